"""Score bands, decision tables, pricing, limits and reject inference."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from loanloom.functions.hashing import hash_unit
from loanloom.operators.binning import quantile_edges, right_closed_bin
from loanloom.operators.profiling import small_frame
from loanloom.operators.ranking import score_curve

# Fixed values of the decision tables.
RATE_CAP = 0.24
LIMIT_CAP = 200000
LIMIT_MULTIPLES = ((700, 6), (600, 4), (None, 2))
LIMIT_RATES = ((700, 0.10), (600, 0.15), (None, 0.20))
TIER_ACTIONS = {"T1": "sms_only", "T2": "outbound_call", "T3": "intensive_call", "T4": "third_party", "T5": "legal_action"}


def band_stats(df: DataFrame, band: Column, label: str) -> DataFrame:
    t = df.groupBy(band.alias("band")).agg(F.count("*").alias("count"), F.sum(label).alias("bad"))
    return t.withColumns({
        "bad_rate": F.col("bad") / F.col("count"), "pct_of_total": F.col("count") / F.sum("count").over(Window.partitionBy())})


def equal_frequency_bands(df: DataFrame, score: str, label: str, bands: int = 5) -> DataFrame:
    edges = quantile_edges(df, [score], bands)[score]
    return band_stats(df.where(F.col(score).isNotNull()), right_closed_bin(score, edges) - 1, label)


def thresholds_for_bad_rates(df: DataFrame, score: str, label: str, targets: Sequence[float]) -> DataFrame:
    """Largest score up to which the bad rate stays within each target, for all targets in one pass.

    A score passes when it is at or below the threshold. The lowest score answers where no score
    keeps the target.
    """
    c = score_curve(df, score, label)
    upto_bad = F.col("total_bad") - F.col("before_bad")
    upto_n = upto_bad + F.col("total_good") - F.col("before_good")
    rows = c.select("score", (upto_bad / upto_n).alias("rate"))
    picks = [
        F.struct(F.lit(float(t)).alias("target"),
                 F.coalesce(F.max(F.when(F.col("rate") <= t, F.col("score"))), F.min("score")).alias("threshold"))
        for t in targets]
    return rows.agg(F.array(*picks).alias("a")).select(F.inline("a"))


def bad_rate_bands(df: DataFrame, score: str, label: str, targets: Sequence[float]) -> DataFrame:
    cuts = sorted(r["threshold"] for r in thresholds_for_bad_rates(df, score, label, targets).collect())
    band = sum((F.when(F.col(score) > c, 1).otherwise(0) for c in sorted(set(cuts))), F.lit(0))
    return band_stats(df.where(F.col(score).isNotNull()), band, label)


def band_actions(stats: DataFrame, total_bad_rate: float) -> DataFrame:
    """Cumulative approval share, lift and the suggested action of each band."""
    upto = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    r = F.col("bad_rate")
    return stats.withColumns({
        "cum_approval_rate": F.sum("pct_of_total").over(upto), "lift": r / total_bad_rate,
        "suggested_action": F.when(r < total_bad_rate * 0.5, "approve").when(r < total_bad_rate * 1.5, "conditional")
        .otherwise("reject")})


def strategy_cells(df: DataFrame, score: str, segment: str, label: str, bands: int = 5) -> DataFrame:
    """(score_band, segment, rate, n): bad rate and count of each cell of score band by segment."""
    edges = quantile_edges(df, [score], bands)[score]
    banded = df.withColumn("score_band", F.concat(F.lit("S"), right_closed_bin(score, edges)))
    return banded.groupBy("score_band", segment).agg(F.round(F.avg(label), 4).alias("rate"), F.count(label).alias("n"))


def strategy_matrix(df: DataFrame, score: str, segment: str, label: str, bands: int = 5, segments: Sequence | None = None):
    """Bad-rate matrix and count matrix, score band by segment, a column per segment."""
    cells = strategy_cells(df, score, segment, label, bands)
    wide = lambda v: cells.groupBy("score_band").pivot(segment, list(segments) if segments else None).agg(F.first(v))
    return wide("rate"), wide("n")


def dual_score_decision(credit: Column, fraud: Column, credit_cuts=(500, 550, 600), fraud_cuts=(0.1, 0.3)) -> Column:
    low, mid, high = credit_cuts
    watch, stop = fraud_cuts
    cautious = F.when(credit < low, "REJECT").otherwise("MANUAL_REVIEW")
    clean = (
        F.when(credit >= high, "APPROVE").when(credit >= mid, "APPROVE_CONDITIONAL").when(credit >= low, "MANUAL_REVIEW")
        .otherwise("REJECT"))
    return F.when(fraud > stop, "REJECT_FRAUD").when(fraud > watch, cautious).otherwise(clean)


def two_stage_decision(card: Column, model: Column, card_cut: float = 550, model_cut: float = 0.15) -> Column:
    """struct(result, reason): the card gates, the model refines."""
    out = lambda result, reason: F.struct(F.lit(result).alias("result"), F.lit(reason).cast("string").alias("reason"))
    return (
        F.when(card < card_cut, out("REJECT", "scorecard_reject")).when(model > model_cut, out("REJECT", "ml_high_risk"))
        .otherwise(out("APPROVE", None)))


def price(pd: Column, lgd: float = 0.6, cost_of_fund: float = 0.05, target_roi: float = 0.02) -> dict[str, Column]:
    loss = pd * F.lit(lgd)
    need = F.lit(cost_of_fund) + loss + F.lit(target_roi)
    return {"expected_loss_rate": loss, "required_rate": need, "actual_rate": F.least(need, F.lit(RATE_CAP)),
            "is_viable": need <= RATE_CAP}


def credit_limit(score: Column, income: Column, debt_burden: Column, multiple: Column) -> Column:
    """Income times the policy multiple, cut for debt and for weak scores, in thousands (half to even)."""
    base = income * multiple * F.when(debt_burden > 0.5, 0.7).otherwise(1.0)
    capped = F.when(score < 500, F.least(base, F.lit(5000.0))).when(score < 600, F.least(base, F.lit(20000.0))).otherwise(base)
    return F.rint(capped / 1000) * 1000


def stepped(value: Column, steps) -> Column:
    """First step whose bound lies below the value; the last step has no bound."""
    out = F
    for bound, result in steps:
        out = out.when(value > bound, result) if bound is not None else out.otherwise(result)
    return out


def decide(df: DataFrame, policy: DataFrame, score: str = "credit_score", fraud: str = "fraud_score") -> DataFrame:
    """Hard rules, then the policy row of the score bands and channel, then limit and rate.

    ``policy``: (channel, min_score, max_fraud, result, reason), checked from the strictest row down; it
    is a rule table, so its rows become one expression instead of a join.
    """
    rules = (
        F.when(F.coalesce("is_blacklist", F.lit(False)), "blacklist")
        .when((F.coalesce("age", F.lit(25)) < 18) | (F.coalesce("age", F.lit(25)) > 70), "age_out_of_range")
        .when(F.coalesce("is_sanctions", F.lit(False)), "sanctions"))
    cell = F.lit(None).cast("struct<result:string,reason:string>")
    for r in sorted(policy.collect(), key=lambda r: (r["min_score"], -r["max_fraud"])):
        here = (F.col(score) >= r["min_score"]) & (F.col(fraud) <= r["max_fraud"])
        if r["channel"] is not None:
            here = here & (F.col("channel") == r["channel"])
        cell = F.when(here, F.struct(F.lit(r["result"]).alias("result"), F.lit(r["reason"]).cast("string").alias("reason"))).otherwise(cell)
    df = df.withColumns({"_rule": rules, "_cell": cell})
    passed = F.col("_rule").isNull()
    result = F.coalesce(F.col("_cell.result"), F.lit("REJECT"))
    final = F.when(~passed, "REJECT").when(result == "APPROVE", "APPROVE").when(result == "MANUAL", "MANUAL_REVIEW").otherwise("REJECT")
    df = df.withColumn("final", final)
    approved = F.col("final") == "APPROVE"
    income = F.coalesce("monthly_income", F.lit(5000.0))
    steps = F.array_compact(F.array(
        F.when(passed, "rules:PASS").otherwise(F.concat(F.lit("rules:"), F.col("_rule"))),
        F.when(passed, F.concat(F.lit("score:"), F.col(score).cast("string"))),
        F.when(passed, F.concat(F.lit("policy:"), result))))
    return df.withColumns({
        "reason": F.when(~passed, F.col("_rule")).when(F.col("final") == "REJECT", F.coalesce("_cell.reason", F.lit("policy_reject"))),
        "limit": F.when(approved, F.least(income * stepped(F.col(score), LIMIT_MULTIPLES), F.lit(float(LIMIT_CAP)))),
        "rate": F.when(approved, stepped(F.col(score), LIMIT_RATES)), "steps": steps}).drop("_rule", "_cell")


def fallback_score(model_score: Column, queries: Column, overdue: Column) -> dict[str, Column]:
    """Rule score for rows the model could not score."""
    rule = F.when(F.coalesce(queries, F.lit(0)) > 10, 0.8).when(F.coalesce(overdue, F.lit(0)) >= 3, 0.7).otherwise(0.1)
    return {"final_score": F.coalesce(model_score, rule),
            "source": F.when(model_score.isNotNull(), "model").otherwise("fallback_rules"),
            "risk": F.when(model_score.isNull(), F.when(rule >= 0.7, "HIGH").otherwise("MEDIUM"))}


def customer_segment(has_file: Column, age: Column, existing: Column) -> Column:
    return (F.when(existing, "existing").when(has_file, "with_file").when(age < 25, "young_no_file").otherwise("other_no_file"))


def collection_priority(df: DataFrame, score: str, owed: str, cost: float) -> DataFrame:
    """Expected recovery, net value, quintile tier and treatment, most valuable first."""
    edges = quantile_edges(df, [score], 5)[score]
    tier = F.concat(F.lit("T"), F.lit(len(edges)) - right_closed_bin(score, edges))
    gain = F.col(score) * F.col(owed)
    actions = F.create_map(*[F.lit(x) for kv in TIER_ACTIONS.items() for x in kv])
    out = df.withColumns({"expected_recovery": gain, "net_value": gain - cost, "collection_tier": tier})
    return out.withColumn("collection_strategy", F.try_element_at(actions, F.col("collection_tier"))).orderBy(F.desc("net_value"))


def reject_as_bad(approved: DataFrame, rejected: DataFrame, label: str) -> DataFrame:
    return approved.unionByName(rejected.withColumn(label, F.lit(1)))


def fuzzy_rejects(approved: DataFrame, rejected: DataFrame, label: str, probability: str, key: str, multiple: float = 2.0, seed: int = 42):
    """Rejected rows get a label drawn with their raised bad probability."""
    p = F.least(F.col(probability) * multiple, F.lit(1.0))
    drawn = (hash_unit(key, seed) < p).cast("int")
    return approved.unionByName(rejected.withColumn(label, drawn))


def confident_labels(df: DataFrame, probability: str, label: str, threshold: float = 0.05, bad_multiple: float = 2.0) -> DataFrame:
    """Rows the model is sure of, labelled: good below the threshold, bad above 1 - threshold / multiple."""
    p = F.col(probability)
    made = F.when(p < threshold, 0).when(p > 1 - threshold / bad_multiple, 1)
    return df.withColumn(label, made).where(F.col(label).isNotNull())


def extend_with_confident(train: DataFrame, scored: DataFrame, probability: str, label: str, threshold: float = 0.05, bad_multiple: float = 2.0):
    extra = confident_labels(scored, probability, label, threshold, bad_multiple)
    return train.withColumn("is_pseudo", F.lit(False)).unionByName(extra.withColumn("is_pseudo", F.lit(True)).select(*train.columns, "is_pseudo"))


def policy_table(spark, rows: Sequence[Mapping]) -> DataFrame:
    return small_frame(spark, list(rows), "channel string, min_score int, max_fraud double, result string, reason string")
