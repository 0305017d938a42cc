"""Bands, decisions, pricing, collections and reject inference."""

from pyspark.sql import functions as F

from loanloom.operators import profiling, strategy
from loanloom.plans.catalog import query
from loanloom.plans.check_sql import SCORED, edges_sql, r6, right_bin, uniform
from loanloom.plans.profile_queries import collection_cases, rounded
from loanloom.session import hold
from loanloom.sources import marts
from loanloom.sources.tables import table

BANDED = SCORED + f""", e AS {edges_sql('score', 'scored', 5)},
b AS (SELECT ({right_bin('score')} - 1)::INT AS band, count(*) AS count, sum(label)::BIGINT AS bad FROM scored, e GROUP BY 1)"""


def _scored(spark, folder, *extra):
    return marts.scores(spark, folder, *extra)


@query("equal_frequency_bands", f"""
WITH {BANDED} SELECT band, count, bad, {r6('bad / count')} AS bad_rate, {r6('count / sum(count) OVER ()')} AS pct_of_total FROM b""")
def equal_frequency_bands(spark, folder):
    return rounded(strategy.equal_frequency_bands(hold(_scored(spark, folder).select("score", "label")), "score", "label"))


@query("band_actions", f"""
WITH {BANDED}, t AS (SELECT avg(label) AS m FROM scored)
SELECT band, count, bad, {r6('bad / count')} AS bad_rate, {r6('count / sum(count) OVER ()')} AS pct_of_total,
  {r6('sum(count) OVER (ORDER BY band) / sum(count) OVER ()')} AS cum_approval_rate, {r6('bad / count / m')} AS lift,
  CASE WHEN bad / count < m * 0.5 THEN 'approve' WHEN bad / count < m * 1.5 THEN 'conditional' ELSE 'reject' END AS suggested_action FROM b, t""")
def band_actions(spark, folder):
    df = hold(_scored(spark, folder).select("score", "label"))
    mean = df.agg(F.avg("label").alias("m")).first()["m"]
    return rounded(strategy.band_actions(strategy.equal_frequency_bands(df, "score", "label"), mean))


THRESH = SCORED + """, h AS (SELECT score AS s, sum(label) AS bad, count(*) AS n FROM scored GROUP BY 1),
c AS (SELECT s, sum(bad) OVER (ORDER BY s) / sum(n) OVER (ORDER BY s) AS rate FROM h),
t AS (SELECT target, coalesce((SELECT max(s) FROM c WHERE rate <= target), (SELECT min(s) FROM c)) AS threshold FROM
  (SELECT unnest([0.02, 0.05, 0.1])::DOUBLE AS target))"""


@query("thresholds_for_bad_rates", f"WITH {THRESH} SELECT target, {r6('threshold')} AS threshold FROM t")
def thresholds_for_bad_rates(spark, folder):
    df = hold(_scored(spark, folder).select("score", "label"))
    return rounded(strategy.thresholds_for_bad_rates(df, "score", "label", [0.02, 0.05, 0.1]))


@query("bad_rate_bands", f"""
WITH {THRESH}, b AS (SELECT (SELECT count(DISTINCT threshold) FROM t WHERE score > threshold)::INT AS band, count(*) AS count, sum(label)::BIGINT AS bad FROM scored GROUP BY 1)
SELECT band, count, bad, {r6('bad / count')} AS bad_rate, {r6('count / sum(count) OVER ()')} AS pct_of_total FROM b""")
def bad_rate_bands(spark, folder):
    df = hold(_scored(spark, folder).select("score", "label"))
    return rounded(strategy.bad_rate_bands(df, "score", "label", [0.02, 0.05, 0.1]))


MATRIX = SCORED + f""", e AS {edges_sql('score', 'scored', 5)},
g AS (SELECT 'S' || {right_bin('score')} AS score_band, purpose, round(avg(label), 4) + 0 AS rate, count(*) AS n FROM scored, e GROUP BY 1, 2)"""


def _grid_sql(value: str) -> str:
    """Every band with every segment there is; null where a cell has no rows."""
    return f"""
WITH {MATRIX}, b AS (SELECT DISTINCT score_band FROM g WHERE purpose IS NOT NULL), p AS (SELECT DISTINCT purpose FROM g WHERE purpose IS NOT NULL)
SELECT b.score_band, p.purpose, g.{value} FROM b CROSS JOIN p LEFT JOIN g ON g.purpose = p.purpose AND g.score_band IS NOT DISTINCT FROM b.score_band"""


def _matrix(spark, folder, value):
    df = hold(_scored(spark, folder, "purpose").select("score", "label", "purpose"))
    cells = strategy.strategy_cells(df, "score", "purpose", "label", 5)
    return profiling.matrix_cells(cells, "score_band", "purpose", value).select("score_band", F.inline("cells"))


@query("strategy_matrix", _grid_sql("rate"))
def strategy_matrix(spark, folder):
    return _matrix(spark, folder, "rate")


@query("strategy_count_matrix", _grid_sql("n"))
def strategy_count_matrix(spark, folder):
    return _matrix(spark, folder, "n")


POINTS = "round(700 - 400 * score, 2)"


@query("dual_score_decision", f"""
WITH {SCORED}, d AS (SELECT loan_id, {POINTS} AS cs, score2 AS fs FROM scored)
SELECT loan_id, CASE WHEN fs > 0.3 THEN 'REJECT_FRAUD' WHEN fs > 0.1 THEN CASE WHEN cs < 500 THEN 'REJECT' ELSE 'MANUAL_REVIEW' END
  WHEN cs >= 600 THEN 'APPROVE' WHEN cs >= 550 THEN 'APPROVE_CONDITIONAL' WHEN cs >= 500 THEN 'MANUAL_REVIEW' ELSE 'REJECT' END AS decision FROM d""")
def dual_score_decision(spark, folder):
    return _scored(spark, folder).select("loan_id", strategy.dual_score_decision(F.expr(POINTS), F.col("score2")).alias("decision"))


@query("two_stage_decision", f"""
WITH {SCORED}, d AS (SELECT loan_id, {POINTS} AS cs, score2 AS m FROM scored)
SELECT loan_id, CASE WHEN cs < 550 OR m > 0.15 THEN 'REJECT' ELSE 'APPROVE' END AS result,
  CASE WHEN cs < 550 THEN 'scorecard_reject' WHEN m > 0.15 THEN 'ml_high_risk' END AS reason FROM d""")
def two_stage_decision(spark, folder):
    d = _scored(spark, folder).select("loan_id", strategy.two_stage_decision(F.expr(POINTS), F.col("score2")).alias("d"))
    return d.select("loan_id", "d.result", "d.reason")


@query("risk_based_pricing", f"""
WITH {SCORED} SELECT loan_id, {r6('score * 0.6')} AS expected_loss_rate, {r6('0.05 + score * 0.6 + 0.02')} AS required_rate,
  {r6('least(0.05 + score * 0.6 + 0.02, 0.24)')} AS actual_rate, (0.05::DOUBLE + score * 0.6 + 0.02) <= 0.24 AS is_viable FROM scored""")
def risk_based_pricing(spark, folder):
    return rounded(_scored(spark, folder).select("loan_id", *[c.alias(n) for n, c in strategy.price(F.col("score")).items()]))


@query("credit_limit", f"""
WITH {SCORED}, x AS (SELECT loan_id, {POINTS} AS cs, annualIncome AS inc, least(score2 * 2, 1) AS dbr FROM scored),
y AS (SELECT *, inc * CASE WHEN cs >= 650 THEN 8 WHEN cs >= 600 THEN 5 ELSE 3 END * CASE WHEN dbr > 0.5 THEN 0.7 ELSE 1.0 END::DOUBLE AS b FROM x)
SELECT loan_id, CASE WHEN inc IS NOT NULL THEN round_even(CASE WHEN cs < 500 THEN least(b, 5000) WHEN cs < 600 THEN least(b, 20000) ELSE b END / 1000, 0) * 1000 END AS credit_limit FROM y""")
def credit_limit(spark, folder):
    cs = F.expr(POINTS)
    multiple = F.when(cs >= 650, 8).when(cs >= 600, 5).otherwise(3)
    lim = strategy.credit_limit(cs, F.col("annualIncome"), F.least(F.col("score2") * 2, F.lit(1.0)), multiple)
    return _scored(spark, folder, "annualIncome").select("loan_id", F.when(F.col("annualIncome").isNotNull(), lim).alias("credit_limit"))


POLICY = [
    {"channel": None, "min_score": 500, "max_fraud": 0.5, "result": "MANUAL", "reason": None},
    {"channel": None, "min_score": 600, "max_fraud": 0.2, "result": "APPROVE", "reason": None},
    {"channel": "BUILDING", "min_score": 640, "max_fraud": 0.05, "result": "MANUAL", "reason": None},
]


@query("decision_engine", f"""
WITH {SCORED}, x AS (SELECT loan_id, {POINTS}::INT AS cs, score2 AS fs, purpose AS ch, grade = 'E' AS bl, (n0 * 8)::INT AS age,
  regionCode = 7 AS sx, annualIncome / 12 AS inc FROM scored),
r AS (SELECT *, CASE WHEN bl THEN 'blacklist' WHEN coalesce(age, 25) < 18 OR coalesce(age, 25) > 70 THEN 'age_out_of_range' WHEN sx THEN 'sanctions' END AS rule,
  CASE WHEN cs >= 640 AND fs <= 0.05 AND ch = 'BUILDING' THEN 'MANUAL' WHEN cs >= 600 AND fs <= 0.2 THEN 'APPROVE'
    WHEN cs >= 500 AND fs <= 0.5 THEN 'MANUAL' ELSE 'REJECT' END AS pol FROM x),
f AS (SELECT *, CASE WHEN rule IS NOT NULL THEN 'REJECT' WHEN pol = 'MANUAL' THEN 'MANUAL_REVIEW' ELSE pol END AS final FROM r)
SELECT loan_id, final, CASE WHEN rule IS NOT NULL THEN rule WHEN final = 'REJECT' THEN 'policy_reject' END AS reason,
  CASE WHEN final = 'APPROVE' THEN {r6('least(coalesce(inc, 5000) * CASE WHEN cs > 700 THEN 6 WHEN cs > 600 THEN 4 ELSE 2 END, 200000)')} END AS "limit",
  CASE WHEN final = 'APPROVE' THEN CASE WHEN cs > 700 THEN 0.10 WHEN cs > 600 THEN 0.15 ELSE 0.20 END END::DOUBLE AS rate,
  CASE WHEN rule IS NOT NULL THEN 'rules:' || rule ELSE 'rules:PASS>score:' || cs || '>policy:' || pol END AS steps FROM f""")
def decision_engine(spark, folder):
    df = _scored(spark, folder, "purpose", "grade", "regionCode", "annualIncome", "n0").select(
        "loan_id", F.rint(F.expr(POINTS)).cast("int").alias("credit_score"), F.col("score2").alias("fraud_score"),
        F.col("purpose").alias("channel"), (F.col("grade") == "E").alias("is_blacklist"), (F.col("n0") * 8).cast("int").alias("age"),
        (F.col("regionCode") == 7).alias("is_sanctions"), (F.col("annualIncome") / 12).alias("monthly_income"))
    out = strategy.decide(df, strategy.policy_table(spark, POLICY))
    return out.select("loan_id", "final", "reason", F.round("limit", 6).alias("limit"), "rate", F.array_join("steps", ">").alias("steps"))


@query("fallback_score", f"""
WITH {SCORED}, x AS (SELECT loan_id, CASE WHEN grade <> 'A' THEN score END AS m, n0 AS q, n_bad_lines AS o FROM scored)
SELECT loan_id, coalesce(m, CASE WHEN coalesce(q, 0) > 10 THEN 0.8 WHEN o >= 3 THEN 0.7 ELSE 0.1 END)::DOUBLE AS final_score,
  CASE WHEN m IS NULL THEN 'fallback_rules' ELSE 'model' END AS source,
  CASE WHEN m IS NULL THEN CASE WHEN coalesce(q, 0) > 10 OR o >= 3 THEN 'HIGH' ELSE 'MEDIUM' END END AS risk FROM x""")
def fallback_score(spark, folder):
    df = _scored(spark, folder, "grade", "n0", "n_bad_lines")
    m = F.when(F.col("grade") != "A", F.col("score"))
    return df.select("loan_id", *[c.alias(n) for n, c in strategy.fallback_score(m, F.col("n0"), F.col("n_bad_lines")).items()])


@query("customer_segments", f"""
WITH {SCORED} SELECT CASE WHEN homeOwnership = 'F' THEN 'existing' WHEN annualIncome IS NOT NULL THEN 'with_file'
  WHEN n0 * 8 < 25 THEN 'young_no_file' ELSE 'other_no_file' END AS segment, count(*) AS n, {r6('avg(label)')} AS bad_rate FROM scored GROUP BY 1""")
def customer_segments(spark, folder):
    df = _scored(spark, folder, "homeOwnership", "annualIncome", "n0")
    seg = strategy.customer_segment(F.col("annualIncome").isNotNull(), F.col("n0") * 8, F.col("homeOwnership") == "F")
    return df.groupBy(seg.alias("segment")).agg(F.count("*").alias("n"), F.round(F.avg("label"), 6).alias("bad_rate"))


@query("collection_priority", f"""
WITH {SCORED}, e AS {edges_sql('score2', 'scored', 5)}
SELECT loan_id, round(score2 * loanAmnt, 2) AS expected_recovery, round(score2 * loanAmnt - 50, 2) AS net_value, 'T' || (len(e) - {right_bin('score2')}) AS collection_tier,
  CASE len(e) - {right_bin('score2')} WHEN 1 THEN 'sms_only' WHEN 2 THEN 'outbound_call' WHEN 3 THEN 'intensive_call' WHEN 4 THEN 'third_party'
    WHEN 5 THEN 'legal_action' END AS collection_strategy FROM scored, e""")
def collection_priority(spark, folder):
    df = hold(_scored(spark, folder, "loanAmnt").select("loan_id", "score2", "loanAmnt"))
    out = strategy.collection_priority(df, "score2", "loanAmnt", 50.0).drop("score2", "loanAmnt")
    return out.withColumns({c: F.round(c, 2) for c in ("expected_recovery", "net_value")})


@query("collection_contacts", """
SELECT user_id, count(*) FILTER (event_type IN ('view', 'click')) AS contact_count,
  round(count(*) FILTER (event_type = 'click') / nullif(count(*) FILTER (event_type IN ('view', 'click')), 0), 6) AS response_rate,
  count(*) FILTER (event_type = 'signup') AS promises, count(*) FILTER (event_type = 'error') AS broken_promise_count,
  round(count(*) FILTER (event_type = 'purchase' AND value < 10) / nullif(count(*) FILTER (event_type = 'purchase'), 0), 6) AS partial_payment_share
FROM events GROUP BY 1""")
def collection_contacts(spark, folder):
    n = lambda cond: F.count(F.when(cond, 1))
    t = F.col("event_type")
    contact = t.isin("view", "click")
    return table(spark, folder, "events").groupBy("user_id").agg(
        n(contact).alias("contact_count"), F.round(F.try_divide(n(t == "click"), n(contact)), 6).alias("response_rate"),
        n(t == "signup").alias("promises"), n(t == "error").alias("broken_promise_count"),
        F.round(F.try_divide(n((t == "purchase") & (F.col("value") < 10)), n(t == "purchase")), 6).alias("partial_payment_share"))


REJ = SCORED + ", ap AS (SELECT loan_id, label, score FROM scored WHERE score <= 0.3), rj AS (SELECT loan_id, score FROM scored WHERE score > 0.3)"


def _approved_rejected(spark, folder):
    df = _scored(spark, folder).select("loan_id", "label", "score")
    return df.where("score <= 0.3"), df.where("score > 0.3")


@query("reject_as_bad", f"WITH {REJ} SELECT loan_id, label, score FROM ap UNION ALL SELECT loan_id, 1, score FROM rj")
def reject_as_bad(spark, folder):
    return strategy.reject_as_bad(*_approved_rejected(spark, folder), "label")


@query("fuzzy_rejects", f"""
WITH {REJ} SELECT loan_id, label, score FROM ap UNION ALL
SELECT loan_id, ({uniform('loan_id', 42)} / 4294967296.0 < least(score * 1.5, 1))::INT, score FROM rj""")
def fuzzy_rejects(spark, folder):
    return strategy.fuzzy_rejects(*_approved_rejected(spark, folder), "label", "score", "loan_id", 1.5)


@query("confident_labels", f"""
WITH {SCORED} SELECT loan_id, CASE WHEN score < 0.05 THEN 0 ELSE 1 END AS label, score FROM scored WHERE score < 0.05 OR score > 1 - 0.05 / 2.0""")
def confident_labels(spark, folder):
    return strategy.confident_labels(_scored(spark, folder).select("loan_id", "label", "score"), "score", "label")


@query("extended_training_rows", f"""
WITH {SCORED} SELECT loan_id, label, score, false AS is_pseudo FROM scored WHERE year(issueDate) <= 1999 UNION ALL
SELECT loan_id, CASE WHEN score < 0.05 THEN 0 ELSE 1 END, score, true FROM scored WHERE year(issueDate) > 1999 AND (score < 0.05 OR score > 1 - 0.05 / 2.0)""")
def extended_training_rows(spark, folder):
    """Labelled rows of the early years and the confident ones of the later years, marked."""
    df = hold(_scored(spark, folder, "issueDate").select("loan_id", "label", "score", (F.year("issueDate") <= 1999).alias("early")))
    train, later = df.where("early").drop("early"), df.where("NOT early").drop("early", "label")
    return strategy.extend_with_confident(train, later, "score", "label")


@query("recovery_by_tier", """
WITH c AS (SELECT l_orderkey AS loan_id, round(sum(CASE WHEN l_linestatus = 'F' THEN l_extendedprice ELSE 0 END), 2) AS col, round(sum(l_extendedprice), 2) AS ead FROM lineitem GROUP BY 1)
SELECT o_orderstatus AS status, round(1 - sum(col) / sum(ead), 6) AS lgd, count(*) AS n FROM c JOIN orders ON o_orderkey = loan_id GROUP BY 1""")
def recovery_by_tier(spark, folder):
    c = collection_cases(spark, folder).join(
        table(spark, folder, "orders").select(F.col("o_orderkey").alias("loan_id"), F.col("o_orderstatus").alias("status")), "loan_id")
    return c.groupBy("status").agg(F.round(1 - F.sum("collected_amount") / F.sum("ead"), 6).alias("lgd"), F.count("*").alias("n"))
