"""Ranking metrics, all from the prefix sums of the score histogram or from row positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from loanloom.operators.binning import quantile_edges, right_closed_bin
from loanloom.operators.ordering import average_ranks, exact_quantiles, prefix_sums, row_positions
from loanloom.operators.profiling import small_frame, to_long


def score_curve(df: DataFrame, score: str = "score", label: str = "label", by: Sequence[str] = (), extra: Sequence[str] = ()):
    """One row per distinct score, highest first: bad, good, counts before and up to it, totals."""
    rows = df.select(
        *by, F.col(score).alias("score"), F.col(label).cast("long").alias("bad"), (1 - F.col(label)).cast("long").alias("good"),
        *extra,
    )
    out = prefix_sums(rows, "score", ["bad", "good", *extra], by, descending=True)
    return out.withColumns({
        "cum_bad": F.col("before_bad") + F.col("bad"), "cum_good": F.col("before_good") + F.col("good"),
        "tpr": F.try_divide(F.col("before_bad") + F.col("bad"), F.col("total_bad")),
        "fpr": F.try_divide(F.col("before_good") + F.col("good"), F.col("total_good")),
    })


def _metric_columns() -> list[Column]:
    b, g = F.col("total_bad").cast("double"), F.col("total_good").cast("double")  # their product leaves the range of long
    beaten = F.col("bad").cast("double") * ((g - F.col("cum_good")) + F.col("good") / 2)
    top = F.max(F.struct((F.col("tpr") - F.col("fpr")).alias("ks"), F.col("score").alias("at")))
    precision = F.col("cum_bad") / (F.col("cum_bad") + F.col("cum_good"))
    auc = F.try_divide(F.sum(beaten), F.max(b * g))
    return [
        (F.sum("bad") + F.sum("good")).alias("n"), F.sum("bad").alias("bad"), auc.alias("auc"), (2 * auc - 1).alias("gini"),
        top["ks"].alias("ks"), top["at"].alias("ks_threshold"),
        F.try_divide(F.sum(F.col("bad") * precision), F.max(b)).alias("ap"),
    ]


def evaluate(df: DataFrame, score: str = "score", label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """n, bad, AUC, Gini, KS with its threshold and average precision; one row per group."""
    curve = score_curve(df, score, label, by)
    return curve.groupBy(*by).agg(*_metric_columns()) if by else curve.agg(*_metric_columns())


def compare_models(df: DataFrame, models: Sequence[str], label: str = "label") -> DataFrame:
    """All score columns evaluated in one pass, best KS first."""
    long = to_long(df, models, [label]).withColumnsRenamed({"feature": "model", "value": "score"})
    return evaluate(long, "score", label, ["model"]).select("model", "auc", "gini", "ks", "ap").orderBy(F.desc("ks"))


def ks_table(df: DataFrame, score: str, label: str, key: str, bins: int = 10) -> DataFrame:
    """Position deciles from the highest score down."""
    p = row_positions(df.select(key, score, label), score, key)
    spot = F.least(F.floor((F.col("pos") - 1) * bins / F.col("total")) + 1, F.lit(bins)).cast("int")
    t = p.groupBy(spot.alias("decile")).agg(
        F.min(score).alias("score_min"), F.max(score).alias("score_max"), F.count("*").alias("count"), F.sum(label).alias("bad")
    )
    return _cumulate(t, "count")


def _cumulate(t: DataFrame, n: str) -> DataFrame:
    """Cumulative shares and KS over the few rows of a band table."""
    upto = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    t = t.withColumn("good", F.col(n) - F.col("bad"))
    share = lambda c: F.sum(c).over(upto) / F.sum(c).over(whole)
    return t.withColumns({
        "bad_rate": F.col("bad") / F.col(n), "cum_bad_pct": share("bad"), "cum_good_pct": share("good"),
        "ks": F.abs(share("bad") - share("good")),
    })


def ks_by_value_decile(df: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """Deciles cut by score value; decile 0 is the highest."""
    edges = quantile_edges(df, [score], bins)[score]
    spot = (F.lit(max(1, len(edges) - 1)) - right_closed_bin(score, edges)).cast("int")
    t = df.where(F.col(score).isNotNull()).groupBy(spot.alias("decile")).agg(
        F.count("*").alias("total"), F.sum(label).alias("bad"))
    return _cumulate(t, "total")


def lift_table(df: DataFrame, score: str, label: str, key: str, bins: int = 10) -> DataFrame:
    p = row_positions(df.select(key, score, label), score, key)
    spot = F.greatest(F.ceil((F.col("pos") - 1) * bins / F.greatest(F.col("total") - 1, F.lit(1))), F.lit(1)).cast("int")
    t = p.groupBy(spot.alias("decile")).agg(F.count("*").alias("count"), F.sum(label).alias("bad"))
    upto = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    return t.withColumns({
        "bad_rate": F.col("bad") / F.col("count"),
        "cum_bad_capture": F.sum("bad").over(upto) / F.sum("bad").over(whole),
        "pct_population": F.sum("count").over(upto) / F.sum("count").over(whole),
    }).withColumn("lift", F.col("cum_bad_capture") / F.col("pct_population"))


def lift_curve(df: DataFrame, score: str, label: str, key: str) -> DataFrame:
    """Row by row from the highest score: captured share of the bad, share of the population, lift."""
    total_bad = df.where(F.col(score).isNotNull()).agg(F.sum(label).alias("b")).first()["b"]
    p = row_positions(df.select(key, score, label), score, key, sums=[label])
    return p.select(
        key, score, label, "pos", F.col(f"cum_{label}").alias("cum_bad"),
        (F.col("pos") / F.col("total")).alias("pct_population"),
        (F.col(f"cum_{label}") / F.lit(total_bad)).alias("cum_bad_rate"),
    ).withColumn("lift", F.col("cum_bad_rate") / F.col("pct_population"))


def roc_table(df: DataFrame, score: str = "score", label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    c = score_curve(df, score, label, by)
    return c.select(*by, F.col("score").alias("threshold"), "tpr", "fpr", (F.col("tpr") - F.col("fpr")).alias("diff"))


def pr_table(df: DataFrame, score: str = "score", label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall per threshold and the trapezoid that ends there."""
    c = score_curve(df, score, label, by)
    precision = F.col("cum_bad") / (F.col("cum_bad") + F.col("cum_good"))
    before_n = F.col("before_bad") + F.col("before_good")
    previous = F.when(before_n == 0, 1.0).otherwise(F.try_divide(F.col("before_bad"), before_n))
    return c.select(
        *by, F.col("score").alias("threshold"), precision.alias("precision"), F.col("tpr").alias("recall"),
        (F.col("bad") / F.col("total_bad") * (precision + previous) / 2).alias("area"),
    )


def confusion_metrics(df: DataFrame, score: str, label: str, threshold: float = 0.5) -> DataFrame:
    hit = F.col(score) >= threshold
    bad = F.col(label) == 1
    n = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    t = df.where(F.col(score).isNotNull()).agg(
        n(hit & bad).alias("tp"), n(hit & ~bad).alias("fp"), n(~hit & ~bad).alias("tn"), n(~hit & bad).alias("fn"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    t = t.withColumns({
        "precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")), "recall": ratio(F.col("tp"), F.col("tp") + F.col("fn")),
        "good_fp_rate": ratio(F.col("fp"), F.col("fp") + F.col("tn")),
    })
    return t.withColumns({
        "f1": ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
        "bad_capture_rate": F.col("recall"),
    })


def risk_model_metrics(df: DataFrame, score: str, label: str, threshold: float = 0.5) -> DataFrame:
    """Confusion metrics beside AUC and KS; two one-row tables side by side."""
    rank = evaluate(df, score, label).select("auc", "ks", "ks_threshold")
    return confusion_metrics(df, score, label, threshold).withColumn("_one", F.lit(1)).join(
        F.broadcast(rank.withColumn("_one", F.lit(1))), "_one").drop("_one")  # one row each


def calibration_table(df: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """Mean predicted and observed rate per uniform probability bin."""
    spot = right_closed_bin(score, [i / bins for i in range(bins + 1)])
    return df.where(F.col(score).isNotNull()).groupBy(spot.alias("bin")).agg(
        F.avg(score).alias("mean_predicted"), F.avg(label).alias("observed"), F.count("*").alias("n"))


def brier_score(df: DataFrame, score: str, label: str) -> DataFrame:
    return df.agg(F.avg(F.pow(F.col(score) - F.col(label), F.lit(2.0))).alias("brier"))


def rejection_analysis(df: DataFrame, score: str, label: str, key: str, shares: Sequence[float] = (0.1, 0.2, 0.3, 0.4)):
    """Reject the riskiest share: captured bad, bad rate of the approved and of the rejected."""
    p = row_positions(df.select(key, score, label), score, key)
    parts = []
    for s in shares:
        cut = F.col("pos") <= F.floor(F.col("total") * F.lit(s))
        parts.append(F.struct(
            F.lit(s).alias("reject_rate"),
            (F.sum(F.when(cut, F.col(label)).otherwise(0)) / F.sum(label)).alias("reject_bad_capture"),
            F.avg(F.when(~cut, F.col(label))).alias("approve_bad_rate"),
            F.avg(F.when(cut, F.col(label))).alias("reject_bad_rate")))
    return p.agg(F.array(*parts).alias("a")).select(F.inline("a"))


def threshold_table(df: DataFrame, score: str, label: str, thresholds: Sequence[float], low_passes: bool = True) -> DataFrame:
    """Pass rate and bad rates at fixed thresholds, all in one aggregate without a join."""
    parts = []
    for t in thresholds:
        ok = F.col(score) <= F.lit(t) if low_passes else F.col(score) >= F.lit(t)
        parts.append(F.struct(
            F.lit(float(t)).alias("threshold"), F.avg(ok.cast("double")).alias("pass_rate"),
            F.coalesce(F.avg(F.when(ok, F.col(label))), F.lit(0.0)).alias("approve_bad_rate"),
            F.avg(F.when(~ok, F.col(label))).alias("reject_bad_rate")))
    return df.where(F.col(score).isNotNull()).agg(F.array(*parts).alias("a")).select(F.posexplode("a").alias("point", "s")).select("point", "s.*")


def pass_rate_curve(df: DataFrame, score: str, label: str, points: int = 20) -> DataFrame:
    q = exact_quantiles(df, [score], [i / (points - 1) for i in range(points)])[score]
    return threshold_table(df, score, label, q)


def cutoffs_for_pass_rates(df: DataFrame, score: str, label: str, rates: Sequence[float] = (0.4, 0.5, 0.6, 0.7)) -> DataFrame:
    """Cut-off per wanted pass rate where a high score passes."""
    q = exact_quantiles(df, [score], [1 - r for r in rates])[score]
    t = threshold_table(df, score, label, q, low_passes=False)
    return t.select(
        F.get(F.lit([float(r) for r in rates]), F.col("point")).alias("target_pass_rate"), F.rint("threshold").alias("cutoff_score"),
        F.col("pass_rate").alias("actual_pass_rate"), F.col("approve_bad_rate").alias("pass_bad_rate"), "reject_bad_rate")


def precision_at_recall(df: DataFrame, score: str, label: str, targets: Sequence[float] = (0.7, 0.8, 0.9)) -> DataFrame:
    """Precision and threshold at the point whose recall is nearest to each target."""
    pr = pr_table(df, score, label)
    picks = []
    for t in targets:
        near = F.min(F.struct(F.abs(F.col("recall") - t).alias("d"), F.col("threshold"), F.col("precision"), F.col("recall")))
        picks.append(F.struct(F.lit(t).alias("target_recall"), near["precision"].alias("precision"),
                              near["recall"].alias("recall"), near["threshold"].alias("threshold")))
    return pr.agg(F.array(*picks).alias("a")).select(F.inline("a"))


def capture_in_top(df: DataFrame, score: str, label: str, amount: str, key: str, shares: Sequence[float] = (0.05, 0.1, 0.2)):
    """Share of bad cases and of bad amount inside the riskiest shares."""
    p = row_positions(df.select(key, score, label, amount), score, key)
    bad_amount = F.when(F.col(label) == 1, F.col(amount)).otherwise(0.0)
    parts = []
    for s in shares:
        cut = F.col("pos") <= F.floor(F.col("total") * F.lit(s))
        parts.append(F.struct(
            F.lit(s).alias("reject_rate"), (F.sum(F.when(cut, F.col(label)).otherwise(0)) / F.sum(label)).alias("case_capture"),
            (F.sum(F.when(cut, bad_amount).otherwise(0.0)) / F.sum(bad_amount)).alias("amount_capture")))
    return p.agg(F.array(*parts).alias("a")).select(F.inline("a"))


def metrics_by_period(df: DataFrame, score: str, label: str, period: str, min_bad: int = 5) -> DataFrame:
    e = evaluate(df, score, label, [period]).where(F.col("bad") >= min_bad)
    return e.select(period, "n", (F.col("bad") / F.col("n")).alias("bad_rate"), "auc", "ks")


def fairness_audit(df: DataFrame, score: str, label: str, group: str, min_rows: int = 30) -> DataFrame:
    """Per group: size, bad rate, AUC, KS, pass rate at the overall median, AUC gap to the whole."""
    median = exact_quantiles(df, [score], [0.5])[score][0]
    overall = evaluate(df, score, label).first()["auc"]
    passes = df.where(F.col(score).isNotNull()).groupBy(group).agg(
        F.avg((F.col(score) <= median).cast("double")).alias("pass_rate_at_median"))
    e = evaluate(df, score, label, [group]).where(F.col("n") >= min_rows)
    return e.join(passes, group).select(
        group, "n", (F.col("bad") / F.col("n")).alias("bad_rate"), "auc", "ks", "pass_rate_at_median",
        (F.col("auc") - F.lit(overall)).alias("auc_gap"))


def rank_blend(df: DataFrame, scores: Sequence[str], key: str, weights: Sequence[float] | None = None, name: str = "blend"):
    """Weighted mean of percentile ranks (ties averaged), one pass per score column. A row with a null score stays, without a blend."""
    weights = list(weights or [1.0] * len(scores))
    df = average_ranks(df, scores, key, [f"_rank{i}" for i in range(len(scores))])
    total = sum((F.col(f"_rank{i}") * F.lit(float(w)) for i, w in enumerate(weights)), F.lit(0.0))
    return df.withColumn(name, total / F.lit(float(sum(weights)))).drop(*[f"_rank{i}" for i in range(len(scores))])


def probability_blend(scores: Sequence[str], weights: Sequence[float] | None = None) -> Column:
    weights = list(weights or [1.0] * len(scores))
    total = sum((F.col(s) * F.lit(float(w)) for s, w in zip(scores, weights)), F.lit(0.0))
    return total / F.lit(float(sum(weights)))
