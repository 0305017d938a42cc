"""Population stability and monitoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from loanloom.operators.binning import left_closed_bin, quantile_edges
from loanloom.operators.ordering import exact_quantiles
from loanloom.operators.profiling import numeric_columns, small_frame, to_long


def psi_term(expected: Column, actual: Column) -> Column:
    return (actual - expected) * F.log(actual / expected)


def psi_detail(
    expected: DataFrame, actual: DataFrame, column: str, bins: int = 10, eps: float = 1e-6,
    variant: str = "smoothed", open_ends: bool = False,
) -> DataFrame:
    """PSI per bin; edges are the distinct percentiles of the expected side, left-closed.

    Variants: 'smoothed' = cnt / (n + eps) + eps; 'replace' = zero shares become eps; 'shifted' =
    cnt / n + eps, with the shares shown without eps. Actual values outside the edges count in n but in
    no bin, unless ``open_ends`` puts them into the outer bins.
    """
    expected, actual = (d.select(F.col(column).cast("double").alias(column)).where(f"`{column}` IS NOT NULL")
                        for d in (expected, actual))
    edges = quantile_edges(expected, [column], bins)[column]
    side = lambda d, tag: d.select(left_closed_bin(column, edges, open_ends).alias("bin"), F.lit(tag).alias("side"))
    counts = side(expected, "e").unionByName(side(actual, "a")).groupBy("bin").agg(
        F.sum(F.when(F.col("side") == "e", 1).otherwise(0)).alias("e"),
        F.sum(F.when(F.col("side") == "a", 1).otherwise(0)).alias("a"))
    # every bin of the edge list appears, also one that holds no row
    spine = small_frame(counts.sparkSession, [
        {"bin": i + 1, "bin_low": a, "bin_high": b} for i, (a, b) in enumerate(zip(edges, edges[1:]))],
        "bin int, bin_low double, bin_high double")
    e, a = F.coalesce("e", F.lit(0)), F.coalesce("a", F.lit(0))
    whole = Window.partitionBy()  # one row per bin, and one for the rows outside
    t = counts.join(spine, "bin", "full").withColumns({"en": F.sum("e").over(whole), "an": F.sum("a").over(whole)})
    t = t.where("bin_low IS NOT NULL")
    if variant == "smoothed":
        pe, pa = e / (F.col("en") + eps) + eps, a / (F.col("an") + eps) + eps
        shown = (pe, pa)
    elif variant == "replace":
        fill = lambda p: F.when(p == 0, eps).otherwise(p)
        pe, pa = fill(e / F.col("en")), fill(a / F.col("an"))
        shown = (pe, pa)
    else:
        pe, pa = e / F.col("en") + eps, a / F.col("an") + eps
        shown = (pe - eps, pa - eps)
    return t.select(
        "bin_low", "bin_high", shown[0].alias("exp_pct"), shown[1].alias("act_pct"), psi_term(pe, pa).alias("psi"),
    ).withColumn("drifting", F.col("psi") > 0.025)


def psi(expected: DataFrame, actual: DataFrame, column: str, **kw) -> DataFrame:
    return psi_detail(expected, actual, column, **kw).agg(F.sum("psi").alias("psi"))


class Baseline:
    """Distribution of the training features: edges, value shares, missing rates."""

    def __init__(self, edges: dict[str, list[float]], shares: DataFrame, missing: dict[str, float], texts: list[str]):
        self.edges, self.shares, self.missing, self.texts = edges, shares, missing, texts


def fit_baseline(df: DataFrame, columns: Sequence[str], bins: int = 10) -> Baseline:
    numbers = [c for c in columns if c in numeric_columns(df)]
    texts = [c for c in columns if c not in numbers]
    edges = quantile_edges(df, numbers, bins) if numbers else {}
    m = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns]).first()
    shares = value_shares(df, texts) if texts else None
    return Baseline(edges, shares, {c: m[c] for c in columns}, texts)


def baseline_table(b: Baseline, spark) -> DataFrame:
    """The numeric baseline as rows (feature, point, value)."""
    rows = [{"feature": f, "point": i, "value": v} for f, e in b.edges.items() for i, v in enumerate(e)]
    return small_frame(spark, rows, "feature string, point int, value double")


def value_shares(df: DataFrame, texts: Sequence[str]) -> DataFrame:
    counts = to_long(df, texts, kind="string").where("value IS NOT NULL").groupBy("feature", "value").agg(
        F.count("*").alias("n"))
    total = counts.groupBy("feature").agg(F.sum("n").alias("t"))
    return counts.join(total, "feature").select("feature", "value", (F.col("n") / F.col("t")).alias("share"))


def numeric_psi(b: Baseline, df: DataFrame, eps: float = 1e-6) -> DataFrame:
    """PSI per numeric feature; the expected share is the same for every surviving bin."""
    binned = df.select(*[left_closed_bin(c, e).alias(c) for c, e in b.edges.items()],
                       *[F.col(c).isNotNull().alias(f"_has_{c}") for c in b.edges])
    parts = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("bin"), F.col(f"_has_{c}").alias("has")) for c in b.edges]
    counts = binned.select(F.inline(F.array(*parts))).where("has").groupBy("feature", "bin").agg(F.count("*").alias("n"))
    counts = counts.withColumn("t", F.sum("n").over(Window.partitionBy("feature")))
    spine = small_frame(df.sparkSession, [
        {"feature": c, "bin": i + 1, "k": len(e) - 1} for c, e in b.edges.items() for i in range(len(e) - 1)],
        "feature string, bin int, k int")
    totals = counts.groupBy("feature").agg(F.max("t").alias("t"))
    t = spine.join(counts.drop("t"), ["feature", "bin"], "left").join(totals, "feature", "left")
    pa = F.coalesce(F.col("n") / F.col("t"), F.lit(0.0)) + eps
    pe = 1 / F.col("k") + eps
    return t.groupBy("feature").agg(F.sum(psi_term(pe, pa)).alias("psi"))


def text_psi(b: Baseline, df: DataFrame, eps: float = 1e-6) -> DataFrame:
    """PSI per text feature over the union of the values; a value missing on one side counts as eps."""
    now = value_shares(df, b.texts).withColumnRenamed("share", "now")
    both = b.shares.join(now, ["feature", "value"], "full")
    e, a = F.coalesce("share", F.lit(eps)), F.coalesce("now", F.lit(eps))
    return both.groupBy("feature").agg(F.sum((a - e) * F.log((a + eps) / (e + eps))).alias("psi"))


def monitor_features(b: Baseline, df: DataFrame, threshold: float = 0.1, report_date: str | None = None) -> DataFrame:
    """PSI and missing-rate change per feature with an alert flag."""
    parts = ([numeric_psi(b, df)] if b.edges else []) + ([text_psi(b, df)] if b.texts else [])
    table = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    m = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in b.missing]).first()
    rates = small_frame(df.sparkSession, [
        {"feature": c, "now": m[c], "change": m[c] - was} for c, was in b.missing.items()],
        "feature string, now double, change double")
    alert = (F.col("psi") > threshold) | (F.abs("change") > 0.1)
    return table.join(rates, "feature").select(
        "feature", F.round("psi", 4).alias("psi"), F.round("now", 4).alias("current_missing_rate"),
        F.round("change", 4).alias("missing_rate_change"), F.when(alert, "ALERT").otherwise("OK").alias("status"),
        F.lit(report_date).alias("report_date"))


def monitor_score(before: DataFrame, now: DataFrame, score: str, cutoff: float = 0.1, alert: float = 0.1) -> DataFrame:
    """Score PSI, shifts of five percentiles and of the pass rate at a fixed cut-off, as one row."""
    points = [0.1, 0.25, 0.5, 0.75, 0.9]
    qb, qn = exact_quantiles(before, [score], points)[score], exact_quantiles(now, [score], points)[score]
    value = psi(before, now, score, variant="shifted").first()["psi"]
    rate = lambda d: d.agg(F.avg((F.col(score) <= cutoff).cast("double")).alias("r")).first()["r"]
    row = {"psi": value, "status": "ALERT" if value > alert else "OK",
           **{f"p{round(p * 100)}_shift": n - o for p, o, n in zip(points, qb, qn)}, "pass_rate_shift": rate(now) - rate(before)}
    return small_frame(before.sparkSession, [row])


def first_payment_alert(df: DataFrame, date: str, bad: str, as_of: str, target: float = 0.02, days: int = 7) -> DataFrame:
    """First-payment default of the last days before ``as_of``, alert above 1.2 times the target."""
    recent = df.where(F.col(date) >= F.date_sub(F.to_date(F.lit(as_of)), days))
    fpd = F.avg(bad)
    return recent.agg(fpd.alias("fpd"), F.coalesce(fpd > target * 1.2, F.lit(False)).alias("alert"))


def advice(psi_value: Column, n_alerts: Column, fpd_alert: Column) -> Column:
    """Advice codes that apply, or 'all_normal'."""
    found = F.array_compact(F.array(
        F.when(psi_value > 0.2, "score_drift_investigate").when(psi_value > 0.1, "score_drift_watch"),
        F.when(n_alerts > 5, "many_feature_alerts_pause_updates"), F.when(fpd_alert, "fpd_above_target_tighten")))
    return F.when(F.size(found) == 0, F.array(F.lit("all_normal"))).otherwise(found)


def daily_report(features: DataFrame, score: DataFrame, business: DataFrame, model: str, version: str, date: str) -> DataFrame:
    """One row that joins the three monitors; each input is itself a small report table."""
    worst = F.slice(F.sort_array(F.collect_list(F.struct("psi", "feature")), asc=False), 1, 5)
    f = features.agg(F.sum(F.when(F.col("status") == "ALERT", 1).otherwise(0)).alias("n_features_alert"),
                     F.array_join(F.transform(worst, lambda x: x["feature"]), ",").alias("top_psi_features"))
    one = F.lit(1).alias("_one")  # every input is a single row
    joined = (
        f.select("*", one).join(score.select(one, F.col("psi").alias("score_psi")), "_one")
        .join(business.select(one, "fpd", F.col("alert").alias("fpd_alert")), "_one").drop("_one")
    )
    return joined.select(
        F.lit(date).alias("report_date"), F.lit(model).alias("model_name"), F.lit(version).alias("model_version"), "*",
        F.array_join(advice(F.col("score_psi"), F.col("n_features_alert"), F.col("fpd_alert")), ",").alias("recommendation"))


def iteration_triggers(monthly: DataFrame, month_idx: str = "month_idx", ks: str = "ks") -> DataFrame:
    """Months in which KS has fallen three months running and by more than five points in all."""
    w = Window.orderBy(month_idx)  # one row per month: the metric table, not the loans
    lag = lambda k: F.lag(ks, k).over(w)
    falling = (F.col(ks) < lag(1)) & (lag(1) < lag(2)) & (lag(2) < lag(3))
    return monthly.withColumn("ks_trigger", F.coalesce(falling & (lag(3) - F.col(ks) > 0.05), F.lit(False)))


def weekly_fpd_trigger(weekly: DataFrame, week: str = "week", rate: str = "fpd", target: float = 0.02, run: int = 4):
    """Weeks that end a run of ``run`` weeks above 1.5 times the target."""
    w = Window.orderBy(week)  # one row per week
    above = F.col(rate) > target * 1.5
    t = weekly.withColumn("above", above).withColumn("_rn", F.row_number().over(w))
    t = t.withColumn("_island", F.col("_rn") - F.row_number().over(Window.partitionBy("above").orderBy(week)))
    streak = F.row_number().over(Window.partitionBy("above", "_island").orderBy(week))
    t = t.withColumn("streak", F.when(F.col("above"), streak).otherwise(0))
    return t.withColumn("fpd_trigger", F.col("streak") >= run).drop("_rn", "_island", "above")
