"""Profiles, group statistics and report tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loanloom.operators.ordering import exact_quantiles

PERCENTILES = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]


def small_frame(spark: SparkSession, rows: list[dict] | pd.DataFrame, schema: str | None = None) -> DataFrame:
    """A model table that already fits the driver, as a local relation."""
    return spark.createDataFrame(rows if isinstance(rows, pd.DataFrame) else pd.DataFrame(rows), schema=schema)


def numeric_columns(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    kinds = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
    return [n for n, t in df.dtypes if t.startswith(kinds) and n not in skip]


def to_long(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), kind: str = "double") -> DataFrame:
    """(keep..., feature, value): the row is expanded in one pass, so many features cost one scan."""
    cast = df.select(*keep, *[F.col(c).cast(kind).alias(c) for c in columns])
    return cast.unpivot(list(keep) or [], list(columns), "feature", "value")


def winsorize(df: DataFrame, column: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    q = exact_quantiles(df, [column], [low, high])[column]
    return df.withColumn(column, F.greatest(F.lit(q[0]), F.least(F.lit(q[1]), F.col(column)))) if q else df


def outlier_bounds(df: DataFrame, columns: Sequence[str], k: float = 3) -> DataFrame:
    """Lower and upper bound per column by IQR, z-score and 1/99 percentile."""
    q = exact_quantiles(df, columns, [0.01, 0.25, 0.75, 0.99])
    moments = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_samp(c).alias(f"s_{c}") for c in columns]
    ).first()
    rows = []
    for c in columns:
        p1, q1, q3, p99 = q[c]
        m, s = moments[f"m_{c}"], moments[f"s_{c}"]
        rows += [
            {"feature": c, "method": "iqr", "lower": q1 - k * (q3 - q1), "upper": q3 + k * (q3 - q1)},
            {"feature": c, "method": "zscore", "lower": m - k * s, "upper": m + k * s},
            {"feature": c, "method": "percentile", "lower": p1, "upper": p99},
        ]
    return small_frame(df.sparkSession, rows)


def flag_outliers(df: DataFrame, bounds: DataFrame, method: str) -> DataFrame:
    """0/1 column ``{feature}_outlier`` for each feature with bounds (a table of one row per feature)."""
    for b in bounds.where(F.col("method") == method).collect():
        c = F.col(b["feature"])
        df = df.withColumn(f"{b['feature']}_outlier", ((c < b["lower"]) | (c > b["upper"])).cast("int"))
    return df


def group_statistics(
    df: DataFrame, groups: Sequence[str], values: Sequence[str], stats: Sequence[str] = ("mean", "std", "min", "max")
) -> DataFrame:
    """Group statistics attached to every row as ``{value}_{stat}_by_{groups}``.

    The table of groups is aggregated before its shuffle; whether it is then broadcast is left to the
    planner, which knows its size at run time.
    """
    make = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "sum": F.sum, "count": F.count}
    tail = "_".join(groups)
    table = df.groupBy(*groups).agg(*[make[s](v).alias(f"{v}_{s}_by_{tail}") for v in values for s in stats])
    return df.join(table, list(groups), "left")


def window_statistics(
    df: DataFrame, key: str, date: str, value: str, months: Sequence[int] = (1, 3, 6), as_of=None
) -> DataFrame:
    """Sum, mean, max, min, count, deviation over the last k months, all windows in one aggregate."""
    as_of = as_of or df.agg(F.max(date).alias("d")).first()["d"]
    end = F.lit(as_of)
    start = {k: F.add_months(end, -k) for k in months}
    recent = df.where(F.col(date) >= start[max(months)])
    aggs = []
    for k in months:
        v = F.when(F.col(date) >= start[k], F.col(value))
        n = F.count(v)
        aggs += [
            F.sum(v).alias(f"{value}_m{k}_sum"), F.avg(v).alias(f"{value}_m{k}_mean"), F.max(v).alias(f"{value}_m{k}_max"),
            F.min(v).alias(f"{value}_m{k}_min"), F.when(n > 0, n.cast("double")).alias(f"{value}_m{k}_count"),
            F.stddev_samp(v).alias(f"{value}_m{k}_std"),
        ]
    return recent.groupBy(key).agg(*aggs)


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """(feature, nunique). Exact counts shuffle the distinct (feature, value) pairs; sketches do not."""
    long = to_long(df, columns, kind="string").where("value IS NOT NULL")
    if approximate:
        return long.groupBy("feature").agg(F.approx_count_distinct("value").alias("nunique"))
    return long.groupBy("feature", "value").agg(F.lit(1)).groupBy("feature").agg(F.count("*").alias("nunique"))


def overview(df: DataFrame, label: str | None = None, approximate: bool = False) -> DataFrame:
    """Type, missing rate, distinct count and correlation with the label, per column, most missing first."""
    spark, kinds = df.sparkSession, dict(df.dtypes)
    numeric = set(numeric_columns(df))
    corr = [c for c in df.columns if label and c in numeric and c != label]
    row = df.agg(
        *[F.avg(F.col(c).isNull().cast("double")).alias(f"m_{c}") for c in df.columns],
        *[F.corr(c, label).alias(f"r_{c}") for c in corr],
    ).first()
    rows = [
        {"feature": c, "dtype": kinds[c], "missing_rate": row[f"m_{c}"],
         "corr_with_target": row[f"r_{c}"] if c in corr else None} for c in df.columns
    ]
    made = small_frame(spark, rows, "feature string, dtype string, missing_rate double, corr_with_target double")
    counts = distinct_counts(df, df.columns, approximate)
    return made.join(counts, "feature", "left").fillna(0, ["nunique"]).orderBy(F.desc("missing_rate"), "feature")


def numeric_profile(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Missing rate, mean, deviation, seven percentiles and correlation with the label per feature."""
    q = exact_quantiles(df, columns, PERCENTILES)
    one = lambda c: [
        F.avg(F.col(c).isNull().cast("double")), F.avg(c), F.stddev_samp(c), F.corr(F.col(c).cast("double"), F.col(label)),
    ]
    names = ["missing_rate", "mean", "std", "corr_with_y"]
    row = df.agg(*[e.alias(f"{n}__{c}") for c in columns for n, e in zip(names, one(c))]).first()
    rows = [
        {"feature": c, **{n: row[f"{n}__{c}"] for n in names},
         **{f"p{round(p * 100)}": v for p, v in zip(PERCENTILES, q[c])}} for c in columns
    ]
    return small_frame(df.sparkSession, rows)


def top_values(df: DataFrame, columns: Sequence[str], k: int = 5) -> DataFrame:
    """The k most frequent values of each text feature with their share; ties by value.

    The rank filter is pushed below the shuffle by the planner, so each task sends k rows per feature.
    """
    from pyspark.sql import Window

    counts = (
        to_long(df, columns, kind="string").where("value IS NOT NULL").groupBy("feature", "value")
        .agg(F.count("*").alias("n"))
    )
    totals = counts.groupBy("feature").agg(F.sum("n").alias("total"))
    rank = F.row_number().over(Window.partitionBy("feature").orderBy(F.desc("n"), "value"))
    ranked = counts.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.join(totals, "feature").select("feature", "rank", "value", (F.col("n") / F.col("total")).alias("share"))


def monthly_target(df: DataFrame, date: str, label: str) -> DataFrame:
    month = F.date_format(date, "yyyy-MM").alias("month")
    return df.groupBy(month).agg(
        F.count(label).alias("total"), F.sum(label).alias("bad"), (F.sum(label) / F.count(label)).alias("bad_rate")
    )


def bad_rate_by_category(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """(dim, value, bad_rate, n) of every column in one aggregate."""
    long = to_long(df, columns, [label], "string").withColumnRenamed("feature", "dim")
    return long.where("value IS NOT NULL").groupBy("dim", "value").agg(
        F.avg(label).alias("bad_rate"), F.count("*").alias("n")
    )


def histogram(df: DataFrame, column: str, bins: int = 50, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Counts of equal-width bins after clipping at two percentiles."""
    q = exact_quantiles(df, [column], [low, high])[column]
    lo, hi = q
    width = (hi - lo) / bins or 1.0
    clipped = F.greatest(F.lit(lo), F.least(F.lit(hi), F.col(column)))
    spot = F.least(F.floor((clipped - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return (
        df.where(F.col(column).isNotNull()).groupBy(spot.alias("bin")).agg(F.count("*").alias("n"))
        .withColumn("lower", F.lit(lo) + F.col("bin") * F.lit(width))
    )


def equal_width_edges(df: DataFrame, column: str, bins: int = 10) -> list[float]:
    r = df.agg(F.min(column).alias("a"), F.max(column).alias("b")).first()
    a, b = float(r["a"]), float(r["b"])
    return [a + (b - a) * i / bins for i in range(bins + 1)]


def vintage(df: DataFrame, cohort: str | Sequence[str], age: str, bad: str) -> DataFrame:
    """Long form: cohort, age, mean bad, observations."""
    keys = [cohort] if isinstance(cohort, str) else list(cohort)
    return df.groupBy(*keys, age).agg(F.avg(bad).alias("bad_rate"), F.count("*").alias("n"))


def vintage_matrix(long: DataFrame, cohort: str | Sequence[str], age: str, ages: Sequence[int] | None = None) -> DataFrame:
    """One column per age of the long form (or per age of ``ages``)."""
    keys = [cohort] if isinstance(cohort, str) else list(cohort)
    return long.groupBy(*keys).pivot(age, list(ages) if ages is not None else None).agg(F.first("bad_rate"))


def matrix_cells(cells: DataFrame, row: str, column: str, value: str) -> DataFrame:
    """(row, cells): per row value one array of (column, value) structs, an entry for every column value there is.

    The matrix form whose schema does not depend on the data: the column values are a single array, joined to every row.
    """
    across = cells.agg(F.array_sort(F.collect_set(column)).alias("_all"))
    known = cells.where(F.col(column).isNotNull()).groupBy(row).agg(F.map_from_entries(F.collect_list(F.struct(column, value))).alias("_known"))
    entry = F.transform("_all", lambda c: F.struct(c.alias(column), F.try_element_at("_known", c).alias(value)))
    return known.join(F.broadcast(across)).select(row, entry.alias("cells"))  # a single row


def coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing, coverage and zero rate with the handling band of each feature, least covered first."""
    missing = to_long(df, columns).groupBy("feature").agg(
        F.avg(F.col("value").isNull().cast("double")).alias("missing_rate"),
        F.avg(F.col("value").isNotNull().cast("double")).alias("coverage_rate"),
        F.avg(F.coalesce((F.col("value") == 0).cast("double"), F.lit(0.0))).alias("zero_rate"),
    )
    m, c = F.col("missing_rate"), F.col("coverage_rate")
    return missing.withColumns({
        "missing_action": F.when(m < 0.05, "fill").when(m < 0.3, "flag").when(m < 0.7, "verify").otherwise("drop"),
        "coverage_action": F.when(c < 0.2, "exclude").when(c < 0.5, "caution").otherwise("use"),
    }).orderBy("coverage_rate", "feature")


def asset_quality(df: DataFrame, month: Column, overdue: Column, balance: Column, npl_from: int = 3) -> DataFrame:
    """Monthly NPL and M1+ by balance, first- and second-payment default by count."""
    at_least = lambda k: F.sum(F.when(overdue >= k, balance).otherwise(0.0)) / F.sum(balance)
    return df.groupBy(month.alias("month")).agg(
        at_least(npl_from).alias("npl"), at_least(1).alias("m1_plus"),
        F.avg("is_fpd").alias("fpd"), F.avg("is_spd").alias("spd"), F.count("*").alias("n"),
    )


def arm_metrics(df: DataFrame, arm: str = "ab_group") -> DataFrame:
    return df.groupBy(arm).agg(
        F.count("*").alias("n_applications"), F.avg("is_approved").alias("pass_rate"),
        F.avg("risk_score").alias("avg_score"), F.avg("is_fpd").alias("fpd_rate"),
    )


def pooled_t_test(df: DataFrame, arm: str, value: str, control: str = "control", treatment: str = "treatment"):
    """Two-sample t statistic with pooled variance and its two-sided p-value, from two aggregated rows."""
    got = {
        r[arm]: r for r in df.groupBy(arm).agg(
            F.count(value).alias("n"), F.avg(value).alias("m"), F.var_samp(value).alias("v")).collect()
    }
    a, b = got[control], got[treatment]
    free = a["n"] + b["n"] - 2
    pooled = ((a["n"] - 1) * a["v"] + (b["n"] - 1) * b["v"]) / free
    t = (a["m"] - b["m"]) / math.sqrt(pooled * (1 / a["n"] + 1 / b["n"]))
    return small_frame(df.sparkSession, [{"t_stat": t, "p_value": student_two_sided(t, free)}])


#: points of the tail integral
TAIL_POINTS = 20000


def student_two_sided(t: float, free: float) -> float:
    """Two-sided tail of Student's t. The tail itself is integrated, over x = |t| + u / (1 - u) at the middles of equal steps of u,
    so that small probabilities keep their digits."""
    u = (np.arange(TAIL_POINTS) + 0.5) / TAIL_POINTS
    x = abs(t) + u / (1 - u)
    log_c = math.lgamma((free + 1) / 2) - math.lgamma(free / 2) - 0.5 * math.log(free * math.pi)
    density = np.exp(log_c - (free + 1) / 2 * np.log1p(x * x / free))
    return min(1.0, 2 * float((density / (1 - u) ** 2).sum()) / TAIL_POINTS)


def strategy_effect(df: DataFrame, period: str = "period") -> DataFrame:
    """Pass, automatic, manual and reject rates, mean limit and rate of the approved, per period."""
    share = lambda d: F.avg((F.col("decision") == d).cast("double"))
    approved = lambda c: F.avg(F.when(F.col("is_approved") == 1, F.col(c)))
    return df.groupBy(period).agg(
        F.avg(F.col("is_approved").cast("double")).alias("pass_rate"), share("APPROVE").alias("auto_approve_rate"),
        share("MANUAL_REVIEW").alias("manual_rate"), share("REJECT").alias("reject_rate"),
        approved("credit_limit").alias("avg_credit_limit"), approved("interest_rate").alias("avg_interest_rate"),
    )


def compare_periods(before: DataFrame, after: DataFrame) -> DataFrame:
    both = before.withColumn("period", F.lit("before")).unionByName(after.withColumn("period", F.lit("after")))
    return strategy_effect(both)


def recovery_labels(df: DataFrame) -> DataFrame:
    """Four outcome labels of a collection case."""
    owed = F.when(F.col("overdue_amount") == 0, F.lit(1.0)).otherwise(F.col("overdue_amount"))
    return df.withColumns({
        "has_payment": (F.col("collected_amount") > 0).cast("int"),
        "fully_paid": (F.col("collected_amount") >= F.col("overdue_amount")).cast("int"),
        "recovery_rate": F.col("collected_amount") / owed,
        "paid_within_30d": F.coalesce((F.datediff("payment_date", "due_date") <= 30).cast("int"), F.lit(0)),
    })


def leakage_screen(df: DataFrame, columns: Sequence[str], label: str, threshold: float = 0.9) -> DataFrame:
    """Features whose absolute correlation with the label exceeds the threshold."""
    row = df.agg(*[F.corr(F.col(c).cast("double"), F.col(label)).alias(c) for c in columns]).first()
    rows = [{"feature": c, "corr": row[c]} for c in columns]
    return small_frame(df.sparkSession, rows, "feature string, corr double").where(F.abs("corr") > threshold)


def feature_consistency(offline: DataFrame, online: DataFrame, key: str, columns: Sequence[str], tol: float = 1e-6):
    """Offline against online values of the same rows, per feature.

    Numbers: largest and mean absolute error and the share above the tolerance. Text: share unequal,
    where two missing values count as equal.
    """
    kinds = dict(offline.dtypes)
    numbers = [c for c in columns if c in set(numeric_columns(offline))]
    right = online.select(key, *[F.col(c).alias(f"_o_{c}") for c in columns])
    both = offline.select(key, *columns).join(right, key)
    errs = []
    for c in columns:
        if c in numbers:
            e = F.abs(F.col(c).cast("double") - F.col(f"_o_{c}").cast("double"))
            errs.append(F.struct(F.lit(c).alias("feature"), e.alias("err"), F.coalesce(e > tol, F.lit(False)).alias("bad"),
                                 F.lit(True).alias("number")))
        else:
            bad = ~F.col(c).eqNullSafe(F.col(f"_o_{c}"))
            errs.append(F.struct(F.lit(c).alias("feature"), F.lit(None).cast("double").alias("err"), bad.alias("bad"),
                                 F.lit(False).alias("number")))
    long = both.select(F.inline(F.array(*errs)))
    agg = long.groupBy("feature", "number").agg(
        F.max("err").alias("max_abs_error"), F.avg("err").alias("mean_abs_error"),
        F.avg(F.col("bad").cast("double")).alias("mismatch_rate"),
    )
    ok = F.when(F.col("number"), F.col("max_abs_error") < tol).otherwise(F.col("mismatch_rate") == 0)
    return agg.withColumn("status", F.when(ok, "OK").otherwise("MISMATCH")).drop("number")
