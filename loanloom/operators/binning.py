"""Binning, weight of evidence and information value."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from loanloom.functions.features import score_scale
from loanloom.operators.ordering import double_array, exact_quantiles
from loanloom.operators.profiling import equal_width_edges, small_frame
from loanloom.session import cut_lineage

MISSING = "Missing"


def quantile_edges(df: DataFrame, columns: Sequence[str], bins: int = 10) -> dict[str, list[float]]:
    """Distinct linear percentiles per column."""
    q = exact_quantiles(df, columns, [i / bins for i in range(bins + 1)])
    return {c: sorted(set(v)) if v else [] for c, v in q.items()}


def right_closed_bin(column: str | Column, edges: Sequence[float]) -> Column:
    """1-based bin over (e[i], e[i+1]]; the first bin holds its lower edge, the outer bins are open."""
    c = F.col(column) if isinstance(column, str) else column
    above = sum((F.when(c > F.lit(e), 1).otherwise(0) for e in edges[1:-1]), F.lit(1))
    return F.when(c.isNotNull(), above)


def left_closed_bin(column: str | Column, edges: Sequence[float], open_ends: bool = False) -> Column:
    """1-based bin over [e[i], e[i+1]), last one closed; NULL outside unless the ends are open."""
    c = F.col(column) if isinstance(column, str) else column
    at = sum((F.when(c >= F.lit(e), 1).otherwise(0) for e in edges[1:-1]), F.lit(1))
    inside = c.isNotNull() if open_ends else (c >= F.lit(edges[0])) & (c <= F.lit(edges[-1]))
    return F.when(inside, at)


@dataclass
class WoeModel:
    """Edges of the numeric features and one table (feature, bin, n, bad, good, woe, iv)."""

    edges: dict[str, list[float]]
    categories: list[str]
    table: DataFrame
    features: list[str] = field(default_factory=list)

    def __post_init__(self):
        self.features = [*self.edges, *self.categories]

    def bin_of(self, feature: str) -> Column:
        if feature in self.edges:
            return F.coalesce(right_closed_bin(feature, self.edges[feature]).cast("string"), F.lit(MISSING))
        return F.coalesce(F.col(feature).cast("string"), F.lit(MISSING))


def bin_counts(df: DataFrame, model_bins: dict[str, Column], label: str) -> DataFrame:
    """Good and bad counts per (feature, bin). Rows expand per feature, counts combine before the shuffle."""
    binned = df.select(label, *[c.alias(f) for f, c in model_bins.items()])
    long = binned.unpivot([label], list(model_bins), "feature", "bin")
    return long.groupBy("feature", "bin").agg(
        F.count("*").alias("n"), F.sum(label).alias("bad"), F.sum(1 - F.col(label)).alias("good")
    )


def woe_columns(counts: DataFrame, smooth: float = 0.5, zero_fix: str = "smooth") -> DataFrame:
    """WOE = ln(bad share / good share) and its IV term per bin.

    'smooth' adds ``smooth`` to both counts and divides by the unsmoothed totals; 'half' replaces only
    zero counts by 0.5 and takes the totals afterwards.
    """
    per = Window.partitionBy("feature")
    if zero_fix == "smooth":
        b, g = F.col("bad") + F.lit(smooth), F.col("good") + F.lit(smooth)
        tb, tg = F.sum("bad").over(per), F.sum("good").over(per)
    else:
        b = F.when(F.col("bad") == 0, 0.5).otherwise(F.col("bad"))
        g = F.when(F.col("good") == 0, 0.5).otherwise(F.col("good"))
        tb, tg = F.sum(b).over(per), F.sum(g).over(per)
    pb, pg = b / tb, g / tg
    return counts.withColumn("woe", F.log(pb / pg)).withColumn("iv", (pb - pg) * F.col("woe"))


def fit_woe(
    df: DataFrame, numeric: Sequence[str], categories: Sequence[str], label: str, bins: int = 10,
    smooth: float = 0.5, zero_fix: str = "smooth", keep_missing: bool = True,
) -> WoeModel:
    """Equal-frequency bins for numbers, one bin per category, missing as a bin of its own."""
    edges = quantile_edges(df, numeric, bins) if numeric else {}
    model = WoeModel(edges, list(categories), None)
    counts = bin_counts(df, {f: model.bin_of(f) for f in model.features}, label)
    if not keep_missing:
        counts = counts.where(F.col("bin") != MISSING)
    model.table = woe_columns(counts, smooth, zero_fix)
    return model


def fit_monotone_woe(
    df: DataFrame, numeric: Sequence[str], categories: Sequence[str], label: str, prebins: int = 20,
    min_share: float = 0.05, trend: str = "auto", smooth: float = 0.5, max_bins: int | None = None,
) -> WoeModel:
    """Pre-bins merged to the bins of highest information value under a monotone WOE.

    Every bin holds at least ``min_share`` of the rows with a value, there are at most ``max_bins``, and the WOE only rises
    ('increasing'), only falls ('decreasing'), whichever gives more ('auto'), or is free ('none'). One pass counts the pre-bins of
    all features; each feature's counts, at most ``prebins`` rows, are one group of ``optimal_bins``. The final table
    sums the same counts, so the data is read twice in all: for the quantiles and for the counts.
    """
    first = fit_woe(df, numeric, categories, label, prebins, smooth)
    counts = cut_lineage(first.table.select("feature", "bin", "n", "bad", "good"))
    per = Window.partitionBy("feature")
    ordered = counts.where(F.col("feature").isin(list(numeric))).withColumns({"bads": F.sum("bad").over(per), "goods": F.sum("good").over(per)})
    merged = (
        ordered.where(F.col("bin") != MISSING).withColumn("bin", F.col("bin").cast("int")).groupBy("feature")
        .applyInPandas(lambda p: optimal_bins(p, min_share, trend, smooth, max_bins), "feature string, bin int, merged int")
    )
    merged = cut_lineage(merged)  # at most prebins rows per feature
    last = merged.groupBy("feature", "merged").agg(F.max("bin").alias("last")).collect()
    edges = {}
    for f in numeric:
        e = first.edges[f]
        keep = sorted(r["last"] for r in last if r["feature"] == f)
        edges[f] = [e[0], *[e[b] for b in keep[:-1]], e[-1]] if e else []
    model = WoeModel(edges, list(categories), None)
    names = merged.select(F.col("feature").alias("_f"), F.col("bin").cast("string").alias("_b"), F.col("merged").cast("string").alias("_m"))
    summed = counts.join(names, (F.col("feature") == F.col("_f")) & (F.col("bin") == F.col("_b")), "left").groupBy(
        "feature", F.coalesce("_m", "bin").alias("bin")).agg(*[F.sum(c).alias(c) for c in ("n", "bad", "good")])
    model.table = woe_columns(summed, smooth)
    return model


def optimal_bins(counts: pd.DataFrame, min_share: float, trend: str, smooth: float = 0.5, max_bins: int | None = None) -> pd.DataFrame:
    """(feature, bin, merged): the merged bin (from 1) of each pre-bin of one feature, by dynamic programming.

    ``counts`` has bin, n, bad, good and the feature's totals bads and goods. best[k][i][j] is the highest information value of k
    merged bins over the first j pre-bins whose last one is i..j; a bin i..j may follow h..i if their WOEs are in
    order, which fractions decide exactly. Prefix sums give every bin's counts. Of equal values, fewer bins win. Where no split
    satisfies the bounds, all pre-bins are one.
    """
    p = counts.sort_values("bin")
    m = len(p)
    sums = {c: np.concatenate([[0], np.cumsum(p[c].to_numpy(dtype="int64"))]) for c in ("n", "bad", "good")}
    n, bad, good = (sums[c][None, :] - sums[c][:, None] for c in ("n", "bad", "good"))  # [i, j]: pre-bins i..j-1
    fits = np.triu(np.ones((m + 1, m + 1), bool), 1) & (n >= min_share * sums["n"][-1])
    with np.errstate(divide="ignore", invalid="ignore"):
        pb, pg = (bad + smooth) / float(p["bads"].iloc[0]), (good + smooth) / float(p["goods"].iloc[0])
        iv = np.where(fits, (pb - pg) * np.log(pb / pg), -np.inf)
    iv = np.where(np.isnan(iv), -np.inf, iv)
    # WOEs compare as exact fractions, however large the counts
    b2, g2 = (c.astype(object) + Fraction(smooth) for c in (bad, good))
    gap = [b2[i][None, :] * g2[:, i][:, None] - b2[:, i][:, None] * g2[i][None, :] for i in range(m)]  # [h, j] of bins h..i and i..j
    best_value, best_cuts = -np.inf, [0, m]
    for sign in {"increasing": (1,), "decreasing": (-1,), "auto": (1, -1), "none": (0,)}[trend]:
        follows = [(sign * g >= 0).astype(bool) for g in gap]
        value = np.where(np.arange(m + 1)[:, None] == 0, iv, -np.inf)  # a first bin starts at 0
        came: list[np.ndarray] = []
        while np.isfinite(value).any():
            if value[:, m].max() > best_value + 1e-12:
                best_value, best_cuts = value[:, m].max(), _unwound(came, int(value[:, m].argmax()), m)
            if len(came) + 1 >= (max_bins or m):
                break
            after, back = np.full_like(value, -np.inf), np.zeros(value.shape, int)
            for i in range(1, m):
                total = np.where(follows[i], value[:, i][:, None], -np.inf) + iv[i][None, :]
                after[i], back[i] = total.max(axis=0), total.argmax(axis=0)
            came.append(back)
            value = after
    merged = np.searchsorted(best_cuts[1:], np.arange(m), side="right") + 1
    return pd.DataFrame({"feature": counts["feature"].iloc[0], "bin": p["bin"].to_numpy(), "merged": merged})


def _unwound(came: list[np.ndarray], start: int, m: int) -> list[int]:
    """Bounds of the merged bins whose last one is start..m."""
    cuts, end = [m, start], m
    for back in reversed(came):
        start, end = int(back[start, end]), start
        cuts.append(start)
    return cuts[::-1]


def apply_woe(df: DataFrame, model: WoeModel, features: Sequence[str] | None = None) -> DataFrame:
    """Adds ``{feature}_woe``; unseen values take the missing bin's WOE, else 0.

    Numeric bins become an indexed literal array. Categories join the table, whose size may grow with
    the data, so the join strategy is left to the planner. The table is written first: its size is known then, and
    a small one does not send the rows to one task per category.
    """
    features = list(features or model.features)
    numeric = [f for f in features if f in model.edges]
    table = cut_lineage(model.table.select("feature", "bin", "woe"))
    small = {(r["feature"], r["bin"]): r["woe"] for r in
             table.where(F.col("feature").isin(numeric) | (F.col("bin") == MISSING)).collect()}
    for f in features:
        absent = float(small.get((f, MISSING), 0.0))
        if f in model.edges:
            k = max(1, len(model.edges[f]) - 1)
            woes = [float(small.get((f, str(i + 1)), absent)) for i in range(k)]
            spot = F.get(double_array(woes), right_closed_bin(f, model.edges[f]) - 1)
            df = df.withColumn(f"{f}_woe", F.coalesce(spot, F.lit(absent)))
        else:
            part = table.where(F.col("feature") == f).select(F.col("bin").alias("_b"), F.col("woe").alias("_w"))
            df = (
                df.join(part, F.coalesce(F.col(f).cast("string"), F.lit(MISSING)) == F.col("_b"), "left")
                .withColumn(f"{f}_woe", F.coalesce("_w", F.lit(absent)))
                .drop("_b", "_w")
            )
    return df


def iv_strength(iv: Column) -> Column:
    return (
        F.when(iv < 0.02, "none").when(iv < 0.10, "weak").when(iv < 0.30, "medium").when(iv < 0.50, "strong")
        .otherwise("suspicious")
    )


def iv_summary(table: DataFrame) -> DataFrame:
    iv = table.groupBy("feature").agg(F.sum("iv").alias("iv"))
    return iv.withColumn("strength", iv_strength(F.col("iv"))).orderBy(F.desc("iv"), "feature")


def binning_table(model: WoeModel, feature: str) -> DataFrame:
    """Bins of one feature with their value range."""
    e = model.edges.get(feature)
    t = model.table.where(F.col("feature") == feature)
    if not e:
        return t
    spot = F.col("bin").try_cast("int")
    return t.withColumns({"lower": F.get(double_array(e), spot - 1), "upper": F.get(double_array(e), spot)})


def iv_filter(summary: DataFrame, threshold: float = 0.02) -> DataFrame:
    return summary.where(F.col("iv") >= threshold)


def card_table(
    table: DataFrame, coefficients: dict[str, float], intercept: float,
    base_score: float = 600, base_odds: float = 1 / 50, pdo: float = 20,
) -> DataFrame:
    """Points per bin; offset and intercept are spread evenly over the features."""
    a, b = score_scale(base_score, base_odds, pdo)
    n = len(coefficients)
    coef = small_frame(
        table.sparkSession, [{"feature": f, "coef": float(v)} for f, v in coefficients.items()], "feature string, coef double"
    )
    raw = F.lit(a / n) - F.lit(b) * (F.col("coef") * F.col("woe") + F.lit(intercept / n))
    return table.join(F.broadcast(coef), "feature").select(  # one row per model feature
        "feature", "bin", F.round("woe", 4).alias("woe"), F.rint(raw).cast("int").alias("points")
    )


def score_distribution(df: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """Equal-width score bands: count, bad, cumulative share, bad rate."""
    edges = equal_width_edges(df, score, bins)
    bands = df.groupBy(right_closed_bin(score, edges).alias("band")).agg(
        F.count("*").alias("count"), F.sum(label).alias("bad")
    )
    upto = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    share = F.sum("count").over(upto) / F.sum("count").over(Window.partitionBy())
    return bands.withColumn("pass_cum", share).withColumn("bad_rate", F.col("bad") / F.col("count"))


def save_woe(model: WoeModel, path: str) -> None:
    """Two parquet folders: the bin table and the edges."""
    spark = model.table.sparkSession
    model.table.write.mode("overwrite").parquet(f"{path}/bins")
    rows = [{"feature": f, "edges": e, "numeric": True} for f, e in model.edges.items()]
    rows += [{"feature": f, "edges": [], "numeric": False} for f in model.categories]
    small_frame(spark, rows, "feature string, edges array<double>, numeric boolean").coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/edges")


def load_woe(spark, path: str) -> WoeModel:
    rows = spark.read.parquet(f"{path}/edges").collect()
    return WoeModel({r["feature"]: list(r["edges"]) for r in rows if r["numeric"]},
                    [r["feature"] for r in rows if not r["numeric"]], spark.read.parquet(f"{path}/bins"))
