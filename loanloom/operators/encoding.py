"""Target (mean) encoding with smoothing; out-of-fold values come from totals minus the fold's own totals."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from loanloom.operators.ordering import join_null_safe


@dataclass
class TargetMeans:
    """Encoding table (column, value, encoded), the overall mean and the encoded columns."""

    table: DataFrame
    overall: float
    columns: list[str]


def smoothed_mean(total: Column, n: Column, overall: Column | float, smoothing: float) -> Column:
    prior = overall if isinstance(overall, Column) else F.lit(overall)
    return (total + F.lit(smoothing) * prior) / (n + F.lit(smoothing))


def fit_target_means(df: DataFrame, columns: Sequence[str], label: str, smoothing: float = 20.0) -> TargetMeans:
    """One aggregate over all columns at once; each row is expanded to (column, value)."""
    columns = list(columns)
    overall = float(df.agg(F.avg(label).alias("m")).first()["m"])
    long = df.select(label, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [label], columns, "column", "value"
    )
    stats = long.where("value IS NOT NULL").groupBy("column", "value").agg(
        F.sum(label).alias("bad"), F.count("*").alias("n")
    )
    encoded = smoothed_mean(F.col("bad"), F.col("n"), overall, smoothing)
    return TargetMeans(stats.select("column", "value", encoded.alias("encoded")), overall, columns)


def apply_target_means(df: DataFrame, model: TargetMeans) -> DataFrame:
    """Adds ``{column}_te``; unseen values get the overall mean."""
    for c in model.columns:
        part = model.table.where(F.col("column") == c).select(F.col("value").alias("_v"), F.col("encoded").alias("_e"))
        df = (
            df.join(part, F.col(c).cast("string") == F.col("_v"), "left")
            .withColumn(f"{c}_te", F.coalesce("_e", F.lit(model.overall)))
            .drop("_v", "_e")
        )
    return df


def out_of_fold_means(
    df: DataFrame, columns: Sequence[str], label: str, fold: str, smoothing: float = 20.0, fold_prior: bool = False
) -> DataFrame:
    """Adds ``{column}_te`` computed from the other folds.

    The prior is the mean of all rows, or with ``fold_prior`` the mean of the other folds. Sums over
    the other folds are a window difference on the (value, fold) table, so no fold is scanned twice.
    """
    by_fold = df.groupBy(fold).agg(F.sum(label).alias("b"), F.count("*").alias("n")).collect()
    all_b, all_n = sum(r["b"] for r in by_fold), sum(r["n"] for r in by_fold)
    if fold_prior:
        prior = F.create_map(
            *[F.lit(x) for r in by_fold for x in (r[fold], (all_b - r["b"]) / max(all_n - r["n"], 1))]
        )[F.col(fold)]
    else:
        prior = F.lit(all_b / all_n)
    for c in columns:
        cell = df.where(F.col(c).isNotNull()).groupBy(c, fold).agg(F.sum(label).alias("_b"), F.count("*").alias("_n"))
        whole = cell.groupBy(c).agg(F.sum("_b").alias("_tb"), F.sum("_n").alias("_tn"))
        other = (
            cell.join(whole, c)
            .withColumn("_ob", F.col("_tb") - F.col("_b"))
            .withColumn("_on", F.col("_tn") - F.col("_n"))
            .select(c, fold, "_ob", "_on")
        )
        df = join_null_safe(df, other, [c, fold], "left")
        seen = smoothed_mean(F.col("_ob"), F.col("_on"), prior, smoothing)
        df = df.withColumn(f"{c}_te", F.when(F.col("_on") > 0, seen).otherwise(prior)).drop("_ob", "_on")
    return df
