"""Samples, splits, folds and class weights, all decided row by row from the key's hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from loanloom.functions.hashing import fold_of, hash_unit
from loanloom.operators.ordering import exact_quantiles


def modelling_sample(df: DataFrame, min_age: int) -> DataFrame:
    """Mature loans without policy extension and without very early write-off."""
    early = F.coalesce(F.col("is_written_off").cast("boolean") & (F.col("dpd_at_writeoff") < 30), F.lit(False))
    return df.where((F.col("loan_age") >= min_age) & (F.col("is_policy_extension") == 0) & ~early)


def three_way_label(worst_overdue: Column, bad_from: int = 2) -> Column:
    """1 bad, 0 never overdue, NULL in between."""
    return F.when(worst_overdue >= bad_from, 1).when(worst_overdue == 0, 0)


def random_split(df: DataFrame, key: str, val_ratio: float = 0.2, label: str | None = None, seed: int = 42):
    """Train and validation part by hash threshold; the ratio holds in expectation within every label."""
    salt = F.concat_ws("|", F.col(key).cast("string"), F.col(label).cast("string")) if label else F.col(key)
    draw = hash_unit(salt, seed)
    return df.where(draw >= val_ratio), df.where(draw < val_ratio)


def year_split(df: DataFrame, year: str, val_years: int | Sequence[int]):
    """Validation = rows of the given years; rows without a year train."""
    years = [val_years] if isinstance(val_years, int) else list(val_years)
    held = F.coalesce(F.col(year).isin(years), F.lit(False))
    return df.where(~held), df.where(held)


def with_fold(df: DataFrame, key: str, folds: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    return df.withColumn(name, fold_of(key, folds, seed))


def with_time_fold(df: DataFrame, date: str, folds: int = 5, name: str = "time_fold") -> DataFrame:
    """Equal-count time blocks 0..folds. Split i trains on blocks < i + 1 and validates on block i + 1."""
    days = F.datediff(F.col(date), F.to_date(F.lit("1970-01-01")))
    probs = [i / (folds + 1) for i in range(1, folds + 1)]
    cuts = exact_quantiles(df.select(days.alias("d")), ["d"], probs)["d"] or []
    block = sum((F.when(days > F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0))
    return df.withColumn(name, block)


def expanding_splits(df: DataFrame, folds: int = 5, name: str = "time_fold"):
    for i in range(folds):
        yield df.where(F.col(name) <= i), df.where(F.col(name) == i + 1)


def under_sample(df: DataFrame, label: str, key: str, ratio: float = 10, seed: int = 42) -> DataFrame:
    """All bad rows and, in expectation, ``ratio`` good rows per bad one."""
    counts = df.agg(F.sum(label).alias("bad"), F.sum(1 - F.col(label)).alias("good")).first()
    keep = min(1.0, ratio * (counts["bad"] or 0) / (counts["good"] or 1))
    return df.where((F.col(label) == 1) | (hash_unit(key, seed) < keep))


def with_class_weight(df: DataFrame, label: str, mode: str | dict = "balanced", name: str = "weight") -> DataFrame:
    """'balanced' = n / (2 n_c); 'positive' = good/bad ratio on the bad; or a {label: weight} mapping."""
    if isinstance(mode, dict):
        return df.withColumn(name, F.when(F.col(label) == 1, float(mode[1])).otherwise(float(mode[0])))
    c = df.agg(F.sum(label).alias("bad"), F.sum(1 - F.col(label)).alias("good")).first()
    bad, good = float(c["bad"]), float(c["good"])
    if mode == "balanced":
        w1, w0 = (bad + good) / (2 * bad), (bad + good) / (2 * good)
    else:
        w1, w0 = good / bad, 1.0
    return df.withColumn(name, F.when(F.col(label) == 1, w1).otherwise(w0))
