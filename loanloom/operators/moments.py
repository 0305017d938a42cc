"""Cross products of many columns: correlations and variance inflation of wide tables.

A pair of columns needs sums over the rows in which both have a value. One pass gives them for all pairs: every task multiplies
its batches as matrices (values, squares and masks), and sends one row per pair of columns; the rows are summed by pair. The plan
has the same size for 8 and for 800 columns, and what is shuffled depends on the columns only, not on the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loanloom.operators.profiling import small_frame

#: rows that are multiplied at once
BLOCK_ROWS = 8192
SUMS = ["n", "sa", "sb", "saa", "sbb", "sab"]
SCHEMA = "pa int, pb int, " + ", ".join(f"{s} double" for s in SUMS)


def pair_sums(df: DataFrame, columns: Sequence[str], centre: bool = True) -> DataFrame:
    """(pa, pb, n, sa, sb, saa, sbb, sab) for pa <= pb: count and sums over the rows where both columns have a value.

    With ``centre`` the columns' means are taken off first, which keeps the differences of large sums exact; it costs one small
    aggregate more. A NULL counts as missing, a NaN is a value.
    """
    columns = list(columns)
    wide = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    offset = np.zeros(len(columns))
    if centre and columns:
        means = wide.agg(*[F.avg(c).alias(c) for c in wide.columns]).first()
        offset = np.array([m if m is not None and np.isfinite(m) else 0.0 for m in means])
    k = len(columns)
    upper = np.triu_indices(k)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((5, k, k))
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                here = np.stack([~np.asarray(part.column(i).is_null()) for i in range(k)], axis=1)
                x = np.stack([part.column(i).fill_null(0.0).to_numpy(zero_copy_only=False) for i in range(k)], axis=1)
                x, m = np.where(here, x - offset, 0.0), here.astype(float)
                total[0] += m.T @ m
                total[1] += x.T @ m  # [a, b]: a where b has a value
                total[2] += (x * x).T @ m
                total[3] += x.T @ x
        n, s, ss, c, _ = total
        values = [n[upper], s[upper], s.T[upper], ss[upper], ss.T[upper], c[upper]]
        yield pa.record_batch([pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), *[pa.array(v) for v in values]], ["pa", "pb", *SUMS])

    return wide.mapInArrow(products, SCHEMA).groupBy("pa", "pb").agg(*[F.sum(s).alias(s) for s in SUMS])


def correlations(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(a, b, pa, pb, r) of every feature pair, a earlier than b; r is NULL where one of the two does not vary."""
    features = list(features)
    sums = pair_sums(df, features).where("pa < pb")
    spread = F.sqrt((F.col("n") * F.col("saa") - F.col("sa") ** 2) * (F.col("n") * F.col("sbb") - F.col("sb") ** 2))
    r = F.try_divide(F.col("n") * F.col("sab") - F.col("sa") * F.col("sb"), F.when(spread > 0, spread))
    names = F.expr("array(" + ", ".join(f"'{_quoted(f)}'" for f in features) + ")")
    return sums.select(F.get(names, F.col("pa")).alias("a"), F.get(names, F.col("pb")).alias("b"), "pa", "pb", F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("r"))


def variance_inflation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """VIF per column from the uncentred cross products; the k x k matrix is inverted on the driver."""
    columns = list(columns)
    g = np.zeros((len(columns), len(columns)))
    for r in pair_sums(df, columns, centre=False).collect():
        g[r["pa"], r["pb"]] = g[r["pb"], r["pa"]] = r["sab"]
    scale = np.sqrt(np.where(np.diag(g) > 0, np.diag(g), 1.0))
    vif = np.diag(g) / scale ** 2 * np.diag(np.linalg.pinv(g / np.outer(scale, scale)))
    return small_frame(df.sparkSession, [{"feature": c, "vif": float(v)} for c, v in zip(columns, vif)])


def _quoted(name: str) -> str:
    return name.replace("\\", "\\\\").replace("'", "\\'")
