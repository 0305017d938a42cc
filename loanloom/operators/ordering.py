"""Global order without a single sorting task.

A window without PARTITION BY sends every row to one task. Everything here that needs a global (or
per-group) order cuts the value range into slices first. The cut points are values of a quantile
sketch, so an open slice holds about rows/slices rows, and a value frequent enough to fill a slice is
itself a cut point with a slice of its own, where rows are either merged (``prefix_sums``) or spread
over sub-slices by a hash of the key (``row_positions``). Cut points only balance the work; results do
not depend on them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from loanloom.functions.hashing import tie_key
from loanloom.session import parallelism

SUB_SLICES = 64
REFINE_ROW_LIMIT = 200_000


def double_array(values: Sequence[float]) -> Column:
    """Array literal of doubles, parsed as one expression."""
    return F.expr("array(" + ",".join(f"{float(v)!r}D" for v in values) + ")")


def plan_cuts_of(df: DataFrame, columns: Sequence[str], slices: int | None = None) -> dict[str, list[float]]:
    """Cut points per column from mergeable sketches, in one pass; at most ``slices`` numbers per column
    reach the driver."""
    slices = slices or min(1024, max(8, 2 * parallelism(df.sparkSession)))
    probs = double_array([i / slices for i in range(1, slices)])
    row = df.agg(
        *[F.percentile_approx(F.col(c).cast("double"), probs, 10 * slices).alias(f"q{i}") for i, c in enumerate(columns)]
    ).first()
    return {c: sorted({float(v) for v in (row[f"q{i}"] or []) if math.isfinite(v)}) for i, c in enumerate(columns)}


def plan_cuts(df: DataFrame, order: str, slices: int | None = None) -> list[float]:
    return plan_cuts_of(df, [order], slices)[order]


def uniform_cuts(spark) -> list[float]:
    """Cut points for a hash that is even over [0, 1): no sketch has to look for them."""
    slices = min(1024, max(8, 2 * parallelism(spark)))
    return [i / slices for i in range(1, slices)]


def with_slice(df: DataFrame, order: str, cuts: Sequence[float], name: str = "_slice") -> DataFrame:
    """Odd slices are single cut values, even slices the open ranges between them."""
    cuts = list(cuts)
    value = F.col(order).cast("double")
    if not cuts:
        return df.withColumn(name, F.lit(0))
    if len(cuts) <= 32:
        below = sum((F.when(value >= F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0))
        df = df.withColumn(name, below)
    else:
        splits = [float("-inf"), *cuts, float("inf")]
        raw, pos = f"{name}_v", f"{name}_b"
        df = (
            Bucketizer(splits=splits, inputCol=raw, outputCol=pos, handleInvalid="keep")
            .transform(df.withColumn(raw, value))
            .withColumn(name, F.col(pos).cast("int"))
            .drop(raw, pos)
        )
    at_cut = F.coalesce(F.get(double_array(cuts), F.col(name) - 1) == value, F.lit(False))
    return df.withColumn(name, 2 * F.col(name) - F.when(at_cut, 1).otherwise(0))


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a NULL key matches a NULL key."""
    other = right
    for k in keys:
        other = other.withColumnRenamed(k, f"_r_{k}")
    cond = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(other, cond, how).drop(*[f"_r_{k}" for k in keys])


def _with_offsets(part: DataFrame, totals: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Attach the offsets and a column ``_part`` that both the join and the window after it cluster on.

    Fields of a struct compare equal when both are NULL, so NULL groups stay whole, and join and window
    share one shuffle. Without groups the offsets are one row per slice, a number fixed by the plan.
    """
    key = F.struct(*keys).alias("_part")
    left, right = part.select("*", key), totals.select(key, *[c for c in totals.columns if c not in keys])
    return left.join(right if by else F.broadcast(right), "_part")


def prefix_sums(
    df: DataFrame,
    order: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """One row per (by, order value): its sums, what lies before it, and the group totals. The order
    column is a number.

    Columns added per summed column ``s``: ``before_s`` (strictly before), ``total_s``.
    Rows without an order value are left out.
    """
    by, sums = list(by), list(sums)
    df = df.where(F.col(order).isNotNull())
    cuts = plan_cuts(df, order) if cuts is None else cuts
    hist = (
        with_slice(df.select(*by, order, *sums), order, cuts)
        .groupBy(*by, "_slice", order)
        .agg(*[F.sum(s).alias(s) for s in sums])
    )
    direction = F.desc if descending else F.asc
    totals = hist.groupBy(*by, "_slice").agg(*[F.sum(s).alias(s) for s in sums])
    across = Window.partitionBy(*by).orderBy(direction("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    totals = totals.select(
        *by,
        "_slice",
        *[F.coalesce(F.sum(s).over(across), F.lit(0)).alias(f"off_{s}") for s in sums],
        *[F.sum(s).over(whole).alias(f"total_{s}") for s in sums],
    )
    inside = Window.partitionBy("_part").orderBy(direction(order)).rowsBetween(Window.unboundedPreceding, -1)
    return _with_offsets(hist, totals, [*by, "_slice"], by).select(
        *by,
        order,
        *sums,
        *[(F.coalesce(F.sum(s).over(inside), F.lit(0)) + F.col(f"off_{s}")).alias(f"before_{s}") for s in sums],
        *[f"total_{s}" for s in sums],
    )


def _spread_rows(df: DataFrame, order: str, key: str, cuts: Sequence[float]) -> DataFrame:
    """Rows with slice, tie key, and a sub-slice by the tie key inside single-value slices."""
    rows = with_slice(df, order, cuts).withColumn("_tie", tie_key(key))
    first_byte = F.conv(F.substring("_tie", 1, 2), 16, 10).cast("int")
    sub = F.when(F.col("_slice") % 2 == 1, F.floor(first_byte * SUB_SLICES / 256)).otherwise(0)
    return rows.withColumn("_sub", sub.cast("int"))


def row_positions(
    df: DataFrame,
    order: str,
    key: str,
    by: Sequence[str] = (),
    descending: bool = True,
    sums: Sequence[str] = (),
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Adds ``pos`` (1-based position by order value, ties by md5 of the key) and ``total`` rows.

    For each column in ``sums`` the running sum up to and including the row is added as ``cum_s``.
    """
    by = list(by)
    df = df.where(F.col(order).isNotNull())
    cuts = plan_cuts(df, order) if cuts is None else cuts
    rows = _spread_rows(df, order, key, cuts)
    direction = F.desc if descending else F.asc
    part = [*by, "_slice", "_sub"]
    parts = rows.groupBy(*part).agg(F.count("*").alias("_n"), *[F.sum(s).alias(f"_t_{s}") for s in sums])
    across = (
        Window.partitionBy(*by).orderBy(direction("_slice"), "_sub").rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = parts.select(
        *part,
        F.coalesce(F.sum("_n").over(across), F.lit(0)).alias("_off"),
        F.sum("_n").over(Window.partitionBy(*by)).alias("total"),
        *[F.coalesce(F.sum(f"_t_{s}").over(across), F.lit(0)).alias(f"_off_{s}") for s in sums],
    )
    inside = Window.partitionBy("_part").orderBy(direction(order), "_tie")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = _with_offsets(rows, totals, part, by).withColumn("pos", F.row_number().over(inside) + F.col("_off"))
    for s in sums:
        out = out.withColumn(f"cum_{s}", F.coalesce(F.sum(s).over(running), F.lit(0)) + F.col(f"_off_{s}"))
    return out.drop("_part", "_slice", "_sub", "_off", "_tie", *[f"_off_{s}" for s in sums])


def average_ranks(df: DataFrame, orders: Sequence[str], key: str, names: Sequence[str]) -> DataFrame:
    """Adds, per order column, the ascending rank with ties averaged, as a share of the ranked rows. A null has a null rank.

    All columns share one pass: rows become (model, value) counts, one grouped prefix sum ranks the distinct values, and the
    ranks come back by one join on (model, value) and one on the row. The plan grows by a few expressions per column. Rows are told apart
    by ``key`` and their values, so a repeated key is no problem.
    """
    orders, names = list(orders), list(names)
    cells = F.inline(F.array(*[F.struct(F.lit(i).alias("_model"), F.col(o).cast("double").alias("_value")) for i, o in enumerate(orders)]))
    counted = df.select(cells).where("_value IS NOT NULL").withColumn("_n", F.lit(1).cast("long"))
    sums = prefix_sums(counted, "_value", ["_n"], ["_model"])
    rank = (F.col("before__n") + (F.col("_n") + 1) / 2) / F.col("total__n")
    ranks = sums.select(F.col("_model").alias("_m"), F.col("_value").alias("_v"), rank.alias("_rank"))
    own = {c: f"_own_{c}" for c in dict.fromkeys([key, *orders])}
    long = df.select(*[F.col(c).alias(o) for c, o in own.items()], cells).distinct()
    found = long.join(ranks, (F.col("_model") == F.col("_m")) & (F.col("_value") == F.col("_v")), "left")
    wide = found.groupBy(*own.values()).agg(*[F.max(F.when(F.col("_model") == i, F.col("_rank"))).alias(n) for i, n in enumerate(names)])
    same = [df[c].eqNullSafe(wide[o]) for c, o in own.items()]
    return df.join(wide, same, "left").drop(*own.values())


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    refine_limit: int | None = None,
    slices: int = 512,
) -> dict[str, list[float] | None]:
    """Exact linear-interpolated quantiles of many columns.

    The value range is narrowed around each wanted rank by counting rows per slice, a job whose shuffle
    holds only counts, until so few rows are left around the ranks that they can be ordered; only those
    are shuffled. Every size takes this path. values are counted first, as the lowest and highest ranks.
    """
    refine_limit = REFINE_ROW_LIMIT if refine_limit is None else refine_limit
    columns, probs = list(columns), list(probs)
    wide = df.select(*[_clean_double(c).alias(c) for c in columns])
    ends = (float("-inf"), float("inf"))
    row = wide.agg(*[f(F.col(f"`{c}`")).alias(f"{name}{i}") for i, c in enumerate(columns) for name, f in (
        ("n", F.count), ("low", lambda v: F.count_if(v == ends[0])), ("high", lambda v: F.count_if(v == ends[1])))]).first()
    counts = {c: row[f"n{i}"] for i, c in enumerate(columns)}
    found: dict[str, dict[int, float]] = {c: {} for c in columns}
    # open value ranges still to be searched: column -> list of (low, high, rows below the range, ranks)
    open_ranges = {}
    for i, c in enumerate(columns):
        n, low, high = counts[c], row[f"low{i}"], row[f"high{i}"]
        wanted = {k for p in probs for k in _ranks(n, p)} if n else set()
        found[c].update({k: ends[0] for k in wanted if k < low} | {k: ends[1] for k in wanted if k >= n - high})
        if rest := sorted(wanted - found[c].keys()):
            open_ranges[c] = [(*ends, low, rest)]
    while open_ranges:
        open_ranges = _narrow(wide, open_ranges, found, slices, refine_limit)
    out: dict[str, list[float] | None] = {}
    for c in columns:
        n = counts[c]
        out[c] = [_between(found[c], n, p) for p in probs] if n else None
    return out


def _clean_double(c: str) -> Column:
    v = F.col(f"`{c}`").cast("double")
    return F.when(~F.isnan(v), v)


def _ranks(n: int, p: float) -> tuple[int, int]:
    spot = (n - 1) * p
    low = int(spot)
    return low, min(low + (spot > low), n - 1)


def _between(values: dict[int, float], n: int, p: float) -> float:
    low, high = _ranks(n, p)
    a, b = values[low], values[high]
    spot = (n - 1) * p
    return a if a == b else (low + 1 - spot) * a + (spot - low) * b


def _narrow(wide, open_ranges, found, slices, refine_limit):
    """One round: sketch the open ranges, count their slices, settle or shrink each wanted rank.

    All columns and ranges share the jobs: one sketch, one count, one ordering of the small rests.
    """
    searched = [(c, r) for c, rs in open_ranges.items() for r in rs]
    probs = double_array([i / slices for i in range(slices + 1)])

    def inside(c, r):
        return F.when((F.col(f"`{c}`") > r[0]) & (F.col(f"`{c}`") < r[1]), F.col(f"`{c}`"))

    sketch = wide.agg(
        *[F.percentile_approx(inside(c, r), probs, 10 * slices).alias(f"q{j}") for j, (c, r) in enumerate(searched)]
    ).first()
    cuts = [sorted({float(v) for v in sketch[f"q{j}"] if math.isfinite(v)}) for j in range(len(searched))]
    sliced = wide.select(*[inside(c, r).alias(f"v{j}") for j, (c, r) in enumerate(searched)])
    for j in range(len(searched)):
        sliced = with_slice(sliced, f"v{j}", cuts[j], f"s{j}")
    long = sliced.select(F.inline(F.array(*[
        F.struct(F.lit(j).alias("j"), F.when(F.col(f"v{j}").isNotNull(), F.col(f"s{j}")).alias("s")) for j in range(len(searched))])))
    counted = long.where("s IS NOT NULL").groupBy("j", "s").agg(F.count("*").alias("n")).collect()
    per_slice = {(row["j"], row["s"]): row["n"] for row in counted}
    still: dict[str, list] = {}
    small: list[tuple] = []
    for j, (c, r) in enumerate(searched):
        below = r[2]
        for s in range(2 * len(cuts[j]) + 1):
            n = per_slice.get((j, s), 0)
            here = [k for k in r[3] if below <= k < below + n]
            if here and s % 2 == 1:
                found[c].update({k: cuts[j][s // 2] for k in here})
            elif here:
                low = cuts[j][s // 2 - 1] if s else r[0]
                high = cuts[j][s // 2] if s // 2 < len(cuts[j]) else r[1]
                if n <= refine_limit:
                    small.append((c, (low, high, below, here)))
                else:
                    still.setdefault(c, []).append((low, high, below, here))
            below += n
    if small:
        _order_rests(wide, small, found, inside)
    return still


def _order_rests(wide, small, found, inside) -> None:
    """Order the rows of the last small ranges (each at most the refine limit) and keep the wanted ranks."""
    long = wide.select(F.inline(F.array(*[
        F.struct(F.lit(j).alias("j"), inside(c, r).alias("v")) for j, (c, r) in enumerate(small)]))).where("v IS NOT NULL")
    counts = long.groupBy("j", "v").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("j").orderBy("v"))
    ranked = counts.select("j", "v", (upto - F.col("n")).alias("lo"), upto.alias("hi"))
    hit = F.lit(False)
    for j, (_, r) in enumerate(small):
        for k in r[3]:
            hit = hit | ((F.col("j") == j) & (F.col("lo") <= k - r[2]) & (F.col("hi") > k - r[2]))
    for row in ranked.where(hit).collect():
        c, r = small[row["j"]]
        found[c].update({k: row["v"] for k in r[3] if row["lo"] <= k - r[2] < row["hi"]})
