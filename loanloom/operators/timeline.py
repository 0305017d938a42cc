"""Point-in-time joins and trailing windows.

None of these pairs rows with rows. Counts up to a moment come from prefix sums over time, windows over
the future or the past from range frames on rows already aggregated to the frame's grain, and trailing
counts per entity from frames inside time buckets, so a very active entity is spread over its buckets.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from loanloom.operators.ordering import prefix_sums
from loanloom.operators.ranking import evaluate


def epoch(c):
    return F.unix_micros(F.col(c).cast("timestamp")) if isinstance(c, str) else F.unix_micros(c.cast("timestamp"))


def count_before(
    observations: DataFrame, events: DataFrame, key: str, observed_at: str, event_at: str, name: str = "n_before",
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Events of the same key strictly before each observation; observations without any get zero.

    Events and observation moments form one timeline per key; the answer is the exclusive prefix sum at
    the observation's moment. No (observation, event) pair is ever built.
    """
    marks = observations.select(key, epoch(observed_at).alias("_at"), F.lit(0).cast("long").alias("_n")).distinct()
    line = events.select(key, epoch(event_at).alias("_at"), F.lit(1).cast("long").alias("_n")).unionByName(marks)
    sums = prefix_sums(line, "_at", ["_n"], [key], cuts=cuts).select(
        F.col(key).alias("_key"), "_at", F.col("before__n").alias(name))
    out = observations.withColumn("_oat", epoch(observed_at))
    hit = (out[key] == sums["_key"]) & (out["_oat"] == sums["_at"])
    return out.join(sums, hit, "left").drop("_key", "_at", "_oat").withColumn(name, F.coalesce(name, F.lit(0)).cast("long"))


def early_warning_sample(
    snapshots: DataFrame, key: str, month: str, overdue: str, window_months: int = 3, bad_from: int = 2
) -> DataFrame:
    """Snapshots that are not overdue, labelled by the worst state of the following months.

    ``snapshots`` has one row per key and month, so a frame holds at most one row per month.
    """
    ahead = Window.partitionBy(key).orderBy(month).rangeBetween(1, window_months)
    worst = F.coalesce(F.max(overdue).over(ahead), F.lit(0))
    return snapshots.withColumn("label", (worst >= bad_from).cast("int")).where(F.col(overdue) == 0)


def early_warning_features(snapshots: DataFrame, key: str, month: str, overdue: str, balance: str) -> DataFrame:
    """Overdue counts of 3 and 6 months, worst of 12, trend over 6 months, change to the month before."""
    back = lambda k: Window.partitionBy(key).orderBy(month).rangeBetween(-k + 1, 0)
    late = F.when(F.col(overdue) > 0, 1).otherwise(0)
    previous = Window.partitionBy(key).orderBy(month).rangeBetween(-1, -1)
    return snapshots.withColumns({
        "overdue_count_m3": F.sum(late).over(back(3)), "overdue_count_m6": F.sum(late).over(back(6)),
        "max_dpd_m12": F.max(overdue).over(back(12)),
        "late_payment_trend": F.regr_slope(F.col(overdue).cast("double"), F.col(month).cast("double")).over(back(6)),
        "total_debt_change": F.try_divide(F.col(balance), F.max(balance).over(previous)) - 1,
    })


def trailing_count(
    events: DataFrame, entity: str, at: str, window_seconds: int = 3600, count_all: bool = False, name: str = "n_recent"
) -> DataFrame:
    """(entity, second, n): distinct active seconds in (t - window, t], or with ``count_all`` all events.

    A time bucket is as long as the window, and each second is also handed to the following bucket as
    context. A frame therefore sees two buckets, at most 2 * window rows, whatever the entity's volume.
    """
    second = F.unix_seconds(F.col(at).cast("timestamp"))
    per = events.where(F.col(entity).isNotNull()).groupBy(entity, second.alias("second")).agg(F.count("*").alias("_n"))
    own = F.floor(F.col("second") / window_seconds)
    copies = F.inline(F.array(
        F.struct(own.alias("_bucket"), F.lit(True).alias("_own")), F.struct((own + 1).alias("_bucket"), F.lit(False).alias("_own"))))
    spread = per.select(entity, "second", "_n", copies)
    frame = Window.partitionBy(entity, "_bucket").orderBy("second").rangeBetween(-(window_seconds - 1), 0)
    value = F.sum("_n").over(frame) if count_all else F.count("*").over(frame)
    return spread.withColumn(name, value).where("_own").select(entity, "second", name)


def last_periods(
    log: DataFrame, key: str, period: str, values: Sequence[str], length: int = 12, keys: DataFrame | None = None
) -> DataFrame:
    """Per key the last ``length`` periods in order, padded with zeros on the left.

    The rank filter runs on both sides of the shuffle, so at most ``length`` rows per key and task travel.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(period)))
    recent = log.select(key, period, *values).withColumn("_rn", rank).where(F.col("_rn") <= length)
    zero = F.struct(*[F.lit(0.0).alias(v) for v in values])
    step = F.struct(*[F.coalesce(F.col(v).cast("double"), F.lit(0.0)).alias(v) for v in values])
    rows = recent.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(period).alias("_p"), step.alias("_s")))), lambda x: x["_s"]).alias("_seq"))
    if keys is not None:
        rows = keys.select(key).distinct().join(rows, key, "left")
    seq = F.coalesce("_seq", F.array().cast(f"array<struct<{','.join(v + ':double' for v in values)}>>"))
    return rows.select(key, F.concat(F.array_repeat(zero, F.lit(length) - F.size(seq)), seq).alias("sequence"))


def step_importance(
    df: DataFrame, label: str, values: Sequence[str], score: Callable[[Column], Column], length: int, sequence: str = "sequence",
) -> DataFrame:
    """(step, auc, auc_drop): what the scorer loses in AUC when one step of every sequence is set to zero; step 0 is the whole sequence.

    ``score`` turns a sequence column into a score column. All ``length`` + 1 copies of a row come from one expansion, and one
    grouped prefix sum ranks the scores of all copies at once, so the data is read once however long the sequences are.
    """
    nothing = F.struct(*[F.lit(0.0).alias(v) for v in values])
    copies = df.select(F.col(label).alias("label"), sequence, F.explode(F.sequence(F.lit(0), F.lit(length))).alias("step"))
    erased = F.transform(sequence, lambda x, i: F.when(i + 1 == F.col("step"), nothing).otherwise(F.struct(*[x[v].cast("double").alias(v) for v in values])))
    scored = copies.select("step", "label", score(erased).alias("score"))
    aucs = evaluate(scored, "score", "label", ["step"]).select("step", "auc")
    whole = Window.partitionBy()  # one row per step
    return aucs.withColumn("auc_drop", F.max(F.when(F.col("step") == 0, F.col("auc"))).over(whole) - F.col("auc"))


def jitter(df: DataFrame, key: str, values: Sequence[str], scale: float = 0.1, seed: int = 42) -> DataFrame:
    """Normal noise on every step, drawn from the hash of key, step and field."""
    from loanloom.functions.hashing import hash_normal

    def noisy(x, i):
        return F.struct(*[
            (x[v] + scale * hash_normal(F.concat_ws("|", F.col(key).cast("string"), i.cast("string"), F.lit(v)), seed)).alias(v)
            for v in values])

    return df.withColumn("sequence", F.transform("sequence", noisy))


def time_warp(df: DataFrame, key: str, values: Sequence[str], low: float = 0.9, high: float = 1.1, seed: int = 42) -> DataFrame:
    """Stretch by linear interpolation or crop to a hash-drawn share of the length."""
    from loanloom.functions.hashing import hash_unit

    n = F.size("sequence")
    m = F.floor(n * (low + (high - low) * hash_unit(key, seed))).cast("int")
    start = F.floor(hash_unit(key, f"{seed}s") * (n - m)).cast("int")

    def point(i):
        spot = i * F.try_divide(n - 1, m - 1)
        lo = F.floor(spot).cast("int")
        hi = F.least(lo + 1, n - 1)
        a, b, w = F.get("sequence", lo), F.get("sequence", hi), spot - lo
        return F.struct(*[(a[v] * (1 - w) + b[v] * w).alias(v) for v in values])

    longer = F.transform(F.sequence(F.lit(0), m - 1), point)
    return df.withColumn("sequence", F.when(m < n, F.slice("sequence", start + 1, m)).when(n < 2, F.col("sequence")).otherwise(longer))
