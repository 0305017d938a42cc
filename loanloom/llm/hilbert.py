"""Sharding along a Hilbert curve (DataFrame functions only).

Several metadata columns are quantised to 2^bits levels each, the levels of a row give its index on the Hilbert curve, rows
are sorted by that index and the sorted run is cut into shards of equal row counts. Neighbours on the curve agree in all
dimensions, so each shard covers a small box and files can be skipped by their minima and maxima in any of them.

Levels: text columns by the order of their first seven bytes, numbers by value; both against approximate quantiles of the
column, so that levels hold similar row counts (a frequent value keeps one level). Nulls take level 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from loanloom.llm.common import free, written

BITS = 5


def _number(df: DataFrame, name: str) -> Column:
    """A number that keeps the column's order."""
    if isinstance(df.schema[name].dataType, NumericType):
        return F.col(name).cast("double")
    first = F.rpad(F.hex(F.substring(F.encode(F.col(name).cast("string"), "UTF-8"), 1, 7)), 14, "0")
    return F.conv(first, 16, 10).cast("double")


def quantised(df: DataFrame, dimensions: Sequence[str], bits: int = BITS) -> DataFrame:
    """Adds ``_q0 .. _qd``, the levels 0 to 2^bits - 1 of the dimensions. One pass for the quantiles, one row to the driver."""
    side = 2 ** bits
    numbers = df.select(*[_number(df, d).alias(f"_n{i}") for i, d in enumerate(dimensions)])
    probs = [j / (side - 1) for j in range(1, side - 1)]
    cuts = numbers.agg(*[F.percentile_approx(c, probs, 10_000).alias(c) for c in numbers.columns]).first()
    for i, d in enumerate(dimensions):
        edges = sorted(set(cuts[f"_n{i}"] or []))
        value = _number(df, d)
        # level: 1 + number of cuts below the value
        above = F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges]), lambda e: e < F.col(f"_n{i}"))) if edges else F.lit(0)
        df = df.withColumn(f"_n{i}", value).withColumn(f"_q{i}", F.when(F.col(f"_n{i}").isNull(), 0).otherwise(1 + above).cast("int"))
    return df.drop(*[f"_n{i}" for i in range(len(dimensions))])


def curve_index(levels: Sequence[str], bits: int = BITS) -> Column:
    """Hilbert index of integer levels, by folding the axes into the transposed index and interleaving its bits.

    The steps (bit by bit from the top: reflect or exchange low bits, then Gray decoding) run as one ``aggregate`` over the
    list of (bit, axis) pairs with the axes as an array; no step depends on data other than the row's own levels.
    """
    d = len(levels)
    pairs = ", ".join(f"named_struct('q', {1 << b}, 'i', {i})" for b in range(bits - 1, 0, -1) for i in range(d))
    axes = f"array({', '.join(levels)})"
    # low bits p = q - 1: reflect axis 0 if the bit is set in axis i, else exchange the differing low bits
    fold = (f"aggregate(array({pairs}), {axes}, (x, s) -> transform(x, (v, j) -> CASE "
            "WHEN (x[s.i] & s.q) != 0 THEN IF(j = 0, v ^ (s.q - 1), v) "
            "WHEN j = 0 OR j = s.i THEN v ^ ((x[0] ^ x[s.i]) & (s.q - 1)) ELSE v END))") if bits > 1 else axes
    gray = f"transform({fold}, (v, j) -> aggregate(slice({fold}, 1, j + 1), 0, (a, b) -> a ^ b))"
    top = " ^ ".join(f"IF((g[{d - 1}] & {1 << b}) != 0, {(1 << b) - 1}, 0)" for b in range(bits - 1, 0, -1)) or "0"
    turned = f"transform(array({gray}), g -> transform(g, v -> v ^ ({top})))[0]"
    places = ", ".join(f"named_struct('i', {i}, 'b', {b})" for b in range(bits - 1, -1, -1) for i in range(d))
    return F.expr(f"transform(array({turned}), g -> aggregate(array({places}), 0L, (a, s) -> a * 2 + (shiftright(g[s.i], s.b) & 1)))[0]")


def shards(docs: DataFrame, count: int, dimensions: Sequence[str] = ("source", "lang", "n_chars"), bits: int = BITS) -> DataFrame:
    """One row per row of docs: doc_id, the dimensions, size (UTF-8 bytes + 8), text_crc32, curve (Hilbert index), shard and
    slot (place in the shard, from 0). Row counts of any two shards differ by one at most.

    Nulls: a null text has no bytes (CRC 0), null dimensions take level 0, null ids sort first. Ties on the curve are ordered
    by doc_id, size and CRC; rows equal in all of these are interchangeable. With fewer rows than shards some stay empty.

    One range exchange over (curve, doc_id, size, CRC) orders the rows, so a cell with a third of all rows is cut by doc_id.
    The place is the partition's offset (one row per partition, prefix sums of counts) plus the place within the partition.
    """
    if count < 1:
        raise ValueError("count must be positive")
    df = docs.select("doc_id", *dimensions, F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("_bytes"),
                     F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).alias("text_crc32"))
    df = written(df.withColumn("size", F.col("_bytes") + 8).drop("_bytes"), "narrow")
    cells = quantised(df, dimensions, bits).withColumn("curve", curve_index([f"_q{i}" for i in range(len(dimensions))], bits))
    keys = ["curve", "doc_id", "size", "text_crc32"]
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    run = cells.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    run = written(run, "run").withColumn("_part", F.shiftright("_at", 33)).withColumn("_in", F.col("_at").bitwiseAND((1 << 33) - 1))
    # one row per partition: offsets from counts, small whatever the input (at most `parts` rows)
    sizes = {r[0]: r[1] for r in run.groupBy("_part").count().collect()}
    total, offsets = 0, []
    for part in sorted(sizes):
        offsets.append((part, total))
        total += sizes[part]
    if not total:
        return run.select("doc_id", *dimensions, "size", "text_crc32", "curve", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    starts = F.create_map(*[F.lit(x) for pair in offsets for x in pair])
    run = run.withColumn("_pos", F.element_at(starts, F.col("_part")).cast("long") + F.col("_in"))
    run = run.withColumn("shard", F.expr(f"CAST(_pos * {count} DIV {total} AS INT)"))
    first = F.expr(f"(CAST(shard AS BIGINT) * {total} + {count - 1}) DIV {count}")
    return run.select("doc_id", *dimensions, "size", "text_crc32", "curve", "shard", (F.col("_pos") - first).alias("slot"))


def manifest(sharded: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Per shard: row count, bytes, and the least and greatest value of each dimension - what a reader prunes by."""
    return sharded.groupBy("shard").agg(F.count("*").alias("n_rows"), F.sum("size").alias("n_bytes"), *[
        f(d).alias(f"{n}_{d}") for d in dimensions for n, f in (("min", F.min), ("max", F.max))])


def write_shards(docs: DataFrame, count: int, path: str, dimensions: Sequence[str] = ("source", "lang", "n_chars")) -> DataFrame:
    """Write the rows as one folder per shard, each sorted along the curve; returns the manifest. The columns shard, slot and
    curve are added (they replace columns of that name)."""
    placed = written(shards(docs, count, dimensions), "placed")
    rows = docs.drop("shard", "slot", "curve")
    ident, crc, mine = free("ident", rows), free("crc", rows), free("mine", rows)
    where = placed.groupBy(F.col("doc_id").alias(ident), F.col("text_crc32").alias(crc)).agg(F.sort_array(F.collect_list(
        F.struct("shard", "slot", "curve"))).alias("places"))  # rows equal in id and text share out their places
    copy = free("copy", rows)
    order = Window.partitionBy("doc_id", mine).orderBy(F.lit(0))
    rows = rows.withColumn(mine, F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0))).withColumn(copy, F.row_number().over(order))
    place = free("place", rows)
    where = where.withColumnRenamed("places", place)
    out = rows.join(where, rows["doc_id"].eqNullSafe(where[ident]) & (rows[mine] == where[crc])).withColumn(place, F.expr(f"`{place}`[`{copy}` - 1]"))
    out = out.select(*[c for c in rows.columns if c not in (mine, copy)], F.col(place)["shard"].alias("shard"), F.col(place)["slot"].alias("slot"),
                     F.col(place)["curve"].alias("curve"))
    # several writers a shard: slots are dealt by range, so every file of a shard covers a stretch of the curve
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return manifest(placed, dimensions)
