"""Exact self-join of word-shingle sets by Jaccard similarity, as a metric-space join with pivots.

The Jaccard distance is a metric. Sets within ``reach`` = 1 - similarity of each other are to be linked.

1. Texts with equal sets are one class; a class is joined once and named by its smallest doc_id (by a hash where that id has
   texts with other sets too).
2. Pivots and regions. In a fixed order of all shingles (common ones last), two sets within reach share a shingle among
   the first ``n - ceil(similarity * n) + 1`` of each. The smallest class that holds a leading shingle is the pivot of all
   classes that hold it, so each class belongs to the regions of the pivots that its leading shingles name, and any two
   classes within reach meet in a region. Regions are the Voronoi cells with their boundary copies: a class is copied into
   every region where it may have a partner, and only there.
3. Windows. In a region, a class stays if some other one lies within its windows: first the sizes alone (distance from the
   empty set), by counts; then the sizes and the counts of shingles by hash bucket (a map into an L1 space that never lengthens a symmetric difference) must not
   differ by more than ``reach`` allows. This is the triangle inequality on small sketches; no link is lost.
4. Recursion. A region too large for one task computes the exact distance of its members to the pivot. Members within
   reach are linked to the pivot and hence to each other; members within 2 x reach are compared with those in blocks; and
   all members not linked form the next region, with a pivot of their own.
5. A region that fits is joined exactly, all intersections at once; a spanning set of its links goes out.
   A region whose members all lie in another one is left out: its pairs meet there.

Links never leave a task as all pairs of a group: regions give at most one link per member.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.common import written
from loanloom.llm.words import mixed, shingles, steps, text_bytes
from loanloom.operators.graph import component_labels

#: counters of the frequency sketch (fixed size; it only orders shingles and never decides a link)
SKETCH_BITS = 20
#: members and shingles that one task joins at once
LEAF_MEMBERS, LEAF_SHINGLES = 1500, 4_000_000
#: members of a region whose sketches one task compares
SKETCH_MEMBERS = 6000
#: bits of the table that tells which texts are needed again (2 MB at any size)
ID_BITS = 24
#: pivot rounds of large regions before the rest is compared in blocks
ROUNDS = 3


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    data, offsets = text_bytes(batch.column(batch.schema.get_field_index("text")))
    hashes, bounds = shingles(data, offsets, size)
    for a, b in zip(bounds[:-1], bounds[1:]):
        x = np.sort(hashes[a:b])
        yield x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) > 1 else x


def common_buckets(docs: DataFrame, size: int) -> np.ndarray:
    """Which of the 2^SKETCH_BITS hash buckets hold common shingles. Tasks send the buckets that stand out in their share of
    the texts; what reaches the driver is bounded by the number of buckets."""
    def run(batches):
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        for part in steps(batches):
            data, offsets = text_bytes(part.column(0))
            hashes, _ = shingles(data, offsets, size)
            counts += np.bincount((hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS)
        out = np.flatnonzero(counts > 8 + 4 * counts.mean())
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.int32()), pa.array(counts[out], pa.int64())], names=["bucket", "c"])

    sent = docs.select("text").mapInArrow(run, "bucket int, c long")
    rows = sent.groupBy("bucket").agg(F.sum("c").alias("c")).where("c >= 40").select("bucket").toArrow()
    common = np.zeros(1 << SKETCH_BITS, bool)
    common[rows["bucket"].to_numpy()] = True
    return common


def signatures(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, n, s1, s2 (the set's 128-bit name), prefix (leading shingles), sketch (shingle counts by bucket, at most 255)."""
    common = docs.sparkSession.sparkContext.broadcast(np.packbits(common_buckets(docs, size)).tobytes())  # 128 KB

    def run(batches):
        late = np.unpackbits(np.frombuffer(common.value, np.uint8)).astype(bool)
        for part in steps(batches):
            n, s1, s2, prefix, sketch = [], [], [], [], []
            for x in _sets(part, size):
                n.append(len(x))
                one, two = _name(x)
                s1.append(one)
                s2.append(two)
                lead = len(x) - (percent * len(x) + 99) // 100 + 1 if len(x) else 0
                order = (x >> np.uint64(1)) | (late[(x >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(63))
                prefix.append(np.sort(order)[:lead].view(np.int64))
                slots = 64
                while slots < 4096 and slots * 8 < len(x):
                    slots *= 2
                counts = np.bincount((x & np.uint64(slots - 1)).astype(np.int64), minlength=slots)
                sketch.append(np.minimum(counts, 255).astype(np.uint8).tobytes())
            ends = np.concatenate([[0], np.cumsum([len(p) for p in prefix])]).astype(np.int32)
            flat = np.concatenate(prefix) if prefix else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).cast(pa.int64()), pa.array(n, pa.int32()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(sketch, pa.binary())],
                names=["doc_id", "n", "s1", "s2", "prefix", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n int, s1 long, s2 long, prefix array<long>, sketch binary")


def _name(x: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, with its size the set's name."""
    return (int(x.sum(dtype=np.uint64).astype(np.int64)), int(mixed(x ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)))


def _by_region(rows: DataFrame, work: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Run ``work`` on the rows of each region (a bounded number). Regions are read one after another from sorted rows: far
    less per-group cost than a grouped map where most regions have two rows."""
    def run(batches):
        held = None
        for batch in batches:
            df = batch.to_pandas()
            df = pd.concat([held, df], ignore_index=True) if held is not None else df
            if not len(df):
                continue
            keys = df["region"].to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
            out = [work(df.iloc[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
            held = df.iloc[cuts[-1]:]
            out = [x for x in out if len(x)]
            if out:
                yield pa.RecordBatch.from_pandas(pd.concat(out, ignore_index=True), preserve_index=False)
        if held is not None and len(held):
            yield pa.RecordBatch.from_pandas(work(held), preserve_index=False)

    return rows.repartition(F.col("region")).sortWithinPartitions("region").mapInArrow(run, schema)


def _sliced(rows: DataFrame, slices, first: str = "0") -> DataFrame:
    """Deal the rows of large regions into blocks that hold two of the region's slices each (side 1 and 2; side 0: one slice
    with itself), so that any two rows meet in a block. ``slices`` is a column: 1 leaves the region as it is."""
    rows = rows.withColumn("_s", slices).withColumn("_i", F.expr("CAST(pmod(xxhash64(rep, 7), _s) AS INT)"))
    rows = rows.withColumn("_j", F.expr("explode_outer(sequence(0, _s - 1))"))
    return rows.withColumn("side", F.expr("CASE WHEN _i = _j THEN 0 WHEN _i < _j THEN 1 ELSE 2 END")).withColumn(
        "region", F.expr(f"IF(_s = 1, region, xxhash64(region, {first}, least(_i, _j), greatest(_i, _j)))")).drop("_s", "_i", "_j")


def _folded(raw: list[bytes], slots: int) -> np.ndarray:
    return np.stack([np.frombuffer(r, np.uint8).astype(np.int32).reshape(-1, slots).sum(0) if len(r) > slots
                     else np.frombuffer(r, np.uint8).astype(np.int32) for r in raw])


def _may_link(percent: int):
    """Members of a region with another one inside their windows."""
    def work(df: pd.DataFrame) -> pd.DataFrame:
        n, side = df["n"].to_numpy(np.int64), df["side"].to_numpy()
        order = np.argsort(n, kind="stable")
        n, side = n[order], side[order]
        raw = df["sketch"].to_numpy()[order]
        hit = np.zeros(len(n), bool)
        if len(n) > 1:
            widths = np.array([len(r) for r in raw])
            for width in np.unique(widths):  # pairs are compared at the narrower of their two sketches
                at = np.flatnonzero(widths >= width)
                table = _folded([raw[i] for i in at], int(width))
                for own in np.flatnonzero(widths[at] == width):
                    i = at[own]
                    near = (100 * np.minimum(n[at], n[i]) >= percent * np.maximum(n[at], n[i]))
                    near[own] = False
                    if side[i]:
                        near &= side[at] == 3 - side[i]
                    js = np.flatnonzero(near)
                    js = js[~(hit[at[js]] & hit[i])]
                    if not len(js):
                        continue
                    # similarity (a + b - d) / (a + b + d) falls with the symmetric difference d, which is at least the L1 distance
                    d = np.abs(table[js] - table[own]).sum(1)
                    total = n[at[js]] + n[i]
                    ok = 100 * (total - d) >= percent * (total + d)
                    if ok.any():
                        hit[i] = True
                        hit[at[js[ok]]] = True
        return df.iloc[order[hit]][["region", "rep", "side"]]

    return work


def _linked(percent: int):
    """A spanning set of the links inside a region: (a, b) with b the smallest member that a reaches inside the region."""
    def work(df: pd.DataFrame) -> pd.DataFrame:
        df = df.drop_duplicates("rep")
        rep, side, k = df["rep"].to_numpy(), df["side"].to_numpy(), len(df)
        if k < 2:
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        sets = [np.frombuffer(x, np.uint64) for x in df["items"]]
        n = np.array([len(x) for x in sets], np.int64)
        _, ids, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(k), n)
        shared = counts >= 2
        ids, owner = (np.cumsum(shared) - 1)[ids][shared[ids]], owner[shared[ids]]
        inter = np.zeros((k, k), np.float64)
        order = np.argsort(ids, kind="stable")
        ids, owner = ids[order], owner[order]
        wide = max(256, 8_000_000 // k)
        for lo in range(0, int(ids[-1]) + 1 if len(ids) else 0, wide):
            a, b = np.searchsorted(ids, [lo, lo + wide])
            m = np.zeros((k, min(wide, int(ids[-1]) + 1 - lo)), np.float32)
            m[owner[a:b], ids[a:b] - lo] = 1
            inter += m @ m.T
        inter = np.rint(inter).astype(np.int64)
        link = 100 * inter >= percent * (n[:, None] + n[None, :] - inter)
        link &= (side[:, None] == 0) | (side[None, :] == 0) | (side[:, None] != side[None, :])
        np.fill_diagonal(link, False)
        seen, a, b = np.zeros(k, bool), [], []
        for i in np.argsort(rep, kind="stable"):
            if seen[i] or not link[i].any():
                continue
            reach = np.zeros(k, bool)
            front = np.array([i])
            reach[i] = True
            while len(front):
                new = link[front].any(0) & ~reach
                reach |= new
                front = np.flatnonzero(new)
            seen |= reach
            reach[i] = False
            a.append(rep[reach])
            b.append(np.full(reach.sum(), rep[i]))
        return pd.DataFrame({"a": np.concatenate(a) if a else np.zeros(0, np.int64), "b": np.concatenate(b) if b else np.zeros(0, np.int64)})

    return work


def _distances(rows: DataFrame) -> DataFrame:
    """Adds (i, u): sizes of the intersection and union with the region's pivot."""
    def run(batches):
        for batch in batches:
            mine, theirs = batch.column(batch.schema.get_field_index("items")), batch.column(batch.schema.get_field_index("pivot_items"))
            inter, union = [], []
            for x, p in zip(mine, theirs):
                x, p = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(p.as_buffer(), np.uint64)
                both = int(np.isin(x, p, assume_unique=True).sum())
                inter.append(both)
                union.append(len(x) + len(p) - both)
            keep = [batch.column(batch.schema.get_field_index(c)) for c in ("region", "rep", "pivot")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(inter, pa.int64()), pa.array(union, pa.int64())],
                                             names=["region", "rep", "pivot", "i", "u"])

    return rows.select("region", "rep", "pivot", "items", "pivot_items").mapInArrow(run, "region long, rep long, pivot long, i long, u long")


def _regions(tokens: DataFrame) -> DataFrame:
    """(region, rep, n) of the tokens (rep, n, token) that several classes hold; the region is the smallest of them. Rows may repeat.
    Tokens are many times the classes, so they are shuffled once and read in order."""
    def run(batches):
        first = [np.zeros(0, np.int64)] * 3  # the last token's first row, which goes on in the next batch
        for batch in batches:
            rep, n, token = (np.concatenate([f, c.to_numpy()]) for f, c in zip(first, batch.columns))
            if not len(token):
                continue
            cuts = np.concatenate([[0], np.flatnonzero(token[1:] != token[:-1]) + 1, [len(token)]])
            held = np.diff(cuts)
            region, several = np.repeat(rep[cuts[:-1]], held), np.repeat(held > 1, held)
            first = [c[cuts[-2]:cuts[-2] + 1] for c in (rep, n, token)]
            yield pa.RecordBatch.from_arrays([pa.array(region[several]), pa.array(rep[several]), pa.array(n[several], pa.int32())],
                                             names=["region", "rep", "n"])

    rows = tokens.select("rep", "n", "token").repartition(F.col("token")).sortWithinPartitions("token", "rep")
    return rows.mapInArrow(run, "region long, rep long, n int")


def _with_company(members: DataFrame, percent: int) -> DataFrame:
    """Members (region, rep, n) of a region that have another one of nearly their size. Sizes within reach of each other lie in
    the same or in neighbouring bands of a geometric scale, so that counts by (region, band) are enough."""
    width = math.log(100 / min(percent, 99)) * (1 + 1e-6)  # a little wider, so that rounding cannot part two sizes further
    banded = members.withColumn("band", F.floor(F.log("n") / F.lit(width)).cast("int"))
    counts = banded.groupBy("region", "band").agg(F.count("*").alias("c"))
    around = counts.select("region", "c", F.explode(F.array(*[F.struct((F.col("band") + d).alias("band"), F.lit(d == 0).alias("own")) for d in (-1, 0, 1)])).alias("x"))
    full = around.groupBy("region", "x.band").agg(F.sum("c").alias("c"), F.max("x.own").alias("own")).where("own AND c > 1")
    return banded.join(full.select("region", "band"), ["region", "band"], "left_semi").drop("band")


def _outer(near: DataFrame) -> DataFrame:
    """Rows (region, rep, side) without the regions whose members all lie in another region too, where all their pairs meet as well.
    The other one is the lowest region of the region's lowest member, if it is lower still: so a chain of them ends in one that stays."""
    whole = near.where("side = 0").select("region", "rep").distinct()
    homes = whole.groupBy("rep").agg(F.min("region").alias("home"))
    leads = near.groupBy("region").agg(F.min("rep").alias("rep"))
    inner = leads.join(homes, "rep").where("home < region").select("region", "home")
    there = whole.select(F.col("region").alias("home"), "rep", F.lit(True).alias("there"))
    inner = near.join(inner, "region").join(there, ["home", "rep"], "left").groupBy("region").agg(
        F.count("*").alias("c"), F.count("there").alias("both")).where("c = both").select("region")
    return near.join(inner, "region", "left_anti")


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of docs whose doc_id may be among ``wanted`` (of): a table of 2^ID_BITS bits, whatever the number of rows, keeps most
    of the other texts out of the join that follows."""
    bucket = lambda c: F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(1 << ID_BITS)).cast("int")
    words = wanted.select(bucket("of").alias("b")).groupBy(F.expr("b DIV 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, b % 64))").alias("bits")).toArrow()
    table = np.zeros((1 << ID_BITS) // 64, np.int64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    given = docs.sparkSession.sparkContext.broadcast(table.tobytes())

    def run(batches):
        bits = np.frombuffer(given.value, np.uint64)
        for batch in batches:
            at = batch.column(2).to_numpy()
            there = (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            yield batch.filter(pa.array(there.astype(bool))).select([0, 1])

    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text", bucket("doc_id").alias("_b"))
    return rows.mapInArrow(run, "doc_id long, text string")


def links(docs: DataFrame, classes: DataFrame, size: int, percent: int, leaf_members: int = LEAF_MEMBERS) -> DataFrame:
    """(a, b): links between class names that connect exactly the classes that similarity links connect. ``classes`` has rep (the
    name), of (the doc_id of a text that has the set), n, s1, s2, prefix and sketch."""
    tokens = classes.where("rep IS NOT NULL").select("rep", "n", F.explode("prefix").alias("token"))
    shared = written(_regions(tokens).distinct(), "shared")
    members = written(_with_company(shared, percent), "members")
    sizes = members.groupBy("region").agg(F.count("*").alias("members"))
    rows = members.join(sizes, "region")
    blocks = _sliced(rows, F.expr(f"IF(members <= {SKETCH_MEMBERS}, 1, CAST(ceil(members / {SKETCH_MEMBERS // 2}) AS INT))"))
    blocks = blocks.join(classes.select("rep", "sketch"), "rep")
    near = _by_region(blocks.select("region", "rep", "n", "sketch", "side"), _may_link(percent), "region long, rep long, side int")
    near = written(_outer(written(near, "near")), "outer")

    # the sets of those that are left
    wanted = near.select("rep").distinct().join(classes.select("rep", "of", "n", "s1", "s2"), "rep")

    def whole(batches):
        for part in steps(batches):
            reps, sizes, items = [], [], []
            for rep, n, s1, s2, x in zip(*(part.column(i).to_pylist() for i in range(4)), _sets(part, size)):
                if (len(x), *_name(x)) == (n, s1, s2):  # of the texts of one id, those that have the set
                    reps.append(rep)
                    sizes.append(n)
                    items.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), pa.array(sizes, pa.int32()), pa.array(items, pa.binary())],
                                             names=["rep", "n", "items"])

    texts = _texts_of(docs, wanted).join(wanted, F.col("doc_id") == F.col("of"))
    sets = written(texts.select("rep", "n", "s1", "s2", "text").mapInArrow(whole, "rep long, n int, items binary"), "sets")
    lengths = sets.select("rep", "n").distinct()  # without the sets themselves, which are shuffled for their joins alone
    sets = sets.dropDuplicates(["rep"])

    sizes = written(near.join(lengths, "rep").groupBy("region").agg(
        F.count("*").alias("members"), F.sum("n").alias("weight"), F.max("side").alias("sides")), "sizes")
    fits = (F.col("members") <= leaf_members) & (F.col("weight") <= LEAF_SHINGLES)
    found = []
    leaves = near.join(sizes.where(fits), "region").join(sets, "rep").select("region", "rep", "side", "items")
    found.append(_by_region(leaves, _linked(percent), "a long, b long"))

    open_ = near.join(sizes.where(~fits).select("region"), "region").select("region", "rep").distinct()
    slices = F.expr(f"CAST(greatest(1, ceil(members / {max(1, leaf_members // 2)}), ceil(weight / {LEAF_SHINGLES // 2})) AS INT)")
    if sizes.where(~fits).limit(1).count():
        for turn in range(ROUNDS):
            pivots = open_.groupBy("region").agg(F.min("rep").alias("pivot"))
            theirs = pivots.join(sets.select(F.col("rep").alias("pivot"), F.col("items").alias("pivot_items")), "pivot")
            rows = open_.join(sets.select("rep", "items"), "rep").join(theirs, "region")
            rows = written(_distances(rows), "distances")
            # distance (u - i) / u against reach and twice reach, in whole numbers
            rows = rows.withColumn("ring", F.expr(f"CASE WHEN 100 * i >= {percent} * u THEN 0 "
                                                  f"WHEN 100 * (u - i) <= {2 * (100 - percent)} * u THEN 1 ELSE 2 END"))
            found.append(rows.where("ring = 0 AND rep <> pivot").select(F.col("rep").alias("a"), F.col("pivot").alias("b")))
            rest = rows.where("ring > 0").select("region", "rep")
            counts = rows.join(lengths, "rep").groupBy("region").agg(
                F.count(F.when(F.col("ring") <= 1, 1)).alias("members"), F.sum(F.when(F.col("ring") <= 1, F.col("n")).otherwise(0)).alias("weight"),
                F.count(F.when(F.col("ring") == 1, 1)).alias("mid"),
                F.count(F.when(F.col("ring") > 0, 1)).alias("left"), F.sum(F.when(F.col("ring") > 0, F.col("n")).otherwise(0)).alias("left_weight"))
            counts = written(counts, "counts")
            # ring 0 against ring 1, slice by slice: side 1 against side 2
            cross = rows.where("ring < 2").join(counts.where("mid > 0"), "region").withColumn("_s", slices)
            cross = cross.withColumn("_i", F.expr("CAST(pmod(xxhash64(rep, 7), _s) AS INT)")).withColumn(
                "_j", F.expr("explode_outer(sequence(0, _s - 1))"))
            cross = cross.select(F.expr(f"xxhash64(region, 'cross', {turn}, IF(ring = 0, _i, _j), IF(ring = 0, _j, _i))").alias("region"),
                                 "rep", (F.col("ring") + 1).alias("side"))
            found.append(_by_region(cross.join(sets.select("rep", "items"), "rep"), _linked(percent), "a long, b long"))
            open_ = rest
            sizes = counts.select("region", F.col("left").alias("members"), F.col("left_weight").alias("weight"))
            small = (F.col("members") <= leaf_members) & (F.col("weight") <= LEAF_SHINGLES)
            done = open_.join(sizes.where(small), "region").join(sets.select("rep", "items"), "rep").withColumn("side", F.lit(0))
            found.append(_by_region(done.select("region", "rep", "side", "items"), _linked(percent), "a long, b long"))
            open_ = open_.join(sizes.where(~small).select("region"), "region")
            if not sizes.where(~small).limit(1).count():
                break
        else:
            rows = _sliced(open_.join(sizes, "region"), slices, "'rest'")
            found.append(_by_region(rows.select("region", "rep", "side").join(sets.select("rep", "items"), "rep"), _linked(percent), "a long, b long"))
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return written(out.distinct(), "links")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, leaf_members: int = LEAF_MEMBERS) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_shingles, component_id.

    Two texts are linked when ``100 * intersection >= percent * union`` of their sets of ``size``-word shingles (A-Z
    lower-cased; a text with fewer words is one shingle). component_id is the smallest doc_id reachable by links, itself
    included. Null texts and texts without words have the empty set and are linked with nothing. Repeated rows give repeated
    results; different texts that share a doc_id count as linked. A null doc_id is not a name: such a row takes the component
    of an equal set that has an id, else null.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must lie above 50 and up to 100")
    sigs = written(signatures(docs, size, percent), "signatures")
    name = F.struct("n", "s1", "s2")
    classes = sigs.where("n > 0").groupBy("n", "s1", "s2").agg(
        F.min("doc_id").alias("of"), F.any_value("prefix").alias("prefix"), F.any_value("sketch").alias("sketch"))
    # ids whose texts have different sets: a class is named by its smallest id, or by a hash where that id names another one
    several = sigs.where("n > 0 AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(F.min(name).alias("first"), F.max(name).alias("last"))
    several = written(several.where("first <> last").select("_id", "first"), "several")
    repeated = several.limit(1).count() > 0
    if repeated:
        other = F.col("first").isNotNull() & (F.col("first") != name)
        classes = classes.join(several, F.col("of") == F.col("_id"), "left").withColumn(
            "rep", F.when(other, F.xxhash64("of", "n", "s1", "s2")).otherwise(F.col("of"))).drop("_id", "first")
    else:
        classes = classes.withColumn("rep", F.col("of"))
    classes = written(classes, "classes")
    names = classes.select(*[F.col(c).alias(f"_{c}") for c in ("n", "s1", "s2", "rep", "of")])
    same = (F.col("n") == F.col("_n")) & (F.col("s1") == F.col("_s1")) & (F.col("s2") == F.col("_s2"))
    found = links(docs, classes, size, percent, leaf_members)
    if repeated:  # texts of one id are linked
        sets = sigs.where("n > 0").join(several, F.col("doc_id") == F.col("_id")).select("n", "s1", "s2", "first").distinct()
        ends = sets.join(names, same).select(F.col("_rep").alias("a"), "first.*").join(names, same).select("a", F.col("_rep").alias("b"))
        found = found.unionByName(ends.where("a <> b"))
    labels = component_labels(found).select(F.col("id").alias("_id"), "label")
    named = names.join(labels, F.col("_rep") == F.col("_id"), "left").withColumn("component_id", F.coalesce("label", "_rep"))
    if repeated:
        least = named.groupBy(F.col("component_id").alias("_c")).agg(F.min("_of").alias("least"))
        named = named.join(least, F.col("component_id") == F.col("_c"), "left").withColumn("component_id", F.col("least"))
    out = sigs.select("doc_id", "n", "s1", "s2").join(named.select("_n", "_s1", "_s2", "component_id"), same, "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(
        F.col("doc_id")).alias("component_id"))
