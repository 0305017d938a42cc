"""Fraud-graph features.

Shared attributes (phone, device, address) make every group of sharers a clique. The pairs of a clique
are never listed: degrees and neighbour counts of the union of cliques follow from group sizes over the
attribute subsets by inclusion and exclusion. Explicit relation edges are kept as an edge table.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from loanloom.functions.hashing import hash_int, hash_unit
from loanloom.operators.ordering import row_positions, uniform_cuts
from loanloom.session import cut_lineage, hold

# Strength of a relation by type; other types count 0.3.
RELATION_WEIGHTS = {"guarantor": 1.0, "co_borrower": 0.8, "device": 0.5}
RELATION_DEFAULT = 0.3


def dated_before(df: DataFrame, date: str, observed: str) -> DataFrame:
    return df.where(F.col(date) <= F.to_date(F.lit(observed)))


def relation_edges(relations: DataFrame, a: str = "customer_id_1", b: str = "customer_id_2") -> DataFrame:
    """Undirected edges in both directions (src, dst, weight); a repeated pair keeps its strongest relation."""
    known = F.create_map(*[F.lit(x) for kv in RELATION_WEIGHTS.items() for x in kv])
    w = F.coalesce(F.try_element_at(known, F.col("relation_type")), F.lit(RELATION_DEFAULT)).alias("weight")
    there = relations.select(F.col(a).alias("src"), F.col(b).alias("dst"), w)
    both = there.unionByName(there.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    return both.where("src <> dst").groupBy("src", "dst").agg(F.max("weight").alias("weight"))


def shared_attribute_features(vertices: DataFrame, key: str, attributes: Sequence[str], fraud: str | None = None) -> DataFrame:
    """Degree, fraud neighbours and strongest tie in the graph that links rows with an equal attribute.

    For a row, the set of neighbours is the union over the attributes of the other rows with the same value. Its size is the
    alternating sum, over the attribute subsets, of the number of other rows equal on the whole subset; the strongest tie is the
    largest subset that some other row shares. The lattice of subsets is pruned from below: single values are counted first, a row
    keeps the attributes in which somebody else equals it, and all subsets of those are counted in one grouping keyed by
    (subset, values). The number of shuffles does not depend on the number of attributes, and counts combine before each shuffle, so
    a popular value costs no more than a rare one. A row without an attribute has no ties through it. One row per key.
    """
    flag = F.coalesce(F.col(fraud).cast("long") if fraud else F.lit(0).cast("long"), F.lit(0).cast("long"))
    base = vertices.select(F.col(key).alias("_key"), flag.alias("_f"), *[F.col(a).cast("string").alias(f"_a{i}") for i, a in enumerate(attributes)])
    single = F.inline(F.array(*[F.struct(F.lit(i).alias("bit"), F.col(f"_a{i}").alias("value")) for i in range(len(attributes))]))
    long = base.select("_key", "_f", single).where("value IS NOT NULL")
    popular = long.groupBy("bit", "value").agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    shared = long.join(popular, ["bit", "value"], "left_semi").groupBy("_key", "_f").agg(
        F.array_sort(F.collect_list(F.struct("bit", "value"))).alias("own"))  # at most one entry per attribute
    subsets = shared.select("_key", "_f", F.explode(F.expr(
        "transform(sequence(1L, shiftleft(1L, size(own)) - 1), s -> filter(own, (x, i) -> shiftright(s, i) & 1 = 1))")).alias("chosen"))
    subsets = subsets.select("_key", "_f", F.expr("aggregate(chosen, 0L, (m, x) -> m + shiftleft(1L, x.bit))").alias("bits"), F.col("chosen.value").alias("values"))
    sizes = subsets.groupBy("bits", "values").agg(F.count("*").alias("_n"), F.sum("_f").alias("_s")).where("_n > 1")
    sign = F.when(F.size("values") % 2 == 1, 1).otherwise(-1)
    ties = subsets.join(sizes, ["bits", "values"]).groupBy("_key").agg(
        F.sum(sign * (F.col("_n") - 1)).alias("_degree"), F.sum(sign * (F.col("_s") - F.col("_f"))).alias("_frauds"), F.max(F.size("values")).alias("_tie"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    out = vertices.select(key).join(ties, F.col(key) == F.col("_key"), "left").select(
        key, zero("_degree").alias("degree"), zero("_frauds").alias("fraud_neighbor_count"), zero("_tie").alias("max_edge_weight"))
    return out.withColumn("fraud_neighbor_rate", F.col("fraud_neighbor_count") / F.greatest("degree", F.lit(1)))


def attribute_ties(vertices: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """The same graph in its two-sided form (key, relation, value, sharers): linear in the rows."""
    long = vertices.select(key, *[F.col(a).cast("string").alias(a) for a in attributes]).unpivot([key], list(attributes), "relation", "value")
    long = long.where("value IS NOT NULL").distinct()
    sizes = long.groupBy("relation", "value").agg(F.count("*").alias("sharers"))
    return long.join(sizes, ["relation", "value"]).where("sharers > 1")


def ranked_edges(edges: DataFrame) -> DataFrame:
    """(src, dst, d_src, d_dst, up): both directions of every edge; up where dst has the higher (degree, key)."""
    ends = edges.select("src", "dst").where("src <> dst").distinct()
    deg = ends.groupBy("src").agg(F.count("*").alias("d"))
    a = deg.select(F.col("src").alias("_a"), F.col("d").alias("d_src"))
    b = deg.select(F.col("src").alias("_b"), F.col("d").alias("d_dst"))
    both = ends.join(a, F.col("src") == F.col("_a")).join(b, F.col("dst") == F.col("_b"))
    up = (F.col("d_src") < F.col("d_dst")) | ((F.col("d_src") == F.col("d_dst")) & (F.col("src") < F.col("dst")))
    return both.select("src", "dst", "d_src", "d_dst", up.alias("up"))


def triangles(edges: DataFrame, ranked: DataFrame | None = None) -> DataFrame:
    """(id, triangles). Every edge points to the end of higher degree, so even a hub has few outgoing
    edges (at most the square root of twice the edge count) and the open wedges stay few."""
    up = (ranked_edges(edges) if ranked is None else ranked).where("up").select("src", "dst")
    one, two = up.select("src", F.col("dst").alias("x")), up.select("src", F.col("dst").alias("y"))
    wedge = one.join(two, "src").where("x < y")
    closing = up.select(F.least("src", "dst").alias("x"), F.greatest("src", "dst").alias("y"))
    closed = wedge.join(closing, ["x", "y"])
    return closed.select(F.explode(F.array("src", "x", "y")).alias("id")).groupBy("id").agg(F.count("*").alias("triangles"))


def squares(edges: DataFrame, ranked: DataFrame | None = None, chunk: int = 1024) -> DataFrame:
    """(id, squares): closed 4-cycles through each vertex.

    A 4-cycle has one vertex u of highest (degree, key) and one vertex w opposite to it. Paths u - v - w with u above v and w are
    listed from v: its few higher neighbours with each of its neighbours, so the paths are bounded by the edges times the smaller degree of
    their ends. c paths between u and w make c (c - 1) / 2 cycles, and each middle lies on c - 1 of them. A middle with many
    neighbours is split by the second end, so that no task holds all its paths. The paths are shuffled once, to their pair of ends, and
    counted there: each of the c paths brings its middle c - 1 cycles and either end half as many.
    """
    e = cut_lineage(ranked_edges(edges) if ranked is None else ranked)
    parts = F.ceil(F.col("d_src") / chunk)
    second = e.select(F.col("src").alias("v"), F.pmod(F.xxhash64("dst"), parts).alias("part"), F.col("dst").alias("w"), F.col("d_dst").alias("dw"))
    first = e.where("up").select(F.col("src").alias("v"), F.col("dst").alias("u"), F.col("d_dst").alias("du"), F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))
    below = (F.col("dw") < F.col("du")) | ((F.col("dw") == F.col("du")) & (F.col("w") < F.col("u")))
    paths = first.join(second, ["v", "part"]).where(below).select("v", "u", "w")
    met = paths.withColumn("c", F.count("*").over(Window.partitionBy("u", "w"))).where("c > 1")
    halves = met.select(F.inline(F.expr("array(struct(v AS id, 2 * (c - 1) AS k), struct(u AS id, c - 1 AS k), struct(w AS id, c - 1 AS k))")))
    return halves.groupBy("id").agg(F.expr("sum(k) DIV 2").alias("squares"))


def neighbour_features(edges: DataFrame, vertices: DataFrame, key: str, label: str, tri: DataFrame | None = None) -> DataFrame:
    """Degree, bad neighbours, rates, strongest tie, clustering and degree centrality per vertex.

    Neighbour labels travel along the edges once; an isolated vertex gets zeros. ``tri`` is the result of ``triangles`` if known.
    """
    who = vertices.select(F.col(key).alias("_v"), F.coalesce(F.col(label), F.lit(0)).alias("_bad"))
    joined = edges.join(who, F.col("dst") == F.col("_v"), "left")
    bad = F.coalesce("_bad", F.lit(0))
    per = joined.groupBy("src").agg(
        F.count("*").alias("degree"), F.sum(bad).alias("bad_neighbors"), F.max("weight").alias("max_edge_weight"),
        (F.sum(F.col("weight") * bad) / (F.sum("weight") + 1e-6)).alias("weighted_bad_rate"))
    tri = (triangles(edges) if tri is None else tri).select(F.col("id").alias("_tri"), "triangles")
    n = vertices.agg(F.count("*").alias("_all"), F.lit(1).alias("_one"))
    out = (
        vertices.select(key).join(per, F.col(key) == F.col("src"), "left").join(tri, F.col(key) == F.col("_tri"), "left")
        .withColumn("_one", F.lit(1)).join(F.broadcast(n), "_one")  # a single row
    )
    d, t = F.coalesce("degree", F.lit(0)), F.coalesce("triangles", F.lit(0))
    b = F.coalesce("bad_neighbors", F.lit(0))
    return out.select(
        key, d.alias("degree"), b.alias("bad_neighbor_count"), (b / F.greatest(d, F.lit(1))).alias("bad_neighbor_rate"),
        F.coalesce("max_edge_weight", F.lit(0.0)).alias("max_edge_weight"),
        F.coalesce("weighted_bad_rate", F.lit(0.0)).alias("weighted_bad_rate"), (d - b).alias("good_neighbors"),
        F.when(d > 1, 2 * t / (d.cast("double") * (d - 1))).otherwise(0.0).alias("clustering"),
        F.try_divide(d, F.col("_all") - 1).alias("degree_centrality"))


#: most paths of two edges whose ends meet in the vertex's row; the ends of more meet piece by piece
TWO_HOP_PATHS = 100_000
SKETCH_BITS = 14
#: places of a piece of a list, most of them that are sent one by one (more are sent as bits), and vertices that take a list from one task
PIECE, PIECE_PLACES, PIECE_TAKERS = 1 << 16, 1 << 12, 1024


def two_hop_counts(edges: DataFrame, vertices: DataFrame, key: str, most_paths: int | None = None, bits: int = SKETCH_BITS) -> DataFrame:
    """(key, n_two_hop, exact): distinct vertices at the end of a path of two edges, the vertex itself left out.

    All counts are exact unless ``most_paths`` is given. A vertex with at most TWO_HOP_PATHS paths (the sum of its neighbours'
    degrees) is counted in its row, where its neighbours' lists of neighbours, together at most that many keys, meet, so no row per path is
    made. The lists of any other vertex meet in pieces (``far_in_pieces``). With ``most_paths``, a vertex with more paths
    than that is estimated: its neighbours' distinct-count sketches are merged along its edges, 2^bits registers, a standard error of about
    1.04 / sqrt(2^bits), 0.8 % for 14, and no paths at all.
    """
    most = TWO_HOP_PATHS if most_paths is None else most_paths
    ends = edges.select("src", "dst").where("src <> dst").distinct()
    deg = ends.groupBy(F.col("src").alias("_v")).agg(F.count("*").alias("d"))
    paths = ends.join(deg, F.col("dst") == F.col("_v")).groupBy("src").agg(F.sum("d").alias("paths"))
    sized = cut_lineage(ends.join(paths.withColumnRenamed("src", "_s"), F.col("src") == F.col("_s")).select("src", "dst", (F.col("paths") <= most).alias("light")))
    light = sized.where("light").select(F.col("src").alias("v"), F.col("dst").alias("mid"))
    # a vertex of higher degree has no light neighbour
    listed = ends.join(deg.where(F.col("d") <= most), F.col("src") == F.col("_v"), "left_semi").groupBy(
        F.col("src").alias("mid")).agg(F.collect_list("dst").alias("near"))
    met = light.join(listed, "mid").groupBy("v").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("far"))
    own = F.array_contains("far", F.col("v")).cast("long")
    found = met.select("v", (F.size("far") - own).alias("n"), F.lit(True).alias("exact"))
    heavy = sized.where("NOT light").select(F.col("src").alias("v"), F.col("dst").alias("mid"))
    if most_paths is not None:
        merged = heavy.join(neighbour_sketches(ends, bits), F.col("mid") == F.col("_u")).groupBy("v").agg(F.hll_union_agg("sketch").alias("whole"))
        # the vertex is a neighbour of each of its neighbours
        found = found.unionByName(merged.select("v", (F.hll_sketch_estimate("whole") - 1).alias("n"), F.lit(False).alias("exact")))
    elif heavy.limit(1).count():
        found = found.unionByName(far_in_pieces(cut_lineage(ends), heavy).withColumn("exact", F.lit(True)))
    return vertices.select(F.col(key).alias("_k")).join(found, F.col("_k") == F.col("v"), "left").select(
        F.col("_k").alias(key), F.coalesce("n", F.lit(0)).cast("long").alias("n_two_hop"), F.coalesce("exact", F.lit(True)).alias("exact"))


def far_in_pieces(ends: DataFrame, heavy: DataFrame) -> DataFrame:
    """(v, n): distinct ends of the paths v - mid - end, v itself left out, for the pairs (v, mid) of ``heavy``; distinct ends (src, dst).

    The ends are numbered, and a middle's list is cut into pieces of PIECE numbers each, sent as two bytes a place or, if long, as one
    bit a place. The pieces of a vertex and a range of numbers pass through one stream that marks the places they hold: a task has
    PIECE marks and a batch of pieces in memory, whatever the degrees, and two hubs cost an eighth of a byte a path. A middle
    with many takers is sent by several tasks.
    """
    mids = heavy.groupBy("mid").agg(F.ceil(F.count("*") / PIECE_TAKERS).alias("tasks"))
    near = ends.join(mids, F.col("src") == F.col("mid"), "left_semi").select(F.col("src").alias("mid"), "dst")
    named = near.select(F.col("dst").alias("_w")).distinct().withColumn("_h", hash_unit("_w", "two hops"))
    named = row_positions(named, "_h", "_w", descending=False, cuts=uniform_cuts(ends.sparkSession))
    at = F.col("pos") - 1
    places = near.join(named, F.col("dst") == F.col("_w")).groupBy("mid", F.floor(at / PIECE).alias("range")).agg(
        F.collect_list((at % PIECE).cast("int")).alias("places"))
    mid, v = ends.schema["src"].dataType, heavy.schema["v"].dataType
    form = T.StructType([T.StructField("mid", mid), T.StructField("range", T.LongType()), T.StructField("places", T.BinaryType()), T.StructField("bits", T.BinaryType())])
    pieces = cut_lineage(places.mapInArrow(packed_places(PIECE, PIECE_PLACES), form))
    takers = heavy.join(mids, "mid").select("mid", "v", F.pmod(F.xxhash64("v"), "tasks").alias("task"))
    sent = pieces.join(mids, "mid").withColumn("task", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1))).drop("tasks")
    rows = takers.join(sent, ["mid", "task"]).select("v", "range", "places", "bits").repartition("v", "range").sortWithinPartitions("v", "range")
    counted = rows.mapInArrow(places_met(PIECE), T.StructType([T.StructField("v", v), T.StructField("n", T.LongType())]))
    back = heavy.join(ends.select(F.col("dst").alias("v"), F.col("src").alias("mid")), ["v", "mid"], "left_semi").select("v").distinct()
    both = counted.unionByName(back.withColumn("n", F.lit(-1).cast("long")))
    return both.groupBy("v").agg(F.sum("n").alias("n"))


def packed_places(width: int, most: int):
    """For ``mapInArrow`` over (mid, range, places): the places as two-byte numbers if there are at most ``most``, else as bits."""

    def pack(batches):
        for batch in batches:
            lists = [np.asarray(x.values.to_numpy(zero_copy_only=False)) for x in batch.column(2)]
            few = [x.astype("<u2").tobytes() if len(x) <= most else None for x in lists]
            bits = [None if len(x) <= most else np.packbits(np.bincount(x, minlength=width).astype(bool)).tobytes() for x in lists]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(few, pa.binary()), pa.array(bits, pa.binary())], ["mid", "range", "places", "bits"])

    return pack


def places_met(width: int):
    """For ``mapInArrow`` over (v, range, places, bits) in order of the first two: per vertex and range the number of places that its
    pieces hold. A vertex's rows may fill many batches."""

    def data(packed: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        packed = packed.cast(pa.binary())
        ends = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset:packed.offset + len(packed) + 1]
        return np.frombuffer(packed.buffers()[2] or b"", np.uint8), ends

    def met(batches):
        key, seen = None, np.zeros(width, bool)
        for batch in batches:
            if not batch.num_rows:
                continue
            v, at = batch.column(0), batch.column(1)
            new = pc.or_(pc.not_equal(v[1:], v[:-1]), pc.not_equal(at[1:], at[:-1])).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
            (few, few_ends), (bits, bit_ends) = data(batch.column(2)), data(batch.column(3))
            names, counts = [], []
            for a, b in zip(cuts[:-1], cuts[1:]):
                now = (v[a].as_py(), at[a].as_py())
                if key is not None and now != key:
                    names.append(key[0])
                    counts.append(np.count_nonzero(seen))
                    seen[:] = False
                key = now
                seen[few[few_ends[a]:few_ends[b]].view("<u2")] = True
                if bit_ends[a] < bit_ends[b]:
                    whole = np.bitwise_or.reduce(bits[bit_ends[a]:bit_ends[b]].reshape(-1, width // 8), axis=0)
                    seen |= np.unpackbits(whole).astype(bool)
            if names:
                yield pa.record_batch([pa.array(names, v.type), pa.array(counts, pa.int64())], ["v", "n"])
        if key is not None:
            yield pa.record_batch([pa.array([key[0]], v.type), pa.array([np.count_nonzero(seen)], pa.int64())], ["v", "n"])

    return met


def neighbour_sketches(ends: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """(_u, sketch): distinct-count sketch of every vertex's neighbours."""
    return ends.groupBy(F.col("src").alias("_u")).agg(F.hll_sketch_agg(F.col("dst").cast("string"), bits).alias("sketch"))


def graph_feature_table(edges: DataFrame, vertices: DataFrame, key: str, label: str) -> DataFrame:
    """All graph features of every vertex in one table: neighbours, neighbours of neighbours, centrality, component, clustering,
    and the labels of the neighbours by count, rate and weight."""
    near = neighbour_features(edges, vertices, key, label)
    far = two_hop_counts(edges, vertices, key).select(F.col(key).alias("_far"), "n_two_hop")
    comps = connected_components(edges, vertices, key).select(F.col(key).alias("_comp"), F.col("size").alias("component_size"))
    out = near.join(far, F.col(key) == F.col("_far")).join(comps, F.col(key) == F.col("_comp"))
    return out.select(
        key, F.col("degree").alias("n_neighbors"), F.col("n_two_hop").alias("n_two_hop_neighbors"), "degree_centrality", "component_size", "clustering",
        "bad_neighbor_rate", "bad_neighbor_count", "weighted_bad_rate", "good_neighbors", "max_edge_weight")


def hops_from(edges: DataFrame, sources: DataFrame, key: str, max_hops: int = 2) -> DataFrame:
    """(key, hops) of every vertex within ``max_hops`` of the sources, each at its shortest distance.

    Only the vertices reached last round are expanded, once each, so the work is linear in the edges
    however the paths multiply. One or two hops give the direct and indirect relations of a set.
    """
    seen = cut_lineage(sources.select(F.col(key).alias("id")).distinct().withColumn("hops", F.lit(0)))
    links = edges.select("src", "dst")
    for h in range(1, max_hops + 1):
        edge_of_front = seen.where(F.col("hops") == h - 1).join(links, F.col("id") == F.col("src"))
        fresh = edge_of_front.select(F.col("dst").alias("id")).distinct().join(seen.select("id"), "id", "left_anti")
        seen = cut_lineage(seen.unionByName(fresh.withColumn("hops", F.lit(h))))
    return seen.select(F.col("id").alias(key), "hops")


#: one in the fixed-point numbers of the embeddings
EMBEDDING_ONE = 1 << 20


def seed_digits(key, size: int, seed: int) -> Column:
    """Hex digits of md5(key|seed|block), 32 a block, for at least ``size`` components."""
    return F.concat(*[F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)), F.lit(str(b)))) for b in range((size + 31) // 32)])


def seed_vector(key, size: int, seed: int) -> Column:
    """Sparse random vector of a vertex: a hex digit of md5(key|seed|block) per component, 0-2 for +1, 3-5 for -1, else 0."""
    blocks = seed_digits(key, size, seed)
    one = EMBEDDING_ONE
    return F.transform(F.sequence(F.lit(1), F.lit(size)), lambda i: F.when(F.substring(blocks, i, F.lit(1)) < "3", one).when(
        F.substring(blocks, i, F.lit(1)) < "6", -one).otherwise(0).cast("long"))


def packed_vectors(packed: pa.Array, size: int, seeds: bool) -> np.ndarray:
    """The vectors of a binary column that are not null: 32-bit numbers, or the signs of a seed, which has two digits in each byte."""
    ends = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset:packed.offset + len(packed) + 1]
    data = np.frombuffer(packed.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    if not seeds:
        return data.view("<i4").reshape(-1, size)
    sign = np.array([1, 1, 1, -1, -1, -1, *[0] * 10], np.int8)
    both = np.stack([np.repeat(sign, 16), np.tile(sign, 16)], axis=-1)
    return both.view(np.int16).ravel().take(data).view(np.int8).reshape(-1, 32 * ((size + 31) // 32))[:, :size]


def neighbour_means(size: int, seeds: bool):
    """For ``mapInArrow`` over (id, x) in order of id: the rows of a vertex are its neighbours' packed vectors and one null that marks
    it as a vertex. Gives its packed mean, rounded down; zeros without neighbours. A vertex's rows may fill many batches."""

    def means(batches):
        key, kept = None, None  # the vertex whose rows may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, packed = batch.column(0), batch.column(1).cast(pa.binary())
            new = pc.fill_null(pc.not_equal(ids[1:], ids[:-1]), True).to_numpy(zero_copy_only=False).astype(bool)
            starts = np.concatenate([[0], np.flatnonzero(new) + 1])
            there = packed.is_valid().to_numpy(zero_copy_only=False)
            n = np.add.reduceat(there.astype(np.int64), starts)
            marked = np.diff(np.append(starts, len(there))) > n
            sums = np.zeros((len(starts), size), np.int64)
            if there.any():
                before = np.cumsum(there) - there
                sums[n > 0] = np.add.reduceat(packed_vectors(packed, size, seeds), before[starts[n > 0]], axis=0, dtype=np.int64) * (EMBEDDING_ONE if seeds else 1)
            names = ids.take(pa.array(starts))
            if kept is not None and key.equals(names[0]):
                n[0], marked[0], sums[0] = n[0] + kept[0][0], marked[0] | kept[1][0], sums[0] + kept[2][0]
            elif kept is not None:
                yield from packed_means(pa.array([key.as_py()], ids.type), *kept)
            yield from packed_means(names[:-1], n[:-1], marked[:-1], sums[:-1])
            key, kept = names[-1], (n[-1:], marked[-1:], sums[-1:])
        if kept is not None:
            yield from packed_means(pa.array([key.as_py()], key.type), *kept)

    def packed_means(names, n, marked, sums):
        mean = (sums[marked] // np.maximum(n[marked], 1)[:, None]).astype("<i4")
        if len(mean):
            yield pa.record_batch([names.filter(pa.array(marked)), pa.array([m.tobytes() for m in mean], pa.binary())], ["id", "x"])

    return means


def unpacked(size: int, rounds: int):
    """For ``mapInArrow`` over (id, packed vectors of all rounds): one vector of doubles."""

    def vectors(batches):
        for batch in batches:
            whole = np.concatenate([packed_vectors(batch.column(k + 1).cast(pa.binary()), size, False) for k in range(rounds)], axis=1) / EMBEDDING_ONE
            ends = np.arange(0, whole.size + 1, size * rounds, dtype=np.int32)
            yield pa.record_batch([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(whole.reshape(-1)))], ["id", "vector"])

    return vectors


def walk_embeddings(edges: DataFrame, vertices: DataFrame, key: str, size: int = 64, rounds: int = 3, seed: int = 42) -> DataFrame:
    """(key, vector): where walks of 1 to ``rounds`` steps from a vertex lead, projected to ``size`` components a step.

    Round k is the mean of the neighbours' vectors of round k - 1, which starts with sparse random vectors: the expected seed
    vector at the end of a random walk of k steps. Two vertices whose walks meet the same vertices get close vectors, and inner
    products are kept in expectation. A round is one join along the edges and one ordered shuffle of packed vectors (4 bytes a component;
    seeds half a byte), summed in a stream and written before the next; vectors are fixed-point integers, so the result depends on
    neither the order nor the partitioning. Isolated vertices get zeros. Keys are numbers or strings.
    """
    ends = cut_lineage(edges.select("src", "dst").where("src <> dst").distinct())
    ids = vertices.select(F.col(key).alias("id")).distinct()
    state = cut_lineage(ids.select("id", F.unhex(seed_digits("id", size, seed)).alias("x")))
    form = state.schema
    out = None
    for k in range(rounds):
        sent = ends.join(state, F.col("dst") == F.col("id")).select(F.col("src").try_cast(form["id"].dataType).alias("id"), "x").where("id IS NOT NULL")
        marks = state.select("id", F.lit(None).cast("binary").alias("x"))
        rows = sent.unionByName(marks).repartition("id").sortWithinPartitions("id")
        state = cut_lineage(rows.mapInArrow(neighbour_means(size, k == 0), form))
        step = state.select(F.col("id").alias(f"_id{k}"), F.col("x").alias(f"_x{k}"))
        out = step if out is None else out.join(step, F.col("_id0") == F.col(f"_id{k}"))
    form = T.StructType([T.StructField("id", form["id"].dataType), T.StructField("vector", T.ArrayType(T.DoubleType()))])
    whole = out.select("_id0", *[f"_x{k}" for k in range(rounds)]).mapInArrow(unpacked(size, rounds), form)
    return whole.select(F.col("id").alias(key), "vector")


def device_sharing(pairs: DataFrame, user: str = "user_id", device: str = "device_id") -> DataFrame:
    """Devices of each user and how many of them are used by somebody else too."""
    pairs = pairs.select(user, device).distinct()
    users = pairs.groupBy(device).agg((F.count("*") > 1).cast("int").alias("_shared"))
    t = pairs.join(users, device).groupBy(user).agg(F.count("*").alias("n_devices"), F.sum("_shared").alias("n_shared_devices"))
    return t.withColumn("shared_device_ratio", F.col("n_shared_devices") / (F.col("n_devices") + 1e-6))


def neighbour_mean(edges: DataFrame, features: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Mean of the neighbours' features: one message-passing hop without weights."""
    other = features.select(F.col(key).alias("_v"), *columns)
    return edges.join(other, F.col("dst") == F.col("_v")).groupBy(F.col("src").alias(key)).agg(
        *[F.avg(c).alias(f"nb_{c}") for c in columns])


def component_labels(edges: DataFrame) -> DataFrame:
    """(id, label) of every vertex that is not the smallest of its component; label is that smallest vertex.

    ``edges`` has two columns of vertex keys, in any order and direction. Each round hooks every vertex that has a smaller
    neighbour to its smallest one, follows the hooks to their ends by pointer doubling, and replaces the ends of all edges
    by what they are hooked to. Only local minima survive a round, so edges and vertices shrink and the number of rounds
    does not grow with the length of chains. All state is written; a lost executor replays one step.
    """
    a, b = edges.columns
    pairs = lambda x, y: (F.greatest(x, y).alias("hi"), F.least(x, y).alias("lo"))
    links = cut_lineage(edges.where(F.col(a) != F.col(b)).select(*pairs(F.col(a), F.col(b))).distinct())
    labels = None
    while links.limit(1).count():
        hooks = cut_lineage(links.groupBy("hi").agg(F.min("lo").alias("to")))
        while True:
            for _ in range(2):
                onward = hooks.select(F.col("hi").alias("_hi"), F.col("to").alias("_to"))
                hooks = hooks.join(onward, F.col("to") == F.col("_hi"), "left").select("hi", F.coalesce("_to", "to").alias("to"))
            hooks = cut_lineage(hooks)
            if not hooks.join(hooks.select(F.col("hi").alias("_hi")), F.col("to") == F.col("_hi"), "left_semi").limit(1).count():
                break
        if labels is None:
            labels = hooks.select(F.col("hi").alias("id"), F.col("to").alias("label"))
        else:
            onward = hooks.select(F.col("hi").alias("_hi"), F.col("to").alias("_to"))
            labels = labels.join(onward, F.col("label") == F.col("_hi"), "left").select("id", F.coalesce("_to", "label").alias("label"))
            labels = cut_lineage(labels.unionByName(hooks.select(F.col("hi").alias("id"), F.col("to").alias("label"))))
        x, y = (hooks.select(F.col("hi").alias(f"_h{i}"), F.col("to").alias(f"_t{i}")) for i in (0, 1))
        links = links.join(x, F.col("hi") == F.col("_h0"), "left").join(y, F.col("lo") == F.col("_h1"), "left").select(
            F.coalesce("_t0", "hi").alias("p"), F.coalesce("_t1", "lo").alias("q"))
        links = cut_lineage(links.where("p <> q").select(*pairs(F.col("p"), F.col("q"))).distinct())
    return labels if labels is not None else links.select(F.col("hi").alias("id"), F.col("lo").alias("label"))


def connected_components(edges: DataFrame, vertices: DataFrame, key: str) -> DataFrame:
    """(key, component, size) of all vertices; component is the smallest reachable key."""
    labels = component_labels(edges.select("src", "dst")).select(F.col("id").alias("_id"), "label")
    state = vertices.select(F.col(key).alias("id")).distinct()
    state = cut_lineage(state.join(labels, F.col("id") == F.col("_id"), "left").select("id", F.coalesce("label", "id").alias("comp")))
    sizes = state.groupBy("comp").agg(F.count("*").alias("size"))
    return state.join(sizes, "comp").select(F.col("id").alias(key), F.col("comp").alias("component"), "size")


def label_communities(edges: DataFrame, vertices: DataFrame, key: str, rounds: int = 5) -> DataFrame:
    """Label propagation for a fixed number of rounds; the heaviest label wins, ties go to the smallest."""
    state = vertices.select(F.col(key).alias("id"), F.col(key).alias("comm")).distinct()
    for i in range(rounds):
        votes = edges.join(state, F.col("dst") == F.col("id")).groupBy("src", "comm").agg(F.sum("weight").alias("w"))
        best = votes.groupBy("src").agg(F.min(F.struct((-F.round("w", 9)).alias("w"), F.col("comm").alias("c"))).alias("top"))
        state = state.join(best, F.col("id") == F.col("src"), "left").select(
            "id", F.coalesce("top.c", "comm").alias("comm"))
        state = cut_lineage(state)
    return state.select(F.col("id").alias(key), F.col("comm").alias("community"))


def community_risk(communities: DataFrame, vertices: DataFrame, key: str, label: str, min_size: int = 3) -> DataFrame:
    t = communities.join(vertices.select(key, label), key).groupBy("community").agg(
        F.count("*").alias("size"), F.sum(label).alias("bad"), F.avg(label).alias("bad_rate"))
    return t.where(F.col("size") >= min_size)


#: links of a part of a rank's round at most
LINK_ROWS = 5_000_000


def page_rank(edges: DataFrame, vertices: DataFrame, key: str, rounds: int = 100, damping: float = 0.85, tolerance: float = 1e-10) -> DataFrame:
    """Rank that sums to one; rank of vertices without links is spread evenly. Rounds end when the ranks move by less than ``tolerance`` in all."""
    n = vertices.count()
    out = edges.groupBy("src").agg(F.count("*").alias("_deg"))
    links = cut_lineage(edges.select("src", "dst").join(out, "src").select("src", "dst", "_deg"))
    # dealt once, not every round, and into few parts, so that more links of a vertex are summed before their shuffle
    parts = max(edges.sparkSession.sparkContext.defaultParallelism, -(-links.count() // LINK_ROWS))
    links = hold(links.repartition(parts, "src").sortWithinPartitions("src"))
    links.count()  # a plan that has not run does not tell how it is dealt
    state = vertices.select(F.col(key).alias("id"), F.lit(1.0 / max(n, 1)).alias("rank"))
    for i in range(rounds):
        flow = links.join(state, F.col("src") == F.col("id")).groupBy("dst").agg(F.sum(F.col("rank") / F.col("_deg")).alias("_in"))
        nxt = cut_lineage(state.join(flow, F.col("id") == F.col("dst"), "left").select("id", F.col("rank").alias("_was"), F.coalesce("_in", F.lit(0.0)).alias("_in")))
        lost = 1 - (nxt.agg(F.sum("_in").alias("s")).first()["s"] or 0.0)
        rank = (1 - damping) / max(n, 1) + damping * (F.col("_in") + F.lit(lost / max(n, 1)))
        moved = nxt.agg(F.sum(F.abs(rank - F.col("_was"))).alias("m")).first()["m"] or 0.0
        state = nxt.select("id", rank.alias("rank"))
        if moved < tolerance:
            break
    links.unpersist()
    return state.select(F.col("id").alias(key), "rank")


def dense_components(edges: DataFrame, components: DataFrame, key: str, min_size: int = 3, min_density: float = 0.5, max_diameter: int = 3):
    """Components that are dense and of small diameter.

    Two vertices whose degrees add up to size - 1 are neighbours or share one, so a pair can be far apart
    only if one of the two has fewer than half of the others as neighbours. Balls are grown from those
    vertices alone, and only inside components that pass the density filter.
    """
    comp = components.select(F.col(key).alias("id"), "component", "size").where(F.col("size") >= min_size)
    inside = edges.select("src", "dst").join(comp, F.col("src") == F.col("id"))
    dens = inside.groupBy("component", "size").agg(F.count("*").alias("m")).withColumn(
        "density", F.col("m") / (F.col("size") * (F.col("size") - 1)))
    dense = dens.where(F.col("density") > min_density)
    kept = inside.join(dense.select("component"), "component", "left_semi").select("component", "size", "src", "dst")
    sparse = kept.groupBy("component", "size", F.col("src").alias("a")).agg(F.count("*").alias("d")).where("2 * d < size - 1")
    links = kept.select(F.col("src").alias("b"), F.col("dst").alias("c"))
    reach = sparse.select("component", "size", "a", F.col("a").alias("b"))
    for _ in range(max_diameter):
        step = reach.join(links, "b").where("a <> c").select("component", "size", "a", F.col("c").alias("b"))
        reach = reach.unionByName(step).distinct()
    far = reach.groupBy("component", "size", "a").agg(F.count("*").alias("n")).where("n < size")
    return dense.join(far.select("component").distinct(), "component", "left_anti").select("component", "size", "density")


def star_and_ring(features: DataFrame, tri: DataFrame, four: DataFrame, key: str, min_degree: int = 5, max_clustering: float = 0.1) -> DataFrame:
    """Star centres (many neighbours, hardly linked to each other) and members of closed rings of three and of four.

    ``features`` are those of ``neighbour_features``, ``tri`` and ``four`` the results of ``triangles`` and ``squares``.
    """
    tri, four = tri.select(F.col("id").alias("_tri"), "triangles"), four.select(F.col("id").alias("_four"), "squares")
    t = features.join(tri, F.col(key) == F.col("_tri"), "left").join(four, F.col(key) == F.col("_four"), "left")
    rings, rings4 = F.coalesce("triangles", F.lit(0)), F.coalesce("squares", F.lit(0))
    return t.select(
        key, ((F.col("degree") >= min_degree) & (F.col("clustering") <= max_clustering)).alias("is_star"),
        (rings > 0).alias("in_ring"), rings.alias("n_rings_of_3"), rings4.alias("n_rings_of_4"))


def random_walks(edges: DataFrame, vertices: DataFrame, key: str, length: int = 5, walks: int = 1, seed: int = 42) -> DataFrame:
    """(key, walk, path). A vertex's neighbours are numbered, and a step draws a number from the hash of
    the walk and the step: an equi-join on (vertex, number), never a row per neighbour."""
    hashed = edges.select("src", "dst", hash_int("dst", "neighbour").alias("_h"))
    numbered = row_positions(hashed, "_h", "dst", ["src"], descending=False).withColumn("_i", F.col("pos") - 1)
    numbered = cut_lineage(numbered.select("src", "dst", "_i"))  # every step joins it
    deg = cut_lineage(edges.groupBy("src").agg(F.count("*").alias("_deg")))
    state = vertices.select(
        F.col(key).alias("start"), F.explode(F.sequence(F.lit(1), F.lit(walks))).alias("walk"), F.col(key).alias("at"),
        F.array(F.col(key)).alias("path"))
    nxt = numbered.select(F.col("src").alias("_s"), F.col("_i").alias("_pick"), F.col("dst").alias("_next"))
    for step in range(length - 1):
        state = state.join(deg, F.col("at") == F.col("src"), "left").drop("src")
        pick = hash_int(F.concat_ws("|", "start", "walk", F.lit(step)), seed) % F.col("_deg")
        state = state.withColumn("_want", pick).join(nxt, (F.col("at") == F.col("_s")) & (F.col("_want") == F.col("_pick")), "left")
        state = state.select(
            "start", "walk", F.coalesce("_next", "at").alias("at"),
            F.when(F.col("_next").isNull(), F.col("path")).otherwise(F.concat("path", F.array("_next"))).alias("path"))
    return state.select(F.col("start").alias(key), "walk", "path")
