"""Nearest neighbours of vectors without all pairs, and the resampling built on them: Tomek links and SMOTE.

Each round projects the vectors on a random direction, puts the projections in order by the sliced row positions and cuts the
order into slices of equally many rows. A block is two neighbouring slices; the pairs inside a block are compared exactly and
each row keeps its nearest few. Blocks hold a fixed number of rows whatever the data look like: a dense region, or a third of all
rows with one vector, is cut by position like everything else. A row's neighbours are the best over the rounds. Up to ``slice_rows``
rows there is one block and the result is exact; beyond it rounds trade time for recall, and ``recall`` measures it against all
rows for a stated set of queries.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from loanloom.functions.hashing import hash_int, hash_unit
from loanloom.operators.ordering import double_array, row_positions
from loanloom.session import cut_lineage

SLICE_ROWS, ROUNDS = 1024, 8
#: queries and rows of a tile of exact distances; queries, and pairs to be subtracted, that are worked on at once
QUERY_BLOCK, ROW_BLOCK, QUERY_TILE, PAIR_ROWS = 4096, 16384, 256, 1 << 16
PAIRS_SCHEMA = "id long, other long, d double"


def _directions(dims: int, rounds: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((rounds, dims))


def projection(vector: str, direction: Sequence[float]) -> Column:
    return F.aggregate(F.zip_with(vector, double_array(direction), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)


def nearest_of_block(ids: np.ndarray, x: np.ndarray, k: int) -> pd.DataFrame:
    """(id, other, d): the k nearest other rows of each row, squared distance, equal ones by the lower id."""
    n = len(ids)
    if n < 2:
        return pd.DataFrame({"id": [], "other": [], "d": []}).astype({"id": "int64", "other": "int64"})
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    norm = (x * x).sum(axis=1)
    out = []
    few = min(k + 8, n - 1)
    for at in range(0, n, 256):
        rows = np.arange(at, min(at + 256, n))
        d = norm[rows][:, None] + norm[None, :] - 2 * (x[rows] @ x.T)
        d[np.arange(len(rows)), rows] = np.inf
        # matrix products choose the candidates (all that are as near as the last one up to rounding), differences decide
        edge = np.partition(d, few - 1, axis=1)[:, few - 1]
        slack = 1e-9 * (norm[rows] + norm.max() + 1)
        who, other = np.nonzero(d <= (edge + slack)[:, None])
        real = ((x[rows[who]] - x[other]) ** 2).sum(axis=1)
        by = np.lexsort((other, real, who))
        who, other, real = who[by], other[by], real[by]
        rank = np.arange(len(who)) - np.searchsorted(who, who, "left")
        keep = rank < k
        out.append(pd.DataFrame({"id": ids[rows[who[keep]]], "other": ids[other[keep]], "d": real[keep]}))
    return pd.concat(out)


def nearest_neighbours(
    vectors: DataFrame, key: str, vector: str, dims: int, k: int = 1, rounds: int = ROUNDS, slice_rows: int = SLICE_ROWS, seed: int = 42,
) -> DataFrame:
    """(id, other, d, rank): the k nearest rows found for each row with a whole vector; d is the squared distance. Keys are unique."""
    whole = F.col(vector).isNotNull() & (F.size(vector) == dims) & F.forall(vector, lambda v: F.coalesce(~F.isnan(v.cast("double")), F.lit(False)))
    rows = cut_lineage(vectors.where(whole).select(F.col(key).cast("long").alias("id"), F.transform(vector, lambda v: v.cast("double")).alias("x")))
    n = rows.count()
    last = max(0, (n - 1) // slice_rows)
    found = None
    for r, direction in enumerate(_directions(dims, rounds if last else 1, seed)):
        placed = row_positions(rows.withColumn("_p", projection("x", direction)), "_p", "id", descending=False)
        slot = F.floor((F.col("pos") - 1) / slice_rows)
        blocks = F.array_distinct(F.array(F.greatest(slot - 1, F.lit(0)), F.least(slot, F.lit(max(last - 1, 0)))))
        spread = placed.select("id", "x", F.explode(blocks).alias("block"))
        pairs = spread.groupBy("block").applyInPandas(
            lambda p: nearest_of_block(p["id"].to_numpy(), np.stack(p["x"].to_numpy()), k), PAIRS_SCHEMA)
        found = pairs if found is None else found.unionByName(pairs)
        if r % 4 == 3:  # keep the plan short and the rows few
            found = cut_lineage(_best(found, k).drop("rank"))
    return _best(found, k)


def _best(pairs: DataFrame, k: int) -> DataFrame:
    """The k nearest of each row; the rank filter also runs before the shuffle of the window."""
    each = pairs.groupBy("id", "other").agg(F.min("d").alias("d"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy("d", "other"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k)


def least_distances(rows: pa.Table, asked: pa.Table) -> pa.Table:
    """(q, least): per query of ``asked`` (q, qx) the least squared distance to a row of ``rows`` (id, x) with another id. Vectors of
    different lengths have no distance; one that is not a number is above all others, as in SQL."""
    found = {}
    ids, q = rows.column("id").to_numpy(), asked.column("q").to_numpy()
    lengths, own = (t.column(c).combine_chunks().value_lengths().to_numpy() for t, c in ((rows, "x"), (asked, "qx")))
    values, wanted = (t.column(c).combine_chunks().flatten().to_numpy() for t, c in ((rows, "x"), (asked, "qx")))
    for dims in np.unique(own):
        to, by = np.repeat(lengths == dims, lengths), np.repeat(own == dims, own)
        all_ids, all_q = ids[lengths == dims], q[own == dims]
        x, qx = (v.reshape(len(n), dims) for v, n in ((values[to], all_ids), (wanted[by], all_q)))
        odd = ~np.isfinite(x).all(axis=1)  # matrix products would spread what is not finite
        norm = np.where(odd, 0, (np.where(odd[:, None], 0, x) ** 2).sum(axis=1))
        for at in range(0, len(all_q), QUERY_TILE):
            some, names = qx[at:at + QUERY_TILE], all_q[at:at + QUERY_TILE]
            whole = np.isfinite(some).all(axis=1)
            safe = np.where(whole[:, None], some, 0)
            size = (safe ** 2).sum(axis=1)
            d = size[:, None] + norm[None, :] - 2 * (safe @ np.where(odd[:, None], 0, x).T)
            d[:, odd] = np.inf
            other = names[:, None] != all_ids[None, :]
            d[~other] = np.inf
            slack = 1e-9 * (size + norm.max(initial=0) + 1)
            near = d <= (d.min(axis=1, initial=np.inf) + slack)[:, None]  # matrix products choose the candidates, differences decide
            near |= odd[None, :] | ~whole[:, None]
            who, row = np.nonzero(near & other)
            for a in range(0, len(who), PAIR_ROWS):
                w = who[a:a + PAIR_ROWS]
                with np.errstate(invalid="ignore", over="ignore"):
                    real = ((some[w] - x[row[a:a + PAIR_ROWS]]) ** 2).sum(axis=1)
                first = np.flatnonzero(np.diff(w, prepend=-1))
                for k, v in zip(names[w[first]].tolist(), np.fmin.reduceat(real, first).tolist()):
                    found[k] = float(np.fmin(found.get(k, np.nan), v))
    return pa.table([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.float64())], ["q", "least"])


def recall(found: DataFrame, vectors: DataFrame, key: str, vector: str, queries: Column) -> DataFrame:
    """(n_queries, hits): of the rows that ``queries`` picks, how many have their exact nearest neighbour among those found.

    The queries are compared with all rows, in tiles of about QUERY_BLOCK queries and ROW_BLOCK rows that meet by key: no task grows
    with either, and nothing is broadcast. The pairs are as many as rows times queries; a tile's are matrix products.
    """
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.transform(vector, lambda v: v.cast("double")).alias("x"))
    rows = rows.where("id IS NOT NULL")
    asked = cut_lineage(rows.where(queries).select(F.col("id").alias("q"), F.col("x").alias("qx")).distinct())
    others = rows.select("id").distinct().limit(2).count() > 1  # else no query has another row
    blocks, slots = max(1, -(-asked.count() // QUERY_BLOCK)), max(1, -(-rows.count() // ROW_BLOCK))
    number = lambda c, x, n: F.pmod(F.xxhash64(c, x), F.lit(n))
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    known = lambda x: F.forall(x, lambda v: v.isNotNull())
    left = rows.where(known("x")).distinct().withColumn("slot", number("id", "x", slots)).withColumn("block", spread(blocks))
    right = asked.where(known("qx")).withColumn("block", number("q", "qx", blocks)).withColumn("slot", spread(slots))
    tiles = left.groupBy("block", "slot").cogroup(right.groupBy("block", "slot"))
    exact = tiles.applyInArrow(least_distances, "q long, least double").groupBy("q").agg(F.min("least").alias("least"))
    best = found.where("rank = 1").select(F.col("id").alias("q"), F.col("d").alias("mine"))
    both = asked.where(F.lit(others)).select("q").distinct().join(exact, "q", "left").join(best, "q", "left")
    return both.agg(F.count("*").alias("n_queries"), F.count_if(F.col("mine") <= F.col("least") * (1 + 1e-9)).alias("hits"))


def tomek_links(vectors: DataFrame, key: str, vector: str, label: str, dims: int, **how) -> DataFrame:
    """(a, b, label_a, label_b, d), a < b: pairs of different labels that are each other's nearest neighbour."""
    near = cut_lineage(nearest_neighbours(vectors, key, vector, dims, 1, **how).select("id", "other", "d"))
    back = near.select(F.col("id").alias("other"), F.col("other").alias("id"))
    mutual = near.join(back, ["id", "other"]).where("id < other")
    one, two = (vectors.select(F.col(key).cast("long").alias(side), F.col(label).alias(f"label_{side}")) for side in ("a", "b"))
    out = mutual.select(F.col("id").alias("a"), F.col("other").alias("b"), "d").join(one, "a").join(two, "b")
    return out.where("label_a <> label_b").select("a", "b", "label_a", "label_b", "d")


def smote(vectors: DataFrame, key: str, vector: str, label: str, minority, dims: int, copies: int = 1, k: int = 5, seed: int = 42, **how) -> DataFrame:
    """(source, other, copy, vector): ``copies`` synthetic rows per row of the minority, between it and one of its k nearest rows of
    the minority. Neighbour and place on the way follow from the hash of key, copy and seed, so every run gives the same rows."""
    rare = vectors.where(F.col(label) == minority)
    near = cut_lineage(nearest_neighbours(rare, key, vector, dims, k, seed=seed, **how))
    most = near.groupBy("id").agg(F.max("rank").alias("n"))
    name = F.concat_ws("|", "id", "copy")
    wanted = most.select("id", "n", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy")).select(
        "id", "copy", (hash_int(name, f"{seed}pick") % F.col("n") + 1).alias("rank"), hash_unit(name, f"{seed}gap").alias("gap"))
    one, two = (rare.select(F.col(key).cast("long").alias(side), F.transform(vector, lambda v: v.cast("double")).alias(f"x_{side}")) for side in ("id", "other"))
    picked = wanted.join(near.select("id", "rank", "other"), ["id", "rank"]).join(one, "id").join(two, "other")
    between = F.transform(F.arrays_zip("x_id", "x_other"), lambda p: p["x_id"] + F.col("gap") * (p["x_other"] - p["x_id"]))
    return picked.select(F.col("id").alias("source"), "other", "copy", between.alias("vector"))
