"""Clustering around centroids with JVM-native expressions (Lloyd's rounds on integers).

Vectors become integer arrays once and are written. In a round the centroids are one literal array in the plan: ``zip_with``
and ``aggregate`` give the squared distance to each, ``array_min`` of (distance, number) structs the nearest one (ties: the
smaller number), and one generated aggregate of a sum per component, combined in every task before its shuffle, gives at most
``k`` rows from which the next centroids are divided. All numbers are integers, so results depend on neither the partitioning
nor the order of rows, and a task that runs again gives the same sums. The driver holds the centroids only: k x dims numbers.

Defined cases. Left out: null vectors, other lengths, vectors with a null, NaN or infinite component. Repeated rows and
ids: each row is a vector of its own; among the first centroids equal ids are ordered by their components, and null ids come
after all others. Fewer vectors than ``k``: as many centroids as vectors. No vectors: no centroids, an empty result. Components
are clamped to +-2^27 (x beyond +-524,288): larger ones have no squared distance in a long. Sums of distances beyond a long
are null. Columns of the input other than the id and the vector are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.llm.common import written

DIMS, SCALE, CLUSTERS, ROUNDS = 64, 256, 40, 5
#: components lie within +-CLAMP, so that DIMS x (2 x CLAMP)^2 fits a long
CLAMP = 1 << 27

Centroids = Sequence[Sequence[int]]


def quantised(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component, of the rows whose vector is whole."""
    x = F.transform(F.col(column), lambda c: c.cast("double"))
    whole = (F.size(column) == dims) & F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    steps = F.transform(x, lambda c: F.floor(F.least(F.greatest(c * scale, F.lit(float(-CLAMP))), F.lit(float(CLAMP)))).cast("long"))
    return vectors.where(F.col(column).isNotNull() & whole).select(F.col(id_column).alias("vec_id"), steps.alias("v"))


def first_centroids(kept: DataFrame, k: int = CLUSTERS, salt: str = "2") -> list[list[int]]:
    """The k vectors whose ``salt:id`` has the smallest sha256, in the order of the hashes."""
    named = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    return [list(r.v) for r in kept.select(named.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()]


def nearest(centroids: Centroids, v: str = "v") -> Column:
    """Struct (distance, cluster) of the nearest centroid; ``array_min`` compares the distance first, then the number.

    |v - c|^2 = |v|^2 + |c|^2 - 2 v.c: |c|^2 stands in the plan, |v|^2 is added to the least only.
    """
    # folded into one literal when the plan is optimised; thousands of single ones would have to be analysed
    literal = ", ".join(f"({sum(x * x for x in c)}L, {i}, cast(split('{','.join(str(-2 * x) for x in c)}', ',') AS array<bigint>))"
                        for i, c in enumerate(centroids))
    least = F.expr(f"""array_min(transform(array({literal}), c -> struct(
        aggregate(zip_with({v}, c.col3, (a, b) -> a * b), c.col1, (s, d) -> s + d) AS distance, c.col2 AS cluster)))""")
    own = F.aggregate(F.transform(v, lambda a: a * a), F.lit(0).cast("long"), lambda s, d: s + d)
    return F.struct((least.getField("distance") + own).alias("distance"), least.getField("cluster").alias("cluster"))


def moved(kept: DataFrame, centroids: Centroids) -> list[list[int]]:
    """The centroids after one round: componentwise floor of the mean; one without vectors stays."""
    dims = range(len(centroids[0]))
    assigned = kept.select(nearest(centroids).getField("cluster").alias("cluster"), *[F.col("v")[j].alias(f"v{j}") for j in dims])
    sums = assigned.groupBy("cluster").agg(F.count("*").alias("n"), *[F.sum(f"v{j}").alias(f"s{j}") for j in dims])
    out = [list(c) for c in centroids]
    for r in sums.collect():  # at most k rows
        out[r.cluster] = [r[f"s{j}"] // r.n for j in dims]
    return out


def clusters(kept: DataFrame, start: Centroids, rounds: int = ROUNDS) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of every vector of ``kept`` after ``rounds`` rounds, and the final centroids."""
    centroids = [list(c) for c in start]
    if not centroids:
        return kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), centroids
    for _ in range(rounds):
        after = moved(kept, centroids)
        if after == centroids:
            break
        centroids = after
    return kept.select("vec_id", nearest(centroids).alias("near")).select("vec_id", "near.cluster", "near.distance"), centroids


def summary(assigned: DataFrame, centroids: Centroids) -> DataFrame:
    """One row per non-empty cluster: cluster, n_vectors, cluster_inertia, inertia (of all), centroid_sha256, centroid."""
    each = assigned.groupBy("cluster").agg(F.count("*").alias("n"), F.try_sum("distance").alias("own"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("exact"))
    rows = each.collect()  # at most k rows
    whole = sum(int(r.exact) for r in rows)
    named = [(r.cluster, r.n, r.own, whole if whole < 1 << 63 else None, hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest(),
              list(centroids[r.cluster])) for r in rows]
    return assigned.sparkSession.createDataFrame(
        named, "cluster int, n_vectors long, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<long>")


def clustered(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """vec_id, cluster, distance and the cluster's summary for every whole vector of a table (vec_id, embedding)."""
    kept = written(quantised(vectors, dims=dims, scale=scale), "vectors")
    assigned, centroids = clusters(kept, first_centroids(kept, k), rounds)
    assigned = written(assigned, "assigned")
    return assigned.join(F.broadcast(summary(assigned, centroids)), "cluster")  # at most k rows
