"""Exact distances of the recall come from tiles of bounded size, without a broadcast of the queries."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from loanloom.operators import neighbours


def brute(x, ids, q):
    return {k: min(((x[i] - x[j]) ** 2).sum() for j in range(len(x)) if ids[j] != k for i in [ids.index(k)]) for k in q}


def test_queries_are_not_broadcast(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(300, 4))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    found = neighbours.nearest_neighbours(df, "id", "v", 4).cache()
    out = neighbours.recall(found, df, "id", "v", F.col("id") % 3 == 0)
    assert out.first().asDict() == {"n_queries": 100, "hits": 100}
    lines = out._jdf.queryExecution().executedPlan().toString().splitlines()
    # neither rows nor queries with their vectors are sent to every task
    assert not [b for a, b in zip(lines, lines[1:]) if "BroadcastExchange" in a and "qx" in b]


def test_tiles_give_the_least_distance(spark, monkeypatch):
    for name, value in (("QUERY_BLOCK", 7), ("ROW_BLOCK", 11)):
        monkeypatch.setattr(neighbours, name, value)
    r = np.random.default_rng(4)
    x = r.normal(size=(90, 3))
    x[:30] = x[0]  # a third of the rows is one vector
    x[40] *= 1e9
    ids = list(range(90))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)] + [(5, x[5].tolist()), (None, x[5].tolist())], "id long, v array<double>")
    want = brute(x, ids, ids)
    table = [(i, (i + 1) % 90, float(d) if i % 2 else float(d) * 1.001 + 1e-3, 1) for i, d in want.items()]
    found = spark.createDataFrame(table, "id long, other long, d double, rank int")
    assert neighbours.recall(found, df, "id", "v", F.lit(True)).first().asDict() == {"n_queries": 90, "hits": 45}


def test_vectors_that_are_not_whole(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 0.0]), (2, [3.0, 4.0]), (3, [nan, 0.0]), (4, [inf, 0.0]), (5, None), (6, [1.0]), (7, [1.0, None]), (8, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    found = spark.createDataFrame([(1, 8, 1.0, 1), (2, 8, 18.0, 1), (8, 1, 1.0, 1), (6, 1, 0.0, 1), (5, 1, 0.0, 1), (4, 1, inf, 1)], "id long, other long, d double, rank int")
    out = neighbours.recall(found, df, "id", "v", F.lit(True)).first()
    assert (out.n_queries, out.hits) == (8, 4)  # 1, 2, 8 and the infinite one
    alone = neighbours.recall(found, df.where("id = 1"), "id", "v", F.lit(True)).first()
    assert (alone.n_queries, alone.hits) == (0, 0)


def test_many_equal_candidates_are_subtracted_in_parts(monkeypatch):
    monkeypatch.setattr(neighbours, "PAIR_ROWS", 10)
    monkeypatch.setattr(neighbours, "QUERY_TILE", 4)
    x = np.random.default_rng(5).integers(0, 2, (60, 3)).astype(float)
    ids = list(range(60))
    lists = pa.array(x.tolist(), pa.list_(pa.float64()))
    out = neighbours.least_distances(pa.table([pa.array(ids), lists], ["id", "x"]), pa.table([pa.array(ids), lists], ["q", "qx"]))
    assert dict(zip(out.column("q").to_pylist(), out.column("least").to_pylist())) == brute(x, ids, ids)
