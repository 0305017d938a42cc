"""Cycles, vertex embeddings, wide rank blends and trailing counts on streams."""

import itertools
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loanloom.operators import graph, profiling, ranking
from loanloom.streaming import monitors


def graph_of(spark, pairs):
    both = sorted({(a, b) for a, b in pairs if a != b} | {(b, a) for a, b in pairs if a != b})
    return both, spark.createDataFrame([(a, b, 1.0) for a, b in both], "src long, dst long, weight double").repartition(3)


@pytest.mark.parametrize("seed,chunk", [(1, 1024), (2, 3), (3, 1)])
def test_rings_of_three_and_four(spark, seed, chunk):
    r = random.Random(seed)
    pairs = [(r.randrange(18), r.randrange(18)) for _ in range(50)] + [(0, i) for i in range(1, 18)]  # 0 is a hub
    both, edges = graph_of(spark, pairs)
    near = {v: {b for a, b in both if a == v} for v in range(18)}
    three, four = dict.fromkeys(range(18), 0), dict.fromkeys(range(18), 0)
    for c in itertools.combinations(range(18), 3):
        if all(b in near[a] for a, b in itertools.combinations(c, 2)):
            for v in c:
                three[v] += 1
    for a, b, c, d in itertools.permutations(range(18), 4):
        if a == min(a, b, c, d) and b < d and b in near[a] and c in near[b] and d in near[c] and a in near[d]:
            for v in (a, b, c, d):
                four[v] += 1
    ranked = graph.ranked_edges(edges)
    assert {x.id: x.triangles for x in graph.triangles(edges, ranked).collect()} == {v: n for v, n in three.items() if n}
    assert {x.id: x.squares for x in graph.squares(edges, ranked, chunk).collect()} == {v: n for v, n in four.items() if n}


def test_no_edges_no_rings(spark):
    none = spark.createDataFrame([], "src long, dst long, weight double")
    assert graph.squares(none).count() == 0 and graph.triangles(none).count() == 0


def test_embeddings_do_not_depend_on_partitions(spark):
    r = random.Random(8)
    both, edges = graph_of(spark, [(r.randrange(30), r.randrange(30)) for _ in range(60)])
    vertices = spark.range(32).withColumnRenamed("id", "v")
    one = {x.v: x.vector for x in graph.walk_embeddings(edges, vertices, "v", size=40, rounds=2).collect()}
    two = {x.v: x.vector for x in graph.walk_embeddings(edges.repartition(7), vertices.repartition(5), "v", size=40, rounds=2).collect()}
    assert one == two and len(one) == 32 and all(len(x) == 80 for x in one.values())
    assert one[31] == [0.0] * 80  # isolated
    seeds = {x.v: np.array(x.s) for x in vertices.select("v", graph.seed_vector("v", 40, 42).alias("s")).collect()}
    for v in {a for a, _ in both}:
        mean = np.mean([seeds[b] for a, b in both if a == v], axis=0) / graph.EMBEDDING_ONE
        np.testing.assert_allclose(one[v][:40], mean, atol=2e-6)
    share = np.mean([np.mean(np.array(s) != 0) for s in seeds.values()])
    assert 0.3 < share < 0.45


def test_blend_of_ten_scores_scans_a_fixed_number_of_times(spark):
    rng = np.random.default_rng(1)
    p = pd.DataFrame(rng.integers(0, 9, (200, 10)).astype(float), columns=[f"s{i}" for i in range(10)]).assign(id=range(200))
    p.loc[::5, "s3"] = None
    df = spark.createDataFrame(p)
    few, many = (ranking.rank_blend(df, [f"s{i}" for i in range(k)], "id") for k in (2, 10))
    scans = [x._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") for x in (few, many)]
    assert scans[0] == scans[1]
    got = many.toPandas().set_index("id").sort_index()["blend"]
    want = sum(p[f"s{i}"].rank(pct=True) for i in range(10)) / 10
    np.testing.assert_allclose(got, want.where(p["s3"].notna()))


def test_ranks_of_repeated_keys(spark):
    df = spark.createDataFrame([(1, 3.0), (1, 1.0), (None, 2.0), (1, 3.0), (2, None)], "id long, a double")
    got = sorted((str(r.id), str(r.a), r.blend) for r in ranking.rank_blend(df, ["a"], "id").collect())
    assert got == sorted([("1", "3.0", 0.875), ("1", "3.0", 0.875), ("1", "1.0", 0.25), ("None", "2.0", 0.5), ("2", "None", None)])


def test_matrix_cells(spark):
    long = spark.createDataFrame([("a", 1, 0.5), ("a", 3, 0.25), ("b", 2, 1.0), (None, 1, 0.0), ("c", None, 9.0)], "r string, c int, v double")
    got = {x.r: [(y.c, y.v) for y in x.cells] for x in profiling.matrix_cells(long, "r", "c", "v").collect()}
    assert got == {"a": [(1, 0.5), (2, None), (3, 0.25)], "b": [(1, None), (2, 1.0), (3, None)], None: [(1, 0.0), (2, None), (3, None)]}


def trailing(rows, window):
    seconds = sorted({(e, t) for e, t in rows if e is not None})
    return sorted((e, t, sum(1 for f, u in seconds if f == e and t - window < u <= t)) for e, t in seconds)


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_counts_over_batches_out_of_order(spark, tmp_path, seed):
    r = random.Random(seed)
    start, window = 1_700_000_000, 60
    rows = [(r.choice([1, 1, 1, 1, 2, 3, None]), start + int(r.expovariate(1 / 400)) + r.randrange(1200)) for _ in range(400)]
    rows += [(7, start + 239), (7, start + 241), (8, start + 5)]  # across a bucket's end
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    table = spark.createDataFrame([(i, e, t) for i, (e, t) in enumerate(rows)], "event_id long, e long, t long").selectExpr(
        "event_id", "CAST(timestamp_seconds(t) AS timestamp_ntz) + make_dt_interval(0, 0, 0, event_id % 10 / 10.0) AS ts", "e AS user_id", "'x' AS event_type", "1D AS value",
        "IF(e IS NULL, NULL, concat('{\"k\": ', e, '}')) AS props")
    assert table.schema.simpleString() == f"struct<{schema.replace('long', 'bigint').replace(' ', ':').replace(',:', ',')}>"
    folder = monitors.replay(table.coalesce(1), "ts", "test-replay", slices=5, jitter_seconds=120, quiet="1 hour")
    events = monitors.read_events(spark, folder, "*.parquet", files_per_batch=1)
    out = monitors.run_available(monitors.exact_trailing_counts(events, "device_id", window_seconds=window, late="5 minutes"), "test-trailing", monitors.ROCKS)
    assert sorted(tuple(x) for x in out.collect()) == trailing(rows, window)
    assert not spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("RocksDBStateStoreProvider")
