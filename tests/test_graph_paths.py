"""Counts over paths of two edges."""

import random
import re

import numpy as np

from loanloom.operators import graph


def test_two_hops_make_no_row_per_path(spark):
    r = random.Random(3)
    pairs = {(r.randrange(20), r.randrange(20)) for _ in range(40)} | {(0, i) for i in range(1, 12)}
    both = sorted({(a, b) for a, b in pairs if a != b} | {(b, a) for a, b in pairs if a != b})
    out = graph.two_hop_counts(spark.createDataFrame(both, "src long, dst long"), spark.range(25), "id")
    assert not re.search(r"Aggregate \[v#\d+L?, w#", out._jdf.queryExecution().optimizedPlan().toString())
    far = {v: {c for a, b in both if a == v for x, c in both if x == b and c != v} for v in range(25)}
    assert {x.id: x.n_two_hop for x in out.collect()} == {v: len(n) for v, n in far.items()}


def test_paths_of_squares_are_not_written(spark, monkeypatch):
    written, cut = [], graph.cut_lineage
    monkeypatch.setattr(graph, "cut_lineage", lambda df: written.append(df.columns) or cut(df))
    edges = spark.createDataFrame([(a, b) for a in range(5) for b in range(5) if a != b], "src long, dst long")
    found = {x.id: x.squares for x in graph.squares(edges).collect()}
    assert found == dict.fromkeys(range(5), 12) and ["v", "u", "w"] not in written


def test_a_hub_fills_many_batches(spark):
    """A vertex with more neighbours than a batch holds, neighbours that are no vertices, and vertices nobody leads to."""
    limit = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        pairs = [(0, i) for i in range(1, 60)] + [(i, 0) for i in range(1, 30)] + [(3, 4), (3, 4), (4, 3), (5, 5), (6, 99), (98, 6)]
        edges = spark.createDataFrame([(a, b) for a, b in pairs] + [(None, 1), (1, None)], "src long, dst long")
        vertices = spark.range(70).withColumnRenamed("id", "v")
        seeds = {x.v: np.array(x.s) for x in vertices.select("v", graph.seed_vector("v", 40, 7).alias("s")).collect()}
        got = {x.v: x.vector for x in graph.walk_embeddings(edges, vertices, "v", size=40, rounds=3, seed=7).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", limit)
    far = {v: {b for a, b in pairs if a == v and b != v and b in seeds} for v in seeds}
    for k in range(3):
        seeds = {v: sum(seeds[b] for b in far[v]) // len(far[v]) if far[v] else np.zeros(40, int) for v in far}
        assert {v: x[40 * k:40 * (k + 1)] for v, x in got.items()} == {v: (x / graph.EMBEDDING_ONE).tolist() for v, x in seeds.items()}


def test_embeddings_send_no_sums_of_every_component(spark, monkeypatch):
    written = []
    monkeypatch.setattr(graph, "cut_lineage", lambda df: written.append(df) or df)
    edges = spark.createDataFrame([(1, 2), (2, 1)], "src long, dst long")
    graph.walk_embeddings(edges, spark.range(4).withColumnRenamed("id", "v"), "v", size=64, rounds=2)
    assert all(f.dataType.simpleString() in ("bigint", "binary") for df in written for f in df.schema)
    assert all("sum(" not in df._jdf.queryExecution().optimizedPlan().toString() for df in written)


def test_links_of_a_rank_are_dealt_once(spark, monkeypatch):
    rounds, write = [], graph.cut_lineage

    def spied(df):
        if "_was" in df.columns:
            rounds.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df)

    monkeypatch.setattr(graph, "cut_lineage", spied)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edges = spark.createDataFrame([(0, 1), (1, 0), (1, 2), (2, 1)], "src long, dst long")
        ranks = {x.v: x["rank"] for x in graph.page_rank(edges, spark.range(4).withColumnRenamed("id", "v"), "v", rounds=3).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert abs(sum(ranks.values()) - 1) < 1e-9 and ranks[1] > ranks[0] == ranks[2] > ranks[3]
    assert len(rounds) == 3 and not any(re.search(r"hashpartitioning\(src#\d+L, \d+\), ENSURE", plan) for plan in rounds)
