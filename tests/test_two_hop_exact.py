"""Counts of two hops are exact however many paths a vertex has."""

import random

import pytest
from pyspark.sql import functions as F

from loanloom.operators import graph


def test_feature_table_counts_a_hub_of_many_paths(spark):
    """Vertex 0, 300 middles, 400 leaves a middle: 120,300 paths from 0."""
    middle = spark.range(1, 301).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"))
    leaf = spark.range(120_000).select((F.col("id") % 300 + 1).alias("src"), (F.col("id") + 1000).alias("dst"))
    one = middle.unionByName(leaf)
    edges = one.unionByName(one.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).withColumn("weight", F.lit(1.0))
    vertices = edges.select(F.col("src").alias("id")).distinct().withColumn("bad", F.lit(0))
    out = graph.graph_feature_table(edges, vertices, "id", "bad")
    kind = F.when(F.col("id") == 0, "hub").when(F.col("id") <= 300, "middle").otherwise("leaf")
    got = {(r.kind, r.n_two_hop_neighbors): r["count"] for r in out.groupBy(kind.alias("kind"), "n_two_hop_neighbors").count().collect()}
    assert got == {("hub", 120_000): 1, ("middle", 299): 300, ("leaf", 400): 120_000}


@pytest.mark.parametrize("most,width,places,takers,names", [(3, 8, 2, 2, False), (3, 16, 16, 1, True), (0, 8, 0, 3, False)])
def test_pieces_count_every_end_once(spark, monkeypatch, most, width, places, takers, names):
    for name, value in (("TWO_HOP_PATHS", most), ("PIECE", width), ("PIECE_PLACES", places), ("PIECE_TAKERS", takers)):
        monkeypatch.setattr(graph, name, value)
    r = random.Random(6)
    pairs = {(r.randrange(40), r.randrange(40)) for _ in range(90)} | {(0, i) for i in range(1, 40)} | {(i, 0) for i in range(1, 40, 2)}
    said = (lambda i: f"k{i}") if names else (lambda i: i)  # links may lead one way, keys may be text, links may repeat or be null
    rows = [(said(a), said(b)) for a, b in pairs] + [(said(0), said(1)), (said(5), said(5)), (None, said(1)), (said(1), None)]
    kind = "string" if names else "long"
    limit = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        edges = spark.createDataFrame(rows, f"src {kind}, dst {kind}")
        vertices = spark.createDataFrame([(said(i),) for i in range(45)], f"id {kind}")
        got = {x.id: (x.n_two_hop, x.exact) for x in graph.two_hop_counts(edges, vertices, "id").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", limit)
    near = {v: {b for a, b in pairs if a == v != b} for v in range(45)}
    assert got == {said(v): (len(set().union(*[near[m] for m in near[v]]) - {v}) if near[v] else 0, True) for v in range(45)}
