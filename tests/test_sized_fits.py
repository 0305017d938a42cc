"""Fits over few partitions, scores written once, one order of takers."""

import random

from pyspark.sql import functions as F

from loanloom.operators import learning


def rows_of(spark, n=400, partitions=4):
    r = random.Random(5)
    rows = [(i, float(r.randrange(6)), float(r.randrange(4)), int(r.random() < 0.3)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, a double, b double, y int").repartition(partitions)


def test_fits_run_on_few_partitions(spark):
    df = rows_of(spark, 400, 50)
    held, rows, n = learning.training_rows(df)
    assert n == 400 and rows.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert sorted(rows.collect()) == sorted(df.collect())
    held.unpersist()
    assert [learning.fits_at_once(n, 8) for n in (0, 900_000, 9_000_000, 54_000_000)] == [8, 8, 2, 1]


def test_out_of_fold_scores_are_written_once(spark):
    r = learning.fit_out_of_fold(rows_of(spark), ["a", "b"], "y", "id", None, 3, learning.boosted(2, 2))
    assert r.oof.inputFiles()
    assert [x.n for x in r.oof.groupBy("id").agg(F.count("*").alias("n")).collect()] == [1] * 400


def test_takers_are_ordered_once(spark, monkeypatch):
    ordered, positions = [], learning.row_positions
    monkeypatch.setattr(learning, "row_positions", lambda *a, **k: ordered.append(a) or positions(*a, **k))
    df = rows_of(spark)
    m = learning.boosted(2, 2).fit(learning.assemble(df.withColumn("label", F.col("y").cast("double")), ["a", "b"], ["label"]))
    out = learning.permutation_importance(m, df, ["a", "b"], "y", "id")
    assert out.count() == 2 and len(ordered) == 3
