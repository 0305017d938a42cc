"""Tokens are shuffled once; regions that lie inside another one are not joined again."""

from pyspark.sql import functions as F

from loanloom.llm import jaccard_join


def test_regions_of_tokens_across_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = [(rep, rep * 10, token) for token, reps in ((-5, range(20)), (1, [4]), (2, [7, 3, 9]), (8, [5])) for rep in reps]
        tokens = spark.createDataFrame(rows, "rep long, n int, token long")
        plan = jaccard_join._regions(tokens)
        got = {tuple(r) for r in plan.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {(0, r, r * 10) for r in range(20)} | {(3, r, r * 10) for r in (3, 7, 9)}
    assert jaccard_join._regions(tokens)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert jaccard_join._regions(tokens.where("rep < 0")).count() == 0


def test_regions_inside_another_are_left_out(spark):
    regions = {1: [1, 2, 3, 4], 2: [2, 3], 3: [3, 4, 9], 4: [4, 9], 5: [5, 6], 9: [9, 3]}
    near = spark.createDataFrame([(r, m, 0) for r, ms in regions.items() for m in ms], "region long, rep long, side int")
    left = {r["region"]: sorted(r["m"]) for r in jaccard_join._outer(near).groupBy("region").agg(F.collect_list("rep").alias("m")).collect()}
    assert 2 not in left and all(left[r] == sorted(regions[r]) for r in left)
    pairs = lambda table: {(a, b) for ms in table.values() for a in ms for b in ms}
    assert pairs(left) == pairs(regions)
    # members of one side are not compared with each other: such a region stands for no other one
    sided = near.withColumn("side", F.expr("IF(region = 1, IF(rep < 3, 1, 2), 0)"))
    assert jaccard_join._outer(sided).where("region = 2").count() == 2
