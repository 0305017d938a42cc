"""Weights of evidence of categories come to the rows, which stay where they are."""

import numpy as np
import pytest

from loanloom.operators import binning, learning


def test_rows_are_not_dealt_by_category(spark):
    df = spark.range(20_000).selectExpr("id", "id % 17 + 0D AS a", "CASE WHEN id % 5 > 0 THEN substr('ab', int(id % 2) + 1, 1) END AS c", "int(id % 3 = 0) AS y").cache()
    df.count()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")  # the rows are more than that, the table is not
    try:
        model = binning.fit_woe(df, ["a"], ["c"], "y")
        out = binning.apply_woe(df, model)
        assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
        held = out.cache()
        assert min(held.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()) > 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    woe = {r["bin"]: r["woe"] for r in model.table.where("feature = 'c'").collect()}
    assert {r["c"] or "Missing": r["c_woe"] for r in held.select("c", "c_woe").distinct().collect()} == pytest.approx(woe)


def test_sums_of_all_models_at_once(spark):
    r = np.random.default_rng(2)
    rows = [(float(r.integers(2)), float(r.random()), int(r.integers(3)), *map(float, r.normal(size=2))) for _ in range(200)]
    x = spark.createDataFrame(rows, "label double, weight double, fold int, a double, b double").repartition(3)
    beta, without = r.normal(size=(4, 3)), np.array([0, 1, 2, 2])
    got = learning._fit_sums(x, ["a", "b"], without, beta)
    y, weight, fold, a, b = np.array(rows).T
    full = np.column_stack([a, b, np.ones(len(a))])
    for m in range(4):
        w, z = weight * (fold != without[m]), full @ beta[m]
        p = 1 / (1 + np.exp(-z))
        want = [w.sum(), w @ y, w @ (np.log1p(np.exp(z)) - y * z), *((w * (p - y)) @ full), *((full.T * (w * p * (1 - p))) @ full).ravel()]
        assert got[m] == pytest.approx(want)
