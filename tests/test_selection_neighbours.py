"""Wide moments, null labels, halving, neighbours, sequences: against numpy and brute force."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loanloom.operators import graph, learning, moments, neighbours, profiling, ranking, selection, timeline


def test_wide_correlations_and_vif(spark):
    rng = np.random.default_rng(2)
    k = 120
    base = rng.normal(size=(300, 6))
    x = base @ rng.normal(size=(6, k)) + rng.normal(size=(300, k)) + 1e6
    p = pd.DataFrame(x, columns=[f"c{i}" for i in range(k)])
    holes = p.mask(rng.random(p.shape) < 0.2)
    holes["c7"] = 3.0
    df = spark.createDataFrame(holes.astype(object).where(holes.notna(), None), ", ".join(f"c{i} double" for i in range(k))).repartition(4)
    got = moments.correlations(df, list(p)).collect()
    assert len(got) == k * (k - 1) // 2
    want = holes.corr().to_numpy()
    for r in got:
        w = want[r["pa"], r["pb"]]
        assert (r["r"] is None) == (np.isnan(w) or 7 in (r["pa"], r["pb"]))
        if r["r"] is not None:
            assert r["r"] == pytest.approx(w, abs=1e-8)
    few = p[[f"c{i}" for i in range(9)]] - 1e6
    vif = {r["feature"]: r["vif"] for r in moments.variance_inflation(spark.createDataFrame(few), list(few)).collect()}
    g = few.to_numpy().T @ few.to_numpy()
    np.testing.assert_allclose([vif[c] for c in few], np.diag(g) * np.diag(np.linalg.inv(g)), rtol=1e-6)


def test_plan_of_correlations_does_not_grow(spark):
    df = spark.range(3).select(*[F.rand(i).alias(f"c{i}") for i in range(60)])
    lines = [moments.pair_sums(df, [f"c{i}" for i in range(k)], centre=False)._jdf.queryExecution().executedPlan().toString().count("\n") for k in (4, 60)]
    assert lines[0] == lines[1]


def test_null_labels_are_permutations(spark):
    n = 997
    df = spark.createDataFrame([(i, int(i % 9 == 0)) for i in range(n)], "id long, y int").repartition(5)
    placed, marks = selection.shuffled_labels(df, "y", "id", 12)
    rows = placed.select("id", "_p", *[m.alias(f"m{i}") for i, m in enumerate(marks)]).toPandas()
    assert sorted(rows["_p"]) == list(range(n))
    bad = sum(i % 9 == 0 for i in range(n))
    marked = [frozenset(rows.loc[rows[f"m{i}"] == 1, "id"]) for i in range(12)]
    assert all(len(m) == bad for m in marked) and len(set(marked)) == 12
    again = selection.shuffled_labels(df.repartition(3), "y", "id", 12)[0].toPandas().set_index("id")["_p"]
    assert again.sort_index().tolist() == rows.set_index("id")["_p"].sort_index().tolist()
    overlap = [len(a & b) for i, a in enumerate(marked) for b in marked[:i]]
    assert np.mean(overlap) == pytest.approx(bad * bad / n, rel=0.35)


def test_leaking_features(spark):
    t = spark.createDataFrame([("a", 0.1), ("b", 0.5), ("c", 0.4)], "feature string, importance double")
    assert [r.feature for r in selection.leaking_features(t, 0.8, 0.7, 0.8).collect()] == ["b"]
    assert selection.leaking_features(t, 0.6, 0.7, 0.8).count() == 0
    assert selection.leaking_features(t.limit(0), 0.9).count() == 0


def test_halving_keeps_the_better_third(spark):
    seen = []

    def measure(budget, left):
        seen.append((budget, list(left)))
        return [(t * 7 % 10) + (t == 4) * budget for t in left]

    out = learning.successive_halving(spark, range(10), [1, 2, 3], measure).toPandas()
    first = sorted(range(10), key=lambda t: (-((t * 7 % 10) + (t == 4)), t))[:4]
    assert seen[1][1] == sorted(first) and len(seen[2][1]) == 2
    assert out.groupby("rung")["survived"].sum().tolist() == [4, 2, 1]


def test_boosted_search_reports_every_rung(spark):
    rng = np.random.default_rng(1)
    p = pd.DataFrame({"id": range(400), "a": rng.normal(size=400), "b": rng.normal(size=400)})
    p["y"] = (p["a"] + rng.normal(size=400) > 1).astype(int)
    out = learning.search_boosted(spark.createDataFrame(p), ["a", "b"], "y", "id", trials=4, folds=2, rungs=(1, 2)).toPandas()
    assert out.groupby("rung").size().tolist() == [4, 2] and out[out.rung == 1]["survived"].sum() == 1
    assert set(out[out.rung == 1]["trial"]) == set(out[(out.rung == 0) & out.survived]["trial"])
    assert out["value"].between(0.3, 1).all()


def test_tail_of_student():
    assert profiling.student_two_sided(2.0, 10.0) == pytest.approx(0.0733880347707404, rel=1e-6)
    assert profiling.student_two_sided(0.0, 7.0) == pytest.approx(1.0, abs=1e-4)
    assert profiling.student_two_sided(12.0, 1e6) == pytest.approx(math.erfc(12 / math.sqrt(2)), rel=2e-2)


def cloud(n, dims, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(8, dims))[rng.integers(0, 8, n)] + 0.5 * rng.normal(size=(n, dims))
    x[: n // 3] = x[0]  # a third of all rows is one vector
    return x, rng.integers(0, 3, n)


def exact(x, k):
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    order = np.lexsort((np.broadcast_to(np.arange(len(x)), d.shape), d), axis=1)[:, :k]
    return order, np.take_along_axis(d, order, 1)


def test_nearest_neighbours_one_block_is_exact(spark):
    x, y = cloud(150, 6, 3)
    df = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, y))] + [(900, None, 1), (901, [1.0], 1), (902, [float("nan")] * 6, 0)],
                               "id long, v array<double>, y int")
    got = neighbours.nearest_neighbours(df, "id", "v", 6, 3).toPandas().sort_values(["id", "rank"])
    order, d = exact(x, 3)
    assert got["other"].tolist() == order.ravel().tolist()
    np.testing.assert_allclose(got["d"], d.ravel(), atol=1e-12)
    links = {(r.a, r.b) for r in neighbours.tomek_links(df, "id", "v", "y", 6).collect()}
    one = order[:, 0]
    assert links == {(i, int(one[i])) for i in range(150) if one[one[i]] == i and i < one[i] and y[i] != y[one[i]]}
    made = neighbours.smote(df, "id", "v", "y", 2, 6, copies=2, k=3).collect()
    assert len(made) == 2 * (y == 2).sum()
    for r in made:
        a, b, v = x[r.source], x[r.other], np.array(r.vector)
        assert y[r.source] == y[r.other] == 2
        gap = (v - a) @ (b - a) / max((b - a) @ (b - a), 1e-300)
        np.testing.assert_allclose(v, a + gap * (b - a), atol=1e-9)
        assert -1e-9 <= gap <= 1


def test_recall_of_many_blocks(spark):
    x, y = cloud(1500, 8, 5)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    found = neighbours.nearest_neighbours(df, "id", "v", 8, 1, rounds=8, slice_rows=200).cache()
    out = neighbours.recall(found, df, "id", "v", F.col("id") % 5 == 0).first()
    assert out.n_queries == 300 and out.hits >= 0.9 * 300


def test_neighbours_of_few_and_none(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0])], "id long, v array<double>")
    assert neighbours.nearest_neighbours(df, "id", "v", 2).count() == 0
    assert neighbours.nearest_neighbours(df.limit(0), "id", "v", 2).count() == 0


def test_step_importance(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(80, 5)).round(2)
    y = (x[:, 2] + 0.3 * rng.normal(size=80) > 0).astype(int)
    df = spark.createDataFrame([([(float(v),) for v in row], int(c)) for row, c in zip(x, y)], "sequence array<struct<v: double>>, y int")
    score = lambda s: F.aggregate(s, F.lit(0.0), lambda a, e: a + e["v"])
    got = timeline.step_importance(df, "y", ["v"], score, 5).toPandas().sort_values("step")

    def auc(s):
        return np.mean([(a > b) + 0.5 * (a == b) for a in s[y == 1] for b in s[y == 0]])

    want = [auc(x.sum(axis=1).round(9))] + [auc(np.delete(x, t, axis=1).sum(axis=1).round(9)) for t in range(5)]
    np.testing.assert_allclose(got["auc"], want, atol=2e-3)
    assert got["auc_drop"].idxmax() == got.index[3]


def test_graph_features_of_hub_by_sketch(spark):
    pairs = [(0, i) for i in range(1, 400)] + [(i, i + 1) for i in range(1, 399)]
    both = pairs + [(b, a) for a, b in pairs]
    e = spark.createDataFrame([(a, b, 1.0) for a, b in both], "src long, dst long, weight double")
    v = spark.range(401)
    got = {r.id: (r.n_two_hop, r.exact) for r in graph.two_hop_counts(e, v, "id", most_paths=410).collect()}
    near = {n: {b for a, b in both if a == n} for n in range(401)}
    for n in range(401):
        true = len(set().union(*[near[m] for m in near[n]]) - {n}) if near[n] else 0
        assert abs(got[n][0] - true) <= 0.05 * true and (not got[n][1] or got[n][0] == true)
    assert not got[0][1] and got[400] == (0, True)
    table = graph.graph_feature_table(e, v.withColumn("bad", F.lit(0)), "id", "bad")
    assert table.count() == 401 and table.where("component_size = 400").count() == 400
