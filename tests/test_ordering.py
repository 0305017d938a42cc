"""Prefix sums, positions, ranks and quantiles, also where one value holds a third of the rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loanloom.operators import ordering


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(1)
    n = 3000
    v = np.where(rng.random(n) < 0.34, 0.5, np.round(rng.random(n), 3))
    return pd.DataFrame({"id": np.arange(n), "v": v, "g": np.where(rng.random(n) < 0.4, "a", rng.choice(list("bcd"), n)),
                         "y": rng.integers(0, 2, n)})


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame(data)


def test_prefix_sums(frame, data):
    got = ordering.prefix_sums(frame, "v", ["y"], descending=True).toPandas().sort_values("v")
    per = data.groupby("v")["y"].sum()
    assert list(got["v"]) == list(per.index)
    assert got["before_y"].tolist() == (per.sum() - per.cumsum()).tolist()
    assert (got["total_y"] == data["y"].sum()).all()


def test_prefix_sums_by_group_with_null_key(spark, data):
    pdf = data.assign(g=data["g"].where(data["g"] != "b", None))
    df = spark.createDataFrame(pdf, "id long, v double, g string, y long")
    got = ordering.prefix_sums(df, "v", ["y"], ["g"]).toPandas()
    for g, part in pdf.groupby("g", dropna=False):
        per = part.groupby("v")["y"].sum()
        mine = got[got["g"].isna() if pd.isna(g) else got["g"] == g].sort_values("v")
        assert mine["before_y"].tolist() == (per.cumsum() - per).tolist()


def test_cut_points_do_not_change_results(frame):
    a = ordering.prefix_sums(frame, "v", ["y"], cuts=[]).toPandas().sort_values("v").reset_index(drop=True)
    b = ordering.prefix_sums(frame, "v", ["y"], cuts=[0.1, 0.5, 0.7]).toPandas().sort_values("v").reset_index(drop=True)
    c = ordering.prefix_sums(frame, "v", ["y"], cuts=[i / 40 for i in range(40)]).toPandas().sort_values("v").reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b)
    pd.testing.assert_frame_equal(a, c)


def test_positions_are_a_permutation_in_order(frame, data):
    got = ordering.row_positions(frame, "v", "id", sums=["y"]).toPandas().sort_values("pos")
    assert got["pos"].tolist() == list(range(1, len(data) + 1))
    assert got["v"].is_monotonic_decreasing
    assert got["cum_y"].tolist() == got["y"].cumsum().tolist()


def test_hot_value_is_spread(frame):
    cuts = ordering.plan_cuts(frame, "v")
    rows = ordering._spread_rows(frame, "v", "id", cuts)
    biggest = rows.groupBy("_slice", "_sub").count().agg(F.max("count")).first()[0]
    assert biggest < 3000 / 8


def test_average_ranks(frame, data):
    got = ordering.average_ranks(frame, ["v", "y"], "id", ["r", "s"]).toPandas().set_index("id").sort_index()
    np.testing.assert_allclose(got["r"], data["v"].rank(pct=True))
    np.testing.assert_allclose(got["s"], data["y"].rank(pct=True))


@pytest.mark.parametrize("slices,rest", [(4, 3), (64, 50)])
def test_quantiles_by_narrowing_equal_numpy(spark, slices, rest):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"a": rng.lognormal(size=2000), "b": np.where(rng.random(2000) < 0.4, 7.0, rng.normal(size=2000))})
    pdf.loc[:50, "a"] = None
    probs = [0, 0.01, 0.25, 0.5, 0.9, 1]
    got = ordering.exact_quantiles(spark.createDataFrame(pdf), ["a", "b"], probs, refine_limit=rest, slices=slices)
    for c in pdf:
        np.testing.assert_allclose(got[c], np.percentile(pdf[c].dropna(), [100 * p for p in probs]))
    small = ordering.exact_quantiles(spark.createDataFrame(pdf), ["a", "b"], probs)
    assert all(small[c] == pytest.approx(got[c]) for c in pdf)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "a double")
    assert ordering.exact_quantiles(df, ["a"], [0.5]) == {"a": None}
    assert ordering.exact_quantiles(df, ["a"], [0.5]) == {"a": None}


@pytest.mark.parametrize("rest", [3, None])
def test_quantiles_with_infinite_values(spark, rest):
    inf = float("inf")
    values = [-inf] * 30 + [float(v) for v in range(50)] + [inf] * 20
    df = spark.createDataFrame([(v, None if v == inf else -inf) for v in values], "a double, b double")
    got = ordering.exact_quantiles(df, ["a", "b"], [0, 0.25, 0.5, 0.75, 0.9, 1], refine_limit=rest, slices=4)
    assert got == {"a": [-inf, -inf, 19.5, 44.25, inf, inf], "b": [-inf] * 6}
    assert ordering.exact_quantiles(df, ["a"], [0.25, 0.5]) == {"a": [-inf, 19.5]}


def test_one_way_to_quantiles(spark, monkeypatch):
    rounds = []
    narrow = ordering._narrow
    monkeypatch.setattr(ordering, "_narrow", lambda *a: rounds.append(1) or narrow(*a))
    assert ordering.exact_quantiles(spark.createDataFrame([(1.0,), (2.0,)], "a double"), ["a"], [0.5]) == {"a": [1.5]}
    assert rounds
