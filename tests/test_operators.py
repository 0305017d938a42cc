"""Values against pandas or numpy on small data, and the invariants of the metrics."""

import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loanloom.functions import cleaning, features, hashing
from loanloom.operators import binning, documents, drift, encoding, graph, learning, profiling, ranking, sampling, selection, strategy, timeline


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(0)
    n = 2000
    s = np.round(rng.random(n), 2)
    y = (rng.random(n) < s * 0.5).astype(int)
    pdf = pd.DataFrame({"id": np.arange(n), "score": s, "label": y, "x": rng.normal(size=n) + y, "c": rng.choice(list("pqrs"), n)})
    return spark.createDataFrame(pdf), pdf


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :])).mean()


def test_auc_ks_ap(scored):
    df, p = scored
    m = ranking.evaluate(df).first()
    y, s = p["label"].to_numpy(), p["score"].to_numpy()
    assert m["auc"] == pytest.approx(brute_auc(y, s))
    thr = np.unique(s)[::-1]
    tpr = np.array([(s[y == 1] >= t).mean() for t in thr])
    fpr = np.array([(s[y == 0] >= t).mean() for t in thr])
    assert m["ks"] == pytest.approx((tpr - fpr).max())
    assert m["ks_threshold"] == pytest.approx(thr[(tpr - fpr).argmax()])
    prec = np.array([y[s >= t].mean() for t in thr])
    assert m["ap"] == pytest.approx((np.diff(np.r_[0, tpr]) * prec).sum())


def test_metric_invariants(scored):
    df, p = scored
    up = ranking.evaluate(df).first()["auc"]
    down = ranking.evaluate(df.withColumn("score", -F.col("score"))).first()["auc"]
    assert up + down == pytest.approx(1)
    ks = ranking.ks_table(df, "score", "label", "id").toPandas().sort_values("decile")
    assert ks["count"].sum() == len(p) and ks["ks"].iloc[-1] == pytest.approx(0)
    lift = ranking.lift_table(df, "score", "label", "id").toPandas().sort_values("decile")
    assert lift["lift"].iloc[-1] == pytest.approx(1)
    one = ranking.rank_blend(df, ["score"], "id").toPandas().sort_values("id")
    np.testing.assert_allclose(one["blend"], p["score"].rank(pct=True))
    same = ranking.evaluate(df.withColumn("score", F.lit(0.3))).first()
    assert same["auc"] == pytest.approx(0.5)


def test_psi_of_itself_is_zero(scored):
    df, _ = scored
    assert drift.psi(df, df, "score").first()["psi"] == pytest.approx(0, abs=1e-9)
    assert drift.psi(df, df.withColumn("score", F.col("score") / 3), "score").first()["psi"] > 0.2


def test_woe_table(scored):
    df, p = scored
    t = binning.fit_woe(df, ["x"], ["c"], "label", bins=5).table.toPandas()
    edges = np.unique(np.percentile(p["x"], np.linspace(0, 100, 6)))
    cut = pd.cut(p["x"], edges, labels=False, include_lowest=True) + 1
    bad = p.groupby(cut)["label"].sum()
    good = p.groupby(cut)["label"].count() - bad
    woe = np.log(((bad + 0.5) / p["label"].sum()) / ((good + 0.5) / (1 - p["label"]).sum()))
    mine = t[t.feature == "x"].assign(b=lambda d: d["bin"].astype(int)).sort_values("b")
    np.testing.assert_allclose(mine["woe"], woe)
    assert t[t.feature == "c"]["n"].sum() == len(p)


def test_monotone_bins(scored):
    df, p = scored
    m = binning.fit_monotone_woe(df, ["x", "score"], [], "label")
    t = m.table.where("bin <> 'Missing'").withColumn("b", F.col("bin").cast("int")).toPandas()
    for _, part in t.groupby("feature"):
        rate = (part.sort_values("b")["bad"] / part.sort_values("b")["n"]).to_numpy()
        assert (np.diff(rate) >= 0).all() or (np.diff(rate) <= 0).all()
        assert (part["n"] >= 0.05 * len(p)).all()


def test_woe_survives_saving(scored, tmp_path):
    df, _ = scored
    m = binning.fit_woe(df, ["x"], ["c"], "label")
    binning.save_woe(m, str(tmp_path / "woe"))
    back = binning.load_woe(df.sparkSession, str(tmp_path / "woe"))
    a = binning.apply_woe(df, m).select("id", "x_woe", "c_woe").toPandas().sort_values("id").reset_index(drop=True)
    b = binning.apply_woe(df, back).select("id", "x_woe", "c_woe").toPandas().sort_values("id").reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b)


def _best_partition(n, bad, good, share, sign, most, smooth=0.5):
    """Highest information value over all partitions, one by one."""
    m, best = len(n), (-1.0, None)
    for mask in range(1 << (m - 1)):
        cuts = [0, *[i + 1 for i in range(m - 1) if mask >> i & 1], m]
        bins = [(sum(n[a:b]), sum(bad[a:b]), sum(good[a:b])) for a, b in zip(cuts, cuts[1:])]
        if len(bins) > most or min(x[0] for x in bins) < share * sum(n):
            continue
        woe = [np.log((x[1] + smooth) / sum(bad) / ((x[2] + smooth) / sum(good))) for x in bins]
        if any(sign * (y - x) < -1e-12 for x, y in zip(woe, woe[1:])):
            continue
        iv = sum(((x[1] + smooth) / sum(bad) - (x[2] + smooth) / sum(good)) * w for x, w in zip(bins, woe))
        best = max(best, (iv, cuts), key=lambda v: v[0])
    return best


@pytest.mark.parametrize("seed,share,trend,most", [(1, 0.05, "auto", 9), (2, 0.2, "increasing", 9), (3, 0.0, "decreasing", 3), (4, 0.01, "none", 4), (5, 0.9, "auto", 9)])
def test_optimal_bins_are_the_best_of_all_partitions(seed, share, trend, most):
    r = np.random.default_rng(seed)
    n = r.integers(1, 200, 9)
    bad = r.binomial(n, np.linspace(0.1, 0.5, 9) + r.normal(0, 0.05, 9).clip(-0.09, 0.2))
    counts = pd.DataFrame({"feature": "f", "bin": range(1, 10), "n": n, "bad": bad, "good": n - bad, "bads": bad.sum(), "goods": (n - bad).sum()})
    out = binning.optimal_bins(counts.sample(frac=1, random_state=seed), share, trend, 0.5, most)
    want = max((_best_partition(n, bad, n - bad, share, s, most) for s in {"auto": (1, -1), "increasing": (1,), "decreasing": (-1,), "none": (0,)}[trend]), key=lambda v: v[0])
    cuts = want[1] or [0, 9]
    assert out.sort_values("bin")["merged"].tolist() == [int(np.searchsorted(cuts[1:], i, "right")) + 1 for i in range(9)]


def test_out_of_fold_means_exclude_own_fold(scored):
    df, p = scored
    got = encoding.out_of_fold_means(df.withColumn("fold", hashing.fold_of("id", 4)), ["c"], "label", "fold", 10).toPandas()
    mean = p["label"].mean()
    for (c, f), part in got.groupby(["c", "fold"]):
        other = got[(got["c"] == c) & (got["fold"] != f)]
        want = (other["label"].sum() + 10 * mean) / (len(other) + 10)
        np.testing.assert_allclose(part["c_te"], want)


def test_experiment_arm_equals_big_integer(spark):
    df = spark.range(300).select("id", hashing.experiment_arm("id", 0.3).alias("arm"))
    for r in df.collect():
        want = int(hashlib.md5(str(r["id"]).encode()).hexdigest(), 16) % 100 < 30
        assert (r["arm"] == "treatment") == want


def test_row_statistics_match_pandas(spark):
    rng = np.random.default_rng(3)
    p = pd.DataFrame(rng.normal(size=(200, 5)), columns=[f"n{i}" for i in range(5)])
    p[rng.random(p.shape) < 0.3] = None
    got = features.with_row_statistics(spark.createDataFrame(p.reset_index()), list(p)).toPandas().sort_values("index")
    for name, want in (("mean", p.mean(axis=1)), ("std", p.std(axis=1)), ("min", p.min(axis=1)), ("max", p.max(axis=1)), ("skew", p.skew(axis=1))):
        np.testing.assert_allclose(got[f"n_{name}"], want, rtol=1e-8, atol=1e-10)
    assert got["n_null_cnt"].tolist() == p.isna().sum(axis=1).tolist()


def test_cleaning_odd_values(spark):
    df = spark.createDataFrame([("A1",), ("G5",), ("Z3",), ("B",), ("Cx",), (None,)], "s string")
    assert [r[0] for r in df.select(cleaning.subgrade_rank(F.col("s"))).collect()] == [1, 35, 3, -1, -1, -1]


def test_three_column_block_names(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "loanAmnt double, annualIncome double")
    assert list(features.loan_ratios(df)) == ["loanToIncome"]


def test_shared_attributes_equal_pair_enumeration(spark):
    rng = np.random.default_rng(4)
    n = 120
    p = pd.DataFrame({"id": range(n), "a": np.where(rng.random(n) < 0.35, 0, rng.integers(1, 30, n)), "b": rng.integers(0, 20, n),
                      "c": rng.integers(0, 15, n), "f": rng.integers(0, 2, n)}).astype({"a": "object"})
    p.loc[::7, "a"] = None
    got = graph.shared_attribute_features(spark.createDataFrame(p, "id long, a long, b long, c long, f long"), "id", ["a", "b", "c"], "f")
    got = got.toPandas().set_index("id").sort_index()
    for i, r in p.iterrows():
        ties = sum((p[k] == r[k]).astype(int) if r[k] is not None else 0 * p["b"] for k in "abc")
        ties[i] = 0
        near = ties > 0
        assert got.loc[i, "degree"] == near.sum()
        assert got.loc[i, "fraud_neighbor_count"] == p.loc[near, "f"].sum()
        assert got.loc[i, "max_edge_weight"] == ties.max()


@pytest.fixture(scope="module")
def hub_graph(spark):
    """A chain, a hub that holds a third of the edges, a clique."""
    pairs = [(i, i + 1) for i in range(0, 30)] + [(100, i) for i in range(0, 30, 2)] + [(a, b) for a in range(200, 206) for b in range(a + 1, 206)]
    both = pairs + [(b, a) for a, b in pairs]
    nodes = sorted({a for a, _ in both} | {999})
    e = spark.createDataFrame([(a, b, 1.0) for a, b in both], "src long, dst long, weight double")
    return e, spark.createDataFrame([(v,) for v in nodes], "id long"), both, nodes


def test_two_hop_with_hub(hub_graph):
    e, v, both, nodes = hub_graph
    near = {n: {b for a, b in both if a == n} for n in nodes}
    want = {n: len(set().union(*[near[m] for m in near[n]]) - {n}) if near[n] else 0 for n in nodes}
    for heavy in (3, 8, 1000):
        got = {r["id"]: r["n_two_hop"] for r in graph.two_hop_counts(e, v, "id", heavy).collect()}
        assert got == want


def test_components_and_dense_parts(hub_graph):
    e, v, both, nodes = hub_graph
    comp = graph.connected_components(e, v, "id")
    got = {r["id"]: (r["component"], r["size"]) for r in comp.collect()}
    assert got[30] == (0, 32) and got[205] == (200, 6) and got[999] == (999, 1)
    dense = graph.dense_components(e, comp, "id").collect()
    assert [(r["component"], r["density"]) for r in dense] == [(200, 1.0)]


def test_triangles(hub_graph):
    e, v, both, _ = hub_graph
    got = {r["id"]: r["triangles"] for r in graph.triangles(e).collect()}
    assert got == {i: 10 for i in range(200, 206)}


def test_trailing_count_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    p = pd.DataFrame({"e": np.where(rng.random(400) < 0.4, 1, rng.integers(2, 5, 400)), "s": rng.integers(0, 3000, 400)})
    df = spark.createDataFrame(p).select("e", F.timestamp_seconds("s").alias("t"))
    got = {(r["e"], r["second"]): r["n_recent"] for r in timeline.trailing_count(df, "e", "t", 100).collect()}
    for (e, s), n in got.items():
        mine = p[(p["e"] == e) & (p["s"] > s - 100) & (p["s"] <= s)]
        assert n == mine["s"].nunique()
    assert len(got) == len(p.drop_duplicates())


def test_count_before_is_strict(spark):
    obs = spark.sql("SELECT 1 AS id, 7 AS k, TIMESTAMP '2020-01-02' AS t UNION ALL SELECT 2, 8, TIMESTAMP '2020-01-02'")
    ev = spark.sql("SELECT 7 AS k, TIMESTAMP '2020-01-01' AS t UNION ALL SELECT 7, TIMESTAMP '2020-01-02'")
    got = {r["id"]: r["n_before"] for r in timeline.count_before(obs, ev, "k", "t", "t").collect()}
    assert got == {1: 1, 2: 0}


def test_shuffled_labels_keep_their_count(scored):
    df, p = scored
    got = selection.with_shuffled_labels(df, "label", "id", 3).agg(*[F.sum(f"_y{i}") for i in range(3)]).first()
    assert list(got) == [p["label"].sum()] * 3


def test_scorecard_solves_the_penalised_objective(scored):
    df, p = scored
    card = learning.fit_scorecard(df, ["x", "score"], "label", c=0.1)
    x = np.c_[p[["x", "score"]].to_numpy(), np.ones(len(p))]
    y = p["label"].to_numpy()
    w = np.where(y == 1, len(p) / (2 * y.sum()), len(p) / (2 * (1 - y).sum()))
    b, pen = np.zeros(3), np.diag([1.0, 1.0, 0.0])
    for _ in range(50):
        q = 1 / (1 + np.exp(-x @ b))
        g = 0.1 * x.T @ (w * (q - y)) + pen @ b
        h = 0.1 * (x * (w * q * (1 - q))[:, None]).T @ x + pen
        b = b - np.linalg.solve(h, g)
    np.testing.assert_allclose([*card.coefficients.values(), card.intercept], b, rtol=1e-3, atol=1e-3)


def test_out_of_fold_covers_every_row(scored):
    df, p = scored
    r = learning.fit_out_of_fold(df, ["x", "score"], "label", "id", df.limit(100), 2, learning.boosted(2, 2))
    assert r.oof.select("id").distinct().count() == len(p)
    assert r.test.count() == 100
    assert r.importance.count() == 2


def test_permutation_keeps_the_column(scored):
    df, p = scored
    m = learning.boosted(2, 2).fit(learning.assemble(df.withColumn("label", F.col("label").cast("double")), ["x", "score"], ["label"]))
    drop = {r["feature"]: r["auc_drop"] for r in learning.permutation_importance(m, df, ["x", "score"], "label", "id").collect()}
    assert drop["score"] > 0


def test_student_tail():
    assert profiling.student_two_sided(0, 10) == pytest.approx(1)
    assert profiling.student_two_sided(2.228, 10) == pytest.approx(0.05, abs=1e-4)
    assert profiling.student_two_sided(1.96, 1e6) == pytest.approx(0.05, abs=1e-4)


def test_warp_lengths(spark):
    df = spark.createDataFrame([(i, [(float(j),) for j in range(12)]) for i in range(50)], "id long, sequence array<struct<v:double>>")
    for r in timeline.time_warp(df, "id", ["v"]).collect():
        v = [s["v"] for s in r["sequence"]]
        assert 10 <= len(v) <= 13 and v == sorted(v)
        if len(v) >= 12:
            assert v[0] == 0 and v[-1] == pytest.approx(11)


def test_expanding_splits_never_look_ahead(spark):
    df = spark.range(600).select("id", F.date_add(F.to_date(F.lit("2020-01-01")), F.col("id").cast("int")).alias("d"))
    folded = sampling.with_time_fold(df, "d", 4)
    for past, ahead in sampling.expanding_splits(folded, 4):
        assert past.agg(F.max("d")).first()[0] < ahead.agg(F.min("d")).first()[0]


def test_limit_and_price_rules(spark):
    df = spark.createDataFrame([(480.0, 3000.0, 0.6, 5.0), (700.0, 3333.0, 0.1, 5.0)], "s double, i double, d double, m double")
    got = [r[0] for r in df.select(strategy.credit_limit(*[F.col(c) for c in "sidm"])).collect()]
    assert got == [5000.0, 17000.0]
    p = strategy.price(F.col("p"))
    row = spark.createDataFrame([(0.4,)], "p double").select(*[c.alias(n) for n, c in p.items()]).first()
    assert row["actual_rate"] == 0.24 and not row["is_viable"]


def test_retrieval_order(spark):
    df = spark.createDataFrame([(1, "loan risk"), (2, "risk"), (3, "none"), (4, "loan risk score")], "id long, t string")
    assert [r["id"] for r in documents.retrieve(df, "t", "id", "loan score", 5).collect()] == [4, 1]


def test_fpd_streak(spark):
    df = spark.createDataFrame([(w, 0.05 if w != 3 else 0.0) for w in range(9)], "week int, fpd double")
    got = {r["week"]: (r["streak"], r["fpd_trigger"]) for r in drift.weekly_fpd_trigger(df).collect()}
    assert got[2] == (3, False) and got[3] == (0, False) and got[7] == (4, True) and got[8] == (5, True)


def test_expected_scale():
    a, b = features.score_scale()
    assert a == pytest.approx(600 - b * math.log(50))
    assert features.score_scale(base_odds=50)[0] - a == pytest.approx(2 * b * math.log(50))


def test_adversarial_rules(spark):
    imp = profiling.small_frame(spark, [{"feature": f, "importance": v} for f, v in zip("abcd", [0.05, 0.04, 0.6, 0.31])])
    far = selection.Adversarial(0.8, 0.79, imp.orderBy(F.desc("importance")))
    assert far.verdict == "severe" and far.pooled_verdict == "significant"
    assert {r["feature"] for r in far.leaking(0.7, 0.8).collect()} == {"c"}
    assert far.to_drop(0.1).count() == 0 and {r["feature"] for r in far.to_drop(0.95).collect()} == {"c", "d"}
    near = selection.Adversarial(0.52, 0.5, imp)
    assert near.verdict == "similar" and near.leaking().count() == 0


def test_hops_and_walks(hub_graph):
    e, v, both, nodes = hub_graph
    got = {r["id"]: r["hops"] for r in graph.hops_from(e, v.where("id = 29"), "id", 3).collect()}
    assert got == {29: 0, 28: 1, 30: 1, 27: 2, 100: 2, **{i: 3 for i in range(0, 28, 2)}}
    near = {(a, b) for a, b in both}
    for r in graph.random_walks(e, v, "id", 4, 2).collect():
        assert r["path"][0] == r["id"] and all(p in near for p in zip(r["path"], r["path"][1:]))
        assert len(r["path"]) == (1 if r["id"] == 999 else 4)


def test_label_propagation_finds_the_clique(hub_graph):
    e, v, _, _ = hub_graph
    got = {r["id"]: r["community"] for r in graph.label_communities(e, v, "id", 4).collect()}
    assert len({got[i] for i in range(200, 206)}) == 1 and got[999] == 999


def test_feature_columns(spark):
    df = spark.createDataFrame([(1, 2.0, 0)], "id int, x double, isDefault int")
    assert cleaning.feature_columns(df) == ["x"]


def test_reason_codes_are_positive_and_ranked(spark):
    df = spark.createDataFrame([(1.0, 3.0, -2.0)], "a double, b double, c double")
    out = learning.reason_codes(df, {"a": 1.0, "b": 1.0, "c": 1.0}, {"a": 0.0, "b": 0.0, "c": 0.0}, {"a": "A", "b": "B", "c": "C"})
    assert out.first()["reasons"] == ["B", "A"]


def test_isotonic_is_monotone(scored):
    df, _ = scored
    out = learning.calibrate_isotonic(df, "score", "label")(df).select("score", "calibrated").toPandas().sort_values("score")
    assert (out["calibrated"].diff().dropna() >= -1e-12).all()


def test_isotonic_tells_small_scores_apart(spark):
    rows = [(i * 1e-7, int(i >= 200)) for i in range(400)]
    df = spark.createDataFrame(rows, "score double, label int")
    out = {r.score: r.calibrated for r in learning.calibrate_isotonic(df, "score", "label")(df).collect()}
    assert [out[s] for s, _ in rows] == [y for _, y in rows]


def test_components_of_a_chain_that_turns_back(spark):
    """1, n, n - 1, ..., 2: the label of the smallest has to travel against the ids."""
    from loanloom.operators import graph

    n = 10_000
    edges = spark.range(2, n).selectExpr("id AS src", "id + 1 AS dst").unionByName(spark.createDataFrame([(1, n)], "src long, dst long"))
    out = graph.component_labels(edges)
    assert out.count() == n - 1 and out.where("label <> 1").count() == 0
    assert graph.component_labels(edges.where("false")).count() == 0


def test_loan_files_are_read_by_header(spark, tmp_path):
    import pytest

    from loanloom.sources.tables import LABEL, loan_schema, read_loans_csv, read_train_test

    names = [f.name for f in loan_schema().fields]
    assert names[:6] == ["id", "loanAmnt", "term", "interestRate", "installment", "grade"]
    line = {"id": "1", "loanAmnt": "5000", "term": "36", "grade": "A", "subGrade": "A1", "employmentLength": "2 years", "issueDate": "2015-01-01",
            "earliesCreditLine": "Aug-2001", LABEL: "1", "n14": "3"}
    for name, order, label in (("train", names, True), ("other", names[::-1], True), ("test", [x for x in names if x != LABEL], False)):
        with open(tmp_path / f"{name}.csv", "w") as f:
            f.write(",".join(order) + ",extra\n" + ",".join(line.get(x, "") for x in order) + ",x\n")
        row = read_loans_csv(spark, str(tmp_path / f"{name}.csv"), label).first()
        assert (row.loanAmnt, row.term, row.subGrade, row.n14, row.dti) == (5000.0, 36, "A1", 3.0, None) and "extra" not in row
    train, test = read_train_test(spark, str(tmp_path / "train.csv"), str(tmp_path / "test.csv"))
    assert train.count() == test.count() == 1 and train.first()[LABEL] == 1
    with pytest.raises(ValueError):
        read_loans_csv(spark, str(tmp_path / "test.csv"))
    with pytest.raises(Exception):
        read_train_test(spark, str(tmp_path / "none.csv"), str(tmp_path / "test.csv"))


def test_blend_keeps_rows_without_a_score(spark):
    from loanloom.operators import ranking

    df = spark.createDataFrame([(i, float(i % 4) if i % 3 else None, float(i)) for i in range(9)], "id long, a double, b double")
    out = ranking.rank_blend(df, ["a", "b"], "id").collect()
    assert len(out) == 9 and {r.id for r in out if r.blend is None} == {0, 3, 6}
    whole = {r.id: r.blend for r in ranking.rank_blend(df.where("a IS NOT NULL"), ["a"], "id").collect()}
    assert {r.id: r.blend for r in ranking.rank_blend(df, ["a"], "id").collect() if r.blend is not None} == whole


def test_auc_of_huge_counts_does_not_overflow(spark):
    from pyspark.sql import functions as F

    from loanloom.operators import ranking

    df = spark.createDataFrame([(10**9, 10**10, 1.0, 0.0)], "total_bad long, total_good long, tpr double, fpr double").selectExpr(
        "*", "total_bad AS bad", "0L AS good", "total_bad AS cum_bad", "0L AS cum_good", "0.5D AS score")
    assert df.agg(*ranking._metric_columns()).select(F.col("auc")).first()[0] == 1.0
