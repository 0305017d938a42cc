"""Models, selection and the model-driven reports."""

from functools import lru_cache

from pyspark.sql import functions as F

from loanloom.functions.hashing import fold_of, hash_unit
from loanloom.operators import binning, learning, moments, ranking, selection, strategy
from loanloom.plans.binning_queries import CAT, NUM, WOE
from loanloom.plans.catalog import query
from loanloom.plans.check_sql import LOAN, edges_sql, r6, right_bin, uniform
from loanloom.plans.profile_queries import collection_cases, rounded
from loanloom.session import hold
from loanloom.sources import marts
from loanloom.sources.tables import table

FEATURES = ["loanAmnt", "interestRate", "annualIncome", "n0", "n1", "n2", "n3", "n4"]


def _loans(spark, folder, *extra):
    return hold(marts.loans(spark, folder, "loan_id", *FEATURES, "isDefault", *extra))


def _woe(spark, folder):
    df = hold(marts.loans(spark, folder, "loan_id", *NUM, *CAT, "n0", "isDefault"))
    model = binning.fit_woe(df, [*NUM, "n0"], CAT, "isDefault")
    cols = [f"{c}_woe" for c in model.features]
    return hold(binning.apply_woe(df, model).select("loan_id", "isDefault", *cols)), cols, model


def _early_late(df):
    early = F.year("issueDate") <= 1999
    return df.where(early).drop("issueDate"), df.where(~early).drop("issueDate")


@query("scorecard_scores")
def scorecard_scores(spark, folder):
    from loanloom.functions.features import probability_score

    df, cols, _ = _woe(spark, folder)
    card = learning.fit_scorecard(df, cols, "isDefault")
    return card.score(df, ["loan_id", "isDefault"]).select(
        "loan_id", F.round("score", 6).alias("score"), probability_score(F.col("score")).alias("points"))


@query("scorecard_card")
def scorecard_card(spark, folder):
    df, cols, model = _woe(spark, folder)
    card = learning.fit_scorecard(df, cols, "isDefault")
    return binning.card_table(model.table, {c[:-4]: w for c, w in card.coefficients.items()}, card.intercept)


@query("scorecard_strength_search")
def scorecard_strength_search(spark, folder):
    df, cols, _ = _woe(spark, folder)
    return rounded(learning.fit_scorecard_cv(df, cols, "isDefault", "loan_id", (0.01, 0.1, 1.0), 5)[1])


@query("segment_scorecards")
def segment_scorecards(spark, folder):
    """One card per customer segment, each applied to its own rows."""
    df, cols, _ = _woe(spark, folder)
    home = marts.loans(spark, folder, "loan_id", "annualIncome", "homeOwnership", "n0").select(
        "loan_id", strategy.customer_segment(F.col("annualIncome").isNotNull(), F.col("n0") * 8, F.col("homeOwnership") == "F").alias("segment"))
    seg = hold(df.join(home, "loan_id"))
    names = sorted(r["segment"] for r in seg.select("segment").distinct().collect())

    def card(name):
        part = seg.where(F.col("segment") == name)
        return learning.fit_scorecard(part, cols, "isDefault").score(part, ["loan_id", "segment"])

    out = None
    for scored in learning.side_by_side(card, names):
        out = scored if out is None else out.unionByName(scored)
    return rounded(out)


def inverse_sql(columns) -> str:
    """Gauss-Jordan elimination of the matrix of cross products, one pivot after another, as rows (i, j, v)."""
    k = len(columns)
    cells = " UNION ALL ".join(f"SELECT {i} AS i, {j} AS j, sum({a} * {b}) AS v FROM x" for i, a in enumerate(columns) for j, b in enumerate(columns))
    parts = [f"x AS (SELECT {', '.join(f'coalesce({c}, 0)::DOUBLE AS {c}' for c in columns)} FROM loan)", f"g0 AS MATERIALIZED ({cells})"]
    for p in range(k):
        parts.append(f"""g{p + 1} AS MATERIALIZED (SELECT a.i, a.j, CASE WHEN a.i = {p} AND a.j = {p} THEN 1 / q.v WHEN a.i = {p} THEN a.v / q.v WHEN a.j = {p} THEN -a.v / q.v
  ELSE a.v - r.v * c.v / q.v END AS v FROM g{p} a JOIN g{p} q ON q.i = {p} AND q.j = {p} JOIN g{p} r ON r.i = a.i AND r.j = {p} JOIN g{p} c ON c.i = {p} AND c.j = a.j)""")
    return ", ".join(parts)


@query("variance_inflation", f"""
WITH {LOAN}, {inverse_sql(FEATURES)}
SELECT {FEATURES}[g0.i + 1] AS feature, round(g0.v * g{len(FEATURES)}.v, 4) + 0 AS vif FROM g0 JOIN g{len(FEATURES)} USING (i, j) WHERE i = j""")
def variance_inflation(spark, folder):
    df = marts.loans(spark, folder, *FEATURES).fillna(0.0)
    return rounded(moments.variance_inflation(df, FEATURES)).withColumn("vif", F.round("vif", 4))


COEF = {"loanAmnt": 0.5, "interestRate": 0.75, "annualIncome": 1.0, "purpose": 1.25}


@query("reason_codes", f"""
WITH {WOE}, w AS (SELECT loan_id, feature, woe, woe - avg(woe) OVER (PARTITION BY feature) AS d FROM binned JOIN woe USING (feature, bin)),
c AS (SELECT loan_id, 'R_' || feature AS reason, round(d * CASE feature WHEN 'loanAmnt' THEN 0.5 WHEN 'interestRate' THEN 0.75 WHEN 'annualIncome' THEN 1.0 ELSE 1.25 END, 9) AS v FROM w),
r AS (SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY v DESC, reason DESC) AS k FROM c WHERE v > 0)
SELECT l.loan_id, coalesce(string_agg(reason, ',' ORDER BY k), '') AS reasons FROM loan l LEFT JOIN r ON r.loan_id = l.loan_id AND k <= 3 GROUP BY 1""")
def reason_codes(spark, folder):
    df = hold(marts.loans(spark, folder, "loan_id", *NUM, *CAT, "isDefault"))
    woe = hold(binning.apply_woe(df, binning.fit_woe(df, NUM, CAT, "isDefault")))
    means = woe.agg(*[F.avg(f"{c}_woe").alias(c) for c in COEF]).first().asDict()
    coef = {f"{c}_woe": w for c, w in COEF.items()}
    out = learning.reason_codes(woe, coef, {f"{c}_woe": m for c, m in means.items()}, {f"{c}_woe": f"R_{c}" for c in COEF})
    return out.select("loan_id", F.array_join("reasons", ",").alias("reasons"))


@lru_cache(maxsize=2)
def _oof(spark, folder):
    """One fit of five folds for the queries that show its parts."""
    train, test = _early_late(_loans(spark, folder, "issueDate"))
    return learning.fit_out_of_fold(train, FEATURES, "isDefault", "loan_id", test, 5, learning.boosted(10, 3))


@query("boosted_out_of_fold")
def boosted_out_of_fold(spark, folder):
    return rounded(_oof(spark, folder).oof.select("loan_id", "fold", F.col("label").cast("int").alias("label"), "score"))


@query("boosted_fold_sizes", f"""
WITH {LOAN} SELECT ({uniform('loan_id', 42)} % 5)::INT AS fold, count(*) AS n, sum(isDefault)::BIGINT AS bad, true AS each_row_once FROM loan
WHERE year(issueDate) <= 1999 GROUP BY 1""")
def boosted_fold_sizes(spark, folder):
    """Of the out-of-fold scores: rows and bad rows per fold, and that every training row is scored once."""
    per = _oof(spark, folder).oof.groupBy("fold", "loan_id").agg(F.count("*").alias("k"), F.sum("label").cast("long").alias("bad"))
    return per.groupBy("fold").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"), (F.max("k") == 1).alias("each_row_once"))


@query("boosted_test_scores")
def boosted_test_scores(spark, folder):
    return rounded(_oof(spark, folder).test)


@query("boosted_importance")
def boosted_importance(spark, folder):
    return rounded(_oof(spark, folder).importance)


@query("boosted_search")
def boosted_search(spark, folder):
    return learning.search_boosted(_loans(spark, folder), FEATURES, "isDefault", "loan_id", trials=30, folds=3, rungs=(2, 6, 18))


RUNG_SHARES = [0.15, 0.4, 1.0]


def _trial_score(t: int) -> str:
    """Linear scorer number t."""
    return f"round({t * 7 % 30 / 30} * coalesce(n0, 0) + {t * 11 % 30 / 30} * coalesce(interestRate, 0) - {t * 13 % 30 / 300} * coalesce(n1, 0) / 25, 4)"


@query("halving_rungs", f"""
WITH {LOAN}, tr AS MATERIALIZED (SELECT ({uniform('loan_id', 42)} % 3) AS fold, {uniform('loan_id', 'rung')} / 4294967296.0 AS u, isDefault AS y,
  unnest(range(30)) AS trial, unnest([{', '.join(_trial_score(t) for t in range(30))}]) AS s FROM loan),
rk AS (SELECT rung, trial, fold, y, rank() OVER (PARTITION BY rung, trial, fold ORDER BY s) + (count(*) OVER (PARTITION BY rung, trial, fold, s) - 1) / 2 AS r
  FROM tr, (SELECT unnest(range(3)) AS rung, unnest({RUNG_SHARES}) AS share) WHERE u < share),
auc AS (SELECT rung, trial, fold, (sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * sum(1 - y)) AS a FROM rk GROUP BY 1, 2, 3),
mean AS MATERIALIZED (SELECT rung, trial, round(avg(a), 6) AS value FROM auc GROUP BY 1, 2),
r0 AS (SELECT *, row_number() OVER (ORDER BY value DESC, trial) <= 10 AS survived FROM mean WHERE rung = 0),
r1 AS (SELECT *, row_number() OVER (ORDER BY value DESC, trial) <= 4 AS survived FROM mean WHERE rung = 1 AND trial IN (SELECT trial FROM r0 WHERE survived)),
r2 AS (SELECT *, row_number() OVER (ORDER BY value DESC, trial) <= 1 AS survived FROM mean WHERE rung = 2 AND trial IN (SELECT trial FROM r1 WHERE survived))
SELECT rung::INT AS rung, trial::INT AS trial, value + 0 AS value, survived FROM (SELECT * FROM r0 UNION ALL SELECT * FROM r1 UNION ALL SELECT * FROM r2)""")
def halving_rungs(spark, folder):
    """Thirty linear scorers through three budgets of rows: mean AUC over three folds, the best third goes on."""
    df = hold(_loans(spark, folder).withColumns({"fold": fold_of("loan_id", 3), "_u": hash_unit("loan_id", "rung")}))

    def measure(share, trials):
        cells = F.inline(F.array(*[F.struct(F.lit(t).alias("trial"), F.expr(_trial_score(t)).alias("s")) for t in trials]))
        rows = df.where(F.col("_u") < share).select("fold", F.col("isDefault").alias("label"), cells)
        per = ranking.evaluate(rows, "s", "label", ["trial", "fold"]).groupBy("trial").agg(F.round(F.avg("auc"), 6).alias("auc")).collect()
        found = {r["trial"]: r["auc"] for r in per}
        return [found[t] for t in trials]

    return learning.successive_halving(spark, range(30), RUNG_SHARES, measure)


@query("time_series_auc")
def time_series_auc(spark, folder):
    from loanloom.operators.sampling import with_time_fold

    df = with_time_fold(_loans(spark, folder, "issueDate"), "issueDate", 5)
    return rounded(learning.time_series_auc(df, FEATURES, "isDefault", "time_fold", 5, learning.boosted(10, 3)))


@query("permutation_importance")
def permutation_importance(spark, folder):
    df = _loans(spark, folder)
    m = learning.boosted(10, 3).fit(learning.assemble(df.withColumn("label", F.col("isDefault").cast("double")), FEATURES, ["label"]))
    return rounded(learning.permutation_importance(m, df, FEATURES, "isDefault", "loan_id"))


@query("calibrated_scores")
def calibrated_scores(spark, folder):
    df = hold(marts.scores(spark, folder).select("loan_id", "score", "label"))
    out = learning.calibrate_sigmoid(df, "score", "label")(df, "platt")
    out = learning.calibrate_isotonic(df, "score", "label")(out, "isotonic")
    return rounded(out.select("loan_id", "platt", "isotonic"))


@query("uplift_scores")
def uplift_scores(spark, folder):
    from loanloom.functions.hashing import experiment_arm

    df = _loans(spark, folder).withColumn("treated", (experiment_arm("loan_id", 0.5) == "treatment").cast("int"))
    score = learning.fit_uplift(df, FEATURES, "isDefault", "treated", learning.boosted(10, 3))
    return rounded(score(df, "loan_id"))


@query("loss_given_default")
def loss_given_default(spark, folder):
    x = collection_cases(spark, folder).join(marts.loans(spark, folder, "loan_id", *FEATURES), "loan_id")
    df = hold(x.select("loan_id", "collected_amount", "ead", *FEATURES))
    return rounded(learning.fit_lgd(df, FEATURES, "collected_amount", "ead", trees=10)(df, "loan_id"))


@query("stacked_scores")
def stacked_scores(spark, folder):
    train, test = _early_late(_loans(spark, folder, "issueDate"))
    scores, _ = learning.fit_stack(train, test, FEATURES, "isDefault", "loan_id",
                                   [learning.boosted(10, 2), learning.boosted(10, 4)], folds=5)
    return rounded(scores)


@query("pseudo_label_rounds")
def pseudo_label_rounds(spark, folder):
    train, test = _early_late(_loans(spark, folder, "issueDate"))
    out = learning.pseudo_label_rounds(train, test, FEATURES, "isDefault", "loan_id", 3, 0.1, learning.boosted(10, 3))
    return out.groupBy("round", "isDefault").agg(F.count("*").alias("n"))


RUNS = 50


def null_iv_sql(runs=RUNS):
    binned = " UNION ALL ".join(
        f"SELECT loan_id, '{c}' AS feature, CASE WHEN {c} IS NULL THEN 'Missing' ELSE ({right_bin(c)})::VARCHAR END AS bin FROM loan, {edges_sql(c, 'loan')}" for c in FEATURES)
    word = lambda name: f"('0x' || substr(md5({name}), 1, 8))::BIGINT"
    return f"""{LOAN}, size AS (SELECT count(*) AS n, sum(isDefault) AS total FROM loan),
drawn AS (SELECT run, {word("'null' || run")} % least(n, 4611686018427387904 // n) + 1 AS a0, {word("'null' || run || 'b'")} % n AS b FROM size, range({runs}) t(run)),
perm AS MATERIALIZED (SELECT run, any_value(b) AS b, min(a0 + k) AS a FROM drawn, size, range(200) t(k) WHERE gcd(a0 + k, n) = 1 GROUP BY run),
pos AS (SELECT loan_id, isDefault, row_number() OVER (ORDER BY {uniform('loan_id', 'null')}, md5(loan_id::VARCHAR)) - 1 AS p FROM loan),
ys AS (SELECT loan_id, run, ((p * a + b) % n < total)::INT AS y FROM pos, perm, size UNION ALL SELECT loan_id, -1, isDefault FROM loan),
bn AS ({binned}), cn AS (SELECT feature, bin, run, sum(y) AS bad, sum(1 - y) AS good FROM bn JOIN ys USING (loan_id) GROUP BY 1, 2, 3),
sh AS (SELECT *, (bad + 0.5) / sum(bad) OVER (PARTITION BY feature, run) AS pb, (good + 0.5) / sum(good) OVER (PARTITION BY feature, run) AS pg FROM cn),
iv AS (SELECT feature, run, sum((pb - pg) * ln(pb / pg)) AS iv FROM sh GROUP BY 1, 2)"""


@query("null_information_value", f"WITH {null_iv_sql()} SELECT feature, run::INT AS run, {r6('iv')} AS iv FROM iv")
def null_information_value(spark, folder):
    return rounded(selection.null_iv(_loans(spark, folder), FEATURES, [], "isDefault", "loan_id", runs=RUNS))


@query("null_iv_scores", f"""
WITH {null_iv_sql()}, a AS (SELECT feature, iv AS actual FROM iv WHERE run = -1),
t AS (SELECT feature, actual, avg(iv) AS nm, stddev_pop(iv) AS ns, median(iv) AS nd, avg((iv < actual)::INT) AS sp FROM iv JOIN a USING (feature) WHERE run >= 0 GROUP BY 1, 2)
SELECT feature, {r6('actual')} AS actual, {r6('nm')} AS null_mean, {r6('ns')} AS null_std, {r6('nd')} AS null_median, {r6('sp')} AS score_pct,
  round(actual / (nd + 1e-6), 3) + 0 AS ratio, sp >= 0.75 AS selected FROM t""")
def null_iv_scores(spark, folder):
    runs = selection.null_iv(_loans(spark, folder), FEATURES, [], "isDefault", "loan_id", runs=RUNS)
    return rounded(selection.null_scores(runs, "iv")).withColumn("ratio", F.round("ratio", 3))


@query("null_importance_scores")
def null_importance_scores(spark, folder):
    runs = selection.null_importance(_loans(spark, folder), FEATURES, "isDefault", "loan_id", RUNS, learning.boosted(3, 3))
    return rounded(selection.null_scores(runs))


@query("leaked_features", f"""
WITH {WOE}, w AS (SELECT (year(issueDate) > 1999)::INT AS y, loanAmnt AS s FROM loan),
k AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2 AS r FROM w),
auc AS (SELECT (sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * sum(1 - y)) AS a FROM k),
i AS (SELECT feature, sum(iv) AS importance FROM woe GROUP BY 1), q AS (SELECT quantile_cont(importance, 0.8) AS cut FROM i)
SELECT feature, {r6('importance')} AS importance FROM i, q, auc WHERE a >= 0.45 AND importance >= cut""")
def leaked_features(spark, folder):
    """The rule on given importances (information values) and a given AUC (amount against the later years)."""
    df = hold(marts.loans(spark, folder, "loan_id", *NUM, *CAT, "isDefault", "issueDate"))
    auc = ranking.evaluate(df.select("loanAmnt", (F.year("issueDate") > 1999).cast("int").alias("late")), "loanAmnt", "late").first()["auc"]
    table = binning.iv_summary(binning.fit_woe(df, NUM, CAT, "isDefault").table).select("feature", F.col("iv").alias("importance"))
    return rounded(selection.leaking_features(table, auc, 0.45, 0.8))


@lru_cache(maxsize=2)
def _adversarial(spark, folder):
    train, test = _early_late(_loans(spark, folder, "issueDate"))
    return selection.adversarial(train, test, FEATURES, "loan_id", 5, learning.boosted(10, 3))


@query("adversarial_report")
def adversarial_report(spark, folder):
    return rounded(_adversarial(spark, folder).report())


@query("adversarial_drops")
def adversarial_drops(spark, folder):
    """Every feature with its cumulative share of the train-against-later importance and whether it would be dropped."""
    a = _adversarial(spark, folder)
    drop = a.to_drop(0.5).select("feature", F.lit(True).alias("dropped"))
    out = a.report(len(FEATURES)).join(drop, "feature", "left")
    return rounded(out.select("feature", "importance", F.coalesce("dropped", F.lit(False)).alias("dropped")))


PAIRS = FEATURES


@query("feature_correlations", f"""
WITH {LOAN} {' UNION ALL '.join(f"SELECT '{a}' AS a, '{b}' AS b, {r6(f'corr({a}, {b})')} AS r FROM loan" for i, a in enumerate(PAIRS) for b in PAIRS[i + 1:])}""")
def feature_correlations(spark, folder):
    return rounded(moments.correlations(marts.loans(spark, folder, *PAIRS), PAIRS).drop("pa", "pb"))


@query("correlation_filter", f"""
WITH {LOAN}, p AS ({' UNION ALL '.join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM loan" for i, a in enumerate(PAIRS) for b in PAIRS[i + 1:])})
SELECT f AS feature FROM (SELECT unnest({PAIRS}) AS f) WHERE f NOT IN (SELECT a FROM p WHERE abs(r) > 0.8)""")
def correlation_filter(spark, folder):
    from loanloom.operators.profiling import small_frame

    kept = selection.correlation_filter(marts.loans(spark, folder, *PAIRS), PAIRS, 0.8)
    return small_frame(spark, [{"feature": f} for f in kept])


GIVEN_IV = {"loanAmnt": 0.03, "interestRate": 0.2, "annualIncome": 0.05, "n0": 0.4, "n1": 0.35, "n2": 0.01, "n3": 0.02, "n4": 0.1}


@query("correlation_filter_by_iv", f"""
WITH RECURSIVE {LOAN}, p AS ({' UNION ALL '.join(f"SELECT {i} AS pa, {j} AS pb, '{a}' AS a, '{b}' AS b, {GIVEN_IV[a]} < {GIVEN_IV[b]} AS first, corr({a}, {b}) AS r FROM loan" for i, a in enumerate(PAIRS) for j, b in enumerate(PAIRS) if i < j)}),
s AS (SELECT *, row_number() OVER (ORDER BY pa, pb) AS k FROM p WHERE abs(r) > 0.1),
walk(k, gone) AS (SELECT 0, []::VARCHAR[] UNION ALL
  SELECT s.k, CASE WHEN list_contains(gone, a) OR list_contains(gone, b) THEN gone WHEN s.first THEN list_append(gone, a) ELSE list_append(gone, b) END
  FROM walk JOIN s ON s.k = walk.k + 1)
SELECT f AS feature FROM (SELECT unnest({PAIRS}) AS f) WHERE NOT list_contains((SELECT arg_max(gone, k) FROM walk), f)""")
def correlation_filter_by_iv(spark, folder):
    """Of two strongly correlated features the one with the lower information value goes."""
    from loanloom.operators.profiling import small_frame

    kept = selection.correlation_filter(marts.loans(spark, folder, *PAIRS), PAIRS, 0.1, GIVEN_IV)
    return small_frame(spark, [{"feature": f} for f in kept])


@query("selected_features")
def selected_features(spark, folder):
    train, test = _early_late(_loans(spark, folder, "issueDate"))
    return rounded(selection.select_features(train, FEATURES, "isDefault", "loan_id", test, runs=10))
