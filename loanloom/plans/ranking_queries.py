"""Ranking metrics, cut-offs and blends."""

from pyspark.sql import functions as F

from loanloom.operators import ranking
from loanloom.plans.catalog import query
from loanloom.plans.check_sql import SCORED, edges_sql, r6, right_bin
from loanloom.plans.profile_queries import rounded
from loanloom.session import hold
from loanloom.sources import marts


def curve_sql(src: str, by: str = "", score: str = "score") -> str:
    """CTEs ``h`` (score histogram) and ``c`` (prefix sums, highest score first)."""
    keys, part = (f"{by}, ", f"PARTITION BY {by} ") if by else ("", "")
    return f"""h AS (SELECT {keys}{score} AS s, sum(label)::BIGINT AS bad, sum(1 - label)::BIGINT AS good FROM {src}
  WHERE {score} IS NOT NULL GROUP BY {keys}{score}),
c AS (SELECT *, sum(bad) OVER (PARTITION BY {by or '1'})::DOUBLE AS tb, sum(good) OVER (PARTITION BY {by or '1'})::DOUBLE AS tg,
    sum(bad) OVER ({part}ORDER BY s DESC)::DOUBLE AS cb, sum(good) OVER ({part}ORDER BY s DESC)::DOUBLE AS cg FROM h)"""


AUC = "sum(bad * (tg - cg + good / 2)) / max(tb * tg)"
KS = "max(cb / tb - cg / tg)"
KS_AT = "max({'k': cb / tb - cg / tg, 's': s})['s']"
AP = "sum(bad * cb / (cb + cg)) / max(tb)"

POS = SCORED + """,
p AS (SELECT loan_id, label, score, loanAmnt, row_number() OVER (ORDER BY score DESC, md5(loan_id::VARCHAR)) AS pos,
        count(*) OVER () AS n FROM scored)"""


def _scored(spark, folder, *extra):
    return marts.scores(spark, folder, *extra)


@query("model_metrics", f"""
WITH {SCORED}, {curve_sql('scored')}
SELECT (sum(bad) + sum(good))::BIGINT AS n, sum(bad)::BIGINT AS bad, {r6(AUC)} AS auc, {r6(f'2 * {AUC} - 1')} AS gini, {r6(KS)} AS ks,
  {r6(KS_AT)} AS ks_threshold, {r6(AP)} AS ap FROM c""")
def model_metrics(spark, folder):
    return rounded(ranking.evaluate(hold(_scored(spark, folder).select("score", "label"))))


@query("compare_models", f"""
WITH {SCORED}, long AS (SELECT label, 'score' AS model, score AS v FROM scored UNION ALL SELECT label, 'score2', score2 FROM scored
  UNION ALL SELECT label, 'score3', score3 FROM scored), {curve_sql('long', 'model', 'v')}
SELECT model, {r6(AUC)} AS auc, {r6(f'2 * {AUC} - 1')} AS gini, {r6(KS)} AS ks, {r6(AP)} AS ap FROM c GROUP BY 1""")
def compare_models(spark, folder):
    df = hold(_scored(spark, folder).select("label", "score", "score2", "score3"))
    return rounded(ranking.compare_models(df, ["score", "score2", "score3"]))


@query("roc_table", f"""
WITH {SCORED}, {curve_sql('scored')} SELECT {r6('s')} AS threshold, {r6('cb / tb')} AS tpr, {r6('cg / tg')} AS fpr, {r6('cb / tb - cg / tg')} AS diff FROM c""")
def roc_table(spark, folder):
    return rounded(ranking.roc_table(hold(_scored(spark, folder).select("score", "label"))))


@query("pr_table", f"""
WITH {SCORED}, {curve_sql('scored')}
SELECT {r6('s')} AS threshold, {r6('cb / (cb + cg)')} AS precision, {r6('cb / tb')} AS recall,
  {r6('bad / tb * (cb / (cb + cg) + CASE WHEN cb + cg = bad + good THEN 1 ELSE (cb - bad) / (cb + cg - bad - good) END) / 2')} AS area FROM c""")
def pr_table(spark, folder):
    return rounded(ranking.pr_table(hold(_scored(spark, folder).select("score", "label"))))


@query("ks_table", f"""
WITH {POS}, d AS (SELECT least((pos - 1) * 10 // n + 1, 10)::INT AS decile, min(score) AS score_min, max(score) AS score_max,
  count(*) AS count, sum(label)::BIGINT AS bad FROM p GROUP BY 1),
w AS (SELECT *, count - bad AS good, sum(bad) OVER (ORDER BY decile) / sum(bad) OVER () AS cb,
  sum(count - bad) OVER (ORDER BY decile) / sum(count - bad) OVER () AS cg FROM d)
SELECT decile, score_min, score_max, count, bad, good, {r6('bad / count')} AS bad_rate, {r6('cb')} AS cum_bad_pct, {r6('cg')} AS cum_good_pct,
  {r6('abs(cb - cg)')} AS ks FROM w""")
def ks_table(spark, folder):
    return rounded(ranking.ks_table(hold(_scored(spark, folder).select("loan_id", "score", "label")), "score", "label", "loan_id"))


@query("ks_by_value_decile", f"""
WITH {SCORED}, e AS {edges_sql('score', 'scored')},
d AS (SELECT (len(e) - 1 - {right_bin('score')})::INT AS decile, count(*) AS total, sum(label)::BIGINT AS bad FROM scored, e GROUP BY 1),
w AS (SELECT *, total - bad AS good, sum(bad) OVER (ORDER BY decile) / sum(bad) OVER () AS cb,
  sum(total - bad) OVER (ORDER BY decile) / sum(total - bad) OVER () AS cg FROM d)
SELECT decile, total, bad, good, {r6('bad / total')} AS bad_rate, {r6('cb')} AS cum_bad_pct, {r6('cg')} AS cum_good_pct, {r6('abs(cb - cg)')} AS ks FROM w""")
def ks_by_value_decile(spark, folder):
    return rounded(ranking.ks_by_value_decile(hold(_scored(spark, folder).select("score", "label")), "score", "label"))


@query("lift_table", f"""
WITH {POS}, d AS (SELECT greatest(ceil((pos - 1) * 10 / (n - 1)), 1)::INT AS decile, count(*) AS count, sum(label)::BIGINT AS bad FROM p GROUP BY 1),
w AS (SELECT *, sum(bad) OVER (ORDER BY decile) / sum(bad) OVER () AS cb, sum(count) OVER (ORDER BY decile) / sum(count) OVER () AS cp FROM d)
SELECT decile, count, bad, {r6('bad / count')} AS bad_rate, {r6('cb')} AS cum_bad_capture, {r6('cp')} AS pct_population, {r6('cb / cp')} AS lift FROM w""")
def lift_table(spark, folder):
    return rounded(ranking.lift_table(hold(_scored(spark, folder).select("loan_id", "score", "label")), "score", "label", "loan_id"))


@query("lift_curve", f"""
WITH {POS}, w AS (SELECT *, sum(label) OVER (ORDER BY pos) AS cb, sum(label) OVER () AS tb FROM p)
SELECT loan_id, score, label, pos, cb::BIGINT AS cum_bad, {r6('pos / n')} AS pct_population, {r6('cb / tb')} AS cum_bad_rate,
  {r6('(cb / tb) / (pos / n)')} AS lift FROM w""")
def lift_curve(spark, folder):
    return rounded(ranking.lift_curve(hold(_scored(spark, folder).select("loan_id", "score", "label")), "score", "label", "loan_id"))


@query("risk_model_metrics", f"""
WITH {SCORED}, {curve_sql('scored')}, k AS (SELECT {AUC} AS auc, {KS} AS ks, {KS_AT} AS ks_at FROM c),
m AS (SELECT count(*) FILTER (score >= 0.3 AND label = 1) AS tp, count(*) FILTER (score >= 0.3 AND label = 0) AS fp,
  count(*) FILTER (score < 0.3 AND label = 0) AS tn, count(*) FILTER (score < 0.3 AND label = 1) AS fn FROM scored)
SELECT tp, fp, tn, fn, {r6('tp / (tp + fp)')} AS precision, {r6('tp / (tp + fn)')} AS recall, {r6('fp / (fp + tn)')} AS good_fp_rate,
  {r6('2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn))')} AS f1, {r6('tp / (tp + fn)')} AS bad_capture_rate,
  {r6('auc')} AS auc, {r6('ks')} AS ks, {r6('ks_at')} AS ks_threshold FROM m, k""")
def risk_model_metrics(spark, folder):
    return rounded(ranking.risk_model_metrics(hold(_scored(spark, folder).select("score", "label")), "score", "label", 0.3))


@query("calibration_table", f"""
WITH {SCORED}, e AS (SELECT [{', '.join(str(i / 10) for i in range(11))}]::DOUBLE[] AS e)
SELECT {right_bin('score')} AS bin, {r6('avg(score)')} AS mean_predicted, {r6('avg(label)')} AS observed, count(*) AS n FROM scored, e GROUP BY 1""")
def calibration_table(spark, folder):
    return rounded(ranking.calibration_table(_scored(spark, folder), "score", "label"))


@query("brier_score", f"WITH {SCORED} SELECT {r6('avg((score - label) ** 2)')} AS brier FROM scored")
def brier_score(spark, folder):
    return rounded(ranking.brier_score(_scored(spark, folder), "score", "label"))


@query("rejection_analysis", f"""
WITH {POS}, r AS (SELECT unnest([0.1, 0.2, 0.3, 0.4]) AS reject_rate)
SELECT reject_rate::DOUBLE AS reject_rate, {r6('sum(label) FILTER (pos <= floor(n * reject_rate)) / sum(label)')} AS reject_bad_capture,
  {r6('avg(label) FILTER (pos > floor(n * reject_rate))')} AS approve_bad_rate,
  {r6('avg(label) FILTER (pos <= floor(n * reject_rate))')} AS reject_bad_rate FROM p, r GROUP BY 1""")
def rejection_analysis(spark, folder):
    return rounded(ranking.rejection_analysis(
        hold(_scored(spark, folder).select("loan_id", "score", "label")), "score", "label", "loan_id"))


@query("pass_rate_curve", f"""
WITH {SCORED}, q AS (SELECT quantile_cont(score, [{', '.join(str(i / 19) for i in range(20))}]) AS e FROM scored),
t AS (SELECT unnest(range(20)) AS point, unnest(e) AS thr FROM q)
SELECT point::INT AS point, {r6('thr')} AS threshold, {r6('avg((score <= thr)::INT)')} AS pass_rate,
  {r6('coalesce(avg(label) FILTER (score <= thr), 0)')} AS approve_bad_rate, {r6('avg(label) FILTER (score > thr)')} AS reject_bad_rate
FROM scored, t GROUP BY 1, thr""")
def pass_rate_curve(spark, folder):
    return rounded(ranking.pass_rate_curve(hold(_scored(spark, folder).select("score", "label")), "score", "label"))


@query("cutoffs_for_pass_rates", f"""
WITH {SCORED}, q AS (SELECT quantile_cont(1000 - 1000 * score, [0.6, 0.5, 0.4, 0.30000000000000004]) AS e FROM scored),
t AS (SELECT unnest([0.4, 0.5, 0.6, 0.7]) AS rate, unnest(e) AS thr FROM q), s AS (SELECT 1000 - 1000 * score AS pts, label FROM scored)
SELECT rate::DOUBLE AS target_pass_rate, round_even(thr, 0) AS cutoff_score, {r6('avg((pts >= thr)::INT)')} AS actual_pass_rate,
  {r6('coalesce(avg(label) FILTER (pts >= thr), 0)')} AS pass_bad_rate, {r6('avg(label) FILTER (pts < thr)')} AS reject_bad_rate FROM s, t GROUP BY 1, thr""")
def cutoffs_for_pass_rates(spark, folder):
    df = hold(_scored(spark, folder).select((1000 - 1000 * F.col("score")).alias("points"), "label"))
    return rounded(ranking.cutoffs_for_pass_rates(df, "points", "label"))


@query("precision_at_recall", f"""
WITH {SCORED}, {curve_sql('scored')}, t AS (SELECT unnest([0.7, 0.8, 0.9])::DOUBLE AS target_recall),
r AS (SELECT *, row_number() OVER (PARTITION BY target_recall ORDER BY abs(cb / tb - target_recall), s) AS k FROM c, t)
SELECT target_recall, {r6('cb / (cb + cg)')} AS precision, {r6('cb / tb')} AS recall, {r6('s')} AS threshold FROM r WHERE k = 1""")
def precision_at_recall(spark, folder):
    return rounded(ranking.precision_at_recall(hold(_scored(spark, folder).select("score", "label")), "score", "label"))


@query("capture_in_top", f"""
WITH {POS}, r AS (SELECT unnest([0.05, 0.1, 0.2]) AS reject_rate)
SELECT reject_rate::DOUBLE AS reject_rate, {r6('sum(label) FILTER (pos <= floor(n * reject_rate)) / sum(label)')} AS case_capture,
  {r6('sum(label * loanAmnt) FILTER (pos <= floor(n * reject_rate)) / sum(label * loanAmnt)')} AS amount_capture FROM p, r GROUP BY 1""")
def capture_in_top(spark, folder):
    df = hold(_scored(spark, folder, "loanAmnt").select("loan_id", "score", "label", "loanAmnt"))
    return rounded(ranking.capture_in_top(df, "score", "label", "loanAmnt", "loan_id"))


@query("metrics_by_month", f"""
WITH {SCORED}, m AS (SELECT strftime(issueDate, '%Y-%m') AS month, score, label FROM scored), {curve_sql('m', 'month')}
SELECT month, (sum(bad) + sum(good))::BIGINT AS n, {r6('sum(bad) / (sum(bad) + sum(good))')} AS bad_rate, {r6(AUC)} AS auc, {r6(KS)} AS ks
FROM c GROUP BY 1 HAVING sum(bad) >= 5""")
def metrics_by_month(spark, folder):
    df = _scored(spark, folder, "issueDate").select(F.date_format("issueDate", "yyyy-MM").alias("month"), "score", "label")
    return rounded(ranking.metrics_by_period(hold(df), "score", "label", "month"))


@query("fairness_audit", f"""
WITH {SCORED}, {curve_sql('scored', 'purpose')}, md AS (SELECT quantile_cont(score, 0.5) AS md FROM scored),
ps AS (SELECT purpose, avg((score <= md)::INT) AS pr FROM scored, md GROUP BY 1),
o AS (SELECT sum(bad * (tg - cg + good / 2)) / max(tb * tg) AS auc FROM (SELECT *, sum(bad) OVER ()::DOUBLE AS tb, sum(good) OVER ()::DOUBLE AS tg,
  sum(bad) OVER (ORDER BY s DESC)::DOUBLE AS cb, sum(good) OVER (ORDER BY s DESC)::DOUBLE AS cg
  FROM (SELECT score AS s, sum(label) AS bad, sum(1 - label) AS good FROM scored GROUP BY 1)))
SELECT purpose, (sum(bad) + sum(good))::BIGINT AS n, {r6('sum(bad) / (sum(bad) + sum(good))')} AS bad_rate, {r6(AUC)} AS auc, {r6(KS)} AS ks,
  {r6('any_value(pr)')} AS pass_rate_at_median, {r6(f'{AUC} - any_value(o.auc)')} AS auc_gap
FROM c JOIN ps USING (purpose), o GROUP BY 1 HAVING sum(bad) + sum(good) >= 30""")
def fairness_audit(spark, folder):
    df = hold(_scored(spark, folder, "purpose").select("purpose", "score", "label"))
    return rounded(ranking.fairness_audit(df, "score", "label", "purpose"))


def _rank_sql(s):
    return f"(rank() OVER (ORDER BY {s}) + (count(*) OVER (PARTITION BY {s}) - 1) / 2) / count(*) OVER ()"


@query("rank_blend", f"""
WITH {SCORED}, r AS (SELECT loan_id, {_rank_sql('score')} AS a, {_rank_sql('score2')} AS b, {_rank_sql('score3')} AS c FROM scored)
SELECT loan_id, {r6('(a + 2 * b + 2 * c) / 5')} AS blend FROM r""")
def rank_blend(spark, folder):
    df = hold(_scored(spark, folder).select("loan_id", "score", "score2", "score3"))
    return rounded(ranking.rank_blend(df, ["score", "score2", "score3"], "loan_id", [1, 2, 2]).select("loan_id", "blend"))


@query("probability_blend", f"""
WITH {SCORED} SELECT loan_id, {r6('(score + 2 * score2) / 3')} AS blend FROM scored""")
def probability_blend(spark, folder):
    return _scored(spark, folder).select(
        "loan_id", F.round(ranking.probability_blend(["score", "score2"], [1, 2]), 6).alias("blend"))
