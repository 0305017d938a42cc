"""Stability and monitoring reports."""

from pyspark.sql import functions as F

from loanloom.operators import drift, ranking
from loanloom.plans.catalog import query
from loanloom.plans.check_sql import LOAN, SCORED, edges_sql, left_bin, r6
from loanloom.plans.profile_queries import rounded
from loanloom.plans.ranking_queries import KS, curve_sql
from loanloom.session import hold
from loanloom.sources import marts

SIDES = SCORED + f""",
base AS (SELECT * FROM scored WHERE year(issueDate) <= 1999), cur AS (SELECT * FROM scored WHERE year(issueDate) > 1999)"""


def psi_sql(col, pe, pa, shown_e="pe", shown_a="pa"):
    return f"""e AS {edges_sql(col, 'base')}, spine AS (SELECT unnest(range(1, len(e)::BIGINT)) AS bin, e FROM e),
ec AS (SELECT {left_bin(col)} AS bin, count(*) AS c FROM base, e WHERE {col} IS NOT NULL GROUP BY 1),
ac AS (SELECT {left_bin(col)} AS bin, count(*) AS c FROM cur, e WHERE {col} IS NOT NULL GROUP BY 1),
nn AS (SELECT (SELECT count({col}) FROM base) AS en, (SELECT count({col}) FROM cur) AS an),
sh AS (SELECT bin, e[bin] AS lo, e[bin + 1] AS hi, {pe} AS pe, {pa} AS pa FROM
   (SELECT spine.bin, e, coalesce(ec.c, 0) AS ec, coalesce(ac.c, 0) AS ac, en, an FROM spine LEFT JOIN ec USING (bin) LEFT JOIN ac USING (bin), nn)),
det AS (SELECT lo AS bin_low, hi AS bin_high, {shown_e} AS exp_pct, {shown_a} AS act_pct, (pa - pe) * ln(pa / pe) AS psi FROM sh)"""


SMOOTHED = ("ec / (en + 1e-6) + 1e-6", "ac / (an + 1e-6) + 1e-6")
REPLACED = ("CASE WHEN ec = 0 THEN 1e-6 ELSE ec / en END", "CASE WHEN ac = 0 THEN 1e-6 ELSE ac / an END")
SHIFTED = ("ec / en + 1e-6", "ac / an + 1e-6", "pe - 1e-6", "pa - 1e-6")


def _sides(spark, folder, *cols):
    df = hold(marts.scores(spark, folder, "issueDate", *cols))
    early = F.year("issueDate") <= 1999
    return df.where(early), df.where(~early)


@query("psi_detail", f"""
WITH {SIDES}, {psi_sql('loanAmnt', *SMOOTHED)}
SELECT {r6('bin_low')} AS bin_low, {r6('bin_high')} AS bin_high, {r6('exp_pct')} AS exp_pct, {r6('act_pct')} AS act_pct, {r6('psi')} AS psi,
  psi > 0.025 AS drifting FROM det""")
def psi_detail(spark, folder):
    base, cur = _sides(spark, folder, "loanAmnt")
    return rounded(drift.psi_detail(base, cur, "loanAmnt"))


@query("psi_replace_zero", f"WITH {SIDES}, {psi_sql('score', *REPLACED)} SELECT {r6('sum(psi)')} AS psi FROM det")
def psi_replace_zero(spark, folder):
    base, cur = _sides(spark, folder)
    return rounded(drift.psi(base, cur, "score", variant="replace"))


@query("psi_shifted", f"""
WITH {SIDES}, {psi_sql('score', *SHIFTED)}
SELECT {r6('bin_low')} AS bin_low, {r6('bin_high')} AS bin_high, {r6('exp_pct')} AS exp_pct, {r6('act_pct')} AS act_pct, {r6('psi')} AS psi,
  psi > 0.025 AS drifting FROM det""")
def psi_shifted(spark, folder):
    base, cur = _sides(spark, folder)
    return rounded(drift.psi_detail(base, cur, "score", variant="shifted"))


MON = ["loanAmnt", "annualIncome", "interestRate"]


def num_psi_sql(c):
    return f"""(SELECT sum((pa - pe) * ln(pa / pe)) FROM (SELECT coalesce(c, 0) / (SELECT count({c}) FROM cur) + 1e-6 AS pa, 1 / (len(e) - 1) + 1e-6 AS pe
    FROM (SELECT unnest(range(1, len(e)::BIGINT)) AS bin, e FROM {edges_sql(c, 'base')}) LEFT JOIN
    (SELECT {left_bin(c)} AS bin, count(*) AS c FROM cur, {edges_sql(c, 'base')} WHERE {c} IS NOT NULL GROUP BY 1) USING (bin)))"""


MONITOR = SIDES + f""",
cat AS (SELECT sum((a - e) * ln((a + 1e-6) / (e + 1e-6))) AS psi FROM (SELECT coalesce(x.s, 1e-6) AS e, coalesce(y.s, 1e-6) AS a FROM
  (SELECT purpose, count(*) / sum(count(*)) OVER () AS s FROM base GROUP BY 1) x FULL JOIN
  (SELECT purpose, count(*) / sum(count(*)) OVER () AS s FROM cur GROUP BY 1) y USING (purpose))),
mon AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, {num_psi_sql(c)} AS psi, (SELECT 1 - count({c}) / count(*) FROM cur) AS now, (SELECT 1 - count({c}) / count(*) FROM base) AS was" for c in MON)}
  UNION ALL SELECT 'purpose', psi, 0, 0 FROM cat),
rep AS (SELECT feature, round(psi, 4) + 0 AS psi, round(now, 4) + 0 AS current_missing_rate, round(now - was, 4) + 0 AS missing_rate_change,
  CASE WHEN psi > 0.0001 OR abs(now - was) > 0.1 THEN 'ALERT' ELSE 'OK' END AS status, '2001-08-01' AS report_date FROM mon)"""


@query("feature_monitor", f"WITH {MONITOR} SELECT * FROM rep")
def feature_monitor(spark, folder):
    base, cur = _sides(spark, folder, *MON, "purpose")
    return drift.monitor_features(drift.fit_baseline(base, [*MON, "purpose"]), cur, 0.0001, "2001-08-01")


@query("feature_baseline", f"""
WITH {SIDES} {' UNION ALL '.join(f"SELECT '{c}' AS feature, unnest(range(len(e)))::INT AS point, {r6('unnest(e)')} AS value FROM {edges_sql(c, 'base')}" for c in MON)}""")
def feature_baseline(spark, folder):
    base, _ = _sides(spark, folder, *MON)
    return rounded(drift.baseline_table(drift.fit_baseline(base, MON), spark))


SCOREMON = f"""{psi_sql('score', *SHIFTED)},
sm AS (SELECT (SELECT sum(psi) FROM det) AS psi, (SELECT quantile_cont(score, [0.1, 0.25, 0.5, 0.75, 0.9]) FROM base) AS b,
  (SELECT quantile_cont(score, [0.1, 0.25, 0.5, 0.75, 0.9]) FROM cur) AS c, (SELECT avg((score <= 0.1)::INT) FROM cur) - (SELECT avg((score <= 0.1)::INT) FROM base) AS d)"""


@query("score_monitor", f"""
WITH {SIDES}, {SCOREMON} SELECT {r6('psi')} AS psi, CASE WHEN psi > 0.1 THEN 'ALERT' ELSE 'OK' END AS status,
  {', '.join(f'{r6(f"c[{i + 1}] - b[{i + 1}]")} AS p{p}_shift' for i, p in enumerate((10, 25, 50, 75, 90)))}, {r6('d')} AS pass_rate_shift FROM sm""")
def score_monitor(spark, folder):
    return rounded(drift.monitor_score(*_sides(spark, folder), "score"))


@query("first_payment_alert", f"""
WITH {LOAN} SELECT {r6('avg(isDefault)')} AS fpd, avg(isDefault) > 0.024 AS alert FROM loan WHERE issueDate >= DATE '2001-07-01' - 7""")
def first_payment_alert(spark, folder):
    df = marts.loans(spark, folder, "issueDate", "isDefault")
    return rounded(drift.first_payment_alert(df, "issueDate", "isDefault", "2001-07-01"))


@query("daily_report", f"""
WITH {MONITOR}, {SCOREMON}, fp AS (SELECT avg(isDefault) AS fpd FROM loan WHERE issueDate >= DATE '2001-07-01' - 7)
SELECT '2001-07-01' AS report_date, 'card' AS model_name, 'v1' AS model_version,
  (SELECT count(*) FROM rep WHERE status = 'ALERT') AS n_features_alert,
  (SELECT string_agg(feature, ',' ORDER BY psi DESC, feature DESC) FROM rep) AS top_psi_features,
  {r6('sm.psi')} AS score_psi, {r6('fpd')} AS fpd, fpd > 0.024 AS fpd_alert,
  CASE WHEN sm.psi <= 0.1 AND fpd <= 0.024 THEN 'all_normal' ELSE concat_ws(',', CASE WHEN sm.psi > 0.2 THEN 'score_drift_investigate'
    WHEN sm.psi > 0.1 THEN 'score_drift_watch' END, CASE WHEN fpd > 0.024 THEN 'fpd_above_target_tighten' END) END AS recommendation FROM sm, fp""")
def daily_report(spark, folder):
    base, cur = _sides(spark, folder, *MON, "purpose")
    feats = drift.monitor_features(drift.fit_baseline(base, [*MON, "purpose"]), cur, 0.0001, "2001-07-01")
    fpd = drift.first_payment_alert(marts.loans(spark, folder, "issueDate", "isDefault"), "issueDate", "isDefault", "2001-07-01")
    return rounded(drift.daily_report(feats, drift.monitor_score(base, cur, "score"), fpd, "card", "v1", "2001-07-01"))


@query("iteration_triggers", f"""
WITH {SCORED}, m AS (SELECT (year(issueDate) * 12 + month(issueDate) - 1)::INT AS month_idx, score, label FROM scored), {curve_sql('m', 'month_idx')},
k AS (SELECT month_idx, {KS} AS ks FROM c GROUP BY 1),
l AS (SELECT *, lag(ks, 1) OVER w AS a, lag(ks, 2) OVER w AS b, lag(ks, 3) OVER w AS d FROM k WINDOW w AS (ORDER BY month_idx))
SELECT month_idx, {r6('ks')} AS ks, coalesce(ks < a AND a < b AND b < d AND d - ks > 0.05, false) AS ks_trigger FROM l""")
def iteration_triggers(spark, folder):
    idx = (F.year("issueDate") * 12 + F.month("issueDate") - 1).alias("month_idx")
    df = hold(marts.scores(spark, folder, "issueDate").select(idx, "score", "label"))
    monthly = ranking.evaluate(df, "score", "label", ["month_idx"]).select("month_idx", "ks")
    return rounded(drift.iteration_triggers(monthly))


@query("weekly_fpd_trigger", f"""
WITH {LOAN}, w AS (SELECT datediff('day', DATE '1970-01-01', issueDate) // 7 AS week, avg(isDefault) AS fpd FROM loan GROUP BY 1),
a AS (SELECT *, fpd > 0.1 * 1.5 AS above, row_number() OVER (ORDER BY week) - row_number() OVER (PARTITION BY fpd > 0.1 * 1.5 ORDER BY week) AS isl FROM w),
s AS (SELECT *, CASE WHEN above THEN row_number() OVER (PARTITION BY above, isl ORDER BY week) ELSE 0 END AS streak FROM a)
SELECT week::BIGINT AS week, {r6('fpd')} AS fpd, streak::INT AS streak, streak >= 4 AS fpd_trigger FROM s""")
def weekly_fpd_trigger(spark, folder):
    week = F.floor(F.datediff("issueDate", F.to_date(F.lit("1970-01-01"))) / 7).alias("week")
    weekly = marts.loans(spark, folder, "issueDate", "isDefault").groupBy(week).agg(F.avg("isDefault").alias("fpd"))
    return rounded(drift.weekly_fpd_trigger(weekly, target=0.1))
