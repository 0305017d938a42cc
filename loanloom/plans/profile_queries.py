"""Profiles, group statistics, vintage and report tables."""

from pyspark.sql import functions as F

from loanloom.functions.hashing import experiment_arm
from loanloom.operators import binning, profiling
from loanloom.plans.catalog import query
from loanloom.plans.check_sql import LOAN, PERFORMANCE, SCORED, SNAPSHOT, edges_sql, r6, right_bin
from loanloom.session import hold
from loanloom.sources import marts
from loanloom.sources.tables import load_summary, table


def rounded(df, *skip):
    """Round the double columns of a result to six digits."""
    return df.select(*[
        F.round(F.col(f"`{n}`"), 6).alias(n) if t == "double" and n not in skip else F.col(f"`{n}`") for n, t in df.dtypes
    ])


@query("load_summary", f"""
WITH {LOAN} SELECT count(*) AS n_rows, 17::INT AS n_columns, {r6('avg(isDefault)')} AS bad_rate FROM loan""")
def load_summary_query(spark, folder):
    return rounded(load_summary(marts.loans(spark, folder)))


@query("group_statistics", f"""
WITH {LOAN}, g AS (SELECT grade, {', '.join(
    f'{fn}({c}) AS "{c}_{n}_by_grade"' for c in ('loanAmnt', 'interestRate')
    for n, fn in (('mean', 'avg'), ('std', 'stddev_samp'), ('min', 'min'), ('max', 'max')))} FROM loan GROUP BY 1)
SELECT loan_id, {', '.join(f'{r6(chr(34) + c + "_" + n + "_by_grade" + chr(34))} AS "{c}_{n}_by_grade"'
    for c in ('loanAmnt', 'interestRate') for n in ('mean', 'std', 'min', 'max'))} FROM loan JOIN g USING (grade)""")
def group_statistics(spark, folder):
    df = marts.loans(spark, folder, "loan_id", "grade", "loanAmnt", "interestRate")
    out = profiling.group_statistics(df, ["grade"], ["loanAmnt", "interestRate"])
    return rounded(out.drop("grade", "loanAmnt", "interestRate"))


@query("window_statistics", f"""
WITH m AS (SELECT max(o_orderdate)::DATE AS d FROM orders),
x AS (SELECT o_custkey AS customer_id, o_orderdate::DATE AS dt, o_totalprice AS v, d FROM orders, m
      WHERE o_orderdate::DATE >= d - INTERVAL 6 MONTH)
SELECT customer_id, {', '.join(
    f'{r6(f"{fn}(v) FILTER (dt >= d - INTERVAL {k} MONTH)")} AS amount_m{k}_{n}' if n != 'count' else
    f'nullif(count(*) FILTER (dt >= d - INTERVAL {k} MONTH), 0)::DOUBLE AS amount_m{k}_count'
    for k in (1, 3, 6) for n, fn in (('sum', 'sum'), ('mean', 'avg'), ('max', 'max'), ('min', 'min'),
                                     ('count', ''), ('std', 'stddev_samp')))} FROM x GROUP BY 1""")
def window_statistics(spark, folder):
    df = marts.loans(spark, folder, "customer_id", "issueDate", "loanAmnt").withColumnRenamed("loanAmnt", "amount")
    return rounded(profiling.window_statistics(df, "customer_id", "issueDate", "amount"))


OVERVIEW = ["loanAmnt", "annualIncome", "interestRate", "grade", "purpose", "n1", "isDefault"]


@query("data_overview", f"""
WITH {LOAN} {' UNION ALL '.join(
    f'''SELECT '{c}' AS feature, {r6(f'1 - count({c}) / count(*)')} AS missing_rate, count(DISTINCT {c}) AS nunique,
    {r6(f'corr({c}, isDefault)') if c not in ('grade', 'purpose', 'isDefault') else 'NULL::DOUBLE'} AS corr_with_target FROM loan'''
    for c in OVERVIEW)}""")
def data_overview(spark, folder):
    df = hold(marts.loans(spark, folder, *OVERVIEW))
    return rounded(profiling.overview(df, "isDefault").drop("dtype"))


NUMS = ["loanAmnt", "annualIncome", "interestRate", "n1"]


@query("numeric_profile", f"""
WITH {LOAN} {' UNION ALL '.join(
    f'''SELECT '{c}' AS feature, {r6(f'1 - count({c}) / count(*)')} AS missing_rate, {r6(f'avg({c})')} AS mean,
    {r6(f'stddev_samp({c})')} AS std, {r6(f'corr({c}, isDefault)')} AS corr_with_y,
    {', '.join(f'{r6(f"quantile_cont({c}, {p})")} AS p{round(p * 100)}' for p in profiling.PERCENTILES)} FROM loan'''
    for c in NUMS)}""")
def numeric_profile(spark, folder):
    df = hold(marts.loans(spark, folder, *NUMS, "isDefault"))
    return rounded(profiling.numeric_profile(df, NUMS, "isDefault"))


@query("top_values", f"""
WITH {LOAN}, c AS ({' UNION ALL '.join(
    f"SELECT '{c}' AS feature, {c}::VARCHAR AS value, count(*) AS n FROM loan WHERE {c} IS NOT NULL GROUP BY 2"
    for c in ('grade', 'purpose', 'regionCode'))}),
r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) AS rank,
        sum(n) OVER (PARTITION BY feature) AS total FROM c)
SELECT feature, rank::INT AS rank, value, {r6('n / total')} AS share FROM r WHERE rank <= 5""")
def top_values(spark, folder):
    return rounded(profiling.top_values(marts.loans(spark, folder, "grade", "purpose", "regionCode"),
                                        ["grade", "purpose", "regionCode"]))


@query("monthly_target", f"""
WITH {LOAN} SELECT strftime(issueDate, '%Y-%m') AS month, count(*) AS total, sum(isDefault)::BIGINT AS bad,
  {r6('sum(isDefault) / count(*)')} AS bad_rate FROM loan GROUP BY 1""")
def monthly_target(spark, folder):
    return rounded(profiling.monthly_target(marts.loans(spark, folder, "issueDate", "isDefault"), "issueDate", "isDefault"))


@query("yearly_bad_rate", f"""
WITH {LOAN} SELECT year(issueDate)::INT AS year, {r6('avg(isDefault)')} AS bad_rate, count(*) AS n_loans FROM loan GROUP BY 1""")
def yearly_bad_rate(spark, folder):
    df = marts.loans(spark, folder, "issueDate", "isDefault")
    return df.groupBy(F.year("issueDate").alias("year")).agg(
        F.round(F.avg("isDefault"), 6).alias("bad_rate"), F.count("*").alias("n_loans"))


DIMS = ["grade", "homeOwnership", "purpose", "regionCode"]


@query("bad_rate_by_category", f"""
WITH {LOAN} {' UNION ALL '.join(
    f"SELECT '{c}' AS dim, {c}::VARCHAR AS value, {r6('avg(isDefault)')} AS bad_rate, count(*) AS n FROM loan GROUP BY 2"
    for c in DIMS)}""")
def bad_rate_by_category(spark, folder):
    df = marts.loans(spark, folder, *DIMS, "isDefault")
    return rounded(profiling.bad_rate_by_category(df, DIMS, "isDefault").orderBy(F.desc("bad_rate")))


@query("amount_histogram", f"""
WITH {LOAN}, q AS (SELECT quantile_cont(loanAmnt, 0.01) AS lo, quantile_cont(loanAmnt, 0.99) AS hi FROM loan),
b AS (SELECT least(floor((greatest(lo, least(hi, loanAmnt)) - lo) / ((hi - lo) / 50)), 49)::INT AS bin, lo, hi FROM loan, q)
SELECT bin, count(*) AS n, {r6('any_value(lo) + bin * ((any_value(hi) - any_value(lo)) / 50)')} AS lower FROM b GROUP BY 1""")
def amount_histogram(spark, folder):
    return rounded(profiling.histogram(hold(marts.loans(spark, folder, "loanAmnt")), "loanAmnt"))


@query("vintage", f"""
WITH {PERFORMANCE} SELECT cohort, loan_age, {r6('avg(is_bad)')} AS bad_rate, count(*) AS n FROM performance GROUP BY 1, 2""")
def vintage(spark, folder):
    return rounded(profiling.vintage(marts.performance(spark, folder), "cohort", "loan_age", "is_bad"))


@query("vintage_matrix", f"""
WITH {PERFORMANCE}, long AS (SELECT cohort, loan_age, {r6('avg(is_bad)')} AS bad_rate FROM performance GROUP BY 1, 2),
c AS (SELECT DISTINCT cohort FROM long), a AS (SELECT DISTINCT loan_age FROM long)
SELECT cohort, loan_age, bad_rate FROM c CROSS JOIN a LEFT JOIN long USING (cohort, loan_age)""")
def vintage_matrix(spark, folder):
    long = profiling.vintage(marts.performance(spark, folder), "cohort", "loan_age", "is_bad")
    return rounded(profiling.matrix_cells(long, "cohort", "loan_age", "bad_rate").select("cohort", F.inline("cells")))


@query("vintage_by_score_band", f"""
WITH {SCORED}, {PERFORMANCE}, m AS (SELECT performance.*, score FROM scored JOIN performance USING (loan_id)),
e AS {edges_sql('score', 'm', 5)}
SELECT cohort, 'S' || {right_bin('score')} AS score_band, loan_age, {r6('avg(is_bad)')} AS bad_rate, count(*) AS n
FROM m, e GROUP BY 1, 2, 3""")
def vintage_by_score_band(spark, folder):
    scored = marts.scores(spark, folder).select("loan_id", "score")
    merged = hold(scored.join(marts.performance(spark, folder).drop("balance"), "loan_id"))
    edges = binning.quantile_edges(merged, ["score"], 5)["score"]
    banded = merged.withColumn("score_band", F.concat(F.lit("S"), binning.right_closed_bin("score", edges)))
    return rounded(profiling.vintage(banded, ["cohort", "score_band"], "loan_age", "is_bad"))


COVER = ["loanAmnt", "annualIncome", "interestRate", "n2", "n3"]


@query("feature_coverage", f"""
WITH {LOAN}, c AS ({' UNION ALL '.join(
    f'''SELECT '{c}' AS feature, {r6(f'1 - count({c}) / count(*)')} AS missing_rate, {r6(f'count({c}) / count(*)')} AS coverage_rate,
    {r6(f'count(*) FILTER ({c} = 0) / count(*)')} AS zero_rate FROM loan''' for c in COVER)})
SELECT *, CASE WHEN missing_rate < 0.05 THEN 'fill' WHEN missing_rate < 0.3 THEN 'flag' WHEN missing_rate < 0.7
  THEN 'verify' ELSE 'drop' END AS missing_action, CASE WHEN coverage_rate < 0.2 THEN 'exclude'
  WHEN coverage_rate < 0.5 THEN 'caution' ELSE 'use' END AS coverage_action FROM c""")
def feature_coverage(spark, folder):
    return rounded(profiling.coverage(marts.loans(spark, folder, *COVER), COVER))


@query("asset_quality", f"""
WITH {SNAPSHOT} SELECT (month_idx // 12) || '-' || lpad((month_idx % 12 + 1)::VARCHAR, 2, '0') AS month,
  {r6("sum(CASE WHEN current_dpd >= 2 THEN balance ELSE 0 END) / sum(balance)")} AS npl,
  {r6("sum(CASE WHEN current_dpd >= 1 THEN balance ELSE 0 END) / sum(balance)")} AS m1_plus,
  {r6('avg((current_dpd >= 1)::INT)')} AS fpd, {r6('avg((current_dpd >= 2)::INT)')} AS spd, count(*) AS n
FROM snapshot GROUP BY 1""")
def asset_quality(spark, folder):
    s = marts.snapshots(spark, folder).selectExpr(
        "*", "CAST(current_dpd >= 1 AS INT) AS is_fpd", "CAST(current_dpd >= 2 AS INT) AS is_spd")
    month = F.concat_ws("-", F.floor(F.col("month_idx") / 12), F.lpad((F.col("month_idx") % 12 + 1).cast("string"), 2, "0"))
    return rounded(profiling.asset_quality(s, month, F.col("current_dpd"), F.col("balance"), npl_from=2))


ARM_SQL = """(CASE WHEN
  (((( ('0x' || substr(md5(customer_id::VARCHAR), 1, 8))::BIGINT % 100) * 96
     + ('0x' || substr(md5(customer_id::VARCHAR), 9, 8))::BIGINT) % 100 * 96
     + ('0x' || substr(md5(customer_id::VARCHAR), 17, 8))::BIGINT) % 100 * 96
     + ('0x' || substr(md5(customer_id::VARCHAR), 25, 8))::BIGINT) % 100 < 30 THEN 'treatment' ELSE 'control' END)"""
ARMS = SCORED + f""", arms AS (SELECT {ARM_SQL} AS ab_group, (score <= 0.15)::INT AS is_approved, score AS risk_score,
  label AS is_fpd FROM scored)"""


def _arms(spark, folder):
    return marts.scores(spark, folder, "customer_id").select(
        experiment_arm("customer_id", 0.3).alias("ab_group"), (F.col("score") <= 0.15).cast("int").alias("is_approved"),
        F.col("score").alias("risk_score"), F.col("label").alias("is_fpd"))


@query("experiment_metrics", f"""
WITH {ARMS} SELECT ab_group, count(*) AS n_applications, {r6('avg(is_approved)')} AS pass_rate,
  {r6('avg(risk_score)')} AS avg_score, {r6('avg(is_fpd)')} AS fpd_rate FROM arms GROUP BY 1""")
def experiment_metrics(spark, folder):
    return rounded(profiling.arm_metrics(_arms(spark, folder)))


@query("experiment_t_test", f"""
WITH {ARMS}, s AS (SELECT
  count(*) FILTER (ab_group = 'control') AS n1, count(*) FILTER (ab_group = 'treatment') AS n2,
  avg(is_approved) FILTER (ab_group = 'control') AS m1, avg(is_approved) FILTER (ab_group = 'treatment') AS m2,
  var_samp(is_approved) FILTER (ab_group = 'control') AS v1, var_samp(is_approved) FILTER (ab_group = 'treatment') AS v2
  FROM arms),
t AS (SELECT (m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1 / n1 + 1 / n2)) AS t, (n1 + n2 - 2)::DOUBLE AS f FROM s),
d AS (SELECT t, f, abs(t) + u / (1 - u) AS x, u FROM t, (SELECT (i + 0.5) / {profiling.TAIL_POINTS} AS u FROM range({profiling.TAIL_POINTS}) r(i)))
SELECT {r6('any_value(t)')} AS t_stat,
  {r6(f"least(1, 2 * sum(exp(lgamma((f + 1) / 2) - lgamma(f / 2) - 0.5 * ln(f * pi()) - (f + 1) / 2 * ln(1 + x * x / f)) / pow(1 - u, 2)) / {profiling.TAIL_POINTS})")} AS p_value FROM d""")
def experiment_t_test(spark, folder):
    return rounded(profiling.pooled_t_test(_arms(spark, folder), "ab_group", "is_approved"))


STRATEGY = SCORED + """, log AS (SELECT CASE WHEN year(issueDate) <= 1998 THEN 'before' ELSE 'after' END AS period,
  CASE WHEN score < 0.1 THEN 'APPROVE' WHEN score < 0.3 THEN 'MANUAL_REVIEW' ELSE 'REJECT' END AS decision,
  (score < 0.1)::INT AS is_approved, loanAmnt AS credit_limit, interestRate AS interest_rate FROM scored)"""


@query("strategy_effect", f"""
WITH {STRATEGY} SELECT period, {r6('avg(is_approved)')} AS pass_rate,
  {r6("avg((decision = 'APPROVE')::INT)")} AS auto_approve_rate, {r6("avg((decision = 'MANUAL_REVIEW')::INT)")} AS manual_rate,
  {r6("avg((decision = 'REJECT')::INT)")} AS reject_rate, {r6('avg(credit_limit) FILTER (is_approved = 1)')} AS avg_credit_limit,
  {r6('avg(interest_rate) FILTER (is_approved = 1)')} AS avg_interest_rate FROM log GROUP BY 1""")
def strategy_effect(spark, folder):
    s = F.col("score")
    log = marts.scores(spark, folder, "issueDate", "loanAmnt", "interestRate").select(
        "issueDate", F.when(s < 0.1, "APPROVE").when(s < 0.3, "MANUAL_REVIEW").otherwise("REJECT").alias("decision"),
        (s < 0.1).cast("int").alias("is_approved"), F.col("loanAmnt").alias("credit_limit"),
        F.col("interestRate").alias("interest_rate"))
    early = F.year("issueDate") <= 1998
    return rounded(profiling.compare_periods(log.where(early).drop("issueDate"), log.where(~early).drop("issueDate")))


@query("score_bands_equal_width", f"""
WITH {SCORED}, p AS (SELECT *, round_even(600 + 20 / ln(2) * ln(1 / 50.0::DOUBLE) - 20 / ln(2) * ln(score / (1 - score + 1e-9)), 0)::INT AS pts FROM scored),
m AS (SELECT min(pts)::DOUBLE AS a, max(pts)::DOUBLE AS b FROM p),
e AS (SELECT list_transform(range(11), lambda i: a + (b - a) * i / 10) AS e FROM m),
g AS (SELECT {right_bin('pts')} AS band, count(*) AS n, sum(label)::BIGINT AS bad FROM p, e GROUP BY 1)
SELECT band, n AS count, bad, {r6('sum(n) OVER (ORDER BY band) / sum(n) OVER ()')} AS pass_cum, {r6('bad / n')} AS bad_rate FROM g""")
def score_bands_equal_width(spark, folder):
    from loanloom.functions.features import probability_score

    df = hold(marts.scores(spark, folder).select(probability_score(F.col("score")).alias("points"), "label"))
    return rounded(binning.score_distribution(df, "points", "label", 10))


@query("bad_rate_by_score_band", f"""
WITH {SCORED}, e AS {edges_sql('score', 'scored')}
SELECT {right_bin('score')} AS band, count(*) AS n, {r6('avg(label)')} AS bad_rate FROM scored, e GROUP BY 1""")
def bad_rate_by_score_band(spark, folder):
    df = hold(marts.scores(spark, folder).select("score", "label"))
    edges = binning.quantile_edges(df, ["score"], 10)["score"]
    return df.groupBy(binning.right_closed_bin("score", edges).alias("band")).agg(
        F.count("*").alias("n"), F.round(F.avg("label"), 6).alias("bad_rate"))


@query("score_histogram_by_label", f"""
WITH {SCORED}, m AS (SELECT min(score) AS a, max(score) AS b FROM scored),
e AS (SELECT list_transform(range(41), lambda i: a + (b - a) * i / 40) AS e FROM m)
SELECT label, {right_bin('score')} AS bin, count(*) AS n FROM scored, e GROUP BY 1, 2""")
def score_histogram_by_label(spark, folder):
    df = hold(marts.scores(spark, folder).select("score", "label"))
    edges = profiling.equal_width_edges(df, "score", 40)
    return df.groupBy("label", binning.right_closed_bin("score", edges).alias("bin")).agg(F.count("*").alias("n"))


@query("recovery_labels", """
WITH c AS (SELECT l_orderkey AS loan_id, sum(CASE WHEN l_linestatus = 'F' THEN l_extendedprice ELSE 0 END) AS col,
  sum(CASE WHEN l_returnflag <> 'N' THEN l_extendedprice ELSE 0 END) AS owed, max(l_shipdate)::DATE AS paid FROM lineitem GROUP BY 1)
SELECT loan_id, (col > 0)::INT AS has_payment, (round(col, 2) >= round(owed, 2))::INT AS fully_paid,
  round(round(col, 2) / CASE WHEN owed = 0 THEN 1 ELSE round(owed, 2) END, 6) AS recovery_rate,
  (datediff('day', o_orderdate::DATE, paid) <= 30)::INT AS paid_within_30d FROM c JOIN orders ON o_orderkey = loan_id""")
def recovery_labels(spark, folder):
    return rounded(profiling.recovery_labels(collection_cases(spark, folder)).select(
        "loan_id", "has_payment", "fully_paid", "recovery_rate", "paid_within_30d"))


def collection_cases(spark, folder):
    """Order as a collection case: settled and disputed line amounts, last line date against the order date."""
    money = lambda cond: F.round(F.sum(F.when(cond, F.col("l_extendedprice")).otherwise(0.0)), 2)
    c = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("loan_id")).agg(
        money(F.col("l_linestatus") == "F").alias("collected_amount"),
        money(F.col("l_returnflag") != "N").alias("overdue_amount"),
        F.round(F.sum("l_extendedprice"), 2).alias("ead"), F.to_date(F.max("l_shipdate")).alias("payment_date"))
    o = table(spark, folder, "orders").select(F.col("o_orderkey").alias("loan_id"), F.to_date("o_orderdate").alias("due_date"))
    return c.join(o, "loan_id")


@query("leakage_screen", f"""
WITH {LOAN}, c AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, {r6(f'corr({c}, isDefault)')} AS corr FROM loan"
                                      for c in ('loanAmnt', 'n0', 'n1', 'n_bad_lines'))})
SELECT * FROM c WHERE abs(corr) > 0.4""")
def leakage_screen(spark, folder):
    cols = ["loanAmnt", "n0", "n1", "n_bad_lines"]
    return rounded(profiling.leakage_screen(marts.loans(spark, folder, *cols, "isDefault"), cols, "isDefault", 0.4))


@query("feature_consistency", f"""
WITH {LOAN}, o AS (SELECT loan_id, CASE WHEN grade = 'A' THEN n4 + 0.001 ELSE n4 END AS n4, n1,
  CASE WHEN grade = 'B' THEN lower(purpose) ELSE purpose END AS purpose FROM loan),
j AS (SELECT abs(a.n4 - o.n4) AS e4, abs(a.n1 - o.n1) AS e1, a.purpose IS DISTINCT FROM o.purpose AS p
      FROM loan a JOIN o USING (loan_id))
SELECT 'n4' AS feature, {r6('max(e4)')} AS max_abs_error, {r6('avg(e4)')} AS mean_abs_error,
  {r6('avg(coalesce(e4 > 1e-6, false)::INT)')} AS mismatch_rate, CASE WHEN max(e4) < 1e-6 THEN 'OK' ELSE 'MISMATCH' END AS status FROM j
UNION ALL SELECT 'n1', {r6('max(e1)')}, {r6('avg(e1)')}, {r6('avg(coalesce(e1 > 1e-6, false)::INT)')},
  CASE WHEN max(e1) < 1e-6 THEN 'OK' ELSE 'MISMATCH' END FROM j
UNION ALL SELECT 'purpose', NULL, NULL, {r6('avg(p::INT)')}, CASE WHEN avg(p::INT) = 0 THEN 'OK' ELSE 'MISMATCH' END FROM j""")
def feature_consistency(spark, folder):
    off = marts.loans(spark, folder, "loan_id", "grade", "n4", "n1", "purpose")
    on = off.withColumns({
        "n4": F.when(F.col("grade") == "A", F.col("n4") + 0.001).otherwise(F.col("n4")),
        "purpose": F.when(F.col("grade") == "B", F.lower("purpose")).otherwise(F.col("purpose"))})
    return rounded(profiling.feature_consistency(off, on, "loan_id", ["n4", "n1", "purpose"]))
