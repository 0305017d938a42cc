"""Cleaning, row features, samples and splits."""

from pyspark.sql import functions as F

from loanloom.functions import cleaning, features
from loanloom.functions.hashing import experiment_arm, fold_of
from loanloom.operators import profiling, sampling
from loanloom.plans.catalog import query
from loanloom.plans.check_sql import LOAN, SCORED, r6, uniform
from loanloom.session import hold
from loanloom.sources import marts
from loanloom.sources.tables import table

RAW = LOAN + """,
raw AS (
  SELECT loan_id AS id,
    CASE regionCode % 13 WHEN 0 THEN '< 1 year' WHEN 1 THEN '1 year' WHEN 10 THEN '10+ years' WHEN 11 THEN NULL
      WHEN 12 THEN 'n/a' ELSE (regionCode % 13) || ' years' END AS el,
    CASE WHEN regionCode % 13 = 5 THEN NULL ELSE issueDate END AS issued,
    CASE WHEN regionCode % 13 = 7 THEN NULL ELSE date_trunc('month', issueDate)::DATE END AS opened,
    CASE WHEN regionCode % 13 = 3 THEN NULL ELSE grade END AS grade,
    CASE WHEN regionCode % 13 = 3 THEN NULL WHEN regionCode % 13 = 4 THEN grade || 'x'
      ELSE grade || (regionCode % 5 + 1) END AS sg, isDefault
  FROM loan)"""


@query("clean_applications", f"""
WITH {RAW}
SELECT id, CASE el WHEN '< 1 year' THEN 0 WHEN '1 year' THEN 1 WHEN '10+ years' THEN 10
    ELSE coalesce(try_cast(nullif(split_part(el, ' years', 1), el) AS INT), -1) END::TINYINT AS "employmentLength",
  month(issued)::DOUBLE AS "issueDate_month", year(issued)::DOUBLE AS "issueDate_year",
  floor(datediff('day', opened, DATE '2020-01-01') / 30)::DOUBLE AS "creditHistory_months",
  (ascii(grade) - 64)::DOUBLE AS grade,
  coalesce((ascii(sg) - 65) * 5 + try_cast(substr(sg, 2, 1) AS INT), -1)::INT AS "subGrade", "isDefault"
FROM raw""")
def clean_applications(spark, folder):
    out = cleaning.clean_loans(marts.raw_applications(spark, folder))
    holey = ["issueDate_month", "issueDate_year", "creditHistory_months", "grade"]
    return out.withColumns({c: F.col(c).cast("double") for c in holey})


@query("loan_ratio_features", f"""
WITH {LOAN}
SELECT loan_id, {r6('loanAmnt / (annualIncome + 1e-6)')} AS "loanToIncome",
  {r6('installment / (annualIncome / 12 + 1e-6)')} AS "installmentToIncome",
  {r6('(600 + n1 + 604 + n1) / 2')} AS "ficoMean", {r6('604 + n1 - (600 + n1)')} AS "ficoRange",
  {r6('100 * n2 / 100')} AS "revolUtil_norm", {r6('n0 / (n0 + 2 + 1e-6)')} AS "openAccRatio",
  {r6('n1 * interestRate')} AS dti_x_rate
FROM loan""")
def loan_ratio_features(spark, folder):
    df = marts.loans(spark, folder, "loan_id", "loanAmnt", "annualIncome", "installment", "interestRate", "n0", "n1", "n2")
    df = df.selectExpr("*", "600 + n1 AS ficoRangeLow", "604 + n1 AS ficoRangeHigh", "100 * n2 AS revolUtil",
                       "n0 AS openAcc", "n0 + 2 AS totalAcc", "n1 AS dti")
    ratios = features.loan_ratios(df)
    return df.select("loan_id", *[F.round(c, 6).alias(n) for n, c in ratios.items()])


@query("debt_ratio_features", f"""
WITH {LOAN}
SELECT loan_id, {r6('loanAmnt / (annualIncome / 12 + 1e-6)')} AS debt_to_income,
  {r6('n1 / (n4 + 1e-6)')} AS credit_utilization, {r6('installment / (annualIncome / 12 + 1e-6)')} AS payment_coverage,
  {r6('n_bad_lines / (n0 + 1e-6)')} AS recent_overdue_ratio FROM loan""")
def debt_ratio_features(spark, folder):
    df = marts.loans(spark, folder, "loan_id", "loanAmnt", "annualIncome", "installment", "n0", "n1", "n4", "n_bad_lines")
    df = df.selectExpr("loan_id", "loanAmnt AS total_debt", "annualIncome / 12 AS monthly_income", "n1 AS used_credit",
                       "n4 AS total_credit_limit", "installment AS monthly_payment", "n_bad_lines AS overdue_m3",
                       "n0 AS overdue_m12")
    return df.select("loan_id", *[F.round(c, 6).alias(n) for n, c in features.debt_ratios(df).items()])


@query("cross_features", f"""
WITH {LOAN}
SELECT loan_id, {r6('annualIncome * interestRate')} AS income_debt_interaction,
  {r6('n1 / (n0 + 1)')} AS age_tenure_ratio, {r6('n2 * isDefault')} AS device_behavior_risk FROM loan""")
def cross_features(spark, folder):
    df = marts.loans(spark, folder, "loan_id", "annualIncome", "interestRate", "n0", "n1", "n2", "isDefault")
    return df.select(
        "loan_id", F.round(features.product("annualIncome", "interestRate"), 6).alias("income_debt_interaction"),
        F.round(features.shifted_ratio("n1", "n0"), 6).alias("age_tenure_ratio"),
        F.round(features.product("n2", "isDefault"), 6).alias("device_behavior_risk"))


@query("row_statistics", f"""
WITH {LOAN},
xs AS (SELECT loan_id, list_filter([n0, n1, n2, n3, annualIncome], lambda x: x IS NOT NULL) AS l FROM loan),
ms AS (SELECT loan_id, l, len(l) AS n, list_avg(l) AS m FROM xs),
mo AS (SELECT *, list_sum(list_transform(l, lambda x: (x - m) ** 2)) AS m2,
         list_sum(list_transform(l, lambda x: (x - m) ** 3)) AS m3 FROM ms)
SELECT loan_id, {r6('m')} AS n_mean, CASE WHEN n > 1 THEN round(sqrt(m2 / (n - 1)), 4) END AS n_std,
  {r6('list_min(l)')} AS n_min, {r6('list_max(l)')} AS n_max, (5 - n)::INT AS n_null_cnt,
  CASE WHEN n >= 3 THEN CASE WHEN m2 / n < 1e-14 THEN 0.0 ELSE
    {r6('(m3 / n) / (m2 / n) ** 1.5 * sqrt(n * (n - 1)) / (n - 2)')} END END AS n_skew FROM mo""")
def row_statistics(spark, folder):
    cols = ["n0", "n1", "n2", "n3", "annualIncome"]
    df = marts.loans(spark, folder, "loan_id", *cols)
    df = features.with_row_statistics(df, cols).drop(*cols)
    digits = {"n_mean": 6, "n_std": 4, "n_min": 6, "n_max": 6, "n_skew": 6}
    return df.withColumns({n: F.round(n, d) for n, d in digits.items()})


@query("occupation_risk", f"""
WITH {LOAN}
SELECT loan_id, CASE purpose WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'MACHINERY' THEN 5 ELSE 3 END
  AS occupation_risk FROM loan""")
def occupation_risk(spark, folder):
    risk = {"AUTOMOBILE": 1, "BUILDING": 2, "MACHINERY": 5}
    return marts.loans(spark, folder, "loan_id", "purpose").select(
        "loan_id", features.lookup(F.col("purpose"), risk, features.OCCUPATION_DEFAULT).alias("occupation_risk"))


@query("missing_indicator", f"""
WITH {LOAN}
SELECT loan_id, (annualIncome IS NOT NULL)::INT AS has_income, coalesce(annualIncome, -1) AS income_filled FROM loan""")
def missing_indicator(spark, folder):
    return marts.loans(spark, folder, "loan_id", "annualIncome").select(
        "loan_id", features.missing_flag(F.col("annualIncome")).alias("has_income"),
        F.coalesce("annualIncome", F.lit(-1.0)).alias("income_filled"))


@query("behaviour_features", """
WITH log AS (
  SELECT user_id, ts::DATE AS d, min(date_trunc('second', ts)) AS t0, max(date_trunc('second', ts)) AS t1,
    count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'error') AS err,
    count(*) FILTER (event_type = 'view') AS view, count(*) FILTER (event_type = 'purchase') AS pur,
    count(*) FILTER (event_type = 'signup') AS sig FROM events GROUP BY 1, 2)
SELECT user_id, strftime(d, '%Y-%m-%d') AS day, datediff('second', t0, t1)::BIGINT AS fill_seconds,
  datediff('second', t0, t1) < 30 AS is_suspiciously_fast, click AS phone_modify_count, err AS id_modify_count,
  view AS page_back_count, (click + pur + sig)::BIGINT AS total_paste_count, pur < 2 AS skim_privacy_policy FROM log""")
def behaviour_features(spark, folder):
    n = lambda t: F.count(F.when(F.col("event_type") == t, 1))
    log = marts.event_log(spark, folder).groupBy("user_id", F.to_date("ts").alias("d")).agg(
        F.min("ts").alias("start_time"), F.max("ts").alias("submit_time"), n("click").alias("phone_changes"),
        n("error").alias("id_changes"), n("view").alias("back_events"), n("click").alias("phone_pastes"),
        n("purchase").alias("id_pastes"), n("signup").alias("bank_pastes"), n("purchase").alias("privacy_stay_time"))
    return features.behaviour_features(log).select(
        "user_id", F.date_format("d", "yyyy-MM-dd").alias("day"), "fill_seconds", "is_suspiciously_fast",
        "phone_modify_count", "id_modify_count", "page_back_count", "total_paste_count", "skim_privacy_policy")


@query("winsorized_amount", f"""
WITH {LOAN}, q AS (SELECT quantile_cont(loanAmnt, 0.01) AS lo, quantile_cont(loanAmnt, 0.99) AS hi FROM loan)
SELECT loan_id, {r6('greatest(lo, least(hi, loanAmnt))')} AS "loanAmnt" FROM loan, q""")
def winsorized_amount(spark, folder):
    df = marts.loans(spark, folder, "loan_id", "loanAmnt")
    return profiling.winsorize(df, "loanAmnt").select("loan_id", F.round("loanAmnt", 6).alias("loanAmnt"))


@query("outlier_bounds", f"""
WITH {LOAN}, v AS (SELECT unnest(['loanAmnt', 'annualIncome', 'n4']) AS feature,
                          unnest([loanAmnt, annualIncome, n4]) AS x FROM loan),
s AS (SELECT feature, quantile_cont(x, [0.01, 0.25, 0.75, 0.99]) AS q, avg(x) AS m, stddev_samp(x) AS sd
      FROM v GROUP BY 1)
SELECT feature, 'iqr' AS method, {r6('q[2] - 3 * (q[3] - q[2])')} AS lower, {r6('q[3] + 3 * (q[3] - q[2])')} AS upper FROM s
UNION ALL SELECT feature, 'zscore', {r6('m - 3 * sd')}, {r6('m + 3 * sd')} FROM s
UNION ALL SELECT feature, 'percentile', {r6('q[1]')}, {r6('q[4]')} FROM s""")
def outlier_bounds(spark, folder):
    df = marts.loans(spark, folder, "loanAmnt", "annualIncome", "n4")
    out = profiling.outlier_bounds(df, ["loanAmnt", "annualIncome", "n4"])
    return out.select("feature", "method", F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"))


FLAGGED = ["loanAmnt", "annualIncome", "n4"]


def _flag_sql(c: str) -> str:
    iqr = f"(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"
    return (f"quantile_cont({c}, 0.25) - 1.5 * {iqr} AS iqr_lo_{c}, quantile_cont({c}, 0.75) + 1.5 * {iqr} AS iqr_hi_{c}, avg({c}) - 1.5 * stddev_samp({c}) AS zscore_lo_{c}, "
            f"avg({c}) + 1.5 * stddev_samp({c}) AS zscore_hi_{c}, quantile_cont({c}, 0.01) AS percentile_lo_{c}, quantile_cont({c}, 0.99) AS percentile_hi_{c}")


@query("outlier_flags", f"""
WITH {LOAN}, b AS (SELECT {', '.join(_flag_sql(c) for c in FLAGGED)} FROM loan) {' UNION ALL '.join(
    f"SELECT loan_id, '{m}' AS method, " + ', '.join(f'({c} < {m}_lo_{c} OR {c} > {m}_hi_{c})::INT AS "{c}_outlier"' for c in FLAGGED) + " FROM loan, b"
    for m in ("iqr", "zscore", "percentile"))}""")
def outlier_flags(spark, folder):
    """Flags of every row by each of the three rules, at 1.5 times the spread."""
    df = hold(marts.loans(spark, folder, "loan_id", *FLAGGED))
    bounds = profiling.outlier_bounds(df, FLAGGED, 1.5)
    out = None
    for m in ("iqr", "zscore", "percentile"):
        part = profiling.flag_outliers(df, bounds, m).select("loan_id", F.lit(m).alias("method"), *[f"{c}_outlier" for c in FLAGGED])
        out = part if out is None else out.unionByName(part)
    return out


@query("risk_level", f"""
WITH {SCORED} SELECT loan_id, CASE WHEN score > 0.15 THEN 'HIGH' WHEN score > 0.05 THEN 'MEDIUM' ELSE 'LOW' END
  AS risk_level FROM scored""")
def risk_level(spark, folder):
    return marts.scores(spark, folder).select("loan_id", features.risk_level(F.col("score")).alias("risk_level"))


@query("experiment_arm", """
SELECT c_custkey AS user_id, CASE WHEN
  (((( ('0x' || substr(md5(c_custkey::VARCHAR), 1, 8))::BIGINT % 100) * 96
     + ('0x' || substr(md5(c_custkey::VARCHAR), 9, 8))::BIGINT) % 100 * 96
     + ('0x' || substr(md5(c_custkey::VARCHAR), 17, 8))::BIGINT) % 100 * 96
     + ('0x' || substr(md5(c_custkey::VARCHAR), 25, 8))::BIGINT) % 100 < 10 THEN 'treatment' ELSE 'control' END AS arm
FROM customer""")
def experiment_arm_query(spark, folder):
    c = table(spark, folder, "customer")
    return c.select(F.col("c_custkey").alias("user_id"), experiment_arm("c_custkey", 0.1).alias("arm"))


@query("log_odds_score", f"""
WITH {SCORED}, k AS (SELECT 20 / ln(2) AS b)
SELECT loan_id, {r6('600 + b * ln(1 / 50.0::DOUBLE) - b * ln(score / (1 - score))')} AS points,
  round_even(600 + b * ln(1 / 50.0::DOUBLE) - b * ln(score / (1 - score + 1e-9)), 0)::INT AS whole_points
FROM scored, k""")
def log_odds_score(spark, folder):
    s = F.col("score")
    return marts.scores(spark, folder).select(
        "loan_id", F.round(features.log_odds_score(F.log(s / (1 - s))), 6).alias("points"),
        features.probability_score(s).alias("whole_points"))


@query("expected_loss_by_segment", f"""
WITH {SCORED} SELECT purpose, {r6('sum(score * 0.6 * loanAmnt)')} AS expected_loss, {r6('sum(loanAmnt)')} AS exposure
FROM scored GROUP BY 1""")
def expected_loss_by_segment(spark, folder):
    df = marts.scores(spark, folder, "purpose", "loanAmnt")
    el = features.expected_loss(F.col("score"), F.lit(0.6), F.col("loanAmnt"))
    return df.groupBy("purpose").agg(
        F.round(F.sum(el), 6).alias("expected_loss"), F.round(F.sum("loanAmnt"), 6).alias("exposure"))


@query("business_anomalies", f"""
WITH {LOAN} SELECT loan_id, (coalesce(annualIncome, 0) = 0)::INT AS zero_income,
  coalesce(loanAmnt > 10 * coalesce(annualIncome, 0), false)::INT AS amount_above_income,
  coalesce(n0 * 8 < 18 OR n0 * 8 > 70, false)::INT AS age_out_of_range FROM loan""")
def business_anomalies(spark, folder):
    df = marts.loans(spark, folder, "loan_id", "annualIncome", "loanAmnt", "n0")
    df = df.selectExpr("loan_id", "coalesce(annualIncome, 0) AS income", "loanAmnt", "n0 * 8 AS age")
    return features.business_anomalies(df, "income", "loanAmnt", "age").select(
        "loan_id", "zero_income", "amount_above_income", "age_out_of_range")


@query("modelling_sample", f"""
WITH {LOAN} SELECT loan_id FROM loan WHERE datediff('month', date_trunc('month', issueDate), DATE '2001-08-01') >= 12
  AND grade <> 'E' AND NOT (homeOwnership = 'F' AND n_bad_lines < 1)""")
def modelling_sample(spark, folder):
    df = marts.loans(spark, folder, "loan_id", "issueDate", "grade", "homeOwnership", "n_bad_lines")
    df = df.select(
        "loan_id",
        ((2001 - F.year("issueDate")) * 12 + 8 - F.month("issueDate")).alias("loan_age"),
        F.when(F.col("grade") == "E", 1).otherwise(0).alias("is_policy_extension"),
        (F.col("homeOwnership") == "F").alias("is_written_off"), (30 * F.col("n_bad_lines")).alias("dpd_at_writeoff"))
    return sampling.modelling_sample(df, 12).select("loan_id")


@query("three_way_label", f"""
WITH {LOAN} SELECT loan_id, CASE WHEN n_bad_lines >= 2 THEN 1 ELSE 0 END::INT AS label FROM loan
WHERE n_bad_lines <> 1""")
def three_way_label(spark, folder):
    df = marts.loans(spark, folder, "loan_id", "n_bad_lines")
    return df.select("loan_id", sampling.three_way_label(F.col("n_bad_lines")).alias("label")).where("label IS NOT NULL")


@query("stratified_split", f"""
WITH {LOAN} SELECT loan_id, "isDefault",
  CASE WHEN {uniform("loan_id || '|' || isDefault", 42)} / 4294967296.0 < 0.2 THEN 'val' ELSE 'train' END AS part FROM loan""")
def stratified_split(spark, folder):
    df = marts.loans(spark, folder, "loan_id", "isDefault")
    train, val = sampling.random_split(df, "loan_id", 0.2, "isDefault")
    return train.withColumn("part", F.lit("train")).unionByName(val.withColumn("part", F.lit("val")))


@query("year_split", f"""
WITH {LOAN} SELECT CASE WHEN year(issueDate) IN (2000, 2001) THEN 'val' ELSE 'train' END AS part,
  count(*) AS n, sum(isDefault)::BIGINT AS bad FROM loan GROUP BY 1""")
def year_split(spark, folder):
    df = marts.loans(spark, folder, "issueDate", "isDefault").withColumn("y", F.year("issueDate"))
    train, val = sampling.year_split(df, "y", [2000, 2001])
    both = train.withColumn("part", F.lit("train")).unionByName(val.withColumn("part", F.lit("val")))
    return both.groupBy("part").agg(F.count("*").alias("n"), F.sum("isDefault").alias("bad"))


@query("time_folds", f"""
WITH {LOAN}, d AS (SELECT datediff('day', DATE '1970-01-01', issueDate) AS x, isDefault FROM loan),
e AS (SELECT quantile_cont(x, [{', '.join(str(i / 6) for i in range(1, 6))}]) AS q FROM d)
SELECT len(list_filter(q, lambda v: x > v))::INT AS time_fold, count(*) AS n, sum(isDefault)::BIGINT AS bad,
  min(x)::INT AS first_day, max(x)::INT AS last_day FROM d, e GROUP BY 1""")
def time_folds(spark, folder):
    df = sampling.with_time_fold(marts.loans(spark, folder, "issueDate", "isDefault"), "issueDate", 5)
    day = F.datediff("issueDate", F.to_date(F.lit("1970-01-01")))
    return df.groupBy("time_fold").agg(
        F.count("*").alias("n"), F.sum("isDefault").alias("bad"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))


@query("hash_folds", f"""
WITH {LOAN} SELECT ({uniform("loan_id", 42)} % 5)::INT AS fold, isDefault AS "isDefault", count(*) AS n FROM loan GROUP BY 1, 2""")
def hash_folds(spark, folder):
    df = marts.loans(spark, folder, "loan_id", "isDefault")
    return df.groupBy(fold_of("loan_id", 5).alias("fold"), "isDefault").agg(F.count("*").alias("n"))


@query("under_sample", f"""
WITH {LOAN}, c AS (SELECT least(1.0, 2 * sum(isDefault) / sum(1 - isDefault)) AS f FROM loan)
SELECT loan_id, "isDefault" FROM loan, c WHERE isDefault = 1 OR {uniform("loan_id", 42)} / 4294967296.0 < f""")
def under_sample(spark, folder):
    return sampling.under_sample(marts.loans(spark, folder, "loan_id", "isDefault"), "isDefault", "loan_id", 2)


@query("class_weights", f"""
WITH {LOAN}, c AS (SELECT sum(isDefault) AS b, sum(1 - isDefault) AS g FROM loan)
SELECT loan_id, {r6('CASE WHEN isDefault = 1 THEN (b + g) / (2 * b) ELSE (b + g) / (2 * g) END')} AS balanced,
  {r6('CASE WHEN isDefault = 1 THEN g / b ELSE 1 END')} AS positive,
  CASE WHEN isDefault = 1 THEN 10.0 ELSE 1.0 END::DOUBLE AS fixed FROM loan, c""")
def class_weights(spark, folder):
    df = marts.loans(spark, folder, "loan_id", "isDefault")
    df = sampling.with_class_weight(df, "isDefault", "balanced", "balanced")
    df = sampling.with_class_weight(df, "isDefault", "positive", "positive")
    df = sampling.with_class_weight(df, "isDefault", {0: 1, 1: 10}, "fixed")
    return df.select("loan_id", F.round("balanced", 6).alias("balanced"), F.round("positive", 6).alias("positive"), "fixed")


@query("feature_block", f"""
WITH {LOAN},
t AS (SELECT purpose, sum(isDefault) AS b, count(*) AS n FROM loan GROUP BY 1),
g AS (SELECT avg(isDefault) AS m FROM loan)
SELECT loan_id, {r6('loanAmnt / (annualIncome + 1e-6)')} AS "loanToIncome",
  {r6('list_avg(list_filter([n0, n1, n2], lambda x: x IS NOT NULL))')} AS n_mean,
  {r6('(t.b + 20 * m) / (t.n + 20)')} AS purpose_te FROM loan JOIN t USING (purpose), g""")
def feature_block(spark, folder):
    from loanloom.operators import encoding

    df = marts.loans(spark, folder, "loan_id", "loanAmnt", "annualIncome", "n0", "n1", "n2", "purpose", "isDefault")
    model = encoding.fit_target_means(df, ["purpose"], "isDefault", smoothing=20)
    df = encoding.apply_target_means(df, model)
    df = features.with_row_statistics(df, ["n0", "n1", "n2"])
    ratio = features.guarded_ratio(F.col("loanAmnt"), F.col("annualIncome"))
    return df.select("loan_id", F.round(ratio, 6).alias("loanToIncome"), F.round("n_mean", 6).alias("n_mean"),
                     F.round("purpose_te", 6).alias("purpose_te"))
