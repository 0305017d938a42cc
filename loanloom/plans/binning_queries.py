"""Weight of evidence, information value, cards and target encoding."""

from pyspark.sql import functions as F

from loanloom.functions.hashing import fold_of
from loanloom.operators import binning, encoding
from loanloom.plans.catalog import query
from loanloom.plans.check_sql import LOAN, edges_sql, r6, right_bin, uniform
from loanloom.plans.profile_queries import rounded
from loanloom.session import hold
from loanloom.sources import marts

NUM = ["loanAmnt", "interestRate", "annualIncome"]
CAT = ["purpose"]


def binned_sql(bins=10, missing=True):
    parts = [
        f"SELECT loan_id, isDefault, '{c}' AS feature, coalesce(({right_bin(c)})::VARCHAR, 'Missing') AS bin "
        f"FROM loan, {edges_sql(c, 'loan', bins)} WHERE {'true' if missing else c + ' IS NOT NULL'}" for c in NUM]
    parts = [p.replace("coalesce((", f"coalesce((CASE WHEN {c} IS NOT NULL THEN ").replace(")::INT)::VARCHAR", ")::INT END)::VARCHAR")
             for p, c in zip(parts, NUM)]
    parts += [f"SELECT loan_id, isDefault, '{c}' AS feature, coalesce({c}, 'Missing') AS bin FROM loan" for c in CAT]
    return " UNION ALL ".join(parts)


WOE = LOAN + f""",
binned AS ({binned_sql()}),
cnt AS (SELECT feature, bin, count(*) AS n, sum(isDefault)::BIGINT AS bad, sum(1 - isDefault)::BIGINT AS good FROM binned GROUP BY 1, 2),
shr AS (SELECT *, (bad + 0.5) / sum(bad) OVER (PARTITION BY feature) AS pb, (good + 0.5) / sum(good) OVER (PARTITION BY feature) AS pg FROM cnt),
woe AS (SELECT feature, bin, n, bad, good, ln(pb / pg) AS woe, (pb - pg) * ln(pb / pg) AS iv FROM shr)"""


def _loans(spark, folder, *extra):
    return hold(marts.loans(spark, folder, "loan_id", *NUM, *CAT, "isDefault", *extra))


@query("woe_table", f"""
WITH {WOE} SELECT feature, bin, n, bad, good, {r6('woe')} AS woe, {r6('iv')} AS iv FROM woe""")
def woe_table(spark, folder):
    return rounded(binning.fit_woe(_loans(spark, folder), NUM, CAT, "isDefault").table)


@query("iv_summary", f"""
WITH {WOE}, s AS (SELECT feature, sum(iv) AS iv FROM woe GROUP BY 1)
SELECT feature, {r6('iv')} AS iv, CASE WHEN iv < 0.02 THEN 'none' WHEN iv < 0.1 THEN 'weak' WHEN iv < 0.3 THEN 'medium'
  WHEN iv < 0.5 THEN 'strong' ELSE 'suspicious' END AS strength FROM s""")
def iv_summary(spark, folder):
    return rounded(binning.iv_summary(binning.fit_woe(_loans(spark, folder), NUM, CAT, "isDefault").table))


@query("iv_filter", f"""
WITH {WOE} SELECT feature, {r6('sum(iv)')} AS iv FROM woe GROUP BY 1 HAVING sum(iv) >= 0.02""")
def iv_filter(spark, folder):
    t = binning.fit_woe(_loans(spark, folder), NUM, CAT, "isDefault").table
    return rounded(binning.iv_filter(binning.iv_summary(t)).drop("strength"))


@query("woe_encoded", f"""
WITH {WOE} SELECT loan_id, {', '.join(f"{r6(f'max(woe) FILTER (feature = {chr(39)}{c}{chr(39)})')} AS {chr(34)}{c}_woe{chr(34)}" for c in NUM + CAT)}
FROM binned JOIN woe USING (feature, bin) GROUP BY 1""")
def woe_encoded(spark, folder):
    df = _loans(spark, folder)
    model = binning.fit_woe(df, NUM, CAT, "isDefault")
    return rounded(binning.apply_woe(df, model).select("loan_id", *[f"{c}_woe" for c in NUM + CAT]))


@query("binning_table", f"""
WITH {WOE}, e AS {edges_sql('interestRate', 'loan')}
SELECT feature, bin, n, bad, good, {r6('woe')} AS woe, {r6('iv')} AS iv, {r6('e[try_cast(bin AS INT)]')} AS lower,
  {r6('e[try_cast(bin AS INT) + 1]')} AS upper FROM woe, e WHERE feature = 'interestRate'""")
def binning_table(spark, folder):
    return rounded(binning.binning_table(binning.fit_woe(_loans(spark, folder), NUM, CAT, "isDefault"), "interestRate"))


@query("woe_table_half_fix", f"""
WITH {LOAN}, binned AS ({binned_sql(missing=False)}),
cnt AS (SELECT feature, bin, count(*) AS n, sum(isDefault)::BIGINT AS bad, sum(1 - isDefault)::BIGINT AS good FROM binned GROUP BY 1, 2),
fix AS (SELECT *, CASE WHEN bad = 0 THEN 0.5 ELSE bad END::DOUBLE AS b, CASE WHEN good = 0 THEN 0.5 ELSE good END::DOUBLE AS g FROM cnt),
shr AS (SELECT *, b / sum(b) OVER (PARTITION BY feature) AS pb, g / sum(g) OVER (PARTITION BY feature) AS pg FROM fix)
SELECT feature, bin, n, bad, good, {r6('ln(pb / pg)')} AS woe, {r6('(pb - pg) * ln(pb / pg)')} AS iv FROM shr""")
def woe_table_half_fix(spark, folder):
    return rounded(binning.fit_woe(_loans(spark, folder), NUM, CAT, "isDefault", zero_fix="half", keep_missing=False).table)


def best_bins_sql(numeric) -> str:
    """All monotone partitions of the pre-bins into bins of enough rows, and the one of highest information value per feature."""
    pre = " UNION ALL ".join(
        f"SELECT isDefault, '{c}' AS feature, CASE WHEN {c} IS NOT NULL THEN {right_bin(c)} END AS bin FROM loan, {edges_sql(c, 'loan', 20)}" for c in numeric)
    gain = "((b + 0.5) / tb - (g + 0.5) / tg) * ln(((b + 0.5) / tb) / ((g + 0.5) / tg))"
    return f"""
pre AS MATERIALIZED (SELECT feature, bin, count(*) AS n, sum(isDefault)::BIGINT AS bad, sum(1 - isDefault)::BIGINT AS good FROM ({pre}) GROUP BY 1, 2),
total AS (SELECT feature, sum(bad) AS tb, sum(good) AS tg, sum(n) FILTER (bin IS NOT NULL) AS whole FROM pre GROUP BY 1),
numbered AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY bin) AS i FROM pre WHERE bin IS NOT NULL),
upto AS (SELECT feature, i, sum(n) OVER w AS n, sum(bad) OVER w AS bad, sum(good) OVER w AS good FROM numbered WINDOW w AS (PARTITION BY feature ORDER BY i)
  UNION ALL SELECT DISTINCT feature, 0, 0, 0, 0 FROM numbered),
seg AS MATERIALIZED (SELECT x.feature, x.i, y.i AS j, (y.bad - x.bad)::DOUBLE AS b, (y.good - x.good)::DOUBLE AS g, tb, tg FROM upto x JOIN upto y ON x.feature = y.feature AND x.i < y.i
  JOIN total ON total.feature = x.feature WHERE y.n - x.n >= 0.05 * whole),
part(feature, j, b, g, dir, gain, cuts) AS (
  SELECT feature, j, b, g, dir, {gain}, [j] FROM seg, (VALUES (1), (-1)) d(dir) WHERE i = 0
  UNION ALL SELECT s.feature, s.j, s.b, s.g, p.dir, p.gain + {gain.replace('(b ', '(s.b ').replace('(g ', '(s.g ')}, list_append(p.cuts, s.j)
  FROM part p JOIN seg s ON s.feature = p.feature AND s.i = p.j AND p.dir * ((2 * s.b + 1) * (2 * p.g + 1) - (2 * p.b + 1) * (2 * s.g + 1)) >= 0),
best AS (SELECT part.feature, arg_max(cuts, gain) AS cuts FROM part JOIN (SELECT feature, max(i) AS m FROM numbered GROUP BY 1) e ON e.feature = part.feature AND j = m GROUP BY 1)"""


MONOTONE = [*NUM, "n1"]


@query("monotone_woe_table", f"""
WITH RECURSIVE {LOAN}, {best_bins_sql(MONOTONE)},
cnt AS (SELECT pre.feature, CASE WHEN pre.bin IS NULL THEN 'Missing' ELSE (1 + len(list_filter(cuts, lambda c: c < i)))::VARCHAR END AS bin,
    sum(n)::BIGINT AS n, sum(pre.bad)::BIGINT AS bad, sum(pre.good)::BIGINT AS good
  FROM pre LEFT JOIN (SELECT feature, bin, i FROM numbered) k ON k.feature = pre.feature AND k.bin = pre.bin JOIN best ON best.feature = pre.feature GROUP BY 1, 2
  UNION ALL SELECT 'purpose', coalesce(purpose, 'Missing'), count(*), sum(isDefault)::BIGINT, sum(1 - isDefault)::BIGINT FROM loan GROUP BY 2),
shr AS (SELECT *, (bad + 0.5) / sum(bad) OVER (PARTITION BY feature) AS pb, (good + 0.5) / sum(good) OVER (PARTITION BY feature) AS pg FROM cnt)
SELECT feature, bin, n, bad, good, {r6('ln(pb / pg)')} AS woe, {r6('(pb - pg) * ln(pb / pg)')} AS iv FROM shr""")
def monotone_woe_table(spark, folder):
    return rounded(binning.fit_monotone_woe(_loans(spark, folder, "n1"), MONOTONE, CAT, "isDefault").table)


@query("card_table", f"""
WITH {WOE}, k AS (SELECT 20 / ln(2) AS b, 600 + 20 / ln(2) * ln(1 / 50.0::DOUBLE) AS a),
c AS (SELECT unnest(['loanAmnt', 'interestRate', 'annualIncome', 'purpose']) AS feature, unnest([0.5, 0.75, 1.0, 1.25]) AS coef)
SELECT feature, bin, round(woe, 4) + 0 AS woe, round_even(a / 4 - b * (coef * woe + -1.5 / 4), 0)::INT AS points FROM woe JOIN c USING (feature), k""")
def card_table(spark, folder):
    t = binning.fit_woe(_loans(spark, folder), NUM, CAT, "isDefault").table
    coef = {"loanAmnt": 0.5, "interestRate": 0.75, "annualIncome": 1.0, "purpose": 1.25}
    return binning.card_table(t, coef, -1.5)


FOLDED = LOAN + f""",
f AS (SELECT loan_id, purpose, isDefault, ({uniform('loan_id', 42)} % 5)::INT AS fold FROM loan),
g AS (SELECT avg(isDefault) AS m FROM f),
cf AS (SELECT purpose, fold, sum(isDefault) AS b, count(*) AS n FROM f GROUP BY 1, 2),
ct AS (SELECT purpose, sum(b) AS tb, sum(n) AS tn FROM cf GROUP BY 1)"""


@query("target_encoding_out_of_fold", f"""
WITH {FOLDED} SELECT loan_id, fold, {r6('CASE WHEN tn > n THEN (tb - b + 20 * m) / (tn - n + 20) ELSE m END')} AS purpose_te
FROM f JOIN cf USING (purpose, fold) JOIN ct USING (purpose), g""")
def target_encoding_out_of_fold(spark, folder):
    df = hold(marts.loans(spark, folder, "loan_id", "purpose", "isDefault").withColumn("fold", fold_of("loan_id", 5)))
    return rounded(encoding.out_of_fold_means(df, ["purpose"], "isDefault", "fold", 20).select("loan_id", "fold", "purpose_te"))


@query("target_encoding_fold_prior", f"""
WITH {FOLDED}, ff AS (SELECT fold, sum(isDefault) AS fb, count(*) AS fn FROM f GROUP BY 1), al AS (SELECT sum(fb) AS ab, sum(fn) AS an FROM ff)
SELECT loan_id, {r6('(tb - b + 10 * (ab - fb) / (an - fn)) / (tn - n + 10)')} AS purpose_te
FROM f JOIN cf USING (purpose, fold) JOIN ct USING (purpose) JOIN ff USING (fold), al""")
def target_encoding_fold_prior(spark, folder):
    df = hold(marts.loans(spark, folder, "loan_id", "purpose", "isDefault").withColumn("fold", fold_of("loan_id", 5)))
    out = encoding.out_of_fold_means(df, ["purpose"], "isDefault", "fold", 10, fold_prior=True)
    return rounded(out.select("loan_id", "purpose_te"))


@query("target_encoding_applied", f"""
WITH {LOAN}, tr AS (SELECT * FROM loan WHERE year(issueDate) <= 1999), g AS (SELECT avg(isDefault) AS m FROM tr),
p AS (SELECT purpose, (sum(isDefault) + 20 * any_value(m)) / (count(*) + 20) AS v FROM tr, g GROUP BY 1),
r AS (SELECT regionCode, (sum(isDefault) + 20 * any_value(m)) / (count(*) + 20) AS v FROM tr, g GROUP BY 1)
SELECT loan_id, {r6('coalesce(p.v, m)')} AS purpose_te, {r6('coalesce(r.v, m)')} AS "regionCode_te"
FROM loan LEFT JOIN p USING (purpose) LEFT JOIN r USING (regionCode), g WHERE year(issueDate) > 1999""")
def target_encoding_applied(spark, folder):
    df = marts.loans(spark, folder, "loan_id", "purpose", "regionCode", "issueDate", "isDefault")
    early = F.year("issueDate") <= 1999
    model = encoding.fit_target_means(df.where(early), ["purpose", "regionCode"], "isDefault", 20)
    return rounded(encoding.apply_target_means(df.where(~early), model).select("loan_id", "purpose_te", "regionCode_te"))
