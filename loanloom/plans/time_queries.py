"""Point-in-time counts, early warning, trailing windows, sequences."""

from pyspark.sql import functions as F

from loanloom.operators import timeline
from loanloom.plans.catalog import query
from loanloom.plans.check_sql import DEFAULTS, LOAN, SNAPSHOT, r6
from loanloom.plans.profile_queries import rounded
from loanloom.sources import marts
from loanloom.sources.tables import table


@query("count_before", """
SELECT o.o_orderkey AS loan_id, count(l.l_shipdate) AS n_before FROM orders o
LEFT JOIN (SELECT o_custkey AS ck, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R') l
  ON l.ck = o.o_custkey AND l.l_shipdate < o.o_orderdate GROUP BY 1""")
def count_before(spark, folder):
    o, li = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    late = li.where("l_returnflag = 'R'").join(o, li.l_orderkey == o.o_orderkey).select("o_custkey", "l_shipdate")
    obs = o.select(F.col("o_orderkey").alias("loan_id"), "o_custkey", "o_orderdate")
    return timeline.count_before(obs, late, "o_custkey", "o_orderdate", "l_shipdate").select("loan_id", "n_before")


@query("early_warning_sample", f"""
WITH {SNAPSHOT}, w AS (SELECT *, max(current_dpd) OVER (PARTITION BY customer_id ORDER BY month_idx RANGE BETWEEN 1 FOLLOWING AND 3 FOLLOWING) AS worst FROM snapshot)
SELECT customer_id, month_idx, (coalesce(worst, 0) >= 2)::INT AS label FROM w WHERE current_dpd = 0""")
def early_warning_sample(spark, folder):
    s = marts.snapshots(spark, folder)
    return timeline.early_warning_sample(s, "customer_id", "month_idx", "current_dpd").select("customer_id", "month_idx", "label")


@query("early_warning_features", f"""
WITH {SNAPSHOT} SELECT customer_id, month_idx,
  sum((current_dpd > 0)::INT) OVER (PARTITION BY customer_id ORDER BY month_idx RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)::BIGINT AS overdue_count_m3,
  sum((current_dpd > 0)::INT) OVER (PARTITION BY customer_id ORDER BY month_idx RANGE BETWEEN 5 PRECEDING AND CURRENT ROW)::BIGINT AS overdue_count_m6,
  max(current_dpd) OVER (PARTITION BY customer_id ORDER BY month_idx RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) AS max_dpd_m12,
  {r6('regr_slope(current_dpd, month_idx) OVER (PARTITION BY customer_id ORDER BY month_idx RANGE BETWEEN 5 PRECEDING AND CURRENT ROW)')} AS late_payment_trend,
  {r6('balance / max(balance) OVER (PARTITION BY customer_id ORDER BY month_idx RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) - 1')} AS total_debt_change FROM snapshot""")
def early_warning_features(spark, folder):
    s = marts.snapshots(spark, folder)
    return rounded(timeline.early_warning_features(s, "customer_id", "month_idx", "current_dpd", "balance").drop("current_dpd", "balance"))


TRAIL = """WITH s AS (SELECT (props->>'$.k')::BIGINT AS device_id, floor(epoch(ts))::BIGINT AS second, count(*) AS n FROM events GROUP BY 1, 2)
SELECT device_id, second, {agg} OVER (PARTITION BY device_id ORDER BY second RANGE BETWEEN 3599 PRECEDING AND CURRENT ROW)::BIGINT AS n_recent FROM s"""


@query("trailing_apply_count", TRAIL.format(agg="count(*)"))
def trailing_apply_count(spark, folder):
    return timeline.trailing_count(marts.event_log(spark, folder), "device_id", "ts")


@query("trailing_event_count", TRAIL.format(agg="sum(n)"))
def trailing_event_count(spark, folder):
    return timeline.trailing_count(marts.event_log(spark, folder), "device_id", "ts", count_all=True)


def _monthly_log(spark, folder):
    return marts.snapshots(spark, folder).selectExpr(
        "customer_id", "month_idx AS period", "round(balance, 2) AS repay_amount", "current_dpd AS overdue_days")


@query("repayment_sequences", f"""
WITH {SNAPSHOT}, x AS (SELECT customer_id, month_idx, round(balance, 2) AS v, current_dpd::DOUBLE AS d,
    row_number() OVER (PARTITION BY customer_id ORDER BY month_idx DESC) AS rn FROM snapshot),
k AS (SELECT c_custkey AS customer_id, unnest(range(1, 13)) AS step FROM customer)
SELECT k.customer_id, step::INT AS step, coalesce(v, 0) AS repay_amount, coalesce(d, 0) AS overdue_days
FROM k LEFT JOIN x ON x.customer_id = k.customer_id AND 13 - rn = step""")
def repayment_sequences(spark, folder):
    keys = table(spark, folder, "customer").select(F.col("c_custkey").alias("customer_id"))
    seq = timeline.last_periods(_monthly_log(spark, folder), "customer_id", "period", ["repay_amount", "overdue_days"], 12, keys)
    flat = seq.select("customer_id", F.posexplode("sequence").alias("step", "s"))
    return flat.select("customer_id", (F.col("step") + 1).alias("step"), "s.*")


STEP_WEIGHTS = [round(0.1 * (i + 1), 1) for i in range(12)]


@query("sequence_step_importance", f"""
WITH {SNAPSHOT}, {LOAN}, {DEFAULTS}, x AS (SELECT customer_id, month_idx, round(balance, 2) AS v, current_dpd::DOUBLE AS d,
    row_number() OVER (PARTITION BY customer_id ORDER BY month_idx DESC) AS rn FROM snapshot),
k AS (SELECT customer_id, isDefault AS label, unnest(range(1, 13)) AS i FROM defaults),
part AS (SELECT k.customer_id, label, i, coalesce({STEP_WEIGHTS}[i] * (d + v / 1000000), 0) AS p FROM k LEFT JOIN x ON x.customer_id = k.customer_id AND 13 - rn = i),
scored AS (SELECT step, customer_id, any_value(label) AS label, round(sum(p) FILTER (i <> step), 4) AS s FROM part, range(0, 13) t(step) GROUP BY 1, 2),
ranked AS (SELECT *, rank() OVER (PARTITION BY step ORDER BY s) + (count(*) OVER (PARTITION BY step, s) - 1) / 2 AS r FROM scored),
a AS (SELECT step, (sum(r) FILTER (label = 1) - sum(label) * (sum(label) + 1) / 2) / (sum(label) * sum(1 - label)) AS auc FROM ranked GROUP BY 1)
SELECT step::INT AS step, {r6('auc')} AS auc, {r6('(SELECT auc FROM a WHERE step = 0) - auc')} AS auc_drop FROM a""")
def sequence_step_importance(spark, folder):
    """A fixed linear scorer over the repayment sequences of all customers."""
    who = marts.customer_defaults(spark, folder)
    seq = timeline.last_periods(_monthly_log(spark, folder), "customer_id", "period", ["repay_amount", "overdue_days"], 12, who)
    weights = F.lit(STEP_WEIGHTS)

    def score(sequence):
        parts = F.zip_with(sequence, weights, lambda x, w: w * (x["overdue_days"] + x["repay_amount"] / 1000000))
        return F.round(F.aggregate(parts, F.lit(0.0), lambda a, b: a + b), 4)

    return rounded(timeline.step_importance(seq.join(who, "customer_id"), "isDefault", ["repay_amount", "overdue_days"], score, 12))


@query("jittered_sequences", f"""
WITH {SNAPSHOT}, x AS (SELECT customer_id, current_dpd::DOUBLE AS d, row_number() OVER (PARTITION BY customer_id ORDER BY month_idx DESC) AS rn FROM snapshot),
k AS (SELECT DISTINCT customer_id, unnest(range(1, 13)) AS step FROM x),
v AS (SELECT k.customer_id, step, coalesce(d, 0) AS d, k.customer_id || '|' || (step - 1) || '|overdue_days' AS h FROM k LEFT JOIN x ON x.customer_id = k.customer_id AND 13 - rn = step)
SELECT customer_id, step::INT AS step, {r6("""d + 0.1 * (sqrt(-2 * ln((('0x' || substr(md5(h || '|42a'), 1, 8))::BIGINT + 1) / 4294967297.0::DOUBLE))
  * cos(('0x' || substr(md5(h || '|42b'), 1, 8))::BIGINT / 4294967296.0::DOUBLE * 6.283185307179586))""")} AS overdue_days FROM v""")
def jittered_sequences(spark, folder):
    seq = timeline.last_periods(_monthly_log(spark, folder), "customer_id", "period", ["overdue_days"], 12)
    flat = timeline.jitter(seq, "customer_id", ["overdue_days"]).select("customer_id", F.posexplode("sequence").alias("step", "s"))
    return flat.select("customer_id", (F.col("step") + 1).alias("step"), F.round("s.overdue_days", 6).alias("overdue_days"))


WARP_UNIT = "(('0x' || substr(md5(customer_id || '|{}'), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


@query("warped_sequences", f"""
WITH {SNAPSHOT}, x AS (SELECT customer_id, round(balance, 2) AS v, current_dpd::DOUBLE AS d, row_number() OVER (PARTITION BY customer_id ORDER BY month_idx DESC) AS rn FROM snapshot),
k AS (SELECT DISTINCT customer_id, unnest(range(0, 12)) AS slot FROM x),
q AS (SELECT k.customer_id, list(coalesce(v, 0) ORDER BY slot) AS v, list(coalesce(d, 0) ORDER BY slot) AS d FROM k LEFT JOIN x ON x.customer_id = k.customer_id AND 12 - rn = slot GROUP BY 1),
m AS (SELECT *, floor(12 * (0.9::DOUBLE + {1.1 - 0.9!r}::DOUBLE * {WARP_UNIT.format('42')}))::INT AS m, {WARP_UNIT.format('42s')} AS u FROM q),
i AS (SELECT *, floor(u * (12 - m))::INT AS first, unnest(range(m)) AS step FROM m),
s AS (SELECT *, CASE WHEN m < 12 THEN first + step ELSE floor(step * (11 / (m - 1)))::INT END AS lo, CASE WHEN m < 12 THEN 0 ELSE step * (11 / (m - 1)) - floor(step * (11 / (m - 1))) END AS w FROM i)
SELECT customer_id, step::INT AS step, {r6('v[lo + 1] * (1 - w) + v[least(lo + 1, 11) + 1] * w')} AS repay_amount, {r6('d[lo + 1] * (1 - w) + d[least(lo + 1, 11) + 1] * w')} AS overdue_days FROM s""")
def warped_sequences(spark, folder):
    seq = timeline.last_periods(_monthly_log(spark, folder), "customer_id", "period", ["repay_amount", "overdue_days"], 12)
    warped = timeline.time_warp(seq, "customer_id", ["repay_amount", "overdue_days"])
    return rounded(warped.select("customer_id", F.posexplode("sequence").alias("step", "s")).select("customer_id", "step", "s.*"))
