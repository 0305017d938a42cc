"""SQL text shared by the checks: the loan views of ``sources.marts`` over the plain tables."""

LOAN = """
lines AS (
  SELECT l_orderkey, count(*)::DOUBLE AS n0, sum(l_quantity) AS n1, max(l_tax) AS n2, min(l_discount) AS n3,
         round(avg(l_extendedprice), 6) AS n4, round(100 * avg(l_discount), 6) AS interestRate,
         sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)::BIGINT AS nr
  FROM lineitem GROUP BY l_orderkey),
loan AS (
  SELECT o_orderkey AS loan_id, o_custkey AS customer_id, o_totalprice AS loanAmnt, o_orderdate::DATE AS issueDate,
         translate(substr(o_orderpriority, 1, 1), '12345', 'ABCDE') AS grade, o_orderstatus AS homeOwnership,
         c_mktsegment AS purpose, c_nationkey AS regionCode,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS annualIncome, interestRate,
         round(o_totalprice / greatest(coalesce(n0, 0), 1), 6) AS installment, n0, n1, n2, n3, n4,
         CASE WHEN coalesce(nr, 0) >= 3 THEN 1 ELSE 0 END AS isDefault, coalesce(nr, 0) AS n_bad_lines
  FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey LEFT JOIN customer ON o_custkey = c_custkey)"""

SCORED = LOAN + """,
scored AS (
  SELECT *, isDefault AS label,
    round(1 / (1 + exp(-(-4 + 0.5 * coalesce(n0, 0) + 0.05 * coalesce(interestRate, 0)))), 6) AS score,
    round(1 / (1 + exp(-(-3 + 0.012 * coalesce(n1, 0)))), 6) AS score2,
    round(1 / (1 + exp(-(-2 + 0.000003 * loanAmnt))), 6) AS score3
  FROM loan)"""

PERFORMANCE = """
performance AS (
  SELECT o_orderkey AS loan_id, strftime(o_orderdate, '%Y-%m') AS cohort,
         ((year(l_shipdate) - year(o_orderdate)) * 12 + month(l_shipdate) - month(o_orderdate))::INT AS loan_age,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_bad, l_extendedprice AS balance
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

SNAPSHOT = """
snapshot AS (
  SELECT o_custkey AS customer_id, (year(o_orderdate) * 12 + month(o_orderdate) - 1)::INT AS month_idx,
         sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::BIGINT AS current_dpd, sum(o_totalprice) AS balance
  FROM orders GROUP BY 1, 2)"""

RELATION = """
relation AS (
  SELECT o_custkey AS customer_id_1, l_partkey AS customer_id_2,
         CASE l_linenumber WHEN 1 THEN 'guarantor' WHEN 2 THEN 'co_borrower' WHEN 3 THEN 'device' ELSE 'other' END
           AS relation_type, l_shipdate::DATE AS relation_start_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON l_partkey = c_custkey
  WHERE l_returnflag = 'R' AND o_custkey <> l_partkey)"""

EDGE = RELATION + """,
edge AS (
  SELECT src, dst, max(w) AS weight FROM (
    SELECT customer_id_1 AS src, customer_id_2 AS dst,
           CASE relation_type WHEN 'guarantor' THEN 1.0 WHEN 'co_borrower' THEN 0.8 WHEN 'device' THEN 0.5
             ELSE 0.3 END::DOUBLE AS w FROM relation
    UNION ALL
    SELECT customer_id_2, customer_id_1,
           CASE relation_type WHEN 'guarantor' THEN 1.0 WHEN 'co_borrower' THEN 0.8 WHEN 'device' THEN 0.5
             ELSE 0.3 END::DOUBLE FROM relation) GROUP BY 1, 2)"""

DEFAULTS = """
defaults AS (
  SELECT c_custkey AS customer_id, coalesce(max(isDefault), 0)::INT AS isDefault
  FROM customer LEFT JOIN loan ON customer_id = c_custkey GROUP BY 1)"""

DEVICE = """
device AS (
  SELECT DISTINCT user_id, (props->>'$.k')::BIGINT AS device_id FROM events)"""


def r6(x: str) -> str:
    """Round to six digits without negative zero."""
    return f"(round(({x})::DOUBLE, 6) + 0)"


def uniform(key: str, seed) -> str:
    """The hash of ``functions.hashing.hash_int`` as SQL."""
    return f"(('0x' || substr(md5({key} || '|{seed}'), 1, 8))::BIGINT)"


def edges_sql(column: str, source: str, bins: int = 10) -> str:
    """Subquery with the sorted distinct linear percentiles of a column as a list ``e``."""
    probs = ", ".join(str(i / bins) for i in range(bins + 1))
    return f"(SELECT list_sort(list_distinct(quantile_cont({column}, [{probs}]))) AS e FROM {source})"


def right_bin(x: str, e: str = "e") -> str:
    """Right-closed bin number, first bin includes its lower edge."""
    return f"(1 + len(list_filter({e}[2:len({e}) - 1], lambda v: {x} > v)))::INT"


def left_bin(x: str, e: str = "e") -> str:
    """Left-closed bin number, last bin includes its upper edge, NULL outside."""
    return (
        f"CASE WHEN {x} >= {e}[1] AND {x} <= {e}[len({e})] "
        f"THEN (1 + len(list_filter({e}[2:len({e}) - 1], lambda v: {x} >= v)))::INT END"
    )
