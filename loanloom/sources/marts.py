"""Loan-shaped views over the order tables: one application per order.

Each view joins only what the requested columns need. ``lineitem`` is aggregated before the join, so the
order-level join shuffles one row per order from either side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loanloom.sources.tables import table

LINE_COLUMNS = {"interestRate", "installment", "n0", "n1", "n2", "n3", "n4", "isDefault", "n_bad_lines"}
CUSTOMER_COLUMNS = {"purpose", "regionCode", "annualIncome"}
LOAN_COLUMNS = [
    "loan_id", "customer_id", "loanAmnt", "issueDate", "grade", "homeOwnership", "purpose", "regionCode",
    "annualIncome", "interestRate", "installment", "n0", "n1", "n2", "n3", "n4", "isDefault",
]


def line_facts(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count("*").cast("double").alias("n0"),
            F.sum("l_quantity").alias("n1"),
            F.max("l_tax").alias("n2"),
            F.min("l_discount").alias("n3"),
            F.round(F.avg("l_extendedprice"), 6).alias("n4"),
            F.round(100 * F.avg("l_discount"), 6).alias("interestRate"),
            F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("n_bad_lines"),
        )
    )


def loans(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    wanted = list(columns) or LOAN_COLUMNS
    df = table(spark, folder, "orders")
    if LINE_COLUMNS & set(wanted):
        df = df.join(line_facts(spark, folder), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    if CUSTOMER_COLUMNS & set(wanted):
        df = df.join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    made = {
        "loan_id": F.col("o_orderkey"),
        "customer_id": F.col("o_custkey"),
        "loanAmnt": F.col("o_totalprice"),
        "issueDate": F.to_date("o_orderdate"),
        "grade": F.translate(F.substring("o_orderpriority", 1, 1), "12345", "ABCDE"),
        "homeOwnership": F.col("o_orderstatus"),
        "purpose": F.expr("c_mktsegment"),
        "regionCode": F.expr("c_nationkey"),
        "annualIncome": F.expr("CASE WHEN c_acctbal >= 0 THEN c_acctbal END"),
        "interestRate": F.expr("interestRate"),
        "installment": F.expr("round(o_totalprice / greatest(coalesce(n0, 0), 1), 6)"),
        "isDefault": F.expr("CASE WHEN coalesce(n_bad_lines, 0) >= 3 THEN 1 ELSE 0 END"),
        "n_bad_lines": F.expr("coalesce(n_bad_lines, 0)"),
        **{f"n{i}": F.expr(f"n{i}") for i in range(5)},
    }
    return df.select(*[made[c].alias(c) for c in wanted])


SCORE_RULES = {
    "score": "round(1 / (1 + exp(-(-4 + 0.5 * coalesce(n0, 0) + 0.05 * coalesce(interestRate, 0)))), 6)",
    "score2": "round(1 / (1 + exp(-(-3 + 0.012 * coalesce(n1, 0)))), 6)",
    "score3": "round(1 / (1 + exp(-(-2 + 0.000003 * loanAmnt))), 6)",
}


def scores(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    """Deterministic scores in [0, 1], rounded so that ties exist."""
    base = ["loan_id", "isDefault", "n0", "n1", "interestRate", "loanAmnt"]
    keep = [c for c in extra if c not in base]
    df = loans(spark, folder, *base, *keep)
    return df.select(
        "loan_id", F.col("isDefault").alias("label"), *extra, *[F.expr(s).alias(n) for n, s in SCORE_RULES.items()]
    )


def raw_applications(spark: SparkSession, folder: str) -> DataFrame:
    """Uncleaned text and date fields in the shapes the loan file has."""
    df = loans(spark, folder, "loan_id", "issueDate", "grade", "regionCode", "isDefault")
    k = F.col("regionCode") % 13
    return df.select(
        F.col("loan_id").alias("id"),
        F.lit(1.0).alias("policyCode"),
        F.when(k == 0, "< 1 year").when(k == 1, "1 year").when(k == 10, "10+ years").when(k == 11, None)
        .when(k == 12, "n/a").otherwise(F.concat(k.cast("string"), F.lit(" years"))).alias("employmentLength"),
        F.when(k == 5, "unknown").otherwise(F.date_format("issueDate", "yyyy-MM-dd")).alias("issueDate"),
        F.when(k == 7, "missing").otherwise(F.date_format("issueDate", "MMM-yyyy")).alias("earliesCreditLine"),
        F.when(k == 3, None).otherwise(F.col("grade")).alias("grade"),
        F.when(k == 3, None).when(k == 4, F.concat("grade", F.lit("x")))
        .otherwise(F.concat("grade", (F.col("regionCode") % 5 + 1).cast("string"))).alias("subGrade"),
        "isDefault",
    )


def performance(spark: SparkSession, folder: str) -> DataFrame:
    """Order line as a monthly observation: age in months since the order, bad if returned."""
    li, o = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    age = (F.year("l_shipdate") - F.year("o_orderdate")) * 12 + F.month("l_shipdate") - F.month("o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_orderkey").alias("loan_id"),
        F.date_format("o_orderdate", "yyyy-MM").alias("cohort"),
        age.cast("int").alias("loan_age"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("is_bad"),
        F.col("l_extendedprice").alias("balance"),
    )


def snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Customer by month: number of late (status F) orders, used as the overdue count."""
    o = table(spark, folder, "orders")
    return o.groupBy(
        F.col("o_custkey").alias("customer_id"),
        (F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1).alias("month_idx"),
    ).agg(
        F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("current_dpd"),
        F.sum("o_totalprice").alias("balance"),
    )


def relations(spark: SparkSession, folder: str) -> DataFrame:
    """Customer to customer: returned lines whose part number is also a customer number."""
    li = table(spark, folder, "lineitem").where("l_returnflag = 'R'")
    o = table(spark, folder, "orders")
    c = table(spark, folder, "customer").select("c_custkey")
    return (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(c, F.col("l_partkey") == F.col("c_custkey"))
        .where("o_custkey <> l_partkey")
        .select(
            F.col("o_custkey").alias("customer_id_1"),
            F.col("l_partkey").alias("customer_id_2"),
            F.expr(
                "CASE l_linenumber WHEN 1 THEN 'guarantor' WHEN 2 THEN 'co_borrower' "
                "WHEN 3 THEN 'device' ELSE 'other' END"
            ).alias("relation_type"),
            F.to_date("l_shipdate").alias("relation_start_date"),
        )
    )


def customer_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer: 1 if any of its loans is bad."""
    bad = loans(spark, folder, "customer_id", "isDefault").groupBy("customer_id").agg(F.max("isDefault").alias("d"))
    c = table(spark, folder, "customer").select(F.col("c_custkey").alias("customer_id"))
    return c.join(bad, "customer_id", "left").select("customer_id", F.coalesce("d", F.lit(0)).alias("isDefault"))


def device_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct (user, device) pairs of all events."""
    return (
        table(spark, folder, "events")
        .select("user_id", F.get_json_object("props", "$.k").cast("long").alias("device_id"))
        .distinct()
    )


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("long").alias("device_id"),
    )
