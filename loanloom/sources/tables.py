"""Readers with fixed schemas. Nothing is inferred from the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Fields of the loan application file, in file order, and their types.
LABEL = "isDefault"
LOAN_FIELDS = """
id long, loanAmnt double, term int, interestRate double, installment double, grade string, subGrade string, employmentTitle double,
employmentLength string, homeOwnership string, annualIncome double, verificationStatus string, issueDate string, isDefault int,
purpose string, postCode double, regionCode double, dti double, delinquency_2years double, ficoRangeLow double, ficoRangeHigh double,
openAcc double, pubRec double, pubRecBankruptcies double, revolBal double, revolUtil double, totalAcc double, initialListStatus string,
applicationType string, earliesCreditLine string, title double, policyCode double
"""
UNUSED_FIELDS = ["policyCode"]
ANONYMOUS_FIELDS = [f"n{i}" for i in range(15)]


def loan_schema(labelled: bool = True) -> T.StructType:
    schema = T.StructType.fromDDL(LOAN_FIELDS + "".join(f", {c} double" for c in ANONYMOUS_FIELDS))
    return schema if labelled else T.StructType([f for f in schema.fields if f.name != LABEL])


def read_loans_csv(spark: SparkSession, path: str, labelled: bool = True, rows: int | None = None) -> DataFrame:
    """Loan file with a header line. Columns are found by the names in that line, in any order; a field that the file lacks is
    null, and columns that are no field are left out. The label must be there if the file is labelled. The files of a folder
    share one header: each file's own is compared with it, and one with other names or another order stops the read."""
    wanted = loan_schema(labelled)
    by_name = {f.name: f for f in wanted.fields}
    header = spark.read.option("header", True).csv(path).columns  # reads the first line alone
    if labelled and LABEL not in header:
        raise ValueError(f"{path} has no column {LABEL}")
    schema = T.StructType([by_name.get(h, T.StructField(h, T.StringType())) for h in header])
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    df = df.select(*[F.col(f.name) if f.name in header else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted.fields])
    return df.limit(rows) if rows else df


def read_train_test(spark: SparkSession, train_path: str, test_path: str, rows: int | None = None):
    """The labelled and the unlabelled file, cleaned; a missing file fails when the plan is built."""
    from loanloom.functions.cleaning import clean_loans

    train = clean_loans(read_loans_csv(spark, train_path, True, rows=rows))
    test = clean_loans(read_loans_csv(spark, test_path, False, rows=rows))
    return train, test


def load_summary(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Row count, column count and bad rate in one aggregate."""
    return df.agg(
        F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"), F.avg(label).alias("bad_rate")
    )


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
