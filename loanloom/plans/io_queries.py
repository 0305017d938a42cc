"""Round trips through the file formats, saved models and batch scoring."""

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from loanloom.functions.cleaning import clean_loans
from loanloom.plans.catalog import query
from loanloom.plans.check_sql import LOAN, SCORED, r6
from loanloom.plans.feature_queries import RAW
from loanloom.plans.profile_queries import rounded
from loanloom.sources import marts, sinks
from loanloom.sources.tables import read_loans_csv


@query("csv_round_trip", f"""
WITH {RAW} SELECT id, CASE el WHEN '< 1 year' THEN 0 WHEN '1 year' THEN 1 WHEN '10+ years' THEN 10
  ELSE coalesce(try_cast(nullif(split_part(el, ' years', 1), el) AS INT), -1) END::TINYINT AS "employmentLength", isDefault AS "isDefault" FROM raw""")
def csv_round_trip(spark, folder):
    path = sinks.run_folder(spark, "loans-csv")
    raw = marts.raw_applications(spark, folder)
    raw.write.option("header", True).csv(path)
    back = clean_loans(read_loans_csv(spark, path))
    return back.select("id", "employmentLength", "isDefault")


@query("cleaned_round_trip", f"""
WITH {LOAN} SELECT year(issueDate)::INT AS "issueDate_year", count(*) AS n, sum(isDefault)::BIGINT AS bad FROM loan GROUP BY 1""")
def cleaned_round_trip(spark, folder):
    path = sinks.run_folder(spark, "cleaned")
    df = marts.loans(spark, folder, "loan_id", "issueDate", "isDefault").withColumn("issueDate_year", F.year("issueDate"))
    sinks.write_cleaned(df, path)
    back = spark.read.parquet(path)
    return back.groupBy("issueDate_year").agg(F.count("*").alias("n"), F.sum("isDefault").alias("bad"))


@query("features_round_trip", f"""
WITH {LOAN} SELECT loan_id, isDefault AS "isDefault", coalesce(annualIncome, -999) AS "annualIncome", coalesce(n1, -999) AS n1 FROM loan""")
def features_round_trip(spark, folder):
    path = sinks.run_folder(spark, "features")
    sinks.write_features(marts.loans(spark, folder, "loan_id", "annualIncome", "n1", "isDefault"), ["annualIncome", "n1"], path, ["loan_id", "isDefault"])
    df, names = sinks.read_features(spark, path)
    return df.select("loan_id", "isDefault", *names)


@query("submission_round_trip", f"""WITH {SCORED} SELECT loan_id AS id, score AS "isDefault" FROM scored""")
def submission_round_trip(spark, folder):
    path = sinks.run_folder(spark, "submission")
    sinks.write_submission(marts.scores(spark, folder).select(F.col("loan_id").alias("id"), F.col("score").alias("isDefault")), path)
    return spark.read.schema("id long, isDefault double").option("header", True).csv(path)


@query("batch_scores")
def batch_scores(spark, folder):
    features = ["n0", "n1", "loanAmnt"]
    df = marts.loans(spark, folder, "loan_id", *features, "isDefault").fillna(0.0, features)
    stages = [VectorAssembler(inputCols=features, outputCol="features"), LogisticRegression(labelCol="isDefault", regParam=0.01)]
    path = sinks.run_folder(spark, "model")
    sinks.save_model(Pipeline(stages=stages).fit(df), path, features, {"owner": "risk"}, "2001-08-01T00:00:00")
    model, meta = sinks.load_model(spark, path)
    return rounded(sinks.batch_score(df, model, "loan_id", meta["saved_at"][:10], "behaviour_v1"))
