"""Writers and saved models."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from loanloom.operators.profiling import small_frame
from loanloom.session import run_folder  # noqa: F401


def write_cleaned(df: DataFrame, path: str, year: str | None = "issueDate_year") -> None:
    """Parquet, laid out by year so that out-of-time reads prune folders."""
    if year and year in df.columns:
        # adaptive execution sizes the files: a year with many rows gets many writers
        df.hint("rebalance", F.col(year)).write.mode("overwrite").partitionBy(year).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def write_features(df: DataFrame, selected: Sequence[str], path: str, keep: Sequence[str], missing: float = -999.0) -> None:
    """Selected columns with missing numbers filled, and the list of names beside them."""
    df.select(*keep, *selected).fillna(missing, list(selected)).write.mode("overwrite").parquet(f"{path}/features")
    small_frame(df.sparkSession, [{"feature": f} for f in selected]).coalesce(1).write.mode("overwrite").json(f"{path}/selected")


def read_features(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    names = [r["feature"] for r in spark.read.schema("feature string").json(f"{path}/selected").collect()]
    return spark.read.parquet(f"{path}/features"), names


def write_submission(df: DataFrame, path: str, key: str = "id", score: str = "isDefault") -> None:
    df.select(key, score).write.mode("overwrite").option("header", True).csv(path)


def save_model(model: PipelineModel, path: str, features: Sequence[str], meta: dict, saved_at: str) -> None:
    """The fitted stages and one metadata row: features, free-form meta, time stamp."""
    model.write().overwrite().save(f"{path}/model")
    row = [{"saved_at": saved_at, "features": ",".join(features), "meta": json.dumps(meta, sort_keys=True)}]
    small_frame(SparkSession.active(), row).coalesce(1).write.mode("overwrite").json(f"{path}/meta")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    row = spark.read.schema("saved_at string, features string, meta string").json(f"{path}/meta").first()
    return PipelineModel.load(f"{path}/model"), row.asDict()


def batch_score(df: DataFrame, model: PipelineModel, key: str, score_date: str, version: str) -> DataFrame:
    """Score a whole book; partitions take the place of chunks."""
    from pyspark.ml.functions import vector_to_array

    return model.transform(df).select(
        key, F.get(vector_to_array("probability"), 1).alias("risk_score"), F.lit(score_date).alias("score_date"),
        F.lit(version).alias("model_version"))
