"""What the operators share: column clean-up, written intermediate tables, ASCII-only lower case."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: white space of the word contracts: space, tab to carriage return
BLANKS = " \t\n\x0b\f\r"


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; where it is unset (tests on one machine) a private one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        named = tempfile.mkdtemp(prefix="llm-shared-")
        spark.sparkContext.setCheckpointDir(named)
    return named


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a step's rows to the shared folder and go on from there.

    Lost executors replay nothing before it. The step's shuffle files have no reader any more, so the driver is asked
    to collect its garbage, upon which Spark frees them.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    schema = df.schema
    del df
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def free(name: str, df: DataFrame) -> str:
    """A working column's name that df does not have."""
    while name in df.columns:
        name = "_" + name
    return name


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. Texts of ASCII alone take the quick built-in."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def blank_words(text: Column) -> Column:
    """Words between white space (space, tab to carriage return); null and blank texts have none."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+"))
