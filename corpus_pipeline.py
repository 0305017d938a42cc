"""A training corpus from raw documents, in five stages: quality, near duplicates, repeated passages, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next one's docs. All but
the last return the columns of documents. Stages work on what their predecessor kept, and their decisions take effect:

1. quality: texts above their language's perplexity threshold go (``kneser_ney``);
2. near_duplicates: of texts with 5-word shingle similarity of 0.8 or more, the one with the smallest doc_id stays
   (``jaccard_join``); of rows equal in doc_id and text one stays;
3. repeats: strings of REPEAT_BYTES bytes that start in a document with a smaller doc_id are cut out, in whole characters
   (``suffix_dedup``); n_chars follows; a text of which only white space is left goes;
4. benchmark: texts that share ten consecutive words with a benchmark item, or a whole shorter item, go (``decontaminate``);
5. tokens: texts become SentencePiece ids (``pieces``); text is what the ids decode to.

Extra columns travel with the rows (columns named ids or n_tokens are replaced by stage 5). Null texts: they have no perplexity, so stage 1 drops them; later stages treat a null as an
empty text. Null ids: such rows are judged like all others, and stage 2 drops them only if an equal text has an id. Empty tables
stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanloom.llm import decontaminate, jaccard_join, kneser_ney, pieces, suffix_dedup
from loanloom.llm.common import free, written
from loanloom.llm.tokenizers import pieces as piece_model

#: any passage of more than 50 words has at least this many bytes
REPEAT_BYTES = 100


def _staying(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of docs whose doc_id is among ids (null is an id like any other)."""
    own = free("stays", docs)
    known = ids.select(F.col("doc_id").alias(own)).distinct()
    return docs.join(known, docs["doc_id"].eqNullSafe(known[own]), "left_semi")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = kneser_ney.judged(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    # a text without characters has no perplexity even where another row of its id has one
    return _staying(docs.where("text <> ''"), judged.where("kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = jaccard_join.near_duplicates(docs, size=5, percent=80)
    # structs of null fields are equal; join and window share the shuffle on the key, so texts travel once
    key, copy = free("key", docs), free("copy", docs)
    stays = found.where("component_id IS NULL OR doc_id = component_id").select(F.struct("doc_id").alias(key)).distinct()
    left = docs.withColumn(key, F.struct("doc_id")).join(stays, key, "left_semi")
    others = [F.col(c).cast("string") for c in docs.columns if c not in ("doc_id", "text")]
    one = Window.partitionBy(key, F.xxhash64("text")).orderBy(*others or [F.lit(0)])
    return left.withColumn(copy, F.row_number().over(one)).where(F.col(copy) == 1).drop(key, copy)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    out = suffix_dedup.deduplicated(docs.withColumnsRenamed({c: f"k_{c}" for c in rest}), REPEAT_BYTES, keep=tuple(f"k_{c}" for c in rest),
                                    whole_characters=True)
    out = out.withColumn("text", F.col("kept").cast("string"))
    out = out.where("n_removed = 0 OR text RLIKE '[^ \\\\t-\\\\r]'")
    columns = {c: F.col(f"k_{c}") for c in rest}
    if "n_chars" in rest:
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("k_n_chars"))
    return out.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in docs.columns])


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _staying(docs, found.where("NOT contaminated"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model, rest = piece_model(), tuple(c for c in docs.columns if c not in ("doc_id", "text", "ids", "n_tokens"))
    back = pieces.encode_and_decode(docs, model, keep=rest)
    return back.select(*[c for c in docs.columns if c not in ("ids", "n_tokens")], "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeats", repeats), ("benchmark", benchmark), ("tokens", tokens)]
#: perplexity, links and piece merges have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
