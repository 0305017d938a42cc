"""Text features and retrieval over whole documents."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, IDF, NGram, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, functions as F

from loanloom.operators.ordering import row_positions
from loanloom.session import hold


def tfidf(df: DataFrame, text: str, keep: Sequence[str], terms: int = 500) -> tuple[DataFrame, list[str]]:
    """Unit-length TF-IDF vectors over the most frequent words and word pairs.

    Words have at least two letters; idf = ln((1 + n) / (1 + df)) + 1. The terms are counted by a grouping, which spills where a
    vocabulary exceeds the memory, and terms of equal frequency go by name; only the counts of the chosen terms are held.
    """
    from pyspark.ml.linalg import Vectors

    filled = df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    words = RegexTokenizer(inputCol="_text", outputCol="_w", pattern=r"(?U)\b\w\w+\b", gaps=False).transform(filled)
    pairs = NGram(n=2, inputCol="_w", outputCol="_p").transform(words)
    grams = pairs.select(*keep, F.concat("_w", "_p").alias("_g"))
    met = grams.select(F.explode("_g").alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    vocabulary = [r["term"] for r in met.orderBy(F.desc("n"), "term").limit(terms).collect()]
    if not vocabulary:
        raise ValueError("the texts have no words")
    counter = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="_g", outputCol="_tf")
    counts = hold(counter.transform(grams).select(*keep, "_tf"))
    idf = IDF(inputCol="_tf", outputCol="_x").fit(counts).idf
    weights = Vectors.dense([float(v) + 1.0 for v in idf])
    scaled = ElementwiseProduct(scalingVec=weights, inputCol="_tf", outputCol="_s").transform(counts)
    return Normalizer(p=2.0, inputCol="_s", outputCol="tfidf").transform(scaled).select(*keep, "tfidf"), vocabulary


def text_components(df: DataFrame, text: str, key: str, components: int = 10, terms: int = 500) -> DataFrame:
    """TF-IDF reduced to its leading singular directions; the sign makes each direction's largest weight positive.

    The directions are the eigenvectors of the terms' cross products, a matrix of terms x terms that one pass sums up.
    """
    x, _ = tfidf(df, text, [key], terms)
    square = RowMatrix(MLUtils.convertVectorColumnsFromML(x.select("tfidf"), "tfidf")).computeGramianMatrix().toArray()
    if components > len(square):
        raise ValueError(f"{components} components of {len(square)} terms")
    power, v = np.linalg.eigh(square)
    there = np.sqrt(np.maximum(power, 0)) > 1e-9 * np.sqrt(power[-1])  # as computeSVD has it
    v = v[:, there][:, ::-1][:, :components]
    v = v * np.sign(v[np.abs(v).argmax(axis=0), range(v.shape[1])])

    @F.pandas_udf("array<double>")
    def project(a: pd.Series) -> pd.Series:
        return pd.Series(list(np.stack(a.to_numpy()) @ v)) if len(a) else pd.Series([], dtype=object)

    out = x.select(key, project(vector_to_array("tfidf")).alias("_c"))
    return out.select(key, *[F.get("_c", F.lit(i)).alias(f"{text}_svd_{i}") for i in range(v.shape[1])])


def retrieve(df: DataFrame, text: str, key: str, question: str, k: int = 3) -> DataFrame:
    """Documents that contain any word of the question, most words first, then by key."""
    hits = sum((F.when(F.contains(F.col(text), F.lit(w)), 1).otherwise(0) for w in dict.fromkeys(question.split())), F.lit(0))
    return df.withColumn("n_words", hits).where("n_words > 0").orderBy(F.desc("n_words"), key).limit(k)


def numbered_articles(df: DataFrame, entity: str, key: str, title: str, content: str) -> DataFrame:
    """Per entity the articles in key order, each numbered and laid out with its title and whole text.

    One row per article: an entity's text is read in ``pos`` order and never gathered into one cell.
    """
    p = row_positions(df.select(entity, key, title, content), key, key, [entity], descending=False)
    line = F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("] "), F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(content, F.lit("")))
    return p.select(entity, "pos", line.alias("article"))
