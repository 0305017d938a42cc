"""Benchmark decontamination by winnowing (DataFrame functions only).

A text is a list of words. Every k-gram of words gets a hash; in each run of ``window - k + 1`` neighbouring k-grams the
smallest hash is kept. Two texts that share ``window`` consecutive words share all k-grams of that run, hence its smallest
hash: a join of the kept hashes finds every shared window. Each hit is then extended: the windows around the shared k-gram
are compared word by word (as joined strings) with the windows of the benchmark, so the result is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.llm.common import ascii_lower, written

WINDOW, GRAM = 10, 6
#: fingerprints of the benchmark up to this number are broadcast (at most 64 MB); beyond it the join shuffles
BROADCAST_ROWS = 4_000_000


def content_words(text: Column) -> Column:
    """Lower-cased runs of digits, letters a-z and non-ASCII characters."""
    cut = F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.array_remove(cut, "")


def _hashes(words: str, size: int) -> str:
    return f"xxhash64({size}, {', '.join(f'{words}[i + {j}]' for j in range(size))})"


def _kept(texts: DataFrame, window: int, gram: int, short: list[int]) -> DataFrame:
    """Adds n and ``marks``: the kept (kind, pos, hash); kind 0 from winnowing, kind m for every m-gram of a short length."""
    run = window - gram + 1
    df = texts.withColumn("n", F.size("w"))
    df = df.withColumn("h", F.expr(f"IF(n < {window}, array(), transform(sequence(0, greatest(n, {gram}) - {gram}), i -> {_hashes('w', gram)}))"))
    df = df.withColumn("m", F.expr(
        f"IF(n < {window}, array(), transform(sequence(0, greatest(size(h), {run}) - {run}), "
        f"i -> least({', '.join(f'h[i + {j}]' for j in range(run))})))" if run > 1 else "h"))
    near = ", ".join(f"get(m, p - {j})" for j in range(run))
    best = f"greatest({near})" if run > 1 else "m[p]"
    marks = (f"IF(n < {window}, array(), filter(transform(h, (x, p) -> IF(x = {best}, struct(0 AS kind, p AS pos, x AS hash), null)), "
             "x -> x IS NOT NULL))")
    for m in short:
        marks = (f"concat({marks}, IF(n < {m}, array(), transform(sequence(0, greatest(n, {m}) - {m}), "
                 f"i -> struct({m} AS kind, i AS pos, {_hashes('w', m)} AS hash))))")
    return df.withColumn("marks", F.expr(marks))


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(sizes, spans): ``sizes`` has (doc_id, n_words) for every row of docs; ``spans`` has one row per document, start word
    and item: (doc_id, start, length, item_id), the window ``[start, start + length)`` being a window of that item.

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text; other columns are left alone. Null and empty texts have
    no words. Rows that share a doc_id (null is an id like any other) count as one document; repeated benchmark rows change
    nothing. An item with fewer words than ``window`` is one window of its own length.
    """
    if not 0 < gram <= window:
        raise ValueError("gram must lie between 1 and window")
    items = written(benchmark.select("item_id", content_words(F.col("text")).alias("w")).where(F.size("w") > 0).distinct(), "items")
    # at most window - 1 values
    short = sorted(r[0] for r in items.where(F.size("w") < window).select(F.size("w")).distinct().collect())
    panes = items.withColumn("n", F.size("w")).select("item_id", F.least("n", F.lit(window)).alias("length"), F.expr(
        f"explode_outer(transform(sequence(0, n - least(n, {window})), i -> array_join(slice(w, i + 1, {window}), ' ')))").alias("pane"))
    panes = written(panes.distinct(), "panes")
    # outer generators throughout: for the plain ones the planner adds a filter on the array, which it pushes down and
    # writes out once more inside each lambda
    prints = _kept(items, window, gram, short).select(F.size("w").alias("n"), F.inline_outer("marks"))
    # a short gram counts only where it is the whole item
    prints = prints.where("kind = 0 OR kind = n").select("kind", "hash").distinct()
    prints = written(prints, "prints")
    if prints.count() <= BROADCAST_ROWS:
        prints = F.broadcast(prints)

    texts = docs.select("doc_id", content_words(F.col("text")).alias("w"))
    # every document's own row has a hash that matches nothing: a key of its own where the join shuffles
    marks = _kept(texts, window, gram, short).select("doc_id", F.inline_outer(F.expr(
        "concat(array(struct(-1 AS kind, n AS pos, xxhash64(doc_id, n) AS hash)), marks)")))
    known = prints.select(F.col("kind").alias("_kind"), F.col("hash").alias("_hash"))
    found = marks.join(known, (F.col("kind") == F.col("_kind")) & (F.col("hash") == F.col("_hash")), "left")
    found = written(found.where("kind = -1 OR _hash IS NOT NULL").select("doc_id", "kind", "pos"), "found")
    sizes = found.where("kind = -1").select("doc_id", F.col("pos").cast("long").alias("n_words"))

    # extension: every window that holds the shared gram, compared as text
    starts = found.where("kind >= 0").select("doc_id", F.expr(f"IF(kind = 0, {window}, kind)").alias("length"), F.expr(
        f"explode(IF(kind = 0, sequence(greatest(pos - {window - gram}, 0), pos), array(pos)))").alias("start"))
    starts = starts.groupBy("doc_id").agg(F.collect_set(F.struct("start", "length")).alias("starts"))
    here = starts.select(F.col("doc_id").alias("_id"), "starts")
    panes_of_docs = docs.select("doc_id", "text").join(here, F.col("doc_id").eqNullSafe(F.col("_id"))).select(
        "doc_id", "starts", content_words(F.col("text")).alias("w"))
    panes_of_docs = panes_of_docs.withColumn("n", F.size("w")).select("doc_id", F.expr(
        "inline_outer(transform(filter(starts, s -> s.start + s.length <= n), "
        "s -> struct(s.start AS start, s.length AS length, array_join(slice(w, s.start + 1, s.length), ' ') AS pane)))")).where("start IS NOT NULL")
    theirs = panes.select("item_id", F.col("length").alias("_length"), F.col("pane").alias("_pane"))
    spans = panes_of_docs.join(theirs, (F.col("pane") == F.col("_pane")) & (F.col("length") == F.col("_length"))).select(
        "doc_id", "start", "length", "item_id").distinct()
    return sizes, written(spans, "spans")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit (words inside a matching window), n_items, items (sorted as strings,
    comma-joined), contaminated. Edge cases as in ``hits``; an empty table on either side gives no hits."""
    sizes, spans = hits(docs, benchmark, window, gram)
    words = spans.select("doc_id", F.expr("explode(sequence(start, start + length - 1))").alias("pos")).distinct()
    n_hit = words.groupBy(F.col("doc_id").alias("_h")).agg(F.count("*").alias("n_hit"))
    items = spans.select("doc_id", "item_id").distinct().groupBy(F.col("doc_id").alias("_i")).agg(
        F.count("*").alias("n_items"), F.array_join(F.sort_array(F.collect_list(F.col("item_id").cast("string"))), ",").alias("items"))
    out = sizes.join(n_hit, F.col("doc_id").eqNullSafe(F.col("_h")), "left").join(items, F.col("doc_id").eqNullSafe(F.col("_i")), "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", F.lit("")).alias("items"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))
