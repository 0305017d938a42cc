"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of characters, trained on trusted text.

The model's symbols are the characters below U+057D (Latin, Greek, Cyrillic and their marks); any other character is two symbols, its
block of 512 and its place there, so that all characters are told apart and five symbols fit into a long.

The n-gram table of the trusted texts is a DataFrame sharded by n-gram. The highest order has occurrence counts; lower orders
have continuation counts (number of different characters before the n-gram), each order from the one above. Discounts D1, D2,
D3+ of each order come from its counts of counts. Each order's probabilities are a join with the sums of its contexts and
with the probabilities of the order below. All of that is done per language and once more for all languages together, which
stands in for languages with few trusted texts.

Scoring looks up the longest known n-gram of every character; contexts that were seen pay their back-off weight. Model tables
of up to MODEL_ROWS rows go to the tasks (a bound of 80 MB); larger ones are joined with the n-gram counts of the documents,
shard by shard. A text is kept when its perplexity per character is at most the given quantile of its language's trusted
texts that the model has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.llm.common import written
from loanloom.llm.words import steps, text_bytes

ORDER = 5
WIDTH = 12  # bits of a character code; five fit into a long
BEGIN, END = 1, 2
#: characters that are one symbol, and the first symbols for blocks of 512 characters (2176 of them) and for places in a block
DIRECT = 1405
LEAD, TRAIL = 3 + DIRECT, 3 + DIRECT + 2176
MODEL_ROWS = 5_000_000
#: parts in which a model table comes to the driver
PARTS = 8
#: bytes of text whose n-grams are sorted at once
STEP_BYTES = 1 << 20
QUANTILE = 0.995
#: trusted texts below which a language uses the model and threshold of all languages
LEAST_TRUSTED = 30
#: languages with a model of their own
LANGUAGES = 1000
ALL = "*"


def _codes(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(codes, bounds): per text ORDER - 1 begin marks, the symbols of its characters, an end mark."""
    data, offsets = text_bytes(part.column(part.schema.get_field_index("text")))
    chars = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    wide = chars >= DIRECT
    at = np.concatenate([[0], np.cumsum(1 + wide)])
    symbols = np.empty(int(at[-1]), np.int64)
    symbols[at[:-1]] = np.where(wide, LEAD + (chars >> 9), chars + 3)
    symbols[at[:-1][wide] + 1] = TRAIL + (chars[wide] & 511)
    heads = at[heads]
    n = len(offsets) - 1
    bounds = heads + np.arange(n + 1) * ORDER
    out = np.full(int(bounds[-1]), BEGIN, np.int64)
    owner = np.repeat(np.arange(n), np.diff(heads))
    out[np.arange(len(symbols)) + owner * ORDER + ORDER - 1] = symbols
    out[bounds[1:] - 1] = END
    return out, bounds


def _grams(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram ending at each character or end mark, text of each)."""
    key = np.zeros(len(codes), np.int64)
    for back in range(ORDER - 1, -1, -1):
        key[ORDER - 1:] = (key[ORDER - 1:] << WIDTH) | codes[ORDER - 1 - back:len(codes) - back]
    real = np.ones(len(codes), bool)
    for j in range(ORDER - 1):
        real[bounds[:-1] + j] = False
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds) - (ORDER - 1))
    return key[real], owner


def counts(texts: DataFrame) -> DataFrame:
    """lang, gram, c: occurrences of the longest n-grams over all rows of texts (lang, text), and those of ``ALL``."""
    def run(batches: Iterator[pa.RecordBatch]):
        for part in steps(batches, limit=STEP_BYTES):
            langs = part.column(0).to_pylist()
            names = {x: i for i, x in enumerate(dict.fromkeys(langs))}
            of = np.array([names[x] for x in langs], np.int32)
            gram, owner = _grams(*_codes(part))
            of = of[owner]
            del owner
            order = np.lexsort((gram, of))
            gram, of = gram[order], of[order]
            del order
            first = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (of[1:] != of[:-1])])) if len(gram) else np.zeros(0, np.int64)
            c = np.diff(np.concatenate([first, [len(gram)]]))
            lang = pa.array(list(names), pa.string()).take(pa.array(of[first]))
            yield pa.RecordBatch.from_arrays([lang, pa.array(gram[first]), pa.array(c, pa.int64())], names=["lang", "gram", "c"])

    own = texts.select("lang", "text").mapInArrow(run, "lang string, gram long, c long").groupBy("lang", "gram").agg(F.sum("c").alias("c"))
    own = written(own, "grams")
    return own.unionByName(own.groupBy("gram").agg(F.sum("c").alias("c")).withColumn("lang", F.lit(ALL)))


def _mask(order: int) -> int:
    return (1 << (WIDTH * order)) - 1


def model(highest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(probabilities, back-offs): (lang, k, gram, logp) of every known n-gram of order k = 1 .. ORDER, and (lang, k, context,
    logb) with ``context`` the k - 1 characters before an n-gram of order k."""
    highest = written(highest, "highest")
    tables = {ORDER: highest}
    for k in range(ORDER - 1, 0, -1):
        tables[k] = written(tables[k + 1].groupBy("lang", F.col("gram").bitwiseAND(_mask(k)).alias("gram")).agg(
            F.count("*").alias("c")), f"order{k}")
    below, probs, backs = None, None, None
    for k in range(1, ORDER + 1):
        t = tables[k]
        n = [F.sum((F.col("c") == i).cast("double")).alias(f"n{i}") for i in range(1, 5)]
        spread = t.groupBy("lang").agg(*n).withColumn("y", F.expr("n1 / greatest(n1 + 2 * n2, 1)"))
        # D_i = i - (i + 1) y n_(i+1) / n_i, kept within [0.1, i] where counts of counts are missing
        d = [F.expr(f"CASE WHEN n{i} = 0 THEN {0.5 * i} ELSE least({i}, greatest(0.1, {i} - {i + 1} * y * n{i + 1} / n{i})) END").alias(f"d{i}")
             for i in (1, 2, 3)]
        discounts = written(spread.select(F.col("lang").alias("_l"), *d), "discounts")
        t = t.join(discounts, F.col("lang").eqNullSafe(F.col("_l"))).withColumn("d", F.expr("CASE c WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END"))
        t = t.select("lang", "gram", "c", F.least("d", "c").alias("d"), F.shiftright("gram", WIDTH).alias("context"))
        sums = t.groupBy("lang", "context").agg(F.sum("c").cast("double").alias("total"), F.sum("d").alias("spared"), F.count("*").alias("kinds"))
        # order 1 backs off to one share for each known character and one for all others
        sums = written(sums.withColumn("b", F.expr("spared / total") if k > 1 else F.expr("spared / total / (kinds + 1)")), f"contexts{k}")
        s = sums.select(F.col("lang").alias("_sl"), F.col("context").alias("_sc"), "total", "b")
        p = t.join(s, F.col("lang").eqNullSafe(F.col("_sl")) & (F.col("context") == F.col("_sc")))
        if below is None:
            p = p.select("lang", "gram", F.expr("(c - d) / total + b").alias("p"))
        else:
            lower = below.select(F.col("lang").alias("_bl"), F.col("gram").alias("_bg"), F.col("p").alias("_bp"))
            p = p.join(lower, F.col("lang").eqNullSafe(F.col("_bl")) & (F.col("gram").bitwiseAND(_mask(k - 1)) == F.col("_bg"))).select(
                "lang", "gram", F.expr("(c - d) / total + b * _bp").alias("p"))
        below = written(p, f"probabilities{k}")
        one = below.select("lang", F.lit(k).alias("k"), "gram", F.log("p").alias("logp"))
        two = sums.select("lang", F.lit(k).alias("k"), "context", F.log("b").alias("logb"))
        probs = one if probs is None else probs.unionByName(one)
        backs = two if backs is None else backs.unionByName(two)
    return probs, backs


def _packed(table: DataFrame, key: str, value: str) -> dict:
    """{(lang, k): (sorted keys, values)} of a model table of checked size. Tasks pack the rows into bytes, which come to the
    driver part by part, so that it holds 16 bytes a row and the copies of one (lang, k) at a time."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column(0).dictionary_encode()
            of, k = names.indices.fill_null(-1).to_numpy(), batch.column(1).to_numpy()
            order = np.lexsort((k, of))
            of, k = of[order], k[order]
            keys, values = (batch.column(i).to_numpy(zero_copy_only=False)[order] for i in (2, 3))
            cuts = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (k[1:] != k[:-1]), [True]]))
            spans = list(zip(cuts[:-1], cuts[1:]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([names.dictionary[int(of[x])].as_py() if of[x] >= 0 else None for x, _ in spans], pa.string()), pa.array(k[cuts[:-1]], pa.int32()),
                 pa.array([keys[x:y].tobytes() for x, y in spans], pa.binary()), pa.array([values[x:y].tobytes() for x, y in spans], pa.binary())],
                names=["lang", "k", "keys", "values"])

    rows = table.select("lang", F.col("k").cast("int"), F.col(key).cast("long"), F.col(value).cast("double")).coalesce(PARTS)
    out = {}
    for lang, k, keys, values in rows.mapInArrow(run, "lang string, k int, keys binary, values binary").toLocalIterator():
        held = out.setdefault((lang, k), (bytearray(), bytearray()))
        held[0].extend(keys)
        held[1].extend(values)
    for name, (keys, values) in out.items():
        keys, values = np.frombuffer(keys, np.int64), np.frombuffer(values, np.float64)
        order = np.argsort(keys)
        out[name] = (keys[order], values[order])
    return out


def _found(table, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    known, values = table
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return known[at] == keys, values[at]


def _logs(gram: np.ndarray, lang, probs: dict, backs: dict) -> np.ndarray:
    """ln p of the last character of each n-gram."""
    out = np.zeros(len(gram))
    open_ = np.arange(len(gram))
    for k in range(ORDER, 0, -1):
        hit, logp = _found(probs[(lang, k)], gram[open_] & _mask(k))
        out[open_[hit]] += logp[hit]
        open_ = open_[~hit]
        if not len(open_):
            break
        seen, logb = _found(backs[(lang, k)], (gram[open_] & _mask(k)) >> WIDTH)
        out[open_[seen]] += logb[seen]
    return out


def _characters() -> Column:
    return F.coalesce(F.char_length("text"), F.lit(0)).alias("n_chars")


def _by_broadcast(docs: DataFrame, probs: DataFrame, backs: DataFrame, langs: list) -> DataFrame:
    given = docs.sparkSession.sparkContext.broadcast((_packed(probs, "gram", "logp"), _packed(backs, "context", "logb"), set(langs)))

    def run(batches: Iterator[pa.RecordBatch]):
        p, b, own = given.value
        for part in steps(batches):
            gram, owner = _grams(*_codes(part))
            names = part.column(part.schema.get_field_index("lang")).to_pylist()
            of = np.array([x if x in own else ALL for x in names], object)
            total = np.zeros(part.num_rows)
            # distinct n-grams are looked up once
            for name in set(of.tolist()):
                mine = (of == name)[owner]
                keys, back = np.unique(gram[mine], return_inverse=True)
                total += np.bincount(owner[mine], _logs(keys, name, p, b)[back], part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), part.column(1), part.column(2).cast(pa.int64()), pa.array(total)],
                                             names=["doc_id", "lang", "n_chars", "logp"])

    return docs.select("doc_id", "lang", _characters(), "text").mapInArrow(run, "doc_id long, lang string, n_chars long, logp double")


def _by_join(docs: DataFrame, probs: DataFrame, backs: DataFrame, langs: list) -> DataFrame:
    """The same for a model of any size: every document's n-gram counts are joined with the model's shards, order by order."""
    def run(batches: Iterator[pa.RecordBatch]):
        for part in steps(batches):
            gram, owner = _grams(*_codes(part))
            order = np.lexsort((gram, owner))
            g, o = gram[order], owner[order]
            first = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (o[1:] != o[:-1])])) if len(g) else np.zeros(0, np.int64)
            c = np.diff(np.concatenate([first, [len(g)]]))
            take = pa.array(o[first], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0).take(take), part.column(1).take(take), part.column(2).take(take), part.column(3).cast(pa.int64()).take(take),
                                              pa.array(g[first]), pa.array(c, pa.int64())], names=["_row", "doc_id", "lang", "n_chars", "gram", "c"])

    rows = written(docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "lang", _characters(), "text"), "rows")
    df = rows.select("_row", "doc_id", "lang", "n_chars", "text").mapInArrow(run, "_row long, doc_id long, lang string, n_chars long, gram long, c long")
    df = df.withColumn("_own", F.when(F.col("lang").isin([x for x in langs if x]), F.col("lang")).otherwise(F.lit(ALL)))
    df = df.withColumn("lp", F.lit(0.0)).withColumn("done", F.lit(False))
    for k in range(ORDER, 0, -1):
        p = probs.where(F.col("k") == k).select(F.col("lang").alias("_pl"), F.col("gram").alias("_pg"), "logp")
        b = backs.where(F.col("k") == k).select(F.col("lang").alias("_bl"), F.col("context").alias("_bc"), "logb")
        low = F.col("gram").bitwiseAND(_mask(k))
        df = df.join(p, (F.col("_own") == F.col("_pl")) & (low == F.col("_pg")), "left").join(
            b, (F.col("_own") == F.col("_bl")) & (F.shiftright(low, WIDTH) == F.col("_bc")), "left")
        df = df.withColumn("lp", F.expr("IF(done, lp, lp + coalesce(logp, logb, 0D))")).withColumn("done", F.expr("done OR logp IS NOT NULL"))
        df = df.drop("_pl", "_pg", "logp", "_bl", "_bc", "logb")
    total = df.groupBy("_row").agg(F.first("doc_id").alias("doc_id"), F.first("lang").alias("lang"), F.first("n_chars").alias("n_chars"),
                                   F.sum(F.col("lp") * F.col("c")).alias("logp"))
    return total.select("doc_id", "lang", "n_chars", "logp")


def judged(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, model_rows: int = MODEL_ROWS) -> DataFrame:
    """One row per row of docs (doc_id, text, lang): doc_id, lang, n_chars, perplexity (per character, the end included),
    threshold, kept.

    Trusted are texts whose labels all say quality 1. Those with crc32(doc_id) mod 5 = 0 set the thresholds, the others train.
    Null and empty texts have no perplexity and are not kept. Without any trusted text nothing can be judged: thresholds are
    null and every text with characters is kept. A null or rare language uses the model
    and threshold of all languages, and so do languages beyond the LANGUAGES most frequent ones.
    """
    good = labels.where("quality IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("q")).where("q = 1").select("_id")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    # the same plan at every size: labels grow with the corpus, so they are not to be sent to all tasks
    trusted = docs.select("doc_id", "lang", "text").join(good.hint("merge"), F.col("doc_id") == F.col("_id")).where("text <> ''")
    sizes = trusted.groupBy("lang").agg(F.count("*").alias("n")).where(f"n >= {LEAST_TRUSTED} AND lang IS NOT NULL")
    langs = [r[0] for r in sizes.orderBy(F.desc("n")).limit(LANGUAGES).collect()]
    learn = trusted.where(fold != 0).withColumn("lang", F.when(F.col("lang").isin(langs), F.col("lang")).otherwise(F.lit("?")))
    probs, backs = model(counts(learn.select("lang", "text")))
    rows = probs.count() + backs.count()
    if not rows:
        return docs.select("doc_id", "lang", F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n_chars"),
                           F.lit(None).cast("double").alias("perplexity"), F.lit(None).cast("double").alias("threshold"),
                           F.coalesce(F.char_length("text") > 0, F.lit(False)).alias("kept"))
    scored = written((_by_broadcast if rows <= model_rows else _by_join)(docs.select("doc_id", "lang", "text"), probs, backs, langs), "scored")
    scored = scored.withColumn("perplexity", F.when(F.col("n_chars") > 0, F.exp(-F.col("logp") / (F.col("n_chars") + 1))))
    own = lambda c: F.when(c.isin(langs), c).otherwise(F.lit(ALL))
    held = scored.join(good, F.col("doc_id") == F.col("_id")).where((fold == 0) & F.col("perplexity").isNotNull())
    # every text counts, equal ones too; one without a model of its own counts for ALL once
    held = held.select(F.explode(F.array_distinct(F.array(own(F.col("lang")), F.lit(ALL)))).alias("_lang"), "perplexity")
    cuts = written(held.groupBy("_lang").agg(F.percentile_approx("perplexity", quantile, 10_000).alias("threshold")), "thresholds")
    out = scored.withColumn("_own", own(F.col("lang"))).join(cuts, F.col("_own") == F.col("_lang"), "left")
    return out.select("doc_id", "lang", "n_chars", "perplexity", "threshold",
                      ((F.col("n_chars") > 0) & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))).alias("kept"))
