"""Quality rules with risk-controlled thresholds (DataFrame functions only).

Each rule is a share of a text (symbols, repeated lines, repeated words, capitals) and rejects above a cut-off. On the
labelled good texts of a stratum (language) the number of false rejections at a cut-off is binomial. Going from the loosest
cut-off to the strictest, a cut-off is accepted while the exact binomial test rejects "more than ``risk / rules`` of the good
texts are lost" at level ``level / (rules x strata)``: Bonferroni over rules and strata, fixed-sequence testing along the
cut-offs (the first cut-off that fails ends its sequence). With probability 1 - level, no stratum loses more than ``risk``
of its good texts. A stratum with too few labels gets no cut-offs, so it rejects nothing by these rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from loanloom.llm.common import BLANKS, blank_words, written

RISK, LEVEL = 0.02, 0.05
#: cut-offs in thousandths, loosest first
CUTS = [900, 800, 700, 600, 500, 400, 350, 300, 250, 200, 170, 140, 120, 100, 80, 60, 50, 40, 30, 20, 10, 5]
#: rule: (numerator, denominator)
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "capitals": ("n_capitals", "word_chars"),
}


def features(docs: DataFrame) -> DataFrame:
    """doc_id, lang and the counts of every row of docs (doc_id, text, lang). A null text counts as empty: all zero.

    n_words, word_chars (code points in words), n_symbols (characters of ``#*$%&|<>``), n_lines (lines with a word),
    n_dup_lines (those equal to an earlier line), n_repeat_words (words in 3-word windows that occur twice or more),
    n_capitals (A-Z).
    """
    df = docs.select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))
    df = df.withColumn("w", blank_words(F.col("text"))).withColumn(
        "lines", F.filter(F.split("text", "\n"), lambda x: F.trim(x, F.lit(BLANKS)) != ""))
    df = df.withColumn("n", F.size("w"))
    # windows carry their place in the low part of a pair, so that sorting brings equal windows together
    df = df.withColumn("t", F.expr("IF(n < 3, array(), transform(sequence(0, greatest(n, 3) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])))"))
    df = df.withColumn("s", F.expr(
        "IF(size(t) = size(array_distinct(t)), array(), sort_array(transform(t, (x, i) -> struct(x AS x, i AS i))))"))
    df = df.withColumn("p", F.expr(
        "sort_array(transform(filter(s, (a, j) -> coalesce(a.x = get(s, j - 1).x, false) OR coalesce(a.x = get(s, j + 1).x, false)), a -> a.i))"))
    return df.select(
        "doc_id", "lang", F.col("n").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("aggregate(transform(p, (x, j) -> least(3, coalesce(get(p, j + 1) - x, 3))), 0L, (a, b) -> a + b)").alias("n_repeat_words"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_capitals"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _level(rule: str) -> Column:
    """Number of cut-offs that the rule's share lies above; 0 where the text has no words."""
    part, whole = RULES[rule]
    over = [F.when(1000 * F.col(part) > cut * F.col(whole), 1).otherwise(0) for cut in CUTS]
    total = over[0]
    for x in over[1:]:
        total = total + x
    return total


def _ln_factorial(x: str) -> str:
    """Exact up to 20, beyond it Stirling's series (error below 1e-15)."""
    return (f"IF({x} <= 20, ln(factorial(CAST(least({x}, 20) AS INT))), "
            f"({x} + 0.5D) * ln({x}) - {x} + 0.918938533204672742D + 1D / (12D * {x}) - 1D / (360D * pow({x}, 3)) + 1D / (1260D * pow({x}, 5)))")


def binomial_tail(k: str, n: str, p: str) -> str:
    """SQL for P(Binomial(n, p) <= k). The sum runs downwards from k; where k is at or above the mean the answer is 1 (the
    test fails there in any case). Below the mean terms shrink, and after 40 standard deviations they are below 1e-300."""
    log_k = (f"({_ln_factorial(n)}) - ({_ln_factorial(k)}) - ({_ln_factorial(f'({n} - {k})')}) + {k} * ln({p}) + ({n} - {k}) * ln(1 - {p})")
    steps = f"CAST(least({k}, ceil(40 * sqrt({n} * {p})) + 40) AS INT)"
    terms = (f"aggregate(sequence(0, {steps}), named_struct('term', 1D, 'sum', 0D), (a, i) -> named_struct("
             f"'term', a.term * ({k} - i) / ({n} - {k} + i + 1) * (1 - {p}) / {p}, 'sum', a.sum + a.term), a -> a.sum)")
    return f"IF({k} >= {n} * {p}, 1D, exp({log_k}) * {terms})"


def thresholds(feats: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """(lang, rule, cut, n_good, n_lost, p_value): the strictest accepted cut-off, in thousandths, of each stratum and rule.

    ``labels`` has doc_id and quality; a text is good if all its labels say 1 (null labels are ignored). Good texts that
    fail the base rules are lost anyway and are not counted. A null language is a stratum of its own.
    """
    good = labels.where("quality IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("q")).where("q = 1")
    held = feats.where(~base_failed()).join(good, F.col("doc_id") == F.col("_id"))
    rows = held.select("lang", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), _level(r).alias("lvl")) for r in RULES])).alias("r"))
    # at most (cut-offs + 1) rows a stratum and rule leave here; the rest is arithmetic on that small table
    counts = rows.groupBy("lang", "r.rule", "r.lvl").agg(F.count("*").alias("c"))
    per = Window.partitionBy("lang", "rule")
    grid = counts.groupBy("lang", "rule").agg(F.map_from_entries(F.collect_list(F.struct("lvl", "c"))).alias("by"), F.sum("c").alias("n_good"))
    steps = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(c).alias("cut")) for i, c in enumerate(CUTS)])
    grid = grid.select("lang", "rule", "n_good", "by", F.inline(steps)).withColumn("n_lost", F.expr(
        "aggregate(map_values(map_filter(by, (l, c) -> l >= step)), 0L, (a, b) -> a + b)")).drop("by")
    strata = feats.select("lang").distinct().count()
    p = f"{risk / len(RULES)!r}D"
    tests = grid.withColumn("p_value", F.expr(binomial_tail("n_lost", "n_good", p)))
    tests = tests.withColumn("failed", F.max((F.col("p_value") > level / (len(RULES) * max(1, strata))).cast("int")).over(
        per.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)))
    best = tests.where("failed = 0").groupBy("lang", "rule").agg(F.max_by(F.struct("cut", "n_good", "n_lost", "p_value"), "step").alias("b"))
    return best.select("lang", "rule", "b.*")


def judged(docs: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """``features`` of every row plus base_failed, ``broken`` (names of the rules it breaks) and kept."""
    feats = written(features(docs), "features")
    cuts = written(thresholds(feats, labels, risk, level), "cuts")
    wide = cuts.groupBy(F.col("lang").alias("_lang")).agg(*[F.max(F.when(F.col("rule") == r, F.col("cut"))).alias(f"cut_{r}") for r in RULES])
    out = feats.join(wide, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    broken = F.filter(F.array(*[F.when(1000 * F.col(a) > F.col(f"cut_{r}") * F.col(b), F.lit(r)) for r, (a, b) in RULES.items()]), lambda x: x.isNotNull())
    out = out.withColumn("base_failed", base_failed()).withColumn("broken", broken)
    return out.select(*feats.columns, "base_failed", "broken", (~F.col("base_failed") & (F.size("broken") == 0)).alias("kept"))
