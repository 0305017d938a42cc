"""Toxicity: logistic regression on hashed words with a counterfactual penalty.

Training texts come with a label. Wherever a sentence names a group (``IDENTITY_TERMS``), the term is swapped for each other
term of its family, and the loss adds ``penalty * (score(sentence) - score(swapped sentence))^2``. So weight on a group's
name, or on a word pair with it, has to pay for itself by being equal over the family, and neutral mentions of a group do
not raise the score. Features are the distinct words of a text, the beginnings of longer words (so that forms of a stem
count together) and the word pairs that hold an identity term, hashed to 2^BITS places; scoring is a sum of weights and one
pass over the texts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.words import PUNCTUATION, mixed, prefix_hashes, steps, text_bytes, word_hashes

#: fixed values: families of terms that may stand for one another in a sentence
IDENTITY_TERMS: Mapping[str, Sequence[str]] = {
    "gender": ("men", "women", "man", "woman", "boys", "girls", "transgender"),
    "religion": ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    "orientation": ("gay", "lesbian", "straight", "bisexual"),
    "origin": ("african", "asian", "european", "american", "arab", "mexican", "chinese", "indian"),
    "colour": ("black", "white", "brown"),
    "ability": ("blind", "deaf", "disabled"),
    "age": ("old", "young", "elderly"),
}
BITS = 18
#: bytes of the word beginnings
STEMS = (4, 6)
#: labelled texts of each class that the fit reads at most, and the words of each (a text beyond it is read to its end)
SAMPLE_PER_CLASS = 3000
FEATURES = 4000
_SENTENCE_END = np.zeros(256, bool)
_SENTENCE_END[[33, 46, 63, 10]] = True


def _term_hashes(terms: Mapping[str, Sequence[str]]) -> dict[int, list[int]]:
    """Hash of each term: hashes of the other terms of its family."""
    def of(word: str) -> int:
        data = np.frombuffer(word.encode(), np.uint8)
        return int(word_hashes(data, np.array([0, len(data)]), between=PUNCTUATION)[0][0])

    return {of(a): [of(b) for b in family if b != a] for family in terms.values() for a in family}


def _term_stems(terms: Mapping[str, Sequence[str]]) -> dict[int, list[int]]:
    """Hash of each term: places of its word beginnings."""
    out = {}
    for word in (a for family in terms.values() for a in family):
        data = np.frombuffer(word.encode(), np.uint8)
        starts, ends = np.array([0]), np.array([len(data)])
        found = [prefix_hashes(data, starts, ends, length)[1] for length in STEMS]
        out[int(word_hashes(data, ends[[0, 0]] * [0, 1], between=PUNCTUATION)[0][0])] = [int(x >> np.uint64(64 - BITS)) for s in found for x in s]
    return out


def _pair(a, b):
    return mixed(np.asarray(a, np.uint64) * np.uint64(3) + np.asarray(b, np.uint64))


def _features(part: pa.RecordBatch, terms: np.ndarray):
    """(place, text) pairs without repeats, and the words with their text bounds."""
    data, offsets = text_bytes(part.column(part.schema.get_field_index("text")))
    words, at, starts, ends = word_hashes(data, offsets, between=PUNCTUATION)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    named = np.isin(words, terms)
    left = np.flatnonzero((named[:-1] | named[1:]) & (owner[:-1] == owner[1:])) if len(words) > 1 else np.zeros(0, np.int64)
    found, owners = [words, _pair(words[left], words[left + 1])], [owner, owner[left]]
    for length in STEMS:
        longer, stems = prefix_hashes(data, starts, ends, length)
        found.append(stems)
        owners.append(owner[longer])
    place = np.concatenate(found) >> np.uint64(64 - BITS)
    keys = np.unique((np.concatenate(owners).astype(np.int64) << BITS) | place.astype(np.int64))
    return keys & ((1 << BITS) - 1), keys >> BITS, (words, at, starts, ends, named, data)


def _swaps(words, at, starts, ends, named, data, terms: dict[int, list[int]], stems: dict[int, list[int]], row: int):
    """For each swap in a text: places that the sentence loses and places that it gains, those of word beginnings included."""
    lost, gained = [], []
    broken = np.concatenate([[0], np.cumsum(_SENTENCE_END[data])])
    lo, hi = at[row], at[row + 1]
    place = lambda x: int(np.uint64(x) >> np.uint64(64 - BITS))
    for i in np.flatnonzero(named[lo:hi]) + lo:
        before = words[i - 1] if i > lo and broken[starts[i]] == broken[ends[i - 1]] else None
        after = words[i + 1] if i + 1 < hi and broken[starts[i + 1]] == broken[ends[i]] else None

        def around(w):
            return [place(w), *stems[int(w)]] + ([place(_pair(before, w))] if before is not None else []) + ([place(_pair(w, after))] if after is not None else [])

        for other in terms[int(words[i])]:
            lost.append(around(words[i]))
            gained.append(around(np.uint64(other)))
    return lost, gained


def sample(docs: DataFrame, labels: DataFrame, terms: Mapping[str, Sequence[str]], per_class: int):
    """At most ``per_class`` labelled texts of each class (those with the smallest hash of doc_id) as features, and the
    number of labelled texts of each class."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {int(r[0] > 0): r[1] for r in known.groupBy((F.col("toxic") > 0).cast("int")).count().collect()}
    chosen = None
    for value in (0, 1):
        part = known.where((F.col("toxic") > 0).cast("int") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").select("text", "toxic")
    table, stems = _term_hashes(terms), _term_stems(terms)

    def run(batches):
        own = np.array(sorted(table), np.uint64)
        for part in steps(batches):
            place, owner, found = _features(part, own)
            ends = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
            swaps = [_swaps(*found, table, stems, i) for i in range(part.num_rows)]
            kind = pa.list_(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [part.column(1).cast(pa.int32()), pa.ListArray.from_arrays(pa.array(ends), pa.array(place, pa.int32())),
                 pa.array([s[0] for s in swaps], kind), pa.array([s[1] for s in swaps], kind)], names=["toxic", "places", "lost", "gained"])

    return rows.mapInArrow(run, "toxic int, places array<int>, lost array<array<int>>, gained array<array<int>>").collect(), counts


def fit(docs: DataFrame, labels: DataFrame, terms: Mapping[str, Sequence[str]] = IDENTITY_TERMS, per_class: int = SAMPLE_PER_CLASS,
        penalty: float = 1.0, ridge: float = 1e-3, rounds: int = 300) -> tuple[np.ndarray, float]:
    """(weights, intercept). The fit sees at most 2 x per_class texts and keeps the FEATURES places whose presence differs
    most between the classes; the intercept is set to the share of toxic texts among all labels given. Without labels of both
    classes all weights are 0 and the intercept is the share (or -1 without any label)."""
    rows, counts = sample(docs, labels, terms, per_class)
    weights = np.zeros(1 << BITS)
    total = sum(counts.values())
    share = (counts.get(1, 0) + 0.5) / (total + 1) if total else 1 / (1 + np.e)
    y = np.array([r[0] > 0 for r in rows], float)
    if not len(y) or y.min() == y.max():
        return weights, float(np.log(share / (1 - share)))
    doc = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    place = np.concatenate([np.asarray(r[1], np.int64) for r in rows])
    # places by the two-proportion z value of their presence
    n1, n0 = y.sum(), (1 - y).sum()
    in1 = np.bincount(place, y[doc], 1 << BITS)
    in0 = np.bincount(place, 1 - y[doc], 1 << BITS)
    rate = (in1 + in0) / len(y)
    z = np.abs(in1 / n1 - in0 / n0) / np.sqrt(rate * (1 - rate) * (1 / n1 + 1 / n0) + 1e-9)
    z[in1 + in0 < 3] = 0
    kept = np.sort(np.argsort(-z, kind="stable")[:FEATURES])
    kept = kept[z[kept] > 4]
    column = np.full(1 << BITS, -1)
    column[kept] = np.arange(len(kept))
    use = column[place] >= 0
    doc, col = doc[use], column[place[use]]
    swap, side, scol = [], [], []
    for r in rows:
        for lost, gained in zip(r[2], r[3]):
            number = swap[-1] + 1 if swap else 0
            for places, sign in ((lost, -1.0), (gained, 1.0)):
                swap += [number] * len(places)
                side += [sign] * len(places)
                scol += [int(column[p]) for p in places]
    swap, side, scol = np.array(swap, np.int64), np.array(side), np.array(scol, np.int64)
    live = scol >= 0
    n_swaps = int(swap.max()) + 1 if len(swap) else 0
    swap, side, scol = swap[live], side[live], scol[live]
    w, b, m, v = np.zeros(len(kept)), 0.0, np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(doc, w[col], len(y)) + b, -30, 30)))
        err = (p - y) / len(y)
        g = np.append(np.bincount(col, err[doc], len(kept)) + ridge * w, err.sum())
        if n_swaps:
            change = np.bincount(swap, side * w[scol], n_swaps)
            g[:-1] += penalty * 2 / n_swaps * np.bincount(scol, side * change[swap], len(kept))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    weights[kept] = w
    drawn = y.mean()
    return weights, float(b + np.log(share / (1 - share)) - np.log(drawn / (1 - drawn)))


def scores(docs: DataFrame, model: tuple[np.ndarray, float], terms: Mapping[str, Sequence[str]] = IDENTITY_TERMS) -> DataFrame:
    """doc_id and score of every row of docs. Null and empty texts get the intercept's score."""
    given = docs.sparkSession.sparkContext.broadcast((model[0].astype(np.float32), model[1]))  # 1 MB
    own = np.array(sorted(_term_hashes(terms)), np.uint64)

    def run(batches):
        weights, intercept = given.value
        for part in steps(batches):
            place, owner, _ = _features(part, own)
            total = np.bincount(owner, weights[place].astype(float), part.num_rows) + intercept
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(1 / (1 + np.exp(-np.clip(total, -30, 30))))],
                                             names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
