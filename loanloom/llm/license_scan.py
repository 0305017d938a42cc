"""Fuzzy search for short licence notices: exact seeds, then bounded-error matching.

A notice of m bytes that occurs with at most k edits keeps at least one of its k + 1 pieces unchanged (pigeonhole). One
Aho-Corasick pass over a text finds all pieces of all notices; a piece that ends at byte e and starts at offset o of its notice can
only belong to an occurrence that starts within k bytes of its own start less o. These candidate windows are merged, so that a byte
is verified once per notice however often it is covered, and the ``regex`` library matches the notice with at most k errors in
them. Occurrences without an edit are the places of the notice; the others are reported with their number of edits.

Texts are compared as words: A-Z become lower case, every run of ASCII characters that are neither digits nor letters becomes
one space, and an occurrence starts and ends with whole words. Edits are counted in UTF-8 bytes (insert, delete, replace), spaces
between words included, so "gpl notice" may also match "gplnotice".

Every text is searched whole and by itself: one pass, no shuffle, no state between rows. Defined cases: null and empty texts
and texts without words have no place and score 0; a very long text is one row of its own step; repeated rows and ids give a row
each; other columns of the input are not read. Equal spans of different notices are all reported.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.words import steps

# The base phrases with their labels; each occurrence without an edit is a place.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Further notices (phrase, label, most edits); the base phrases are among them with the edits allowed to them.
NOTICES = [
    ("gnu general public license", "gpl", 3),
    ("apache license", "apache", 1),
    ("cc by", "cc-by", 0),
    ("mit license", "mit", 1),
    ("gnu lesser general public license", "lgpl", 3),
    ("gnu affero general public license", "agpl", 3),
    ("mozilla public license", "mpl", 2),
    ("creative commons attribution", "cc-by", 3),
    ("creative commons zero", "cc0", 2),
    ("bsd 3 clause license", "bsd", 2),
    ("redistribution and use in source and binary forms", "bsd", 4),
    ("permission is hereby granted free of charge", "mit", 4),
    ("licensed under the apache license version 2 0", "apache", 4),
    ("all rights reserved", "proprietary", 2),
    ("spdx license identifier", "spdx", 2),
    ("released into the public domain", "public-domain", 3),
]

_FOLD = bytes(ord(" ") if i < 128 and not chr(i).isalnum() else i + 32 if 65 <= i <= 90 else i for i in range(256))

PLACE = "struct<label: string, phrase: string, first_word: bigint, n_words: bigint, edits: int, found: string>"
SCHEMA = f"doc_id bigint, n_words bigint, places array<{PLACE}>"


def folded(text: bytes) -> tuple[str, int]:
    """(words joined and surrounded by single spaces, one character a byte; number of words)."""
    words = text.translate(_FOLD).split(b" ") if text else []
    words = [w for w in words if w]
    return (b" " + b" ".join(words) + b" ").decode("latin-1"), len(words)


def pieces(length: int, edits: int) -> list[tuple[int, int]]:
    """(start, end) of the edits + 1 pieces, as equal as can be."""
    cuts = [length * i // (edits + 1) for i in range(edits + 2)]
    return list(zip(cuts, cuts[1:]))


class Scanner:
    """The automaton of all pieces and the compiled notices."""

    def __init__(self, notices: tuple[tuple[str, str, int], ...]):
        self.notices, self.seeds = notices, ahocorasick.Automaton()
        found: dict[str, list[tuple[int, int]]] = {}
        for i, (phrase, _, edits) in enumerate(notices):
            if len(phrase) <= edits or folded(phrase.encode())[0][1:-1] != phrase:
                raise ValueError(f"a notice is words between single spaces, longer than its edits: {phrase!r}")
            for a, b in pieces(len(phrase), edits):
                found.setdefault(phrase[a:b], []).append((i, a))
        for piece, owners in found.items():
            self.seeds.add_word(piece, (len(piece), owners))
        self.seeds.make_automaton()
        # whole words on both sides
        self.fuzzy = [[regex.compile(rf"(?<= )(?:{regex.escape(p, literal_spaces=True)}){{e<={k}}}(?= )") for k in range(edits + 1)]
                      for p, _, edits in notices]

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """Merged candidate ranges (the spaces around included) of each notice that has a seed in the text."""
        out: dict[int, list[list[int]]] = {}
        for end, (size, owners) in self.seeds.iter(text):
            start = end + 1 - size
            for i, offset in owners:
                phrase, _, edits = self.notices[i]
                low = max(0, start - offset - edits - 1)
                high = min(len(text), start - offset + len(phrase) + edits + 1)
                ranges = out.setdefault(i, [])
                # seeds come by their ends and differ in size and offset: a range may start before the last one
                while ranges and low <= ranges[-1][1]:
                    low, high = min(low, ranges[-1][0]), max(high, ranges[-1][1])
                    ranges.pop()
                ranges.append([low, high])
        return out

    def verified(self, text: str, i: int, low: int, high: int) -> Iterator[tuple[int, int, int]]:
        """(start, end, edits) of the notice in text[low:high]: all places without an edit, then, in what lies between them,
        matches of 1, 2, ... edits, so that a close match is never hidden by a worse one that starts before it."""
        phrase, _, edits = self.notices[i]
        free = [(low, high)]
        for k in range(edits + 1):
            left: list[tuple[int, int]] = []
            for a, b in free:
                at = a
                while True:
                    if k:
                        m = self.fuzzy[i][k].search(text, at, b)
                        start, end = m.span() if m else (-1, -1)
                    else:
                        start = text.find(f" {phrase} ", at, b) + 1 or -1
                        end = start + len(phrase)
                    if start < 0:
                        break
                    yield start, end, k
                    left.append((at, start))
                    at = end  # the space that ends a place may start the next
                left.append((at, b))
            free = [(a, b) for a, b in left if b - a > len(phrase) - edits]

    def places(self, text: bytes) -> tuple[int, list[tuple[str, str, int, int, int, str]]]:
        """(number of words, places by first word: label, phrase, first word, words, edits, text found)."""
        joined, n = folded(text)
        candidates, out = self.windows(joined), []
        if candidates:
            spaces = np.flatnonzero(np.frombuffer(joined.encode("latin-1"), np.uint8) == 32)
            for i, ranges in candidates.items():
                phrase, label, _ = self.notices[i]
                for low, high in ranges:
                    for start, end, edits in self.verified(joined, i, low, high):
                        first, last = np.searchsorted(spaces, [start, end])
                        found = joined[start:end].encode("latin-1").decode("utf-8", "replace")
                        out.append((int(first) - 1, int(last - first) + 1, phrase, label, edits, found))
        return n, [(label, phrase, first, words, edits, found) for first, words, phrase, label, edits, found in sorted(out)]


@lru_cache(maxsize=4)
def scanner(notices: tuple[tuple[str, str, int], ...]) -> Scanner:
    return Scanner(notices)


def notices_found(docs: DataFrame, notices: list[tuple[str, str, int]] = NOTICES) -> DataFrame:
    """doc_id, n_words and the places of all notices, by first word, of every row of docs (doc_id, text)."""
    fixed = tuple(notices)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = scanner(fixed).places
        kind = pa.list_(pa.struct([("label", pa.string()), ("phrase", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()),
                                   ("edits", pa.int32()), ("found", pa.string())]))
        names = [kind.value_type.field(j).name for j in range(6)]
        for batch in steps(batches):
            texts = batch.column(1).cast(pa.large_binary())
            counts, places = [], []
            for text in texts:
                n, found = find(text.as_py() or b"")
                counts.append(n)
                places.append([dict(zip(names, p)) for p in found])
            yield pa.record_batch([batch.column(0).cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(places, kind)],
                                  ["doc_id", "n_words", "places"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(scan, SCHEMA)


def labelled(docs: DataFrame, notices: list[tuple[str, str, int]] = NOTICES, base: dict[str, str] = BASE) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_base, first_word, last_word (of the base places), base_labels, labels, score, places.

    A base place is an occurrence of a base phrase without an edit. score: the largest 1 - edits / bytes of the phrase, 0 without
    a place.
    """
    out = notices_found(docs, notices)
    phrases = ", ".join(f"'{p}'" for p in base)
    starts = F.expr(f"transform(filter(places, p -> p.edits = 0 AND p.phrase IN ({phrases})), p -> p.first_word)")

    def joined(places: str) -> str:
        return f"array_join(array_sort(array_distinct(transform({places}, p -> p.label))), ',')"

    return out.withColumn("s", starts).select(
        "doc_id", "n_words", F.size("s").cast("long").alias("n_base"), F.array_min("s").alias("first_word"), F.array_max("s").alias("last_word"),
        F.expr(joined(f"filter(places, p -> p.edits = 0 AND p.phrase IN ({phrases}))")).alias("base_labels"),
        F.expr(joined("places")).alias("labels"),
        F.expr("coalesce(array_max(transform(places, p -> 1D - p.edits / CAST(octet_length(p.phrase) AS DOUBLE))), 0D)").alias("score"),
        "places")
