"""Edit-aware token counts: a segment tree of token counts per document.

The pre-tokeniser's pattern starts a new pre-token at every space before a non-space, whatever stands around it. A text is cut at
such places into leaves of about LEAF characters; they encode independently, and the token count of the text is the sum over them.
The tree over the leaves is a heap array: node i has the children 2i and 2i + 1, node 1 is the root, leaf k stands at ``width + k``. An edit re-encodes the leaves it touches plus one leaf to the right if the edit reaches a leaf's end,
or one to the left if it changes a leaf's first characters, and then only the sums on the way to the root change.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.words import steps

LEAF = 256
#: a space before a character that is certainly no white space
_SAFE = re.compile(r" (?=[!-~\u00c0-\u07ff])")
_encoders: dict[str, object] = {}


def encoder(ranks: bytes, pattern: str):
    """The byte-level BPE encoder of a rank file, made once per process."""
    import tiktoken

    key = f"{len(ranks)}:{hash(ranks)}:{pattern}"
    if key not in _encoders:
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        _encoders[key] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return _encoders[key]


def cut(text: str, leaf: int = LEAF) -> list[str]:
    """Leaves of a text: each runs to the first safe place after ``leaf`` characters. A stretch without one is one leaf, however
    long; an empty text has none."""
    out, at = [], 0
    while len(text) - at > leaf:
        found = _SAFE.search(text, at + leaf)
        if not found:
            break
        out.append(text[at:found.start()])
        at = found.start()
    if at < len(text):
        out.append(text[at:])
    return out


def leaves(text: str, counts, leaf: int = LEAF) -> tuple[list[int], list[int]]:
    """(characters, tokens) of the leaves of a text; ``counts`` gives the numbers of tokens of a list of strings."""
    parts = cut(text, leaf)
    return [len(p) for p in parts], counts(parts)


def tree_of(counts: list[int]) -> list[int]:
    """Heap array of sums; [0, 0] for no leaves."""
    width = 1
    while width < len(counts):
        width *= 2
    tree = np.zeros(2 * width, np.int64)
    tree[width:width + len(counts)] = counts
    while width > 1:
        width //= 2
        tree[width:2 * width] = tree[2 * width:4 * width:2] + tree[2 * width + 1:4 * width:2]
    return tree.tolist()


def set_leaf(tree: list[int], leaf: int, count: int) -> None:
    """Change one leaf and the sums above it."""
    i = len(tree) // 2 + leaf
    change = count - tree[i]
    while i and change:
        tree[i] += change
        i //= 2


def _touched(lengths: list[int], start: int, stop: int) -> tuple[int, int, int]:
    """First and last leaf that an edit of [start, stop) touches with their context, and where the first begins."""
    ends = np.cumsum(lengths)
    a = min(int(np.searchsorted(ends, start, "right")), len(lengths) - 1)
    b = min(int(np.searchsorted(ends, stop, "left")), len(lengths) - 1)
    # a leaf's first two characters make its left side a safe place, and its last one does so for the next leaf
    if a and start < ends[a - 1] + 2:
        a -= 1
    b = max(a, b)
    if b + 1 < len(lengths) and stop >= ends[b] - 1:
        b += 1
    return a, b, int(ends[a] - lengths[a])


def edit(text: str, lengths: list[int], tree: list[int], start: int, removed: int, inserted: str, counts, leaf: int = LEAF):
    """(new text, leaf lengths, tree, characters encoded again) after replacing ``removed`` characters at ``start``.

    ``counts`` gives the numbers of tokens of a list of strings. If the number of leaves stays the same only the touched paths
    of the tree change, else the tree is laid out anew from the leaf counts it holds (nothing else is encoded)."""
    start = min(max(start, 0), len(text))
    stop = min(len(text), start + max(removed, 0))
    new = text[:start] + inserted + text[stop:]
    if not lengths:
        size, fresh = leaves(new, counts, leaf)
        return new, size, tree_of(fresh), len(new)
    a, b, begin = _touched(lengths, start, stop)
    touched = sum(lengths[a:b + 1]) + len(inserted) - (stop - start)
    size, fresh = leaves(new[begin:begin + touched], counts, leaf)
    if len(size) == b - a + 1:
        for k, c in enumerate(fresh):
            set_leaf(tree, a + k, c)
    else:
        width = len(tree) // 2
        tree = tree_of(tree[width:width + a] + fresh + tree[width + b + 1:width + len(lengths)])
    return new, lengths[:a] + size + lengths[b + 1:], tree, touched


def counter(ranks: bytes, pattern: str):
    """Function from a list of strings to their numbers of tokens. (A batch call of the encoder would start threads each time.)"""
    encode = encoder(ranks, pattern).encode_ordinary
    return lambda parts: [len(encode(p)) for p in parts]


def trees(docs: DataFrame, ranks: bytes, pattern: str, leaf: int = LEAF) -> DataFrame:
    """doc_id, n_tokens, lengths (characters of the leaves), tree, for every row of docs. Null texts count as empty."""
    def run(batches):
        counts = counter(ranks, pattern)
        for part in steps(batches):
            found = [leaves(t or "", counts, leaf) for t in part.column(1).to_pylist()]
            made = [tree_of(tokens) for _, tokens in found]
            yield pa.RecordBatch.from_arrays(
                [part.column(0).cast(pa.int64()), pa.array([t[1] for t in made], pa.int64()),
                 pa.array([x for x, _ in found], pa.list_(pa.int32())), pa.array(made, pa.list_(pa.int32()))],
                names=["doc_id", "n_tokens", "lengths", "tree"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, lengths array<int>, tree array<int>")


def updated(held: DataFrame, ranks: bytes, pattern: str, leaf: int = LEAF) -> DataFrame:
    """Apply edits. ``held`` has doc_id, text, lengths, tree (from ``trees``; null: not counted yet, the text is counted first)
    and edits, an array of (start, removed, inserted) in the order of application (null: none).

    Returns doc_id, text, lengths, tree, n_before, n_tokens, n_encoded (characters encoded again), one row per row."""
    def run(batches):
        counts = counter(ranks, pattern)
        for part in steps(batches):
            out = []
            for row in part.to_pylist():
                text, lengths, tree = row["text"] or "", row["lengths"], row["tree"]
                if lengths is None or tree is None:
                    lengths, tokens = leaves(text, counts, leaf)
                    tree = tree_of(tokens)
                before, encoded = tree[1], 0
                for e in row["edits"] or []:
                    text, lengths, tree, n = edit(text, lengths, tree, e["start"], e["removed"], e["inserted"] or "", counts, leaf)
                    encoded += n
                out.append((row["doc_id"], text, lengths, tree, before, tree[1], encoded))
            kinds = [pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "text", "lengths", "tree", "n_before", "n_tokens", "n_encoded"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)

    kind = "doc_id long, text string, lengths array<int>, tree array<int>, n_before long, n_tokens long, n_encoded long"
    return held.select("doc_id", "text", "lengths", "tree", "edits").mapInArrow(run, kind)


def derived_edits() -> "F.Column":
    """Three edits per text that follow from the row alone, for the registered query: a replacement, a deletion and an
    insertion, at places given by hashes of doc_id, the inserted string being a stretch of the text itself."""
    n = "greatest(char_length(coalesce(text, '')), 1)"
    at = lambda k: f"CAST(pmod(xxhash64(doc_id, {k}), {n}) AS INT)"
    stretch = lambda k: f"substr(coalesce(text, ''), {at(k)} + 1, 1 + CAST(pmod(xxhash64(doc_id, {k + 10}), 40) AS INT))"
    return F.expr(
        f"array(named_struct('start', {at(1)}, 'removed', 12, 'inserted', {stretch(2)}), "
        f"named_struct('start', {at(3)}, 'removed', 1 + CAST(pmod(xxhash64(doc_id, 5), 30) AS INT), 'inserted', ''), "
        f"named_struct('start', {at(4)}, 'removed', 0, 'inserted', {stretch(6)}))")
