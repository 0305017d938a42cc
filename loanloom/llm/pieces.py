"""SentencePiece encoding (BPE with byte fallback) by suffix-array matching, and decoding.

White space splits a text into segments (a run of spaces and the non-spaces after it) that encode independently, because no
piece has a space after another character. The distinct segments of a batch are joined into one string; its suffixes are
sorted; a binary search finds the range of suffixes that begin with each piece, hence all places where the piece occurs.
These occurrences are edges of a graph over the string's positions. Sorted by end position they are relaxed from left to
right: an edge extends the encoding of the prefix before it if its piece may stand after that prefix's last piece, that is,
if the two pieces joined encode to themselves. In BPE each prefix has exactly one encoding and neighbouring pieces that are
stable in pairs are stable together, so the result is the encoding of the merge procedure. Pair tests are kept per process, up to
a fixed number.

Characters outside the vocabulary become their bytes' pieces. The texts' first segment gets the model's leading space.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType

from loanloom.llm.words import mixed, powers, steps, text_bytes, _BYTE_CODES

SPACE = "▁"
BATCH_BYTES = 1 << 20
#: pair tests kept by a process, 8 bytes each, and those kept in a dict meanwhile
KNOWN_PAIRS, RECENT_PAIRS = 4_000_000, 50_000
_models: dict[bytes, "Pieces"] = {}


class Pieces:
    """The vocabulary: pieces as bytes with a plain space for the space mark, scores, and the kept pair tests."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.bytes_of = np.full(256, sp.unk_id(), np.int32)
        self.raw: list[bytes] = []
        plain = []
        for i in range(n):
            name = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(name[3:5], 16)
                self.bytes_of[value] = i
                self.raw.append(bytes([value]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.raw.append(b"")
            else:
                self.raw.append(name.replace(SPACE, " ").encode())
                plain.append(i)
        self.text = [r.decode("utf-8", "replace") for r in self.raw]
        self.score = {self.text[i]: sp.get_score(i) for i in plain}
        # a piece that its own characters do not merge to never stands in an encoding
        plain = [i for i in plain if len(self.text[i]) == 1 or self.merged(self.text[i]) == [self.text[i]]]
        plain.sort(key=lambda i: self.raw[i])
        self.ids = np.array(plain, np.int64)
        self.length = np.array([len(r) for r in self.raw], np.int64)
        self.words = -(-max((len(self.raw[i]) for i in plain), default=1) // 8)
        pad = lambda fill: np.array([[int.from_bytes(self.raw[i].ljust(8 * self.words, fill)[8 * j:8 * j + 8], "big") for i in plain]
                                     for j in range(self.words)], np.uint64).reshape(self.words, -1)
        self.low, self.high = pad(b"\x00"), pad(b"\xff")
        self.size = n
        # kept pair tests: the latest in a dict, all others as sorted numbers 2 x pair + result
        self.recent: dict[int, bool] = {}
        self.known = np.zeros(0, np.int64)
        starts = np.concatenate([[0], np.cumsum(self.length)])
        self.flat, self.flat_at = np.frombuffer(b"".join(self.raw), np.uint8), starts[:-1]

    def merged(self, text: str) -> list[str]:
        """The merge procedure on a short string: join the neighbours of best score, leftmost first, while there are any."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_follow(self, codes: np.ndarray) -> np.ndarray:
        """For codes left * size + right: whether the two pieces, joined, encode to themselves."""
        at = np.searchsorted(self.known, codes * 2)
        near = self.known[np.minimum(at, len(self.known) - 1)] if len(self.known) else np.full(len(codes), -1)
        out = (near & 1).astype(bool)
        recent = self.recent
        for i in np.flatnonzero(near >> 1 != codes).tolist():
            code = int(codes[i])
            ok = recent.get(code)
            if ok is None:
                a, b = self.text[code // self.size], self.text[code % self.size]
                ok = recent[code] = self.merged(a + b) == [a, b]
            out[i] = ok
        return out

    def pack(self) -> None:
        """Between batches: the dict joins the sorted numbers; beyond KNOWN_PAIRS of them the tests start anew."""
        if len(self.recent) > RECENT_PAIRS:
            fresh = np.fromiter((2 * c + ok for c, ok in self.recent.items()), np.int64, len(self.recent))
            self.known = np.sort(np.concatenate([self.known, fresh])) if len(self.known) < KNOWN_PAIRS else np.sort(fresh)
            self.recent = {}


def pieces_of(model: bytes) -> Pieces:
    if model not in _models:
        _models[model] = Pieces(model)
    return _models[model]


def sorted_suffixes(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix starts in the order of their first ``depth`` x 8 bytes, big-endian words at every position). Data ends in at
    least 8 x depth zeros, whose suffixes are left out."""
    n = len(data) - 8 * depth
    word = np.zeros(len(data), np.uint64)
    for j in range(8):
        word[:len(data) - j] |= data[j:].astype(np.uint64) << np.uint64(56 - 8 * j)
    order = np.argsort(word[:n], kind="stable")
    group = np.concatenate([[0], np.cumsum(word[order][1:] != word[order][:-1])]) if n else np.zeros(0, np.int64)
    for d in range(1, depth):
        tied = np.concatenate([[False], group[1:] == group[:-1]]) if n else np.zeros(0, bool)
        tied[:-1] |= tied[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        nxt = word[order[at] + 8 * d]
        again = np.lexsort((nxt, group[at]))
        order[at] = order[at][again]
        nxt = nxt[again]
        step = np.zeros(n, bool)
        step[1:] = group[1:] != group[:-1]
        inner = np.concatenate([[False], nxt[1:] != nxt[:-1]])
        step[at] |= inner
        group = np.cumsum(step)
    return order, word


def _ranges(order: np.ndarray, word: np.ndarray, keys: np.ndarray, upper: bool) -> np.ndarray:
    """For each column of ``keys`` (words of a padded piece) the number of suffixes below it (``upper``: at most it)."""
    n = keys.shape[1]
    lo, hi = np.zeros(n, np.int64), np.full(n, len(order), np.int64)
    while True:
        live = np.flatnonzero(lo < hi)
        if not len(live):
            return lo
        mid = (lo[live] + hi[live]) // 2
        at = order[mid]
        below, equal = np.zeros(len(live), bool), np.arange(len(live))
        for j in range(len(keys)):
            mine, theirs = word[at[equal] + 8 * j], keys[j, live[equal]]
            below[equal[mine < theirs]] = True
            equal = equal[mine == theirs]
            if not len(equal):
                break
        if upper:
            below[equal] = True
        lo[live[below]] = mid[below] + 1
        hi[live[~below]] = mid[~below]


def _segments(data: np.ndarray, offsets: np.ndarray):
    """Bytes with the leading space of non-empty texts and literal space marks as spaces; segment starts; segments per text."""
    raw = data.tobytes()
    n = len(offsets) - 1
    mark = SPACE.encode()
    if mark in raw:
        texts = [raw[a:b].replace(mark, b" ") for a, b in zip(offsets[:-1], offsets[1:])]
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    full = np.diff(offsets) > 0
    starts = offsets + np.concatenate([[0], np.cumsum(full)])
    out = np.full(int(starts[-1]), 32, np.uint8)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    out[np.arange(len(data)) + (np.cumsum(full))[owner]] = data
    first = np.zeros(len(out), bool)
    if len(out):
        space = out == 32
        first[1:] = space[1:] & ~space[:-1]
        first[starts[:-1][full]] = True
    at = np.flatnonzero(first)
    return out, at, np.searchsorted(at, starts)


def _encode_distinct(text: np.ndarray, begin: np.ndarray, length: np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """(ids, bounds) of the segments ``text[begin : begin + length]``."""
    gap = 8 * p.words
    at = np.concatenate([[0], np.cumsum(length + 1)])
    joined = np.zeros(int(at[-1]) + gap, np.uint8)
    owner = np.repeat(np.arange(len(length)), length)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length)
    joined[at[owner] + inside] = text[begin[owner] + inside]
    order, word = sorted_suffixes(joined, p.words)
    lo, hi = _ranges(order, word, p.low, False), _ranges(order, word, p.high, True)
    found = hi - lo
    start = order[np.repeat(lo - (np.cumsum(found) - found), found) + np.arange(int(found.sum()))]
    piece = np.repeat(p.ids, found)
    # characters without a piece: an edge of their own, number p.size
    heads = np.flatnonzero((joined[:at[-1]] & 0xC0) != 0x80)
    is_segment = np.ones(int(at[-1]) + 1, bool)
    is_segment[at[1:] - 1] = False
    heads = heads[is_segment[heads]]
    lead = joined[heads]
    width = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
    single = np.zeros(int(at[-1]) + 1, bool)
    ends = start + p.length[piece]
    chars = np.zeros(int(at[-1]) + 1, np.int64)
    chars[heads] = width
    single[start[p.length[piece] == chars[start]]] = True
    rare = ~single[heads]
    start = np.concatenate([start, heads[rare]])
    ends = np.concatenate([ends, heads[rare] + width[rare]])
    piece = np.concatenate([piece, np.full(int(rare.sum()), p.size)])
    # by end position within the segment, so that all segments advance together
    seg_of = np.repeat(np.arange(len(length)), length + 1)
    column = ends - at[seg_of[start]]
    by = np.argsort(column, kind="stable")
    start, ends, piece, column = start[by], ends[by], piece[by], column[by]
    last = np.full(int(at[-1]) + 1, -1, np.int64)
    origin = np.zeros(int(at[-1]) + 1, np.int64)
    edge = np.zeros(int(at[-1]) + 1, bool)
    edge[at[:-1]] = True
    cuts = np.concatenate([[0], np.flatnonzero(column[1:] != column[:-1]) + 1, [len(column)]]) if len(column) else np.zeros(1, np.int64)
    for a, b in zip(cuts[:-1], cuts[1:]):
        s, t = start[a:b], piece[a:b]
        before = last[s]
        free = edge[s] | (before == p.size) | ((t == p.size) & (before >= 0))
        ask = np.flatnonzero(~free & (before >= 0))
        if len(ask):
            codes, back = np.unique(before[ask] * p.size + t[ask], return_inverse=True)
            free[ask] = p.may_follow(codes)[back]
        go = np.flatnonzero(free)
        last[ends[a:b][go]] = t[go]
        origin[ends[a:b][go]] = s[go]
    # back from the ends
    node, rows = at[1:] - 1, np.arange(len(length))
    taken, owners, froms = [], [], []
    while len(rows):
        taken.append(last[node])
        froms.append(origin[node])
        owners.append(rows)
        node = origin[node]
        more = node > at[rows]
        node, rows = node[more], rows[more]
    if not taken:
        return np.zeros(0, np.int32), np.zeros(1, np.int64)
    taken, owners, froms = np.concatenate(taken), np.concatenate(owners), np.concatenate(froms)
    by = np.lexsort((froms, owners))
    taken, owners, froms = taken[by], owners[by], froms[by]
    if (taken < 0).any():
        raise ValueError("a segment has no encoding")
    # characters without a piece are spelt in bytes
    count = np.where(taken == p.size, chars[froms], 1)
    ids = np.repeat(taken, count)
    spelt = np.repeat(taken == p.size, count)
    place = np.repeat(froms - (np.cumsum(count) - count), count) + np.arange(len(ids))
    ids[spelt] = p.bytes_of[joined[place[spelt]]]
    per = np.bincount(owners, count, len(length)).astype(np.int64)
    return ids.astype(np.int32), np.concatenate([[0], np.cumsum(per)])


def encode_batch(data: np.ndarray, offsets: np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """(ids, bounds per text)."""
    text, at, first = _segments(data, offsets)
    length = np.diff(np.concatenate([at, [len(text)]]))
    if not len(at):
        return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    up, down = powers(len(text) + 1)
    keys = []
    for salt in (np.uint64(0), np.uint64(0xD6E8FEB86659FD93)):
        total = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(mixed(_BYTE_CODES + salt)[text] * up[:-1], out=total[1:])
        keys.append((total[at + length] - total[at]) * down[at])
    _, rep, back = np.unique(keys[0], return_index=True, return_inverse=True)
    if (keys[1][rep][back] != keys[1]).any() or (length[rep][back] != length).any():  # hashes met: take every segment
        rep, back = np.arange(len(at)), np.arange(len(at))
    ids, bounds = _encode_distinct(text, at[rep], length[rep], p)
    p.pack()
    size = np.diff(bounds)[back]
    ends = np.concatenate([[0], np.cumsum(size)])
    flat = ids[np.repeat(bounds[:-1][back] - ends[:-1], size) + np.arange(int(ends[-1]))]
    return flat, ends[first]


def encode(docs: DataFrame, model: bytes, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns of ``keep`` and ids (array of int) for every row of docs. Null and empty texts have no ids."""
    given = docs.sparkSession.sparkContext.broadcast(model)  # the vocabulary file, half a megabyte
    schema = docs.select("doc_id", *keep).schema

    def run(batches: Iterator[pa.RecordBatch]):
        p = pieces_of(given.value)
        for part in steps(batches, column="_text", limit=BATCH_BYTES):
            ids, bounds = encode_batch(*text_bytes(part.column(0)), p)
            arrays = [part.column(i) for i in range(1, part.num_columns)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))],
                                             names=[*part.schema.names[1:], "ids"])

    rows = docs.select(docs["text"].alias("_text"), "doc_id", *keep)
    return rows.mapInArrow(run, schema.add("ids", ArrayType(IntegerType())))


def decode_batch(ids: np.ndarray, bounds: np.ndarray, p: Pieces) -> list[str]:
    """Texts of id lists: the pieces' bytes in a row, without the leading space; bytes that are no UTF-8 become U+FFFD."""
    size = p.length[ids]
    ends = np.concatenate([[0], np.cumsum(size)])
    flat = p.flat[np.repeat(p.flat_at[ids] - ends[:-1], size) + np.arange(int(ends[-1]))].tobytes()
    out = []
    for a, b in zip(ends[bounds[:-1]], ends[bounds[1:]]):
        t = flat[a:b].decode("utf-8", "replace")
        out.append(t[1:] if t.startswith(" ") else t)
    return out


def _recoded(docs: DataFrame, model: bytes, columns: list[str], schema, made) -> DataFrame:
    """One pass: encode, decode, and ``made(batch, ids, bounds, texts)`` as the arrays after the kept columns."""
    given = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]):
        p = pieces_of(given.value)
        for part in steps(batches, column="_text", limit=BATCH_BYTES):
            ids, bounds = encode_batch(*text_bytes(part.column(0)), p)
            texts = decode_batch(ids.astype(np.int64), bounds, p)
            arrays = [part.column(i) for i in range(1, part.num_columns)]
            yield pa.RecordBatch.from_arrays([*arrays, *made(part, ids, bounds, texts)], names=schema.names)

    return docs.select(docs["text"].alias("_text"), *columns).mapInArrow(run, schema)


def encode_and_decode(docs: DataFrame, model: bytes, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns of ``keep``, ids and text (what the ids decode to) for every row of docs, in one pass."""
    schema = docs.select("doc_id", *keep).schema.add("ids", ArrayType(IntegerType())).add("text", StringType())

    def made(part, ids, bounds, texts):
        return [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids)), pa.array(texts, pa.string())]

    return _recoded(docs, model, ["doc_id", *keep], schema, made)


def round_trips(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the ids joined by spaces) and round_trip (decoding gives the text back, the space mark read
    as a space and a null as an empty text) for every row of docs, in one pass."""
    schema = docs.select("doc_id").schema.add("n_tokens", LongType()).add("ids_sha256", StringType()).add("round_trip", BooleanType())

    def made(part, ids, bounds, texts):
        flat, digests, same = ids.tolist(), [], []
        for a, b, given, back in zip(bounds[:-1].tolist(), bounds[1:].tolist(), part.column(0), texts):
            digests.append(hashlib.sha256(" ".join(map(str, flat[a:b])).encode()).hexdigest())
            same.append((given.as_py() or "").replace(SPACE, " ") == back)
        return [pa.array(np.diff(bounds), pa.int64()), pa.array(digests, pa.string()), pa.array(same)]

    return _recoded(docs, model, ["doc_id"], schema, made)


def decode(encoded: DataFrame, model: bytes, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns of ``keep`` and text for every row of encoded (doc_id, ids). Null ids give an empty text."""
    given = encoded.sparkSession.sparkContext.broadcast(model)
    schema = encoded.select("doc_id", *keep).schema

    def run(batches: Iterator[pa.RecordBatch]):
        p = pieces_of(given.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                lists = part.column(0)
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                texts = decode_batch(flat, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), p)
                arrays = [part.column(i) for i in range(1, part.num_columns)]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(texts, pa.string())], names=[*part.schema.names[1:], "text"])

    return encoded.select(encoded["ids"].alias("_ids"), "doc_id", *keep).mapInArrow(run, schema.add("text", StringType()))
