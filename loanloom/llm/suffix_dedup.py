"""Removal of byte strings that also start in a document with a smaller id, by column-wise suffix sorting of a collection.

The suffixes of all documents are sorted the way a collection's Burrows-Wheeler transform is built column by column: all
strings advance together, each round puts one symbol of every string in front of its suffix, and a stable sort by that symbol
turns the order of the old suffixes into the order of the new ones, while common-prefix lengths of neighbours grow by one
from the minimum between them. Neighbours with a common prefix of ``length`` bytes start with the same string.

To do that for a corpus, strings that can share a prefix are brought together first. Each window of ``length`` bytes has an
anchor, its k-gram of smallest hash; equal windows have equal anchors at equal places. So

1. anchors that occur once in the whole corpus are dropped (each task sends one 4-byte hash per anchor it sees; shards of
   the hash space answer which ones occur again);
2. the stretch of consecutive windows with one anchor becomes a string of a bucket chosen by the anchor's hash;
3. a bucket lines its strings up at the anchor, so that a round takes one column: the symbols are read column after column
   from the end, as from sequential files, and the order and common prefixes of the last round are all the state there is.
   Buckets hold a bounded number of strings, so their columns stay in memory;
4. in each run of neighbours with common prefixes of ``length`` the smallest doc_id keeps the window.

Hot anchors (more than HOT occurrences; at most ANCHOR_LIST of them, sent to all tasks) would fill a bucket: their windows
are aggregated one by one instead, keyed by two 64-bit hashes, which combine before the shuffle. They leave the texts in the
same pass as the strings, in pieces that are groups of their own. Texts equal to one with a smaller id lose everything without
entering a bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.common import written
from loanloom.llm.words import _BYTE_CODES, mixed, powers, steps, text_bytes

LENGTH = 50
#: strings of one anchor that a bucket takes (5 MB); anchors beyond it, and how many of those can be sent to all tasks
HOT, ANCHOR_LIST = 50_000, 4_000_000
#: bytes of text per bucket
BUCKET_BYTES = 4 << 20
#: windows of hot anchors in one piece (9 MB)
PIECE = 1 << 18
BLOCK = 2 << 20
NO_ID = (1 << 63) - 1


def gram_of(length: int) -> int:
    """Bytes of an anchor."""
    return max(1, 2 * length // 5)


def _rolling(data: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """Hash of the ``size`` bytes from each place on."""
    n = len(data) - size + 1
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    codes = mixed(_BYTE_CODES + np.uint64(salt)) if salt else _BYTE_CODES
    np.cumsum(codes[data] * up[:-1], out=total[1:])
    return mixed((total[size:] - total[:n]) * down[:n])


def runs(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor place, its hash, first window, number of windows) of the maximal stretches of windows with one anchor."""
    gram = gram_of(length)
    width = length - gram + 1
    found: list[tuple] = []
    # window starts that lie within their text
    room = np.repeat(offsets[1:], np.diff(offsets))
    for at in range(0, max(1, len(data)), BLOCK):
        part = data[at:at + BLOCK + length - 1]
        if len(part) < length:
            continue
        h = _rolling(part, gram)
        low = (h >> np.uint64(24) << np.uint64(24)) | np.arange(len(h), dtype=np.uint64)
        reach = 1
        while reach * 2 <= width:
            low = np.minimum(low[:-reach], low[reach:])
            reach *= 2
        if width > reach:
            low = np.minimum(low[:len(low) - (width - reach)], low[width - reach:])
        anchor = (low & np.uint64((1 << 24) - 1)).astype(np.int64)
        start = np.arange(len(anchor))
        good = start + at + length <= room[at:at + len(anchor)]
        start, anchor = start[good], anchor[good]
        if not len(start):
            continue
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1])])
        first = np.flatnonzero(new)
        found.append((anchor[first] + at, h[anchor[first]], start[first] + at, np.diff(np.concatenate([first, [len(start)]]))))
    if not found:
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    return tuple(np.concatenate(x) for x in zip(*found))


def _name(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, 32 further bits) of anchor hashes."""
    bucket = ((hashes >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
    return bucket, (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _requests(docs: DataFrame, length: int, buckets: int) -> DataFrame:
    """(bucket, step, kind, payload). kind 0: one entry per distinct anchor of a step (hash, text in step, offset, count);
    kind 1: (text in step, offset) of anchors that occur more than once in their step; kind 2: ids and hashes of the texts."""
    entry = np.dtype([("hash", "<u4"), ("text", "<u2"), ("offset", "<u4"), ("count", "<u2")])
    place = np.dtype([("text", "<u2"), ("offset", "<u4")])

    def run(batches: Iterator[pa.RecordBatch]):
        me, number = TaskContext.get().partitionId(), 0
        for part in steps(batches):
            step = (me << 32) | number
            number += 1
            data, offsets = text_bytes(part.column(2))
            at, hashes, _, _ = runs(data, offsets, length)
            text = np.searchsorted(offsets, at, "right") - 1
            off = at - offsets[text]
            out = [(step % buckets, step, 2, np.stack([part.column(0).to_numpy(), part.column(1).to_numpy()]).astype("<i8").tobytes())]
            bucket, short = _name(hashes, buckets)
            key = (bucket.astype(np.uint64) << np.uint64(32)) | short
            _, first, back, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            again = count[back] > 1
            if again.any():
                p = np.zeros(int(again.sum()), place)
                p["text"], p["offset"] = text[again], off[again]
                out.append((step % buckets, step, 1, p.tobytes()))
            e = np.zeros(len(first), entry)
            e["hash"], e["text"], e["offset"], e["count"] = short[first], text[first], off[first], np.minimum(count, 65535)
            b = bucket[first]  # keys, hence buckets, ascend
            cuts = np.concatenate([[0], np.flatnonzero(b[1:] != b[:-1]) + 1, [len(b)]]) if len(b) else np.zeros(1, np.int64)
            out += [(int(b[x]), step, 0, e[x:y].tobytes()) for x, y in zip(cuts[:-1], cuts[1:])]
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.binary())],
                names=["bucket", "step", "kind", "payload"])

    return docs.select("id", "th", "text").mapInArrow(run, "bucket int, step long, kind int, payload binary")


def _answers(requests: DataFrame, hot: int) -> DataFrame:
    """(kind, step, payload): kind 1 places of anchors that occur again, kind 2 as given, kind 3 (bucket in step) hot hashes."""
    entry = np.dtype([("hash", "<u4"), ("text", "<u2"), ("offset", "<u4"), ("count", "<u2")])
    place = np.dtype([("text", "<u2"), ("offset", "<u4")])

    def work(table: pa.Table) -> pa.Table:
        bucket, step, kind = (table.column(c).to_numpy() for c in ("bucket", "step", "kind"))
        payload = table.column("payload").to_pylist()
        out = [(int(kind[i]), int(step[i]), payload[i]) for i in range(len(kind)) if kind[i]]
        asked = [i for i in range(len(kind)) if not kind[i]]
        if asked:
            all_ = np.concatenate([np.frombuffer(payload[i], entry) for i in asked])
            of = np.repeat(np.arange(len(asked)), [len(payload[i]) // entry.itemsize for i in asked])
            keys, back, times = np.unique(all_["hash"], return_inverse=True, return_counts=True)
            total = np.bincount(back, all_["count"].astype(float), len(keys))
            # a step's own repeats have been answered there
            take = np.flatnonzero((times[back] > 1) & (all_["count"] == 1))
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(of[take])) + 1, [len(take)]]) if len(take) else np.zeros(1, np.int64)
            for a, b in zip(cuts[:-1], cuts[1:]):
                p = np.zeros(b - a, place)
                p["text"], p["offset"] = all_["text"][take[a:b]], all_["offset"][take[a:b]]
                out.append((1, int(step[asked[of[take[a]]]]), p.tobytes()))
            busy = keys[total > hot]
            if len(busy):
                out.append((3, int(bucket[0]), busy.astype("<u4").tobytes()))
        cols = list(zip(*out)) if out else [[], [], []]
        return pa.table([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary())],
                        names=["kind", "step", "payload"])

    return requests.groupBy("bucket").applyInArrow(work, "kind int, step long, payload binary")


def _shared(answers: DataFrame) -> DataFrame:
    """(id, th, offsets): the anchors of each text that occur more than once in the corpus."""
    place = np.dtype([("text", "<u2"), ("offset", "<u4")])

    def work(table: pa.Table) -> pa.Table:
        kind, payload = table.column("kind").to_numpy(), table.column("payload").to_pylist()
        names = [np.frombuffer(p, "<i8").reshape(2, -1) for k, p in zip(kind, payload) if k == 2][0]
        found = [np.frombuffer(p, place) for k, p in zip(kind, payload) if k == 1]
        found = np.concatenate(found) if found else np.zeros(0, place)
        found = found[np.lexsort((found["offset"], found["text"]))]
        cuts = np.searchsorted(found["text"], np.arange(names.shape[1] + 1))
        some = np.flatnonzero(np.diff(cuts))
        offsets = [found["offset"][cuts[i]:cuts[i + 1]].astype("<u4").tobytes() for i in some]
        return pa.table([pa.array(names[0][some]), pa.array(names[1][some]), pa.array(offsets, pa.binary())], names=["id", "th", "offsets"])

    # a step is one task's share of a few megabytes, so its places fit easily
    return answers.where("kind IN (1, 2)").groupBy("step").applyInArrow(work, "id long, th long, offsets binary")


_HEAD = np.dtype([("id", "<i8"), ("th", "<i8"), ("start", "<u4"), ("left", "u1"), ("windows", "u1")])
_WINDOW = np.dtype([("w1", "<i8"), ("w2", "<i8"), ("id", "<i8"), ("th", "<i8"), ("start", "<u4")])


def _strings(texts: DataFrame, length: int, buckets: int, hot_keys: np.ndarray) -> DataFrame:
    """(bucket, heads, strings): the strings of all anchors but the hot ones and, in buckets below 0 (one for each piece), rows
    whose heads hold the single windows of hot anchors: (two hashes, id, th, start)."""
    given = texts.sparkSession.sparkContext.broadcast(hot_keys)

    def run(batches: Iterator[pa.RecordBatch]):
        hot = given.value
        me, pieces = TaskContext.get().partitionId(), 0
        for part in steps(batches):
            data, offsets = text_bytes(part.column(3))
            ids, ths = part.column(0).to_numpy(), part.column(1).to_numpy()
            shared_raw, shared_at = text_bytes(part.column(2))
            shared = np.frombuffer(shared_raw.tobytes(), "<u4").astype(np.int64)
            owner = np.repeat(np.arange(part.num_rows), np.diff(shared_at) // 4)
            at, hashes, first, n = runs(data, offsets, length)
            text = np.searchsorted(offsets, at, "right") - 1
            use = np.isin((text << 32) | (at - offsets[text]), (owner << 32) | shared)
            at, hashes, first, n, text = at[use], hashes[use], first[use], n[use], text[use]
            if not len(at):
                continue
            bucket, short = _name(hashes, buckets)
            key = (bucket.astype(np.uint64) << np.uint64(32)) | short
            busy = hot[np.minimum(np.searchsorted(hot, key), max(len(hot) - 1, 0))] == key if len(hot) else np.zeros(len(key), bool)
            out = []
            if busy.any():
                own = np.repeat(np.flatnonzero(busy), n[busy])
                w = first[own] + np.arange(len(own)) - np.repeat(np.cumsum(n[busy]) - n[busy], n[busy])
                rows = np.zeros(len(own), _WINDOW)
                for name, salt in (("w1", 0), ("w2", 0x51ED270B)):
                    # block by block, as the hashes need the powers of a whole block
                    for a in range(0, len(data), BLOCK):
                        mine = (w >= a) & (w < a + BLOCK)
                        if mine.any():
                            rows[name][mine] = _rolling(data[a:a + BLOCK + length - 1], length, salt)[w[mine] - a].view(np.int64)
                rows["id"], rows["th"], rows["start"] = ids[text[own]], ths[text[own]], w - offsets[text[own]]
                for a in range(0, len(rows), PIECE):
                    out.append((-1 - ((me << 32) | pieces), rows[a:a + PIECE].tobytes(), b""))
                    pieces += 1
            rest = np.flatnonzero(~busy)
            rest = rest[np.argsort(bucket[rest], kind="stable")]
            at, first, n, text, bucket = at[rest], first[rest], n[rest], text[rest], bucket[rest]
            heads = np.zeros(len(at), _HEAD)
            heads["id"], heads["th"], heads["start"] = ids[text], ths[text], first - offsets[text]
            heads["left"], heads["windows"] = at - first, n
            size = n + length - 1
            ends = np.concatenate([[0], np.cumsum(size)])
            symbols = data[np.repeat(first - ends[:-1], size) + np.arange(int(ends[-1]))]
            cuts = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]]) if len(bucket) else np.zeros(1, np.int64)
            out += [(int(bucket[a]), heads[a:b].tobytes(), symbols[ends[a]:ends[b]].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]
            if not out:
                continue
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary())],
                                             names=["bucket", "heads", "strings"])

    return texts.select("id", "th", "offsets", "text").mapInArrow(run, "bucket long, heads binary, strings binary")


def repeated_windows(heads: np.ndarray, symbols: np.ndarray, length: int) -> np.ndarray:
    """For lined-up strings, which windows also start in a string of a smaller id: a (column, string) matrix."""
    n = len(heads)
    middle = length - gram_of(length)  # the anchor's column
    begin = middle - heads["left"].astype(np.int64)
    end = begin + heads["windows"] + length - 1
    last = begin + heads["windows"] - 1  # column of the last window
    size = end - begin
    at = np.concatenate([[0], np.cumsum(size)])
    columns = np.zeros((middle + length, n), np.uint8)
    owner = np.repeat(np.arange(n), size)
    columns[np.repeat(begin - at[:-1], size) + np.arange(len(owner)), owner] = symbols
    enter = np.argsort(-end, kind="stable")  # strings in the order in which their last symbol comes
    entered = 0
    order = np.zeros(0, np.int64)
    common = np.zeros(0, np.int16)
    out = np.zeros((middle + 1, n), bool)
    ids = heads["id"]
    for c in range(middle + length - 1, -1, -1):
        done = begin[order] > c  # strings that have begun leave; the prefix across them is the least on the way
        if done.any():
            kept = np.flatnonzero(~done)
            common = np.minimum.reduceat(common[:kept[-1] + 1], np.concatenate([[0], kept[:-1] + 1])) if len(kept) else common[:0]
            order = order[kept]
            common[:1] = 0
        more = entered
        while more < n and end[enter[more]] - 1 == c:
            more += 1
        if more > entered:  # the empty suffix comes first
            common = np.concatenate([np.zeros(more - entered, np.int16), common])
            order = np.concatenate([enter[entered:more], order])
            entered = more
        if not len(order):
            continue
        symbol = columns[c, order]
        by = np.argsort(symbol, kind="stable")
        symbol = symbol[by]
        same = np.concatenate([[False], symbol[1:] == symbol[:-1]])
        fresh = np.zeros(len(order), np.int16)
        pair = np.flatnonzero(same)
        if len(pair):
            spans = np.empty(2 * len(pair), np.int64)
            spans[0::2], spans[1::2] = by[pair - 1] + 1, by[pair] + 1
            low = np.minimum.reduceat(np.concatenate([common, np.zeros(1, np.int16)]), spans)[0::2]
            fresh[pair] = np.minimum(low + 1, length)
        order, common = order[by], fresh
        if c <= middle:
            group = np.flatnonzero(common < length)
            if len(group) < len(order):
                sizes = np.diff(np.concatenate([group, [len(order)]]))
                least = np.repeat(np.minimum.reduceat(ids[order], group), sizes)
                out[c, order] = (ids[order] > least) & (c <= last[order])
    return out


def _bucket_spans(strings: DataFrame, length: int) -> DataFrame:
    """(w1, w2, id, th, start, stop) of the bytes that the windows of each string lose, without hashes; the single windows of hot
    anchors, lost or not, with them."""
    def work(table: pa.Table) -> pa.Table:
        names = ["w1", "w2", "id", "th", "start", "stop"]
        if table.column("bucket")[0].as_py() < 0:
            r = np.frombuffer(b"".join(table.column("heads").to_pylist()), _WINDOW)
            start = r["start"].astype(np.int32)
            return pa.table([*[pa.array(np.ascontiguousarray(r[c])) for c in names[:4]], pa.array(start), pa.array(start + np.int32(length))], names=names)
        heads = np.frombuffer(b"".join(table.column("heads").to_pylist()), _HEAD)
        symbols = np.frombuffer(b"".join(table.column("strings").to_pylist()), np.uint8)
        lost = repeated_windows(heads, symbols, length)
        middle = length - gram_of(length)
        padded = np.zeros((lost.shape[1], lost.shape[0] + 2), np.int8)
        padded[:, 1:-1] = lost.T
        change = np.diff(padded, axis=1)
        who, a = np.nonzero(change == 1)
        _, b = np.nonzero(change == -1)
        shift = heads["start"][who].astype(np.int64) - (middle - heads["left"][who].astype(np.int64))
        none = pa.nulls(len(who), pa.int64())
        return pa.table([none, none, pa.array(heads["id"][who]), pa.array(heads["th"][who]), pa.array((a + shift).astype(np.int32)),
                         pa.array((b - 1 + length + shift).astype(np.int32))], names=names)

    return strings.groupBy("bucket").applyInArrow(work, "w1 long, w2 long, id long, th long, start int, stop int")


def _window_spans(windows: DataFrame) -> DataFrame:
    """(id, th, start, stop) of the windows of hot anchors that are lost: least id per window, combined before the shuffle."""
    least = windows.groupBy("w1", "w2").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").drop("most")
    return windows.join(least, ["w1", "w2"]).where("id > least").select("id", "th", "start", "stop")


def _keyed(docs: DataFrame, length: int) -> DataFrame:
    return docs.select(F.coalesce("doc_id", F.lit(NO_ID)).cast("long").alias("id"), F.xxhash64("text").alias("th"), "text")


def spans(docs: DataFrame, length: int = LENGTH, hot: int = HOT, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(id, th, whole, spans): the texts that lose bytes, by id and hash of the text; ``whole``: all of it, else ``spans``, an
    array of (start, stop), which may overlap."""
    texts = _keyed(docs.where(F.octet_length("text") >= length), length)
    narrow = written(texts.select("id", "th", F.md5(F.col("text").cast("binary")).alias("m"), F.octet_length("text").alias("n")), "narrow")
    total = narrow.agg(F.sum("n")).first()[0] or 0
    buckets = int(min(1 << 22, max(8, total // bucket_bytes)))
    first = narrow.groupBy("m", "n").agg(F.min("id").alias("first"))
    later = written(narrow.join(first, ["m", "n"]).where("first < id").select("id", "th").distinct(), "later")
    answers = written(_answers(_requests(texts, length, buckets), max(hot, total // 16 // ANCHOR_LIST)), "answers")
    busy = [np.frombuffer(r[1], "<u4").astype(np.uint64) | (np.uint64(r[0]) << np.uint64(32)) for r in
            answers.where("kind = 3").select("step", "payload").collect()]  # at most ANCHOR_LIST hashes
    hot_keys = np.sort(np.concatenate(busy)) if busy else np.zeros(0, np.uint64)
    plan = _shared(answers).join(later, ["id", "th"], "left_anti")
    # equal texts under one id are one text
    plan = written(plan.dropDuplicates(["id", "th"]), "plan")
    # strings take more room than the texts they come from: they are shuffled once and never written
    planned = texts.join(plan, ["id", "th"])
    both = written(_bucket_spans(_strings(planned, length, buckets, hot_keys), length), "found")
    found = both.where("w1 IS NULL").select("id", "th", "start", "stop")
    if len(hot_keys):
        found = found.unionByName(_window_spans(both.where("w1 IS NOT NULL")))
    per_text = found.groupBy("id", "th").agg(F.collect_list(F.struct("start", "stop")).alias("spans")).withColumn("whole", F.lit(False))
    none = F.lit(None).cast("array<struct<start:int,stop:int>>")
    return written(per_text.unionByName(later.withColumn("whole", F.lit(True)).withColumn("spans", none)), "spans")


def deduplicated(docs: DataFrame, length: int = LENGTH, keep: tuple[str, ...] = (), hot: int = HOT, whole_characters: bool = False,
                 bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, the columns of ``keep``, n_bytes, n_removed, n_spans (maximal removed
    runs), kept (the remaining bytes).

    Every byte is removed that lies in a ``length``-byte string (of UTF-8 bytes) that also starts in a document with a smaller
    doc_id; strings are judged on the input. A null text is empty. A null doc_id counts as larger than all others; rows with
    equal ids do not affect each other. ``whole_characters``: a character that loses some of its bytes is kept whole.
    """
    if length < 2 or length > 200:
        raise ValueError("length must lie between 2 and 200")
    lost = spans(docs, length, hot, bucket_bytes).select(F.col("id").alias("_id"), F.col("th").alias("_th"), "whole", "spans")
    extra = docs.select("doc_id", *keep).schema
    rows = docs.select(F.col("doc_id"), *keep, F.col("text").alias("_text"), F.coalesce("doc_id", F.lit(NO_ID)).cast("long").alias("_i"),
                       F.xxhash64("text").alias("_t"))
    rows = rows.join(lost, (F.col("_i") == F.col("_id")) & (F.col("_t") == F.col("_th")), "left")
    rows = rows.select("_text", "whole", F.transform("spans", lambda s: s["start"]).alias("a"), F.transform("spans", lambda s: s["stop"]).alias("b"),
                       "doc_id", *keep)

    def run(batches: Iterator[pa.RecordBatch]):
        for part in steps(batches, column="_text"):
            data, offsets = text_bytes(part.column(0))
            whole = part.column(1).fill_null(False).to_numpy(zero_copy_only=False)
            some = part.column(2).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            a = part.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            b = part.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            base = np.repeat(offsets[:-1], some)
            depth = np.bincount(a + base, minlength=len(data) + 1) - np.bincount(b + base, minlength=len(data) + 1)
            gone = np.cumsum(depth)[:len(data)] > 0
            gone[np.repeat(whole, np.diff(offsets))] = True
            if whole_characters:
                # a character goes only with all its bytes
                head = (data & 0xC0) != 0x80
                number = np.cumsum(head) - 1
                kept = np.bincount(number, ~gone, int(head.sum())) > 0 if len(data) else np.zeros(0, bool)
                gone = ~kept[number] if len(data) else gone
            edge = np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1
            edge[offsets[:-1][np.diff(offsets) > 0]] = gone[offsets[:-1][np.diff(offsets) > 0]]
            sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[offsets])
            left = data[~gone]
            ends = np.concatenate([[0], np.cumsum(~gone)])[offsets]
            body = pa.LargeBinaryArray.from_buffers(pa.large_binary(), part.num_rows, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(left)])
            yield pa.RecordBatch.from_arrays(
                [*[part.column(i) for i in range(4, part.num_columns)], pa.array(np.diff(offsets)), pa.array(sums(gone).astype(np.int64)),
                 pa.array(sums(edge).astype(np.int64)), body.cast(pa.binary())],
                names=[*part.schema.names[4:], "n_bytes", "n_removed", "n_spans", "kept"])

    from pyspark.sql.types import BinaryType, LongType

    for name, kind in (("n_bytes", LongType()), ("n_removed", LongType()), ("n_spans", LongType()), ("kept", BinaryType())):
        extra = extra.add(name, kind)
    return rows.mapInArrow(run, extra)
