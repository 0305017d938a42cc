"""Repair of conversation structure at the least cost, with an audit of every edit.

A repaired conversation is empty, or an optional system message followed by pairs of user and assistant messages. Each message is
kept, given another role, or deleted; messages without text may be inserted. What an edit sequence has emitted so far is one of
four states (nothing, system, user, assistant), so a message is a 4 x 4 matrix of least costs and a conversation the min-plus
product of its messages' matrices.

Run-length DP: equal consecutive symbols (role and fault) are one run; a run of n is a product of cached binary powers of its
symbol's matrix. Rows are put in order by one range exchange, which cuts large conversations at the partitions' bounds; each
segment is reduced to its matrix by itself. Products of a conversation's segments from the end give the cost-to-go behind each
segment, and the states its cheapest path enters and leaves follow from the front. Then each segment unrolls its choices: at every
message the least letter (D, I, K, R) that keeps the least cost. Costs-to-go make that greedy choice exact, and each letter leads
to one state, so that the audit is the least of all cheapest ones.

Scale: a conversation may span any number of partitions; tasks hold a segment's symbols, never a conversation. A conversation's
segments (at most one a partition, 16 numbers each) meet in one group. Equal rows (same turn, role, text) are counted before the
exchange. A row's first occurrence is found by a combined minimum and joined by the row's own number, so no key is hot. The
edits come as rows; only ``digests`` joins a conversation's lines to one string, which is what a hash of them needs.

Defined cases. Null role and text: one space, so no legal role, blank text. Null turns come first, equal turns in the order of
sha256 over role and text. A null conv_id is a conversation. An empty role has no initial and is never kept. Roles count by their
first character (s, u, a; case matters); a kept role keeps its whole name. Empty tables stay empty. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.llm.common import BLANKS, written

DELETE, INSERT, REROLE, KEEP_TRUNCATED = 2, 5, 1, 5
#: states: 0 nothing yet, 1 system, 2 user, 3 assistant; what a user or assistant message leads to
NEXT = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
LEGAL = {"su", "ua", "au"}
INF = 1 << 60

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(row[k] + b[k][j] for k in range(4)) for j in range(4)) for row in a)


def applied(a: Matrix, v: Vector) -> Vector:
    return tuple(min(min(row[k] + v[k] for k in range(4)), INF) for row in a)


def moves(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits that consume a message, by letter.

    Symbols: s, u, a, o (any other role); upper case if truncated; x must go.
    """
    out = [("D", DELETE, state)]
    if symbol != "x":
        extra, initial = KEEP_TRUNCATED * symbol.isupper(), symbol.lower()
        if (initial, state) in (("s", 0), ("u", 0), ("u", 1), ("u", 3), ("a", 2)):
            out.append(("K", extra, {"s": 1, "u": 2, "a": 3}[initial]))
        out.append(("R", REROLE + extra, NEXT[state]))
    return out


# cost of inserts alone from state to state: at most two are of use
_INSERTS: Matrix = tuple(tuple(0 if r == q else INSERT if r == NEXT[q] else 2 * INSERT if r == NEXT[NEXT[q]] else INF for r in range(4)) for q in range(4))
#: cost-to-go at the end of a conversation: nothing, or inserts up to an assistant message
END: Vector = tuple(min(_INSERTS[q][0], _INSERTS[q][3]) for q in range(4))


@lru_cache(maxsize=None)
def power(symbol: str, exponent: int) -> Matrix:
    """The symbol's matrix (inserts, then the edit of one message) to the power 2^exponent."""
    if exponent:
        half = power(symbol, exponent - 1)
        return times(half, half)
    edit = [[INF] * 4 for _ in range(4)]
    for q in range(4):
        for _, cost, r in moves(symbol, q):
            edit[q][r] = min(edit[q][r], cost)
    return times(_INSERTS, tuple(map(tuple, edit)))


@lru_cache(maxsize=4096)
def run_matrix(symbol: str, count: int) -> Matrix:
    bits = [i for i in range(count.bit_length()) if count >> i & 1]
    out = power(symbol, bits[0])
    for i in bits[1:]:
        out = times(out, power(symbol, i))
    return out


def runs(symbols: str) -> list[tuple[str, int]]:
    return [(s, sum(1 for _ in g)) for s, g in groupby(symbols)]


@lru_cache(maxsize=4096)
def segment_matrix(symbols: str) -> Matrix:
    out: Matrix | None = None
    for s, n in runs(symbols):
        out = run_matrix(s, n) if out is None else times(out, run_matrix(s, n))
    assert out is not None
    return out


def unrolled(symbols: str, behind: Vector, state: int, last: bool) -> tuple[list[str], int]:
    """(letters up to and with each message, state after the last) of the cheapest edits, ties to the least letter.

    ``behind`` is the cost-to-go after the segment; a ``last`` segment closes the conversation with its inserts.
    """
    parts = runs(symbols)
    to_go = [behind]  # at the bounds of the runs, from the end
    for s, n in reversed(parts):
        to_go.append(applied(run_matrix(s, n), to_go[-1]))
    to_go.reverse()
    out: list[str] = []
    for (symbol, n), after in zip(parts, to_go[1:]):
        inner = [after]
        for _ in range(n):
            inner.append(applied(power(symbol, 0), inner[-1]))
        choices = [moves(symbol, q) for q in range(4)]
        for i in range(n, 0, -1):
            here, then, letters = inner[i], inner[i - 1], ""
            while True:
                options = [(a, cost + then[r], r) for a, cost, r in choices[state]] + [("I", INSERT + here[NEXT[state]], NEXT[state])]
                a, _, state = min(o for o in options if o[1] == here[state])
                letters += a
                if a != "I":
                    break
            out.append(letters)
    while last and state in (1, 2):
        out[-1] += "I"
        state = NEXT[state]
    return out, state


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults put in by crc32(conv_id:turn) % 20: 0 drops the row, 1 empties its text, 2 removes
    its ``.!?``, 3 repeats it, 4 sets role user. Nulls count as one space, but for the turn and conv_id returned."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.pmod(F.crc32(name.cast("binary")), F.lit(20))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", kind.alias("kind"), role.alias("role"), text.alias("text")).where("kind <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def ordered(rows: DataFrame) -> DataFrame:
    """Distinct rows in order, written: at (number that rises with conv_id, turn, key), part (a range partition), copies."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    named = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")).withColumn(
        "key", F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)))
    # equal keys have equal roles and texts
    once = named.groupBy("conv_id", "turn", "key").agg(F.count("*").alias("copies"), F.first("role").alias("role"), F.first("text").alias("text"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "key")]
    placed = once.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    return written(placed.withColumn("part", F.shiftright("at", 33)), "rows")


def _first_character(column: str, known: str) -> Column:
    c = F.substring(column, 1, 1)
    return F.when(c.isin(*known), c).otherwise("o")


def symbols(placed: DataFrame) -> DataFrame:
    """at, conv_id, part, blank, duplicate, truncated (numbers of copies with that first fault), symbols and initials of the copies."""
    first = placed.groupBy("conv_id", "key").agg(F.min("at").alias("first_at")).select("first_at")
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    facts = placed.select("at", "conv_id", "part", "copies", (end == "").alias("no_text"), (~F.right(end, F.lit(1)).isin(*".!?")).alias("open"),
                          _first_character("role", "sua").alias("initial"))
    known = facts.join(first, facts["at"] == first["first_at"], "left")
    fresh = ~F.col("no_text") & F.col("first_at").isNotNull()
    symbol = F.when(~fresh, "x").when(F.col("open"), F.upper("initial")).otherwise(F.col("initial"))
    n = F.col("copies")
    return known.select(
        "at", "conv_id", "part", F.when(F.col("no_text"), n).otherwise(0).alias("blank"),
        F.when(F.col("no_text"), 0).otherwise(n - fresh.cast("long")).alias("duplicate"), (fresh & F.col("open")).cast("long").alias("truncated"),
        F.concat(symbol, F.expr("repeat('x', CAST(copies - 1 AS INT))")).alias("symbols"), F.expr("repeat(initial, CAST(copies AS INT))").alias("initials"))


def _mapped(df: DataFrame, fn: Callable[[dict], dict | list[dict]], schema: str, kind: pa.Schema) -> DataFrame:
    """Each row's dict through ``fn`` to one or several rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[dict] = []
            for row in batch.to_pylist():
                made = fn(row)
                out.extend(made if isinstance(made, list) else [made])
            yield pa.RecordBatch.from_pylist(out, schema=kind)

    return df.mapInArrow(work, schema)


def _matrix_of(row: dict) -> dict:
    joined, initials = "".join(row["symbols"]), "".join(row["initials"])
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
    return {"segment": row["segment"], "matrix": [x for line in segment_matrix(joined) for x in line], "illegal": illegal, "ends": initials[0] + initials[-1]}


def _behind(row: dict) -> list[dict]:
    """Cost-to-go behind each segment of a conversation; with the first one the conversation's cost and illegal pairs."""
    parts = sorted(row["parts"], key=lambda p: p["segment"])
    illegal = sum(p["illegal"] for p in parts) + sum(a["ends"][1] + b["ends"][0] not in LEGAL for a, b in zip(parts, parts[1:]))
    out, v = [], END
    for i, p in enumerate(reversed(parts)):
        m = p["matrix"]
        out.append({"segment": p["segment"], "behind": list(v), "last": i == 0, "only": len(parts) == 1, "head": parts[0]["segment"], "cost": None, "illegal": None})
        v = applied(tuple(tuple(m[4 * q:4 * q + 4]) for q in range(4)), v)
    out[-1] |= {"cost": v[0], "illegal": illegal}
    return out


def _exits(row: dict) -> dict:
    joined = "".join(row["symbols"])
    return {"head": row["head"], "segment": row["segment"], "exits": [unrolled(joined, tuple(row["behind"]), q, False)[1] for q in range(4)]}


def _entries(row: dict) -> list[dict]:
    state, out = 0, []
    for p in sorted(row["parts"], key=lambda p: p["segment"]):
        out.append({"segment": p["segment"], "state": state})
        state = p["exits"][state]
    return out


def _edits(row: dict) -> list[dict]:
    joined, state, done, out = "".join(row["symbols"]), row["state"], 0, []
    letters, _ = unrolled(joined, tuple(row["behind"]), state, row["last"])
    for at, own in zip(row["ats"], row["symbols"]):
        steps = []
        for s, group in zip(own, letters[done:done + len(own)]):
            for a in group:
                if a == "K":
                    state = {"s": 1, "u": 2, "a": 3}[s.lower()]
                elif a != "D":
                    state = NEXT[state]
                steps.append({"action": a, "role": ROLE[state] if a in "IR" else None})
        done += len(own)
        out.append({"at": at, "steps": steps})
    return out


_LONGS, _TEXT = pa.list_(pa.int64()), pa.string()


def edits(facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(at, steps: the edits up to and with each row) and (at of a conversation's first row, cost, illegal)."""
    listed = facts.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct("at", "symbols", "initials"))).alias("r"))
    # a segment is named by its first row's number
    segments = written(listed.select("conv_id", F.col("r")[0]["at"].alias("segment"), F.col("r.at").alias("ats"), F.col("r.symbols").alias("symbols"),
                                     F.col("r.initials").alias("initials")), "segments")
    matrices = _mapped(segments.select("segment", "symbols", "initials"), _matrix_of, "segment bigint, matrix array<bigint>, illegal bigint, ends string",
                       pa.schema([("segment", pa.int64()), ("matrix", _LONGS), ("illegal", pa.int64()), ("ends", _TEXT)]))
    joint = segments.select("conv_id", F.col("segment").alias("own")).join(matrices, F.col("own") == F.col("segment"))
    per = joint.groupBy("conv_id").agg(F.collect_list(F.struct("segment", "matrix", "illegal", "ends")).alias("parts")).select("parts")
    behind = written(_mapped(per, _behind, "segment bigint, behind array<bigint>, last boolean, only boolean, head bigint, cost bigint, illegal bigint", pa.schema([
        ("segment", pa.int64()), ("behind", _LONGS), ("last", pa.bool_()), ("only", pa.bool_()), ("head", pa.int64()), ("cost", pa.int64()), ("illegal", pa.int64())])), "behind")
    # states are needed where a conversation has several segments; any other starts with nothing
    many = behind.where("NOT only").join(segments.select("segment", "symbols"), "segment")
    exits = _mapped(many.select("head", "segment", "behind", "symbols"), _exits, "head bigint, segment bigint, exits array<int>",
                    pa.schema([("head", pa.int64()), ("segment", pa.int64()), ("exits", pa.list_(pa.int32()))]))
    entries = _mapped(exits.groupBy("head").agg(F.collect_list(F.struct("segment", "exits")).alias("parts")), _entries, "segment bigint, state int",
                      pa.schema([("segment", pa.int64()), ("state", pa.int32())]))
    starts = entries.unionByName(behind.where("only").select("segment", F.lit(0).alias("state")))
    todo = segments.select("segment", "ats", "symbols").join(behind.select("segment", "behind", "last"), "segment").join(starts, "segment")
    step = pa.list_(pa.struct([("action", _TEXT), ("role", _TEXT)]))
    out = _mapped(todo.select("ats", "symbols", "behind", "last", "state"), _edits, "at bigint, steps array<struct<action: string, role: string>>",
                  pa.schema([("at", pa.int64()), ("steps", step)]))
    return out, behind.where("cost IS NOT NULL").select(F.col("segment").alias("at"), "cost", "illegal")


def _worked(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    placed = ordered(rows)
    facts = written(symbols(placed), "facts")
    steps, costs = edits(facts)
    return placed, facts, placed.join(steps, "at").join(costs, "at", "left")


def repaired(rows: DataFrame) -> DataFrame:
    """Every edit of every conversation of rows (conv_id, turn, role, text): conv_id, at and place (their order), action (Delete,
    Insert, Keep, Rerole by initial), turn, role and text of the repaired message (role null if deleted)."""
    _, _, out = _worked(rows)
    flat = out.select("conv_id", "at", F.col("role").alias("own"), "turn", "text", F.posexplode("steps").alias("place", "step"))
    return flat.select("conv_id", "at", "place", "step.action", F.when(F.col("step.action") != "I", F.col("turn")).alias("turn"),
                       F.when(F.col("step.action") != "D", F.coalesce("step.role", "own")).alias("role"),
                       F.when(F.col("step.action") == "I", "").otherwise(F.col("text")).alias("text"))


def digests(rows: DataFrame) -> DataFrame:
    """Per conversation of rows: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and the hash of the repaired lines."""
    placed, facts, out = _worked(rows)
    lines = F.expr("transform(filter(steps, s -> s.action <> 'D'), s -> concat(coalesce(s.role, role), ':', IF(s.action = 'I', '', text)))")
    told = out.select("conv_id", "at", "cost", "illegal", F.array_join("steps.action", "").alias("letters"), lines.alias("lines"))
    told = told.join(facts.select("at", "blank", "duplicate", "truncated"), "at")
    totals = told.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")], F.max("illegal").alias("illegal"), F.max("cost").alias("cost"),
        F.array_sort(F.collect_list(F.struct("at", "letters", "lines"))).alias("r"))
    turns = placed.select(F.col("conv_id").alias("of"), "turn").distinct().groupBy("of").agg(
        F.max("turn").alias("high"), F.min("turn").alias("low"), F.count("turn").alias("different"))
    span = F.expr("try_subtract(try_add(try_subtract(high, low), 1L), different)")
    return totals.join(turns, F.col("conv_id").eqNullSafe(F.col("of"))).select(
        "conv_id", F.when(F.col("different") > 0, span).otherwise(0).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost",
        F.array_join("r.letters", "").alias("audit"), F.sha2(F.array_join(F.flatten("r.lines"), "\n"), 256).alias("repaired_sha256"))
