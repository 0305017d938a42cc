"""Conversation repair, licence scan and centroid clustering against plain Python."""

import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from loanloom.llm import centroids, conversation_repair, license_scan

WORD = re.compile(r"[^\x20\x09-\x0D]")
CONTENT = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def cheapest(symbols):
    """(cost, letters) over all edit sequences; symbols are (initial, must go, truncated)."""
    step = {"": "u", "s": "u", "u": "a", "a": "u"}  # what a user or assistant message has to be
    after = [{"": (0, ""), "a": (0, ""), "u": (5, "I"), "s": (10, "II")}]
    for initial, gone, cut in reversed(symbols):
        then, here = after[-1], {}
        for q in step:
            ways = [(2 + then[q][0], "D" + then[q][1])]
            if not gone:
                extra = 5 * cut
                if initial == step[q] or (initial == "s" and q == ""):
                    ways.append((extra + then[initial][0], "K" + then[initial][1]))
                ways.append((1 + extra + then[step[q]][0], "R" + then[step[q]][1]))
            here[q] = min(ways)
        for _ in range(3):  # inserts before the message
            here = {q: min(w, (5 + here[step[q]][0], "I" + here[step[q]][1])) for q, w in here.items()}
        after.append(here)
    return after[-1][""]


def expected(rows):
    """Digest of one conversation's (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    key = lambda r, x: hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest()
    rows.sort(key=lambda y: (y[0] is not None, y[0] or 0, key(*y[1:])))
    seen, symbols, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, r, x in rows:
        marks = WORD.findall(x)
        fault = "blank" if not marks else "duplicate" if (r, x) in seen else "truncated" if marks[-1] not in ".!?" else None
        seen.add((r, x))
        if fault:
            faults[fault] += 1
        symbols.append((r[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit = cheapest(symbols)
    lines, at, roles = [], 0, audit.replace("D", "")
    name = ["system"] * (len(roles) % 2) + ["user", "assistant"] * (len(roles) // 2)
    for a in audit:
        if a != "D":
            role = name[len(lines)]
            lines.append(f"{rows[at][1]}:{rows[at][2]}" if a == "K" else f"{role}:{'' if a == 'I' else rows[at][2]}")
        at += a != "I"
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def chats(seed):
    r = random.Random(seed)
    roles = ["user"] * 6 + ["assistant"] * 6 + ["system", "tool", "", None, "User", "a", "stranger"]
    texts = ["Yes.", "No!", "so?", "cut off", "", " \t", None, "été.\n", "Wait. ", "a.b", "\x1c"]
    out = {}
    for c in [None, *range(60)]:
        n = r.choice([1, 1, 2, 3, 5, 8, 30])
        out[c] = [(r.choice([None, i, i, i, i, i // 2]), r.choice(roles), r.choice(texts) if r.random() < 0.4 else f"word {r.random()}" + r.choice([".", "!", ""]))
                  for i in range(n)]
    out[100] = [(i, ("user", "assistant")[i % 2], f"line {i}.") for i in range(700)]
    out[101] = [(i, "user", "same" if i % 3 else f"line {i}.") for i in range(500)]
    out[102] = [(5, "user", "the very same row")] * 300 + [(6, "assistant", "ok.")]
    out[103] = [(0, "system", "s."), (1, "user", "x" * 200_000 + "."), (2, "assistant", "y.")]
    return out


def frame(spark, chats):
    rows = [(c, *x) for c, given in chats.items() for x in given]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    for c in ("at", "part", "key", "segment", "copies", "kind"):
        df = df.withColumn(c, F.lit("extra"))
    return df


@pytest.mark.parametrize("seed,spread", [(1, True), (2, False)])
def test_repairs(spark, seed, spread):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(not spread).lower())  # large conversations lie in several partitions
    try:
        given = chats(seed)
        df = frame(spark, given)
        if spread:
            placed = conversation_repair.ordered(df)
            assert placed.where("conv_id = 100").select("part").distinct().count() > 1
        got = {x.conv_id: tuple(x)[1:] for x in conversation_repair.digests(df).collect()}
        assert got == {c: expected(x) for c, x in given.items()}
        steps = conversation_repair.repaired(df).where("conv_id = 101").orderBy("at", "place").collect()
        assert "".join(s.action for s in steps) == got[101][6]
        kept = [s.role[0] for s in steps if s.role is not None]
        assert re.fullmatch("(s?(ua)+)?", "".join(kept))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_powers_are_products():
    for symbol in "suaoSUAOx":
        m = conversation_repair.power(symbol, 0)
        out = m
        for n in range(2, 20):
            out = conversation_repair.times(out, m)
            assert conversation_repair.run_matrix(symbol, n) == out


def test_damage(spark):
    given = frame(spark, {**chats(3), 7: [(None, None, None), (3, "user", "a.b!c?")]})
    want = []
    for r in given.collect():
        kind = zlib.crc32(f"{' ' if r.conv_id is None else r.conv_id}:{' ' if r.turn is None else r.turn}".encode()) % 20
        role, text = " " if r.role is None else r.role, " " if r.text is None else r.text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        want += [(r.conv_id, r.turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert sorted(map(str, map(tuple, conversation_repair.damaged(given).collect()))) == sorted(map(str, want))


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_repair.digests(none).count() == 0 and conversation_repair.repaired(none).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def scanned(text):
    """(n_words, base places, least edits by notice) over all runs of words."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x.encode() for x in CONTENT.findall(lowered)]
    base, least = [], {}
    for phrase, label, k in license_scan.NOTICES:
        m = phrase.encode()
        for i in range(len(w)):
            for z in range(max(1, phrase.count(" ") + 1 - k), phrase.count(" ") + 2 + k):
                run = b" ".join(w[i:i + z])
                if i + z <= len(w) and abs(len(run) - len(m)) <= k:
                    d = distance(run, m)
                    if d <= k:
                        least[phrase] = min(d, least.get(phrase, 99))
                    if d == 0 and phrase in license_scan.BASE:
                        base.append((i, label))
    return len(w), base, least


@pytest.fixture(scope="module")
def notices(spark):
    r = random.Random(5)
    words = ["the", "été", "license", "gnu", "public", "b", "cc", "mit", "by", "general", "x1", "rights", "日本"]
    rows = []
    for i in range(150):
        parts = []
        for _ in range(r.choice([0, 1, 2, 4])):
            parts += [r.choice(words) for _ in range(r.choice([0, 1, 6]))]
            phrase = list(r.choice(license_scan.NOTICES)[0])
            for _ in range(r.choice([0, 0, 1, 2, 3, 5])):
                at = r.randrange(len(phrase))
                phrase[at] = r.choice(["", " ", "e", "é", phrase[at] * 2, phrase[at].upper()])
            parts.append("".join(phrase))
        rows.append((i, r.choice([" ", "\n", " - ", "/"]).join(parts)))
    rows += [(900, None), (901, ""), (902, "!! \n"), (903, "MIT License\x00mit license, MITLicense"), (904, "license " * 3000 + "gnu general public license"),
             (0, rows[0][1]), (None, "Apache-License"), (905, "cc by cc by cc-by")]
    return rows


def test_scan(spark, notices):
    df = spark.createDataFrame(notices, "doc_id long, text string").withColumn("places", F.lit(1)).withColumn("n_words", F.lit(2)).repartition(4)
    got = license_scan.labelled(df).collect()
    want = []
    for i, text in notices:
        n, base, least = scanned(text)
        labels = {p: label for p, label, _ in license_scan.NOTICES}
        starts = [b[0] for b in base]
        score = max((1 - d / len(p) for p, d in least.items()), default=0.0)
        want.append((i, n, len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({b[1] for b in base})),
                     ",".join(sorted({labels[p] for p in least})), score))
    assert sorted((tuple(x)[:-1] for x in got), key=str) == sorted(want, key=str)
    for x in got:
        for p in x.places:
            assert distance(p.found.encode(), p.phrase.encode()) == p.edits or "�" in p.found
            assert p.found.count(" ") + 1 == p.n_words and 0 <= p.first_word <= x.n_words - p.n_words


def test_scan_of_nothing(spark):
    assert license_scan.labelled(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        license_scan.Scanner((("mit", "mit", 3),))
    with pytest.raises(ValueError):
        license_scan.Scanner((("MIT License", "mit", 1),))


def lloyd(rows, k, rounds):
    start = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    c = [v for _, v in start[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m)), i) for i, m in enumerate(c))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in rows]
        c = [[sum(x) // len(x) for x in zip(*[v for (_, v), o in zip(rows, own) if o == i])] if i in own else m for i, m in enumerate(c)]
    out = [(i, *reversed(near(v))) for i, v in rows]
    inertia = sum(d for _, _, d in out)
    return [(i, o, d, sum(y for _, x, y in out if x == o), inertia, hashlib.sha256(",".join(map(str, c[o])).encode()).hexdigest()) for i, o, d in out]


@pytest.mark.parametrize("n,k", [(200, 8), (5, 8), (0, 3)])
def test_clusters(spark, n, k):
    r = random.Random(n)
    rows = [(i, [r.choice([-1, 1]) + r.gauss(0, 0.3) for _ in range(4)]) for i in range(n)]
    rows += [(i % 7, [0.5, -0.25, 0.001, -0.001]) for i in range(n // 4)]  # repeated ids and vectors, ties
    rows += [(i, [-0.0, 1e-9, -1e-9, 3.0]) for i in (None,) if n]
    odd = [(900, None), (901, [1.0, 2.0, 3.0]), (902, [1.0, None, 2.0, 3.0]), (903, [float("nan"), 0.0, 0.0, 0.0]), (904, [float("inf"), 0.0, 0.0, 0.0]), (905, [])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("v", F.lit(1)).withColumn("cluster", F.lit("x")).repartition(3)
    got = centroids.clustered(df, k=k, dims=4).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(lloyd(whole, k, 5), key=str)


def test_huge_components_are_clamped(spark):
    df = spark.createDataFrame([(1, [1e300, -1e300]), (2, [0.0, 0.0])], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.distance for r in centroids.clustered(df, k=1, dims=2).collect()}
    assert all(0 <= d < 1 << 62 for d in got.values()) and len(got) == 2
