"""Strings and windows of hot anchors leave the texts in one pass."""

import re

from pyspark.sql import functions as F

from loanloom.llm import suffix_dedup


def test_texts_are_joined_with_their_anchors_once(spark, monkeypatch):
    plans, real = [], suffix_dedup.written
    monkeypatch.setattr(suffix_dedup, "written", lambda df, name: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), real(df, name))[1])
    monkeypatch.setattr(suffix_dedup, "PIECE", 7)
    common, pair = "the same passage in every text", "a passage that stands in two texts only"
    rows = [(i, f"{i * 7919} {common} {pair if i in (3, 30) else i * 104729}") for i in range(40)] + [(None, common)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: bytes(r.kept).decode() for r in suffix_dedup.deduplicated(docs, 12, hot=5).collect()}
    assert got[0] == rows[0][1] and got[None] == "" and pair in got[3] and common not in got[3] and pair not in got[30]
    assert all(common not in got[i] for i in range(1, 40))
    assert sum(len(re.findall(r"run\(id#\d+L?, th#\d+L?, offsets#\d+, text#\d+\)", p)) for p in plans) == 1


def test_windows_of_hot_anchors_keep_their_places(spark):
    rows = [(i, "abcdefghij" * 3) for i in range(9)] + [(20, "x" + "abcdefghij" * 2), (None, "abcdefghij" * 3 + "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cold, hot = (sorted(map(tuple, suffix_dedup.deduplicated(docs, 8, hot=h).withColumn("kept", F.hex("kept")).collect()), key=str) for h in (1000, 2))
    assert cold == hot
