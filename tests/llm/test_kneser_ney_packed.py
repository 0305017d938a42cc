"""The model's tables come to the driver packed and part by part."""

import numpy as np
from pyspark.sql import DataFrame

from loanloom.llm import kneser_ney


def test_model_tables_are_packed_by_tasks(spark, monkeypatch):
    r = np.random.default_rng(5)
    rows = sorted({(["en", "*", None, "?"][r.integers(4)], int(r.integers(1, 6)), int(r.integers(1 << 60))) for _ in range(3000)}, key=str)
    rows = [(*x, -i / 7) for i, x in enumerate(rows)]
    table = spark.createDataFrame(rows, "lang string, k int, gram long, logp double").repartition(13)

    def whole(*args, **kwargs):
        raise AssertionError("the table comes to the driver as a whole")

    for name in ("toArrow", "toPandas", "collect"):
        monkeypatch.setattr(type(table), name, whole)
    got = kneser_ney._packed(table, "gram", "logp")
    assert issubclass(type(table), DataFrame) and set(got) == {x[:2] for x in rows}
    for (lang, k), (keys, values) in got.items():
        want = sorted((g, v) for a, b, g, v in rows if (a, b) == (lang, k))
        assert keys.tolist() == [g for g, _ in want] and values.tolist() == [v for _, v in want]
    assert kneser_ney._packed(table.where("false"), "gram", "logp") == {}
