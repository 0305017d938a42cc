"""Terms counted by a grouping, directions from cross products."""

import random

import numpy as np

from loanloom.operators import documents


def test_no_words_are_held_for_text_components(spark):
    spark.catalog.clearCache()
    r = random.Random(1)
    texts = [" ".join(f"w{r.randrange(300)}" for _ in range(4000)) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    out = documents.text_components(df, "text", "id", components=3, terms=50)
    assert out.count() == 30
    held = sum(x.memSize() + x.diskSize() for x in spark.sparkContext._jsc.sc().getRDDStorageInfo())
    assert held < sum(map(len, texts)) / 3


def test_terms_of_equal_frequency_go_by_name_and_directions_are_singular_vectors(spark):
    df = spark.createDataFrame([(i, f"aa bb{i} cc dd{i} zz yy") for i in range(12)], "id long, text string")
    x, terms = documents.tfidf(df, "text", ["id"], 4)
    assert terms == ["aa", "cc", "yy", "zz"]
    got = documents.text_components(df.limit(9), "text", "id", components=2, terms=20).orderBy("id").toPandas()
    x, _ = documents.tfidf(df.limit(9), "text", ["id"], 20)
    whole = np.array([r.tfidf.toArray() for r in x.orderBy("id").collect()])
    s = np.linalg.svd(whole, compute_uv=False)
    np.testing.assert_allclose(np.linalg.norm(got.iloc[:, 1:].to_numpy(), axis=0), s[:2], atol=1e-9)
