"""The strength search fits all folds and strengths in the same passes over the rows."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from loanloom.functions.hashing import fold_of
from loanloom.operators import learning
from loanloom.operators.sampling import with_class_weight

STRENGTHS, FOLDS = (0.0001, 0.01, 1.0), 3


def rows_of(spark, n=600):
    r = random.Random(3)
    rows = []
    for i in range(n):
        a, b = r.gauss(0, 1), r.choice([None, 1.0, 2.0, 900.0])
        rows.append((i, a, b, 7.0, int(r.random() < 1 / (1 + np.exp(1 - a)))))
    return spark.createDataFrame(rows, "id long, a double, b double, same double, y int").repartition(4)


def test_search_equals_a_fit_per_fold_and_strength(spark):
    df, cols = rows_of(spark), ["a", "b", "same"]
    x = with_class_weight(df, "y").withColumns({"label": F.col("y").cast("double"), "fold": fold_of("id", FOLDS)})
    x = learning.assemble(x, cols, ["label", "weight", "fold"]).cache()
    n = x.count() * (FOLDS - 1) / FOLDS
    wanted = []
    for c in STRENGTHS:
        lr = LogisticRegression(regParam=1 / (c * n), standardization=False, maxIter=200, tol=1e-12, weightCol="weight")
        wanted.append(np.mean([BinaryClassificationEvaluator().evaluate(lr.fit(x.where(F.col("fold") != i)).transform(x.where(F.col("fold") == i)))
                               for i in range(FOLDS)]))
    card, table = learning.fit_scorecard_cv(df, cols, "y", "id", STRENGTHS, FOLDS)
    assert [r["c"] for r in table.collect()] == list(STRENGTHS)
    assert [r["auc"] for r in table.collect()] == pytest.approx(wanted, abs=1e-6)
    assert set(card.coefficients) == set(cols)


def test_passes_do_not_grow_with_folds_and_strengths(spark, monkeypatch):
    monkeypatch.setattr(learning, "fit_scorecard", lambda *a, **k: None)
    passes, sums = [], learning._fit_sums
    monkeypatch.setattr(learning, "_fit_sums", lambda *a: passes.append(a) or sums(*a))
    learning.fit_scorecard_cv(rows_of(spark), ["a", "b"], "y", "id", (0.01, 0.1, 1.0, 10.0), 5)
    assert 0 < len(passes) <= 15


def test_one_class_outside_of_a_fold(spark):
    rows = [(1.0, 1.0, 0, 0.5), (0.0, 1.0, 1, 0.1), (0.0, 1.0, 1, 0.9), (0.0, 1.0, 0, 0.3)]
    x = spark.createDataFrame(rows, "label double, weight double, fold int, a double")
    beta = learning.fit_without_folds(x, ["a"], [0, 1], [0.1, 0.1])
    assert beta[0].tolist() == [0, -np.inf] and np.isfinite(beta[1]).all()
    with pytest.raises(ValueError):
        learning.fit_without_folds(x.where("fold = 0"), ["a"], [0], [0.1])
