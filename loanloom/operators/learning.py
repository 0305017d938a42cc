"""Learners on MLlib: scorecard regression, boosted trees out of fold, calibration, uplift, loss given default."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, IsotonicRegression
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.util import inheritable_thread_target

from loanloom.functions.hashing import fold_of, hash_unit
from loanloom.operators.ordering import row_positions, uniform_cuts
from loanloom.operators.profiling import small_frame
from loanloom.operators.ranking import evaluate
from loanloom.operators.sampling import with_class_weight
from loanloom.operators.strategy import confident_labels
from loanloom.session import cut_lineage, hold

MISSING_VALUE = -999.0


def assemble(df: DataFrame, features: Sequence[str], keep: Sequence[str] = (), out: str = "features") -> DataFrame:
    """Feature vector; NULL becomes the sentinel here and nowhere earlier."""
    filled = df.select(*keep, *[F.coalesce(F.col(c).cast("double"), F.lit(MISSING_VALUE)).alias(c) for c in features])
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(filled).select(*keep, out)


def probability(col: str = "probability"):
    return F.get(vector_to_array(F.col(col)), 1)


# Scorecard -------------------------------------------------------------------------------------

@dataclass
class Scorecard:
    model: object
    features: list[str]

    @property
    def coefficients(self) -> dict[str, float]:
        return dict(zip(self.features, map(float, self.model.coefficients)))

    @property
    def intercept(self) -> float:
        return float(self.model.intercept)

    def score(self, df: DataFrame, keep: Sequence[str], name: str = "score") -> DataFrame:
        x = assemble(df, self.features, keep)
        return self.model.transform(x).select(*keep, probability().alias(name))


def _logistic(c: float, n: float, weight: str | None) -> LogisticRegression:
    """L2 regression whose penalty equals that of a summed loss with inverse strength ``c``."""
    lr = LogisticRegression(regParam=1 / (c * n), elasticNetParam=0.0, standardization=False, maxIter=100, tol=1e-9)
    return lr.setWeightCol(weight) if weight else lr


def fit_scorecard(df: DataFrame, features: Sequence[str], label: str, c: float = 0.1, balanced: bool = True) -> Scorecard:
    weighted = with_class_weight(df, label) if balanced else df.withColumn("weight", F.lit(1.0))
    x = hold(assemble(weighted.withColumn("label", F.col(label).cast("double")), features, ["label", "weight"]))
    model = _logistic(c, float(x.count()), "weight").fit(x)
    x.unpersist()
    return Scorecard(model, list(features))


def _fit_sums(x: DataFrame, features: Sequence[str], without: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """For every model, over the rows outside of its fold: weight, weight of label 1, loss, gradient and Hessian at ``beta`` (the
    last coefficient is the intercept). One pass over the rows; a task sends one sum per number."""
    models, k = beta.shape
    one, two = np.triu_indices(k)

    def run(batches):
        total, upper = np.zeros((models, 3 + k + k * k)), np.zeros((models, len(one)))
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            rows = np.column_stack([*cols[3:], np.ones(batch.num_rows)])
            y, weight, fold = (c[:, None] for c in cols[:3])
            z = rows @ beta.T
            w = weight * (fold != without)
            soft = np.logaddexp(0, z)
            p = np.exp(z - soft)
            total[:, 0] += w.sum(axis=0)
            total[:, 1] += (w * y).sum(axis=0)
            total[:, 2] += (w * (soft - y * z)).sum(axis=0)
            total[:, 3:3 + k] += (w * (p - y)).T @ rows
            upper += (w * p * (1 - p)).T @ (rows[:, one] * rows[:, two])
        hessian = np.zeros((models, k, k))
        hessian[:, one, two] = hessian[:, two, one] = upper
        total[:, 3 + k:] = hessian.reshape(models, -1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], names=["at", "v"])

    sums = x.select("label", "weight", "fold", *features).mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(models * (3 + k + k * k))
    out[sums["at"].to_numpy()] = sums["v"].to_numpy()
    return out.reshape(models, -1)


def fit_without_folds(x: DataFrame, features: Sequence[str], without: Sequence[int], penalties: Sequence[float], passes: int = 100) -> np.ndarray:
    """Coefficients (the intercept last) of L2 regressions, model m on the rows of x (label, weight, fold, features) whose fold is not
    ``without[m]``: all models advance together, a Newton step per pass over the rows, halved where a model's loss would rise. The
    loss is MLlib's: mean weighted log loss plus half the penalty times the squared coefficients."""
    without, penalties, k = np.asarray(without), np.asarray(penalties, float), len(features) + 1
    at, step, endless = np.zeros((len(without), k)), np.zeros((len(without), k)), np.zeros(len(without))
    least, open_ = np.full(len(without), np.inf), set(range(len(without)))
    for _ in range(passes):
        sums = _fit_sums(x, features, without, at - step)
        if not np.isfinite(sums).all():
            raise ValueError("labels and features must be numbers")
        for m in sorted(open_):
            n, ones, loss = sums[m, :3]
            if not n:
                raise ValueError(f"no training rows outside of fold {without[m]}")
            if ones in (0, n):  # one class: its log odds are infinite
                endless[m] = np.inf if ones else -np.inf
                open_.discard(m)
                continue
            there, penalty = at[m] - step[m], np.full(k, penalties[m])
            penalty[-1] = 0
            loss = loss / n + (penalty * there ** 2).sum() / 2
            if loss > least[m] + 1e-12:
                step[m] /= 2
                continue
            least[m], at[m] = loss, there
            gradient = sums[m, 3:3 + k] / n + penalty * there
            hessian = sums[m, 3 + k:].reshape(k, k) / n + np.diag(penalty)
            scale = np.sqrt(np.maximum(np.diag(hessian), 1e-300))
            step[m] = np.linalg.lstsq(hessian / np.outer(scale, scale), gradient / scale, rcond=None)[0] / scale
            if gradient @ step[m] < 1e-13:
                at[m], step[m] = at[m] - step[m], 0
                open_.discard(m)
        if not open_:
            break
    at[:, -1] += endless
    return at


def fit_scorecard_cv(df: DataFrame, features: Sequence[str], label: str, key: str, strengths=(0.01, 0.1, 1.0), folds: int = 5):
    """Strength chosen by cross-validated AUC, then refitted on all rows. Returns (card, table of AUCs)."""
    weighted = with_class_weight(df, label).withColumns({"_label": F.col(label).cast("double"), "_fold": fold_of(key, folds)})
    names = [f"x{i}" for i in range(len(features))]  # a feature may have any name
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(MISSING_VALUE)).alias(n) for c, n in zip(features, names)]
    held, x, n_rows = training_rows(weighted.select(F.col("_label").alias("label"), "weight", F.col("_fold").alias("fold"), *filled))
    n = float(n_rows) * (folds - 1) / folds
    models = [(i, c) for i in range(folds) for c in strengths]
    beta = fit_without_folds(x.where("fold IS NOT NULL"), names, [i for i, _ in models], [1 / (c * n) for _, c in models])

    def auc(m: int) -> float:
        margin = sum((F.col(name) * float(b) for name, b in zip(names, beta[m])), F.lit(float(beta[m, -1])))
        scored = x.where(F.col("fold") == models[m][0]).select("label", margin.alias("rawPrediction"))
        return BinaryClassificationEvaluator().evaluate(scored)

    aucs = np.mean(np.reshape(side_by_side(auc, range(len(models))), (folds, len(strengths))), axis=0)
    held.unpersist()
    best = strengths[int(np.argmax(aucs))]
    table = small_frame(df.sparkSession, [{"c": float(c), "auc": float(a)} for c, a in zip(strengths, aucs)])
    return fit_scorecard(df, features, label, best), table


def reason_codes(df: DataFrame, coefficients: dict[str, float], means: dict[str, float], reasons: dict[str, str], top: int = 3, name: str = "reasons"):
    """Reasons of the largest positive contributions coefficient * (value - mean), highest first."""
    parts = F.array(*[
        F.struct((F.lit(w) * (F.col(c) - F.lit(means[c]))).alias("v"), F.lit(reasons[c]).alias("reason"))
        for c, w in coefficients.items() if c in reasons])
    ranked = F.sort_array(F.filter(parts, lambda x: x["v"] > 0), asc=False)
    return df.withColumn(name, F.transform(F.slice(ranked, 1, top), lambda x: x["reason"]))


# Boosted trees ---------------------------------------------------------------------------------

def boosted(trees: int = 20, depth: int = 4, step: float = 0.1, seed: int = 42, **params) -> GBTClassifier:
    return GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=step, seed=seed, labelCol="label", featuresCol="features", **params)


#: rows of a task of a fit, and rows that the fits which run side by side keep together
TASK_ROWS, FIT_ROWS = 500_000, 20_000_000


def training_rows(x: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(held table, its rows for fits, their number). A fit runs a job per level of each tree, so its tasks are as few as keep every
    core busy: partitions are put together, without a shuffle, up to TASK_ROWS rows."""
    held = hold(x)
    n = held.count()
    return held, held.coalesce(max(held.sparkSession.sparkContext.defaultParallelism, -(-n // TASK_ROWS))), n


def fits_at_once(rows: int, wanted: int) -> int:
    """Fits side by side: fewer where their binned rows would push each other out of the memory."""
    return max(1, min(wanted, FIT_ROWS // max(rows, 1)))


def side_by_side(fn: Callable, items: Sequence, parallelism: int = 4) -> list:
    """``fn`` of every item, several Spark jobs at a time; results in the order of the items."""
    with ThreadPool(max(1, min(parallelism, len(items)))) as pool:
        return pool.map(inheritable_thread_target(SparkSession.active())(fn), items)


@dataclass
class OutOfFold:
    """Out-of-fold scores of the training rows, mean scores of the test rows, and the fold models."""

    oof: DataFrame
    test: DataFrame | None
    models: list
    fold_metrics: DataFrame
    importance: DataFrame


def fit_out_of_fold(
    train: DataFrame, features: Sequence[str], label: str, key: str, test: DataFrame | None = None, folds: int = 5,
    learner: GBTClassifier | None = None, seed: int = 42, early_stop_share: float = 0.1,
) -> OutOfFold:
    """One booster per fold, class weights from the fold's own training rows, early stopping on a share
    of the training rows that the out-of-fold scores never touch."""
    learner = learner or boosted()
    x = train.withColumns({"label": F.col(label).cast("double"), "fold": fold_of(key, folds, seed),
                           "_stop": hash_unit(key, f"{seed}stop") < early_stop_share})
    held, x, n_rows = training_rows(assemble(x, features, [key, "label", "fold", "_stop"]))
    ratio = {r["fold"]: (r["b"], r["n"]) for r in x.groupBy("fold").agg(F.sum("label").alias("b"), F.count("*").alias("n")).collect()}
    all_b, all_n = sum(v[0] for v in ratio.values()), sum(v[1] for v in ratio.values())

    def fit(i: int):
        b, n = all_b - ratio.get(i, (0, 0))[0], all_n - ratio.get(i, (0, 0))[1]
        part = x.where(F.col("fold") != i).withColumn("weight", F.when(F.col("label") == 1, (n - b) / max(b, 1.0)).otherwise(1.0))
        return learner.copy().setWeightCol("weight").setValidationIndicatorCol("_stop").fit(part)

    models = side_by_side(fit, list(range(folds)), fits_at_once(n_rows, 4))
    oof = None
    for i, model in enumerate(models):
        part = model.transform(x.where(F.col("fold") == i)).select(key, "fold", "label", probability().alias("score"))
        oof = part if oof is None else oof.unionByName(part)
    oof = cut_lineage(oof)  # scored once, whatever is asked of the scores
    held.unpersist()
    per_fold = evaluate(oof, "score", "label", ["fold"]).select("fold", "auc")
    scored = None if test is None else mean_score(models, test, features, key)
    return OutOfFold(oof, scored, models, per_fold, importance_table(train.sparkSession, models, features))


def mean_score(models: Sequence, df: DataFrame, features: Sequence[str], key: str, name: str = "score", keep: Sequence[str] = ()) -> DataFrame:
    """Mean of the models' probabilities; the models are chained, so the rows are read once."""
    x = assemble(df, features, [key, *keep])
    for i, m in enumerate(models):
        x = m.copy().setProbabilityCol(f"_p{i}").setRawPredictionCol("_raw").setPredictionCol("_pred").transform(x).drop("_raw", "_pred")
    total = sum((probability(f"_p{i}") for i in range(len(models))), F.lit(0.0))
    return x.select(key, *keep, (total / len(models)).alias(name))


def importance_table(spark, models: Sequence, features: Sequence[str]) -> DataFrame:
    """Mean impurity-gain importance over the models."""
    mean = np.mean([m.featureImportances.toArray() for m in models], axis=0)
    return small_frame(spark, [{"feature": f, "importance": float(v)} for f, v in zip(features, mean)]).orderBy(F.desc("importance"), "feature")


def successive_halving(spark: SparkSession, trials: Sequence[int], rungs: Sequence, measure: Callable, keep: float = 1 / 3) -> DataFrame:
    """(rung, trial, value, survived): all trials at the first budget, the better share of them at the next, and so on.

    ``measure(budget, trials)`` gives one number per trial, the higher the better. Of n trials the best ceil(n x keep) go on; equal
    values go by the lower trial. Losers cost no more than the budgets up to their last rung.
    """
    rows, left = [], list(trials)
    for i, budget in enumerate(rungs):
        values = dict(zip(left, measure(budget, left)))
        order = sorted(left, key=lambda t: (-values[t], t))
        best = set(order[:math.ceil(len(left) * keep)]) if i + 1 < len(rungs) else set(order[:1])
        rows += [{"rung": i, "trial": t, "value": float(values[t]), "survived": t in best} for t in left]
        left = [t for t in left if t in best]
    return small_frame(spark, rows, "rung int, trial int, value double, survived boolean")


def search_boosted(train: DataFrame, features: Sequence[str], label: str, key: str, trials: int = 30, folds: int = 3,
                   rungs: Sequence[int] = (3, 9, 27), stop_share: float = 0.1, seed: int = 42, parallelism: int = 8) -> DataFrame:
    """Random search over depth, leaf size, step, row and feature shares by successive halving on the number of trees.

    A trial's value is its mean AUC over the folds. Bad rows weigh as much as good ones within a fold's own training rows, and a
    share of those rows, never the fold that is scored, stops a booster that no longer gains. The fits of a rung run side by side.
    Returns (rung, trial, value, survived) with the trial's parameters.
    """
    rng = random.Random(seed)
    x = train.withColumns({"label": F.col(label).cast("double"), "fold": fold_of(key, folds, seed), "_stop": hash_unit(key, f"{seed}stop") < stop_share})
    held, x, n_rows = training_rows(assemble(x, features, ["label", "fold", "_stop"]))
    counts = {r["fold"]: (r["b"], r["n"]) for r in x.groupBy("fold").agg(F.sum("label").alias("b"), F.count("*").alias("n")).collect()}
    draws = [{
        "maxDepth": rng.randint(2, 6), "minInstancesPerNode": rng.choice([1, 20, 50, 100]), "stepSize": round(10 ** rng.uniform(-2, -0.5), 6),
        "subsamplingRate": round(rng.uniform(0.5, 1.0), 6), "featureSubsetStrategy": rng.choice(["all", "0.8", "0.6"])} for _ in range(trials)]

    def auc(item) -> float:
        trees, trial, fold = item
        b, n = (sum(v[i] for f, v in counts.items() if f != fold) for i in (0, 1))
        part = x.where(F.col("fold") != fold).withColumn("weight", F.when(F.col("label") == 1, (n - b) / max(b, 1.0)).otherwise(1.0))
        model = GBTClassifier(maxIter=trees, seed=seed, weightCol="weight", validationIndicatorCol="_stop", **draws[trial]).fit(part)
        return BinaryClassificationEvaluator().evaluate(model.transform(x.where(F.col("fold") == fold)))

    def measure(trees: int, left: list[int]) -> list[float]:
        values = side_by_side(auc, [(trees, t, f) for t in left for f in range(folds)], fits_at_once(n_rows, parallelism))
        return [float(np.mean(values[i * folds:(i + 1) * folds])) for i in range(len(left))]

    table = successive_halving(train.sparkSession, range(trials), rungs, measure)
    held.unpersist()
    drawn = small_frame(train.sparkSession, [{"trial": i, **{k: str(v) for k, v in d.items()}} for i, d in enumerate(draws)])
    return table.withColumn("trees", F.element_at(F.lit([int(r) for r in rungs]), F.col("rung") + 1)).join(F.broadcast(drawn), "trial")  # a row per trial


def time_series_auc(df: DataFrame, features: Sequence[str], label: str, fold: str, folds: int = 5, learner=None) -> DataFrame:
    """Expanding window: fold i trains on all earlier time blocks."""
    from loanloom.operators.sampling import expanding_splits

    learner = learner or boosted()
    held, x, _ = training_rows(assemble(df.withColumn("label", F.col(label).cast("double")), features, ["label", fold]))
    parts = []
    for i, (past, ahead) in enumerate(expanding_splits(x, folds, fold)):
        parts.append(learner.fit(past).transform(ahead).select(F.lit(i + 1).alias("split"), "label", probability().alias("score")))
    scored = parts[0]
    for p in parts[1:]:
        scored = scored.unionByName(p)
    scored = cut_lineage(scored)
    held.unpersist()
    return evaluate(scored, "score", "label", ["split"]).select("split", "n", "auc")


def permutation_importance(model, df: DataFrame, features: Sequence[str], label: str, key: str, columns: Sequence[str] | None = None,
                           mode: str = "permute", seed: int = 42) -> DataFrame:
    """Drop in AUC when one column is destroyed: replaced by zero, or handed to another row.

    The permutation matches the rows in one hash order with the rows in another; both orders come from
    the sliced row positions, so no task sees all rows. The order of the takers is the same for all columns and found once.
    """
    base = hold(df.select(key, F.col(label).cast("int").alias("label"), *features))

    def auc(d: DataFrame) -> float:
        scored = hold(model.transform(assemble(d, features, ["label"])).select("label", probability().alias("score")))
        value = evaluate(scored).first()["auc"]
        scored.unpersist()
        return value

    whole = auc(base)
    even = uniform_cuts(df.sparkSession)
    takers = None if mode == "zero" else cut_lineage(
        row_positions(base.withColumn("_h", hash_unit(key, f"{seed}t")), "_h", key, descending=False, cuts=even).drop("_h", "total"))
    rows = []
    for c in columns or features:
        if mode == "zero":
            broken = base.withColumn(c, F.lit(0.0))
        else:
            giver = row_positions(base.select(key, c).withColumn("_h", hash_unit(key, f"{seed}g{c}")), "_h", key, descending=False, cuts=even)
            broken = takers.drop(c).join(giver.select("pos", c), "pos").drop("pos")
        rows.append({"feature": c, "auc_drop": float(whole - auc(broken))})
    return small_frame(df.sparkSession, rows)


# Calibration, uplift, loss ---------------------------------------------------------------------

def calibrate_sigmoid(df: DataFrame, score: str, label: str):
    """Logistic curve on the score; returns a function that adds the calibrated column."""
    x = assemble(df.withColumn("label", F.col(label).cast("double")), [score], ["label"])
    m = LogisticRegression(regParam=0.0, maxIter=100).fit(x)
    slope, level = float(m.coefficients[0]), float(m.intercept)
    return lambda d, name="calibrated": d.withColumn(name, 1 / (1 + F.exp(-(F.lit(level) + F.lit(slope) * F.col(score)))))


def calibrate_isotonic(df: DataFrame, score: str, label: str):
    """Monotone curve fitted on all distinct scores. The fit pools adjacent violators in range slices of the scores, then
    the blocks that remain over the slices."""
    hist = df.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("features")).agg(
        F.avg(F.col(label).cast("double")).alias("label"), F.count("*").cast("double").alias("weight"))
    model = IsotonicRegression(weightCol="weight").fit(hist)

    def apply(d: DataFrame, name: str = "calibrated") -> DataFrame:
        return model.transform(d.withColumn("features", F.col(score))).withColumnRenamed("prediction", name).drop("features")

    return apply


def fit_uplift(df: DataFrame, features: Sequence[str], label: str, treated: str, learner=None):
    """Two boosters on the treated and the untreated rows; returns a scoring function."""
    learner = learner or boosted()
    x = hold(assemble(df.withColumn("label", F.col(label).cast("double")), features, ["label", treated]))
    with_t, without = (learner.fit(x.where(F.col(treated) == v)) for v in (1, 0))
    x.unpersist()

    def score(d: DataFrame, key: str) -> DataFrame:
        a = assemble(d, features, [key])
        for m, p in ((with_t, "_pt"), (without, "_pc")):
            a = m.copy().setProbabilityCol(p).setRawPredictionCol("_raw").setPredictionCol("_pred").transform(a).drop("_raw", "_pred")
        return a.select(key, probability("_pt").alias("p_treated"), probability("_pc").alias("p_control")).withColumn(
            "uplift", F.col("p_treated") - F.col("p_control"))

    return score


def fit_lgd(df: DataFrame, features: Sequence[str], collected: str, exposure: str, trees: int = 20):
    """Chance of any recovery times the recovered share: two models, combined in one expression."""
    rate = F.try_divide(F.col(collected), F.col(exposure))
    x = hold(assemble(df.withColumns({"rate": rate, "label": (rate > 0).cast("double")}), features, ["rate", "label"]))
    any_recovery = LogisticRegression(maxIter=50).fit(x)
    share = GBTRegressor(labelCol="rate", maxIter=trees, maxDepth=3, seed=42).fit(x.where("rate > 0"))
    x.unpersist()

    def predict(d: DataFrame, key: str) -> DataFrame:
        a = any_recovery.transform(assemble(d, features, [key])).select(key, "features", probability().alias("p"))
        r = share.transform(a)
        lgd = (1 - F.col("p")) + F.col("p") * (1 - F.col("prediction"))
        return r.select(key, F.greatest(F.lit(0.0), F.least(F.lit(1.0), lgd)).alias("lgd"))

    return predict


# Stacking and pseudo-labels --------------------------------------------------------------------

def fit_stack(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, key: str, learners: Sequence[GBTClassifier],
              folds: int = 5, c: float = 0.01, with_features: bool = False):
    """Base out-of-fold scores feed a logistic meta model. Returns (test scores, metrics of every layer).

    The meta model's metric is in-sample and named so.
    """
    runs = [fit_out_of_fold(train, features, label, key, test, folds, g, seed=42 + i) for i, g in enumerate(learners)]
    names = [f"base{i}" for i in range(len(runs))]
    meta, ahead = train.select(key, label, *features), test.select(key, *features)
    for n, r in zip(names, runs):
        meta = meta.join(r.oof.select(key, F.col("score").alias(n)), key)
        ahead = ahead.join(r.test.select(key, F.col("score").alias(n)), key)
    inputs = [*names, *(features if with_features else [])]
    meta = hold(meta)
    card = fit_scorecard(meta, inputs, label, c, balanced=False)
    in_sample = card.score(meta, [key, label], "meta_in_sample")
    wide = meta.select(key, F.col(label).alias("label"), *names).join(in_sample.select(key, "meta_in_sample"), key)
    from loanloom.operators.ranking import compare_models

    return card.score(ahead, [key]), compare_models(hold(wide), [*names, "meta_in_sample"])


def pseudo_label_rounds(train: DataFrame, unlabelled: DataFrame, features: Sequence[str], label: str, key: str, rounds: int = 3,
                        threshold: float = 0.1, learner=None) -> DataFrame:
    """Fit, label the confident rows, append, repeat; stops early when no row is confident.

    Returns the extended training rows with the round they came in. Each round is checkpointed.
    """
    learner = learner or boosted()
    pool = unlabelled.select(key, *features)
    rows = cut_lineage(train.select(key, *features, F.col(label).cast("int").alias(label)).withColumn("round", F.lit(0)))
    for i in range(1, rounds + 1):
        x = assemble(rows.withColumn("label", F.col(label).cast("double")), features, ["label"])
        model = learner.fit(x)
        scored = model.transform(assemble(pool, features, [key])).select(key, probability().alias("p"))
        sure = confident_labels(scored, "p", label, threshold, 1.0).select(key, label)
        extra = cut_lineage(pool.join(sure, key).withColumn("round", F.lit(i)))
        if extra.limit(1).count() == 0:
            break
        rows = cut_lineage(rows.unionByName(extra.select(rows.columns)))
        pool = cut_lineage(pool.join(extra.select(key), key, "left_anti"))
    return rows
