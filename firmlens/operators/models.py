"""Estimators: thin settings over ``pyspark.ml``, plus the few stages Spark does not have.

``task`` is ``"regression"`` or ``"class"``. All read ``features`` and ``label`` and write
``prediction``.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, functions as F

from firmlens.functions.columns import col
from firmlens.operators import margins
from firmlens.operators.knn import knn_join
from firmlens.operators.metrics import classification_metrics, regression_metrics
from firmlens.session import settle, temporary

#: Spark's own limit; stands for trees without one.
MAX_DEPTH = 30
ITERATIONS = 200


def _depth(wanted: int | None) -> int:
    if wanted is not None and wanted > MAX_DEPTH:
        raise ValueError(f"trees can be {MAX_DEPTH} deep at most, not {wanted}")
    return MAX_DEPTH if wanted is None else wanted


def _converged(model: Model) -> Model:
    """The fitted model; says so if its solver stopped at its limit of iterations."""
    for part in getattr(model, "models", [model]):
        try:
            done = part.summary.totalIterations if not callable(part.summary) else part.summary().totalIterations
        except Exception:  # a model without a training summary
            continue
        if done >= ITERATIONS:
            warnings.warn(f"{type(part).__name__} stopped after {done} iterations", stacklevel=3)
    return model


class Penalised(Estimator):
    """An estimator whose mean loss is penalised by ``1 / (c * rows)``: ``c`` weighs the sum of losses."""

    def __init__(self, build: Callable[[float], Estimator], c: float):
        super().__init__()
        self.build, self.c = build, c

    def _fit(self, df: DataFrame) -> Model:
        return _converged(self.build(1.0 / (self.c * max(1, df.count()))).fit(df))


class RelativeError(Evaluator):
    """Mean absolute error relative to the label; lower is better."""

    def _evaluate(self, dataset: DataFrame) -> float:
        relative = F.abs(F.col("label") - F.col("prediction")) / F.greatest(F.abs("label"), F.lit(2.220446049250313e-16))
        return dataset.agg(F.avg(relative)).first()[0]

    def isLargerBetter(self) -> bool:
        return False


def evaluator(task: str, metric: str | None = None) -> Evaluator:
    """R2 for regression and accuracy for classes, unless ``metric`` names another: r2, rmse, mape,
    accuracy."""
    metric = metric or ("r2" if task == "regression" else "accuracy")
    if metric == "mape":
        return RelativeError()
    if metric in ("r2", "rmse"):
        return RegressionEvaluator(metricName=metric)
    return MulticlassClassificationEvaluator(metricName=metric)


# ---- linear --------------------------------------------------------------------------------------


def linear(alpha: float = 0.0, l1_ratio: float = 0.0, label_std: float = 1.0) -> LinearRegression:
    """Least squares; with ``alpha`` lasso (``l1_ratio=1``) or elastic net.

    Minimises half the mean squared error plus ``alpha * l1_ratio * |w|`` plus
    ``alpha * (1 - l1_ratio) / 2 * w^2``. Spark divides the squared part of its penalty by the
    label's standard deviation, so that must be given where the squared part counts.
    """
    absolute, squared = alpha * l1_ratio, alpha * (1 - l1_ratio) * label_std
    total = absolute + squared
    return LinearRegression(regParam=total, elasticNetParam=absolute / total if total else 0.0, standardization=False)


def ridge(alpha: float, n_rows: int, label_std: float = 1.0) -> LinearRegression:
    """Ridge with the penalty set against the sum (not the mean) of squared errors."""
    return linear(alpha / max(n_rows, 1), 0.0, label_std)


class Ridge(Estimator):
    """Ridge whose penalty follows the rows it is fitted on."""

    def __init__(self, alpha: float):
        super().__init__()
        self.alpha = alpha

    def _fit(self, df: DataFrame) -> Model:
        n, spread = df.agg(F.count(F.lit(1)), F.stddev_pop("label")).first()
        return ridge(self.alpha, n, spread or 1.0).fit(df)


def label_std(df: DataFrame, label: str = "label") -> float:
    return df.agg(F.stddev_pop(label)).first()[0] or 1.0


def tweedie(link: str = "auto", alpha: float = 1.0) -> Estimator:
    """Power 0 (normal) with an identity or log link."""
    power = {"auto": 1.0, "identity": 1.0, "log": 0.0}[link]
    spark = GeneralizedLinearRegression(family="tweedie", variancePower=0.0, linkPower=power, regParam=alpha)
    return LogLink(spark, alpha) if link == "log" else spark


class LogLink(Estimator):
    """A normal family with a log link on any labels of which one is positive. Spark's solver starts at
    the logarithms of the labels, so it fits those that are all positive; others are fitted by the same
    reweighted steps (and the same penalty) from a constant, halved where they would not lower the loss."""

    def __init__(self, positive: Estimator, alpha: float):
        super().__init__()
        self.positive, self.alpha = positive, alpha

    def _fit(self, df: DataFrame) -> Model:
        least, start = df.agg(F.min("label"), F.avg(F.greatest("label", F.lit(0.0)))).first()
        if least is None or least > 0:
            return self.positive.fit(df)
        if not start > 0:
            raise ValueError("a log link needs a positive label")
        n = df.select(F.size(vector_to_array("features"))).first()[0]
        x = F.array(*(F.element_at(vector_to_array("features"), i + 1) for i in range(n)))
        rows = df.select(x.alias("x"), F.col("label").cast("double").alias("y"))
        moments = rows.agg(*(f(F.element_at("x", i + 1)) for f in (F.avg, F.stddev_pop) for i in range(n))).first()
        centre = np.array(moments[:n], float)
        scale = np.array([s or 1.0 for s in moments[n:]], float)
        at = np.append(math.log(start), np.zeros(n))
        here = _log_sums(rows, at, centre, scale)
        for _ in range(ITERATIONS):
            loss, weight, gram, pull = here
            # Slopes are of scaled columns, the penalty is on those of the columns themselves.
            shrink = np.append(0.0, self.alpha * weight / scale**2)
            step = np.linalg.lstsq(gram + np.diag(shrink), pull - shrink * at, rcond=None)[0]
            worth = loss + (shrink * at**2).sum()
            for _ in range(60):
                there = _log_sums(rows, at + step, centre, scale)
                now = there[0] + (shrink * (at + step) ** 2).sum()
                if now <= worth or np.abs(step).max() <= 1e-9 * max(1.0, np.abs(at).max()):
                    break
                step = step / 2
            if not now <= worth:
                break  # as low as sums can tell
            at, here = at + step, there
            if np.abs(step).max() <= 1e-9 * max(1.0, np.abs(at).max()):
                break
        else:
            warnings.warn(f"LogLink stopped after {ITERATIONS} iterations", stacklevel=2)
        slopes = at[1:] / scale
        return LogLinkModel(slopes, float(at[0] - (slopes * centre).sum()))


class LogLinkModel(Model):
    def __init__(self, coefficients: np.ndarray, intercept: float):
        super().__init__()
        self.coefficients, self.intercept = coefficients, intercept

    def _transform(self, df: DataFrame) -> DataFrame:
        line = F.lit(self.intercept)
        for i, c in enumerate(self.coefficients):
            line = line + F.element_at(vector_to_array("features"), i + 1) * F.lit(float(c))
        return df.withColumn("prediction", F.exp(line))


def _log_sums(rows: DataFrame, at: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray]:
    """Squared errors, weights, the weighted moments of the columns (a constant first) and what the
    errors add to each, all summed over the rows."""
    p = len(at)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 + p * p + p)
        with np.errstate(over="ignore", invalid="ignore"):
            for batch in batches:
                y = batch.column("y").to_numpy()
                data = batch.column("x").flatten().to_numpy().reshape(len(y), p - 1)
                x = np.concatenate([np.ones((len(y), 1)), (data - centre) / scale], axis=1)
                mu = np.exp(x @ at)
                wide, miss = x * mu[:, None], y - mu
                total += np.concatenate([[(miss**2).sum(), (mu**2).sum()], (wide.T @ wide).ravel(), wide.T @ miss])
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], ["sums"])

    parts = [r[0] for r in rows.mapInArrow(add, "sums array<double>").collect()]
    total = np.sum(parts, axis=0)
    return total[0], total[1], total[2 : 2 + p * p].reshape(p, p), total[2 + p * p :]


def linear_clf(loss: str = "log", c: float = 1.0) -> Estimator:
    """Linear classifier with logistic, hinge or squared loss; ``c`` weighs the sum of losses."""

    def build(penalty: float) -> Estimator:
        if loss == "log":
            return LogisticRegression(family="multinomial", regParam=penalty, elasticNetParam=0.0, maxIter=ITERATIONS)
        if loss == "hinge":
            return OneVsRest(classifier=LinearSVC(regParam=penalty, maxIter=ITERATIONS), parallelism=3)
        if loss == "squared":
            return LeastSquaresClassifier(alpha=penalty)
        raise ValueError(f"unknown loss {loss!r}")

    build(1.0)
    return Penalised(build, c)


class LeastSquaresClassifier(Estimator):
    """One least-squares fit per class against its 0/1 indicator; the highest output wins."""

    def __init__(self, alpha: float = 0.0):
        super().__init__()
        self.alpha = alpha

    def _fit(self, df: DataFrame) -> Model:
        classes = sorted(r[0] for r in df.select("label").distinct().collect())
        fits = []
        for i, c in enumerate(classes):
            rows = df.select("features", (F.col("label") == c).cast("double").alias("label"))
            fits.append(linear(self.alpha).setPredictionCol(f"__out{i}").fit(rows))
        return HighestOutput(classes, fits)


class HighestOutput(Model):
    def __init__(self, classes, fits):
        super().__init__()
        self.classes, self.fits = classes, fits

    def _transform(self, df: DataFrame) -> DataFrame:
        out = df
        for m in self.fits:
            out = m.transform(out)
        best = F.array(*(F.struct(F.col(f"__out{i}").alias("out"), F.lit(-float(c)).alias("c")) for i, c in enumerate(self.classes)))
        return out.select(*df.columns, (-F.array_max(best)["c"]).alias("prediction"))


# ---- support vectors -----------------------------------------------------------------------------


def svm(
    task: str, kernel: str = "rbf", c: float = 1.0, gamma: float | str = "scale", n_features: int = 128, epsilon: float = 0.1
) -> margins.SupportVectors:
    """Support vectors: hinge loss for classes, the epsilon-insensitive loss for regression; the RBF
    kernel goes through landmarks. ``c`` weighs the sum of losses. Inputs are standardised, so
    ``gamma`` "scale" and "auto" are both one over their number."""
    return margins.SupportVectors(task, kernel, c, 0.0 if gamma in ("scale", "auto") else float(gamma), n_features, epsilon)


def sgd_clf(loss: str = "hinge", alpha: float = 1e-4) -> margins.StochasticLinear:
    """Linear classes by stochastic gradients: hinge, log or squared loss."""
    return margins.StochasticLinear(loss, alpha)


# ---- trees ---------------------------------------------------------------------------------------


def tree(task: str, max_depth: int | None = None, min_split: int = 2, seed: int = 42, **extra) -> Estimator:
    """Decision tree; the least rows to split become the least rows in a leaf (half of them)."""
    kind = DecisionTreeRegressor if task == "regression" else DecisionTreeClassifier
    return kind(maxDepth=_depth(max_depth), minInstancesPerNode=max(1, min_split // 2), seed=seed, **extra)


def forest(
    task: str,
    n: int = 100,
    max_depth: int | None = None,
    min_leaf: int = 1,
    min_split: int = 2,
    bootstrap: bool = True,
    seed: int = 42,
    **extra,
) -> Estimator:
    """Random forest; the least rows to split are half as many in a leaf, as for ``tree``."""
    kind = RandomForestRegressor if task == "regression" else RandomForestClassifier
    # Deep trees have many nodes at a level: with more room for statistics a pass over the rows grows
    # more of them, and kept node numbers save walking each row down from the root.
    extra = {"maxMemoryInMB": 1024, "cacheNodeIds": True} | extra
    return kind(
        numTrees=n, maxDepth=_depth(max_depth), minInstancesPerNode=max(min_leaf, min_split // 2), bootstrap=bootstrap, seed=seed, **extra
    )


def random_subspace_forest(task: str, n: int = 100, max_depth: int | None = None, bins: int = 8, seed: int = 42, **extra) -> Estimator:
    """Stands in for extremely randomised trees: all rows, few split points, column subsets."""
    return forest(task, n, max_depth, bootstrap=False, seed=seed, maxBins=bins, featureSubsetStrategy="onethird", **extra)


def gbt(
    task: str,
    n: int = 100,
    rate: float = 0.1,
    max_depth: int = 3,
    min_leaf: int = 1,
    subsample: float = 1.0,
    columns: str | float = "all",
    loss: str = "squared",
    seed: int = 42,
    **extra,
) -> Estimator:
    """Histogram gradient boosting; three classes through one model per class."""
    args = dict(
        maxIter=n,
        stepSize=rate,
        maxDepth=_depth(max_depth),
        minInstancesPerNode=min_leaf,
        subsamplingRate=subsample,
        featureSubsetStrategy=str(columns),
        seed=seed,
        **extra,
    )
    if task == "regression":
        return GBTRegressor(lossType=loss, **args)
    return OneVsRest(classifier=GBTClassifier(**args), parallelism=3)


def gaussian_nb() -> NaiveBayes:
    return NaiveBayes(modelType="gaussian")


# ---- nearest neighbours --------------------------------------------------------------------------


def knn_predict(
    train: DataFrame,
    test: DataFrame,
    k: int,
    cols,
    key: str,
    label: str,
    task: str,
    weights: str = "uniform",
) -> DataFrame:
    """``key, prediction`` per test row: mean (regression) or vote (ties to the lowest class)."""
    base = train.select(key, *cols, col(label).cast("double").alias("__y"))
    return knn_vote(knn_join(test, base, k, cols, key, carry=["__y"]), key, task, weights)


def knn_vote(found: DataFrame, key: str, task: str, weights: str = "uniform") -> DataFrame:
    """The prediction that the neighbours found (with their labels ``__y``) give each query."""
    if weights == "distance":
        nearest = found.withColumn("__min", F.col("distance") == 0)
        hits = nearest.groupBy("query").agg(F.bool_or("__min").alias("__exact"))
        found = nearest.join(hits, "query")
        weight = F.when(F.col("__exact"), F.col("__min").cast("double")).otherwise(1 / F.nullif("distance", F.lit(0.0)))
    elif weights == "uniform":
        weight = F.lit(1.0)
    else:
        raise ValueError(f"unknown weights {weights!r}")
    weighed = found.withColumn("__w", weight).where(F.col("__w") > 0)
    if task == "regression":
        out = weighed.groupBy("query").agg((F.sum(F.col("__w") * F.col("__y")) / F.sum("__w")).alias("prediction"))
    else:
        votes = weighed.groupBy("query", "__y").agg(F.sum("__w").alias("__w"))
        out = votes.groupBy("query").agg(F.max_by("__y", F.struct("__w", -F.col("__y"))).alias("prediction"))
    return out.withColumnRenamed("query", key)


class Neighbours(Estimator):
    """The nearest-neighbour join as an estimator; rows need a unique key column."""

    def __init__(self, task: str, k: int = 5, weights: str = "uniform", key: str = "company_id"):
        super().__init__()
        self.task, self.k, self.weights, self.key = task, k, weights, key

    def _fit(self, df: DataFrame) -> Model:
        return NeighboursModel(self, df.select(self.key, "label", vector_to_array("features").alias("__x")))


class NeighboursModel(Model):
    def __init__(self, spec: Neighbours, train: DataFrame):
        super().__init__()
        self.spec, self.train = spec, train

    def _transform(self, df: DataFrame) -> DataFrame:
        """A row that shares no column with any training row gets the mean label or commonest class."""
        s = self.spec
        test = df.select(s.key, vector_to_array("features").alias("__x"))
        found = knn_predict(self.train, test, s.k, ["__x"], s.key, "label", s.task, s.weights)
        return self.with_usual(df, found)

    def with_usual(self, df: DataFrame, found: DataFrame) -> DataFrame:
        s = self.spec
        usual = F.avg("label") if s.task == "regression" else F.mode("label", deterministic=True).cast("double")
        usual = self.train.agg(usual).first()[0]
        return df.join(found, s.key, "left").withColumn("prediction", F.coalesce("prediction", F.lit(usual)))


def score_neighbours(train: DataFrame, test: DataFrame, specs: Sequence[Neighbours], judge: Evaluator) -> list[float]:
    """The score of each estimator, of one task and key: those with fewer neighbours take the first of
    the most, so the rows are searched once for all."""
    task, key = specs[0].task, specs[0].key
    base = train.select(key, vector_to_array("features").alias("__x"), F.col("label").cast("double").alias("__y"))
    asked = test.select(key, vector_to_array("features").alias("__x"))
    with temporary(train.sparkSession):
        found = settle(knn_join(asked, base, max(s.k for s in specs), ["__x"], key, carry=["__y"]))
        scores = []
        for s in specs:
            votes = knn_vote(found.where(F.col("rank") <= s.k), key, task, s.weights)
            scores.append(judge.evaluate(s.fit(train).with_usual(test, votes)))
    return scores


# ---- fit and score -------------------------------------------------------------------------------


def fit_score_reg(est: Estimator, train: DataFrame, test: DataFrame, forward=None, inverse=None) -> DataFrame:
    """Fit on the transformed label, undo the transform on the predictions, score on the original scale."""
    rows = train if forward is None else train.withColumn("label", forward(F.col("label")))
    predicted = est.fit(rows).transform(test)
    if inverse is not None:
        predicted = predicted.withColumn("prediction", inverse(F.col("prediction")))
    return regression_metrics(predicted, "label", "prediction")


def fit_score_clf(est: Estimator, train: DataFrame, test: DataFrame) -> DataFrame:
    return classification_metrics(est.fit(train).transform(test), "label", "prediction")
