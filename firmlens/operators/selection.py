"""Feature selection: correlation, F-tests, forest importance, recursive elimination, comparisons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from firmlens.functions.columns import col
from firmlens.operators import grown, models
from firmlens.operators.encoding import minmax, standardize
from firmlens.operators.profile import corr_with
from firmlens.operators.splitting import split
from firmlens.session import hold, temporary

#: The column that bootstraps are drawn by.
DRAW = "__draw"
# Correlation and importance thresholds of the fused and the two-year tables.
CORR_THRESHOLDS = {"regression": 0.15, "regression_two_year": 0.20, "class": 0.04, "class_two_year": 0.08}
IMPORTANCE_THRESHOLDS = {"regression": 0.01, "regression_two_year": 0.02, "class": 0.017, "class_two_year": 0.017}


def select_by_corr(
    df: DataFrame, target: str, threshold: float, names: Sequence[str] | None = None, digits: int | None = None
) -> list[str]:
    """Columns whose correlation with the target exceeds the threshold in size, largest first; with
    ``digits``, sizes that are equal when rounded are in order of their names."""
    rows = corr_with(df, target, names).where(F.abs("corr") > threshold).collect()

    def place(r):
        size = abs(r["corr"])
        return -(size if digits is None else round(size, digits)), r["variable"]

    return [r["variable"] for r in sorted(rows, key=place)]


def f_regression(df: DataFrame, target: str, names: Sequence[str], k: int | None = 20) -> DataFrame:
    """``F = r^2 / (1 - r^2) * (n - 2)`` per column over rows that have both, best ``k``."""
    names = [c for c in names if c != target]
    wide = df.agg(
        *(F.corr(_both(c, target), _both(target, c)).alias(f"r{i}") for i, c in enumerate(names)),
        *(F.count(_both(c, target)).alias(f"n{i}") for i, c in enumerate(names)),
    )
    entries = F.array(
        *(F.struct(F.lit(c).alias("variable"), F.col(f"r{i}").alias("r"), F.col(f"n{i}").alias("n")) for i, c in enumerate(names))
    )
    r2 = F.nanvl("r", F.lit(None).cast("double")) * F.col("r")
    scored = wide.select(F.inline(entries)).select(
        "variable", "n", (F.try_divide(r2, 1 - r2) * (F.col("n") - 2)).alias("f")
    )
    return _best(scored, k)


def _both(name: str, other: str):
    return F.when(col(name).isNotNull() & col(other).isNotNull(), col(name).cast("double"))


def f_classif(df: DataFrame, label: str, names: Sequence[str], k: int | None = 20) -> DataFrame:
    """One-way analysis of variance per column, best ``k``.

    One grouped aggregate gives size, mean and variance per class; the F value is arithmetic on
    that table of a few rows.
    """
    names = [c for c in names if c != label]
    stats = []
    for i, c in enumerate(names):
        x = col(c).cast("double")
        stats += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}")]
    classes = df.where(col(label).isNotNull()).groupBy(label).agg(*stats).collect()
    rows = []
    for i, c in enumerate(names):
        parts = [(r[f"n{i}"], r[f"m{i}"], r[f"v{i}"]) for r in classes if r[f"n{i}"]]
        n, groups = sum(p[0] for p in parts), len(parts)
        f = None
        if groups > 1 and n > groups:
            mean = sum(p[0] * p[1] for p in parts) / n
            between = sum(p[0] * (p[1] - mean) ** 2 for p in parts) / (groups - 1)
            inside = sum(p[0] * p[2] for p in parts) / (n - groups)
            f = between / inside if inside > 0 else None
        rows.append((c, n, f))
    return _best(df.sparkSession.createDataFrame(rows, "variable string, n long, f double"), k)


def _best(scored: DataFrame, k: int | None) -> DataFrame:
    ordered = scored.orderBy(F.desc_nulls_last("f"), "variable")
    return ordered if k is None else ordered.limit(k)


def assemble(df: DataFrame, names: Sequence[str], target: str, *keep: str) -> DataFrame:
    """``features`` and ``label`` columns of the rows that have all of them."""
    rows = df.select(*keep, *(col(c).cast("double").alias(c) for c in names), col(target).cast("double").alias("label"))
    rows = rows.dropna()
    return VectorAssembler(inputCols=list(names), outputCol="features").transform(rows).select(*keep, "features", "label")


def _draw(names: Sequence[str], target: str, key: str | None) -> Column:
    """What bootstraps are drawn by: the values of a row, and its key if it has one."""
    return F.xxhash64(*(col(c) for c in dict.fromkeys([*([key] if key else []), target, *names]))).alias(DRAW)


def _importances(rows: DataFrame, names: Sequence[str], target: str, task: str, trees: int, seed: int) -> dict[str, float]:
    with temporary(rows.sparkSession):
        model = grown.Forest(task, trees, columns="spark", seed=seed, key=DRAW).fit(assemble(rows, names, target, DRAW))
        return dict(zip(names, map(float, model.importances())))


def importances(
    df: DataFrame, target: str, names: Sequence[str], task: str, trees: int = 100, seed: int = 42, key: str | None = None
) -> dict[str, float]:
    """Random forest importance per column."""
    return _importances(df.select("*", _draw(names, target, key)), names, target, task, trees, seed)


def select_by_importance(
    df: DataFrame, target: str, threshold: float, names: Sequence[str], task: str, trees: int = 100, seed: int = 42, key: str | None = None
) -> list[str]:
    """Columns whose forest importance exceeds the threshold."""
    return [c for c, v in importances(df, target, names, task, trees, seed, key).items() if v > threshold]


def rfe(
    df: DataFrame, target: str, names: Sequence[str], task: str, n: int = 20, step: int = 1, trees: int = 100, seed: int = 42,
    key: str | None = None,
) -> list[str]:
    """Drop the ``step`` least important columns and refit until ``n`` are left."""
    left = list(names)
    rows = hold(df.select(_draw(left, target, key), target, *left).dropna())
    try:
        while len(left) > n:
            scores = _importances(rows, left, target, task, trees, seed)
            drop = sorted(left, key=lambda c: (scores[c], c))[: min(step, len(left) - n)]
            left = [c for c in left if c not in drop]
    finally:
        rows.unpersist()
    return left


def base_score(df: DataFrame, names: Sequence[str], target: str, key: str, task: str, trees: int = 100, seed: int = 42) -> float:
    """R2 or accuracy of a plain forest on a 30 % hold-out."""
    with temporary(df.sparkSession):
        rows = hold(assemble(df, names, target, key))
        train, test = split(rows, key, 0.3, seed)
        fitted = grown.Forest(task, trees, columns="spark", seed=seed, key=key).fit(train)
        score = models.evaluator(task).evaluate(fitted.transform(test))
        rows.unpersist()
    return score


def best_feature_set(
    df: DataFrame, sets: Mapping[str, Sequence[str]], target: str, key: str, task: str, trees: int = 100, seed: int = 42
) -> DataFrame:
    """Base score of every candidate set (the target is never among the features), best first."""
    used = hold(df.select(key, target, *dict.fromkeys(c for cs in sets.values() for c in cs if c != target)))
    rows = [
        (name, len(cols), base_score(used, cols, target, key, task, trees, seed))
        for name, cols in ((n, [c for c in cs if c != target]) for n, cs in sets.items())
    ]
    used.unpersist()
    out = df.sparkSession.createDataFrame(rows, "candidate string, n_features int, score double")
    return out.orderBy(F.desc("score"), "candidate")


def scalings(df: DataFrame, names: Sequence[str]) -> dict[str, DataFrame]:
    return {"raw": df, "standard": standardize(df, names), "minmax": minmax(df, names)}


def best_scaling(
    df: DataFrame, names: Sequence[str], target: str, key: str, task: str, trees: int = 100, seed: int = 42
) -> DataFrame:
    """Base score of the raw, standardised and min-max scaled table, best first."""
    used = hold(df.select(key, target, *names))
    rows = [(kind, base_score(d, names, target, key, task, trees, seed)) for kind, d in scalings(used, names).items()]
    used.unpersist()
    out = df.sparkSession.createDataFrame(rows, "scaling string, score double")
    return out.orderBy(F.desc("score"), "scaling")


def leaderboard(
    tables: Mapping[str, tuple[DataFrame, Sequence[str]]],
    target: str,
    key: str,
    candidates: Mapping[str, object],
    task: str,
    prepare=None,
    seed: int = 42,
    threads: int = 4,
) -> DataFrame:
    """Every column set, raw and scaled both ways, against every model, best score first.

    ``tables``: name -> (table, feature columns). ``prepare``: a function applied to the train rows
    only (resampling). Fits are independent Spark jobs, so a few run at the same time.
    """
    jobs = []
    held = []
    for name, (df, names) in tables.items():
        used = hold(df.select(key, target, *names).dropna())
        held.append(used)
        for kind, scaled in scalings(used, names).items():
            train, test = split(scaled, key, 0.2 if task == "regression" else 0.3, seed)
            train = train if prepare is None else prepare(train, names)
            train = hold(assemble(train, names, target, key))
            test = hold(assemble(test, names, target, key))
            held += [train, test]
            jobs += [(name, kind, model, est, train, test) for model, est in candidates.items()]

    def run(job):
        name, kind, model, est, train, test = job
        with temporary(train.sparkSession):
            fitted = est.copy().fit(train)
            return name, kind, model, float(models.evaluator(task).evaluate(fitted.transform(test)))

    with ThreadPool(threads) as pool:
        rows = pool.map(run, jobs, chunksize=1)
    spark = held[0].sparkSession
    for d in held:
        d.unpersist()
    out = spark.createDataFrame(rows, "dataset string, scaling string, model string, score double")
    return out.orderBy(F.desc("score"), "dataset", "scaling", "model")
