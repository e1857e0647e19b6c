"""Scores of predictions, each from one grouped aggregate."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from firmlens.functions.columns import col

EPS = 2.220446049250313e-16


def regression_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """R2, MSE, RMSE, MAE and MAPE over rows that have both values."""
    rows = df.where(col(y).isNotNull() & col(yhat).isNotNull())
    err = col(y) - col(yhat)
    sums = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(err * err).alias("mse"),
        F.avg(F.abs(err)).alias("mae"),
        F.avg(F.abs(err) / F.greatest(F.abs(col(y)), F.lit(EPS))).alias("mape"),
        F.var_pop(col(y)).alias("__var"),
    )
    return sums.select(
        "n",
        (1 - F.try_divide(F.col("mse"), F.col("__var"))).alias("r2"),
        "mse",
        F.sqrt("mse").alias("rmse"),
        "mae",
        "mape",
    )


def confusion_matrix(df: DataFrame, y: str, yhat: str, labels: Sequence[int] = (0, 1, 2)) -> DataFrame:
    """Rows: true class; columns ``pred_<label>``: number of predictions."""
    cells = [F.count_if(col(yhat) == lab).alias(f"pred_{lab}") for lab in labels]
    return df.where(col(y).isNotNull()).groupBy(col(y).alias("actual")).agg(*cells)


def accuracy(df: DataFrame, y: str, yhat: str) -> DataFrame:
    return df.agg(F.avg((col(y) == col(yhat)).cast("double")).alias("accuracy"))


def classification_metrics(df: DataFrame, y: str, yhat: str, labels: Sequence[int] = (0, 1, 2)) -> DataFrame:
    """Per class, macro and weighted precision, recall, F1 and support, plus the accuracy row.

    One aggregate of a few counts; the rest is arithmetic on its single row.
    """
    counts = []
    for lab in labels:
        counts += [
            F.count_if((col(y) == lab) & (col(yhat) == lab)).alias(f"tp{lab}"),
            F.count_if(col(yhat) == lab).alias(f"pp{lab}"),
            F.count_if(col(y) == lab).alias(f"n{lab}"),
        ]
    wide = df.agg(*counts, F.count_if(col(y) == col(yhat)).alias("hit"), F.count(col(y)).alias("n"))

    def ratio(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    per = {}
    for lab in labels:
        p, r = ratio(F.col(f"tp{lab}"), F.col(f"pp{lab}")), ratio(F.col(f"tp{lab}"), F.col(f"n{lab}"))
        f1 = ratio(2 * F.col(f"tp{lab}"), F.col(f"pp{lab}") + F.col(f"n{lab}"))
        per[lab] = (p, r, f1, F.col(f"n{lab}"))

    def mean(i, weighted):
        if weighted:
            return ratio(reduce(lambda a, b: a + b, (v[i] * v[3] for v in per.values())), F.col("n"))
        return reduce(lambda a, b: a + b, (v[i] for v in per.values())) / len(per)

    def entry(name, p, r, f1, n):
        return F.struct(
            F.lit(name).alias("class"),
            p.alias("precision"),
            r.alias("recall"),
            f1.alias("f1"),
            n.cast("long").alias("support"),
        )

    hit = ratio(F.col("hit"), F.col("n"))
    rows = [entry(str(lab), *per[lab]) for lab in labels]
    rows.append(entry("macro", *(mean(i, False) for i in range(3)), F.col("n")))
    rows.append(entry("weighted", *(mean(i, True) for i in range(3)), F.col("n")))
    rows.append(entry("accuracy", hit, hit, hit, F.col("n")))
    return wide.select(F.inline(F.array(*rows)))
