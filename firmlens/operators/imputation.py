"""Filling missing numbers from neighbours or medians, and missing text from models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from firmlens.functions.columns import any_null, col, cols_of, null_columns
from firmlens.operators.knn import knn_join
from firmlens.operators.quantiles import exact_quantiles
from firmlens.operators.splitting import split
from firmlens.session import hold, settle

# Column groups imputed together, in this order; profit_margin is in two of them.
FEATURE_GROUPS = {
    "results": (
        "operating_result", "financial_result", "net_result", "taxes", "debt", "sales", "profit_margin",
    ),
    "profitability": (
        "economic_return", "financial_return", "return_on_capital", "return_on_assets", "return_on_equity",
        "profit_margin",
    ),
    "resources": (
        "fixed_assets", "amort", "current_assets", "total_assets", "equity", "noncurrent_liab", "current_liab",
        "total_liab_equity", "value_added", "staff_cost_ratio", "inventory", "payables", "working_capital",
    ),
    "liquidity": (
        "cash", "cash_flow", "collection_days", "general_liquidity", "liquidity_ratio", "solvency_ratio",
        "solvency_coefficient", "interest_cover",
    ),
    "asset_turnover": (
        "net_asset_turnover", "inventory_turnover", "ratio_sales_assets", "ratio_sales_ebitda",
        "ratio_sales_equity", "ratio_collection_days", "ratio_acid_test", "ratio_debt_assets",
    ),
    "leverage": (
        "ratio_debt_ebitda", "ratio_debt_equity", "ratio_ebitda_assets", "ratio_ebitda_equity", "gearing",
        "indebtedness", "financial_autonomy",
    ),
}


def impute_knn(df: DataFrame, key: str, cols: Sequence[str], k: int = 10, weights: str = "distance") -> DataFrame:
    """Fill each missing cell from the ``k`` nearest rows that have the column.

    Weights are inverse distances; neighbours at distance 0 take all the weight. A cell without
    any comparable row gets the column mean; a column without any value stays missing. The table is written once, since it is
    searched, averaged and filled.
    """
    if weights not in ("distance", "uniform"):
        raise ValueError(f"unknown weights {weights!r}")
    cols = list(cols)
    df = settle(df)
    gaps = F.filter(
        F.array(*(F.when(col(c).isNull(), F.lit(i)) for i, c in enumerate(cols))), lambda i: i.isNotNull()
    )
    receivers = df.where(any_null(cols)).select(key, *(col(c) for c in cols), F.explode(gaps).alias("__need"))
    found = knn_join(receivers, df, k, cols, key, need="__need")
    if weights == "distance":
        exact = F.col("distance") == 0
        weighted = F.try_divide(
            F.sum(F.when(~exact, F.col("value") / F.nullif("distance", F.lit(0.0)))),
            F.sum(F.when(~exact, 1 / F.nullif("distance", F.lit(0.0)))),
        )
        estimate = F.coalesce(F.avg(F.when(exact, F.col("value"))), weighted)
    else:
        estimate = F.avg("value")
    cells = found.groupBy("query", "need").agg(estimate.alias("v"))
    wide = cells.groupBy(F.col("query").alias(key)).agg(
        *(F.max(F.when(F.col("need") == i, F.col("v"))).alias(f"__fill{i}") for i in range(len(cols)))
    )
    means = df.agg(*(F.avg(col(c)).alias(str(i)) for i, c in enumerate(cols))).first()
    filled = {c: F.coalesce(col(c), F.col(f"__fill{i}"), F.lit(means[i])) for i, c in enumerate(cols)}
    joined = df.join(wide, key, "left")
    return joined.select(*(filled[c].alias(c) if c in filled else col(c) for c in df.columns))


def impute_groups(df: DataFrame, key: str, groups: Sequence[Sequence[str]], k: int = 10) -> DataFrame:
    """Impute column groups one after the other; a later group sees the earlier fills."""
    for group in groups:
        present = [c for c in group if c in df.columns]
        if present:
            df = impute_knn(df, key, present, k)
    return df


def impute_remaining(df: DataFrame, key: str, skip: Sequence[str] = (), k: int = 10) -> DataFrame:
    """A last neighbour pass over every numeric column that still misses cells."""
    numeric = set(cols_of(df, "numeric")) - {key, *skip}
    left = [c for c in null_columns(df) if c in numeric]
    return impute_knn(df, key, left, k) if left else df


def impute_median(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Fill both tables with the exact medians of the first."""
    medians = {c: q[0] for c, q in exact_quantiles(train, cols, [0.5]).items()}

    def fill(df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(col(c).cast("double"), F.lit(m).cast("double")) for c, m in medians.items()})

    return fill(train), fill(test)


def impute_by_model(
    df: DataFrame, target_cols: Sequence[str], predictors: Sequence[str], key: str, seed: int = 42, trees: int = 100, rounds: int = 20
) -> DataFrame:
    """Fill text columns with the better of a random forest and boosted trees.

    Both are scored by accuracy on a 20 % hold-out of the complete rows (a tie goes to the forest);
    the winner is fitted again on all rows that have the column and predicts the others.
    """
    for name in target_cols:
        df = settle(df)
        known = df.where(col(name).isNotNull())
        unknown = df.where(col(name).isNull())
        train, unknown = impute_median(known, unknown, predictors)
        indexer = StringIndexer(inputCol=name, outputCol="__label", stringOrderType="alphabetAsc").fit(known)
        assembler = VectorAssembler(inputCols=list(predictors), outputCol="__features")
        rows = hold(assembler.transform(indexer.transform(train)))
        complete = rows.join(known.dropna(subset=list(predictors)).select(key), key, "left_semi")
        fit_rows, test_rows = split(complete, key, 0.2, seed)
        args = dict(labelCol="__label", featuresCol="__features", predictionCol="__pred")
        forest = RandomForestClassifier(numTrees=trees, seed=seed, **args)
        boosted = OneVsRest(classifier=GBTClassifier(maxIter=rounds, seed=seed, labelCol="__label", featuresCol="__features"), parallelism=4, **args)
        judge = MulticlassClassificationEvaluator(labelCol="__label", predictionCol="__pred", metricName="accuracy")
        scores = [judge.evaluate(est.fit(fit_rows).transform(test_rows)) for est in (forest, boosted)]
        best = forest if scores[0] >= scores[1] else boosted
        decode = IndexToString(inputCol="__pred", outputCol="__text", labels=indexer.labels)
        model = Pipeline(stages=[best, decode]).fit(rows)
        rows.unpersist()
        fills = model.transform(assembler.transform(unknown)).select(key, "__text")
        joined = df.join(fills, key, "left")
        df = joined.select(*(F.coalesce(col(c), F.col("__text")).alias(c) if c == name else col(c) for c in df.columns))
    return df
