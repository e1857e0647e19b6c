"""Queries on neighbours, class balance, feature selection, models, metrics and scoring."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from firmlens.functions import measures as M
from firmlens.functions.text import decode_class
from firmlens.operators import balance, ensembles, grown, imputation, metrics, models, profile, scoring, selection, tuning
from firmlens.operators.knn import knn_join
from firmlens.operators.splitting import split
from firmlens.plans.cleaning import RESOURCES, company_years, rounded
from firmlens.plans.growth import with_gaps
from firmlens.plans.registry import query
from firmlens.plans.views import (
    BOTH,
    EARLIER,
    FEATURES,
    LATER,
    companies,
    cte,
    model_table,
    oracle,
    prepared,
    scoring_table,
    table,
)
from firmlens.session import hold, scratch_path, settle
from firmlens.sources.models import load_model, save_model

# The collection period of the bound tables is constant up to rounding, hence no feature.
STATEMENT_SET = tuple(c for c in FEATURES if c != "ratio_collection_days")
NUMBERS = (*STATEMENT_SET, "total_funding")
SMALL_SET = ("sales", "debt", "inventory", "total_funding", "ratio_acid_test")
SETS = {
    "all": NUMBERS,
    "ratios": tuple(c for c in STATEMENT_SET if c.startswith("ratio")),
    "balance": ("fixed_assets", "current_assets", "equity", "current_liab", "noncurrent_liab"),
}

# ---- nearest neighbours --------------------------------------------------------------------------

EMBEDDING_DISTANCE = "list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"


def _near_embeddings(k: int) -> str:
    return (
        f"near AS (SELECT a.vec_id AS query, b.vec_id AS neighbour, a.label AS own, b.label AS other, {EMBEDDING_DISTANCE} AS distance, "
        f"row_number() OVER (PARTITION BY a.vec_id ORDER BY {EMBEDDING_DISTANCE}, b.vec_id) AS rank "
        f"FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id QUALIFY rank <= {k})"
    )


_EMBEDDINGS_SQL = f"WITH {_near_embeddings(5)} SELECT query, neighbour, other AS label, round(distance, 8) AS distance, CAST(rank AS INTEGER) AS rank FROM near"


def _embeddings(spark, d, **how) -> DataFrame:
    df = table(spark, d, "embeddings")
    found = knn_join(df, df, 5, ["embedding"], "vec_id", exclude_self=True, carry=["label"], **how)
    return found.select("query", "neighbour", "label", F.round("distance", 8).alias("distance"), "rank")


@query("nearest_embeddings", _EMBEDDINGS_SQL)
def nearest_embeddings(spark, d):
    return _embeddings(spark, d)


@query("nearest_embeddings_leaves", _EMBEDDINGS_SQL)
def nearest_embeddings_leaves(spark, d):
    """The way that a base takes which is too big to broadcast."""
    return _embeddings(spark, d, small_rows=0, leaf_rows=256)


_SEEN = " + ".join(f"(a.{c} IS NOT NULL AND b.{c} IS NOT NULL)::INT" for c in RESOURCES)
_SUM = " + ".join(f"coalesce((a.{c} - b.{c}) * (a.{c} - b.{c}), 0)" for c in RESOURCES)


_COMPANIES_SQL = oracle(
    f"p AS (SELECT a.company_year AS query, b.company_year AS neighbour, {_SEEN} AS seen, {_SUM} AS total "
    "FROM cy a JOIN cy b ON a.company_year <> b.company_year), "
    f"n AS (SELECT query, neighbour, sqrt(CASE WHEN seen = {len(RESOURCES)} THEN total ELSE total / seen * {len(RESOURCES)} END) "
    "AS distance FROM p WHERE seen > 0), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, neighbour) AS rank FROM n QUALIFY rank <= 3) "
    "SELECT query, neighbour, round(distance, 4) AS distance, CAST(rank AS INTEGER) AS rank FROM r",
    "cy",
)


def _near_companies(spark, d, **how) -> DataFrame:
    df = company_years(spark, d)
    found = knn_join(df, df, 3, RESOURCES, "company_year", exclude_self=True, **how)
    return found.select("query", "neighbour", F.round("distance", 4).alias("distance"), "rank")


@query("nearest_companies", _COMPANIES_SQL)
def nearest_companies(spark, d):
    return _near_companies(spark, d)


@query("nearest_companies_leaves", _COMPANIES_SQL)
def nearest_companies_leaves(spark, d):
    """The way that a base takes which is too big to broadcast."""
    return _near_companies(spark, d, small_rows=0, leaf_rows=512)


# ---- class balance -------------------------------------------------------------------------------


cte("mtc", f"SELECT * FROM mt WHERE {' AND '.join(f'{c} IS NOT NULL' for c in SMALL_SET)}", "mt")


def complete(spark, d) -> DataFrame:
    """Companies with all features of the small set, written once for train and test."""
    df = model_table(spark, d).select("company_id", "acq_class", "valuation", *SMALL_SET)
    return settle(df.dropna(subset=list(SMALL_SET)))


def filled(spark, d) -> DataFrame:
    """Every company, with missing features of the small set from its nearest neighbours."""
    df = model_table(spark, d).select("company_id", "acq_class", "valuation", *SMALL_SET)
    return settle(imputation.impute_knn(df, "company_id", SMALL_SET))


def labelled(spark, d) -> DataFrame:
    return model_table(spark, d).select("company_id", "acq_class", *SMALL_SET).dropna()


_NEAR_CLASS = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in SMALL_SET)
cte(
    "near5",
    f"SELECT a.company_id, b.company_id AS other, row_number() OVER (PARTITION BY a.company_id ORDER BY sqrt({_NEAR_CLASS}), b.company_id) "
    "AS rank FROM mtc a JOIN mtc b ON a.company_id <> b.company_id AND a.acq_class = b.acq_class QUALIFY rank <= 5",
    "mtc",
)
cte(
    "grown",
    "WITH sizes AS (SELECT acq_class, count(*) AS n FROM mtc GROUP BY 1), goal AS (SELECT max(n) AS goal FROM sizes), "
    "spread AS (SELECT m.*, goal - n AS gap, n, row_number() OVER (PARTITION BY m.acq_class ORDER BY md5('0|' || company_id::VARCHAR)) - 1 AS r "
    "FROM mtc m JOIN sizes USING (acq_class), goal), "
    "copies AS (SELECT s.*, unnest(range(CAST(gap // n + (r < gap % n)::INT AS BIGINT))) AS copy FROM spread s WHERE gap > 0), "
    "drawn AS (SELECT *, md5('0|' || company_id::VARCHAR || '|' || copy::VARCHAR) AS h FROM copies), "
    "words AS (SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS w1, CAST('0x' || substr(h, 9, 8) AS BIGINT) / 4294967296.0::DOUBLE AS step FROM drawn) "
    "SELECT company_id::VARCHAR AS company_id, acq_class, "
    + ", ".join(SMALL_SET)
    + ", false AS synthetic FROM mtc UNION ALL SELECT w.company_id::VARCHAR || '#' || copy::VARCHAR, w.acq_class, "
    + ", ".join(f"w.{c} + step * (o.{c} - w.{c})" for c in SMALL_SET)
    + ", true FROM words w JOIN near5 k ON k.company_id = w.company_id AND k.rank = w1 % 5 + 1 JOIN mtc o ON o.company_id = k.other",
    "mtc",
    "near5",
)


@query("smote", oracle(f"SELECT company_id, acq_class, {', '.join(SMALL_SET)}, synthetic FROM grown", "grown"))
def smote(spark, d):
    return balance.smote(labelled(spark, d), "acq_class", SMALL_SET, "company_id")


@query(
    "smote_enn",
    oracle(
        f"p AS (SELECT a.company_id AS query, a.acq_class AS own, b.acq_class AS other, row_number() OVER (PARTITION BY a.company_id "
        f"ORDER BY sqrt({_NEAR_CLASS}), b.company_id) AS rank FROM grown a JOIN grown b ON a.company_id <> b.company_id QUALIFY rank <= 3) "
        f"SELECT company_id, acq_class, {', '.join(SMALL_SET)}, synthetic FROM grown JOIN (SELECT query FROM p GROUP BY query "
        "HAVING bool_and(own = other)) ON query = company_id",
        "grown",
    ),
)
def smote_enn(spark, d):
    return balance.smote_enn(labelled(spark, d), "acq_class", SMALL_SET, "company_id")


@query(
    "edited_neighbours",
    f"WITH {_near_embeddings(1)} SELECT vec_id, label FROM embeddings JOIN "
    "(SELECT query FROM near GROUP BY query HAVING bool_and(own = other)) ON query = vec_id",
)
def edited_neighbours(spark, d):
    return balance.enn(table(spark, d, "embeddings"), "label", ["embedding"], "vec_id", k=1).select("vec_id", "label")


@query(
    "edited_companies",
    oracle(
        "p AS (SELECT a.company_id AS query, b.company_id AS neighbour, a.acq_class AS own, b.acq_class AS other, "
        + " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in SMALL_SET)
        + " AS total FROM mtc a JOIN mtc b ON a.company_id <> b.company_id), "
        "n AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY sqrt(total), neighbour) AS rank FROM p QUALIFY rank <= 3) "
        "SELECT company_id, acq_class FROM mtc JOIN (SELECT query FROM n GROUP BY query HAVING bool_and(own = other)) ON query = company_id",
        "mtc",
    ),
)
def edited_companies(spark, d):
    return balance.enn(labelled(spark, d), "acq_class", SMALL_SET, "company_id").select("company_id", "acq_class")


@query(
    "tomek_links",
    f"WITH {_near_embeddings(1)}, rare AS (SELECT label FROM embeddings GROUP BY label ORDER BY count(*), label LIMIT 1) "
    "SELECT vec_id, label FROM embeddings WHERE vec_id NOT IN (SELECT x.query FROM near x JOIN near y ON x.query = y.neighbour "
    "AND x.neighbour = y.query WHERE x.own <> x.other AND x.own <> (SELECT label FROM rare))",
)
def tomek_links(spark, d):
    return balance.tomek_links(table(spark, d, "embeddings"), "label", ["embedding"], "vec_id").select("vec_id", "label")


# ---- feature selection ---------------------------------------------------------------------------


@query(
    "select_by_corr",
    oracle(
        "c AS ("
        + " UNION ALL ".join(f"SELECT '{c}' AS variable, corr({c}, valuation) AS corr FROM mt" for c in NUMBERS)
        + ") SELECT variable, CAST(row_number() OVER (ORDER BY round(abs(corr), 8) DESC, variable) AS INTEGER) AS rank FROM c WHERE abs(corr) > 0.15",
        "mt",
    ),
)
def select_by_corr(spark, d):
    """The columns that go with the valuation, most first."""
    names = selection.select_by_corr(settle(model_table(spark, d)), "valuation", selection.CORR_THRESHOLDS["regression"], NUMBERS, digits=8)
    return spark.createDataFrame([(n, i + 1) for i, n in enumerate(names)], "variable string, rank int")


@query(
    "f_regression",
    oracle(
        "c AS ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS variable, corr({c}, valuation) AS r, count(*) FILTER ({c} IS NOT NULL AND valuation IS NOT NULL) AS n FROM mt"
            for c in STATEMENT_SET
        )
        + "), f AS (SELECT variable, n, r * r / nullif(1 - r * r, 0) * (n - 2) AS f FROM c) "
        "SELECT variable, n, round(f, 5) AS f FROM f ORDER BY f.f DESC, variable LIMIT 20",
        "mt",
    ),
)
def f_regression(spark, d):
    return rounded(selection.f_regression(model_table(spark, d), "valuation", STATEMENT_SET), 5, "f")


@query(
    "f_classif",
    oracle(
        " UNION ALL ".join(
            f"SELECT '{c}' AS variable, CAST(sum(n) AS BIGINT) AS n, "
            f"round((sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))), 6) AS f FROM "
            f"(SELECT acq_class, count({c}) AS n, avg({c}) AS m, var_pop({c}) AS v, (SELECT avg({c}) FROM mt) AS g FROM mt GROUP BY acq_class)"
            for c in NUMBERS
        ),
        "mt",
    ),
)
def f_classif(spark, d):
    return rounded(selection.f_classif(model_table(spark, d), "acq_class", NUMBERS, None), 6, "f")


def _listed(df: DataFrame, names, column="variable") -> DataFrame:
    return df.sparkSession.createDataFrame([(n,) for n in names], f"{column} string")


@query("forest_importance")
def forest_importance(spark, d):
    df = model_table(spark, d)
    found = selection.importances(df, "valuation", NUMBERS, "regression", key="company_id")
    return spark.createDataFrame(list(found.items()), "variable string, importance double")


@query("select_by_importance")
def select_by_importance(spark, d):
    df = model_table(spark, d)
    return _listed(df, selection.select_by_importance(df, "acq_class", 0.017, NUMBERS, "class", key="company_id"))


@query("recursive_elimination")
def recursive_elimination(spark, d):
    df = model_table(spark, d)
    return _listed(df, selection.rfe(df, "acq_class", NUMBERS, "class", key="company_id"))


@query("best_feature_set")
def best_feature_set(spark, d):
    """The five candidates: all columns, and those that each way of selection keeps."""
    df = settle(model_table(spark, d).select("company_id", "valuation", *NUMBERS))
    scores = selection.importances(df, "valuation", NUMBERS, "regression", key="company_id")
    sets = {
        "all": NUMBERS,
        "correlation": selection.select_by_corr(df, "valuation", selection.CORR_THRESHOLDS["regression"], NUMBERS),
        "f_test": [r["variable"] for r in selection.f_regression(df, "valuation", NUMBERS).collect()],
        "importance": [c for c, v in scores.items() if v > selection.IMPORTANCE_THRESHOLDS["regression"]],
        "elimination": selection.rfe(df, "valuation", NUMBERS, "regression", key="company_id"),
    }
    return selection.best_feature_set(df, sets, "valuation", "company_id", "regression")


@query("best_scaling")
def best_scaling(spark, d):
    return selection.best_scaling(model_table(spark, d), NUMBERS, "acq_class", "company_id", "class")


@query("regression_leaderboard")
def regression_leaderboard(spark, d):
    df = M.log1p_all(model_table(spark, d), ["valuation", *NUMBERS]).where(F.col("valuation").isNotNull())
    candidates = {
        "forest": grown.Forest("regression", columns="spark"),
        "linear": models.linear(),
        "svm": models.svm("regression"),
        "neighbours": models.Neighbours("regression"),
        "tree": grown.Tree("regression"),
        "tweedie": models.tweedie(),
    }
    return selection.leaderboard({n: (df, names) for n, names in SETS.items()}, "valuation", "company_id", candidates, "regression")


@query("class_leaderboard")
def class_leaderboard(spark, d):
    df = model_table(spark, d).select("company_id", "acq_class", *NUMBERS)
    candidates = {
        "forest": grown.Forest("class", columns="spark"),
        "linear": models.linear_clf("log"),
        "svm": models.svm("class"),
        "neighbours": models.Neighbours("class"),
        "tree": grown.Tree("class"),
        "bayes": models.gaussian_nb(),
    }

    def resample(train: DataFrame, names):
        return balance.smote_enn(train, "acq_class", names, "company_id")

    df = df.withColumn("company_id", F.col("company_id").cast("string"))
    return selection.leaderboard({n: (df, names) for n, names in SETS.items()}, "acq_class", "company_id", candidates, "class", prepare=resample)


# ---- models --------------------------------------------------------------------------------------


def regression_rows(spark, d, names=SMALL_SET) -> DataFrame:
    """Features on the log scale and the valuation as label."""
    df = M.log1p_all(model_table(spark, d), names).where(F.col("valuation") > 0)
    return selection.assemble(df, names, "valuation", "company_id")


def class_rows(spark, d, names=SMALL_SET) -> DataFrame:
    return selection.assemble(model_table(spark, d), names, "acq_class", "company_id")


def every_row(spark, d, task: str, gaps: bool) -> DataFrame:
    """All companies with the target: missing features stay gaps, or come from nearest neighbours."""
    if gaps:
        df = model_table(spark, d).select("company_id", "acq_class", "valuation", *SMALL_SET)
    else:
        df = filled(spark, d)
    target = "acq_class"
    if task == "regression":
        df, target = M.log1p_all(df, SMALL_SET).where(F.col("valuation") > 0), "valuation"
    return with_gaps(df, SMALL_SET, target) if gaps else selection.assemble(df, SMALL_SET, target, "company_id")


def _scores(spark, d, task: str, candidates: dict, gaps: bool = False) -> DataFrame:
    """The score rows of every estimator, fitted and judged on companies with gaps too; the valuation
    goes through a Box-Cox transform. ``gaps``: the estimators know gaps, so nothing is filled."""
    rows = hold(every_row(spark, d, task, gaps))
    train, test = split(rows, "company_id", 0.2 if task == "regression" else 0.3)
    if task == "regression":
        lam = M.boxcox_fit(train, "label")

        def judge(est):
            return models.fit_score_reg(est, train, test, lambda c: M.boxcox(c, lam), lambda c: M.inv_boxcox(c, lam))

    else:

        def judge(est):
            return models.fit_score_clf(est, train, test)

    boards = [judge(est).withColumn("model", F.lit(name)) for name, est in candidates.items()]
    scores = [tuple(r) for b in boards for r in b.collect()]
    rows.unpersist()
    return spark.createDataFrame(scores, boards[0].schema)


@query(
    "ols_one_feature",
    oracle(
        "SELECT round(regr_slope(valuation, total_funding), 8) AS slope, round(regr_intercept(valuation, total_funding), 4) AS intercept "
        "FROM cmp WHERE valuation IS NOT NULL",
        "cmp",
    ),
)
def ols_one_feature(spark, d):
    df = companies(spark, d)
    fitted = models.linear().fit(selection.assemble(df, ["total_funding"], "valuation"))
    return df.agg(
        F.round(F.max(F.lit(float(fitted.coefficients[0]))), 8).alias("slope"),
        F.round(F.max(F.lit(float(fitted.intercept))), 4).alias("intercept"),
    )


PENALTIES = {"ridge": (2e6, 0.0), "lasso": (1e5, 1.0), "elastic_net": (1e6, 0.5)}


def _penalised_sql(name: str) -> str:
    alpha, l1 = PENALTIES[name]
    return (
        f"SELECT '{name}' AS model, sign(c) * greatest(abs(c) - {alpha * l1}, 0) / (v + {alpha * (1 - l1)}) AS slope, mx, my FROM m"
    )


@query(
    "penalised_one_feature",
    oracle(
        "m AS (SELECT covar_pop(valuation, total_funding) AS c, var_pop(total_funding) AS v, avg(total_funding) AS mx, "
        "avg(valuation) AS my FROM cmp WHERE valuation IS NOT NULL), s AS ("
        + " UNION ALL ".join(map(_penalised_sql, PENALTIES))
        + ") SELECT model, round(slope, 4) AS slope, round(my - slope * mx, 1) AS intercept FROM s",
        "cmp",
    ),
)
def penalised_one_feature(spark, d):
    """With one feature the penalised slopes have a closed form."""
    rows = hold(selection.assemble(companies(spark, d), ["total_funding"], "valuation"))
    spread = models.label_std(rows)
    fits = {name: models.linear(alpha, l1, spread).fit(rows) for name, (alpha, l1) in PENALTIES.items()}
    rows.unpersist()
    found = [(n, round(float(m.coefficients[0]), 4), round(float(m.intercept), 1)) for n, m in fits.items()]
    return spark.createDataFrame(found, "model string, slope double, intercept double")


@query("linear_regressors")
def linear_regressors(spark, d):
    n, spread = every_row(spark, d, "regression", True).agg(F.count(F.lit(1)), F.stddev_pop("label")).first()
    candidates = {
        "linear": models.linear(),
        "lasso": models.linear(0.5, 1.0),
        "ridge": models.ridge(0.5, n, spread),
        "elastic_net": models.linear(1.0, 0.5, spread),
    }
    return _scores(spark, d, "regression", candidates)


@query("tweedie_links")
def tweedie_links(spark, d):
    return _scores(spark, d, "regression", {link: models.tweedie(link) for link in ("auto", "identity", "log")})


def _indicator_sql(c: int) -> str:
    y = f"CAST(acq_class = {c} AS INT)::DOUBLE"
    return f"regr_slope({y}, valuation) AS s{c}, regr_intercept({y}, valuation) AS i{c}"


@query(
    "least_squares_classes",
    oracle(
        f"f AS (SELECT {', '.join(map(_indicator_sql, range(3)))} FROM cmp WHERE valuation IS NOT NULL), "
        "o AS (SELECT company_id, i0 + s0 * valuation AS a, i1 + s1 * valuation AS b, i2 + s2 * valuation AS c FROM cmp, f WHERE valuation IS NOT NULL) "
        "SELECT company_id, CASE WHEN a >= b AND a >= c THEN 0.0::DOUBLE WHEN b >= c THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS prediction FROM o",
        "cmp",
    ),
)
def least_squares_classes(spark, d):
    rows = settle(selection.assemble(companies(spark, d), ["valuation"], "acq_class", "company_id"))
    return models.LeastSquaresClassifier().fit(rows).transform(rows).select("company_id", "prediction")


@query("linear_classifiers")
def linear_classifiers(spark, d):
    return _scores(spark, d, "class", {loss: models.linear_clf(loss) for loss in ("log", "hinge", "squared")})


@query("stochastic_classifiers")
def stochastic_classifiers(spark, d):
    return _scores(spark, d, "class", {loss: models.sgd_clf(loss) for loss in ("hinge", "log", "squared")})


@query("support_vector_regressors")
def support_vector_regressors(spark, d):
    return _scores(spark, d, "regression", {k: models.svm("regression", k) for k in ("linear", "rbf")})


@query("support_vector_classifiers")
def support_vector_classifiers(spark, d):
    return _scores(spark, d, "class", {k: models.svm("class", k) for k in ("linear", "rbf")})


def _tree_query(name: str, regressor, classifier, gaps: bool | tuple[bool, bool] = False):
    of_values, of_classes = (gaps, gaps) if isinstance(gaps, bool) else gaps

    @query(f"{name}_regressor")
    def regress(spark, d):
        return _scores(spark, d, "regression", {name: regressor()}, of_values)

    @query(f"{name}_classifier")
    def classify(spark, d):
        return _scores(spark, d, "class", {name: classifier()}, of_classes)


_tree_query("decision_tree", lambda: grown.Tree("regression", 5, 10), lambda: grown.Tree("class", 5, 10), True)
_tree_query("random_forest", lambda: grown.Forest("regression"), lambda: grown.Forest("class"), True)
_tree_query(
    "extra_trees",
    lambda: grown.Forest("regression", random_cuts=True, bootstrap=False),
    lambda: grown.Forest("class", random_cuts=True, bootstrap=False),
    True,
)
_tree_query(
    "random_subspace", lambda: models.random_subspace_forest("regression"), lambda: models.random_subspace_forest("class")
)
_tree_query("gradient_boosting", lambda: grown.Boosting("regression"), lambda: grown.Boosting("class"), True)
_tree_query(
    "adaboost",
    lambda: ensembles.AdaBoost("regression", loss="linear"),
    lambda: grown.ProbabilityAdaBoost(),
    (False, True),
)
_tree_query(
    "bagging",
    lambda: ensembles.Bagging(grown.Tree("regression"), 100, "regression"),
    lambda: ensembles.Bagging(grown.Tree("class"), 100, "class"),
)
_tree_query(
    "stacking",
    lambda: ensembles.Stacking(
        {
            "lasso": models.linear(0.5, 1.0),
            "ridge": models.Ridge(0.5),
            "tree": grown.Tree("regression"),
            "svm": models.svm("regression"),
        },
        grown.Tree("regression"),
        "regression",
    ),
    lambda: ensembles.Stacking(
        {
            "logistic": models.linear_clf("log"),
            "svm": models.svm("class"),
            "neighbours": models.Neighbours("class"),
            "tree": grown.Tree("class", 3),
        },
        models.linear_clf("log"),
        "class",
    ),
)


@query(
    "naive_bayes_classes",
    oracle(
        "c AS (SELECT acq_class AS k, count(*) AS n, "
        + ", ".join(f"avg({f}) AS m_{f}, var_pop({f}) AS v_{f}" for f in SMALL_SET)
        + " FROM mtc GROUP BY 1), e AS (SELECT 1e-9 * greatest("
        + ", ".join(f"var_pop({f})" for f in SMALL_SET)
        + ") AS eps FROM mtc), s AS (SELECT company_id, k, ln(n) "
        + " ".join(f"- 0.5 * ln(v_{f} + eps) - ({f} - m_{f}) * ({f} - m_{f}) / (2 * (v_{f} + eps))" for f in SMALL_SET)
        + " AS score FROM mtc, c, e) SELECT company_id, CAST(arg_max(k, score) AS DOUBLE) AS prediction FROM s GROUP BY company_id",
        "mtc",
    ),
)
def naive_bayes_classes(spark, d):
    rows = settle(class_rows(spark, d))
    return models.gaussian_nb().fit(rows).transform(rows).select("company_id", "prediction")


@query("naive_bayes_classes_all")
def naive_bayes_classes_all(spark, d):
    """Fitted on complete companies like ``naive_bayes_classes``, but every company gets a class."""
    rows = VectorAssembler(inputCols=list(SMALL_SET), outputCol="features").transform(filled(spark, d))
    return models.gaussian_nb().fit(settle(class_rows(spark, d))).transform(rows).select("company_id", "prediction")


@query("naive_bayes")
def naive_bayes(spark, d):
    return _scores(spark, d, "class", {"gaussian": models.gaussian_nb()})


cte(
    "sp",
    "SELECT *, CAST('0x' || substr(md5('42|' || company_id::VARCHAR), 1, 8) AS BIGINT) % 100 < 20 AS is_test FROM mtc",
    "mtc",
)
_PAIR = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in SMALL_SET)
_KNN_SQL = (
    "n AS (SELECT a.company_id, b.valuation AS v, b.acq_class AS c, sqrt({pair}) AS dist FROM sp a JOIN sp b "
    "ON a.is_test AND NOT b.is_test AND {known} QUALIFY row_number() OVER (PARTITION BY a.company_id ORDER BY sqrt({pair}), b.company_id) <= {k}) "
)


def _knn_sql(k: int, known: str) -> str:
    return _KNN_SQL.format(pair=_PAIR, k=k, known=known)


@query(
    "knn_regression",
    oracle(
        _knn_sql(7, "b.valuation IS NOT NULL")
        + "SELECT company_id, round(CASE WHEN count(*) FILTER (dist = 0) > 0 THEN avg(v) FILTER (dist = 0) "
        "ELSE sum(v / nullif(dist, 0)) / sum(1 / nullif(dist, 0)) END, 4) AS prediction FROM n GROUP BY company_id",
        "sp",
    ),
)
def knn_regression(spark, d):
    train, test = split(complete(spark, d), "company_id", 0.2)
    train = train.where(F.col("valuation").isNotNull())
    out = models.knn_predict(train, test, 7, SMALL_SET, "company_id", "valuation", "regression", "distance")
    return rounded(out, 4, "prediction")


@query(
    "knn_classification",
    oracle(
        _knn_sql(5, "true")
        + ", v AS (SELECT company_id, c, count(*) AS k FROM n GROUP BY company_id, c) "
        "SELECT company_id, CAST(c AS DOUBLE) AS prediction FROM v QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY k DESC, c) = 1",
        "sp",
    ),
)
def knn_classification(spark, d):
    train, test = split(complete(spark, d), "company_id", 0.2)
    return models.knn_predict(train, test, 5, SMALL_SET, "company_id", "acq_class", "class")


@query("knn_regression_all")
def knn_regression_all(spark, d):
    """Complete companies are the neighbours as in ``knn_regression``; every test company is predicted."""
    train, _ = split(complete(spark, d), "company_id", 0.2)
    _, test = split(filled(spark, d), "company_id", 0.2)
    train = train.where(F.col("valuation").isNotNull())
    out = models.knn_predict(train, test, 7, SMALL_SET, "company_id", "valuation", "regression", "distance")
    return rounded(out, 4, "prediction")


@query("knn_classification_all")
def knn_classification_all(spark, d):
    train, _ = split(complete(spark, d), "company_id", 0.2)
    _, test = split(filled(spark, d), "company_id", 0.2)
    return models.knn_predict(train, test, 5, SMALL_SET, "company_id", "acq_class", "class")


@query("grid_search_tree")
def grid_search_tree(spark, d):
    train, _ = split(regression_rows(spark, d), "company_id", 0.2)
    board, _ = tuning.grid_search(
        train, lambda **p: grown.Tree("regression", **p), tuning.REGRESSION_GRIDS["tree"], "regression", refit=False
    )
    return board


@query("grid_search_neighbours")
def grid_search_neighbours(spark, d):
    train, _ = split(class_rows(spark, d), "company_id", 0.3)
    board, _ = tuning.grid_search(
        train, lambda **p: models.Neighbours("class", **p), tuning.CLASS_GRIDS["neighbours"], "class"
    )
    return board


@query("random_search_boosting")
def random_search_boosting(spark, d):
    """The whole space and budget of the light boosting search, by relative error."""
    train, _ = split(regression_rows(spark, d), "company_id", 0.2)
    space, budget = tuning.SPACES["light_boosting"]
    board, _ = tuning.random_search(train, tuning.BUILDERS["light_boosting"], space, budget, "regression", metric="mape", refit=False)
    return board


@query("random_search_forest")
def random_search_forest(spark, d):
    """The whole space and budget of the forest search."""
    train, _ = split(class_rows(spark, d), "company_id", 0.3)
    space, budget = tuning.SPACES["forest_class"]
    board, _ = tuning.random_search(train, tuning.BUILDERS["forest_class"], space, budget, "class", refit=False)
    return board


@query("random_search_extra")
def random_search_extra(spark, d):
    """The whole space and budget of the search over extremely randomised trees."""
    train, _ = split(class_rows(spark, d), "company_id", 0.3)
    space, budget = tuning.SPACES["extra_class"]
    board, _ = tuning.random_search(train, tuning.BUILDERS["extra_class"], space, budget, "class", refit=False)
    return board


@query(
    "saved_model",
    oracle(
        "s AS (SELECT *, CAST('0x' || substr(md5('42|' || company_id::VARCHAR), 1, 8) AS BIGINT) % 100 < 20 AS is_test FROM mt WHERE valuation IS NOT NULL), "
        "f AS (SELECT regr_slope(valuation, total_funding) AS b, regr_intercept(valuation, total_funding) AS a FROM s WHERE NOT is_test) "
        "SELECT company_id, round(a + b * total_funding, 4) AS before, round(a + b * total_funding, 4) AS after FROM s, f WHERE is_test",
        "mt",
    ),
)
def saved_model(spark, d):
    """Predictions of a pipeline that was written and read back, next to those of the original."""
    train, test = split(settle(model_table(spark, d).dropna(subset=["valuation"])), "company_id", 0.2)
    stages = [VectorAssembler(inputCols=["total_funding"], outputCol="features"), models.linear().setLabelCol("valuation")]
    fitted = Pipeline(stages=stages).fit(train)
    return rounded(_round_trip(spark, fitted, test), 4, "before", "after")


def _round_trip(spark, fitted, test: DataFrame) -> DataFrame:
    path = scratch_path(spark, "model")
    save_model(fitted, path)
    before = fitted.transform(test).select("company_id", F.col("prediction").alias("before"))
    after = load_model(path).transform(test).select("company_id", F.col("prediction").alias("after"))
    return before.join(after, "company_id")


@query("saved_adaboost")
def saved_adaboost(spark, d):
    """Both tasks' boosted trees, written and read back."""
    out = []
    for task, rows in (("regression", regression_rows(spark, d)), ("class", class_rows(spark, d))):
        train, test = split(settle(rows), "company_id", 0.2)
        out.append(_round_trip(spark, (ensembles.AdaBoost(task) if task == "regression" else grown.ProbabilityAdaBoost()).fit(train), test).withColumn("task", F.lit(task)))
    return out[0].unionByName(out[1])


@query("saved_forest")
def saved_forest(spark, d):
    train, test = split(settle(regression_rows(spark, d)), "company_id", 0.2)
    return _round_trip(spark, grown.Forest("regression").fit(train), test)


@query(
    "tweedie_identity",
    oracle(
        "SELECT round(covar_pop(valuation, total_funding) / var_pop(total_funding), 6) AS slope, "
        "round(avg(valuation) - covar_pop(valuation, total_funding) / var_pop(total_funding) * avg(total_funding), 3) AS intercept "
        "FROM cmp WHERE valuation IS NOT NULL",
        "cmp",
    ),
)
def tweedie_identity(spark, d):
    """Without a penalty the identity link is least squares."""
    rows = hold(selection.assemble(companies(spark, d), ["total_funding"], "valuation"))
    m = models.tweedie("identity", 0.0).fit(rows)
    rows.unpersist()
    return spark.createDataFrame([(round(float(m.coefficients[0]), 6), round(float(m.intercept), 3))], "slope double, intercept double")


def _two_by_normal_equations(ridge: float) -> str:
    """Two features solved by hand from central moments; ``ridge`` is added to both variances."""
    return (
        "s AS (SELECT sales, debt, valuation FROM mt WHERE valuation IS NOT NULL), "
        f"m AS (SELECT var_pop(sales) + {ridge} AS aa, var_pop(debt) + {ridge} AS bb, covar_pop(sales, debt) AS ab, "
        "covar_pop(sales, valuation) AS ya, covar_pop(debt, valuation) AS yb FROM s) "
        "SELECT round((ya * bb - yb * ab) / (aa * bb - ab * ab), 8) AS sales, "
        "round((yb * aa - ya * ab) / (aa * bb - ab * ab), 8) AS debt FROM m"
    )


def _two_slopes(spark, d, build) -> DataFrame:
    rows = hold(selection.assemble(model_table(spark, d), ["sales", "debt"], "valuation"))
    a, b = build(rows).fit(rows).coefficients
    rows.unpersist()
    return spark.createDataFrame([(round(float(a), 8), round(float(b), 8))], "sales double, debt double")


@query("ols_two_features", oracle(_two_by_normal_equations(0.0), "mt"))
def ols_two_features(spark, d):
    return _two_slopes(spark, d, lambda rows: models.linear())


@query("ridge_two_features", oracle(_two_by_normal_equations(1e8), "mt"))
def ridge_two_features(spark, d):
    return _two_slopes(spark, d, lambda rows: models.linear(1e8, 0.0, models.label_std(rows)))


@query(
    "tree_one_cut_all",
    oracle(
        "s AS (SELECT total_funding AS x, valuation AS y FROM cmp WHERE valuation IS NOT NULL AND total_funding IS NOT NULL), "
        "g AS (SELECT x, count(*) AS n, sum(y) AS t FROM s GROUP BY x), "
        "c AS (SELECT x, lead(x) OVER (ORDER BY x) AS nx, sum(n) OVER (ORDER BY x) AS n1, sum(t) OVER (ORDER BY x) AS t1, "
        "sum(n) OVER () AS n, sum(t) OVER () AS t FROM g), "
        "b AS (SELECT *, t1 * t1 / n1 + (t - t1) * (t - t1) / nullif(n - n1, 0) AS gain FROM c WHERE nx IS NOT NULL ORDER BY gain DESC, x LIMIT 1) "
        "SELECT round(t1 / n1, 4) AS low, round((t - t1) / (n - n1), 4) AS high FROM b",
        "cmp",
    ),
)
def tree_one_cut_all(spark, d):
    return _one_cut(companies(spark, d))


def _one_cut(df: DataFrame) -> DataFrame:
    """A tree of depth one is the cut that leaves the least variance; every midpoint is a candidate."""
    rows = hold(selection.assemble(df, ["total_funding"], "valuation"))
    # As many bins as rows: every midpoint is tried.
    fitted = models.tree("regression", 1, maxBins=max(2, rows.count())).fit(rows)
    rows.unpersist()
    low, high = ensembles.Trees.of([fitted]).nodes[1:, 4]
    return df.sparkSession.createDataFrame([(round(float(low), 4), round(float(high), 4))], "low double, high double")


# ---- metrics -------------------------------------------------------------------------------------


def judged(spark, d) -> DataFrame:
    """Simple stand-in predictions for the metrics to judge."""
    guess = F.when(F.col("total_funding") < 3000, 0).when(F.col("total_funding") < 6000, 1).otherwise(2)
    return companies(spark, d).select(
        "company_id", "valuation", "acq_class", F.col("total_funding").alias("guess"), guess.alias("guess_class")
    )


cte(
    "judged",
    "SELECT company_id, valuation, acq_class, total_funding AS guess, CASE WHEN total_funding < 3000 THEN 0 "
    "WHEN total_funding < 6000 THEN 1 ELSE 2 END AS guess_class FROM cmp",
    "cmp",
)


@query(
    "regression_metrics",
    oracle(
        "SELECT count(*) AS n, round(1 - avg((valuation - guess) * (valuation - guess)) / var_pop(valuation), 8) AS r2, "
        "round(avg((valuation - guess) * (valuation - guess)), 4) AS mse, round(sqrt(avg((valuation - guess) * (valuation - guess))), 6) AS rmse, "
        "round(avg(abs(valuation - guess)), 6) AS mae, round(avg(abs(valuation - guess) / greatest(abs(valuation), 2.220446049250313e-16)), 8) AS mape "
        "FROM judged WHERE valuation IS NOT NULL AND guess IS NOT NULL",
        "judged",
    ),
)
def regression_metrics(spark, d):
    out = metrics.regression_metrics(judged(spark, d), "valuation", "guess")
    for digits, names in ((8, ("r2", "mape")), (4, ("mse",)), (6, ("rmse", "mae"))):
        out = rounded(out, digits, *names)
    return out


@query(
    "confusion_matrix",
    oracle(
        "SELECT acq_class AS actual, count(*) FILTER (guess_class = 0) AS pred_0, count(*) FILTER (guess_class = 1) AS pred_1, "
        "count(*) FILTER (guess_class = 2) AS pred_2 FROM judged GROUP BY 1",
        "judged",
    ),
)
def confusion_matrix(spark, d):
    return metrics.confusion_matrix(judged(spark, d), "acq_class", "guess_class")


_CLASS_SQL = (
    "k AS (SELECT c, (SELECT count(*) FROM judged WHERE acq_class = c AND guess_class = c) AS tp, "
    "(SELECT count(*) FROM judged WHERE guess_class = c) AS pp, (SELECT count(*) FROM judged WHERE acq_class = c) AS n FROM range(3) t(c)), "
    "m AS (SELECT c, n, coalesce(tp / CAST(nullif(pp, 0) AS DOUBLE), 0) AS p, coalesce(tp / CAST(nullif(n, 0) AS DOUBLE), 0) AS r, "
    "coalesce(2 * tp / CAST(nullif(pp + n, 0) AS DOUBLE), 0) AS f, tp FROM k), "
    "o AS (SELECT c::VARCHAR AS class, p, r, f, n FROM m UNION ALL SELECT 'macro', avg(p), avg(r), avg(f), sum(n) FROM m "
    "UNION ALL SELECT 'weighted', sum(p * n) / sum(n), sum(r * n) / sum(n), sum(f * n) / sum(n), sum(n) FROM m "
    "UNION ALL SELECT 'accuracy', sum(tp) / CAST(sum(n) AS DOUBLE), sum(tp) / CAST(sum(n) AS DOUBLE), sum(tp) / CAST(sum(n) AS DOUBLE), sum(n) FROM m) "
    "SELECT class, round(p, 8) AS precision, round(r, 8) AS recall, round(f, 8) AS f1, CAST(n AS BIGINT) AS support FROM o"
)


@query("classification_metrics", oracle(_CLASS_SQL, "judged"))
def classification_metrics(spark, d):
    return rounded(metrics.classification_metrics(judged(spark, d), "acq_class", "guess_class"), 8, "precision", "recall", "f1")


@query("accuracy", oracle("SELECT round(avg((acq_class = guess_class)::INT), 8) AS accuracy FROM judged", "judged"))
def accuracy(spark, d):
    return rounded(metrics.accuracy(judged(spark, d), "acq_class", "guess_class"), 8, "accuracy")


# ---- scoring -------------------------------------------------------------------------------------


@query("score_valuation")
def score_valuation(spark, d):
    df = settle(scoring_table(spark, d))
    names = scoring.VALUATION_FEATURES
    known = df.where(F.col("valuation") > 0).withColumn("valuation", F.ln("valuation"))
    rows = selection.assemble(scoring.valuation_inputs(known, names), names, "valuation", "company_id")
    return scoring.score_valuation(df, grown.Forest("regression").fit(rows), names)


@query("score_acquisition")
def score_acquisition(spark, d):
    df = settle(scoring_table(spark, d))
    names = scoring.ACQUISITION_FEATURES
    rows = selection.assemble(M.nan_to_num(df, names), names, "acq_class", "company_id")
    return scoring.score_acquisition(df, grown.Forest("class").fit(rows), names)


@query(
    "balance_long",
    oracle(
        " UNION ALL ".join(f"SELECT company_id, year, '{side}' AS side, '{item}' AS item, {item} AS value FROM prep" for item, side in scoring.BALANCE_SIDES.items()),
        "prep",
    ),
)
def balance_long(spark, d):
    return scoring.balance_long(prepared(spark, d))


KPIS = {"profitability": "ratio_ebitda_assets", "liquidity_solvency": "ratio_acid_test", "efficiency_leverage": "ratio_debt_assets"}


@query(
    "kpi_by_year",
    oracle(
        "SELECT a.company_id, "
        + ", ".join(f"a.{r} AS {k}_{EARLIER}, b.{r} AS {k}_{LATER}" for k, r in KPIS.items())
        + f" FROM rat a JOIN rat b ON a.company_id = b.company_id AND a.year = {EARLIER} AND b.year = {LATER}",
        "rat",
    ),
)
def kpi_by_year(spark, d):
    df = M.add_ratios(prepared(spark, d, BOTH)).select("company_id", "year", *(F.col(r).alias(k) for k, r in KPIS.items()))
    df = settle(df)
    earlier, later = df.where(F.col("year") == EARLIER), df.where(F.col("year") == LATER)
    return scoring.kpi_by_year(earlier, later, list(KPIS), (EARLIER, LATER))


@query(
    "decode_prediction",
    oracle(
        "SELECT company_id, CASE guess_class WHEN 0 THEN 'not acquired' WHEN 1 THEN 'partly acquired' ELSE 'fully acquired' END AS text FROM judged",
        "judged",
    ),
)
def decode_prediction(spark, d):
    return judged(spark, d).select("company_id", decode_class(F.col("guess_class")).alias("text"))
