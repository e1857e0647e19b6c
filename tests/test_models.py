"""Invariants of the model operators on a small table."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from firmlens.operators import ensembles, models, selection, tuning
from firmlens.operators.imputation import impute_by_model
from firmlens.operators.splitting import split
from firmlens.sources.models import load_model, save_model


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(240, 3))
    rows = [(i, *map(float, r), float(3 * r[0] - r[1]), int(np.digitize(r[0], [-0.4, 0.4]))) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "company_id long, a double, b double, c double, y double, k int").persist()


@pytest.fixture(scope="module")
def reg(table):
    rows = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(table)
    return split(rows.select("company_id", "features", F.col("y").alias("label")).persist(), "company_id", 0.2)


@pytest.fixture(scope="module")
def clf(table):
    rows = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(table)
    return split(rows.select("company_id", "features", F.col("k").cast("double").alias("label")).persist(), "company_id", 0.2)


@pytest.mark.parametrize(
    "est,least",
    [
        (lambda: models.linear(), 0.99),
        (lambda: models.svm("regression", "linear"), 0.95),
        (lambda: models.svm("regression", "rbf"), 0.5),
        (lambda: ensembles.AdaBoost("regression", n=5), 0.5),
        (lambda: ensembles.Bagging(models.tree("regression", 5), 4, "regression"), 0.5),
        (lambda: ensembles.Stacking({"a": models.linear(), "b": models.tree("regression", 4)}, models.linear(), "regression", k=3), 0.95),
        (lambda: models.Neighbours("regression", 5, "distance"), 0.6),
    ],
    ids=["linear", "svm", "rbf", "adaboost", "bagging", "stacking", "neighbours"],
)
def test_regressors_learn(reg, est, least):
    assert models.fit_score_reg(est(), *reg).first()["r2"] > least


@pytest.mark.parametrize(
    "est",
    [
        lambda: models.linear_clf("log"),
        lambda: models.linear_clf("squared"),
        lambda: models.svm("class", "rbf", n_features=32),
        lambda: models.gaussian_nb(),
        lambda: ensembles.AdaBoost("class", n=4, max_depth=2),
        lambda: ensembles.Bagging(models.tree("class", 4), 3, "class"),
        lambda: ensembles.Stacking({"a": models.gaussian_nb(), "b": models.tree("class", 4)}, models.linear_clf("log"), "class", k=3),
        lambda: models.Neighbours("class", 5),
    ],
    ids=["log", "squared", "rbf", "bayes", "adaboost", "bagging", "stacking", "neighbours"],
)
def test_classifiers_learn(clf, est):
    report = {r["class"]: r for r in models.fit_score_clf(est(), *clf).collect()}
    assert report["accuracy"]["precision"] > 0.55


def test_label_transform_is_undone(reg):
    train, test = reg
    out = models.fit_score_reg(models.linear(), train, test, lambda c: c * 2 + 1, lambda c: (c - 1) / 2).first()
    assert out["r2"] > 0.99


def test_searches(clf, reg):
    board, best = tuning.grid_search(reg[0], lambda **p: models.tree("regression", **p), {"max_depth": [1, 5]}, "regression", k=3)
    assert board.first()["params"] == '{"max_depth": 5}'
    assert "prediction" in best.transform(reg[1]).columns
    assert tuning.BUILDERS.keys() == tuning.SPACES.keys()
    for name, (space, _) in tuning.SPACES.items():
        assert tuning.BUILDERS[name](**tuning.sample_space(space, 1)[0]) is not None
    draws = tuning.sample_space(*tuning.SPACES["gbt_regression"])
    assert len(draws) == 10 and draws == tuning.sample_space(*tuning.SPACES["gbt_regression"])
    assert all(10 <= p["n"] <= 100 and p["loss"] in ("squared", "absolute") for p in draws)


def test_selection(table):
    scores = selection.importances(table, "y", ["a", "b", "c"], "regression", trees=10)
    assert sum(scores.values()) == pytest.approx(1.0) and max(scores, key=scores.get) == "a"
    assert set(selection.rfe(table, "y", ["a", "b", "c"], "regression", n=2, trees=10)) == {"a", "b"}
    assert selection.select_by_corr(table, "y", 0.2, ["a", "b", "c"]) == ["a", "b"]
    board = selection.best_feature_set(table, {"good": ["a", "b", "y"], "bad": ["c"]}, "y", "company_id", "regression", trees=5)
    assert [(r["candidate"], r["n_features"]) for r in board.collect()] == [("good", 2), ("bad", 1)]


def test_model_fill(spark, table):
    df = table.withColumn("s", F.when(F.col("company_id") % 5 != 0, F.concat(F.lit("k"), F.col("k"))))
    out = impute_by_model(df, ["s"], ["a", "b"], "company_id", trees=5, rounds=2).select("company_id", "k", "s").collect()
    assert {r["s"] for r in out} <= {"k0", "k1", "k2"}
    assert all(r["s"] == f"k{r['k']}" for r in out if r["company_id"] % 5)


def test_bootstrap_weight_has_mean_one(spark):
    df = spark.range(20000).select(ensembles.bootstrap_weight("id", 3).alias("w"))
    mean, var = df.agg(F.avg("w"), F.var_pop("w")).first()
    assert mean == pytest.approx(1.0, abs=0.05) and var == pytest.approx(1.0, abs=0.1)


@pytest.mark.parametrize("task", ["regression", "class"])
def test_trees_are_scored_together_as_one_by_one(reg, clf, task):
    train, test = reg if task == "regression" else clf
    fits = [models.tree(task, d, seed=d).fit(train) for d in (1, 3, 6)]
    rows = test.collect()
    together = ensembles.Trees.of(fits).values(np.array([r["features"].toArray() for r in rows]))
    for i, fit in enumerate(fits):
        assert together[:, i].tolist() == [r["prediction"] for r in fit.transform(test).collect()]


def test_votes_and_medians():
    p = np.array([[1.0, 2.0, 2.0], [0.0, 1.0, 2.0]])
    assert ensembles._voted(p, np.array([1.0, 1.0, 1.0]), [0.0, 1.0, 2.0]).tolist() == [2.0, 0.0]
    assert ensembles._voted(np.array([[5.0, 1.0, 3.0]]), np.array([1.0, 1.0, 1.0]), []).tolist() == [3.0]
    assert ensembles._voted(np.array([[5.0, 1.0, 3.0]]), np.array([5.0, 1.0, 1.0]), []).tolist() == [5.0]


@pytest.mark.parametrize(
    "task,est",
    [
        ("regression", lambda: ensembles.AdaBoost("regression", n=4)),
        ("class", lambda: ensembles.AdaBoost("class", n=4, max_depth=2)),
        ("regression", lambda: ensembles.Bagging(models.tree("regression", 3), 3, "regression")),
        ("regression", lambda: ensembles.Bagging(models.linear(), 3, "regression")),
        ("class", lambda: models.linear_clf("squared")),
        ("class", lambda: models.Neighbours("class", 5)),
        ("regression", lambda: ensembles.Stacking({"a": models.linear(), "b": models.tree("regression", 4)}, models.linear(), "regression", k=3)),
    ],
    ids=["adaboost", "adaboost_class", "bagged_trees", "bagged_lines", "squared", "neighbours", "stacking"],
)
def test_saved_ensembles_predict_the_same(reg, clf, tmp_path, task, est):
    train, test = reg if task == "regression" else clf
    fitted = est().fit(train)
    save_model(fitted, str(tmp_path / "m"))
    again = load_model(str(tmp_path / "m"))

    def predicted(m):
        return sorted(tuple(r) for r in m.transform(test).select("company_id", "prediction").collect())

    assert predicted(fitted) == predicted(again)


def test_plan_of_many_members_stays_small(reg):
    train, test = reg
    few, many = (ensembles.Bagging(models.tree("regression", 1), n, "regression").fit(train).transform(test) for n in (2, 12))
    sizes = [len(df._jdf.queryExecution().executedPlan().toString()) for df in (few, many)]
    assert abs(sizes[0] - sizes[1]) < 200


def test_metrics_order_the_board(reg):
    for metric in ("rmse", "mape"):
        board, _ = tuning.grid_search(reg[0], lambda **p: models.tree("regression", **p), {"max_depth": [1, 5]}, "regression", k=3, metric=metric)
        scores = [r["score"] for r in board.collect()]
        assert scores == sorted(scores)


def test_depth_beyond_the_limit_is_refused():
    with pytest.raises(ValueError):
        models.forest("class", max_depth=31)
    assert models.tree("class").getMaxDepth() == 30


def test_neighbours_without_a_comparable_row(spark, reg):
    train, _ = reg
    model = models.Neighbours("regression", 3).fit(train)
    odd = spark.createDataFrame([(9999, [float("nan")] * 3)], "company_id long, x array<double>")
    odd = odd.select("company_id", array_to_vector("x").alias("features"))
    mean = train.agg(F.avg("label")).first()[0]
    assert model.transform(odd).first()["prediction"] == pytest.approx(mean)


def test_all_features_of_the_scorers(spark, sf_dir):
    from firmlens.operators import scoring
    from firmlens.plans.views import model_table, scoring_table

    df = scoring_table(spark, sf_dir)
    assert len(scoring.VALUATION_FEATURES) == 22 and len(scoring.ACQUISITION_FEATURES) == 23
    assert {*scoring.VALUATION_FEATURES, *scoring.ACQUISITION_FEATURES} <= set(df.columns)
    assert df.count() == model_table(spark, sf_dir).count()
