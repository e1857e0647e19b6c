"""Bagging, importance, elimination and base scores by trees that stay out of the driver."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmlens.operators import ensembles, growing, grown, models, selection
from firmlens.sources.models import load_model, save_model

N = 400


@pytest.fixture(scope="module")
def df(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(N, 4))
    y = 2 * x[:, 0] - x[:, 1] + 0.1 * rng.normal(size=N)
    rows = [(i, *map(float, x[i]), float(y[i]), float((y[i] > -1) + (y[i] > 1))) for i in range(N)]
    return spark.createDataFrame(rows, "company_id long, a double, b double, c double, d double, y double, k double").repartition(3).persist()


def no_spark_trees(monkeypatch):
    for name in ("forest", "tree"):
        monkeypatch.setattr(models, name, lambda *a, **k: pytest.fail("Spark's trees are whole in the driver"))


@pytest.mark.parametrize("task,target", [("regression", "y"), ("class", "k")])
def test_bagged_trees_may_stay_out_of_the_driver(df, tmp_path, monkeypatch, task, target):
    """the same predictions as those of one tree after the other, by mean or by most votes."""
    rows = selection.assemble(df, ["a", "b", "c", "d"], target, "company_id")
    bagging = ensembles.Bagging(grown.Tree(task, 4), 7, task)
    near = bagging.fit(rows)
    monkeypatch.setattr(growing, "NODE_BUDGET", 50)
    far = bagging.fit(rows)
    assert isinstance(near, grown.GrownModel) and isinstance(far, grown.FarForest)
    save_model(far, str(tmp_path / "m"))
    near, far, read = (sorted((r["company_id"], r["prediction"]) for r in m.transform(rows).collect()) for m in (near, far, load_model(str(tmp_path / "m"))))
    assert np.allclose(near, far) and far == read
    table = growing.binned(rows, "company_id", task)
    x = np.array([r["features"].toArray() for r in rows.orderBy("company_id").collect()])
    alone = []
    for t in range(7):
        tree = growing.grow(table, [growing.Rules("gini" if task == "class" else "squared", 4, draw="bootstrap", seed=42 * 1_000_003 + t)])
        value = tree.value[tree.walk(x)[:, 0]]
        alone.append(value.argmax(axis=1) if task == "class" else value[:, 0])
    if task == "class":
        found = [np.bincount([a[i] for a in alone], minlength=3).argmax() for i in range(N)]
    else:
        found = np.mean(alone, axis=0)
    assert np.allclose([p for _, p in near], found)


@pytest.mark.parametrize("task,target", [("regression", "y"), ("class", "k")])
def test_selection_grows_no_trees_in_the_driver(df, monkeypatch, task, target):
    """F4, F9, F14, F16: the same importances, columns and scores wherever the trees are."""
    no_spark_trees(monkeypatch)
    names = ["a", "b", "c", "d"]

    def found():
        shares = selection.importances(df, target, names, task, trees=10, key="company_id")
        kept = selection.rfe(df, target, names, task, n=2, trees=10)
        sets = {"all": names, "one": ["a"]}
        score = [tuple(r) for r in selection.best_feature_set(df, sets, target, "company_id", task, trees=10).collect()]
        scaled = [tuple(r) for r in selection.best_scaling(df, names, target, "company_id", task, trees=10).collect()]
        return shares, kept, score, scaled

    near = found()
    monkeypatch.setattr(growing, "NODE_BUDGET", 50)
    far = found()
    assert near[1] == far[1] == ["a", "b"] and near[0]["a"] == max(near[0].values()) and abs(sum(near[0].values()) - 1) < 1e-9
    assert np.allclose([*near[0].values()], [*far[0].values()])
    for a, b in zip(near[2] + near[3], far[2] + far[3], strict=True):
        assert a[0] == b[0] and a[-1] == pytest.approx(b[-1], abs=0.02)


def test_importances_need_no_key(df):
    """Rows without a key, or with the same one, are still drawn apart."""
    bare = df.drop("company_id")
    same = df.withColumn("company_id", F.lit(None).cast("long"))
    assert selection.importances(bare, "y", ["a", "b", "c"], "regression", trees=10)["a"] > 0.5
    assert selection.importances(same, "y", ["a", "b", "c"], "regression", trees=10, key="company_id")["a"] > 0.5
