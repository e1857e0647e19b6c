"""Nodes of few rows grown by one task, and forests that stay out of the driver."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from firmlens.operators import growing, grown
from firmlens.operators.growing import Rules
from firmlens.sources.models import load_model, save_model

N = 1500


@pytest.fixture(scope="module")
def df(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(N, 3))
    x[rng.random((N, 3)) < 0.1] = np.nan
    y = np.nan_to_num(x[:, 0]) + rng.normal(size=N)
    rows = [(i, x[i].tolist(), float(y[i]), float((y[i] > 0) + (y[i] > 1))) for i in range(N)]
    out = spark.createDataFrame(rows, "company_id long, x array<double>, y double, c double").repartition(4)
    return out.withColumn("features", array_to_vector("x")).persist()


def few_together(monkeypatch):
    monkeypatch.setattr(growing, "LOCAL_ROWS", 200)
    monkeypatch.setattr(growing, "LOCAL_PAIRS", 500)


@pytest.mark.parametrize("label,rules", [
    ("y", [Rules(draw="bootstrap", seed=s) for s in range(3)]),
    ("y", [Rules("poisson", min_leaf=4, columns=2)]),
    ("y", [Rules("absolute", max_depth=6)]),
    ("y", [Rules(random_cuts=True, seed=s) for s in range(2)]),
    ("c", [Rules("gini", columns=1, draw="share", share=0.7, seed=s) for s in range(3)]),
    ("c", [Rules("entropy", min_split=30)]),
])
def test_trees_grown_in_one_task_or_by_levels_are_the_same(df, monkeypatch, label, rules):
    table = growing.binned(df.withColumn("y", F.col("y") + 10), "company_id", "class" if label == "c" else "regression", label=label)
    whole = growing.grow(table, rules)
    few_together(monkeypatch)
    monkeypatch.setattr(growing, "CELLS_AT_ONCE", 300)
    parted = growing.grow(table, rules)
    x = np.array([r["x"] for r in df.select("x").collect()], float)
    assert (whole.value[whole.walk(x)] == parted.value[parted.walk(x)]).all()
    assert len(whole.feature) == len(parted.feature) and np.allclose(whole.importance(3), parted.importance(3))
    assert (np.bincount(whole.owner) == np.bincount(parted.owner)).all() and (np.bincount(whole.depth) == np.bincount(parted.depth)).all()


def test_jobs_do_not_grow_with_depth(spark, df):
    table = growing.binned(df, "company_id", "regression", label="y")
    tracker, counts = spark.sparkContext.statusTracker(), []
    for depth in (2, None):
        spark.sparkContext.setJobGroup(f"depth-{depth}", "depth")
        trees = growing.grow(table, [Rules(max_depth=depth)])
        counts.append(len(tracker.getJobIdsForGroup(f"depth-{depth}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert trees.depth.max() > 8 and counts[0] == counts[1]


def test_many_trees_on_few_rows_shuffle_no_sums(df, monkeypatch):
    """Sums of (tree, node, column, bin) for thousands of trees once filled the disk."""
    table = growing.binned(df, "company_id", "class", label="c")
    monkeypatch.setattr(growing, "_summed", lambda *a: pytest.fail("sums are shuffled"))
    trees = growing.grow(table, [Rules("gini", max_depth=3, seed=s, draw="bootstrap") for s in range(300)])
    assert trees.n_trees == 300 and (trees.feature[:300] >= 0).all()


def test_histograms_of_labels_are_judged_a_few_at_a_time(df, monkeypatch):
    sizes = []
    by_rank = growing._by_rank
    monkeypatch.setattr(growing, "_by_rank", lambda codes, stats, table: sizes.append(len(np.unique(codes >> 8))) or by_rank(codes, stats, table))
    table = growing.binned(df, "company_id", "regression", label="y")
    work = growing.Work.of(table, [Rules("absolute")] * 400, None, 1.0)
    slot = np.repeat(np.arange(400), 30)
    codes, sums = growing.add_up((slot * 3 * 256 + np.tile(np.arange(30), 400)) * 256 + np.tile(np.arange(30) % 7, 400), np.ones((12000, 1), np.int64))
    best = growing.Best(codes, sums, work, work.of_nodes(np.arange(400)))
    assert len(best.slot) == 400 and max(sizes) <= growing.CELLS_AT_ONCE // 64 + 768 and len(sizes) > 5


@pytest.mark.parametrize("task,options", [("regression", {}), ("class", {}), ("regression", {"random_cuts": True, "bootstrap": False})])
@pytest.mark.parametrize("by_levels", [False, True])
def test_a_forest_too_big_for_the_driver(df, monkeypatch, tmp_path, task, options, by_levels):
    """It predicts what the same forest would in the driver, saved or not, and holds only the upper nodes."""
    rows = df.withColumn("label", F.col("c" if task == "class" else "y"))
    est = grown.Forest(task, 5, **options)
    near = est.fit(rows)
    monkeypatch.setattr(growing, "NODE_BUDGET", 500)
    monkeypatch.setattr(grown, "PAIRS_SCORED", 300)
    if by_levels:
        few_together(monkeypatch)
    far = est.fit(rows)
    assert isinstance(far, grown.FarForest) and len(far.upper.feature) < 500
    save_model(far, str(tmp_path / "m"))
    # Other rows than those it was fitted on, and some twice.
    asked = rows.where("company_id % 3 = 0").unionByName(rows.where("company_id < 10")).withColumn("features", array_to_vector(F.transform("x", lambda v: v * 1.1)))
    want, found, again = ([tuple(r) for r in m.transform(asked).select("company_id", "prediction").orderBy("company_id").collect()] for m in (near, far, load_model(str(tmp_path / "m"))))
    assert found == again and np.allclose(want, found, atol=1e-9)
    assert np.allclose(near.importances(), far.importances())
