"""Trees that are grown together, against plain versions on small tables."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from firmlens.operators import growing, grown, models, tuning
from firmlens.operators.growing import Rules
from firmlens.sources.models import load_model, save_model

N = 400


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(N, 3))
    x[rng.random((N, 3)) < 0.1] = np.nan
    x[:, 2] = np.round(x[:, 2])
    y = np.where(np.nan_to_num(x[:, 0]) > 0.3, 5.0, 0.5) + np.where(np.isnan(x[:, 1]), 3, 0) + rng.normal(size=N) * 0.1 + 1
    c = (y > 3).astype(int) + (y > 5)
    return x, y, c


@pytest.fixture(scope="module")
def df(spark, data):
    x, y, c = data
    rows = [(i, x[i].tolist(), float(y[i]), float(c[i])) for i in range(N)]
    out = spark.createDataFrame(rows, "company_id long, x array<double>, y double, c double").repartition(5)
    return out.withColumn("features", array_to_vector("x")).persist()


@pytest.fixture(scope="module")
def reg(df):
    return df.withColumn("label", F.col("y"))


@pytest.fixture(scope="module")
def clf(df):
    return df.withColumn("label", F.col("c"))


@pytest.fixture(scope="module")
def tables(reg, clf):
    return growing.binned(reg, "company_id", "regression"), growing.binned(clf, "company_id", "class")


def plain_cut(table, x, y, worth, least=1):
    """The best cut by trying all, with gaps on either side."""
    best = (0.0,)
    for j, edges in enumerate(table.edges):
        v = x[:, j]
        for edge in [*edges, np.inf]:
            for gaps in (False, True) if np.isnan(v).any() else (False,):
                left = np.where(np.isnan(v), gaps, v <= edge)
                if least <= left.sum() <= len(y) - least:
                    gain = worth(y[left]) + worth(y[~left]) - worth(y)
                    if gain > best[0] + 1e-9:
                        best = (gain, j, edge, gaps)
    return best


def shares(c):
    return np.bincount(c, minlength=3) / len(c)


WORTH = {
    "squared": lambda y: y.sum() ** 2 / len(y),
    "poisson": lambda y: y.sum() * np.log(y.mean()),
    "gini": lambda c: len(c) * (shares(c) ** 2).sum(),
    "entropy": lambda c: len(c) * sum(p * np.log(p) for p in shares(c) if p),
}


@pytest.mark.parametrize("criterion", list(WORTH))
@pytest.mark.parametrize("least", [1, 60])
def test_first_cut_equals_trying_all(tables, data, criterion, least):
    x, y, c = data
    kind = criterion in ("gini", "entropy")
    trees = growing.grow(tables[kind], [Rules(criterion, max_depth=1, min_leaf=least)])
    gain, column, cut, gaps = plain_cut(tables[kind], x, c if kind else y, WORTH[criterion], least)
    assert (trees.feature[0], trees.cut[0]) == (column, cut) and trees.gain[0] == pytest.approx(gain, rel=1e-6)
    assert trees.gap_left[0] == gaps


def test_absolute_cut_and_medians(spark, tables, data):
    """With few values of the label, bins are values and medians exact."""
    x, y, _ = data
    y = np.round(y)
    rows = [(i, x[i].tolist(), float(y[i])) for i in range(N)]
    table = growing.binned(spark.createDataFrame(rows, "k long, x array<double>, y double"), "k", "regression", F.col("x"), "y")
    trees = growing.grow(table, [Rules("absolute", max_depth=1)])
    gain, *_ = plain_cut(table, x, y, lambda v: -np.abs(v - np.median(v)).sum())
    assert trees.gain[0] == pytest.approx(gain)
    left = trees.walk(x)[:, 0] == trees.left[0]
    assert trees.value[1:3, 0].tolist() == [np.median(y[left]), np.median(y[~left])]


def test_rows_to_split_and_rows_in_leaves_are_two_conditions(tables):
    split, leaf = (growing.grow(tables[0], [r]) for r in (Rules(min_split=100), Rules(min_leaf=50)))
    inner = split.feature >= 0
    assert (split.size[inner] >= 100).all() and split.size[~inner].min() < 50
    assert leaf.size.min() >= 50


def test_full_trees_fit_what_bins_can_tell(tables, data):
    x, y, _ = data
    trees = growing.grow(tables[0], [Rules()])
    codes = [tuple(-1 if np.isnan(v) else int(np.searchsorted(e, v)) for e, v in zip(tables[0].edges, row, strict=True)) for row in x]
    want = {k: np.mean([y[i] for i in range(N) if codes[i] == k]) for k in set(codes)}
    found = trees.value[trees.walk(x)[:, 0], 0]
    assert np.allclose(found, [want[k] for k in codes])


def test_a_tree_is_the_same_in_any_company(tables, data):
    x, _, _ = data
    rules = [Rules("gini", draw="bootstrap", columns=2, seed=s, fold=-1) for s in range(30)]
    alone, among = growing.grow(tables[1], rules[7:8]), growing.grow(tables[1], rules)
    assert (alone.value[alone.walk(x)][:, 0] == among.value[among.walk(x)][:, 7]).all()


def test_upper_nodes_are_the_shallower_tree(tables, data):
    x, _, _ = data
    deep, flat = (growing.grow(tables[0], [Rules(max_depth=d)]) for d in (None, 2))
    assert (deep.upper(2).value[deep.upper(2).walk(x)] == flat.value[flat.walk(x)]).all()


def test_random_cuts_are_no_edges(tables, data):
    x, _, _ = data
    trees = growing.grow(tables[0], [Rules(max_depth=4, random_cuts=True, seed=s) for s in range(10)])
    # Where a column has one value left, the cut is that value and parts it from gaps.
    inner = np.flatnonzero((trees.feature >= 0) & (trees.feature < 2) & (trees.size > 20))
    edges = [set(e) for e in tables[0].edges]
    assert len(inner) > 30 and not any(trees.cut[i] in edges[trees.feature[i]] for i in inner)
    seen = x[~np.isnan(x).any(axis=1)]
    assert all(seen[:, trees.feature[i]].min() <= trees.cut[i] <= seen[:, trees.feature[i]].max() + 3 for i in inner)
    best = growing.grow(tables[0], [Rules(max_depth=1)]).gain[0]
    assert (trees.gain[:10] <= best * (1 + 1e-9)).all()


def test_scores_of_a_search_are_those_of_separate_ones(clf, reg):
    """Sizes and depths that share a forest are scored as if each had its own, bit for bit."""
    for task, rows in (("class", clf), ("regression", reg)):
        candidates = [{"n": 3, "max_depth": 2}, {"n": 11, "max_depth": None}, {"n": 7, "max_depth": 2}, {"n": 5, "max_depth": 3, "random_cuts": True}]
        build = lambda **p: grown.Forest(task, **p)
        board, best = tuning.search(rows, build, candidates, task, k=3)
        alone = [tuning.search(rows, build, [c], task, k=3)[0].first() for c in candidates]
        assert sorted(map(tuple, board.collect())) == sorted(map(tuple, alone))
        assert best.transform(rows).where("prediction IS NULL").count() == 0


def test_held_out_rows_are_not_learned(reg):
    """Labels that have nothing to do with the columns cannot be told on held-out rows."""
    noise = reg.withColumn("label", F.rand(3))
    board, _ = grown.search_forest(noise, lambda **p: grown.Forest("regression", **p), [{"n": 20}], "regression", k=4)
    assert board.first()["score"] < 0.15
    board, _ = grown.search_boosting(noise, lambda **p: grown.Boosting("regression", **p), [{"n": 10}], "regression", k=4)
    assert board.first()["score"] < 0.15


def test_boosting_search_equals_single_fits(reg):
    candidates = [{"n": 6, "rate": 0.5, "subsample": 0.7}, {"n": 3, "columns": 0.5, "max_depth": 2}]
    build = lambda **p: grown.Boosting("regression", **p)
    together = {r.params: r.score for r in tuning.search(reg, build, candidates, "regression", k=3, metric="mape")[0].collect()}
    for c in candidates:
        alone = tuning.search(reg, build, [c], "regression", k=3, metric="mape")[0].first()
        assert together[alone.params] == pytest.approx(alone.score, rel=1e-9)


def test_one_round_by_hand(reg, data):
    x, y, _ = data
    for l1, l2, gain in ((0.0, 0.0, 0.0), (20.0, 5.0, 10.0)):
        model = grown.Boosting("regression", 1, 0.3, 1, l1=l1, l2=l2, least_gain=gain).fit(reg)

        def shrunk(g):
            return np.sign(g) * max(abs(g) - l1, 0)

        g = y.mean() - y
        (tree,) = model.trees
        left = tree.walk(x)[:, 0] == tree.left[0]
        want = [y.mean() - 0.3 * shrunk(g[s].sum()) / (s.sum() + l2) for s in (left, ~left)]
        assert np.allclose(model.predict(x), np.where(left, *want))

        def worth(v):
            return 0.5 * shrunk(v.sum()) ** 2 / (len(v) + l2)

        assert tree.gain[0] == pytest.approx(plain_cut(growing.binned(reg, "company_id", "regression"), x, g, worth)[0] - gain, rel=1e-6)
    assert grown.Boosting("regression", 2, least_gain=1e9).fit(reg).predict(x) == pytest.approx(y.mean())
    assert grown.Boosting("regression", 2, least_weight=N).fit(reg).predict(x) == pytest.approx(y.mean())


def test_log_loss_falls_each_round(clf, data):
    x, _, c = data
    model = grown.Boosting("class", 8, 0.3, 2).fit(clf)
    losses, upto = [], grown.GrownModel([], [], model.base, model.classes, "classes", 3)
    for trees, outputs in zip(model.trees, model.outputs, strict=True):
        upto = grown.GrownModel([*upto.trees, trees], [*upto.outputs, outputs], model.base, model.classes, "classes", 3)
        e = np.exp(upto.scores(x))
        p = e / e.sum(axis=1, keepdims=True)
        assert np.allclose(p.sum(axis=1), 1)
        losses.append(-np.log(p[np.arange(N), c]).mean())
    assert all(b < a for a, b in zip(losses, losses[1:])) and losses[-1] < losses[0] / 2


def test_probability_boosting_by_hand(clf, data):
    x, _, c = data
    model = grown.ProbabilityAdaBoost(6, max_depth=1).fit(clf)
    w, scores = np.ones(N), np.zeros((N, 3))
    for trees in model.trees:
        leaf = trees.walk(x)[:, 0]
        p = np.array([[w[(leaf == v) & (c == k)].sum() / w[leaf == v].sum() for k in range(3)] for v in leaf])
        log = np.log(np.maximum(p, np.finfo(float).eps))
        scores += 2 * (log - log.mean(axis=1, keepdims=True))
        own = log[np.arange(N), c]
        w = w * np.exp(-2 / 3 * (own - (log.sum(axis=1) - own) / 2))
    assert np.allclose(model.scores(x), scores, atol=1e-3)
    assert (model.predict(x) == c).mean() > 0.8


@pytest.mark.parametrize("task,est", [
    ("regression", lambda: grown.Forest("regression", 20)),
    ("regression", lambda: grown.Forest("regression", 20, random_cuts=True, bootstrap=False)),
    ("regression", lambda: grown.Boosting("regression", 20, 0.3)),
    ("regression", lambda: grown.Boosting("regression", 30, 0.3, loss="absolute")),
    ("regression", lambda: grown.Tree("regression", 4, criterion="absolute")),
    ("class", lambda: grown.Forest("class", 20, min_leaf=0.02)),
    ("class", lambda: grown.Boosting("class", 10, 0.3)),
    ("class", lambda: grown.ProbabilityAdaBoost(10, max_depth=2)),
])
def test_models_learn_keep_gaps_and_come_back(reg, clf, tmp_path, task, est):
    """Every row is predicted, gaps and all, and a saved model predicts the same."""
    rows = reg if task == "regression" else clf
    model = est().fit(rows)
    predicted = model.transform(rows)
    assert predicted.where("prediction IS NOT NULL AND NOT isnan(prediction)").count() == N
    assert models.evaluator(task).evaluate(predicted) > (0.8 if task == "class" else 0.6)
    save_model(model, str(tmp_path / "m"))
    again = load_model(str(tmp_path / "m"))
    pairs = [sorted(map(tuple, m.transform(rows).select("company_id", "prediction").collect())) for m in (model, again)]
    assert pairs[0] == pairs[1]
    assert np.allclose(model.importances(), again.importances())


def test_odd_tables(spark):
    """No rows, no columns with values, one class, equal rows, absent labels."""
    none = spark.createDataFrame([], "company_id long, x array<double>, label double").withColumn("features", array_to_vector("x"))
    assert grown.Forest("regression", 3).fit(none).transform(none).count() == 0
    same = [(i, [1.0, float("nan")], 2.0 if i else None) for i in range(9)]
    same = spark.createDataFrame(same, "company_id long, x array<double>, label double").withColumn("features", array_to_vector("x"))
    for est in (grown.Forest("regression", 3), grown.Boosting("regression", 3), grown.Forest("class", 3), grown.Boosting("class", 2), grown.ProbabilityAdaBoost(3)):
        assert {r.prediction for r in est.fit(same).transform(same).collect()} == {2.0}


def test_more_trees_mean_no_more_jobs(spark, tables):
    """Levels, not trees, make jobs."""
    tracker = spark.sparkContext.statusTracker()
    counts = []
    for n in (1, 40):
        group = f"growing-{n}"
        spark.sparkContext.setJobGroup(group, group)
        growing.grow(tables[0], [Rules(max_depth=3, seed=s, draw="bootstrap") for s in range(n)])
        counts.append(len(tracker.getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts[0] == counts[1]


def test_a_tree_beyond_the_budget_is_refused(tables, monkeypatch):
    monkeypatch.setattr(growing, "NODE_BUDGET", 10)
    with pytest.raises(ValueError):
        growing.grow(tables[0], [Rules()])
