"""Neighbour search against brute force, on both ways, with a hot point and missing cells."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmlens.operators import balance, knn
from firmlens.operators.imputation import impute_knn
from firmlens.operators.models import knn_predict

N = 400


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(N, 3)).round(1)
    x[: N // 3] = 0.5
    x[rng.random(x.shape) < 0.1] = np.nan
    x[-1] = np.nan
    return x, rng.integers(0, 3, N)


@pytest.fixture(scope="module")
def cloud_df(spark, cloud):
    x, lab = cloud
    rows = [(i, int(lab[i]), *(None if np.isnan(v) else float(v) for v in x[i])) for i in range(N)]
    return spark.createDataFrame(rows, "id long, lab int, a double, b double, c double").repartition(5)


def brute(x, lab, k, exclude_self, within):
    out = []
    for i in range(N):
        d = knn.distances(np.repeat(x[i : i + 1], N, 0), x)
        pool = [(d[j], j) for j in range(N) if np.isfinite(d[j]) and not (exclude_self and i == j) and not (within and lab[i] != lab[j])]
        out += [(i, j, v) for v, j in sorted(pool)[:k]]
    return out


@pytest.mark.parametrize("small_rows", [10**6, 0])
@pytest.mark.parametrize("exclude_self,within", [(True, ()), (False, ()), (True, ("lab",))])
def test_knn_join(cloud, cloud_df, small_rows, exclude_self, within):
    found = knn.knn_join(
        cloud_df, cloud_df, 4, ["a", "b", "c"], "id", within, None, exclude_self, ["lab"], small_rows, leaf_rows=40
    )
    got = sorted((r["query"], r["rank"], r["neighbour"], r["distance"], r["lab"]) for r in found.collect())
    assert [(q, n, d) for q, _, n, d, _ in got] == brute(*cloud, 4, exclude_self, bool(within))
    assert all(cloud[1][n] == lab for _, _, n, _, lab in got)


def test_many_queries_per_leaf_are_split(cloud, cloud_df, monkeypatch):
    monkeypatch.setattr(knn, "QUERY_CHUNK", 16)
    found = knn.knn_join(cloud_df, cloud_df, 3, ["a", "b", "c"], "id", exclude_self=True, small_rows=0, leaf_rows=50)
    got = sorted((r["query"], r["rank"], r["neighbour"]) for r in found.collect())
    assert [(q, n) for q, _, n in got] == [(q, n) for q, n, _ in brute(*cloud, 3, True, False)]


def test_impute_zero_distance_takes_all(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0), (2, 1.0, None), (3, 3.0, 5.0)], "id long, a double, b double")
    got = {r["id"]: r["b"] for r in impute_knn(df, "id", ["a", "b"], k=2).collect()}
    assert got == {1: 1.0, 2: 1.0, 3: 5.0}


def test_impute_inverse_distance(spark):
    df = spark.createDataFrame([(1, 0.0, None), (2, 1.0, 10.0), (3, 3.0, 20.0)], "id long, a double, b double")
    got = {r["id"]: r["b"] for r in impute_knn(df, "id", ["a", "b"], k=2).collect()}
    assert got[1] == pytest.approx(12.5)


def test_impute_without_comparable_row_uses_the_mean(spark):
    df = spark.createDataFrame([(1, None, None), (2, 1.0, 10.0), (3, 3.0, 20.0)], "id long, a double, b double")
    got = {r["id"]: (r["a"], r["b"]) for r in impute_knn(df, "id", ["a", "b"]).collect()}
    assert got[1] == (2.0, 15.0)


def test_impute_all_missing_column_stays(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 2.0, None)], "id long, a double, b double")
    assert [r["b"] for r in impute_knn(df, "id", ["a", "b"]).collect()] == [None, None]


def test_predict_vote_tie_goes_to_the_lowest_class(spark):
    train = spark.createDataFrame([(1, 0.0, 2), (2, 2.0, 1)], "id long, x double, y int")
    test = spark.createDataFrame([(9, 1.0)], "id long, x double")
    assert knn_predict(train, test, 2, ["x"], "id", "y", "class").first()["prediction"] == 1.0


def test_enn_and_tomek(spark):
    rows = [(1, 0.0, 0.0, 0), (2, 0.0, 1.0, 0), (3, 1.0, 0.0, 0), (4, 0.5, 0.5, 1)]
    df = spark.createDataFrame(rows, "id long, x double, y double, lab int")
    assert balance.enn(df, "lab", ["x", "y"], "id").count() == 0
    pair = spark.createDataFrame([(1, 0.0, 0), (2, 0.1, 1), (3, 5.0, 0), (4, 5.2, 0)], "id long, x double, lab int")
    left = balance.tomek_links(pair, "lab", ["x"], "id")
    assert sorted(r["id"] for r in left.collect()) == [2, 3, 4]


def test_smote_balances_between_parents(spark):
    rows = [(i, float(i), float(i * 2), 0) for i in range(30)] + [(100 + i, 50.0 + i, 7.0, 1) for i in range(7)]
    rows += [(200, 90.0, 90.0, 2)]
    df = spark.createDataFrame(rows, "id long, x double, y double, lab int")
    out = balance.smote(df, "lab", ["x", "y"], "id").collect()
    sizes = {c: sum(r["lab"] == c for r in out) for c in (0, 1, 2)}
    assert sizes == {0: 30, 1: 30, 2: 30}
    made = [r for r in out if r["synthetic"]]
    assert all(50.0 <= r["x"] <= 56.0 and r["y"] == 7.0 for r in made if r["lab"] == 1)
    assert len({r["id"] for r in out}) == 90
    again = balance.smote(df.repartition(7), "lab", ["x", "y"], "id").collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))


def test_smote_splits_very_many_copies(spark, monkeypatch):
    monkeypatch.setattr(balance, "COPIES_PER_TASK_ROW", 8)
    df = spark.range(200).select("id", F.col("id").cast("double").alias("x"), (F.col("id") < 3).cast("int").alias("lab"))
    out = balance.smote(df, "lab", ["x"], "id")
    assert {r[0]: r[1] for r in out.groupBy("lab").count().collect()} == {0: 197, 1: 197}


def test_a_query_goes_once_to_leaves_that_lie_side_by_side(spark, monkeypatch):
    """Evenly spread columns let hardly a leaf be left out; still a query is written once, not once a leaf."""
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, rng.normal(size=16).tolist()) for i in range(600)], "id long, x array<double>")
    written, settle = [], knn.settle
    monkeypatch.setattr(knn, "settle", lambda d: written.append(settle(d)) or written[-1])
    found = knn.knn_join(df, df, 2, ["x"], "id", exclude_self=True, small_rows=0, leaf_rows=20)
    assert found.count() == 1200
    assert written[-1].count() <= 600


def test_a_query_without_a_key_keeps_its_neighbours_in_leaves(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(200)], "id long, x array<double>")
    asked = df.where("id < 5").withColumn("id", F.when(F.col("id") > 0, F.col("id")))
    ways = [knn.knn_join(asked, df, 3, ["x"], "id", small_rows=n, leaf_rows=20).collect() for n in (0, 10**6)]
    one, other = ([sorted((r["query"] or -1, r["rank"], r["neighbour"]) for r in rows) for rows in ways])
    assert one == other and len(one) == 15


@pytest.mark.parametrize("gaps", [0.0, 0.2])
def test_a_query_looks_at_few_of_many_boxes(monkeypatch, gaps):
    """The leaves to visit are those that bounds of every leaf would name, but few bounds are computed."""
    rng = np.random.default_rng(4)
    n, k, looked = 8_192, 5, []
    corner = np.array([(i // 1_024, i // 32 % 32, i % 32) for i in range(n)], dtype="f8")
    low = np.where(np.repeat(rng.random((4, 3)) < gaps, n // 4, axis=0), np.nan, corner)
    low[:4, 1] = np.nan
    boxes = knn._Boxes.over(np.arange(n), np.full(n, "g", dtype=object), np.full(n, 3), low, low + 0.9)
    x = rng.random((300, 3)) * [8, 32, 32]
    x[rng.random(x.shape) < gaps] = np.nan
    radius = np.where(rng.random(300) < 0.1, np.inf, 0.7)
    real = knn._Level.bounds
    monkeypatch.setattr(knn._Level, "bounds", lambda s, x, q, at: looked.append(len(at)) or real(s, x, q, at))
    found = {(q, leaf) for part in boxes.visits(x, "g", -1, radius, k) for q, leaf in zip(*map(np.ndarray.tolist, part))}
    homes = {q: leaf for part in boxes.home(x, "g", -1, 1) for q, leaf in zip(*map(np.ndarray.tolist, part))}
    few = sum(looked)
    q, at = np.repeat(np.arange(300), n), np.tile(np.arange(n), 300)
    near, far = real(boxes.levels[0], x, q, at)
    sure = np.sort(far.reshape(300, n), axis=1)[:, 1]  # two leaves hold six rows
    go = np.isfinite(near) & (near <= np.minimum(radius, sure)[q] * (1 + 1e-9))
    assert found == set(zip(q[go].tolist(), at[go].tolist()))
    assert set(homes) == {int(i) for i in np.flatnonzero(np.isfinite(near).reshape(300, n).any(axis=1))}
    assert all(np.isfinite(near[i * n + leaf]) for i, leaf in homes.items())
    if not gaps:
        assert few < 300 * n / 8


def test_neighbours_searched_once_score_as_those_of_a_cross_validator(spark, monkeypatch):
    """One search a fold serves all candidates."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.tuning import CrossValidator

    from firmlens.operators import models, tuning
    from firmlens.operators.splitting import stratified_folds

    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=2).round(1).tolist(), float(rng.integers(0, 3))) for i in range(120)]
    df = spark.createDataFrame(rows, "company_id long, x array<double>, label double").select("company_id", array_to_vector("x").alias("features"), "label")
    values = tuning.CLASS_GRIDS["neighbours"]
    searched, real = [], models.knn_join
    monkeypatch.setattr(models, "knn_join", lambda *a, **o: searched.append(1) or real(*a, **o))
    board, best = tuning.grid_search(df, lambda **p: models.Neighbours("class", **p), values, "class", k=2)
    got = {r["params"]: r["score"] for r in board.collect()}
    assert len(searched) == 2
    folded = stratified_folds(df, "label", "company_id", 2, seed=42)
    pipeline, candidates = Pipeline(stages=[]), tuning.grid(values)
    maps = [{pipeline.stages: [models.Neighbours("class", **c)]} for c in candidates]
    judge = models.evaluator("class", None)
    cv = CrossValidator(estimator=pipeline, estimatorParamMaps=maps, evaluator=judge, numFolds=2, foldCol="fold").fit(folded)
    assert got == {tuning.json.dumps(c, sort_keys=True): s for c, s in zip(candidates, cv.avgMetrics)}
    assert best.transform(df).count() == 120
