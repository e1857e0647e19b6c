import numpy as np
import pytest
from pyspark.sql import functions as F

from firmlens.llm import ann
from firmlens.llm.queries import QUERIES


def exact(vectors, query_id, query, k=20):
    found = {}
    for i, v in vectors:
        if i != query_id:
            found[i] = max(found.get(i, -np.inf), float((np.array(v, float) * np.array(query, float)).sum()))
    return sorted(found.items(), key=lambda x: (-x[1], x[0]))[:k]


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_pairs_come_by_summed_distance():
    rng = np.random.default_rng(1)
    index = ann.MultiIndex(rng.normal(size=(7, 3)), rng.normal(size=(5, 4)), np.ones(35))
    q = rng.normal(size=7)
    order = list(index.order(q))
    sums = [float(index.first[c // 5] @ q[:3] + index.second[c % 5] @ q[3:]) for c in order]
    assert sorted(order) == list(range(35)) and sums == sorted(sums, reverse=True)
    index.rows[:] = 10
    index.visit = 0.2
    assert index.visited(q, 1) == order[:7]


def test_recall_and_scores_on_the_table(spark):
    sf = "/root/testdata/sf0.1"
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    found = by_query(QUERIES["op1_inverted_multi_index"].run(spark, sf).collect())
    assert sorted(found) == [i for i, _ in sorted(vectors) if i % 20 == 0]
    points = dict(vectors)
    hit = 0
    for i, rows in found.items():
        assert [r for r, _, _ in rows] == list(range(1, 21))
        assert all(abs(s - float((np.array(points[v], float) * np.array(points[i], float)).sum())) < 1e-12 for _, v, s in rows)
        hit += len({v for _, v, _ in rows} & {v for v, _ in exact(vectors, i, points[i])})
    assert hit >= 0.9 * 20 * len(found)


@pytest.mark.parametrize("part", [4096, 7])
def test_hot_vector_ties_and_clusters(spark, monkeypatch, part):
    monkeypatch.setattr(ann, "PART_ROWS", part)
    monkeypatch.setattr(ann, "QUERIES_TOGETHER", 5)
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(6, 8)) * 3
    rows = [(i, (centers[i % 6] + rng.normal(size=8) * 0.1).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, [1.0, 2.0, 0.5, 0.0, 0.0, 1.0, 0.0, 3.0]) for i in range(150)]
    found = by_query(ann.search(table(spark, rows), F.col("vec_id") % 20 == 0).collect())
    assert set(found) == {i for i, _ in rows if i % 20 == 0}
    points, hit = dict(rows), 0
    for i, got in found.items():
        want = exact(rows, i, points[i])
        hit += len({v for _, v, _ in got} & {v for v, _ in want})
        if i >= 1000:
            copies = [v for _, v, s in got if s == got[0][2]]
            assert copies == sorted(copies)
    assert hit >= 0.9 * sum(map(len, found.values()))


def test_odd_rows(spark):
    ok = [(i, [float(i % 7 + 1), 1.0, 0.5 * i]) for i in range(1, 41)]
    odd = [(60, None), (80, [0.0, 0.0, 0.0]), (100, [1.0, None, 1.0]), (120, [float("nan"), 1.0, 1.0]), (140, [float("inf"), 1.0, 1.0]), (160, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (180, [])]
    df = table(spark, ok + odd + [(20, ok[19][1])]).withColumn("cell", F.lit("x")).withColumn("v", F.lit(1)).withColumn("part", F.lit(1))
    found = by_query(ann.search(df, F.col("vec_id") % 20 == 0).collect())
    assert sorted(found) == [20, 40]
    for i, got in found.items():
        assert [(v, s) for _, v, s in got] == exact(ok, i, dict(ok)[i])
    assert by_query(ann.search(table(spark, ok[:20]), F.col("vec_id") == 20, k=50).collect())[20][-1][0] == 19
    assert ann.search(table(spark, odd[:3]), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.search(table(spark, ok), F.col("vec_id") < 0).count() == 0
    assert ann.search(table(spark, [(20, [1.0])]), F.lit(True)).count() == 0
    assert [tuple(r) for r in ann.search(table(spark, [(1, [2.0]), (2, [3.0])]), F.lit(True)).orderBy("query_id").collect()] == [(1, 1, 2, 6.0), (2, 1, 1, 6.0)]
