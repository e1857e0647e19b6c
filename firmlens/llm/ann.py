"""Approximate nearest neighbours by inner product with an inverted multi-index."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from firmlens.llm.common import share
from firmlens.session import parallelism, settle

#: Bound of the sample that the centroids and the share of rows to visit are fitted on.
SAMPLE_ROWS = 20_000
TRIAL_QUERIES = 200
#: Recall that the share of rows visited must reach on the sample.
RECALL = 0.96
MOST_CENTROIDS = 256
ROUNDS = 12
#: Rows of the index, and queries, that meet in one step of a task.
PART_ROWS = 4096
QUERIES_TOGETHER = 2048
QUERIES_AT_ONCE = 256
SEED = 13


def usable(vector: str) -> Column:
    """Neither null nor zero, and all components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def _nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((centroids**2).sum(1) - 2 * points @ centroids.T).argmin(1)


def k_means(points: np.ndarray, k: int) -> np.ndarray:
    """Lloyd's rounds from distinct random points; an empty centroid keeps its place."""
    distinct = np.unique(points, axis=0)
    centroids = distinct[np.random.default_rng(SEED).permutation(len(distinct))[:k]].copy()
    for _ in range(ROUNDS):
        near = _nearest(points, centroids)
        sizes = np.bincount(near, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, points)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
    return centroids


@dataclass
class MultiIndex:
    """Centroids of the two halves; ``rows``: (estimated) distinct vectors of each pair of centroids;
    ``visit``: the share of them that a query looks at."""

    first: np.ndarray
    second: np.ndarray
    rows: np.ndarray
    visit: float = 1.0

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        cut = self.first.shape[1]
        return _nearest(vectors[:, :cut], self.first) * len(self.second) + _nearest(vectors[:, cut:], self.second)

    def order(self, query: np.ndarray) -> Iterator[int]:
        """Pairs of centroids by summed distance (the negative inner product of each half): the
        multi-sequence walk, a heap of the pairs whose predecessors in both halves are done."""
        cut = self.first.shape[1]
        a, b = -(self.first @ query[:cut]), -(self.second @ query[cut:])
        at, bt = np.argsort(a, kind="stable").tolist(), np.argsort(b, kind="stable").tolist()
        a, b = a[at].tolist(), b[bt].tolist()
        heap, done = [(a[0] + b[0], 0, 0)], [0] * len(at)
        n, m = len(at), len(bt)
        while heap:
            _, i, j = heapq.heappop(heap)
            yield at[i] * m + bt[j]
            done[i] = j + 1
            if j + 1 < m and (i == 0 or done[i - 1] > j + 1):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
            if i + 1 < n and done[i + 1] == j:
                heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))

    def visited(self, query: np.ndarray, least: int) -> list[int]:
        """The cells in that order until they hold the share of rows, and at least ``least``."""
        wanted = max(least, self.visit * self.rows.sum())
        found, cells = 0.0, []
        for cell in self.order(query):
            if self.rows[cell]:
                cells.append(cell)
                found += self.rows[cell]
                if found >= wanted:
                    break
        return cells


def _trial(index: MultiIndex, sample: np.ndarray, k: int) -> float:
    """The share of rows after which ``RECALL`` of the true neighbours of sample queries are seen."""
    queries = sample[np.random.default_rng(SEED).permutation(len(sample))[:TRIAL_QUERIES]]
    near = min(k, len(sample) - 1)
    if near < 1:
        return 1.0
    cells, total = index.cells(sample), index.rows.sum()
    seen = []
    for q in queries:
        score = sample @ q
        true = np.argpartition(-score, min(near, len(score) - 1))[: near + 1]
        order = np.fromiter(index.order(q), np.int64)
        after = np.zeros(len(index.rows))
        after[order] = np.cumsum(index.rows[order]) / total
        seen += after[cells[true]].tolist()
    return float(np.quantile(seen, RECALL))


def fit(vectors: DataFrame, k: int = 20, sample_rows: int = SAMPLE_ROWS) -> MultiIndex:
    """Centroids, and the share of rows to visit, from a sample of ``vectors`` (vec_id, v) that is
    drawn by a hash of vec_id; the rows of each pair of centroids are counted over all rows."""
    n = vectors.count()
    drawn = vectors.where(share(F.col("vec_id"), SEED) < min(1.0, sample_rows / max(1, n))).select("vec_id", "v").collect()
    drawn.sort(key=lambda r: (r["vec_id"], r["v"]))
    if not drawn:  # by chance, of a few rows
        drawn = vectors.orderBy("vec_id").limit(1000).select("vec_id", "v").collect()
    sample = np.unique(np.array([r["v"] for r in drawn], float), axis=0)
    size = int(np.clip(round(n**0.5 / 7), 2, MOST_CENTROIDS))
    cut = max(1, sample.shape[1] // 2)
    index = MultiIndex(k_means(sample[:, :cut], size), k_means(sample[:, cut:], size), np.zeros(0))
    cells = len(index.first) * len(index.second)
    index.rows = np.bincount(index.cells(sample), minlength=cells).astype(float)
    index.visit = _trial(index, sample, k)
    return index


def _celled(vectors: DataFrame, index: MultiIndex) -> DataFrame:
    @F.pandas_udf("int")
    def cell(part: pd.Series) -> pd.Series:
        return pd.Series(index.cells(np.stack(part.to_numpy()).astype(float)) if len(part) else [], dtype="int32")

    return vectors.withColumn("cell", cell("v"))


def _parts(counts: dict[int, int], cells: int) -> tuple[np.ndarray, np.ndarray]:
    """The first part of each cell and over how many it is dealt: small cells share a part, a cell
    with more rows than a part has several of its own."""
    first, pieces = np.zeros(cells, np.int64), np.ones(cells, np.int64)
    part, held = 0, 0
    for cell in sorted(counts):
        n = counts[cell]
        if held and held + n > PART_ROWS:
            part, held = part + 1, 0
        first[cell], pieces[cell] = part, -(-n // PART_ROWS)
        if pieces[cell] > 1:
            part, held = part + pieces[cell], 0
        else:
            held += n
    return first, pieces


def _packed(rows: DataFrame, key: str, columns: str) -> DataFrame:
    """One row per group of bounded size: its ids, cells and vectors as arrays in a row."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        vectors = np.stack(pdf["v"].to_numpy()).astype(np.float64)
        row = {key: pdf[key].iat[0], "ids": pdf["vec_id"].to_numpy(np.int64).tobytes(), "vectors": vectors.tobytes()}
        if "cells" in columns:
            row["cells"] = pdf["cell"].to_numpy(np.int32).tobytes()
        return pd.DataFrame([row])

    return rows.groupBy(key).applyInPandas(pack, columns)


def _best(query: np.ndarray, query_id: int, scores: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[list, list]:
    """The ``k`` best by exact score, ties to the smaller id. Matrix products round differently from
    row to row, so all that come within that rounding are measured again, each in the same way."""
    scores = np.where(ids == query_id, -np.inf, scores)
    if len(scores) > k:
        limit = np.partition(scores, len(scores) - k)[len(scores) - k]
        limit -= 1e-9 * (1 + abs(limit)) if np.isfinite(limit) else 0
        near = np.flatnonzero((scores >= limit) & np.isfinite(scores))
    else:
        near = np.flatnonzero(np.isfinite(scores))
    exact = (vectors[near] * query).sum(axis=1)
    order = np.lexsort((ids[near], -exact))[:k]
    return ids[near][order].tolist(), exact[order].tolist()


def search(vectors: DataFrame, queries: Column, k: int = 20, index: MultiIndex | None = None) -> DataFrame:
    """The ``k`` nearest of each row of ``vectors`` (vec_id, embedding) that ``queries`` marks, among
    all other rows: query_id, rank (from 1), vec_id, score. Largest inner product first, in double
    precision on the vectors as they are; ties to the smaller vec_id; all candidates, if fewer.

    Every row is in the index. A query walks pairs of half centroids by summed distance until they
    hold the fitted share of the rows, and everything there is measured. Index and queries meet in
    blocks of bounded size: cells are gathered into parts, a cell with very many rows is dealt over
    several, and queries of the same neighbourhood travel together.

    Null ids and null, zero or non-finite vectors take no part, nor do vectors of another length
    than the commonest (the longer one at a tie). Equal rows count once. No rows give no rows.
    """
    spark = vectors.sparkSession
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"), queries.alias("q"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable("v"))
    sizes = sorted((r["count"], r["n"]) for r in rows.groupBy(F.size("v").alias("n")).count().collect())
    if not sizes:
        return none
    rows = rows.where(F.size("v") == sizes[-1][1])
    index = index or fit(rows, k)
    celled = settle(_celled(rows, index))
    stats = celled.groupBy("cell").agg(F.count("*").alias("n"), F.approx_count_distinct(F.xxhash64("v")).alias("d")).collect()
    cells = len(index.first) * len(index.second)
    index.rows = np.zeros(cells)
    for r in stats:
        index.rows[r["cell"]] = max(1, r["d"])
    first, pieces = _parts({r["cell"]: r["n"] for r in stats}, cells)

    @F.pandas_udf("long")
    def part(cell: pd.Series, vec_id: pd.Series) -> pd.Series:
        c = cell.to_numpy()
        return pd.Series(first[c] + vec_id.to_numpy() % pieces[c])

    parts = celled.dropDuplicates(["vec_id", "v"]).withColumn("part", part("cell", "vec_id"))
    packed = settle(_packed(parts.select("part", "cell", "vec_id", "v"), "part", "part long, ids binary, vectors binary, cells binary"))

    # Queries of a neighbouring home cell form a block; each block names the parts that it visits.
    asked = celled.where("q").dropDuplicates(["vec_id", "v"])
    homes = {r["cell"]: r["count"] for r in asked.groupBy("cell").count().collect()}
    if not homes:
        return none
    home, home_pieces = _parts({c: -(-n * PART_ROWS // QUERIES_TOGETHER) for c, n in homes.items()}, cells)

    @F.pandas_udf("long")
    def block(cell: pd.Series, vec_id: pd.Series) -> pd.Series:
        c = cell.to_numpy()
        mixed = (vec_id.to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        return pd.Series(home[c] + mixed.astype(np.int64) % home_pieces[c])

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        """A row for each part that a block of queries visits, with the queries and their cells there."""
        pdf = pdf.sort_values("vec_id")
        queries_here = np.stack(pdf["v"].to_numpy()).astype(float)
        ids = pdf["vec_id"].to_numpy(np.int64)
        seen = np.zeros((len(ids), cells), bool)
        for i, q in enumerate(queries_here):
            seen[i, index.visited(q, 2 * k)] = True
        out = []
        where: dict[int, list[int]] = {}
        for c in np.flatnonzero(seen.any(0)).tolist():
            for p in range(int(pieces[c])):
                where.setdefault(int(first[c]) + p, []).append(c)
        for p, own in where.items():
            some = seen[:, own].any(1)
            out.append((p, ids[some].tobytes(), queries_here[some].tobytes(), np.array(own, np.int32).tobytes(), np.packbits(seen[some][:, own], axis=1).tobytes()))
        return pd.DataFrame(out, columns=["part", "query_ids", "queries", "own", "seen"])

    walks = asked.withColumn("block", block("cell", "vec_id")).groupBy("block").applyInPandas(
        walk, "part long, query_ids binary, queries binary, own binary, seen binary"
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, cell = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["cells"], np.int32)
                points = np.frombuffer(r["vectors"]).reshape(len(ids), -1)
                asked_ids, own = np.frombuffer(r["query_ids"], np.int64), np.frombuffer(r["own"], np.int32)
                wanted = np.frombuffer(r["queries"]).reshape(len(asked_ids), -1)
                seen = np.unpackbits(np.frombuffer(r["seen"], np.uint8).reshape(len(asked_ids), -1), axis=1, count=len(own)).astype(bool)
                place = np.searchsorted(own, cell).clip(max=len(own) - 1)
                there = own[place] == cell
                out: tuple[list, list, list] = ([], [], [])
                for at in range(0, len(asked_ids), QUERIES_AT_ONCE):
                    stop = at + QUERIES_AT_ONCE
                    scores = np.where(seen[at:stop][:, place] & there, wanted[at:stop] @ points.T, -np.inf)
                    for q, i, s in zip(wanted[at:stop], asked_ids[at:stop].tolist(), scores, strict=True):
                        found, exact = _best(q, i, s, ids, points, k)
                        out[0].extend([i] * len(found))
                        out[1].extend(found)
                        out[2].extend(exact)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], ["query_id", "vec_id", "score"])

    met = settle(walks).join(packed, "part").repartition(parallelism(spark)).mapInArrow(meet, "query_id long, vec_id long, score double")
    best = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
