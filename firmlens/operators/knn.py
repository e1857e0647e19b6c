"""Exact nearest-neighbour join without a cross join.

Distance is Euclidean over the columns both rows have, scaled by ``n / n_shared`` where some are
missing. Neighbours are ordered by distance, then key. Rows that share no column are no neighbours.

* A base of at most ``SMALL_ROWS`` rows is counted, collected and broadcast; queries are searched
  in vectorised blocks.
* A bigger base is cut into box-shaped leaves (median splits of a bounded sample, separately per
  group and missing-cell pattern). Each query first searches a leaf near it; the distance found
  there rules out all leaves whose box is farther away, and the query visits only the rest. Boxes
  are the true minima and maxima of the leaves, so the result does not depend on the sample.
  Neighbouring leaves have a common box, and so have those boxes: a query looks into a box only if
  that is near enough, not at every leaf.

Equal points need no more than ``k + 1`` of their rows in the base, since ties go to the lower key;
that keeps a point held by a third of all rows from filling a leaf. Neighbouring leaves are searched
together: a query goes there once, with the list of leaves to visit, and takes its ``k`` nearest of
them along. Leaves that very many queries visit are searched by several tasks, each with a part of
the queries.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from firmlens.functions.columns import col
from firmlens.session import parallelism, settle

SMALL_ROWS = 32_768
SMALL_CELLS = 4_000_000
LEAF_ROWS = 2_048
MAX_LEAVES = 65_536
SAMPLE_CELLS = 4_000_000
#: Sampled rows that a leaf is cut by, and boxes that a box above the leaves holds.
SAMPLE_PER_LEAF = 64
FANOUT = 16
QUERY_CHUNK = 16_384
#: Base rows of neighbouring leaves that one task searches, and found rows it keeps before it ranks them.
TOGETHER_ROWS = 16_384
FOUND_ROWS = 200_000
PAIRS_PER_TASK = 20_000_000
BLOCK_CELLS = 250_000


def knn_join(
    queries: DataFrame,
    base: DataFrame,
    k: int,
    cols: Sequence[str],
    key: str,
    within: Sequence[str] = (),
    need: str | None = None,
    exclude_self: bool = False,
    carry: Sequence[str] = (),
    small_rows: int = SMALL_ROWS,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """The ``k`` nearest base rows of every query row.

    ``cols`` are numeric columns, or one array column. ``within``: few-valued columns that must be
    equal on both sides. ``need``: a query column with the position in ``cols`` that a neighbour
    must have; its value is returned as ``value``. ``carry``: base columns to return. Result:
    ``query, need, neighbour, distance, value, rank`` and the carried columns.
    """
    taken = {"query", "need", "neighbour", "distance", "value", "rank"} & set(carry)
    if taken:
        raise ValueError(f"carried columns clash with result columns: {sorted(taken)}")
    inner = {f"carry{i}": c for i, c in enumerate(carry)}
    group = F.concat_ws("|", F.lit("g"), *(col(c).cast("string") for c in within))
    wanted = F.lit(-1) if need is None else col(need).cast("int")
    # The base is read several times below, so it is computed once.
    right = settle(
        base.select(col(key).alias("neighbour"), group.alias("g"), _vector(base, cols).alias("x"), *(col(c).alias(i) for i, c in inner.items()))
    )
    same = queries is base and need is None
    if same:
        left = right.select(F.col("neighbour").alias("query"), wanted.alias("need"), "g", "x")
    else:
        # Counted and then searched.
        left = settle(queries.select(col(key).alias("query"), wanted.alias("need"), group.alias("g"), _vector(queries, cols).alias("x")))
    total = right.count()
    carried = [f for f in right.schema.fields if f.name in inner]
    width = (right.select(F.size("x")).first() or [1])[0] if len(cols) == 1 else len(cols)
    out = T.StructType(
        [
            T.StructField("query", left.schema["query"].dataType),
            T.StructField("need", T.IntegerType()),
            T.StructField("neighbour", right.schema["neighbour"].dataType),
            T.StructField("distance", T.DoubleType()),
            T.StructField("value", T.DoubleType()),
            *carried,
        ]
    )
    if total <= small_rows and total * width <= SMALL_CELLS:
        found = _against_broadcast(left, right, k, exclude_self, out, same)
    else:
        found = _against_leaves(left, right, total, width, k, exclude_self, out, leaf_rows)
    # At most k rows per query (and visited leaf) reach this window.
    order = Window.partitionBy("query", "need").orderBy("distance", "neighbour")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.withColumnsRenamed(inner)


def _vector(df: DataFrame, cols: Sequence[str]):
    """The columns as one array in which missing values are NULL."""

    def known(v):
        v = v.cast("double")
        # Infinite values have no distance either. Adding 0.0 turns -0.0 into 0.0, so that equal
        # points are equal arrays.
        return F.when(F.abs(v) < float("inf"), v + 0.0)

    if len(cols) == 1 and isinstance(df.schema[cols[0]].dataType, T.ArrayType):
        return F.transform(col(cols[0]), known).cast("array<double>")
    return F.array(*(known(col(c)) for c in cols)).cast("array<double>")


# ---- vectorised search of one block of base rows ------------------------------------------------


def _matrix(series: pd.Series) -> np.ndarray:
    return np.array(series.tolist(), dtype="f8").reshape(len(series), -1)


def distances(q: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of each row of ``q`` to the same row of ``b``, added up column by column."""
    n = q.shape[1]
    total = np.zeros(len(q))
    shared = np.zeros(len(q), dtype="i4")
    for j in range(n):
        diff = q[:, j] - b[:, j]
        known = ~np.isnan(diff)
        total += np.where(known, diff * diff, 0.0)
        shared += known
    with np.errstate(divide="ignore", invalid="ignore"):
        total = np.where(shared == n, total, total / shared * n)
    total[shared == 0] = np.inf
    return np.sqrt(total)


class _Block:
    """Base rows prepared for the squared-distance estimate ``q.q + b.b - 2 q.b``.

    Missing cells are 0 in the products, and 0/1 masks pick the shared columns.
    """

    def __init__(self, x: np.ndarray):
        self.x = x
        known = ~np.isnan(x)
        filled = np.where(known, x, 0.0)
        rows = known.sum(axis=0)
        # Centred values keep the products small.
        self.centre = filled.sum(axis=0) / np.maximum(rows, 1)
        self.gaps = not known.all()
        self.values = np.where(known, x - self.centre, 0.0)
        self.squares = self.values * self.values
        self.mask = known.astype("f8") if self.gaps else None
        # A leaf has the same gaps in all its rows.
        self.same = known[0].astype("f8") if self.gaps and (known == known[0]).all() else None
        self.paired = None if self.same is None else np.concatenate([self.squares, -2.0 * self.values], axis=1).T.copy()
        self.norm = self.squares.sum(axis=1)

    def estimate(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated squared distances, and per query how far an estimate may be off."""
        n = q.shape[1]
        known = ~np.isnan(q)
        values = np.where(known, q - self.centre, 0.0)
        squares = values * values
        norm = squares.sum(axis=1)
        if self.same is not None:
            mask = known.astype("f8")
            out = np.concatenate([mask, values], axis=1) @ self.paired
            out += (squares @ self.same)[:, None]
            shared = mask @ self.same
            with np.errstate(divide="ignore"):
                out *= (n / shared)[:, None]
            out[shared == 0] = np.inf
            scale = float(n)
        elif self.gaps or not known.all():
            mask = known.astype("f8")
            base_mask = self.mask if self.gaps else np.ones_like(self.values)
            out = squares @ base_mask.T
            out += mask @ self.squares.T
            out -= 2.0 * (values @ self.values.T)
            shared = mask @ base_mask.T
            with np.errstate(divide="ignore", invalid="ignore"):
                out *= n / shared
            out[shared == 0] = np.inf
            scale = float(n)
        else:
            out = values @ (-2.0 * self.values.T)
            out += self.norm[None, :]
            out += norm[:, None]
            scale = 1.0
        # Rounding of sums of n products, with a wide safety factor.
        slack = 1e-14 * (n + 8) * scale * (norm + self.norm.max(initial=0.0))
        return out, slack


def _nearest(block: _Block, at: np.ndarray | None, q: np.ndarray, own: np.ndarray, k: int, radius: np.ndarray | None = None):
    """(query position, base position, distance) of the k nearest, ties to the lower base position.

    The estimate only proposes rows: everything that could be among the k nearest within its
    error is measured exactly. ``own`` is each query's own base position, or -1. ``at`` limits
    the base rows, ``radius`` the distance: rows beyond it may be left out.
    """
    guess, slack = block.estimate(q)
    mine = np.flatnonzero(own >= 0)
    guess[mine, own[mine]] = np.inf
    if at is not None:
        guess[:, ~at] = np.inf
    limit = np.full(len(q), np.inf) if radius is None else radius * radius * (1 + 1e-9) + 2.0 * slack
    proposed = guess <= np.minimum(limit, np.finfo(float).max)[:, None]
    many = np.flatnonzero(proposed.sum(axis=1) > 4 * k) if guess.shape[1] > k else np.zeros(0, int)
    if len(many):
        some = guess[many]
        proposed[many] &= some <= (np.partition(some, k - 1, axis=1)[:, k - 1] + 2.0 * slack[many])[:, None]
    rows, hits = np.nonzero(proposed)
    dist = distances(q[rows], block.x[hits])
    order = np.lexsort((hits, dist, rows))
    rows, hits, dist = rows[order], hits[order], dist[order]
    keep = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return rows[keep], hits[keep], dist[keep]


def _search_block(queries: pd.DataFrame, base: pd.DataFrame, block: _Block, k: int, exclude_self: bool, names):
    """Neighbours of the queries in one block; ``base`` is sorted by key and free of surplus copies."""
    keys = base["neighbour"].to_numpy()
    step = max(1, BLOCK_CELLS // len(base))
    asked_rows, base_rows, gaps = [], [], []
    for need, some in queries.groupby("need", sort=True):
        at = None if need < 0 else ~np.isnan(block.x[:, need])
        if at is not None and not at.any():
            continue
        if at is not None and at.all():
            at = None
        asked, x, spots = some["query"].to_numpy(), _matrix(some["x"]), some.index.to_numpy()
        radius = some["radius"].to_numpy() if "radius" in some else None
        own = np.full(len(some), -1)
        if exclude_self:
            near = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
            own = np.where(keys[near] == asked, near, -1)
        for i in range(0, len(some), step):
            found, hits, dist = _nearest(block, at, x[i : i + step], own[i : i + step], k, None if radius is None else radius[i : i + step])
            asked_rows.append(spots[i + found])
            base_rows.append(hits)
            gaps.append(dist)
    if not asked_rows:
        return None
    asked_at, hits = np.concatenate(asked_rows), np.concatenate(base_rows)
    out = base.iloc[hits].reset_index(drop=True)
    matched = queries.loc[asked_at, ["query", "need"]]
    out["query"], out["need"] = matched["query"].to_numpy(), matched["need"].to_numpy()
    out["distance"] = np.concatenate(gaps)
    column = out["need"].to_numpy()
    out["value"] = np.where(column >= 0, block.x[hits, np.maximum(column, 0)], np.nan)
    return out[names]


def _slim(base: pd.DataFrame, k: int) -> pd.DataFrame:
    """Sorted by key, at most ``k + 1`` rows per equal point."""
    base = base.sort_values("neighbour", kind="stable").reset_index(drop=True)
    point = pd.Series([r.tobytes() for r in _matrix(base["x"])], dtype=object)
    copies = pd.DataFrame({"g": base["g"], "p": point}).groupby(["g", "p"]).cumcount()
    return base[(copies <= k).to_numpy()].reset_index(drop=True)


# ---- small base ---------------------------------------------------------------------------------


def _against_broadcast(
    left: DataFrame, right: DataFrame, k: int, exclude_self: bool, out: T.StructType, same: bool
) -> DataFrame:
    spark = left.sparkSession
    rows = right.toPandas()
    n_queries = len(rows) if same else left.count()
    rows = _slim(rows, k)
    blocks = {g: some.reset_index(drop=True) for g, some in rows.groupby("g")}
    shared = spark.sparkContext.broadcast({g: (b.drop(columns="x"), _Block(_matrix(b["x"]))) for g, b in blocks.items()})
    names = out.fieldNames()

    def search(batches):
        for batch in batches:
            for g, some in batch.groupby("g"):
                if g in shared.value:
                    base, block = shared.value[g]
                    found = _search_block(some, base, block, k, exclude_self, names)
                    if found is not None:
                        yield found

    # Searching costs far more than moving a row: tasks are sized by the pairs they look at.
    tasks = min(-(-n_queries * len(rows) // PAIRS_PER_TASK), max(parallelism(spark), n_queries // 50_000))
    return left.repartition(max(tasks, 1), "query").mapInPandas(search, out)


# ---- big base -----------------------------------------------------------------------------------


@dataclass
class _Level:
    """Boxes side by side: group, rows, the smallest and largest value of every column (a row each), and
    the first of the boxes below that each holds and their number."""

    groups: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    first: np.ndarray
    held: np.ndarray

    def bounds(self, x: np.ndarray, q: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Smallest and largest possible distance of pairs of a query and a box."""
        near, far = np.zeros(len(at)), np.zeros(len(at))
        shared = np.zeros(len(at), dtype="i4")
        n = x.shape[1]
        for j in range(n):
            lo, hi, v = self.low[j][at], self.high[j][at], x[q, j]
            known = ~np.isnan(lo) & ~np.isnan(v)
            shared += known
            gap = np.maximum(np.maximum(lo - v, v - hi), 0.0)
            near += np.where(known, gap * gap, 0.0)
            reach = np.maximum(np.abs(v - lo), np.abs(v - hi))
            far += np.where(known, reach * reach, 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(shared > 0, n / shared, np.nan)
            near, far = np.sqrt(near * scale), np.sqrt(far * scale)
        near[shared == 0] = np.inf
        far[shared == 0] = np.inf
        return near, far

    def below(self, q: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs with the boxes that the boxes of the given pairs hold."""
        n = self.held[at]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(q, n), np.repeat(self.first[at], n) + inside


def _sure(q: np.ndarray, far: np.ndarray, rows: np.ndarray, enough: int, n: int) -> np.ndarray:
    """The distance within which each of ``n`` queries surely has ``enough`` rows: those of the first
    boxes in the order of their far corners."""
    order = np.lexsort((far, q))
    q, rows = q[order], rows[order]
    total = np.cumsum(rows)
    start = np.searchsorted(q, q)
    hit = np.flatnonzero(total - total[start] + rows[start] >= enough)
    at, first = np.unique(q[hit], return_index=True)
    out = np.full(n, np.inf)
    out[at] = far[order][hit[first]]
    return out


@dataclass
class _Boxes:
    """The numbers of the leaves, and levels of boxes: the leaves first, one box a tree last."""

    ids: np.ndarray
    levels: list[_Level]

    @staticmethod
    def over(ids: np.ndarray, groups: np.ndarray, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> _Boxes:
        """Leaves in the order of their numbers; those of a tree follow each other."""
        gaps = np.isnan(low)
        tree = np.cumsum(np.append(False, (groups[1:] != groups[:-1]) | (gaps[1:] != gaps[:-1]).any(axis=1))) if len(ids) else np.zeros(0, int)
        levels = [_Level(groups, rows, low.T.copy(), high.T.copy(), np.zeros(0, int), np.zeros(0, int))]
        while len(tree) > len(np.unique(tree)):
            place = np.arange(len(tree)) - np.searchsorted(tree, tree)
            first = np.flatnonzero(place % FANOUT == 0)
            last = levels[-1]
            held = np.diff(np.append(first, len(tree)))
            low, high = np.minimum.reduceat(last.low, first, axis=1), np.maximum.reduceat(last.high, first, axis=1)
            levels.append(_Level(last.groups[first], np.add.reduceat(last.rows, first), low, high, first, held))
            tree = tree[first]
        return _Boxes(ids, levels)

    def _tops(self, group: str, need: int) -> np.ndarray:
        top = self.levels[-1]
        ok = top.groups == group
        if need >= 0:
            ok &= ~np.isnan(top.low[need])
        return np.flatnonzero(ok)

    def home(self, x: np.ndarray, group: str, need: int, enough: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Queries with the number of a leaf near them, of ``enough`` rows if possible. Those without a
        comparable leaf are left out."""
        tops = self._tops(group, need)
        step = max(1, BLOCK_CELLS // max(len(tops), FANOUT))
        for i in range(0, len(x) if len(tops) else 0, step):
            n = len(x[i : i + step])
            q, at = np.repeat(np.arange(i, i + n), len(tops)), np.tile(tops, n)
            for level in reversed(self.levels):
                near, far = level.bounds(x, q, at)
                order = np.lexsort((far, near, level.rows[at] < enough, np.isinf(near), q))
                best = order[np.flatnonzero(np.diff(q[order], prepend=-1))]
                best = best[np.isfinite(near[best])]
                q, at = q[best], at[best]
                if len(level.held):
                    q, at = level.below(q, at)
            yield q, self.ids[at]

    def visits(self, x: np.ndarray, group: str, need: int, radius: np.ndarray, enough: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Queries with the number of every leaf that may hold a neighbour."""
        tops = self._tops(group, need)
        step = max(1, BLOCK_CELLS // max(len(tops), 1))
        open_ = np.isinf(radius).any()
        for i in range(0, len(x) if len(tops) else 0, step):
            n = len(x[i : i + step])
            todo = [(len(self.levels) - 1, np.repeat(np.arange(i, i + n), len(tops)), np.tile(tops, n))]
            while todo:
                depth, q, at = todo.pop()
                level = self.levels[depth]
                near, far = level.bounds(x, q, at)
                go = np.isfinite(near) & (near <= radius[q] * (1 + 1e-9))
                q, at, near, far = q[go], at[go], near[go], far[go]
                if depth == 0 or open_:
                    # Boxes left out are farther than the radius, so they change no bound below it.
                    go = near <= _sure(q, far, level.rows[at], enough, len(x))[q] * (1 + 1e-9)
                    q, at = q[go], at[go]
                if not len(q):
                    continue
                if depth == 0:
                    yield q, self.ids[at]
                    continue
                # A query's boxes stay together, since what is surely near follows from all of them.
                room = np.cumsum(level.held[at]) // BLOCK_CELLS
                cuts = np.unique(np.searchsorted(q, q[np.flatnonzero(np.diff(room)) + 1]))
                for a, b in zip([0, *cuts], [*cuts, len(q)]):
                    if a < b:
                        todo.append((depth - 1, *level.below(q[a:b], at[a:b])))


def _against_leaves(left, right, total, width, k, exclude_self, out, leaf_rows) -> DataFrame:
    spark = left.sparkSession
    # The rank filter runs before the shuffle too, so a hot point sends k + 1 rows per task.
    copies = Window.partitionBy("g", "x").orderBy("neighbour")
    slim = right.withColumn("__copy", F.row_number().over(copies)).where(F.col("__copy") <= k + 1).drop("__copy")
    # The missing-cell pattern is constant in a leaf, hence the set of shared columns as well.
    slim = settle(slim.withColumn("p", F.concat_ws("", F.transform("x", lambda v: F.when(v.isNull(), "0").otherwise("1")))))
    trees = _grow_trees(slim, total, width, leaf_rows)
    shared_trees = spark.sparkContext.broadcast(trees)

    def place(batches):
        for batch in batches:
            batch["leaf"] = -1
            for (g, p), some in batch.groupby(["g", "p"]):
                root = shared_trees.value[(g, p)]
                batch.loc[some.index, "leaf"] = _descend(root, _matrix(some["x"]))
            yield batch.drop(columns="p")

    fields = [f for f in slim.schema.fields if f.name != "p"]
    placed = settle(slim.mapInPandas(place, T.StructType([*fields, T.StructField("leaf", T.LongType())])))
    boxes = spark.sparkContext.broadcast(_boxes(placed, width))
    # Leaves are numbered along their trees, so those of consecutive numbers lie side by side.
    beside = max(1, TOGETHER_ROWS // max(leaf_rows, -(-total // MAX_LEAVES)))
    visit_schema = T.StructType(
        [*left.schema.fields, T.StructField("radius", T.DoubleType()), T.StructField("stand", T.LongType()), T.StructField("leaves", T.ArrayType(T.LongType()))]
    )
    enough = k + int(exclude_self)

    def home(batches):
        """A leaf near the query."""
        for batch in batches:
            for (g, need), some in batch.groupby(["g", "need"]):
                for rows, leaf in boxes.value.home(_matrix(some["x"]), g, need, enough):
                    block = some.iloc[rows].copy()
                    block["radius"] = np.inf
                    block["stand"], block["leaves"] = leaf // beside, [[v] for v in leaf.tolist()]
                    yield block

    stands = placed.withColumn("stand", F.floor(F.col("leaf") / beside))
    homed = settle(left.repartition(parallelism(spark), "query").mapInPandas(home, visit_schema))
    first = settle(_visit(homed, stands, k, exclude_self, out))
    reached = first.groupBy("query", "need").agg(
        F.when(F.count(F.lit(1)) >= k, F.max("distance")).otherwise(F.lit(float("inf"))).alias("radius")
    )
    known = homed.select(*left.columns, F.col("leaves")[0].alias("home")).join(reached, ["query", "need"], "left")
    known = known.withColumn("radius", F.coalesce("radius", F.lit(float("inf"))))

    def others(batches):
        """Every other leaf that may hold a neighbour."""
        for batch in batches:
            for (g, need), some in batch.groupby(["g", "need"]):
                home, radius = some["home"].to_numpy(), some["radius"].to_numpy()
                for rows, leaf in boxes.value.visits(_matrix(some["x"]), g, need, radius, enough):
                    other = leaf != home[rows]
                    rows, leaf = rows[other], leaf[other]
                    if not len(rows):
                        continue
                    order = np.lexsort((leaf, rows))
                    rows, leaf = rows[order], leaf[order]
                    new = np.flatnonzero((np.diff(rows) != 0) | (np.diff(leaf // beside) != 0)) + 1
                    heads = np.concatenate([[0], new])
                    visits = some.iloc[rows[heads]][["query", "need", "g", "x", "radius"]].reset_index(drop=True)
                    visits["stand"], visits["leaves"] = leaf[heads] // beside, [v.tolist() for v in np.split(leaf, new)]
                    yield visits

    visits = settle(known.mapInPandas(others, visit_schema))
    return first.unionByName(_visit(visits, stands, k, exclude_self, out))


def _visit(visits: DataFrame, stands: DataFrame, k: int, exclude_self: bool, out: T.StructType) -> DataFrame:
    """The ``k`` nearest rows of the leaves that each visit names. Leaves with many visits are copied
    to several tasks."""
    parts = visits.groupBy("stand").agg(F.ceil(F.count(F.lit(1)) / QUERY_CHUNK).cast("long").alias("parts"))
    asked = visits.join(parts, "stand").withColumn("part", F.pmod(F.xxhash64("query", "need"), F.col("parts")))
    copies = stands.join(parts, "stand").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    names = out.fieldNames()

    def nearest(found: list[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(found, ignore_index=True).sort_values(["query", "need", "distance", "neighbour"], kind="stable", na_position="first")
        return rows[rows.groupby(["query", "need"], dropna=False).cumcount() < k]

    def search(queries: pd.DataFrame, base: pd.DataFrame) -> pd.DataFrame:
        found, held = [], 0
        if len(queries) and len(base):
            base = base.sort_values(["leaf", "neighbour"], kind="stable")
            leaf = np.concatenate([np.asarray(v) for v in queries["leaves"]])
            rows = np.repeat(np.arange(len(queries)), queries["leaves"].map(len))
            order = np.argsort(leaf, kind="stable")
            leaf, rows = leaf[order], rows[order]
            for number, of_leaf in base.groupby("leaf"):
                some = queries.iloc[rows[np.searchsorted(leaf, number) : np.searchsorted(leaf, number, "right")]]
                if not len(some):
                    continue
                of_leaf = of_leaf.reset_index(drop=True)
                near = _search_block(some.reset_index(drop=True), of_leaf, _Block(_matrix(of_leaf["x"])), k, exclude_self, names)
                if near is not None:
                    found.append(near)
                    held += len(near)
                if held > FOUND_ROWS:
                    found = [nearest(found)]
                    # What is left may be many rows by itself.
                    held = 0
        return nearest(found) if found else pd.DataFrame({n: [] for n in names})

    keys = ["stand", "part"]
    return asked.drop("parts").groupBy(*keys).cogroup(copies.drop("parts").groupBy(*keys)).applyInPandas(search, out)


def _grow_trees(slim: DataFrame, total: int, width: int, leaf_rows: int) -> dict:
    """Median splits per (group, pattern) from a sample of bounded size.

    A tree is a leaf number, or (column, cut, left, right).
    """
    sizes = {(r["g"], r["p"]): r["count"] for r in slim.groupBy("g", "p").count().collect()}
    rows = sum(sizes.values())
    leaf_rows = max(leaf_rows, -(-rows // MAX_LEAVES))
    share = min(1.0, SAMPLE_PER_LEAF / leaf_rows, SAMPLE_CELLS / width / max(rows, 1))
    scale = 1 << 30
    sampled = slim.where(F.pmod(F.xxhash64("neighbour"), F.lit(scale)) < int(share * scale))
    sample = sampled.select("g", "p", "x").toPandas()
    points = {gp: _matrix(some["x"]) for gp, some in sample.groupby(["g", "p"])}
    counter = iter(range(1 << 40))

    def grow(x: np.ndarray, leaves: int):
        if leaves <= 1 or len(x) < 4:
            return next(counter)
        spread = np.where(np.isnan(x[0]), -1.0, x.max(axis=0) - x.min(axis=0))
        j = int(spread.argmax())
        if not spread[j] > 0:
            return next(counter)
        cut = float(np.median(x[:, j]))
        goes_left = x[:, j] < cut
        if not goes_left.any():
            cut = float(x[x[:, j] > cut, j].min())
            goes_left = x[:, j] < cut
        return (j, cut, grow(x[goes_left], -(-leaves // 2)), grow(x[~goes_left], -(-leaves // 2)))

    return {gp: grow(points.get(gp, np.empty((0, width))), -(-n // leaf_rows)) for gp, n in sizes.items()}


def _descend(root, x: np.ndarray) -> np.ndarray:
    leaf = np.empty(len(x), dtype="i8")
    stack = [(root, np.arange(len(x)))]
    while stack:
        node, rows = stack.pop()
        if not isinstance(node, tuple):
            leaf[rows] = node
        elif len(rows):
            j, cut, left, right = node
            goes_left = x[rows, j] < cut
            stack.append((left, rows[goes_left]))
            stack.append((right, rows[~goes_left]))
    return leaf


def _boxes(placed: DataFrame, width: int) -> _Boxes:
    at = [F.element_at("x", j + 1) for j in range(width)]
    rows = placed.groupBy("leaf").agg(
        F.first("g").alias("g"),
        F.count(F.lit(1)).alias("n"),
        F.array(*(F.min(c) for c in at)).alias("low"),
        F.array(*(F.max(c) for c in at)).alias("high"),
    ).toPandas().sort_values("leaf")
    return _Boxes.over(
        rows["leaf"].to_numpy(), rows["g"].to_numpy(), rows["n"].to_numpy(), _matrix(rows["low"]), _matrix(rows["high"])
    )
