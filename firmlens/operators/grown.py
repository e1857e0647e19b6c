"""Models made of the trees of ``growing``: forests, extremely randomised trees, second-order boosting
(also of several classes together), boosting by class probabilities, and searches over their settings.

All read ``features`` (a vector; NaN is a gap, which every split has a side for) and ``label``; the
``key`` column tells rows apart in draws, so a draw is the same at every run.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from firmlens.operators import growing
from firmlens.operators.growing import GAP, KINDS, PAIRS_AT_ONCE, Binned, Block, Rules, Tails, Trees, binned, blocks, grow, most_nodes, plant, read_piece, together
from firmlens.operators.splitting import stratified_folds
from firmlens.session import hold, parallelism, release, scratch_path, settle, temporary

#: Rounds whose trees are walked anew in every pass before margins are written.
SETTLE_ROUNDS = 4
#: Votes are added as whole numbers of this share, so any order of adding gives the same sum.
VOTE = 2.0**-40
#: (row, tree) pairs that one task scores, and rows whose votes meet in one.
PAIRS_SCORED = 200_000
ROWS_MEET_BITS = 13


def _columns_at_node(strategy: str | int | float | None, task: str, n_columns: int) -> int | None:
    """Columns that a node draws: all, sqrt, log2, onethird, a share or a number. "auto" is the root
    for classes and all for regression; "spark" is what Spark's forests draw, the root rounded up or a third."""
    if strategy == "spark":
        return math.ceil(math.sqrt(n_columns) if task == "class" else n_columns / 3)
    if strategy == "auto":
        strategy = "sqrt" if task == "class" else "all"
    if strategy in (None, "all"):
        return None
    if strategy == "sqrt":
        return max(1, math.isqrt(n_columns))
    if strategy == "log2":
        return max(1, int(math.log2(n_columns)))
    if strategy == "onethird":
        return math.ceil(n_columns / 3)
    return math.ceil(strategy * n_columns) if isinstance(strategy, float) else int(strategy)


def _rows(wanted: float, n_rows: int, least: int) -> float:
    """A share of the rows, or a number of them."""
    return max(least, math.ceil(wanted * n_rows) if 0 < wanted < 1 else wanted)


# ---- scoring -------------------------------------------------------------------------------------


class GrownModel(Model):
    """``base`` plus what the trees say: each tree adds its leaf's values from column ``output`` on.

    ``link``: value, classes (the class of the largest sum) or exp. All trees are scored in one pass.
    """

    def __init__(self, trees: Sequence[Trees], outputs: Sequence[np.ndarray], base: np.ndarray, classes: Sequence[float], link: str, n_columns: int):
        super().__init__()
        self.trees, self.outputs, self.base, self.classes, self.link, self.n_columns = list(trees), list(outputs), np.asarray(base, float), list(classes), link, n_columns

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.tile(self.base, (len(x), 1))
        for trees, outputs in zip(self.trees, self.outputs, strict=True):
            _add(out, trees, outputs, x)
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        scores = self.scores(x)
        return np.asarray(self.classes, float)[scores.argmax(axis=1)] if self.link == "classes" else scores[:, 0]

    def importances(self) -> np.ndarray:
        parts = [(t.importance(self.n_columns), t.n_trees) for t in self.trees if t.n_trees]
        total = sum(v * n for v, n in parts)
        return total / total.sum() if total.sum() > 0 else total

    def _column(self, what: Callable[[np.ndarray], np.ndarray], kind: str) -> Column:
        n_columns = self.n_columns

        @F.pandas_udf(kind)
        def run(x: pd.Series) -> pd.Series:
            data = np.array(x.tolist(), "f8").reshape(len(x), n_columns)
            return pd.Series(list(what(data)) if len(x) else [], dtype=object if kind != "double" else float)

        return run(vector_to_array("features"))

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", self._column(self.predict, "double"))

    def with_scores(self, df: DataFrame, name: str = "scores") -> DataFrame:
        """The sums behind the predictions, an array a row."""
        return df.withColumn(name, self._column(self.scores, "array<double>"))


def _add(out: np.ndarray, trees: Trees, outputs: np.ndarray, x: np.ndarray) -> None:
    """Add the values that rows reach, trees of one width at a time."""
    width = trees.value.shape[1]
    step = max(1, PAIRS_AT_ONCE // max(1, trees.n_trees))
    for at in range(0, len(x), step):
        value = trees.value[trees.walk(x[at : at + step])]
        if width > 1:
            out[at : at + step] += value.sum(axis=1)
        else:
            for o in np.unique(outputs):
                out[at : at + step, o] += value[:, outputs == o, 0].sum(axis=1)


def _one_vote(value: np.ndarray) -> np.ndarray:
    """One for the commonest class (the lowest of them) instead of the classes' shares."""
    return (np.arange(value.shape[-1]) == value.argmax(axis=-1)[..., None]).astype(float)


# ---- forests that stay where they were grown -----------------------------------------------------


class FarForest(Model):
    """A forest whose trees end in a table of pieces. ``upper`` are the nodes above the pieces: rows walk
    down these and go on to the task that has the piece below. Votes are added as whole numbers, a
    row's from all tasks, so any order gives the same sum."""

    def __init__(self, upper: Trees, tails: Tails, edges: Sequence[np.ndarray], random_cuts: bool, classes: Sequence[float], scale: tuple[float, float], n_rows: int, hard: bool = False):
        super().__init__()
        self.upper, self.tails, self.edges, self.random_cuts, self.classes, self.scale, self.n_rows = upper, tails, list(edges), random_cuts, list(classes), scale, n_rows
        self.hard = hard and len(self.classes) > 0

    def _transform(self, df: DataFrame) -> DataFrame:
        spark, n_trees, classes = df.sparkSession, self.upper.n_trees, np.array(self.classes, float)
        middle, half = self.scale
        hard = self.hard
        width, n_columns, random_cuts, edges = self.upper.value.shape[1], len(self.edges), self.random_cuts, self.edges
        kind = "<f8" if random_cuts else "u1"
        rows = settle(df.withColumn("__row", F.monotonically_increasing_id()))
        slot = np.full(len(self.upper.feature), -1, np.int32)
        slot[self.tails.places] = np.arange(len(self.tails.places))
        # With walks ended at pieces, a slot is where a row leaves the upper nodes.
        shared = spark.sparkContext.broadcast((self.upper, slot, self.tails.part))
        # Values that stand for the bins: a cut is an edge, or beyond all of them.
        values = np.full((n_columns, GAP + 1), np.nan)
        for c, e in enumerate(edges):
            values[c, : len(e) + 1] = np.append(e, np.inf)

        def votes(value: np.ndarray) -> np.ndarray:
            value = _one_vote(value) if hard else value
            return np.rint((value - middle) / (half * VOTE)).astype(np.int64)

        def coded(x: np.ndarray) -> np.ndarray:
            if random_cuts:
                return x
            codes = np.empty(x.shape, np.uint8)
            for c, e in enumerate(edges):
                codes[:, c] = np.where(np.isnan(x[:, c]), GAP, np.searchsorted(e, x[:, c], side="left"))
            return codes

        def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            step = max(1, PAIRS_AT_ONCE // n_trees)
            for batch in batches:
                for at in range(0, batch.num_rows, step):
                    some = batch.slice(at, step)
                    x = np.array(some.column("x").to_pylist(), "f8").reshape(some.num_rows, -1)
                    yield some.column("__row").to_numpy(), x, shared.value[0].walk(x)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            _, slot, part = shared.value
            total = np.zeros(int(part.max()) + 1, np.int64)
            for _, _, node in walked(batches):
                at = slot[node].ravel()
                total += np.bincount(part[at[at >= 0]], minlength=len(total))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["part", "n"])

        asked = rows.select("__row", vector_to_array("features").alias("x"))
        counts = asked.mapInArrow(count, "part long, n long").groupBy("part").agg(F.sum("n").alias("n")).collect()
        # Parts that very many rows reach are copied to several tasks.
        copies = np.ones(int(self.tails.part.max()) + 1, np.int64)
        for r in counts:
            copies[r["part"]] = max(1, -(-r["n"] // PAIRS_SCORED))
        tasks = max(parallelism(spark), int(copies.sum()) // 4)
        sent = "part int, copy int, rows binary, slots binary, x binary"

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            upper, slot, part = shared.value
            for ids, x, node in walked(batches):
                x = coded(x)
                here, tree = np.nonzero(slot[node] >= 0)
                at = slot[node[here, tree]]
                copy = growing.mix(ids.astype(np.uint64))[here] % copies[part[at]].astype(np.uint64)
                order = np.lexsort((copy, part[at]))
                here, at, copy = here[order], at[order], copy[order].astype(np.int64)
                key = part[at].astype(np.int64) * (int(copies.max()) + 1) + copy
                first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, int)
                ranges = [slice(a, b) for a, b in zip(first, [*first[1:], len(key)])]
                columns = [
                    pa.array(part[at[first]].astype(np.int32)), pa.array(copy[first].astype(np.int32)),
                    *(pa.array([v[r].tobytes() for r in ranges], pa.binary()) for v in (ids[here].astype("<i8"), at.astype("<i4"))),
                    pa.array([x[here[r]].astype(kind).tobytes() for r in ranges], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["part", "copy", "rows", "slots", "x"])

        met = "block long, rows binary, votes binary"

        def dealt(ids: np.ndarray, found: np.ndarray) -> tuple[pa.Array, ...]:
            """Votes by blocks of rows, those of a row added up."""
            order = np.argsort(ids, kind="stable")
            ids, found = ids[order], found[order]
            first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])) if len(ids) else np.zeros(0, int)
            ids, found = ids[first], np.add.reduceat(found, first, axis=0) if len(first) else found
            block = ids >> ROWS_MEET_BITS
            at = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(ids) else np.zeros(0, int)
            ranges = [slice(a, b) for a, b in zip(at, [*at[1:], len(ids)])]
            return pa.array(block[at]), pa.array([ids[r].tobytes() for r in ranges], pa.binary()), pa.array([found[r].tobytes() for r in ranges], pa.binary())

        def ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Votes of the upper nodes that nothing lies below."""
            upper, slot, _ = shared.value
            for ids, _, node in walked(batches):
                done = np.where((slot[node] < 0)[:, :, None], votes(upper.value[node]), 0).sum(axis=1)
                yield pa.RecordBatch.from_arrays([*dealt(ids, done)], ["block", "rows", "votes"])

        def score(asked: pa.Table, pieces: pa.Table) -> pa.Table:
            ids, found = np.zeros(0, np.int64), np.zeros((0, width), np.int64)
            if asked.num_rows:
                ids = np.frombuffer(b"".join(asked.column("rows").to_pylist()), "<i8")
                at = np.frombuffer(b"".join(asked.column("slots").to_pylist()), "<i4")
                x = np.frombuffer(b"".join(asked.column("x").to_pylist()), kind).reshape(-1, n_columns)
                x = x if random_cuts else values[np.arange(n_columns)[None, :], x]
                found = np.zeros((len(ids), width), np.int64)
                for piece in pieces.to_pylist():
                    roots, trees = read_piece(piece, width)
                    place = np.searchsorted(roots, at)
                    mine = np.flatnonzero((place < len(roots)) & (roots[np.minimum(place, len(roots) - 1)] == at))
                    found[mine] = votes(trees.value[trees.walk_from(x[mine], place[mine])])
            return pa.table(dict(zip(("block", "rows", "votes"), dealt(ids, found), strict=True)))

        def add(group: pa.Table) -> pa.Table:
            ids = np.frombuffer(b"".join(group.column("rows").to_pylist()), "<i8")
            found = np.frombuffer(b"".join(group.column("votes").to_pylist()), "<i8").reshape(-1, width)
            ids, at = np.unique(ids, return_inverse=True)
            total = np.zeros((len(ids), width), np.int64)
            np.add.at(total, at, found)
            return pa.table({"__row": ids, "prediction": classes[total.argmax(axis=1)] if len(classes) else total[:, 0] * VOTE / n_trees * half + middle})

        copied = spark.createDataFrame([(p, int(c)) for p, c in enumerate(copies)], "part int, copies int")
        pieces = self.tails.pieces.join(F.broadcast(copied), "part").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
        pieces = pieces.drop("copies", "gains").repartition(tasks, "part", "copy")
        keys = ("part", "copy")
        below = asked.mapInArrow(send, sent).repartition(tasks, *keys).groupBy(*keys).cogroup(pieces.groupBy(*keys)).applyInArrow(score, met)
        sums = below.unionByName(asked.mapInArrow(ended, met)).groupBy("block").applyInArrow(add, "__row long, prediction double")
        return rows.join(settle(sums), "__row", "left").drop("__row")

    def importances(self) -> np.ndarray:
        """Each column's share of the gain, averaged over trees: tasks report sums by piece."""
        upper, n_columns = self.upper, len(self.edges)
        gains = np.zeros((upper.n_trees, n_columns))
        inner = upper.feature >= 0
        np.add.at(gains, (upper.owner[inner], upper.feature[inner]), upper.gain[inner])
        for r in self.tails.pieces.select("roots", "gains").collect():
            roots = np.frombuffer(r["roots"], "<i4")
            np.add.at(gains, upper.owner[self.tails.places[roots]], np.frombuffer(r["gains"], "f8").reshape(-1, n_columns))
        totals = gains.sum(axis=1, keepdims=True)
        mean = np.divide(gains, totals, out=np.zeros_like(gains), where=totals > 0).mean(axis=0)
        return mean / mean.sum() if mean.sum() > 0 else mean


# ---- forests -------------------------------------------------------------------------------------


class Forest(Estimator):
    """Trees on bootstraps (or all rows), averaged. ``random_cuts`` makes them extremely randomised:
    each node has one random cut a drawn column, and takes the best of these. ``min_leaf`` and
    ``min_split`` are numbers of rows or shares of them, two separate conditions. ``hard``: a tree has
    one vote for its class instead of a share for each."""

    def __init__(
        self, task: str, n: int = 100, max_depth: int | None = None, min_leaf: float = 1, min_split: float = 2, bootstrap: bool = True,
        columns: str | int | float | None = "auto", criterion: str | None = None, random_cuts: bool = False, seed: int = 42, key: str = "company_id",
        hard: bool = False,
    ):
        super().__init__()
        self.task, self.n, self.columns, self.key, self.hard = task, n, columns, key, hard
        self.rules = Rules(
            criterion or ("gini" if task == "class" else "squared"), max_depth, min_split, min_leaf, random_cuts=random_cuts,
            draw="bootstrap" if bootstrap else "all", seed=seed,
        )

    def common(self, n_columns: int, n_rows: int) -> Rules:
        """What the trees have in common; shares of columns and rows become numbers."""
        r = self.rules
        columns = _columns_at_node(self.columns, self.task, n_columns)
        return replace(r, columns=columns, min_leaf=_rows(r.min_leaf, n_rows, 1), min_split=_rows(r.min_split, n_rows, 2))

    def each(self, n_columns: int, n_rows: int, fold: int = -1) -> list[Rules]:
        """The rules of every tree: the first ones of a larger forest are those of a smaller one."""
        common = self.common(n_columns, n_rows)
        return [replace(common, seed=common.seed * 1_000_003 + t, fold=fold) for t in range(self.n)]

    def _fit(self, df: DataFrame) -> GrownModel:
        path = scratch_path(df.sparkSession, "trees")
        with temporary(df.sparkSession):
            table = binned(df, self.key, self.task)
            rules = self.each(table.n_columns, table.n_rows)
            if sum(most_nodes(r, table.n_rows) for r in rules) > growing.NODE_BUDGET:
                return self._planted(table, rules, path)
            grown = [grow(table, [rules[i] for i in group]) for group in together(rules, table.n_rows)]
            table.release()
        for t in grown:
            t.value = (_one_vote(t.value) if self.hard and table.classes else t.value) / self.n
        base = np.zeros(len(table.classes) or 1)
        return GrownModel(grown, [np.zeros(t.n_trees, int) for t in grown], base, table.classes, "classes" if table.classes else "value", table.n_columns)

    def _planted(self, table: Binned, rules: Sequence[Rules], path: str) -> Model:
        """Trees with more nodes than the driver should hold stay where they were grown."""
        upper, tails = plant(table, rules, path)
        table.release()
        scale = (0.0, 1.0) if table.classes else (table.middle, table.unit * (1 << table.bits))
        return FarForest(upper, tails, table.edges, self.rules.random_cuts, table.classes, scale, table.n_rows, self.hard)


class Tree(Forest):
    """One tree on all rows and columns. ``min_split`` rows are needed to split a node, ``min_leaf``
    on either side. Criteria: squared, absolute (medians in the leaves), poisson; gini, entropy."""

    def __init__(self, task: str, max_depth: int | None = None, min_split: float = 2, min_leaf: float = 1, criterion: str | None = None, seed: int = 42, key: str = "company_id"):
        super().__init__(task, 1, max_depth, min_leaf, min_split, False, None, criterion, seed=seed, key=key)

    def bagged(self, n: int, seed: int, key: str) -> Forest:
        """``n`` such trees on bootstraps, grown together: the mean, or the class of most trees."""
        out = Forest(self.task, n, columns=None, key=key, hard=True)
        out.rules = replace(self.rules, draw="bootstrap", seed=seed)
        return out


# ---- second-order boosting -----------------------------------------------------------------------


@dataclass(frozen=True)
class Fit:
    """One boosted model: ``n`` rounds of trees by ``rules``, each added at ``rate``."""

    n: int
    rate: float
    rules: Rules
    loss: str = "squared"


class _Scale:
    """Labels are boosted in units of half their range, so gradients are small numbers."""

    def __init__(self, table: Binned):
        self.classes = len(table.classes)
        self.middle = 0.0 if self.classes else table.middle
        self.half = 1.0 if self.classes else table.unit * (1 << table.bits)
        # Gradients stay below 8; sums of all rows below 2^62.
        self.unit = 2.0 ** -max(8, min(34, 58 - max(1, table.n_rows).bit_length()))

    def rules(self, r: Rules) -> Rules:
        return replace(r, criterion="second", l1=r.l1 / self.half, least_gain=r.least_gain / self.half**2)


def _start(table: Binned, fit: Fit, scale: _Scale) -> list[float]:
    """Margins before the first round, from the rows that the fit may see: mean or log shares."""
    seen = [v for f, v in table.folds.items() if f != fit.rules.fold or f < 0]
    n = sum(v[0] for v in seen)
    if not scale.classes:
        return [(sum(v[1] for v in seen) / n - scale.middle) / scale.half if n else 0.0]
    counts = np.array([v[2] for v in seen], float).sum(axis=0) if seen else np.ones(scale.classes)
    return np.log(np.maximum(counts, 1e-9) / max(n, 1)).tolist()


class _Margins:
    """The sums of all fits for a block: written ones plus the trees since."""

    def __init__(self, start: np.ndarray):
        self.start, self.pending = start, []

    def of(self, block: Block) -> np.ndarray:
        out = np.tile(self.start, (len(block.y), 1)) if block.state is None else block.state.copy()
        for trees, outputs in self.pending:
            _add(out, trees, outputs, block.x)
        return out

    def write(self, rows: DataFrame) -> DataFrame:
        """Rows with the sums so far as their state."""
        margins, n_trees = self, sum(t.n_trees for t, _ in self.pending)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    state = [r.tobytes() for r in margins.of(Block.of(batch)).astype("<f8")]
                    kept = [batch.column(c) for c in ("id", "x", "bins", "y", "fold")]
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(state, pa.binary())], ["id", "x", "bins", "y", "fold", "state"])

        return hold(rows.mapInArrow(run, "id long, x binary, bins binary, y double, fold int, state binary"))


def _gradients(margins: np.ndarray, y: np.ndarray, outputs: Sequence[tuple[int, int]], fits: Sequence[Fit], scale: _Scale) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of each (fit, class) as whole numbers."""
    g, h = np.empty((len(y), len(outputs))), np.ones((len(y), len(outputs)))
    k_all = max(1, scale.classes)
    shares: dict[int, np.ndarray] = {}
    for j, (i, k) in enumerate(outputs):
        if scale.classes:
            if i not in shares:
                m = margins[:, i * k_all : (i + 1) * k_all]
                e = np.exp(m - m.max(axis=1, keepdims=True))
                shares = {i: e / e.sum(axis=1, keepdims=True)}
            p = shares[i][:, k]
            g[:, j], h[:, j] = p - (y == k), p * (1 - p)
        else:
            miss = margins[:, i] - (y - scale.middle) / scale.half
            g[:, j] = np.sign(miss) if fits[i].loss == "absolute" else miss
    return tuple(np.rint(np.clip(v, -8, 8) / scale.unit).astype(np.int64) for v in (g, h))


def boost(table: Binned, fits: Sequence[Fit], keep: bool = True) -> tuple[DataFrame, _Margins, list[tuple[Trees, np.ndarray]]]:
    """All fits round by round, their trees grown together; a round has one tree a class and fit.

    Returns the rows with written margins, the trees since, and (``keep``) the trees of every round
    with the column of margins that each adds to.
    """
    scale = _Scale(table)
    k_all = max(1, scale.classes)
    small = replace(table, rows=None, unit=scale.unit, middle=0.0)
    margins = _Margins(np.array([m for f in fits for m in _start(table, f, scale)]))
    rows, kept = table.rows, []
    for r in range(max((f.n for f in fits), default=0)):
        outputs = [(i, k) for i, f in enumerate(fits) if f.n > r for k in range(k_all)]
        rules = [replace(scale.rules(fits[i].rules), seed=fits[i].rules.seed * 1_000_003 + r) for i, _ in outputs]

        def gradients(block: Block, outputs=outputs) -> tuple[np.ndarray, np.ndarray]:
            return _gradients(margins.of(block), block.y, outputs, fits, scale)

        trees = grow(small, rules, gradients, rows)
        trees.value *= np.array([fits[i].rate for i, _ in outputs])[trees.owner][:, None]
        places = np.array([i * k_all + k for i, k in outputs])
        margins.pending.append((trees, places))
        if keep:
            kept.append((trees, places))
        if len(margins.pending) >= SETTLE_ROUNDS:
            before, rows = rows, margins.write(rows)
            if before is not table.rows:
                release(before)
            margins.pending = []
    return rows, margins, kept


class Boosting(Estimator):
    """Second-order gradient boosting: squared or absolute loss, or one softmax over all classes.

    A leaf's weight is ``-shrunk(G, l1) / (H + l2)``; a split must gain ``least_gain`` and leave
    ``least_weight`` of second derivatives on either side; ``columns`` are drawn for each tree. A gap
    goes to the side where it lowers the loss more.
    """

    def __init__(
        self, task: str, n: int = 100, rate: float = 0.1, max_depth: int | None = 3, min_leaf: float = 1, min_split: float = 2, subsample: float = 1.0,
        columns: float = 1.0, loss: str = "squared", l1: float = 0.0, l2: float = 1.0, least_gain: float = 0.0, least_weight: float = 0.0, seed: int = 42, key: str = "company_id",
    ):
        super().__init__()
        if loss not in ("squared", "absolute"):
            raise ValueError(f"unknown loss {loss!r}")
        self.task, self.key = task, key
        rules = Rules(
            "second", max_depth, min_split, min_leaf, tree_columns=columns, draw="share" if subsample < 1 else "all", share=subsample,
            l1=l1, l2=l2, least_gain=least_gain, least_weight=least_weight, seed=seed,
        )
        self.spec = Fit(n, rate, rules, loss)

    def _fit(self, df: DataFrame) -> GrownModel:
        with temporary(df.sparkSession):
            table = binned(df, self.key, self.task)
            rows, _, kept = boost(table, [self.spec])
            rows.unpersist()
            table.release()
        return boosted_model(table, self.spec, kept)


def boosted_model(table: Binned, fit: Fit, kept: Sequence[tuple[Trees, np.ndarray]]) -> GrownModel:
    scale = _Scale(table)
    base = np.array(_start(table, fit, scale)) * scale.half + scale.middle
    for trees, _ in kept:
        trees.value, trees.gain = trees.value * scale.half, trees.gain * scale.half**2
    return GrownModel([t for t, _ in kept], [o for _, o in kept], base, table.classes, "classes" if table.classes else "value", table.n_columns)


# ---- boosting by class probabilities -------------------------------------------------------------


class ProbabilityAdaBoost(Estimator):
    """SAMME.R (Zhu et al. 2009): every round grows a tree on weighted rows; its leaves' class shares
    change the weights and are its vote. Weights are products that no round rewrites the table for:
    they follow from the trees since the last write."""

    def __init__(self, n: int = 50, rate: float = 1.0, max_depth: int = 1, seed: int = 42, key: str = "company_id"):
        super().__init__()
        self.n, self.rate, self.max_depth, self.seed, self.key = n, rate, max_depth, seed, key

    def _fit(self, df: DataFrame) -> GrownModel:
        with temporary(df.sparkSession):
            table = binned(df, self.key, "class")
            k = len(table.classes)
            bits = max(8, min(50, 60 - max(1, table.n_rows).bit_length()))
            rows, pending, votes = table.rows, _Margins(np.zeros(1)), []
            highest = 0.0  # of the logarithms of weights: the largest weight counts as one
            for r in range(self.n if k > 1 else 1):
                rules = Rules("gini", self.max_depth, seed=self.seed * 1_000_003 + r)

                def weights(block: Block, highest=highest) -> tuple[np.ndarray, np.ndarray]:
                    w = np.exp(_log_weights(pending, block, highest) - highest)
                    return np.rint(w * (1 << bits)).astype(np.int64)[:, None], None

                trees = grow(table, [rules], weights, rows, weight_unit=2.0**-bits)
                log = np.log(np.maximum(trees.value, np.finfo(float).eps))
                vote = trees.with_values((k - 1) * (log - log.mean(axis=1, keepdims=True)))
                votes.append(vote)
                # By class of the row: what its logarithm of weight changes by in this leaf.
                change = trees.with_values(-self.rate * (k - 1) / k * (log - (log.sum(axis=1, keepdims=True) - log) / max(1, k - 1)))
                pending.pending.append((change, np.zeros(1, int)))
                if len(pending.pending) >= SETTLE_ROUNDS:
                    before, rows = rows, _write_weights(pending, rows)
                    if before is not table.rows:
                        release(before)
                    pending.pending = []
                highest, wrong = _weights_now(pending, rows, trees)
                if wrong == 0:
                    break
            rows.unpersist()
            table.release()
        return GrownModel(votes, [np.zeros(1, int) for _ in votes], np.zeros(k), table.classes, "classes", table.n_columns)


def _log_weights(pending: _Margins, block: Block, _highest: float) -> np.ndarray:
    out = np.zeros(len(block.y)) if block.state is None else block.state[:, 0].copy()
    for trees, _ in pending.pending:
        out += trees.value[trees.walk(block.x)[:, 0], block.y.astype(int)]
    return out


def _write_weights(pending: _Margins, rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                state = [r.tobytes() for r in _log_weights(pending, Block.of(batch), 0.0).astype("<f8")]
                kept = [batch.column(c) for c in ("id", "x", "bins", "y", "fold")]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(state, pa.binary())], ["id", "x", "bins", "y", "fold", "state"])

    return hold(rows.mapInArrow(run, "id long, x binary, bins binary, y double, fold int, state binary"))


def _weights_now(pending: _Margins, rows: DataFrame, trees: Trees) -> tuple[float, int]:
    """The largest logarithm of a weight, and how many rows the last tree gets wrong."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, 1):
            log = _log_weights(pending, block, 0.0)
            wrong = int((trees.value[trees.walk(block.x)[:, 0]].argmax(axis=1) != block.y).sum())
            yield pa.RecordBatch.from_arrays([pa.array([float(log.max())]), pa.array([wrong], pa.int64())], ["top", "wrong"])

    found = rows.mapInArrow(run, "top double, wrong long").agg(F.max("top"), F.sum("wrong")).first()
    return found[0] or 0.0, found[1] or 0


# ---- searches ------------------------------------------------------------------------------------


def _folded(df: DataFrame, task: str, key: str, k: int, seed: int) -> Binned:
    classes = task == "class"
    rows = df if classes else df.withColumn("__all", F.lit(0))
    folded = stratified_folds(rows, "label" if classes else "__all", key, k, seed=seed)
    return binned(folded.select(key, "features", "label", "fold"), key, task, fold=F.col("fold"))


def _exact(values: np.ndarray | Sequence[float]) -> list[float]:
    """A few numbers whose exact sum is that of ``values``."""
    values = np.asarray(values, float)
    if not np.isfinite(values).all():
        return [float(values.sum())]
    rest, out = values.tolist(), []
    while part := math.fsum(rest):
        out.append(part)
        rest.append(-part)
    return out


def _measured(rows: DataFrame, predict: Callable[[Block], Iterator[tuple[int, np.ndarray, np.ndarray]]], task: str, metric: str) -> dict[int, float]:
    """The metric of each number that ``predict`` gives held-out rows and predictions for: summed by
    task, then by number. Sums are exact, so a score doesn't depend on how rows are dealt."""
    names = ["a", "b", "c"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        sums: dict[int, list[list[float]]] = {}
        for block in blocks(batches, 1):
            for i, held, p in predict(block):
                y = block.y[held]
                if task == "class":
                    parts = [(p == y).astype(float)]
                elif metric == "mape":
                    parts = [np.abs(y - p) / np.maximum(np.abs(y), np.finfo(float).eps)]
                else:
                    parts = [(y - p) ** 2, y, y**2]
                counts[i] = counts.get(i, 0) + len(y)
                for total, part in zip(sums.setdefault(i, [[], [], []]), parts):
                    total[:] = _exact([*total, *_exact(part)])
        columns = [pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())]
        columns += [pa.array([s[j] for s in sums.values()], pa.list_(pa.float64())) for j in range(3)]
        yield pa.RecordBatch.from_arrays(columns, ["i", "n", *names])

    parts = rows.mapInArrow(run, "i long, n long, a array<double>, b array<double>, c array<double>")
    found = parts.groupBy("i").agg(F.sum("n").alias("n"), *(F.flatten(F.collect_list(c)).alias(c) for c in names)).collect()

    def value(r) -> float:
        a, b, c = (math.fsum(r[name]) for name in names)
        if task == "class" or metric == "mape":
            return a / r["n"] if r["n"] else float("nan")
        if metric == "rmse":
            return math.sqrt(a / r["n"])
        spread = c - b**2 / r["n"]
        return 1 - a / spread if spread > 0 else float("nan")

    return {r["i"]: value(r) for r in found}


def _board(spark, candidates: Sequence[dict], scores: dict[int, float], k: int, larger: bool) -> tuple[DataFrame, int]:
    """Mean score of each candidate over its folds, best first, and the winner's number."""
    means = [float(np.mean([scores.get(i * k + f, float("nan")) for f in range(k)])) for i in range(len(candidates))]
    rows = [(json.dumps(c, sort_keys=True), m) for c, m in zip(candidates, means, strict=True)]
    order = sorted(range(len(rows)), key=lambda i: ((-means[i] if larger else means[i]) if means[i] == means[i] else math.inf, rows[i][0]))
    board = spark.createDataFrame([rows[i] for i in order], "params string, score double")
    return board, order[0]


def search_boosting(
    df: DataFrame, build: Callable[..., Boosting], candidates: Sequence[dict], task: str, key: str = "company_id", k: int = 5, seed: int = 42, metric: str | None = None, refit: bool = True
):
    """Mean k-fold score per candidate, best first, and (``refit``) the winner fitted on all rows. The fits of all
    candidates and folds go through their rounds together."""
    metric = metric or ("r2" if task == "regression" else "accuracy")
    specs = [build(**c).spec for c in candidates]
    with temporary(df.sparkSession):
        table = _folded(df, task, key, k, seed)
        fits = [replace(s, rules=replace(s.rules, fold=f)) for s in specs for f in range(k)]
        scale, k_all = _Scale(table), max(1, len(table.classes))
        rows, margins, _ = boost(table, fits, keep=False)

        folds = [f.rules.fold for f in fits]

        def predict(block: Block) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            m = margins.of(block)
            for i, fold in enumerate(folds):
                held = np.flatnonzero(block.fold == fold)
                if len(held):
                    own = m[held, i * k_all : (i + 1) * k_all]
                    yield i, held, own.argmax(axis=1).astype(float) if scale.classes else own[:, 0] * scale.half + scale.middle

        scores = _measured(rows, predict, task, metric)
        rows.unpersist()
        table.release()
    board, best = _board(df.sparkSession, candidates, scores, k, metric not in ("rmse", "mape"))
    return board, build(**candidates[best]).fit(df) if refit else None


def search_forest(
    df: DataFrame, build: Callable[..., Forest], candidates: Sequence[dict], task: str, key: str = "company_id", k: int = 5, seed: int = 42, metric: str | None = None, refit: bool = True
):
    """Mean k-fold score per candidate, best first, and (``refit``) the winner fitted on all rows.

    Candidates that differ in the number of trees and their depth only share one forest a fold: a
    smaller forest is its first trees, a shallower tree its upper nodes. Votes are added up as whole
    numbers over groups of trees that fit the node budget, so scores equal those of separate fits.
    """
    metric = metric or ("r2" if task == "regression" else "accuracy")
    built = [build(**c) for c in candidates]
    with temporary(df.sparkSession):
        table = _folded(df, task, key, k, seed)
        width = max(1, len(table.classes))
        alike: dict[tuple, list[int]] = {}
        for i, b in enumerate(built):
            alike.setdefault((b.columns, replace(b.rules, max_depth=None)), []).append(i)
        rows, n_columns = table.rows, table.n_columns
        plans = []  # (number of the group, tree, rules)
        for g, members in enumerate(alike.values()):
            depths = [built[i].rules.max_depth for i in members]
            deepest = None if None in depths else max(depths)
            for f in range(k):
                seen = table.n_rows - table.folds.get(f, (0,))[0]
                largest = max((built[i] for i in members), key=lambda b: b.n).each(n_columns, seen, f)
                plans += [(g, t, replace(r, max_depth=deepest)) for t, r in enumerate(largest)]
        groups = list(alike.values())
        middle, half = (0.0, 1.0) if table.classes else (table.middle, table.unit * (1 << table.bits))
        # Trees of one kind are grown together.
        kinds: dict[tuple, list] = {}
        for plan in plans:
            kinds.setdefault((plan[2].random_cuts, KINDS[plan[2].criterion]), []).append(plan)
        pending: list[tuple[Trees, list]] = []
        for of_kind in kinds.values():
            # Trees of the same draws, of whatever candidate, share their rows, so they are grown side by side.
            of_kind.sort(key=lambda p: (p[2].seed, p[2].fold))
            for some in together([r for _, _, r in of_kind], table.n_rows):
                part = [of_kind[p] for p in some]
                pending.append((grow(table, [r for _, _, r in part]), part))
                # Trees have far fewer nodes than they might: votes are written when many are together.
                if sum(len(t.feature) for t, _ in pending) > growing.NODE_BUDGET // 4:
                    rows = _counted(table, rows, pending, groups, built, width, middle, half)
        if pending:
            rows = _counted(table, rows, pending, groups, built, width, middle, half)

        sizes = [b.n for b in built]

        def predict(block: Block) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            votes = block.state.copy().view("<i8").reshape(len(block.y), len(sizes), width)
            for i, size in enumerate(sizes):
                for f in range(k):
                    held = np.flatnonzero(block.fold == f)
                    if len(held):
                        own = votes[held, i]
                        yield i * k + f, held, own.argmax(axis=1).astype(float) if width > 1 else own[:, 0] * VOTE / size * half + middle

        scores = _measured(rows, predict, task, metric)
        rows.unpersist()
    board, best = _board(df.sparkSession, candidates, scores, k, metric not in ("rmse", "mape"))
    return board, built[best].fit(df) if refit else None


def _counted(table: Binned, rows: DataFrame, pending: list, *how) -> DataFrame:
    """Rows with the votes of the pending trees too; none are pending then."""
    out = _with_votes(rows, pending, *how)
    if rows is not table.rows:
        release(rows)
    pending.clear()
    return out


def _with_votes(rows: DataFrame, pending: Sequence[tuple[Trees, list]], groups, built: Sequence[Forest], width: int, middle: float, half: float) -> DataFrame:
    """Rows with the votes so far of every candidate: each held-out row asks the trees of its fold."""
    sizes, depths = [b.n for b in built], [b.rules.max_depth for b in built]
    parts = [
        (trees, np.array([g for g, _, _ in part]), np.array([t for _, t, _ in part]), np.array([r.fold for _, _, r in part]), int(trees.depth.max()))
        for trees, part in pending
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limited = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            block = Block.of(batch)
            n = len(block.y)
            votes = np.zeros((n, len(sizes), width), np.int64) if block.state is None else block.state.copy().view("<i8").reshape(n, len(sizes), width)
            by_fold = {f: np.flatnonzero(block.fold == f) for f in np.unique(block.fold)}
            for p, (trees, of_group, number, fold, deepest) in enumerate(parts):
                for g in np.unique(of_group):
                    for i in groups[g]:
                        d = depths[i]
                        if (p, d) not in limited:
                            limited[p, d] = trees if d is None or d >= deepest else trees.upper(d)
                        for f, held in by_fold.items():
                            mine = np.flatnonzero((of_group == g) & (number < sizes[i]) & (fold == f))
                            step = max(1, PAIRS_AT_ONCE // max(1, len(mine)))
                            for at in range(0, len(held) if len(mine) else 0, step):
                                some = held[at : at + step]
                                value = limited[p, d].value[limited[p, d].walk(block.x[some], mine)]
                                votes[some, i] += np.rint((value - middle) / (half * VOTE)).astype(np.int64).sum(axis=1)
            state = [v.tobytes() for v in votes.astype("<i8")]
            kept = [batch.column(c) for c in ("id", "x", "bins", "y", "fold")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(state, pa.binary())], ["id", "x", "bins", "y", "fold", "state"])

    return hold(rows.mapInArrow(run, "id long, x binary, bins binary, y double, fold int, state binary"))
