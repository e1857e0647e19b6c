"""Decision trees grown level by level from histograms, those of all models and folds at once.

Columns are binned once. A level is one grouped sum: tasks add up the statistics of their rows by
(tree, node, column, bin), the sums are shuffled by ranges of nodes, and the best cut of each node is
found where its sums meet. Rows find their node by walking down the cuts found so far, so there is no
table of places to rewrite and a lost executor costs the tasks it ran. A node with at most
``LOCAL_ROWS`` rows is no longer grown level by level: its rows go to one task, which grows all that
lies below it. The number of jobs is the logarithm of the rows, whatever the depth and the number of
trees.

Statistics are whole numbers (targets and gradients are scaled), so sums don't depend on how rows
are dealt and a tree is the same however many others are grown beside it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from firmlens.functions.columns import col
from firmlens.session import hold, parallelism

#: Bins of a column, without the one for gaps, and of the label where its absolute error is judged.
MOST_BINS = 254
GAP = 255
#: Nodes of trees grown together. They go to every task, so a single tree with more is refused.
NODE_BUDGET = 4_000_000
#: Sums that one task merges, about, and those whose cuts are judged at once.
CELLS_TOGETHER = 400_000
CELLS_AT_ONCE = 65_536
#: Rows of a node that one task grows to the end, and (row, tree) pairs that it holds for that.
LOCAL_ROWS = 65_536
LOCAL_PAIRS = 131_072
#: Tables of so many times that, and of so many bins, go whole to tasks that grow many small trees.
WHOLE_TIMES = 8
WHOLE_CELLS = 1 << 23
#: (row, tree) pairs that trees may have which share their rows until they are cut differently.
WHOLE_PAIRS = 1 << 21
#: Row and tree pairs that a task looks at in one step, and those that are worth a task of their own.
PAIRS_AT_ONCE = 1 << 20
PAIRS_IN_TASK = 50_000
#: Rows of a task. Each task has sums of its own, so more tasks than the rows need only mean more sums to shuffle.
ROWS_IN_TASK = 16_384

# Cumulative Poisson probabilities with mean 1, for bootstraps without a pass over the data.
_POISSON = np.cumsum([math.exp(-1.0) / math.factorial(k) for k in range(20)])


@dataclass(frozen=True)
class Rules:
    """How one tree is grown. ``criterion``: gini, entropy, squared (friedman scores the same cuts the
    same), poisson, absolute or second (gradients). ``columns`` are drawn at each node, ``tree_columns`` (a share) for the whole tree.
    ``draw``: all rows, a ``bootstrap`` or a ``share`` of them. Rows of ``fold`` are left out."""

    criterion: str = "squared"
    max_depth: int | None = None
    min_split: float = 2
    min_leaf: float = 1
    columns: int | None = None
    tree_columns: float = 1.0
    random_cuts: bool = False
    draw: str = "all"
    share: float = 1.0
    l1: float = 0.0
    l2: float = 0.0
    least_gain: float = 0.0
    least_weight: float = 0.0
    seed: int = 42
    fold: int = -1


KINDS = {"gini": "class", "entropy": "class", "squared": "value", "friedman": "value", "poisson": "value", "absolute": "ranks", "second": "second"}


# ---- the table -----------------------------------------------------------------------------------


@dataclass
class Binned:
    """Rows (id, x, bins, y, fold and maybe state) and what is known of them. ``y`` is the class
    number or the label; ``unit`` scales labels to whole numbers around ``middle``."""

    rows: DataFrame
    edges: list[np.ndarray]
    n_rows: int
    classes: list[float] = field(default_factory=list)
    folds: dict[int, tuple[int, float, list[int]]] = field(default_factory=dict)
    middle: float = 0.0
    unit: float = 1.0
    bits: int = 30
    y_edges: np.ndarray | None = None

    @property
    def n_columns(self) -> int:
        return len(self.edges)

    def release(self) -> None:
        self.rows.unpersist()


def features(names: Sequence[str]) -> Column:
    """Columns as one array; a missing value is NaN in it."""
    return F.array(*(F.coalesce(col(c).cast("double"), F.lit(float("nan"))) for c in names))


def binned(
    df: DataFrame, key: str, task: str, x: Column | None = None, label: str = "label", fold: Column | None = None, most_bins: int = MOST_BINS
) -> Binned:
    """Bins of ``x`` (an array or, by default, the vector ``features``; NaN is a gap) at its quantiles.

    Rows without a label are left out. Edges are values of the column, from a sketch that is exact
    for columns of fewer rows than its accuracy. ``key`` tells rows apart in draws.
    """
    spark = df.sparkSession
    x = vector_to_array("features") if x is None else x
    rows = df.select(
        F.xxhash64(F.lit(7), col(key)).alias("id"), x.alias("x"), col(label).cast("double").alias("y"), (F.lit(-1) if fold is None else fold).cast("int").alias("fold")
    )
    rows = hold(rows.where("y IS NOT NULL AND NOT isnan(y)"))
    n_columns = rows.select(F.max(F.size("x"))).first()[0] or 0
    values = [F.nullif(F.element_at("x", i + 1), F.lit(float("nan"))) for i in range(n_columns)]
    probs = [(k + 1) / (most_bins + 1) for k in range(most_bins)]
    sketches = [F.percentile_approx(v, probs, 10_000).alias(f"q{i}") for i, v in enumerate([*values, F.col("y")])]
    stats = rows.agg(F.count("*").alias("n"), F.min("y").alias("low"), F.max("y").alias("high"), *sketches).first()
    edges = [np.unique(np.array(stats[f"q{i}"] or [], float)) for i in range(n_columns)]
    n = stats["n"]
    out = Binned(rows, edges, n)
    per_fold = rows.groupBy("fold").agg(F.count("*").alias("n"), F.sum("y").alias("s"))
    if task == "class":
        out.classes = [r[0] for r in rows.select("y").distinct().orderBy("y").collect()]
        counts = {(r["fold"], r["y"]): r["count"] for r in rows.groupBy("fold", "y").count().collect()}
        number = F.lit(0.0)
        for k, c in enumerate(out.classes):
            number = F.when(F.col("y") == c, float(k)).otherwise(number)
        coded = rows.withColumn("y", number)
    else:
        counts, coded = {}, rows
        low, high = stats["low"] or 0.0, stats["high"] or 0.0
        # Sums of all rows stay below 2^62, those of a batch exact in double precision.
        out.bits = max(8, min(62 - max(1, n).bit_length(), 39))
        out.middle, out.unit = (low + high) / 2, ((high - low) / 2 or 1.0) / (1 << out.bits)
        out.y_edges = np.unique(np.array(stats[f"q{n_columns}"] or [], float))
    for r in per_fold.collect():
        out.folds[r["fold"]] = (r["n"], r["s"], [counts.get((r["fold"], c), 0) for c in out.classes])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype("<f8").reshape(batch.num_rows, -1)
            codes = np.empty(data.shape, np.uint8)
            for i, e in enumerate(edges):
                codes[:, i] = np.where(np.isnan(data[:, i]), GAP, np.searchsorted(e, data[:, i], side="left"))
            packed = [pa.array([r.tobytes() for r in m], pa.binary()) for m in (data, codes)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *packed, batch.column("y"), batch.column("fold")], ["id", "x", "bins", "y", "fold"])

    tasks = min(parallelism(spark), max(1, n // 64), max(spark.sparkContext.defaultParallelism, n // ROWS_IN_TASK))
    out.rows = hold(coded.repartition(tasks).mapInArrow(cut, "id long, x binary, bins binary, y double, fold int"))
    rows.unpersist()
    return out


@dataclass
class Block:
    """Some rows as arrays."""

    ids: np.ndarray
    x: np.ndarray
    bins: np.ndarray
    y: np.ndarray
    fold: np.ndarray
    state: np.ndarray | None

    @staticmethod
    def of(batch: pa.RecordBatch) -> Block:
        n = batch.num_rows

        def packed(name: str, kind: str) -> np.ndarray:
            return np.frombuffer(b"".join(batch.column(name).to_pylist()), kind).reshape(n, -1)

        state = packed("state", "<f8") if "state" in batch.schema.names else None
        numbers = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "y", "fold"))
        ids, y, fold = numbers
        return Block(ids.astype(np.int64).view(np.uint64), packed("x", "<f8"), packed("bins", "u1"), y, fold, state)

    def rows(self, some: slice) -> Block:
        return Block(self.ids[some], self.x[some], self.bins[some], self.y[some], self.fold[some], None if self.state is None else self.state[some])


def blocks(batches: Iterator[pa.RecordBatch], trees: int) -> Iterator[Block]:
    """Rows in blocks that hold a bounded number of (row, tree) pairs."""
    step = max(1, PAIRS_AT_ONCE // max(1, trees))
    for batch in batches:
        if batch.num_rows:
            block = Block.of(batch)
            for at in range(0, batch.num_rows, step):
                yield block.rows(slice(at, at + step))


# ---- trees ---------------------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """An even 64-bit hash of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in [0, 1)."""
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def cut_share(seed: np.ndarray, path: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Where between least and greatest value a random cut lies: fixed by seed, node and column."""
    return unit(mix(mix(seed ^ mix(path)) + column))


class Trees:
    """Nodes of many trees. Node t is the root of tree t; the children of a node follow each other,
    left first. ``feature`` is -1 in leaves; a gap goes left if ``gap_left``."""

    def __init__(self, n_trees: int, width: int):
        self.n_trees = n_trees
        self.feature = np.full(n_trees, -1, np.int16)
        self.cut = np.zeros(n_trees)
        self.left = np.zeros(n_trees, np.int32)
        self.gap_left = np.zeros(n_trees, bool)
        self.value = np.zeros((n_trees, width))
        self.size = np.zeros(n_trees)
        self.gain = np.zeros(n_trees)
        self.owner = np.arange(n_trees, dtype=np.int32)
        self.depth = np.zeros(n_trees, np.int16)

    def bare(self) -> Trees:
        """The cuts alone, which is what rows need to find their nodes."""
        return self._with(value=None, size=None, gain=None, owner=None, depth=None)

    def upper(self, depth: int) -> Trees:
        """The trees as if grown to that depth only."""
        return self._with(feature=np.where(self.depth < depth, self.feature, -1).astype(np.int16))

    def with_values(self, value: np.ndarray) -> Trees:
        """The same trees with other values in their nodes."""
        return self._with(value=value)

    def _with(self, **changed) -> Trees:
        out = object.__new__(Trees)
        out.__dict__ = self.__dict__ | changed
        return out

    def walk(self, x: np.ndarray, trees: slice | np.ndarray = slice(None)) -> np.ndarray:
        """The node that each row (row) has reached in each tree (column)."""
        roots = np.arange(self.n_trees, dtype=np.int32)[trees]
        node = np.tile(roots, (len(x), 1))
        return self._down(x, np.repeat(np.arange(len(x)), len(roots)), node.ravel()).reshape(node.shape)

    def walk_from(self, x: np.ndarray, roots: np.ndarray) -> np.ndarray:
        """The node that each row has reached in the one tree it asks."""
        return self._down(x, np.arange(len(x)), roots.astype(np.int32))

    def _down(self, x: np.ndarray, row: np.ndarray, flat: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(self.feature[flat] >= 0)
        while len(at):
            here = flat[at]
            v = x[row[at], self.feature[here]]
            left = np.where(np.isnan(v), self.gap_left[here], v <= self.cut[here])
            flat[at] = self.left[here] + ~left
            at = at[self.feature[flat[at]] >= 0]
        return flat

    def split(self, nodes: np.ndarray, feature, cut, gap_left, gain, values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Give ``nodes`` two children each; returns the left ones."""
        first = len(self.feature)
        left = first + 2 * np.arange(len(nodes))
        self.feature[nodes], self.cut[nodes], self.left[nodes] = feature, cut, left
        self.gap_left[nodes], self.gain[nodes] = gap_left, gain
        n = 2 * len(nodes)
        self.feature = np.append(self.feature, np.full(n, -1, np.int16))
        self.cut = np.append(self.cut, np.zeros(n))
        self.left = np.append(self.left, np.zeros(n, np.int32))
        self.gap_left = np.append(self.gap_left, np.zeros(n, bool))
        self.gain = np.append(self.gain, np.zeros(n))
        self.value = np.concatenate([self.value, values.reshape(n, -1)])
        self.size = np.append(self.size, sizes.ravel())
        self.owner = np.append(self.owner, np.repeat(self.owner[nodes], 2))
        self.depth = np.append(self.depth, np.repeat(self.depth[nodes] + 1, 2).astype(np.int16))
        return left

    def importance(self, n_columns: int) -> np.ndarray:
        """Each column's share of the gain, averaged over trees."""
        inner = self.feature >= 0
        gains = np.zeros((self.n_trees, n_columns))
        np.add.at(gains, (self.owner[inner], self.feature[inner]), self.gain[inner])
        totals = gains.sum(axis=1, keepdims=True)
        mean = np.divide(gains, totals, out=np.zeros_like(gains), where=totals > 0).mean(axis=0)
        return mean / mean.sum() if mean.sum() > 0 else mean


@dataclass
class Work:
    """What is the same at all levels: the rules of each tree as arrays, and what its rows are."""

    kind: str
    n_columns: int
    n_classes: int
    table: Binned
    numbers: dict[str, np.ndarray]
    random_cuts: bool
    weight_unit: float
    gradients: Gradients | None

    @property
    def width(self) -> int:
        return self.n_classes if self.kind == "class" else 1

    def __getstate__(self) -> dict:
        # Gradients are functions made in functions, which a broadcast cannot hold as they are.
        return self.__dict__ | {"gradients": cloudpickle.dumps(self.gradients)}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state | {"gradients": cloudpickle.loads(state["gradients"])})

    @staticmethod
    def of(table: Binned, rules: Sequence[Rules], gradients: Gradients | None, weight_unit: float) -> Work:
        kinds = {KINDS[r.criterion] for r in rules}
        if len(kinds) > 1:
            raise ValueError("trees grown together must sum the same statistics")
        random_cuts = any(r.random_cuts for r in rules)
        if random_cuts and not all(r.random_cuts for r in rules):
            raise ValueError("trees with random cuts are grown apart from others")
        n_columns = table.n_columns
        numbers = {k: np.array([getattr(r, k) for r in rules], float) for k in ("min_split", "min_leaf", "l1", "l2", "least_gain", "least_weight", "share")}
        numbers["criterion"] = np.array([r.criterion in ("entropy", "poisson") for r in rules], int)
        numbers["depth"] = np.array([NODE_BUDGET if r.max_depth is None else r.max_depth for r in rules], int)
        numbers["seed"] = np.array([r.seed for r in rules], np.uint64)
        numbers["fold"] = np.array([r.fold for r in rules], int)
        numbers["draw"] = np.array([{"all": 0, "bootstrap": 1, "share": 2}[r.draw] for r in rules], int)
        numbers["of_tree"] = np.array([max(1, round(r.tree_columns * n_columns)) for r in rules], int)
        numbers["of_node"] = np.array([n_columns if r.columns is None else max(1, min(r.columns, n_columns)) for r in rules], int)
        return Work(kinds.pop() if kinds else "value", n_columns, len(table.classes), replace(table, rows=None), numbers, random_cuts, weight_unit, gradients)

    def of_nodes(self, tree: np.ndarray) -> dict[str, np.ndarray]:
        """The numbers that cuts are judged by, of the trees of some nodes."""
        return {k: self.numbers[k][tree] for k in ("min_split", "min_leaf", "l1", "l2", "least_gain", "least_weight", "criterion")}


@dataclass
class Plan:
    """What tasks need at a level: the trees so far and the nodes to split."""

    work: Work
    trees: Trees
    slot: np.ndarray  # of each node, -1 if it is not split
    drawn: np.ndarray | None = None  # of each slot: the columns to look at
    random: np.ndarray | None = None  # of each slot and column: a cut, once it is drawn


# ---- sums ----------------------------------------------------------------------------------------


Gradients = Callable[[Block], tuple[np.ndarray, np.ndarray]]


def _weights(block: Block, work: Work, trees: slice = slice(None)) -> np.ndarray:
    """How often each row counts in each tree."""
    draw, seed, share, fold = (work.numbers[k][trees] for k in ("draw", "seed", "share", "fold"))
    w = np.ones((len(block.ids), len(draw)), np.int64)
    chance = np.flatnonzero(draw > 0)
    if len(chance):
        u = unit(mix(block.ids[:, None] ^ mix(seed[None, chance])))
        poisson = np.searchsorted(_POISSON, u, side="right")
        w[:, chance] = np.where(draw[None, chance] == 1, poisson, u < share[None, chance])
    return w * ((fold < 0) | (block.fold[:, None] != fold))


def _statistics(block: Block, work: Work, row: np.ndarray, tree: np.ndarray, weight: np.ndarray, given: tuple | None) -> np.ndarray:
    """What (row, tree) pairs add to the sums of their nodes; ``given`` are the gradients of the block."""
    y = block.y[row]
    if work.kind == "class":
        own = weight * given[0][row, tree] if given else weight  # given weights, as whole numbers
        stats = np.zeros((len(row), work.n_classes), np.int64)
        stats[np.arange(len(row)), y.astype(np.int64)] = own
    elif work.kind == "second":
        g, h = given
        stats = np.stack([weight, weight * g[row, tree], weight * h[row, tree]], axis=1)
    elif work.kind == "value":
        scaled = np.rint((y - work.table.middle) / work.table.unit).astype(np.int64)
        stats = np.stack([weight, weight * scaled], axis=1)
    else:  # ranks
        stats = weight[:, None]
    return stats


def _pairs(block: Block, plan: Plan):
    """Rows and slots of all (row, tree) pairs that count, with their statistics."""
    w = _weights(block, plan.work)
    slots = plan.slot[plan.trees.walk(block.x)]
    row, tree = np.nonzero((w > 0) & (slots >= 0))
    given = plan.work.gradients(block) if plan.work.gradients else None
    return row, slots[row, tree], _statistics(block, plan.work, row, tree, w[row, tree], given)


def _order(codes: np.ndarray) -> np.ndarray:
    """What sorts whole numbers: by 16 bits at a time, which is several times faster than comparing them."""
    if not len(codes):
        return np.zeros(0, int)
    low, high = int(codes.min()), int(codes.max())
    if high - low >= 1 << 48:
        return np.argsort(codes, kind="stable")
    rest = codes - low if low else codes
    order = np.argsort(rest.astype(np.uint16), kind="stable")
    for shift in range(16, (high - low).bit_length(), 16):
        order = order[np.argsort((rest >> shift).astype(np.uint16)[order], kind="stable")]
    return order


def add_up(codes: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order with the sums of their statistics."""
    if not len(codes):
        return codes, stats
    order = _order(codes)
    codes = codes[order]
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
    # A column at a time: sums along rows of a few numbers are slow.
    return codes[first], np.stack([np.add.reduceat(np.ascontiguousarray(stats[:, j])[order], first) for j in range(stats.shape[1])], axis=1)


def _ranks(block: Block, work: Work) -> np.ndarray | None:
    return np.searchsorted(work.table.y_edges, block.y, side="left") if work.kind == "ranks" else None


def _cells(block: Block, plan: Plan) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes ((slot * columns + column) * 256 + bin) and statistics of a block."""
    row, slot, stats = _pairs(block, plan)
    ranks, n_columns = _ranks(block, plan.work), plan.work.n_columns
    for c in range(n_columns):
        some = np.flatnonzero(plan.drawn[slot, c])
        s, r = slot[some].astype(np.int64), row[some]
        if plan.random is None:
            bins = block.bins[r, c].astype(np.int64)
        else:
            v = block.x[r, c]
            bins = np.where(np.isnan(v), GAP, v > plan.random[s, c])
        code = (s * n_columns + c) * 256 + bins
        yield (code * 256 + ranks[r] if ranks is not None else code), stats[some]


def _ranges(block: Block, plan: Plan) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes (slot * columns + column) and the least and negated greatest value there."""
    w, n_columns = _weights(block, plan.work), plan.work.n_columns
    slots = plan.slot[plan.trees.walk(block.x)]
    row, tree = np.nonzero((w > 0) & (slots >= 0))
    slot = slots[row, tree].astype(np.int64)
    for c in range(n_columns):
        v = block.x[row, c]
        some = np.flatnonzero(plan.drawn[slot, c] & ~np.isnan(v))
        yield slot[some] * n_columns + c, np.stack([v[some], -v[some]], axis=1)


def _least(codes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(codes):
        return codes, values
    order = np.argsort(codes)
    codes = codes[order]
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
    return codes[first], np.minimum.reduceat(values[order], first, axis=0)


_SUMS = "part int, codes binary, sums binary"


def _small(a: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as they need, with their width in front; others as they are."""
    if a.dtype.kind == "f":
        return b"\0" + a.astype("<f8").tobytes()
    low, high = (int(a.min()), int(a.max())) if len(a) else (0, 0)
    width = next(w for w in (1, 2, 4, 8) if -(1 << (8 * w - 1)) <= low and high < 1 << (8 * w - 1))
    return bytes([width]) + a.astype(f"<i{width}").tobytes()


def _wide(b: bytes) -> np.ndarray:
    return np.frombuffer(b, f"<i{b[0]}" if b[0] else "<f8", offset=1).astype(np.int64 if b[0] else np.float64)


def _packed_sums(codes: np.ndarray, sums: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted codes by their steps, sums column by column."""
    columns = [_small(sums[:, j]) for j in range(sums.shape[1])]
    lengths = np.array([len(columns), *map(len, columns)], "<i8").tobytes()
    return _small(np.diff(codes, prepend=0)), lengths + b"".join(columns)


def _unpacked_sums(codes: bytes, sums: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(sums, "<i8", 1)[0])
    ends = 8 * (n + 1) + np.cumsum([0, *np.frombuffer(sums, "<i8", n, offset=8)])
    return np.cumsum(_wide(codes)), np.stack([_wide(sums[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)], axis=1)


def _all_sums(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    parts = [_unpacked_sums(c, s) for c, s in zip(group.column("codes").to_pylist(), group.column("sums").to_pylist(), strict=True)]
    return np.concatenate([c for c, _ in parts]), np.concatenate([s for _, s in parts])


def _summed(rows: DataFrame, plan, n_slots: int, parts: int, span: int, cells, join) -> DataFrame:
    """Sums of tasks, a row for each range of slots."""
    bounds = (np.arange(1, parts) * n_slots // parts) * span

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = plan.value
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size, least = 0, 0

        def out(codes: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
            at = [0, *np.searchsorted(codes, bounds).tolist(), len(codes)]
            some = [p for p in range(parts) if at[p] < at[p + 1]]
            packed = [_packed_sums(codes[at[p] : at[p + 1]], sums[at[p] : at[p + 1]]) for p in some]
            columns = [pa.array(some, pa.int32()), *(pa.array([v[i] for v in packed], pa.binary()) for i in range(2))]
            return pa.RecordBatch.from_arrays(columns, ["part", "codes", "sums"])

        def joined() -> tuple[np.ndarray, np.ndarray]:
            return join(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))

        for block in blocks(batches, level.trees.n_trees):
            for codes, sums in cells(block, level):
                codes, sums = join(codes, sums)
                held.append((codes, sums))
                size += len(codes)
                if size > CELLS_TOGETHER + 2 * least:
                    held[:] = [joined()]
                    size = least = len(held[0][0])
                    if size > 2 * CELLS_TOGETHER:
                        yield out(*held.pop())
                        size = least = 0
        if held:
            yield out(*joined())

    return rows.mapInArrow(run, _SUMS)


# ---- cuts ----------------------------------------------------------------------------------------


def _score(kind: str, criterion: np.ndarray, s: np.ndarray, rule: dict[str, np.ndarray], table: Binned) -> np.ndarray:
    """What a node with these sums is worth; a cut gains what its sides are worth beyond the whole."""
    with np.errstate(divide="ignore", invalid="ignore"):
        if kind == "class":
            n = s.sum(axis=1)
            gini = (s.astype(float) ** 2).sum(axis=1) / n
            entropy = np.where(s > 0, s * np.log(np.maximum(s, 1)), 0.0).sum(axis=1) - n * np.log(np.maximum(n, 1))
            out = np.where(criterion == 1, entropy, gini)
        elif kind == "value":
            total = s[:, 1] * table.unit
            real = total + s[:, 0] * table.middle
            poisson = np.where(real > 0, real * np.log(np.maximum(real, 1e-300) / s[:, 0]), 0.0)
            out = np.where(criterion == 1, poisson, total**2 / s[:, 0])
        else:
            out = _soft(s[:, 1], rule, table) ** 2 / (s[:, 2] * table.unit + rule["l2"]) / 2
    return np.nan_to_num(out)


def _soft(g: np.ndarray, rule: dict[str, np.ndarray], table: Binned) -> np.ndarray:
    g = g * table.unit
    return np.sign(g) * np.maximum(np.abs(g) - rule["l1"], 0.0)


def _value(kind: str, s: np.ndarray, rule: dict[str, np.ndarray], table: Binned) -> np.ndarray:
    """What a leaf with these sums predicts."""
    with np.errstate(divide="ignore", invalid="ignore"):
        if kind == "class":
            out = s / s.sum(axis=1, keepdims=True)
        elif kind == "value":
            out = (table.middle + s[:, 1] * table.unit / s[:, 0])[:, None]
        else:
            out = (-_soft(s[:, 1], rule, table) / (s[:, 2] * table.unit + rule["l2"]))[:, None]
    return np.nan_to_num(out)


def _count(kind: str, s: np.ndarray, weight_unit: float) -> np.ndarray:
    """Rows (with their weights); ``ranks`` have a histogram of the label instead of sums."""
    return s.sum(axis=1) * weight_unit if kind in ("class", "ranks") else s[:, 0].astype(float)


class Cuts:
    """The best cut of each slot among sorted cells. Of equal gains the first column and the lowest
    cut win; a gap goes where it gains more, and to the larger side where there was none."""

    def __init__(self, codes: np.ndarray, stats: np.ndarray, work: Work, rules: dict[str, np.ndarray]):
        kind, n_columns, table, single, weight_unit = work.kind, work.n_columns, work.table, work.random_cuts, work.weight_unit
        if kind == "ranks":
            codes, stats, self.absolute = _by_rank(codes, stats, table)
        segment, bins = codes >> 8, codes & 255
        slot = segment // n_columns
        first = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
        of = np.cumsum(np.append(False, segment[1:] != segment[:-1]))
        gap = bins == GAP
        rule = {k: v[slot] for k, v in rules.items()}
        total = np.add.reduceat(stats, first, axis=0)[of]
        gaps = np.add.reduceat(stats * gap[:, None], first, axis=0)[of]
        running = np.cumsum(stats, axis=0)
        left = running - (running[first] - stats[first])[of]
        best = np.full(len(codes), -np.inf)
        to_left = np.zeros(len(codes), bool)
        sides = [left]
        if gap.any():
            sides.append(left + gaps)
        if kind != "ranks":
            worth = _score(kind, rule["criterion"], total, rule, table)
        for side, l in enumerate(sides):
            r = total - l
            nl, nr = (_count(kind, s, weight_unit) for s in (l, r))
            if kind == "ranks":
                gain = self.absolute(total) - self.absolute(l) - self.absolute(r)
            else:
                gain = _score(kind, rule["criterion"], l, rule, table) + _score(kind, rule["criterion"], r, rule, table) - worth
            scale = np.abs(worth) if kind != "ranks" else np.abs(self.absolute(total))
            ok = ~gap & (nl > 0) & (nr > 0) & (nl >= rule["min_leaf"]) & (nr >= rule["min_leaf"]) & (nl + nr >= rule["min_split"])
            if kind == "second":
                ok &= (l[:, 2] * table.unit >= rule["least_weight"]) & (r[:, 2] * table.unit >= rule["least_weight"])
                gain = gain - rule["least_gain"]
            if single:
                ok &= bins == 0
            ok &= gain > scale * 1e-12
            gain = np.where(ok, gain, -np.inf)
            better = gain > best
            best[better], to_left[better] = gain[better], bool(side)
        none = ~gaps.any(axis=1)
        to_left = np.where(none, _count(kind, left, 1.0) * 2 >= _count(kind, total, 1.0), to_left)
        starts = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
        most = np.maximum.reduceat(best, starts)
        spread = np.repeat(most, np.diff(np.append(starts, len(slot))))
        hit = np.flatnonzero(best == spread)
        _, at = np.unique(slot[hit], return_index=True)
        cell = hit[at]
        self.slot, self.gain = slot[cell], best[cell]
        self.column, self.bin, self.gap_left = segment[cell] % n_columns, bins[cell], to_left[cell]
        whole = total[cell]
        l = left[cell] + np.where((self.gap_left & ~none[cell])[:, None], gaps[cell], 0)
        r = whole - l
        picked = {k: v[self.slot] for k, v in rules.items()}
        parts = (whole, l, r)
        self.sizes = np.stack([_count(kind, s, weight_unit) for s in parts], axis=1)
        if kind == "ranks":
            self.values = np.stack([self.absolute(s, median=True) for s in parts], axis=1)[:, :, None]
        else:
            self.values = np.stack([_value(kind, s, picked, table) for s in parts], axis=1)
        # A class node with one class is finished; of others nothing is known.
        self.pure = np.stack([(s.max(axis=1) == s.sum(axis=1)) if kind == "class" else np.zeros(len(cell), bool) for s in parts], axis=1)


class Best:
    """``Cuts`` of any number of slots, a bounded number of cells at a time."""

    FIELDS = ("slot", "gain", "column", "bin", "gap_left", "sizes", "values", "pure")

    def __init__(self, codes: np.ndarray, stats: np.ndarray, work: Work, rules: dict[str, np.ndarray]):
        cell = codes >> 8 if work.kind == "ranks" else codes
        slot = (cell >> 8) // work.n_columns
        # A cell of ranks is a histogram of the label.
        most = CELLS_AT_ONCE // (64 if work.kind == "ranks" else 1)
        number = np.cumsum(np.append(False, cell[1:] != cell[:-1]))
        first = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
        group = number[first] // most
        at = [0, *first[np.flatnonzero(group[1:] != group[:-1]) + 1].tolist(), len(codes)]
        found = [Cuts(codes[a:b], stats[a:b], work, rules) for a, b in zip(at[:-1], at[1:], strict=True)]
        for name in self.FIELDS:
            setattr(self, name, np.concatenate([getattr(f, name) for f in found]))


def _by_rank(codes: np.ndarray, stats: np.ndarray, table: Binned):
    """Cells with a histogram of the label each, and the absolute error around a histogram's median
    (or the median). The label's bins stand for their upper edges, so both are exact as long as it
    has no more values than bins."""
    cells, at = np.unique(codes >> 8, return_inverse=True)
    edges = table.y_edges
    points = np.append(edges, table.middle + table.unit * (1 << table.bits))
    wide = np.zeros((len(cells), len(points)), np.int64)
    np.add.at(wide, (at, codes & 255), stats[:, 0])

    def error(histogram: np.ndarray, median: bool = False) -> np.ndarray:
        running = np.cumsum(histogram, axis=1)
        n = running[:, -1:]
        low = (running * 2 >= n).argmax(axis=1)
        high = (running * 2 > n).argmax(axis=1)
        middle = (points[low] + points[high]) / 2
        return middle if median else (histogram * np.abs(points[None, :] - middle[:, None])).sum(axis=1)

    return cells, wide, error


# ---- cuts of a level -----------------------------------------------------------------------------


def _found_schema(width: int) -> str:
    """A slot's cut, and for the whole node and its sides the rows, whether it is finished, and values."""
    parts = [f"n{i} double, p{i} boolean" for i in range(3)] + [f"v{j} double" for j in range(3 * width)]
    return "slot int, column int, bin int, gap_left boolean, gain double, " + ", ".join(parts)


def _found(sums: DataFrame, level_work, of_slots, width: int) -> pa.Table:
    def choose(group: pa.Table) -> pa.Table:
        codes, stats = add_up(*_all_sums(group))
        cuts = Best(codes, stats, level_work.value, of_slots.value)
        values = cuts.values.reshape(len(cuts.slot), -1)
        columns = {"slot": cuts.slot.astype(np.int32), "column": cuts.column.astype(np.int32), "bin": cuts.bin.astype(np.int32), "gap_left": cuts.gap_left, "gain": cuts.gain}
        for i in range(3):
            columns |= {f"n{i}": cuts.sizes[:, i], f"p{i}": cuts.pure[:, i]}
        return pa.table(columns | {f"v{j}": values[:, j] for j in range(values.shape[1])})

    return sums.groupBy("part").applyInArrow(choose, _found_schema(width)).toArrow()


def _drawn_columns(work: Work, tree: np.ndarray, path: np.ndarray) -> np.ndarray:
    """Which columns each node looks at: drawn by seed and path, so the same in any company."""
    n_columns, numbers = work.n_columns, work.numbers
    if (numbers["of_tree"] >= n_columns).all() and (numbers["of_node"] >= n_columns).all():
        return np.ones((len(tree), n_columns), bool)
    seeds = numbers["seed"][tree]
    c = np.arange(n_columns, dtype=np.uint64)
    of_tree = mix(mix(seeds[:, None] + np.uint64(11)) ^ c)
    allowed = of_tree.argsort(axis=1).argsort(axis=1) < numbers["of_tree"][tree][:, None]
    of_node = np.where(allowed, mix(mix(seeds ^ mix(path))[:, None] ^ mix(c)) >> np.uint64(1), np.uint64(1 << 63))
    return allowed & (of_node.argsort(axis=1).argsort(axis=1) < numbers["of_node"][tree][:, None])


def most_nodes(r: Rules, n_rows: int) -> float:
    """Nodes that a tree can have."""
    return min(2 * n_rows / max(1, r.min_leaf), 2 ** min(60, (60 if r.max_depth is None else r.max_depth) + 1))


def together(rules: Sequence[Rules], n_rows: int) -> Iterator[list[int]]:
    """Numbers of trees in groups whose nodes stay in a part of the budget for sure, or single ones."""
    group, room = [], 0
    for i, r in enumerate(rules):
        most = most_nodes(r, n_rows)
        if group and room + most > NODE_BUDGET // 4:
            yield group
            group, room = [], 0
        group.append(i)
        room += most
    if group:
        yield group


def _children(work: Work, trees: Trees, node, tree, path, s, column, cut, gap_left, gain, sizes, pure, values):
    """Split slots ``s``: their children, and which of them can be split in turn."""
    left = trees.split(node[s], column, cut, gap_left, gain, values[:, 1:], sizes[:, 1:])
    children = np.stack([left, left + 1], axis=1).ravel()
    tree = np.repeat(tree[s], 2)
    path = np.stack([2 * path[s], 2 * path[s] + np.uint64(1)], axis=1).ravel()
    numbers = work.numbers
    more = ~pure[:, 1:].ravel() & (trees.depth[children] < numbers["depth"][tree]) & (trees.size[children] >= numbers["min_split"][tree])
    if work.kind != "class" or work.weight_unit == 1.0:
        more &= trees.size[children] >= 2 * numbers["min_leaf"][tree]
    return children, tree, path, more


def _upper_edges(table: Binned) -> list[np.ndarray]:
    return [np.append(e, np.inf) for e in table.edges]


# ---- nodes whose rows are at hand ----------------------------------------------------------------


@dataclass
class Pairs:
    """(row, tree) pairs by the slot of their node. With random cuts ``x`` are values, else bins."""

    slot: np.ndarray
    stats: np.ndarray
    x: np.ndarray
    ranks: np.ndarray | None

    def some(self, at: np.ndarray, slot: np.ndarray) -> Pairs:
        return Pairs(slot, self.stats[at], self.x[at], None if self.ranks is None else self.ranks[at])


def _drawn_here(pairs: Pairs, work: Work, tree: np.ndarray, path: np.ndarray) -> np.ndarray:
    """``_draw_cuts`` of rows at hand."""
    order = _order(pairs.slot)
    slot = pairs.slot[order]
    first = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
    # A column at a time: least and greatest along rows of a few numbers are slow.
    values = [np.ascontiguousarray(pairs.x[:, c])[order] for c in range(work.n_columns)]
    low, high = (np.stack([f.reduceat(v, first) for v in values], axis=1) for f in (np.fmin, np.fmax))
    s = slot[first]
    u = cut_share(work.numbers["seed"][tree[s]][:, None], path[s][:, None], np.arange(work.n_columns, dtype=np.uint64)[None, :])
    out = np.full((len(tree), work.n_columns), -np.inf)
    out[s] = np.where(np.isnan(low), -np.inf, low + u * (high - low))
    return out


def _running(slot: np.ndarray, bins: np.ndarray, stats: list[np.ndarray], exact: list[bool], n_slots: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Slot and bin of the cells that pairs are in, in order, and the statistics summed up to each cell."""
    n = len(slot)
    if n_slots * 256 <= 2 * n:
        # Few cells: counted in place. Sums of floats are exact where they stay below 2^53, so larger numbers go in two halves.
        code = slot * 256 + bins
        at = np.flatnonzero(np.bincount(code, minlength=n_slots * 256))
        sums = []
        for v, small in zip(stats, exact, strict=True):
            if small:
                sums.append(np.bincount(code, v, minlength=n_slots * 256)[at].astype(np.int64))
            else:
                low, high = (np.bincount(code, h, minlength=n_slots * 256)[at].astype(np.int64) for h in (v & 0xFFFFFF, v >> 24))
                sums.append((high << 24) + low)
        return at >> 8, at & 255, [np.cumsum(v) for v in sums]
    order = np.argsort(bins, kind="stable")
    for shift in range(0, max(1, n_slots.bit_length()), 16):
        order = order[np.argsort((slot >> shift).astype(np.uint16)[order], kind="stable")]
    slot, bins = slot[order], bins[order]
    end = np.append(np.flatnonzero((slot[1:] != slot[:-1]) | (bins[1:] != bins[:-1])), n - 1)
    return slot[end], bins[end].astype(np.int64), [np.cumsum(v[order])[end] for v in stats]


def _worth(kind: str, criterion: np.ndarray, s: list[np.ndarray], rule: dict[str, np.ndarray], table: Binned) -> np.ndarray:
    """``_score`` of statistics that are an array each."""
    other = (criterion == 1).any()
    with np.errstate(divide="ignore", invalid="ignore"):
        if kind == "class":
            n = sum(s[1:], s[0])
            out = sum((v.astype(float) ** 2 for v in s[1:]), s[0].astype(float) ** 2) / n
            if other:
                parts = [np.where(v > 0, v * np.log(np.maximum(v, 1)), 0.0) for v in s]
                out = np.where(criterion == 1, sum(parts[1:], parts[0]) - n * np.log(np.maximum(n, 1)), out)
        elif kind == "value":
            total = s[1] * table.unit
            out = total**2 / s[0]
            if other:
                real = total + s[0] * table.middle
                out = np.where(criterion == 1, np.where(real > 0, real * np.log(np.maximum(real, 1e-300) / s[0]), 0.0), out)
        else:
            out = _soft(s[1], rule, table) ** 2 / (s[2] * table.unit + rule["l2"]) / 2
    return np.nan_to_num(out, copy=False)


class NearCuts:
    """``Cuts`` of rows at hand, a column after the other. ``source``: the slot of pairs that each node has
    its rows in; ``drawn`` and ``random`` are those of the slots, ``rules`` of the nodes."""

    def __init__(
        self, pairs: Pairs, stats: list[np.ndarray], exact: list[bool], work: Work, rules: dict[str, np.ndarray], drawn: np.ndarray,
        random: np.ndarray | None, source: np.ndarray,
    ):
        kind, table, n_slots = work.kind, work.table, len(source)
        shared = not np.array_equal(source, np.arange(len(drawn)))
        best = np.full(n_slots, -np.inf)
        column, bin_, gap_left = np.zeros(n_slots, np.int64), np.zeros(n_slots, np.int64), np.zeros(n_slots, bool)
        whole, lefts = ([np.zeros(n_slots, np.int64) for _ in stats] for _ in range(2))
        there = np.zeros(n_slots, bool)

        def count(s: list[np.ndarray], unit: float) -> np.ndarray:
            return sum(s[1:], s[0]) * unit if kind == "class" else s[0].astype(float)

        wanted = ("criterion", "min_leaf", "min_split") + (("l1", "l2", "least_gain", "least_weight") if kind == "second" else ())
        for c in range(work.n_columns):
            own, some = pairs.slot, stats
            v = pairs.x[:, c]
            if not drawn[:, c].all():
                at = np.flatnonzero(drawn[own, c])
                if not len(at):
                    continue
                own, some, v = own[at], [s[at] for s in stats], v[at]
            bins = v if random is None else np.where(np.isnan(v), GAP, v > random[own, c]).astype(np.uint8)
            slot, bins, run = _running(own, bins, some, exact, len(drawn))
            starts = np.append(True, slot[1:] != slot[:-1])
            first = np.flatnonzero(starts)
            of = np.cumsum(starts) - 1
            last = np.append(first[1:], len(slot)) - 1
            here = slot[first]
            base = [np.where(first > 0, r[first - 1], 0) for r in run]
            total = [r[last] - b for r, b in zip(run, base, strict=True)]
            left = [r - b[of] for r, b in zip(run, base, strict=True)]
            gap = bins == GAP
            # The bin of gaps is the last of its slot.
            gaps = [np.where(gap[last], t - np.where(last > first, l[last - 1], 0), 0) for t, l in zip(total, left, strict=True)]
            if shared:
                # Every node has the cells of its rows.
                place = np.full(len(drawn), -1)
                place[here] = np.arange(len(here))
                here = np.flatnonzero(place[source] >= 0)
                segment = place[source[here]]
                many = (last - first + 1)[segment]
                ends = np.cumsum(many)
                cell = np.repeat(first[segment] - ends + many, many) + np.arange(ends[-1])
                of, first = np.repeat(np.arange(len(here)), many), ends - many
                slot, bins, gap, left = here[of], bins[cell], gap[cell], [v[cell] for v in left]
                total, gaps = ([v[segment] for v in vs] for vs in (total, gaps))
            none = np.logical_and.reduce([g == 0 for g in gaps])
            for w, t in zip(whole, total, strict=True):
                w[here] = t
            there[here] = True
            rule = {k: rules[k][here] for k in wanted}
            worth = _worth(kind, rule["criterion"], total, rule, table)
            least = (np.abs(worth) * 1e-12)[of]
            worth, rule = worth[of], {k: r[of] for k, r in rule.items()}
            total = [t[of] for t in total]
            possible = ~gap if random is None else bins == 0
            possible &= count(total, work.weight_unit) >= rule["min_split"]
            found, to_left = np.full(len(slot), -np.inf), np.zeros(len(slot), bool)
            for side, l in enumerate([left, [a + g[of] for a, g in zip(left, gaps, strict=True)]] if gap.any() else [left]):
                r = [t - a for t, a in zip(total, l, strict=True)]
                nl, nr = (count(s, work.weight_unit) for s in (l, r))
                gain = _worth(kind, rule["criterion"], l, rule, table) + _worth(kind, rule["criterion"], r, rule, table) - worth
                ok = possible & (nl > 0) & (nr > 0) & (nl >= rule["min_leaf"]) & (nr >= rule["min_leaf"])
                if kind == "second":
                    ok &= (l[2] * table.unit >= rule["least_weight"]) & (r[2] * table.unit >= rule["least_weight"])
                    gain = gain - rule["least_gain"]
                ok &= gain > least
                better = ok & (gain > found)
                found[better], to_left[better] = gain[better], bool(side)
            most = np.maximum.reduceat(found, first)
            hit = np.flatnonzero((found == most[of]) & (most > best[here])[of])
            if not len(hit):
                continue
            cell = hit[np.diff(of[hit], prepend=-1) > 0]
            seg, s = of[cell], slot[cell]
            best[s], column[s], bin_[s] = found[cell], c, bins[cell]
            mine = [a[cell] for a in left]
            gap_left[s] = np.where(none[seg], count(mine, 1.0) * 2 >= count([t[cell] for t in total], 1.0), to_left[cell])
            for a, m, g in zip(lefts, mine, gaps, strict=True):
                a[s] = m + np.where(gap_left[s] & ~none[seg], g[seg], 0)
        self.slot = np.flatnonzero(there)
        self.gain, self.column, self.bin, self.gap_left = best[self.slot], column[self.slot], bin_[self.slot], gap_left[self.slot]
        all_, l = (np.stack([v[self.slot] for v in vs], axis=1) for vs in (whole, lefts))
        parts, picked = (all_, l, all_ - l), {k: v[self.slot] for k, v in rules.items()}
        self.sizes = np.stack([_count(kind, s, work.weight_unit) for s in parts], axis=1)
        self.values = np.stack([_value(kind, s, picked, table) for s in parts], axis=1)
        self.pure = np.stack([(s.max(axis=1) == s.sum(axis=1)) if kind == "class" else np.zeros(len(s), bool) for s in parts], axis=1)


def _sorted_cuts(pairs: Pairs, work: Work, rules: dict[str, np.ndarray], drawn: np.ndarray, random: np.ndarray | None) -> Best:
    """The cuts of any statistics, from the sums of all cells."""
    held = []
    for c in range(work.n_columns):
        some = np.flatnonzero(drawn[pairs.slot, c])
        s, v = pairs.slot[some].astype(np.int64), pairs.x[some, c]
        bins = v if random is None else np.where(np.isnan(v), GAP, v > random[s, c])
        code = (s * work.n_columns + c) * 256 + bins
        held.append(add_up(code if pairs.ranks is None else code * 256 + pairs.ranks[some], pairs.stats[some]))
    codes, sums = (np.concatenate([h[i] for h in held]) for i in range(2))
    order = np.argsort(codes)
    return Best(codes[order], sums[order], work, rules)


def grow_here(work: Work, tree: np.ndarray, path: np.ndarray, depth: np.ndarray, pairs: Pairs, source: np.ndarray | None = None) -> Trees:
    """All that lies below some nodes, whose numbers are the slots of ``pairs``: the same cuts as level
    by level. The nodes are the roots of what comes back. ``source``: slots of nodes that share their rows
    with others of the same seed, path and drawn columns; they go on sharing them as long as they are cut alike."""
    out = Trees(len(tree), work.width)
    out.depth[:] = depth
    ends = _upper_edges(work.table)
    node, begun = np.arange(len(tree)), False
    # Sums of eight and more numbers are not added one after the other.
    near = pairs.ranks is None and pairs.stats.shape[1] < 8
    if near:
        pairs = replace(pairs, slot=pairs.slot.astype(np.int64))
        stats = [np.ascontiguousarray(pairs.stats[:, j]) for j in range(pairs.stats.shape[1])]
        top = [int(np.abs(v).max(initial=0)) for v in stats]
        exact = [t * len(stats[0]) < 1 << 53 for t in top]
        stats = [v.astype(np.int8 if t < 1 << 7 else np.int16 if t < 1 << 15 else v.dtype) for v, t in zip(stats, top, strict=True)]
    source = np.arange(len(tree)) if source is None else source
    while len(node) and len(pairs.slot):
        drawn = _drawn_columns(work, tree, path)
        _, of_set = np.unique(source, return_index=True)
        random = _drawn_here(pairs, work, tree[of_set], path[of_set]) if work.random_cuts else None
        rules = work.of_nodes(tree)
        if near:
            cuts = NearCuts(pairs, stats, exact, work, rules, drawn[of_set], random, source)
        else:
            cuts = _sorted_cuts(pairs, work, rules, drawn, random)
        if not begun:
            out.value[cuts.slot], out.size[cuts.slot], begun = cuts.values[:, 0], cuts.sizes[:, 0], True
        good = np.flatnonzero(np.isfinite(cuts.gain) & (work.numbers["depth"][tree[cuts.slot]] > out.depth[node[cuts.slot]]))
        if not len(good):
            break
        s, column, bins, gap_left = cuts.slot[good], cuts.column[good], cuts.bin[good], cuts.gap_left[good]
        cut = random[source[s], column] if random is not None else np.array([ends[c][b] for c, b in zip(column, bins, strict=True)])
        sources = source[s]
        children, tree, path, more = _children(work, out, node, tree, path, s, column, cut, gap_left, cuts.gain[good], cuts.sizes[good], cuts.pure[good], cuts.values[good])
        node, tree, path = children[more], tree[more], path[more]
        if len(of_set) == len(source):
            group = np.arange(len(s))
            place = np.full(len(of_set), -1)
            place[sources] = group
            at = place[pairs.slot]
            of = np.flatnonzero(at >= 0)
            at = at[of]
        else:
            # Nodes with the same rows and the same cut; the rows of others that were with them are copied.
            alike = np.stack([sources, column, bins, gap_left], axis=1)
            alike, first, group = np.unique(alike, axis=0, return_index=True, return_inverse=True)
            order = _order(pairs.slot)
            begin = np.searchsorted(pairs.slot[order], np.arange(len(of_set) + 1))
            many = np.diff(begin)[alike[:, 0]]
            at = np.repeat(np.arange(len(alike)), many)
            of = order[np.repeat(begin[alike[:, 0]] - np.cumsum(many) + many, many) + np.arange(many.sum())]
            column, bins, gap_left, cut = column[first], bins[first], gap_left[first], cut[first]
        side = (2 * group[:, None] + np.arange(2)).ravel()[more]
        wanted = np.zeros(2 * (int(group.max()) + 1), bool)
        wanted[side] = True
        number = np.where(wanted, np.cumsum(wanted) - 1, -1)
        source = number[side]
        v = pairs.x[of, column[at]]
        gap, low = (v == GAP, v <= bins[at]) if random is None else (np.isnan(v), v <= cut[at])
        slot = number[2 * at + ~np.where(gap, gap_left[at], low)]
        kept = slot >= 0
        of, slot = of[kept], slot[kept]
        if near:
            stats, pairs = [v[of] for v in stats], Pairs(slot, pairs.stats[:0], pairs.x[of], None)
        else:
            pairs = pairs.some(of, slot)
    return out


#: Arrays of ``Trees`` in a table of pieces.
_NODES = {"feature": "<i2", "cut": "<f8", "left": "<i4", "gap_left": "?", "value": "<f8", "size": "<f8", "gain": "<f8", "owner": "<i4", "depth": "<i2"}
PIECES = "part int, roots binary, gains binary, " + ", ".join(f"{n} binary" for n in _NODES)


def _piece(part: int, roots: np.ndarray, trees: Trees, n_columns: int) -> dict:
    """A row of a table of pieces: ``roots`` are slots; ``gains`` what each root's tree gains by column."""
    inner = trees.feature >= 0
    gains = np.zeros((trees.n_trees, n_columns))
    np.add.at(gains, (trees.owner[inner], trees.feature[inner]), trees.gain[inner])
    arrays = {n: getattr(trees, n).astype(k).tobytes() for n, k in _NODES.items()}
    return {"part": part, "roots": roots.astype("<i4").tobytes(), "gains": gains.tobytes()} | arrays


def _pieces(found: Sequence[dict]) -> pa.Table:
    names = {"part": pa.int32()} | {n: pa.binary() for n in ("roots", "gains", *_NODES)}
    return pa.table({n: pa.array([f[n] for f in found], k) for n, k in names.items()})


def read_piece(row: dict, width: int) -> tuple[np.ndarray, Trees]:
    """Slots of the roots, and the trees."""
    out = object.__new__(Trees)
    for n, k in _NODES.items():
        setattr(out, n, np.frombuffer(row[n], k))
    out.value = out.value.reshape(-1, width)
    roots = np.frombuffer(row["roots"], "<i4")
    out.n_trees = len(roots)
    return roots, out


def graft(trees: Trees, places: np.ndarray, pieces: Sequence[tuple[np.ndarray, Trees]]) -> None:
    """Put pieces at their nodes: ``places`` are the nodes of the slots."""
    first, tails = len(trees.feature), []
    for roots, piece in sorted(pieces, key=lambda p: int(p[0][0]) if len(p[0]) else -1):
        at, m = places[roots], len(roots)
        index = np.concatenate([at, first + np.arange(len(piece.feature) - m)])
        inner = piece.feature >= 0
        left = np.where(inner, index[np.where(inner, piece.left, 0)], 0).astype(np.int32)
        whole = trees.depth[at] == 0
        trees.value[at[whole]], trees.size[at[whole]] = piece.value[:m][whole], piece.size[:m][whole]
        trees.feature[at], trees.cut[at], trees.left[at], trees.gap_left[at], trees.gain[at] = piece.feature[:m], piece.cut[:m], left[:m], piece.gap_left[:m], piece.gain[:m]
        tails.append((piece, m, left, trees.owner[at][piece.owner]))
        first += len(piece.feature) - m
    for name in _NODES:
        parts = [left[m:] if name == "left" else owner[m:] if name == "owner" else getattr(p, name)[m:] for p, m, left, owner in tails]
        setattr(trees, name, np.concatenate([getattr(trees, name), *parts]).astype(getattr(trees, name).dtype))


@dataclass
class Tails:
    """Where trees go on: the node of each slot, and the part of the table of pieces it is in."""

    places: np.ndarray
    part: np.ndarray
    pieces: DataFrame
    shared: object = None


def _by_tree(table: Binned, rules: Sequence[Rules], gradients: Gradients | None, cores: int) -> bool:
    """Whether tasks should get the whole table and some of the trees: always for few rows, and for many
    small trees on a table whose bins fit a task. Their levels would be sums of hardly more than a row each."""
    if table.n_rows <= LOCAL_ROWS:
        return True
    fits = table.n_rows <= WHOLE_TIMES * LOCAL_ROWS and table.n_rows * table.n_columns <= WHOLE_CELLS
    return fits and gradients is None and len(rules) >= 4 * cores and max(most_nodes(r, table.n_rows) for r in rules) <= LOCAL_ROWS


def _whole_trees(rows: DataFrame, work: Work, n: int, n_rows: int) -> Tails:
    """Trees of a table of bounded size: every task gets all rows, and some of the trees."""
    spark = rows.sparkSession
    order, kin, part = _dealt_trees(work, n, n_rows)
    chunks = int(part[-1]) + 1
    begin = np.searchsorted(part, np.arange(chunks + 1))
    tasks = min(max(1, n_rows * n // PAIRS_IN_TASK), chunks, 3 * spark.sparkContext.defaultParallelism)
    # Without gradients nothing but bins (or values) is looked at, so the rows are small enough to be sent to all.
    sent = None
    if tasks > 1 and not work.gradients:
        x = "x" if work.random_cuts else F.lit(b"").alias("x")
        bins = F.lit(b"").alias("bins") if work.random_cuts else "bins"
        sent = Block.of(rows.select("id", x, bins, "y", "fold").toArrow().combine_chunks().to_batches()[0])
    shared = spark.sparkContext.broadcast((work, sent))

    def build(block: Block, task: int) -> Iterator[dict]:
        work = shared.value[0]
        given = work.gradients(block) if work.gradients else None
        ranks = _ranks(block, work)
        x = block.x if work.random_cuts else block.bins
        for chunk in range(task, chunks, tasks):
            trees = np.sort(order[begin[chunk] : begin[chunk + 1]])
            # Trees with the same draws have the same rows at first.
            _, lead, source = np.unique(kin[trees], return_index=True, return_inverse=True)
            lead = trees[lead]
            w = _weights(block, work, lead)
            row, slot = np.nonzero(w > 0)
            stats = _statistics(block, work, row, lead[slot], w[row, slot], given)
            pairs = Pairs(slot, stats, x[row], None if ranks is None else ranks[row])
            grown = grow_here(work, trees, np.ones(len(trees), np.uint64), np.zeros(len(trees), int), pairs, source)
            yield _piece(chunk, trees, grown, work.n_columns)

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            for piece in build(Block.of(pa.Table.from_batches(held).combine_chunks().to_batches()[0]), 0):
                yield from _pieces([piece]).to_batches()

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task in batch.column("id").to_pylist():
                for piece in build(shared.value[1], task):
                    yield from _pieces([piece]).to_batches()

    def share(group: pa.Table) -> pa.Table:
        task = group.column("task")[0].as_py()
        return _pieces([*build(Block.of(group.combine_chunks().to_batches()[0]), task)])

    if tasks == 1:
        found = rows.coalesce(1).mapInArrow(alone, PIECES)
    elif sent is not None:
        found = spark.range(0, tasks, 1, tasks).mapInArrow(mine, PIECES)
    else:
        dealt = rows.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
        found = dealt.repartition(2 * tasks, "task").groupBy("task").applyInArrow(share, PIECES)
    of_tree = np.empty(n, np.int64)
    of_tree[order] = part
    return Tails(np.arange(n), of_tree, found, shared)


def _dealt_trees(work: Work, n: int, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trees in the order of their chunks, what tells their draws apart, and the chunk of each in that order."""
    numbers = work.numbers
    kin = np.arange(n)
    if not work.gradients and work.kind != "ranks" and work.width < 8:
        alike = [numbers[k].astype(np.float64) for k in ("draw", "share", "fold", "of_tree", "of_node")]
        _, kin = np.unique(np.stack([numbers["seed"].view(np.float64), *alike], axis=1).view("V48").ravel(), return_inverse=True)
    order = np.argsort(kin, kind="stable")
    sets, most = max(1, LOCAL_PAIRS // n_rows), max(1, WHOLE_PAIRS // n_rows)
    part, held, trees, before = np.empty(n, np.int64), 0, 0, -1
    chunk = 0
    for i, k in enumerate(kin[order].tolist()):
        new = k != before
        if (new and held == sets) or trees == max(sets, most):
            chunk, held, trees, new = chunk + 1, 0, 0, True
        held, trees, before = held + new, trees + 1, k
        part[i] = chunk
    return order, kin, part


def _below(rows: DataFrame, work: Work, trees: Trees, node: np.ndarray, tree: np.ndarray, path: np.ndarray) -> Tails:
    """All that lies below some nodes of few rows each: their rows meet in one task."""
    spark = rows.sparkSession
    order = np.argsort(tree, kind="stable")
    node, tree, path = node[order], tree[order], path[order]
    size = trees.size[node]
    part = ((np.cumsum(size) - size) // LOCAL_PAIRS).astype(np.int32)
    _, part = np.unique(part, return_inverse=True)
    part = part.astype(np.int32)
    slot = np.full(len(trees.feature), -1, np.int32)
    slot[node] = np.arange(len(node))
    first = np.searchsorted(part, np.arange(part[-1] + 2))
    plan = spark.sparkContext.broadcast((Plan(work, trees.bare(), slot), part, first, tree, path, trees.depth[node]))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, part, first, *_ = plan.value
        for block in blocks(batches, level.trees.n_trees):
            row, slot, stats = _pairs(block, level)
            ranks = _ranks(block, level.work)
            x = block.x if level.work.random_cuts else block.bins
            order = np.argsort(slot, kind="stable")
            row, slot, stats = row[order], slot[order], stats[order]
            at = np.searchsorted(slot, first)
            some = np.flatnonzero(at[1:] > at[:-1])
            ranges = [slice(at[p], at[p + 1]) for p in some]
            lengths = [stats[r] for r in ranges]
            columns = [
                pa.array(some.astype(np.int32)),
                pa.array([_small(slot[r] - first[p]) for p, r in zip(some, ranges, strict=True)], pa.binary()),
                pa.array([_packed_sums(np.zeros(0, np.int64), s)[1] for s in lengths], pa.binary()),
                pa.array([x[row[r]].tobytes() for r in ranges], pa.binary()),
                pa.array([b"" if ranks is None else ranks[row[r]].astype("u1").tobytes() for r in ranges], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["part", "slot", "stats", "x", "ranks"])

    def finish(group: pa.Table) -> pa.Table:
        level, _, first, tree, path, depth = plan.value
        work, p = level.work, group.column("part")[0].as_py()
        mine = slice(first[p], first[p + 1])
        slot, stats, x, ranks = (group.column(c).to_pylist() for c in ("slot", "stats", "x", "ranks"))
        kind = "<f8" if work.random_cuts else "u1"
        pairs = Pairs(
            np.concatenate([_wide(b) for b in slot]), np.concatenate([_unpacked_sums(b"\x01", b)[1] for b in stats]),
            np.frombuffer(b"".join(x), kind).reshape(-1, work.n_columns),
            np.frombuffer(b"".join(ranks), "u1").astype(np.int64) if work.kind == "ranks" else None,
        )
        grown = grow_here(work, tree[mine], path[mine], depth[mine], pairs)
        return _pieces([_piece(p, np.arange(first[p], first[p + 1]), grown, work.n_columns)])

    parts = int(part[-1]) + 1
    sent = rows.mapInArrow(send, "part int, slot binary, stats binary, x binary, ranks binary")
    found = sent.repartition(min(2 * parts, max(parallelism(spark), parts // 4)), "part").groupBy("part").applyInArrow(finish, PIECES)
    return Tails(node, part, found, plan)



# ---- levels --------------------------------------------------------------------------------------


def grow(table: Binned, rules: Sequence[Rules], gradients: Gradients | None = None, state_rows: DataFrame | None = None, weight_unit: float = 1.0) -> Trees:
    """Grow one tree for each of ``rules`` (all of one kind of criterion) at the same time.

    ``gradients`` gives first and second derivatives (for the criterion "second") or row weights
    (for classes) of a block as whole numbers of ``table.unit`` (``weight_unit``), a column a tree.
    """
    trees, tails = _grow(table, rules, gradients, state_rows, weight_unit)
    if tails is not None:
        found = tails.pieces.toArrow().to_pylist()
        tails.shared.destroy()
        pieces = [read_piece(r, trees.value.shape[1]) for r in found]
        if len(trees.feature) + sum(len(p.feature) for _, p in pieces) > 4 * NODE_BUDGET:
            raise ValueError(f"more than {4 * NODE_BUDGET} nodes: give max_depth or min_leaf")
        graft(trees, tails.places, pieces)
    return trees


def plant(table: Binned, rules: Sequence[Rules], path: str) -> tuple[Trees, Tails | None]:
    """``grow`` for trees of any number of nodes: the upper ones, and the rest as a table at ``path``."""
    trees, tails = _grow(table, rules, None, None, 1.0)
    if tails is not None:
        tails.pieces.write.parquet(path)
        tails.shared.destroy()
        tails = replace(tails, pieces=table.rows.sparkSession.read.schema(PIECES).parquet(path), shared=None)
    return trees, tails


def _grow(table: Binned, rules: Sequence[Rules], gradients: Gradients | None, state_rows: DataFrame | None, weight_unit: float) -> tuple[Trees, Tails | None]:
    """Trees as far as levels go, and what is below."""
    rows = table.rows if state_rows is None else state_rows
    sc = rows.sparkSession.sparkContext
    work = Work.of(table, rules, gradients, weight_unit)
    n, n_columns, kind, width = len(rules), table.n_columns, work.kind, work.width
    trees = Trees(n, width)
    if not n or not n_columns or not table.n_rows:
        return trees, None
    if _by_tree(table, rules, gradients, sc.defaultParallelism):
        return trees, _whole_trees(rows, work, n, table.n_rows)
    shared_work = sc.broadcast(work)
    node, tree, path, depth = np.arange(n), np.arange(n), np.ones(n, np.uint64), 0
    small: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(node):
        if len(trees.feature) + 2 * len(node) > 4 * NODE_BUDGET:
            raise ValueError(f"more than {4 * NODE_BUDGET} nodes: give max_depth or min_leaf")
        slot = np.full(len(trees.feature), -1, np.int32)
        slot[node] = np.arange(len(node))
        drawn = _drawn_columns(work, tree, path)
        plan = Plan(work, trees.bare(), slot, drawn)
        per_row = float(drawn.sum() / max(1, len(node)))
        cells = min(table.n_rows * n * per_row, len(node) * per_row * 256)
        parts = int(min(len(node), max(1, math.ceil(cells / CELLS_TOGETHER))))
        if work.random_cuts:
            plan.random = _draw_cuts(rows, sc.broadcast(plan), tree, path, parts)
        level, of_slots = sc.broadcast(plan), sc.broadcast(work.of_nodes(tree))
        span = n_columns * 256 * (256 if kind == "ranks" else 1)
        sums = _summed(rows, level, len(node), parts, span, _cells, add_up)
        found = _found(sums, shared_work, of_slots, width)
        level.destroy()
        of_slots.destroy()
        if not found.num_rows:
            break
        s = found.column("slot").to_numpy()
        sizes, pure, values = (
            np.stack([found.column(f"{c}{i}").to_numpy(zero_copy_only=False) for i in range(n_parts)], axis=1) for c, n_parts in (("n", 3), ("p", 3), ("v", 3 * width))
        )
        values = values.reshape(-1, 3, width)
        gain = found.column("gain").to_numpy()
        if depth == 0:
            trees.value[s], trees.size[s] = values[:, 0], sizes[:, 0]
        good = np.flatnonzero(np.isfinite(gain) & (work.numbers["depth"][tree[s]] > depth))
        good = good[np.argsort(s[good])]
        if not len(good):
            break
        s, sizes, pure, values, gain = s[good], sizes[good], pure[good], values[good], gain[good]
        column, bins = found.column("column").to_numpy()[good], found.column("bin").to_numpy()[good]
        ends = _upper_edges(table)
        cut = plan.random[s, column] if work.random_cuts else np.array([ends[c][b] for c, b in zip(column, bins, strict=True)])
        gap_left = found.column("gap_left").to_numpy(zero_copy_only=False)[good]
        children, tree, path, more = _children(work, trees, node, tree, path, s, column, cut, gap_left, gain, sizes, pure, values)
        depth += 1
        # Given weights don't tell how many rows a node has.
        few = more & (trees.size[children] <= LOCAL_ROWS) & (kind != "class" or gradients is None)
        small.append((children[few], tree[few], path[few]))
        node, tree, path = (a[more & ~few] for a in (children, tree, path))
    shared_work.destroy()
    found = [np.concatenate([v[i] for v in small]) for i in range(3)] if small else []
    return trees, _below(rows, work, trees, *found) if small and len(found[0]) else None


def _draw_cuts(rows: DataFrame, level, tree: np.ndarray, path: np.ndarray, parts: int) -> np.ndarray:
    """One cut for each slot and column, evenly between its least and greatest value there."""
    work = level.value.work
    n_columns = work.n_columns
    sums = _summed(rows, level, len(tree), parts, n_columns, _ranges, _least)

    def join(group: pa.Table) -> pa.Table:
        codes, values = _least(*_all_sums(group))
        return pa.table({"code": codes, "low": values[:, 0], "high": -values[:, 1]})

    found = sums.groupBy("part").applyInArrow(join, "code long, low double, high double").toArrow()
    level.destroy()
    code, low, high = (found.column(c).to_numpy() for c in ("code", "low", "high"))
    s, c = code // n_columns, code % n_columns
    u = cut_share(work.numbers["seed"][tree[s]], path[s], c.astype(np.uint64))
    out = np.full((len(tree), n_columns), -np.inf)
    out[s, c] = low + u * (high - low)
    return out
