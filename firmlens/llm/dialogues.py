"""The trie of conversation prefixes, encoded as balanced parentheses by shards of sorted conversations.

A conversation is a path of turns. Paths are sorted, so a shard's conversations are a walk through a
part of the trie: an opening bit where the walk goes down to a new node, a closing one where it
leaves it. ``findclose`` over a range min-max tree of the excess delimits each subtree; what lies in
it are differences of cumulative arrays: conversations, leaf pairs ``()`` and saved tokens.

Nodes that a shard may have in common with its neighbours lie on the paths of its first and last
conversations, the spines. They are told apart from the nodes a shard has alone, and what shards have
of them is summed by node. Paths are cut every ``SPAN`` turns, so a conversation of any length is many
short rows; a cut is a node that the row before ends at and the row after hangs from.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from firmlens.llm.common import rows
from firmlens.session import parallelism, settle

#: Turns that a conversation can lose to the start of its group, and the size of a group.
HEAD, GROUP = 9, 5
#: Turns of a path row.
SPAN = 64
#: Turns that a shard has, about.
SHARD_TURNS = 400_000
TURN_BYTES = 16
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

_ROOT = bytes(16)


# ---- conversations as paths ----------------------------------------------------------------------


def _first_turns(conv: Column) -> Column:
    """How many of its first turns a conversation has from its group's first one."""
    return (F.crc32(conv.cast("string").cast("binary")) % HEAD).cast("int")


def _placed(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, at, turn hash, bytes) and conversations (conv, n_turns).

    Turns are sorted in ranges of (conv, turn), equal ones by role and text, so a conversation that
    has a third of all turns lies in many ranges; a turn's place is its place in the range plus what
    earlier ranges have of its conversation.
    """
    empty = F.lit("")
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), empty).alias("role"), F.coalesce(F.col("text").cast("string"), empty).alias("text"),
    ).where("conv IS NOT NULL")
    # The last key parts the copies of one and the same turn; which of them goes first is all the same.
    keys = ["conv", F.asc_nulls_first("turn"), "role", "text", "copy"]
    turns = turns.withColumn("copy", F.monotonically_increasing_id())
    ranges = turns.repartitionByRange(parallelism(conversations.sparkSession), *keys).sortWithinPartitions(*keys)
    digest = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"))
    placed = settle(
        ranges.select("conv", F.unhex(digest).alias("hash"), F.octet_length("text").cast("long").alias("bytes"), F.monotonically_increasing_id().alias("id"))
    )
    placed = placed.withColumn("part", F.shiftright("id", 33))
    spans = placed.groupBy("conv", "part").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    # At most one row of a conversation a range.
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = settle(spans.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))))
    # By conversation and range, so that no key has more rows than a range.
    turns = placed.join(spans, ["conv", "part"]).select("conv", "part", (F.col("id") - F.col("first") + F.col("before")).alias("at"), "hash", "bytes")
    return turns, spans


def _rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv, at, hash, bytes) and the conversations left without any (conv)."""
    turns, spans = _placed(conversations)
    sizes = spans.groupBy("conv").agg(F.sum("n").alias("n_turns"))
    base = F.col("conv") - F.col("conv") % GROUP
    heads = sizes.select(F.col("conv").alias("base"), F.least("n_turns", F.lit(HEAD)).alias("n_base"))
    taken = sizes.withColumn("base", base).join(heads, "base", "left")
    taken = taken.select("conv", "base", "n_turns", _first_turns(F.col("conv")).alias("h"), F.coalesce("n_base", F.lit(0)).alias("n_base"))
    taken = settle(taken.withColumn("head", F.least("h", "n_base")))
    # A group's first conversation gives few turns to few others.
    given = turns.where(F.col("at") < HEAD).select(F.col("conv").alias("base"), "at", "hash", "bytes")
    given = taken.where("head > 0").select("conv", "base", "head").join(given, "base").where(F.col("at") < F.col("head"))
    shift = spans.join(taken, "conv").select("conv", "part", "h", (F.col("head") - F.col("h")).alias("shift"))
    own = turns.join(shift, ["conv", "part"]).where(F.col("at") >= F.col("h"))
    both = given.select("conv", "at", "hash", "bytes").unionByName(own.select("conv", (F.col("at") + F.col("shift")).alias("at"), "hash", "bytes"))
    bare = taken.where((F.col("head") == 0) & (F.col("n_turns") <= F.col("h"))).select("conv")
    return both, bare


def _path_rows(turns: DataFrame, bare: DataFrame, span: int = SPAN) -> DataFrame:
    """conv, layer, path (turn hashes in a row), bytes, above and below (keys of the nodes that the
    row hangs from and, if it is full, ends at), ends (whether the conversation ends with the row).

    The key of a cut is made of sums over the rows before it, each hashed with its place.
    """
    layer = F.floor(F.col("at") / span).cast("long")
    rows_ = turns.groupBy("conv", layer.alias("layer")).agg(F.sort_array(F.collect_list(F.struct("at", "hash", "bytes"))).alias("t"))
    rows_ = rows_.select("conv", "layer", F.aggregate("t", F.lit(b""), lambda a, x: F.concat(a, x["hash"])).alias("path"), F.col("t.bytes").alias("bytes"))
    rows_ = settle(rows_.unionByName(bare.select("conv", F.lit(0).cast("long").alias("layer"), F.lit(b"").alias("path"), F.array().cast("array<bigint>").alias("bytes"))))

    digest = F.md5(F.concat(F.col("layer").cast("string").cast("binary"), F.lit(b":"), "path"))

    def part(at: int) -> Column:
        return F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(38,0)")

    so_far = Window.partitionBy("conv").orderBy("layer").rowsBetween(Window.unboundedPreceding, 0)
    hashed = rows_.select("conv", "layer", part(1).alias("a"), part(16).alias("b"))
    sums = hashed.select(
        "conv", "layer", "a", "b", F.sum("a").over(so_far).alias("sa"), F.sum("b").over(so_far).alias("sb"),
        F.lead("layer").over(Window.partitionBy("conv").orderBy("layer")).isNull().alias("ends"),
    )

    def key(layer_: Column, a: Column, b: Column) -> Column:
        return F.when(layer_ == 0, F.lit(_ROOT)).otherwise(F.unhex(F.md5(F.concat_ws("|", layer_, a, b))))

    cuts = sums.select(
        "conv", "layer", "ends", key(F.col("layer"), F.col("sa") - F.col("a"), F.col("sb") - F.col("b")).alias("above"),
        key(F.col("layer") + 1, F.col("sa"), F.col("sb")).alias("below"),
    )
    return rows_.join(cuts, ["conv", "layer"])


# ---- balanced parentheses ------------------------------------------------------------------------


class Parentheses:
    """A row of balanced parentheses with the least excess of each block, of pairs of blocks, and so
    on up: a range min-max tree."""

    BLOCK = 64

    def __init__(self, bits: np.ndarray):
        self.bits = bits.astype(bool)
        self.opens = np.flatnonzero(self.bits)
        self.rank = np.cumsum(self.bits) - self.bits  # opening ones before each place
        self.excess = np.cumsum(np.where(self.bits, 1, -1)).astype(np.int64)
        size = max(1, -(-len(bits) // self.BLOCK))
        size = 1 << (size - 1).bit_length()
        padded = np.full(size * self.BLOCK, np.iinfo(np.int64).max)
        padded[: len(bits)] = self.excess
        self.levels = [padded.reshape(size, -1).min(axis=1)]
        while len(self.levels[-1]) > 1:
            self.levels.append(self.levels[-1].reshape(-1, 2).min(axis=1))
        self.padded = padded

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """The closing place of each opening one: the first after it whose excess is one less."""
        wanted = self.excess[at] - 1
        close = np.full(len(at), -1, np.int64)
        place, left = at + 1, np.arange(len(at))
        # In the rest of the own block.
        while len(left):
            here = self.padded[place] == wanted[left]
            close[left[here]] = place[here]
            stay = ~here
            left, place = left[stay], place[stay] + 1
            inside = place % self.BLOCK != 0
            self._beyond(close, left[~inside], place[~inside] // self.BLOCK, wanted)
            left, place = left[inside], place[inside]
        return close

    def _beyond(self, close: np.ndarray, left: np.ndarray, block: np.ndarray, wanted: np.ndarray) -> None:
        """For searches that reach the start of a block: up to the first range that dips low enough,
        down to its first block, and through it."""
        if not len(left):
            return
        want, level, node = wanted[left], np.zeros(len(left), np.int64), block.copy()
        done = self._least(level, node) <= want
        while not done.all():
            up = ~done
            # The next range to the right: a sibling, or the parent's one.
            odd = up & (node % 2 == 1)
            node[odd] = (node[odd] + 1) // 2
            level[odd] += 1
            even = up & ~odd
            node[even] += 1
            done[up] = self._least(level[up], node[up]) <= want[up]
        while (level > 0).any():
            down = level > 0
            node[down] *= 2
            level[down] -= 1
            far = down & (self._least(level, node) > want)
            node[far] += 1
        block_rows = self.padded.reshape(-1, self.BLOCK)
        for first in range(0, len(left), 1 << 14):
            some = slice(first, first + (1 << 14))
            inside = (block_rows[node[some]] == want[some, None]).argmax(axis=1)
            close[left[some]] = node[some] * self.BLOCK + inside

    def _least(self, level: np.ndarray, node: np.ndarray) -> np.ndarray:
        out = np.empty(len(level), np.int64)
        for l in np.unique(level):
            at = level == l
            out[at] = self.levels[l][node[at]]
        return out


class Shard:
    """The walk through one shard's sorted path rows, and what it knows of every node in it.

    ``own`` tells the nodes that no other shard has: not on the first or the last row's path (of a
    forest: those of each root), not a root and not a cut.
    """

    def __init__(self, table: pa.Table, span: int):
        convs = table.column("conv").to_numpy()
        above, below = table.column("above").to_pylist(), table.column("below").to_pylist()
        paths = table.column("path").to_pylist()
        sizes = [len(p) // TURN_BYTES for p in paths]
        bytes_ = table.column("bytes").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        starts = np.cumsum(sizes) - sizes
        bits: list[int] = []
        depth, parent, at_bytes, keys, row, last, layers = [], [], [], [], [], [], []
        stack: list[int] = []
        before_root, before_path = None, b""
        layer = table.column("layer").to_numpy()
        cut = []
        for r, (root, path, size) in enumerate(zip(above, paths, sizes, strict=True)):
            if root != before_root:
                bits += [0] * len(stack)
                stack = [len(depth)]
                bits.append(1)
                depth.append(0), parent.append(-1), at_bytes.append(0), keys.append(root), row.append(r), layers.append(layer[r]), cut.append(True)
                shared = 0
            else:
                shared = _shared(before_path, path)
                bits += [0] * (len(stack) - 1 - shared)
                del stack[shared + 1 :]
            for d in range(shared + 1, size + 1):
                bits.append(1)
                full = d == span
                keys.append(below[r] if full else xxhash.xxh3_128_digest(root + path[: d * TURN_BYTES]))
                depth.append(d), parent.append(stack[-1]), at_bytes.append(bytes_[starts[r] + d - 1]), row.append(r), layers.append(layer[r]), cut.append(full)
                stack.append(len(depth) - 1)
            last.append(stack[-1])
            before_root, before_path = root, path
        bits += [0] * len(stack)
        self.tree = Parentheses(np.array(bits, np.int8))
        self.depth, self.parent, self.keys, self.layer = np.array(depth), np.array(parent), keys, np.array(layers, np.int64)
        self.bytes = np.array(at_bytes, np.int64)
        # A node's subtree is the nodes from it to its closing place, its conversations the rows from
        # the one that opened it to the last that ended in it.
        opens = self.tree.opens
        self.close = self.tree.findclose(opens)
        self.after = self.tree.rank[self.close]
        self.first_row = np.array(row)
        self.end_node = np.array(last)
        ended = np.cumsum(np.bincount(self.end_node, minlength=len(depth)))
        self.n_convs = self._between(ended)
        # Least conversation of consecutive rows, for all nodes at once.
        places = np.stack([self.first_row, self.first_row + self.n_convs], axis=1).ravel()
        self.conv = np.minimum.reduceat(np.append(convs, np.iinfo(np.int64).max), places)[::2]
        self.convs, self.ends = convs, table.column("ends").to_numpy(zero_copy_only=False)
        self.n_children = np.bincount(self.parent[self.parent >= 0], minlength=len(depth))
        own = ~np.array(cut)
        for edge in (self.end_node[0], self.end_node[-1]):
            while edge >= 0:
                own[edge] = False
                edge = self.parent[edge]
        self.own = own
        # Leaf pairs and savings of own nodes, up to each node in the order of opening.
        leaf = np.zeros(len(depth), bool)
        leaf[:] = ~self.tree.bits[opens + 1]
        self.n_leaves = self._between(np.cumsum(leaf & own))
        self.saved = self._between(np.cumsum((self.n_convs - 1) * self.bytes * own))
        self.own_children = np.bincount(self.parent[own], minlength=len(depth)) if len(depth) else np.zeros(0, np.int64)

    def _between(self, cumulated: np.ndarray) -> np.ndarray:
        """Sums over each subtree, from sums over all nodes up to one."""
        whole = np.concatenate([[0], cumulated])
        return whole[self.after] - whole[np.arange(len(self.after))]


def _shared(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common at their start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // TURN_BYTES
    at = 0
    while a[at : at + TURN_BYTES] == b[at : at + TURN_BYTES]:
        at += TURN_BYTES
    return at // TURN_BYTES


NODE = (
    "key binary, parent_key binary, shard int, own boolean, root boolean, layer long, depth long, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved long, bytes long, ends_sha256 string, ends array<struct<first:bigint,ids:string>>, spine array<binary>"
)
IDS_IN_PART = 4096


def _shards(paths: DataFrame, span: int) -> DataFrame:
    """Every node of every shard. ``own`` ones are whole; the others have what the shard knows:
    sums over the shard's own nodes below, conversation ids in parts, and the keys of the nodes
    above (``spine``) up to the root of the row."""
    n_turns = paths.agg(F.sum(F.size("bytes") + 1)).first()[0] or 0
    shards = max(parallelism(paths.sparkSession), -(-n_turns // SHARD_TURNS))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in rows(batches)]
        if not held:
            return
        number = TaskContext.get().partitionId()
        shard = Shard(pa.Table.from_batches(held), span)
        del held
        ending = np.flatnonzero(shard.ends)
        at_node = shard.end_node[ending]
        ids = shard.convs[ending]
        starts = np.searchsorted(at_node, np.arange(len(shard.depth)), side="left")
        stops = np.searchsorted(at_node, np.arange(len(shard.depth)), side="right")
        for first in range(0, len(shard.depth), 1 << 13):
            out = []
            for v in range(first, min(first + (1 << 13), len(shard.depth))):
                own, up = bool(shard.own[v]), int(shard.parent[v])
                whole, parts, spine = None, None, None
                mine = ids[starts[v] : stops[v]].tolist()
                if own:
                    whole = hashlib.sha256(",".join(map(str, mine)).encode()).hexdigest() if mine else EMPTY_SHA256
                else:
                    parts = [{"first": mine[i], "ids": ",".join(map(str, mine[i : i + IDS_IN_PART]))} for i in range(0, len(mine), IDS_IN_PART)]
                    spine, w = [], up
                    while w >= 0:
                        spine.append(shard.keys[w])
                        w = int(shard.parent[w])
                root = up < 0
                out.append((
                    shard.keys[v], None if up < 0 else shard.keys[up], number, own, root, int(shard.layer[v]), int(shard.depth[v] + shard.layer[v] * span),
                    int(shard.conv[v]), int(shard.conv[up]) if up >= 0 and shard.own[up] else None, int(shard.n_convs[v]),
                    int(shard.n_children[v] if own else shard.own_children[v]), int(shard.n_leaves[v]), int(shard.saved[v]), int(shard.bytes[v]), whole, parts, spine,
                ))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _ARROW, strict=True)], schema=_ARROW)

    keys = ["layer", "above", "path", "conv"]
    ranges = paths.repartitionByRange(shards, *keys).sortWithinPartitions(*keys)
    return ranges.select("conv", "layer", "path", "bytes", "above", "below", "ends").mapInArrow(encode, NODE)


_ARROW = pa.schema(
    [
        ("key", pa.binary()), ("parent_key", pa.binary()), ("shard", pa.int32()), ("own", pa.bool_()), ("root", pa.bool_()),
        *((n, pa.int64()) for n in ("layer", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "bytes")),
        ("ends_sha256", pa.string()), ("ends", pa.list_(pa.struct([("first", pa.int64()), ("ids", pa.string())]))), ("spine", pa.list_(pa.binary())),
    ]
)


def _ends(parts: DataFrame) -> DataFrame:
    """key and SHA-256 of all ids of a shared node, which arrive in order and are not held."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in rows(batches):
            keys, sums = [], []
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if key != at:
                    if at is not None:
                        keys.append(at)
                        sums.append(state.hexdigest())
                    at, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sums, pa.string())], ["key", "sha"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["key", "sha"])

    ordered = parts.repartition(parallelism(parts.sparkSession), "key").sortWithinPartitions("key", "first")
    return ordered.select("key", "ids").mapInArrow(digest, "key binary, sha string")


def _merged(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The shared nodes, each once, with the sums that shards have below them; and for every node
    (key) what the shared nodes below it in its layer are themselves: leaves and savings."""
    parts = nodes.where("NOT own")
    # A root of a deeper layer is the cut of the layer above again; only what lies below it is new.
    in_row = ~F.col("root") | (F.col("layer") == 0)

    def of_rows(c: str) -> Column:
        return F.when(in_row, F.col(c))

    def of_roots(c: str) -> Column:
        return F.when(~in_row, F.col(c))

    found = settle(
        parts.groupBy("key").agg(
            F.max(of_rows("depth")).alias("depth"), F.max(of_rows("parent_key")).alias("parent_key"), F.min(of_rows("conv_id")).alias("conv_id"),
            F.max(of_rows("parent_conv_id")).alias("parent_conv_id"), F.sum(of_rows("n_convs")).alias("n_convs"), F.max(of_rows("bytes")).alias("bytes"), F.sum("n_children").alias("own_children"),
            F.sum(of_rows("n_leaves")).alias("n_leaves"), F.sum(of_rows("saved")).alias("saved"), F.first(of_rows("spine"), ignorenulls=True).alias("spine"),
            F.sum(of_roots("n_leaves")).alias("under_leaves"), F.sum(of_roots("saved")).alias("under_saved"), F.min(of_roots("conv_id")).alias("under_conv"),
        )
    )
    children = found.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("shared_children"))
    found = found.join(children, "key", "left").withColumn("n_children", F.col("own_children") + F.coalesce("shared_children", F.lit(0)))
    found = found.withColumn("leaf", (F.col("n_children") == 0).cast("long")).withColumn("weight", (F.col("n_convs") - 1) * F.col("bytes"))
    found = settle(found)
    # The keys above a node, up to its row's root; for a deeper layer that is a cut.
    above = found.select(F.posexplode("spine").alias("place", "key"), "leaf", "weight", F.size("spine").alias("up"), "depth")
    at_cut = (F.col("place") == F.col("up") - 1) & (F.col("depth") > F.col("up"))
    zero = F.lit(0)
    sums = settle(
        above.groupBy("key").agg(
            F.sum(F.when(at_cut, zero).otherwise(F.col("leaf"))).alias("leaves"), F.sum(F.when(at_cut, zero).otherwise(F.col("weight"))).alias("saved"),
            F.sum(F.when(at_cut, F.col("leaf")).otherwise(zero)).alias("cut_leaves"), F.sum(F.when(at_cut, F.col("weight")).otherwise(zero)).alias("cut_saved"),
        )
    )
    under = sums.select("key", "cut_leaves", "cut_saved")
    shared = found.join(under, "key", "left").select(
        "key", "depth", "parent_key", "conv_id", "parent_conv_id", "n_convs", "n_children", "under_conv",
        (F.col("n_leaves") + F.col("leaf")).alias("n_leaves"), (F.col("saved") + F.col("weight")).alias("saved"),
        (F.col("under_leaves") + F.coalesce("cut_leaves", zero)).alias("under_leaves"),
        (F.col("under_saved") + F.coalesce("cut_saved", zero)).alias("under_saved"),
    )
    return shared, sums.select("key", "leaves", "saved")


def _below_cuts(paths: DataFrame, shared: DataFrame, span: int) -> DataFrame:
    """key, leaves, saved: what nodes have below the cuts under them.

    What hangs from a cut in its layer is credited to the least conversation that goes on there, whose
    rows pass through all nodes above: on each row, what it is credited with in later rows.
    """
    credit = shared.where("under_conv IS NOT NULL").select(F.col("key").alias("above"), F.col("under_conv").alias("conv"), "under_leaves", "under_saved")
    later = Window.partitionBy("conv").orderBy(F.desc("layer")).rowsBetween(Window.unboundedPreceding, -1)
    long_ones = paths.where("layer > 0").select("conv").distinct()
    credited = paths.join(long_ones, "conv", "left_semi").select("conv", "layer", "above").join(credit, ["above", "conv"], "left")
    credited = credited.select(
        "conv", "layer", F.sum("under_leaves").over(later).alias("leaves"), F.sum("under_saved").over(later).alias("saved")
    ).where("leaves > 0 OR saved > 0")

    @F.pandas_udf("array<binary>")
    def keys_of(path: pd.Series, above: pd.Series, below: pd.Series) -> pd.Series:
        out = []
        for p, a, b in zip(path, above, below, strict=True):
            n = len(p) // TURN_BYTES
            top = [a] if a == _ROOT else []  # a deeper root is the cut that the row above ends at
            out.append(top + [b if d == span else xxhash.xxh3_128_digest(a + p[: d * TURN_BYTES]) for d in range(1, n + 1)])
        return pd.Series(out)

    on_path = paths.join(credited, ["conv", "layer"]).select(F.explode(keys_of("path", "above", "below")).alias("key"), "leaves", F.col("saved").alias("s"))
    return on_path.groupBy("key").agg(F.sum("leaves").alias("leaves"), F.sum("s").alias("saved"))


def prefix_trie(conversations: DataFrame, span: int = SPAN) -> DataFrame:
    """One row for every node of the trie of rebuilt conversations (conv_id, turn, role, text).

    Turns are ordered by turn (null first), then by role and text; a null role or text is empty.
    Each conversation takes its first turns from its group's first conversation, as many as its id's
    hash says. Rows without a conv_id take no part, repeated rows are turns of their own, other
    columns are not read, and an empty table gives no rows, not even the root.
    """
    turns, bare = _rebuilt(conversations)
    paths = settle(_path_rows(turns, bare, span))
    nodes = settle(_shards(paths, span))
    shared, in_layer = _merged(nodes)
    shared = settle(shared)
    below = in_layer.unionByName(_below_cuts(paths, shared, span)).groupBy("key").agg(F.sum("leaves").alias("below_leaves"), F.sum("saved").alias("below_saved"))
    sha = _ends(nodes.where("NOT own AND size(ends) > 0").select("key", F.explode("ends").alias("e")).select("key", "e.first", "e.ids"))
    # Children of a shared node find it by shard as well: no key has more rows than a shard.
    names = shared.select("key", F.col("conv_id").alias("up"))
    seen = nodes.where("NOT own").select("shard", "key").distinct().join(names, "key").withColumnRenamed("key", "parent_key")
    own = nodes.where("own").join(seen, ["shard", "parent_key"], "left").select(
        "key", "conv_id", "depth", F.coalesce("parent_conv_id", "up").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved", "ends_sha256"
    )
    joint = shared.join(names.withColumnRenamed("key", "parent_key"), "parent_key", "left").join(sha, "key", "left").select(
        "key", "conv_id", "depth", F.coalesce("parent_conv_id", "up").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved",
        F.coalesce("sha", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
    zero = F.lit(0)
    return own.unionByName(joint).join(below, "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", (F.col("n_leaves") + F.coalesce("below_leaves", zero)).cast("long").alias("n_leaves"),
        (F.col("saved") + F.coalesce("below_saved", zero)).cast("long").alias("saved_tokens"), "ends_sha256",
    )
