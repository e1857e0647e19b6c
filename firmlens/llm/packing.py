"""Best-fit-decreasing packing of token ids into training windows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from firmlens.llm.tokens import encoder
from firmlens.session import settle

WINDOW = 2048
END_ID = 1
#: Rows that one task ranks at most, about.
RANKED_TOGETHER = 100_000


class OpenWindows:
    """Open windows by remaining capacity: runs of consecutive window numbers, and a segment tree
    over the capacities that tells the tightest one in use."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = [False] * (2 * self.leaves)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _mark(self, room: int) -> None:
        at = room + self.leaves
        self.tree[at] = bool(self.runs[room])
        while at > 1:
            at >>= 1
            self.tree[at] = self.tree[2 * at] or self.tree[2 * at + 1]

    def put(self, room: int, first: int, n: int) -> None:
        if n and room:
            self.runs[room].append((first, n))
            self._mark(room)

    def take(self, room: int) -> tuple[int, int]:
        run = self.runs[room].pop()
        self._mark(room)
        return run

    def tightest(self, size: int) -> int | None:
        """The least capacity in use that is at least ``size``."""
        at = size + self.leaves
        if self.tree[at]:
            return size
        while at > 1:
            if at % 2 == 0 and self.tree[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.tree[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


def best_fit_decreasing(counts: dict[int, int], capacity: int = WINDOW) -> np.ndarray:
    """Where the pieces of each size go, as rows (size, rank, window, each, offset).

    Piece number ``rank + j`` of a size lies in window ``window + j // each`` at
    ``offset + j % each * size``, up to the next row of the size. This is best fit decreasing piece by
    piece: pieces of one size that find the same tightest capacity are placed together, and windows
    with the same capacity left are equally full. The work and the result depend on the number of
    sizes (``capacity`` at most), not of pieces.
    """
    open_windows, windows, placed = OpenWindows(capacity), 0, []
    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            room = open_windows.tightest(size)
            if room is None:
                n = -(-left // (capacity // size))
                open_windows.put(capacity, windows, n)
                windows += n
                room = capacity
            first, n = open_windows.take(room)
            each = room // size
            full = min(n, left // each)
            rest = min(left - full * each, each - 1) if full < n else 0
            placed.append((size, rank, first, each, capacity - room))
            open_windows.put(room - each * size, first, full)
            if rest:
                open_windows.put(room - rest * size, first + full, 1)
            used = full + bool(rest)
            open_windows.put(room, first + used, n - used)
            rank += full * each + rest
            left -= full * each + rest
    return np.array(placed, np.int64).reshape(-1, 5)


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Each document's ids (``end_id`` last) cut into full windows and what is left: doc_id, start,
    length, ids_crc32, doc_tokens and, if asked for, ids. A null text is empty: its end alone."""
    names = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
    schema = pa.schema(names + [("ids", pa.binary())] * with_ids)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer)
        for batch in batches:
            out = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), words.with_end(batch.column("text"), end_id), strict=True):
                ids = ids.tobytes()
                for at in range(0, len(ids), 4 * window):
                    part = ids[at : at + 4 * window]
                    out.append((doc_id, at // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4, part)[: 5 + with_ids])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * len(schema), schema, strict=True)], schema=schema)

    out = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, out)


def _numbered(rows: DataFrame, largest: int) -> DataFrame:
    """``rank``: the number (from 0) of each piece among those of its length. A length is ranked in
    hash buckets of bounded size plus the sizes of the buckets before."""
    buckets = max(1, -(-largest // RANKED_TOGETHER))
    key = F.xxhash64("doc_id", "start", "ids_crc32")
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(9), key), F.lit(buckets)))
    sizes = dealt.groupBy("length", "bucket").count()
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "bucket").orderBy(key)
    return (
        dealt.withColumn("inside", F.row_number().over(inside) - 1)
        .join(bases, ["length", "bucket"])
        .withColumn("rank", F.col("base") + F.col("inside"))
        .drop("bucket", "base", "inside")
    )


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """``pieces`` with sequence_id and offset: every piece in one window, gapless from 0.

    Only the count of each length (``window`` rows at most) comes to the driver; the plan that goes
    back is of the same order. Repeated rows are packed as often as they come; an empty table gives
    no rows. Other columns of ``docs`` are not read.
    """
    cut = settle(pieces(docs, tokenizer, window, end_id, with_ids))
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    plan = best_fit_decreasing(counts, window)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    # One sorted key for (size, rank): ranks are below 2^51.
    keys = plan[:, 0] * (1 << 51) + plan[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        size = length.to_numpy()
        row = plan[np.searchsorted(keys, size * (1 << 51) + rank.to_numpy(), side="right") - 1]
        j = rank.to_numpy() - row[:, 1]
        return pd.DataFrame({"sequence_id": row[:, 2] + j // row[:, 3], "offset": row[:, 4] + j % row[:, 3] * size})

    ranked = _numbered(cut, max(counts.values(), default=0)).withColumn("at", place("length", "rank"))
    return ranked.select(*cut.columns, "at.sequence_id", "at.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The windows themselves from ``pack(..., with_ids=True)``: sequence_id, n_tokens and ids
    (little-endian unsigned 32-bit). A group is one window, so it is bounded."""
    part = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.aggregate(part, F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
    )
