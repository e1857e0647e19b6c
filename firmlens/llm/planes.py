"""Token ids in files of compressed byte or bit planes.

A data set is a folder of Parquet tables that Spark's writer commits, so it works in every store
that Spark reaches and a lost executor leaves no half-written file:

* ``chunks``: one row per block of ``block_ids`` consecutive ids of a shard: ``shard, block, first``
  (ids of the shard before it), ``n``, ``mode`` (``byte`` or ``bit``), ``planes`` (each a zstandard
  frame; trailing planes of zeros are left out) and ``docs``, the pieces of documents in the block.
* ``index``: one row per chunk: ``shard, block, start`` (ids of all shards before it), ``n, bytes``
  (of each plane) and the first and last document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from firmlens.llm.tokens import encoder
from firmlens.session import parallelism, settle

BLOCK_IDS = 1 << 16
END_ID = 1
LEVEL = 3
DOC = "struct<doc_id:bigint,number:bigint,at:int,length:int,offset:bigint,tokens:bigint>"
CHUNK = f"shard int, block int, first long, n int, mode string, planes array<binary>, docs array<{DOC}>"


def to_planes(ids: np.ndarray, mode: str = "byte", level: int = LEVEL) -> list[bytes]:
    """Compressed planes of unsigned 32-bit ids, lowest byte (bit) first, up to the last one in use."""
    table = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if mode == "bit":
        table = np.unpackbits(table, axis=1, bitorder="little")
    used = int(ids.max()).bit_length() if len(ids) else 0
    planes = np.ascontiguousarray(table.T[: used if mode == "bit" else -(-used // 8)])
    if mode == "bit":
        planes = np.packbits(planes, axis=1, bitorder="little")
    return [zstandard.ZstdCompressor(level=level).compress(p.tobytes()) for p in planes]


def from_planes(planes: list[bytes], n: int, mode: str = "byte") -> np.ndarray:
    size = -(-n // 8) if mode == "bit" else n
    unpack = zstandard.ZstdDecompressor().decompress
    flat = [np.frombuffer(unpack(p, max_output_size=max(1, size)), np.uint8) for p in planes]
    table = np.zeros((n, 4), np.uint8)
    if mode == "bit" and flat:
        bits = np.zeros((n, 32), np.uint8)
        bits[:, : len(flat)] = np.unpackbits(np.stack(flat), axis=1, bitorder="little", count=n).T
        table = np.packbits(bits, axis=1, bitorder="little")
    elif flat:
        table[:, : len(flat)] = np.stack(flat).T
    return table.view("<u4").ravel()


class _Shard:
    """Cuts a row of documents into blocks."""

    def __init__(self, shard: int, block_ids: int, mode: str):
        self.shard, self.size, self.mode = shard, block_ids, mode
        self.block, self.number, self.held, self.parts, self.docs = 0, 0, 0, [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[dict]:
        offset = 0
        while offset < len(ids):
            part = ids[offset : offset + self.size - self.held]
            self.docs.append(
                {"doc_id": doc_id, "number": self.number, "at": self.held, "length": len(part), "offset": offset, "tokens": len(ids)}
            )
            self.parts.append(part)
            offset += len(part)
            self.held += len(part)
            if self.held == self.size:
                yield self.chunk()
        self.number += 1

    def chunk(self) -> dict:
        row = {
            "shard": self.shard, "block": self.block, "first": self.block * self.size, "n": self.held, "mode": self.mode,
            "planes": to_planes(np.concatenate(self.parts), self.mode), "docs": self.docs,
        }
        self.block, self.held, self.parts, self.docs = self.block + 1, 0, [], []
        return row


def write(
    docs: DataFrame, path: str, tokenizer: str, mode: str = "byte", block_ids: int = BLOCK_IDS, end_id: int = END_ID
) -> None:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order and write the data set below ``path``.

    Rows are dealt by ranges of doc_id (equal ones by the hash of the text), so shards follow each
    other and a doc_id on very many rows is spread; a null doc_id comes first, a null text is empty.
    Every document ends with ``end_id``. Shard-relative places need no count beforehand; the index
    adds what came in earlier shards.
    """
    spark = docs.sparkSession

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer)
        shard = _Shard(TaskContext.get().partitionId(), block_ids, mode)
        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), words.with_end(batch.column("text"), end_id), strict=True):
                for row in shard.add(doc_id, ids):
                    yield pa.RecordBatch.from_pylist([row], schema)
        if shard.held:
            yield pa.RecordBatch.from_pylist([shard.chunk()], schema)

    doc = pa.struct(
        [("doc_id", pa.int64()), ("number", pa.int64()), ("at", pa.int32()), ("length", pa.int32()), ("offset", pa.int64()), ("tokens", pa.int64())]
    )
    schema = pa.schema(
        [("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n", pa.int32()), ("mode", pa.string()), ("planes", pa.list_(pa.binary())), ("docs", pa.list_(doc))]
    )
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
        .repartitionByRange(parallelism(spark), "doc_id", "h")
        .sortWithinPartitions("doc_id", "h")
        .select("doc_id", "text")
    )
    # The planes are compressed already.
    ordered.mapInArrow(encode, CHUNK).write.option("compression", "uncompressed").parquet(f"{path}/chunks")
    chunks = spark.read.parquet(f"{path}/chunks")
    index = chunks.join(_bases(chunks), "shard").select(
        "shard", "block", (F.col("base") + F.col("first")).alias("start"), "n",
        F.transform("planes", F.length).alias("bytes"),
        F.col("docs")[0]["doc_id"].alias("first_doc"), F.element_at("docs", -1)["doc_id"].alias("last_doc"),
    )
    index.write.parquet(f"{path}/index")


def _bases(chunks: DataFrame) -> DataFrame:
    """Ids in all earlier shards; one row per shard, so at most as many as the writer had tasks."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return chunks.groupBy("shard").agg(F.sum("n").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )


def _pieces(spark: SparkSession, path: str, columns: dict[str, tuple[pa.DataType, str]], of) -> DataFrame:
    """The pieces of documents in each chunk, with ``columns`` made by ``of`` from a piece's ids."""
    names = {"shard": pa.int32(), "number": pa.int64(), "doc_id": pa.int64(), "offset": pa.int64(), "tokens": pa.int64(), "first": pa.int64()}
    schema = pa.schema([*names.items(), *((n, t) for n, (t, _) in columns.items())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = from_planes(row["planes"], row["n"], row["mode"])
                docs = row["docs"]
                fixed = [
                    [row["shard"]] * len(docs), [d["number"] for d in docs], [d["doc_id"] for d in docs], [d["offset"] for d in docs],
                    [d["tokens"] for d in docs], [row["first"] + d["at"] - d["offset"] for d in docs],
                ]
                made = zip(*(of(ids[d["at"] : d["at"] + d["length"]].tobytes()) for d in docs), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([*fixed, *made], schema, strict=True)], schema=schema)

    out = "shard int, number long, doc_id long, offset long, tokens long, first long"
    return spark.read.parquet(f"{path}/chunks").mapInArrow(decode, ", ".join([out, *(f"{n} {t}" for n, (_, t) in columns.items())]))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The pieces of documents in each chunk: shard, number (of the document in its shard), doc_id,
    offset (in the document), tokens (of the document), first (the document's start in the shard)
    and ids (little-endian unsigned 32-bit)."""
    return _pieces(spark, path, {"ids": (pa.binary(), "binary")}, lambda ids: (ids,))


def join_crc32(before: int, after: int, length: int) -> int:
    """crc32 of two texts in a row, from their own and the second one's length in bytes."""
    zeros = bytes(length)
    return zlib.crc32(zeros, before) ^ zlib.crc32(zeros) ^ after


def digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens and the
    crc32 of its ids. Only documents that lie in several chunks are grouped, by their pieces' crc32."""

    @F.pandas_udf("long")
    def joined(parts: pd.Series) -> pd.Series:
        out = []
        for pieces_of_one in parts:
            crc = None
            for p in pieces_of_one:
                crc = p["crc"] if crc is None else join_crc32(crc, p["crc"], p["size"])
            out.append(crc)
        return pd.Series(out, dtype="int64")

    digest = {"crc": (pa.int64(), "long"), "size": (pa.int64(), "long")}
    pieces = settle(_pieces(spark, path, digest, lambda ids: (zlib.crc32(ids), len(ids))))
    whole = F.col("size") == 4 * F.col("tokens")
    kept = ["doc_id", "tokens", "shard", "first", "crc"]
    # A document has as many pieces as chunks that it reaches into.
    parts = F.sort_array(F.collect_list(F.struct("offset", "crc", "size")))
    cut = pieces.where(~whole).groupBy("shard", "number").agg(
        F.first("doc_id").alias("doc_id"), F.first("tokens").alias("tokens"), F.min("first").alias("first"), parts.alias("parts")
    )
    cut = cut.select("doc_id", "tokens", "shard", "first", joined("parts").alias("crc"))
    sizes = pieces.select("shard", F.expr("size div 4").alias("n"))
    return (
        pieces.where(whole).select(*kept).unionByName(cut)
        .join(_bases(sizes), "shard")
        .select("doc_id", (F.col("base") + F.col("first")).alias("start"), F.col("tokens").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
    )
