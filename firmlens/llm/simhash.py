"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from firmlens.llm.common import unused
from firmlens.llm.graph import components
from firmlens.session import settle

SHINGLE_WORDS = 3
MAX_BITS = 2
BITS = 64
SEED = 42
#: Shingles whose bits are summed at once; bounds memory for very long texts.
SHINGLES_AT_ONCE = 1 << 15


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64 bits of a text as a signed integer. Only A-Z are lower-cased and only ASCII white
    space parts words. A text without words has 0; one with fewer words than a shingle has one
    shingle of them all."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        starts, ends = [0], [len(joined)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        stop = np.cumsum(lengths + 1) - 1
        starts = (stop - lengths)[: len(words) - shingle_words + 1].tolist()
        ends = stop[shingle_words - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)), np.uint64, len(starts)
    )
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), SHINGLES_AT_ONCE):
        part = hashes[at : at + SHINGLES_AT_ONCE].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(set_bits.view("<i8")[0])


def fingerprints(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    @F.pandas_udf("long")
    def run(part: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle_words) for t in part], dtype="int64")

    return run(text)


def _masks(radius: int) -> list[tuple[int, int]]:
    """(mask, set bits) of every pattern of at most ``radius`` bits, as signed integers."""
    found = []
    for n in range(radius + 1):
        for bits in combinations(range(BITS), n):
            mask = sum(1 << b for b in bits)
            found.append((mask - (1 << BITS) if mask >> (BITS - 1) else mask, n))
    return found


def links(values: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Verified links (u, v) between the distinct fingerprints ``fp`` that keep every connection.

    Each fingerprint goes to all values within half the distance. Two that differ by at most
    ``max_bits`` meet at a value in the middle: one at most ``max_bits // 2`` bits away (the core of
    that value), the other at most the rest. Everything that meets at a value is close enough to
    each core member, so a meeting is kept as a star around its least core member, not as all its
    pairs; a value meets as many fingerprints as its ball has values, never more.
    """
    core = max_bits // 2
    reach = max_bits - core
    masks = F.array(*(F.struct(F.lit(m).cast("long").alias("m"), F.lit(n).alias("n")) for m, n in _masks(reach)))
    spread = values.select("fp", F.explode(masks).alias("x")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("x.m")).alias("at"), F.col("x.n").alias("n")
    )
    least = F.min(F.when(F.col("n") <= core, F.col("fp"))).over(Window.partitionBy("at"))
    met = spread.withColumn("center", least).where("center is not null and center <> fp")
    return (
        met.select(F.col("center").alias("u"), F.col("fp").alias("v"))
        .distinct()
        .where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits)
    )


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) of every row of ``docs`` (doc_id, text).

    ``root`` is the least fingerprint of the component and names it even if it has no doc_id.
    ``component_id`` is the smallest doc_id reachable over links of at most ``max_bits`` bits.
    Exact copies share a fingerprint, so they are one node of the graph however many there are.
    Null and empty texts have fingerprint zero and link like any other. A repeated row is returned
    as often as it comes. A null doc_id is never the smallest; a group of nothing else has a null
    component. Other columns of ``docs`` are not read; an empty table gives no rows.
    """
    marked = settle(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.xxhash64("text").alias("text_hash"),
            fingerprints(F.col("text"), shingle_words).alias("fp"),
        )
    )
    classes = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(classes.select("fp"), max_bits))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    rooted = settle(rooted)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "root", "component_id")
    return marked.join(named, "fp", "left").select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_one(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """The rows of ``docs``, with all their columns, without the near-copies: of each group the row
    of the smallest doc_id stays (a null doc_id comes last, equal ones are told apart by the hash of
    the text, and of wholly equal rows one stays)."""
    key = F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col("text_hash").alias("h"))
    best = near_duplicates(docs, shingle_words, max_bits).groupBy("root").agg(F.min(key).alias("k"))
    kept_id, kept_hash = unused(docs, "kept_id"), unused(docs, "kept_hash")
    picked = settle(best.select(F.col("k.id").alias(kept_id), F.col("k.h").alias(kept_hash)))
    same_row = docs["doc_id"].cast("long").eqNullSafe(picked[kept_id]) & (
        F.xxhash64(docs["text"]) == picked[kept_hash]
    )
    kept = docs.join(picked, same_row, "left_semi")
    # Wholly equal rows are rare; only if there are any are the kept rows told apart again.
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"))
    if narrow.groupBy("doc_id", "h").count().where("count > 1").isEmpty():
        return kept
    return kept.dropDuplicates(["doc_id", "text"])
