"""Benchmark decontamination by winnowing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from firmlens.llm.common import texts, unused
from firmlens.session import settle

#: Every shared span of this many words is found.
WINDOW_WORDS = 13
GRAM_WORDS = 8
#: 64-bit words of the membership filter that goes to all tasks (2 MB).
FILTER_WORDS = 1 << 18
#: A document is contaminated if at least one word in this many is hit.
CONTAMINATED_SHARE = 20

_OTHER = bytes(b for b in range(128) if not (48 <= b <= 57 or 97 <= b <= 122))
_TO_SPACE = bytes.maketrans(_OTHER, b" " * len(_OTHER))
_PRIME = np.uint64(0x9E3779B97F4A7C15)
OUT = "doc_id long, text_hash long, n_words long, grams array<struct<n:int,h:bigint,at:bigint,left:array<string>,right:array<string>>>"


def split_words(text: str | None) -> list[bytes]:
    """Runs of digits, letters and anything beyond ASCII, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_TO_SPACE).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter(map(digest, words), np.uint64, len(words))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` words; runs of other lengths hash apart."""
    count = len(hashes) - n + 1
    if count <= 0:
        return hashes[:0]
    total = np.full(count, n, np.uint64)
    for i in range(n):
        total = total * _PRIME + hashes[i : i + count]
    total ^= total >> np.uint64(29)
    return total * _PRIME


def winnowed(grams: np.ndarray, width: int) -> np.ndarray:
    """Places whose hash is the least of some window of ``width`` hashes in a row (all that tie).

    What is kept of a window depends on nothing outside it, so two texts that share the words of a
    whole window keep the same places in it.
    """
    windows = len(grams) - width + 1
    if windows <= 0:
        return np.zeros(0, np.int64)
    least = grams[:windows].copy()
    for i in range(1, width):
        np.minimum(least, grams[i : i + windows], out=least)
    kept = np.zeros(len(grams), bool)
    for i in range(width):
        kept[i : i + windows] |= grams[i : i + windows] == least
    return np.flatnonzero(kept)


def _places(hashes: np.ndarray, n: int, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Kept places and their hashes for spans of ``n`` words: winnowed grams for whole windows, every
    run of ``n`` words for an item that is shorter than a window."""
    grams = gram_hashes(hashes, gram if n == window else n)
    at = winnowed(grams, n - gram + 1) if n == window else np.arange(len(grams))
    return at, grams[at]


def _slots(hashes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    return (hashes >> np.uint64(6)) % np.uint64(words), np.uint64(1) << (hashes & np.uint64(63))


def _emit(keys: list[str], window: int, gram: int, lengths: list[int] | None, member: np.ndarray | None):
    """Words, and the kept grams with the words around them that a window with the gram can have.

    ``lengths``: of the spans to look for; None for items, whose own length decides. ``member``: the
    filter of the hashes that can match at all; None keeps everything.
    """
    gram_type = pa.struct([("n", pa.int32()), ("h", pa.int64()), ("at", pa.int64()), ("left", pa.list_(pa.string())), ("right", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found = [], []
            for text in texts(batch):
                words = split_words(text)
                hashes, grams = word_hashes(words), []
                spans = lengths if lengths is not None else [min(window, len(words))] * bool(words)
                for n in spans:
                    at, h = _places(hashes, n, window, gram)
                    if member is not None and len(h):
                        slot, bit = _slots(h, len(member))
                        hit = (member[slot] & bit) != 0
                        at, h = at[hit], h[hit]
                    size, around = (gram, window - gram) if n == window else (n, 0)
                    for a, x in zip(at.tolist(), h.view(np.int64).tolist(), strict=True):
                        grams.append(
                            {
                                "n": n, "h": x, "at": a,
                                # Nearest first, so that equal words are counted from the front.
                                "left": [w.decode() for w in words[max(0, a - around) : a][::-1]],
                                "right": [w.decode() for w in words[a : a + size + around]],
                            }
                        )
                counts.append(len(words))
                found.append(grams)
            arrays = [batch.column(k) for k in keys]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(counts, pa.int64()), pa.array(found, pa.list_(gram_type))], [*keys, "n_words", "grams"]
            )

    return run


def _member_filter(hashes: DataFrame, words: int) -> np.ndarray:
    """Bits of all hashes, in a table of fixed size: at most ``words`` rows come to the driver."""
    unsigned = F.shiftrightunsigned("h", 6)
    slots = hashes.groupBy(F.pmod(unsigned, F.lit(words)).alias("slot")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("h").bitwiseAND(F.lit(63)).cast("int"))).alias("bits")
    )
    member = np.zeros(words, np.uint64)
    for row in slots.toLocalIterator():
        member[row["slot"]] = np.uint64(row["bits"] % (1 << 64))
    return member


def _equal(a: str, b: str):
    """How many words agree from the front of two arrays."""
    pairs = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y) & x.isNotNull())
    return F.coalesce(F.nullif(F.array_position(pairs, F.lit(False)), F.lit(0)) - 1, F.size(pairs).cast("long"))


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS, gram: int = GRAM_WORDS) -> tuple[DataFrame, DataFrame]:
    """Documents with their counts of words, and the spans of them that occur in items.

    First: doc_id, text_hash, n_words, one row per row of ``docs``. Second: doc_id, text_hash, start,
    stop, item_id: words ``start`` to ``stop - 1`` lie in windows of the item, found once or more.

    Items and documents are winnowed: of every ``window - gram + 1`` runs of ``gram`` words in a row
    the least hash is kept, so each shared span of ``window`` words keeps a common one. A filter of
    fixed size drops document hashes that no item has before anything is shuffled; the rest joins
    the items' hashes, and each meeting is extended word by word to both sides. Spans of at least
    ``window`` words count, hash accidents don't. Items shorter than a window are looked for whole.
    """
    item_rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    item_keys = "item_id string, n_words long, " + OUT[OUT.index("grams") :]
    cut = settle(item_rows.mapInArrow(_emit(["item_id"], window, gram, None, None), item_keys).where("n_words > 0"))
    test = cut.select("item_id", F.explode("grams").alias("g")).select("item_id", "g.*").distinct()
    lengths = sorted(r["n"] for r in test.select("n").distinct().collect())
    member = _member_filter(test.select("h"), FILTER_WORDS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    marked = settle(rows.mapInArrow(_emit(["doc_id", "text_hash"], window, gram, lengths, member), OUT))
    # Equal rows give equal hits, so they are looked up once.
    train = marked.where(F.size("grams") > 0).dropDuplicates(["doc_id", "text_hash"])
    train = train.select("doc_id", "text_hash", F.explode("grams").alias("g")).select(
        "doc_id", "text_hash", "g.n", "g.h", "g.at", F.col("g.left").alias("l"), F.col("g.right").alias("r")
    )
    test = test.select("item_id", "n", "h", F.col("left").alias("item_l"), F.col("right").alias("item_r"))
    spans = (
        train.join(test, ["n", "h"])
        .select(
            "doc_id", "text_hash", "item_id", "n",
            (F.col("at") - _equal("l", "item_l")).alias("start"), (F.col("at") + _equal("r", "item_r")).alias("stop"),
        )
        .where("stop - start >= n")
        .select("doc_id", "text_hash", "item_id", "start", "stop")
        .distinct()
    )
    return marked.select("doc_id", "text_hash", "n_words"), spans


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS, gram: int = GRAM_WORDS) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, n_words, n_hit (words inside an occurrence of a window
    of an item), item_ids (those items, sorted as strings) and contaminated.

    Null and empty texts have no words. A null doc_id is a value like any other. A null item_id
    counts as the empty one. Items without words match nothing; without items nothing is hit. Other columns are not read.
    """
    counted, found = hits(docs, items, window, gram)
    found = settle(found)
    words = (
        found.select("doc_id", "text_hash", "start", "stop").distinct()
        .select("doc_id", "text_hash", F.explode(F.expr("sequence(start, stop - 1)")).alias("at"))
        .distinct().groupBy("doc_id", "text_hash").agg(F.count("*").alias("n_hit"))
    )
    names = found.select("doc_id", "text_hash", "item_id").distinct().groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_list("item_id")).alias("item_ids")
    )
    words = words.select(F.col("doc_id").alias("i"), F.col("text_hash").alias("t"), "n_hit")
    names = names.select(F.col("doc_id").alias("i2"), F.col("text_hash").alias("t2"), "item_ids")
    both = words.join(names, F.col("i").eqNullSafe(F.col("i2")) & (F.col("t") == F.col("t2")))
    same = F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_hash") == F.col("t"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return counted.join(both, same, "left").select(
        "doc_id", "text_hash", "n_words", n_hit.alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((n_hit > 0) & (n_hit * CONTAMINATED_SHARE >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS, gram: int = GRAM_WORDS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not contaminated."""
    doc_id, text_hash = unused(docs, "hit_id"), unused(docs, "hit_hash")
    hit = contamination(docs, items, window, gram).where("contaminated")
    hit = settle(hit.select(F.col("doc_id").alias(doc_id), F.col("text_hash").alias(text_hash)).distinct())
    same = docs["doc_id"].cast("long").eqNullSafe(hit[doc_id]) & (F.xxhash64(docs["text"]) == hit[text_hash])
    return docs.join(hit, same, "left_anti")
