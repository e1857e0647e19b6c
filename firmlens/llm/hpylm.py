"""Hierarchical Pitman-Yor language model over a whole corpus.

Two levels: a restaurant for each context (the 64-bit hash of the word before; the start of a text
is one more) and the root that all of them share as their parent. Customers of a context restaurant
are its tokens; each of its tables sends one customer to the root.

Work is dealt by dish, that is by word: a task holds all (word, context) counts of its words, so
tables and root customers are counted where they are. What tasks must tell each other are the totals
of each restaurant: a table of (bucket, shard) rows, where a bucket tells each shard of contexts what
it has of them, and the shard answers with the sums. Words that are very frequent are dealt by word
and context, and their root counts are totals at the driver.
"""

from __future__ import annotations

import gc
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from firmlens.llm.common import share, texts
from firmlens.session import settle

END = np.uint64(xxhash.xxh64_intdigest(b""))  # no word is empty
START = np.uint64(xxhash.xxh64_intdigest(b" "))  # no word is a space
#: Tokens of documents that travel together, and (word, context, document) entries of a bucket, about.
BLOCK_TOKENS = 400_000
BLOCK_DOCUMENTS = 16_384
BUCKET_TOKENS = 1_400_000
#: Words with at least this share of a sample's tokens, or as many as a quarter of a bucket, are dealt
#: by context too. A (word, context) pair in so many documents sends its bucket one entry a block.
HOT_SHARE = 0.005
HOT_SAMPLE_DOCUMENTS = 2000
STRENGTH = 1.0
BURN_IN, SAMPLES = 2, 4
#: Up to this many customers of a dish the number of tables is drawn from the exact conditional.
EXACT_CUSTOMERS = 64
SEED = 17

_HELD = 1 << 15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(keys: np.ndarray, draw: int) -> np.ndarray:
    """An even number in (0, 1) from a key and the number of the draw: the same in every task."""
    mixed = _mix(keys + _mix(np.array([draw + (SEED << 32)], np.uint64)))
    return ((mixed >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53)


def _squeeze(*arrays: np.ndarray) -> list[bytes]:
    """Each array byte plane by byte plane: small and sorted numbers leave planes with little in them."""
    planes = (np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T for a in arrays)
    return [zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(p).tobytes()) for p in planes]


def _open(frame: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(frame), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _packed_ids(ids: list[int | None]) -> bytes:
    """Ids and which of them are known, as bytes: an array with a null would reach pandas as doubles."""
    return np.array([i or 0 for i in ids], "<i8").tobytes() + np.array([i is not None for i in ids], np.uint8).tobytes()


def _unpacked_ids(packed: bytes, n: int) -> list[int | None]:
    known = np.frombuffer(packed, np.uint8, n, 8 * n)
    return [i if k else None for i, k in zip(np.frombuffer(packed, "<i8", n).tolist(), known.tolist(), strict=True)]


def _release(df: DataFrame) -> None:
    """Let Spark's cleaner remove shuffles that nothing refers to any more: it goes by the garbage
    collection of the driver, which may not come before the disk is full."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def split_words(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def hash_words(words) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _pair(hashes: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    return hashes ^ _mix(contexts + np.uint64(1))


def _bucket(hashes: np.ndarray, contexts: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    keys = np.where(np.isin(hashes, hot), _pair(hashes, contexts), hashes) if len(hot) else hashes
    return (_mix(keys) % np.uint64(buckets)).astype(np.int64)


EXCHANGED = "bucket long, shard long, sweep long, parts array<binary>"
#: In place of a shard: a bucket's summary, and what of it the sweeps need.
SUMMARY, CORE = -1, -2
#: Summaries that reach the driver.
SUMMARIES = 64
MESSAGE = "bucket long, block long, parts array<binary>, doc_ids binary, learn array<boolean>, tokens array<long>"
MERGED = "bucket long, block long, types array<binary>, refs array<binary>, doc_ids binary, learn array<boolean>, tokens array<long>"


def _messages(hot: np.ndarray, buckets: int, pairs: np.ndarray = np.zeros(0, np.uint64)):
    """Blocks of documents as one message to each bucket (sorted word, context, document and count),
    and a head (documents, whether they are learned from, tokens) to a bucket beyond the others.

    Of the hot ``pairs`` a bucket gets one entry a block, with a number after the documents' and the
    block's training count (or 1, not learned from); the head keeps which documents have them."""
    schema = pa.schema(
        [("bucket", pa.int64()), ("block", pa.int64()), ("parts", pa.list_(pa.binary())), ("doc_ids", pa.binary()), ("learn", pa.list_(pa.bool_())), ("tokens", pa.list_(pa.int64()))]
    )

    def block(number: int, ids: list, learn: list, sizes: list, words: list) -> pa.RecordBatch:
        docs = len(ids)
        codes, distinct = pd.factorize(np.array(words, object)) if words else (np.zeros(0, np.int64), [])
        hashes = np.append(hash_words(distinct), END)
        order = np.argsort(hashes)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        hashes = hashes[order]
        # Each document's words, then its end.
        size = np.array(sizes, np.int64)
        doc = np.repeat(np.arange(docs), size + 1)
        stop = np.cumsum(size + 1) - 1
        token = np.full(len(doc), rank[-1])
        inner = np.ones(len(doc), bool)
        inner[stop] = False
        token[inner] = rank[codes]
        names = np.append(hashes, START)
        context = np.empty(len(doc), np.int64)
        context[1:] = token[:-1]
        context[np.append(0, stop[:-1] + 1)] = len(hashes)
        key, count = np.unique((token * len(names) + context) * docs + doc, return_counts=True)
        doc, key = key % docs, key // docs
        context, token = key % len(names), key // len(names)
        learned = np.array(learn, bool)[doc]
        pair = _pair(hashes[token], names[context])
        hit = np.isin(pair, pairs)
        _, first, j = np.unique(pair[hit], return_index=True, return_inverse=True)
        weight = np.bincount(j, count[hit] * learned[hit], len(first)).astype(np.int64)
        kept = _squeeze(j.astype("<u4"), doc[hit].astype("<u2"), count[hit].astype("<u4"), np.maximum(weight, 1).astype("<u4"))
        if len(first):
            token, context = (np.append(x[~hit], x[hit][first]) for x in (token, context))
            doc, count, learned = np.append(doc[~hit], docs + np.arange(len(first))), np.append(count[~hit], np.maximum(weight, 1)), np.append(learned[~hit], weight > 0)
            by = np.lexsort((doc, context, token))
            token, context, doc, count, learned = token[by], context[by], doc[by], count[by], learned[by]
        to = _bucket(hashes[token], names[context], hot, buckets)
        by = np.argsort(to, kind="stable")
        doc = doc | np.where(learned, 0, _HELD)
        to, token, context, doc, count = to[by], token[by], context[by], doc[by], count[by]
        cuts = np.flatnonzero(np.diff(to)) + 1
        rows: list[list] = [[], [], [], [], [], []]
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(to)], strict=True):
            starts = np.append(0, np.flatnonzero(np.diff(token[a:b])) + 1)
            lengths = np.diff(np.append(starts, b - a))
            met, slot = np.unique(context[a:b], return_inverse=True)
            parts = _squeeze(hashes[token[a:b][starts]], lengths.astype("<u4"), slot.astype("<u4"), doc[a:b].astype("<u2"), count[a:b].astype("<u4"), names[met])
            for column, value in zip(rows, (int(to[a]), number, parts, None, None, None), strict=True):
                column.append(value)
        for column, value in zip(rows, (buckets + number % buckets, number, kept, _packed_ids(ids), learn, (size + 1).tolist()), strict=True):
            column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        ids, learn, sizes, words = [], [], [], []
        for batch in batches:
            for doc_id, known, text in zip(batch.column("doc_id").to_pylist(), batch.column("learn").to_pylist(), texts(batch), strict=True):
                own = split_words(text)
                ids.append(doc_id)
                learn.append(bool(known))
                sizes.append(len(own))
                words += own
                if len(words) >= BLOCK_TOKENS or len(ids) >= BLOCK_DOCUMENTS:
                    yield block(number, ids, learn, sizes, words)
                    number, ids, learn, sizes, words = number + 1, [], [], [], []
        if ids:
            yield block(number, ids, learn, sizes, words)

    return run


def _merge(buckets: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """A bucket's messages as its distinct (word, context) with their training counts, and for
        each block the entries that refer to them. Heads stay as they are, their parts as refs."""
        number = int(pdf["bucket"].iat[0])
        if number >= buckets:
            return pdf.assign(types=None, refs=pdf["parts"])[["bucket", "block", "types", "refs", "doc_ids", "learn", "tokens"]]
        pdf = pdf.sort_values("block")
        kinds = ("<u8", "<u4", "<u4", "<u2", "<u4", "<u8")

        def column(i: int) -> np.ndarray:
            """One field of all messages; only one is open at a time."""
            return np.concatenate([_open(parts[i], kinds[i]) for parts in pdf["parts"]])

        hashes, run_of_hash = np.unique(column(0), return_inverse=True)
        contexts = np.unique(column(5))
        key = np.repeat(run_of_hash * len(contexts), column(1))
        key += np.concatenate([np.searchsorted(contexts, _open(parts[5], "<u8"))[_open(parts[2], "<u4")] for parts in pdf["parts"]])
        key, ref = np.unique(key, return_inverse=True)
        doc, count = column(3), column(4)
        sizes = np.array([len(_open(parts[3], "<u2")) for parts in pdf["parts"]], np.int64)
        learned = np.bincount(ref, np.where(doc & _HELD, 0, count), len(key)).astype("<u8")
        per_word = np.bincount(key // len(contexts), minlength=len(hashes)).astype("<u4")
        types = _squeeze(hashes, per_word, (key % len(contexts)).astype("<u4"), learned, contexts)
        step = np.diff(ref, prepend=0)
        refs = _squeeze(step.astype("<i4"), doc & (_HELD - 1), count, pdf["block"].to_numpy("<i8"), sizes)
        return pd.DataFrame([{"bucket": number, "block": None, "types": types, "refs": refs, "doc_ids": None, "learn": None, "tokens": None}])

    return run


def log_stirling(discount: float, most: int = EXACT_CUSTOMERS) -> np.ndarray:
    """log of the generalised Stirling numbers: ways to seat c customers at t tables."""
    table = np.full((most + 1, most + 1), -np.inf)
    table[0, 0] = 0.0
    for c in range(most):
        t = np.arange(1, c + 2)
        with np.errstate(divide="ignore"):
            stay = np.log(np.maximum(c - t * discount, 0)) + table[c, 1 : c + 2]
        table[c + 1, 1 : c + 2] = np.logaddexp(table[c, : c + 1], stay)
    return table


def draw_tables(customers: np.ndarray, mass: np.ndarray, discount: float, uniform: np.ndarray, stirling: np.ndarray) -> np.ndarray:
    """The number of tables at which the customers of each dish sit, given all others.

    ``mass`` is what a new table of the dish weighs: the restaurant's strength and tables times the
    parent's probability of the dish. Seatings with t tables weigh ``stirling[c, t] * mass ** t``;
    beyond ``EXACT_CUSTOMERS`` the saddle point of the same weights is used.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    few = np.minimum(customers, EXACT_CUSTOMERS)
    order = np.argsort(few, kind="stable")
    at = np.searchsorted(few[order], np.arange(2, EXACT_CUSTOMERS + 2))
    for c, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True), start=2):
        if a < b:
            some = order[a:b]
            weight = stirling[c, 1 : c + 1] + np.log(mass[some])[:, None] * np.arange(1, c + 1)
            total = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
            tables[some] = 1 + (total < uniform[some, None] * total[:, -1:]).sum(axis=1)
    many = np.flatnonzero(customers > EXACT_CUSTOMERS)
    if len(many):
        tables[many] = _saddle_tables(customers[many].astype(float), mass[many], discount, uniform[many])
    return tables


def _saddle_tables(customers: np.ndarray, mass: np.ndarray, discount: float, uniform: np.ndarray) -> np.ndarray:
    """Tables of many customers. The weights are those of a compound Poisson number of tables given
    their total size; tilted so that the size is expected, one table holds the bulk and the others
    are a Poisson number (with the variance that the total leaves, where there are many)."""
    low, high = np.full(len(mass), -700.0), np.zeros(len(mass))
    for _ in range(60):
        middle = (low + high) / 2
        u = np.exp(middle)
        over = np.log(mass) + np.log1p(-u) + (discount - 1) * middle > np.log(customers)
        low, high = np.where(over, middle, low), np.where(over, high, middle)
    u = np.exp(high)
    x = 1 - u
    mean = mass / discount * (1 - u**discount)
    spread = customers + customers * x * (1 - discount) / u
    sigma = np.sqrt(np.maximum(mean - customers**2 / spread, 1e-9))
    few = np.minimum(mean, 40.0)
    others, term = np.zeros(len(mass)), np.exp(-few)
    total = term.copy()
    for k in range(1, 120):
        others += uniform > total
        term = term * few / k
        total += term
    # The logistic curve is close enough to the normal one here.
    normal = np.log(uniform / (1 - uniform)) * 0.5513
    others = np.where(mean > 40.0, np.rint(mean + sigma * normal), others)
    return np.clip(1 + others, 1, customers).astype(np.int64)


@dataclass
class Totals:
    """What all tasks know after a sweep: of the root the customers and tables; per hot word its
    training tokens, root customers and root tables. ``tokens`` and ``tables`` are those of all
    restaurants, by groups of buckets. What is of single restaurants stays in tables: ``sent`` by the
    buckets to the shards, and ``replies``, the shards' sums for the contexts that sweeps need."""

    tokens: np.ndarray
    tables: np.ndarray
    customers: float
    root_tables: float
    hot: np.ndarray
    hot_tokens: np.ndarray
    hot_customers: np.ndarray
    hot_tables: np.ndarray
    n: float
    v: float
    discount: float
    root_discount: float
    shards: int
    sent: DataFrame | None = None
    replies: DataFrame | None = None


class Bucket:
    """A bucket's words and (word, context) types, and their seating sweep by sweep. ``types`` may be
    those of ``core``: only what sweeps can change."""

    def __init__(self, number: int, types: list[bytes], hot: np.ndarray):
        self.number = number
        self.hashes, per_word, self.slot, learned, self.contexts, *rest = (_open(f, k) for f, k in zip(types, ("<u8", "<u4", "<u4", "<u8", "<u8", "<u4", "<u8"), strict=False))
        #: Types that are left out: per word those of one customer, and words of one token.
        self.single, self.hidden = (rest[0].astype(np.int64), int(rest[1][0])) if rest else (np.zeros(len(self.hashes), np.int64), 0)
        self.word = np.repeat(np.arange(len(self.hashes)), per_word)
        self.count = learned.astype(np.int64)
        self.keys = _mix(self.hashes[self.word]) ^ _mix(self.contexts + np.uint64(77))[self.slot]
        place = np.searchsorted(hot, self.hashes) if len(hot) else np.zeros(len(self.hashes), np.int64)
        self.hot = place.clip(max=max(0, len(hot) - 1))
        self.is_hot = hot[self.hot] == self.hashes if len(hot) else np.zeros(len(self.hashes), bool)
        self.tokens = np.bincount(self.word, self.count, len(self.hashes)) + self.single
        self.several = np.flatnonzero(self.count > 1)

    @property
    def context(self) -> np.ndarray:
        """The first 16 bits of each type's context, to show; the model goes by all 64."""
        return (self.contexts >> np.uint64(48))[self.slot]

    def core(self) -> list[bytes]:
        """The types of several customers and the words of several tokens: the others have one table
        in every sweep."""
        kept = (self.tokens > 1) | (self.is_hot & (self.tokens > 0))
        used, slot = np.unique(self.slot[self.several], return_inverse=True)
        per_word = np.bincount(self.word[self.several], minlength=len(self.hashes))[kept]
        single = np.bincount(self.word, self.count == 1, len(self.hashes))[kept]
        hidden = (~kept & (self.tokens == 1)).sum()
        return _squeeze(
            self.hashes[kept], per_word.astype("<u4"), slot.astype("<u4"), self.count[self.several].astype("<u8"), self.contexts[used], single.astype("<u4"), np.array([hidden], "<u8")
        )

    def root(self, state: tuple, totals: Totals) -> np.ndarray:
        """The root's probability of each word."""
        customers, tables = state[1], state[2]
        if totals.hot.size:
            customers = np.where(self.is_hot, totals.hot_customers[self.hot], customers)
            tables = np.where(self.is_hot, totals.hot_tables[self.hot], tables)
        return (customers - totals.root_discount * tables + new_word(totals)) / (STRENGTH + totals.customers)

    def states(self, known: list[Totals], seats: list[np.ndarray], upto: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(tables per type, root customers and root tables per word) after sweeps 0 to ``upto``; at
        0 every dish has one table in each restaurant. ``seats`` are the tables of each context after
        each sweep before. Draws depend on word, context and sweep alone, so each pass repeats the
        earlier ones exactly instead of keeping their seats."""
        tables = np.minimum(self.count, 1)
        for sweep in range(upto + 1):
            if sweep:
                before = known[sweep - 1]
                mass = (STRENGTH + before.discount * seats[sweep - 1][self.slot[self.several]]) * self.root(state, before)[self.word[self.several]]
                tables = tables.copy()
                tables[self.several] = draw_tables(
                    self.count[self.several], mass, before.discount, _uniform(self.keys[self.several], 2 * sweep), log_stirling(before.discount)
                )
            customers = np.bincount(self.word, tables, len(self.hashes)).astype(np.int64) + self.single
            root_tables = np.minimum(customers, 1)
            if sweep:
                root_tables = draw_root_tables(customers, self.hashes, known[sweep - 1], sweep)
            state = tables, customers, root_tables
            yield state

    def summary(self, state: tuple, hots: int) -> np.ndarray:
        """What the totals at the driver are made of. Those of words and tokens hold for sweep 0."""
        _, customers, root_tables = state
        cold = ~self.is_hot
        hot_tokens = np.bincount(self.hot, self.tokens * self.is_hot, hots) if hots else np.zeros(0)
        hot_customers = np.bincount(self.hot, customers * self.is_hot, hots) if hots else np.zeros(0)
        scalars = [
            customers.sum() + self.hidden, root_tables[cold].sum() + self.hidden, self.count.sum(), (self.tokens[cold] > 0).sum(),
            (self.count == 1).sum(), (self.count == 2).sum(), (customers[cold] == 1).sum(), (customers[cold] == 2).sum(),
        ]
        return np.concatenate([hot_tokens, hot_customers, scalars]).astype(float)


def new_word(totals: Totals) -> float:
    """What the root keeps for a new table of any one dish; V words and one unknown share it evenly."""
    return (STRENGTH + totals.root_discount * totals.root_tables) / (totals.v + 1)


def draw_root_tables(customers: np.ndarray, hashes: np.ndarray, before: Totals, sweep: int) -> np.ndarray:
    mass = np.full(len(customers), new_word(before))
    return draw_tables(customers, mass, before.root_discount, _uniform(_mix(hashes), 2 * sweep + 1), log_stirling(before.root_discount))


def _rows(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """Rows one by one: each may hold megabytes."""
    columns = [batch.column(n) for n in names]
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in columns)


def _dealt(number: int, sweep: int, shards: int, contexts: np.ndarray, *columns: np.ndarray) -> list[tuple]:
    """A bucket's rows to the shards of its (sorted) contexts. Shards are ranges of hashes."""
    shard = (((contexts >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)
    edges = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
    return [(number, int(shard[a]), sweep, _squeeze(contexts[a:b], *(c[a:b] for c in columns))) for a, b in zip(edges[:-1], edges[1:], strict=True) if a < b]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["bucket", "shard", "sweep", "parts"])


def _first(hot: np.ndarray, shards: int):
    """Sweep 0: what each bucket has of its contexts (tokens, tables, whether later sweeps need
    them), its core and its summary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, types in _rows(batch, "bucket", "types"):
                bucket = Bucket(number, types, hot)
                (state,) = bucket.states([], [], 0)
                size = len(bucket.contexts)
                tokens, tables = (np.bincount(bucket.slot, x, size) for x in (bucket.count, state[0]))
                wanted = np.bincount(bucket.slot[bucket.several], minlength=size) > 0
                rows = _dealt(number, 0, shards, bucket.contexts, tables.astype("<u4"), tokens.astype("<u8"), wanted)
                rows += [(number, CORE, 0, bucket.core()), (number, SUMMARY, 0, [bucket.summary(state, len(hot)).tobytes()])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.binary())), strict=True)], ["bucket", "shard", "sweep", "parts"]
                )

    return run


def _next(hot: np.ndarray, known: list[Totals], shards: int):
    """A later sweep over the buckets' cores: the tables beyond the first of each dish, by context."""
    sweep = len(known)

    def run(core: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        number = int(core["bucket"].iat[0])
        bucket = Bucket(number, list(core["parts"].iat[0]), hot)
        replies = replies.sort_values(["sweep", "shard"])
        seats = [np.concatenate([np.zeros(0, "<u4"), *(_open(p[0], "<u4") for p in replies["parts"][replies["sweep"] == i])]).astype(np.int64) for i in range(sweep)]
        *_, state = bucket.states(known, [seats[0], *(seats[0] + more for more in seats[1:])], sweep)
        more = np.bincount(bucket.slot, state[0] - 1, len(bucket.contexts)).astype("<u4")
        rows = _dealt(number, sweep, shards, bucket.contexts, more)
        return _frame([*rows, (number, SUMMARY, sweep, [bucket.summary(state, len(hot)).tobytes()])])

    return run


def _answered(pdf: pd.DataFrame) -> pd.DataFrame:
    """A shard's sums of one sweep, to each bucket for its contexts that sweeps need, in their order."""
    contexts = [_open(p[0], "<u8") for p in pdf["parts"]]
    _, place = np.unique(np.concatenate(contexts), return_inverse=True)
    sums = np.bincount(place, np.concatenate([_open(p[1], "<u4") for p in pdf["parts"]])).astype("<u4")[place]
    rows, at = [], 0
    for number, shard, sweep, parts, own in zip(pdf["bucket"], pdf["shard"], pdf["sweep"], pdf["parts"], contexts, strict=True):
        mine = sums[at : at + len(own)]
        at += len(own)
        mine = mine[_open(parts[3], bool)] if sweep == 0 else mine
        if len(mine):
            rows.append((number, shard, sweep, _squeeze(mine)))
    return _frame(rows)


def _settled(pdf: pd.DataFrame) -> pd.DataFrame:
    """A shard's tokens and tables after every sweep, to each bucket for all of its contexts."""
    asked = pdf[pdf["sweep"] == 0]
    contexts = [_open(p[0], "<u8") for p in asked["parts"]]
    every, place = np.unique(np.concatenate(contexts), return_inverse=True)
    tokens, tables = (np.bincount(place, np.concatenate([_open(p[i], k) for p in asked["parts"]])) for i, k in ((2, "<u8"), (1, "<u4")))
    columns = [tokens.astype("<u8"), tables.astype("<u4")]
    for sweep in range(1, 1 + BURN_IN + SAMPLES):
        parts = pdf["parts"][pdf["sweep"] == sweep]
        more = np.zeros(len(every))
        for p in parts:
            more[np.searchsorted(every, _open(p[0], "<u8"))] += _open(p[1], "<u4")
        columns.append(more.astype("<u4"))
    edges = np.cumsum([0, *map(len, contexts)])
    rows = zip(asked["bucket"], asked["shard"], asked["sweep"], zip(edges[:-1], edges[1:], strict=True), strict=True)
    return _frame([(number, shard, sweep, _squeeze(*(c[place[a:b]] for c in columns))) for number, shard, sweep, (a, b) in rows])


def _added(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"sums": [np.sum([np.frombuffer(p[0]) for p in pdf["parts"]], axis=0).tobytes()]})


def _restaurants(known: list[Totals]) -> DataFrame:
    """Tokens and tables of each bucket's contexts, from what was sent in all sweeps."""
    sent = known[0].sent
    for totals in known[1:]:
        sent = sent.unionByName(totals.sent)
    return sent.where("shard >= 0").groupBy("shard").applyInPandas(_settled, EXCHANGED)


def _received(parts: list) -> tuple[np.ndarray, list[np.ndarray]]:
    """Tokens, and tables after each sweep, of a bucket's contexts; ``parts`` in the order of shards."""
    columns = [np.concatenate([_open(p[i], "<u4" if i else "<u8") for p in parts]).astype(np.int64) for i in range(2 + BURN_IN + SAMPLES)]
    return columns[0], [columns[1], *(columns[1] + more for more in columns[2:])]


def _plain(known: list[Totals]) -> list[Totals]:
    """What goes to tasks."""
    return [replace(t, sent=None, replies=None) for t in known]


def _totals(merged: DataFrame, hot: np.ndarray, known: list[Totals]) -> Totals:
    """One Gibbs sweep over all buckets, given the totals after the sweeps before."""
    sweep, hots = len(known), len(hot)
    if known:
        shards, replies = known[0].shards, known[0].replies
        for totals in known[1:]:
            replies = replies.unionByName(totals.replies)
        cores = known[0].sent.where(F.col("shard") == CORE).groupBy("bucket")
        sent = settle(cores.cogroup(replies.groupBy("bucket")).applyInPandas(_next(hot, _plain(known), shards), EXCHANGED))
    else:
        shards = 1 + (merged.where("doc_ids is null").agg(F.max("bucket")).first()[0] or 0)
        sent = settle(merged.where("types is not null").select("bucket", "types").mapInArrow(_first(hot, shards), EXCHANGED))
    replies = settle(sent.where("shard >= 0").groupBy("shard").applyInPandas(_answered, EXCHANGED)) if sweep < BURN_IN + SAMPLES else None
    groups = sent.where(F.col("shard") == SUMMARY).withColumn("shard", F.col("bucket") % SUMMARIES).groupBy("shard").applyInPandas(_added, "sums binary")
    sums = [np.frombuffer(r["sums"]) for r in groups.collect()]
    sums = np.array(sums) if sums else np.zeros((1, 2 * hots + 8))
    hot_tokens, hot_customers, scalars = np.split(sums.sum(axis=0), [hots, 2 * hots])
    customers, cold_tables, n, cold_v, one, two, root_one, root_two = scalars

    def discount(a: float, b: float) -> float:
        """From the dishes that were ordered once and twice."""
        return float(np.clip(a / (a + 2 * b), 0.05, 0.95)) if a else 0.5

    if known:
        hot_tables = draw_root_tables(hot_customers.astype(np.int64), hot, known[-1], sweep).astype(float)
        start = known[0]
        return replace(
            start, tables=sums[:, 2 * hots], customers=customers, root_tables=cold_tables + hot_tables.sum(), hot_customers=hot_customers, hot_tables=hot_tables, sent=sent, replies=replies
        )
    hot_tables = np.minimum(hot_customers, 1)
    return Totals(
        sums[:, 2 * hots + 2], sums[:, 2 * hots], customers, cold_tables + hot_tables.sum(), hot, hot_tokens, hot_customers, hot_tables, n, cold_v + (hot_tokens > 0).sum(),
        discount(one, two), discount(root_one, root_two), shards, sent, replies,
    )


def probabilities(bucket: Bucket, known: list[Totals], parts: list | None = None) -> np.ndarray:
    """The predictive probability of each type's word in its context, averaged over the kept sweeps.
    ``parts`` are the bucket's rows of ``_restaurants``; at the driver they are read."""
    if parts is None:
        parts = [r["parts"] for r in _restaurants(known).where(F.col("bucket") == bucket.number).orderBy("shard").collect()]
    tokens, seats = _received(parts)
    mean = np.zeros(len(bucket.word))
    for sweep, state in enumerate(bucket.states(known, seats, len(known) - 1)):
        if sweep >= len(known) - SAMPLES:
            totals = known[sweep]
            backing = (STRENGTH + totals.discount * seats[sweep][bucket.slot]) * bucket.root(state, totals)[bucket.word]
            mean += (bucket.count - totals.discount * state[0] + backing) / (STRENGTH + tokens[bucket.slot])
    return mean / SAMPLES


def _scored(hot: np.ndarray, known: list[Totals]):
    """Per bucket and block: the documents met and their sums of log10 probabilities, of base scores
    and of known tokens."""
    last = known[-1]

    def run(pdf: pd.DataFrame, restaurants: pd.DataFrame) -> pd.DataFrame:
        number = int(pdf["bucket"].iat[0])
        bucket = Bucket(number, list(pdf["types"].iat[0]), hot)
        log_p = np.log10(probabilities(bucket, known, list(restaurants.sort_values("shard")["parts"])))
        tokens = np.where(bucket.is_hot, last.hot_tokens[bucket.hot], bucket.tokens) if len(hot) else bucket.tokens
        base = np.log10((tokens + 0.5) / (last.n + 0.5 * (last.v + 1)))[bucket.word]
        seen = (tokens > 0)[bucket.word]
        step, doc, count, blocks, sizes = (_open(f, k) for f, k in zip(pdf["refs"].iat[0], ("<i4", "<u2", "<u4", "<i8", "<i8"), strict=True))
        ref = np.cumsum(step, dtype=np.int64)
        rows, at = [], 0
        for block, size in zip(blocks.tolist(), sizes.tolist(), strict=True):
            r, d, c = ref[at : at + size], doc[at : at + size], count[at : at + size].astype(float)
            at += size
            docs, place = np.unique(d, return_inverse=True)
            sums = [np.bincount(place, c * x[r], len(docs)) for x in (log_p, base, seen)]
            rows.append((number, block, _squeeze(docs, *sums[:2], sums[2].astype("<u4"))))
        return pd.DataFrame(rows, columns=["bucket", "block", "parts"])

    return run


def _collected(n: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """A block's documents with the sums from all buckets, added in the order of the buckets."""
        head = pdf[pdf["doc_ids"].notna()].iloc[0]
        size = len(head["tokens"])
        pair, at, times, weight = (_open(f, t) for f, t in zip(head["parts"], ("<u4", "<u2", "<u4", "<u4"), strict=True))
        score, base, known = (np.zeros(size + len(weight), t) for t in (float, float, np.int64))
        for parts in pdf[pdf["doc_ids"].isna()].sort_values("bucket")["parts"]:
            docs, s, b, k = (_open(f, t) for f, t in zip(parts, ("<u2", "<f8", "<f8", "<u4"), strict=True))
            score[docs] += s
            base[docs] += b
            known[docs] += k
        score, base, known = (x[:size] + np.bincount(at, (x[size:] / weight)[pair] * times, size) for x in (score, base, known))
        known = np.rint(known).astype(np.int64)
        ids = pd.array(_unpacked_ids(head["doc_ids"], size), dtype="Int64")
        return pd.DataFrame(
            {"doc_id": ids, "learned": [bool(x) for x in head["learn"]], "n_tokens": np.array(head["tokens"], np.int64), "n_known": known, "train_tokens": int(n), "base_score": base, "score": score}
        )

    return run


def _hot(docs: DataFrame, tokens: float, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the most frequent words of a bounded sample of documents, and the end; and of the
    (word, context) pairs that so many documents have that they would fill a quarter of a bucket.

    A hot word is at least a quarter of a bucket or ``HOT_SHARE`` of all, so there are at most some
    four of them a bucket; the sample grows with the buckets and shows each of them often.
    """
    rate = min(1.0, max(HOT_SAMPLE_DOCUMENTS / max(1, docs.count()), 800 * buckets / max(1.0, tokens)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, pairs = Counter(), Counter()
            for t in texts(batch):
                own = split_words(t)
                words.update(own)
                pairs.update({*zip([b" ", *own], [*own, b""], strict=True)})
            for kind, hashes, seen in (("word", hash_words(list(words)), words), ("pair", _pair(hash_words([b for _, b in pairs]), hash_words([a for a, _ in pairs])), pairs)):
                yield pa.RecordBatch.from_arrays([pa.array([kind] * len(seen), pa.string()), pa.array(hashes.view(np.int64)), pa.array(list(seen.values()), pa.int64())], ["kind", "h", "n"])

    drawn = docs.where(share(F.xxhash64("doc_id", "text"), SEED) < rate).select("text")
    quarter = rate * BUCKET_TOKENS / 4
    counts = settle(drawn.mapInArrow(count, "kind string, h long, n long").groupBy("kind", "h").agg(F.sum("n").alias("n")).where("n >= 50 or kind = 'word'"))
    total = counts.where("kind = 'word'").agg(F.sum("n")).first()[0] or 0
    least = {"word": min(HOT_SHARE * total, quarter), "pair": quarter}
    often = counts.where(" or ".join(f"kind = '{k}' and n >= {max(50, n)}" for k, n in least.items())).orderBy(F.desc("n"), "h").collect()
    words, pairs = (np.array([r["h"] for r in often if r["kind"] == k], np.int64).view(np.uint64) for k in least)
    # A block numbers its hot pairs after its documents.
    return np.unique(np.append(words, END)), np.unique(pairs[: _HELD - BLOCK_DOCUMENTS])


def score(docs: DataFrame, learn: Column) -> DataFrame:
    """Fit on the rows of ``docs`` (doc_id, text) that ``learn`` marks and score all rows.

    doc_id, learned, n_tokens (words and the end), n_known (tokens that were learned from), train_tokens,
    base_score (add-half unigram) and score: the log10 probability of the text, its words and its end,
    with the predictive probabilities averaged over ``SAMPLES`` Gibbs sweeps after ``BURN_IN``.

    Documents are cut into blocks, each sends every bucket of words one packed message, and a bucket's
    merged counts are written once. Sweeps and scoring read them; the totals of restaurants go from
    buckets to shards of contexts and back, and only sums over all come to the driver. In a sweep the totals and the root's probabilities are those of the sweep before, and
    a dish's tables are drawn jointly from their exact conditional.

    Null texts are empty: one token, the end. Unknown words share the root's room for one more word.
    With nothing to learn from every token has probability 1 (the one unknown word). A null doc_id
    stays null; repeated rows are scored each; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(learn, F.lit(False)).alias("learn"))
    letters = rows.agg(F.sum(F.length("text") + 7)).first()[0] or 0
    buckets = max(1, round(letters / 7 / BUCKET_TOKENS))
    hot, pairs = _hot(rows, letters / 7, buckets)
    merged = settle(rows.mapInArrow(_messages(hot, buckets, pairs), MESSAGE).groupBy("bucket").applyInPandas(_merge(buckets), MERGED))
    _release(rows)
    known: list[Totals] = []
    for _ in range(1 + BURN_IN + SAMPLES):
        known.append(_totals(merged, hot, known))
        _release(rows)
    types = merged.where("types is not null").select("bucket", "types", "refs").groupBy("bucket")
    sums = types.cogroup(_restaurants(known).groupBy("bucket")).applyInPandas(_scored(hot, _plain(known)), "bucket long, block long, parts array<binary>")
    sums = sums.select("bucket", "block", "parts", *(F.lit(None).cast(t).alias(c) for c, t in (("doc_ids", "binary"), ("learn", "array<boolean>"), ("tokens", "array<bigint>"))))
    heads = merged.where("doc_ids is not null").select("bucket", "block", F.col("refs").alias("parts"), "doc_ids", "learn", "tokens")
    return sums.unionByName(heads).groupBy("block").applyInPandas(
        _collected(known[-1].n), "doc_id long, learned boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
