import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmlens.llm import hpylm
from firmlens.llm.common import fold
from firmlens.llm.queries import QUERIES
from firmlens.session import settle

END = None


def tokens(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", text), END]


def base_rows(rows, held):
    counts = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = {}
    for i, text in rows:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)
        out.setdefault(i, []).append((len(own), sum(counts[t] > 0 for t in own), n, base))
    return out


def test_base_scores_and_perplexity_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = base_rows(rows, lambda i: zlib.crc32(str(i).encode()) % 5 == 1)
    found = QUERIES["op2_hierarchical_pitman_yor"].run(spark, sf).collect()
    assert len(found) == len(rows)
    for r in found:
        n_tokens, n_known, n, base = want[r.doc_id][0]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n_tokens, n_known, n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
    held = [r for r in found if r.held_out]
    size = sum(r.n_tokens for r in held)
    assert 10 ** (-sum(r.score for r in held) / size) < 0.5 * 10 ** (-sum(r.base_score for r in held) / size)


def test_blocks_buckets_and_hot_words_change_nothing(spark, documents, monkeypatch):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["the", "the", "the", "of", "a", *(f"w{j}" for j in range(60))], k=rng.randint(0, 60)))) for i in range(120)]
    docs, learn = documents(rows), fold(F.col("doc_id"), 5) != 1
    whole = {r.doc_id: r for r in hpylm.score(docs, learn).collect()}
    monkeypatch.setattr(hpylm, "BLOCK_TOKENS", 200)
    monkeypatch.setattr(hpylm, "BUCKET_TOKENS", 300)
    monkeypatch.setattr(hpylm, "HOT_SHARE", 1.0)
    dealt = {r.doc_id: r for r in hpylm.score(docs.repartition(7), learn).collect()}
    for i, r in whole.items():
        assert dealt[i].score == pytest.approx(r.score, rel=1e-9) and dealt[i].base_score == pytest.approx(r.base_score, rel=1e-9)
        assert (dealt[i].n_tokens, dealt[i].n_known) == (r.n_tokens, r.n_known)


def test_predictions_sum_to_one(spark, documents, monkeypatch):
    rng = random.Random(6)
    vocabulary = [f"w{j}" for j in range(12)]
    # Every word after every word is asked for by a document that isn't learned from.
    rows = [(i, " ".join(rng.choices(vocabulary, k=30))) for i in range(20)]
    pairs = [(1000, f"{a} {b}") for a in vocabulary for b in [*vocabulary, "unknown"]]
    docs = documents(rows + pairs).select("doc_id", "text", (F.col("doc_id") < 1000).alias("learn"))
    merged = settle(docs.mapInArrow(hpylm._messages(np.zeros(0, np.uint64), 1), hpylm.MESSAGE).groupBy("bucket").applyInPandas(hpylm._merge(1), hpylm.MERGED))
    hot, known = np.zeros(0, np.uint64), []
    for _ in range(7):
        known.append(hpylm._totals(merged, hot, known))
    bucket = hpylm.Bucket(0, merged.where("types is not null").first()["types"], hot)
    p = hpylm.probabilities(bucket, known)
    words = {int(h): w for w, h in zip([*vocabulary, "unknown"], hpylm.hash_words([w.encode() for w in [*vocabulary, "unknown"]]))}
    name = [words.get(int(h), "end") for h in bucket.hashes]
    context = {w: int(h) >> 48 for h, w in words.items()}
    for before in vocabulary:
        total = sum(p[i] for i in range(len(p)) if bucket.context[i] == context[before] and name[bucket.word[i]] != "end")
        ends = [p[i] for i in range(len(p)) if bucket.context[i] == context[before] and name[bucket.word[i]] == "end"]
        assert total + ends[0] == pytest.approx(1, abs=1e-9)
    assert known[-1].customers == known[-1].tables.sum() and known[-1].n == known[-1].tokens.sum()


def test_tables_follow_the_seating_of_customers():
    """Drawn numbers of tables against Gibbs moves of single customers."""
    discount, mass, customers = 0.6, 0.8, 7
    drawn = hpylm.draw_tables(np.full(20_000, customers), np.full(20_000, mass), discount, hpylm._uniform(np.arange(20_000, dtype=np.uint64), 3), hpylm.log_stirling(discount))
    rng, seats, seen = random.Random(2), [customers], []
    for step in range(60_000):
        i = rng.choices(range(len(seats)), seats)[0]
        seats[i] -= 1
        seats = [s for s in seats if s]
        weights = [s - discount for s in seats] + [mass]
        i = rng.choices(range(len(weights)), weights)[0]
        seats = seats + [1] if i == len(seats) else [s + (j == i) for j, s in enumerate(seats)]
        seen.append(len(seats))
    a, b = Counter(drawn.tolist()), Counter(seen[1000:])
    for t in range(1, customers + 1):
        assert abs(a[t] / 20_000 - b[t] / len(seen[1000:])) < 0.02


@pytest.mark.parametrize("discount", [0.3, 0.6, 0.9])
@pytest.mark.parametrize("mass", [1e-4, 0.5, 3.0, 40.0, 400.0])
def test_many_customers(discount, mass):
    """The saddle point against the exact weights."""
    customers, n = 300, 4000
    weight = hpylm.log_stirling(discount, customers)[customers, 1:] + np.log(mass) * np.arange(1, customers + 1)
    p = np.exp(weight - weight.max())
    mean = (p * np.arange(1, customers + 1)).sum() / p.sum()
    u = hpylm._uniform(np.arange(n, dtype=np.uint64), 1)
    drawn = hpylm.draw_tables(np.full(n, customers), np.full(n, mass), discount, u, hpylm.log_stirling(discount))
    assert drawn.min() >= 1 and drawn.max() <= customers
    assert abs(drawn.mean() - mean) < 0.05 * mean + 0.15


def test_odd_rows(spark, documents):
    rows = [(1, None), (2, ""), (None, "a b a"), (3, "A B"), (3, "A B"), (4, "same " * 70_000), (5, "É é\x1cx"), (7, " \t\n ")]
    docs = documents(rows).withColumn("learn", F.lit("x")).withColumn("block", F.lit(1))
    want = base_rows(rows, lambda i: i == 7)
    found = hpylm.score(docs, F.col("doc_id").isNull() | (F.col("doc_id") != 7)).collect()
    got = {}
    for r in found:
        got.setdefault(r.doc_id, []).append((r.n_tokens, r.n_known, r.train_tokens, pytest.approx(r.base_score)))
    assert {k: sorted(v, key=str) for k, v in got.items()} == {k: sorted(v, key=str) for k, v in want.items()}
    assert hpylm.score(docs.where("false"), F.lit(True)).count() == 0
    nothing = hpylm.score(docs, F.lit(False)).collect()
    assert all(r.score == 0 and r.n_known == 0 and r.train_tokens == 0 for r in nothing)


def test_contexts_that_share_sixteen_bits_are_apart(spark, documents):
    """Two contexts whose hashes begin alike have restaurants of their own."""
    seen = {}
    for j in range(5000):
        a, b = seen.setdefault(int(hpylm.hash_words([b"c%d" % j])[0]) >> 48, f"c{j}"), f"c{j}"
        if a != b:
            break
    assert a != b
    rows = [(i, f"{a} p" if i % 2 else f"{b} q") for i in range(200)] + [(1000, f"{a} p"), (1001, f"{a} q")]
    found = {r.doc_id: r.score for r in hpylm.score(documents(rows), F.col("doc_id") < 1000).collect()}
    assert found[1000] - found[1001] > 1


def test_hot_words_and_pairs_leave_buckets_of_their_size(spark, documents, monkeypatch):
    """Words are hot by the size of a bucket, and a pair that many documents share sends its bucket
    one entry a block; the scores stay the same."""
    rng = random.Random(7)
    rows = [(i, " ".join(["same", "start", *rng.choices([f"w{j}" for j in range(300)], k=rng.randint(0, 20))])) for i in range(600)]
    docs, learn = documents(rows).coalesce(1), fold(F.col("doc_id"), 5) != 1
    whole = {r.doc_id: r for r in hpylm.score(docs, learn).collect()}
    monkeypatch.setattr(hpylm, "BUCKET_TOKENS", 400)
    monkeypatch.setattr(hpylm, "BLOCK_DOCUMENTS", 50)
    monkeypatch.setattr(hpylm, "HOT_SHARE", 1.0)
    dealt = {r.doc_id: r for r in hpylm.score(docs, learn).collect()}
    for i, r in whole.items():
        assert dealt[i].score == pytest.approx(r.score, rel=1e-9) and dealt[i].base_score == pytest.approx(r.base_score, rel=1e-9)
        assert (dealt[i].n_tokens, dealt[i].n_known) == (r.n_tokens, r.n_known)
    tokens = sum(r.n_tokens for r in whole.values())
    buckets = round(tokens / 400)
    hot, pairs = hpylm._hot(docs, tokens, buckets)
    assert {int(h) for h in hpylm.hash_words([b"same", b"start"])} <= {int(h) for h in hot} and len(pairs) == 2
    messages = docs.withColumn("learn", learn).mapInArrow(hpylm._messages(hot, buckets, pairs), hpylm.MESSAGE).where(F.col("bucket") < buckets)
    entries = Counter()
    for r in messages.select("bucket", "parts").collect():
        entries[r.bucket] += len(hpylm._open(r.parts[3], "<u2"))
    assert max(entries.values()) < 400 * 1.5


def test_large_ids_beside_null(spark, documents):
    """Ids that doubles cannot hold, in a block with a null one."""
    ids = [2**53 + 1, 2**62, None, -(2**63), 2**63 - 1, 0]
    found = hpylm.score(documents([(i, f"some words {i}") for i in ids]), F.lit(True)).collect()
    assert sorted((r.doc_id for r in found), key=str) == sorted(ids, key=str)
