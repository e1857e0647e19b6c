import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from firmlens.llm import spelling
from firmlens.llm.queries import QUERIES


def plain_counts(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(words, candidates=None):
    """By definition; ``candidates`` may narrow the pairs to compare."""
    pairs = candidates or {w: set(words) for w in words}
    found = {w: [x for x in pairs[w] if near(w, x)] for w in words}
    best = {w: min(x, key=lambda v: (-words[v], v), default=None) for w, x in found.items()}
    form = {w: b if b is not None and words[b] >= 5 * words[w] else None for w, b in best.items()}

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n, len(found[w]), words.get(form[w])) for w, n in words.items())


def by_deletion(words):
    """Words that share a string with one letter less."""
    groups, pairs = defaultdict(set), defaultdict(set)
    for w in words:
        for s in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            groups[s].add(w)
    for g in groups.values():
        for w in g:
            pairs[w] |= g - {w}
    return pairs


def rows(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


def test_query_on_whole_table(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    words = plain_counts(docs)
    assert len(words) > 100
    assert rows(QUERIES["op11_spelling_pairs"].run(spark, sf_dir)) == plain_variants(words, by_deletion(words))


@pytest.mark.parametrize("seed", [1, 2])
def test_dense_words_of_all_lengths(spark, seed):
    """Few letters, so that words have many neighbours, equal letters in a row, ties and long chains."""
    rng = random.Random(seed)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 7))): rng.choice([1, 2, 5, 25, 125, 3125, 10**9]) for _ in range(400)}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(7)
    assert rows(spelling.variants(df)) == plain_variants(words)


def test_chain_of_forms(spark):
    words = {"a" * (30 - i): 5**i for i in range(26)}
    found = rows(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert {r[2] for r in found} == {"a" * 5}
    assert found == plain_variants(words)


def test_one_word_of_a_pair_a_letter(spark):
    """All letters at one place: one group, nobody meets twice."""
    letters = [chr(c) for c in [*range(97, 123), *range(0xE0, 0x100)]]
    words = {f"house{c}": i + 1 for i, c in enumerate(letters)} | {"house": 1000}
    found = rows(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert {r[4] for r in found} == {len(letters)}
    assert found == plain_variants(words)


def test_very_long_words_share_their_nodes(spark):
    words = {"x" * 50_000: 5, "x" * 50_000 + "y": 30, "y" + "x" * 50_000: 30, "x" * 30_000: 9}
    found = rows(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert [r[4] for r in found] == [0, 2, 1, 1]
    assert [r[1] is not None for r in found] == [False, True, False, False]


def test_odd_rows(spark, documents):
    docs = [(None, "Über über ÜBER"), (3, None), (4, ""), (5, "12 ab, x"), (6, "Hausboot! " * 40_000), (6, "Hausboot! " * 40_000)]
    docs += [(i, "Hausboote hausbote×x Hausböot") for i in range(40)] + [(None, "hausbxot " * 300)] * 2
    df = documents(docs).withColumn("word", F.lit("w")).withColumn("N", F.lit(1))
    words = plain_counts(docs)
    assert rows(spelling.spellings(df)) == plain_variants(words)
    assert spelling.spellings(df.where("false")).count() == 0
    assert rows(spelling.spellings(documents([(1, "seldom words here")]))) == []
