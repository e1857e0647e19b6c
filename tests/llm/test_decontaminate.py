import hashlib
import re

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from firmlens.llm import decontaminate
from firmlens.llm.queries import QUERIES


def words_of(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def plain(docs, items):
    """Every window of every item against every place of every document."""
    windows = {}
    for item, text in items:
        words = words_of(text)
        n = min(13, len(words))
        for i in range(len(words) - n + 1 if words else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words, hit, found = words_of(text), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if names := windows.get(tuple(words[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words)))
    return out


def key(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r))


def run(spark, folder, documents, docs, items):
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("n", F.lit(1)).withColumn("grams", F.lit(2))
    path = folder(documents=documents(docs).withColumn("h", F.lit("x")), benchmark=bench)
    found = QUERIES["op10_winnowing_decontamination"].run(spark, path)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return [tuple(r) for r in found.select(*columns).collect()]


def test_same_as_every_window_against_every_place(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    found = QUERIES["op10_winnowing_decontamination"].run(spark, sf_dir)
    found = found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    assert key(map(tuple, found)) == key(plain(docs, items))
    assert any(r[2] for r in found)


def test_odd_rows_and_short_items(spark, documents, folder):
    span = " ".join(f"w{i}" for i in range(40))
    items = [(1, span), (2, "Short one"), (3, ""), (4, None), (5, span), (6, " ".join(["tie"] * 30)), (None, "w0 w1 x y z p q r s t u v w more")]
    docs = [
        (1, f"before {span.upper()} after"), (2, " ".join(span.split()[:12])), (3, " ".join(span.split()[5:18]) + " end"),
        (4, "a short, one!"), (5, None), (6, ""), (None, "short one"), (7, "tie " * 13), (8, "tie " * 12), (9, "tie " * 3000),
        (9, "tie " * 3000), (10, "x " * 70_000 + span), (11, "w0 w1 x y z p q r s t u v w"), (12, "é short onE é"),
    ]
    want = plain(docs, [(i, t) if i is not None else ("", t) for i, t in items])
    found = run(spark, folder, documents, docs, items)
    assert [r[:4] + r[5:] for r in key(found)] == [r[:4] + r[5:] for r in key(want)]


def test_empty_tables(spark, documents, folder, tmp_path):
    assert run(spark, folder, documents, [(1, "some words")], []) == [(1, 2, 0, 0, hashlib.sha256(b"").hexdigest(), False)]
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(documents([(1, "a")]).where("false"), empty).count() == 0


def test_clean_documents_stay_whole(spark, documents):
    span = " ".join(f"w{i}" for i in range(20))
    docs = documents([(1, span), (2, "clean"), (3, None), (3, None), (None, span)]).withColumn("hit_id", F.lit(1))
    items = spark.createDataFrame([(1, span)], "item_id long, text string")
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 3]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=13, max_size=13), st.lists(st.integers(0, 3), max_size=9), st.lists(st.integers(0, 3), max_size=9))
def test_a_shared_window_keeps_a_shared_gram(shared, before, after):
    words = [b"a", b"b", b"c", b"d"]
    one = decontaminate.word_hashes([words[i] for i in shared])
    two = decontaminate.word_hashes([words[i] for i in before + shared + after])
    at, h = decontaminate._places(one, 13, 13, 8)
    at2, h2 = decontaminate._places(two, 13, 13, 8)
    assert {(int(a) + len(before), int(x)) for a, x in zip(at, h)} <= {(int(a), int(x)) for a, x in zip(at2, h2)}
    assert len(at) and np.all(at < 6)
