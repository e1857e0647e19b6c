"""The corpus pipeline on planted documents, and its registration."""

import random
from collections import defaultdict

import __spark_entry__
import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from firmlens.llm import simhash
from firmlens.llm.queries import QUERIES
from firmlens.llm.tokens import read_tokenizer

TOKENIZER = Tokenizer.from_str(read_tokenizer())
LANGUAGES = {"en": "the of and house river tree walk", "de": "der und haus fluss baum gehen nicht", "fr": "le et maison fleuve arbre marcher ne"}


def prose(rng, lang, n):
    return " ".join(rng.choice(LANGUAGES[lang].split()) + rng.choice(["", "", "s", "en", "a"]) for _ in range(n)) + "."


@pytest.fixture
def planted(spark, documents, folder):
    rng = random.Random(12)
    clean = [(i, prose(rng, lang, rng.randint(30, 80)), lang) for i in range(60) for lang in [list(LANGUAGES)[i % 3]]]
    passage = prose(rng, "en", 40)
    copies = [(1000 + i, clean[5][1], "fr") for i in range(4)] + [(1010, clean[8][1].upper(), "fr")]
    tainted = [(2000, passage, "en"), (2001, f"{prose(rng, 'de', 30)} {passage} {prose(rng, 'de', 30)}", "de")]
    grazed = [(2002, f"{prose(rng, 'en', 900)} {' '.join(passage.split()[:14])}", "en")]
    key = "0123456789abcdef" * 2
    secret = [(3000, f'{prose(rng, "en", 40)} token = "{key}" {prose(rng, "en", 20)}', "en")]
    none = [(4000, None, "en"), (4001, "", None), (4002, "12 34 !!", "en")]
    docs = documents(clean + copies + tainted + grazed + secret + none).withColumn("fp", F.lit("x")).withColumn("hit_id", F.lit(1))
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    path = folder(documents=docs, benchmark=bench, labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    return path, {i: t for i, t, _ in clean}, secret[0], key


def test_every_stage_keeps_what_it_should(spark, planted):
    path, clean, (secret_id, secret_text, _), key = planted
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "secret_scan", "packing"]
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
        docs.write.parquet(f"{path}/after_{name}")
        docs = spark.read.parquet(f"{path}/after_{name}")
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
        if name != "packing":
            assert docs.columns == columns
        if name == "secret_scan":
            texts = {r.doc_id: (r.text, r.n_chars) for r in docs.collect()}
    kept = set(clean) | {2002, secret_id}
    # Null, empty and letterless texts go; of the copies the first stays (upper case is one, too).
    assert seen[0] == kept | {1000, 1001, 1002, 1003, 1010, 2000, 2001}
    assert seen[1] == kept | {2000, 2001}
    assert seen[2] == seen[3] == seen[4] == kept
    assert key not in texts[secret_id][0] and "[SECRET]" in texts[secret_id][0]
    assert all(n == len(t) for t, n in texts.values())
    assert all(texts[i][0] == t for i, t in clean.items())
    pieces = defaultdict(int)
    for r in docs.collect():
        pieces[r.doc_id] += r.length
    assert pieces == {i: len(TOKENIZER.encode(t, add_special_tokens=False).ids) + 1 for i, (t, _) in texts.items()}


def test_run_applies_the_stages(spark, planted):
    path, clean, (secret_id, _, _), _ = planted
    out = corpus_pipeline.run(spark, path)
    assert {r.doc_id for r in out.collect()} == set(clean) | {2002, secret_id}


def test_empty_tables(spark, documents, folder):
    path = folder(documents=documents([(1, "a")]).where("false"), benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert corpus_pipeline.run(spark, path).count() == 0


def test_one_query_for_each_operator():
    names = list(__spark_entry__.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert "pipeline" in names and set(QUERIES) <= set(names)


def test_pipeline_dedup_is_the_operator(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r.doc_id for r in simhash.keep_one(docs).select("doc_id").collect()}
    found = QUERIES["op8_simhash_near_dedup"].run(spark, sf_dir).collect()
    assert kept == {r.component_id for r in found}
