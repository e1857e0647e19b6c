"""The queries of this package by name, applied to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from firmlens.llm import ann, bpefst, decontaminate, dialogues, hpylm, langid, packing, planes, quality, secretscan, simhash, spelling, toxicity
from firmlens.llm.common import fold, table
from firmlens.llm.tokens import read_tokenizer
from firmlens.plans.registry import Query
from firmlens.session import scratch_path

QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = Query(run, sql)
        return run

    return add


@query("op3_bit_planes")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "planes")
    planes.write(table(spark, sf_dir, "documents"), path, read_tokenizer())
    return planes.digests(spark, path)


@query("op8_simhash_near_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query("op9_best_fit_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), read_tokenizer())


@query("op10_winnowing_decontamination")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


@query("op5_string_kernel_language")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = langid.fit(docs.where(~held_out))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), langid.predictions(model, F.col("text")).alias("found")
    ).select("doc_id", "held_out", "found.lang_pred", "found.score")


@query("op4_fourier_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = quality.fit(docs.where(~held_out), table(spark, sf_dir, "labels"))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), quality.scores(model, F.col("text")).alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op7_pattern_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs.where(~held_out), table(spark, sf_dir, "labels"))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), toxicity.scores(model, F.col("text")).alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op6_char_network_secrets")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = secretscan.fit(docs)
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), secretscan.spans(model, F.col("text")).alias("found"))

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["kind"] != "net")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"),
    )


@query("op1_inverted_multi_index")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op2_hierarchical_pitman_yor")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = hpylm.score(docs, fold(F.col("doc_id"), 5) != 1)
    return found.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op11_spelling_pairs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spellings(table(spark, sf_dir, "documents"))


@query("op12_byte_bpe_transducer")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    content, pattern = bpefst.read_ranks(), bpefst.public_pattern()
    ids = bpefst.encode(table(spark, sf_dir, "documents"), content, pattern)
    found = ids.select("doc_id", "ids", bpefst.decoded(content, F.col("ids")).alias("text"))
    return found.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op13_conversation_trie")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogues.prefix_trie(table(spark, sf_dir, "conversations"))
