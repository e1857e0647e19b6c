import hashlib
import random

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from firmlens.llm import bpefst
from firmlens.llm.queries import QUERIES

CONTENT, PATTERN = bpefst.read_ranks(), bpefst.public_pattern()
# Little room, so that the transducer is cleared and built again all the time.
ENCODER = bpefst.Encoder(CONTENT, PATTERN, pieces_bytes=4000, transitions=500)
PLAIN = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ENCODER.merges.rank, special_tokens={})
ODD = ["", None, " ", "\n\n  x", "it's WE'LL 123 ½ ٣", "漢字かな", "ȩ́", "\U0001f642" * 9, "\x00\x1c\x85\xa0 ﻿", "a" * 5000, "ab" * 3000]


def ids(text):
    return np.frombuffer(ENCODER.ids(text), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_ids_equal_the_library(text):
    assert ids(text) == PLAIN.encode_ordinary(text)
    assert "".join(bpefst.decode(ENCODER.merges.token, ids(text))) == text


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    assert ids(text) == PLAIN.encode_ordinary(text or "")
    assert "".join(bpefst.decode(ENCODER.merges.token, ids(text))) == (text or "")


def test_pieces_equal_plain_merging():
    """Also pieces that no text has: any bytes, tokens in a row."""
    rng, merges = random.Random(3), ENCODER.merges
    tokens = list(merges.rank)
    for _ in range(3000):
        piece = b"".join(rng.choice(tokens) for _ in range(rng.randint(1, 4)))
        if rng.random() < 0.5:
            piece = bytes(rng.choice(b"aeinst ") for _ in range(rng.randint(1, 25)))
        want = [merges.rank[t] for t in merges.merged(piece)[0]]
        assert list(ENCODER.transducer.tokens(piece)) == ENCODER.transducer.row(piece) == want
        assert all(merges.apart(a, b) for a, b in zip(want, want[1:]))


def test_neighbours_apart_as_merged():
    rng, merges = random.Random(4), ENCODER.merges
    ranks = list(merges.token)
    near = [(rng.choice(ranks), rng.choice(ranks)) for _ in range(2000)]
    near += [tuple(merges.rank[t] for t in (p[:i], p[i:])) for p in rng.sample(list(merges.rank), 500) for i in range(1, len(p)) if p[:i] in merges.rank and p[i:] in merges.rank]
    for a, b in near:
        whole = merges.merged(merges.token[a] + merges.token[b])[0]
        assert merges.apart(a, b) == (whole == [merges.token[a], merges.token[b]])


def test_tokens_come_before_the_piece_ends():
    """Output lags by a bounded number of bytes, whatever the piece's length."""
    read = []

    class Bytes:
        def __iter__(self):
            for i in range(100_000):
                read.append(i)
                yield b"internationalisation"[i % 20]

    lags, done = [], 0
    for token in bpefst.Transducer(ENCODER.merges).tokens(Bytes()):
        lags.append(len(read) - done)
        done += len(ENCODER.merges.token[token])
    assert max(lags) < 3 * bpefst.LOOK


def test_broken_bytes_in_any_cuts():
    rng = random.Random(5)
    some = [0x41, 0x7F, 0x80, 0xBF, 0xC0, 0xC2, 0xE0, 0xA0, 0xED, 0x9F, 0xF0, 0x90, 0xF4, 0x8F, 0xFF, 0xE2, 0x82, 0xAC]
    for _ in range(5000):
        data = bytes(rng.choice(some) for _ in range(rng.randint(0, 12)))
        machine, out, at = bpefst.Utf8Machine(), "", 0
        while at < len(data):
            step = rng.randint(1, 4)
            out += machine.feed(data[at : at + step])
            at += step
        assert out + machine.end() == data.decode("utf-8", "replace")


def check_rows(docs, found):
    want = []
    for doc_id, text in docs:
        plain = PLAIN.encode_ordinary(text or "")
        packed = np.array(plain, "<u4").tobytes()
        want.append((doc_id, len(plain), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)


def test_query_on_whole_table(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check_rows(docs, QUERIES["op12_byte_bpe_transducer"].run(spark, sf_dir).collect())


def test_odd_rows(spark, documents, folder):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "x"), (1, "same"), (1, "same"), (77, "very long é " * 100_000)]
    docs = documents(rows).withColumn("ids", F.lit(1)).withColumn("IDs_", F.lit(2))
    check_rows(rows, QUERIES["op12_byte_bpe_transducer"].run(spark, folder(documents=docs)).collect())


def test_empty_table_and_null_ids(spark, documents):
    empty = bpefst.encode(documents([(1, "x")]).where("false"), CONTENT, PATTERN)
    assert empty.columns == ["doc_id", "ids"] and empty.count() == 0
    nulls = spark.createDataFrame([(None,)], "ids binary").select(bpefst.decoded(CONTENT, F.col("ids")).alias("t"))
    assert nulls.first().t is None
