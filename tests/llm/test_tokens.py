"""Token ids, plane files and packing against plain versions."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from firmlens.llm import packing, planes
from firmlens.llm.queries import QUERIES
from firmlens.llm.tokens import WordEncoder, read_tokenizer

CONTENT = read_tokenizer()
PLAIN = Tokenizer.from_str(CONTENT)
WORDS = WordEncoder(CONTENT, words_bytes=12_000, pieces_bytes=5_000)
ODD = ["", None, "a\xa0b \xa0 c", "<|endoftext|> <|EndOfText|>x<|startoftext|>", "É É ΑΣ İ ß\x1cq", "it's  WE'LL 12 3.5—x"]


def plain_ids(text):
    return np.array([*PLAIN.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def check_ids(texts):
    found = WORDS.with_end(pa.array(texts, pa.string()), 1)
    assert [f.tolist() for f in found] == [plain_ids(t).tolist() for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), max_size=4))
def test_ids_equal_the_tokenizer(texts):
    check_ids(texts)


def test_ids_of_odd_texts():
    check_ids(ODD)
    check_ids([])
    check_ids([None, ""])


@pytest.mark.parametrize("mode", ["byte", "bit"])
@pytest.mark.parametrize("top", [1, 2, 200, 50_000, 1 << 32])
def test_planes_round_trip(mode, top):
    for n in (1, 7, 8, 1000):
        ids = np.random.default_rng(n).integers(0, top, n, dtype=np.uint32)
        assert (planes.from_planes(planes.to_planes(ids, mode), n, mode) == ids).all()


def test_crc_of_joined_texts():
    for n in (0, 1, 999):
        a, b = random.Random(n).randbytes(77), random.Random(-n).randbytes(n)
        assert planes.join_crc32(zlib.crc32(a), zlib.crc32(b), n) == zlib.crc32(a + b)


def check_files(rows, found):
    start, want = 0, []
    for doc_id, ids in rows:
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == want


def test_files_give_every_document_back(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    found = QUERIES["op3_bit_planes"].run(spark, sf_dir).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    check_files([(r.doc_id, plain_ids(r.text)) for r in rows], found)


@pytest.mark.parametrize("mode", ["byte", "bit"])
def test_files_with_small_blocks_and_odd_rows(spark, documents, tmp_path, mode):
    rows = [*enumerate(ODD), (9, "same"), (9, "same"), (None, "no id"), (50, "long text here " * 9000)]
    planes.write(documents(rows), f"{tmp_path}/a", CONTENT, mode, block_ids=100)
    found = planes.digests(spark, f"{tmp_path}/a").select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    check_files([(i, plain_ids(t)) for i, t in [rows[-2], *rows[:-2], rows[-1]]], found)
    index = spark.read.parquet(f"{tmp_path}/a/index").orderBy("start").collect()
    assert [r.start for r in index] == [0, *np.cumsum([r.n for r in index])[:-1].tolist()]
    planes.write(documents(rows).where("false"), f"{tmp_path}/b", CONTENT, mode)
    assert planes.digests(spark, f"{tmp_path}/b").count() == 0


def piece_by_piece(sizes, capacity):
    """Best fit decreasing without any grouping: the load of each window."""
    room = []
    for size in sorted(sizes, reverse=True):
        fits = [(r, i) for i, r in enumerate(room) if r >= size]
        if fits:
            room[min(fits)[1]] -= size
        else:
            room.append(capacity - size)
    return sorted(room)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=120))
def test_plan_is_best_fit_decreasing(sizes):
    counts = {s: sizes.count(s) for s in sizes}
    at = defaultdict(list)
    plan = packing.best_fit_decreasing(counts, 30)
    for i, (size, rank, window, each, offset) in enumerate(plan.tolist()):
        after = plan[i + 1, 1] if i + 1 < len(plan) and plan[i + 1, 0] == size else counts[size]
        for j in range(after - rank):
            at[window + j // each].append((offset + j % each * size, size))
    for placed in at.values():
        end = 0
        for offset, size in sorted(placed):
            assert offset == end
            end += size
        assert end <= 30
    assert sorted(30 - sum(s for _, s in p) for p in at.values()) == piece_by_piece(sizes, 30)


def check_packing(rows, found):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for doc_id, ids in rows.items():
        at = 0
        for r in sorted(by_doc.pop(doc_id), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert not by_doc
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for placed in by_sequence.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 2048


def test_packing_of_the_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = QUERIES["op9_best_fit_packing"].run(spark, sf_dir).collect()
    check_packing({r.doc_id: plain_ids(r.text) for r in rows}, found)
    used = sum(r.length for r in found)
    assert used > 0.98 * 2048 * (max(r.sequence_id for r in found) + 1)


def test_packing_of_odd_rows(spark, documents, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", 3)
    rows = [*enumerate(ODD), (50, "long text here " * 9000), *((100 + i, "same words") for i in range(20))]
    found = packing.pack(documents(rows), CONTENT, with_ids=True)
    check_packing({i: plain_ids(t) for i, t in rows}, found.collect())
    windows = packing.sequences(found).collect()
    assert sum(len(w.ids) for w in windows) == sum(4 * len(plain_ids(t)) for _, t in rows)
    assert packing.pack(documents(rows).where("false"), CONTENT).count() == 0
    assert packing.pack(documents([(None, "a"), (1, "a"), (1, "a")]), CONTENT).count() == 3
