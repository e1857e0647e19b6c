import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmlens.llm import dialogues
from firmlens.llm.queries import QUERIES

COLUMNS = "conv_id long, turn int, role string, text string"


def plain_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(v)] for c, v in turns.items()}
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                children[path[: d - 1]].add(path[:d])
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[b] for b in below) if below else 1
        size = len(node[-1][1].encode()) if node else 0
        saved[node] = sum(saved[b] for b in below) + (len(members[node]) - 1) * size
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(paths[c]) == len(node)))
        up = min(members[node[:-1]]) if node else None
        out.append((min(m), len(node), up, len(m), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(map(tuple, df.select(*names).collect()), key=str)


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 6000])
@pytest.mark.parametrize("up", [0.3, 0.55, 0.99])
def test_closing_places(n, up):
    rng, bits, open_, opened = np.random.default_rng(n), [], [], 0
    want = {}
    while opened < n or open_:
        if opened < n and (not open_ or rng.random() < up):
            open_.append(len(bits))
            bits.append(1)
            opened += 1
        else:
            want[open_.pop()] = len(bits)
            bits.append(0)
    tree = dialogues.Parentheses(np.array(bits))
    assert tree.findclose(tree.opens).tolist() == [want[i] for i in tree.opens.tolist()]


def test_query_on_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op13_conversation_trie"].run(spark, sf_dir)) == plain_trie(rows)


def odd_rows():
    rng = random.Random(5)
    rows = [
        (c, rng.choice([t, None, t]), rng.choice(["u", "a", None]), rng.choice(["x", "", "é", None]))
        for c in [*range(60), 101, 103, 204, 10**15 + 3]
        for t in range(rng.choice([1, 2, 5, 9, 20, 30]))
    ]
    rows += [(c, t, "u", "x") for c, n in ((7, 100), (8, 100), (9, 40), (71, 1), (72, 1)) for t in range(n)]
    return rows + [(None, 1, "a", "b")] + rows[:30]


@pytest.mark.parametrize("span", [64, 7, 2])
def test_odd_rows_and_cuts(spark, span):
    """Rows cut after any number of turns give the same trie; also turnless conversations, absent
    group heads, repeated turns and one conversation that is far longer than the others."""
    df = spark.createDataFrame(odd_rows(), COLUMNS).withColumn("conv", F.lit("x")).withColumn("HASH", F.lit(1))
    assert found(dialogues.prefix_trie(df, span=span)) == plain_trie(odd_rows())


def test_many_copies_over_all_shards(spark):
    """One conversation that most have, longer and shorter ones around it."""
    rows = [(c, t, "u", f"turn {t}") for c in range(3000) for t in range(3 if c % 50 else c % 7)]
    rows += [(9_000_005, t, "u", "very long " * 50_000) for t in range(2)]
    df = spark.createDataFrame(rows, COLUMNS)
    assert found(dialogues.prefix_trie(df)) == plain_trie(rows)


def test_empty_table(spark):
    assert found(dialogues.prefix_trie(spark.createDataFrame([], COLUMNS))) == []
    assert found(dialogues.prefix_trie(spark.createDataFrame([(None, 1, "u", "x")], COLUMNS))) == []
