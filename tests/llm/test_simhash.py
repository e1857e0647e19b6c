import re

import xxhash
from pyspark.sql import functions as F

from firmlens.llm import simhash
from firmlens.llm.queries import QUERIES


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    distinct = sorted(fps)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    return {f: find(f) for f in fps}


def test_fingerprint_follows_the_definition():
    for text in ("", None, " \t", "One", "one TWO", "a b c", "Ünicode ÉÈ x y z", "w x y\x1cz q " * 9, "a b " * 50):
        assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


def test_same_components_as_all_pairs(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    fps = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    roots = plain_components(set(fps.values()))
    least = {}
    for i, f in fps.items():
        least[roots[f]] = min(i, least.get(roots[f], i))
    found = QUERIES["op8_simhash_near_dedup"].run(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in found) == sorted(
        (i, f"{f:016x}", least[roots[f]]) for i, f in fps.items()
    )


def test_chains_and_odd_distances(spark):
    for most in (1, 2, 3):
        values = [0, 0b11, 0b1111, 0b111111, (1 << 63) - 1, 1 << 40, (1 << 40) | 7, (7 << 30) | 1]
        df = spark.createDataFrame([(v,) for v in values], "fp long")
        pairs = {tuple(sorted(r)) for r in simhash.links(df, most).collect()}
        assert all((a ^ b).bit_count() <= most for a, b in pairs)
        group = {v: v for v in values}
        for _ in values:
            for a, b in pairs:
                group[a] = group[b] = min(group[a], group[b])
        want = {v: v for v in values}
        for _ in values:
            for a in values:
                for b in values:
                    if (a ^ b).bit_count() <= most:
                        want[a] = want[b] = min(want[a], want[b])
        assert group == want


def test_odd_rows(spark, documents):
    rows = [(3, None), (2, ""), (None, "x y z"), (5, "x y z"), (5, "x y z"), (None, None), (9, "long word " * 60_000)]
    found = simhash.near_duplicates(documents(rows)).collect()
    assert sorted((r.doc_id or -1, r.component_id) for r in found) == [(-1, 2), (-1, 5), (2, 2), (3, 2), (5, 5), (5, 5), (9, 9)]
    assert simhash.near_duplicates(documents(rows).where("false")).count() == 0


def test_one_row_of_each_group_stays(spark, documents):
    rows = [(3, None), (2, ""), (5, "x y z"), (5, "x y z"), (7, "X Y z"), (None, "other text is here")]
    docs = documents(rows).withColumn("kept_id", F.lit(1)).withColumn("fp", F.lit("a"))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == [(-1, "other text is here"), (2, ""), (5, "x y z")]
