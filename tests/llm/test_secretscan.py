import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from firmlens.llm import secretscan
from firmlens.llm.queries import QUERIES

PLAIN = (
    ("assign", re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)


def plain(text):
    found = []
    for order, (kind, pattern, holds) in enumerate(PLAIN):
        found += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in pattern.finditer(text or "") if holds(m)]
    return [s for _, _, s in sorted(found)]


HEX = "0123456789abcdef" * 3
ODD = [
    None, "", "nothing here", f'token = "{HEX[:40]}" rest', "secret=token: abcdefgh", "Password : 'abc' PASSWD=abcdefg", "ſecret=abcdefgh toKen=abcdefgh",
    "AKIA" + "A1" * 8, "AKIA" + "A1" * 7 + "B", "AKIAAKIA" + "Z" * 14, "xAKIA" + "0" * 30 + "y", "abcdefabcdefabcdefabcdef", "a" * 23, "g" + "a" * 24 + "G" + "b" * 30,
    f"é\U0001f600 api_key={HEX} {HEX}é{HEX}", "api-key=abcdefgh apikey=x.y-z_/+=", "token==abcdefgh token=:=abcdefgh", "f" * 100_000, "word " * 30_000 + f"secret={HEX}",
    "tokentoken=abcdef", "password\"  :  \"hunter22\"", "00000000000000000000000000000000",
]


def test_base_spans_follow_the_patterns():
    for text in ODD:
        base, _ = secretscan.candidates(text)
        assert [f"{secretscan.KINDS[k]}:{a}:{b}" for a, b, k in base] == plain(text)


def test_base_spans_on_noise():
    rng = random.Random(4)
    parts = ["token", "Secret", "api_key", "passwd", "AKIA", "0f", "abc", "DEAD", "=", ":", " ", '"', "'", "-", "é", "xyz9", HEX[:20], "Z" * 9]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 14)))
        base, _ = secretscan.candidates(text)
        assert [f"{secretscan.KINDS[k]}:{a}:{b}" for a, b, k in base] == plain(text)


def test_gradients_are_those_of_the_loss():
    net = secretscan.Network.new()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 256, (5, secretscan.WIDTH)).astype(np.uint8)
    labels = np.array([0, 1, 1, 0, 1], float)

    def loss():
        z = net.forward(rows)[0]
        return np.mean(np.log1p(np.exp(z)) - labels * z)

    found = net.gradients(rows, labels)
    for name, value in net.p.items():
        for at in [tuple(rng.integers(0, s) for s in value.shape) for _ in range(6)]:
            value[at] += 1e-5
            up = loss()
            value[at] -= 2e-5
            down = loss()
            value[at] += 1e-5
            assert abs(found[name][at] - (up - down) / 2e-5) < 2e-4


def secrets(rng, n):
    return [("".join(rng.choices("0123456789abcdef", k=40)), f"AKIA{''.join(rng.choices('ABCDEFGHIJ0123456789', k=16))}") for _ in range(n)]


def corpus(n=160):
    rng = random.Random(8)
    rows = []
    for i, (digest, key) in enumerate(secrets(rng, n)):
        number = "".join(rng.choices("0123456789", k=16))
        rows.append((1000 + i, f'The plain words of {number} here. token = "{digest}" more words, {key} and the end of it'))
    return rows


def test_query_on_the_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = {r.doc_id: r for r in QUERIES["op6_char_network_secrets"].run(spark, sf_dir).collect()}
    assert len(found) == len(rows)
    for r in rows:
        want, got = plain(r.text), found[r.doc_id]
        assert got.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [s for s in got.spans.split(",") if s and not s.startswith("net")] == want
        assert (got.n_assign, got.n_access, got.n_hex) == tuple(sum(s.startswith(k) for s in want) for k in ("assign", "access", "hex"))


def test_network_finds_what_the_patterns_miss_and_leaves_numbers(spark, documents):
    model = secretscan.fit(documents(corpus()))
    assert model.network is not None and 0 < model.threshold < 1
    rng = random.Random(99)
    missed = [f"see {d[:20]}-{d[20:].upper()} there" for d, _ in secrets(rng, 30)]
    plain_texts = [f"The plain words of {rng.randint(10**15, 10**16 - 1)} here" for _ in range(30)]
    assert not any(plain(t) for t in missed + plain_texts)
    assert sum(bool(s) for s in model.scan(missed)) > sum(bool(s) for s in model.scan(plain_texts))
    assert sum(bool(s) for s in model.scan(plain_texts)) <= 3
    long = "x" * 20 + "".join(rng.choices("0123456789abcdefGH", k=5000))
    assert all(a < b <= len(long) for a, b, _, _ in model.scan([long])[0])


def test_recall_constrained_threshold():
    model = secretscan.Model(secretscan.Network.new())
    slope, offset = secretscan.calibrate(np.array([-3.0, -2, -1, 1, 2, 3]), np.array([0.0, 0, 1, 0, 1, 1]))
    assert slope > 0 and np.all(np.diff(secretscan.Model(None, slope, offset).probabilities(np.arange(5.0))) > 0)
    assert model.threshold == 1.0


def test_odd_rows_are_redacted(spark, documents):
    rows = [*enumerate(ODD), (None, f"secret={HEX}"), (3, "twice"), (3, "twice"), *corpus()]
    docs = documents(rows).withColumn("found", F.lit(1)).withColumn("redacted", F.lit("x"))
    done = secretscan.without_secrets(secretscan.fit(docs), docs)
    assert done.columns == docs.columns and done.count() == docs.count()
    out = done.collect()
    assert not any(plain(r.text) for r in out if r.doc_id != 4)
    assert all(r.n_chars == len(r.text or "") for r in out)
    assert sum(r.text == "twice" for r in out) == 2 and sum(r.text is None for r in out) == 1
    none = secretscan.fit(docs.where("false"))
    assert none.network is None and none.scan(["token=abcdefg", None]) == [[(0, 13, 0, None)], []]
    assert secretscan.without_secrets(none, docs.where("false")).count() == 0


def test_every_finding_is_learned(spark, documents, monkeypatch):
    """Blocks hold each distinct finding once, however many there are, and their network finds secrets."""
    rows = corpus(2100)
    monkeypatch.setattr(secretscan, "EPOCHS", 2)
    seen = []
    packed = secretscan._blocks
    monkeypatch.setattr(secretscan, "_blocks", lambda drawn, n: seen.append(packed(drawn, n)) or seen[-1])
    # Blocks last as long as the fit, so they are looked at inside it.
    trained, found = secretscan._trained, {}

    def looked(blocks):
        found.update((len(found), [(r["block"], len(r["labels"]), sum(r["labels"])) for r in b.collect()]) for b in seen)
        return trained(blocks)

    monkeypatch.setattr(secretscan, "_trained", looked)
    model = secretscan.fit(documents(rows))
    parts = [p for b in found.values() for p in b]
    want = secretscan.findings(documents(rows)).distinct().groupBy().agg(F.count("label"), F.sum("label")).first()
    assert want[1] >= 2 * 2100 and (sum(n for _, n, _ in parts), sum(n for _, _, n in parts)) == tuple(want)
    assert len(found[0]) > 1 and model.network is not None
    rng = random.Random(99)
    assert sum(bool(s) for s in model.scan([f"see {d[:20]}-{d[20:].upper()} there" for d, _ in secrets(rng, 30)])) > 20


def test_threshold_is_the_exact_order_statistic(spark, monkeypatch):
    monkeypatch.setattr(secretscan, "FEW", 3)
    rng = np.random.default_rng(1)
    for values in (rng.random(2000) ** 9, np.repeat([0.25, 0.5, 1.0], 40), np.zeros(7)):
        parts = [(i, bytearray(v.tobytes()), bytearray(len(v))) for i, v in enumerate(np.array_split(values, 5))]
        blocks = spark.createDataFrame(parts, "block int, out binary, labels binary")
        for at in (0, len(values) // 50, len(values) - 1):
            assert secretscan._smallest(blocks, lambda out, _: np.frombuffer(out), at) == np.sort(values)[at]
