"""Language, quality and toxicity: definitions, odd rows, held-out accuracy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmlens.llm import langid, quality, toxicity
from firmlens.llm.common import fold
from firmlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, "1234 5678 !?"), (4, "A."), (None, "some words here"), (5, "word " * 60_000), (5, "twice"), (5, "twice"), (6, "\U0001f600 你好")]


def grams(text):
    """Letters in lower case, anything else one space, all n-grams."""
    import itertools

    text = "".join(c if c.isalpha() else " " for c in text.lower()).lstrip()
    text = "".join(c for c, before in zip(text, "x" + text) if c != " " or before != " ")
    return {text[i : i + n] for n in range(1, langid.LONGEST + 1) for i in range(len(text) - n + 1)}


def test_kernel_is_the_share_of_common_ngrams():
    a, b = "The cat sat, on the mat 99 times.", "the Dog sat... on a log"
    one, two = langid.presence(a), langid.presence(b)
    exact = len(grams(a) & grams(b)) / np.sqrt(len(grams(a)) * len(grams(b)))
    hashed = float((langid._unit(one[None]) @ langid._unit(two[None]).T)[0, 0])
    assert abs(one.sum() - len(grams(a))) <= 2 and abs(exact - hashed) < 0.03
    assert langid.presence("12 !") is None and langid.presence(None) is None


def test_ridge_on_landmarks_equals_plain_formulas(spark, documents):
    rows = [(i, ("the dog and cat %d " if i % 2 else "le chien et chat %d ") % i * 3, "en" if i % 2 else "fr") for i in range(40)]
    model = langid.fit(documents(rows), landmarks=1000, rows=1000, ridge=1e-3)
    x = np.stack([langid.presence(t) for _, t, _ in rows])
    x = x / np.sqrt(x.sum(1, keepdims=True))
    kernel, wanted = (x @ x.T).astype(float), np.array([[r[2] == "en", r[2] == "fr"] for r in rows], float)
    # With every row a landmark, the same function as the weighted ridge over the whole kernel.
    weight = np.full(40, 1 / 20)
    want = kernel @ np.linalg.solve(np.diag(weight) @ kernel + 1e-3 * np.eye(40), weight[:, None] * wanted)
    got = model.scores(np.stack([langid.presence(t) for _, t, _ in rows]))
    assert model.languages == ["en", "fr"] and np.abs(want - got).max() < 5e-3


def test_language_is_learned_from_every_row(spark, documents):
    """A word that only a few of very many rows have counts."""
    rows = [(i, ("dog and cat %d " if i % 2 else "chien et chat %d ") % i, "en" if i % 2 else "fr") for i in range(4000)]
    docs = documents(rows)
    whole, part = langid.fit(docs, landmarks=10), langid.fit(docs, landmarks=10, rows=400)
    x = np.stack([langid.presence(t) for _, t, _ in rows])
    kernel = ((x / np.sqrt(x.sum(1, keepdims=True))) @ whole.landmarks).astype(float)
    gram = (whole.landmarks.T @ whole.landmarks).astype(float)
    values, vectors = np.linalg.eigh(gram)
    kept = values > 1e-6 * values.max()
    nystrom = vectors[:, kept] / np.sqrt(values[kept])
    lifted = kernel @ nystrom
    wanted = np.array([[r[2] == "en", r[2] == "fr"] for r in rows], float)
    want = nystrom @ np.linalg.solve(lifted.T @ lifted / 2000 + langid.RIDGE * np.eye(kept.sum()), lifted.T @ wanted / 2000)
    assert np.abs(kernel @ want - kernel @ whole.weights).max() < 1e-3
    assert np.abs(kernel @ part.weights - kernel @ whole.weights).max() > 1e-9


def test_language_held_out(spark):
    found = QUERIES["op5_string_kernel_language"].run(spark, SF).alias("f").join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id")
    rows = found.where("held_out").select("lang", "lang_pred", "f.score").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark, documents):
    docs = documents([*ODD, *((100 + i, f"the cat and dog {i}", "en") for i in range(20)), *((200 + i, f"der hund und katze {i}", "de") for i in range(20))])
    docs = docs.withColumn("found", F.lit(1)).withColumn("lang_pred", F.lit("x"))
    model = langid.fit(docs.where("doc_id >= 100"))
    kept = langid.speaks(model, docs)
    assert kept.columns == docs.columns
    gone = [r.text for r in docs.exceptAll(kept).collect()]
    assert {None, "", "1234 5678 !?"} <= set(gone)
    empty = langid.fit(docs.where("false"))
    assert empty.predict(["word", None]) == [("und", 0.0), ("und", 0.0)]
    assert langid.speaks(empty, docs).count() == docs.count() - 3
    assert langid.speaks(model, docs.where("false")).count() == 0


def test_isotonic_is_the_best_rising_curve():
    rng = np.random.default_rng(1)
    scores, labels = rng.integers(0, 12, 60).astype(float), rng.integers(0, 2, 60).astype(float)
    x, y = quality.isotonic(scores, labels)
    assert (np.diff(y) >= 0).all()
    # The pooled means by the min-max formula.
    at = np.unique(scores)
    means = {}
    for v in at:
        means[v] = max(
            min(labels[(scores >= a) & (scores <= b)].mean() for b in at if b >= v) for a in at if a <= v
        )
    assert np.allclose(np.interp(at, x, y), [means[v] for v in at])


def test_fourier_features_approach_the_gaussian_kernel():
    width, features = len(quality.NAMES), 60_000
    g = np.random.default_rng(3)
    model = quality.Model(np.zeros(width), np.ones(width), g.normal(size=(width, features)) / quality.BANDWIDTH, g.uniform(0, 2 * np.pi, features), np.zeros(1), (np.zeros(0), np.zeros(0)))
    x = g.normal(size=(6, width))
    z = model.features(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(2) / (2 * quality.BANDWIDTH**2))
    assert np.abs(z @ z.T - exact).max() < 0.03


@pytest.mark.parametrize("name, label, folds, held", [("op4_fourier_quality", "quality", 3, 1), ("op7_pattern_toxicity", "toxic", 5, 0)])
def test_held_out_scores(spark, name, label, folds, held):
    sf = "/root/testdata/sf0.1"  # enough labels for a handful of each kind in each language
    found = QUERIES[name].run(spark, sf)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").withColumn("fold", fold(F.col("doc_id"), folds)).collect()
    assert all(r.held_out == (r.fold == held) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    unseen = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r[label] for r in unseen]) > 0.98
    one, zero = ([r.score for r in unseen if r[label] == v] for v in (1, 0))
    assert np.mean([(a > b) + (a == b) / 2 for a in one for b in zero]) > 0.95


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_odd_rows_and_labels(spark, documents, module, label):
    good = [(100 + i, "The plain text is here, as it was. " * (1 + i % 5)) for i in range(30)]
    bad = [(200 + i, "you stupid idiot #$%& !! " * (1 + i % 5)) for i in range(30)]
    docs = documents([*ODD, *good, *bad]).withColumn("label", F.lit("x")).withColumn("score", F.lit(1))
    marks = [(i, None) for i in range(3)] + [(i, 7) for i in range(3)] + [(None, 1), (9999, 1), (100, 0), (100, 0)] + [(i, int(i >= 200)) for i, _ in good + bad]
    labels = spark.createDataFrame(marks, f"doc_id long, {label} int").withColumn("text", F.lit("clash"))
    model = module.fit(docs, labels, label)
    found = docs.select("doc_id", module.scores(model, F.col("text")).alias("s")).collect()
    assert len(found) == docs.count() and all(0 <= r.s <= 1 for r in found)
    assert min(r.s for r in found if (r.doc_id or 0) >= 200) > max(r.s for r in found if 100 <= (r.doc_id or 0) < 200)
    for some in (labels.where("false"), labels.where(f"{label} = 1")):
        model = module.fit(docs, some, label)
        assert all(0 <= r.s <= 1 for r in docs.select(module.scores(model, F.col("text")).alias("s")).collect())
    assert docs.where("false").select(module.scores(model, F.col("text")).alias("s")).count() == 0


def weight(text):
    lexicon = toxicity.Lexicon({}, {"gront": 2.0, "gronter": 3.0})
    _, found = toxicity.clauses(text, lexicon)
    return [dict(p) for _, p in found], sum(w for w, _ in found)


def test_grammar_reads_clauses():
    t = toxicity
    assert weight("A clean text. It stays so!") == ([], 0)
    assert weight("what trash. And more")[0] == [{t.PLAIN: 1}]
    assert weight("you are trash")[0] == [{t.AIMED: 1}]
    assert weight("trash, that is what you are")[0] == [{t.PLAIN: 1, t.AIMED: 1}]
    assert weight("you are not trash")[0] == [{t.DENIED: 1}]
    assert weight("not at all in that place is it trash")[0] == [{t.PLAIN: 1}]
    assert weight("He said: you moron")[0] == [{t.AIMED: 1}]
    assert weight("he said you moron")[0] == [{t.QUOTED: 1}]
    assert weight("“you moron” it read")[0] == [{t.QUOTED: 1}]
    assert weight("I will kill you. Kill the light")[0] == [{t.MENACE: 1, t.MENACE_AIMED: 1}, {t.MENACE: 1}]
    assert weight("trash. trash")[0] == [{t.PLAIN: 1}, {t.PLAIN: 1}]
    aimed, plain, denied = (weight(x)[1] for x in ("you trash", "the trash", "not trash"))
    assert aimed > plain > denied > 0
    assert weight("grontig x")[1] == 2.0 and weight("grontered x")[1] == 3.0


def test_composition_reads_like_one_after_the_other():
    t, rng = toxicity, np.random.default_rng(2)
    parts = [t.Transducer.build(t.NEAR + 1, t._negation), t.Transducer.build(3, t._report), t.Transducer.build(3, t._target), t.Transducer.build(2, t._menace)]
    for _ in range(50):
        symbols = rng.integers(0, 8, 30).tolist()
        chained = symbols
        for part in parts:
            q, out = 0, []
            for s in chained:
                out.append(int(part.out[q, s]))
                q = int(part.step[q, s])
            chained = out
        q, whole = 0, []
        for s in symbols:
            whole.append(int(t.GRAMMAR.out[q, s]))
            q = int(t.GRAMMAR.step[q, s])
        assert whole == chained


def test_stems_are_learned_by_their_odds(spark, documents):
    rows = [("vleeb one two", 1)] * 20 + [("vleeban three", 1)] * 20 + [("one two three four", 0)] * 200
    rows = [(*r, i % 3) for i, r in enumerate(rows)]
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, label int, fold int"))
    assert lexicon.find("vleebix")[0] == toxicity.INSULT and lexicon.find("vleeb")[1] > 3
    assert lexicon.find("three")[0] == toxicity.OTHER
