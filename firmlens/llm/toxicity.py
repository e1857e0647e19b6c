"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols (a lexicon of known words and of stems learned from labels). Four transducers,
composed into one table, rewrite insults and threats by what else their clause holds: a negation
shortly before, a verb of saying or a quote, a target. Each matched clause gets the weights of its
rewritten symbols; the score of a document is a logistic function of its matched clauses.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from firmlens.llm.common import share, texts
from firmlens.session import settle

#: Bounds of the sample of labelled rows and of the learned lexicon.
SAMPLE_ROWS = 20_000
STEMS = 4000
STEM_LETTERS = range(3, 10)
#: A stem counts if the evidence (likelihood ratio) is at least this, and its log odds, less one
#: standard error, which is its weight, at least that.
EVIDENCE = 20.0
LEAST_WEIGHT = 1.0
FOLDS = 3
RIDGE = 0.5
SEED = 11

# Words of the grammar.
INSULTS = "idiot idiots stupid moron morons clown clowns trash scum loser losers pathetic worthless disgusting dumb imbecile filth vermin".split()
THREATS = "kill hurt destroy beat burn smash punish attack hunt strangle".split()
TARGETS = "you your yours u ur they them their he him she her his these those people everyone".split()
NEGATIONS = "not no never neither nor isn aren wasn weren don doesn didn cannot without hardly nicht kein keine ne pas jamais nunca".split()
REPORTS = "said says say told tells wrote writes called calls reported reports claimed quoted according sagte dit dijo".split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, END = range(8)
#: Rewritten symbols.
PLAIN, AIMED, DENIED, QUOTED, MENACE, MENACE_AIMED = range(8, 14)
PATTERNS = (PLAIN, AIMED, DENIED, QUOTED, MENACE, MENACE_AIMED)
#: What a pattern keeps of a word's weight before anything is learned.
KEEPS = {PLAIN: 1.0, AIMED: 1.25, DENIED: 0.4, QUOTED: 0.5, MENACE: 0.5, MENACE_AIMED: 1.25}
SYMBOLS = range(14)
NEAR = 3

TOKENS = regex.compile(r"[\p{L}]+|[.!?;:\n]+|[\"“”«»]")
_CLASSES = {
    **dict.fromkeys(INSULTS, INSULT), **dict.fromkeys(THREATS, THREAT), **dict.fromkeys(TARGETS, TARGET),
    **dict.fromkeys(NEGATIONS, NEGATION), **dict.fromkeys(REPORTS, REPORT),
}


@dataclass(frozen=True)
class Transducer:
    """``step[state, symbol]`` and the symbol put out there. State 0 is the start."""

    step: np.ndarray
    out: np.ndarray

    @staticmethod
    def build(states: int, rule: Callable[[int, int], tuple[int, int]]) -> Transducer:
        arcs = [[rule(q, s) for s in SYMBOLS] for q in range(states)]
        return Transducer(np.array([[a[0] for a in row] for row in arcs]), np.array([[a[1] for a in row] for row in arcs]))

    def then(self, other: Transducer) -> Transducer:
        """The composition: what this one puts out is what the other one reads."""
        pairs, todo, step, out = {(0, 0): 0}, [(0, 0)], [], []
        for a, b in todo:
            step.append([])
            out.append([])
            for s in SYMBOLS:
                middle = self.out[a, s]
                pair = (int(self.step[a, s]), int(other.step[b, middle]))
                if pair not in pairs:
                    pairs[pair] = len(pairs)
                    todo.append(pair)
                step[-1].append(pairs[pair])
                out[-1].append(int(other.out[b, middle]))
        return Transducer(np.array(step), np.array(out))


def _negation(q: int, s: int) -> tuple[int, int]:
    """State: words left in which a negation still holds."""
    if s == END:
        return 0, s
    if s == NEGATION:
        return NEAR, s
    return max(0, q - 1), DENIED if s == INSULT and q else OTHER if s == THREAT and q else s


def _report(q: int, s: int) -> tuple[int, int]:
    """State: 1 after a verb of saying in the clause, 2 inside quotes."""
    if s == QUOTE:
        return (0 if q == 2 else 2), s
    if s == END:
        return 2 * (q == 2), s
    if s == REPORT and q == 0:
        return 1, s
    return q, (QUOTED if s in (INSULT, DENIED, THREAT) and q else s)


def _target(q: int, s: int) -> tuple[int, int]:
    """State: 1 after a target in the clause, 2 after an insult that had none yet."""
    if s == END:
        return 0, s
    if s == TARGET:
        return 1, AIMED if q == 2 else s
    if s == INSULT:
        return (q or 2), AIMED if q == 1 else PLAIN
    return q, s


def _menace(q: int, s: int) -> tuple[int, int]:
    """State: 1 after a threat; a target in the clause makes it one."""
    if s == END:
        return 0, s
    if s == THREAT:
        return 1, MENACE
    return q, MENACE_AIMED if s == TARGET and q else s


GRAMMAR = (
    Transducer.build(NEAR + 1, _negation)
    .then(Transducer.build(3, _report))
    .then(Transducer.build(3, _target))
    .then(Transducer.build(2, _menace))
)


@dataclass
class Lexicon:
    """Weights of words and of stems (the longest stem that a word begins with counts)."""

    words: dict[str, float]
    stems: dict[str, float]

    def __post_init__(self):
        self.seen: dict[str, tuple[int, float]] = {}

    def __getstate__(self):
        return {"words": self.words, "stems": self.stems, "seen": {}}

    def find(self, word: str) -> tuple[int, float]:
        known = self.seen.get(word)
        if known is None:
            known = self._look_up(word)
            if len(self.seen) < 400_000:
                self.seen[word] = known
        return known

    def _look_up(self, word: str) -> tuple[int, float]:
        kind = _CLASSES.get(word, OTHER)
        if not word[0].isalpha():
            return (END if word[0] in ".!?;:\n" else QUOTE), 0.0
        if word in self.words:
            return kind or INSULT, self.words[word]
        if kind == OTHER:
            for n in range(min(len(word), STEM_LETTERS.stop - 1), STEM_LETTERS.start - 1, -1):
                if (weight := self.stems.get(word[:n])) is not None:
                    return INSULT, weight
        return kind, 3.0 if kind == INSULT else 1.0


FEATURES = ("clauses", "strongest", "total", "density", "log_words", *(f"pattern_{p}" for p in PATTERNS))

#: What the constant and the features weigh before anything is learned.
PRIOR = np.array([-3.0, 0.5, 0.5, 0.5, 0.5, 0.0, *[0.0] * len(PATTERNS)])


def clauses(text: str | None, lexicon: Lexicon) -> tuple[int, list[tuple[float, Counter]]]:
    """The number of words, and the weight and patterns of each clause that matches."""
    tokens = TOKENS.findall((text or "").lower())
    find = lexicon.find
    found = [find(t) for t in tokens]
    if not any(kind == INSULT or kind == THREAT for kind, _ in found):
        return len(tokens), []
    state, out, weight, patterns, last = 0, [], 0.0, Counter(), 0.0
    for kind, w in [*found, (END, 0.0)]:
        symbol = int(GRAMMAR.out[state, kind])
        state = int(GRAMMAR.step[state, kind])
        if symbol >= PLAIN:
            patterns[symbol] += 1
            last = w if kind in (INSULT, THREAT) else last
            # A target after its word lifts what was counted plain.
            weight += KEEPS[symbol] * w if kind in (INSULT, THREAT) else 0.25 * last
        if symbol == END and patterns:
            out.append((weight, patterns))
            weight, patterns = 0.0, Counter()
    return len(tokens), out


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    words, matched = clauses(text, lexicon)
    weights = [w for w, _ in matched]
    total = sum(weights)
    patterns = sum((p for _, p in matched), Counter())
    return [
        math.log1p(len(matched)), max(weights, default=0.0), math.log1p(max(0.0, total)), math.log1p(100 * max(0.0, total) / (words + 20)),
        math.log1p(words) if matched else 0.0, *(math.log1p(patterns[p]) for p in PATTERNS),
    ]


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    weights: np.ndarray

    def scores(self, values) -> np.ndarray:
        x = np.array([[1.0, *features(t, self.lexicon)] for t in values]).reshape(-1, len(FEATURES) + 1)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def _stem_counts(rows: DataFrame) -> DataFrame:
    """In how many toxic and other documents of each fold each word (with a mark at its end) and stem
    occurs. Counts are summed in each batch, then by Spark."""
    names = [f"{kind}{k}" for kind in ("neg", "pos") for k in range(FOLDS)]

    def run(batches):
        for batch in batches:
            sums = [Counter() for _ in names]
            for text, label, fold in zip(texts(batch), batch.column("label").to_pylist(), batch.column("fold").to_pylist(), strict=True):
                words = {t for t in TOKENS.findall(text.lower()) if t[0].isalpha()}
                stems = {w[:n] for w in words for n in STEM_LETTERS if n <= len(w)}
                sums[FOLDS * label + fold].update(stems | {w + "$" for w in words})
            keys = list(set().union(*sums))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([s[k] for k in keys], pa.int64()) for s in sums)], ["stem", *names])

    parts = rows.select("text", "label", "fold").mapInArrow(run, "stem string, " + ", ".join(f"{n} long" for n in names))
    return parts.groupBy("stem").agg(*(F.sum(n).alias(n) for n in names))


def _lexicon(counts: DataFrame, sizes: dict[tuple[int, int], int], skip: int | None = None, stems: int = STEMS) -> Lexicon:
    """Words and stems that are far likelier in toxic documents, from all folds but ``skip``."""
    folds = [k for k in range(FOLDS) if k != skip]
    n1, n0 = (sum(sizes.get((label, k), 0) for k in folds) for label in (1, 0))
    if not n1 or not n0:
        return Lexicon({}, {})
    pos, neg = (sum((F.col(f"{kind}{k}") for k in folds), F.lit(0)).cast("double") for kind in ("pos", "neg"))
    odds = F.log((pos + 0.5) / (n1 + 1.0)) - F.log((neg + 0.5) / (n0 + 1.0))
    weight = odds - F.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5))
    expected = (pos + neg) * (n1 / (n1 + n0))
    evidence = 2 * (pos * F.log(pos / expected) + F.when(neg > 0, neg * F.log(neg / (pos + neg - expected))).otherwise(0.0))
    found = (
        counts.where(pos >= 4).select("stem", weight.alias("weight"), evidence.alias("evidence"))
        .where((F.col("weight") >= LEAST_WEIGHT) & (F.col("evidence") >= EVIDENCE))
        .orderBy(F.desc("evidence"), "stem").limit(stems).collect()
    )
    words = {r["stem"][:-1]: r["weight"] for r in found if r["stem"].endswith("$")}
    return Lexicon(words, {r["stem"]: r["weight"] for r in found if not r["stem"].endswith("$")})


def _sizes(rows: DataFrame) -> dict[tuple[int, int], int]:
    return {(r["label"], r["fold"]): r["count"] for r in rows.groupBy("label", "fold").count().collect()}


def learn_lexicon(rows: DataFrame, stems: int = STEMS) -> Lexicon:
    """The lexicon of all ``rows`` (text, label, fold)."""
    return _lexicon(_stem_counts(rows), _sizes(rows), None, stems)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Logistic regression drawn towards ``PRIOR``: Newton steps, halved until the loss falls, to
    where it falls no more."""
    sign = np.where(y > 0, -1.0, 1.0)

    def loss(w: np.ndarray) -> float:
        return float(np.logaddexp(0, sign * (x @ w)).sum() + ridge / 2 * ((w - PRIOR) ** 2).sum())

    w = PRIOR.copy()
    now = loss(w)
    while True:
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        gradient = x.T @ (p - y) + ridge * (w - PRIOR)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), gradient)
        while (then := loss(w - step)) > now and np.abs(step).max() > 1e-9:
            step = step / 2
        if not then < now - 1e-9 * abs(now):
            return w
        w, now = w - step, then


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn the stems' weights and how much the patterns say from labelled documents.

    About ``sample_rows`` labelled rows are drawn by a hash of doc_id. What the patterns say is weighed
    on each fold of them with a lexicon from the other folds, as unseen documents meet it; the lexicon
    itself is learned from all. Only the strongest stems and the features of the sample come to the
    driver. Without labels of both kinds the grammar's own words and weights are used.
    """
    marks = labels.where(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("label"))
    number = docs.select("doc_id").join(marks, "doc_id").count()
    draw = share(F.col("doc_id"), SEED) < min(1.0, sample_rows / max(1, number))
    fold = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(FOLDS)).cast("int")
    rows = docs.where(draw).select("doc_id", "text").join(marks.where(draw), "doc_id")
    rows = settle(rows.select(fold.alias("fold"), "label", "text"))
    sizes, counts = _sizes(rows), settle(_stem_counts(rows).where(sum((F.col(f"pos{k}") for k in range(FOLDS)), F.lit(0)) >= 4))
    others = [_lexicon(counts, sizes, k) for k in range(FOLDS)]

    def measure(batches):
        for batch in batches:
            found = [features(t, others[k]) for t, k in zip(texts(batch), batch.column("fold").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found, pa.list_(pa.float64()))], ["label", "x"])

    seen = rows.mapInArrow(measure, "label int, x array<double>").collect()
    y = np.array([r["label"] for r in seen], float)
    lexicon = _lexicon(counts, sizes)
    if len(set(y.tolist())) < 2:
        return Model(lexicon, PRIOR)
    x = np.array([[1.0, *r["x"]] for r in seen])
    order = np.lexsort([*x.T, y])
    return Model(lexicon, _logistic(x[order], y[order]))


def scores(model: Model, text: Column) -> Column:
    """P(toxic) of each whole text; null is the empty text, which matches nothing."""

    @F.pandas_udf("double")
    def run(part: pd.Series) -> pd.Series:
        return pd.Series(model.scores(part.tolist()), dtype=float)

    return run(text)
