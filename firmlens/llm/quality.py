"""Document quality: random Fourier features of text statistics, ridge scores, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from firmlens.llm.common import share, texts
from firmlens.session import settle

#: Bound of the labelled rows that are fitted on, drawn by a hash of the row.
SAMPLE_ROWS = 20_000
FEATURES = 384
#: Width of the Gaussian kernel, in standard deviations of each statistic.
BANDWIDTH = 6.0
RIDGE = 1e-4
FOLDS = 5
SEED = 7
#: Tasks that sum the normal equations of the bounded sample.
SUM_TASKS = 8

_CLASSES = {
    "lower": bytes(range(97, 123)), "upper": bytes(range(65, 91)), "digit": bytes(range(48, 58)),
    "stop": b".?", "comma": b",;:", "shout": b"!", "quote": b"\"'`", "open": b"()[]{}<>", "bar": b"|\\/", "link": b"-_=+*~^",
    "symbol": b"#$%&@", "space": b" ", "line": b"\n", "control": bytes([*range(10), *range(11, 32), 127]),
}
_BYTE_CLASS = np.full(256, len(_CLASSES), np.int64)  # beyond ASCII
for _i, _chars in enumerate(_CLASSES.values()):
    _BYTE_CLASS[list(_chars)] = _i

NAMES = (
    "log_bytes", "log_words", "log_lines", *(f"share_{c}" for c in _CLASSES), "share_wide",
    "mean_word", "short_words", "long_words", "distinct_words", "top_word", "repeated_lines", "repeated_triples",
    "mean_line", "longest_line", "marked_words", "capital_words", "entropy",
)


def statistics(text: str | None) -> np.ndarray:
    """``NAMES`` of a whole text; of an empty text the shares are zero."""
    data = (text or "").encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    classes = np.bincount(_BYTE_CLASS, weights=counts, minlength=len(_CLASSES) + 1)
    size = max(1, len(data))
    words, lines = data.split(), data.split(b"\n")
    n, m = max(1, len(words)), len(lines)
    codes, distinct = pd.factorize(np.array(words, object)) if words else (np.zeros(0, np.int64), ())
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    often = np.bincount(codes).max() / n if words else 0.0
    triples = codes[:-2] * (len(distinct) + 1) ** 2 + codes[1:-1] * (len(distinct) + 1) + codes[2:] if len(words) > 2 else codes[:0]
    line_sizes = [len(x) for x in lines]
    seen = counts[counts > 0] / size
    last = [w[-1] for w in words]
    first = [w[0] for w in words]
    return np.array(
        [
            np.log1p(len(data)), np.log1p(len(words)), np.log1p(m), *(classes / size),
            lengths.mean() if words else 0.0, (lengths <= 3).sum() / n, (lengths >= 12).sum() / n, len(distinct) / n, often,
            1 - len(set(lines)) / m, 1 - len(np.unique(triples)) / max(1, len(triples)),
            np.log1p(len(data) / m), max(line_sizes) / size,
            sum(not (97 <= c <= 122 or 65 <= c <= 90 or c > 127) for c in last) / n, sum(65 <= c <= 90 for c in first) / n,
            float(-(seen * np.log(seen)).sum()),
        ]
    )


def isotonic(scores: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots (score, share of label 1) that never fall. Between knots the
    curve is straight; equal scores are one point."""
    at, place = np.unique(scores, return_inverse=True)
    weights = np.bincount(place).astype(float)
    means = np.bincount(place, labels) / weights
    blocks: list[list[float]] = []  # mean, weight, first score, last score
    for mean, weight, x in zip(means.tolist(), weights.tolist(), at.tolist(), strict=True):
        blocks.append([mean, weight, x, x])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            mean2, weight2, _, end = blocks.pop()
            last = blocks[-1]
            last[0] = (last[0] * last[1] + mean2 * weight2) / (last[1] + weight2)
            last[1] += weight2
            last[3] = end
    knots = [(x, b[0]) for b in blocks for x in ([b[2], b[3]] if b[3] > b[2] else [b[2]])]
    return np.array([x for x, _ in knots]), np.array([y for _, y in knots])


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: tuple[np.ndarray, np.ndarray]

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Random Fourier features of standardised statistics, and a constant."""
        z = np.clip((stats - self.mean) / self.scale, -8, 8) @ self.directions + self.phases
        return np.hstack([np.cos(z) * np.sqrt(2 / len(self.phases)), np.ones((len(stats), 1))])

    def scores(self, stats: np.ndarray) -> np.ndarray:
        if not len(self.knots[0]):
            return np.full(len(stats), 0.5)
        return np.clip(np.interp(self.features(stats) @ self.weights, *self.knots), 0.0, 1.0)


def _sums(rows: DataFrame, width: int, part) -> np.ndarray:
    """``part(stats, label, fold)`` gives the sums of a batch, rows of ``width``; added up by task, then here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                stats = np.array(batch.column("stats").to_pylist())
                sums = part(stats, np.array(batch.column("label"), float), np.array(batch.column("fold")))
                total = sums if total is None else total + sums
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": [total.reshape(-1, width).tobytes()]})

    # One row per task of a fixed number of tasks.
    found = [np.frombuffer(r["sums"]).reshape(-1, width) for r in rows.mapInArrow(run, "sums binary").toLocalIterator()]
    return np.sum(found, axis=0) if found else np.zeros((0, width))


def labelled(docs: DataFrame, labels: DataFrame, label: str, sample_rows: int) -> DataFrame:
    """text and label (0 or 1) of about ``sample_rows`` labelled rows (all, if fewer), drawn by hash.

    Documents without a label and labels without a document take no part; a document with several
    labels counts with each of them."""
    marks = labels.where(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("double").alias("label"))
    number = docs.select("doc_id").join(marks, "doc_id").count()
    rate = min(1.0, sample_rows / max(1, number))
    # Rows are drawn on both sides before the join, so no more than the sample's texts are moved.
    draw = share(F.col("doc_id"), SEED) < rate
    return docs.where(draw).select("doc_id", "text").join(marks.where(draw), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS, features: int = FEATURES) -> Model:
    """Learn P(label = 1) from the statistics of labelled documents.

    Only sums over the sample come to the driver: of the statistics, then the normal equations of
    each fold, then for the isotonic curve the scores of each row by a model that hasn't seen its
    fold. Without rows of both labels the score is the same for every text.
    """

    def measure(batches):
        for batch in batches:
            found = [statistics(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("fold"), batch.column("label"), pa.array([f.tolist() for f in found], pa.list_(pa.float64()))], ["fold", "label", "stats"]
            )

    drawn = labelled(docs, labels, label, sample_rows)
    fold = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "text"), F.lit(FOLDS)).cast("int")
    rows = settle(drawn.select(fold.alias("fold"), "label", "text").mapInArrow(measure, "fold int, label double, stats array<double>"))
    rows = rows.repartition(SUM_TASKS)
    width = len(NAMES)
    generator = np.random.default_rng(SEED)
    directions = generator.normal(size=(width, features)) / BANDWIDTH
    phases = generator.uniform(0, 2 * np.pi, features)
    none = Model(np.zeros(width), np.ones(width), directions, phases, np.zeros(features + 1), (np.zeros(0), np.zeros(0)))

    moments = _sums(rows, width, lambda s, y, _: np.vstack([s.sum(0), (s**2).sum(0), np.full(width, len(s)), np.full(width, y.sum())]))
    if not len(moments) or not 0 < moments[3, 0] < moments[2, 0]:
        share_of_one = moments[3, 0] / moments[2, 0] if len(moments) else 0.5
        knots = (np.zeros(1), np.array([share_of_one]))
        return Model(none.mean, none.scale, directions, phases, none.weights, knots)
    n = moments[2, 0]
    mean = moments[0] / n
    deviation = np.sqrt(np.maximum(moments[1] / n - mean**2, 0))
    base = Model(mean, np.where(deviation > 1e-9, deviation, 1.0), directions, phases, none.weights, none.knots)

    def normal(stats, y, folds):
        z = base.features(stats)
        return np.stack([z[folds == k].T @ np.hstack([z[folds == k], y[folds == k, None]]) for k in range(FOLDS)])

    size = features + 1
    sums = _sums(rows, size + 1, normal).reshape(FOLDS, size, size + 1)
    total = sums.sum(0)

    def solve(s):
        return np.linalg.solve(s[:, :size] + RIDGE * n * np.eye(size) / size, s[:, size])

    held = np.stack([solve(total - sums[k]) for k in range(FOLDS)])

    def unseen(batches):
        for batch in batches:
            if batch.num_rows:
                z = base.features(np.array(batch.column("stats").to_pylist()))
                score = (z * held[np.array(batch.column("fold"))]).sum(1)
                yield pa.RecordBatch.from_pydict({"score": score, "label": np.array(batch.column("label"), float)})

    pairs = rows.mapInArrow(unseen, "score double, label double").toPandas()
    knots = isotonic(pairs["score"].to_numpy(), pairs["label"].to_numpy())
    return Model(base.mean, base.scale, directions, phases, solve(total), knots)


def scores(model: Model, text: Column) -> Column:
    """P(label = 1) of each whole text, by its statistics alone; null is the empty text."""

    @F.pandas_udf("double")
    def run(part: pd.Series) -> pd.Series:
        if not len(part):
            return pd.Series([], dtype=float)
        return pd.Series(model.scores(np.stack([statistics(t) for t in part])))

    return run(text)
