"""Language identification with string kernels.

The kernel of two texts is the share of character n-grams (1 to ``LONGEST`` letters, presence only)
that both have: ``|A and B| / sqrt(|A| |B|)``. Nyström landmarks turn it into features, on which one
kernel ridge regression per language is fitted against the rest.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from firmlens.llm.common import share, texts, unused

LONGEST = 4
#: n-grams are hashed to this many places, which bounds memory in every language.
PLACES = 1 << 14
#: Texts of a language that the kernel is taken with.
LANDMARKS_PER_LANGUAGE = 24
RIDGE = 1e-3
UNKNOWN = "und"
#: A text below this score has hardly an n-gram in common with any language.
LEAST_SCORE = 0.1
#: Texts whose kernel with all landmarks is one matrix product.
TOGETHER = 64
_MULTIPLIER = np.uint32(0x9E3779B1)


def _letter_table() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    table[[c for c in range(0x110000) if chr(c).isalpha()]] = True
    return table


_LETTERS: list[np.ndarray] = []


def presence(text: str | None) -> np.ndarray | None:
    """Whether each hashed n-gram occurs in the whole text, lower-cased, with every run of other
    characters as one space. None if no character is a letter."""
    if not _LETTERS:
        _LETTERS.append(_letter_table())
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _LETTERS[0][codes]
    if not letter.any():
        return None
    codes = np.where(letter, codes, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    codes = codes[keep]
    found = np.zeros(PLACES, np.float32)
    hashed = np.zeros(len(codes), np.uint32)
    for n in range(1, min(LONGEST, len(codes)) + 1):
        hashed = hashed[: len(codes) - n + 1] * _MULTIPLIER + codes[n - 1 :] + np.uint32(n)
        mixed = hashed ^ (hashed >> np.uint32(15))
        found[(mixed * _MULTIPLIER) >> np.uint32(32 - PLACES.bit_length() + 1)] = 1
    return found


def _unit(found: np.ndarray) -> np.ndarray:
    return found / np.sqrt(np.maximum(found.sum(axis=1, keepdims=True), 1))


@dataclass(frozen=True)
class Model:
    """``landmarks``: unit presence vectors (n-gram x landmark). ``weights``: (landmark x language),
    the Nyström map times the ridge weights, so that kernel @ weights are the scores."""

    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray

    def scores(self, found: np.ndarray) -> np.ndarray:
        return (_unit(found) @ self.landmarks).astype(np.float64) @ self.weights

    def predict(self, values) -> list[tuple[str, float]]:
        """Language and score (0 to 1) of each text; equal scores go to the first language."""
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(values)
        if not self.languages:
            return out
        block, places = np.zeros((TOGETHER, PLACES), np.float32), []

        def flush() -> None:
            scores = self.scores(block[: len(places)])
            best = scores.argmax(axis=1)
            for i, b, row in zip(places, best.tolist(), scores, strict=True):
                out[i] = (self.languages[b], float(min(1.0, max(0.0, row[b]))))
            places.clear()

        for i, text in enumerate(values):
            found = presence(text)
            if found is None:
                continue
            block[len(places)] = found
            places.append(i)
            if len(places) == TOGETHER:
                flush()
        if places:
            flush()
        return out


def _sample(docs: DataFrame, counts: dict[str, int], rows: int, seed: int) -> DataFrame:
    """About ``rows`` rows of each language (all, if fewer), by a hash of the key."""
    rates = F.lit(0.0)
    for lang, n in counts.items():
        rates = F.when(F.col("lang") == lang, min(1.0, rows / n)).otherwise(rates)
    return docs.where(share(F.xxhash64("doc_id", "text"), seed) < rates)


def _presences(docs: DataFrame) -> DataFrame:
    """lang and the packed presence bits of each text that has a letter."""

    def run(batches):
        for batch in batches:
            found = [presence(t) for t in texts(batch)]
            bits = [None if f is None else np.packbits(f.astype(bool)).tobytes() for f in found]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(bits, pa.binary())], ["lang", "bits"])

    return docs.select("lang", "text").mapInArrow(run, "lang string, bits binary").where("bits is not null")


def _unpacked(bits) -> np.ndarray:
    return np.unpackbits(np.stack([np.frombuffer(b, np.uint8) for b in bits]), axis=1).astype(np.float32)


def fit(
    docs: DataFrame,
    landmarks: int = LANDMARKS_PER_LANGUAGE,
    rows: int | None = None,
    ridge: float = RIDGE,
) -> Model:
    """Learn from ``docs`` (doc_id, text, lang) where lang is known.

    About ``landmarks`` texts of each language, the places of the Nyström map, are drawn by a hash of
    the row. The regression is fitted on every row (``rows``: about so many of each language): tasks send the normal equations of theirs, which
    are added up row by row; only those sums and the landmarks' bits come to the driver. Without
    labelled texts the model knows no language.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    chosen = _presences(_sample(known, counts, landmarks, 1)).collect() if counts else []
    if not chosen:
        return Model([], np.zeros((PLACES, 0), np.float32), np.zeros((0, 0)))
    chosen.sort(key=lambda r: (r["lang"], bytes(r["bits"])))
    unit = _unit(_unpacked([r["bits"] for r in chosen]))
    names, m = sorted(counts), len(chosen)
    gram = (unit @ unit.T).astype(np.float64)
    values, vectors = np.linalg.eigh(gram)
    kept = values > 1e-6 * values.max()
    nystrom = vectors[:, kept] / np.sqrt(values[kept])
    columns = np.ascontiguousarray(unit.T)

    weights = {lang: 1 / min(rows or n, n) for lang, n in counts.items()}

    def sums(batches):
        """The normal equations of a task's rows: kernel' kernel, and kernel' with each language."""
        total = np.zeros((m, m + len(names)))
        for batch in batches:
            langs, values = batch.column("lang").to_pylist(), texts(batch)
            for at in range(0, len(values), TOGETHER):
                found = zip(langs[at : at + TOGETHER], map(presence, values[at : at + TOGETHER]), strict=True)
                part = [(lang, f) for lang, f in found if f is not None]
                if not part:
                    continue
                kernel = (_unit(np.stack([f for _, f in part])) @ columns).astype(np.float64)
                wanted = np.array([[lang == n for n in names] for lang, _ in part], float)
                total += (kernel * np.array([weights[lang] for lang, _ in part])[:, None]).T @ np.hstack([kernel, wanted])
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict({"row": list(range(m)), "task": [task] * m, "sums": total.tolist()})

    def added(part: pd.DataFrame) -> pd.DataFrame:
        # In order of tasks, so that every run gives the same sums.
        part = part.sort_values("task")
        return pd.DataFrame({"row": part["row"].iloc[:1], "sums": [np.sum(np.stack(part["sums"]), axis=0)]})

    learned = known if rows is None else _sample(known, counts, rows, 2)
    of_tasks = learned.select("lang", "text").mapInArrow(sums, "row long, task long, sums array<double>")
    total = np.zeros((m, m + len(names)))
    for r in of_tasks.groupBy("row").applyInPandas(added, "row long, sums array<double>").collect():
        total[r["row"]] = r["sums"]
    inner = nystrom.T @ total[:, :m] @ nystrom
    target = nystrom.T @ total[:, m:]
    solved = np.linalg.solve(inner + ridge * np.eye(len(inner)), target)
    return Model(names, columns, nystrom @ solved)


def predictions(model: Model, text: Column) -> Column:
    """A struct of lang_pred and score for each whole text; ``und`` and 0 if null or without letters."""

    @F.pandas_udf("lang_pred string, score double")
    def run(part: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(model.predict(part.tolist()), columns=["lang_pred", "score"])

    return run(text)


def speaks(model: Model, docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text has a language: letters, and a score
    of at least ``least``. A model that knows no language rejects only texts without letters."""
    name = unused(docs, "found")
    found = docs.withColumn(name, predictions(model, docs["text"]))
    if model.languages:
        kept = (F.col(f"`{name}`.lang_pred") != UNKNOWN) & (F.col(f"`{name}`.score") >= least)
    else:
        kept = F.col("text").rlike("\\p{L}")
    return found.where(kept).drop(name)
