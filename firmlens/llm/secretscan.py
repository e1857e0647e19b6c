"""Secrets in whole texts: fixed patterns, and a character network over every other candidate."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from firmlens.llm.common import texts, unused
from firmlens.session import parallelism, settle, temporary

#: Findings that a task trains on before its network is averaged with the others'.
BLOCK_ROWS = 4096
#: The threshold keeps at least this share of the labelled secrets that the network hasn't seen.
RECALL = 0.98
LEFT, BODY, RIGHT = 24, 96, 8
WIDTH = LEFT + BODY + RIGHT
STRIDE = 64
EMBEDDING, FILTERS, SPAN, HIDDEN = 8, 24, 5, 16
EPOCHS, BATCH, RATE = 12, 64, 3e-3
#: Bins of a step towards the threshold, and values that are ordered on the driver.
BINS, FEW = 1024, 20_000
SEED = 5
KINDS = ("assign", "access", "hex", "net")

# The patterns and their least lengths.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
_RUN_BYTES = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_TO_SPACE = bytes(b if b in _RUN_BYTES else 32 for b in range(256))


def _odd(run: bytes) -> bool:
    """Whether a run of 12 letters or more can be a secret: digits, or capitals inside."""
    digits = sum(48 <= b <= 57 for b in run)
    return digits >= 2 or (len(run) >= 20 and run[1:].lower() != run[1:] and run.upper() != run)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the fixed patterns, leftmost and non-overlapping within each kind.

    An access key or a hex run of full length is the whole of what its pattern would match, so the
    least length may stand in the pattern; an assignment is matched first and judged then.
    """
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    return found


def candidates(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """The base spans, and every other run that can be a secret, of the whole text."""
    text = text or ""
    base, others = base_spans(text), []
    runs = text.encode("utf-8", "surrogatepass").translate(_TO_SPACE).split()
    if any(len(r) >= 24 or (len(r) >= 12 and not (r.isalpha() and r[1:].islower())) for r in runs):
        for m in RUN.finditer(text):
            a, b = m.span()
            base += [(h.start(), h.end(), 2) for h in HEX.finditer(text, a, b)]
            if _odd(m[0].encode()):
                others.append((a, b))
    base.sort(key=lambda s: (s[0], s[2]))
    others = [(a, b) for a, b in others if not any(a < e and s < b for s, e, _ in base)]
    return base, others


def windows(text: str, start: int, end: int) -> Iterator[bytes]:
    """``WIDTH`` bytes around each part of a candidate: context, up to ``BODY`` characters of it,
    context; a long one gives overlapping windows that cover it. A character beyond ASCII is 127,
    none at all is 0; the candidate's own have the high bit."""
    for at in range(start, max(start + 1, end - BODY + STRIDE), STRIDE):
        stop = min(end, at + BODY)
        row = bytearray(WIDTH)
        left = text[max(0, at - LEFT) : at]
        body, right = text[at:stop], text[stop : stop + RIGHT]
        for place, part, mark in ((LEFT - len(left), left, 0), (LEFT, body, 128), (LEFT + len(body), right, 0)):
            row[place : place + len(part)] = bytes(min(127, ord(c)) | mark for c in part)
        yield bytes(row)


@dataclass
class Network:
    """Embedding, one convolution, largest and mean response of each filter, two dense layers."""

    p: dict[str, np.ndarray]

    @staticmethod
    def new() -> Network:
        g = np.random.default_rng(SEED)

        def init(*shape):
            return g.normal(size=shape) * np.sqrt(2 / shape[0])

        inputs = SPAN * (EMBEDDING + 1)
        p = {"e": g.normal(size=(128, EMBEDDING)) * 0.3, "w1": init(inputs, FILTERS), "b1": np.zeros(FILTERS)}
        p |= {"w2": init(2 * FILTERS, HIDDEN), "b2": np.zeros(HIDDEN), "w3": init(HIDDEN, 1), "b3": np.zeros(1)}
        return Network({k: v.astype(np.float32) for k, v in p.items()})

    def forward(self, rows: np.ndarray) -> tuple[np.ndarray, tuple]:
        p, codes = self.p, rows & 127
        x = np.concatenate([p["e"][codes], (rows >> 7)[..., None].astype(np.float32)], axis=2)
        cut = np.lib.stride_tricks.sliding_window_view(x, SPAN, axis=1).transpose(0, 1, 3, 2)
        cut = np.ascontiguousarray(cut).reshape(len(rows), WIDTH - SPAN + 1, -1)
        h = np.maximum(cut @ p["w1"] + p["b1"], 0)
        top = h.argmax(axis=1)
        pooled = np.concatenate([np.take_along_axis(h, top[:, None], 1)[:, 0], h.mean(axis=1)], axis=1)
        dense = np.maximum(pooled @ p["w2"] + p["b2"], 0)
        return (dense @ p["w3"] + p["b3"])[:, 0], (codes, cut, h, top, pooled, dense)

    def gradients(self, rows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        logit, (codes, cut, h, top, pooled, dense) = self.forward(rows)
        d = ((1 / (1 + np.exp(-logit)) - labels) / len(rows)).astype(np.float32)[:, None]
        g = {"w3": dense.T @ d, "b3": d.sum(0)}
        d = (d @ p["w3"].T) * (dense > 0)
        g |= {"w2": pooled.T @ d, "b2": d.sum(0)}
        d = d @ p["w2"].T
        dh = np.repeat(d[:, None, FILTERS:] / h.shape[1], h.shape[1], axis=1)
        r, f = np.indices(top.shape)
        dh[r, top, f] += d[:, :FILTERS]
        dh *= h > 0
        g |= {"w1": np.tensordot(cut, dh, ([0, 1], [0, 1])), "b1": dh.sum((0, 1))}
        dx = (dh @ p["w1"].T).reshape(len(rows), h.shape[1], SPAN, EMBEDDING + 1)
        g["e"] = np.zeros_like(p["e"])
        for i in range(SPAN):
            np.add.at(g["e"], codes[:, i : i + h.shape[1]], dx[:, :, i, :EMBEDDING])
        return g

    def zeros(self) -> dict[str, np.ndarray]:
        return {k: np.zeros_like(v) for k, v in self.p.items()}

    def passed(self, rows: np.ndarray, labels: np.ndarray, mean: dict, square: dict, step: int, epoch: int, block: int) -> int:
        """One pass of Adam over a block of findings, whose moments and steps so far are given. In half
        of the passes the context is blank, so that shape alone must do too."""
        g = np.random.default_rng(SEED + 1 + block)
        starts = range(0, len(rows), BATCH)
        for _ in range(epoch):
            g.permutation(len(rows))
            for at in starts:
                g.random(min(BATCH, len(rows) - at))
        order = g.permutation(len(rows))
        for at in starts:
            pick = order[at : at + BATCH]
            part = rows[pick].copy()
            blank = g.random(len(pick)) < 0.5
            part[blank] *= part[blank] >> 7
            step += 1
            for k, d in self.gradients(part, labels[pick]).items():
                mean[k] += 0.1 * (d - mean[k])
                square[k] += 0.001 * (d * d - square[k])
                self.p[k] -= RATE * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
        return step

    def logits(self, rows: np.ndarray) -> np.ndarray:
        parts = [self.forward(rows[at : at + 256])[0] for at in range(0, len(rows), 256)]
        return np.concatenate(parts).astype(float) if parts else np.zeros(0)


def calibrate(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset (Platt) that turn logits into probabilities; smoothed targets keep them finite."""
    n1, n0 = labels.sum(), (1 - labels).sum()
    return _platt(lambda w: _platt_sums(logits, labels, w, n1, n0), len(logits))


def _platt_sums(logits: np.ndarray, labels: np.ndarray, w: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """First and second derivatives of the loss, in a flat array; sums of parts are those of the whole."""
    wanted = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([logits, np.ones(len(logits))], 1)
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return np.concatenate([x.T @ (p - wanted), ((x * (p * (1 - p) + 1e-9)[:, None]).T @ x).ravel()])


def _platt(sums, n: int) -> tuple[float, float]:
    w = np.array([1.0, 0.0])
    for _ in range(100):
        found = sums(w)
        slope = found[:2] + 1e-3 * w
        if np.abs(slope).max() < 1e-7 * n:
            break
        w = w - np.linalg.solve(found[2:].reshape(2, 2) + 1e-3 * np.eye(2), slope)
    return float(w[0]), float(w[1])


@dataclass
class Model:
    network: Network | None
    slope: float = 1.0
    offset: float = 0.0
    threshold: float = 1.0

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logits + self.offset, -30, 30)))

    def scan(self, values) -> list[list[tuple[int, int, int, float | None]]]:
        """(start, end, kind, probability) of each text's spans, by start, then kind. Base spans
        always stay; other candidates need the threshold. Without a network there are none."""
        found, rows, owners = [], [], []
        for i, text in enumerate(values):
            base, others = candidates(text)
            spans = [[a, b, k, None] for a, b, k in base] + [[a, b, 3, None] for a, b in others]
            found.append(spans)
            if self.network:
                for j, (a, b, *_) in enumerate(spans):
                    for window in windows(text, a, b):
                        rows.append(window)
                        owners.append((i, j))
        if rows:
            table = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, WIDTH)
            for (i, j), p in zip(owners, self.probabilities(self.network.logits(table)).tolist(), strict=True):
                found[i][j][3] = max(p, found[i][j][3] or 0.0)
        kept = [[tuple(s) for s in spans if s[2] < 3 or (s[3] or 0.0) >= self.threshold and self.network] for spans in found]
        return [sorted(spans, key=lambda s: (s[0], s[2])) for spans in kept]


def findings(docs: DataFrame) -> DataFrame:
    """Labelled findings: a window around each candidate of ``docs`` (doc_id, text), and whether a
    fixed pattern says that it is a secret."""

    def run(batches):
        for batch in batches:
            rows = []
            for text in texts(batch):
                base, others = candidates(text)
                rows += [(w, 1) for a, b, _ in base for w in [next(windows(text, a, b))]]
                rows += [(w, 0) for a, b in others for w in windows(text, a, b)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int32())], ["bytes", "label"])

    return docs.select("text").mapInArrow(run, "bytes binary, label int")


def _blocks(drawn: DataFrame, n: int) -> DataFrame:
    """The ``n`` findings of ``drawn`` as blocks of about ``BLOCK_ROWS``, dealt by hash: one row each,
    its windows one after the other, in a fixed order."""
    n_blocks = max(1, -(-n // BLOCK_ROWS))
    dealt = drawn.withColumn("block", F.pmod(F.xxhash64(F.lit(SEED + 1), "bytes", "label"), F.lit(n_blocks)).cast("int"))

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["label", "h", "bytes"])
        packed = (int(part["block"].iloc[0]), b"".join(part["bytes"]), part["label"].to_numpy(np.uint8).tobytes())
        return pd.DataFrame([packed], columns=["block", "rows", "labels"])

    dealt = dealt.repartition(min(n_blocks, parallelism(drawn.sparkSession)), "block")
    return settle(dealt.groupBy("block").applyInPandas(pack, "block int, rows binary, labels binary"))


def _each(blocks: DataFrame, run: Callable[..., bytes]) -> DataFrame:
    """``run`` of each block's number, first column's bytes and labels."""
    first = blocks.columns[1]

    def walk(batches):
        for batch in batches:
            for r in batch.to_pylist():
                out = run(r["block"], r[first], np.frombuffer(r["labels"], np.uint8).astype(np.float32))
                yield pa.RecordBatch.from_pydict(
                    {"block": pa.array([r["block"]], pa.int32()), "out": pa.array([out], pa.binary()), "labels": pa.array([r["labels"]], pa.binary())}
                )

    return blocks.mapInArrow(walk, "block int, out binary, labels binary")


def _collected(blocks: DataFrame, run: Callable[..., bytes], dtype) -> list[np.ndarray]:
    found = sorted(_each(blocks, run).select("block", "out").collect(), key=lambda r: r["block"])
    return [np.frombuffer(r["out"], dtype) for r in found]


def _table(rows: bytes) -> np.ndarray:
    return np.frombuffer(rows, np.uint8).reshape(-1, WIDTH)


def _trained(blocks: DataFrame) -> Network:
    """A network trained on all blocks: in each round every block makes a pass from the shared network,
    and the networks and moments that come out are averaged by rows."""
    network = Network.new()
    mean, square, step = network.zeros(), network.zeros(), 0.0
    names, shapes = list(network.p), [v.shape for v in network.p.values()]
    ends = np.cumsum([int(np.prod(s)) for s in shapes])
    for epoch in range(EPOCHS):

        def run(block, rows, labels, state=(network.p, mean, square), step=round(step), epoch=epoch):
            own, m, q = ({k: v.copy() for k, v in part.items()} for part in state)
            done = Network(own).passed(_table(rows), labels, m, q, step, epoch, block)
            flat = [part[k].ravel() for part in (own, m, q) for k in names]
            return np.concatenate([*flat, [len(labels), done]]).astype(np.float64).tobytes()

        found = _collected(blocks, run, np.float64)
        weights = np.array([f[-2] for f in found])
        total = sum(f * (w / weights.sum()) for f, w in zip(found, weights, strict=True)) if len(found) > 1 else found[0]
        step = float(total[-1])
        parts = np.split(total[:-2].astype(np.float32), 3)
        states = [{k: v.reshape(s) for k, v, s in zip(names, np.split(part, ends[:-1]), shapes, strict=True)} for part in parts]
        network, mean, square = Network(states[0]), states[1], states[2]
    return network


def _smallest(blocks: DataFrame, values: Callable[[bytes, np.ndarray], np.ndarray], at: int) -> float:
    """The value with ``at`` smaller ones beside it, by counting in ever narrower bins."""
    low, high, below = 0.0, 1.0, 0
    while True:
        edges = np.linspace(low, high, BINS + 1)

        def count(_, out, labels, edges=edges):
            v = values(out, labels)
            v = v[(v >= edges[0]) & (v <= edges[-1])]
            # A bin holds its lower edge, the last one both.
            return np.bincount(np.minimum(np.searchsorted(edges, v, "right") - 1, BINS - 1), minlength=BINS).astype(np.int64).tobytes()

        counts = sum(_collected(blocks, count, np.int64))
        i = int(np.searchsorted(below + np.cumsum(counts), at, "right"))
        below += int(counts[:i].sum())
        last = i == BINS - 1
        low, high = float(edges[i]), float(edges[i + 1])
        if counts[i] <= FEW or high <= np.nextafter(low, 2):
            break
        # An upper edge belongs to the next bin, but for the last one.
        high = high if last else float(np.nextafter(high, 0))

    def inside(_, out, labels):
        v = values(out, labels)
        return v[(v >= low) & ((v < high) | (last & (v == high)))].astype(np.float64).tobytes()

    if counts[i] > FEW:
        return low
    return float(np.sort(np.concatenate(_collected(blocks, inside, np.float64)))[at - below])


def fit(docs: DataFrame) -> Model:
    """Train on the labelled findings of all documents, equal windows once.

    Findings are dealt by hash into blocks, which train side by side; only networks and sums of blocks
    come to the driver. A third (by hash) is kept back: it calibrates the probabilities and sets the
    threshold, the highest that keeps ``RECALL`` of its secrets. With too few findings of a label
    there is no network, and only the fixed patterns find anything.
    """
    with temporary(docs.sparkSession):
        drawn = findings(docs).distinct().withColumn("h", F.xxhash64(F.lit(SEED), "bytes"))
        drawn = settle(drawn.withColumn("held", F.pmod("h", F.lit(3)) == 0))
        sizes = {(r["held"], r["label"]): r["count"] for r in drawn.groupBy("held", "label").count().collect()}
        if min(sizes.get((held, label), 0) for held in (False, True) for label in (0, 1)) < 3:
            return Model(None)
        train, back = (_blocks(drawn.where(F.col("held") == held), sizes[held, 0] + sizes[held, 1]) for held in (False, True))
        network = _trained(train)

        def logits(_, rows, labels):
            table = _table(rows)
            return network.logits(np.vstack([table, table * (table >> 7)])).tobytes()

        judged = settle(_each(back, logits))
        n1, n0 = 2 * sizes[True, 1], 2 * sizes[True, 0]

        def platt(w):
            return sum(_collected(judged, lambda _, out, labels: _platt_sums(np.frombuffer(out), np.tile(labels, 2), w, n1, n0).tobytes(), np.float64))

        model = Model(network, *_platt(platt, n1 + n0))

        def secret(out, labels):
            return model.probabilities(np.frombuffer(out)[np.tile(labels, 2) == 1])

        model.threshold = _smallest(judged, secret, int((1 - RECALL) * n1))
        return model


def spans(model: Model, text: Column) -> Column:
    """The spans of each whole text as an array of (start, end, kind, probability); null is empty."""

    @F.pandas_udf("array<struct<start:long,end:long,kind:string,probability:double>>")
    def run(part: pd.Series) -> pd.Series:
        return pd.Series([[(a, b, KINDS[k], p) for a, b, k, p in found] for found in model.scan(part.tolist())], dtype=object)

    return run(text)


def redacted(model: Model, text: Column, mask: str = "[SECRET]") -> Column:
    """The whole text with each stretch of spans replaced; a text without spans stays as it is."""

    @F.pandas_udf("string")
    def run(part: pd.Series) -> pd.Series:
        values, out = part.tolist(), []
        for value, found in zip(values, model.scan(values), strict=True):
            if found:
                parts, at = [], 0
                for a, b, *_ in found:
                    if a >= at:
                        parts += [value[at:a], mask]
                    at = max(at, b)
                value = "".join([*parts, value[at:]])
            out.append(value)
        return pd.Series(out, dtype=object)

    return run(text)


def without_secrets(model: Model, docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``, the secrets in their texts replaced; ``n_chars``, if there is
    one, follows a text that changed."""
    name = unused(docs, "redacted")
    done = docs.withColumn(name, redacted(model, docs["text"]))
    changed = ~F.col(name).eqNullSafe(docs["text"])
    out = []
    for field in docs.schema:
        column = docs[f"`{field.name}`"]
        if field.name == "text":
            column = F.col(name)
        elif field.name == "n_chars":
            column = F.when(changed, F.length(name).cast(field.dataType)).otherwise(column)
        out.append(column.alias(field.name))
    return done.select(*out)
