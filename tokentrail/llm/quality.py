"""A quality classifier: Naive Bayes support vectors.

Features are indicators of hashed n-grams: runs of 1 to 4 bytes of the text with each word's case and marks kept,
runs of 3, 5 and 8 character kinds, and words or pairs said again. Each is scaled by the log ratio of its smoothed shares in the two classes;
a linear model with squared hinge loss is fitted to them by dual coordinate descent, and its margins become
probabilities by a logistic fit on labelled rows that the descent did not see.

The fit, its class counts included, takes at most SAMPLE_ROWS labelled rows, those lowest by a hash of doc_id. Their
whole texts become feature bits where they lie; the driver gets these, 2 ** BITS bits a row at most. Every text is
scored as a whole. Nulls: a null text is empty and is scored by the bias alone; null labels and null doc_ids are never
learned from. With no labels, or labels of one class only, all scores are that class's share (1 if there is none).
Several labels of one doc_id each count, and so do several texts of one. Equal texts have equal scores. An empty table
gives no rows. Other columns, of any names, are kept by keep_good and left out by classify.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gram_hashes, slices, utf8, word_hashes

BITS = 18
SAMPLE_ROWS = 4_000
#: Least score of a document that is kept.
LEAST = 0.3
_KIND = np.zeros(256, np.uint8)  # lower 1, upper 2, digit 3, white 4, other mark 5, beyond ASCII 6
_KIND[:] = 5
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 3
_KIND[[32, 9, 10, 11, 12, 13]] = 4
_KIND[128:] = 6


def features(text: bytes, bits: int = BITS) -> np.ndarray:
    """The distinct feature numbers of a whole text, ascending."""
    raw = np.frombuffer(text, np.uint8)
    seen = np.zeros(1 << bits, bool)
    shift = np.uint32(32 - bits)
    with np.errstate(over="ignore"):
        for n in (1, 2, 3, 4):
            if len(raw) >= n:
                h = np.full(len(raw) - n + 1, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
                for i in range(n):
                    h = (h ^ raw[i : len(raw) - n + 1 + i]) * np.uint32(0x85EBCA6B)
                    h ^= h >> np.uint32(15)
                seen[(h * np.uint32(0xC2B2AE35)) >> shift] = True
        kind = _KIND[raw]
        if len(kind):
            # shapes: runs of one kind as one sign, then n-grams of these
            runs = kind[np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))]
            for n in (3, 5, 8):
                if len(runs) >= n:
                    h = np.full(len(runs) - n + 1, n * 0x27D4EB2F & 0xFFFFFFFF, np.uint32)
                    for i in range(n):
                        h = h * np.uint32(0x01000193) + runs[i : len(runs) - n + 1 + i]
                    h ^= h >> np.uint32(13)
                    seen[(h * np.uint32(0x9E3779B1)) >> shift] = True
    words = word_hashes(text.split())
    if len(words) > 1:
        # n-grams of one word said again, and of a pair said again, by how large a part of the text they are
        again = float((words[1:] == words[:-1]).mean())
        pairs = 1 - len(np.unique(gram_hashes(words, 2))) / (len(words) - 1)
        for kind, part in ((0, again), (8, pairs)):
            for k, least in enumerate((0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.8)):
                if part >= least:
                    seen[kind + k] = True
    return np.flatnonzero(seen).astype(np.int32)


@dataclass
class Model:
    weights: np.ndarray  # log-count ratio times fitted weight, by feature
    bias: float
    slope: float
    offset: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(texts), self.bias)
        margins = np.array([_margin(self.weights, features(t)) for t in texts]) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -40, 40)))


def _margin(weights: np.ndarray, index: np.ndarray) -> float:
    """Mean over the square root of the number of features, so that long texts have no larger margins."""
    return float(weights[index].sum() / np.sqrt(max(1, len(index))))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, size: int, smooth: float = 1.0) -> np.ndarray:
    counts = [np.full(size, smooth), np.full(size, smooth)]
    for index, y in zip(rows, labels, strict=True):
        counts[int(y)][index] += 1
    return np.log((counts[1] / counts[1].sum()) / (counts[0] / counts[0].sum()))


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int, c: np.ndarray, rounds: int = 8, seed: int = 3) -> tuple[np.ndarray, float]:
    """Weights and bias of min |w|^2 / 2 + sum c_i max(0, 1 - y_i (w x_i + b))^2, one dual variable at a time."""
    w, bias, alpha = np.zeros(size), 0.0, np.zeros(len(y))
    norm = np.array([float(v @ v) + 1 for v in values]) + 0.5 / c
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        worst = 0.0
        for i in order.permutation(len(y)):
            gradient = y[i] * (w[rows[i]] @ values[i] + bias) - 1 + alpha[i] * 0.5 / c[i]
            new = max(0.0, alpha[i] - gradient / norm[i])
            step = (new - alpha[i]) * y[i]
            if step:
                worst = max(worst, abs(step))
                w[rows[i]] += step * values[i]
                bias += step
                alpha[i] = new
        if worst < 1e-3:
            break
    return w, bias


class _Values:
    """The values of rows of features, made when they are asked for: all together are twice as large as the rows."""

    def __init__(self, rows: list[np.ndarray], ratio: np.ndarray):
        self.rows, self.ratio = rows, ratio

    def __getitem__(self, i: int) -> np.ndarray:
        return self.ratio[self.rows[i]] / np.sqrt(max(1, len(self.rows[i])))


def fit(texts: list[bytes], labels: list[int], bits: int = BITS, c: float = 1.0) -> Model:
    return fit_features([features(t, bits) for t in texts], labels, 1 << bits, c)


def fit_features(rows: list[np.ndarray], labels: list[int], size: int, c: float = 1.0) -> Model:
    y = np.array(labels, np.int64)
    if len(set(labels)) < 2:
        return Model(np.empty(0), float(labels[0]) if labels else 1.0, 1.0, 0.0)
    own = np.arange(len(y)) % 5 != 0
    if len(set(y[own])) < 2 or len(set(y[~own])) < 2:
        own[:] = True
    at = np.flatnonzero(own)
    ratio = log_count_ratios([rows[i] for i in at], y[at], size)
    values = _Values([rows[i] for i in at], ratio)
    sign = np.where(y[at] == 1, 1.0, -1.0)
    w, bias = dual_coordinate_descent([rows[i] for i in at], values, sign, size, np.full(len(at), c))
    weights = (ratio * w).astype(np.float32)
    calibrate = np.flatnonzero(~own) if (~own).any() else at
    margins = np.array([_margin(weights, rows[i]) for i in calibrate]) + bias
    slope, offset = logistic(margins, y[calibrate])
    return Model(weights, bias, slope, offset)


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through (x, y), by Newton's method on targets drawn in from 0 and 1."""
    pos, neg = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g, h = p - t, np.maximum(p * (1 - p), 1e-9)
        m = np.array([[(h * x * x).sum() + 1e-6, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(m, [(g * x).sum(), g.sum()])
        step *= min(1.0, 5 / max(1e-9, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(max(a, 0.0)), float(b)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fits to labelled documents outside the held-out fold. The ids of the sample, at most sample_rows, are few enough
    to be sent to the scan of docs; of its texts only the features move, as bits."""
    known = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").filter(~held_out())
    ids = known.select(F.col("doc_id").cast("long").alias("l_id"), F.col("quality").cast("int").alias("quality")).orderBy(F.xxhash64("l_id"), "l_id", "quality").limit(sample_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(ids), texts.doc_id == ids.l_id).select("doc_id", "quality", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = [features(t) for t in utf8(b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([_packed(f) for f in found], pa.binary())], names=["doc_id", "quality", "bits"])

    sample = sorted((r.doc_id, r.quality, bytes(r.bits)) for r in rows.mapInArrow(run, "doc_id long, quality int, bits binary").collect())
    order = np.random.default_rng(11).permutation(len(sample))
    return fit_features([_unpacked(sample[i][2]) for i in order], [sample[i][1] for i in order], 1 << BITS)


def _packed(index: np.ndarray, bits: int = BITS) -> bytes:
    """Feature numbers as four bytes each or as one bit map, whichever is less."""
    if 32 * len(index) < 1 << bits:
        return b"\0" + index.astype("<i4").tobytes()
    seen = np.zeros(1 << bits, bool)
    seen[index] = True
    return b"\1" + np.packbits(seen).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    if raw[:1] == b"\0":
        return np.frombuffer(raw[1:], "<i4")
    return np.flatnonzero(np.unpackbits(np.frombuffer(raw[1:], np.uint8))).astype(np.int32)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of each whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sent.value.scores(utf8(b.column(1))), pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, least: float = LEAST) -> DataFrame:
    """(doc_id, held_out, score, predicted)."""
    scored = score(docs, learn(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = LEAST) -> DataFrame:
    """The documents with a score of at least least, all columns unchanged."""
    sent = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield b.filter(pa.array(sent.value.scores(utf8(b.column(text))) >= least))

    return docs.mapInArrow(run, docs.schema)
