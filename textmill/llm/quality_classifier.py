"""Quality classifier: histogram gradient-boosted trees on document statistics (operator 8).

Every text becomes ``FEATURES`` statistics (byte classes, words, lines,
repetition); labels, language, source and ids are never among them. The trees are
fitted on at most ``TRAIN_ROWS`` labelled rows whose ``crc32(doc_id)`` modulo 5
is not 0 (those with the smallest hash of their id, if there are more): features
are cut into ``BINS`` quantile bins, each level of a tree takes its splits from
gradient and hessian histograms, and leaves get Newton steps of the logistic
loss. The finished trees are complete binary trees in three arrays (feature,
threshold, leaf value), and scoring walks all trees for all rows of an Arrow
batch at once, one array step per level.

The sample's ids are broadcast (bounded by ``TRAIN_ROWS``), so texts are not
shuffled for training; scoring is one pass over the documents.

Defined cases: null or empty texts have all-zero statistics and get a score; with
no labelled row the score is 0.5, with one class its smoothed share; repeated
labels of a document count once (the smallest quality); repeated documents are
scored alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_ROWS = 20_000
BINS = 64
TREES = 60
DEPTH = 4
RATE = 0.2
LEAST_HESSIAN = 2.0
L2 = 1.0
CUTOFF = 0.3
FEATURES = ["log_bytes", "log_words", "word_mean", "word_std", "upper", "digit", "symbol", "bang", "pipe", "other_punct",
            "space", "non_ascii", "distinct_words", "top_word", "same_as_before", "log_lines", "dup_lines", "words_per_line",
            "mark_words"]


def _class(chars: bytes) -> np.ndarray:
    return np.isin(np.arange(256), list(chars))


_UPPER, _DIGIT = _class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class(b"0123456789")
_SYMBOL, _BANG, _PIPE = _class(b"#*$%&<>@^~\\{}[]="), _class(b"!?"), _class(b"|")
_PUNCT, _SPACE, _HIGH = _class(b".,;:'\"()-_/+`"), _class(b" \t\n\x0b\x0c\r"), np.arange(256) >= 128


def statistics(text: str | None) -> list[float]:
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    solid = max(1, len(raw) - int(counts[_SPACE].sum()))
    share = lambda cls: float(counts[cls].sum()) / solid
    n = len(words)
    sizes = np.fromiter(map(len, words), dtype=np.float64, count=n)
    kinds = set(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    marked = sum(1 for w in words[:] if not w[-1:].isalnum() and w[-1] < 128)
    seen: dict = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    return [float(np.log1p(len(raw))), float(np.log1p(n)), float(sizes.mean()), float(sizes.std()), share(_UPPER),
            share(_DIGIT), share(_SYMBOL), share(_BANG), share(_PIPE), share(_PUNCT),
            1 - solid / len(raw), share(_HIGH), len(kinds) / n, max(seen.values()) / n,
            sum(map(operator.eq, words, words[1:])) / n, float(np.log1p(len(lines))),
            1 - len(set(lines)) / max(1, len(lines)), n / max(1, len(lines)), marked / n]


class Trees:
    """Complete trees of depth ``DEPTH`` as arrays; ``score`` is vectorised."""

    def __init__(self, base: float, feature=None, threshold=None, value=None):
        self.base, self.feature, self.threshold, self.value = base, feature, threshold, value

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = np.full(len(x), self.base)
        if self.feature is not None and len(x):
            trees = np.arange(len(self.feature))[None, :]
            at = np.zeros((len(x), len(self.feature)), dtype=np.int64)
            rows = np.arange(len(x))[:, None]
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, self.feature[trees, at]] > self.threshold[trees, at])
            raw += self.value[trees, at - (2 ** DEPTH - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-raw))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    if len(y) == 0:
        return Trees(0.0)
    p = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(p / (1 - p)))
    if y.min() == y.max():
        return Trees(base)
    n, k = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(k)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    flat = binned + np.arange(k) * BINS
    raw = np.full(n, base)
    feature = np.zeros((TREES, 2 ** DEPTH - 1), dtype=np.int64)
    threshold = np.full((TREES, 2 ** DEPTH - 1), np.inf)
    value = np.zeros((TREES, 2 ** DEPTH))
    for t in range(TREES):
        prob = 1 / (1 + np.exp(-raw))
        grad, hess = prob - y, prob * (1 - prob)
        node = np.zeros(n, dtype=np.int64)
        for depth in range(DEPTH):
            width = 2 ** depth
            key = (node[:, None] * k * BINS + flat).ravel()
            g = np.bincount(key, np.repeat(grad, k), width * k * BINS).reshape(width, k, BINS)
            h = np.bincount(key, np.repeat(hess, k), width * k * BINS).reshape(width, k, BINS)
            gl, hl = g.cumsum(axis=2), h.cumsum(axis=2)
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl ** 2 / (hl + L2) + (gt - gl) ** 2 / (ht - hl + L2) - gt ** 2 / (ht + L2)
            gain[(hl < LEAST_HESSIAN) | (ht - hl < LEAST_HESSIAN)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            split = gain.reshape(width, -1).max(axis=1) > 1e-9
            f, b = best // BINS, best % BINS
            limit = np.array([cuts[j][c] if ok and c < len(cuts[j]) else np.inf for j, c, ok in zip(f, b, split)])
            at = slice(width - 1, 2 * width - 1)
            feature[t, at], threshold[t, at] = f, limit
            node = 2 * node + (x[np.arange(n), f[node]] > limit[node])
        g, h = np.bincount(node, grad, 2 ** DEPTH), np.bincount(node, hess, 2 ** DEPTH)
        value[t] = -RATE * g / (h + L2)
        raw += value[t][node]
    return Trees(base, feature, threshold, value)


def held_out(doc_id) -> F.Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def _table(batches, columns):
    for b in batches:
        x = np.array([statistics(t.as_py()) for t in b.column(b.schema.get_field_index("text"))], dtype=np.float64)
        yield b, x.reshape(-1, len(FEATURES))


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most ``rows`` labelled rows outside the held-out part."""
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out("doc_id"))
              .groupBy("doc_id").agg(F.min("quality").cast("int").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    have = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``rows`` rows

    def run(batches):
        for b, x in _table(batches, FEATURES):
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(b.schema.get_field_index("y")),
                                              pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "y", "x"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    got = have.select("doc_id", "text", "y").mapInArrow(run, f"doc_id {kind}, y int, x array<double>").orderBy(
        F.xxhash64("doc_id"), "doc_id", "x").limit(rows).collect()
    return (np.array([r["x"] for r in got]).reshape(-1, len(FEATURES)), np.array([r["y"] for r in got], dtype=np.float64))


def score_quality(docs: DataFrame, model: Trees) -> DataFrame:
    """(doc_id, score) per row of ``docs``."""
    def run(batches):
        for b, x in _table(batches, FEATURES):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x), pa.float64())], ["doc_id", "score"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def op8_quality_classifier(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(*training_sample(docs, labels))
    return score_quality(docs, model).select(
        "doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= CUTOFF).cast("int").alias("predicted"))
