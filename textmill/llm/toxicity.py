"""Toxicity by a chain of linear classifiers (operator 3).

The chain predicts ``insult``, ``contempt``, ``disgust`` and then ``toxic``. Each
link is a logistic regression on the distinct words of a text, on how many of
them share a beginning (compounds and inflections), and on the probabilities of
all earlier links. So that a link learns from predictions as
good as those it will see later, the probabilities of earlier links that it is
trained on are out-of-fold: they come from models that did not see the row.

``toxic`` is ``labels.toxic``. The table names no categories, so the first three
are labelled weakly: a row belongs to a category if it is labelled toxic and
holds one of the category's seed words. The seeds only make training labels; the
features are at most ``N_WORDS`` terms that separate the toxic training rows
best (chi-square, beyond what chance gives among so many words), whatever they are.

Fitted on at most ``TRAIN_ROWS`` labelled rows (those with the smallest hash of
their id, if there are more); every document is scored, whole text, in Arrow
batches with numpy.

Words are runs of ASCII letters, digits and non-ASCII bytes, A-Z lower-cased.

Defined cases: null or empty texts have no words and get the intercepts'
probabilities; without labelled rows, or with one class, the probability is the
smoothed share and nothing is flagged unless that share reaches ``CUTOFF``;
repeated labels of a document count once (the largest); repeated documents are
scored alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.decontaminate import words_of

TRAIN_ROWS = 8_000
N_WORDS = 400
LEAST_DOCS = 3
FOLDS = 3
HEAD = 4
STEPS = 120
L2 = 1e-4
CUTOFF = 0.6
#: Seed words of the weak category labels
SEEDS = {
    "insult": "clown dumb fool idiot imbecile loser moron stupid",
    "contempt": "garbage pathetic scum trash useless vermin worthless",
    "disgust": "disgusting filthy gross nasty repulsive sickening vile",
}
CHAIN = [*SEEDS, "toxic"]


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and intercept (last) by accelerated gradient steps with a fixed
    step length for each column (its share of rows bounds the curvature)."""
    n = len(y)
    p = (y.sum() + 0.5) / (n + 1)
    w = np.zeros(x.shape[1] + 1)
    w[-1] = np.log(p / (1 - p))
    if n == 0 or y.min() == y.max():
        return w
    # rows of both classes weigh alike, else a rare class moves the weights too slowly
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (n - y.sum()))
    lead, prev = w.copy(), w.copy()
    sizes = np.append((x.T.astype(np.float64) ** 2) @ weight, 1.0)
    step = 4.0 / (np.sqrt(sizes) * np.sqrt(sizes).sum() * 0.05 + 1e-3)
    step = np.minimum(step, 40.0)
    for k in range(STEPS):
        err = weight * (sigmoid(x @ lead[:-1] + lead[-1]) - y)
        grad = np.append(x.T @ err, err.sum()) + L2 * np.append(lead[:-1], 0)
        nxt = lead - step * grad
        if grad @ (nxt - prev) > 0:  # restart the momentum when it points uphill
            lead = prev = nxt
            continue
        lead, prev = nxt + k / (k + 3) * (nxt - prev), nxt
    return prev


def terms(word: bytes) -> list[bytes]:
    """The whole word, marked at its end, and its beginnings of 4 to 8 bytes."""
    return [word + b"$", *(word[:k] for k in range(HEAD, min(len(word), 9)))]


class Chain:
    def __init__(self, vocabulary: dict[bytes, int], links: list[np.ndarray]):
        self.vocabulary, self.links = vocabulary, links

        self.heads = {v[:HEAD] for v in vocabulary}

    def features(self, bags) -> np.ndarray:
        """log2(1 + number of the text's distinct words that give the term)."""
        x = np.zeros((len(bags), len(self.vocabulary)), dtype=np.float32)
        for row, bag in enumerate(bags):
            for w in bag:
                if w[:HEAD] in self.heads or len(w) < HEAD:
                    for term in terms(w):
                        if (j := self.vocabulary.get(term)) is not None:
                            x[row, j] += 1
        return np.log2(1 + x)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """(rows, links): each link sees the probabilities of those before it."""
        probs = np.zeros((len(x), len(CHAIN)))
        for j, w in enumerate(self.links):
            probs[:, j] = sigmoid(np.hstack([x, probs[:, :j]]) @ w[:-1] + w[-1])
        return probs


def unlike_rows(bags: list[set[bytes]], bands: int = 3, size: int = 3) -> list[int]:
    """Rows without the near copies of earlier ones (min-hash bands): words that a
    group of copies happens to share would otherwise look like evidence."""
    factor = (np.random.default_rng(7).integers(1, 2**62, bands * size) * 2 + 1).astype(np.uint64)
    seen, kept = set(), []
    for row, bag in enumerate(bags):
        h = np.fromiter((zlib.crc32(w) + 1 for w in bag), dtype=np.uint64, count=len(bag))
        least = [int((h * f).min()) for f in factor] if len(h) else [0] * len(factor)
        keys = {(b, *least[b * size:(b + 1) * size]) for b in range(bands)}
        if seen.isdisjoint(keys):
            kept.append(row)
        seen |= keys
    return kept


def fit(bags: list[set[bytes]], toxic: np.ndarray) -> Chain:
    rows = unlike_rows(bags)
    bags, toxic = [bags[i] for i in rows], toxic[rows].astype(np.float64)
    df, pos = Counter(), Counter()
    for bag, t in zip(bags, toxic):
        found = {term for w in bag for term in terms(w)}
        df.update(found)
        if t:
            pos.update(found)
    n, n_pos = len(bags), toxic.sum()
    def chi2(w):
        a, total = pos[w], df[w]
        expect = total * n_pos / n
        return (a - expect) ** 2 / expect + (a - expect) ** 2 / max(total - expect, 1e-9)
    common = [w for w, c in df.items() if c >= LEAST_DOCS and 0 < n_pos < n]
    # the best of many random words reaches about 2 ln(their number); ask for twice that
    least = 4 * np.log(max(len(common), 3))
    common = sorted(w for w in common if chi2(w) >= least)
    vocabulary = {w: i for i, w in enumerate(sorted(common, key=chi2, reverse=True)[:N_WORDS])}
    chain = Chain(vocabulary, [])
    x = chain.features(bags)
    seeds = {c: {w.encode() for w in s.split()} for c, s in SEEDS.items()}
    fold = np.arange(n) % FOLDS
    earlier = np.zeros((n, 0), dtype=np.float32)  # out-of-fold probabilities of the links so far
    for name in CHAIN:
        y = toxic if name == "toxic" else np.array([float(t > 0 and not bag.isdisjoint(seeds[name])) for bag, t in zip(bags, toxic)])
        xs = np.hstack([x, earlier])
        out = np.zeros(n, dtype=np.float32)
        for k in range(FOLDS):
            w = fit_logistic(xs[fold != k], y[fold != k])
            out[fold == k] = sigmoid(xs[fold == k] @ w[:-1] + w[-1])
        chain.links.append(fit_logistic(xs, y))
        earlier = np.hstack([earlier, out[:, None]])
    return chain


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, where=None):
    """Word sets and labels of at most ``rows`` labelled documents."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    chosen = ((usable if where is None else usable.where(where))
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    have = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``rows`` rows

    def run(batches):
        for b in batches:
            bags = [b" ".join(sorted(set(words_of(t.as_py())))) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(bags, pa.binary())], ["doc_id", "y", "bag"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    got = have.select("doc_id", "text", "y").mapInArrow(run, f"doc_id {kind}, y int, bag binary").orderBy(
        F.xxhash64("doc_id"), "doc_id", "bag").limit(rows).collect()
    return [set(bytes(r["bag"]).split(b" ")) if r["bag"] else set() for r in got], np.array([r["y"] for r in got], dtype=np.float64)


def score_toxicity(docs: DataFrame, chain: Chain) -> DataFrame:
    """(doc_id, p_<link>...) per row of ``docs``."""
    names = [f"p_{c}" for c in CHAIN]

    def run(batches):
        for b in batches:
            probs = np.zeros((b.num_rows, len(CHAIN)))
            for at in range(0, b.num_rows, 1000):
                bags = [set(words_of(t.as_py())) for t in b.column(1).slice(at, 1000)]
                probs[at:at + len(bags)] = chain.predict(chain.features(bags))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(probs[:, j]) for j in range(len(CHAIN))]], ["doc_id", *names])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, ", ".join([f"doc_id {kind}", *[f"{c} double" for c in names]]))


def op3_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_toxicity(docs, fit(*training_sample(docs, labels)))
    flags = F.array_join(F.filter(F.array(*[F.when(F.col(f"p_{c}") >= CUTOFF, F.lit(c)) for c in SEEDS]), lambda x: x.isNotNull()), ",")
    return scored.select("doc_id", (F.col("p_toxic") >= CUTOFF).alias("toxic"), flags.alias("categories"),
                         *[F.round(f"p_{c}", 6).alias(f"p_{c}") for c in CHAIN])
