"""Parameter merge and Spark ML re-aims of pre-training / fine-tuning.

The reference trains a Transformer; that network is not rebuilt. What is kept
is the data contract: self-supervised token vectors learned from unlabelled
encoded text (``Word2Vec``), a supervised two-class text model with and
without those vectors (``LogisticRegression``), batch scoring, and the
train / validation metrics of A6/A7.
"""

from __future__ import annotations

import heapq
import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, Word2Vec
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.operators import training as TR
from textmill.operators.evaluate import epoch_metrics, metrics_batches
from textmill.session import checkpoint_dir, cut_lineage


def merge_params(own: DataFrame, pretrained: DataFrame) -> DataFrame:
    """Own parameters overwritten by pretrained ones of the same name;
    unknown pretrained names ignored, unmatched own ones kept."""
    pre = pretrained.select("name", F.col("value").alias("_pre"))
    return (own.join(pre, "name", "left")
               .select("name", F.coalesce(F.col("_pre"), F.col("value")).alias("value"),
                       F.col("_pre").isNotNull().alias("from_pretrained")))


def _as_terms(df: DataFrame, ids_col: str = "tokens") -> DataFrame:
    return df.withColumn("terms", F.transform(F.col(ids_col), lambda x: x.cast("string")))


#: token ids below this are trained on the counts of their pairs
MAX_PAIRED = 2048
WINDOW = 5
#: descents over the counts per pass, their first step, and tokens counted at a time
STEPS, RATE = 1000, 0.05
COUNT_STRETCH = 1 << 20


def _pair_counter(window: int, limit: int, stretch: int):
    """``mapInArrow`` over token ids: ``(a, b, n)``, how often ``b`` comes up to ``window`` places
    behind ``a`` in a sentence, ``d`` places counting ``window - d + 1`` times; ``b = -1`` are the
    occurrences of ``a``. An id that is null, negative or not below ``limit`` gives ``(-1, -1, 1)``."""
    def run(batches):
        pairs, seen, width, beyond = np.zeros((1, 1), dtype=np.int64), np.zeros(0, dtype=np.int64), 0, False
        for batch in batches:
            ids = batch.column(0)
            flat = ids.flatten()
            if beyond or not len(flat):
                continue
            most = -1 if flat.null_count else int(flat.to_numpy().max())
            beyond = most < 0 or most >= limit or int(flat.to_numpy().min()) < 0
            if beyond:
                continue
            if most >= width:
                grown, more = np.zeros((most + 2, most + 2), dtype=np.int64), np.zeros(most + 1, dtype=np.int64)
                grown[:width, :width], more[:width] = pairs[:width, :width], seen
                pairs, seen, width = grown, more, most + 1
            flat, sizes = flat.to_numpy(), ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes, dtype=np.int64)
            begin = row = 0
            while row < len(ends):
                last = max(row + 1, int(np.searchsorted(ends, begin + stretch, side="right")))
                part, own = flat[begin:ends[last - 1]], sizes[row:last]
                begin, row = int(ends[last - 1]), last
                # sentences stand ``window`` places apart, with an id of no token between them
                text = np.full(len(part) + window * len(own), width, dtype=np.int64)
                text[np.arange(len(part)) + np.repeat(np.arange(len(own)) * window, own)] = part
                seen += np.bincount(part, minlength=width)
                for d in range(1, window + 1):
                    code = text[:-d] * (width + 1) + text[d:]
                    pairs += (window - d + 1) * np.bincount(code, minlength=(width + 1) ** 2).reshape(pairs.shape)
        a, b = np.nonzero(pairs[:width, :width])
        own = np.nonzero(seen)[0]
        n = [pairs[a, b], seen[own]]
        a, b = np.concatenate([a, own]), np.concatenate([b, np.full(len(own), -1)])
        if beyond:
            a, b, n = [-1], [-1], [[1]]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(np.concatenate(n), pa.int64())], ["a", "b", "n"])

    return run


def pair_counts(sentences: DataFrame, ids_col: str) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """``(tokens, occurrences, pairs)`` of all sentences: the distinct token ids, the most frequent
    first, how often each occurs, and the V × V weighted numbers of times that two stand within
    ``WINDOW`` places, both ways. None if an id is not below ``MAX_PAIRED``. A task sends its sums,
    whatever its number of tokens; they are integers, so any partitioning gives the same."""
    ids = sentences.select(F.col(ids_col).cast("array<int>").alias("ids")).where(F.size("ids") > 0)
    sums = ids.mapInArrow(_pair_counter(WINDOW, MAX_PAIRED, COUNT_STRETCH), "a int, b int, n long")
    t = sums.groupBy("a", "b").agg(F.sum("n").alias("n")).toArrow()     # at most MAX_PAIRED ** 2 rows
    a, b, n = (t.column(c).to_numpy() for c in ("a", "b", "n"))
    if (a < 0).any():
        return None
    own = b < 0
    order = np.lexsort((a[own], -n[own]))
    tokens, seen = a[own][order], n[own][order]
    at = np.zeros(int(tokens.max(initial=-1)) + 1, dtype=np.int64)
    at[tokens] = np.arange(len(tokens))
    pairs = np.zeros((len(tokens), len(tokens)), dtype=np.int64)
    pairs[at[a[~own]], at[b[~own]]] = n[~own]
    return tokens, seen, pairs + pairs.T


def _huffman(seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(on, zero)``, V × (V - 1): the inner nodes on the way to a token, and those where it goes to
    the first child."""
    v = len(seen)
    on, zero = np.zeros((v, max(v - 1, 0))), np.zeros((v, max(v - 1, 0)))
    heap, below = [(int(n), i) for i, n in enumerate(seen)], {i: [i] for i in range(v)}
    heapq.heapify(heap)
    for node in range(v - 1):
        (m, first), (n, second) = heapq.heappop(heap), heapq.heappop(heap)
        first, second = below.pop(first), below.pop(second)
        on[first + second, node], zero[first, node] = 1, 1
        below[v + node] = first + second
        heapq.heappush(heap, (m + n, v + node))
    return on, zero


def skip_gram(seen: np.ndarray, pairs: np.ndarray, dim: int, seed: int, steps: int) -> np.ndarray:
    """V × ``dim`` vectors that tell the neighbours of a token by hierarchical softmax: the loss of
    skip-gram over all pairs of the corpus depends on their numbers only, so the sum over V × V of
    them is descended (Adam, the step falling to 0), each token and node by the mean over its pairs."""
    vectors = np.random.default_rng(seed).uniform(-0.5, 0.5, (len(seen), dim)) / dim
    on, zero = _huffman(seen)
    asked, first = pairs @ on, pairs @ zero
    asked_of, asked_at = np.maximum(asked.sum(axis=1), 1)[:, None], np.maximum(asked.sum(axis=0), 1)[:, None]
    params = [vectors, np.zeros((on.shape[1], dim))]
    mean, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        error = asked / (1 + np.exp(-np.clip(params[0] @ params[1].T, -30, 30))) - first
        for k, g in enumerate((error @ params[1] / asked_of, error.T @ params[0] / asked_at)):
            mean[k] += 0.1 * (g - mean[k])
            square[k] += 0.001 * (g * g - square[k])
            move = mean[k] / (1 - 0.9 ** step) / (np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-8)
            params[k] = params[k] - RATE * (1 - (step - 1) / steps) * move
    return params[0]


class PairWord2Vec(Word2Vec):
    """Spark's Word2Vec, trained on the numbers of the pairs (``skip_gram``) in place of a step per
    token and neighbour: one pass counts every window of every sentence, with the share of windows
    that reach so far as its weight. Ids of ``MAX_PAIRED`` and more go Spark's way, on as many
    partitions as the cluster has cores; windows are never cut short by a limit on the line length."""

    ids_col = "tokens"

    def _fit_java(self, dataset: DataFrame):
        counted = pair_counts(dataset, self.ids_col)
        if counted is None or not len(counted[0]):
            longest = dataset.agg(F.max(F.size(self.ids_col))).first()[0] or 1
            self.setMaxSentenceLength(max(1000, longest))
            return super()._fit_java(dataset)
        tokens, seen, pairs = counted
        vectors = skip_gram(seen, pairs, self.getVectorSize(), self.getSeed(), STEPS * self.getMaxIter())
        sc = dataset.sparkSession.sparkContext
        by_term = sc._jvm.java.util.HashMap()
        for token, vector in zip(tokens.tolist(), vectors.tolist()):
            row = sc._gateway.new_array(sc._jvm.float, len(vector))
            for i, x in enumerate(vector):
                row[i] = x
            by_term[str(token)] = row
        model = sc._jvm.org.apache.spark.mllib.feature.Word2VecModel(sc._jvm.PythonUtils.toScalaMap(by_term))
        return sc._jvm.org.apache.spark.ml.feature.Word2VecModel(self.uid, model)


def _word2vec(terms: DataFrame, dim: int, seed: int, out: str, max_iter: int = 1, ids_col: str = "tokens") -> Word2Vec:
    w2v = PairWord2Vec(vectorSize=dim, minCount=1, seed=seed, inputCol="terms", outputCol=out, maxIter=max_iter,
                       windowSize=WINDOW, numPartitions=terms.sparkSession.sparkContext.defaultParallelism)
    w2v.ids_col = ids_col
    return w2v


def pretrain_vectors(encoded: DataFrame, dim: int = 32, seed: int = 0, ids_col: str = "ids",
                     max_iter: int = 1) -> DataFrame:
    """M1: token vectors ``(token INT, vector ARRAY<DOUBLE>)`` from encoded sentences."""
    terms = _as_terms(encoded, ids_col).where(F.size(ids_col) > 0)
    model = _word2vec(terms, dim, seed, "w2v", max_iter, ids_col).fit(terms)
    from pyspark.ml.functions import vector_to_array
    return model.getVectors().select(F.col("word").cast("int").alias("token"),
                                     vector_to_array("vector").alias("vector"))


def fit_classifier(train: DataFrame, use_pretrained: bool, dim: int = 32, seed: int = 0,
                   max_iter: int = 20, unlabelled: DataFrame | None = None) -> PipelineModel:
    """M2: ``train(doc_id, tokens ARRAY<INT>, label BOOLEAN)`` → fitted pipeline.

    With ``use_pretrained`` the features are the mean Word2Vec vector of the
    document (vectors learned on ``unlabelled`` if given, else on ``train``);
    otherwise token counts."""
    df = _as_terms(train).withColumn("y", F.col("label").cast("double"))
    if use_pretrained:
        if unlabelled is not None:
            terms = _as_terms(unlabelled, "ids").where(F.size("ids") > 0)
            w2v = _word2vec(terms, dim, seed, "features", ids_col="ids").fit(terms)
            lr = LogisticRegression(featuresCol="features", labelCol="y", maxIter=max_iter).fit(w2v.transform(df))
            return PipelineModel(stages=[w2v, lr])
        stages = [_word2vec(df, dim, seed, "features")]
    else:
        # token ids are dense: every one of them is a column
        width = (df.agg(F.max(F.array_max("tokens"))).first()[0] or 0) + 1
        stages = [CountVectorizer(inputCol="terms", outputCol="features", minDF=1.0, vocabSize=width)]
    stages.append(LogisticRegression(featuresCol="features", labelCol="y", maxIter=max_iter))
    return Pipeline(stages=stages).fit(df)


def score_documents(model: PipelineModel, docs: DataFrame) -> DataFrame:
    """M3: ``(doc_id, pred BOOLEAN, label)`` — argmax of the two class scores."""
    from pyspark.ml.functions import vector_to_array
    out = model.transform(_as_terms(docs))
    probs = vector_to_array("probability")
    return out.select("doc_id", (F.array_position(probs, F.array_max(probs)) - 1 == 1).alias("pred"),
                      F.col("label").alias("truth"))


def training_rows(train: DataFrame, val: DataFrame, use_pretrained: bool, epochs: int, dim: int = 32, seed: int = 0,
                  unlabelled: DataFrame | None = None, path: str | None = None, **how) -> DataFrame:
    """The course of M2: ``(step_key, epoch, split, loss, accuracy)``, a row per
    document, split and epoch, of mini-batch training (``operators.training``) on token
    shares or, with ``use_pretrained``, on mean token vectors. ``path`` keeps the epochs'
    checkpoints; training goes on from those it holds (default: a fresh folder)."""
    splits = {"train": train, "val": val}
    if use_pretrained:
        from pyspark.ml.functions import vector_to_array
        source, ids_col = (train, "tokens") if unlabelled is None else (unlabelled, "ids")
        terms = _as_terms(source, ids_col).where(F.size(ids_col) > 0)
        model = _word2vec(terms, dim, seed, "features", ids_col=ids_col).fit(terms)
        data = {k: TR.vector_features(model.transform(_as_terms(df)).withColumn("features", vector_to_array("features")), "features")
                for k, df in splits.items()}
        width = dim
    else:
        data = {k: TR.token_features(df) for k, df in splits.items()}
        width = max(df.agg(F.max(F.array_max("tokens"))).first()[0] or 0 for df in splits.values()) + 1
    path = path or os.path.join(checkpoint_dir(train.sparkSession), "scratch", f"training-{uuid.uuid4().hex[:12]}")
    return TR.training_rows({k: cut_lineage(df) for k, df in data.items()}, width, epochs, path, seed=seed, **how)


def training_history(rows: DataFrame, batch_size: int) -> DataFrame:
    """A7 over ``training_rows``: ``(epoch, split, metric, value, n_batches)``,
    means over full batches of the batch means of loss and accuracy."""
    batched = cut_lineage(metrics_batches(rows, batch_size))
    parts = [epoch_metrics(batched, metric, batch_size).withColumn("metric", F.lit(metric)) for metric in ("loss", "accuracy")]
    return parts[0].unionByName(parts[1])
