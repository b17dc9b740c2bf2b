"""Training over epochs (M2): mini-batch steps, weights carried on, a checkpoint per epoch.

The model is a logistic one over ``(idx ARRAY<INT>, val ARRAY<DOUBLE>)`` features;
an index may stand in ``idx`` more than once (its values add up). An epoch takes the batches of
T3 in a new keyed order (T4) and deals them to ``workers`` by their place in that
order. Each worker streams its batches, one step each, from the weights the epoch
began with; the epoch's weights are the mean of theirs, weighted by steps and added
in the order of the workers. One worker is plain mini-batch descent.

The weights and the sums of squared gradients (AdaGrad) of every epoch are written to
``path`` before the epoch is entered in ``path/progress``. Training that was stopped
goes on behind the last entered epoch, and since an epoch is a function of the rows
and the weights before it, it ends with the weights of an unbroken run.

Bounds: a worker holds the weights and one batch; the driver holds the weights
(``width`` of them: a vocabulary or a vector, not data). ``doc_id`` must be unique;
rows without features or label are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.operators.batching import length_buckets, shuffle_batches
from textmill.session import cut_lineage

MAX_WIDTH = 4_000_000
#: added to the squares, so that the rounding noise of a gradient of zero is not scaled up to a step
EPSILON = 1e-8


def token_features(docs: DataFrame, ids_col: str = "tokens") -> DataFrame:
    """``(doc_id, idx, val, y)``: the share of each token id in the document, an entry per
    distinct id: an epoch sorts and reads these, not the document's tokens."""
    shares = T.StructType([T.StructField("idx", T.ArrayType(T.IntegerType())), T.StructField("val", T.ArrayType(T.DoubleType()))])

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            sizes = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = batch.flatten().to_numpy(zero_copy_only=False)
            idx, val, begin = [np.zeros(0, dtype=np.int64)], [np.zeros(0)], 0
            ends = [0]
            for size in sizes.tolist():
                ids, n = np.unique(flat[begin:begin + size], return_counts=True)
                idx.append(ids)
                val.append(n / max(size, 1))
                ends.append(ends[-1] + len(ids))
                begin += size
            ends = pa.array(ends, pa.int32())
            yield pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, pa.array(np.concatenate(idx).astype(np.int32))),
                                              pa.ListArray.from_arrays(ends, pa.array(np.concatenate(val)))], ["idx", "val"])

    ids = F.col(ids_col).cast("array<int>")
    found = docs.select("doc_id", F.arrow_udf(count, shares)(ids).alias("z"), ids.isNotNull().alias("known"), F.col("label").cast("double").alias("y"))
    return found.select("doc_id", F.when(F.col("known"), F.col("z.idx")).alias("idx"), F.when(F.col("known"), F.col("z.val")).alias("val"), "y")


def vector_features(docs: DataFrame, vector_col: str) -> DataFrame:
    """``(doc_id, idx, val, y)`` from a dense array column."""
    return docs.select("doc_id", F.transform(vector_col, lambda _, i: i).cast("array<int>").alias("idx"),
                       F.col(vector_col).cast("array<double>").alias("val"), F.col("label").cast("double").alias("y"))


def completed(spark, path: str) -> int:
    """Epochs entered in ``path`` so far."""
    try:
        last = spark.read.schema("epoch long").parquet(f"{path}/progress").agg(F.max("epoch")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return 0 if last is None else last + 1


def weights(spark, path: str, epochs: int) -> DataFrame:
    """``(epoch, i, w, g2)`` of the first ``epochs`` epochs; index ``width`` is the constant."""
    folders = [f"{path}/weights/epoch={e}" for e in range(epochs)]
    return spark.read.option("basePath", f"{path}/weights").schema("i int, w double, g2 double, epoch long").parquet(*folders)


def _stepper(start: np.ndarray, squares: np.ndarray, rate: float):
    """``mapInPandas`` over rows sorted by worker, batch order and slot."""
    def one_step(w, g2, rows):
        idx = [np.append(np.asarray(r[0], dtype=np.int64), len(w) - 1) for r in rows]
        val = [np.append(np.asarray(r[1], dtype=np.float64), 1.0) for r in rows]
        owner = np.repeat(np.arange(len(rows)), [len(i) for i in idx])
        idx, val = np.concatenate(idx), np.concatenate(val)
        z = np.bincount(owner, weights=val * w[idx], minlength=len(rows))
        error = 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))) - np.asarray([r[2] for r in rows])
        at, back = np.unique(idx, return_inverse=True)
        g = np.bincount(back, weights=val * error[owner]) / len(rows)
        g2[at] += g * g
        w[at] -= rate * g / np.sqrt(g2[at] + EPSILON)

    def run(parts):
        worker, batch, rows, steps, w, g2 = None, None, [], 0, None, None

        def result():
            return pd.DataFrame({"worker": [worker], "steps": [steps], "w": [w.tolist()], "g2": [g2.tolist()]})

        for part in parts:
            for r in part.itertuples(index=False):
                if rows and (r.worker, r.batch_order) != (worker, batch):
                    one_step(w, g2, rows)
                    rows, steps = [], steps + 1
                if r.worker != worker:
                    if worker is not None:
                        yield result()
                    worker, steps, w, g2 = r.worker, 0, start.copy(), squares.copy()
                batch = r.batch_order
                rows.append((r.idx, r.val, r.y))
        if rows:
            one_step(w, g2, rows)
            steps += 1
            yield result()

    return run


def train(data: DataFrame, width: int, epochs: int, path: str, batch_size: int = 16, rate: float = 0.3,
          workers: int = 8, seed: int = 0) -> DataFrame:
    """Weights of ``epochs`` epochs over ``data(doc_id, idx, val, y)``, going on from
    what ``path`` (a shared folder) holds already. No rows: the weights stay zero."""
    spark = data.sparkSession
    if width > MAX_WIDTH:
        raise ValueError(f"{width} weights; the driver and every worker hold them, so at most {MAX_WIDTH}")
    batched = cut_lineage(length_buckets(data.where(F.col("idx").isNotNull() & F.col("y").isNotNull()),
                                         batch_size, ids_col="idx"))
    for epoch in range(completed(spark, path), epochs):
        w, g2 = np.zeros(width + 1), np.zeros(width + 1)
        if epoch:
            last = weights(spark, path, epoch).where(F.col("epoch") == epoch - 1).toPandas()  # the model: width + 1 rows
            w[last["i"]], g2[last["i"]] = last["w"], last["g2"]
        order = shuffle_batches(batched, seed, epoch)
        dealt = (batched.join(order, "batch_id")
                 .select((F.col("batch_order") % workers).alias("worker"), "batch_order", "slot", "idx", "val", "y")
                 .repartition(workers, "worker").sortWithinPartitions("worker", "batch_order", "slot"))
        ends = dealt.mapInPandas(_stepper(w, g2, rate), "worker long, steps long, w array<double>, g2 array<double>")
        values = ends.select("worker", "steps", F.posexplode(F.arrays_zip("w", "g2")).alias("i", "z"))
        # a list holds one entry per worker
        per_weight = values.groupBy("i").agg(F.array_sort(F.collect_list(
            F.struct("worker", "steps", F.col("z.w").alias("w"), F.col("z.g2").alias("g2")))).alias("l"))

        def mean(field):
            return F.aggregate("l", F.lit(0.0), lambda s, v: s + v[field] * v["steps"]) / F.aggregate(
                "l", F.lit(0).cast("long"), lambda s, v: s + v["steps"])

        per_weight.select("i", mean("w").alias("w"), mean("g2").alias("g2")).write.mode("overwrite").parquet(
            f"{path}/weights/epoch={epoch}")
        spark.range(epoch, epoch + 1).select(F.col("id").alias("epoch")).coalesce(1).write.mode("append").parquet(f"{path}/progress")
    return weights(spark, path, epochs)


def scored(data: DataFrame, learned: DataFrame, width: int) -> DataFrame:
    """``(step_key, epoch, loss, accuracy)``: every row by the weights of every epoch, in
    one pass over the rows."""
    rows = learned.select("epoch", "i", "w").toPandas()  # the models: epochs x (width + 1) rows
    epochs = np.sort(rows["epoch"].unique())
    table = np.zeros((len(epochs), width + 1))
    table[np.searchsorted(epochs, rows["epoch"]), rows["i"]] = rows["w"]
    sent = data.sparkSession.sparkContext.broadcast(table)

    def score(parts):
        w = sent.value
        for part in parts:
            y = part["y"].to_numpy() == 1.0
            z = np.empty((len(part), len(w)))
            for k, (idx, val) in enumerate(zip(part["idx"], part["val"])):
                z[k] = w[:, -1] + w[:, np.asarray(idx, dtype=np.int64)] @ np.asarray(val, dtype=np.float64)
            yield pd.DataFrame({
                "step_key": np.repeat(part["doc_id"].to_numpy(), len(w)), "epoch": np.tile(epochs, len(part)),
                "loss": np.logaddexp(0.0, np.where(y[:, None], -z, z)).ravel(),
                "accuracy": ((z > 0) == y[:, None]).astype(float).ravel()})

    usable = data.where(F.col("idx").isNotNull() & F.col("y").isNotNull())
    return usable.select("doc_id", "idx", "val", "y").mapInPandas(
        score, f"step_key {data.schema['doc_id'].dataType.simpleString()}, epoch long, loss double, accuracy double")


def training_rows(splits: dict[str, DataFrame], width: int, epochs: int, path: str, **how) -> DataFrame:
    """``(step_key, epoch, split, loss, accuracy)``, a row per document, split and epoch,
    of a model trained on ``splits['train']``; the input of A7."""
    learned = train(splits["train"], width, epochs, path, **how)
    out = None
    for split, data in splits.items():
        part = scored(data, learned, width).withColumn("split", F.lit(split))
        out = part if out is None else out.unionByName(part)
    return cut_lineage(out)
