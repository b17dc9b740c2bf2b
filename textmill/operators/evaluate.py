"""Evaluation aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.operators.index import dense_index_within
from textmill.operators.joins import broadcast_if_small


def argmax_label(col: str) -> F.Column:
    """Index of the largest score; ties → lowest index."""
    return (F.array_position(F.col(col), F.array_max(F.col(col))) - 1).cast("int")


def confusion_accuracy(df: DataFrame, pred: str = "pred", truth: str = "truth") -> DataFrame:
    """TP, TN, FP, FN and (TP+TN)/total in one aggregation."""
    p, t = F.col(pred).cast("boolean"), F.col(truth).cast("boolean")

    def n(c):
        return F.sum(c.cast("long"))

    return df.agg(n(p & t).alias("tp"), n(~p & ~t).alias("tn"), n(p & ~t).alias("fp"), n(~p & t).alias("fn"),
                  F.round(n(p == t) / F.count(F.lit(1)), 6).alias("accuracy"))


def log_softmax_loss(logits: str, label: str) -> F.Column:
    """Per-row cross entropy ``logsumexp(logits) - logits[label]``, stable form."""
    x = F.col(logits).cast("array<double>")
    m = F.array_max(x)
    lse = F.log(F.aggregate(x, F.lit(0.0), lambda acc, v: acc + F.exp(v - m))) + m
    return lse - F.element_at(x, F.col(label).cast("int") + 1)


def masked_cross_entropy(df: DataFrame, logits: str = "logits", label: str = "label",
                         mask: str | None = None) -> DataFrame:
    """Mean cross entropy over the rows (positions) selected by ``mask``."""
    if mask is not None:
        df = df.where(F.col(mask))
    return df.agg(F.count(F.lit(1)).alias("n"),
                  F.round(F.avg(log_softmax_loss(logits, label)), 6).alias("loss"))


def metrics_batches(rows: DataFrame, batch_size: int, group=("epoch", "split"), order="step_key") -> DataFrame:
    """Fixed-order batches inside each (epoch, split); last partial batch dropped
    (its rows do not count, as with ``drop_last``). Skew-safe per-group index."""
    ranked = dense_index_within(rows, list(group), [order], out="_rn")
    # a row per group: broadcast, so that a large group is not brought together
    sizes = broadcast_if_small(rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")))
    return (ranked.join(sizes, list(group))
                  .where(F.col("_rn") < F.floor(F.col("_n") / batch_size) * batch_size)
                  .withColumn("batch", F.floor(F.col("_rn") / batch_size).cast("long"))
                  .drop("_rn", "_n"))


def epoch_metrics(batched: DataFrame, value: str = "value", batch_size: int = 16) -> DataFrame:
    """Per (epoch, split): mean over batches of the batch means.

    Batches are full (``drop_last``), so the mean of means is
    ``sum(batch sums) / (batch_size * n_batches)``. Sums are taken in integer
    micro-units and the 6-decimal half-up rounding is done in integer
    arithmetic, so the result does not depend on summation order."""
    micro = F.round(F.col(value) * 1_000_000).cast("long")
    per_batch = batched.groupBy("epoch", "split", "batch").agg(F.sum(micro).alias("_s"))
    agg = per_batch.groupBy("epoch", "split").agg(F.sum("_s").alias("_n"), F.count(F.lit(1)).alias("n_batches"))
    rounded = F.expr(f"(2 * _n + {batch_size} * n_batches) div (2 * {batch_size} * n_batches)")
    return agg.select("epoch", "split", (rounded.cast("double") / 1_000_000).alias("value"), "n_batches")


def final_metrics(metrics: DataFrame) -> DataFrame:
    """Value at the last epoch of each split."""
    return metrics.groupBy("split").agg(F.max_by("value", "epoch").alias("final_value"),
                                        F.max("epoch").alias("last_epoch"))


def compare_runs(metrics: DataFrame, splits: list[str]) -> DataFrame:
    """M4: learning-curve table, one column per split (``x = epoch + 1``)."""
    return (metrics.groupBy("epoch").pivot("split", splits).agg(F.first("value"))
                   .withColumn("x", F.col("epoch") + 1))
