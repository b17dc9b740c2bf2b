"""Dense row numbers without a single-partition window.

``dense_index``         0-based position in the global order of ``order_cols``.
``dense_index_within``  0-based position inside each group of ``key_cols``.

Both range-partition on the full sort key, so one hot group is spread over as
many partitions as its size needs; positions are then local counters plus a
per-partition offset. The partitioned rows are checkpointed once and both the
counts and the result are read from there: two separate range exchanges would
sample their boundaries separately and disagree. The offset tables have one row per partition, so
broadcasting them is bounded by the partition count, not by the data.
``order_cols`` must make rows unique (add a tiebreak column if needed): that is
what makes a recomputed partition come out in the same order after an executor
loss.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.session import cut_lineage


def _n_parts(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _ranged(df: DataFrame, sort_cols: list[str], num_partitions: int | None) -> DataFrame:
    n = _n_parts(df, num_partitions)
    return (df.repartitionByRange(n, *sort_cols)
              .sortWithinPartitions(*sort_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_local", F.monotonically_increasing_id()
                          - F.shiftleft(F.col("_pid").cast("long"), 33)))


def dense_index(df: DataFrame, order_cols: list[str], out: str = "rn",
                num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 0-based rank of each row in the order of ``order_cols``."""
    ranged = cut_lineage(_ranged(df, list(order_cols), num_partitions))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: a bounded table, safe to window and broadcast
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    return (ranged.join(F.broadcast(offsets), "_pid")
                  .withColumn(out, (F.col("_off") + F.col("_local")).cast("long"))
                  .drop("_pid", "_local", "_off"))


def _local_group_rank(key_cols: list[str]):
    """Per partition (already sorted by keys): rank of each row inside its key
    run, carried across Arrow batches of the same partition. Works on Arrow
    batches directly so payload columns pass through with their exact types."""

    def fn(batches):
        prev_key, prev_cnt = None, 0
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                yield batch.append_column("_lrank", pa.array([], pa.int64()))
                continue
            keys = [batch.column(c) for c in key_cols]
            change = np.zeros(n, dtype=bool)
            change[0] = True
            for k in keys:  # two nulls are one group
                differ = pc.fill_null(pc.not_equal(k[1:], k[:-1]), False)
                null = k.is_null().to_numpy(zero_copy_only=False)
                change[1:] |= differ.to_numpy(zero_copy_only=False) | (null[1:] != null[:-1])
            first_key = tuple(k[0].as_py() for k in keys)
            carry = prev_key is not None and first_key == prev_key
            if carry:
                change[0] = False
            idx = np.arange(n)
            start = np.maximum.accumulate(np.where(change, idx, 0))
            lrank = idx - start
            if carry:
                lrank = lrank + np.where(start == 0, prev_cnt, 0)
            prev_key = tuple(k[-1].as_py() for k in keys)
            prev_cnt = int(lrank[-1]) + 1
            yield batch.append_column("_lrank", pa.array(lrank.astype(np.int64), pa.int64()))

    return fn


def dense_index_within(df: DataFrame, key_cols: list[str], order_cols: list[str],
                       out: str = "idx", num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 0-based rank of each row inside its ``key_cols`` group,
    ordered by ``order_cols``; a group may span several partitions."""
    key_cols, order_cols = list(key_cols), list(order_cols)
    ranged = _ranged(df, key_cols + order_cols, num_partitions)
    schema = T.StructType(ranged.schema.fields + [T.StructField("_lrank", T.LongType(), False)])
    ranked = cut_lineage(ranged.mapInArrow(_local_group_rank(key_cols), schema))
    keys = F.struct(*key_cols)
    summary = ranked.groupBy("_pid").agg(
        F.min_by(keys, "_local").alias("_fk"),
        F.max_by(F.struct(keys.alias("k"), F.col("_lrank").alias("r")), "_local").alias("_last"))
    # offset of a partition's first key: rows of that key in earlier partitions,
    # each of which has it as its last key. Both sides are one row per partition.
    s1 = summary.select("_pid", "_fk")
    s2 = summary.select(F.col("_pid").alias("_q"), F.col("_last.k").alias("_lk"),
                        (F.col("_last.r") + 1).alias("_c"))
    offsets = (s1.join(s2, (s2["_lk"].eqNullSafe(s1["_fk"])) & (s2["_q"] < s1["_pid"]), "left")
                 .groupBy("_pid", "_fk").agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("_off")))
    return (ranked.join(F.broadcast(offsets), "_pid")
                  .withColumn(out, (F.col("_lrank") + F.when(keys.eqNullSafe(F.col("_fk")), F.col("_off"))
                                    .otherwise(F.lit(0))).cast("long"))
                  .drop("_pid", "_local", "_lrank", "_fk", "_off"))
