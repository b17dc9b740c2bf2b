"""Join helpers with explicit size / skew handling.

``hot_key_join`` joins a large occurrence table to a one-row-per-key table
(e.g. word occurrences to encoded distinct words). Keys whose occurrence
count exceeds ``total / (partitions * spread)`` are *hot*: there are at most
``partitions * spread`` of them by construction, so their rows are broadcast
(a proven bound). Every other key goes through an ordinary shuffle join in
which no single key can hold more than a slice of one partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000  # row bound for broadcasting a data-derived table


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast if it has at most ``max_rows`` rows (counted);
    beyond that the join shuffles. Meant for vocabulary-like tables, whose rows
    are short."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def hot_key_join(big: DataFrame, per_key: DataFrame, key: str, key_counts: DataFrame,
                 spread: int = 4, how: str = "inner", hot_keys: int = 0) -> DataFrame:
    """``big ⋈ per_key`` on ``key``; ``key_counts(key, n)`` are occurrence counts
    of ``key`` in ``big`` (already computed upstream by a partial aggregation).

    With ``hot_keys`` up to that many of the most frequent keys (of at most 64
    characters) are broadcast as well, so that only the rare ones are shuffled."""
    parts = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # keys and rows per size class of n (powers of two): at most 64 rows
    sizes = (key_counts.groupBy(F.length(F.bin("n")).alias("c")).agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"))
             .collect())
    threshold = max(1, sum(r["n"] for r in sizes) // (parts * spread))  # <= parts*spread keys lie above
    also, taken = threshold, 0
    for r in sorted(sizes, key=lambda r: -r["c"]):
        taken += r["k"]
        if taken > hot_keys:
            break
        also = min(also, (1 << (r["c"] - 1)) - 1)                       # <= hot_keys keys lie above
    is_hot = F.col("n") > threshold
    if also < threshold:
        is_hot = is_hot | ((F.col("n") > also) & (F.length(F.col(key)) <= 64))
    top = F.broadcast(key_counts.where(is_hot).select(key))
    hot = per_key.join(top, key)
    big_hot = big.join(F.broadcast(hot), key, how)
    big_cold = big.join(top, key, "left_anti").join(per_key, key, how)
    return big_hot.unionByName(big_cold)
