"""Small shared pieces of the corpus operators."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.session import checkpoint_dir

SPACE = "\x20\t\n\x0b\x0c\r"            # [\x20\x09-\x0D]
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


TEXT_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def _arrow_batches(spark: SparkSession, rows: int | None):
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(rows or before))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def written(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: the lineage ends there, the files outlive executors, and the plan
    after it knows the size.

    ``batch_rows``: rows that go to a Python task at a time (``TEXT_ROWS`` for whole texts:
    a batch lies in the JVM and in the worker at once, and both keep the memory
    for later stages)."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    with _arrow_batches(spark, batch_rows):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def deleted(df: DataFrame) -> None:
    """Remove the folder that ``written`` made for ``df``, once later tables stand
    in its place."""
    jvm = df.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(df.written_to)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: a plain reference inside a
    lambda would be evaluated again for every element."""
    return F.transform(F.array(value), body).getItem(0)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def text_key(text: Column) -> Column:
    """Tells rows apart that share a ``doc_id``."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


BROADCAST_BYTES = 32 << 20


def broadcast_if_small(df: DataFrame, row_bytes: Column | int) -> DataFrame:
    """Mark a written table for broadcast if its measured size is at most
    ``BROADCAST_BYTES``; beyond that the join shuffles both sides."""
    total = df.agg(F.sum(F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes)).first()[0] or 0
    return F.broadcast(df) if total <= BROADCAST_BYTES else df
