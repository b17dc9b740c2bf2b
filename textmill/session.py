"""Session construction and lineage cutting.

Iterative jobs (vocabulary training) cut their lineage with a reliable
``DataFrame.checkpoint()`` into the shared folder named by the cluster in
``spark.checkpoint.dir``. The library never invents a folder of its own: only
``build_session`` (used by tests, bench and the driver entry) fills the setting
in when it is unset.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

_CONF_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "textmill", extra: dict | None = None) -> SparkSession:
    """Session for tests/bench. Sets a scratch checkpoint folder only for a local
    master and when none is configured; a cluster must name its shared folder."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, local_fallback=is_single_jvm(spark))
    return spark


def is_single_jvm(spark: SparkSession) -> bool:
    """True for ``local`` / ``local[n]`` masters, where a local folder is shared."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession, local_fallback: bool = False) -> str:
    """Make sure the SparkContext checkpoints into ``spark.checkpoint.dir``.

    ``local_fallback`` is for tests and the local driver harness only: a fresh
    ``mktemp``-style folder is used when the session names none.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(_CONF_KEY, None) or sc.getConf().get(_CONF_KEY, None)
    if not configured:
        if not local_fallback:
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="textmill-ckpt-", dir="/tmp")
        spark.conf.set(_CONF_KEY, configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def checkpoint_dir(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark, local_fallback=False)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint (survives executor loss), never ``localCheckpoint``."""
    ensure_checkpoint_dir(df.sparkSession, local_fallback=False)
    return df.checkpoint(eager=eager)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet files in the shared checkpoint folder: like a checkpoint it cuts the
    lineage, but it is compressed and only the columns in use are read back."""
    import os
    import uuid

    path = os.path.join(checkpoint_dir(df.sparkSession), "tables", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_bucketed(df: DataFrame, buckets: int, cols: list[str], name: str) -> DataFrame:
    """Write ``df`` as a table bucketed on ``cols`` into the shared checkpoint
    folder and read it back. Unlike a checkpoint, the read keeps the hash
    layout, so every later join on ``cols`` shuffles only its other side."""
    import os
    import uuid

    table = f"tm_{name}_{uuid.uuid4().hex[:12]}"
    path = os.path.join(checkpoint_dir(df.sparkSession), "tables", table)
    # one task per bucket, hence one file per bucket
    df.repartition(buckets, *cols).write.bucketBy(buckets, *cols).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)
