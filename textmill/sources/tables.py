"""Driver tables as paragraphs / sentences / words.

Paragraphs are kept in *long form* — one row per sentence,
``(paragraph_id, idx, sentence)`` — never collected into one array per
paragraph, so a conversation holding a third of all turns is still spread over
many tasks. A document's lines come from its single row, so exploding them is
bounded by that row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.constants import POSITIVE_LABEL, WORD_SPLIT_REGEX
from textmill.operators.index import dense_index_within

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


# unique keys: one long conversation is spread as well
_SPREAD_KEYS = {"documents": ["doc_id"], "conversations": ["conv_id", "turn"], "pages": ["page_id"]}


def load(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """Read one driver table. Text tables whose scan yields fewer splits than the
    cluster has cores (one big row group) are hash-spread on their id so the
    CPU-heavy text work uses every core; with many input files — the large
    case — the scan is already wide and nothing is added."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    key = _SPREAD_KEYS.get(name)
    if spread and key is not None:
        cores = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < cores:
            df = df.repartition(cores, *key)
    return df


def documents_as_paragraphs(documents: DataFrame) -> DataFrame:
    """``(paragraph_id, idx, sentence)``: each line of a document is a sentence."""
    return (documents.select(F.col("doc_id").alias("paragraph_id"),
                             F.posexplode(F.split(F.col("text"), "\n")).alias("idx", "sentence"))
                     .withColumn("idx", F.col("idx").cast("long")))


def conversations_as_paragraphs(conversations: DataFrame) -> DataFrame:
    """``(paragraph_id, idx, sentence)``: turns of a conversation in turn order,
    ``idx`` dense from 0 even when turn numbers have gaps (skew-safe index)."""
    turns = conversations.select(F.col("conv_id").alias("paragraph_id"), "turn",
                                 F.col("text").alias("sentence"))
    return (dense_index_within(turns, ["paragraph_id"], ["turn"], out="idx")
            .select("paragraph_id", "idx", "sentence"))


def corpus_size(documents: DataFrame) -> DataFrame:
    """A4: paragraphs, sentences and words in one aggregation."""
    lines = F.size(F.split(F.col("text"), "\n"))
    words = F.size(F.filter(F.split(F.lower(F.col("text")), WORD_SPLIT_REGEX), lambda w: w != ""))
    total = lambda n: F.coalesce(F.sum(n), F.lit(0)).cast("long")
    return documents.agg(F.count(F.lit(1)).alias("n_paragraphs"), total(lines).alias("n_sentences"),
                         total(words).alias("n_words"))


def corpus_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, pos, word)``: lower-cased whitespace-separated words; ``pos`` is
    the word position in its row, so ``(doc_id, pos)`` orders first occurrences."""
    return (df.select(F.col(id_col).alias("doc_id"),
                      F.posexplode(F.split(F.lower(F.col(text_col)), WORD_SPLIT_REGEX)).alias("pos", "word"))
              .where(F.col("word") != "")
              .withColumn("pos", F.col("pos").cast("long")))


def sentence_words(sentences: DataFrame) -> DataFrame:
    """``(paragraph_id, idx, wpos, word)`` words of every sentence in order."""
    return (sentences.select("paragraph_id", "idx",
                             F.posexplode(F.split(F.lower(F.col("sentence")), WORD_SPLIT_REGEX))
                             .alias("wpos", "word"))
                     .where(F.col("word") != "")
                     .withColumn("wpos", F.col("wpos").cast("long")))


def labelled_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with a label row, label text ``positive`` iff ``quality = 1``."""
    return (documents.join(labels.select("doc_id", "quality"), "doc_id")
                     .select("doc_id", "text",
                             F.when(F.col("quality") == 1, F.lit(POSITIVE_LABEL))
                              .otherwise(F.lit("negative")).alias("label_text")))
