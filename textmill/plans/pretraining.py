"""End-to-end pre-training data job: paragraphs → learned byte-pair
vocabulary → encoded corpus (persisted once) → sentence-pair / masked-token
examples → per-epoch assignment and audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.operators import encode as E
from textmill.operators import examples as X
from textmill.operators import vocab as V
from textmill.session import cut_lineage
from textmill.sources import tables as TB


def build_corpus(spark: SparkSession, sentences: DataFrame, max_vocab_size: int) -> dict:
    """Learn a vocabulary from the paragraphs' own words and encode them."""
    words = TB.corpus_words(sentences.select(F.col("paragraph_id").alias("doc_id"),
                                             F.col("sentence").alias("text")))
    idx2word, merges = V.bpe_train(spark, words, max_vocab_size)
    vocab = V.vocab_table(spark, idx2word)
    encoded = cut_lineage(E.encode_sentences(sentences, vocab))
    return {"vocab": vocab, "idx2word": idx2word, "merges": merges, "encoded": encoded,
            "token_num": len(idx2word)}


def generate(spark: SparkSession, corpus: dict, n_examples: int, seed: int = 0) -> DataFrame:
    index = X.prepare_paragraphs(corpus["encoded"])
    return X.epoch_assign(X.pretrain_examples(index, n_examples, corpus["token_num"], seed))


def flagship(spark: SparkSession, sf_dir: str, max_vocab_size: int = 120, seed: int = 0) -> DataFrame:
    """Conversations as paragraphs, one example per turn."""
    sentences = TB.conversations_as_paragraphs(TB.load(spark, sf_dir, "conversations"))
    corpus = build_corpus(spark, sentences, max_vocab_size)
    n = sentences.count()
    return generate(spark, corpus, n, seed)
