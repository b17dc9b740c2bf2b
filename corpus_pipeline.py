"""Corpus preparation in five stages, from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last
give the columns of ``documents``. ``run`` writes every result as Parquet in the
shared checkpoint folder and reads it back as the next stage's input.
"""

from __future__ import annotations

from textmill.llm import common
from textmill.llm.decontaminate import drop_leaks
from textmill.llm.line_dedup import strip_lines
from textmill.llm.packing import pack
from textmill.llm.quality_rules import filter_documents
from textmill.llm.simhash_dedup import drop_near_duplicates


def quality_rules(spark, docs, sf_dir):
    """Documents that the rules reject go."""
    return filter_documents(docs)


def line_dedup(spark, docs, sf_dir):
    """Repeated lines go; the documents stay, some with shorter texts."""
    return strip_lines(docs)


def simhash_dedup(spark, docs, sf_dir):
    """One document of each group of near duplicates stays."""
    return drop_near_duplicates(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that hold a benchmark item go."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark, docs, sf_dir):
    """The remaining documents as pieces with their place in a sequence."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

ORACLE_SQL = None  # fingerprints and tokens have no SQL form; tests compare with a brute-force version


def run(spark, sf_dir):
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
