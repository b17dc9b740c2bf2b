"""Queries and DuckDB SQL of the corpus operators."""

from __future__ import annotations

from textmill.llm import common
from textmill.llm.decontaminate import op7_decontamination
from textmill.llm.divergence_audit import op13_source_divergence_audit
from textmill.llm.license_scan import op6_license_scan
from textmill.llm.line_dedup import op5_line_dedup
from textmill.llm.ngram_join import op12_ngram_jaccard_join
from textmill.llm.oracle import ORACLES
from textmill.llm.packing import op9_best_fit_packing
from textmill.llm.quality_classifier import op8_quality_classifier
from textmill.llm.quality_rules import op10_quality_rules
from textmill.llm.secret_scan import op1_secret_scan
from textmill.llm.simhash_dedup import op2_simhash_dedup
from textmill.llm.substring_dedup import op4_substring_dedup
from textmill.llm.toxicity import op3_toxicity
from textmill.llm.vector_codes import op11_vector_codes

_ON_DOCUMENTS = {
    "op1_secret_scan": op1_secret_scan,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_line_dedup": op5_line_dedup,
    "op6_license_scan": op6_license_scan,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_quality_rules": op10_quality_rules,
    "op12_ngram_jaccard_join": op12_ngram_jaccard_join,
    "op13_source_divergence_audit": op13_source_divergence_audit,
}
_WITH_TABLE = {
    "op3_toxicity": (op3_toxicity, "labels"),
    "op7_decontamination": (op7_decontamination, "benchmark"),
    "op8_quality_classifier": (op8_quality_classifier, "labels"),
}


def queries():
    def on_documents(op):
        return lambda spark, sf_dir: op(common.documents(spark, sf_dir))

    def with_table(op, name):
        return lambda spark, sf_dir: op(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/{name}.parquet"))
    return ({name: on_documents(op) for name, op in _ON_DOCUMENTS.items()}
            | {"op11_vector_codes": lambda spark, sf_dir: op11_vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))}
            | {name: with_table(*v) for name, v in _WITH_TABLE.items()})


def oracles():
    return dict(ORACLES)
