"""License scan by diagonal voting (operator 6).

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased.
Every rolling 3-word window of every document is hashed and joined to the
windows of the template texts (a fixed table of a few hundred rows, broadcast).
A hit at word ``pos`` of window ``tpos`` votes for the diagonal ``pos - tpos``.
Votes are counted per document, template and diagonal; diagonals at most
``DRIFT`` apart merge (insertions and deletions move a match to a neighbouring
diagonal). Merged groups of one template that follow each other both in the document, at
most ``INSERTED`` words apart, and in the template form a chain, as where a name
was put into a notice. A chain is verified when the distinct template windows it
hits, compared as words and not as hashes, cover ``MIN_COVER`` of the template.
``score`` is the best cover of the document (1 if a base phrase stands in it).

The base phrases are found by the same votes: a phrase stands at word ``s`` if
all its windows hit on diagonal ``s``.

One pass over the texts; only hits are shuffled, by document, and findings
join the documents' word counts (broadcast behind a check of their size).

Defined cases: a null text has no words; rows with the same ``doc_id`` and text
give the same result each; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import broadcast_if_small, let, text_key, written

K = 3
DRIFT = 2
INSERTED = 12
MIN_COVER = 0.6
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Opening words of well-known license notices
TEMPLATES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
           "associated documentation files the software to deal in the software without restriction",
    "mit-line": "released under the mit license",
    "apache-2": "licensed under the apache license version 2 0",
    "apache-2-notice": "you may not use this file except in compliance with the license",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted "
           "provided that the following conditions are met",
    "gpl": "this work is licensed under the gnu general public license version",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the "
                  "gnu general public license as published by the free software foundation",
    "lgpl": "under the terms of the gnu lesser general public license",
    "mpl-2": "this source code form is subject to the terms of the mozilla public license",
    "cc-by": "this work is licensed under a creative commons attribution",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee "
           "is hereby granted",
}
#: label reported for a template that is one of several texts of a license
LABEL = {"mit-line": "mit", "apache-2-notice": "apache-2", "gpl-notice": "gpl"}


_DOC = -1  # hash under which a document's own row joins


def template_windows(spark):
    """(h, gram, tmpl, tpos, n_windows, label, is_base) of all template windows,
    and the row that lets a document's own row through the join."""
    rows = [(None, None, None, None, None, None)]
    for name, text, label, is_base in [*((n, t, LABEL.get(n, n), False) for n, t in TEMPLATES.items()),
                                       *((p, p, lab, True) for p, lab in BASE.items())]:
        w = text.split()
        rows += [(" ".join(w[i:i + K]), name, i, len(w) - K + 1, label, is_base) for i in range(len(w) - K + 1)]
    df = spark.createDataFrame(rows, "gram string, tmpl string, tpos int, n_windows int, label string, is_base boolean")
    return df.withColumn("h", F.when(F.col("gram").isNull(), F.lit(_DOC).cast("long")).otherwise(F.xxhash64("gram")))


def hits(docs: DataFrame) -> DataFrame:
    """One row per template hit, and one with ``tmpl`` null per document (``n_words``)."""
    def cells(w):  # the word count, then the rolling windows
        own = F.array(F.size(w).cast("string"))
        grams = F.transform(F.sequence(F.lit(0), F.size(w) - K), lambda i: F.concat_ws(" ", *[w[i + j] for j in range(K)]))
        return F.when(F.size(w) >= K, F.concat(own, grams)).otherwise(own)

    # lower() leaves words apart from A-Z alike or non-ASCII, so no template can match by it
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col("text"), F.lit(""))), F.lit(WORDS), F.lit(0))
    rows = docs.select("doc_id", text_key(F.col("text")).alias("tk"), F.posexplode(let(words, cells)).alias("cell", "raw"))
    rows = rows.withColumn("h", F.when(F.col("cell") == 0, F.lit(_DOC).cast("long")).otherwise(F.xxhash64("raw")))
    found = rows.join(F.broadcast(template_windows(docs.sparkSession)), "h").where(
        (F.col("cell") == 0) | (F.col("raw") == F.col("gram")))
    return found.select("doc_id", "tk", (F.col("cell") - 1).alias("pos"), "tmpl", "tpos", "n_windows", "label", "is_base",
                        F.when(F.col("cell") == 0, F.col("raw").cast("long")).alias("n_words"))


def diagonals(found: DataFrame) -> DataFrame:
    """Votes per document, template and diagonal; repeated rows vote once."""
    return (found.where(F.col("tmpl").isNotNull())
            .groupBy("doc_id", "tk", "tmpl", "label", "is_base", "n_windows", (F.col("pos") - F.col("tpos")).alias("diag"))
            .agg(F.collect_set("tpos").alias("tposs"), F.min("pos").alias("first"), F.max("pos").alias("last")))


def diagonal_spans(votes: DataFrame) -> DataFrame:
    """Verified spans of templates: (doc_id, tk, tmpl, label, first, last, cover)."""
    w = Window.partitionBy("doc_id", "tk", "tmpl").orderBy("diag")
    new = (F.col("diag") - F.lag("diag").over(w) > DRIFT).cast("int")
    merged = (votes.where(~F.col("is_base")).withColumn("new", F.coalesce(new, F.lit(0)))
              .withColumn("cluster", F.sum("new").over(w))
              .groupBy("doc_id", "tk", "tmpl", "label", "cluster", "n_windows")
              .agg(F.array_distinct(F.flatten(F.collect_list("tposs"))).alias("tposs"),
                   F.min("first").alias("first"), (F.max("last") + K).alias("last")))
    o = Window.partitionBy("doc_id", "tk", "tmpl").orderBy("first", "last", "cluster")
    follows = (F.array_min("tposs") > F.lag(F.array_max("tposs")).over(o)) & (F.col("first") - F.lag("last").over(o) <= INSERTED)
    chains = (merged.withColumn("apart", F.when(follows, F.lit(0)).otherwise(F.lit(1)))
              .withColumn("chain", F.sum("apart").over(o))
              .groupBy("doc_id", "tk", "tmpl", "label", "chain", "n_windows")
              .agg(F.size(F.array_distinct(F.flatten(F.collect_list("tposs")))).alias("n_hit"),
                   F.min("first").alias("first"), F.max("last").alias("last")))
    return (chains.withColumn("cover", F.col("n_hit") / F.col("n_windows"))
            .where(F.col("cover") >= MIN_COVER).drop("n_hit", "n_windows", "chain"))


def base_places(votes: DataFrame) -> DataFrame:
    """Places of base phrases: diagonals on which every window of the phrase hits."""
    return votes.where(F.col("is_base") & (F.size("tposs") == F.col("n_windows"))).select(
        "doc_id", "tk", "label", F.col("diag").alias("place"))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score, spans."""
    # written once: the hits are read several times below, the texts only here
    found = written(hits(docs.select("doc_id", "text")), "license-hits")
    votes = written(diagonals(found), "license-votes")
    key = ["doc_id", "tk"]
    own = found.where(F.col("tmpl").isNull()).select(*key, "n_words")
    base = base_places(votes).groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_base"), F.min("place").cast("long").alias("first_word"),
        F.max("place").cast("long").alias("last_word"), F.collect_set("label").alias("base_set"))
    spans = diagonal_spans(votes).groupBy(*key).agg(
        F.max("cover").alias("cover"), F.collect_set("label").alias("span_set"),
        F.sort_array(F.collect_list(F.struct("first", "last", "label", F.round("cover", 6).alias("cover")))).alias("spans"))
    both = written(_full(base, spans, key), "license-found")
    hit = broadcast_if_small(both, 64 + 64 * F.size("spans"))
    none = F.array().cast("array<string>")
    joined = own.alias("o").join(hit.alias("h"), F.col("o.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("o.tk") == F.col("h.tk")), "left")
    base_set, span_set = F.coalesce("base_set", none), F.coalesce("span_set", none)
    return joined.select(
        "o.doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.array_join(F.sort_array(base_set), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(base_set, span_set)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("cover", F.lit(0.0))).alias("score"), "spans")


def _full(base: DataFrame, spans: DataFrame, key: list[str]) -> DataFrame:
    """Both findings of a document in one row (a null ``doc_id`` is a key, too)."""
    columns = lambda df, other: [F.lit(None).cast(other.schema[c].dataType).alias(c) for c in other.columns if c not in key]
    rows = base.select("*", *columns(base, spans)).unionByName(spans.select("*", *columns(spans, base)))
    return rows.groupBy(*key).agg(*[F.first(c, ignorenulls=True).alias(c) for c in rows.columns if c not in key])


def op6_license_scan(docs: DataFrame) -> DataFrame:
    return scan_licenses(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
                                      "labels", F.round("score", 6).alias("score"), F.greatest(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"))
