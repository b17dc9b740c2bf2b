"""Shared DuckDB SQL fragments for the oracle side of the registered queries.

They restate, in plain SQL over the same parquet views, what the Spark
operators compute, so the driver can compare both engines row for row.
"""

from __future__ import annotations

import re

from textmill.functions.constants import DEMO_PIECES, SPECIAL_TOKENS

_SPECIALS_IN = ", ".join(f"'{t}'" for t in SPECIAL_TOKENS)
_SPECIAL_VALUES = ", ".join(f"({i}, '{t}')" for i, t in enumerate(SPECIAL_TOKENS))
_PIECES = ", ".join(f"'{p}'" for p in DEMO_PIECES)

WORD_RE = r"'[ \n\t]+'"

DOC_WORDS = rf"""
doc_words AS (
  SELECT doc_id, pos, word FROM (
    SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS pos, unnest(l) AS word
    FROM (SELECT doc_id, string_split_regex(lower(text), {WORD_RE}) AS l FROM documents))
  WHERE word <> '')"""

DOC_SENTS = """
doc_sents AS (
  SELECT doc_id AS paragraph_id, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS idx,
         unnest(l) AS sentence
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"""

CONV_SENTS = """
conv_sents AS (
  SELECT conv_id AS paragraph_id,
         CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS idx,
         text AS sentence
  FROM conversations)"""


def sent_words(sents: str = "doc_sents", name: str = "sent_words") -> str:
    return rf"""
{name} AS (
  SELECT paragraph_id, idx, wpos, word FROM (
    SELECT paragraph_id, idx, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS wpos, unnest(l) AS word
    FROM (SELECT paragraph_id, idx, string_split_regex(lower(sentence), {WORD_RE}) AS l FROM {sents}))
  WHERE word <> '')"""


def demo_vocab(words: str = "doc_words", name: str = "vocab", pieces: str | None = None,
               alphabet_filter: str = "TRUE") -> str:
    """Specials + fixed pieces + the alphabet of ``words`` ordered by length desc, token."""
    pieces = _PIECES if pieces is None else pieces
    return f"""
{name}_learned AS (
  SELECT token FROM (
    SELECT unnest([{pieces}]) AS token
    UNION SELECT s AS token FROM (SELECT unnest(string_split(word || '_', '')) AS s FROM {words}) WHERE {alphabet_filter})
  WHERE token NOT IN ({_SPECIALS_IN})),
{name} AS (
  SELECT CAST(id AS INTEGER) AS id, token FROM (VALUES {_SPECIAL_VALUES}) s(id, token)
  UNION ALL
  SELECT CAST(4 + row_number() OVER (ORDER BY length(token) DESC, token) AS INTEGER) AS id, token
  FROM {name}_learned)"""


def encode_words(words: str = "sent_words", vocab: str = "vocab", name: str = "enc_words") -> str:
    """Distinct words → ids with the accept-if-no-overlap fold and unknown runs."""
    return f"""
{name}_dw AS (SELECT DISTINCT word FROM {words}),
{name}_cands AS (
  SELECT d.word, v.id, CAST(pos AS INTEGER) AS pos, CAST(len AS INTEGER) AS len
  FROM {name}_dw d, (SELECT max(length(token)) AS m FROM {vocab}) ml,
       range(1, length(d.word) + 2) r(pos), range(1, ml.m + 1) u(len), {vocab} v
  WHERE pos + len - 1 <= length(d.word) + 1 AND substr(d.word || '_', pos, len) = v.token),
{name}_segs AS (
  SELECT word, list_reduce(list_sort(list({{'id': id, 'pos': pos, 'len': len}})),
           lambda st, c: CASE WHEN len(list_filter(st, lambda a: a.pos < c.pos + c.len AND c.pos < a.pos + a.len)) = 0
                              THEN list_append(st, {{'pos': c.pos, 'id': c.id, 'len': c.len}}) ELSE st END,
           []::STRUCT(pos INTEGER, id INTEGER, len INTEGER)[]) AS acc
  FROM {name}_cands GROUP BY word),
{name}_cov AS (
  SELECT d.word, coalesce(s.acc, []::STRUCT(pos INTEGER, id INTEGER, len INTEGER)[]) AS acc,
         list_transform(range(1, length(d.word) + 2),
           lambda i: len(list_filter(coalesce(s.acc, []::STRUCT(pos INTEGER, id INTEGER, len INTEGER)[]),
                                     lambda a: a.pos <= i AND i < a.pos + a.len)) > 0) AS cov
  FROM {name}_dw d LEFT JOIN {name}_segs s USING (word)),
{name} AS (
  SELECT word, list_transform(list_sort(list_concat(acc,
           list_transform(list_filter(range(1, length(word) + 2),
                                      lambda i: NOT cov[i] AND (i = 1 OR cov[greatest(i - 1, 1)])),
                          lambda i: {{'pos': CAST(i AS INTEGER), 'id': 1, 'len': 0}}))), lambda e: e.id) AS ids
  FROM {name}_cov)"""


def encode_sents(sents: str = "doc_sents", words: str = "sent_words", enc: str = "enc_words",
                 name: str = "enc_sents") -> str:
    return rf"""
{name} AS (
  SELECT paragraph_id, idx, flatten(list(ids ORDER BY wpos)) AS ids
  FROM {words} JOIN {enc} USING (word) GROUP BY paragraph_id, idx
  UNION ALL
  SELECT paragraph_id, idx, []::INTEGER[] AS ids FROM {sents}
  WHERE len(list_filter(string_split_regex(lower(sentence), {WORD_RE}), lambda x: x <> '')) = 0)"""


def with_(*ctes: str) -> str:
    """Each CTE is computed once, whatever number of times it is named."""
    every = ",".join(c.strip("\n") for c in ctes)
    return "WITH " + re.sub(r"(?m)^(\w+) AS \(", r"\1 AS MATERIALIZED (", every) + "\n"
