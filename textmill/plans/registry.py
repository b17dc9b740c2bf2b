"""Registered queries: name → (Spark callable, DuckDB oracle SQL or None).

Each callable takes ``(spark, sf_dir)``, reads whole driver tables and returns
a DataFrame whose arrays are rendered as space-joined strings and whose
doubles are rounded, so the driver's engine-neutral compare can hash them.
``None`` as SQL marks an operator that is not SQL-expressible (iterative,
model fitting, streaming); those get golden / invariant tests instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.constants import BATCH_SIZE, CLS_ID, DEMO_PIECES, MASK_RATE, MSK_ID, SEP_ID, VAL_STEPS
from textmill.operators import encode as E
from textmill.operators import vocab as V
from textmill.operators.index import dense_index
from textmill.plans import oracle_sql as O
from textmill.sources import tables as TB

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _joined_text(kind: str):
    """Array column → its elements joined by spaces, a batch of rows at once; null elements are left out
    of integers and 0 among booleans. Nested, so that it is shipped by value."""
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np
        import pyarrow.compute as pc

        for batch in batches:
            flat = batch.flatten()
            if flat.null_count:
                yield pa.array([None if r is None else " ".join(str(x) for x in r if x is not None) for r in batch.to_pylist()], pa.string())
                continue
            if not len(flat):
                yield pc.if_else(batch.is_valid(), pa.scalar(""), pa.scalar(None, pa.string()))
                continue
            ends = np.cumsum(batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
            least, most = pc.min_max(flat).as_py().values()
            if least >= 0 and most <= len(flat):        # each number is written once
                names = pc.cast(pa.array(np.arange(most + 1)), pa.string()).take(flat)
            else:
                names = pc.cast(flat, pa.string())
            text = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], ends])), names), " ")
            yield text if not batch.null_count else pc.if_else(batch.is_valid(), text, pa.scalar(None, pa.string()))

    def bits(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np
        import pyarrow.compute as pc

        for batch in batches:
            flat = batch.flatten().fill_null(False).to_numpy(zero_copy_only=False)
            sizes = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            text = np.full(2 * len(flat), 32, dtype=np.uint8)
            text[::2] = flat
            text[::2] += 48
            text = np.delete(text, 2 * np.cumsum(sizes)[sizes > 0] - 1)     # no space behind the last
            offsets = np.concatenate([[0], np.cumsum(np.maximum(2 * sizes - 1, 0))])
            out = pa.LargeStringArray.from_buffers(len(batch), pa.py_buffer(offsets), pa.py_buffer(text)).cast(pa.string())
            yield out if not batch.null_count else pc.if_else(batch.is_valid(), out, pa.scalar(None, pa.string()))

    return ids if kind == "ids" else bits


def ids_str(col) -> F.Column:
    return F.arrow_udf(_joined_text("ids"), "string")(F.col(col) if isinstance(col, str) else col)


# ------------------------------------------------------------------ helpers --
def doc_words(spark, sf):
    return TB.corpus_words(TB.load(spark, sf, "documents"))


def doc_sents(spark, sf):
    return TB.documents_as_paragraphs(TB.load(spark, sf, "documents"))


def conv_sents(spark, sf):
    return TB.conversations_as_paragraphs(TB.load(spark, sf, "conversations"))


def demo_vocab(spark, words: DataFrame, alphabet_filter=None, pieces=DEMO_PIECES) -> DataFrame:
    """Fixed pieces + the corpus alphabet, ordered by the T1 rule."""
    alpha = V.alphabet(words).select(F.col("symbol").alias("token"))
    if alphabet_filter is not None:
        alpha = alpha.where(alphabet_filter)
    fixed = spark.createDataFrame([(p,) for p in pieces], "token string")
    return V.materialize_vocab(V.vocab_order(fixed.unionByName(alpha)))


def encoded_doc_sents(spark, sf):
    vocab = demo_vocab(spark, doc_words(spark, sf))
    return E.encode_sentences(doc_sents(spark, sf), vocab), vocab


_ENC_DOCS = [O.DOC_WORDS, O.DOC_SENTS, O.sent_words(), O.demo_vocab(), O.encode_words(), O.encode_sents()]

# ------------------------------------------------------------------ sources --


@register("documents_as_paragraphs", O.with_(O.DOC_SENTS) + "SELECT paragraph_id, idx, sentence FROM doc_sents")
def q_documents_as_paragraphs(spark, sf):
    return doc_sents(spark, sf)


@register("conversations_as_paragraphs", O.with_(O.CONV_SENTS) + "SELECT paragraph_id, idx, sentence FROM conv_sents")
def q_conversations_as_paragraphs(spark, sf):
    return conv_sents(spark, sf)


@register("read_paragraphs", O.with_(O.DOC_SENTS) + """
SELECT paragraph_id, count(*) AS n_sentences,
       CAST(sum(CASE WHEN sentence = '' THEN 1 ELSE 0 END) AS BIGINT) AS n_empty
FROM doc_sents GROUP BY paragraph_id""")
def q_read_paragraphs(spark, sf):
    return (doc_sents(spark, sf).groupBy("paragraph_id")
            .agg(F.count(F.lit(1)).alias("n_sentences"),
                 F.sum(F.when(F.col("sentence") == "", 1).otherwise(0)).cast("long").alias("n_empty")))


# --------------------------------------------------------- word statistics --
@register("word_counts", O.with_(O.DOC_WORDS) + """
SELECT word, count(*) AS n, min({'d': doc_id, 'p': pos}).d AS first_doc, min({'d': doc_id, 'p': pos}).p AS first_pos
FROM doc_words GROUP BY word""")
def q_word_counts(spark, sf):
    return V.word_counts(doc_words(spark, sf))


@register("alphabet", O.with_(O.DOC_WORDS) + """
SELECT DISTINCT unnest(string_split(word || '_', '')) AS symbol FROM doc_words""")
def q_alphabet(spark, sf):
    return V.alphabet(doc_words(spark, sf))


_PAIRS = O.with_(O.DOC_WORDS, """
wc AS (SELECT word, count(*) AS n, min({'d': doc_id, 'p': pos}) AS f FROM doc_words GROUP BY word)""", """
syms AS (SELECT word, n, f, string_split(word || '_', '') AS s FROM wc)""", """
pairs AS (SELECT s[i] AS l, s[i + 1] AS r, n, f.d AS d, f.p AS p, CAST(i - 1 AS BIGINT) AS sp
          FROM syms, range(1, len(s)) t(i))""", """
pc AS (SELECT l AS left_sym, r AS right_sym, CAST(sum(n) AS BIGINT) AS n,
              min({'d': d, 'p': p, 'sp': sp}) AS f FROM pairs GROUP BY l, r)""")


@register("pair_counts", _PAIRS + """
SELECT left_sym, right_sym, n, f.d AS first_doc, f.p AS first_pos, f.sp AS first_sym FROM pc""")
def q_pair_counts(spark, sf):
    return V.pair_counts(V.symbolize(V.word_counts(doc_words(spark, sf))))


@register("best_pair", _PAIRS + """
SELECT left_sym, right_sym, n, f.d AS first_doc, f.p AS first_pos, f.sp AS first_sym
FROM pc ORDER BY n DESC, f.d, f.p, f.sp LIMIT 1""")
def q_best_pair(spark, sf):
    return V.best_pair(V.pair_counts(V.symbolize(V.word_counts(doc_words(spark, sf)))))


@register("merge_pair", _PAIRS.rstrip("\n") + """,
best AS (SELECT left_sym AS bl, right_sym AS br FROM pc ORDER BY n DESC, f.d, f.p, f.sp LIMIT 1)
SELECT word, array_to_string(list_reduce(s,
         lambda acc, x: CASE WHEN len(acc) > 0 AND acc[-1] = bl AND x = br
                             THEN list_append(acc[1:len(acc) - 1], bl || br) ELSE list_append(acc, x) END,
         []::VARCHAR[]), ' ') AS symbols
FROM syms, best""")
def q_merge_pair(spark, sf):
    state = V.symbolize(V.word_counts(doc_words(spark, sf)))
    top = V.best_pair(V.pair_counts(state)).first()  # one row: the merge to apply
    merged = V.merge_pair(state, top["left_sym"], top["right_sym"])
    return merged.select("word", F.array_join("symbols", " ").alias("symbols"))


@register("corpus_size", O.with_(O.DOC_SENTS, O.DOC_WORDS) + """
SELECT (SELECT count(*) FROM documents) AS n_paragraphs, (SELECT count(*) FROM doc_sents) AS n_sentences,
       (SELECT count(*) FROM doc_words) AS n_words""")
def q_corpus_size(spark, sf):
    return TB.corpus_size(TB.load(spark, sf, "documents"))


@register("dense_index", "SELECT doc_id, CAST(row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS BIGINT) AS rn FROM documents")
def q_dense_index(spark, sf):
    docs = TB.load(spark, sf, "documents").select("doc_id", "n_chars")
    return dense_index(docs, ["n_chars", "doc_id"]).select("doc_id", "rn")


# ------------------------------------------------------- sentence neighbours --
@register("next_sentence", O.with_(O.DOC_SENTS) + """
SELECT a.paragraph_id, a.idx, a.sentence, b.sentence AS next_sentence
FROM doc_sents a LEFT JOIN doc_sents b ON b.paragraph_id = a.paragraph_id AND b.idx = a.idx + 1""")
def q_next_sentence(spark, sf):
    from textmill.operators.examples import next_sentence
    return next_sentence(doc_sents(spark, sf))


@register("consecutive_pairs", O.with_(O.CONV_SENTS) + """
SELECT a.paragraph_id, a.idx, a.sentence AS first, b.sentence AS second
FROM conv_sents a JOIN conv_sents b ON b.paragraph_id = a.paragraph_id AND b.idx = a.idx + 1""")
def q_consecutive_pairs(spark, sf):
    from textmill.operators.examples import consecutive_pairs
    return consecutive_pairs(conv_sents(spark, sf))


# ------------------------------------------------------------- vocabularies --
@register("vocab_order", O.with_(O.DOC_WORDS, O.demo_vocab()) + "SELECT id, token FROM vocab")
def q_vocab_order(spark, sf):
    return demo_vocab(spark, doc_words(spark, sf))


@register("vocab_union", O.with_(O.DOC_WORDS, O.demo_vocab()) + "SELECT token FROM vocab_learned")
def q_vocab_union(spark, sf):
    return demo_vocab(spark, doc_words(spark, sf)).where(F.col("id") >= 5).select("token")


_CONV_WORDS = r"""
conv_words AS (
  SELECT conv_id AS doc_id, pos, word FROM (
    SELECT conv_id, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS pos, unnest(l) AS word
    FROM (SELECT conv_id, string_split_regex(lower(text), '[ \n\t]+') AS l FROM conversations))
  WHERE word <> '')"""


def conv_words(spark, sf):
    return TB.corpus_words(TB.load(spark, sf, "conversations"), id_col="conv_id")


@register("vocab_diff", O.with_(O.DOC_WORDS, _CONV_WORDS, """
a AS (SELECT DISTINCT unnest(string_split(word || '_', '')) AS token FROM doc_words)""", """
b AS (SELECT DISTINCT unnest(string_split(word || '_', '')) AS token FROM conv_words)""") + """
SELECT token, 'only_a' AS side FROM a WHERE token NOT IN (SELECT token FROM b)
UNION ALL SELECT token, 'only_b' AS side FROM b WHERE token NOT IN (SELECT token FROM a)""")
def q_vocab_diff(spark, sf):
    a = V.alphabet(doc_words(spark, sf)).select(F.col("symbol").alias("token"))
    b = V.alphabet(conv_words(spark, sf)).select(F.col("symbol").alias("token"))
    return V.vocab_diff(a, b)


@register("vocab_lookup", O.with_(O.DOC_WORDS, O.demo_vocab(), _CONV_WORDS, """
syms AS (SELECT DISTINCT unnest(string_split(word || '_', '')) AS token FROM conv_words)""") + """
SELECT s.token, v.id FROM syms s LEFT JOIN vocab v USING (token)""")
def q_vocab_lookup(spark, sf):
    vocab = demo_vocab(spark, doc_words(spark, sf))
    syms = V.alphabet(conv_words(spark, sf)).select(F.col("symbol").alias("token"))
    return E.vocab_lookup(syms, vocab).select("token", "id")


# ----------------------------------------------------------------- encoding --
@register("substring_vocab_match", O.with_(O.DOC_WORDS, O.demo_vocab(), _CONV_WORDS,
                                           "cw AS (SELECT DISTINCT word FROM conv_words)") + """
SELECT d.word, v.id, CAST(pos AS INTEGER) AS pos, CAST(len AS INTEGER) AS len
FROM cw d, (SELECT max(length(token)) AS m FROM vocab) ml,
     range(1, length(d.word) + 2) r(pos), range(1, ml.m + 1) u(len), vocab v
WHERE pos + len - 1 <= length(d.word) + 1 AND substr(d.word || '_', pos, len) = v.token""")
def q_substring_vocab_match(spark, sf):
    vocab = demo_vocab(spark, doc_words(spark, sf))
    words = conv_words(spark, sf).select("word").distinct()
    return E.substring_vocab_match(words, vocab)


@register("bpe_encode", O.with_(*_ENC_DOCS) + "SELECT word, array_to_string(ids, ' ') AS ids FROM enc_words")
def q_bpe_encode(spark, sf):
    vocab = demo_vocab(spark, doc_words(spark, sf))
    words = TB.sentence_words(doc_sents(spark, sf)).select("word").distinct()
    return E.bpe_encode_words(words, vocab).select("word", ids_str("ids").alias("ids"))


@register("bpe_pieces", O.with_(*_ENC_DOCS) + """
SELECT word, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY p) AS ids, string_agg(token, ' ' ORDER BY p) AS pieces
FROM (SELECT word, generate_subscripts(ids, 1) AS p, unnest(ids) AS id FROM enc_words) JOIN vocab USING (id) GROUP BY word""")
def q_bpe_pieces(spark, sf):
    """B3 with the pieces next to their ids."""
    vocab = demo_vocab(spark, doc_words(spark, sf))
    enc = E.bpe_encode_words(TB.sentence_words(doc_sents(spark, sf)), vocab)
    return E.pieces_of(enc, vocab, ["word"]).select("word", ids_str("ids").alias("ids"), F.array_join("pieces", " ").alias("pieces"))


@register("encode_corpus", O.with_(*_ENC_DOCS) + """
SELECT paragraph_id, idx, array_to_string(ids, ' ') AS ids, CAST(len(ids) AS BIGINT) AS n_tokens FROM enc_sents""")
def q_encode_corpus(spark, sf):
    enc, _ = encoded_doc_sents(spark, sf)
    return enc.select("paragraph_id", "idx", ids_str("ids").alias("ids"),
                      F.size("ids").cast("long").alias("n_tokens"))


@register("sentence_length_stats", O.with_(*_ENC_DOCS) + """
SELECT CAST(max(len(ids)) AS BIGINT) AS max_sentence_tokens,
       (SELECT CAST(max(t) AS BIGINT) + 2 FROM (SELECT sum(len(ids)) AS t FROM enc_sents GROUP BY paragraph_id)) AS max_review_tokens
FROM enc_sents""")
def q_sentence_length_stats(spark, sf):
    enc, _ = encoded_doc_sents(spark, sf)
    return (enc.groupBy("paragraph_id").agg(F.max(F.size("ids")).alias("m"), F.sum(F.size("ids")).alias("t"))
               .agg(F.max("m").cast("long").alias("max_sentence_tokens"),
                    (F.max("t") + 2).cast("long").alias("max_review_tokens")))


@register("encode_unknowns", O.with_(O.CONV_SENTS, O.DOC_WORDS, O.sent_words("conv_sents", "cs_words"),
                                     O.demo_vocab(alphabet_filter="regexp_full_match(s, '[a-z_]')"),
                                     O.encode_words("cs_words"), O.encode_sents("conv_sents", "cs_words")) + """
SELECT paragraph_id, idx, CAST(len(ids) AS BIGINT) AS n_tokens,
       CAST(len(list_filter(ids, lambda x: x = 1)) AS BIGINT) AS n_unk FROM enc_sents""")
def q_encode_unknowns(spark, sf):
    vocab = demo_vocab(spark, doc_words(spark, sf), alphabet_filter=F.col("token").rlike("^[a-z_]$"))
    enc = E.encode_sentences(conv_sents(spark, sf), vocab)
    return enc.select("paragraph_id", "idx", F.size("ids").cast("long").alias("n_tokens"),
                      F.size(F.filter("ids", lambda x: x == 1)).cast("long").alias("n_unk"))


_DECODE = O.with_(*_ENC_DOCS, """
dec AS (
  SELECT paragraph_id, idx, string_split(string_agg(token, '' ORDER BY p), '_') AS parts
  FROM (SELECT paragraph_id, idx, generate_subscripts(ids, 1) AS p, unnest(ids) AS id FROM enc_sents) e
  JOIN vocab USING (id) GROUP BY paragraph_id, idx)""", """
decoded AS (
  SELECT paragraph_id, idx, CASE WHEN parts[-1] = '' THEN parts[1:len(parts) - 1] ELSE parts END AS words FROM dec
  UNION ALL SELECT paragraph_id, idx, []::VARCHAR[] FROM enc_sents WHERE len(ids) = 0)""")


@register("bpe_decode", _DECODE + "SELECT paragraph_id, idx, array_to_string(words, ' ') AS words FROM decoded")
def q_bpe_decode(spark, sf):
    enc, vocab = encoded_doc_sents(spark, sf)
    return E.decode(enc, vocab, ["paragraph_id", "idx"]).select(
        "paragraph_id", "idx", F.array_join("words", " ").alias("words"))


@register("roundtrip_check", _DECODE.rstrip("\n") + rf""",
orig AS (SELECT paragraph_id, idx, list_filter(string_split_regex(lower(sentence), {O.WORD_RE}), lambda x: x <> '') AS o
         FROM doc_sents)
SELECT paragraph_id, idx, array_to_string(o, ' ') AS orig, array_to_string(words, ' ') AS words
FROM orig JOIN decoded USING (paragraph_id, idx) WHERE o <> words""")
def q_roundtrip_check(spark, sf):
    vocab = demo_vocab(spark, doc_words(spark, sf))
    bad = E.roundtrip_check(doc_sents(spark, sf), vocab)
    return bad.select("paragraph_id", "idx", F.array_join("orig", " ").alias("orig"),
                      F.array_join("words", " ").alias("words"))


_ROUNDTRIP_MARKED = O.with_(r"""
doc_sents AS (
  SELECT doc_id AS paragraph_id, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS idx, replace(unnest(l), 'e', 'e_') AS sentence
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))""", rf"""
orig AS (SELECT paragraph_id, idx, list_filter(string_split_regex(lower(sentence), {O.WORD_RE}), lambda x: x <> '') AS o
         FROM doc_sents)""") + """
SELECT paragraph_id, idx, array_to_string(o, ' ') AS orig, replace(array_to_string(o, ' '), '_', ' ') AS words
FROM orig WHERE contains(array_to_string(o, ''), '_')"""


@register("roundtrip_marked", _ROUNDTRIP_MARKED)
def q_roundtrip_marked(spark, sf):
    """B6 where it must find something: texts that hold the word-end mark itself
    come back split at it."""
    marked = doc_sents(spark, sf).withColumn("sentence", F.replace("sentence", F.lit("e"), F.lit("e_")))
    vocab = demo_vocab(spark, TB.sentence_words(marked))
    bad = E.roundtrip_check(marked, vocab)
    return bad.select("paragraph_id", "idx", F.array_join("orig", " ").alias("orig"),
                      F.array_join("words", " ").alias("words"))


# ------------------------------------------------------- example generation --
from textmill.operators import examples as X  # noqa: E402
from textmill.plans.examples_sql import with_examples  # noqa: E402
from textmill.session import cut_lineage, written  # noqa: E402

_STATE: dict = {}


class ExampleState(dict):
    """Encoded documents → paragraph index → one example per sentence. A stage is made when
    it is first asked for, written to the shared checkpoint folder, and shared by the
    queries on one (session, input)."""

    def __init__(self, spark, sf, seed):
        super().__init__()
        self.spark, self.sf, self.seed, self.asked = spark, sf, seed, set()

    def __missing__(self, stage):
        if stage not in self.STAGES:
            raise KeyError(stage)
        self[stage] = self.STAGES[stage](self)
        return self[stage]

    def once(self, stage):
        """``stage`` for a query that reads it once: made while it is read, and written only when
        it is asked for again."""
        if stage in self or stage in self.asked:
            return self[stage]
        self.asked.add(stage)
        return self.PLANS[stage](self)

    def ids(self):
        return self.spark.range(0, self["n"]).withColumnRenamed("id", "example_id")

    STAGES = {
        "vocab": lambda st: demo_vocab(st.spark, doc_words(st.spark, st.sf)),
        "token_num": lambda st: st["vocab"].count(),
        "enc": lambda st: written(E.encode_sentences(doc_sents(st.spark, st.sf), st["vocab"]), "enc"),
        "index": lambda st: X.prepare_paragraphs(st["enc"]),
        "n": lambda st: doc_sents(st.spark, st.sf).count(),
        "pairs": lambda st: written(st.PLANS["pairs"](st), "pairs"),
        "examples": lambda st: written(st.PLANS["examples"](st), "examples"),
    }

    PLANS = {
        "pairs": lambda st: X.sample_pairs(st["index"], st.ids(), st.seed),
        "examples": lambda st: X.mask_tokens(st.once("pairs"), st["token_num"], st.seed),
    }


def example_state(spark, sf, seed: int = 0) -> ExampleState:
    key = (spark.sparkContext.applicationId, sf, seed)
    if key not in _STATE:
        _STATE[key] = ExampleState(spark, sf, seed)
    return _STATE[key]


def bool_str(col):
    return F.arrow_udf(_joined_text("bits"), "string")(col)


_BOOL_SQL = "array_to_string(list_transform({c}, lambda x: CASE WHEN x THEN '1' ELSE '0' END), ' ')"


@register("nsp_label", with_examples() + "SELECT example_id, nsp FROM ex")
def q_nsp_label(spark, sf):
    from textmill.functions.rng import draw
    n = doc_sents(spark, sf).count()
    return spark.range(0, n).select(F.col("id").alias("example_id"),
                                    (draw(0, "nsp", F.col("id")) % 2 == 1).alias("nsp"))


@register("paragraph_min_sentences", with_examples() + "SELECT paragraph_id, n AS n_sentences, erank FROM elig")
def q_paragraph_min_sentences(spark, sf):
    st = example_state(spark, sf)
    sizes = st["enc"].groupBy("paragraph_id").agg(F.count(F.lit(1)).alias("n_sentences"))
    return dense_index(sizes.where(F.col("n_sentences") >= 2), ["paragraph_id"], out="erank")


def _pairs_meta(spark, sf):
    """Sampled sentence coordinates per example with paragraph ids."""
    st = example_state(spark, sf)
    if "pairs_meta" not in st:
        ids = spark.range(0, st["n"]).withColumnRenamed("id", "example_id")
        meta = X.sample_coordinates(st["index"], ids)
        pid = _rank_to_pid(spark, sf)
        meta = (meta.join(pid.select(F.col("rank").alias("r0"), F.col("paragraph_id").alias("p0")), "r0")
                    .join(pid.select(F.col("rank").alias("rb"), F.col("paragraph_id").alias("p1")), "rb"))
        st["pairs_meta"] = cut_lineage(meta.select("example_id", "nsp", "r0", "p0", "s0", "p1",
                                                   F.col("sb").alias("s1"), "m", "r"))
    return st["pairs_meta"]


def _rank_to_pid(spark, sf):
    st = example_state(spark, sf)
    return dense_index(st["enc"].select("paragraph_id").distinct(), ["paragraph_id"], out="rank")


@register("nsp_positive", with_examples() + """
SELECT p.example_id, s.paragraph_id, p.s0, p.sb AS s1 FROM pairs p JOIN sent s ON s.rank = p.r0 AND s.idx = p.s0
WHERE p.nsp""")
def q_nsp_positive(spark, sf):
    return _pairs_meta(spark, sf).where("nsp").select("example_id", F.col("p0").alias("paragraph_id"), "s0", "s1")


@register("nsp_negative", with_examples() + """
SELECT n.example_id, a.paragraph_id AS p0, n.s0, b.paragraph_id AS p1, n.s1
FROM neg5 n JOIN ranked a ON a.rank = n.r0 JOIN ranked b ON b.rank = n.r1""")
def q_nsp_negative(spark, sf):
    return _pairs_meta(spark, sf).where(~F.col("nsp")).select("example_id", "p0", "s0", "p1", "s1")


@register("paragraph_lookup", with_examples() + """
SELECT c.example_id, c.r0 AS rank, r.paragraph_id FROM chosen c JOIN ranked r ON r.rank = c.r0""")
def q_paragraph_lookup(spark, sf):
    return _pairs_meta(spark, sf).select("example_id", F.col("r0").alias("rank"), F.col("p0").alias("paragraph_id"))


@register("distinct_paragraph_pairs", with_examples() + """
SELECT a.paragraph_id AS p0, b.paragraph_id AS p1, count(*) AS n_examples
FROM neg1 n JOIN ranked a ON a.rank = n.r0 JOIN ranked b ON b.rank = n.r1 GROUP BY a.paragraph_id, b.paragraph_id""")
def q_distinct_paragraph_pairs(spark, sf):
    st = example_state(spark, sf)
    ids = spark.range(0, st["n"]).withColumnRenamed("id", "example_id")
    negs = X.negative_paragraphs(st["index"], ids)
    ranks = _rank_to_pid(spark, sf)
    return (negs.join(ranks.select(F.col("rank").alias("r0"), F.col("paragraph_id").alias("p0")), "r0")
                .join(ranks.select(F.col("rank").alias("r1"), F.col("paragraph_id").alias("p1")), "r1")
                .groupBy("p0", "p1").agg(F.count(F.lit(1)).alias("n_examples")))


@register("reject_true_next", with_examples() + """
SELECT example_id, m AS n_copies, r AS valid_rank, s1 FROM neg5 WHERE m > 0""")
def q_reject_true_next(spark, sf):
    return _pairs_meta(spark, sf).where(~F.col("nsp") & (F.col("m") > 0)).select(
        "example_id", F.col("m").alias("n_copies"), F.col("r").alias("valid_rank"), "s1")


@register("pair_pack", with_examples() + "SELECT example_id, array_to_string(src, ' ') AS src FROM m1")
def q_pair_pack(spark, sf):
    st = example_state(spark, sf)
    return st.once("pairs").select("example_id", ids_str(X.pair_pack(F.col("a"), F.col("b"))).alias("src"))


@register("special_mask", with_examples() + f"""
SELECT example_id, {_BOOL_SQL.format(c="list_transform(src, lambda x: x IN (2, 3))")} AS special FROM m1""")
def q_special_mask(spark, sf):
    st = example_state(spark, sf)
    return st.once("pairs").select("example_id", bool_str(X.special_mask(X.pair_pack(F.col("a"), F.col("b"))))
                              .alias("special"))


@register("mlm_select", with_examples() + f"SELECT example_id, {_BOOL_SQL.format(c='mask')} AS mask FROM examples")
def q_mlm_select(spark, sf):
    return example_state(spark, sf).once("examples").select("example_id", bool_str(F.col("mask")).alias("mask"))


@register("mlm_corrupt", with_examples() + "SELECT example_id, array_to_string(mlm, ' ') AS mlm FROM examples")
def q_mlm_corrupt(spark, sf):
    return example_state(spark, sf).once("examples").select("example_id", ids_str("mlm").alias("mlm"))


@register("mlm_short_fallback", O.with_(*_ENC_DOCS) + """
SELECT word, 2 * len(ids) + 3 AS len, CAST(floor((2 * len(ids) + 3) * 0.15::DOUBLE) AS INTEGER) AS k,
       2 * len(list_filter(ids, lambda x: x NOT IN (2, 3))) AS n_content, 1 AS n_masked, 1 AS n_msk
FROM enc_words WHERE len(list_filter(ids, lambda x: x NOT IN (2, 3))) > 0
  AND (floor((2 * len(ids) + 3) * 0.15::DOUBLE) = 0
       OR floor((2 * len(ids) + 3) * 0.15::DOUBLE) > 2 * len(list_filter(ids, lambda x: x NOT IN (2, 3))))""")
def q_mlm_short_fallback(spark, sf):
    """E6 on the shortest pairs there are: a word with itself."""
    vocab = demo_vocab(spark, doc_words(spark, sf))
    words = E.bpe_encode_words(TB.sentence_words(doc_sents(spark, sf)), vocab)
    pairs = words.select(F.col("word").alias("example_id"), F.lit(True).alias("nsp"),
                         F.col("ids").alias("a"), F.col("ids").alias("b"))
    ex = X.mask_tokens(pairs, vocab.count())
    L = F.size("src")
    k = F.floor(L.cast("double") * MASK_RATE).cast("int")
    nc = F.size(F.filter("src", lambda x: ~x.isin(CLS_ID, SEP_ID)))
    return ex.where((k == 0) | (k > nc)).select(
        F.col("example_id").alias("word"), L.alias("len"), k.alias("k"), nc.alias("n_content"),
        F.size(F.filter("mask", lambda m: m)).alias("n_masked"),
        F.size(F.filter("mlm", lambda t: t == MSK_ID)).alias("n_msk"))


@register("pretrain_examples", with_examples() + f"""
SELECT example_id, array_to_string(src, ' ') AS src, array_to_string(mlm, ' ') AS mlm,
       {_BOOL_SQL.format(c='mask')} AS mask, nsp FROM examples""")
def q_pretrain_examples(spark, sf):
    ex = example_state(spark, sf).once("examples")
    return ex.select("example_id", ids_str("src").alias("src"), ids_str("mlm").alias("mlm"),
                     bool_str(F.col("mask")).alias("mask"), "nsp")


@register("masked_positions", with_examples() + """
SELECT example_id, CAST(i - 1 AS INTEGER) AS pos, src[i] AS token, mlm[i] AS masked_token
FROM (SELECT example_id, src, mlm, mask, generate_subscripts(mask, 1) AS i FROM examples) WHERE mask[i]""")
def q_masked_positions(spark, sf):
    ex = example_state(spark, sf).once("examples")
    return X.masked_positions(ex)


@register("epoch_assign", with_examples() + """
SELECT example_id, CAST(floor(example_id / 32000) AS BIGINT) AS epoch,
       CAST(floor((example_id % 32000) / 16) AS BIGINT) AS step, CAST(example_id % 16 AS BIGINT) AS slot FROM examples""")
def q_epoch_assign(spark, sf):
    ex = example_state(spark, sf).once("examples")
    return X.epoch_assign(ex).select("example_id", "epoch", "step", "slot")


@register("epoch_assign_validation", with_examples() + f"""
SELECT example_id, CAST(floor(example_id / {VAL_STEPS * BATCH_SIZE}) AS BIGINT) AS epoch,
       CAST(floor((example_id % {VAL_STEPS * BATCH_SIZE}) / {BATCH_SIZE}) AS BIGINT) AS step,
       CAST(example_id % {BATCH_SIZE} AS BIGINT) AS slot FROM examples""")
def q_epoch_assign_validation(spark, sf):
    ex = example_state(spark, sf).once("examples")
    return X.epoch_assign(ex, VAL_STEPS, BATCH_SIZE).select("example_id", "epoch", "step", "slot")


@register("distinct_pairs", with_examples() + """
SELECT DISTINCT array_to_string(a, ' ') AS a, array_to_string(b, ' ') AS b FROM pairs""")
def q_distinct_pairs(spark, sf):
    st = example_state(spark, sf)
    return X.distinct_pairs(st["index"], st.ids(), st.seed).select(ids_str("a").alias("a"), ids_str("b").alias("b"))


_AUDITED = ("""
succ AS (SELECT x.ids AS a, y.ids AS b, count(*) AS n_next FROM sent x JOIN sent y ON y.rank = x.rank AND y.idx = x.idx + 1
         GROUP BY x.ids, y.ids)""", """
occ AS (SELECT ids AS a, count(*) AS n_a FROM sent GROUP BY ids)""", """
asked AS (SELECT p.nsp, p.a, p.b, s.n_next, o.n_a FROM pairs p JOIN examples USING (example_id)
          LEFT JOIN succ s ON s.a = p.a AND s.b = p.b LEFT JOIN occ o ON o.a = p.a)""")


@register("example_audit", with_examples("""
z AS (SELECT example_id, nsp, src, mlm, mask,
             list_transform(range(1, len(src) + 1), lambda i: {'s': src[i], 'm': mlm[i], 'k': mask[i]}) AS t
      FROM examples)""", *_AUDITED) + """
SELECT count(*) AS n_examples,
  CAST(sum(CASE WHEN len(list_filter(t, lambda x: x.s IN (2, 3) AND x.k)) > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_special_masked,
  CAST(sum(CASE WHEN len(list_filter(t, lambda x: x.s <> x.m AND NOT x.k)) > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_changed_unmasked,
  CAST(sum(CASE WHEN src[1] <> 2 OR src[-1] <> 3 THEN 1 ELSE 0 END) AS BIGINT) AS n_bad_shape,
  round(sum(len(list_filter(mask, lambda x: x))) / sum(len(src)), 6) AS mask_rate,
  round(sum(len(list_filter(t, lambda x: x.k AND x.m = 4))) / sum(len(list_filter(mask, lambda x: x))), 6) AS msk_share,
  round(sum(len(list_filter(t, lambda x: x.k AND x.m = x.s))) / sum(len(list_filter(mask, lambda x: x))), 6) AS same_share,
  round(sum(len(list_filter(t, lambda x: x.k AND x.m <> x.s AND x.m <> 4))) / sum(len(list_filter(mask, lambda x: x))), 6) AS random_share,
  round(avg(CASE WHEN nsp THEN 1.0 ELSE 0.0 END), 6) AS positive_share,
  (SELECT count(*) FROM doc_sents) AS n_requested, (SELECT count(*) FROM doc_sents) - count(*) AS n_dropped,
  (SELECT count(*) FROM examples e JOIN pairs p USING (example_id) WHERE e.src <> list_concat([2], p.a, [3], p.b, [3])) AS n_source_changed,
  (SELECT count(*) FILTER (nsp AND n_next IS NULL) FROM asked) AS n_positive_not_next,
  (SELECT count(*) FILTER (NOT nsp AND n_next = n_a) FROM asked) AS n_negative_always_next,
  (SELECT count(*) FROM (SELECT DISTINCT a, b FROM asked)) AS n_distinct_pairs
FROM z""")
def q_example_audit(spark, sf):
    st = example_state(spark, sf)
    pairs = st["pairs"]     # read by the examples and the audit
    return X.example_audit(st["examples"], st["n"], pairs, st["index"])


@register("example_source_audit", with_examples(*_AUDITED) + """
SELECT count(*) FILTER (nsp) AS n_positive, count(*) FILTER (nsp AND n_next IS NULL) AS n_positive_not_next,
       count(*) FILTER (NOT nsp) AS n_negative, count(*) FILTER (NOT nsp AND n_next = n_a) AS n_negative_always_next,
       (SELECT count(*) FROM (SELECT DISTINCT a, b FROM asked)) AS n_distinct_pairs FROM asked""")
def q_example_source_audit(spark, sf):
    """The labels of the delivered examples against the paragraphs."""
    st = example_state(spark, sf)
    return X.source_audit(X.unpacked(st["examples"]), st["index"])


def _load_all() -> None:
    import textmill.plans.registry_more  # noqa: F401  (registers part 2)


def queries() -> dict[str, QueryFn]:
    _load_all()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracles() -> dict[str, str]:
    _load_all()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
