"""Encoding and decoding with a vocabulary.

Segmentation rule (the reference's recursive search, restated): tokens are
tried in vocabulary order — specials, then longest first; the first token found
anywhere in the word claims all its non-overlapping left-to-right occurrences,
gaps are searched with later tokens. Equivalently: list every occurrence
``(id, pos)`` of every token in the word, visit them ordered by ``(id, pos)`` and
accept each one that overlaps nothing accepted. Every maximal run of characters
left uncovered becomes one ``<unk>``.

Sentences are encoded where they lie: a stretch of sentences → its distinct words →
matches by one walk of the vocabulary automaton → fold → ids set in for every
occurrence. No word and no id is shuffled. A vocabulary beyond the automaton's bounds is
matched by a shuffle join of substrings instead, once per distinct word, with a hot/cold
join back to the occurrences and a regroup per sentence; both ways give the same rows.

Texts are lower-cased before they are split into words unless ``lower=False``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.functions.constants import N_SPECIAL, UNK_ID, WORD_END, WORD_SPLIT_REGEX, WORD_START
from textmill.operators import automaton as A
from textmill.operators.joins import broadcast_if_small, hot_key_join
from textmill.session import cut_lineage

_CAND = T.ArrayType(T.StructType([T.StructField("id", T.IntegerType()),
                                  T.StructField("pos", T.IntegerType()),
                                  T.StructField("len", T.IntegerType())]))


def max_token_length(vocab: DataFrame) -> int:
    return int(vocab.agg(F.max(F.length("token"))).first()[0] or 1)


def vocab_lookup(tokens: DataFrame, vocab: DataFrame, token_col: str = "token") -> DataFrame:
    """Token → id; the vocabulary is broadcast if its size allows it."""
    ids = broadcast_if_small(vocab.select(F.col("token").alias(token_col), "id"))
    return tokens.join(ids, token_col, "left")


def _cased(text: Column, lower: bool) -> Column:
    return F.lower(text) if lower else text


def marked(word: Column, mark: str = WORD_END, at_start: bool = False) -> Column:
    """The word with its boundary mark, at the end or at the start."""
    return F.concat(F.lit(mark), word) if at_start else F.concat(word, F.lit(mark))


def _usable(vocab: DataFrame, max_len: int | None, match_specials: bool) -> DataFrame:
    if not match_specials:
        vocab = vocab.where(F.col("id") >= N_SPECIAL)
    return vocab if max_len is None else vocab.where(F.length("token") <= max_len)


def substring_vocab_match(words: DataFrame, vocab: DataFrame, max_len: int | None = None,
                          match_specials: bool = True, key: str = "word", mark: str = WORD_END,
                          at_start: bool = False) -> DataFrame:
    """Every occurrence ``(key, id, pos, len)`` of every vocabulary token
    in the marked word (1-based ``pos``; overlapping occurrences kept), found by the
    vocabulary automaton or, beyond its bounds, by ``substring_join``."""
    automaton = A.compiled(_usable(vocab, max_len, match_specials))
    if automaton is None:
        return substring_join(words, vocab, max_len, match_specials, key, mark, at_start)
    sent = words.sparkSession.sparkContext.broadcast(automaton)
    matches, chunks = A.matcher(), A.chunker()

    def find(batches):
        for batch in batches:
            first = 0
            for part in chunks(batch.column(1).to_pylist()):
                start, size, token, ends = matches(sent.value, part)
                word = np.searchsorted(ends, start, side="right")
                begin = np.concatenate([[0], ends[:-1]])[word]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(first + word)), pa.array(token, pa.int32()),
                     pa.array(start - begin + 1, pa.int32()), pa.array(size, pa.int32())], [key, "id", "pos", "len"])
                first += len(part)

    at = words.where(F.col("word").isNotNull()).select(key, marked(F.col("word"), mark, at_start).alias("_marked"))
    schema = T.StructType([at.schema[0], *[T.StructField(c, T.IntegerType()) for c in ("id", "pos", "len")]])
    return at.mapInArrow(find, schema)


def substring_join(words: DataFrame, vocab: DataFrame, max_len: int | None = None,
                   match_specials: bool = True, key: str = "word", mark: str = WORD_END,
                   at_start: bool = False) -> DataFrame:
    """J2 for a vocabulary of any size: substrings joined with it.

    The characters are split once; each position becomes a row with the next
    ``max_len`` of them, so the work is linear in the word's length."""
    vocab = _usable(vocab, None, match_specials)
    max_len = max_len or max_token_length(vocab)

    def tails(chars):
        return F.transform(F.sequence(F.lit(1), F.size(chars)),
                           lambda p: F.array_join(F.slice(chars, p, F.lit(max_len)), ""))

    chars = F.split(marked(F.col("word"), mark, at_start), "")
    at = words.select(key, F.posexplode(F.transform(F.array(chars), tails).getItem(0)).alias("p", "tail"))
    cands = at.select(key, (F.col("p") + 1).alias("pos"), F.explode(F.transform(
        F.sequence(F.lit(1), F.length("tail")), lambda k: F.struct(k.alias("len"), F.left(F.col("tail"), k).alias("s"))))
        .alias("c")).select(key, "pos", F.col("c.len").alias("len"), F.col("c.s").alias("token"))
    return cands.join(broadcast_if_small(vocab.select("token", "id")), "token").select(key, "id", "pos", "len")


def _walked(fold, automaton: tuple, word: Column, spark) -> Column:
    """``fold(start, size, id, ends, automaton) -> (position, id)``, ordered by position,
    for stretches of words; as an array of ids per word. A null word has none."""
    sent = spark.sparkContext.broadcast(automaton)
    matches, chunks = A.matcher(), A.chunker()

    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values, sizes = [np.zeros(0, dtype=np.int64)], [np.zeros(1, dtype=np.int64)]
            for part in chunks([w or "" for w in batch.to_pylist()]):
                start, size, token, ends = matches(sent.value, part)
                at, out = fold(start, size, token, ends, sent.value)
                values.append(out)
                sizes.append(np.diff(np.searchsorted(at, ends), prepend=0))
            yield pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(sizes)), pa.int32()),
                                           pa.array(np.concatenate(values), pa.int32()))

    return F.arrow_udf(ids, T.ArrayType(T.IntegerType()))(word)


def _priority_fold(unknown: int = UNK_ID):
    """Matches in ``(id, start)`` order, accepted when they overlap nothing accepted; one
    ``unknown`` per uncovered run of a word. Words do not overlap, so a stretch of them is
    folded as one, a token at a time (neighbours of one character together: they never
    overlap one another)."""
    def fold(start, size, token, ends, _):
        n = int(ends[-1]) if len(ends) else 0
        covered = np.zeros(n, dtype=bool)
        order = np.lexsort((start, token))
        s, k, t = start[order], size[order], token[order]
        group = np.where(k == 1, -1, t)
        cuts = np.concatenate([[0], np.nonzero(np.diff(group))[0] + 1, [len(t)]]) if len(t) else [0]
        kept = [order[:0]]
        for i, j in zip(cuts[:-1], cuts[1:]):
            at, width = s[i:j], int(k[i])
            free = ~covered[at]
            for d in range(1, width):
                free &= ~covered[at + d]
            at, which = at[free], order[i:j][free]
            if width > 1 and len(at) > 1 and np.diff(at).min() < width:     # the token overlaps itself
                take, last = [], -width
                for x, p in enumerate(at.tolist()):
                    if p >= last + width:
                        take.append(x)
                        last = p
                at, which = at[take], which[take]
            for d in range(width):
                covered[at + d] = True
            kept.append(which)
        kept = np.concatenate(kept)
        free = ~covered
        first = np.zeros(n + 1, dtype=bool)
        first[0], first[ends] = True, True
        runs = np.nonzero(free & (first[:-1] | ~np.concatenate([[False], free[:-1]])))[0] if n else np.zeros(0, dtype=np.int64)
        at = np.concatenate([start[kept], runs])
        ids = np.concatenate([token[kept], np.full(len(runs), unknown)])
        order = np.argsort(at, kind="stable")
        return at[order], ids[order]

    return fold


def _word_key() -> Column:
    """What stands for a word in its candidate rows: the word itself if it is
    short, else its SHA-256 (64 characters, so the two never meet). A very long
    word is thereby not repeated once per character."""
    return F.when(F.length("word") < 64, F.col("word")).otherwise(F.sha2(F.col("word").cast("binary"), 256))


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _segment_batch(word_len: pd.Series, ids: pd.Series, pos: pd.Series, lens: pd.Series) -> pd.Series:
    """Arrow-batched fold over one word per row: candidates in (id, pos) order,
    accepted when they overlap nothing accepted, one ``<unk>`` per uncovered run.
    Coverage is a byte per character, so a word costs its length and candidates."""
    out = []
    for n, ci, cp, cl in zip(word_len.to_numpy(), ids, pos, lens):
        covered = bytearray(int(n))
        at: dict[int, int] = {}
        if ci is not None and len(ci):
            for j in np.lexsort((cp, ci)):
                first, size = int(cp[j]) - 1, int(cl[j])
                if covered.find(1, first, first + size) < 0:
                    covered[first:first + size] = b"\x01" * size
                    at[first] = int(ci[j])
        free = np.frombuffer(covered, dtype=np.uint8) == 0
        starts = np.nonzero(free & ~np.concatenate([[False], free[:-1]]))[0]
        at.update((int(i), UNK_ID) for i in starts)
        out.append([at[i] for i in sorted(at)])
    return pd.Series(out)


def _encode_distinct(words: DataFrame, vocab: DataFrame, max_len: int | None, match_specials: bool,
                     automaton: tuple | None) -> DataFrame:
    """``words`` (one row per word, other columns kept) plus ``ids``; ``automaton`` is that
    of the usable tokens, None beyond its bounds."""
    if automaton is not None:
        return words.select(*words.columns, _walked(_priority_fold(), automaton, marked(F.col("word")),
                                                    words.sparkSession).alias("ids"))
    keyed = words.withColumn("_wk", _word_key())
    cands = substring_join(keyed, vocab, max_len, match_specials, key="_wk")
    grouped = cands.groupBy("_wk").agg(F.collect_list(F.struct("id", "pos", "len")).alias("_cands"))
    # words with no candidate at all (nothing of them in the vocabulary) still encode
    full = keyed.join(grouped, "_wk", "left")
    c = F.coalesce(F.col("_cands"), F.array().cast(_CAND))
    return full.select(*words.columns, _segment_batch(F.length(marked(F.col("word"))),
                                                      c["id"], c["pos"], c["len"]).alias("ids"))


def bpe_encode_words(words: DataFrame, vocab: DataFrame, max_len: int | None = None,
                     match_specials: bool = True) -> DataFrame:
    """B3/B4 on distinct words: ``(word, ids ARRAY<INT>)``."""
    return _encode_distinct(words.select("word").distinct(), vocab, max_len, match_specials,
                            A.compiled(_usable(vocab, max_len, match_specials)))


HOT_WORDS = 100_000  # most frequent words whose ids are broadcast at the most


def _sentence_split(lower: bool) -> Column:
    return F.array_remove(F.split(_cased(F.col("sentence"), lower), WORD_SPLIT_REGEX), "")


def _walked_lists(fold, automaton: tuple, words: Column, mark: str, at_start: bool, spark) -> Column:
    """``words ARRAY<STRING>`` of a row → the ids of all its words, one after the other.
    Each distinct word of a stretch of rows is folded once."""
    sent = spark.sparkContext.broadcast(automaton)
    matches, chunks = A.matcher(), A.chunker()

    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            bounds = np.concatenate([[0], np.cumsum(batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            coded = batch.flatten().dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            values, sizes = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
            for part in chunks([mark + w if at_start else w + mark for w in coded.dictionary.to_pylist()]):
                start, size, token, ends = matches(sent.value, part)
                at, out = fold(start, size, token, ends, sent.value)
                values.append(out)
                sizes.append(np.diff(np.searchsorted(at, ends), prepend=0))
            values, sizes = np.concatenate(values), np.concatenate(sizes)
            own = sizes[codes]                                          # ids per occurrence
            upto = np.concatenate([[0], np.cumsum(own)])
            begin = np.concatenate([[0], np.cumsum(sizes)])[codes]
            flat = values[np.repeat(begin - upto[:-1], own) + np.arange(upto[-1])]
            yield pa.ListArray.from_arrays(pa.array(upto[bounds], pa.int32()), pa.array(flat, pa.int32()))

    return F.arrow_udf(ids, T.ArrayType(T.IntegerType()))(words)


SENTENCE = ["paragraph_id", "idx"]


def _repeated(sentences: DataFrame) -> DataFrame | None:
    """Keys that more than one row has, or None. Only keys are shuffled."""
    twice = (sentences.groupBy(*SENTENCE).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
             .select(*[F.col(c).alias("_" + c) for c in SENTENCE]))
    return None if twice.isEmpty() else cut_lineage(twice)


def _encode_with(sentences: DataFrame, encode, in_place, lower: bool) -> DataFrame:
    """``(paragraph_id, idx, sentence)`` → ``(paragraph_id, idx, ids)``.

    ``in_place(words ARRAY<STRING>)`` is the column that encodes a row where it lies, or
    None: ``encode`` is then applied once per distinct word ``(word, n)`` and joined back.
    Rows of one key are one sentence, their words in the order of their places."""
    if in_place is None:
        return _encode_joined(sentences, encode, lower)
    alone, twice = sentences, _repeated(sentences)
    if twice is not None:
        same = [F.col(c).eqNullSafe(F.col("_" + c)) for c in SENTENCE]
        alone = sentences.join(twice, same, "left_anti")
    out = alone.where(F.col("sentence").isNotNull()).select(*SENTENCE, in_place(_sentence_split(lower)).alias("ids"))
    return out if twice is None else out.unionByName(_encode_joined(sentences.join(twice, same, "left_semi"), encode, lower))


def _encode_joined(sentences: DataFrame, encode, lower: bool) -> DataFrame:
    """``encode`` applied once per distinct word ``(word, n)``, joined back and regrouped."""
    split = _sentence_split(lower)
    words = sentences.select("paragraph_id", "idx", F.posexplode(split).alias("wpos", "word"))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    # one row per distinct word; written once so that all join branches read it
    encoded = cut_lineage(encode(counts))
    joined = hot_key_join(words, encoded.select("word", "ids"), "word", encoded.select("word", "n"),
                          hot_keys=HOT_WORDS)
    per_sentence = (joined.groupBy("paragraph_id", "idx")
                          .agg(F.array_sort(F.collect_list(F.struct("wpos", "ids"))).alias("_w"))
                          .select("paragraph_id", "idx", F.flatten(F.transform("_w", lambda s: s["ids"])).alias("ids")))
    empty = (sentences.where(F.size(split) == 0)
                      .select("paragraph_id", "idx", F.array().cast(T.ArrayType(T.IntegerType())).alias("ids")))
    return per_sentence.unionByName(empty)


def encode_sentences(sentences: DataFrame, vocab: DataFrame, max_len: int | None = None,
                     match_specials: bool = True, lower: bool = True) -> DataFrame:
    """``(paragraph_id, idx, sentence)`` → ``(paragraph_id, idx, ids)``.

    Word order is kept; a sentence without words encodes to ``[]``.
    """
    automaton = A.compiled(_usable(vocab, max_len, match_specials))

    def in_place(words):
        return _walked_lists(_priority_fold(), automaton, words, WORD_END, False, sentences.sparkSession)

    return _encode_with(sentences, lambda words: _encode_distinct(words, vocab, max_len, match_specials, automaton),
                        None if automaton is None else in_place, lower)


def _token_table(vocab: DataFrame) -> pa.Array | None:
    """The tokens by id, null where there is none; None for vocabularies that are too large
    for it (counted), hold an id twice or one that is negative or far beyond their number."""
    slim = vocab.select("id", "token")
    n, chars, least, most = slim.limit(A.MAX_TOKENS + 1).agg(
        F.count(F.lit(1)), F.sum(F.length("token")), F.min("id"), F.max("id")).first()
    if n > A.MAX_TOKENS or (chars or 0) > A.MAX_CHARS or (least or 0) < 0 or (most or 0) > 2 * A.MAX_TOKENS:
        return None
    rows = [r for r in slim.collect() if r["id"] is not None]  # bounded by the line above
    by_id = {r["id"]: r["token"] for r in rows}
    if len(by_id) < len(rows):
        return None
    return pa.array([by_id.get(i) for i in range((most or 0) + 1)], pa.string())


def _named(table: pa.Array, ids: Column, joined: bool, spark) -> Column:
    """The tokens of an array of ids (null where there is none), as an array or, ``joined``,
    as one string without the nulls."""
    sent = spark.sparkContext.broadcast(table)

    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = sent.value
        for batch in batches:
            flat = batch.flatten()
            inside = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(known)))
            names = known.take(pc.if_else(inside, flat, pa.scalar(None, pa.int32())))
            ends = np.cumsum(batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
            if not joined:
                yield pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), names)
                continue
            words = names.fill_null("")
            # the text of a row is a stretch of the tokens' own text
            first, text = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset:words.offset + len(words) + 1], words.buffers()[2]
            cuts = first[np.concatenate([[0], ends])] if len(words) else np.zeros(len(ends) + 1, dtype=np.int32)
            yield pa.StringArray.from_buffers(len(batch), pa.py_buffer(cuts.astype(np.int32).tobytes()), text if text is not None else pa.py_buffer(b""))

    return F.arrow_udf(tokens, T.StringType() if joined else T.ArrayType(T.StringType()))(ids)


def pieces_of(seqs: DataFrame, vocab: DataFrame, key_cols: list[str], ids_col: str = "ids") -> DataFrame:
    """Ids and the tokens they stand for, in order: ``key_cols + [ids, pieces ARRAY<STRING>]``;
    an id that is not in the vocabulary has a null piece. Keys must be unique. The tokens
    are looked up where a row lies, in a broadcast table; a vocabulary too large for one
    is joined."""
    table = _token_table(vocab)
    if table is not None:
        return seqs.where(F.col(ids_col).isNotNull()).select(
            *key_cols, F.col(ids_col).alias("ids"), _named(table, F.col(ids_col), False, seqs.sparkSession).alias("pieces"))
    named = seqs.select(*key_cols, F.posexplode(ids_col).alias("p", "id")).join(
        broadcast_if_small(vocab.select("id", "token")), "id", "left")
    some = (named.groupBy(*key_cols).agg(F.array_sort(F.collect_list(F.struct("p", "id", "token"))).alias("_t"))
            .select(*key_cols, F.transform("_t", lambda s: s["id"]).alias("ids"), F.transform("_t", lambda s: s["token"]).alias("pieces")))
    none = seqs.where(F.size(ids_col) == 0).select(*key_cols, F.array().cast("array<int>").alias("ids"),
                                                   F.array().cast("array<string>").alias("pieces"))
    return some.unionByName(none)


def _words_of(text: Column) -> Column:
    """The words of a decoded text: cut at the word end, one trailing empty piece dropped."""
    parts = F.split(text, WORD_END)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def decode(seqs: DataFrame, vocab: DataFrame, key_cols: list[str], ids_col: str = "ids") -> DataFrame:
    """Ids → words. Tokens are concatenated and split at the word end; one
    trailing empty piece is dropped. Returns ``key_cols + [words ARRAY<STRING>]``. Keys must
    be unique among the sequences that hold ids; other columns may be named among them.
    The tokens are looked up as in ``pieces_of``."""
    empty = (seqs.where(F.size(ids_col) == 0)
                 .select(*key_cols, F.array().cast(T.ArrayType(T.StringType())).alias("words")))
    table = _token_table(vocab)
    if table is not None:
        text = seqs.where(F.size(ids_col) > 0).select(
            *key_cols, _named(table, F.col(ids_col), True, seqs.sparkSession).alias("_s"))
    else:
        exploded = seqs.select(*key_cols, F.posexplode(ids_col).alias("p", "id"))
        named = exploded.join(broadcast_if_small(vocab.select("id", "token")), "id", "left")
        text = (named.groupBy(*key_cols)
                     .agg(F.array_sort(F.collect_list(F.struct("p", "token"))).alias("_t"))
                     .select(*key_cols, F.array_join(F.transform("_t", lambda s: s["token"]), "").alias("_s")))
    return text.select(*key_cols, _words_of(F.col("_s")).alias("words")).unionByName(empty)


def roundtrip_check(sentences: DataFrame, vocab: DataFrame, lower: bool = True) -> DataFrame:
    """Sentences whose decode(encode(x)) differs from their word list. A sentence is
    encoded, decoded and compared where it lies; only rows that share a key, and those
    of a vocabulary beyond the automaton's bounds, are joined with their decoded words."""
    automaton, table, spark = A.compiled(_usable(vocab, None, True)), _token_table(vocab), sentences.sparkSession
    rest = sentences
    out = None
    if automaton is not None and table is not None:
        alone, rest = sentences, None
        twice = _repeated(sentences)
        if twice is not None:
            same = [F.col(c).eqNullSafe(F.col("_" + c)) for c in SENTENCE]
            alone, rest = sentences.join(twice, same, "left_anti"), sentences.join(twice, same, "left_semi")
        orig = alone.where(F.col("sentence").isNotNull() & F.col("paragraph_id").isNotNull() & F.col("idx").isNotNull()).select(
            *SENTENCE, _sentence_split(lower).alias("orig"))
        enc = orig.select(*SENTENCE, "orig", _walked_lists(_priority_fold(), automaton, F.col("orig"), WORD_END, False, spark).alias("ids"))
        dec = enc.select(*SENTENCE, "orig", _named(table, F.col("ids"), True, spark).alias("_s"), F.size("ids").alias("_n"))
        none = F.array().cast(T.ArrayType(T.StringType()))
        out = dec.select(*SENTENCE, "orig", F.when(F.col("_n") == 0, none).otherwise(_words_of(F.col("_s"))).alias("words"))
    if rest is not None:
        enc = encode_sentences(rest, vocab, lower=lower)
        dec = decode(enc, vocab, SENTENCE)
        joined = rest.select(*SENTENCE, _sentence_split(lower).alias("orig")).join(dec, SENTENCE)
        out = joined if out is None else out.unionByName(joined)
    return out.where(F.col("orig") != F.col("words")).select("paragraph_id", "idx", "orig", "words")


# ------------------------------------------------------- unigram (max-likelihood) --
@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _viterbi_batch(word_len: pd.Series, ids: pd.Series, pos: pd.Series, lens: pd.Series,
                   scores: pd.Series, unk_score: pd.Series) -> pd.Series:
    """Best-scoring segmentation per word (sum of piece log-probabilities); a
    character no piece covers costs ``unk_score`` and consecutive ones fuse
    into one ``<unk>``. Ties keep the earlier-found (longer-first) piece."""
    out = []
    for L, ci, cp, cl, cs, us in zip(word_len.to_numpy(), ids, pos, lens, scores, unk_score.to_numpy()):
        L = int(L)
        ends: dict[int, list] = {}
        if ci is not None:
            for i, p, ln, sc in zip(ci, cp, cl, cs):
                ends.setdefault(int(p) + int(ln) - 1, []).append((int(p) - 1, int(i), float(sc)))
        best = [0.0] + [-np.inf] * L
        back: list = [None] * (L + 1)
        for e in range(1, L + 1):
            for start, tid, sc in ends.get(e, []):
                v = best[start] + sc
                if v > best[e]:
                    best[e], back[e] = v, (start, tid)
            v = best[e - 1] + float(us)
            if v > best[e]:
                best[e], back[e] = v, (e - 1, UNK_ID)
        seq, e = [], L
        while e > 0:
            start, tid = back[e]
            seq.append(tid)
            e = start
        seq.reverse()
        fused = [t for k, t in enumerate(seq) if not (t == UNK_ID and k > 0 and seq[k - 1] == UNK_ID)]
        out.append(fused)
    return pd.Series(out)


def _viterbi_fold(unk_score: float, unknown: int = UNK_ID):
    """Best-scoring path per word, as ``_viterbi_batch``; matches come longest first at
    an end, so ties keep the longest."""
    def fold(start, size, token, ends, automaton):
        scores = automaton[3]
        by_end: dict[int, list] = {}
        for s, k, t, sc in zip(start.tolist(), size.tolist(), token.tolist(), scores[token].tolist()):
            by_end.setdefault(s + k, []).append((s, t, sc))
        at, ids, begin = [], [], 0
        for end in ends.tolist():
            best, back = {begin: 0.0}, {}
            for e in range(begin + 1, end + 1):
                top, step = -np.inf, None
                for s, t, sc in by_end.get(e, ()):
                    if best[s] + sc > top:
                        top, step = best[s] + sc, (s, t)
                if best[e - 1] + unk_score > top:
                    top, step = best[e - 1] + unk_score, (e - 1, unknown)
                best[e], back[e] = top, step
            path, e = [], end
            while e > begin:
                path.append(back[e])
                e = back[e][0]
            path.reverse()
            for k, (s, t) in enumerate(path):
                if t != unknown or k == 0 or path[k - 1][1] != unknown:
                    at.append(s)
                    ids.append(t)
            begin = end
        return np.asarray(at, dtype=np.int64), np.asarray(ids, dtype=np.int64)

    return fold


def _scored_pieces(vocab: DataFrame) -> tuple[DataFrame, float, tuple | None]:
    """The pieces, the score of an unknown character, and the automaton (None beyond its bounds)."""
    token = "piece" if "piece" in vocab.columns else "token"
    pieces = vocab.where(F.col("id") >= N_SPECIAL).select("id", F.col(token).alias("token"),
                                                          F.col("score").cast("double").alias("score"))
    unk = (pieces.agg(F.min("score")).first()[0] or 0.0) - 10.0  # one scalar
    return pieces, unk, A.compiled(pieces)


def _unigram_distinct(words: DataFrame, scored: tuple, mark: str, at_start: bool) -> DataFrame:
    pieces, unk, automaton = scored
    if automaton is not None:
        return words.select(*words.columns, _walked(_viterbi_fold(unk), automaton, marked(F.col("word"), mark, at_start),
                                                    words.sparkSession).alias("ids"))
    keyed = words.withColumn("_wk", _word_key())
    cands = substring_join(keyed, pieces, key="_wk", mark=mark, at_start=at_start).join(
        broadcast_if_small(pieces.select("id", "score")), "id")
    grouped = cands.groupBy("_wk").agg(F.collect_list(F.struct("id", "pos", "len", "score")).alias("c"))
    full = keyed.join(grouped, "_wk", "left")
    empty = F.array().cast("array<struct<id:int,pos:int,len:int,score:double>>")
    c = F.coalesce(F.col("c"), empty)
    return full.select(*words.columns, _viterbi_batch(F.length(marked(F.col("word"), mark, at_start)),
                                                      c["id"], c["pos"], c["len"], c["score"], F.lit(unk)).alias("ids"))


def unigram_encode_words(words: DataFrame, vocab: DataFrame, mark: str = WORD_END,
                         at_start: bool = False) -> DataFrame:
    """``vocab(id, token | piece, score)`` log-probability pieces →
    max-likelihood ids per distinct word (same matches as B3). Unknown
    characters score ``min(score) - 10``. A vocabulary file (S3) marks the
    start of a word: ``mark=WORD_START, at_start=True``."""
    return _unigram_distinct(words.select("word").distinct(), _scored_pieces(vocab), mark, at_start)


def unigram_encode_sentences(sentences: DataFrame, vocab: DataFrame, mark: str = WORD_START,
                             at_start: bool = True, lower: bool = False) -> DataFrame:
    """B7/B8 with the pieces and scores of a vocabulary file; the case is kept.
    Pieces hold the word mark only in front, so words are independent."""
    scored = _scored_pieces(vocab)
    _, unk, automaton = scored

    def in_place(words):
        return _walked_lists(_viterbi_fold(unk), automaton, words, mark, at_start, sentences.sparkSession)

    return _encode_with(sentences, lambda words: _unigram_distinct(words, scored, mark, at_start),
                        None if automaton is None else in_place, lower)


def unigram_scores(encoded: DataFrame, vocab: DataFrame) -> DataFrame:
    """Piece log-probabilities from token frequencies of an encoded corpus
    (one counting pass, partial aggregation); unseen pieces get the minimum."""
    # a row per piece, written once: the total and the minimum read it again
    freq = cut_lineage(encoded.select(F.explode("ids").alias("id")).where(F.col("id") >= N_SPECIAL)
                       .groupBy("id").count())
    total, least = freq.agg(F.sum("count"), F.min("count")).first()
    score = F.log(F.coalesce(F.col("count"), F.lit(least or 1)) / F.lit(total or 1))
    return vocab.join(broadcast_if_small(freq), "id", "left").select("id", "token", score.alias("score"))
