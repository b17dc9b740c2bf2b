"""Vocabulary statistics and byte-pair vocabulary training.

Training works on the *distinct-word* table ``(word, symbols, n, first_doc,
first_pos)``, which stays on Spark: a round counts its pairs (partial + final, so hot
pairs are combined map-side), pulls the candidates and the added-up segments they
form, a bounded number of symbols, and decides hundreds of merges on them; see
``bpe_train``.
"""

from __future__ import annotations

import heapq
import sys
from collections import defaultdict

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.functions.constants import N_SPECIAL, SPECIAL_TOKENS, WORD_END
from textmill.operators.index import dense_index
from textmill.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # task functions travel with the job


# ---------------------------------------------------------------- statistics --
def word_counts(words: DataFrame) -> DataFrame:
    """A1: ``(word, n, first_doc, first_pos)`` from ``(doc_id, pos, word)``."""
    return (words.groupBy("word")
                 .agg(F.count(F.lit(1)).alias("n"),
                      F.min(F.struct("doc_id", "pos")).alias("_first"))
                 .select("word", "n", F.col("_first.doc_id").alias("first_doc"),
                         F.col("_first.pos").alias("first_pos")))


def symbolize(counts: DataFrame) -> DataFrame:
    """Add ``symbols`` = characters of ``word`` followed by the word-end mark."""
    return counts.withColumn("symbols", F.split(F.concat(F.col("word"), F.lit(WORD_END)), ""))


def alphabet(words: DataFrame) -> DataFrame:
    """A2: distinct symbols (characters of all words, plus the word end): a task marks the
    code points of its words' text and sends each once, so no word is shuffled."""
    mark = WORD_END

    def characters(batches):
        import numpy as np
        import pyarrow as pa

        seen, any_word = np.zeros(0x110000, dtype=bool), False
        for batch in batches:
            some = batch.column(0).drop_null().cast(pa.large_binary())
            any_word = any_word or len(some) > 0
            if len(some) and some.buffers()[2] is not None:
                ends = np.frombuffer(some.buffers()[1], dtype=np.int64)[some.offset:some.offset + len(some) + 1]
                text = some.buffers()[2][int(ends[0]):int(ends[-1])].to_pybytes().decode()
                seen[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)] = True
        found = {chr(c) for c in np.nonzero(seen)[0].tolist()} | ({mark} if any_word else set())
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], ["symbol"])

    return words.select("word").mapInArrow(characters, "symbol string").distinct()


def pair_counts(state: DataFrame) -> DataFrame:
    """A3: adjacent symbol pairs weighted by word count, overlapping occurrences
    counted; ``first_*`` is the first insertion (word first occurrence, position)."""
    pairs = state.select(
        "n", "first_doc", "first_pos",
        F.posexplode(F.arrays_zip(F.slice("symbols", 1, F.size("symbols") - 1).alias("l"),
                                  F.slice("symbols", 2, F.size("symbols")).alias("r")))
         .alias("sym_pos", "p"))
    return (pairs.groupBy(F.col("p.l").alias("left_sym"), F.col("p.r").alias("right_sym"))
                 .agg(F.sum("n").alias("n"),
                      F.min(F.struct("first_doc", "first_pos", "sym_pos")).alias("_f"))
                 .select("left_sym", "right_sym", "n", F.col("_f.first_doc").alias("first_doc"),
                         F.col("_f.first_pos").alias("first_pos"),
                         F.col("_f.sym_pos").cast("long").alias("first_sym")))


def best_pair(pairs: DataFrame, k: int = 1) -> DataFrame:
    """Arg-max pair; ties go to the earliest first insertion (distributed top-k)."""
    return pairs.orderBy(F.col("n").desc(), "first_doc", "first_pos", "first_sym").limit(k)


def merge_pair_expr(symbols: Column, left: str, right: str) -> Column:
    """B2: replace adjacent ``(left, right)`` by ``left+right``, left to right,
    non-overlapping. A merged symbol never equals ``left``, so it is not re-merged.
    Words that lack one of the two symbols are passed over."""
    l, r = F.lit(left), F.lit(right)

    def merged(s):
        return F.aggregate(
            s, F.array().cast(T.ArrayType(T.StringType())),
            lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1) == l) & (x == r),
                                  F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.lit(left + right))))
                            .otherwise(F.concat(acc, F.array(x))))

    # a lambda over the one array: ``symbols`` may be an expression and is computed once
    return F.transform(F.array(symbols), lambda s: F.when(
        F.array_contains(s, l) & F.array_contains(s, r), merged(s)).otherwise(s)).getItem(0)


def merge_pair(state: DataFrame, left: str, right: str) -> DataFrame:
    return state.withColumn("symbols", merge_pair_expr(F.col("symbols"), left, right))


# ------------------------------------------------------------------- training --
WORKING_SYMBOLS = 1_000_000   # symbols of candidate segments that the driver holds
FIRST_PAIRS = 256             # candidate pairs of the first round; later ones follow the room left
MOST_PAIRS = 200_000
_TASK_SEGMENTS = 200_000      # distinct segments that a task adds up before it emits them


def _merged(symbols: list, a: str, b: str) -> list:
    out: list = []
    for x in symbols:
        if out and out[-1] == a and x == b:
            out[-1] = a + b
        else:
            out.append(x)
    return out


def _apply(symbols: list, rank: dict) -> list:
    """The merges in ``rank`` (pair -> number) applied in their order."""
    while len(symbols) > 1:
        best = min((rank.get(p, -1) for p in zip(symbols, symbols[1:]) if p in rank), default=None)
        if best is None:
            return symbols
        a, b = next(p for p in zip(symbols, symbols[1:]) if rank.get(p) == best)
        symbols = _merged(symbols, a, b)
    return symbols


def _sortable(v):
    """A value of any id column as Spark orders it: nulls first, structs by field."""
    if isinstance(v, dict):
        v = tuple(v.values())
    return tuple(map(_sortable, v)) if isinstance(v, tuple) else (v is not None, v)


def _before(n, doc, pos):
    """Sort key of a pair: frequent first, then by first occurrence."""
    return -n, _sortable(doc), _sortable(pos)


def _merge_segments(rows: list, vocab: set, max_vocab_size: int, outside: tuple | None) -> list[tuple[str, str]]:
    """The next merges, as far as the segments decide them.

    ``rows (symbols, n, first_doc, first_pos)`` come in the order of their first
    occurrence; ``vocab`` grows. Pair counts are kept up to date: a merge visits
    only the segments that hold its pair. A pair's key is (-count, first segment,
    place in it), as in ``best_pair``. ``outside`` is the ``_before`` key of the
    best pair that no segment holds (None: there is none): merging goes on while the
    best pair comes before it, and stops after a merge whose string exists already."""
    words, n = [list(r["symbols"]) for r in rows], [r["n"] for r in rows]
    total, holds = defaultdict(int), defaultdict(set)
    for w, s in enumerate(words):
        for p in zip(s, s[1:]):
            total[p] += n[w]
            holds[p].add(w)
    order = {p: sorted(ws) for p, ws in holds.items()}  # heaps of segments; those that lost the pair go when they surface

    def key_of(p):
        ws, heap = holds[p], order[p]
        while heap[0] not in ws:
            heapq.heappop(heap)
        s = words[heap[0]]
        return -total[p], heap[0], next(i for i in range(len(s) - 1) if s[i] == p[0] and s[i + 1] == p[1])

    keys = {p: key_of(p) for p in holds}
    best = [(k, p) for p, k in keys.items()]
    heapq.heapify(best)
    merges: list[tuple[str, str]] = []
    while len(vocab) + N_SPECIAL < max_vocab_size:
        while best and keys.get(best[0][1]) != best[0][0]:
            heapq.heappop(best)
        if not best:
            break
        (count, w, _), (a, b) = best[0]
        # the first one is the best of all pairs in any case
        if merges and outside is not None and not _before(-count, rows[w]["first_doc"], rows[w]["first_pos"]) < outside:
            break
        known = a + b in vocab
        vocab.add(a + b)
        merges.append((a, b))
        if known and outside is not None:
            break
        touched = set()
        for w in list(holds[a, b]):
            old, new = words[w], _merged(words[w], a, b)
            words[w] = new
            for p in zip(old, old[1:]):
                total[p] -= n[w]
            for p in zip(new, new[1:]):
                total[p] += n[w]
            before, after = set(zip(old, old[1:])), set(zip(new, new[1:]))
            for p in before - after:
                holds[p].discard(w)
            for p in after - before:
                holds[p].add(w)
                heapq.heappush(order.setdefault(p, []), w)
            touched |= before | after
        for p in touched:
            if not holds[p]:
                del holds[p], total[p], order[p]
                keys.pop(p, None)
                continue
            k = key_of(p)
            if keys.get(p) != k:
                keys[p] = k
                heapq.heappush(best, (k, p))
    return merges


def segments(state: DataFrame, pairs: list[tuple[str, str]] | None) -> DataFrame:
    """Distinct stretches of symbols whose neighbours are all in ``pairs`` (None: any
    neighbours), with their summed counts and the place where they come first:
    ``(symbols, n, first_doc, first_pos, off)``, ``off`` in characters."""
    wanted = None if pairs is None else set(pairs)
    kinds = [state.schema[c].dataType.simpleString() for c in ("first_doc", "first_pos")]
    schema = f"symbols array<string>, n long, first_doc {kinds[0]}, first_pos {kinds[1]}, off long"

    def run(batches):
        import pyarrow as pa
        types: list = []

        def table(found):
            rows = list(found.values())
            return pa.RecordBatch.from_arrays(
                [pa.array(list(map(list, found)), pa.list_(pa.string())), pa.array([r[0] for r in rows], pa.int64()),
                 *[pa.array([r[2][i] for r in rows], t) for i, t in enumerate(types)]], ["symbols", "n", "first_doc", "first_pos", "off"])
        found: dict = {}
        for batch in batches:
            types[:] = [batch.schema.field(2).type, batch.schema.field(3).type, pa.int64()]
            for s, n, doc, pos in zip(*(batch.column(i).to_pylist() for i in range(4))):
                start = 0
                for end in range(1, len(s) + 1):
                    if end < len(s) and (wanted is None or (s[end - 1], s[end]) in wanted):
                        continue
                    if end - start > 1:
                        part, place = tuple(s[start:end]), (doc, pos, sum(map(len, s[:start])))
                        key = tuple(map(_sortable, place))
                        have = found.get(part)
                        if have is None:
                            found[part] = [n, key, place]
                        else:
                            have[0] += n
                            if key < have[1]:
                                have[1:] = key, place
                    start = end
            if len(found) >= _TASK_SEGMENTS:
                yield table(found)
                found = {}
        if found:
            yield table(found)
    return (state.select("symbols", "n", "first_doc", "first_pos").mapInArrow(run, schema).groupBy("symbols")
            .agg(F.sum("n").alias("n"), F.min(F.struct("first_doc", "first_pos", "off")).alias("f"))
            .select("symbols", "n", "f.first_doc", "f.first_pos", "f.off"))


def apply_merges(state: DataFrame, merges: list[tuple[str, str]]) -> DataFrame:
    """``state`` after ``merges``, applied in their order to every word."""
    rank = {p: i for i, p in enumerate(merges)}

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            done = [_apply(s, rank) for s in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.list_(pa.string())), *batch.columns[1:]], batch.schema.names)
    return state.mapInArrow(run, state.schema)


def bpe_train(spark: SparkSession, words: DataFrame, max_vocab_size: int,
              working_symbols: int = WORKING_SYMBOLS, first_pairs: int = FIRST_PAIRS,
              stats: list | None = None) -> tuple[list[str], list[tuple[str, str]]]:
    """B1: learn a byte-pair vocabulary from ``(doc_id, pos, word)``.

    Returns ``(idx2word, merges)``: specials, then the learned tokens by length
    descending (ties by token text — our fixed rule), and the merge list.
    Characters of every word enter the vocabulary even past ``max_vocab_size``;
    a merge whose string already exists still consumes a round.

    Rounds. The distinct words stay on Spark. A round counts their pairs, takes the
    most frequent ``k`` of them as candidates and cuts every word into segments whose
    neighbours are candidates; equal segments of all words are added up. These go to
    the driver, which merges on them with pair counts kept by differences. The counts
    there are whole: a pair of candidates, or of what was merged from them, stands in
    segments only. Any other pair lies across the end of a segment, where a pair
    that is no candidate lay before, and each of its occurrences was one of that
    pair (strings are merged in one way only within a round, or the round ends), so
    it comes after the best pair outside. Merging stops where that bound is reached,
    which takes hundreds of merges a round; then the words are merged on Spark.

    ``k`` follows the room: candidates are halved until their segments hold at most
    ``working_symbols`` symbols and doubled when they hold less than a third, so the
    driver's share is bounded for any input and small inputs take one round.
    ``stats`` gets a row (merges, candidate pairs, symbols held) per round.
    """
    state = cut_lineage(symbolize(word_counts(words)).select("symbols", "n", "first_doc", "first_pos"))
    vocab = {r[0] for r in state.select(F.explode("symbols")).distinct().collect()}  # bounded by the character set
    merges: list[tuple[str, str]] = []
    k = first_pairs
    while len(vocab) + N_SPECIAL < max_vocab_size:
        ranked = best_pair(pair_counts(state), min(k, MOST_PAIRS) + 1).collect()
        if not ranked:
            break
        while True:
            top, rest = ranked[:k], ranked[k:]
            held = cut_lineage(segments(state, [(r["left_sym"], r["right_sym"]) for r in top] if rest else None))
            size = held.agg(F.sum(F.size("symbols"))).first()[0] or 0
            if size <= working_symbols or k == 1:
                break
            k = max(1, min(k, len(ranked)) // 2)
        rows = held.orderBy("first_doc", "first_pos", "off", "symbols").collect()  # at most ``working_symbols`` symbols
        outside = _before(rest[0]["n"], rest[0]["first_doc"], rest[0]["first_pos"]) if rest else None
        batch = _merge_segments(rows, vocab, max_vocab_size, outside)
        merges += batch
        if stats is not None:
            stats.append((len(batch), len(top), size))
        if outside is None:
            break
        state = cut_lineage(apply_merges(state, batch))
        if 3 * size < working_symbols:
            k = min(2 * k, MOST_PAIRS)
    learned = sorted(vocab, key=lambda t: (-len(t), t))
    return list(SPECIAL_TOKENS) + learned, merges


# ------------------------------------------------------------ vocabulary sets --
def vocab_table(spark: SparkSession, tokens: list[str]) -> DataFrame:
    """``(id, token)`` from an ordered token list (bounded by the vocabulary size)."""
    return spark.createDataFrame([(i, t) for i, t in enumerate(tokens)], "id int, token string")


LOCAL_VOCAB_ROWS = 200_000


def materialize_vocab(vocab: DataFrame) -> DataFrame:
    """Compute a vocabulary once: as a local table if it is small, which every
    later lookup reuses, else as a checkpointed one of any size."""
    rows = vocab.select("id", "token").limit(LOCAL_VOCAB_ROWS + 1).collect()
    if len(rows) > LOCAL_VOCAB_ROWS:
        return cut_lineage(vocab.select("id", "token"))
    return vocab.sparkSession.createDataFrame([(r[0], r[1]) for r in rows], "id int, token string")


def vocab_order(learned: DataFrame, token_col: str = "token") -> DataFrame:
    """T1 + U1: specials first, then distinct learned tokens by length desc,
    token asc; id = 5 + rank."""
    spark = learned.sparkSession
    toks = (learned.select(F.col(token_col).alias("token"))
                   .where(~F.col("token").isin(SPECIAL_TOKENS))
                   .dropDuplicates(["token"]))
    ranked = dense_index(toks.withColumn("_shorter", -F.length("token")), ["_shorter", "token"], out="_rank")
    ranked = ranked.select((F.col("_rank") + N_SPECIAL).cast("int").alias("id"), "token")
    specials = spark.createDataFrame([(i, t) for i, t in enumerate(SPECIAL_TOKENS)], "id int, token string")
    return specials.unionByName(ranked)


def vocab_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Tokens in exactly one of two vocabularies, tagged by side."""
    ta, tb = a.select("token"), b.select("token")
    return (ta.join(tb, "token", "left_anti").withColumn("side", F.lit("only_a"))
              .unionByName(tb.join(ta, "token", "left_anti").withColumn("side", F.lit("only_b"))))
