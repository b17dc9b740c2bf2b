"""Piece scores by expectation maximisation.

``fit`` takes distinct words with their counts and candidate pieces. A round computes,
per distinct word, the expected number of every piece over all segmentations
(forward-backward on the matches of the vocabulary automaton), adds them up, weighted
by the word's count, and makes log shares of them the new scores. Each Arrow batch
adds up its own words first, so a row per piece and batch is shuffled, and in whole
millionths, so the sums do not depend on their order. Characters no piece covers
cost ``unk_score``, which stays as it was before the first round.

After each round but the last pieces with an expected count below ``least`` go, single
characters excepted. Without pruning the likelihood never falls.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions.constants import N_SPECIAL, WORD_START
from textmill.operators import automaton as A
from textmill.operators.encode import marked
from textmill.session import cut_lineage

UNIT = 1_000_000
LIKELIHOOD = -1  # id of the row that holds the log-likelihood


def seed_pieces(counts: DataFrame, size: int, max_len: int = 8, mark: str = WORD_START, at_start: bool = True) -> DataFrame:
    """``(id, token, score)``: every character of the marked words and, up to ``size`` in all, the
    substrings that cover most text; ids follow score and token."""
    chars = F.split(marked(F.col("word"), mark, at_start), "")
    tails = F.transform(F.sequence(F.lit(1), F.size("c")), lambda p: F.slice("c", p, F.lit(max_len)))
    at = counts.select(chars.alias("c"), "n").select(F.explode(tails).alias("t"), "n")
    subs = at.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("t")),
                                           lambda k: F.array_join(F.slice("t", F.lit(1), k), ""))).alias("token"), "n")
    found = cut_lineage(subs.groupBy("token").agg(F.sum("n").alias("n")))
    single = found.where(F.length("token") == 1)
    longer = (found.where((F.length("token") > 1) & (F.col("n") > 1))
              .orderBy((F.col("n") * F.length("token")).desc(), "token").limit(max(0, size - single.count())))
    return numbered(single.unionByName(longer).withColumn("w", F.col("n").cast("double")))


def numbered(pieces: DataFrame) -> DataFrame:
    """``(token, w)`` → ``(id, token, score)``: log shares of ``w``, ids behind the special tokens
    in the order of score and token. A vocabulary is bounded by ``automaton.MAX_TOKENS``."""
    rows = sorted(((-r["w"], r["token"]) for r in pieces.select("token", "w").limit(A.MAX_TOKENS + 1).collect()))
    if len(rows) > A.MAX_TOKENS:
        raise ValueError(f"more than {A.MAX_TOKENS} pieces")
    total = math.fsum(-w for w, _ in rows)
    return pieces.sparkSession.createDataFrame(
        [(N_SPECIAL + i, t, math.log(-w / total)) for i, (w, t) in enumerate(rows)], "id int, token string, score double")


def expectations():
    """A function ``(start, size, id, ends, weights, scores, unk) -> (expected by id, likelihood)``
    over a stretch of words, both in whole millionths; nested, so that it is shipped by value.

    All words of the stretch go forward and back together, a place per step; the matches
    that begin at a place follow by size, so every sum is added up in one order."""
    unit = UNIT

    def expected(start, size, token, ends, weights, scores, unk):
        lengths = np.diff(ends, prepend=0)
        word = np.repeat(np.arange(len(ends)), lengths)
        place = np.arange(len(word)) - (ends - lengths)[word]           # of a character in its word
        # a word has a node more than characters, so the nodes of the words before shift its own
        by_place = np.argsort(place, kind="stable")
        nodes = by_place + word[by_place]
        node_cuts = np.searchsorted(place[by_place], np.arange(lengths.max(initial=0) + 1))
        which = np.arange(len(start)) - np.searchsorted(start, start)   # number of a match among those of its place
        order = np.lexsort((which, place[start]))
        at, which, token = start[order], which[order], token[order]
        source, target, score = at + word[at], at + word[at] + size[order], scores[token]
        cuts = np.searchsorted(place[at], np.arange(len(node_cuts)))

        before = np.full(len(word) + len(ends), -np.inf)    # log weight of all ways up to a node
        before[ends - lengths + np.arange(len(ends))] = 0.0
        after = np.full(len(before), -np.inf)               # and from a node to the end
        after[ends + np.arange(len(ends))] = 0.0
        steps = list(zip(node_cuts[:-1].tolist(), node_cuts[1:].tolist(), cuts[:-1].tolist(), cuts[1:].tolist()))
        for a, b, c, d in steps:
            own = nodes[a:b]
            before[own + 1] = np.logaddexp(before[own + 1], before[own] + unk)
            to = target[c:d]
            before[to] = np.logaddexp(before[to], before[source[c:d]] + score[c:d])
        for a, b, c, d in reversed(steps):
            own = nodes[a:b]
            after[own] = after[own + 1] + unk
            ranks = np.searchsorted(which[c:d], np.arange(which[d - 1] + 2)) + c if d > c else []
            for e, f in zip(ranks[:-1], ranks[1:]):
                s = source[e:f]
                after[s] = np.logaddexp(after[s], score[e:f] + after[target[e:f]])
        whole, n = before[ends + np.arange(len(ends))], np.asarray(weights, dtype=np.float64)
        back = np.lexsort((which, -at))                     # a word's shares are added from its end
        share = before[source[back]] + score[back] + after[target[back]] - whole[word[at[back]]]
        share = np.fromiter(map(math.exp, share.tolist()), dtype=np.float64, count=len(share))
        keys, slot = np.unique(word[at[back]] * len(scores) + token[back], return_inverse=True)
        of_word = np.zeros(len(keys))
        np.add.at(of_word, slot, share)
        rounded = np.rint(of_word * n[keys // len(scores)] * unit).astype(np.int64)
        ids, slot = np.unique(keys % len(scores), return_inverse=True)
        sums = np.zeros(len(ids), dtype=np.int64)
        np.add.at(sums, slot, rounded)
        return dict(zip(ids.tolist(), sums.tolist())), int(np.rint(whole * n * unit).astype(np.int64).sum())

    return expected


def expected_counts(counts: DataFrame, pieces: DataFrame, unk_score: float, mark: str = WORD_START,
                    at_start: bool = True) -> DataFrame:
    """``(id, expected)`` in millionths over ``counts(word, n)``; id -1: the log-likelihood."""
    automaton = A.compiled(pieces)
    if automaton is None:
        raise ValueError(f"pieces must be unique, at most {A.MAX_TOKENS} of {A.MAX_CHARS} characters")
    sent = counts.sparkSession.sparkContext.broadcast(automaton)
    matches, chunks, expected = A.matcher(), A.chunker(), expectations()
    like = LIKELIHOOD

    def run(batches):
        for batch in batches:
            sums, likelihood, first = {}, 0, 0
            weights = batch.column(1).to_pylist()
            for part in chunks(batch.column(0).to_pylist()):
                some, l = expected(*matches(sent.value, part), weights[first:first + len(part)], sent.value[3], unk_score)
                first, likelihood = first + len(part), likelihood + l
                for t, x in some.items():
                    sums[t] = sums.get(t, 0) + x
            yield pa.RecordBatch.from_arrays([pa.array([like, *sums], pa.int32()), pa.array([likelihood, *sums.values()], pa.int64())],
                                             ["id", "expected"])

    words = counts.where(F.col("word").isNotNull()).select(marked(F.col("word"), mark, at_start).alias("w"), F.col("n").cast("long").alias("n"))
    # decimals: the sum of a whole corpus in millionths may pass 64 bits
    return words.mapInArrow(run, "id int, expected long").groupBy("id").agg(F.sum(F.col("expected").cast("decimal(38,0)")).alias("expected"))


def fit(counts: DataFrame, pieces: DataFrame, rounds: int = 4, least: float = 0.5, mark: str = WORD_START,
        at_start: bool = True) -> tuple[DataFrame, list[float]]:
    """``(pieces(id, token, score), log-likelihood before each round)``. No words: the
    pieces as they are."""
    unk = (pieces.agg(F.min("score")).first()[0] or 0.0) - 10.0
    course = []
    for r in range(rounds):
        sums = {row["id"]: int(row["expected"]) for row in expected_counts(counts, pieces, unk, mark, at_start).collect()}  # a row per piece
        if not sums:
            return pieces, course
        course.append(sums.pop(LIKELIHOOD) / UNIT)
        floor = 0 if r == rounds - 1 else least * UNIT
        held = [(row["token"], float(max(sums.get(row["id"], 0), 1))) for row in pieces.collect()
                if len(row["token"]) == 1 or sums.get(row["id"], 0) > floor]
        if not held:
            return pieces, course
        pieces = numbered(pieces.sparkSession.createDataFrame(held, "token string, w double"))
    return pieces, course
