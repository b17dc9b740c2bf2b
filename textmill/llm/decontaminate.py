"""Benchmark decontamination by BM25 retrieval and overlap checks (operator 7).

The test items form an inverted index with BM25 impacts (``K1``, ``B``), scaled
so that an item's score against itself is 1. Items are grouped in blocks of
``BLOCK``; next to each posting list stand the largest impacts per block. Every
training passage queries the index: documents are read in passages of twice the
longest item with half of that as the step, so an item of any length lies whole
in one passage. Block-max WAND, with the passages of a batch side by side in arrays:
the terms of a passage are ordered by their largest impact; those before the pivot,
the first term at which the summed maxima reach ``THRESHOLD``, cannot make a match
alone, so only blocks in the postings from the pivot on are looked at. To these the
block maxima of the earlier terms are added, and only blocks whose bound reaches
``THRESHOLD`` are scored exactly; all items that reach it are retrieved. A retrieved item is reported if at least ``OVERLAP`` of the
shingles of its question and of its answer stand in the passage.
Shingles have ``SHINGLE`` words, in short parts fewer, so that one changed word
takes at most a fifth of them (``shingle_length``).
The answer is the last sentence of an item, the question the rest; an item that
cannot be split so (either part shorter than a shingle) is split in the middle.

Words are runs of ASCII letters, digits and non-ASCII bytes, A-Z lower-cased.

The index is sent to the tasks in shards of at most ``SHARD_BYTES`` of item
text; every shard is one pass over the documents, so nothing that is broadcast
grows without bound. Document frequencies, item count, mean and largest length
are taken over all items, so scores do not depend on the shards. Documents are only
read, never moved.

Defined cases: null or empty texts and items without words match nothing;
repeated rows are judged alike (one finding per document id and item); a null
``doc_id`` is reported as null; empty tables give an empty result; an item with
fewer words than a shingle is compared as one shingle; other columns are ignored
by ``find_leaks`` and passed through by ``drop_leaks``.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import broadcast_if_small, text_key, written

K1, B = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP = 0.8
SHINGLE = 5
BLOCK = 8
SHARD_BYTES = 16 << 20
_CELLS = 4_000_000   # (passage, block) bounds held at once
_WORDS = 1_000_000   # words of documents held at once
_TABLE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().translate(_TABLE).split()


def shingle_length(n: int) -> int:
    """One changed word breaks k of n - k + 1 shingles: at most a fifth if n >= 6 k - 1."""
    return n if n < SHINGLE else min(SHINGLE, (n + 1) // 6)


def shingles(words: list, k: int) -> set:
    return set(zip(*(words[i:] for i in range(k)))) if words else set()


def question_and_answer(text: str) -> tuple[tuple[set, int], tuple[set, int]]:
    """Shingles and their length, of the question and of the answer."""
    body = (text or "").strip()
    cut = max(body[:-1].rfind(c) for c in ".?!\n")
    question, answer = words_of(body[:cut + 1]), words_of(body[cut + 1:])
    if min(len(question), len(answer)) < SHINGLE:
        words = words_of(body)
        half = len(words) // 2
        question, answer = words[:half], words[half:]
        if half < SHINGLE:
            question = answer = words
    return tuple((shingles(p, shingle_length(len(p))), shingle_length(len(p))) for p in (question, answer))


class Index:
    """Inverted index over items: postings (CSR) with impacts, and block maxima.
    ``df``, ``count``, ``mean`` and ``longest`` describe all items, not only these."""

    def __init__(self, items: list[tuple[int, str]], df: dict, count: int, mean: float, longest: int):
        items = [(i, t) for i, t in items if words_of(t)]
        self.item_id = [i for i, _ in items]
        self.parts = [question_and_answer(t) for _, t in items]
        bags = [Counter(words_of(t)) for _, t in items]
        sizes = [sum(b.values()) for b in bags]
        self.longest = max(1, longest)
        mean = max(1.0, mean)
        self.term = {w: n for n, w in enumerate(sorted({w for b in bags for w in b}))}
        found = []
        for n, (bag, size) in enumerate(zip(bags, sizes)):
            raw = {w: math.log(1 + (count - df[w] + 0.5) / (df[w] + 0.5)) * tf * (K1 + 1)
                   / (tf + K1 * (1 - B + B * size / mean)) for w, tf in bag.items()}
            own = sum(raw.values())
            found += [(self.term[w], n, x / own) for w, x in raw.items()]
        found.sort()
        self.items = np.array([f[1] for f in found], dtype=np.int64)
        self.impact = np.array([f[2] for f in found])
        terms = np.array([f[0] for f in found], dtype=np.int64)
        self.at = np.searchsorted(terms, np.arange(len(self.term) + 1))
        self.n_blocks = -(-len(items) // BLOCK)
        key, where = np.unique(terms * max(1, self.n_blocks) + self.items // BLOCK, return_inverse=True)
        top = np.zeros(len(key))
        np.maximum.at(top, where, self.impact)
        self.block, self.block_max = key % max(1, self.n_blocks), top
        self.block_at = np.searchsorted(key // max(1, self.n_blocks), np.arange(len(self.term) + 1))
        self.term_max = np.zeros(len(self.term))
        np.maximum.at(self.term_max, key // max(1, self.n_blocks), top)

    @classmethod
    def of(cls, state: dict) -> Index:
        """From the plain arrays and tables of another one, as they are broadcast."""
        index = cls.__new__(cls)
        vars(index).update(state)
        return index

    def _after_pivot(self, passages, terms, threshold):
        """Which (passage, term) pairs are the pivot of their passage or come after it,
        by falling rarity: the terms before it cannot reach ``threshold`` together."""
        order = np.lexsort((self.term_max[terms], passages))
        total = np.cumsum(self.term_max[terms[order]])
        first = np.append(True, np.diff(passages[order]) != 0)[:len(order)]
        start = (total - self.term_max[terms[order]])[first]
        out = np.zeros(len(terms), dtype=bool)
        out[order] = total - np.repeat(start, np.diff(np.append(np.nonzero(first)[0], len(order)))) >= threshold - 1e-9
        return out

    def search(self, passages: np.ndarray, terms: np.ndarray, n: int, threshold: float):
        """Distinct (passage, term) pairs, sorted → (passage, item, score) of all
        items that reach ``threshold``; ``n`` passages."""
        late = self._after_pivot(passages, terms, threshold)
        blocks = (self.block_at, self.block, self.block_max)
        bound = np.bincount(*self._spread(passages[late] * self.n_blocks, terms[late], *blocks), minlength=n * self.n_blocks)
        near = np.zeros(n, dtype=bool)              # passages that have a block after their pivot
        near[np.nonzero(bound)[0] // max(1, self.n_blocks)] = True
        early = ~late & near[passages]
        key, weight = self._spread(passages[early] * self.n_blocks, terms[early], *blocks)
        seen = bound[key] > 0
        bound += np.bincount(key[seen], weight[seen], minlength=len(bound))
        open_blocks = np.nonzero(bound >= threshold - 1e-9)[0]
        out, ends = [], np.searchsorted(passages, np.arange(n + 1))
        for p in np.unique(open_blocks // max(1, self.n_blocks)):
            mine = terms[ends[p]:ends[p + 1]]
            key, weights = self._spread(np.zeros(len(mine), dtype=np.int64), mine, self.at, self.items, self.impact)
            score = np.bincount(key, weights, minlength=len(self.item_id))
            for item in np.nonzero(score >= threshold)[0]:
                out.append((int(p), int(item), float(score[item])))
        return out

    @staticmethod
    def _spread(base, terms, at, what, weight):
        lens = at[terms + 1] - at[terms]
        k = np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens) + np.repeat(at[terms], lens)
        return np.repeat(base, lens) + what[k], weight[k]


def _scan(texts: list[str | None], index: Index, threshold: float, overlap: float):
    """(row, item, score, question overlap, answer overlap) over a batch of texts."""
    step = index.longest
    get, width = index.term.get, max(1, len(index.term))
    most = max(1, _CELLS // max(1, index.n_blocks))
    rows, keys, n, held = [], [], 0, 0   # rows: (row, first passage, words)

    def flush():
        pairs = np.unique(np.concatenate(keys)) if keys else np.zeros(0, dtype=np.int64)
        best: dict = {}
        firsts = np.array([r[1] for r in rows])
        for p, item, score in index.search(pairs // width, pairs % width, n, threshold):
            row, first, words = rows[int(np.searchsorted(firsts, p, side="right")) - 1]
            own = words[(p - first) * step:(p - first + 2) * step]
            q, a = (len(part & shingles(own, k)) / len(part) for part, k in index.parts[item])
            if q >= overlap and a >= overlap:
                best[row, item] = max(best.get((row, item), (0.0, 0.0, 0.0)), (score, q, a))
        return [(row, item, *v) for (row, item), v in best.items()]

    for row, text in enumerate(texts):
        words = words_of(text)
        if not words:
            continue
        ids = np.array([get(w, -1) for w in words], dtype=np.int64)
        pos = np.nonzero(ids >= 0)[0]
        hits = ids[pos]
        cell = pos // step
        local = -(-len(words) // step)
        both = np.concatenate([cell, cell[cell > 0] - 1])  # a word is in two passages
        keys.append(np.unique((n + both) * width + np.concatenate([hits, hits[cell > 0]])))
        rows.append((row, n, words))
        n += local
        held += len(words)
        if n > most or held > _WORDS:
            yield from flush()
            rows, keys, n, held = [], [], 0, 0
    if rows:
        yield from flush()


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP,
               shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, tk, item_id, score, question_overlap, answer_overlap) per match."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, tk long, item_id long, score double, question_overlap double, answer_overlap double"
    items = benchmark.select(F.col("item_id").cast("long"), "text").where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_shards = -(-total // shard_bytes)
    shard_of = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, n_shards))).cast("int")
    words = written(items.select(shard_of.alias("shard"), "text").mapInArrow(_item_words, "shard int, word binary, n long, item boolean"), "leak-words")
    sizes = words.where("item").agg(F.count(F.lit(1)), F.sum("n"), F.max("n")).first()
    df = words.where(~F.col("item")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    source = docs.select("doc_id", text_key(F.col("text")).alias("tk"), "text")
    found = spark.createDataFrame([], schema)
    for shard in range(n_shards if sizes[0] else 0):
        # all three are bounded by the text of a shard, about ``shard_bytes``
        rows = items.where(shard_of == shard).collect()
        own = words.where((F.col("shard") == shard) & ~F.col("item")).select("word").distinct()
        counts = {bytes(r["word"]): r["df"] for r in df.join(own, "word").collect()}
        built = Index([(r["item_id"], r["text"]) for r in rows], counts, sizes[0], sizes[1] / sizes[0], sizes[2])
        # plain arrays and tables: workers need no copy of this module to read them
        index = spark.sparkContext.broadcast(vars(built))

        def run(batches, index=index):
            ix = Index.of(index.value)
            for b in batches:
                got = list(_scan_in_parts(b.column(2), ix, threshold, overlap))
                take = pa.array([g[0] for g in got], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(take), b.column(1).take(take), pa.array([ix.item_id[g[1]] for g in got], pa.int64()),
                     *[pa.array([g[k] for g in got], pa.float64()) for k in (2, 3, 4)]],
                    ["doc_id", "tk", "item_id", "score", "question_overlap", "answer_overlap"])
        found = found.unionByName(source.mapInArrow(run, schema))
    return found


def _item_words(batches):
    """Per item: its distinct words, and a row with its length."""
    for b in batches:
        for shard, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            words = words_of(text)
            if not words:
                continue
            distinct = list(set(words))
            k = len(distinct)
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * (k + 1), pa.int32()), pa.array([*distinct, None], pa.binary()),
                 pa.array([1] * k + [len(words)], pa.int64()), pa.array([False] * k + [True])], ["shard", "word", "n", "item"])


def _scan_in_parts(column, index, threshold, overlap, step: int = 500):
    for at in range(0, len(column), step):
        texts = [t.as_py() for t in column.slice(at, step)]
        for row, *rest in _scan(texts, index, threshold, overlap):
            yield (at + row, *rest)


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a match, with the columns they came with."""
    bad = written(find_leaks(docs, benchmark).select(
        F.col("doc_id").alias("_dc_id"), F.col("tk").alias("_dc_tk")).distinct(), "leaks")
    keyed = docs.withColumn("_dc_key", text_key(F.col("text")))
    return keyed.join(broadcast_if_small(bad, 64), keyed["doc_id"].eqNullSafe(bad["_dc_id"])
                      & (keyed["_dc_key"] == bad["_dc_tk"]), "left_anti").select(*docs.columns)


def op7_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document id and matched item."""
    best = F.max(F.struct("score", "question_overlap", "answer_overlap")).alias("m")
    return (find_leaks(docs, benchmark).groupBy("doc_id", "item_id").agg(best)
            .select("doc_id", "item_id", F.round("m.score", 6).alias("score"),
                    F.round("m.question_overlap", 6).alias("question_overlap"),
                    F.round("m.answer_overlap", 6).alias("answer_overlap")))
