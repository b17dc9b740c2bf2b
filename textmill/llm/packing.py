"""Best-fit packing of tokenised documents into sequences (operator 9).

A document is the ids of a public tokenizer followed by id 0; only documents
longer than ``size`` are cut, into pieces of ``size`` ids.

Planning works on the histogram of piece lengths (at most ``size`` rows, so it
fits on the driver whatever the input): best fit over counts in order of
falling length. Sequences with the same free space form a class; a length takes
the tightest class that holds it, many sequences at a time, and opens new ones
only when none does. This gives the packing that best-fit-decreasing gives when
it handles the pieces one by one. The plan is a few thousand runs of slots
``(length, first rank, count, first sequence, slots per sequence, offset)``.

Spark turns the runs into one row per slot and joins them to the pieces on
``(length, rank within length)``. Ranks come from a window over ``(length,
salt)`` plus the counts of the smaller salts, so that a length shared by a third
of all pieces is spread over many tasks.

Tokenising happens in Arrow batches; the ids of a stretch's distinct words are looked up in a bounded
cache, because the tokenizer never joins characters across white space.

Defined cases: a null or empty text is the single id 0; repeated rows are packed
as separate pieces; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import re
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import TEXT_ROWS, partitions, written

SIZE = 2048
VOCABULARY = "word_bpe_49k.json"
RANK_ROWS = 100_000     # pieces per (length, salt) window, about
SLOT_RUN = 4096         # slots made from one row
MARK = "<|startoftext|>"  # a special token of the vocabulary
_CACHE = 450_000        # words and word cores kept by a worker
_SEGMENT = 1 << 22      # characters split at once
_CLOSING = ".,!?;:$%&#*"
_BEFORE_CLOSING = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789" + "ßàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿ")
_ODD_SPACE = re.compile("[\x1c-\x1f]")  # white space to Python, not to the tokenizer


class WordIds:
    """Ids of words as little-endian 32-bit bytes. A word that ``known`` lacks is
    looked up by its core: in lower case (if ASCII), without at most three closing
    ``_CLOSING`` after an ASCII letter or digit or a small Latin-1 letter, which the
    tokenizer always splits off. (Its normaliser turns some other letters into a letter
    and a mark, and a mark joins the comma.)"""

    def __init__(self, tokenizer, closing: np.ndarray, known: dict):
        self.tokenizer, self.closing, self.known = tokenizer, closing, known
        self.mark_id = tokenizer.token_to_id(MARK)
        self.tails = {"": b""}

    def ids(self, text: str) -> np.ndarray:
        # the batch call without offsets is the quicker one, also for a single text
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def whole(self, text: str) -> bytes:
        return self.ids(text).tobytes()

    def encode_new(self, cores: list[str]) -> dict[str, bytes]:
        found: dict[str, bytes] = {}
        words, rest = [w for w in cores if w.isalpha()], [w for w in cores if not w.isalpha()]
        for at in range(0, len(words), 10_000):
            # letters only: one token with a word end for each word
            part = words[at:at + 10_000]
            ids = self.ids(" ".join(part))
            ends = 4 * (np.nonzero(self.closing[ids])[0] + 1)
            if len(ends) == len(part):
                _cut(found, part, ids, ends, 0)
            else:
                rest += part
        plain = [w for w in rest if "<|" not in w]
        for at in range(0, len(plain), 10_000):
            # anything else: a special token between two words keeps them apart
            part = plain[at:at + 10_000]
            ids = self.ids(MARK.join(part))
            _cut(found, part, ids, 4 * np.append(np.nonzero(ids == self.mark_id)[0], len(ids)), 4)
        found.update((w, self.whole(w)) for w in rest if "<|" in w)
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each distinct word of the texts is looked up once; its ids are set in for
        every occurrence."""
        n_words, spaced = [], []
        for t in texts:
            split = None if _ODD_SPACE.search(t) else t.split()
            n_words.append(-1 if split is None else len(split))
            if split:
                spaced.append(" ".join(split))
        coded = _words(spaced).dictionary_encode()
        known, tails, parts = self.known, self.tails, {}
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(known.get, words))
        for at in [i for i, ids in enumerate(found) if ids is None]:
            w = words[at]
            w = w.lower() if w.isascii() else w
            core = w.rstrip(_CLOSING)
            if core and len(w) - len(core) <= 3 and core[-1] in _BEFORE_CLOSING:
                parts[at] = core, w[len(core):]
            else:
                parts[at] = w, ""
        new = self.encode_new(list({core for core, _ in parts.values()}.difference(known)))
        for at, (core, tail) in parts.items():
            ids = new[core] if core in new else known[core]
            if tail and tail not in tails:
                tails[tail] = self.whole(tail)
            found[at] = ids + tails[tail]
        for at, (core, _) in islice(parts.items(), max(0, _CACHE - len(known)) // 2):  # frequent words come first
            known[words[at]] = found[at]
            known[core] = new[core] if core in new else known[core]

        ids = np.frombuffer(b"".join(found), dtype="<u4")
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        codes = coded.indices.to_numpy()
        own = sizes[codes]                                              # ids per occurrence
        upto = np.concatenate([[0], np.cumsum(own)])
        begin = (np.cumsum(sizes) - sizes)[codes]
        every = ids[np.repeat(begin - upto[:-1], own) + np.arange(upto[-1])].tobytes()
        ends = (4 * upto[np.cumsum(np.maximum(n_words, 0))]).tolist()
        return [self.whole(t) if n < 0 else every[first:end]
                for t, n, first, end in zip(texts, n_words, [0, *ends], ends)]


def _words(texts: list[str]) -> pa.Array:
    """The words of texts that one space parts, as an array."""
    raw = np.frombuffer(" ".join(texts).encode(), dtype=np.uint8)
    gaps = np.nonzero(raw == 32)[0]
    n = len(gaps) + 1 if len(raw) else 0
    offsets = np.concatenate([[0], gaps - np.arange(len(gaps)), [len(raw) - len(gaps)]]).astype(np.int32)
    return pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(raw[raw != 32]))


def _cut(found: dict, words, ids: np.ndarray, ends: np.ndarray, gap: int) -> None:
    ids, first = ids.tobytes(), 0
    for w, end in zip(words, ends.tolist()):
        found[w] = ids[first:end]
        first = end + gap


def word_ids(vocabulary: str) -> WordIds:
    """Kept for the life of the worker process, so that its later tasks know the
    words of earlier ones."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tokenizers
    kept = vars(tokenizers).setdefault("_textmill_word_ids", {})
    if vocabulary not in kept:
        tokenizer = tokenizers.Tokenizer.from_file(vocabulary)
        closing = np.zeros(tokenizer.get_vocab_size(), dtype=bool)
        closing[[i for t, i in tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        kept[vocabulary] = tokenizer, closing, {}
    return WordIds(*kept[vocabulary])


def segments(text: str):
    """Parts of at most about ``_SEGMENT`` characters, cut at spaces."""
    at = 0
    while len(text) - at > _SEGMENT:
        cut = text.rfind(" ", at + 1, at + _SEGMENT)
        cut = text.find(" ", at + _SEGMENT) if cut < 0 else cut
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def _ids_of(texts: list[str], words: WordIds):
    """The ids of each text, at most about ``_SEGMENT`` characters at a time."""
    group, size = [], 0
    for t in texts:
        if len(t) > _SEGMENT:
            if group:
                yield from words.encode(group)
            group, size = [], 0
            parts = [t] if _ODD_SPACE.search(t) else segments(t)
            yield b"".join(words.encode([p])[0] for p in parts)
            continue
        group.append(t)
        size += len(t)
        if size > _SEGMENT:
            yield from words.encode(group)
            group, size = [], 0
    if group:
        yield from words.encode(group)


def pieces(docs: DataFrame, vocabulary: str, size: int = SIZE) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32); ``vocabulary`` is the path of a
    tokenizer file that every executor can read."""
    def run(batches):
        words = word_ids(vocabulary)
        for b in batches:
            rows, piece, start, length, crc = [], [], [], [], []
            texts = [t.as_py() or "" for t in b.column(1)]
            for row, ids in enumerate(_ids_of(texts, words)):
                ids = memoryview(ids + b"\0\0\0\0")
                for n, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at:at + 4 * size]
                    rows.append(row)
                    piece.append(n)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def plan(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit over counts; rows (length, rank, n, sequence, per, offset): slot
    ``k < n`` of the row is at ``offset + (k % per) * length`` of sequence
    ``sequence + k // per`` and goes to the piece with rank ``rank + k``."""
    free: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]  # runs of sequences by free space
    rows, opened = [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        for room in range(length, size + 1):
            per = room // length
            while left and (free[room] or room == size):
                first, n = free[room].pop() if free[room] else (opened, -(-left // per))
                if first == opened:
                    opened += n
                full = min(n, left // per)
                if full:
                    rows.append((length, rank, full * per, first, per, size - room))
                    free[room - per * length].append((first, full))
                    rank, left = rank + full * per, left - full * per
                if full < n and left and left < per:
                    rows.append((length, rank, left, first + full, left, size - room))
                    free[room - left * length].append((first + full, 1))
                    rank, left, full = rank + left, 0, full + 1
                if full < n:
                    free[room].append((first + full, n - full))
            if not left:
                break
    return rows


def ranked(parts: DataFrame, n: int) -> DataFrame:
    """``parts`` with ``rank``: 0, 1, ... within each length."""
    salts = max(1, -(-n // RANK_ROWS))
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    before = (salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
              .select("length", "salt", F.coalesce(F.sum("n").over(
                  Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")))
    local = salted.withColumn("local", F.row_number().over(
        Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")) - 1)
    return local.join(before, ["length", "salt"]).withColumn("rank", F.col("local") + F.col("before")).drop("salt", "local", "before")


def slots(spark, rows) -> DataFrame:
    """One row (length, rank, sequence_id, offset) per planned slot."""
    runs = spark.createDataFrame(rows, "length long, rank0 long, n long, seq0 long, per long, off0 long")
    runs = runs.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(n - 1) div " + str(SLOT_RUN)))))
    runs = runs.repartition(partitions(spark), "length", "rank0", "part")
    last = F.least(F.col("n"), (F.col("part") + 1) * SLOT_RUN) - 1
    k = F.explode(F.sequence(F.col("part") * SLOT_RUN, last)).alias("k")
    return runs.select("*", k).select("length", (F.col("rank0") + F.col("k")).alias("rank"),
                                      (F.col("seq0") + F.expr("k div per")).alias("sequence_id"),
                                      (F.col("off0") + F.col("k") % F.col("per") * F.col("length")).alias("offset"))


def pack(docs: DataFrame, vocabulary: str | None = None, size: int = SIZE) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) per piece."""
    spark = docs.sparkSession
    if vocabulary is None:
        import public_tokenizers
        vocabulary = public_tokenizers.path(VOCABULARY)
    parts = written(pieces(docs, str(vocabulary), size), "pack-pieces", TEXT_ROWS)
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= size rows
    taken = slots(spark, plan(histogram, size))
    return ranked(parts, sum(histogram.values())).join(taken, ["length", "rank"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op9_best_fit_packing(docs: DataFrame) -> DataFrame:
    return pack(docs)
