"""Substring deduplication of long word sequences (operator 4).

Words are ``[^\\x20\\x09-\\x0D]+``. A window is ``size`` (20) consecutive words of one
document; words covered by a window that also starts earlier (smaller
``doc_id``, or same document and earlier start) are removed.

Anchors. Every document is cut into non-overlapping blocks of ``size // 2`` words;
their hashes are the index. A repeated window holds a whole block of its other
occurrence, wherever the two stand, so probing the index with the rolling
``size // 2``-word windows of all documents finds every repeat. Only hashes travel:
a map task takes a few MB of text at a time, keeps one probe per distinct hash,
and sends, per hash bucket, 32 hash bits, an index bit and a position gap for
each (about five bytes a word). A hot passage is thereby one probe per map task
and bucket, however many documents share it. A bucket task answers with the
probes whose hash is an indexed block and stands elsewhere, too, and tells which
of the indexed blocks among them were only probed, not met by another block.

Extension. If a window repeats, every block of its own document inside it is probed
from the other occurrence, and some block of that one is met in it. Only windows
with both can repeat, so a repeat that is little longer than a block, of which there are
more and more as the corpus grows, goes no further. For the others the hash of all ``size``
words (64 bits, besides the bucket's own bits) goes through the same
exchange once more, the earliest occurrence per map task first, and all but the
earliest overall come back. Runs of them are the maximal exact repeats, whose
words go. Marks are joined to the texts where these are read, as a broadcast of
measured size; only beyond that are the texts shuffled by document.

Ties: rows with equal ``doc_id`` are ordered by a hash of their text; rows that
repeat a document exactly are one document, so nothing is removed from one
because of the other. A null ``doc_id`` comes before all others.

Defined cases: null or empty texts have no words; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import broadcast_if_small, text_key, written

SIZE = 20
PACK_WORDS = 400_000      # words that a map task handles at once
BUCKET_BYTES = 4 << 20    # bytes of text per hash bucket
_PACK = "bucket int, pack long, docs binary, counts binary, pos binary, flag binary, h binary, n_docs int"
_NO_DOC = -(1 << 63)
_PROBED = 1 << 30         # added to the position of a block that is met by no other block; no text has that many words


# ------------------------------------------------------------- task helpers

_IS_SPACE = np.isin(np.arange(256), list(b"\x20\t\n\x0b\x0c\r"))
_BASE = 0x9E3779B97F4A7C15                       # odd, so it has an inverse modulo 2**64
_CHUNK = 1 << 16                                 # bytes hashed at once; no word may be longer


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n + 1, base, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_POWER, _INVERSE = _powers(_BASE, _CHUNK), _powers(pow(_BASE, -1, 1 << 64), _CHUNK)


def _word_hashes(text: str | None) -> np.ndarray:
    """One 64-bit hash per word: a polynomial of its bytes, taken from prefix
    sums over a stretch of text, mixed with its length."""
    raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
    inside = np.concatenate([[False], ~_IS_SPACE[raw], [False]])
    edges = np.nonzero(inside[1:] != inside[:-1])[0]
    starts, ends = edges[::2], edges[1::2]
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        first = starts[at]
        upto = max(int(np.searchsorted(ends, first + _CHUNK, side="right")), at)
        if upto == at:  # a word longer than a stretch
            out[at] = xxhash.xxh3_64_intdigest(raw[first:ends[at]].tobytes())
            at += 1
            continue
        part = raw[first:ends[upto - 1]].astype(np.uint64) + np.uint64(1)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(part * _POWER[:len(part)], out=sums[1:])
        s, e = starts[at:upto] - first, ends[at:upto] - first
        out[at:upto] = (sums[e] - sums[s]) * _INVERSE[s] + (e - s).astype(np.uint64)
        at = upto
    return _mix(out)


def _mix(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def rolling(word_hashes: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Hashes of all ``k``-word windows (64 bits)."""
    n = len(word_hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    factor = np.random.default_rng(seed).integers(1, 2**63, k).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out += word_hashes[j:j + n] * factor[j]
    return _mix(out)


def _planes(values: np.ndarray) -> bytes:
    """32-bit numbers as four byte planes: the high ones, mostly zero, compress away."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).reshape(-1).view("<u4").astype(np.int64)


def _encode(doc: np.ndarray, pos: np.ndarray) -> tuple[bytes, bytes]:
    """Positions sorted by document → (counts per document, position gaps)."""
    change = np.nonzero(np.diff(doc))[0] + 1
    starts = np.concatenate([[0], change])
    gaps = np.diff(pos, prepend=0)
    gaps[starts] = pos[starts]
    return _planes(np.diff(np.append(starts, len(doc)))), _planes(gaps)


def _decode(counts: bytes, pos: bytes) -> tuple[np.ndarray, np.ndarray]:
    """→ (ordinal of the document, position)."""
    n, gaps = _unplanes(counts), _unplanes(pos)
    doc = np.repeat(np.arange(len(n)), n)
    total = np.cumsum(gaps)
    starts = np.cumsum(n) - n
    return doc, total - np.repeat(total[starts] - gaps[starts], n)


def _distinct(ordered: np.ndarray) -> np.ndarray:
    return ordered[np.append(True, np.diff(ordered) != 0)[:len(ordered)]]


def _after_first(h, ids, keys, pos) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by hash and corpus order → which start later than the first of
    their hash. An exact repeat of a document is the same document: its windows
    are as early as the first one's."""
    first = np.append(True, np.diff(h) != 0)[:len(h)]
    lead = np.nonzero(first)[0][np.cumsum(first) - 1]
    same = (ids == ids[lead]) & (keys == keys[lead]) & (pos == pos[lead])
    return ~same, same


class _Pack:
    """Windows of some documents, dealt to hash buckets."""

    def __init__(self, number: int, buckets: int):
        self.number, self.buckets = number, buckets
        self.docs, self.parts, self.size = [], [], 0

    def add(self, doc: tuple[int, int], pos: np.ndarray, h: np.ndarray, flag: np.ndarray, words: int):
        self.docs.append(doc)
        self.parts.append((pos, h, flag))
        self.size += words

    def rows(self, keep_flag: bool, wide: bool):
        """One row per bucket with a probe per distinct hash. With ``keep_flag``
        equal hashes of the pack are sent as they are found first and the others
        are reported in a row of bucket -1; their flags are joined."""
        n = [len(p) for p, _, _ in self.parts]
        if not sum(n):
            return
        doc = np.repeat(np.arange(len(n)), n)
        pos, h, flag = (np.concatenate([p[k] for p in self.parts]) for k in range(3))
        ids = np.array([d[0] for d in self.docs], dtype="<i8")
        keys = np.array([d[1] for d in self.docs], dtype="<i8")
        order = np.argsort(h)
        first = np.append(True, np.diff(h[order]) != 0)
        alone = first & np.append(first[1:], True)
        if keep_flag:
            begin = np.nonzero(first)[0]
            flags = flag.copy()
            flags[order[first]] = np.logical_or.reduceat(flag[order], begin)
            sent, local = order[first], order[~alone]
        else:
            flags = flag
            tied = order[~alone]  # equal hashes, now in the order of the corpus
            tied = tied[np.lexsort((pos[tied], keys[doc[tied]], ids[doc[tied]], h[tied]))]
            later, same = _after_first(h[tied], ids[doc[tied]], keys[doc[tied]], pos[tied])
            sent, local = np.concatenate([order[alone], tied[~later]]), tied[later]
        tables = ids.tobytes(), keys.tobytes()
        yield self._row(-1, np.sort(local), doc, pos, flags, None, tables)
        bucket = (h[sent] >> np.uint64(32)) % np.uint64(self.buckets) if not wide else _mix(h[sent].copy()) % np.uint64(self.buckets)
        by = np.argsort(sent)
        sent, bucket = sent[by], bucket[by].astype(np.uint16 if self.buckets < 1 << 16 else np.int64)
        by = np.argsort(bucket, kind="stable")
        sent, bucket = sent[by], bucket[by]
        cuts = np.concatenate([[0], np.nonzero(np.diff(bucket.astype(np.int64)))[0] + 1, [len(sent)]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            rows = sent[a:b]
            low = h[rows].astype("<u8").tobytes() if wide else (h[rows] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()
            yield self._row(int(bucket[a]), rows, doc, pos, flags, low, tables if wide else None)

    def _row(self, bucket, rows, doc, pos, flags, low, tables):
        used = _distinct(doc[rows])
        counts, gaps = _encode(doc[rows], pos[rows]) if len(rows) else (b"", b"")
        if tables is None:
            docs = used.astype("<i4").tobytes()       # ordinals; the ids are in the row of bucket -1
        else:
            docs = b"".join(np.frombuffer(t, "<i8")[used].tobytes() for t in tables) if bucket >= 0 else (
                used.astype("<i4").tobytes().ljust(4 * len(used)) + b"".join(tables))
        return bucket, self.number, docs, counts, gaps, np.packbits(flags[rows]).tobytes(), low or b"", len(used)


def _batch(rows) -> pa.RecordBatch:
    cols = list(zip(*rows))
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 5, pa.int32()]
    names = ["bucket", "pack", "docs", "counts", "pos", "flag", "h", "n_docs"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)


def _number(partition: int, count: int) -> int:
    return (partition << 24) + count


def _probes(size: int, buckets: int):
    """Round 1, map side: (doc_id, tk, text) → packs of block-length windows."""
    block = size // 2

    def run(batches):
        from pyspark import TaskContext
        part, count = TaskContext.get().partitionId(), 0
        pack = _Pack(_number(part, 0), buckets)
        for b in batches:
            for d, k, t in zip(b.column(0), b.column(1), b.column(2)):
                w = _word_hashes(t.as_py())
                if len(w) < size:
                    continue
                h = rolling(w, block, 1)
                pos = np.arange(len(h))
                pack.add((_NO_DOC if d.as_py() is None else d.as_py(), k.as_py()), pos, h, pos % block == 0, len(w))
                if pack.size >= PACK_WORDS:
                    yield from (_batch([r]) for r in pack.rows(True, False))
                    count += 1
                    pack = _Pack(_number(part, count), buckets)
        yield from (_batch([r]) for r in pack.rows(True, False))
    return run


def _answer_probes(key, table):
    """Round 1, bucket side: which probes hit an indexed block that stands elsewhere."""
    if key[0].as_py() < 0:
        return table
    rows = table.to_pylist()
    del table
    h = np.concatenate([np.frombuffer(r["h"], "<u4") for r in rows])
    flag = np.concatenate([np.unpackbits(np.frombuffer(r["flag"], np.uint8), count=len(r["h"]) // 4) for r in rows]).astype(bool)
    order = np.argsort(h, kind="stable")
    hs = h[order]
    first = np.nonzero(np.append(True, hs[1:] != hs[:-1]))[0]
    size = np.diff(np.append(first, len(hs)))
    blocks = np.repeat(np.add.reduceat(flag[order].astype(np.int64), first), size)
    hit, probed = np.zeros(len(h), dtype=bool), np.zeros(len(h), dtype=bool)
    hit[order] = (blocks > 0) & np.repeat(size > 1, size)
    probed[order] = flag[order] & (blocks == 1)
    return _replies(rows, hit, 4, probed)


def _replies(rows, hit, width, probed=None):
    """The hits per pack and bucket; ``probed`` ones have ``_PROBED`` added to their position."""
    out, at = [], 0
    for r in rows:
        n = len(r["h"]) // width
        mine, only = hit[at:at + n], None if probed is None else probed[at:at + n]
        at += n
        if not mine.any():
            continue
        doc, pos = _decode(r["counts"], r["pos"])
        doc, pos = doc[mine], pos[mine]
        if only is not None:
            pos = pos + _PROBED * only[mine]
            order = np.lexsort((pos, doc))
            doc, pos = doc[order], pos[order]
        used = _distinct(doc)
        counts, gaps = _encode(doc, pos)
        if width == 4:
            docs = np.frombuffer(r["docs"], "<i4")[used].tobytes()
        else:
            docs = np.frombuffer(r["docs"], "<i8").reshape(2, -1)[:, used].tobytes()
        out.append((r["bucket"], r["pack"], docs, counts, gaps, b"", b"", len(used)))
    if not out:
        return pa.Table.from_batches([], schema=_batch([(0, 0, b"", b"", b"", b"", b"", 0)]).schema)
    return pa.Table.from_batches([_batch(out)])


_MARKS = "doc_id long, tk long, marks binary"


def _marks(ids, keys, doc, pos) -> pa.Table:
    """(doc_id, tk, marks): sorted positions per document."""
    order = np.lexsort((pos, doc))
    doc, pos = doc[order], pos[order]
    cuts = np.concatenate([[0], np.nonzero(np.diff(doc))[0] + 1, [len(doc)]]) if len(doc) else np.zeros(1, dtype=int)
    own = doc[cuts[:-1]] if len(doc) else np.zeros(0, dtype=int)
    return pa.table({"doc_id": pa.array(ids[own], pa.int64()), "tk": pa.array(keys[own], pa.int64()),
                     "marks": pa.array([_runs(pos[a:b]) for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())})


def _runs(pos: np.ndarray) -> bytes:
    """Sorted positions as (first, length) of their runs."""
    pos = np.unique(pos)
    starts = np.nonzero(np.append(True, np.diff(pos) > 1))[0]
    return np.stack([pos[starts], np.diff(np.append(starts, len(pos)))]).astype("<u4").tobytes()


def _positions(marks: bytes) -> np.ndarray:
    first, n = np.frombuffer(marks, "<u4").astype(np.int64).reshape(2, -1)
    return np.repeat(first - np.cumsum(n) + n, n) + np.arange(int(n.sum()))


def _open_windows(hits: np.ndarray, size: int) -> np.ndarray:
    """Starts of the windows that can repeat, from the hits of a document: one is met by
    another block within, and all own blocks within are hits. Past the end of the text
    no window is looked for, so a start may lie there."""
    block = size // 2
    met = hits[hits < _PROBED]
    if not len(met):
        return met
    own = np.zeros(int((hits & (_PROBED - 1)).max()) // block + 3, dtype=np.int64)
    own[(hits & (_PROBED - 1))[hits % _PROBED % block == 0] // block] = 1
    near = np.zeros(int(met.max()) + 2, dtype=np.int64)   # windows [hit - (size - block), hit]
    np.add.at(near, np.maximum(met - (size - block), 0), 1)
    np.add.at(near, met + 1, -1)
    starts = np.nonzero(np.cumsum(near)[:-1] > 0)[0]
    first, last = -(-starts // block), (starts + size - block) // block
    found = np.concatenate([[0], np.cumsum(own)])
    last = np.minimum(last, len(own) - 1)
    return starts[found[last + 1] - found[first] == last + 1 - first]


def _collect_pack(size: int):
    """Round 1, back at the pack: windows that can repeat per document, from the hits of
    all buckets. Hashes found twice in the pack count as met by another block."""
    def run(key, table):
        rows = table.to_pylist()
        own = next(r for r in rows if r["bucket"] < 0)
        tables = np.frombuffer(own["docs"][4 * own["n_docs"]:], "<i8").reshape(2, -1)
        docs, poss = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for r in rows:
            if r["counts"]:
                doc, pos = _decode(r["counts"], r["pos"])
                docs.append(np.frombuffer(r["docs"][:4 * r["n_docs"]], "<i4")[doc].astype(np.int64))
                poss.append(pos)
        doc, pos = np.concatenate(docs), np.concatenate(poss)
        order = np.argsort(doc, kind="stable")
        doc, pos = doc[order], pos[order]
        starts = [_open_windows(p, size) for p in np.split(pos, np.nonzero(np.diff(doc))[0] + 1)]
        return _marks(tables[0], tables[1], np.repeat(_distinct(doc), [len(x) for x in starts][:len(doc)]), np.concatenate(starts))
    return run


def _candidates(size: int, buckets: int):
    """Round 2, map side: (doc_id, tk, text, marks) → packs of the marked windows."""
    def run(batches):
        from pyspark import TaskContext
        part, count = TaskContext.get().partitionId(), 0
        pack = _Pack(_number(part, 0), buckets)
        for b in batches:
            for d, k, t, m in zip(*(b.column(i) for i in range(4))):
                w = _word_hashes(t.as_py())
                pos = np.unique(np.concatenate([_positions(x.as_py()) for x in m.values])) if m.values is not None else np.zeros(0, int)
                pos = pos[pos < len(w) - size + 1]
                if len(pos):
                    h = rolling(w, size, 2)[pos]
                    pack.add((_NO_DOC if d.as_py() is None else d.as_py(), k.as_py()), pos, h, np.zeros(len(pos), dtype=bool), len(pos))
                if pack.size >= PACK_WORDS:
                    yield from (_batch([r]) for r in pack.rows(False, True))
                    count += 1
                    pack = _Pack(_number(part, count), buckets)
        yield from (_batch([r]) for r in pack.rows(False, True))
    return run


def _later_windows(key, table):
    """Round 2, bucket side: which windows start earlier elsewhere."""
    if key[0].as_py() < 0:  # what the packs know themselves
        return table
    rows = table.to_pylist()
    h = np.concatenate([np.frombuffer(r["h"], "<u8") for r in rows])
    order = np.argsort(h)
    first = np.append(True, np.diff(h[order]) != 0)
    tied = order[~(first & np.append(first[1:], True))]
    ids, keys, poss = [], [], []
    for r in rows:
        doc, pos = _decode(r["counts"], r["pos"])
        tables = np.frombuffer(r["docs"], "<i8").reshape(2, -1)
        ids.append(tables[0][doc])
        keys.append(tables[1][doc])
        poss.append(pos)
    ids, keys, pos = np.concatenate(ids), np.concatenate(keys), np.concatenate(poss)
    tied = tied[np.lexsort((pos[tied], keys[tied], ids[tied], h[tied]))]
    later, _ = _after_first(h[tied], ids[tied], keys[tied], pos[tied])
    hit = np.zeros(len(h), dtype=bool)
    hit[tied[later]] = True
    return _replies(rows, hit, 8)


def _collect_later(key, table):
    """Round 2, back at the pack: later windows of all buckets per document."""
    ids, keys, poss = [], [], []
    for r in table.to_pylist():
        if not r["counts"]:
            continue
        doc, pos = _decode(r["counts"], r["pos"])
        if r["bucket"] < 0:
            tables = np.frombuffer(r["docs"][4 * r["n_docs"]:], "<i8").reshape(2, -1)
            doc = np.frombuffer(r["docs"][:4 * r["n_docs"]], "<i4")[doc]
        else:
            tables = np.frombuffer(r["docs"], "<i8").reshape(2, -1)
        ids.append(tables[0][doc])
        keys.append(tables[1][doc])
        poss.append(pos)
    none = np.zeros(0, dtype=np.int64)
    ids, keys, pos = (np.concatenate([none, *x]) for x in (ids, keys, poss))
    order = np.lexsort((pos, keys, ids))
    ids, keys, pos = ids[order], keys[order], pos[order]
    new = np.append(True, (np.diff(ids) != 0) | (np.diff(keys) != 0))[:len(ids)]
    return _marks(ids[new], keys[new], np.cumsum(new) - 1, pos)


def _strip(size: int):
    """(doc_id, tk, text, marks) → (doc_id, n_words, n_removed, kept)."""
    def run(batches):
        for b in batches:
            n_words, n_removed, kept = [], [], []
            for t, m in zip(b.column(2), b.column(3)):
                words = (t.as_py() or "").encode().split()
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                if m.values is not None and len(m.values):
                    starts = np.concatenate([_positions(x.as_py()) for x in m.values])
                    np.add.at(gone, starts, 1)
                    np.add.at(gone, starts + size, -1)
                gone = np.cumsum(gone)[:-1] > 0
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                kept.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g]) if gone.any() else b" ".join(words))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                              pa.array(kept, pa.binary())], ["doc_id", "n_words", "n_removed", "kept"])
    return run


# --------------------------------------------------------------- Spark stages

def _exchange(packs: DataFrame, buckets: int, answer, collect) -> DataFrame:
    """Packs → bucket tasks (``answer``) → back to the packs (``collect``):
    (doc_id, tk, marks), one row per document with marks. Rows of bucket -1 only
    pass through on the way there, dealt by their pack."""
    deal = F.when(F.col("bucket") < 0, -1 - F.pmod("pack", F.lit(buckets))).otherwise(F.col("bucket")).cast("int")

    def run(key, table):
        return answer(key, table.drop_columns(["deal"]))
    return (packs.withColumn("deal", deal).groupBy("deal").applyInArrow(run, _PACK)
            .groupBy("pack").applyInArrow(collect, _MARKS))


def _with_marks(texts: DataFrame, marks: DataFrame, how: str) -> DataFrame:
    m = marks.groupBy("doc_id", "tk").agg(F.collect_list("marks").alias("marks"))  # bounded by the document
    m = written(m.select(F.col("doc_id").alias("m_id"), F.col("tk").alias("m_tk"), "marks"), "repeat-marks")
    m = broadcast_if_small(m, 40 + 24 * F.size("marks") + F.aggregate("marks", F.lit(0), lambda n, x: n + F.octet_length(x)))
    return texts.join(m, (texts["order_id"] == m["m_id"]) & (texts["tk"] == m["m_tk"]), how)


def remove_repeats(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) per row of ``docs``; ``kept`` is the
    text of the remaining words, joined by single spaces, as UTF-8."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(max(4, total // BUCKET_BYTES))
    texts = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_DOC)).alias("order_id"),
                        text_key(F.col("text")).alias("tk"), "text")
    probes = texts.select("order_id", "tk", "text").mapInArrow(_probes(size, buckets), _PACK)
    hits = written(_exchange(probes, buckets, _answer_probes, _collect_pack(size)), "repeat-hits")
    marked = _with_marks(texts, hits, "inner").select("order_id", "tk", "text", "marks")
    windows = marked.mapInArrow(_candidates(size, buckets), _PACK)
    later = written(_exchange(windows, buckets, _later_windows, _collect_later), "repeat-windows")
    final = _with_marks(texts, later, "left").select("doc_id", "tk", "text", "marks")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return final.mapInArrow(_strip(size), f"doc_id {kind}, n_words long, n_removed long, kept binary")


def op4_substring_dedup(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
