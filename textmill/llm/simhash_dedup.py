"""SimHash near-duplicates by a self-join of the binary trie of fingerprints (operator 2).

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of
``shingle`` words with repeats (a shorter text is one shingle), XXH64 (UTF-8,
seed 42); a bit is 1 if it is set in more than half of the hashes. No words:
fingerprint zero. Documents whose fingerprints differ in at most ``max_bits``
bits are linked, and components of links share a ``component_id``.

Equal fingerprints are collapsed first (a partial aggregation), so groups of
copies cost one row. The distinct fingerprints form a binary trie, which is cut
at ``prefix`` bits into subtrees. Two subtrees meet in a task only if their
prefixes differ in at most ``max_bits`` bits; such a task walks down both
subtrees together, level by level. A node is a slice of the sorted
fingerprints, a pair of nodes carries the number of bits in which the paths
differ, and a pair is dropped as soon as that exceeds ``max_bits``. Pairs whose
nodes already lie in one component are dropped as well: they cannot change the
result, and this is what keeps a dense group from costing all its pairs. A task
returns a spanning forest of its links (a row per fingerprint at most), never
the pairs. The forests are joined into components by label propagation with
pointer jumping on DataFrames, cut by written tables; nothing but counts
reaches the driver.

Subtree size: the prefix grows with the number of distinct fingerprints, so
that subtrees hold about ``SUBTREE`` of them. A ball of radius 3 around a
fingerprint has at most 43,745 members, so near copies cannot overfill one.

Defined cases: a null text has no words; a null ``doc_id`` is never a
``component_id`` unless its component has no other (then null); repeated rows
stay; an empty table gives an empty result; in ``drop_near_duplicates`` other
columns pass through.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import TEXT_ROWS, text_key, written
from textmill.operators.joins import hot_key_join

SHINGLE = 3
MAX_BITS = 3
SUBTREE = 16_384
LEAF = 64          # node pairs of at most this many combinations are compared directly
FRONT = 200_000    # node pairs handled at once


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(g, 42) for g in grams], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 65_536):
        part = h[at:at + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, tk, fp) per document; ``fp`` holds the 64 bits as a signed long."""
    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], ["doc_id", "tk", "fp"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_key(F.col("text")).alias("tk"), "text").mapInArrow(run, f"doc_id {kind}, tk long, fp long")


# ------------------------------------------------------------- trie traversal

def _merge(labels: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Join the components of ``u[i]`` and ``v[i]``; labels are least members."""
    while True:
        lu, lv = labels[u], labels[v]
        differ = lu != lv
        if not differ.any():
            return labels
        u, v, lu, lv = u[differ], v[differ], lu[differ], lv[differ]
        np.minimum.at(labels, np.maximum(lu, lv), np.minimum(lu, lv))
        while True:
            nxt = labels[labels]
            if (nxt == labels).all():
                break
            labels = nxt


class _Trie:
    """Sorted fingerprints; a node is (first, end) of those that share a prefix."""

    def __init__(self, fps: np.ndarray, offset: int):
        self.fps, self.offset, self._ones = fps, offset, {}

    def children(self, lo, hi, depth):
        """End of the 0-child (= start of the 1-child) of every node."""
        if depth not in self._ones:
            bit = (self.fps >> np.uint64(63 - depth)) & np.uint64(1)
            self._ones[depth] = np.concatenate([[0], np.cumsum(bit, dtype=np.int64)])
        ones = self._ones[depth]
        return hi - (ones[hi] - ones[lo])


def trie_links(a: np.ndarray, b: np.ndarray | None, prefix: int, differing: int, max_bits: int):
    """Spanning forest (members, roots) of all links between ``a`` and ``b``, or
    within ``a`` if ``b`` is None. Both are sorted and share their prefixes."""
    same = b is None
    ta = _Trie(a, 0)
    tb = ta if same else _Trie(b, len(a))
    every = a if same else np.concatenate([a, b])
    labels = np.arange(len(every))
    zero = np.zeros(1, dtype=np.int64)
    stack = [(prefix, zero, zero + len(a), zero, zero + len(tb.fps), zero + differing)]
    while stack:
        depth, al, ah, bl, bh, err = stack.pop()
        if len(al) > FRONT:
            half = len(al) // 2
            stack.append((depth, *(x[half:] for x in (al, ah, bl, bh, err))))
            al, ah, bl, bh, err = (x[:half] for x in (al, ah, bl, bh, err))
            stack.append((depth, al, ah, bl, bh, err))
            continue
        # nodes that already form one component need no further visit
        steps = np.concatenate([[0], np.cumsum(labels[1:] != labels[:-1])])
        a0, a1, b0, b1 = al, ah - 1, bl + tb.offset, bh - 1 + tb.offset
        joined = (steps[a0] == steps[a1]) & (steps[b0] == steps[b1]) & (labels[a0] == labels[b0])
        open_ = ~joined
        al, ah, bl, bh, err = (x[open_] for x in (al, ah, bl, bh, err))
        leaf = ((ah - al) * (bh - bl) <= LEAF) | (depth >= 64)
        if leaf.any():
            labels = _merge(labels, *_compare(ta, tb, al[leaf], ah[leaf], bl[leaf], bh[leaf], max_bits))
        inner = ~leaf
        if not inner.any():
            continue
        al, ah, bl, bh, err = (x[inner] for x in (al, ah, bl, bh, err))
        am, bm = ta.children(al, ah, depth), tb.children(bl, bh, depth)
        self_pair = same & (al == bl) & (ah == bh)
        parts = []
        for x0, x1, y0, y1, cost, skip in ((al, am, bl, bm, 0, False), (am, ah, bm, bh, 0, False),
                                           (al, am, bm, bh, 1, False), (am, ah, bl, bm, 1, True)):
            ok = (x1 > x0) & (y1 > y0) & (err + cost <= max_bits)
            if skip:  # of a node paired with itself the mixed pair is visited once
                ok &= ~self_pair
            parts.append((x0[ok], x1[ok], y0[ok], y1[ok], err[ok] + cost))
        stack.append((depth + 1, *(np.concatenate(x) for x in zip(*parts))))
    members = np.nonzero(labels != np.arange(len(labels)))[0]
    return every[members], every[labels[members]]


def _compare(ta, tb, al, ah, bl, bh, max_bits):
    """Index pairs (into a ++ b) of linked fingerprints in small node pairs."""
    us, vs = [], []
    for at in range(0, len(al), 50_000):
        w = slice(at, at + 50_000)
        nb = bh[w] - bl[w]
        n = (ah[w] - al[w]) * nb
        pair = np.repeat(np.arange(len(n)), n)
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        i, j = al[w][pair] + k // nb[pair], bl[w][pair] + k % nb[pair]
        near = np.bitwise_count(ta.fps[i] ^ tb.fps[j]) <= max_bits
        us.append(i[near])
        vs.append(j[near] + tb.offset)
    return (np.concatenate(us), np.concatenate(vs)) if us else (np.zeros(0, int), np.zeros(0, int))


# --------------------------------------------------------------- Spark stages

def links(distinct: DataFrame, max_bits: int = MAX_BITS, n: int | None = None) -> DataFrame:
    """(u, v): a forest of links between the distinct fingerprints ``fp``."""
    n = distinct.count() if n is None else n
    prefix = min(24, max(2, math.ceil(math.log2(max(n, 1) / SUBTREE)) if n > SUBTREE else 2))
    head = F.shiftrightunsigned("fp", 64 - prefix)
    masks = [m for m in range(1 << prefix) if m.bit_count() <= max_bits] if prefix <= 8 else _masks(prefix, max_bits)
    meet = F.explode(F.array(*[F.lit(m) for m in masks])).alias("mask")
    dealt = (distinct.select("fp", head.alias("head"), meet)
             .select("fp", F.least("head", F.col("head").bitwiseXOR(F.col("mask"))).alias("p"), "mask"))

    def walk(key, table):
        p, mask = key[0].as_py(), key[1].as_py()
        fps = np.sort(table.column("fp").to_numpy().view(np.uint64))
        if mask == 0:
            u, v = trie_links(fps, None, prefix, 0, max_bits)
        else:
            cut = np.searchsorted(fps >> np.uint64(64 - prefix), np.uint64(p), side="right")
            if cut == 0 or cut == len(fps):
                return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
            u, v = trie_links(fps[:cut], fps[cut:], prefix, mask.bit_count(), max_bits)
        return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})

    return dealt.groupBy("p", "mask").applyInArrow(walk, "u long, v long")


def _masks(prefix: int, max_bits: int) -> list[int]:
    from itertools import combinations
    return [sum(1 << i for i in c) for k in range(max_bits + 1) for c in combinations(range(prefix), k)]


def components(edges: DataFrame) -> DataFrame:
    """(fp, root) for every end of an edge. Each round takes the least label among
    the neighbours, then the label of that label, until nothing changes."""
    both = written(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "simhash-edges")
    labels = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("c")), "simhash-labels")
    while True:
        near = (both.join(labels.select(F.col("u").alias("v"), F.col("c").alias("nc")), "v")
                .groupBy("u").agg(F.min("nc").alias("nc")))
        nxt = labels.join(near, "u").select("u", "c", F.least("c", "nc").alias("m"))
        jump = labels.select(F.col("u").alias("m"), F.col("c").alias("mc"))
        nxt = written(nxt.join(jump, "m").select("u", F.col("c").alias("old"), F.least("m", "mc").alias("c")), "simhash-labels")
        changed = nxt.where(F.col("old") != F.col("c")).limit(1).count()
        labels = nxt.select("u", "c")
        if not changed:
            return labels.select(F.col("u").alias("fp"), F.col("c").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, tk, fp, root, component_id) per row of ``docs``; ``root`` is the
    component's own fingerprint, so it tells components of one id apart."""
    prints = written(fingerprints(docs.select("doc_id", "text"), shingle), "simhash-prints", TEXT_ROWS)
    per_fp = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "simhash-distinct")
    roots = components(links(per_fp.select("fp"), max_bits))
    linked = per_fp.join(roots, "fp")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    moved = linked.join(least, "root").select("fp", "root", F.col("component_id").alias("cid"))
    per_fp_id = per_fp.select("fp", "least").join(moved, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNotNull(), F.col("cid")).otherwise(F.col("least")).alias("component_id"))
    per_fp_id = written(per_fp_id, "simhash-ids")
    return hot_key_join(prints, per_fp_id, "fp", per_fp.select("fp", "n")).select("doc_id", "tk", "fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component stays: the one with the smallest
    ``doc_id`` (rows that repeat it: one of them; no ids at all: one of them).
    Components are told apart by their root, since unlike ones can share a null
    or repeated id. Columns as they came."""
    ids = near_duplicates(docs, shingle, max_bits)
    first = (ids.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
             .groupBy("root", "component_id").agg(F.min("tk").alias("_sd_tk"))
             .select(F.col("component_id").alias("_sd_id"), "_sd_tk"))
    kept = docs.withColumn("_sd_key", text_key(F.col("text")))
    out = kept.join(first, kept["doc_id"].eqNullSafe(first["_sd_id"]) & (kept["_sd_key"] == first["_sd_tk"]), "left_semi")
    return out.dropDuplicates(["doc_id", "_sd_key"]).select(*docs.columns)


def op2_simhash_dedup(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
