"""Jaccard links between sets of word n-grams by a grouped prefix join (operator 12).

A document's set: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, distinct shingles
of ``shingle`` words (fewer words: the whole sequence as one; no words: empty and
linked with nothing). Two sets link when ``100 * common >= percent * union``.
Shingles are told apart by 64 hash bits, sets by 128 bits over their shingles.

Order. All sets sort their shingles by one global order, rare ones first. The
order is (occurrences of the shingle's hash bucket, hash): a table of ``COUNTERS``
counters over the whole corpus, so nothing that is sent to the tasks grows, and
any number of counters gives right results.

Groups. Documents with equal sets are one set. Sets with the same size and the
same prefix (the first ``n - ceil(percent * n / 100) + 1`` shingles, which two
linked sets never share none of) are one group, and only groups are joined on the
shingles of their prefixes. Their postings travel packed, once per group and map
task, to the bucket of their shingle; lists with one group go there. Group pairs must pass
the size filter and the positional filter (at the common shingle both sets must
have enough shingles left), and what passes is expanded to members and verified
on the whole sets.

Only components are asked for, so pairs that cannot change them are not made:

1. every group is paired with one leader, the least by hash among the leaders of
   its lists, and members with the first member of their group: a row per set;
2. further rounds pair every group with another leader that lies in another
   component, as long as one pair in 25 links, so that a cluster in which only
   some pairs link falls together as well;
3. in rounds like Boruvka's every group is paired with the group of another component
   whose bitmap is nearest to its own, looked for where the lists meet, as long as one
   pair in 25 links: a row per group, and what is joined needs no other pair;
4. all other group pairs are made that still lie in different components: near misses
   of which no chain of links is known. A list whose groups are all in one component
   goes as a whole. Long lists are compared block by block.

So a cluster of near copies costs its size, not its square, and no link between
different texts is lost: a pair left out is already connected.

Parities. Every set has a bitmap of 1 to 2 bits per shingle: bit ``i`` tells whether an
odd number of its shingles hash to ``i``. Two bitmaps differ in no more bits than the sets
do in shingles, so they bound the overlap from above at a fortieth of the bytes. Set pairs
are filtered by them before their sets are read, and group pairs where their lists meet
(groups of one set; bitmaps of half the length). A longer bitmap is folded to the shorter
one's length.

Verification reads the sets of the pairs that are left. A set travels
once per pair as the partner and once per ``CHUNK_BYTES`` as the leader.

Defined cases: a null text has no words; a null ``doc_id`` is a ``component_id``
only if its component has no other; documents without words are components of
their own; repeated rows stay and are linked; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import broadcast_if_small, deleted, text_key, written
from textmill.llm.simhash_dedup import components
from textmill.llm.substring_dedup import _IS_SPACE, _mix, _word_hashes, rolling
from textmill.operators.joins import hot_key_join

SHINGLE = 5
PERCENT = 80
COUNTERS = 1 << 18          # counters of the shingle order
POSTS = 1_000_000           # postings packed or met in one task, about
HOT_LIST = 50_000           # postings of one shingle handled in one task, about
SHORT_LIST = 256            # lists up to this length drop groups that fit no other
BLOCK = 2_048               # groups of a long list compared with as many others
CHUNK_BYTES = 8 << 20       # sets verified at once
LEADER_ROUNDS = 8           # rounds with one leader per group, at most; any number is right
NEAREST_ROUNDS = 8          # rounds with the nearest partner per group, likewise
MARK_BYTES = 4_096          # longer bitmaps are not sent to the lists, only to the pairs
_TEXT = 4 << 20             # characters hashed at once
_PAIRS = 2_000_000          # group pairs looked at at once
_SEED = 11


# ------------------------------------------------------------- task helpers

def shingle_hashes(texts: list[str | None], shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every shingle of some texts, repeats included."""
    parts = [(t or "").encode().lower() for t in texts]  # bytes: A-Z only
    raw = b"\n".join(parts)
    inside = np.concatenate([[False], ~_IS_SPACE[np.frombuffer(raw, dtype=np.uint8)]])
    starts = np.nonzero(inside[1:] & ~inside[:-1])[0]
    begin = np.cumsum([0] + [len(p) + 1 for p in parts])
    first = np.searchsorted(starts, begin)               # words before each text
    n = np.diff(first)
    words = _word_hashes(raw.decode())
    row = np.repeat(np.arange(len(parts)), n)
    h = rolling(words, shingle, _SEED)
    whole = row[:len(h)] == row[shingle - 1:] if len(h) else np.zeros(0, dtype=bool)
    short = np.nonzero((n > 0) & (n < shingle))[0]
    extra = [rolling(words[first[r]:first[r + 1]], int(n[r]), _SEED + int(n[r])) for r in short]
    return (np.concatenate([row[:len(h)][whole], short]),
            np.concatenate([h[whole], *extra]) if extra else h[whole])


def _sets(texts, shingle):
    """(row, hash) sorted and distinct."""
    row, h = shingle_hashes(texts, shingle)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.append(True, (np.diff(row) != 0) | (h[1:] != h[:-1]))[:len(row)]
    return row[new], h[new]


def _slices(column, limit=_TEXT):
    """(first, texts): stretches of a column with at most about ``limit`` characters."""
    texts, first, size = [], 0, 0
    for i, t in enumerate(column):
        t = t.as_py()
        if texts and size + len(t or "") > limit:
            yield first, texts
            texts, first, size = [], i, 0
        texts.append(t)
        size += len(t or "")
    if texts:
        yield first, texts


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(24)) % np.uint64(buckets)).astype(np.int64)


def prefix_length(n, percent: int):
    return n - (percent * n + 99) // 100 + 1


def linked(common, n_a, n_b, percent: int):
    """``100 * common >= percent * union`` in whole numbers."""
    return (100 + percent) * common >= percent * (n_a + n_b)


def parities(h: np.ndarray) -> bytes:
    """Bitmap of a set: the parity of the shingles per bit."""
    bits = max(64, 1 << max(len(h) - 1, 0).bit_length())
    at = (h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) & np.uint64(bits - 1)
    return np.packbits((np.bincount(at.astype(np.int64), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def _folded(marks: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps (last axis: 64-bit words) folded to ``width`` words."""
    while marks.shape[-1] > width:
        half = marks.shape[-1] // 2
        marks = marks[..., :half] ^ marks[..., half:]
    return marks


def may_link(x: bytes, y: bytes, n_x: int, n_y: int, percent: int) -> bool:
    """False only if the bitmaps prove that two sets do not link."""
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    width = min(len(x), len(y))
    differ = int(np.bitwise_count(_folded(x, width) ^ _folded(y, width)).sum())
    return linked((n_x + n_y - differ) // 2, n_x, n_y, percent)


def differing(marks, n, i, j) -> np.ndarray:
    """In how many shingles the sets of the index pairs (i, j) differ at least; ``marks``
    holds a bitmap or None per row."""
    found = np.abs(n[i] - n[j])
    words = np.array([0 if m is None else len(m) // 8 for m in marks], dtype=np.int64)
    width = np.minimum(words[i], words[j])
    for w in np.unique(width[width > 0]).tolist():
        at = np.nonzero(width == w)[0]
        rows, place = np.unique(np.concatenate([i[at], j[at]]), return_inverse=True)
        table = np.empty((len(rows), w), dtype=np.uint64)
        for k, r in enumerate(rows.tolist()):
            table[k] = _folded(np.frombuffer(marks[r], np.uint64), w)
        a, b = place[:len(at)], place[len(at):]
        step = max(1, (4 << 20) // (8 * w))
        for s in range(0, len(at), step):
            part = at[s:s + step]
            apart = np.bitwise_count(table[a[s:s + step]] ^ table[b[s:s + step]]).sum(axis=1, dtype=np.int64)
            found[part] = apart
    return found


def marked_pairs(marks, n, i, j, percent: int) -> np.ndarray:
    """``may_link`` for the index pairs (i, j) of sets that pass the size filter."""
    return linked((n[i] + n[j] - differing(marks, n, i, j)) // 2, n[i], n[j], percent)


def list_pairs(token, n, pos, low, high, percent: int, side=None):
    """Index pairs of rows (sorted by ``token``) that share a token, pass the size
    and the positional filter and are not in one component. ``side`` tells the two
    blocks of a list apart; then only pairs across are taken."""
    end = np.searchsorted(token, token, side="right")
    mates = end - np.arange(len(token)) - 1
    upto = np.cumsum(mates)
    at = 0
    while at < len(token):
        last = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + _PAIRS, side="right")))
        m = mates[at:last]
        i = np.repeat(np.arange(at, last), m)
        j = np.arange(len(i)) - np.repeat(np.cumsum(m) - m, m) + i + 1
        left = np.minimum(n[i] - pos[i], n[j] - pos[j])
        ok = linked(left, n[i], n[j], percent) & ~((low[i] == high[i]) & (low[j] == high[j]) & (low[i] == low[j]))
        ok &= 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
        if side is not None:
            ok &= side[i] != side[j]
        yield i[ok], j[ok]
        at = last


# --------------------------------------------------------------- Spark stages

def shingle_counts(texts: DataFrame, shingle: int, buckets: int) -> np.ndarray:
    """Occurrences of the shingles of each hash bucket."""
    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for _, part in _slices(b.column(0)):
                total += np.bincount(_bucket(shingle_hashes(part, shingle)[1], buckets), minlength=buckets)
        used = np.nonzero(total)[0]
        for at in range(0, len(used), 65_536):
            part = used[at:at + 65_536]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["bucket", "n"])
    rows = (texts.select("text").mapInArrow(run, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(buckets, dtype=np.int64)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def set_rows(docs: DataFrame, counts, shingle: int, percent: int) -> DataFrame:
    """(doc_id, tk, n, dig, gid, prefix, mark, short) per document; ``counts`` is a broadcast."""
    def run(batches):
        freq = counts.value
        for b in batches:
            for first, texts in _slices(b.column(2)):
                row, h = _sets(texts, shingle)
                cut = np.searchsorted(row, np.arange(len(texts) + 1))
                order = np.lexsort((h, freq[_bucket(h, len(freq))], row))
                ranked = h[order]
                n = np.diff(cut)
                dig, gid, prefix, mark, short = [], [], [], [], []
                for a, e in zip(cut[:-1].tolist(), cut[1:].tolist()):
                    own = ranked[a:a + prefix_length(e - a, percent)].tobytes() if e > a else b""
                    dig.append(xxhash.xxh3_128_digest(h[a:e].tobytes()))
                    gid.append(xxhash.xxh3_64_intdigest(own, e - a))
                    prefix.append(own)
                    mark.append(parities(h[a:e]))
                    short.append(_folded(np.frombuffer(mark[-1], np.uint64), max(1, len(mark[-1]) // 16)).tobytes())
                here = b.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [here.column(0), here.column(1), pa.array(n, pa.int64()), pa.array(dig, pa.binary()),
                     pa.array(np.array(gid, dtype=np.uint64).view(np.int64)), pa.array(prefix, pa.binary()), pa.array(mark, pa.binary()),
                     pa.array(short, pa.binary())],
                    ["doc_id", "tk", "n", "dig", "gid", "prefix", "mark", "short"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_key(F.col("text")).alias("tk"), "text").mapInArrow(
        run, f"doc_id {kind}, tk long, n long, dig binary, gid long, prefix binary, mark binary, short binary")


_LISTS = "token long, gid long, n int, pos int, h long, leader long"


def _planes(values: np.ndarray) -> bytes:
    """64-bit numbers as byte planes: the high ones, mostly zero, compress away."""
    return np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).reshape(-1).view("<i8")


def _dealt(token, gid, freq, buckets):
    """Bucket of every posting; a token that may be hot is spread by group."""
    salts = 1 + freq[_bucket(token, len(freq))] // HOT_LIST
    return ((token >> np.uint64(8)) + (gid.view(np.uint64) % salts.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(buckets)


def _pack(gid, n, prefix, freq, buckets):
    """Rows (bucket, tokens, counts, gids, ns, pos) of some groups, each taken once."""
    gid, first = np.unique(np.concatenate(gid), return_index=True)
    n = np.concatenate(n)[first]
    data = [prefix[i] for i in first.tolist()]
    sizes = np.array([len(d) // 8 for d in data], dtype=np.int64)
    token = np.frombuffer(b"".join(data), dtype=np.uint64)
    own = np.repeat(np.arange(len(gid)), sizes)
    pos = np.arange(len(token)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    bucket = _dealt(token, gid[own], freq, buckets)
    by = np.argsort(bucket, kind="stable")
    cuts = np.nonzero(np.append(True, np.diff(bucket[by]) != 0))[0] if len(by) else []
    for a, e in zip(cuts, np.append(cuts[1:], len(by))):
        rows = by[a:e]
        used, counts = np.unique(own[rows], return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(bucket[rows[0]])], pa.int32())]
            + [pa.array([x], pa.binary()) for x in (token[rows].tobytes(), _planes(counts), gid[used].tobytes(), _planes(n[used]), _planes(pos[rows]))],
            ["bucket", "token", "counts", "gid", "n", "pos"])


def _met(table: pa.Table, freq, percent: int):
    """A bucket's postings → its lists, and for every group its least leader here."""
    counts = [_unplanes(x.as_py()) for x in table.column("counts")]
    token = np.concatenate([np.frombuffer(x.as_py(), dtype=np.uint64) for x in table.column("token")])
    pos = np.concatenate([_unplanes(x.as_py()) for x in table.column("pos")])
    gid = np.concatenate([np.repeat(np.frombuffer(x.as_py(), dtype=np.int64), c) for x, c in zip(table.column("gid"), counts)])
    n = np.concatenate([np.repeat(_unplanes(x.as_py()), c) for x, c in zip(table.column("n"), counts)])
    h = _mix(gid.view(np.uint64).copy())
    by = np.lexsort((h, token))
    token, gid, n, pos, h = (x[by] for x in (token, gid, n, pos, h))
    once = np.append(True, (token[1:] != token[:-1]) | (gid[1:] != gid[:-1]))[:len(token)]
    token, gid, n, pos, h = (x[once] for x in (token, gid, n, pos, h))
    first = np.nonzero(np.append(True, token[1:] != token[:-1]))[0] if len(token) else np.zeros(0, dtype=np.int64)
    size = np.repeat(np.diff(np.append(first, len(token))), np.diff(np.append(first, len(token))))
    keep = (size > 1) | (freq[_bucket(token, len(freq))] >= HOT_LIST)
    short = np.nonzero((size > 1) & (size <= SHORT_LIST))[0]
    fits = np.zeros(len(token), dtype=bool)
    apart = np.arange(len(short))
    for i, j in list_pairs(token[short], n[short], pos[short], apart, apart, percent):
        fits[short[i]] = fits[short[j]] = True
    keep[short] = fits[short]
    lead = np.repeat(first, np.diff(np.append(first, len(token))))
    left = np.minimum(n - pos, n[lead] - pos[lead])
    good = np.nonzero((gid != gid[lead]) & linked(left, n, n[lead], percent)
                      & (100 * np.minimum(n, n[lead]) >= percent * np.maximum(n, n[lead])))[0]
    good = good[np.lexsort((h[lead[good]], gid[good]))]
    good = good[np.append(True, np.diff(gid[good]) != 0)[:len(good)]]
    a, b = int(keep.sum()), len(good)
    none = lambda k, t: pa.nulls(k, t)
    yield pa.RecordBatch.from_arrays(
        [pa.array(token[keep].view(np.int64)), pa.array(gid[keep]), pa.array(n[keep], pa.int32()), pa.array(pos[keep], pa.int32()),
         none(a, pa.int64()), none(a, pa.int64())], ["token", "gid", "n", "pos", "h", "leader"])
    yield pa.RecordBatch.from_arrays(
        [none(b, pa.int64()), pa.array(gid[good]), none(b, pa.int32()), none(b, pa.int32()),
         pa.array(h[lead[good]].view(np.int64)), pa.array(gid[lead[good]])], ["token", "gid", "n", "pos", "h", "leader"])


def met_lists(rows: DataFrame, counts, percent: int) -> DataFrame:
    """Rows (token, gid, n, pos) of the lists with two groups or more that fit each
    other, and rows (gid, h, leader): the leader of a list is its least group by hash."""
    total = rows.agg(F.sum(F.octet_length("prefix"))).first()[0] or 0
    buckets = int(max(8, total // (8 * POSTS)))

    def pack(batches):
        freq = counts.value
        gid, n, prefix, size = [], [], [], 0
        for b in batches:
            gid.append(b.column(0).to_numpy(zero_copy_only=False))
            n.append(b.column(1).to_numpy(zero_copy_only=False))
            prefix += b.column(2).to_pylist()
            size += sum(map(len, prefix[-b.num_rows:]))
            if size >= 8 * POSTS:
                yield from _pack(gid, n, prefix, freq, buckets)
                gid, n, prefix, size = [], [], [], 0
        if gid:
            yield from _pack(gid, n, prefix, freq, buckets)

    def meet(key, table):
        return pa.Table.from_batches(_met(table, counts.value, percent))
    packed = rows.select("gid", "n", "prefix").mapInArrow(
        pack, "bucket int, token binary, counts binary, gid binary, n binary, pos binary")
    return packed.groupBy("bucket").applyInArrow(meet, _LISTS)


def next_leaders(lists: DataFrame, labels: DataFrame, seed: int, percent: int) -> DataFrame:
    """(gid, leader): for every group one leader of its lists, any by hash, that may
    link and lies in another component; a list's leader is any of its groups by hash.
    As groups draw different partners, a few rounds join a cluster of which only some
    pairs link."""
    named = lists.join(broadcast_if_small(labels, 24), "gid")
    lead = (named.groupBy("token").agg(F.min(F.struct(F.xxhash64("gid", "token", F.lit(seed)).alias("h"), "gid", "n", "pos", "low", "high")).alias("lead"),
                                       F.min("low").alias("lo"), F.max("high").alias("hi"))
            .where(F.col("lo") != F.col("hi")).select("token", "lead"))
    left = F.least(F.col("n") - F.col("pos"), F.col("lead.n") - F.col("lead.pos"))
    sizes = 100 * F.least("n", "lead.n") >= percent * F.greatest("n", "lead.n")
    apart = (F.col("low") != F.col("lead.low")) | (F.col("high") != F.col("lead.high")) | (F.col("low") != F.col("high"))
    fit = named.join(lead, "token").where((F.col("gid") != F.col("lead.gid")) & sizes & apart
                                          & ((100 + percent) * left >= percent * (F.col("n") + F.col("lead.n"))))
    pick = F.struct(F.xxhash64("gid", "lead.gid", F.lit(seed)).alias("h"), F.col("lead.gid").alias("leader"))
    return fit.groupBy("gid").agg(F.min(pick).alias("m")).select("gid", F.col("m.leader").alias("leader"))


def open_lists(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of the lists whose groups do not all lie in one component, with their block.
    ``labels`` (gid, low, high): least and largest component of a group."""
    named = lists.join(broadcast_if_small(labels, 24), "gid").repartition("token")
    mixed = (named.groupBy("token").agg(F.min("low").alias("lo"), F.max("high").alias("hi"), F.count(F.lit(1)).alias("m"))
             .where(F.col("lo") != F.col("hi")).select("token", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")))
    return written(named.join(mixed, "token").withColumn("block", F.pmod(F.xxhash64("gid"), F.col("blocks")).cast("int")), "jaccard-open")


def group_marks(opened: DataFrame, sets: DataFrame) -> DataFrame:
    """(gid, mark): the bitmaps of the groups of one of the ``sets``."""
    own = written(opened.select("gid").distinct(), "jaccard-open-groups")
    fits = F.octet_length("short") <= MARK_BYTES
    return written(sets.select("gid", F.when(fits, F.col("short")).alias("mark")).join(broadcast_if_small(own, 16), "gid", "left_semi").groupBy("gid")
                   .agg(F.count(F.lit(1)).alias("m"), F.first("mark").alias("mark")).where("m = 1").select("gid", "mark"), "jaccard-marks")


def compared_lists(opened: DataFrame, marks: DataFrame, compare, schema: str) -> DataFrame:
    """``compare(table)`` for stretches of whole lists, long ones block by block."""
    named = opened.join(broadcast_if_small(marks, F.octet_length("mark") + 32), "gid", "left")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = named.select("*", other.alias("other")).select(
        "token", "gid", "n", "pos", "low", "high", "mark", "block", F.least("block", "other").alias("b1"),
        F.greatest("block", "other").alias("b2"))

    def run(batches):
        # one stretch of lists at a time: rows come sorted, a list is never cut
        kept = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([kept, t]) if kept is not None else t
            last = _last_list(t)
            if last:
                yield from compare(t.slice(0, last))
            kept = t.slice(last)
        if kept is not None and len(kept):
            yield from compare(kept)

    return (dealt.repartition("token", "b1", "b2").sortWithinPartitions("token", "b1", "b2")
            .select("token", "b1", "b2", "block", "gid", "n", "pos", "low", "high", "mark").mapInArrow(run, schema))


def nearest_pairs(opened: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """(g, h): for every group that has one the most likely partner in another component."""
    found = compared_lists(opened, marks, lambda t: _nearest(t, percent), "g long, h long, near long")
    return found.groupBy("g").agg(F.max(F.struct("near", "h")).alias("m")).select("g", F.col("m.h").alias("h"))


def open_pairs(opened: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """(g, h): group pairs of all lists that pass the filters and do not lie in one
    component. Groups of one set take its bitmap along."""
    found = compared_lists(opened, marks, lambda t: _filtered(t, percent), "g long, h long, n_g long, n_h long, p_g long, p_h long")
    # the common tokens that passed are the first ones, so this bounds the overlap
    bound = F.col("common") + F.least(F.col("n_g") - 1 - F.col("p_g"), F.col("n_h") - 1 - F.col("p_h"))
    return (found.groupBy("g", "h", "n_g", "n_h").agg(F.count(F.lit(1)).alias("common"), F.max("p_g").alias("p_g"), F.max("p_h").alias("p_h"))
            .where((100 + percent) * bound >= percent * (F.col("n_g") + F.col("n_h"))).select("g", "h"))


def _column(table, name):
    return table.column(name).to_numpy().astype(np.int64, copy=False)


def _last_list(table) -> int:
    """Rows before the last (token, b1, b2) of a sorted table."""
    if not len(table):
        return 0
    change = np.zeros(len(table) - 1, dtype=bool)
    for name in ("token", "b1", "b2"):
        change |= np.diff(_column(table, name)) != 0
    at = np.nonzero(change)[0]
    return int(at[-1]) + 1 if len(at) else 0


def _met_pairs(table, percent):
    """Index pairs (i, j) of a table's lists that pass all filters, the most shingles they
    may share, and the columns gid, n, pos."""
    token, b1, b2, block, gid, n, pos, low, high = (_column(table, c) for c in (
        "token", "b1", "b2", "block", "gid", "n", "pos", "low", "high"))
    new = np.append(True, (np.diff(token) != 0) | (np.diff(b1) != 0) | (np.diff(b2) != 0))[:len(token)]
    number = np.cumsum(new)
    # within one block all pairs, of two blocks those across
    side = np.where(b1 == b2, np.arange(len(token)), block)
    marks = table.column("mark").to_pylist()
    for i, j in list_pairs(number, n, pos, low, high, percent, side):
        common = (n[i] + n[j] - differing(marks, n, i, j)) // 2
        may = linked(common, n[i], n[j], percent)
        yield i[may], j[may], common[may], (gid, n, pos)


def _filtered(table, percent):
    for i, j, _, (gid, n, pos) in _met_pairs(table, percent):
        swap = gid[i] > gid[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (gid[i], gid[j], n[i], n[j], pos[i], pos[j])],
                                         ["g", "h", "n_g", "n_h", "p_g", "p_h"])


def _nearest(table, percent):
    """For every group of the lists its nearest partner there: a row per group at most."""
    gid = _column(table, "gid")
    near, mate = np.full(len(table), -1, dtype=np.int64), np.zeros(len(table), dtype=np.int64)
    for i, j, common, (_, n, _) in _met_pairs(table, percent):
        likeness = np.tile(1_000_000 * common // (n[i] + n[j] - common), 2)
        row, other = np.concatenate([i, j]), np.concatenate([j, i])
        by = np.lexsort((likeness, row))
        by = by[np.append(row[by][1:] != row[by][:-1], True)[:len(by)]]     # the last one of each row
        by = by[likeness[by] > near[row[by]]]
        near[row[by]], mate[row[by]] = likeness[by], other[by]
    by = np.lexsort((near, gid))
    by = by[np.append(gid[by][1:] != gid[by][:-1], True)[:len(by)]]
    by = by[near[by] >= 0]
    yield pa.RecordBatch.from_arrays([pa.array(gid[by]), pa.array(gid[mate[by]]), pa.array(near[by])], ["g", "h", "near"])


def whole_sets(docs: DataFrame, sets: DataFrame, pairs: DataFrame, shingle: int) -> DataFrame:
    """(dig, n, h): sorted shingle hashes of the sets in ``pairs`` (a, b); ``sets``
    names one of the documents that have a set (rep)."""
    wanted = pairs.select(F.col("a").alias("dig")).unionByName(pairs.select(F.col("b").alias("dig"))).distinct()
    keys = written(sets.join(wanted, "dig").select(F.col("rep.doc_id").alias("w_id"), F.col("rep.tk").alias("w_tk")), "jaccard-wanted")
    source = docs.select("doc_id", text_key(F.col("text")).alias("tk"), "text")
    source = source.join(broadcast_if_small(keys, 40), source["doc_id"].eqNullSafe(keys["w_id"]) & (source["tk"] == keys["w_tk"]), "left_semi")

    def run(batches):
        for b in batches:
            for _, texts in _slices(b.column(0)):
                row, h = _sets(texts, shingle)
                cut = np.searchsorted(row, np.arange(len(texts) + 1))
                data = [h[a:e].tobytes() for a, e in zip(cut[:-1], cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([xxhash.xxh3_128_digest(d) for d in data], pa.binary()), pa.array(np.diff(cut), pa.int64()),
                     pa.array(data, pa.binary())], ["dig", "n", "h"])
    return written(source.select("text").mapInArrow(run, "dig binary, n long, h binary").dropDuplicates(["dig"]), "jaccard-sets")


def compared(pairs: DataFrame, sets: DataFrame, test) -> DataFrame:
    """The pairs (a, b) for which ``test(h_a, h_b, n_a, n_b)`` holds; ``sets`` gives
    (dig, n, h, bytes), bytes about the length of h. What belongs to ``a`` is sent once
    per chunk of its partners, so that a leader of very many is spread over tasks."""
    of = sets.select(F.col("dig").alias("a"), F.col("n").alias("n_a"), F.col("bytes").alias("bytes_a"))
    # partners have about the size of ``a``
    chunks = F.ceil(F.col("c") * F.col("bytes_a") * 5 / 4 / CHUNK_BYTES).cast("int")
    degree = written(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("c")).join(of, "a")
                     .select("a", "c", "n_a", "bytes_a", F.greatest(chunks, F.lit(1)).alias("chunks")), "jaccard-degrees")
    total = degree.agg(F.sum(F.col("c") * F.col("bytes_a"))).first()[0] or 0
    buckets = int(max(8, total // CHUNK_BYTES))
    deal = F.pmod(F.xxhash64("a", "chunk"), F.lit(buckets)).cast("int").alias("deal")
    left = (degree.select("a", "n_a", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
            .join(sets.select(F.col("dig").alias("a"), F.col("h").alias("h_a")), "a")
            .select(deal, F.col("a").alias("leader"), "n_a", "h_a"))
    right = (pairs.join(degree.select("a", "chunks"), "a")
             .withColumn("chunk", F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int"))
             .join(sets.select(F.col("dig").alias("b"), F.col("n").alias("n_b"), F.col("h").alias("h_b")), "b")
             .select(deal, "a", "b", "n_b", "h_b"))

    def run(left, right):
        own = {a.as_py(): (n.as_py(), h) for a, n, h in zip(left.column("leader"), left.column("n_a"), left.column("h_a"))}
        us, vs = [], []
        for a, b, n, h in zip(right.column("a"), right.column("b"), right.column("n_b"), right.column("h_b")):
            n_a, h_a = own[a.as_py()]
            if test(h_a.as_py(), h.as_py(), n_a, n.as_py()):
                us.append(a.as_py())
                vs.append(b.as_py())
        return pa.table({"a": pa.array(us, pa.binary()), "b": pa.array(vs, pa.binary())})
    out = written(left.groupBy("deal").cogroup(right.groupBy("deal")).applyInArrow(run, "a binary, b binary"), "jaccard-compared")
    deleted(degree)
    return out


def verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(u, v): the pairs (a, b) of sets that link: those whose bitmaps allow it are
    verified on the whole sets."""
    def link(x, y, n_x, n_y):
        x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
        small, large = (x, y) if n_x <= n_y else (y, x)
        at = np.searchsorted(large, small)
        at[at == len(large)] = 0
        return linked(int((large[at] == small).sum()) if len(large) else 0, n_x, n_y, percent)

    pairs = written(pairs.distinct(), "jaccard-pairs")
    marks = sets.select("dig", "n", F.col("mark").alias("h"), F.greatest(F.lit(8), F.col("n") / 4).alias("bytes"))
    left = compared(pairs, marks, lambda x, y, n_x, n_y: may_link(x, y, n_x, n_y, percent))
    whole = whole_sets(docs, sets, left, shingle)
    links = compared(left, whole.withColumn("bytes", F.col("n") * 8), link)
    for table in (pairs, left, whole):
        deleted(table)
    return links.select(F.col("a").alias("u"), F.col("b").alias("v"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, tk, n, dig, component_id) per row of ``docs``."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    counts = spark.sparkContext.broadcast(shingle_counts(docs, shingle, COUNTERS))
    rows = written(set_rows(docs, counts, shingle, percent), "jaccard-rows")

    full = rows.where(F.col("n") > 0)
    sets = written(full.groupBy("dig").agg(F.first("gid").alias("gid"), F.min(F.struct("doc_id", "tk")).alias("rep"),
                                           F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"),
                                           F.first("n").alias("n"), F.first("mark").alias("mark"), F.first("short").alias("short")), "jaccard-distinct")
    met = written(met_lists(full, counts, percent), "jaccard-lists")
    lists = met.where(F.col("leader").isNull()).select("token", "gid", "n", "pos")
    heads = written(sets.groupBy("gid").agg(F.min("dig").alias("a"), F.count(F.lit(1)).alias("members")), "jaccard-groups")

    # one partner per set: the leader of its group, and the head of its group
    lead = (met.where(F.col("leader").isNotNull()).groupBy("gid").agg(F.min(F.struct("h", "leader")).alias("m"))
            .select("gid", F.col("m.leader").alias("leader"))
            .join(heads.select(F.col("gid").alias("leader"), "a"), "leader").select("gid", "a"))
    member = sets.select("gid", F.col("dig").alias("b"))
    stars = lead.unionByName(heads.where(F.col("members") > 1).select("gid", "a"))
    edges = verified(member.join(stars, "gid").where(F.col("a") != F.col("b")).select("a", "b"), docs, sets, shingle, percent)
    busy = heads.where(F.col("members") > 1).select("gid").unionByName(lists.select("gid")).distinct()

    label = F.xxhash64(F.coalesce("root", "dig"))
    named = written(sets.join(busy, "gid", "left_semi").join(components(edges).withColumnRenamed("fp", "dig"), "dig", "left")
                    .select("gid", "dig", label.alias("label")), "jaccard-labels")
    def grouped():
        return written(named.groupBy("gid").agg(F.min("label").alias("low"), F.max("label").alias("high")), "jaccard-group-labels")

    def tried(partners):
        """The members of every group with the first member of its partner (gid, leader)."""
        head = named.groupBy("gid").agg(F.min(F.struct("dig", "label")).alias("m"))
        head = head.select(F.col("gid").alias("leader"), F.col("m.dig").alias("a"), F.col("m.label").alias("la"))
        return written(named.join(partners, "gid").join(head, "leader")
                       .where(F.col("la") != F.col("label")).select("a", F.col("dig").alias("b")), "jaccard-tried")

    def relabelled(new):
        of = named.select("dig", "label")
        joined = components(new.join(of.select(F.col("dig").alias("u"), F.col("label").alias("lu")), "u")
                            .join(of.select(F.col("dig").alias("v"), F.col("label").alias("lv")), "v")
                            .select(F.col("lu").alias("u"), F.col("lv").alias("v")))
        return written(named.join(joined.withColumnRenamed("fp", "label"), "label", "left")
                       .select("gid", "dig", F.coalesce("root", "label").alias("label")), "jaccard-labels")

    for seed in range(1, LEADER_ROUNDS):
        pairs = tried(next_leaders(lists, grouped(), seed, percent))
        n = pairs.count()
        if not n:
            break
        new = verified(pairs, docs, sets, shingle, percent)
        edges, named = edges.unionByName(new), relabelled(new)
        if 25 * new.count() < n:
            break

    opened = open_lists(lists, grouped())
    marks = group_marks(opened, sets)
    for _ in range(NEAREST_ROUNDS):
        pairs = tried(nearest_pairs(opened, marks, percent).select(F.col("g").alias("gid"), F.col("h").alias("leader")))
        n = pairs.count()
        if not n:
            break
        new = verified(pairs, docs, sets, shingle, percent)
        edges, named = edges.unionByName(new), relabelled(new)
        deleted(opened)
        opened = open_lists(lists, grouped())
        if 25 * new.count() < n:
            break

    # all that still lies apart
    labels = grouped()
    across = open_pairs(opened, marks, percent)
    inside = labels.where(F.col("low") != F.col("high")).select(F.col("gid").alias("g"), F.col("gid").alias("h"))
    pairs = across.unionByName(inside)
    x = named.select(F.col("gid").alias("g"), F.col("dig").alias("a"), F.col("label").alias("la"))
    y = named.select(F.col("gid").alias("h"), F.col("dig").alias("b"), F.col("label").alias("lb"))
    rest = pairs.join(x, "g").join(y, "h").where((F.col("la") != F.col("lb")) & ((F.col("g") != F.col("h")) | (F.col("a") < F.col("b"))))
    more = verified(rest.select("a", "b"), docs, sets, shingle, percent)

    roots = components(edges.unionByName(more)).withColumnRenamed("fp", "dig")
    linked_sets = sets.select("dig", "least").join(roots, "dig", "left").withColumn("root", F.coalesce("root", "dig"))
    least = linked_sets.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = written(linked_sets.join(least, "root").select("dig", "component_id"), "jaccard-ids")
    slim = full.select("doc_id", "tk", "n", "dig")
    alone = rows.where(F.col("n") == 0).select("doc_id", "tk", "n", "dig", F.col("doc_id").alias("component_id"))
    return (hot_key_join(slim, ids, "dig", sets.select("dig", F.col("copies").alias("n")))
            .select("doc_id", "tk", "n", "dig", "component_id").unionByName(alone))


def op12_ngram_jaccard_join(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
