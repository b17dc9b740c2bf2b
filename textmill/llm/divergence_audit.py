"""Audit of how the sources of a language differ in their words (operator 13).

Terms are matches of ``TERM``, A-Z lower-cased. A language keeps the ``V`` terms
that stand in at least ``min_docs`` of its documents. A group (language, source)
and the language itself give each kept term ``p = 1 + floor(SCALE * (count + 2) /
(N + 2 V))``, ``N`` their count over all kept terms, and two such numbers differ by
``f = floor((p - q)^2 / (p + q))``. All arithmetic is in whole numbers.

Counting. Tasks count the words of their documents and emit one row per
(language, term, source) and about ``FLUSH`` counted terms, so a hot language or
source is added up before it is shuffled. Rows meet by (language, term); the same
exchange serves the sums per source and per language.

Part ``pair``: value of two sources, ``f`` summed over all kept terms. Terms are
dealt to tasks by (language, salt), so that a task holds about ``CELLS`` counts
of one language; it adds up one matrix of sources by sources (a stripe of it if a
language has very many sources), and the stripes are summed.

Part ``term``: the ``top`` terms of a group with ``p > q`` by value. ``f`` grows
with ``p`` and falls with ``q``, hence a term cannot be among the first k if k
others have at least its count in the group, at most its count in the language
and come before it in UTF-8. Every task keeps its skyband, the terms with fewer
than k such dominators; skybands are merged in two steps (a skyband of a union
lies in the union of the skybands), and only what is left is valued and ranked.

Defined cases: null text, lang or source is ''; a group without terms has ``N`` 0
and pair rows, a language without kept terms has pairs of value 0; repeated rows
count each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import broadcast_if_small, partitions, written

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 10
SCALE = 1_000_000_000
TOP = 10
FLUSH = 500_000       # (language, source, term) counts that a task holds
CELLS = 2_000_000     # counts of one language that a pair or skyband task holds, about
STRIPE = 4_000_000    # cells of the source matrix that a task adds up
_SWEEP = 256          # terms tried against the skyband at once
# bytes of a text: A-Z lower-cased, what is in no term (TERM) made a space
_SPLIT = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


# ------------------------------------------------------------- task helpers

def _count_terms(batches):
    """(lang, source, term, n, docs); a row without a term tells that the group occurs.
    Terms are counted as UTF-8: what parts them is ASCII, so is what is lower-cased."""
    seen, n, docs, size = set(), {}, {}, 0

    def flush():
        for (lang, source), bag in n.items():
            terms, own = list(bag), docs[lang, source]
            for at in range(0, len(terms), 50_000):
                part = terms[at:at + 50_000]
                yield _rows(lang, source, part, list(map(bag.__getitem__, part)), list(map(own.__getitem__, part)))

    for b in batches:
        text = b.column(0).cast(_binary(b.column(0).type))
        for text, lang, source in zip(text, *(b.column(i) for i in (1, 2))):
            key = lang.as_py() or "", source.as_py() or ""
            if key not in n:
                seen.add(key)
                n[key], docs[key] = Counter(), Counter()
            words = (text.as_py() or b"").translate(_SPLIT).split()
            size -= len(n[key])
            n[key].update(words)
            docs[key].update(set(words))
            size += len(n[key])
            if size >= FLUSH:
                yield from flush()
                n, docs, size = {}, {}, 0
    yield from flush()
    for lang, source in seen:
        yield _rows(lang, source, [None], [0], [0])


def _binary(kind):
    return pa.large_binary() if pa.types.is_large_string(kind) else pa.binary()


def _rows(lang, source, terms, n, docs):
    k = len(terms)
    return pa.RecordBatch.from_arrays(
        [pa.repeat(pa.scalar(lang, pa.string()), k), pa.repeat(pa.scalar(source, pa.string()), k), pa.array(terms, pa.binary()).cast(pa.string()),
         pa.array(n, pa.int64()), pa.array(docs, pa.int64())], ["lang", "source", "term", "n", "docs"])


def share(count: np.ndarray, total: int, kept: int) -> np.ndarray:
    """``1 + floor(SCALE * (count + 2) / (total + 2 * kept))`` without overflow."""
    count = np.asarray(count, dtype=np.int64) + 2
    over = int(total) + 2 * int(kept)
    if len(count) and int(count.max()) > (1 << 62) // SCALE:
        return np.array([1 + SCALE * int(c) // over for c in count], dtype=np.int64)
    return 1 + SCALE * count // over


def skyband(group: np.ndarray, lang: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Rows that fewer than ``k`` others dominate: with at least their ``group``, at
    most their ``lang`` and a lesser ``order`` (all different).

    Rows are taken so that dominators come first; whoever is dominated by k rows is
    dominated by k rows of the skyband, so only those are looked at."""
    rows = np.lexsort((order, lang, -group))
    held = np.zeros(0, dtype=np.int64)
    for at in range(0, len(rows), _SWEEP):
        new = rows[at:at + _SWEEP]
        before = _dominators(new, held, group, lang, order)
        new, before = new[before < k], before[before < k]
        # among themselves, in order
        mine = (group[new][None, :] >= group[new][:, None]) & (lang[new][None, :] <= lang[new][:, None]) \
            & (order[new][None, :] < order[new][:, None])
        kept = np.zeros(len(new), dtype=bool)
        for i in range(len(new)):
            kept[i] = before[i] + int((mine[i] & kept).sum()) < k
        held = np.concatenate([held, new[kept]])
    return held


def _dominators(rows, held, group, lang, order) -> np.ndarray:
    return ((group[held][None, :] >= group[rows][:, None]) & (lang[held][None, :] <= lang[rows][:, None])
            & (order[held][None, :] < order[rows][:, None])).sum(axis=1)


def _skybands(k: int):
    """Per (lang, source) of a table (lang, source, term, n, lang_n): its skyband."""
    def run(table: pa.Table) -> pa.Table:
        table = table.select(["lang", "source", "term", "n", "lang_n"]).combine_chunks()
        if not len(table):
            return table
        key = np.unique(np.array([f"{a}\0{b}" for a, b in zip(table.column("lang").to_pylist(), table.column("source").to_pylist())],
                                 dtype=object), return_inverse=True)[1]
        terms = [t.encode() for t in table.column("term").to_pylist()]
        place = np.empty(len(terms), dtype=np.int64)
        place[sorted(range(len(terms)), key=terms.__getitem__)] = np.arange(len(terms))
        n, lang_n = table.column("n").to_numpy(), table.column("lang_n").to_numpy()
        by = np.argsort(key, kind="stable")
        cuts = np.nonzero(np.append(True, np.diff(key[by]) != 0))[0]
        keep = []
        for a, e in zip(cuts, np.append(cuts[1:], len(by))):
            own = by[a:e]
            keep.append(own[skyband(n[own], lang_n[own], place[own], k)])
        return table.take(pa.array(np.concatenate(keep)))
    return run


def _pair_sums(first: np.ndarray, last: int, counts, kept: int, totals: np.ndarray) -> np.ndarray:
    """Sums of f for the sources ``first..last`` against all, over terms given as
    (term, source, count) triples."""
    term, source, n = counts
    base = np.array([share(np.zeros(1), t, kept)[0] for t in totals], dtype=np.int64)
    value = np.empty(len(n), dtype=np.int64)
    by = np.argsort(source, kind="stable")
    ends = np.searchsorted(source[by], np.arange(len(totals) + 1))
    for s in range(len(totals)):
        own = by[ends[s]:ends[s + 1]]
        value[own] = share(n[own], totals[s], kept)
    out = np.zeros((last - first, len(totals)), dtype=np.int64)
    by = np.argsort(term, kind="stable")
    term, source, value = term[by], source[by], value[by]
    n_terms = int(term[-1]) + 1 if len(term) else 0
    step = max(1, STRIPE // max(1, len(totals)))
    for at in range(0, n_terms, step):
        lo, hi = np.searchsorted(term, [at, min(at + step, n_terms)])
        p = np.repeat(base[None, :], min(step, n_terms - at), axis=0)
        p[term[lo:hi] - at, source[lo:hi]] = value[lo:hi]
        for a in range(first, last):
            d = p - p[:, a:a + 1]
            out[a - first] += (d * d // (p + p[:, a:a + 1])).sum(axis=0)
    return out


# --------------------------------------------------------------- Spark stages

def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, term, docs, sources: [(source, n)]) per term of a language; a null term
    lists all sources of the language."""
    rows = docs.select("text", F.col("lang").cast("string"), F.col("source").cast("string")).mapInArrow(
        _count_terms, "lang string, source string, term string, n long, docs long")
    # one exchange: the grouping by source is within the one by term
    met = rows.repartition(partitions(docs.sparkSession), "lang", "term")
    return (met.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
            .groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("sources")))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank)."""
    met = written(term_counts(docs).where(F.col("term").isNull() | (F.col("docs") >= min_docs)), "audit-terms")
    kept = met.where(F.col("term").isNotNull()).select("lang", "term", "sources", F.aggregate(
        "sources", F.lit(0).cast("long"), lambda s, x: s + x["n"]).alias("lang_n"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"), F.sum(F.size("sources")).alias("cells"))
    flat = kept.select("lang", "term", "lang_n", F.inline("sources"))
    own = flat.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_name = Window.partitionBy("lang").orderBy("source")
    groups = (met.where(F.col("term").isNull()).select("lang", F.explode("sources.source").alias("source"))
              .join(own, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
              .withColumn("number", F.row_number().over(by_name) - 1)
              .withColumn("sources", F.count(F.lit(1)).over(Window.partitionBy("lang"))))
    groups = broadcast_if_small(written(groups, "audit-groups"), 256)
    pairs = pair_values(flat, groups)
    terms = top_terms(flat, groups, top)
    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return (pairs.withColumn("part", F.lit("pair")).withColumn("rank", F.row_number().over(ranked))
            .select("lang", "source", "part", "item", "value", "rank")
            .unionByName(terms.withColumn("part", F.lit("term")).withColumn("rank", F.row_number().over(ranked))
                         .where(F.col("rank") <= top).select("lang", "source", "part", "item", "value", "rank")))


def pair_values(flat: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every ordered pair of sources of a language."""
    salts = F.greatest(F.ceil(F.col("cells") / CELLS), F.lit(1)).cast("int")
    width = F.greatest(F.floor(F.lit(STRIPE) / F.col("sources")), F.lit(1))
    stripes = F.ceil(F.col("sources") / width).cast("int")
    shape = groups.groupBy("lang").agg(F.first("sources").alias("sources"), F.first("cells").alias("cells")).select(
        "lang", salts.alias("salts"), width.cast("int").alias("width"), stripes.alias("stripes"))
    each = F.explode(F.sequence(F.lit(0), F.col("stripes") - 1)).alias("stripe")
    counts = (flat.join(groups.select("lang", "source", "number"), ["lang", "source"]).join(shape, "lang")
              .select("lang", F.pmod(F.xxhash64("term"), F.col("salts")).cast("int").alias("salt"), each, "term", "number", "n"))
    sized = groups.join(shape, "lang").select(
        "lang", F.col("number").alias("at"), "total", "kept", "width", "stripes", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    sized = sized.select("lang", "salt", each, "at", "total", "kept", "width").toDF(
        "s_lang", "s_salt", "s_stripe", "at", "total", "kept", "width")

    def run(key, counts, sized):
        lang, _, stripe = (k.as_py() for k in key)
        totals = np.zeros(len(sized), dtype=np.int64)
        totals[sized.column("at").to_numpy()] = sized.column("total").to_numpy()
        width = sized.column("width")[0].as_py()
        first, last = stripe * width, min((stripe + 1) * width, len(totals))
        term = counts.column("term").combine_chunks().dictionary_encode()
        term = (pa.chunked_array(term) if isinstance(term, pa.Array) else term).unify_dictionaries()
        code = np.concatenate([np.zeros(0, dtype=np.int64), *(c.indices.to_numpy() for c in term.chunks)]).astype(np.int64)
        sums = _pair_sums(first, last, (code, counts.column("number").to_numpy().astype(np.int64), counts.column("n").to_numpy()),
                          sized.column("kept")[0].as_py(), totals)
        a, b = (x.ravel() for x in np.meshgrid(np.arange(first, last), np.arange(len(totals)), indexing="ij"))
        off = a != b
        return pa.table({"lang": pa.array([lang] * int(off.sum()), pa.string()), "a": a[off], "b": b[off], "value": sums.ravel()[off]})
    sums = (counts.groupBy("lang", "salt", "stripe").cogroup(sized.groupBy("s_lang", "s_salt", "s_stripe"))
            .applyInArrow(run, "lang string, a long, b long, value long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    one = groups.select("lang", F.col("number").cast("long").alias("a"), "source")
    other = groups.select("lang", F.col("number").cast("long").alias("b"), F.col("source").alias("item"))
    return sums.join(one, ["lang", "a"]).join(other, ["lang", "b"]).select("lang", "source", "item", "value")


def top_terms(flat: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """(lang, source, item, value): terms of the groups' skybands with p > q."""
    schema = "lang string, source string, term string, n long, lang_n long"
    band = _skybands(top)

    def in_task(batches):
        held = []
        for b in batches:
            held.append(pa.Table.from_batches([b]))
            if sum(map(len, held)) >= CELLS // 4:
                held = [band(pa.concat_tables(held))]
        if held:
            yield from band(pa.concat_tables(held)).to_batches()
    some = flat.select("lang", "source", "term", "n", "lang_n").mapInArrow(in_task, schema)
    # a task merges several groups at once, a hot group first in parts by term
    n = partitions(flat.sparkSession)
    part = F.pmod(F.xxhash64("lang", "source", F.pmod(F.xxhash64("term"), F.lit(16))), F.lit(n)).alias("deal")
    whole = F.pmod(F.xxhash64("lang", "source"), F.lit(n)).alias("deal")
    merged = some
    for deal in (part, whole):
        merged = merged.groupBy(deal).applyInArrow(lambda key, t: band(t), schema)

    def p(count, total):
        # whole numbers beyond 64 bits
        return (F.expr(f"{SCALE} * cast({count} + 2 as decimal(28,0)) div cast({total} + 2 * kept as decimal(28,0))") + 1).cast("long")
    p_q = merged.join(groups.select("lang", "source", "total", "kept", "lang_total"), ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), p("n", "total").alias("p"), p("lang_n", "lang_total").alias("q"))
    return p_q.where(F.col("p") > F.col("q")).select("lang", "source", "item", F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))


def op13_source_divergence_audit(docs: DataFrame) -> DataFrame:
    return divergence(docs)
