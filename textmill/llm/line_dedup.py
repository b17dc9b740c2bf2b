"""Line deduplication by hashed line keys (operator 5).

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with A-Z
lower-cased. Keys of at least ``MIN_CHARS`` code points that occur in at least
``MIN_DOCS`` documents keep their lines only in the largest ``doc_id``.

Rows ``(hash, document, position)`` are range-partitioned on the hash and sorted
by hash, document (descending) and position; a window streams over them and
marks everything but the first document's lines. A key that alone would
overload a partition is found beforehand (counts of 65,536 hash classes, then
of the keys of heavy classes) and decided by a partial aggregation instead, so
its rows are never brought together: at most ``4 * partitions`` keys can
be that heavy, and only those are broadcast. Only dropped positions travel on,
as one bitmap per document in compressed form (runs of kept lines). Texts are
joined with their bitmap only to rebuild them; bitmaps whose measured size is
small are broadcast, otherwise both sides are shuffled by document.

A key is held as 96 hash bits (xxHash64 and Murmur3).

Defined cases: a null or empty text is one empty line; a null ``doc_id`` counts
as one document smaller than any other; rows with the same ``doc_id`` are one
document; an empty table gives an empty result; other columns pass through
``dedup_lines`` untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import SPACE, ascii_lower, broadcast_if_small, let, partitions, text_key, written

MIN_CHARS = 20
MIN_DOCS = 3
CLASSES = 65_536


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, doc_id, tk, pos) of every line that is long enough."""
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n")
    keyed = F.transform(lines, lambda x, i: let(F.btrim(x, F.lit(SPACE)), lambda k: F.when(
        F.char_length(k) >= min_chars, let(ascii_lower(k), lambda z: F.struct(
            F.xxhash64(z).alias("h1"), F.hash(z).alias("h2"), i.alias("pos"))))))
    return (docs.select("doc_id", text_key(F.col("text")).alias("tk"),
                        F.explode(F.filter(keyed, lambda x: x.isNotNull())).alias("r"))
            .select("r.h1", "r.h2", "doc_id", "tk", "r.pos"))


def heavy_keys(rows: DataFrame, parts: int) -> DataFrame:
    """Keys with more than 1/(4 * parts) of all rows; at most 4 * parts of them."""
    classes = rows.groupBy(F.pmod("h1", F.lit(CLASSES)).alias("cls")).agg(F.count(F.lit(1)).alias("n"))
    classes = written(classes, "line-classes")  # at most CLASSES rows
    total = classes.agg(F.sum("n")).first()[0] or 0
    limit = max(1_000, total // (4 * parts))
    heavy = classes.where(F.col("n") > limit).select("cls")
    return (rows.select("h1", "h2", F.pmod("h1", F.lit(CLASSES)).alias("cls"))
            .join(F.broadcast(heavy), "cls", "left_semi")  # at most 4 * parts rows
            .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select("h1", "h2"))


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, tk, pos) of the lines that go."""
    parts = partitions(docs.sparkSession)
    rows = written(line_rows(docs, min_chars), "line-rows")
    heavy = written(heavy_keys(rows, parts), "line-heavy")

    light = (rows.join(F.broadcast(heavy), ["h1", "h2"], "left_anti")
             .repartitionByRange(parts, "h1")
             .sortWithinPartitions("h1", "h2", F.col("doc_id").desc_nulls_last(), "pos"))
    key = Window.partitionBy("h1", "h2")
    first_docs = F.dense_rank().over(key.orderBy(F.col("doc_id").desc_nulls_last()))
    light = (light.withColumn("rank", first_docs).withColumn("n_docs", F.max("rank").over(key))
             .where((F.col("rank") > 1) & (F.col("n_docs") >= min_docs)))

    hot = rows.join(F.broadcast(heavy), ["h1", "h2"], "left_semi")
    top = (hot.select("h1", "h2", "doc_id").distinct().groupBy("h1", "h2")
           .agg(F.max("doc_id").alias("top"), F.count(F.lit(1)).alias("n_docs"))
           .where(F.col("n_docs") >= min_docs))
    hot = (hot.join(F.broadcast(top), ["h1", "h2"])  # no more rows than heavy keys
           .where(~F.col("doc_id").eqNullSafe(F.col("top"))))
    cols = ["doc_id", "tk", "pos"]
    return light.select(*cols).unionByName(hot.select(*cols))


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, tk, n_dropped, cuts): the compressed keep bitmap of each document
    that loses lines. ``cuts`` are the dropped positions as sorted runs
    ``(first, last)``; every other line is kept."""
    def runs(p):
        # a run starts where the previous position is not the predecessor
        starts = F.filter(p, lambda x, i: F.when(i == 0, F.lit(True)).otherwise(p[i - 1] + 1 != x))
        ends = F.filter(p, lambda x, i: F.when(i + 1 == F.size(p), F.lit(True)).otherwise(p[i + 1] - 1 != x))
        return F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("first"), e.alias("last")))
    return (dropped_lines(docs, min_chars, min_docs).groupBy("doc_id", "tk")
            .agg(F.sort_array(F.collect_set("pos")).alias("p"))  # bounded by the document itself
            .select("doc_id", "tk", F.size("p").cast("long").alias("n_dropped"), let(F.col("p"), runs).alias("cuts")))


def kept_text(lines, cuts):
    """The lines outside the runs of ``cuts``, joined by newlines."""
    def rebuild(a):
        def gaps(c):
            n = F.size(c)
            first = lambda i: F.when(i == 0, F.lit(0)).otherwise(c[i - 1]["last"] + 1)
            until = lambda i: F.when(i == n, F.size(a)).otherwise(c[i]["first"])
            return F.flatten(F.transform(F.sequence(F.lit(0), n), lambda i: F.slice(a, first(i) + 1, until(i) - first(i))))
        return F.array_join(let(cuts, gaps), "\n")
    return let(lines, rebuild)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with shortened texts and the columns ``n_lines`` and ``n_dropped``."""
    maps = written(keep_bitmaps(docs.select("doc_id", "text"), min_chars, min_docs), "line-bitmaps").select(
        F.col("doc_id").alias("_ld_id"), F.col("tk").alias("_ld_tk"), F.col("n_dropped").alias("_ld_n"),
        F.col("cuts").alias("_ld_cuts"))
    # bitmaps are far smaller than texts: move them, as long as their measured size allows it
    maps = broadcast_if_small(maps, 64 + 16 * F.size("_ld_cuts"))
    base = docs.withColumn("_ld_key", text_key(F.col("text")))
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n")
    out = (base.join(maps, base["doc_id"].eqNullSafe(maps["_ld_id"]) & (base["_ld_key"] == maps["_ld_tk"]), "left")
           .withColumn("_ld_lines", F.size(lines).cast("long"))
           .withColumn("text", F.when(F.col("_ld_n").isNull(), F.col("text"))
                       .otherwise(kept_text(lines, F.col("_ld_cuts")))))
    keep = [F.col(c) for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return out.select(*keep, F.col("_ld_lines").alias("n_lines"),
                      F.coalesce(F.col("_ld_n"), F.lit(0).cast("long")).alias("n_dropped"))


def strip_lines(docs: DataFrame) -> DataFrame:
    """Pipeline form: the columns of ``docs`` with deduplicated texts."""
    names = [c for c in docs.columns]
    shadow = docs.select(*[F.col(c).alias(c if c in ("doc_id", "text") else f"_c_{c}") for c in names])
    return dedup_lines(shadow).select(*[F.col(c if c in ("doc_id", "text") else f"_c_{c}").alias(c) for c in names])


def op5_line_dedup(docs: DataFrame) -> DataFrame:
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("kept_sha256"))
