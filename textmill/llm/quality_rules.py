"""Quality rules with thresholds learned per language and source (operator 10).

Every document gets counts (``word_counts``). The rules compare four ratios
with a fence that adapts to the document's own language and source: the fence
is ``q50 + reach * max(q75 - q50, resolution)``, above which (for word length
also below the mirrored fence) a document is an outlier of its group.

The quantiles come from a mergeable sketch: a log-linear histogram of integer
values. A value keeps its ``SKETCH_BITS`` leading bits, so a bucket is at most
1/32 wide relative to its value; a sketch is the table of bucket counts and two
sketches merge by adding counts. Building one is a partial aggregation (a hot
source is combined before the shuffle), merging is a second one: groups of
fewer than ``MIN_GROUP`` documents use the merged sketch of their language, and
languages of fewer use the sketch of everything. All arithmetic is on integers,
so the result does not depend on the order of merging.

Defined cases: a null or empty text has no words and fails the base rule; null
``lang`` or ``source`` form groups of their own; repeated rows are judged
alike; an empty table gives an empty result; extra columns pass through
``filter_documents`` and are ignored by ``judge``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import broadcast_if_small, let, text_key, words_of, written

SKETCH_BITS = 6
MIN_GROUP = 200
REACH = 8
MIN_WORDS = 50
REPEAT_PCT = 50
#: metric: least spread that counts (the resolution of the rule), in its unit
RESOLUTION = {"symbol_ppm": 5_000, "upper_ppm": 2_000, "dup_line_ppm": 50_000, "word_milli": 150}
TWO_SIDED = ("word_milli",)
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_PRE = "_qr_"


def repeated_words(words: Column, k: int = 3) -> Column:
    """Words lying in a ``k``-word window that occurs at least twice in ``words``."""
    def covered(keyed):
        n = F.size(keyed)
        def is_rep(x, j):
            before = F.when(j > 0, keyed[j - 1]["h"] == x["h"]).otherwise(F.lit(False))
            after = F.when(j + 1 < n, keyed[j + 1]["h"] == x["h"]).otherwise(F.lit(False))
            return before | after
        starts = F.sort_array(F.transform(F.filter(keyed, is_rep), lambda x: x["i"]))
        def total(p):
            gaps = F.transform(p, lambda x, j: F.when(j + 1 < F.size(p), F.least(F.lit(k), p[j + 1] - x)).otherwise(F.lit(k)))
            return F.aggregate(gaps, F.lit(0), lambda acc, g: acc + g)
        return let(starts, total)

    def windows(w):
        keyed = F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.struct(
            F.xxhash64(*[w[i + j] for j in range(k)]).alias("h"), i.alias("i")))
        return F.when(F.size(w) >= k, let(F.sort_array(keyed), covered)).otherwise(F.lit(0))

    return let(words, windows).cast("long")


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    return let(lines, lambda a: (F.size(a) - F.size(F.array_distinct(a)))).cast("long")


def word_counts(docs: DataFrame, text: str = "text", pre: str = "") -> DataFrame:
    """``docs`` plus the counts of ``COUNTS`` and two helpers (lines, capitals)."""
    t = F.coalesce(F.col(text), F.lit(""))
    packed = let(words_of(t), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).alias("n_repeat_words")))
    return (docs.withColumn(pre + "_w", packed)
            .select(*docs.columns,
                    *[F.col(f"{pre}_w.{c}").alias(pre + c) for c in ("n_words", "word_chars")],
                    F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias(pre + "n_symbols"),
                    duplicate_lines(t).alias(pre + "n_dup_lines"),
                    F.col(f"{pre}_w.n_repeat_words").alias(pre + "n_repeat_words"),
                    F.size(F.split(t, "\n")).cast("long").alias(pre + "n_lines"),
                    F.regexp_count(t, F.lit("[A-Z]")).cast("long").alias(pre + "n_upper")))


def ratios(pre: str = "") -> dict[str, Column]:
    """The ratios that the rules judge, as integers."""
    c = lambda name: F.col(pre + name)
    per = lambda num, den, unit: F.expr(f"(`{pre}{num}` * {unit}L) div greatest(`{pre}{den}`, 1L)")
    return {"symbol_ppm": per("n_symbols", "word_chars", 1_000_000),
            "upper_ppm": per("n_upper", "word_chars", 1_000_000),
            "dup_line_ppm": per("n_dup_lines", "n_lines", 1_000_000),
            "word_milli": per("word_chars", "n_words", 1_000)}


def base_failed(pre: str = "") -> Column:
    return (F.col(pre + "n_words") < MIN_WORDS) | (
        100 * F.col(pre + "n_repeat_words") > REPEAT_PCT * F.col(pre + "n_words"))


def bucket(value: str) -> Column:
    """Lower end of the sketch bucket that holds the integer column ``value``."""
    drop = f"greatest(length(bin({value})) - {SKETCH_BITS}, 0)"
    return F.expr(f"shiftleft(shiftright({value}, {drop}), {drop})")


def sketches(counted: DataFrame, pre: str = "") -> DataFrame:
    """Sketch rows (lang, source, metric, bucket, n) of the rows that pass the base rule."""
    metrics = F.explode(F.map_from_arrays(
        F.array(*[F.lit(m) for m in RESOLUTION]), F.array(*ratios(pre).values()))).alias("metric", "v")
    return (counted.where(~base_failed(pre)).select("lang", "source", metrics)
            .select("lang", "source", "metric", bucket("v").alias("bucket"))
            .groupBy("lang", "source", "metric", "bucket").agg(F.count(F.lit(1)).alias("n")))


def merge(sketch: DataFrame, keys: list[str]) -> DataFrame:
    return sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """One row per group: size and the fences of every metric. A group's sketch
    has at most 64 * 2**SKETCH_BITS buckets, whatever the group's size."""
    w = Window.partitionBy(*keys, "metric")
    ranked = sketch.select(*keys, "metric", "bucket", "n",
                           F.sum("n").over(w.orderBy("bucket")).alias("cum"), F.sum("n").over(w).alias("total"))
    at = lambda pct: F.min(F.when(100 * F.col("cum") >= pct * F.col("total"), F.col("bucket")))
    q = ranked.groupBy(*keys, "metric").agg(at(25).alias("q25"), at(50).alias("q50"), at(75).alias("q75"),
                                            F.max("total").alias("total"))
    res = F.element_at(F.create_map(*[F.lit(x) for kv in RESOLUTION.items() for x in kv]), F.col("metric"))
    q = q.select(*keys, "metric", "total",
                 (F.col("q50") + REACH * F.greatest(F.col("q75") - F.col("q50"), res)).alias("hi"),
                 (F.col("q50") - REACH * F.greatest(F.col("q50") - F.col("q25"), res)).alias("lo"))
    pick = lambda m, c: F.max(F.when(F.col("metric") == m, F.col(c)))
    return q.groupBy(*keys).agg(F.max("total").alias("group_size"),
                                *[pick(m, "hi").alias(f"{m}_hi") for m in RESOLUTION],
                                *[pick(m, "lo").alias(f"{m}_lo") for m in TWO_SIDED])


LIMITS = [f"{m}_hi" for m in RESOLUTION] + [f"{m}_lo" for m in TWO_SIDED]


def thresholds(sketch: DataFrame) -> DataFrame:
    """(lang, source) → limits, taken from the smallest group with at least
    ``MIN_GROUP`` documents; written once, so that all later tasks agree."""
    sketch = written(sketch, "quality-sketch")
    own = fences(sketch, ["lang", "source"])
    lang = fences(merge(sketch, ["lang"]), ["lang"])
    every = fences(merge(sketch, []).withColumn("_all", F.lit(1)), ["_all"])
    ren = lambda df, p: df.select(*[F.col(c).alias(p + c) for c in df.columns])
    j = (own.withColumn("_all", F.lit(1)).join(ren(lang, "l_"), F.col("lang").eqNullSafe(F.col("l_lang")), "left")
            .join(F.broadcast(ren(every, "e_")), F.col("_all") == F.col("e__all"), "left"))  # one row
    pick = lambda c: (F.when(F.col("group_size") >= MIN_GROUP, F.col(c))
                      .when(F.col("l_group_size") >= MIN_GROUP, F.col("l_" + c)).otherwise(F.col("e_" + c)))
    return written(j.select("lang", "source", *[pick(c).alias(c) for c in LIMITS]), "quality-limits")


def judge(counted: DataFrame, limits: DataFrame, pre: str = "") -> DataFrame:
    """Join the limits of each row's group and add ``base_failed`` and ``kept``."""
    lim = limits.select(F.col("lang").alias(_PRE + "lang"), F.col("source").alias(_PRE + "source"),
                        *[F.col(c).alias(_PRE + c) for c in LIMITS])
    r = ratios(pre)
    over = F.lit(False)
    for m in RESOLUTION:
        over = over | F.coalesce(r[m] > F.col(f"{_PRE}{m}_hi"), F.lit(False))
    for m in TWO_SIDED:
        over = over | F.coalesce(r[m] < F.col(f"{_PRE}{m}_lo"), F.lit(False))
    return (counted.join(lim, counted["lang"].eqNullSafe(lim[_PRE + "lang"])
                         & counted["source"].eqNullSafe(lim[_PRE + "source"]), "left")
            .withColumn(pre + "base_failed", base_failed(pre))
            .withColumn(pre + "kept", ~F.col(pre + "base_failed") & ~over)
            .drop(_PRE + "lang", _PRE + "source", *[_PRE + c for c in LIMITS]))


def filter_documents(docs: DataFrame) -> DataFrame:
    """The kept documents, with the columns they came with. Counts are taken once
    and written without the texts; the rows that are not kept are then told by
    ``doc_id`` and a hash of the text, group included."""
    keyed = docs.withColumn(_PRE + "tk", text_key(F.col("text")))
    keys = ["doc_id", "lang", "source"]
    counted = written(word_counts(keyed.select(*keys, _PRE + "tk", "text")).drop("text"), "quality-counts")
    bad = judge(counted, thresholds(sketches(counted))).where(~F.col("kept")).select(
        *[F.col(c).alias(_PRE + c) for c in keys], F.col(_PRE + "tk").alias(_PRE + "bad")).distinct()
    bad = written(bad, "quality-rejected")
    same = keyed[_PRE + "tk"] == bad[_PRE + "bad"]
    for c in keys:
        same = same & keyed[c].eqNullSafe(bad[_PRE + c])
    return keyed.join(broadcast_if_small(bad, 96), same, "left_anti").select(*docs.columns)


def op10_quality_rules(docs: DataFrame) -> DataFrame:
    counted = written(word_counts(docs.select("doc_id", "lang", "source", "text")).drop("text"), "quality-counts")
    limits = thresholds(sketches(counted))
    return judge(counted, limits).select("doc_id", *COUNTS, "base_failed", "kept", "n_lines", "n_upper")
