"""Secret scan: fixed patterns plus sliding-window entropy (operator 1).

Base spans are the matches of three patterns (``BASE``). On top of them every
maximal run of characters of one class (hexadecimal, base64) that is at least a
window long is a candidate. A window slides over it; the sum of ``c * log2(c)`` over
the counts of its characters is updated by the two characters that leave and enter
(the state holds the sum; the count of such a character is read from the window). Windows whose
Shannon entropy reaches the threshold of the class become a span (touching windows are joined).
Allow-list: stretches that are no secrets (UUIDs, alphabets, documentation samples;
``SAMPLES``) are cut out of the text before candidates are taken, so a key beside one
is still found; candidates that are prose in one case, numbers, identifiers or paths
as a whole (``ALLOW``) are suppressed, and so are spans that lie
inside a base span. Sums are integers in millionths of a bit.

All of it is in-row array work on the DataFrame API: no shuffle at all.

Defined cases: a null text is empty and has no span; a text without matches has
the digest of the empty string; rows are independent, so repeated rows give
repeated results; an empty table gives an empty result. Positions are code
points, the end is exclusive, a base span is the whole match.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import let

ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
#: kind, pattern, group whose length counts, least length of that group
BASE = [("assign", ASSIGN, 2, 6), ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]{24,}", 0, 24)]
#: kind, characters, window, entropy threshold in bits
CLASSES = [("entropy_hex", r"[0-9A-Fa-f]", 24, 3.0), ("entropy_base64", r"[A-Za-z0-9+/=_-]", 24, 4.0)]
ALLOW = (r"^([a-z]+|[A-Z]+|[A-Z]?[a-z]+)$"                                    # prose in one case
         r"|^[0-9]+$"
         r"|^/?[A-Za-z]+([-_/=+][A-Za-z]+)*/?$")                                # identifiers, paths
#: stretches that are cut out, with their length (a pattern's matches all have one)
SAMPLES = [(r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}", 36), (r"(?i)placeholder", 11),
           (r"(?i)abcdefghij|0123456789|1234567890", 10), (r"(?i)changeme", 8), (r"(?i)example", 7), (r"(?i)your_", 5), (r"(?i)xxxx", 4)]
UNIT = 1_000_000
_BLOCK = 256


def weight(c: int) -> int:
    """``c * log2(c)`` in millionths."""
    return 0 if c < 2 else round(UNIT * c * math.log2(c))


def matches(text: Column, pattern: str, group: int, least: int) -> Column:
    """array<struct<start, stop, s>> of all leftmost non-overlapping matches whose
    ``group`` has ``least`` characters. Starts follow from the lengths of the
    matches and of the gaps between them, summed in blocks (linear time)."""
    item = "struct<start:bigint,stop:bigint,s:string>"

    def positions(found, gaps, sized):
        def in_block(state, b):
            cells = F.slice(F.sequence(F.lit(0), F.size(found) - 1), b * _BLOCK + 1, F.lit(_BLOCK))
            zero = F.struct(state["at"].alias("at"), F.array().cast(f"array<{item}>").alias("out"))
            def step(st, i):
                start = st["at"] + F.char_length(gaps[i])
                stop = start + F.char_length(found[i])
                hit = F.struct(start.alias("start"), stop.alias("stop"), found[i].alias("s"))
                return F.struct(stop.alias("at"), F.when(F.char_length(sized[i]) >= least, F.array_append(st["out"], hit))
                                .otherwise(st["out"]).alias("out"))
            return let(F.aggregate(cells, zero, step), lambda r: F.struct(
                r["at"].alias("at"), F.array_append(state["blocks"], r["out"]).alias("blocks")))
        blocks = F.sequence(F.lit(0), F.expr("0") + F.floor((F.size(found) - 1) / _BLOCK).cast("int"))
        zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<array<{item}>>").alias("blocks"))
        return F.flatten(F.aggregate(blocks, zero, in_block)["blocks"])

    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sized = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    hits = let(whole, lambda found: let(F.split(text, pattern, -1), lambda gaps: let(
        sized, lambda g: positions(found, gaps, g))))
    return F.when(F.rlike(text, F.lit(pattern)), hits).otherwise(F.array().cast(f"array<{item}>"))


def without_samples(text: Column) -> Column:
    """The text with every sample stretch blanked, all positions kept."""
    out = text
    for pattern, length in SAMPLES:
        out = F.regexp_replace(out, pattern, " " * length)
    return F.when(F.rlike(text, F.lit("|".join(p for p, _ in SAMPLES))), out).otherwise(text)


def entropy_spans(cand: Column, window: int, bits: float) -> Column:
    """array<struct<start, stop>> of the joined windows of ``cand`` (struct start,
    stop, s) whose entropy is at least ``bits``."""
    table = F.array(*[F.lit(weight(c)) for c in range(window + 1)])
    most = weight(window) - round(UNIT * bits * window)  # H >= bits  <=>  sum of weights <= most
    span = "struct<start:bigint,stop:bigint>"

    def scan(chars):
        def count(ch, first, n):  # occurrences of ch among n characters from first on
            return n - F.size(F.array_remove(F.slice(chars, first + 1, n), ch))

        def step(st, i):
            full = i >= window
            def entered(gone):
                first = F.greatest(i - window + 1, F.lit(0))
                b = count(chars[i], first, i - first)
                total = st["total"] - gone + table[b + 1] - table[b]
                return total
            left = F.when(full, let(count(chars[i - window], i - window, F.lit(window)),
                                    lambda a: table[a] - table[a - 1])).otherwise(F.lit(0))
            def close(total):
                hit = (i >= window - 1) & (total <= most)
                lo, hi = (i - window + 1).cast("bigint"), (i + 1).cast("bigint")
                joined = st["last"].isNotNull() & (lo <= st["last"]["stop"])
                last = F.when(hit & joined, F.struct(st["last"]["start"].alias("start"), hi.alias("stop"))).when(
                    hit, F.struct(lo.alias("start"), hi.alias("stop"))).otherwise(st["last"])
                done = F.when(hit & ~joined & st["last"].isNotNull(), F.array_append(st["done"], st["last"])).otherwise(st["done"])
                return F.struct(total.alias("total"), last.alias("last"), done.alias("done"))
            return let(let(left, entered), close)

        zero = F.struct(F.lit(0).alias("total"), F.lit(None).cast(span).alias("last"),
                        F.array().cast(f"array<{span}>").alias("done"))
        return let(F.aggregate(F.sequence(F.lit(0), F.size(chars) - 1), zero, step), lambda r: F.when(
            r["last"].isNull(), r["done"]).otherwise(F.array_append(r["done"], r["last"])))

    local = let(F.split(cand["s"], ""), scan)
    return F.transform(local, lambda x: F.struct((x["start"] + cand["start"]).alias("start"),
                                                 (x["stop"] + cand["start"]).alias("stop")))


def scan_secrets(docs: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` plus ``out``: array<struct<start, ord, stop, kind, base>> sorted by
    start and kind."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = docs
    for kind, pattern, group, least in BASE:
        df = df.withColumn(f"_sec_{kind}", matches(t, pattern, group, least))
    def shaped(arr, order, kind, base):
        return F.transform(arr, lambda x: F.struct(
            x["start"].alias("start"), F.lit(order).alias("ord"), x["stop"].alias("stop"),
            F.lit(kind).alias("kind"), F.lit(base).alias("base")))
    df = df.withColumn("_sec_base", F.concat(*[shaped(F.col(f"_sec_{k}"), n, k, True) for n, (k, *_) in enumerate(BASE)]))
    df = df.withColumn("_sec_cut", without_samples(t))
    added = []
    for n, (kind, chars, window, bits) in enumerate(CLASSES):
        cands = F.filter(matches(F.col("_sec_cut"), f"{chars}{{{window},}}", 0, window), lambda c: ~F.rlike(c["s"], F.lit(ALLOW)))
        spans = F.flatten(F.transform(cands, lambda c: entropy_spans(c, window, bits)))
        new = F.filter(shaped(spans, len(BASE) + n, kind, False), lambda x: ~F.exists(
            F.col("_sec_base"), lambda b: (b["start"] <= x["start"]) & (x["stop"] <= b["stop"])))
        df = df.withColumn(f"_sec_{kind}", new)
        added.append(F.col(f"_sec_{kind}"))
    df = df.withColumn(out, F.sort_array(F.concat(F.col("_sec_base"), *added)))
    return df.drop("_sec_base", "_sec_cut", *[f"_sec_{k}" for k, *_ in [*BASE, *CLASSES]])


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")


def op1_secret_scan(docs: DataFrame) -> DataFrame:
    found = scan_secrets(docs.select("doc_id", "text"), out="_spans").drop("text")
    n = lambda kind: F.size(F.filter("_spans", lambda x: x["kind"] == kind)).cast("long")
    return found.select("doc_id", *[n(k).alias(f"n_{k}") for k, *_ in BASE],
                        F.sha2(listed(F.filter("_spans", lambda x: x["base"])).cast("binary"), 256).alias("base_sha256"),
                        listed(F.col("_spans")).alias("spans"),
                        (F.size("_spans") - F.size(F.filter("_spans", lambda x: x["base"]))).cast("long").alias("n_entropy"))
