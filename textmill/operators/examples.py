"""Sentence-pair + masked-token example generation.

Paragraphs are long-form sentence tables ``(paragraph_id, idx, ids)``. An
example id is the only input of an example: every random choice is a keyed
draw of ``(seed, salt, example_id, ...)``, so a batch or a streaming micro-batch
over the same ids yields the same rows, and re-run tasks recompute them exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.functions.constants import (CLS_ID, MASK_RATE, MSK_ID, MSK_SHARE, N_SPECIAL, RANDOM_ID_STRIDE, SAME_SHARE,
                                          SEP_ID)


def next_sentence(sentences: DataFrame) -> DataFrame:
    """Each sentence with its successor (null for the last). A self equi-join
    on ``(paragraph_id, idx + 1)`` — unique keys, so no hot group exists, unlike
    a ``lead`` window partitioned by paragraph."""
    nxt = sentences.select("paragraph_id", (F.col("idx") - 1).alias("idx"),
                           F.col("sentence").alias("next_sentence"))
    return sentences.join(nxt, ["paragraph_id", "idx"], "left").select(
        "paragraph_id", "idx", "sentence", "next_sentence")


def consecutive_pairs(sentences: DataFrame) -> DataFrame:
    """Every (sentence i, sentence i+1) of the same paragraph."""
    nxt = sentences.select("paragraph_id", (F.col("idx") - 1).alias("idx"), F.col("sentence").alias("second"))
    return (sentences.withColumnRenamed("sentence", "first")
                     .join(nxt, ["paragraph_id", "idx"])
                     .select("paragraph_id", "idx", "first", "second"))


# ----------------------------------------------------------- paragraph index --
def _seq_hash(col: str | F.Column, salt: str) -> F.Column:
    return F.xxhash64(F.lit(salt), F.col(col) if isinstance(col, str) else col)


def prepare_paragraphs(encoded: DataFrame) -> dict:
    """Index an encoded long-form corpus ``(paragraph_id, idx, ids)`` for sampling.

    Returns ``{'sent', 'seqs', 'lookup', 'groups', 'P', 'E', 'repeated'}``:

    * ``seqs``    ``(rank, idx, ids)`` — ``rank`` dense over paragraphs.
    * ``sent``    ``(rank, idx, h1, h2, nh1, nh2, g)`` — ``(h1, h2)`` a 128-bit content key;
      ``(nh1, nh2)`` the key of the next sentence (null for the last); ``g`` = ``idx`` minus
      the number of earlier sentences of the same paragraph with the same content. It is
      made of the keys alone; the ids are shuffled for ``seqs`` only.
    * ``lookup``  ``(kind, key, rank, n)``: ``kind='a'`` by rank over all
      paragraphs, ``kind='e'`` by rank over paragraphs with ≥ 2 sentences.
    * ``groups``  ``(rank, h1, h2, m, firsts)`` copies of a content inside a paragraph
      and the first ``g`` of each of their blocks.
    * ``blocks``  ``(rank, h1, h2, block, gs)``: the sorted ``g`` of ``COPY_BLOCK`` copies.
    * ``P``, ``E`` paragraph counts (two scalars); ``repeated``: is a place taken twice.

    Everything is written once as bucketed tables in the shared checkpoint
    folder: later example batches (and streaming micro-batches) reuse it.
    """
    from textmill.operators.index import dense_index, dense_index_within
    from textmill.session import write_bucketed

    sizes = encoded.groupBy("paragraph_id").agg(F.count(F.lit(1)).alias("n"))
    ranked = dense_index(sizes, ["paragraph_id"], out="rank")
    elig = dense_index(ranked.where(F.col("n") >= 2).select("paragraph_id", "rank", "n"),
                       ["paragraph_id"], out="erank")
    # Each lookup table is written bucketed on the key it is joined on, so an
    # example batch (or streaming micro-batch) shuffles only its own rows and
    # never the corpus again.
    parts = int(encoded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lookup = write_bucketed(
        ranked.select(F.lit("a").alias("kind"), F.col("rank").alias("key"), "rank", "n")
        .unionByName(elig.select(F.lit("e").alias("kind"), F.col("erank").alias("key"), "rank", "n")),
        parts, ["kind", "key"], "lookup")
    counts = lookup.groupBy("kind").count().collect()
    P = next((r["count"] for r in counts if r["kind"] == "a"), 0)
    E = next((r["count"] for r in counts if r["kind"] == "e"), 0)
    par = write_bucketed(ranked.select("rank", "n"), parts, ["rank"], "par")

    seqs = write_bucketed(encoded.join(ranked.select("paragraph_id", "rank"), "paragraph_id").select("rank", "idx", "ids"),
                          parts, ["rank", "idx"], "seqs")
    # a place that is taken twice must meet its successors with its ids, row by row
    repeated = not seqs.groupBy("rank", "idx").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).isEmpty()
    sent = seqs.select("rank", "idx", *(["ids"] if repeated else []),
                       _seq_hash("ids", "h1").alias("h1"), _seq_hash("ids", "h2").alias("h2"))
    nxt = sent.select("rank", (F.col("idx") - 1).alias("idx"), F.col("h1").alias("nh1"), F.col("h2").alias("nh2"))
    sent = sent.join(nxt, ["rank", "idx"], "left")
    sent = dense_index_within(sent, ["rank", "h1", "h2"], ["idx"], out="_ord")
    sent = write_bucketed(sent.withColumn("g", F.col("idx") - F.col("_ord")).drop("_ord"),
                          parts, ["rank", "idx"], "sent")
    if repeated:
        seqs, sent = sent.select("rank", "idx", "ids"), sent.drop("ids")
    # rank-select index of the copies (no token arrays): ``g`` never falls with the
    # copy's number, so blocks of consecutive copies are sorted, one after the other
    block = F.expr(f"(idx - g) div {COPY_BLOCK}").alias("block")
    blocks = write_bucketed(
        sent.groupBy("rank", "h1", "h2", block).agg(F.sort_array(F.collect_list("g")).alias("gs")),   # <= COPY_BLOCK
        parts, ["rank", "h1", "h2", "block"], "copies")
    groups = write_bucketed(
        blocks.groupBy("rank", "h1", "h2").agg(F.sum(F.size("gs")).alias("m"), F.sort_array(F.collect_list(F.col("gs")[0])).alias("firsts")),
        parts, ["rank", "h1", "h2"], "groups")
    return {"sent": sent, "seqs": seqs, "lookup": lookup, "par": par, "blocks": blocks, "groups": groups, "P": P, "E": E,
            "repeated": repeated}


COPY_BLOCK = 256


def count_not_above(values: F.Column, r: F.Column) -> F.Column:
    """How many entries of the sorted array ``values`` are at most ``r``: a binary
    search over powers of two."""
    steps = F.array(*[F.lit(1 << k) for k in range(30, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= F.size(values)) & (F.get(values, at + step - 1) <= r), at + step).otherwise(at))


# ---------------------------------------------------------------- sampling --
def _draw(seed, salt, method="md5"):
    from textmill.functions.rng import draw
    return draw(seed, salt, F.col("example_id"), method=method)


def _first_draws(index: dict, ids: DataFrame, seed: int, method: str) -> DataFrame:
    """E1 + J3 + J5: label, first paragraph (rank, size), second paragraph for negatives."""
    P, E = index["P"], index["E"]
    lookup = index["lookup"]
    ex = ids.select(
        "example_id",
        (_draw(seed, "nsp", method) % 2 == 1).alias("nsp"),
        _draw(seed, "p0", method).alias("u0"), _draw(seed, "p1", method).alias("u1"),
        _draw(seed, "s0", method).alias("us0"), _draw(seed, "s1", method).alias("us1"))
    if E == 0:
        ex = ex.where(~F.col("nsp"))
    if P < 2:
        ex = ex.where(F.col("nsp"))
    ex = ex.select("*",
                   F.when(F.col("nsp"), F.lit("e")).otherwise(F.lit("a")).alias("kind"),
                   F.when(F.col("nsp"), F.col("u0") % F.lit(max(E, 1)))
                    .otherwise(F.col("u0") % F.lit(max(P, 1))).alias("key"))
    # paragraph of the first sentence (by eligible rank for positives)
    ex = ex.join(lookup, ["kind", "key"]).select(
        "example_id", "nsp", "us0", "us1", F.col("rank").alias("r0"), F.col("n").alias("n0"),
        F.when(~F.col("nsp"), (F.col("rank") + 1 + F.col("u1") % F.lit(max(P - 1, 1))) % F.lit(max(P, 1)))
         .alias("r1"))
    return ex


def negative_paragraphs(index: dict, ids: DataFrame, seed: int = 0, method: str = "md5") -> DataFrame:
    """``(example_id, r0, r1)`` — two different paragraphs per negative example."""
    return _first_draws(index, ids, seed, method).where(~F.col("nsp")).select("example_id", "r0", "r1")


def sample_coordinates(index: dict, ids: DataFrame, seed: int = 0, method: str = "md5") -> DataFrame:
    """E1-E3 (J3, J5, J6): sentence coordinates of each example id.

    Positive (``nsp``): uniform paragraph with ≥ 2 sentences, uniform ``i``,
    pair ``(i, i+1)``. Negative: uniform ``p0``, ``p1 = (p0 + 1 + u % (P-1)) % P``
    (two different paragraphs, no cross join), uniform sentence of ``p0`` and a
    uniform sentence of ``p1`` among those whose content differs from the true
    successor of the first — the reference's rejection loop as one exact draw.
    Examples with no valid second sentence are dropped (the reference loops).

    Returns ``(example_id, nsp, r0, s0, rb, sb, m, r)``; ``m`` copies of the
    true successor in ``p1``, ``r`` the rank among valid sentences.
    """
    sent, lookup, groups = index["sent"], index["lookup"], index["groups"]
    ex = _first_draws(index, ids, seed, method)
    all_par = index["par"].select(F.col("rank").alias("r1"), F.col("n").alias("n1"))
    ex = ex.join(all_par, "r1", "left")
    # divisors are kept >= 1 in both branches: under ANSI mode an untaken
    # branch may still be evaluated
    ex = ex.withColumn("s0", F.when(F.col("nsp"), F.col("us0") % F.greatest(F.col("n0") - 1, F.lit(1)))
                              .otherwise(F.col("us0") % F.greatest(F.col("n0"), F.lit(1))))
    pos = ex.where(F.col("nsp")).select("example_id", "nsp", "r0", "s0", F.col("r0").alias("rb"),
                                        (F.col("s0") + 1).alias("sb"), F.lit(0).cast("long").alias("m"),
                                        F.lit(None).cast("long").alias("r"))
    # content key of the first sentence's true successor (keys only, no arrays)
    nh = sent.select(F.col("rank").alias("r0"), F.col("idx").alias("s0"), "nh1", "nh2")
    neg = ex.where(~F.col("nsp")).join(nh, ["r0", "s0"])
    g = groups.select(F.col("rank").alias("r1"), F.col("h1").alias("nh1"), F.col("h2").alias("nh2"), "m", "firsts")
    neg = (neg.join(g, ["r1", "nh1", "nh2"], "left")
              .withColumn("m", F.coalesce(F.col("m"), F.lit(0)).cast("long"))
              .withColumn("valid", F.col("n1") - F.col("m"))
              .where(F.col("valid") > 0)
              .withColumn("r", F.col("us1") % F.greatest(F.col("valid"), F.lit(1))))
    plain = neg.where(F.col("m") == 0).select("example_id", "nsp", "r0", "s0", F.col("r1").alias("rb"),
                                               F.col("r").alias("sb"), "m", "r")
    # rare: the successor's content occurs in p1; skip its copies. With g_j =
    # q_j - j (q_j the copies' positions), the r-th valid index is r + #{g_j <= r}.
    # One probe of the block that holds r, whatever the number of copies.
    hit = neg.where(F.col("m") > 0).withColumn("block", (count_not_above(F.col("firsts"), F.col("r")) - 1).cast("long"))
    blocks = index["blocks"].select(F.col("rank").alias("r1"), F.col("h1").alias("nh1"), F.col("h2").alias("nh2"), "block", "gs")
    skip = F.when(F.col("block") < 0, F.lit(0)).otherwise(
        F.col("block") * COPY_BLOCK + count_not_above(F.coalesce("gs", F.array().cast("array<long>")), F.col("r")))
    skipped = (hit.join(blocks, ["r1", "nh1", "nh2", "block"], "left")
                  .select("example_id", "nsp", "r0", "s0", F.col("r1").alias("rb"), (F.col("r") + skip).alias("sb"), "m", "r"))
    return pos.unionByName(plain).unionByName(skipped)


def sample_pairs(index: dict, ids: DataFrame, seed: int = 0, method: str = "md5") -> DataFrame:
    """Coordinates plus the two token sequences: ``(example_id, nsp, a, b)``."""
    seqs = index["seqs"]
    c = sample_coordinates(index, ids, seed, method)
    a = seqs.select(F.col("rank").alias("r0"), F.col("idx").alias("s0"), F.col("ids").alias("a"))
    b = seqs.select(F.col("rank").alias("rb"), F.col("idx").alias("sb"), F.col("ids").alias("b"))
    return c.join(a, ["r0", "s0"]).join(b, ["rb", "sb"]).select("example_id", "nsp", "a", "b")


def distinct_pairs(index: dict, ids: DataFrame, seed: int = 0, method: str = "md5") -> DataFrame:
    """The different ``(a, b)`` of ``sample_pairs``. All examples are compared by the 128-bit content
    keys of their places; the tokens are looked up for one example of each pair only, so they
    are not shuffled to be compared."""
    if index["repeated"]:       # a place does not tell its tokens
        return sample_pairs(index, ids, seed, method).select("a", "b").distinct()
    key = index["sent"].select("rank", "idx", "h1", "h2")
    c = sample_coordinates(index, ids, seed, method).select("r0", "s0", "rb", "sb")
    a = key.select(F.col("rank").alias("r0"), F.col("idx").alias("s0"), "h1", "h2")
    b = key.select(F.col("rank").alias("rb"), F.col("idx").alias("sb"), F.col("h1").alias("nh1"), F.col("h2").alias("nh2"))
    one = (c.join(a, ["r0", "s0"]).join(b, ["rb", "sb"]).groupBy("h1", "h2", "nh1", "nh2")
           .agg(F.min(F.struct("r0", "s0", "rb", "sb")).alias("_c")).select("_c.*"))
    seqs = index["seqs"]
    return (one.join(seqs.select(F.col("rank").alias("r0"), F.col("idx").alias("s0"), F.col("ids").alias("a")), ["r0", "s0"])
            .join(seqs.select(F.col("rank").alias("rb"), F.col("idx").alias("sb"), F.col("ids").alias("b")), ["rb", "sb"]).select("a", "b"))


def masked_positions(examples: DataFrame) -> DataFrame:
    """One row per masked position ``(example_id, pos, token, masked_token)``."""
    z = F.arrays_zip(F.col("src").alias("token"), F.col("mlm").alias("masked_token"), F.col("mask").alias("k"))
    return (examples.select("example_id", F.posexplode(z).alias("pos", "t"))
                    .where(F.col("t.k"))
                    .select("example_id", F.col("pos").cast("int").alias("pos"),
                            F.col("t.token").alias("token"), F.col("t.masked_token").alias("masked_token")))


# ----------------------------------------------------------------- masking --
_BIG = (1 << 62)
DRAW_STRETCH = 1 << 18      # positions whose draws are made together


def pair_pack(a: F.Column, b: F.Column) -> F.Column:
    """``[CLS] a [SEP] b [SEP]``."""
    return F.concat(F.array(F.lit(2)), a, F.array(F.lit(3)), b, F.array(F.lit(3)))


def special_mask(src: F.Column) -> F.Column:
    """P5: token is CLS or SEP, by value."""
    return F.transform(src, lambda x: x.isin(2, 3))


def _masker(n_special: int, span: int, md5: bool):
    """``mapInArrow`` over ``(key, draws, base, payload..., src)``: appends ``mlm`` and ``mask``.
    ``draws`` is one number per position or, with ``md5``, null: the draws are then the
    first 52 bits of the MD5 of ``key|position``. Nested, so that it is shipped by value."""
    import math

    from textmill.functions.rng import position_draws

    cls, sep, msk, big = CLS_ID, SEP_ID, MSK_ID, _BIG
    mask_rate, msk_share, same_share, stride = MASK_RATE, MSK_SHARE, SAME_SHARE, RANDOM_ID_STRIDE
    draws, stretch = position_draws(), DRAW_STRETCH

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            src = batch.column("src")
            flat = src.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(src.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
            given = None if md5 else batch.column("_draws").flatten().to_numpy(zero_copy_only=False)
            mlm, mask = flat.astype(np.int32), np.zeros(len(flat), dtype=bool)
            special = (flat == cls) | (flat == sep)
            keys = batch.column("_key").to_pylist()
            begin = first = upto = 0
            for row, (base, end) in enumerate(zip(batch.column("_base").to_pylist(), ends.tolist())):
                size = end - begin
                if md5:
                    if end > upto:      # the draws of a stretch of rows
                        last = max(row + 1, int(np.searchsorted(ends, begin + stretch, side="right")))
                        given, first, upto = draws(keys[row:last], np.diff(ends[row:last], prepend=begin)), begin, int(ends[last - 1])
                    d = given[begin - first:end - first]
                else:
                    d = given[begin:end].copy()
                own = special[begin:end]
                d[own] = big                            # behind all others; a stable sort keeps their order
                k, content = math.floor(size * mask_rate), size - int(own.sum())
                fallback = k == 0 or k > content
                n_msk = 1 if fallback else math.floor(k * msk_share)
                n_same = 0 if fallback else math.floor(k * same_share)
                chosen = begin + np.argsort(d, kind="stable")[:1 if fallback else k]
                mask[chosen] = True
                mlm[chosen[:n_msk]] = msk
                other = chosen[n_msk + n_same:]
                if len(other):
                    v = (base + np.arange(len(other), dtype=np.int64) * stride) % span
                    v = np.where(v + n_special == flat[other], (v + 1) % span, v)
                    mlm[other] = v + n_special
                begin = end
            offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("example_id"), src, pa.ListArray.from_arrays(offsets, pa.array(mlm, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(mask)), batch.column("nsp")], ["example_id", "src", "mlm", "mask", "nsp"])

    return run


def mask_tokens(pairs: DataFrame, token_num: int, seed: int = 0, method: str = "md5") -> DataFrame:
    """Choose ``k = floor(len * 0.15)`` content positions uniformly without
    replacement (a keyed sort inside the row, no shuffle); the first
    ``floor(.8k)`` become MSK, the next ``floor(.1k)`` stay, the rest get a random
    id in ``[5, token_num)`` different from the original. ``k = 0`` or more than
    the content positions → exactly one content position, MSK. Rows without any
    content position are dropped (the reference divides by zero).

    ``pairs``: ``(example_id, nsp, a, b)`` → ``(example_id, src, mlm, mask, nsp)``. The
    rows are masked in Arrow batches: a lambda over an array is interpreted per position.
    """
    span = token_num - N_SPECIAL
    df = pairs.select("example_id", pair_pack(F.col("a"), F.col("b")).alias("src"), "nsp")
    has_content = F.exists("src", lambda x: ~x.isin(CLS_ID, SEP_ID))    # ends at the first one
    salted = F.concat_ws("|", F.lit(str(seed)), F.lit("mlm"), F.col("example_id").cast("string"))
    draws = F.lit(None).cast("array<bigint>")
    if method != "md5":
        draws = F.transform(F.sequence(F.lit(0), F.size("src") - 1), lambda p: F.xxhash64(
            F.lit(str(seed)), F.lit("mlm"), F.col("example_id"), p).bitwiseAND(F.lit((1 << 52) - 1)))
    keyed = df.where(has_content).select("example_id", "src", "nsp", salted.alias("_key"), draws.alias("_draws"),
                                           (_draw(seed, "rtok", method) % F.lit(span)).cast("bigint").alias("_base"))
    schema = T.StructType([df.schema["example_id"], T.StructField("src", T.ArrayType(T.IntegerType())),
                           T.StructField("mlm", T.ArrayType(T.IntegerType())), T.StructField("mask", T.ArrayType(T.BooleanType())),
                           df.schema["nsp"]])
    return keyed.mapInArrow(_masker(N_SPECIAL, span, method == "md5"), schema)


def pretrain_examples(index: dict, n: int, token_num: int, seed: int = 0, start: int = 0,
                      method: str = "md5") -> DataFrame:
    """``n`` examples with ids ``start .. start+n-1``."""
    ids = index["seqs"].sparkSession.range(start, start + n).withColumnRenamed("id", "example_id")
    return examples_for_ids(index, ids, token_num, seed, method)


def examples_for_ids(index: dict, ids: DataFrame, token_num: int, seed: int = 0,
                     method: str = "md5") -> DataFrame:
    return mask_tokens(sample_pairs(index, ids, seed, method), token_num, seed, method)


def epoch_assign(examples: DataFrame, steps: int = 2000, batch_size: int = 16) -> DataFrame:
    """``epoch = floor(id / (steps*batch))``, ``step`` and ``slot`` inside it."""
    per_epoch = steps * batch_size
    eid = F.col("example_id")
    return examples.select("*", F.floor(eid / per_epoch).cast("long").alias("epoch"),
                           F.floor((eid % per_epoch) / batch_size).cast("long").alias("step"),
                           (eid % batch_size).cast("long").alias("slot"))


AUDIT_COUNTS = ["n_examples", "n_special_masked", "n_changed_unmasked", "n_bad_shape", "n_mask", "n_tokens", "n_msk", "n_same",
                "n_rand", "n_nsp", "n_positive"]


def _auditor():
    """``mapInArrow`` over ``(src, mlm, mask, nsp)``: ``AUDIT_COUNTS`` of each batch. Rows with nulls or
    arrays of unequal lengths are counted one by one; a comparison with a missing value holds never."""
    special, msk, first, last = (CLS_ID, SEP_ID), MSK_ID, CLS_ID, SEP_ID

    def one_by_one(rows):
        from itertools import zip_longest

        out = [0] * 8
        for r in rows:
            src, mlm, mask = r["src"], r["mlm"], r["mask"]
            z = [] if None in (src, mlm, mask) else list(zip_longest(src, mlm, mask))
            known = [(s, m, k) for s, m, k in z if s is not None and m is not None]
            out[0] += any(s in special and k for s, _, k in z)
            out[1] += any(s != m and k is False for s, m, k in known)
            out[2] += src is not None and (not src or src[0] != first or src[-1] != last)
            out[3] += sum(k is True for k in mask or [])
            out[4] += len(src or [])
            out[5] += sum(k is True and m == msk for _, m, k in z)
            out[6] += sum(k is True and m == s for s, m, k in known)
            out[7] += sum(k is True and m not in (s, msk) for s, m, k in known)
        return out

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            n, nsp = batch.num_rows, batch.column("nsp")
            odd = np.zeros(n, dtype=bool)
            size = [pc.list_value_length(batch.column(c)) for c in ("src", "mlm", "mask")]
            for c, k in zip(("src", "mlm", "mask"), size):
                odd |= pc.fill_null(pc.not_equal(k, size[0]), True).to_numpy(zero_copy_only=False)
                nulls = batch.column(c).flatten().is_null().to_numpy(zero_copy_only=False)
                if nulls.any():
                    odd[np.repeat(np.arange(n), k.fill_null(0).to_numpy(zero_copy_only=False))[nulls]] = True
            counts = one_by_one(batch.filter(pa.array(odd)).to_pylist() if odd.any() else [])
            even = batch.filter(pa.array(~odd)) if odd.any() else batch
            sizes = even.column("src").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            src, mlm, mask = (even.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("src", "mlm", "mask"))
            ends = np.cumsum(sizes)

            def rows_with(found):      # rows that hold a position where it is so
                return len(np.unique(np.searchsorted(ends, np.nonzero(found)[0], side="right")))

            same, is_msk, filled = src == mlm, mlm == msk, sizes > 0
            shape_bad = ~filled
            shape_bad[filled] = (src[(ends - sizes)[filled]] != first) | (src[ends[filled] - 1] != last)
            mine = [rows_with(((src == special[0]) | (src == special[1])) & mask), rows_with(~same & ~mask), int(shape_bad.sum()),
                    int(mask.sum()), len(src), int((mask & is_msk).sum()), int((mask & same).sum()), int((mask & ~same & ~is_msk).sum())]
            row = [n, *(int(x) + y for x, y in zip(counts, mine)), n - nsp.null_count, pc.sum(nsp).as_py() or 0]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in row], names)

    names = list(AUDIT_COUNTS)
    return run


def example_audit(examples: DataFrame, requested: int | None = None, pairs: DataFrame | None = None,
                  index: dict | None = None) -> DataFrame:
    """Violation counts and rates over examples ``(example_id, src, mlm, mask, nsp)``;
    with ``requested`` also how many of the requested examples were dropped
    because no valid paragraph, second sentence or content exists for them.

    With the ``pairs`` they were made of and the paragraphs' ``index`` the audit is the whole one: are
    the sentences in ``src`` unchanged, are the labels true (``source_audit``), and how many
    different pairs are there. The counts are taken in Arrow batches."""
    sums = examples.select("src", "mlm", "mask", "nsp").mapInArrow(_auditor(), ", ".join(f"{c} long" for c in AUDIT_COUNTS)).agg(
        *[F.sum(c).alias(c) for c in AUDIT_COUNTS])
    n = F.coalesce("n_examples", F.lit(0)).cast("long")
    counts = [] if requested is None else [F.lit(requested).cast("long").alias("n_requested"),
                                           (F.lit(requested) - n).cast("long").alias("n_dropped")]

    def share(part, whole):
        return F.round(F.col(part) / F.col(whole), 6)

    row = sums.select(
        *counts, n.alias("n_examples"), "n_special_masked", "n_changed_unmasked", "n_bad_shape",
        share("n_mask", "n_tokens").alias("mask_rate"), share("n_msk", "n_mask").alias("msk_share"),
        share("n_same", "n_mask").alias("same_share"), share("n_rand", "n_mask").alias("random_share"),
        F.round(F.try_divide(F.col("n_positive"), F.col("n_nsp")), 6).alias("positive_share"))
    if pairs is None:
        return row
    packed = pair_pack(F.col("a"), F.col("b"))
    given = pairs.select("example_id", *_pair_keys(), _seq_hash(packed, "h1").alias("p1"), _seq_hash(packed, "h2").alias("p2"))
    made = examples.select("example_id", "nsp", _seq_hash("src", "h1").alias("e1"), _seq_hash("src", "h2").alias("e2"))
    changed = (F.col("p1") != F.col("e1")) | (F.col("p2") != F.col("e2"))
    # keys only: no token is shuffled; an example without its pair is a changed one
    asked = made.join(given, "example_id", "left").select("nsp", *PAIR_KEY, F.coalesce(changed, F.lit(True)).cast("long").alias("changed"))
    source = _audited(asked, index)
    return row.join(F.broadcast(source.select("n_source_changed", "n_positive_not_next", "n_negative_always_next", "n_distinct_pairs")))


def unpacked(examples: DataFrame) -> DataFrame:
    """``(example_id, nsp, a, b)`` from ``src`` = CLS a SEP b SEP; sentences hold no SEP."""
    at = F.array_position("src", SEP_ID).cast("int")
    return examples.select("example_id", "nsp", F.slice("src", F.lit(2), F.greatest(at - 2, F.lit(0))).alias("a"),
                           F.slice("src", at + 1, F.greatest(F.size("src") - at - 1, F.lit(0))).alias("b"))


def source_audit(pairs: DataFrame, index: dict, sketch: bool = False) -> DataFrame:
    """A9 against the paragraphs: are the labels of ``(nsp, a, b)`` true?

    A positive pair must stand somewhere as a sentence and its successor; a negative one is
    false where every occurrence of its first sentence is followed by the second.
    One row: ``n_positive, n_positive_not_next, n_negative, n_negative_always_next,
    n_distinct_pairs`` (of ``a`` and ``b``); with ``sketch`` also
    ``n_distinct_sketch``, the same from a mergeable HLL sketch.

    Equal pairs are added up before they are joined on their 128-bit content keys, and
    so are equal sentences, so a pair or sentence that stands everywhere is a row."""
    return _audited(pairs.select("nsp", *_pair_keys(), F.lit(0).cast("long").alias("changed")), index, sketch).drop("n_source_changed")


PAIR_KEY = ["h1", "h2", "nh1", "nh2"]


def _pair_keys() -> list[F.Column]:
    """128-bit content keys of ``a`` and ``b``."""
    return [_seq_hash("a", "h1").alias("h1"), _seq_hash("a", "h2").alias("h2"),
            _seq_hash("b", "h1").alias("nh1"), _seq_hash("b", "h2").alias("nh2")]


def _audited(asked: DataFrame, index: dict, sketch: bool = False) -> DataFrame:
    """``source_audit`` of ``asked(nsp, h1, h2, nh1, nh2, changed)``, and the sum of ``changed``."""
    key = PAIR_KEY
    counted = asked.groupBy(*key).agg(F.count_if("nsp").alias("pos"), F.count_if(~F.col("nsp")).alias("neg"), F.sum("changed").alias("changed"))
    sent = index["sent"].select(*key)
    follows = sent.where(F.col("nh1").isNotNull()).groupBy(*key).agg(F.count(F.lit(1)).alias("n_next"))
    known = counted.join(follows, key, "left")
    # only negatives that follow somewhere need the occurrences of their first sentence
    doubtful = known.where((F.col("neg") > 0) & F.col("n_next").isNotNull())
    occurs = sent.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_a"))
    false_neg = doubtful.join(occurs, ["h1", "h2"]).where(F.col("n_next") == F.col("n_a")).agg(
        F.coalesce(F.sum("neg"), F.lit(0)).alias("n_negative_always_next"))
    extra = [F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64(*key))).alias("n_distinct_sketch")] if sketch else []

    def total(col):
        return F.coalesce(F.sum(col), F.lit(0))

    sums = known.agg(total("changed").alias("n_source_changed"), total("pos").alias("n_positive"),
                     total(F.when(F.col("n_next").isNull(), F.col("pos"))).alias("n_positive_not_next"),
                     total("neg").alias("n_negative"), F.count(F.lit(1)).alias("n_distinct_pairs"), *extra)
    return sums.join(F.broadcast(false_neg))  # one row each
