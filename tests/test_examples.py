"""Example generation: the reference's randomized invariants (FIXTURES §2) and
the per-length MLM count table, plus collation and segment goldens."""
from pyspark.sql import functions as F

from textmill.operators import batching as B
from textmill.operators import examples as X
from textmill.operators import features as FT

N = 3000


def _paragraphs(spark):
    rows = [(0, 0, [10] * 100), (0, 1, [11] * 100), (1, 0, [20] * 100), (1, 1, [21] * 100), (2, 0, [30] * 100)]
    return spark.createDataFrame(rows, "paragraph_id long, idx long, ids array<int>")


def test_invariants(spark):
    index = X.prepare_paragraphs(_paragraphs(spark))
    ex = X.pretrain_examples(index, N, token_num=100, seed=3).collect()
    assert len(ex) == N
    follows = {10: 11, 20: 21}
    n_mask = n_msk = n_rand = n_pos = 0
    pairs = set()
    for r in ex:
        src, mlm, mask = r["src"], r["mlm"], r["mask"]
        assert len(src) == len(mlm) == len(mask) == 203
        assert (src[0], src[101], src[-1]) == (2, 3, 3)                       # 1
        assert not (mask[0] or mask[101] or mask[-1])
        a, b = src[1], src[102]
        assert r["nsp"] == (follows.get(a) == b)                               # 2
        assert src[1:101] == [a] * 100 and src[102:202] == [b] * 100          # 3
        assert all(m == s or k for s, m, k in zip(src, mlm, mask))            # 4
        k = sum(mask)
        assert k == 30                                                         # 5
        n_mask += k
        n_msk += sum(1 for m, kk in zip(mlm, mask) if kk and m == 4)
        n_rand += sum(1 for s, m, kk in zip(src, mlm, mask) if kk and m != s and m != 4)
        assert all(5 <= m < 100 for s, m, kk in zip(src, mlm, mask) if kk and m != 4 and m != s)
        n_pos += r["nsp"]
        pairs.add((a, b))
    assert n_msk == 24 * N and n_rand == 3 * N                                 # 6, 7 (exact counts)
    assert 0.45 < n_pos / N < 0.55                                             # 8
    assert len(pairs) >= 6  # all ordered pairs of distinct first tokens that the 3 paragraphs allow (9)


def _counts(spark, lengths):
    rows = [(i, True, [7] * (n - 3 - n // 2), [8] * (n // 2)) for i, n in enumerate(lengths)]
    pairs = spark.createDataFrame(rows, "example_id long, nsp boolean, a array<int>, b array<int>")
    out = X.mask_tokens(pairs, token_num=50).orderBy("example_id").collect()
    res = []
    for r in out:
        k = sum(r["mask"])
        msk = sum(1 for m, kk in zip(r["mlm"], r["mask"]) if kk and m == 4)
        same = sum(1 for s, m, kk in zip(r["src"], r["mlm"], r["mask"]) if kk and m == s)
        res.append((len(r["src"]), k, msk, same, k - msk - same))
    return res


def test_mlm_count_table(spark):
    got = _counts(spark, [6, 7, 13, 14, 19, 20, 40, 60, 100, 203])
    want = {6: (1, 1, 0, 0), 7: (1, 0, 0, 1), 13: (1, 0, 0, 1), 14: (2, 1, 0, 1), 19: (2, 1, 0, 1),
            20: (3, 2, 0, 1), 40: (6, 4, 0, 2), 60: (9, 7, 0, 2), 100: (15, 12, 1, 2), 203: (30, 24, 3, 3)}
    for n, k, msk, same, rnd in got:
        assert (k, msk, same, rnd) == want[n], n


def test_pad_collate_golden(spark):
    rows = [(0, 0, list(range(5, 19)), [False] * 14), (1, 0, list(range(5, 15)), [True] * 10),
            (2, 0, list(range(5, 17)), [False] * 12)]
    df = spark.createDataFrame(rows, "example_id long, batch_id long, src array<int>, mask array<boolean>")
    out = {r["example_id"]: r for r in B.pad_collate(df, cols=("src", "mask")).collect()}
    assert all(len(r["src"]) == 14 and len(r["mask"]) == 14 for r in out.values())
    assert out[1]["src"][10:] == [0] * 4 and out[1]["mask"][10:] == [False] * 4


def test_segment_ids_golden(spark):
    df = spark.createDataFrame([([2, 10, 11, 3, 12, 3, 0, 0],)], "src array<int>")
    assert FT.with_segment_ids(df).first()["segments"] == [0, 0, 0, 0, 1, 1, 2, 2]


def test_negative_rejects_true_next_content(spark):
    # paragraph 1 repeats the true successor of paragraph 0's first sentence
    rows = [(0, 0, [10]), (0, 1, [11]), (1, 0, [11]), (1, 1, [11]), (1, 2, [12])]
    index = X.prepare_paragraphs(spark.createDataFrame(rows, "paragraph_id long, idx long, ids array<int>"))
    ex = X.sample_pairs(index, spark.range(0, 400).withColumnRenamed("id", "example_id"), seed=1).collect()
    for r in ex:
        if not r["nsp"] and r["a"] == [10]:
            assert r["b"] != [11]


def test_rank_select_over_many_copies(spark):
    """A paragraph that repeats one line: the r-th other line is found in one probe."""
    from pyspark.sql import functions as F
    from textmill.operators import examples as X
    rows = [(0, i, [9]) for i in range(3)] + [(1, i, [9] if i % 7 else [100 + i]) for i in range(3000)]
    index = X.prepare_paragraphs(spark.createDataFrame(rows, "paragraph_id long, idx long, ids array<int>"))
    assert index["blocks"].agg(F.max(F.size("gs"))).first()[0] <= X.COPY_BLOCK < index["groups"].agg(F.max("m")).first()[0]
    got = [r for r in X.sample_coordinates(index, spark.range(400).withColumnRenamed("id", "example_id")).collect() if r.m and r.rb == 1]
    others = [i for i in range(3000) if i % 7 == 0]
    assert got and all(r.sb == others[r.r] for r in got)


def test_count_not_above(spark):
    from pyspark.sql import functions as F
    from textmill.operators.examples import count_not_above
    df = spark.createDataFrame([([], 3), ([1, 1, 4, 9], 0), ([1, 1, 4, 9], 1), ([1, 1, 4, 9], 8), ([1, 1, 4, 9], 9)], "v array<long>, r long")
    assert [r[0] for r in df.select(count_not_above(F.col("v"), F.col("r"))).collect()] == [0, 0, 2, 3, 4]


def test_audit_against_the_source_finds_planted_faults(spark):
    from pyspark.sql import functions as F
    enc = [(p, i, [10 * (p + 1) + i] * 5) for p in range(4) for i in range(3 + p)] + [(9, i, [77]) for i in range(4)] + [(10, 0, [])]
    encoded = spark.createDataFrame(enc, "paragraph_id long, idx long, ids array<int>")
    index = X.prepare_paragraphs(encoded)
    ex = X.pretrain_examples(index, 400, 100)
    pairs = X.unpacked(ex)
    got = X.source_audit(pairs, index, sketch=True).first()
    rows = pairs.collect()
    texts = {}
    for p, i, ids in enc:
        texts.setdefault(p, []).append(tuple(ids))
    nxt = [(a, b) for t in texts.values() for a, b in zip(t, t[1:])]
    every = [a for t in texts.values() for a in t]

    def counts(rows):
        always = {(a, b) for a, b in nxt if nxt.count((a, b)) == every.count(a)}
        pair = [(r["nsp"], (tuple(r["a"]), tuple(r["b"]))) for r in rows]
        return (sum(n for n, _ in pair), sum(n and p not in nxt for n, p in pair), sum(not n for n, _ in pair),
                sum(not n and p in always for n, p in pair), len({p for _, p in pair}))

    names = ("n_positive", "n_positive_not_next", "n_negative", "n_negative_always_next", "n_distinct_pairs")
    assert tuple(got[c] for c in names) == counts(rows)
    assert got["n_positive_not_next"] == got["n_negative_always_next"] == 0
    assert abs(got["n_distinct_sketch"] - got["n_distinct_pairs"]) <= 0.05 * got["n_distinct_pairs"]
    # a tenth of the labels turned round, and second sentences put in the place of the first
    wrong = pairs.withColumn("nsp", F.when(F.col("example_id") % 10 == 0, ~F.col("nsp")).otherwise(F.col("nsp")))
    wrong = wrong.withColumn("a", F.when(F.col("example_id") % 7 == 0, F.col("b")).otherwise(F.col("a")))
    found = X.source_audit(wrong, index).first()
    assert tuple(found[c] for c in names) == counts(wrong.collect())
    assert found["n_positive_not_next"] > 0 and found["n_negative_always_next"] > 0
    assert tuple(X.source_audit(pairs.limit(0), index).first()[c] for c in names) == (0, 0, 0, 0, 0)


def test_masking_equals_the_plain_rule(spark):
    """Also for a row so long that its replacement ids pass 32 bits, and for both kinds of draws."""
    import hashlib
    rows = [(i, i % 2 == 0, [5 + (i * j) % 40 for j in range(i % 23)], [2, 9, 3][: i % 4]) for i in range(60)]
    rows.append((60, True, [7] * 150_000, [8]))
    pairs = spark.createDataFrame(rows, "example_id long, nsp boolean, a array<int>, b array<int>")

    def value(*key):
        return int(hashlib.md5("|".join(map(str, key)).encode()).hexdigest()[:13], 16)

    got = {r["example_id"]: r for r in X.mask_tokens(pairs, 50, seed=4).collect()}
    for i, nsp, a, b in rows:
        src = [2, *a, 3, *b, 3]
        free = [p for p, x in enumerate(src) if x not in (2, 3)]
        if not free:
            assert i not in got
            continue
        k = int(len(src) * 0.15)
        k, m, s = (1, 1, 0) if k == 0 or k > len(free) else (k, int(k * 0.8), int(k * 0.1))
        chosen = sorted(free, key=lambda p: (value(4, "mlm", i, p), p))[:k]
        want = list(src)
        for j, p in enumerate(chosen):
            if j < m:
                want[p] = 4
            elif j >= m + s:
                v = (value(4, "rtok", i) + (j - m - s) * 1000003) % 45
                want[p] = 5 + (v + (v + 5 == src[p])) % 45
        r = got[i]
        assert (r["nsp"], r["src"], r["mlm"]) == (nsp, src, want)
        assert [p for p, on in enumerate(r["mask"]) if on] == sorted(chosen)
    hashed = X.mask_tokens(pairs.where("example_id < 60"), 50, method="xxhash").collect()
    assert {r["example_id"]: sum(r["mask"]) for r in hashed} == {i: sum(got[i]["mask"]) for i in got if i < 60}


def test_stages_are_made_when_asked_for(spark, tmp_path):
    from textmill.plans import registry, registry_more
    sf = str(tmp_path)
    spark.createDataFrame([(i, f"one line {i}\nand the next\nthe end") for i in range(5)], "doc_id long, text string").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(4)], "doc_id long, quality int").write.parquet(f"{sf}/labels.parquet")
    registry_more.classification(spark, sf).count()
    st = registry.example_state(spark, sf)
    assert "enc" in st and "index" not in st and "examples" not in st
    assert "ids" not in st["index"]["sent"].columns and "pairs" not in st   # keys only


def test_position_draws_are_the_md5_ones():
    """Drawn for thousands of positions at once, a row of MD5 blocks each."""
    import hashlib

    from textmill.functions.rng import position_draws
    keys = ["0|mlm|1", "x" * 34, "x" * 35, "y" * 80, "0|mlm|" + "9" * 18, "é|mlm|7", ""]
    sizes = [12_000, 101, 11, 1001, 0, 5000, 3]
    want = [int(hashlib.md5(f"{k}|{p}".encode()).hexdigest()[:13], 16) for k, n in zip(keys, sizes) for p in range(n)]
    draws = position_draws()
    assert draws(keys, sizes).tolist() == want and draws([], []).tolist() == []


def test_masking_is_the_same_in_any_stretch(spark, monkeypatch):
    rows = [(i, i % 2 == 0, [10 + i % 7] * (1 + i % 40), [20] * (i % 5)) for i in range(300)]
    pairs = spark.createDataFrame(rows, "example_id long, nsp boolean, a array<int>, b array<int>")
    want = sorted(map(str, X.mask_tokens(pairs, 50, seed=4).collect()))
    monkeypatch.setattr(X, "DRAW_STRETCH", 37)
    assert sorted(map(str, X.mask_tokens(pairs, 50, seed=4).collect())) == want


def test_the_whole_audit_finds_planted_faults(spark):
    """also changed sentences, false labels and the number of different pairs; F13: rows with
    nulls or arrays of unequal lengths, which are counted one by one."""
    enc = [(p, i, [10 * (p + 1) + i] * 5) for p in range(4) for i in range(3 + p)]
    index = X.prepare_paragraphs(spark.createDataFrame(enc, "paragraph_id long, idx long, ids array<int>"))
    pairs = X.sample_pairs(index, spark.range(200).withColumnRenamed("id", "example_id"))
    examples = X.mask_tokens(pairs, 100)
    clean = X.example_audit(examples, 210, pairs, index).first()
    faults = ("n_special_masked", "n_changed_unmasked", "n_bad_shape", "n_source_changed", "n_positive_not_next", "n_negative_always_next")
    assert [clean[c] for c in faults] == [0] * 6 and clean["n_examples"] == 200 and clean["n_dropped"] == 10
    by_id = {r["example_id"]: r for r in pairs.collect()}
    assert clean["n_distinct_pairs"] == len({(tuple(r["a"]), tuple(r["b"])) for r in by_id.values()})
    rows = [r.asDict() for r in examples.orderBy("example_id").collect()]
    for i, r in enumerate(rows):
        r["src"], r["mlm"], r["mask"] = list(r["src"]), list(r["mlm"]), list(r["mask"])
        if i % 11 == 1:
            r["src"][2] += 1
        elif i % 11 == 2:
            r["mask"][0] = True
        elif i % 11 == 3:
            r["nsp"] = not r["nsp"]
        elif i % 11 == 4:
            r["mlm"].pop()
        elif i % 11 == 5:
            r["mlm"][3] = None
        elif i % 11 == 6:
            r["src"][-1] = 9
    rows[50]["mask"], rows[60]["src"], rows[70]["nsp"], rows[80]["src"], rows[80]["mlm"], rows[80]["mask"] = None, None, None, [], [], []
    faulty = spark.createDataFrame([tuple(r[c] for c in examples.columns) for r in rows], examples.schema)
    got = X.example_audit(faulty, pairs=pairs, index=index).first()
    z = [(r, list(zip(r["src"], r["mlm"] + [None], r["mask"])) if None not in (r["src"], r["mlm"], r["mask"]) else []) for r in rows]
    whole = [[(s, m, k) for s, m, k in t if m is not None] for _, t in z]
    assert got["n_special_masked"] == sum(any(s in (2, 3) and k for s, _, k in t) for _, t in z)
    assert got["n_changed_unmasked"] == sum(any(s != m and not k for s, m, k in t) for t in whole)
    assert got["n_bad_shape"] == sum(r["src"] is not None and (not r["src"] or r["src"][0] != 2 or r["src"][-1] != 3) for r in rows)
    n_mask = sum(sum(r["mask"] or []) for r in rows)
    assert got["mask_rate"] == round(n_mask / sum(len(r["src"] or []) for r in rows), 6)
    assert got["msk_share"] == round(sum(k and m == 4 for t in whole for _, m, k in t) / n_mask, 6)
    assert got["same_share"] == round(sum(k and m == s for t in whole for s, m, k in t) / n_mask, 6)
    assert got["random_share"] == round(sum(k and m not in (s, 4) for t in whole for s, m, k in t) / n_mask, 6)
    said = [r["nsp"] for r in rows if r["nsp"] is not None]
    assert got["positive_share"] == round(sum(said) / len(said), 6)
    packed = {i: [2, *r["a"], 3, *r["b"], 3] for i, r in by_id.items()}
    assert got["n_source_changed"] == sum(r["src"] != packed[r["example_id"]] for r in rows) > 30
    assert got["n_positive_not_next"] > 0 and got["n_distinct_pairs"] == clean["n_distinct_pairs"]
    none = X.example_audit(examples.limit(0), 3).first()
    assert (none["n_examples"], none["n_dropped"], none["n_special_masked"], none["positive_share"]) == (0, 3, None, None)


def test_distinct_pairs_by_content(spark):
    """equal sentences at different places are one; also where a place is taken twice."""
    rows = [(p, i, [5 + (p * i) % 3] * (1 + i % 2)) for p in range(5) for i in range(6)] + [(7, 0, []), (7, 1, [5])]
    ids = spark.range(300).withColumnRenamed("id", "example_id")
    for extra in ([], [(1, 1, [6]), (1, 1, [6]), (2, 1, [9])]):
        index = X.prepare_paragraphs(spark.createDataFrame(rows + extra, "paragraph_id long, idx long, ids array<int>"))
        assert index["repeated"] == bool(extra)
        every = [(tuple(r["a"]), tuple(r["b"])) for r in X.sample_pairs(index, ids).collect()]
        found = X.distinct_pairs(index, ids)
        got = [(tuple(r["a"]), tuple(r["b"])) for r in found.collect()]
        assert sorted(got) == sorted(set(every)) and len(got) < len(every)


def test_a_stage_that_is_read_once_is_not_written(spark, tmp_path):
    """Examples are made while they are read; written when asked for again."""
    from textmill.plans import registry
    sf = str(tmp_path)
    spark.createDataFrame([(i, f"one line {i}\nand the next\nthe end") for i in range(5)], "doc_id long, text string").write.parquet(f"{sf}/documents.parquet")
    first = sorted(map(tuple, registry.q_pretrain_examples(spark, sf).collect()))
    st = registry.example_state(spark, sf)
    assert "examples" not in st and "pairs" not in st and len(first) == 15
    again = sorted(map(tuple, registry.q_pretrain_examples(spark, sf).collect()))
    assert "examples" in st and again == first
    assert sorted(map(tuple, registry.q_pretrain_examples(spark, sf).collect())) == first
    assert registry.q_example_audit(spark, sf).first()["n_examples"] == 15
