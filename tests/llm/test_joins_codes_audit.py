"""Operators 11 to 13 and the mended ones against plain-Python versions."""

import math
import pickle
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import LONG, SCHEMA, empty, odd, real  # noqa: F401

from textmill.llm import divergence_audit as D
from textmill.llm import ngram_join as N
from textmill.llm import packing
from textmill.llm import vector_codes as V
from textmill.llm.decontaminate import Index, find_leaks, op7_decontamination, words_of
from textmill.llm.packing import VOCABULARY, word_ids
from textmill.llm.quality_rules import op10_quality_rules

KEY = lambda r: tuple((x is None, str(x)) for x in r)


@pytest.fixture(params=["odd", "real"])
def docs(request):
    return request.getfixturevalue(request.param)


# ------------------------------------------------------------- n-gram join

def test_jaccard_join(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = [tuple(r) for r in N.op12_ngram_jaccard_join(docs).collect()]
    assert sorted(got, key=KEY) == sorted(brute.jaccard(rows), key=KEY)


def test_jaccard_join_clusters(spark):
    """Copies, near copies at the limit, chains, null and repeated ids, one hot cluster."""
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(12):
        base = rnd.choices(vocab, k=rnd.randrange(5, 90))
        for _ in range(rnd.randrange(1, 14)):
            t = list(base)
            for _ in range(rnd.randrange(0, 3)):
                t[rnd.randrange(len(t))] = rnd.choice(vocab)
            base = t if rnd.random() < 0.5 else base     # chains drift away
            texts.append(" ".join(t))
    hot = " ".join(rnd.choices(vocab, k=80))
    texts += [hot + f" tail{i}" for i in range(150)] + ["a b c", "A b\tC", "", " ", None, "a b c d", "İ x"]
    rows = [(None if i % 17 == 0 else i // 2 if i % 5 == 0 else i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows + rows[:9], "doc_id long, text string").repartition(4)
    got = [tuple(r) for r in N.op12_ngram_jaccard_join(df).collect()]
    assert sorted(got, key=KEY) == sorted(brute.jaccard(rows + rows[:9]), key=KEY)


def test_jaccard_join_leaves_few_pairs_of_a_cluster(spark, monkeypatch):
    """One word of a text changed: places at most three words apart link, all others are
    near misses. The cluster is joined by nearest partners, not by all its pairs."""
    rnd = random.Random(8)
    base, rows, made = [f"w{i}" for i in range(80)], [], []
    for i in range(400):
        t = list(base)
        t[rnd.randrange(80)] = f"x{i}"
        rows.append((i, " ".join(t)))
    open_pairs = N.open_pairs

    def counted(*a):
        made.append(N.written(open_pairs(*a), "test-pairs"))
        return made[-1]
    monkeypatch.setattr(N, "open_pairs", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [tuple(r) for r in N.op12_ngram_jaccard_join(df).collect()]
    assert sorted(got, key=KEY) == sorted(brute.jaccard(rows), key=KEY)
    assert sum(x.count() for x in made) <= 10 * len(rows)


def test_jaccard_join_any_table_of_counts_and_blocks(spark, real, monkeypatch):  # noqa: F811
    want = sorted(map(tuple, N.op12_ngram_jaccard_join(real).collect()))
    for name, value in (("COUNTERS", 3), ("POSTS", 500), ("HOT_LIST", 5), ("SHORT_LIST", 2), ("BLOCK", 3), ("CHUNK_BYTES", 2000)):
        monkeypatch.setattr(N, name, value)
    assert sorted(map(tuple, N.op12_ngram_jaccard_join(real).collect())) == want


def test_prefix_and_limit():
    for a in range(1, 60):
        for b in range(a, 60):
            for common in range(a + 1):
                if N.linked(common, a, b, 80):
                    # what is outside one prefix cannot hold all common shingles
                    assert common > a - N.prefix_length(a, 80) and common > b - N.prefix_length(b, 80)
                assert N.linked(common, a, b, 80) == (100 * common >= 80 * (a + b - common))


# --------------------------------------------------------- divergence audit

def test_divergence(docs):
    rows = [(r.text, r.lang, r.source) for r in docs.collect()]
    got = sorted(map(tuple, D.op13_source_divergence_audit(docs).collect()))
    assert got == brute.divergence(rows)


def test_bytes_split_at_what_parts_terms():
    import re
    text = "".join(f"{chr(c)}aZ{chr(c)}{chr(c)}" for c in range(0x3000) if not 0xD800 <= c < 0xE000) + "\U0001F600x中"
    want = [w.translate({c: c + 32 for c in range(65, 91)}).encode() for w in re.findall(D.TERM, text)]
    assert text.encode().translate(D._SPLIT).split() == want


def test_divergence_small_groups(spark, monkeypatch):
    """Groups without terms, a language without kept terms, ties, stripes and salts."""
    rnd = random.Random(3)
    words = ["zeta", "Alpha", "été", "beta", "Ω", "x", "İd", "naïve"]
    rows = [(" ".join(rnd.choices(words, k=rnd.randrange(0, 9))), rnd.choice(["en", "fr", None]), rnd.choice(["a", "b", "c", None, "é"]))
            for _ in range(200)] + [("once", "de", "a"), (None, "de", "b"), ("1 2 3", "en", "digits"), ("one", "it", "only")]
    df = spark.createDataFrame([(i, *r, "clash") for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, term string").repartition(3)
    want = brute.divergence(rows)
    assert sorted(map(tuple, D.op13_source_divergence_audit(df).collect())) == want
    monkeypatch.setattr(D, "CELLS", 4)
    monkeypatch.setattr(D, "STRIPE", 8)
    monkeypatch.setattr(D, "FLUSH", 5)
    assert sorted(map(tuple, D.op13_source_divergence_audit(df).collect())) == want


def test_skyband_is_exact_and_merges():
    rnd = np.random.default_rng(1)
    for k in (1, 3, 10):
        g, lang, order = rnd.integers(0, 12, 900), rnd.integers(0, 12, 900), rnd.permutation(900)
        dom = ((g[None, :] >= g[:, None]) & (lang[None, :] <= lang[:, None]) & (order[None, :] < order[:, None])).sum(axis=1)
        want = set(np.nonzero(dom < k)[0].tolist())
        assert set(D.skyband(g, lang, order, k).tolist()) == want
        halves = [np.arange(0, 450), np.arange(450, 900)]
        left = np.concatenate([h[D.skyband(g[h], lang[h], order[h], k)] for h in halves])
        assert set(left[D.skyband(g[left], lang[left], order[left], k)].tolist()) == want


def test_share_does_not_overflow():
    assert D.share(np.array([9_000_000_000]), 10_000_000_000, 5)[0] == 1 + 10**9 * 9_000_000_002 // 10_000_000_010


# ------------------------------------------------------------- vector codes

def codes(spark, rows, schema="vec_id long, label int, embedding array<float>"):
    return sorted((tuple(r) for r in V.op11_vector_codes(spark.createDataFrame(rows, schema)).collect()), key=KEY)


def test_vector_codes(spark):
    got = sorted(map(tuple, V.op11_vector_codes(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")).collect()))
    rows = [(r.vec_id, r.label, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    assert got == sorted(brute.vector_codes(rows))


def test_vector_codes_odd(spark):
    rnd = random.Random(2)
    f32 = lambda v: [float(np.float32(x)) for x in v]
    rows = [(i // 2, None if i % 3 == 0 else i % 4, f32(rnd.choice([-1.5, -0.001, 0, 0.001, 0.25]) for _ in range(8))) for i in range(700)]
    rows += [(None, 1, f32([1] * 8)), (3, None, None), (4, 1, [float("nan")] * 8), (5, 1, [float("inf")] + [0.0] * 7),
             (6, 2, [None] + [0.0] * 7), (7, 2, f32([0.5] * 3)), (8, 2, []), (9, 2, f32([200.0] * 10))] + [(1, 1, f32([0.25] * 8))] * 40
    assert codes(spark, rows) == sorted(brute.vector_codes(rows), key=KEY)
    assert codes(spark, rows[:5]) == sorted(brute.vector_codes(rows[:5]), key=KEY)
    assert codes(spark, []) == [] and codes(spark, [(1, 1, None)]) == []
    assert len(codes(spark, [(1, None, [3e38, -3e38, 0.0, 1.0]), (2, None, [0.0] * 4)])) == 2


def test_bounds_hold_and_spare_scans():
    """Every bound lies below the true distance, and later rounds scan less."""
    rnd = np.random.default_rng(4)
    centres = rnd.integers(-900, 900, (60, 6))
    x = (centres[rnd.integers(0, 60, 4000)] + rnd.integers(-40, 40, (4000, 6))).astype(np.int64)
    history, bounds, scanned = [x[:256].copy()], V.Bounds(x), []
    for _ in range(8):
        before = bounds.scanned
        best = bounds.assign(history)
        scanned.append(bounds.scanned - before)
        d = V.distances(x, history[-1])
        assert (bounds.code == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
        d = np.sqrt(d.astype(float))
        d[np.arange(len(x)), bounds.code] = np.inf
        true = d.reshape(len(x), -1, V.GROUP).min(axis=2)
        assert (bounds._lowered(history) <= true).all()
        nxt = history[-1].copy()
        for e in np.unique(bounds.code):
            own = x[bounds.code == e]
            nxt[e] = own.sum(axis=0) // len(own)
        history.append(nxt)
    assert scanned[-1] < scanned[0] / 2


# ------------------------------------------------------ mended operators

def test_scores_are_bm25_in_any_number_of_shards(spark):
    rnd = random.Random(8)
    vocab = [f"t{i}" for i in range(80)]
    texts = {i: " ".join(rnd.choices(vocab, k=rnd.randrange(8, 30))) + ". " + " ".join(rnd.choices(vocab, k=rnd.randrange(5, 9))) for i in range(60)}
    edited = {}
    for i in range(0, 60, 2):
        w = texts[i].split()
        for _ in range(rnd.randrange(0, 3)):
            w[rnd.randrange(len(w))] = "changed"
        edited[i] = " ".join(w)
    items = spark.createDataFrame(list(texts.items()), "item_id long, text string")
    docs = spark.createDataFrame(list(edited.items()), "doc_id long, text string")
    runs = [{(r.doc_id, r.item_id): r.score for r in find_leaks(docs, items, threshold=0.5, overlap=0.0, shard_bytes=b).collect()} for b in (1 << 20, 700)]
    bags = {i: words_of(t) for i, t in texts.items()}
    want = {(d, i): s for d, t in edited.items() for i, s in brute.bm25(bags, words_of(t)).items() if s >= 0.5}
    for got in runs:
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_one_changed_word_in_a_short_answer(spark):
    item = "the quick survey of northern rivers lists every crossing built before the railway came to town and who paid for it. answer seven bridges and one old ferry"
    leaked = item.replace("bridges", "tunnels")
    docs = spark.createDataFrame([(1, LONG + " " + leaked), (2, LONG), (3, item.split(".")[0])], "doc_id long, text string")
    got = op7_decontamination(docs, spark.createDataFrame([(9, item), (10, LONG[::-1])], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(1, 9)]


def test_index_travels_without_the_module():
    words = words_of("one two three four five six seven")
    index = Index([(1, "one two three. four five six seven")], {w: 1 for w in words}, 1, 7.0, 7)
    data = pickle.dumps(vars(index))
    assert b"textmill" not in data and Index.of(pickle.loads(data)).item_id == [1]


def test_words_before_a_comma_have_the_tokenizers_ids():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    words = word_ids(str(public_tokenizers.path(VOCABULARY)))
    letters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalnum()]
    texts = [f"x{a}{t}" for a in letters for t in ",."]
    for at in range(0, len(texts), 4000):
        part = texts[at:at + 4000]
        whole = [np.array(e.ids, dtype="<u4").tobytes() for e in words.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
        assert words.encode(part) == whole
    rnd = random.Random(6)
    odd = "aZ9,.;-'İक़é́ ßẞ\n\t中 "
    part = ["".join(rnd.choices(odd, k=rnd.randrange(1, 25))) for _ in range(3000)]
    assert words.encode(part) == [np.array(e.ids, dtype="<u4").tobytes() for e in words.tokenizer.encode_batch_fast(part, add_special_tokens=False)]


def test_closing_marks_have_the_tokenizers_ids():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    words = word_ids(str(public_tokenizers.path(VOCABULARY)))
    part = [f"x{a}{u}{v}" for a in sorted(packing._BEFORE_CLOSING) for u in packing._CLOSING for v in ["", *packing._CLOSING]]
    rnd = random.Random(1)
    part += ["".join(rnd.choices("aZ9,.!?;:$%&#*éßç'-_<|中İ ", k=rnd.randrange(1, 9))) for _ in range(5000)]
    assert words.encode(part) == [np.array(e.ids, dtype="<u4").tobytes() for e in words.tokenizer.encode_batch_fast(part, add_special_tokens=False)]


def test_a_word_is_looked_up_once_per_stretch():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    words = word_ids(str(public_tokenizers.path(VOCABULARY)))
    asked = []

    class Known(dict):
        def get(self, word, *rest):
            asked.append(word)
            return super().get(word, *rest)

        def __getitem__(self, word):
            asked.append(word)
            return super().__getitem__(word)
    words = packing.WordIds(words.tokenizer, words.closing, Known())
    one = words.encode(["same other"])[0]
    del asked[:]
    assert words.encode(["same other " * 50, "", "other same"])[0] == one * 50 and len(asked) <= 4


def test_capitals_are_judged_by_the_groups_own_spread(spark):
    def text(share, i):
        return " ".join(("Ab" if (j * 7 + i) % 100 < share else "ab") + f"c{j}def" for j in range(120))
    calm = [(i, text(3, i), "en", "calm") for i in range(250)]
    wild = [(1000 + i, text((i * 37) % 25, i), "en", "wild") for i in range(250)]
    probe = [(9001, text(45, 0), "en", "calm"), (9002, text(45, 0), "en", "wild")]
    kept = {r.doc_id: r.kept for r in op10_quality_rules(spark.createDataFrame(calm + wild + probe, "doc_id long, text string, lang string, source string")).collect()}
    assert not kept[9001] and kept[9002]


def test_word_cache_is_filled_to_its_limit(monkeypatch):
    """Also by a stretch with more words than it holds; the ids are the same."""
    import public_tokenizers
    monkeypatch.setattr(packing, "_CACHE", 6)
    words = word_ids(str(public_tokenizers.path(VOCABULARY)))
    words.known = {}
    texts = ["one two, three four five six seven eight nine ten", "Eleven one two. thirteen"]
    want = [words.whole(t) for t in texts]
    assert words.encode(texts[:1]) + words.encode(texts[1:]) == want
    assert 5 <= len(words.known) <= 6 and words.known["one"] == words.whole("one")


def test_new_operators_on_empty_tables(spark, empty):  # noqa: F811
    assert N.op12_ngram_jaccard_join(empty).collect() == [] and D.op13_source_divergence_audit(empty).collect() == []
    assert math.isfinite(V._limit(16)) and F is not None and SCHEMA


def test_parities_never_hide_a_link():
    rng = np.random.default_rng(5)
    n, marks, sets = [], [], []
    for size in (1, 5, 40, 64, 65, 300, 1000):
        base = rng.integers(0, 2 ** 63, size, dtype=np.uint64)
        for share in (0, 0.02, 0.1, 0.3):
            other = base.copy()
            k = int(size * share)
            other[:k] = rng.integers(0, 2 ** 63, k, dtype=np.uint64)
            for one in (np.unique(other), np.unique(other[: max(1, int(0.85 * size))])):
                sets.append(one)
                n.append(len(one))
                marks.append(N.parities(one))
    marks[3] = None                                        # a row without a bitmap passes
    n = np.array(n)
    i, j = np.triu_indices(len(sets), 1)
    may = N.marked_pairs(marks, n, i, j, 80)
    hidden = 0
    for a, b, ok in zip(i.tolist(), j.tolist(), may.tolist()):
        common = len(np.intersect1d(sets[a], sets[b]))
        assert ok or not N.linked(common, n[a], n[b], 80)
        if marks[a] is not None and marks[b] is not None:
            assert ok == N.may_link(marks[a], marks[b], int(n[a]), int(n[b]), 80)
        hidden += not ok
    assert hidden > len(i) // 2
