"""Vocabulary training goldens (FIXTURES §2) and batched == one-at-a-time."""
import random

from textmill.functions.constants import SPECIAL_TOKENS
from textmill.operators import vocab as V


def _words(spark, corpus):
    rows = [(0, i, w) for i, w in enumerate(corpus)]
    return spark.createDataFrame(rows, "doc_id long, pos long, word string")


def test_specials_and_length_order(spark):
    idx2word, _ = V.bpe_train(spark, _words(spark, ["abcde"]), 15)
    assert idx2word[:5] == SPECIAL_TOKENS
    learned = idx2word[5:]
    assert sorted(learned, key=len, reverse=True) == learned


def test_low_lower_newest_widest(spark):
    corpus = ["low"] * 5 + ["lower"] * 2 + ["newest"] * 6 + ["widest"] * 3
    vocab = set(V.bpe_train(spark, _words(spark, corpus), 24)[0])
    assert vocab > set(SPECIAL_TOKENS) | {"est_", "low", "newest_", "i", "e", "n", "t", "d", "s",
                                          "o", "l", "r", "w", "_"}
    assert "low_" not in vocab and "wi" not in vocab and "id" not in vocab


def test_self_pairs(spark):
    vocab = set(V.bpe_train(spark, _words(spark, ["aaaaaaaaaaaa", "abababab"]), 13)[0])
    assert vocab == set(SPECIAL_TOKENS) | {"aaaaaaaa", "aaaa", "abab", "aa", "ab", "a", "b", "_"}


def test_stops_when_no_pair_left(spark):
    assert len(V.bpe_train(spark, _words(spark, ["abc", "bcd"]), 10000)[0]) == 15


def _one_at_a_time(corpus, max_size):
    """Plain training that counts all pairs again for every merge."""
    counts, first = {}, {}
    for i, w in enumerate(corpus):
        counts[w] = counts.get(w, 0) + 1
        first.setdefault(w, i)
    words = {w: [*w, "_"] for w in counts}
    vocab, merges = {c for s in words.values() for c in s}, []
    while len(vocab) + len(SPECIAL_TOKENS) < max_size:
        n, where = {}, {}
        for w, s in words.items():
            for i, p in enumerate(zip(s, s[1:])):
                n[p] = n.get(p, 0) + counts[w]
                where[p] = min(where.get(p, (first[w], i)), (first[w], i))
        if not n:
            break
        a, b = min(n, key=lambda p: (-n[p], where[p]))
        vocab.add(a + b)
        merges.append((a, b))
        words = {w: V._merged(s, a, b) for w, s in words.items()}
    return list(SPECIAL_TOKENS) + sorted(vocab, key=lambda t: (-len(t), t)), merges


def test_any_working_set_gives_the_same_merges(spark):
    rnd = random.Random(7)
    for trial in range(2):
        letters = "ab" if trial == 0 else "abcdefgh"
        corpus = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 9))) for _ in range(80)]
        df = _words(spark, corpus)
        want = _one_at_a_time(corpus, 60)
        for symbols, pairs in ((10**6, 10**6), (60, 8)):
            stats = []
            got = V.bpe_train(spark, df, 60, working_symbols=symbols, first_pairs=pairs, stats=stats)
            assert got == want, (trial, symbols, pairs, corpus)
            assert sum(r[0] for r in stats) == len(want[1])
            if symbols == 60:
                assert all(size <= 60 or k == 1 for _, k, size in stats) and len(stats) > 1


def test_segments_hold_every_candidate_pair(spark):
    state = V.symbolize(spark.createDataFrame([("abcab", 3, 5, 0), ("xabz", 2, 1, 4), ("q", 9, None, None)],
                                              "word string, n long, first_doc long, first_pos long")).drop("word")
    got = {tuple(r.symbols): (r.n, r.first_doc, r.first_pos, r.off) for r in V.segments(state, [("a", "b"), ("b", "c")]).collect()}
    assert got == {("a", "b", "c"): (3, 5, 0, 0), ("a", "b"): (5, 1, 4, 1)}
    # merged on Spark as one at a time, a run of one letter included
    runs = spark.createDataFrame([(["a"] * 7 + ["b"], 1, 0, 0)], "symbols array<string>, n long, first_doc long, first_pos long")
    assert V.apply_merges(runs, [("a", "a"), ("aa", "aa"), ("a", "b")]).first().symbols == ["aaaa", "aa", "ab"]


def test_merge_pair_non_overlapping(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(["a", "a", "a", "_"],), (["b", "a", "b", "b"],)], "symbols array<string>")
    out = [r[0] for r in df.select(V.merge_pair_expr(F.col("symbols"), "a", "a")).collect()]
    assert out == [["aa", "a", "_"], ["b", "a", "b", "b"]]


def test_merge_pair_query_equals_plain_python(spark):
    from textmill.plans.registry import doc_words, q_merge_pair
    words = [(r.doc_id, r.pos, r.word) for r in doc_words(spark, "/root/testdata/sf0.001").collect()]
    n, first = {}, {}
    for d, p, w in sorted(words):
        n[w] = n.get(w, 0) + 1
        first.setdefault(w, (d, p))
    pairs, where = {}, {}
    for w, k in n.items():
        s = [*w, "_"]
        for i, p in enumerate(zip(s, s[1:])):
            pairs[p] = pairs.get(p, 0) + k
            where[p] = min(where.get(p, (*first[w], i)), (*first[w], i))
    a, b = min(pairs, key=lambda p: (-pairs[p], where[p]))
    got = {r.word: r.symbols for r in q_merge_pair(spark, "/root/testdata/sf0.001").collect()}
    assert got == {w: " ".join(V._merged([*w, "_"], a, b)) for w in n}


def test_query_learns_from_both_tables(spark):
    from textmill.plans.registry_more import q_bpe_train, training_words
    learned = {r.token for r in q_bpe_train(spark, "/root/testdata/sf0.001").collect()}
    words = training_words(spark, "/root/testdata/sf0.001")
    assert len(learned) > 150 and {r[0] for r in words.select("doc_id.source").distinct().collect()} == {0, 1}
    chars = {c for r in words.select("word").distinct().collect() for c in r.word}
    assert chars <= learned
