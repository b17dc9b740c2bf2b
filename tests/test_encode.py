"""Encode / decode goldens (FIXTURES §2)."""
from textmill.functions.constants import SPECIAL_TOKENS
from textmill.operators import encode as E
from textmill.operators import vocab as V


def _vocab(spark, learned):
    return V.vocab_table(spark, SPECIAL_TOKENS + learned)


def _encode(spark, vocab, words):
    sents = spark.createDataFrame([(0, 0, " ".join(words))], "paragraph_id long, idx long, sentence string")
    return E.encode_sentences(sents, vocab).first()["ids"]


def test_encode_goldens(spark):
    v1 = _vocab(spark, ["bcc", "bb", "bc", "a", "b", "c", "_"])
    assert _encode(spark, v1, ["abbccc"]) == [8, 9, 5, 10, 11]
    v2 = _vocab(spark, ["aaaa", "aa", "a", "_"])
    assert len(_encode(spark, v2, ["aaaaaaaa", "aaaaaaa"])) == 7


def test_unknown_runs(spark):
    v1 = _vocab(spark, ["bcc", "bb", "bc", "a", "b", "c", "_"])
    assert _encode(spark, v1, ["xay"]) == [1, 8, 1, 11]


def test_decode_goldens(spark):
    v1 = _vocab(spark, ["bcc", "bb", "bc", "a", "b", "c", "_"])
    seqs = spark.createDataFrame([(0, [8, 9, 5, 10, 11])], "k long, ids array<int>")
    assert E.decode(seqs, v1, ["k"]).first()["words"] == ["abbccc"]
    v2 = _vocab(spark, ["aaaa", "aa", "a", "_"])
    seqs = spark.createDataFrame([(0, [5, 5, 8, 5, 6, 7, 8])], "k long, ids array<int>")
    assert E.decode(seqs, v2, ["k"]).first()["words"] == ["aaaaaaaa", "aaaaaaa"]


def test_roundtrip_unseen_sentence(spark):
    corpus = ["a river bends around the old mill .",
              "grain is ground between two heavy stones .",
              "flour dust settles on every beam and window .",
              "the miller counts the sacks before the sun goes down .",
              "bread is baked at night ."]
    words = [w for s in corpus for w in s.split()]
    df = spark.createDataFrame([(0, i, w) for i, w in enumerate(words)], "doc_id long, pos long, word string")
    idx2word, _ = V.bpe_train(spark, df, 80)
    vocab = V.vocab_table(spark, idx2word)
    sentence = "the old window bends around heavy bread and dust ."
    sents = spark.createDataFrame([(0, 0, sentence)], "paragraph_id long, idx long, sentence string")
    enc = E.encode_sentences(sents, vocab)
    assert E.decode(enc, vocab, ["paragraph_id", "idx"]).first()["words"] == sentence.split()
    assert E.roundtrip_check(sents, vocab).count() == 0


def test_case_is_kept_on_request(spark):
    vocab = _vocab(spark, ["Ab", "ab", "A", "a", "b", "_"])
    sents = spark.createDataFrame([(0, 0, "Ab ab")], "paragraph_id long, idx long, sentence string")
    assert E.encode_sentences(sents, vocab).first()["ids"] == [6, 10, 6, 10]
    assert E.encode_sentences(sents, vocab, lower=False).first()["ids"] == [5, 10, 6, 10]
    assert E.roundtrip_check(sents, vocab, lower=False).count() == 0


def test_very_long_word(spark):
    vocab = _vocab(spark, ["ab", "a", "b", "_"])
    n = 200_000
    ids = _encode(spark, vocab, ["ab" * n + "xyz" + "b", "ab"])
    assert ids == [5] * n + [1, 7, 8, 5, 8]


def test_frequent_words_join_as_rare_ones(spark):
    from pyspark.sql import functions as F
    from textmill.operators.joins import hot_key_join
    big = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("w"), F.col("id") % 700)).alias("k"), "id")
    counts = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    per_key = counts.select("k", F.length("k").alias("v"))
    want = sorted(map(tuple, big.join(per_key, "k").select("id", "v").collect()))
    for hot_keys in (0, 10, 350, 100_000):
        got = hot_key_join(big, per_key, "k", counts, hot_keys=hot_keys)
        assert sorted(map(tuple, got.select("id", "v").collect())) == want


def _random_words(seed, n):
    import random
    rnd = random.Random(seed)
    return ["".join(rnd.choice("abcxé𝒳") for _ in range(rnd.randint(1, 12))) for _ in range(n)]


TOKENS = ["abc", "ab", "bc", "ca", "a𝒳", "éé", "c_", "a", "b", "c", "_"]


def test_automaton_matches_equal_the_join(spark):
    """Same occurrences and same ids by both ways, with words cut at every stretch."""
    vocab = _vocab(spark, TOKENS)
    words = _random_words(3, 300) + ["ab" * 500]
    df = spark.createDataFrame([(w,) for w in set(words)] + [(None,)], "word string")
    by_join = sorted(map(tuple, E.substring_join(df, vocab).collect()))
    want = {r["word"]: r["ids"] for r in E.bpe_encode_words(df.dropna(), vocab).collect()}
    for chars, tokens in ((1, 200_000), (50, 200_000), (1 << 18, 200_000), (1 << 18, 0)):
        old = E.A.WALK_CHARS, E.A.MAX_TOKENS
        try:
            E.A.WALK_CHARS, E.A.MAX_TOKENS = chars, tokens  # 0 tokens: the join path
            assert (E.A.compiled(vocab) is None) == (tokens == 0)
            assert sorted(map(tuple, E.substring_vocab_match(df, vocab).collect())) == by_join
            got = {r["word"]: r["ids"] for r in E.bpe_encode_words(df.dropna(), vocab).collect()}
        finally:
            E.A.WALK_CHARS, E.A.MAX_TOKENS = old
        assert got == want
    assert sorted(map(tuple, E.substring_vocab_match(df, vocab, max_len=2).collect())) == sorted(
        map(tuple, E.substring_join(df, vocab, max_len=2).collect()))


def test_segmentation_equals_plain_rule(spark):
    vocab = _vocab(spark, TOKENS)
    ids = {t: 5 + i for i, t in enumerate(TOKENS)}

    def plain(word):
        word, out = word + "_", {}
        free = [True] * len(word)
        for t in TOKENS:
            at = 0
            while at + len(t) <= len(word):
                if word[at:at + len(t)] == t and all(free[at:at + len(t)]):
                    free[at:at + len(t)] = [False] * len(t)
                    out[at] = ids[t]
                    at += len(t)
                else:
                    at += 1
        out.update({i: 1 for i in range(len(word)) if free[i] and (i == 0 or not free[i - 1])})
        return [out[i] for i in sorted(out)]

    words = set(_random_words(4, 300))
    df = spark.createDataFrame([(w,) for w in words], "word string")
    assert {r["word"]: r["ids"] for r in E.bpe_encode_words(df, vocab).collect()} == {w: plain(w) for w in words}


def test_vocabulary_with_repeated_or_no_tokens(spark):
    df = spark.createDataFrame([("ab",)], "word string")
    twice = spark.createDataFrame([("a", 7), ("a", 9), ("_", 10)], "token string, id int")
    assert E.A.compiled(twice) is None
    assert E.bpe_encode_words(df, twice).first()["ids"] == [7, 1, 10]
    assert E.bpe_encode_words(df, twice.limit(0)).first()["ids"] == [1]


def test_sentences_are_encoded_where_they_lie(spark):
    """No shuffle of words, ids or pieces; rows that share a key are one sentence, as when joined."""
    vocab = _vocab(spark, TOKENS)
    rows = [(1, 0, "ab abc"), (1, 1, ""), (2, 0, None), (3, 0, "xx ca a"), (3, 1, "a" * 30 + " éé")]
    sents = spark.createDataFrame(rows, "paragraph_id long, idx long, sentence string")
    enc = E.encode_sentences(sents, vocab)
    whole = enc.transform(lambda d: E.pieces_of(d, vocab, ["paragraph_id", "idx"])), E.decode(enc, vocab, ["paragraph_id", "idx"]), \
        E.roundtrip_check(sents, vocab)
    for df in (enc, *whole):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    twice = sents.unionByName(sents.where("paragraph_id = 3")).unionByName(sents.where("idx = 1"))

    def both(df):
        old = E.A.MAX_TOKENS
        got = []
        for tokens in (200_000, 0):   # in place, joined
            try:
                E.A.MAX_TOKENS = tokens
                e = E.encode_sentences(df, vocab)
                outs = e, E.pieces_of(e.where("size(ids) > 0"), vocab, ["paragraph_id", "idx"]), E.decode(e, vocab, ["paragraph_id", "idx"]), E.roundtrip_check(df, vocab)
                got.append([sorted(map(str, o.collect())) for o in outs])
            finally:
                E.A.MAX_TOKENS = old
        return got

    for df in (sents, twice, sents.limit(0)):
        here, joined = both(df)
        assert here == joined
    odd = spark.createDataFrame([(1, [5, -1, 99, 6]), (2, []), (3, None)], "k int, ids array<int>")
    assert sorted(map(tuple, E.pieces_of(odd, vocab, ["k"]).collect())) == [
        (1, [5, -1, 99, 6], ["abc", None, None, "ab"]), (2, [], [])]
