"""B7 Viterbi segmentation against brute-force enumeration."""
import math
import random

from textmill.operators import automaton as A
from textmill.operators import encode as E


def _brute(word, pieces, unk, marked=None):
    w = marked or word + "_"
    best = (-math.inf, None)

    def rec(i, score, seq):
        nonlocal best
        if i == len(w):
            if score > best[0] + 1e-12:
                best = (score, seq)
            return
        for tid, (tok, sc) in pieces.items():
            if w.startswith(tok, i):
                rec(i + len(tok), score + sc, seq + [tid])
        rec(i + 1, score + unk, seq + [1])

    rec(0, 0.0, [])
    seq = best[1]
    return [t for k, t in enumerate(seq) if not (t == 1 and k > 0 and seq[k - 1] == 1)], best[0]


def test_viterbi_matches_brute_force(spark):
    rnd = random.Random(5)
    toks = ["a", "b", "ab", "ba", "abb", "b_", "_", "aa"]
    pieces = {5 + i: (t, -rnd.uniform(0.5, 4.0)) for i, t in enumerate(toks)}
    vocab = spark.createDataFrame([(i, t, s) for i, (t, s) in pieces.items()], "id int, token string, score double")
    words = ["".join(rnd.choice("abc") for _ in range(rnd.randint(1, 6))) for _ in range(40)]
    df = spark.createDataFrame([(w,) for w in set(words)], "word string")
    got = {r["word"]: r["ids"] for r in E.unigram_encode_words(df, vocab).collect()}
    unk = min(s for _, s in pieces.values()) - 10.0
    for w in set(words):
        want, score = _brute(w, pieces, unk)
        # compare by score: equal-score segmentations may differ
        def total(seq):
            return sum(pieces[t][1] if t != 1 else 0 for t in seq)
        assert abs(total(got[w]) - total(want)) < 1e-9 or got[w] == want, (w, got[w], want)


def test_vocabulary_file_keeps_case_and_marks_word_starts(spark, tmp_path):
    from textmill.functions.constants import SPECIAL_TOKENS
    from textmill.sources import files as FS
    learned = [("▁", -3.0), ("▁An", -2.0), ("An", -2.5), ("an", -2.2), ("a", -4.0), ("n", -4.1), ("▁b", -3.3), ("b", -5.0),
               ("ba", -3.9), ('"', -6.0)]
    with open(tmp_path / "pieces.vocab", "w") as f:
        f.write("".join(f"{t}\t0\n" for t in SPECIAL_TOKENS) + "".join(f"{t}\t{s}\n" for t, s in learned))
    vocab = FS.read_vocab(spark, str(tmp_path))
    texts = ["An an banan", "", "  ", 'ann "A" bXXba', "AnAn  an"]
    sents = spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "paragraph_id long, idx long, sentence string")
    got = {r["paragraph_id"]: r["ids"] for r in E.unigram_encode_sentences(sents, vocab).collect()}
    pieces = {5 + i: ts for i, ts in enumerate(learned)}
    for i, t in enumerate(texts):
        assert got[i] == [x for w in t.split() for x in _brute(w, pieces, -16.0, "▁" + w)[0]], t
    assert 6 in got[0] and 8 in got[0]  # "An" and "an" are different pieces


def test_scores_by_em_against_all_segmentations(spark):
    """One round equals enumeration; the likelihood never falls; rare pieces go."""
    from textmill.operators import unigram as U
    words = [("abab", 5), ("ab", 9), ("bba", 3), ("a", 4), ("xab", 2), ("x", 1)]
    pieces = [(5, "a", -1.5), (6, "b", -1.7), (7, "ab", -1.2), (8, "▁ab", -2.0), (9, "▁", -2.2), (10, "bba", -9.0)]
    counts = spark.createDataFrame(words, "word string, n long")
    vocab = spark.createDataFrame(pieces, "id int, token string, score double")
    unk = -19.0

    def ways(w):
        if not w:
            return [((), 0.0)]
        out = [(p, s + unk) for p, s in ways(w[1:])]
        for i, t, sc in pieces:
            if w.startswith(t):
                out += [((i, *p), s + sc) for p, s in ways(w[len(t):])]
        return out

    want, total = {}, 0.0
    for w, n in words:
        every = ways("▁" + w)
        z = sum(math.exp(s) for _, s in every)
        total += n * math.log(z)
        for p, s in every:
            for i in p:
                want[i] = want.get(i, 0.0) + n * math.exp(s) / z
    got = {r["id"]: int(r["expected"]) / U.UNIT for r in U.expected_counts(counts, vocab, unk).collect()}
    assert abs(got.pop(U.LIKELIHOOD) - total) < 1e-4
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-4 for i in want)

    fitted, course = U.fit(counts, vocab, rounds=6, least=0.0)
    assert len(course) == 6 and all(b >= a - 1e-4 for a, b in zip(course, course[1:]))
    assert abs(sum(math.exp(r["score"]) for r in fitted.collect()) - 1) < 1e-9
    tokens = {r["token"] for r in U.fit(counts, vocab, rounds=3, least=1.0)[0].collect()}
    assert "bba" not in tokens and {"a", "b", "▁"} <= tokens
    assert U.fit(counts.limit(0), vocab)[0].count() == len(pieces)


def test_seeds_and_pieces_cover_the_text(spark):
    from textmill.operators import unigram as U
    counts = spark.createDataFrame([("grain", 7), ("grains", 3), ("rain", 5), ("é𝒳", 1)], "word string, n long")
    seeds = U.seed_pieces(counts, 30)
    assert seeds.count() == 30 and {"▁", "é", "𝒳"} <= {r["token"] for r in seeds.collect()}
    vocab, _ = U.fit(counts, seeds)
    enc = E.unigram_encode_words(counts, vocab, mark="▁", at_start=True)
    for r in E.pieces_of(enc, vocab, ["word"]).collect():
        assert "".join(r["pieces"]) == "▁" + r["word"] and len(r["ids"]) == len(r["pieces"])


def test_expectations_take_all_words_in_few_steps():
    """The sums are those of the words one by one, and the steps do not grow with the words."""
    from textmill.operators import unigram as U
    tokens = ["a", "ab", "b", "ba", "aba"]
    automaton = A.build([(t, i) for i, t in enumerate(tokens)], {i: -1.0 - i / 7 for i in range(len(tokens))})
    match, expected = A.matcher(), U.expectations()
    words, weights = ["abab", "", "zab", "b", "abaabab"] * 200, [3, 2, 1, 5, 4] * 200
    together = expected(*match(automaton, words), weights, automaton[3], -20.0)
    sums, likelihood = {}, 0
    for w, n in zip(words, weights):
        one, l = expected(*match(automaton, [w]), [n], automaton[3], -20.0)
        likelihood += l
        for t, x in one.items():
            sums[t] = sums.get(t, 0) + x
    assert together == (sums, likelihood)
    import sys
    seen = []

    def lines(frame, event, arg):
        seen.append(frame.f_lineno)
        return lines
    found = match(automaton, words)
    before, _ = sys.gettrace(), sys.settrace(lambda frame, event, arg: lines if frame.f_code.co_name == "expected" else None)
    try:
        expected(*found, weights, automaton[3], -20.0)
    finally:
        sys.settrace(before)
    assert len(seen) < 1000     # the words were walked one character at a time before
