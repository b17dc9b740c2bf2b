"""Training history against the same means computed in plain Python."""
from pyspark.sql import functions as F

from textmill.operators import learn as LN


def _docs(spark, n, first):
    rows = [(first + i, [5, 6 + i % 2, 6 + i % 2, 8 + i % 3], i % 2 == 0) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, tokens array<int>, label boolean")


def test_training_history(spark):
    train, val = _docs(spark, 40, 0), _docs(spark, 21, 1000)
    rows = LN.training_rows(train, val, False, epochs=2)
    assert rows.count() == 2 * (40 + 21)
    got = {(r["epoch"], r["split"], r["metric"]): r for r in LN.training_history(rows, 8).collect()}
    assert len(got) == 8
    plain = rows.collect()
    for (epoch, split, metric), r in got.items():
        mine = sorted((p for p in plain if (p["epoch"], p["split"]) == (epoch, split)), key=lambda p: p["step_key"])
        full = len(mine) // 8 * 8  # the last partial batch does not count
        assert r["n_batches"] == full // 8
        assert abs(r["value"] - sum(p[metric] for p in mine[:full]) / full) < 2e-6
    assert got[1, "train", "loss"]["value"] <= got[0, "train", "loss"]["value"]
    assert got[1, "val", "accuracy"]["value"] == 1.0  # token 6 or 7 tells the label


def test_vectors_for_every_token(spark):
    enc = spark.createDataFrame([(0, i, [5, 6, 7 + i % 4]) for i in range(30)], "paragraph_id long, idx long, ids array<int>")
    v = LN.pretrain_vectors(enc, dim=4)
    assert sorted(r["token"] for r in v.collect()) == [5, 6, 7, 8, 9, 10]
    assert v.select(F.size("vector")).distinct().collect()[0][0] == 4


def _sentences(spark, rows, parts):
    return spark.createDataFrame([(0, i, ids) for i, ids in enumerate(rows)], "paragraph_id long, idx long, ids array<int>").repartition(parts)


def test_pairs_are_counted_with_the_share_of_windows_that_reach_them(spark, monkeypatch):
    """Every window of every sentence, none across sentences, in any stretch."""
    rows = [[5 + (i * j) % 9 for j in range(i % 14)] for i in range(60)] + [None, [], [30]]
    want, seen = {}, {}
    for ids in rows:
        for i, a in enumerate(ids or []):
            seen[a] = seen.get(a, 0) + 1
            for j, b in enumerate(ids):
                if i != j and abs(i - j) <= 5:
                    want[a, b] = want.get((a, b), 0) + 6 - abs(i - j)
    for stretch in (LN.COUNT_STRETCH, 7):
        monkeypatch.setattr(LN, "COUNT_STRETCH", stretch)
        tokens, n, pairs = LN.pair_counts(_sentences(spark, rows, 3), "ids")
        assert dict(zip(tokens.tolist(), n.tolist())) == seen and sorted(-n) == (-n).tolist()
        assert {(a, b): x for a, r in zip(tokens.tolist(), pairs.tolist()) for b, x in zip(tokens.tolist(), r) if x} == want


def test_vectors_do_not_depend_on_the_partitions(spark):
    """Failed with a step per token on every partition for itself."""
    rows = [[5 + (7 * i + j * j) % 11 for j in range(3 + i % 9)] for i in range(90)]
    got = [{r["token"]: r["vector"] for r in LN.pretrain_vectors(_sentences(spark, rows, p), dim=4).collect()} for p in (1, 6)]
    assert got[0] == got[1] and len(got[0]) == 11


def test_tokens_of_like_neighbours_have_like_vectors(spark):
    import numpy as np
    # 5 and 6 stand among 10-12, 7 and 8 among 20-22
    rows = [[10 + i % 3, 5 + i % 2, 10 + (i + 1) % 3] for i in range(60)] + [[20 + i % 3, 7 + i % 2, 20 + (i + 1) % 3] for i in range(60)]
    v = {r["token"]: np.array(r["vector"]) for r in LN.pretrain_vectors(_sentences(spark, rows, 2), dim=8).collect()}

    def cos(a, b):
        return v[a] @ v[b] / np.sqrt((v[a] @ v[a]) * (v[b] @ v[b]))

    assert min(cos(5, 6), cos(7, 8)) > max(cos(5, 7), cos(5, 8), cos(6, 7), cos(6, 8)) + 0.3


def test_skip_gram_comes_near_the_least_loss():
    """The shares that hierarchical softmax gives the neighbours are those that were counted."""
    import numpy as np
    seen = np.array([40, 30, 20, 10, 5])
    pairs = np.array([[9, 3, 1, 4, 2], [3, 8, 6, 1, 1], [1, 6, 2, 5, 2], [4, 1, 5, 1, 1], [2, 1, 2, 1, 3]]) * 100
    on, zero = LN._huffman(seen)
    assert (on.sum(axis=1) >= 1).all() and on.shape == (5, 4)
    assert on[0].sum() <= on[4].sum()       # the most frequent token has the shortest way
    assert len({tuple(r) for r in np.hstack([on, zero]).tolist()}) == 5
    vectors = LN.skip_gram(seen, pairs, 8, 0, LN.STEPS)
    assert np.isfinite(vectors).all() and np.linalg.matrix_rank(vectors) >= 4


def test_large_ids_go_the_way_token_by_token(spark, tmp_path):
    rows = [[5, 6, LN.MAX_PAIRED + i % 4] for i in range(30)]
    assert LN.pair_counts(_sentences(spark, rows, 2), "ids") is None
    v = LN.pretrain_vectors(_sentences(spark, rows, 2), dim=4).collect()
    assert sorted(r["token"] for r in v) == [5, 6, *range(LN.MAX_PAIRED, LN.MAX_PAIRED + 4)]


def test_a_model_on_vectors_is_saved_and_scores(spark, tmp_path):
    from textmill.sources import files as FS
    train = _docs(spark, 40, 0)
    unlabelled = _sentences(spark, [[5, 6 + i % 2, 8 + i % 3] for i in range(50)], 2)
    for unl in (None, unlabelled):
        model = LN.fit_classifier(train, True, dim=4, unlabelled=unl)
        want = sorted(map(tuple, LN.score_documents(model, train).collect()))
        path = str(tmp_path / f"model-{unl is None}")
        FS.save_model(model, path)
        assert sorted(map(tuple, LN.score_documents(FS.load_model(path), train).collect())) == want and len(want) == 40
