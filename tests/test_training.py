"""Training over epochs: against plain descent, broken off and resumed, odd rows."""
import math

import pytest

from textmill.operators import batching as B
from textmill.operators import training as TR

RATE = 0.3


def _data(spark, n=70):
    rows = [(i, [5, 6 + i % 2, 6 + i % 2, 8 + i % 3] * (1 + i % 5), i % 2 == 0) for i in range(n)]
    return TR.token_features(spark.createDataFrame(rows, "doc_id long, tokens array<int>, label boolean")), 11


def _table(df):
    return {(r["epoch"], r["i"]): (r["w"], r["g2"]) for r in df.collect()}


def _plain(spark, data, width, epochs, workers):
    """The same steps in plain Python, from the batches and orders of T3 and T4."""
    batched = B.length_buckets(data, 16, ids_col="idx")
    batches = {}
    for r in sorted(batched.collect(), key=lambda r: (r["batch_id"], r["slot"])):
        batches.setdefault(r["batch_id"], []).append((r["idx"] + [width], r["val"] + [1.0], r["y"]))
    w, g2, out, orders = [0.0] * (width + 1), [0.0] * (width + 1), {}, []
    for epoch in range(epochs):
        order = {r["batch_order"]: r["batch_id"] for r in B.shuffle_batches(batched, 0, epoch).collect()}
        orders.append(tuple(order[k] for k in sorted(order)))
        ends = []
        for worker in range(workers):
            mine = [order[k] for k in sorted(order) if k % workers == worker]
            mw, mg = list(w), list(g2)
            for b in mine:
                grad = {}
                for idx, val, y in batches[b]:
                    z = sum(v * mw[i] for i, v in zip(idx, val))
                    error = 1 / (1 + math.exp(-z)) - y
                    for i, v in zip(idx, val):
                        grad[i] = grad.get(i, 0.0) + v * error / len(batches[b])
                for i, g in grad.items():
                    mg[i] += g * g
                    mw[i] -= RATE * g / math.sqrt(mg[i] + TR.EPSILON)
            if mine:
                ends.append((len(mine), mw, mg))
        steps = sum(e[0] for e in ends)
        w = [sum(e[0] * e[1][i] for e in ends) / steps for i in range(width + 1)]
        g2 = [sum(e[0] * e[2][i] for e in ends) / steps for i in range(width + 1)]
        out.update({(epoch, i): (w[i], g2[i]) for i in range(width + 1)})
    return out, orders


@pytest.mark.parametrize("workers", [1, 2])
def test_equals_plain_descent(spark, tmp_path, workers):
    data, width = _data(spark)
    got = _table(TR.train(data, width, 2, str(tmp_path / "run"), rate=RATE, workers=workers))
    want, orders = _plain(spark, data, width, 2, workers)
    assert got.keys() == want.keys()
    assert all(abs(got[k][j] - want[k][j]) < 1e-9 for k in want for j in (0, 1))
    assert len(set(orders)) == 2  # every epoch has its own order


def test_broken_off_and_resumed_equals_unbroken(spark, tmp_path):
    data, width = _data(spark)
    whole = _table(TR.train(data, width, 4, str(tmp_path / "whole"), workers=3))
    path = str(tmp_path / "broken")
    TR.train(data, width, 2, path, workers=3)
    # died while epoch 2 was written: its folder is there, the entry is not
    spark.createDataFrame([(0, 99.0, 1.0)], "i int, w double, g2 double").write.parquet(f"{path}/weights/epoch=2")
    assert TR.completed(spark, path) == 2
    assert _table(TR.train(data, width, 4, path, workers=3)) == whole  # to the last bit
    assert TR.completed(spark, path) == 4
    assert _table(TR.train(data, width, 4, path, workers=3)) == whole  # nothing left to do


def test_scores_and_odd_rows(spark, tmp_path):
    data, width = _data(spark, 40)
    learned = TR.train(data, width, 3, str(tmp_path / "run"))
    odd = spark.createDataFrame([(900, [], True), (901, None, True), (902, [5, 6], None)], "doc_id long, tokens array<int>, label boolean")
    rows = TR.scored(data.unionByName(TR.token_features(odd)), learned, width).collect()
    assert len(rows) == 3 * 41 and {r["step_key"] for r in rows} == {*range(40), 900}
    w = {k: v[0] for k, v in _table(learned).items()}
    for r in data.collect():
        for e in range(3):
            z = w[e, width] + sum(v * w[e, i] for i, v in zip(r["idx"], r["val"]))
            mine = next(x for x in rows if (x["step_key"], x["epoch"]) == (r["doc_id"], e))
            assert abs(mine["loss"] - math.log1p(math.exp(-z if r["y"] else z))) < 1e-9
            assert mine["accuracy"] == float((z > 0) == (r["y"] == 1.0))
    empty = TR.train(data.limit(0), width, 1, str(tmp_path / "none"))
    assert empty.count() == 0


def test_width_is_bounded(spark, tmp_path):
    data, _ = _data(spark, 2)
    with pytest.raises(ValueError):
        TR.train(data, TR.MAX_WIDTH + 1, 1, str(tmp_path / "wide"))


def test_token_features_have_an_entry_per_distinct_id(spark):
    from textmill.operators import training as TR
    docs = spark.createDataFrame([(1, [2, 7, 7, 3, 7], True), (2, [], False), (3, None, True)], "doc_id long, tokens array<int>, label boolean")
    got = {r["doc_id"]: (r["idx"], r["val"], r["y"]) for r in TR.token_features(docs).collect()}
    assert got == {1: ([2, 3, 7], [0.2, 0.2, 0.6], 1.0), 2: ([], [], 0.0), 3: (None, None, 1.0)}
