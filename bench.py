"""Headline timings at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is forced with a ``noop`` write (full computation, nothing pulled to
the driver). Throughputs: tokens/s of the corpus encoding and examples/s of the
masked-token / sentence-pair generator (the reference's comparable figure is
~178 examples/s, training included).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from textmill.session import build_session, cut_lineage  # noqa: E402


def _force(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app_name="textmill-bench")
    from textmill.operators import encode as E
    from textmill.operators import examples as X
    from textmill.operators import vocab as V
    from textmill.plans import registry as R

    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.time()
        out = fn()
        times[name] = round(time.time() - t, 3)
        return out

    spark.range(1).count()  # JVM warm-up outside the timings
    words = R.doc_words(spark, sf)
    timed("word_counts", lambda: _force(V.word_counts(words)))
    timed("pair_counts", lambda: _force(V.pair_counts(V.symbolize(V.word_counts(words)))))
    conv = R.conv_sents(spark, sf)
    conv_words = R.TB.corpus_words(conv.select(F.col("paragraph_id").alias("doc_id"), F.col("sentence").alias("text")))
    idx2word = timed("bpe_train", lambda: V.bpe_train(spark, conv_words, 150)[0])
    vocab = timed("demo_vocab", lambda: R.demo_vocab(spark, words))
    sents = R.doc_sents(spark, sf)
    enc = timed("encode_corpus", lambda: cut_lineage(E.encode_sentences(sents, vocab)))
    n_tokens = enc.agg(F.sum(F.size("ids"))).first()[0]
    token_num = vocab.count()
    index = timed("prepare_paragraphs", lambda: X.prepare_paragraphs(enc))
    n_ex = sents.count()
    ex = timed("pretrain_examples", lambda: cut_lineage(X.pretrain_examples(index, n_ex, token_num)))
    timed("example_audit", lambda: X.example_audit(ex).collect())
    delivered = ex.select("example_id").distinct().count()
    from textmill.operators import batching as B
    timed("length_buckets", lambda: _force(B.length_buckets(enc.select(
        F.struct("paragraph_id", "idx").alias("_k"), "ids").withColumn("doc_id", F.xxhash64("_k")), 16)))

    total = round(sum(times.values()), 3)
    out = {"metric": "total_time", "value": total, "unit": "sec", "queries": times,
           "sf": os.path.basename(sf.rstrip("/")).replace("sf", ""),
           "tokens_per_sec": round(n_tokens / times["encode_corpus"], 1),
           "examples_requested": n_ex, "examples_delivered": delivered,
           "examples_per_sec": round(delivered / (times["pretrain_examples"] + times["prepare_paragraphs"]), 1),
           "bpe_vocab": len(idx2word)}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
