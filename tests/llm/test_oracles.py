"""The DuckDB SQL and the Spark operators agree, also on odd texts."""

import random

import duckdb
import pytest
from test_operators import LONG, ODD

from textmill.llm import registry
from textmill.llm.oracle import ORACLES


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(4)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    texts = [t for t in ODD] + [f"key {''.join(rnd.choices(alphabet, k=rnd.randrange(20, 90)))} and token={''.join(rnd.choices(alphabet, k=30))}"
                                f" {''.join(rnd.choices('0123456789ABCDEF', k=rnd.randrange(20, 60)))} {LONG}" for _ in range(60)]
    texts += ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
              "documentation files, to deal in the Software without restriction. " * 2]
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else f"s{i % 2}", 0) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{path}/documents.parquet")
    vectors = [(i, None if i % 50 == 7 else [rnd.uniform(-1, 1) for _ in range(8)], None if i % 9 == 0 else i % 4) for i in range(400)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{path}/embeddings.parquet")
    return path


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_agrees(spark, folder, name):
    df = registry.queries()[name](spark, folder)
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
    res = con.execute(ORACLES[name])
    cols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(df.columns)
    want = sorted(map(repr, res.fetchall()))
    got = sorted(repr(tuple(r)) for r in df.select(*cols).collect())
    assert got == want
    if name == "op1_secret_scan":
        assert sum(r["n_entropy"] for r in df.collect()) > 60
