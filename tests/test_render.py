"""Arrays as text: what the SQL's array_to_string gives, also for odd rows."""
from pyspark.sql import functions as F

from textmill.plans.registry import bool_str, ids_str


def test_arrays_as_text(spark):
    """A batch of rows at once, not an element at a time."""
    rows = [(0, [5, 0, 117, 3], [True, False]), (1, [], []), (2, None, None), (3, [-4, 2**31 - 1], [None, True, None]),
            (4, [None, 7, None], [False]), (5, [12] * 30, [True] * 30), (6, [1], [])]
    df = spark.createDataFrame(rows, "i int, x array<int>, k array<boolean>")
    want = {i: (None if x is None else " ".join(str(v) for v in x if v is not None),
                None if k is None else " ".join("1" if v else "0" for v in k)) for i, x, k in rows}
    for parts in (1, 7):
        out = df.repartition(parts).select("i", ids_str("x").alias("x"), bool_str(F.col("k")).alias("k"))
        assert {r["i"]: (r["x"], r["k"]) for r in out.collect()} == want
        assert [t for _, t in out.dtypes] == ["int", "string", "string"]
    assert [r[0] for r in df.where("i = 2").select(ids_str(F.col("x").cast("array<bigint>"))).collect()] == [None]


def test_the_alphabet_of_any_text(spark):
    """Code points are marked for a whole stretch of words."""
    from textmill.operators import vocab as V
    words = ["straße", "日本", "", None, "a\u0000b", "\U0001f600", "naïve_"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    for parts in (1, 9):
        got = sorted(r["symbol"] for r in V.alphabet(df.repartition(parts)).collect())
        assert got == sorted(set("".join(w for w in words if w)) | {"_"})
    assert V.alphabet(df.where("word is null")).count() == 0
    assert [r[0] for r in V.alphabet(df.where("word = ''")).collect()] == ["_"]
