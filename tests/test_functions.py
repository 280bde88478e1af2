import duckdb
import pytest
from pyspark.sql import functions as F

from basketrec.functions import array_cosine, dense_index, hash_u32
from basketrec.plans.oracle import u32


def test_array_cosine(spark):
    df = spark.createDataFrame([([1, 2, 3], [1, 2, 3]), ([1, 0], [0, 1]), ([0, 0], [1, 1]), ([3, 4], [4, 3])],
                               "x array<int>, y array<int>")
    got = [r.c for r in df.select(array_cosine("x", "y").alias("c")).collect()]
    assert got[0] == pytest.approx(1.0) and got[1] == 0.0 and got[2] is None
    assert got[3] == pytest.approx(24 / 25)
    bad = spark.createDataFrame([([1, 2], [1, 2, 3])], "x array<int>, y array<int>")
    with pytest.raises(Exception, match="differ in length"):
        bad.select(array_cosine("x", "y")).collect()


def test_hash_draws_match_sql(spark):
    df = spark.range(200).select(F.col("id").alias("a"), (F.col("id") * 7919).alias("b"))
    got = [r.h for r in df.select(hash_u32(3, "a", "b").alias("h")).orderBy("a").collect()]
    con = duckdb.connect()
    exp = [r[0] for r in con.execute(
        f"SELECT {u32(3, 'a', 'b')} FROM (SELECT range AS a, range * 7919 AS b FROM range(200)) ORDER BY a").fetchall()]
    assert got == exp and all(0 <= h < 2**32 for h in got)


def test_dense_index(spark):
    df = spark.createDataFrame([(x,) for x in [50, 3, 3, 900, 7, 12, 50, 1]], "k long")
    got = sorted((r.k, r.idx) for r in dense_index(df, "k", num_partitions=3).collect())
    assert got == [(1, 0), (3, 1), (7, 2), (12, 3), (50, 4), (900, 5)]


def test_group_row_number_matches_window(spark):
    from pyspark.sql import Window

    from basketrec.functions.indexing import global_index, group_row_number

    rows = [(g, t, i) for g in range(4) for t, i in [(5, 1), (3, 2), (5, 0), (1, 9)]] + \
        [(7, t, t) for t in range(50)]  # one hot group
    df = spark.createDataFrame(rows, "g long, t long, i long")
    got = group_row_number(df, ["g"], ["t", "i"], "rn", group_size="n")
    exp = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("t", "i")))
    assert sorted((r.g, r.t, r.i, r.rn) for r in got.collect()) == sorted((r.g, r.t, r.i, r.rn) for r in exp.collect())
    assert {r.n for r in got.where("g = 7").collect()} == {50}
    gi = global_index(df, ["g", "t", "i"], num_partitions=5).orderBy("idx").collect()
    assert [r.idx for r in gi] == list(range(len(rows)))
    assert [(r.g, r.t, r.i) for r in gi] == sorted((g, t, i) for g, t, i in rows)
