import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from oddlens.functions import bucket_of_rank, global_row_number, prefix_sums


def _values(spark, seed=3):
    draw = random.Random(seed)
    # one key holds most rows
    rows = [("hot" if draw.random() < 0.7 else draw.choice("abc"), i, draw.randint(1, 5), draw.randint(0, 1)) for i in range(500)]
    return spark.createDataFrame(rows, "k string, v int, n int, bad int")


@pytest.mark.parametrize("partitions", [1, 2, 7])
@pytest.mark.parametrize("order", ["v", "-v"])
def test_prefix_sums_equal_a_plain_window(spark, partitions, order):
    df = _values(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        mine = prefix_sums(df, ["k"], [order], ["n", "bad"])
        sort = F.desc("v") if order == "-v" else F.asc("v")
        w = Window.partitionBy("k").orderBy(sort)
        whole = Window.partitionBy("k")
        plain = df.select(
            "k", "v", "n", "bad", F.sum("n").over(w).alias("cum_n"), F.sum("bad").over(w).alias("cum_bad"),
            F.sum("n").over(whole).alias("tot_n"), F.sum("bad").over(whole).alias("tot_bad"),
        )
        assert sorted(map(tuple, mine.select(*plain.columns).collect())) == sorted(map(tuple, plain.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_global_row_number_without_keys(spark):
    df = _values(spark)
    rows = global_row_number(df, ["-v"]).orderBy("rn").collect()
    assert [r.rn for r in rows] == list(range(1, 501))
    assert [r.v for r in rows] == list(range(499, -1, -1))
    assert {r.tot_n for r in rows} == {500}


def test_ranking_never_gathers_rows_in_one_partition(spark, monkeypatch):
    from oddlens.functions import ranking

    plans = []

    def spy(df, partition_by=()):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return original(df, partition_by)

    original = ranking.stage
    monkeypatch.setattr(ranking, "stage", spy)
    prefix_sums(_values(spark), [], ["v"], ["n"])
    assert "rangepartitioning" in plans[0]
    assert "SinglePartition" not in plans[0]


@pytest.mark.parametrize("n,k", [(10, 10), (10, 3), (7, 10), (23, 5), (1, 10)])
def test_buckets_match_floor_slices(spark, n, k):
    df = spark.range(1, n + 1).select(F.col("id").alias("rn"), F.lit(n).cast("long").alias("n"))
    got = [r.b for r in df.select("rn", bucket_of_rank(F.col("rn"), F.col("n"), k).alias("b")).orderBy("rn").collect()]
    k = min(n, k)
    want = [b for b in range(1, k + 1) for _ in range((b - 1) * n // k, b * n // k)]
    assert got == want
