"""Widths, sizes and nulls that the small catalog does not show."""

import math

import pytest
from pyspark.sql import functions as F

from oddlens.functions.columns import null_count
from oddlens.functions.ranking import prefix_sums
from oddlens.operators import diagnose, discrimination, split
from oddlens.operators.profile import profile_columns


def test_null_count_of_a_table_with_2000_features(spark):
    df = spark.range(4).select("id", *[F.when(F.col("id") == 1, None).otherwise(F.col("id")).alias(f"f{i}") for i in range(2000)])
    found = {r.id: r.n for r in df.select("id", null_count([f"f{i}" for i in range(2000)]).alias("n")).collect()}
    assert found == {0: 0, 1: 2000, 2: 0, 3: 0}


def test_whole_numbers_beyond_doubles_are_profiled_exactly(spark):
    start = 1 << 60
    df = spark.range(1000).select((F.col("id") + start).alias("big"), F.lit(start + 1).alias("one"))
    found = {r.column_name: r for r in profile_columns(df).collect()}
    assert found["big"].unique_count == 1000 and found["big"].unique_rate == 1.0 and found["big"].top_value_count == 1
    assert found["big"].top_value == str(start)
    assert found["one"].unique_count == 1 and found["one"].top_value == str(start + 1)


def test_rows_with_a_null_key_stay(spark):
    df = spark.createDataFrame([(None, 1, 2), (None, 2, 3), ("a", 1, 5), ("a", 3, 7)], "k string, o int, v long")
    found = sorted(((r.k, r.o, r.cum_v, r.tot_v) for r in prefix_sums(df, ["k"], ["o"], ["v"]).collect()), key=str)
    assert found == sorted([(None, 1, 2, 5), (None, 2, 5, 5), ("a", 1, 5, 12), ("a", 3, 12, 12)], key=str)


def test_splits_keep_rows_without_a_label(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 != 0, F.col("id") % 2).alias("y"))
    parts = {(r.y, r.dataset): r["count"] for r in split.stratified_test(df, "y", ["id"]).groupBy("y", "dataset").count().collect()}
    assert sum(parts.values()) == 1000 and parts[None, "train"] == 100 and (None, "test") not in parts
    assert split.stratified_folds(df, "y", ["id"]).count() == 1000


def test_auc_of_four_thousand_million_bad_rows(spark):
    n = 4_000_000_000
    rows = [("f", 0.0, n, 0, n, 0, 2 * n, n), ("f", 1.0, n, n, 2 * n, n, 2 * n, n)]
    ranked = spark.createDataFrame(rows, "feature string, num double, n long, bad long, cum_n long, cum_bad long, tot_n long, tot_bad long")
    row = discrimination.rank_metrics(ranked, ["feature"]).first()
    assert row.auc == pytest.approx(1.0) and row.ks == 1.0


def test_ties_of_the_order_give_one_choice(spark):
    rows = [(k % 5, 1, f"value {k}") for k in range(200)]
    chosen = set()
    for parts in (1, 3, 7):
        df = spark.createDataFrame(rows, "id int, at int, v string").repartition(parts, "v")
        chosen.add(tuple(sorted((r.id, r.v) for r in diagnose.first_per_id(df, ["id"], ["at"]).collect())))
    assert len(chosen) == 1


def test_large_whole_numbers_and_decimals_stay_apart(spark):
    from decimal import Decimal

    from oddlens.operators.binning import value_entropy
    from oddlens.operators.prepare import quality_decisions
    from oddlens.operators.profile import dominant_values, profile_columns

    rows = [((1 << 60) + k, Decimal(10**25 + k), (1 << 60) + k % 2, 1) for k in range(1000)]
    df = spark.createDataFrame(rows, "id long, wide decimal(30,0), two long, bad int")
    found = {r.feature: r for r in dominant_values(df, ["id", "wide", "two"]).collect()}
    assert [found[c].unique_count for c in ("id", "wide", "two")] == [1000, 1000, 2]
    assert [found[c].dominant_count for c in ("id", "wide", "two")] == [1, 1, 500]
    entropy = {r.feature: r.entropy for r in value_entropy(df, ["id", "wide", "two"]).collect()}
    assert abs(entropy["id"] - math.log2(1000)) < 1e-9 and abs(entropy["two"] - 1) < 1e-9
    exact = {r.column_name: r for r in profile_columns(df).collect()}
    assert exact["id"].unique_count == 1000 and exact["id"].top_value == str(1 << 60) and exact["wide"].top_value == str(10**25)
    sketched = {r.column_name: r for r in profile_columns(df, approximate=True).collect()}
    assert all(abs(sketched[c].unique_count - 1000) < 100 for c in ("id", "wide")) and sketched["two"].unique_count == 2
    from oddlens.operators.contract import RiskContract

    kept = {r.column_name: r.decision for r in quality_decisions(df, RiskContract(("id",), None, "bad"), max_constant=0.6).collect()}
    assert kept["wide"] == "retained" and kept["two"] == "retained"
