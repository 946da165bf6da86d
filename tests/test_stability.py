import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from oddlens.functions.columns import is_bad
from oddlens.operators import binning, correlation, stability


def _frame(spark):
    draw = random.Random(11)
    rows = []
    for i in range(600):
        m = f"2025{1 + i % 4:02d}" if i % 50 else None
        x = draw.gauss(0, 1) + (i % 4)
        rows.append((i, m, None if i % 17 == 0 else x, 2 * x + draw.gauss(0, 0.1), 1.0, draw.choice("abc"), int(draw.random() < 0.3)))
    return spark.createDataFrame(rows, "id long, event_month string, x double, z double, one double, c string, y int")


def test_baseline_psi_is_zero_and_drift_is_positive(spark):
    df = _frame(spark)
    psi = stability.monthly_psi(df, binning.fit_bins(df, ["x", "c"])).collect()
    assert len(psi) == 8
    assert all(abs(r.psi) < 1e-12 for r in psi if r.event_month == r.baseline_month)
    assert max(r.psi for r in psi if r.feature == "x") > 0.25
    with pytest.raises(ValueError):
        stability.monthly_psi(df, binning.fit_bins(df, ["x"]), baseline="209901")


def test_psi_with_empty_bins_is_finite(spark):
    rows = [("base", 0), ("base", 1), ("base", 2), ("now", 0), ("now", 0)]
    df = spark.createDataFrame([(g, float(v)) for g, v in rows], "event_month string, v double")
    psi = stability.monthly_psi(df, {"v": binning.NumericBins((1.0, 2.0))}, baseline="base", smoothing=1.0)
    value = psi.where("event_month = 'now'").first().psi
    assert math.isfinite(value) and value > 0


def test_monthly_sample_mix(spark):
    rows = stability.monthly_sample(_frame(spark), is_bad("y")).orderBy("event_month").collect()
    assert rows[0].psi == 0.0 and all(r.psi >= 0 for r in rows) and len(rows) == 4


def test_constant_score_has_no_drift(spark):
    df = spark.createDataFrame([("train", 0.5)] * 4 + [("oot", 0.5)] * 3, "dataset string, s double")
    assert all(r.score_psi == 0.0 for r in stability.score_psi(df, "s", edges="linear").collect())
    # additive smoothing leaves a small residue when the splits differ in size
    assert all(abs(r.score_psi) < 0.01 for r in stability.score_psi(df, "s").collect())


def test_correlation_with_nulls_and_constants(spark):
    df = _frame(spark)
    pairs = {(r.feature_1, r.feature_2): r for r in correlation.pearson_pairs(df, ["x", "z", "one"]).collect()}
    local = df.toPandas()
    assert pairs["x", "z"].correlation == pytest.approx(local.x.corr(local.z))
    assert pairs["x", "z"].pair_count == local.x.notna().sum()
    assert pairs["x", "one"].correlation == 0.0
    ranks = {(r.feature_1, r.feature_2): r for r in correlation.spearman_pairs(df, ["x", "z", "one"]).collect()}
    both = local[["x", "z"]].dropna()
    assert ranks["x", "z"].correlation == pytest.approx(both.x.rank().corr(both.z.rank()))
    matrix = {r.feature: r for r in correlation.correlation_matrix(correlation.pearson_pairs(df, ["x", "z"]), ["x", "z"]).collect()}
    assert matrix["x"].x == 1.0 and matrix["x"].z == matrix["z"].x


def test_large_offsets_do_not_cancel(spark):
    rows = [(1e9 + i, -1e9 - 3 * i) for i in range(100)]
    df = spark.createDataFrame(rows, "a double, b double")
    assert correlation.pearson_pairs(df, ["a", "b"]).first().correlation == pytest.approx(-1.0)


def test_perfect_twins_are_left_out_of_the_maximum(spark):
    rows = [("a", "b", 1.0, 1.0), ("a", "c", -0.4, 0.4)]
    pairs = spark.createDataFrame(rows, "feature_1 string, feature_2 string, correlation double, abs_correlation double")
    assert {r.feature: r.max_correlation for r in correlation.max_correlation(pairs).collect()} == {"a": 0.4, "b": 0.0, "c": 0.4}


def test_many_columns_with_nulls_take_one_pass(spark):
    draw = np.random.default_rng(5)
    n, wide = 400, 14  # 91 pairs: more than one aggregation holds
    values = np.round(draw.normal(size=(n, wide)).cumsum(axis=1), 1) + 1e6
    values[draw.random((n, wide)) < np.linspace(0, 0.4, wide)] = np.nan
    values[:, 3], values[:, 7] = 2.5, np.nan
    local = pd.DataFrame(values, columns=[f"f{k}" for k in range(wide)])
    df = spark.createDataFrame(local).repartition(5)
    for method, pairs in (("pearson", correlation.pearson_pairs), ("spearman", correlation.spearman_pairs)):
        found = {(r.feature_1, r.feature_2): r for r in pairs(df, list(local)).collect()}
        for i, a in enumerate(local):
            for b in list(local)[i + 1 :]:
                both = local[[a, b]].dropna()
                if len(both) < 2:
                    assert (a, b) not in found
                    continue
                assert found[a, b].pair_count == len(both)
                both = both.rank() if method == "spearman" else both
                exact = 0.0 if "f3" in (a, b) else both[a].corr(both[b])
                assert found[a, b].correlation == pytest.approx(exact, abs=1e-7)
    plan = correlation.pearson_pairs(df, list(local))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_both_ways_of_summing_agree(spark):
    df = _frame(spark).select((F.col("x") - 1).alias("x0"), F.col("z").alias("x1"), F.when(F.col("id") % 3 > 0, F.col("y") - 0.3).alias("x2"))
    pairs = [(0, 1), (0, 2), (1, 2)]
    one, other = (sorted(tuple(r) for r in f.select("i", "j", "n", "sx", "sy", "qx", "qy", "c").collect())
                  for f in (correlation._pair_sums(df, pairs, {1}), correlation.gram_sums(df)))
    # A column without nulls gives its own sums, which a pair with nulls does not use.
    assert [r[:3] for r in one] == [r[:3] for r in other]
    assert all(a == pytest.approx(b) for a, b in zip(one, other, strict=True))
    assert correlation.gram_sums(df.limit(0)).count() == 0
