import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from oddlens.functions.columns import is_bad
from oddlens.operators import binning, discrimination
from oddlens.operators.binning import CategoryBins, NumericBins


def _frame(spark, n=400, seed=5):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        x = draw.choice([None, 0.0, 0.0, 0.0, draw.gauss(0, 1), float(draw.randint(0, 9))])
        rows.append((i, x, draw.choice(["a", "b", "c", None]), int(draw.random() < 0.3), draw.random() < 0.5))
    return spark.createDataFrame(rows, "id long, x double, c string, y int, flag boolean")


def test_iv_over_three_bins(spark):
    rows = [(i, float(b), y) for i, (b, y) in enumerate(zip([0, 0, 1, 1, 2, 2], [0, 1, 0, 1, 1, 1]))]
    df = spark.createDataFrame(rows, "id long, b double, y int")
    detail = binning.bin_detail(binning.bin_counts(df, {"b": NumericBins((1.0, 2.0))}, is_bad("y")))
    assert detail.count() == 3
    assert binning.bin_summary(detail).first().iv > 0


def test_counts_are_whole_and_sides_differ(spark):
    df = _frame(spark)
    bins = {"x": NumericBins((0.0, 3.0)), "c": CategoryBins(("a", "b"), True), "flag": CategoryBins(("true", "false"))}
    counts = binning.bin_counts(df, bins, is_bad("y")).collect()
    for f in bins:
        assert sum(r.n for r in counts if r.feature == f) == 400
    xs = [r.x for r in df.collect()]
    right = {r.bin: r.n for r in counts if r.feature == "x"}
    assert right[1] == sum(x is not None and 0 <= x < 3 for x in xs) and right[-1] == sum(x is None for x in xs)
    left = {r.bin: r.n for r in binning.bin_counts(df, {"x": NumericBins((0.0, 3.0), "left")}, is_bad("y")).collect()}
    assert left[0] == sum(x is not None and x <= 0 for x in xs)
    mixed = binning.bin_counts(df.withColumn("z", F.col("x")), {"x": NumericBins((0.0,)), "z": NumericBins((0.0, 1.0), "left")}, is_bad("y"))
    assert {r.bin: r.n for r in mixed.where("feature = 'z'").collect()}[0] == left[0]


def test_edges_against_sorted_values(spark):
    df = _frame(spark)
    values = sorted(r.x for r in df.collect() if r.x is not None)
    last = len(values) - 1
    want = sorted({values[round(i * last / 10)] for i in range(1, 10)})
    assert list(binning.fit_bins(df, ["x"])["x"].edges) == want
    distinct = sorted(set(values))
    want = sorted({distinct[round(i * (len(distinct) - 1) / 10)] for i in range(1, 10)})
    assert list(binning.fit_bins(df, ["x"], method="distinct")["x"].edges) == want
    want = sorted(set(pd.Series(values).quantile([i / 10 for i in range(1, 10)])))
    assert list(binning.fit_bins(df, ["x"], method="linear")["x"].edges) == pytest.approx(want)


def test_constant_and_empty_features(spark):
    df = spark.createDataFrame([(i, 1.0, None, i % 2) for i in range(6)], "id long, one double, none double, y int")
    fitted = binning.fit_bins(df, ["one", "none"], method="distinct")
    assert fitted["one"].edges == () and fitted["none"].edges == () and fitted["one"].labels() == ["all"]
    overview = {r.feature: r for r in discrimination.univariate_overview(df, ["one", "none"], is_bad("y")).collect()}
    assert overview["none"].missing_rate == 1.0 and overview["none"].auc is None
    assert overview["one"].auc == 0.5 and overview["one"].ks_raw == 0.0


def test_separable_scores(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0), (0.8, 1), (0.9, 1)], "s double, y int")
    row = discrimination.rank_metrics(binning.ranked_values(df, ["s"], is_bad("y")), ["feature"]).first()
    assert row.ks == 1.0 and row.auc_raw == 1.0


def test_auc_of_a_reversed_value(spark):
    df = _frame(spark).withColumn("r", -F.col("x"))
    rows = {r.feature: r for r in discrimination.rank_metrics(binning.ranked_values(df, ["x", "r"], is_bad("y")), ["feature"]).collect()}
    assert rows["x"].auc_raw + rows["r"].auc_raw == pytest.approx(1.0)
    assert rows["x"].ks == pytest.approx(rows["r"].ks)


def test_chi_merge_keeps_the_strong_boundary():
    part = pd.DataFrame({"bin": range(6), "n": [100] * 6, "bad": [5, 6, 5, 60, 61, 59], "edge": [1.0, 2.0, 3.0, 4.0, 5.0, math.nan]})
    assert binning.chi_merge(part, 2, 0.01) == [3.0]
    tiny = pd.DataFrame({"bin": range(3), "n": [500, 2, 500], "bad": [10, 1, 200], "edge": [1.0, 2.0, math.nan]})
    assert len(binning.chi_merge(tiny, 3, 0.01)) == 1


def test_chi_bins_in_spark(spark):
    rows = [(i, float(i), int(i >= 600)) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, x double, y int")
    edges = binning.fit_bins(df, ["x"], bins=2, method="chi", bad=is_bad("y"))["x"].edges
    assert len(edges) == 1 and abs(edges[0] - 600) <= 5


def test_top_share_lift_brute_force(spark):
    df = _frame(spark, 97)
    bins = binning.fit_bins(df, ["x", "c"])
    for ascending in ([], ["x"]):
        got = {r.feature: r for r in discrimination.top_share_lift(df, bins, is_bad("y"), ["id"], ascending=ascending).collect()}
        rows = sorted((r for r in df.collect() if r.x is not None), key=lambda r: (r.x if ascending else -r.x, r.id))
        top = rows[: math.ceil(0.1 * len(rows))]
        assert got["x"].top_bad == sum(r.y for r in top) and got["x"].top_size == len(top)


def test_long_feature_lists_are_batched(spark, monkeypatch):
    from oddlens.operators import counts

    monkeypatch.setattr(counts, "BATCH", 2)
    df = _frame(spark)
    names = ["x"] + [f"x{i}" for i in range(4)]
    wide = df.withColumns({f"x{i}": F.col("x") + i for i in range(4)})
    table = counts.value_counts(wide, names, is_bad("y")).groupBy("feature").agg(F.sum("n").alias("n")).collect()
    assert {r.feature: r.n for r in table} == {n: 400 for n in names}


def test_ks_buckets_rank_only_the_rows_at_a_cut(spark, monkeypatch):
    import numpy as np
    from oddlens.functions import ranking

    draw = np.random.default_rng(3)
    n = 600
    data = pd.DataFrame({"id": draw.permutation(n), "few": draw.integers(0, 3, n).astype(float), "many": draw.random(n), "same": 1.0, "bad": (draw.random(n) < 0.3).astype(int)})
    data.loc[data.id % 10 == 0, "few"] = None
    df = spark.createDataFrame(data.astype(object).where(data.notna(), None), "id long, few double, many double, same double, bad int").repartition(5)
    written = []
    for module in (ranking, discrimination):
        own = module.stage
        monkeypatch.setattr(module, "stage", lambda table, own=own: written.append(table.count()) or own(table))
    names = ["few", "many", "same"]
    found = discrimination.ks_buckets(df, {f: NumericBins(()) for f in names}, F.col("bad"), ["id"], 7)
    got = {(r.feature, r.bucket): (r.score_min, r.score_max, r.sample_count, r.bad_count) for r in found.collect()}
    expected = {}
    for f in names:
        rows = data.dropna(subset=[f]).sort_values([f, "id"], ascending=[False, True])
        size = -(-len(rows) // 7)
        for k in range(-(-len(rows) // size)):
            part = rows.iloc[k * size : (k + 1) * size]
            expected[f, k + 1] = (part[f].min(), part[f].max(), len(part), part.bad.sum())
    # the value counts of `many` are as long as the table; cells (three per row) are never written
    assert got == expected and max(written) <= n + 4


def test_monthly_discrimination_counts_the_cells_once(spark, monkeypatch):
    df = spark.range(300).select(
        F.col("id"), F.when(F.col("id") % 50 != 0, F.concat(F.lit("20240"), F.col("id") % 3 + 1)).alias("event_month"),
        F.when(F.col("id") % 7 != 0, (F.col("id") % 11).cast("double")).alias("x"), (F.col("id") % 4 == 0).cast("int").alias("bad"),
    )
    scans = []
    own = discrimination.score_cells
    monkeypatch.setattr(discrimination, "score_cells", lambda *args: scans.append(1) or own(*args))
    found = discrimination.monthly_discrimination(df, {"x": NumericBins((5.0,))}, F.col("bad"), ["id"], include_missing=True)
    rows = {r.event_month: (r.sample_count, r.bad_count) for r in found.collect()}
    expected = df.where("event_month is not null").groupBy("event_month").agg(F.count("*").alias("n"), F.sum("bad").alias("b"))
    assert rows == {r.event_month: (r.n, r.b) for r in expected.collect()}
    assert len(scans) == 2  # the counts, and the rows at the cut of the lift


def test_chi_edges_read_the_rows_once(spark, monkeypatch):
    rows = [(float(i % 250), int(i % 250 > 120 and i % 3 > 0)) for i in range(2000)] + [(None, 1), (float("nan"), 0)]
    df = spark.createDataFrame(rows, "x double, y int").withColumn("same", F.lit(3.0)).withColumn("none", F.lit(None).cast("double"))
    start = binning.fit_bins(df, ["x"], 100)
    fine = binning.bin_counts(df, start, is_bad("y")).where("bin >= 0").toPandas()
    fine["edge"] = [start["x"].edges[b] if b < len(start["x"].edges) else None for b in fine.bin]
    monkeypatch.setattr(binning, "bin_counts", None)
    found = binning.fit_bins(df, ["x", "same", "none"], 4, method="chi", bad=is_bad("y"))
    assert list(found["x"].edges) == binning.chi_merge(fine, 4, 0.01)
    assert found["none"].edges == ()
