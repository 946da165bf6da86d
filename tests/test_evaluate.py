import random

import pytest
from pyspark.sql import functions as F

from oddlens import RiskContract
from oddlens.functions.columns import is_bad
from oddlens.operators import evaluate

# Twenty rows; every third is bad, and the score falls with the row number.
def _small(spark):
    rows = [(i, int(i % 3 == 0), 1 - i / 40) for i in range(20)]
    return spark.createDataFrame(rows, "id long, y int, s double")


def _tied(spark, n=300):
    draw = random.Random(2)
    rows = []
    for i in range(n):
        s = round(draw.random(), 1)
        rows.append((i, draw.choice(["train", "oot"]), int(draw.random() < 0.2 + 0.5 * s), 0.5 if draw.random() < 0.33 else s))
    return spark.createDataFrame(rows, "id long, dataset string, y int, s double")


def test_small_fixture(spark):
    ranked = evaluate.rank_scores(_small(spark), "s", is_bad("y"), ["id"])
    metrics = evaluate.binary_metrics(ranked).first()
    bads = [i for i in range(20) if i % 3 == 0]
    wins = sum(j > i for i in bads for j in range(20) if j not in bads)
    assert metrics.auc == pytest.approx(wins / (7 * 13))
    assert metrics.ks == pytest.approx(max(abs(sum(b <= i for b in bads) / 7 - sum(j not in bads for j in range(i + 1)) / 13) for i in range(20)))
    assert metrics.pr_auc == pytest.approx(sum((k + 1) / (b + 1) for k, b in enumerate(bads)) / 7)
    assert metrics.brier_score == pytest.approx(sum((1 - i / 40 - (i % 3 == 0)) ** 2 for i in range(20)) / 20)
    lift = evaluate.lift_table(ranked).orderBy("bucket").collect()
    assert [round(r.cumulative_bad_capture * 7) for r in lift] == [1, 2, 2, 3, 4, 4, 5, 6, 6, 7]
    assert evaluate.calibration_table(ranked, buckets=5).count() == 5


def test_metrics_against_brute_force(spark):
    df = _tied(spark)
    got = {r.dataset: r for r in evaluate.evaluate_scores(df, "s", is_bad("y"), ["id"], ["dataset"]).collect()}
    for name, row in got.items():
        rows = sorted(((r.s, r.id, r.y) for r in df.collect() if r.dataset == name), key=lambda r: (-r[0], r[1]))
        bads, goods = [r[0] for r in rows if r[2]], [r[0] for r in rows if not r[2]]
        wins = sum((b > g) + 0.5 * (b == g) for b in bads for g in goods)
        assert row.auc == pytest.approx(wins / len(bads) / len(goods))
        gaps = [abs(sum(b >= t for b in bads) / len(bads) - sum(g >= t for g in goods) / len(goods)) for t in set(r[0] for r in rows)]
        assert row.ks == pytest.approx(max(gaps))
        seen, precision = 0, 0.0
        for i, r in enumerate(rows, 1):
            seen += r[2]
            precision += r[2] * seen / i
        assert row.pr_auc == pytest.approx(precision / len(bads))
        assert row.brier_score == pytest.approx(sum((r[0] - r[2]) ** 2 for r in rows) / len(rows))


def test_constant_score_is_not_a_perfect_score(spark):
    df = _small(spark).withColumn("s", F.lit(0.5))
    row = evaluate.evaluate_scores(df, "s", is_bad("y"), ["id"]).first()
    assert row.auc == 0.5 and row.ks == 0.0
    only_good = _small(spark).where("y = 0")
    row = evaluate.evaluate_scores(only_good, "s", is_bad("y"), ["id"]).first()
    assert row.auc is None and row.ks is None and row.pr_auc is None


def test_bootstrap(spark):
    df = _tied(spark)
    rows = {r.metric: r for r in evaluate.bootstrap_intervals(df, "s", is_bad("y"), rounds=60).collect()}
    assert set(rows) == {"auc", "ks", "pr_auc", "brier_score"}
    assert all(r.lower <= r.upper and r.rounds == 60 for r in rows.values())
    assert rows["auc"].lower < rows["auc"].estimate < rows["auc"].upper
    again = {r.metric: r for r in evaluate.bootstrap_intervals(df.repartition(5), "s", is_bad("y"), rounds=60).collect()}
    assert again["auc"].lower == rows["auc"].lower
    other = {r.metric: r for r in evaluate.bootstrap_intervals(df, "s", is_bad("y"), rounds=60, seed=7).collect()}
    assert other["auc"].lower != rows["auc"].lower


def test_poisson_weights_have_mean_and_variance_n(spark):
    for n in (1, 5, 24, 200):
        draws = spark.range(20_000).select(evaluate._poisson_weight(F.lit(n).cast("long"), F.col("id")).alias("w"))
        row = draws.agg(F.avg("w").alias("m"), F.var_pop("w").alias("v")).first()
        assert row.m == pytest.approx(n, rel=0.03) and row.v == pytest.approx(n, rel=0.06)


def test_large_cells_keep_the_skew_of_a_poisson_draw(spark):
    for n in (30, 61, 4_125):
        draws = spark.range(100_000).select(evaluate._poisson_weight(F.lit(n), F.col("id")).alias("w"))
        row = draws.agg(F.avg("w").alias("m"), F.var_pop("w").alias("v"), F.skewness("w").alias("s")).first()
        assert row.m == pytest.approx(n, rel=0.01) and row.v == pytest.approx(n, rel=0.03)
        if n < 100:  # a rounded normal has none
            assert row.s == pytest.approx(n**-0.5, abs=0.04)


def test_thin_curve_keeps_ends(spark):
    points = spark.range(200).select(F.col("id").cast("double").alias("x"))
    kept = sorted(r.x for r in evaluate.thin_curve(points, ["x"]).collect())
    assert len(kept) == 41 and kept[0] == 0 and kept[-1] == 199
    assert evaluate.thin_curve(points.limit(30), ["x"]).count() == 30


def test_group_columns(spark):
    rows = [(i, "202501", i % 2, "a" if i % 3 else None, f"v{i}", i % 4, i % 5) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, d string, y int, kind string, wide string, region_code int, plain int")
    contract = RiskContract(("id",), "d", "y")
    assert evaluate.detect_group_columns(df, contract) == ["region_code", "kind"]
