import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from oddlens import ContractError
from oddlens.functions.columns import is_bad
from oddlens.operators import select, split


def _months(spark, counts):
    return spark.createDataFrame([(f"2025{i + 1:02d}", n) for i, n in enumerate(counts)], "event_month string, sample_count long")


def test_rolling_folds(spark):
    plan = split.rolling_folds(_months(spark, [2] * 6), folds=4, min_train_months=2).collect()
    by = {}
    for r in plan:
        by.setdefault((r.fold, r.role), []).append(r.event_month)
    assert sorted(by[1, "train"]) == ["202501", "202502"] and by[1, "validation"] == ["202503"]
    assert len(by[4, "train"]) == 5 and by[4, "validation"] == ["202506"]
    assert max(r.fold for r in plan) == 4
    assert split.rolling_folds(_months(spark, [2] * 2), folds=4).count() == 0


def test_time_split_is_disjoint_and_ordered(spark):
    rows = [(i, f"2025{1 + i % 12:02d}" if i else None, i % 2) for i in range(240)]
    df = spark.createDataFrame(rows, "id long, event_month string, y int")
    done = split.time_split(df, 2, 2)
    assert done.count() == 239
    months = {r.dataset: r.months for r in split.split_summary(done, is_bad("y")).collect()}
    assert months["oot"] == "202511,202512" and months["test"] == "202509,202510"
    with pytest.raises(ContractError):
        split.time_split(df, 6, 6)


def test_ratio_split(spark):
    labels = {r.event_month: r.dataset for r in split.ratio_split_months(_months(spark, [100] * 9 + [5])).collect()}
    assert labels["202510"] == "excluded" and labels["202509"] == labels["202508"] == "oot"
    assert [m for m, d in labels.items() if d == "validate"] and labels["202507"] == "validate"
    assert labels["202501"] == "train"


def test_stratified_counts(spark):
    df = spark.createDataFrame([(i, int(i < 31)) for i in range(200)], "id long, y int")
    done = split.stratified_test(df, "y", ["id"], 0.2)
    counts = {(r.y, r.dataset): r["count"] for r in done.groupBy("y", "dataset").count().collect()}
    assert counts[1, "test"] == 6 and counts[0, "test"] == round(169 * 0.2)
    again = split.stratified_test(df.repartition(7), "y", ["id"], 0.2)
    assert done.join(again, ["id", "y", "dataset"]).count() == 200
    folds = split.stratified_folds(df, "y", ["id"], 3)
    assert {r["count"] for r in folds.where("y = 1").groupBy("fold").count().collect()} == {10, 11}


def _selection_table(spark):
    rows = []
    for m in range(4):
        for i in range(60):
            y = i % 2
            strong = 2 * y + (i % 7) * 0.01
            rows.append((m * 60 + i, f"20250{m + 1}", y, strong, strong + (i % 5) * 0.08, 100.0 * m + y, 1.0, "bad" if y else "good"))
    return spark.createDataFrame(
        rows, "id long, event_month string, y int, strong double, weak double, unstable double, constant double, channel string"
    )


def test_selection(spark):
    rules = select.SelectionRules(
        min_iv=0.0, max_correlation=0.8, max_psi=0.01, max_unstable_ratio=0.2, min_month_samples=1, stability_action="drop"
    )
    decisions = select.select_features(_selection_table(spark), ["strong", "weak", "unstable", "constant", "channel"], is_bad("y"), rules)
    rows = {r.feature: r for r in decisions.collect()}
    assert rows["constant"].decision == "excluded_constant" and rows["unstable"].decision == "excluded_unstable"
    lost = [f for f in ("strong", "weak") if rows[f].decision == "excluded_correlation"]
    assert len(lost) == 1
    kept = rows[lost[0]].correlated_with
    assert rows[kept].iv >= rows[lost[0]].iv and rows["channel"].decision.startswith("retained")
    assert set(select.retained_features(decisions)) == {kept, "channel"}


def test_pruning_follows_the_greedy_walk(spark):
    metrics = spark.createDataFrame(
        [("a", False, 0.5, 0.0, "candidate"), ("b", False, 0.4, 0.0, "candidate"), ("c", False, 0.3, 0.0, "candidate"), ("d", True, 0.9, 0.0, "candidate"), ("e", False, 0.9, 0.0, "excluded_missing")],
        "feature string, unstable boolean, iv double, missing_rate double, decision string",
    )
    pairs = spark.createDataFrame(
        [("a", "b", 0.9), ("b", "c", 0.95), ("c", "d", 0.85), ("a", "e", 0.99)], "feature_1 string, feature_2 string, r double"
    ).select("feature_1", "feature_2", F.col("r").alias("correlation"), F.col("r").alias("abs_correlation"))
    # b goes for a; c stays since b is gone; d is unstable, comes last and goes for c
    assert select.prune_correlated(metrics, pairs, 0.8) == {"b": "a", "d": "c"}


@pytest.mark.parametrize("seed", range(3))
def test_pruning_of_random_graphs_is_the_greedy_walk(spark, seed):
    draw = random.Random(seed)
    n = 25
    names = [f"f{k:02d}" for k in range(n)]
    shuffled = draw.sample(names, n)  # from the strongest to the weakest
    metrics = spark.createDataFrame(
        [(f, k > 18, 1 - k / 100, 0.0, "candidate") for k, f in enumerate(shuffled)],
        "feature string, unstable boolean, iv double, missing_rate double, decision string",
    )
    rows = [(a, b, draw.random()) for i, a in enumerate(names) for b in names[i + 1 :]]
    pairs = spark.createDataFrame(rows, "feature_1 string, feature_2 string, correlation double").withColumn("abs_correlation", F.col("correlation"))
    strong = {frozenset((a, b)) for a, b, r in rows if r > 0.8}
    kept, replaced = [], {}
    for f in shuffled:
        clash = next((k for k in kept if frozenset((k, f)) in strong), None)
        if clash is None:
            kept.append(f)
        else:
            replaced[f] = clash
    assert replaced and select.prune_correlated(metrics, pairs, 0.8) == replaced
    assert select.prune_correlated(metrics, pairs, 1.1) == {}
    assert select.prune_correlated(metrics.limit(0), pairs, 0.8) == {}


def test_cuts_are_exact_and_leave_wide_rows_unsorted(spark):
    rows = [(k, "x" * 20, ["a", "b", None][min(k % 7, 2)]) for k in range(5000)] + [(9000, "x", "c"), (9001, "x", "d"), (9002, "x", "d")]
    df = spark.createDataFrame(rows, "id long, wide string, y string").repartition(9)
    sizes = Counter(r[2] for r in rows)
    done = split.stratified_test(df, "y", ["id"], 0.3)
    tests = Counter(r.y for r in done.where("dataset = 'test'").collect())
    assert tests == {y: max(1, min(round(n * 0.3), n - 1)) for y, n in sizes.items() if y is not None and n > 1}
    folds = split.stratified_folds(df, "y", ["id"], 4)
    found = Counter((r.y, r.fold) for r in folds.collect())
    assert sum(found.values()) == len(rows)
    for y, n in sizes.items():
        assert [found[y, k + 1] for k in range(4)] == [n // 4 + (k < n % 4) for k in range(4)]
    assert done.columns == [*df.columns, "dataset"] and folds.columns == [*df.columns, "fold"]
    assert split.stratified_folds(df, "y", ["id"], 1).where("fold = 1").count() == len(rows)
    for plan in (done, folds):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in text and "Window" not in text


def test_repeated_ids_stay_together(spark):
    df = spark.createDataFrame([(k // 50, 1) for k in range(500)] + [(77, 0)] * 6, "id long, y int")
    done = split.stratified_test(df, "y", ["id"], 0.2)
    assert done.groupBy("y", "id").agg(F.count_distinct("dataset").alias("n")).where("n > 1").count() == 0
    assert done.where("dataset = 'test' and y = 1").count() == 100 and done.where("dataset = 'test' and y = 0").count() == 0
    folds = split.stratified_folds(df, "y", ["id"], 3)
    assert folds.groupBy("y", "id").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    assert split.stratified_test(df.limit(0), "y", ["id"]).count() == 0
