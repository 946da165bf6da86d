import pytest
from pyspark.sql import functions as F

from oddlens.functions.columns import is_bad
from oddlens.operators import boost

PARAMS = boost.BoosterParams(max_depth=2, num_boost_round=3, min_data_in_leaf=1, early_stopping_rounds=2)


def _table(spark):
    rows = [(i, "train" if i < 60 else "test", i % 2, float(i % 7) if i % 11 else None, i % 3) for i in range(80)]
    return spark.createDataFrame(rows, "id long, dataset string, target int, amount double, channel int")


def test_class_weight_is_good_over_bad_in_train(spark):
    train = _table(spark).where("dataset = 'train' and (target = 0 or id < 30)")
    row = boost.class_weights(train, is_bad("target")).first()
    assert row.bad_weight == pytest.approx(row.good_count / row.bad_count)


def test_fit_score_and_importance(spark):
    df = _table(spark)
    trained = boost.fit_booster(df, ["amount", "channel"], is_bad("target"), PARAMS, balance=True)
    assert 1 <= trained.best_iteration <= 3 and trained.history.count() == 3
    assert trained.history.where("is_best_iteration").count() == 1
    scored = boost.score_rows(df, trained)
    assert scored.count() == 80 and scored.where("bad_probability between 0 and 1").count() == 80
    assert set(scored.columns) == {*df.columns, "bad_probability"}
    gains = boost.feature_importance(trained, df).collect()
    assert {r.feature for r in gains} == {"amount", "channel"} and sum(r.gain_importance for r in gains) > 0


def test_staged_score_of_all_trees_is_the_model_score(spark):
    df = _table(spark)
    trained = boost.fit_booster(df, ["amount", "channel"], is_bad("target"), PARAMS)
    ready = boost.assemble(df, ["amount", "channel"])
    staged = boost.staged_scores(ready, trained.model, ["id"]).where("iteration = 3")
    from pyspark.ml.functions import vector_to_array

    own = trained.model.transform(ready).select("id", vector_to_array("probability")[1].alias("p"))
    assert staged.join(own, "id").where(F.abs(F.col("score") - F.col("p")) > 1e-9).count() == 0


def test_permutation_and_parameters(spark):
    df = _table(spark)
    trained = boost.fit_booster(df, ["amount", "channel"], is_bad("target"), PARAMS)
    rows = boost.permutation_importance(df, trained, is_bad("target"), ["id"]).collect()
    assert len(rows) == 4 and all(r.permutation_importance >= 0 for r in rows)
    drawn = boost.sample_parameters(PARAMS, 20, seed=1)
    assert drawn == boost.sample_parameters(PARAMS, 20, seed=1)
    assert all(3 <= p.max_depth <= 8 and 0.01 <= p.learning_rate <= 0.08 for p in drawn)


def _assembled(spark, n=400):
    df = spark.range(n, numPartitions=3).select(
        F.col("id"), F.when(F.col("id") % 4 == 0, "test").otherwise("train").alias("dataset"),
        (F.pmod(F.xxhash64("id"), F.lit(100)) < 30).cast("int").alias("target"),
        F.when(F.col("id") % 9 != 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(50)).cast("double")).alias("amount"),
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(8)).cast("double").alias("code"),
    )
    return df


def test_a_thousand_trees_are_scored_and_have_a_history(spark):
    from pyspark import SparkContext
    from pyspark.ml.classification import GBTClassificationModel
    from pyspark.ml.functions import vector_to_array

    df = _assembled(spark)
    small = boost.fit_booster(df, ["amount", "code"], is_bad("target"), boost.BoosterParams(max_depth=2, num_boost_round=10, early_stopping_rounds=10)).model
    gateway, count = SparkContext._active_spark_context._gateway, 1000
    classes = SparkContext._active_spark_context._jvm.org.apache.spark.ml
    trees, weights = gateway.new_array(classes.regression.DecisionTreeRegressionModel, count), gateway.new_array(gateway.jvm.double, count)
    for k in range(count):
        trees[k], weights[k] = small._java_obj.trees()[k % 10], 0.001 * (k % 7)
    model = GBTClassificationModel(classes.classification.GBTClassificationModel("many", trees, weights, 2, 2))
    ready = boost.assemble(df, ["amount", "code"]).withColumn("label", F.col("target").cast("double"))
    history = boost.training_history(ready.select("features", "dataset", "label"), model).collect()
    assert len(history) == count
    trained = boost.BoostedModel(model, ("amount", "code"), 700, None, boost.BoosterParams(), 1)
    own = boost.score_rows(df, trained).select("id", "bad_probability")
    staged = boost.staged_scores(ready, model, ["id"]).where("iteration = 700")
    assert staged.join(own, "id").where(F.abs(F.col("score") - F.col("bad_probability")) > 1e-9).count() == 0
    whole = model.transform(ready).select("id", vector_to_array("probability")[1].alias("p"))
    last = boost.staged_scores(ready, model, ["id"]).where("iteration = 1000")
    assert last.join(whole, "id").where(F.abs(F.col("score") - F.col("p")) > 1e-9).count() == 0


def test_history_counts_equal_the_scores_themselves(spark):
    df = _assembled(spark)
    ready = boost.assemble(df, ["amount", "code"]).withColumn("label", F.col("target").cast("double")).select("features", "dataset", "label")
    model = boost.fit_booster(df, ["amount", "code"], is_bad("target"), boost.BoosterParams(max_depth=3, num_boost_round=6, early_stopping_rounds=6)).model
    cells = {tuple(r) for r in boost.staged_counts(ready, model, 1 << 10).collect()}
    exact = boost.staged_scores(ready, model, ["dataset", "label"]).withColumn("score", F.round(F.col("score") * 1024) / 1024)
    expected = exact.groupBy("dataset", "iteration", "score").agg(F.count("*").alias("n"), F.sum("label").cast("long").alias("bad"))
    assert cells == {tuple(r) for r in expected.collect()}


def test_permuted_scores_leave_a_task_as_counts(spark):
    df = _assembled(spark, 20_000)
    trained = boost.fit_booster(df, ["amount", "code"], is_bad("target"), boost.BoosterParams(max_depth=2, num_boost_round=2))
    df = df.withColumn("dataset", F.when(F.col("id") == 7, "single").when(F.col("id") == 9, F.lit(None)).otherwise(F.col("dataset")))
    pairs = boost.shifted_rows(df, trained, is_bad("target"), ["id"], 42, "dataset")
    sides = [{(r.dataset, tuple(r.x)): r.n for r in pairs.groupBy("dataset", F.col(c).alias("x")).agg(F.count("*").alias("n")).collect()} for c in ("__x", "__other")]
    assert sides[0] == sides[1] and sum(sides[0].values()) == 19_999
    cells = boost.permuted_counts(pairs, trained, "dataset")
    total = cells.agg(F.sum("n").alias("n"), F.count("*").alias("rows")).first()
    assert total.n == 3 * 19_999 and total.rows < 6_000


def test_seeds_share_the_training_rows(spark, monkeypatch):
    df = _assembled(spark)
    written = []
    own = boost.stage
    monkeypatch.setattr(boost, "stage", lambda table, **options: written.append(table.columns) or own(table, **options))
    params = boost.BoosterParams(max_depth=2, num_boost_round=2)
    found = boost.seed_stability(df, ["amount", "code"], is_bad("target"), ["id"], params, seeds=2).collect()
    assert len(found) == 4 and written.count(["features", "dataset", "label"]) == 1
    assert written.count(["dataset", "id", "__bad", "bad_probability"]) == 2


def test_a_task_holds_little_of_the_history():
    import tracemalloc

    import numpy as np

    draw = np.random.default_rng(1)
    parts = (draw.integers(0, 300_000, 16_384) for _ in range(400))  # 6.5 million scores
    tracemalloc.start()
    counted = sum(int(n.sum()) for _, n in boost.counted_slices(parts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counted == 400 * 16_384 and peak < 40e6


def test_growing_stops_by_itself(spark):
    params = boost.BoosterParams(max_depth=2, num_boost_round=1000, early_stopping_rounds=12, min_data_in_leaf=5, learning_rate=0.3)
    trained = boost.fit_booster(_assembled(spark), ["amount", "code"], is_bad("target"), params)
    last = trained.history.agg(F.max("iteration")).first()[0]
    assert last <= trained.best_iteration + 12 and len(trained.model.treeWeights) < 1000


def test_codes_without_order_are_split_in_one_level(spark):
    df = spark.range(600).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "test").otherwise("train").alias("dataset"), (F.col("id") % 8).cast("int").alias("code"), F.lit(1.0).alias("same")
    )
    df = df.withColumn("code", F.when(F.col("id") > 590, F.lit(None)).otherwise(F.col("code")))
    df = df.withColumn("target", F.coalesce((F.col("code") % 2).cast("int"), F.lit(1)))
    params = boost.BoosterParams(max_depth=1, num_boost_round=1, min_data_in_leaf=1)
    ordered = boost.fit_booster(df, ["code", "same"], is_bad("target"), params)
    nominal = boost.fit_booster(df, ["code", "same"], is_bad("target"), params, categorical={"code": 8})
    best = [t.history.first().test_auc for t in (ordered, nominal)]
    assert best[0] < 0.8 and best[1] == 1.0
    scored = boost.score_rows(df, nominal)
    assert scored.where((F.col("bad_probability") > 0.5) != (F.col("target") == 1)).count() == 0
    unseen = df.limit(1).withColumn("code", F.lit(77))
    assert boost.score_rows(unseen, nominal).count() == 1


def test_permutation_equals_a_full_scoring(spark):
    df = _assembled(spark)
    trained = boost.fit_booster(df, ["amount", "code"], is_bad("target"), boost.BoosterParams(max_depth=3, num_boost_round=8, early_stopping_rounds=8), categorical={"code": 8})
    found = {(r.feature, r.dataset): r for r in boost.permutation_importance(df, trained, is_bad("target"), ["id"]).collect()}
    from oddlens.functions.ranking import global_row_number
    from oddlens.operators.evaluate import score_auc_ks

    ranked = global_row_number(df.withColumn("h", F.xxhash64(F.lit(42), "id")), ["h", "id"], ["dataset"], name="k").cache()
    for f in ("amount", "code"):
        following = ranked.select("dataset", F.when(F.col("k") == 1, F.col("tot_n")).otherwise(F.col("k") - 1).alias("k"), F.col(f).alias("other"))
        mixed = ranked.join(following, ["dataset", "k"]).withColumn(f, F.col("other"))
        for r in score_auc_ks(boost.score_rows(mixed, trained, "s"), "s", F.col("target"), ["dataset"]).collect():
            assert found[f, r.dataset].shuffled_auc == pytest.approx(r.auc_raw, abs=1e-9)
