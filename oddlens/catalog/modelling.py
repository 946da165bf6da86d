"""Boosted trees on the sample table. Tree fits have no SQL form; what SQL can state
about their results (counts, ranges, sums) is checked where possible."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oddlens.catalog.base import CONTRACT, FEATURES, IDS, SAMPLES_SQL, bad, check, samples, split_samples
from oddlens.operators import boost, evaluate, prepare, review, select, split
from oddlens.plans.modeling import run_model
from oddlens.sources.stages import stage

PARAMS = boost.BoosterParams(max_depth=3, num_boost_round=8, early_stopping_rounds=4, min_data_in_leaf=20)
SMALL = boost.BoosterParams(max_depth=3, num_boost_round=4, early_stopping_rounds=4, min_data_in_leaf=20)


def _matrix(spark: SparkSession, folder: str) -> DataFrame:
    rows = split_samples(spark, folder)
    plan = prepare.fit_preparation(rows.where("dataset = 'train'"), FEATURES)
    return stage(prepare.transform_features(rows, plan), partition_by=["dataset"])


def boosted_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Probability of bad for every row of every split."""
    matrix = _matrix(spark, folder)
    scored = boost.score_rows(matrix, boost.fit_booster(matrix, FEATURES, bad(), PARAMS))
    return scored.select("o_orderkey", "dataset", "bad", "bad_probability")


def boosted_score_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Each row is scored once and every score is a probability."""
    scored = boosted_scores(spark, folder)
    return scored.groupBy("dataset").agg(
        F.count("*").alias("n"), F.count_if(F.col("bad_probability").between(0, 1)).alias("scored"), F.sum("bad").alias("bad")
    )


def weighted_boost_metrics(spark: SparkSession, folder: str) -> DataFrame:
    matrix = _matrix(spark, folder)
    scored = stage(boost.score_rows(matrix, boost.fit_booster(matrix, FEATURES, bad(), PARAMS, balance=True)))
    return evaluate.evaluate_scores(scored, "bad_probability", bad(), IDS, ["dataset"])


def training_history(spark: SparkSession, folder: str) -> DataFrame:
    return boost.fit_booster(_matrix(spark, folder), FEATURES, bad(), PARAMS).history


def feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    matrix = _matrix(spark, folder)
    return review.gain_shares(boost.feature_importance(boost.fit_booster(matrix, FEATURES, bad(), PARAMS), matrix))


def permutation_importance(spark: SparkSession, folder: str) -> DataFrame:
    matrix = _matrix(spark, folder)
    trained = boost.fit_booster(matrix, FEATURES, bad(), SMALL)
    return boost.permutation_importance(matrix, trained, bad(), IDS)


def seed_stability(spark: SparkSession, folder: str) -> DataFrame:
    params = boost.BoosterParams(max_depth=3, num_boost_round=4, bagging_fraction=0.7)
    return boost.seed_stability(_matrix(spark, folder), FEATURES, bad(), IDS, params, seeds=2)


def tuned_trials(spark: SparkSession, folder: str) -> DataFrame:
    train = stage(_matrix(spark, folder).where("dataset = 'train'").drop("dataset"))
    plan = split.rolling_folds(split.month_counts(train), folds=2, validation_months=6, min_train_months=24)
    _, table, _ = boost.tune_booster(train, FEATURES, bad(), plan, SMALL, trials=2)
    return table


def model_run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """The whole run: clean, split, select on train, train, score, evaluate."""
    rules = select.SelectionRules(min_iv=0.001, correlation_method="pearson")
    run = run_model(samples(spark, folder), CONTRACT, ["o_orderkey"], PARAMS, rules, oot_months=6, test_months=6)
    return run.metrics


QUERIES = {
    f.__name__: f
    for f in (
        boosted_scores, boosted_score_counts, weighted_boost_metrics, training_history, feature_importance,
        permutation_importance, seed_stability, tuned_trials, model_run_metrics,
    )
}

CHECKS = {
    "boosted_score_counts": check(SAMPLES_SQL, "SELECT dataset, count(*) AS n, count(*) AS scored, sum(bad) AS bad FROM scored GROUP BY 1", longs=["bad"]),
}
