"""Evaluation of a tied score over splits, months and groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oddlens.catalog.base import CATEGORICAL, CONTRACT, FEATURES, IDS, METRICS_SQL, SAMPLES_SQL, bad, check, rounded, scored
from oddlens.catalog.tracking import QUANTILE_SCORE_EDGES, score_psi_sql
from oddlens.operators import evaluate


def _ranked(spark: SparkSession, folder: str, ascending: bool = False) -> DataFrame:
    return evaluate.rank_scores(scored(spark, folder), "score", bad(), IDS, ["dataset"], ascending)


def split_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate.binary_metrics(_ranked(spark, folder), ["dataset"]))


def score_auc_ks(spark: SparkSession, folder: str) -> DataFrame:
    """AUC and KS from score counts only, without ordering rows."""
    return rounded(evaluate.score_auc_ks(scored(spark, folder), "score", bad(), ["dataset"]))


def lift_table(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate.lift_table(_ranked(spark, folder), ["dataset"]))


def decile_table(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate.decile_table(_ranked(spark, folder), ["dataset"]))


def cumulative_lift(spark: SparkSession, folder: str) -> DataFrame:
    lift = evaluate.lift_table(_ranked(spark, folder), ["dataset"])
    return rounded(evaluate.cumulative_lift(lift).select("dataset", "bucket", "cumulative_sample_rate", "cumulative_bad_capture", "cumulative_lift", "reliability"))


def calibration_table(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate.calibration_table(_ranked(spark, folder), ["dataset"]))


def score_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate.score_distribution(_ranked(spark, folder, ascending=True), ["dataset"]))


def roc_points(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate.roc_points(_ranked(spark, folder), ["dataset"]))


def pr_points(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate.pr_points(_ranked(spark, folder), ["dataset"]))


def ks_curve(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate.ks_curve(_ranked(spark, folder), ["dataset"]))


def thinned_roc(spark: SparkSession, folder: str) -> DataFrame:
    points = evaluate.roc_points(_ranked(spark, folder), ["dataset"])
    return rounded(evaluate.thin_curve(points.select("dataset", "fpr", "tpr"), ["tpr", "fpr"], ["dataset"]))


def bootstrap_intervals(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.bootstrap_intervals(scored(spark, folder), "score", bad(), rounds=200, keys=["dataset"])


def bootstrap_estimates(spark: SparkSession, folder: str) -> DataFrame:
    """The estimates that the intervals surround, and whether they do."""
    found = evaluate.bootstrap_intervals(scored(spark, folder), "score", bad(), rounds=200, keys=["dataset"])
    usable = found.where("metric in ('auc', 'ks', 'brier_score') and dataset = 'train'")
    return rounded(usable.select("metric", "estimate", "rounds", (F.col("estimate").between(F.col("lower"), F.col("upper"))).alias("covered")))


def metrics_by_split(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate.metrics_by_split(scored(spark, folder), "score", bad(), IDS))


def _squares(metrics: DataFrame) -> DataFrame:
    """Brier score times rows: a sum of six-digit numbers, so it rounds alike anywhere."""
    total = (F.col("brier_score") * F.col("sample_count")).alias("squared_error")
    return metrics.select("*", total).drop("auc_adjusted", "gini", "brier_score")


def monthly_performance(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_squares(evaluate.monthly_performance(scored(spark, folder), "score", bad(), IDS)))


def group_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Monitoring dimensions found in the train split, with their sizes."""
    train = scored(spark, folder).where("dataset = 'train'")
    names = evaluate.detect_group_columns(train, CONTRACT, FEATURES)
    parts = [train.agg(F.count_distinct(n).alias("values")).select(F.lit(n).alias("dimension"), "values") for n in names]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def group_performance(spark: SparkSession, folder: str) -> DataFrame:
    rows = scored(spark, folder)
    return rounded(_squares(evaluate.group_performance(rows, "score", bad(), IDS, ["event_month", *CATEGORICAL])))


QUERIES = {
    f.__name__: f
    for f in (
        split_metrics, score_auc_ks, lift_table, decile_table, cumulative_lift, calibration_table, score_distribution,
        roc_points, pr_points, ks_curve, thinned_roc, bootstrap_intervals, bootstrap_estimates, metrics_by_split,
        monthly_performance, group_columns, group_performance,
    )
}

BUCKETS_SQL = METRICS_SQL + """,
bk AS (
  SELECT dataset, CAST((rn*10 + tn - 1) // tn AS INTEGER) AS bucket, min(score) AS score_min, max(score) AS score_max, count(*) AS sample_count,
    sum(bad) AS bad_count, avg(score) AS mean_predicted, max(tn) AS tn, max(tb) AS tb FROM ordered GROUP BY 1, 2),
br AS (SELECT *, sum(sample_count) OVER w AS cn, sum(bad_count) OVER w AS cb FROM bk WINDOW w AS (PARTITION BY dataset ORDER BY bucket))
"""
_METRICS = ["bad_rate", "auc", "auc_adjusted", "gini", "ks", "pr_auc", "brier_score"]
_ROC = METRICS_SQL + """,
roc AS (
  SELECT dataset, CAST(NULL AS DOUBLE) AS threshold, 0e0 AS fpr, 0e0 AS tpr FROM tie_metrics
  UNION ALL SELECT dataset, score, (rn-cb)/(tn-tb), cb/tb FROM ties)
"""


def keyed_metrics(key: str, source: str) -> str:
    """Metrics per data set and one more key, from rows ``(dataset, key, id, score, bad)``."""
    return f"""
ko AS (
  SELECT *, row_number() OVER w AS rn, sum(bad) OVER w AS cb, count(*) OVER (PARTITION BY dataset, {key}) AS tn, sum(bad) OVER (PARTITION BY dataset, {key}) AS tb
  FROM {source} WINDOW w AS (PARTITION BY dataset, {key} ORDER BY score DESC, o_orderkey ROWS UNBOUNDED PRECEDING)),
kt AS (SELECT dataset, {key}, score, count(*) AS n, sum(bad) AS b, max(rn) AS rn, max(cb) AS cb, max(tn) AS tn, max(tb) AS tb FROM ko GROUP BY ALL),
km AS (SELECT dataset, {key}, max(abs(cb/nullif(tb, 0) - (rn-cb)/nullif(tn-tb, 0))) AS ks,
    (sum(b*(tn-rn+(n+1)/2e0)) - max(tb)*(max(tb)+1)/2e0)/nullif(max(tb)*CAST(max(tn)-max(tb) AS DOUBLE), 0) AS auc FROM kt GROUP BY ALL),
kr AS (SELECT dataset, {key}, count(*) AS sample_count, sum(bad) AS bad_count, sum(bad*(cb/rn))/nullif(sum(bad), 0) AS pr_auc, avg((score-bad)*(score-bad)) AS brier_score FROM ko GROUP BY ALL),
keyed AS (SELECT * , bad_count/sample_count AS bad_rate FROM kr JOIN km USING (dataset, {key}))
"""


_GROUPS = METRICS_SQL + ",\nlong AS (" + " UNION ALL ".join(
    f"SELECT dataset, '{c}' AS dimension, coalesce({c}, '<MISSING>') AS group_value, '{c}' || '|' || coalesce({c}, '<MISSING>') AS g, o_orderkey, score, bad FROM scored"
    for c in ["event_month", *CATEGORICAL]
) + ")," + keyed_metrics("g", "long")

CHECKS = {
    "split_metrics": check(METRICS_SQL, "SELECT * FROM split_metrics", _METRICS, ["bad_count"]),
    "score_auc_ks": check(METRICS_SQL, "SELECT dataset, sample_count, bad_count, sample_count - bad_count AS good_count, ks, auc AS auc_raw, auc_adjusted AS auc FROM split_metrics", ["ks", "auc_raw", "auc"], ["sample_count", "bad_count", "good_count"]),
    "lift_table": check(
        BUCKETS_SQL,
        "SELECT dataset, bucket, score_min, score_max, sample_count, bad_count, bad_count/sample_count AS bad_rate, (bad_count/sample_count)/(tb/tn) AS lift, cn/tn AS cumulative_sample_rate, cb/tb AS cumulative_bad_capture FROM br",
        ["score_min", "score_max", "bad_rate", "lift", "cumulative_sample_rate", "cumulative_bad_capture"], ["bad_count"],
    ),
    "decile_table": check(
        BUCKETS_SQL,
        "SELECT dataset, bucket AS decile, sample_count, bad_count, bad_count/sample_count AS bad_rate, (bad_count/sample_count)/(tb/tn) AS lift, cb/tb AS cumulative_gain, sample_count/tn AS sample_rate FROM br",
        ["bad_rate", "lift", "cumulative_gain", "sample_rate"], ["bad_count"],
    ),
    "cumulative_lift": check(
        BUCKETS_SQL,
        "SELECT dataset, bucket, cn/tn AS cumulative_sample_rate, cb/tb AS cumulative_bad_capture, (cb/tb)/(cn/tn) AS cumulative_lift, CASE WHEN least(bad_count, sample_count-bad_count) < 10 THEN 'insufficient' WHEN least(bad_count, sample_count-bad_count) < 30 THEN 'directional' ELSE 'usable' END AS reliability FROM br",
        ["cumulative_sample_rate", "cumulative_bad_capture", "cumulative_lift"],
    ),
    "calibration_table": check(
        BUCKETS_SQL,
        "SELECT dataset, bucket, sample_count, mean_predicted, bad_count/sample_count AS observed_bad_rate, abs(mean_predicted - bad_count/sample_count) AS absolute_error FROM br",
        ["mean_predicted", "observed_bad_rate", "absolute_error"],
    ),
    "score_distribution": check(
        SAMPLES_SQL + """,
        ao AS (SELECT dataset, score, bad, row_number() OVER (PARTITION BY dataset ORDER BY score, o_orderkey) AS rn, count(*) OVER (PARTITION BY dataset) AS tn FROM scored),
        ab AS (SELECT dataset, CAST((rn*10 + tn - 1) // tn AS INTEGER) AS bucket, min(score) AS score_min, max(score) AS score_max, count(*) AS sample_count, sum(bad) AS bad_count FROM ao GROUP BY 1, 2)""",
        "SELECT dataset, bucket, printf('P%02d (%.4f–%.4f)', bucket, score_min, score_max) AS label, sample_count - bad_count AS good_count, bad_count, sample_count, score_min, score_max FROM ab",
        ["score_min", "score_max"], ["good_count", "bad_count"],
    ),
    "roc_points": check(_ROC, "SELECT * FROM roc", ["threshold", "fpr", "tpr"]),
    "pr_points": check(
        METRICS_SQL,
        "SELECT dataset, CAST(NULL AS DOUBLE) AS threshold, 0e0 AS recall, 1e0 AS precision FROM tie_metrics UNION ALL SELECT dataset, score, cb/tb, cb/rn FROM ties",
        ["threshold", "recall", "precision"],
    ),
    "ks_curve": check(
        METRICS_SQL,
        "SELECT dataset, rn AS position, rn/tn AS population_rate, cb/tb AS cumulative_bad_rate, (rn-cb)/(tn-tb) AS cumulative_good_rate, abs(cb/tb - (rn-cb)/(tn-tb)) AS ks FROM ordered",
        ["population_rate", "cumulative_bad_rate", "cumulative_good_rate", "ks"],
    ),
    "thinned_roc": check(
        _ROC + ", rp AS (SELECT dataset, fpr, tpr, row_number() OVER (PARTITION BY dataset ORDER BY tpr, fpr) - 1 AS point, count(*) OVER (PARTITION BY dataset) AS t FROM roc)",
        "SELECT dataset, fpr, tpr, point FROM rp WHERE t <= 41 OR point = t - 1 OR list_contains(list_transform(range(0, 40), lambda j: CAST(floor(j*((t-1)/40e0)) AS BIGINT)), point)",
        ["fpr", "tpr"],
    ),
    "bootstrap_estimates": check(
        METRICS_SQL,
        "SELECT 'auc' AS metric, auc AS estimate, 200 AS rounds, true AS covered FROM split_metrics WHERE dataset = 'train' UNION ALL SELECT 'ks', ks, 200, true FROM split_metrics WHERE dataset = 'train' UNION ALL SELECT 'brier_score', brier_score, 200, true FROM split_metrics WHERE dataset = 'train'",
        ["estimate"],
    ),
    "metrics_by_split": check(
        score_psi_sql(QUANTILE_SCORE_EDGES, "0.5e0") + METRICS_SQL[len(SAMPLES_SQL) :],
        "SELECT m.*, p.score_psi AS score_psi_vs_train FROM split_metrics m LEFT JOIN score_psi p USING (dataset)",
        [*_METRICS, "score_psi_vs_train"], ["bad_count"],
    ),
    "monthly_performance": check(SAMPLES_SQL + "," + keyed_metrics("event_month", "scored"), "SELECT dataset, event_month, sample_count, bad_count, bad_rate, auc, ks, pr_auc, brier_score*sample_count AS squared_error FROM keyed", ["bad_rate", "auc", "ks", "pr_auc", "squared_error"], ["bad_count"]),
    "group_columns": check(
        SAMPLES_SQL,
        "SELECT 'c_mktsegment' AS dimension, count(DISTINCT c_mktsegment) AS values FROM scored WHERE dataset = 'train' UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority) FROM scored WHERE dataset = 'train'",
    ),
    "group_performance": check(
        _GROUPS,
        "SELECT dataset, split_part(g, '|', 1) AS dimension, split_part(g, '|', 2) AS group_value, sample_count, bad_count, bad_rate, auc, ks, pr_auc, brier_score*sample_count AS squared_error FROM keyed WHERE sample_count >= 20",
        ["bad_rate", "auc", "ks", "pr_auc", "squared_error"], ["bad_count"],
    ),
}
