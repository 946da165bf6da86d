"""Review rules, trial and candidate tables over measured scores.

Candidates are scores taken from the sample columns, so every rule reads metrics
that Spark computed from the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oddlens.catalog.base import CELLS_SQL, FEATURES, IDS, SAMPLES_SQL, bad, check, dated, rounded, scored
from oddlens.catalog.evaluating import BUCKETS_SQL, keyed_metrics
from oddlens.catalog.splitting import folds_sql
from oddlens.catalog.tracking import QUANTILE_SCORE_EDGES, score_psi_sql
from oddlens.operators import boost, discrimination, evaluate, review, split
from oddlens.sources.stages import stage

# Candidate scores as SQL expressions valid in both engines.
CANDIDATES = {
    "baseline": "score",
    "blend": "score + CASE WHEN o_orderpriority = '1-URGENT' THEN 0.3 ELSE 0.0 END",
    "price": "o_totalprice / 1000000",
    "flat": "0.5",
}


def _candidate_rows(rows: DataFrame) -> DataFrame:
    names = list(CANDIDATES)
    wide = rows.select(
        "dataset", "event_month", bad().cast("long").alias("bad"), *[F.expr(f"cast({CANDIDATES[n]} as double)").alias(n) for n in names]
    )
    return wide.unpivot(["dataset", "event_month", "bad"], names, "candidate", "value")


def candidate_metrics(rows: DataFrame) -> DataFrame:
    """One row per candidate with train / test / oot metrics side by side."""
    long = _candidate_rows(rows)
    metrics = evaluate.score_auc_ks(long, "value", F.col("bad"), ["candidate", "dataset"])
    wide = metrics.groupBy("candidate").pivot("dataset", ["train", "test", "oot"]).agg(
        F.max("auc_raw").alias("auc"), F.max("ks").alias("ks"), F.max("bad_count").alias("bad_count")
    )
    return stage(wide.drop("train_bad_count", "test_bad_count"))


def candidate_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(review.candidate_comparison(candidate_metrics(scored(spark, folder)), "ks", 0.001))


def guardrail_checks(spark: SparkSession, folder: str) -> DataFrame:
    found = review.guardrail_checks(candidate_metrics(scored(spark, folder)), {"max_train_validate_ks_gap": 0.02})
    return rounded(found.select("candidate", "train_validate_gap", "validate_oot_drop", "oot_degradation", "gap_forgiven", "reasons", "passed"))


def target_check(spark: SparkSession, folder: str) -> DataFrame:
    goals = {"validate_ks": 0.15, "validate_auc": 0.60, "oot_ks": 0.15, "oot_auc": 0.60}
    return review.target_check(candidate_metrics(scored(spark, folder)), goals, tolerance=0.05)


def _trials(spark: SparkSession, folder: str) -> DataFrame:
    rows = scored(spark, folder)
    spread = review.score_spread(_candidate_rows(rows).where("dataset = 'test'"), "value", ["candidate"])
    c = F.col
    return candidate_metrics(rows).join(spread, "candidate").select(
        c("candidate").alias("trial"),
        F.when(c("candidate") == "price", "pruned").otherwise("complete").alias("status"),
        "train_ks",
        c("test_ks").alias("validate_ks"),
        "oot_ks",
        c("test_auc").alias("validate_auc"),
        F.lit(0.30).alias("oot_psi"),
        "score_unique_count",
    )


def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    return rounded(
        _trials(spark, folder).select("trial", review.quality_score(c("train_ks"), c("validate_ks"), c("oot_ks"), c("oot_psi")).alias("quality_score"))
    )


def degenerate_trials(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    return _trials(spark, folder).select(
        "trial", "score_unique_count", review.is_degenerate(c("validate_auc"), c("validate_ks"), c("score_unique_count")).alias("degenerate")
    )


def best_trial(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(review.best_trial(_trials(spark, folder)).select("trial", "status", "quality_score", "degenerate", "rejected"))


def _fold_metrics(spark: SparkSession, folder: str) -> DataFrame:
    rows = scored(spark, folder)
    plan = stage(split.rolling_folds(split.month_counts(rows), folds=3, validation_months=6, min_train_months=12))
    long = split.fold_rows(_candidate_rows(rows).where("candidate <> 'flat'"), plan)
    metrics = evaluate.score_auc_ks(long, "value", F.col("bad"), ["candidate", "fold", "role"])
    wide = metrics.groupBy("candidate", "fold").pivot("role", ["train", "validation"]).agg(F.max("auc_raw").alias("auc"), F.max("ks").alias("ks"))
    return stage(wide.withColumnRenamed("candidate", "trial").withColumn("best_iteration", F.col("fold") * 10))


def trial_table(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(review.trial_table(_fold_metrics(spark, folder)))


def bounds_check(spark: SparkSession, folder: str) -> DataFrame:
    """Each order proposes parameters from its own numbers; most are rejected."""
    rows = dated(spark, folder).where("line_cnt is not null")
    c = F.col
    wide = rows.select(
        c("o_orderkey").alias("proposal"),
        c("line_cnt").cast("double").alias("max_depth"),
        c("sum_qty").alias("num_leaves"),
        c("avg_disc").alias("learning_rate"),
        (c("o_totalprice") / 1000).alias("min_data_in_leaf"),
        c("c_nationkey").cast("double").alias("depth_limit"),
    )
    long = wide.unpivot(["proposal"], [n for n in wide.columns if n != "proposal"], "name", "value")
    found = review.bounds_check(long.where("name <> 'depth_limit' or value > 20"))
    return found.groupBy("reasons", "accepted").agg(F.count("*").alias("n"))


def gain_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Shares of the information value, read as gain."""
    overview = discrimination.univariate_overview(dated(spark, folder), FEATURES, bad())
    return rounded(review.gain_shares(overview.select("feature", F.col("iv").alias("gain_importance"))))


def class_weights(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(boost.class_weights(scored(spark, folder).where("dataset = 'train'"), bad()))


def score_spread(spark: SparkSession, folder: str) -> DataFrame:
    return review.score_spread(_candidate_rows(scored(spark, folder)), "value", ["candidate", "dataset"])


def _review_inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = scored(spark, folder)
    metrics = stage(evaluate.metrics_by_split(rows, "score", bad(), IDS))
    lift = stage(evaluate.lift_table(evaluate.rank_scores(rows, "score", bad(), IDS, ["dataset"]), ["dataset"]))
    return metrics, lift, stage(evaluate.monthly_performance(rows, "score", bad(), IDS))


def lift_findings(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(review.lift_findings(_review_inputs(spark, folder)[1]).drop("allowed"))


def monthly_spread(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(review.monthly_spread(_review_inputs(spark, folder)[2]))


def _findings(spark: SparkSession, folder: str) -> DataFrame:
    metrics, lift, monthly = _review_inputs(spark, folder)
    overview = discrimination.univariate_overview(dated(spark, folder), FEATURES, bad())
    gains = overview.select("feature", F.col("iv").alias("gain_importance"))
    return stage(review.model_review(metrics, 8, gains, lift=lift, monthly=monthly))


def model_review(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_findings(spark, folder))


def recommendations(spark: SparkSession, folder: str) -> DataFrame:
    return review.recommendations(_findings(spark, folder)).drop("action", "place")


QUERIES = {
    f.__name__: f
    for f in (
        candidate_comparison, guardrail_checks, target_check, quality_scores, degenerate_trials, best_trial, trial_table,
        bounds_check, gain_shares, class_weights, score_spread, lift_findings, monthly_spread, model_review, recommendations,
    )
}

_LONG = ",\ncl AS (" + " UNION ALL ".join(f"SELECT dataset, event_month, bad, '{n}' AS candidate, CAST({e} AS DOUBLE) AS v FROM scored" for n, e in CANDIDATES.items()) + ")"


def _ranked_sql(name: str, source: str, keys: str) -> str:
    return f""",
{name}_c AS (SELECT {keys}, v, count(*) AS n, sum(bad) AS b FROM {source} GROUP BY ALL),
{name}_r AS (SELECT *, sum(n) OVER w AS cn, sum(b) OVER w AS cb, sum(n) OVER p AS tn, sum(b) OVER p AS tb FROM {name}_c WINDOW w AS (PARTITION BY {keys} ORDER BY v), p AS (PARTITION BY {keys})),
{name} AS (SELECT {keys}, max(tb) AS bad_count, max(abs(cb/tb - (cn-cb)/(tn-tb))) AS ks, (sum(b*(cn-n+(n+1)/2e0)) - max(tb)*(max(tb)+1)/2e0)/(max(tb)*CAST(max(tn)-max(tb) AS DOUBLE)) AS auc FROM {name}_r GROUP BY ALL)"""


_CAND = SAMPLES_SQL + _LONG + _ranked_sql("cm", "cl", "candidate, dataset") + """,
cand AS (
  SELECT candidate, max(auc) FILTER (dataset = 'train') AS train_auc, max(ks) FILTER (dataset = 'train') AS train_ks, max(auc) FILTER (dataset = 'test') AS test_auc, max(ks) FILTER (dataset = 'test') AS test_ks,
    max(auc) FILTER (dataset = 'oot') AS oot_auc, max(ks) FILTER (dataset = 'oot') AS oot_ks, max(bad_count) FILTER (dataset = 'oot') AS oot_bad_count FROM cm GROUP BY 1),
base AS (SELECT train_ks AS btr, test_ks AS bte, oot_ks AS boot FROM cand WHERE candidate = 'baseline'),
spread AS (SELECT candidate, count(DISTINCT round(v, 12)) AS score_unique_count FROM cl WHERE dataset = 'test' GROUP BY 1),
trials AS (SELECT candidate AS trial, CASE WHEN candidate = 'price' THEN 'pruned' ELSE 'complete' END AS status, train_ks, test_ks AS validate_ks, oot_ks, test_auc AS validate_auc, 0.3e0 AS oot_psi, score_unique_count FROM cand JOIN spread USING (candidate)),
quality AS (
  SELECT *, greatest(0, least(1, 0.25e0*train_ks + 0.3e0*validate_ks + 0.45e0*oot_ks - 0.25e0*abs(train_ks-validate_ks) - 0.35e0*abs(validate_ks-oot_ks) - 0.2e0*greatest(0, 0.2e0-oot_ks) - 0.05e0*greatest(0, oot_psi-0.25e0))) AS quality_score,
    score_unique_count <= 1 OR (abs(validate_auc-0.5) < 1e-9 AND validate_ks >= 0.99) AS degenerate, status = 'pruned' AS rejected FROM trials)
"""
_FOLDS = SAMPLES_SQL + _LONG + "," + folds_sql(3, 6, 0, 12) + ",\nfl AS (SELECT c.*, f.fold, f.role FROM cl c JOIN folds f USING (event_month) WHERE candidate <> 'flat')" + _ranked_sql("fm", "fl", "candidate, fold, role") + """,
fw AS (SELECT candidate AS trial, fold, max(auc) FILTER (role = 'train') AS train_auc, max(ks) FILTER (role = 'train') AS train_ks, max(auc) FILTER (role = 'validation') AS validation_auc, max(ks) FILTER (role = 'validation') AS validation_ks, fold*10 AS it FROM fm GROUP BY 1, 2),
ft AS (SELECT trial, count(*) AS folds, avg(train_auc) AS mean_train_auc, avg(train_ks) AS mean_train_ks, avg(validation_auc) AS mean_validation_auc, avg(validation_ks) AS mean_validation_ks, stddev_pop(validation_auc) AS fold_auc_std, stddev_pop(validation_ks) AS fold_ks_std, avg(it) AS mean_best_iteration, min(it) AS min_best_iteration, max(it) AS max_best_iteration FROM fw GROUP BY 1)
"""
_LIFT = BUCKETS_SQL + """,
lstep AS (SELECT dataset, bucket, bad_count/sample_count AS r, lead(bad_count/sample_count) OVER (PARTITION BY dataset ORDER BY bucket) AS nx, (bad_count/sample_count)/(tb/tn) AS lift FROM bk),
lsum AS (SELECT dataset, count(*) AS bucket_count, count(*) FILTER (nx > r) AS violations, arg_min(lift, bucket) AS top_lift FROM lstep GROUP BY 1),
lfind AS (SELECT * FROM lsum WHERE bucket_count >= 5 AND (violations > greatest(1, floor((bucket_count-1)*0.3e0)) OR top_lift < 1))
"""
_SPREAD = """
mu AS (SELECT * FROM keyed WHERE sample_count >= 30 AND bad_count >= 10),
ml AS (SELECT dataset, 0 AS place, 'auc' AS metric, auc AS v, 0.1 AS t FROM mu UNION ALL SELECT dataset, 1, 'ks', ks, 0.1 FROM mu UNION ALL SELECT dataset, 2, 'bad_rate', bad_rate, 0.05 FROM mu),
ms AS (SELECT dataset, place, metric, count(v) AS month_count, min(v) AS min, max(v) AS max, max(v) - min(v) AS spread, max(t) AS t FROM ml GROUP BY 1, 2, 3 HAVING count(v) >= 3),
mfind AS (SELECT * FROM ms WHERE spread >= t QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY place) = 1)
"""
_REVIEW = (
    CELLS_SQL
    + score_psi_sql(QUANTILE_SCORE_EDGES, "0.5e0")[len(SAMPLES_SQL) :]
    + _LIFT[len(SAMPLES_SQL) :]
    + ","
    + keyed_metrics("event_month", "scored")
    + ","
    + _SPREAD
    + """,
wm AS (
  SELECT max(auc) FILTER (dataset = 'train') AS tra, max(auc) FILTER (dataset = 'test') AS tea, max(auc) FILTER (dataset = 'oot') AS ooa,
    max(ks) FILTER (dataset = 'train') AS trk, max(ks) FILTER (dataset = 'test') AS tek, max(ks) FILTER (dataset = 'oot') AS ook, max(bad_count) FILTER (dataset = 'oot') AS oob FROM split_metrics),
findings AS (
  SELECT CASE WHEN tra-tea >= 0.15 THEN 'TRAIN_TEST_AUC_GAP_CRITICAL' ELSE 'TRAIN_TEST_AUC_GAP_HIGH' END AS code, CASE WHEN tra-tea >= 0.15 THEN 'blocker' ELSE 'warning' END AS severity, 'overfit' AS category, NULL AS dataset, tra-tea AS value FROM wm WHERE tra-tea >= 0.08
  UNION ALL SELECT CASE WHEN trk-tek >= 0.15 THEN 'TRAIN_TEST_KS_GAP_CRITICAL' ELSE 'TRAIN_TEST_KS_GAP_HIGH' END, CASE WHEN trk-tek >= 0.15 THEN 'blocker' ELSE 'warning' END, 'overfit', NULL, trk-tek FROM wm WHERE trk-tek >= 0.08
  UNION ALL SELECT CASE WHEN greatest(tra, tea) < 0.55 THEN 'MODEL_UNDERFIT_CRITICAL' ELSE 'MODEL_UNDERFIT_WARNING' END, CASE WHEN greatest(tra, tea) < 0.55 THEN 'blocker' ELSE 'warning' END, 'underfit', NULL, tea FROM wm WHERE greatest(tra, tea) < 0.6 OR greatest(trk, tek) < 0.15
  UNION ALL SELECT 'OOT_AUC_DROP', CASE WHEN tea-ooa >= 0.1 THEN 'blocker' ELSE 'warning' END, 'oot', 'oot', tea-ooa FROM wm WHERE tea-ooa >= 0.05
  UNION ALL SELECT 'OOT_KS_DROP', CASE WHEN tek-ook >= 0.1 THEN 'blocker' ELSE 'warning' END, 'oot', 'oot', tek-ook FROM wm WHERE tek-ook >= 0.05
  UNION ALL SELECT 'OOT_EVALUATION_UNSUPPORTED', 'blocker', 'oot', 'oot', oob FROM wm WHERE oob < 10
  UNION ALL SELECT upper(dataset) || '_SCORE_PSI_HIGH', CASE WHEN score_psi >= 0.25 THEN 'blocker' ELSE 'warning' END, 'drift', dataset, score_psi FROM score_psi WHERE dataset IN ('test', 'oot') AND score_psi >= 0.1
  UNION ALL SELECT 'EARLY_STOP_TOO_EARLY', 'warning', 'overfit', NULL, 8
  UNION ALL SELECT 'FEATURE_IMPORTANCE_CONCENTRATED', 'warning', 'importance', NULL, max(iv)/sum(iv) FROM overview HAVING max(iv)/sum(iv) > 0.5
  UNION ALL SELECT 'LIFT_ORDERING_WEAK', 'warning', 'lift', dataset, violations FROM lfind
  UNION ALL SELECT 'MONTHLY_PERFORMANCE_UNSTABLE', 'warning', 'monthly', dataset, spread FROM mfind)
"""
)
_PROPOSALS = SAMPLES_SQL + """,
pl AS (
  SELECT o_orderkey AS proposal, 'max_depth' AS name, CAST(line_cnt AS DOUBLE) AS v FROM samples WHERE line_cnt IS NOT NULL
  UNION ALL SELECT o_orderkey, 'num_leaves', sum_qty FROM samples WHERE line_cnt IS NOT NULL UNION ALL SELECT o_orderkey, 'learning_rate', avg_disc FROM samples WHERE line_cnt IS NOT NULL
  UNION ALL SELECT o_orderkey, 'min_data_in_leaf', o_totalprice/1000 FROM samples WHERE line_cnt IS NOT NULL UNION ALL SELECT o_orderkey, 'depth_limit', c_nationkey FROM samples WHERE line_cnt IS NOT NULL AND c_nationkey > 20),
pc AS (
  SELECT *, CASE WHEN name = 'depth_limit' THEN 'unknown' WHEN name <> 'learning_rate' AND v <> floor(v) THEN 'not_integer'
    WHEN (name = 'max_depth' AND v NOT BETWEEN 3 AND 8) OR (name = 'num_leaves' AND v NOT BETWEEN 7 AND 63) OR (name = 'learning_rate' AND v NOT BETWEEN 0.01 AND 0.08) OR (name = 'min_data_in_leaf' AND v NOT BETWEEN 30 AND 300) THEN 'out_of_bounds' END AS problem FROM pl),
pr AS (
  SELECT proposal, concat_ws(',', string_agg(name || ':' || problem, ',' ORDER BY name || ':' || problem) FILTER (problem IS NOT NULL),
    CASE WHEN max(v) FILTER (name = 'max_depth') > 0 AND max(v) FILTER (name = 'num_leaves') > pow(2e0, max(v) FILTER (name = 'max_depth')) THEN 'num_leaves:above_depth' END) AS reasons FROM pc GROUP BY 1)
"""
_COMPARED = """
cmp AS (
  SELECT c.*, train_auc - test_auc AS auc_gap, CASE WHEN candidate = 'baseline' THEN 0 ELSE test_ks - bte END AS improvement_vs_baseline, CASE WHEN candidate = 'baseline' THEN 0 ELSE oot_ks - boot END AS oot_improvement_vs_baseline,
    candidate <> 'baseline' AND test_ks - bte >= 0.001 AS accepted FROM cand c, base)
"""

CHECKS = {
    "candidate_comparison": check(
        _CAND + "," + _COMPARED,
        "SELECT *, CASE WHEN (SELECT bool_or(accepted) FROM cmp) THEN candidate = (SELECT candidate FROM cmp WHERE accepted ORDER BY test_ks DESC, candidate LIMIT 1) ELSE candidate = 'baseline' END AS selected_candidate FROM cmp",
        ["train_auc", "train_ks", "test_auc", "test_ks", "oot_auc", "oot_ks", "auc_gap", "improvement_vs_baseline", "oot_improvement_vs_baseline"], ["oot_bad_count"],
    ),
    "guardrail_checks": check(
        _CAND + """,
        gr AS (SELECT candidate, oot_bad_count, train_ks - test_ks AS train_validate_gap, test_ks - oot_ks AS validate_oot_drop, CASE WHEN candidate <> 'baseline' THEN boot - oot_ks END AS oot_degradation,
          candidate <> 'baseline' AND (btr - bte) - (train_ks - test_ks) >= 0.02 AND test_ks - bte >= -0.005 AND oot_ks - boot >= -0.01 AS gap_forgiven FROM cand, base),
        gx AS (SELECT *, concat_ws(',', CASE WHEN train_validate_gap > 0.02 AND NOT gap_forgiven THEN 'train_validate_gap' END, CASE WHEN oot_bad_count >= 30 AND validate_oot_drop > 0.08 THEN 'validate_oot_drop' END, CASE WHEN oot_bad_count >= 30 AND oot_degradation > 0.03 THEN 'oot_degradation' END) AS reasons FROM gr)""",
        "SELECT candidate, train_validate_gap, validate_oot_drop, oot_degradation, gap_forgiven, reasons, reasons = '' AS passed FROM gx",
        ["train_validate_gap", "validate_oot_drop", "oot_degradation"],
    ),
    "target_check": check(
        _CAND,
        """SELECT candidate, test_ks >= 0.15 AND test_auc >= 0.6 AND (oot_bad_count < 30 OR (oot_ks >= 0.15 AND oot_auc >= 0.6)) AS target_met,
          test_ks >= 0.15-0.05 AND test_auc >= 0.6-0.05 AND (oot_bad_count < 30 OR (oot_ks >= 0.15-0.05 AND oot_auc >= 0.6-0.05)) AS target_close, oot_bad_count >= 30 AS oot_counted,
          concat_ws(',', CASE WHEN test_ks < 0.15 THEN 'validate_ks' END, CASE WHEN test_auc < 0.6 THEN 'validate_auc' END, CASE WHEN oot_bad_count >= 30 AND oot_ks < 0.15 THEN 'oot_ks' END, CASE WHEN oot_bad_count >= 30 AND oot_auc < 0.6 THEN 'oot_auc' END) AS missed FROM cand""",
    ),
    "quality_scores": check(_CAND, "SELECT trial, quality_score FROM quality", ["quality_score"]),
    "degenerate_trials": check(_CAND, "SELECT trial, score_unique_count, degenerate FROM quality"),
    "best_trial": check(
        _CAND,
        "SELECT trial, status, quality_score, degenerate, rejected FROM quality ORDER BY CASE WHEN NOT degenerate AND NOT rejected THEN 0 WHEN NOT degenerate THEN 1 ELSE 2 END, quality_score DESC NULLS LAST, validate_ks DESC, trial LIMIT 1",
        ["quality_score"],
    ),
    "trial_table": check(
        _FOLDS,
        "SELECT *, mean_train_auc - mean_validation_auc AS auc_gap, mean_train_ks - mean_validation_ks AS ks_gap, mean_validation_ks - 0.5e0*greatest(0, mean_train_ks - mean_validation_ks) - 0.25e0*fold_ks_std AS score FROM ft",
        ["mean_train_auc", "mean_train_ks", "mean_validation_auc", "mean_validation_ks", "fold_auc_std", "fold_ks_std", "mean_best_iteration", "auc_gap", "ks_gap", "score"],
    ),
    "bounds_check": check(_PROPOSALS, "SELECT reasons, reasons = '' AS accepted, count(*) AS n FROM pr GROUP BY 1, 2"),
    "gain_shares": check(CELLS_SQL, "SELECT feature, iv AS gain_importance, iv/sum(iv) OVER () AS gain_share, sum(iv) OVER (ORDER BY iv DESC, feature)/sum(iv) OVER () AS cumulative_gain_share FROM overview", ["gain_importance", "gain_share", "cumulative_gain_share"]),
    "class_weights": check(SAMPLES_SQL, "SELECT count(*) FILTER (bad = 0) AS good_count, count(*) FILTER (bad = 1) AS bad_count, count(*) FILTER (bad = 0)/count(*) FILTER (bad = 1) AS bad_weight FROM scored WHERE dataset = 'train'", ["bad_weight"]),
    "score_spread": check(SAMPLES_SQL + _LONG, "SELECT candidate, dataset, count(DISTINCT round(v, 12)) AS score_unique_count, count(DISTINCT round(v, 12)) <= 1 AS is_degenerate FROM cl GROUP BY 1, 2"),
    "lift_findings": check(_LIFT, "SELECT * FROM lfind", ["top_lift"]),
    "monthly_spread": check(SAMPLES_SQL + "," + keyed_metrics("event_month", "scored") + "," + _SPREAD, "SELECT dataset, metric, month_count, min, max, spread FROM mfind", ["min", "max", "spread"]),
    "model_review": check(_REVIEW, "SELECT *, CASE WHEN (SELECT bool_or(severity = 'blocker') FROM findings) THEN 'blocked' ELSE 'needs_review' END AS status FROM findings", ["value"]),
    "recommendations": check(
        _REVIEW,
        "SELECT CASE WHEN category IN ('overfit', 'underfit', 'oot', 'drift') THEN 'first' ELSE 'then' END AS priority, category, string_agg(DISTINCT code, ',' ORDER BY code) AS source_codes FROM findings GROUP BY 1, 2",
    ),
}
