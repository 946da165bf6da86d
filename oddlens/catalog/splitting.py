"""Splits, folds and feature selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oddlens.catalog.base import FEATURES, IDS, NUMERIC, SAMPLES_SQL, bad, check, dated, rounded, split_samples
from oddlens.catalog.reading import RATIO_MANIFEST
from oddlens.catalog.separating import SPLIT_CELLS
from oddlens.operators import select, split
from oddlens.sources.stages import stage


def time_split(spark: SparkSession, folder: str) -> DataFrame:
    rows = split.time_split(dated(spark, folder), oot_months=6, test_months=6)
    return rows.groupBy("dataset", "event_month").agg(F.count("*").alias("n"))


def stratified_test(spark: SparkSession, folder: str) -> DataFrame:
    rows = split.stratified_test(dated(spark, folder), "bad", IDS, test_ratio=0.2)
    return rows.groupBy("bad", "dataset").agg(F.count("*").alias("n"), F.countDistinct("o_orderkey").alias("ids"))


def ratio_split(spark: SparkSession, folder: str) -> DataFrame:
    return split.ratio_split_months(split.month_counts(dated(spark, folder)))


def split_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(split.split_summary(split_samples(spark, folder), bad()))


def rolling_folds(spark: SparkSession, folder: str) -> DataFrame:
    return split.rolling_folds(split.month_counts(dated(spark, folder)), folds=4, validation_months=3, gap_months=1, min_train_months=12)


def rolling_fold_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per fold and role after the month plan is joined back to the table."""
    rows = dated(spark, folder)
    plan = stage(split.rolling_folds(split.month_counts(rows), folds=3))
    return split.fold_rows(rows, plan).groupBy("fold", "role").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))


def stratified_folds(spark: SparkSession, folder: str) -> DataFrame:
    rows = split.stratified_folds(dated(spark, folder), "bad", IDS, folds=3)
    return rows.groupBy("fold", "bad").agg(F.count("*").alias("n"))


def fold_guard(spark: SparkSession, folder: str) -> DataFrame:
    rows = dated(spark, folder)
    plan = stage(split.rolling_folds(split.month_counts(rows), folds=5))
    return split.fold_guard(rows, plan, bad(), minimum=25)


_RULES = select.SelectionRules(min_iv=0.004, max_correlation=0.60, correlation_method="pearson", max_psi=0.10)


def selected_features(spark: SparkSession, folder: str) -> DataFrame:
    train = stage(split_samples(spark, folder).where("dataset = 'train'"))
    return rounded(select.select_features(train, FEATURES, bad(), _RULES))


def selection_metrics(spark: SparkSession, folder: str) -> DataFrame:
    train = stage(split_samples(spark, folder).where("dataset = 'train'"))
    return rounded(select.selection_metrics(train, FEATURES, bad(), _RULES).select("feature", "iv", "missing_rate", "unique_count", "dominant_rate"))


def screened_features(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(select.screen_features(split_samples(spark, folder), FEATURES, bad()).drop("validate_psi"))


def screening_action_counts(spark: SparkSession, folder: str) -> DataFrame:
    return select.action_counts(select.screen_features(split_samples(spark, folder), FEATURES, bad()))


QUERIES = {
    f.__name__: f
    for f in (
        time_split, stratified_test, ratio_split, split_summary, rolling_folds, rolling_fold_rows, stratified_folds,
        fold_guard, selected_features, selection_metrics, screened_features, screening_action_counts,
    )
}


def folds_sql(folds: int, validation: int, gap: int, least: int) -> str:
    return f"""
pm AS (SELECT event_month, row_number() OVER (ORDER BY event_month) - 1 AS p, count(*) OVER () AS t FROM months),
st AS (SELECT unnest(generate_series(greatest({least + gap}, max(t) - {validation} - {folds} + 1), max(t) - {validation})) AS s FROM pm),
fp AS (
  SELECT CAST(dense_rank() OVER (ORDER BY s) AS INTEGER) AS fold, event_month,
    CASE WHEN p < s - {gap} THEN 'train' WHEN p BETWEEN s AND s + {validation} - 1 THEN 'validation' END AS role FROM pm, st),
folds AS (SELECT * FROM fp WHERE role IS NOT NULL)
"""


_VALUES = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS unique_count, count(*) - count({c}) AS missing, (SELECT count(*) FROM scored WHERE dataset = 'train' AND {c} IS NOT NULL GROUP BY {c} ORDER BY 1 DESC LIMIT 1)/count({c}) AS dominant_rate FROM scored WHERE dataset = 'train'"
    for c in FEATURES
)
_TRAIN_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, abs(corr({a}, {b})) AS r FROM scored WHERE dataset = 'train'"
    for i, a in enumerate(NUMERIC)
    for b in NUMERIC[i + 1 :]
)
# Everything of the train split: bins, monthly PSI, stability and greedy pruning.
_SELECTION = SPLIT_CELLS + f""",
vals AS ({_VALUES}),
tm AS (SELECT event_month, count(*) AS n FROM scored WHERE dataset = 'train' GROUP BY 1),
tcell AS (SELECT c.*, s.event_month FROM scells c JOIN scored s USING (dataset, o_orderkey) WHERE c.dataset = 'train'),
tbin AS (
  SELECT t.event_month, t.feature, CASE WHEN t.num IS NOT NULL THEN len(list_filter(e.es, lambda x: x <= t.num)) WHEN t.txt IS NOT NULL THEN least(c.p - 1, 19) ELSE -1 END AS bin, count(*) AS n
  FROM tcell t LEFT JOIN sedge e ON e.dataset = 'train' AND t.feature = e.feature LEFT JOIN scat c ON c.dataset = 'train' AND t.feature = c.feature AND t.txt = c.txt GROUP BY 1, 2, 3),
tt AS (SELECT feature, event_month, sum(n) AS t FROM tbin GROUP BY 1, 2),
tg AS (SELECT tt.feature, tt.event_month, b.bin, coalesce(x.n, 0) AS n, tt.t, count(*) OVER (PARTITION BY tt.feature, tt.event_month) AS k
  FROM tt JOIN (SELECT DISTINCT feature, bin FROM tbin) b USING (feature) LEFT JOIN tbin x ON x.feature = tt.feature AND x.event_month = tt.event_month AND x.bin = b.bin),
tp AS (
  SELECT g.feature, g.event_month, sum(((g.n+0.5e0)/(g.t+0.5e0*g.k) - (h.n+0.5e0)/(h.t+0.5e0*h.k)) * ln(((g.n+0.5e0)/(g.t+0.5e0*g.k)) / ((h.n+0.5e0)/(h.t+0.5e0*h.k)))) AS psi
  FROM tg g JOIN tg h ON g.feature = h.feature AND g.bin = h.bin AND h.event_month = (SELECT min(event_month) FROM tm) GROUP BY 1, 2),
stab AS (
  SELECT feature, max(psi) AS max_monthly_psi, avg(CAST(psi > 0.1 AS DOUBLE)) AS unstable_month_ratio, count(*) AS eligible_month_count
  FROM tp JOIN tm USING (event_month) WHERE n >= 100 AND event_month <> (SELECT min(event_month) FROM tm) GROUP BY 1),
met AS (
  SELECT v.feature, i.iv, i.missing_rate, v.unique_count, v.dominant_rate, coalesce(max_monthly_psi, 0) AS max_monthly_psi, coalesce(unstable_month_ratio, 0) AS unstable_month_ratio,
    coalesce(eligible_month_count, 0) AS eligible_month_count, coalesce(max_monthly_psi > 0.1 AND unstable_month_ratio > 0.3, false) AS unstable
  FROM vals v JOIN siv i ON i.dataset = 'train' AND i.feature = v.feature LEFT JOIN stab s ON s.feature = v.feature),
based AS (SELECT *, CASE WHEN unique_count <= 1 THEN 'excluded_constant' WHEN missing_rate > 0.8 THEN 'excluded_missing' WHEN iv < 0.004 THEN 'excluded_low_iv' ELSE 'candidate' END AS base FROM met),
walk0 AS (SELECT feature, row_number() OVER (ORDER BY unstable, iv DESC, missing_rate, feature) AS p FROM based WHERE base = 'candidate'),
pairs AS (SELECT a, b FROM ({_TRAIN_PAIRS}) WHERE r > 0.6),
rival AS (SELECT a AS feature, list(b) AS rs FROM (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs) GROUP BY 1),
rivals AS (SELECT w.feature, w.p, coalesce(r.rs, []) AS rs FROM walk0 w LEFT JOIN rival r USING (feature)),
walk AS (
  SELECT 0 AS p, CAST([] AS VARCHAR[]) AS kept, CAST(NULL AS VARCHAR) AS feature, CAST(NULL AS VARCHAR) AS clash
  UNION ALL
  SELECT r.p, CASE WHEN len(list_filter(w.kept, lambda x: list_contains(r.rs, x))) = 0 THEN list_append(w.kept, r.feature) ELSE w.kept END, r.feature, list_filter(w.kept, lambda x: list_contains(r.rs, x))[1]
  FROM walk w JOIN rivals r ON r.p = w.p + 1),
decided AS (
  SELECT b.*, w.clash, concat_ws(', ', CASE WHEN unstable THEN 'stability' END, CASE WHEN dominant_rate > 0.95 THEN 'dominant value' END) AS review FROM based b LEFT JOIN walk w ON b.feature = w.feature),
fin AS (SELECT *, CASE WHEN base <> 'candidate' THEN base WHEN clash IS NOT NULL THEN 'excluded_correlation' WHEN review <> '' THEN 'retained_review' ELSE 'retained' END AS decision FROM decided)
"""
_SELECTION = _SELECTION.replace(SAMPLES_SQL.strip()[:3], "RECURSIVE " + SAMPLES_SQL.strip()[:3], 1)

_SHIFT = """
tcut AS (SELECT feature, quantile_cont(num, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS es FROM scells WHERE dataset = 'train' AND num IS NOT NULL GROUP BY 1),
talpha AS (SELECT feature, txt, row_number() OVER (PARTITION BY feature ORDER BY txt) AS p FROM (SELECT DISTINCT feature, txt FROM scells WHERE dataset = 'train' AND txt IS NOT NULL)),
pb AS (
  SELECT s.dataset, s.feature, CASE WHEN s.num IS NOT NULL THEN len(list_filter(list_distinct(c.es), lambda x: x < s.num)) WHEN a.p <= 9 THEN a.p - 1 ELSE 9 END AS bin, count(*) AS n
  FROM scells s LEFT JOIN tcut c ON s.feature = c.feature LEFT JOIN talpha a ON s.feature = a.feature AND s.txt = a.txt WHERE s.num IS NOT NULL OR s.txt IS NOT NULL GROUP BY 1, 2, 3),
pt AS (SELECT dataset, feature, sum(n) AS t FROM pb GROUP BY 1, 2),
pg AS (SELECT pt.dataset, pt.feature, b.bin, coalesce(pb.n, 0) AS n, pt.t, count(*) OVER (PARTITION BY pt.dataset, pt.feature) AS k
  FROM pt JOIN (SELECT DISTINCT feature, bin FROM pb) b ON pt.feature = b.feature LEFT JOIN pb ON pb.dataset = pt.dataset AND pb.feature = pt.feature AND pb.bin = b.bin),
pp AS (
  SELECT g.feature, g.dataset, sum(((g.n+0.5e0)/(g.t+0.5e0*g.k) - (h.n+0.5e0)/(h.t+0.5e0*h.k)) * ln(((g.n+0.5e0)/(g.t+0.5e0*g.k)) / ((h.n+0.5e0)/(h.t+0.5e0*h.k)))) AS psi
  FROM pg g JOIN pg h ON g.feature = h.feature AND g.bin = h.bin AND h.dataset = 'train' GROUP BY 1, 2)
"""
_FILLED = ", ".join(f"coalesce({c}, (SELECT median({c}) FROM scored WHERE dataset = 'train')) AS {c}" for c in NUMERIC)
_FILLED_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, abs(corr({a}, {b})) AS r FROM filled" for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1 :]
)
# Screening fits its train bins on distinct values.
_SCREEN = (
    SPLIT_CELLS.replace("sedge AS (", "sdr AS (SELECT *, row_number() OVER (PARTITION BY dataset, feature ORDER BY num) AS d, count(*) OVER (PARTITION BY dataset, feature) AS td FROM srk),\nsedge AS (")
    .replace("FROM srk, generate_series", "FROM sdr, generate_series")
    .replace("WHERE round_even(CAST(i*(tn-1) AS DOUBLE)/10, 0) >= cn - n AND round_even(CAST(i*(tn-1) AS DOUBLE)/10, 0) < cn", "WHERE td > 1 AND round_even(CAST(i*(td-1) AS DOUBLE)/10, 0) = d - 1")
    + f""",{_SHIFT},
filled AS (SELECT {_FILLED} FROM scored WHERE dataset = 'train'),
fpr AS ({_FILLED_PAIRS}),
mc AS (SELECT a AS feature, coalesce(max(r) FILTER (r < 0.999999), 0) AS max_correlation FROM (SELECT a, r FROM fpr UNION ALL SELECT b, r FROM fpr) GROUP BY 1),
sent2 AS (SELECT feature, -sum(n/t*log2(n/t)) AS e FROM (SELECT feature, bin, n, sum(n) OVER (PARTITION BY feature) AS t FROM sbin WHERE dataset = 'train') GROUP BY 1),
rk AS (SELECT feature, num, n, bad AS b, sum(n) OVER w AS cn, sum(bad) OVER w AS cb, sum(n) OVER p AS tn, sum(bad) OVER p AS tb FROM svc WHERE dataset = 'train' AND num IS NOT NULL
  WINDOW w AS (PARTITION BY feature ORDER BY num), p AS (PARTITION BY feature)),
rm AS (SELECT feature, max(abs(cb/tb - (cn-cb)/(tn-tb))) AS ks, (sum(b*(cn-n+(n+1)/2e0)) - max(tb)*(max(tb)+1)/2e0)/(max(tb)*CAST(max(tn)-max(tb) AS DOUBLE)) AS a FROM rk GROUP BY 1),
vals AS ({_VALUES}),
scr AS (
  SELECT i.feature, i.missing_rate, i.iv, rm.ks, greatest(rm.a, 1-rm.a) AS auc, 2*greatest(rm.a, 1-rm.a)-1 AS gini, e.e AS information_entropy,
    (SELECT psi FROM pp WHERE pp.feature = i.feature AND pp.dataset = 'test') AS test_psi, (SELECT psi FROM pp WHERE pp.feature = i.feature AND pp.dataset = 'oot') AS oot_psi,
    coalesce(mc.max_correlation, 0) AS max_correlation, v.unique_count + CAST(v.missing > 0 AS INTEGER) AS dc
  FROM siv i LEFT JOIN rm ON rm.feature = i.feature LEFT JOIN sent2 e ON e.feature = i.feature LEFT JOIN mc ON mc.feature = i.feature JOIN vals v ON v.feature = i.feature WHERE i.dataset = 'train'),
scr2 AS (SELECT *, greatest(test_psi, oot_psi) AS max_psi,
  CASE WHEN dc <= 1 THEN 'constant' WHEN missing_rate >= 0.8 THEN 'missing' WHEN iv < 0.02 THEN 'low_iv' END AS del,
  CASE WHEN greatest(test_psi, oot_psi) >= 0.25 THEN 'psi_high' WHEN greatest(test_psi, oot_psi) >= 0.1 THEN 'psi_watch' END AS dr, CASE WHEN max_correlation >= 0.7 THEN 'correlated' END AS tw FROM scr),
screened AS (SELECT feature, missing_rate, iv, ks, auc, gini, information_entropy, test_psi, oot_psi, max_psi, max_correlation,
  CASE WHEN del IS NOT NULL THEN 'delete' WHEN dr IS NOT NULL OR tw IS NOT NULL THEN 'review' ELSE 'keep' END AS action, coalesce(nullif(concat_ws(',', del, dr, tw), ''), 'passed') AS reason FROM scr2)
"""
)

CHECKS = {
    "time_split": check(SAMPLES_SQL, "SELECT dataset, event_month, count(*) AS n FROM scored GROUP BY 1, 2"),
    "stratified_test": check(
        SAMPLES_SQL + ", c AS (SELECT bad, count(*) AS n, greatest(1, least(round_even(count(*)*0.2e0, 0), count(*)-1)) AS t FROM samples GROUP BY 1)",
        "SELECT bad, 'test' AS dataset, t AS n, t AS ids FROM c UNION ALL SELECT bad, 'train', n - t, n - t FROM c", longs=["n", "ids"],
    ),
    "ratio_split": check(SAMPLES_SQL + "," + RATIO_MANIFEST, "SELECT * FROM ratio_manifest"),
    "split_summary": check(
        SAMPLES_SQL,
        "SELECT dataset, count(*) AS sample_count, sum(bad) AS bad_count, min(event_month) AS month_start, max(event_month) AS month_end, string_agg(DISTINCT event_month, ',' ORDER BY event_month) AS months, count(*) - sum(bad) AS good_count, sum(bad)/count(*) AS bad_rate FROM scored GROUP BY 1",
        ["bad_rate"], ["bad_count", "good_count"],
    ),
    "rolling_folds": check(SAMPLES_SQL + "," + folds_sql(4, 3, 1, 12), "SELECT fold, event_month, role FROM folds"),
    "rolling_fold_rows": check(SAMPLES_SQL + "," + folds_sql(3, 1, 0, 3), "SELECT fold, role, count(*) AS n, sum(bad) AS bad FROM folds JOIN samples USING (event_month) GROUP BY 1, 2", longs=["bad"]),
    "stratified_folds": check(
        SAMPLES_SQL + ", c AS (SELECT bad, count(*) AS n FROM samples GROUP BY 1)",
        "SELECT CAST(f AS INTEGER) AS fold, bad, n // 3 + CAST(n % 3 >= f AS INTEGER) AS n FROM c, generate_series(1, 3) AS g(f)", longs=["n"],
    ),
    "fold_guard": check(SAMPLES_SQL + "," + folds_sql(5, 1, 0, 3), "SELECT fold, sum(bad_count) AS bad_count, sum(bad_count) >= 25 AS enough FROM folds JOIN months USING (event_month) WHERE role = 'validation' GROUP BY 1", longs=["bad_count"]),
    "selected_features": check(
        _SELECTION,
        "SELECT feature, decision, CASE WHEN decision = 'retained_review' THEN review END AS review_reason, iv, missing_rate, dominant_rate, max_monthly_psi, unstable_month_ratio, eligible_month_count, CASE WHEN base = 'candidate' THEN clash END AS correlated_with, 'pearson' AS correlation_method FROM fin",
        ["iv", "missing_rate", "dominant_rate", "max_monthly_psi", "unstable_month_ratio"],
    ),
    "selection_metrics": check(_SELECTION, "SELECT feature, iv, missing_rate, unique_count, dominant_rate FROM met", ["iv", "missing_rate", "dominant_rate"]),
    "screened_features": check(
        _SCREEN, "SELECT * FROM screened",
        ["missing_rate", "iv", "ks", "auc", "gini", "information_entropy", "test_psi", "oot_psi", "max_psi", "max_correlation"],
    ),
    "screening_action_counts": check(_SCREEN, "SELECT action, count(*) AS feature_count FROM screened GROUP BY 1"),
}
