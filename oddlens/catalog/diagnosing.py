"""Sample diagnostics over the order samples and the untidy line table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oddlens.catalog.base import (
    CELLS_SQL,
    CONTRACT,
    FEATURES,
    IDS,
    LINE_CONTRACT,
    LINE_FEATURES,
    LINE_IDS,
    LINE_ORDER,
    NUMERIC,
    PAIRS_SQL,
    SAMPLES_SQL,
    bad,
    check,
    dated,
    lines,
    rounded,
    samples,
)
from oddlens.operators import binning, correlation, diagnose, discrimination, profile, stability
from oddlens.sources.stages import stage

LOW_FILL = diagnose.DiagnosticLimits(high_missing_row_rate=0.40)


def monthly_target_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(diagnose.monthly_target_summary(samples(spark, folder), CONTRACT))


def monthly_target_summary_of_lines(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(diagnose.monthly_target_summary(lines(spark, folder), LINE_CONTRACT))


def duplicate_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return diagnose.duplicate_metrics(lines(spark, folder), LINE_IDS)


def label_validity(spark: SparkSession, folder: str) -> DataFrame:
    return diagnose.label_validity(lines(spark, folder), LINE_CONTRACT)


def class_balance(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(diagnose.class_balance(lines(spark, folder), LINE_CONTRACT))


def all_null_features(spark: SparkSession, folder: str) -> DataFrame:
    return diagnose.all_null_features(lines(spark, folder), LINE_FEATURES)


def high_missing_rows(spark: SparkSession, folder: str) -> DataFrame:
    found = diagnose.high_missing_rows(lines(spark, folder), LINE_FEATURES, 0.40)
    return found.groupBy("l_returnflag").agg(F.count("*").alias("n"))


def _segment_months(spark: SparkSession, folder: str) -> DataFrame:
    """Urgent orders of one nation: a segment thin enough to skip months."""
    urgent = samples(spark, folder).where("o_orderpriority = '1-URGENT' and c_nationkey = 7")
    return stage(diagnose.monthly_target_summary(urgent, CONTRACT))


def missing_months(spark: SparkSession, folder: str) -> DataFrame:
    return diagnose.missing_months(_segment_months(spark, folder))


def bad_rate_changes(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(diagnose.bad_rate_changes(diagnose.monthly_target_summary(samples(spark, folder), CONTRACT)))


def latest_month_check(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(diagnose.latest_month_check(diagnose.monthly_target_summary(lines(spark, folder), LINE_CONTRACT)))


def sample_findings(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(diagnose.sample_findings(lines(spark, folder), LINE_CONTRACT, LOW_FILL))


def sample_treatment(spark: SparkSession, folder: str) -> DataFrame:
    """What is left after all treatment steps, by month."""
    done = diagnose.apply_treatment(
        lines(spark, folder), LINE_CONTRACT, LINE_ORDER, diagnose.Treatment(high_missing_rows="drop"), LOW_FILL
    )
    return rounded(
        done.data.groupBy(F.date_format(F.to_date("ship_date"), "yyyyMM").alias("event_month")).agg(
            F.count("*").alias("n"),
            F.sum("label").alias("label_sum"),
            F.sum("l_extendedprice").alias("price"),
            F.max(F.lit(done.removed_missing_target)).cast("long").alias("removed_missing_target"),
            F.max(F.lit(done.removed_duplicates)).cast("long").alias("removed_duplicates"),
            F.max(F.lit(done.removed_high_missing_rows)).cast("long").alias("removed_sparse"),
            F.max(F.lit(done.removed_incomplete_month)).cast("long").alias("removed_month"),
            F.max(F.lit(",".join(done.removed_features))).alias("removed_features"),
        ),
        4,
    )


def _metric_frames(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame, dict]:
    rows = dated(spark, folder)
    fitted = binning.fit_bins(rows, FEATURES)
    overview = stage(discrimination.univariate_overview(rows, FEATURES, bad(), fitted=fitted))
    return rows, overview, stage(stability.psi_summary(stability.monthly_psi(rows, fitted))), fitted


def modelling_risk_table(spark: SparkSession, folder: str) -> DataFrame:
    rows, overview, psi, _ = _metric_frames(spark, folder)
    return rounded(
        diagnose.risk_table(overview, psi, stage(diagnose.sample_findings(rows.drop("event_month"), CONTRACT)), diagnose.class_balance(rows, CONTRACT))
    )


def evidence_findings(spark: SparkSession, folder: str) -> DataFrame:
    rows, overview, psi, fitted = _metric_frames(spark, folder)
    monthly = stage(discrimination.monthly_discrimination(rows, fitted, bad(), IDS))
    found = diagnose.evidence_findings(
        overview, stability.monthly_sample(rows, bad()), psi, correlation.pearson_pairs(rows, NUMERIC), monthly
    )
    return rounded(found.drop("subject"))


def small_months(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(diagnose.small_months(stability.monthly_sample(dated(spark, folder), bad())))


def ks_volatility(spark: SparkSession, folder: str) -> DataFrame:
    rows = dated(spark, folder)
    fitted = binning.fit_bins(rows, FEATURES)
    return rounded(diagnose.ks_volatility(discrimination.monthly_discrimination(rows, fitted, bad(), IDS)))


def preflight_findings(spark: SparkSession, folder: str) -> DataFrame:
    rows = lines(spark, folder)
    return rounded(diagnose.preflight_findings(rows, LINE_CONTRACT, profile.profile_columns(rows, LINE_FEATURES)))


def month_reliability(spark: SparkSession, folder: str) -> DataFrame:
    monthly = diagnose.monthly_target_summary(samples(spark, folder), CONTRACT)
    return monthly.select(
        "event_month", diagnose.reliability(F.col("bad_count"), F.col("sample_count")).alias("reliability")
    )


QUERIES = {
    f.__name__: f
    for f in (
        monthly_target_summary, monthly_target_summary_of_lines, duplicate_metrics, label_validity, class_balance,
        all_null_features, high_missing_rows, missing_months, bad_rate_changes, latest_month_check, sample_findings,
        sample_treatment, modelling_risk_table, evidence_findings, small_months, ks_volatility, preflight_findings,
        month_reliability,
    )
}

_MONTHLY = """
SELECT event_month, count(*) AS sample_count, count(*) FILTER ({y} = 0) AS good_count, count(*) FILTER ({y} = 1) AS bad_count,
  count(*) FILTER ({y} IS NULL) AS missing_target_count, count(*) FILTER ({y} NOT IN (0, 1)) AS invalid_target_count,
  count(*) FILTER ({y} IN (0, 1)) AS labeled_sample_count, count(*) FILTER ({y} = 1)/nullif(count(*) FILTER ({y} IN (0, 1)), 0) AS bad_rate
FROM {t} GROUP BY 1"""
_NULLS = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in LINE_FEATURES)
_LINE_SQL = SAMPLES_SQL + f""",
monthly AS ({_MONTHLY.format(y='label', t='lines')}),
dup AS (SELECT count(*) FILTER (n > 1) AS k, sum(n) FILTER (n > 1) AS r FROM (SELECT count(*) AS n FROM lines GROUP BY l_orderkey, l_linenumber)),
recent AS (SELECT event_month, sample_count, bad_count, row_number() OVER (ORDER BY event_month DESC) AS p FROM monthly),
latest AS (
  SELECT max(event_month) FILTER (p = 1) AS latest_month, max(sample_count) FILTER (p = 1) AS latest_sample_count,
    median(sample_count) FILTER (p BETWEEN 2 AND 4) AS recent_median FROM recent),
change AS (
  SELECT event_month AS current_month, abs(bad_rate - lag(bad_rate) OVER (ORDER BY event_month)) AS c FROM monthly),
facts AS (
  SELECT count(*) FILTER (label IS NULL) AS m, count(*) FILTER (label NOT IN (0, 1)) AS i, count(*) FILTER (label = 0) AS g,
    count(*) FILTER (label = 1) AS b, count(*) FILTER (({_NULLS})/7.0 >= 0.4) AS sparse FROM lines)
"""
_FIRST = """
labelled AS (SELECT * FROM lines WHERE label IS NOT NULL),
firsts AS (SELECT * FROM labelled QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY ship_date, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount NULLS FIRST) = 1),
dense AS (SELECT * FROM firsts WHERE (CAST(l_quantity IS NULL AS INTEGER) + CAST(l_extendedprice IS NULL AS INTEGER) + CAST(l_discount IS NULL AS INTEGER)
  + CAST(l_tax IS NULL AS INTEGER) + CAST(l_returnflag IS NULL AS INTEGER) + CAST(l_linestatus IS NULL AS INTEGER))/6.0 < 0.4),
dm AS (SELECT event_month, count(*) AS n, row_number() OVER (ORDER BY event_month DESC) AS p FROM dense GROUP BY 1),
cutm AS (SELECT max(event_month) FILTER (p = 1) AS m, max(n) FILTER (p = 1) AS n FROM dm
  HAVING max(n) FILTER (p = 1) < 0.5*median(n) FILTER (p BETWEEN 2 AND 4)),
final AS (SELECT * FROM dense WHERE event_month NOT IN (SELECT m FROM cutm))
"""
_MONTH_KS = CELLS_SQL + """,
mscore AS (
  SELECT c.event_month, c.feature, c.o_orderkey, c.bad, coalesce(c.num, CAST(v.bin AS DOUBLE)) AS score
  FROM cells c LEFT JOIN value_bin v ON c.feature = v.feature AND c.txt = v.txt AND v.num IS NULL
  WHERE c.num IS NOT NULL OR c.txt IS NOT NULL),
mvc AS (SELECT event_month, feature, score, count(*) AS n, sum(bad) AS b FROM mscore GROUP BY 1, 2, 3),
mrank AS (
  SELECT *, sum(n) OVER w AS cn, sum(b) OVER w AS cb, sum(n) OVER p AS tn, sum(b) OVER p AS tb FROM mvc
  WINDOW w AS (PARTITION BY event_month, feature ORDER BY score), p AS (PARTITION BY event_month, feature)),
mks AS (
  SELECT event_month, feature, max(tn) AS sample_count, max(tb) AS bad_count,
    max(abs(cb/nullif(tb, 0) - (cn-cb)/nullif(tn-tb, 0))) AS ks,
    (sum(b*(cn - n + (n+1)/2e0)) - max(tb)*(max(tb)+1)/2e0) / nullif(max(tb)*CAST(max(tn)-max(tb) AS DOUBLE), 0) AS auc_raw
  FROM mrank GROUP BY 1, 2),
volatility AS (
  SELECT feature, count(*) AS month_count, avg(ks) AS monthly_ks_mean, stddev_pop(ks) AS monthly_ks_std FROM mks
  WHERE ks IS NOT NULL GROUP BY 1 HAVING count(*) >= 2),
small AS (
  SELECT event_month, sample_count, bad_count, median AS median_sample_count, sample_count < 0.3*median AS is_small, bad_count = 0 AS has_no_bad
  FROM months, (SELECT median(sample_count) AS median FROM months))
"""
_PEARSON = PAIRS_SQL[len(CELLS_SQL) :]

CHECKS = {
    "monthly_target_summary": check(SAMPLES_SQL, _MONTHLY.format(y="bad", t="samples"), ["bad_rate"]),
    "monthly_target_summary_of_lines": check(SAMPLES_SQL, _MONTHLY.format(y="label", t="lines"), ["bad_rate"]),
    "duplicate_metrics": check(_LINE_SQL, "SELECT k AS duplicate_key_count, r AS duplicate_row_count, r - k AS duplicate_excess_row_count FROM dup", longs=["duplicate_key_count", "duplicate_row_count", "duplicate_excess_row_count"]),
    "label_validity": check(SAMPLES_SQL, "SELECT count(*) AS row_count, count(*) FILTER (label IS NULL) AS missing_target_count, count(*) FILTER (label NOT IN (0, 1)) AS invalid_target_count FROM lines"),
    "class_balance": check(_LINE_SQL, "SELECT g AS good_count, b AS bad_count, g + b AS labeled_sample_count, least(g, b)/(g + b) AS minority_rate, greatest(g, b)/least(g, b) AS majority_ratio FROM facts", ["minority_rate", "majority_ratio"]),
    "all_null_features": check("", "SELECT 'empty_col' AS feature"),
    "high_missing_rows": check(SAMPLES_SQL, f"SELECT l_returnflag, count(*) AS n FROM lines WHERE ({_NULLS})/7.0 >= 0.4 GROUP BY 1"),
    "missing_months": check(
        SAMPLES_SQL + ", seg AS (SELECT DISTINCT event_month FROM samples WHERE o_orderpriority = '1-URGENT' AND c_nationkey = 7)",
        "SELECT strftime(d, '%Y%m') AS event_month FROM (SELECT unnest(generate_series(min(strptime(event_month || '01', '%Y%m%d')), max(strptime(event_month || '01', '%Y%m%d')), INTERVAL 1 MONTH)) AS d FROM seg) WHERE strftime(d, '%Y%m') NOT IN (SELECT event_month FROM seg)",
    ),
    "bad_rate_changes": check(
        SAMPLES_SQL + ", mm AS (SELECT event_month, bad_count/sample_count AS r FROM months)",
        "SELECT * FROM (SELECT lag(event_month) OVER w AS previous_month, event_month AS current_month, lag(r) OVER w AS previous_bad_rate, r AS current_bad_rate, abs(r - lag(r) OVER w) AS absolute_change FROM mm WINDOW w AS (ORDER BY event_month)) WHERE previous_month IS NOT NULL",
        ["previous_bad_rate", "current_bad_rate", "absolute_change"],
    ),
    "latest_month_check": check(_LINE_SQL, "SELECT *, recent_median > 0 AND latest_sample_count < 0.5*recent_median AS incomplete FROM latest", ["recent_median"]),
    "sample_findings": check(
        _LINE_SQL,
        """
        SELECT 'MISSING_TARGET' AS code, 'warning' AS severity, NULL AS subject, m AS value, 0 AS threshold FROM facts WHERE m > 0
        UNION ALL SELECT 'INVALID_TARGET_VALUES', 'warning', NULL, i, 0 FROM facts WHERE i > 0
        UNION ALL SELECT 'DUPLICATE_ID', 'warning', NULL, k, 0 FROM dup WHERE k > 0
        UNION ALL SELECT 'ALL_NULL_FEATURES', 'warning', 'empty_col', 1, 0
        UNION ALL SELECT 'HIGH_MISSING_ROWS', 'warning', NULL, sparse, 0.4 FROM facts WHERE sparse > 0
        UNION ALL SELECT CASE WHEN least(g, b)/(g+b) < 0.01 THEN 'CLASS_IMBALANCE_CRITICAL' ELSE 'CLASS_IMBALANCE_WARNING' END, 'warning', NULL, least(g, b)/(g+b), 0.1 FROM facts WHERE least(g, b)/(g+b) < 0.1
        UNION ALL SELECT 'MONTHLY_BAD_RATE_SHIFT', 'warning', arg_max(current_month, c), max(c), 0.03 FROM change HAVING max(c) >= 0.03
        UNION ALL SELECT 'LATEST_MONTH_INCOMPLETE', 'warning', latest_month, latest_sample_count, 0.5 FROM latest WHERE latest_sample_count < 0.5*recent_median""",
        ["value", "threshold"],
    ),
    "sample_treatment": check(
        SAMPLES_SQL + "," + _FIRST,
        """SELECT event_month, count(*) AS n, sum(label) AS label_sum, sum(l_extendedprice) AS price,
          (SELECT count(*) FROM lines WHERE label IS NULL) AS removed_missing_target,
          (SELECT count(*) FROM labelled) - (SELECT count(*) FROM firsts) AS removed_duplicates,
          (SELECT count(*) FROM firsts) - (SELECT count(*) FROM dense) AS removed_sparse,
          coalesce((SELECT n FROM cutm), 0) AS removed_month, 'empty_col' AS removed_features FROM final GROUP BY 1""",
        ["price"], ["label_sum"], digits=4,
    ),
    "modelling_risk_table": check(
        CELLS_SQL + ", mm AS (SELECT event_month, bad_count/sample_count AS r FROM months), ch AS (SELECT max(c) AS c FROM (SELECT abs(r - lag(r) OVER (ORDER BY event_month)) AS c FROM mm)), "
        "rm AS (SELECT sample_count, row_number() OVER (ORDER BY event_month DESC) AS p FROM months), "
        "lm AS (SELECT max(sample_count) FILTER (p = 1) < 0.5*median(sample_count) FILTER (p BETWEEN 2 AND 4) AS inc FROM rm), "
        "iss AS (SELECT CAST((SELECT c >= 0.03 FROM ch) AS INTEGER) + CAST((SELECT inc FROM lm) AS INTEGER) AS n), "
        "bal AS (SELECT least(sum(bad), count(*)-sum(bad))/count(*) AS minority, sum(bad)/count(*) AS rate FROM samples), "
        "q AS (SELECT 'iv_pass_ratio' AS check_item, avg(CAST(iv >= 0.02 AS DOUBLE)) AS value FROM overview UNION ALL SELECT 'missing_pass_ratio', avg(CAST(missing_rate <= 0.8 AS DOUBLE)) FROM overview "
        "UNION ALL SELECT 'psi_effective_ratio', avg(CAST(max_psi < 0.25 AS DOUBLE)) FROM psi_sum UNION ALL SELECT 'psi_stable_ratio', avg(CAST(max_psi < 0.1 AS DOUBLE)) FROM psi_sum)",
        """
        SELECT 'label_and_key_quality' AS check_item, 0.0 AS value, 'pass' AS status
        UNION ALL SELECT 'overall_bad_rate', rate, CASE WHEN rate BETWEEN 0.01 AND 0.2 THEN 'pass' ELSE 'warn' END FROM bal
        UNION ALL SELECT check_item, value, CASE WHEN value >= 0.8 THEN 'pass' WHEN value >= 0.4 THEN 'hint' ELSE 'warn' END FROM q
        UNION ALL SELECT 'class_balance', minority, CASE WHEN minority < 0.1 THEN 'warn' ELSE 'pass' END FROM bal
        UNION ALL SELECT 'month_completeness', n, CASE WHEN n > 0 THEN 'warn' ELSE 'pass' END FROM iss""",
        ["value"],
    ),
    "evidence_findings": check(
        _MONTH_KS + _PEARSON + """,
        f AS (
          SELECT 'WEAK_FEATURES' AS code, 'warning' AS severity, count(*) AS value, 0.02 AS threshold FROM overview WHERE iv < 0.02
          UNION ALL SELECT 'SUSPECTED_LEAKAGE', 'warning', count(*), 0.5 FROM overview WHERE iv >= 0.5
          UNION ALL SELECT 'HIGH_MISSING_FEATURES', 'warning', count(*), 0.8 FROM overview WHERE missing_rate >= 0.8
          UNION ALL SELECT 'RAISED_MISSING_FEATURES', 'info', count(*), 0.5 FROM overview WHERE missing_rate >= 0.5 AND (SELECT max(missing_rate) FROM overview) < 0.8
          UNION ALL SELECT 'HIGH_PSI_FEATURES', 'warning', count(*), 0.25 FROM psi_sum WHERE max_psi >= 0.25
          UNION ALL SELECT 'CORRELATED_PAIRS', 'info', count(*), 0.7 FROM pearson WHERE abs_correlation >= 0.7
          UNION ALL SELECT 'SMALL_MONTHS', 'warning', count(*), 0.3 FROM small WHERE is_small
          UNION ALL SELECT 'MONTHS_WITHOUT_BAD', 'warning', count(*), 0 FROM small WHERE has_no_bad
          UNION ALL SELECT 'VOLATILE_MONTHLY_KS', 'warning', count(*), 0.1 FROM volatility WHERE monthly_ks_std >= 0.1)""",
        "SELECT code, severity, value, threshold, CASE severity WHEN 'blocker' THEN 0 WHEN 'warning' THEN 1 ELSE 2 END AS severity_rank, 'warning' AS status FROM f WHERE value > 0",
        ["value", "threshold"],
    ),
    "small_months": check(_MONTH_KS, "SELECT * FROM small WHERE is_small OR has_no_bad", ["median_sample_count"], ["bad_count"]),
    "ks_volatility": check(_MONTH_KS, "SELECT *, monthly_ks_std >= 0.1 AS is_volatile FROM volatility", ["monthly_ks_mean", "monthly_ks_std"]),
    "preflight_findings": check(
        _LINE_SQL,
        """
        SELECT 'TOTAL_BAD_COUNT_CRITICAL' AS code, 'blocker' AS severity, NULL AS subject, b AS value, 30 AS threshold FROM facts WHERE b < 30
        UNION ALL SELECT 'TOTAL_BAD_COUNT_LOW', 'warning', NULL, b, 100 FROM facts WHERE b BETWEEN 30 AND 99
        UNION ALL SELECT CASE WHEN sum(bad_count) < 10 THEN 'OOT_BAD_COUNT_CRITICAL' ELSE 'OOT_BAD_COUNT_LOW' END, CASE WHEN sum(bad_count) < 10 THEN 'blocker' ELSE 'warning' END,
          string_agg(event_month, ',' ORDER BY event_month), sum(bad_count), CASE WHEN sum(bad_count) < 10 THEN 10 ELSE 30 END FROM recent WHERE p <= 2 HAVING sum(bad_count) < 30
        UNION ALL SELECT 'HIGH_MISSING_COLUMNS', 'warning', 'empty_col', 1, 0.8""",
        ["value", "threshold"],
    ),
    "month_reliability": check(SAMPLES_SQL, "SELECT event_month, CASE WHEN least(bad_count, sample_count-bad_count) < 10 THEN 'insufficient' WHEN least(bad_count, sample_count-bad_count) < 30 THEN 'directional' ELSE 'usable' END AS reliability FROM months"),
}
