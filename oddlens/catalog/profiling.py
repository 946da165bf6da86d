"""Column profiles, role and leakage hints, feature-level summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oddlens.catalog.base import (
    CATEGORICAL,
    CELLS_SQL,
    CONTRACT,
    FEATURES,
    LINE_FEATURES,
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
from oddlens.operators import binning, correlation, discrimination, profile, stability
from oddlens.sources.stages import stage

_RENAMED = {"o_orderkey": "order_key", "bad": "is_bad", "avg_disc": "x_12", "sum_qty": "post_amount"}


def _named(spark: SparkSession, folder: str) -> DataFrame:
    """``samples`` under names that trigger the naming rules."""
    return samples(spark, folder).withColumnsRenamed(_RENAMED)


def column_profile(spark: SparkSession, folder: str) -> DataFrame:
    found = profile.profile_columns(_named(spark, folder))
    # Doubles print differently per engine; their top value is checked as a count.
    text = F.when(F.col("data_type") != "double", F.col("top_value"))
    return rounded(
        found.select(
            "column_name", "row_count", "non_null_count", "missing_count", "missing_rate", "unique_count", "unique_rate",
            "top_value_count", "top_value_rate", text.alias("top_value"), "numeric_min", "numeric_max", "numeric_mean",
            "date_parse_rate", "candidate_role",
        )
    )


def column_samples(spark: SparkSession, folder: str) -> DataFrame:
    """The smallest values of each text column, as JSON."""
    found = profile.profile_columns(samples(spark, folder), ["obs_date", *CATEGORICAL])
    return found.select("column_name", "sample_values")


def sketched_profile(spark: SparkSession, folder: str) -> DataFrame:
    """One-scan profile; columns with few values are counted exactly by the sketch."""
    found = profile.profile_columns(samples(spark, folder), [*CATEGORICAL, "line_cnt"], approximate=True)
    return rounded(found.select("column_name", "non_null_count", "unique_count", "numeric_min", "numeric_max"))


def date_parse_rates(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.date_parse_rates(samples(spark, folder), ["obs_date", "o_orderpriority", "c_nationkey"]))


def dominant_values(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.dominant_values(lines(spark, folder), LINE_FEATURES))


def large_value_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Keys beyond 2 ** 53, where doubles no longer differ: distinct, dominant and top value,
    entropy, key role and constant rule."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    rows = orders.select(
        (F.col("o_orderkey").cast("long") + F.lit(1 << 60)).alias("order_id"),
        (F.col("o_custkey").cast("long") + F.lit(1 << 60)).alias("customer_number"),
        (F.col("o_orderkey").cast("decimal(30,0)") + F.lit(str(10**25)).cast("decimal(30,0)")).cast("decimal(30,0)").alias("wide_id"),
    )
    columns = rows.columns
    facts = profile.profile_columns(rows).select(F.col("column_name").alias("feature"), F.col("unique_count").alias("profiled"), "top_value", "top_value_count", "candidate_role")
    found = profile.dominant_values(rows, columns).join(facts, "feature").join(binning.value_entropy(rows, columns), "feature")
    constant = (F.col("dominant_rate") > 0.8).alias("is_constant")
    return rounded(found.select("feature", "unique_count", "dominant_count", "profiled", "top_value", "top_value_count", "candidate_role", "entropy", constant))


def target_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.target_distribution(lines(spark, folder), "label"))


def dataset_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.dataset_summary(samples(spark, folder), CONTRACT))


def leakage_review(spark: SparkSession, folder: str) -> DataFrame:
    rows = _named(spark, folder)
    from oddlens.operators.contract import RiskContract

    contract = RiskContract(("order_key",), "obs_date", "is_bad")
    found = profile.leakage_review(profile.profile_columns(rows), contract)
    return rounded(found.select("column_name", "confirmed_role", "candidate_role", "unique_rate", "opaque_name", "needs_review", "severity"))


def _overview(spark: SparkSession, folder: str) -> DataFrame:
    return stage(discrimination.univariate_overview(dated(spark, folder), FEATURES, bad()))


def _psi_summary(rows: DataFrame) -> DataFrame:
    return stage(stability.psi_summary(stability.monthly_psi(rows, binning.fit_bins(rows, FEATURES))))


def field_table(spark: SparkSession, folder: str) -> DataFrame:
    rows = dated(spark, folder)
    table = profile.field_table(
        profile.profile_columns(rows.drop("event_month")), discrimination.univariate_overview(rows, FEATURES, bad())
    )
    return rounded(table.select("column_name", "unique_count", "missing_rate", "iv", "ks", "auc", "bin_count"))


def top_iv(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.top_features(_overview(spark, folder), "iv", 10).select("feature", "iv"))


def top_missing(spark: SparkSession, folder: str) -> DataFrame:
    found = profile.profile_columns(lines(spark, folder), LINE_FEATURES)
    return rounded(profile.top_features(found, "missing_rate", 10, "column_name").select("column_name", "missing_rate"))


def top_psi(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.top_features(_psi_summary(dated(spark, folder)), "max_psi", 10).select("feature", "max_psi"))


def _statistics(spark: SparkSession, folder: str) -> DataFrame:
    rows = dated(spark, folder)
    overview = discrimination.univariate_overview(rows, FEATURES, bad())
    return profile.feature_statistics(overview, _psi_summary(rows))


def feature_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_statistics(spark, folder).select("feature", "variable_type", "iv", "ks", "missing_rate", "max_monthly_psi"))


def metric_ranges(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.metric_ranges(_statistics(spark, folder), ["missing_rate", "iv", "ks", "max_monthly_psi"]))


def threshold_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = dated(spark, folder)
    overview = discrimination.univariate_overview(rows, FEATURES, bad())
    return profile.threshold_counts(overview, _psi_summary(rows), correlation.pearson_pairs(rows, NUMERIC))


QUERIES = {
    f.__name__: f
    for f in (
        column_profile, column_samples, sketched_profile, date_parse_rates, dominant_values, large_value_profile, target_distribution,
        dataset_summary, leakage_review, field_table, top_iv, top_missing, top_psi, feature_statistics, metric_ranges,
        threshold_counts,
    )
}

_COLUMNS = {
    "order_key": ("o_orderkey", "bigint"), "obs_date": ("obs_date", "string"), "is_bad": ("bad", "int"),
    "o_totalprice": ("o_totalprice", "double"), "c_acctbal": ("c_acctbal", "double"), "c_nationkey": ("c_nationkey", "int"),
    "o_orderpriority": ("o_orderpriority", "string"), "c_mktsegment": ("c_mktsegment", "string"),
    "line_cnt": ("line_cnt", "bigint"), "post_amount": ("sum_qty", "double"), "x_12": ("avg_disc", "double"),
}
_ROLES = {"order_key": "candidate_id", "obs_date": "candidate_date", "is_bad": "candidate_target"}


def _profile_sql() -> str:
    parts = []
    for name, (column, kind) in _COLUMNS.items():
        number = kind != "string"
        low, high, mean = (f"CAST({f}({column}) AS DOUBLE)" if number else "CAST(NULL AS DOUBLE)" for f in ("min", "max", "avg"))
        top = "CAST(NULL AS VARCHAR)" if kind == "double" else f"(SELECT CAST({column} AS VARCHAR) FROM samples WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1)"
        top_n = f"(SELECT count(*) FROM samples WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY 1 DESC LIMIT 1)"
        rate = f"count({column})/count({column})" if name == "obs_date" else "CAST(NULL AS DOUBLE)"
        parts.append(
            f"SELECT '{name}' AS column_name, count(*) AS row_count, count({column}) AS non_null_count, count(*)-count({column}) AS missing_count, "
            f"(count(*)-count({column}))/count(*) AS missing_rate, count(DISTINCT {column}) AS unique_count, count(DISTINCT {column})/count({column}) AS unique_rate, "
            f"{top_n} AS top_value_count, {top_n}/count({column}) AS top_value_rate, {top} AS top_value, {low} AS numeric_min, {high} AS numeric_max, {mean} AS numeric_mean, "
            f"{rate} AS date_parse_rate, '{_ROLES.get(name, 'candidate_feature')}' AS candidate_role FROM samples"
        )
    return " UNION ALL ".join(parts)


_PROFILE_DOUBLES = ["missing_rate", "unique_rate", "top_value_rate", "numeric_min", "numeric_max", "numeric_mean", "date_parse_rate"]
_LINE_FACTS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) AS row_count, count(*)-count({c}) AS missing_count, count(DISTINCT {c}) AS unique_count, "
    f"coalesce((SELECT count(*) FROM lines WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY 1 DESC LIMIT 1), 0) AS dominant_count, "
    f"coalesce((SELECT count(*) FROM lines WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY 1 DESC LIMIT 1)/nullif(count({c}), 0), 1) AS dominant_rate FROM lines"
    for c in LINE_FEATURES
)
_SIMPLE = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS unique_count, (count(*)-count({c}))/count(*) AS missing_rate FROM samples"
    for c in ["o_orderkey", "obs_date", "bad", *FEATURES]
)
_TYPES = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, '{'string' if f in CATEGORICAL else 'bigint' if f == 'line_cnt' else 'int' if f == 'c_nationkey' else 'double'}' AS variable_type"
    for f in FEATURES
)

CHECKS = {
    "column_profile": check(SAMPLES_SQL, _profile_sql(), _PROFILE_DOUBLES),
    "column_samples": check(
        SAMPLES_SQL,
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST(to_json(list(v ORDER BY v)) AS VARCHAR) AS sample_values FROM (SELECT DISTINCT {c} AS v FROM samples WHERE {c} IS NOT NULL ORDER BY 1 LIMIT 3)"
            for c in ["obs_date", *CATEGORICAL]
        ),
    ),
    "sketched_profile": check(
        SAMPLES_SQL,
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count({c}) AS non_null_count, count(DISTINCT {c}) AS unique_count, {lo} AS numeric_min, {hi} AS numeric_max FROM samples"
            for c, lo, hi in [*[(c, "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)") for c in CATEGORICAL], ("line_cnt", "CAST(min(line_cnt) AS DOUBLE)", "CAST(max(line_cnt) AS DOUBLE)")]
        ),
        ["numeric_min", "numeric_max"],
    ),
    "date_parse_rates": check(
        SAMPLES_SQL,
        "SELECT 'obs_date' AS column_name, count(obs_date) AS non_null_count, 1.0 AS date_parse_rate FROM samples UNION ALL "
        "SELECT 'o_orderpriority', count(o_orderpriority), 0.0 FROM samples UNION ALL SELECT 'c_nationkey', count(c_nationkey), 0.0 FROM samples",
        ["date_parse_rate"],
    ),
    "dominant_values": check(SAMPLES_SQL, _LINE_FACTS, ["dominant_rate"]),
    "large_value_profile": check(
        """cells AS (
          SELECT 'order_id' AS feature, CAST(CAST(o_orderkey AS HUGEINT) + 1152921504606846976 AS VARCHAR) AS v, CAST(o_orderkey AS BIGINT) AS o FROM orders
          UNION ALL SELECT 'customer_number', CAST(CAST(o_custkey AS HUGEINT) + 1152921504606846976 AS VARCHAR), CAST(o_custkey AS BIGINT) FROM orders
          UNION ALL SELECT 'wide_id', CAST(CAST(o_orderkey AS HUGEINT) + 10000000000000000000000000 AS VARCHAR), CAST(o_orderkey AS BIGINT) FROM orders
        ), vc AS (SELECT feature, v, min(o) AS o, count(*) AS n FROM cells GROUP BY 1, 2)""",
        """SELECT feature, count(*) AS unique_count, max(n) AS dominant_count, count(*) AS profiled, first(v ORDER BY n DESC, o) AS top_value,
          max(n) AS top_value_count, CASE WHEN feature LIKE '%_id' AND count(*) / sum(n) >= 0.95 THEN 'candidate_id' ELSE 'candidate_feature' END AS candidate_role,
          log2(sum(n)) - sum(n * log2(n)) / sum(n) AS entropy, max(n) / sum(n) > 0.8 AS is_constant
        FROM vc GROUP BY feature""",
        ["entropy"],
    ),
    "target_distribution": check(SAMPLES_SQL, "SELECT label, count(*) AS count, count(*)/(SELECT count(*) FROM lines) AS rate FROM lines GROUP BY 1", ["rate"]),
    "dataset_summary": check(
        SAMPLES_SQL,
        "SELECT count(*) AS row_count, 11 AS column_count, 8 AS feature_count, count(DISTINCT o_orderkey)/count(*) AS id_unique_rate, "
        "count(obs_date)/count(*) AS date_parse_rate, sum(bad) AS bad_count, sum(bad)/count(*) AS bad_rate FROM samples",
        ["id_unique_rate", "date_parse_rate", "bad_rate"], ["bad_count"], ["column_count", "feature_count"],
    ),
    "leakage_review": check(
        SAMPLES_SQL,
        f"""SELECT column_name, role AS confirmed_role, candidate_role, unique_rate, role = 'feature' AND column_name = 'x_12' AS opaque_name,
          role = 'feature' AND (column_name = 'post_amount' OR unique_rate >= 0.98) AS needs_review,
          CASE WHEN role = 'feature' AND (column_name = 'post_amount' OR unique_rate >= 0.98) THEN 'blocker' WHEN column_name = 'x_12' THEN 'warning' ELSE 'info' END AS severity
        FROM (SELECT *, CASE column_name WHEN 'order_key' THEN 'id' WHEN 'obs_date' THEN 'date' WHEN 'is_bad' THEN 'target' ELSE 'feature' END AS role FROM ({_profile_sql()}))""",
        ["unique_rate"],
    ),
    "field_table": check(CELLS_SQL, f"SELECT p.*, o.iv, o.ks, o.auc, o.bin_count FROM ({_SIMPLE}) p LEFT JOIN overview o ON p.column_name = o.feature", ["missing_rate", "iv", "ks", "auc"]),
    "top_iv": check(CELLS_SQL, "SELECT feature, iv FROM overview ORDER BY iv DESC, feature LIMIT 10", ["iv"]),
    "top_missing": check(SAMPLES_SQL, f"SELECT feature AS column_name, missing_count/row_count AS missing_rate FROM ({_LINE_FACTS}) ORDER BY 2 DESC, 1 LIMIT 10", ["missing_rate"]),
    "top_psi": check(CELLS_SQL, "SELECT feature, max_psi FROM psi_sum ORDER BY max_psi DESC, feature LIMIT 10", ["max_psi"]),
    "feature_statistics": check(
        CELLS_SQL,
        f"SELECT o.feature, t.variable_type, o.iv, o.ks, o.missing_rate, p.max_psi AS max_monthly_psi FROM overview o LEFT JOIN psi_sum p USING (feature) JOIN ({_TYPES}) t USING (feature)",
        ["iv", "ks", "missing_rate", "max_monthly_psi"],
    ),
    "metric_ranges": check(
        CELLS_SQL,
        " UNION ALL ".join(
            f"SELECT '{m}' AS metric, min({m}) AS min, max({m}) AS max, avg({m}) AS mean FROM (SELECT o.*, p.max_psi AS max_monthly_psi FROM overview o LEFT JOIN psi_sum p USING (feature))"
            for m in ("missing_rate", "iv", "ks", "max_monthly_psi")
        ),
        ["min", "max", "mean"],
    ),
    "threshold_counts": check(
        PAIRS_SQL,
        "SELECT (SELECT count(*) FROM overview WHERE NOT coalesce(iv >= 0.02, false)) AS weak_iv_count, (SELECT count(*) FROM psi_sum WHERE max_psi >= 0.25) AS high_psi_count, "
        "(SELECT count(*) FROM pearson WHERE abs_correlation >= 0.7) AS high_corr_count",
    ),
}
