"""Reading, writing, dates and roles."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oddlens.catalog.base import CELLS_SQL, CONTRACT, FEATURES, LINE_CONTRACT, SAMPLES_SQL, check, dated, lines, rounded, samples, scored, table
from oddlens.functions.columns import month_digits, month_of, normalize_missing, parse_date, round_doubles
from oddlens.operators import binning, profile, split, stability
from oddlens.operators.contract import contract_summary, fill_roles_from_profile, infer_roles, override_roles, RiskContract
from oddlens.sources import StageStore, load_metadata, load_table, read_trial_log, restore_split, write_metric_csv, write_partitioned


def _scratch(spark: SparkSession) -> str:
    return StageStore(spark, run="files").path(uuid.uuid4().hex[:16])


def table_metadata(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{folder}/lineitem.parquet"
    return load_metadata(load_table(spark, path), path).drop("path")


def pruned_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Only two columns and the matching row groups are read."""
    rows = load_table(spark, f"{folder}/lineitem.parquet")
    late = rows.where(F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))
    return late.groupBy("l_returnflag").agg(F.count("*").alias("n"))


def _psi(spark: SparkSession, folder: str) -> DataFrame:
    rows = dated(spark, folder)
    return stability.monthly_psi(rows, binning.fit_bins(rows, FEATURES))


def metric_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = _scratch(spark) + ".csv"
    write_metric_csv(stability.psi_summary(_psi(spark, folder)), path)
    back = load_table(spark, path, schema="feature string, average_psi double, max_psi double, psi_warning boolean")
    return back.select("feature", "average_psi", "max_psi", "psi_warning")


def rounded_overview(spark: SparkSession, folder: str) -> DataFrame:
    return round_doubles(stability.psi_summary(_psi(spark, folder)).select("feature", "average_psi", "max_psi"))


def partitioned_split_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = _scratch(spark) + ".parquet"
    write_partitioned(scored(spark, folder), path)
    oot = load_table(spark, path).where("dataset = 'oot'")
    return rounded(oot.groupBy("event_month").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"), F.sum("score").alias("score")))


def staged_table_reuse(spark: SparkSession, folder: str) -> DataFrame:
    """One written table, read by two later steps."""
    store = StageStore(spark)
    store.put("samples", samples(spark, folder))
    labels = store.get("samples").groupBy("bad").agg(F.count("*").alias("n"))
    values = store.get("samples").groupBy("bad").agg(F.count("line_cnt").alias("with_lines"))
    return labels.join(values, "bad")


def trial_log_events(spark: SparkSession, folder: str) -> DataFrame:
    """A log with whole, broken and unnumbered lines, written from the events."""
    event = F.to_json(
        F.struct(
            F.col("event_id").alias("iteration"),
            F.col("event_type").alias("status"),
            F.create_map(F.lit("validate"), F.create_map(F.lit("ks"), F.col("value"))).alias("metrics"),
        )
    )
    line = (
        F.when(F.col("event_type") == "error", F.substring(event, 1, 9))
        .when(F.col("event_type") == "signup", F.regexp_replace(event, r'"iteration":(\d+)', '"iteration":"$1"'))
        .otherwise(event)
    )
    path = _scratch(spark)
    table(spark, folder, "events").select(line.alias("value")).write.text(path)
    return read_trial_log(spark, path).select(
        F.col("iteration").cast("long").alias("iteration"), "status", F.col("metrics")["validate"]["ks"].alias("validate_ks")
    )


def restored_split(spark: SparkSession, folder: str) -> DataFrame:
    """Labels restored from a month manifest, as saved by an earlier split."""
    rows = dated(spark, folder)
    manifest = split.ratio_split_months(split.month_counts(rows))
    months = {r.event_month: r.dataset for r in manifest.collect()}
    labelled = restore_split(rows, "obs_date", months)
    return labelled.groupBy("dataset").agg(
        F.count("*").alias("n"), F.min("event_month").alias("first_month"), F.max("event_month").alias("last_month")
    )


def contract_facts(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(contract_summary(samples(spark, folder), CONTRACT))


def contract_facts_of_lines(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(contract_summary(lines(spark, folder), LINE_CONTRACT))


def overridden_roles(spark: SparkSession, folder: str) -> DataFrame:
    """The order becomes the ID of a line table that was declared per line."""
    contract = override_roles(LINE_CONTRACT, id_cols="l_orderkey")
    return rounded(contract_summary(lines(spark, folder), contract).select("row_count", "id_count", "id_unique_rate"))


_NAMED = {"o_orderkey": "Customer_ID", "obs_date": "Apply_Date", "bad": "Label"}


def inferred_roles(spark: SparkSession, folder: str) -> DataFrame:
    """Roles found by column names alone, then measured."""
    rows = samples(spark, folder).withColumnsRenamed(_NAMED)
    contract = infer_roles(rows)
    return rounded(
        contract_summary(rows, contract).select(
            F.lit(contract.id_cols[0]).alias("id_col"),
            F.lit(contract.date_col).alias("date_col"),
            F.lit(contract.target_col).alias("target_col"),
            "row_count",
            "id_count",
            "date_parsed_count",
            "bad_count",
        )
    )


def roles_from_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Missing roles filled with the first profile candidate of each kind."""
    rows = samples(spark, folder).withColumnsRenamed({"o_orderkey": "order_key", "bad": "is_bad"})
    found = fill_roles_from_profile(profile.profile_columns(rows), RiskContract((), None, None), rows.columns)
    return rounded(
        contract_summary(rows, found).select(
            F.lit(found.id_cols[0]).alias("id_col"),
            F.lit(found.date_col).alias("date_col"),
            F.lit(found.target_col).alias("target_col"),
            "id_unique_rate",
            "date_parse_rate",
            "bad_count",
        )
    )


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates written in every accepted format, and one that is not accepted."""
    day = F.col("o_orderdate")
    kind = F.col("o_orderkey") % 7
    text = F.date_format(day, "dd.MM.yyyy")
    for i, fmt in enumerate(("yyyyMMdd", "yyyy-MM-dd", "yyyy/MM/dd", "yyyyMM", "yyyy-MM", "' 'yyyyMMdd' '")):
        text = F.when(kind == i, F.date_format(day, fmt)).otherwise(text)
    return table(spark, folder, "orders").select(kind.alias("kind"), text.alias("text"))


def parsed_dates(spark: SparkSession, folder: str) -> DataFrame:
    rows = _texts(spark, folder)
    date = parse_date("text", rows.schema["text"].dataType)
    return rows.groupBy("kind", month_of(date).alias("event_month")).agg(
        F.count("*").alias("n"), F.min(F.date_format(date, "yyyyMMdd")).alias("first_day")
    )


def month_keys(spark: SparkSession, folder: str) -> DataFrame:
    rows = _texts(spark, folder)
    return rows.groupBy("kind", month_digits("text", rows.schema["text"].dataType).alias("month_key")).agg(F.count("*").alias("n"))


def finite_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """NaN and infinities, made by dividing doubles by zero, become null."""
    value = F.col("value")
    odd = (
        F.when(F.col("event_type") == "error", F.lit(float("nan")))
        .when(F.col("event_type") == "click", F.lit(float("inf")))
        .when(F.col("event_type") == "view", F.lit(float("-inf")))
        .otherwise(value)
    )
    rows = normalize_missing(table(spark, folder, "events").select("event_type", odd.alias("value")))
    return rounded(
        rows.groupBy("event_type").agg(F.count("*").alias("n"), F.count("value").alias("finite"), F.sum("value").alias("total")), 4
    )


QUERIES = {
    "table_metadata": table_metadata,
    "pruned_scan": pruned_scan,
    "metric_csv_roundtrip": metric_csv_roundtrip,
    "rounded_overview": rounded_overview,
    "partitioned_split_roundtrip": partitioned_split_roundtrip,
    "staged_table_reuse": staged_table_reuse,
    "trial_log_events": trial_log_events,
    "restored_split": restored_split,
    "contract_facts": contract_facts,
    "contract_facts_of_lines": contract_facts_of_lines,
    "overridden_roles": overridden_roles,
    "inferred_roles": inferred_roles,
    "roles_from_profile": roles_from_profile,
    "parsed_dates": parsed_dates,
    "month_keys": month_keys,
    "finite_numbers": finite_numbers,
}

_FACTS = """
SELECT count(*) AS row_count, count(DISTINCT {ids}) AS id_count, count({date}) AS date_count, count({date}) AS date_parsed_count,
  count(*) FILTER ({y} IS NULL) AS missing_target_count, count(*) FILTER ({y} NOT IN (0, 1)) AS invalid_target_count,
  count(*) FILTER ({y} = 0) AS good_count, count(*) FILTER ({y} = 1) AS bad_count,
  count(DISTINCT {ids})/count(*) AS id_unique_rate, count({date})/count({date}) AS date_parse_rate
FROM {t}"""

_TEXTS = """
SELECT o_orderkey % 7 AS kind, CASE o_orderkey % 7 WHEN 0 THEN strftime(o_orderdate, '%Y%m%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
  WHEN 2 THEN strftime(o_orderdate, '%Y/%m/%d') WHEN 3 THEN strftime(o_orderdate, '%Y%m') WHEN 4 THEN strftime(o_orderdate, '%Y-%m')
  WHEN 5 THEN ' ' || strftime(o_orderdate, '%Y%m%d') || ' ' ELSE strftime(o_orderdate, '%d.%m.%Y') END AS text, o_orderdate AS day
FROM orders"""

RATIO_MANIFEST = """
typical AS (SELECT median(sample_count) AS m, count(*) AS k FROM months),
cut AS (SELECT event_month, sample_count, sample_count < m*0.3 AND k >= 2 AND event_month = (SELECT max(event_month) FROM months) AS is_cut FROM months, typical),
kept AS (SELECT event_month, sample_count, row_number() OVER (ORDER BY event_month DESC) AS p FROM cut WHERE NOT is_cut),
hist AS (SELECT event_month, sum(sample_count) OVER (ORDER BY event_month DESC) - sample_count AS newer,
  greatest(1, floor(sum(sample_count) OVER () * 0.2)) AS target FROM kept WHERE p > 2),
ratio_manifest AS (
  SELECT event_month, 'excluded' AS dataset FROM cut WHERE is_cut
  UNION ALL SELECT event_month, 'oot' FROM kept WHERE p <= 2
  UNION ALL SELECT event_month, CASE WHEN newer < target THEN 'validate' ELSE 'train' END FROM hist)
"""

CHECKS = {
    "table_metadata": check("", "SELECT 'parquet' AS source_format, count(*) AS row_count, 11 AS column_count FROM lineitem", longs=["row_count"], ints=["column_count"]),
    "pruned_scan": check("", "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01' GROUP BY 1"),
    "metric_csv_roundtrip": check(CELLS_SQL, "SELECT *, max_psi >= 0.25 AS psi_warning FROM psi_sum", ["average_psi", "max_psi"], digits=5),
    "rounded_overview": check(CELLS_SQL, "SELECT * FROM psi_sum", ["average_psi", "max_psi"], digits=5),
    "partitioned_split_roundtrip": check(SAMPLES_SQL, "SELECT event_month, count(*) AS n, sum(bad) AS bad, sum(score) AS score FROM scored WHERE dataset = 'oot' GROUP BY 1", ["score"], ["n", "bad"]),
    "staged_table_reuse": check(SAMPLES_SQL, "SELECT bad, count(*) AS n, count(line_cnt) AS with_lines FROM samples GROUP BY 1"),
    "trial_log_events": check("", "SELECT event_id AS iteration, event_type AS status, value AS validate_ks FROM events WHERE event_type NOT IN ('error', 'signup')"),
    "restored_split": check(SAMPLES_SQL + "," + RATIO_MANIFEST, "SELECT dataset, count(*) AS n, min(event_month) AS first_month, max(event_month) AS last_month FROM samples JOIN ratio_manifest USING (event_month) GROUP BY 1"),
    "contract_facts": check(SAMPLES_SQL, _FACTS.format(ids="o_orderkey", date="obs_date", y="bad", t="samples"), ["id_unique_rate", "date_parse_rate"]),
    "contract_facts_of_lines": check(SAMPLES_SQL, _FACTS.format(ids="(l_orderkey, l_linenumber)", date="ship_date", y="label", t="lines"), ["id_unique_rate", "date_parse_rate"]),
    "overridden_roles": check("", "SELECT count(*) AS row_count, count(DISTINCT l_orderkey) AS id_count, count(DISTINCT l_orderkey)/count(*) AS id_unique_rate FROM lineitem", ["id_unique_rate"]),
    "inferred_roles": check(SAMPLES_SQL, "SELECT 'Customer_ID' AS id_col, 'Apply_Date' AS date_col, 'Label' AS target_col, count(*) AS row_count, count(DISTINCT o_orderkey) AS id_count, count(obs_date) AS date_parsed_count, sum(bad) AS bad_count FROM samples", longs=["bad_count"]),
    "roles_from_profile": check(SAMPLES_SQL, "SELECT 'order_key' AS id_col, 'obs_date' AS date_col, 'is_bad' AS target_col, count(DISTINCT o_orderkey)/count(*) AS id_unique_rate, count(obs_date)/count(*) AS date_parse_rate, sum(bad) AS bad_count FROM samples", ["id_unique_rate", "date_parse_rate"], ["bad_count"]),
    "parsed_dates": check("", f"SELECT kind, CASE WHEN kind < 6 THEN strftime(day, '%Y%m') END AS event_month, count(*) AS n, min(CASE WHEN kind < 6 THEN CASE WHEN kind IN (3, 4) THEN strftime(day, '%Y%m') || '01' ELSE strftime(day, '%Y%m%d') END END) AS first_day FROM ({_TEXTS}) GROUP BY 1, 2"),
    "month_keys": check("", f"SELECT kind, substr(regexp_replace(trim(text), '[^0-9]', '', 'g'), 1, 6) AS month_key, count(*) AS n FROM ({_TEXTS}) GROUP BY 1, 2"),
    "finite_numbers": check("", "SELECT event_type, count(*) AS n, count(*) FILTER (event_type NOT IN ('error', 'click', 'view')) AS finite, sum(value) FILTER (event_type NOT IN ('error', 'click', 'view')) AS total FROM events GROUP BY 1", ["total"], digits=4),
}
