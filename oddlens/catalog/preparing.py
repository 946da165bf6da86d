"""Cleaning, duplicates, typing, category codes and fills."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oddlens.catalog.base import CATEGORICAL, CONTRACT, FEATURES, LINE_CONTRACT, LINE_IDS, LINE_ORDER, NUMERIC, SAMPLES_SQL, check, lines, rounded, samples, split_samples, table
from oddlens.operators import binning, prepare


def event_dates(spark: SparkSession, folder: str) -> DataFrame:
    rows = prepare.add_event_dates(samples(spark, folder), CONTRACT)
    return rows.groupBy("event_month").agg(
        F.count("*").alias("n"), F.date_format(F.min("event_date"), "yyyyMMdd").alias("first_day")
    )


def _kept(df: DataFrame) -> DataFrame:
    return rounded(
        df.groupBy("l_returnflag", "l_linenumber").agg(
            F.count("*").alias("n"), F.sum("l_partkey").alias("parts"), F.sum("l_extendedprice").alias("price"), F.min("ship_date").alias("first_ship")
        ),
        4,
    )


def dedup_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    return _kept(prepare.deduplicate(lines(spark, folder), LINE_IDS, LINE_ORDER, "keep_first"))


def dedup_keep_last(spark: SparkSession, folder: str) -> DataFrame:
    return _kept(prepare.deduplicate(lines(spark, folder), LINE_IDS, LINE_ORDER, "keep_last"))


def quality_decisions(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(prepare.quality_decisions(lines(spark, folder), LINE_CONTRACT, max_missing=0.8, max_constant=0.45))


def cleaned_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Dates added, duplicates out, weak columns dropped; counted per month."""
    clean, _ = prepare.clean_samples(lines(spark, folder), LINE_CONTRACT, LINE_ORDER)
    names = ",".join(sorted(clean.columns))
    return clean.groupBy("event_month").agg(F.count("*").alias("n"), F.max(F.lit(names)).alias("columns"))


_PREPARED = [*FEATURES, "o_clerk_note", "order_code", "ordered_at", "is_large"]
_RULES = prepare.PreparationRules(rare_min_count=2500, max_categories=100)


def _typed(spark: SparkSession, folder: str) -> DataFrame:
    """Samples with a long text, a nearly unique code, a timestamp and a boolean."""
    code = F.concat(F.lit("code-"), F.col("o_orderkey").cast("string"))
    day = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").alias("ordered_at"))
    return split_samples(spark, folder).join(day, "o_orderkey").withColumns(
        {
            "o_clerk_note": F.concat(F.repeat(F.lit("long text "), 10), code),
            "order_code": code,
            "is_large": F.col("o_totalprice") > 250000,
        }
    )


def preparation_decisions(spark: SparkSession, folder: str) -> DataFrame:
    train = _typed(spark, folder).where("dataset = 'train'")
    return rounded(prepare.preparation_decisions(train, _PREPARED).drop("original_type", "position"))


def category_codes(spark: SparkSession, folder: str) -> DataFrame:
    train = split_samples(spark, folder).where("dataset = 'train'")
    return prepare.category_codes(train, CATEGORICAL, _RULES)


def transformed_features(spark: SparkSession, folder: str) -> DataFrame:
    """Train-fitted codes and numbers applied to every split."""
    rows = split_samples(spark, folder)
    plan = prepare.fit_preparation(rows.where("dataset = 'train'"), FEATURES, _RULES)
    ready = prepare.transform_features(rows, plan)
    return rounded(
        ready.groupBy("dataset", "o_orderpriority", "c_mktsegment").agg(
            F.count("*").alias("n"), F.count("sum_qty").alias("with_qty"), F.sum("o_totalprice").alias("price")
        ),
        3,
    )


def median_fill(spark: SparkSession, folder: str) -> DataFrame:
    filled = binning.fill_medians(samples(spark, folder), NUMERIC)
    return rounded(filled.agg(F.count("*").alias("n"), *[F.sum(c).alias(f"sum_{c}") for c in NUMERIC], *[F.count(c).alias(f"n_{c}") for c in NUMERIC]), 3)


QUERIES = {
    f.__name__: f
    for f in (
        event_dates, dedup_keep_first, dedup_keep_last, quality_decisions, cleaned_columns, preparation_decisions,
        category_codes, transformed_features, median_fill,
    )
}


def _dedup(direction: str) -> str:
    order = ", ".join(f"{c} {direction} NULLS {'FIRST' if direction == 'ASC' else 'LAST'}" for c in LINE_ORDER)
    return (
        "SELECT l_returnflag, l_linenumber, count(*) AS n, sum(l_partkey) AS parts, sum(l_extendedprice) AS price, min(ship_date) AS first_ship "
        f"FROM (SELECT * FROM lines QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) = 1) GROUP BY 1, 2"
    )


_LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "empty_col"]
_QUALITY = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, (count(*)-count({c}))/count(*) AS missing_rate, coalesce((SELECT count(*) FROM lines WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY 1 DESC LIMIT 1)/nullif(count({c}), 0), 1) AS constant_rate FROM lines"
    for c in _LINE_COLUMNS
)
_TRAIN = "train AS (SELECT * FROM scored WHERE dataset = 'train')"
_STRINGS = {
    **{c: c for c in FEATURES},
    "o_clerk_note": "repeat('long text ', 10) || 'code-' || o_orderkey",
    "order_code": "'code-' || o_orderkey",
    "ordered_at": "obs_date",
    "is_large": "o_totalprice > 250000",
}
_ACTION = {
    **{c: ("numeric", "retain_numeric") for c in NUMERIC},
    **{c: ("categorical", "encode") for c in CATEGORICAL},
    "o_clerk_note": ("text", "drop_text"),
    "order_code": ("categorical", "drop_near_unique"),
    "ordered_at": ("temporal", "drop_temporal"),
    "is_large": ("boolean", "retain_numeric"),
}
_PREP = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, '{_ACTION[c][0]}' AS inferred_type, '{_ACTION[c][1]}' AS action, (count(*)-count({e}))/count(*) AS missing_rate, count(DISTINCT {e}) AS unique_count, count(DISTINCT {e})/count({e}) AS unique_rate FROM train"
    for c, e in _STRINGS.items()
)
_CODES = _TRAIN + """,
tv AS (SELECT 'o_orderpriority' AS feature, o_orderpriority AS v FROM train UNION ALL SELECT 'c_mktsegment', c_mktsegment FROM train),
tc AS (SELECT feature, v, count(*) AS n, sum(count(*)) OVER (PARTITION BY feature) AS tot, row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, v) AS p FROM tv GROUP BY 1, 2),
fr AS (SELECT feature, v, p - 1 AS code FROM tc WHERE p <= 98 AND (n >= greatest(2500, ceil(tot*0.001)) OR p = 1)),
oc AS (SELECT feature, count(*) AS other_code FROM fr GROUP BY 1),
codes AS (SELECT tc.feature, tc.v AS value, CAST(coalesce(fr.code, oc.other_code) AS INTEGER) AS code, fr.code IS NULL AS is_other, CAST(oc.other_code AS INTEGER) AS other_code
  FROM tc JOIN oc USING (feature) LEFT JOIN fr ON tc.feature = fr.feature AND tc.v = fr.v)
"""

CHECKS = {
    "event_dates": check(SAMPLES_SQL, "SELECT event_month, count(*) AS n, min(obs_date) AS first_day FROM samples GROUP BY 1"),
    "dedup_keep_first": check(SAMPLES_SQL, _dedup("ASC"), ["price"], ["parts"], digits=4),
    "dedup_keep_last": check(SAMPLES_SQL, _dedup("DESC"), ["price"], ["parts"], digits=4),
    "quality_decisions": check(
        SAMPLES_SQL,
        f"SELECT *, CASE WHEN missing_rate > 0.8 THEN 'excluded_missing' WHEN constant_rate > 0.45 THEN 'excluded_constant' ELSE 'retained' END AS decision FROM ({_QUALITY}) "
        "UNION ALL SELECT 'l_partkey', NULL, NULL, 'excluded_manual' UNION ALL SELECT 'l_suppkey', NULL, NULL, 'excluded_manual'",
        ["missing_rate", "constant_rate"],
    ),
    "cleaned_columns": check(
        SAMPLES_SQL,
        "SELECT event_month, count(*) AS n, 'event_date,event_month,l_discount,l_extendedprice,l_linenumber,l_linestatus,l_orderkey,l_quantity,l_returnflag,l_tax,label,ship_date' AS columns "
        "FROM (SELECT * FROM lines QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY ship_date, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount NULLS FIRST) = 1) GROUP BY 1",
    ),
    "preparation_decisions": check(SAMPLES_SQL + "," + _TRAIN, _PREP, ["missing_rate", "unique_rate"]),
    "category_codes": check(SAMPLES_SQL + "," + _CODES, "SELECT * FROM codes"),
    "transformed_features": check(
        SAMPLES_SQL + "," + _CODES,
        "SELECT dataset, a.code AS o_orderpriority, b.code AS c_mktsegment, count(*) AS n, count(sum_qty) AS with_qty, sum(o_totalprice) AS price FROM scored "
        "LEFT JOIN codes a ON a.feature = 'o_orderpriority' AND a.value = o_orderpriority LEFT JOIN codes b ON b.feature = 'c_mktsegment' AND b.value = c_mktsegment GROUP BY 1, 2, 3",
        ["price"], digits=3,
    ),
    "median_fill": check(
        SAMPLES_SQL,
        "SELECT count(*) AS n, " + ", ".join(f"sum(coalesce({c}, m_{c})) AS sum_{c}" for c in NUMERIC) + ", " + ", ".join(f"count(coalesce({c}, m_{c})) AS n_{c}" for c in NUMERIC)
        + " FROM samples, (SELECT " + ", ".join(f"median({c}) AS m_{c}" for c in NUMERIC) + " FROM samples)",
        [f"sum_{c}" for c in NUMERIC], digits=3,
    ),
}
