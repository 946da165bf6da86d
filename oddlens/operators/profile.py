"""Column profile, role hints, leakage hints and feature-level summaries."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oddlens.functions.columns import is_numeric, parse_date, ratio
from oddlens.operators.contract import RiskContract
from oddlens.operators.counts import feature_name, is_present, typed_cells, typed_counts
from oddlens.sources.stages import stage

# Names that hint at a role or at leakage.
TARGET_NAMES = ("y", "y_flag", "label", "target", "bad_flag", "is_bad", "default_flag")
ID_NAME = r"(^|_)(id|key|no|number)(_|$)"
DATE_NAME = r"(date|time|month|yearmonth|ym|日期|时间|年月)"
OPAQUE_NAME = r"(?i)^(flag|var|feature|x)_?\d+$"
POST_OUTCOME_NAME = (
    r"(?i)(collection_result|final_status|write_?off|recovery_result|post_|after_"
    r"|催收结果|最终状态|核销结果)"
)


def _column_facts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with its type, position and date parse counts (one scan)."""
    aggs = [F.count("*").alias("__rows")]
    dated = [c for c in columns if _looks_like_date(c)]
    for i, name in enumerate(dated):
        aggs.append(F.count(parse_date(name, df.schema[name].dataType)).alias(f"__d{i}"))
    cells = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(df.schema[name].dataType.simpleString()).alias("data_type"),
            F.lit(is_numeric(df.schema[name].dataType)).alias("numeric"),
            F.col("__rows").alias("row_count"),
            (F.col(f"__d{dated.index(name)}") if name in dated else F.lit(None).cast("long")).alias("parsed"),
        )
        for position, name in enumerate(columns)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


def _looks_like_date(name: str) -> bool:
    return re.search(DATE_NAME, name.lower()) is not None


def profile_columns(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    sample_size: int = 3,
    approximate: bool = False,
) -> DataFrame:
    """Profile each column: counts, distinct, top value, range, role hint.

    Exact distinct counts come from the value counts; ``approximate`` uses a sketch
    and leaves the top value and samples null, so nothing is shuffled but sketches.
    Samples are the smallest values, since a Spark table has no first rows.
    """
    if sample_size < 1:
        raise ValueError("sample_size must be at least 1")
    columns = list(columns or df.columns)
    facts = _column_facts(df, columns)
    stats = _sketch_stats(df, columns) if approximate else _exact_stats(df, columns, sample_size)
    joined = facts.join(stats, facts.column_name == stats.feature, "left")
    present = F.coalesce(F.col("non_null_count"), F.lit(0))
    result = joined.select(
        "position",
        "column_name",
        "data_type",
        "row_count",
        present.alias("non_null_count"),
        (F.col("row_count") - present).alias("missing_count"),
        F.coalesce(ratio(F.col("row_count") - present, F.col("row_count")), F.lit(0.0)).alias("missing_rate"),
        F.coalesce("unique_count", F.lit(0)).alias("unique_count"),
        F.coalesce(ratio(F.col("unique_count"), present), F.lit(0.0)).alias("unique_rate"),
        "sample_values",
        "top_value",
        F.coalesce("top_value_count", F.lit(0)).alias("top_value_count"),
        F.coalesce(ratio(F.col("top_value_count"), present), F.lit(0.0)).alias("top_value_rate"),
        F.when(F.col("numeric"), F.col("numeric_min")).alias("numeric_min"),
        F.when(F.col("numeric"), F.col("numeric_max")).alias("numeric_max"),
        F.when(F.col("numeric"), F.col("numeric_mean")).alias("numeric_mean"),
        ratio(F.col("parsed"), present).alias("date_parse_rate"),
    )
    return result.withColumns(_role_hint())


def _cell_text() -> Column:
    """Text of a cell; whole numbers print without a fraction."""
    return F.coalesce(F.col("txt"), F.col("whole").cast("string"), F.col("dec"), F.col("num").cast("string"))


def _exact_stats(df: DataFrame, columns: Sequence[str], sample_size: int) -> DataFrame:
    cells = stage(typed_counts(df, columns).where(is_present()))
    stats = cells.groupBy("feature").agg(
        F.sum("n").alias("non_null_count"),
        F.count("*").alias("unique_count"),
        # most frequent value; ties go to the smaller value
        F.min_by(_cell_text(), F.struct(-F.col("n"), "num", "whole", "dec", "txt")).alias("top_value"),
        F.max("n").alias("top_value_count"),
        F.min("num").alias("numeric_min"),
        F.max("num").alias("numeric_max"),
        (F.sum(F.col("num") * F.col("n")) / F.sum("n")).alias("numeric_mean"),
    )
    # Spark limits each task to `sample_size` rows per feature before the shuffle.
    place = F.row_number().over(Window.partitionBy("feature").orderBy("num", "txt"))
    samples = (
        cells.withColumn("place", place)
        .where(F.col("place") <= sample_size)
        .groupBy("feature")
        .agg(F.array_sort(F.collect_list(F.struct("place", _cell_text().alias("text")))).alias("s"))
        .select("feature", F.to_json(F.col("s.text")).alias("sample_values"))
    )
    return stats.join(samples, "feature", "left")


def _sketch_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return (
        typed_cells(df, columns)
        .where(is_present())
        .groupBy("fid")
        .agg(
            F.count("*").alias("non_null_count"),
            F.approx_count_distinct(_cell_text()).alias("unique_count"),
            F.min("num").alias("numeric_min"),
            F.max("num").alias("numeric_max"),
            F.avg("num").alias("numeric_mean"),
        )
        .withColumn("feature", feature_name(columns))
        .drop("fid")
        .withColumns(
            {
                "top_value": F.lit(None).cast("string"),
                "top_value_count": F.lit(None).cast("long"),
                "sample_values": F.lit(None).cast("string"),
            }
        )
    )


def _role_hint() -> dict[str, Column]:
    """Advisory role of a column from its name and its rates."""
    name = F.lower(F.trim("column_name"))
    target = name.isin(*TARGET_NAMES)
    date = name.rlike(DATE_NAME) & (F.coalesce("date_parse_rate", F.lit(0.0)) >= 0.8)
    ident = name.rlike(ID_NAME) & (F.col("non_null_count") > 0) & (F.col("unique_rate") >= 0.95)
    role = F.when(target, "candidate_target").when(date, "candidate_date").when(ident, "candidate_id")
    reason = (
        F.when(target, "name is a known target name")
        .when(date, "name looks like a date and at least 80% of values parse")
        .when(ident, "name looks like a key and at least 95% of values are distinct")
    )
    return {
        "candidate_role": role.otherwise("candidate_feature"),
        "role_reason": reason.otherwise("no target, date or key rule matched"),
    }


def date_parse_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of non-null values of each column that parse as a date."""
    aggs = []
    for i, name in enumerate(columns):
        aggs.append(F.count(name).alias(f"n{i}"))
        aggs.append(F.count(parse_date(name, df.schema[name].dataType)).alias(f"p{i}"))
    cells = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"n{i}").alias("non_null_count"),
            ratio(F.col(f"p{i}"), F.col(f"n{i}")).alias("date_parse_rate"),
        )
        for i, name in enumerate(columns)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


def dominant_values(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Distinct count, dominant count and rate over non-null values per feature.

    A feature without values counts as constant: rate 1.0.
    """
    cells = typed_counts(df, features)
    present = is_present()
    return cells.groupBy("feature").agg(
        F.sum("n").alias("row_count"),
        F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("missing_count"),
        F.count_if(present).alias("unique_count"),
        F.coalesce(F.max(F.when(present, F.col("n"))), F.lit(0)).alias("dominant_count"),
        F.coalesce(
            F.max(F.when(present, F.col("n"))) / F.sum(F.when(present, F.col("n"))), F.lit(1.0)
        ).alias("dominant_rate"),
    )


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """Count and rate per label, ordered by label."""
    counts = df.groupBy(F.col(target).alias("label")).agg(F.count("*").alias("count"))
    total = F.sum("count").over(Window.partitionBy())  # labels-sized
    return counts.withColumn("rate", F.col("count") / total).orderBy("label")


def dataset_summary(df: DataFrame, contract: RiskContract) -> DataFrame:
    """One row: size, feature count, ID and date rates, bad count and bad rate."""
    from oddlens.operators.contract import contract_summary

    return contract_summary(df, contract).select(
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(len(contract.feature_cols(df))).alias("feature_count"),
        "id_unique_rate",
        "date_parse_rate",
        "bad_count",
        ratio(F.col("bad_count"), F.col("row_count")).alias("bad_rate"),
    )


def leakage_review(profile: DataFrame, contract: RiskContract) -> DataFrame:
    """Review hints per column: confirmed role, opaque name, leakage suspicion."""
    name = F.col("column_name")
    role = (
        F.when(name.isin(*contract.id_cols), "id")
        .when(name == F.lit(contract.date_col), "date")
        .when(name == F.lit(contract.target_col), "target")
        .when(name.isin(*contract.exclude_cols), "excluded")
        .otherwise("feature")
    )
    feature = F.col("confirmed_role") == "feature"
    outcome = feature & name.rlike(POST_OUTCOME_NAME)
    unique = feature & (F.col("unique_rate") >= 0.98)
    reason = F.when(outcome, "name refers to an outcome").when(unique, "nearly unique values")
    return profile.withColumn("confirmed_role", role).select(
        "column_name",
        "confirmed_role",
        "candidate_role",
        "data_type",
        "missing_rate",
        "unique_rate",
        (feature & name.rlike(OPAQUE_NAME)).alias("opaque_name"),
        reason.isNotNull().alias("needs_review"),
        reason.alias("review_reason"),
        F.when(reason.isNotNull(), "blocker")
        .when(feature & name.rlike(OPAQUE_NAME), "warning")
        .otherwise("info")
        .alias("severity"),
    )


def field_table(profile: DataFrame, overview: DataFrame) -> DataFrame:
    """Profile of every column with the discrimination metrics of features."""
    extra = overview.select("feature", "iv", "ks", "auc", "bin_count")
    return profile.join(extra, profile.column_name == extra.feature, "left").drop("feature")


def feature_statistics(overview: DataFrame, psi_summary: DataFrame) -> DataFrame:
    """Overview of each feature with its largest monthly PSI."""
    psi = psi_summary.select("feature", F.col("max_psi").alias("max_monthly_psi"))
    return overview.join(psi, "feature", "left")


def top_features(table: DataFrame, column: str, size: int = 10, name: str = "feature") -> DataFrame:
    """The ``size`` largest rows by a metric (a top-k, no full sort)."""
    return table.where(F.col(column).isNotNull()).orderBy(F.desc(column), name).limit(size)


def metric_ranges(statistics: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum, maximum and mean of metrics across features, one row per metric."""
    aggs, cells = [], []
    for c in columns:
        aggs += [F.min(c).alias(f"{c}_0"), F.max(c).alias(f"{c}_1"), F.avg(c).alias(f"{c}_2")]
        cells.append(
            F.struct(
                F.lit(c).alias("metric"),
                F.col(f"{c}_0").alias("min"),
                F.col(f"{c}_1").alias("max"),
                F.col(f"{c}_2").alias("mean"),
            )
        )
    return statistics.agg(*aggs).select(F.inline(F.array(*cells)))


def threshold_counts(
    overview: DataFrame,
    psi_summary: DataFrame,
    pairs: DataFrame,
    min_iv: float = 0.02,
    high_psi: float = 0.25,
    high_corr: float = 0.70,
) -> DataFrame:
    """Counts of weak features, drifting features and strongly correlated pairs."""
    weak = overview.agg(F.count_if(~(F.coalesce("iv", F.lit(-1.0)) >= min_iv)).alias("weak_iv_count"))
    drift = psi_summary.agg(F.count_if(F.col("max_psi") >= high_psi).alias("high_psi_count"))
    twins = pairs.agg(F.count_if(F.col("abs_correlation") >= high_corr).alias("high_corr_count"))
    return weak.crossJoin(drift).crossJoin(twins)  # one row each
