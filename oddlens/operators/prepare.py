"""Cleaning and train-only feature preparation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from math import ceil

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oddlens.functions.columns import clean_number, is_numeric, month_of, parse_date, ratio
from oddlens.operators.binning import local_frame
from oddlens.operators.contract import ContractError, RiskContract
from oddlens.operators.counts import feature_name, is_present, long_cells, value_counts
from oddlens.operators.diagnose import first_per_id
from oddlens.operators.profile import dominant_values
from oddlens.sources.stages import stage


def add_event_dates(df: DataFrame, contract: RiskContract) -> DataFrame:
    """Add ``event_date`` and ``event_month``; fail when a given date does not parse."""
    if {"event_date", "event_month"} & set(df.columns):
        raise ContractError("columns event_date and event_month are reserved")
    date = parse_date(contract.date_col, df.schema[contract.date_col].dataType)
    broken = df.where(F.col(contract.date_col).isNotNull() & date.isNull()).count()
    if broken:
        raise ContractError(f"{broken} values of '{contract.date_col}' are not dates")
    return df.withColumns({"event_date": date, "event_month": month_of(date)})


def deduplicate(
    df: DataFrame, id_cols: Sequence[str], order_by: Sequence[str], strategy: str = "keep_first"
) -> DataFrame:
    """One row per ID: keep_first, keep_last, or error when an ID repeats."""
    if strategy == "error":
        repeated = df.groupBy(*id_cols).count().where("count > 1").limit(1).count()
        if repeated:
            raise ContractError(f"ids repeat in {list(id_cols)}")
        return df
    if strategy not in {"keep_first", "keep_last"}:
        raise ValueError("strategy must be keep_first, keep_last or error")
    return first_per_id(df, id_cols, order_by, strategy.removeprefix("keep_"))


def quality_decisions(
    df: DataFrame,
    contract: RiskContract,
    max_missing: float = 0.8,
    max_constant: float = 0.8,
    filter_features: bool = True,
) -> DataFrame:
    """Keep or exclude each feature by missing rate, then by its dominant value."""
    stats = dominant_values(df, contract.feature_cols(df)).select(
        F.col("feature").alias("column_name"),
        ratio(F.col("missing_count"), F.col("row_count")).alias("missing_rate"),
        F.col("dominant_rate").alias("constant_rate"),
    )
    if filter_features:
        decision = (
            F.when(F.col("missing_rate") > max_missing, "excluded_missing")
            .when(F.col("constant_rate") > max_constant, "excluded_constant")
            .otherwise("retained")
        )
    else:
        decision = F.lit("deferred_train_fit")
    decided = stats.withColumn("decision", decision)
    if not contract.exclude_cols:
        return decided
    manual = local_frame(df, pd.DataFrame({"column_name": list(contract.exclude_cols)})).select(
        "column_name",
        F.lit(None).cast("double").alias("missing_rate"),
        F.lit(None).cast("double").alias("constant_rate"),
        F.lit("excluded_manual").alias("decision"),
    )
    return manual.unionByName(decided)


def drop_excluded(df: DataFrame, decisions: DataFrame) -> DataFrame:
    """Remove the columns that a decisions table (one row per column) excludes."""
    names = [r.column_name for r in decisions.where("decision like 'excluded%'").collect()]
    return df.drop(*names)


def clean_samples(
    df: DataFrame,
    contract: RiskContract,
    order_by: Sequence[str],
    strategy: str = "keep_first",
    filter_features: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Dates, duplicates and quality filter; returns the table and the decisions."""
    dated = add_event_dates(df, contract)
    clean = stage(deduplicate(dated, contract.id_cols, order_by, strategy))
    features = set(contract.feature_cols(df))
    roles = RiskContract(
        contract.id_cols,
        contract.date_col,
        contract.target_col,
        contract.good_label,
        contract.bad_label,
        tuple(c for c in clean.columns if c not in features and c not in contract.role_cols),
    )
    decisions = stage(quality_decisions(clean, roles, filter_features=filter_features)).where(
        ~F.col("column_name").isin("event_date", "event_month")
    )
    return drop_excluded(clean, decisions), decisions


@dataclass(frozen=True)
class PreparationRules:
    """Default limits of the train-only preparation."""

    text_length: int = 64
    text_unique_rate: float = 0.50
    near_unique_rate: float = 0.98
    max_categories: int = 100
    rare_min_count: int = 20
    rare_min_rate: float = 0.001
    categorical: str = "encode"
    high_cardinality: str = "drop"
    unknown: str = "missing"


@dataclass(frozen=True)
class PreparationPlan:
    """What the train split decided; applied unchanged to every split."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    dropped: tuple[str, ...]
    codes: DataFrame | None
    other_codes: dict[str, int]
    decisions: DataFrame
    rules: PreparationRules = field(default_factory=PreparationRules)

    @property
    def retained(self) -> tuple[str, ...]:
        return (*self.numeric, *self.categorical)


def _kind(dtype: T.DataType) -> str:
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if is_numeric(dtype):
        return "numeric"
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return "string"
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "temporal"
    return "unsupported"


#: Parts that features are counted in: a task holds the different values of one part only.
PARTS = 16
#: Bytes of a text beyond which its sha256 stands for it while values are counted.
LONG = 32


def _value_stats(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows, values, different values and average length of a text, per feature."""
    digest = F.concat(F.unhex(F.sha2("txt", 256)), F.lit(b"\0"))
    key = F.when(F.octet_length("txt") > LONG, digest).otherwise(F.col("txt").cast("binary"))
    cells = long_cells(df, features).select("fid", "num", key.alias("txt"), F.length("txt").alias("chars"))
    counts = cells.groupBy("fid", "num", "txt").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))
    present = is_present()
    n = F.when(present, F.col("n"))
    stats = counts.groupBy("fid").agg(
        F.sum("n").alias("row_count"),
        F.coalesce(F.sum(n), F.lit(0)).alias("value_count"),
        F.count_if(present).alias("unique_count"),
        F.coalesce(ratio(F.sum("chars"), F.sum(n)), F.lit(0.0)).alias("average_length"),
    )
    return stats.select(feature_name(features), "row_count", "value_count", "unique_count", "average_length")


def preparation_decisions(df: DataFrame, features: Sequence[str], rules: PreparationRules | None = None) -> DataFrame:
    """Type and action per feature, judged on the given (train) rows only."""
    rules = rules or PreparationRules()
    kinds = {f: _kind(df.schema[f].dataType) for f in features}
    countable = [f for f in features if kinds[f] != "unsupported"]
    rows = stage(df.select(*countable))
    size = ceil(len(countable) / PARTS)
    stats = reduce(DataFrame.unionByName, [_value_stats(rows, countable[a : a + size]) for a in range(0, len(countable), size)])
    meta = local_frame(
        df,
        pd.DataFrame(
            [(i, f, df.schema[f].dataType.simpleString(), kinds[f]) for i, f in enumerate(features)],
            columns=["position", "feature", "original_type", "kind"],
        ),
    )
    joined = meta.join(stats, "feature", "left").withColumn(
        "unique_rate", F.coalesce(ratio(F.col("unique_count"), F.col("value_count")), F.lit(0.0))
    )
    text = (F.col("average_length") >= rules.text_length) & (F.col("unique_rate") >= rules.text_unique_rate)
    string_action = (
        F.when(text, "drop_text")
        .when(F.col("unique_rate") >= rules.near_unique_rate, "drop_near_unique")
        .when(F.lit(rules.categorical == "drop"), "drop_categorical")
        .when((F.col("unique_count") > rules.max_categories) & F.lit(rules.high_cardinality == "drop"), "drop_high_cardinality")
        .otherwise("encode")
    )
    kind = F.col("kind")
    action = (
        F.when(kind.isin("numeric", "boolean"), "retain_numeric")
        .when(kind == "string", string_action)
        .when(kind == "temporal", "drop_temporal")
        .otherwise("drop_unsupported")
    )
    inferred = F.when((kind == "string") & text, "text").when(kind == "string", "categorical").otherwise(kind)
    return joined.select(
        "position",
        "feature",
        "original_type",
        inferred.alias("inferred_type"),
        action.alias("action"),
        F.coalesce(ratio(F.col("row_count") - F.col("value_count"), F.col("row_count")), F.lit(0.0)).alias("missing_rate"),
        F.coalesce("unique_count", F.lit(0)).alias("unique_count"),
        "unique_rate",
    )


def category_codes(df: DataFrame, features: Sequence[str], rules: PreparationRules | None = None) -> DataFrame:
    """``(feature, value, code, is_other, other_code)`` fitted on the given rows.

    Frequent values get codes by (count desc, value asc); rare values share the next
    code. The number of frequent values is bounded, so only they are ranked, and the
    rank is limited inside each task before any shuffle.
    """
    rules = rules or PreparationRules()
    counts = stage(value_counts(df, features).where(F.col("txt").isNotNull()).select("feature", "txt", "n"))
    keep = max(1, rules.max_categories - 2)
    totals = counts.groupBy("feature").agg(F.sum("n").alias("total"))
    needed = F.greatest(F.lit(rules.rare_min_count), F.ceil(F.col("total") * F.lit(rules.rare_min_rate)))
    place = F.row_number().over(Window.partitionBy("feature").orderBy(F.desc("n"), "txt"))
    frequent = stage(
        counts.withColumn("place", place)
        .where(F.col("place") <= keep)
        .join(totals, "feature")
        # the most common value is always kept
        .where((F.col("n") >= needed) | (F.col("place") == 1))
        .select("feature", "txt", (F.col("place") - 1).alias("code"))
    )
    other = frequent.groupBy("feature").agg(F.count("*").cast("int").alias("other_code"))
    return (
        counts.join(frequent, ["feature", "txt"], "left")
        .join(other, "feature")
        .select(
            "feature",
            F.col("txt").alias("value"),
            F.coalesce("code", "other_code").cast("int").alias("code"),
            F.col("code").isNull().alias("is_other"),
            "other_code",
        )
    )


def fit_preparation(df: DataFrame, features: Sequence[str], rules: PreparationRules | None = None) -> PreparationPlan:
    """Learn types, drops and category codes on the train split.

    Only the action of a text depends on its values, so only texts are counted here; the
    plan's ``decisions``, with the counts of all features, are computed when they are read.
    """
    rules = rules or PreparationRules()
    decisions = preparation_decisions(df, features, rules)
    texts = [f for f in features if _kind(df.schema[f].dataType) == "string"]
    actions = {f: "retain_numeric" if _kind(df.schema[f].dataType) in ("numeric", "boolean") else "drop" for f in features}
    if texts:
        actions |= {r.feature: r.action for r in preparation_decisions(df, texts, rules).select("feature", "action").collect()}
    numeric = tuple(f for f in features if actions[f] == "retain_numeric")
    categorical = tuple(f for f in features if actions[f] == "encode")
    if not numeric and not categorical:
        raise ValueError("no trainable feature is left")
    codes, other = None, {}
    if categorical:
        codes = stage(category_codes(df, categorical, rules), partition_by=["feature"])
        other = {r.feature: r.other_code for r in codes.groupBy("feature").agg(F.max("other_code").alias("other_code")).collect()}
        # A categorical feature without any train value has no codes at all.
        other = {f: other.get(f, 0) for f in categorical}
    return PreparationPlan(
        numeric=numeric,
        categorical=categorical,
        dropped=tuple(f for f in features if f not in numeric and f not in categorical),
        codes=codes,
        other_codes=other,
        decisions=decisions,
        rules=rules,
    )


def transform_features(df: DataFrame, plan: PreparationPlan) -> DataFrame:
    """Apply a fitted plan: doubles without ±inf, integer codes, dropped columns.

    Each code table was written on its own, so its size is known: it is broadcast
    when small and joined by shuffle when a category has very many values.
    """
    result = df.drop(*plan.dropped)
    if plan.numeric:
        result = result.withColumns({f: clean_number(F.col(f)) for f in plan.numeric})
    for f in plan.categorical:
        codes = plan.codes.where(F.col("feature") == f).select(F.col("value").alias(f), F.col("code").alias("__code"))
        joined = result.join(codes, f, "left")
        unseen = F.lit(plan.other_codes[f]) if plan.rules.unknown == "other" else F.lit(None).cast("int")
        code = F.when(F.col(f).isNotNull(), F.coalesce("__code", unseen))
        result = joined.withColumn(f, code).drop("__code")
    order = [c for c in df.columns if c not in plan.dropped]
    return result.select(*order)


def rare_floor(total: int, rules: PreparationRules | None = None) -> int:
    """Smallest count a category needs to get a code of its own."""
    rules = rules or PreparationRules()
    return max(rules.rare_min_count, ceil(total * rules.rare_min_rate))
