"""Sample diagnostics: duplicates, labels, months, missing cells, findings, treatment."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oddlens.functions.columns import month_of, null_count, parse_date, ratio
from oddlens.operators.contract import RiskContract
from oddlens.sources.stages import stage


@dataclass(frozen=True)
class DiagnosticLimits:
    """Default thresholds of the sample checks."""

    iv_weak: float = 0.02
    psi_warning: float = 0.25
    psi_stable: float = 0.10
    bad_rate_min: float = 0.01
    bad_rate_max: float = 0.20
    feature_pass_ratio: float = 0.80
    max_missing_rate: float = 0.80
    imbalance_warning: float = 0.10
    imbalance_critical: float = 0.01
    latest_month_ratio: float = 0.50
    bad_rate_change: float = 0.03
    high_missing_row_rate: float = 0.80


@dataclass(frozen=True)
class Treatment:
    """Actions applied by ``apply_treatment``."""

    keep: str = "first"
    high_missing_rows: str = "keep"
    incomplete_latest_month: str = "exclude"


@dataclass(frozen=True)
class TreatmentResult:
    data: DataFrame
    removed_missing_target: int
    removed_duplicates: int
    removed_features: tuple[str, ...]
    removed_high_missing_rows: int
    removed_incomplete_month: int
    excluded_month: str | None = field(default=None)


def event_month(df: DataFrame, contract: RiskContract) -> Column:
    return month_of(parse_date(contract.date_col, df.schema[contract.date_col].dataType))


def duplicate_metrics(df: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """Duplicate key groups, the rows in them and the rows beyond the first."""
    groups = df.groupBy(*id_cols).agg(F.count("*").alias("n"))
    many = F.col("n") > 1
    rows = F.coalesce(F.sum(F.when(many, F.col("n"))), F.lit(0))
    return groups.agg(
        F.count_if(many).alias("duplicate_key_count"),
        rows.alias("duplicate_row_count"),
        (rows - F.count_if(many)).alias("duplicate_excess_row_count"),
    )


def monthly_target_summary(df: DataFrame, contract: RiskContract) -> DataFrame:
    """Counts and bad rate per observation month; unparsable dates are left out."""
    label = F.col(contract.target_col)
    good, bad = F.lit(contract.good_label), F.lit(contract.bad_label)
    return (
        df.select(event_month(df, contract).alias("event_month"), label.alias("label"))
        .where("event_month is not null")
        .groupBy("event_month")
        .agg(
            F.count("*").alias("sample_count"),
            F.count_if(F.col("label") == good).alias("good_count"),
            F.count_if(F.col("label") == bad).alias("bad_count"),
            F.count_if(F.col("label").isNull()).alias("missing_target_count"),
            F.count_if((F.col("label") != good) & (F.col("label") != bad)).alias("invalid_target_count"),
        )
        .withColumn("labeled_sample_count", F.col("good_count") + F.col("bad_count"))
        .withColumn("bad_rate", ratio(F.col("bad_count"), F.col("labeled_sample_count")))
    )


def label_validity(df: DataFrame, contract: RiskContract) -> DataFrame:
    """Counts of null labels and of labels outside the declared pair."""
    label = F.col(contract.target_col)
    return df.agg(
        F.count("*").alias("row_count"),
        F.count_if(label.isNull()).alias("missing_target_count"),
        F.count_if(~label.isin(contract.good_label, contract.bad_label)).alias("invalid_target_count"),
    )


def class_balance(df: DataFrame, contract: RiskContract) -> DataFrame:
    """Label counts, minority rate and majority-to-minority ratio."""
    label = F.col(contract.target_col)
    counts = df.agg(
        F.count_if(label == F.lit(contract.good_label)).alias("good_count"),
        F.count_if(label == F.lit(contract.bad_label)).alias("bad_count"),
    )
    small = F.least("good_count", "bad_count")
    return counts.select(
        "good_count",
        "bad_count",
        (F.col("good_count") + F.col("bad_count")).alias("labeled_sample_count"),
        ratio(small, F.col("good_count") + F.col("bad_count")).alias("minority_rate"),
        ratio(F.greatest("good_count", "bad_count"), small).alias("majority_ratio"),
    )


def all_null_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features that hold no value at all (one pass over all of them)."""
    counts = df.agg(*[F.count(c).alias(f"c{i}") for i, c in enumerate(features)])
    cells = [
        F.struct(F.lit(c).alias("feature"), F.col(f"c{i}").alias("non_null_count"))
        for i, c in enumerate(features)
    ]
    return counts.select(F.inline(F.array(*cells))).where("non_null_count = 0").select("feature")


def high_missing_rows(df: DataFrame, features: Sequence[str], rate: float = 0.80) -> DataFrame:
    """Rows whose share of null features reaches ``rate``."""
    return df.where(null_count(features) / F.lit(float(len(features))) >= rate)


def missing_months(monthly: DataFrame) -> DataFrame:
    """Months without rows between the first and the last month."""
    day = F.to_date(F.concat("event_month", F.lit("01")), "yyyyMMdd")
    span = monthly.select(day.alias("day")).agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    every = (
        span.where("lo is not null")
        .select(F.explode(F.expr("sequence(lo, hi, interval 1 month)")).alias("day"))
        .select(F.date_format("day", "yyyyMM").alias("event_month"))
    )
    return every.join(monthly.select("event_month"), "event_month", "left_anti")


def bad_rate_changes(monthly: DataFrame) -> DataFrame:
    """Month-to-month change of the bad rate; months without labels break the chain."""
    by_month = Window.orderBy("event_month")  # months-sized
    return (
        monthly.select(
            F.lag("event_month").over(by_month).alias("previous_month"),
            F.col("event_month").alias("current_month"),
            F.lag("bad_rate").over(by_month).alias("previous_bad_rate"),
            F.col("bad_rate").alias("current_bad_rate"),
        )
        .where("previous_bad_rate is not null and current_bad_rate is not null")
        .withColumn("absolute_change", F.abs(F.col("current_bad_rate") - F.col("previous_bad_rate")))
    )


def latest_month_check(monthly: DataFrame, min_ratio: float = 0.50) -> DataFrame:
    """Latest month against the median of up to three months before it."""
    place = F.row_number().over(Window.orderBy(F.desc("event_month")))  # months-sized
    ranked = monthly.select("event_month", "sample_count", place.alias("place"))
    return (
        ranked.agg(
            F.max(F.when(F.col("place") == 1, F.col("event_month"))).alias("latest_month"),
            F.max(F.when(F.col("place") == 1, F.col("sample_count"))).alias("latest_sample_count"),
            F.percentile(F.when(F.col("place").between(2, 4), F.col("sample_count")), 0.5).alias("recent_median"),
        )
        .withColumn(
            "incomplete",
            F.coalesce(
                (F.col("recent_median") > 0)
                & (F.col("latest_sample_count") < min_ratio * F.col("recent_median")),
                F.lit(False),
            ),
        )
    )


def _row(source: DataFrame, code, severity, when: Column, value: Column, limit, subject: Column | None = None) -> DataFrame:
    return source.where(when).select(
        (code if isinstance(code, Column) else F.lit(code)).alias("code"),
        (severity if isinstance(severity, Column) else F.lit(severity)).alias("severity"),
        (F.lit(None).cast("string") if subject is None else subject.cast("string")).alias("subject"),
        value.cast("double").alias("value"),
        F.lit(limit).cast("double").alias("threshold"),
    )


def union_findings(rows: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, rows)


def sample_findings(
    df: DataFrame, contract: RiskContract, limits: DiagnosticLimits | None = None
) -> DataFrame:
    """One row per problem found: code, severity, subject, value, threshold.

    The table is read three times: one pass for label counts, null counts and
    missing rows, one for the ID groups, one for the months.
    """
    limits = limits or DiagnosticLimits()
    features = contract.feature_cols(df)
    label = F.col(contract.target_col)
    aggs = [
        F.count("*").alias("rows"),
        F.count_if(label.isNull()).alias("label_null"),
        F.count_if(~label.isin(contract.good_label, contract.bad_label)).alias("label_invalid"),
        F.count_if(label == F.lit(contract.good_label)).alias("good"),
        F.count_if(label == F.lit(contract.bad_label)).alias("bad"),
    ]
    if features:
        aggs.append(
            F.count_if(
                null_count(features) / F.lit(float(len(features))) >= limits.high_missing_row_rate
            ).alias("sparse_rows")
        )
        empty = [F.when(F.count(c) == 0, F.lit(c)) for c in features]
        aggs.append(F.array_join(F.array_compact(F.array(*empty)), ",").alias("empty_features"))
    else:
        aggs += [F.lit(0).alias("sparse_rows"), F.lit("").alias("empty_features")]
    facts = stage(df.agg(*aggs))
    monthly = stage(monthly_target_summary(df, contract))
    minority = ratio(F.least("good", "bad"), F.col("good") + F.col("bad"))
    n = F.col
    empty_count = F.size(F.filter(F.split("empty_features", ","), lambda c: c != ""))
    change = bad_rate_changes(monthly).agg(
        F.max("absolute_change").alias("change"),
        F.min_by("current_month", F.struct(-F.col("absolute_change"), "current_month")).alias("month"),
    )
    gaps = missing_months(monthly).agg(
        F.count("*").alias("gaps"), F.array_join(F.sort_array(F.collect_list("event_month")), ",").alias("months")
    )
    latest = latest_month_check(monthly, limits.latest_month_ratio)
    dups = duplicate_metrics(df, contract.id_cols)
    imbalance = F.when(minority < limits.imbalance_critical, "CLASS_IMBALANCE_CRITICAL").otherwise(
        "CLASS_IMBALANCE_WARNING"
    )
    return union_findings(
        [
            _row(facts, "MISSING_TARGET", "warning", n("label_null") > 0, n("label_null"), 0),
            _row(facts, "INVALID_TARGET_VALUES", "warning", n("label_invalid") > 0, n("label_invalid"), 0),
            _row(dups, "DUPLICATE_ID", "warning", n("duplicate_key_count") > 0, n("duplicate_key_count"), 0),
            _row(facts, "ALL_NULL_FEATURES", "warning", empty_count > 0, empty_count, 0, n("empty_features")),
            _row(facts, "HIGH_MISSING_ROWS", "warning", n("sparse_rows") > 0, n("sparse_rows"), limits.high_missing_row_rate),
            _row(facts, imbalance, "warning", minority < limits.imbalance_warning, minority, limits.imbalance_warning),
            _row(gaps, "MISSING_MONTHS", "warning", n("gaps") > 0, n("gaps"), 0, n("months")),
            _row(change, "MONTHLY_BAD_RATE_SHIFT", "warning", n("change") >= limits.bad_rate_change, n("change"), limits.bad_rate_change, n("month")),
            _row(latest, "LATEST_MONTH_INCOMPLETE", "warning", n("incomplete"), n("latest_sample_count"), limits.latest_month_ratio, n("latest_month")),
        ]
    )


def first_per_id(df: DataFrame, id_cols: Sequence[str], order_by: Sequence[str], keep: str = "first") -> DataFrame:
    """Keep one row per ID by an explicit order (a Spark table has no row order); rows that
    tie on it are told apart by a hash of their other columns, so the choice is repeatable.

    The kept row is a map-side combinable minimum, so an ID that holds a large part
    of the table shrinks to one row per task before it is shuffled.
    """
    if keep not in {"first", "last"}:
        raise ValueError("keep must be 'first' or 'last'")
    if not order_by:
        raise ValueError("order_by is required")
    rest = [c for c in df.columns if c not in id_cols]
    pick = F.min_by if keep == "first" else F.max_by
    kept = df.groupBy(*id_cols).agg(pick(F.struct(*rest), F.struct(*order_by, F.xxhash64(*rest).alias("__tie"))).alias("__row"))
    return kept.select(*[F.col(c) if c in id_cols else F.col(f"__row.{c}").alias(c) for c in df.columns])


def apply_treatment(
    df: DataFrame,
    contract: RiskContract,
    order_by: Sequence[str],
    treatment: Treatment | None = None,
    limits: DiagnosticLimits | None = None,
) -> TreatmentResult:
    """Drop null labels, duplicates, empty features, sparse rows and an incomplete
    latest month, in this order, and count what each step removed."""
    treatment, limits = treatment or Treatment(), limits or DiagnosticLimits()
    target = F.col(contract.target_col)
    labelled = df.where(target.isNotNull())
    deduped = stage(first_per_id(labelled, contract.id_cols, order_by, treatment.keep))
    before = df.agg(F.count("*").alias("rows"), F.count(target).alias("labelled")).first()

    features = contract.feature_cols(df)
    filled = deduped.agg(F.count("*").alias("rows"), *[F.count(c).alias(f"c{i}") for i, c in enumerate(features)]).first()
    empty = tuple(c for i, c in enumerate(features) if filled[f"c{i}"] == 0)
    result = deduped.drop(*empty)
    kept = [c for c in features if c not in empty]

    sparse = 0
    if kept and treatment.high_missing_rows == "drop":
        dense = null_count(kept) / F.lit(float(len(kept))) < limits.high_missing_row_rate
        sparse = result.where(~dense).count()
        result = result.where(dense)

    latest = latest_month_check(monthly_target_summary(result, contract), limits.latest_month_ratio).first()
    cut, month = 0, None
    if latest.incomplete and treatment.incomplete_latest_month != "keep":
        month, cut = latest.latest_month, int(latest.latest_sample_count)
        current = event_month(result, contract)
        result = result.where(current.isNull() | (current != month))
    return TreatmentResult(
        data=result,
        removed_missing_target=before.rows - before.labelled,
        removed_duplicates=before.labelled - filled.rows,
        removed_features=empty,
        removed_high_missing_rows=sparse,
        removed_incomplete_month=cut,
        excluded_month=month,
    )


def risk_table(
    overview: DataFrame,
    psi_summary: DataFrame,
    findings: DataFrame,
    balance: DataFrame,
    limits: DiagnosticLimits | None = None,
) -> DataFrame:
    """Hand-off checks before modelling, each with a value and pass / hint / warn."""
    limits = limits or DiagnosticLimits()
    quality = overview.agg(
        F.avg((F.col("iv") >= limits.iv_weak).cast("double")).alias("iv_pass_ratio"),
        F.avg((F.col("missing_rate") <= limits.max_missing_rate).cast("double")).alias("missing_pass_ratio"),
    )
    drift = psi_summary.agg(
        F.avg((F.col("max_psi") < limits.psi_warning).cast("double")).alias("psi_effective_ratio"),
        F.avg((F.col("max_psi") < limits.psi_stable).cast("double")).alias("psi_stable_ratio"),
    )
    codes = findings.agg(
        F.coalesce(F.sum(F.when(F.col("code").isin("DUPLICATE_ID", "MISSING_TARGET"), F.col("value"))), F.lit(0.0)).alias("label_key_issues"),
        F.count_if(F.col("code").startswith("CLASS_IMBALANCE")).alias("imbalance"),
        F.count_if(F.col("code").isin("MISSING_MONTHS", "MONTHLY_BAD_RATE_SHIFT", "LATEST_MONTH_INCOMPLETE")).alias("month_issues"),
    )
    one = quality.crossJoin(drift).crossJoin(codes).crossJoin(  # one row each
        balance.select(ratio(F.col("bad_count"), F.col("labeled_sample_count")).alias("bad_rate"), "minority_rate")
    )

    def by_ratio(c: str) -> Column:
        full = limits.feature_pass_ratio
        return F.when(F.col(c) >= full, "pass").when(F.col(c) >= full / 2, "hint").when(F.col(c).isNotNull(), "warn").otherwise("hint")

    bad_rate = F.col("bad_rate")
    rate_status = F.when(bad_rate.between(limits.bad_rate_min, limits.bad_rate_max), "pass").when(bad_rate.isNotNull(), "warn").otherwise("hint")
    checks = [
        ("label_and_key_quality", F.col("label_key_issues"), F.when(F.col("label_key_issues") == 0, "pass").otherwise("warn")),
        ("overall_bad_rate", bad_rate, rate_status),
        ("iv_pass_ratio", F.col("iv_pass_ratio"), by_ratio("iv_pass_ratio")),
        ("psi_effective_ratio", F.col("psi_effective_ratio"), by_ratio("psi_effective_ratio")),
        ("psi_stable_ratio", F.col("psi_stable_ratio"), by_ratio("psi_stable_ratio")),
        ("missing_pass_ratio", F.col("missing_pass_ratio"), by_ratio("missing_pass_ratio")),
        ("class_balance", F.col("minority_rate"), F.when(F.col("imbalance") > 0, "warn").otherwise("pass")),
        ("month_completeness", F.col("month_issues").cast("double"), F.when(F.col("month_issues") > 0, "warn").otherwise("pass")),
    ]
    cells = [F.struct(F.lit(c).alias("check_item"), v.cast("double").alias("value"), s.alias("status")) for c, v, s in checks]
    return one.select(F.inline(F.array(*cells)))


def small_months(monthly: DataFrame, min_ratio: float = 0.30) -> DataFrame:
    """Months far below the median month, and months without any bad sample."""
    typical = monthly.agg(F.percentile("sample_count", 0.5).alias("median_sample_count"))
    return monthly.crossJoin(typical).select(  # typical has one row
        "event_month",
        "sample_count",
        "bad_count",
        "median_sample_count",
        (F.col("sample_count") < min_ratio * F.col("median_sample_count")).alias("is_small"),
        (F.col("bad_count") == 0).alias("has_no_bad"),
    ).where("is_small or has_no_bad")


def ks_volatility(monthly_metrics: DataFrame, limit: float = 0.10) -> DataFrame:
    """Mean and population deviation of the monthly KS per feature (two months up)."""
    return (
        monthly_metrics.where("ks is not null")
        .groupBy("feature")
        .agg(
            F.count("*").alias("month_count"),
            F.avg("ks").alias("monthly_ks_mean"),
            F.stddev_pop("ks").alias("monthly_ks_std"),
        )
        .where("month_count >= 2")
        .withColumn("is_volatile", F.col("monthly_ks_std") >= limit)
    )


def evidence_findings(
    overview: DataFrame,
    monthly: DataFrame,
    psi_summary: DataFrame,
    pairs: DataFrame,
    monthly_metrics: DataFrame,
    duplicate_keys: int = 0,
    missing_labels: int = 0,
) -> DataFrame:
    """Findings from the metric tables, most severe first, with the overall status."""
    counts = overview.agg(
        F.count_if(F.col("iv") < 0.02).alias("low_iv"),
        F.count_if(F.col("iv") >= 0.50).alias("high_iv"),
        F.count_if(F.col("missing_rate") >= 0.80).alias("very_missing"),
        F.count_if(F.col("missing_rate") >= 0.50).alias("missing"),
        F.lit(duplicate_keys).alias("dups"),
        F.lit(missing_labels).alias("unlabelled"),
    )
    drift = psi_summary.agg(F.count_if(F.col("max_psi") >= 0.25).alias("n"))
    twins = pairs.agg(F.count_if(F.col("abs_correlation") >= 0.70).alias("n"))
    months = small_months(monthly).agg(F.count_if("is_small").alias("small"), F.count_if("has_no_bad").alias("no_bad"))
    volatile = ks_volatility(monthly_metrics).agg(F.count_if("is_volatile").alias("n"))
    n = F.col
    rows = union_findings(
        [
            _row(counts, "MISSING_LABELS", "blocker", n("unlabelled") > 0, n("unlabelled"), 0),
            _row(counts, "DUPLICATE_KEYS", "warning", n("dups") > 0, n("dups"), 0),
            _row(counts, "WEAK_FEATURES", "warning", n("low_iv") > 0, n("low_iv"), 0.02),
            _row(counts, "SUSPECTED_LEAKAGE", "warning", n("high_iv") > 0, n("high_iv"), 0.50),
            _row(counts, "HIGH_MISSING_FEATURES", "warning", n("very_missing") > 0, n("very_missing"), 0.80),
            _row(counts, "RAISED_MISSING_FEATURES", "info", (n("very_missing") == 0) & (n("missing") > 0), n("missing"), 0.50),
            _row(drift, "HIGH_PSI_FEATURES", "warning", n("n") > 0, n("n"), 0.25),
            _row(twins, "CORRELATED_PAIRS", "info", n("n") > 0, n("n"), 0.70),
            _row(months, "SMALL_MONTHS", "warning", n("small") > 0, n("small"), 0.30),
            _row(months, "MONTHS_WITHOUT_BAD", "warning", n("no_bad") > 0, n("no_bad"), 0),
            _row(volatile, "VOLATILE_MONTHLY_KS", "warning", n("n") > 0, n("n"), 0.10),
        ]
    )
    return with_status(rows, {"blocker": "blocker", "warning": "warning", "info": "warning"}, "normal")


def with_status(findings: DataFrame, names: dict[str, str], default: str) -> DataFrame:
    """Add a severity rank and the overall status (findings are few rows)."""
    rank = F.when(F.col("severity") == "blocker", 0).when(F.col("severity") == "warning", 1).otherwise(2)
    worst = F.min("severity_rank").over(Window.partitionBy())
    status = (
        F.when(worst == 0, names["blocker"]).when(worst == 1, names["warning"]).when(worst == 2, names["info"]).otherwise(default)
    )
    return findings.withColumn("severity_rank", rank).withColumn("status", status)


def preflight_findings(
    df: DataFrame, contract: RiskContract, profile: DataFrame, oot_months: int = 2
) -> DataFrame:
    """Enough bad samples overall and in the last months? Columns mostly missing?"""
    facts = stage(
        df.agg(
            F.count("*").alias("rows"),
            F.count_if(F.col(contract.target_col) == F.lit(contract.bad_label)).alias("bad"),
        )
    )
    monthly = monthly_target_summary(df, contract)
    place = F.row_number().over(Window.orderBy(F.desc("event_month")))  # months-sized
    months = F.count("*").over(Window.partitionBy())
    recent = (
        monthly.select("event_month", "bad_count", place.alias("place"), months.alias("months"))
        .where((F.col("place") <= oot_months) & (F.col("months") > oot_months))
        .agg(F.sum("bad_count").alias("bad"), F.array_join(F.sort_array(F.collect_list("event_month")), ",").alias("months"))
    )
    sparse = profile.where("missing_rate > 0.8").agg(
        F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("column_name")), ",").alias("columns")
    )
    n = F.col
    return union_findings(
        [
            _row(facts, "EMPTY_DATASET", "blocker", n("rows") == 0, n("rows"), 0),
            _row(facts, "TOTAL_BAD_COUNT_CRITICAL", "blocker", (n("rows") > 0) & (n("bad") < 30), n("bad"), 30),
            _row(facts, "TOTAL_BAD_COUNT_LOW", "warning", n("bad").between(30, 99), n("bad"), 100),
            _row(recent, "OOT_BAD_COUNT_CRITICAL", "blocker", n("bad") < 10, n("bad"), 10, n("months")),
            _row(recent, "OOT_BAD_COUNT_LOW", "warning", n("bad").between(10, 29), n("bad"), 30, n("months")),
            _row(sparse, "HIGH_MISSING_COLUMNS", "warning", n("n") > 0, n("n"), 0.8, n("columns")),
        ]
    )


def reliability(bad: Column, total: Column) -> Column:
    """How far metrics of a group of this size can be trusted."""
    smaller = F.least(bad, total - bad)
    return F.when(smaller < 10, "insufficient").when(smaller < 30, "directional").otherwise("usable")
