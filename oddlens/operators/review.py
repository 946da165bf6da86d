"""Rule tables over metric frames: model review, trial choice, guardrails, bounds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oddlens.functions.columns import ratio
from oddlens.operators.binning import local_frame

# Thresholds of the model review.
AUC_GAP = (0.08, 0.15)
KS_GAP = (0.08, 0.15)
LOW_AUC = (0.60, 0.55)
LOW_KS = 0.15
OOT_DROP = (0.05, 0.10)
SCORE_PSI = (0.10, 0.25)
MIN_OOT_BAD = 10
EARLY_STOP = 10
GAP_RANGE = 0.10
TOP_GAIN_SHARE = 0.5
MONTH_SPREAD = {"auc": 0.10, "ks": 0.10, "bad_rate": 0.05}
MIN_MONTH_SAMPLES = 30
MIN_MONTH_BAD = 10

# Per category of our finding codes: its priority (a fixed value) and where to look.
ACTIONS = {
    "overfit": ("first", "compare train and test by feature; shrink trees until the gaps are within their limits"),
    "underfit": ("first", "check which screening rule removed the strongest features before growing the model"),
    "oot": ("first", "compare month by month where AUC falls; keep these months out of tuning"),
    "drift": ("first", "list features by PSI and follow the largest to its source"),
    "lift": ("then", "count bads per bucket; join buckets that hold too few to be ordered"),
    "importance": ("then", "refit without the leading feature and compare"),
    "monthly": ("then", "set small months aside and see whether the spread remains"),
}

# Default acceptance limits of a tuned candidate.
GUARDRAILS = {
    "max_train_validate_ks_gap": 0.10,
    "min_gap_reduction": 0.02,
    "max_validate_ks_regression": 0.005,
    "max_oot_ks_regression": 0.01,
    "max_validate_oot_ks_drop": 0.08,
    "max_oot_degradation_vs_baseline": 0.03,
    "min_oot_bad_count": 30,
}
TARGETS = {"validate_ks": 0.30, "validate_auc": 0.75, "oot_ks": 0.25, "oot_auc": 0.70}
TARGET_TOLERANCE = 0.01
REJECTED = ("skipped", "failed", "pruned", "rejected_bounds", "rejected_metric", "rejected_degenerate", "stopped_timeout")

# Default search bounds of the booster parameters.
BOUNDS = {
    "learning_rate": (0.01, 0.08),
    "num_leaves": (7, 63),
    "max_depth": (3, 8),
    "min_data_in_leaf": (30, 300),
    "feature_fraction": (0.6, 1.0),
    "bagging_fraction": (0.6, 1.0),
    "bagging_freq": (1, 10),
    "lambda_l1": (0.0001, 20.0),
    "lambda_l2": (0.0001, 20.0),
    "min_gain_to_split": (0.0, 1.0),
}
WHOLE_NUMBERS = ("num_leaves", "max_depth", "min_data_in_leaf", "bagging_freq")


def _level(value: Column, limits: tuple[float, float]) -> Column:
    warning, blocker = limits
    return F.when(value >= blocker, "blocker").when(value >= warning, "warning")


def _found(source: DataFrame, code: Column | str, severity: Column | str, category: str, value: Column, dataset=None) -> DataFrame:
    level = severity if isinstance(severity, Column) else F.lit(severity)
    return source.select(
        (code if isinstance(code, Column) else F.lit(code)).alias("code"),
        level.alias("severity"),
        F.lit(category).alias("category"),
        (F.lit(None).cast("string") if dataset is None else dataset).alias("dataset"),
        value.cast("double").alias("value"),
    ).where("severity is not null")


def _wide(metrics: DataFrame) -> DataFrame:
    """One row with ``<dataset>_<metric>`` columns (metrics has one row per split)."""
    aggs = []
    for d in ("train", "test", "oot"):
        for m in ("auc", "ks", "bad_count", "score_psi_vs_train"):
            aggs.append(F.max(F.when(F.col("dataset") == d, F.col(m))).alias(f"{d}_{m}"))
        aggs.append(F.count_if(F.col("dataset") == d).alias(f"{d}_rows"))
    return metrics.agg(*aggs)


def lift_findings(lift: DataFrame) -> DataFrame:
    """Splits whose bad rate rises too often from bucket to bucket, or whose top
    bucket is below average. Needs five buckets."""
    per = Window.partitionBy("dataset").orderBy("bucket")  # bucket-sized
    steps = lift.where("bad_rate is not null").withColumn("next_rate", F.lead("bad_rate").over(per))
    summary = steps.groupBy("dataset").agg(
        F.count("*").alias("bucket_count"),
        F.count_if(F.col("next_rate") > F.col("bad_rate")).alias("violations"),
        F.min_by("lift", "bucket").alias("top_lift"),
    )
    allowed = F.greatest(F.lit(1), F.floor((F.col("bucket_count") - 1) * F.lit(0.30)))
    return summary.withColumn("allowed", allowed).where(
        (F.col("bucket_count") >= 5)
        & ((F.col("violations") > F.col("allowed")) | F.coalesce(F.col("top_lift") < 1.0, F.lit(False)))
    )


def monthly_spread(monthly: DataFrame) -> DataFrame:
    """First metric per split, in the order auc, ks, bad_rate, that moves too much
    between months with enough samples (three months needed)."""
    usable = monthly.where(
        (F.col("sample_count") >= MIN_MONTH_SAMPLES) & (F.col("bad_count") >= MIN_MONTH_BAD)
    )
    names = list(MONTH_SPREAD)
    cells = [x for i, m in enumerate(names) for x in (F.lit(i), F.lit(m), F.col(m).cast("double"), F.lit(MONTH_SPREAD[m]))]
    return (
        usable.select("dataset", F.stack(F.lit(len(names)), *cells).alias("place", "metric", "value", "threshold"))
        .where("value is not null")
        .groupBy("dataset", "place", "metric", "threshold")
        .agg(F.count("*").alias("month_count"), F.min("value").alias("min"), F.max("value").alias("max"))
        .withColumn("spread", F.col("max") - F.col("min"))
        .where("month_count >= 3 and spread >= threshold")
        .withColumn("first", F.min("place").over(Window.partitionBy("dataset")))
        .where("place = first")
        .select("dataset", "metric", "month_count", "min", "max", "spread")
    )


def model_review(
    metrics: DataFrame,
    best_iteration: int,
    importance: DataFrame | None = None,
    history: DataFrame | None = None,
    lift: DataFrame | None = None,
    monthly: DataFrame | None = None,
) -> DataFrame:
    """Findings of a trained model: code, severity, category, split, value, status.

    All inputs are split-, bucket-, month- or feature-sized.
    """
    w = _wide(metrics)
    c = F.col
    auc_gap, ks_gap = c("train_auc") - c("test_auc"), c("train_ks") - c("test_ks")
    auc_level, ks_level = _level(auc_gap, AUC_GAP), _level(ks_gap, KS_GAP)
    known = c("train_auc").isNotNull() & c("test_auc").isNotNull() & c("train_ks").isNotNull() & c("test_ks").isNotNull()
    under_critical = known & (F.greatest("train_auc", "test_auc") < LOW_AUC[1])
    under_warning = known & ((F.greatest("train_auc", "test_auc") < LOW_AUC[0]) | (F.greatest("train_ks", "test_ks") < LOW_KS))
    under = F.when(under_critical, "blocker").when(under_warning, "warning")
    parts = [
        _found(w, F.when(auc_level == "blocker", "TRAIN_TEST_AUC_GAP_CRITICAL").otherwise("TRAIN_TEST_AUC_GAP_HIGH"), auc_level, "overfit", auc_gap),
        _found(w, F.when(ks_level == "blocker", "TRAIN_TEST_KS_GAP_CRITICAL").otherwise("TRAIN_TEST_KS_GAP_HIGH"), ks_level, "overfit", ks_gap),
        _found(w, F.when(under == "blocker", "MODEL_UNDERFIT_CRITICAL").otherwise("MODEL_UNDERFIT_WARNING"), under, "underfit", c("test_auc")),
        _found(w, "OOT_AUC_DROP", _level(c("test_auc") - c("oot_auc"), OOT_DROP), "oot", c("test_auc") - c("oot_auc"), F.lit("oot")),
        _found(w, "OOT_KS_DROP", _level(c("test_ks") - c("oot_ks"), OOT_DROP), "oot", c("test_ks") - c("oot_ks"), F.lit("oot")),
        _found(w, "OOT_EVALUATION_UNSUPPORTED", F.when((c("oot_rows") > 0) & (F.coalesce("oot_bad_count", F.lit(0)) < MIN_OOT_BAD), "blocker"), "oot", F.coalesce("oot_bad_count", F.lit(0)), F.lit("oot")),
        *[
            _found(w, f"{d.upper()}_SCORE_PSI_HIGH", _level(c(f"{d}_score_psi_vs_train"), SCORE_PSI), "drift", c(f"{d}_score_psi_vs_train"), F.lit(d))
            for d in ("test", "oot")
        ],
    ]
    if best_iteration <= EARLY_STOP:
        parts.append(_found(w, "EARLY_STOP_TOO_EARLY", "warning", "overfit", F.lit(best_iteration)))
    if history is not None:
        gap = history.agg((F.max(c("train_auc") - c("test_auc")) - F.min(c("train_auc") - c("test_auc"))).alias("range"))
        parts.append(_found(gap, "TRAINING_GAP_WIDENS", F.when(c("range") >= GAP_RANGE, "warning"), "overfit", c("range")))
    if importance is not None:
        share = importance.agg(ratio(F.max("gain_importance"), F.sum("gain_importance")).alias("share"))
        parts.append(_found(share, "FEATURE_IMPORTANCE_CONCENTRATED", F.when(c("share") > TOP_GAIN_SHARE, "warning"), "importance", c("share")))
    if lift is not None:
        parts.append(_found(lift_findings(lift), "LIFT_ORDERING_WEAK", "warning", "lift", c("violations"), c("dataset")))
    if monthly is not None:
        parts.append(_found(monthly_spread(monthly), "MONTHLY_PERFORMANCE_UNSTABLE", "warning", "monthly", c("spread"), c("dataset")))
    findings = reduce(DataFrame.unionByName, parts)
    every = Window.partitionBy()  # findings-sized
    blocked = F.max((c("severity") == "blocker").cast("int")).over(every)
    return findings.withColumn("status", F.when(blocked == 1, "blocked").otherwise("needs_review"))


def recommendations(findings: DataFrame) -> DataFrame:
    """One action per finding category with the codes that ask for it."""
    table = local_frame(
        findings,
        pd.DataFrame([(i, k, p, a) for i, (k, (p, a)) in enumerate(ACTIONS.items())], columns=["place", "category", "priority", "action"]),
    )
    return (
        findings.groupBy("category")
        .agg(F.array_join(F.array_sort(F.collect_set("code")), ",").alias("source_codes"))
        .join(table, "category")
        .select("place", "priority", "category", "source_codes", "action")
    )


def quality_score(train_ks: Column, validate_ks: Column, oot_ks: Column, oot_psi: Column) -> Column:
    """Weighted KS minus gap, floor and drift penalties, clamped to [0, 1]."""
    weighted = 0.25 * train_ks + 0.30 * validate_ks + 0.45 * oot_ks
    gaps = 0.25 * F.abs(train_ks - validate_ks) + 0.35 * F.abs(validate_ks - oot_ks)
    floor = 0.20 * F.greatest(F.lit(0.0), 0.20 - oot_ks)
    drift = 0.05 * F.greatest(F.lit(0.0), F.coalesce(oot_psi, F.lit(0.0)) - 0.25)
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), weighted - gaps - floor - drift))
    return F.when(train_ks.isNotNull() & validate_ks.isNotNull() & oot_ks.isNotNull(), score)


def is_degenerate(validate_auc: Column, validate_ks: Column, distinct_scores: Column) -> Column:
    """No usable ranking: a single score, or the old tie error (AUC .5 with KS 1)."""
    tie_error = (F.abs(validate_auc - 0.5) < 1e-9) & (validate_ks >= 0.99)
    return F.coalesce(distinct_scores <= 1, F.lit(False)) | F.coalesce(tie_error, F.lit(False))


def score_spread(df: DataFrame, score: str, keys: Sequence[str] = ("dataset",)) -> DataFrame:
    """Distinct scores (12 decimals) per key; per-value groups come first, so the
    distinct count is spread over tasks."""
    values = df.select(*keys, F.round(score, 12).alias("__s")).groupBy(*keys, "__s").agg(F.count("*").alias("n"))
    return values.groupBy(*keys).agg(
        F.count("__s").alias("score_unique_count"), (F.count("__s") <= 1).alias("is_degenerate")
    )


def best_trial(trials: DataFrame) -> DataFrame:
    """Best row of a trial table: selectable, best quality, else best validation KS.

    Expects ``trial, status, train_ks, validate_ks, oot_ks, oot_psi, validate_auc,
    score_unique_count``.
    """
    c = F.col
    scored = trials.where("validate_ks is not null").withColumns(
        {
            "quality_score": quality_score(c("train_ks"), c("validate_ks"), c("oot_ks"), c("oot_psi")),
            "degenerate": is_degenerate(c("validate_auc"), c("validate_ks"), c("score_unique_count")),
            "rejected": F.coalesce(c("status").isin(*REJECTED), F.lit(False)),
        }
    )
    # Preference order replaces the fallbacks: usable, then any not degenerate, then any.
    tier = F.when(~c("degenerate") & ~c("rejected"), 0).when(~c("degenerate"), 1).otherwise(2)
    return scored.orderBy(
        tier, F.desc_nulls_last("quality_score"), F.desc("validate_ks"), "trial"
    ).limit(1)


def trial_table(
    folds: DataFrame, metric: str = "ks", gap_penalty: float = 0.5, std_penalty: float = 0.25
) -> DataFrame:
    """Fold means, gaps and spread per trial, with the penalised objective."""
    means = folds.groupBy("trial").agg(
        F.count("*").alias("folds"),
        *[F.avg(f"{s}_{m}").alias(f"mean_{s}_{m}") for s in ("train", "validation") for m in ("auc", "ks")],
        F.stddev_pop("validation_auc").alias("fold_auc_std"),
        F.stddev_pop("validation_ks").alias("fold_ks_std"),
        F.round(F.avg("best_iteration"), 2).alias("mean_best_iteration"),
        F.min("best_iteration").alias("min_best_iteration"),
        F.max("best_iteration").alias("max_best_iteration"),
    )
    table = means.withColumns(
        {f"{m}_gap": F.col(f"mean_train_{m}") - F.col(f"mean_validation_{m}") for m in ("auc", "ks")}
    )
    score = (
        F.col(f"mean_validation_{metric}")
        - gap_penalty * F.greatest(F.lit(0.0), F.col(f"{metric}_gap"))
        - std_penalty * F.col(f"fold_{metric}_std")
    )
    return table.withColumn("score", score)


def candidate_comparison(candidates: DataFrame, metric: str = "ks", min_improvement: float = 0.0) -> DataFrame:
    """Each candidate against the baseline row; the best accepted one is selected."""
    c = F.col
    every = Window.partitionBy()  # candidates-sized
    is_base = c("candidate") == "baseline"

    def versus(name: str) -> Column:
        base = F.max(F.when(is_base, c(name))).over(every)
        return F.when(is_base, F.lit(0.0)).otherwise(c(name) - base)

    table = candidates.withColumns(
        {
            "auc_gap": c("train_auc") - c("test_auc"),
            "improvement_vs_baseline": versus(f"test_{metric}"),
            "oot_improvement_vs_baseline": versus("oot_ks"),
        }
    ).withColumn("accepted", F.coalesce(~is_base & (c("improvement_vs_baseline") >= min_improvement), F.lit(False)))
    order = Window.orderBy(F.desc(c("accepted").cast("int")), F.desc(f"test_{metric}"), "candidate")
    best_accepted = F.row_number().over(order) == 1
    any_accepted = F.max(c("accepted").cast("int")).over(every) == 1
    return table.withColumn("selected_candidate", F.when(any_accepted, best_accepted).otherwise(is_base))


def guardrail_checks(candidates: DataFrame, limits: Mapping[str, float] | None = None) -> DataFrame:
    """Rejection reasons per candidate against the baseline row.

    Out-of-time rules apply only with enough out-of-time bad samples. A gap that is
    too wide is forgiven when the candidate narrows it enough at little cost.
    """
    g = {**GUARDRAILS, **(limits or {})}
    c = F.col
    every = Window.partitionBy()  # candidates-sized
    is_base = c("candidate") == "baseline"
    gap = c("train_ks") - c("test_ks")
    base = {m: F.max(F.when(is_base, c(m))).over(every) for m in ("train_ks", "test_ks", "oot_ks")}
    narrowed = (base["train_ks"] - base["test_ks"]) - gap
    small_loss = (c("test_ks") - base["test_ks"] >= -g["max_validate_ks_regression"]) & F.coalesce(
        c("oot_ks") - base["oot_ks"] >= -g["max_oot_ks_regression"], F.lit(True)
    )
    forgiven = ~is_base & (narrowed >= g["min_gap_reduction"]) & small_loss
    oot_ok = c("oot_bad_count") >= g["min_oot_bad_count"]
    table = candidates.withColumns(
        {
            "train_validate_gap": gap,
            "gap_forgiven": F.coalesce(forgiven, F.lit(False)),
            "validate_oot_drop": c("test_ks") - c("oot_ks"),
            "oot_degradation": F.when(~is_base, base["oot_ks"] - c("oot_ks")),
        }
    )
    reasons = F.concat_ws(
        ",",
        F.when((c("train_validate_gap") > g["max_train_validate_ks_gap"]) & ~c("gap_forgiven"), "train_validate_gap"),
        F.when(oot_ok & (c("validate_oot_drop") > g["max_validate_oot_ks_drop"]), "validate_oot_drop"),
        F.when(oot_ok & (c("oot_degradation") > g["max_oot_degradation_vs_baseline"]), "oot_degradation"),
    )
    return table.withColumn("reasons", reasons).withColumn("passed", c("reasons") == "")


def target_check(
    candidates: DataFrame, targets: Mapping[str, float] | None = None, tolerance: float = TARGET_TOLERANCE,
    min_oot_bad: int = 30,
) -> DataFrame:
    """Are the validation (and, with enough bads, out-of-time) targets met or close?"""
    t = {**TARGETS, **(targets or {})}
    c = F.col
    oot_counts = c("oot_bad_count") >= min_oot_bad
    checks = {"validate_ks": c("test_ks"), "validate_auc": c("test_auc"), "oot_ks": c("oot_ks"), "oot_auc": c("oot_auc")}

    def every(slack: float) -> Column:
        parts = []
        for name, value in checks.items():
            met = F.coalesce(value >= t[name] - slack, F.lit(False))
            parts.append(met if name.startswith("validate") else (met | ~oot_counts))
        return reduce(lambda a, b: a & b, parts)

    missed = F.concat_ws(
        ",",
        *[
            F.when((F.lit(True) if n.startswith("validate") else oot_counts) & ~F.coalesce(v >= t[n], F.lit(False)), n)
            for n, v in checks.items()
        ],
    )
    return candidates.select(
        "candidate",
        every(0.0).alias("target_met"),
        every(tolerance).alias("target_close"),
        oot_counts.alias("oot_counted"),
        missed.alias("missed"),
    )


def bounds_check(proposals: DataFrame, bounds: Mapping[str, tuple[float, float]] | None = None) -> DataFrame:
    """Reject proposals with unknown, fractional or out-of-range parameters, or more
    leaves than the depth allows. Values are never clamped.

    ``proposals`` is ``(proposal, name, value)``.
    """
    limits = bounds or BOUNDS
    table = local_frame(
        proposals,
        pd.DataFrame([(n, float(a), float(b), n in WHOLE_NUMBERS) for n, (a, b) in limits.items()], columns=["name", "low", "high", "whole"]),
    )
    c = F.col
    checked = proposals.join(table, "name", "left")
    problem = (
        F.when(c("low").isNull(), "unknown")
        .when(c("whole") & (c("value") != F.floor("value")), "not_integer")
        .when(~c("value").between(c("low"), c("high")), "out_of_bounds")
    )
    per = checked.withColumn("problem", problem).groupBy("proposal").agg(
        F.array_join(F.array_sort(F.collect_list(F.when(c("problem").isNotNull(), F.concat_ws(":", "name", "problem")))), ",").alias("reasons"),
        F.max(F.when(c("name") == "num_leaves", c("value"))).alias("leaves"),
        F.max(F.when(c("name") == "max_depth", c("value"))).alias("depth"),
    )
    too_many = F.coalesce((c("depth") > 0) & (c("leaves") > F.pow(F.lit(2.0), c("depth"))), F.lit(False))
    reasons = F.concat_ws(",", F.when(c("reasons") != "", c("reasons")), F.when(too_many, "num_leaves:above_depth"))
    return per.select("proposal", reasons.alias("reasons"), (reasons == "").alias("accepted"))


def gain_shares(importance: DataFrame) -> DataFrame:
    """Share and running share of the gain, largest first (feature-sized)."""
    every = Window.partitionBy()
    run = every.orderBy(F.desc("gain_importance"), "feature").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("gain_importance").over(every)
    return importance.withColumns(
        {
            "gain_share": F.coalesce(ratio(F.col("gain_importance"), total), F.lit(0.0)),
            "cumulative_gain_share": F.coalesce(ratio(F.sum("gain_importance").over(run), total), F.lit(0.0)),
        }
    )
