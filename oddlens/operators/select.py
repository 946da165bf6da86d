"""Feature selection on the train split, and screening across splits."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddlens.functions.columns import numeric_columns
from oddlens.operators.binning import bin_counts, bin_detail, bin_summary, fit_bins, local_frame, ranked_values
from oddlens.operators.correlation import both_directions, correlation_pairs, filled_pairs, max_correlation
from oddlens.operators.counts import split_types
from oddlens.operators.discrimination import rank_metrics
from oddlens.operators.profile import dominant_values
from oddlens.operators.stability import monthly_psi, monthly_sample, split_psi, stability_summary
from oddlens.sources.stages import stage


@dataclass(frozen=True)
class SelectionRules:
    """Limits of the train-only selection. Fixed values where the rule set has them."""

    min_iv: float = 0.02
    max_missing: float = 0.80
    max_correlation: float = 0.80
    max_psi: float = 0.25
    max_unstable_ratio: float = 0.30
    min_month_samples: int = 100
    stability_action: str = "review"
    max_dominant: float = 0.95
    correlation_method: str = "spearman"
    bins: int = 10


def base_decisions(metrics: DataFrame, rules: SelectionRules) -> DataFrame:
    """Rules in order: constant, missing, weak, unstable. Others stay candidates."""
    unstable = (F.col("max_monthly_psi") > rules.max_psi) & (F.col("unstable_month_ratio") > rules.max_unstable_ratio)
    decision = (
        F.when(F.col("unique_count") <= 1, "excluded_constant")
        .when(F.col("missing_rate") > rules.max_missing, "excluded_missing")
        .when(F.col("iv") < rules.min_iv, "excluded_low_iv")
        .when(unstable & F.lit(rules.stability_action == "drop"), "excluded_unstable")
        .otherwise("candidate")
    )
    return metrics.withColumns({"unstable": unstable, "decision": decision})


def prune_correlated(metrics: DataFrame, pairs: DataFrame, limit: float) -> dict[str, str]:
    """Greedy pruning of candidates: stable and strong features are kept first, and a
    feature goes when a kept one correlates above the limit. Returns who replaced it.

    The pairs stay in Spark; the driver holds one entry for each feature. In each round
    the features without an open pair to an earlier one stay, and those that pair with
    them go, until no pair is open. That is what a walk in order would keep.
    """
    candidates = metrics.where("decision = 'candidate'")
    order = candidates.orderBy("unstable", F.desc("iv"), "missing_rate", "feature").select("feature")
    names = [r.feature for r in order.collect()]

    def places(chosen: Iterable[int]) -> DataFrame:
        numbers = np.array(sorted(chosen), np.int64)
        return local_frame(metrics, pa.table({"place": numbers, "feature": pa.array([names[k] for k in numbers], pa.string())}))

    every = places(range(len(names)))
    strong = both_directions(pairs.where(F.col("abs_correlation") > limit))
    placed = strong.join(every.withColumnRenamed("place", "late"), "feature").join(
        every.select(F.col("place").alias("early"), F.col("feature").alias("other")), "other"
    )
    edges = stage(placed.where("early < late").select("early", "late").distinct())
    undecided, kept, gone, left = set(range(len(names))), set(), set(), edges
    while undecided:
        waiting = {r.late for r in left.select("late").distinct().collect()}
        free = undecided - waiting
        kept |= free
        undecided &= waiting
        if not undecided:
            break
        beaten = left.join(places(free).select(F.col("place").alias("early")), "early", "left_semi")
        lost = {r.late for r in beaten.select("late").distinct().collect()}
        gone |= lost
        undecided -= lost
        still = places(undecided).select("place")
        for end in ("early", "late"):
            left = left.join(still.withColumnRenamed("place", end), end, "left_semi")
        left = stage(left)
    if not gone:
        return {}
    rivals = edges.join(places(kept).select(F.col("place").alias("early")), "early", "left_semi")
    first = rivals.join(places(gone).select(F.col("place").alias("late")), "late", "left_semi").groupBy("late").agg(F.min("early").alias("early"))
    return {names[r.late]: names[r.early] for r in first.orderBy("late").collect()}


def selection_metrics(
    train: DataFrame, features: Sequence[str], bad: Column, rules: SelectionRules | None = None,
    month: str = "event_month",
) -> DataFrame:
    """IV, missing rate, distinct count, dominant rate and monthly stability."""
    rules = rules or SelectionRules()
    bins = fit_bins(train, features, rules.bins)
    summary = bin_summary(bin_detail(stage(bin_counts(train, bins, bad)))).select("feature", "iv", "missing_rate")
    psi = stage(monthly_psi(train, bins, month))
    stable = stability_summary(psi, monthly_sample(train, bad, month), rules.max_psi, rules.min_month_samples)
    values = dominant_values(train, features).select("feature", "unique_count", "dominant_rate")
    return summary.join(values, "feature").join(stable, "feature", "left").fillna(
        0, ["max_monthly_psi", "unstable_month_ratio", "eligible_month_count"]
    )


def select_features(
    train: DataFrame, features: Sequence[str], bad: Column, rules: SelectionRules | None = None,
    month: str = "event_month",
) -> DataFrame:
    """Decision per feature with its evidence, ordered by decision and IV."""
    rules = rules or SelectionRules()
    metrics = stage(base_decisions(selection_metrics(train, features, bad, rules, month), rules))
    numeric = numeric_columns(train, features)
    replaced: dict[str, str] = {}
    if len(numeric) > 1:
        pairs = stage(correlation_pairs(train, numeric, rules.correlation_method))
        replaced = prune_correlated(metrics, pairs, rules.max_correlation)
    swaps = local_frame(
        train,
        pa.table(
            {
                "feature": pa.array(list(replaced), pa.string()),
                "correlated_with": pa.array(list(replaced.values()), pa.string()),
            }
        ),
    )
    review = F.concat_ws(
        ", ",
        F.when(F.col("unstable"), "stability"),
        F.when(F.col("dominant_rate") > rules.max_dominant, "dominant value"),
    )
    decision = (
        F.when(F.col("decision") != "candidate", F.col("decision"))
        .when(F.col("correlated_with").isNotNull(), "excluded_correlation")
        .when(review != "", "retained_review")
        .otherwise("retained")
    )
    result = metrics.join(swaps, "feature", "left").select(
        "feature",
        decision.alias("decision"),
        F.when(decision == "retained_review", review).alias("review_reason"),
        "iv",
        "missing_rate",
        "dominant_rate",
        "max_monthly_psi",
        "unstable_month_ratio",
        "eligible_month_count",
        "correlated_with",
        F.lit(rules.correlation_method).alias("correlation_method"),
    )
    return result.orderBy("decision", F.desc("iv"), "feature")


def retained_features(decisions: DataFrame) -> list[str]:
    """Names that stay (feature-sized), strongest first."""
    kept = [r.feature for r in decisions.where("decision like 'retained%'").orderBy(F.desc("iv"), "feature").collect()]
    if not kept:
        raise ValueError("no feature is left after selection")
    return kept


@dataclass(frozen=True)
class ScreeningRules:
    """Default limits of the cross-split screening."""

    max_missing: float = 0.80
    min_iv: float = 0.02
    psi_watch: float = 0.10
    psi_review: float = 0.25
    max_correlation: float = 0.70
    drop_categorical: bool = False
    bins: int = 10


def screen_features(
    df: DataFrame,
    features: Sequence[str],
    bad: Column,
    rules: ScreeningRules | None = None,
    dataset: str = "dataset",
    base: str = "train",
) -> DataFrame:
    """Keep, review or delete each feature from train quality and split PSI."""
    rules = rules or ScreeningRules()
    train = df.where(F.col(dataset) == base)
    numeric, categorical = split_types(df, features)
    ranked = ranked_values(train, numeric, bad) if numeric else None
    bins = fit_bins(train, features, rules.bins, method="distinct", ranked=ranked)
    summary = bin_summary(bin_detail(stage(bin_counts(train, bins, bad)))).select("feature", "iv", "missing_rate", "entropy")
    table = summary
    if ranked is not None:
        table = table.join(rank_metrics(ranked, ["feature"]).select("feature", "ks", "auc"), "feature", "left")
    else:
        table = table.withColumns({c: F.lit(None).cast("double") for c in ("ks", "auc")})
    psi = stage(split_psi(df, features, dataset, base, rules.bins))
    others = [d for d in ("validate", "test", "oot")]
    shift = psi.groupBy("feature").agg(
        *[F.max(F.when(F.col(dataset) == d, F.col("psi"))).alias(f"{d}_psi") for d in others],
        F.coalesce(F.max(F.when(F.col(dataset) != base, F.col("psi"))), F.lit(0.0)).alias("max_psi"),
    )
    values = dominant_values(train, features).select(
        "feature", (F.col("unique_count") + (F.col("missing_count") > 0).cast("int")).alias("distinct_count")
    )
    table = table.join(values, "feature").join(shift, "feature", "left")
    if len(numeric) > 1:
        table = table.join(max_correlation(stage(filled_pairs(train, numeric))), "feature", "left")
    else:
        table = table.withColumn("max_correlation", F.lit(0.0))
    table = table.fillna(0.0, ["max_correlation", "max_psi"])
    is_text = F.col("feature").isin(categorical) if categorical else F.lit(False)
    delete = (
        F.when(F.col("distinct_count") <= 1, "constant")
        .when(is_text & F.lit(rules.drop_categorical), "categorical")
        .when(F.col("missing_rate") >= rules.max_missing, "missing")
        .when(F.col("iv") < rules.min_iv, "low_iv")
    )
    drift = F.when(F.col("max_psi") >= rules.psi_review, "psi_high").when(F.col("max_psi") >= rules.psi_watch, "psi_watch")
    twin = F.when(F.col("max_correlation") >= rules.max_correlation, "correlated")
    reasons = F.concat_ws(",", delete, drift, twin)
    action = F.when(delete.isNotNull(), "delete").when(drift.isNotNull() | twin.isNotNull(), "review").otherwise("keep")
    return table.select(
        "feature",
        "missing_rate",
        "iv",
        "ks",
        "auc",
        (2 * F.col("auc") - 1).alias("gini"),
        F.col("entropy").alias("information_entropy"),
        *[f"{d}_psi" for d in others],
        "max_psi",
        "max_correlation",
        action.alias("action"),
        F.when(reasons == "", "passed").otherwise(reasons).alias("reason"),
    )


def action_counts(screened: DataFrame) -> DataFrame:
    return screened.groupBy("action").agg(F.count("*").alias("feature_count"))
