"""Population stability: monthly and split-to-split PSI, monthly sample mix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oddlens.functions.columns import ratio, share_gap
from oddlens.operators.binning import (
    MISSING,
    Bins,
    CategoryBins,
    NumericBins,
    bin_counts,
    fit_bins,
    ranked_edges,
    ranked_quantiles,
)
from oddlens.functions.ranking import prefix_sums
from oddlens.operators.counts import split_types, value_counts
from oddlens.sources.stages import stage


def psi_against(
    counts: DataFrame, keys: Sequence[str], group: str, base: Column, smoothing: float = 0.5,
    support: DataFrame | None = None,
) -> DataFrame:
    """PSI of each group against the base group, per key.

    ``counts`` is bin-sized: ``(*keys, group, bin, n)``. ``base`` gives, per row of
    ``(*keys, group)``, the name of the base group. Every bin seen for a key takes
    part, also where a group has none of it.
    """
    cells = counts.where(F.col(group).isNotNull()).groupBy(*keys, group, "bin").agg(F.sum("n").alias("n"))
    totals = cells.groupBy(*keys, group).agg(F.sum("n").alias("total"))
    bins = (counts if support is None else support).select(*keys, "bin").distinct()
    # One row per (key, group, bin): an equi-join on the keys, all bin-sized.
    grid = totals.join(bins, keys) if keys else totals.crossJoin(bins)  # splits × bins
    grid = grid.join(cells, [*keys, group, "bin"], "left").fillna(0, ["n"]).withColumn("base_group", base)
    per_key = Window.partitionBy(*keys, "bin")
    is_base = F.col(group) == F.col("base_group")
    return (
        grid.withColumns(
            {
                "base_n": F.max(F.when(is_base, F.col("n"))).over(per_key),
                "base_total": F.max(F.when(is_base, F.col("total"))).over(per_key),
                "cells": F.count("*").over(Window.partitionBy(*keys, group)),
            }
        )
        .groupBy(*keys, group)
        .agg(
            F.max("base_group").alias("base_group"),
            F.max("total").alias("sample_count"),
            F.sum(
                share_gap(F.col("n"), F.col("total"), F.col("base_n"), F.col("base_total"), F.col("cells"), smoothing)
            ).alias("psi"),
        )
    )


def monthly_psi(
    df: DataFrame,
    bins: Bins,
    month: str = "event_month",
    baseline: str | None = None,
    smoothing: float = 0.5,
) -> DataFrame:
    """Feature PSI per month against a baseline month (the earliest by default).

    One pass over the table; everything after it is (feature, month, bin)-sized.
    ``smoothing=1.0`` adds one observation to every bin on both sides.
    """
    counts = stage(bin_counts(df, bins, F.lit(0), [month]))
    months = counts.where(F.col(month).isNotNull()).select(month).distinct()
    if baseline is not None:
        if not months.where(F.col(month) == baseline).count():
            raise ValueError(f"baseline month {baseline!r} does not occur")
        base = F.lit(baseline)
    else:
        base = F.lit(months.agg(F.min(month)).first()[0])
    return psi_against(counts, ["feature"], month, base, smoothing).select(
        "feature", F.col(month).alias("event_month"), F.col("base_group").alias("baseline_month"), "psi"
    )


def psi_summary(psi: DataFrame, warning: float = 0.25) -> DataFrame:
    """Mean and largest monthly PSI per feature, largest first."""
    return (
        psi.groupBy("feature")
        .agg(F.avg("psi").alias("average_psi"), F.max("psi").alias("max_psi"))
        .withColumn("psi_warning", F.col("max_psi") >= warning)
        .orderBy(F.desc("max_psi"), "feature")
    )


def monthly_sample(df: DataFrame, bad: Column, month: str = "event_month", baseline: str | None = None) -> DataFrame:
    """Counts, bad rate and the PSI of the good/bad mix against the baseline month."""
    monthly = (
        df.groupBy(F.col(month).alias("event_month"))
        .agg(F.count("*").alias("sample_count"), F.coalesce(F.sum(bad.cast("long")), F.lit(0)).alias("bad_count"))
        .where("event_month is not null")
        .withColumn("good_count", F.col("sample_count") - F.col("bad_count"))
    )
    every = Window.partitionBy()  # months-sized
    base = F.lit(baseline) if baseline is not None else F.min("event_month").over(every)
    monthly = monthly.withColumn("baseline_month", base)
    is_base = F.col("event_month") == F.col("baseline_month")
    monthly = monthly.withColumns(
        {f"base_{c}": F.max(F.when(is_base, F.col(f"{c}_count"))).over(every) for c in ("sample", "bad", "good")}
    )
    two = F.lit(2)
    mix = sum(
        share_gap(F.col(f"{c}_count"), F.col("sample_count"), F.col(f"base_{c}"), F.col("base_sample"), two, 0.5)
        for c in ("bad", "good")
    )
    return monthly.select(
        "event_month",
        "sample_count",
        "bad_count",
        "good_count",
        ratio(F.col("bad_count"), F.col("sample_count")).alias("bad_rate"),
        "baseline_month",
        F.when(is_base, F.lit(0.0)).otherwise(mix).alias("psi"),
    )


def split_psi(
    df: DataFrame, features: Sequence[str], dataset: str = "dataset", base: str = "train", bins: int = 10,
    smoothing: float = 0.5,
) -> DataFrame:
    """Feature PSI of each split against the base split.

    Numbers use interpolated train quantiles with values on an edge going down;
    categories keep the first ``bins - 1`` train values in alphabetical order.
    Missing values are left out.
    """
    train = df.where(F.col(dataset) == base)
    numeric, categorical = split_types(df, features)
    fitted: dict = {}
    if numeric:
        fitted.update(fit_bins(train, numeric, bins, method="linear", side="left"))
    fitted.update(_alphabetical_bins(train, categorical, bins))
    counts = stage(bin_counts(df, fitted, F.lit(0), [dataset])).where(F.col("bin") != MISSING)
    return psi_against(counts, ["feature"], dataset, F.lit(base), smoothing).select("feature", dataset, "psi")


def _alphabetical_bins(df: DataFrame, features: Sequence[str], bins: int) -> dict[str, CategoryBins]:
    if not features:
        return {}
    keep = max(1, bins - 1)
    place = F.row_number().over(Window.partitionBy("feature").orderBy("txt"))
    top = (
        value_counts(df, features)
        .where(F.col("txt").isNotNull())
        .withColumn("place", place)
        .where(F.col("place") <= keep)
    )
    found: dict[str, list[str]] = {f: [] for f in features}
    for row in top.select("feature", "txt").collect():
        found[row.feature].append(row.txt)
    return {f: CategoryBins(tuple(sorted(v)), True) for f, v in found.items()}


def score_psi(
    df: DataFrame,
    score: str,
    dataset: str = "dataset",
    base: str = "train",
    bins: int = 10,
    edges: str = "quantile",
    smoothing: float = 0.5,
) -> DataFrame:
    """PSI of a score per split against the base split; values on an edge go down.

    ``edges="quantile"`` takes data values, ``"linear"`` interpolates and gives 0 to a
    split whose scores are all the one constant of the base split.
    """
    scored = df.where(F.col(score).isNotNull())
    counts = scored.where(F.col(dataset) == base).groupBy(F.col(score).alias("num")).agg(F.count("*").alias("n"))
    ranked = prefix_sums(counts, [], ["num"], ["n"])
    if edges == "linear":
        row = ranked_quantiles(ranked, [i / bins for i in range(1, bins)], keys=[]).first()
        cuts = sorted(set(row.quantiles)) if row and row.quantiles and row.quantiles[0] is not None else []
    else:
        cuts = sorted(ranked_edges(ranked, bins, keys=[]).first().edges)
    bucket = NumericBins(tuple(cuts), "left").index(score)
    cells = stage(
        scored.groupBy(dataset, bucket.alias("bin")).agg(
            F.count("*").alias("n"), F.min(score).alias("low"), F.max(score).alias("high")
        )
    )
    support = scored.sparkSession.range(len(cuts) + 1).select(F.col("id").cast("int").alias("bin"))
    psi = psi_against(cells, [], dataset, F.lit(base), smoothing, support=support).select(
        dataset, F.col("psi").alias("score_psi")
    )
    if edges != "linear":
        return psi
    ranges = cells.groupBy(dataset).agg(F.min("low").alias("low"), F.max("high").alias("high"))
    known = {r[dataset]: (r.low, r.high) for r in ranges.collect()}  # splits-sized
    low, high = known.get(base, (None, None))
    same = [d for d, r in known.items() if low is not None and low == high and r == (low, high)]
    return psi.withColumn("score_psi", F.when(F.col(dataset).isin(same), F.lit(0.0)).otherwise(F.col("score_psi"))) if same else psi


def stability_summary(
    psi: DataFrame, monthly: DataFrame, max_psi: float = 0.25, min_samples: int = 100
) -> DataFrame:
    """Largest PSI and share of unstable months per feature, over months with enough
    samples and without the baseline month. A feature without such months gets 0."""
    enough = monthly.where(F.col("sample_count") >= min_samples).select("event_month")
    counted = psi.where(F.col("event_month") != F.col("baseline_month")).join(enough, "event_month", "left_semi")
    per = counted.groupBy("feature").agg(
        F.max("psi").alias("max_monthly_psi"),
        F.avg((F.col("psi") > max_psi).cast("double")).alias("unstable_month_ratio"),
        F.count("*").alias("eligible_month_count"),
    )
    return psi.select("feature").distinct().join(per, "feature", "left").fillna(
        0, ["max_monthly_psi", "unstable_month_ratio", "eligible_month_count"]
    )
