"""How well single features separate bad from good: KS, AUC, lift, buckets, Gini."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oddlens.functions.columns import ratio
from oddlens.functions.ranking import prefix_sums
from oddlens.operators.binning import (
    Bins,
    bin_counts,
    bin_detail,
    bin_summary,
    column_moments,
    fit_bins,
    ranked_values,
    score_cells,
    value_entropy,
)
from oddlens.operators.counts import feature_name, split_types, value_counts
from oddlens.sources.stages import stage


def rank_metrics(ranked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Tie-aware KS and rank AUC per key, from value counts ranked ascending.

    AUC uses average ranks: Σ bad·(values below + (n+1)/2). Null with one class.
    """
    below = F.col("cum_n") - F.col("n")
    middle = below + (F.col("n") + 1) / F.lit(2.0)
    good = F.col("tot_n") - F.col("tot_bad")
    gap = F.abs(
        ratio(F.col("cum_bad"), F.col("tot_bad"))
        - ratio(F.col("cum_n") - F.col("cum_bad"), good)
    )
    sums = ranked.groupBy(*keys).agg(
        F.max("tot_n").alias("sample_count"),
        F.max("tot_bad").alias("bad_count"),
        F.sum(F.col("bad") * middle).alias("rank_sum"),
        F.max(gap).alias("ks"),
    )
    b = F.col("bad_count")
    g = F.col("sample_count") - b
    auc = F.when((b > 0) & (g > 0), (F.col("rank_sum") - b.cast("double") * (b + 1) / F.lit(2.0)) / (b.cast("double") * g))
    return sums.withColumn("auc_raw", auc).select(
        *keys,
        "sample_count",
        "bad_count",
        g.alias("good_count"),
        "ks",
        "auc_raw",
        F.greatest("auc_raw", 1 - F.col("auc_raw")).alias("auc"),
    )


def univariate_overview(
    df: DataFrame,
    features: Sequence[str],
    bad: Column,
    bins: int = 10,
    max_categories: int = 20,
    method: str = "quantile",
    fitted: Bins | None = None,
) -> DataFrame:
    """One row per feature, strongest IV first.

    ``ks`` is measured on bins, ``ks_raw`` and ``auc`` on the raw numeric values.
    """
    numeric, _ = split_types(df, features)
    ranked = ranked_values(df, numeric, bad) if numeric else None
    if fitted is None:
        fitted = fit_bins(df, features, bins, max_categories, method, bad, ranked=ranked)
    summary = bin_summary(bin_detail(stage(bin_counts(df, fitted, bad))))
    result = column_moments(df, features).join(summary, "feature", "left")
    if ranked is not None:
        raw = rank_metrics(ranked, ["feature"])
        result = result.join(raw.select("feature", F.col("ks").alias("ks_raw"), "auc"), "feature", "left")
    else:
        result = result.withColumns({c: F.lit(None).cast("double") for c in ("ks_raw", "auc")})
    return result.select(
        "feature", "variable_type", "mean", "std", "iv", "ks", "ks_raw", "auc", "bin_count", "missing_rate"
    ).orderBy(F.desc("iv"), "feature")


def _cell_counts(df: DataFrame, bins: Bins, bad: Column, by: Sequence[str]) -> DataFrame:
    """``(*by, feature, num) → n, bad``; missing values have a null ``num``."""
    return (
        score_cells(df, bins, [*by, bad.cast("long").alias("__bad")])
        .groupBy(*by, "fid", "num")
        .agg(F.count("*").alias("n"), F.coalesce(F.sum("__bad"), F.lit(0)).alias("bad"))
        .select(*by, feature_name(list(bins)), "num", "n", "bad")
    )


def _cell_ranks(df: DataFrame, bins: Bins, bad: Column, by: Sequence[str]) -> DataFrame:
    counts = _cell_counts(df, bins, bad, by).where(F.col("num").isNotNull())
    return prefix_sums(counts, [*by, "feature"], ["num"], ["n", "bad"])


def top_share_lift(
    df: DataFrame,
    bins: Bins,
    bad: Column,
    id_cols: Sequence[str],
    by: Sequence[str] = (),
    share: float = 0.10,
    ranked: DataFrame | None = None,
    ascending: Sequence[str] = (),
) -> DataFrame:
    """Bad rate among the top ``ceil(share·n)`` rows over the overall bad rate.

    Values rank descending, or ascending for features named in ``ascending``; rows
    that tie at the cut enter in ID order. Rows above the cut come from the value
    counts; only the rows that hold the cut value are ranked one by one.
    """
    keys = [*by, "feature"]
    ranked = _cell_ranks(df, bins, bad, by) if ranked is None else ranked
    low_first = F.col("feature").isin(list(ascending)) if ascending else F.lit(False)
    before = F.when(low_first, F.col("cum_n") - F.col("n")).otherwise(F.col("tot_n") - F.col("cum_n"))
    bad_before = F.when(low_first, F.col("cum_bad") - F.col("bad")).otherwise(F.col("tot_bad") - F.col("cum_bad"))
    size = F.ceil(F.col("tot_n") * F.lit(share))
    cut = stage(
        ranked.where((before < size) & (before + F.col("n") >= size)).select(
            *keys,
            "num",
            size.alias("top_size"),
            (size - before).alias("need"),
            bad_before.alias("bad_above"),
            (F.col("n") == size - before).alias("whole"),
            F.col("bad").alias("cut_bad"),
            F.col("tot_n"),
            F.col("tot_bad"),
        )
    )
    # `cut` has one row per key and a known written size.
    label = bad.cast("long").alias("__bad")
    cells = score_cells(df, bins, [*by, *id_cols, label])
    cells = cells.select(*by, *id_cols, "__bad", feature_name(list(bins)), "num")
    tied = cells.join(cut.where(~F.col("whole")).select(*keys, "num", "need"), [*keys, "num"])
    inside = (
        prefix_sums(tied.withColumn("__one", F.lit(1).cast("long")), keys, list(id_cols), ["__one"])
        .where(F.col("cum___one") <= F.col("need"))
        .groupBy(*keys)
        .agg(F.coalesce(F.sum("__bad"), F.lit(0)).alias("cut_part"))
    )
    taken = F.col("bad_above") + F.when(F.col("whole"), F.col("cut_bad")).otherwise(F.coalesce("cut_part", F.lit(0)))
    top_rate = taken / F.col("top_size")
    return cut.join(inside, keys, "left").select(
        *keys,
        "top_size",
        taken.alias("top_bad"),
        ratio(top_rate, F.col("tot_bad") / F.col("tot_n")).alias("lift"),
    )


def monthly_discrimination(
    df: DataFrame,
    bins: Bins,
    bad: Column,
    id_cols: Sequence[str],
    month: str = "event_month",
    monthly_psi: DataFrame | None = None,
    include_missing: bool = False,
) -> DataFrame:
    """KS, AUC, top-decile lift and counts per feature and month.

    The direction of the lift is fixed per feature by its overall raw AUC, so months
    stay comparable. ``include_missing`` counts rows with a missing value too.
    """
    dated = df.where(F.col(month).isNotNull())
    # One scan counts the cells; ranks over all rows, ranks by month and totals come from its counts.
    counts = stage(_cell_counts(df, bins, bad, [month]))
    present = counts.where(F.col("num").isNotNull())
    overall = present.groupBy("feature", "num").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    whole = rank_metrics(prefix_sums(overall, ["feature"], ["num"], ["n", "bad"]), ["feature"]).select("feature", "auc_raw")
    direction = {r.feature: r.auc_raw is None or r.auc_raw >= 0.5 for r in whole.collect()}
    ascending = [f for f, high_first in direction.items() if not high_first]
    monthly = present.where(F.col(month).isNotNull())
    ranked = prefix_sums(monthly, [month, "feature"], ["num"], ["n", "bad"])
    metrics = rank_metrics(ranked, [month, "feature"])
    lift = top_share_lift(dated, bins, bad, id_cols, [month], ranked=ranked, ascending=ascending)
    totals = df.agg(F.count("*").alias("table_rows"))
    cells = (
        counts.where(F.col(month).isNotNull())
        .groupBy(month, "feature")
        .agg(F.sum("n").alias("all_rows"), F.sum("bad").alias("all_bad"))
    )
    keys = [month, "feature"]
    joined = cells.join(metrics, keys, "left").join(lift, keys, "left").crossJoin(totals)  # one row
    n = F.col("all_rows") if include_missing else F.coalesce("sample_count", F.lit(0))
    b = F.col("all_bad") if include_missing else F.coalesce("bad_count", F.lit(0))
    result = joined.select(
        "feature",
        month,
        "ks",
        "auc",
        F.col("lift").alias("lift_10"),
        n.alias("sample_count"),
        b.alias("bad_count"),
        (n - b).alias("good_count"),
        ratio(b, n).alias("bad_rate"),
        ratio(n, F.col("table_rows")).alias("sample_rate"),
        F.when(F.col("feature").isin(ascending) if ascending else F.lit(False), "ascending")
        .otherwise("descending")
        .alias("direction"),
    )
    if monthly_psi is None:
        return result
    psi = monthly_psi.select("feature", F.col("event_month").alias(month), "psi")
    return result.join(psi, ["feature", month], "left").fillna(0.0, ["psi"])


def ks_buckets(
    df: DataFrame, bins: Bins, bad: Column, id_cols: Sequence[str], buckets: int = 10
) -> DataFrame:
    """Equal-size buckets from the highest value down, with capture, KS and lift.

    Buckets hold ``ceil(n/buckets)`` rows (the last may be smaller); rows that tie
    are ordered by ID. Buckets are cut from the value counts; only values that a cut runs
    through are looked up by ID (``_bad_before_cuts``).
    """
    ranked = _cell_ranks(df, bins, bad, [])
    size = F.greatest(F.lit(1), F.ceil(F.col("tot_n") / F.lit(buckets)))
    above = F.col("tot_n") - F.col("cum_n")
    placed = ranked.withColumns({"size": size, "above": above}).withColumns({
        "first": (F.floor(F.col("above") / F.col("size")) + 1).cast("int"),
        "last": (F.floor((F.col("above") + F.col("n") - 1) / F.col("size")) + 1).cast("int"),
    })
    kept = ["feature", "num", "bucket", "n", "bad", "tot_n", "tot_bad"]
    whole = placed.where("first = last").withColumnRenamed("first", "bucket").select(*kept)
    pieces = stage(placed.where("first < last").withColumn("bucket", F.explode(F.sequence("first", "last"))))
    until = F.least(F.col("bucket") * F.col("size") - F.col("above"), F.col("n"))
    pieces = pieces.withColumn("until", until)
    cuts = stage(pieces.where("until < n").select("feature", "num", "until"))
    pieces = pieces.join(_bad_before_cuts(df, bins, bad, id_cols, cuts), ["feature", "num", "until"], "left")
    steps = Window.partitionBy("feature", "num").orderBy("bucket")
    reached = F.when(F.col("until") == F.col("n"), F.col("bad")).otherwise(F.col("bad_before"))
    pieces = pieces.withColumn("reached", reached).withColumns({
        "n": F.col("until") - F.coalesce(F.lag("until").over(steps), F.lit(0)),
        "bad": F.col("reached") - F.coalesce(F.lag("reached").over(steps), F.lit(0)),
    })
    grouped = whole.unionByName(pieces.select(*kept)).groupBy("feature", "bucket").agg(
        F.min("num").alias("score_min"),
        F.max("num").alias("score_max"),
        F.sum("n").alias("sample_count"),
        F.sum("bad").alias("bad_count"),
        F.max("tot_n").alias("total"),
        F.max("tot_bad").alias("total_bad"),
    )
    return bucket_columns(grouped, ["feature"])


def _bad_before_cuts(df: DataFrame, bins: Bins, bad: Column, id_cols: Sequence[str], cuts: DataFrame) -> DataFrame:
    """``(feature, num, until, bad_before)``: bads among the first ``until`` rows of a value in ID order.

    The rows, not their cells, are shuffled once into slices of ID order. Counts per slice
    tell the slice that a cut falls into; only its rows with the value are ranked.
    """
    keep = [c for c in dict.fromkeys([*id_cols, *bins])]
    rows = df.select(*keep, bad.cast("long").alias("__bad")).repartitionByRange(*id_cols)
    rows = stage(rows.withColumn("__slice", F.spark_partition_id()))
    cells = score_cells(rows, bins, ["__slice", *[F.col(c).alias(f"__id{i}") for i, c in enumerate(id_cols)], "__bad"])
    cells = cells.withColumn("feature", feature_name(list(bins))).drop("fid")
    cell = ["feature", "num"]
    counts = cells.join(cuts.select(*cell).distinct(), cell).groupBy(*cell, "__slice").agg(
        F.count("*").alias("__n"), F.coalesce(F.sum("__bad"), F.lit(0)).alias("__b")
    )
    run = Window.partitionBy(*cell).orderBy("__slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = counts.withColumns({"__n_to": F.sum("__n").over(run), "__b_to": F.sum("__b").over(run)})
    hit = stage(
        sums.join(cuts, cell)
        .where((F.col("until") <= F.col("__n_to")) & (F.col("until") > F.col("__n_to") - F.col("__n")))
        .select(*cell, "until", "__slice", (F.col("until") - F.col("__n_to") + F.col("__n")).alias("__need"), (F.col("__b_to") - F.col("__b")).alias("__before"))
    )
    order = Window.partitionBy(*cell, "until").orderBy(*[f"__id{i}" for i in range(len(id_cols))])
    inside = cells.join(hit, [*cell, "__slice"]).withColumn("__place", F.row_number().over(order)).where("__place <= __need")
    return inside.groupBy(*cell, "until").agg((F.max("__before") + F.coalesce(F.sum("__bad"), F.lit(0))).alias("bad_before"))


def bucket_columns(grouped: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rates, distributions, running capture, KS and lift (bucket-sized input)."""
    run = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    good = F.col("sample_count") - F.col("bad_count")
    total_good = F.col("total") - F.col("total_bad")
    cum_n = F.sum("sample_count").over(run)
    cum_bad = F.sum("bad_count").over(run)
    bad_capture = ratio(cum_bad, F.col("total_bad"))
    good_capture = ratio(cum_n - cum_bad, total_good)
    base_rate = F.col("total_bad") / F.col("total")
    return grouped.select(
        *keys,
        "bucket",
        "score_min",
        "score_max",
        "sample_count",
        "bad_count",
        good.alias("good_count"),
        ratio(F.col("bad_count"), F.col("sample_count")).alias("bad_rate"),
        ratio(good, F.col("sample_count")).alias("good_rate"),
        ratio(F.col("bad_count"), F.col("total_bad")).alias("bad_distribution"),
        ratio(good, total_good).alias("good_distribution"),
        bad_capture.alias("cumulative_bad_capture"),
        good_capture.alias("cumulative_good_capture"),
        ratio(cum_n, F.col("total")).alias("cumulative_sample_rate"),
        F.abs(bad_capture - good_capture).alias("ks"),
        ratio(F.col("bad_count") / F.col("sample_count"), base_rate).alias("lift"),
        ratio(bad_capture, cum_n / F.col("total")).alias("cumulative_lift"),
    )


def target_mean_gini(df: DataFrame, features: Sequence[str], bad: Column, by: Sequence[str] = ()) -> DataFrame:
    """Gini = 2·AUC − 1 per feature: numbers rank by value with missing as 0, a
    category ranks by the bad rate of its own value in the same group."""
    counts = value_counts(df, features, bad, by)
    numeric, _ = split_types(df, features)
    is_number = F.col("feature").isin(numeric) if numeric else F.lit(False)
    score = F.when(is_number, F.coalesce("num", F.lit(0.0))).otherwise(F.col("bad") / F.col("n"))
    merged = (
        counts.withColumn("score", score)
        .groupBy(*by, "feature", "score")
        .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        .withColumnRenamed("score", "num")
    )
    ranked = prefix_sums(merged, [*by, "feature"], ["num"], ["n", "bad"])
    return rank_metrics(ranked, [*by, "feature"]).select(
        *by, "feature", (2 * F.col("auc_raw") - 1).alias("gini")
    )


def variable_information(
    df: DataFrame, features: Sequence[str], bad: Column, dataset: str = "dataset",
    datasets: Sequence[str] = ("train", "test", "oot"), bins: int = 10,
) -> DataFrame:
    """IV, missing rate, entropy and Gini per feature and split, one column each.

    Bins are fitted inside each split, as each split is measured on its own.
    """
    gini = target_mean_gini(df, features, bad, [dataset])
    entropy = value_entropy(df, features, [dataset])
    parts = []
    for name in datasets:
        part = df.where(F.col(dataset) == name)
        fitted = fit_bins(part, features, bins)
        detail = bin_detail(stage(bin_counts(part, fitted, bad)))
        parts.append(bin_summary(detail).select(F.lit(name).alias(dataset), "feature", "iv", "missing_rate"))
    summary = parts[0]
    for part in parts[1:]:
        summary = summary.unionByName(part)
    keys = [dataset, "feature"]
    wide = (
        summary.join(entropy, keys, "left")
        .join(gini, keys, "left")
        .groupBy("feature")
        .pivot(dataset, list(datasets))
        .agg(*[F.max(c).alias(c) for c in ("iv", "missing_rate", "entropy", "gini")])
    )
    if "test" in datasets:
        wide = wide.withColumns({f"validation_{c}": F.col(f"test_{c}") for c in ("iv", "missing_rate", "entropy", "gini")})
    return wide
