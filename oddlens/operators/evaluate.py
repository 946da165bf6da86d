"""Evaluation of scores: ranking metrics, lift, calibration, curves, intervals.

``rank_scores`` orders the scored rows once, by (score desc, ID asc) inside each
key, with range partitioned prefix sums. Every table here is an aggregate of that
one ranked frame, so several tables can share one sort.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oddlens.functions.columns import bucket_of_rank, ratio
from oddlens.functions.ranking import global_row_number, prefix_sums
from oddlens.operators.contract import RiskContract
from oddlens.operators.counts import feature_name, text_cells, value_counts
from oddlens.operators.stability import score_psi
from oddlens.sources.stages import stage

# Name parts that mark a column as a monitoring dimension.
GROUP_HINTS = ("channel", "region", "province", "city", "segment", "group", "客群", "渠道", "地区")


def rank_scores(
    df: DataFrame,
    score: str,
    bad: Column,
    id_cols: Sequence[str],
    keys: Sequence[str] = (),
    ascending: bool = False,
) -> DataFrame:
    """Narrow rows ``(*keys, *ids, score, bad)`` with running and total counts.

    ``id_cols`` may be named like a key; a column is kept once.
    """
    ids = [c for c in id_cols if c not in keys]
    rows = df.where(F.col(score).isNotNull()).select(
        *keys,
        *ids,
        F.col(score).cast("double").alias("score"),
        bad.cast("long").alias("bad"),
        F.lit(1).cast("long").alias("n"),
    )
    return prefix_sums(rows, keys, ["score" if ascending else "-score", *ids], ["n", "bad"])


def binary_metrics(ranked: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """AUC, tie-aware KS, average precision and Brier score per key.

    Ties are folded first, so KS and AUC do not depend on the order inside a tie;
    average precision follows the row order (score desc, ID asc).
    """
    b, g = F.col("tot_bad"), F.col("tot_n") - F.col("tot_bad")
    ties = ranked.groupBy(*keys, "score").agg(
        F.count("*").alias("n"),
        F.sum("bad").alias("bad"),
        F.max("cum_n").alias("cum_n"),
        F.max("cum_bad").alias("cum_bad"),
        F.max("tot_n").alias("tot_n"),
        F.max("tot_bad").alias("tot_bad"),
        F.sum(F.col("bad") * F.col("cum_bad") / F.col("cum_n")).alias("precision_sum"),
        F.sum(F.pow(F.col("score") - F.col("bad"), F.lit(2))).alias("squared"),
    )
    middle = F.col("tot_n") - F.col("cum_n") + (F.col("n") + 1) / F.lit(2.0)
    gap = F.abs(ratio(F.col("cum_bad"), b) - ratio(F.col("cum_n") - F.col("cum_bad"), g))
    per = ties.groupBy(*keys).agg(
        F.sum("n").alias("sample_count"),
        F.sum("bad").alias("bad_count"),
        F.sum(F.col("bad") * middle).alias("rank_sum"),
        F.max(gap).alias("ks"),
        F.sum("precision_sum").alias("precision_sum"),
        F.sum("squared").alias("squared"),
    )
    b, g = F.col("bad_count"), F.col("sample_count") - F.col("bad_count")
    auc = F.when((b > 0) & (g > 0), (F.col("rank_sum") - b.cast("double") * (b + 1) / F.lit(2.0)) / (b.cast("double") * g))
    return per.select(
        *keys,
        "sample_count",
        "bad_count",
        ratio(b, F.col("sample_count")).alias("bad_rate"),
        auc.alias("auc"),
        F.greatest(auc, 1 - auc).alias("auc_adjusted"),
        (2 * auc - 1).alias("gini"),
        "ks",
        ratio(F.col("precision_sum"), b).alias("pr_auc"),
        ratio(F.col("squared"), F.col("sample_count")).alias("brier_score"),
    )


def evaluate_scores(
    df: DataFrame, score: str, bad: Column, id_cols: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    return binary_metrics(rank_scores(df, score, bad, id_cols, keys), keys)


def score_auc_ks(df: DataFrame, score: str, bad: Column, keys: Sequence[str] = ()) -> DataFrame:
    """AUC and KS only: rows shrink to distinct scores before anything is ordered."""
    from oddlens.operators.discrimination import rank_metrics

    counts = (
        df.where(F.col(score).isNotNull())
        .groupBy(*keys, F.col(score).cast("double").alias("num"))
        .agg(F.count("*").alias("n"), F.coalesce(F.sum(bad.cast("long")), F.lit(0)).alias("bad"))
    )
    return rank_metrics(prefix_sums(counts, keys, ["num"], ["n", "bad"]), keys)


def _bucketed(ranked: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    bucket = bucket_of_rank(F.col("cum_n"), F.col("tot_n"), buckets)
    return ranked.groupBy(*keys, bucket.alias("bucket")).agg(
        F.min("score").alias("score_min"),
        F.max("score").alias("score_max"),
        F.count("*").alias("sample_count"),
        F.sum("bad").alias("bad_count"),
        F.avg("score").alias("mean_predicted"),
        F.max("tot_n").alias("total"),
        F.max("tot_bad").alias("total_bad"),
    )


def lift_table(ranked: DataFrame, keys: Sequence[str] = (), buckets: int = 10) -> DataFrame:
    """Equal-population buckets from the highest risk down, with capture and lift."""
    run = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sample_rate = ratio(F.sum("sample_count").over(run), F.col("total"))
    capture = ratio(F.sum("bad_count").over(run), F.col("total_bad"))
    bad_rate = ratio(F.col("bad_count"), F.col("sample_count"))
    return _bucketed(ranked, keys, buckets).select(
        *keys,
        "bucket",
        "score_min",
        "score_max",
        "sample_count",
        "bad_count",
        bad_rate.alias("bad_rate"),
        ratio(bad_rate, F.col("total_bad") / F.col("total")).alias("lift"),
        sample_rate.alias("cumulative_sample_rate"),
        capture.alias("cumulative_bad_capture"),
    )


def cumulative_lift(lift: DataFrame, keys: Sequence[str] = ("dataset",)) -> DataFrame:
    """Add running shares, capture over sample share, and a reliability tag, from
    the counts of a lift table."""
    from oddlens.operators.diagnose import reliability

    whole = Window.partitionBy(*keys)
    run = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    share = ratio(F.sum("sample_count").over(run), F.sum("sample_count").over(whole))
    capture = ratio(F.sum("bad_count").over(run), F.sum("bad_count").over(whole))
    return lift.withColumns(
        {
            "cumulative_sample_rate": share,
            "cumulative_bad_capture": capture,
            "cumulative_lift": ratio(capture, share),
            "reliability": reliability(F.col("bad_count"), F.col("sample_count")),
        }
    )


def decile_table(ranked: DataFrame, keys: Sequence[str] = (), groups: int = 10) -> DataFrame:
    """Deciles with lift (0 without bads), cumulative gain and sample share."""
    zero = F.lit(0.0)
    return lift_table(ranked, keys, groups).select(
        *keys,
        F.col("bucket").alias("decile"),
        "sample_count",
        "bad_count",
        "bad_rate",
        F.coalesce("lift", zero).alias("lift"),
        F.coalesce("cumulative_bad_capture", zero).alias("cumulative_gain"),
        (F.col("sample_count") / F.sum("sample_count").over(Window.partitionBy(*keys))).alias("sample_rate"),
    )


def calibration_table(ranked: DataFrame, keys: Sequence[str] = (), buckets: int = 10) -> DataFrame:
    """Mean predicted against observed bad rate per equal-population bucket."""
    observed = ratio(F.col("bad_count"), F.col("sample_count"))
    return _bucketed(ranked, keys, buckets).select(
        *keys,
        "bucket",
        "sample_count",
        "mean_predicted",
        observed.alias("observed_bad_rate"),
        F.abs(F.col("mean_predicted") - observed).alias("absolute_error"),
    )


def score_distribution(ranked: DataFrame, keys: Sequence[str] = (), buckets: int = 10) -> DataFrame:
    """Good and bad counts per ascending bucket; expects an ascending ranking."""
    return _bucketed(ranked, keys, buckets).select(
        *keys,
        "bucket",
        F.format_string("P%02d (%.4f–%.4f)", "bucket", "score_min", "score_max").alias("label"),
        (F.col("sample_count") - F.col("bad_count")).alias("good_count"),
        "bad_count",
        "sample_count",
        "score_min",
        "score_max",
    )


def _thresholds(ranked: DataFrame, keys: Sequence[str]) -> DataFrame:
    return ranked.groupBy(*keys, "score").agg(
        F.max("cum_n").alias("cum_n"),
        F.max("cum_bad").alias("cum_bad"),
        F.max("tot_n").alias("tot_n"),
        F.max("tot_bad").alias("tot_bad"),
    ).where("tot_bad > 0 and tot_bad < tot_n")


def roc_points(ranked: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """ROC path at distinct thresholds, with the (0, 0) start (null threshold)."""
    points = _thresholds(ranked, keys)
    path = points.select(
        *keys,
        F.col("score").alias("threshold"),
        ((F.col("cum_n") - F.col("cum_bad")) / (F.col("tot_n") - F.col("tot_bad"))).alias("fpr"),
        (F.col("cum_bad") / F.col("tot_bad")).alias("tpr"),
    )
    zero = F.lit(0.0)
    start = _start(points, keys, F.lit(None).cast("double").alias("threshold"), zero.alias("fpr"), zero.alias("tpr"))
    return start.unionByName(path)


def pr_points(ranked: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Precision-recall path at distinct thresholds, starting at (0, 1)."""
    points = _thresholds(ranked, keys)
    path = points.select(
        *keys,
        F.col("score").alias("threshold"),
        (F.col("cum_bad") / F.col("tot_bad")).alias("recall"),
        (F.col("cum_bad") / F.col("cum_n")).alias("precision"),
    )
    start = _start(
        points, keys, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("recall"), F.lit(1.0).alias("precision")
    )
    return start.unionByName(path)


def _start(points: DataFrame, keys: Sequence[str], *columns: Column) -> DataFrame:
    """One row per key that has points."""
    return points.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n > 0").select(*keys, *columns)


def ks_curve(ranked: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Running bad and good shares and their gap along the ranked rows."""
    bad = F.col("cum_bad") / F.col("tot_bad")
    good = (F.col("cum_n") - F.col("cum_bad")) / (F.col("tot_n") - F.col("tot_bad"))
    return ranked.where("tot_bad > 0 and tot_bad < tot_n").select(
        *keys,
        F.col("cum_n").alias("position"),
        (F.col("cum_n") / F.col("tot_n")).alias("population_rate"),
        bad.alias("cumulative_bad_rate"),
        good.alias("cumulative_good_rate"),
        F.abs(bad - good).alias("ks"),
    )


def thin_curve(points: DataFrame, order: Sequence[str], keys: Sequence[str] = (), limit: int = 41) -> DataFrame:
    """Keep ``limit`` evenly indexed points of a curve (all of them if fewer)."""
    ranked = global_row_number(points, order, keys)
    step = (F.col("tot_n") - 1) / F.lit(float(limit - 1))
    wanted = F.array(*[F.floor(F.lit(float(j)) * step) for j in range(limit - 1)])
    index = F.col("rn") - 1
    kept = (F.col("tot_n") <= limit) | F.array_contains(wanted, index) | (F.col("rn") == F.col("tot_n"))
    return ranked.where(kept).withColumn("point", index).drop("rn", "tot_n")


def metrics_by_split(
    df: DataFrame, score: str, bad: Column, id_cols: Sequence[str], base: str = "train", ranked: DataFrame | None = None
) -> DataFrame:
    """Ranking and calibration metrics per split, with the score PSI against train.

    ``ranked``: the same rows, ranked by ``rank_scores`` per dataset, if they are at hand.
    """
    metrics = binary_metrics(rank_scores(df, score, bad, id_cols, ["dataset"]) if ranked is None else ranked, ["dataset"])
    psi = score_psi(df, score, "dataset", base).withColumnRenamed("score_psi", "score_psi_vs_train")
    return metrics.join(psi, "dataset", "left")


def monthly_performance(
    df: DataFrame, score: str, bad: Column, id_cols: Sequence[str], month: str = "event_month"
) -> DataFrame:
    """Metrics per split and month; rows without a month count as UNKNOWN."""
    dated = df.withColumn(month, F.coalesce(month, F.lit("UNKNOWN")))
    return evaluate_scores(dated, score, bad, id_cols, ["dataset", month])


def detect_group_columns(
    df: DataFrame, contract: RiskContract, features: Sequence[str] = (), limit: int = 5
) -> list[str]:
    """Columns with 2 to 20 distinct values (null counts) that are text, boolean or
    named like a dimension; named ones first. Sketches rule out wide columns before
    the exact count."""
    skip = {*contract.role_cols, "event_date", "event_month"}
    names = [c for c in dict.fromkeys([*features, *df.columns]) if c not in skip]

    def hinted(c: str) -> bool:
        return any(h in c.lower() for h in GROUP_HINTS)

    def texty(c: str) -> bool:
        return isinstance(df.schema[c].dataType, (T.StringType, T.BooleanType))

    names = sorted((c for c in names if hinted(c) or texty(c)), key=lambda c: (not hinted(c), not texty(c), c))
    if not names:
        return []
    exact = value_counts(df, names).groupBy("feature").agg(F.count("*").alias("values"))
    found = {r.feature: r["values"] for r in exact.collect()}
    return [c for c in names if 2 <= found[c] <= 20][:limit]


def group_performance(
    df: DataFrame,
    score: str,
    bad: Column,
    id_cols: Sequence[str],
    dimensions: Sequence[str],
    minimum: int = 20,
) -> DataFrame:
    """Metrics per split, dimension and value for groups of at least ``minimum`` rows."""
    keys = ["dataset", "dimension", "group_value"]
    extra = [c for c in id_cols if c != "dataset"]
    names = list(dimensions)
    kept = [F.col(c) for c in ("dataset", *extra)] + [F.col(score).alias("__score"), bad.alias("__bad")]
    long = text_cells(df, dict(enumerate(names)), kept).select(
        "dataset",
        *extra,
        "__score",
        "__bad",
        feature_name(names).alias("dimension"),
        F.coalesce("txt", F.lit("<MISSING>")).alias("group_value"),
    )
    return evaluate_scores(long, "__score", F.col("__bad"), extra, keys).where(F.col("sample_count") >= minimum)


# Largest cell with a Poisson table of its own; larger ones are sums of independent draws of
# n % 16, of the powers of two that make up the rest, and of as many blocks as are left.
_EXACT_POISSON, _POWERS, _BLOCK = 24, (16, 32, 64, 128, 256, 512, 1024, 2048), 4096


def _poisson_cdf(mean: int) -> list[float]:
    """Cumulative probabilities of 0, 1, ..., 62, and a closing infinity."""
    term, total, cdf = math.exp(-mean), 0.0, []
    for k in range(63):
        total += term
        cdf.append(total)
        term *= mean / (k + 1)
    return [*cdf, math.inf]


def _poisson_window(mean: int) -> tuple[int, list[float]]:
    """First value and cumulative probabilities from it on; what lies outside has a
    probability below the grain of ``_uniform``."""
    reach = 10 * math.sqrt(mean) + 10
    first = max(0, math.floor(mean - reach))
    total, cdf = 0.0, []
    for k in range(first, math.ceil(mean + reach)):
        total += math.exp(k * math.log(mean) - mean - math.lgamma(k + 1))
        cdf.append(total)
    return first, cdf


def _uniform(*parts: Column) -> Column:
    """Repeatable uniform in (0, 1) from a hash, so a retried task draws the same."""
    return (F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))


def _up_to(cdf: Column, size: int, u: Column) -> Column:
    """How many of the ``size`` cumulative probabilities are at most u, by binary search."""
    steps = [1 << k for k in reversed(range(size.bit_length()))]
    return F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda found, step: F.when((found + step <= size) & (F.get(cdf, found + step - 1) <= u), found + step).otherwise(found),
    )


def _poisson_draw(mean: int, *parts: Column) -> Column:
    first, cdf = _poisson_window(mean)
    table = F.expr(f"array({', '.join(f'{p!r}D' for p in cdf)})")
    return (F.lit(first) + _up_to(table, len(cdf), _uniform(*parts))).cast("long")


def _poisson_weight(n: Column, *parts: Column) -> Column:
    """Poisson(n) draw of a cell: how often its n rows enter a resample together."""
    n = n.cast("long")
    small = F.when(n <= _EXACT_POISSON, n).otherwise(n % _POWERS[0]).cast("int")
    tables = F.array(*[F.array(*[F.lit(p) for p in _poisson_cdf(m)]) for m in range(1, _EXACT_POISSON + 1)])
    cdf = F.element_at(tables, F.greatest(small, F.lit(1)))
    rest = F.when(small == 0, F.lit(0)).otherwise(_up_to(cdf, 63, _uniform(*parts, F.lit(1)))).cast("long")
    powers = [F.when(n.bitwiseAND(F.lit(m)) != 0, _poisson_draw(m, *parts, F.lit(m))).otherwise(F.lit(0).cast("long")) for m in _POWERS]
    blocks = F.when(n < _BLOCK, F.lit(0).cast("long")).otherwise(
        F.aggregate(
            F.sequence(F.lit(1).cast("long"), F.floor(n / _BLOCK)),
            F.lit(0).cast("long"),
            lambda total, k: total + _poisson_draw(_BLOCK, *parts, F.lit(_BLOCK), k),
        )
    )
    return F.when(n <= _EXACT_POISSON, rest).otherwise(sum(powers, rest + blocks))


def bootstrap_intervals(
    df: DataFrame,
    score: str,
    bad: Column,
    rounds: int = 200,
    seed: int = 42,
    alpha: float = 0.05,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Percentile intervals of AUC, KS, average precision and Brier score.

    A Poisson bootstrap on (score, label) cells: all rows of a cell are alike, so one
    exact Poisson(count) weight replaces their individual draws and the work grows with
    distinct scores times rounds (and rows / 4096 times rounds), not with rows times rounds. Average precision folds
    ties. Percentiles use the positions int(α/2·m) and int((1-α/2)·m) - 1.
    """
    cells = stage(
        df.where(F.col(score).isNotNull())
        .groupBy(*keys, F.col(score).cast("double").alias("score"))
        .agg(F.count("*").alias("rows"), F.coalesce(F.sum(bad.cast("long")), F.lit(0)).alias("bads"))
    )
    # Round 0 is the estimate on the original counts.
    drawn = cells.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds))))
    parts = [F.lit(seed), *[F.col(k) for k in keys], F.col("round"), F.col("score")]
    goods = F.col("rows") - F.col("bads")

    def weight(n: Column, tag: int) -> Column:
        return F.when(F.col("round") == 0, n).when(n == 0, F.lit(0)).otherwise(_poisson_weight(n, *parts, F.lit(tag)))

    # Written once, so the draws are not repeated by the range sampling that follows.
    weighted = stage(
        drawn.select(*keys, "round", "score", weight(F.col("bads"), 1).alias("bad"), weight(goods, 0).alias("good"))
    ).withColumn("n", F.col("bad") + F.col("good"))
    ranked = prefix_sums(weighted.where("n > 0"), [*keys, "round"], ["-score"], ["n", "bad"])
    b, g = F.col("tot_bad"), F.col("tot_n") - F.col("tot_bad")
    middle = F.col("tot_n") - F.col("cum_n") + (F.col("n") + 1) / F.lit(2.0)
    square = F.col("bad") * F.pow(F.col("score") - 1, F.lit(2)) + F.col("good") * F.pow("score", F.lit(2))
    per = ranked.groupBy(*keys, "round").agg(
        F.max(F.abs(ratio(F.col("cum_bad"), b) - ratio(F.col("cum_n") - F.col("cum_bad"), g))).alias("ks"),
        F.max(b).alias("b"),
        F.max(g).alias("g"),
        F.sum(F.col("bad") * middle).alias("rank_sum"),
        ratio(F.sum(F.col("bad") * F.col("cum_bad") / F.col("cum_n")), F.max(b)).alias("pr_auc"),
        (F.sum(square) / F.max("tot_n")).alias("brier_score"),
    )
    auc = F.when(
        (F.col("b") > 0) & (F.col("g") > 0),
        (F.col("rank_sum") - F.col("b").cast("double") * (F.col("b") + 1) / F.lit(2.0)) / (F.col("b").cast("double") * F.col("g")),
    )
    metrics = ("auc", "ks", "pr_auc", "brier_score")
    long = per.withColumn("auc", auc).select(
        *keys, "round", F.stack(F.lit(4), *[x for m in metrics for x in (F.lit(m), F.col(m))]).alias("metric", "value")
    )
    # rounds-sized from here on
    values = F.array_sort(F.collect_list(F.when(F.col("round") > 0, F.col("value"))))
    m = F.size("values")
    low = F.greatest(F.lit(0), F.least(m - 1, F.floor(F.lit(alpha / 2) * m).cast("int")))
    high = F.greatest(F.lit(0), F.least(m - 1, F.floor(F.lit(1 - alpha / 2) * m).cast("int") - 1))
    return (
        long.where("value is not null")
        .groupBy(*keys, "metric")
        .agg(F.max(F.when(F.col("round") == 0, F.col("value"))).alias("estimate"), values.alias("values"))
        .where(m > 0)
        .select(
            *keys,
            "metric",
            "estimate",
            F.element_at("values", low + 1).alias("lower"),
            F.element_at("values", high + 1).alias("upper"),
            m.alias("rounds"),
        )
    )
