"""Bins: fit edges and categories, count per bin, WOE / IV / binned KS.

Fitted bins are feature-sized and live on the driver. Applying them unpivots the rows
inside the scan, compares each cell with the edges of its feature, and counts map-side:
a wide table is binned in one pass that shuffles only (feature, bin) cells.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oddlens.functions.columns import clean_number, edge_bin, is_numeric, ratio
from oddlens.functions.ranking import prefix_sums
from oddlens.operators.counts import (
    BATCH,
    feature_name,
    number_cells,
    numbered,
    split_types,
    text_cells,
    typed_counts,
    value_counts,
)
from oddlens.sources.stages import stage

MISSING = -1
SMOOTHING = 0.5
METHODS = ("quantile", "distinct", "linear", "approx", "chi")


@dataclass(frozen=True)
class NumericBins:
    edges: tuple[float, ...]
    side: str = "right"

    def index(self, column: str) -> Column:
        return edge_bin(clean_number(F.col(column)), self.edges, self.side)

    def labels(self) -> list[str]:
        if not self.edges:
            return ["all"]
        ends = [f"{e:.6g}" for e in self.edges]
        lows = ["-inf", *ends]
        highs = [f"{e}]" for e in ends] + ["inf)"]
        return [f"({low}, {high}" for low, high in zip(lows, highs)]


@dataclass(frozen=True)
class CategoryBins:
    values: tuple[str, ...]
    has_other: bool = False

    def index(self, column: str) -> Column:
        text = F.col(column).cast("string")
        place = F.array_position(F.array(*[F.lit(v) for v in self.values]), text) if self.values else F.lit(0)
        known = F.when(place > 0, (place - 1).cast("int")).otherwise(F.lit(len(self.values)))
        return F.when(text.isNotNull(), known)

    def labels(self) -> list[str]:
        return [*self.values, *(["OTHER"] if self.has_other else [])]


Bins = Mapping[str, NumericBins | CategoryBins]


def ranked_values(df: DataFrame, features: Sequence[str], bad: Column, by: Sequence[str] = ()) -> DataFrame:
    """Value counts of numeric features with running and total counts per key.

    Columns: ``*by, feature, num, n, bad, distinct`` and ``cum_`` / ``tot_`` of each.
    """
    counts = (
        value_counts(df, features, bad, by)
        .where(F.col("num").isNotNull())
        .drop("txt")
        .withColumn("distinct", F.lit(1).cast("long"))
    )
    return prefix_sums(counts, [*by, "feature"], ["num"], ["n", "bad", "distinct"])


def _holds(rank: Column, weight: str) -> Column:
    """Does the value row cover this 0-based position of the sorted values?"""
    last = F.col(f"cum_{weight}")
    return (rank >= last - F.col(weight)) & (rank < last)


def _half_even(top: str, bottom: int) -> Column:
    """``top / bottom`` rounded half-even, in whole numbers (``top`` is SQL text)."""
    whole, rest = F.expr(f"({top}) div {bottom}"), F.expr(f"2 * (({top}) % {bottom})")
    return whole + F.when(rest > bottom, 1).when(rest == bottom, whole % 2).otherwise(0)


def ranked_edges(ranked: DataFrame, bins: int, keys: Sequence[str] = ("feature",), weight: str = "n") -> DataFrame:
    """Edges that are data values at the half-even rounded positions i(n-1)/bins.

    ``weight="n"`` walks all values, ``weight="distinct"`` walks distinct values. A
    short range test drops nearly all rows first; the exact positions are then looked
    up in the few candidate rows of each key.
    """
    high, total = F.col(f"cum_{weight}"), F.col(f"tot_{weight}")
    low = high - F.col(weight)
    scale = F.lit(float(bins)) / (total - 1)
    near = F.when(total > 1, F.floor((high - 0.4) * scale) >= F.ceil((low - 0.6) * scale)).otherwise(weight == "n")
    candidates = (
        ranked.select(*keys, "num", low.alias("low"), high.alias("high"), total.alias("total"), near.alias("near"))
        .where("near")
        .groupBy(*keys)
        .agg(F.max("total").alias("total"), F.collect_list(F.struct("num", "low", "high")).alias("rows"))
    )
    places = F.array(*[_half_even(f"(total - 1) * {i}", bins) for i in range(1, bins)])
    held = F.filter("rows", lambda r: F.exists("places", lambda p: (p >= r["low"]) & (p < r["high"])))
    return candidates.withColumn("places", places).select(
        *keys, F.array_sort(F.array_distinct(F.transform(held, lambda r: r["num"]))).alias("edges")
    )


def ranked_quantiles(ranked: DataFrame, probabilities: Sequence[float], keys: Sequence[str] = ("feature",)) -> DataFrame:
    """Exact linearly interpolated quantiles as an array, from ranked values.

    Spark's ``percentile`` keeps every distinct value of a group in one buffer; here
    each quantile needs only the two values around its position.
    """
    last = F.col("tot_n") - 1
    aggs, cells = [], []
    for i, p in enumerate(probabilities):
        position = last * F.lit(float(p))
        aggs.append(F.max(F.when(_holds(F.floor(position), "n"), F.col("num"))).alias(f"lo{i}"))
        aggs.append(F.max(F.when(_holds(F.ceil(position), "n"), F.col("num"))).alias(f"hi{i}"))
        aggs.append(F.max(position - F.floor(position)).alias(f"w{i}"))
        cells.append(F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"w{i}"))
    return ranked.groupBy(*keys).agg(*aggs).select(*keys, F.array(*cells).alias("quantiles"))


def medians(df: DataFrame, features: Sequence[str]) -> dict[str, float | None]:
    """Exact median of each numeric feature (feature-sized result)."""
    ranked = ranked_values(df, features, F.lit(0))
    rows = ranked_quantiles(ranked, [0.5]).collect()
    return {f: None for f in features} | {r.feature: r.quantiles[0] for r in rows}


def fill_medians(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Replace missing numbers by the column median; an empty column stays null."""
    found = medians(df, features)
    return df.withColumns(
        {
            f: clean_number(F.col(f)) if m is None else F.coalesce(clean_number(F.col(f)), F.lit(m))
            for f, m in found.items()
        }
    )


def fit_category_bins(df: DataFrame, features: Sequence[str], max_categories: int = 20) -> dict[str, CategoryBins]:
    """Most frequent values by (count desc, value asc); the rest shares OTHER."""
    if not features:
        return {}
    keep = max(1, max_categories - 1)
    place = F.row_number().over(Window.partitionBy("feature").orderBy(F.desc("n"), "txt"))
    # The limit is applied inside each task before the shuffle (one extra row tells
    # whether OTHER exists), so no feature is ever collected whole.
    top = (
        value_counts(df, features)
        .where(F.col("txt").isNotNull())
        .withColumn("place", place)
        .where(F.col("place") <= keep + 1)
        .select("feature", "txt", "place")
    )
    found: dict[str, list[tuple[int, str]]] = {f: [] for f in features}
    for row in top.collect():
        found[row.feature].append((row.place, row.txt))
    return {
        f: CategoryBins(tuple(v for _, v in sorted(pairs)[:keep]), len(pairs) > keep)
        for f, pairs in found.items()
    }


def fit_bins(
    df: DataFrame,
    features: Sequence[str],
    bins: int = 10,
    max_categories: int = 20,
    method: str = "quantile",
    bad: Column | None = None,
    side: str = "right",
    ranked: DataFrame | None = None,
    fine: int = 100,
) -> dict[str, NumericBins | CategoryBins]:
    """Fit every feature. ``quantile`` and ``distinct`` edges are data values,
    ``linear`` edges are interpolated, ``approx`` edges come from one sketch pass,
    ``chi`` merges at most ``fine`` quantile bins by their chi-square statistic."""
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    numeric, categorical = split_types(df, features)
    edges: dict[str, tuple[float, ...]] = {f: () for f in numeric}
    if numeric and method == "approx":
        edges |= _approx_edges(df, numeric, bins)
    elif numeric and method == "chi":
        if bad is None:
            raise ValueError("chi-square bins need the bad label")
        edges |= _chi_edges(df, numeric, bins, bad, fine)
    elif numeric:
        if ranked is None:
            ranked = ranked_values(df, numeric, F.lit(0))
        if method == "linear":
            wanted = [i / bins for i in range(1, bins)]
            rows = ranked_quantiles(ranked, wanted).withColumnRenamed("quantiles", "edges")
        else:
            rows = ranked_edges(ranked, bins, weight="n" if method == "quantile" else "distinct")
        edges |= {r.feature: tuple(sorted(set(r.edges))) for r in rows.collect()}
    fitted: dict[str, NumericBins | CategoryBins] = {f: NumericBins(e, side) for f, e in edges.items()}
    fitted.update(fit_category_bins(df, categorical, max_categories))
    return {f: fitted[f] for f in features}


def _approx_edges(df: DataFrame, features: Sequence[str], bins: int, accuracy: int = 10_000) -> dict:
    """Sketch quantiles: one scan, one mergeable sketch per feature, no value shuffle."""
    wanted = [i / bins for i in range(1, bins)]
    found = {}
    for start in range(0, len(features), BATCH):
        batch = features[start : start + BATCH]
        row = df.agg(
            *[F.approx_percentile(clean_number(F.col(f)), wanted, accuracy).alias(f"e{i}") for i, f in enumerate(batch)]
        ).first()
        found.update({f: tuple(sorted(set(row[f"e{i}"] or []))) for i, f in enumerate(batch)})
    return found


def _chi_edges(
    df: DataFrame, features: Sequence[str], bins: int, bad: Column, fine: int, min_share: float = 0.01
) -> dict:
    """Merge at most ``fine`` quantile bins per feature down to ``bins``.

    Edges are data values, so the ranked values at them hold the counts below each edge
    (a value at an edge is in the bin above it): the rows are not read again. Only the contingency tables (at most ``fine`` rows each)
    enter the per-feature merge.
    """
    ranked = ranked_values(df, features, bad)
    start = fit_bins(df, features, fine, method="quantile", ranked=ranked)
    limits = local_frame(df, pd.DataFrame([(f, e) for f, b in start.items() for e in b.edges], columns=["feature", "num"]))
    limits = limits.select(F.col("feature").cast("string"), F.col("num").cast("double"))
    ends = ranked.join(limits, ["feature", "num"]).select("feature", F.col("num").alias("edge"), (F.col("cum_n") - F.col("n")).alias("n"), (F.col("cum_bad") - F.col("bad")).alias("bad"))
    whole = ranked.groupBy("feature").agg(F.lit(None).cast("double").alias("edge"), F.max("tot_n").alias("n"), F.max("tot_bad").alias("bad"))
    path = Window.partitionBy("feature").orderBy(F.col("edge").isNull(), "edge")
    own = [(F.col(c) - F.lag(c, 1, 0).over(path)).alias(c) for c in ("n", "bad")]
    table = ends.unionByName(whole).select("feature", "edge", F.row_number().over(path).alias("bin"), *own).where("n > 0")

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"feature": part.feature.iloc[0], "edge": chi_merge(part, bins, min_share)})

    rows = table.groupBy("feature").applyInPandas(merge, "feature string, edge double").collect()
    found: dict[str, list[float]] = {f: [] for f in features}
    for row in rows:
        found[row.feature].append(row.edge)
    return {f: tuple(sorted(e)) for f, e in found.items()}


def chi_merge(part: pd.DataFrame, bins: int, min_share: float) -> list[float]:
    """Join adjacent bins of one contingency table (``bin, n, bad, edge``) while the
    pair with the smallest chi-square is joined first; then join bins that are too
    small. Returns the upper edges that are left."""
    rows = [[float(r.n - r.bad), float(r.bad), r.edge] for r in part.sort_values("bin").itertuples()]
    floor = min_share * sum(r[0] + r[1] for r in rows)

    def statistic(a: list, b: list) -> float:
        total = a[0] + a[1] + b[0] + b[1]
        value = 0.0
        for c in (0, 1):
            column = a[c] + b[c]
            for r in (a, b):
                expected = (r[0] + r[1]) * column / total if total else 0.0
                value += (r[c] - expected) ** 2 / expected if expected else 0.0
        return value

    def join(i: int) -> None:
        rows[i : i + 2] = [[rows[i][0] + rows[i + 1][0], rows[i][1] + rows[i + 1][1], rows[i + 1][2]]]

    while len(rows) > bins:
        join(min(range(len(rows) - 1), key=lambda i: statistic(rows[i], rows[i + 1])))
    while len(rows) > 1:
        small = min(range(len(rows)), key=lambda i: rows[i][0] + rows[i][1])
        if rows[small][0] + rows[small][1] >= floor:
            break
        left = statistic(rows[small - 1], rows[small]) if small else float("inf")
        right = statistic(rows[small], rows[small + 1]) if small + 1 < len(rows) else float("inf")
        join(small - 1 if left <= right else small)
    return [r[2] for r in rows[:-1] if r[2] is not None and r[2] == r[2]]


def local_frame(df: DataFrame, data: pd.DataFrame | pa.Table) -> DataFrame:
    """A driver-made table (feature- or bin-sized) whose size the planner knows."""
    if isinstance(data, pd.DataFrame):
        data = pa.Table.from_pandas(data, preserve_index=False)
    return df.sparkSession.createDataFrame(data)


def _numeric_index(df: DataFrame, cells: DataFrame, features: dict[int, str], bins: Bins) -> DataFrame:
    """Add ``bin`` to number cells by joining each feature's edges as plain columns.

    The edge table is made on the driver, one row per feature, so its size is known;
    comparing a value with padded edge columns is one short expression whatever the
    number of features, which keeps the generated code small enough to be compiled.
    """
    width = max(len(bins[f].edges) for f in features.values())
    table = pd.DataFrame(
        [[i, bins[f].side == "left", *bins[f].edges, *[math.inf] * (width - len(bins[f].edges))] for i, f in features.items()],
        columns=["fid", "left_side", *[f"__e{k}" for k in range(width)]],
    ).astype({"fid": "int32"})
    value = F.col("num")
    edges = [F.col(f"__e{k}") for k in range(width)]
    sides = {bins[f].side for f in features.values()}

    def count(side: str) -> Column:
        hits = [(value >= e if side == "right" else value > e).cast("int") for e in edges]
        return reduce(lambda a, b: a + b, hits, F.lit(0))

    if len(sides) == 1:
        index = count(sides.pop())
    else:
        index = F.when(F.col("left_side"), count("left")).otherwise(count("right"))
    joined = cells.join(local_frame(df, table), "fid")
    kept = [c for c in cells.columns if c != "num"]
    return joined.select(*kept, F.when(value.isNotNull(), index).alias("bin"))


def _category_index(df: DataFrame, cells: DataFrame, features: dict[int, str], bins: Bins) -> DataFrame:
    """Add ``bin`` to text cells by joining the listed values of each feature."""
    rows = [(i, v, k) for i, f in features.items() for k, v in enumerate(bins[f].values)]
    table = pa.table(
        {
            "fid": pa.array([r[0] for r in rows], pa.int32()),
            "txt": pa.array([r[1] for r in rows], pa.string()),
            "place": pa.array([r[2] for r in rows], pa.int32()),
        }
    )
    others = F.create_map(*[F.lit(x) for i, f in features.items() for x in (i, len(bins[f].values))])
    known = cells.join(local_frame(df, table), ["fid", "txt"], "left")
    index = F.when(F.col("txt").isNotNull(), F.coalesce("place", others[F.col("fid")]))
    kept = [c for c in cells.columns if c != "txt"]
    return known.select(*kept, index.alias("bin"))


def _indexed(df: DataFrame, bins: Bins, keep: Sequence[Column]) -> DataFrame:
    """``(*keep, fid, bin)`` for every cell, null bin where the value is missing."""
    names = list(bins)
    numbers = numbered(names, [f for f in names if isinstance(bins[f], NumericBins)])
    texts = numbered(names, [f for f in names if isinstance(bins[f], CategoryBins)])
    frames = []
    if numbers:
        frames.append(_numeric_index(df, number_cells(df, numbers, keep), numbers, bins))
    if texts:
        frames.append(_category_index(df, text_cells(df, texts, keep), texts, bins))
    return reduce(DataFrame.unionByName, frames)


def bin_counts(df: DataFrame, bins: Bins, bad: Column, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, feature, bin) → n, bad``; missing values are bin -1.

    Cells are counted map-side, so only (feature, bin) cells are shuffled.
    """
    keep = [*[F.col(c) for c in by], bad.cast("long").alias("__bad")]
    counts = (
        _indexed(df, bins, keep)
        .groupBy(*by, "fid", F.coalesce("bin", F.lit(MISSING)).alias("bin"))
        .agg(F.count("*").alias("n"), F.coalesce(F.sum("__bad"), F.lit(0)).alias("bad"))
    )
    return counts.select(*by, feature_name(list(bins)), "bin", "n", "bad")


def score_cells(df: DataFrame, bins: Bins, keep: Sequence[Column | str]) -> DataFrame:
    """``(*keep, fid, num)``: the number itself, or the bin index of a category."""
    kept = [F.col(k) if isinstance(k, str) else k for k in keep]
    names = list(bins)
    numbers = numbered(names, [f for f in names if isinstance(bins[f], NumericBins)])
    texts = numbered(names, [f for f in names if isinstance(bins[f], CategoryBins)])
    frames = []
    if numbers:
        frames.append(number_cells(df, numbers, kept))
    if texts:
        part = _category_index(df, text_cells(df, texts, kept), texts, bins)
        frames.append(part.withColumn("num", F.col("bin").cast("double")).drop("bin"))
    return reduce(DataFrame.unionByName, frames)


def bin_labels(df: DataFrame, bins: Bins) -> DataFrame:
    rows = [(f, MISSING, "MISSING") for f in bins]
    rows += [(f, i, label) for f, b in bins.items() for i, label in enumerate(b.labels())]
    return local_frame(df, pd.DataFrame(rows, columns=["feature", "bin", "label"]).astype({"bin": "int32"}))


def bin_detail(counts: DataFrame, labels: DataFrame | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """WOE / IV / KS per bin from bin counts (all windows here are bin-sized).

    Missing cells count in IV and in the totals but not in the KS path.
    """
    keys = [*keys, "feature"]
    whole = Window.partitionBy(*keys)
    path = whole.orderBy(F.col("bin") < 0, "bin")
    run = path.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    good = F.col("n") - F.col("bad")
    base = counts.select(
        *keys,
        "bin",
        F.col("n").alias("sample_count"),
        F.col("bad").alias("bad_count"),
        good.alias("good_count"),
        F.row_number().over(path).alias("bin_order"),
        F.count("*").over(whole).alias("cells"),
        F.sum("n").over(whole).alias("total"),
        F.sum("bad").over(whole).alias("total_bad"),
        F.sum("bad").over(run).alias("cum_bad"),
        F.sum(good).over(run).alias("cum_good"),
    ).withColumn("total_good", F.col("total") - F.col("total_bad"))
    pad = F.lit(SMOOTHING)
    bad_share = (F.col("bad_count") + pad) / (F.col("total_bad") + pad * F.col("cells"))
    good_share = (F.col("good_count") + pad) / (F.col("total_good") + pad * F.col("cells"))
    zero = F.lit(0.0)
    gap = F.abs(
        F.coalesce(ratio(F.col("cum_bad"), F.col("total_bad")), zero)
        - F.coalesce(ratio(F.col("cum_good"), F.col("total_good")), zero)
    )
    detail = base.withColumns(
        {
            "sample_rate": ratio(F.col("sample_count"), F.col("total")),
            "bad_rate": ratio(F.col("bad_count"), F.col("sample_count")),
            "bad_distribution": F.coalesce(ratio(F.col("bad_count"), F.col("total_bad")), zero),
            "good_distribution": F.coalesce(ratio(F.col("good_count"), F.col("total_good")), zero),
            "woe": F.ln(bad_share / good_share),
            "iv_bin": (bad_share - good_share) * F.ln(bad_share / good_share),
            "ks": F.when(F.col("bin") >= 0, gap),
        }
    )
    ordered = Window.partitionBy(*keys).orderBy("bin_order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    detail = detail.withColumns(
        {
            "cumulative_iv": F.sum("iv_bin").over(ordered),
            "cumulative_ks": F.coalesce(F.max("ks").over(ordered), zero),
        }
    )
    if labels is not None:
        detail = detail.join(labels, ["feature", "bin"], "left")
    else:
        detail = detail.withColumn("label", F.lit(None).cast("string"))
    return detail.select(
        *keys,
        "bin_order",
        "bin",
        "label",
        "sample_count",
        "sample_rate",
        "bad_count",
        "good_count",
        "bad_rate",
        "bad_distribution",
        "good_distribution",
        "woe",
        "iv_bin",
        "cumulative_iv",
        "ks",
        "cumulative_ks",
    )


def bin_summary(detail: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """IV, binned KS, bin count, missing rate and bin entropy (bits) per feature."""
    share = F.col("sample_rate")
    return detail.groupBy(*keys, "feature").agg(
        F.sum("iv_bin").alias("iv"),
        F.max("cumulative_ks").alias("ks"),
        F.count("*").alias("bin_count"),
        F.coalesce(F.sum(F.when(F.col("bin") == MISSING, share)), F.lit(0.0)).alias("missing_rate"),
        (-F.sum(F.when(share > 0, share * F.log2(share)))).alias("entropy"),
    )


def value_entropy(df: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Entropy (bits) of all values per feature; missing counts as one value.

    Uses H = log2(N) - Σ n·log2(n) / N, so one combinable pass over the counts.
    """
    n = F.col("n")
    return (
        typed_counts(df, features, by)
        .groupBy(*by, "feature")
        .agg((F.log2(F.sum(n)) - F.sum(n * F.log2(n)) / F.sum(n)).alias("entropy"))
    )


def column_moments(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Type, mean and sample deviation per feature, null for non-numeric ones."""
    frames = []
    for start in range(0, len(features), BATCH):
        batch = features[start : start + BATCH]
        aggs, cells = [], []
        for i, f in enumerate(batch):
            value = clean_number(F.col(f)) if is_numeric(df.schema[f].dataType) else F.lit(None).cast("double")
            aggs += [F.avg(value).alias(f"m{i}"), F.stddev_samp(value).alias(f"s{i}")]
            cells.append(
                F.struct(
                    F.lit(f).alias("feature"),
                    F.lit(df.schema[f].dataType.simpleString()).alias("variable_type"),
                    F.col(f"m{i}").alias("mean"),
                    F.col(f"s{i}").alias("std"),
                )
            )
        frames.append(df.agg(*aggs).select(F.inline(F.array(*cells))))
    return reduce(DataFrame.unionByName, frames)
