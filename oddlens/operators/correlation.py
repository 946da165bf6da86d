"""Pairwise correlation of numeric features: Pearson, Spearman, matrix, maxima."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddlens.functions.columns import clean_number, numeric_columns, ratio
from oddlens.functions.ranking import prefix_sums
from oddlens.operators.binning import fill_medians
from oddlens.operators.counts import BATCH, number_cells, value_counts
from oddlens.sources.stages import stage

# Most pairs of one aggregation in generated code; more are summed by matrix products.
PAIRS = 60


def _centres(df: DataFrame, features: Sequence[str]) -> tuple[int, dict[str, tuple[int, float]]]:
    """Row count, and per feature its value count and mean (one small row each)."""
    found: dict[str, tuple[int, float]] = {}
    rows = 0
    for start in range(0, len(features), BATCH):
        batch = features[start : start + BATCH]
        aggs = []
        for i, f in enumerate(batch):
            value = clean_number(F.col(f))
            aggs += [F.count(value).alias(f"n{i}"), F.avg(value).alias(f"m{i}")]
        row = df.agg(F.count("*").alias("rows"), *aggs).first()
        rows = row.rows
        found.update({f: (row[f"n{i}"], row[f"m{i}"] or 0.0) for i, f in enumerate(batch)})
    return rows, found


def _moment_pairs(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Pearson r of each pair of features from sums of centred values.

    Two passes at any width: means first, then products of centred values, so large
    offsets do not cancel. Partial sums are combined map-side: a task shuffles one row
    (few features) or one for each pair.
    """
    rows, centre = _centres(df, features)
    shifted = df.select(*[(clean_number(F.col(f)) - F.lit(centre[f][1])).alias(f"x{i}") for i, f in enumerate(features)])
    pairs = list(combinations(range(len(features)), 2))
    if len(pairs) <= PAIRS:
        sums = _pair_sums(shifted, pairs, {i for i, f in enumerate(features) if centre[f][0] == rows})
    else:
        sums = gram_sums(shifted)
    n, sx, sy, qx, qy = (F.col(c) for c in ("n", "sx", "sy", "qx", "qy"))
    spread = (qx - sx * sx / n) * (qy - sy * sy / n)
    # Rounding noise of a constant column must not look like spread.
    tiny = F.lit(1e-24) * F.greatest(qx * qy, F.lit(0.0))
    r = F.when(spread > tiny, (F.col("c") - sx * sy / n) / F.sqrt(spread)).otherwise(F.lit(0.0))
    return sums.where(n >= 2).select(*_named(features), r.alias("correlation"), n.alias("pair_count"))


def _named(features: Sequence[str]) -> list[Column]:
    """Names of the places ``i`` and ``j``."""
    names = F.array(*[F.lit(f) for f in features])
    return [F.element_at(names, F.col(k) + 1).alias(f"feature_{m}") for m, k in enumerate("ij", 1)]


_SUMS = "i int, j int, n long, sx double, sy double, qx double, qy double, c double"


def _pair_sums(shifted: DataFrame, pairs: Sequence[tuple[int, int]], full: set[int]) -> DataFrame:
    """One aggregation of all pairs; columns without nulls share their own sums."""
    aggs: dict[str, Column] = {}
    cells = []
    for p, (i, j) in enumerate(pairs):
        x, y = F.col(f"x{i}"), F.col(f"x{j}")
        if i in full and j in full:
            names = ("rows", f"s{i}", f"s{j}", f"q{i}", f"q{j}")
            aggs.setdefault("rows", F.count("*"))
            for k, v in ((i, x), (j, y)):
                aggs.setdefault(f"s{k}", F.sum(v))
                aggs.setdefault(f"q{k}", F.sum(v * v))
        else:
            both = x.isNotNull() & y.isNotNull()
            xx, yy = F.when(both, x), F.when(both, y)
            names = tuple(f"{m}_{p}" for m in ("n", "sx", "sy", "qx", "qy"))
            aggs |= dict(zip(names, (F.count(xx), F.sum(xx), F.sum(yy), F.sum(xx * xx), F.sum(yy * yy))))
        aggs[f"c_{p}"] = F.sum(x * y)
        sums = [F.col(c).alias(m) for c, m in zip((*names, f"c_{p}"), ("n", "sx", "sy", "qx", "qy", "c"))]
        cells.append(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), *sums))
    return shifted.agg(*[c.alias(a) for a, c in aggs.items()]).select(F.inline(F.array(*cells)))


def gram_sums(shifted: DataFrame) -> DataFrame:
    """The same sums by products of Arrow batches with their null masks: one scan at any width.

    A task holds four numbers for each pair of columns.
    """

    def products(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            has = ~np.isnan(x)
            x[~has] = 0.0
            m = has.astype(float)
            part = np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
            sums = part if sums is None else sums + part
        if sums is None:
            return
        n, s, q, c = sums
        i, j = np.triu_indices(len(n), 1)
        columns = [i.astype(np.int32), j.astype(np.int32), n[i, j].astype(np.int64), s[i, j], s[j, i], q[i, j], q[j, i], c[i, j]]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns], names=["i", "j", "n", "sx", "sy", "qx", "qy", "c"])

    parts = shifted.mapInArrow(products, _SUMS)
    return parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "qx", "qy", "c")])


def _finish(pairs: DataFrame, method: str) -> DataFrame:
    return pairs.select(
        "feature_1",
        "feature_2",
        F.lit(method).alias("method"),
        "correlation",
        F.abs("correlation").alias("abs_correlation"),
        "pair_count",
    ).orderBy(F.desc("abs_correlation"), "feature_1", "feature_2")


def pearson_pairs(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Pearson r over pairwise complete rows; zero variance gives 0.0."""
    numeric = numeric_columns(df, features)
    if len(numeric) < 2:
        raise ValueError("at least two numeric features are needed")
    return _finish(_moment_pairs(df, numeric), "pearson")


def average_ranks(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, num) → rank`` with average ranks for ties, from value counts."""
    counts = value_counts(df, features).where(F.col("num").isNotNull()).drop("txt")
    ranked = prefix_sums(counts, ["feature"], ["num"], ["n"])
    rank = F.col("cum_n") - F.col("n") + (F.col("n") + 1) / F.lit(2.0)
    return ranked.select("feature", "num", rank.alias("rank"))


def _centred_ranks(numbers: DataFrame, features: Sequence[str], gaps: Sequence[str]) -> DataFrame:
    """``(fid, num, n, ranks, tot)``: arrays with one entry for all rows of a feature, and one
    for its rows in which each feature of ``gaps`` has a value as well.

    ``n`` counts the value, ``ranks`` holds its average rank less the mean rank, ``tot``
    the rows. All of them come from one count of the values and one ranking.
    """
    sums = [f"__n{k}" for k in range(len(gaps) + 1)]
    marks = [F.lit(1).cast("long"), *[F.col(g).isNotNull().cast("long") for g in gaps]]
    cells = number_cells(numbers, dict(enumerate(features)), [m.alias(c) for m, c in zip(marks, sums, strict=True)])
    counts = cells.where("num is not null").groupBy("fid", "num").agg(*[F.sum(c).alias(c) for c in sums])
    ranked = prefix_sums(counts, ["fid"], ["num"], sums)
    return ranked.select(
        "fid",
        "num",
        F.array(*sums).alias("n"),
        F.array(*[(2 * F.col(f"cum_{c}") - F.col(c) - F.col(f"tot_{c}")) / F.lit(2.0) for c in sums]).alias("ranks"),
        F.array(*[F.col(f"tot_{c}") for c in sums]).alias("tot"),
    )


def _rank_products(rows: DataFrame, slots: Sequence[int]) -> DataFrame:
    """``(i, j, c)``: sums of products of two features' ranks, each among the complete rows of the pair.

    Row column k holds the ranks of feature k (null where it has no value); ``slots``
    tells where another feature's ranks for the rows with feature k lie.
    """
    at = np.array(slots)

    def products(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            ranks = np.zeros((batch.num_columns, batch.num_rows, at.max() + 1))
            for k, column in enumerate(batch.columns):
                has = column.is_valid().to_numpy(zero_copy_only=False)
                ranks[k, has] = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, ranks.shape[2])
            # Zeros stand for missing values, so incomplete rows add nothing.
            part = np.stack([np.einsum("rj,jr->j", ranks[i][:, at], ranks[:, :, at[i]]) for i in range(len(at))])
            sums = part if sums is None else sums + part
        if sums is None:
            return
        i, j = np.triu_indices(len(sums), 1)
        columns = [i.astype(np.int32), j.astype(np.int32), sums[i, j]]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns], names=["i", "j", "c"])

    return rows.mapInArrow(products, "i int, j int, c double").groupBy("i", "j").agg(F.sum("c").alias("c"))


def spearman_pairs(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Spearman r; ranks are taken inside the complete rows of each pair.

    One ranking and one pass over the rows serve all pairs: a value's ranks travel as an
    array, with an entry for each feature that has missing values, since the complete rows
    of a pair are the feature's own rows in which the other one has a value. Ranks are
    written per feature, so each join sees the real size of its own rank table: Spark
    broadcasts small ones and shuffles large ones with skew splitting. A row carries
    (features) x (1 + features with missing values) numbers.
    """
    numeric = numeric_columns(df, features)
    if len(numeric) < 2:
        raise ValueError("at least two numeric features are needed")
    rows, centre = _centres(df, numeric)
    gaps = [f for f in numeric if centre[f][0] < rows]
    slots = [gaps.index(f) + 1 if f in gaps else 0 for f in numeric]
    numbers = df.select(*[clean_number(F.col(f)).alias(f) for f in numeric])
    ranks = stage(_centred_ranks(numbers, numeric, gaps), partition_by=["fid"])

    result = numbers.select(*[F.col(f).alias(f"x{k}") for k, f in enumerate(numeric)])
    for k in range(len(numeric)):
        own = ranks.where(F.col("fid") == k).select(F.col("num").alias(f"x{k}"), F.col("ranks").alias(f"r{k}"))
        result = result.join(own, f"x{k}", "left")
    products = _rank_products(result.select(*[f"r{k}" for k in range(len(numeric))]), slots)

    width = range(len(gaps) + 1)
    per_slot = ranks.groupBy("fid").agg(
        F.array(*[F.sum(F.col("n")[k] * F.col("ranks")[k] * F.col("ranks")[k]) for k in width]).alias("q"),
        F.max("tot").alias("tot"),
    )
    spread = stage(per_slot.select("fid", F.arrays_zip("q", "tot").alias("spread")))  # one row for each feature
    slot = F.array(*[F.lit(s) for s in slots])
    for k in "ij":
        products = products.join(spread.select(F.col("fid").alias(k), F.col("spread").alias(f"of_{k}")), k)
    one = F.element_at("of_i", F.element_at(slot, F.col("j") + 1) + 1)
    other = F.element_at("of_j", F.element_at(slot, F.col("i") + 1) + 1)
    both = one["q"] * other["q"]
    r = F.when(both > 0, F.col("c") / F.sqrt(both)).otherwise(F.lit(0.0))
    found = products.where(one["tot"] >= 2).select(*_named(numeric), r.alias("correlation"), one["tot"].alias("pair_count"))
    return _finish(found, "spearman")


def correlation_pairs(df: DataFrame, features: Sequence[str], method: str = "pearson") -> DataFrame:
    if method not in {"pearson", "spearman"}:
        raise ValueError("method must be 'pearson' or 'spearman'")
    return pearson_pairs(df, features) if method == "pearson" else spearman_pairs(df, features)


def filled_pairs(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Pearson pairs after filling missing numbers with the column median."""
    numeric = numeric_columns(df, features)
    return pearson_pairs(fill_medians(df.select(*numeric), numeric), numeric)


def both_directions(pairs: DataFrame) -> DataFrame:
    """Each pair seen from either feature."""
    ends = F.array(
        F.struct(F.col("feature_1").alias("feature"), F.col("feature_2").alias("other")),
        F.struct(F.col("feature_2").alias("feature"), F.col("feature_1").alias("other")),
    )
    return pairs.select(F.inline(ends), "correlation", "abs_correlation")


def correlation_matrix(pairs: DataFrame, features: Sequence[str]) -> DataFrame:
    """Square matrix with 1.0 on the diagonal; pairs without data stay null."""
    wide = both_directions(pairs).groupBy("feature").pivot("other", list(features)).agg(F.max("correlation"))
    return wide.select(
        "feature", *[F.when(F.col("feature") == f, F.lit(1.0)).otherwise(F.col(f"`{f}`")).alias(f) for f in features]
    )


def max_correlation(pairs: DataFrame) -> DataFrame:
    """Largest |r| of each feature, leaving out |r| >= .999999 as the rule has it."""
    return (
        both_directions(pairs)
        .groupBy("feature")
        .agg(F.coalesce(F.max(F.when(F.col("abs_correlation") < 0.999999, F.col("abs_correlation"))), F.lit(0.0)).alias("max_correlation"))
    )
