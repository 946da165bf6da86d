"""The one wide-to-long step: value counts per feature.

Rows are unpivoted and aggregated in the same stage, so map-side combining happens
before the shuffle and a value shared by a third of all rows costs one row per task.
Distinct counts, dominant values, quantile edges, KS, AUC, entropy and ranks all
start from these counts, so later work grows with distinct values, not with rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddlens.functions.columns import clean_number, is_numeric

# Columns unpivoted per scan; Parquet reads only the columns of the current batch.
BATCH = 100


def split_types(df: DataFrame, features: Sequence[str]) -> tuple[list[str], list[str]]:
    """Numeric features, and all others (which are treated as categories)."""
    numeric = [f for f in features if is_numeric(df.schema[f].dataType)]
    return numeric, [f for f in features if f not in numeric]


def _unpivot(df: DataFrame, features: dict[int, str], kind: str, value: str, keep: Sequence[Column]) -> DataFrame:
    """Long rows ``(*keep, fid, value)`` through Spark's Expand operator.

    Features travel as small integers: they are hashed and compared far more cheaply
    than names, which are put back after the rows have been aggregated.
    """
    frames = []
    items = list(features.items())
    for start in range(0, len(items), BATCH):
        batch = items[start : start + BATCH]
        wide = df.select(*keep, *[F.col(name).cast(kind).alias(str(i)) for i, name in batch])
        kept = wide.columns[: len(wide.columns) - len(batch)]
        long = wide.unpivot(kept, [str(i) for i, _ in batch], "fid", value)
        frames.append(long.withColumn("fid", F.col("fid").cast("int")))
    return reduce(DataFrame.unionByName, frames)


def number_cells(df: DataFrame, features: dict[int, str], keep: Sequence[Column] = ()) -> DataFrame:
    """``(*keep, fid, num)``; NaN and ±inf become null."""
    return _unpivot(df, features, "double", "num", keep).withColumn("num", clean_number(F.col("num")))


def text_cells(df: DataFrame, features: dict[int, str], keep: Sequence[Column] = ()) -> DataFrame:
    """``(*keep, fid, txt)``"""
    return _unpivot(df, features, "string", "txt", keep)


def numbered(features: Sequence[str], chosen: Sequence[str]) -> dict[int, str]:
    """Positions of the chosen features within all features."""
    wanted = set(chosen)
    return {i: f for i, f in enumerate(features) if f in wanted}


def feature_name(features: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(f) for f in features]), F.col("fid") + 1).alias("feature")


def long_cells(df: DataFrame, features: Sequence[str], keep: Sequence[Column | str] = ()) -> DataFrame:
    """One row per (row, feature): ``fid, num, txt`` plus the kept columns."""
    if not features:
        raise ValueError("at least one feature is needed")
    kept = [F.col(k) if isinstance(k, str) else k for k in keep]
    numeric, text = split_types(df, features)
    frames = []
    if numeric:
        frames.append(number_cells(df, numbered(features, numeric), kept).withColumn("txt", F.lit(None).cast("string")))
    if text:
        frames.append(text_cells(df, numbered(features, text), kept).withColumn("num", F.lit(None).cast("double")))
    return reduce(DataFrame.unionByName, frames)


_WHOLE = {"byte", "short", "integer", "long"}


def typed_cells(df: DataFrame, features: Sequence[str], keep: Sequence[Column | str] = ()) -> DataFrame:
    """``(*keep, fid, num, whole, dec, txt)``: like ``long_cells``, but values keep their type.

    Whole numbers travel as 64-bit integers in ``whole`` and decimals by their digits in
    ``dec``, since a double does not tell large ones apart; ``num`` is the nearest double
    of either, for order and range.
    """
    if not features:
        raise ValueError("at least one feature is needed")
    kept = [F.col(k) if isinstance(k, str) else k for k in keep]
    groups: dict[str, list[str]] = {"whole": [], "dec": [], "num": [], "txt": []}
    for f in features:
        kind = df.schema[f].dataType.typeName()
        groups["whole" if kind in _WHOLE else "dec" if kind == "decimal" else "num" if is_numeric(df.schema[f].dataType) else "txt"].append(f)
    kinds = {"num": "double", "whole": "bigint", "dec": "string", "txt": "string"}
    frames = []
    for column, chosen in groups.items():
        if chosen:
            long = _unpivot(df, numbered(features, chosen), kinds[column], column, kept)
            if column in ("whole", "dec"):
                long = long.withColumn("num", F.col(column).cast("double"))
            elif column == "num":
                long = long.withColumn("num", clean_number(F.col("num")))
            frames.append(long.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items() if c not in long.columns}))
    return reduce(DataFrame.unionByName, frames)


def typed_counts(df: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(*by, feature, num, whole, dec, txt) → n`` of exact values; a missing cell has only nulls."""
    features = list(features)
    counts = typed_cells(df, features, list(by)).groupBy(*by, "fid", "num", "whole", "dec", "txt").agg(F.count("*").alias("n"))
    return counts.select(*by, feature_name(features), "num", "whole", "dec", "txt", "n")


def value_counts(
    df: DataFrame,
    features: Sequence[str],
    bad: Column | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """``(*by, feature, num, txt) → n[, bad]``; a missing cell has both values null.

    Features without a value in any row still appear, through their missing cell.
    """
    features = list(features)
    label = [] if bad is None else [bad.cast("long").alias("__bad")]
    sums = [F.count("*").alias("n")]
    if bad is not None:
        sums.append(F.coalesce(F.sum("__bad"), F.lit(0)).alias("bad"))
    counts = long_cells(df, features, [*by, *label]).groupBy(*by, "fid", "num", "txt").agg(*sums)
    return counts.select(*by, feature_name(features), "num", "txt", *[c for c in ("n", "bad") if c in counts.columns])


def is_present() -> Column:
    return F.col("num").isNotNull() | F.col("txt").isNotNull()
