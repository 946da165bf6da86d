"""Cumulative sums over a total order, without a one-partition window.

A plain ``Window.orderBy`` moves the whole table into one task, and a window per
feature or per data set moves one hot group into one task. Here the rows are range
partitioned over (keys, order), so a group of any size is spread over as many tasks
as it needs; each task sums its own slice, and the slice totals (one row per slice
and key) give every slice its starting offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oddlens.sources.stages import stage

_SLICE = "__slice"


def _sort_key(name: str) -> Column:
    return F.col(name[1:]).desc() if name.startswith("-") else F.col(name).asc()


def prefix_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Sequence[str],
) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum) and ``tot_<c>`` (group sum) per key.

    ``order`` must be a total order inside each key; a leading ``-`` sorts
    descending. Null keys form a group of their own. Rows that tie on ``order`` should be
    aggregated first, which also makes the work grow with distinct values only.

    The sliced rows are written once: range bounds come from sampling, so two
    evaluations of the same range partitioning could slice differently.
    """
    keys = list(keys)
    sort_cols = [_sort_key(k) for k in keys] + [_sort_key(o) for o in order]
    sliced = df.repartitionByRange(*sort_cols).withColumn(_SLICE, F.spark_partition_id())
    inside = (
        Window.partitionBy(*keys, _SLICE)
        .orderBy(*[_sort_key(o) for o in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = stage(
        sliced.select("*", *[F.sum(c).over(inside).alias(f"cum_{c}") for c in sums])
    )

    before = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = stage(
        rows.groupBy(*keys, _SLICE)
        .agg(*[F.sum(c).alias(c) for c in sums])
        .select(
            *keys,
            _SLICE,
            *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"__off_{c}") for c in sums],
            *[F.sum(c).over(whole).alias(f"tot_{c}") for c in sums],
        )
    )
    # The written size of `offsets` is known to the planner, so Spark broadcasts it
    # below autoBroadcastJoinThreshold and otherwise falls back to a shuffled join.
    # Null keys are groups like any other, so the join is null-safe.
    named = offsets.withColumnsRenamed({k: f"__key_{k}" for k in keys} | {_SLICE: "__key_slice"})
    same = F.col(_SLICE) == F.col("__key_slice")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"__key_{k}"))
    joined = rows.join(named, same)
    kept = [c for c in df.columns]
    return joined.select(
        *kept,
        *[(F.col(f"cum_{c}") + F.col(f"__off_{c}")).alias(f"cum_{c}") for c in sums],
        *[F.col(f"tot_{c}") for c in sums],
    )


def global_row_number(
    df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), name: str = "rn"
) -> DataFrame:
    """Row number 1..n per key over a total order, plus the group size ``tot_n``."""
    counted = df.withColumn("__one", F.lit(1).cast("long"))
    return (
        prefix_sums(counted, keys, order, ["__one"])
        .drop("__one")
        .withColumnsRenamed({"cum___one": name, "tot___one": "tot_n"})
    )
