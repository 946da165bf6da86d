"""Column expressions shared by every operator (all JVM-side built-ins)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted date formats, tried in this order.
DATE_FORMATS = ("yyyyMMdd", "yyyy-MM-dd", "yyyy/MM/dd", "yyyyMM", "yyyy-MM")


def is_numeric(dtype: T.DataType) -> bool:
    """Numbers only; booleans are treated as categories when binning."""
    return isinstance(dtype, T.NumericType)


def numeric_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    wanted = df.columns if columns is None else columns
    return [c for c in wanted if is_numeric(df.schema[c].dataType)]


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as double, null on a zero or null denominator."""
    return F.when(bottom != 0, top.cast("double") / bottom)


def is_bad(target: str, bad_label: object = 1) -> Column:
    """1 for the bad label, 0 for any other label, null for a null label."""
    return (F.col(target) == F.lit(bad_label)).cast("int")


def clean_number(value: Column) -> Column:
    """Cast to double; NaN and infinities become null."""
    number = value.cast("double")
    infinite = F.lit(float("inf"))
    return F.when(~F.isnan(number) & (F.abs(number) != infinite), number)


def normalize_missing(df: DataFrame) -> DataFrame:
    """Map NaN and ±inf of float columns to null; other columns are untouched."""
    floats = {
        f.name: F.when(
            ~F.isnan(f.name) & (F.abs(F.col(f.name)) != F.lit(float("inf"))), F.col(f.name)
        )
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(floats) if floats else df


def parse_date(column: str, dtype: T.DataType) -> Column:
    """Parse ints or strings in any of ``DATE_FORMATS``; month-only means day 1.

    Typed date and timestamp columns need no parsing and are only truncated.
    """
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.to_date(F.col(column))
    text = F.trim(F.col(column).cast("string"))
    return F.coalesce(*[F.try_to_date(text, fmt) for fmt in DATE_FORMATS])


def month_of(date: Column) -> Column:
    return F.date_format(date, "yyyyMM")


def month_digits(column: str, dtype: T.DataType) -> Column:
    """Month key from the first six digits, null when fewer than six exist."""
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.date_format(F.col(column), "yyyyMM")
    digits = F.regexp_replace(F.trim(F.col(column).cast("string")), r"\D", "")
    return F.when(F.length(digits) >= 6, F.substring(digits, 1, 6))


def bucket_of_rank(rank: Column, total: Column, buckets: int) -> Column:
    """Equal-population bucket 1..k of a 1-based rank, with k = min(buckets, total).

    ``ceil(rank·k/total)`` in integer arithmetic, so no rounding is involved.
    """
    k = F.least(F.lit(buckets).cast("long"), total)
    return F.floor((rank * k + total - 1) / total).cast("int")


def edge_bin(value: Column, edges: Sequence[float], side: str = "right") -> Column:
    """Bin index of a value among sorted literal edges.

    ``right`` counts edges <= value (a value equal to an edge goes up), ``left``
    counts edges < value. Written as a CASE with early exit, inside codegen.
    """
    if side not in {"right", "left"}:
        raise ValueError("side must be 'right' or 'left'")
    if not edges:
        return F.when(value.isNotNull(), F.lit(0))
    chain = F.when(value.isNull(), F.lit(None).cast("int"))
    for index, edge in enumerate(edges):
        below = value < F.lit(float(edge)) if side == "right" else value <= F.lit(float(edge))
        chain = chain.when(below, F.lit(index))
    return chain.otherwise(F.lit(len(edges)))


def share_gap(
    actual: Column,
    actual_total: Column,
    base: Column,
    base_total: Column,
    cells: Column,
    smoothing: float,
) -> Column:
    """One cell of a PSI sum with additive smoothing on both shares."""
    pad = F.lit(float(smoothing))
    a = (actual + pad) / (actual_total + pad * cells)
    b = (base + pad) / (base_total + pad * cells)
    return (a - b) * F.ln(a / b)


def null_count(columns: Sequence[str]) -> Column:
    """Number of null cells of a row over the given columns."""
    # One array instead of a chain of sums: an expression as deep as the table is wide
    # overflows the stack from some hundred columns on.
    return F.size(F.filter(F.array(*[F.col(c).isNull() for c in columns]), lambda missing: missing))


def round_doubles(df: DataFrame, digits: int = 5) -> DataFrame:
    """Round every float column; used before exporting metric tables."""
    floats = {
        f.name: F.round(f.name, digits)
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(floats) if floats else df
