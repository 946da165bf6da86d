"""Readers and writers: CSV, Parquet, JSONL trial logs, split manifests."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oddlens.functions.columns import month_digits, round_doubles


def load_table(
    spark: SparkSession,
    path: str,
    encoding: str | None = None,
    schema: T.StructType | str | None = None,
    sampling_ratio: float | None = None,
) -> DataFrame:
    """Read CSV or Parquet by suffix. The frame is lazy: columns and filters used
    later are pushed into this scan. Charsets beyond ISO-8859-1 and the UTF family need
    ``spark.sql.legacy.javaCharsets=true`` in the session."""
    suffix = PurePosixPath(path.rstrip("/")).suffix.lower()
    if suffix == ".csv":
        reader = spark.read.option("header", True).option("encoding", encoding or "UTF-8")
        if schema is not None:
            return reader.schema(schema).csv(path)
        if sampling_ratio is not None:
            reader = reader.option("samplingRatio", sampling_ratio)
        return reader.option("inferSchema", True).csv(path)
    if suffix in {".parquet", ".pq"}:
        return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    raise ValueError(f"unsupported table format '{suffix}': use .csv or .parquet")


def load_metadata(df: DataFrame, path: str) -> DataFrame:
    """One row: path, format, row count, column count."""
    suffix = PurePosixPath(path.rstrip("/")).suffix.lower().lstrip(".")
    return df.agg(F.count("*").alias("row_count")).select(
        F.lit(path).alias("path"),
        F.lit(suffix).alias("source_format"),
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
    )


def write_partitioned(df: DataFrame, path: str, by: str = "dataset") -> None:
    """Write a split table so that later reads of one split prune the others.

    Rows of one split stay spread over all tasks: a split may hold most of the
    table, so it is not gathered into one writer.
    """
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def write_metric_csv(df: DataFrame, path: str, digits: int = 5) -> None:
    """Write a month-, bin- or feature-sized result as CSV with rounded floats."""
    round_doubles(df, digits).write.mode("overwrite").option("header", True).csv(path)


_TRIAL = T.StructType(
    [
        T.StructField("iteration", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("accepted", T.BooleanType()),
        T.StructField("parameters", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType()))),
    ]
)


def read_trial_log(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines, one per trial. Broken lines and lines without a numeric
    iteration are skipped; rows come ordered by iteration."""
    text = spark.read.text(path)
    # A string holding a number is not a numeric iteration, hence the raw-text test.
    numeric = F.get_json_object("value", "$.iteration")
    quoted = F.col("value").rlike(r'"iteration"\s*:\s*"')
    event = F.from_json("value", _TRIAL, {"mode": "PERMISSIVE"})
    return (
        text.where(numeric.isNotNull() & ~quoted)
        .select(event.alias("e"))
        .where("e.iteration is not null")
        .select("e.*")
        .orderBy("iteration")
    )


def restore_split(df: DataFrame, date_col: str, manifest: dict[str, str]) -> DataFrame:
    """Label rows with the data set of their month; ``manifest`` maps month → data set.

    The manifest has one entry per month, so it travels as a literal map.
    """
    month = month_digits(date_col, df.schema[date_col].dataType)
    pairs = [F.lit(x) for month_set in sorted(manifest.items()) for x in month_set]
    return df.withColumn("dataset", F.create_map(*pairs)[month]).where("dataset is not null")
