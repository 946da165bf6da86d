"""Helpers shared by the corpus operators: written tables, text bytes, document keys."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oddlens.sources.stages import StageStore

#: A-Z to a-z and the white space of the contracts ([\x20\x09-\x0D]) to one blank, on UTF-8 bytes.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz     ")
#: The same white space, as bytes to delete.
SPACES = b" \t\n\x0b\x0c\r"


_shipped: set[str] = set()
#: Tables of the pipeline's stages, and whether new ones are noted.
_paths: list[str] = []
_noted = False


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that tasks can import it."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="oddlens-code-")  # the driver's own: it serves the file to the workers
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below the session's shared checkpoint folder."""
    path = StageStore(spark, run="llm").path(f"{name}-{uuid.uuid4().hex[:12]}")
    if _noted:
        _paths.append(path)
    return path


@contextmanager
def stage_tables(docs: DataFrame) -> Iterator[None]:
    """For a stage of a pipeline, whose documents have been written: first deletes the tables that the
    stages before it wrote for themselves, but those that ``docs`` reads; then notes its own."""
    global _noted
    read = docs.inputFiles() if _paths else []
    jvm, conf = docs.sparkSession._jvm, docs.sparkSession._jsc.hadoopConfiguration()
    for path in list(_paths):
        if not any(f"/{path.rsplit('/', 1)[1]}/" in file for file in read):
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)
            _paths.remove(path)
    _noted = True
    try:
        yield
    finally:
        _noted = False


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` once to the shared folder and return the table that was written.

    It cuts the lineage: what follows survives the loss of any executor, and each
    later read takes only the columns that it needs.
    """
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(column: str, divisor: int) -> Column:
    """crc32 of a value's text, modulo ``divisor``; a null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def text_bytes(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def slices(batch, rows: int = 256):
    """Parts of an Arrow batch as column lists, so that only a few texts are Python objects at once."""
    for a in range(0, batch.num_rows, rows):
        yield [c.to_pylist() for c in batch.slice(a, rows).columns]


def chunks(batch: pa.RecordBatch, texts: int, size: int) -> Iterator[pa.RecordBatch]:
    """Parts of an Arrow batch with about ``size`` bytes in its column ``texts``, of one row at least."""
    stops = np.cumsum(pc.fill_null(pc.binary_length(batch.column(texts)), 0).to_numpy().astype(np.int64))
    a = 0
    while a < len(stops):
        before = stops[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(stops, before + size, side="right")))
        yield batch.slice(a, b - a)
        a = b
