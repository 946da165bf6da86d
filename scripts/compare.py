"""Run registered queries next to their SQL checks and report differences.

usage: python scripts/compare.py FOLDER [NAME ...]
"""

from __future__ import annotations

import math
import sys
import time
import traceback
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from oddlens.catalog import all_checks, all_queries  # noqa: E402

TYPES = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"},
}


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("oddlens-compare")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)) if v is None else "", str(v)) for v in row)


def same(a: object, b: object) -> bool:
    if a is None or b is None:
        return a is b
    if isinstance(a, float) or isinstance(b, float):
        return math.isclose(a, b, rel_tol=0, abs_tol=0) or (math.isnan(a) and math.isnan(b))
    return a == b


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, folder: str) -> tuple[bool, str]:
    frame = all_queries()[name](spark, folder)
    columns = sorted(frame.columns)
    mine = sorted((tuple(r) for r in frame.select(*columns).collect()), key=_key)
    sql = all_checks().get(name)
    if sql is None:
        return True, f"{len(mine)} rows (no SQL check)"
    result = con.sql(sql)
    if sorted(result.columns) != columns:
        return False, f"columns differ: {columns} / {sorted(result.columns)}"
    types = dict(zip(result.columns, map(str, result.types)))
    for f in frame.schema.fields:
        kind = f.dataType.simpleString()
        if types[f.name] not in TYPES.get(kind, {kind}):
            return False, f"type of {f.name}: {kind} / {types[f.name]}"
    theirs = sorted((tuple(r) for r in result.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()), key=_key)
    if len(mine) != len(theirs):
        return False, f"{len(mine)} rows / {len(theirs)} rows"
    for a, b in zip(mine, theirs):
        if not all(same(x, y) for x, y in zip(a, b)):
            return False, f"rows differ ({columns}):\n   {a}\n   {b}"
    return True, f"{len(mine)} rows"


def main() -> None:
    folder, names = sys.argv[1], sys.argv[2:] or list(all_queries())
    spark, con = session(), duck(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            ok, note = compare(spark, con, name, folder)
        except Exception as error:  # noqa: BLE001
            ok, note = False, "".join(traceback.format_exception_only(error))[:1500]
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:32s} {time.time() - start:6.2f}s {note}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    spark.stop()


if __name__ == "__main__":
    main()
