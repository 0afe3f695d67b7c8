"""Run every registered query in Spark and its SQL in DuckDB, and compare.

    python tests/check_oracles.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from __spark_entry__ import oracle_sql, queries  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def normalised(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows sorted, numbers as float, times as text."""
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        if pd.api.types.is_datetime64_any_dtype(frame[name]):
            frame[name] = frame[name].astype("datetime64[us]").astype(str)
        elif pd.api.types.is_numeric_dtype(frame[name]):
            frame[name] = frame[name].astype("float64")
        else:
            frame[name] = frame[name].astype(object).where(frame[name].notna(), None).map(str)
    return frame.sort_values(list(frame.columns), kind="stable").reset_index(drop=True)


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} and {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"{len(spark_frame)} and {len(sql_frame)} rows"
    try:
        pd.testing.assert_frame_equal(
            normalised(spark_frame), normalised(sql_frame), check_exact=True
        )
    except AssertionError as error:
        return str(error)
    return None


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = connect(sf_dir), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.perf_counter()
        result = query(spark, sf_dir).toPandas()
        seconds = time.perf_counter() - start
        sql = oracle_sql().get(name)
        problem = differences(result, connection.execute(sql).df()) if sql else None
        failed += problem is not None
        verdict = "rows only" if sql is None else "equal" if problem is None else "DIFFERS"
        print(f"{name:20} {len(result):8} rows {seconds:7.2f} s  {verdict} {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
