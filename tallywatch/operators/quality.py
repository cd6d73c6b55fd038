"""Row-count expectations and load audits that ride on the write instead of extra scans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallywatch.session import path_exists


class ExpectationFailed(RuntimeError):
    pass


def observed_write(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Run ``write`` and return how many rows went through it."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def expect_rows(actual: int, expected: int, what: str) -> int:
    if actual != expected:
        raise ExpectationFailed(f"Unexpected {what} row count: {actual}. Expected {expected}.")
    return actual


def stored_rows(spark: SparkSession, path: str) -> int:
    """Rows of a parquet folder (answered from file footers); 0 if there is none yet."""
    return spark.read.parquet(path).count() if path_exists(spark, path) else 0


def audited_append(df: DataFrame, path: str, name: str) -> tuple[str, int, int, int]:
    """Append to a parquet folder; returns (table, rows before, written, rows after)."""
    spark = df.sparkSession
    before = stored_rows(spark, path)
    written = observed_write(df, lambda d: d.write.mode("append").parquet(path))
    return name, before, written, stored_rows(spark, path)


def audit_frame(spark: SparkSession, rows: list[tuple[str, int, int, int]]) -> DataFrame:
    return spark.createDataFrame(rows, "table_name string, rows_before long, rows_written long, rows_after long")
