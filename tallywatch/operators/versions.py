"""Dimensions that change: every version with the time from which it holds, joined as of an event's time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def append_versions(versions: DataFrame, path: str) -> None:
    """More versions for a dimension: rows of (key, valid_from, written, attributes)."""
    versions.write.mode("append").parquet(path)


def read_versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All versions written so far. Called again, it sees what was appended meanwhile."""
    return spark.read.schema(schema).parquet(path)


def valid_ranges(versions: DataFrame, key: str, valid_from: str = "valid_from", written: str = "written") -> DataFrame:
    """The versions with ``valid_to``, the time of the key's next one (NULL for its last).

    Of versions of one key and time the one written last counts. Rows without a key or a time match nothing and go.
    """
    rest = [c for c in versions.columns if c not in (key, valid_from)]
    known = versions.filter(F.col(key).isNotNull() & F.col(valid_from).isNotNull())
    last = known.groupBy(key, valid_from).agg(F.max_by(F.struct(*rest), F.struct(written, F.struct(*rest))).alias("_row"))
    ends = F.lead(valid_from).over(Window.partitionBy(key).orderBy(valid_from))
    return last.select(key, valid_from, ends.alias("valid_to"), "_row.*")


def attach_as_of(facts: DataFrame, versions: DataFrame, key: str, at: str, columns: dict[str, str], version_key: str, valid_from: str = "valid_from") -> DataFrame:
    """Each fact with the ``columns`` (version's name to new name) of the version that held at its time.

    One row for each fact: ranges of a key do not overlap. NULL where the key is unknown, the fact has no key or time, or its time is
    before the key's first version. Whether the versions are broadcast is Spark's decision, from their size.
    """
    ranges = valid_ranges(versions, version_key, valid_from).select(
        F.col(version_key).alias("_key"), F.col(valid_from).alias("_from"), F.col("valid_to").alias("_to"), *[F.col(c).alias(n) for c, n in columns.items()]
    )
    held = (F.col(key) == F.col("_key")) & (F.col(at) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(at) < F.col("_to")))
    return facts.join(ranges, held, "left").drop("_key", "_from", "_to")
