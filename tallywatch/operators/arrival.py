"""Repeated and late records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key, the first in ``order``; copies meet in a partial aggregate, not in one sorted group.

    Rows without a key are no copies of each other and all stay.
    """
    rest = [c for c in df.columns if c != key]
    kept = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    keyless = df.filter(F.col(key).isNull())
    return kept.select(key, "_row.*").select(*df.columns).unionByName(keyless)


def first_on_stream(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """The first row of each key that a stream delivers; copies up to ``delay`` behind the newest event are dropped.

    ``time`` is a timestamp. Rows without a key are no copies of each other and all stay.
    """
    kept = stream.filter(F.col(key).isNotNull()).withWatermark(time, delay).dropDuplicatesWithinWatermark([key])
    return kept.unionByName(stream.filter(F.col(key).isNull()).withWatermark(time, delay))


SLICE = 4096  # batches that one task orders


def flag_late(df: DataFrame, batch: str, time_us: str, delay_us: int) -> DataFrame:
    """Add ``watermark_us`` and ``is_late``: an event more than ``delay_us`` behind all earlier batches is late.

    ``batch`` is a whole number. The newest time before a batch comes from the batches of its slice and from one
    row for each earlier slice.
    """
    seen = df.groupBy(batch).agg(F.max(time_us).alias("_max")).withColumn("_slice", F.floor(F.col(batch) / F.lit(SLICE)))
    earlier = Window.partitionBy("_slice").orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = seen.groupBy("_slice").agg(F.max("_max").alias("_top")).select("_slice", F.max("_top").over(before).alias("_before"))
    newest = F.greatest(F.max("_max").over(earlier), F.col("_before"))
    marks = seen.join(slices, "_slice").select(batch, (newest - F.lit(delay_us)).alias("watermark_us"))
    late = F.coalesce(F.col(time_us) < F.col("watermark_us"), F.lit(False))
    return df.join(marks, batch).withColumn("is_late", late)


def split_late(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    late: Column = F.col("is_late")
    return flagged.filter(~late), flagged.filter(late)
