"""Row numbers per group without sorting a whole group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLICE_ROWS = 1_000_000


def number_rows(df: DataFrame, group: str, seq: str, slice_rows: int = SLICE_ROWS, name: str = "row_no") -> DataFrame:
    """1-based position by ``seq`` within ``group``; ``seq`` is a unique whole number such as a log offset.

    Because ``seq`` is unique, a slice of its range holds at most ``slice_rows`` rows however large the
    group is; the row counts of the earlier slices are added to the position within the slice.
    """
    sliced = df.withColumn("_slice", F.floor(F.col(seq) / F.lit(slice_rows)).cast("bigint"))
    within = Window.partitionBy(group, "_slice").orderBy(seq)
    numbered = sliced.withColumn("_position", F.row_number().over(within))
    earlier = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        sliced.groupBy(group, "_slice")
        .agg(F.count("*").alias("_n"))
        .select(group, "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    joined = numbered.join(before, [group, "_slice"])
    return joined.withColumn(name, F.col("_before") + F.col("_position")).drop("_slice", "_position", "_before")
