"""Reading the text tables, and helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallywatch.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def stored(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` below the shared scratch root and read it back: computed once, and no lineage to repeat."""
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, schema: str | StructType, start: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch]], rows: int | None = 1024) -> DataFrame:
    """``mapInArrow`` whose per-task state comes from ``start``; the returned function maps at most ``rows`` rows at a time, never none."""

    def run(batches):
        with _same_operator():
            step = start()
        for batch in batches:
            for k in range(0, batch.num_rows, rows or batch.num_rows):
                out = step(batch.slice(k, rows))
                if isinstance(out, pa.RecordBatch):
                    yield out
                else:
                    yield from out
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


_kept: dict = {}
_former: dict = {}


def kept_by_worker(key: Hashable, make: Callable[[], object]) -> object:
    """What a Python worker keeps from task to task; to be called in ``start`` of ``map_batches``. The first task that
    does not ask for it drops it, so that a worker does not carry one operator's memory through another's stages."""
    if key not in _kept:
        _kept[key] = _former.pop(key) if key in _former else make()
    return _kept[key]


@contextmanager
def _same_operator():
    """Around the start of a task: what it asks for stays, the rest of what earlier tasks kept goes."""
    _former.update(_kept)
    _kept.clear()
    yield
    _former.clear()


def packed(docs: DataFrame) -> DataFrame:
    """Every column in one struct ``row``, so that no name of theirs meets an operator's own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def partitions_for(spark: SparkSession) -> int:
    """Partitions for an explicit shuffle: what the session would use for its own."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
