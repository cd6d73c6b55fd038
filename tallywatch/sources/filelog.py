"""Keyed append-only logs as folders of parquet files, with the options of a broker where one exists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

# Fixed value: the most records one micro-batch takes from a broker partition set.
MAX_OFFSETS_PER_TRIGGER = 5000
TRIGGER_INTERVAL = "30 seconds"
BYTES_PER_TRIGGER = 1 << 30  # of log files that one micro-batch takes; a broker's limit counts records instead

MESSAGE_COLUMNS = ("key", "value")


def log_partition(key: Column, partitions: int) -> Column:
    """Every message of a key lands in the same partition."""
    return F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int")


def append_messages(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_keyed(df: DataFrame, path: str, partitions: int) -> None:
    """Append (key, value, ...) rows, laid out by log partition."""
    placed = df.withColumn("partition", log_partition(F.col("key"), partitions))
    placed.write.mode("append").partitionBy("partition").parquet(path)


def read_bounded(
    spark: SparkSession, path: str, start: dict[int, int] | None = None, end: dict[int, int] | None = None
) -> DataFrame:
    """Messages from ``start`` (inclusive) to ``end`` (exclusive) per partition; earliest to latest by default."""
    df = spark.read.parquet(path)
    keep = F.lit(True)
    for bounds, outside in ((start, lambda o, b: o < b), (end, lambda o, b: o >= b)):
        for partition, bound in (bounds or {}).items():
            keep = keep & ~((F.col("partition") == partition) & outside(F.col("offset"), F.lit(bound)))
    return df.filter(keep) if start or end else df


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None, bytes_per_trigger: int = BYTES_PER_TRIGGER
) -> DataFrame:
    """A growing log; a micro-batch takes files up to ``bytes_per_trigger`` (one at least), or ``files_per_trigger`` files."""
    reader: DataStreamReader = spark.readStream.schema(schema)
    if files_per_trigger is None:
        return reader.option("maxBytesPerTrigger", bytes_per_trigger).parquet(path)
    return reader.option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def read_positions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The messages of a ``replay`` with ``position``: their place in the log partition as a reader of its files meets them."""
    rows = spark.read.schema(schema).parquet(path)
    place = F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    return rows.select("*", place.alias("position"))


def replay(df: DataFrame, key: str, order: list[str], partitions: int, tasks: int | None = None) -> DataFrame:
    """Rows laid out by (log partition, event order).

    A range partitioning on the whole order splits a key with many rows over several tasks, and the
    files of a log partition still follow each other in event order.
    """
    placed = df.withColumn("partition", log_partition(F.col(key), partitions))
    by = ["partition", *order]
    ranged = placed.repartitionByRange(tasks, *by) if tasks else placed.repartitionByRange(*by)
    return ranged.sortWithinPartitions(*by)


# --- broker, when its package is on the classpath -------------------------------------------


def broker_available(spark: SparkSession) -> bool:
    try:
        spark.sparkContext._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
    except Exception:
        return False
    return True


def broker_stream_options(servers: str, topic: str, per_trigger: int = MAX_OFFSETS_PER_TRIGGER) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": str(per_trigger),
        "failOnDataLoss": "false",
    }


def broker_batch_options(servers: str, topic: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
    }


def read_broker(spark: SparkSession, servers: str, topic: str, streaming: bool) -> DataFrame:
    options = broker_stream_options(servers, topic) if streaming else broker_batch_options(servers, topic)
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**options).load()


def write_broker(df: DataFrame, servers: str, topic: str) -> None:
    df.select(*MESSAGE_COLUMNS).write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "topic", topic
    ).save()
