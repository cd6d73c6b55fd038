"""Session settings and shared scratch space."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cores: int = 8, shuffle_partitions: int | None = None, app: str = "tallywatch") -> SparkSession:
    """Single-JVM session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


# The JVM does not compile methods above 8000 bytes of bytecode. The wide projections here would
# generate larger ones and then run interpreted; below the limit Spark generates smaller methods.
RUNTIME_SETTINGS = {"spark.sql.session.timeZone": "UTC", "spark.sql.codegen.hugeMethodLimit": "8000"}


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings every plan in this package assumes."""
    for name, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def travels_by_value(module: str) -> None:
    """Functions of this module reach Python workers with their code, so that workers need not find the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


_given_out: list[str] = []


def _shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a local one only where driver and executors are one process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master is {master})")
        root = tempfile.mkdtemp(prefix="tallywatch-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared root, for logs, tables and stream checkpoints."""
    path = f"{_shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    _given_out.append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete the folders ``scratch_dir`` gave out in this process, once no result still reads them; how many there were."""
    removed = 0
    while _given_out:
        hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_given_out.pop())
        fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        removed += bool(fs.delete(hadoop_path, True))
    return removed


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a plan's result to a table below the shared root and read it back.

    The plan runs once, its lineage ends here, and a lost executor costs no more than re-reading files.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)
