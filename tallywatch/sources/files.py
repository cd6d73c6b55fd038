"""CSV scan, JSON archive and external tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.functions import features
from tallywatch.functions.cleaning import SPARK_TYPES
from tallywatch.session import materialize


CORRUPT = "_corrupt_record"
LINEAGE = {"source_file": "file_path", "source_modified": "file_modification_time", "source_bytes": "file_size"}


def scan_csv(spark: SparkSession, path: str | list[str], columns: list[str], lineage: bool = False, header: bool = True) -> DataFrame:
    """All columns as text, no inference; unreadable lines stay, with their text in ``_corrupt_record``.

    With ``lineage`` each line also says which file it came from, as the scan itself knows it.
    """
    fields = [T.StructField(c, T.StringType()) for c in (*columns, CORRUPT)]
    options = {"header": str(header).lower(), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    scanned = spark.read.schema(T.StructType(fields)).options(**options).csv(path)
    return scanned.select("*", *[F.col(f"_metadata.{field}").alias(n) for n, field in LINEAGE.items()]) if lineage else scanned


def split_corrupt(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable lines, and the rejects of a ``scan_csv``: the line's text, why, and its lineage where that was asked for.

    A line is rejected as a whole: too few or too many fields, or quotes that do not close. The lines are parsed once, whole, and
    written: read on its own, either output would be planned without the fields that tell a broken line.
    """
    parsed = materialize(scanned, "csv-lines")
    good = parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    width = len([c for c in scanned.columns if c != CORRUPT and c not in LINEAGE])
    commas = F.length(CORRUPT) - F.length(F.replace(F.col(CORRUPT), F.lit(","), F.lit("")))
    why = F.when(F.col(CORRUPT).contains('"'), "quoting").when(commas < width - 1, "too_few_fields").otherwise("too_many_fields")
    kept = [F.col(n) for n in LINEAGE if n in scanned.columns]
    return good, parsed.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line"), why.alias("reason"), *kept)


def cast_columns(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    return df.withColumns({n: F.col(n).try_cast(SPARK_TYPES[k]) for n, k in kinds.items()})


def bronze(transactions: DataFrame, identity: DataFrame, run_ts: Column, source_file: str) -> DataFrame:
    """Typed transactions with identity attached, event time and ingestion columns."""
    from tallywatch.operators.enrichment import attach_identity

    typed = cast_columns(
        transactions, {"TransactionID": "long", "TransactionDT": "long", "TransactionAmt": "double", "isFraud": "int"}
    )
    who = cast_columns(identity, {"TransactionID": "long"})
    joined = attach_identity(typed, who, spread_by="TransactionDT")
    return joined.withColumns(
        {
            "event_timestamp": features.event_time(F.col("TransactionDT")),
            "ingestion_date": F.to_date(run_ts),
            "ingested_at": run_ts,
            "source_file": F.lit(source_file),
            "pipeline_phase": F.lit("bronze_bootstrap"),
        }
    )


def read_jdbc_dimension(spark: SparkSession, url: str, table: str, properties: dict[str, str]) -> DataFrame:
    """A small lookup table over JDBC; credentials come from the caller."""
    return spark.read.jdbc(url=url, table=table, properties=properties)
