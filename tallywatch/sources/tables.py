"""Catalog tables: create, replace, append, idempotent refresh, partition columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.functions.cleaning import SPARK_TYPES
from tallywatch.operators import contracts

COMPRESSION = "snappy"

# Table layouts: columns and the partitioning each is written with.
SILVER_DECISIONS = {
    "transactionid": "bigint",
    "uid": "string",
    "transactionamt": "double",
    "productcd": "string",
    "card4": "string",
    "card6": "string",
    "p_emaildomain": "string",
    "transaction_hour": "int",
    "fraud_score": "double",
    "decision_reason": "string",
    "model_version": "string",
    "rules_triggered": "string",
    "isfraud": "int",
    "ingestion_id": "string",
    "transaction_date": "date",
    "decision": "string",
}
SILVER_TRANSACTIONS = {
    "transactionid": "bigint",
    "isfraud": "int",
    "transactionamt": "double",
    "uid": "string",
    "event_timestamp": "timestamp_ntz",
    "transaction_hour": "int",
    "ingestion_id": "string",
    "transaction_date": "date",
    "productcd": "string",
}
_COUNTS_AND_RATES = {"total_transactions": "bigint", "fraud_count": "bigint", "fraud_rate": "double"}
GOLD = {
    "daily_fraud_summary": {
        "summary_date": "date",
        **_COUNTS_AND_RATES,
        **dict.fromkeys(["total_amount", "fraud_amount", "avg_fraud_amount", "max_fraud_amount"], "double"),
        "blocked_count": "bigint",
        "blocked_amount": "double",
    },
    "product_fraud_stats": {"summary_date": "date", "productcd": "string", **_COUNTS_AND_RATES, **dict.fromkeys(["total_amount", "avg_transaction_amt", "avg_fraud_amt"], "double")},
    "hourly_fraud_pattern": {"summary_date": "date", "transaction_hour": "int", "transaction_dow": "int", **_COUNTS_AND_RATES, "avg_amount": "double", "risk_level": "string"},
    "rule_performance": {
        "summary_date": "date",
        "rule_name": "string",
        "rule_type": "string",
        **dict.fromkeys(["triggers_count", "true_positive", "false_positive", "true_negative", "false_negative"], "bigint"),
        **dict.fromkeys(["precision_score", "recall_score", "f1_score", "blocked_amount"], "double"),
    },
    "uid_risk_profile": {
        "uid": "string",
        "card1": "double",
        "addr1": "double",
        **_COUNTS_AND_RATES,
        **dict.fromkeys(["total_amount", "avg_amount", "max_amount"], "double"),
        "distinct_merchants": "bigint",
        "distinct_emails": "bigint",
        "last_seen": "timestamp_ntz",
    },
}
# A table laid out by day has the day as its partition column; one laid out by month has the derived ``month``.
BRONZE_EXTRA = {"event_timestamp": "timestamp_ntz", "ingested_at": "timestamp_ntz", "source_file": "string", "pipeline_phase": "string", "ingestion_date": "date"}
LAYOUTS = {
    "bronze_transactions": ({f.name: SPARK_TYPES[f.kind] for f in contracts.RAW.fields} | BRONZE_EXTRA, ["ingestion_date"]),
    "silver_decisions": (SILVER_DECISIONS, ["transaction_date", "decision"]),
    "silver_transactions": (SILVER_TRANSACTIONS, ["transaction_date", "productcd"]),
    "uid_risk_profile": (GOLD["uid_risk_profile"] | {"updated_at": "timestamp_ntz", "risk_tier": "string"}, ["risk_tier"]),
}
LAYOUTS |= {name: (columns | {"updated_at": "timestamp_ntz", "month": "string"}, ["month"]) for name, columns in GOLD.items() if "summary_date" in columns}


def month_of(day: Column) -> Column:
    """Derived partition value for tables that are partitioned by the month of a date."""
    return F.date_format(day, "yyyy-MM")


def create_namespace(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name} LOCATION '{location}'")


def create_table(spark: SparkSession, name: str, columns: dict[str, str], partitions: list[str], location: str) -> None:
    body = ", ".join(f"`{c}` {t}" for c, t in columns.items())
    by = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({body}) USING parquet{by} LOCATION '{location}'")


def replace_table(df: DataFrame, name: str, location: str, partitions: list[str]) -> None:
    """Create or replace an external table in one write."""
    writer = df.write.mode("overwrite").format("parquet").option("compression", COMPRESSION).option("path", location)
    (writer.partitionBy(*partitions) if partitions else writer).saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    columns = df.sparkSession.table(name).columns
    df.select(*columns).write.mode("append").insertInto(name)


def refresh_partitions(df: DataFrame, location: str, partitions: list[str]) -> None:
    """Overwrite exactly the partitions present in ``df``: running a load twice changes nothing."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", COMPRESSION)
        .partitionBy(*partitions)
        .parquet(location)
    )


def create_view(spark: SparkSession, name: str, query: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


def for_partitioned_write(df: DataFrame, partitions: list[str]) -> DataFrame:
    """Bring the rows of a partition together before a write; Spark splits large ones by their measured size."""
    return df.hint("rebalance", *partitions)


def between_days(df: DataFrame, day: str, month: str, first: str, last: str) -> DataFrame:
    """Rows of a plain table laid out by ``month`` whose ``day`` is in a range; only the months of the range are read."""
    months = F.col(month).between(F.lit(first[:7]), F.lit(last[:7]))
    return df.filter(months & F.col(day).between(F.to_date(F.lit(first)), F.to_date(F.lit(last))))


# --- hidden partitioning: laid out by month, filtered by day -----------------------------------

NO_DAY = -(2**31)  # no date has this number; rows without a day have it as their key
CALENDAR = {
    "month": lambda day: month_of(day),
    "quarter": lambda day: F.concat(F.year(day), F.lit("-Q"), F.quarter(day)),
    "year": lambda day: F.year(day),
    "weekday": lambda day: F.weekday(day) + 1,
}


def write_by_month(df: DataFrame, path: str, day: Column) -> None:
    """Append rows to a table that is laid out by the month of ``day``; its users need not know.

    Beside the rows goes a calendar of the days that this write holds, combined per day before it is written.
    """
    dated = df.withColumns({"_day_number": F.coalesce(F.unix_date(day.cast("date")), F.lit(NO_DAY)), "_month": F.coalesce(month_of(day), F.lit("none"))})
    for_partitioned_write(dated, ["_month"]).write.mode("append").partitionBy("_month").option("compression", COMPRESSION).parquet(f"{path}/rows")
    days = dated.select("_month", "_day_number").distinct()
    days.withColumn("day", F.when(F.col("_day_number") != NO_DAY, F.date_from_unix_date("_day_number"))).write.mode("append").parquet(f"{path}/calendar")


def read_by_month(spark: SparkSession, path: str, schema: T.StructType, name: str = "day") -> DataFrame:
    """The rows of ``write_by_month`` with the day as column ``name`` and the calendar's columns under ``name_...``.

    Day and calendar columns come from the calendar, which is joined by month and day. A filter on any of them picks
    calendar rows; their months then prune the folders as the query runs. Without such a filter nothing is pruned or lost:
    rows without a day have a calendar row of their own.
    """
    layout = T.StructType([*schema.fields, T.StructField("_day_number", T.IntegerType()), T.StructField("_month", T.StringType())])
    rows = spark.read.schema(layout).parquet(f"{path}/rows")
    days = spark.read.schema("_month string, _day_number int, day date").parquet(f"{path}/calendar").distinct()
    calendar = days.withColumnRenamed("day", name)
    calendar = calendar.withColumns({f"{name}_{n}": of(F.col(name)) for n, of in CALENDAR.items()})
    return rows.join(calendar, ["_month", "_day_number"]).drop("_month", "_day_number")
