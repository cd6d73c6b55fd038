"""The batch path from raw records to decisions and silver tables; building it starts no job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.functions import features
from tallywatch.functions.rules import RULES
from tallywatch.operators import contracts, scoring
from tallywatch.operators.enrichment import attach_dimensions
from tallywatch.operators.velocity import SECOND_US, add_velocity

Dimensions = tuple[DataFrame, DataFrame, DataFrame]


# The part of a validated record that the enrichment stage reads.
FOR_ENRICHMENT = contracts.VALIDATED.only([*contracts.ENRICHED.names, "TransactionDT"])


def with_event_us(validated: DataFrame) -> DataFrame:
    return validated.withColumn("event_us", F.try_multiply(F.col("TransactionDT"), F.lit(SECOND_US)))


def enrich(
    validated: DataFrame, dims: Dimensions, keep: tuple[str, ...] = ("offset", "event_us")
) -> DataFrame:
    """Validated records plus velocity and risk columns, cut to the enriched contract."""
    wanted = [c for c in validated.columns if c in contracts.ENRICHED.names or c in (*keep, "TransactionDT")]
    narrow = with_event_us(validated.select(*wanted))
    fast = add_velocity(narrow)
    return contracts.ENRICHED.conform(attach_dimensions(fast, *dims), keep=keep)


def silver_decisions(decisions: DataFrame) -> DataFrame:
    """Decision records under the table's lower-case names; rows without an id are dropped.

    Beyond the base columns the table keeps the decision time and every rule score, which the
    per-rule performance table needs.
    """
    base = [
        F.col("TransactionID").cast("bigint").alias("transactionid"),
        F.col("uid"),
        F.col("TransactionAmt").cast("double").alias("transactionamt"),
        F.col("ProductCD").alias("productcd"),
        F.col("card4"),
        F.col("card6"),
        F.col("P_emaildomain").alias("p_emaildomain"),
        F.col("transaction_hour").cast("int").alias("transaction_hour"),
        F.col("fraud_score").cast("double").alias("fraud_score"),
        F.col("decision"),
        F.col("decision_reason"),
        F.col("model_version"),
        scoring.rules_as_text(F.col("rules_triggered")).alias("rules_triggered"),
        F.col("isFraud").cast("int").alias("isfraud"),
        F.col("ingestion_id"),
        F.to_date("transaction_date").alias("transaction_date"),
    ]
    extra = [F.col("decided_at").try_cast("timestamp_ntz").alias("decided_at"), F.col("confidence")]
    extra += [F.col(f"score_{r.name}") for r in RULES]
    if "event_us" in decisions.columns:  # decisions that come from a log hold the date and the hour only
        extra.append(features.event_time(F.floor(F.col("event_us") / F.lit(SECOND_US)).cast("bigint")).alias("event_at"))
    return decisions.select(*base, *extra).filter(F.col("transactionid").isNotNull())


def silver_transactions(validated: DataFrame) -> DataFrame:
    """Transactions from validated records, so that hour and event time are those of the transaction."""
    return validated.select(
        F.col("TransactionID").cast("bigint").alias("transactionid"),
        F.col("isFraud").cast("int").alias("isfraud"),
        F.col("TransactionAmt").cast("double").alias("transactionamt"),
        F.col("ProductCD").alias("productcd"),
        F.col("uid"),
        F.to_date("transaction_date").alias("transaction_date"),
        F.col("event_timestamp").try_cast("timestamp_ntz").alias("event_timestamp"),
        F.col("transaction_hour").cast("int").alias("transaction_hour"),
        F.col("ingestion_id"),
    ).filter(F.col("transactionid").isNotNull())


DECISION_MAP_COLUMNS = [
    ("TransactionID", "transactionid", "bigint"),
    ("uid", "uid", "string"),
    ("TransactionAmt", "transactionamt", "double"),
    ("ProductCD", "productcd", "string"),
    ("card4", "card4", "string"),
    ("card6", "card6", "string"),
    ("P_emaildomain", "p_emaildomain", "string"),
    ("transaction_hour", "transaction_hour", "int"),
    ("fraud_score", "fraud_score", "double"),
    ("decision", "decision", "string"),
    ("decision_reason", "decision_reason", "string"),
    ("model_version", "model_version", "string"),
    ("rules_triggered", "rules_triggered", "string"),
    ("isFraud", "isfraud", "int"),
    ("ingestion_id", "ingestion_id", "string"),
    ("transaction_date", "transaction_date", "string"),
]


def decisions_from_log(messages: DataFrame) -> DataFrame:
    """Framed decision messages to table columns through a text map, whatever fields a body carries."""
    from tallywatch.functions import wire

    # the generator opens every body once, however many keys are read from it
    decoded = messages.select(F.explode(F.array(wire.decode_map(wire.body(F.col("value"))))).alias("data"))
    projected = decoded.filter(F.col("data").isNotNull()).select(
        *contracts.project_map(F.col("data"), DECISION_MAP_COLUMNS)
    )
    return projected.filter(F.col("transactionid").isNotNull())
