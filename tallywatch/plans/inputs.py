"""Inputs derived by Spark from the provided tables, in the shapes the operators expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.functions import wire
from tallywatch.operators import contracts, validation
from tallywatch.session import prepare

# One fixed run time instead of the wall clock, so that a re-run gives the same tables.
RUN_TS = "2024-02-01 00:00:00"
LOG_PARTITIONS = 6

DIM_PRODUCT = [("W", "LOW", 10.0), ("C", "HIGH", 70.0), ("H", "HIGH", 75.0), ("S", "MEDIUM", 40.0)]
DIM_EMAIL = [
    ("gmail.com", False, "LOW", 10.0),
    ("yahoo.com", False, "MEDIUM", 25.0),
    ("anonymous.com", True, "HIGH", 80.0),
    ("protonmail.com", True, "HIGH", 60.0),
    ("outlook.com", False, "LOW", 15.0),
]


def run_ts() -> Column:
    return F.to_timestamp_ntz(F.lit(RUN_TS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


_PROPS_NUMBER = "CAST(regexp_extract(props, '[0-9]+', 0) AS INT)"

_RAW_COLUMNS = {
    "offset": "event_id",
    "ingestion_id": "concat('ing-', event_id)",
    "TransactionID": "CASE WHEN event_id % 307 = 0 THEN NULL ELSE event_id END",
    "TransactionDT": "CAST(timestampdiff(SECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts) AS BIGINT)",
    "TransactionAmt": """CASE WHEN event_id % 401 = 0 THEN NULL WHEN event_id % 199 = 0 THEN CAST(0 AS DOUBLE)
        WHEN event_id % 211 = 0 THEN CAST(-5 AS DOUBLE)
        ELSE CAST(CAST(value AS DECIMAL(10,2)) * 4 AS DOUBLE) END""",
    "ProductCD": """CASE WHEN event_id % 223 = 0 THEN 'X' WHEN event_id % 227 = 0 THEN NULL
        WHEN event_type = 'view' THEN 'W' WHEN event_type = 'click' THEN 'C'
        WHEN event_type = 'signup' THEN 'S' WHEN event_type = 'purchase' THEN 'R' ELSE 'H' END""",
    "card1": "CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(1000 + user_id AS DOUBLE) END",
    "card4": "CASE user_id % 3 WHEN 0 THEN 'visa' WHEN 1 THEN 'mastercard' ELSE NULL END",
    "card6": "CASE user_id % 2 WHEN 0 THEN 'credit' ELSE 'debit' END",
    "addr1": "CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(100 + user_id % 50 AS DOUBLE) END",
    "P_emaildomain": """CASE user_id % 8 WHEN 0 THEN 'gmail.com' WHEN 1 THEN 'yahoo.com' WHEN 2 THEN 'anonymous.com'
        WHEN 3 THEN 'hotmail.com' WHEN 4 THEN 'protonmail.com' WHEN 5 THEN ' Outlook.COM '
        WHEN 6 THEN '' ELSE NULL END""",
    "C13": f"CAST({_PROPS_NUMBER} * 30 AS DOUBLE)",
    "V258": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id % 5 - 2 AS DOUBLE) END",
    "V257": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 7 - 2 AS DOUBLE) END",
    "M1": "CASE event_id % 4 WHEN 0 THEN 'T' WHEN 1 THEN 'F' WHEN 2 THEN 't' ELSE NULL END",
    "M4": "CASE event_id % 4 WHEN 0 THEN 'M0' WHEN 1 THEN 'M1' WHEN 2 THEN 'M2' ELSE NULL END",
    "id_01": "CASE WHEN event_id % 6 = 0 THEN CAST(event_id % 10 AS DOUBLE) ELSE NULL END",
    "isFraud": f"CASE WHEN event_id % 53 = 0 THEN NULL WHEN {_PROPS_NUMBER} >= 96 THEN 1 ELSE 0 END",
}


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty raw transactions, one per event; the contract fields not listed here are missing."""
    events = table(spark, sf_dir, "events")
    return events.selectExpr(*[f"{sql} AS `{name}`" for name, sql in _RAW_COLUMNS.items()])


def valid_transactions(
    spark: SparkSession, sf_dir: str, contract: contracts.Contract = contracts.VALIDATED
) -> DataFrame:
    """Accepted rows as validated records, with the log offset kept."""
    good = validation.good_records(raw_transactions(spark, sf_dir))
    return validation.build_validated(good, keep=("offset",), contract=contract)


def identity_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_transactions(spark, sf_dir)
    return raw.filter((F.col("offset") % 6 == 0) & F.col("TransactionID").isNotNull()).select("TransactionID", "id_01")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions as framed messages, some of them broken in each possible way."""
    raw = raw_transactions(spark, sf_dir)
    fields = [F.col(n) for n in contracts.RAW.names if n in raw.columns]
    body = wire.encode_body(F.struct(*fields))
    framed = wire.frame(body, contracts.RAW.schema_id)
    offset = F.col("offset")
    value = (
        F.when(offset % 41 == 0, F.lit(None).cast("binary"))
        .when(offset % 43 == 0, F.substring(framed, 1, 4))
        .when(offset % 47 == 0, F.concat(F.unhex(F.lit("01")), F.substring(framed, F.lit(2), F.length(framed))))
        .when(offset % 59 == 0, F.substring(framed, F.lit(1), F.length(framed) - F.lit(1)))
        .otherwise(framed)
    )
    key = F.coalesce(F.col("TransactionID").cast("string"), F.lit("unknown"))
    partition = (offset % LOG_PARTITIONS).cast("int")
    return raw.select(key.cast("binary").alias("key"), value.alias("value"), partition.alias("partition"), "offset")


def inline_table(spark: SparkSession, rows: list[tuple], columns: dict[str, str]) -> DataFrame:
    """A few fixed rows as a local relation of the plan."""
    literals = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, columns.items())]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*literals)))


def dim_product(spark: SparkSession) -> DataFrame:
    return inline_table(spark, DIM_PRODUCT, {"product_cd": "string", "risk_tier": "string", "risk_score": "double"})


def dim_email(spark: SparkSession) -> DataFrame:
    columns = {"domain": "string", "is_anonymous": "boolean", "risk_tier": "string", "risk_score": "double"}
    return inline_table(spark, DIM_EMAIL, columns)


def dim_hour(spark: SparkSession) -> DataFrame:
    """23 rows: hour 12 is left out, so that a lookup can miss."""
    from tallywatch.functions.features import hour_band

    banded = spark.range(24).filter("id <> 12").select(F.col("id").cast("int").alias("hour_of_day"))
    level = banded.withColumn("risk_level", hour_band(F.col("hour_of_day")))
    points = F.when(F.col("risk_level") == "HIGH", 80.0).when(F.col("risk_level") == "MEDIUM", 40.0).otherwise(10.0)
    return level.withColumn("risk_score", points)


def dimensions(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three fixed dimensions (4, 5 and 23 rows), ready for a broadcast join."""
    return tuple(F.broadcast(d) for d in (dim_product(spark), dim_email(spark), dim_hour(spark)))


def _versioned_contracts() -> tuple[contracts.Contract, contracts.Contract, contracts.Contract]:
    """Three versions of one subject: fields were renamed, retyped and added."""
    field = contracts.Field
    first = (field("txn", "int"), field("TransactionAmt", "double"), field("ProductCD", "string"), field("legacy", "string"))
    second = (field("TransactionID", "long", False), field("amount", "string"), field("product", "string"), field("channel", "string"))
    third = (
        field("TransactionID", "long", False),
        field("amount", "double"),
        field("product", "string", False, "unknown"),
        field("channel", "string", False, "web"),
        field("risk", "int", False, 1),
        field("note", "string"),
    )
    return tuple(contracts.Contract("payments", k, fields) for k, fields in ((101, first), (102, second), (103, third)))


PAYMENT_VERSIONS = _versioned_contracts()
PAYMENT_ALIASES = {"TransactionID": ("txn",), "amount": ("TransactionAmt",), "product": ("ProductCD",)}


def payment_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log written by three versions of a producer; some messages are unframed, cut short, or of a version nobody knows."""
    raw = raw_transactions(spark, sf_dir).withColumn("n", F.col("offset"))
    n = F.col("n")
    amount = F.when(n % 31 == 0, F.lit("n/a")).otherwise(F.col("TransactionAmt").cast("string"))
    records = (
        F.struct(n.cast("int").alias("txn"), "TransactionAmt", "ProductCD", F.lit("old").alias("legacy")),
        F.struct(n.alias("TransactionID"), amount.alias("amount"), F.col("ProductCD").alias("product"), F.when(n % 5 == 0, "app").alias("channel")),
        F.struct(
            n.alias("TransactionID"), F.col("TransactionAmt").alias("amount"), F.col("ProductCD").alias("product"),
            F.lit("pos").alias("channel"), (n % 4).cast("int").alias("risk"), F.lit("new").alias("note"),
        ),
    )
    framed = F.when(F.lit(False), F.lit(None).cast("binary"))
    for k, (contract, record) in enumerate(zip(PAYMENT_VERSIONS, records)):
        framed = framed.when(n % 3 == k, wire.frame(wire.encode_body(record), contract.schema_id))
    framed = framed.otherwise(F.lit(None).cast("binary"))
    value = (
        F.when(n % 53 == 0, wire.frame(wire.body(framed), 999))
        .when(n % 59 == 0, F.substring(framed, F.lit(1), F.length(framed) - 1))
        .when(n % 61 == 0, wire.body(framed))
        .otherwise(framed)
    )
    return raw.select("offset", value.alias("value"))


PRODUCT_VERSIONS = "event_type string, valid_from timestamp_ntz, written long, tier string, score double"


def product_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiers of each event type: a new version every ten days, one of them corrected later, one withdrawn, none before the third day."""
    types = table(spark, sf_dir, "events").select("event_type").distinct()
    place = F.explode(F.sequence(F.lit(0), F.lit(3)))
    versions = types.select("event_type", place.alias("k")).withColumn("valid_from", F.expr("timestampadd(DAY, 2 + 10 * LEAST(k, 2), TIMESTAMP_NTZ'2024-01-01 00:00:00')"))
    letter = F.length("event_type")
    tier = F.when((F.col("k") == 1) & (F.col("event_type") == "view"), F.lit(None)).otherwise(F.concat(F.lit("T"), (letter + F.col("k")) % 4))
    return versions.select("event_type", "valid_from", F.col("k").cast("long").alias("written"), tier.alias("tier"), (letter * 10 + F.col("k")).cast("double").alias("score"))


def csv_folders(spark: SparkSession, sf_dir: str, path: str) -> list[str]:
    """Events as CSV lines in three folders, some lines with a field too few or too many, or an open quote."""
    n = F.col("event_id")
    fields = [n.cast("string"), F.col("event_type"), F.col("user_id").cast("string")]
    line = (
        F.when(n % 37 == 0, F.concat_ws(",", *fields[:2]))
        .when(n % 41 == 0, F.concat_ws(",", *fields, F.lit("extra")))
        .otherwise(F.concat_ws(",", *fields))
    )
    lines = table(spark, sf_dir, "events").select(line.alias("value"), (n % 3).alias("part"))
    for part in range(3):
        lines.filter(F.col("part") == part).select("value").write.text(f"{path}/part-{part}")
    return [f"{path}/part-{part}" for part in range(3)]


def dirty_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer rows with a text column that holds every kind of missing or odd value."""
    customer = table(spark, sf_dir, "customer")
    dirty = """CASE c_custkey % 12 WHEN 0 THEN '' WHEN 1 THEN ' null ' WHEN 2 THEN 'NaN' WHEN 3 THEN 'abc'
        WHEN 4 THEN '3.7' WHEN 5 THEN ' None' WHEN 6 THEN '-12' WHEN 7 THEN 'yes' WHEN 8 THEN ' TRUE '
        WHEN 9 THEN CAST(c_acctbal AS STRING) WHEN 10 THEN c_mktsegment ELSE NULL END"""
    return customer.selectExpr("c_custkey", f"{dirty} AS dirty")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.col("ts").alias("ingested_at"),
        F.col("event_id").alias("seq"),
    )


def faulty_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks of which some hold no price, no number, no finite number, a very large or very small one, or no symbol."""
    n = F.col("seq")
    price = (
        F.when(n % 113 == 0, F.lit(None))
        .when(n % 127 == 0, F.lit(float("nan")))
        .when(n % 131 == 0, F.lit(float("inf")))
        .when(n % 137 == 0, F.lit(1e15))
        .when(n % 149 == 0, F.lit(4.2e-9))
        .when(n % 151 == 0, F.lit(1e9))
        .when(n % 1009 == 0, F.lit(1e300))
        .when((n > 3000) & (n < 3400), F.col("price") * F.lit(1e-9))
        .when((n > 3600) & (n < 3900), F.col("price") * F.lit(1e-200))
        .otherwise(F.col("price"))
    )
    return ticks(spark, sf_dir).withColumn("price", price).withColumn("symbol", F.when(n % 139 != 0, F.col("symbol")))


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("m_"), F.col("event_type")).alias("metric"),
        F.create_map(F.lit("user"), (F.col("user_id") % 10).cast("string")).alias("labels"),
        F.date_trunc("MINUTE", F.col("ts")).cast("timestamp_ntz").alias("ts"),
        F.col("value"),
    )


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % 10).cast("string").alias("series"),
        F.col("ts"),
        F.col("event_id").alias("seq"),
        (F.col("event_id") % 500).alias("value"),
    )


def node_memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Available and total memory of each node (a user), in whole units."""
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % 10).alias("grp"),
        F.col("user_id").alias("node"),
        F.col("ts"),
        F.col("event_id").alias("seq"),
        (F.col("event_id") % 97).alias("available"),
        (F.lit(100) + F.col("user_id") % 3).alias("total"),
    )


def entity_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    phase = (
        F.when(F.col("event_type") == "purchase", "Pending")
        .when(F.col("event_type") == "error", "Failed")
        .otherwise("Running")
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("entity"),
        (F.col("user_id") % 10).alias("grp"),
        F.col("ts"),
        F.col("event_id").alias("seq"),
        phase.alias("phase"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("restarts"),
    )


def with_hour_ties(valid: DataFrame) -> DataFrame:
    """The same rows with event times cut to the hour, so that many rows of a key share a time."""
    whole = (F.floor(F.col("TransactionDT") / 3600) * 3600).cast("bigint")
    return valid.withColumn("TransactionDT", whole)


def with_copies(valid: DataFrame) -> DataFrame:
    copies = F.when(F.col("offset") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return valid.withColumn("copy", F.explode(copies))


def with_batches(valid: DataFrame, seconds: int = 259_200) -> DataFrame:
    """Ordered batches by event time; every 50th row arrives one batch late."""
    batch = F.floor(F.col("TransactionDT") / seconds).cast("int")
    return valid.withColumn("batch", F.when(F.col("offset") % 50 == 0, batch + 1).otherwise(batch))


MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)
