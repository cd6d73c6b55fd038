"""Every registered query: a name and a function from (session, table folder) to a DataFrame.

Each one reads the provided tables whole. Columns are named as in the matching text of ``oracles``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywatch.functions import cleaning, features, rules, wire
from tallywatch.functions.numbers import clamp, half_up
from tallywatch.operators import arrival, contracts, enrichment, numbering, quality, resolution, scoring, signals, telemetry, timeline, validation, versions
from tallywatch.plans import decisioning, gold, inputs
from tallywatch.plans import views as sql_views
from tallywatch.session import prepare, scratch_dir
from tallywatch.sources import filelog, files, tables
from tallywatch.streaming import progress, sinks, stages, stateful

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def _run_date() -> Column:
    return F.to_date(inputs.run_ts())


# --- shared plans ---------------------------------------------------------------------------


SILVER_FIELDS = contracts.VALIDATED.only(
    ["TransactionID", "isFraud", "TransactionDT", "TransactionAmt", "ProductCD", "uid", "transaction_date"]
    + ["event_timestamp", "transaction_hour", "ingestion_id"]
)


def _valid_for_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.valid_transactions(spark, sf_dir, decisioning.FOR_ENRICHMENT)


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisioning.enrich(_valid_for_enrichment(spark, sf_dir), inputs.dimensions(spark))


def _scored(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return scoring.score(_enriched(spark, sf_dir), inputs.run_ts(), keep=keep)


def _decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.decide(_scored(spark, sf_dir, keep=("event_us",)), inputs.run_ts(), keep=("event_us",))


def _decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisioning.silver_decisions(_decided(spark, sf_dir))


def _transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisioning.silver_transactions(inputs.valid_transactions(spark, sf_dir, SILVER_FIELDS))


def _rows_of_sinks(spark: SparkSession, root: str) -> DataFrame:
    """What a three-way fan-out wrote: one row per message with its sink, id and text."""

    def records(contract: contracts.Contract) -> DataFrame:
        log = spark.read.parquet(stages.stage_path(root, contract.subject))
        return validation.decode_log(log, contract.only(["TransactionID", "decision"])).select(
            F.lit(contract.subject).alias("sink"), F.col("TransactionID").alias("row_id"), F.col("decision").alias("detail")
        )

    rows = records(contracts.DECISIONS).unionByName(records(contracts.AUDIT))
    letters = spark.read.parquet(stages.dead_letter_path(root, contracts.DECISIONS.subject))
    return rows.unionByName(
        letters.select(
            F.lit("dead-letter").alias("sink"),
            F.col("offset").alias("row_id"),
            F.get_json_object(F.col("value").cast("string"), "$.reason").alias("detail"),
        )
    )


def _decision_rows(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("TransactionID").alias("transaction_id"),
        "uid",
        "fraud_score",
        "decision",
        scoring.rules_as_text(F.col("rules_triggered")).alias("rules_triggered"),
    )


# --- sources, sinks, tables -----------------------------------------------------------------


@query
def csv_scan_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two CSV files written, scanned as text, cast, joined and given an event time."""
    root = scratch_dir(spark, "csv")
    raw = inputs.raw_transactions(spark, sf_dir)
    wanted = ["TransactionID", "TransactionDT", "TransactionAmt", "isFraud", "ProductCD"]
    raw.select(*[F.col(c).cast("string") for c in wanted]).write.option("header", "true").csv(f"{root}/transactions")
    who = inputs.identity_records(spark, sf_dir)
    who.select(*[F.col(c).cast("string") for c in who.columns]).write.option("header", "true").csv(f"{root}/identity")
    scanned = files.scan_csv(spark, f"{root}/transactions", wanted).drop("_corrupt_record")
    identity = files.scan_csv(spark, f"{root}/identity", who.columns).drop("_corrupt_record")
    bronze = files.bronze(scanned, identity, inputs.run_ts(), "transactions.csv+identity.csv")
    return bronze.select(
        F.col("TransactionID").alias("transaction_id"),
        F.col("TransactionDT").alias("transaction_dt"),
        F.col("TransactionAmt").alias("transaction_amt"),
        F.col("isFraud").alias("is_fraud"),
        F.col("ProductCD").alias("product_cd"),
        F.col("id_01").try_cast("double").alias("id_01"),
        F.col("event_timestamp").alias("event_ts"),
        "ingestion_date",
    )


def _scanned_folders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    folders = inputs.csv_folders(spark, sf_dir, scratch_dir(spark, "csv-folders"))
    scanned = files.scan_csv(spark, folders, ["event_id", "event_type", "user_id"], lineage=True, header=False)
    return files.split_corrupt(scanned)


def _folder(path: Column) -> Column:
    return F.regexp_extract(path, "/(part-[0-9]+)/[^/]*$", 1)


@query
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of three folders that are not records: their text, the reason, and the folder the scan found them in."""
    _, rejects = _scanned_folders(spark, sf_dir)
    return rejects.select("line", "reason", _folder(F.col("source_file")).alias("folder"))


@query
def csv_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of each source folder: accepted rows with the ingestion columns of their source."""
    good, _ = _scanned_folders(spark, sf_dir)
    typed = files.cast_columns(good, {"event_id": "long", "user_id": "long"})
    traced = contracts.with_lineage(typed, inputs.run_ts(), _folder(F.col("source_file")), "bronze_bootstrap")
    return traced.groupBy("source_file", "pipeline_phase", "ingestion_date").agg(
        F.count("*").alias("records"),
        F.count_distinct("ingestion_id").alias("ingestion_ids"),
        F.sum("event_id").alias("event_ids"),
        F.min("source_bytes").isNotNull().alias("sized"),
    )


def _write_log(spark: SparkSession, sf_dir: str, label: str) -> str:
    path = f"{scratch_dir(spark, label)}/log"
    filelog.append_messages(inputs.messages(spark, sf_dir), path)
    return path


def _message_rows(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("key").cast("string").alias("message_key"),
        F.col("partition").alias("log_partition"),
        F.col("offset").alias("log_offset"),
        wire.is_framed(F.col("value")).alias("is_framed"),
    )


@query
def log_bounded_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as a bounded read, earliest to latest offset of every partition."""
    log = _write_log(spark, sf_dir, "bounded")
    return _message_rows(filelog.read_bounded(spark, log))


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as a stream, in bounded micro-batches, into an exactly-once file sink."""
    log = _write_log(spark, sf_dir, "ingest")
    out = scratch_dir(spark, "ingested")
    stream = stages.read_log(spark, log, files_per_trigger=4)
    sinks.drain_to_files(stream, f"{out}/checkpoint", f"{out}/data")
    return _message_rows(spark.read.schema(inputs.MESSAGE_SCHEMA).parquet(f"{out}/data"))


@query
def log_keyed_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated records as keyed framed messages; every key ends up in one log partition."""
    path = scratch_dir(spark, "keyed")
    valid = inputs.valid_transactions(spark, sf_dir)
    filelog.write_keyed(validation.to_messages(valid, contracts.VALIDATED, keep=("offset",)), path, 6)
    log = spark.read.parquet(path)
    return log.groupBy(F.col("key").cast("string").alias("message_key")).agg(
        F.count("*").alias("messages"), F.count_distinct("partition").alias("partitions")
    )


@query
def stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score messages in; decisions, audit events and dead letters out of each micro-batch."""
    root = scratch_dir(spark, "fanout")
    scored = _scored(spark, sf_dir, keep=("offset",))
    good = validation.to_messages(scored, contracts.SCORES, keep=(F.lit(None).cast("int").alias("partition"), "offset"))
    broken = F.when(F.col("offset") % 61 == 0, F.substring("value", 1, 3)).otherwise(F.col("value"))
    filelog.append_messages(good.withColumn("value", broken), f"{root}/scores")
    stages.run_decision(spark, root, inputs.run_ts(), source=f"{root}/scores")
    return _rows_of_sinks(spark, root)


def _database(spark: SparkSession, label: str) -> tuple[str, str]:
    root = scratch_dir(spark, label)
    name = "tallywatch_" + root.rsplit("-", 1)[-1]
    tables.create_namespace(spark, name, f"{root}/db")
    return name, root


def _table_rows(df: DataFrame) -> DataFrame:
    return df.select("transactionid", "isfraud", "transactionamt", "productcd", "uid", "transaction_date", "transaction_hour")


@query
def table_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An external partitioned table, created and then replaced."""
    database, root = _database(spark, "replace")
    rows = _transactions(spark, sf_dir)
    placed = tables.for_partitioned_write(rows, ["transaction_date"])
    for _ in range(2):
        tables.replace_table(placed, f"{database}.transactions", f"{root}/transactions", ["transaction_date"])
    return _table_rows(spark.table(f"{database}.transactions"))


@query
def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table created from its layout, then two appends."""
    database, root = _database(spark, "append")
    columns, partitions = tables.LAYOUTS["silver_transactions"]
    name = f"{database}.silver_transactions"
    for _ in range(2):
        tables.create_table(spark, name, columns, partitions, f"{root}/silver_transactions")
    placed = tables.for_partitioned_write(_transactions(spark, sf_dir), ["transaction_date"])
    for _ in range(2):
        tables.append_table(placed, name)
    return _table_rows(spark.table(name))


def _line_items_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items laid out by ship month in two appends, as their users see them: with a ship day."""
    path = scratch_dir(spark, "by-month")
    items = inputs.table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.when(F.col("l_orderkey") % 211 != 0, F.col("l_shipdate")))
    for part in range(2):
        tables.write_by_month(items.filter(F.col("l_linenumber") % 2 == part), path, F.col("l_shipdate"))
    return tables.read_by_month(spark, path, items.schema, "ship_day")


@query
def partition_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plain range of days over a table laid out by month; the query prunes the folders as it runs."""
    items = inputs.table(spark, sf_dir, "lineitem")
    path = scratch_dir(spark, "by-month")
    tables.write_by_month(items, path, F.col("l_shipdate"))
    stored = tables.read_by_month(spark, path, items.schema, "ship_day")
    return (
        stored.filter(F.col("ship_day").between(F.lit("1996-01-11").cast("date"), F.lit("1996-06-20").cast("date")))
        .groupBy(F.col("ship_day_month").alias("ship_month"))
        .agg(F.count("*").alias("line_items"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
    )


@query
def calendar_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filters on other columns of the calendar, in SQL: weekends of two quarters."""
    _line_items_by_month(spark, sf_dir).createOrReplaceTempView("line_items_by_month")
    return spark.sql("""
        SELECT ship_day, ship_day_weekday AS weekday, count(*) AS line_items, sum(CAST(l_quantity AS BIGINT)) AS quantity
        FROM line_items_by_month
        WHERE ship_day_quarter IN ('1995-Q4', '1996-Q2') AND ship_day_weekday >= 6
        GROUP BY ship_day, ship_day_weekday""")


@query
def undated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table without a filter: rows without a day are there, and can be asked for."""
    stored = _line_items_by_month(spark, sf_dir)
    return stored.groupBy(F.col("ship_day").isNull().alias("undated")).agg(F.count("*").alias("line_items"), F.count_distinct("ship_day_month").alias("months"))


def _refresh_gold(spark: SparkSession, decisions: DataFrame, root: str) -> dict[str, str]:
    loads = {
        "daily_fraud_summary": (gold.daily_fraud_summary(decisions), "summary_date"),
        "product_fraud_stats": (gold.product_fraud_stats(decisions), "summary_date"),
        "hourly_fraud_pattern": (gold.hourly_fraud_pattern(decisions, _run_date()), "summary_date"),
        "rule_performance": (gold.rule_performance(decisions, _run_date()), "summary_date"),
        "uid_risk_profile": (gold.uid_risk_profile(decisions), None),
    }
    paths = {}
    for name, (rows, day) in loads.items():
        paths[name] = f"{root}/{name}"
        stamped = rows.withColumn("updated_at", inputs.run_ts())
        if day is None:
            stamped.write.mode("overwrite").partitionBy("risk_tier").parquet(paths[name])
        elif name in ("hourly_fraud_pattern", "rule_performance"):
            tables.refresh_partitions(stamped.withColumn("run_date", F.col(day)), paths[name], ["run_date"])
        else:
            tables.refresh_partitions(stamped.withColumn("month", tables.month_of(F.col(day))), paths[name], ["month"])
    return paths


@query
def gold_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver written once, all gold tables refreshed twice; the second run changes nothing."""
    root = scratch_dir(spark, "gold")
    _decisions(spark, sf_dir).write.parquet(f"{root}/silver")
    decisions = spark.read.parquet(f"{root}/silver")
    for _ in range(2):
        paths = _refresh_gold(spark, decisions, root)
    return gold.long_values({name: spark.read.parquet(path) for name, path in paths.items()})


@query
def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five views, created over written tables and read through the catalog: every figure."""
    database, root = _database(spark, "views")
    _decisions(spark, sf_dir).write.parquet(f"{root}/silver")
    decisions = spark.read.parquet(f"{root}/silver")
    for name, rows in (
        ("silver_transactions", _transactions(spark, sf_dir)),
        ("daily_fraud_summary", gold.daily_fraud_summary(decisions)),
        ("rule_performance", gold.rule_performance(decisions, _run_date())),
    ):
        tables.replace_table(rows, f"{database}.{name}", f"{root}/{name}", [])
    sql_views.create_views(spark, database)
    return gold.long_values({name: spark.table(f"{database}.{name}") for name in sql_views.VIEWS}, sql_views.VIEW_VALUES)


@query
def archive_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tick log streamed into JSON lines and read back."""
    root = scratch_dir(spark, "archive")
    ticks = inputs.ticks(spark, sf_dir)
    ticks.write.parquet(f"{root}/log")
    stream = filelog.read_stream(spark, f"{root}/log", ticks.schema)
    sinks.drain_to_files(stream, f"{root}/checkpoint", f"{root}/archive", "json", wire.JSON_OPTIONS)
    return spark.read.schema(ticks.schema).options(**wire.JSON_OPTIONS).json(f"{root}/archive")


@query
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = inputs.ticks(spark, sf_dir)
    encoded = ticks.select(wire.encode_body(F.struct(*ticks.columns)).alias("value"))
    return encoded.select(F.from_json(F.col("value").cast("string"), ticks.schema, wire.JSON_OPTIONS).alias("r")).select("r.*")


@query
def replay_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows laid out per log partition in event order, then framed."""
    path = scratch_dir(spark, "replay")
    raw = inputs.raw_transactions(spark, sf_dir).withColumn("uid", features.replay_key(F.col("card1"), F.col("addr1")))
    ordered = filelog.replay(raw, "uid", ["TransactionDT", "offset"], 6)
    record = contracts.RAW.conform(ordered, keep=("uid", "offset", "partition"), clean=True)
    body = wire.encode_body(F.struct(*[F.col(n) for n in contracts.RAW.names]))
    framed = wire.frame(body, contracts.RAW.schema_id)
    record.select(
        F.col("uid").cast("binary").alias("key"), framed.alias("value"), "partition", "offset"
    ).write.parquet(path)
    log = spark.read.schema(inputs.MESSAGE_SCHEMA).parquet(path)
    decoded = validation.decode_log(log, contracts.RAW.only(["TransactionID", "TransactionDT"]), keep=("key", "offset"))
    return decoded.select(
        F.col("key").cast("string").alias("message_key"),
        F.col("offset").alias("log_offset"),
        F.col("TransactionID").alias("transaction_id"),
        F.col("TransactionDT").alias("transaction_dt"),
    )


@query
def replay_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replayed log as a consumer meets it, file by file and row by row: the place of each message among those of its key."""
    path = scratch_dir(spark, "replay-positions")
    raw = inputs.raw_transactions(spark, sf_dir).withColumn("uid", features.replay_key(F.col("card1"), F.col("addr1")))
    ordered = filelog.replay(raw.select("uid", "TransactionDT", "offset"), "uid", ["TransactionDT", "offset"], 6)
    ordered.write.parquet(path)
    read = filelog.read_positions(spark, path, ordered.schema)
    met = F.row_number().over(Window.partitionBy("uid").orderBy("position"))
    return read.select(F.col("uid").alias("message_key"), F.col("offset").alias("log_offset"), met.alias("place"))


# --- wire format and contracts --------------------------------------------------------------


@query
def frame_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Framed messages, some broken, to records; what cannot be read has no record."""
    log = inputs.messages(spark, sf_dir)
    shown = contracts.RAW.only(["TransactionID", "TransactionAmt", "ProductCD", "P_emaildomain", "isFraud"])
    decoded = validation.decode_log(log, shown, keep=("offset", "value"))
    return decoded.select(
        F.col("offset").alias("log_offset"),
        "decoded",
        wire.schema_id(F.col("value")).alias("schema_id"),
        F.col("TransactionID").alias("transaction_id"),
        F.col("TransactionAmt").alias("transaction_amt"),
        F.col("ProductCD").alias("product_cd"),
        F.col("P_emaildomain").alias("p_emaildomain"),
        F.col("isFraud").alias("is_fraud"),
    )


@query
def frame_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log of three producer versions, each message read by the contract of its own id, as the newest contract."""
    log = inputs.payment_log(spark, sf_dir)
    read = resolution.decode_by_id(log, inputs.PAYMENT_VERSIONS[-1], inputs.PAYMENT_VERSIONS, inputs.PAYMENT_ALIASES)
    return read.select(F.col("offset").alias("log_offset"), "schema_id", "reason", F.col("TransactionID").alias("transaction_id"), "amount", "product", "channel", "risk", "note")


@query
def frame_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = inputs.table(spark, sf_dir, "part")
    framed = parts.select("p_partkey", wire.frame(F.encode("p_name", "UTF-8"), 7).alias("value"))
    return framed.select(
        "p_partkey",
        F.length("value").alias("frame_bytes"),
        wire.schema_id(F.col("value")).alias("schema_id"),
        F.decode(wire.body(F.col("value")), "UTF-8").alias("p_name"),
    )


@query
def null_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = inputs.dirty_strings(spark, sf_dir)
    return dirty.select("c_custkey", cleaning.normalize_null(F.col("dirty")).alias("cleaned"))


@query
def cast_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = inputs.dirty_strings(spark, sf_dir)
    kinds = {"string": "as_string", "int": "as_int", "long": "as_long", "double": "as_double", "boolean": "as_boolean"}
    return dirty.select(
        "c_custkey", *[cleaning.cast_text(F.col("dirty"), kind).alias(name) for kind, name in kinds.items()]
    )


@query
def default_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = inputs.dirty_strings(spark, sf_dir)

    def filled(kind: str, nullable: bool, default: object = None) -> Column:
        return cleaning.fill_default(cleaning.cast_text(F.col("dirty"), kind), kind, nullable, default)

    return dirty.select(
        "c_custkey",
        filled("double", True).alias("nullable_double"),
        filled("string", False).alias("required_string"),
        filled("int", False).alias("required_int"),
        filled("double", False).alias("required_double"),
        filled("boolean", False).alias("required_boolean"),
        filled("int", False, 7).alias("declared_default"),
    )


@query
def conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows to all 439 contract fields; a few of them and the field count are shown."""
    raw = inputs.raw_transactions(spark, sf_dir)
    full = contracts.RAW.conform(raw, keep=("offset",), clean=True)
    shown = ["TransactionID", "isFraud", "TransactionDT", "TransactionAmt", "ProductCD", "card1", "card2", "card4"]
    shown += ["P_emaildomain", "C13", "V258", "V339", "M1", "M4", "id_01", "id_38", "kafka_offset", "DeviceType"]
    return full.select(
        F.col("offset").alias("log_offset"),
        F.lit(len(full.columns) - 1).alias("field_count"),
        *[F.col(c).alias(c.lower()) for c in shown],
    )


@query
def map_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Framed decisions through a text map to typed columns; a key that is missing gives NULL."""
    log = validation.to_messages(_decided(spark, sf_dir), contracts.DECISIONS)
    rows = decisioning.decisions_from_log(log)
    names = F.from_json("rules_triggered", "array<string>")
    return rows.withColumn("rules_triggered", scoring.rules_as_text(names)).drop("model_version")


# --- scalar functions -----------------------------------------------------------------------


@query
def time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.raw_transactions(spark, sf_dir)
    ts = features.event_time(F.col("TransactionDT"))
    return raw.select(
        F.col("offset").alias("log_offset"),
        ts.alias("event_ts"),
        features.transaction_date(ts).alias("transaction_date"),
        features.transaction_hour(ts).alias("transaction_hour"),
        features.transaction_dow(ts).alias("transaction_dow"),
    )


@query
def cent_amt(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey", "o_totalprice", features.fractional_amount(F.col("o_totalprice")).alias("cent_amt")
    )


@query
def uid_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.raw_transactions(spark, sf_dir)
    odd = F.when(F.col("offset") % 113 == 0, F.lit(float("nan"))).otherwise(F.col("card1"))
    return raw.withColumn("card1", odd).select(
        F.col("offset").alias("log_offset"),
        features.replay_key(F.col("card4"), F.col("addr1").cast("bigint")).alias("replay_key"),
        features.uid(F.col("card1"), F.col("addr1")).alias("uid"),
    )


@query
def flag_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.raw_transactions(spark, sf_dir)
    return raw.select(
        F.col("offset").alias("log_offset"), features.parse_flag(F.col("M1")).alias("m1"), F.col("M4").alias("m4")
    )


@query
def has_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = inputs.valid_transactions(spark, sf_dir)
    return valid.select(F.col("offset").alias("log_offset"), "has_identity")


@query
def email_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.raw_transactions(spark, sf_dir)
    return raw.select(F.col("offset").alias("log_offset"), features.normalize_email(F.col("P_emaildomain")).alias("domain"))


@query
def message_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = _valid_for_enrichment(spark, sf_dir)
    return valid.select(
        F.col("offset").alias("log_offset"),
        features.message_key(F.col("uid"), F.col("TransactionID")).alias("message_key"),
    )


@query
def rules_triggered(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored(spark, sf_dir)
    return scored.select(
        F.col("TransactionID").alias("transaction_id"),
        F.size("rules_triggered").alias("rule_count"),
        scoring.rules_as_text(F.col("rules_triggered")).alias("rules_triggered"),
    )


# --- quality gates --------------------------------------------------------------------------


@query
def validate_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validation.with_reject_reason(inputs.raw_transactions(spark, sf_dir))
    return checked.select(F.col("offset").alias("log_offset"), "reject_reason")


@query
def dlq_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of the raw log: unreadable messages and rejected records, with key and payload."""
    decoded = validation.decode_log(inputs.messages(spark, sf_dir), contracts.RAW.only(validation.CHECKED_FIELDS))
    letters = validation.dead_letters(validation.bad_records(decoded), "validation")
    return letters.select(
        "stage",
        F.col("offset").alias("log_offset"),
        F.col("key").cast("string").alias("message_key"),
        F.get_json_object(F.col("value").cast("string"), "$.reason").alias("reason"),
        F.get_json_object(F.col("value").cast("string"), "$.offset").cast("bigint").alias("payload_offset"),
    )


@query
def silver_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decisions(spark, sf_dir).drop("decided_at")


@query
def silver_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _transactions(spark, sf_dir)


@query
def expect_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts observed on the write, checked against the stored rows."""
    root = scratch_dir(spark, "expect")
    raw = inputs.raw_transactions(spark, sf_dir)
    written = quality.observed_write(raw, lambda d: d.write.parquet(f"{root}/bronze"))
    quality.expect_rows(quality.stored_rows(spark, f"{root}/bronze"), written, "bronze")
    stored = spark.read.parquet(f"{root}/bronze")
    return stored.agg(
        F.lit("bronze").alias("table_name"), F.lit(written).cast("bigint").alias("written"), F.count("*").alias("stored")
    )


@query
def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts before, during and after two appends to each silver table."""
    root = scratch_dir(spark, "audit")
    loads = {"silver_decisions": _decisions(spark, sf_dir), "silver_transactions": _transactions(spark, sf_dir)}
    audits = [quality.audited_append(df, f"{root}/{name}", name) for _ in range(2) for name, df in loads.items()]
    return quality.audit_frame(spark, audits)


# --- joins ----------------------------------------------------------------------------------


@query
def identity_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.raw_transactions(spark, sf_dir).select("offset", "TransactionID", "TransactionAmt")
    joined = enrichment.attach_identity(raw, inputs.identity_records(spark, sf_dir))
    return joined.select(
        F.col("offset").alias("log_offset"),
        F.col("TransactionID").alias("transaction_id"),
        F.col("TransactionAmt").alias("transaction_amt"),
        "id_01",
    )


@query
def dimension_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = _valid_for_enrichment(spark, sf_dir)
    joined = enrichment.attach_dimensions(valid, *inputs.dimensions(spark))
    return joined.select(
        F.col("offset").alias("log_offset"),
        "product_risk_tier",
        "p_email_risk_score",
        "p_email_is_anonymous",
        "hour_risk_level",
        "hour_risk_score",
    )


@query
def dimension_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the tier that held at its time, from a dimension with several versions."""
    events = inputs.table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    held = versions.attach_as_of(events, inputs.product_versions(spark, sf_dir), "event_type", "ts", {"tier": "tier", "score": "tier_score", "valid_from": "since"}, "event_type")
    return held.select("event_id", "tier", "tier_score", "since")


@query
def rule_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    score_of = {r.gold_name: f"score_{r.name}" for r in rules.RULES}
    long = gold.unpivot_rules(_decisions(spark, sf_dir), score_of)
    return long.select("transactionid", "rule_name", "rule_score", "isfraud")


# --- windows --------------------------------------------------------------------------------

VELOCITY = ["spend_1min", "spend_5min", "spend_1hr", "spend_24hr", "txn_count_1hr", "txn_count_24hr"]


@query
def velocity_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir).select(F.col("offset").alias("log_offset"), "uid", *VELOCITY)


@query
def velocity_windows_tied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same windows where many events of a key share one time."""
    tied = inputs.with_hour_ties(_valid_for_enrichment(spark, sf_dir))
    enriched = decisioning.enrich(tied, inputs.dimensions(spark))
    return enriched.select(F.col("offset").alias("log_offset"), "uid", *VELOCITY)


@query
def velocity_windows_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same windows where a few keys hold all rows: a key spreads over tasks by the minute."""
    valid = _valid_for_enrichment(spark, sf_dir)
    crowded = valid.withColumn("uid", F.when(F.col("uid").isNotNull(), F.substring_index("uid", "_", -1)))
    enriched = decisioning.enrich(crowded, inputs.dimensions(spark))
    return enriched.select(F.col("offset").alias("log_offset"), "uid", *VELOCITY)


@query
def velocity_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir).select(F.col("offset").alias("log_offset"), "velocity_flag")


@query
def price_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.price_signals(inputs.ticks(spark, sf_dir), chunk_rows=4096)


@query
def price_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.price_alerts(price_signals(spark, sf_dir))


@query
def price_signals_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same signals where prices go from billionths to 10^300 and some ticks hold no usable price or symbol."""
    return signals.price_signals(inputs.faulty_ticks(spark, sf_dir), chunk_rows=4096)


@query
def price_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ticks that the signals leave out."""
    return signals.price_rejects(inputs.faulty_ticks(spark, sf_dir)).select("seq", "symbol", "reason")


@query
def row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival position of every tick within its symbol, the basis of the chunked windows."""
    numbered = numbering.number_rows(inputs.ticks(spark, sf_dir), "symbol", "seq", slice_rows=1000)
    return numbered.select("symbol", "seq", F.col("row_no").cast("bigint").alias("row_no"))


# --- rules and decisions --------------------------------------------------------------------


def _rule_query(rule: rules.Rule) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        enriched = _enriched(spark, sf_dir)
        return enriched.select(F.col("TransactionID").alias("transaction_id"), half_up(rule.score(), 2).alias("score"))

    run.__name__ = f"rule_{rule.name}"
    query(run)


for _rule in rules.RULES:
    _rule_query(_rule)


@query
def fraud_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored(spark, sf_dir)
    return scored.select(
        F.col("TransactionID").alias("transaction_id"),
        "transaction_date",
        "fraud_score",
        "model_version",
        *[r.column for r in rules.RULES],
        "has_identity",
        "spend_1hr",
        "txn_count_1hr",
        "velocity_flag",
    )


@query
def fraud_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = _decided(spark, sf_dir)
    return decided.select(
        F.col("TransactionID").alias("transaction_id"),
        "uid",
        "fraud_score",
        "decision",
        "decision_reason",
        "confidence",
        *[f"score_{r.name}" for r in rules.RULES],
        F.col("isFraud").alias("is_fraud"),
    )


@query
def audit_trail(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = scoring.audit(_decided(spark, sf_dir), inputs.run_ts())
    return events.select(
        "event_type",
        "event_timestamp",
        "transaction_date",
        F.col("TransactionID").alias("transaction_id"),
        "uid",
        F.col("TransactionAmt").alias("transaction_amt"),
        F.col("ProductCD").alias("product_cd"),
        "fraud_score",
        "decision",
        scoring.rules_as_text(F.col("rules_triggered")).alias("rules_triggered"),
        "model_version",
        F.col("isFraud").alias("is_fraud"),
        "pipeline_latency_ms",
        "ingestion_id",
    )


# --- gold -----------------------------------------------------------------------------------


@query
def daily_fraud_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily_fraud_summary(_decisions(spark, sf_dir))


@query
def rule_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.rule_performance(_decisions(spark, sf_dir), _run_date())


@query
def rule_performance_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.rule_performance_by_rule(_decisions(spark, sf_dir), _run_date())


@query
def uid_risk_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.uid_risk_profile(_decisions(spark, sf_dir))


@query
def hourly_fraud_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.hourly_fraud_pattern(_decisions(spark, sf_dir), _run_date()).drop("transaction_dow")


@query
def hourly_weekday_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.hourly_fraud_pattern(_decisions(spark, sf_dir), _run_date(), by_weekday=True)


@query
def product_fraud_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.product_fraud_stats(_decisions(spark, sf_dir))


@query
def fraud_rate_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fraud_rate_by_product(_transactions(spark, sf_dir))


@query
def hourly_fraud_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.hourly_fraud_trend(_transactions(spark, sf_dir))


@query
def top_risky_uids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.top_risky_uids(_transactions(spark, sf_dir))


@query
def rule_effectiveness_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.rule_effectiveness_ranking(rule_performance_by_rule(spark, sf_dir))


@query
def daily_blocked_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily_blocked_amount(daily_fraud_summary(spark, sf_dir))


@query
def fraud_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fraud_totals(daily_fraud_summary(spark, sf_dir))


@query
def risk_tier_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.risk_tier_rollup(uid_risk_profile(spark, sf_dir))


@query
def latest_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.latest_daily(daily_fraud_summary(spark, sf_dir))


@query
def top_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five days with the most fraud, from the daily table."""
    daily = daily_fraud_summary(spark, sf_dir)
    ranked = daily.orderBy(F.desc("fraud_count"), F.desc("summary_date")).limit(5)
    return ranked.select("summary_date", "total_transactions", "fraud_count", "fraud_rate")


TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
TABLE_NAMES += ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@query
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.table_counts({name: inputs.table(spark, sf_dir, name) for name in TABLE_NAMES})


# --- metrics, alerts, health ----------------------------------------------------------------


def _gold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of gold tables that were written first, so that no source is scored once per table."""
    root = scratch_dir(spark, "metrics")
    _decisions(spark, sf_dir).write.parquet(f"{root}/decisions")
    decisions = spark.read.parquet(f"{root}/decisions")
    return telemetry.gold_metrics(
        gold.daily_fraud_summary(decisions),
        gold.product_fraud_stats(decisions),
        gold.hourly_fraud_pattern(decisions, _run_date()),
        gold.uid_risk_profile(decisions),
        gold.rule_performance(decisions, _run_date()),
        decisions,
        _transactions(spark, sf_dir),
    )


@query
def metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold_metrics(spark, sf_dir).withColumn("labels", telemetry.label_text(F.col("labels")))


@query
def alert_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    evaluated = telemetry.evaluate_alerts(_gold_metrics(spark, sf_dir))
    return evaluated.select(
        "alert", "severity", "metric", telemetry.label_text(F.col("labels")).alias("labels"), "value", "threshold", "active"
    )


# A stretch of six hours above 60, where a silence of half a day ends it.
HOLD_SECONDS, GAP_SECONDS, HOLD_ABOVE = 21_600, 43_200, 60.0


@query
def alert_sustained(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = inputs.metric_samples(spark, sf_dir).withColumn("labels", telemetry.label_text(F.col("labels")))
    scraped = telemetry.scrape(samples, ["metric", "labels"], "ts", "value")
    return telemetry.sustained(
        scraped, ["metric", "labels"], "ts", F.col("value") > HOLD_ABOVE, HOLD_SECONDS, GAP_SECONDS
    )


@query
def alert_firing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alert rules over the day's running fraud rate: what fired after its hold, and what was held back."""
    return telemetry.alert_stretches(telemetry.daily_rate_samples(_transactions(spark, sf_dir)), GAP_SECONDS)


@query
def group_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.group_health(telemetry.latest_phase(inputs.entity_states(spark, sf_dir)))


@query
def health_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both weightings over the signals of each group, and the score's status."""
    states = inputs.entity_states(spark, sf_dir)
    latest = telemetry.latest_phase(states).groupBy("grp").agg(
        F.count_if(F.col("phase") != telemetry.RUNNING).alias("bad"),
        (F.count_if(F.col("phase") == "Failed") / F.count("*")).alias("cpu"),
        (F.count_if(F.col("phase") == "Pending") / F.count("*")).alias("memory"),
    )
    restarts = states.groupBy("grp").agg(F.sum("restarts").alias("restarts"))
    both = latest.join(restarts, "grp")
    overview = telemetry.health_score((F.col("bad"), 0.02), (F.col("cpu"), 10.0), (F.col("memory"), 8.0))
    dashboard = telemetry.health_score((F.col("bad"), 0.15), (F.col("restarts"), 0.5))
    strict = telemetry.health_score((F.col("bad"), 3.0), (F.col("restarts"), 0.05))
    return both.select(
        "grp",
        "bad",
        "restarts",
        half_up(overview, 1).alias("overview_score"),
        half_up(dashboard, 1).alias("dashboard_score"),
        half_up(strict, 1).alias("strict_score"),
    )


@query
def status_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-threshold bands of the daily maximum of each metric."""
    daily = inputs.table(spark, sf_dir, "events").groupBy(
        F.col("event_type").alias("metric"), F.to_date("ts").alias("day")
    ).agg(F.max("value").alias("peak"))
    return daily.withColumn("status", telemetry.status_band(F.col("peak"), 200.0, 300.0))


@query
def incident_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First matching incident of each day's signals."""
    hour = F.hour("ts")
    days = inputs.table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(
        (F.count_if((F.col("event_type") == "error") & (hour < 3)) % 60).alias("bad_pods"),
        (F.lit(70) + F.count_if(F.col("event_type") == "view") % 25).alias("memory"),
        (F.lit(65) + F.count_if(F.col("event_type") == "click") % 25).alias("cpu"),
    )
    return telemetry.classify_incidents(days)


@query
def counter_increase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-hour increase and rate of each counter, resets handled."""
    return telemetry.counter_increase(inputs.counters(spark, sf_dir), 21_600)


RATE_WIDTHS = {"increase_1h": 3_600, "increase_6h": 21_600}


@query
def counter_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate over 5 minutes, increase over 1 and 6 hours of each counter, every 5 minutes."""
    return timeline.counter_rates(inputs.counters(spark, sf_dir), 300, RATE_WIDTHS, {"rate_5m": 300})


@query
def health_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly health score of each group: pods not running, busy share from counter rates, memory in use from a ratio of sums.

    Each signal is what was last known at the hour: a phase for a day, a node's memory for twelve hours.
    """
    pods = timeline.last_at_steps(inputs.entity_states(spark, sf_dir), ["grp", "entity"], ["phase"], 3_600, 86_400)
    bad = pods.groupBy("grp", "evaluated_at").agg(F.count_if(F.col("phase") != telemetry.RUNNING).alias("bad_pods"))
    nodes = timeline.last_at_steps(inputs.node_memory(spark, sf_dir), ["grp", "node"], ["available", "total"], 3_600, 43_200)
    memory = nodes.groupBy("grp", "evaluated_at").agg(timeline.missing_share("available", "total").alias("memory"))
    idle = timeline.counter_rates(inputs.counters(spark, sf_dir), 3_600, {}, {"idle": 3_600}).filter("idle IS NOT NULL")
    cpu = idle.select(F.col("series").cast("bigint").alias("grp"), "evaluated_at", (F.lit(1.0) - clamp(F.col("idle"), 0.0, 1.0)).alias("cpu"))
    score = telemetry.health_score((F.col("bad_pods"), 0.02), (F.col("cpu"), 10.0), (F.col("memory"), 8.0))
    return timeline.aligned([bad, memory, cpu], ["grp"]).withColumn("health_score", half_up(score, 1)).select("grp", "evaluated_at", "bad_pods", "cpu", "memory", "health_score")


@query
def ratio_of_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of the list price that discounts take, per return flag, in whole hundredths of a cent."""
    items = inputs.table(spark, sf_dir, "lineitem")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    left = F.lit(100) - F.round(F.col("l_discount") * 100).cast("bigint")
    return telemetry.ratio_of_sums(items, cents * left, cents * 100, ["l_returnflag"], above=0.05).select(
        "l_returnflag", "used_ratio", "breached"
    )


@query
def entity_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = inputs.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("entity"), F.col("c_nationkey").alias("node")
    )
    return telemetry.entity_latest_state(nodes, inputs.entity_states(spark, sf_dir))


@query
def severity_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    apps = inputs.table(spark, sf_dir, "supplier").selectExpr(
        "s_name AS name",
        "CASE WHEN s_suppkey % 4 = 0 THEN 'Degraded' WHEN s_suppkey % 11 = 0 THEN NULL ELSE 'Healthy' END AS health_status",
        "CASE WHEN s_suppkey % 3 = 0 THEN 'OutOfSync' ELSE 'Synced' END AS sync_status",
    )
    ranked = apps.withColumn("severity", telemetry.app_severity(F.col("health_status"), F.col("sync_status")))
    return telemetry.by_severity(ranked)


@query
def telemetry_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.top_groups(inputs.table(spark, sf_dir, "events"), "user_id", "value", 10)


# --- arrival --------------------------------------------------------------------------------


@query
def dedup_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = inputs.with_copies(_valid_for_enrichment(spark, sf_dir)).select(
        "TransactionID", "TransactionDT", "TransactionAmt", "uid", "offset", "copy"
    )
    first = arrival.first_per_key(copies, "TransactionID", ["TransactionDT", "copy"])
    return first.select(
        F.col("TransactionID").alias("transaction_id"), F.col("TransactionAmt").alias("transaction_amt"), "uid", "copy"
    )


@query
def late_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that arrive more than a day behind the newest event of the earlier batches."""
    batches = inputs.with_batches(_valid_for_enrichment(spark, sf_dir)).select("offset", "batch", "TransactionDT")
    flagged = arrival.flag_late(decisioning.with_event_us(batches), "batch", "event_us", 86_400_000_000)
    return flagged.select(F.col("offset").alias("log_offset"), "batch", "is_late")


# --- streaming ------------------------------------------------------------------------------

FIFTEEN_DAYS = 1_296_000


def _in_halves(source: DataFrame, second: Column, log: str, run: Callable[[], None]) -> None:
    """Append the source to a log in two ordered parts and let the stream catch up after each one."""
    for part in (~second, second):
        source.filter(part).write.mode("append").parquet(log)
        run()


@query
def stream_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fused query over a growing log, restarted from its checkpoint half-way."""
    root = scratch_dir(spark, "fused")
    log = f"{root}/raw"
    dims = inputs.dimensions(spark)
    second = F.col("offset") * 2 >= F.lit(_event_count(spark, sf_dir))
    source = inputs.messages(spark, sf_dir)
    _in_halves(source, second, log, lambda: stages.run_fused(spark, root, log, dims, inputs.run_ts()))
    return _rows_of_sinks(spark, root)


def _event_count(spark: SparkSession, sf_dir: str) -> int:
    return inputs.table(spark, sf_dir, "events").count()


@query
def stream_stage_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four stages as separate queries, each reading the log of the one before."""
    root = scratch_dir(spark, "chain")
    filelog.append_messages(inputs.messages(spark, sf_dir), f"{root}/raw")
    stages.run_chain(spark, root, f"{root}/raw", inputs.dimensions(spark), inputs.run_ts())
    log = spark.read.parquet(stages.stage_path(root, contracts.DECISIONS.subject))
    shown = contracts.DECISIONS.only(["TransactionID", "uid", "fraud_score", "decision", "rules_triggered"])
    return _decision_rows(validation.decode_log(log, shown))


@query
def stream_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The velocity windows from keyed state, restarted half-way."""
    root = scratch_dir(spark, "velocity")
    log = f"{root}/log"
    wanted = ["offset", "TransactionID", "TransactionDT", "TransactionAmt", "uid"]
    valid = decisioning.with_event_us(_valid_for_enrichment(spark, sf_dir).select(*wanted))

    def catch_up() -> None:
        stream = stateful.velocity_on_stream(filelog.read_stream(spark, log, valid.schema, stages.FILES_PER_TRIGGER))
        sinks.drain_to_files(stream, f"{root}/checkpoint", f"{root}/out")

    _in_halves(valid, F.col("TransactionDT") >= FIFTEEN_DAYS, log, catch_up)
    out = spark.read.parquet(f"{root}/out")
    return out.select(F.col("offset").alias("log_offset"), "uid", *VELOCITY, "velocity_flag", "is_late")


@query
def stream_price_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The moving-window signals from keyed state, restarted half-way."""
    root = scratch_dir(spark, "signals")
    log = f"{root}/log"
    ticks = inputs.faulty_ticks(spark, sf_dir)

    def catch_up() -> None:
        stream = stateful.price_signals_on_stream(filelog.read_stream(spark, log, ticks.schema, stages.FILES_PER_TRIGGER))
        sinks.drain_to_files(stream, f"{root}/checkpoint", f"{root}/out")

    _in_halves(ticks, F.col("ingested_at") >= F.lit("2024-01-16").cast("timestamp_ntz"), log, catch_up)
    return spark.read.parquet(f"{root}/out")


@query
def stream_dimension_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tier changes while a stream runs: every micro-batch reads the versions anew and takes the one of each event's time.

    The second half holds events from before the change, and a tenth of the first half arrives only with it.
    """
    root = scratch_dir(spark, "versions")
    events = inputs.table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    known = inputs.product_versions(spark, sf_dir)
    later = F.col("valid_from") >= F.lit("2024-01-20").cast("timestamp_ntz")
    versions.append_versions(known.filter(~later), f"{root}/dimension")
    held = {"tier": "tier", "valid_from": "since"}

    def enriched(batch: DataFrame) -> DataFrame:
        return versions.attach_as_of(batch, versions.read_versions(spark, f"{root}/dimension", known.schema), "event_type", "ts", held, "event_type")

    def catch_up() -> None:
        sinks.drain_batches(filelog.read_stream(spark, f"{root}/log", events.schema), f"{root}/checkpoint", sinks.fan_out({f"{root}/out": enriched}))

    second = (F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")) | (F.col("event_id") % 10 == 0)
    events.filter(~second).write.parquet(f"{root}/log")
    catch_up()
    versions.append_versions(known.filter(later), f"{root}/dimension")
    events.filter(second).write.mode("append").parquet(f"{root}/log")
    catch_up()
    return spark.read.parquet(f"{root}/out").select("event_id", "tier", "since")


@query
def stream_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query that keeps its trigger while its log grows twice; what its listener reported of each growth, and what it wrote."""
    root = scratch_dir(spark, "trigger")
    ticks = inputs.ticks(spark, sf_dir)
    name = "trigger_" + root.rsplit("-", 1)[-1]
    listener = progress.ProgressRows(name)
    spark.streams.addListener(listener)
    try:
        ticks.filter("seq % 4 = 0").write.parquet(f"{root}/log")
        stream = filelog.read_stream(spark, f"{root}/log", ticks.schema)
        running = sinks.start_batches(stream, f"{root}/checkpoint", sinks.fan_out({f"{root}/out": lambda batch: batch}), "1 second", name)
        first = progress.catch_up(running)
        ticks.filter("seq % 4 <> 0").write.mode("append").parquet(f"{root}/log")
        progress.stop_cleanly(running, listener)
    finally:
        spark.streams.removeListener(listener)
    taken = listener.metrics(spark).filter("metric = 'input_rows'")
    growth = F.when(F.col("batch") <= first, 1).otherwise(2)
    reported = taken.groupBy(growth.alias("growth")).agg(F.sum("value").cast("bigint").alias("input_rows"))
    written = spark.read.parquet(f"{root}/out").withColumn("growth", F.when(F.col("batch_id") <= first, 1).otherwise(2))
    counted = written.groupBy("growth").agg(F.count("*").alias("written_rows"), F.max("seq").alias("last_seq"))
    return reported.join(counted, "growth")


@query
def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fused query where some events of the first half arrive with the second: what went where."""
    root = scratch_dir(spark, "late")
    log = f"{root}/raw"
    dims = inputs.dimensions(spark)
    event = inputs.raw_transactions(spark, sf_dir).select("offset", "TransactionDT")
    source = inputs.messages(spark, sf_dir).join(event, "offset")
    second = (F.col("TransactionDT") >= FIFTEEN_DAYS) | (F.col("offset") % 50 == 0)
    for part in (~second, second):
        source.filter(part).select(*inputs.MESSAGE_SCHEMA.names).write.mode("append").parquet(log)
        stages.run_fused(spark, root, log, dims, inputs.run_ts(), files_per_trigger=100_000)

    def ids(path: str, contract: contracts.Contract, sink: str) -> DataFrame:
        rows = validation.decode_log(spark.read.parquet(path), contract.only(["TransactionID"]))
        return rows.select(F.lit(sink).alias("sink"), F.col("TransactionID").alias("transaction_id"))

    on_time = ids(stages.stage_path(root, contracts.DECISIONS.subject), contracts.DECISIONS, "decision")
    return on_time.unionByName(ids(stages.late_path(root), contracts.DECISIONS, "late"))


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies dropped on a stream, within one micro-batch and across restarts."""
    root = scratch_dir(spark, "dedup")
    log = f"{root}/log"
    fields = ["TransactionID", "TransactionAmt", "uid", "event_timestamp"]
    copies = inputs.with_copies(_valid_for_dedup(spark, sf_dir)).withColumn("event_at", F.col("event_timestamp").cast("timestamp"))
    copies = copies.select(*fields[:-1], "event_at", "offset", "copy")

    def catch_up() -> None:
        stream = filelog.read_stream(spark, log, copies.schema, stages.FILES_PER_TRIGGER)
        kept = arrival.first_on_stream(stream, "TransactionID", "event_at", "60 days")
        sinks.drain_to_files(kept, f"{root}/checkpoint", f"{root}/out")

    _in_halves(copies, (F.col("copy") > 0) & (F.col("offset") % 2 == 0), log, catch_up)
    out = spark.read.parquet(f"{root}/out")
    return out.select(F.col("TransactionID").alias("transaction_id"), F.col("TransactionAmt").alias("transaction_amt"), "uid")


def _valid_for_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["TransactionID", "TransactionDT", "TransactionAmt", "uid", "event_timestamp"]
    valid = inputs.valid_transactions(spark, sf_dir, contracts.VALIDATED.only(fields))
    return valid.withColumn("event_timestamp", F.col("event_timestamp").try_cast("timestamp_ntz"))
