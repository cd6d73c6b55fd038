"""Sinks, tables, logs and audits: retries, empty batches, idempotent loads, bounded reads."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from tallywatch.operators import enrichment, quality, telemetry
from tallywatch.plans import gold, inputs, registry
from tallywatch.session import path_exists, scratch_dir
from tallywatch.sources import filelog, files, tables
from tallywatch.streaming import sinks


def test_retried_batch_is_written_once(spark):
    path = scratch_dir(spark, "once")
    sinks.write_batch_once(spark.range(5), path, 3)
    sinks.write_batch_once(spark.range(100), path, 3)
    sinks.write_batch_once(spark.range(2), path, 4)
    assert spark.read.parquet(path).count() == 7


def test_unfinished_batch_is_replaced(spark):
    path = scratch_dir(spark, "unfinished")
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/batch_id=0")
    sinks.write_batch_once(spark.range(4), path, 0)
    assert spark.read.parquet(path).count() == 4


def test_empty_batch_writes_nothing(spark):
    path = scratch_dir(spark, "empty")
    sinks.fan_out({path: lambda df: df})(spark.range(0), 0)
    assert not path_exists(spark, path)


def test_fan_out_writes_every_output(spark):
    root = scratch_dir(spark, "fan")
    sinks.fan_out({f"{root}/even": lambda d: d.filter("id % 2 = 0"), f"{root}/all": lambda d: d})(spark.range(10), 0)
    assert spark.read.parquet(f"{root}/even").count() == 5 and spark.read.parquet(f"{root}/all").count() == 10


def test_second_drain_adds_nothing(spark):
    root = scratch_dir(spark, "drain")
    spark.range(20).write.parquet(f"{root}/log")
    for _ in range(2):
        stream = filelog.read_stream(spark, f"{root}/log", spark.range(1).schema)
        sinks.drain_batches(stream, f"{root}/cp", sinks.fan_out({f"{root}/out": lambda d: d}))
    assert spark.read.parquet(f"{root}/out").count() == 20


def test_refresh_overwrites_only_its_partitions(spark):
    path = scratch_dir(spark, "refresh")
    tables.refresh_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string"), path, ["p"])
    for _ in range(2):
        tables.refresh_partitions(spark.createDataFrame([(3, "b")], "x int, p string"), path, ["p"])
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == [1, 3]


def test_expectation_and_audit(spark):
    path = scratch_dir(spark, "audit")
    assert quality.audited_append(spark.range(3), path, "t") == ("t", 0, 3, 3)
    assert quality.audited_append(spark.range(2), path, "t") == ("t", 3, 2, 5)
    with pytest.raises(quality.ExpectationFailed, match="Unexpected bronze row count: 3. Expected 4."):
        quality.expect_rows(3, 4, "bronze")


def test_bounded_read(spark):
    path = scratch_dir(spark, "bounded")
    spark.createDataFrame([(p, o) for p in range(3) for o in range(10)], "partition int, offset long").write.parquet(path)
    got = filelog.read_bounded(spark, path, start={0: 4}, end={1: 7}).groupBy("partition").count().collect()
    assert {r.partition: r["count"] for r in got} == {0: 6, 1: 7, 2: 10}
    assert filelog.read_bounded(spark, path).count() == 30


def test_replay_is_ordered_within_each_key_across_files(spark):
    rows = [(f"k{i % 3}" if i % 2 else "hot", (i * 7919) % 1000, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "uid string, at long, id long")
    placed = filelog.replay(df, "uid", ["at", "id"], 4, tasks=6).withColumn("task", F.spark_partition_id())
    parts = placed.withColumn("place", F.monotonically_increasing_id()).orderBy("place").collect()
    last: dict = {}
    for r in parts:
        assert last.get(r.uid, (-1, -1)) < (r.at, r.id)
        last[r.uid] = (r.at, r.id)
    # the hot key holds half of the rows and is shared by several tasks
    assert len({r.task for r in parts if r.uid == "hot"}) > 1


def test_csv_keeps_unreadable_lines(spark):
    path = scratch_dir(spark, "csv")
    spark.createDataFrame([("TransactionID,amt",), ("1,2.5",), ("2,x",), ("3,4,5",)], "v string").coalesce(1).write.text(path)
    df = files.cast_columns(files.scan_csv(spark, path, ["TransactionID", "amt"]), {"TransactionID": "long", "amt": "double"}).cache()
    got = {r.TransactionID: (r.amt, r._corrupt_record) for r in df.collect()}
    assert got[1] == (2.5, None) and got[2] == (None, None) and got[3][1] == "3,4,5"


def test_identity_join_keeps_keyless_rows_apart(spark):
    left = spark.createDataFrame([(i, None if i % 3 == 0 else i) for i in range(300)], "offset long, TransactionID long")
    right = spark.createDataFrame([(i, float(i)) for i in range(0, 300, 2)], "TransactionID long, id_01 double")
    joined = enrichment.attach_identity(left, right)
    assert joined.count() == 300
    assert joined.filter("id_01 is not null").count() == sum(1 for i in range(300) if i % 3 and i % 2 == 0)


def test_dimension_keeps_the_smallest_row_of_a_key(spark):
    rows = [("a", 2, None), ("a", 1, "y"), ("a", 1, "x"), ("b", None, "z"), (None, 1, "n")]
    got = enrichment.one_per_key(spark.createDataFrame(rows, "k string, v int, w string"), "k").collect()
    assert sorted(map(tuple, got)) == [("a", 1, "x"), ("b", None, "z")]


def test_namespace_table_and_view(spark):
    name, root = registry._database(spark, "ddl")
    columns, partitions = tables.LAYOUTS["silver_decisions"]
    for _ in range(2):
        tables.create_table(spark, f"{name}.silver_decisions", columns, partitions, f"{root}/silver_decisions")
    assert set(spark.table(f"{name}.silver_decisions").columns) == set(columns)
    tables.create_view(spark, f"{name}.v", f"SELECT decision, count(*) AS n FROM {name}.silver_decisions GROUP BY decision")
    assert spark.table(f"{name}.v").count() == 0


def test_gold_of_nothing_is_empty(spark, sf_dir):
    none = registry._decisions(spark, sf_dir).filter("1 = 0")
    day = F.lit(datetime.date(2024, 2, 1))
    assert gold.rule_performance(none, day).count() == 0
    assert gold.daily_fraud_summary(none).count() == 0
    assert gold.fraud_totals(gold.daily_fraud_summary(none)).collect()[0].avg_fraud_rate is None


def test_alert_rules_fire(spark):
    rows = [("fraud_daily_fraud_rate", {}, 0.06), ("fraud_silver_decisions_count", {}, 0.0), ("fraud_product_fraud_rate", {"product": "C"}, 0.2), ("fraud_product_fraud_rate", {"product": "W"}, 0.9)]
    df = spark.createDataFrame(rows, "metric string, labels map<string,string>, value double")
    got = {r.alert: r.active for r in telemetry.evaluate_alerts(df).collect()}
    assert got == {"FraudRateSpikeDetected": False, "FraudPipelineDLQNonZero": True, "FraudRateElevated": True, "HighRiskProductCFraudRate": True}


def test_broker_options(spark):
    options = filelog.broker_stream_options("host:9092", "t")
    assert options["maxOffsetsPerTrigger"] == "5000" and options["failOnDataLoss"] == "false"
    assert filelog.broker_batch_options("host:9092", "t")["endingOffsets"] == "latest"
    assert filelog.broker_available(spark) in (True, False)


def test_scratch_follows_the_configured_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    assert root is None or scratch_dir(spark, "x").startswith(root.rstrip("/"))
    assert inputs.run_ts() is not None


def test_all_table_layouts(spark, sf_dir):
    from tallywatch.plans import gold, inputs

    name, root = registry._database(spark, "layouts")
    for table, (columns, partitions) in tables.LAYOUTS.items():
        for _ in range(2):
            tables.create_table(spark, f"{name}.{table}", columns, partitions, f"{root}/{table}")
        assert dict(spark.table(f"{name}.{table}").dtypes) == columns
    assert len(tables.LAYOUTS) == 8
    decisions = registry._decisions(spark, sf_dir)
    day = F.to_date(inputs.run_ts())
    loads = {
        "daily_fraud_summary": gold.daily_fraud_summary(decisions),
        "hourly_fraud_pattern": gold.hourly_fraud_pattern(decisions, day),
        "rule_performance": gold.rule_performance(decisions, day),
        "uid_risk_profile": gold.uid_risk_profile(decisions),
    }
    for table, rows in loads.items():
        stamped = rows.withColumn("updated_at", inputs.run_ts())
        if table != "uid_risk_profile":
            stamped = stamped.withColumn("month", tables.month_of(F.col("summary_date")))
        tables.append_table(stamped, f"{name}.{table}")
        assert spark.table(f"{name}.{table}").count() == rows.count()


def test_days_prune_months(spark):
    path = scratch_dir(spark, "months")
    days = spark.range(400).select(F.date_add(F.to_date(F.lit("2024-01-01")), F.col("id").cast("int")).alias("day"), "id")
    days.withColumn("month", tables.month_of(F.col("day"))).write.partitionBy("month").parquet(path)
    some = tables.between_days(spark.read.parquet(path), "day", "month", "2024-03-10", "2024-04-02")
    assert some.count() == 24
    text = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in text
