"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest

from tallywatch.plans import decisioning, inputs, registry
from tallywatch.session import scratch_dir
from tallywatch.sources import tables
from pyspark.sql import functions as F


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def decided(spark, sf_dir):
    return plan(registry._decided(spark, sf_dir))


def test_decisions_shuffle_rows_once(decided):
    # rows by (uid, minute); beside them only sums per uid and minute move: combined, by uid, and to the rows' minutes
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", decided)
    assert len(shuffles) <= 4
    assert sum("uid" in keys and "_slice" in keys for keys in shuffles) <= 3
    assert "rangepartitioning" not in decided and "SinglePartition" not in decided


def test_dimensions_are_broadcast(decided):
    dimensions = [line for line in decided.split("\n") if "BroadcastHashJoin" in line and "_slice" not in line]
    assert len(dimensions) == 3 and decided.count("SortMergeJoin") <= 1  # the other join is of rows and their minutes


def test_no_python_in_the_batch_path(decided):
    assert "Python" not in decided and "Pandas" not in decided


def test_window_frames_never_slide(decided):
    assert "unboundedpreceding" in decided and "RangeFrame, -" not in decided


def test_scan_reads_only_used_columns(spark, sf_dir):
    text = plan(registry.QUERIES["ratio_of_sums"](spark, sf_dir))
    assert "ReadSchema: struct<l_extendedprice:double,l_discount:double,l_returnflag:string>" in text


def test_rule_performance_does_not_multiply_rows(spark, sf_dir):
    text = plan(registry.QUERIES["rule_performance_by_rule"](spark, sf_dir))
    # the only expansion is of the single aggregated row
    assert text.index("Generate inline") < text.index("HashAggregate")


@pytest.mark.parametrize("name", ["partition_prune", "calendar_prune"])
def test_day_filters_prune_months_as_the_query_runs(spark, sf_dir, name):
    df = registry.QUERIES[name](spark, sf_dir)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    assert re.search(r"PartitionFilters: \[[^]]*dynamicpruningexpression\(_month#\d+ IN", plan(df))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    df.collect()
    scan = re.search(r"FileScan parquet \[[^]]*_month", plan(df))
    assert scan and "rows" in plan(df)


def test_pruned_folders_are_not_read(spark):
    rows = spark.range(360).selectExpr("id", "date_add(DATE'2024-01-01', CAST(id AS INT)) AS d").unionByName(spark.range(3).selectExpr("id", "CAST(NULL AS DATE) AS d"))
    path = scratch_dir(spark, "pruned")
    tables.write_by_month(rows, path, F.col("d"))
    stored = tables.read_by_month(spark, path, rows.schema)
    assert stored.count() == 363 and stored.filter("day IS NULL").count() == 3
    # a month whose folder is broken: a query of other months never opens it
    broken = f"{path}/rows/_month=2024-07"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{broken}/part-broken.parquet")
    out = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(hadoop)
    out.writeBytes("not parquet")
    out.close()
    stored = tables.read_by_month(spark, path, rows.schema)
    assert stored.filter("day >= DATE'2024-03-05' AND day < DATE'2024-04-03'").count() == 29
    assert stored.filter("day_quarter = '2024-Q2'").count() == 91
    with pytest.raises(Exception, match="part-broken"):
        stored.filter("day = DATE'2024-07-05'").count()


def test_limits_use_top_k(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(registry.QUERIES["telemetry_topk"](spark, sf_dir))


def test_good_records_filters_reach_the_scan(spark):
    from tallywatch.operators import validation

    path = scratch_dir(spark, "pushdown")
    schema = "offset long, TransactionID long, TransactionAmt double, ProductCD string, card1 double, addr1 double, TransactionDT long"
    spark.createDataFrame([(1, 1, 1.0, "W", 1.0, 1.0, 1)], schema).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    text = plan(validation.good_records(spark.read.parquet(path)))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    assert "IsNotNull(TransactionID)" in pushed and "GreaterThan(TransactionAmt,0.0)" in pushed and "In(ProductCD" in pushed


def test_building_the_decision_path_starts_no_job(spark, sf_dir):
    jobs = spark.sparkContext._jsc.sc().dagScheduler().nextJobId
    before = jobs()
    df = registry.QUERIES["fraud_decisions"](spark, sf_dir)
    text = plan(df)
    assert jobs() - before <= 1  # reading the schema of the one table
    assert "SinglePartition" not in text


def test_one_key_of_all_rows_is_split_over_tasks(spark, sf_dir):
    valid = inputs.valid_transactions(spark, sf_dir, decisioning.FOR_ENRICHMENT).withColumn("uid", F.lit("one"))
    enriched = decisioning.enrich(valid, inputs.dimensions(spark))
    assert re.search(r"_slice#\d+L\], \[_at#", plan(enriched))
    assert enriched.count() == valid.count()


def test_write_spreads_a_large_partition(spark):
    df = spark.range(1000).withColumn("p", F.lit("x"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
    path = scratch_dir(spark, "spread")
    tables.for_partitioned_write(df, ["p"]).write.partitionBy("p").parquet(path)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(spark.read.parquet(path).inputFiles()) > 1


def test_scratch_needs_a_shared_folder(spark):
    from tallywatch import session

    class Unshared:
        class conf:
            get = staticmethod(lambda name, default: None)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(Unshared, "x")
    path = scratch_dir(spark, "released")
    spark.range(3).write.parquet(path)
    held, session._given_out[:] = session._given_out[:-1], [path]
    assert session.release_scratch(spark) == 1 and not session.path_exists(spark, path)
    session._given_out[:] = held
