"""Dimension versions, contracts by id, CSV rejects with lineage, replay order and running triggers."""

from __future__ import annotations

import datetime
import random

from pyspark.sql import functions as F

from tallywatch.functions import wire
from tallywatch.operators import contracts, resolution, versions
from tallywatch.session import scratch_dir
from tallywatch.sources import filelog, files
from tallywatch.streaming import progress, sinks

START = datetime.datetime(2024, 1, 1)
FIELD, CONTRACT = contracts.Field, contracts.Contract


def at(minutes):
    return None if minutes is None else START + datetime.timedelta(minutes=minutes)


def test_as_of_equals_a_plain_search(spark):
    rng = random.Random(6)
    known = [(rng.choice(["a", "b", None]), at(rng.choice([None, *range(0, 100, 7)])), n, f"v{n}") for n in range(60)]
    facts = [(n, rng.choice(["a", "b", "c", None]), at(rng.choice([None, *range(-5, 110)]))) for n in range(300)]
    out = versions.attach_as_of(
        spark.createDataFrame(facts, "id long, k string, ts timestamp_ntz"),
        spark.createDataFrame(known, "key string, valid_from timestamp_ntz, written long, tier string"),
        "k", "ts", {"tier": "tier"}, "key",
    )
    want = {}
    for n, key, ts in facts:
        held = [v for v in known if key is not None and ts is not None and v[0] == key and v[1] is not None and v[1] <= ts]
        want[n] = max(held, key=lambda v: (v[1], v[2]))[3] if held else None
    rows = out.collect()
    assert len(rows) == len(facts) and {r.id: r.tier for r in rows} == want


def test_as_of_without_versions_keeps_all_facts(spark):
    facts = spark.createDataFrame([(1, "a", START)], "id long, k string, ts timestamp_ntz")
    none = spark.createDataFrame([], "key string, valid_from timestamp_ntz, written long, tier string")
    assert [tuple(r) for r in versions.attach_as_of(facts, none, "k", "ts", {"tier": "tier"}, "key").collect()] == [(1, "a", START, None)]


def test_each_message_is_read_by_the_contract_of_its_id(spark):
    old = CONTRACT("s", 1, (FIELD("txn", "int"), FIELD("size", "string"), FIELD("gone", "string")))
    new = CONTRACT("s", 2, (FIELD("id", "long", False), FIELD("size", "double"), FIELD("tag", "string", False, "none")))
    foreign = CONTRACT("s", 3, (FIELD("size", "double"),))  # has no id at all
    reader = CONTRACT("s", 9, (FIELD("id", "long", False), FIELD("size", "double"), FIELD("tag", "string", False, "none"), FIELD("more", "int")))
    bodies = [
        (1, 1, '{"txn": 7, "size": "2.5", "gone": "x"}'),
        (2, 1, '{"txn": 8, "size": "much"}'),
        (3, 2, '{"id": 5000000000, "size": 1.5, "tag": "t"}'),
        (4, 2, '{"id": 9}'),
        (5, 3, '{"size": 1.0}'),
        (6, 4, '{"id": 9}'),
        (7, 2, '{"id": 9'),
        (8, None, '{"id": 9}'),
    ]
    df = spark.createDataFrame(bodies, "offset long, sid int, body string")
    framed = F.when(F.lit(False), F.lit(None).cast("binary"))
    for k in (1, 2, 3, 4):
        framed = framed.when(F.col("sid") == k, wire.frame(F.col("body"), k))
    log = df.select("offset", framed.otherwise(F.col("body").cast("binary")).alias("value"))
    with_null = log.unionByName(log.limit(1).select(F.lit(9).cast("long").alias("offset"), F.lit(None).cast("binary").alias("value")))
    rows = resolution.decode_by_id(with_null, reader, (old, new, foreign), {"id": ("txn",)}).collect()
    got = {r.offset: (r.reason, r.id, r.size, r.tag, r.more) for r in rows}
    assert got == {
        1: (None, 7, 2.5, "none", None),
        2: (None, 8, None, "none", None),
        3: (None, 5_000_000_000, 1.5, "t", None),
        4: (None, 9, None, "none", None),
        5: ("unresolvable:id", None, None, None, None),
        6: ("unknown_schema:4", None, None, None, None),
        7: ("unreadable", None, None, None, None),
        8: ("not_framed", None, None, None, None),
        9: ("not_framed", None, None, None, None),
    }


def test_broken_lines_and_where_they_came_from(spark):
    path = scratch_dir(spark, "broken-csv")
    lines = ["1,a,x", "2,b", "3,c,x,extra", '4,"d', "", "5,e,", "6,,"]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    scanned = files.scan_csv(spark, path, ["n", "name", "tag"], lineage=True, header=False)
    good, rejects = files.split_corrupt(scanned)
    assert {(r.n, r.name, r.tag) for r in good.collect()} == {("1", "a", "x"), ("5", "e", None), ("6", None, None)}
    assert {(r.line, r.reason) for r in rejects.collect()} == {("2,b", "too_few_fields"), ("3,c,x,extra", "too_many_fields"), ('4,"d', "quoting")}
    assert all(r.source_file.startswith("file:") and r.source_bytes > 0 and r.source_modified for r in rejects.collect())
    traced = contracts.with_lineage(good, F.lit(START), F.col("source_file"), "phase").collect()
    assert len({r.ingestion_id for r in traced}) == 3 and all(r.source_file.endswith(".txt") for r in traced)


def test_a_reader_meets_a_key_in_event_order(spark):
    rng = random.Random(8)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(20)}", rng.randrange(10_000), n) for n in range(2000)]
    df = spark.createDataFrame(rows, "key string, at long, n long")
    path = scratch_dir(spark, "replayed")
    filelog.replay(df, "key", ["at", "n"], 3, tasks=7).write.parquet(path)
    read = filelog.read_positions(spark, path, spark.read.parquet(path).schema)
    met = {}
    for r in sorted(read.collect(), key=lambda r: (r.partition, tuple(r.position))):
        met.setdefault(r.key, []).append((r["at"], r.n))
    assert all(seen == sorted(seen) for seen in met.values()) and sum(map(len, met.values())) == 2000


def test_a_micro_batch_is_bounded_in_bytes(spark):
    root = scratch_dir(spark, "bytes")
    for _ in range(4):
        spark.range(1000).coalesce(1).write.mode("append").parquet(f"{root}/log")
    stream = filelog.read_stream(spark, f"{root}/log", spark.range(1).schema, bytes_per_trigger=1)
    sizes = []
    sinks.drain_batches(stream, f"{root}/cp", lambda batch, _: sizes.append(batch.count()))
    assert sizes == [1000] * 4


def test_a_running_query_reports_its_triggers_and_stops(spark):
    root = scratch_dir(spark, "running")
    name = "running_" + root.rsplit("-", 1)[-1]
    listener = progress.ProgressRows(name)
    spark.streams.addListener(listener)
    spark.range(10).coalesce(1).write.parquet(f"{root}/log")
    stream = filelog.read_stream(spark, f"{root}/log", spark.range(1).schema)
    query = sinks.start_batches(stream, f"{root}/cp", sinks.fan_out({f"{root}/out": lambda b: b}), "200 milliseconds", name)
    first = progress.catch_up(query)
    spark.range(5).coalesce(1).write.mode("append").parquet(f"{root}/log")
    progress.stop_cleanly(query, listener)
    spark.streams.removeListener(listener)
    assert listener.ended and not query.isActive
    rows = {r.batch: r.value for r in listener.metrics(spark).filter("metric = 'input_rows' AND value > 0").collect()}
    assert list(rows.values()) == [10.0, 5.0] and min(rows) <= first < max(rows)
    assert spark.read.parquet(f"{root}/out").count() == 15
