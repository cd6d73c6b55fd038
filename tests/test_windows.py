"""Velocity, price signals and counters against brute force, on streams with ties, gaps and hot keys."""

from __future__ import annotations

import math
import random
import re
import statistics
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tallywatch.operators import arrival, numbering, signals, telemetry
from tallywatch.operators.velocity import COUNT_WIDTHS, SPEND_WIDTHS, add_velocity
from tallywatch.session import scratch_dir
from tallywatch.sources import filelog
from tallywatch.streaming import sinks, stateful

SCHEMA = "offset long, TransactionID long, uid string, event_us long, TransactionAmt double"
NAMES = [*SPEND_WIDTHS, *COUNT_WIDTHS]


def random_events(seed, n=600):
    rng = random.Random(seed)
    events = []
    for i in range(n):
        uid = rng.choice(["hot", "hot", "hot", "a", "b", "c", None, None])
        # whole minutes, so that times repeat and window edges are hit exactly
        at = rng.randrange(0, 3 * 1440) * 60_000_000
        events.append((i, 10_000 + i % 500, uid, at, round(rng.uniform(0.01, 900), 2)))
    return events


def brute_force(events):
    want = {}
    for offset, tid, uid, at, _ in events:
        if uid is None:
            want[offset] = (None,) * len(NAMES)
            continue
        past = [e for e in events if e[2] == uid and (e[3], e[1], e[0]) < (at, tid, offset)]
        spend = [round(sum(e[4] for e in past if e[3] >= at - w) + 1e-9, 2) for w in SPEND_WIDTHS.values()]
        count = [sum(1 for e in past if e[3] >= at - w) for w in COUNT_WIDTHS.values()]
        want[offset] = (*spend, *count)
    return want


def collected(df):
    return {r.offset: tuple(r[n] for n in NAMES) for r in df.collect()}


def same(got, want):
    assert got.keys() == want.keys()
    for offset in want:
        assert got[offset] == pytest.approx(want[offset]) if want[offset][0] is not None else got[offset] == want[offset]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_velocity_equals_brute_force(spark, seed):
    events = random_events(seed)
    same(collected(add_velocity(spark.createDataFrame(events, SCHEMA))), brute_force(events))


def test_velocity_off_the_minute_and_at_its_edges(spark):
    rng = random.Random(11)
    near = [-1, 0, 1]
    at = [rng.randrange(30) * 60_000_000 + rng.choice([0, 60, 300, 3600, 86_400]) * 1_000_000 + rng.choice(near) for _ in range(300)]
    events = [(i, 7 - i % 5, rng.choice("ab"), t, round(rng.uniform(-5, 900), 4)) for i, t in enumerate(at)]
    want = {}
    for offset, tid, uid, t, _ in events:
        past = [e for e in events if e[2] == uid and (e[3], e[1], e[0]) < (t, tid, offset)]
        units = [sum(round(e[4] * 10_000) for e in past if e[3] >= t - w) for w in SPEND_WIDTHS.values()]
        want[offset] = (*[math.floor((u + 50) / 100) / 100 for u in units], *[sum(e[3] >= t - w for e in past) for w in COUNT_WIDTHS.values()])
    same(collected(add_velocity(spark.createDataFrame(events, SCHEMA))), want)


def test_a_hot_day_of_one_uid_spreads_over_tasks(spark):
    """A third of all rows in one uid's day: no task of the row stage gets more than a few minutes of it."""
    hot = [(i, i, "hot", i * 43_000_000, 1.0) for i in range(2000)]
    events = hot + [(2000 + i, i, f"u{i % 500}", i * 20_000_000, 1.0) for i in range(4000)]
    df = add_velocity(spark.createDataFrame(events, SCHEMA))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Window .*\[uid#\d+, _slice#\d+L\], \[_at#", plan)
    assert all("_slice" in keys for keys in re.findall(r"Window .*\[(uid#[^]]*)\], \[_at#", plan))
    dealt = df.withColumn("minute", F.floor(F.col("event_us") / 60_000_000)).groupBy("uid", "minute").count()
    assert dealt.agg(F.max("count")).first()[0] <= 3
    got = {r.offset: r.txn_count_24hr for r in df.filter("uid = 'hot'").collect()}
    assert got == {i: i for i in range(2000)}  # the day is not over: every earlier row counts


def test_times_at_the_ends_of_the_range(spark):
    last = 2**63 - 1
    events = [(1, 1, "u", last - 5, 2.0), (2, 2, "u", last, 3.0), (3, 3, "u", None, 4.0), (4, 4, None, 5, 1.0)]
    got = {r.offset: (r.spend_24hr, r.txn_count_24hr) for r in add_velocity(spark.createDataFrame(events, SCHEMA)).collect()}
    assert got == {1: (0.0, 0), 2: (2.0, 1), 3: (0.0, 0), 4: (None, None)}


def test_velocity_flag_needs_a_day_of_spend(spark):
    hour = 3_600_000_000
    events = [(1, 1, "u", 0, 10.0), (2, 2, "u", 20 * hour, 10.0), (3, 3, "u", 20 * hour + 1, 10.0)]
    got = {r.offset: r.velocity_flag for r in add_velocity(spark.createDataFrame(events, SCHEMA)).collect()}
    assert got == {1: False, 2: False, 3: True}


@pytest.mark.parametrize("batches", [1, 4])
def test_stream_velocity_equals_brute_force_for_any_split(spark, batches):
    events = sorted(random_events(5, 300), key=lambda e: (e[3], e[1], e[0]))
    root = scratch_dir(spark, "stream-velocity")
    edges = [len(events) * i // batches for i in range(batches + 1)]
    # a split never separates events of one time, whose order is by id
    edges = [0] + [next(j for j in range(e, len(events) + 1) if j == len(events) or events[j][3] != events[j - 1][3]) for e in edges[1:]]
    for low, high in zip(edges, edges[1:]):
        spark.createDataFrame(events[low:high], SCHEMA).write.mode("append").parquet(f"{root}/log")
        stream = filelog.read_stream(spark, f"{root}/log", spark.createDataFrame([], SCHEMA).schema)
        sinks.drain_to_files(stateful.velocity_on_stream(stream), f"{root}/cp", f"{root}/out")
    out = spark.read.parquet(f"{root}/out")
    same(collected(out), brute_force(events))
    assert out.filter("is_late").count() == 0


def test_stream_velocity_groups_uids_in_buckets(spark):
    """What reaches the keyed state is a row for each task's bucket, however many uids there are; every column comes back as it was."""
    rows = spark.range(4000).selectExpr(
        "id AS offset", "id AS TransactionID", "concat('u', id % 2000) AS uid", "id * 1000000 AS event_us", "CAST(id % 7 AS DOUBLE) AS TransactionAmt",
        "IF(id % 3 = 0, NULL, 9007199254740993 + id) AS big", "array(id, NULL) AS list", "CAST(id AS DECIMAL(38, 2)) / 4 AS exact",
        "timestamp_micros(id) AS at", "CAST(concat('b', id) AS BINARY) AS body", "IF(id % 11 = 0, 'bad', NULL) AS reject_reason",
    )
    root = scratch_dir(spark, "stream-buckets")
    rows.repartition(2).write.parquet(f"{root}/log")
    stored = spark.read.parquet(f"{root}/log")
    packed = stateful.pieces(stored.coalesce(1), F.col("uid").isNotNull(), "uid", "event_us", "TransactionAmt", "TransactionID", "offset")
    assert packed.count() <= stateful.BUCKETS
    stream = filelog.read_stream(spark, f"{root}/log", stored.schema)
    sinks.drain_to_files(stateful.velocity_on_stream(stream, rejected="reject_reason"), f"{root}/cp", f"{root}/out")
    out = spark.read.parquet(f"{root}/out")
    assert out.select(*rows.columns).schema == stored.schema and out.count() == 4000
    assert out.select(*rows.columns).exceptAll(stored).isEmpty()
    good = add_velocity(stored.filter("reject_reason IS NULL"))
    assert out.filter("reject_reason IS NULL").drop("is_late").select(*good.columns).exceptAll(good).isEmpty()


def test_stream_velocity_marks_late_events_and_passes_rejects(spark):
    day = 86_400_000_000
    root = scratch_dir(spark, "stream-late")
    schema = SCHEMA + ", reject_reason string"
    parts = [
        [(1, 1, "u", 0, 5.0, None), (2, 2, "u", 3 * day, 7.0, None), (3, 3, "u", 0, 9.0, "bad")],
        [(4, 4, "u", day, 1.0, None), (5, 5, "u", 3 * day - 60_000_000, 2.0, None)],
    ]
    for part in parts:
        spark.createDataFrame(part, schema).write.mode("append").parquet(f"{root}/log")
        stream = filelog.read_stream(spark, f"{root}/log", spark.createDataFrame([], schema).schema)
        tracked = stateful.velocity_on_stream(stream, rejected="reject_reason")
        sinks.drain_to_files(tracked, f"{root}/cp", f"{root}/out")
    got = {r.offset: r for r in spark.read.parquet(f"{root}/out").collect()}
    assert len(got) == 5
    assert got[4].is_late and not got[5].is_late and not got[2].is_late
    assert got[3].spend_24hr is None and got[3].reject_reason == "bad"
    # the late event at day 3 minus a minute sees nothing newer than itself
    assert got[5].spend_24hr == 0.0


def test_idle_state_is_dropped_and_timers_follow_the_last_event():
    pd = pytest.importorskip("pandas")

    class State:
        rows: list = []

        def get(self):
            return iter(self.rows)

        def put(self, rows):
            self.rows = list(rows)

        def appendList(self, rows):
            self.rows = [*self.rows, *rows]

        def clear(self):
            self.rows = []

    class Handle:
        timers: list = []

        def getListState(self, name, schema):
            return State()

        def listTimers(self):
            return iter(self.timers)

        def deleteTimer(self, at):
            self.timers = [t for t in self.timers if t != at]

        def registerTimer(self, at):
            self.timers = [*self.timers, at]

    class Clock:
        now = 1000

        def getCurrentProcessingTimeInMs(self):
            return self.now

    day = 86_400_000_000
    processor = stateful._velocity_processor(list(SPEND_WIDTHS.values()), list(COUNT_WIDTHS.values()), day, day, 50, ["carry"])
    handle, clock = Handle(), Clock()
    processor.init(handle)

    def feed(*times):
        rows = pd.DataFrame({"carry": ["{}"] * len(times), "event_us": times, "tie": 1, "row_id": 1, "high": 0, "low": 100})
        return pd.concat(list(processor.handleInputRows(("u:x",), iter([rows]), clock)))

    assert feed(0, 0, day // 2)["v7"].tolist() == [0, 100, 200]
    assert len(processor.history.rows) == 2
    clock.now = 2000
    feed(10 * day)
    assert handle.timers == [2050]
    # everything before the last event is stale by now
    assert [r[0] for r in processor.history.rows] == [10 * day]
    list(processor.handleExpiredTimer(("u:x",), clock, None))
    assert processor.history.rows == []


def ticks_of(n=400, hot=0.6, seed=7):
    rng = random.Random(seed)
    names = [rng.random() for _ in range(n)]
    return [("hot" if x < hot else "cold", round(rng.uniform(90, 110), 2), i * 3) for i, x in enumerate(names)]


def expected_signals(ticks):
    want, seen = {}, {}
    for symbol, price, seq in ticks:
        window = seen.setdefault(symbol, [])
        window.append(price)
        del window[:-50]
        if len(window) >= 10:
            mean = sum(window) / len(window)
            want[seq] = (mean, (price - mean) / mean * 100, statistics.pstdev(window))
    return want


@pytest.mark.parametrize("chunk_rows, slice_rows", [(64, 100), (50_000, 1_000_000), (200, 7)])
def test_price_signals_equal_ring_buffer(spark, chunk_rows, slice_rows):
    ticks = ticks_of()
    df = spark.createDataFrame(ticks, "symbol string, price double, seq long").withColumn("ingested_at", F.lit("t"))
    got = {r.seq: (r.ma, r.deviation_pct, r.volatility) for r in signals.price_signals(df, chunk_rows, slice_rows).collect()}
    want = expected_signals(ticks)
    assert got.keys() == want.keys()
    for seq in want:
        assert got[seq] == pytest.approx(want[seq], abs=1e-9)


def test_prices_that_cannot_be_used_are_rejected(spark):
    ticks = ticks_of(120)
    bad = [("hot", None, 1), ("hot", float("nan"), 4), ("cold", float("inf"), 7), ("cold", float("-inf"), 10), (None, 5.0, 13)]
    df = spark.createDataFrame(ticks + bad, "symbol string, price double, seq long").withColumn("ingested_at", F.lit("t"))
    got = {r.seq: (r.ma, r.deviation_pct, r.volatility) for r in signals.price_signals(df).collect()}
    want = expected_signals(ticks)
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s], abs=1e-6) for s in want)
    reasons = {r.seq: r.reason for r in signals.price_rejects(df).collect()}
    assert reasons == {1: "null_price", 4: "nan_price", 7: "infinite_price", 10: "infinite_price", 13: "null_symbol"}


@pytest.mark.parametrize("size", [1.0, 4.2e-9, 1e9, 1e15, 1e-200, 1e300])
def test_prices_of_any_size_are_taken_as_they_are(spark, size):
    """Against exact fractions, also where one size follows another inside a window."""
    rng = random.Random(1)
    prices = [rng.uniform(90, 110) * (size if 40 <= k < 120 else 1.0) for k in range(200)]
    df = spark.createDataFrame([("s", p, k) for k, p in enumerate(prices)], "symbol string, price double, seq long")
    got = {r.seq: r for r in signals.price_signals(df.withColumn("ingested_at", F.lit("t")), 64).collect()}
    assert sorted(got) == list(range(9, 200))
    for k, row in got.items():
        window = [Fraction(p) for p in prices[max(0, k - 49) : k + 1]]
        mean = sum(window) / len(window)
        variance = sum((p - mean) ** 2 for p in window) / len(window)
        assert row.ma == pytest.approx(float(mean), rel=1e-15)
        assert row.deviation_pct == pytest.approx(float((window[-1] - mean) / mean * 100), rel=1e-9)
        exponent = 2 ** (math.frexp(max(map(float, window)))[1])
        assert row.volatility == pytest.approx(math.sqrt(variance / Fraction(exponent) ** 2) * exponent, rel=1e-9)


def test_mean_of_zero_has_no_deviation(spark):
    df = spark.createDataFrame([("s", float((-1) ** k), k) for k in range(10)], "symbol string, price double, seq long")
    row = signals.price_signals(df.withColumn("ingested_at", F.lit("t"))).collect()
    assert [(r.ma, r.deviation_pct, r.volatility, r.severity) for r in row] == [(0.0, None, 1.0, "NORMAL")]


def test_large_amounts_are_summed_whole(spark):
    events = [(1, 1, "u", 0, 1e15), (2, 2, "u", 1_000_000, 3e17), (3, 3, "u", 2_000_000, 0.25), (4, 4, "u", 3_000_000, 1.0)]
    df = spark.createDataFrame(events, SCHEMA)
    want = {1: 0.0, 2: 1e15, 3: 3.01e17, 4: 3.01e17}
    assert {r.offset: r.spend_24hr for r in add_velocity(df).collect()} == want
    root = scratch_dir(spark, "stream-large")
    df.write.parquet(f"{root}/log")
    stream = filelog.read_stream(spark, f"{root}/log", df.schema)
    sinks.drain_to_files(stateful.velocity_on_stream(stream), f"{root}/cp", f"{root}/out")
    assert {r.offset: r.spend_24hr for r in spark.read.parquet(f"{root}/out").collect()} == want


def test_severity_bands(spark):
    df = spark.createDataFrame([(0.1,), (-0.11,), (0.31,), (-0.51,), (None,)], "d double")
    got = [r[0] for r in df.select(signals.severity(F.col("d"))).collect()]
    assert got == ["NORMAL", "WATCH", "ALERT", "CRITICAL", "NORMAL"]


def test_row_numbers_with_sparse_sequence(spark):
    rows = [("a", s) for s in (5, 17, 1000, 1001, 99_999)] + [("b", 3)]
    df = numbering.number_rows(spark.createDataFrame(rows, "g string, s long"), "g", "s", slice_rows=10)
    assert {(r.g, r.s): r.row_no for r in df.collect()} == {("a", 5): 1, ("a", 17): 2, ("a", 1000): 3, ("a", 1001): 4, ("a", 99_999): 5, ("b", 3): 1}


def test_counter_increase_with_resets(spark):
    rng = random.Random(3)
    samples, value = [], 0
    for i in range(300):
        value = 0 if rng.random() < 0.1 else value + rng.randrange(5)
        samples.append(("s", 1_704_067_200 + i * 37, i, value))
    df = spark.createDataFrame(samples, "series string, at long, seq long, value long")
    df = df.withColumn("ts", F.timestamp_seconds("at").cast("timestamp_ntz"))
    got = {r.bucket_start: (r.increase, r.samples) for r in telemetry.counter_increase(df, 3600).collect()}
    want: dict = {}
    for (_, at, _, v), previous in zip(samples, [None, *samples]):
        bucket = at // 3600
        grown, n = want.get(bucket, (0, 0))
        if previous is not None and previous[1] // 3600 == bucket:
            grown += v if v < previous[3] else v - previous[3]
        want[bucket] = (grown, n + 1)
    assert sorted(got.values()) == sorted(want.values())
    with pytest.raises(ValueError):
        telemetry.counter_increase(df, 90)


def test_sustained_needs_an_unbroken_stretch(spark):
    # on for 0..5, off at 6, on 7..9, silence, on 100..101
    samples = [("m", i, 1.0 if i != 6 else 0.0) for i in range(10)] + [("m", 100, 1.0), ("m", 101, 1.0)]
    df = spark.createDataFrame(samples, "metric string, minute long, value double")
    df = df.withColumn("ts", F.timestamp_seconds(F.col("minute") * 60).cast("timestamp_ntz"))
    out = telemetry.sustained(df, ["metric"], "ts", F.col("value") > 0.5, 300, 600).collect()
    assert len(out) == 1 and out[0].samples == 6
    assert (out[0].fired_at - out[0].active_since).total_seconds() == 300


def test_dedup_keeps_first_and_all_keyless(spark):
    rows = [(1, 5, "b"), (1, 3, "a"), (2, 1, "c"), (None, 1, "d"), (None, 2, "e")]
    df = spark.createDataFrame(rows, "id long, at long, v string")
    assert sorted(r.v for r in arrival.first_per_key(df, "id", ["at"]).collect()) == ["a", "c", "d", "e"]


def test_late_split(spark):
    rows = [(0, 100), (0, 500), (1, 390), (1, 410), (2, 1000), (3, 899), (3, 900)]
    df = spark.createDataFrame(rows, "batch int, us long")
    on_time, late = arrival.split_late(arrival.flag_late(df, "batch", "us", 100))
    assert sorted(r.us for r in late.collect()) == [390, 899]
    assert on_time.count() == 5
