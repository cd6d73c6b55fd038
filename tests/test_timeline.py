"""Counter look-backs and last values at evaluation times against plain loops."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tallywatch.operators import timeline

START = datetime.datetime(2024, 1, 1)
WIDTHS = {"i1": 300, "i6": 1800}


def counters(seed, n=400, span=20_000, series=("a", "b", None)):
    rng = random.Random(seed)
    rows, value = [], 0
    for i in range(n):
        value = rng.randrange(5) if rng.random() < 0.1 else value + rng.randrange(9)
        # many moments on whole steps, some shared by several samples
        second = rng.choice([rng.randrange(span), rng.randrange(span // 300) * 300])
        rows.append((rng.choice(series), START + datetime.timedelta(seconds=second), i, None if rng.random() < 0.02 else value))
    return rows


def expected_rates(rows, step=300):
    out = {}
    for name in {r[0] for r in rows if r[0] is not None}:
        mine = sorted((t, q, v) for s, t, q, v in rows if s == name and t is not None and v is not None)
        total, run = [], 0
        for k, (_, _, v) in enumerate(mine):
            run += 0 if k == 0 else v if v < mine[k - 1][2] else v - mine[k - 1][2]
            total.append(run)
        k, last = 0, mine[-1][0] + datetime.timedelta(seconds=max(WIDTHS.values()))
        while (at := START + datetime.timedelta(seconds=k * step)) < last:
            inside = {n: [r for (t, _, _), r in zip(mine, total) if at - datetime.timedelta(seconds=w) < t <= at] for n, w in WIDTHS.items()}
            if inside["i6"]:
                out[name, at] = tuple(r[-1] - r[0] if len(r) > 1 else None for r in inside.values())
            k += 1
    return out


@pytest.mark.parametrize("seed, slice_seconds", [(1, 86_400), (2, 300), (3, 1200)])
def test_rates_equal_plain_loops(spark, seed, slice_seconds):
    rows = counters(seed)
    df = spark.createDataFrame(rows, "series string, ts timestamp_ntz, seq long, value long")
    out = timeline.counter_rates(df, 300, WIDTHS, {"rate": 300}, slice_seconds)
    got = {(r.series, r.evaluated_at): (r.i1, r.i6) for r in out.collect()}
    assert got == expected_rates(rows)
    assert all(r.rate == r.i1 / 300 if r.i1 is not None else r.rate is None for r in out.collect())


def test_rates_of_nothing_and_of_odd_widths(spark):
    df = spark.createDataFrame([], "series string, ts timestamp_ntz, seq long, value long")
    assert timeline.counter_rates(df, 300, WIDTHS, {}).collect() == []
    with pytest.raises(ValueError):
        timeline.counter_rates(df, 300, {"x": 450}, {})


def test_a_busy_series_is_shared_by_slices(spark):
    rows = [("hot", START + datetime.timedelta(seconds=i * 40), i, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "series string, ts timestamp_ntz, seq long, value long")
    out = timeline.counter_rates(df, 300, {"i1": 3600}, {}, 3600)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(series" in plan and "_slice" in plan
    middle = out.filter(F.col("evaluated_at") == F.lit(START + datetime.timedelta(hours=20))).first()
    assert middle.i1 == 89  # 90 samples in the hour


def test_last_values_age_out(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), START + datetime.timedelta(seconds=rng.randrange(0, 40_000)), i, rng.choice([None, i])) for i in range(60)]
    rows += [("a", None, 99, 1), (None, START, 100, 5)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, seq long, v long")
    got = {(r.k, r.evaluated_at): r.v for r in timeline.last_at_steps(df, ["k"], ["v"], 600, 1500).collect()}
    want = {}
    for key in ("a", "b", None):
        for step in range(200):
            at = START + datetime.timedelta(seconds=600 * step)
            seen = [r for r in rows if r[0] == key and r[1] is not None and r[1] <= at]
            if seen:
                newest = max(seen, key=lambda r: (r[1], r[2]))
                if at - newest[1] <= datetime.timedelta(seconds=1500):
                    want[key, at] = newest[3]
    assert got == want
