"""Series seen at regular evaluation times: counter rates over sliding look-backs, and last values not older than a limit.

Samples are first reduced to one row per series and step, in slices of time, so a busy series is shared by many
tasks; what follows costs steps, not samples.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.functions.numbers import safe_divide

SECOND_US = 1_000_000
SLICE_SECONDS = 86_400


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _step_of(us: Column, step_seconds: int) -> Column:
    """The first evaluation time at or after a moment, as a number of steps. Whole numbers: a double would not hold every moment."""
    step = F.lit(step_seconds * SECOND_US)
    rest = F.pmod(us, step)
    return F.round((us - rest) / step).cast("bigint") + F.when(rest > 0, 1).otherwise(0)


def _step_time(step: Column, step_seconds: int) -> Column:
    return F.timestamp_seconds(step * F.lit(step_seconds)).cast("timestamp_ntz")


def growth(value: Column, previous: Column) -> Column:
    """Growth from one sample to the next; after a reset the new value itself, for the first sample nothing."""
    return F.when(previous.isNull(), F.lit(0)).when(value < previous, value).otherwise(value - previous)


def counter_rates(
    samples: DataFrame,
    step_seconds: int,
    increases: dict[str, int],
    rates: dict[str, int],
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Increase and rate of (series, ts, seq, value) counters over look-backs that end at every evaluation time.

    A look-back of width w at time t holds the samples in (t - w, t]; its increase is the growth from its first sample to its
    last, resets handled, and NULL where it holds fewer than two. All widths (in seconds, whole steps) come from one total that
    runs over the whole series: inside a slice from sample to sample, and from slice to slice by the growth from
    the last value of one to the first value of the next. ``value`` is a whole number; samples without a
    series, a time or a value are left out. A time is reported where the widest look-back holds a sample.
    """
    widths = increases | rates
    steps = {n: w // step_seconds for n, w in widths.items()}
    if slice_seconds % step_seconds or any(w % step_seconds for w in widths.values()):
        raise ValueError("widths and slices must be whole steps")
    usable = samples.filter(F.col("series").isNotNull() & F.col("ts").isNotNull() & F.col("value").isNotNull())
    cut = usable.select("series", "ts", "seq", "value", _step_of(_micros("ts"), step_seconds).alias("_k"))
    cut = cut.withColumn("_slice", F.floor((F.col("_k") - 1) / F.lit(slice_seconds // step_seconds)))
    order = Window.partitionBy("series", "_slice").orderBy("ts", "seq")
    grown = cut.withColumn("_grown", growth(F.col("value"), F.lag("value").over(order)))
    running = grown.withColumn("_total", F.sum("_grown").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    place = F.struct("ts", "seq")
    stepped = running.groupBy("series", "_slice", "_k").agg(
        F.min_by("_total", place).alias("_first"),
        F.max_by("_total", place).alias("_last"),
        F.min_by("value", place).alias("_first_value"),
        F.max_by("value", place).alias("_last_value"),
        F.count(F.lit(1)).alias("_n"),
    )
    along = Window.partitionBy("series").orderBy("_k")
    opens = F.lag("_slice").over(along) != F.col("_slice")
    bridge = F.lag("_last").over(along) + growth(F.col("_first_value"), F.lag("_last_value").over(along))
    carried = stepped.withColumn("_bridge", F.when(opens, bridge).otherwise(F.lit(0)))
    carried = carried.withColumn("_carried", F.sum("_bridge").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    whole = carried.select(
        "series",
        "_k",
        "_n",
        (F.col("_first") + F.col("_carried")).alias("_first"),
        (F.col("_last") + F.col("_carried")).alias("_last"),
        F.least(F.lead("_k").over(along), F.col("_k") + F.lit(max(steps.values()))).alias("_until"),
    )
    at_steps = whole.withColumn("_step", F.explode(F.sequence(F.col("_k"), F.col("_until") - 1)))
    here = F.col("_step") == F.col("_k")
    at_steps = at_steps.select("series", "_step", *[F.when(here, F.col(c)).alias(c) for c in ("_n", "_first", "_last")])

    def over(width: int):
        return Window.partitionBy("series").orderBy("_step").rangeBetween(1 - width, Window.currentRow)

    figures = {}
    for name, width in steps.items():
        grown_by = F.last("_last", ignorenulls=True).over(over(width)) - F.first("_first", ignorenulls=True).over(over(width))
        figures[name] = F.when(F.sum("_n").over(over(width)) >= 2, grown_by.cast("bigint"))
    out = at_steps.withColumns(figures)
    return out.select(
        "series",
        _step_time(F.col("_step"), step_seconds).alias("evaluated_at"),
        *[F.col(n) for n in increases],
        *[(F.col(n).cast("double") / F.lit(float(w))).alias(n) for n, w in rates.items()],
    )


def last_at_steps(samples: DataFrame, keys: list[str], values: list[str], step_seconds: int, limit_seconds: int, ts: str = "ts", tie: str = "seq") -> DataFrame:
    """``keys, evaluated_at, values`` at every evaluation time: of each key the values of its last sample, if not older than the limit.

    A sample shows from the first evaluation time at or after it until the next one with a sample of its key, or until it is
    older than the limit. Of samples in one step only the last can show, so they are reduced to it
    before anything is ordered. Samples without a time are left out; null keys and values are kept as they are.
    """
    known = samples.filter(F.col(ts).isNotNull()).select(*keys, *values, tie, _micros(ts).alias("_us"))
    known = known.withColumn("_k", _step_of(F.col("_us"), step_seconds))
    newest = known.groupBy(*keys, "_k").agg(F.max_by(F.struct("_us", *values), F.struct("_us", tie)).alias("_row"))
    along = Window.partitionBy(*keys).orderBy("_k")
    stale = F.floor((F.col("_row._us") + F.lit(limit_seconds * SECOND_US)) / F.lit(step_seconds * SECOND_US)).cast("bigint")
    shown = newest.withColumn("_until", F.least(F.lead("_k").over(along) - 1, stale)).filter("_until >= _k")
    at_steps = shown.withColumn("_step", F.explode(F.sequence("_k", "_until")))
    return at_steps.select(*keys, _step_time(F.col("_step"), step_seconds).alias("evaluated_at"), *[F.col(f"_row.{v}").alias(v) for v in values])


def aligned(series: list[DataFrame], keys: list[str]) -> DataFrame:
    """Several series at the same keys and evaluation times; a time at which one of them shows nothing is left out."""
    return reduce(lambda a, b: a.join(b, [*keys, "evaluated_at"]), series)


def missing_share(part: str, whole: str) -> Column:
    """1 - sum(part) / sum(whole) as an aggregate; NULL where the whole is zero."""
    return F.lit(1.0) - safe_divide(F.sum(part).cast("double"), F.sum(whole).cast("double"))
