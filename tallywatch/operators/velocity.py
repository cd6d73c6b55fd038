"""Trailing spend and count per key over 1 minute, 5 minutes, 1 hour and 24 hours.

The event itself is excluded, the lower bound is inclusive, and events at the same time count as
earlier if their id sorts first. Non-finite amounts add nothing to a spend.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.numbers import LIMB, UNITS_TYPE, cents_from_units, limbs, to_units

SECOND_US = 1_000_000
# Window names and widths.
SPEND_WIDTHS = {
    "spend_1min": 60 * SECOND_US,
    "spend_5min": 300 * SECOND_US,
    "spend_1hr": 3_600 * SECOND_US,
    "spend_24hr": 86_400 * SECOND_US,
}
COUNT_WIDTHS = {"txn_count_1hr": SPEND_WIDTHS["spend_1hr"], "txn_count_24hr": SPEND_WIDTHS["spend_24hr"]}

DAY_US = SPEND_WIDTHS["spend_24hr"]
SLICE_US = 60 * SECOND_US  # every width is a whole number of slices


def velocity_flag() -> Column:
    """Spend in the last hour above three times the hourly average of the last day."""
    day = F.coalesce(F.col("spend_24hr"), F.lit(0.0))
    hour = F.coalesce(F.col("spend_1hr"), F.lit(0.0))
    return (day > 0) & (hour > F.lit(3.0) * (day / F.lit(24.0)))


def add_velocity(
    df: DataFrame,
    key: str = "uid",
    time_us: str = "event_us",
    amount: str = "TransactionAmt",
    tie: str = "TransactionID",
    row_id: str = "offset",
) -> DataFrame:
    """Append the velocity columns; ``row_id`` is unique per row (the log offset).

    Two levels of prefix sums. Amounts are first summed per key and minute; running totals over a key's minutes give
    what each window holds as a minute opens. Rows are then worked minute by minute: every row is an
    arrival, and an expiry in the minute when it leaves each window. Every width is a whole number of minutes, so a
    minute needs only its own arrivals and the expiries that fall into it: no task holds more than one minute of a
    key, and expiries into minutes without arrivals fall out in the join. Rows without a key or a time have no
    windows and are scattered.
    """
    high, low = limbs(F.coalesce(to_units(F.col(amount)), F.lit(0).cast(UNITS_TYPE)))
    prepared = df.withColumns({"_high": high, "_low": low})
    names = {"key": f"`{key}`", "at": f"`{time_us}`", "tie": f"`{tie}`", "row_id": f"`{row_id}`"}
    return finish(_by_minutes(prepared, _opening_totals(prepared, names), names), F.col(key).isNotNull())


# Plans of these two are written as SQL text: some fifty expressions, each one call to the JVM instead of a dozen.


def _minute(at: str) -> str:
    """Whole slices since the epoch; ``div`` cuts towards zero, so the rest is taken off first."""
    return f"try_subtract({at}, pmod({at}, {SLICE_US}L)) div {SLICE_US}L"


def _opening_totals(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """What each window holds as a minute of a key opens: one row for each minute with arrivals.

    The totals combine before their shuffle, and the frames only grow, so a key with many rows costs its minutes. A
    minute's total is brought back to a low part below ``LIMB``, so running totals over minutes fit 64 bits as well.
    """
    known = df.where("{key} IS NOT NULL AND {at} IS NOT NULL".format(**names)).selectExpr("{key} AS _key".format(**names), f"{_minute(names['at'])} AS _slice", "_high", "_low")
    totals = known.groupBy("_key", "_slice").agg(F.expr("sum(_high) AS _h"), F.expr("sum(_low) AS _l"), F.expr("count(1) AS _rows"))
    totals = totals.selectExpr("_key", "_slice", f"_h + _l div {LIMB}L AS _high", f"_l % {LIMB}L AS _low", "_rows")

    def held(total: str, width: int) -> str:
        def before(minutes: int) -> str:
            return f"coalesce(sum({total}) OVER (PARTITION BY _key ORDER BY _slice RANGE BETWEEN UNBOUNDED PRECEDING AND {1 + minutes} PRECEDING), 0L)"

        return f"{before(0)} - {before(width // SLICE_US)}"

    return totals.selectExpr("_key", "_slice", *[f"{held(f'_{part}', w)} AS _open_{part}_{n}" for part, n, w in _sums()])


def _sums() -> list[tuple[str, str, int]]:
    """What is summed for the windows: part, window, width."""
    return [(part, n, w) for part in ("high", "low") for n, w in SPEND_WIDTHS.items()] + [("rows", n, w) for n, w in COUNT_WIDTHS.items()]


def _by_minutes(df: DataFrame, opening: DataFrame, names: dict[str, str]) -> DataFrame:
    """Window sums as the totals at the minute's opening, plus the arrivals before the row, minus the expiries before it.

    Inside a minute the sums are pairs of 64-bit numbers; only the result is wide.
    """
    key, at, tie, row_id = names.values()
    columns = [f"`{c}`" for c in df.columns if c not in ("_high", "_low")]
    payload = [c for c in columns if c not in names.values()]
    widths = sorted({*SPEND_WIDTHS.values(), *COUNT_WIDTHS.values()})
    arrival = f"struct({at} AS at, 0L AS width)"
    moments = ", ".join([arrival, *[f"struct(try_add({at}, {w}L) AS at, {w}L AS width)" for w in widths]])
    known = f"{key} IS NOT NULL AND {at} IS NOT NULL"
    # the other columns go with the arrival only, each for itself, so that unused ones are never carried
    events = df.selectExpr("*", f"explode(IF({known}, array({moments}), array({arrival}))) AS _m").selectExpr(
        *names.values(),
        f"IF({known}, {_minute('_m.at')}, xxhash64({row_id})) AS _slice",
        "_m.at AS _at",
        "_m.width AS _width",
        "_high",
        "_low",
        "1L AS _rows",
        *[f"IF(_m.width = 0, {c}, NULL) AS {c}" for c in payload],
    )
    left, right = events.alias("e"), opening.alias("o")
    met = left.join(right, F.expr(f"e.{key} = o._key AND e._slice = o._slice"), "left")
    met = met.where("e._width = 0 OR o._key IS NOT NULL")
    order = f"PARTITION BY e.{key}, e._slice ORDER BY e._at, e._width, e.{tie}, e.{row_id} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"

    def so_far(part: str, width: int) -> str:
        return f"coalesce(sum(CASE e._width WHEN 0 THEN e._{part} WHEN {width} THEN -e._{part} END) OVER ({order}), 0L)"

    totals = [f"coalesce(o._open_{part}_{n} + {so_far(part, w)}, 0L) AS _{part}_{n}" for part, n, w in _sums()]
    own = met.selectExpr(*[f"e.{c}" for c in columns], "e._width", *totals).where("_width = 0")
    spends = [f"CAST(CAST(_high_{n} AS {UNITS_TYPE}) * {LIMB}L + _low_{n} AS {UNITS_TYPE}) AS _{n}" for n in SPEND_WIDTHS]
    return own.selectExpr(*columns, *spends, *[f"_rows_{n} AS _{n}" for n in COUNT_WIDTHS])


def finish(df: DataFrame, known: Column) -> DataFrame:
    """Window sums in ``_name`` columns to the published ones, NULL where the key is not ``known``."""
    spends = {name: F.when(known, cents_from_units(F.col(f"_{name}"))) for name in SPEND_WIDTHS}
    counts = {name: F.when(known, F.col(f"_{name}").cast("int")) for name in COUNT_WIDTHS}
    named = df.withColumns({**spends, **counts})
    helpers = [f"_{n}" for n in (*SPEND_WIDTHS, *COUNT_WIDTHS)]
    return named.withColumn("velocity_flag", velocity_flag()).drop(*helpers)
