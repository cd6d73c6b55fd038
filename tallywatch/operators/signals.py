"""Moving-window price signals per symbol, with severity bands and an alert side output."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.functions.moving import moving_statistics
from tallywatch.operators.numbering import SLICE_ROWS, number_rows
from tallywatch.session import travels_by_value

travels_by_value(__name__)

# Window length, rows before the first signal, severity bands in percent.
WINDOW_ROWS = 50
MINIMUM_ROWS = 10
SEVERITY_BANDS = ((0.5, "CRITICAL"), (0.3, "ALERT"), (0.1, "WATCH"))
ALERT_LEVELS = ("ALERT", "CRITICAL")

CHUNK_ROWS = 50_000


def severity(deviation: Column) -> Column:
    size = F.abs(deviation)
    expr = F.when(size > F.lit(SEVERITY_BANDS[0][0]), SEVERITY_BANDS[0][1])
    for threshold, level in SEVERITY_BANDS[1:]:
        expr = expr.when(size > F.lit(threshold), level)
    return expr.otherwise("NORMAL")


def reject_reason(symbol: Column, price: Column) -> Column:
    """Why a tick cannot enter a window; NULL for a good one."""
    return (
        F.when(symbol.isNull(), "null_symbol")
        .when(price.isNull(), "null_price")
        .when(F.isnan(price), "nan_price")
        .when(F.abs(price) == float("inf"), "infinite_price")
    )


def price_rejects(ticks: DataFrame) -> DataFrame:
    """The ticks that ``price_signals`` leaves out, with the reason."""
    return ticks.withColumn("reason", reject_reason(F.col("symbol"), F.col("price"))).filter(F.col("reason").isNotNull())


def usable(ticks: DataFrame) -> DataFrame:
    return ticks.filter(reject_reason(F.col("symbol"), F.col("price")).isNull())


def with_statistics(df: DataFrame) -> DataFrame:
    """A NaN deviation (from a mean of zero) to NULL, and the severity."""
    deviation = F.when(~F.isnan("deviation_pct"), F.col("deviation_pct"))
    return df.withColumn("deviation_pct", deviation).withColumn("severity", severity(F.col("deviation_pct")))


def _same_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one (symbol, chunk) after the other; they arrive sorted, a chunk possibly over several batches."""
    held, parts = None, []
    for batch in batches:
        symbols, chunks = batch.column("symbol").dictionary_encode(), batch.column("_chunk").to_numpy()
        codes = symbols.indices.to_numpy()
        cuts = [0, *(np.flatnonzero((codes[1:] != codes[:-1]) | (chunks[1:] != chunks[:-1])) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            key = (batch.column("symbol")[a].as_py(), chunks[a])
            if parts and key != held:
                yield pa.Table.from_batches(parts)
                parts = []
            held = key
            parts.append(batch.slice(a, b - a))
    if parts:
        yield pa.Table.from_batches(parts)


def _chunk_signals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _same_chunk(batches):
        own = table.column("_own").to_numpy()
        first = int(own.argmax())  # the copied rows before the chunk sort first
        price = table.column("price").to_numpy()
        rows, *figures = moving_statistics(price[first:], price[:first], WINDOW_ROWS)
        ready = np.flatnonzero(rows >= MINIMUM_ROWS)
        out = table.slice(first).drop_columns(["_chunk", "_own", "row_no"]).take(pa.array(ready)).combine_chunks()
        for name, values in zip(("ma", "deviation_pct", "volatility"), figures):
            out = out.append_column(name, pa.array(values[ready]))
        yield from out.to_batches()


def price_signals(ticks: DataFrame, chunk_rows: int = CHUNK_ROWS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Signals of (symbol, price, ingested_at, seq) ticks, each over the last 50 rows of its symbol.

    A symbol is cut into chunks of ``chunk_rows`` rows; each chunk gets a copy of the 49 rows before it, so a hot symbol
    spreads over tasks. Each window is summed anew in two-part floats, so prices of any finite size are taken as they are.
    """
    numbered = number_rows(usable(ticks).select("symbol", F.col("price").cast("double").alias("price"), "ingested_at", "seq"), "symbol", "seq", slice_rows)
    place = F.col("row_no") - 1
    chunk = F.floor(place / F.lit(chunk_rows)).cast("bigint")
    last_rows = place % chunk_rows >= chunk_rows - (WINDOW_ROWS - 1)
    homes = F.when(last_rows, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    spread = numbered.withColumn("_chunk", F.explode(homes)).withColumn("_own", F.col("_chunk") == chunk)
    ordered = spread.repartition("symbol", "_chunk").sortWithinPartitions("symbol", "_chunk", "row_no")
    kept = [f for f in ordered.schema.fields if f.name in ("symbol", "price", "ingested_at", "seq")]
    figures = [T.StructField(n, T.DoubleType()) for n in ("ma", "deviation_pct", "volatility")]
    order = [f.name for f in kept]
    found = ordered.select(*order, "_chunk", "_own", "row_no").mapInArrow(_chunk_signals, T.StructType([*kept, *figures]))
    return with_statistics(found)


def price_alerts(signals: DataFrame) -> DataFrame:
    return signals.filter(F.col("severity").isin(*ALERT_LEVELS)).select(
        "symbol", "severity", "deviation_pct", "price", "ingested_at"
    )
