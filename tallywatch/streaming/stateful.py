"""Keyed state on a stream: trailing velocity per uid and the last rows per symbol.

The state of a key is bounded (two days of distinct event times, or 49 prices), lives in the RocksDB
store and is checkpointed. What one call sees of a key is bounded by the source's limit in bytes for each trigger.

Spark hands a group's rows to Python one by one, so a row with many columns is dear, and so is a group with few rows. Velocity
therefore groups uids into ``BUCKETS``: a task's rows meet their bucket as pieces, one row of a bucket with the columns
in Arrow's format, and all uids of a bucket are worked together. Each uid keeps a state of its own, read only with its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.functions.numbers import UNITS_TYPE, from_limbs, limbs, to_units
from tallywatch.operators import signals
from tallywatch.operators.velocity import COUNT_WIDTHS, SPEND_WIDTHS, finish
from tallywatch.session import ROCKSDB_PROVIDER

DAY_US = SPEND_WIDTHS["spend_24hr"]
GROUPS_PER_PARTITION = 4  # groups of rows that only pass through, for each shuffle partition
BUCKETS = 512  # of uids; fixed, because a checkpoint keeps a uid's state in its bucket
PIECE_BYTES = 16 << 20  # of a task's rows that are cut into pieces together


def use_state_store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


def _velocity_processor(spend_widths: list[int], count_widths: list[int], window_us: int, lateness_us: int, idle_ms: int | None, carry: list[str]):
    # Built inside a function so that it travels to the workers by value.
    import numpy as np
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    class VelocityProcessor(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.history = handle.getListState("history", "us long, high long, low long, n long")

        def handleInputRows(self, key, rows, timerValues):
            if not key[0].startswith("u:"):
                for part in rows:  # as they come: such a group is as large as it likes
                    yield self._output(part, [0] * (2 * len(spend_widths) + len(count_widths)), False)
                return
            parts = list(rows)
            now, tie, row_id, high_now, low_now = (
                np.concatenate([p[c].to_numpy(np.int64) for p in parts]) for c in ("event_us", "tie", "row_id", "high", "low")
            )
            sequence = np.lexsort((row_id, tie, now))
            arrived = np.empty(len(now), dtype=np.int64)
            arrived[sequence] = np.arange(len(now))
            now, high_now, low_now = now[sequence], high_now[sequence], low_now[sequence]
            held = np.array(list(self.history.get()), dtype=np.int64).reshape(-1, 4)
            high = np.concatenate([held[:, 1], high_now])
            low_part = np.concatenate([held[:, 2], low_now])
            count = np.concatenate([held[:, 3], np.ones(len(now), dtype=np.int64)])
            at = np.concatenate([held[:, 0], now])
            order = np.argsort(at, kind="stable")
            place = np.empty(len(at), dtype=np.int64)
            place[order] = np.arange(len(at))
            mine = place[len(held) :]
            sorted_at = at[order]
            totals = [np.concatenate([[0], np.cumsum(part[order])]) for part in (high, low_part, count)]
            results = []
            for widths, running in ((spend_widths, totals[0]), (spend_widths, totals[1]), (count_widths, totals[2])):
                for width in widths:
                    low = np.searchsorted(sorted_at, now - width, side="left")
                    results.append((running[mine] - running[low])[arrived])
            late = (now < held[:, 0].max() - lateness_us)[arrived] if len(held) else np.zeros(len(now), dtype=bool)
            self._remember(held, now, high_now, low_now, sorted_at[-1])
            if idle_ms is not None:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + idle_ms)
            start = 0
            for part in parts:  # the wide columns stay in the pieces they came in
                stop = start + len(part)
                yield self._output(part, [r[start:stop] for r in results], late[start:stop])
                start = stop

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            self.history.clear()
            yield from ()

        def _remember(self, held, at, high, low, newest) -> None:
            """Append the batch, one entry per event time; rewrite only once half of the entries are stale."""
            times, where = np.unique(at, return_inverse=True)
            sums = np.zeros((2, len(times)), dtype=np.int64)
            np.add.at(sums[0], where, high)
            np.add.at(sums[1], where, low)
            added = np.column_stack([times, sums[0], sums[1], np.bincount(where)])
            stale = held[:, 0] < newest - window_us - lateness_us
            if stale.sum() * 2 > len(held):
                self.history.put([tuple(map(int, r)) for r in np.vstack([held[~stale], added])])
            else:
                self.history.appendList([tuple(map(int, r)) for r in added])

        def _output(self, part, results, late):
            carried = {c: part[c].array for c in carry}
            return pd.DataFrame({**carried, **{f"v{i}": value for i, value in enumerate(results)}, "is_late": late})

        def close(self) -> None:
            pass

    return VelocityProcessor()


NARROW = ("uid", "event_us", "tie", "row_id", "high", "low")


def _to_pieces(payload: list[str], most: int):
    """Rows with a ``bucket`` to one row for each bucket: its narrow columns and its other ones, each as an Arrow stream."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def body(batch):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema) as out:
                out.write_batch(batch)
            return sink.getvalue().to_pybytes()

        def cut(waiting):
            table = pa.Table.from_batches(waiting)
            bucket = table.column("bucket").to_numpy()
            order = np.argsort(bucket, kind="stable")
            ordered = table.take(pa.array(order)).combine_chunks()
            edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
            narrow, wide = (ordered.select(names).to_batches()[0] for names in (list(NARROW), payload))
            cuts = [(lo, hi - lo) for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist())]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[order][edges[:-1]], pa.int32()),
                    pa.array([body(narrow.slice(*c)) for c in cuts], pa.binary()),
                    pa.array([body(wide.slice(*c)) for c in cuts], pa.binary()),
                ],
                names=["bucket", "narrow", "payload"],
            )

        waiting, size = [], 0
        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                size += batch.nbytes
            if size >= most:
                yield cut(waiting)
                waiting, size = [], 0
        if waiting:
            yield cut(waiting)

    return run


def _from_pieces(values: int):
    """Pieces and their results (``values`` columns of 64-bit numbers and whether a row is late) back to rows."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            tables = []
            for payload, results in zip(batch.column("payload"), batch.column("results")):
                table = pa.ipc.open_stream(payload.as_buffer()).read_all()
                numbers = np.frombuffer(results.as_buffer(), np.int64).reshape(values + 1, -1)
                for k in range(values):
                    table = table.append_column(f"v{k}", pa.array(numbers[k]))
                tables.append(table.append_column("is_late", pa.array(numbers[values] != 0)))
            yield from pa.concat_tables(tables).combine_chunks().to_batches()

    return run


def _bucket_processor(spend_widths: list[int], count_widths: list[int], window_us: int, lateness_us: int):
    # Built inside a function so that it travels to the workers by value.
    import numpy as np
    import pandas as pd
    import pyarrow as pa
    from pyspark.sql.streaming import StatefulProcessor

    class BucketProcessor(StatefulProcessor):
        def init(self, handle) -> None:
            # of each uid: (time, high, low, rows) of distinct event times, as 64-bit numbers end to end
            self.history = handle.getMapState("history", "uid string", "entries binary")

        def handleInputRows(self, key, rows, timerValues):
            parts = list(rows)  # the wide columns stay in the pieces they came in
            pieces = [pa.ipc.open_stream(body).read_all() for part in parts for body in part["narrow"]]
            edges = np.cumsum([0, *(piece.num_rows for piece in pieces)])
            out = np.zeros((2 * len(spend_widths) + len(count_widths) + 1, edges[-1]), dtype=np.int64)
            whole = pa.concat_tables(pieces)
            tracked = np.flatnonzero(whole.column("uid").is_valid().to_numpy())
            if tracked.size:
                out[:, tracked] = self._worked(whole.take(pa.array(tracked)))
            at = 0
            for part in parts:
                bodies = [out[:, edges[k] : edges[k + 1]].tobytes() for k in range(at, at + len(part))]
                at += len(part)
                yield pd.DataFrame({"payload": part["payload"].array, "results": bodies})

        def _worked(self, rows):
            """Window sums and lateness of rows that have a uid; their times join the state."""
            coded = rows.column("uid").combine_chunks().dictionary_encode()
            uids = coded.dictionary.to_pylist()
            who, now, tie, row_id, high_now, low_now = (
                a.to_numpy().astype(np.int64) for a in (coded.indices, *(rows.column(c) for c in ("event_us", "tie", "row_id", "high", "low")))
            )
            sequence = np.lexsort((row_id, tie, now))
            arrived = np.empty(len(now), dtype=np.int64)
            arrived[sequence] = np.arange(len(now))
            who, now, high_now, low_now = who[sequence], now[sequence], high_now[sequence], low_now[sequence]
            known = [self.history.getValue((uid,)) for uid in uids]
            known = [np.frombuffer(bytes(entries[0]) if entries else b"", dtype=np.int64).reshape(-1, 4) for entries in known]
            held, owner = np.concatenate(known), np.repeat(np.arange(len(uids)), [len(k) for k in known])
            all_who, at = np.concatenate([owner, who]), np.concatenate([held[:, 0], now])
            order = np.lexsort((at, all_who))  # stable: of one time, what is held comes first
            place = np.empty(len(at), dtype=np.int64)
            place[order] = np.arange(len(at))
            mine = place[len(held) :]
            times = np.unique(at)
            stride = len(times) + 1
            spot = all_who * stride + np.searchsorted(times, at)  # uid and time in one number
            sorted_spot = spot[order]
            numbers = (np.concatenate([held[:, 1], high_now]), np.concatenate([held[:, 2], low_now]), np.concatenate([held[:, 3], np.ones(len(now), dtype=np.int64)]))
            totals = [np.concatenate([[0], np.cumsum(part[order])]) for part in numbers]  # differences are exact even if a total wraps
            results = []
            for widths, running in ((spend_widths, totals[0]), (spend_widths, totals[1]), (count_widths, totals[2])):
                for width in widths:
                    low = np.searchsorted(sorted_spot, who * stride + np.searchsorted(times, now - width), side="left")
                    results.append((running[mine] - running[low])[arrived])
            newest_held = np.full(len(uids), np.iinfo(np.int64).min)
            np.maximum.at(newest_held, owner, held[:, 0])
            has = np.bincount(owner, minlength=len(uids))
            late = (has[who] > 0) & (now < np.where(has > 0, newest_held, 0)[who] - lateness_us)
            newest = newest_held.copy()
            np.maximum.at(newest, who, now)
            self._remember(uids, held, owner, has, newest, times, stride, spot[len(held) :], high_now, low_now)
            return np.vstack([*results, late[arrived]])

        def _remember(self, uids, held, owner, has, newest, times, stride, spot, high, low) -> None:
            """Add the rows, one entry per uid and event time; a uid's stale entries go once they are more than half."""
            distinct, where = np.unique(spot, return_inverse=True)
            sums = np.zeros((2, len(distinct)), dtype=np.int64)
            np.add.at(sums[0], where, high)
            np.add.at(sums[1], where, low)
            added = np.column_stack([times[distinct % stride], sums[0], sums[1], np.bincount(where)])
            stale = held[:, 0] < (newest - window_us - lateness_us)[owner]
            full = np.bincount(owner[stale], minlength=len(uids)) * 2 > has
            kept = ~(stale & full[owner])
            entries, whose = np.vstack([held[kept], added]), np.concatenate([owner[kept], distinct // stride])
            by_uid = np.argsort(whose, kind="stable")
            entries, edges = entries[by_uid], np.searchsorted(whose[by_uid], np.arange(len(uids) + 1))
            for k, uid in enumerate(uids):
                self.history.updateValue((uid,), (entries[edges[k] : edges[k + 1]].tobytes(),))

        def close(self) -> None:
            pass

    return BucketProcessor()


def pieces(df: DataFrame, tracked: Column, key: str, time_us: str, amount: str, tie: str, row_id: str) -> DataFrame:
    """``bucket, narrow, payload``: what is needed for the velocity, and all columns of ``df`` as ``c0, c1, ...``, by bucket of uids."""
    zero = F.lit(0).cast("bigint")
    high, low = limbs(F.coalesce(to_units(F.col(amount)), F.lit(0).cast(UNITS_TYPE)))
    fields = [f"c{i}" for i in range(len(df.columns))]
    rows = df.select(
        F.pmod(F.when(tracked, F.xxhash64(F.col(key))).otherwise(F.xxhash64(row_id)), F.lit(BUCKETS)).cast("int").alias("bucket"),
        F.when(tracked, F.col(key).cast("string")).alias("uid"),
        F.coalesce(F.col(time_us), zero).alias("event_us"),
        F.coalesce(F.col(tie).cast("bigint"), zero).alias("tie"),
        F.coalesce(F.col(row_id).cast("bigint"), zero).alias("row_id"),
        high.cast("bigint").alias("high"),
        low.cast("bigint").alias("low"),
        *[F.col(f"`{c}`").alias(n) for n, c in zip(fields, df.columns)],
    )
    return rows.mapInArrow(_to_pieces(fields, PIECE_BYTES), "bucket int, narrow binary, payload binary")


def velocity_on_stream(
    df: DataFrame,
    key: str = "uid",
    time_us: str = "event_us",
    amount: str = "TransactionAmt",
    tie: str = "TransactionID",
    row_id: str = "offset",
    rejected: str | None = None,
    lateness_us: int = DAY_US,
    idle_ms: int | None = None,
) -> DataFrame:
    """The velocity columns on a stream, plus ``is_late`` for events too far behind their key's newest.

    Rows without a key, and rows with a reason in ``rejected``, pass through, spread over the buckets. All columns keep
    their types. With ``idle_ms`` the state of a key is dropped after that long without events; timers belong to a group, so
    there each uid is a group of its own. They need a query that keeps running, not one that drains what is available.
    """
    use_state_store(df.sparkSession)
    tracked = F.col(key).isNotNull()
    if rejected is not None:
        tracked = tracked & F.col(rejected).isNull()
    if idle_ms is not None:
        return _velocity_with_timers(df, tracked, key, time_us, amount, tie, row_id, lateness_us, idle_ms)
    names = [*[f"{n}_high" for n in SPEND_WIDTHS], *[f"{n}_low" for n in SPEND_WIDTHS], *COUNT_WIDTHS]
    worked = pieces(df, tracked, key, time_us, amount, tie, row_id).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=_bucket_processor(list(SPEND_WIDTHS.values()), list(COUNT_WIDTHS.values()), DAY_US, lateness_us),
        outputStructType="payload binary, results binary",
        outputMode="Append",
        timeMode="None",
    )
    payload = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(df.schema.fields)]
    values = [T.StructField(f"v{i}", T.LongType()) for i in range(len(names))]
    rows = worked.mapInArrow(_from_pieces(len(names)), T.StructType([*payload, *values, T.StructField("is_late", T.BooleanType())]))
    return _finished(rows, [F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns)], names, tracked)


def _finished(rows: DataFrame, back: list[Column], names: list[str], tracked: Column) -> DataFrame:
    value = {n: F.col(f"v{i}") for i, n in enumerate(names)}
    whole = [from_limbs(value[f"{n}_high"], value[f"{n}_low"]).alias(f"_{n}") for n in SPEND_WIDTHS]
    return finish(rows.select(*back, *whole, *[value[n].alias(f"_{n}") for n in COUNT_WIDTHS], "is_late"), tracked)


def _velocity_with_timers(df: DataFrame, tracked: Column, key: str, time_us: str, amount: str, tie: str, row_id: str, lateness_us: int, idle_ms: int) -> DataFrame:
    """A group for each uid. Whole numbers of 64 bits travel as text, because pandas would turn them to doubles where some are NULL."""
    spark = df.sparkSession
    groups = GROUPS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bystander = F.concat(F.lit("n:"), F.pmod(F.xxhash64(row_id), F.lit(groups)))
    zero = F.lit(0).cast("bigint")
    units = F.coalesce(to_units(F.col(amount)), F.lit(0).cast(UNITS_TYPE))
    high, low = limbs(units)
    fields = {f"c{i}": f for i, f in enumerate(df.schema.fields)}
    as_text = [n for n, f in fields.items() if f.dataType == T.LongType()]
    carried = [(F.col(f"`{f.name}`").cast("string") if n in as_text else F.col(f"`{f.name}`")).alias(n) for n, f in fields.items()]
    packed = df.select(
        F.when(tracked, F.concat(F.lit("u:"), F.col(key))).otherwise(bystander).alias("state_key"),
        *carried,
        F.coalesce(F.col(time_us), zero).alias("event_us"),
        F.coalesce(F.col(tie).cast("bigint"), zero).alias("tie"),
        F.coalesce(F.col(row_id).cast("bigint"), zero).alias("row_id"),
        high.alias("high"),
        low.alias("low"),
    )
    names = [*[f"{n}_high" for n in SPEND_WIDTHS], *[f"{n}_low" for n in SPEND_WIDTHS], *COUNT_WIDTHS]
    payload = [T.StructField(n, T.StringType() if n in as_text else f.dataType) for n, f in fields.items()]
    values = [T.StructField(f"v{i}", T.LongType()) for i in range(len(names))]
    output = T.StructType([*payload, *values, T.StructField("is_late", T.BooleanType())])
    processor = _velocity_processor(list(SPEND_WIDTHS.values()), list(COUNT_WIDTHS.values()), DAY_US, lateness_us, idle_ms, list(fields))
    summed = packed.groupBy("state_key").transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=output,
        outputMode="Append",
        timeMode="ProcessingTime",
    )
    return _finished(summed, [F.col(n).cast(f.dataType).alias(f.name) for n, f in fields.items()], names, tracked)


def _last_rows_processor(window_rows: int):
    import numpy as np
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    from tallywatch.functions.moving import moving_statistics

    class LastRowsProcessor(StatefulProcessor):
        def init(self, handle) -> None:
            self.recent = handle.getListState("recent", "price double")

        def handleInputRows(self, key, rows, timerValues):
            batch = pd.concat(list(rows), ignore_index=True).sort_values("seq", kind="stable", ignore_index=True)
            held = np.array([row[0] for row in self.recent.get()], dtype=np.float64)
            price = batch["price"].to_numpy(np.float64)
            count, ma, deviation, volatility = moving_statistics(price, held, window_rows)
            self.recent.put([(float(p),) for p in np.concatenate([held, price])[-(window_rows - 1) :]])
            yield pd.DataFrame(
                {
                    "symbol": key[0],
                    "price": price,
                    "ingested_at": batch["ingested_at"],
                    "seq": batch["seq"],
                    "rows": count,
                    "ma": ma,
                    "deviation_pct": deviation,
                    "volatility": volatility,
                }
            )

        def close(self) -> None:
            pass

    return LastRowsProcessor()


def price_signals_on_stream(ticks: DataFrame) -> DataFrame:
    """The moving-window signals on a stream of (symbol, price, ingested_at, seq)."""
    use_state_store(ticks.sparkSession)
    schema = "symbol string, price double, ingested_at timestamp_ntz, seq long, rows long, ma double, deviation_pct double, volatility double"
    windows = (
        signals.usable(ticks)
        .groupBy("symbol")
        .transformWithStateInPandas(
            statefulProcessor=_last_rows_processor(signals.WINDOW_ROWS),
            outputStructType=schema,
            outputMode="Append",
            timeMode="None",
        )
    )
    return signals.with_statistics(windows.filter(F.col("rows") >= signals.MINIMUM_ROWS).drop("rows"))
