"""Reject reasons, frames, casts and contract projections."""

from __future__ import annotations

import json
import struct

import pytest
from pyspark.sql import functions as F

from tallywatch.functions import cleaning, features, wire
from tallywatch.functions.numbers import cents_from_units, half_up, plain_float_text, to_units
from tallywatch.operators import contracts, validation

RAW = "offset long, TransactionID long, TransactionAmt double, ProductCD string, card1 double, addr1 double, TransactionDT long"
INF, NAN = float("inf"), float("nan")


def test_first_failing_reason_wins(spark):
    cases = [
        ((1, 10.0, "W", 1.0, 2.0, 5), None),
        ((None, -1.0, "X", 1.0, 2.0, 5), "null_transaction_id"),
        ((1, None, "X", 1.0, 2.0, 5), "invalid_amount:None"),
        ((1, 0.0, "W", 1.0, 2.0, 5), "invalid_amount:0.0"),
        ((1, -12345678.5, "W", 1.0, 2.0, 5), "invalid_amount:-12345678.5"),
        ((1, NAN, "W", 1.0, 2.0, 5), None),
        ((1, INF, "W", 1.0, 2.0, 5), None),
        ((1, 1.0, None, 1.0, 2.0, 5), "invalid_product:None"),
        ((1, 1.0, "w", 1.0, 2.0, 5), "invalid_product:w"),
        ((1, 1.0, "W", INF, 2.0, 5), validation.INFINITE_UID),
        ((1, 1.0, "W", NAN, INF, 5), None),
        ((1, 1.0, "W", None, INF, 5), None),
        ((1, 1.0, "W", 1.0, 2.0, 10**15), validation.DATE_RANGE),
        ((1, 1.0, "W", 1.0, 2.0, None), None),
    ]
    df = spark.createDataFrame([(i, *row) for i, (row, _) in enumerate(cases)], RAW)
    got = {r.offset: r.reject_reason for r in validation.with_reject_reason(df).collect()}
    assert [got[i] for i in range(len(cases))] == [why for _, why in cases]
    good = {r.offset for r in validation.good_records(df).collect()}
    bad = {r.offset for r in validation.bad_records(df).collect()}
    assert good == {i for i, (_, why) in enumerate(cases) if why is None}
    assert bad == set(range(len(cases))) - good
    letters = {r.offset: (bytes(r.key), json.loads(bytes(r.value))) for r in validation.dead_letters(validation.bad_records(df), "v").collect()}
    assert letters[9] == (b"build_error", {"reason": validation.INFINITE_UID, "offset": 9})
    assert letters[3] == (b"invalid_amount:0.0", {"reason": "invalid_amount:0.0", "offset": 3})


def test_broken_frames_have_no_record(spark):
    good = b"\x00" + struct.pack(">I", 1) + b'{"TransactionID": 7, "ProductCD": "W"}'
    cases = [
        (good, True),
        (None, False),
        (b"", False),
        (good[:4], False),
        (good[:5], False),
        (b"\x01" + good[1:], False),
        (good[:-1], False),
        (good[:5] + b"[1]", False),
        (good[:5] + b"null", False),
        (good[:5] + b'{"TransactionID": "seven"}', False),
        (good[:5] + b"\xff\xfe", False),
    ]
    df = spark.createDataFrame([(i, bytearray(v) if v is not None else None) for i, (v, _) in enumerate(cases)], "offset long, value binary")
    rows = {r.offset: r for r in validation.decode_log(df, contracts.RAW.only(["TransactionID", "ProductCD"])).collect()}
    assert len(rows) == len(cases)
    assert [rows[i].decoded for i in range(len(cases))] == [ok for _, ok in cases]
    assert rows[0].TransactionID == 7 and all(rows[i].TransactionID is None for i in range(1, len(cases)))
    ids = {r.offset: r.id for r in df.select("offset", wire.schema_id(F.col("value")).alias("id")).collect()}
    assert ids[0] == 1 and ids[1] is None and ids[3] is None and ids[5] is None


def test_frame_bytes(spark):
    value = spark.range(1).select(wire.frame(F.encode(F.lit("body"), "UTF-8"), 70_000).alias("v")).collect()[0].v
    assert bytes(value) == b"\x00" + struct.pack(">I", 70_000) + b"body"


def test_text_map_decoding(spark):
    text = '{"a": 1.5, "b": null, "c": ["x", "y"], "d": "s"}'
    row = spark.range(1).select(wire.decode_map(F.encode(F.lit(text), "UTF-8")).alias("m")).collect()[0].m
    assert row["a"] == "1.5" and row["b"] is None and json.loads(row["c"]) == ["x", "y"] and row["d"] == "s"
    assert spark.range(1).select(wire.decode_map(F.lit(None).cast("binary")).alias("m")).collect()[0].m is None


@pytest.mark.parametrize(
    "text, kind, want",
    [
        (" 3.7 ", "int", 3),
        ("-3.7", "long", -3),
        ("abc", "int", None),
        ("9e30", "int", None),
        ("\t NONE\n", "string", None),
        (" x ", "string", "x"),
        ("Yes", "boolean", True),
        ("T", "boolean", False),
        ("nan", "double", None),
        ("1e3", "double", 1000.0),
    ],
)
def test_cast_text(spark, text, kind, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(cleaning.cast_text(F.col("t"), kind).alias("v")).collect()[0].v == want


def test_contract_sizes_and_types():
    assert [len(c.fields) for c in contracts.CONTRACTS] == [439, 101, 49, 28, 26, 15]
    assert contracts.by_subject("fraud-scores") is contracts.by_id(4)
    avro = contracts.AUDIT.avro_schema()
    assert {"name": "uid", "type": ["null", "string"], "default": None} in avro["fields"]
    assert next(f for f in avro["fields"] if f["name"] == "rules_triggered")["default"] == []


def test_conform_fills_required_and_keeps_order(spark):
    df = spark.createDataFrame([("7", " gmail.com ")], "transactionid string, P_emaildomain string")
    out = contracts.RAW.conform(df, clean=True)
    assert out.columns == contracts.RAW.names and out.schema.simpleString() == contracts.RAW.struct_type().simpleString()
    row = out.collect()[0]
    assert (row.TransactionID, row.ProductCD, row.TransactionAmt, row.isFraud, row.P_emaildomain) == (7, "", 0.0, None, "gmail.com")


def test_typed_text_is_left_alone(spark):
    df = spark.createDataFrame([(" Outlook.COM ",)], "P_emaildomain string")
    assert contracts.VALIDATED.only(["P_emaildomain"]).conform(df).collect()[0][0] == " Outlook.COM "


def test_scalar_features(spark):
    df = spark.createDataFrame([(0, 13926.0, 315.0), (86_400, NAN, 1.0), (None, None, 1.0)], "dt long, c double, a double")
    ts = features.event_time(F.col("dt"))
    got = df.select(
        F.date_format(ts, "yyyy-MM-dd HH:mm").alias("t"), features.transaction_dow(ts).alias("dow"), features.uid(F.col("c"), F.col("a")).alias("u")
    ).collect()
    assert [tuple(r) for r in got] == [("2017-11-30 00:00", 3, "13926_315"), ("2017-12-01 00:00", 4, None), ("2017-11-30 00:00", 3, None)]


def test_numbers(spark):
    df = spark.createDataFrame([(35.166,), (-1234567890.5,), (0.00025,), (NAN,)], "x double")
    rows = df.select(to_units(F.col("x")).alias("u"), plain_float_text(F.col("x")).alias("t")).collect()
    assert [r.u for r in rows] == [351660, -12345678905000, 3, None]
    assert [r.t for r in rows][:3] == ["35.166", "-1234567890.5", "0.00025"]
    spend = spark.range(1).select(cents_from_units(F.lit(703_320)).alias("c"), half_up(F.lit(2.345), 2).alias("h")).collect()[0]
    assert spend.c == 70.33 and spend.h == 2.35


def test_later_stages_reject_missing_fields(spark):
    body = json.dumps({"TransactionID": 5}).encode()
    df = spark.createDataFrame([(1, bytearray(b"\x00\x00\x00\x00\x04" + body)), (2, None)], "offset long, value binary")
    from tallywatch.streaming.stages import checked

    got = {r.offset: r.reject_reason for r in checked(df, contracts.SCORES, "decision_error").collect()}
    assert got == {1: "decision_error:ingestion_id", 2: "decode_failed"}
    letters = validation.dead_letters(checked(df, contracts.SCORES, "decision_error"), "decision", key="decision_error")
    assert {r.offset: bytes(r.key) for r in letters.collect()} == {1: b"decision_error", 2: b"decode_error"}


def test_text_map_opens_unions(spark):
    body = '{"a": {"string": "x"}, "b": {"tag": 1, "value": 2.5}, "c": "plain", "d": [1, 2], "e": null, "f": {}, "g": 7}'
    got = spark.range(1).select(wire.decode_map(F.lit(body)).alias("m")).first()["m"]
    assert got == {"a": "x", "b": "2.5", "c": "plain", "d": "[1,2]", "e": None, "f": None, "g": "7"}


def test_only_plain_numbers_are_cast(spark):
    texts = ["3.7", "3.7d", "2f", "0x1p3", "1e3", " -12 ", "+.5", "5.", "inf", "-Infinity", "1_0", "", "abc", "12L"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [(r.d, r.i) for r in df.select(cleaning.cast_text(F.col("t"), "double").alias("d"), cleaning.cast_text(F.col("t"), "int").alias("i")).collect()]
    inf = float("inf")
    want = [3.7, None, None, None, 1000.0, -12.0, 0.5, 5.0, inf, -inf, None, None, None, None]
    assert [d for d, _ in got] == want
    assert [i for _, i in got][:8] == [3, None, None, None, 1000, -12, 0, 5]


def test_amounts_beyond_exact_sums_are_rejected(spark):
    schema = "TransactionID long, TransactionAmt double, ProductCD string, card1 double, addr1 double, TransactionDT long"
    rows = [(1, 1e15, "W", 1.0, 1.0, 1), (2, 1e18, "W", 1.0, 1.0, 1), (3, float("inf"), "W", 1.0, 1.0, 1)]
    got = [r[0] for r in spark.createDataFrame(rows, schema).select(validation.reject_reason()).collect()]
    assert got == [None, "amount_out_of_range", None]
    parts = spark.createDataFrame([(1e15 + 0.25,), (1e300,), (float("inf"),), (-3.75,)], "x double")
    assert [r[0] for r in parts.select(features.fractional_amount(F.col("x"))).collect()] == [0.25, 0.0, None, 0.25]
