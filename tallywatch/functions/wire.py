"""Framed messages: one zero byte, a big-endian four-byte schema id, then the body."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the frame format.
HEADER_BYTES = 5
MAGIC_HEX = "00"

_CORRUPT = "_unreadable"


def frame(body: Column, schema_id: int) -> Column:
    header = F.unhex(F.lit(MAGIC_HEX + format(schema_id, "08x")))
    return F.concat(header, body.cast("binary"))


def is_framed(value: Column) -> Column:
    """False for NULL, for values shorter than a header, and for a wrong first byte."""
    magic = F.hex(F.substring(value, 1, 1)) == F.lit(MAGIC_HEX)
    return F.coalesce((F.length(value) >= HEADER_BYTES) & magic, F.lit(False))


def schema_id(value: Column) -> Column:
    return F.when(is_framed(value), F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("bigint"))


def body(value: Column) -> Column:
    return F.when(is_framed(value), F.substring(value, F.lit(HEADER_BYTES + 1), F.length(value) - F.lit(HEADER_BYTES)))


# Micro-second times survive the round trip.
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def encode_body(record: Column) -> Column:
    return F.encode(F.to_json(record, JSON_OPTIONS), "UTF-8")


def readable_bodies(payload: Column, schema: T.StructType) -> Column:
    """Body to an array with its record, or an empty one where the body cannot be read.

    Meant for ``posexplode_outer``: the generator parses every body once, and no later filter on a
    field is pushed below it, which would parse the body again for each field it tests.
    """
    probe = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {**JSON_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = F.from_json(payload.cast("string"), probe, options)
    return F.filter(F.array(parsed), lambda r: r.isNotNull() & r[_CORRUPT].isNull())


def decode_records(df: DataFrame, payload: Column, schema: T.StructType, keep: tuple[str, ...]) -> DataFrame:
    """The ``keep`` columns, ``decoded``, and the fields of the body (all NULL where it is unreadable)."""
    opened = df.select(*keep, F.posexplode_outer(readable_bodies(payload, schema)).alias("_found", "_record"))
    return opened.select(
        *keep, F.col("_found").isNotNull().alias("decoded"), *[F.col(f"_record.{n}").alias(n) for n in schema.names]
    )


def decode_map(payload: Column) -> Column:
    """Body to ``map<string,string>``: scalars and lists as text, NULL where it cannot be read.

    A value that is an object, as a tagged union is encoded, counts as its ``value`` or else as its first member.
    """
    whole = F.from_json(payload.cast("string"), "map<string,string>")

    def member(text: Column) -> Column:
        first = F.get(F.map_values(F.from_json(text, "map<string,string>")), F.lit(0))
        return F.when(text.startswith("{"), F.coalesce(F.get_json_object(text, "$.value"), first)).otherwise(text)

    return F.transform_values(whole, lambda _, text: member(text))


def avro_available(spark: SparkSession) -> bool:
    """Whether the optional Avro package is on the classpath; it only adds a second body encoding."""
    try:
        spark.sparkContext._jvm.java.lang.Class.forName("org.apache.spark.sql.avro.AvroDataToCatalyst")
    except Exception:
        return False
    return True


def decode_avro_body(payload: Column, avro_schema: dict) -> Column:
    from pyspark.sql.avro.functions import from_avro

    return from_avro(payload, json.dumps(avro_schema), {"mode": "PERMISSIVE"})


def encode_avro_body(record: Column, avro_schema: dict) -> Column:
    from pyspark.sql.avro.functions import to_avro

    return to_avro(record, json.dumps(avro_schema))
