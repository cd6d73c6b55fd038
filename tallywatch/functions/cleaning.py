"""Null normalisation, contract casts and default filling for dirty text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that mean "missing", and texts that mean "true".
MISSING_TEXTS = ("", "null", "none", "nan")
TRUE_TEXTS = ("true", "1", "yes", "y")

SPARK_TYPES = {"string": "string", "int": "int", "long": "bigint", "double": "double", "boolean": "boolean"}
NUMBER = r"^(?i)[+-]?(([0-9]+(\.[0-9]*)?|\.[0-9]+)(e[+-]?[0-9]+)?|inf(inity)?)$"
ZERO_VALUES = {"string": "", "int": 0, "long": 0, "double": 0.0, "boolean": False}


def strip_text(text: Column) -> Column:
    """Remove leading and trailing white space of every kind, not just blanks."""
    return F.btrim(text, F.lit(" \t\n\x0b\f\r"))


def normalize_null(text: Column) -> Column:
    cleaned = strip_text(text)
    return F.when(F.lower(cleaned).isin(*MISSING_TEXTS), None).otherwise(cleaned)


def number_of(text: Column) -> Column:
    """A double from plain or scientific digits or a word for infinity; suffixes and hexadecimal digits give NULL."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def cast_text(text: Column, kind: str) -> Column:
    """Text to a contract type; whole numbers truncate through double; failure gives NULL."""
    value = normalize_null(text)
    if kind == "string":
        return value
    if kind in ("int", "long"):
        return number_of(value).try_cast(SPARK_TYPES[kind])
    if kind == "double":
        return number_of(value)
    if kind == "boolean":
        return F.when(value.isNotNull(), F.lower(value).isin(*TRUE_TEXTS))
    return value


def cast_typed(value: Column, source: str, kind: str) -> Column:
    """Cast a column of Spark type ``source`` to a contract type; failure gives NULL."""
    if kind.startswith("array") or SPARK_TYPES[kind] == source:
        return value
    if source == "string" and kind != "string":
        return cast_text(value, kind)
    return value.try_cast(SPARK_TYPES[kind])


def default_literal(kind: str, nullable: bool, default: object) -> Column:
    """What fills a missing field: NULL if allowed, else the declared default, else the zero value."""
    if kind.startswith("array"):
        return F.expr("CAST(array() AS array<string>)")
    if nullable:
        return F.expr(f"CAST(NULL AS {SPARK_TYPES[kind]})")
    fill = ZERO_VALUES[kind] if default is None else default
    return F.lit(fill).cast(SPARK_TYPES[kind])


def fill_default(value: Column, kind: str, nullable: bool, default: object = None) -> Column:
    return value if nullable else F.coalesce(value, default_literal(kind, nullable, default))
