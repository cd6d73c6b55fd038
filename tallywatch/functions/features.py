"""Scalar features of a raw transaction record."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywatch.functions.cleaning import strip_text

# Fixed values of the record format.
EPOCH_OF_OFFSETS = "2017-11-30 00:00:00"
IDENTITY_FIELDS = ("id_01", "id_02", "id_03", "id_04", "id_05", "id_06")


# Offsets that lead outside the years 1 to 9999.
FIRST_OFFSET = int((datetime(1, 1, 1) - datetime.fromisoformat(EPOCH_OF_OFFSETS)).total_seconds())
LAST_OFFSET = int((datetime(9999, 12, 31, 23, 59, 59) - datetime.fromisoformat(EPOCH_OF_OFFSETS)).total_seconds())


def event_time(offset_seconds: Column) -> Column:
    """Base date plus offset; a missing offset counts as 0, one out of range gives NULL."""
    base = F.to_timestamp_ntz(F.lit(EPOCH_OF_OFFSETS))
    seconds = F.coalesce(offset_seconds, F.lit(0)).cast("bigint")
    return F.timestamp_add("SECOND", F.when(~offset_out_of_range(offset_seconds), seconds), base)


def offset_out_of_range(offset_seconds: Column) -> Column:
    return F.coalesce(~offset_seconds.between(FIRST_OFFSET, LAST_OFFSET), F.lit(False))


def transaction_date(ts: Column) -> Column:
    return F.to_date(ts)


def transaction_hour(ts: Column) -> Column:
    return F.hour(ts)


def transaction_dow(ts: Column) -> Column:
    """0 is Monday, 6 is Sunday."""
    return F.weekday(ts)


def fractional_amount(amount: Column) -> Column:
    """The part behind the decimal point, to four places; NULL only for NULL, NaN and infinity."""
    short = F.pmod(amount.try_cast("decimal(18,4)"), F.lit(1)).cast("double")
    # a larger double has few binary places, and its remainder is exact
    long = F.pmod(amount, F.lit(1.0))
    return F.when(F.abs(amount) < F.lit(1e13), short).when(F.abs(amount) < F.lit(float("inf")), long)


def replay_key(card: Column, address: Column) -> Column:
    unknown = F.lit("unknown")
    return F.concat(F.coalesce(card.cast("string"), unknown), F.lit("_"), F.coalesce(address.cast("string"), unknown))


def uid(card: Column, address: Column) -> Column:
    """``card_address`` as whole numbers; NULL if a part is missing or not a number."""
    parts = [part.cast("double").try_cast("bigint").cast("string") for part in (card, address)]
    return F.concat(parts[0], F.lit("_"), parts[1])


def has_infinite_part(card: Column, address: Column) -> Column:
    """True when uid cannot be formed because a part is infinite (both parts must be present)."""

    def infinite(part: Column) -> Column:
        return F.abs(part.cast("double")) == F.lit(float("inf"))

    ordered = infinite(card) | (~F.isnan(card.cast("double")) & infinite(address))
    return F.coalesce(card.isNotNull() & address.isNotNull() & ordered, F.lit(False))


def parse_flag(text: Column) -> Column:
    return F.upper(text) == F.lit("T")


def has_identity(columns: list[Column]) -> Column:
    return F.coalesce(*[c.cast("string") for c in columns]).isNotNull()


def normalize_email(domain: Column) -> Column:
    return strip_text(F.lower(F.coalesce(domain, F.lit(""))))


def message_key(uid_column: Column, transaction_id: Column) -> Column:
    return F.coalesce(F.nullif(uid_column, F.lit("")), transaction_id.cast("string"))


def hour_band(hour: Column) -> Column:
    return (
        F.when(hour.between(0, 5), "HIGH")
        .when(hour.between(6, 9), "MEDIUM")
        .when(hour.between(22, 23), "MEDIUM")
        .otherwise("LOW")
    )


def score_tier(score: Column) -> Column:
    return F.when(score >= 65, "HIGH").when(score >= 35, "MEDIUM").otherwise("LOW")
