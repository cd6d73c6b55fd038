"""Quality gate: the first reason to reject a record, and the split into good and dead-letter rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.functions import cleaning, features, wire
from tallywatch.functions.numbers import LARGEST_AMOUNT, plain_float_text
from tallywatch.operators import contracts
from tallywatch.operators.contracts import Contract

# Accepted product codes and the texts of the reject reasons.
VALID_PRODUCTS = ("W", "H", "C", "S", "R")
DECODE_FAILED = "decode_failed"
NULL_TRANSACTION_ID = "null_transaction_id"
INFINITE_UID = "build_error:cannot convert float infinity to integer"
DATE_RANGE = "build_error:date value out of range"
AMOUNT_RANGE = "amount_out_of_range"  # own reason: a finite amount beyond what exact sums hold


def decode_log(df: DataFrame, contract: Contract, keep: tuple[str, ...] = ("offset",)) -> DataFrame:
    """Framed ``value`` to contract columns plus ``decoded``; rows that cannot be read keep only ``keep``.

    Pass ``contract.only(...)`` to parse no more fields than are used.
    """
    return wire.decode_records(df, wire.body(F.col("value")), contract.struct_type(), keep)


def _checks(decoded: Column | None) -> list[tuple[Column, Column]]:
    """(failed, reason) pairs in order of precedence; ``failed`` is never NULL. A NaN amount passes."""
    amount = F.col("TransactionAmt")
    product = F.col("ProductCD")
    checks = [
        (F.col("TransactionID").isNull(), F.lit(NULL_TRANSACTION_ID)),
        (
            amount.isNull() | (amount <= 0),
            F.concat(F.lit("invalid_amount:"), F.coalesce(plain_float_text(amount), F.lit("None"))),
        ),
        (
            product.isNull() | ~product.isin(*VALID_PRODUCTS),
            F.concat(F.lit("invalid_product:"), F.coalesce(product, F.lit("None"))),
        ),
        (features.offset_out_of_range(F.col("TransactionDT")), F.lit(DATE_RANGE)),
        (features.has_infinite_part(F.col("card1"), F.col("addr1")), F.lit(INFINITE_UID)),
        ((amount >= LARGEST_AMOUNT) & (amount < float("inf")), F.lit(AMOUNT_RANGE)),
    ]
    return checks if decoded is None else [(~decoded, F.lit(DECODE_FAILED)), *checks]


def _decoded(df: DataFrame) -> Column | None:
    return F.col("decoded") if "decoded" in df.columns else None


def reject_reason(decoded: Column | None = None) -> Column:
    """First failing check of a raw record; NULL for a good one."""
    return F.coalesce(*[F.when(failed, why) for failed, why in _checks(decoded)])


def with_reject_reason(df: DataFrame) -> DataFrame:
    return df.withColumn("reject_reason", reject_reason(_decoded(df)))


def good_records(df: DataFrame) -> DataFrame:
    """Raw records with no reject reason, by plain predicates that can reach the scan."""
    for failed, _ in _checks(_decoded(df)):
        df = df.filter(~failed)
    return df


def bad_records(df: DataFrame) -> DataFrame:
    """Raw records with a reject reason, and the reason."""
    failed = [test for test, _ in _checks(_decoded(df))]
    return with_reject_reason(df.filter(reduce(lambda a, b: a | b, failed)))


def missing_required(contract: Contract, label: str) -> Column:
    """Reject reason of the later stages: unreadable, or a required field is missing."""
    missing = [F.when(F.col(n).isNull(), F.lit(f"{label}:{n}")) for n in contract.required]
    return F.coalesce(F.when(~F.col("decoded"), F.lit(DECODE_FAILED)), *missing)


# Raw fields the checks and derived columns read.
CHECKED_FIELDS = ("TransactionID", "TransactionDT", "TransactionAmt", "ProductCD", "card1", "addr1")


def build_validated(
    df: DataFrame, keep: tuple[str, ...] = (), contract: Contract = contracts.VALIDATED
) -> DataFrame:
    """Typed record with time features, uid, flags and has_identity, in contract order."""
    event_ts = features.event_time(F.col("TransactionDT"))
    have = set(df.columns)
    derived = {
        "TransactionDT": F.coalesce(F.col("TransactionDT"), F.lit(0)).cast("bigint"),
        "event_timestamp": F.date_format(event_ts, "yyyy-MM-dd'T'HH:mm:ss"),
        "transaction_date": F.date_format(event_ts, "yyyy-MM-dd"),
        "transaction_hour": features.transaction_hour(event_ts),
        "transaction_dow": features.transaction_dow(event_ts),
        "cent_amt": features.fractional_amount(F.col("TransactionAmt")),
        "uid": features.uid(F.col("card1"), F.col("addr1")),
    }
    identity = [F.col(c) for c in features.IDENTITY_FIELDS if c in have]
    derived["has_identity"] = features.has_identity(identity) if identity else F.lit(False)
    derived = {n: c for n, c in derived.items() if n in contract.names}
    for name in contract.names:
        if name in have and name.startswith("M") and name != "M4":
            derived[name] = features.parse_flag(F.col(name))
    return contract.conform(df.withColumns(derived), keep=keep)


def dead_letters(df: DataFrame, stage: str, reason: str = "reject_reason", key: str | None = None) -> DataFrame:
    """Rejected rows as keyed messages: key is the reason (or ``key``), value a small JSON object."""
    why = F.col(reason)
    label = F.when(why.startswith("build_error"), F.lit("build_error")).otherwise(why)
    if key is not None:
        label = F.when(why == DECODE_FAILED, F.lit("decode_error")).otherwise(F.lit(key))
    payload = F.to_json(F.struct(why.alias("reason"), F.col("offset")))
    return df.filter(why.isNotNull()).select(
        F.lit(stage).alias("stage"), label.cast("binary").alias("key"), payload.cast("binary").alias("value"), "offset"
    )


def accepted(df: DataFrame, reason: str = "reject_reason") -> DataFrame:
    return df.filter(F.col(reason).isNull())


def to_messages(df: DataFrame, contract: Contract, keep: tuple[str, ...] = ()) -> DataFrame:
    """Contract rows as keyed framed messages; the key is uid, else the transaction id."""
    key = features.message_key(F.col("uid"), F.col("TransactionID"))
    record = F.struct(*[F.col(n) for n in contract.names])
    value = wire.frame(wire.encode_body(record), contract.schema_id)
    return df.select(key.cast("binary").alias("key"), value.alias("value"), *keep)


def clean_text_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({n: cleaning.normalize_null(F.col(n)) for n in names})
