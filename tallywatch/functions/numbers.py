"""Exact money arithmetic and rounding that does not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts are summed as whole ten-thousandths: such sums are exact and associative, while double sums change
# with the partitioning. The counts are decimals, because a long holds no more than 9.2e14.
UNITS_PER_ONE = 10_000
UNITS_TYPE = "decimal(38,0)"
# Records with a larger amount are rejected, so that no sum of fewer than 10^12 rows can run out of digits.
LARGEST_AMOUNT = 1e18


def to_units(amount: Column) -> Column:
    """Amount as a whole count of 1/10000; NULL for NULL, non-finite and unrepresentable amounts."""
    return F.round(amount * F.lit(float(UNITS_PER_ONE))).try_cast(UNITS_TYPE)


#: Units as two 64-bit numbers, high * LIMB + low: sums of either hold 9 * 10^7 rows of any amount.
LIMB = 10**11


def limbs(units: Column) -> tuple[Column, Column]:
    """The high and the low part; the low one is never negative."""
    low = F.pmod(units, F.lit(LIMB).cast(UNITS_TYPE))
    return ((units - low) / F.lit(LIMB)).cast("bigint"), low.cast("bigint")


def from_limbs(high: Column, low: Column) -> Column:
    return (high.cast(UNITS_TYPE) * F.lit(LIMB) + low).cast(UNITS_TYPE)


def from_units(units: Column) -> Column:
    return units.cast("double") / F.lit(float(UNITS_PER_ONE))


def cents_from_units(units: Column) -> Column:
    """Units rounded half up to two places, as a double; integer arithmetic up to the last step."""
    return _whole((units + F.lit(50)) / F.lit(100.0)) / F.lit(100.0)


def _whole(value: Column) -> Column:
    """The floor of a double; from 2^53 on a double is whole, and a long would not hold the largest."""
    return F.when(F.abs(value) < F.lit(2.0**53), F.floor(value).cast("double")).otherwise(value.cast("double"))


def half_up(value: Column, places: int) -> Column:
    """Round a non-negative double half up with the same IEEE steps in every engine."""
    factor = float(10**places)
    return _whole(value * F.lit(factor) + F.lit(0.5)) / F.lit(factor)


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), value))


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """NULL instead of an error when the denominator is zero."""
    return numerator / F.nullif(denominator, F.lit(0))


def zero_if_missing(value: Column) -> Column:
    """NULL and NaN become 0.0, so that no comparison on them holds."""
    return F.nanvl(F.coalesce(value.cast("double"), F.lit(0.0)), F.lit(0.0))


def plain_float_text(value: Column) -> Column:
    """A double as plain digits (``-12345678.5``) in the range where Spark would use an exponent."""
    digits = F.regexp_replace(value.try_cast("decimal(38,18)").cast("string"), r"(\.\d+?)0+$", "$1")
    size = F.abs(value)
    exponent_in_spark = ((size >= F.lit(1e7)) & (size < F.lit(1e16))) | ((size >= F.lit(1e-4)) & (size < F.lit(1e-3)))
    return F.when(exponent_in_spark, digits).otherwise(value.cast("string"))
