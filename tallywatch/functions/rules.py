"""The weighted rule set: each rule maps an enriched record to a score from 0 to 100."""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywatch.functions.features import normalize_email
from tallywatch.functions.numbers import zero_if_missing

# Fixed values of the rule set.
MODEL_VERSION = "rules-v1.0"
MAINSTREAM_DOMAINS = (
    "gmail.com",
    "hotmail.com",
    "outlook.com",
    "icloud.com",
    "live.com",
    "msn.com",
    "comcast.net",
    "att.net",
    "verizon.net",
    "me.com",
)


def _number(name: str) -> Column:
    return zero_if_missing(F.col(name))


def _yes(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def _capped(value: Column) -> Column:
    return F.least(F.lit(100.0), value)


def _bands(value: Column, *steps: tuple[float, float]) -> Column:
    """Score of the first threshold the value is above, else 0."""
    expr = F.when(value > F.lit(steps[0][0]), F.lit(steps[0][1]))
    for threshold, score in steps[1:]:
        expr = expr.when(value > F.lit(threshold), F.lit(score))
    return expr.otherwise(F.lit(0.0))


def high_amount_new_uid() -> Column:
    amount = _number("TransactionAmt")
    recent = F.coalesce(F.col("txn_count_1hr"), F.lit(0))
    return (
        F.when((amount > 500.0) & (recent <= 1), _capped((amount / F.lit(500.0)) * F.lit(60.0)))
        .when((amount > 200.0) & (recent <= 2), F.lit(30.0))
        .otherwise(F.lit(0.0))
    )


def anonymous_email_amount() -> Column:
    amount = _number("TransactionAmt")
    risk = _number("p_email_risk_score")
    anonymous = _yes("p_email_is_anonymous")
    raised = _capped(risk + (amount / F.lit(100.0)) * F.lit(10.0))
    return F.when(anonymous & (amount > 100.0), raised).when(anonymous, risk).otherwise(F.lit(0.0))


def product_h_cnp() -> Column:
    product = F.col("ProductCD")
    return F.when(product == "H", F.lit(75.0)).when(product == "C", F.lit(60.0)).otherwise(F.lit(0.0))


def velocity_breach() -> Column:
    day = _number("spend_24hr")
    hourly = day / F.lit(24.0)
    ratio = _number("spend_1hr") / F.nullif(hourly, F.lit(0.0))
    flagged = F.when(day > 0.0, _capped(ratio * F.lit(25.0))).otherwise(F.lit(50.0))
    return F.when(_yes("velocity_flag"), flagged).otherwise(F.lit(0.0))


def foreign_email() -> Column:
    domain = normalize_email(F.col("P_emaildomain"))
    return ~domain.isin(*MAINSTREAM_DOMAINS) & (domain != "")


def night_foreign_email() -> Column:
    night = F.upper(F.coalesce(F.nullif(F.col("hour_risk_level"), F.lit("")), F.lit("LOW"))) == "HIGH"
    suspicious = _yes("p_email_is_anonymous") | foreign_email()
    return F.when(night & suspicious, F.lit(80.0)).when(night, F.lit(40.0)).otherwise(F.lit(0.0))


def m_mismatch() -> Column:
    """Always 0: the match flags are not part of the enriched record."""
    return F.lit(0.0)


def c13_spike() -> Column:
    return _bands(_number("C13"), (2500.0, 100.0), (1500.0, 60.0), (500.0, 25.0))


def v258_v257_threshold() -> Column:
    a, b = _number("V258"), _number("V257")
    both = _capped((a + b) * F.lit(10.0))
    return F.when((a > 0) & (b > 0), both).when((a > 0) | (b > 0), F.lit(30.0)).otherwise(F.lit(0.0))


@dataclass(frozen=True)
class Rule:
    name: str
    weight: float
    score: Callable[[], Column]
    gold_name: str

    @property
    def column(self) -> str:
        return f"rule_{self.name}"


# Weights (they sum to 1) and the names used in the performance table.
RULES = (
    Rule("high_amount_new_uid", 0.20, high_amount_new_uid, "high_amount"),
    Rule("anonymous_email_amount", 0.15, anonymous_email_amount, "anonymous_email"),
    Rule("product_h_cnp", 0.15, product_h_cnp, "product_h"),
    Rule("velocity_breach", 0.20, velocity_breach, "velocity"),
    Rule("night_foreign_email", 0.10, night_foreign_email, "night_tx"),
    Rule("m_mismatch", 0.05, m_mismatch, "mismatch"),
    Rule("c13_spike", 0.10, c13_spike, "c13_spike"),
    Rule("v258_v257_threshold", 0.05, v258_v257_threshold, "v258_v257"),
)
