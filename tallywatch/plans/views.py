"""The persisted views over the silver and gold tables of a database, as SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tallywatch.sources import tables


def _units(amount: str, condition: str = "true") -> str:
    """A sum in whole ten-thousandths, as ``functions.numbers`` counts money."""
    return f"CAST(sum(CASE WHEN {condition} THEN try_cast(round({amount} * 10000.0D) AS DECIMAL(38,0)) END) AS DOUBLE) / 10000.0D"


def _half_up(value: str, places: int) -> str:
    factor = f"{10**places}.0D"
    return f"floor(({value}) * {factor} + 0.5D) / {factor}"


def _by(key: str, more: str = "") -> str:
    rate = "CAST(sum(CAST(isfraud AS BIGINT)) AS DOUBLE) / nullif(count(isfraud), 0) * 100.0D"
    mean = f"{_units('transactionamt')} / nullif(count(transactionamt), 0)"
    return f"""SELECT {key}, count(*) AS total_transactions, sum(CAST(isfraud AS BIGINT)) AS fraud_count,
  {_half_up(rate, 3)} AS fraud_rate_pct, {_half_up(mean, 2)} AS {{mean}}{more}"""


# Each text reads ``{db}.silver_transactions`` or a gold table of the same database.
VIEWS = {
    "fraud_rate_by_product": _by("productcd", f",\n  {_half_up('coalesce(' + _units('transactionamt', 'isfraud = 1') + ', 0.0D)', 2)} AS total_fraud_amt").replace("{mean}", "avg_transaction_amt")
    + "\nFROM {db}.silver_transactions GROUP BY productcd",
    "hourly_fraud_trend": _by("transaction_hour").replace("{mean}", "avg_transaction_amt") + "\nFROM {db}.silver_transactions GROUP BY transaction_hour",
    "top_risky_uids": _by("uid", f",\n  {_half_up(_units('transactionamt'), 2)} AS total_amount, max(transaction_date) AS last_seen").replace("{mean}", "avg_amount")
    + "\nFROM {db}.silver_transactions WHERE uid IS NOT NULL GROUP BY uid HAVING count(*) >= 3",
    "rule_effectiveness_ranking": f"""SELECT rule_name, rule_type, sum(triggers_count) AS total_triggers, sum(true_positive) AS total_tp,
  sum(false_positive) AS total_fp, {_half_up("avg(precision_score) * 100.0D", 2)} AS avg_precision_pct,
  {_half_up("avg(recall_score) * 100.0D", 2)} AS avg_recall_pct, {_half_up("avg(f1_score) * 100.0D", 2)} AS avg_f1_pct,
  {_half_up(_units("blocked_amount"), 2)} AS total_blocked_amount
FROM {{db}}.rule_performance GROUP BY rule_name, rule_type""",
    "daily_blocked_amount": f"""SELECT summary_date, total_transactions, fraud_count, {_half_up("fraud_rate * 100.0D", 3)} AS fraud_rate_pct,
  blocked_count, {_half_up("blocked_amount", 2)} AS blocked_amount, {_half_up("fraud_amount", 2)} AS fraud_amount,
  {_half_up("blocked_amount / nullif(fraud_amount, 0) * 100.0D", 2)} AS capture_rate_pct
FROM {{db}}.daily_fraud_summary""",
}

# What identifies a row of each view, and its figures.
VIEW_VALUES = {
    "fraud_rate_by_product": (["productcd"], "total_transactions fraud_count fraud_rate_pct avg_transaction_amt total_fraud_amt".split()),
    "hourly_fraud_trend": (["transaction_hour"], "total_transactions fraud_count fraud_rate_pct avg_transaction_amt".split()),
    "top_risky_uids": (["uid"], "total_transactions fraud_count fraud_rate_pct avg_amount total_amount".split()),
    "rule_effectiveness_ranking": (["rule_name", "rule_type"], "total_triggers total_tp total_fp avg_precision_pct avg_recall_pct avg_f1_pct total_blocked_amount".split()),
    "daily_blocked_amount": (["summary_date"], "total_transactions fraud_count fraud_rate_pct blocked_count blocked_amount fraud_amount capture_rate_pct".split()),
}


def create_views(spark: SparkSession, database: str) -> None:
    for name, text in VIEWS.items():
        tables.create_view(spark, f"{database}.{name}", text.replace("{db}", database))
