"""Gold aggregates and the views on top of them.

Money is summed as whole units (see ``functions.numbers``) and every group is pre-aggregated before
the shuffle, so a group that holds a third of the rows costs no more than any other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.features import hour_band, score_tier
from tallywatch.functions.numbers import from_units, half_up, safe_divide, to_units
from tallywatch.functions.rules import RULES

# Rates are averaged as whole billionths, so that the mean does not depend on the row order.
RATE_UNITS = 1_000_000_000


def _is_fraud() -> Column:
    return F.col("isfraud") == 1


def _count_where(condition: Column) -> Column:
    return F.count_if(condition)


def _units_where(condition: Column | None = None) -> Column:
    units = to_units(F.col("transactionamt"))
    return F.sum(units if condition is None else F.when(condition, units))


def _rate(part: Column, whole: Column) -> Column:
    return part.cast("double") / whole.cast("double")


def _mean_rate(rate: Column) -> Column:
    total = F.sum(F.round(rate * F.lit(float(RATE_UNITS))).cast("bigint"))
    return total.cast("double") / F.lit(float(RATE_UNITS)) / F.nullif(F.count(rate), F.lit(0))


def daily_fraud_summary(decisions: DataFrame) -> DataFrame:
    blocked = F.col("decision") == "BLOCK"
    sums = (
        decisions.filter(F.col("transaction_date").isNotNull())
        .groupBy(F.col("transaction_date").cast("date").alias("summary_date"))
        .agg(
            F.count("*").alias("total_transactions"),
            _units_where().alias("_all"),
            _count_where(_is_fraud()).alias("fraud_count"),
            _units_where(_is_fraud()).alias("_fraud"),
            F.count(F.when(_is_fraud(), F.col("transactionamt"))).alias("_fraud_n"),
            F.max(F.when(_is_fraud(), F.col("transactionamt"))).alias("max_fraud_amount"),
            _count_where(blocked).alias("blocked_count"),
            _units_where(blocked).alias("_blocked"),
        )
    )
    return sums.select(
        "summary_date",
        "total_transactions",
        from_units(F.col("_all")).alias("total_amount"),
        "fraud_count",
        from_units(F.col("_fraud")).alias("fraud_amount"),
        _rate(F.col("fraud_count"), F.col("total_transactions")).alias("fraud_rate"),
        safe_divide(from_units(F.col("_fraud")), F.col("_fraud_n")).alias("avg_fraud_amount"),
        "max_fraud_amount",
        "blocked_count",
        from_units(F.col("_blocked")).alias("blocked_amount"),
    )


def _performance_counts(decisions: DataFrame, scores: list[tuple[str, Column]]) -> DataFrame:
    """One pass over the decisions, one output row per (name, score): no row is multiplied by the rules."""
    legit = F.col("isfraud") == 0
    blocked = F.col("decision") == "BLOCK"
    measures = {
        "triggers_count": lambda s: _count_where(s > 0),
        "true_positive": lambda s: _count_where((s > 0) & _is_fraud()),
        "false_positive": lambda s: _count_where((s > 0) & legit),
        "true_negative": lambda s: _count_where((s == 0) & legit),
        "false_negative": lambda s: _count_where((s == 0) & _is_fraud()),
        "_blocked": lambda s: _units_where((s > 0) & blocked),
    }
    aggregates = [F.count("*").alias("_rows"), _count_where(_is_fraud()).alias("_fraud")]
    for i, (_, value) in enumerate(scores):
        aggregates += [measure(value).alias(f"{name}{i}") for name, measure in measures.items()]
    wide = decisions.agg(*aggregates).filter(F.col("_rows") > 0)
    per_rule = [
        F.struct(F.lit(rule).alias("rule_name"), *[F.col(f"{m}{i}").alias(m) for m in measures])
        for i, (rule, _) in enumerate(scores)
    ]
    return wide.select("_fraud", F.inline(F.array(*per_rule)))


def _performance(decisions: DataFrame, scores: list[tuple[str, Column]], run_date: Column) -> DataFrame:
    tp = F.col("true_positive").cast("double")
    fraud = F.col("_fraud")
    counted = _performance_counts(decisions, scores).withColumn(
        "precision_score", safe_divide(tp, F.col("triggers_count"))
    )
    with_recall = counted.withColumn("recall_score", safe_divide(tp, fraud))
    product = safe_divide(F.col("precision_score") * tp, fraud)
    total = F.col("precision_score") + F.col("recall_score")
    return with_recall.select(
        run_date.alias("summary_date"),
        "rule_name",
        F.lit("scoring").alias("rule_type"),
        "triggers_count",
        "true_positive",
        "false_positive",
        "true_negative",
        "false_negative",
        "precision_score",
        "recall_score",
        ((F.lit(2.0) * product) / F.nullif(total, F.lit(0.0))).alias("f1_score"),
        from_units(F.col("_blocked")).alias("blocked_amount"),
    )


def rule_performance(decisions: DataFrame, run_date: Column) -> DataFrame:
    """Every rule judged by the composite score, as the base table defines it: rows differ by name only."""
    counted = _performance(decisions, [("", F.col("fraud_score"))], run_date).drop("rule_name")
    return counted.withColumn("rule_name", F.explode(F.array(*[F.lit(r.gold_name) for r in RULES]))).select(
        "summary_date", "rule_name", *[c for c in counted.columns if c != "summary_date"]
    )


def rule_performance_by_rule(decisions: DataFrame, run_date: Column) -> DataFrame:
    """Every rule judged by its own score."""
    return _performance(decisions, [(r.gold_name, F.col(f"score_{r.name}")) for r in RULES], run_date)


def unpivot_rules(decisions: DataFrame, score_of: dict[str, str]) -> DataFrame:
    """Wide to long: one row per decision and rule, from ``{rule name: score column}``."""
    pairs = [F.struct(F.lit(n).alias("rule_name"), F.col(c).alias("rule_score")) for n, c in score_of.items()]
    return decisions.select("*", F.inline(F.array(*pairs)))


def uid_risk_profile(decisions: DataFrame) -> DataFrame:
    """Two steps: the first collapses rows per (uid, product, email), so the distinct counts see few rows."""
    if "event_at" in decisions.columns:
        seen = F.col("event_at")
    else:
        seen = F.timestamp_add("HOUR", F.col("transaction_hour").cast("bigint"), F.col("transaction_date").cast("timestamp_ntz"))
    narrow = (
        decisions.filter(F.col("uid").isNotNull())
        .groupBy("uid", "productcd", "p_emaildomain")
        .agg(
            F.count("*").alias("n"),
            F.count("transactionamt").alias("n_amount"),
            _units_where().alias("units"),
            _count_where(_is_fraud()).alias("fraud"),
            F.max("transactionamt").alias("top"),
            F.sum(F.round(F.col("fraud_score") * F.lit(100.0)).cast("bigint")).alias("points"),
            F.count("fraud_score").alias("n_score"),
            F.max(seen).alias("seen"),
        )
    )
    sums = narrow.groupBy("uid").agg(
        F.sum("n").alias("total_transactions"),
        F.sum("units").alias("_units"),
        F.sum("n_amount").alias("_n_amount"),
        F.sum("fraud").alias("fraud_count"),
        F.max("top").alias("max_amount"),
        F.count_distinct("productcd").alias("distinct_merchants"),
        F.count_distinct("p_emaildomain").alias("distinct_emails"),
        F.sum("points").alias("_points"),
        F.sum("n_score").alias("_n_score"),
        F.max("seen").alias("last_seen"),
    )
    mean_score = F.col("_points").cast("double") / F.lit(100.0) / F.nullif(F.col("_n_score"), F.lit(0))
    parts = F.split("uid", "_")
    return sums.select(
        "uid",
        F.get(parts, F.lit(0)).try_cast("double").alias("card1"),
        F.get(parts, F.lit(1)).try_cast("double").alias("addr1"),
        "total_transactions",
        from_units(F.col("_units")).alias("total_amount"),
        "fraud_count",
        _rate(F.col("fraud_count"), F.col("total_transactions")).alias("fraud_rate"),
        safe_divide(from_units(F.col("_units")), F.col("_n_amount")).alias("avg_amount"),
        "max_amount",
        "distinct_merchants",
        "distinct_emails",
        "last_seen",
        score_tier(mean_score).alias("risk_tier"),
    )


def hourly_fraud_pattern(decisions: DataFrame, run_date: Column, by_weekday: bool = False) -> DataFrame:
    """Per hour of day; with ``by_weekday`` also per day of week (0 is Monday)."""
    weekday = F.weekday("transaction_date") if by_weekday else F.lit(None).cast("int")
    keys = ["transaction_hour", "transaction_dow"] if by_weekday else ["transaction_hour"]
    sums = (
        decisions.filter(F.col("transaction_hour").isNotNull())
        .withColumn("transaction_dow", weekday)
        .groupBy(*keys)
        .agg(
            F.count("*").alias("total_transactions"),
            _count_where(_is_fraud()).alias("fraud_count"),
            _units_where().alias("_units"),
            F.count("transactionamt").alias("_n"),
        )
    )
    return sums.select(
        run_date.alias("summary_date"),
        "transaction_hour",
        (F.col("transaction_dow") if by_weekday else weekday).alias("transaction_dow"),
        "total_transactions",
        "fraud_count",
        _rate(F.col("fraud_count"), F.col("total_transactions")).alias("fraud_rate"),
        safe_divide(from_units(F.col("_units")), F.col("_n")).alias("avg_amount"),
        hour_band(F.col("transaction_hour")).alias("risk_level"),
    )


def product_fraud_stats(decisions: DataFrame) -> DataFrame:
    sums = (
        decisions.filter(F.col("transaction_date").isNotNull())
        .groupBy(F.col("transaction_date").cast("date").alias("summary_date"), "productcd")
        .agg(
            F.count("*").alias("total_transactions"),
            _units_where().alias("_all"),
            F.count("transactionamt").alias("_n"),
            _count_where(_is_fraud()).alias("fraud_count"),
            _units_where(_is_fraud()).alias("_fraud"),
            F.count(F.when(_is_fraud(), F.col("transactionamt"))).alias("_fraud_n"),
        )
    )
    return sums.select(
        "summary_date",
        "productcd",
        "total_transactions",
        from_units(F.col("_all")).alias("total_amount"),
        "fraud_count",
        _rate(F.col("fraud_count"), F.col("total_transactions")).alias("fraud_rate"),
        safe_divide(from_units(F.col("_all")), F.col("_n")).alias("avg_transaction_amt"),
        safe_divide(from_units(F.col("_fraud")), F.col("_fraud_n")).alias("avg_fraud_amt"),
    )


# --- views over silver transactions ---------------------------------------------------------


def _fraud_view(transactions: DataFrame, key: str, *extra: Column) -> DataFrame:
    labelled = F.count("isfraud")
    fraud = F.sum(F.col("isfraud").cast("bigint"))
    n_amount = F.nullif(F.count("transactionamt"), F.lit(0))
    rate = fraud.cast("double") / F.nullif(labelled, F.lit(0)) * F.lit(100.0)
    return transactions.groupBy(key).agg(
        F.count("*").alias("total_transactions"),
        fraud.alias("fraud_count"),
        half_up(rate, 3).alias("fraud_rate_pct"),
        half_up(from_units(_units_where()) / n_amount, 2).alias("avg_transaction_amt"),
        *extra,
    )


def fraud_rate_by_product(transactions: DataFrame) -> DataFrame:
    fraud_units = F.coalesce(_units_where(_is_fraud()), F.lit(0).cast("bigint"))
    return _fraud_view(transactions, "productcd", half_up(from_units(fraud_units), 2).alias("total_fraud_amt"))


def hourly_fraud_trend(transactions: DataFrame) -> DataFrame:
    return _fraud_view(transactions, "transaction_hour").orderBy("transaction_hour")


def top_risky_uids(transactions: DataFrame, at_least: int = 3) -> DataFrame:
    known = transactions.filter(F.col("uid").isNotNull())
    grouped = _fraud_view(
        known,
        "uid",
        half_up(from_units(_units_where()), 2).alias("total_amount"),
        F.max("transaction_date").alias("last_seen"),
    )
    return (
        grouped.filter(F.col("total_transactions") >= at_least)
        .withColumnRenamed("avg_transaction_amt", "avg_amount")
        .orderBy(F.desc("fraud_rate_pct"), "uid")
    )


# --- views over gold tables -----------------------------------------------------------------


def rule_effectiveness_ranking(performance: DataFrame) -> DataFrame:
    def percent(name: str) -> Column:
        return half_up(F.avg(name) * F.lit(100.0), 2)

    ranked = performance.groupBy("rule_name", "rule_type").agg(
        F.sum("triggers_count").alias("total_triggers"),
        F.sum("true_positive").alias("total_tp"),
        F.sum("false_positive").alias("total_fp"),
        percent("precision_score").alias("avg_precision_pct"),
        percent("recall_score").alias("avg_recall_pct"),
        percent("f1_score").alias("avg_f1_pct"),
        half_up(from_units(F.sum(to_units(F.col("blocked_amount")))), 2).alias("total_blocked_amount"),
    )
    return ranked.orderBy(F.desc("avg_f1_pct"), "rule_name")


def daily_blocked_amount(daily: DataFrame) -> DataFrame:
    capture = safe_divide(F.col("blocked_amount"), F.col("fraud_amount")) * F.lit(100.0)
    return daily.select(
        "summary_date",
        "total_transactions",
        "fraud_count",
        half_up(F.col("fraud_rate") * F.lit(100.0), 3).alias("fraud_rate_pct"),
        "blocked_count",
        half_up(F.col("blocked_amount"), 2).alias("blocked_amount"),
        half_up(F.col("fraud_amount"), 2).alias("fraud_amount"),
        half_up(capture, 2).alias("capture_rate_pct"),
    ).orderBy(F.desc("summary_date"))


def fraud_totals(daily: DataFrame) -> DataFrame:
    """Grand totals; the average rate is the mean of the daily rates."""
    return daily.agg(
        F.sum("total_transactions").alias("total_transactions"),
        F.sum("fraud_count").alias("fraud_count"),
        _mean_rate(F.col("fraud_rate")).alias("avg_fraud_rate"),
        F.sum("blocked_count").alias("blocked_count"),
        F.count_distinct("summary_date").alias("days_tracked"),
    )


def risk_tier_rollup(profiles: DataFrame) -> DataFrame:
    return profiles.groupBy("risk_tier").agg(
        F.count("*").alias("uid_count"), _mean_rate(F.col("fraud_rate")).alias("avg_fraud_rate")
    )


def latest_daily(daily: DataFrame) -> DataFrame:
    return daily.orderBy(F.desc("summary_date")).limit(1)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count")) for name, df in tables.items()]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result


# What identifies a row of each gold table, and its figures.
GOLD_VALUES = {
    "daily_fraud_summary": (
        ["summary_date"],
        "total_transactions total_amount fraud_count fraud_amount fraud_rate avg_fraud_amount max_fraud_amount blocked_count blocked_amount".split(),
    ),
    "product_fraud_stats": (["summary_date", "productcd"], "total_transactions total_amount fraud_count fraud_rate avg_transaction_amt avg_fraud_amt".split()),
    "hourly_fraud_pattern": (["transaction_hour"], "total_transactions fraud_count fraud_rate avg_amount".split()),
    "rule_performance": (["rule_name"], "triggers_count true_positive false_positive true_negative false_negative precision_score recall_score f1_score blocked_amount".split()),
    "uid_risk_profile": (["uid"], "total_transactions total_amount fraud_count fraud_rate avg_amount max_amount distinct_merchants distinct_emails".split()),
}


def long_values(tables: dict[str, DataFrame], values: dict[str, tuple[list[str], list[str]]] = GOLD_VALUES) -> DataFrame:
    """Every figure of the gold tables (or of views): table_name, row_key, metric, value."""
    parts = []
    for name, df in tables.items():
        keys, metrics = values[name]
        key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
        figures = F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]))
        parts.append(df.select(F.lit(name).alias("table_name"), key.alias("row_key"), figures))
    return reduce(DataFrame.unionByName, parts)
