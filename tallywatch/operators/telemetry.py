"""Long-format metrics, alert rules, health rollups and counter arithmetic."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywatch.functions.numbers import clamp, safe_divide, to_units, from_units

SEVERITY_RANK = {"critical": 0, "warning": 1, "healthy": 2}
BAD_PHASES = ("Failed", "Pending", "Unknown")
RUNNING = "Running"


# --- long metrics ---------------------------------------------------------------------------


def flatten(df: DataFrame, measures: dict[str, str], labels: dict[str, str] | None = None) -> DataFrame:
    """Wide rows to (metric, labels, value): ``measures`` maps column to metric, ``labels`` label to column."""
    pairs = [F.lit(x) if i % 2 == 0 else F.col(x).cast("string") for kv in (labels or {}).items() for i, x in enumerate(kv)]
    label_map = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    entries = [
        F.struct(F.lit(metric).alias("metric"), F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias("value"))
        for c, metric in measures.items()
    ]
    long = df.select(label_map.alias("labels"), F.inline(F.array(*entries)))
    return long.select("metric", "labels", "value")


def union_metrics(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def label_text(labels: Column) -> Column:
    """A map of labels as ``k=v,k=v`` in key order, usable as a grouping key."""
    entries = F.array_sort(F.map_entries(labels))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")


def newest(df: DataFrame, by: str, per: list[str]) -> DataFrame:
    """The row with the greatest ``by`` for each ``per`` key, with partial aggregation."""
    rest = [c for c in df.columns if c not in per]
    picked = df.groupBy(*per).agg(F.max_by(F.struct(*rest), F.col(by)).alias("_row"))
    return picked.select(*per, "_row.*").select(*df.columns)


def gold_metrics(
    daily: DataFrame,
    product: DataFrame,
    hourly: DataFrame,
    profiles: DataFrame,
    rules: DataFrame,
    decisions: DataFrame,
    transactions: DataFrame,
) -> DataFrame:
    """All published metrics of the gold tables; products and rules show their latest date."""
    from tallywatch.plans import gold

    rolled = gold.risk_tier_rollup(profiles)
    return union_metrics(
        [
            flatten(
                gold.latest_daily(daily),
                {
                    "total_transactions": "fraud_daily_total_transactions",
                    "total_amount": "fraud_daily_total_amount",
                    "fraud_count": "fraud_daily_fraud_count",
                    "fraud_rate": "fraud_daily_fraud_rate",
                    "blocked_count": "fraud_daily_blocked_count",
                    "blocked_amount": "fraud_daily_blocked_amount",
                },
            ),
            flatten(
                gold.fraud_totals(daily),
                {
                    "total_transactions": "fraud_total_transactions_all",
                    "fraud_count": "fraud_total_fraud_count_all",
                    "avg_fraud_rate": "fraud_avg_fraud_rate_all",
                    "blocked_count": "fraud_total_blocked_all",
                    "days_tracked": "fraud_days_tracked",
                },
            ),
            flatten(
                newest(product, "summary_date", ["productcd"]),
                {
                    "total_transactions": "fraud_product_transactions",
                    "fraud_count": "fraud_product_fraud_count",
                    "fraud_rate": "fraud_product_fraud_rate",
                },
                {"product": "productcd"},
            ),
            flatten(
                hourly,
                {"total_transactions": "fraud_hourly_transactions", "fraud_rate": "fraud_hourly_fraud_rate"},
                {"hour": "transaction_hour", "risk": "risk_level"},
            ),
            flatten(
                rolled,
                {"uid_count": "fraud_uid_risk_count", "avg_fraud_rate": "fraud_uid_avg_fraud_rate"},
                {"tier": "risk_tier"},
            ),
            flatten(
                newest(rules, "summary_date", ["rule_name"]),
                {
                    "triggers_count": "fraud_rule_triggers",
                    "true_positive": "fraud_rule_true_positive",
                    "false_positive": "fraud_rule_false_positive",
                    "precision_score": "fraud_rule_precision",
                },
                {"rule": "rule_name"},
            ),
            flatten(decisions.agg(F.count("*").alias("n")), {"n": "fraud_silver_decisions_count"}),
            flatten(transactions.agg(F.count("*").alias("n")), {"n": "fraud_silver_transactions_count"}),
        ]
    )


# --- alert rules ----------------------------------------------------------------------------


@dataclass(frozen=True)
class AlertRule:
    alert: str
    metric: str
    op: str
    threshold: float
    severity: str
    hold_minutes: int
    label: str | None = None
    label_value: str | None = None


# Rules over the published metrics.
ALERT_RULES = (
    AlertRule("FraudRateSpikeDetected", "fraud_daily_fraud_rate", ">", 0.08, "critical", 5),
    AlertRule("FraudPipelineDLQNonZero", "fraud_silver_decisions_count", "==", 0.0, "critical", 10),
    AlertRule("FraudRateElevated", "fraud_daily_fraud_rate", ">", 0.05, "warning", 10),
    AlertRule("HighRiskProductCFraudRate", "fraud_product_fraud_rate", ">", 0.15, "warning", 5, "product", "C"),
)


def rules_frame(spark: SparkSession, rules: tuple[AlertRule, ...] = ALERT_RULES) -> DataFrame:
    rows = [(r.alert, r.metric, r.op, r.threshold, r.severity, r.hold_minutes, r.label, r.label_value) for r in rules]
    schema = (
        "alert string, rule_metric string, op string, threshold double, severity string, "
        "hold_minutes int, label string, label_value string"
    )
    return spark.createDataFrame(rows, schema)


def holds(value: Column, op: Column, threshold: Column) -> Column:
    return (
        F.when(op == ">", value > threshold)
        .when(op == "<", value < threshold)
        .when(op == ">=", value >= threshold)
        .when(op == "<=", value <= threshold)
        .when(op == "==", value == threshold)
        .otherwise(value != threshold)
    )


def evaluate_alerts(metrics: DataFrame, rules: tuple[AlertRule, ...] = ALERT_RULES) -> DataFrame:
    """Every (rule, matching series) with whether its condition holds; the rule list is a few rows."""
    table = F.broadcast(rules_frame(metrics.sparkSession, rules))
    label_matches = F.col("label").isNull() | (F.try_element_at("labels", F.col("label")) == F.col("label_value"))
    joined = metrics.join(table, (F.col("metric") == F.col("rule_metric")) & label_matches)
    return joined.withColumn("active", holds(F.col("value"), F.col("op"), F.col("threshold"))).drop("rule_metric")


def sustained(
    samples: DataFrame, series: list[str], ts: str, active: Column, hold_seconds: int | Column, max_gap_seconds: int, held_back: bool = False
) -> DataFrame:
    """Stretches in which ``active`` held without a break for at least ``hold_seconds``.

    With ``held_back`` the shorter ones come too, with a NULL ``fired_at``.
    ``samples`` has one row per series and scrape time, so a series is as long as the time covered,
    not as the number of raw events. A gap above ``max_gap_seconds`` ends a stretch.
    """
    order = Window.partitionBy(*series).orderBy(ts)
    at = F.unix_seconds(F.col(ts).cast("timestamp"))
    marked = samples.withColumns({"_at": at, "_on": F.coalesce(active, F.lit(False))})
    before = marked.withColumns({"_was_on": F.lag("_on").over(order), "_prev": F.lag("_at").over(order)})
    broken = F.col("_prev").isNull() | ~F.col("_was_on") | (F.col("_at") - F.col("_prev") > max_gap_seconds)
    started = before.withColumn("_start", F.when(F.col("_on") & broken, 1).otherwise(0))
    counted = started.withColumn(
        "_stretch", F.sum("_start").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    on = counted.filter("_on")
    stretch_start = F.min("_at").over(Window.partitionBy(*series, "_stretch"))
    due = F.when(F.col("_at") - F.col("_since") >= hold_seconds, F.col(ts))
    stretches = (
        on.withColumn("_since", stretch_start)
        .groupBy(*series, "_stretch")
        .agg(
            F.min(ts).alias("active_since"),
            F.min(due).alias("fired_at"),
            F.max(ts).alias("active_until"),
            F.count("*").alias("samples"),
        )
        .drop("_stretch")
    )
    return stretches if held_back else stretches.filter(F.col("fired_at").isNotNull())


def alert_stretches(samples: DataFrame, max_gap_seconds: int, rules: tuple[AlertRule, ...] = ALERT_RULES) -> DataFrame:
    """Every stretch in which a rule's condition held, over (metric, labels, ts, value) samples; a rule fires after its own hold."""
    judged = evaluate_alerts(samples, rules).withColumn("labels", label_text(F.col("labels")))
    hold = F.col("hold_minutes") * F.lit(60)
    return sustained(judged, ["alert", "severity", "labels"], "ts", F.col("active"), hold, max_gap_seconds, held_back=True)


def daily_rate_samples(transactions: DataFrame) -> DataFrame:
    """The fraud rate of the day so far, of all and of each product, one sample for each minute with transactions.

    Minutes are counted first, so a window holds the minutes of one day.
    """

    def series(metric: str, keys: list[str], labels: Column) -> DataFrame:
        minute = F.date_trunc("MINUTE", F.col("event_timestamp")).cast("timestamp_ntz")
        counted = transactions.filter(F.col("event_timestamp").isNotNull()).groupBy("transaction_date", *keys, minute.alias("ts"))
        counted = counted.agg(F.count("*").alias("_n"), F.count_if(F.col("isfraud") == 1).alias("_fraud"))
        so_far = Window.partitionBy("transaction_date", *keys).orderBy("ts").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rate = F.sum("_fraud").over(so_far).cast("double") / F.sum("_n").over(so_far).cast("double")
        return counted.select(F.lit(metric).alias("metric"), labels.alias("labels"), "ts", rate.alias("value"))

    everyone = series("fraud_daily_fraud_rate", [], F.expr("cast(map() as map<string,string>)"))
    return everyone.unionByName(series("fraud_product_fraud_rate", ["productcd"], F.create_map(F.lit("product"), F.col("productcd"))))


def scrape(samples: DataFrame, series: list[str], ts: str, value: str) -> DataFrame:
    """One sample per series and minute, the largest value of that minute."""
    minute = F.date_trunc("MINUTE", F.col(ts)).cast("timestamp_ntz")
    return samples.groupBy(*series, minute.alias(ts)).agg(F.max(value).alias(value))


# --- state of entities and groups -----------------------------------------------------------


def entity_latest_state(nodes: DataFrame, states: DataFrame) -> DataFrame:
    """Latest phase and summed restarts per entity, joined to its node; ``Unknown`` if never seen."""
    latest = states.groupBy("entity").agg(
        F.max_by("phase", F.struct("ts", "seq")).alias("phase"), F.sum("restarts").alias("restarts")
    )
    joined = nodes.join(latest, "entity", "left")
    return joined.select(
        "entity",
        F.coalesce("phase", F.lit("Unknown")).alias("phase"),
        F.coalesce("restarts", F.lit(0)).cast("bigint").alias("restarts"),
        "node",
    )


def latest_phase(states: DataFrame) -> DataFrame:
    return states.groupBy("grp", "entity").agg(F.max_by("phase", F.struct("ts", "seq")).alias("phase"))


def group_health(latest: DataFrame) -> DataFrame:
    counted = latest.groupBy("grp").agg(
        F.count_if(F.col("phase") == RUNNING).alias("running"), F.count_if(F.col("phase").isin(*BAD_PHASES)).alias("bad")
    )
    status = (
        F.when((F.col("running") == 0) | (F.col("bad") >= 3), "critical")
        .when(F.col("bad") > 0, "warning")
        .otherwise("healthy")
    )
    return counted.withColumn("status", status)


def health_score(*weighted: tuple[Column, float]) -> Column:
    """100 minus the weighted signals, kept within 0 and 100."""
    value = reduce(lambda acc, sw: acc - sw[0] * F.lit(sw[1]), weighted, F.lit(100.0))
    return clamp(value, 0.0, 100.0)


def status_band(value: Column, warning: float, critical: float) -> Column:
    return F.when(value >= critical, "critical").when(value >= warning, "warning").otherwise("healthy")


# Incident texts, in order of precedence; ``{}`` is the signal's value.
INCIDENTS = (
    (
        "bad_pods",
        lambda v: v > 40,
        "critical",
        "Workload instability detected",
        "{} pods are currently non-running.",
        "Possible impact on Spark jobs, Airflow tasks, or platform services.",
        "Open Namespace Health Matrix and inspect namespaces with bad pods.",
    ),
    (
        "memory",
        lambda v: v >= 85,
        "critical",
        "Cluster memory pressure detected",
        "Cluster memory utilization is at {}%.",
        "Scheduling delays, pod evictions, and Spark executor instability may occur.",
        "Check high-memory namespaces and worker node pressure.",
    ),
    (
        "cpu",
        lambda v: v >= 80,
        "warning",
        "High CPU utilization detected",
        "Cluster CPU utilization is at {}%.",
        "Batch jobs and query workloads may slow down.",
        "Check Spark, Trino, and Kafka workload activity.",
    ),
)
NO_INCIDENT = (
    "healthy",
    "No active incident detected",
    "Platform telemetry is within normal operating range.",
    "No immediate user-facing or data-platform impact detected.",
    "Continue monitoring namespace health and pod restarts.",
)


def classify_incidents(signals: DataFrame) -> DataFrame:
    """First matching incident over the columns bad_pods, memory and cpu."""

    def filled(template: str, signal: str) -> Column:
        head, _, tail = template.partition("{}")
        return F.concat(F.lit(head), F.col(signal).cast("string"), F.lit(tail))

    names = ("severity", "title", "root_cause", "impact", "suggestion")
    found = [
        F.when(
            test(F.col(signal)),
            F.struct(
                F.lit(level).alias(names[0]),
                F.lit(title).alias(names[1]),
                filled(cause, signal).alias(names[2]),
                F.lit(impact).alias(names[3]),
                F.lit(advice).alias(names[4]),
            ),
        )
        for signal, test, level, title, cause, impact, advice in INCIDENTS
    ]
    calm = F.struct(*[F.lit(t).alias(n) for t, n in zip(NO_INCIDENT, names)])
    return signals.withColumn("_incident", F.coalesce(*found, calm)).select(*signals.columns, "_incident.*")


def app_severity(health: Column, sync: Column) -> Column:
    return (
        F.when(F.coalesce(health, F.lit("Unknown")) != "Healthy", "critical")
        .when(F.coalesce(sync, F.lit("Unknown")) != "Synced", "warning")
        .otherwise("healthy")
    )


def by_severity(df: DataFrame, name: str = "name") -> DataFrame:
    rank = F.lit(99)
    for level, place in SEVERITY_RANK.items():
        rank = F.when(F.col("severity") == level, place).otherwise(rank)
    return df.orderBy(rank, name)


# --- counters and ratios --------------------------------------------------------------------


def _step(value: Column, previous: Column) -> Column:
    """Growth from one sample to the next; after a reset the new value itself."""
    return F.when(previous.isNull(), F.lit(0)).when(value < previous, value).otherwise(value - previous)


def counter_increase(samples: DataFrame, bucket_seconds: int, slice_seconds: int = 60) -> DataFrame:
    """Increase and rate of (series, ts, seq, value) counters per time bucket, resets handled.

    A bucket sees its own samples only. It is worked in slices, so that a busy series is shared by
    many tasks; the step from one slice to the next is added from the slices' last and first values.
    """
    if bucket_seconds % slice_seconds:
        raise ValueError("bucket_seconds must be a multiple of slice_seconds")
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    cut = samples.withColumns(
        {"_slice": F.floor(at / slice_seconds), "_bucket": F.floor(at / bucket_seconds) * bucket_seconds}
    )
    order = Window.partitionBy("series", "_slice").orderBy("ts", "seq")
    stepped = cut.withColumn("_step", _step(F.col("value"), F.lag("value").over(order)))
    place = F.struct("ts", "seq")
    sliced = stepped.groupBy("series", "_bucket", "_slice").agg(
        F.sum("_step").alias("_grown"),
        F.min_by("value", place).alias("_first"),
        F.max_by("value", place).alias("_last"),
        F.count("*").alias("_n"),
    )
    across = Window.partitionBy("series", "_bucket").orderBy("_slice")
    joined = sliced.withColumn("_bridge", _step(F.col("_first"), F.lag("_last").over(across)))
    grown = joined.groupBy("series", "_bucket").agg(
        F.sum(F.col("_grown") + F.col("_bridge")).cast("bigint").alias("increase"), F.sum("_n").alias("samples")
    )
    return grown.select(
        "series",
        F.timestamp_seconds(F.col("_bucket")).cast("timestamp_ntz").alias("bucket_start"),
        "increase",
        (F.col("increase").cast("double") / F.lit(float(bucket_seconds))).alias("rate_per_sec"),
        "samples",
    )


def ratio_of_sums(df: DataFrame, part: Column, whole: Column, keys: list[str], above: float) -> DataFrame:
    """1 - sum(part) / sum(whole) per key from whole-number columns, and whether it is above a limit."""
    sums = df.groupBy(*keys).agg(F.sum(part).alias("part"), F.sum(whole).alias("whole"))
    used = F.lit(1.0) - safe_divide(F.col("part").cast("double"), F.col("whole").cast("double"))
    return sums.withColumn("used_ratio", used).withColumn("breached", F.col("used_ratio") > above)


def top_groups(df: DataFrame, key: str, value: str, k: int = 10) -> DataFrame:
    """The k groups with the largest sum."""
    totals = df.groupBy(key).agg(from_units(F.sum(to_units(F.col(value)))).alias("total"))
    return totals.orderBy(F.desc("total"), key).limit(k)
