"""Composite score, decision and audit event of an enriched record."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.numbers import clamp, half_up
from tallywatch.functions.rules import MODEL_VERSION, RULES
from tallywatch.operators import contracts

# Decision thresholds and reasons.
REVIEW_FROM = 35
BLOCK_FROM = 65
REASONS = {"APPROVE": "Low fraud score", "REVIEW": "Medium fraud risk", "BLOCK": "High fraud risk"}


def composite(scores: dict[str, Column]) -> Column:
    """Weighted sum in rule order, clamped to 0..100 and rounded to cents."""
    terms = [scores[r.column] * F.lit(r.weight) for r in RULES]
    return half_up(clamp(reduce(lambda a, b: a + b, terms), 0.0, 100.0), 2)


def triggered(scores: dict[str, Column]) -> Column:
    """Names of the rules with a positive score, in rule order."""
    names = F.array(*[F.when(value > 0, F.lit(name)) for name, value in scores.items()])
    return F.filter(names, lambda n: n.isNotNull())


def score(df: DataFrame, scored_at: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Enriched rows to score records."""
    raw = df.withColumns({f"_{r.column}": r.score() for r in RULES})
    parts = {r.column: F.col(f"_{r.column}") for r in RULES}
    named = raw.withColumns(
        {
            "scored_at": scored_at.cast("string"),
            "model_version": F.lit(MODEL_VERSION),
            "fraud_score": composite(parts),
            "rules_triggered": triggered(parts),
            **{r.column: half_up(parts[r.column], 2) for r in RULES},
        }
    )
    return contracts.SCORES.conform(named, keep=keep)


def decision(score_column: Column) -> Column:
    return F.when(score_column < REVIEW_FROM, "APPROVE").when(score_column < BLOCK_FROM, "REVIEW").otherwise("BLOCK")


def decision_reason(decision_column: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in REASONS.items() for x in pair]), decision_column)


def confidence(score_column: Column) -> Column:
    return half_up(clamp(score_column / F.lit(100.0), 0.5, 1.0), 2)


def decide(df: DataFrame, decided_at: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Score records to decision records; rule_* become score_*, NULL as 0."""
    total = F.col("fraud_score")
    named = df.withColumns(
        {
            "decided_at": decided_at.cast("string"),
            "decision": decision(total),
            "confidence": confidence(total),
            "model_version": F.lit(MODEL_VERSION),
            **{f"score_{r.name}": F.coalesce(F.col(r.column), F.lit(0.0)) for r in RULES},
        }
    ).withColumn("decision_reason", decision_reason(F.col("decision")))
    return contracts.DECISIONS.conform(named, keep=keep)


def audit(decisions: DataFrame, event_at: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """One DECIDED event per decision; latency is not measured and stays NULL."""
    named = decisions.withColumns(
        {
            "audit_id": F.uuid(),
            "event_type": F.lit("DECIDED"),
            "event_timestamp": event_at.cast("string"),
            "pipeline_latency_ms": F.lit(None).cast("bigint"),
        }
    )
    return contracts.AUDIT.conform(named, keep=keep)


def rules_as_text(column: Column) -> Column:
    """Array of names as one text, for a string column of a table."""
    return F.array_join(column, ",")
