"""The four stages of the decision path on a stream, chained through logs or fused into one query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.functions import features
from tallywatch.operators import contracts, scoring, validation
from tallywatch.operators.contracts import Contract
from tallywatch.operators.enrichment import attach_dimensions
from tallywatch.plans.decisioning import FOR_ENRICHMENT, Dimensions, with_event_us
from tallywatch.plans.inputs import MESSAGE_SCHEMA
from tallywatch.sources import filelog
from tallywatch.streaming import sinks
from tallywatch.streaming.stateful import velocity_on_stream

REASON = "reject_reason"
CARRIED = ("offset", REASON)
FILES_PER_TRIGGER = None  # a count of files in place of the limit in bytes


def stage_path(root: str, name: str) -> str:
    return f"{root}/{name}"


def dead_letter_path(root: str, subject: str) -> str:
    return f"{root}/{subject}-dlq"


def late_path(root: str) -> str:
    """Records more than a day behind their key's newest: enriched ones of the chain, decided ones of the fused query."""
    return f"{root}/late"


def read_log(spark: SparkSession, path: str, files_per_trigger: int | None = FILES_PER_TRIGGER) -> DataFrame:
    return filelog.read_stream(spark, path, MESSAGE_SCHEMA, files_per_trigger)


# --- transformations ------------------------------------------------------------------------


def validate_messages(messages: DataFrame, contract: Contract = contracts.VALIDATED) -> DataFrame:
    """Raw messages to validated records plus offset and reject reason; rejected rows stay in."""
    read = (*validation.CHECKED_FIELDS, *features.IDENTITY_FIELDS, *contract.names)
    decoded = validation.decode_log(messages, contracts.RAW.only(read))
    return validation.build_validated(validation.with_reject_reason(decoded), keep=CARRIED, contract=contract)


def checked(messages: DataFrame, contract: Contract, label: str) -> DataFrame:
    """Messages of a later stage to contract columns plus offset and reject reason."""
    decoded = validation.decode_log(messages, contract)
    return decoded.withColumn(REASON, validation.missing_required(contract, label))


def enrich_stream(validated: DataFrame, dims: Dimensions) -> DataFrame:
    """Validated records (with offset and reject reason) to enriched ones, with state per uid."""
    wanted = [c for c in validated.columns if c in contracts.ENRICHED.names or c in (*CARRIED, "TransactionDT")]
    fast = velocity_on_stream(with_event_us(validated.select(*wanted)), rejected=REASON)
    return contracts.ENRICHED.conform(attach_dimensions(fast, *dims), keep=(*CARRIED, "is_late"))


def _good(contract: Contract, late: bool = False):
    """Accepted rows as messages: those on time, or those that are late."""

    def messages(df: DataFrame) -> DataFrame:
        rows = validation.accepted(df)
        if "is_late" in df.columns:
            rows = rows.filter(F.col("is_late") if late else ~F.col("is_late"))
        return validation.to_messages(rows, contract, keep=(F.lit(None).cast("int").alias("partition"), "offset"))

    return messages


def _bad(stage: str, key: str | None):
    return lambda df: validation.dead_letters(df, stage, key=key)


# --- four chained queries -------------------------------------------------------------------


def run_validation(spark: SparkSession, root: str, source: str) -> None:
    sinks.drain_batches(
        validate_messages(read_log(spark, source)),
        stage_path(root, "checkpoints/validation"),
        sinks.fan_out(
            {
                stage_path(root, contracts.VALIDATED.subject): _good(contracts.VALIDATED),
                dead_letter_path(root, contracts.RAW.subject): _bad("validation", None),
            }
        ),
    )


def run_enrichment(spark: SparkSession, root: str, dims: Dimensions) -> None:
    source = checked(read_log(spark, stage_path(root, contracts.VALIDATED.subject)), contracts.VALIDATED, "enrich_error")
    sinks.drain_batches(
        enrich_stream(source, dims),
        stage_path(root, "checkpoints/enrichment"),
        sinks.fan_out(
            {
                stage_path(root, contracts.ENRICHED.subject): _good(contracts.ENRICHED),
                late_path(root): _good(contracts.ENRICHED, late=True),
                dead_letter_path(root, contracts.VALIDATED.subject): _bad("enrichment", "enrich_error"),
            }
        ),
    )


def run_scoring(spark: SparkSession, root: str, at: Column) -> None:
    source = checked(read_log(spark, stage_path(root, contracts.ENRICHED.subject)), contracts.ENRICHED, "score_error")
    sinks.drain_batches(
        scoring.score(source, at, keep=CARRIED),
        stage_path(root, "checkpoints/scoring"),
        sinks.fan_out(
            {
                stage_path(root, contracts.SCORES.subject): _good(contracts.SCORES),
                dead_letter_path(root, contracts.ENRICHED.subject): _bad("scoring", "score_error"),
            }
        ),
    )


def decision_outputs(root: str, at: Column, stage: str, key: str | None) -> dict:
    """The outputs of a decided batch: decisions, audit events, dead letters, and late records of the fused query."""
    late = {late_path(root): _good(contracts.DECISIONS, late=True)} if stage == "fused" else {}
    return late | {
        stage_path(root, contracts.DECISIONS.subject): _good(contracts.DECISIONS),
        stage_path(root, contracts.AUDIT.subject): lambda df: _good(contracts.AUDIT)(
            scoring.audit(df, at, keep=[c for c in (*CARRIED, "is_late") if c in df.columns])
        ),
        dead_letter_path(root, contracts.DECISIONS.subject): _bad(stage, key),
    }


def run_decision(spark: SparkSession, root: str, at: Column, source: str | None = None) -> None:
    log = source or stage_path(root, contracts.SCORES.subject)
    scored = checked(read_log(spark, log), contracts.SCORES, "decision_error")
    sinks.drain_batches(
        scoring.decide(scored, at, keep=CARRIED),
        stage_path(root, "checkpoints/decision"),
        sinks.fan_out(decision_outputs(root, at, "decision", "decision_error")),
    )


def run_chain(spark: SparkSession, root: str, source: str, dims: Dimensions, at: Column) -> None:
    """All four stages over what is available now, each from its own checkpoint."""
    run_validation(spark, root, source)
    run_enrichment(spark, root, dims)
    run_scoring(spark, root, at)
    run_decision(spark, root, at)


# --- one fused query ------------------------------------------------------------------------


def fused(messages: DataFrame, dims: Dimensions, at: Column) -> DataFrame:
    """Raw messages to decisions in one plan; rejected rows carry their reason to the end."""
    enriched = enrich_stream(validate_messages(messages, FOR_ENRICHMENT), dims)
    carried = (*CARRIED, "is_late")
    return scoring.decide(scoring.score(enriched, at, keep=carried), at, keep=carried)


def run_fused(
    spark: SparkSession, root: str, source: str, dims: Dimensions, at: Column, files_per_trigger: int | None = FILES_PER_TRIGGER
) -> None:
    sinks.drain_batches(
        fused(read_log(spark, source, files_per_trigger), dims, at),
        stage_path(root, "checkpoints/fused"),
        sinks.fan_out(decision_outputs(root, at, "fused", None)),
    )
