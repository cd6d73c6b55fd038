"""Record contracts: ordered fields with a type, nullability and default, and the projections they imply."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.functions import cleaning

_STRUCT_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "array<string>": T.ArrayType(T.StringType()),
}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    nullable: bool = True
    default: object = None


@dataclass(frozen=True)
class Contract:
    subject: str
    schema_id: int
    fields: tuple[Field, ...]

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def required(self) -> list[str]:
        """Fields a record cannot be built without: not nullable and no declared default."""
        return [f.name for f in self.fields if not f.nullable and f.default is None]

    def only(self, names: list[str] | tuple[str, ...]) -> Contract:
        """The same contract cut to some fields, in contract order, so that a plan carries no unused ones."""
        return Contract(self.subject, self.schema_id, tuple(f for f in self.fields if f.name in names))

    def struct_type(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, _STRUCT_TYPES[f.kind], True) for f in self.fields])

    def conform(self, df: DataFrame, keep: tuple[str, ...] = (), clean: bool = False) -> DataFrame:
        """One projection to every contract field in order; ``keep`` names extra columns to carry along.

        ``clean`` is for text straight from a source: it trims, turns missing-value texts to NULL and
        reads numbers and flags leniently.
        """
        present = {c.lower(): (c, t) for c, t in df.dtypes}

        def column(field: Field) -> Column:
            if field.name.lower() not in present:
                return cleaning.default_literal(field.kind, field.nullable, field.default).alias(field.name)
            name, source = present[field.name.lower()]
            as_is = source == cleaning.SPARK_TYPES.get(field.kind, source) and not (clean and source == "string")
            if as_is and field.nullable:
                return F.col(name) if name == field.name else F.col(name).alias(field.name)
            raw = F.col(name)
            value = raw if as_is else cleaning.cast_typed(raw, source, field.kind)
            if clean and source == "string":
                value = cleaning.cast_text(raw, field.kind)
            return cleaning.fill_default(value, field.kind, field.nullable, field.default).alias(field.name)

        return df.select(*[column(f) for f in self.fields], *keep)

    def avro_schema(self) -> dict:
        """The same contract as an Avro record schema, for sessions that have the Avro package."""

        def avro_type(f: Field) -> object:
            base = {"type": "array", "items": "string"} if f.kind.startswith("array") else f.kind
            return ["null", base] if f.nullable else base

        fields = []
        for f in self.fields:
            entry: dict[str, object] = {"name": f.name, "type": avro_type(f)}
            if f.nullable or f.default is not None:
                entry["default"] = list(f.default) if isinstance(f.default, tuple) else f.default
            fields.append(entry)
        return {"type": "record", "name": self.subject.replace("-", "_"), "fields": fields}


def _need(kind: str, *names: str, default: object = None) -> list[Field]:
    return [Field(n, kind, False, default) for n in names]


def _may(kind: str, *names: str) -> list[Field]:
    return [Field(n, kind) for n in names]


def _numbered(prefix: str, first: int, last: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(first, last + 1)]


# Identity fields that hold text, and the feature subsets each stage keeps.
TEXT_IDENTITY_NUMBERS = (12, 15, 16, 28, 29, 30, 31, 33, 34, 35, 36, 37, 38)
VALIDATED_V = ("V258", "V257", "V201", "V200", *_numbered("V", 130, 137), *_numbered("V", 95, 102))
ENRICHED_C = ("C1", "C2", "C6", "C11", "C13", "C14")
ENRICHED_D = ("D1", "D2", "D3", "D10", "D15")
ENRICHED_V = ("V258", "V257", "V201", "V200", "V95", "V96", "V97", "V98", "V99")
RULE_NAMES = (
    "high_amount_new_uid",
    "anonymous_email_amount",
    "product_h_cnp",
    "velocity_breach",
    "night_foreign_email",
    "m_mismatch",
    "c13_spike",
    "v258_v257_threshold",
)


def _cards() -> list[Field]:
    return [
        *_may("double", "card1", "card2", "card3"),
        *_may("string", "card4"),
        *_may("double", "card5"),
        *_may("string", "card6"),
    ]


def _flags(flag_kind: str) -> list[Field]:
    return [Field(m, "string" if m == "M4" else flag_kind) for m in _numbered("M", 1, 9)]


def _identity(numbers: range | tuple[int, ...]) -> list[Field]:
    return [Field(f"id_{i:02d}", "string" if i in TEXT_IDENTITY_NUMBERS else "double") for i in numbers]


RAW = Contract(
    "transactions-raw",
    1,
    (
        *_need("string", "ingestion_id"),
        *_need("long", "kafka_offset"),
        *_need("int", "kafka_partition"),
        *_need("string", "ingested_at", "ingestion_date"),
        # wider than the declared int: the bronze table keeps this id as a long
        *_need("long", "TransactionID"),
        *_may("int", "isFraud"),
        *_need("long", "TransactionDT"),
        *_need("double", "TransactionAmt"),
        *_need("string", "ProductCD"),
        *_cards(),
        *_may("double", "addr1", "addr2", "dist1", "dist2"),
        *_may("string", "P_emaildomain", "R_emaildomain"),
        *_may("double", *_numbered("C", 1, 14), *_numbered("D", 1, 15)),
        *_flags("string"),
        *_may("double", *_numbered("V", 1, 339)),
        *_identity(range(1, 39)),
        *_may("string", "DeviceType", "DeviceInfo"),
    ),
)

VALIDATED = Contract(
    "transactions-validated",
    7,
    (
        *_need("string", "ingestion_id", "ingested_at", "transaction_date"),
        *_need("long", "TransactionID"),
        *_may("int", "isFraud"),
        *_need("long", "TransactionDT"),
        *_need("string", "event_timestamp"),
        *_need("int", "transaction_hour", "transaction_dow"),
        *_need("double", "TransactionAmt", "cent_amt"),
        *_need("string", "ProductCD"),
        *_cards(),
        *_may("string", "uid"),
        *_may("double", "addr1", "addr2", "dist1", "dist2"),
        *_may("string", "P_emaildomain", "R_emaildomain"),
        *_may("double", *_numbered("C", 1, 14), *_numbered("D", 1, 15)),
        *_flags("boolean"),
        *_may("double", *VALIDATED_V),
        *_need("boolean", "has_identity", default=False),
        *_identity((1, 2, 3, 4, 5, 6, 30, 31, 33)),
        *_may("string", "DeviceType", "DeviceInfo"),
        *_may("double", "p_email_risk_score"),
        *_may("boolean", "p_email_is_anonymous"),
        *_may("double", "r_email_risk_score"),
        *_may("string", "hour_risk_level"),
        *_may("double", "hour_risk_score"),
        *_may("string", "product_risk_tier"),
    ),
)

ENRICHED = Contract(
    "transactions-enriched",
    3,
    (
        *_need("string", "ingestion_id", "transaction_date"),
        *_need("long", "TransactionID"),
        *_may("string", "uid"),
        *_need("string", "event_timestamp"),
        *_need("int", "transaction_hour", "transaction_dow"),
        *_need("double", "TransactionAmt", "cent_amt"),
        *_need("string", "ProductCD"),
        *_may("string", "card4", "card6", "P_emaildomain", "R_emaildomain"),
        *_may("double", *ENRICHED_C, *ENRICHED_D, *ENRICHED_V),
        *_may("double", "spend_1min", "spend_5min", "spend_1hr", "spend_24hr"),
        *_may("int", "txn_count_1hr", "txn_count_24hr"),
        *_need("boolean", "velocity_flag", default=False),
        *_may("double", "p_email_risk_score"),
        *_may("boolean", "p_email_is_anonymous"),
        *_may("string", "hour_risk_level"),
        *_may("double", "hour_risk_score"),
        *_may("string", "product_risk_tier"),
        *_need("boolean", "has_identity", default=False),
        *_may("string", "DeviceType"),
        *_may("int", "isFraud"),
    ),
)

SCORES = Contract(
    "fraud-scores",
    4,
    (
        *_need("string", "ingestion_id", "scored_at", "transaction_date"),
        *_need("long", "TransactionID"),
        *_may("string", "uid"),
        *_need("double", "TransactionAmt"),
        *_need("string", "ProductCD"),
        *_may("string", "card4", "card6", "P_emaildomain"),
        *_need("int", "transaction_hour"),
        *_need("boolean", "has_identity"),
        *_may("string", "DeviceType"),
        *_need("double", "fraud_score"),
        *_need("string", "model_version"),
        *_need("double", *[f"rule_{r}" for r in RULE_NAMES], default=0.0),
        Field("rules_triggered", "array<string>", False, ()),
        *_may("double", "spend_1hr"),
        *_may("int", "txn_count_1hr"),
        *_need("boolean", "velocity_flag", default=False),
        *_may("int", "isFraud"),
    ),
)

DECISIONS = Contract(
    "fraud-decisions",
    5,
    (
        *_need("string", "ingestion_id", "decided_at", "transaction_date"),
        *_need("long", "TransactionID"),
        *_may("string", "uid"),
        *_need("double", "TransactionAmt"),
        *_need("string", "ProductCD"),
        *_may("string", "card4", "card6", "P_emaildomain"),
        *_need("int", "transaction_hour"),
        *_need("double", "fraud_score"),
        *_need("string", "decision", "decision_reason"),
        Field("rules_triggered", "array<string>", False, ()),
        *_need("double", "confidence"),
        *_need("string", "model_version"),
        *_need("double", *[f"score_{r}" for r in RULE_NAMES], default=0.0),
        *_may("int", "isFraud"),
    ),
)

AUDIT = Contract(
    "audit-trail",
    6,
    (
        *_need("string", "audit_id", "event_type", "event_timestamp", "transaction_date"),
        *_need("long", "TransactionID"),
        *_may("string", "uid"),
        *_need("double", "TransactionAmt"),
        *_need("string", "ProductCD"),
        *_may("double", "fraud_score"),
        *_may("string", "decision"),
        Field("rules_triggered", "array<string>", False, ()),
        *_may("string", "model_version"),
        *_may("int", "isFraud"),
        *_may("long", "pipeline_latency_ms"),
        *_need("string", "ingestion_id"),
    ),
)

CONTRACTS = (RAW, VALIDATED, ENRICHED, SCORES, DECISIONS, AUDIT)

# Allowed values of the enumerated fields.
ENUMS = {
    "decision": ("APPROVE", "REVIEW", "BLOCK"),
    "event_type": ("RECEIVED", "VALIDATED", "ENRICHED", "SCORED", "DECIDED"),
}


def by_subject(subject: str) -> Contract:
    return next(c for c in CONTRACTS if c.subject == subject)


def by_id(schema_id: int) -> Contract:
    return next(c for c in CONTRACTS if c.schema_id == schema_id)


def in_enum(field: str) -> Column:
    return F.col(field).isin(*ENUMS[field])


def project_map(data: Column, targets: list[tuple[str, str, str]]) -> list[Column]:
    """Columns from a ``map<string,string>``: (key, output name, type); a missing key or a bad cast is NULL."""
    return [F.try_element_at(data, F.lit(key)).try_cast(kind).alias(name) for key, name, kind in targets]


def with_lineage(df: DataFrame, run_ts: Column, source_file: str | Column, phase: str) -> DataFrame:
    """Ingestion columns; ``run_ts`` is passed in so that a re-run can repeat them. The source may be a column of the scan."""
    return df.withColumns(
        {
            "ingestion_id": F.uuid(),
            "ingested_at": run_ts,
            "ingestion_date": F.to_date(run_ts),
            "source_file": F.lit(source_file) if isinstance(source_file, str) else source_file,
            "pipeline_phase": F.lit(phase),
            "kafka_offset": F.lit(0).cast("bigint"),
            "kafka_partition": F.lit(0),
        }
    )
