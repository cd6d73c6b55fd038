"""Reading messages by the contract they were written with: the frame's id picks the writer, a reader contract the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.functions import cleaning, wire
from tallywatch.operators.contracts import Contract, Field

NOT_FRAMED = "not_framed"
UNKNOWN = "unknown_schema"
UNRESOLVABLE = "unresolvable"
UNREADABLE = "unreadable"

#: Writer kinds that a reader kind takes without a chance of loss; others are cast, and NULL where that fails.
PROMOTIONS = {"long": ("int",), "double": ("int", "long"), "string": ("int", "long", "double", "boolean")}


def written_as(field: Field, writer: Contract, aliases: dict[str, tuple[str, ...]]) -> Field | None:
    """The writer's field for a reader's one: of the same name, or else the first of its former names."""
    by_name = {f.name.lower(): f for f in writer.fields}
    return next((by_name[n.lower()] for n in (field.name, *aliases.get(field.name, ())) if n.lower() in by_name), None)


def unresolvable(reader: Contract, writer: Contract, aliases: dict[str, tuple[str, ...]]) -> list[str]:
    """Required fields of the reader that the writer never had: no message of that writer can be read."""
    return [f.name for f in reader.fields if f.name in reader.required and written_as(f, writer, aliases) is None]


def resolve(record: Column, reader: Contract, writer: Contract, aliases: dict[str, tuple[str, ...]]) -> Column:
    """A writer's record as the reader's: promoted or cast by field, defaults for what is missing, the writer's extras left out."""

    def column(field: Field) -> Column:
        source = written_as(field, writer, aliases)
        if source is None:
            return cleaning.default_literal(field.kind, field.nullable, field.default).alias(field.name)
        value = record[source.name]
        if source.kind != field.kind:
            kind = cleaning.SPARK_TYPES[field.kind]
            value = value.cast(kind) if source.kind in PROMOTIONS.get(field.kind, ()) else value.try_cast(kind)
        return cleaning.fill_default(value, field.kind, field.nullable, field.default).alias(field.name)

    return F.struct(*[column(f) for f in reader.fields])


def decode_by_id(
    df: DataFrame,
    reader: Contract,
    writers: tuple[Contract, ...],
    aliases: dict[str, tuple[str, ...]] | None = None,
    keep: tuple[str, ...] = ("offset",),
) -> DataFrame:
    """``keep``, ``schema_id``, ``reason`` and the reader's fields for every framed ``value``.

    ``reason`` is NULL where the message was read, else why not: no frame, an id without a contract, a contract that lacks a required
    field, or a body that is not a record of its contract. A body is parsed once, by the contract of its own id.
    """
    aliases = aliases or {}
    sid, body = wire.schema_id(F.col("value")), wire.body(F.col("value"))
    lacking = {w.schema_id: unresolvable(reader, w, aliases) for w in writers}
    usable = [w for w in writers if not lacking[w.schema_id]]

    def read(writer: Contract) -> Column:
        bodies = wire.readable_bodies(F.when(sid == writer.schema_id, body), writer.struct_type())
        return F.coalesce(F.transform(bodies, lambda r: resolve(r, reader, writer, aliases)), F.array())

    opened = df.select(*keep, sid.alias("schema_id"), F.posexplode_outer(F.concat(*map(read, usable))).alias("_found", "_record"))
    known = F.col("schema_id").isin([w.schema_id for w in writers])
    reason = F.when(F.col("schema_id").isNull(), NOT_FRAMED).when(~known, F.concat(F.lit(UNKNOWN + ":"), F.col("schema_id").cast("string")))
    for k, names in lacking.items():
        if names:
            reason = reason.when(F.col("schema_id") == k, f"{UNRESOLVABLE}:{names[0]}")
    reason = reason.when(F.col("_found").isNull(), UNREADABLE)
    return opened.select(*keep, "schema_id", reason.alias("reason"), *[F.col(f"_record.{n}").alias(n) for n in reader.names])
