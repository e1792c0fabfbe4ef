"""Decode raw JSON records: mutation envelopes, bare records, and the typed entity inside."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import ALLOWED_OPERATIONS, DELETE, FIELDS, INSERT
from ..functions.javasem import strict_long

_ENVELOPE = "entityType string, operation string, occurredAt string, data string"


def _kind(json: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(F.try_parse_json(json), path, "variant"))


def message(json: Column, entity_type: str, operations: tuple[str, ...] = ALLOWED_OPERATIONS) -> Column:
    """Struct ``entity_type, operation, occurred_at, data_json`` of a record, or null if it is invalid.

    A JSON object without the key ``schemaVersion`` is a bare record: an insert of itself.  An envelope must
    name the expected type and an allowed operation and have the key ``data``; ``occurredAt`` may be
    absent, which counts as 0, but must be a number if it is there.
    """
    keys = F.json_object_keys(json)
    has = lambda k: F.array_contains(keys, k)
    envelope = F.from_json(json, _ENVELOPE)
    fraction = F.when(_kind(json, "$.occurredAt").rlike("^(DECIMAL|DOUBLE|FLOAT)"), envelope["occurredAt"].try_cast("double"))
    occurred = F.coalesce(strict_long(envelope["occurredAt"]), fraction.try_cast("bigint"))
    occurred = F.when(~has("occurredAt"), F.lit(0).cast("bigint")).otherwise(occurred)
    bare = F.struct(F.lit(entity_type).alias("entity_type"), F.lit(INSERT).alias("operation"), F.lit(0).cast("bigint").alias("occurred_at"), json.alias("data_json"))
    wrapped = F.struct(
        envelope["entityType"].alias("entity_type"),
        envelope["operation"].alias("operation"),
        occurred.alias("occurred_at"),
        F.get_json_object(json, "$.data").alias("data_json"),
    )
    valid = (envelope["entityType"] == entity_type) & has("data") & envelope["operation"].isin(*operations) & occurred.isNotNull()
    return F.when(keys.isNull(), None).when(~has("schemaVersion"), bare).when(valid, wrapped)


def entity(data_json: Column, entity_type: str) -> Column:
    """The certain fields of an entity as strings; null unless the text is an object with scalars in them."""
    names = FIELDS[entity_type]
    parsed = F.from_json(data_json, ", ".join(f"`{n}` string" for n in names))
    nested = [F.when(parsed[n].rlike(r"\A[\[{]"), _kind(data_json, f"$.{n}").rlike("^(OBJECT|ARRAY)")).otherwise(False) for n in names]
    wrong = reduce(lambda a, b: a | b, [F.coalesce(x, F.lit(False)) for x in nested])
    return F.when(F.json_object_keys(data_json).isNotNull() & ~wrong, parsed)


def decode(raw: DataFrame, entity_type: str, json: str = "json", operations: tuple[str, ...] = ALLOWED_OPERATIONS) -> DataFrame:
    """Add ``message`` and ``entity`` structs to the raw records; both are null where the record is invalid.

    Each struct comes out of a one-element ``explode``: what stands above then reads it as a column, where a
    plain projection would be merged into every expression that uses it, over and over.
    """
    decoded = raw.withColumn("message", F.explode(F.array(message(F.col(json), entity_type, operations))))
    data = F.col("message.data_json")
    # a quoted JSON text as data is a string, not an object
    object_data = ~F.array_contains(F.json_object_keys(json), "schemaVersion") | _kind(F.col(json), "$.data").startswith("OBJECT")
    return decoded.withColumn("entity", F.explode(F.array(F.when(object_data, entity(data, entity_type)))))


def is_delete(message: Column) -> Column:
    return message["operation"] == DELETE
