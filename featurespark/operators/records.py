"""Validated entity records with their row keys, and the day that a raw record belongs to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.javasem import blank, epoch_millis, first_filled, utc_day
from .envelope import is_delete


def row_key(entity: Column, entity_type: str) -> Column:
    """Stable key: the id, or for events the trace id, else ``time#user#item#scene#type``."""
    if entity_type != "event":
        return F.when(~blank(entity["id"]), entity["id"])
    part = lambda name: F.coalesce(entity[name], F.lit(""))
    derived = F.concat_ws("#", part("time"), entity["userId"], entity["itemId"], part("scene"), part("type"))
    complete = ~blank(entity["userId"]) & ~blank(entity["itemId"])
    return F.when(complete, F.when(blank(entity["traceId"]), derived).otherwise(entity["traceId"]))


def records(decoded: DataFrame, entity_type: str) -> DataFrame:
    """``type, row_key, json, operation`` of complete entities, with any other columns of the input kept."""
    key = row_key(F.col("entity"), entity_type)
    kept = decoded.withColumn("row_key", key).filter("row_key is not null")
    columns = [F.lit(entity_type).alias("type"), "row_key", F.col("message.data_json").alias("json"), F.col("message.operation").alias("operation")]
    others = [c for c in decoded.columns if c not in ("json", "message", "entity")]
    return kept.select(*columns, *others)


def day(decoded: DataFrame, entity_type: str, now_millis: Column) -> DataFrame:
    """Add ``dt``: the UTC day of the business time; of ``now_millis`` if there is none, or for a delete of its own time."""
    e, m = F.col("entity"), F.col("message")
    if entity_type == "event":
        text = e["time"]
    elif entity_type == "item":
        text = first_filled(e["modifyTime"], e["pubTime"])
    else:
        text = first_filled(e["loginTime"], e["registerTime"])
    fallback = F.when(is_delete(m) & (m["occurred_at"] > 0), m["occurred_at"]).otherwise(now_millis)
    return decoded.withColumn("dt", utc_day(epoch_millis(text, fallback)))


def typed_events(raw: DataFrame) -> DataFrame:
    """Schema-on-read projection of stored event records: ``user_id, item_id, event_type, event_time``."""
    get = lambda path: F.get_json_object("json", path)
    return raw.select(
        get("$.userId").alias("user_id"),
        get("$.itemId").alias("item_id"),
        get("$.type").alias("event_type"),
        get("$.time").try_cast("bigint").alias("event_time"),
    )
