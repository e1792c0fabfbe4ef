"""Serving projections: the latest value for each key, and scored member sets.

The logs are replayed by ``seq``: for each key (or key and member) the operation with the largest one
counts.  That is an aggregate with partial sums, so a key with a large share of the log is not gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dislike import dislike_rules
from ..functions.javasem import blank, parse_double
from .envelope import is_delete

TOP_ITEMS = 10_000


def _latest(log: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The last row for each key."""
    rest = [c for c in log.columns if c not in keys]
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), seq).alias("_row"))
    return last.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def entity_kv(decoded: DataFrame, entity_type: str, seq: str = "seq") -> DataFrame:
    """``key, value, seq`` of stored users or items: ``user:{id}`` and the last JSON; deleted keys are absent.

    An id that is blank but not null is a key.
    """
    log = decoded.filter(F.col("entity.id").isNotNull()).select(
        F.concat(F.lit(f"{entity_type}:{{"), "entity.id", F.lit("}")).alias("key"),
        F.col("message.data_json").alias("value"),
        is_delete(F.col("message")).alias("deleted"),
        seq,
    )
    return _latest(log, ["key"], seq).filter("not deleted").drop("deleted")


def deleted_scenes(items: DataFrame, seq: str = "seq") -> DataFrame:
    """``id, scene, seq`` of item deletes: the scene in the delete's payload, else that of the item as stored then.

    ``scene`` is null if neither has one; an item that was deleted before is not stored.
    """
    log = items.filter(F.col("entity.id").isNotNull()).select(
        F.col("entity.id").alias("id"), F.col("entity.scene").alias("scene"), is_delete(F.col("message")).alias("deleted"), seq
    )
    before = F.lag(F.struct("deleted", "scene")).over(Window.partitionBy("id").orderBy(seq))
    stored = log.withColumn("_before", before).filter("deleted")
    scene = F.coalesce("scene", F.when(~F.col("_before.deleted"), F.col("_before.scene")))
    return stored.select("id", scene.alias("scene"), seq)


def top_members(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The ``most`` members with the largest (score, member) of each set; all of them for 0 or less."""
    if most <= 0:
        return rows
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("member"))
    return rows.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= most).drop("_rank")


def new_items(items: DataFrame, most: int = TOP_ITEMS, seq: str = "seq") -> DataFrame:
    """``key, member, score`` of the newest items of each scene, ``new:{scene}`` by publication time.

    An item that moves to another scene stays in the old one.  ``most`` items with the largest (score, member) are
    kept; 0 or less keeps all.  Exact where scores don't fall and deletes don't reach trimmed items.
    """
    adds = items.filter(F.col("entity.id").isNotNull() & ~is_delete(F.col("message")) & ~blank(F.col("entity.scene"))).select(
        F.col("entity.scene").alias("scene"), F.col("entity.id").alias("member"), parse_double(F.col("entity.pubTime")).alias("score"), seq
    )
    drops = deleted_scenes(items, seq).filter("scene is not null")
    drops = drops.select("scene", F.col("id").alias("member"), F.lit(None).cast("double").alias("score"), seq)
    kept = _latest(adds.unionByName(drops), ["scene", "member"], seq).filter("score is not null")
    return top_members(kept, ["scene"], most).select(F.concat(F.lit("new:{"), "scene", F.lit("}")).alias("key"), "member", "score")


def _event_key() -> Column:
    text = lambda name: F.coalesce(f"entity.{name}", F.lit("null"))
    return F.concat(F.lit("event:{"), "entity.userId", F.lit("}:"), text("scene"), F.lit(":"), text("type"))


def event_index(events: DataFrame, seq: str = "seq") -> DataFrame:
    """``key, member, score``: items by time under each user, scene and type; dislikes by the rules of their value.

    The last write of a member counts, even with a smaller score, and deletes of events are no different
    from events.
    """
    own = F.array("entity.itemId")
    member = F.when(F.lower("entity.type") == "dislike", dislike_rules(F.col("entity.value"))).otherwise(own)
    complete = events.filter(F.col("entity.userId").isNotNull() & F.col("entity.itemId").isNotNull())
    log = complete.select(
        _event_key().alias("key"), F.posexplode(member).alias("_at", "member"), parse_double(F.col("entity.time")).alias("score"), seq
    ).drop("_at")
    return _latest(log, ["key", "member"], seq).drop(seq)


def snapshot_kv(snapshots: DataFrame, *more: Column) -> DataFrame:
    """``key, value``: each entity's snapshot as JSON under ``feature:<type>:{<id>}``, and the columns ``more``."""
    value = F.to_json(
        F.struct(F.col("entity_type").alias("entityType"), F.col("entity_id").alias("entityId"), F.col("as_of_time").alias("asOfTime"), "features")
    )
    key = F.concat(F.lit("feature:"), "entity_type", F.lit(":{"), "entity_id", F.lit("}"))
    return snapshots.select(key.alias("key"), value.alias("value"), *more)


def entity_store(records: DataFrame, seq: str = "seq") -> DataFrame:
    """``type, row_key, json, seq``: the last record of each row key, without those deleted last."""
    last = _latest(records.select("type", "row_key", "json", "operation", seq), ["type", "row_key"], seq)
    return last.filter("operation <> 'DELETE'").drop("operation")
