"""One query for each operator over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..contract import ENTITY_TYPES, feature_names
from ..operators import features as fe
from ..operators.envelope import decode
from ..operators.records import day, records, typed_events
from ..operators.serving import deleted_scenes, entity_kv, entity_store, event_index, new_items, snapshot_kv
from ..operators.updates import events_of, updates
from ..sources import adapters
from ..sources.readers import stored_text, text_stream
from ..sources.sinks import append_days, scratch_folder, write_snapshots
from ..streaming.jobs import STATE_STORE, entity_table, kv_table, persist_raw, serving_items
from ..streaming.state import stream_features

#: Snapshot times: one after all events, one in their midst.
AS_OF = (1_707_000_000, 1_705_000_000)
TOP = 10
PRUNED_FROM = "2024-01-15"


def _rounded(df: DataFrame) -> DataFrame:
    """Sums of doubles depend on their order in the last bits, which rounding takes away; the mean follows the sum."""
    df = df.withColumn("event_value_sum", F.round("event_value_sum", 6))
    return df.withColumn("event_value_mean", F.col("event_value_sum") / F.col("event_count"))


def _updates(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return updates(adapters.events(spark, sf_dir), keep)


def _decoded(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    raw = {"event": adapters.event_json, "item": adapters.item_json, "user": adapters.user_json}[kind]
    return decode(raw(spark, sf_dir), kind)


def _features(kind: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        own = _updates(spark, sf_dir).filter(F.col("entity_type") == kind)
        return _rounded(fe.for_type(fe.entity_features(own), kind)).select("entity_id", "as_of_time", *feature_names(kind))

    return query


def features_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [_rounded(fe.entity_features(_updates(spark, sf_dir), t)) for t in AS_OF]
    return reduce(DataFrame.unionByName, parts)


def features_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fe.long_form(_rounded(fe.entity_features(_updates(spark, sf_dir))))


def running_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(fe.running_features(_updates(spark, sf_dir, "seq")))


def microbatch_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(fe.batch_features(_updates(spark, sf_dir, "seq", "day"), "day"))


def feature_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _updates(spark, sf_dir, "seq")


def _records(kind: str, *fields: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = records(_decoded(spark, sf_dir, kind), kind)
        return found.select("type", "row_key", "operation", "seq", *[F.get_json_object("json", f"$.{f}").alias(f) for f in fields])

    return query


def _partitions(kind: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return day(_decoded(spark, sf_dir, kind), kind, F.lit(0).cast("bigint")).select("seq", "dt")

    return query


def envelope_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode(adapters.event_envelopes(spark, sf_dir), "event")
    return decoded.select(
        "seq",
        F.col("message").isNotNull().alias("valid"),
        F.col("message.operation").alias("operation"),
        F.col("message.occurred_at").alias("occurred_at"),
        F.col("entity.userId").alias("user_id"),
        F.col("entity.itemId").alias("item_id"),
    )


def typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_events(adapters.event_json(spark, sf_dir))


def entity_store_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [entity_store(records(_decoded(spark, sf_dir, kind), kind)).select("type", "row_key", "seq") for kind in ENTITY_TYPES]
    return reduce(DataFrame.unionByName, parts)


def _kv(kind: str, *fields: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = entity_kv(_decoded(spark, sf_dir, kind), kind)
        return rows.select("key", "seq", *[F.get_json_object("value", f"$.{f}").alias(f) for f in fields])

    return query


def event_zset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_index(_decoded(spark, sf_dir, "event"))


def dislike_zset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_index(decode(adapters.event_json(spark, sf_dir, dislikes=True), "event"))


def new_items_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_items(_decoded(spark, sf_dir, "item"), TOP)


def item_delete_scene(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deleted_scenes(_decoded(spark, sf_dir, "item"))


def _written(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_folder(spark, "events")
    append_days(day(_decoded(spark, sf_dir, "event"), "event", F.lit(0).cast("bigint")), path)
    return path


def _by_day(df: DataFrame, *more: Column) -> DataFrame:
    return df.groupBy("dt").agg(F.count("*").alias("n"), *more)


def raw_append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = F.count_distinct(F.get_json_object("json", "$.userId")).alias("users")
    return _by_day(stored_text(spark, _written(spark, sf_dir)), users)


def partition_pruned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_day(stored_text(spark, _written(spark, sf_dir)).filter(F.col("dt") >= PRUNED_FROM))


def stream_features_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User features by the streaming state, over all events in four files as four micro-batches."""
    folder = scratch_folder(spark, "stream")
    raw = adapters.event_json(spark, sf_dir).repartitionByRange(4, "seq").sortWithinPartitions("seq")
    raw.select(F.col("json").alias("value")).write.text(f"{folder}/in")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    own = updates(events_of(decode(text_stream(spark, f"{folder}/in"), "event"))).filter("entity_type = 'user'")

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{folder}/out/batch_id={batch_id}")

    running = stream_features(own).writeStream.outputMode("update").option("checkpointLocation", f"{folder}/state")
    running.foreachBatch(store).trigger(availableNow=True).start().awaitTermination()
    last = spark.read.parquet(f"{folder}/out").groupBy("entity_id").agg(F.max_by(F.struct("as_of_time", "features"), "batch").alias("s"))
    columns = [F.col("s.features").getItem(n).alias(n) for n in feature_names("user")]
    return _rounded(last.select("entity_id", F.col("s.as_of_time").alias("as_of_time"), *columns))


def odd_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of both entity types over events with nulls and blanks."""
    return _rounded(fe.entity_features(updates(adapters.odd_events(spark, sf_dir))))


def odd_row_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(decode(adapters.odd_event_json(spark, sf_dir), "event"), "event").select("type", "row_key", "seq")


def odd_event_zset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_index(decode(adapters.odd_event_json(spark, sf_dir), "event"))


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fe.snapshots(fe.entity_features(_updates(spark, sf_dir)))


def _json_numbers(json: str, *names: str) -> list[Column]:
    return [F.get_json_object(json, f"$.features.{n}").cast("double").alias(n) for n in names]


def snapshot_kv_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshot_kv(_snapshots(spark, sf_dir))
    get = lambda path: F.get_json_object("value", path)
    return rows.select("key", get("$.entityType").alias("entity_type"), get("$.asOfTime").cast("bigint").alias("as_of_time"), *_json_numbers("value", *SNAPSHOT_NAMES))


def snapshot_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots as JSON lines in two batches, of which the first is written twice."""
    folder, rows = scratch_folder(spark, "snapshots"), _snapshots(spark, sf_dir)
    for batch in (0, 0, 1):
        write_snapshots(rows.filter(F.col("entity_type") == ("user", "item")[batch]), folder, batch)
    lines = spark.read.text(folder)
    return lines.select(F.get_json_object("value", "$.entityId").alias("entity_id"), "batch_id", *_json_numbers("value", *SNAPSHOT_NAMES))


def multi_sink_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item log through all its sinks in two batches, inserts and deletes, each written twice: stored keys, members and day files."""
    folder, items = scratch_folder(spark, "jobs"), adapters.item_json(spark, sf_dir)
    config = Config(kv_path=f"{folder}/kv", store_path=f"{folder}/store", hdfs_output=f"{folder}/out", redis_new_max_items=TOP)
    # by what they hold: from a million parts on, the numbers of inserts and deletes overlap
    deletes = F.col("json").contains('"operation":"DELETE"')
    for batch, part in enumerate((items.filter(~deletes), items.filter(deletes))):
        for _ in range(2):
            persist_raw(spark, part, batch, "item", config)
    kv = kv_table(spark, config, "item").read().select(F.lit("kv").alias("sink"), F.col("key").alias("name"), F.lit("").alias("member"))
    store = entity_table(spark, config, "item").read().select(F.lit("store"), "row_key", F.lit(""))
    index = serving_items(spark, config).select(F.lit("index"), "key", "member")
    raw = stored_text(spark, f"{config.hdfs_output}/hive/item")
    # items with an unreadable time are filed under the day of the run
    days = raw.filter(~F.col("json").contains('"modifyTime":"bad"')).groupBy("dt").count().select(F.lit("day"), "dt", F.col("count").cast("string"))
    return kv.union(store).union(index).union(days)


#: Features that the snapshot queries read back from JSON.
SNAPSHOT_NAMES = ("event_count", "event_last_time", "event_count_7d", "event_buy_count", "event_click_rate")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "user_features": _features("user"),
    "item_features": _features("item"),
    "features_as_of": features_as_of,
    "features_long": features_long,
    "running_snapshots": running_snapshots,
    "microbatch_snapshots": microbatch_snapshots,
    "feature_updates": feature_updates,
    "event_row_keys": _records("event"),
    "item_records": _records("item", "scene"),
    "user_records": _records("user", "registerTime"),
    "event_partitions": _partitions("event"),
    "item_partitions": _partitions("item"),
    "user_partitions": _partitions("user"),
    "envelope_decode": envelope_decode,
    "typed_projection": typed_projection,
    "entity_store_latest": entity_store_latest,
    "user_kv": _kv("user", "registerTime"),
    "item_kv": _kv("item", "scene", "title"),
    "event_zset": event_zset,
    "dislike_zset": dislike_zset,
    "new_items_topn": new_items_topn,
    "item_delete_scene": item_delete_scene,
    "raw_append_roundtrip": raw_append_roundtrip,
    "partition_pruned_read": partition_pruned_read,
    "stream_features": stream_features_query,
    "odd_features": odd_features,
    "odd_row_keys": odd_row_keys,
    "odd_event_zset": odd_event_zset,
    "snapshot_kv": snapshot_kv_query,
    "snapshot_files": snapshot_files,
    "multi_sink_batches": multi_sink_batches,
}
