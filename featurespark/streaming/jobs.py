"""The running jobs: one query for each raw stream, and one for the features."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..config import Config
from ..contract import ENTITY_TYPES
from ..functions.javasem import blank, parse_double
from ..operators.envelope import decode, is_delete
from ..operators.records import day, records
from ..operators.serving import deleted_scenes, event_index, snapshot_kv
from ..operators.updates import events_of, updates
from ..sources.readers import kafka
from ..sources.sinks import DeltaTable, append_days, write_snapshots
from .state import stream_features

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _ordered(batch: DataFrame, batch_id: int) -> DataFrame:
    """Give records without an arrival number one that grows with the batch."""
    if "seq" in batch.columns:
        return batch
    return batch.withColumn("seq", F.lit(batch_id << 40) + F.monotonically_increasing_id() % (1 << 40))


def _table(spark: SparkSession, path: str, keys: list[str], values: str) -> DeltaTable:
    return DeltaTable(spark, path, keys, values)


def kv_table(spark: SparkSession, config: Config, kind: str) -> DeltaTable:
    return _table(spark, f"{config.kv_path}/kv_{kind}", ["key"], "value string")


def index_table(spark: SparkSession, config: Config, entity_type: str) -> DeltaTable:
    return _table(spark, f"{config.kv_path}/zset_{entity_type}", ["key", "member"], "score double")


def entity_table(spark: SparkSession, config: Config, entity_type: str) -> DeltaTable:
    return _table(spark, f"{config.store_path}/{config.hbase_table_prefix}{entity_type}", ["row_key"], "json string")


def persist_raw(spark: SparkSession, batch: DataFrame, batch_id: int, entity_type: str, config: Config) -> None:
    """Write one micro-batch of raw records to every enabled sink.  Writing a batch again changes nothing.

    The batch is decoded once and kept while the sinks read it.  Where it looks at what is stored, it leaves out its own
    earlier attempt.
    """
    now = F.unix_millis(F.current_timestamp())
    decoded = day(decode(_ordered(batch, batch_id), entity_type), entity_type, now).persist()
    try:
        if config.hive_enabled:
            append_days(decoded, f"{config.hdfs_output}/hive/{entity_type}", batch_id)
        if config.hbase_enabled:
            changes = records(decoded, entity_type).withColumn("deleted", F.col("operation") == "DELETE")
            entity_table(spark, config, entity_type).merge(changes.select("row_key", "json", "seq", "deleted"), batch_id)
        index = index_table(spark, config, entity_type) if entity_type != "user" else None
        if entity_type == "event":
            scored = event_index(decoded).withColumns({"seq": F.lit(batch_id << 40), "deleted": F.lit(False)})
            index.merge(scored, batch_id)
            return
        kv = kv_table(spark, config, entity_type)
        if entity_type == "item":
            changes = _new_item_changes(kv, decoded, batch_id).persist()  # trimming reads them four times
            try:
                index.merge(_trimmed(index, changes, batch_id, config.redis_new_max_items), batch_id)
            finally:
                changes.unpersist()
        kv.merge(_kv_changes(decoded, entity_type), batch_id)
    finally:
        decoded.unpersist()


def _kv_changes(decoded: DataFrame, entity_type: str) -> DataFrame:
    return decoded.filter("entity.id is not null").select(
        F.concat(F.lit(f"{entity_type}:{{"), "entity.id", F.lit("}")).alias("key"),
        F.col("message.data_json").alias("value"),
        "seq",
        is_delete(F.col("message")).alias("deleted"),
    )


def _new_item_changes(kv: DeltaTable, decoded: DataFrame, batch_id: int) -> DataFrame:
    """Adds and removals in the scenes' sets; a delete without a scene looks up what was stored before the batch."""
    log = decoded.select("message", "entity", "seq").withColumn("_stored", F.lit(False))
    ids = decoded.filter("entity.id is not null").select(F.concat(F.lit("item:{"), "entity.id", F.lit("}")).alias("key"))
    stored = kv.read(batch_id, ids).select(F.col("value").alias("json"), "seq")
    log = decode(stored, "item").select("message", "entity", "seq").withColumn("_stored", F.lit(True)).unionByName(log)
    adds = log.filter("not _stored and entity.id is not null").filter(~is_delete(F.col("message")) & ~blank(F.col("entity.scene")))
    key = lambda scene: F.concat(F.lit("new:{"), F.col(scene), F.lit("}")).alias("key")
    adds = adds.select(key("entity.scene"), F.col("entity.id").alias("member"), parse_double(F.col("entity.pubTime")).alias("score"), "seq", F.lit(False).alias("deleted"))
    drops = deleted_scenes(log).filter("scene is not null")
    drops = drops.select(key("scene"), F.col("id").alias("member"), F.lit(0.0).alias("score"), "seq", F.lit(True).alias("deleted"))
    return adds.unionByName(drops)


def _trimmed(index: DeltaTable, changes: DataFrame, batch_id: int, most: int) -> DataFrame:
    """``changes`` with a removal for every member that they push out of its set's ``most`` largest; only sets of the batch are read.

    What is pushed out stays out, also when others are removed later.  The limit holds after each batch, not after each record.
    """
    if most <= 0:
        return changes
    stored = index.read(batch_id, changes.select("key")).withColumn("deleted", F.lit(False))
    last = index._last(stored.unionByName(changes)).filter("not deleted")
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.desc("member"))
    out = last.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") > most)
    return changes.unionByName(out.withColumn("deleted", F.lit(True)).withColumn("seq", F.col("seq") + 1).select(*changes.columns))


def serving_items(spark: SparkSession, config: Config) -> DataFrame:
    """The scenes' sets as served: at most ``redis_new_max_items`` items each, unless that is 0 or less."""
    return index_table(spark, config, "item").read().drop("seq")


def _triggered(writer: DataStreamWriter, config: Config) -> DataStreamWriter:
    return writer.trigger(processingTime=f"{config.checkpoint_interval_ms} milliseconds") if config.checkpoint_interval_ms > 0 else writer


def raw_writer(spark: SparkSession, stream: DataFrame, entity_type: str, config: Config) -> DataStreamWriter:
    writer = stream.writeStream.option("checkpointLocation", f"{config.checkpoint_path}/raw-{entity_type}")
    return writer.foreachBatch(lambda batch, i: persist_raw(spark, batch, i, entity_type, config))


def persist_snapshots(spark: SparkSession, batch: DataFrame, batch_id: int, config: Config) -> None:
    """Write a batch of snapshots as files and into the serving table, where an entity's last one counts."""
    batch = batch.persist()
    try:
        write_snapshots(batch, f"{config.hdfs_output}/features", batch_id)
        order = F.lit(batch_id << 40) + F.element_at("features", "event_count").cast("bigint")
        rows = snapshot_kv(batch, order.alias("seq")).withColumn("deleted", F.lit(False))
        kv_table(spark, config, "feature").merge(rows, batch_id)
    finally:
        batch.unpersist()


def feature_writer(spark: SparkSession, stream: DataFrame, config: Config) -> DataStreamWriter:
    """Features of a raw event stream; the session needs the settings of :func:`prepared`."""
    snapshots = stream_features(updates(events_of(decode(stream, "event"))), config.feature_every_update)
    writer = snapshots.writeStream.outputMode("update").option("checkpointLocation", f"{config.checkpoint_path}/features")
    return writer.foreachBatch(lambda batch, i: persist_snapshots(spark, batch, i, config))


def prepared(spark: SparkSession, config: Config) -> SparkSession:
    """The session with the settings that the jobs need: the state store, and their parallelism."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    spark.conf.set("spark.sql.shuffle.partitions", str(config.job_parallelism))
    return spark


def start(spark: SparkSession, config: Config, source: Callable[[SparkSession, Config, str], DataFrame] = kafka, **trigger) -> list[StreamingQuery]:
    """Start all four queries in a session of :func:`prepared`; the caller awaits them.

    They run a batch every ``checkpoint_interval_ms``, or as ``trigger`` says.
    """
    writers = [raw_writer(spark, source(spark, config, t), t, config) for t in ENTITY_TYPES]
    writers.append(feature_writer(spark, source(spark, config, "event"), config))
    return [(w.trigger(**trigger) if trigger else _triggered(w, config)).start() for w in writers]
