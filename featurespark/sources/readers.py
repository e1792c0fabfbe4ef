"""Raw streams and stored tables as frames with a ``json`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import Config


def kafka_options(config: Config, entity_type: str) -> dict[str, str]:
    """Options of the source of a topic: from the earliest offset where no checkpoint says otherwise."""
    return {
        "kafka.bootstrap.servers": config.kafka_servers,
        "subscribe": config.topic(entity_type),
        "startingOffsets": "earliest",
        "groupIdPrefix": config.kafka_groupId,
    }


#: Arrival order of Kafka records, across partitions too: by the record's time, then by offset (of which the low 20 bits count).
KAFKA_SEQ = "unix_millis(timestamp) * 1048576 + offset % 1048576"


def kafka(spark: SparkSession, config: Config, entity_type: str) -> DataFrame:
    """Stream of a topic's values: ``json, seq``."""
    stream = spark.readStream.format("kafka").options(**kafka_options(config, entity_type))
    return stream.load().selectExpr("CAST(value AS STRING) AS json", f"{KAFKA_SEQ} AS seq")


def text_stream(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """Stream of text files, a record for each line, in the order in which the files appear."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path).withColumnRenamed("value", "json")


def stored_text(spark: SparkSession, path: str) -> DataFrame:
    """Day-partitioned raw records: ``json, dt``; a filter on ``dt`` prunes folders."""
    return spark.read.schema("value string, dt string").text(path).withColumnRenamed("value", "json")
