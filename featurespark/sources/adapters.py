"""Contract records from the test tables, by fixed expressions that the SQL mirrors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _seconds(ts: Column) -> Column:
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(1_000_000)).cast("bigint")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event columns as strings, with ``seq`` the event id and ``day`` the UTC date."""
    kind = F.col("event_type")
    action = (
        F.when(kind == "view", "expose")
        .when(kind == "purchase", "buy")
        .when(kind == "signup", "collect")
        .when((kind == "error") & (F.col("event_id") % 2 == 0), "stay")
        .otherwise(kind)
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("userId"),
        F.get_json_object("props", "$.k").alias("itemId"),
        F.concat(F.lit("s"), (F.col("event_id") % 7).cast("string")).alias("scene"),
        action.alias("type"),
        F.col("value").cast("string").alias("value"),
        _seconds(F.col("ts")).cast("string").alias("time"),
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("trace-"), F.col("event_id").cast("string"))).alias("traceId"),
        F.col("event_id").alias("seq"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
    )


def event_json(spark: SparkSession, sf_dir: str, dislikes: bool = False) -> DataFrame:
    """``json, seq``: bare event records; errors with an odd id are dislikes, if asked."""
    rows = events(spark, sf_dir)
    if dislikes:
        rows = rows.filter("type = 'error'")
        tag = F.concat(F.lit("t"), (F.col("seq") % 3).cast("string"))
        value = F.to_json(
            F.struct(
                F.col("itemId").alias("id"),
                F.concat(F.lit("c"), (F.col("seq") % 5).cast("string")).alias("category"),
                F.array(tag, F.concat(F.lit(" "), tag, F.lit(" ")), F.lit("")).alias("tags"),
            )
        )
        rows = rows.withColumns({"type": F.lit("dislike"), "value": value})
    names = ["userId", "itemId", "scene", "type", "value", "time", "traceId"]
    return rows.select(F.to_json(F.struct(*names)).alias("json"), "seq")


def item_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``json, seq``: bare items from ``part``, and DELETE envelopes for every eleventh of them later on."""
    key = F.col("p_partkey")
    published = F.lit(1_700_000_000) + key * 3_600
    modified = F.when(key % 7 == 0, "bad").when(key % 5 == 0, "")
    item = F.struct(
        key.cast("string").alias("id"),
        F.col("p_brand").alias("scene"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("category"),
        F.when(key % 3 == 0, published * 1_000).otherwise(published).cast("string").alias("pubTime"),
        modified.alias("modifyTime"),
    )
    parts = table(spark, sf_dir, "part")
    inserts = parts.select(F.to_json(item).alias("json"), key.alias("seq"))
    scene = F.when(key % 2 == 1, F.col("p_brand"))
    envelope = F.struct(
        F.lit(1).alias("schemaVersion"),
        F.lit("item").alias("entityType"),
        F.lit("DELETE").alias("operation"),
        (F.lit(1_700_000_000_000) + key).alias("occurredAt"),
        F.struct(key.cast("string").alias("id"), scene.alias("scene")).alias("data"),
    )
    deletes = parts.filter(key % 11 == 0).select(F.to_json(envelope).alias("json"), (key + 1_000_000).alias("seq"))
    return inserts.unionByName(deletes)


def user_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``json, seq``: bare users from ``customer``, with the first and last of their orders as times."""
    key = F.col("c_custkey")
    spans = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    rows = table(spark, sf_dir, "customer").join(spans, key == F.col("o_custkey"), "left")
    user = F.struct(
        key.cast("string").alias("id"),
        F.when(key % 4 == 0, "").otherwise(_seconds(F.col("last")).cast("string")).alias("loginTime"),
        _seconds(F.col("first")).cast("string").alias("registerTime"),
        F.col("c_mktsegment").alias("tags"),
    )
    return rows.select(F.to_json(user).alias("json"), key.alias("seq"))


def event_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``json, seq``: event records in every form that decoding tells apart, by the id modulo 10."""
    n = F.col("seq") % 10
    data = F.struct("userId", "itemId", "scene", "type", "time")
    version = F.when(n > 0, 1)
    wrapped = F.struct(
        version.alias("schemaVersion"),
        F.when(n == 1, "item").otherwise("event").alias("entityType"),
        F.when(n == 2, "UPSERT").when(n == 3, "DELETE").otherwise("INSERT").alias("operation"),
        F.when(n == 4, F.lit("soon")).when(n != 5, F.concat(F.lit("17"), F.col("time"))).alias("occurredAt"),
        F.when(n != 6, data).alias("data"),
    )
    bare = F.to_json(data)
    broken = F.when(n == 7, F.lit("{bad")).when(n == 8, F.lit("[1]"))
    json = F.when(n == 0, bare).otherwise(F.coalesce(broken, F.to_json(wrapped)))
    return events(spark, sf_dir).select(json.alias("json"), "seq")


def odd_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with nulls and blanks: no scene for every fourth, no type for every fifth, a blank user or item for some, no item for others."""
    n = F.col("seq")
    return events(spark, sf_dir).withColumns(
        {
            "scene": F.when(n % 4 != 0, F.col("scene")),
            "type": F.when(n % 5 != 0, F.col("type")),
            "userId": F.when(n % 6 == 0, " \t").otherwise(F.col("userId")),
            "itemId": F.when(n % 9 == 0, None).when(n % 10 == 0, "").otherwise(F.col("itemId")),
            "value": F.when(n % 11 == 0, " x").otherwise(F.col("value")),
        }
    )


def odd_event_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``json, seq``: bare records of :func:`odd_events`; null fields are absent."""
    names = ["userId", "itemId", "scene", "type", "value", "time", "traceId"]
    return odd_events(spark, sf_dir).select(F.to_json(F.struct(*names)).alias("json"), "seq")
