"""One event makes two keyed updates: one for its user, one for its item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contract import UPDATE_COLUMNS
from ..functions.javasem import blank, parse_double, parse_long


def updates(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Updates of complete events (``userId, itemId, scene, type, value, time``), with columns ``keep`` carried along."""
    side = lambda kind, own, other: F.struct(F.lit(kind).alias("t"), F.col(own).alias("i"), F.col(other).alias("c"))
    both = events.filter(~blank(F.col("userId")) & ~blank(F.col("itemId"))).withColumn(
        "_side", F.explode(F.array(side("user", "userId", "itemId"), side("item", "itemId", "userId")))
    )
    return both.select(
        F.col("_side.t").alias("entity_type"),
        F.col("_side.i").alias("entity_id"),
        F.col("_side.c").alias("counterpart_id"),
        "scene",
        F.col("type").alias("event_type"),
        parse_double(F.col("value")).alias("value"),
        parse_long(F.col("time")).alias("event_time"),
        *keep,
    ).select(*UPDATE_COLUMNS, *keep)


def events_of(decoded: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Event columns of decoded records.  A DELETE envelope of an event still counts as its event."""
    return decoded.filter("entity is not null").select("entity.*", *keep)
