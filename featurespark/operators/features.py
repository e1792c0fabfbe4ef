"""The eighteen behavioural features of each user and item, as batch plans.

Let ``last`` be the latest event time of an entity, never below 0.  State older than ``last - 30 days`` is
pruned, so an N-day count as of ``t`` holds the events from ``max(t - N days, last - 30 days)`` on,
with no upper bound; all other features cover all events.  The result doesn't depend on arrival order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contract import ACTIONS, COUNTERPART, DAY, WINDOWS, feature_names

KEY = ["entity_type", "entity_id"]
_COUNTERPART = "event_counterpart_count"


def _double(column: Column) -> Column:
    return column.cast("double")


def _rate(clicks: Column, exposes: Column) -> Column:
    return F.when(clicks + exposes == 0, 0.0).otherwise(clicks / F.greatest(clicks + exposes, F.lit(1.0)))


def _last(column: Column) -> Column:
    return F.greatest(F.lit(0).cast("bigint"), column)


def entity_features(updates: DataFrame, as_of: int | None = None) -> DataFrame:
    """One row for each entity: ``entity_type, entity_id, as_of_time`` and the features.

    Both passes aggregate before they shuffle, and distinct values are counted by partial aggregation too, so an
    entity with a large share of all events is not gathered in one task.
    """
    totals = updates.groupBy(*KEY).agg(
        _double(F.count("*")).alias("event_count"),
        F.sum("value").alias("event_value_sum"),
        _double(F.count_distinct(F.expr(f"event_time div {DAY}"))).alias("event_active_days"),
        _double(F.count_distinct("scene")).alias("event_unique_scene_count"),
        _double(F.count_distinct("counterpart_id")).alias(_COUNTERPART),
        _double(F.min("event_time")).alias("event_first_time"),
        _last(F.max("event_time")).alias("_last"),
        *[_double(F.count_if(F.col("event_type") == a)).alias(f"event_{a}_count") for a in ACTIONS],
    )
    lasts = updates.groupBy(*KEY).agg(_last(F.max("event_time")).alias("_last"))
    at = F.col("_last") if as_of is None else F.lit(as_of).cast("bigint")
    pruned = F.col("_last") - max(WINDOWS) * DAY
    counts = [_double(F.count_if(F.col("event_time") >= F.greatest(at - n * DAY, pruned))).alias(f"event_count_{n}d") for n in WINDOWS]
    recent = updates.select(*KEY, "event_time").join(lasts, KEY).groupBy(*KEY).agg(*counts)
    joined = totals.join(recent, KEY)
    return (
        joined.withColumn("as_of_time", at)
        .withColumn("event_value_mean", F.col("event_value_sum") / F.col("event_count"))
        .withColumn("event_last_time", _double(F.col("_last")))
        .withColumn("event_recency_seconds", _double(F.greatest(F.lit(0).cast("bigint"), at - F.col("_last"))))
        .withColumn("event_click_rate", _rate(F.col("event_click_count"), F.col("event_expose_count")))
        .select(*KEY, "as_of_time", *_columns())
    )


def _columns() -> list[str]:
    return [_COUNTERPART if n == COUNTERPART["user"] else n for n in feature_names("user")]


def for_type(features: DataFrame, entity_type: str) -> DataFrame:
    """The rows of one entity type, with that type's feature names."""
    rows = features.filter(F.col("entity_type") == entity_type)
    return rows.withColumnRenamed(_COUNTERPART, COUNTERPART[entity_type])


def feature_map(entity_type: str) -> Column:
    """The features of a row of :func:`for_type` as a map, in their order."""
    return F.create_map(*[x for n in feature_names(entity_type) for x in (F.lit(n), F.col(n))])


def snapshots(features: DataFrame) -> DataFrame:
    """``entity_type, entity_id, as_of_time, features`` with the features as a map, for both entity types."""
    parts = [for_type(features, t).select(*KEY, "as_of_time", feature_map(t).alias("features")) for t in COUNTERPART]
    return reduce(DataFrame.unionByName, parts)


def long_form(features: DataFrame) -> DataFrame:
    """``entity_type, entity_id, feature, value``: a row for each feature."""
    return snapshots(features).select(*KEY, F.explode("features").alias("feature", "value"))


def running_features(updates: DataFrame, seq: str = "seq") -> DataFrame:
    """The features after every single update, in the order of ``seq``, with ``seq`` kept.

    A count over N days at a row is the number of rows so far less those that have expired: an event at ``t`` expires with
    the first row whose running ``last`` is above ``t + N days``.  That row is found by one sort of the running maxima
    together with the expiry times, and a running sum counts the expiries, so no list of times is held.
    All steps share one partitioning by entity.
    """
    sofar = Window.partitionBy(*KEY).orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = updates.withColumn("_day", F.expr(f"event_time div {DAY}"))
    news = {"_day": "event_active_days", "scene": "event_unique_scene_count", "counterpart_id": _COUNTERPART}
    for column in news:
        first = F.row_number().over(Window.partitionBy(*KEY, column).orderBy(seq)) == 1
        base = base.withColumn(f"_new_{column}", (first & F.col(column).isNotNull()).cast("int"))
    base = base.withColumn("_last", _last(F.max("event_time").over(sofar)))
    base = base.withColumns({out: _double(F.sum(f"_new_{c}").over(sofar)) for c, out in news.items()})
    base = base.withColumns(
        {
            "event_count": _double(F.count(F.lit(1)).over(sofar)),
            "event_value_sum": F.sum("value").over(sofar),
            "event_first_time": _double(F.min("event_time").over(sofar)),
            **{f"event_{a}_count": _double(F.count_if(F.col("event_type") == a).over(sofar)) for a in ACTIONS},
        }
    )
    # n = 0: a running maximum; otherwise an event's expiry time
    marks = F.array(
        F.struct(F.lit(0).alias("n"), F.col("_last").alias("v")),
        *[F.struct(F.lit(n).alias("n"), (F.col("event_time") + n * DAY).alias("v")) for n in WINDOWS],
    )
    marks = base.select(*KEY, seq, F.explode(marks).alias("m")).select(*KEY, seq, "m.n", "m.v")
    above = Window.partitionBy(*KEY).orderBy(F.desc("v"), F.desc("n")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marks = marks.withColumn("_from", F.min(F.when(F.col("n") == 0, F.col(seq))).over(above))
    at = F.when(F.col("n") == 0, F.col(seq)).otherwise(F.greatest(F.col(seq), F.col("_from")))
    ordered = marks.filter("n = 0 or _from is not null").select(*KEY, "n", at.alias(seq))
    upto = Window.partitionBy(*KEY).orderBy(seq, F.desc("n")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gone = ordered.withColumns({f"_gone_{n}": F.count_if(F.col("n") == n).over(upto) for n in WINDOWS}).filter("n = 0").drop("n")
    rows = base.join(gone, [*KEY, seq])
    return (
        rows.withColumns({f"event_count_{n}d": F.col("event_count") - F.col(f"_gone_{n}") for n in WINDOWS})
        .withColumn("as_of_time", F.col("_last"))
        .withColumn("event_value_mean", F.col("event_value_sum") / F.col("event_count"))
        .withColumn("event_last_time", _double(F.col("_last")))
        .withColumn("event_recency_seconds", F.lit(0.0))
        .withColumn("event_click_rate", _rate(F.col("event_click_count"), F.col("event_expose_count")))
        .select(*KEY, seq, "as_of_time", *_columns())
    )


def batch_features(updates: DataFrame, batch: str, seq: str = "seq") -> DataFrame:
    """The last snapshot of each entity in each micro-batch, where ``batch`` names a row's batch."""
    running = running_features(updates, seq)
    ends = updates.groupBy(*KEY, batch).agg(F.max(seq).alias(seq))
    return running.join(ends, [*KEY, seq])
