"""Exact ranks within groups, by sums over blocks rather than by one sort of a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .support import saved

#: Rows of one group that one task ranks.
BLOCK_ROWS = 50_000
#: Bounds for a broadcast lookup table; a larger one is joined by a shuffle.
LOOKUP_ROWS, LOOKUP_BYTES = 200_000, 16 << 20


def lookup(big: DataFrame, small: DataFrame, on: list[str]) -> DataFrame:
    """Left join on null-safe keys, broadcasting ``small`` only when its measured size is bounded.

    Beyond the bound the join shuffles, and adaptive execution splits partitions of hot keys.
    """
    small = saved(small)
    text = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in small.dtypes if kind == "string"]
    width = sum(text, F.lit(16 * len(small.columns)))
    rows, size = small.agg(F.count("*"), F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()
    side = small.select(*[F.col(c).alias(f"_k_{c}") if c in on else F.col(c) for c in small.columns])
    if rows <= LOOKUP_ROWS and size <= LOOKUP_BYTES:
        side = F.broadcast(side)
    match = None
    for c in on:
        one = F.col(c).eqNullSafe(F.col(f"_k_{c}"))
        match = one if match is None else match & one
    return big.join(side, match, "left").drop(*[f"_k_{c}" for c in on])


def repeated(df: DataFrame, times: str, index: str, chunk: int = BLOCK_ROWS) -> DataFrame:
    """Each row of ``df`` as often as its column ``times`` says, numbered from 0 in the column ``index``.

    Rows with a very large number are first cut into chunks of ``chunk`` copies and dealt out, so no task makes them all.
    """
    df = saved(df)
    few = df.filter(F.col(times).between(1, chunk)).withColumn(index, F.explode(F.sequence(F.lit(0).cast("long"), F.col(times) - 1)))
    many = df.filter(F.col(times) > chunk)
    if many.isEmpty():
        return few
    parts = many.withColumn(index, F.explode(F.sequence(F.lit(0).cast("long"), F.col(times) - 1, F.lit(chunk).cast("long"))))
    parts = parts.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), index)
    inside = F.sequence(F.col(index), F.least(F.col(index) + chunk, F.col(times)) - 1)
    return few.unionByName(parts.withColumn(index, F.explode(inside)))


def ranked(df: DataFrame, group: str, count: Column, order: list[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``rank``: 0, 1, ... within each value of ``group``.

    ``count`` is the group's row count (any value near it will do).  Rows that are equal in all columns are ranked as one with
    their number, which partial aggregates find, so any number of them may repeat.  A group is dealt by a hash of the
    order columns to blocks of about ``block_rows`` rows, blocks are ranked apart, and sums of the block
    counts give their offsets; so a group with a third of all rows is ranked by many tasks.
    """
    columns = df.columns
    blocks = F.greatest(F.lit(1), F.ceil(count / block_rows)).cast("long")
    df = df.withColumn("_block", F.pmod(F.xxhash64(*order), blocks))
    df = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    before = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(group, "_block")
        .agg(F.sum("_copies").alias("_n"))
        .select(
            F.col(group).alias("_group"),
            F.col("_block").alias("_of"),
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        )
    )
    rest = [c for c in columns if c not in order]
    inside = Window.partitionBy(group, "_block").orderBy(*order, *rest).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("_row", F.coalesce(F.sum("_copies").over(inside), F.lit(0)))
    same = rows[group].eqNullSafe(offsets["_group"]) & (rows["_block"] == offsets["_of"])
    rows = repeated(rows.join(offsets, same), "_copies", "_copy")
    return rows.select(*columns, (F.col("_before") + F.col("_row") + F.col("_copy")).alias("rank"))
