"""Shards along a Hilbert curve, so that each shard spans a small box of the metadata.

Every document becomes a point: the logarithm of its size, and the places of its language and its
source in those columns' sorted values, each quantised to 16 steps.  Cells of that grid are ordered by
their index on the curve, and the order is cut into runs of equal row counts.  A reader with a predicate
on any of the three columns then skips most shards by their minimum and maximum (:func:`shard_boxes`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rank import lookup, ranked
from .support import block_count, saved

#: Bits for each dimension; the grid has ``2 ** (3 * BITS)`` cells, which bounds the cell table.
BITS = 4
SHARDS = 16


def hilbert_index(coordinates: list[Column], bits: int = BITS) -> Column:
    """Index on the Hilbert curve (Skilling's transform) of integer coordinates below ``2 ** bits``."""
    n = len(coordinates)
    steps = F.array(
        *[
            F.struct(F.lit(1 << b).cast("long").alias("q"), F.lit(i).alias("i"))
            for b in range(bits - 1, 0, -1)
            for i in range(n)
        ]
    )

    def undo(axes: Column, step: Column) -> Column:
        low, x, y = step["q"] - 1, F.get(axes, F.lit(0)), F.get(axes, step["i"])
        swap = x.bitwiseXOR(y).bitwiseAND(low)
        is_set = y.bitwiseAND(step["q"]) != 0
        head = F.when(is_set, x.bitwiseXOR(low)).otherwise(x.bitwiseXOR(swap))
        this = F.when(is_set, y).otherwise(y.bitwiseXOR(swap))
        return F.transform(axes, lambda v, k: F.when(k == 0, head).when(k == step["i"], this).otherwise(v))

    def interleave(axes: Column) -> Column:
        gray, sofar = [], None
        for i in range(n):
            x = F.get(axes, F.lit(i))
            sofar = x if sofar is None else sofar.bitwiseXOR(x)
            gray.append(sofar)
        flip = F.lit(0).cast("long")
        for b in range(bits - 1, 0, -1):
            one = F.when(gray[-1].bitwiseAND(F.lit(1 << b)) != 0, F.lit((1 << b) - 1)).otherwise(F.lit(0))
            flip = flip.bitwiseXOR(one.cast("long"))
        total = F.lit(0).cast("long")
        for b in range(bits):
            for i in range(n):
                bit = F.shiftright(gray[i].bitwiseXOR(flip), b).bitwiseAND(F.lit(1))
                total = total + F.shiftleft(bit, b * n + n - 1 - i)
        return total

    return F.aggregate(steps, F.array(*[c.cast("long") for c in coordinates]), undo, interleave)


def _place(df: DataFrame, column: str, out: str, rows: int) -> DataFrame:
    """Quantise a column by the share of rows with a smaller value; null counts as the smallest."""
    values = df.groupBy(column).agg(F.count("*").alias("_n"))
    before = Window.orderBy(F.col(column).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    share = F.coalesce(F.sum("_n").over(before), F.lit(0))
    step = F.least(F.lit((1 << BITS) - 1), F.floor(share * (1 << BITS) / max(rows, 1))).cast("int")
    return lookup(df, values.select(column, step.alias(out)), [column])


def _along(rows: DataFrame, shards: int, order: list[str]) -> DataFrame:
    """Add ``curve, shard, slot`` to rows with ``size, lang, source``; of all columns, equal rows are ranked as one."""
    columns, rows = rows.columns, saved(rows)
    total = rows.count()
    rows = _place(_place(rows, "lang", "_lang", total), "source", "_source", total)
    steps = F.least(F.lit((1 << BITS) - 1), F.floor(F.log2("size"))).cast("int")
    rows = rows.withColumn("_cell", (steps * (1 << BITS) + F.col("_lang")) * (1 << BITS) + F.col("_source"))
    mask = F.lit((1 << BITS) - 1)
    axes = [F.shiftright("_cell", k * BITS).bitwiseAND(mask) for k in (2, 1, 0)]
    before = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    cells = (
        rows.groupBy("_cell")
        .agg(F.count("*").alias("_rows"))
        .withColumn("curve", hilbert_index(axes))
        .withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    )
    rows = ranked(lookup(rows, cells, ["_cell"]), "_cell", F.col("_rows"), order)
    small, longer = total // shards, total % shards
    at, cut = F.col("_start") + F.col("rank"), longer * (small + 1)
    head = F.floor(at / (small + 1))
    tail = longer + F.floor((at - cut) / max(small, 1))
    shard = F.when(at < cut, head).otherwise(tail)
    first = F.when(F.col("shard") <= longer, F.col("shard") * (small + 1)).otherwise(cut + (F.col("shard") - longer) * small)
    rows = rows.withColumn("shard", shard.cast("int")).withColumn("slot", (at - first).cast("long"))
    return rows.select(*columns, "curve", "shard", "slot")


def _metadata(docs: DataFrame) -> list[Column]:
    text = F.coalesce(F.col("text"), F.lit(""))
    return [
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
    ]


def hilbert_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Deal all rows of ``docs`` to ``shards`` runs of the curve; shard sizes in rows differ by one at most.

    Returns ``doc_id, size, text_crc32, lang, source, curve, shard, slot``.  ``size`` is the UTF-8 length
    plus 1, and 1 for a null text, whose checksum is that of the empty text.  Null ids, languages and
    sources are values of their own; rows of one cell lie in the order of a hash, so a cell with any share of the rows
    is split over tasks; repeated rows, however many, keep separate slots.  An empty table gives no rows; other columns
    are ignored.
    """
    return _along(docs.select(*_metadata(docs)), shards, ["doc_id", "text_crc32", "size"])


def shard_boxes(sharded: DataFrame) -> DataFrame:
    """Rows, bytes and the range of each dimension by shard: what a reader prunes with."""
    ranges = [f(c).alias(f"{name}_{c}") for c in ("size", "lang", "source") for name, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"), *ranges)


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, files: int | None = None) -> None:
    """Write the documents themselves, one folder for each shard, sorted along the curve within each file.

    Whole rows are ranked, so every row has a slot of its own; columns that can't be grouped by (maps) are not supported.
    Each shard is cut into ranges of slots, of which a task writes one: ``files`` in all, by default one for each 128 MB of
    input, and one for each shard at least.  Columns of the input named ``shard`` or ``slot`` are replaced.
    """
    docs = docs.drop("shard", "slot")
    inner = [f"_in_{i}" for i in range(len(docs.columns))]
    rows = docs.select(*[F.col(c).alias(x) for c, x in zip(docs.columns, inner, strict=True)], *_metadata(docs))
    rows = _along(rows, shards, ["doc_id", "text_crc32", "size"])
    rows = rows.select(*[F.col(x).alias(c) for c, x in zip(docs.columns, inner, strict=True)], "shard", "slot")
    rows = rows.repartitionByRange(files or block_count(docs, 128 << 20, shards), "shard", "slot")
    rows.sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)
