"""Mix sources to target weights by hash thresholds, without sorting the documents.

Each document has a fixed hash of its id and text.  A source that must give up words keeps the documents whose
hash is below a threshold, so a smaller budget always keeps a subset of a larger one.  The threshold is
found from histograms: words by (source, high bits of the hash), then the next bits inside the one
bucket where the budget runs out, then single hashes inside what is left of it.  Rows that share even the
hash at the threshold are repeated rows; of them as many are taken as the budget allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rank import lookup, repeated
from .support import WORD, saved, unused

#: Weights given to the sources in turn, and how often a document may be taken.
WEIGHTS, MOST = (1, 2, 3), 3
#: Bits of the hash, and of one histogram level.
HASH_BITS, LEVEL_BITS = 60, 12


def doc_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of the MD5 of the id's decimal text and the MD5 of the text; a null id counts as ``-``, a null text as empty."""
    name = F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, target``: water filling of all words by weight under the caps.

    Sources whose cap is below their share come first by cap per weight; with those capped, the rest share
    what is left by weight.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by_need = Window.orderBy("_need", F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy()
    upto = by_need.rowsBetween(Window.unboundedPreceding, -1)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))))
    level = (F.col("_total") - F.col("_capped")) / (F.col("_weights") - F.col("_used"))
    return (
        sizes.withColumn("_w", weight)
        .withColumn("_cap", (F.col("source_size") * most).cast("double"))
        .withColumn("_need", F.col("_cap") / F.col("_w"))
        .withColumn("_capped", F.coalesce(F.sum("_cap").over(upto), F.lit(0.0)))
        .withColumn("_used", F.coalesce(F.sum("_w").over(upto), F.lit(0.0)))
        .withColumn("_total", F.sum("source_size").over(all_rows).cast("double"))
        .withColumn("_weights", F.sum("_w").over(all_rows))
        .withColumn("_level", F.when(level <= F.col("_need"), level))
        .withColumn("_level", F.max("_level").over(all_rows))
        .withColumn("target", F.least("_cap", F.col("_level") * F.col("_w")))
        .select("source", "source_size", F.coalesce("target", "_cap").alias("target"))
    )


def _thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """``source, _threshold, _left``: documents with a hash below it fit the source's budget, and leave so much of it."""
    found = budgets.select("source", F.col("_budget"), F.lit(0).cast("long").alias("_prefix"))
    rows = rows.select("source", "size", "_hash")
    left = rows
    for level in (1, 2):
        shift = HASH_BITS - LEVEL_BITS * level
        bucket = F.shiftright("_hash", shift)
        hist = left.groupBy("source", bucket.alias("_bucket")).agg(F.sum("size").alias("_words"))
        order = Window.partitionBy("source").orderBy("_bucket")
        hist = lookup(hist, found.select("source", "_budget"), ["source"])
        hist = hist.withColumn("_sum", F.sum("_words").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        hist = hist.filter(F.col("_sum") > F.col("_budget"))
        edge = hist.groupBy("source").agg(F.min(F.struct("_bucket", "_sum", "_words", "_budget")).alias("e"))
        found = saved(
            edge.select(
                "source",
                (F.col("e._budget") - F.col("e._sum") + F.col("e._words")).alias("_budget"),
                F.col("e._bucket").alias("_prefix"),
            )
        )
        left = lookup(left, found.select("source", F.col("_prefix")), ["source"])
        left = saved(left.filter(bucket == F.col("_prefix")).select("source", "size", "_hash"))
    single = left.groupBy("source", "_hash").agg(F.sum("size").alias("_words"))
    single = lookup(single, found.select("source", "_budget"), ["source"])
    order = Window.partitionBy("source").orderBy("_hash").rowsBetween(Window.unboundedPreceding, 0)
    over = single.withColumn("_sum", F.sum("_words").over(order)).filter(F.col("_sum") > F.col("_budget"))
    left = F.col("_budget") - F.col("_sum") + F.col("_words")
    edge = over.groupBy("source").agg(F.min(F.struct("_hash", left.alias("_left"))).alias("e"))
    return edge.select("source", F.col("e._hash").alias("_threshold"), F.col("e._left").alias("_left"))


def count_words(text: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD), F.lit(0))).cast("long")


def mix_plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """The documents as ``doc_id, source, size, _hash``, and a row for each source: ``source, source_size, target, _whole, _budget, _threshold, _left``.

    Every document of the source is taken ``_whole`` times, and those with a hash below ``_threshold`` once more; of those at
    the threshold, so many that their words are at most ``_left``.
    """
    rows = saved(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            count_words(F.col("text")).alias("size"),
            doc_hash(F.col("doc_id"), F.col("text")).alias("_hash"),
        )
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)))
    targets = source_targets(sizes, weights, most).withColumn("_whole", F.least(F.lit(most), whole).cast("long"))
    targets = saved(targets.withColumn("_budget", F.col("target") - F.col("_whole") * F.col("source_size")))
    return rows, saved(lookup(targets, _thresholds(rows, targets), ["source"]))


def _taken(rows: DataFrame, names: dict[str, str], copies: str, size: Column, most: int) -> DataFrame:
    """Add ``copies`` to rows that have the columns of the plan and ``_hash``, under the names that ``names`` gives.

    Rows at their source's threshold are few, or repeated ones: those that are equal in all columns are counted, the counts
    are put in order, and each row is then made again as often as it was there.
    """
    col = lambda c: F.col(names[c])
    asks = (col("_whole") < most) & (col("_budget") > 0)
    more = asks & (col("_threshold").isNull() | (col("_hash") < col("_threshold")))
    ties = F.coalesce(asks & (col("_hash") == col("_threshold")), F.lit(False))
    columns = rows.columns
    plain = rows.filter(~ties).withColumn(copies, (col("_whole") + F.when(more, 1).otherwise(0)).cast("int"))
    inner = unused(rows, "_size", "_times", "_before", "_at")
    size_of, times, before, at = (F.col(c) for c in inner)
    edge = rows.filter(ties).groupBy(*columns).agg(F.count("*").alias(inner[1])).withColumn(inner[0], size)
    # the order of the columns that decide comes first; what follows makes it total
    order = Window.partitionBy(names["source"]).orderBy(inner[0], *columns).rowsBetween(Window.unboundedPreceding, -1)
    edge = edge.withColumn(inner[2], F.coalesce(F.sum(size_of * times).over(order), F.lit(0)))
    edge = repeated(edge, inner[1], inner[3])
    fits = before + size_of * (at + 1) <= col("_left")
    edge = edge.withColumn(copies, (col("_whole") + F.when(fits, 1).otherwise(0)).cast("int"))
    return plain.unionByName(edge.select(*columns, copies))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Decide how often the mix takes each document: ``doc_id, size, source, source_size, target, copies, taken``.

    A target of at least the source's size takes every document once for each whole time, and documents
    below the hash threshold once more.  A source's words fall short of its target by less than the size
    of one document, also where rows share an id or have none, or repeat.  Null texts and texts without words have size 0 and are
    taken with ``taken`` 0; a null source is a source; an empty table gives no rows.
    """
    rows, plan = mix_plan(docs, weights, most)
    rows = lookup(rows, plan, ["source"])
    rows = _taken(rows, {c: c for c in rows.columns}, "copies", F.col("size"), most)
    taken = (F.col("size") * F.col("copies")).cast("long").alias("taken")
    return rows.select("doc_id", "size", "source", "source_size", "target", "copies", taken)


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the plan takes it, and not at all if it doesn't."""
    plan = mix_plan(docs, weights, most)[1]
    # the plan's names must not meet those of the input
    inner = unused(docs, *plan.columns, "_hash", "_copies", "_copy")
    names = dict(zip([*plan.columns, "_hash", "_copies", "_copy"], inner, strict=True))
    plan = plan.select(*[F.col(c).alias(names[c]) for c in plan.columns])
    rows = docs.withColumns({names["source"]: F.col("source").cast("string"), names["_hash"]: doc_hash(F.col("doc_id"), F.col("text"))})
    rows = _taken(lookup(rows, plan, [names["source"]]), names, names["_copies"], count_words(F.col("text")), most)
    copies = F.col(names["_copies"])
    return rows.filter(copies > 0).withColumn(names["_copy"], F.explode(F.sequence(F.lit(1), copies))).select(*docs.columns)


def mix_sql() -> str:
    """The same mix in SQL, with one sort of each source in place of the histograms."""
    weights = f"[{', '.join(f'{float(w)}' for w in WEIGHTS)}]"
    return f"""
WITH rows AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || md5(coalesce(text, ''))), 1, {HASH_BITS // 4}) AS BIGINT) AS h
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY source),
w AS (SELECT *, {weights}[CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} AS BIGINT) + 1] AS w,
  CAST(source_size * {MOST} AS DOUBLE) AS cap FROM sizes),
upto AS (SELECT *, cap / w AS need,
  coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
  coalesce(sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
  CAST(sum(source_size) OVER () AS DOUBLE) AS total, sum(w) OVER () AS weights FROM w),
level AS (SELECT max(CASE WHEN (total - capped) / (weights - used) <= need THEN (total - capped) / (weights - used) END) AS level FROM upto),
target AS (SELECT source, source_size, coalesce(least(cap, (SELECT level FROM level) * w), cap) AS target FROM upto),
budget AS (SELECT *, least({MOST}, CAST(floor(target / greatest(source_size, 1)) AS BIGINT)) AS whole FROM target),
sums AS (SELECT r.*, b.source_size, b.target, b.whole, b.target - b.whole * b.source_size AS budget,
  sum(r.size) OVER (PARTITION BY r.source ORDER BY r.h, r.size ROWS UNBOUNDED PRECEDING) AS upto
  FROM rows r JOIN budget b ON r.source IS NOT DISTINCT FROM b.source),
cut AS (SELECT *, whole + CASE WHEN whole < {MOST} AND budget > 0 AND upto <= budget THEN 1 ELSE 0 END AS copies FROM sums)
SELECT doc_id, CAST(size AS BIGINT) AS size, source, source_size, target, CAST(copies AS INTEGER) AS copies,
  CAST(size * copies AS BIGINT) AS taken FROM cut"""
