"""Batches of documents of like length, with bucket bounds that minimise padding.

A batch pads its rows to its bucket's length.  The global histogram of lengths decides the buckets: dynamic
programming over its distinct lengths finds the bounds with the least total padding for a number of buckets.  Inside
a bucket, batches of as many rows as the token budget allows are cut from ranks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .mixing import count_words
from .rank import ranked
from .support import saved

BUCKETS, TOKEN_BUDGET = 16, 65_536
#: Lengths up to here have a bin of their own; above, a bin spans a ``2 ** -STEPS`` part of a power of two at most.  That
#: bounds the histogram to 65,536 bins, and 32,768 for each further power of two; so it is exact up to 65,536 tokens, and
#: beyond that a bound lies at most 1/32,768 above the best one.
EXACT, STEPS = 65_536, 15


def length_bin(length: Column) -> Column:
    """The bin of a length, named by the largest length that it may hold."""
    wide = F.greatest(F.floor(F.log2(F.greatest(length, F.lit(1)))).cast("int") - STEPS, F.lit(0))
    scale = F.pow(F.lit(2.0), wide).cast("long")
    return F.when(length <= EXACT, length).otherwise(F.ceil(length / scale).cast("long") * scale)


def best_bounds(lengths: np.ndarray, counts: np.ndarray, totals: np.ndarray, buckets: int) -> list[int]:
    """Last bin of each bucket, so that the padding up to each bucket's longest row is least.

    ``lengths``: the longest row of each bin, ascending; ``counts`` and ``totals``: its rows and tokens.
    Of equal plans the one with fewer buckets counts.

    A bucket of the bins i to j - 1 pads ``l[j] (r[j] - r[i]) - (t[j] - t[i])``, with the length of its last bin and the rows and
    tokens before a bin.  For a fixed i that is a line in the length, and the slopes -r[i] fall as the lengths grow; so each
    layer of the dynamic programme is one sweep over the lower hull of the lines, in exact integers.
    """
    n = len(lengths)
    rows, tokens = [0, *np.cumsum(counts).tolist()], [0, *np.cumsum(totals).tolist()]
    length = [0, *lengths.tolist()]
    pad = [length[j] * rows[j] - tokens[j] for j in range(n + 1)]  # of one bucket up to bin j
    best, choices, final = pad, [[0] * (n + 1)], [(pad[n], 1)]
    for k in range(2, min(buckets, n) + 1):
        now, pick, hull, head = [0] * (n + 1), [0] * (n + 1), [], 0
        for j in range(k, n + 1):
            i = j - 1
            slope, height = -rows[i], best[i] + tokens[i]
            while len(hull) - head >= 2:
                (s1, h1, _), (s2, h2, _) = hull[-2], hull[-1]
                # the middle line is never lowest if the outer ones cross at or before it
                if (height - h1) * (s1 - s2) <= (h2 - h1) * (s1 - slope):
                    hull.pop()
                else:
                    break
            hull.append((slope, height, i))
            x = length[j]
            while len(hull) - head >= 2 and hull[head + 1][0] * x + hull[head + 1][1] <= hull[head][0] * x + hull[head][1]:
                head += 1
            now[j], pick[j] = hull[head][0] * x + hull[head][1] + pad[j], hull[head][2]
        best = now
        choices.append(pick)
        final.append((best[n], k))
    k, j, bounds = min(final)[1], n, []
    for pick in reversed(choices[:k]):
        bounds.append(j - 1)
        j = pick[j]
    return bounds[::-1]


def length_buckets(docs: DataFrame, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET, tokens: Column | None = None) -> DataFrame:
    """Pack each row into a batch: ``doc_id, n_tokens, bucket, bucket_len, batch, slot, padding``.

    ``tokens`` gives a row's length (by default its number of words).  ``bucket_len`` is the longest row of the bucket;
    a batch holds ``max(1, budget // bucket_len)`` rows, so it exceeds the budget only where a single row does; rows
    without tokens count with a ``bucket_len`` of at least 1.  Rows are never split or cut.  Batches are
    numbered from 0 within their bucket, and only the last of a bucket may be short.  Null ids and
    repeated rows are packed like others; an empty table gives no rows.
    """
    length = count_words(F.col("text")) if tokens is None else F.coalesce(tokens.cast("long"), F.lit(0))
    rows = saved(docs.select(F.col("doc_id").cast("long").alias("doc_id"), length.alias("n_tokens"))).withColumn(
        "_bin", length_bin(F.col("n_tokens"))
    )
    bins = rows.groupBy("_bin").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("t"), F.max("n_tokens").alias("m"))
    hist = sorted((r["_bin"], r["m"], r["n"], r["t"]) for r in bins.collect())
    if not hist:
        hist = [(0, 0, 0, 0)]
    edges, longest, counts, totals = (np.array(x, dtype=np.int64) for x in zip(*hist, strict=True))
    bounds = best_bounds(longest, counts, totals, buckets)
    bucket = F.lit(len(bounds) - 1)
    sizes, starts = [], [0, *[b + 1 for b in bounds[:-1]]]
    for k in range(len(bounds) - 2, -1, -1):
        bucket = F.when(F.col("_bin") <= int(edges[bounds[k]]), F.lit(k)).otherwise(bucket)
    sizes = [int(counts[a : b + 1].sum()) for a, b in zip(starts, bounds, strict=True)]
    rows = rows.withColumn("bucket", bucket)
    pick = lambda values: F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), F.col("bucket") + 1)
    rows = ranked(rows, "bucket", pick(sizes), ["doc_id", "n_tokens"])
    capacity = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(pick(longest[bounds]), F.lit(1)))).cast("long")
    return rows.select(
        "doc_id",
        "n_tokens",
        "bucket",
        pick(longest[bounds]).alias("bucket_len"),
        F.floor(F.col("rank") / capacity).cast("long").alias("batch"),
        (F.col("rank") % capacity).cast("int").alias("slot"),
        (pick(longest[bounds]) - F.col("n_tokens")).alias("padding"),
    )
