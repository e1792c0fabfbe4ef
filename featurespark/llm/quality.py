"""Quality rules: base rules on counts, and an isolation forest over rule statistics.

Every text has a vector of rule statistics (lengths, shares of symbols, capitals and repeats).  Random splits of a sample
isolate unusual vectors early; a text's score falls with its mean path length over the trees.  Statistics of one kind
share a forest, so that an oddity of one kind isn't averaged away among the others, and each forest has a
threshold of its own, calibrated on all labelled rows through a histogram of their scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .kernels import (
    Chunk,
    byte_codes,
    chunks,
    covered,
    find_words,
    gram_hashes,
    is_space,
    mix,
    runs,
    span_hashes,
    window_starts,
    word_hashes,
)
from .support import keyed, public_id, saved, session

#: Fixed values of the base rules.
SYMBOLS, WINDOW, LEAST_WORDS, MOST_REPEATED = "[#*$%&|<>]", 5, 10, 20
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
STATISTICS = ["mean_word", "symbol_share", "mark_share", "capital_share", "dup_line_share", "repeat_share", "distinct_share", "space_share"]
#: The forests: the statistics of each, trees, rows of a tree, and labelled rows that the trees are fitted on at most.
KINDS = {"symbols": [1], "shouting": [2, 3], "repeats": [4, 5, 6], "shape": [0, 7]}
TREES, TREE_ROWS, MOST_ROWS = 64, 256, 16_384
#: Share of the labelled good rows that each threshold may drop, and bins of a score from 0 to 1.
MAY_DROP, BINS = 0.0005, 8_192

_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(SYMBOLS[1:-1].encode(), np.uint8)] = True
_MARK = np.zeros(256, bool)
_MARK[np.frombuffer(b"!?", np.uint8)] = True


def _sum_by(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(values, dtype=np.int64)]
    return total[offsets[1:]] - total[offsets[:-1]]


def _by_document(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Order by a key that joins document and hash; equal keys are equal pairs."""
    return mix(hashes ^ mix((doc + 1).astype(np.uint64)))


def count(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """The counts of ``COUNTS`` and the statistics of ``STATISTICS`` for each document of a chunk."""
    buf, offsets, n = chunk.buf, chunk.offsets, len(chunk.offsets) - 1
    words = find_words(chunk)
    n_words = np.diff(words.first)
    points = (buf & 0xC0) != 0x80
    space = is_space(buf)
    word_chars = _sum_by(points & ~space, offsets)
    n_symbols = _sum_by(_SYMBOL[buf], offsets)

    # a line starts its document or follows a newline, and ends at a newline or with its document
    newline = np.flatnonzero(buf == 10)
    starts = np.union1d(newline + 1, offsets[:-1])
    starts = starts[starts < len(buf)]
    line_doc = np.searchsorted(offsets, starts, "right") - 1
    line_end = np.minimum(np.r_[newline, len(buf)][np.searchsorted(newline, starts)], offsets[1:][line_doc])
    has_word = np.searchsorted(words.start, line_end) > np.searchsorted(words.start, starts)
    starts, line_end, line_doc = starts[has_word], line_end[has_word], line_doc[has_word]
    keys = _by_document(span_hashes(byte_codes(buf), starts, line_end), line_doc)
    order = np.argsort(keys, kind="stable")
    edges = runs(keys[order])
    again = np.ones(len(keys), bool)
    again[edges[:-1]] = False
    n_lines = np.bincount(line_doc, minlength=n)
    n_dup = np.bincount(line_doc[order[again]], minlength=n)

    hashes = word_hashes(chunk, words)
    at = window_starts(words.first, WINDOW)
    keys = _by_document(gram_hashes(hashes, WINDOW)[at], words.doc[at])
    order = np.argsort(keys)
    edges = runs(keys[order])
    times = np.repeat(np.diff(edges), np.diff(edges))
    twice = at[order[times > 1]]
    repeated = covered(twice, np.full(len(twice), WINDOW), len(hashes))
    n_repeat = _sum_by(repeated, words.first)

    keys = _by_document(hashes, words.doc)
    order = np.argsort(keys)
    n_distinct = np.bincount(words.doc[order[runs(keys[order])[:-1]]], minlength=n)
    capitals = _sum_by((buf >= 65) & (buf <= 90), offsets)
    letters = _sum_by(((buf | 32) >= 97) & ((buf | 32) <= 122), offsets)
    marks = _sum_by(_MARK[buf], offsets)
    some = lambda a, b: a / np.maximum(b, 1)
    counts = np.stack([n_words, word_chars, n_symbols, n_dup, n_repeat], axis=1).astype(np.int64)
    # distinct words thin out with length in any text, so their share is held against the usual root law
    usual = np.minimum(1.0, 4.0 / np.sqrt(np.maximum(n_words, 16)))
    statistics = [
        np.minimum(some(word_chars, n_words), 40) if n else n_words,
        some(n_symbols, word_chars),
        some(marks, word_chars),
        some(capitals, letters),
        some(n_dup, n_lines),
        some(n_repeat, n_words),
        np.maximum(0.0, usual - some(n_distinct, n_words)),
        some(_sum_by(space, offsets) - n_words, n_words),
    ]
    return counts, np.stack(statistics, axis=1).astype(float)


def _mean_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search among n rows."""
    n = np.asarray(n, float)
    more = np.maximum(n, 2)
    return np.where(n > 1, 2 * (np.log(np.maximum(more - 1, 1)) + 0.5772156649) - 2 * (more - 1) / more, 0.0)


@dataclass
class Forest:
    """Trees as arrays: split column (-1 at a leaf), split value, left child (the right one follows it), and path length at leaves."""

    column: np.ndarray
    value: np.ndarray
    child: np.ndarray
    path: np.ndarray
    usual: float
    depth: int

    @classmethod
    def fit(cls, rows: np.ndarray, trees: int = TREES, size: int = TREE_ROWS, seed: int = 11) -> Forest:
        rng = np.random.default_rng(seed)
        depth = int(np.ceil(np.log2(max(2, min(size, len(rows))))))
        built = []
        for _ in range(trees):
            own = rows[rng.choice(len(rows), min(size, len(rows)), replace=False)]
            column, value, child, path = [-1], [0.0], [0], [0.0]
            todo = [(0, own, 0)]
            while todo:
                at, part, level = todo.pop()
                low, high = part.min(axis=0), part.max(axis=0)
                able = np.flatnonzero(high > low)
                if level >= depth or len(part) < 2 or not len(able):
                    path[at] = level + float(_mean_path(len(part)))
                    continue
                k = int(rng.choice(able))
                v = rng.uniform(low[k], high[k])
                left = part[:, k] <= v
                column[at], value[at], child[at] = k, v, len(column)
                for side in (left, ~left):
                    todo.append((len(column), part[side], level + 1))
                    column.append(-1), value.append(0.0), child.append(0), path.append(0.0)
            built.append((column, value, child, path))
        width = max(len(b[0]) for b in built)
        pad = lambda k, fill: np.array([b[k] + [fill] * (width - len(b[k])) for b in built])
        return cls(pad(0, -1), pad(1, 0.0), pad(2, 0), pad(3, 0.0), float(_mean_path(min(size, len(rows)))), depth)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly of each row from 0 to 1; about 0.5 for a usual row."""
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for t in range(len(self.column)):
            at = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                column = self.column[t][at]
                right = rows[every, np.maximum(column, 0)] > self.value[t][at]
                at = np.where(column < 0, at, self.child[t][at] + right)
            total += self.path[t][at]
        return 2.0 ** (-total / len(self.column) / max(self.usual, 1e-9))


def threshold(bins: np.ndarray, good: np.ndarray, bad: np.ndarray, may_drop: float = MAY_DROP) -> float:
    """The cut with the best balance of bad rows caught and good rows kept, among those that drop few good rows.

    ``bins``: ascending places of a score's bins, with the numbers of good and bad rows in each.  A row is dropped if its score is
    above the cut; infinite without rows of both labels.
    """
    if not good.sum() or not bad.sum():
        return float("inf")
    lost, caught = np.cumsum(good[::-1]) / good.sum(), np.cumsum(bad[::-1]) / bad.sum()
    gain = np.where(lost <= may_drop, caught - lost, -1.0)
    k = int(np.argmax(gain))
    return float(np.nextafter(bins[::-1][k] / BINS, -1)) if gain[k] > 0 else float("inf")


def rule_statistics(docs: DataFrame, *more: str) -> DataFrame:
    """``doc``, the columns ``more``, the base counts and, as an array, the statistics of each whole text."""
    source = keyed(docs, *more).select("doc", *more, "text")
    names = source.columns[:-1]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = [count(c) for c in chunks(batch.column("text"))]
            counts, statistics = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            columns = {c: batch.column(c) for c in names} | {c: pa.array(counts[:, k]) for k, c in enumerate(COUNTS)}
            columns["statistics"] = pa.FixedSizeListArray.from_arrays(pa.array(statistics.ravel()), len(STATISTICS)).cast(pa.list_(pa.float64()))
            yield pa.record_batch(columns)

    session(docs)
    schema = source.drop("text").schema
    for c in COUNTS:
        schema = schema.add(c, "long")
    return source.mapInArrow(task, schema.add("statistics", T.ArrayType(T.DoubleType())))


def fit(docs: DataFrame, labels: DataFrame) -> dict[str, Forest] | None:
    """The forest of each kind from the ``MOST_ROWS`` labelled ids with the least hashes; None without any.

    Of several rows with one id, that with the least statistics counts.
    """
    known = _known(labels).select("_id").distinct()
    picked = F.broadcast(known.orderBy(F.xxhash64("_id"), "_id").limit(MOST_ROWS))
    sample = docs.select("doc_id", "text").join(picked, F.col("doc_id").cast("long") == F.col("_id")).select("doc_id", "text")
    table = rule_statistics(sample).groupBy("doc").agg(F.min("statistics").alias("statistics")).toArrow()
    if not table.num_rows:
        return None
    rows = np.array(table.column("statistics").to_pylist(), float)
    rows = rows[np.argsort(table.column("doc").to_numpy(), kind="stable")]
    return {k: Forest.fit(rows[:, at]) for k, at in KINDS.items()}


def _known(labels: DataFrame) -> DataFrame:
    return labels.filter("quality in (0, 1) and doc_id is not null").select(F.col("doc_id").cast("long").alias("_id"), "quality")


def _cuts(rated: DataFrame, labels: DataFrame) -> dict[str, float]:
    """Each kind's threshold, from all labelled rows: both sides are narrow, and counts are summed before they are shuffled."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"_{k}").alias("score")) for k in KINDS])
    rows = rated.join(_known(labels), F.col("doc") == F.col("_id")).select("quality", F.explode(kinds).alias("s"))
    place = F.least(F.lit(BINS - 1), F.floor(F.col("s.score") * BINS)).cast("int")
    counts = rows.groupBy(F.col("s.kind").alias("kind"), place.alias("bin")).agg(
        F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad")
    )
    found = counts.orderBy("kind", "bin").toPandas()
    parts = {k: found[found["kind"] == k] for k in KINDS}
    return {k: threshold(*(p[c].to_numpy() for c in ("bin", "good", "bad"))) for k, p in parts.items()}


def rate_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``kept``, ``excess`` and ``kind`` for every row.

    ``base_failed``: fewer than 10 words, or over a fifth of the words in 5-word windows that the text has
    twice.  ``kept``: not base_failed, and no forest's score above its threshold.  ``excess`` is the largest score less its
    threshold, and ``kind`` the forest that gave it.  Null and empty texts have no words and fail; without
    labelled rows only the base rules decide, ``excess`` is 0 and ``kind`` null; texts of any length are read whole; null ids are
    returned as null, and repeated rows are rated alike.
    """
    forests = fit(docs, labels)
    shared = session(docs).sparkContext.broadcast(forests)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forests = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column("statistics").flatten().to_numpy().reshape(-1, len(STATISTICS))
            columns = {c: batch.column(c) for c in ["doc", *COUNTS]}
            for k, at in KINDS.items():
                columns[f"_{k}"] = pa.array(forests[k].score(rows[:, at]) if forests else np.zeros(len(rows)))
            yield pa.record_batch(columns)

    schema = "doc long, " + ", ".join(f"{c} long" for c in COUNTS) + ", " + ", ".join(f"_{k} double" for k in KINDS)
    rated = rule_statistics(docs).mapInArrow(task, schema)
    if forests:
        rated = saved(rated)
        cuts = _cuts(rated, labels)
        worst = F.greatest(*[F.struct((F.col(f"_{k}") - F.lit(cut)).alias("excess"), F.lit(k).alias("kind")) for k, cut in cuts.items()])
    else:
        worst = F.struct(F.lit(0.0).alias("excess"), F.lit(None).cast("string").alias("kind"))
    few = F.col("n_words") < LEAST_WORDS
    repeated = 100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    return (
        rated.withColumn("_worst", worst)
        .withColumn("base_failed", few | repeated)
        .withColumn("kept", ~F.col("base_failed") & (F.col("_worst.excess") <= 0))
        .select(public_id(), *COUNTS, "base_failed", "kept", F.col("_worst.excess").alias("excess"), F.col("_worst.kind").alias("kind"))
    )
