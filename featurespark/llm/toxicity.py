"""Toxicity by a small convolutional network over hashed word embeddings, trained in numpy.

A token's vector is the sum of the embeddings of its hash and of the hashes of its first bytes, so that unseen endings of a known
stem still count.  Filters of several widths slide over the vectors; each filter's maximum over the whole
text goes through a linear layer.  The net is fitted on a bounded sample of labelled rows.  Its score is calibrated on all
the other labelled rows that may be learnt from, through histograms, and so is one threshold for each language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .kernels import Chunk, byte_codes, chunks, find_words, span_hashes
from .rank import lookup
from .support import saved, session, unused

#: Hash buckets, size of a vector, widths of the filters, filters of each width, and prefix lengths in bytes.
BUCKETS, DIM, WIDTHS, FILTERS, PREFIXES = 1 << 16, 8, (1, 2, 3), 8, (4, 6)
#: The training sample: rows of each label at most, and the longest text in it.
MOST_TOXIC, MOST_CLEAN, MOST_BYTES = 2_500, 5_000, 20_000
#: Rounds over the sample, but as many steps at least; rows in a step, its rate and the table's in its terms, and the weight of the prior of the first vectors.
EPOCHS, LEAST_STEPS, BATCH, RATE, TABLE_RATE, PRIOR = 4, 200, 64, 0.01, 20, 10.0
#: Where a score counts as toxic without regard to language, and the rows that a language's own threshold needs.
CUT, LEAST_ROWS = 0.3, 20
#: Weight of the pull of scale and shift towards 1 and 0, in rows.
PULL = 1.0
#: Bins of a histogram of raw outputs for each of their standard deviations, and how many of these lie to either side of the mean.
STEPS, WIDE = 64, 8

_KIND = np.zeros(256, bool)
_KIND[np.r_[48:58, 65:91, 97:123, 128:256]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def tokens(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each token (one for the word, one for each prefix), and the first token of each document."""
    chunk = chunk._replace(buf=_LOWER[chunk.buf])
    words = find_words(chunk, _KIND[chunk.buf])
    codes = byte_codes(chunk.buf)
    ends = [words.end, *[np.minimum(words.end, words.start + n) for n in PREFIXES]]
    # whole words and prefixes of one spelling are different features
    hashes = [span_hashes(codes, words.start, e) * np.uint64(2 * k + 1) for k, e in enumerate(ends)]
    return np.stack([(h >> np.uint64(40)) % np.uint64(BUCKETS) for h in hashes], axis=1).astype(np.int32), words.first


@dataclass
class Net:
    """Parameters.  ``middle`` and ``spread`` standardise the raw output, ``scale`` and ``shift`` make that a calibrated score."""

    table: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    rest: float = 0.0
    middle: float = 0.0
    spread: float = 1.0
    scale: float = 1.0
    shift: float = 0.0

    def features(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Vectors, pooled filter outputs of each document, and each filter's outputs by place."""
        n = len(ids)
        vectors = self.table[ids[:, 0]]
        for k in range(1, ids.shape[1]):
            vectors = vectors + self.table[ids[:, k]]
        last = np.repeat(first[1:], np.diff(first))
        pooled = np.zeros((len(first) - 1, len(self.filters) * FILTERS), np.float32)
        full = np.flatnonzero(np.diff(first) > 0)
        outs = []
        for w, weights in enumerate(self.filters):
            out = vectors @ weights[0]
            for o in range(1, len(weights)):
                # a window that runs over its document's end sees nothing there
                inside = (np.arange(n - o) + o < last[: n - o])[:, None] if n > o else np.zeros((0, 1), bool)
                if n > o:
                    out[: n - o] += np.where(inside, vectors[o:] @ weights[o], 0)
            outs.append(out)
            if len(full):
                pooled[full, w * FILTERS : (w + 1) * FILTERS] = np.maximum.reduceat(out, first[full], axis=0)
        return vectors, pooled, outs

    def raw(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        _, pooled, _ = self.features(ids, first)
        return np.maximum(pooled + self.bias, 0) @ self.out + self.rest

    def standard(self, chunk: Chunk) -> np.ndarray:
        return (self.raw(*tokens(chunk)).astype(float) - self.middle) / self.spread

    def gradients(self, ids: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict:
        """Of the mean cross-entropy, by parameter; that of the table as token places and vectors, which hold for each of their buckets."""
        vectors, pooled, outs = self.features(ids, first)
        active = pooled + self.bias
        hidden = np.maximum(active, 0)
        p = 1 / (1 + np.exp(-np.clip(hidden @ self.out + self.rest, -30, 30)))
        delta = (p - y) / len(y)
        d_hidden = np.where(active > 0, delta[:, None] * self.out[None], 0).astype(vectors.dtype)
        found = {"out": hidden.T @ delta, "rest": float(delta.sum()), "bias": d_hidden.sum(axis=0), "filters": [], "at": [], "by": []}
        for w, weights in enumerate(self.filters):
            d_weights = np.zeros_like(weights)
            for k in range(len(y)):
                a, b = first[k], first[k + 1]
                grad = d_hidden[k, w * FILTERS : (w + 1) * FILTERS]
                if a == b or not grad.any():
                    continue
                best = a + np.argmax(outs[w][a:b], axis=0)
                for o in range(len(weights)):
                    inside = best + o < b
                    at, g = best[inside] + o, grad[inside]
                    np.add.at(d_weights[o].T, np.flatnonzero(inside), vectors[at] * g[:, None])
                    found["at"].append(at)
                    found["by"].append(g[:, None] * weights[o][:, inside].T)
            found["filters"].append(d_weights)
        return found


class _Adam:
    def __init__(self, rate: float) -> None:
        self.rate, self.state, self.t = rate, {}, 0

    def step(self, name: str, value: np.ndarray, grad: np.ndarray) -> None:
        m, v = self.state.setdefault(name, (np.zeros_like(value), np.zeros_like(value)))
        m *= 0.9
        m += 0.1 * grad
        v *= 0.999
        v += 0.001 * grad * grad
        t = self.t
        value -= self.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)


def _log_odds(docs: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Log odds of each bucket against the base rate, by documents, drawn to 0 where few documents have it."""
    seen = np.zeros((2, BUCKETS))
    for ids, y in zip(docs, labels.astype(int).tolist(), strict=True):
        seen[y][np.unique(ids)] += 1
    base = labels.mean()
    p = (seen[1] + PRIOR * base) / (seen.sum(axis=0) + PRIOR)
    return np.log(p / (1 - p)) - np.log(base / (1 - base))


def train(docs: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Net:
    """Fit a net on documents as arrays of :func:`tokens`, by Adam on the cross-entropy."""
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.02, (BUCKETS, DIM)).astype(np.float32)
    table[:, 0] += 0.3 * _log_odds(docs, labels)
    filters = [rng.normal(0, 0.3 / w, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for f in filters:
        f[0, 0] = np.abs(f[0, 0]) + 0.5
    net = Net(table, filters, np.zeros(len(WIDTHS) * FILTERS, np.float32), rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32))
    adam = _Adam(RATE)
    rate_table = RATE * TABLE_RATE
    for _ in range(max(EPOCHS, -(-LEAST_STEPS * BATCH // len(docs)))):
        order = rng.permutation(len(docs))
        for lo in range(0, len(order), BATCH):
            rows = order[lo : lo + BATCH]
            ids = np.concatenate([docs[i] for i in rows]) if len(rows) else docs[0]
            first = np.r_[0, np.cumsum([len(docs[i]) for i in rows])]
            y = labels[rows].astype(np.float32)
            found = net.gradients(ids, first, y)
            adam.t += 1
            adam.step("out", net.out, found["out"])
            net.rest -= RATE * found["rest"]
            adam.step("bias", net.bias, found["bias"])
            for w, weights in enumerate(net.filters):
                adam.step(f"filter{w}", weights, found["filters"][w])
            if found["at"]:
                at, by = np.concatenate(found["at"]), np.concatenate(found["by"])
                for k in range(ids.shape[1]):
                    np.subtract.at(net.table, ids[at, k], rate_table * by)
    return net


def calibrate(x: np.ndarray, weight: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a logistic regression on standardised outputs ``x`` that stand for ``weight`` rows each."""
    a, b = 1.0, 0.0

    def loss(a: float, b: float) -> float:
        z = a * x + b
        return float((weight * (np.logaddexp(0, z) - labels * z)).sum() + PULL / 2 * ((a - 1) ** 2 + b * b))

    for _ in range(50):  # Newton steps, shortened until they help
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w, d = weight * p * (1 - p), weight * (p - labels)
        g = np.array([d @ x + PULL * (a - 1), d.sum() + PULL * b])
        h = np.array([[w @ (x * x) + PULL, w @ x], [w @ x, w.sum() + PULL]])
        step = np.linalg.solve(h, g)
        while loss(a - step[0], b - step[1]) > loss(a, b) and np.abs(step).max() > 1e-9:
            step /= 2
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(float(a), 1e-3), float(b)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learnt(labels: DataFrame) -> DataFrame:
    """``_id, toxic``: the labels that may be learnt from."""
    known = labels.filter("toxic in (0, 1) and doc_id is not null").filter(~held_out(F.col("doc_id")))
    return known.select(F.col("doc_id").cast("long").alias("_id"), "toxic")


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Net, list[int]] | None:
    """A net trained on labelled rows of ``docs`` that are not held out, and the ids of these rows; None if a class has no rows.

    Of each class the rows with the least hashes of their ids are taken, up to the documented bounds, of several rows with one id the
    one with the least text; one in five of them is left to the calibration.
    """
    known = learnt(labels)
    short = docs.filter(F.octet_length("text") <= MOST_BYTES).select(F.col("doc_id").cast("long").alias("_id"), "text")
    picked = [
        known.filter(F.col("toxic") == y).distinct().orderBy(F.xxhash64("_id"), "_id").limit(n) for y, n in ((1, MOST_TOXIC), (0, MOST_CLEAN))
    ]
    sample = short.join(F.broadcast(picked[0].unionByName(picked[1])), "_id").groupBy("_id", "toxic").agg(F.min("text").alias("text"))
    sample = sample.toArrow().sort_by([("_id", "ascending"), ("toxic", "ascending")])
    y = np.array(sample.column("toxic").to_pylist(), dtype=float)
    parts = [tokens(c) for c in chunks(sample.column("text").combine_chunks())] if len(y) else []
    rows = [ids[first[i] : first[i + 1]] for ids, first in parts for i in range(len(first) - 1)]
    apart = np.arange(len(y)) % 5 == 4
    if any(len(set(y[x])) < 2 for x in (apart, ~apart)):
        return None
    net = train([rows[i] for i in np.flatnonzero(~apart)], y[~apart])
    at = np.flatnonzero(apart)
    raw = net.raw(np.concatenate([rows[i] for i in at]), np.r_[0, np.cumsum([len(rows[i]) for i in at])]).astype(float)
    net.middle, net.spread = float(raw.mean()), max(float(raw.std()), 1e-6)
    return net, np.array(sample.column("_id").to_pylist())[~apart].tolist()


def standard_outputs(docs: DataFrame, net: Net | None, out: str, with_text: bool = True) -> DataFrame:
    """``docs`` with the net's standardised output for each whole text in the column ``out``, and without ``text`` unless asked."""
    shared = session(docs).sparkContext.broadcast(net)
    names = [c for c in docs.columns if with_text or c != "text"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = [net.standard(c) if net else np.zeros(c.hi - c.lo) for c in chunks(batch.column("text"))]
            yield pa.record_batch({c: batch.column(c) for c in names} | {out: pa.array(np.concatenate(parts))})

    schema = T.StructType([f for f in docs.schema.fields if f.name in names] + [T.StructField(out, T.DoubleType())])
    return docs.mapInArrow(task, schema)


def _histogram(outputs: DataFrame, labels: DataFrame, trained: list[int]) -> DataFrame:
    """``lang, toxic, bin, n``: rows (weighted so that both labels have their share of all) that the net wasn't trained on.

    ``outputs`` has ``_id, lang, _x``.  Both sides are narrow, and counts are summed before they are shuffled.
    """
    spark = outputs.sparkSession
    seen = F.broadcast(spark.createDataFrame([(i, True) for i in trained], "_id long, _seen boolean"))
    place = F.floor((F.col("_x") + WIDE) * STEPS).cast("int")
    rows = outputs.join(learnt(labels), "_id").join(seen, "_id", "left")
    counts = rows.groupBy("lang", "toxic", F.greatest(F.lit(0), F.least(F.lit(2 * WIDE * STEPS - 1), place)).alias("bin")).agg(
        F.count("*").alias("_all"), F.count_if(F.col("_seen").isNull()).alias("_apart")
    )
    counts = saved(counts)
    share = counts.groupBy("toxic").agg((F.sum("_all") / F.greatest(F.sum("_apart"), F.lit(1))).alias("_share"))
    return lookup(counts, share, ["toxic"]).filter("_apart > 0").select("lang", "toxic", "bin", (F.col("_apart") * F.col("_share")).alias("n"), "_apart")


def thresholds(histogram: DataFrame, score: Column) -> DataFrame:
    """``lang, threshold``: where F1 is best, for languages with rows of both labels, ``LEAST_ROWS`` in all at least.

    ``score`` turns the column ``_x``, here the lower edge of the best bin, into a score.
    """
    down = Window.partitionBy("lang").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("lang")
    hits = F.when(F.col("toxic") == 1, F.col("n")).otherwise(0.0)
    bins = histogram.filter("lang is not null").groupBy("lang", "bin").agg(F.sum("n").alias("n"), F.sum(hits).alias("hits"), F.sum("_apart").alias("rows"))
    bins = bins.withColumn("f1", 2 * F.sum("hits").over(down) / (F.sum("n").over(down) + F.sum("hits").over(whole)))
    enough = (F.sum("rows").over(whole) >= LEAST_ROWS) & (F.sum("hits").over(whole) > 0) & (F.sum("hits").over(whole) < F.sum("n").over(whole) - 1e-9)
    best = bins.withColumn("enough", enough).filter("enough").groupBy("lang").agg(F.max(F.struct("f1", "bin")).alias("b"))
    return best.withColumn("_x", F.col("b.bin") / STEPS - WIDE).select("lang", score.alias("threshold"))


def score_toxicity(docs: DataFrame, labels: DataFrame, with_text: bool = True) -> DataFrame:
    """All rows and columns of ``docs`` with ``score``, ``threshold`` (its language's) and ``toxic``: score at least threshold.

    The score reads the text alone.  Null and empty texts get the score of a text without tokens; texts of
    any length are read whole; an unknown or null language has the threshold ``CUT``; without labels of both
    classes every score is 0.  Columns named ``score``, ``threshold`` or ``toxic`` are replaced.  Without ``with_text`` the text is
    left out, and is read once instead of twice.
    """
    docs = docs.drop("score", "threshold", "toxic")
    fitted = fit(docs, labels)
    net, trained = fitted or (None, [])
    (x,) = unused(docs, "_x")
    if with_text:
        outputs = standard_outputs(docs, net, x)
        known = docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        narrow = standard_outputs(known.select(F.col("doc_id").cast("long").alias("_id"), F.col("lang").cast("string").alias("lang"), "text"), net, "_x", False)
    else:
        outputs = saved(standard_outputs(docs, net, x, False))
        narrow = outputs.select(F.col("doc_id").cast("long").alias("_id"), F.col("lang").cast("string").alias("lang"), F.col(x).alias("_x"))
    if not net:
        rows = outputs.withColumns({"score": F.lit(0.0), "threshold": F.lit(CUT)})
    else:
        histogram = saved(_histogram(narrow, labels, trained))
        bins = histogram.groupBy("bin", "toxic").agg(F.sum("n").alias("n")).orderBy("bin", "toxic").toArrow()
        middles, n, y = ((np.array(bins.column(c).to_pylist(), float)) for c in ("bin", "n", "toxic"))
        net.scale, net.shift = calibrate((middles + 0.5) / STEPS - WIDE, n, y) if len(n) else (1.0, 0.0)
        score = lambda c: 1 / (1 + F.exp(-F.greatest(F.lit(-50.0), F.least(F.lit(50.0), F.col(c) * net.scale + net.shift))))
        cuts = thresholds(histogram, score("_x"))
        lang, cut = unused(docs, "_lang", "_cut")
        cuts = cuts.select(F.col("lang").alias(lang), F.col("threshold").alias(cut))
        rows = lookup(outputs.withColumn(lang, F.col("lang").cast("string")), cuts, [lang])
        rows = rows.withColumns({"score": score(x), "threshold": F.coalesce(F.col(cut), F.lit(CUT))})
    columns = [c for c in docs.columns if with_text or c != "text"]
    return rows.withColumn("toxic", F.col("score") >= F.col("threshold")).select(*columns, "score", "threshold", "toxic")
