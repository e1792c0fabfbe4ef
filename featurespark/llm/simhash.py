"""Near-duplicates by SimHash, with pairs proposed and discarded by tables of distances to pivots.

The Hamming distances of a fingerprint to fixed reference fingerprints (*pivots*) are its coordinates.
By the triangle inequality two fingerprints within ``d`` bits differ by ``d`` at most in every
coordinate, so a pair with a larger difference anywhere is discarded without comparing the fingerprints,
and the survivors are verified.

Comparing the coordinates of all pairs would be quadratic, and full distances of random fingerprints lie too close together to part
them.  So the table holds each distance in five parts, by blocks of the bits.  Three changed bits leave two of five blocks alone, and
there all partial distances are equal; so any linked pair meets in a cell of equal partial distances to the first pivots, for
one of the ten pairs of blocks.  A cell that is still large is parted by further pivots, by their full distances: into overlapping
ranges, of which any two fingerprints within ``d`` share one.  Only distinct fingerprints take part; equal ones are one
node from the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import LEAST_BLOCKS, blocks_for
from .components import components
from .kernels import Chunk, chunks, find_words, joined_words, mix, runs, window_starts, xxh64
from .support import NO_ID, keyed, public_id, saved, unused

SHINGLE, SEED, DISTANCE = 3, 42, 3
#: Width of each block of bits, from the lowest; ``DISTANCE + 2`` blocks, of which two stay equal.
BLOCKS = (13, 13, 13, 13, 12)
#: Number of pivots, which are fixed pseudo-random fingerprints, and how many of them route.
PIVOTS, ROUTING = 16, 5
#: Fingerprints of a cell that are compared as they are, the width of a range of a larger one, and the candidate pairs compared at a time.
CELL, RANGE, PAIRS = 256, 8, 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lowered(chunk: Chunk) -> Chunk:
    """The chunk with A-Z in lower case."""
    return chunk._replace(buf=_LOWER[chunk.buf])


def chunk_fingerprints(chunk: Chunk, shingle: int = SHINGLE) -> np.ndarray:
    """SimHash of each text's word shingles, repeats included."""
    chunk = lowered(chunk)
    words = find_words(chunk)
    joined, begin = joined_words(chunk, words)
    n_words = np.diff(words.first)
    few = np.flatnonzero((n_words > 0) & (n_words < shingle))
    first = np.r_[window_starts(words.first, shingle), words.first[few]]
    last = first + np.r_[np.full(len(first) - len(few), shingle), n_words[few]]
    order = np.argsort(first, kind="stable")
    first, last = first[order], last[order]
    hashes = xxh64(joined, begin[first], begin[last] - 1, SEED)
    out = np.zeros(len(n_words), np.uint64)
    some = np.flatnonzero(n_words > 0)
    edges = np.searchsorted(first, words.first[some])
    ends = np.r_[edges[1:], len(first)]
    bits = np.zeros((len(some), 64), np.int64)
    part = 1 << 16
    for lo in range(0, len(hashes), part):  # a slice of the shingles at a time, cut at the texts' edges too
        rows = np.flatnonzero((edges < lo + part) & (ends > lo))
        here = np.unpackbits(hashes[lo : lo + part].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        bits[rows] += np.add.reduceat(here, np.maximum(edges[rows] - lo, 0), axis=0, dtype=np.int64)
    set_bits = bits * 2 > (ends - edges)[:, None]
    out[some] = np.packbits(set_bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of one text."""
    return int(chunk_fingerprints(Chunk(0, 1, np.frombuffer(text, np.uint8), np.array([0, len(text)])), shingle)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc, tag, fp``: the SimHash of each whole text, as a signed long; 0 for texts without words."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [chunk_fingerprints(c, shingle).view(np.int64) for c in chunks(batch.column("text"))]
            if fps:
                yield pa.record_batch({c: batch.column(c) for c in ("doc", "tag")} | {"fp": pa.array(np.concatenate(fps))})

    return keyed(docs).mapInArrow(task, "doc long, tag long, fp long")


def pivots(n: int = PIVOTS) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def pivot_table(fps: np.ndarray, n: int = PIVOTS, widths: tuple[int, ...] = BLOCKS) -> np.ndarray:
    """Distances of each fingerprint (first axis) to each pivot, in a part for each block of bits."""
    out, at = np.empty((len(fps), n, len(widths)), np.uint8), 0
    apart = fps[:, None] ^ pivots(n)[None, :]
    for k, width in enumerate(widths):
        out[:, :, k] = np.bitwise_count((apart >> np.uint64(at)) & np.uint64((1 << width) - 1))
        at += width
    return out


def cells(table: np.ndarray, routing: int = ROUTING, distance: int = DISTANCE) -> np.ndarray:
    """The cells of each fingerprint, ten for the contract's: which blocks ``distance`` bits leave alone, and a hash of their distances to the first pivots."""
    out, blocks = [], table.shape[2]
    for n, pair in enumerate(combinations(range(blocks), blocks - distance)):
        key = np.full(len(table), n + 1, np.uint64)
        for p in range(routing):
            for k in pair:
                key = key * np.uint64(16) + table[:, p, k]
        out.append(mix(key * np.uint64(0x9E3779B97F4A7C15)))
    return np.stack(out, axis=1)


class Forest:
    """Disjoint sets over 0 to n - 1, each named by its least member."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def find(self, at: np.ndarray) -> np.ndarray:
        up = self.up[at]
        while True:
            more = self.up[up]
            if np.array_equal(more, up):
                return up
            up = more

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.find(a), self.find(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.up, np.maximum(a, b), np.minimum(a, b))

    def roots(self) -> np.ndarray:
        return self.find(np.arange(len(self.up)))


def parted(key: np.ndarray, table: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Members and cells, where cells of more than ``CELL`` are parted by the ranges of one pivot after the other.

    A member goes to the range of its distance and to that of the distance ``distance`` above.  A pivot that parts nothing is passed over.
    """
    member, full = np.arange(len(key)), table.sum(axis=2, dtype=np.int64)
    key = np.unique(key, return_inverse=True)[1]
    for p in range(full.shape[1]):
        size = np.bincount(key)
        large = size[key] > CELL
        if not large.any():
            break
        own, at = member[large], full[member[large], p]
        low, high = at // RANGE, (at + distance) // RANGE
        more = high > low
        ranges = np.r_[low, high[more]]
        again, cell = np.r_[own, own[more]], np.r_[key[large], key[large][more]]
        new = cell * 16 + ranges + len(size)  # at most 64 / RANGE + 1 ranges
        # a cell whose members all lie in one range, or of which a range holds them all, isn't made smaller
        largest = np.zeros(len(size), np.int64)
        name, where, count = np.unique(new, return_inverse=True, return_counts=True)
        np.maximum.at(largest, cell, count[where])
        helps = largest < size
        keep, use = helps[cell], ~large | ~helps[key]
        member, key = np.r_[member[use], again[keep]], np.r_[key[use], new[keep]]
        key = np.unique(key, return_inverse=True)[1]
    return member, key


def links_in_cells(key: np.ndarray, fps: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links within cells of equal ``key``, as two arrays of fingerprints.

    A cell is sorted by its first coordinate; partners of a row lie in a short run of that order,
    which is walked by offset for all rows at once, with rows leaving as their run ends.
    """
    names, node = np.unique(fps, return_inverse=True)
    parts = pivot_table(names)
    member, key = parted(key, parts[node], distance)
    table, node = parts.sum(axis=2, dtype=np.int16), node[member]
    order = np.lexsort((node, table[node, 0], key))
    key, node = key[order], node[order]
    forest = Forest(len(names))
    active, offset = np.arange(len(node)), 1
    while len(active):
        active = active[active + offset < len(node)]
        other = active + offset
        stays = (key[active] == key[other]) & (table[node[other], 0] - table[node[active], 0] <= distance)
        active, other = active[stays], other[stays]
        for lo in range(0, len(active), PAIRS):
            a, b = node[active[lo : lo + PAIRS]], node[other[lo : lo + PAIRS]]
            near = (np.abs(table[a] - table[b]) <= distance).all(axis=1)
            a, b = a[near], b[near]
            linked = np.bitwise_count(names[a] ^ names[b]) <= distance
            forest.link(a[linked], b[linked])
        offset += 1
    roots = forest.roots()
    below = np.flatnonzero(roots != np.arange(len(names)))
    return names[below], names[roots[below]]


def near_links(distinct: DataFrame, blocks: int, widths: tuple[int, ...] = BLOCKS, distance: int = DISTANCE) -> DataFrame:
    """``u, v``: edges between the distinct fingerprints ``fp`` whose components are those of all links.

    ``widths`` are of ``distance + 2`` blocks.
    """

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy()
            keys = cells(pivot_table(fps.view(np.uint64), ROUTING, widths), ROUTING, distance)
            block = ((keys >> np.uint64(20)) % np.uint64(blocks)).astype(np.int32)
            yield pa.record_batch(
                {"block": block.ravel(), "key": keys.view(np.int64).ravel(), "fp": np.repeat(fps, keys.shape[1])}
            )

    def block(table: pa.Table) -> pa.Table:
        key, fps = (table.column(c).to_numpy() for c in ("key", "fp"))
        u, v = links_in_cells(key, fps.view(np.uint64), distance)
        return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})

    routed = distinct.select("fp").mapInArrow(route, "block int, key long, fp long")
    return routed.groupBy("block").applyInArrow(block, "u long, v long")


def near_classes(docs: DataFrame, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """``doc, tag, fp`` of each row, and ``fp, least, root``: the class of each fingerprint and the first row with it."""
    rows = saved(fingerprints(docs, shingle))
    distinct = saved(rows.groupBy("fp").agg(F.min(F.struct("doc", "tag")).alias("least")))
    roots = components(near_links(distinct, max(LEAST_BLOCKS, blocks_for(docs))))
    classes = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return rows, saved(classes)


def near_components(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint, component_id``: classes of documents linked at 3 differing bits or fewer.

    ``fingerprint`` is written as 16 hex digits.  ``component_id`` is the least doc_id of the class.
    Null texts and texts without words have fingerprint zero and are linked like any other; null ids take part,
    are returned as null, and name a class (as null) only if it has no other id; repeated rows stay rows.
    An empty table gives no rows.
    """
    rows, classes = near_classes(docs, shingle)
    least = classes.groupBy("root").agg(F.min("least.doc").alias("component"))
    named = classes.join(least, "root").select("fp", "component")
    return rows.join(named, "fp").select(
        public_id(),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("component") != NO_ID, F.col("component")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that stand for their near-duplicate class: of each class the first by doc_id, then by hash of the text.

    ``classes`` are those of :func:`near_classes` unless given in the same form.  Null ids stand after all others.  Every class keeps one row, with or without ids, and also where an id is
    shared with another class.  All columns are kept as they are.
    """
    classes = near_classes(docs)[1] if classes is None else classes
    doc, tag = unused(docs, "_doc", "_tag")
    keep = classes.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.doc").alias(doc), F.col("least.tag").alias(tag))
    rows = docs.withColumns({doc: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), tag: F.xxhash64("text")})
    # rows that share id and text are one class, of which partial aggregates keep one
    return rows.join(keep, [doc, tag], "left_semi").dropDuplicates([doc, tag]).select(*docs.columns)
