"""Near-duplicate classes of an exact similarity: the Jaccard likeness of the sets of word shingles.

Pairs are proposed by SimHash, as :mod:`.simhash` does: fingerprints of the shingles that differ in ``DISTANCE`` bits or fewer meet in
cells of equal distances to pivots, and pivots and bits discard what is further apart.  At a likeness of 0.8 some ten of 64 bits
differ, more than blocks of bits can be equal around; so what SimHash can't reach is proposed by minima of hashed
shingles, in bands of ``BAND``: of ``BANDS`` bands, a pair at the bound shares none with a chance of 5 in a million.  What is
proposed together, directly or through others, is a *crowd*; the sets of a crowd are brought together once, and there every link is
counted exactly, whichever way proposed it.  A crowd of more than ``CROWD`` shingles is dealt into parts of about that size, and every
two parts meet in a task of their own; so a task's memory is bounded, whatever the crowd, and no link is lost.  A band key that many texts share is
linked where it is made, and reaches its block once from each flush of a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import LEAST_BLOCKS, blocks_for
from .components import components
from .kernels import Chunk, chunks, find_words, mix, runs, span_hashes, window_starts, word_hashes
from .simhash import Forest, chunk_fingerprints, lowered, near_links
from .support import keyed, saved

#: Words of a shingle, and the likeness of a link, as a fraction.
SHINGLE, LIKENESS = 5, (4, 5)
#: Bits in which fingerprints of proposed pairs may differ, and the blocks of bits for that, two of which stay equal.
DISTANCE, BLOCKS = 5, (9, 9, 9, 9, 9, 9, 10)
#: Bands of a signature, and the minima in each.
BANDS, BAND = 40, 6
#: Shingles of a crowd that are compared in one task, or of a part of a larger one; and band keys that a task links at a time.
CROWD, KEYS = 1 << 22, 1 << 19

_MIXED = mix(np.arange(1, BANDS * BAND + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
#: The hash functions of the minima: odd factors and summands modulo 2**32.
FACTORS, SUMMANDS = (_MIXED >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (_MIXED & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def shingles(chunk: Chunk, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each document's shingles, each document's first of them (then the end), and a hash of all its words.

    A text of fewer words has one shingle of them all, and one without words none, and 0 for all its words.
    """
    chunk = lowered(chunk)
    words = find_words(chunk)
    hashes = word_hashes(chunk, words)
    lo, hi = words.first[:-1], words.first[1:]
    short = lo[(hi > lo) & (hi - lo < size)]
    ends = hi[(hi > lo) & (hi - lo < size)]
    starts = np.r_[window_starts(words.first, size), short]
    ends = np.r_[starts[: len(starts) - len(short)] + size, ends]
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    whole = np.where(hi > lo, span_hashes(hashes, lo, hi), np.uint64(0))
    return span_hashes(hashes, starts, ends), np.searchsorted(starts, words.first), whole


def bands(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The band keys of each document, a row each; rows of documents without shingles are zero."""
    out = np.zeros((len(first) - 1, BANDS), np.uint64)
    full = np.flatnonzero(np.diff(first) > 0)
    if not len(full):
        return out
    short, at = (hashes >> np.uint64(32)).astype(np.uint32), first[full]
    for band in range(BANDS):
        key = np.full(len(full), band + 1, np.uint64)
        for k in range(band * BAND, (band + 1) * BAND):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(short * FACTORS[k] + SUMMANDS[k], at))
        out[full, band] = key
    return out


def crowd_roots(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The least member of each member's class, where members are linked at ``LIKENESS`` or more.

    Member ``i`` has the distinct shingles ``values[first[i]:first[i + 1]]``.  A member is compared with all that share a
    shingle with it, through lists of members by shingle.  The one whose shingles are the most common comes first, and
    members of the largest class never need to, since all others are compared with them.
    """
    n, size = len(first) - 1, np.diff(first)
    part, whole = LIKENESS
    order = np.argsort(values, kind="stable")
    edges = runs(values[order])
    name = np.empty(len(values), np.int64)
    name[order] = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    who = np.repeat(np.arange(n), size)[order]
    times = np.diff(edges)
    common = np.bincount(np.repeat(np.arange(n), size), times[name], n) / np.maximum(size, 1)
    root, todo = np.arange(n), np.ones(n, bool)
    members = np.ones(n, np.int64)
    order, more = np.argsort(-common, kind="stable").tolist(), True
    while more:
        more = False
        for c in order:
            largest = int(members.argmax())
            if members[largest] == n:
                return root
            if not todo[c] or (root[c] == largest and members[largest] > 1):
                continue
            todo[c], more = False, True
            own = name[first[c] : first[c + 1]]
            lo, count = edges[own], times[own]
            at = np.repeat(lo - np.cumsum(count) + count, count) + np.arange(count.sum())
            shared = np.bincount(who[at], minlength=n)
            near = (shared > 0) & (shared * whole >= part * (size + size[c] - shared))
            old = np.unique(root[near])
            root[np.isin(root, old)] = old[0]
            members[old[0]] = members[old].sum()
            members[old[1:]] = 0
    return root


def _signatures(docs: DataFrame, size: int) -> DataFrame:
    """``doc, tag, fp, n, sim, bands``: ``fp`` is a hash of all words, so rows of equal words are one node from the start.

    ``n`` is the number of shingles, repeats included, and ``sim`` their SimHash.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                hashes, first, whole = shingles(chunk, size)
                keys = bands(hashes, first).view(np.int64).ravel()
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(whole) + 1, dtype=np.int32) * BANDS), pa.array(keys))
                columns = {c: batch.column(c).slice(chunk.lo, chunk.hi - chunk.lo) for c in ("doc", "tag")}
                sims = pa.array(chunk_fingerprints(chunk, size).view(np.int64))
                yield pa.record_batch(columns | {"fp": pa.array(whole.view(np.int64)), "n": pa.array(np.diff(first)), "sim": sims, "bands": lists})

    return keyed(docs).mapInArrow(task, "doc long, tag long, fp long, n long, sim long, bands array<long>")


def linked_by_key(key: np.ndarray, fp: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of equal key are linked, and each ``fp`` with its ``head``: one row for each key, and members below their root with it."""
    names, node = np.unique(np.r_[fp, head], return_inverse=True)
    node, up = node[: len(fp)], node[len(fp) :]
    order = np.argsort(key, kind="stable")
    edges = runs(key[order])
    node = node[order]
    forest = Forest(len(names))
    forest.link(node, up[order])
    forest.link(np.repeat(node[edges[:-1]], np.diff(edges)), node)
    roots = forest.roots()
    below = np.flatnonzero(roots != np.arange(len(names)))
    return order[edges[:-1]], names[below], names[roots[below]]


def _near(distinct: DataFrame, blocks: int) -> DataFrame:
    """``u, v``: links of nodes by their SimHash, through the least node of each fingerprint."""
    some = distinct.filter("fp <> 0").select("fp", "sim")
    heads = saved(some.groupBy("sim").agg(F.min("fp").alias("head")))
    links = near_links(heads.select(F.col("sim").alias("fp")), blocks, BLOCKS, DISTANCE)
    for end in ("u", "v"):
        links = links.join(heads.withColumnRenamed("sim", end), end).drop(end).withColumnRenamed("head", f"{end}_head")
    same = some.join(heads, "sim").filter("fp <> head").select(F.col("fp").alias("u"), F.col("head").alias("v"))
    return links.select(F.col("u_head").alias("u"), F.col("v_head").alias("v")).unionByName(same)


def _crowds(distinct: DataFrame, blocks: int, most: int = KEYS) -> DataFrame:
    """``node, root``: nodes that are near by SimHash or share a band, directly or through others."""

    def send(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        key, fp = (np.concatenate(x) for x in zip(*parts, strict=True))
        one, u, v = linked_by_key(key, fp, fp)
        # a link is a key of its own, which it shares with nothing but itself
        key = np.r_[key[one], mix(u.view(np.uint64)).view(np.int64)]
        block = ((key.view(np.uint64) >> np.uint64(20)) % np.uint64(blocks)).astype(np.int32)
        return pa.record_batch({"block": block, "key": key, "fp": np.r_[fp[one], u], "head": np.r_[fp[one], v]})

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            parts.append((batch.column("bands").flatten().to_numpy(), np.repeat(batch.column("fp").to_numpy(), BANDS)))
            held += len(parts[-1][0])
            if held >= most:
                yield send(parts)
                parts, held = [], 0
        if held:
            yield send(parts)

    def block(table: pa.Table) -> pa.Table:
        _, u, v = linked_by_key(*(table.column(c).to_numpy() for c in ("key", "fp", "head")))
        return pa.table({"u": u, "v": v})

    keys = distinct.filter("fp <> 0").select("fp", "bands").mapInArrow(task, "block int, key long, fp long, head long")
    banded = keys.groupBy("block").applyInArrow(block, "u long, v long")
    return components(_near(distinct, blocks).unionByName(banded))


def jaccard_classes(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``fp, least, root``: the class of each distinct text, and the first row (``doc, tag``) with it.

    Texts are linked where the sets of their ``size``-word shingles, in ASCII lower case, have a likeness of 0.8 or more.
    Texts without words are one class.
    """
    blocks = max(LEAST_BLOCKS, blocks_for(docs))
    rows = saved(_signatures(docs, size))
    firsts = [F.min(F.struct("doc", "tag")).alias("least"), *(F.first(c).alias(c) for c in ("n", "sim", "bands"))]
    distinct = saved(rows.groupBy("fp").agg(*firsts))
    crowds = saved(distinct.join(_crowds(distinct, blocks).withColumnRenamed("node", "fp"), "fp").select("fp", "root", "least", "n"))
    parts = crowds.groupBy("root").agg(F.ceil(F.sum("n") / F.lit(CROWD)).cast("int").alias("parts")).filter("parts > 1")
    wanted = crowds.join(parts, "root", "left").select("fp", "root", F.coalesce("parts", F.lit(1)).alias("parts"), "least.*")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                hashes, first, _ = shingles(chunk, size)
                found = [np.unique(hashes[a:b]).tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
                columns = {c: batch.column(c).slice(chunk.lo, chunk.hi - chunk.lo) for c in ("fp", "root", "parts")}
                yield pa.record_batch(columns | {"own": pa.array(found, pa.binary())})

    def block(table: pa.Table) -> pa.Table:
        cell, fp = (table.column(c).to_numpy() for c in ("cell", "fp"))
        own = table.column("own").combine_chunks()
        order = np.lexsort((fp, cell))
        order = order[runs(cell[order], fp[order])[:-1]]  # rows that repeat are one member
        cell, fp = cell[order], fp[order]
        edges = runs(cell)
        out = fp.copy()
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            own_sets = [np.frombuffer(own[i].as_py(), np.uint64) for i in order[a:b].tolist()]
            first = np.r_[0, np.cumsum([len(p) for p in own_sets])]
            out[a:b] = fp[a:b][crowd_roots(np.concatenate(own_sets), first)]
        return pa.table({"fp": fp, "class": out, "split": table.column("split").take(pa.array(order))})

    texts = keyed(docs).join(wanted, ["doc", "tag"]).select("fp", "root", "parts", "text")
    held = texts.mapInArrow(sets, "fp long, root long, parts int, own binary").withColumn("split", F.expr("parts > 1"))
    # a part meets each other part in a cell of the two
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    others = F.expr("if(split, filter(sequence(0, parts - 1), q -> q <> part), array(0))")
    held = held.withColumn("part", part).withColumn("other", F.explode(others))
    two = F.xxhash64("root", F.least("part", "other"), F.greatest("part", "other"))
    held = held.withColumn("cell", F.when(F.col("split"), two).otherwise(F.col("root")))
    held = held.withColumn("block", F.when(F.col("split"), two).otherwise(F.pmod(F.xxhash64("root"), F.lit(blocks))))
    members = held.select("block", "cell", "split", "fp", "own").groupBy("block")
    exact = saved(members.applyInArrow(block, "fp long, class long, split boolean"))
    across = components(exact.filter("split").select(F.col("fp").alias("u"), F.col("class").alias("v")))
    roots = exact.filter("not split").select("fp", "class").unionByName(across.select(F.col("node").alias("fp"), F.col("root").alias("class")))
    return distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("class", "fp").alias("root"))
