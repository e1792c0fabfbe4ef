"""Byte-exact substring dedup over sorted suffixes, by deep-shallow sorting.

Every string of ``length`` bytes that starts at two places is found where the suffixes of those places
are neighbours in sorted order with a common prefix of at least ``length`` bytes.  Sorting all suffixes of a
corpus is not needed for that.  Window starts are put in *stretches* of up to 64 whose windows share a
*core*, all but the 63 bytes at either side.  Stretches are laid out from content-chosen anchors, so equal windows have
equal cores at the same distance, and an anchor that occurs once rules out all of its stretches.

What is left is brought together in blocks by anchor and sorted there, twice.  First the stretches of each core, by the bytes
around it: equal neighbours are one *variant*, which is sorted as one row from there on, with the number of its
places.  Then the suffixes at the window starts of all variants of a core; a window repeats where a neighbour in that order is
equal, or where its variant has several places.  Both sorts are :func:`deep_shallow`: a three-way multikey quicksort
over the first ``SHALLOW`` bytes, eight at a time, and blind tries for groups that agree to that depth.  The core is
equal within a group, so comparisons step over it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import ANSWER, Records, answered, blocks_for, joined, resolve, scatter, take
from .kernels import Chunk, anchors, byte_codes, chunks, covered, gram_hashes, runs, span_hashes, window_starts
from .substring import live_anchors, row_ids, row_records, shared_anchors
from .support import keyed, public_id

LENGTH = 400
#: Bytes of an anchor gram, window starts in a stretch, and the depth of the multikey quicksort.
GRAM, STRETCH, SHALLOW = 24, 64, 16
#: Windows sorted at a time, or those of one core and place if they are more.
WINDOWS = 1 << 17


class BlindTrie:
    """Order of equal-length strings by a trie that keeps only the places where they branch.

    An insertion first goes down by the branching bytes alone, whatever lies between (blindly), compares once with the leaf
    that it meets, and then hangs the new leaf where the two part.
    """

    def __init__(self) -> None:
        self.root: list | None = None

    def insert(self, text: bytes, name: int) -> None:
        if self.root is None:
            self.root = [text, [name]]
            return
        node = self.root
        while len(node) == 3:
            node = node[2].get(text[node[0]]) or next(iter(node[2].values()))
        other = node[0]
        if other == text:
            node[1].append(name)
            return
        depth = next(i for i, (a, b) in enumerate(zip(text, other, strict=True)) if a != b)
        above, node = None, self.root
        while len(node) == 3 and node[0] < depth:
            above, node = node, node[2][text[node[0]]]
        leaf = [text, [name]]
        if len(node) == 3 and node[0] == depth:
            node[2][text[depth]] = leaf
            return
        fork = [depth, 0, {text[depth]: leaf, other[depth]: node}]
        if above is None:
            self.root = fork
        else:
            above[2][text[above[0]]] = fork

    def order(self) -> list[list[int]]:
        """Names by string, ascending; names of equal strings stand together."""
        out, stack = [], [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if len(node) == 2:
                out.append(node[1])
            else:
                stack += [node[2][k] for k in sorted(node[2], reverse=True)]
        return out


def shallow_sort(words: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Three-way multikey quicksort of the rows of each group by their machine words: the order, and where tied runs start.

    All segments take a step at once.  A segment is parted around the median of three of its words at its own depth; rows
    below and above the median go on at that depth, and those equal to it one word deeper.
    """
    n, depths = words.shape
    order = np.argsort(group, kind="stable")
    bound = np.zeros(n + 1, bool)
    bound[runs(group[order])] = True
    depth = np.zeros(n, np.int64)
    active = np.arange(n)
    while len(active):
        name = np.cumsum(bound[:-1])[active]
        edges = runs(name)
        size = np.diff(edges)
        keep = np.repeat(size > 1, size) & (depth[active] < depths)
        active, name = active[keep], name[keep]
        if not len(active):
            break
        edges = runs(name)
        first, size = edges[:-1], np.diff(edges)
        value = words[order[active], depth[active]]
        three = np.sort(np.stack([value[first], value[first + size // 2], value[first + size - 1]]), axis=0)
        middle = np.repeat(three[1], size)
        side = (value >= middle).astype(np.int64) + (value > middle)
        inner = np.argsort(np.repeat(np.arange(len(size)), size) * 3 + side, kind="stable")
        order[active], side = order[active[inner]], side[inner]
        bound[active[1:]] |= (side[1:] != side[:-1]) | (name[1:] != name[:-1])
        depth[active] += side == 1
    return order, bound


def deep_shallow(strings: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort the rows of a byte matrix within their groups: the order (stable), and which rows equal the one before.

    Quicksort goes to ``SHALLOW`` bytes.  Groups still tied there are ordered by blind tries; a trie of two leaves
    is one comparison, so all pairs are compared at once.
    """
    n, width = strings.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = strings
    words = padded.view(">u8").astype(np.uint64)
    del padded
    order, bound = shallow_sort(words[:, : SHALLOW // 8], group)
    equal = np.zeros(n, bool)
    edges = np.flatnonzero(bound)
    size = np.diff(edges)
    two = edges[:-1][size == 2]
    for lo in range(0, len(two), WINDOWS):
        at = two[lo : lo + WINDOWS]
        a, b = order[at], order[at + 1]
        deep, other = words[a, SHALLOW // 8 :], words[b, SHALLOW // 8 :]
        differs = deep != other
        some, column = differs.any(axis=1), differs.argmax(axis=1)
        equal[at + 1] = ~some
        every = np.arange(len(at))
        swap = some & (deep[every, column] > other[every, column])
        order[at[swap]], order[at[swap] + 1] = b[swap], a[swap]
    del words
    for lo, m in zip(edges[:-1][size > 2].tolist(), size[size > 2].tolist(), strict=True):
        trie = BlindTrie()
        rows = order[lo : lo + m]
        for name in rows.tolist():
            trie.insert(strings[name, SHALLOW:].tobytes(), name)
        at = lo
        for names in trie.order():
            order[at : at + len(names)] = names
            equal[at + 1 : at + len(names)] = True
            at += len(names)
    return order, equal


def _stretches(chunk: Chunk, length: int) -> tuple[np.ndarray, ...]:
    """Document, first and last window start, core start and anchor of each stretch, and the hashes of the anchor grams."""
    empty = np.zeros(0, np.int64)
    starts = window_starts(chunk.offsets, length)
    if not len(starts):
        return empty, empty, empty, empty, empty, empty.astype(np.uint64)
    gram = min(GRAM, length)
    grams = gram_hashes(byte_codes(chunk.buf), gram)
    at = anchors(grams, length - gram + 1)[starts]
    doc = np.repeat(np.arange(len(chunk.offsets) - 1), np.maximum(np.diff(chunk.offsets) - length + 1, 0))
    part = (at - starts) // STRETCH
    edges = runs(doc, at, part)
    first, last = edges[:-1], edges[1:] - 1
    return doc[first], starts[first], starts[last], at[first] - part[first] * STRETCH, at[first], grams


def _sides(buf: np.ndarray, start: np.ndarray, end: np.ndarray, align_right: bool) -> np.ndarray:
    """Bytes ``start:end`` of each row as a matrix, flush with the core's side, zero elsewhere."""
    width = STRETCH - 1
    k = np.arange(width)
    at = (end[:, None] - width + k) if align_right else (start[:, None] + k)
    inside = (at >= start[:, None]) & (at < end[:, None])
    return np.where(inside, buf[np.clip(at, 0, max(len(buf) - 1, 0))], 0).astype(np.uint8)


def _slices(group: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Whole groups of a sorted key, about ``most`` rows at a time."""
    edges, lo = runs(group), 0
    while lo < len(group):
        hi = int(edges[np.searchsorted(edges, min(lo + most, len(group)))])
        yield lo, hi
        lo = hi


def variants(records: Records) -> tuple[Records, np.ndarray, np.ndarray]:
    """Records sorted by core, then by the bytes around it; the runs of equal stretches, and each record's group by core."""
    records = take(records, np.lexsort((records["pos"], records["tag"], records["doc"], records["key2"], records["key"])))
    cores = runs(records["key"], records["key2"])
    group = np.repeat(np.arange(len(cores) - 1), np.diff(cores))
    order, equal = np.arange(len(group)), np.zeros(len(group), bool)
    for lo, hi in _slices(group, WINDOWS):
        both = [records[k][lo:hi] for k in ("left", "right")]
        sides = np.concatenate([*both, np.stack([records[k][lo:hi] for k in ("n_left", "n_right")], axis=1)], axis=1)
        at, equal[lo:hi] = deep_shallow(sides, group[lo:hi])
        order[lo:hi] = lo + at
    return take(records, order), np.r_[np.flatnonzero(~equal), len(equal)], group


def _span(records: Records) -> None:
    """Let ``from`` and ``count`` name all windows of each stretch."""
    n = records["n_left"].astype(np.int64)
    records["from"], records["count"] = records["pos"] - n, np.minimum(n, records["n_right"] + n - STRETCH + 1) + 1


def repeated_stretches(records: Records) -> tuple[Records, Records]:
    """Combine of a task: equal stretches prove each other's windows, and one of them tells the block."""
    records, edges, _ = variants(records)
    times = np.repeat(np.diff(edges), np.diff(edges))
    records["known"] = times > 1
    _span(records)
    send = times == 1
    send[edges[:-1]] = True
    # the block needs no bytes of what is settled
    return take(records, send), take({k: v for k, v in records.items() if k not in ("left", "right")}, times > 1)


def _starts(records: Records) -> tuple[np.ndarray, np.ndarray]:
    """Each window of each stretch: the record, and how many bytes lie before the core."""
    low = np.maximum(STRETCH - 1 - records["n_right"].astype(np.int64), 0)
    count = np.maximum(records["n_left"].astype(np.int64) - low + 1, 0)
    row = np.repeat(np.arange(len(count)), count)
    return row, low[row] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)


def proved_windows(one: Records, group: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of one stretch for each variant, the windows that occur again: the stretch, and the bytes before the core.

    All windows of cores with several variants are sorted, a whole number of cores at a time.
    """
    crowd = np.bincount(group)[group] > 1
    found = [np.zeros((0, 2), np.int64)]
    alone = np.flatnonzero(known & ~crowd)
    if len(alone):
        row, before = _starts(take(one, alone))
        found.append(np.stack([alone[row], before], axis=1))
    asked = np.flatnonzero(crowd)
    for lo, hi in _slices(group[asked], WINDOWS // STRETCH):
        part = asked[lo:hi]
        own = take(one, part)
        row, before = _starts(own)
        both = np.concatenate([own["left"], own["right"]], axis=1).ravel()
        key = (group[part] - group[part[0]])[row] * STRETCH + before
        at = np.argsort(key, kind="stable")
        for a, b in _slices(key[at], WINDOWS):
            some = at[a:b]
            # a window without its core: the last `before` bytes of the left side, then the first of the right side
            begin = row[some] * (2 * (STRETCH - 1)) + STRETCH - 1 - before[some]
            strings = np.empty((len(some), STRETCH - 1), np.uint8)
            for k in range(STRETCH - 1):
                strings[:, k] = both[begin + k]
            order, equal = deep_shallow(strings, key[some])
            again = equal | known[part][row[some[order]]]
            again[:-1] |= equal[1:]
            good = some[order[again]]
            found.append(np.stack([part[row[good]], before[good]], axis=1))
    rows = np.concatenate(found)
    return rows[:, 0], rows[:, 1]


def sort_stretches(records: Records) -> Records:
    """Settle of a block: sort the stretches of each core and the windows of its variants; runs of windows that occur again.

    The records must not say more of one variant than one of each task does.
    """
    records, edges, group = variants(records)
    head, times = edges[:-1], np.diff(edges)
    known = np.maximum.reduceat(records["known"], head) | (times > 1) if len(head) else np.zeros(0, bool)
    row, before = proved_windows(take(records, head), group[head], known) if len(head) else (head, head)
    order = np.lexsort((-before, row))
    row, before = row[order], before[order]
    jump = np.ones(len(row), bool)
    jump[1:] = (np.diff(row) != 0) | (np.diff(before) != -1)
    first = np.flatnonzero(jump)
    length = np.diff(np.r_[first, len(row)])
    span_of, span_before = row[first], before[first]
    # the spans of a variant hold at each of its places
    variant = np.repeat(np.arange(len(head)), times)
    lo, hi = np.searchsorted(span_of, variant), np.searchsorted(span_of, variant, "right")
    count = hi - lo
    record = np.repeat(np.arange(len(variant)), count)
    span = np.repeat(lo - np.cumsum(count) + count, count) + np.arange(count.sum())
    out = take({k: v for k, v in records.items() if k not in ("left", "right")}, record)
    out["from"], out["count"] = out["pos"] - span_before[span], length[span]
    return out


def _spans(records: Records) -> tuple[Records, np.ndarray]:
    return records, np.stack([records["from"], records["count"]], axis=1).astype(np.int64)


def suffix_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc, tag, text, found``: for each document, runs of window starts whose window occurs elsewhere too."""
    if length < 2 * STRETCH:
        raise ValueError(f"windows must have {2 * STRETCH} bytes at least")
    rows = keyed(docs)
    blocks = blocks_for(docs)
    core = length - STRETCH + 1

    def read_anchors(batch: pa.RecordBatch) -> Iterator[Records]:
        doc, tag = row_ids(batch)
        for chunk in chunks(batch.column("text")):
            row, _, _, _, at, grams = _stretches(chunk, length)
            one = runs(at)[:-1]
            row, at = row[one], at[one]
            key = grams[at]
            yield row_records(doc, tag, chunk, row, key=key, deal=key, pos=at - chunk.offsets[row])

    def read_sides(batch: pa.RecordBatch) -> Iterator[Records]:
        doc, tag = row_ids(batch)
        found = batch.column("found")
        for chunk in chunks(batch.column("text")):
            row, first, last, at, anchor, grams = _stretches(chunk, length)
            live = np.zeros(len(chunk.buf) + 1, bool)
            for i in range(chunk.hi - chunk.lo):
                live[chunk.offsets[i] + joined(found, chunk.lo + i, np.int64, 1)[:, 0]] = True
            some = live[anchor]
            row, first, last, at, anchor = (x[some] for x in (row, first, last, at, anchor))
            key, key2 = (span_hashes(byte_codes(chunk.buf, s), at, at + core, s) for s in (0, 1))
            left = _sides(chunk.buf, first, at, True)
            right = _sides(chunk.buf, at + core, last + length, False)
            start = chunk.offsets[row]
            columns = {"key": key, "key2": (key2 >> np.uint64(32)).astype(np.uint32), "pos": at - start, "run": anchor - start}
            columns |= {"left": left, "right": right, "n_left": (at - first).astype(np.uint8), "n_right": (last + length - at - core).astype(np.uint8)}
            yield row_records(doc, tag, chunk, row, **columns, deal=grams[anchor])

    anchors_of = partial(live_anchors, places=True), partial(shared_anchors, places=True)

    def anchor_rows(records: Records) -> tuple[Records, np.ndarray]:
        records["run"] = records["pos"]
        return records, records["pos"].astype(np.int64)

    live = resolve(scatter(rows, read_anchors, anchors_of[0], blocks), anchors_of[1], anchor_rows)
    asked = answered(rows, live).filter(F.col("found").isNotNull())
    found = resolve(scatter(asked, read_sides, repeated_stretches, blocks), sort_stretches, _spans)
    return answered(rows, found.unionByName(_twins(docs, length)))


def _twins(docs: DataFrame, length: int) -> DataFrame:
    """Answers for rows of equal id and text, which count as one place elsewhere: all of their windows repeat."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = batch.column("size").to_numpy().astype(np.int64) - length + 1
            found = pa.array([row.tobytes() for row in np.stack([np.zeros_like(count), count], axis=1)], pa.binary())
            yield pa.record_batch({"doc": batch.column("doc"), "tag": batch.column("tag"), "found": found})

    sizes = keyed(docs).groupBy("doc", "tag").agg(F.count("*").alias("times"), F.max(F.octet_length("text")).alias("size"))
    return sizes.filter(f"times > 1 and size >= {length}").select("doc", "tag", "size").mapInArrow(task, ANSWER)


def dedup_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Remove every byte that a string of ``length`` bytes covers which also starts anywhere else.

    Returns ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``; ``n_spans`` counts maximal removed runs.  All copies go, in the
    same document too, and overlapping ones count; strings are judged on the input and never cross
    documents.  A null text is empty, a null id is returned as null, repeated rows repeat each other, texts of
    any length are taken whole, and an empty table gives no rows.  ``kept`` need not be valid UTF-8, so it
    is returned by its hash alone.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, out = batch.column("found"), []
            for chunk in chunks(batch.column("text")):
                for i in range(chunk.hi - chunk.lo):
                    text = chunk.buf[chunk.offsets[i] : chunk.offsets[i + 1]]
                    spans = joined(found, chunk.lo + i, np.int64, 2)
                    gone = np.zeros(len(text), bool)
                    if len(spans):
                        gone = covered(spans[:, 0], spans[:, 1] + length - 1, len(text))
                    n_spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(text) else 0
                    out.append((len(text), int(gone.sum()), n_spans, hashlib.sha256(text[~gone].tobytes()).hexdigest()))
            if out:
                n, removed, n_spans, sha = zip(*out, strict=True)
                columns = {"doc": batch.column("doc"), "n_bytes": pa.array(n, pa.int64()), "n_removed": pa.array(removed, pa.int64())}
                yield pa.record_batch(columns | {"n_spans": pa.array(n_spans, pa.int64()), "kept_sha256": pa.array(sha)})

    schema = "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    result = suffix_spans(docs, length).mapInArrow(task, schema)
    return result.select(public_id(), *result.columns[1:])
