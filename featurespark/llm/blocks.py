"""Exchange of packed records: scattered to blocks by key, resolved there, and answered by document.

Hashes of windows are too many for a row each.  A map task gathers them as columns, resolves what it can
among its own records, and sends the rest as one compressed blob for each block; so a key that a third
of all documents share reaches its block once from each task, not once from each document.  A block resolves
all records of its keys and answers with one row for each *run* of a document, which is what shares an anchor; so the
answers grow with the input alone, and not with the number of blocks.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import mix, runs
from .support import block_count

Records = dict[str, np.ndarray]
#: Bytes of records that a map task gathers before it sends them.
FLUSH = 24 << 20
#: Bytes of input for each block.
BLOCK_BYTES, LEAST_BLOCKS = 16 << 20, 12
PACKED = "block int, settled boolean, blob binary"
ANSWER = "doc long, tag long, found binary"


def pack(records: Records) -> bytes:
    columns = dict(records)
    columns["doc"] = np.diff(columns["doc"], prepend=np.int64(0))
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(columns, 5))


def unpack(blobs: Iterable[bytes]) -> Records:
    parts = [pickle.loads(zstandard.ZstdDecompressor().decompress(b)) for b in blobs]
    for p in parts:
        p["doc"] = np.cumsum(p["doc"])
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}


def take(records: Records, at: np.ndarray) -> Records:
    return {k: v[at] for k, v in records.items()}


def distinct(records: Records) -> Records:
    """One record for each place (and span of it): rows of equal id and text send the same ones.  Sorted by run and place."""
    names = [k for k in ("doc", "tag", "run", "pos", "from") if k in records]
    records = take(records, np.lexsort([records[k] for k in reversed(names)]))
    return take(records, runs(*[records[k] for k in names])[:-1])


def scatter(
    df: DataFrame, read: Callable[[pa.RecordBatch], Iterator[Records]], combine: Callable[[Records], tuple[Records, Records]], blocks: int
) -> DataFrame:
    """Rows ``block, blob``.  ``combine`` parts a task's records into those to send by ``deal`` and those settled.

    Settled records go to a block that their document decides.
    """

    def send(parts: list[Records]) -> Iterator[pa.RecordBatch]:
        records = distinct({k: np.concatenate([p[k] for p in parts]) for k in parts[0]})
        parts.clear()
        for done, some in zip((False, True), combine(records), strict=True):
            deal = some.pop("deal")
            if done:
                deal = mix(some["doc"].astype(np.uint64) ^ some["tag"].view(np.uint64))
            to = (deal >> np.uint64(20)) % np.uint64(blocks)
            order = np.lexsort((some["pos"], some["tag"], some["doc"], to))  # by place, which packs well
            to, some = to[order], take(some, order)
            edges = runs(to)
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                blob = pack({k: v[lo:hi] for k, v in some.items()})
                yield pa.record_batch(
                    {"block": pa.array([int(to[lo])], pa.int32()), "settled": pa.array([done]), "blob": pa.array([blob], pa.binary())}
                )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for records in read(batch):
                if len(records["doc"]):
                    parts.append(records)
                    held += sum(v.nbytes for v in records.values())
                if held >= FLUSH:
                    yield from send(parts)
                    held = 0
        if parts:
            yield from send(parts)

    return df.mapInArrow(task, PACKED)


def _binary(rows: np.ndarray, edges: np.ndarray) -> pa.Array:
    """``rows[edges[i]:edges[i + 1]]`` as the bytes of value ``i``."""
    rows = np.ascontiguousarray(rows)
    width = rows.itemsize * (rows.shape[1] if rows.ndim > 1 else 1)
    offsets = (edges * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(rows.view(np.uint8).reshape(-1))])


def resolve(packed: DataFrame, settle: Callable[[Records], Records], code: Callable[[Records], tuple[Records, np.ndarray]]) -> DataFrame:
    """``doc, tag, found``: for each document and ``run``, what ``code`` makes of the records that ``settle`` keeps, as bytes.

    ``code`` gets them sorted by place and returns records and a row of numbers for each.
    """

    def block(table: pa.Table) -> pa.Table:
        done, kept = table.column("settled").to_numpy(), []
        for settled in (True, False):
            part = table.column("blob").filter(pa.array(done == settled))
            if len(part):
                records = unpack(x.as_py() for x in part)
                kept.append(records if settled else settle(records))
        records = {k: np.concatenate([x.pop(k) for x in kept]) for k in set(kept[0]).intersection(*kept)}
        records, rows = code(distinct(records))
        edges = runs(records["doc"], records["tag"], records["run"])
        first = edges[:-1]
        columns = [pa.array(records["doc"][first], pa.int64()), pa.array(records["tag"][first], pa.int64()), _binary(rows, edges)]
        return pa.table(columns, names=["doc", "tag", "found"])

    return packed.groupBy("block").applyInArrow(block, ANSWER)


def answered(rows: DataFrame, answers: DataFrame) -> DataFrame:
    """``rows`` with ``found``: the list of what the blocks said of each document, or null."""
    mine = answers.groupBy("doc", "tag").agg(F.collect_list("found").alias("found"))
    return rows.join(mine, ["doc", "tag"], "left")


def joined(found: pa.Array, i: int, dtype, width: int) -> np.ndarray:
    """The rows for document ``i`` of a batch, ``width`` values each."""
    parts = found[i].as_py()
    data = b"".join(parts) if parts else b""
    return np.frombuffer(data, dtype).reshape(-1, width)


def blocks_for(docs: DataFrame) -> int:
    return block_count(docs, BLOCK_BYTES, LEAST_BLOCKS)
