"""Substring dedup by relative Lempel-Ziv parsing against indexed reference blocks.

The reference of a document is every document with a smaller id.  Its phrases of ``length`` words are
indexed in blocks dealt by content: by the *anchor* of a phrase, of its shorter grams the one of least hash, which
equal phrases choose alike.  So a document asks only the blocks that could hold a phrase of its own, instead of each
block in turn.  An anchor that one document alone has proves that none of its windows repeats, and those
windows, most of all, are never sent.  The others are looked up in one batch: each gets the *place* of its
phrase, the first one in the index.  (Where a map task itself has the phrase in several documents, the first of these
serves as the place, so that a hot phrase reaches its block once from each task.)

The parse then goes greedily through a document.  A factor starts at the first word where a phrase has a place, and is
extended word by word while the reference goes on from that place, that is while the next phrase has the next place.
Where it ends, the parse starts again.  Factors don't overlap, and each is at least ``length`` words long; their
words are duplicate spans.  A phrase that begins within a factor and ends beyond it belongs to no factor; these are
checked at each factor's boundary, and those that have a place add their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import Records, answered, blocks_for, joined, resolve, scatter, take
from .kernels import Chunk, Words, anchors, chunks, covered, find_words, gram_hashes, runs, window_starts, word_hashes
from .support import keyed, public_id

LENGTH = 13
#: Words of an anchor gram.
GRAM = 6


def _windows(chunk: Chunk, length: int, salt: int = 0) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, their hashes, the anchor grams' hashes, the window starts and each window's anchor."""
    words = find_words(chunk)
    hashes = word_hashes(chunk, words, salt)
    gram = min(GRAM, length)
    grams = gram_hashes(hashes, gram, salt)
    starts = window_starts(words.first, length)
    return words, hashes, grams, starts, anchors(grams, length - gram + 1)[starts]


def row_ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("doc").to_numpy(zero_copy_only=False), batch.column("tag").to_numpy(zero_copy_only=False)


def row_records(doc: np.ndarray, tag: np.ndarray, chunk: Chunk, row: np.ndarray, **columns: np.ndarray) -> Records:
    row = row + chunk.lo
    return {"doc": doc[row], "tag": tag[row], **columns}


def _by_key(records: Records) -> Records:
    return take(records, np.lexsort((records["pos"], records["tag"], records["doc"], records["key"])))


def several(records: Records, places: bool) -> np.ndarray:
    """Mask of the records whose key more than one row has, or more than one place if ``places`` are to count.

    The records must be sorted by key, then row.
    """
    edges = runs(records["key"])
    if places:
        return np.repeat(np.diff(edges) > 1, np.diff(edges))
    row = np.zeros(len(records["key"]) + 1, np.int64)
    row[runs(records["key"], records["doc"], records["tag"])[:-1] + 1] = 1
    rows = np.cumsum(row)
    return np.repeat(rows[edges[1:]] - rows[edges[:-1]] > 1, np.diff(edges))


def live_anchors(records: Records, places: bool = False) -> tuple[Records, Records]:
    """Combine of a task: anchors that two of its rows share are settled, and one of each key tells its block."""
    records = _by_key(records)
    shared = several(records, places)
    records["ask"] = ~shared
    send = ~shared
    send[runs(records["key"])[:-1]] = True
    return take(records, send), take(records, shared)


def shared_anchors(records: Records, places: bool = False) -> Records:
    """Settle of a block: the records that ask, and whose key another row has too."""
    records = _by_key(records)
    edges = runs(records["key"])
    shared = several(records, places)
    told = np.zeros(len(records["key"]) + 1, np.int64)
    np.cumsum(~records["ask"], out=told[1:])
    told = np.repeat(told[edges[1:]] > told[edges[:-1]], np.diff(edges))
    return take(records, (shared | told) & records["ask"])


def anchor_places(records: Records) -> tuple[Records, np.ndarray]:
    records["run"] = records["pos"]
    return records, records["pos"].astype(np.int32)


def _first_places(records: Records) -> tuple[Records, np.ndarray]:
    """Records by phrase and place, with the first place as ``ref`` and ``ref_pos``; mask of the phrases' first document."""
    records = take(records, np.lexsort((records["pos"], records["tag"], records["doc"], records["key2"], records["key"])))
    edges = runs(records["key"], records["key2"])
    head, times = edges[:-1], np.diff(edges)
    records["ref"], records["ref_pos"] = np.repeat(records["doc"][head], times), np.repeat(records["pos"][head], times)
    return records, records["doc"] == records["ref"]


def _pieces(records: Records) -> tuple[Records, np.ndarray]:
    """Runs of windows whose places follow each other: ``start, windows, reference doc, reference start``."""
    ahead = np.arange(len(records["pos"]), dtype=np.int64)
    pos, ref_pos = records["pos"] - ahead, records["ref_pos"] - ahead
    edges = runs(records["doc"], records["tag"], records["run"], records["ref"], pos, ref_pos)
    first = edges[:-1]
    rows = np.stack([records["pos"][first], np.diff(edges), records["ref"][first], records["ref_pos"][first]], axis=1)
    return take(records, first), rows.astype(np.int64)


def rlz_places(docs: DataFrame, length: int = LENGTH, carry: tuple[str, ...] = ()) -> DataFrame:
    """Look the phrases of every document up among those of smaller ids: ``doc, tag, text``, the columns ``carry``, and ``found``.

    ``found`` holds, for :func:`factors`, the windows of a document that have a place, as rows of ``_pieces``.
    """
    rows = keyed(docs, *carry)
    blocks = blocks_for(docs)

    def read_anchors(batch: pa.RecordBatch) -> Iterator[Records]:
        doc, tag = row_ids(batch)
        for chunk in chunks(batch.column("text")):
            words, _, grams, _, at = _windows(chunk, length)
            at = at[runs(at)[:-1]] if len(at) else at
            row = words.doc[at]
            yield row_records(doc, tag, chunk, row, key=grams[at], deal=grams[at], pos=(at - words.first[row]).astype(np.int32))

    def read_windows(batch: pa.RecordBatch) -> Iterator[Records]:
        found = batch.column("found")
        doc, tag = row_ids(batch)
        for chunk in chunks(batch.column("text")):
            words, hashes, grams, starts, at = _windows(chunk, length)
            live = np.zeros(len(hashes) + 1, bool)
            for i in range(chunk.hi - chunk.lo):
                live[words.first[i] + joined(found, chunk.lo + i, np.int32, 1)[:, 0]] = True
            some = live[at]
            starts, at = starts[some], at[some]
            other = word_hashes(chunk, words, 1)
            row = words.doc[starts]
            key, key2 = (gram_hashes(h, length, s)[starts] for s, h in enumerate((hashes, other)))
            pos, run = ((x - words.first[row]).astype(np.int32) for x in (starts, at))
            yield row_records(doc, tag, chunk, row, key=key, key2=(key2 >> np.uint64(32)).astype(np.uint32), pos=pos, run=run, deal=grams[at])

    def first_windows(records: Records) -> tuple[Records, Records]:
        records, first = _first_places(records)
        send, settled = take(records, first), take(records, ~first)
        return send | {k: np.zeros_like(send[k]) for k in ("ref", "ref_pos")}, settled

    def later_windows(records: Records) -> Records:
        records, first = _first_places(records)
        return take(records, ~first)

    live = resolve(scatter(rows, read_anchors, live_anchors, blocks), shared_anchors, anchor_places)
    asked = answered(rows, live).filter(F.col("found").isNotNull())
    return answered(rows, resolve(scatter(asked, read_windows, first_windows, blocks), later_windows, _pieces))


def places_of(pieces: np.ndarray) -> np.ndarray:
    """``start, reference doc, reference start`` of every window of the pieces, in the order of the document."""
    times = pieces[:, 1]
    ahead = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    rows = np.repeat(pieces[:, [0, 2, 3]], times, axis=0)
    rows[:, 0] += ahead
    rows[:, 2] += ahead
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    return rows[runs(rows[:, 0])[:-1]]  # repeated rows of one text may have got different places


def factors(pieces: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """The parse of one document: factors ``start, words, reference doc, reference start``, and starts of phrases across their ends.

    ``pieces``: rows of ``_pieces``, in any order.
    """
    places = places_of(pieces)
    if not len(places):
        return np.zeros((0, 4), np.int64), np.zeros(0, np.int64)
    start = places[:, 0]
    step = np.diff(places, axis=0)
    goes_on = np.r_[(step[:, 0] == 1) & (step[:, 1] == 0) & (step[:, 2] == 1), False]
    ends = np.flatnonzero(~goes_on)
    found, across, i = [], [], 0
    while i < len(places):
        last = int(ends[np.searchsorted(ends, i)])
        end = int(start[last]) + length
        found.append((start[i], end - start[i], places[i, 1], places[i, 2]))
        i = int(np.searchsorted(start, end))
        across.append(start[last + 1 : i])
    return np.array(found, np.int64), np.concatenate(across)


def duplicate_words(pieces: np.ndarray, n: int, length: int = LENGTH) -> tuple[int, np.ndarray]:
    """The number of factors of a document of ``n`` words, and the mask of the words that they and the checks at their ends cover."""
    found, across = factors(pieces, length)
    spans = np.concatenate([found[:, :2], np.stack([across, np.full(len(across), length)], axis=1)])
    return len(found), covered(spans[:, 0], spans[:, 1], n)


def dedup_words(docs: DataFrame, length: int = LENGTH, carry: tuple[str, ...] = (), with_text: bool = False) -> DataFrame:
    """Remove the words of windows that start in a document with a smaller id.

    Returns ``doc_id, n_words, n_removed, n_factors, kept_sha256`` and, if asked, the columns ``carry`` and ``kept``: the
    text as it was if nothing was removed, else the kept words joined by one space.  The hash is always that of the joined words.
    A word is a run of other bytes than space and 0x09 to 0x0D.  Windows are judged on the input.  ``n_factors`` may depend on
    how the rows are dealt to tasks, since places may; the words removed don't.
    A document repeats nothing by itself, and rows that share an id don't count as each other's
    reference; a null id counts as larger than all others, so such rows lose what any document has, and is
    returned as null.  Null and empty texts have no words and the hash of the empty text.  Texts of any
    length are taken whole; an empty table gives no rows.
    """
    parsed = rlz_places(docs, length, carry)
    fields = [f for f in parsed.schema.fields if f.name in carry]
    schema = T.StructType([T.StructField("doc", T.LongType()), *[T.StructField(c, T.LongType()) for c in ("n_words", "n_removed", "n_factors")]])
    schema = schema.add("kept_sha256", T.StringType())
    for f in fields:
        schema = schema.add(f)
    if with_text:
        schema = schema.add("kept", T.StringType())

    def clean(text: bytes, pieces: np.ndarray) -> tuple:
        words = kept = text.split()
        n_factors = 0
        if len(pieces):
            n_factors, gone = duplicate_words(pieces, len(words), length)
            kept = [w for w, x in zip(words, gone.tolist(), strict=True) if not x]
        joint = b" ".join(kept)
        left = (joint if n_factors else text).decode() if with_text else None
        return len(words), len(words) - len(kept), n_factors, hashlib.sha256(joint).hexdigest(), left

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("found")
            out = [
                clean(c.text(i), joined(found, c.lo + i, np.int64, 4)) for c in chunks(batch.column("text")) for i in range(c.hi - c.lo)
            ]
            if not out:
                continue
            n, gone, n_factors, sha, left = zip(*out, strict=True)
            columns = {"doc": batch.column("doc"), "n_words": pa.array(n, pa.int64()), "n_removed": pa.array(gone, pa.int64())}
            columns |= {"n_factors": pa.array(n_factors, pa.int64()), "kept_sha256": pa.array(sha)}
            columns |= {f.name: batch.column(f.name) for f in fields}
            if with_text:
                columns["kept"] = pa.array(left, pa.string())
            yield pa.record_batch(columns)

    result = parsed.mapInArrow(task, schema)
    return result.select(public_id(), *result.columns[1:])


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with each text cleaned by :func:`dedup_words`, and ``n_chars`` as it then is; the other columns as they were.

    A document of which nothing is left goes; one that had no words to begin with stays.
    """
    carry = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    inner = [f"_c{i}" for i in range(len(carry))]
    rows = docs.select("doc_id", "text", *[F.col(c).alias(x) for c, x in zip(carry, inner, strict=True)])
    cleaned = dedup_words(rows, length, tuple(inner), with_text=True).filter("n_removed = 0 or n_removed < n_words")
    columns = dict(zip(carry, inner, strict=True)) | {"text": "kept", "doc_id": "doc_id"}
    made = {"n_chars": F.char_length("kept").cast("long").alias("n_chars")}
    return cleaned.select(*[made[c] if c in made else F.col(columns[c]).alias(c) for c in docs.columns])
