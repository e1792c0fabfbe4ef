"""Substring and near-duplicate removal against brute force."""

import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import xxhash

from featurespark.llm import blocks, simhash, substring, suffix
from featurespark.llm.components import components
from featurespark.llm.kernels import anchors, covered, sliding_min, span_hashes, xxh64
from featurespark.llm.simhash import DISTANCE, Forest, cells, fingerprint, links_in_cells, near_components, one_of_each, parted, pivot_table, pivots
from featurespark.llm.blocks import joined
from featurespark.llm.substring import dedup_words, duplicate_words, factors, places_of, rlz_places, without_repeats
from featurespark.llm.suffix import BlindTrie, deep_shallow, dedup_bytes

from conftest import prose

LAST = 2**63 - 1


def test_kernels():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 50, 300).astype(np.uint64)
    for w in (1, 2, 7, 300):
        assert sliding_min(x, w).tolist() == [min(x[i : i + w]) for i in range(len(x) - w + 1)]
    assert len(sliding_min(x, 301)) == 0
    codes = np.tile(rng.integers(0, 2**63, 40).astype(np.uint64), 3)
    a = np.arange(40)
    assert (span_hashes(codes, a, a + 30) == span_hashes(codes, a + 40, a + 70)).all()
    assert covered(np.array([0, 3]), np.array([2, 9]), 6).tolist() == [True, True, False, True, True, True]
    grams = np.tile(span_hashes(codes, a, a + 5), 2)
    at = anchors(grams, 9)
    assert (at[:20] + 40 == at[40:60]).all() and all(i <= p < i + 9 for i, p in enumerate(at))


def windows_removed(rows, length=13):
    words = [((LAST if d is None else d), (t or "").encode().split()) for d, t, *_ in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - length + 1):
            k = tuple(w[i : i + length])
            first[k] = min(first.get(k, LAST), d)
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if first[tuple(w[i : i + length])] < d:
                gone[i : i + length] = [True] * length
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((None if d == LAST else d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("length", [13, 3])
def test_words(docs, rows, length):
    got = dedup_words(docs, length).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert Counter(map(tuple, got)) == windows_removed(rows, length)


def slow_parse(places, length):
    """Greedy parse, word by word: ``places`` maps a window's start to its place in the reference."""
    out, at = [], 0
    while at <= max(places, default=-1):
        if at not in places:
            at += 1
            continue
        (ref, ref_pos), n = places[at], length
        while places.get(at + n - length + 1) == (ref, ref_pos + n - length + 1):
            n += 1
        out.append((at, n, ref, ref_pos))
        at += n
    return out


def test_parse(docs, rows):
    words = {d: (t or "").split() for d, t, *_ in rows if d is not None}
    seen = crossed = 0
    for batch in rlz_places(docs).toArrow().to_batches():
        for i, (doc, text) in enumerate(zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), strict=True)):
            pieces, own = joined(batch.column("found"), i, np.int64, 4), (text or "").split()
            places = {s: (ref, at) for s, ref, at in places_of(pieces).tolist()}
            found, across = factors(pieces)
            assert list(map(tuple, found.tolist())) == slow_parse(places, 13)
            ends = [s + n for s, n, *_ in found.tolist()]
            assert all(a <= b for a, b in zip(ends, found[1:, 0].tolist(), strict=False))  # no overlap
            for start, n, ref, ref_start in found.tolist():
                assert n >= 13 and ref < doc and own[start : start + n] == words[ref][ref_start : ref_start + n]
                seen += 1
            assert all(any(s < e < s + 13 for e in ends) for s in across.tolist())
            crossed += len(across)
            covered_words = {k for s in places for k in range(s, s + 13)}
            assert set(np.flatnonzero(duplicate_words(pieces, len(own))[1]).tolist()) == covered_words
    assert seen > 5 and crossed > 0


def test_parse_across_boundaries():
    pieces = np.array([[0, 3, 1, 10], [3, 2, 2, 50], [9, 1, 4, 0], [20, 30, 5, 7]])
    found, across = factors(pieces)
    assert found.tolist() == [[0, 15, 1, 10], [20, 42, 5, 7]] and across.tolist() == [3, 4, 9]
    assert duplicate_words(pieces, 70)[1].sum() == 62


def test_answers_follow_the_input_and_not_the_blocks(docs, monkeypatch):
    counts = []
    for bytes_each in (1 << 30, 1):
        monkeypatch.setattr(blocks, "LEAST_BLOCKS", 2 if bytes_each > 1 else 64)
        counts.append([])
        for module in (substring, suffix):
            original = module.answered

            def spy(rows, answers, original=original):
                counts[-1].append(answers.count())
                return original(rows, answers)

            monkeypatch.setattr(module, "answered", spy)
        dedup_words(docs).count()
        dedup_bytes(docs).count()
        monkeypatch.undo()
    few, many = counts
    assert len(few) == 4 and all(b <= a * 1.5 for a, b in zip(few, many, strict=True))


def test_cleaned_documents(docs, clashing, none, rows):
    out = without_repeats(clashing)
    assert out.columns == clashing.columns and without_repeats(none).count() == 0 == dedup_words(none).count()
    got = out.collect()
    removed = {k[0]: k for k in windows_removed(rows)}
    for r in got:
        if r.doc_id is not None and not removed[r.doc_id][2]:
            assert r.text in {t for d, t, *_ in rows if d == r.doc_id} | {""}
        assert r.text is None or r.n_chars == len(r.text)
    gone = {k[0] for k in removed.values() if k[2] and k[1] == k[2]}
    assert gone and not gone & {r.doc_id for r in got if r.doc_id is not None}


def bytes_removed(rows, length):
    texts = [(d, (t or "").encode()) for d, t, *_ in rows]
    seen = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for d, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("length", [400, 130])
def test_bytes(docs, rows, length):
    assert Counter(map(tuple, dedup_bytes(docs, length).collect())) == bytes_removed(rows, length)


def test_bytes_of_odd_tables(clashing, none, rows):
    assert dedup_bytes(none).count() == 0 and dedup_bytes(clashing).count() == len(rows)


def test_bytes_of_repeated_rows_alone(spark):
    rng = random.Random(13)
    a, b, c = (prose(rng, 150) for _ in range(3))
    rows = [(1, a), (1, a), (None, b), (None, b), (2, c), (3, "short"), (3, "short")]
    got = dedup_bytes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(map(tuple, got.collect())) == bytes_removed(rows, 400)


def test_deep_shallow_sorts():
    rng = np.random.default_rng(4)
    for n, width, letters in ((0, 63, 2), (1, 63, 2), (400, 63, 2), (300, 20, 3)):
        strings = rng.integers(0, letters, (n, width)).astype(np.uint8)
        strings[: n // 2, : width - 3] = 0  # deep ties
        strings[n // 3 : n // 2] = strings[: n // 2 - n // 3]
        group = rng.integers(0, 3, n)
        order, equal = deep_shallow(strings, group)
        keys = [(int(group[i]), strings[i].tobytes()) for i in order]
        assert keys == sorted(keys) and sorted(order.tolist()) == list(range(n))
        assert equal.tolist() == [i > 0 and keys[i] == keys[i - 1] for i in range(n)]


def test_sorting_proves_every_window(docs, rows, monkeypatch):
    """What sort_stretches keeps is what neighbours in the order of deep_shallow prove, counted by brute force."""
    monkeypatch.setattr(suffix, "deep_shallow", lambda strings, group: (np.argsort(group, kind="stable"), np.zeros(len(group), bool)))
    rng = np.random.default_rng(3)
    n = 40
    base = {
        "doc": np.arange(n), "tag": np.zeros(n, np.int64), "key": np.repeat(np.arange(4, dtype=np.uint64), 10), "key2": np.zeros(n, np.uint32),
        "pos": np.full(n, 100), "run": np.full(n, 100), "left": rng.integers(97, 99, (n, 63)).astype(np.uint8),
        "right": rng.integers(97, 99, (n, 63)).astype(np.uint8), "n_left": np.full(n, 63, np.uint8), "n_right": np.full(n, 63, np.uint8),
        "known": np.zeros(n, bool),
    }
    assert len(suffix.sort_stretches(dict(base))["doc"]) == 0  # a sorter that finds nothing equal proves nothing
    monkeypatch.undo()
    base["left"][5:10] = base["left"][0]
    base["right"][5:8] = base["right"][0]
    base["left"][12:15, 20:] = base["left"][11, 20:]
    base["right"][12:15, :25] = base["right"][11, :25]
    got = Counter()
    out = suffix.sort_stretches({k: v.copy() for k, v in base.items()})
    for d, a, m in zip(out["doc"].tolist(), out["from"].tolist(), out["count"].tolist(), strict=True):
        got.update({(d, a + i): 1 for i in range(m)})
    windows = {}
    for d in range(n):
        both = bytes(base["left"][d]) + b"|" + bytes(base["right"][d])
        for before in range(64):
            text = both[63 - before : 63] + both[64 : 64 + 63 - before]
            windows.setdefault((int(base["key"][d]), before, text), []).append((d, 100 - before))
    want = {x for places in windows.values() if len(places) > 1 for x in places}
    assert set(got) == want and len(want) > 300


def test_memory_of_a_flush():
    import subprocess
    import sys

    code = """
import resource, sys
import numpy as np
sys.path.insert(0, %r)
from featurespark.llm import suffix
n = (24 << 20) // 160
rng = np.random.default_rng(1)
records = {"doc": np.sort(rng.integers(0, 5000, n)), "tag": np.zeros(n, np.int64), "key": rng.integers(0, n // 2, n).astype(np.uint64),
    "key2": np.zeros(n, np.uint32), "pos": np.arange(n), "run": np.arange(n), "left": rng.integers(0, 2, (n, 63)).astype(np.uint8),
    "right": rng.integers(0, 255, (n, 63)).astype(np.uint8), "n_left": np.full(n, 63, np.uint8), "n_right": np.full(n, 63, np.uint8)}
suffix.repeated_stretches(suffix.take(records, np.arange(10)))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
suffix.repeated_stretches(records)
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
""" % str(Path(suffix.__file__).resolve().parents[2])
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    assert int(done.stdout) < 150


def test_blind_trie():
    rng = np.random.default_rng(5)
    texts = [bytes(rng.integers(97, 99, 12).astype(np.uint8)) for _ in range(200)]
    trie = BlindTrie()
    for i, t in enumerate(texts):
        trie.insert(t, i)
    assert [texts[names[0]] for names in trie.order()] == sorted(set(texts))
    assert sorted(i for names in trie.order() for i in names) == list(range(200))


def test_short_windows_are_refused(docs):
    with pytest.raises(ValueError, match=str(2 * suffix.STRETCH)):
        dedup_bytes(docs, 100)


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps):
    up = list(range(len(fps)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                up[b] = a
    return [find(i) for i in range(len(fps))]


def test_near_components(docs, clashing, none, rows):
    fps = [slow_fingerprint(t) for _, t, *_ in rows]
    roots, least = slow_components(fps), {}
    for (d, *_), r in zip(rows, roots, strict=True):
        least[r] = min(least.get(r, LAST), LAST if d is None else d)
    want = Counter((d, f"{f:016x}", None if least[r] == LAST else least[r]) for (d, *_), f, r in zip(rows, fps, roots, strict=True))
    assert Counter(map(tuple, near_components(docs).collect())) == want
    kept = one_of_each(clashing)
    assert kept.columns == clashing.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))
    assert near_components(none).count() == 0 == one_of_each(none).count()


def test_every_class_keeps_a_row(spark):
    rng = random.Random(11)
    texts = [prose(rng, 80) for _ in range(6)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[2]), (None, texts[2]), (None, texts[3]), (4, texts[3]), (7, texts[4]), (7, texts[5])]
    kept = one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(map(tuple, kept)) == Counter([(None, t) for t in texts[:3]] + [(4, texts[3]), (7, texts[4]), (7, texts[5])])


def clustered(n=40):
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**63, n).astype(np.uint64)
    flips = (np.uint64(1) << rng.integers(0, 64, (n, 8, 3)).astype(np.uint64)).astype(np.uint64)
    return np.unique(np.concatenate([base, np.bitwise_xor.reduce(flips, axis=2).ravel() ^ np.repeat(base, 8)]))


def classes(fps, u, v):
    place = {x: i for i, x in enumerate(fps.tolist())}
    forest = Forest(len(fps))
    forest.link(np.array([place[x] for x in u.tolist()], int), np.array([place[x] for x in v.tolist()], int))
    return forest.roots().tolist()


@pytest.mark.parametrize("cell", [4, 256])
def test_links_lose_nothing(cell, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", cell)
    fps = clustered()
    # one cell for all, parted by further pivots or not
    assert classes(fps, *links_in_cells(np.zeros(len(fps), np.int64), fps)) == slow_components(fps.tolist())
    # the ten cells that the pivots route to
    keys = cells(pivot_table(fps))
    assert classes(fps, *links_in_cells(keys.ravel().view(np.int64), np.repeat(fps, keys.shape[1]))) == slow_components(fps.tolist())


def test_pivots_decide_the_candidates():
    fps = clustered(150)
    table = pivot_table(fps)
    apart = fps[:, None] ^ pivots()[None, :]
    assert (table.sum(axis=2) == np.bitwise_count(apart)).all()

    def candidates(routing):
        found = set()
        keys = cells(table, routing)
        for k in range(keys.shape[1]):
            for name in np.unique(keys[:, k]):
                at = np.flatnonzero(keys[:, k] == name).tolist()
                found |= {(i, j) for x, i in enumerate(at) for j in at[:x]}
        return found

    linked = {(i, j) for i in range(len(fps)) for j in range(i) if int(fps[i] ^ fps[j]).bit_count() <= DISTANCE}
    every, routed = candidates(0), candidates(simhash.ROUTING)
    assert linked <= routed and len(every) == len(fps) * (len(fps) - 1) // 2 and len(routed) < len(every) / 50
    # further pivots part a crowded cell, and lose no link either
    member, key = parted(np.zeros(len(fps), np.int64), table)
    cell_of = {}
    for m, k in zip(member.tolist(), key.tolist(), strict=True):
        cell_of.setdefault(m, set()).add(k)
    assert np.bincount(key).max() < len(fps) and all(cell_of[i] & cell_of[j] for i, j in linked)


def test_xxh64():
    rng = np.random.default_rng(8)
    buf = rng.integers(0, 256, 5000).astype(np.uint8)
    start = rng.integers(0, 4900, 600)
    end = start + np.r_[np.arange(100), rng.integers(0, 100, 500)]
    want = [xxhash.xxh64_intdigest(buf[a:b].tobytes(), 42) for a, b in zip(start, end, strict=True)]
    assert xxh64(buf, start, end, 42).tolist() == want and len(xxh64(buf[:0], start[:0], end[:0], 42)) == 0


def test_long_chain(spark):
    n = 70
    order = np.random.default_rng(7).permutation(n).tolist()
    edges = [(order[i], order[i + 1]) for i in range(n - 1)] + [(100, 101), (101, 100), (5, 5)]
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert sorted(map(tuple, got)) == [(i, 0) for i in range(n)] + [(100, 100), (101, 100)]


def test_fingerprint_of_few_words():
    assert fingerprint(b"") == fingerprint(b" \n") == 0
    long = " ".join(f"Wort{i % 977}é" for i in range(70_000))
    assert fingerprint(long.encode()) == slow_fingerprint(long.replace("W", "w"))
    assert fingerprint(b"A b") == slow_fingerprint("a B") and fingerprint(b"a b c d") == slow_fingerprint("a b c d")
