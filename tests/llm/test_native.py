"""Sharding, fingerprints, mixing, packing and licences against plain Python."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import prose
from featurespark.llm import fingerprints, rank
from featurespark.llm.fingerprints import edit_fingerprints, with_fingerprint
from featurespark.llm.licenses import RULES, SENTENCES, normalise, recognise
from featurespark.llm.mixing import mix, mixed
from featurespark.llm.packing import best_bounds, length_bin, length_buckets
from featurespark.llm.support import keyed
from featurespark.llm.sharding import hilbert_index, hilbert_shards, shard_boxes, write_shards

WORD = re.compile("[^\x20\x09-\x0d]+")


def test_hilbert_curve_is_one_path(spark):
    n = 8
    cells = spark.range(n**3).selectExpr("id", "id div 64 AS x", "id div 8 % 8 AS y", "id % 8 AS z")
    got = cells.select("x", "y", "z", hilbert_index([F.col("x"), F.col("y"), F.col("z")], 3).alias("h")).orderBy("h").collect()
    assert [r.h for r in got] == list(range(n**3))
    assert all(abs(a.x - b.x) + abs(a.y - b.y) + abs(a.z - b.z) == 1 for a, b in itertools.pairwise(got))


@pytest.mark.parametrize("shards", [1, 4, 16, 100])
def test_shards(docs, rows, shards):
    got = hilbert_shards(docs, shards).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in rows
    )
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    sizes = [len(by[k]) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows) and set(by) <= set(range(shards))
    assert all(sorted(r.slot for r in part) == list(range(len(part))) for part in by.values())
    curve = [[r.curve for r in by[k]] for k in sorted(by) if by[k]]
    assert all(max(a) <= min(b) for a, b in itertools.pairwise(curve))
    assert sum(r["rows"] for r in shard_boxes(hilbert_shards(docs, shards)).collect()) == len(rows)


def test_shards_of_odd_tables(spark, none, clashing, rows, tmp_path):
    assert hilbert_shards(none).count() == 0
    assert hilbert_shards(clashing).count() == len(rows)
    write_shards(clashing, str(tmp_path / "out"))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r.doc_id, r.text, r.lang, r.source) for r in out.collect()) == Counter(x[:4] for x in rows)
    sizes = Counter(r.shard for r in out.collect())
    assert max(sizes.values()) - min(sizes.get(k, 0) for k in range(16)) <= 1


def test_shards_of_repeated_rows(spark, monkeypatch):
    rows = [(i if i % 3 else None, "same" if i % 3 == 0 else f"text {i}", "en", "s", 4) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    monkeypatch.setattr(rank.repeated, "__defaults__", (9,))
    got = hilbert_shards(df, 7).collect()
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert sorted(len(x) for x in by.values()) == [42, 43, 43, 43, 43, 43, 43] and all(sorted(x) == list(range(len(x))) for x in by.values())
    assert sum(r.doc_id is None for r in got) == 100


def test_fingerprints(docs, rows):
    got = edit_fingerprints(docs).collect()
    key = lambda d: (d is None, d if d is not None else 0)
    texts = Counter((d, t or "") for d, t, *_ in rows)
    order = sorted(((key(d), d, t) for (d, t), n in texts.items() for _ in range(n)), reverse=True, key=lambda x: x[0])
    unique = [x for x in order if sum(y[1] == x[1] for y in order) == 1]
    expected = {}
    for k, (_, d, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)]
        if (_, d, t) in unique and nxt in unique:
            cut = len(t) // 3
            expected[d] = hashlib.sha256((t[: len(t) - cut] + nxt[2][:cut]).encode()).hexdigest()
    assert len(got) == len(rows)
    found = {r.doc_id: r for r in got}
    assert len(expected) > 20 and all(found[d].edited_sha256 == x for d, x in expected.items())
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    prints = {}
    for d, t, *_ in rows:
        prints.setdefault(t or "", set()).update(r.fingerprint for r in got if r.doc_id == d is not None)
    singles = [next(iter(x)) for x in prints.values() if len(x) == 1]
    assert len(singles) > 20 and len(set(singles)) == len(singles)
    assert sum(r.near_edited >= r.near_next for r in got) > len(got) * 0.8


def tree(text):
    """Leaves of four words by paragraph, as plain text."""
    return [re.findall("(?:[^ ]+ *| +){1,4}", p) for p in text.split("\n")]


def slow_likeness(a, b):
    if a == b:
        return 1.0
    x, y = ({leaf for p in tree(t) for leaf in (p or [""])} for t in (a, b))
    return len(x & y) / max(len(x), len(y))


def slow_edit(a, b):
    if a == b:
        return None, None
    x, y = tree(a), tree(b)
    p = next(i for i, (m, n) in enumerate(itertools.zip_longest(x, y)) if m != n)
    m, n = (t[p] if p < len(t) and t[p] else [""] for t in (x, y))
    return p, next((i for i, (u, v) in enumerate(itertools.zip_longest(m, n)) if u != v), 0)


def check_neighbours(got, rows):
    """Every column against the definition, where ties stand in the order of the text's hash."""
    by_id = defaultdict(list)
    for d, t, *_ in rows:
        by_id[d].append(t or "")
    ids = sorted(by_id, key=lambda d: (d is None, d or 0), reverse=True)
    found = defaultdict(list)
    for r in got:
        found[r.doc_id].append(r)
    checked = 0
    for k, d in enumerate(ids):
        after = by_id[ids[(k + 1) % len(ids)]]
        assert len(found[d]) == len(by_id[d])
        for t in by_id[d]:
            cut = len(t) // 3
            nexts = {n for n in [*after, *by_id[d]]}
            edits = {hashlib.sha256((t[: len(t) - cut] + n[:cut]).encode()).hexdigest(): n for n in nexts}
            mine = [r for r in found[d] if r.n_chars == len(t) and r.edited_sha256 in edits]
            assert mine
            if len(by_id[d]) == 1 and len(set(after)) == 1:
                n = after[0]
                edited = t[: len(t) - cut] + n[:cut]
                assert mine[0].near_edited == pytest.approx(slow_likeness(t, edited)) and mine[0].near_next == pytest.approx(slow_likeness(t, n))
                assert (mine[0].first_edit, mine[0].first_leaf) == slow_edit(t, edited)
                checked += 1
    return checked


def test_likeness_and_first_edit(docs, rows):
    assert check_neighbours(edit_fingerprints(docs).collect(), rows) > 25


@pytest.mark.parametrize("hot", ["ids", "rows", "clustered"])
def test_neighbours_in_full_buckets(spark, hot, monkeypatch):
    """A third of the rows without ids, the same row, or ids close together among far ones: no bucket stays full."""
    monkeypatch.setattr(fingerprints, "BUCKET_ROWS", 5)
    rng = random.Random(6)
    rows = [(i * 7, prose(rng, 12)) for i in range(60)]
    rows += {"ids": [(None, prose(rng, 9)) for _ in range(40)], "rows": [(21, "again and again, my friend")] * 40, "clustered": [(2**61 + i, prose(rng, 9)) for i in range(40)]}[hot]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert check_neighbours(edit_fingerprints(df).collect(), rows) >= 55
    if hot != "rows":
        ids = keyed(df).select("doc", "tag")
        sizes = fingerprints._Buckets(ids, 4).place(ids).groupBy("_b").count().collect()
        assert max(r["count"] for r in sizes) <= 20


def test_fingerprint_tree(spark):
    texts = ["a b\nc d", "a b\n\nc d", "a b\nc d\n", "a  b\nc d", "", " ", "a b\nc e", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    roots = [r.fp.split(":")[0] for r in with_fingerprint(df, "text", "fp").collect()]
    assert len(set(roots[:-1])) == 7 and roots[-1] == roots[4]


def test_fingerprints_of_odd_tables(spark, none, clashing, rows):
    assert edit_fingerprints(none).count() == 0
    assert edit_fingerprints(clashing).count() == len(rows)
    one = edit_fingerprints(spark.createDataFrame([(7, "abcdef")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()
    far = spark.createDataFrame([(-(2**62), "aaa"), (2**62, "bbb"), (2**62 + 1, "ccc")], "doc_id long, text string")
    got = {r.doc_id: r.edited_sha256 for r in edit_fingerprints(far).collect()}
    assert got[2**62 + 1] == hashlib.sha256(b"ccb").hexdigest() and got[-(2**62)] == hashlib.sha256(b"aac").hexdigest()


def water(sizes, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        target = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if target[s] > most * sizes[s]}
        if not over:
            return target | {s: most * sizes[s] for s in capped}
        capped |= over


def held_to_targets(rows, got):
    sizes, taken, longest = Counter(), Counter(), Counter()
    for _, t, _, s, *_ in rows:
        n = len(WORD.findall(t or ""))
        sizes[s] += n
        longest[s] = max(longest[s], n)
    want = water(sizes)
    for r in got:
        assert r.taken == r.size * r.copies and 0 <= r.copies <= 3
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        taken[r.source] += r.taken
    for s in sizes:
        assert want[s] - longest[s] <= taken[s] <= want[s] + 1e-6


def test_mix(docs, rows):
    got = mix(docs).collect()
    held_to_targets(rows, got)
    assert sorted(map(repr, got)) == sorted(map(repr, mix(docs.repartition(2)).collect()))


@pytest.mark.parametrize("hot", ["ids", "rows"])
def test_mix_where_a_third_is_alike(spark, hot, monkeypatch):
    rng = random.Random(4)
    rows = [(None if hot == "ids" else i, prose(rng, rng.randrange(3, 30)), "en", "abc"[i % 3], 0) for i in range(120)]
    if hot == "rows":
        rows += [(7, "one two three", "en", "abc"[i % 3], 0) for i in range(60 * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    monkeypatch.setattr(rank.repeated, "__defaults__", (7,))  # many chunks
    got = mix(df).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((d, s, len(WORD.findall(t))) for d, t, _, s, _ in rows)
    held_to_targets(rows, got)
    copies = Counter()
    for r in got:
        copies[r.doc_id, r.source, r.size] += r.copies
    out = mixed(df).collect()
    assert Counter((r.doc_id, r.source, len(WORD.findall(r.text))) for r in out) == +copies


def test_mix_of_odd_tables(none, clashing, docs, rows):
    assert mix(none).count() == 0 and mix(clashing).count() == len(rows) and mixed(none).count() == 0
    out, copies = mixed(clashing), Counter()
    for r in mix(docs).collect():
        copies[r.doc_id, r.source] += r.copies
    assert out.columns == clashing.columns
    assert Counter((r.doc_id, r.source) for r in out.collect()) == +copies


def test_best_bounds():
    rng = np.random.default_rng(1)
    for _ in range(30):
        n = int(rng.integers(1, 9))
        lengths = np.sort(rng.choice(np.arange(1, 60), n, replace=False))
        counts = rng.integers(1, 9, n)
        k = int(rng.integers(1, 5))
        pad = lambda ends: sum(
            counts[i] * (lengths[min(e for e in ends if e >= i)] - lengths[i]) for i in range(n)
        )
        got = best_bounds(lengths, counts, counts * lengths, k)
        best = min(pad((*c, n - 1)) for m in range(min(k, n)) for c in itertools.combinations(range(n - 1), m))
        assert len(got) <= k and got[-1] == n - 1 and pad(got) == best


def test_best_bounds_of_many_lengths():
    lengths = np.unique(np.random.default_rng(2).integers(1, 60_000, 20_000))
    counts = np.random.default_rng(3).integers(1, 9, len(lengths))
    got = best_bounds(lengths, counts, counts * lengths, 16)
    assert len(got) == 16 and got[-1] == len(lengths) - 1
    pad = lambda ends: sum(int((counts[a + 1 : b + 1] * (lengths[b] - lengths[a + 1 : b + 1])).sum()) for a, b in itertools.pairwise([-1, *ends]))
    best = pad(got)
    for k in range(15):
        for step in (-200, -1, 1, 200):
            moved = sorted({*got[:k], got[k] + step, *got[k + 1 :]})
            assert moved[0] < 0 or pad(moved) >= best


def test_length_bins(spark):
    got = spark.range(0, 500_000, 7).select("id", length_bin(F.col("id")).alias("b")).collect()
    assert all(r.id <= r.b <= (r.id if r.id <= 65_536 else r.id * (1 + 1 / 32_768)) for r in got)


def test_packing(docs, rows):
    budget = 600
    got = length_buckets(docs, 4, budget).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter((d, len(WORD.findall(t or ""))) for d, t, *_ in rows)
    batches, buckets = defaultdict(list), defaultdict(list)
    for r in got:
        batches[r.bucket, r.batch].append(r)
        buckets[r.bucket].append(r)
        assert 0 <= r.padding == r.bucket_len - r.n_tokens
    assert len(buckets) <= 4
    for (bucket, batch), part in batches.items():
        full = max(1, budget // max(part[0].bucket_len, 1))
        last = max(b for k, b in batches if k == bucket)
        assert len(part) == full or (batch == last and len(part) < full)
        assert sorted(r.slot for r in part) == list(range(len(part)))
    assert all(max(r.n_tokens for r in part) == part[0].bucket_len for part in buckets.values())


def test_packing_of_odd_tables(none, clashing, rows):
    assert length_buckets(none).count() == 0 and length_buckets(clashing).count() == len(rows)
    assert length_buckets(clashing, tokens=F.lit(None)).filter("n_tokens <> 0").count() == 0


APACHE = """/*
 * Copyright 2020 Some One
 *
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law or agreed to in writing, software
 * distributed under the License is distributed on an "AS IS" BASIS,
 * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
 * See the License for the specific language governing permissions and
 * limitations under the License.
 */
class A {}"""
MIT = """MIT License

Copyright (c) 2021 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
BSD = """Copyright (c) 2019, Some One
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
NAMES = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
AS_IS = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES."""
GPL3 = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU General Public License for more details.
#
# You should have received a copy of the GNU General Public License
# along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""
GPL2 = """// This program is free software; you can redistribute it and/or modify
// it under the terms of the GNU General Public License as published by
// the Free Software Foundation; either version 2 of the License, or
// (at your option) any later version.
//
// This program is distributed in the hope that it will be useful,
// but WITHOUT ANY WARRANTY; without even the implied warranty of
// MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
// GNU General Public License for more details.
"""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS."""


def test_published_headers(spark):
    texts = [
        (APACHE, "Apache-2.0"),
        (APACHE.replace("\n *\n *     http", " http"), "Apache-2.0"),
        ("\n".join(x.lstrip(" */") for x in APACHE.splitlines()), "Apache-2.0"),
        (MIT, "MIT"),
        (BSD + AS_IS, "BSD-2-Clause"),
        (BSD + NAMES + AS_IS, "BSD-3-Clause"),
        ("\n".join("; " + x for x in (BSD + NAMES + AS_IS).splitlines()), "BSD-3-Clause"),
        (GPL3, "GPL-3.0-or-later"),
        (GPL2, "GPL-2.0-or-later"),
        (GPL3.replace("General", "Lesser General"), "LGPL-3.0-or-later"),
        (GPL3.replace("General", "Affero General"), "AGPL-3.0-or-later"),
        (MPL, "MPL-2.0"),
        (ISC, "ISC"),
        ("// SPDX-License-Identifier: Apache-2.0\nint x;", "Apache-2.0"),
        ("Copyright Some One. All rights reserved.", "proprietary"),
        (BSD + NAMES + AS_IS + "\n\n" + BSD + AS_IS, "BSD-3-Clause, BSD-2-Clause"),
        (MIT + "\n\n\n" + APACHE, "Apache-2.0, MIT"),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    assert [r.licenses for r in recognise(df).orderBy("doc_id").collect()] == [x for _, x in texts]


def test_sentences_are_as_they_are_cut():
    for text in SENTENCES.values():
        assert len([x for x in re.split("(?<=[.!?:;])\\s+", text) if normalise(x)]) == 1, text
    assert len(set(map(normalise, SENTENCES.values()))) == len(SENTENCES)
    sizes = [len(rule) for _, rule in RULES]
    assert sizes == sorted(sizes, reverse=True) and {x for _, rule in RULES for x in rule} == set(SENTENCES)


def test_licenses(spark, docs, clashing, none, rows):
    s = SENTENCES
    mit = [s[x] for x in ("mit-grant", "mit-notice", "mit-as-is")]
    cases = [
        (" ".join(mit), "MIT"),
        ("\n".join(re.sub("(.{40,60}) ", r"\1\n", x) for x in mit), "MIT"),
        (mit[2] + " " + mit[0], ""),
        (f"Some words.\n{s['cc-by-nc-4']}\nMore. {s['apache-licensed']} End", "Apache-2.0, CC-BY-NC-4.0"),
        (s["apache-licensed"].upper() + "!", "Apache-2.0"),
        (s["bsd-grant"] + " 1. " + s["bsd-source"] + "\n" + s["reserved"], "BSD-2-Clause"),
        ("licensed", ""),
        (None, ""),
        ("", ""),
        ("word " * 50_000 + "end.\n" + s["gpl3-licensed"], "GPL-3.0"),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    assert [r.licenses for r in recognise(df).orderBy("doc_id").collect()] == [x for _, x in cases]
    named = []
    for name, rule in RULES:
        named.append((len(named), "\n".join(SENTENCES[x] for x in rule), name))
    found = recognise(spark.createDataFrame(named, "doc_id long, text string, name string")).collect()
    assert {r.doc_id: r.licenses for r in found} == {i: name for i, _, name in named}
    assert recognise(docs).count() == recognise(clashing).count() == len(rows) and recognise(none).count() == 0
