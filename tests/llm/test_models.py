"""The classifier and the quality forests: held-out accuracy, counts by brute force, odd tables."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from featurespark.llm import quality, toxicity
from featurespark.llm.quality import rate_quality
from featurespark.llm.toxicity import score_toxicity

from conftest import SCHEMA, prose

WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(500):
        text, toxic, bad = prose(rng, rng.randrange(20, 80)), i % 4 == 0, i % 5 == 0
        if toxic:
            text += " You " + rng.choice(["grumbletoad", "grumblewort", "snarkfen"]) + "! " + prose(rng, 10)
        if bad:
            text = text.replace(" ", "### ").upper()
        rows.append((i, text, ["en", "de"][i % 2], "s", len(text)))
        labels.append((i, int(not bad), int(toxic)))
    return spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


def test_toxicity_on_held_out_rows(labelled):
    docs, labels, truth = labelled
    got = {r.doc_id: r for r in score_toxicity(docs, labels).withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()}
    held = [(got[i], t) for i, _, t in truth if got[i].held]
    assert len(held) > 80
    right = [(r.score >= toxicity.CUT) == bool(t) for r, t in held]
    assert np.mean(right) > 0.9 and np.mean([r.toxic == bool(t) for r, t in held]) > 0.9
    assert all(0 <= r.score <= 1 for r in got.values())


def test_scores_read_the_text_alone(spark, labelled):
    docs, labels, _ = labelled
    net, trained = toxicity.fit(docs, labels)
    again, same = toxicity.fit(docs.repartition(2), labels)
    assert (net.table == again.table).all() and trained == same and len(trained) > 200
    assert not set(trained) & {r.doc_id for r in docs.filter(toxicity.held_out(F.col("doc_id"))).collect()}
    text = "quiet grumbletoad"
    df = spark.createDataFrame([(1, text, "en", "a", 1), (2, text, None, None, None)], SCHEMA)
    a, b = score_toxicity(df.unionByName(docs), labels).filter(f"text = '{text}'").collect()
    assert a.score == b.score
    narrow = score_toxicity(df.select("doc_id", "lang", "text").unionByName(docs.select("doc_id", "lang", "text")), labels, with_text=False)
    assert narrow.columns == ["doc_id", "lang", "score", "threshold", "toxic"]
    assert {r.score for r in narrow.filter("doc_id in (1, 2)").collect()} >= {a.score}


def naive_raw(net, ids):
    """Convolution, pooling and the linear layer, one filter and one place at a time."""
    vectors = [sum(net.table[i].astype(float) for i in row) for row in ids]
    pooled = []
    for weights in net.filters:
        for f in range(toxicity.FILTERS):
            outs = [
                sum(float(vectors[at + o] @ weights[o][:, f]) for o in range(len(weights)) if at + o < len(vectors)) for at in range(len(vectors))
            ]
            pooled.append(max(outs, default=0.0))
    return sum(max(x + b, 0.0) * o for x, b, o in zip(pooled, net.bias.tolist(), net.out.tolist(), strict=True)) + net.rest


def small_net(rng):
    wide = len(toxicity.WIDTHS) * toxicity.FILTERS
    filters = [rng.normal(0, 0.5, (w, toxicity.DIM, toxicity.FILTERS)) for w in toxicity.WIDTHS]
    return toxicity.Net(rng.normal(0, 0.5, (40, toxicity.DIM)), filters, rng.normal(0, 0.1, wide), rng.normal(0, 0.5, wide), 0.2)


def test_forward_pass_by_naive_code():
    rng = np.random.default_rng(12)
    net = small_net(rng)
    docs = [rng.integers(0, 40, (n, 3)) for n in (5, 0, 1, 2, 9)]
    got = net.raw(np.concatenate(docs), np.r_[0, np.cumsum([len(d) for d in docs])])
    # the pooled outputs are single precision
    assert got.tolist() == pytest.approx([naive_raw(net, d) for d in docs], abs=1e-4)


def test_gradients_by_finite_differences():
    rng = np.random.default_rng(13)
    net = small_net(rng)
    docs = [rng.integers(0, 40, (n, 3)) for n in (6, 0, 3, 8)]
    ids, first, y = np.concatenate(docs), np.r_[0, np.cumsum([len(d) for d in docs])], np.array([1.0, 0.0, 0.0, 1.0])

    def loss():
        z = np.array([naive_raw(net, d) for d in docs])
        return float((np.logaddexp(0, z) - y * z).mean())

    found = net.gradients(ids, first, y)
    table = np.zeros_like(net.table)
    for at, by in zip(found["at"], found["by"], strict=True):
        for k in range(ids.shape[1]):
            np.add.at(table, ids[at, k], by)
    pairs = [(net.out, found["out"]), (net.bias, found["bias"]), (net.table, table), *zip(net.filters, found["filters"], strict=True)]
    for value, grad in pairs:
        for at in rng.choice(value.size, 12):
            at = np.unravel_index(at, value.shape)
            value[at] += 1e-5
            above = loss()
            value[at] -= 2e-5
            below = loss()
            value[at] += 1e-5
            assert grad[at] == pytest.approx((above - below) / 2e-5, abs=1e-4)


def test_calibration_does_not_depend_on_the_size_of_the_sample(labelled, monkeypatch):
    """A sample in which half the rows are toxic gives scores of the same odds as one with the natural share."""
    docs, labels, truth = labelled
    monkeypatch.setattr(toxicity, "MOST_CLEAN", 60)
    got = {r.doc_id: r for r in score_toxicity(docs, labels).collect()}
    share = np.mean([t for _, _, t in truth])
    assert np.mean([r.score for r in got.values()]) == pytest.approx(share, abs=0.06)


def test_calibrate_recovers_odds():
    rng = np.random.default_rng(14)
    x = rng.normal(0, 1, 60_000)
    y = rng.random(60_000) < 1 / (1 + np.exp(-(1.7 * x - 0.8)))
    bins, where = np.unique(np.round(x * 64), return_inverse=True)
    weight = np.stack([np.bincount(where, ~y), np.bincount(where, y)])
    a, b = toxicity.calibrate(np.tile(bins / 64, 2), weight.ravel(), np.repeat([0.0, 1.0], len(bins)))
    assert (a, b) == (pytest.approx(1.7, abs=0.06), pytest.approx(-0.8, abs=0.05))


def test_toxicity_of_odd_tables(docs, clashing, none, labelled, rows):
    _, labels, _ = labelled
    assert score_toxicity(none, labels).count() == 0
    got = score_toxicity(clashing, labels)
    assert got.count() == len(rows) and all(0 <= r.score <= 1 for r in got.collect())
    empty = score_toxicity(docs, labels.filter("false"))
    assert empty.filter("score = 0 and not toxic").count() == len(rows)


def slow_counts(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    twice = set()
    for i in range(len(words) - 4):
        if grams[tuple(words[i : i + 5])] > 1:
            twice |= set(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(quality.SYMBOLS, text)), len(lines) - len(set(lines)), len(twice)


def test_counts(docs, clashing, none, labelled, rows):
    _, labels, _ = labelled
    got = rate_quality(docs, labels.filter("false")).collect()
    assert Counter((r.doc_id, *[r[c] for c in quality.COUNTS]) for r in got) == Counter((d, *slow_counts(t)) for d, t, *_ in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and r.kept == (not r.base_failed)
    assert rate_quality(none, labels).count() == 0 and rate_quality(clashing, labels).count() == len(rows)


def test_lines(spark):
    texts = ["x\ny\nx\n\n", "x\ny", "x\n", "\n\nx\nx x\nx\r\nx", "same #\nsame #\nsame #"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = rate_quality(df, spark.createDataFrame([], "doc_id long, quality int")).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in quality.COUNTS) for r in got] == [slow_counts(t) for t in texts]


def test_quality_finds_junk(labelled):
    docs, labels, truth = labelled
    got = {r.doc_id: r for r in rate_quality(docs, labels).collect()}
    good = [got[i].kept or got[i].base_failed for i, q, _ in truth if q]
    bad = [not got[i].kept for i, q, _ in truth if not q]
    assert np.mean(good) > 0.97 and np.mean(bad) > 0.9


def test_forest_isolates_outliers():
    rng = np.random.default_rng(9)
    rows = np.r_[rng.normal(0, 1, (500, 2)), [[9, 9], [-8, 7]]]
    score = quality.Forest.fit(rows).score(rows)
    assert set(np.argsort(-score)[:2].tolist()) == {500, 501}
    bins = np.array([800, 1600, 7000])
    cut = quality.threshold(bins, np.array([5, 5, 0]), np.array([0, 0, 3]))
    assert 1601 / quality.BINS < cut < 7000 / quality.BINS
    assert quality.threshold(bins[:1], np.array([1]), np.array([0])) == float("inf")


def test_path_lengths_by_plain_traversal():
    rng = np.random.default_rng(10)
    rows = rng.normal(0, 1, (400, 3))
    forest = quality.Forest.fit(rows, trees=8, size=64)

    def walk(t, row, at=0):
        k = forest.column[t][at]
        if k < 0:
            return forest.path[t][at]
        return walk(t, row, forest.child[t][at] + int(row[k] > forest.value[t][at]))

    want = [2 ** (-np.mean([walk(t, row) for t in range(8)]) / forest.usual) for row in rows]
    assert forest.score(rows).tolist() == pytest.approx(want)


def test_quality_on_held_out_labels(labelled):
    """Labels of every fourth row are kept back from fitting."""
    docs, labels, truth = labelled
    got = {r.doc_id: r for r in rate_quality(docs, labels.filter("doc_id % 4 <> 2")).collect()}
    bad = [not got[i].kept for i, q, _ in truth if not q and i % 4 == 2]
    good = [got[i].kept or got[i].base_failed for i, q, _ in truth if q and i % 4 == 2]
    assert len(bad) >= 20 and np.mean(bad) >= 0.9 and np.mean(good) > 0.95
