"""The pipeline's stages, one after the other, and the registered queries."""

import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from featurespark.llm import jaccard
from featurespark.llm.queries import QUERIES, SQL
from featurespark.llm.simhash import Forest, fingerprint

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables here")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert docs.columns == columns, name
        now = {r.doc_id for r in docs.collect()}
        assert now and now <= before.keys()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.count() == docs.count()


def slow_roots(texts):
    words = [(t or "").lower().split() for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    up = list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                x, y = sorted((find(i), find(j)))
                up[y] = x
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("crowd", [jaccard.CROWD, 250])
def test_near_duplicates_by_brute_force(spark, crowd, monkeypatch):
    monkeypatch.setattr(jaccard, "CROWD", crowd)  # the small one deals crowds into parts
    rng = random.Random(12)
    texts = ["", None, " \n", "one", "One", "a b c d", "a b c d e"]
    for _ in range(25):  # a text and copies of it with some words changed
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(20, 200))]
        texts.append(" ".join(base))
        for _ in range(6):
            copy = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 40) + 1)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(3000)}"
            texts.append(" ".join(copy))
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(set(slow_roots(texts)))
    assert 30 < len(want) < len(texts) - 50
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()) == want


def test_links_of_band_keys():
    key = np.array([5, 7, 5, 9, 7, 11])
    fp = np.array([30, 10, 20, 40, 30, 50])
    one, u, v = jaccard.linked_by_key(key, fp, np.array([30, 10, 20, 40, 30, 40]))
    assert sorted(key[one].tolist()) == [5, 7, 9, 11]
    assert dict(zip(u.tolist(), v.tolist(), strict=True)) == {20: 10, 30: 10, 50: 40}


def test_a_crowd_in_parts_is_one_class(spark, monkeypatch):
    """A chain of versions, of which only neighbours are alike enough, over many parts, and flushes of few keys."""
    monkeypatch.setattr(jaccard, "CROWD", 100)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[6 * i : 6 * i + 70]) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(99, texts[3]), (None, texts[5])], "doc_id long, text string")
    assert len(set(slow_roots(texts))) == 1
    classes = jaccard.jaccard_classes(docs)
    assert classes.select("root").distinct().count() == 1 and classes.count() == 40
    few = jaccard._signatures(docs, 5).dropDuplicates(["fp"])
    crowds = [{r.node: r.root for r in jaccard._crowds(few, 12, most).collect()} for most in (40, 1 << 19)]
    assert crowds[0] == crowds[1] and len(crowds[0]) == 40


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = db.sql(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    assert sorted(map(repr, map(tuple, df.select(*columns).collect()))) == sorted(map(repr, want))


def test_simhash_proposes(spark):
    """Near fingerprints, by brute force, make crowds without the help of bands, through cells of distances to pivots."""
    rng = np.random.default_rng(5)
    texts = []
    for _ in range(60):
        words = [f"w{x}" for x in rng.integers(0, 5000, 120)]
        texts.append(" ".join(words))
        for _ in range(3):
            words = words[:]
            words[int(rng.integers(0, 120))] = f"x{rng.integers(0, 5000)}"
            texts.append(" ".join(words))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *texts[:3], "", None])], "doc_id long, text string")
    few = jaccard._signatures(docs, 5).dropDuplicates(["fp"]).persist()
    found = {r.fp: r.sim for r in few.filter("fp <> 0").collect()}
    assert set(found.values()) == {np.uint64(fingerprint(t.encode(), 5)).astype(np.int64) for t in texts}
    apart = few.withColumn("bands", F.transform("bands", lambda b: F.xxhash64("fp", b)))
    names = sorted(found)
    fps = np.array([found[n] for n in names]).view(np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= jaccard.DISTANCE
    forest = Forest(len(names))
    forest.link(*np.nonzero(near))
    roots = forest.roots()
    assert len(set(roots)) < len(names) - 60
    crowds = {r.node: r.root for r in jaccard._crowds(apart, 12).collect()}
    assert [crowds.get(n, n) for n in names] == [names[r] for r in roots]
