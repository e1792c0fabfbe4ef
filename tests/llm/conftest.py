import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def prose(rng: random.Random, n: int) -> str:
    words = [rng.choice(["stone", "river", "é", "lamp", "the", "of", "Green", "quiet", "door", "x1"]) + rng.choice(["", "", "s", ",", "."]) for _ in range(n)]
    return "".join(w + rng.choice([" ", " ", " ", "\n", "\t"]) for w in words)


def corpus(seed: int = 5) -> list[tuple]:
    """Rows with nulls in every column, empty and long texts, copies, near copies, shared passages and repeated rows."""
    rng = random.Random(seed)
    passage, long = prose(rng, 90), prose(rng, 4000)
    texts = [prose(rng, rng.randrange(5, 120)) for _ in range(25)]
    texts += [t + passage + prose(rng, 20) for t in texts[:4]] + [passage, passage, long, long[: len(long) // 2] + "changed " + long[len(long) // 2 :]]
    texts += [texts[0], texts[0], texts[1].replace("the", "a", 1), "a b " * 300, "a b " * 301, "", None, " \n\t", "one", "é\U0001f600 end"]
    rows = [(i * 3 + (i % 2), t, ["en", "de", None][i % 3], [None, "s1", "s2", "big", "big", "big"][i % 6], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[2], rows[2], (None, texts[3], None, None, None), (None, None, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(docs):
    """The same rows with extra columns named like the operators' own."""
    names = ["doc", "tag", "found", "rank", "score", "toxic", "shard", "size", "bucket", "fp", "_id", "key", "kept", "_block", "copies", "_hash", "block"]
    return docs.selectExpr("*", *[f"'z' AS `{n}`" for n in names])
