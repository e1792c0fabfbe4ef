"""Every query against its SQL at the smallest scale."""

from pathlib import Path

import pytest

from featurespark.plans.queries import QUERIES
from featurespark.plans.sql import SQL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables here")


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        db.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = db.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in columns)} FROM ({SQL[name]})").fetchall()
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and got
