"""Day files of a batch: one for each day whatever the partitions, several for a large day, replaced by a repeat."""

from pathlib import Path

from pyspark.sql import functions as F

from featurespark.sources import sinks
from featurespark.sources.readers import stored_text


def _log(spark, n, days, parts):
    dt = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % days).cast("int")).cast("string")
    json = F.when(F.col("id") % 7 > 0, F.concat(F.lit("é"), F.col("id").cast("string")))
    return spark.range(0, n, 1, parts).select(json.alias("json"), dt.alias("dt"))


def _files(path, batch):
    return sorted(x for x in Path(path).glob(f"dt=*/batch_id={batch}/*") if not x.name.startswith("."))


def test_many_days(spark, tmp_path):
    path, rows = str(tmp_path / "out"), _log(spark, 400, 40, 6)
    for batch in (0, 0, 1):
        sinks.append_days(rows, path, batch)
    sinks.append_days(rows.filter("dt < '2024-01-03'").limit(3), f"file://{path}", 1)
    assert len(_files(path, 0)) == 40 and len(_files(path, 1)) == 40
    found = stored_text(spark, path).groupBy(F.col("dt").cast("string"), "batch_id").count().collect()
    assert sum(r["count"] for r in found if r.batch_id == 0) == 400
    lines = sorted(x for f in _files(path, 0) for x in f.read_text().split("\n")[:-1])
    assert lines == sorted(r.json or "" for r in rows.collect())


def test_large_day(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "DAY_ROWS", 50)
    path, rows = str(tmp_path / "out"), _log(spark, 1000, 1, 3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which joins parts as small as these
    try:
        for _ in range(2):
            sinks.append_days(rows, path, 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [len(f.read_text().split("\n")) - 1 for f in _files(path, 0)]
    assert len(sizes) > 1 and sum(sizes) == 1000 and stored_text(spark, path).count() == 1000
