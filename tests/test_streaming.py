"""Streams end where batches do, also after a restart and a repeated batch."""

import json

import pytest
from pyspark.sql import functions as F

from featurespark.config import Config
from featurespark.contract import DAY
from featurespark.operators import features as fe
from featurespark.operators.envelope import decode
from featurespark.operators.updates import events_of, updates
from featurespark.plans.ddl import create_tables, register_all, register_day
from featurespark.sources.readers import KAFKA_SEQ, kafka_options, stored_text, text_stream
from featurespark.sources.sinks import DeltaTable, append_days
from featurespark.streaming.jobs import entity_table, feature_writer, index_table, kv_table, persist_raw, prepared, raw_writer, serving_items, start


def event_log():
    times = [5, 3 * DAY, 40 * DAY, 2 * DAY, 41 * DAY, 10 * DAY]
    kinds = ["click", "expose", "buy", "click", "other", None]
    return [
        {"userId": f"u{k % 2}", "itemId": f"i{k % 3}", "scene": [None, "s"][k % 2], "type": kinds[k], "value": str(k / 2), "time": str(times[k])}
        for k in range(6)
    ]


def write(folder, part, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"part-{part}.txt").write_text("".join(json.dumps(r) + "\n" for r in rows))


def config(path, **more):
    return Config(**more, kv_path=f"{path}/kv", store_path=f"{path}/store", hdfs_output=f"{path}/out", checkpoint_path=f"{path}/ckpt")


def test_features_match_the_batch_after_a_restart(spark, tmp_path):
    log, c = event_log(), config(tmp_path)
    for part in range(2):
        write(tmp_path / "in", part, log[part * 3 : part * 3 + 3])
        feature_writer(spark, text_stream(spark, str(tmp_path / "in")), c).trigger(availableNow=True).start().awaitTermination()
    got = {r.key: json.loads(r.value) for r in kv_table(spark, c, "feature").read().collect()}
    raw = spark.createDataFrame([(json.dumps(r),) for r in log], "json string")
    want = fe.snapshots(fe.entity_features(updates(events_of(decode(raw, "event"))))).collect()
    assert len(got) == len(want) == 5
    for r in want:
        one = got[f"feature:{r.entity_type}:{{{r.entity_id}}}"]
        assert one["asOfTime"] == r.as_of_time and one["features"] == pytest.approx(r.features)
    assert spark.read.text(f"{c.hdfs_output}/features").count() == 2 * 5


def test_raw_sinks(spark, tmp_path):
    c = config(tmp_path)
    rows = [
        {"id": "a", "scene": "x", "pubTime": "1700000000"},
        {"id": "b", "scene": "x", "pubTime": "1700000001"},
        {"schemaVersion": 1, "entityType": "item", "operation": "DELETE", "occurredAt": 1700000000000, "data": {"id": "a"}},
    ]
    for part, some in enumerate((rows[:2], rows[2:])):
        write(tmp_path / "in", part, some)
        stream = text_stream(spark, str(tmp_path / "in"))
        raw_writer(spark, stream, "item", c).trigger(availableNow=True).start().awaitTermination()
    assert [(r.key, r.member) for r in serving_items(spark, c).collect()] == [("new:{x}", "b")]
    assert [r.row_key for r in entity_table(spark, c, "item").read().collect()] == ["b"]
    assert [r.key for r in kv_table(spark, c, "item").read().collect()] == ["item:{b}"]
    assert [tuple(r) for r in spark.read.text(f"{c.hdfs_output}/hive/item").groupBy(F.col("dt").cast("string")).count().collect()] == [("2023-11-14", 3)]


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    c = config(tmp_path)
    batch = spark.createDataFrame([('{"id":"u","loginTime":"1700000000"}', 1), ("{bad", 2)], "json string, seq bigint")
    for _ in range(2):
        persist_raw(spark, batch, 0, "user", c)
    assert spark.read.text(f"{c.hdfs_output}/hive/user").count() == 2
    assert kv_table(spark, c, "user").read().count() == 1


def item(i, scene=None, t=None, gone=False):
    d = {"id": i} | ({"scene": scene} if scene else {}) | ({"pubTime": str(t)} if t is not None else {})
    return json.dumps({"schemaVersion": 1, "entityType": "item", "operation": "DELETE", "data": d} if gone else d)


def test_repeated_item_batches(spark, tmp_path, monkeypatch):
    """Insert, delete without a scene, insert others: each batch once or twice, with and without compaction, to the same tables."""
    batches = [
        [item("a", "x", 1), item("b", "x", 2)],
        [item("a", gone=True), item("c", "x", 3)],
        [item("d", "x", 4), item("e", "y", 1)],
        [item("c", gone=True)],
    ]
    ends = []
    for times, compact in ((1, 100), (2, 2)):
        c = config(tmp_path / f"{times}", redis_new_max_items=2, hive_enabled=False)
        monkeypatch.setattr(DeltaTable.__init__, "__defaults__", ("", 2, compact))
        for n, rows in enumerate(batches):
            batch = spark.createDataFrame([(j, n * 10 + k) for k, j in enumerate(rows)], "json string, seq bigint")
            for _ in range(times):
                persist_raw(spark, batch, n, "item", c)
        tables = [serving_items(spark, c), kv_table(spark, c, "item").read(), entity_table(spark, c, "item").read()]
        ends.append([sorted(map(tuple, t.drop("score").collect())) for t in tables])
    # the limit of two pushed b out when c came, and then c out of x: b doesn't come back when c goes
    assert ends[0][0] == [("new:{x}", "d"), ("new:{y}", "e")] and all(x == ends[0] for x in ends)
    assert [k for k, *_ in ends[0][1]] == ["item:{b}", "item:{d}", "item:{e}"]


def test_delta_table(spark, tmp_path):
    table = DeltaTable(spark, str(tmp_path / "t"), ["key"], "value string", buckets=4, compact_after=3)
    assert table.read().columns == ["key", "value", "seq"] and table.read().count() == 0
    for n in range(10):
        rows = [(f"k{n % 5}", f"v{n}", n, n == 8), ("all", f"v{n}", n, False)] if n != 4 else []
        table.merge(spark.createDataFrame(rows, "key string, value string, seq bigint, deleted boolean"), n)
    want = {"all": "v9", "k0": "v5", "k1": "v6", "k2": "v7", "k4": "v9"}
    assert {r.key: r.value for r in table.read().collect()} == want
    before = {r.key: r.value for r in table.read(before=9).collect()}
    assert before == {"all": "v8", "k0": "v5", "k1": "v6", "k2": "v7"}  # k4 of the empty batch was never written
    only = spark.createDataFrame([("k1",), ("none",)], "key string")
    assert [r.key for r in table.read(only=only).collect()] == ["k1"]
    assert len(table.files("base")) <= 2 and len(table.files("delta")) <= 6
    with pytest.raises(FileNotFoundError):
        DeltaTable(spark, str(tmp_path / "none"), ["key"]).read()


def test_every_update_and_a_late_one(spark, tmp_path):
    log, c = event_log(), config(tmp_path, feature_every_update=True)
    for part in range(2):
        write(tmp_path / "in", part, log[part * 3 : part * 3 + 3])
    prepared(spark, c)
    feature_writer(spark, text_stream(spark, str(tmp_path / "in")), c).trigger(availableNow=True).start().awaitTermination()
    lines = [json.loads(r.value) for r in spark.read.text(f"{c.hdfs_output}/features").collect()]
    raw = spark.createDataFrame([(json.dumps(r), k) for k, r in enumerate(log)], "json string, seq bigint")
    running = fe.running_features(updates(events_of(decode(raw, "event"), ("seq",)), ("seq",)))
    want = {(r.entity_type, r.entity_id, r.event_count): r for r in running.collect()}
    assert len(lines) == len(want) == 12
    for x in lines:
        r = want[x["entityType"], x["entityId"], x["features"]["event_count"]].asDict()
        for name, value in x["features"].items():
            assert value == pytest.approx(r.get(name, r["event_counterpart_count"])), name
    kept = {r.key: json.loads(r.value)["features"]["event_count"] for r in kv_table(spark, c, "feature").read().collect()}
    assert kept["feature:user:{u0}"] == 3 and kept["feature:item:{i2}"] == 2


def test_start_runs_all_four(spark, tmp_path):
    c = config(tmp_path, job_parallelism=3)
    write(tmp_path / "event", 0, event_log())
    write(tmp_path / "item", 0, [{"id": "a", "scene": "x", "pubTime": "1"}])
    write(tmp_path / "user", 0, [{"id": "u"}])
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert prepared(spark, c).conf.get("spark.sql.shuffle.partitions") == "3"
        queries = start(spark, c, lambda s, _, kind: text_stream(s, str(tmp_path / kind)), availableNow=True)
        assert len(queries) == 4
        for q in queries:
            q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert kv_table(spark, c, "user").read().count() == kv_table(spark, c, "item").read().count() == 1
    assert index_table(spark, c, "event").read().count() == 6 and entity_table(spark, c, "event").read().count() == 6
    assert kv_table(spark, c, "feature").read().count() == 5


def test_kafka_source(spark):
    options = kafka_options(Config(kafka_servers="a:1", kafka_groupId="g", kafka_item_topic="things"), "item")
    assert options == {"kafka.bootstrap.servers": "a:1", "subscribe": "things", "startingOffsets": "earliest", "groupIdPrefix": "g"}
    rows = [(1_700_000_000_000, 7), (1_700_000_000_000, 8), (1_700_000_000_001, 1)]
    df = spark.createDataFrame(rows, "ms bigint, offset bigint").selectExpr("timestamp_millis(ms) AS timestamp", "offset").selectExpr(f"{KAFKA_SEQ} AS seq")
    seqs = [r.seq for r in df.collect()]
    assert seqs == sorted(set(seqs))


def test_tables_and_partitions(spark, tmp_path):
    names = create_tables(spark, str(tmp_path / "hive"), "raw_entities")
    assert create_tables(spark, str(tmp_path / "hive"), "raw_entities") == names
    rows = spark.createDataFrame([('{"a":1}', "2024-01-01"), ("{bad", "2024-01-02")], "json string, dt string")
    append_days(rows, str(tmp_path / "hive/user"))
    register_day(spark, names[0], "2024-01-01")
    assert [r.json for r in spark.table(names[0]).collect()] == ['{"a":1}']
    register_all(spark, names[0])
    assert spark.table(names[0]).count() == 2
    pruned = stored_text(spark, str(tmp_path / "hive/user")).filter("dt = '2024-01-02'")
    assert [r.json for r in pruned.collect()] == ["{bad"]
    spark.sql("DROP DATABASE raw_entities CASCADE")
