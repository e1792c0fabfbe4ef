"""Parsing, decoding, records, partitions and dislike rules, one frame for each group of cases."""

import json

from pyspark.sql import functions as F

from featurespark.config import Config
from featurespark.functions.dislike import dislike_rules
from featurespark.functions.javasem import blank, epoch_millis, parse_double, parse_long, trim_control, utc_day
from featurespark.operators.envelope import decode
from featurespark.operators.records import day, records, typed_events


def rows(spark, values, *columns):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def test_blank_strips_controls_only(spark):
    cases = {None: True, "": True, " \t\n\r\x00": True, " ": False, "\u0085": False, " a ": False}
    assert [r[0] for r in rows(spark, list(cases), blank(F.col("x")))] == list(cases.values())
    assert rows(spark, ["\tx y\n", " z"], trim_control(F.col("x"))) == [("x y",), (" z",)]


def test_numbers(spark):
    longs = {"12": 12, "-3": -3, "+4": 4, " 12": 0, "12.5": 0, None: 0, "": 0, "9223372036854775807": 2**63 - 1, "9223372036854775808": 0, "1\n": 0}
    assert [r[0] for r in rows(spark, list(longs), parse_long(F.col("x")))] == list(longs.values())
    doubles = {"1.5": 1.5, " 2 ": 2.0, "3e2": 300.0, "1d": 1.0, "4f": 4.0, ".5": 0.5, "abc": 0.0, None: 0.0, "nan": 0.0, "inf": 0.0, "Infinity": float("inf"), "0x1p3": 8.0}
    assert [r[0] for r in rows(spark, list(doubles), parse_double(F.col("x")))] == list(doubles.values())
    assert rows(spark, ["NaN"], parse_double(F.col("x")).cast("string")) == [("NaN",)]


def test_days(spark):
    times = {"1700000000": "2023-11-14", "1700000000000": "2023-11-14", "x": "1970-01-01", None: "1970-01-01", "-1": "1969-12-31"}
    millis = epoch_millis(F.col("x"), F.lit(0).cast("bigint"))
    assert [r[0] for r in rows(spark, list(times), utc_day(millis))] == list(times.values())


def decoded(spark, kind, values):
    return decode(spark.createDataFrame([(v, i) for i, v in enumerate(values)], "json string, seq bigint"), kind)


def test_row_keys(spark):
    event = {"time": "10", "userId": "u1", "itemId": "i1", "scene": "home", "type": "click"}
    values = [json.dumps(event), json.dumps(event | {"traceId": "t1"}), json.dumps({"userId": "u1"}), "{bad-json", None, json.dumps(event | {"userId": " "})]
    found = records(decoded(spark, "event", values), "event").orderBy("seq").select("row_key", "seq").collect()
    assert [tuple(r) for r in found] == [("10#u1#i1#home#click", 0), ("t1", 1)]
    assert [r.row_key for r in records(decoded(spark, "user", ['{"id":"u1"}', "{}"]), "user").collect()] == ["u1"]


def test_envelopes(spark):
    data = {"id": "i1"}
    good = {"schemaVersion": 1, "entityType": "item", "operation": "DELETE", "occurredAt": 1700000000000, "data": data}
    cases = [
        (good, ("DELETE", 1700000000000)),
        (good | {"entityType": "user"}, None),
        ({k: v for k, v in good.items() if k != "data"}, None),
        (good | {"operation": "delete"}, None),
        (good | {"occurredAt": None}, None),
        ({k: v for k, v in good.items() if k != "occurredAt"}, ("DELETE", 0)),
        (good | {"occurredAt": 12.7}, ("DELETE", 12)),
        ({"id": "i2"}, ("INSERT", 0)),
        (good | {"schemaVersion": None}, ("DELETE", 1700000000000)),
        ([1], None),
    ]
    got = decoded(spark, "item", [json.dumps(c) for c, _ in cases]).orderBy("seq").collect()
    assert [r.message and (r.message.operation, r.message.occurred_at) for r in got] == [e for _, e in cases]
    assert got[0].entity.id == "i1" and got[7].message.data_json == '{"id": "i2"}'


def test_entities_need_scalars_and_objects(spark):
    got = decoded(spark, "event", ['{"userId":{"a":1},"itemId":"i"}', '{"userId":7,"itemId":"i","value":"{\\"id\\":\\"x\\"}"}']).orderBy("seq").collect()
    assert got[0].entity is None and (got[1].entity.userId, got[1].entity.value) == ("7", '{"id":"x"}')
    quoted = {"schemaVersion": 1, "entityType": "user", "operation": "INSERT", "data": '{"id":"u"}'}
    assert decoded(spark, "user", [json.dumps(quoted)]).first().entity is None


def test_partition_days(spark):
    now = F.lit(0).cast("bigint")
    item = [{"pubTime": "1700000000000"}, {"modifyTime": "", "pubTime": "1700000000"}, {"modifyTime": "bad", "pubTime": "1700000000"}]
    delete = {"schemaVersion": 1, "entityType": "item", "operation": "DELETE", "occurredAt": 1700000000000, "data": {"id": "i"}}
    values = [json.dumps(x) for x in [*item, delete]] + ["{bad"]
    got = day(decoded(spark, "item", values), "item", now).orderBy("seq").collect()
    assert [r.dt for r in got] == ["2023-11-14", "2023-11-14", "1970-01-01", "2023-11-14", "1970-01-01"]
    assert day(decoded(spark, "user", ['{"registerTime":"1700000000"}']), "user", now).first().dt == "2023-11-14"
    assert day(decoded(spark, "event", ["{}"]), "event", now).first().dt == "1970-01-01"


def test_typed_projection(spark):
    raw = spark.createDataFrame([('{"userId":"u","itemId":"i","type":"click","time":"12"}',), ('{"time":"x"}',)], "json string")
    assert [tuple(r) for r in typed_events(raw).collect()] == [("u", "i", "click", 12), (None, None, None, None)]


def test_dislike_rules(spark):
    cases = {
        '{"id":"i1","category":"c1","tags":["t1","t2"]}': ["id:i1", "category:c1", "tag:t1", "tag:t2"],
        '{"id":"\\ti1 ","tags":["a"," a ","",null]}': ["id:i1", "tag:a"],
        "[1]": [],
        "text": [],
        None: [],
        "{}": [],
    }
    assert [r[0] for r in rows(spark, list(cases), dislike_rules(F.col("x")))] == list(cases.values())


def test_config(tmp_path):
    path = tmp_path / "dp.properties"
    path.write_text("# c\nredis.new.max-items=5\nhive.enabled=false\njob.parallelism = 7\nkafka.groupId=g\nunknown=1\n")
    c = Config.load(path)
    assert (c.redis_new_max_items, c.hive_enabled, c.hbase_enabled, c.job_parallelism, c.kafka_groupId) == (5, False, True, 7, "g")
    assert c.topic("item") == "item"
