"""Projections against a replay of the operations in order."""

import json
import random

from featurespark.operators.envelope import decode
from featurespark.operators.records import records
from featurespark.operators.serving import deleted_scenes, entity_kv, entity_store, event_index, new_items, snapshot_kv
from featurespark.operators import features as fe

from test_features import event, frame


def decoded(spark, kind, values):
    return decode(spark.createDataFrame([(json.dumps(v), i) for i, v in enumerate(values)], "json string, seq bigint"), kind)


def delete(kind, data):
    return {"schemaVersion": 1, "entityType": kind, "operation": "DELETE", "data": data}


def replay_items(log):
    stored, index = {}, {}
    for m in log:
        gone = "data" in m
        d = m["data"] if gone else m
        if gone:
            scene = d.get("scene", stored.get(d["id"], {}).get("scene"))
            stored.pop(d["id"], None)
            if scene is not None:
                index.pop((scene, d["id"]), None)
        else:
            stored[d["id"]] = d
            if (d.get("scene") or "").strip():
                index[d["scene"], d["id"]] = float(d.get("pubTime", 0))
    return stored, index


def test_items_as_replayed(spark):
    rng = random.Random(3)
    for _ in range(3):
        log = []
        for k in range(40):
            d = {"id": rng.choice("abcd")} | ({"scene": rng.choice(["x", "y", " "])} if rng.random() < 0.8 else {})
            log.append(delete("item", d) if rng.random() < 0.3 else d | {"pubTime": str(k)})
        stored, index = replay_items(log)
        df = decoded(spark, "item", log)
        assert {r.key: json.loads(r.value) for r in entity_kv(df, "item").collect()} == {f"item:{{{k}}}": v for k, v in stored.items()}
        got = {(r.key, r.member): r.score for r in new_items(df, 0).collect()}
        assert got == {(f"new:{{{s}}}", i): v for (s, i), v in index.items()}


def test_scene_change_leaves_the_old_entry(spark):
    log = [{"id": "a", "scene": "x", "pubTime": "1"}, {"id": "a", "scene": "y", "pubTime": "2"}, delete("item", {"id": "a"})]
    assert [(r.key, r.member) for r in new_items(decoded(spark, "item", log)).collect()] == [("new:{x}", "a")]
    assert [(r.id, r.scene) for r in deleted_scenes(decoded(spark, "item", log)).collect()] == [("a", "y")]


def test_top_items(spark):
    log = [{"id": k, "scene": "x", "pubTime": t} for k, t in (("a", "1"), ("b", "2"), ("c", "1"))]
    top = lambda n: sorted(r.member for r in new_items(decoded(spark, "item", log), n).collect())
    assert (top(2), top(0)) == (["b", "c"], ["a", "b", "c"])


def test_event_index(spark):
    base = {"userId": "u", "itemId": "i", "time": "5"}
    log = [
        base,
        base | {"time": "3"},
        base | {"scene": "s", "type": "DISLIKE", "value": '{"id":"x","tags":["t"]}'},
        base | {"type": "dislike", "value": "none"},
        {"userId": " ", "itemId": "i", "type": "click", "time": "bad"},
        delete("event", base | {"type": "buy"}),
    ]
    got = {(r.key, r.member, r.score) for r in event_index(decoded(spark, "event", log)).collect()}
    assert got == {
        ("event:{u}:null:null", "i", 3.0),
        ("event:{u}:s:DISLIKE", "id:x", 5.0),
        ("event:{u}:s:DISLIKE", "tag:t", 5.0),
        ("event:{ }:null:click", "i", 0.0),
        ("event:{u}:null:buy", "i", 5.0),
    }


def test_store_honours_deletes_and_rejects_blanks(spark):
    log = [{"id": "a"}, {"id": "b"}, delete("user", {"id": "a"}), {"id": " "}]
    df = decoded(spark, "user", log)
    assert [r.row_key for r in entity_store(records(df, "user")).collect()] == ["b"]
    assert sorted(r.key for r in entity_kv(df, "user").collect()) == ["user:{ }", "user:{b}"]


def test_snapshot_kv(spark):
    rows = snapshot_kv(fe.snapshots(fe.entity_features(frame(spark, [event(t=7)])))).collect()
    value = {r.key: json.loads(r.value) for r in rows}
    assert sorted(value) == ["feature:item:{i}", "feature:user:{u}"]
    assert list(value["feature:user:{u}"]) == ["entityType", "entityId", "asOfTime", "features"]
    assert value["feature:user:{u}"]["features"]["event_last_time"] == 7.0
