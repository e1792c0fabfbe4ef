"""The eighteen features against a small model in plain Python."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from featurespark.contract import ACTIONS, DAY, WINDOWS, feature_names
from featurespark.operators import features as fe
from featurespark.operators.updates import updates

EVENT = "userId string, itemId string, scene string, type string, value string, time string, seq bigint"


def model(events, own, other, as_of=None):
    """Features of one entity from its events in order."""
    last = max([0, *[e["t"] for e in events]])
    at = last if as_of is None else as_of
    count = lambda a: sum(e["type"] == a for e in events)
    total = sum(e["v"] for e in events)
    shown = count("click") + count("expose")
    values = [
        len(events),
        total,
        total / len(events),
        len({int(e["t"] / DAY) for e in events}),
        len({e["scene"] for e in events if e["scene"] is not None}),
        len({e[other] for e in events}),
        min(e["t"] for e in events),
        last,
        max(0, at - last),
        *[sum(e["t"] >= max(at - n * DAY, last - 30 * DAY) for e in events) for n in WINDOWS],
        *[count(a) for a in ACTIONS],
        count("click") / shown if shown else 0,
    ]
    return [float(v) for v in values]


def frame(spark, events):
    rows = [(e["u"], e["i"], e["scene"], e["type"], str(e["v"]), str(e["t"]), k) for k, e in enumerate(events)]
    return updates(spark.createDataFrame(rows, EVENT), ("seq",))


def event(u="u", i="i", scene="s", type="click", v=0.0, t=0):  # noqa: A002
    return {"u": u, "i": i, "scene": scene, "type": type, "v": v, "t": t}


def user(spark, events, as_of=None):
    row = fe.for_type(fe.entity_features(frame(spark, events), as_of), "user").first().asDict()
    return {n: row[n] for n in feature_names("user")}


def test_reference_case(spark):
    events = [event(i="i2", scene="s2", type="expose", t=150000), event(i="i1", scene="s1", v=2.0, t=200000)]
    got = user(spark, events)
    assert list(got.values()) == [2, 2, 1, 2, 2, 2, 150000, 200000, 0, 2, 2, 2, 1, 1, 0, 0, 0, 0.5]
    item = fe.for_type(fe.entity_features(frame(spark, events)), "item").filter("entity_id = 'i1'").first()
    assert item.event_unique_user_count == 1


@pytest.mark.parametrize(
    ("events", "as_of", "expected"),
    [
        ([event(t=0), event(t=1), event(t=DAY + 1)], None, {"event_count_1d": 2}),
        ([event(t=40 * DAY), event(t=5 * DAY)], None, {"event_count": 2, "event_active_days": 2, "event_count_30d": 1}),
        ([event(t=-1)], None, {"event_first_time": -1, "event_last_time": 0, "event_active_days": 1}),
        ([event(type="Click"), event(type="view"), event(type=None)], None, {"event_count": 3, "event_click_count": 0}),
        ([event(scene=None), event(scene="")], None, {"event_unique_scene_count": 1}),
        ([event(t=100)], 200, {"event_recency_seconds": 100, "event_count_1d": 1}),
        ([event(t=5 * DAY), event(t=9 * DAY)], 6 * DAY, {"event_recency_seconds": 0, "event_count_1d": 2}),
    ],
)
def test_cases(spark, events, as_of, expected):
    got = user(spark, events, as_of)
    assert {k: got[k] for k in expected} == expected


def test_blank_ids_and_bad_numbers(spark):
    rows = [("u", " ", None, None, None, None, 0), (None, "i", None, None, None, None, 1), ("u", "i", None, None, "abc", " 12", 2)]
    got = updates(spark.createDataFrame(rows, EVENT)).collect()
    assert [(r.entity_type, r.entity_id, r.counterpart_id, r.value, r.event_time) for r in got] == [("user", "u", "i", 0.0, 0), ("item", "i", "u", 0.0, 0)]


TIMES = st.integers(-2 * DAY, 50 * DAY) | st.sampled_from([0, DAY, 30 * DAY, 31 * DAY])
EVENTS = st.lists(
    st.builds(
        event,
        u=st.sampled_from(["u", "w"]),
        i=st.sampled_from(["i", "j", "k"]),
        scene=st.sampled_from([None, "", "s"]),
        type=st.sampled_from([*ACTIONS, "other", None]),
        v=st.sampled_from([0.0, 1.5, -2.0]),
        t=TIMES,
    ),
    min_size=1,
    max_size=25,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events=EVENTS, as_of=st.none() | TIMES)
def test_model(spark, events, as_of):
    df = frame(spark, events)
    names = fe._columns()
    for kind, own, other in (("user", "u", "i"), ("item", "i", "u")):
        got = {r.entity_id: [r[n] for n in names] for r in fe.entity_features(df, as_of).filter(f"entity_type = '{kind}'").collect()}
        want = {x: model([e for e in events if e[own] == x], own, other, as_of) for x in {e[own] for e in events}}
        assert got.keys() == want.keys()
        for k in want:
            assert got[k] == pytest.approx(want[k], abs=1e-9)
    running = {(r.entity_type, r.entity_id, r.seq): [r[n] for n in names] for r in fe.running_features(df).collect()}
    assert len(running) == 2 * len(events)
    for (kind, name, seq), got in running.items():
        own, other = ("u", "i") if kind == "user" else ("i", "u")
        assert got == pytest.approx(model([e for e in events[: seq + 1] if e[own] == name], own, other), abs=1e-9)


def test_snapshot_map_order(spark):
    features = fe.snapshots(fe.entity_features(frame(spark, [event()])))
    keys = features.selectExpr("entity_type", "map_keys(features) AS names")
    assert {r.entity_type: r.names for r in keys.collect()} == {k: feature_names(k) for k in ("user", "item")}
