"""The same results in SQL, from the tables themselves."""

from __future__ import annotations

from ..contract import ACTIONS, DAY, WINDOWS, feature_names
from .queries import AS_OF, PRUNED_FROM, SNAPSHOT_NAMES, TOP

_EVENTS = """ev AS (SELECT CAST(user_id AS VARCHAR) AS userid, json_extract_string(props, '$.k') AS itemid,
  's' || (event_id % 7) AS scene, CASE WHEN event_type = 'view' THEN 'expose' WHEN event_type = 'purchase' THEN 'buy'
  WHEN event_type = 'signup' THEN 'collect' WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'stay' ELSE event_type END AS action,
  value, epoch_us(ts) // 1000000 AS t, event_id AS seq, strftime(ts, '%Y-%m-%d') AS day,
  CASE WHEN event_id % 3 = 0 THEN 'trace-' || event_id END AS trace FROM events)"""
_FULL = "(SELECT * FROM ev WHERE userid IS NOT NULL AND itemid IS NOT NULL)"


def _updates(events: str, full: str) -> str:
    return f"""{events}, upd AS (SELECT 'user' AS entity_type, userid AS entity_id, itemid AS counterpart_id, scene,
  action AS event_type, coalesce(value, 0.0) AS value, t AS event_time, seq, day FROM {full}
  UNION ALL SELECT 'item', itemid, userid, scene, action, coalesce(value, 0.0), t, seq, day FROM {full})"""


_UPDATES = _updates(_EVENTS, _FULL)
# nulls and blanks as the adapter puts them in
_ODD = f"""{_EVENTS.replace("ev AS", "plain AS", 1)}, ev AS (SELECT t, seq, day, trace, CASE WHEN seq % 4 <> 0 THEN scene END AS scene,
  CASE WHEN seq % 5 <> 0 THEN action END AS action, CASE WHEN seq % 6 = 0 THEN ' ' || chr(9) ELSE userid END AS userid,
  CASE WHEN seq % 9 = 0 THEN NULL WHEN seq % 10 = 0 THEN '' ELSE itemid END AS itemid, CASE WHEN seq % 11 <> 0 THEN value END AS value FROM plain)"""
_ODD_FULL = "(SELECT * FROM ev WHERE userid <> ' ' || chr(9) AND itemid <> '')"
_ITEMS = """it AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_brand AS scene, p_name AS title, 1700000000 + p_partkey * 3600 AS pub,
  p_partkey AS k FROM part)"""
_USERS = """us AS (SELECT c_custkey AS k, epoch_us(min(o_orderdate)) // 1000000 AS first, epoch_us(max(o_orderdate)) // 1000000 AS last
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey)"""
_COUNTERPART = "event_counterpart_count"
_NAMES = [_COUNTERPART if n == "event_unique_item_count" else n for n in feature_names("user")]


def _aggregates(row: str, last: str, at: str) -> str:
    """Select list of the features over the rows ``row`` of a group."""
    cols = [
        "CAST(count(*) AS DOUBLE) AS event_count",
        f"round(sum({row}.value), 6) AS event_value_sum",
        f"round(sum({row}.value), 6) / count(*) AS event_value_mean",
        f"CAST(count(DISTINCT {row}.event_time // {DAY}) AS DOUBLE) AS event_active_days",
        f"CAST(count(DISTINCT {row}.scene) AS DOUBLE) AS event_unique_scene_count",
        f"CAST(count(DISTINCT {row}.counterpart_id) AS DOUBLE) AS {_COUNTERPART}",
        f"CAST(min({row}.event_time) AS DOUBLE) AS event_first_time",
        f"CAST({last} AS DOUBLE) AS event_last_time",
        f"CAST(greatest(0, {at} - {last}) AS DOUBLE) AS event_recency_seconds",
    ]
    for n in WINDOWS:
        start = f"greatest({at} - {n * DAY}, {last} - {max(WINDOWS) * DAY})"
        cols.append(f"CAST(count(*) FILTER (WHERE {row}.event_time >= {start}) AS DOUBLE) AS event_count_{n}d")
    acts = {a: f"count(*) FILTER (WHERE {row}.event_type = '{a}')" for a in ACTIONS}
    cols += [f"CAST({x} AS DOUBLE) AS event_{a}_count" for a, x in acts.items()]
    both = f"({acts['click']} + {acts['expose']})"
    cols.append(f"CASE WHEN {both} = 0 THEN 0.0 ELSE {acts['click']} / CAST({both} AS DOUBLE) END AS event_click_rate")
    return ", ".join(cols)


def _features(at: str = "l") -> str:
    return f"""SELECT u.entity_type, u.entity_id, CAST({at} AS BIGINT) AS as_of_time, {_aggregates("u", "l", at)}
  FROM upd u JOIN (SELECT entity_type, entity_id, greatest(0, max(event_time)) AS l FROM upd GROUP BY ALL) x
  ON u.entity_type = x.entity_type AND u.entity_id = x.entity_id GROUP BY u.entity_type, u.entity_id, l"""


def _own(kind: str) -> str:
    names = ", ".join(f"{_COUNTERPART} AS {n}" if n.startswith("event_unique_") and "scene" not in n else n for n in feature_names(kind))
    return f"WITH {_UPDATES}, f AS ({_features()}) SELECT entity_id, as_of_time, {names} FROM f WHERE entity_type = '{kind}'"


def _long() -> str:
    parts = []
    for kind in ("user", "item"):
        for own, name in zip(_NAMES, feature_names(kind), strict=True):
            parts.append(f"SELECT entity_type, entity_id, '{name}' AS feature, {own} AS value FROM f WHERE entity_type = '{kind}'")
    return f"WITH {_UPDATES}, f AS ({_features()}) " + " UNION ALL ".join(parts)


_RUNNING = f"""run AS (SELECT a.entity_type, a.entity_id, a.seq, CAST(a.l AS BIGINT) AS as_of_time, {_aggregates("b", "a.l", "a.l")}
  FROM (SELECT *, greatest(0, max(event_time) OVER (PARTITION BY entity_type, entity_id ORDER BY seq)) AS l FROM upd) a
  JOIN upd b ON a.entity_type = b.entity_type AND a.entity_id = b.entity_id AND b.seq <= a.seq
  GROUP BY a.entity_type, a.entity_id, a.seq, a.l)"""
_DAY = "strftime(make_timestamp(CAST({} AS BIGINT) * 1000), '%Y-%m-%d')"
_KEY = """CASE WHEN trace IS NOT NULL THEN trace ELSE t || '#' || userid || '#' || itemid || '#' || scene || '#' || action END"""

_ODD_KEY = "CASE WHEN trace IS NOT NULL THEN trace ELSE t || '#' || userid || '#' || itemid || '#' || coalesce(scene, '') || '#' || coalesce(action, '') END"


def _snapshots() -> str:
    return f"{_UPDATES}, f AS ({_features()})"


_READ_BACK = ", ".join(SNAPSHOT_NAMES)
_NEWEST = f"""s AS (SELECT *, CAST(CASE WHEN k % 3 = 0 THEN pub * 1000 ELSE pub END AS DOUBLE) AS score FROM it),
r AS (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY score DESC, id DESC) AS n FROM s)"""

_MEMBERS = "'event:{{' || userid || '}}:' || coalesce(scene, 'null') || ':' || {}"

SQL: dict[str, str] = {
    "user_features": _own("user"),
    "item_features": _own("item"),
    "features_as_of": f"WITH {_UPDATES} " + " UNION ALL ".join(_features(str(t)) for t in AS_OF),
    "features_long": _long(),
    "running_snapshots": f"WITH {_UPDATES}, {_RUNNING} SELECT * FROM run",
    "microbatch_snapshots": f"""WITH {_UPDATES}, {_RUNNING}, ends AS (SELECT entity_type, entity_id, day, max(seq) AS seq FROM upd GROUP BY ALL)
SELECT run.*, ends.day FROM run JOIN ends ON run.entity_type = ends.entity_type AND run.entity_id = ends.entity_id AND run.seq = ends.seq""",
    "feature_updates": f"""WITH {_UPDATES} SELECT entity_type, entity_id, counterpart_id, scene, event_type, value,
  CAST(event_time AS BIGINT) AS event_time, seq FROM upd""",
    "event_row_keys": f"WITH {_EVENTS} SELECT 'event' AS type, {_KEY} AS row_key, 'INSERT' AS operation, seq FROM {_FULL}",
    "item_records": f"""WITH {_ITEMS} SELECT 'item' AS type, id AS row_key, 'INSERT' AS operation, CAST(k AS BIGINT) AS seq, scene FROM it
UNION ALL SELECT 'item', id, 'DELETE', k + 1000000, CASE WHEN k % 2 = 1 THEN scene END FROM it WHERE k % 11 = 0""",
    "user_records": f"""WITH {_USERS} SELECT 'user' AS type, CAST(k AS VARCHAR) AS row_key, 'INSERT' AS operation, k AS seq,
  CAST(first AS VARCHAR) AS registerTime FROM us""",
    "event_partitions": f"WITH {_EVENTS} SELECT seq, {_DAY.format('t * 1000')} AS dt FROM ev",
    "item_partitions": f"""WITH {_ITEMS} SELECT CAST(k AS BIGINT) AS seq, CASE WHEN k % 7 = 0 THEN '1970-01-01' ELSE {_DAY.format("pub * 1000")} END AS dt FROM it
UNION ALL SELECT k + 1000000, {_DAY.format("1700000000000 + k")} FROM it WHERE k % 11 = 0""",
    "user_partitions": f"""WITH {_USERS} SELECT k AS seq, {_DAY.format("coalesce(CASE WHEN k % 4 <> 0 THEN last ELSE first END, 0) * 1000")} AS dt FROM us""",
    "envelope_decode": f"""WITH {_EVENTS}, n AS (SELECT *, seq % 10 AS n, seq % 10 IN (0, 3, 5, 9) AS valid FROM ev)
SELECT seq, valid, CASE WHEN valid THEN CASE WHEN n = 3 THEN 'DELETE' ELSE 'INSERT' END END AS operation,
  CASE WHEN valid THEN CASE WHEN n IN (0, 5) THEN 0 ELSE CAST('17' || t AS BIGINT) END END AS occurred_at,
  CASE WHEN valid THEN userid END AS user_id, CASE WHEN valid THEN itemid END AS item_id FROM n""",
    "typed_projection": f"WITH {_EVENTS} SELECT userid AS user_id, itemid AS item_id, action AS event_type, CAST(t AS BIGINT) AS event_time FROM ev",
    "entity_store_latest": f"""WITH {_EVENTS}, {_ITEMS} SELECT 'event' AS type, {_KEY} AS row_key, max(seq) AS seq FROM {_FULL} GROUP BY ALL
UNION ALL SELECT 'item', id, k FROM it WHERE k % 11 <> 0 UNION ALL SELECT 'user', CAST(c_custkey AS VARCHAR), c_custkey FROM customer""",
    "user_kv": f"WITH {_USERS} SELECT 'user:{{' || k || '}}' AS key, k AS seq, CAST(first AS VARCHAR) AS registerTime FROM us",
    "item_kv": f"WITH {_ITEMS} SELECT 'item:{{' || id || '}}' AS key, CAST(k AS BIGINT) AS seq, scene, title FROM it WHERE k % 11 <> 0",
    "event_zset": f"""WITH {_EVENTS} SELECT {_MEMBERS.format("coalesce(action, 'null')")} AS key, itemid AS member,
  CAST(arg_max(t, seq) AS DOUBLE) AS score FROM {_FULL} GROUP BY ALL""",
    "dislike_zset": f"""WITH {_EVENTS}, d AS (SELECT *, unnest(['id:' || itemid, 'category:c' || (seq % 5), 'tag:t' || (seq % 3)]) AS member
  FROM {_FULL} WHERE action = 'error')
SELECT {_MEMBERS.format("'dislike'")} AS key, member, CAST(arg_max(t, seq) AS DOUBLE) AS score FROM d GROUP BY ALL""",
    "new_items_topn": f"""WITH {_ITEMS}, s AS (SELECT *, CAST(CASE WHEN k % 3 = 0 THEN pub * 1000 ELSE pub END AS DOUBLE) AS score FROM it WHERE k % 11 <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY score DESC, id DESC) AS n FROM s)
SELECT 'new:{{' || scene || '}}' AS key, id AS member, score FROM r WHERE n <= {TOP}""",
    "item_delete_scene": f"WITH {_ITEMS} SELECT id, scene, CAST(k + 1000000 AS BIGINT) AS seq FROM it WHERE k % 11 = 0",
    "raw_append_roundtrip": f"WITH {_EVENTS} SELECT CAST(day AS VARCHAR) AS dt, count(*) AS n, count(DISTINCT userid) AS users FROM ev GROUP BY day",
    "partition_pruned_read": f"WITH {_EVENTS} SELECT CAST(day AS VARCHAR) AS dt, count(*) AS n FROM ev WHERE day >= '{PRUNED_FROM}' GROUP BY day",
    "stream_features": _own("user"),
    "odd_features": f"WITH {_updates(_ODD, _ODD_FULL)} {_features()}",
    "odd_row_keys": f"WITH {_ODD} SELECT 'event' AS type, {_ODD_KEY} AS row_key, seq FROM {_ODD_FULL}",
    "odd_event_zset": f"""WITH {_ODD} SELECT {_MEMBERS.format("coalesce(action, 'null')")} AS key, itemid AS member,
  CAST(arg_max(t, seq) AS DOUBLE) AS score FROM {_FULL} GROUP BY ALL""",
    "snapshot_kv": f"""WITH {_snapshots()} SELECT 'feature:' || entity_type || ':{{' || entity_id || '}}' AS key, entity_type, as_of_time, {_READ_BACK} FROM f""",
    "snapshot_files": f"WITH {_snapshots()} SELECT entity_id, CASE WHEN entity_type = 'user' THEN 0 ELSE 1 END AS batch_id, {_READ_BACK} FROM f",
    "multi_sink_batches": f"""WITH {_ITEMS}, {_NEWEST}
SELECT 'kv' AS sink, 'item:{{' || id || '}}' AS name, '' AS member FROM it WHERE k % 11 <> 0
UNION ALL SELECT 'store', id, '' FROM it WHERE k % 11 <> 0
UNION ALL SELECT 'index', 'new:{{' || scene || '}}', id FROM r WHERE n <= {TOP} AND k % 11 <> 0
UNION ALL SELECT 'day', dt, CAST(count(*) AS VARCHAR) FROM (
  SELECT {_DAY.format("pub * 1000")} AS dt FROM it WHERE k % 7 <> 0 UNION ALL SELECT {_DAY.format("1700000000000 + k")} FROM it WHERE k % 11 = 0) GROUP BY dt""",
}
