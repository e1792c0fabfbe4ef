"""Schemas, feature names and fixed values that all layers share."""

from __future__ import annotations

# Fixed values.
DAY = 86_400
WINDOWS = (1, 7, 30)
ACTIONS = ("click", "expose", "buy", "collect", "stay")
INSERT, DELETE = "INSERT", "DELETE"
ENTITY_TYPES = ("user", "item", "event")
#: Operations that an envelope may name; others make the message invalid.  Deployments may extend it.
ALLOWED_OPERATIONS = (INSERT, DELETE)
#: An epoch below this is in seconds, otherwise in milliseconds.
MILLIS_FROM = 100_000_000_000

EVENT_FIELDS = ("userId", "itemId", "scene", "type", "value", "time", "traceId")
ITEM_FIELDS = ("id", "scene", "pubTime", "modifyTime")
USER_FIELDS = ("id", "loginTime", "registerTime")
FIELDS = {"event": EVENT_FIELDS, "item": ITEM_FIELDS, "user": USER_FIELDS}

UPDATE_COLUMNS = ("entity_type", "entity_id", "counterpart_id", "scene", "event_type", "value", "event_time")
COUNTERPART = {"user": "event_unique_item_count", "item": "event_unique_user_count"}


def feature_names(entity_type: str) -> list[str]:
    """The eighteen features of an entity type, in their order."""
    return [
        "event_count",
        "event_value_sum",
        "event_value_mean",
        "event_active_days",
        "event_unique_scene_count",
        COUNTERPART[entity_type],
        "event_first_time",
        "event_last_time",
        "event_recency_seconds",
        *[f"event_count_{n}d" for n in WINDOWS],
        *[f"event_{a}_count" for a in ACTIONS],
        "event_click_rate",
    ]
