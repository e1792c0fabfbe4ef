"""Members of a structured dislike value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .javasem import blank, trim_control

_SCHEMA = "id string, category string, tags array<string>"


def dislike_rules(value: Column) -> Column:
    """``id:``, ``category:`` and ``tag:`` members of a JSON object, trimmed, distinct, in that order.

    Blank parts are skipped; anything but an object gives an empty array.
    """
    parsed = F.from_json(F.when(F.json_object_keys(value).isNotNull(), value), _SCHEMA)
    labelled = F.concat(
        F.array(
            F.struct(F.lit("id:").alias("k"), parsed["id"].alias("v")),
            F.struct(F.lit("category:").alias("k"), parsed["category"].alias("v")),
        ),
        F.transform(F.coalesce(parsed["tags"], F.array().cast("array<string>")), lambda t: F.struct(F.lit("tag:").alias("k"), t.alias("v"))),
    )
    filled = F.filter(labelled, lambda x: ~blank(x["v"]))
    return F.array_distinct(F.transform(filled, lambda x: F.concat(x["k"], trim_control(x["v"]))))
