"""Job settings under their property names, with the defaults of the jobs."""

from __future__ import annotations

from dataclasses import dataclass, fields
from pathlib import Path


@dataclass(frozen=True)
class Config:
    kv_path: str = "serving"
    store_path: str = "store"
    hdfs_output: str = "output"
    checkpoint_path: str = "checkpoints"
    redis_new_max_items: int = 10_000
    hbase_enabled: bool = True
    hive_enabled: bool = True
    hbase_table_prefix: str = "entity_"
    kafka_servers: str = ""
    kafka_user_topic: str = "user"
    kafka_item_topic: str = "item"
    kafka_event_topic: str = "event"
    kafka_groupId: str = "features-spark"  # noqa: N815
    #: Shuffle partitions of the running jobs, milliseconds between their batches, and whether every update gets a snapshot.
    job_parallelism: int = 2
    checkpoint_interval_ms: int = 60_000
    feature_every_update: bool = False

    @classmethod
    def load(cls, path: str | Path) -> Config:
        """Read a ``key=value`` properties file; a missing file is an error, unknown keys are ignored."""
        known = {f.name.replace("_", "").lower(): f for f in fields(cls)}
        values = {}
        for line in Path(path).read_text().splitlines():
            key, sep, value = line.partition("=")
            name = key.strip().replace(".", "").replace("-", "").replace("_", "").lower()
            if not sep or key.lstrip().startswith("#") or name not in known:
                continue
            kind, value = known[name].type, value.strip()
            values[known[name].name] = value.lower() == "true" if kind == "bool" else int(value) if kind == "int" else value
        return cls(**values)

    def topic(self, entity_type: str) -> str:
        return getattr(self, f"kafka_{entity_type}_topic")
