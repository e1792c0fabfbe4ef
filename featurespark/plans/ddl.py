"""Catalog tables over the day-partitioned raw records."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..contract import ENTITY_TYPES


def create_tables(spark: SparkSession, root: str, database: str = "entities") -> list[str]:
    """Create the database and an external text table for each entity type, if they aren't there."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for kind in ENTITY_TYPES:
        names.append(f"{database}.{kind}_entity")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {names[-1]} (json STRING, dt STRING) USING text PARTITIONED BY (dt) LOCATION '{root}/{kind}'")
    return names


def register_all(spark: SparkSession, name: str) -> None:
    """Register every partition folder: once, after the table is made."""
    spark.catalog.recoverPartitions(name)


def register_day(spark: SparkSession, name: str, day: str) -> None:
    """Register one day's folder without listing the others."""
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (dt = '{day}')")
