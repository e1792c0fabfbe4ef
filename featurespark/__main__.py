"""Run the four streams until one of them ends: ``python -m featurespark settings.properties``."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from .config import Config
from .streaming.jobs import prepared, start


def main(args: list[str]) -> None:
    if len(args) != 1:
        sys.exit(__doc__)
    config = Config.load(args[0])
    spark = prepared(SparkSession.builder.appName("features").config("spark.sql.session.timeZone", "UTC").getOrCreate(), config)
    start(spark, config)
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main(sys.argv[1:])
