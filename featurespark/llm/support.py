"""What the operators share on the Spark side: shared storage, sizes and worker paths."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null doc_id inside an operator; it sorts after every other id.
NO_ID = (1 << 63) - 1
#: The word pattern of the contracts.
WORD = "[^\\x20\\x09-\\x0D]+"


#: Rows and bytes of an Arrow batch at most; whole texts are long, and a batch is held by the JVM and by its worker.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1_000, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Set the session's Arrow batches to ``BATCHES`` at most.

    The settings count when a plan runs, so operators can't set and restore them; the queries and the pipeline call this, and
    so should other callers with long texts.
    """
    for name, most in BATCHES.items():
        now = str(spark.conf.get(name)).rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(name, str(most))
    return spark


def session(df: DataFrame) -> SparkSession:
    """The frame's session, whose Python workers can import this package."""
    spark = df.sparkSession
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session.  One is made here only in local mode, where driver and executors are one process."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not re.match(r"local(\[[^,]*(,[^,]*)?\])?$", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc.getCheckpointDir()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a folder of its own in the shared folder, and reread."""
    spark = session(df)
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def saved(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_folder(session(df))
    return df.checkpoint(eager=True)


def input_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the frame's sources, which is the file size for a scan."""
    size = 0
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        size += int(str(leaves.apply(i).stats().sizeInBytes()))
    return size


def block_count(df: DataFrame, bytes_each: int, least: int = 4, most: int = 1 << 20) -> int:
    """Blocks so that each stands for ``bytes_each`` of input at most; in proportion to the input."""
    size = input_bytes(df)
    if size >= 1 << 60:  # a source without statistics
        return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return min(most, max(least, -(-size // bytes_each)))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened where the frame has such columns already."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bounded_batches(spark).read.parquet(f"{sf_dir}/documents.parquet")


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """``doc`` and ``tag`` name a row without nulls: its id, and a hash of its text for rows that share an id."""
    session(docs)
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64("text").alias("tag"),
        F.col("text").cast("string").alias("text"),
        *more,
    )


def public_id(name: str = "doc"):
    """The doc_id for a ``doc`` of :func:`keyed`."""
    return F.when(F.col(name) != NO_ID, F.col(name)).alias("doc_id")
