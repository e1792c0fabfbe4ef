"""Sinks: day-partitioned text, snapshot files, and upserts into key-value tables kept as Parquet."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import suppress
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows of a day that one task writes, about; a larger day is written by several.
DAY_ROWS = 100_000


def _spread(rows: DataFrame) -> DataFrame:
    """``rows`` with each day in one task, or a large one in several, so that a batch of many days has a file for each and not one a task."""
    many = rows.groupBy("dt").count().filter(F.col("count") > DAY_ROWS)
    many = many.select("dt", F.ceil(F.col("count") / DAY_ROWS).alias("_parts"))
    numbered = rows.withColumn("_row", F.monotonically_increasing_id()).join(F.broadcast(many), "dt", "left")
    return numbered.repartition("dt", F.coalesce(F.col("_row") % F.col("_parts"), F.lit(0))).select(*rows.columns)


def _file_system(path: str) -> tuple[fs.FileSystem, str] | None:
    """The file system of a path and the path there; none if only Hadoop has it."""
    scheme, rest = re.fullmatch(r"(?:([a-z][\w+.-]*):)?(.*)", path, re.DOTALL).groups()
    if scheme in (None, "file"):
        return fs.LocalFileSystem(), re.sub(r"^//(?=/)", "", rest)
    try:
        return fs.FileSystem.from_uri(path)
    except (pa.ArrowInvalid, OSError):
        return None


def _write_days(rows: DataFrame, out: fs.FileSystem, root: str, batch_id: int) -> None:
    """The task's days, sorted, each to one file of its own, which replaces those of earlier writes of the batch.

    Hadoop's local files start a process for each new file to set its rights, which takes far longer than writing it; a batch may hold
    tens of thousands of days.  A file gets its name when it is whole, the same in each attempt of a task.
    """
    write = uuid.uuid4().hex

    def close(folder: str, stream, hidden: str) -> None:
        stream.close()
        name = f"{folder}/part-{TaskContext.get().partitionId():05d}-{write}.txt"
        out.move(hidden, name)
        for old in out.get_file_info(fs.FileSelector(folder)):
            if not old.base_name.startswith(".") and write not in old.base_name:
                with suppress(FileNotFoundError):  # another task of the day was faster
                    out.delete_file(old.path)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        day, stream, folder, hidden = "", None, "", ""
        for batch in batches:
            for line, dt in zip(batch.column("json").to_pylist(), batch.column("dt").to_pylist(), strict=True):
                if stream is None or dt != day:
                    if stream is not None:
                        close(folder, stream, hidden)
                    day, folder = dt, f"{root}/dt={'__HIVE_DEFAULT_PARTITION__' if dt is None else dt}/batch_id={batch_id}"
                    hidden = f"{folder}/.{uuid.uuid4().hex}"
                    out.create_dir(folder, recursive=True)
                    stream = out.open_output_stream(hidden)
                stream.write(((line or "") + "\n").encode())
        if stream is not None:
            close(folder, stream, hidden)
        yield from ()

    rows.sortWithinPartitions("dt").mapInArrow(task, "n int").write.format("noop").mode("overwrite").save()


def append_days(rows: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Write ``json`` under ``dt=...``.  With a batch id, writing the same batch again replaces it."""
    rows = rows.select("json", "dt")
    if batch_id is None:
        rows.write.mode("append").partitionBy("dt").text(path)
    elif (found := _file_system(path)) is not None:
        _write_days(_spread(rows), *found, batch_id)
    else:
        rows = _spread(rows).withColumn("batch_id", F.lit(batch_id))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt", "batch_id").text(path)


def write_snapshots(snapshots: DataFrame, path: str, batch_id: int) -> None:
    """Snapshot rows as JSON lines in the batch's own folder, replaced if the batch is written again."""
    columns = [F.col("entity_type").alias("entityType"), F.col("entity_id").alias("entityId"), F.col("as_of_time").alias("asOfTime"), "features"]
    snapshots.select(F.to_json(F.struct(*columns)).alias("value")).write.mode("overwrite").text(f"{path}/batch_id={batch_id}")


#: Buckets of a table's keys, and batches after which its deltas are merged into a new base.
BUCKETS, COMPACT_AFTER = 32, 16


class DeltaTable:
    """A keyed table as a base and the changes of later batches, all in buckets by a hash of the first key column.

    A merge writes the last change of each key in the batch and reads nothing; a read takes the last one by ``seq`` of the base and the
    deltas.  After ``compact_after`` batches they are merged into a new base, and what the base before it had replaced is removed, so
    the files don't grow with the number of batches.  ``deleted`` rows stay as tombstones until then.  The files of a batch
    carry its id: writing a batch again replaces its own, and :meth:`read` can leave out a batch and all later ones, which is what
    a batch must do that looks at the table and may be repeated.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: list[str], values: str = "", buckets: int = BUCKETS, compact_after: int = COMPACT_AFTER
    ) -> None:
        """``values``: the schema of the columns beside the keys, ``seq`` and ``deleted``; a table that isn't written yet is read as empty."""
        self.spark, self.path, self.keys, self.values = spark, path, keys, values
        self.buckets, self.compact_after = buckets, compact_after

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.keys[0]), F.lit(self.buckets)).cast("int").alias("bucket")

    def _fs(self):
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(self.path)
        return hadoop, root.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def files(self, kind: str) -> list[int]:
        """Batch ids of the finished bases or deltas."""
        hadoop, fs = self._fs()
        root = hadoop.Path(f"{self.path}/{kind}")
        if not fs.exists(root):
            return []
        found = [x.getPath() for x in fs.listStatus(root)]
        return sorted(int(p.getName()[2:]) for p in found if p.getName().startswith("v=") and fs.exists(hadoop.Path(p, "_SUCCESS")))

    def _last(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in self.keys]
        return rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), "seq").alias("_row")).select(*self.keys, "_row.*")

    def _schema(self) -> str:
        """Of the rows as they are kept."""
        return ", ".join([*[f"{k} string" for k in self.keys], self.values, "seq bigint", "deleted boolean"])

    def _write(self, rows: DataFrame, kind: str, batch_id: int) -> None:
        rows = rows.withColumns({"seq": F.col("seq").cast("bigint"), "bucket": self._bucket()}).repartition("bucket")
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{kind}/v={batch_id}")

    def _rows(self, before: int | None) -> DataFrame | None:
        """Base and deltas below a batch, with tombstones and buckets."""
        bases = [v for v in self.files("base") if before is None or v < before]
        deltas = [v for v in self.files("delta") if (before is None or v < before) and (not bases or v > bases[-1])]
        paths = [f"{self.path}/base/v={v}" for v in bases[-1:]] + [f"{self.path}/delta/v={v}" for v in deltas]
        hadoop, fs = self._fs()
        # a batch without changes has no buckets
        filled = [p for p in paths if any(x.getPath().getName().startswith("bucket=") for x in fs.listStatus(hadoop.Path(p)))]
        # a given schema saves a job over the footers for each part
        reader = self.spark.read.schema(f"{self._schema()}, bucket int") if self.values else self.spark.read
        parts = [reader.parquet(p) for p in filled]
        return reduce(DataFrame.unionByName, parts) if parts else None

    def merge(self, changes: DataFrame, batch_id: int) -> None:
        """``changes``: keys, ``seq``, ``deleted`` and the value columns, any number of rows for a key."""
        self._write(self._last(changes), "delta", batch_id)
        bases = [v for v in self.files("base") if v < batch_id]
        if len([v for v in self.files("delta") if v > (bases[-1] if bases else -1)]) >= self.compact_after:
            self._compact(batch_id, bases)

    def _compact(self, batch_id: int, bases: list[int]) -> None:
        rows = self._rows(batch_id + 1)
        if rows is None:
            return
        # a repeated batch must still find the table as it was before: only what the base before this one replaced may go
        self._write(self._last(rows.drop("bucket")), "base", batch_id)
        hadoop, fs = self._fs()
        for kind in ("base", "delta") if bases else ():
            for v in self.files(kind):
                if v < bases[-1] or (kind == "delta" and v == bases[-1]):
                    fs.delete(hadoop.Path(f"{self.path}/{kind}/v={v}"), True)

    def read(self, before: int | None = None, only: DataFrame | None = None) -> DataFrame:
        """The table without tombstones, as it was before a batch if asked.

        ``only``: values of the first key column; just their buckets are read.
        """
        rows = self._rows(before)
        if rows is None:
            if not self.values:
                raise FileNotFoundError(f"nothing is written to {self.path}")
            names = ", ".join(f"{k} string" for k in self.keys)
            return self.spark.createDataFrame([], f"{names}, {self.values}, seq bigint")
        if only is not None:
            only = only.select(self.keys[0]).distinct()
            wanted = [x.bucket for x in only.select(self._bucket()).distinct().collect()]
            rows = rows.filter(F.col("bucket").isin(wanted)).join(only, self.keys[0], "left_semi")
        return self._last(rows.drop("bucket")).filter("not deleted").drop("deleted")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the session's checkpoint folder; under a temporary one only in local mode and where none is set, as in tests."""
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not re.match(r"local(\[[^,]*(,[^,]*)?\])?$", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="scratch-")
    return f"{root}/{name}-{uuid.uuid4().hex}"
