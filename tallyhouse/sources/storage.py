"""Stored tables: write once, count while writing, read back.

Reading a written table back cuts lineage in storage every executor can reach, so
a lost executor costs a re-read and never a recomputation of the plan above it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Stored(NamedTuple):
    """A table read back from storage and what was measured while it was written."""

    df: DataFrame
    rows: int
    path: str


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names, a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="tallyhouse-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def if_present(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The table `read` opens, or nothing when its folder does not exist yet."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def observed_write(df: DataFrame, write: Callable[[DataFrame], None], **metrics: Column) -> dict:
    """Run `write(df)` and return `rows` plus the given aggregates, measured in the same pass.

    The measuring step sits directly under the writer, with no shuffle in between,
    so a retried task is counted once.
    """
    seen = Observation()
    columns = [F.count(F.lit(1)).alias("rows")] + [value.alias(name) for name, value in metrics.items()]
    write(df.observe(seen, *columns))
    return dict(seen.get)


class TableStore:
    """Parquet tables under one root folder; without a root, under a new folder of the shared one."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.temporary = root is None
        self.root = (root or f"{shared_folder(spark)}/tallyhouse-{uuid.uuid4().hex}").rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> Stored:
        path = self.path(name)

        def write(rows: DataFrame) -> None:
            writer = rows.write.mode(mode).option("compression", "zstd")
            (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)

        rows = observed_write(df, write)["rows"]
        return Stored(self.spark.read.schema(df.schema).parquet(path), rows, path)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def drop(self) -> None:
        """Delete a temporary store once nothing reads from it any more."""
        if not self.temporary:
            raise ValueError(f"{self.root} was given from outside and is not dropped")
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
