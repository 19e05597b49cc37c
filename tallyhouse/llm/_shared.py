"""What the operators share: staged tables in the shared folder, bounded Arrow batches, word splitting."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tallyhouse.sources.storage import shared_folder

#: Bytes of text a worker looks at in one go; a single longer document is a batch of its own.
BATCH_BYTES = 4 << 20


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, wherever the cluster starts them."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="tallyhouse-package-"), "tallyhouse_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder path under the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str) -> tuple:
    """A Hadoop path and its file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


_STAGED: list[tuple[str, str]] = []


def drop_staged(spark: SparkSession) -> None:
    """Delete the staged tables of this application; for when its results have been read or written.

    Those that nobody drops go when the application ends.
    """
    mine = [entry for entry in _STAGED if entry[0] == spark.sparkContext.applicationId]
    for entry in mine:
        folder, system = _folder(spark, entry[1])
        system.delete(folder, True)
        _STAGED.remove(entry)


#: While a table is written: Spark removes the shuffle files of the query when it has ended, and
#: Arrow batches for Python workers are cut by bytes, not only by rows; both sides hold them whole.
_WHILE_STAGED = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
}


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back, which cuts its lineage.

    The shuffle files of the write are of no use afterwards and are removed at once, so a
    chain of stages never holds more than one stage's shuffles on disk.
    """
    spark = df.sparkSession
    path, before = scratch(spark, name), {key: spark.conf.get(key, None) for key in _WHILE_STAGED}
    try:
        for key, value in _WHILE_STAGED.items():
            spark.conf.set(key, value)
        df.write.mode("overwrite").parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    folder, system = _folder(spark, path)
    system.deleteOnExit(folder)
    _STAGED.append((spark.sparkContext.applicationId, path))
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def give_back() -> None:
    """Return freed memory to the system: Python workers live on between tasks, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def slices(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = BATCH_BYTES, rows: int = 1 << 20
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that `column` holds about `limit` bytes in each, in at most `rows` rows."""
    give_back()
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for at, size in enumerate(sizes):
            if (total + size > limit or at - start == rows) and at > start:
                yield batch.slice(start, at - start)
                give_back()
                start, total = at, 0
            total += size
        yield batch.slice(start)
        give_back()
