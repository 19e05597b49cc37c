"""Stored tables cut into buckets by the hash of a key, of which single buckets can be replaced."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tallyhouse.sources.bronze import known_schemas, remember_schema

BUCKET = "key_bucket"


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def among(column: str, values: Iterable) -> Column:
    """Whether the column has one of the values, null being one like any other; prunes partitions."""
    given = set(values)
    found = F.col(column).isin(*(value for value in given if value is not None))
    return found | F.col(column).isNull() if None in given else found


def replace_partitions(content: DataFrame, path: str, column: str, touched: Iterable) -> None:
    """Replace the touched partitions by `content`; all others stay as they are, file by file.

    Large partitions become several files, small ones one. `content` must not be read from `path`. Touched partitions that it has no rows for
    are removed once the others are in place.
    """
    spark = content.sparkSession
    dealt = content.hint("rebalance", column)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    kept = {row[column] for row in content.select(column).distinct().collect()}  # at most the touched ones
    for value in set(touched) - kept:
        name = "__HIVE_DEFAULT_PARTITION__" if value is None else value
        remove_folder(spark, f"{path}/{column}={name}")


class BucketedTable:
    """Rows in `buckets` folders by the hash of `key`; its rows must have one.

    Columns may be added over time. A column keeps the type it was first stored with, and
    what does not fit that type later is null. The number of buckets is fixed once stored.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, key: str, buckets: int):
        self.spark = spark
        self.path = f"{root}/{name}"
        self.key = key
        self.buckets = buckets
        self._schemas = f"{root}/_schemas/{name}"

    def _bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(self.buckets)).cast("int")

    def schema(self) -> StructType | None:
        """Each schema stored extends the one before, so the widest is the latest."""
        return max(known_schemas(self.spark, self._schemas).values(), key=len, default=None)

    def conformed(self, df: DataFrame) -> DataFrame:
        """`df` with the stored types, missing columns as nulls, and its new columns behind."""
        stored = self.schema()
        if stored is None:
            return df
        present = dict(df.dtypes)
        columns = []
        for field in stored:
            kind = field.dataType.simpleString()
            value = F.col(field.name) if field.name in present else F.lit(None)
            columns.append((value if present.get(field.name) == kind else value.try_cast(field.dataType)).alias(field.name))
        return df.select(*columns, *(name for name in df.columns if name not in stored.names))

    def touched(self, keys: DataFrame) -> list[int]:
        """Buckets of the keys in the column named like the table's key."""
        return sorted(row[0] for row in keys.select(self._bucket(self.key)).distinct().collect())

    def read(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets; other buckets are not looked at."""
        rows = self.spark.read.schema(StructType([*self.schema(), StructField(BUCKET, IntegerType())])).parquet(self.path)
        return (rows if buckets is None else rows.where(F.col(BUCKET).isin(*buckets))).drop(BUCKET)

    def replace(self, content: DataFrame, buckets: Iterable[int] | None = None) -> None:
        """Write some buckets anew, or the whole table. Large buckets become several files, small ones one."""
        content = self.conformed(content)
        remember_schema(self.spark, self._schemas, content.schema)
        dealt = content.withColumn(BUCKET, self._bucket(self.key))
        if buckets is None:
            dealt.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(self.path)
        else:
            replace_partitions(dealt, self.path, BUCKET, buckets)
