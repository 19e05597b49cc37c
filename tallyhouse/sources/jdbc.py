"""Reading a source table over JDBC in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FETCH_ROWS = 10_000


def jdbc_options(
    url: str,
    table: str,
    properties: dict[str, str],
    split_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    splits: int = 1,
) -> dict[str, str]:
    """Reader options; with a split column the scan runs as `splits` range queries.

    Filters put on the resulting DataFrame (such as the incremental slice) are
    pushed into the source by Spark, so no SQL text is assembled here.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(FETCH_ROWS), **properties}
    if split_column is None:
        return options
    if bounds is None or splits < 1:
        raise ValueError("a split column needs its lower and upper bound and at least one split")
    return {
        **options,
        "partitionColumn": split_column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(splits),
    }


def bounds_query(table: str, split_column: str) -> str:
    """One aggregate for the source to answer: the smallest and largest value to split by."""
    return f"SELECT MIN({split_column}) AS low, MAX({split_column}) AS high FROM {table}"


def read_jdbc_in_splits(
    spark: SparkSession, url: str, table: str, properties: dict[str, str], split_column: str, splits: int
) -> DataFrame:
    """Scan a table as `splits` range queries, with bounds asked of the source; an empty table is one query."""
    asked = {"url": url, "query": bounds_query(table, split_column), **properties}
    found = spark.read.format("jdbc").options(**asked).load().toDF("low", "high").first()
    if found is None or found["low"] is None:
        return read_jdbc(spark, url, table, properties)
    return read_jdbc(
        spark, url, table, properties, split_column=split_column, bounds=(found["low"], found["high"]), splits=splits
    )


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str], **split) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, properties, **split)).load()
