"""Writing star-schema tables: clustered facts, refreshed months, and the warehouse load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.fixed_values import GOLD_TABLES
from tallyhouse.operators.contract import prepare
from tallyhouse.sources.storage import observed_write

# The columns facts are clustered by, and the one they are dated by.
CLUSTERING = {
    "fact_transaction": ("date_key", "merchant_key"),
    "fact_refund": ("refund_date_key", "merchant_key"),
    "fact_chargeback": ("chargeback_date_key", "merchant_key"),
}
MONTH = "year_month"


def month_of(day_key: Column | str) -> Column:
    return F.floor((F.col(day_key) if isinstance(day_key, str) else day_key) / 100).cast("int")


def clustered(df: DataFrame, table: str) -> DataFrame:
    """Rows ranged and sorted by month, day and merchant.

    The surrogate key closes the range, so a merchant with very many rows on one day
    is cut over several tasks and files.
    """
    day_key, merchant_key = CLUSTERING[table]
    order = [MONTH, day_key, merchant_key, GOLD_TABLES[table][0].name]
    return df.withColumn(MONTH, month_of(day_key)).repartitionByRange(*order).sortWithinPartitions(*order)


def write_dimension(df: DataFrame, path: str) -> int:
    return observed_write(df, lambda rows: rows.write.mode("overwrite").parquet(path))["rows"]


def write_fact(df: DataFrame, table: str, path: str, only_months_present: bool = False) -> int:
    """Write a fact partitioned by month; returns its rows.

    With `only_months_present`, months that do not occur in `df` stay as they are.
    """
    kept = "dynamic" if only_months_present else "static"

    def write(rows: DataFrame) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", kept).partitionBy(MONTH).parquet(path)

    return observed_write(clustered(df, table), write)["rows"]


def publish(df: DataFrame, table: str, database: str, table_format: str = "parquet") -> int:
    """Load one table into a catalog database in the contract's shape; returns its rows.

    A table goes to a staging table first and replaces the target from there, so a
    failure while it is computed leaves the published table untouched. The first
    publish renames the staging table. Amounts are decimals with the contract's digits.
    """
    spark: SparkSession = df.sparkSession
    target = f"{database}.{table}"
    stage = f"{database}._{table}_load"
    shaped = prepare(df, table, decimal_money=True)

    def write(rows: DataFrame) -> None:
        rows.write.mode("overwrite").format(table_format).saveAsTable(stage)

    try:
        rows = observed_write(shaped, write)["rows"]
        if spark.catalog.tableExists(target):
            names = ", ".join(shaped.columns)
            spark.sql(f"INSERT OVERWRITE TABLE {target} ({names}) SELECT {names} FROM {stage}")
        else:
            spark.sql(f"ALTER TABLE {stage} RENAME TO {target}")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {stage}")
    return rows


def publish_external(df: DataFrame, table: str, connector: str, options: dict[str, str]) -> int:
    """Load one table through a warehouse connector, replacing what is there; returns its rows."""
    shaped = prepare(df, table, decimal_money=True)
    with_target = {"dbtable": table.upper(), **options}

    def write(rows: DataFrame) -> None:
        rows.write.mode("overwrite").format(connector).options(**with_target).save()

    return observed_write(shaped, write)["rows"]
