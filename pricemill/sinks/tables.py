"""Snapshots and typed tables."""

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricemill.schemas import PriceTable

YEAR = "year"


def write_snapshot(df: DataFrame, folder: str, as_of: date | str) -> str:
    """Dated CSV snapshot with header; writing the same date again replaces it."""
    path = f"{folder.rstrip('/')}/snapshot_date={as_of}"
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def by_year(df: DataFrame, day: str) -> DataFrame:
    """Rows grouped by year for a partitioned write, and by day in each file.

    The rebalance hint lets AQE split a year that is too large for one task and merge small
    ones, so that a write makes neither one huge file nor a file per task and year. Row groups of
    a file follow each other in date, so that reads by date skip those outside.
    """
    grouped = df.withColumn(YEAR, F.year(day)).hint("rebalance", YEAR)
    return grouped.sortWithinPartitions(YEAR, day)


def write_table(df: DataFrame, path: str, day: str, mode: str = "append") -> None:
    """Append to, or overwrite, a Parquet table partitioned by year."""
    writer = by_year(df, day).write.mode(mode).option("partitionOverwriteMode", "static")
    writer.partitionBy(YEAR).parquet(path)


def create_table(spark: SparkSession, table: PriceTable, location: str | None = None) -> None:
    """Create a price table in the catalog if it is missing.

    Spark keeps no key and length rules for it: ``operators.quality`` checks those on load.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.stored)
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table.name} ({columns}, {YEAR} int) "
        f"USING parquet PARTITIONED BY ({YEAR}){place}"
    )


def load_table(df: DataFrame, table: PriceTable, mode: str = "append") -> None:
    """Append to, or overwrite, a price table of the catalog. The name comes with the schema, so
    a family cannot land in the table of another. A frame without the flag column gives NULLs."""
    columns = table.stored.fieldNames()
    given = {f.name: F.col(f.name) if f.name in df.columns else F.lit(None) for f in table.stored}
    typed = df.select(*[given[f.name].cast(f.dataType).alias(f.name) for f in table.stored])
    rows = by_year(typed, table.date).select(*columns, YEAR)
    rows.write.insertInto(table.name, overwrite=mode == "overwrite")


def write_jdbc(
    df: DataFrame, table: str, options: Mapping[str, str], mode: str = "append"
) -> None:
    """Append to, or overwrite, a database table; address and user come from the caller.

    Overwrite empties the table and keeps its definition.
    """
    writer = df.write.format("jdbc").options(**dict(options), dbtable=table)
    if mode == "overwrite":
        writer = writer.option("truncate", True)
    writer.mode(mode).save()


def stage(df: DataFrame, folder: str, family: str, run: str) -> str:
    """Staged rows of one run of a family. A repeated run replaces its own rows only."""
    path = f"{folder.rstrip('/')}/family={family}/run={run}"
    df.write.mode("overwrite").parquet(path)
    return path
