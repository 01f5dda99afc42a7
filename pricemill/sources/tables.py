"""Whole-table scans from the catalog, from a folder or over JDBC."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_jdbc(spark: SparkSession, table: str, options: Mapping[str, str]) -> DataFrame:
    """A database table. Address, user and driver come from the caller.

    Filters and columns of the query reach the database. For a large table pass
    ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` so that the scan
    is not one task.
    """
    return spark.read.format("jdbc").options(**dict(options), dbtable=table).load()
