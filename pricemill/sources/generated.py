"""Generated integers."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def random_integers(
    spark: SparkSession, length: int, lowest: int = 0, highest: int = 100, seed: int | None = None
) -> DataFrame:
    """``length`` integers between ``lowest`` and ``highest``, both included."""
    spread = highest - lowest + 1
    value = F.floor(F.rand(seed) * spread + lowest).cast("int")
    return spark.range(length).select(value.alias("value"))
