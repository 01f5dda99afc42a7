"""A table of loaded keys, bucketed so that a load's keys come to it and it stays where it is."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A digest of each key, by which the table is bucketed. NULL is a value like others in it, which a join
#: by the key's own columns can only tell by shuffling both sides.
KEY = "_key"
BUCKETS = 64


def key_digest(keys: Sequence[str]) -> Column:
    return F.unhex(F.sha2(F.to_json(F.struct(*keys)), 256))


def write_keys(
    rows: DataFrame,
    name: str,
    keys: Sequence[str],
    buckets: int = BUCKETS,
    mode: str = "append",
    location: str | None = None,
) -> None:
    """Add the keys of these rows to the catalog table ``name``, or make it anew: a file a bucket."""
    dealt = rows.select(key_digest(keys).alias(KEY)).repartition(buckets, KEY)
    writer = dealt.write.format("parquet").bucketBy(buckets, KEY).sortBy(KEY).mode(mode)
    if location and not rows.sparkSession.catalog.tableExists(name):
        writer = writer.option("path", location)
    writer.saveAsTable(name)


def without_known(rows: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys the table lacks. Only these rows are shuffled, to the table's buckets."""
    known = rows.sparkSession.table(name)
    return rows.withColumn(KEY, key_digest(keys)).join(known, KEY, "left_anti").drop(KEY)


def in_step(spark: SparkSession, name: str, target: DataFrame | None) -> bool:
    """Whether the table has as many keys as the target has rows: a load may have failed between the
    two. Counts come from the files' footers."""
    if not spark.catalog.tableExists(name):
        return target is None
    return spark.table(name).count() == (0 if target is None else target.count())
