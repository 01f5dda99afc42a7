"""Profiles that can be put together: one for each load, and the table's from theirs."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemill.functions.numbers import missing

#: The distinct counts' sketches have 2^this registers: an error of 1.6 % (one standard deviation).
REGISTERS = 12
#: Types that a sketch takes as they are; others go in as text.
SKETCHED = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: ``rows``, and for each column its known values, the least and the largest, and a
    sketch of the distinct ones. One pass; a few kilobytes however many rows there are."""
    types = dict(df.dtypes)
    kinds = {f.name: f.dataType for f in df.schema}

    def part(c: str) -> Column:
        known = F.when(~missing(c, types[c]), F.col(c))
        value = known if isinstance(kinds[c], SKETCHED) else known.cast("string")
        return F.struct(
            F.count(known).alias("non_null"),
            F.min(known).alias("low"),
            F.max(known).alias("high"),
            F.hll_sketch_agg(value, REGISTERS).alias("sketch"),
        ).alias(c)

    names = columns or df.columns
    return df.agg(F.count(F.lit(1)).alias("rows"), *[part(c) for c in names])


def merged(profiles: DataFrame) -> DataFrame:
    """The profile of all rows that these profiles, one a row, are of: no row is read again.

    Counts, least and largest values are exact. A column that some profiles lack is missing in theirs.
    """

    def part(c: str) -> Column:
        return F.struct(
            F.coalesce(F.sum(f"{c}.non_null"), F.lit(0)).alias("non_null"),
            F.min(f"{c}.low").alias("low"),
            F.max(f"{c}.high").alias("high"),
            F.hll_union_agg(f"{c}.sketch").alias("sketch"),
        ).alias(c)

    names = [f.name for f in profiles.schema if isinstance(f.dataType, T.StructType)]
    rows = F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
    return profiles.agg(rows, *[part(c) for c in names])


def as_table(profile: DataFrame) -> DataFrame:
    """One row per column: column_name, dtype, rows, non_null, low and high as text, and about how many
    distinct values."""
    kinds = {
        f.name: f.dataType["low"].dataType.simpleString()
        for f in profile.schema
        if isinstance(f.dataType, T.StructType)
    }
    listed = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(kind).alias("dtype"),
                F.col("rows"),
                F.col(f"{c}.non_null").alias("non_null"),
                F.col(f"{c}.low").cast("string").alias("low"),
                F.col(f"{c}.high").cast("string").alias("high"),
                F.coalesce(F.hll_sketch_estimate(f"{c}.sketch"), F.lit(0)).alias("about_distinct"),
            )
            for c, kind in kinds.items()
        ]
    )
    return profile.select(F.inline(listed))
