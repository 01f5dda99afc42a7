"""Counts, averages, shares, ranges, facets and profiles.

Everything is an aggregate with map-side partial results, so a group that holds a third of the
rows reaches the shuffle as one partial row per task. Totals are scalar subqueries or a second,
smaller aggregate; no window runs over an unbounded group.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricemill.functions.dates import long_date_text
from pricemill.functions.numbers import missing, no_nan, round_half_even
from pricemill.operators.filters import equal_to


def _known(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are all known: groups are never formed on NULL or NaN."""
    types = dict(df.dtypes)
    for k in keys:
        df = df.filter(~missing(k, types[k]))
    return df


def group_count(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return _known(df, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def value_counts(
    df: DataFrame,
    column: str,
    where: Mapping[str, object] | None = None,
    share: bool = True,
    total: bool = False,
) -> DataFrame:
    """Rows per value, most frequent first, with the share of all rows counted."""
    counts = group_count(equal_to(df, where or {}), column)
    everything = counts.agg(F.sum("n").alias("total")).scalar()
    if share:
        counts = counts.withColumn("share", F.col("n").cast("double") / everything)
    if total:
        counts = counts.withColumn("total", everything)
    return counts.orderBy(F.desc("n"), column)


def _averages(df: DataFrame, measures: Mapping[str, str]) -> list[Column]:
    types = dict(df.dtypes)
    return [F.avg(no_nan(m, types[m])).alias(name) for m, name in measures.items()]


def average_by(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, str] | Sequence[str],
    count: str | None = None,
) -> DataFrame:
    """Mean of measures per group, missing values skipped."""
    names = dict(measures) if isinstance(measures, Mapping) else {m: m for m in measures}
    aggregates = _averages(df, names)
    if count:
        aggregates.append(F.count(F.lit(1)).alias(count))
    return _known(df, keys).groupBy(*keys).agg(*aggregates)


def segment_share(
    df: DataFrame, keys: Sequence[str], segment: Sequence[str], measure: str
) -> DataFrame:
    """Sum per key and its share of the segment the key belongs to.

    The segment totals come from the summed rows and are joined back. A segment may hold very
    many keys, so this is a join that AQE can split rather than a window per segment.
    """
    sums = _known(df, keys).groupBy(*keys).agg(F.sum(measure).alias(measure))
    totals = sums.groupBy(*segment).agg(F.sum(measure).alias("segment_total"))
    return sums.join(totals, on=list(segment)).withColumn(
        "share", F.col(measure) / F.col("segment_total")
    )


def headline(
    df: DataFrame,
    mean: Mapping[str, str] | None = None,
    highest: Mapping[str, str] | None = None,
    total: Mapping[str, str] | None = None,
    digits: int | None = 0,
) -> DataFrame:
    """One row of headline figures; means are rounded half to even unless ``digits`` is None."""
    types = dict(df.dtypes)

    def rounded(c: Column) -> Column:
        return c if digits is None else round_half_even(c, digits)

    figures = [
        rounded(F.avg(no_nan(m, types[m]))).alias(name) for m, name in (mean or {}).items()
    ]
    figures += [F.max(no_nan(m, types[m])).alias(name) for m, name in (highest or {}).items()]
    figures += [F.sum(no_nan(m, types[m])).alias(name) for m, name in (total or {}).items()]
    return df.agg(*figures)


def price_range(
    df: DataFrame, keys: Sequence[str], measure: str, day: str, labels: bool = True
) -> DataFrame:
    """Lowest and highest value with the first and last day, as dates or as text."""
    price = no_nan(measure, dict(df.dtypes)[measure])
    first, last = F.min(day), F.max(day)
    return df.groupBy(*keys).agg(
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        (long_date_text(first) if labels else first).alias("min_date"),
        (long_date_text(last) if labels else last).alias("max_date"),
    )


def at_extreme(
    df: DataFrame, keys: Sequence[str], measure: str, wanted: str, highest: bool = True
) -> DataFrame:
    """Value of another column at the row with the highest or lowest measure."""
    pick = F.max_by if highest else F.min_by
    return df.groupBy(*keys).agg(pick(wanted, measure).alias(wanted))


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def newest_first(df: DataFrame, day: str) -> DataFrame:
    """Distinct days, newest first."""
    return df.select(day).distinct().orderBy(F.desc(day))


def first_rows(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first n rows of a stated order; a top-k, not a full sort."""
    return df.orderBy(*order).limit(n)


def distinct_counts(
    df: DataFrame, columns: Sequence[str], null_is_value: bool = False, error: float | None = None
) -> DataFrame:
    """Distinct values per column in one row.

    ``null_is_value`` counts NULL as one more value. Each count is a scalar subquery over its own
    column: distinct values are combined in the map tasks, and no row is copied for each column.
    With ``error`` the counts are approximate, from one pass without a shuffle of the values.
    """
    if error is not None:

        def about(c: str) -> Column:
            n = F.approx_count_distinct(c, error)
            return n + F.max(F.col(c).isNull().cast("int")) if null_is_value else n

        return df.agg(*[about(c).alias(c) for c in columns])

    def exact(c: str) -> Column:
        values = df.select(c).distinct()
        return values.agg(F.count("*") if null_is_value else F.count(c)).scalar()

    return df.sparkSession.range(1).select(*[exact(c).alias(c) for c in columns])


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column in one row, one pass."""
    types = dict(df.dtypes)
    names = columns or df.columns
    return df.agg(*[F.count_if(missing(c, types[c])).alias(c) for c in names])


def table_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: its type, the row count and the number of known values."""
    types = dict(df.dtypes)
    names = list(columns or df.columns)
    wide = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(~missing(c, types[c])).alias(c) for c in names],
    )
    kinds = F.create_map(*[F.lit(x) for c in names for x in (c, types[c])])
    return wide.unpivot(["rows"], names, "column_name", "non_null").select(
        "column_name",
        F.element_at(kinds, F.col("column_name")).alias("dtype"),
        "rows",
        "non_null",
    )


def facet_options(
    df: DataFrame, levels: Sequence[str], chosen: Mapping[str, object]
) -> DataFrame:
    """Options of the next level of a filter cascade, given the choices made so far.

    ``levels`` is the order of the cascade, ``chosen`` the values picked on its first levels.
    """
    depth = len(chosen)
    if list(chosen) != list(levels[:depth]) or depth >= len(levels):
        raise ValueError("choices must follow the levels and leave one open")
    return equal_to(df, chosen).select(levels[depth]).distinct()
