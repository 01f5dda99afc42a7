"""Row filters: equality chains, sets, zeros, time windows, NULL rules."""

import functools
import operator
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricemill.functions.dates import as_of_date, days_before
from pricemill.functions.numbers import missing
from pricemill.functions.text import contains_text

PERIODS = ("1m", "6m", "ytd", "1y", "all")


def equal_to(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Keep rows equal to every given value; a chain of any depth is one filter."""
    if not values:
        return df
    return df.filter(
        functools.reduce(operator.and_, [F.col(c) == F.lit(v) for c, v in values.items()])
    )


def one_of(df: DataFrame, column: str, *values: object) -> DataFrame:
    """Keep rows of the given classes (two of them for a pairwise comparison)."""
    return df.filter(F.col(column).isin(*values))


def not_zero_keep_null(df: DataFrame, column: str) -> DataFrame:
    """Zeros go, NULL stays."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(0)))


def not_zero(df: DataFrame, column: str) -> DataFrame:
    """Zeros and NULL go."""
    return df.filter(F.col(column) != 0)


def _years_from(df: DataFrame, first: Column, year: str | None) -> DataFrame:
    """Only the partitions that can hold dates from ``first`` on, by the partition column."""
    return df if year is None else df.filter(F.col(year) >= F.year(first))


def trailing(
    df: DataFrame, column: str, as_of: date | str, days: int = 365, year: str | None = None
) -> DataFrame:
    """Rows strictly later than ``days`` before ``as_of``.

    ``year`` names the partition column with the year of ``column``, if the table has one: earlier
    folders are not read then.
    """
    first = days_before(as_of, days)
    return _years_from(df, first, year).filter(F.col(column) > first)


def since(
    df: DataFrame, column: str, as_of: date | str, days: int, year: str | None = None
) -> DataFrame:
    """Load window: rows from ``days`` before ``as_of`` on (7 weekly, 90 backfill)."""
    first = days_before(as_of, days)
    return _years_from(df, first, year).filter(F.col(column) >= first)


def still_open(df: DataFrame, column: str, as_of: date | str) -> DataFrame:
    """Contracts that settle strictly after ``as_of``."""
    return df.filter(F.col(column) > as_of_date(as_of))


def year_back_for(
    df: DataFrame, column: str, as_of: date | str, values: Mapping[str, object]
) -> DataFrame:
    """A year back and equal to the given values, as for one upload date.

    Equality comes first: it is cheap and selective, while the date may be a parsed one.
    """
    return trailing(equal_to(df, values), column, as_of, 365)


def containing(df: DataFrame, column: str, part: str) -> DataFrame:
    return df.filter(contains_text(column, part))


def without(df: DataFrame, mask: Column) -> DataFrame:
    """Rows for which the mask is not true (header rows go, NULL masks stay)."""
    return df.filter(~F.coalesce(mask, F.lit(False)))


def _null_count(df: DataFrame, columns: Sequence[str] | None) -> Column:
    types = dict(df.dtypes)
    parts = [missing(c, types[c]).cast("int") for c in (columns or df.columns)]
    return functools.reduce(operator.add, parts)


def complete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL or NaN in any (or any of the named) columns."""
    return df.dropna(how="any", subset=list(columns) if columns else None)


def not_blank(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows that are NULL in all of the data columns; file columns do not count."""
    return df.dropna(how="all", subset=list(columns))


def max_nulls(df: DataFrame, limit: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with more than ``limit`` NULLs."""
    return df.filter(_null_count(df, columns) <= limit)


def null_count_not(df: DataFrame, count: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with exactly ``count`` NULLs."""
    return df.filter(_null_count(df, columns) != count)


def period_start(last: Column, period: str) -> Column:
    """First day of a preset that ends at ``last``."""
    if period == "1m":
        return F.add_months(last, -1)
    if period == "6m":
        return F.add_months(last, -6)
    if period == "1y":
        return F.add_months(last, -12)
    if period == "ytd":
        return F.trunc(last, "year")
    raise ValueError(f"period must be one of {PERIODS}, not {period!r}")


def period(df: DataFrame, column: str, preset: str, year: str | None = None) -> DataFrame:
    """Range preset counted back from the newest date of the frame.

    The newest date is a scalar subquery: one value, found by a map-side aggregate, and pushed
    into the scan as a filter.
    """
    if preset == "all":
        return df
    newest = df.agg(F.max(column).cast("date").alias("newest")).scalar()
    first = period_start(newest, preset)
    return _years_from(df, first, year).filter(F.col(column) >= first)


def between_positions(df: DataFrame, position: str, first: int, last: int) -> DataFrame:
    """Lines of a report by position, both ends included."""
    return df.filter(F.col(position).between(first, last))


def price_policy(
    df: DataFrame, policy: str, price: str = "average_price", fallback: str = "closing_price"
) -> DataFrame:
    """The three rules for a missing average price.

    ``coalesce`` takes the closing price, ``drop`` drops the row, ``nonzero`` drops zeros too.
    """
    if policy == "coalesce":
        return df.withColumn(price, F.coalesce(F.col(price), F.col(fallback)))
    if policy == "drop":
        return complete(df, [price])
    if policy == "nonzero":
        return not_zero(df, price)
    raise ValueError("policy must be coalesce, drop or nonzero")
