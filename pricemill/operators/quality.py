"""Checks: NULL, keys, lengths, rows lost per rule, rows per file."""

import functools
import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pricemill.functions.numbers import missing
from pricemill.operators.ordered import top_per_group
from pricemill.schemas import PriceTable


def check_counts(
    df: DataFrame, required: Sequence[str] = (), max_length: Mapping[str, int] | None = None
) -> DataFrame:
    """Breaches of NOT NULL and of text lengths, counted in one pass: one row."""
    types = dict(df.dtypes)
    found = [F.count_if(missing(c, types[c])).alias(f"null_{c}") for c in required]
    found += [
        F.count_if(F.length(c) > limit).alias(f"long_{c}")
        for c, limit in (max_length or {}).items()
    ]
    return df.agg(*found)


def _breach(
    df: DataFrame, required: Sequence[str], max_length: Mapping[str, int] | None
) -> Column:
    types = dict(df.dtypes)
    tests = [missing(c, types[c]) for c in required]
    tests += [F.length(c) > limit for c, limit in (max_length or {}).items()]
    return F.coalesce(functools.reduce(operator.or_, tests, F.lit(False)), F.lit(False))


def quarantine(
    df: DataFrame, required: Sequence[str], max_length: Mapping[str, int] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows that pass, and rows that do not."""
    bad = _breach(df, required, max_length)
    return df.filter(~bad), df.filter(bad)


def key_conflicts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the number of their rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def keep_winner(
    df: DataFrame, keys: Sequence[str], winner: Sequence[str | Column]
) -> DataFrame:
    """One row per key: the first in the stated order. Report ``key_conflicts`` before."""
    return top_per_group(df, keys, winner, 1)


def rule_losses(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows each cleaning rule would drop, and rows in all, in one pass.

    A rule is the condition a row must meet to stay; NULL counts as not met.
    """
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.count_if(~F.coalesce(keep, F.lit(False))).alias(name)
            for name, keep in rules.items()
        ],
    )


def observe_losses(
    df: DataFrame, rules: Mapping[str, Column], name: str = "losses"
) -> tuple[DataFrame, Observation]:
    """The same counts as a by-product of the job that writes ``df``: no extra pass."""
    seen = Observation(name)
    lost = [
        F.count_if(~F.coalesce(keep, F.lit(False))).alias(rule) for rule, keep in rules.items()
    ]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *lost), seen


def rows_per_file(df: DataFrame, file: str = "file_path") -> DataFrame:
    """Rows per input file, when the frame carries its file column."""
    return df.groupBy(file).agg(F.count(F.lit(1)).alias("rows"))


def table_checks(df: DataFrame, table: PriceTable) -> DataFrame:
    """NOT NULL and length checks of a price table."""
    return check_counts(df, table.required, table.max_length)
