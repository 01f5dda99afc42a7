"""Ordered logic: fill-forward, repeats, blocks, row numbers, header values.

A window gives each group to one task. That is fine for a report file, and wrong for a group
that holds a third of all rows. The operators here first cut such hot groups into *spans*:
consecutive pieces of the group's own order. A window then works inside (group, span), and the
little each span needs from the spans before it (a last value, a row count) is aggregated per
span and joined back.

How the cuts are found, all lazily and from the data alone:

1. Groups are counted. A group is hot when it has more rows than a span, and a span has
   ``rows_per_span`` rows or 1/50,000 of the frame, whichever is more. So hot groups and their
   spans number at most 100,000 between them, however large the frame is. This is the size
   bound behind the broadcasts below.
2. In hot groups the order values of a hash-picked share of the rows are counted and sorted, and
   one is a cut wherever the count passes a multiple of k. The pick depends on the rows' values
   only, so every reader of the cuts and every retry after a lost executor sees the same ones, and
   values that many rows share are picked as often as they occur.
3. A row's span is the number of cuts at or before it, by binary search over the first order
   column, which is a plain number or date. Only where more than a span's worth of rows shares
   one value of it are all order columns compared.

With no hot group AQE sees the empty broadcast and drops the extra branches; what stays is the
plain window.
"""

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricemill.functions import ColumnLike, as_column

ROWS_PER_SPAN = 2_000_000
MOST_SPANS = 50_000
MARKS_PER_SPAN = 16
# Steps of the binary search; together they reach past the most spans a group can have.
SEARCH_STEPS = tuple(2**n for n in range(16, -1, -1))

_EVERYTHING = "_everything"


def _keyed(df: DataFrame, group: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """A frame without group columns is one group."""
    if group:
        return df, list(group)
    return df.withColumn(_EVERYTHING, F.lit(0)), [_EVERYTHING]


def _same_group(
    rows: DataFrame, side: DataFrame, group: Sequence[str], how: str, *extra: str
) -> DataFrame:
    """Join a bounded side on the group columns, NULL equal to NULL, without its keys."""
    keys = [*group, *extra]
    renamed = side.withColumnsRenamed({k: f"_side_{k}" for k in keys})
    match = functools.reduce(
        operator.and_, [rows[k].eqNullSafe(renamed[f"_side_{k}"]) for k in keys]
    )
    return rows.join(F.broadcast(renamed), match, how).drop(*[f"_side_{k}" for k in keys])


def _mark(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def _cuts(
    df: DataFrame, group: Sequence[str], order: Sequence[str], rows_per_span: int
) -> DataFrame:
    """Group columns and the sorted cut values of each hot group."""
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows"))
    everything = sizes.agg(F.sum("_rows").alias("_all")).scalar()
    hot = (
        sizes.withColumn(
            "_span_rows",
            F.greatest(F.lit(rows_per_span), F.ceil(everything / MOST_SPANS)),
        )
        .filter(F.col("_rows") > F.col("_span_rows"))
        .withColumn("_every", F.ceil(F.col("_span_rows") / MARKS_PER_SPAN))
        .drop("_rows")
    )
    # Copies of a picked order value are counted before anything is collected; marks of all hot
    # groups together stay below MARKS_PER_SPAN for each of the bounded number of spans.
    hashed = [F.col(f.name) for f in df.schema.fields if f.dataType.typeName() != "map"]
    picked = _same_group(
        df.select(*group, _mark(order).alias("_mark"), F.xxhash64(*hashed).alias("_hash")),
        hot,
        group,
        "inner",
    ).filter(F.pmod("_hash", F.col("_every")) == 0)
    so_far = F.sum("_n").over(Window.partitionBy(*group).orderBy("_mark"))
    marks = (
        picked.groupBy(*group, "_mark")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.max(F.ceil(F.col("_span_rows") / F.col("_every"))).alias("_step"),
        )
        .withColumn("_to", so_far)
        .filter(F.floor(F.col("_to") / F.col("_step")) > F.floor((F.col("_to") - F.col("_n")) / F.col("_step")))
    )
    cuts = (
        marks.groupBy(*group)
        .agg(F.sort_array(F.collect_list("_mark")).alias("_full"))
        .withColumn("_firsts", F.transform("_full", lambda c: c[order[0]]))
    )
    tied = F.size(F.array_distinct("_firsts")) < F.size("_firsts")
    steps = F.array(*[F.lit(n) for n in SEARCH_STEPS])
    return cuts.select(
        *group,
        "_firsts",
        F.when(tied, F.col("_full")).alias("_full"),
        F.filter(steps, lambda n: n <= F.size("_firsts")).alias("_steps"),
    )


def _at_or_before(cuts: Column, value: Column) -> Column:
    """Number of sorted cuts at or before a value."""
    return F.aggregate(
        "_steps",
        F.lit(0),
        lambda at, step: F.when(F.get(cuts, at + step - 1) <= value, at + step).otherwise(at),
    )


def with_spans(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    rows_per_span: int = ROWS_PER_SPAN,
) -> DataFrame:
    """Add ``_span`` (0 in ordinary groups) and ``_hot``. ``order`` should tell all rows apart."""
    cut = _same_group(df, _cuts(df, group, order, rows_per_span), group, "left")
    span = (
        F.when(F.col("_steps").isNull(), 0)
        .when(F.col("_full").isNotNull(), _at_or_before(F.col("_full"), _mark(order)))
        .otherwise(_at_or_before(F.col("_firsts"), F.col(order[0])))
    )
    return cut.withColumns({"_hot": F.col("_steps").isNotNull(), "_span": span}).drop(
        "_firsts", "_full", "_steps"
    )


def _latest(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    include_row: bool,
    rows_per_span: int,
) -> DataFrame:
    """Latest non-NULL value up to the row (or before it) within its group."""
    df, keys = _keyed(df, group)
    cut = with_spans(df.withColumn("_value", value), keys, order, rows_per_span)
    inside = (
        Window.partitionBy(*keys, "_span")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0 if include_row else -1)
    )
    mark = F.when(F.col("_value").isNotNull(), _mark(order))
    earlier = Window.partitionBy(*keys).orderBy("_span")
    carried = (
        cut.filter("_hot")
        .groupBy(*keys, "_span")
        .agg(F.max_by("_value", mark).alias("_last"))
        .withColumn(
            "_carried",
            F.last("_last", ignorenulls=True).over(
                earlier.rowsBetween(Window.unboundedPreceding, -1)
            ),
        )
        .drop("_last")
    )
    local = cut.withColumn("_inside", F.last("_value", ignorenulls=True).over(inside))
    filled = _same_group(local, carried, keys, "left", "_span").withColumn(
        name, F.coalesce(F.col("_inside"), F.col("_carried"))
    )
    return filled.drop("_value", "_hot", "_span", "_inside", "_carried", _EVERYTHING)


def fill_forward(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    value: ColumnLike,
    name: str,
    rows_per_span: int = ROWS_PER_SPAN,
) -> DataFrame:
    """Add the latest non-NULL value at or above the row; NULL above the first one."""
    return _latest(df, group, order, as_column(value), name, True, rows_per_span)


def sections(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    is_header: Column,
    value: ColumnLike,
    name: str,
    rows_per_span: int = ROWS_PER_SPAN,
) -> DataFrame:
    """Give every row the value of the header row above it, then drop the header rows.

    Each header row opens a new section, also when it repeats an earlier one.
    """
    header = F.coalesce(is_header, F.lit(False))
    filled = fill_forward(
        df, group, order, F.when(header, as_column(value)), name, rows_per_span
    )
    return filled.filter(~header)


def drop_repeats(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    column: str,
    rows_per_span: int = ROWS_PER_SPAN,
) -> DataFrame:
    """Keep a row when its value differs from the row before it; the first row stays."""
    # Inside a struct a NULL value counts as a value, so the latest one is the row before.
    boxed = F.struct(F.col(column).alias("value"))
    before = _latest(df, group, order, boxed, "_before", False, rows_per_span)
    same = F.col("_before").isNotNull() & F.col("_before.value").eqNullSafe(F.col(column))
    return before.filter(~same).drop("_before")


def number_rows(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    name: str = "row_no",
    rows_per_span: int = ROWS_PER_SPAN,
) -> DataFrame:
    """Number rows from 1 in the stated order, per group or over the whole frame."""
    df, keys = _keyed(df, group)
    cut = with_spans(df, keys, order, rows_per_span)
    earlier = Window.partitionBy(*keys).orderBy("_span")
    offsets = (
        cut.filter("_hot")
        .groupBy(*keys, "_span")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(
            "_offset",
            F.sum("_n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)),
        )
        .drop("_n")
    )
    inside = Window.partitionBy(*keys, "_span").orderBy(*order)
    local = cut.withColumn("_inside", F.row_number().over(inside).cast("bigint"))
    return (
        _same_group(local, offsets, keys, "left", "_span")
        .withColumn(name, F.col("_inside") + F.coalesce(F.col("_offset"), F.lit(0)))
        .drop("_hot", "_span", "_inside", "_offset", _EVERYTHING)
    )


# Fixed value: up to this many rows per group Spark limits before the shuffle
# (the default of spark.sql.optimizer.windowGroupLimitThreshold).
LIMIT_BEFORE_SHUFFLE = 1000


def _leading(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    n: int,
    name: str,
    descending: bool = False,
) -> DataFrame:
    """First n rows of each group with their number; ``descending`` turns all named columns.

    A small limit is applied before the shuffle (WindowGroupLimit), so a hot group stays small.
    For a larger one over named columns hot groups are cut in spans; rows are then numbered in
    ascending order, and from the group's size for the descending one.
    """
    if n > LIMIT_BEFORE_SHUFFLE and all(isinstance(c, str) for c in order):
        numbered = number_rows(df, group, order, name)
        if descending:
            sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_size"))
            sizes = sizes.withColumnsRenamed({k: f"_side_{k}" for k in group})
            match = functools.reduce(
                operator.and_, [numbered[k].eqNullSafe(sizes[f"_side_{k}"]) for k in group]
            )
            numbered = (
                numbered.join(sizes, match)
                .withColumn(name, F.col("_size") + 1 - F.col(name))
                .drop("_size", *[f"_side_{k}" for k in group])
            )
    else:
        if descending:
            order = [F.desc(c) if isinstance(c, str) else c for c in order]
        row = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        numbered = df.withColumn(name, row)
    return numbered.filter(F.col(name) <= n)


def label_blocks(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    labels: Sequence[str],
    size: int,
    name: str,
) -> DataFrame:
    """Consecutive blocks of ``size`` rows get the labels in turn; rows past the last block go."""
    numbered = _leading(df, group, order, size * len(labels), "_row")
    block = F.floor((F.col("_row") - 1) / size).cast("int")
    return numbered.withColumn(name, F.get(F.array(*[F.lit(x) for x in labels]), block)).drop(
        "_row"
    )


def top_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    n: int = 1,
    descending: bool = False,
) -> DataFrame:
    """First n rows of each group in the stated order, or the last with ``descending``."""
    return _leading(df, group, order, n, "_row", descending).drop("_row")


def spread_first(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    values: Sequence[tuple[ColumnLike, str]],
) -> DataFrame:
    """Give every row of a group the values found on the group's first row.

    One aggregate with map-side partial results finds them; they are joined back, where AQE
    splits a hot group's partition.
    """
    boxed = F.struct(*[as_column(value).alias(name) for value, name in values])
    firsts = df.groupBy(*group).agg(F.min_by(boxed, _mark(order)).alias("_first"))
    renamed = firsts.withColumnsRenamed({k: f"_side_{k}" for k in group})
    match = functools.reduce(
        operator.and_, [df[k].eqNullSafe(renamed[f"_side_{k}"]) for k in group]
    )
    return (
        df.join(renamed, match, "left")
        .withColumns({name: F.col(f"_first.{name}") for _, name in values})
        .drop("_first", *[f"_side_{k}" for k in group])
    )
