"""Names, positions, constants, casts and the long form of a table."""

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemill.functions.dates import parse_date
from pricemill.functions.numbers import plain_number, thousands_number
from pricemill.functions.text import snake_name, strip


def snake_names(df: DataFrame) -> DataFrame:
    """All column names to lower snake case, in one projection."""
    return df.toDF(*[snake_name(c) for c in df.columns])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def duplicate(df: DataFrame, column: str, copy: str) -> DataFrame:
    return df.withColumn(copy, F.col(column))


def drop_junk(df: DataFrame, *columns: str) -> DataFrame:
    """Drop columns that may or may not be there."""
    return df.drop(*columns)


def positional(words: str, names: Sequence[str]) -> list[Column]:
    """Columns 0..n-1 of a token array under the given names; short lines give NULL."""
    return [F.get(F.col(words), i).alias(name) for i, name in enumerate(names)]


def constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def series(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, str] | Sequence[str],
    series_column: str = "series",
    value_column: str = "value",
) -> DataFrame:
    """Several measures as named series on one axis: one row per key and measure.

    ``measures`` maps a measure to its label, or lists measures that keep their name. All of
    them become double.
    """
    labels = dict(measures) if isinstance(measures, Mapping) else {m: m for m in measures}
    wide = df.select(
        *keys, *[F.col(m).cast("double").alias(label) for m, label in labels.items()]
    )
    return wide.unpivot(list(keys), list(labels.values()), series_column, value_column)


def trim_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Strip blanks in the named columns, or in every string column."""
    names = columns or [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: strip(c) for c in names}) if names else df


def text_to_double(df: DataFrame, between: tuple[str, str] | None = None) -> DataFrame:
    """Every string column, or those from one column to another, to double without commas."""
    names = df.columns
    if between is not None:
        names = names[names.index(between[0]) : names.index(between[1]) + 1]
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    picked = {c: thousands_number(c) for c in names if c in text}
    return df.withColumns(picked) if picked else df


#: So many text columns of one parsing function are parsed together.
SHARED = 3


def conform(
    df: DataFrame,
    schema: T.StructType,
    parse: Mapping[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """Typed columns of ``schema`` in order, from text columns, in one projection.

    A column listed in ``parse`` goes through that function; other numbers through
    ``plain_number`` and other dates through ``parse_date``, so nothing raises on bad text. A
    column the frame lacks becomes NULL.

    Text columns that share a function go through it as one array. Written out for each of them, the
    stage's generated code would pass the 8000 bytes beyond which the JVM only interprets it.
    """
    parse = parse or {}
    types = dict(df.dtypes)
    alike: dict[Callable[[Column], Column], list[str]] = {}
    for f in schema.fields:
        if f.name in parse and types.get(f.name) == "string":
            alike.setdefault(parse[f.name], []).append(f.name)
    shared, arrays = {}, {}
    for n, (function, names) in enumerate(alike.items()):
        if len(names) >= SHARED:
            arrays[f"_shared_{n}"] = F.transform(F.array(*names), function)
            shared |= {name: F.get(F.col(f"_shared_{n}"), i) for i, name in enumerate(names)}
    if arrays:
        df = df.withColumns(arrays)
    out = []
    for f in schema.fields:
        kind = f.dataType.simpleString()
        if f.name not in types:
            value = F.lit(None)
        elif f.name in shared:
            value = shared[f.name]
        elif f.name in parse:
            value = parse[f.name](F.col(f.name))
        elif types[f.name] != "string":
            value = F.col(f.name).try_cast(f.dataType)
        elif isinstance(f.dataType, T.NumericType):
            value = plain_number(f.name, kind)
        elif isinstance(f.dataType, T.DateType):
            value = parse_date(f.name)
        else:
            value = F.col(f.name)
        out.append(value.cast(f.dataType).alias(f.name))
    return df.select(*out)


def computed_once(df: DataFrame) -> DataFrame:
    """The same rows, with their columns computed before any filter that follows.

    A filter on computed columns is otherwise pushed below them, where it computes them a second
    time. Columns that nobody asks for are computed too, so this is for filters on most of them.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union with columns matched by name; a missing column is NULL, duplicates stay."""
    out = first
    for other in others:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def attach(
    rows: DataFrame, attributes: DataFrame, key: str | Sequence[str], how: str = "left"
) -> DataFrame:
    """Attributes of a market (or file, or class) by key.

    No broadcast hint: Spark broadcasts ``attributes`` when its known or measured size is under
    ``spark.sql.autoBroadcastJoinThreshold``, and beyond that runs a sort-merge join whose
    skewed partitions AQE splits.
    """
    return rows.join(attributes, on=key, how=how)


def coalesce_measure(df: DataFrame, measure: str, fallback: str) -> DataFrame:
    """A NULL measure takes the value of another column."""
    return df.withColumn(measure, F.coalesce(F.col(measure), F.col(fallback)))


def fill_zero(
    df: DataFrame, columns: Sequence[str] | None = None, flag: str | None = "was_null"
) -> DataFrame:
    """NULL and NaN to 0 in numeric columns; ``flag`` marks rows that had one.

    Without the flag a false zero cannot be told from a reported one.
    """
    types = dict(df.dtypes)
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    names = [c for c in (columns or numeric) if c in numeric]
    if flag is not None:
        empty = F.lit(False)
        for c in names:
            hole = F.col(c).isNull()
            empty = empty | (hole | F.isnan(c) if types[c] in ("float", "double") else hole)
        df = df.withColumn(flag, empty)
    return df.fillna(0, subset=names) if names else df
