"""Report texts: lines, tokens and sections by line number."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricemill.functions.text import tokens
from pricemill.sources.files import text_lines


def report_lines(
    texts: DataFrame,
    text: str = "text",
    keep: Sequence[str] = ("file_path",),
    header: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per line: ``keep``, 0-based ``pos``, ``line`` and its ``words``.

    ``header`` maps a column to an expression over ``head``, the tokens of line 0. Such values
    are set while the report is still one record, so they reach all its rows without a join or
    a window.
    """
    whole = texts.select(*keep, text_lines(F.col(text)).alias("_lines")).withColumn(
        "head", tokens(F.get("_lines", 0))
    )
    spread = [value.alias(name) for name, value in (header or {}).items()]
    # The outer form: for the plain one Spark adds a not-empty filter that splits the text again.
    lines = whole.select(*keep, *spread, F.posexplode_outer("_lines").alias("pos", "line"))
    lines = lines.filter(F.col("pos").isNotNull())
    return lines.withColumn("words", tokens("line"))


def line_section(position: str, bounds: Mapping[str, tuple[int, int | None]]) -> Column:
    """Section of a line by its position; NULL outside all sections. A section whose end is None runs
    to the end of the report."""
    at = F.col(position)
    out = F.lit(None).cast("string")
    for name, (first, last) in reversed(list(bounds.items())):
        inside = at >= first if last is None else at.between(first, last)
        out = F.when(inside, F.lit(name)).otherwise(out)
    return out


def block_of(position: str, first: int, size: int, labels: Sequence[str]) -> Column:
    """Label of the fixed-size block a line falls in, counted from ``first``; NULL past the last."""
    block = F.floor((F.col(position) - first) / size).cast("int")
    return F.when(
        F.col(position) >= first, F.get(F.array(*[F.lit(x) for x in labels]), block)
    )
