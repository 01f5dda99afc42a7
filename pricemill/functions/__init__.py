"""Column expressions. Every function takes a column (or its name) and returns a column."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)
