"""Text to number without raising under ANSI mode, and rounding."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricemill.functions import ColumnLike, as_column, bound
from pricemill.functions.text import strip

WHOLE_TYPES = ("int", "bigint")


def plain_number(c: ColumnLike, kind: str = "double") -> Column:
    """Cast text to ``kind``; text that is no number, and NaN, become NULL.

    Whole kinds drop the fraction ('1.5' is 1) and give NULL when the value does not fit.
    """
    text = as_column(c).cast("string")
    if kind not in WHOLE_TYPES:
        real = F.nanvl(bound(text, _real), F.lit(None).cast("double"))
        return real if kind == "double" else real.try_cast(kind)
    return bound(text, lambda t: F.coalesce(t.try_cast(kind), _whole(strip(t), kind)))


def _real(text: Column) -> Column:
    """A cast passes over white space of ASCII, so only text that it can't read is stripped."""
    return F.coalesce(text.try_cast("double"), strip(text).try_cast("double"))


def _whole(text: Column, kind: str) -> Column:
    """The direct cast keeps all digits of long numbers; the detour over double takes fractions."""
    real = F.nanvl(text.try_cast("double"), F.lit(None).cast("double"))
    return F.coalesce(text.try_cast(kind), real.try_cast(kind))


def thousands_number(c: ColumnLike, kind: str = "double") -> Column:
    """'12,345.50' -> 12345.5: the comma groups thousands."""
    return plain_number(F.translate(as_column(c), ",", ""), kind)


def decimal_comma(c: ColumnLike) -> Column:
    """'61,10' -> '61.10' as text: the comma is the decimal mark."""
    return F.translate(as_column(c), ",", ".")


def decimal_comma_number(c: ColumnLike, kind: str = "double") -> Column:
    """'61,10' -> 61.1. A source uses either this or ``thousands_number``, never both."""
    return plain_number(decimal_comma(c), kind)


def currency_number(c: ColumnLike, symbol: str = "R", kind: str = "double") -> Column:
    """'R1,510.00' -> 1510.0: one leading currency symbol and thousands commas go."""
    return thousands_number(F.regexp_replace(strip(c), f"^\\Q{symbol}\\E", ""), kind)


def unit_number(c: ColumnLike, unit: str = " kg", kind: str = "int") -> Column:
    """'10 kg' -> 10."""
    return plain_number(F.replace(as_column(c), F.lit(unit), F.lit("")), kind)


def round_half_even(c: ColumnLike, digits: int = 0) -> Column:
    """Rounding used for headline figures: 2.5 -> 2, 3.5 -> 4."""
    return F.bround(as_column(c), digits)


def missing(c: ColumnLike, dtype: str | None = None) -> Column:
    """True for NULL, and for NaN where the column is a float or double."""
    col = as_column(c)
    if dtype in ("float", "double"):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def no_nan(c: ColumnLike, dtype: str | None = "double") -> Column:
    """NaN to NULL, so that averages and sums skip it."""
    col = as_column(c)
    if dtype in ("float", "double"):
        return F.nanvl(col, F.lit(None).cast(dtype))
    return col
