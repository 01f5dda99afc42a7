"""Text columns: names, labels, codes, tokens, page fields."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricemill.functions import ColumnLike, as_column


# Fixed value: the characters that count as white space around and between words.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: ColumnLike) -> Column:
    """Without white space at both ends; no-break spaces count, which a plain trim leaves."""
    return F.trim(as_column(c), F.lit(WHITE_SPACE))


def snake_name(name: str) -> str:
    """'Market to  Market' -> 'market_to_market'."""
    return "_".join(name.split()).lower()


def tokens(c: ColumnLike) -> Column:
    """Split on runs of white space; a blank line has no tokens."""
    # Unicode classes take in no-break spaces; the range adds the separator control characters.
    return F.array_remove(F.split(as_column(c), r"(?U)[\s\x1c-\x1f]+"), "")


def token(words: ColumnLike, position: int) -> Column:
    """Token at a 0-based position, NULL past the end."""
    return F.get(as_column(words), position)


def contract_parts(c: ColumnLike) -> Column:
    """'15 May 23 XXXX' -> day, month, year, grain type, as an array."""
    return F.split(as_column(c), " ")


def market_label(name: ColumnLike, code: ColumnLike, separator: str = " ") -> Column:
    """Name and code in one label; NULL when either is NULL."""
    return F.concat(as_column(name), F.lit(separator), as_column(code))


def before_dot(c: ColumnLike) -> Column:
    """'12. ONE' -> '12'."""
    return strip(F.get(F.split(as_column(c), "[.]"), 0))


def after_dot(c: ColumnLike) -> Column:
    """'12. ONE' -> 'ONE'; NULL when there is no dot."""
    return strip(F.get(F.split(as_column(c), "[.]"), 1))


def product_code(c: ColumnLike) -> Column:
    """Leading number of a product, NULL when it has none."""
    return F.nullif(F.regexp_extract(as_column(c), r"^(\d+)\.", 1), F.lit(""))


def product_name(c: ColumnLike) -> Column:
    """'12. ONE' -> 'ONE'; a product without a number keeps its whole name."""
    return F.regexp_replace(as_column(c), r"^\d+\.\s*", "")


def without_blanks(c: ColumnLike) -> Column:
    return F.translate(as_column(c), " ", "")


def contains_text(c: ColumnLike, part: str) -> Column:
    """Case-insensitive substring test; NULL text counts as false."""
    return F.coalesce(F.contains(F.lower(as_column(c)), F.lit(part.lower())), F.lit(False))


def table_cell(html: ColumnLike, row: int, cell: int) -> Column:
    """Text of a cell in an information table of a page, both counted from 1; NULL if absent."""
    rows = F.regexp_extract_all(as_column(html), F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
    cells = F.regexp_extract_all(
        F.get(rows, row - 1), F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), F.lit(1)
    )
    return strip(F.regexp_replace(F.get(cells, cell - 1), "<[^>]*>", ""))


def tag_text(html: ColumnLike, tag: str) -> Column:
    """Text of the first element ``tag`` without nested markup; NULL if absent."""
    name = re.escape(tag)
    return F.nullif(
        F.regexp_extract(as_column(html), f"<{name}>([^<]*)</{name}>", 1), F.lit("")
    )


def tag_attribute(html: ColumnLike, tag: str, attribute: str) -> Column:
    """Value of an attribute of the first element ``tag`` that carries it; NULL if absent."""
    pattern = f'<{re.escape(tag)}\\b[^>]*\\b{re.escape(attribute)}="([^"]*)"'
    return F.nullif(F.regexp_extract(as_column(html), pattern, 1), F.lit(""))
