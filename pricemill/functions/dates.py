"""Date parsing, contract dates, date text and date arithmetic."""

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricemill.functions import ColumnLike, as_column
from pricemill.functions.text import strip

# The date shapes of the three report families. One-letter day and month
# fields accept one and two digits.
REPORT_DATE = "yyyy/M/d"
SHEET_DATE = "d/M/yyyy"
SECTION_DATE = "d MMMM yyyy"
ISO_DATE = "yyyy-M-d"

# Month abbreviations in a contract name.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def parse_date(c: ColumnLike, *formats: str) -> Column:
    """First format that fits wins; NULL when none does."""
    text = strip(c)
    shapes = formats or (ISO_DATE, REPORT_DATE, SHEET_DATE, SECTION_DATE)
    return F.coalesce(*[F.try_to_date(text, shape) for shape in shapes])


def strip_weekday(c: ColumnLike) -> Column:
    """'Monday, 1 May 2023' -> '1 May 2023': all up to the last comma and blank goes."""
    return F.regexp_replace(as_column(c), "^(.*,) ", "")


def section_date(c: ColumnLike) -> Column:
    """Date of a section header such as 'Monday, 1 May 2023'."""
    return parse_date(strip_weekday(c), SECTION_DATE)


def month_number(c: ColumnLike) -> Column:
    """'May' -> 5; other text gives NULL."""
    numbers = F.create_map(*[F.lit(x) for n, m in enumerate(MONTHS, 1) for x in (m, n)])
    return numbers[as_column(c)]


def full_year(c: ColumnLike) -> Column:
    """'23' -> '2023'."""
    return F.concat(F.lit("20"), as_column(c))


def contract_date(day: ColumnLike, month: ColumnLike, year: ColumnLike) -> Column:
    """Date from the day, month number and four-digit year of a contract; NULL if there is none.

    A cast of year-month-day text is about twice as fast as parsing with a pattern.
    """
    full = F.when(F.length(as_column(year)) == 4, as_column(year))
    dash = F.lit("-")
    # One NULL part makes the whole text NULL.
    text = F.concat(full, dash, as_column(month).cast("string"), dash, as_column(day))
    return text.try_cast("date")


def long_date_text(c: ColumnLike) -> Column:
    """'May 08, 2023'."""
    return F.date_format(as_column(c), "MMMM dd, yyyy")


def date_parts_text(c: ColumnLike) -> Column:
    """'2023,5,8': the form a calendar control takes."""
    return F.date_format(as_column(c), "yyyy,M,d")


def as_of_date(as_of: date | str) -> Column:
    return F.lit(as_of).cast("date")


def days_before(as_of: date | str, days: int) -> Column:
    """The day ``days`` before ``as_of``; a constant to the optimizer, so it reaches the scan."""
    return F.date_sub(as_of_date(as_of), days)
