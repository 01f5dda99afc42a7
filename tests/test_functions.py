"""Column expressions: the edge cases of parsing and rounding."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from pricemill.functions import dates, numbers, text


@pytest.fixture(scope="module")
def value(spark):
    one = spark.range(1)

    def evaluate(column):
        return one.select(column.alias("v")).first().v

    return evaluate


@pytest.mark.parametrize(
    ("raw", "kind", "expected"),
    [
        ("1.5", "int", 1),
        ("", "int", None),
        ("abc", "double", None),
        ("NaN", "double", None),
        (" 7 ", "int", 7),
        ("3000000000", "int", None),
        ("3000000000", "bigint", 3000000000),
        ("9007199254740993", "bigint", 9007199254740993),
        (" 12\t", "int", 12),
        (None, "double", None),
    ],
)
def test_plain_number(value, raw, kind, expected):
    assert value(numbers.plain_number(F.lit(raw).cast("string"), kind)) == expected


def test_comma_meanings(value):
    assert value(numbers.thousands_number(F.lit(" 12,345.50 "))) == 12345.5
    assert value(numbers.decimal_comma_number(F.lit("61,10"))) == 61.1
    assert value(numbers.currency_number(F.lit("R1,510.00"))) == 1510.0
    assert value(numbers.currency_number(F.lit("$2.50"), symbol="$")) == 2.5
    assert value(numbers.unit_number(F.lit("202 kg"))) == 202


def test_round_half_even(value):
    assert [value(numbers.round_half_even(F.lit(x))) for x in (0.5, 1.5, 2.5)] == [0.0, 2.0, 2.0]


@pytest.mark.parametrize(
    ("raw", "formats", "expected"),
    [
        ("2023/5/1", (dates.REPORT_DATE,), date(2023, 5, 1)),
        ("2023/05/01", (dates.REPORT_DATE,), date(2023, 5, 1)),
        ("08/05/2023", (dates.SHEET_DATE,), date(2023, 5, 8)),
        ("1 May 2023", (dates.SECTION_DATE,), date(2023, 5, 1)),
        ("02 May 2023", (dates.SECTION_DATE,), date(2023, 5, 2)),
        ("2023-05-02", (), date(2023, 5, 2)),
        ("no date", (), None),
        ("31/02/2023", (dates.SHEET_DATE,), None),
    ],
)
def test_parse_date(value, raw, formats, expected):
    assert value(dates.parse_date(F.lit(raw), *formats)) == expected


def test_section_date(value):
    assert value(dates.section_date(F.lit("Monday, 1 May 2023"))) == date(2023, 5, 1)
    assert value(dates.section_date(F.lit("1 May 2023"))) == date(2023, 5, 1)


def test_contract_parts(value):
    parts = text.contract_parts(F.lit("15 May 23 XXXX"))
    assert value(parts) == ["15", "May", "23", "XXXX"]
    assert value(text.token(text.contract_parts(F.lit("15 May")), 3)) is None
    assert value(dates.month_number(F.lit("May"))) == 5
    assert value(dates.month_number(F.lit("Mai"))) is None
    assert value(dates.full_year(F.lit("23"))) == "2023"


@pytest.mark.parametrize(
    ("day", "month", "year", "expected"),
    [
        ("15", 5, "2023", date(2023, 5, 15)),
        ("1", 5, "2099", date(2099, 5, 1)),
        ("30", 2, "2023", None),
        ("15", None, "2023", None),
        ("15", 5, "202023", None),
        (None, 5, "2023", None),
        ("x", 5, "2023", None),
    ],
)
def test_contract_date(value, day, month, year, expected):
    column = dates.contract_date(
        F.lit(day).cast("string"), F.lit(month).cast("int"), F.lit(year).cast("string")
    )
    assert value(column) == expected


def test_product_parts(value):
    assert value(text.product_code(F.lit("12. ONE"))) == "12"
    assert value(text.product_name(F.lit("12. ONE"))) == "ONE"
    assert value(text.product_code(F.lit("NOCODE"))) is None
    assert value(text.product_name(F.lit("NOCODE"))) == "NOCODE"
    assert value(text.after_dot(F.lit("NOCODE"))) is None
    assert value(text.before_dot(F.lit("12. ONE"))) == "12"


def test_tokens(value):
    assert value(text.tokens(F.lit("  A2\t6900  270,50 "))) == ["A2", "6900", "270,50"]
    assert value(text.tokens(F.lit("   "))) == []
    assert value(text.token(text.tokens(F.lit("a b")), 5)) is None


def test_labels_and_contains(value):
    assert value(text.market_label(F.lit("North"), F.lit("N1"), "  ")) == "North  N1"
    assert value(text.market_label(F.lit(None).cast("string"), F.lit("N1"))) is None
    assert value(text.contains_text(F.lit("Week 2023"), "WEEK")) is True
    assert value(text.contains_text(F.lit(None).cast("string"), "202")) is False


def test_page_markup(value):
    page = F.lit(
        '<html lang="en"><title>T</title><table><tr><td>x</td></tr>'
        "<tr><td>Name</td><td> <b>North</b> </td></tr></table></html>"
    )
    assert value(text.table_cell(page, 2, 2)) == "North"
    assert value(text.table_cell(page, 9, 2)) is None
    assert value(text.tag_text(page, "title")) == "T"
    assert value(text.tag_attribute(page, "html", "lang")) == "en"


def test_date_text(value):
    day = F.lit("2023-05-08").cast("date")
    assert value(dates.long_date_text(day)) == "May 08, 2023"
    assert value(dates.date_parts_text(day)) == "2023,5,8"
    assert value(dates.days_before("2023-05-08", 7)) == date(2023, 5, 1)


def test_snake_name():
    assert text.snake_name(" Market to   Market ") == "market_to_market"
