"""Livestock slaughter reports: weekly texts to the cattle, sheep and pork tables."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricemill.functions import dates, numbers
from pricemill.operators import filters, measures, shape
from pricemill.schemas import CATTLE, PORK, SHEEP, PriceTable
from pricemill.sources import files, reports

# 0-based lines of each section of a report (the pork section runs on to the end
# of the text, its blocks end it), and the tokens of line 0 that hold the dates.
SECTIONS = {"cattle": (1, 8), "sheep": (11, 23), "pork": (26, None)}
DATE_FROM, DATE_TO = 13, 15
# Weight bands of the pork section, six lines each.
WEIGHTS = ("20-55.99kg", "56-64.99kg", "65-79.99kg", "80-99.99kg")
BLOCK = 6
# Columns by position.
CLASS_COLUMNS = (
    "class",
    "units",
    "avg_mass",
    "avg_purch",
    "avg_selling",
    "selling_min",
    "selling_max",
)
PORK_COLUMNS = ("class", "units", "avg_mass", "avg_purch", "purch_min", "purch_max")


def read_reports(
    spark: SparkSession, path: str, suffix: str = "", exclude: Sequence[str] = ()
) -> DataFrame:
    """Section lines of all report files."""
    return report_rows(files.read_whole_texts(spark, path, suffix, exclude))


def report_rows(texts: DataFrame) -> DataFrame:
    """Lines of reports with their dates, section and weight band. No shuffle."""
    lines = reports.report_lines(
        texts,
        header={
            "date_from": F.get("head", DATE_FROM),
            "date_to": F.get("head", DATE_TO),
        },
    )
    return lines.withColumns(
        {
            "section": reports.line_section("pos", SECTIONS),
            "weight": reports.block_of("pos", SECTIONS["pork"][0], BLOCK, WEIGHTS),
        }
    ).filter(F.col("section").isNotNull())


def _clean(
    lines: DataFrame, section: str, names: Sequence[str], table: PriceTable, flag: str | None
) -> DataFrame:
    picked = lines.filter(F.col("section") == section)
    if "weight" in table.columns.fieldNames():
        picked = picked.filter(F.col("weight").isNotNull())
    raw = picked.select(*shape.positional("words", names), "date_from", "date_to", "weight")
    number = {
        f.name: (lambda c, kind=f.dataType.simpleString(): numbers.decimal_comma_number(c, kind))
        for f in table.columns
        if f.dataType.simpleString() in ("bigint", "double")
    }
    day = {d: lambda c: dates.parse_date(c, dates.REPORT_DATE) for d in ("date_from", "date_to")}
    label = {"class": numbers.decimal_comma}
    typed = shape.conform(raw, table.columns, number | day | label)
    return shape.fill_zero(typed, flag=flag)


def cattle(lines: DataFrame, flag: str | None = "was_null") -> DataFrame:
    return _clean(lines, "cattle", CLASS_COLUMNS, CATTLE, flag)


def sheep(lines: DataFrame, flag: str | None = "was_null") -> DataFrame:
    return _clean(lines, "sheep", CLASS_COLUMNS, SHEEP, flag)


def pork(lines: DataFrame, flag: str | None = "was_null") -> DataFrame:
    return _clean(lines, "pork", PORK_COLUMNS, PORK, flag)


def priced(df: DataFrame, empty: int = 6) -> DataFrame:
    """Rows with a purchase price, and without those that lack ``empty`` values."""
    return filters.null_count_not(filters.not_zero_keep_null(df, "avg_purch"), empty)


def price_series(df: DataFrame, class_: str | None = None) -> DataFrame:
    """Purchase price over time, of one class or of all."""
    rows = filters.not_zero_keep_null(df, "avg_purch")
    if class_ is not None:
        rows = filters.equal_to(rows, {"class": class_})
    return rows.select("date_to", "class", "avg_purch").orderBy("date_to", "class")


def compare_classes(df: DataFrame, first: str, second: str) -> DataFrame:
    """Purchase price over time of two classes."""
    return (
        filters.one_of(df, "class", first, second)
        .select("date_to", "class", "avg_purch")
        .orderBy("date_to", "class")
    )


def class_counts(df: DataFrame) -> DataFrame:
    """Records per class with the total."""
    return measures.value_counts(df, "class", share=False, total=True)


def headline(df: DataFrame, class_: str) -> DataFrame:
    """Mean purchase price, mass and selling price of a class."""
    return measures.headline(
        filters.equal_to(df, {"class": class_}),
        mean={"avg_purch": "avg_purch", "avg_mass": "avg_mass", "avg_selling": "avg_selling"},
    )


def weight_counts(df: DataFrame, weight: str) -> DataFrame:
    """Pork records per class in one weight band."""
    return measures.value_counts(df, "class", {"weight": weight}, share=False, total=True)


def pork_series(
    df: DataFrame, weight: str, class_: str, measure: str = "avg_purch"
) -> DataFrame:
    """One measure over time for a weight band and class."""
    return (
        filters.equal_to(df, {"weight": weight, "class": class_})
        .select("date_to", measure)
        .orderBy("date_to", measure)
    )


PORK_MEASURES = {"units": "Units", "avg_mass": "Mass", "avg_purch": "Price"}


def pork_measures(
    df: DataFrame, weight: str, class_: str, names: Mapping[str, str] = PORK_MEASURES
) -> DataFrame:
    """Units, mass and price over time in long form."""
    picked = filters.equal_to(df, {"weight": weight, "class": class_})
    return shape.series(picked, ["date_to"], names)


def pork_headline(df: DataFrame, weight: str, class_: str) -> DataFrame:
    """Mean purchase price, units and mass of a weight band and class."""
    return measures.headline(
        filters.equal_to(df, {"weight": weight, "class": class_}),
        mean={"avg_purch": "avg_purch", "units": "avg_units", "avg_mass": "avg_mass"},
    )


def class_averages(df: DataFrame, *more: str) -> DataFrame:
    """Mean purchase price, mass and units per class (and, say, market)."""
    return measures.average_by(
        df,
        ["class", *more],
        {"avg_purch": "avg_purch", "avg_mass": "avg_mass", "units": "avg_units"},
    )
