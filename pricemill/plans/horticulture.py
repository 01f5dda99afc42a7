"""Horticulture market prices: dated sheets to ``horticulture_prices`` and its questions."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricemill.functions import dates, numbers, text
from pricemill.operators import filters, measures, ordered, shape
from pricemill.schemas import HORTICULTURE
from pricemill.sources import files

# The sheet's column names.
SHEET_COLUMNS = (
    "Product",
    "Variety",
    "Class",
    "Size",
    "Package",
    "Unit",
    "Closing Price",
    "High Price",
    "Low Price",
    "Average Price",
    "Total Sales",
    "Sales Quantity",
    "Closing Stock",
)
REQUIRED = ("Product", "Unit")
# Fixed value: a section header holds a written-out date, such as 'Monday, 1 May 2023'.
SECTION_HEADER = r"((?:[A-Za-z]+day, )?\d{1,2} [A-Za-z]+ 20\d\d)"

LEVELS = ("market_name", "product", "variety", "class", "size", "package")
DESCRIPTIVE = (*LEVELS, "market_code", "market_type")

PARSE = {
    "unit_kg": numbers.unit_number,
    "total_sales": numbers.currency_number,
    "date": dates.section_date,
}


def read_sheets(
    spark: SparkSession, path: str, suffix: str = "", skip_bad: bool = False
) -> DataFrame:
    """Raw rows of all market directories with section date and market columns."""
    texts = files.market_of_path(files.read_whole_texts(spark, path, suffix))
    rows = files.dated_sheet_rows(
        texts,
        SHEET_COLUMNS,
        SECTION_HEADER,
        section_column="Unit",
        section="Date",
        keep=("market_name", "market_code", "market_type"),
        required=REQUIRED,
        skip_bad=skip_bad,
    )
    return filters.not_blank(rows, SHEET_COLUMNS)


def sheet_faults(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """The files that ``read_sheets`` leaves out with ``skip_bad``, and why."""
    texts = files.read_whole_texts(spark, path, suffix)
    return files.sheet_faults(texts, SHEET_COLUMNS, required=REQUIRED)


def read_long_sheets(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """The same rows from sheets that are too long to be one record each.

    Lines are read in splits, and the section date is carried down in the order of the lines.
    """
    lines = files.read_lines(spark, path, suffix)
    rows = files.long_sheet_rows(lines, SHEET_COLUMNS, required=REQUIRED)
    found = F.nullif(F.regexp_extract("Unit", SECTION_HEADER, 1), F.lit(""))
    dated = ordered.sections(
        rows, ["file_path"], ["block", "line_id"], found.isNotNull(), found, "Date"
    )
    return files.market_of_path(dated).drop("block", "line_id")


def clean(raw: DataFrame, policy: str = "coalesce") -> DataFrame:
    """Raw text rows to ``horticulture_prices``; ``policy`` treats a missing average price."""
    named = shape.rename(shape.trim_text(shape.snake_names(raw)), {"unit": "unit_kg"})
    coded = named.withColumns(
        {"product_code": text.product_code("product"), "product": text.product_name("product")}
    )
    return filters.price_policy(shape.conform(coded, HORTICULTURE.columns, PARSE), policy)


def options(df: DataFrame, chosen: Mapping[str, object]) -> DataFrame:
    """Next options of the cascade market, product, variety, class, size, package."""
    return measures.facet_options(df, LEVELS, chosen)


def leaf_series(df: DataFrame, leaf: Mapping[str, object]) -> DataFrame:
    """Closing price and quantity over time at a leaf of the cascade, zero prices left out."""
    priced = filters.not_zero_keep_null(df, "closing_price")
    return (
        filters.equal_to(priced, leaf)
        .select("date", "closing_price", "sales_quantity")
        .orderBy("date", "closing_price")
    )


def markets_of(df: DataFrame, product: str) -> DataFrame:
    """Records per market for one product, with shares."""
    return measures.value_counts(df, "market_name", {"product": product})


def headline(df: DataFrame, leaf: Mapping[str, object]) -> DataFrame:
    """Mean closing price, mean average price and sum of the closing stock."""
    return measures.headline(
        filters.equal_to(df, leaf),
        mean={"closing_price": "avg_closing", "average_price": "avg_price"},
        total={"closing_stock": "closing_stock"},
    )


def descriptive_counts(df: DataFrame) -> DataFrame:
    """Distinct values of the descriptive columns."""
    return measures.distinct_counts(df, DESCRIPTIVE)


def market_averages(df: DataFrame) -> DataFrame:
    """Mean closing price per market."""
    return measures.average_by(df, ["market_name"], {"closing_price": "avg_closing"})


def market_volumes(df: DataFrame) -> DataFrame:
    """Trading volume of products per market: records and quantity sold."""
    known = df.dropna(subset=["market_name", "product"])
    return known.groupBy("market_name", "product").agg(
        F.count(F.lit(1)).alias("n"), F.sum("sales_quantity").alias("sales_quantity")
    )
