"""Grain futures: sheets to ``grain_prices``, contract columns, and the grain questions."""

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession

from pricemill.functions import dates, text
from pricemill.functions.numbers import thousands_number
from pricemill.operators import filters, measures, shape
from pricemill.schemas import GRAIN
from pricemill.sources import files

# The sheet's column names.
SHEET_COLUMNS = (
    "Contract Type",
    "Volatility",
    "Bid",
    "Offer",
    "Market to Market",
    "First",
    "Last",
    "High",
    "Low",
    "Deals",
    "Conts",
    "Value",
    "Upload Date",
)
MARKET_COLUMNS = ("market_name", "market_code", "market_type")


def _whole(c: Column) -> Column:
    return thousands_number(c, "bigint")


PARSE = {
    # One function for all prices: they are parsed together.
    **dict.fromkeys(
        ("volatility", "bid", "offer", "market_to_market", "first", "last", "high", "low"),
        lambda c: thousands_number(c),
    ),
    "contracts": _whole,
    "value": _whole,
    "upload_date": lambda c: dates.parse_date(c, dates.SHEET_DATE),
    **{c: text.strip for c in MARKET_COLUMNS},
}


def read_sheets(
    spark: SparkSession, path: str, markets: DataFrame, suffix: str = "", skip_bad: bool = False
) -> DataFrame:
    """Raw rows of one sheet per market, with the market attributes.

    ``markets`` has ``file_name`` and the three market columns: the file name is the key, not
    the position in a listing.
    """
    texts = files.file_name(files.read_whole_texts(spark, path, suffix))
    texts = shape.attach(texts, markets, "file_name")
    return files.sheet_rows(
        texts, SHEET_COLUMNS, keep=MARKET_COLUMNS, required=SHEET_COLUMNS, skip_bad=skip_bad
    )


def sheet_faults(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """The files that ``read_sheets`` leaves out with ``skip_bad``, and why."""
    texts = files.read_whole_texts(spark, path, suffix)
    return files.sheet_faults(texts, SHEET_COLUMNS, required=SHEET_COLUMNS)


def read_long_sheets(
    spark: SparkSession, path: str, markets: DataFrame, suffix: str = ""
) -> DataFrame:
    """The same rows from sheets that are too long to be one record each."""
    lines = files.read_lines(spark, path, suffix)
    rows = files.long_sheet_rows(lines, SHEET_COLUMNS, required=SHEET_COLUMNS)
    named = shape.attach(files.file_name(rows), markets, "file_name")
    return named.select("file_path", *MARKET_COLUMNS, *SHEET_COLUMNS)


def clean(raw: DataFrame, drop_incomplete: bool = True) -> DataFrame:
    """Raw text rows to ``grain_prices``; rows with any missing value go."""
    named = shape.rename(shape.snake_names(raw), {"conts": "contracts"})
    typed = shape.conform(named, GRAIN.columns, PARSE)
    return filters.complete(shape.computed_once(typed)) if drop_incomplete else typed


def with_contract(df: DataFrame, separator: str = " ") -> DataFrame:
    """Add the parts of the contract name, the contract date and the market label.

    Parts, then month and year, then the date: each step reads columns of the one before, so
    no parsing is repeated.
    """
    split = df.withColumn("_parts", text.contract_parts("contract_type"))
    parts = split.withColumns(
        {n: text.token("_parts", i) for i, n in enumerate(("day", "month", "_year", "grain_type"))}
    )
    return (
        parts.withColumns(
            {
                "month_code": dates.month_number("month"),
                "year": dates.full_year("_year"),
                "market": text.market_label("market_name", "market_code", separator),
            }
        )
        .withColumn("contract_date", dates.contract_date("day", "month_code", "year"))
        .drop("_parts", "_year")
    )


def grain_counts(df: DataFrame) -> DataFrame:
    """Records per grain type."""
    return measures.group_count(df, "grain_type")


def contract_mix(df: DataFrame, grain: str) -> DataFrame:
    """Contracts of one grain with count, share and total; ``markets`` counts all markets."""
    counts = measures.value_counts(df, "contract_type", {"grain_type": grain}, total=True)
    markets = measures.distinct_counts(df, ["market"], null_is_value=True).scalar()
    return counts.withColumn("markets", markets)


def price_by_contract(
    df: DataFrame, market: str, grain: str, upload: date | str, as_of: date | str
) -> DataFrame:
    """Last price by contract date for one market, grain and upload date."""
    window = filters.trailing(df, "upload_date", as_of)
    picked = filters.equal_to(
        window, {"market": market, "grain_type": grain, "upload_date": dates.as_of_date(upload)}
    )
    return picked.select("contract_date", "contract_type", "last")


def price_series(
    df: DataFrame, market: str, grain: str, as_of: date | str, measure: str = "last"
) -> DataFrame:
    """Price over time per contract of one market and grain, oldest first."""
    window = filters.trailing(df, "upload_date", as_of)
    return (
        filters.equal_to(window, {"market": market, "grain_type": grain})
        .select("upload_date", "contract_type", measure)
        .orderBy("upload_date", "contract_type")
    )


def price_span(
    df: DataFrame, market: str, grain: str, as_of: date | str, measure: str = "last"
) -> DataFrame:
    """Highest and lowest price of the series with its first and last day as text."""
    window = filters.trailing(df, "upload_date", as_of)
    picked = filters.equal_to(window, {"market": market, "grain_type": grain})
    return measures.price_range(picked, [], measure, "upload_date")


LAST_AND_BID = {"last": "Last", "bid": "Bid"}


def open_contract_averages(
    df: DataFrame, market: str, grain: str, as_of: date | str
) -> DataFrame:
    """Mean last and bid price per contract date over contracts not settled yet, long form."""
    window = filters.trailing(df, "upload_date", as_of)
    picked = filters.equal_to(window, {"market": market, "grain_type": grain})
    means = measures.average_by(
        filters.still_open(picked, "contract_date", as_of), ["contract_date"], ["last", "bid"]
    )
    return shape.series(means, ["contract_date"], LAST_AND_BID)


def prices_on(
    df: DataFrame, market: str, grain: str, upload: date | str, as_of: date | str
) -> DataFrame:
    """Last and bid by contract date on one upload date, for contracts of the past year on."""
    picked = filters.year_back_for(
        df,
        "contract_date",
        as_of,
        {"market": market, "grain_type": grain, "upload_date": dates.as_of_date(upload)},
    )
    return shape.series(picked, ["contract_date", "contract_type"], LAST_AND_BID)


def daily_averages(df: DataFrame, market: str, grain: str, as_of: date | str) -> DataFrame:
    """Mean last and bid price per upload date, long form."""
    window = filters.trailing(df, "upload_date", as_of)
    picked = filters.equal_to(window, {"market": market, "grain_type": grain})
    means = measures.average_by(picked, ["upload_date"], ["last", "bid"])
    return shape.series(means, ["upload_date"], LAST_AND_BID)


def contract_series(
    df: DataFrame,
    market: str,
    contract: str,
    measures_: Mapping[str, str] = LAST_AND_BID,
) -> DataFrame:
    """Measures of one contract in one market over time, long form."""
    picked = filters.equal_to(df, {"market": market, "contract_type": contract})
    return shape.series(picked, ["upload_date"], measures_)


def contract_series_with_deals(df: DataFrame, market: str, contract: str) -> DataFrame:
    """Last and bid price with the number of deals."""
    return contract_series(df, market, contract, LAST_AND_BID | {"deals": "Deals"})


def market_share(df: DataFrame, upload: date | str, contract: str) -> DataFrame:
    """Deals per market and their share for an upload date and contract."""
    picked = filters.equal_to(
        df, {"upload_date": dates.as_of_date(upload), "contract_type": contract}
    )
    return measures.segment_share(
        picked,
        ["upload_date", "contract_type", "market"],
        ["upload_date", "contract_type"],
        "deals",
    )


def headline(df: DataFrame, market: str, grain: str, upload: date | str) -> DataFrame:
    """Mean last price, highest bid and mean bid of one upload date."""
    picked = filters.equal_to(
        df, {"market": market, "grain_type": grain, "upload_date": dates.as_of_date(upload)}
    )
    return measures.headline(
        picked, mean={"last": "avg_last", "bid": "avg_bid"}, highest={"bid": "highest_bid"}
    )


def market_averages(df: DataFrame) -> DataFrame:
    """Mean bid and mean last price per market."""
    return measures.average_by(df, ["market"], {"bid": "avg_bid", "last": "avg_last"})
