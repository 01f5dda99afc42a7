"""The five price tables: columns, types, keys and text lengths (the data contract)."""

from dataclasses import dataclass, field

from pyspark.sql import types as T

TEXT = T.StringType()
WHOLE = T.LongType()
REAL = T.DoubleType()
DAY = T.DateType()


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


@dataclass(frozen=True)
class PriceTable:
    """A target table. Spark does not enforce keys or lengths on write; ``operators.quality``
    checks them."""

    name: str
    columns: T.StructType
    date: str
    keys: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    #: A column beside the contract's: whether a measure was missing and has become 0.
    flag: str | None = None

    @property
    def stored(self) -> T.StructType:
        """The columns as they are written, the flag included."""
        extra = [T.StructField(self.flag, T.BooleanType())] if self.flag else []
        return T.StructType([*self.columns.fields, *extra])

    @property
    def required(self) -> list[str]:
        return self.columns.fieldNames()


GRAIN = PriceTable(
    "grain_prices",
    _struct(
        ("contract_type", TEXT),
        ("volatility", REAL),
        ("bid", REAL),
        ("offer", REAL),
        ("market_to_market", REAL),
        ("first", REAL),
        ("last", REAL),
        ("high", REAL),
        ("low", REAL),
        ("deals", WHOLE),
        ("contracts", WHOLE),
        ("value", WHOLE),
        ("upload_date", DAY),
        ("market_name", TEXT),
        ("market_code", TEXT),
        ("market_type", TEXT),
    ),
    date="upload_date",
)

HORTICULTURE = PriceTable(
    "horticulture_prices",
    _struct(
        ("product_code", TEXT),
        ("product", TEXT),
        ("variety", TEXT),
        ("class", TEXT),
        ("size", TEXT),
        ("package", TEXT),
        ("unit_kg", WHOLE),
        ("closing_price", REAL),
        ("high_price", REAL),
        ("low_price", REAL),
        ("average_price", REAL),
        ("total_sales", REAL),
        ("sales_quantity", WHOLE),
        ("closing_stock", WHOLE),
        ("date", DAY),
        ("market_name", TEXT),
        ("market_code", TEXT),
        ("market_type", TEXT),
    ),
    date="date",
    max_length={"variety": 30, "class": 30, "size": 30, "package": 30},
)

_CLASS_REPORT = (
    ("class", TEXT),
    ("units", WHOLE),
    ("avg_mass", REAL),
    ("avg_purch", REAL),
    ("avg_selling", REAL),
    ("selling_min", REAL),
    ("selling_max", REAL),
    ("date_from", DAY),
    ("date_to", DAY),
)

CATTLE = PriceTable(
    "livestock_cattle_prices",
    _struct(*_CLASS_REPORT),
    date="date_to",
    keys=("class", "date_from"),
    max_length={"class": 30},
    flag="was_null",
)

SHEEP = PriceTable(
    "livestock_sheep_prices",
    _struct(*_CLASS_REPORT),
    date="date_to",
    keys=("class", "date_from"),
    max_length={"class": 30},
    flag="was_null",
)

PORK = PriceTable(
    "livestock_pork_prices",
    _struct(
        ("class", TEXT),
        ("units", WHOLE),
        ("avg_mass", REAL),
        ("avg_purch", REAL),
        ("purch_min", REAL),
        ("purch_max", REAL),
        ("date_from", DAY),
        ("date_to", DAY),
        ("weight", TEXT),
    ),
    date="date_to",
    keys=("class", "date_from", "weight"),
    max_length={"class": 30},
    flag="was_null",
)

TABLES = {t.name: t for t in (GRAIN, HORTICULTURE, CATTLE, SHEEP, PORK)}
