"""The three families on invented raw reports, from file to answer."""

from datetime import date

import pytest
from test_sources import write

from pricemill.functions.text import snake_name
from pricemill.operators import quality
from pricemill.plans import grain, horticulture, livestock
from pricemill.schemas import CATTLE, GRAIN, HORTICULTURE, PORK, SHEEP

GRAIN_HEAD = (
    "Contract Type,Volatility,Bid,Offer,Market to Market,First,Last,High,Low,Deals,Conts,Value,,Upload Date"
)


@pytest.fixture(scope="module")
def grain_prices(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("grain")
    write(
        folder,
        "north.csv",
        f"title line\n{GRAIN_HEAD}\n"
        '15 May 23 XXXX," 12.5 ","3,410","3,425","3,420","3,400","3,418","3,430","3,395",12,"1,204","41,152,720",,08/05/2023\n'
        '21 Jul 23 YYYY, ,"5,900","5,910","5,905","5,890","5,901","5,915","5,880",3,45,"3000000000",,08/05/2023\n'
        '21 Jul 23 XXXX,1,"3,500","3,510","3,505","3,490","3,501","3,515","3,480",3,45,"3000000000",,8/5/2023\n'
        '21 Jul 23 XXXX,1,"3,600","3,510","3,505","3,490","3,601","3,515","3,480",5,45,"100",,01/05/2023\n',
    )
    write(
        folder,
        "south.csv",
        f"title line\n{GRAIN_HEAD}\n"
        '15 May 23 XXXX,2,"1,000","3,425","3,420","3,400","2,000","3,430","3,395",36,"1,204","1",,08/05/2023\n',
    )
    write(folder, "empty.csv", f"title line\n{GRAIN_HEAD}\n")
    markets = spark.createDataFrame(
        [("south.csv", " South ", "S1", "spot"), ("north.csv", "North", "N1", "spot"), ("empty.csv", "E", "E", "e")],
        "file_name string, market_name string, market_code string, market_type string",
    )
    raw = grain.read_sheets(spark, str(folder), markets)
    return raw


def test_grain_clean(grain_prices):
    clean = grain.clean(grain_prices)
    assert [(f.name, f.dataType) for f in clean.schema] == [(f.name, f.dataType) for f in GRAIN.columns]
    assert clean.count() == 4
    kept = grain.clean(grain_prices, drop_incomplete=False)
    assert kept.count() == 5
    big = kept.filter("contract_type = '21 Jul 23 XXXX' and value > 100").first()
    assert (big.value, big.bid, big.upload_date, big.market_name) == (
        3000000000, 3500.0, date(2023, 5, 8), "North",
    )
    assert kept.filter("volatility is null").count() == 1
    assert kept.filter("market_name = 'South'").count() == 1


def test_grain_questions(grain_prices):
    df = grain.with_contract(grain.clean(grain_prices))
    north, upload, as_of = "North N1", date(2023, 5, 8), date(2023, 5, 10)
    assert {r.grain_type: r.n for r in grain.grain_counts(df).collect()} == {"XXXX": 4}
    mix = grain.contract_mix(df, "XXXX").collect()
    assert [(r.contract_type, r.n, r.share, r.total, r.markets) for r in mix] == [
        ("15 May 23 XXXX", 2, 0.5, 4, 2), ("21 Jul 23 XXXX", 2, 0.5, 4, 2),
    ]
    prices = grain.price_by_contract(df, north, "XXXX", upload, as_of).collect()
    assert sorted((r.contract_date, r.last) for r in prices) == [
        (date(2023, 5, 15), 3418.0), (date(2023, 7, 21), 3501.0),
    ]
    series = grain.price_series(df, north, "XXXX", as_of, "bid").collect()
    assert [r.bid for r in series] == [3600.0, 3410.0, 3500.0]
    assert tuple(grain.price_span(df, north, "XXXX", as_of).first()) == (
        3418.0, 3601.0, "May 01, 2023", "May 08, 2023",
    )
    unsettled = grain.open_contract_averages(df, north, "XXXX", date(2023, 5, 15)).collect()
    assert sorted((r.series, r.value) for r in unsettled) == [("Bid", 3550.0), ("Last", 3551.0)]
    assert grain.prices_on(df, north, "XXXX", upload, as_of).count() == 4
    daily = grain.daily_averages(df, north, "XXXX", as_of).collect()
    assert {(r.upload_date.day, r.series): r.value for r in daily} == {
        (1, "Last"): 3601.0, (1, "Bid"): 3600.0, (8, "Last"): 3459.5, (8, "Bid"): 3455.0,
    }
    assert grain.contract_series(df, north, "21 Jul 23 XXXX").count() == 4
    assert grain.contract_series_with_deals(df, north, "21 Jul 23 XXXX").count() == 6
    share = grain.market_share(df, upload, "15 May 23 XXXX").collect()
    assert {r.market: r.share for r in share} == {"North N1": 0.25, "South S1": 0.75}
    assert tuple(grain.headline(df, north, "XXXX", upload).first()) == (3460.0, 3455.0, 3500.0)
    means = {r.market: r.avg_last for r in grain.market_averages(df).collect()}
    assert means["South S1"] == 2000.0


HORTICULTURE_TEXT = """title line
Product,Variety,Class,Size,Package,Unit,Closing Price,High Price,Low Price,Average Price,Total Sales,Sales Quantity,Closing Stock
12. ONE,V,1,M,BAG,10 kg,50.0,60.0,40.0,50.0,R500.00,10,5
,,,,,"Monday, 1 May 2023",,,,,,,
12. ONE,V,1,M,BAG,10 kg,51.0,61.0,41.0,,"R1,510.00",30,7
,,,,,,,,,,,,
13. TWO,NO VARIETY,NOT GRADED,NO SIZE,BOX,202 kg,0,0,0,0,R0.00,0,9
,,,,,"Tuesday, 02 May 2023",,,,,,,
NOCODE,V,2,L,BOX,5 kg,20.0,22.0,18.0,20.0,R40.00,2,1
,,,,,"Monday, 1 May 2023",,,,,,,
12. ONE,V,1,M,BAG,10 kg,53.0,61.0,41.0,52.0,R1.00,30,8
"""


@pytest.fixture(scope="module")
def horticulture_raw(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("horticulture")
    write(folder, "North Gate_N1_fresh/p1.csv", HORTICULTURE_TEXT)
    write(folder, "South_S1_fresh/p1.csv", HORTICULTURE_TEXT.replace("ONE", "SIX"))
    write(folder, "South_S1_fresh/none.csv", "title line\nProduct,Unit\n")
    write(folder, "Empty_E1_fresh/none.csv", "")
    return horticulture.read_sheets(spark, str(folder))


@pytest.fixture(scope="module")
def tiny_splits(spark):
    """Files are cut in many splits, as long ones are."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_long_sheets_give_the_same_rows(spark, tmp_path, tiny_splits):
    write(tmp_path, "North Gate_N1_fresh/p1.csv", HORTICULTURE_TEXT)
    write(tmp_path, "South_S1_fresh/p1.csv", HORTICULTURE_TEXT.replace("ONE", "SIX"))
    write(tmp_path, "South_S1_fresh/none.csv", "title line\nProduct,Unit\n")
    short = horticulture.clean(horticulture.read_sheets(spark, str(tmp_path)))
    long = horticulture.clean(horticulture.read_long_sheets(spark, str(tmp_path)))
    assert sorted(map(str, long.collect())) == sorted(map(str, short.collect()))


def test_long_grain_sheets_give_the_same_rows(spark, tmp_path, tiny_splits):
    rows = "".join(
        f'15 May 23 G{i},1,"3,{i:03d}",1,1,1,2,1,1,{i},"1,204",5,,08/05/2023\n' for i in range(200)
    )
    write(tmp_path, "a.csv", f"title line\n{GRAIN_HEAD}\n{rows}")
    write(tmp_path, "b.csv", f"title line\n{GRAIN_HEAD}\n{rows[:500]}")
    markets = spark.createDataFrame(
        [("a.csv", "A", "1", "t"), ("b.csv", "B", "2", "t")],
        "file_name string, market_name string, market_code string, market_type string",
    )
    short = grain.clean(grain.read_sheets(spark, str(tmp_path), markets))
    long = grain.clean(grain.read_long_sheets(spark, str(tmp_path), markets))
    assert short.count() > 200
    assert sorted(map(str, long.collect())) == sorted(map(str, short.collect()))


def test_horticulture_clean(horticulture_raw):
    df = horticulture.clean(horticulture_raw).filter("market_code = 'N1'")
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in HORTICULTURE.columns
    ]
    got = sorted(
        (r.product, r.product_code, r.unit_kg, str(r.date), r.average_price, r.total_sales, r.market_name)
        for r in df.collect()
    )
    assert [g for g in got if g[0] == "ONE"] == [
        ("ONE", "12", 10, "2023-05-01", 51.0, 1510.0, "North Gate"),
        ("ONE", "12", 10, "2023-05-01", 52.0, 1.0, "North Gate"),
        ("ONE", "12", 10, "None", 50.0, 500.0, "North Gate"),
    ]
    assert [g[:5] for g in got if g[0] != "ONE"] == [
        ("NOCODE", None, 5, "2023-05-02", 20.0),
        ("TWO", "13", 202, "2023-05-01", 0.0),
    ]


def test_horticulture_policies(horticulture_raw):
    counts = {
        p: horticulture.clean(horticulture_raw, p).count() for p in ("coalesce", "drop", "nonzero")
    }
    assert counts == {"coalesce": 10, "drop": 8, "nonzero": 6}


def test_horticulture_questions(horticulture_raw):
    df = horticulture.clean(horticulture_raw)
    leaf = {"market_name": "North Gate", "product": "ONE", "variety": "V", "class": "1", "size": "M", "package": "BAG"}
    seen = {}
    for level in horticulture.LEVELS:
        options = {r[0] for r in horticulture.options(df, seen).collect()}
        assert leaf[level] in options
        seen[level] = leaf[level]
    assert {r[0] for r in horticulture.options(df, {"market_name": "South"}).collect()} == {
        "SIX", "TWO", "NOCODE",
    }
    series = horticulture.leaf_series(df, leaf).collect()
    assert [(r.closing_price, r.sales_quantity) for r in series] == [(50.0, 10), (51.0, 30), (53.0, 30)]
    assert {r.market_name: r.share for r in horticulture.markets_of(df, "TWO").collect()} == {
        "North Gate": 0.5, "South": 0.5,
    }
    assert tuple(horticulture.headline(df, leaf).first()) == (51.0, 51.0, 20)
    counts = horticulture.descriptive_counts(df).first()
    assert (counts.market_name, counts["product"], counts["size"]) == (2, 4, 3)
    means = {r.market_name: r.avg_closing for r in horticulture.market_averages(df).collect()}
    assert means["South"] == pytest.approx((50 + 51 + 0 + 20 + 53) / 5)
    volumes = {(r.market_name, r["product"]): (r.n, r.sales_quantity) for r in horticulture.market_volumes(df).collect()}
    assert volumes["South", "SIX"] == (3, 70)


def report(week, extra=0, end=""):
    """An invented report of 50 lines: dates on line 0, three sections, four weight blocks."""
    lines = [f"t0 t1 t2 t3 t4 t5 t6 t7 t8 t9 t10 t11 t12 2023/05/{week:02d} to 2023/5/{week + 6}"]
    for i in range(1, 50 + extra):
        if i == 2:
            lines.append("AB 530 276,90 57,40 62,20 60,80")
        elif 1 <= i <= 8:
            lines.append(f"A{i} 6900 270,50 61,10 63,20 62,00 64,00 surplus tokens")
        elif 11 <= i <= 23:
            lines.append(f"S{i} 10 20,5 90,0 91,0 92,0 93,0")
        elif i >= 26:
            lines.append(f"P{(i - 26) % 6} {i} 70,5 30,25 29,0 31,0")
        else:
            lines.append("heading of a section")
    return "\n".join(lines) + end


@pytest.fixture(scope="module")
def livestock_lines(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("livestock")
    write(folder, "w1.txt", report(1))
    write(folder, "w2.txt", report(8, extra=3))
    write(folder, "w3.txt", report(15, end="\n"))
    write(folder, "bad.txt", report(22))
    return livestock.read_reports(spark, str(folder), ".txt", exclude=["bad.txt"])


def test_livestock_tables(livestock_lines):
    cattle, sheep, pork = (
        f(livestock_lines) for f in (livestock.cattle, livestock.sheep, livestock.pork)
    )
    for df, table, n in ((cattle, CATTLE, 24), (sheep, SHEEP, 39), (pork, PORK, 72)):
        assert [(f.name, f.dataType) for f in df.schema if f.name != "was_null"] == [
            (f.name, f.dataType) for f in table.columns
        ]
        assert df.count() == n
        assert quality.key_conflicts(df, table.keys).count() == 0
        assert all(v == 0 for v in quality.table_checks(df, table).first())
    short = cattle.filter("class = 'AB'").first()
    assert (short.selling_min, short.selling_max, short.was_null) == (60.8, 0.0, True)
    assert cattle.filter("was_null").count() == 3
    assert {(str(r.date_from), str(r.date_to)) for r in cattle.collect()} == {
        ("2023-05-01", "2023-05-07"), ("2023-05-08", "2023-05-14"), ("2023-05-15", "2023-05-21"),
    }
    weights = {r.weight: r.n for r in pork.groupBy("weight").count().withColumnRenamed("count", "n").collect()}
    assert weights == dict.fromkeys(livestock.WEIGHTS, 18)


def test_livestock_questions(livestock_lines):
    cattle, pork = livestock.cattle(livestock_lines), livestock.pork(livestock_lines)
    assert [r.avg_purch for r in livestock.price_series(cattle, "A1").collect()] == [61.1] * 3
    assert livestock.price_series(cattle).count() == 24
    assert livestock.compare_classes(cattle, "A1", "A4").count() == 6
    counts = livestock.class_counts(cattle).collect()
    assert (counts[0]["class"], counts[0].n, counts[0].total) == ("A1", 3, 24)
    assert tuple(livestock.headline(cattle, "A1").first()) == (61.0, 270.0, 63.0)
    band = livestock.WEIGHTS[1]
    assert all((r.n, r.total) == (3, 18) for r in livestock.weight_counts(pork, band).collect())
    assert [r.units for r in livestock.pork_series(pork, band, "P0", "units").collect()] == [32] * 3
    assert livestock.pork_measures(pork, band, "P0").count() == 9
    assert tuple(livestock.pork_headline(pork, band, "P0").first()) == (30.0, 32.0, 70.0)
    means = {r["class"]: r.avg_units for r in livestock.class_averages(cattle).collect()}
    assert means["A1"] == 6900.0
    assert livestock.priced(cattle).count() == 24


def test_header_names_become_contract_names():
    named = [snake_name(c) for c in grain.SHEET_COLUMNS]
    assert set(named) - {"conts"} <= set(GRAIN.columns.fieldNames())
