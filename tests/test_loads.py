"""Sheets with awkward text, repeated loads, pruned reads: what must not lose rows."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from pricemill import schemas
from pricemill.operators import filters, measures
from pricemill.plans import grain, horticulture, livestock, load
from pricemill.sinks import keys
from pricemill.sinks import tables as sinks
from pricemill.sources import files
from pricemill.streaming import incremental

HEAD = "Product,Variety,Class,Size,Package,Unit,Closing Price,High Price,Low Price,Average Price,Total Sales,Sales Quantity,Closing Stock"
GRAIN_HEAD = "contract type,VOLATILITY,Bid,Offer,Market to  Market,First,Last,High,Low,Deals,conts,Value,,Upload Date"


def write(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8", newline="")


def market(variety="V", package="BAG", quantity="10"):
    return f"1. A,{variety},1,M,{package},10 kg,5,6,4,5,R5.00,{quantity},5"


def test_only_the_unit_field_opens_a_section(spark, tmp_path):
    lines = [
        "title",
        HEAD.lower(),
        ",,,,,\"Monday, 1 May 2023\",,,,,,,",
        market(),
        market(package="BOX 5 kg 2000 x"),
        market(variety="V harvest 3 June 2023"),
        market(quantity="3000000000"),
    ]
    write(tmp_path, "M_1_t/a.csv", "\n".join(lines))
    short = horticulture.clean(horticulture.read_sheets(spark, str(tmp_path)))
    long = horticulture.clean(horticulture.read_long_sheets(spark, str(tmp_path)))
    rows = short.collect()
    assert [r.date for r in rows] == [date(2023, 5, 1)] * 4
    assert max(r.sales_quantity for r in rows) == 3_000_000_000
    assert sorted(map(str, long.collect())) == sorted(map(str, rows))


def test_quoted_line_breaks_stay_in_their_field(spark, tmp_path):
    write(tmp_path, "a.csv", 'title\nA,B\n1,"two\nlines, ""so"""\r\n2,5" x\n3,"",\n"open\n')
    out = files.sheet_rows(files.read_whole_texts(spark, str(tmp_path)), ["A", "B"]).collect()
    assert [(r.A, r.B) for r in out[:3]] == [("1", 'two\nlines, "so"'), ("2", '5" x'), ("3", None)]
    assert len(out) == 4
    lines = files.read_lines(spark, str(tmp_path))
    with pytest.raises(Exception, match="goes on in the next line"):
        files.long_sheet_rows(lines, ["A", "B"]).collect()


def test_headers_match_without_case_and_lacking_ones_are_an_error(spark, tmp_path):
    row = "15 May 23 G,1,1,1,1,1,1,1,1,3000000000,2,5,,08/05/2023"
    write(tmp_path, "in/a.csv", f"title\n{GRAIN_HEAD}\n{row}\n")
    markets = spark.createDataFrame(
        [("a.csv", "A", "1", "t")],
        "file_name string, market_name string, market_code string, market_type string",
    )
    for read in (grain.read_sheets, grain.read_long_sheets):
        rows = grain.clean(read(spark, str(tmp_path / "in"), markets)).collect()
        assert [(r.deals, r.contracts) for r in rows] == [(3_000_000_000, 2)]
    write(tmp_path, "bad/a.csv", "title\nContract Type,Bid\nx,1\n")
    for read in (grain.read_sheets, grain.read_long_sheets):
        with pytest.raises(Exception, match="lacks a column"):
            grain.clean(read(spark, str(tmp_path / "bad"), markets), False).collect()


def test_numbers_are_parsed_once(spark, tmp_path):
    write(tmp_path, "a.csv", "title\nA,B\n1,2\n")
    out = files.sheet_rows(files.read_whole_texts(spark, str(tmp_path)), ["A", "B"])
    plan = out.dropna()._jdf.queryExecution().optimizedPlan().toString()
    # the header, and in the generator the records: a lambda of each, or its alias
    assert plan.count("from_csv") <= 3


def loaded(spark, folder, name, checkpoint, day="day"):
    stream = incremental.new_files(
        spark, f"{folder}/in/*", "k bigint, n bigint, day date"
    )
    incremental.load_new_files(
        stream, f"{folder}/rows", f"{folder}/{checkpoint}", ["k", "day"], ["n"], day=day
    ).awaitTermination()
    return sorted(
        (r.k, r.n, str(r.day)) for r in spark.read.parquet(f"{folder}/rows").collect()
    )


@pytest.mark.parametrize("day", ["day", None])
def test_a_new_checkpoint_keeps_loaded_rows(spark, tmp_path, day):
    frame = lambda *rows: spark.createDataFrame(
        [(k, n, d and date.fromisoformat(d)) for k, n, d in rows], "k bigint, n bigint, day date"
    )
    first = [(1, 1, "2023-05-01"), (2, 1, None)]
    frame(*first).write.parquet(f"{tmp_path}/in/a")
    one = [(1, 1, "2023-05-01"), (2, 1, "None")]
    assert loaded(spark, tmp_path, "a", "c1", day) == one
    frame((1, 2, "2023-05-01"), (3, 2, "2021-01-01"), (2, 2, None)).write.parquet(f"{tmp_path}/in/b")
    two = sorted([*one, (3, 2, "2021-01-01")])
    assert loaded(spark, tmp_path, "b", "c1", day) == two
    frame((9, 3, "2024-01-01")).write.parquet(f"{tmp_path}/in/c")
    assert loaded(spark, tmp_path, "c", "c2", day) == sorted([*two, (9, 3, "2024-01-01")])


def test_finished_files_move_to_the_archive(spark, tmp_path):
    (tmp_path / "archive").mkdir()
    stream_in = tmp_path / "in"
    for name in ("a", "b"):
        spark.range(2).selectExpr("id k", "id n", "DATE '2023-05-01' day").coalesce(1).write.mode(
            "append"
        ).parquet(str(stream_in))
        stream = incremental.new_files(
            spark, str(stream_in), "k bigint, n bigint, day date", archive=str(tmp_path / "archive")
        )
        incremental.load_new_files(
            stream, f"{tmp_path}/rows", f"{tmp_path}/c", ["k"], ["n"]
        ).awaitTermination()
    moved = [p for p in (tmp_path / "archive").rglob("*.parquet")]
    assert moved  # at the latest the next run moves what the one before has read


def test_reads_by_date_skip_the_folders_of_other_years(spark, tmp_path):
    rows = spark.range(1000).select(
        "id", F.date_add(F.lit("2019-01-01"), F.col("id").cast("int")).alias("day")
    )
    sinks.write_table(rows, str(tmp_path / "t"), "day")
    df = spark.read.parquet(str(tmp_path / "t"))
    whole = {
        "trailing": filters.trailing(df, "day", "2021-08-01", 90),
        "since": filters.since(df, "day", "2021-08-01", 90),
        "period": filters.period(df, "day", "1m"),
    }
    pruned = {
        "trailing": filters.trailing(df, "day", "2021-08-01", 90, year="year"),
        "since": filters.since(df, "day", "2021-08-01", 90, year="year"),
        "period": filters.period(df, "day", "1m", year="year"),
    }
    for name, found in pruned.items():
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: []" not in plan.split("Subquery")[0], name
        assert sorted(r.id for r in found.collect()) == sorted(r.id for r in whole[name].collect())


def test_distinct_counts_copy_no_rows(spark):
    df = spark.createDataFrame(
        [(1, "a", None), (1, "b", None), (2, "b", None)], "x int, y string, z int"
    )
    counts = measures.distinct_counts(df, ["x", "y", "z"])
    assert tuple(counts.first()) == (2, 2, 0)
    assert tuple(measures.distinct_counts(df, ["x", "y", "z"], True).first()) == (2, 2, 1)
    assert "Expand" not in counts._jdf.queryExecution().optimizedPlan().toString()


def report(units):
    head = " ".join("h" * 1 for _ in range(13)) + " 2023/05/01 to 2023/05/07"
    return "\n".join([head, f"A2 {units} 270,50 61,10 63,20 62,00", "A3 5 1,0 1,0 1,0 1,0 1,0"])


def test_load_counts_losses_and_adds_nothing_twice(spark, tmp_path):
    texts = spark.createDataFrame(
        [("f1", report(10)), ("f2", report(20)), ("f3", f"none\n{'x' * 40} 1 1 1 1 1 1")],
        "file_path string, text string",
    )
    rows = livestock.cattle(livestock.report_rows(texts))
    first = load.load(rows, schemas.CATTLE, str(tmp_path / "t"), winner=[F.desc("units")])
    assert (first.rows, first.conflicts, first.added) == (5, 2, 2)
    assert first.lost["no_date_to"] == first.lost["no_date_from"] == first.lost["long_class"] == 1
    again = load.load(rows, schemas.CATTLE, str(tmp_path / "t"))
    assert again.added == 0
    found = {r["class"]: r for r in load.read(spark, str(tmp_path / "t")).collect()}
    assert found["A2"].units == 20 and found["A2"].was_null and not found["A3"].was_null


def test_the_catalog_query_leaves_real_tables_alone(spark, small):
    from pricemill.queries import QUERIES

    name = schemas.CATTLE.name
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    sinks.create_table(spark, schemas.CATTLE)
    before = spark.createDataFrame([("K", date(2023, 5, 1))], "class string, date_to date")
    typed = before.select(
        *[
            F.col(f.name) if f.name in before.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schemas.CATTLE.stored
        ]
    )
    sinks.load_table(typed, schemas.CATTLE)
    QUERIES["catalog_table"](spark, small).collect()
    assert [r["class"] for r in spark.table(name).collect()] == ["K"]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(f"{name}_")]
    spark.sql(f"DROP TABLE {name}")


def records(dice, n):
    odd = ["".join(dice.choices('ab",,"  \n\té', k=dice.randrange(14))) for _ in range(n)]
    fields = ["", "a", '""', '"x,y"', '"a""b"', " c ", '"\n"', '"\r\n"', '""""', 'x"', '"y" ']
    return odd + [",".join(dice.choices(fields, k=dice.randrange(1, 9))) for _ in range(n)]


def test_records_have_the_fields_that_the_csv_parser_finds(spark):
    lines = records(random.Random(8), 3000)
    frame = spark.createDataFrame([(x,) for x in lines], "r string")
    both = frame.select("r", files._fields(F.col("r")).alias("a"), files._parsed(F.col("r")).alias("b"))

    def even(values):
        values = [v or None for v in values]
        while values and values[-1] is None:
            values.pop()
        return values

    for row in both.collect():
        assert even(row.a) == even(row.b), row.r


def test_bad_sheets_stay_out_while_the_others_load(spark, tmp_path):
    row = "15 May 23 G,1,1,1,1,1,1,1,1,7,2,5,,08/05/2023"
    sheets = {
        "good.csv": f"title\n{GRAIN_HEAD}\n{row}\n",
        "lacks.csv": f"title\n{GRAIN_HEAD.replace('Bid', 'Bit')}\n{row}\n",
        "wide.csv": f"title\n{GRAIN_HEAD}{',x' * 40}\n{row}\n",
        "empty.csv": " \n",
        "bare.csv": f"title\n{GRAIN_HEAD}\n,,,\n",
        "headless.csv": "title\n",
    }
    for name, text in sheets.items():
        write(tmp_path, name, text)
    markets = spark.createDataFrame(
        [(name, "A", "1", "t") for name in sheets],
        "file_name string, market_name string, market_code string, market_type string",
    )
    rows = grain.read_sheets(spark, str(tmp_path), markets, skip_bad=True)
    assert [r.deals for r in grain.clean(rows).collect()] == [7]
    faults = {r.file_path.rsplit("/", 1)[1]: r.fault for r in grain.sheet_faults(spark, str(tmp_path)).collect()}
    assert faults == {
        "lacks.csv": "the sheet lacks a column: Bid",
        "wide.csv": "the sheet is too wide",
        "empty.csv": "the sheet is empty",
        "bare.csv": "the sheet has no rows",
        "headless.csv": "the sheet has no header",
    }
    lines = files.read_lines(spark, str(tmp_path))
    long = files.long_sheet_rows(
        lines, grain.SHEET_COLUMNS, required=grain.SHEET_COLUMNS, skip_bad=True
    )
    assert [r.Deals for r in long.collect()] == ["7"]
    with pytest.raises(Exception, match="the sheet (lacks|is too wide)"):
        grain.read_sheets(spark, str(tmp_path), markets).collect()


def test_keys_are_found_without_a_shuffle_of_the_table(spark, tmp_path):
    name, keys_ = "some_keys", ["k", "day"]
    frame = lambda *rows: spark.createDataFrame(list(rows), "k bigint, day date, x int")
    day = date(2023, 5, 1)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert keys.in_step(spark, name, None) and not keys.in_step(spark, name, frame())
        first = frame((1, day, 1), (None, day, 1), (2, None, 1))
        keys.write_keys(first, name, keys_, buckets=4, location=str(tmp_path / "keys"))
        keys.write_keys(frame((3, day, 1)), name, keys_, buckets=4)
        assert keys.in_step(spark, name, frame(*[(k, day, 1) for k in range(4)]))
        new = keys.without_known(
            frame((1, day, 2), (None, day, 2), (2, None, 2), (2, day, 2), (None, None, 2)), name, keys_
        )
        assert sorted((r.k, r.day) for r in new.collect() if r.k) == [(2, day)] and new.count() == 2
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_key_table_that_missed_a_load_is_made_anew(spark, tmp_path):
    name, path = "cattle_keys", str(tmp_path / "t")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    texts = lambda *n: spark.createDataFrame(
        [(f"f{k}", report(10).replace("2023/05/01", f"2023/05/0{k}")) for k in n],
        "file_path string, text string",
    )
    rows = lambda *n: livestock.cattle(livestock.report_rows(texts(*n)))
    try:
        assert load.load(rows(1), schemas.CATTLE, path, key_table=name).added == 2
        assert load.load(rows(2), schemas.CATTLE, path).added == 2  # without its keys
        assert load.load(rows(1, 2, 3), schemas.CATTLE, path, key_table=name).added == 2
        assert load.load(rows(1, 2, 3), schemas.CATTLE, path, key_table=name).added == 0
        assert load.read(spark, path).count() == 6 and spark.table(name).count() == 6
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
