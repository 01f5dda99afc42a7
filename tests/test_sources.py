"""Readers, writers and the incremental load on files in a temporary folder."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemill import schemas
from pricemill.operators import ordered, quality
from pricemill.sinks import tables as sinks
from pricemill.sources import files, generated, pages, reports, tables
from pricemill.streaming import incremental


def write(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8", newline="")
    return path


def test_csv_scans(spark, tmp_path):
    write(tmp_path, "a.csv", "Name,N\nx,1\ny,two\n")
    text = files.read_text_csv(spark, str(tmp_path))
    assert text.dtypes == [("Name", "string"), ("N", "string")]
    schema = T.StructType([T.StructField("Name", T.StringType()), T.StructField("N", T.IntegerType())])
    typed = {r.Name: (r.N, r[files.BAD_RECORD]) for r in files.read_csv(spark, str(tmp_path), schema, True).collect()}
    assert typed == {"x": (1, None), "y": (None, "y,two")}


def test_sheets_match_columns_by_name(spark, tmp_path):
    write(tmp_path, "a.csv", 'title\nA,B\n1,"2,5"\n\n3,4\n"say ""a"", b",5" x,left over\n"",\n')
    write(tmp_path, "b.csv", "title, with comma\r\nB,C,A\r\nx,y,z\r\n")
    write(tmp_path, "c.csv", "title\nA,B\n")
    write(tmp_path, "d.csv", "")
    texts = files.read_whole_texts(spark, str(tmp_path))
    out = files.file_name(files.sheet_rows(texts, ["A", "B", "C"]))
    assert sorted((r.file_name, r.line_no, r.A, r.B, r.C) for r in out.collect()) == [
        ("a.csv", 2, "1", "2,5", None),
        ("a.csv", 4, "3", "4", None),
        ("a.csv", 5, 'say "a", b', '5" x', None),
        ("b.csv", 2, "z", "x", "y"),
    ]
    counts = quality.rows_per_file(files.file_name(out), "file_name").collect()
    assert {r.file_name: r.rows for r in counts} == {"a.csv": 3, "b.csv": 1}


def test_suffix_and_exclude(spark, tmp_path):
    for name in ("w1.txt", "w 2+.txt", "w3.log"):
        write(tmp_path, name, "x")
    out = files.read_whole_texts(spark, str(tmp_path), ".txt", exclude=["w 2+.txt"])
    assert [r.file_name for r in files.file_name(out).collect()] == ["w1.txt"]


def test_market_of_path(spark):
    df = spark.createDataFrame(
        [("file:/r/North%20Gate_N1_fresh/x.csv",), ("file:/r/Old_Town_T2_dry+raw/x.csv",), ("file:/r/plain/x.csv",)],
        "file_path string",
    )
    out = files.market_of_path(df).collect()
    assert [(r.market_name, r.market_code, r.market_type) for r in out] == [
        ("North Gate", "N1", "fresh"),
        ("Old_Town", "T2", "dry+raw"),
        ("", "", ""),
    ]


def test_long_files_are_read_in_splits(spark, tmp_path):
    # Headers every 97 lines; the same answer whether or not the file is cut in splits.
    lines = [f"D{i}" if i % 97 == 0 else f"r{i}" for i in range(5000)]
    write(tmp_path, "long.txt", "\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = files.read_lines(spark, str(tmp_path))
        assert df.select("block").distinct().count() > 3
        out = ordered.sections(
            df, ["file_path"], ["block", "line_id"], F.col("line").startswith("D"), "line", "d", 400
        )
        got = {r.line: r.d for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {f"r{i}": f"D{i - i % 97}" for i in range(5000) if i % 97}


def test_report_lines_and_sections(spark):
    texts = spark.createDataFrame([("f", "h0 h1\na b c\n\nx\n")], "file_path string, text string")
    out = reports.report_lines(texts, header={"day": F.get("head", 1)}).orderBy("pos").collect()
    assert [(r.pos, r.line, r.words, r.day) for r in out] == [
        (0, "h0 h1", ["h0", "h1"], "h1"),
        (1, "a b c", ["a", "b", "c"], "h1"),
        (2, "", [], "h1"),
        (3, "x", ["x"], "h1"),
        (4, "", [], "h1"),
    ]
    at = spark.range(8).withColumnRenamed("id", "pos")
    got = at.select(
        reports.line_section("pos", {"a": (1, 2), "b": (4, None)}).alias("s"),
        reports.block_of("pos", 4, 2, ["x", "y"]).alias("w"),
    ).collect()
    assert [r.s for r in got] == [None, "a", "a", None, "b", "b", "b", "b"]
    assert [r.w for r in got] == [None, None, None, None, "x", "x", "y", "y"]


PAGE = (
    '<a class="x" href="/1">Get</a><a href="/2"> Get </a><A HREF="/3">Other</A><a href="/4">Get</a>'
    "<select><option>all</option><option value='1'>apples</option><option>pears</option></select>"
)


def test_pages(spark):
    df = spark.createDataFrame([(1, PAGE), (2, "NO PRICES TODAY"), (3, "")], "page_id int, html string")
    assert pages.without_notice(df, "NO PRICES").count() == 2
    links = pages.page_links(df, text="Get", first=2).collect()
    assert [(r.page_id, r.pos, r.href) for r in links] == [(1, 0, "/1"), (1, 1, "/2")]
    assert pages.page_links(df).count() == 4
    options = pages.select_options(df)
    assert [(r.pos, r.option) for r in options.collect()] == [(1, "apples"), (2, "pears")]
    loaded = spark.createDataFrame([(1, "pears")], "page_id int, option string")
    assert [tuple(r) for r in pages.work_list(options, loaded, ["page_id", "option"]).collect()] == [(1, "apples")]


def test_random_integers(spark):
    values = [r.value for r in generated.random_integers(spark, 100, 0, 1, seed=7).collect()]
    assert len(values) == 100
    assert set(values) == {0, 1}


def test_snapshot_round_trip(spark, rows, tmp_path):
    df = rows("k string, x double, d date", ("a,b", 0.1, None), ('q"', None, None))
    for _ in range(2):
        path = sinks.write_snapshot(df, str(tmp_path), "2023-05-09")
    back = files.read_processed(spark, path, df.schema, "csv")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert path.endswith("snapshot_date=2023-05-09")


def test_catalog_tables(spark, rows, tmp_path):
    spark.sql("DROP TABLE IF EXISTS livestock_cattle_prices")
    sinks.create_table(spark, schemas.CATTLE, str(tmp_path / "cattle"))
    sinks.create_table(spark, schemas.CATTLE, str(tmp_path / "cattle"))
    one = rows("class string, units int, date_from date", ("A2", 5, None)).select(
        "class", "units", F.lit(1.0).alias("avg_mass"), F.lit(1.0).alias("avg_purch"),
        F.lit(1.0).alias("avg_selling"), F.lit(1.0).alias("selling_min"), F.lit(1.0).alias("selling_max"),
        F.lit("2023-05-01").cast("date").alias("date_from"), F.lit("2023-05-07").cast("date").alias("date_to"),
    )
    sinks.load_table(one, schemas.CATTLE)
    sinks.load_table(one, schemas.CATTLE)
    assert tables.read_table(spark, "livestock_cattle_prices").count() == 2
    sinks.load_table(one, schemas.CATTLE, mode="overwrite")
    out = tables.read_table(spark, "livestock_cattle_prices").collect()
    assert [(r["class"], r.year) for r in out] == [("A2", 2023)]
    spark.sql("DROP TABLE livestock_cattle_prices")


def test_staged_run_replaces_itself(spark, rows, tmp_path):
    df = rows("x int", (1,), (2,))
    for _ in range(2):
        sinks.stage(df, str(tmp_path), "grain", "r1")
    sinks.stage(df, str(tmp_path), "grain", "r2")
    assert spark.read.parquet(str(tmp_path)).count() == 4


def test_incremental_load_is_safe_to_repeat(spark, rows, tmp_path):
    inbox, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = "class string, week int, x int"

    def arrive(*data):
        rows(schema, *data).coalesce(1).write.mode("append").parquet(inbox)

    def load():
        stream = incremental.new_files(spark, inbox, rows(schema, ("a", 1, 1)).schema)
        incremental.load_new_files(
            stream, out, mark, ["class", "week"], ["x"],
            clean=lambda df: df.filter("x > 0"), day="week",
        ).awaitTermination()
        return sorted((r["class"], r.week, r.x) for r in spark.read.parquet(out).collect())

    arrive(("a", 1, 5), ("a", 1, 7), ("b", 1, 0))
    assert load() == [("a", 1, 7)]
    assert load() == [("a", 1, 7)]
    # The window overlaps: a known key does not change, new keys come in.
    arrive(("a", 1, 9), ("a", 2, 1), ("b", 1, 3))
    assert load() == [("a", 1, 7), ("a", 2, 1), ("b", 1, 3)]
    # A batch that runs again leaves the same rows.
    again = incremental.append_batch(out, ["class", "week"], ["x"])
    again(rows(schema, ("a", 1, 9), ("a", 2, 1), ("b", 1, 3)), 1)
    assert spark.read.parquet(out).count() == 3
