"""Work that grows with the tables is dealt out, and generated code stays small enough to be compiled."""

import contextlib
import datetime
import io
import re

import pytest
from pyspark.sql import functions as F

from pricemill import queries, schemas
from pricemill.functions import numbers
from pricemill.plans import load, standins

DAY = datetime.datetime(2023, 5, 8)


@pytest.fixture
def folder(rows, tmp_path, monkeypatch):
    """Small tables of one file and row group; five rows of them are to make a task's reports."""
    monkeypatch.setattr(standins, "REPORTS_A_TASK", 5, raising=False)
    n = 100
    tables = {
        "customer": rows(
            "c_custkey long, c_acctbal double",
            *[(k, k / 4) for k in range(n - 2)], (None, 1.5), (3, None),
        ),
        "part": rows(
            "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
            *[(k, f"name {k}", "B", "T", 7, 2.5) for k in range(n - 1)], (5, "name 5", "B", "T", 7, 2.5),
        ),
        "orders": rows(
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
            "o_orderdate timestamp_ntz, o_orderpriority string",
            *[(k, k, "OF"[k % 2], 1234.5, DAY, "1-URGENT") for k in range(n)],
        ),
    }
    for name, table in tables.items():
        table.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize(
    ("make", "count"),
    [
        (queries._reports, 47 * 100),
        (queries._horticulture_rows, 4 * 100),
        (queries._grain_rows, 100),
        (queries._mixed_sheets, 100),
    ],
)
def test_reports_are_made_in_many_tasks(spark, folder, make, count):
    made = make(spark, folder)
    assert made.rdd.getNumPartitions() == 20
    assert made.count() == count


def test_streamed_sheets_do_not_grow_with_the_table(spark, folder):
    path = queries._sheet_loads(spark, folder, broken=False).removesuffix("/rows")
    lines = spark.read.text(f"{path}/in/second/*").withColumn("file", F.input_file_name())
    sizes = [r["count"] for r in lines.groupBy("file").count().collect()]
    assert max(sizes) <= 5 + 2
    assert sum(sizes) == 100 + 2 * len(sizes)


@pytest.mark.parametrize(
    ("make", "table"),
    [
        (queries._grain_rows, schemas.GRAIN),
        (queries._horticulture_rows, schemas.HORTICULTURE),
    ],
)
def test_generated_code_is_compiled(spark, folder, make, table):
    """The JVM only interprets methods of more than 8000 bytes."""
    typed = make(spark, folder).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.stored]
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with contextlib.redirect_stdout(io.StringIO()) as out:
            typed.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]
    assert sizes and max(sizes) < 8000


def test_numbers_with_any_white_space(spark):
    texts = ["5", " 5\t", "\xa05 ", "\x1f5.5 ", "\xa0\x005", " ", "", "x", "NaN", "\xa0nan", None,
             "9223372036854775807", "99999999999999999999", "\x85-7　", "1e3"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(
        numbers.plain_number("t"), numbers.plain_number("t", "int"), numbers.plain_number("t", "bigint")
    ).collect()
    big = float(2**63)
    assert [tuple(r) for r in got] == [
        (5.0, 5, 5), (5.0, 5, 5), (5.0, 5, 5), (5.5, 5, 5), (5.0, 5, 5), (None,) * 3, (None,) * 3,
        (None,) * 3, (None,) * 3, (None,) * 3, (None,) * 3, (big, None, 2**63 - 1), (1e20, None, None),
        (-7.0, -7, -7), (1000.0, 1000, 1000),
    ]
