"""The commodity tables as views of a star schema.

The price tables themselves are not part of the test data, so the questions run on whole
``lineitem``, ``part``, ``orders`` and ``customer`` tables seen as grain, horticulture and
livestock records. Raw text forms (contract names, coded products) are built first, so that the
same parsing runs as on real reports.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricemill.functions import text
from pricemill.plans import grain as grain_plan


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Rows of a table that become reports in one task.
REPORTS_A_TASK = 25_000


def dealt_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table whose rows become reports, which are many times larger: in tasks of some rows each.

    A scan is cut by the bytes and row groups of the table, so a few MB of it, and all the reports
    that they become, would be one task. The count comes from the files' footers; rows are dealt out
    in turn, so keys that are NULL or repeat don't matter.
    """
    rows = table(spark, folder, name)
    tasks = -(-rows.count() // REPORTS_A_TASK)
    return rows.repartition(max(tasks, spark.sparkContext.defaultParallelism))


def grain(spark: SparkSession, folder: str) -> DataFrame:
    """``lineitem`` as grain contracts: monthly uploads, twelve contract months each."""
    lines = table(spark, folder, "lineitem")
    settles = F.trunc(
        F.date_add(F.col("l_shipdate").cast("date"), (F.col("l_quantity") % 12 * 30).cast("int")),
        "month",
    )
    raw = lines.select(
        F.concat(F.date_format(settles, "d MMM yy"), F.lit(" "), F.col("l_returnflag")).alias(
            "contract_type"
        ),
        F.trunc(F.col("l_shipdate").cast("date"), "month").alias("upload_date"),
        F.col("l_extendedprice").alias("last"),
        F.col("l_quantity").alias("bid"),
        F.col("l_suppkey").alias("deals"),
        F.col("l_linestatus").alias("market_name"),
        F.col("l_linenumber").cast("string").alias("market_code"),
    )
    return grain_plan.with_contract(raw)


GRAIN_SQL = """
WITH grain AS (
  SELECT strftime(d, '%-d %b %y ') || l_returnflag AS contract_type,
         l_returnflag AS grain_type,
         make_date(2000 + year(d) % 100, month(d), day(d)) AS contract_date,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS upload_date,
         l_extendedprice AS last, l_quantity AS bid, l_suppkey AS deals,
         l_linestatus || ' ' || CAST(l_linenumber AS VARCHAR) AS market
  FROM (SELECT *, CAST(date_trunc('month', CAST(l_shipdate AS DATE)
               + CAST(l_quantity % 12 * 30 AS INTEGER)) AS DATE) AS d FROM lineitem))
"""


def horticulture(spark: SparkSession, folder: str) -> DataFrame:
    """``lineitem`` and ``part`` as market prices of products."""
    parts = table(spark, folder, "part").select(
        "p_partkey",
        text.product_name(F.concat(F.col("p_partkey"), F.lit(". "), F.col("p_name"))).alias(
            "product"
        ),
        F.col("p_brand").alias("variety"),
        F.col("p_type").alias("class"),
        F.col("p_size").cast("string").alias("size"),
        F.col("p_retailprice").alias("average_price"),
    )
    sales = table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"),
        F.col("l_linestatus").alias("package"),
        F.when(F.col("l_discount") == 0, F.lit(0.0))
        .otherwise(F.col("l_extendedprice"))
        .alias("closing_price"),
        F.col("l_quantity").cast("int").alias("sales_quantity"),
        F.col("l_linenumber").alias("closing_stock"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.concat(F.lit("Market "), F.col("l_suppkey")).alias("market_name"),
        F.col("l_suppkey").cast("string").alias("market_code"),
        F.col("l_returnflag").alias("market_type"),
    )
    return sales.join(parts, "p_partkey").drop("p_partkey")


HORTICULTURE_SQL = """
WITH horticulture AS (
  SELECT p_name AS product, p_brand AS variety, p_type AS class,
         CAST(p_size AS VARCHAR) AS size, l_linestatus AS package,
         CASE WHEN l_discount = 0 THEN 0.0 ELSE l_extendedprice END AS closing_price,
         p_retailprice AS average_price, CAST(l_quantity AS INTEGER) AS sales_quantity,
         l_linenumber AS closing_stock, CAST(l_shipdate AS DATE) AS date,
         'Market ' || CAST(l_suppkey AS VARCHAR) AS market_name,
         CAST(l_suppkey AS VARCHAR) AS market_code, l_returnflag AS market_type
  FROM lineitem JOIN part ON l_partkey = p_partkey)
"""


def livestock(spark: SparkSession, folder: str) -> DataFrame:
    """``orders`` and ``customer`` as class reports with weight bands and markets."""
    buyers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.col("c_acctbal").alias("avg_mass"),
        F.col("c_mktsegment").alias("market"),
    )
    reports = table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("class"),
        F.col("o_custkey").alias("units"),
        "o_custkey",
        F.col("o_totalprice").alias("avg_purch"),
        F.col("o_orderkey").alias("avg_selling"),
        F.col("o_orderdate").cast("date").alias("date_to"),
        F.col("o_orderstatus").alias("weight"),
    )
    return reports.join(buyers, "o_custkey").drop("o_custkey")


LIVESTOCK_SQL = """
WITH livestock AS (
  SELECT o_orderpriority AS class, o_custkey AS units, c_acctbal AS avg_mass,
         o_totalprice AS avg_purch, o_orderkey AS avg_selling,
         CAST(o_orderdate AS DATE) AS date_to, o_orderstatus AS weight,
         c_mktsegment AS market
  FROM orders JOIN customer ON o_custkey = c_custkey)
"""
