"""Every operator as a query over the whole test tables, next to the same question in SQL.

Averages and ratios are rounded to four places on both sides. Dates of the questions
(``as_of``) are fixed per query.
"""

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemill import schemas
from pricemill.functions import dates, numbers, text
from pricemill.operators import filters, measures, ordered, quality, shape
from pricemill.plans import grain, horticulture, livestock, load, standins
from pricemill.plans.standins import (
    GRAIN_SQL,
    HORTICULTURE_SQL,
    LIVESTOCK_SQL,
    dealt_table,
    table,
)
from pricemill.schemas import CATTLE
from pricemill.session import run_folder
from pricemill.sinks import tables as sinks
from pricemill.sinks import versions
from pricemill.sources import files, pages, reports
from pricemill.sources.tables import read_table
from pricemill.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql.strip()
        return run

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def known(column: str, missing_value: object) -> Column:
    """A column with one of its values taken as missing, for the NULL rules."""
    return F.nullif(F.col(column), F.lit(missing_value))


# --- counts, shares, profiles -------------------------------------------------------------


@query(
    "daily_avg_unpivot",
    """
SELECT CAST(ts AS DATE) AS day, 'avg_value' AS series, round(avg(value), 4) AS v
FROM events WHERE ts > DATE '2024-01-31' - INTERVAL 365 DAY GROUP BY 1
UNION ALL
SELECT CAST(ts AS DATE), 'max_value', round(max(value), 4)
FROM events WHERE ts > DATE '2024-01-31' - INTERVAL 365 DAY GROUP BY 1
""",
)
def daily_avg_unpivot(spark: SparkSession, folder: str) -> DataFrame:
    recent = filters.trailing(table(spark, folder, "events"), "ts", "2024-01-31", 365)
    daily = recent.groupBy(F.col("ts").cast("date").alias("day")).agg(
        F.avg("value").alias("avg_value"), F.max("value").alias("max_value")
    )
    return rounded(
        shape.series(daily, ["day"], ["avg_value", "max_value"], value_column="v"), "v"
    )


@query(
    "group_count",
    "SELECT p_type, count(*) AS n FROM part WHERE p_type IS NOT NULL GROUP BY p_type",
)
def group_count(spark: SparkSession, folder: str) -> DataFrame:
    return measures.group_count(table(spark, folder, "part"), "p_type")


@query(
    "value_counts_share",
    """
SELECT event_type, count(*) AS n,
       round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (), 4) AS share
FROM events GROUP BY event_type
""",
)
def value_counts_share(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(measures.value_counts(table(spark, folder, "events"), "event_type"), "share")


@query(
    "facet_options",
    "SELECT DISTINCT p_size FROM part WHERE p_type = 'ECONOMY' AND p_brand = 'Brand#2'",
)
def facet_options(spark: SparkSession, folder: str) -> DataFrame:
    return measures.facet_options(
        table(spark, folder, "part"),
        ["p_type", "p_brand", "p_size"],
        {"p_type": "ECONOMY", "p_brand": "Brand#2"},
    )


@query(
    "distinct_counts",
    """
SELECT count(DISTINCT p_name) AS p_name, count(DISTINCT p_brand) AS p_brand,
       count(DISTINCT p_type) AS p_type, count(DISTINCT p_size) AS p_size FROM part
""",
)
def distinct_counts(spark: SparkSession, folder: str) -> DataFrame:
    return measures.distinct_counts(
        table(spark, folder, "part"), ["p_name", "p_brand", "p_type", "p_size"]
    )


@query(
    "distinct_with_null",
    """
SELECT count(DISTINCT nullif(l_discount, 0))
       + max(CASE WHEN nullif(l_discount, 0) IS NULL THEN 1 ELSE 0 END) AS l_discount
FROM lineitem
""",
)
def distinct_with_null(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(known("l_discount", 0.0).alias("l_discount"))
    return measures.distinct_counts(lines, ["l_discount"], null_is_value=True)


@query(
    "null_counts",
    """
SELECT count(CASE WHEN nullif(l_discount, 0) IS NULL THEN 1 END) AS l_discount,
       count(CASE WHEN l_tax IS NULL THEN 1 END) AS l_tax FROM lineitem
""",
)
def null_counts(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        known("l_discount", 0.0).alias("l_discount"), "l_tax"
    )
    return measures.null_counts(lines)


@query(
    "table_profile",
    """
SELECT column_name, lower(replace(replace(dtype, 'VARCHAR', 'string'), 'INTEGER', 'int')) AS dtype,
       rows, non_null
FROM (
  SELECT 'c_custkey' AS column_name, any_value(typeof(c_custkey)) AS dtype, count(*) AS rows,
         count(c_custkey) AS non_null FROM customer
  UNION ALL SELECT 'c_name', any_value(typeof(c_name)), count(*), count(c_name) FROM customer
  UNION ALL SELECT 'c_nationkey', any_value(typeof(c_nationkey)), count(*), count(c_nationkey)
            FROM customer
  UNION ALL SELECT 'c_acctbal', any_value(typeof(c_acctbal)), count(*), count(c_acctbal)
            FROM customer
  UNION ALL SELECT 'c_mktsegment', any_value(typeof(c_mktsegment)), count(*), count(c_mktsegment)
            FROM customer)
""",
)
def table_profile(spark: SparkSession, folder: str) -> DataFrame:
    return measures.table_profile(table(spark, folder, "customer"))


@query(
    "kpis",
    """
SELECT round(avg(l_extendedprice), 0) AS avg_last, max(l_extendedprice) AS max_bid,
       CAST(sum(l_quantity) AS BIGINT) AS stock
FROM lineitem WHERE l_returnflag = 'A'
""",
)
def kpis(spark: SparkSession, folder: str) -> DataFrame:
    picked = filters.equal_to(table(spark, folder, "lineitem"), {"l_returnflag": "A"})
    return measures.headline(
        picked,
        mean={"l_extendedprice": "avg_last"},
        highest={"l_extendedprice": "max_bid"},
        total={"l_quantity": "stock"},
    ).withColumn("stock", F.col("stock").cast("bigint"))


@query(
    "price_range_label",
    """
SELECT o_orderstatus, min(o_totalprice) AS min_price, max(o_totalprice) AS max_price,
       strftime(min(o_orderdate), '%B %d, %Y') AS min_date,
       strftime(max(o_orderdate), '%B %d, %Y') AS max_date
FROM orders GROUP BY 1
""",
)
def price_range_label(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return measures.price_range(orders, ["o_orderstatus"], "o_totalprice", "o_orderdate")


@query(
    "row_at_extreme",
    """
SELECT n_regionkey, arg_max(n_name, n_nationkey) AS n_name FROM nation GROUP BY 1
""",
)
def row_at_extreme(spark: SparkSession, folder: str) -> DataFrame:
    return measures.at_extreme(
        table(spark, folder, "nation"), ["n_regionkey"], "n_nationkey", "n_name"
    )


@query(
    "segment_share",
    """
SELECT l_returnflag, l_linestatus, l_suppkey, sum(l_quantity) AS deals,
       round(sum(l_quantity) / sum(sum(l_quantity))
             OVER (PARTITION BY l_returnflag, l_linestatus), 4) AS share
FROM lineitem GROUP BY 1, 2, 3
""",
)
def segment_share(spark: SparkSession, folder: str) -> DataFrame:
    shares = measures.segment_share(
        table(spark, folder, "lineitem").withColumnRenamed("l_quantity", "deals"),
        ["l_returnflag", "l_linestatus", "l_suppkey"],
        ["l_returnflag", "l_linestatus"],
        "deals",
    )
    return rounded(shares.drop("segment_total"), "share")


# --- filters ------------------------------------------------------------------------------


@query(
    "trailing_window",
    """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderdate > DATE '2001-08-01' - INTERVAL 365 DAY
""",
)
def trailing_window(spark: SparkSession, folder: str) -> DataFrame:
    recent = filters.trailing(table(spark, folder, "orders"), "o_orderdate", "2001-08-01")
    return recent.select("o_orderkey", "o_totalprice")


@query(
    "load_window",
    """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderdate >= DATE '2001-08-01' - INTERVAL 90 DAY
""",
)
def load_window(spark: SparkSession, folder: str) -> DataFrame:
    window = filters.since(table(spark, folder, "orders"), "o_orderdate", "2001-08-01", 90)
    return window.select("o_orderkey", "o_totalprice")


@query(
    "open_contract_avg",
    """
SELECT CAST(l_shipdate AS DATE) AS contract_date, round(avg(l_extendedprice), 4) AS avg_last,
       round(avg(l_quantity), 4) AS avg_bid
FROM lineitem WHERE l_shipdate > DATE '2001-01-01' GROUP BY 1
""",
)
def open_contract_avg(spark: SparkSession, folder: str) -> DataFrame:
    unsettled = filters.still_open(table(spark, folder, "lineitem"), "l_shipdate", "2001-01-01")
    means = measures.average_by(
        unsettled.withColumn("contract_date", F.col("l_shipdate").cast("date")),
        ["contract_date"],
        {"l_extendedprice": "avg_last", "l_quantity": "avg_bid"},
    )
    return rounded(means, "avg_last", "avg_bid")


@query(
    "year_back_and_key",
    """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_shipdate > DATE '2001-08-01' - INTERVAL 365 DAY AND l_linenumber = 3
""",
)
def year_back_and_key(spark: SparkSession, folder: str) -> DataFrame:
    picked = filters.year_back_for(
        table(spark, folder, "lineitem"), "l_shipdate", "2001-08-01", {"l_linenumber": 3}
    )
    return picked.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "pair_compare",
    """
SELECT o_orderdate, o_orderkey, o_orderpriority, o_totalprice FROM orders
WHERE o_orderpriority IN ('1-URGENT', '5-LOW')
""",
)
def pair_compare(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    pair = filters.one_of(orders, "o_orderpriority", "1-URGENT", "5-LOW")
    return pair.select("o_orderdate", "o_orderkey", "o_orderpriority", "o_totalprice").orderBy(
        "o_orderdate", "o_orderkey"
    )


@query(
    "leaf_series",
    """
SELECT l_shipdate, l_extendedprice, l_quantity FROM lineitem
WHERE l_returnflag = 'A' AND l_linestatus = 'F' AND l_linenumber = 1 AND l_discount <> 0
""",
)
def leaf_series(spark: SparkSession, folder: str) -> DataFrame:
    lines = filters.not_zero_keep_null(table(spark, folder, "lineitem"), "l_discount")
    leaf = filters.equal_to(
        lines, {"l_returnflag": "A", "l_linestatus": "F", "l_linenumber": 1}
    )
    return leaf.select("l_shipdate", "l_extendedprice", "l_quantity").orderBy("l_shipdate")


@query(
    "exclude_zero_keep_null",
    """
SELECT l_orderkey, l_linenumber, nullif(l_tax, 0.08) AS t FROM lineitem
WHERE nullif(l_tax, 0.08) IS DISTINCT FROM 0
""",
)
def exclude_zero_keep_null(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", known("l_tax", 0.08).alias("t")
    )
    return filters.not_zero_keep_null(lines, "t")


@query(
    "nonzero_filter",
    """
SELECT l_orderkey, l_linenumber, nullif(l_tax, 0.08) AS t FROM lineitem
WHERE nullif(l_tax, 0.08) <> 0
""",
)
def nonzero_filter(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", known("l_tax", 0.08).alias("t")
    )
    return filters.not_zero(lines, "t")


@query(
    "text_contains",
    """
SELECT doc_id, source FROM documents
WHERE contains(lower(text), 'license') OR contains(lower(source), 'web')
""",
)
def text_contains(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = text.contains_text("text", "LICENSE") | text.contains_text("source", "Web")
    return docs.filter(found).select("doc_id", "source")


@query(
    "mask_negated",
    """
SELECT event_id, event_type FROM events WHERE event_type IS DISTINCT FROM 'signup'
""",
)
def mask_negated(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "event_type")
    return filters.without(events, F.col("event_type") == "signup")


def _gappy(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with zero discounts and taxes, and quantity 1, taken as missing."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        known("l_discount", 0.0).alias("discount"),
        known("l_tax", 0.0).alias("tax"),
        known("l_quantity", 1.0).alias("quantity"),
    )


@query(
    "drop_null_any",
    """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE nullif(l_discount, 0) IS NOT NULL AND nullif(l_tax, 0) IS NOT NULL
""",
)
def drop_null_any(spark: SparkSession, folder: str) -> DataFrame:
    lines = _gappy(spark, folder).drop("quantity")
    return filters.complete(lines).select("l_orderkey", "l_linenumber")


@query(
    "drop_null_subset",
    """
SELECT l_orderkey, l_linenumber, nullif(l_tax, 0) AS tax FROM lineitem
WHERE nullif(l_discount, 0) IS NOT NULL
""",
)
def drop_null_subset(spark: SparkSession, folder: str) -> DataFrame:
    lines = filters.complete(_gappy(spark, folder), ["discount"])
    return lines.select("l_orderkey", "l_linenumber", "tax")


@query(
    "drop_null_all",
    """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE NOT (nullif(l_discount, 0) IS NULL AND nullif(l_tax, 0) IS NULL)
""",
)
def drop_null_all(spark: SparkSession, folder: str) -> DataFrame:
    lines = filters.not_blank(_gappy(spark, folder), ["discount", "tax"])
    return lines.select("l_orderkey", "l_linenumber")


@query(
    "drop_null_threshold",
    """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE (nullif(l_discount, 0) IS NULL)::INT + (nullif(l_tax, 0) IS NULL)::INT
      + (nullif(l_quantity, 1) IS NULL)::INT <= 1
""",
)
def drop_null_threshold(spark: SparkSession, folder: str) -> DataFrame:
    lines = filters.max_nulls(_gappy(spark, folder), 1, ["discount", "tax", "quantity"])
    return lines.select("l_orderkey", "l_linenumber")


@query(
    "drop_null_exact",
    """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE (nullif(l_discount, 0) IS NULL)::INT + (nullif(l_tax, 0) IS NULL)::INT
      + (nullif(l_quantity, 1) IS NULL)::INT <> 2
""",
)
def drop_null_exact(spark: SparkSession, folder: str) -> DataFrame:
    lines = filters.null_count_not(_gappy(spark, folder), 2, ["discount", "tax", "quantity"])
    return lines.select("l_orderkey", "l_linenumber")


@query(
    "period_presets",
    """
SELECT count(*) FILTER (WHERE o_orderdate >= m - INTERVAL 1 MONTH) AS m1,
       count(*) FILTER (WHERE o_orderdate >= m - INTERVAL 6 MONTH) AS m6,
       count(*) FILTER (WHERE o_orderdate >= date_trunc('year', m)) AS ytd,
       count(*) FILTER (WHERE o_orderdate >= m - INTERVAL 1 YEAR) AS y1,
       count(*) AS all_rows
FROM orders, (SELECT max(o_orderdate) AS m FROM orders)
""",
)
def period_presets(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    newest = orders.agg(F.max("o_orderdate").cast("date").alias("newest")).scalar()

    def rows(preset: str, name: str) -> Column:
        return F.count_if(F.col("o_orderdate") >= filters.period_start(newest, preset)).alias(name)

    return orders.agg(
        rows("1m", "m1"),
        rows("6m", "m6"),
        rows("ytd", "ytd"),
        rows("1y", "y1"),
        F.count(F.lit(1)).alias("all_rows"),
    )


@query(
    "period_filter",
    """
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 6 MONTH
""",
)
def period_filter(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return filters.period(orders, "o_orderdate", "6m")


# --- ordered logic ------------------------------------------------------------------------


@query(
    "section_fill_forward",
    """
SELECT event_id, user_id, section FROM (
  SELECT event_id, user_id, event_type,
         last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS)
           OVER (PARTITION BY user_id ORDER BY ts, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section
  FROM events)
WHERE event_type <> 'signup'
""",
)
def section_fill_forward(spark: SparkSession, folder: str) -> DataFrame:
    return ordered.sections(
        table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type"),
        ["user_id"],
        ["ts", "event_id"],
        F.col("event_type") == "signup",
        "event_id",
        "section",
        rows_per_span=20,  # users with more rows are cut, as hot ones are
    ).select("event_id", "user_id", "section")


@query(
    "drop_repeats",
    """
SELECT event_id, user_id, event_type FROM (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev
  FROM events)
WHERE prev IS DISTINCT FROM event_type
""",
)
def drop_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return ordered.drop_repeats(
        table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type"),
        ["user_id"],
        ["ts", "event_id"],
        "event_type",
        rows_per_span=20,
    ).select("event_id", "user_id", "event_type")


@query(
    "number_rows",
    "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS row_no FROM events",
)
def number_rows(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "ts")
    numbered = ordered.number_rows(events, [], ["ts", "event_id"], rows_per_span=1000)
    return numbered.select("event_id", "row_no")


@query(
    "block_labels",
    """
SELECT p_partkey, p_type,
       CASE b WHEN 0 THEN 'w0' WHEN 1 THEN 'w1' WHEN 2 THEN 'w2' ELSE 'w3' END AS weight
FROM (SELECT p_partkey, p_type,
             (row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) - 1) // 6 AS b
      FROM part)
WHERE b < 4
""",
)
def block_labels(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_partkey", "p_type")
    return ordered.label_blocks(
        parts, ["p_type"], ["p_partkey"], ["w0", "w1", "w2", "w3"], 6, "weight"
    )


@query(
    "top_per_group",
    """
SELECT o_orderpriority, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderpriority
                               ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
WHERE rn <= 3
""",
)
def top_per_group(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        "o_orderpriority", "o_orderkey", "o_totalprice"
    )
    return ordered.top_per_group(
        orders, ["o_orderpriority"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3
    )


@query(
    "last_per_group",
    """
SELECT o_orderpriority, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderpriority
                               ORDER BY o_totalprice DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn <= 1500
""",
)
def last_per_group(spark: SparkSession, folder: str) -> DataFrame:
    """More rows than Spark limits before a shuffle, from the end of the order."""
    orders = table(spark, folder, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return ordered.top_per_group(
        orders, ["o_orderpriority"], ["o_totalprice", "o_orderkey"], 1500, descending=True
    )


@query(
    "report_header_spread",
    """
SELECT event_id, user_id,
       first_value(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS header_value
FROM events
""",
)
def report_header_spread(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "value")
    spread = ordered.spread_first(
        events, ["user_id"], ["ts", "event_id"], [("value", "header_value")]
    )
    return spread.select("event_id", "user_id", "header_value")


@query(
    "dates_newest_first",
    "SELECT DISTINCT o_orderdate FROM orders ORDER BY o_orderdate DESC",
)
def dates_newest_first(spark: SparkSession, folder: str) -> DataFrame:
    return measures.newest_first(table(spark, folder, "orders"), "o_orderdate")


@query(
    "first_rows",
    """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
ORDER BY o_orderdate DESC, o_orderkey LIMIT 20
""",
)
def first_rows(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return measures.first_rows(orders, 20, F.desc("o_orderdate"), "o_orderkey")


# --- report texts and pages ---------------------------------------------------------------


@query(
    "report_lines",
    """
SELECT doc_id, pos, line FROM (
  SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS pos,
         unnest(string_split(text, chr(10))) AS line
  FROM documents)
""",
)
def report_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = reports.report_lines(table(spark, folder, "documents"), keep=("doc_id",))
    return lines.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "line")


@query(
    "report_sections",
    r"""
SELECT doc_id, pos, list_extract(w, 1) AS word0, list_extract(w, 2) AS word1,
       CASE WHEN pos BETWEEN 1 AND 8 THEN 'cattle' WHEN pos BETWEEN 11 AND 23 THEN 'sheep'
            ELSE 'pork' END AS section,
       CASE WHEN pos >= 26
            THEN list_extract(['20-55.99kg', '56-64.99kg', '65-79.99kg', '80-99.99kg'],
                              (pos - 26) // 6 + 1) END AS weight,
       list_extract(head, 3) AS date_from
FROM (
  SELECT doc_id, unnest(range(len(ls))) AS pos,
         unnest([regexp_extract_all(l, '[^\s\x0b\x{85}\p{Z}]+') for l in ls]) AS w,
         regexp_extract_all(ls[1], '[^\s\x0b\x{85}\p{Z}]+') AS head
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))
WHERE pos BETWEEN 1 AND 8 OR pos BETWEEN 11 AND 23 OR pos >= 26
""",
)
def report_sections(spark: SparkSession, folder: str) -> DataFrame:
    lines = reports.report_lines(
        table(spark, folder, "documents"),
        keep=("doc_id",),
        header={"date_from": F.get("head", 2)},
    )
    return (
        lines.withColumns(
            {
                "section": reports.line_section("pos", livestock.SECTIONS),
                "weight": reports.block_of(
                    "pos", livestock.SECTIONS["pork"][0], livestock.BLOCK, livestock.WEIGHTS
                ),
            }
        )
        .filter(F.col("section").isNotNull())
        .select(
            "doc_id",
            F.col("pos").cast("bigint").alias("pos"),
            *shape.positional("words", ["word0", "word1"]),
            "section",
            "weight",
            "date_from",
        )
    )


@query(
    "page_fields",
    """
SELECT page_id, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title,
       nullif(regexp_extract(html, '<html lang="([a-z]+)"', 1), '') AS lang FROM pages
""",
)
def page_fields(spark: SparkSession, folder: str) -> DataFrame:
    return pages.page_fields(
        table(spark, folder, "pages"),
        {
            "title": text.tag_text("html", "title"),
            "lang": text.tag_attribute("html", "html", "lang"),
        },
    )


@query("page_notice", """SELECT page_id FROM pages WHERE NOT contains(html, '<html lang="fr"')""")
def page_notice(spark: SparkSession, folder: str) -> DataFrame:
    return pages.without_notice(table(spark, folder, "pages"), '<html lang="fr"').select("page_id")


LINK_SQL = r"""
SELECT page_id, pos, href, link_text FROM (
  SELECT page_id, unnest(range(len(h))) AS pos, unnest(h) AS href, unnest(t) AS link_text
  FROM (SELECT page_id,
               regexp_extract_all(html, '(?is)<a\b[^>]*?\bhref="([^"]*)"[^>]*>(.*?)</a>', 1) AS h,
               regexp_extract_all(html, '(?is)<a\b[^>]*?\bhref="([^"]*)"[^>]*>(.*?)</a>', 2) AS t
        FROM pages))
"""


@query("page_links", LINK_SQL)
def page_links(spark: SparkSession, folder: str) -> DataFrame:
    links = pages.page_links(table(spark, folder, "pages"))
    return links.withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "page_links_first",
    f"""
SELECT page_id, href FROM (
  SELECT page_id, href, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rn
  FROM ({LINK_SQL}) WHERE trim(link_text) = 'The')
WHERE rn <= 1
""",
)
def page_links_first(spark: SparkSession, folder: str) -> DataFrame:
    links = pages.page_links(table(spark, folder, "pages"), text="The", first=1)
    return links.select("page_id", "href")


@query(
    "work_list",
    """
SELECT DISTINCT p_brand, l_suppkey FROM lineitem JOIN part ON l_partkey = p_partkey
EXCEPT
SELECT DISTINCT p_brand, l_suppkey FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_shipdate < DATE '1995-07-01'
""",
)
def work_list(spark: SparkSession, folder: str) -> DataFrame:
    sales = table(spark, folder, "lineitem").select("l_partkey", "l_suppkey", "l_shipdate")
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")

    def pairs(rows: DataFrame) -> DataFrame:
        # Distinct before the join: a part sold very often joins once per supplier.
        return rows.select("l_partkey", "l_suppkey").distinct().join(parts, "l_partkey")

    done = sales.filter(F.col("l_shipdate") < dates.as_of_date("1995-07-01"))
    return pages.work_list(pairs(sales), pairs(done), ["p_brand", "l_suppkey"])


# --- whole reports, from raw text to typed rows -------------------------------------------
# One small report per row of a table: the text is built by Spark and then read as if it had
# come from a file.


def _text(*lines: Column | str) -> Column:
    return F.concat_ws("\n", *[F.lit(x) if isinstance(x, str) else x for x in lines])


def _csv(*fields: Column | str) -> Column:
    return F.concat_ws(",", *[F.lit(x) if isinstance(x, str) else x for x in fields])


def _quoted(number: str) -> Column:
    return F.concat(F.lit('"'), F.format_number(number, 2), F.lit('"'))


@query(
    "grain_sheets",
    """
SELECT strftime(o_orderdate, '%-d %b %y ') || o_orderstatus AS contract_type,
       o_totalprice AS bid, o_totalprice AS last, o_custkey + 3000000000 AS deals,
       o_orderkey AS value, CAST(o_orderdate AS DATE) AS upload_date, o_orderpriority AS market_name
FROM orders
""",
)
def grain_sheets(spark: SparkSession, folder: str) -> DataFrame:
    return _grain_rows(spark, folder).select(
        "contract_type", "bid", "last", "deals", "value", "upload_date", "market_name"
    )


def _grain_rows(spark: SparkSession, folder: str) -> DataFrame:
    contract = F.concat(F.date_format("o_orderdate", "d MMM yy"), F.lit(" "), F.col("o_orderstatus"))
    price, day = _quoted("o_totalprice"), F.date_format("o_orderdate", "dd/MM/yyyy")
    deals = F.col("o_custkey") + 3_000_000_000  # beyond 32 bits
    # Column order, case and blanks differ between sheets; names decide.
    plain = _text(
        "title, with a comma",
        "contract type,Volatility,Bid,Offer,MARKET  to Market,First,Last,High,Low,Deals,conts,Value,,Upload Date",
        _csv(contract, "1", price, "1", "1", "1", price, "1", "1", deals, '"1,204"',
             F.col("o_orderkey"), '"two\nlines, ""quoted"""', day),
        "",
    )
    turned = _text(
        "title",
        "Upload Date,Value,Conts,Deals,Low,High,Last,First,Market to Market,Offer,Bid,Volatility,Contract Type",
        _csv(day, F.col("o_orderkey"), "2", deals, "1", "1", price, "1", "1", "1", price, " 1 ",
             contract),
        # No volatility: an incomplete row, which the clean-up drops.
        _csv(day, F.col("o_orderkey"), "2", "7", "1", "1", price, "1", "1", "1", price, " ", contract),
    )
    texts = dealt_table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("file_path"),
        F.concat(F.lit(" "), F.col("o_orderpriority")).alias("market_name"),
        F.lit("m").alias("market_code"),
        F.lit("t").alias("market_type"),
        F.when(F.col("o_orderstatus") == "O", turned).otherwise(plain).alias("text"),
    )
    raw = files.sheet_rows(
        texts, grain.SHEET_COLUMNS, keep=grain.MARKET_COLUMNS, required=grain.SHEET_COLUMNS
    )
    return grain.clean(raw)


@query(
    "horticulture_sheets",
    """
SELECT p_name AS product, CAST(p_partkey AS VARCHAR) AS product_code, p_brand AS variety,
       CAST(p_size AS BIGINT) AS unit_kg, CASE WHEN n < 2 THEN p_retailprice ELSE 20.5 END AS average_price,
       CAST(1510 AS DOUBLE) AS total_sales,
       CASE n WHEN 1 THEN DATE '2023-05-01' WHEN 2 THEN DATE '2023-05-02'
              WHEN 3 THEN DATE '2023-05-02' END AS date,
       'Market ' || p_type AS market_name
FROM part CROSS JOIN range(4) r(n)
""",
)
def horticulture_sheets(spark: SparkSession, folder: str) -> DataFrame:
    return _horticulture_rows(spark, folder).select(
        "product", "product_code", "variety", "unit_kg", "average_price", "total_sales", "date",
        "market_name",
    )


def _horticulture_rows(spark: SparkSession, folder: str) -> DataFrame:
    product = F.concat(F.col("p_partkey"), F.lit(". "), F.col("p_name"))
    unit = F.concat(F.col("p_size").cast("string"), F.lit(" kg"))

    def row(average: Column | str) -> Column:
        # Text that looks like a section header, and a line break, in other fields.
        kind = F.concat(F.col("p_type"), F.lit(" harvest 3 June 2023"))
        return _csv(
            product, F.col("p_brand"), kind, "M", '"BAG 5 kg\n4 July 2000 x"', unit, "20.5", "3", "2", average,
            '"R1,510.00"', "30", "7",
        )

    price = F.col("p_retailprice").cast("string")
    blank = ",,,,,,,,,,,,"
    texts = dealt_table(spark, folder, "part").select(
        F.concat(
            F.lit("file:/in/Market%20"), F.col("p_type"), F.lit("_m_t/"), F.col("p_partkey")
        ).alias("file_path"),
        _text(
            "title line",
            ",".join(horticulture.SHEET_COLUMNS).lower(),
            row(price),
            ',,,,,"Monday, 1 May 2023",,,,,,,',
            row(price),
            blank,
            ",,,,,02 May 2023,,,,,,,",
            # No average price: the closing price stands in.
            row(""),
            # The same header again opens a new section.
            ",,,,,02 May 2023,,,,,,,",
            row(""),
            "",
        ).alias("text"),
    )
    raw = files.dated_sheet_rows(
        files.market_of_path(texts),
        horticulture.SHEET_COLUMNS,
        horticulture.SECTION_HEADER,
        section_column="Unit",
        section="Date",
        keep=("market_name", "market_code", "market_type"),
    )
    return horticulture.clean(raw)


def _mixed_sheets(spark: SparkSession, folder: str) -> DataFrame:
    """A sheet for each order: good, without a column, too wide, empty, or without header or rows."""
    day, columns = F.date_format("o_orderdate", "dd/MM/yyyy"), grain.SHEET_COLUMNS
    head, wide = ",".join(columns), ",".join([*columns, *[f"more {k}" for k in range(30)]])
    row = _csv(F.lit("1 May 23 A"), *["1"] * 10, F.col("o_orderkey"), day)
    kinds = [
        _text("title", head, row, row),
        _text("title", head.replace("Bid,", "bids,").replace(",Value", ""), row),
        _text("title", wide, row),
        F.lit(" \n"),
        F.lit("title\n"),
        _text("title", head, ",,,,,"),
    ]
    text = F.get(F.array(*kinds), (F.col("o_orderkey") % len(kinds)).cast("int"))
    return dealt_table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("file_path"), text.alias("text")
    )


@query(
    "sheet_faults",
    """
SELECT CAST(o_orderkey AS VARCHAR) AS file_path,
       CASE o_orderkey % 6 WHEN 1 THEN 'the sheet lacks a column: Bid, Value'
                           WHEN 2 THEN 'the sheet is too wide' WHEN 3 THEN 'the sheet is empty'
                           WHEN 4 THEN 'the sheet has no header' ELSE 'the sheet has no rows' END AS fault
FROM orders WHERE o_orderkey % 6 > 0
""",
)
def sheet_faults(spark: SparkSession, folder: str) -> DataFrame:
    """The sheets that can't be loaded, each with its reason."""
    texts = _mixed_sheets(spark, folder)
    return files.sheet_faults(texts, grain.SHEET_COLUMNS, required=grain.SHEET_COLUMNS)


@query(
    "mixed_sheets",
    """
SELECT CAST(o_orderkey AS VARCHAR) AS file_path, CAST(o_orderkey AS VARCHAR) AS value,
       CAST(line_no AS INTEGER) AS line_no
FROM orders CROSS JOIN range(2, 4) r(line_no) WHERE o_orderkey % 6 = 0
""",
)
def mixed_sheets(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the good sheets among bad ones."""
    rows = files.sheet_rows(
        _mixed_sheets(spark, folder), grain.SHEET_COLUMNS, required=grain.SHEET_COLUMNS, skip_bad=True
    )
    return rows.select("file_path", F.col("Value").alias("value"), "line_no")


def _reports(spark: SparkSession, folder: str) -> DataFrame:
    """A slaughter report of 52 lines per customer, with the decimal comma."""
    plain = F.translate(F.format_number("c_acctbal", 2), ",", "")
    customers = dealt_table(spark, folder, "customer").select(
        "c_custkey", F.translate(plain, ".", ",").alias("amount")
    )
    amount = F.col("amount")

    def line(i: Column) -> Column:
        return (
            F.when(i == 0, F.lit("a b c d e f g h i j k l m 2023/05/01 to 2023/5/7"))
            .when((i >= 9) & (i <= 10), F.lit("heading"))
            # The last value of the first cattle line is missing.
            .when(i == 1, F.concat_ws(" ", F.lit("K1"), F.col("c_custkey"), amount, amount, amount, amount))
            .otherwise(
                F.concat_ws(
                    "  ", F.concat(F.lit("K"), i), F.col("c_custkey") + i, amount, amount, amount, amount,
                    amount, F.lit("surplus"),
                )
            )
        )

    texts = customers.select(
        F.col("c_custkey").cast("string").alias("file_path"),
        F.array_join(F.transform(F.sequence(F.lit(0), F.lit(51)), line), "\n").alias("text"),
    )
    return livestock.report_rows(texts)


@query(
    "livestock_cattle_reports",
    """
SELECT 'K' || CAST(i AS VARCHAR) AS class,
       CASE WHEN i = 1 THEN c_custkey ELSE c_custkey + i END AS units,
       c_acctbal AS avg_mass, c_acctbal AS selling_min,
       CASE WHEN i = 1 THEN 0.0 ELSE c_acctbal END AS selling_max, i = 1 AS was_null,
       DATE '2023-05-01' AS date_from, DATE '2023-05-07' AS date_to
FROM customer CROSS JOIN range(1, 9) r(i)
""",
)
def livestock_cattle_reports(spark: SparkSession, folder: str) -> DataFrame:
    return livestock.cattle(_reports(spark, folder)).select(
        "class", "units", "avg_mass", "selling_min", "selling_max", "was_null", "date_from", "date_to"
    )


@query(
    "livestock_sheep_reports",
    """
SELECT 'K' || CAST(i AS VARCHAR) AS class, c_custkey + i AS units,
       c_acctbal AS avg_purch, DATE '2023-05-01' AS date_from
FROM customer CROSS JOIN range(11, 24) r(i)
""",
)
def livestock_sheep_reports(spark: SparkSession, folder: str) -> DataFrame:
    return livestock.sheep(_reports(spark, folder)).select(
        "class", "units", "avg_purch", "date_from"
    )


@query(
    "livestock_pork_reports",
    """
SELECT 'K' || CAST(i AS VARCHAR) AS class, c_custkey + i AS units,
       c_acctbal AS purch_max, DATE '2023-05-07' AS date_to,
       list_extract(['20-55.99kg', '56-64.99kg', '65-79.99kg', '80-99.99kg'], (i - 26) // 6 + 1)
         AS weight
FROM customer CROSS JOIN range(26, 50) r(i)
""",
)
def livestock_pork_reports(spark: SparkSession, folder: str) -> DataFrame:
    return livestock.pork(_reports(spark, folder)).select(
        "class", "units", "purch_max", "date_to", "weight"
    )


# --- parsing and projections --------------------------------------------------------------


@query(
    "contract_parse",
    """
SELECT l_orderkey, l_linenumber,
       make_date(2000 + year(l_shipdate) % 100, month(l_shipdate), day(l_shipdate))
         AS contract_date,
       CAST(month(l_shipdate) AS INTEGER) AS month_code,
       '20' || strftime(l_shipdate, '%y') AS year, l_returnflag AS grain_type
FROM lineitem
""",
)
def contract_parse(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.concat(
            F.date_format("l_shipdate", "d MMM yy"), F.lit(" "), F.col("l_returnflag")
        ).alias("contract_type"),
        F.col("l_linestatus").alias("market_name"),
        F.col("l_linestatus").alias("market_code"),
    )
    return grain.with_contract(raw).select(
        "l_orderkey", "l_linenumber", "contract_date", "month_code", "year", "grain_type"
    )


@query(
    "thousands_clean",
    "SELECT l_orderkey, l_linenumber, round(l_extendedprice, 2) AS price FROM lineitem",
)
def thousands_clean(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.concat(F.lit("  "), F.format_number("l_extendedprice", 2), F.lit(" ")).alias("price"),
    )
    return raw.withColumn("price", numbers.thousands_number("price"))


@query(
    "decimal_comma",
    """
SELECT l_orderkey, l_linenumber,
       CAST(replace(replace(CAST(l_discount AS VARCHAR), '.', ','), ',', '.') AS DOUBLE) AS d
FROM lineitem
""",
)
def decimal_comma(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.translate(F.col("l_discount").cast("string"), ".", ",").alias("d"),
    )
    return raw.withColumn("d", numbers.decimal_comma_number("d"))


@query(
    "currency_and_unit",
    "SELECT p_partkey, p_retailprice AS total_sales, p_size AS unit_kg FROM part",
)
def currency_and_unit(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "part").select(
        "p_partkey",
        F.concat(F.lit("R"), F.format_number("p_retailprice", 2)).alias("total_sales"),
        F.concat(F.col("p_size").cast("string"), F.lit(" kg")).alias("unit_kg"),
    )
    return raw.withColumns(
        {
            "total_sales": numbers.currency_number("total_sales"),
            "unit_kg": numbers.unit_number("unit_kg"),
        }
    )


@query("weekday_date", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders")
def weekday_date(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "EEEE, d MMMM yyyy").alias("d")
    )
    return raw.withColumn("d", dates.section_date("d"))


@query(
    "date_text",
    """
SELECT o_orderkey, strftime(o_orderdate, '%B %d, %Y') AS long_text,
       strftime(o_orderdate, '%Y,%-m,%-d') AS parts FROM orders
""",
)
def date_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey",
        dates.long_date_text("o_orderdate").alias("long_text"),
        dates.date_parts_text("o_orderdate").alias("parts"),
    )


@query(
    "product_code",
    """
SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS series, p_name AS product,
       p_name AS after_dot FROM part
""",
)
def product_code(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "part").select(
        "p_partkey", F.concat(F.col("p_partkey"), F.lit(". "), F.col("p_name")).alias("coded")
    )
    return raw.select(
        "p_partkey",
        text.before_dot("coded").alias("series"),
        text.product_name("coded").alias("product"),
        text.after_dot("coded").alias("after_dot"),
    )


@query(
    "market_label",
    """
SELECT s.s_suppkey, n.n_name || ' ' || CAST(n.n_nationkey AS VARCHAR) AS market
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
""",
)
def market_label(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"),
        text.market_label("n_name", F.col("n_nationkey").cast("string")).alias("market"),
    )
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    return shape.attach(suppliers, nations, "s_nationkey").select("s_suppkey", "market")


@query(
    "avg_per_market",
    """
SELECT n.n_name, round(avg(s.s_acctbal), 4) AS avg_bal, count(*) AS n
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey GROUP BY 1
""",
)
def avg_per_market(spark: SparkSession, folder: str) -> DataFrame:
    # Averaged per key first, so the join sees one row per market. Nation names are unique.
    means = measures.average_by(
        table(spark, folder, "supplier"), ["s_nationkey"], {"s_acctbal": "avg_bal"}, count="n"
    )
    names = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), "n_name"
    )
    named = shape.attach(means, names, "s_nationkey", how="inner")
    return rounded(named.select("n_name", "avg_bal", "n"), "avg_bal")


@query(
    "coalesce_price",
    """
SELECT l_orderkey, l_linenumber, coalesce(nullif(l_discount, 0), l_tax) AS p FROM lineitem
""",
)
def coalesce_price(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", known("l_discount", 0.0).alias("p"), "l_tax"
    )
    return shape.coalesce_measure(raw, "p", "l_tax").drop("l_tax")


@query(
    "fill_zero",
    """
SELECT l_orderkey, l_linenumber, coalesce(nullif(l_tax, 0.08), 0) AS tax,
       (nullif(l_tax, 0.08) IS NULL) AS was_null FROM lineitem
""",
)
def fill_zero(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", known("l_tax", 0.08).alias("tax")
    )
    return shape.fill_zero(raw, ["tax"])


@query(
    "positional_columns",
    """
SELECT p_partkey, split_part(p_name, ' ', 1) AS word0, split_part(p_name, ' ', 2) AS word1
FROM part
""",
)
def positional_columns(spark: SparkSession, folder: str) -> DataFrame:
    words = table(spark, folder, "part").select("p_partkey", text.tokens("p_name").alias("words"))
    return words.select("p_partkey", *shape.positional("words", ["word0", "word1"]))


@query(
    "blanks_and_round",
    """
SELECT p_partkey, replace(p_name, ' ', '') AS name, round(p_retailprice, 0) AS price FROM part
""",
)
def blanks_and_round(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        "p_partkey",
        text.without_blanks("p_name").alias("name"),
        F.round("p_retailprice", 0).alias("price"),
    )


@query(
    "round_half_even",
    "SELECT l_orderkey, l_linenumber, round_even(l_quantity / 2, 0) AS q FROM lineitem",
)
def round_half_even(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        numbers.round_half_even(F.col("l_quantity") / 2).alias("q"),
    )


@query(
    "trim_all",
    """
SELECT c_custkey, trim('  ' || c_name || ' ') AS c_name, trim(c_mktsegment) AS c_mktsegment
FROM customer
""",
)
def trim_all(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "customer").select(
        "c_custkey",
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("c_name"),
        "c_mktsegment",
    )
    return shape.trim_text(raw)


@query(
    "text_to_double",
    """
SELECT s_suppkey, s_acctbal AS balance, CAST(s_nationkey AS DOUBLE) AS nation FROM supplier
""",
)
def text_to_double(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "supplier").select(
        "s_suppkey",
        F.format_number("s_acctbal", 2).alias("balance"),
        F.col("s_nationkey").cast("string").alias("nation"),
    )
    return shape.text_to_double(raw, ("balance", "nation"))


@query("rename_snake", "SELECT p_partkey AS part_key, p_name AS part_name, p_name AS name FROM part")
def rename_snake(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "part").select(
        F.col("p_partkey").alias("Part  Key"), F.col("p_name").alias("Name Raw"), "p_type"
    )
    named = shape.rename(shape.snake_names(raw), {"name_raw": "part_name"})
    return shape.drop_junk(shape.duplicate(named, "part_name", "name"), "p_type", "unnamed_12")


@query(
    "union_files",
    """
SELECT c_name AS name, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier
""",
)
def union_files(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select(
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_acctbal").alias("acctbal"), F.col("s_name").alias("name")
    )
    return shape.union_by_name(customers, suppliers)


# --- checks -------------------------------------------------------------------------------


@query(
    "key_conflicts",
    """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""",
)
def key_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.key_conflicts(
        table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@query(
    "keep_winner",
    """
SELECT l_orderkey, l_linenumber, max(l_extendedprice) AS l_extendedprice
FROM lineitem GROUP BY 1, 2
""",
)
def keep_winner(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice"
    )
    return quality.keep_winner(
        lines, ["l_orderkey", "l_linenumber"], [F.desc("l_extendedprice")]
    )


@query(
    "newest_per_key",
    """
SELECT user_id, event_type, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                               ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1
""",
)
def newest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("user_id", "event_type", "event_id", "ts")
    newest = incremental.newest_per_key(events, ["user_id", "event_type"], ["ts", "event_id"])
    return newest.drop("ts")


@query(
    "not_null_and_length",
    """
SELECT count(CASE WHEN p_name IS NULL THEN 1 END) AS null_p_name,
       count(CASE WHEN length(p_name) > 8 THEN 1 END) AS long_p_name FROM part
""",
)
def not_null_and_length(spark: SparkSession, folder: str) -> DataFrame:
    return quality.check_counts(table(spark, folder, "part"), ["p_name"], {"p_name": 8})


@query(
    "quarantine",
    """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE nullif(l_discount, 0) IS NULL OR nullif(l_quantity, 1) IS NULL
""",
)
def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    _, bad = quality.quarantine(_gappy(spark, folder), ["discount", "quantity"])
    return bad.select("l_orderkey", "l_linenumber")


@query(
    "rule_losses",
    """
SELECT count(*) AS rows, count(*) FILTER (WHERE nullif(l_discount, 0) IS NULL) AS no_discount,
       count(*) FILTER (WHERE l_quantity < 10) AS small FROM lineitem
""",
)
def rule_losses(spark: SparkSession, folder: str) -> DataFrame:
    return quality.rule_losses(
        table(spark, folder, "lineitem"),
        {
            "no_discount": known("l_discount", 0.0).isNotNull(),
            "small": F.col("l_quantity") >= 10,
        },
    )


@query(
    "rows_per_file",
    "SELECT 'lineitem.parquet' AS file_name, count(*) AS rows FROM lineitem",
)
def rows_per_file(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        F.col("_metadata.file_path").alias("file_path")
    )
    # The table's own name stands for its files: the table may have one file or many.
    table_path = F.regexp_replace("file_path", r"(lineitem\.parquet)/[^/]*$", "$1")
    counted = quality.rows_per_file(lines.withColumn("file_path", table_path))
    return files.file_name(counted).select("file_name", "rows")


# --- load jobs: reports to the family's table ---------------------------------------------


@query("load_grain", SQL["grain_sheets"])
def load_grain(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads that overlap."""
    rows, path = _grain_rows(spark, folder), run_folder(spark, "load")
    load.load(rows.filter(F.col("value") % 2 == 0), schemas.GRAIN, path)
    load.load(rows, schemas.GRAIN, path)
    return load.read(spark, path).select(
        "contract_type", "bid", "last", "deals", "value", "upload_date", "market_name"
    )


@query(
    "load_horticulture",
    f"SELECT DISTINCT * FROM ({SQL['horticulture_sheets']}) WHERE date IS NOT NULL",
)
def load_horticulture(spark: SparkSession, folder: str) -> DataFrame:
    """Rows above the first section have no date, and rows that repeat are one."""
    rows, path = _horticulture_rows(spark, folder), run_folder(spark, "load")
    load.load(rows.filter(F.col("product_code") % 2 == 0), schemas.HORTICULTURE, path)
    load.load(rows, schemas.HORTICULTURE, path)
    return load.read(spark, path).select(
        "product", "product_code", "variety", "unit_kg", "average_price", "total_sales", "date",
        "market_name",
    )


@query(
    "load_livestock",
    f"""
SELECT * FROM ({SQL['livestock_cattle_reports']})
QUALIFY row_number() OVER (PARTITION BY class, date_from ORDER BY units DESC) = 1
""",
)
def load_livestock(spark: SparkSession, folder: str) -> DataFrame:
    """The report with most units wins; the flag of missing measures is kept."""
    rows, path = livestock.cattle(_reports(spark, folder)), run_folder(spark, "load")
    for _ in range(2):
        load.load(rows, CATTLE, path, winner=[F.desc("units")])
    return load.read(spark, path).select(
        "class", "units", "avg_mass", "selling_min", "selling_max", "was_null", "date_from", "date_to"
    )


@query(
    "load_by_key_table",
    f"""
SELECT * FROM ({SQL['livestock_cattle_reports']})
QUALIFY row_number() OVER (PARTITION BY class, date_from ORDER BY units DESC) = 1
""",
)
def load_by_key_table(spark: SparkSession, folder: str) -> DataFrame:
    """Overlapping loads whose new rows are found by a bucketed table of keys."""
    rows, path = livestock.cattle(_reports(spark, folder)), run_folder(spark, "load")
    name = f"cattle_keys_{uuid.uuid4().hex}"
    for n in range(3):
        some = rows.filter("class <> 'K1'") if n == 0 else rows
        load.load(some, CATTLE, path, winner=[F.desc("units")], key_table=name)
    spark.sql(f"DROP TABLE {name}")
    return load.read(spark, path).select(
        "class", "units", "avg_mass", "selling_min", "selling_max", "was_null", "date_from", "date_to"
    )


# --- files and page markup ----------------------------------------------------------------


@query(
    "listed_files",
    """
SELECT c_mktsegment || '.csv' AS file_name, count(*) AS rows FROM customer
WHERE c_mktsegment <> (SELECT min(c_mktsegment) FROM customer) GROUP BY 1
""",
)
def listed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Sheets by suffix, without one by its name, and without empty ones."""
    path = run_folder(spark, "files")
    rows = table(spark, folder, "customer").select("c_mktsegment", "c_custkey", "c_name")
    wide = rows.select(F.concat_ws(",", "c_custkey", "c_name").alias("value"), "c_mktsegment")
    # A sheet per task and segment: Spark names its own files, so a folder's name stands for them.
    sheets = wide.withColumn("part", F.spark_partition_id()).groupBy("c_mktsegment", "part")
    body = F.array_join(F.sort_array(F.collect_list("value")), "\n")
    sheet = F.concat_ws("\n", F.lit("title"), F.lit("id,name"), body).alias("value")
    sheets.agg(sheet).select("value", "c_mktsegment", "part").write.partitionBy("c_mktsegment", "part").text(
        f"{path}/in"
    )
    texts = files.read_whole_texts(spark, f"{path}/in", suffix=".txt")
    named = texts.withColumn(
        "file_path",
        F.concat(F.regexp_extract(files.plain_path("file_path"), "c_mktsegment=([^/]*)/", 1), F.lit(".csv")),
    )
    first = rows.agg(F.min("c_mktsegment")).first()[0]
    kept = files.without_files(named, [f"{first}.csv"])
    empty = kept.select("file_path", F.lit("title\nid,name\n").alias("text")).withColumn(
        "file_path", F.lit("empty.csv")
    )
    found = files.sheet_rows(kept.union(empty), ["id", "name"], required=["id"])
    return quality.rows_per_file(found).withColumnRenamed("file_path", "file_name")


def _markup(spark: SparkSession, folder: str) -> DataFrame:
    """A small page for each supplier: an information table and a select box."""
    name, balance = F.col("s_name"), F.col("s_acctbal").cast("string")
    page = F.concat(
        F.lit("<table><TR class=x><td>Name</td><td> <b>"), name,
        F.lit("</b> </td></TR>\n<tr><td>Balance</td><td>"), balance,
        F.lit("</td></tr></table><select><option>choose</option><option value='1'> "), name,
        F.lit(" </option><OPTION>other</OPTION></select>"),
    )
    return table(spark, folder, "supplier").select(F.col("s_suppkey").alias("page_id"), page.alias("html"))


@query(
    "page_table_cells",
    """
SELECT s_suppkey AS page_id, s_name AS name, s_acctbal AS balance, CAST(NULL AS VARCHAR) AS none
FROM supplier
""",
)
def page_table_cells(spark: SparkSession, folder: str) -> DataFrame:
    return pages.page_fields(
        _markup(spark, folder),
        {
            "name": text.table_cell("html", 1, 2),
            "balance": text.table_cell("html", 2, 2).cast("double"),
            "none": text.table_cell("html", 3, 1),
        },
    )


@query(
    "page_options",
    """
SELECT s_suppkey AS page_id, 1 AS pos, s_name AS option FROM supplier
UNION ALL SELECT s_suppkey, 2, 'other' FROM supplier
""",
)
def page_options(spark: SparkSession, folder: str) -> DataFrame:
    return pages.select_options(_markup(spark, folder), skip=1)


# --- sinks and the incremental load -------------------------------------------------------


@query("csv_snapshot", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def csv_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    path = sinks.write_snapshot(rows, run_folder(spark, "snapshot"), "2001-08-01")
    return files.read_processed(spark, path, rows.schema, "csv")


@query(
    "text_csv_scan",
    "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer",
)
def text_csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    path = sinks.write_snapshot(rows, run_folder(spark, "snapshot"), "2001-08-01")
    return files.read_text_csv(spark, path)


@query(
    "table_append",
    """
SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
""",
)
def table_append(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    path = run_folder(spark, "table")
    closed = F.col("o_orderdate") < dates.as_of_date("1998-01-01")
    sinks.write_table(rows.filter(closed), path, "o_orderdate", mode="overwrite")
    sinks.write_table(rows.filter(~closed), path, "o_orderdate", mode="append")
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice", "year")


@query(
    "catalog_table",
    """
SELECT o_orderpriority AS class, o_custkey AS units, o_totalprice AS avg_purch,
       CAST(o_orderdate AS DATE) AS date_from, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
""",
)
def catalog_table(spark: SparkSession, folder: str) -> DataFrame:
    nothing = F.lit(0.0)
    rows = table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("class"),
        F.col("o_custkey").alias("units"),
        F.col("o_totalprice").alias("avg_purch"),
        F.col("o_orderdate").alias("date_from"),
        F.col("o_orderdate").alias("date_to"),
        *[nothing.alias(c) for c in ("avg_mass", "avg_selling", "selling_min", "selling_max")],
    )
    # A name of its own: the product's tables stay as they are.
    own = replace(CATTLE, name=f"{CATTLE.name}_{uuid.uuid4().hex}")
    sinks.create_table(spark, own, run_folder(spark, "catalog"))
    sinks.load_table(rows, own, mode="overwrite")
    found = read_table(spark, own.name).select("class", "units", "avg_purch", "date_from", "year")
    copy = f"{run_folder(spark, 'catalog')}/copy"
    found.write.parquet(copy)
    spark.sql(f"DROP TABLE {own.name}")
    return spark.read.parquet(copy)


@query(
    "stage_rows",
    "SELECT s_suppkey, s_acctbal, 'grain' AS family FROM supplier",
)
def stage_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "supplier").select("s_suppkey", "s_acctbal")
    path = run_folder(spark, "stage")
    # The second write of the same run replaces the first.
    for _ in range(2):
        sinks.stage(rows, path, "grain", "run1")
    return spark.read.parquet(path).select("s_suppkey", "s_acctbal", "family")


@query(
    "stream_load",
    """
WITH e AS (
  SELECT event_id, user_id, event_type, ts, event_id % 2 = 0 AS early
  FROM events
), f AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k,
         row_number() OVER (PARTITION BY user_id, event_type, early
                            ORDER BY ts DESC, event_id DESC) AS own,
         bool_or(early) OVER (PARTITION BY user_id, event_type) AS known
  FROM e
)
SELECT user_id, event_type, event_id FROM f
WHERE CASE WHEN known THEN early AND own = 1 ELSE k = 1 END
""",
)
def stream_load(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads that overlap, the second with a checkpoint of its own: keys of the first stay."""
    events = table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type")
    day = F.date_add(F.lit("2024-01-01"), (F.col("user_id") % 28).cast("int"))
    events = events.withColumn("day", F.when(F.col("user_id") % 7 != 0, day))
    path = run_folder(spark, "stream")
    events.filter(F.col("event_id") % 2 == 0).write.parquet(f"{path}/in/first")
    for n, batch in enumerate(("first", "second", "third")):
        if batch == "second":  # all events: half of them were loaded before
            events.write.parquet(f"{path}/in/second")
        stream = incremental.new_files(spark, f"{path}/in/*", events.schema)
        incremental.load_new_files(
            stream,
            f"{path}/rows",
            # The third load starts with an empty checkpoint and meets all files again.
            f"{path}/checkpoint{n // 2}",
            ["user_id", "event_type", "day"],
            ["ts", "event_id"],
            day="day",
        ).awaitTermination()
    rows = versions.read(spark, f"{path}/rows", ["user_id", "event_type", "day"])
    return rows.select("user_id", "event_type", "event_id")


def _priced(spark: SparkSession, folder: str) -> str:
    """Prices of orders in three loads: those of even keys; all, a third of them corrected and some
    without a price; and the first ones again, which are older. Returns the path of the table."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("item"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_totalprice").alias("price"),
        F.lit(1).alias("issue"),
    )
    early = orders.filter("item % 2 = 0")
    later = orders.withColumns(
        {
            "price": F.when(F.col("item") % 5 == 0, None)
            .when(F.col("item") % 3 == 0, F.col("price") + 1)
            .otherwise(F.col("price")),
            "issue": F.when(F.col("item") % 3 == 0, 2).otherwise(1),
        }
    )
    path = run_folder(spark, "prices")
    for n, rows in enumerate((early, later, early)):
        rows.write.parquet(f"{path}/in/{n}")
        incremental.load_new_files(
            incremental.new_files(spark, f"{path}/in/{n}", orders.schema),
            f"{path}/rows",
            f"{path}/checkpoint{n}",
            PRICE_KEY,
            ["issue"],
            day="day",
            rules={"priced": F.col("price").isNotNull(), "late": F.col("day") < F.lit("2001-06-01")},
            winner="newest",
        ).awaitTermination()
    return f"{path}/rows"


PRICE_KEY = ["item", "day"]
#: What the loads of prices bring, and what they then do with it.
PRICES_SQL = """
WITH o AS (
  SELECT o_orderkey AS item, CAST(o_orderdate AS DATE) AS day, o_totalprice AS price FROM orders
), arrived AS (
  SELECT 0 AS version, item, day, price, 1 AS issue FROM o WHERE item % 2 = 0
  UNION ALL
  SELECT 1, item, day, CASE WHEN item % 5 = 0 THEN NULL WHEN item % 3 = 0 THEN price + 1 ELSE price END,
         CASE WHEN item % 3 = 0 THEN 2 ELSE 1 END FROM o
  UNION ALL
  SELECT 2, item, day, price, 1 FROM o WHERE item % 2 = 0
), good AS (
  SELECT * FROM arrived WHERE price IS NOT NULL AND day < DATE '2001-06-01'
), judged AS (
  SELECT *, CASE WHEN version = 0 OR version = 1 AND item % 2 = 1 THEN 'new'
                 WHEN item % 3 <> 0 OR version = 2 AND item % 5 = 0 THEN 'same'
                 WHEN version = 1 THEN 'won' ELSE 'lost' END AS state
  FROM good
)
"""
PRICES_NOW = "SELECT item, day, arg_max(price, issue) AS price, max(issue) AS issue FROM good GROUP BY 1, 2"


@query("stream_corrections", PRICES_SQL + PRICES_NOW)
def stream_corrections(spark: SparkSession, folder: str) -> DataFrame:
    """Corrected prices take the place of loaded ones; older ones that come later don't."""
    path = _priced(spark, folder)
    return versions.read(spark, path, PRICE_KEY).select("item", "day", "price", "issue")


@query("stream_compacted", PRICES_SQL + PRICES_NOW)
def stream_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows after the folders of the loads have become one."""
    path = _priced(spark, folder)
    versions.compact(spark, path, PRICE_KEY, "day")
    return versions.read(spark, path, PRICE_KEY).select("item", "day", "price", "issue")


@query(
    "stream_disputes",
    PRICES_SQL + """
SELECT item, day, price, issue, state, version, CASE version WHEN 1 THEN 0 ELSE 1 END AS known_version
FROM judged WHERE state IN ('won', 'lost')
""",
)
def stream_disputes(spark: SparkSession, folder: str) -> DataFrame:
    found = incremental.disputes(spark, _priced(spark, folder))
    return found.select(
        *PRICE_KEY,
        "price",
        "issue",
        "state",
        F.col("version").cast("int").alias("version"),
        F.col("known_version").cast("int").alias("known_version"),
    )


@query(
    "stream_counts",
    PRICES_SQL + """
, c AS (
  SELECT version, unnest(map_entries(MAP {
      'rows': count(*),
      'broke_priced': count(*) FILTER (WHERE price IS NULL),
      'broke_late': count(*) FILTER (WHERE day >= DATE '2001-06-01')})) AS e
  FROM arrived GROUP BY version
  UNION ALL
  SELECT version, unnest(map_entries(MAP {
      'new': count(*) FILTER (WHERE state = 'new'), 'same': count(*) FILTER (WHERE state = 'same'),
      'won': count(*) FILTER (WHERE state = 'won'), 'lost': count(*) FILTER (WHERE state = 'lost')}))
  FROM judged GROUP BY version
)
SELECT version, e.key AS name, e.value AS n FROM c
""",
)
def stream_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What each load has counted: rows, those that break a rule, and what became of the others."""
    found = versions.counts(spark, _priced(spark, folder))
    return found.select(F.col("version").cast("int").alias("version"), "name", "n")


@query(
    "stream_quarantine",
    PRICES_SQL + """
SELECT version, item, day, issue,
       concat_ws(',', CASE WHEN price IS NULL THEN 'priced' END,
                 CASE WHEN day >= DATE '2001-06-01' THEN 'late' END) AS broken
FROM arrived WHERE price IS NULL OR day >= DATE '2001-06-01'
""",
)
def stream_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that broke rules, load by load."""
    found = incremental.quarantine(spark, _priced(spark, folder))
    return found.select(
        F.col("version").cast("int").alias("version"),
        *PRICE_KEY,
        "issue",
        F.array_join("broken_rules", ",").alias("broken"),
    )


_PROFILED = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query(
    "profile_of_loads",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(*) AS rows, count({c}) AS non_null, "
        f"min({c})::VARCHAR AS low, max({c})::VARCHAR AS high, true AS near FROM customer"
        for c in _PROFILED
    ),
)
def profile_of_loads(spark: SparkSession, folder: str) -> DataFrame:
    """A table's profile from those of its loads; the distinct counts are within 5 % of exact ones."""
    rows = table(spark, folder, "customer").select(*_PROFILED)
    path = run_folder(spark, "profiles")
    load = incremental.append_batch(path, ["c_custkey"], ["c_acctbal"], profiled=True)
    for n in range(3):
        load(rows.filter(F.col("c_custkey") % 3 >= n), n)  # loads that overlap
    found = versions.profile(spark, path, ["c_custkey"])
    exact = measures.distinct_counts(rows, _PROFILED).unpivot([], list(_PROFILED), "name", "exact")
    off = F.abs(F.col("about_distinct") - F.col("exact"))
    return found.join(exact, F.col("column_name") == F.col("name")).select(
        "column_name", "rows", "non_null", "low", "high",
        (off <= F.greatest(0.05 * F.col("exact"), F.lit(1))).alias("near"),
    )


@query(
    "stream_sheets",
    """
SELECT strftime(o_orderdate, '%-d %b %y ') || o_orderstatus AS contract_type,
       o_totalprice AS last, o_orderkey AS value, CAST(o_orderdate AS DATE) AS upload_date,
       o_orderpriority AS market_name
FROM orders
""",
)
def stream_sheets(spark: SparkSession, folder: str) -> DataFrame:
    """Sheet files through the family's clean-up, in overlapping loads with two checkpoints."""
    path = _sheet_loads(spark, folder, broken=False)
    return versions.read(spark, path, SHEET_KEY).select(
        "contract_type", "last", "value", "upload_date", "market_name"
    )


@query(
    "stream_sheet_losses",
    """
WITH o AS (
  SELECT o_orderkey % 2 = 0 AS early, o_orderkey % 5 = 0 AS no_bid, o_orderkey % 7 = 0 AS no_date FROM orders
), arrived AS (
  SELECT 0 AS version, * FROM o WHERE early UNION ALL SELECT 1, * FROM o
  UNION ALL SELECT 2, * FROM o UNION ALL SELECT 2, * FROM o WHERE early
), lost AS (
  SELECT version, unnest(map_entries(MAP {
      'rows': count(*), 'broke_no_bid': count(*) FILTER (WHERE no_bid),
      'broke_no_upload_date': count(*) FILTER (WHERE no_date)})) AS e
  FROM arrived GROUP BY version
), became AS (
  SELECT v.version, unnest(map_entries(MAP {
      'new': count(*) FILTER (WHERE v.version = 0 AND early OR v.version = 1 AND NOT early),
      'same': count(*) FILTER (WHERE v.version = 1 AND early OR v.version = 2), 'won': 0, 'lost': 0})) AS e
  FROM o, (VALUES (0), (1), (2)) v(version) WHERE NOT no_bid AND NOT no_date GROUP BY v.version
)
SELECT version, e.key AS name, e.value::BIGINT AS n FROM (FROM lost UNION ALL FROM became)
""",
)
def stream_sheet_losses(spark: SparkSession, folder: str) -> DataFrame:
    """What loads of sheets with missing bids and dates lose to each rule, and what they add."""
    found = versions.counts(spark, _sheet_loads(spark, folder, broken=True))
    return found.select(F.col("version").cast("int").alias("version"), "name", "n")


SHEET_KEY = ["value", "upload_date"]


def _sheet_loads(spark: SparkSession, folder: str, broken: bool) -> str:
    """Sheets of half the orders, of all, and all files again with an empty checkpoint. ``broken`` ones lack
    a fifth of the bids and a seventh of the dates, which the rules then find. Returns the table's path."""
    key = F.col("o_orderkey")
    contract = F.concat(F.date_format("o_orderdate", "d MMM yy"), F.lit(" "), F.col("o_orderstatus"))
    price, day = _quoted("o_totalprice"), F.date_format("o_orderdate", "dd/MM/yyyy")
    bid = F.when(F.lit(broken) & (key % 5 == 0), F.lit(" ")).otherwise(F.lit("1"))
    day = F.when(F.lit(broken) & (key % 7 == 0), F.lit("soon")).otherwise(day)
    line = _csv(contract, "1", bid, "1", "1", "1", price, *["1"] * 4, key, day)
    rows = dealt_table(spark, folder, "orders").select(
        line.alias("line"), "o_orderkey", "o_orderpriority", F.spark_partition_id().alias("part")
    )
    path = run_folder(spark, "sheets")

    def arrive(some: DataFrame, name: str) -> None:
        head = [F.lit("title"), F.lit(",".join(grain.SHEET_COLUMNS))]
        body = F.array_join(F.collect_list("line"), "\n")
        sheets = some.groupBy("o_orderpriority", "part").agg(
            F.concat_ws("\n", *head, body).alias("value")
        )
        # A file is read as one sheet, so it has one, and a sheet has no more rows than a part.
        writer = sheets.drop("part").write.option("maxRecordsPerFile", 1)
        writer.partitionBy("o_orderpriority").text(f"{path}/in/{name}")

    def clean(texts: DataFrame) -> DataFrame:
        market = F.regexp_extract(files.plain_path("file_path"), "o_orderpriority=([^/]*)/", 1)
        named = texts.withColumns(
            {"market_name": market, "market_code": F.lit("m"), "market_type": F.lit("t")}
        )
        sheets = files.sheet_rows(
            named, grain.SHEET_COLUMNS, keep=grain.MARKET_COLUMNS, required=grain.SHEET_COLUMNS
        )
        return grain.clean(sheets, drop_incomplete=not broken)

    rules = load.rules_of(schemas.GRAIN) | {"no_bid": F.col("bid").isNotNull()}
    arrive(rows.filter(key % 2 == 0), "first")
    for n, batch in enumerate(("first", "second", "third")):
        if batch == "second":
            arrive(rows, "second")
        incremental.load_new_files(
            incremental.new_texts(spark, f"{path}/in/*/*"),
            f"{path}/rows",
            f"{path}/checkpoint{n // 2}",
            SHEET_KEY,
            ["last"],
            clean,
            day="upload_date",
            rules=rules if broken else None,
        ).awaitTermination()
    return f"{path}/rows"


# --- the questions of the dashboards ------------------------------------------------------

MARKET, GRAIN, AS_OF, UPLOAD = "F 3", "A", "2001-08-15", "2001-03-01"
CONTRACT = "1 Jun 01 A"


@query("grain_counts", GRAIN_SQL + "SELECT grain_type, count(*) AS n FROM grain GROUP BY 1")
def grain_counts(spark: SparkSession, folder: str) -> DataFrame:
    return grain.grain_counts(standins.grain(spark, folder))


@query(
    "grain_contract_mix",
    GRAIN_SQL
    + f"""
SELECT contract_type, count(*) AS n,
       round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (), 4) AS share,
       CAST(sum(count(*)) OVER () AS BIGINT) AS total,
       (SELECT count(DISTINCT market) FROM grain) AS markets
FROM grain WHERE grain_type = '{GRAIN}' GROUP BY 1
""",
)
def grain_contract_mix(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(grain.contract_mix(standins.grain(spark, folder), GRAIN), "share")


_YEAR = f"upload_date > DATE '{AS_OF}' - INTERVAL 365 DAY"
_PICKED = f"market = '{MARKET}' AND grain_type = '{GRAIN}'"


@query(
    "grain_price_by_contract",
    GRAIN_SQL
    + f"""
SELECT contract_date, contract_type, last FROM grain
WHERE {_YEAR} AND {_PICKED} AND upload_date = DATE '{UPLOAD}'
""",
)
def grain_price_by_contract(spark: SparkSession, folder: str) -> DataFrame:
    return grain.price_by_contract(standins.grain(spark, folder), MARKET, GRAIN, UPLOAD, AS_OF)


@query(
    "grain_last_series",
    GRAIN_SQL
    + f"SELECT upload_date, contract_type, last FROM grain WHERE {_YEAR} AND {_PICKED}",
)
def grain_last_series(spark: SparkSession, folder: str) -> DataFrame:
    return grain.price_series(standins.grain(spark, folder), MARKET, GRAIN, AS_OF)


@query(
    "grain_bid_series",
    GRAIN_SQL
    + f"SELECT upload_date, contract_type, bid FROM grain WHERE {_YEAR} AND {_PICKED}",
)
def grain_bid_series(spark: SparkSession, folder: str) -> DataFrame:
    return grain.price_series(standins.grain(spark, folder), MARKET, GRAIN, AS_OF, "bid")


@query(
    "grain_price_span",
    GRAIN_SQL
    + f"""
SELECT min(last) AS min_price, max(last) AS max_price,
       strftime(min(upload_date), '%B %d, %Y') AS min_date,
       strftime(max(upload_date), '%B %d, %Y') AS max_date
FROM grain WHERE {_YEAR} AND {_PICKED}
""",
)
def grain_price_span(spark: SparkSession, folder: str) -> DataFrame:
    return grain.price_span(standins.grain(spark, folder), MARKET, GRAIN, AS_OF)


@query(
    "grain_open_contracts",
    GRAIN_SQL
    + f"""
, g AS (SELECT contract_date, avg(last) AS l, avg(bid) AS b FROM grain
        WHERE {_YEAR} AND {_PICKED} AND contract_date > DATE '{AS_OF}' GROUP BY 1)
SELECT contract_date, 'Last' AS series, round(l, 4) AS value FROM g
UNION ALL SELECT contract_date, 'Bid', round(b, 4) FROM g
""",
)
def grain_open_contracts(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(
        grain.open_contract_averages(standins.grain(spark, folder), MARKET, GRAIN, AS_OF), "value"
    )


@query(
    "grain_prices_on",
    GRAIN_SQL
    + f"""
, g AS (SELECT * FROM grain WHERE {_PICKED} AND upload_date = DATE '{UPLOAD}'
        AND contract_date > DATE '{AS_OF}' - INTERVAL 365 DAY)
SELECT contract_date, contract_type, 'Last' AS series, last AS value FROM g
UNION ALL SELECT contract_date, contract_type, 'Bid', bid FROM g
""",
)
def grain_prices_on(spark: SparkSession, folder: str) -> DataFrame:
    return grain.prices_on(standins.grain(spark, folder), MARKET, GRAIN, UPLOAD, AS_OF)


@query(
    "grain_daily_averages",
    GRAIN_SQL
    + f"""
, g AS (SELECT upload_date, avg(last) AS l, avg(bid) AS b FROM grain
        WHERE {_YEAR} AND {_PICKED} GROUP BY 1)
SELECT upload_date, 'Last' AS series, round(l, 4) AS value FROM g
UNION ALL SELECT upload_date, 'Bid', round(b, 4) FROM g
""",
)
def grain_daily_averages(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(
        grain.daily_averages(standins.grain(spark, folder), MARKET, GRAIN, AS_OF), "value"
    )


_CONTRACT = f"market = '{MARKET}' AND contract_type = '{CONTRACT}'"


@query(
    "grain_contract_series",
    GRAIN_SQL
    + f"""
SELECT upload_date, 'Last' AS series, last AS value FROM grain WHERE {_CONTRACT}
UNION ALL SELECT upload_date, 'Bid', bid FROM grain WHERE {_CONTRACT}
""",
)
def grain_contract_series(spark: SparkSession, folder: str) -> DataFrame:
    return grain.contract_series(standins.grain(spark, folder), MARKET, CONTRACT)


@query(
    "grain_contract_deals",
    GRAIN_SQL
    + f"""
SELECT upload_date, 'Last' AS series, last AS value FROM grain WHERE {_CONTRACT}
UNION ALL SELECT upload_date, 'Bid', bid FROM grain WHERE {_CONTRACT}
UNION ALL SELECT upload_date, 'Deals', CAST(deals AS DOUBLE) FROM grain WHERE {_CONTRACT}
""",
)
def grain_contract_deals(spark: SparkSession, folder: str) -> DataFrame:
    return grain.contract_series_with_deals(standins.grain(spark, folder), MARKET, CONTRACT)


@query(
    "grain_market_share",
    GRAIN_SQL
    + f"""
SELECT upload_date, contract_type, market, CAST(sum(deals) AS BIGINT) AS deals,
       CAST(sum(sum(deals)) OVER () AS BIGINT) AS segment_total,
       round(CAST(sum(deals) AS DOUBLE) / sum(sum(deals)) OVER (), 4) AS share
FROM grain WHERE upload_date = DATE '{UPLOAD}' AND contract_type = '{CONTRACT}'
GROUP BY 1, 2, 3
""",
)
def grain_market_share(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(grain.market_share(standins.grain(spark, folder), UPLOAD, CONTRACT), "share")


@query(
    "grain_headline",
    GRAIN_SQL
    + f"""
SELECT round_even(avg(last), 0) AS avg_last, round_even(avg(bid), 0) AS avg_bid,
       max(bid) AS highest_bid
FROM grain WHERE {_PICKED} AND upload_date = DATE '{UPLOAD}'
""",
)
def grain_headline(spark: SparkSession, folder: str) -> DataFrame:
    return grain.headline(standins.grain(spark, folder), MARKET, GRAIN, UPLOAD)


@query(
    "grain_market_averages",
    GRAIN_SQL
    + """
SELECT market, round(avg(bid), 4) AS avg_bid, round(avg(last), 4) AS avg_last
FROM grain GROUP BY 1
""",
)
def grain_market_averages(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(
        grain.market_averages(standins.grain(spark, folder)), "avg_bid", "avg_last"
    )


LEAF = {
    "market_name": "Market 46",
    "product": "hot gizmo",
    "variety": "Brand#21",
    "class": "SMALL",
    "size": "47",
    "package": "F",
}
PRODUCT = LEAF["product"]


def _where(chosen: dict[str, str]) -> str:
    return " AND ".join(f"{c} = '{v}'" for c, v in chosen.items()) or "true"


def _cascade(depth: int) -> None:
    """One query per level of the facet cascade."""
    chosen = dict(list(LEAF.items())[:depth])
    level = horticulture.LEVELS[depth]

    @query(
        f"horticulture_options_{level}",
        HORTICULTURE_SQL + f"SELECT DISTINCT {level} FROM horticulture WHERE {_where(chosen)}",
    )
    def options(spark: SparkSession, folder: str) -> DataFrame:
        return horticulture.options(standins.horticulture(spark, folder), chosen)


for _depth in range(len(horticulture.LEVELS)):
    _cascade(_depth)


@query(
    "horticulture_leaf_series",
    HORTICULTURE_SQL
    + f"""
SELECT date, closing_price, sales_quantity FROM horticulture
WHERE closing_price IS DISTINCT FROM 0 AND {_where(LEAF)}
""",
)
def horticulture_leaf_series(spark: SparkSession, folder: str) -> DataFrame:
    return horticulture.leaf_series(standins.horticulture(spark, folder), LEAF)


@query(
    "horticulture_markets_of",
    HORTICULTURE_SQL
    + f"""
SELECT market_name, count(*) AS n,
       round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (), 4) AS share
FROM horticulture WHERE product = '{PRODUCT}' GROUP BY 1
""",
)
def horticulture_markets_of(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(
        horticulture.markets_of(standins.horticulture(spark, folder), PRODUCT), "share"
    )


@query(
    "horticulture_headline",
    HORTICULTURE_SQL
    + f"""
SELECT round_even(avg(closing_price), 0) AS avg_closing,
       round_even(avg(average_price), 0) AS avg_price,
       CAST(sum(closing_stock) AS BIGINT) AS closing_stock
FROM horticulture WHERE {_where(LEAF)}
""",
)
def horticulture_headline(spark: SparkSession, folder: str) -> DataFrame:
    return horticulture.headline(standins.horticulture(spark, folder), LEAF)


@query(
    "horticulture_descriptive_counts",
    HORTICULTURE_SQL
    + "SELECT "
    + ", ".join(f"count(DISTINCT {c}) AS {c}" for c in horticulture.DESCRIPTIVE)
    + " FROM horticulture",
)
def horticulture_descriptive_counts(spark: SparkSession, folder: str) -> DataFrame:
    return horticulture.descriptive_counts(standins.horticulture(spark, folder))


@query(
    "horticulture_market_averages",
    HORTICULTURE_SQL
    + "SELECT market_name, round(avg(closing_price), 4) AS avg_closing FROM horticulture GROUP BY 1",
)
def horticulture_market_averages(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(
        horticulture.market_averages(standins.horticulture(spark, folder)), "avg_closing"
    )


@query(
    "horticulture_market_volumes",
    HORTICULTURE_SQL
    + """
SELECT market_name, product, count(*) AS n, CAST(sum(sales_quantity) AS BIGINT) AS sales_quantity
FROM horticulture GROUP BY 1, 2
""",
)
def horticulture_market_volumes(spark: SparkSession, folder: str) -> DataFrame:
    return horticulture.market_volumes(standins.horticulture(spark, folder))


CLASS, OTHER, WEIGHT = "2-HIGH", "5-LOW", "F"


@query(
    "livestock_price_series",
    LIVESTOCK_SQL
    + f"""
SELECT date_to, class, avg_purch FROM livestock
WHERE avg_purch IS DISTINCT FROM 0 AND class = '{CLASS}'
""",
)
def livestock_price_series(spark: SparkSession, folder: str) -> DataFrame:
    return livestock.price_series(standins.livestock(spark, folder), CLASS)


@query(
    "livestock_all_classes",
    LIVESTOCK_SQL
    + "SELECT date_to, class, avg_purch FROM livestock WHERE avg_purch IS DISTINCT FROM 0",
)
def livestock_all_classes(spark: SparkSession, folder: str) -> DataFrame:
    return livestock.price_series(standins.livestock(spark, folder))


@query(
    "livestock_compare",
    LIVESTOCK_SQL
    + f"SELECT date_to, class, avg_purch FROM livestock WHERE class IN ('{CLASS}', '{OTHER}')",
)
def livestock_compare(spark: SparkSession, folder: str) -> DataFrame:
    return livestock.compare_classes(standins.livestock(spark, folder), CLASS, OTHER)


@query(
    "livestock_class_counts",
    LIVESTOCK_SQL
    + """
SELECT class, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total
FROM livestock GROUP BY 1
""",
)
def livestock_class_counts(spark: SparkSession, folder: str) -> DataFrame:
    return livestock.class_counts(standins.livestock(spark, folder))


@query(
    "livestock_headline",
    LIVESTOCK_SQL
    + f"""
SELECT round_even(avg(avg_purch), 0) AS avg_purch, round_even(avg(avg_mass), 0) AS avg_mass,
       round_even(avg(avg_selling), 0) AS avg_selling FROM livestock WHERE class = '{CLASS}'
""",
)
def livestock_headline(spark: SparkSession, folder: str) -> DataFrame:
    return livestock.headline(standins.livestock(spark, folder), CLASS)


@query(
    "pork_weight_counts",
    LIVESTOCK_SQL
    + f"""
SELECT class, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total
FROM livestock WHERE weight = '{WEIGHT}' GROUP BY 1
""",
)
def pork_weight_counts(spark: SparkSession, folder: str) -> DataFrame:
    return livestock.weight_counts(standins.livestock(spark, folder), WEIGHT)


_BAND = f"weight = '{WEIGHT}' AND class = '{CLASS}'"


@query(
    "pork_price_series",
    LIVESTOCK_SQL + f"SELECT date_to, avg_purch FROM livestock WHERE {_BAND}",
)
def pork_price_series(spark: SparkSession, folder: str) -> DataFrame:
    return livestock.pork_series(standins.livestock(spark, folder), WEIGHT, CLASS)


@query(
    "pork_measures",
    LIVESTOCK_SQL
    + f"""
SELECT date_to, 'Units' AS series, CAST(units AS DOUBLE) AS value FROM livestock WHERE {_BAND}
UNION ALL SELECT date_to, 'Mass', avg_mass FROM livestock WHERE {_BAND}
UNION ALL SELECT date_to, 'Price', avg_purch FROM livestock WHERE {_BAND}
""",
)
def pork_measures(spark: SparkSession, folder: str) -> DataFrame:
    return livestock.pork_measures(standins.livestock(spark, folder), WEIGHT, CLASS)


@query(
    "pork_headline",
    LIVESTOCK_SQL
    + f"""
SELECT round_even(avg(avg_purch), 0) AS avg_purch, round_even(avg(units), 0) AS avg_units,
       round_even(avg(avg_mass), 0) AS avg_mass FROM livestock WHERE {_BAND}
""",
)
def pork_headline(spark: SparkSession, folder: str) -> DataFrame:
    return livestock.pork_headline(standins.livestock(spark, folder), WEIGHT, CLASS)


@query(
    "livestock_class_averages",
    LIVESTOCK_SQL
    + """
SELECT class, market, round(avg(avg_purch), 4) AS avg_purch, round(avg(avg_mass), 4) AS avg_mass,
       round(avg(units), 4) AS avg_units FROM livestock GROUP BY 1, 2
""",
)
def livestock_class_averages(spark: SparkSession, folder: str) -> DataFrame:
    means = livestock.class_averages(standins.livestock(spark, folder), "market")
    return rounded(means, "avg_purch", "avg_mass", "avg_units")
