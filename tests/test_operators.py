"""Operators on hand-made rows: NULL, NaN, zeros, ties."""

import math
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from pricemill.operators import filters, measures, ordered, quality, shape
from pricemill.schemas import CATTLE


def values(df, column):
    return sorted((getattr(r, column) for r in df.collect()), key=str)


# --- shape --------------------------------------------------------------------------------


def test_snake_names_and_union(rows):
    first = shape.snake_names(rows("`Market to Market` string, Conts string", ("1", "2")))
    assert first.columns == ["market_to_market", "conts"]
    other = rows("conts string", ("2",))
    merged = shape.union_by_name(first, other, other)
    assert sorted(map(str, merged.collect())) == sorted(
        map(
            str,
            rows(
                "market_to_market string, conts string", ("1", "2"), (None, "2"), (None, "2")
            ).collect(),
        )
    )


def test_trim_text_touches_text_only(rows):
    out = shape.trim_text(rows("a string, n int", ("  x\t", 1))).first()
    assert (out.a, out.n) == ("x", 1)


def test_text_to_double_range(rows):
    out = shape.text_to_double(rows("a string, b string, c string", ("1", "2,000", "3")), ("a", "b"))
    assert out.dtypes == [("a", "double"), ("b", "double"), ("c", "string")]
    assert out.first().b == 2000.0


def test_series_keeps_null(rows):
    out = shape.series(rows("d int, last double, bid int", (1, None, 2)), ["d"], {"last": "Last", "bid": "Bid"})
    assert sorted((r.series, r.value) for r in out.collect()) == [("Bid", 2.0), ("Last", None)]


def test_fill_zero_flags_null_and_nan(rows):
    df = rows("k string, x double, n int", ("a", None, 1), ("b", math.nan, 2), ("c", 1.0, 3), (None, 2.0, 4))
    out = {r.n: (r.k, r.x, r.was_null) for r in shape.fill_zero(df).collect()}
    assert out == {1: ("a", 0.0, True), 2: ("b", 0.0, True), 3: ("c", 1.0, False), 4: (None, 2.0, False)}


def test_conform_adds_missing_columns(rows):
    out = shape.conform(rows("class string, units string", ("A2", "12.0")), CATTLE.columns)
    assert out.columns == CATTLE.columns.fieldNames()
    assert (out.first().units, out.first().avg_mass) == (12, None)


def test_attach_keeps_unmatched(rows):
    out = shape.attach(rows("code string", ("a",), ("b",)), rows("code string, name string", ("a", "A")), "code")
    assert sorted((r.code, r.name or "") for r in out.collect()) == [("a", "A"), ("b", "")]


# --- filters ------------------------------------------------------------------------------


def test_zero_filters_differ_on_null(rows):
    df = rows("x double", (0.0,), (None,), (1.0,))
    assert values(filters.not_zero_keep_null(df, "x"), "x") == [1.0, None]
    assert values(filters.not_zero(df, "x"), "x") == [1.0]


def test_windows_are_strict(rows):
    df = rows("d date", (date(2022, 5, 8),), (date(2022, 5, 9),), (date(2023, 5, 8),), (date(2023, 5, 9),))
    assert filters.trailing(df, "d", "2023-05-08", 365).count() == 3
    assert filters.still_open(df, "d", "2023-05-08").count() == 1
    assert filters.since(df, "d", "2023-05-08", 365).count() == 4


def test_null_rules(rows):
    df = rows(
        "f string, a double, b string, c int",
        ("f1", None, None, None),
        ("f1", math.nan, "x", 1),
        ("f1", 1.0, None, None),
        ("f1", 1.0, "x", 1),
    )
    data = ["a", "b", "c"]
    assert filters.not_blank(df, data).count() == 3
    assert filters.complete(df).count() == 1
    assert filters.complete(df, ["b"]).count() == 2
    assert filters.max_nulls(df, 1, data).count() == 2
    assert filters.null_count_not(df, 3, data).count() == 3


def test_period_presets(rows):
    df = rows("d date", *[(date(2023, m, 15),) for m in range(1, 8)], (date(2022, 7, 15),), (date(2022, 7, 14),))
    counts = {p: filters.period(df, "d", p).count() for p in filters.PERIODS}
    assert counts == {"1m": 2, "6m": 7, "ytd": 7, "1y": 8, "all": 9}
    with pytest.raises(ValueError):
        filters.period_start(F.lit(None), "2w")


def test_price_policy(rows):
    df = rows("average_price double, closing_price double", (None, 5.0), (0.0, 6.0), (7.0, 8.0))
    assert values(filters.price_policy(df, "coalesce"), "average_price") == [0.0, 5.0, 7.0]
    assert values(filters.price_policy(df, "drop"), "average_price") == [0.0, 7.0]
    assert values(filters.price_policy(df, "nonzero"), "average_price") == [7.0]
    with pytest.raises(ValueError):
        filters.price_policy(df, "other")


def test_masks(rows):
    df = rows("u string", ("202 kg",), ("1 May 2023",), (None,))
    mask = F.col("u").rlike(r"\d{1,2} \w+ 20\d\d")
    assert filters.without(df, mask).count() == 2
    assert filters.containing(df, "u", "202").count() == 2


# --- measures -----------------------------------------------------------------------------


def test_groups_skip_null_keys(rows):
    df = rows("g string, x double", ("a", 1.0), ("a", math.nan), (None, 5.0), ("b", None))
    assert {r.g: r.n for r in measures.group_count(df, "g").collect()} == {"a": 2, "b": 1}
    means = {r.g: r.x for r in measures.average_by(df, ["g"], ["x"]).collect()}
    assert means == {"a": 1.0, "b": None}


def test_value_counts_order_and_share(rows):
    df = rows("g string, k int", ("a", 1), ("b", 1), ("b", 1), ("c", 2), (None, 1))
    out = measures.value_counts(df, "g", {"k": 1}, total=True).collect()
    assert [(r.g, r.n, r.total) for r in out] == [("b", 2, 3), ("a", 1, 3)]
    assert out[0].share == 2 / 3


def test_segment_share(rows):
    df = rows("d int, c string, m string, deals int", (1, "x", "a", 1), (1, "x", "b", 3), (2, "x", "a", 5))
    out = {(r.d, r.m): r.share for r in measures.segment_share(df, ["d", "c", "m"], ["d", "c"], "deals").collect()}
    assert out == {(1, "a"): 0.25, (1, "b"): 0.75, (2, "a"): 1.0}


def test_headline(rows):
    df = rows("bid double, stock int", (2.0, 1), (3.0, 2), (math.nan, 4))
    out = measures.headline(df, mean={"bid": "m"}, highest={"bid": "h"}, total={"stock": "s"}).first()
    assert (out.m, out.h, out.s) == (2.0, 3.0, 7)


def test_distinct_and_null_counts(rows):
    df = rows("a string, x double", ("p", 1.0), (None, math.nan), ("p", None))
    assert measures.distinct_counts(df, ["a"]).first().a == 1
    assert measures.distinct_counts(df, ["a"], null_is_value=True).first().a == 2
    assert measures.distinct_counts(df, ["a"], error=0.05).first().a == 1
    assert tuple(measures.null_counts(df).first()) == (1, 2)
    profile = {r.column_name: (r.dtype, r.rows, r.non_null) for r in measures.table_profile(df).collect()}
    assert profile == {"a": ("string", 3, 2), "x": ("double", 3, 1)}


def test_extremes(rows):
    df = rows("g int, last double, d date", (1, 5.0, date(2023, 1, 2)), (1, 3.0, date(2023, 5, 8)))
    span = measures.price_range(df, ["g"], "last", "d").first()
    assert tuple(span) == (1, 3.0, 5.0, "January 02, 2023", "May 08, 2023")
    assert measures.at_extreme(df, ["g"], "last", "d", highest=False).first().d == date(2023, 5, 8)


def test_facet_options(rows):
    df = rows("m string, p string", ("a", "x"), ("a", "y"), ("b", "z"))
    assert values(measures.facet_options(df, ["m", "p"], {}), "m") == ["a", "b"]
    assert values(measures.facet_options(df, ["m", "p"], {"m": "a"}), "p") == ["x", "y"]
    with pytest.raises(ValueError):
        measures.facet_options(df, ["m", "p"], {"p": "x"})


# --- ordered ------------------------------------------------------------------------------

SECTION_ROWS = [
    ("f1", 0, "10 kg"),
    ("f1", 1, "D1"),
    ("f1", 2, "11 kg"),
    ("f1", 3, "D2"),
    ("f1", 4, "12 kg"),
    ("f1", 5, "D1"),
    ("f1", 6, "13 kg"),
    ("f2", 0, "20 kg"),
    (None, 0, "D3"),
    (None, 1, "30 kg"),
]


@pytest.mark.parametrize("span", [ordered.ROWS_PER_SPAN, 2, 1])
def test_sections(rows, span):
    df = rows("f string, pos int, u string", *SECTION_ROWS)
    out = ordered.sections(df, ["f"], ["pos"], F.col("u").startswith("D"), "u", "d", span)
    assert {(r.f, r.u): r.d for r in out.collect()} == {
        ("f1", "10 kg"): None,
        ("f1", "11 kg"): "D1",
        ("f1", "12 kg"): "D2",
        ("f1", "13 kg"): "D1",
        ("f2", "20 kg"): None,
        (None, "30 kg"): "D3",
    }


@pytest.mark.parametrize("span", [ordered.ROWS_PER_SPAN, 2, 1])
def test_drop_repeats(rows, span):
    data = [(1, "a"), (2, "a"), (3, None), (4, None), (5, "a"), (6, "b"), (7, "b"), (8, "b")]
    df = rows("pos int, c string", *data)
    out = ordered.drop_repeats(df, [], ["pos"], "c", span)
    assert out.columns == ["pos", "c"]
    assert values(out, "pos") == [1, 3, 5, 6]


@pytest.mark.parametrize("span", [ordered.ROWS_PER_SPAN, 7])
def test_number_rows(rows, span):
    data = [(i * 37 % 101, "g" if i % 3 else "h") for i in range(101)]
    df = rows("x int, g string", *data)
    whole = ordered.number_rows(df, [], ["x"], rows_per_span=span).collect()
    assert all(r.row_no == r.x + 1 for r in whole)
    grouped = ordered.number_rows(df, ["g"], ["x"], rows_per_span=span).collect()
    for g in "gh":
        mine = sorted((r.x, r.row_no) for r in grouped if r.g == g)
        assert [n for _, n in mine] == list(range(1, len(mine) + 1))


def test_spans_follow_the_order_through_ties_and_nulls(rows):
    # Half of the hot group shares two days or has none; the id breaks the ties.
    draw = random.Random(3)
    data = [
        (draw.choice(["hot", "hot", "hot", "cold"]), draw.choice([None, 1, 2, draw.randint(3, 400)]), i)
        for i in range(600)
    ]
    draw.shuffle(data)
    df = rows("g string, day int, id int", *data)
    cut = ordered.with_spans(df, ["g"], ["day", "id"], 12).collect()
    hot = sorted((r.day is not None, r.day or 0, r.id, r._span) for r in cut if r.g == "hot")
    spans = [span for *_, span in hot]
    assert spans == sorted(spans)
    assert all(r._hot for r in cut)
    assert max(spans.count(s) for s in set(spans)) < 60
    value = F.when(F.col("id") % 7 == 0, F.col("id"))
    out = ordered.fill_forward(df, ["g"], ["day", "id"], value, "v", 12).collect()
    for g in ("hot", "cold"):
        seen = None
        for r in sorted((r for r in out if r.g == g), key=lambda r: (r.day is not None, r.day or 0, r.id)):
            seen = r.id if r.id % 7 == 0 else seen
            assert r.v == seen


def test_blocks(rows):
    df = rows("f string, pos int", *[("f1", i) for i in range(10)], ("f2", 3))
    out = ordered.label_blocks(df, ["f"], ["pos"], ["w0", "w1"], 3, "w")
    assert sorted((r.f, r.pos, r.w) for r in out.collect()) == [
        ("f1", 0, "w0"), ("f1", 1, "w0"), ("f1", 2, "w0"),
        ("f1", 3, "w1"), ("f1", 4, "w1"), ("f1", 5, "w1"),
        ("f2", 3, "w0"),
    ]


def test_large_limits_take_the_same_rows(rows):
    df = rows("g string, x int", *[("a", i) for i in range(2500)], ("b", 1))
    out = ordered.top_per_group(df, ["g"], ["x"], 2000).collect()
    assert sorted((r.g, r.x) for r in out) == [("a", i) for i in range(2000)] + [("b", 1)]


def test_spread_first(rows):
    df = rows("f string, pos int, v string", ("a", 2, "x"), ("a", 1, None), (None, 5, "z"), (None, 6, "y"))
    out = ordered.spread_first(df, ["f"], ["pos"], [("v", "head"), ("pos", "at")])
    assert {(r.f, r.pos): (r.head, r.at) for r in out.collect()} == {
        ("a", 2): (None, 1), ("a", 1): (None, 1), (None, 5): ("z", 5), (None, 6): ("z", 5),
    }


# --- quality ------------------------------------------------------------------------------


def test_checks_on_report_traits(rows):
    # The traits of a real load: a week loaded twice with different values, a false zero.
    schema = "class string, date_from date, selling_max double"
    df = rows(
        schema,
        ("A2", date(2022, 5, 16), 60.0),
        ("A2", date(2022, 5, 16), 61.0),
        ("A3", date(2022, 5, 16), 0.0),
        ("x" * 31, date(2022, 5, 23), None),
    )
    keys = ["class", "date_from"]
    conflicts = quality.key_conflicts(df, keys).collect()
    assert [(r["class"], r.n) for r in conflicts] == [("A2", 2)]
    kept = quality.keep_winner(df, keys, [F.desc("selling_max")])
    assert values(kept, "selling_max") == [0.0, 61.0, None]
    counts = quality.check_counts(df, ["selling_max"], {"class": 30}).first()
    assert tuple(counts) == (1, 1)
    good, bad = quality.quarantine(df, ["selling_max"], {"class": 30})
    assert (good.count(), bad.count()) == (3, 1)
    nothing, _ = quality.quarantine(df, [])
    assert nothing.count() == 4


def test_losses_as_aggregate_and_as_observation(rows):
    df = rows("x double", (None,), (1.0,), (0.0,))
    rules = {"missing": F.col("x").isNotNull(), "zero": F.col("x") != 0}
    assert tuple(quality.rule_losses(df, rules).first()) == (3, 1, 2)
    watched, seen = quality.observe_losses(df, rules)
    watched.collect()
    assert seen.get == {"rows": 3, "missing": 1, "zero": 2}


def test_spans_cut_groups_with_few_order_values(spark):
    df = spark.range(20_000).selectExpr("0 AS g", "id % 40 AS day", "id AS v")
    spans = ordered.with_spans(df, ["g"], ["day"], 1000)
    sizes = [r["count"] for r in spans.groupBy("_span").count().collect()]
    assert len(sizes) > 5 and sum(sizes) == 20_000
    one = ordered.with_spans(df.withColumn("day", F.lit(1)), ["g"], ["day"], 1000)
    assert one.filter("_hot").count() in (0, 20_000)  # one value can't be cut


@pytest.mark.parametrize("n", [3, 1500])
def test_last_rows_of_groups(spark, n):
    df = spark.range(4000).selectExpr("nullif(id % 2, 1) AS g", "id AS v")
    found = ordered.top_per_group(df, ["g"], ["v"], n, descending=True).collect()
    assert sorted(r.v for r in found) == list(range(4000 - 2 * n, 4000))
