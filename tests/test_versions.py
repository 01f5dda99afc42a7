"""Tables of versions: corrected rows, broken rules, failed and repeated loads, compaction."""

import random
from datetime import date, timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pricemill.operators import profiles
from pricemill.sinks import tables, versions
from pricemill.streaming import incremental

SCHEMA = "k bigint, day date, price double, issue int"
KEYS = ["k", "day"]


def batch(spark, path, rows, number=0, **options):
    """One batch of a load, and what it counted."""
    run = incremental.append_batch(str(path), KEYS, ["issue"], day="day", **options)
    run(spark.createDataFrame(rows, SCHEMA), number)
    return versions.history(spark, str(path))[-1].counts


def table(spark, path):
    rows = versions.read(spark, str(path), KEYS)
    return sorted(map(tuple, rows.select("k", "day", "price", "issue").collect()), key=str)


D1, D2 = date(2023, 5, 1), date(2024, 6, 2)
FIRST = [(1, D1, 1.0, 1), (2, D2, 2.0, 1), (3, None, 3.0, 1), (None, D1, 4.0, 1)]
SECOND = [
    (1, D1, 9.0, 2),  # corrected
    (2, D2, 2.0, 1),  # the same
    (3, None, None, 0),  # other values, older
    (None, D1, 4.5, 2),  # corrected, its key NULL
    (5, D2, 5.0, 1),  # new
    (5, D2, 6.0, 0),  # an older one of the same batch
]


@pytest.mark.parametrize(
    ("winner", "now", "won"),
    [
        ("first", {1: 1.0, 2: 2.0, 3: 3.0, None: 4.0, 5: 5.0}, 0),
        ("newest", {1: 9.0, 2: 2.0, 3: 3.0, None: 4.5, 5: 5.0}, 2),
        ("last", {1: 9.0, 2: 2.0, 3: None, None: 4.5, 5: 5.0}, 3),
    ],
)
def test_the_stated_winner_stays(spark, tmp_path, winner, now, won):
    assert batch(spark, tmp_path, FIRST, winner=winner) == {"new": 4, "same": 0, "won": 0, "lost": 0}
    counts = batch(spark, tmp_path, SECOND, winner=winner)
    assert counts == {"new": 1, "same": 1, "won": won, "lost": 3 - won}
    assert {r[0]: r[2] for r in table(spark, tmp_path)} == now
    disputed = incremental.disputes(spark, str(tmp_path)).collect()
    assert sorted((str(r.k), r.price or 0) for r in disputed) == [("1", 9.0), ("3", 0), ("None", 4.5)]
    assert {(r.version, r.known_version) for r in disputed} == {(1, 0)}
    assert sum(r.state == "won" for r in disputed) == won
    # the same batch again, with a checkpoint of its own
    again = batch(spark, tmp_path, SECOND, winner=winner)
    assert again["new"] == 0 and again["won"] == 0
    assert {r[0]: r[2] for r in table(spark, tmp_path)} == now


def test_values_that_come_back_are_corrections(spark, tmp_path):
    for n, price in enumerate((1.0, 2.0, 1.0, 1.0)):
        batch(spark, tmp_path, [(1, D1, price, n)], winner="newest")
    assert table(spark, tmp_path) == [(1, D1, 1.0, 3)]
    assert [e.counts["won"] for e in versions.history(spark, str(tmp_path))] == [0, 1, 1, 1]


def test_rows_that_break_rules_are_counted_and_kept_apart(spark, tmp_path):
    rules = {"priced": F.col("price") > 0, "dated": F.col("day").isNotNull()}
    rows = [*FIRST, (7, None, None, 1), (8, D1, -1.0, 1)]
    counts = batch(spark, tmp_path, rows, rules=rules)
    assert counts == {
        "rows": 6, "broke_priced": 2, "broke_dated": 2, "new": 3, "same": 0, "won": 0, "lost": 0
    }
    bad = {r.k: r.broken_rules for r in incremental.quarantine(spark, str(tmp_path)).collect()}
    assert bad == {3: ["dated"], 7: ["priced", "dated"], 8: ["priced"]}
    assert [r[0] for r in table(spark, tmp_path)] == [1, 2, None]
    assert batch(spark, tmp_path, [], rules=rules)["rows"] == 0
    assert incremental.quarantine(spark, str(tmp_path)).count() == 3
    assert versions.counts(spark, str(tmp_path)).filter("name = 'broke_priced'").count() == 2


def test_a_load_that_fails_before_its_entry_is_not_seen(spark, tmp_path, monkeypatch):
    batch(spark, tmp_path, FIRST)

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "publish", broken)
        with pytest.raises(OSError, match="lost"):
            batch(spark, tmp_path, SECOND)
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == 0
    assert len(table(spark, tmp_path)) == 4
    assert batch(spark, tmp_path, SECOND)["new"] == 1
    assert len(table(spark, tmp_path)) == 5


def test_names_of_the_tables_own_are_refused(spark, tmp_path):
    run = incremental.append_batch(str(tmp_path), ["k"], ["version"])
    with pytest.raises(ValueError, match="own"):
        run(spark.createDataFrame([(1, 2)], "k int, version int"), 0)
    with pytest.raises(ValueError, match="winner"):
        incremental.append_batch(str(tmp_path), ["k"], [], winner="best")


def test_columns_may_be_added(spark, tmp_path):
    run = incremental.append_batch(str(tmp_path), ["k"], ["n"])
    run(spark.createDataFrame([(1, 1)], "k int, n int"), 0)
    run(spark.createDataFrame([(2, 1, "x")], "k int, n int, more string"), 1)
    rows = versions.read(spark, str(tmp_path), ["k"]).select("k", "n", "more").collect()
    assert sorted(map(tuple, rows)) == [(1, 1, None), (2, 1, "x")]


def test_only_versions_that_may_hold_a_key_are_read(spark, tmp_path):
    for n in range(4):
        batch(spark, tmp_path, [(100 * n + k, D1, 1.0, 1) for k in range(50)])
    batch(spark, tmp_path, [(k, D2, 1.0, 1) for k in range(50)])
    alive = versions.live(versions.history(spark, str(tmp_path)))

    def held(*rows):
        frame = spark.createDataFrame(list(rows), SCHEMA)
        found = versions.may_hold(spark, str(tmp_path), alive, frame, KEYS, "day")
        return [e.version for e in found]

    assert held((203, D1, 0.0, 0)) == [2]
    assert held((3, D2, 0.0, 0), (301, D1, 0.0, 0)) == [3, 4]
    assert held((1, date(1999, 1, 1), 0.0, 0)) == held((1, None, 0.0, 0)) == []
    known = versions.current(spark, str(tmp_path), [alive[2]], KEYS)
    assert {f.split("version=")[1].split("/")[0] for f in known.inputFiles()} == {"2"}


def test_bits_have_all_keys_and_few_others(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("id k", "DATE '2023-05-01' day", "1.0D price", "1 issue")
    incremental.append_batch(str(tmp_path), KEYS, ["issue"], day="day")(rows, 0)
    entry = versions.history(spark, str(tmp_path))[0]
    assert entry.blocks == 8 and entry.rows == 20_000
    found = 0
    for k in range(200):
        one = spark.range(1).selectExpr(f"{k * 100 + 50_000 * (k % 2)}L k", "DATE '2023-05-01' day")
        hit = bool(versions.may_hold(spark, str(tmp_path), [entry], one, KEYS, "day")) if k < 40 else k % 2 == 0
        assert hit or k % 2
        found += hit and k % 2
    assert found <= 1


def months_of_loads(spark, path, loads=6, seed=5):
    """Random loads with corrections and old rows; returns the rows that should stand."""
    dice, now = random.Random(seed), {}
    for n in range(loads):
        rows = {}
        for _ in range(60):
            key = (dice.randrange(80), dice.choice([None, D1, D1 + timedelta(dice.randrange(900))]))
            rows[key] = (*key, float(dice.randrange(3)), dice.randrange(4) + n // 2)
        for key, row in rows.items():
            if key not in now or now[key][2:] != row[2:] and row[3] > now[key][3]:
                now[key] = row
        batch(spark, path, list(rows.values()), winner="newest")
    return now


def test_compaction_changes_no_row_and_leaves_fewer_files(spark, tmp_path):
    now = months_of_loads(spark, tmp_path)
    expected = sorted(now.values(), key=str)
    assert table(spark, tmp_path) == expected
    before = len(versions.read(spark, str(tmp_path), KEYS).inputFiles())
    old = versions.live(versions.history(spark, str(tmp_path)))
    entry = versions.compact(spark, str(tmp_path), KEYS, "day")
    assert table(spark, tmp_path) == expected
    rows = versions.read(spark, str(tmp_path), KEYS)
    assert len(rows.inputFiles()) < before / 2
    assert "BroadcastHashJoin" not in rows._jdf.queryExecution().executedPlan().toString()
    assert entry.replaces == tuple(e.version for e in old)
    assert len(versions.stale(spark, str(tmp_path))) == len(old)
    assert versions.compact(spark, str(tmp_path), KEYS, "day") is None
    # loads go on after it, and find their keys
    again = [(r[0], r[1], r[2], r[3]) for r in expected[:20]]
    assert batch(spark, tmp_path, again, winner="newest")["same"] == 20
    assert incremental.disputes(spark, str(tmp_path)).count() > 0


def test_compaction_of_some_versions_brings_no_old_row_back(spark, tmp_path):
    big = [(k, D1, 1.0, 1) for k in range(100)]
    batch(spark, tmp_path, big, winner="newest")
    batch(spark, tmp_path, [(1, D1, 2.0, 2), (200, D1, 1.0, 1)], winner="newest")
    batch(spark, tmp_path, [(200, D1, 2.0, 2)] + [(k, D1, 3.0, 3) for k in range(1, 60)], winner="newest")
    batch(spark, tmp_path, [(1, D1, 4.0, 4), (300, D1, 1.0, 1)], winner="newest")
    expected = table(spark, tmp_path)
    assert versions.compact(spark, str(tmp_path), KEYS, "day", small=50).states == ("new", "won")
    assert table(spark, tmp_path) == expected
    assert versions.compact(spark, str(tmp_path), KEYS, "day") is not None
    assert table(spark, tmp_path) == expected and len(expected) == 102


def test_a_compaction_that_fails_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    now = months_of_loads(spark, tmp_path, loads=3)

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "publish", broken)
        with pytest.raises(OSError, match="lost"):
            versions.compact(spark, str(tmp_path), KEYS, "day")
    assert table(spark, tmp_path) == sorted(now.values(), key=str)
    batch(spark, tmp_path, [(999, D1, 1.0, 1)], winner="newest")
    assert len(table(spark, tmp_path)) == len(now) + 1
    assert versions.compact(spark, str(tmp_path), KEYS, "day") is not None
    assert len(table(spark, tmp_path)) == len(now) + 1


def ranges_of_row_groups(path, column):
    """(first, last) of a column in each row group of a file."""
    meta = pq.ParquetFile(path).metadata
    for g in range(meta.num_row_groups):
        group = meta.row_group(g)
        for c in range(group.num_columns):
            if group.column(c).path_in_schema == column:
                yield group.column(c).statistics.min, group.column(c).statistics.max


@pytest.mark.parametrize("kind", ["versions", "table"])
def test_row_groups_of_a_file_do_not_overlap_in_date(spark, tmp_path, kind):
    days = "date_add(DATE '2023-01-01', CAST(pmod(xxhash64(id), 360) AS INT)) day"
    rows = spark.range(200_000).selectExpr("id k", days, "rand(1) price", "1 issue")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "200000")
    try:
        if kind == "versions":
            incremental.append_batch(str(tmp_path), KEYS, ["issue"], day="day")(rows, 0)
        else:
            tables.write_table(rows, str(tmp_path), "day")
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    found = [p for p in Path(tmp_path).rglob("*.parquet") if "/year=" in str(p)]
    groups = [list(ranges_of_row_groups(p, "day")) for p in found]
    assert max(map(len, groups)) > 3
    for listed in groups:
        assert all(a[1] <= b[0] for a, b in zip(listed, listed[1:], strict=False))


def profile_rows(df):
    return {r.column_name: r for r in df.collect()}


def test_profiles_of_loads_are_the_tables(spark, tmp_path):
    run = incremental.append_batch(str(tmp_path), KEYS, ["issue"], day="day", profiled=True)
    every = []
    for n in range(3):
        rows = [(k, D1 + timedelta(k % 40), None if k % 7 else k / 3, n) for k in range(n * 500, n * 500 + 900)]
        run(spark.createDataFrame(rows, SCHEMA), n)
        every += rows
    found = profile_rows(versions.profile(spark, str(tmp_path), KEYS))
    assert not any("version=" in f and "/state=" in f for f in versions.profile(spark, str(tmp_path), KEYS).inputFiles())
    whole = profiles.profile(versions.read(spark, str(tmp_path), KEYS).drop("year"))
    expected = profile_rows(profiles.as_table(whole))
    assert set(found) == {"k", "day", "price", "issue"}
    for name, row in found.items():
        for field in ("dtype", "rows", "non_null", "low", "high"):
            assert row[field] == expected[name][field], (name, field)
    assert found["k"].rows == len({(r[0], r[1]) for r in every}) and found["day"].low == "2023-05-01"
    assert abs(found["k"].about_distinct - 1900) < 0.05 * 1900
    # a correction: the profiles of the loads would count the row that lost
    batch(spark, tmp_path, [(0, D1, 5.0, 9)], 3, winner="newest")
    assert profile_rows(versions.profile(spark, str(tmp_path), KEYS))["k"].rows == found["k"].rows
    versions.compact(spark, str(tmp_path), KEYS, "day")
    entry = versions.history(spark, str(tmp_path))[-1]
    assert entry.profiled and versions.live(versions.history(spark, str(tmp_path))) == [entry]
    assert profile_rows(versions.profile(spark, str(tmp_path), KEYS))["issue"].high == "9"


def test_profiles_of_nothing_and_of_odd_values(spark, tmp_path):
    assert versions.profile(spark, str(tmp_path), KEYS) is None
    odd = spark.createDataFrame([(float("nan"), None), (1.5, ""), (None, "é")], "x double, t string")
    parts = profiles.profile(odd).union(profiles.profile(odd.limit(0)))
    found = profile_rows(profiles.as_table(profiles.merged(parts)))
    assert (found["x"].rows, found["x"].non_null, found["x"].low, found["x"].about_distinct) == (3, 1, "1.5", 1)
    assert (found["t"].non_null, found["t"].low, found["t"].high) == (2, "", "é")
    none = profile_rows(profiles.as_table(profiles.merged(parts.limit(0))))
    assert (none["x"].rows, none["x"].non_null, none["x"].low, none["x"].about_distinct) == (0, 0, None, 0)
