"""A table of versions: one folder for each load, published by an entry of its own.

``version=N`` holds what load N added, ``_entries/version=N`` one row that says so. A folder without
an entry is not part of the table: a load that failed leaves nothing behind that readers see, and
the next one takes its place. A table has one writer at a time, as its schedule has.
"""

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from dataclasses import fields as dataclass_fields
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemill.operators import profiles
from pricemill.sinks.tables import YEAR

VERSION, STATE = "version", "state"
#: States of a row: its key was new, or it took the place of a row with other values.
NEW, WON = "new", "won"
#: The hash of a row's values beside its key, which is stored with it.
HASH = "_hash"
#: Columns of the table's own.
OWN = (HASH, VERSION, STATE, YEAR)
DATED = (T.DateType, T.TimestampType, T.TimestampNTZType)
# What Spark reports for a folder that is not there or holds no files yet.
NOTHING_WRITTEN = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")

ENTRY = (
    "load string, batch bigint, replaces array<bigint>, counts map<string, bigint>, "
    "months array<struct<month: date, rows: bigint, first: date, last: date>>, blocks bigint, "
    "states array<string>, stored_schema string, profiled boolean"
)

#: Bits of a block of key bits, how many a key sets, and how many keys a block takes, about.
BLOCK_BITS = 32768
KEY_BITS = 5
BLOCK_KEYS = 3000


@dataclass(frozen=True)
class Entry:
    """What a version holds: the load it came with, and what that counted; or, from a compaction, the
    versions that it replaces. ``months`` are those of its keys, ``blocks`` those of its key bits."""

    version: int
    load: str | None = None
    batch: int | None = None
    replaces: tuple[int, ...] = ()
    counts: Mapping[str, int] = field(default_factory=dict)
    months: tuple[Row, ...] = ()
    blocks: int = 0
    states: tuple[str, ...] = ()
    stored_schema: str = ""
    profiled: bool = False

    @property
    def rows(self) -> int:
        return sum(m["rows"] for m in self.months)

    @property
    def fields(self) -> list[T.StructField]:
        return T.StructType.fromJson(json.loads(self.stored_schema)).fields


def history(spark: SparkSession, path: str) -> list[Entry]:
    """All entries, the oldest first. The list grows by one a load, not with the rows."""
    try:
        rows = spark.read.schema(f"{ENTRY}, {VERSION} bigint").parquet(f"{path}/_entries").collect()
    except AnalysisException as missing:
        if missing.getCondition() in NOTHING_WRITTEN:
            return []
        raise
    found = [
        Entry(
            r[VERSION],
            r.load,
            r.batch,
            tuple(r.replaces),
            dict(r["counts"]),
            tuple(r.months),
            r.blocks,
            tuple(r.states),
            r.stored_schema,
            bool(r.profiled),
        )
        for r in rows
    ]
    return sorted(found, key=lambda e: e.version)


def live(entries: Sequence[Entry]) -> list[Entry]:
    """Entries whose rows are in the table: those that have some and that no later one replaces."""
    gone = {v for e in entries for v in e.replaces}
    return [e for e in entries if e.version not in gone and e.states]


def next_version(entries: Sequence[Entry]) -> int:
    return entries[-1].version + 1 if entries else 0


def stale(spark: SparkSession, path: str) -> list[str]:
    """Folders that compactions have replaced, for whoever deletes files; readers that began
    before may still need them."""
    return [f"{path}/{VERSION}={v}" for e in history(spark, path) for v in e.replaces]


def small_frame(spark: SparkSession, records: Sequence[dict], fields: str) -> DataFrame:
    """A frame of a few records, made without a Python worker."""
    text = F.lit(json.dumps(records, default=str))
    return spark.range(1).select(F.inline(F.from_json(text, f"array<struct<{fields}>>")))


def publish(spark: SparkSession, path: str, entry: Entry) -> None:
    """Write a version's entry: from here on its rows are part of the table."""
    record = {f.name: getattr(entry, f.name) for f in dataclass_fields(entry)}
    record["months"] = [m.asDict() for m in entry.months]
    folder = f"{path}/_entries/{VERSION}={record.pop(VERSION)}"
    small_frame(spark, [record], ENTRY).write.mode("errorifexists").parquet(folder)


def stored_rows(
    spark: SparkSession, path: str, entries: Sequence[Entry], states: Sequence[str] = (NEW, WON)
) -> DataFrame | None:
    """Rows of these versions as written, with ``version``, ``state`` and ``year``; None if none."""
    chosen = [
        f"{path}/{VERSION}={e.version}/{STATE}={s}"
        for e in entries
        for s in states
        if s in e.states
    ]
    if not chosen:
        return None
    fields: dict[str, T.StructField] = {}
    for e in reversed(entries):  # the newest types, and columns that only older versions have
        for f in e.fields:
            fields.setdefault(f.name, f)
    parts = ((VERSION, T.LongType()), (STATE, T.StringType()), (YEAR, T.IntegerType()))
    schema = T.StructType([*fields.values(), *(T.StructField(*p) for p in parts)])
    return spark.read.schema(schema).option("basePath", path).parquet(*chosen)


def same_key(keys: Sequence[str], other: str = "_other_") -> Column:
    """Whether two rows have one key, NULL being a value; the other's columns have a prefix."""
    match: Column = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"{other}{k}"))
    return match


def current(
    spark: SparkSession,
    path: str,
    entries: Sequence[Entry],
    keys: Sequence[str],
    chosen: Sequence[Entry] | None = None,
) -> DataFrame | None:
    """Rows of the chosen versions (or all of these) but those that a later one has won against."""
    rows = stored_rows(spark, path, entries if chosen is None else chosen)
    winners = stored_rows(spark, path, entries, (WON,))
    if rows is None or winners is None:
        return rows
    winners = winners.select(
        *[F.col(k).alias(f"_other_{k}") for k in keys], F.col(VERSION).alias("_other_version")
    )
    later = same_key(keys) & (F.col("_other_version") > F.col(VERSION))
    return rows.join(winners, later, "left_anti")


def read(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame | None:
    """The table as it is now; None if nothing was ever added. ``year`` stays, to prune by."""
    rows = current(spark, path, live(history(spark, path)), keys)
    return None if rows is None else rows.drop(HASH, VERSION, STATE)


def put_aside(
    spark: SparkSession, path: str, kind: str, counted: tuple[str, ...]
) -> DataFrame | None:
    """Rows in ``_<kind>`` of the loads whose counts say that there are some, under names that begin
    with ``counted``; with their ``version``. None if no load has any."""
    entries = [
        e
        for e in history(spark, path)
        if any(n for name, n in e.counts.items() if name.startswith(counted))
    ]
    if not entries:
        return None
    folder = f"{path}/_{kind}"
    chosen = [f"{folder}/{VERSION}={e.version}" for e in entries]
    return spark.read.option("basePath", folder).option("mergeSchema", True).parquet(*chosen)


def counts(spark: SparkSession, path: str) -> DataFrame:
    """(load, batch, version, name, n): what each load has counted."""
    found = [
        {"load": e.load, "batch": e.batch, "version": e.version, "name": name, "n": n}
        for e in history(spark, path)
        for name, n in sorted(e.counts.items())
    ]
    fields = "load string, batch bigint, version bigint, name string, n bigint"
    return small_frame(spark, found, fields)


def write_profile(rows: DataFrame, path: str, version: int) -> None:
    """The profile of a version's rows, beside them."""
    own = profiles.profile(rows.drop(*OWN))
    own.write.mode("overwrite").parquet(f"{path}/_profiles/{VERSION}={version}")


def profile(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame | None:
    """The table's profile, one row per column, from those of its versions; None if it has no rows.

    Versions without a profile are read. Rows that others have won against would still count in
    the profiles of older versions, so a table that has some is read whole; a compaction takes them out.
    """
    alive = live(history(spark, path))
    if not alive:
        return None
    if any(WON in e.states for e in alive):
        return profiles.as_table(profiles.profile(current(spark, path, alive, keys).drop(*OWN)))
    folder = f"{path}/_profiles"
    found = None
    told = [f"{folder}/{VERSION}={e.version}" for e in alive if e.profiled]
    if told:
        found = spark.read.option("mergeSchema", True).parquet(*told)
    others = [e for e in alive if not e.profiled]
    if others:
        own = profiles.profile(stored_rows(spark, path, others).drop(*OWN))
        found = own if found is None else found.unionByName(own, allowMissingColumns=True)
    return profiles.as_table(profiles.merged(found))


# --- which versions may hold a key --------------------------------------------------------


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def is_dated(rows: DataFrame, day: str | None) -> bool:
    return day is not None and isinstance(rows.schema[day].dataType, DATED)


def month_of(rows: DataFrame, day: str | None) -> Column:
    """A key's month; one for all where there is no date."""
    first = F.trunc(F.col(day), "month") if is_dated(rows, day) else F.lit(None)
    return F.coalesce(first.cast("date"), F.lit("0001-01-01").cast("date"))


def _places(hashed: str, blocks: str) -> tuple[Column, Column]:
    """The block of a key, and its bits there."""
    bits = [F.pmod(F.xxhash64(hashed, F.lit(k)), F.lit(BLOCK_BITS)) for k in range(KEY_BITS)]
    return F.pmod(hashed, blocks), F.array(*bits)


def with_key_bits(rows: DataFrame, path: str, entry: Entry, keys: Sequence[str]) -> Entry:
    """Write a Bloom filter of a version's keys, in blocks of 4 KB, and note how many blocks."""
    blocks = 1
    while blocks * BLOCK_KEYS < entry.rows:
        blocks *= 2
    hashed = rows.select(key_hash(keys).alias("h"), F.lit(blocks).alias("blocks"))
    block, bits = _places("h", "blocks")
    marked = hashed.select(block.alias("block"), F.explode(bits).alias("bit"))
    blocked = marked.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))
    blocked.write.mode("overwrite").parquet(f"{path}/_keys/{VERSION}={entry.version}")
    return replace(entry, blocks=blocks)


def months(rows: DataFrame, day: str | None, *by: str) -> list[Row]:
    """The months of some rows: how many they are, and their first and last day."""
    on = F.col(day).cast("date") if is_dated(rows, day) else F.lit(None).cast("date")
    found = rows.groupBy(*by, month_of(rows, day).alias("month")).agg(
        F.count("*").alias("rows"), F.min(on).alias("first"), F.max(on).alias("last")
    )
    return found.collect()


def merged_months(found: Iterable[Row]) -> tuple[Row, ...]:
    """One row a month."""
    merged: dict[date, Row] = {}
    for m in found:
        both = [x for x in (merged.get(m["month"]), m) if x is not None]
        firsts = [x["first"] for x in both if x["first"] is not None]
        lasts = [x["last"] for x in both if x["last"] is not None]
        merged[m["month"]] = Row(
            month=m["month"],
            rows=sum(x["rows"] for x in both),
            first=min(firsts, default=None),
            last=max(lasts, default=None),
        )
    return tuple(merged[k] for k in sorted(merged))


def may_hold(
    spark: SparkSession,
    path: str,
    entries: Sequence[Entry],
    rows: DataFrame,
    keys: Sequence[str],
    day: str | None,
) -> list[Entry]:
    """The entries that may hold keys of ``rows``: by their months, then by their keys' bits.

    ``day`` is one of the keys, or None. Bits are read of versions that share a month with the rows,
    and rows of none. ``rows`` are read twice, so they should be kept.
    """
    wanted = {r[0] for r in rows.select(month_of(rows, day)).distinct().collect()}
    near = [e for e in entries if any(m["month"] in wanted for m in e.months)]
    if not near:
        return []
    # one row for each version and month that the loads so far have, whatever they hold
    shared = [
        {"version": e.version, "blocks": e.blocks, "month": m["month"]}
        for e in near
        for m in e.months
        if m["month"] in wanted
    ]
    listed = small_frame(spark, shared, "version bigint, blocks bigint, month date")
    hashed = rows.select(key_hash(keys).alias("h"), month_of(rows, day).alias("month"))
    block, bits = _places("h", "blocks")
    asked = hashed.join(F.broadcast(listed), "month").select(
        VERSION, block.alias("block"), bits.alias("places")
    )
    folder = f"{path}/_keys"
    kept = (
        spark.read.schema("block bigint, bits binary, version bigint")
        .option("basePath", folder)
        .parquet(*[f"{folder}/{VERSION}={e.version}" for e in near])
    )
    masks = F.array(*[F.lit(1 << k) for k in range(8)])

    def is_set(place: Column) -> Column:
        octet = F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1)))
        mask = F.get(masks, (place % 8).cast("int"))
        return F.conv(octet, 16, 10).cast("int").bitwiseAND(mask) > 0

    hits = asked.join(kept, [VERSION, "block"]).filter(F.forall("places", is_set))
    found = {r[0] for r in hits.select(VERSION).distinct().collect()}
    return [e for e in near if e.version in found]


# --- writing ------------------------------------------------------------------------------


def write_rows(
    rows: DataFrame, path: str, version: int, day: str | None, dealt: bool = False
) -> None:
    """Write rows with their ``state`` as a version: a folder of each state and year, and files in the
    order of the days. ``dealt`` rows have the partitions that they should have. What an attempt
    before has left there goes."""
    rows = rows.withColumn(YEAR, F.year(day) if is_dated(rows, day) else F.lit(None).cast("int"))
    rows = rows if dealt else rows.hint("rebalance", STATE, YEAR)
    rows = rows.sortWithinPartitions(STATE, YEAR, *([day] if day else []))
    rows.write.mode("overwrite").partitionBy(STATE, YEAR).parquet(f"{path}/{VERSION}={version}")


def compact(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    day: str | None = None,
    small: int = 10_000_000,
) -> Entry | None:
    """Rewrite the versions of fewer than ``small`` rows as one; None if there are fewer than two.

    Rows are split by ranges of days, so files don't overlap but at their borders. Readers see the old
    folders until the entry is written, and the new one from then on; a compaction that fails leaves a
    folder without an entry, which the next writer replaces. Rows that others have won against go.
    Won rows stay so while an older version may hold what they have won against.
    """
    entries = history(spark, path)
    alive = live(entries)
    chosen = [e for e in alive if e.rows < small]
    if len(chosen) < 2:
        return None
    rows = current(spark, path, alive, keys, chosen)
    states = tuple(s for s in (NEW, WON) if any(s in e.states for e in chosen))
    if len(chosen) == len(alive):
        rows, states = rows.withColumn(STATE, F.lit(NEW)), (NEW,)
    version = next_version(entries)
    ranges = [STATE, YEAR, *([day] if day else []), key_hash(keys)]
    rows = rows.repartitionByRange(*ranges).drop(VERSION, YEAR)
    write_rows(rows, path, version, day, dealt=True)
    entry = Entry(
        version,
        replaces=tuple(e.version for e in chosen),
        states=states,
        stored_schema=rows.drop(STATE).schema.json(),
    )
    written = stored_rows(spark, path, [entry])
    entry = replace(entry, months=merged_months(months(written, day)))
    entry = with_key_bits(written, path, entry, keys)
    if any(e.profiled for e in chosen):
        write_profile(written, path, version)
        entry = replace(entry, profiled=True)
    publish(spark, path, entry)
    return entry
