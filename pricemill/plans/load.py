"""The load job of a family: cleaned report rows into its table, with every lost row counted."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricemill.operators import quality
from pricemill.schemas import PriceTable
from pricemill.sinks.keys import in_step, without_known, write_keys
from pricemill.sinks.tables import YEAR, write_table
from pricemill.sinks.versions import NOTHING_WRITTEN
from pricemill.streaming.incremental import not_loaded


@dataclass(frozen=True)
class Loaded:
    """Rows read, rows that broke each rule, keys that had several rows, and rows added."""

    rows: int
    lost: dict[str, int]
    conflicts: int
    added: int


def rules_of(table: PriceTable) -> dict[str, Column]:
    """What a row must meet: a date, its keys, and texts no longer than the table allows."""
    rules = {f"no_{c}": F.col(c).isNotNull() for c in dict.fromkeys((table.date, *table.keys))}
    for column, limit in table.max_length.items():
        rules[f"long_{column}"] = F.col(column).isNull() | (F.length(column) <= limit)
    return rules


def load(
    rows: DataFrame,
    table: PriceTable,
    path: str,
    winner: Sequence[str | Column] = (),
    key_table: str | None = None,
) -> Loaded:
    """Append to the year-partitioned table at ``path`` what it lacks.

    Rows that break a rule stay out and are counted. Of rows with one key the first in the order
    of ``winner`` stays (the other columns decide where it doesn't); a table without keys has whole
    rows as keys. Keys that the table has already are not added again, so a repeated load, or one
    that overlaps another, adds nothing twice. Only years from the first new date on are read.
    The cleaned rows are kept for the job's passes and computed once.

    ``key_table`` names a bucketed table of the catalog (``sinks.keys``) that holds the target's keys: new
    rows are then found by it, and the target is neither read nor shuffled. If a load has failed
    before its keys were written, the next one makes that table anew from the target.
    """
    spark = rows.sparkSession
    columns = table.stored.fieldNames()
    typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.stored])
    kept = [typed.persist()]
    try:
        rules = rules_of(table)
        counts = quality.rule_losses(typed, rules).first().asDict()
        good = typed
        for keep in rules.values():
            good = good.filter(keep)
        keys = list(table.keys or columns)
        conflicts = quality.key_conflicts(good, keys).count()
        order = [*winner, *columns]
        new = quality.keep_winner(good, keys, order) if table.keys else good.distinct()
        first = good.agg(F.min(table.date)).first()[0]
        try:
            before = spark.read.parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() not in NOTHING_WRITTEN:
                raise
            before = None
        if before is not None and key_table is None:
            bound = F.lit(first).cast("date") if first is not None else None
            # a key may have moved to another date: only keys with the date in them prune by it
            day = table.date if table.date in keys else None
            new = not_loaded(new, before, keys, day, bound)
        elif before is not None:
            if not in_step(spark, key_table, before):
                write_keys(before, key_table, keys, mode="overwrite", location=f"{path}_keys")
            new = without_known(new, key_table, keys)
        kept.append(new.persist())
        added = new.count()
        if added:
            write_table(new.select(*columns), path, table.date)
            if key_table is not None:
                mode = "overwrite" if before is None else "append"
                write_keys(new, key_table, keys, mode=mode, location=f"{path}_keys")
    finally:
        for frame in kept:
            frame.unpersist()
    total = counts.pop("rows")
    return Loaded(total, counts, conflicts, added)


def read(spark, path: str) -> DataFrame:
    """A loaded table, without its partition column."""
    return spark.read.parquet(path).drop(YEAR)
