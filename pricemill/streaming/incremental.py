"""Load of new report files, one run per schedule tick, safe to repeat."""

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pricemill.operators.ordered import top_per_group
from pricemill.sinks import versions
from pricemill.sinks.tables import YEAR

#: The rules that a row in quarantine breaks.
BROKEN = "broken_rules"


def new_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    kind: str = "parquet",
    archive: str | None = None,
    **options: str,
) -> DataFrame:
    """Stream of the files that arrive in a folder; ``archive`` moves finished ones away."""
    reader = spark.readStream.format(kind).schema(schema).options(**options)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(folder)


def new_texts(spark: SparkSession, folder: str, archive: str | None = None) -> DataFrame:
    """Stream of arriving report files as ``read_whole_texts`` gives them: file_path and text."""
    texts = new_files(spark, folder, "value string", "text", archive, wholetext="true")
    return texts.select(
        F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("text")
    )


def newest_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """The newest row of each key; ``newest`` should tell all rows of a key apart."""
    return top_per_group(df, keys, [F.desc(c) for c in newest], 1)


def not_loaded(
    rows: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    day: str | None = None,
    first: Column | None = None,
) -> DataFrame:
    """Rows whose key the target lacks.

    When ``day`` is one of the keys, ``first`` is the first day of ``rows``: the part of the
    target before it cannot match and is not read; if the target has the partition column
    ``year``, its folders are not listed either. Rows without a day stay in.
    """
    if day is not None and first is not None:
        later = F.col(day) >= first
        if YEAR in target.columns:
            later = later & (F.col(YEAR) >= F.year(first))
        target = target.filter(later | F.col(day).isNull() & _no_year(target))
    known = target.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
    match: Column = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_known_{k}"))
    return rows.join(known, match, "left_anti")


def _no_year(target: DataFrame) -> Column:
    return F.col(YEAR).isNull() if YEAR in target.columns else F.lit(True)


#: What to do with a row whose key is loaded with other values.
WINNERS = ("first", "newest", "last")


def _counted(**what: Column) -> list[Column]:
    return [F.count_if(F.coalesce(test, F.lit(False))).alias(name) for name, test in what.items()]


def _judged(
    picked: DataFrame, known: DataFrame | None, keys: Sequence[str], newest: Sequence[str], winner: str
) -> DataFrame:
    """Rows with ``state``: new, same, won or lost, by the rows that the table has."""
    if known is None:
        return picked.withColumn(versions.STATE, F.lit(versions.NEW))
    taken = [*keys, *newest, versions.HASH, versions.VERSION]
    other = known.select(*[F.col(c).alias(f"_other_{c}") for c in dict.fromkeys(taken)])
    before = F.col(f"_other_{versions.VERSION}")
    wins = {
        "first": F.lit(False),
        "last": F.lit(True),
        "newest": F.struct(*newest) > F.struct(*[F.col(f"_other_{c}").alias(c) for c in newest]),
    }[winner]
    state = (
        F.when(before.isNull(), versions.NEW)
        .when(F.col(versions.HASH) == F.col(f"_other_{versions.HASH}"), "same")
        .when(wins, versions.WON)
        .otherwise("lost")
    )
    joined = picked.join(other, versions.same_key(keys), "left")
    return joined.select(
        *picked.columns, state.alias(versions.STATE), before.alias("known_version")
    )


def append_batch(
    path: str,
    keys: Sequence[str],
    newest: Sequence[str],
    clean: Callable[[DataFrame], DataFrame] | None = None,
    day: str | None = None,
    rules: Mapping[str, Column] | None = None,
    winner: str = "first",
    profiled: bool = False,
) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch``: clean, check, keep the newest row per key, add what is new.

    ``day``, if given, is a key column that bounds the versions to look at; if it holds dates, the rows
    of a batch are partitioned by its year. Rows that break one of the ``rules`` go to the quarantine,
    with the names of those they break; the counts are a by-product of that write.

    A row whose key the table has is the same, if its other values are; else there is a dispute, which
    ``winner`` decides: ``first`` keeps what is loaded, ``last`` takes what comes, ``newest`` takes it if
    the ``newest`` columns are larger. Either way the row that came is in the table of disputes. What a
    row's values are is compared by a hash of 64 bits that is stored with it. ``profiled`` batches store
    a profile of the rows they add, which ``versions.profile`` puts together.

    A batch is a version of the table (``sinks.versions``) and is seen once its entry is written. One that
    failed is written anew; one that is run again after that finds its rows by their keys and adds
    nothing.
    """
    if winner not in WINNERS:
        raise ValueError(f"winner is one of {', '.join(WINNERS)}")
    load = uuid.uuid4().hex

    def run(arrived: DataFrame, batch: int) -> None:
        spark = arrived.sparkSession
        entries = versions.history(spark, path)
        version = versions.next_version(entries)
        rows = clean(arrived) if clean else arrived
        clash = {*versions.OWN, "known_version", BROKEN} & set(rows.columns)
        if clash:
            raise ValueError(f"columns of the table's own: {', '.join(sorted(clash))}")
        values = [c for c in rows.columns if c not in keys] or keys
        found: dict[str, int] = {}
        kept = []
        try:
            if rules:
                rows, seen = quarantined(rows, rules, f"{path}/_quarantine/version={version}")
                found |= {(k if k == "rows" else f"broke_{k}"): n for k, n in seen.items()}
            else:
                rows = rows.persist()
            kept.append(rows)
            if rules:
                rows = rows.filter(F.size(BROKEN) == 0).drop(BROKEN)
            alive = versions.live(entries)
            held = versions.may_hold(spark, path, alive, rows, keys, day) if alive else []
            known = versions.current(spark, path, held, keys) if held else None
            hashed = rows.withColumn(versions.HASH, F.xxhash64(*values))
            picked = newest_per_key(hashed, keys, [*newest, versions.HASH])
            judged = _judged(picked, known, keys, newest, winner).persist()
            kept.append(judged)
            state = F.col(versions.STATE)
            held_months = versions.months(judged, day, versions.STATE)
            for name in (versions.NEW, "same", versions.WON, "lost"):
                found[name] = sum(m["rows"] for m in held_months if m[versions.STATE] == name)
            states = tuple(s for s in (versions.NEW, versions.WON) if found[s])
            added = judged.filter(state.isin(*states)).drop("known_version")
            entry = versions.Entry(
                version,
                load,
                batch,
                counts=found,
                months=versions.merged_months(m for m in held_months if m[versions.STATE] in states),
                states=states,
                stored_schema=added.drop(versions.STATE).schema.json(),
            )
            if states:
                versions.write_rows(added, path, version, day)
                entry = versions.with_key_bits(added, path, entry, keys)
                if profiled:
                    versions.write_profile(added, path, version)
                    entry = replace(entry, profiled=True)
            if found[versions.WON] or found["lost"]:
                disputed = judged.filter(state.isin(versions.WON, "lost")).drop(versions.HASH)
                disputed.write.mode("overwrite").parquet(f"{path}/_disputes/version={version}")
            versions.publish(spark, path, entry)
        finally:
            for frame in kept:
                frame.unpersist()

    return run


def quarantined(
    rows: DataFrame, rules: Mapping[str, Column], folder: str
) -> tuple[DataFrame, dict[str, int]]:
    """Rows with the names of the rules that they break, kept for further passes, and how many rows there
    are and break each rule. Those that break one are written to ``folder``."""
    broken = [F.when(F.coalesce(keep, F.lit(False)), None).otherwise(n) for n, keep in rules.items()]
    marked = rows.withColumn(BROKEN, F.array_compact(F.array(*broken))).persist()
    seen = Observation()
    tests = {name: F.array_contains(BROKEN, name) for name in rules}
    watched = marked.observe(seen, F.count(F.lit(1)).alias("rows"), *_counted(**tests))
    watched.filter(F.size(BROKEN) > 0).write.mode("overwrite").parquet(folder)
    return marked, seen.get


def load_new_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    newest: Sequence[str],
    clean: Callable[[DataFrame], DataFrame] | None = None,
    day: str | None = None,
    rules: Mapping[str, Column] | None = None,
    winner: str = "first",
    profiled: bool = False,
) -> StreamingQuery:
    """Load all files that are new since the last run, then stop.

    ``clean`` and ``rules`` are the same that the batch job uses.
    """
    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(append_batch(path, keys, newest, clean, day, rules, winner, profiled))
        .start()
    )


def quarantine(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows that broke rules, with the names of these and the ``version`` they came with."""
    return versions.put_aside(spark, path, "quarantine", ("broke_",))


def disputes(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows that came with other values for a key of the table: whether they won or lost (``state``),
    the ``version`` they came with, and the one that had the key (``known_version``)."""
    return versions.put_aside(spark, path, "disputes", (versions.WON, "lost"))
