"""Quality rules: counts of each text, and lines that too many documents of a host share."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricemill.llm.common import BLANK_CHARACTERS, BLANKS, pick, stored

SYMBOLS = "#*$%&|<>"
#: Words of the windows that are counted as repeats.
WINDOW = 8
#: Rows of (host, line) above the limits up to which they are sent to every task: 16 bytes each.
BROADCAST_LINES = 1_000_000
#: Lines of a host that a look-up goes through, about.
BUCKET_LINES = 8


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANK_CHARACTERS))
    none = F.array().cast("array<string>")
    return F.when(F.length(trimmed) > 0, F.split(trimmed, BLANKS)).otherwise(none)


def lines_of(text: Column) -> Column:
    """The lines with a word."""
    filled = lambda line: F.length(F.btrim(line, F.lit(BLANK_CHARACTERS))) > 0
    return F.filter(F.split(text, "\n"), filled)


def line_hash(line: Column) -> Column:
    """The hash of a line without regard to case and to runs of blanks."""
    return F.xxhash64(
        F.regexp_replace(F.btrim(F.lower(line), F.lit(BLANK_CHARACTERS)), BLANKS, " ")
    )


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in windows whose words occur twice or more, first ones included."""

    def counted(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, k: F.struct(h.alias("h"), k.alias("k")))
        return bound(F.sort_array(pairs), among)

    def among(pairs: Column) -> Column:
        def repeats(k: Column) -> Column:
            own = F.get(pairs, k)["h"]
            before, after = F.get(pairs, k - 1)["h"], F.get(pairs, k + 1)["h"]
            return own.eqNullSafe(before) | own.eqNullSafe(after)

        chosen = F.filter(F.sequence(F.lit(0), F.size(pairs) - 1), repeats)
        return bound(F.sort_array(F.transform(chosen, lambda k: F.get(pairs, k)["k"])), covered)

    def covered(starts: Column) -> Column:
        following = F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1)))
        steps = F.zip_with(
            starts, following, lambda a, b: F.least(F.coalesce(b - a, F.lit(window)), F.lit(window))
        )
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def of(words: Column) -> Column:
        last = F.size(words) - (window - 1)
        hashes = F.transform(
            F.sequence(F.lit(1), last), lambda k: F.xxhash64(F.slice(words, k, window))
        )
        some = bound(
            hashes,
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
                counted(h)
            ),
        )
        return F.when(last < 2, F.lit(0)).otherwise(some)

    return bound(words, of)


def measures(text: Column) -> dict[str, Column]:
    """The counts of one text; a NULL text counts as an empty one."""
    text = F.coalesce(text, F.lit(""))
    words = bound(
        words_of(text),
        lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("repeats")),
    )
    duplicates = bound(lines_of(text), lambda x: F.size(x) - F.size(F.array_distinct(x)))
    return {
        "words": words,
        "word_chars": F.length(F.translate(text, BLANK_CHARACTERS, "")).cast("bigint"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint"),
        "n_dup_lines": duplicates.cast("bigint"),
    }


def frequent_lines(
    rows: DataFrame, min_documents: int, share: float, name: str = "frequent-lines"
) -> DataFrame:
    """(host, line): hashed lines that too many distinct documents of a host have.

    Copies of one text count as one document, so that a text copied a thousand times does not
    turn its own lines into boilerplate. Counting is a distinct and a count, both combined in the
    map tasks, so a hot line or host costs each task one row.
    """
    documents = rows.select("host", F.xxhash64("text").alias("document"), "text")
    lines = documents.select(
        "host",
        "document",
        F.explode(F.array_distinct(F.transform(lines_of(F.col("text")), line_hash))).alias("line"),
    ).distinct()
    counts = lines.groupBy("host", "line").agg(F.count("*").alias("n"))
    hosts = documents.select("host", "document").distinct().groupBy("host")
    hosts = hosts.agg(F.count("*").alias("documents"))
    above = counts.filter(F.col("n") >= min_documents).alias("c").join(
        hosts.alias("h"), F.col("c.host").eqNullSafe(F.col("h.host"))
    )
    above = above.filter(F.col("n") >= share * F.col("documents"))
    return stored(above.select("c.host", "line"), name)


def _dealt(frequent: DataFrame) -> DataFrame:
    """(host, shared): a host's lines as an array of arrays, each line in that of its hash modulo their
    number, so that a look-up goes through a few lines only however many the host has."""
    sizes = frequent.groupBy("host").agg(F.ceil(F.count("*") / BUCKET_LINES).alias("parts"))
    every = sizes.select("host", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    own = frequent.alias("l").join(sizes.alias("s"), F.col("l.host").eqNullSafe(F.col("s.host")))
    own = own.select("l.host", "line", F.pmod("line", F.col("parts")).alias("part"))
    own = own.groupBy("host", "part").agg(F.collect_set("line").alias("lines")).alias("o")
    match = F.col("e.host").eqNullSafe(F.col("o.host")) & (F.col("e.part") == F.col("o.part"))
    filled = every.alias("e").join(own, match, "left").select(
        "e.host", F.struct("e.part", F.coalesce("lines", F.array().cast("array<bigint>")).alias("lines")).alias("x")
    )
    parts = F.sort_array(F.collect_list("x"))
    return filled.groupBy("host").agg(F.transform(parts, lambda x: x["lines"]).alias("shared"))


def judged(
    rows: DataFrame,
    min_words: int,
    max_repeats: float,
    min_documents: int,
    share: float,
    min_left: float,
    broadcast_lines: int,
) -> DataFrame:
    """Rows with ``host`` and ``text``, their counts, verdict and the text without shared lines."""
    frequent = frequent_lines(rows, min_documents, share)
    columns = rows.columns
    if frequent.count() <= broadcast_lines:
        # so few rows are put together in one task, without a shuffle for each step
        listed = F.broadcast(_dealt(frequent.coalesce(1)))
        rows = rows.alias("r").join(
            listed.alias("f"), F.col("r.host").eqNullSafe(F.col("f.host")), "left"
        )
        rows = rows.select(*(f"r.{c}" for c in columns), "shared")
    else:  # too many for every task: each document gets those of its own
        documents = rows.select("host", F.xxhash64("text").alias("document"), "text")
        own = documents.select(
            "host", "document", F.explode(F.transform(lines_of(F.col("text")), line_hash))
        ).toDF("host", "document", "line")
        own = own.distinct().alias("o").join(
            frequent.alias("f"),
            F.col("o.host").eqNullSafe(F.col("f.host")) & (F.col("o.line") == F.col("f.line")),
            "left_semi",
        )
        own = own.groupBy("host", "document")
        own = own.agg(F.array(F.collect_set("line")).alias("shared"))
        rows = rows.withColumn("document", F.xxhash64("text")).alias("r").join(
            own.alias("o"),
            F.col("r.host").eqNullSafe(F.col("o.host"))
            & (F.col("r.document") == F.col("o.document")),
            "left",
        )
        rows = rows.select(*(f"r.{c}" for c in columns), "shared")
    text = F.coalesce(F.col("text"), F.lit(""))
    shared = lambda line: (
        F.length(F.btrim(line, F.lit(BLANK_CHARACTERS))) > 0
    ) & bound(
        line_hash(line),
        lambda h: F.array_contains(F.get("shared", F.pmod(h, F.size("shared")).cast("int")), h),
    )
    parted = bound(
        F.split(text, "\n"),
        lambda lines: F.struct(
            F.array_join(F.filter(lines, lambda line: ~shared(line)), "\n").alias("text"),
            F.size(words_of(F.array_join(F.filter(lines, shared), "\n"))).alias("words"),
        ),
    )
    untouched = F.struct(text.alias("text"), F.lit(0).alias("words"))
    rows = rows.withColumns(measures(F.col("text"))).withColumn(
        "parted", F.when(F.col("shared").isNull(), untouched).otherwise(parted)
    )
    n, left = F.col("words.n"), F.col("words.n") - F.col("parted.words")
    failed = (n < min_words) | (F.col("words.repeats") > max_repeats * n)
    depleted = (F.col("parted.words") > 0) & ((left < min_words) | (left < min_left * n))
    return rows.select(
        *columns,
        n.cast("bigint").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.col("words.repeats").cast("bigint").alias("n_repeat_words"),
        F.col("parted.words").cast("bigint").alias("n_shared_words"),
        F.col("parted.text").alias("left_text"),
        failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"),
    )


RULES = {
    "min_words": 20,
    "max_repeats": 0.3,
    "min_documents": 20,
    "share": 0.001,
    "min_left": 0.3,
    "broadcast_lines": BROADCAST_LINES,
}


def quality(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    host_column: str = "source",
    **rules: float,
) -> DataFrame:
    """Counts and verdict of each row: id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_shared_words, base_failed, kept.

    ``base_failed``: fewer words than ``min_words``, or more than ``max_repeats`` of them in
    repeated 8-word windows. Lines that at least ``min_documents`` distinct texts of a host have,
    and at least ``share`` of all its texts, are shared lines (the share starts to count at hosts of
    20,000 texts, where 20 may have a short line by chance); a document whose words outside
    them are under ``min_words``, or under ``min_left`` of all, is depleted. ``kept``: neither.

    NULL and empty texts have no words and fail. A NULL host is a host of its own. Rows that
    repeat are judged alike, each for itself. An empty table gives an empty one.
    """
    rows = pick(df, id=id_column, text=text_column, host=host_column)
    found = judged(rows, **(RULES | rules))
    return found.drop("text", "host", "left_text")


def keep_good(
    df: DataFrame,
    text_column: str = "text",
    host_column: str = "source",
    **rules: float,
) -> DataFrame:
    """The kept rows, their shared lines taken out of the text; all columns stay.

    NULL and empty texts fail and go. Rows that repeat are judged alike and all stay or all go. An empty
    table gives an empty one.
    """
    plain = df.toDF(*(f"_{k}" for k in range(len(df.columns))))
    at = df.columns.index(text_column)
    rows = plain.withColumns({"host": F.col(f"_{df.columns.index(host_column)}")})
    rows = rows.withColumnRenamed(f"_{at}", "text")
    found = judged(rows, **(RULES | rules)).filter("kept")
    names = {at: "left_text"}
    return found.select(
        *(F.col(names.get(k, f"_{k}")).alias(name) for k, name in enumerate(df.columns))
    )
