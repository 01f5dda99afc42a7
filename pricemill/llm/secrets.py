"""Secret scans: candidate strings, and how many owners and repositories have each."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricemill.llm.common import pick, stored

#: (kind, pattern, group with the value, characters that the value needs). The order is fixed;
#: the first three are the base, the last one is what the method adds.
KINDS = (
    (
        "assign",
        r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
        r"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
    ("mixed", r"(?<![A-Za-z0-9_-])(?=[0-9a-f]*[A-Zg-z_-])[A-Za-z0-9_-]{24,}", 0, 24),
)
BASE = 3
#: Words that mark a value as an example.
EXAMPLE_WORDS = r"(?i)example|sample|dummy|test|change_?me|your|xxxx|0000|1234"
#: Distinct characters that a live value has at least.
LEAST_DISTINCT = 8
#: Limits above which a value is widely copied, for corpora with copies of documents. An owner may have
#: many repositories, so the second limit is the larger one.
WIDELY = {"max_owners": 5, "max_repositories": 8}


def _candidates(text: Column) -> Column:
    """An array of (kind, k, gap, size, value): the matches of all kinds in order, each with the
    number of code points between it and the one before.

    Between matches lies what split() returns, so positions need no search of their own.
    """
    found = []
    for number, (_, pattern, group, _) in enumerate(KINDS):
        gaps = F.transform(F.split(text, pattern, -1), lambda gap: F.length(gap))
        matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
        zipped = F.arrays_zip(gaps.alias("g"), matches.alias("m"), values.alias("v"))
        rows = F.transform(F.slice(zipped, 1, F.size(matches)), _row_of(number))
        none = F.array().cast("array<struct<kind:int,k:int,gap:int,size:int,value:string>>")
        found.append(F.when(text.rlike(pattern), rows).otherwise(none))
    return F.concat(*found)


def _row_of(kind: int) -> Callable[[Column, Column], Column]:
    return lambda row, k: F.struct(
        F.lit(kind).alias("kind"),
        k.alias("k"),
        row["g"].alias("gap"),
        F.length(row["m"]).alias("size"),
        row["v"].alias("value"),
    )


def _live(value: Column) -> Column:
    """Whether a value looks like a credential in use rather than a word or an example."""
    return (
        value.rlike("[0-9]")
        & value.rlike("[A-Za-z]")
        & ~value.rlike(EXAMPLE_WORDS)
        & (F.size(F.array_distinct(F.split(value, ""))) >= LEAST_DISTINCT)
    )


def secrets(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    repository_column: str = "lang",
    owner_column: str = "source",
    max_owners: int = 1,
    max_repositories: int = 1,
) -> DataFrame:
    """(id, key, spans) of the rows with secrets; ``key`` is a hash of the text.

    ``spans``: an array by start and kind of (start, kind, end, live, owners, repositories), in code
    points, ends exclusive. Base kinds are always listed. How many distinct owners, and
    repositories of owners, have a value (by its SHA-256) tells copied examples from credentials:
    a value is widely copied if more than ``max_owners`` owners have it, in as many distinct texts, and
    more than ``max_repositories`` repositories, in as many distinct texts; so copies of one text
    make no example. A value of many owners is a credential all the same if it is in hardly more
    repositories than owners, and one of few owners however many repositories they have it in; give the
    second limit a larger value than the first, or it decides nothing. ``live`` says that it is not, and that it looks like a credential. Candidates of
    the added kind are listed only if live.

    NULL and empty texts have none. NULL owners and repositories count as values of their own.
    Rows equal in id and text are one row here. An empty table gives an empty one.
    """
    rows = pick(
        df, id=id_column, text=text_column, repository=repository_column, owner=owner_column
    )
    needed = F.element_at(F.array(*(F.lit(kind[3]) for kind in KINDS)), F.col("kind") + 1)
    matches = rows.select(
        "id",
        F.xxhash64("text").alias("key"),
        F.coalesce(F.concat(F.lit("="), "owner"), F.lit("")).alias("owner"),
        F.coalesce(F.concat(F.lit("="), "repository"), F.lit("")).alias("repository"),
        F.inline(_candidates(F.col("text"))),
    )
    matches = stored(
        matches.select(
            "id",
            "key",
            "owner",
            "repository",
            "kind",
            "k",
            "gap",
            "size",
            (F.length("value") >= needed).alias("fits"),
            _live(F.col("value")).alias("looks_live"),
            F.unhex(F.sha2("value", 256)).alias("hash"),
        ),
        "candidates",
    )
    # each value's owners, repositories and texts; copies are combined before each shuffle
    usage = matches.filter("fits").select("hash", "key", "owner", "repository").distinct()
    usage = usage.groupBy("hash").agg(
        F.count_distinct("owner").alias("owners"),
        F.count_distinct("owner", "repository").alias("repositories"),
        F.count_distinct("key").alias("texts"),
    )
    usage = stored(usage, "usage")
    order = Window.partitionBy("id", "key", "kind").orderBy("k")
    placed = matches.dropDuplicates(["id", "key", "kind", "k"]).withColumn(
        "end", F.sum(F.col("gap") + F.col("size")).over(order)
    )
    spans = stored(
        placed.filter("fits").select(
            "id", "key", "kind", (F.col("end") - F.col("size")).alias("start"), "end", "hash",
            "looks_live",
        ),
        "spans",
    )
    widely = (F.least("owners", "texts") > max_owners) & (
        F.least("repositories", "texts") > max_repositories
    )
    spans = spans.join(usage, "hash").withColumn("live", F.col("looks_live") & ~widely)
    listed = spans.filter((F.col("kind") < BASE) | F.col("live"))
    span = F.struct("start", "kind", "end", "live", "owners", "repositories")
    return listed.groupBy("id", "key").agg(F.sort_array(F.collect_list(span)).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*(F.lit(kind[0]) for kind in KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":",
                F.element_at(names, s["kind"] + 1),
                s["start"].cast("string"),
                s["end"].cast("string"),
            ),
        ),
        ",",
    )


def scanned(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    repository_column: str = "lang",
    owner_column: str = "source",
    max_owners: int = 1,
    max_repositories: int = 1,
) -> DataFrame:
    """(id, spans) for every row, with an empty array where there is no secret.

    NULL and empty texts have none. Rows that repeat get equal spans, each for itself; a NULL id is an id
    like others. An empty table gives an empty one.
    """
    limits = max_owners, max_repositories
    found = secrets(df, id_column, text_column, repository_column, owner_column, *limits)
    found = stored(found, "secrets").alias("f")
    rows = pick(df, id=id_column, text=text_column)
    rows = rows.select("id", F.xxhash64("text").alias("key")).alias("r")
    same = F.col("r.id").eqNullSafe(F.col("f.id")) & (F.col("r.key") == F.col("f.key"))
    none = F.array().cast(found.schema["spans"].dataType)
    return rows.join(found, same, "left").select("r.id", F.coalesce("spans", none).alias("spans"))


def without_secrets(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    repository_column: str = "lang",
    owner_column: str = "source",
    max_owners: int = 1,
    max_repositories: int = 1,
    mask: str = "[secret]",
    example_mask: str = "[example]",
) -> DataFrame:
    """The rows with each run of secrets in the text replaced by a mask; all columns stay.

    Runs with a live secret get ``mask``, those of copied examples alone ``example_mask``. Rows without a
    secret, NULL and empty texts among them, stay as they are, and all rows stay, repeated or not.
    """
    limits = max_owners, max_repositories
    found = secrets(df, id_column, text_column, repository_column, owner_column, *limits)
    found = stored(found, "secrets")
    # overlapping spans become runs, and runs become (text before, live) with a rest
    order = Window.partitionBy("id", "key").orderBy("start", "kind")
    flat = found.select("id", "key", F.inline("spans"))
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    flat = flat.withColumn("opens", (F.col("start") >= F.coalesce(reach, F.lit(0))).cast("int"))
    flat = flat.withColumn("run", F.sum("opens").over(order))
    runs = flat.groupBy("id", "key", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.max("live").alias("live")
    )
    after = F.lag("end", 1, 0).over(Window.partitionBy("id", "key").orderBy("start"))
    runs = runs.withColumn("after", after)
    run = F.struct("start", "end", "live", "after")
    runs = stored(
        runs.groupBy("id", "key").agg(F.sort_array(F.collect_list(run)).alias("runs")), "runs"
    )
    plain = df.toDF(*(f"_{k}" for k in range(len(df.columns))))
    at = f"_{df.columns.index(text_column)}"
    text = F.col(at)
    joined = plain.join(
        runs,
        F.col(f"_{df.columns.index(id_column)}").eqNullSafe(F.col("id"))
        & (F.xxhash64(text) == F.col("key")),
        "left",
    )
    masked = F.concat(
        F.array_join(
            F.transform(
                "runs",
                lambda r: F.concat(
                    F.substring(text, r["after"] + 1, r["start"] - r["after"]),
                    F.when(r["live"], F.lit(mask)).otherwise(F.lit(example_mask)),
                ),
            ),
            "",
        ),
        F.substring(text, F.element_at("runs", -1)["end"] + 1, F.length(text)),
    )
    changed = joined.withColumn(at, F.when(F.col("runs").isNull(), text).otherwise(masked))
    return changed.select(
        *(F.col(f"_{k}").alias(name) for k, name in enumerate(df.columns))
    )
