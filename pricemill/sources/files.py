"""Delimited files: typed and text scans, sheets with a title line, file attributes."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemill.functions import bound
from pricemill.functions.text import snake_name, strip
from pricemill.operators.ordered import top_per_group
from pricemill.operators.shape import computed_once

BAD_RECORD = "_bad_record"


def read_text_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Header names from the file, every column text."""
    return spark.read.csv(path, header=True, inferSchema=False)


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, keep_bad: bool = False
) -> DataFrame:
    """Declared schema. ``keep_bad`` adds the raw line of records that do not fit it."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if keep_bad:
        schema = T.StructType([*schema.fields, T.StructField(BAD_RECORD, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", BAD_RECORD)
    return reader.schema(schema).csv(path)


def read_processed(
    spark: SparkSession, path: str, schema: T.StructType, kind: str = "parquet"
) -> DataFrame:
    """A processed table back for analysis: Parquet, or a CSV snapshot."""
    if kind == "csv":
        return read_csv(spark, path, schema)
    return spark.read.schema(schema).format(kind).load(path)


def plain_path(file: str) -> Column:
    """A path as written: Spark reports it URL-encoded, where '+' stands for itself."""
    return F.url_decode(F.replace(F.col(file), F.lit("+"), F.lit("%2B")))


def file_name(df: DataFrame, file: str = "file_path", name: str = "file_name") -> DataFrame:
    """Last part of the path, as key for a table of file attributes."""
    return df.withColumn(name, F.element_at(F.split(plain_path(file), "/"), -1))


def without_files(df: DataFrame, names: Sequence[str], file: str = "file_path") -> DataFrame:
    """Leave out the rows of the named files."""
    if not names:
        return df
    return df.filter(~F.element_at(F.split(plain_path(file), "/"), -1).isin(*names))


def read_whole_texts(
    spark: SparkSession,
    path: str | list[str],
    suffix: str = "",
    exclude: Sequence[str] = (),
) -> DataFrame:
    """One row per report file: ``file_path`` and ``text``.

    For report files of ordinary size; ``read_lines`` is the reader for long files.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    texts = reader.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("text")
    )
    return without_files(texts, exclude)


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    suffix: str = "",
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Lines of files of any length, read in splits: ``file_path``, ``block``, ``line_id``, ``line``.

    Within a file, (block, line_id) is the order of the lines: a block is the byte offset of a
    split, and ids grow inside one. The ids are set as the split is read, before any shuffle,
    so a repeated task gives the same ones.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    lines = reader.text(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_id"),
        F.rtrim(F.col("value"), F.lit("\r")).alias("line"),
    )
    return without_files(lines, exclude)


def text_lines(text: Column) -> Column:
    """Lines of a whole text."""
    return F.split(text, "\r?\n")


#: Columns that a sheet may have; a wider header is an error.
WIDTH = 32
# A field, whose quotes may hold commas and line breaks, and a record of fields.
FIELD = r'(?:"(?:[^"]++|"")*+"[^,\r\n]*+|[^,\r\n]*+)'
RECORD = rf"({FIELD}(?:,{FIELD})*+)(?:\r\n|\r|\n|\z)"
# Fixed value: a comma, and a field that is quoted from end to end or has no quotes.
CLEAN_FIELD = r',("(?:[^"]++|"")*+"|[^",]*+)'
# Fixed value: a field whose quotes don't end on the line.
OPEN_QUOTE = r'^(?:"(?:[^"]++|"")*+"[^,]*+,|[^",][^,]*+,|,)*+"(?:[^"]++|"")*+$'
_CSV_SCHEMA = ", ".join(f"c{i} string" for i in range(WIDTH))


def records_of(text: Column) -> Column:
    """Delimited records of a whole text; line breaks in quoted fields stay inside."""
    return F.regexp_extract_all(text, F.lit(RECORD), F.lit(1))


def _parsed(record: Column) -> Column:
    """Fields of any record, by Spark's CSV parser."""
    parsed = F.from_csv(record, _CSV_SCHEMA, {"escape": '"', "mode": "PERMISSIVE"})
    return bound(parsed, lambda p: F.array(*[p[f"c{i}"] for i in range(WIDTH)]))


def _unquoted(field: Column) -> Column:
    inner = F.replace(F.substring(field, F.lit(2), F.length(field) - 2), F.lit('""'), F.lit('"'))
    return F.when(field.startswith('"'), inner).otherwise(field)


def _fields(record: Column) -> Column:
    """Fields of a record as an array; an empty one is NULL or empty.

    Each record takes the cheapest way that is right for it: without quotes, the commas; if a pattern
    of fields quoted from end to end leaves nothing between its matches, that; else Spark's CSV parser.
    All give the same fields.
    """
    found = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(CLEAN_FIELD), F.lit(1))
    quoted = bound(
        found,
        lambda fields: F.when(
            F.array_join(fields, ",") == record, F.transform(fields, _unquoted)
        ).otherwise(_parsed(record)),
    )
    return F.when(~F.contains(record, F.lit('"')), F.split(record, ",")).otherwise(quoted)


def _column_names(header: Column) -> Column:
    """``snake_name`` of each field of a header; runs of blanks are found once for all of them, and
    only in headers that have other blanks than single spaces."""
    odd = header.rlike(r"[^\x20-\x7e]|  ")
    even = F.lower(F.when(odd, F.regexp_replace(header, r"(?U)[\s\x1c-\x1f]+", " ")).otherwise(header))
    return F.transform(_fields(even), lambda f: F.replace(F.trim(f), F.lit(" "), F.lit("_")))


def _places(header: Column, names: Sequence[str]) -> Column:
    """Position of each named column in a header record: from 1, 0 if the sheet lacks it.

    Names are compared without regard to case and blanks.
    """
    wanted = F.array(*[F.lit(snake_name(n)) for n in names])
    found = bound(
        _column_names(header),
        lambda own: F.transform(wanted, lambda n: F.coalesce(F.array_position(own, n), F.lit(0))),
    )
    return F.coalesce(found, F.transform(wanted, lambda _: F.lit(0).cast("bigint")))


def _fault(
    header: Column, places: Column, names: Sequence[str], required: Sequence[str]
) -> Column:
    """What is wrong with a header: it is too wide, or lacks a required column. NULL if nothing is, or
    if there is no header."""
    # So many fields need as many commas; most headers have too few to count the fields.
    many = F.substring_index(header, ",", WIDTH - 1) != header
    fields = F.regexp_count(header, F.lit(f"{FIELD}(?:,|$)"))
    # One expression for all columns, in the order of ``required``: see ``shape.conform``.
    wanted = F.array(*[F.lit(n) for n in required], F.lit(None).cast("string"))
    at = F.array(*[F.lit(list(names).index(n)) for n in required], F.lit(None).cast("int"))
    lacking = F.transform(at, lambda i, k: F.when(F.get(places, i) == 0, F.get(wanted, k)))
    lacks = F.nullif(F.concat_ws(", ", lacking), F.lit(""))
    wide = many & (fields > WIDTH + 1)
    return F.when(wide, F.lit("the sheet is too wide")).when(
        header.isNotNull(), F.concat(F.lit("the sheet lacks a column: "), lacks)
    )


def _checked(
    df: DataFrame, head: Column, columns: Sequence[str], required: Sequence[str], skip_bad: bool
) -> DataFrame:
    """Sheets with the positions ``_at`` of their columns. A bad header is an error that names its file,
    as the file's rows would be lost otherwise; or, if the caller says so, its file is left out."""
    df = df.withColumn("_at", _places(head, columns))
    fault = _fault(head, F.col("_at"), columns, required)
    if skip_bad:
        return computed_once(df.withColumn("_fault", fault)).filter("_fault IS NULL").drop("_fault")
    text = F.concat(fault, F.lit(": "), F.col("file_path"))
    stop = F.raise_error(text).cast("array<bigint>")
    return df.withColumn("_at", F.when(fault.isNotNull(), stop).otherwise(F.col("_at")))


def sheet_faults(
    texts: DataFrame,
    columns: Sequence[str],
    title_lines: int = 1,
    required: Sequence[str] = (),
) -> DataFrame:
    """(file_path, fault) of the sheets that the readers leave out with ``skip_bad``, and of those that
    have no rows: the files to look at, while the others are loaded. Spark doesn't read files of no
    bytes, so those are not listed."""
    lines = F.col("_lines")
    head = F.get(lines, title_lines)
    sheets = texts.select("file_path", "text", records_of(F.col("text")).alias("_lines"))
    sheets = sheets.withColumn("_at", _places(head, columns))
    filled = F.filter(F.slice(lines, title_lines + 2, F.size(lines)), lambda r: F.translate(r, ", ", "") != "")
    fault = (
        F.when(F.coalesce(strip("text"), F.lit("")) == "", F.lit("the sheet is empty"))
        .when(F.coalesce(strip(head), F.lit("")) == "", F.lit("the sheet has no header"))
        .otherwise(_fault(head, F.col("_at"), columns, required))
    )
    fault = F.coalesce(fault, F.when(F.size(filled) == 0, F.lit("the sheet has no rows")))
    judged = computed_once(sheets.select("file_path", fault.alias("fault")))
    return judged.filter("fault IS NOT NULL")


def _rows(df: DataFrame, columns: Sequence[str], kept: Sequence[str]) -> DataFrame:
    """Named columns of records ``_v``, arrays of fields, with positions ``_at``; blank records go.

    Records were parsed inside a generator, in its outer form: filters pushed down over the columns
    stop there, so each record is parsed once.
    """
    filled = df.filter(strip(F.concat_ws("", "_v")) != "")
    named = [
        F.nullif(F.get("_v", F.get("_at", i).cast("int") - 1), F.lit("")).alias(name)
        for i, name in enumerate(columns)
    ]
    return filled.select(*kept, *named)


def sheet_rows(
    texts: DataFrame,
    columns: Sequence[str],
    title_lines: int = 1,
    keep: Sequence[str] = (),
    required: Sequence[str] = (),
    skip_bad: bool = False,
) -> DataFrame:
    """Rows of sheets: title lines are skipped, the next line is the header, the rest are rows.

    Columns are matched by header name per file, so files may differ in their columns. The
    result has ``file_path``, ``line_no`` (0-based record of the file), the columns ``keep`` and
    the named columns as text. A sheet without rows adds none. One that lacks a required column, or
    is too wide, stops the job, or is left out with ``skip_bad``: ``sheet_faults`` lists those.
    No shuffle: a file's header and rows are in one record until the lines are exploded.
    """
    lines = F.col("_lines")
    head = F.get(lines, title_lines)
    body = F.slice(lines, title_lines + 2, F.greatest(F.size(lines), F.lit(0)))
    files = texts.select("file_path", *keep, records_of(F.col("text")).alias("_lines"))
    rows = (
        _checked(files, head, columns, required, skip_bad)
        .select(
            "file_path",
            *keep,
            "_at",
            F.posexplode_outer(F.transform(body, _fields)).alias("_no", "_v"),
        )
        .withColumn("line_no", F.col("_no") + (title_lines + 1))
    )
    return _rows(rows, columns, ["file_path", "line_no", *keep])


def dated_sheet_rows(
    texts: DataFrame,
    columns: Sequence[str],
    header_pattern: str,
    section_column: str,
    section: str = "section",
    title_lines: int = 1,
    keep: Sequence[str] = (),
    required: Sequence[str] = (),
    skip_bad: bool = False,
) -> DataFrame:
    """Sheet rows with the text of the section header above them.

    A record is a section header if ``header_pattern`` (a Java regular expression for the header
    text, one group) finds its text in the field of ``section_column``; such text in other fields
    means nothing. A file's records are cut at its headers while they are in one array, so
    nothing has to be carried between rows: no window, no shuffle. Rows above the first header
    get NULL; header records go. Bad sheets are as in ``sheet_rows``.
    """
    place = F.get("_at", list(columns).index(section_column)).cast("int") - 1

    def found(record: Column) -> Column:
        field = F.get(_fields(record), place)
        text = F.nullif(F.regexp_extract(field, header_pattern, 1), F.lit(""))
        return F.when(record.rlike(header_pattern), text)

    def mark(at: Column, text: Column) -> Column:
        return F.struct(at.cast("int").alias("at"), text.alias("text"))

    head = F.get("_lines", title_lines)
    body = F.slice("_lines", title_lines + 2, F.greatest(F.size("_lines"), F.lit(0)))
    files = texts.select("file_path", *keep, records_of(F.col("text")).alias("_lines"))
    files = _checked(files, head, columns, required, skip_bad).withColumn("_body", body)
    marks = F.filter(
        F.transform("_body", lambda r, i: mark(i, found(r))), lambda m: m["text"].isNotNull()
    )
    nothing = F.lit(None).cast("string")
    bounds = F.concat(
        F.array(mark(F.lit(-1), nothing)), marks, F.array(mark(F.size("_body"), nothing))
    )

    def pieces(b: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(b) - 2),
            lambda k: F.struct(
                F.get(b, k)["text"].alias("text"),
                F.slice(
                    "_body", F.get(b, k)["at"] + 2, F.get(b, k + 1)["at"] - F.get(b, k)["at"] - 1
                ).alias("records"),
            ),
        )

    cut = files.select(
        "file_path", *keep, "_at", F.explode_outer(bound(bounds, pieces)).alias("_piece")
    )
    rows = cut.select(
        "file_path",
        *keep,
        "_at",
        F.col("_piece.text").alias(section),
        F.explode_outer(F.transform("_piece.records", _fields)).alias("_v"),
    )
    return _rows(rows, columns, ["file_path", *keep, section])


def long_sheet_rows(
    lines: DataFrame,
    columns: Sequence[str],
    title_lines: int = 1,
    keep: Sequence[str] = (),
    required: Sequence[str] = (),
    skip_bad: bool = False,
) -> DataFrame:
    """Sheet rows from ``read_lines``, for sheets too long for one record.

    The header of each file, one row per file, is joined to its lines; a file that holds most
    of the lines is a skewed join partition, which AQE splits. The result has ``file_path``,
    ``block``, ``line_id`` (the order of the lines), ``keep`` and the named columns. A record is a
    line here: a quoted field that goes on in the next line is an error.
    """
    heads = (
        top_per_group(
            lines.filter(F.col("block") == 0).select("file_path", "line_id", "line"),
            ["file_path"],
            ["line_id"],
            title_lines + 1,
        )
        .groupBy("file_path")
        .agg(
            F.max("line_id").alias("_head_id"),
            F.max_by("line", "line_id").alias("_head"),
        )
    )
    heads = _checked(heads, F.col("_head"), columns, required, skip_bad)
    heads = heads.select("file_path", "_head_id", "_at")
    broken = F.raise_error(
        F.concat(F.lit("a quoted field goes on in the next line: "), F.col("file_path"))
    ).cast("string")
    whole = F.when(F.col("line").rlike(OPEN_QUOTE), broken).otherwise(F.col("line"))
    rows = (
        lines.join(heads, "file_path")
        .filter((F.col("block") > 0) | (F.col("line_id") > F.col("_head_id")))
        .select(
            "file_path",
            "block",
            "line_id",
            *keep,
            "_at",
            F.explode_outer(F.array(_fields(whole))).alias("_v"),
        )
    )
    return _rows(rows, columns, ["file_path", "block", "line_id", *keep])


# Fixed value: the directory of a market file is <name>_<code>_<type>; the name may hold '_'.
MARKET_DIRECTORY = r"([^/]*)_([^/_]*)_([^/_]*)/[^/]*$"


def market_of_path(df: DataFrame, file: str = "file_path") -> DataFrame:
    """Market name, code and type from the directory of the file."""
    path = plain_path(file)
    return df.withColumns(
        {
            name: strip(F.regexp_extract(path, MARKET_DIRECTORY, i))
            for i, name in enumerate(("market_name", "market_code", "market_type"), 1)
        }
    )

