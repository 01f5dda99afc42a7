"""Helpers that the operators of this folder share."""

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricemill.session import shared_folder

#: White space that separates words, in the syntax of Java's patterns.
BLANKS = r"[\x20\x09-\x0D]+"
#: The same characters, for translate().
BLANK_CHARACTERS = " \t\n\x0b\x0c\r"
#: For cutting texts as files of byte-level tokenizers ask for it: letters above ASCII that have one
#: code point, in lower case too; blanks; and texts of these, ASCII and common signs, which Unicode
#: normalisation leaves as they are.
LETTERS = r"\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
BLANK = r"\x09-\x0d\x20\x85\xa0"
PLAIN = re.compile(
    r"[\x00-\x7f\x85\xa0-\xa9\xab-\xb1\xb4\xb6-\xb8\xbb\xbf\xd7\xf7\u2010-\u2027\u2030-\u203a"
    f"{LETTERS}]*"
)


def byte_characters() -> list[str]:
    """The characters that stand for the bytes 0 to 255 in files of byte-level tokenizers:
    printable ones for themselves, the others from 256 on in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """The wanted columns under new names: ``pick(df, id="doc_id")``.

    Columns are found by their exact names, so others that differ in case alone do no harm.
    """
    plain = df.toDF(*(f"_{k}" for k in range(len(df.columns))))
    return plain.select(
        *(F.col(f"_{df.columns.index(name)}").alias(alias) for alias, name in wanted.items())
    )


def stored(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends here.

    The result survives lost executors, and is computed once however often it is used.
    """
    path = os.path.join(shared_folder(df.sparkSession), "pricemill", f"{name}-{uuid.uuid4().hex}")
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
