"""The corpus pipeline: documents go through the stages in turn, each a table in Parquet."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricemill.llm import quality, secrets, simhash, substrings
from pricemill.llm.common import documents, stored
from pricemill.llm.queries import packed

#: Share of a host's texts that a shared line needs besides its 20 texts. It starts to count at hosts
#: of 20,000 texts: there, 20 texts may have a short line by chance.
SHARE = 0.001

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def counted(docs: DataFrame) -> DataFrame:
    """The documents with ``n_chars`` of the text as it is now."""
    names = docs.columns  # others may differ from these in case alone
    text, n_chars = f"_{names.index('text')}", f"_{names.index('n_chars')}"
    plain = docs.toDF(*(f"_{k}" for k in range(len(names))))
    now = F.coalesce(F.length(text).cast(plain.schema[n_chars].dataType), F.col(n_chars))
    return plain.withColumn(n_chars, now).toDF(*names)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that too many of their host share.

    NULL and empty texts go; rows that repeat are judged alike. No documents, no rows: so for all stages.
    """
    return counted(quality.keep_good(docs, share=SHARE))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, whatever their ids; repeated rows are a group."""
    return simhash.keep_one(docs, shingle=4, radius=4)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 20 words and more that start earlier in the corpus.

    Those that lose all their words go; NULL and empty texts have none and stay.
    """
    return counted(substrings.without_repeats(docs, width=20))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked; all rows stay, those with NULL texts as they are."""
    return counted(secrets.without_secrets(docs, **secrets.WIDELY))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in training sequences; a NULL text is an empty one."""
    return packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can't express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written and read again.

    Extra columns are carried to the last stage, which returns pieces. No documents, no pieces.
    """
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
