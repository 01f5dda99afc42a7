"""Repeated passages: rolling hashes of all word windows, and what they cover removed."""

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemill.llm.common import pick, shuffle_partitions

#: Text of one block of documents, in bytes: bounds what a task holds.
BLOCK_BYTES = 8 << 20
#: Windows that meet in one bucket, about, and the least that a block sends to one.
BUCKET_WINDOWS = 1 << 16
LEAST_SENT = 32
#: Bytes of a window's hash that travel; its bucket adds further, independent bits.
HASH_BYTES = 7
NO_ID = -(1 << 63)
#: Odd bases of the rolling hashes; odd numbers have an inverse modulo 2^64.
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; equal numbers stay equal."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def rolling(words: np.ndarray, width: int, base: int) -> np.ndarray:
    """Rabin-Karp hashes, modulo 2^64, of all windows of a sequence of word hashes.

    From prefix sums of word * base^-k, a window's hash is a difference times a power.
    """
    n = len(words)
    powers = np.cumprod(np.full(n, base, np.uint64))
    inverse = np.cumprod(np.full(n, pow(base, -1, 1 << 64), np.uint64))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * inverse, out=sums[1:])
    return (sums[width:] - sums[:-width]) * powers[width - 1 :]


class Windows:
    """The windows of a block's documents, in the order of the documents and of their starts."""

    def __init__(self, texts: list, width: int, bucket_bits: int) -> None:
        digest = xxhash.xxh64_intdigest
        parts = []
        for text in texts:
            words = text.encode().split() if isinstance(text, str) else ()  # ASCII white space
            parts.append(np.fromiter(map(digest, words), np.uint64, len(words)))
        self.n_words = np.array([len(p) for p in parts], np.int64)
        self.first_word = np.cumsum(self.n_words) - self.n_words
        words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        del parts
        n_windows = np.maximum(self.n_words - width + 1, 0)
        #: where each window starts, among the words of the block
        self.start = np.arange(n_windows.sum()) + np.repeat(
            self.first_word - (np.cumsum(n_windows) - n_windows), n_windows
        )
        if len(self.start) == 0:
            self.unique = self.bucket = self.hash = np.zeros(0, np.uint64)
            self.again = np.zeros(0, bool)
            self.inverse = np.zeros(0, np.int64)
            return
        hashes = _mixed(rolling(words, width, BASES[0])[self.start])
        other = _mixed(rolling(_mixed(words), width, BASES[1])[self.start])
        # the block's distinct windows, by bucket and then by first occurrence
        _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        #: windows that also start earlier within the block
        self.again = first[inverse] != np.arange(len(hashes))
        bucket = (other[first] >> np.uint64(64 - bucket_bits)).astype(np.int64)
        order = np.lexsort((first, bucket))
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        #: for each window, its place among the distinct ones
        self.inverse = place[inverse]
        self.bucket, self.hash = bucket[order], hashes[first][order]

    def sent(self) -> Iterator[tuple[int, bytes]]:
        """(bucket, hashes in order) of the distinct windows."""
        octets = self.hash.view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES]
        for bucket, a, b in self._runs():
            yield bucket, octets[a:b].tobytes()

    def covered(self, replies: dict[int, bytes], width: int) -> np.ndarray:
        """Which words of the block a window covers that also starts earlier."""
        earlier = np.zeros(len(self.hash), bool)
        for bucket, a, b in self._runs():
            if bucket in replies:
                bits = np.frombuffer(replies[bucket], np.uint8)
                earlier[a:b] = np.unpackbits(bits, count=b - a)
        starts = self.start[self.again | earlier[self.inverse]]
        total = int(self.n_words.sum())
        change = np.bincount(starts, minlength=total + 1)
        change -= np.bincount(starts + width, minlength=total + 1)[: total + 1]
        return np.cumsum(change)[:total] > 0

    def _runs(self) -> Iterator[tuple[int, int, int]]:
        bounds = np.flatnonzero(np.r_[True, self.bucket[1:] != self.bucket[:-1], True])
        if len(self.bucket):
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                yield int(self.bucket[a]), a, b


def _in_order(block: pa.Table) -> tuple[list[int], list]:
    """The block's distinct documents by id, hash of the text and text: place of each row, and
    (id, hash, text)."""
    columns = (block[name].to_pylist() for name in ("ord", "spot", "text"))
    rows = list(zip(*columns, strict=True))
    order = sorted(set(rows), key=lambda row: (*row[:2], row[2] is not None, row[2] or ""))
    place = {row: k for k, row in enumerate(order)}
    return [place[row] for row in rows], order


def remove_repeats(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 20
) -> DataFrame:
    """Remove every word that a repeated window of ``width`` words covers.

    A window counts as repeated if its word sequence also starts earlier: in a document with a
    smaller id, or further ahead in its own. Windows are judged on the input as it is. Returns for
    each row: id, n_words, n_removed, cuts (maximal intervals of removed words, as an array of
    first and past-the-last word numbers) and kept (the kept words, joined by one space).

    Documents lie in blocks of consecutive ids. A block sends its distinct window hashes, packed in
    order, to buckets by hash; there the windows of all blocks meet, and a bit for each goes back
    that says whether an earlier block has it. So a window costs 7 bytes of shuffle, once for each
    block, however often it occurs.

    NULL and empty texts have no words. A NULL id comes before all others. Rows equal in id and
    text are one document and get equal results; rows of one id with different texts follow each
    other in the order of a hash of their texts, by which an id of many rows is cut into several blocks.
    An empty table gives an empty one.
    """
    rows = pick(df, ord=id_column, text=text_column)
    found = _judged(rows, width)
    return found.select(F.nullif("ord", F.lit(NO_ID)).alias("id"), *RESULT)


def without_repeats(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 20
) -> DataFrame:
    """The rows with repeated passages taken out of the text; all columns stay.

    A text that loses words becomes its kept words, joined by one space; a row whose text loses all
    its words goes. Other rows stay as they are.
    """
    plain = df.toDF(*(f"_{k}" for k in range(len(df.columns))))
    at = df.columns.index(text_column)
    rows = plain.withColumns(
        {"ord": F.col(f"_{df.columns.index(id_column)}"), "text": F.col(f"_{at}")}
    ).drop(f"_{at}")
    found = _judged(rows, width).filter("n_removed = 0 OR n_removed < n_words")
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    return found.withColumn(f"_{at}", text).select(
        *(F.col(f"_{k}").alias(name) for k, name in enumerate(df.columns))
    )


RESULT = ("n_words", "n_removed", "cuts", "kept")
RESULT_SCHEMA = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("cuts", T.ArrayType(T.LongType())),
    T.StructField("kept", T.StringType()),
]


def _judged(rows: DataFrame, width: int) -> DataFrame:
    """Rows with ``ord`` and ``text``, and what RESULT names beside them."""
    spark = rows.sparkSession
    rows = rows.withColumns(
        {
            "ord": F.coalesce(F.col("ord").cast("bigint"), F.lit(NO_ID)),
            "spot": F.xxhash64("text"),
        }
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(4 * shuffle_partitions(spark), ceil(total / BLOCK_BYTES))
    windows = max(total / 6, 1)
    bits = min(log2(max(windows / BUCKET_WINDOWS, 1)), log2(windows / n_blocks / LEAST_SENT + 1))
    bits = max(4, ceil(bits))
    shares = [k / n_blocks for k in range(1, n_blocks)]
    edges = np.array(
        rows.agg(F.percentile_approx("ord", shares, 20 * n_blocks)).first()[0] or [], np.int64
    )

    @F.pandas_udf("bigint")
    def block_of(ids: pd.Series, spots: pd.Series) -> pd.Series:
        first, last = (np.searchsorted(edges, ids.to_numpy(), side=s) for s in ("left", "right"))
        # an id at several edges is cut by the texts' hashes, in their order
        share = spots.to_numpy() / 2.0**64 + 0.5
        return pd.Series(np.minimum(first + ((last - first + 1) * share).astype(np.int64), last))

    def send(block: pa.Table) -> pa.Table:
        _, order = _in_order(block)
        sent = list(Windows([text for _, _, text in order], width, bits).sent())
        return pa.table(
            {
                "block": pa.array([block["block"][0].as_py()] * len(sent), pa.int64()),
                "bucket": pa.array([b for b, _ in sent], pa.int64()),
                "hashes": pa.array([h for _, h in sent], pa.binary()),
            }
        )

    def meet(bucket: pd.DataFrame) -> pd.DataFrame:
        bucket = bucket.sort_values("block", ignore_index=True)
        octets = np.frombuffer(b"".join(bucket["hashes"]), np.uint8).reshape(-1, HASH_BYTES)
        wide = np.zeros((len(octets), 8), np.uint8)
        wide[:, :HASH_BYTES] = octets
        _, first = np.unique(wide.view(np.uint64).ravel(), return_index=True)
        later = np.ones(len(octets), bool)
        later[first] = False
        ends = np.cumsum([len(h) // HASH_BYTES for h in bucket["hashes"]])
        replies = []
        for number, b, size in zip(bucket["block"], ends, np.diff(ends, prepend=0), strict=True):
            if (flags := later[b - size : b]).any():
                replies.append((number, bucket["bucket"].iloc[0], np.packbits(flags).tobytes()))
        return pd.DataFrame(replies, columns=["block", "bucket", "flags"])

    def cut(block: pa.Table, replies: pa.Table) -> pa.Table:
        places, order = _in_order(block)
        found = Windows([text for _, _, text in order], width, bits)
        flags = zip(replies["bucket"].to_pylist(), replies["flags"].to_pylist(), strict=True)
        gone = found.covered(dict(flags), width)
        results = []
        for k, (_, _, text) in enumerate(order):
            a, n = int(found.first_word[k]), int(found.n_words[k])
            lost = gone[a : a + n]
            words = text.encode().split() if n else []
            turns = np.flatnonzero(np.diff(lost.astype(np.int8), prepend=0, append=0)).tolist()
            at, kept = 0, []
            for x, y in zip(turns[::2], turns[1::2], strict=True):
                kept += words[at:x]
                at = y
            kept += words[at:]
            results.append((n, int(lost.sum()), turns, b" ".join(kept).decode()))
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.string())
        for k, (name, kind) in enumerate(zip(RESULT, kinds, strict=True)):
            block = block.append_column(name, pa.array([results[p][k] for p in places], kind))
        return block

    blocks = rows.withColumn("block", block_of("ord", "spot"))
    sent = blocks.groupBy("block").applyInArrow(send, "block bigint, bucket bigint, hashes binary")
    replies = sent.groupBy("bucket").applyInPandas(
        meet, "block bigint, bucket bigint, flags binary"
    )
    both = blocks.groupBy("block").cogroup(replies.groupBy("block"))
    return both.applyInArrow(cut, T.StructType(blocks.schema.fields + RESULT_SCHEMA))
