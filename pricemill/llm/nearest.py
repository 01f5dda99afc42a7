"""Nearest neighbours by a block matrix join: int8 product tiles bound the distances, floats decide."""

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricemill.llm.common import pick, stored
from pricemill.llm.embeddings import usable

#: Queries of a block, which a task holds with their heaps, and candidates of a block, which
#: stream past them in tiles.
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 4096
TILE = 1024
#: Products of int8 codes are whole numbers: float32 adds so many of them up without rounding.
EXACT_TERMS = (1 << 24) // (127 * 127)
#: What rounding in double precision may add to a distance, as a share of the vectors' lengths.
ROUNDING = 1e-6
#: Pairs whose distances are taken at once.
PAIRS = 1 << 15


class Codes:
    """Vectors as int8 codes with a scale each, and how far each vector is from its code."""

    def __init__(self, vectors: np.ndarray) -> None:
        with np.errstate(all="ignore"):
            self.scale = np.abs(vectors).max(axis=1) / 127
            codes = np.rint(vectors / self.scale[:, None])
            codes[~np.isfinite(codes)] = 0  # a scale too small for a double
            self.codes = np.clip(codes, -127, 127).astype(np.int8)
            rest = vectors - self.codes * self.scale[:, None]
            self.error = np.sqrt((rest * rest).sum(axis=1))
            own = (self.codes.astype(np.float64) ** 2).sum(axis=1)
            self.square = own * self.scale**2
            self.length = np.sqrt((vectors * vectors).sum(axis=1))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 rows, by float32 matrices of few enough columns."""
    total = np.zeros((len(a), len(b)))
    for k in range(0, a.shape[1], EXACT_TERMS):
        some = slice(k, k + EXACT_TERMS)
        total += a[:, some].astype(np.float32) @ b[:, some].astype(np.float32).T
    return total


def bounds(a: Codes, b: Codes) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest distance that each pair of vectors can have."""
    with np.errstate(all="ignore"):
        squares = products(a.codes, b.codes)
        squares *= -2 * a.scale[:, None]
        squares *= b.scale
        squares += a.square[:, None]
        squares += b.square
        between = np.sqrt(np.maximum(squares, 0))
        slack = (a.error + ROUNDING * a.length)[:, None] + (b.error + ROUNDING * b.length)
        return between - slack, between + slack


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows, added up in the order of the components."""
    total = np.zeros(len(a))
    with np.errstate(over="ignore"):
        for k in range(a.shape[1]):
            total += (a[:, k] - b[:, k]) ** 2
    return np.sqrt(total)


class Search:
    """A block of queries with a heap each: the nearest candidates that have passed by."""

    def __init__(self, ids: np.ndarray, hashes: np.ndarray, vectors: np.ndarray, k: int) -> None:
        self.ids, self.hashes, self.vectors, self.k = ids, hashes, vectors, k
        self.codes = Codes(vectors)
        #: (-distance, -id) each, so that the top is what goes first
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in ids]
        self.worst = np.full(len(ids), np.inf)

    def meet(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Take in the candidates of a tile."""
        low, high = bounds(self.codes, Codes(vectors))
        limit = self.worst
        if len(ids) > self.k:  # one more, as a query's own row may be among the nearest
            high[np.isnan(high)] = np.inf
            limit = np.minimum(limit, np.partition(high, self.k, axis=1)[:, self.k])
        near = ~(low > limit[:, None])
        for query, c in zip(*np.nonzero(near & (ids == self.ids[:, None])), strict=True):
            near[query, c] = (self.vectors[query] != vectors[c]).any()
        q, c = np.nonzero(near)
        for at in range(0, len(q), PAIRS):
            qs, cs = q[at : at + PAIRS], c[at : at + PAIRS]
            d = distances(self.vectors[qs], vectors[cs])
            some = np.flatnonzero(d <= self.worst[qs])
            for query, x, key in zip(
                qs[some].tolist(), d[some].tolist(), ids[cs[some]].tolist(), strict=True
            ):
                self._push(query, (-x, -key))

    def _push(self, query: int, found: tuple[float, int]) -> None:
        heap = self.heaps[query]
        if len(heap) < self.k:
            heapq.heappush(heap, found)
        elif found > heap[0]:
            heapq.heapreplace(heap, found)
        if len(heap) == self.k:
            self.worst[query] = -heap[0][0]

    def found(self) -> pd.DataFrame:
        """(query_id, query_hash, id, score) of all heaps."""
        at = np.repeat(np.arange(len(self.ids)), [len(heap) for heap in self.heaps])
        best = [entry for heap in self.heaps for entry in heap]
        return pd.DataFrame(
            {
                "query_id": self.ids[at],
                "query_hash": self.hashes[at],
                "id": np.array([-key for _, key in best], np.int64),
                "score": np.array([-x for x, _ in best], np.float64),
            }
        )


def nearest(
    df: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    every: int = 100,
    k: int = 10,
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest vectors of each query, by Euclidean distance.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but the query's
    own. Queries and candidates are dealt out to blocks by hashes, and each pair of blocks is a cell.
    A cell's candidates stream past its queries in tiles: products of int8 codes give each distance
    up to the quantisation error of both vectors, which is known; pairs whose least distance is
    within the ``k``-th best go on to double precision and into the query's heap. Cells give
    ``k`` rows a query, and of these the nearest stay. Nothing is lost: the result is exact.

    Nearest first, ties by the smaller id; all candidates if there are fewer than ``k``. Vectors that
    are NULL, zero, empty, or hold NULL or non-finite numbers take no part, neither do rows whose id
    is NULL. Vectors of different lengths don't meet. Rows equal in id and vector are one row; rows of
    one id with different vectors are rows of their own, so that an id may occur in its own result, and
    its queries are told apart by ``query_hash``. An empty table gives an empty one.
    """
    rows = pick(df, id=id_column, v=vector_column)
    single = rows.schema["v"].dataType.elementType.typeName() == "float"
    number = np.dtype("<f4" if single else "<f8")
    rows = rows.withColumn("v", F.col("v").cast("array<float>" if single else "array<double>"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("v"))).distinct()

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["v"] = [np.asarray(v, number).tobytes() for v in batch["v"]]
            yield batch

    rows = rows.select("id", F.size("v").alias("size"), F.xxhash64("v").alias("hash"), "v")
    rows = stored(
        rows.mapInPandas(packed, "id bigint, size int, hash bigint, v binary"), "vectors"
    )
    is_query = F.col("id") % every == 0
    sizes = (
        rows.groupBy("size")
        .agg(F.count("*").alias("n"), F.count_if(is_query).alias("m"))
        .filter("m > 0")
        .select(
            "size",
            F.ceil(F.col("m") / query_block).cast("int").alias("query_blocks"),
            F.ceil(F.col("n") / candidate_block).cast("int").alias("blocks"),
        )
    )
    dealt = rows.join(sizes, "size").withColumn("part", F.xxhash64("id", "hash"))

    def side(number: int, rows: DataFrame, query_block: Column, block: Column) -> DataFrame:
        return rows.select(
            "size",
            query_block.alias("query_block"),
            block.alias("block"),
            F.lit(number).alias("side"),
            "id",
            "hash",
            "v",
        )

    def own(blocks: str) -> Column:
        return F.pmod("part", F.col(blocks)).cast("int")

    def each(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    queries = side(0, dealt.filter(is_query), own("query_blocks"), each("blocks"))
    candidates = side(1, dealt, each("query_blocks"), own("blocks"))
    cell = ["size", "query_block", "block"]
    cells = queries.union(candidates).repartition(*cell).sortWithinPartitions(*cell, "side")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, queries, search = None, [], None
        for batch in batches:
            for (*here, side), some in batch.groupby([*cell, "side"], sort=True):
                if here != place:
                    if search is not None:
                        yield search.found()
                    place, queries, search = here, [], None
                ids, hashes = some["id"].to_numpy(np.int64), some["hash"].to_numpy(np.int64)
                v = np.frombuffer(b"".join(some["v"]), number).reshape(len(ids), -1)
                v = v.astype(np.float64)
                if side == 0:
                    queries.append((ids, hashes, v))
                elif queries:  # the cell's queries come before its candidates
                    if search is None:
                        search = Search(*map(np.concatenate, zip(*queries, strict=True)), k)
                    for at in range(0, len(ids), TILE):
                        search.meet(ids[at : at + TILE], v[at : at + TILE])
        if search is not None:
            yield search.found()

    found = cells.mapInPandas(run, "query_id bigint, query_hash bigint, id bigint, score double")
    order = Window.partitionBy("query_id", "query_hash").orderBy("score", "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score", "query_hash")
