"""Near-duplicate vectors: sign hashing by random hyperplanes, exact cosines, components."""

from collections.abc import Iterator
from math import acos, ceil, log, log2, pi

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricemill.llm.common import pick, stored
from pricemill.llm.components import connected_components

#: Chance that a pair just at the threshold meets in no table; pairs above it miss less.
MISSED = 1e-5
#: Distinct vectors of a bucket, about, if they were spread evenly.
BUCKET_VECTORS = 64
#: Vectors of one side of a cell of the comparison.
CELL_ROWS = 1024


def tables_for(vectors: int, threshold: float) -> tuple[int, int]:
    """(tables, bits of each): more bits for more vectors, and as many tables as they then need."""
    bits = max(4, min(24, ceil(log2(max(vectors, 1) / BUCKET_VECTORS))))
    together = (1 - acos(threshold) / pi) ** bits
    return max(1, ceil(log(MISSED) / log(1 - together))), bits


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: no NULL, no infinite part, not all zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(
        vector.isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0),
        F.lit(False),
    )


def near_duplicates(
    df: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    threshold: float = 0.95,
    seed: int = 11,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """(id, n_links, component, kept) of each row: vectors linked by cosines at the threshold.

    Equal vectors are one class, compared once and counted as often as they occur. A class is in
    one bucket of each table, by the signs of its products with the table's hyperplanes. Within a
    bucket all cosines are taken in double precision. A pair is counted in the first table where
    it meets. Buckets of more than ``cell_rows`` are dealt out to cells of pairs of their parts, and of
    a cell only its vectors' counts and a spanning forest leave, so dense groups don't emit
    their pairs. ``component`` is the smallest id reachable, ``kept`` whether it is the row's own.

    Vectors that are NULL, zero, empty, or hold NULL or non-finite numbers link with nothing, and
    so do vectors of different lengths, and rows whose id is NULL (component NULL, not kept). Rows
    equal in id and vector are one vector. An empty table gives an empty one. Ids are integers.
    """
    rows = pick(df, id=id_column, v=vector_column)
    vectors = rows.filter(F.col("id").isNotNull() & usable(F.col("v"))).distinct()
    classes = vectors.groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("n"))
    classes = stored(classes, "vectors")
    tables, bits = tables_for(classes.count(), threshold)
    found = stored(_compared(classes, tables, bits, threshold, seed, cell_rows), "cells")
    counts = found.groupBy("rep").agg(F.sum("n").alias("others"))
    components = connected_components(found.filter("root <> rep"), "rep", "root")
    judged = (
        classes.join(counts, "rep", "left")
        .join(components.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "v",
            (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    judged = stored(judged, "vector-classes")
    rows = rows.withColumn("v", F.when(F.col("id").isNotNull() & usable(F.col("v")), F.col("v")))
    component = F.coalesce("component", "id")
    return rows.join(judged, "v", "left").select(
        "id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component"),
        F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"),
    )


def _compared(
    classes: DataFrame, tables: int, bits: int, threshold: float, seed: int, cell_rows: int
) -> DataFrame:
    """(rep, root, n) of each class and cell with links: one it is connected with, and how many
    vectors it links with that it meets there first."""
    single = classes.schema["v"].dataType.elementType.typeName() == "float"
    number = np.dtype("<f4" if single else "<f8")

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            sizes = batch["v"].map(len)
            for size, some in batch.groupby(sizes):
                if size not in planes:
                    random = np.random.default_rng([seed, size])
                    planes[size] = random.standard_normal((size, tables * bits))
                v = np.stack(some["v"].to_numpy()).astype(np.float64)
                v /= np.abs(v).max(axis=1, keepdims=True)
                signs = (v @ planes[size] > 0).reshape(len(v), tables, bits)
                codes = (signs * weights).sum(axis=2)
                yield pd.DataFrame(
                    {
                        "rep": some["rep"].to_numpy(),
                        "n": some["n"].to_numpy(),
                        "size": size,
                        "v": [x.astype(number).tobytes() for x in some["v"]],
                        "codes": [c.astype("<i4").tobytes() for c in codes],
                        "keys": list(codes),
                    }
                )

    rows = classes.select("rep", "n", "v").mapInPandas(
        coded, "rep bigint, n bigint, size int, v binary, codes binary, keys array<bigint>"
    )
    rows = stored(rows, "codes")
    dealt = rows.select(
        "rep", "n", "size", "v", "codes", F.posexplode("keys").alias("t", "key")
    )
    sizes = rows.select("size", F.posexplode("keys").alias("t", "key"))
    large = stored(
        sizes.groupBy("size", "t", "key").count().filter(F.col("count") > cell_rows),
        "large-buckets",
    )
    parts = F.ceil(F.coalesce(F.col("count"), F.lit(1)) / cell_rows).cast("int")
    cells = (
        dealt.join(large, ["size", "t", "key"], "left")
        .withColumn("parts", parts)
        .withColumn("own", F.pmod(F.xxhash64("rep", "t"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    )
    # a cell is known by two numbers
    bucket = F.shiftleft(F.col("t").cast("bigint"), 32) + F.col("key")
    pair = (F.least("own", "other"), F.greatest("own", "other"))
    sides = F.shiftleft(F.col("size").cast("bigint"), 40) + F.shiftleft(
        pair[0].cast("bigint"), 20
    )
    cells = cells.withColumns({"bucket": bucket, "sides": sides + pair[1]})
    cells = cells.select("rep", "n", "v", "codes", "t", "own", "bucket", "sides")
    cells = cells.repartition("bucket", "sides").sortWithinPartitions("bucket", "sides", "rep")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            bounds = cell_bounds(batch)
            rest = batch.iloc[bounds[-2] :] if len(bounds) > 1 else batch
            yield from linked(batch, bounds[:-1])
        if rest is not None and len(rest):
            yield from linked(rest, cell_bounds(rest))

    def cell_bounds(batch: pd.DataFrame) -> np.ndarray:
        place = batch[["bucket", "sides"]].to_numpy()
        if not len(place):
            return np.zeros(1, np.int64)
        return np.flatnonzero(np.r_[True, (place[1:] != place[:-1]).any(axis=1), True])

    def linked(batch: pd.DataFrame, bounds: np.ndarray) -> Iterator[pd.DataFrame]:
        found = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a > 1:
                found += cell_links(batch.iloc[a:b], number, threshold)
        if found:
            yield pd.DataFrame(found, columns=["rep", "root", "n"])

    return cells.mapInPandas(run, "rep bigint, root bigint, n bigint")


def cell_links(rows: pd.DataFrame, number: np.dtype, threshold: float) -> list[tuple]:
    """(rep, root, n) for the vectors of one cell that have links in it."""
    v = np.stack([np.frombuffer(x, number) for x in rows["v"]]).astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    v /= np.sqrt((v * v).sum(axis=1, keepdims=True))
    near = v @ v.T >= threshold
    np.fill_diagonal(near, False)
    own = rows["own"].to_numpy()
    if (own != own[0]).any():  # a cell of two parts: their inner pairs have cells of their own
        near &= own[:, None] != own[None]
    some = np.flatnonzero(near.any(axis=1))
    if not len(some):
        return []
    near = near[np.ix_(some, some)]
    rep, n = rows["rep"].to_numpy()[some], rows["n"].to_numpy()[some]
    codes = np.stack([np.frombuffer(c, "<i4") for c in rows["codes"]])[some]
    table = int(rows["t"].iloc[0])
    first = near.copy()
    for earlier in range(table):
        first &= codes[:, None, earlier] != codes[None, :, earlier]
    counts = first @ n
    root = np.full(len(some), -1)
    for k in range(len(some)):
        if root[k] >= 0:
            continue
        seen = np.zeros(len(some), bool)
        seen[k] = True
        front = np.array([k])
        while len(front):
            reached = near[front].any(axis=0) & ~seen
            seen |= reached
            front = np.flatnonzero(reached)
        root[seen] = k
    return list(zip(rep.tolist(), rep[root].tolist(), counts.tolist(), strict=True))
