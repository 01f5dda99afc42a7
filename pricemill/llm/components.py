"""Connected components of a graph too large for one machine."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricemill.llm.common import stored


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The smallest node that each node of the edges reaches, as (node, component).

    Alternates the two star steps of Kiveris et al. (2014): every node hands its larger
    neighbours, and then its smaller ones, to its smallest neighbour. Each step is an aggregate
    and an equi-join, its result is a table in the shared folder, and the number of rounds is
    logarithmic. Edges may repeat and may join a node to itself (such a node is its own component
    if it has no other edge). Nodes that are NULL are left out. No edges, no rows.
    """
    known = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).dropna()
    loops = known.filter("u = v").select("u").distinct()
    stars = stored(_ordered(known.filter("u <> v")), "edges")
    while True:
        # large star: larger neighbours go to the smallest of the neighbourhood
        both = stars.union(stars.select("v", "u"))
        least = stored(
            both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least")), "least"
        )
        large = stored(
            _ordered(
                both.filter("v > u")
                .join(least, "u")
                .select(F.col("v").alias("u"), F.col("least").alias("v"))
            ),
            "large",
        )
        # small star: smaller neighbours and the node itself go to the smallest of them
        least = stored(large.groupBy("u").agg(F.min("v").alias("least")), "least")
        moved = large.join(least, "u").filter("v <> least").select(F.col("v").alias("u"), "least")
        new = stored(_ordered(moved.union(least.select("u", "least")).toDF("u", "v")), "small")
        before, after = _mark(stars), _mark(new)
        stars = new
        if before == after:
            break
    heads = stars.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    alone = loops.join(
        stars.select("u").union(stars.select("v")).distinct(), "u", "left_anti"
    ).select(F.col("u").alias("node"), F.col("u").alias("root"))
    return stars.toDF("node", "root").union(heads).union(alone).toDF("node", "component")


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct edges, the larger node first; loops go."""
    u, v = edges.columns
    return (
        edges.filter(F.col(u) != F.col(v))
        .select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
        .distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges: their number and a sum of their hashes."""
    return tuple(
        edges.agg(
            F.count("*"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
            F.sum(F.xxhash64("v", "u", F.lit(1)).cast("decimal(38,0)")),
        ).first()
    )
