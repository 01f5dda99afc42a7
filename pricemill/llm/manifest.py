"""Merkle manifest of a dataset: trees of digests, and proofs found by pointer jumping."""

from collections.abc import Callable, Iterator, Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricemill.llm.common import pick, shuffle_partitions, stored

#: Nodes of a run, which have one parent.
RUN = 3
#: The number of the tree above the subroots; those below it are numbered from 0.
TOP = -1


def item(value: Column) -> Column:
    """A value as a digest takes it: UTF-8 byte count, a colon and the value; ``-`` if NULL."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(item, values)), 256))


def numbered(df: DataFrame, group: str, order: Sequence[str], partitions: int) -> DataFrame:
    """Rows with their ``place`` in the group (from 0, by ``order``), the group's ``size`` and its
    ``number`` (from 0; both NULL first).

    Rows are counted and then range-partitioned by group and order, so that a large group is many
    tasks; the counts by group and partition, added up, are where each partition's rows start. The
    ranges are drawn once and written with the rows: a repeated task finds them as they were.
    """
    keys = [F.asc_nulls_first(c) for c in (group, *order)]
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    ranged = counted.repartitionByRange(partitions, *keys)
    ranged = stored(ranged.withColumn("_part", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy(group, "_part").agg(F.sum("_n").alias("_rows"))
    before = Window.partitionBy(group).orderBy("_part")
    counts = counts.select(
        F.col(group).alias("_group"),
        F.col("_part").alias("_of"),
        (F.sum("_rows").over(before) - F.col("_rows")).alias("_start"),
        F.sum("_rows").over(Window.partitionBy(group)).alias("size"),
    )
    # a group's number: how many begin in earlier partitions, and in its own before it
    firsts = counts.groupBy("_group").agg(F.min("_of").alias("_first"))
    parts = firsts.groupBy("_first").agg(F.count("*").alias("_groups"))
    earlier = F.sum("_groups").over(Window.orderBy("_first")) - F.col("_groups")
    inside = Window.partitionBy("_first").orderBy(F.asc_nulls_first("_group"))
    groups = firsts.join(parts.select("_first", earlier.alias("_earlier")), "_first").select(
        F.col("_group").alias("_named"),
        (F.col("_earlier") + F.row_number().over(inside) - 1).alias("number"),
    )
    starts = stored(
        counts.join(groups, F.col("_group").eqNullSafe(F.col("_named"))).drop("_named"), "starts"
    )
    match = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_of"))
    within = Window.partitionBy("_part", group).orderBy(*keys)
    first = F.col("_start") + F.sum("_n").over(within) - F.col("_n")
    copies = F.sequence(F.col("_first"), F.col("_first") + F.col("_n") - 1)
    return (
        ranged.join(starts, match)
        .select(*df.columns, "size", "number", "_n", first.alias("_first"))
        .select(*df.columns, "size", "number", F.explode(copies).alias("place"))
    )


def height(size: int) -> int:
    """Levels above the leaves of a tree."""
    levels = 0
    while size > 1:
        size, levels = -(-size // RUN), levels + 1
    return levels


def _runs(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The runs of each level of trees, each with its parent's digest: one frame a level.

    Nodes have tree, place, size (nodes of the level), digest, and what else a leaf has.
    """
    kid = F.struct("place", *[c for c in nodes.columns if c not in ("tree", "place", "size")])
    found = []
    for level in range(levels):
        hexed = F.transform("kids", lambda k: F.lower(F.hex(k["digest"])))
        runs = (
            nodes.filter("size > 1")
            .groupBy("tree", F.floor(F.col("place") / RUN).alias("run"))
            .agg(F.sort_array(F.collect_list(kid)).alias("kids"), F.first("size").alias("size"))
            .withColumn("digest", F.unhex(F.sha2(F.concat_ws("", hexed), 256)))
            .withColumn("level", F.lit(level))
        )
        runs = stored(runs, "runs")
        found.append(runs)
        nodes = runs.select(
            "tree",
            F.col("run").alias("place"),
            F.ceil(F.col("size") / RUN).alias("size"),
            "digest",
        )
        kid = F.struct("place", "digest")
    return found


def _segment(kids: Column, at: Column) -> Column:
    """One level of a proof: a byte of 3 * (siblings on the left) + (on the right), and their digests."""
    right = F.size(kids) - 1 - at
    nothing = F.lit(b"")
    siblings = [
        F.when(at != k, F.coalesce(F.get(kids, k)["digest"], nothing)).otherwise(nothing)
        for k in range(RUN)
    ]
    return F.concat(F.unhex(F.lpad(F.hex(RUN * at + right), 2, "0")), *siblings)


def _nodes(runs: DataFrame, lone: bool) -> DataFrame:
    """Nodes with their parents as ancestors, and the siblings on the way there. The top node of a
    tree is the leaf of that number of the tree above; the root, if ``lone``, and has no key then."""
    kids = [f.name for f in runs.schema["kids"].dataType.elementType.fields]
    at_top = F.col("size") <= RUN
    above = F.col("tree") == TOP
    root = at_top & (above | F.lit(lone))
    nodes = runs.select("*", F.posexplode("kids").alias("at", "kid"))
    return nodes.select(
        "tree",
        "level",
        F.col("kid.place").alias("place"),
        F.when(~root, F.when(at_top, TOP).otherwise(F.col("tree"))).alias("to_tree"),
        F.when(~root, F.when(at_top, 0).otherwise(F.col("level") + 1)).alias("to_level"),
        F.when(~root, F.when(at_top, F.col("tree")).otherwise(F.col("run"))).alias("to_place"),
        _segment(F.col("kids"), F.col("at")).alias("proof"),
        (F.col("kid.doc") if "doc" in kids else F.lit(None).cast(DOC)).alias("doc"),
    )


#: What a document's leaf carries through the tables of nodes.
DOC = "struct<id: bigint, leaf: binary, tampered: binary, tree: bigint>"
_TO = ["to_tree", "to_level", "to_place"]


def _jumped(nodes: DataFrame, depth: int) -> DataFrame:
    """Documents with whole proofs: pointers jump to where their ancestors point, and the siblings
    on the way are put one after the other, until all are at the root.

    In the round of distance d only nodes with d levels below them are ancestors. Those that no
    later round can ask for are left out.
    """
    distance = 1
    while distance < depth:
        ahead = nodes.filter((F.col("tree") == TOP) | (F.col("level") >= distance))
        ahead = ahead.select(
            F.col("tree").alias("a"),
            F.col("level").alias("b"),
            F.col("place").alias("c"),
            F.struct(*_TO, "proof").alias("far"),
        )
        moving = nodes.filter("to_tree IS NOT NULL").join(
            ahead, (F.col("to_tree") == F.col("a")) & (F.col("to_level") == F.col("b"))
            & (F.col("to_place") == F.col("c")),
        )
        moved = moving.select(
            "tree",
            "level",
            "place",
            *[F.col(f"far.{c}").alias(c) for c in _TO],
            F.concat("proof", "far.proof").alias("proof"),
            "doc",
        )
        nodes = moved.union(nodes.filter("to_tree IS NULL"))
        distance *= 2
        wanted = F.col("doc").isNotNull()
        if distance < depth:
            wanted = wanted | (F.col("tree") == TOP) | (F.col("level") >= distance)
        nodes = nodes.filter(wanted)
        if distance < depth:
            nodes = stored(nodes, "nodes")
    return nodes.filter("doc IS NOT NULL").select("doc", "proof")


def siblings(proof: bytes) -> Iterator[tuple[list[str], list[str]]]:
    """The digests on the left and on the right of a node and its ancestors, from the leaf up."""
    at = 0
    while at < len(proof):
        left, right = divmod(proof[at], RUN)
        at += 1
        texts = [proof[k : k + 32].hex() for k in range(at, at + 32 * (left + right), 32)]
        at += 32 * (left + right)
        yield texts[:left], texts[left:]


def folded(leaf: bytes, proof: bytes) -> str:
    """The root that a leaf has by its proof."""
    digest = leaf.hex()
    for left, right in siblings(proof):
        digest = sha256("".join((*left, digest, *right)).encode()).hexdigest()
    return digest


def manifest(
    df: DataFrame,
    id_column: str = "doc_id",
    group_column: str = "source",
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    tamper: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """(id, leaf, subroot, root, proof, proof_sha256, folded_root, verified) of each row.

    A row's leaf is the SHA-256 of its ``columns``, each ``-`` if NULL, else its UTF-8 byte count, a
    colon and the value. Per group, leaves ascend by id; every three consecutive nodes become the digest
    of their digests until one is left, the subroot; subroots, by group, likewise give the root.
    ``proof`` holds the siblings of the node and its ancestors, as ``siblings`` reads them. ``tamper``
    makes of a row's id and last column what a verifier sees there; ``folded_root`` follows from that
    and the proof, and ``verified`` is whether it is the root.

    Trees grow by level, a level being one aggregate of runs of three. Proofs come by pointer jumping:
    each node holds its siblings on the way to an ancestor; a join of the nodes with themselves doubles
    the distance, so the rounds are the logarithm of the height.

    NULL ids come first, rows of one id by their leaves; equal rows are leaves of their own with proofs
    of their own; a NULL group is a group, the first. A lone row is subroot and root, with an empty
    proof. An empty table gives an empty one. Ids are integers.
    """
    spark = df.sparkSession
    names = {f"c{k}": name for k, name in enumerate(columns)}
    rows = pick(df, id=id_column, group=group_column, **names)
    values = [F.col(c) for c in names]
    seen = [*values[:-1], tamper(F.col("id"), values[-1])] if tamper else values
    hashed = stored(
        rows.select(
            F.col("id").cast("bigint").alias("id"),
            "group",
            leaf_digest(values).alias("leaf"),
            leaf_digest(seen).alias("tampered"),
        ),
        "leaves",
    )
    leaves = numbered(hashed, "group", ["id", "leaf"], shuffle_partitions(spark))
    doc = F.struct("id", "leaf", "tampered", F.col("number").alias("tree"))
    leaves = stored(
        leaves.select(
            F.col("number").alias("tree"),
            "place",
            "size",
            F.col("leaf").alias("digest"),
            doc.cast(DOC).alias("doc"),
        ),
        "places",
    )
    largest, last = leaves.agg(F.max("size"), F.max("tree")).first()
    if largest is None:
        return spark.createDataFrame([], RESULT)
    trees = last + 1
    runs = _runs(leaves, height(largest))
    tops = leaves.filter("size = 1").select("tree", "digest", "doc")
    for level in runs:
        top = level.filter(F.col("size") <= RUN)
        tops = tops.union(top.select("tree", "digest", F.lit(None).cast(DOC)))
    tops = stored(tops, "subroots")
    upper = _runs(
        tops.select(
            F.lit(TOP).cast("bigint").alias("tree"),
            F.col("tree").alias("place"),
            F.lit(trees).alias("size"),
            "digest",
            "doc",
        ),
        height(trees),
    )
    if upper:
        root = upper[-1].first()["digest"]
    else:
        root = tops.first()["digest"]
    frames = [_nodes(frame, trees == 1) for frame in (*runs, *upper)]
    if not frames:  # a lone row
        proofs = tops.select("doc", F.lit(b"").alias("proof"))
    else:
        nodes = frames[0]
        for frame in frames[1:]:
            nodes = nodes.union(frame)
        proofs = _jumped(stored(nodes, "nodes"), len(frames))
    proven = proofs.select("doc.*", "proof").join(
        tops.select("tree", F.col("digest").alias("subroot")), "tree"
    )
    last_hex = root.hex()

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            digests = [
                sha256("".join(x for pair in siblings(p) for side in pair for x in side).encode())
                for p in batch["proof"]
            ]
            ends = [folded(t, p) for t, p in zip(batch["tampered"], batch["proof"], strict=True)]
            yield pd.DataFrame(
                {
                    "id": batch["id"],
                    "leaf": [x.hex() for x in batch["leaf"]],
                    "subroot": [x.hex() for x in batch["subroot"]],
                    "root": last_hex,
                    "proof": batch["proof"],
                    "proof_sha256": [d.hexdigest() for d in digests],
                    "folded_root": ends,
                    "verified": [end == last_hex for end in ends],
                }
            )

    return proven.select("id", "leaf", "tampered", "subroot", "proof").mapInPandas(verify, RESULT)


RESULT = (
    "id bigint, leaf string, subroot string, root string, proof binary, proof_sha256 string, "
    "folded_root string, verified boolean"
)
