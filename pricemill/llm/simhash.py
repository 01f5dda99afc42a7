"""SimHash near-duplicates: fingerprints, and links by bit-sliced comparison."""

from collections.abc import Iterator
from itertools import combinations
from math import ceil

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricemill.llm.common import pick, stored
from pricemill.llm.components import connected_components

BITS = 64
#: Rows of a cell of the comparison at most, so that a bucket of any size is met in bounded tasks.
CELL_ROWS = 4096
#: Cells of (query, word of 64 candidates) that are compared at once.
CELLS = 1 << 18


# --- fingerprints -------------------------------------------------------------------------


def fingerprint(text: str | None, shingle: int) -> int:
    """The SimHash of a text, as a signed 64-bit number.

    Words of the text, A-Z in lower case, form shingles (all of them, repeats included; fewer
    words than a shingle holds: one shingle of what there is). A bit is 1 if more than half of
    the shingles' XXH64 hashes have it. No text or no word: 0.
    """
    words = (text or "").encode().lower().split()  # for bytes: ASCII letters, ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    wide = min(shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (
            digest(joined[a:b], 42)
            for a, b in zip(starts[: len(words) - wide].tolist(), ends[wide:].tolist(), strict=True)
        ),
        np.uint64,
        len(words) - wide,
    )
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        octets = hashes[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 4
) -> DataFrame:
    """(id, fp) for each row, in one pass without a shuffle. Copies are hashed once per batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            codes, texts = pd.factorize(batch["text"], use_na_sentinel=False)
            prints = np.array(
                [fingerprint(t if isinstance(t, str) else None, shingle) for t in texts], np.int64
            )
            yield pd.DataFrame({"id": batch["id"], "fp": prints[codes]})

    rows = pick(df, id=id_column, text=text_column)
    return rows.mapInPandas(run, f"id {rows.schema['id'].dataType.simpleString()}, fp bigint")


# --- links --------------------------------------------------------------------------------


def bands_for(rows: int, radius: int) -> int:
    """Into how many bands to cut a fingerprint: more bands, longer keys, smaller buckets.

    Two fingerprints within the radius agree on all bands but ``radius`` of them, whatever the
    number of bands, so the choice changes the work and not the links.
    """
    bands = radius + 1
    while BITS * (bands - radius) // bands < np.log2(max(rows, 1)) - 7 and bands < 2 * radius:
        bands += 1
    return bands


def band_keys(fp: Column, bands: int, radius: int) -> Column:
    """An array of (table, key): the bits of each choice of bands that may have to agree."""
    edges = [BITS * k // bands for k in range(bands + 1)]
    keys = []
    for table, chosen in enumerate(combinations(range(bands), bands - radius)):
        mask = sum((1 << edges[b + 1]) - (1 << edges[b]) for b in chosen)
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        keys.append(F.struct(F.lit(table).alias("t"), fp.bitwiseAND(F.lit(signed)).alias("key")))
    return F.array(*keys)


def links(prints: DataFrame, radius: int, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Edges (a, b) that connect all distinct (rep, fp) rows within the radius of each other.

    Every pair within the radius meets in a bucket of at least one table and is compared there.
    A bucket of more than ``cell_rows`` rows is dealt out to cells of pairs of its parts. Of each
    cell only a spanning forest of its links leaves, so dense buckets don't emit all their pairs.
    """
    bands = bands_for(prints.count(), radius)
    rows = prints.select("rep", "fp", F.inline(band_keys(F.col("fp"), bands, radius)))
    large = stored(
        rows.groupBy("t", "key").count().filter(F.col("count") > cell_rows), "large-buckets"
    )
    parts = F.ceil(F.coalesce(F.col("count"), F.lit(1)) / cell_rows).cast("int")
    own = F.pmod(F.xxhash64("fp", "t"), F.col("parts")).cast("int")
    cells = (
        rows.join(large, ["t", "key"], "left")
        .withColumn("parts", parts)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "rep",
            "fp",
            "own",
            F.struct(
                "t", "key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y")
            ).alias("cell"),
        )
    )
    cells = cells.select("rep", "fp", "cell", F.xxhash64("cell").alias("place"))
    dealt = cells.repartition("cell").sortWithinPartitions("place", "cell", "rep")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            batch = pd.DataFrame({c: batch[c] for c in ("rep", "fp", "place")})
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            place = batch["place"].to_numpy()
            last = np.searchsorted(place, place[-1]) if len(place) else 0
            rest = batch.iloc[last:]
            if last:
                yield linked(batch.iloc[:last], radius)
        if rest is not None and len(rest):
            yield linked(rest, radius)

    return dealt.select("rep", "fp", "place").mapInPandas(run, "a bigint, b bigint")


def linked(rows: pd.DataFrame, radius: int) -> pd.DataFrame:
    """A spanning forest of the links within each place of the rows, which are sorted by place."""
    fp = rows["fp"].to_numpy().view(np.uint64)
    rep = rows["rep"].to_numpy()
    place = rows["place"].to_numpy()
    bounds = np.flatnonzero(np.r_[True, place[1:] != place[:-1], True])
    found_a, found_b = [], []
    group, cells = [], 0
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a > 1:
            group.append((a, b))
            cells += (b - a) * ceil((b - a) / 64)
        if cells >= CELLS:
            _forest(fp, rep, group, radius, found_a, found_b)
            group, cells = [], 0
    _forest(fp, rep, group, radius, found_a, found_b)
    return pd.DataFrame(
        {"a": np.array(found_a, np.int64), "b": np.array(found_b, np.int64)}
    )


def _forest(fp, rep, groups, radius, found_a, found_b) -> None:
    """Append the links of the groups' spanning forests."""
    if not groups:
        return
    for a, b, near in neighbours(fp, groups, radius):
        left = set(near)
        while left:
            root = left.pop()
            seen = new = 1 << root
            while new:
                reached = 0
                while new:
                    low = new & -new
                    reached |= near.get(low.bit_length() - 1, 0)
                    new ^= low
                new = reached & ~seen
                seen |= new
            seen ^= 1 << root
            while seen:
                low = seen & -seen
                k = low.bit_length() - 1
                left.discard(k)
                found_a.append(rep[a + root])
                found_b.append(rep[a + k])
                seen ^= low


def neighbours(
    fp: np.ndarray, groups: list[tuple[int, int]], radius: int
) -> Iterator[tuple[int, int, dict[int, int]]]:
    """For each group of fingerprints with links: its range, and each member's links as a bit set.

    The group's fingerprints lie vertically: word w of plane k holds bit k of 64 of them. A cell is
    a query against one such word. Eight planes at a time go through carry-save adders into three
    counter words, which hold 64 distances at once; a cell whose 64 distances all exceed the
    radius is dropped before the next eight planes.
    """
    if not 0 <= radius <= 7:
        raise ValueError("the counters hold radii up to 7")
    # where each group's words are, and the vertical planes
    firsts, lane_word, lane_bit, cell_query, cell_word = [], [], [], [], []
    words = 0
    for a, b in groups:
        wide = -(-(b - a) // 64)
        firsts.append(words)
        lanes = np.arange(b - a)
        lane_word.append(words + lanes // 64)
        lane_bit.append(lanes % 64)
        cell_query.append(np.repeat(np.arange(a, b), wide))
        cell_word.append(np.tile(np.arange(words, words + wide), b - a))
        words += wide
    members = np.concatenate([np.arange(a, b) for a, b in groups])
    lane_word, lane_bit = np.concatenate(lane_word), np.concatenate(lane_bit)
    query, word = np.concatenate(cell_query), np.concatenate(cell_word)
    used = np.zeros(words, np.uint64)
    np.bitwise_or.at(used, lane_word, np.uint64(1) << lane_bit.astype(np.uint64))
    grid = np.zeros((words, 64), np.uint64)
    grid[lane_word, lane_bit] = fp[members]
    one = np.uint64(1)
    weights = one << np.arange(64, dtype=np.uint64)

    def plane(k: int) -> np.ndarray:
        return (((grid >> np.uint64(k)) & one) * weights).sum(axis=1, dtype=np.uint64)

    asked = fp[query]
    ones = twos = fours = over = np.zeros(len(query), np.uint64)
    for first in range(0, BITS, 8):
        d = [
            plane(k)[word] ^ (np.uint64(0) - ((asked >> np.uint64(k)) & one))
            for k in range(first, first + 8)
        ]
        ones, two_a = _carry_save(ones, d[0], d[1])
        ones, two_b = _carry_save(ones, d[2], d[3])
        twos, four_a = _carry_save(twos, two_a, two_b)
        ones, two_a = _carry_save(ones, d[4], d[5])
        ones, two_b = _carry_save(ones, d[6], d[7])
        twos, four_b = _carry_save(twos, two_a, two_b)
        fours, eights = _carry_save(fours, four_a, four_b)
        over = over | eights
        alive = ~(over | _exceeds(ones, twos, fours, radius)) & used[word]
        on = alive != 0
        if not on.all():
            query, word, asked, alive = query[on], word[on], asked[on], alive[on]
            ones, twos, fours, over = ones[on], twos[on], fours[on], over[on]
        if not len(query):
            return
    starts = np.array([a for a, _ in groups])
    owner = np.searchsorted(starts, query, side="right") - 1
    lane = (query - starts[owner]).tolist()
    shift = (64 * (word - np.array(firsts)[owner])).tolist()
    near: dict[int, dict[int, int]] = {}
    for g, i, s, bits in zip(owner.tolist(), lane, shift, alive.tolist(), strict=True):
        of = near.setdefault(g, {})
        of[i] = of.get(i, 0) | bits << s
    for g, of in near.items():
        yield *groups[g], {i: bits for i, bits in of.items() if bits != 1 << i}


def _carry_save(x, y, z):
    """Bitwise sum and carry of three words."""
    part = x ^ y
    return part ^ z, (x & y) | (part & z)


def _exceeds(ones, twos, fours, radius):
    """The lanes whose three-bit count is above the radius."""
    above = np.zeros_like(ones)
    equal = ~above
    for counter, bit in ((fours, 4), (twos, 2), (ones, 1)):
        if radius & bit:
            equal = equal & counter
        else:
            above = above | (equal & counter)
            equal = equal & ~counter
    return above


# --- operator -----------------------------------------------------------------------------


def near_duplicates(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = 4,
    radius: int = 4,
) -> DataFrame:
    """(id, fp, component) for each row: documents whose fingerprints chain within the radius.

    ``component`` is the smallest id reachable. Texts that are NULL, empty or without a word have
    fingerprint 0 and link with each other. Rows that repeat an id are one document; a row whose id
    is NULL links nothing and gets the component of its fingerprint, NULL if no other row has it.
    An empty table gives an empty one.
    """
    prints = stored(fingerprints(df, id_column, text_column, shingle), "fingerprints")
    reps = stored(prints.groupBy("fp").agg(F.min("id").alias("rep")), "classes")
    known = reps.dropna()
    # rows of one id with different texts belong together as well
    repeats = prints.dropna().groupBy("id").agg(F.min("fp").alias("x"), F.max("fp").alias("y"))
    both = repeats.filter("x <> y").select("id", F.explode(F.array("x", "y")).alias("fp"))
    same = both.join(reps, "fp").select("id", "rep")
    edges = stored(links(known, radius).union(same), "links")
    found = connected_components(edges)
    classes = stored(
        reps.join(found, reps["rep"] == found["node"], "left").select(
            "fp", F.coalesce("component", "rep").alias("component")
        ),
        "components",
    )
    return prints.join(classes, "fp", "left").select("id", "fp", "component")


def keep_one(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = 4,
    radius: int = 4,
) -> DataFrame:
    """One row of each group of near-duplicates: that with the smallest id, rows without one last, ties
    by a hash of the text. All columns are kept.

    Groups are of texts, whose fingerprints chain within the radius; ids only choose among their rows, so
    rows without an id, or of one id with other texts, count like others. NULL and empty texts, and
    those without a word, are one group. Of rows equal in id and text one stays, whatever their other
    columns. An empty table gives an empty one.
    """
    plain = df.toDF(*(f"_{k}" for k in range(len(df.columns))))  # names may differ in case alone
    row_id, text = (f"_{df.columns.index(c)}" for c in (id_column, text_column))
    plain = plain.withColumn("key", F.xxhash64(text))
    prints = fingerprints(plain, "key", text, shingle).distinct()
    prints = stored(prints.withColumnRenamed("id", "key"), "fingerprints")
    classes = stored(prints.select("fp", F.col("fp").alias("rep")).distinct(), "classes")
    found = connected_components(stored(links(classes, radius), "links"))
    groups = prints.join(found, prints["fp"] == found["node"], "left").select(
        "key", F.coalesce("component", "fp").alias("group")
    )
    # the smallest id of each text, then of each group: copies are combined before they move
    least = plain.groupBy("key").agg(F.min(F.struct(F.col(row_id).isNull(), row_id)).alias("id"))
    firsts = groups.join(least, "key").groupBy("group").agg(F.min(F.struct("id", "key")).alias("f"))
    stay = stored(firsts.select(F.col(f"f.id.{row_id}").alias("_id"), F.col("f.key").alias("_key")), "kept")
    same = F.col(row_id).eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    left = plain.join(stay, same, "left_semi").dropDuplicates([row_id, "key"])
    return left.drop("key").toDF(*df.columns)
