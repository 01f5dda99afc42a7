"""Packing of tokenized documents into sequences of a fixed length."""

import os
import re
import struct
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricemill.llm.common import BLANK, LETTERS, PLAIN, byte_characters, pick, shuffle_partitions, stored

#: Pieces of one length that are numbered in one group, about.
GROUP_ROWS = 100_000
#: Words whose ids a task remembers at most.
REMEMBERED = 300_000
#: How the file's pre-tokenizer cuts plain texts: a space goes with the word after it.
WORDS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z{LETTERS}]+| ?[0-9]+| ?[^{BLANK}A-Za-z0-9{LETTERS}]+"
    f"|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+"
)


# --- tokens -------------------------------------------------------------------------------


class Encoder:
    """The ids of texts, as little-endian unsigned 32-bit numbers, by a byte-level BPE file.

    Plain texts are cut into words by a pattern that does what the file's pre-tokenizer does with
    them, and each distinct word goes through the library's model once. Others, and texts with
    special tokens, go through the library whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.characters = dict(enumerate(byte_characters()))
        self.known: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        if not PLAIN.fullmatch(text) or any(token in text for token in self.special):
            return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        words = WORDS.findall(text)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        for word in set(words).difference(self.known):
            octets = word.encode().decode("latin-1").translate(self.characters)
            self.known[word] = _packed([token.id for token in self.model.tokenize(octets)])
        return b"".join(map(self.known.__getitem__, words))


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def pieces(
    df: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = 1024,
    end_id: int = 2,
) -> DataFrame:
    """(id, piece, start, length, ids) of each row: its ids and then the end id.

    Rows of more than ``capacity`` ids are cut into pieces of just that many, the first of which may
    be shorter. ``ids`` holds little-endian unsigned 32-bit numbers. A NULL text is an empty one. Rows
    that repeat give their pieces again, a NULL id is kept, and an empty table gives an empty one.
    ``tokenizer`` is the path of a byte-level BPE file that the workers can read.
    """
    rows = pick(df, id=id_column, text=text_column)
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        encoder = Encoder(tokenizer)
        for batch in batches:
            for k in range(0, len(batch), 200):
                some = batch.slice(k, 200)
                found, rows = [], []
                for row, text in enumerate(some["text"].to_pylist()):
                    ids = encoder.encode(text or "") + end
                    n = len(ids) // 4
                    cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                    for piece, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                        rows.append(row)
                        found.append((piece, a, b - a, ids[4 * a : 4 * b]))
                columns = zip(*found, strict=True)
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
                arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [some["id"].take(pa.array(rows)), *arrays],
                    ["id", "piece", "start", "length", "ids"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, piece int, start bigint, length bigint, ids binary")


# --- the plan -----------------------------------------------------------------------------


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Sequences for pieces counted by length: (how many alike, [(length, copies), ...]).

    Only the lengths count, so the work depends on the capacity and not on the number of pieces.
    First Martello and Toth's reduction: sets of up to three pieces that provably dominate all
    other sets with the same longest piece are fixed for good, as often as the pieces last. The
    rest is packed best-fit, longest pieces first, all pieces of a length at once.
    """
    left = {length: n for length, n in counts.items() if n}
    if any(not 0 < length <= capacity for length in left):
        raise ValueError("lengths must be between 1 and the capacity")
    found = []
    changed = True
    while changed:
        changed = False
        for longest in sorted(left, reverse=True):
            while left.get(longest):
                chosen = _dominating(left, longest, capacity)
                if chosen is None:
                    break
                content = [(length, chosen.count(length)) for length in sorted(set(chosen))]
                times = min(left[length] // copies for length, copies in content)
                found.append((times, content))
                for length, copies in content:
                    left[length] -= times * copies
                    if not left[length]:
                        del left[length]
                changed = True
    return found + _best_fit(left, capacity)


def _dominating(left: dict[int, int], longest: int, capacity: int) -> list[int] | None:
    """A set with a longest piece that dominates all others with it, if one of up to three does.

    A set dominates another if the other's pieces can be dealt out so that each share fits in the
    place of one of its own pieces: swapping them then costs no sequence.
    """
    room = capacity - longest
    rest = sorted(
        length for length, n in left.items() if length <= room and n > (length == longest)
    )
    if not rest:
        return [longest]
    largest = rest[-1]
    if largest == room:
        return [longest, largest]
    # all sums of two and more pieces that fit, whatever the number of copies
    once = sum(1 << length for length in rest)
    mask = (1 << (room + 1)) - 1
    sums, more = 0, once
    while more:
        step = 0
        for length in rest:
            step |= more << length
        more = step & mask & ~sums
        sums |= more
    if sums.bit_length() - 1 <= largest:
        return [longest, largest]
    if 3 * rest[0] > room:  # no set of four: which pairs go with the longest?
        spare = room - largest
        second = max(
            (x for x in rest if x <= spare and left[x] > [longest, largest].count(x)), default=None
        )
        if second is not None:
            over = [x for x in rest if x > second]
            good = all(
                c + d <= largest or c + d > room for d in over for c in rest if c >= d
            )
            if good:
                return [longest, largest, second]
    return None


def _best_fit(left: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best-fit by falling length. ``open_at`` lists alike sequences by the room they have left."""
    open_at: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}

    def put(room: int, times: int, content: list[tuple[int, int]]) -> None:
        if times:
            open_at.setdefault(room, []).append((times, content))

    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            room = min((r for r in open_at if r >= length), default=None)
            if room is None:
                times, content, room = ceil(n / (capacity // length)), [], capacity
            else:
                times, content = open_at[room].pop()
                if not open_at[room]:
                    del open_at[room]
            each = room // length
            full = min(times, n // each)
            put(room - each * length, full, [*content, (length, each)])
            n -= full * each
            times -= full
            if times and n:
                put(room - n * length, 1, [*content, (length, n)])
                n, times = 0, times - 1
            if content:
                put(room, times, content)
    return [group for groups in open_at.values() for group in groups]


def placements(
    groups: list[tuple[int, list[tuple[int, int]]]],
) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first, past, sequence, copies, offset): pieces of a length numbered from first to
    past go to sequences from ``sequence`` on, so many copies to each, from ``offset`` on."""
    numbered: dict[int, int] = {}
    rows, sequence = [], 0
    for times, content in groups:
        offset = 0
        for length, copies in content:
            first = numbered.get(length, 0)
            numbered[length] = first + times * copies
            rows.append((length, first, first + times * copies, sequence, copies, offset))
            offset += length * copies
        sequence += times
    return rows


# --- operator -----------------------------------------------------------------------------


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``: as few sequences as it can.

    ``pieces`` has id, piece and length, and any other columns. The driver sees the number of
    pieces of each length (as many rows as the capacity, at most) and plans the sequences by them;
    the pieces of a length are numbered in groups on the executors and look up their places.
    Offsets of a sequence run from 0 without gaps. Pieces that repeat, or have no id, are pieces like
    others, each with a place of its own. An empty table gives an empty one.
    """
    spark = pieces.sparkSession
    pieces = stored(pieces, "pieces")
    counts = {row[0]: row[1] for row in pieces.groupBy("length").count().collect()}
    total = sum(counts.values())
    places = spark.createDataFrame(
        placements(plan(counts, capacity)),
        "length bigint, first bigint, past bigint, sequence bigint, copies bigint, base bigint",
    )
    groups = max(shuffle_partitions(spark), ceil(total / GROUP_ROWS))
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("id", "piece"), F.lit(groups)))
    before = Window.partitionBy("length").orderBy("part")
    firsts = dealt.groupBy("length", "part").agg(F.count("*").alias("n"))
    firsts = firsts.select(
        "length", "part", (F.sum("n").over(before) - F.col("n")).alias("before")
    )
    within = Window.partitionBy("length", "part").orderBy("id", "piece", F.xxhash64(*_hashable(pieces)))
    number = F.row_number().over(within)
    numbered = dealt.withColumn("own", number).join(firsts, ["length", "part"])
    numbered = numbered.withColumn("number", F.col("before") + F.col("own") - 1)
    number, first, copies = F.col("n.number"), F.col("p.first"), F.col("p.copies")
    joined = numbered.alias("n").join(
        F.broadcast(places.alias("p")),  # a few rows for each length: bounded by the capacity
        (F.col("n.length") == F.col("p.length")) & (number >= first) & (number < F.col("p.past")),
    )
    turn = number - first
    return joined.select(
        *(f"n.{c}" for c in pieces.columns),
        (F.col("p.sequence") + F.floor(turn / copies)).alias("sequence_id"),
        (F.col("p.base") + turn % copies * F.col("n.length")).alias("offset"),
    )


def _hashable(df: DataFrame) -> list[Column]:
    return [F.col(f.name) for f in df.schema.fields if f.dataType.typeName() != "map"]
