"""Spelling variants: words of one edit, found by products of letter-count matrices in blocks."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricemill.llm.common import pick, stored

#: Runs of these are words; they have one byte each in Latin-1.
LETTERS = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Letters are put into so many classes by their code points. One edit moves at most two of the
#: classes' counts, so words meet in blocks of equal or adjacent counts only.
CLASSES = 4
#: Letters of one side of a cell, words being counted with at least LEAST letters each.
CELL_LETTERS = 1 << 18
LEAST = 64
#: Words of a tile, and letters compared at once.
TILE = 1024
COMPARED = 1 << 22


def words(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_length: int = 5,
    least_count: int = 3,
    misspelt: int = 97,
) -> DataFrame:
    """(word, n): the words that the texts hold often enough, A to Z in lower case.

    A run of letters loses a letter where ``misspelt`` divides the CRC-32 of ``<id>:<run>``: the one at
    that number modulo its length. Runs of rows whose id is NULL stay as they are; NULL texts have none.
    """
    docs = pick(df, id=id_column, text=text_column)
    lowered = F.translate("text", UPPER, LOWER)
    runs = docs.select("id", F.explode(F.regexp_extract_all(lowered, F.lit(LETTERS), F.lit(0))).alias("run"))
    runs = runs.filter(F.length("run") >= least_length)  # a word is never longer than its run
    h = F.crc32(F.concat(F.col("id").cast("string"), F.lit(":"), F.col("run")))
    at = (h % F.length("run")).cast("int")
    shorter = F.concat(
        F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run"))
    )
    found = runs.select(F.when(h % misspelt == 0, shorter).otherwise(F.col("run")).alias("word"))
    counts = found.groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter((F.length("word") >= least_length) & (F.col("n") >= least_count))


def _moves(classes: int) -> list[tuple[int, ...]]:
    """How the letters, and those of each class, can differ between two words of one edit; of two
    opposite differences one. The first is none at all."""
    one = [[int(k == j) for k in range(classes)] for j in range(classes)]
    moves = [(0, *(0 for _ in range(classes)))]
    moves += [
        (0, *(x - y for x, y in zip(one[i], one[j], strict=True)))
        for i in range(classes)
        for j in range(i + 1, classes)
    ]
    return moves + [(1, *row) for row in one]


def class_counts(word: Column, classes: int) -> list[Column]:
    """How many letters of a word each class has."""
    letters = [chr(c) for c in (*range(0x61, 0x7B), *range(0xC0, 0x100))]
    counts = []
    for k in range(classes):
        others = "".join(c for c in letters if ord(c) % classes != k)
        counts.append(F.length(F.translate(word, others, "")))
    return counts


def cells(vocabulary: DataFrame, classes: int, cell_letters: int) -> DataFrame:
    """(cell, left, right, side, word, n): words dealt out to the cells where they may meet others.

    A cell compares the words of two blocks, or of a block with itself. Sides too large for one task
    are split, and each part of one side meets each of the other.
    """
    counts = [f"_c{k}" for k in range(classes)]
    sized = vocabulary.withColumns(
        {"_l": F.length("word")} | dict(zip(counts, class_counts(F.col("word"), classes), strict=True))
    )
    places = []
    for number, move in enumerate(_moves(classes)):
        key = [F.col(c) for c in ("_l", *counts)]
        base = [F.col(c) - d for c, d in zip(("_l", *counts), move, strict=True)]
        for side, own in ((0, key), (1, base)):
            places.append(
                F.struct(
                    F.xxhash64(F.lit(number), *own).alias("cell"),
                    F.lit(number > 0).alias("two"),
                    F.lit(side).alias("side"),
                )
            )
    dealt = sized.select("word", "n", F.col("_l").alias("length"), F.inline(F.array(*places)))
    room = F.lit(cell_letters) / F.greatest("length", F.lit(LEAST))
    sides = stored(
        dealt.groupBy("cell", "side")
        .agg(F.ceil(F.count("*") / F.first(room)).cast("int").alias("parts"))
        .groupBy("cell")
        .agg(
            F.max(F.when(F.col("side") == 0, F.col("parts"))).alias("lefts"),
            F.max(F.when(F.col("side") == 1, F.col("parts"))).alias("rights"),
        )
        .dropna()
        .filter("lefts > 1 OR rights > 1"),
        "large-cells",
    )
    left = F.col("side") == 0
    lefts, rights = (F.coalesce(c, F.lit(1)) for c in ("lefts", "rights"))
    own = F.pmod(F.xxhash64("word"), F.when(left, lefts).otherwise(rights)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(left, rights).otherwise(lefts) - 1))
    split = dealt.join(sides, "cell", "left").select(
        "cell", "two", "side", "word", "n", own.alias("own"), other.alias("other")
    )
    return split.select(
        "cell",
        F.when(left, F.col("own")).otherwise(F.col("other")).alias("left"),
        F.when(left, F.col("other")).otherwise(F.col("own")).alias("right"),
        "side",
        "two",
        "word",
        "n",
    )


_COLUMN = np.zeros(256, np.int64)
_COLUMN[0x61:0x7B] = np.arange(26)
_COLUMN[0xC0:] = np.arange(26, 90)


class Side:
    """Words of one length: their letters, the counts of these, and how often the words occur."""

    def __init__(self, words: list[str], n: np.ndarray) -> None:
        self.words, self.n = words, n
        self.letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
        self.letters = self.letters.reshape(len(words), -1)
        self.length = self.letters.shape[1]
        places = _COLUMN[self.letters] + np.arange(len(words))[:, None] * 90
        self.counts = np.bincount(places.ravel(), minlength=90 * len(words)).reshape(-1, 90)


def close(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of words whose letter counts are at most two apart, in squares: from one product of
    matrices that have the squares of their rows beside them."""
    # whole numbers, which add up without rounding below 2^24 and 2^53
    number = np.float32 if a.length + b.length < 2000 else np.float64
    used = (a.counts.any(axis=0)) | (b.counts.any(axis=0))
    x, y = a.counts[:, used].astype(number), b.counts[:, used].astype(number)
    squares = [(v * v).sum(axis=1, keepdims=True) for v in (x, y)]
    x = np.hstack([x, squares[0], np.ones_like(squares[0])])
    y = np.hstack([-2 * y, np.ones_like(squares[1]), squares[1]]).T
    left, right = [], []
    for at in range(0, len(x), TILE):
        for to in range(0, y.shape[1], TILE):
            # the same letters in another order are no single edit
            tile = np.abs(x[at : at + TILE] @ y[:, to : to + TILE] - 1.5) < 1
            i, j = np.nonzero(tile)
            left.append(i + at)
            right.append(j + to)
    return np.concatenate(left), np.concatenate(right)


def one_edit(a: Side, b: Side, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which of these pairs differ by exactly one letter; words of ``b`` have as many letters as
    those of ``a``, or one more."""
    near = np.zeros(len(i), bool)
    step = max(1, COMPARED // a.length)
    for at in range(0, len(i), step):
        x, y = a.letters[i[at : at + step]], b.letters[j[at : at + step]]
        if a.length == b.length:
            near[at : at + step] = (x != y).sum(axis=1) == 1
        else:
            first = np.logical_and.accumulate(x == y[:, :-1], axis=1).sum(axis=1)
            last = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], axis=1).sum(axis=1)
            near[at : at + step] = first + last >= a.length
    return near


def _best(own: Side, other: Side, i: np.ndarray, j: np.ndarray) -> Iterator[tuple]:
    """(word, near words, the largest n of them, the first word of that n) of words with near ones."""
    if not len(i):
        return
    some, place = np.unique(j, return_inverse=True)
    names = [other.words[k] for k in some]
    rank = np.empty(len(some), np.int64)
    rank[sorted(range(len(some)), key=names.__getitem__)] = np.arange(len(some))
    order = np.lexsort((rank[place], -other.n[j], i))
    i, j = i[order], j[order]
    starts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
    for k, count in zip(starts.tolist(), np.diff(np.r_[starts, len(i)]).tolist(), strict=True):
        yield own.words[i[k]], count, int(other.n[j[k]]), other.words[j[k]]


def _compared(rows: pd.DataFrame) -> Iterator[tuple]:
    """What the words of one cell find among each other."""
    side = rows["side"].to_numpy()
    turn = int(np.searchsorted(side, 1))
    if turn == 0 or turn == len(rows):
        return
    n, listed = rows["n"].to_numpy(), rows["word"].tolist()
    a, b = Side(listed[:turn], n[:turn]), Side(listed[turn:], n[turn:])
    i, j = close(a, b)
    near = one_edit(a, b, i, j)
    i, j = i[near], j[near]
    yield from _best(a, b, i, j)
    if rows["two"].iloc[0]:  # a block with itself has each word on both sides
        yield from _best(b, a, j, i)


def near_words(
    vocabulary: DataFrame, classes: int = CLASSES, cell_letters: int = CELL_LETTERS
) -> DataFrame:
    """(word, n_near, form_n, form) of words with near ones: how many, and the one that occurs most.

    Blocks hold words of one length and equal numbers of letters of each class. Blocks meet where one
    edit can lead from one to the other: a product of their letter counts gives squared distances, pairs
    of at most two go on, and their letters decide. Of a cell only counts and best words leave.
    """
    cell = ["cell", "left", "right"]
    dealt = cells(vocabulary, classes, cell_letters)
    dealt = dealt.repartition(*cell).sortWithinPartitions(*cell, "side")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            bounds = cell_bounds(batch)
            rest = batch.iloc[bounds[-2] :]
            yield from found(batch, bounds[:-1])
        if rest is not None and len(rest):
            yield from found(rest, cell_bounds(rest))

    def cell_bounds(batch: pd.DataFrame) -> np.ndarray:
        place = batch[cell].to_numpy()
        if not len(place):
            return np.zeros(2, np.int64)
        return np.flatnonzero(np.r_[True, (place[1:] != place[:-1]).any(axis=1), True])

    def found(batch: pd.DataFrame, bounds: np.ndarray) -> Iterator[pd.DataFrame]:
        near = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a > 1:
                near += _compared(batch.iloc[a:b])
        if near:
            yield pd.DataFrame(near, columns=["word", "n_near", "form_n", "form"])

    near = dealt.mapInPandas(run, "word string, n_near bigint, form_n bigint, form string")
    best = F.min(F.struct(-F.col("form_n"), "form"))
    return near.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.col1")).alias("form_n"), F.col("best.form").alias("form")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of rows (word, form): where the forms of forms end.

    Each round, every word's pointer jumps to where the word it points at points; n at least doubles
    from word to form, so the rounds are the logarithm of a logarithm.
    """
    pointers = stored(forms.select("word", F.col("form").alias("root")), "pointers")
    while True:
        ahead = pointers.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = pointers.join(ahead, "root", "left")
        moved = F.col("next").isNotNull()
        pointers = stored(
            jumped.select("word", F.coalesce("next", "root").alias("root"), moved.alias("moved")),
            "pointers",
        )
        if pointers.filter("moved").isEmpty():
            return pointers.select("word", "root")
        pointers = pointers.select("word", "root")


def variants(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_length: int = 5,
    least_count: int = 3,
    misspelt: int = 97,
    times: int = 2,
    classes: int = CLASSES,
    cell_letters: int = CELL_LETTERS,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n): words of the texts with their spelling variants.

    Words are near if one letter inserted, deleted or replaced makes one of the other. A word's form is
    its near word that occurs most (ties: the first by code points), if that occurs at least ``times``
    (two or more) times as often as the word; its root is where the forms of forms end, the word
    itself if it has no form.

    NULL and empty texts hold no words, rows whose id is NULL keep theirs whole, repeated rows count as
    often as they occur. No words, no rows.
    """
    vocabulary = stored(
        words(df, id_column, text_column, least_length, least_count, misspelt), "words"
    )
    near = near_words(vocabulary, classes, cell_letters)
    taken = F.col("form_n") >= times * F.col("n")
    judged = stored(
        vocabulary.join(near, "word", "left").select(
            "word",
            F.when(taken, F.col("form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(taken, F.col("form_n")).alias("form_n"),
        ),
        "variants",
    )
    ends = roots(judged.filter("form IS NOT NULL"))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
