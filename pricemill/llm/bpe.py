"""Byte pair encoding by an automaton that is compiled from the merges."""

import functools
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from pricemill.llm.common import BLANK, LETTERS, PLAIN, byte_characters, pick

#: Distinct words that a task remembers at most.
REMEMBERED = 300_000
#: Arcs that it remembers, beside those lost, of which there are as many as merges.
REMEMBERED_ARCS = 2_000_000
START = -1
#: How the file's pre-tokenizer cuts plain texts in lower case.
WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LETTERS}]+|[0-9]|[^{BLANK}a-z0-9{LETTERS}]+")


class Automaton:
    """Accepts just the token sequences that the merges produce; its arcs carry tokens.

    At first there is one state, with an arc for each symbol. The gadget of a merge (u, v), applied
    for all merges in order, makes the pair u, v impossible and the merged token w possible in its
    place: the state that u leads to loses its arc v; w leads to a new state with the arcs that the
    state of v has at that time; and wherever there is an arc u there is now an arc w.

    As a state is known by the token that leads to it, the gadgets are kept as tables: what arcs a
    state lost and when, whose arcs it copied and when, and which token's arcs a token's copied.
    An arc is looked up along these copies, once for each pair that turns up. A word has one path.
    """

    def __init__(self, vocabulary: dict[str, int], merges: list[list[str]], word_end: str) -> None:
        self.lost: dict[int, dict[int, int]] = {}
        self.copied_state: dict[int, int] = {}
        self.copied_arcs: dict[int, int] = {}
        self.born: dict[int, int] = {}
        self.arcs: dict[int, bool] = {}
        usable = {vocabulary[token] for token in _symbols(vocabulary, word_end)}
        for rank, (left, right) in enumerate(merges):
            u, v, w = vocabulary[left], vocabulary[right], vocabulary[left + right]
            if w in usable:
                raise ValueError("two merges make one token")
            if u in usable and v in usable and self.has_arc(u, v):
                self._gadget(u, v, w, rank)
                usable.add(w)
        self.arcs.clear()  # looked up while the automaton grew
        self._trie(vocabulary, usable, word_end)

    def _gadget(self, u: int, v: int, w: int, rank: int) -> None:
        self.copied_state[w], self.copied_arcs[w], self.born[w] = v, u, rank
        self.lost.setdefault(u, {})[v] = rank

    def has_arc(self, state: int, token: int) -> bool:
        """Whether the state that a token leads to has an arc for another token."""
        before = None
        while state is not None:
            if lost := self.lost.get(state):
                since, arc = None, token
                while arc is not None:
                    when = lost.get(arc)
                    # a copy of a state has what was lost before it; a twin of an arc also what its
                    # own merge lost (a pair of equal tokens)
                    if (
                        when is not None
                        and (before is None or when < before)
                        and (since is None or when <= since)
                    ):
                        return False
                    since, arc = self.born.get(arc), self.copied_arcs.get(arc)
            before, state = self.born.get(state), self.copied_state.get(state)
        return True

    def _trie(self, vocabulary: dict[str, int], usable: set[int], word_end: str) -> None:
        """The tokens by their symbols: bytes, or 256 more than a byte at the end of a word."""
        octet = {character: number for number, character in enumerate(byte_characters())}
        self.child: dict[int, int] = {}
        self.token_of = [START]
        self.length: dict[int, int] = {}
        for token, number in vocabulary.items():
            if number not in usable:
                continue
            body = token.removesuffix(word_end)
            symbols = [octet[c] for c in body]
            if body != token:
                symbols[-1] += 256
            node = 0
            for symbol in symbols:
                key = node << 9 | symbol
                if key not in self.child:
                    self.child[key] = len(self.token_of)
                    self.token_of.append(START)
                node = self.child[key]
            self.token_of[node] = number
            self.length[number] = len(symbols)

    def encode(self, word: bytes) -> list[int]:
        """The tokens on the word's path.

        The path of a word begins with the path of each of its prefixes, so the token that ends a
        prefix is found once and for all when an arc first reaches it.
        """
        if not word:
            return []
        child, token_of, arcs = self.child, self.token_of, self.arcs
        symbols = list(word)
        symbols[-1] += 256
        n = len(symbols)
        last = [START] * (n + 1)
        for at in range(n):
            state, node = last[at], 0
            for k in range(at, n):
                node = child.get(node << 9 | symbols[k])
                if node is None:
                    break
                token = token_of[node]
                if token == START or last[k + 1] != START:
                    continue
                if at:
                    arc = state << 32 | token
                    possible = arcs.get(arc)
                    if possible is None:
                        possible = arcs[arc] = self.has_arc(state, token)
                    if not possible:
                        continue
                last[k + 1] = token
        path = []
        while n:
            path.append(last[n])
            n -= self.length[last[n]]
        return path[::-1]


def _symbols(vocabulary: dict[str, int], word_end: str) -> list[str]:
    both = [c + end for c in byte_characters() for end in ("", word_end)]
    return [symbol for symbol in both if symbol in vocabulary]


class Tokenizer:
    """Encodes and decodes whole texts by the automaton of a tokenizer file.

    Texts of plain characters are cut into words by one pattern, others by the library's own
    normaliser and pre-tokenizer. Decoding emits the labels of the arcs, joined as the library does
    without a decoder.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer as Library

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        library = Library.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.automaton = Automaton(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.label = {number: token for token, number in model["vocab"].items()}
        added = library.get_added_tokens_decoder()
        self.special = {t.content: number for number, t in added.items()}
        self.label |= {number: t.content for number, t in added.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_pattern = re.compile(f"({'|'.join(map(re.escape, longest_first))})")
        self.octet = {character: number for number, character in enumerate(byte_characters())}
        self.ids: dict[str, bytes] = {}
        self.labels: dict[str, str] = {}

    def _emitted(self, tokens: list[int]) -> tuple[bytes, str]:
        """The ids as bytes, and the labels, each after a space."""
        ids = b"".join([token.to_bytes(4, "little") for token in tokens])
        return ids, "".join([" " + self.label[token] for token in tokens])

    def _library_words(self, text: str) -> list[str]:
        pieces = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))
        return [bytes([self.octet[c] for c in piece]).decode() for piece, _ in pieces]

    def _encode(self, text: str) -> tuple[bytes, str]:
        """Of a text without special tokens."""
        words = WORDS.findall(text.lower()) if PLAIN.fullmatch(text) else self._library_words(text)
        if len(self.ids) > REMEMBERED:
            self.ids.clear()
            self.labels.clear()
        if len(self.automaton.arcs) > REMEMBERED_ARCS:
            self.automaton.arcs.clear()
        for word in set(words).difference(self.ids):
            self.ids[word], self.labels[word] = self._emitted(
                self.automaton.encode(word.encode())
            )
        return b"".join(map(self.ids.__getitem__, words)), "".join(
            map(self.labels.__getitem__, words)
        )

    def encode(self, text: str) -> tuple[bytes, str]:
        """The ids as little-endian unsigned 32-bit numbers, and what they decode to."""
        if any(token in text for token in self.special):
            found = [
                self._emitted([self.special[part]]) if k % 2 else self._encode(part)
                for k, part in enumerate(self.special_pattern.split(text))
            ]
            ids, labels = b"".join(f[0] for f in found), "".join(f[1] for f in found)
        else:
            ids, labels = self._encode(text)
        return ids, labels[1:]


@functools.lru_cache(maxsize=1)
def tokenizer_of(path: str) -> Tokenizer:
    """The compiled automaton of a file: once for each worker process, whose tasks share it."""
    return Tokenizer(path)


def tokenized(
    df: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, ids, decoded) of each row, in one pass without a shuffle.

    ``tokenizer`` is the path of a BPE file with word ends that the workers can read. ``ids`` holds
    little-endian unsigned 32-bit numbers, ``decoded`` the text they decode to, special tokens
    included. NULL and empty texts have no ids and decode to an empty text. Each row is encoded for
    itself, repeated or not. An empty table gives an empty one.
    """
    rows = pick(df, id=id_column, text=text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer_of(tokenizer)
        for batch in batches:
            for k in range(0, len(batch), 200):
                some = batch.slice(k, 200)
                found = [coder.encode(text or "") for text in some["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        some["id"],
                        pa.array([ids for ids, _ in found], pa.binary()),
                        pa.array([decoded for _, decoded in found], pa.string()),
                    ],
                    ["id", "ids", "decoded"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, ids binary, decoded string")
