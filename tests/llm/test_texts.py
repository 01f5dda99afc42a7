import hashlib
import random
import zlib
from collections import Counter
from math import log10

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from pricemill.llm import (
    bpe,
    mixing,
    packing,
    quality,
    queries,
    secrets,
    simhash,
    substrings,
    toxicity,
)

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def words(text):
    return (text or "").encode().split()


def spot(text):
    """The hash that Spark takes of a text, NULL being 42."""
    number = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), 42)
    return number - (1 << 64) if number >> 63 else number


def order(row):
    return (row[0] is not None, row[0] or 0, spot(row[1]), row[1] is not None, row[1] or "")


# --- SimHash ------------------------------------------------------------------------------


def groups(pairs, nodes):
    least = {node: node for node in nodes}

    def find(node):
        while least[node] != node:
            node = least[node]
        return node

    for a, b in pairs:
        a, b = find(a), find(b)
        least[max(a, b)] = min(a, b)
    return {node: find(node) for node in nodes}


def close(prints, radius):
    return [
        (a, b)
        for k, (a, x) in enumerate(prints)
        for b, y in prints[:k]
        if bin((x ^ y) & (2**64 - 1)).count("1") <= radius
    ]


def test_fingerprint_follows_its_definition():

    text = "The quick  Brown fox\njumps É the quick brown fox jumps"
    listed = text.encode().lower().split()
    hashes = [
        xxhash.xxh64_intdigest(b" ".join(listed[k : k + 4]), 42) for k in range(len(listed) - 3)
    ]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text, 4) & (2**64 - 1) == bits
    assert simhash.fingerprint("Two WORDS", 4) == np.int64(
        np.uint64(xxhash.xxh64_intdigest(b"two words", 42))
    )
    assert simhash.fingerprint(None, 4) == simhash.fingerprint(" \n", 4) == 0


@pytest.mark.parametrize("radius", [0, 3, 4, 7])
def test_bit_sliced_neighbours_are_those_within_the_radius(radius):
    dice = random.Random(radius)
    centres = [dice.getrandbits(64) for _ in range(4)]
    prints = []
    for _ in range(300):
        x = dice.choice(centres)
        for _ in range(dice.randrange(7)):
            x ^= 1 << dice.randrange(64)
        prints.append(x)
    fp = np.array(prints, np.uint64)
    found = set()
    for a, _, near in simhash.neighbours(fp, [(0, 130), (130, 131), (131, 300)], radius):
        for i, bits in near.items():
            found |= {(a + i, a + j) for j in range(300) if bits >> j & 1 and i != j}
    for a, b in ((0, 130), (131, 300)):
        for i in range(a, b):
            for j in range(a, b):
                if i != j:
                    near = bin(prints[i] ^ prints[j]).count("1") <= radius
                    assert ((i, j) in found) == near


@pytest.mark.parametrize("cell_rows", [8, 4096])
def test_links_connect_what_brute_force_connects(spark, cell_rows):
    dice = random.Random(1)
    prints = [(k, dice.getrandbits(64) - 2**63) for k in range(100)]
    for k in range(100, 400):  # one dense group, and copies of others
        base = prints[0][1] if k < 300 else dice.choice(prints)[1]
        x = base & (2**64 - 1)
        for _ in range(dice.randrange(5)):
            x ^= 1 << dice.randrange(64)
        prints.append((k, x - 2**64 if x >= 2**63 else x))
    frame = spark.createDataFrame(prints, "rep bigint, fp bigint")
    edges = [tuple(r) for r in simhash.links(frame, 4, cell_rows=cell_rows).collect()]
    nodes = [k for k, _ in prints]
    assert groups(edges, nodes) == groups(close(prints, 4), nodes)


@pytest.mark.parametrize("bands", [5, 6, 8])
def test_every_close_pair_shares_a_key(spark, bands):
    dice = random.Random(bands)
    for _ in range(20):
        x = dice.getrandbits(64)
        y = x
        for b in dice.sample(range(64), 4):
            y ^= 1 << b
        signed = [v - 2**64 if v >= 2**63 else v for v in (x, y)]
        frame = spark.createDataFrame([(v,) for v in signed], "fp bigint")
        keys = [set(r[0]) for r in frame.select(simhash.band_keys(F.col("fp"), bands, 4)).collect()]
        assert keys[0] & keys[1]


def test_near_duplicates_of_awkward_rows(odd, none, awkward_rows):
    found = {(r.id, r.fp): r.component for r in simhash.near_duplicates(odd).collect()}
    assert found[0, 0] == found[1, 0] == found[2, 0] == 0  # no words
    one = simhash.fingerprint("one", 4)
    assert found[3, one] == found[4, one] == 3
    shared = simhash.fingerprint(awkward_rows[5][1], 4)
    assert found[None, shared] == found[5, shared] == 5
    assert found[5, simhash.fingerprint("another text of one id", 4)] == 5
    assert simhash.near_duplicates(odd).count() == len(awkward_rows)
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert sum(r.doc_id == 3 for r in rows) == 1 and not any(r.doc_id in (1, 2, 4) for r in rows)
    assert simhash.keep_one(none).count() == 0


def test_one_row_of_each_group_stays(spark):
    long = " ".join(f"word{k}" for k in range(60))
    near, other = f"{long} and", " ".join(f"other{k}" for k in range(60))
    alone = " ".join(f"alone{k}" for k in range(60))
    apart = simhash.fingerprint(long, 4) ^ simhash.fingerprint(near, 4)
    assert 0 < apart.bit_count() <= 30
    rows = [
        (7, long, "a", "x"),
        (7, long, "b", "y"),  # equal in id and text, other columns differ
        (7, near, "a", "x"),  # a near copy under the same id
        (None, long, "a", "x"),  # an exact and a near copy without an id
        (None, near, "a", "x"),
        (3, near, "a", "x"),
        (None, other, "a", "x"),  # the only one of its group, and its copy
        (None, other, "b", "x"),
        (7, alone, "a", "x"),  # another document of a known id
        (20, None, "a", "x"),
        (19, "", "a", "x"),
        (None, None, "a", "x"),
    ]
    for schema in (
        "doc_id bigint, text string, Text string, DOC_ID string",
        "doc_id bigint, text string, lang string, source string",
    ):
        df = spark.createDataFrame(rows, schema).repartition(3)
        kept = simhash.keep_one(df, radius=apart.bit_count())
        assert kept.columns == df.columns
        found = sorted(((r[0], r[1]) for r in kept.collect()), key=str)
        assert found == sorted([(3, near), (None, other), (7, alone), (19, "")], key=str)


# --- repeated passages --------------------------------------------------------------------


def brute_repeats(rows, width):
    seen, found = set(), {}
    for key in sorted({(r[0], r[1]) for r in rows}, key=order):
        listed = words(key[1])
        gone = [False] * len(listed)
        for k in range(len(listed) - width + 1):
            window = tuple(listed[k : k + width])
            if window in seen:
                gone[k : k + width] = [True] * width
            seen.add(window)
        kept = [w for w, g in zip(listed, gone, strict=True) if not g]
        found[key] = (len(listed), sum(gone), b" ".join(kept).decode())
    return found


@pytest.mark.parametrize("width", [1, 3, 20])
def test_repeated_passages_like_brute_force(odd, none, awkward_rows, width):
    expected = brute_repeats(awkward_rows, width)
    result = substrings.remove_repeats(odd, width=width).collect()
    assert Counter((r.id, r.n_words, r.n_removed, r.kept) for r in result) == Counter(
        (row[0], *expected[row[0], row[1]]) for row in awkward_rows
    )
    for r in result:
        pairs = list(zip(r.cuts[::2], r.cuts[1::2], strict=True))
        assert sum(b - a for a, b in pairs) == r.n_removed
        assert all(a[1] < b[0] for a, b in zip(pairs, pairs[1:], strict=False))
    assert substrings.remove_repeats(none, width=width).count() == 0


@pytest.mark.parametrize("hot", [50, None, 0])
def test_an_id_of_many_rows_is_cut_into_blocks(spark, hot):
    dice = random.Random(3)
    shared = [" ".join(dice.choices("abcdefghij", k=25)) for _ in range(6)]
    rows = []
    for k in range(300):
        own = [" ".join(f"w{dice.randrange(5000)}" for _ in range(30)) for _ in range(2)]
        rows.append((hot if k % 3 else k, f" {dice.choice(shared)} ".join(own)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    expected = brute_repeats(rows, 20)
    found = substrings.remove_repeats(frame, width=20)
    assert Counter((r.id, r.n_words, r.n_removed, r.kept) for r in found.collect()) == Counter(
        (row[0], *expected[row]) for row in rows
    )
    rows = frame.withColumnRenamed("doc_id", "ord")
    blocks = substrings._judged(rows, 20).groupBy("block").count().collect()
    assert max(r["count"] for r in blocks) < 60  # of 300, 200 of them of one id


def test_texts_without_repeats_keep_their_columns(odd, none):
    found = substrings.without_repeats(odd, width=20)
    assert found.columns == odd.columns
    texts = {(r[0], r[1]) for r in found.collect()}
    assert (6, "before it all and after") in texts and (0, None) in texts
    assert substrings.without_repeats(none).count() == 0


def test_rolling_hashes_depend_on_the_window_alone():
    listed = np.array([5, 9, 5, 9, 5, 1, 9, 5, 9], np.uint64)
    hashes = substrings.rolling(listed, 3, substrings.BASES[0])
    assert hashes[0] == hashes[2] and hashes[1] == hashes[6] and len(set(hashes.tolist())) == 5


# --- quality rules ------------------------------------------------------------------------


def brute_quality(text):
    text = text or ""
    listed = words(text)
    windows = [tuple(listed[k : k + 8]) for k in range(len(listed) - 7)]
    counts, covered = Counter(windows), set()
    for k, window in enumerate(windows):
        if counts[window] > 1:
            covered.update(range(k, k + 8))
    lines = [line for line in text.split("\n") if line.encode().split()]
    n, repeats = len(listed), len(covered)
    return (
        n,
        sum(len(w.decode()) for w in listed),
        sum(c in quality.SYMBOLS for c in text),
        len(lines) - len(set(lines)),
        repeats,
        n < 20 or 100 * repeats > 30 * n,
    )


def test_quality_counts_like_brute_force(odd, none, awkward_rows):
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    found = quality.quality(odd).collect()
    assert Counter((r.id, *(r[c] for c in columns)) for r in found) == Counter(
        (row[0], *brute_quality(row[1])) for row in awkward_rows
    )
    assert quality.quality(none).count() == 0
    assert quality.keep_good(odd).columns == odd.columns


@pytest.mark.parametrize("broadcast_lines", [0, 1000])
def test_lines_that_many_documents_share_go(spark, broadcast_lines):
    own = lambda k: " ".join(f"w{k}x{j}" for j in range(30))
    rows = [(k, f"{own(k)}\n Subscribe  NOW \nend", "a") for k in range(10)]
    rows += [(50, own(50), "a"), (51, "subscribe now\n" * 30, "a"), (52, own(52), None)]
    rows += [(60 + k, f"{own(0)}\ncopied", "b") for k in range(20)]  # one text twenty times
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    rules = {"min_documents": 5, "share": 0.5, "broadcast_lines": broadcast_lines}
    verdict = {r.id: r for r in quality.quality(df, **rules).collect()}
    assert verdict[0].n_shared_words == 3 and verdict[0].kept
    assert not verdict[51].kept and verdict[52].kept
    assert all(verdict[60 + k].kept and verdict[60 + k].n_shared_words == 0 for k in range(20))
    texts = {r.doc_id: r.text for r in quality.keep_good(df, **rules).collect()}
    assert texts[0] == own(0) and 51 not in texts and texts[60] == f"{own(0)}\ncopied"


@pytest.mark.parametrize("broadcast_lines", [0, 10_000])
def test_hosts_of_many_shared_lines(spark, broadcast_lines):
    dice = random.Random(9)
    lines = [f"line {k} of the menu" for k in range(300)]
    own = lambda k: " ".join(f"w{k}x{j}" for j in range(25))
    rows = []
    for k in range(90):
        shown = dice.sample(lines, 100)
        host = dice.choice(["a", None])
        rows.append((k, "\n".join([own(k), *shown, f"only {k}"]), host))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    counts = {}
    for _, text, host in rows:
        for line in text.split("\n"):
            counts[host, line] = counts.get((host, line), 0) + 1
    rules = {"min_documents": 15, "broadcast_lines": broadcast_lines, "min_left": 0.0}
    found = {r.doc_id: r.text for r in quality.keep_good(df, **rules).collect()}
    for k, text, host in rows:
        left = [line for line in text.split("\n") if counts[host, line] < 15]
        assert found[k] == "\n".join(left)
    assert 1 < len({line for (_, line), n in counts.items() if n >= 15}) < 320


def test_pipeline_takes_lines_of_a_few_per_cent_of_a_large_host(spark):
    own = lambda k: " ".join(f"w{k}x{j}" for j in range(30))
    rows = [(k, own(k) + "\nsubscribe now" * (k < 30), "a", 0) for k in range(1000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars bigint")
    found = corpus_pipeline.quality_rules(spark, df, "").collect()
    assert {r.doc_id: r.text for r in found} == {k: own(k) for k in range(1000)}


# --- secrets ------------------------------------------------------------------------------


def brute_spans(text):
    import re

    patterns = (
        re.compile(
            r"(?i:(password|passwd|secret|token|api_?key))"
            r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            re.ASCII,
        ),
        re.compile("AKIA[A-Z0-9]+"),
        re.compile("[0-9a-f]+"),
    )
    found = []
    for kind, (pattern, least) in enumerate(zip(patterns, (8, 16, 32), strict=True)):
        for match in pattern.finditer(text or ""):
            if len(match.group(0 if kind else 2)) >= least:
                found.append((match.start(), kind, match.end()))
    return [f"{secrets.KINDS[kind][0]}:{a}:{b}" for a, kind, b in sorted(found)]


def test_base_secrets_like_brute_force(spark, odd, none, awkward_rows):
    dice = random.Random(3)
    parts = ["password", "TOKEN", "ſecret", "api_key", "apikey", "=", ":", " ", '"', "'", "AKIA"]
    parts += ["AKIA" + "Z9" * 6, "0123456789abcdef", "deadbeef" * 4, "hunter2hunter2", "é👍", "\n"]
    rows = [(k, "".join(dice.choices(parts, k=12))) for k in range(400)]
    rows += [(1000 + k, r[1]) for k, r in enumerate(awkward_rows)]
    df = spark.createDataFrame(
        [(*r, "l", "s") for r in rows], "doc_id bigint, text string, lang string, source string"
    )
    base = F.filter("spans", lambda s: s["kind"] < secrets.BASE)
    found = secrets.scanned(df).select("id", secrets.span_text(base).alias("base"))
    assert {r.id: r.base for r in found.collect()} == {k: ",".join(brute_spans(t)) for k, t in rows}
    assert secrets.scanned(odd).count() == len(awkward_rows)
    assert secrets.scanned(none).count() == 0


def test_owners_tell_copied_examples_from_live_secrets(spark):
    live, copied = "q7Zk2mVx9TbW4nRs8LcY3pHd", "aB3dE6gH9jK2mN5pQ8rT1vW4"
    rows = [(k, f"see {copied} here", "r", f"owner{k}") for k in range(3)]
    rows += [(9, f"key {live} token={copied}", "r", "owner0"), (10, f"key {live}", "r2", "owner0")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    spans = {r.id: r.spans for r in secrets.scanned(df).collect()}
    assert [s.kind for s in spans[0]] == []  # copied by many, and of the added kind
    assert [(s.kind, s.live) for s in spans[9]] == [(3, True), (0, False)]
    assert spans[9][0].repositories == 2 and spans[9][1].owners == 3
    texts = {r.doc_id: r.text for r in secrets.without_secrets(df).collect()}
    assert texts[9] == "key [secret] [example]" and texts[0] == f"see {copied} here"


def test_each_limit_of_copies_decides_alone(spark):
    values = {
        (9, 1): "q7Zk2mVx9TbW4nRs8LcY3pHd",  # owners, repositories of each
        (6, 1): "aB3dE6gH9jK2mN5pQ8rT1vW4",  # too few repositories
        (5, 4): "zX9cV8bN7mK6jH5gF4dS3aP2",  # too few owners
        (6, 2): "mN5bV4cX3zL2kJ1hG9fD8sA7",
    }
    rows = [
        (100 * n + 10 * k + j, f"text {n} {k} {j} {value}", f"r{j}", f"owner{k}")
        for n, ((owners, each), value) in enumerate(values.items())
        for k in range(owners)
        for j in range(each)
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    spans = {r.id: r.spans for r in secrets.scanned(df, **secrets.WIDELY).collect()}
    live = [{bool(spans[r[0]]) for r in rows if r[0] // 100 == n} for n in range(4)]
    assert live == [{False}, {True}, {True}, {False}]


def test_no_owner_is_not_an_empty_one(spark):
    value = "q7Zk2mVx9TbW4nRs8LcY3pHd"
    rows = [(k, f"text {k} {value}", "r", owner) for k, owner in enumerate((None, "", "a"))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    assert secrets.scanned(df, max_owners=5).first().spans[0].owners == 3


def test_copies_of_a_document_make_no_example(spark):
    twice, copied, wide = "q7Zk2mVx9TbW4nRs8LcY3pHd", "aB3dE6gH9jK2mN5pQ8rT1vW4", "zX9cV8bN7mK6jH5gF4dS3aP2"
    rows = [(k, f"own words {k} {twice}", "r", f"owner{k}") for k in range(2)]
    rows += [(10 + k, f"key {copied}", "r", f"owner{k}") for k in range(9)]  # one text
    rows += [(20 + k, f"text {k} {wide}", "r", f"owner{k}") for k in range(9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    spans = {r.id: r.spans for r in secrets.scanned(df, **secrets.WIDELY).collect()}
    assert all([(s.kind, s.live) for s in spans[k]] == [(3, True)] for k in (0, 1, 10, 18))
    assert spans[10][0].owners == 9 and spans[20] == spans[28] == []
    texts = {r.doc_id: r.text for r in secrets.without_secrets(df, **secrets.WIDELY).collect()}
    assert texts[1] == "own words 1 [secret]" and texts[12] == "key [secret]" and wide in texts[20]


def test_masking_keeps_rows_and_columns(odd, none, awkward_rows):
    found = secrets.without_secrets(odd)
    assert found.columns == odd.columns and found.count() == len(awkward_rows)
    texts = {r[0]: r[1] for r in found.collect()}
    assert texts[10] == '[example]" and [example]' and texts[8] == awkward_rows[8][1]
    assert secrets.without_secrets(none).count() == 0


# --- packing ------------------------------------------------------------------------------


def test_pieces_like_the_library(odd, awkward_rows):
    library = Tokenizer.from_file(BYTES)
    expected = Counter()
    for key, text, *_ in awkward_rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            expected[key, piece, a, b - a, np.array(ids[a:b], "<u4").tobytes()] += 1
    found = packing.pieces(odd, BYTES).collect()
    assert expected == Counter((r[0], r[1], r[2], r[3], bytes(r[4])) for r in found)


def test_packed_sequences_have_no_gaps(odd, none, awkward_rows):
    rows = queries.packed(odd).collect()
    assert {r.doc_id for r in rows} == {row[0] for row in awkward_rows}
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(by_sequence) == -(-sum(r.length for r in rows) // 1024)
    assert queries.packed(none).count() == 0


def fewest(lengths, capacity):
    """The least number of sequences, by trying all ways."""
    best = [len(lengths)]

    def place(rest, rooms):
        if len(rooms) >= best[0]:
            return
        if not rest:
            best[0] = len(rooms)
            return
        for room in {r for r in rooms if r >= rest[0]}:
            left = [*rooms]
            left.remove(room)
            place(rest[1:], [*left, room - rest[0]])
        place(rest[1:], [*rooms, capacity - rest[0]])

    place(sorted(lengths, reverse=True), [])
    return best[0]


@pytest.mark.parametrize("seed", range(40))
def test_plan_uses_all_pieces_and_fixes_no_worse_sets(seed):
    dice = random.Random(seed)
    capacity = dice.choice([10, 23, 100])
    lengths = [dice.randint(1, capacity) for _ in range(dice.randrange(11))]
    groups_ = packing.plan(dict(Counter(lengths)), capacity)
    used = Counter()
    for times, content in groups_:
        assert times > 0 and sum(length * n for length, n in content) <= capacity
        for length, n in content:
            used[length] += times * n
    assert used == Counter(lengths)
    # what the reduction fixes costs nothing: the fewest sequences stay reachable
    left, fixed = dict(Counter(lengths)), 0
    for length in sorted(set(lengths), reverse=True):
        while left.get(length):
            chosen = packing._dominating(left, length, capacity)
            if chosen is None:
                break
            for x in chosen:
                left[x] -= 1
                if not left[x]:
                    del left[x]
            fixed += 1
    rest = [length for length, n in left.items() for _ in range(n)]
    assert fixed + fewest(rest, capacity) == fewest(lengths, capacity)


# --- tokenization automaton ---------------------------------------------------------------


def test_automaton_encodes_and_decodes_like_the_library(odd, none, awkward_rows):
    library = Tokenizer.from_file(WORDS)
    expected = Counter()
    for key, text, *_ in awkward_rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected[key, np.array(ids, "<u4").tobytes(), decoded] += 1
    found = bpe.tokenized(odd, WORDS).collect()
    assert expected == Counter((r[0], bytes(r[1]), r[2]) for r in found)
    assert bpe.tokenized(none, WORDS).count() == 0


def test_automaton_of_random_merges_follows_the_merges():
    """Against merging by rank, with pairs of equal symbols."""
    dice = random.Random(5)
    for _ in range(30):
        symbols = ["a", "b", "c", "a</w>", "b</w>", "c</w>"]
        vocabulary = {s: k for k, s in enumerate(symbols)}
        merges = []
        while len(merges) < 12:
            left = dice.choice([s for s in vocabulary if not s.endswith("</w>")])
            right = dice.choice(list(vocabulary))
            if left + right not in vocabulary:
                vocabulary[left + right] = len(vocabulary)
                merges.append([left, right])
        automaton = bpe.Automaton(vocabulary, merges, "</w>")
        ranks = {tuple(m): k for k, m in enumerate(merges)}
        for _ in range(60):
            word = "".join(dice.choices("abc", k=dice.randint(1, 12)))
            tokens = [*word[:-1], word[-1] + "</w>"]
            while pairs := [p for p in zip(tokens, tokens[1:], strict=False) if p in ranks]:
                best, k = min(pairs, key=ranks.get), 0
                while k < len(tokens) - 1:
                    if (tokens[k], tokens[k + 1]) == best:
                        tokens[k : k + 2] = ["".join(best)]
                    k += 1
            assert automaton.encode(word.encode()) == [vocabulary[t] for t in tokens]


# --- context mixing -----------------------------------------------------------------------


def test_base_scores_like_brute_force(odd, none, awkward_rows):
    held = F.coalesce(F.col("doc_id") % 3 == 0, F.lit(False))
    found = mixing.scored(odd.withColumn("held_out", held)).collect()
    counts = Counter()
    for key, text, *_ in awkward_rows:
        if key is None or key % 3:
            counts.update(mixing.tokens(text))
    n, v = sum(counts.values()), len(counts)
    expected = Counter()
    for key, text, *_ in awkward_rows:
        listed = mixing.tokens(text)
        base = sum(log10((counts[t] + 1) / (n + v + 1)) for t in listed)
        known = sum(counts[t] > 0 for t in listed)
        expected[key, key is not None and key % 3 == 0, len(listed), known, n, round(base, 6)] += 1
    assert expected == Counter((*r[:5], round(r.base_score, 6)) for r in found)
    assert all(np.isfinite(r.score) and r.score < 0 for r in found)
    assert mixing.scored(none.withColumn("held_out", F.lit(False))).count() == 0


def test_bit_model_is_a_distribution_and_learns():
    known = [b"the", b"then", b"there", b"thing", b"other"] * 4
    model = mixing.Model()
    flat = mixing.log10_probabilities(model, [b"a", b"ab"])
    assert np.allclose(flat, [-16 * log10(2), -24 * log10(2)], atol=1e-6)
    mixing.count(model, known)
    for _ in range(20):
        mixing.learn(model, known)
    likely, unlikely = mixing.log10_probabilities(model, [b"these", b"zqxjk"])
    assert likely > unlikely + 2
    every = [bytes([k]) for k in range(256) if k != 32]
    total = (10 ** mixing.log10_probabilities(model, every)).sum()
    assert total <= 1 + 1e-6


def test_scores_tell_phrases_from_shuffled_words(spark):
    dice = random.Random(6)
    words = ["".join(dice.choices("abcdefgh", k=5)) for _ in range(60)]
    phrase = " ".join(dice.sample(words, 30))
    texts = [f"{w} {phrase} {v}" for w, v in zip(words, reversed(words), strict=True)]
    shuffled = " ".join(dice.sample(phrase.split(), 30))
    rows = [(k, t, False) for k, t in enumerate(texts)]
    rows += [(100, phrase, True), (101, shuffled, True)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, held_out boolean")
    found = {r.id: r for r in mixing.scored(df).collect()}
    assert found[100].base_score == pytest.approx(found[101].base_score)
    assert found[100].score > found[101].score + 20
    assert found[100].bits_per_byte < found[101].bits_per_byte


def test_many_contexts_share_no_counts():
    dice = np.random.default_rng(5)
    texts = [t.tobytes() for t in dice.integers(97, 123, (150_000, 9), np.uint8)]
    model = mixing.Model()
    mixing.count(model, texts)
    assert len(model.keys) > 1 << 21
    new = [t.tobytes() for t in dice.integers(65, 91, (2_000, 9), np.uint8)]  # capitals
    stream, starts = mixing._stream(new)
    inside = np.arange(len(stream)) % 10
    for places, lean in mixing._own_leanings(model, stream, starts, without_own=False):
        assert not lean[places[inside > 0]].any()  # no context of these has been seen


def mixing_rows():
    dice = random.Random(12)
    words = ["".join(dice.choices("abcdeé", k=dice.randrange(1, 8))) for _ in range(80)]
    text = lambda: " ".join(words[int(80 * dice.random() ** 2)] for _ in range(dice.randrange(90)))
    rows = [(k, text(), k % 5 == 0) for k in range(60)]
    rows += [(None, text(), False) for _ in range(30)] + [(7, text(), k % 2 == 0) for k in range(30)]
    return rows + [(90, None, False), (91, "", True), (92, rows[0][1], False), (92, rows[0][1], False)]


@pytest.mark.parametrize("block_bytes", [1 << 21, 3000])
def test_scores_are_those_of_the_local_model(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(mixing, "BLOCK_BYTES", block_bytes)
    rows = mixing_rows()
    df = spark.createDataFrame(rows, "doc_id bigint, text string, held_out boolean")
    scores = []
    for partitions in (3, 11):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            found = mixing.scored(df.repartition(partitions)).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)
        scores.append(sorted((str(r.id), r.n_tokens, r.score) for r in found))
    assert scores[0] == scores[1]

    # the same counts and blocks in one process
    size = sum(len((t or "").encode()) for _, t, _ in rows)
    n_blocks = max(1, -(-size // block_bytes))
    dealt = df.select("*", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).alias("block"))
    blocks = {}
    for r in dealt.collect():
        blocks.setdefault(r.block, []).append(r)
    assert (len(blocks) > 1) == (block_bytes == 3000)
    counted = mixing.Model()
    mixing.count(counted, [(t or "").encode() for _, t, held_out in rows if not held_out])
    weights, refined, total = 0, 0, 0
    for some in blocks.values():
        some.sort(key=lambda r: (r.doc_id is None, r.doc_id or 0, r.text is None, (r.text or "").encode()))
        own = mixing.Model(keys=counted.keys, numbers=counted.numbers)
        texts = [(r.text or "").encode() for r in some if not r.held_out]
        n = sum(map(len, texts)) + len(texts)
        if texts:
            mixing.learn(own, texts)
        weights, refined, total = weights + n * own.weights.astype(float), refined + own.refined, total + n
    model = mixing.Model(counted.keys, counted.numbers, (weights / total).astype(np.float32), refined)
    texts = [(t or "").encode() for _, t, _ in rows]
    expected = mixing.log10_probabilities(model, texts)
    wanted = sorted(zip([str(r[0]) for r in rows], expected.tolist(), strict=True))
    assert np.allclose([w for _, w in wanted], sorted_scores(scores[0]), rtol=2e-4)


def test_numbers_are_sent_whole():
    for most in (1, 1 << 8, 1 << 16, 1 << 32, 1 << 60):
        numbers = np.random.default_rng(3).integers(0, most, (9, 50), np.uint64)
        assert (mixing._got(mixing._sent(numbers)).reshape(9, -1) == numbers).all()
    levels = np.array([[0.0, 3.0], [1 << 25, 7.0]], np.float32)
    assert (mixing._got(mixing._sent(levels)).reshape(2, -1) == levels).all()
    assert len(mixing._got(mixing._sent(np.zeros(0, np.uint64)))) == 0


def test_distinct_keys_are_in_order():
    dice = np.random.default_rng(4)
    near = np.uint64(9) << np.uint64(40)  # contexts that agree in the bits which are sorted first
    for keys in (
        dice.integers(0, 1 << 63, 5000, np.uint64),
        dice.integers(0, 600, 5000, np.uint64),
        near + dice.integers(0, 1 << 12, 5000, np.uint64),
        np.zeros(0, np.uint64),
    ):
        unique, places = mixing._unique(keys)
        assert (unique == np.unique(keys)).all() and (unique[places] == keys).all()


def test_exchanged_counts_are_small(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("pricemill.llm.common.shared_folder", lambda _: str(tmp_path))
    dice = random.Random(2)
    words = ["".join(dice.choices("abcdefgh", k=dice.randrange(2, 9))) for _ in range(900)]
    texts = [" ".join(dice.choices(words, k=400)) for _ in range(100)]
    rows = [(k, text, False) for k, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, held_out boolean")
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup)
    assert mixing.scored(df).count() == 100
    assert spark.conf.get(cleanup) == before
    kept = sum(f.stat().st_size for f in tmp_path.rglob("contexts-*/**/*.parquet"))
    assert 0 < kept < 3 * sum(map(len, texts))


def test_compiled_loops_like_the_local_model(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_BYTES", 1 << 24)
    dice = random.Random(21)
    stems = ["x", "é", "common-beginnings-of-long-words-", "ÿ0", "a" * 40, ""]
    words = [dice.choice(stems) + "".join(dice.choices("abcü", k=dice.randrange(4))) for _ in range(300)]
    ends = " \n\t\x01\x00\x1f\r"
    text = lambda: "".join(dice.choice(words) + dice.choice(ends) for _ in range(dice.randrange(200)))
    rows = [(k, text() + "end" * (k % 2), k % 4 == 0) for k in range(80)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, held_out boolean")
    found = {r.id: r for r in mixing.scored(df).collect()}
    model = mixing.Model()
    mixing.count(model, [t.encode() for _, t, held_out in rows if not held_out])
    learned = mixing.Model(model.keys, model.numbers)
    mixing.learn(learned, [t.encode() for _, t, held_out in rows if not held_out])
    expected = mixing.log10_probabilities(learned, [t.encode() for _, t, _ in rows])
    assert np.allclose([found[k].score for k, *_ in rows], expected, rtol=2e-5)
    assert [found[k].n_tokens for k, *_ in rows] == [len(mixing.tokens(t)) for _, t, _ in rows]


def test_scores_need_no_python_workers(spark):
    rows = [(k, f"some words {k} of a text", k % 3 == 0) for k in range(20)]
    df = spark.createDataFrame(rows, "id bigint, text string, held_out boolean")
    shelved = mixing.shelves(df.coalesce(1), 3, 2)
    plans = [shelved, *(mixing.counts(shelved, 4, turn) for turn in mixing.TURNS)]
    for plan in plans:
        shown = plan._jdf.queryExecution().toString()
        assert "mapPartitions" in shown.replace("MapPartitions", "mapPartitions")
        assert not any(step in shown for step in ("InPandas", "InArrow", "EvalPython"))
    answers = plans[1].collect()
    totals = [np.frombuffer(r.data, ">i8") for r in answers if r.shelf < 0]
    known = [t for k, text, held_out in rows if not held_out for t in mixing.tokens(text)]
    assert sum(totals).tolist() == [len(known), len(set(known))]


def sorted_scores(rows):
    return [score for _, score in sorted((key, score) for key, _, score in rows)]


# --- toxicity -----------------------------------------------------------------------------


def test_gradients_like_differences():
    net = toxicity.Network.new(["a", "bad"], seed=3)
    for name in toxicity.LEARNED:
        setattr(net, name, getattr(net, name).astype(np.float64) + 0.01)
    listed, places, sizes = toxicity._places([["a", "bad", "e"], ["xyz", "q", "bad", "a"], ["e"]])
    known, labels = net.numbers(listed), np.array([1.0, 0, 1])
    telling = np.array([0.9 if w == "bad" else 0.0 for w in listed])

    def loss():
        return toxicity.gradients(net, listed, known, telling, places, sizes, labels)

    _, gradient = loss()
    for name in toxicity.LEARNED:
        weights, analytic = getattr(net, name), gradient[name]
        at = np.unravel_index(np.argmax(np.abs(analytic)), analytic.shape)
        before, step = weights[at], 4e-3
        weights[at] = before + step
        above = loss()[0]
        weights[at] = before - step
        below = loss()[0]
        weights[at] = before
        measured = (above - below) / (2 * step)
        assert abs(measured - analytic[at]) < 1e-3 + 0.02 * abs(measured), name


def plain_logit(net, words):
    """The network over one window, a number at a time."""
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def step(state, given, weights):
        width = len(state)
        inner = state @ weights
        update = sigmoid(given[:width] + inner[:width])
        reset = sigmoid(given[width : 2 * width] + inner[width : 2 * width])
        candidate = np.tanh(given[2 * width :] + reset * inner[2 * width :])
        return update * state + (1 - update) * candidate

    features = []
    for word in words:
        ends = []
        for d, letters in enumerate((word, word[::-1])):
            state = np.zeros(toxicity.CHAR_STATE)
            for c in letters:
                vector = net.chars[ord(c) % toxicity.CHAR_BUCKETS]
                state = step(state, vector @ net.char_in[d] + net.char_bias[d], net.char_state[d])
            ends.append(state)
        features.append(np.concatenate([*ends, net.words[net.vocabulary.get(word, 0)]]))
    sides = []
    for d, order in enumerate((features, features[::-1])):
        state, states = np.zeros(toxicity.STATE), []
        for x in order:
            state = step(state, x @ net.word_in[d] + net.word_bias[d], net.word_state[d])
            states.append(state)
        sides.append(states if d == 0 else states[::-1])
    states = [np.concatenate(both) for both in zip(*sides, strict=True)]
    marks = [np.tanh(s @ net.attention + net.attention_bias) @ net.attention_out for s in states]
    weights = np.exp(marks) / np.exp(marks).sum()
    return sum(w * s for w, s in zip(weights, states, strict=True)) @ net.out + net.out_bias[0]


def test_scores_are_the_networks_highest_window():
    dice = random.Random(5)
    words = ["".join(dice.choices("abcdeéß", k=dice.randrange(1, 15))) for _ in range(40)]
    net = toxicity.Network.new(sorted(words[:20]), seed=2)
    net.words[:] = np.random.default_rng(1).standard_normal(net.words.shape)
    texts = [" ".join(dice.choices(words, k=n)) for n in (1, 5, 31, 32, 33, 90, 200)]
    found = toxicity.Scorer(net).scores([None, *texts, " ,", ""])
    assert found[0] == found[-1] == found[-2] == 0
    for text, score in zip(texts, found[1:-2], strict=True):
        cut = toxicity.WORD.findall(text)
        last = max(len(cut) - toxicity.WINDOW, 0)
        starts = {*range(0, last, toxicity.WINDOW // 2), last}
        logit = max(plain_logit(net, cut[s : s + toxicity.WINDOW]) for s in starts)
        assert abs(score - 1 / (1 + np.exp(-logit))) < 1e-4


def test_toxicity_on_held_out_documents(spark, small):
    folder = small.replace("0.001", "0.1")
    found = queries.op5_toxicity(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = found.join(labels, "doc_id").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    for part in (True, False):
        toxic = [r.predicted for r in rows if r.held_out == part and r.toxic == 1]
        clean = [r.predicted for r in rows if r.held_out == part and r.toxic == 0]
        assert sum(toxic) >= 0.9 * len(toxic)
        assert sum(clean) <= 0.03 * len(clean)


def test_toxicity_of_awkward_rows(spark, odd, none, awkward_rows):
    labels = spark.createDataFrame(
        [(10, 1), (11, 0), (None, 1), (5, None), (6, 7)], "doc_id bigint, toxic int"
    )
    for known in (labels, labels.limit(0)):
        rows = toxicity.scored(odd, known).collect()
        assert len(rows) == len(awkward_rows)
        assert all(0 <= r.score <= 1 for r in rows)
        assert all(r.score == 0 for r in rows if r.id in (0, 1, 2))
    assert toxicity.scored(none, labels).count() == 0


def test_windows_cover_the_whole_text():
    for n in (0, 1, 31, 32, 33, 56, 57, 1000):
        starts = toxicity.window_starts(n)
        covered = {k for s in starts.tolist() for k in range(s, min(s + toxicity.WINDOW, n))}
        assert covered == set(range(n))


# --- digests ------------------------------------------------------------------------------


def test_queries_derive_their_digests(spark, small):
    texts = {
        r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()
    }
    library = Tokenizer.from_file(WORDS)
    for r in queries.op10_bpe_automaton(spark, small).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    for r in queries.op8_context_mixing(spark, small).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
    expected = brute_repeats(list(texts.items()), 20)
    for r in queries.op9_repeated_passages(spark, small).collect():
        n, gone, kept = expected[r.doc_id, texts[r.doc_id]]
        assert (r.n_words, r.n_removed) == (n, gone)
        assert r.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()
