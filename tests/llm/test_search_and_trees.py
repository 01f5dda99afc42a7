"""Nearest neighbours, manifests and spelling variants against brute force."""

import random
import re
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricemill.llm import manifest, nearest, queries, spelling

# --- nearest neighbours -------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, label int, Vec_ID string"


def good_vectors(rows):
    good = set()
    for key, v, *_ in rows:
        if key is None or not v or None in v:
            continue
        x = np.array(v, np.float32).astype(float)
        if np.isfinite(x).all() and x.any():
            good.add((key, tuple(x.tolist())))
    return good


def brute_nearest(rows, every, k):
    good = good_vectors(rows)
    found = []
    for key, v in good:
        if key % every:
            continue
        others = []
        for other in good:
            if other != (key, v) and len(other[1]) == len(v):
                total = 0.0
                for x, y in zip(v, other[1], strict=True):
                    total += (x - y) ** 2
                others.append((float(np.sqrt(total)), other[0]))
        found += [(key, r, i, s) for r, (s, i) in enumerate(sorted(others)[:k], 1)]
    return sorted(found)


def awkward_vectors():
    dice = np.random.default_rng(3)
    centre = dice.standard_normal(12)
    rows = [(k, (centre + 10.0 ** -(k % 9) * dice.standard_normal(12)).tolist()) for k in range(300)]
    rows += [(400 + k, rows[10][1]) for k in range(120)]  # copies: ties by id
    rows += [(600 + k, [1e30 * x for x in rows[k][1]]) for k in range(12)]
    rows += [(700 + k, [1e-40 * x for x in rows[k][1]]) for k in range(12)]
    rows += [(800, None), (810, []), (820, [0.0] * 12), (830, [float("nan")] + [1.0] * 11)]
    rows += [(840, [None] + [1.0] * 11), (850, [float("inf")] + [1.0] * 11), (None, rows[0][1])]
    rows += [(860, [1.0, 2.0]), (861, [1.0, 2.5]), rows[3], (870, rows[7][1]), (870, rows[8][1])]
    return [(*r, 0, "x") for r in rows]


@pytest.mark.parametrize(("query_block", "candidate_block"), [(1024, 4096), (7, 50)])
def test_nearest_like_brute_force(spark, query_block, candidate_block):
    rows = awkward_vectors()
    frame = spark.createDataFrame(rows, VECTORS).repartition(3)
    found = nearest.nearest(
        frame, every=10, k=10, query_block=query_block, candidate_block=candidate_block
    ).collect()
    assert sorted((r.query_id, r.rank, r.id, r.score) for r in found) == brute_nearest(rows, 10, 10)


def test_nearest_of_few_and_of_none(spark):
    few = [(0, [1.0, 0.0], 0, ""), (10, [0.0, 1.0], 0, ""), (3, [1.0, 1.0], 0, "")]
    found = nearest.nearest(spark.createDataFrame(few, VECTORS), every=10, k=10).collect()
    assert sorted((r.query_id, r.rank, r.id) for r in found) == [
        (0, 1, 3), (0, 2, 10), (10, 1, 3), (10, 2, 0)
    ]
    assert nearest.nearest(spark.createDataFrame([], VECTORS)).count() == 0


@pytest.mark.parametrize("size", [3, 64, 2500])
def test_bounds_hold_the_distance(size):
    dice = np.random.default_rng(size)
    x = dice.standard_normal((40, size)) * 10.0 ** dice.integers(-8, 8, (40, 1))
    y = np.vstack([x[:10] * (1 + 1e-9), dice.standard_normal((30, size))])
    a, b = nearest.Codes(x), nearest.Codes(y)
    low, high = nearest.bounds(a, b)
    true = np.sqrt(((x[:, None] - y[None]) ** 2).sum(axis=2))
    assert (low <= true).all() and (true <= high).all()
    whole = a.codes.astype(np.int64) @ b.codes.astype(np.int64).T
    assert (nearest.products(a.codes, b.codes) == whole).all()


# --- manifests ----------------------------------------------------------------------------


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def item(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    """All levels of a tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest(*last[k : k + 3]) for k in range(0, len(last), 3)])
    return levels


def way(levels, place):
    """(left, right) siblings from a leaf up."""
    for level in levels[:-1]:
        run = level[place // 3 * 3 : place // 3 * 3 + 3]
        yield run[: place % 3], run[place % 3 + 1 :]
        place //= 3


def tampered_text(key, text):
    if key is None or text is None or zlib.crc32(str(key).encode()) % 2:
        return text
    return text.replace("\n", "")


def brute_manifest(rows):
    leaf = lambda r, t: digest(item(r[0]), item(r[3]), item(r[2]), item(r[4]), item(t))
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(
            (r[0] is not None, r[0] or 0, leaf(r, r[1]), leaf(r, tampered_text(r[0], r[1])), r[0])
        )
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:4])]) for g in order}
    top = tree([trees[g][-1][0] for g in order])
    found = []
    for number, g in enumerate(order):
        for place, (_, _, own, seen, key) in enumerate(sorted(groups[g], key=lambda x: x[:4])):
            steps = [*way(trees[g], place), *way(top, number)]
            end = seen
            for left, right in steps:
                end = digest(*left, end, *right)
            proof = digest(*(x for left, right in steps for x in (*left, *right)))
            root = top[-1][0]
            found.append((key, own, trees[g][-1][0], root, proof, end, end == root))
    return sorted(found, key=str)


def proven(spark, rows, schema):
    def tamper(key, text):
        chosen = F.crc32(key.cast("string")) % 2 == 0
        return F.when(chosen, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)

    frame = spark.createDataFrame(rows, schema).repartition(4)
    found = manifest.manifest(frame, tamper=tamper).collect()
    for r in found:
        assert manifest.folded(bytes.fromhex(r.leaf), r.proof) == r.root
    keys = ("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[k] for k in keys) for r in found), key=str)


def document_rows(sizes):
    rows = []
    for g, n in sizes.items():
        rows += [(len(rows) + k, f"line {k}\nof {g}", "en", g, k, "x") for k in range(n)]
    random.Random(1).shuffle(rows)
    return rows


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, Text string"


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 1},
        {"a": 2},
        {"a": 29},
        {"a": 1, "b": 1},
        {None: 4, "": 1, "Z": 28, "a": 3, "é": 9, "中": 1, "hot": 250},
        {f"s{k}": 1 + k % 3 for k in range(30)},
    ],
)
def test_manifest_like_brute_force(spark, sizes):
    rows = document_rows(sizes)
    assert proven(spark, rows, SCHEMA) == brute_manifest(rows)


def test_manifest_of_awkward_rows(spark, awkward_rows):
    rows = awkward_rows + [(7, "again\n", "en", "h", 1, "")] * 40 + [(None, None, None, None, None, "")] * 2
    assert proven(spark, rows, SCHEMA) == brute_manifest(rows)


def test_manifest_of_nothing(none):
    found = manifest.manifest(none)
    assert found.collect() == [] and "proof" in found.columns


# --- spelling variants --------------------------------------------------------------------


def brute_words(rows):
    counts = {}
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            if key is not None:
                h = zlib.crc32(f"{key}:{run}".encode())
                if h % 97 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_variants(rows):
    words = brute_words(rows)
    found = {}
    for w, n in words.items():
        near = sorted((-m, v) for v, m in words.items() if is_near(w, v))
        taken = bool(near) and -near[0][0] >= 2 * n
        found[w] = (near[0][1] if taken else None, n, len(near), -near[0][0] if taken else None)
    result = []
    for w, (form, n, count, form_n) in found.items():
        root = w
        while found[root][0]:
            root = found[root][0]
        result.append((w, form, root, n, count, form_n))
    return sorted(result)


def variant_rows(spark, rows, schema, **limits):
    found = spelling.variants(spark.createDataFrame(rows, schema).repartition(3), **limits)
    return sorted(tuple(r) for r in found.collect())


def misspelt_rows():
    dice = random.Random(6)
    words = ["".join(dice.choices("abcdeéÿß×", k=dice.randrange(4, 8))) for _ in range(60)]
    texts = []
    for k in range(150):
        listed = []
        for _ in range(60):
            word = words[int(60 * dice.random() ** 3)]
            if dice.random() < 0.3:
                at = dice.randrange(len(word))
                word = word[:at] + dice.choice(["", "a", "É", "ab"]) + word[at + 1 :]
            listed.append(word.upper() if dice.random() < 0.1 else word)
        texts.append((k, " ".join(listed)))
    return texts


@pytest.mark.parametrize("cell_letters", [64 * 5, spelling.CELL_LETTERS])
def test_variants_like_brute_force(spark, cell_letters):
    rows = misspelt_rows()
    long = "q" * 3000
    rows += [(200 + k, f"{long} {long}x {long[1:]} anagram granama") for k in range(4)]
    found = variant_rows(spark, rows, "doc_id bigint, text string", cell_letters=cell_letters)
    assert found == brute_variants(rows)
    assert any(r[2] != r[1] and r[1] for r in found)  # a form of a form


def test_variants_of_awkward_rows(spark, awkward_rows, none):
    rows = awkward_rows * 3
    found = variant_rows(spark, rows, SCHEMA)
    assert found == brute_variants([(r[0], r[1]) for r in rows])
    assert spelling.variants(none).collect() == []


def test_squares_of_one_edit_are_at_most_two():
    a = spelling.Side(["abcde", "bacde", "vwxyz"], np.ones(3))
    same = spelling.Side(["abcdd", "edcba", "vwxyé"], np.ones(3))
    i, j = spelling.close(a, same)
    assert {(0, 0), (2, 2)} <= set(zip(i.tolist(), j.tolist(), strict=True))
    near = spelling.one_edit(a, same, i, j)
    assert sorted(zip(i[near].tolist(), j[near].tolist(), strict=True)) == [(0, 0), (2, 2)]
    longer = spelling.Side(["abcdef", "xabcde", "vwxxyz"], np.ones(3))
    i, j = spelling.close(a, longer)
    near = spelling.one_edit(a, longer, i, j)
    assert sorted(zip(i[near].tolist(), j[near].tolist(), strict=True)) == [(0, 0), (0, 1), (2, 2)]


@pytest.mark.parametrize("name", ["op11_nearest", "op12_manifest", "op13_spelling"])
def test_has_sql(name):
    assert name in queries.QUERIES and name in queries.SQL
