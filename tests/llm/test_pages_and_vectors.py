import io
import os
import random
import struct
import zipfile
from hashlib import sha1

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pricemill.llm import components, embeddings, quality, simhash, warc

# --- components ---------------------------------------------------------------------------


def least_reachable(edges):
    least = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(least[a], least[b])
            for n in (a, b):
                changed |= least[n] != low
                least[n] = low
    return least


@pytest.mark.parametrize("kind", ["random", "path", "star", "none"])
def test_components(spark, kind):
    dice = random.Random(2)
    edges = {
        "random": [(dice.randrange(80), dice.randrange(80)) for _ in range(60)],
        "path": [(k + 1, k) for k in dice.sample(range(60), 60)],
        "star": [(99, k) for k in range(60)] + [(200, 200)],
        "none": [],
    }[kind]
    frame = spark.createDataFrame(edges + [(None, 1)], "a bigint, b bigint")
    found = components.connected_components(frame).collect()
    assert {r.node: r.component for r in found} == least_reachable(edges)
    assert len(found) == len({r.node for r in found})


# --- embeddings ---------------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, label int, Embedding string"


def brute_links(rows, threshold):
    good = {}
    for key, v in {(r[0], tuple(r[1]) if r[1] is not None else None) for r in rows}:
        if key is None or v is None or None in v or not v:
            continue
        x = np.array(v, np.float32).astype(float)
        if np.isfinite(x).all() and x.any():
            good[key, v] = x / np.linalg.norm(x)
    links = {k: set() for k in good}
    for a, x in good.items():
        for b, y in good.items():
            if a != b and len(x) == len(y) and x @ y >= threshold:
                links[a].add(b)
    return links


@pytest.mark.parametrize("cell_rows", [16, 1024])
def test_vectors_link_like_brute_force(spark, cell_rows):
    random_ = np.random.default_rng(1)
    centres = random_.standard_normal((6, 16))
    rows = []
    for k in range(300):  # a dense group, thin groups and loners
        centre = centres[0] if k < 150 else centres[random_.integers(6)]
        noise = 0.05 if k % 3 else 0.4
        rows.append((k, (centre + noise * random_.standard_normal(16)).tolist()))
    rows += [(400 + k, rows[0][1]) for k in range(20)]  # copies
    rows += [(500, [2 * x for x in rows[5][1]]), (501, None), (502, []), (503, [0.0] * 16)]
    rows += [(504, [float("nan")] + [1.0] * 15), (505, [None] + [1.0] * 15), (506, [1.0, 2.0])]
    rows += [(507, [float("inf")] + [1.0] * 15), (508, [1.0, 2.0]), rows[3], (None, rows[0][1])]
    frame = spark.createDataFrame([(*r, 0, "x") for r in rows], VECTORS)
    found = embeddings.near_duplicates(frame, cell_rows=cell_rows).collect()
    assert len(found) == len(rows)
    links = brute_links(rows, 0.95)
    ids = {k[0]: len(v) for k, v in links.items()}
    least = least_reachable([(a[0], b[0]) for a, near in links.items() for b in near])
    for r in found:
        if r.id is None:
            assert (r.n_links, r.component, r.kept) == (0, None, False)
        else:
            assert r.n_links == ids.get(r.id, 0), r
            assert r.component == least.get(r.id, r.id) and r.kept == (r.component == r.id)


def test_no_vectors(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def test_tables_miss_few_pairs_at_the_threshold():
    for n in (0, 100, 10**5, 10**9):
        tables, bits = embeddings.tables_for(n, 0.95)
        together = (1 - np.arccos(0.95) / np.pi) ** bits
        assert (1 - together) ** tables <= embeddings.MISSED


# --- WARC packages ------------------------------------------------------------------------

PAGES = "page_id bigint, url string, html string, Html string"


def test_pages_come_back_whole(spark):
    big, other = "é" * 600, "x" * 999
    rows = [(k, f"http://a/{k}", big) for k in range(30)]
    rows += [(100, "u", other), (101, "u", other), (102, None, None), (103, "a\r\nb", "")]
    rows += [(110, "None", "z"), (111, "", "z")]  # a url that says so, and none
    rows += [(104, "u", "y" * 300_000), (29, "again", big), (None, "u", big), (3, "u", "z" * 2000)]
    frame = spark.createDataFrame([(*r, "c") for r in rows], PAGES).repartition(4)
    found = warc.archived(frame).collect()
    assert len(found) == len(rows)
    payload = {r.payload_digest: bytes(r.payload) for r in found if r.record_type == "response"}
    for r in found:
        assert payload[r.payload_digest] is not None
    expected = []
    for key, _, html in rows:
        data = (html or "").encode()
        revisit = html == big and key is not None and key != 29
        expected.append(
            (key, len(data), sha1(data).hexdigest(), "revisit" if revisit else "response",
             29 if revisit else None)
        )
    same = lambda r: (str(r[0]), r[1], r[2])
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(got, key=same) == sorted(expected, key=same)
    assert payload[sha1(big.encode()).hexdigest()] == big.encode()
    assert {r.url for r in found if r.page_id in (102, 103)} == {None, "a b"}
    assert {r.page_id: r.url for r in found if r.page_id in (110, 111)} == {110: "None", 111: ""}
    assert warc.archived(spark.createDataFrame([], PAGES)).count() == 0


def buffer(members, zip64=False, comment=b""):
    out = io.BytesIO()
    writer = warc.ZipWriter(out, zip64)
    for name, data in members.items():
        writer.begin(name)
        for k in range(0, len(data), 7):
            writer.write(data[k : k + 7])
        writer.end()
    writer.close()
    whole = out.getvalue()
    if comment:
        whole = whole[:-2] + struct.pack("<H", len(comment)) + comment
    return whole


@pytest.mark.parametrize("zip64", [False, True])
@pytest.mark.parametrize("comment", [b"", b"PK\x05\x06 is no end"])
def test_directories_are_those_of_a_zip_file(zip64, comment):
    members = {"a": b"first" * 10, "dir/é.bin": bytes(range(256)) * 3, "empty": b""}
    whole = buffer(members, zip64, comment)
    if not comment:  # what we write, others read
        with zipfile.ZipFile(io.BytesIO(whole)) as other:
            assert {n: other.read(n) for n in other.namelist()} == members
    file = pa.BufferReader(whole)
    found = warc.central_directory(file, len(whole))
    assert {n: warc.read_range(file, *place) for n, place in found.items()} == members


def test_what_others_write_we_read(tmp_path):
    path = tmp_path / "x.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as other:
        with other.open("big", "w", force_zip64=True) as member:
            member.write(b"data" * 100)
        other.writestr("deflated", b"z" * 1000, zipfile.ZIP_DEFLATED)
        other.writestr("plain", b"plain")
    whole = path.read_bytes()
    file = pa.BufferReader(whole)
    found = warc.central_directory(file, len(whole))
    assert {n: warc.read_range(file, *p) for n, p in found.items()} == {
        "big": b"data" * 100, "plain": b"plain",
    }
    with pytest.raises(ValueError, match="end record"):
        warc.central_directory(pa.BufferReader(whole[:-30]), len(whole) - 30)


def test_packages_are_cut_and_zip64(spark, tmp_path):
    rows = [(k, f"u{k}", f"{k} " * 2000) for k in range(40)]
    pages = spark.createDataFrame(rows, "id bigint, url string, html string").coalesce(1)
    written = warc.write_packages(
        warc.with_revisits(pages), str(tmp_path / "w"), zip64=True, package_bytes=2000
    ).cache()
    assert written.count() > 3 and written.agg(F.sum("records")).first()[0] == 40
    found = warc.read_packages(written, read_bytes=500).collect()
    assert {r.page_id: bytes(r.payload).decode() for r in found} == {k: h for k, _, h in rows}
    assert all(os.path.getsize(r.path) == r["size"] for r in written.collect())


# --- pipeline -----------------------------------------------------------------------------


def test_pipeline_like_its_stages_by_hand(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == [
        "quality_rules", "simhash_near_dedup", "substring_dedup", "secret_scans",
        "best_fit_packing",
    ]
    kept = {r.id for r in quality.quality(docs).filter("kept").collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in kept}
    prints = {k: simhash.fingerprint(t, 4) & (2**64 - 1) for k, t in texts.items()}
    pairs = [
        (a, b) for a, x in prints.items() for b, y in prints.items()
        if a < b and bin(x ^ y).count("1") <= 4
    ]
    least = least_reachable(pairs)
    left = sorted(k for k in texts if least.get(k, k) == k)
    seen, whole = set(), {}
    for key in left:
        words = texts[key].encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            window = tuple(words[k : k + 20])
            if window in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(window)
        if not words or not all(gone):
            whole[key] = sum(gone)
    rows = corpus_pipeline.run(spark, small).collect()
    assert {r.doc_id for r in rows} == set(whole)
    third = corpus_pipeline.STAGES[2][1](
        spark, docs.filter(F.col("doc_id").isin(left)), small
    )
    assert third.columns == docs.columns
    assert all(r.n_chars == len(r.text) for r in third.collect())


@pytest.mark.parametrize("stage", range(4))
def test_stages_take_awkward_and_empty_documents(spark, odd, none, small, stage):
    name, function = corpus_pipeline.STAGES[stage]
    found = function(spark, odd, small)
    assert found.columns == odd.columns
    if name != "quality_rules":
        assert found.count() > 0
    assert function(spark, none, small).count() == 0
