"""WARC archives packed in ZIP files: written by tasks, read back by ranges.

A package is a ZIP file whose members are stored, not compressed: ``archive/data.warc.gz`` holds
WARC records, each a gzip member of its own, and ``indexes/index.cdxj`` one line for each record
with its place. So a reader finds a record from the end of the file: end record, central directory
(with ZIP64 fields where sizes need them), index, record. Nothing is extracted.
"""

import gzip
import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricemill.llm.common import pick, shuffle_partitions, stored
from pricemill.session import shared_folder

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Payloads from this size on are written once.
LEAST_REVISITED = 1000
#: Bytes of records after which a task begins a new package, and that are read at once.
PACKAGE_BYTES = 128 << 20
READ_BYTES = 8 << 20
LIMIT_16, LIMIT_32 = 0xFFFF, 0xFFFFFFFF


# --- files --------------------------------------------------------------------------------


def _open(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path)


def read_range(file, offset: int, length: int) -> bytes:
    file.seek(offset)
    found = file.read(length)
    if len(found) != length:
        raise ValueError(f"{length} bytes at {offset} are beyond the end of the file")
    return found


# --- ZIP ----------------------------------------------------------------------------------


class ZipWriter:
    """Stored members one after the other, with ZIP64 fields throughout if ``zip64`` is set or
    where sizes ask for them. Sizes and checksums follow a member (bit 3), so it can be streamed."""

    def __init__(self, out, zip64: bool = False) -> None:
        self.out, self.at, self.zip64 = out, 0, zip64
        self.members: list[tuple[bytes, int, int, int]] = []

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.name, self.start = name.encode(), self.at
        head = struct.pack(
            "<IHHHHHIIIHH", 0x04034B50, 45, 0x0808, 0, 0, 0x21, 0, 0, 0, len(self.name), 0
        )
        self._write(head + self.name)
        self.crc, self.size = 0, 0

    def write(self, data: bytes) -> None:
        self.crc, self.size = zlib.crc32(data, self.crc), self.size + len(data)
        self._write(data)

    def end(self) -> None:
        wide = self.zip64 or self.size >= LIMIT_32
        sizes = struct.pack("<QQ" if wide else "<II", self.size, self.size)
        self._write(struct.pack("<II", 0x08074B50, self.crc) + sizes)
        self.members.append((self.name, self.crc, self.size, self.start))

    def close(self) -> None:
        first = self.at
        for name, crc, size, start in self.members:
            wide = self.zip64 or size >= LIMIT_32 or start >= LIMIT_32
            extra = struct.pack("<HHQQQ", 1, 24, size, size, start) if wide else b""
            narrow = (LIMIT_32, LIMIT_32, LIMIT_32) if wide else (size, size, start)
            head = struct.pack(
                "<IHHHHHHIIIHHHHHII",
                0x02014B50, 45, 45, 0x0808, 0, 0, 0x21, crc, narrow[0], narrow[1],
                len(name), len(extra), 0, 0, 0, 0, narrow[2],
            )
            self._write(head + name + extra)
        size, number = self.at - first, len(self.members)
        if self.zip64 or first >= LIMIT_32 or number >= LIMIT_16:
            end64 = self.at
            self._write(
                struct.pack(
                    "<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, number, number, size, first
                )
            )
            self._write(struct.pack("<IIQI", 0x07064B50, 0, end64, 1))
            number, size, first = LIMIT_16, LIMIT_32, LIMIT_32
        self._write(struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, number, number, size, first, 0))


def central_directory(file, total: int) -> dict[str, tuple[int, int]]:
    """The stored members of a ZIP file: name to (offset of the data, size).

    The end record is looked for from the end on, as a comment may follow it. Where it, or an
    entry, holds the largest number of a field, the ZIP64 record or extra field has the real one.
    """
    tail_at = max(0, total - 22 - LIMIT_16)
    tail = read_range(file, tail_at, total - tail_at)
    at = len(tail) - 22
    while at >= 0:
        at = tail.rfind(b"PK\x05\x06", 0, at + 4)
        if at < 0 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
        at -= 1
    if at < 0:
        raise ValueError("no end record: not a ZIP file, or cut short")
    number, size, first = struct.unpack_from("<HII", tail, at + 10)
    if LIMIT_16 == number or LIMIT_32 in (size, first):
        locator = read_range(file, tail_at + at - 20, 20)
        if locator[:4] == b"PK\x06\x07":
            end64 = read_range(file, struct.unpack_from("<Q", locator, 8)[0], 56)
            if end64[:4] != b"PK\x06\x06":
                raise ValueError("the locator doesn't lead to a ZIP64 record")
            number, size, first = struct.unpack_from("<QQQ", end64, 32)
    entries = read_range(file, first, size)
    members, at = {}, 0
    for _ in range(number):
        if entries[at : at + 4] != b"PK\x01\x02":
            raise ValueError("the central directory is damaged")
        method = struct.unpack_from("<H", entries, at + 10)[0]
        packed, plain, name_size, extra_size, comment_size = struct.unpack_from(
            "<IIHHH", entries, at + 20
        )
        start = struct.unpack_from("<I", entries, at + 42)[0]
        name = entries[at + 46 : at + 46 + name_size].decode()
        extra = entries[at + 46 + name_size : at + 46 + name_size + extra_size]
        while len(extra) >= 4:
            kind, length = struct.unpack_from("<HH", extra)
            if kind == 1:  # only the fields that are full are here, in this order
                wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, 4))
                plain = next(wide) if plain == LIMIT_32 else plain
                packed = next(wide) if packed == LIMIT_32 else packed
                start = next(wide) if start == LIMIT_32 else start
            extra = extra[4 + length :]
        if method == 0:
            local = read_range(file, start, 30)
            if local[:4] != b"PK\x03\x04":
                raise ValueError(f"no member at the place of {name}")
            skipped = sum(struct.unpack_from("<HH", local, 26))
            members[name] = start + 30 + skipped, plain
        at += 46 + name_size + extra_size + comment_size
    return members


# --- WARC ---------------------------------------------------------------------------------


def record(row: dict) -> bytes:
    """A WARC record of a page, or of its revisit, without its payload then."""
    revisit = row["refers_to"] is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += f"Content-Length: {row['payload_bytes']}\r\n\r\n".encode()
    body = http if revisit else http + row["payload"]
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{row['page_id']}>"),
        *([("WARC-Target-URI", row["url"])] if row["url"] is not None else []),
        ("WARC-Date", "2024-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"),
        ("WARC-Payload-Length", str(row["payload_bytes"])),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:page:{row['refers_to']}>"),
        ]
    fields += [
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(body))),
    ]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """The fields of a WARC record and its payload (empty for a revisit)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines if ": " in line)
    length = int(fields["Content-Length"])
    if len(rest) < length:
        raise ValueError("the record is cut short")
    return fields, rest[:length].partition(b"\r\n\r\n")[2]


# --- jobs ---------------------------------------------------------------------------------


def with_revisits(pages: DataFrame, least: int = LEAST_REVISITED) -> DataFrame:
    """Pages with ``id``, ``url`` and ``html`` as (page_id, url, payload, payload_bytes,
    payload_digest, refers_to).

    Of equal payloads of ``least`` bytes and more the one with the largest id is the response;
    ``refers_to`` names it in the others. Payloads are compared by SHA-1 and size. Only ids and
    digests are shuffled to find copies; the largest id of a digest is an aggregate, combined in
    the map tasks, and a hot digest's join is split by AQE, as both its sides are tables.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    pages = pages.select("id", "url", payload.alias("payload"))
    digests = pages.select(
        "id", F.octet_length("payload").cast("bigint").alias("size"), F.sha1("payload").alias("sha")
    )
    large = stored(digests.filter(F.col("size") >= least), "payload-digests")
    heads = large.groupBy("sha", "size").agg(F.max("id").alias("head"), F.count("*").alias("n"))
    heads = stored(heads.filter("n > 1 AND head IS NOT NULL").drop("n"), "payload-heads")
    copies = large.join(heads, ["sha", "size"]).filter("id <> head")
    copies = stored(copies.select("id", "sha", "head").distinct(), "payload-copies")
    return (
        pages.withColumn("sha", F.sha1("payload"))
        .join(copies, ["id", "sha"], "left")
        .select(
            F.col("id").alias("page_id"),
            "url",
            "payload",
            F.octet_length("payload").cast("bigint").alias("payload_bytes"),
            F.col("sha").alias("payload_digest"),
            F.col("head").alias("refers_to"),
        )
    )


def write_packages(
    rows: DataFrame, folder: str, zip64: bool = False, package_bytes: int = PACKAGE_BYTES
) -> DataFrame:
    """Write rows of ``with_revisits`` as packages; (path, size, records) of each.

    A task writes its rows to files with names of their own, under a name that no other attempt of
    it has, so a task that is repeated leaves its earlier files unused and unharmed.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        package = None
        for batch in batches:
            for row in batch.to_dict("records"):
                if package is None:
                    package = Package(folder, zip64)
                package.add(row)
                if package.size >= package_bytes:
                    yield package.close()
                    package = None
        if package is not None:
            yield package.close()

    texts = {name: F.col(name).cast("string") for name in ("page_id", "refers_to")}
    return rows.withColumns(texts).mapInPandas(run, "path string, size bigint, records bigint")


class Package:
    """One ZIP file under construction."""

    def __init__(self, folder: str, zip64: bool) -> None:
        self.path = os.path.join(folder, f"{uuid.uuid4().hex}.wacz")
        system, path = _open(self.path)
        system.create_dir(os.path.dirname(path), recursive=True)
        self.out = system.open_output_stream(path)
        self.zip = ZipWriter(self.out, zip64)
        self.zip.begin(DATA)
        self.size, self.index = 0, []

    def add(self, row: dict) -> None:
        data = gzip.compress(record(row), 1, mtime=0)
        entry = {"offset": self.size, "length": len(data), "page": row["page_id"]}
        self.index.append(json.dumps(entry))
        self.zip.write(data)
        self.size += len(data)

    def close(self) -> pd.DataFrame:
        self.zip.end()
        self.zip.begin(INDEX)
        self.zip.write("".join(f"{line}\n" for line in self.index).encode())
        self.zip.end()
        self.zip.close()
        self.out.close()
        return pd.DataFrame(
            {"path": [self.path], "size": [self.zip.at], "records": [len(self.index)]}
        )


def _numbers(values: list[int | None]) -> pd.Series:
    return pd.Series(values, dtype="Int64")


def read_packages(packages: DataFrame, read_bytes: int = READ_BYTES) -> DataFrame:
    """The records of packages (``path``): page_id, url, record_type, refers_to, payload,
    payload_bytes and payload_digest, as the records' fields have them; a revisit's payload is NULL.

    First each package's directories and index are read, and its records listed by runs of about
    ``read_bytes``; then the runs are dealt out and read by range, so that large packages are read
    by many tasks. A response whose payload doesn't have its digest raises an error.
    """

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                system, inner = _open(path)
                runs = []
                with system.open_input_file(inner) as file:
                    members = central_directory(file, file.size())
                    base, _ = members[DATA]
                    at, lengths, size = None, [], 0
                    for line in read_range(file, *members[INDEX]).splitlines():
                        entry = json.loads(line)
                        if at is None:
                            at = base + entry["offset"]
                        lengths.append(entry["length"])
                        size += entry["length"]
                        if size >= read_bytes:
                            runs.append((path, at, lengths))
                            at, lengths, size = None, [], 0
                    if lengths:
                        runs.append((path, at, lengths))
                yield pd.DataFrame(runs, columns=["path", "at", "lengths"])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, at, lengths in zip(
                batch["path"], batch["at"], batch["lengths"], strict=True
            ):
                system, inner = _open(path)
                with system.open_input_file(inner) as file:
                    data = memoryview(read_range(file, int(at), int(sum(lengths))))
                found, place = [], 0
                for length in lengths:
                    whole = gzip.decompress(data[place : place + int(length)])
                    found.append(_page(*parse(whole)))
                    place += int(length)
                out = pd.DataFrame(found, columns=RECORD)
                for name in ("page_id", "refers_to"):
                    out[name] = _numbers([row[RECORD.index(name)] for row in found])
                yield out

    runs = packages.select("path").mapInPandas(
        listed, "path string, at bigint, lengths array<bigint>"
    )
    runs = stored(runs, "record-runs").repartition(shuffle_partitions(packages.sparkSession))
    return runs.mapInPandas(
        read,
        "page_id bigint, url string, record_type string, refers_to bigint, payload binary, "
        "payload_bytes bigint, payload_digest string",
    )


RECORD = [
    "page_id", "url", "record_type", "refers_to", "payload", "payload_bytes", "payload_digest",
]


def _page(fields: dict[str, str], payload: bytes) -> tuple:
    from hashlib import sha1

    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and sha1(payload).hexdigest() != digest:
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} doesn't have its digest")
    number = lambda name: _page_number(fields.get(name))
    return (
        number("WARC-Record-ID"),
        fields.get("WARC-Target-URI"),
        kind,
        number("WARC-Refers-To"),
        payload if kind == "response" else None,
        int(fields["WARC-Payload-Length"]),
        digest,
    )


def _page_number(identity: str | None) -> int | None:
    number = (identity or "").removeprefix("<urn:page:").removesuffix(">")
    return None if number in ("", "None") else int(number)


def archived(
    df: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    least: int = LEAST_REVISITED,
    folder: str | None = None,
    zip64: bool = False,
) -> DataFrame:
    """Write a record for each row to packages in the shared folder, and read them all back.

    Returns what ``read_packages`` does, a row for each row of the input. NULL payloads are empty;
    line breaks in urls become spaces; a NULL id makes a record without a number, which nothing
    refers to. Rows that repeat an id are records of their own; if they have the payload of
    the largest id and that id, they are responses too. An empty table gives an empty one.
    """
    spark = df.sparkSession
    rows = pick(df, id=id_column, url=url_column, html=payload_column)
    rows = rows.withColumn("url", F.regexp_replace("url", r"[\r\n]+", " "))
    folder = folder or os.path.join(shared_folder(spark), "pricemill", f"warc-{uuid.uuid4().hex}")
    packages = stored(write_packages(with_revisits(rows, least), folder, zip64), "packages")
    return read_packages(packages)
