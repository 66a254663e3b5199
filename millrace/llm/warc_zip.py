"""WARC records in ZIP packages, read in place.

A package holds ``archive/data.warc.gz`` (one gzip member per record) and ``indexes/index.cdxj``
(one line per record with its offset and length), both stored, so that a record is a byte range
of the package.  The reader parses the central directory, ZIP64 where it is needed, finds the
stored members and their index, and fetches records by range; nothing is extracted.
"""

from __future__ import annotations

import hashlib
import io
import json
import struct
import urllib.parse
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.base import open_file, put_file, utf8
from millrace.operators.joins import keyed_join, measure
from millrace.session import materialize, scratch_path

PACKAGE_BYTES = 32 << 20
RANGE_BYTES = 4 << 20
READ_TASKS = 20_000
REVISIT_BYTES = 100
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"

#: Fixed values of the formats.
END, END64_AT, END64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06", b"PK\x01\x02", b"PK\x03\x04"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PRINTABLE = "".join(map(chr, range(0x21, 0x7F)))


# records


def record(page: str, url: str | None, kind: str, payload: bytes, digest: str, refers: str | None, date: str) -> bytes:
    """A WARC/1.1 record.  A revisit keeps the HTTP header, with the payload's length, alone."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if kind == "revisit" else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + urllib.parse.quote(url, safe=_PRINTABLE))
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers}>"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(text: bytes) -> dict[str, str]:
    """Header fields after the first line, names in lower case."""
    fields = {}
    for line in text.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            fields[name.strip().lower()] = value.strip()
    return fields


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of one record."""
    if not data.startswith(b"WARC/1."):
        raise ValueError("no WARC record here")
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = headers(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, headers(http), payload


# packages


def pack(records: list[tuple[str, bytes]]) -> bytes:
    """A package of ``(page, record)``."""
    data, index, at = [], [], 0
    for page, raw in records:
        press = zlib.compressobj(1, zlib.DEFLATED, 31)
        data.append(press.compress(raw) + press.flush())
        index.append(json.dumps({"id": page, "offset": at, "length": len(data[-1])}))
        at += len(data[-1])
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as package:
        for name, content in ((ARCHIVE, b"".join(data)), (INDEX, "\n".join(index).encode())):
            package.writestr(zipfile.ZipInfo(name, (2026, 1, 1, 0, 0, 0)), content)
    return out.getvalue()


@dataclass(frozen=True)
class Member:
    name: str
    stored: bool
    offset: int  # of its bytes in the package
    size: int


def _wide(extra: bytes, values: list[int]) -> list[int]:
    """Fill in the values that a ZIP64 extra field holds in place of all ones."""
    while len(extra) >= 4:
        tag, size = struct.unpack("<HH", extra[:4])
        field, extra = extra[4 : 4 + size], extra[4 + size :]
        if tag == 1:
            for i, (value, ones) in enumerate(zip(values, (0xFFFFFFFF,) * 3, strict=True)):
                if value == ones:
                    values[i], field = struct.unpack("<Q", field[:8])[0], field[8:]
    return values


def members(file: pa.NativeFile) -> list[Member]:
    """The central directory of a package, by ranged reads from its end."""
    length = file.size()
    tail_at = max(0, length - 65_557)
    tail = file.read_at(length - tail_at, tail_at)
    end = tail.rfind(END)
    if end < 0:
        raise ValueError("no ZIP directory")
    count, size, start = struct.unpack("<HII", tail[end + 10 : end + 20])
    if 0xFFFF == count or 0xFFFFFFFF in (size, start):
        at = tail.rfind(END64_AT, 0, end)
        if at < 0:
            raise ValueError("no ZIP64 directory")
        wide_at = struct.unpack("<Q", tail[at + 8 : at + 16])[0]
        wide = file.read_at(56, wide_at)
        if not wide.startswith(END64):
            raise ValueError("no ZIP64 directory")
        count, size, start = struct.unpack("<QQQ", wide[32:56])
    entries, found = file.read_at(size, start), []
    for _ in range(count):
        if not entries.startswith(ENTRY):
            raise ValueError("broken ZIP directory")
        flags, method = struct.unpack("<HH", entries[8:12])
        packed, plain = struct.unpack("<II", entries[20:28])
        n, m, k = struct.unpack("<HHH", entries[28:34])
        local = struct.unpack("<I", entries[42:46])[0]
        name = entries[46 : 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        plain, packed, local = _wide(entries[46 + n : 46 + n + m], [plain, packed, local])
        head = file.read_at(30, local)
        if not head.startswith(LOCAL):
            raise ValueError(f"no member {name} at its place")
        a, b = struct.unpack("<HH", head[26:30])
        found.append(Member(name, method == 0 and not flags & 1, local + 30 + a + b, packed))
        entries = entries[46 + n + m + k :]
    return found


def scan_records(file: pa.NativeFile, archive: Member) -> Iterator[tuple[int, int]]:
    """Record ranges of an archive without an index, gzip member by gzip member or plain."""
    at, end = archive.offset, archive.offset + archive.size
    while at < end:
        if file.read_at(2, at) == b"\x1f\x8b":
            press, size = zlib.decompressobj(31), 0
            while not press.eof:
                part = file.read_at(min(1 << 16, end - at - size), at + size)
                if not part:
                    raise ValueError("cut gzip member")
                while part and not press.eof:  # the output is only measured, in bounded steps
                    press.decompress(part, 1 << 20)
                    used = press.unconsumed_tail
                    size += len(part) - len(used) - len(press.unused_data)
                    part = used
        else:
            head, step = b"", 1 << 12
            while b"\r\n\r\n" not in head:
                more = file.read_at(min(step, end - at - len(head)), at + len(head))
                if not more:
                    raise ValueError("cut WARC record")
                head += more
            size = head.index(b"\r\n\r\n") + 8 + int(headers(head.partition(b"\r\n\r\n")[0])["content-length"])
        yield at, size
        at += size


def record_ranges(file: pa.NativeFile) -> Iterator[tuple[int, int]]:
    """Offset and length, in the package, of every record of its stored archives.

    An index applies to the archive if there is one of each; other archives are scanned.
    """
    found = members(file)
    archives = [m for m in found if m.name.startswith("archive/") and m.name.endswith((".warc", ".warc.gz"))]
    indexes = [m for m in found if m.name.startswith("indexes/") and m.name.endswith(".cdxj")]
    for archive in archives:
        if not archive.stored:
            raise ValueError(f"{archive.name} is not stored, so it has no ranges")
        if len(archives) == len(indexes) == 1 and indexes[0].stored:
            for line in file.read_at(indexes[0].size, indexes[0].offset).splitlines():
                entry = json.loads(line[line.index(b"{") :])
                yield archive.offset + int(entry["offset"]), int(entry["length"])
        else:
            yield from scan_records(file, archive)


# jobs


def as_records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    least: int = REVISIT_BYTES,
) -> DataFrame:
    """``id, url, html, digest, kind, refers``: which pages are responses, which revisits.

    Of equal payloads of at least ``least`` bytes the smallest id is the response.  Digests are
    counted within tasks first; only those of several pages are joined back, to one row each.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), html.alias("html"),
        F.sha2(html.cast("binary"), 256).alias("digest"),
    )
    firsts = materialize(
        rows.filter(F.octet_length("html") >= least)
        .groupBy("digest")
        .agg(F.min("id").alias("first"), F.count("*").alias("n"))
        .filter((F.col("n") > 1) & F.col("first").isNotNull())
        .select("digest", "first"),
        "payloads",
    )
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return keyed_join(rows, firsts, ["digest"], "left", measure(firsts), balance=False).select(
        "id", "url", "html", "digest",
        F.when(again, "revisit").otherwise("response").alias("kind"),
        F.when(again, F.col("first")).alias("refers"),
    )


def write_packages(
    records: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES, date: str = "2026-01-01T00:00:00Z"
) -> DataFrame:
    """Write ``as_records`` rows to packages in ``folder``; returns ``path, n_records, bytes``.

    A task closes a package at about ``package_bytes`` of records.  Packages appear whole under
    names fixed by task and order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close() -> pa.RecordBatch:
            path = f"{folder}/pages-{part:07d}-{seq:05d}.wacz"
            row = [[path], [len(held)], [put_file(path, pack(held))]]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in row], ["path", "n_records", "bytes"])

        for batch in batches:
            ids, urls, digests, kinds, refers = (
                batch.column(i).to_pylist() for i in (0, 1, 3, 4, 5)
            )
            for i, html in enumerate(utf8(batch.column(2))):
                raw = record(ids[i], urls[i], kinds[i], html or b"", digests[i], refers[i], date)
                held.append((ids[i], raw))
                size += len(raw)
                if size >= package_bytes:
                    yield close()
                    seq, held, size = seq + 1, [], 0
        if held:
            yield close()

    rows = records.select(
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), "url", "html", "digest", "kind",
        F.col("refers").cast("string").alias("refers"),
    )
    return materialize(rows.mapInArrow(run, "path string, n_records bigint, bytes bigint"), "packages")


def locate_records(packages: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``path, offset, lengths``: runs of neighbouring records of about ``range_bytes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                starts, runs, lengths, end = [], [], [], None
                for offset, length in sorted(record_ranges(open_file(path))):
                    if offset != end or sum(lengths) >= range_bytes:
                        starts.append(offset)
                        runs.append(lengths := [])
                    lengths.append(length)
                    end = offset + length
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path] * len(starts), pa.string()), pa.array(starts, pa.int64()),
                        pa.array(runs, pa.list_(pa.int64())),
                    ],
                    ["path", "offset", "lengths"],
                )

    tasks = max(1, min(packages.count(), READ_TASKS))
    return packages.select("path").repartition(tasks).mapInArrow(
        run, "path string, offset bigint, lengths array<bigint>"
    )


def read_packages(packages: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``id, url, record_type, refers_to, payload_bytes, payload_digest`` of every record.

    ``packages`` has a ``path`` per row.  Record ranges are found first and dealt out evenly;
    then each range is fetched by itself.  The digest of a response is taken of the bytes read
    and must be the one in its header; a revisit states those of the payload it revisits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"]
        for batch in batches:
            rows = []
            for path, offset, lengths in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data, at = open_file(path).read_at(sum(lengths), offset), 0
                for length in lengths:
                    raw, at = data[at : at + length], at + length
                    warc, http, payload = parse_record(zlib.decompress(raw, 31) if raw[:2] == b"\x1f\x8b" else raw)
                    stated = warc["warc-payload-digest"].removeprefix("sha256:")
                    revisit = warc["warc-type"] == "revisit"
                    digest = stated if revisit else hashlib.sha256(payload).hexdigest()
                    if digest != stated:
                        raise ValueError(f"{path}: payload of {warc['warc-record-id']} does not match its digest")
                    name, refers = (
                        warc[k].removeprefix("<urn:page:").removesuffix(">") or None if k in warc else None
                        for k in ("warc-record-id", "warc-refers-to")
                    )
                    size = int(http["content-length"]) if revisit else len(payload)
                    rows.append((name, warc.get("warc-target-uri"), warc["warc-type"], refers, size, digest))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.string()] * 4 + [pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    ranges = materialize(locate_records(packages, range_bytes), "ranges")
    tasks = max(1, min(ranges.count(), READ_TASKS))
    return ranges.repartition(tasks).mapInArrow(
        run,
        "id string, url string, record_type string, refers_to string, payload_bytes bigint, payload_digest string",
    )


def archive_pages(
    pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
    html_col: str = "html", package_bytes: int = PACKAGE_BYTES,
) -> DataFrame:
    """Write a record per page, read the packages back: ``page_id, payload_bytes,
    payload_digest, record_type, refers_to``.

    Null html is an empty payload; a null url is left out of the record; characters that a URL
    may not hold are percent-encoded there.  Rows that share the smallest id of a payload are
    all responses; with that payload, a row without an id is a revisit, and if no row has an id,
    all are responses.  An empty table writes nothing.  Other columns are ignored.
    """
    folder = folder or scratch_path(pages.sparkSession, "packages")
    packages = write_packages(as_records(pages, id_col, url_col, html_col), folder, package_bytes)
    kind = pages.schema[id_col].dataType.simpleString()
    return read_packages(packages).select(
        F.col("id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
