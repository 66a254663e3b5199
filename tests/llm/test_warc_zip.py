from __future__ import annotations

import hashlib
import io
import zipfile

import pyarrow as pa
import pytest

from millrace.llm import queries, warc_zip
from millrace.session import scratch_path
from tests.llm.helpers import SMALL, empty, needs_tables, rows

COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def brute(pages):
    payloads = [(i, (h or "").encode()) for i, h in pages]
    out = []
    for i, data in payloads:
        first = min((j for j, other in payloads if other == data and j is not None), default=None)
        again = len(data) >= 100 and first is not None and first != i
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def pages_frame(spark, rows_):
    return spark.createDataFrame(rows_, "page_id bigint, url string, html string").selectExpr(
        "*", "1 AS id", "'k' AS kind", "'d' AS digest"
    )


def test_odd_pages(spark):
    long, edge, short = "é" * 200_000, "x" * 100, "x" * 99
    given = [
        (5, "http://a/\r\nb ü", long), (3, "http://a/", long), (9, None, long), (1, "u", edge), (2, "u", edge),
        (4, "u", short), (6, "u", short), (7, "u", None), (8, "u", ""), (1, "u", edge), (None, "u", edge),
        (None, "u", "y" * 150), (10, "u", "a\r\n\r\nWARC/1.1\r\n\r\nb\x00" * 20),
    ]
    pages = pages_frame(spark, given)
    expected = brute([(i, h) for i, _, h in given])
    for size in (1, 1 << 20):
        assert rows(warc_zip.archive_pages(pages, package_bytes=size), *COLUMNS) == expected
    assert warc_zip.archive_pages(empty(pages)).count() == 0


def package(tmp_path, **members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, (content, method) in members.items():
            z.writestr(name, content, method)
    path = tmp_path / "x.zip"
    path.write_bytes(out.getvalue())
    return str(path)


def test_archives_without_an_index_are_scanned(spark, tmp_path):
    parts = [warc_zip.record(str(i), "u", "response", b"p" * i, hashlib.sha256(b"p" * i).hexdigest(), None, "d") for i in (3, 70_000)]
    packed = warc_zip.pack([(str(i), p) for i, p in enumerate(parts)])
    with zipfile.ZipFile(io.BytesIO(packed)) as z:
        zipped = z.read(warc_zip.ARCHIVE)
    path = package(tmp_path, **{
        "archive/a.warc": (b"".join(parts), 0), "archive/b.warc.gz": (zipped, 0), "other.txt": (b"t", 8),
    })
    got = warc_zip.read_packages(spark.createDataFrame([(path,)], "path string"))
    assert sorted(r.payload_bytes for r in got.collect()) == [3, 3, 70_000, 70_000]


def test_zip64_directory(tmp_path, monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    path = tmp_path / "z.zip"
    with zipfile.ZipFile(path, "w") as z:
        for i in range(4):
            z.writestr(f"archive/{i}.warc", f"content {i} of a member")
        z.comment = b"a comment"
    assert b"PK\x06\x06" in path.read_bytes()
    file = warc_zip.open_file(str(path))
    found = warc_zip.members(file)
    assert [file.read_at(m.size, m.offset) for m in found] == [f"content {i} of a member".encode() for i in range(4)]


def test_wide_fields():
    extra = b"\x0a\x00\x02\x00zz" + b"\x01\x00\x10\x00" + (5 << 33).to_bytes(8, "little") + (7).to_bytes(8, "little")
    assert warc_zip._wide(extra, [0xFFFFFFFF, 12, 0xFFFFFFFF]) == [5 << 33, 12, 7]


def test_broken_packages(tmp_path):
    with pytest.raises(ValueError, match="no ZIP"):
        warc_zip.members(pa.BufferReader(b"nothing"))
    path = package(tmp_path, **{"archive/a.warc": (b"WARC" * 100, 8)})
    with pytest.raises(ValueError, match="not stored"):
        list(warc_zip.record_ranges(warc_zip.open_file(path)))


def test_wrong_payload_is_noticed(spark, tmp_path):
    raw = warc_zip.record("1", "u", "response", b"abc", "0" * 64, None, "d")
    path = package(tmp_path, **{"archive/a.warc": (raw, 0)})
    with pytest.raises(Exception, match="does not match"):
        warc_zip.read_packages(spark.createDataFrame([(path,)], "path string")).collect()


def test_packages_are_ordinary_zip_files(spark, tmp_path):
    pages = pages_frame(spark, [(i, "u", "z" * 300) for i in range(4)])
    packages = warc_zip.write_packages(warc_zip.as_records(pages), scratch_path(spark, "zip"))
    for r in packages.collect():
        with zipfile.ZipFile(r.path.removeprefix("file:")) as z:
            assert z.testzip() is None and len(z.infolist()) == 2


@needs_tables
def test_whole_table(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    assert rows(queries.QUERIES["op5_warc_zip"](spark, SMALL), *COLUMNS) == brute(pages)
