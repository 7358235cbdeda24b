"""ZIP directories against the standard library, and archives written and read back."""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import zipfile
import zlib

import pytest
from pyspark.errors import PythonException

from tidemark.llm import web_archives, zip_archives
from tidemark.session import scratch

SCHEMA = "page_id long, url string, html string, record_type string, payload string, _key int"
BIG, OTHER = "<p>é" + "x" * 120, "<p>" + "y" * 40_000
ROWS = [(5, "http://a.example/1", BIG), (3, "http://a.example/2", BIG), (9, None, BIG), (4, "http://b.example/", "small"), (2, "u", "small")]
ROWS += [(7, "http://b.example/\r\nWARC-Type: revisit", None), (8, "http://[bad", ""), (1, "é\x85ü", OTHER), (None, "n", OTHER), (None, "n", OTHER)]
ROWS += [(6, "x", "z" * 99), (10, "x", "z" * 99), (11, "x", "z" * 100), (12, "x", "z" * 100), (13, " \u2028", "WARC/1.1\r\n\r\n" * 30), (13, "same", BIG), (13, "same", BIG)]
ROWS = [(*r, "x", "y", 1) for r in ROWS]


def brute(rows):
    """The result's rows by definition; of equal page ids one is the response."""
    out, first = [], {}
    for page, _, html, *_ in rows:
        data = (html or "").encode()
        if len(data) >= 100:
            first.setdefault(data, []).append((page is None, page or 0))
    for page, _, html, *_ in rows:
        data = (html or "").encode()
        base = (str(page), len(data), hashlib.sha256(data).hexdigest())
        if len(data) >= 100 and (page is None, page or 0) == min(first[data]) and data not in out:
            out.append(data)
            yield (*base, "response", "None")
        elif len(data) >= 100:
            last, least = min(first[data])
            yield (*base, "revisit", str(None if last else least))
        else:
            yield (*base, "response", "None")


def rows_of(df):
    return sorted((str(r[0]), r[1], r[2], r[3], str(r[4])) for r in df.collect())


def test_pages_equal_brute_force(spark):
    for rows in (ROWS, ROWS[:1], []):
        got = web_archives.op11_warc(spark.createDataFrame(rows, SCHEMA).repartition(3))
        assert rows_of(got) == sorted(brute(rows))


def test_archives_hold_texts_and_places(spark):
    folder = scratch(spark, "warc")
    records = web_archives.plan(spark.createDataFrame(ROWS, SCHEMA).repartition(2))
    manifest = web_archives.write(records, folder, size=400)
    assert manifest.count() > 2 and manifest.agg({"n_records": "sum"}).first()[0] == len(ROWS)
    found = web_archives.read(manifest).collect()
    planned = {r["record_id"]: r for r in records.collect()}
    assert len(found) == len({r["record_id"] for r in found}) == len(planned)
    for r in found:
        p = planned[r["record_id"]]
        assert (r["record_type"], r["page_id"], r["refers_to_id"], r["header_digest"]) == (p["record_type"], p["page_id"], p["refers_to_id"], p["payload_digest"])
        assert (r["payload"], r["payload_bytes"]) == ((p["payload"], p["payload_bytes"]) if r["record_type"] == "response" else (None, None))
        assert r["url"] == (None if p["url"] is None else web_archives.header_text(p["url"]))
    for package in manifest.collect():
        fs, path = web_archives.opened(package["package"])
        with zipfile.ZipFile(fs.open_input_file(path)) as whole:
            assert whole.testzip() is None
            texts = gzip.decompress(whole.read(web_archives.WARC))
            for line in whole.read(web_archives.INDEX).decode().rstrip("\n").split("\n"):
                entry = json.loads(line[line.index("{") :])
                member = [m for m in zip_archives.members(fs.open_input_file(path), fs.get_file_info(path).size) if m.name == web_archives.WARC][0]
                at = zip_archives.data_at(fs.open_input_file(path), member) + int(entry["offset"])
                one = web_archives.read_record(package["package"], at, int(entry["length"]))
                assert f"sha256:{one['header_digest']}" == entry["digest"] and one["record_id"].encode() in texts


def package_of(spark, edit):
    """A folder with one package of the rows, its members passed through ``edit(name, data) -> {name: (data, compressed)}``."""
    folder = scratch(spark, "warc")
    manifest = web_archives.write(web_archives.plan(spark.createDataFrame(ROWS, SCHEMA).coalesce(1)).coalesce(1), folder)
    address = manifest.first()["package"]
    fs, path = web_archives.opened(address)
    out = io.BytesIO()
    with zipfile.ZipFile(fs.open_input_file(path)) as old, zipfile.ZipFile(out, "w") as new:
        for name in old.namelist():
            for other, (data, squeezed) in edit(name, old.read(name)).items():
                new.writestr(other, data, zipfile.ZIP_DEFLATED if squeezed else zipfile.ZIP_STORED)
    with fs.open_output_stream(path) as file:
        file.write(out.getvalue())
    return manifest


def test_other_shapes_of_packages(spark):
    expected = sorted(brute(ROWS))

    def no_index(name, data):
        return {} if name.startswith("indexes") else {name: (data, False)}

    def gz_index(name, data):
        return {name + ".gz": (gzip.compress(data[:500]) + gzip.compress(data[500:]), False)} if name.startswith("indexes") else {name: (data, False)}

    def two_members(name, data):
        return {name: (data, False), "archive/more.warc.gz": (data, False)} if name.startswith("archive") else {name: (data, False)}

    for edit in (no_index, gz_index):
        got = web_archives.resolved(web_archives.read(package_of(spark, edit))).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        assert rows_of(got) == expected
    assert web_archives.read(package_of(spark, two_members)).count() == 2 * len(ROWS)  # the second member is not covered by the index


def test_bad_packages_raise(spark):
    def deflated(name, data):
        return {name: (data, name.startswith("archive"))}

    def cut(name, data):
        return {} if name.startswith("indexes") else {name: (data[:-3] if name.startswith("archive") else data, False)}

    def changed(name, data):
        return {name: (data[:200] + bytes([data[200] ^ 1]) + data[201:] if name.startswith("archive") else data, False)}

    for edit in (deflated, cut, changed):
        with pytest.raises(PythonException, match="BadArchive"):
            web_archives.read(package_of(spark, edit)).count()


def zipped(names, comment=b"", method=zipfile.ZIP_STORED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, data in names.items():
            z.writestr(name, data)
        z.comment = comment
    return out.getvalue()


FILES = {"a.txt": b"first" * 10, "ü/b.bin": bytes(range(256)) * 9, "empty": b"", "c": b"PK\x05\x06 inside"}


@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("comment", [b"", b"note", b"PK\x05\x06" + b"\0" * 40])
@pytest.mark.parametrize("before", [b"", b"#!/bin/sh\n" * 7])
def test_directory_equals_zipfile(monkeypatch, wide, comment, before):
    if wide:  # every size, offset and count goes to the ZIP64 records
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", -1)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", -1)
    data = before + zipped(FILES, comment)
    if wide:
        assert b"PK\x06\x06" in data and b"PK\x06\x07" in data
    monkeypatch.undo()
    file = io.BytesIO(data)
    found = zip_archives.members(file, len(data))
    assert [(m.name, m.size, m.crc) for m in found] == [(n, len(d), zlib.crc32(d)) for n, d in FILES.items()]
    assert {m.name: zip_archives.read_at(file, zip_archives.data_at(file, m), m.size) for m in found} == FILES


def test_directories_that_cannot_be_read():
    assert zip_archives.members(io.BytesIO(empty := zipped({})), len(empty)) == []
    whole = zipped(FILES)
    for data in (b"", b"PK", whole[:-1], whole[: len(whole) // 2], b"\0" * 100):
        with pytest.raises(zip_archives.BadArchive):
            zip_archives.members(io.BytesIO(data), len(data))
    packed = zipped({"a": b"aaaa" * 100}, method=zipfile.ZIP_DEFLATED)
    with pytest.raises(zip_archives.BadArchive, match="not stored"):
        zip_archives.data_at(io.BytesIO(packed), zip_archives.members(io.BytesIO(packed), len(packed))[0])
