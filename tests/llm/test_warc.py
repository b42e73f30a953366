from __future__ import annotations

import base64
import hashlib
from pathlib import Path

import pytest
import zstandard

from parcelake.llm import tables, warc

PAGES = "page_id long, url string, html string, refers_to long, payload string, size long, first long"


def expected(rows, least=0):
    first = {}
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        refers = first.get(html or "")
        refers = None if len(data) < least or refers is None or refers == page else refers
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def through_archives(spark, pages, least=0):
    folder = tables.scratch_path(spark, "warc-test")
    warc.write(pages, folder, least)
    return folder, sorted((tuple(r) for r in warc.read(spark, folder).collect()), key=repr)


def test_given_pages(spark):
    pages = tables.read(spark, "/root/testdata/sf0.01", "pages")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    folder, found = through_archives(spark, pages)
    assert found == expected(rows)
    archive = next(Path(folder.removeprefix("file://")).glob("*.warc.zst")).read_bytes()
    assert archive[:4] == (0x184D2A5D).to_bytes(4, "little")


def test_special_cases(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 600)
    rows = [(5, "http://a/\r\nX: y", "same"), (3, None, "same"), (3, None, "same"), (None, "u", "same"),
            (None, None, "alone"), (None, None, "alone"), (7, "u", None), (8, "u", ""), (9, "u", "é中" * 50_000),
            (10, "u", "\r\n\r\nWARC/1.1\r\n")]
    pages = spark.createDataFrame([(*r, 1, "p", 2, 3) for r in rows], PAGES)
    for least in (0, 5):
        folder, found = through_archives(spark, pages, least)
        assert found == expected(rows, least)
    stray = Path(folder.removeprefix("file://")) / "part-lost.warc.zst"
    stray.write_bytes(b"an attempt that was lost")
    assert warc.read(spark, folder).count() == len(rows)
    assert through_archives(spark, pages.limit(0))[1] == []


def frame(data, dictionary=None):
    return zstandard.ZstdCompressor(dict_data=dictionary).compress(data)


def test_plain_dictionary_frame_and_no_dictionary():
    record = warc.record(1, "u", b"payload", None)
    samples = [b"%d sample words of a page %d" % (k, k * k) for k in range(4000)]
    dictionary = zstandard.train_dictionary(4096, samples)
    plain = (0x184D2A5D).to_bytes(4, "little") + len(dictionary.as_bytes()).to_bytes(4, "little") + dictionary.as_bytes()
    assert list(warc.frames(plain + frame(record, dictionary) * 3)) == [record] * 3
    assert list(warc.frames(frame(record) + frame(b"z" * 3_000_000))) == [record, b"z" * 3_000_000]
    assert list(warc.frames(b"")) == []


def test_broken_archives_raise():
    record = warc.record(1, "u", b"payload", None)
    whole = frame(record)
    for data in (whole[:-5], whole + b"junk", b"\x5d\x2a\x4d\x18\xff\xff\xff\x00", whole[:6] + b"\xff" * 9 + whole[15:]):
        with pytest.raises(ValueError):
            list(warc.frames(data))
    bad = [record.replace(b"WARC/1.1", b"HTTP/1.1"), record[:-1], record + b"x", record.replace(b"WARC-Date", b"Date"),
           record.replace(b"\r\nContent-Length: ", b"\r\nContent-Length: 1")]
    for data in bad:
        with pytest.raises(ValueError):
            warc.parse(data)
    for data in (record.replace(b"payload\r\n", b"paYload\r\n"), record.replace(b"Content-Length: 7", b"Content-Length: 8")):
        with pytest.raises(ValueError):
            warc.described(*warc.parse(data))
