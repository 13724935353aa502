"""Archives: read back against hashlib, and as files against a reader of the format."""

from __future__ import annotations

import base64
import gzip
import hashlib
from pathlib import Path

from cadastra.llm import warc

PAGES = [
    (1, "http://a/", "<p>x</p>"), (2, "http://b/", "<p>x</p>"), (3, None, None), (4, "http://c/\r\nX: y", ""), (0, "http://d/", "<p>x</p>"),
    (5, "u", "é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nHTTP/1.1 200\r\n\r\n"), (None, "n", "<p>x</p>"), (None, "n", "only null"),
    (7, "v", "line\n" * 4000), (8, "v", "line\n" * 4000), (8, "v", "line\n" * 4000), (9, "w", "\r\n\r\n"), (9, "w", "other"), *[(11, "t", "same")] * 3, (12, "t", "same"), (11, "other address", "same"), (10, "z", "\x00﻿\U0001f600"),
]
SCHEMA = "page_id long, url string, html string"


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def expected(rows, min_bytes=0):
    out, answered = [], set()
    for page, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (html or "").encode()
        ids = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = min(ids) if data in answered and ids and len(data) >= min_bytes else None
        answered.add(data)
        out.append((page, len(data), digest(data), "response" if first is None else "revisit", first))
    return sorted(out, key=str)


def test_round_trip(spark):
    df = spark.createDataFrame(PAGES, SCHEMA).selectExpr("*", "'x' AS payload", "1 AS refers_to", "2 AS record_type").repartition(3)
    for least in (0, 9, 10**9):
        got = warc.archive_round_trip(df, min_bytes=least)
        assert sorted((tuple(r) for r in got.collect()), key=str) == expected(PAGES, least)
    plain = warc.archive_round_trip(df, compression="none")
    assert sorted((tuple(r) for r in plain.collect()), key=str) == expected(PAGES)
    assert warc.archive_round_trip(df.limit(0)).collect() == []


def test_files_are_warc(spark, tmp_path):
    archive = warc.write_archive(spark.createDataFrame(PAGES, SCHEMA).coalesce(2), str(tmp_path / "w"), records_per_file=4)
    files = sorted(Path(tmp_path / "w").glob("part-*"))
    assert len(files) >= 3
    records = []
    for file in files:
        data, at = gzip.decompress(file.read_bytes()), 0
        while at < len(data):
            end = data.index(b"\r\n\r\n", at)
            lines = data[at:end].decode().split("\r\n")
            assert lines[0] == "WARC/1.1"
            header = dict(line.split(": ", 1) for line in lines[1:])
            block = data[end + 4:end + 4 + int(header["Content-Length"])]
            assert data[end + 4 + len(block):end + 8 + len(block)] == b"\r\n\r\n"
            at = end + 8 + len(block)
            records.append((header, block))
    assert len(records) == len(PAGES) == len({h["WARC-Record-ID"] for h, _ in records})
    assert len({h["WARC-Date"] for h, _ in records}) == 1 and records[0][0]["WARC-Date"] > "2020"
    by_id = {h["WARC-Record-ID"]: (h, b) for h, b in records if h["WARC-Type"] == "response"}
    for header, block in records:
        assert header["WARC-Archive-Id"] == archive
        _, original = by_id[header.get("WARC-Refers-To", header["WARC-Record-ID"])]
        payload = original.split(b"\r\n\r\n", 1)[1]
        assert header["WARC-Payload-Digest"] == "sha1:" + digest(payload)
        assert (header["WARC-Type"] == "revisit") == ("WARC-Profile" in header) == block.endswith(b"\r\n\r\n" if header["WARC-Type"] == "revisit" else b"\xff")


def test_one_response_for_many_equal_rows(spark):
    """A third of all rows are one row: one response, all others revisit it, also over several parts of copies."""
    rows = [(4, "http://a/", "hot")] * 2500 + [(i, f"http://{i}/", f"page {i % 1500}") for i in range(5, 3005)]
    got = warc.archive_round_trip(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert sorted((tuple(r) for r in got.collect()), key=str) == quick_expected(rows)


def quick_expected(rows):
    """As :func:`expected` for rows without nulls and lengths, with one pass."""
    first, out = {}, []
    for page, _, html in sorted(rows):
        known = html in first
        first.setdefault(html, page)
        out.append((page, len(html), digest(html.encode()), "revisit" if known else "response", first[html] if known else None))
    return sorted(out, key=str)
