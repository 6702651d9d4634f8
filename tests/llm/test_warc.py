import gzip
import hashlib
import io
import os

import pytest

from farelake.llm import warc

from .conftest import PAGES


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "x", "x", 7, 7) for i, u, h in rows], PAGES)


def expected(rows):
    out, top = [], {}
    for i, _, h in rows:
        h = (h or "").encode()
        if len(h) >= 1000 and i is not None:
            top[h] = max(i, top.get(h, i))
    for i, _, h in rows:
        h = (h or "").encode()
        t = top.get(h)
        rev = t is not None and t != i
        out.append((i, len(h), hashlib.sha1(h).hexdigest(), "revisit" if rev else "response", t if rev else None, True))
    return sorted(out, key=str)


def read(spark, rows, **kw):
    recs = warc.read_warc(spark, warc.write_warc(spark, pages(spark, rows), **kw)).collect()
    return recs, sorted(((None if r.row_id is None else int(r.row_id), r.payload_bytes, r.payload_digest, r.record_type,
                          None if r.refers_to is None else int(r.refers_to), r.verified) for r in recs), key=str)


def test_round_trip_with_copies_and_odd_rows(spark):
    hot = "<p>same é</p>" * 200
    rows = [(i, f"http://a/{i}", hot) for i in range(60)]
    rows += [(100, None, None), (101, "", ""), (102, "http://x/\r\nEvil: 1", "a\r\n\r\nWARC/1.1\r\n"), (None, "u", hot),
             (103, "u", "s" * 999), (104, "u", "s" * 999), (105, "u", "t" * 1000), (106, "u", "t" * 1000),
             (106, "u", "t" * 1000), (None, None, "n" * 2000), (None, None, "n" * 2000), (107, "u", "é" * 3_000_000)]
    recs, got = read(spark, rows)
    assert got == expected(rows)
    assert "Evil" not in {r.uri for r in recs} and all("\n" not in (r.uri or "") for r in recs)


def test_archives_are_bounded_and_plain_gzip_members(spark):
    rows = [(i, f"http://a/{i}", hashlib.sha256(str(i).encode()).hexdigest() * 40) for i in range(50)]
    manifest = warc.write_warc(spark, pages(spark, rows).coalesce(1), archive_bytes=4000).collect()
    assert len(manifest) > 3 and sum(m.records for m in manifest) == 50
    raw = open(manifest[0].path.removeprefix("file:"), "rb").read()
    assert len(raw) == manifest[0].bytes == os.path.getsize(manifest[0].path.removeprefix("file:"))
    assert gzip.decompress(raw).count(b"WARC/1.1\r\n") == manifest[0].records


def test_empty_table(spark):
    assert read(spark, [])[1] == []


def member(body=b"hello" * 500, **kw):
    return gzip.compress(warc.make_record(1, "u", body, hashlib.sha1(body).hexdigest(), None))


def test_reader_checks_digests_and_framing(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 11)
    ok = list(warc.read_records(io.BytesIO(member() + member(b"")), "a"))
    assert [r["verified"] for r in ok] == [True, True] and ok[1]["member_offset"] == len(member())
    raw = gzip.decompress(member())
    bad = gzip.compress(raw.replace(b"hellohello", b"hellohellO", 1))
    assert [r["verified"] for r in warc.read_records(io.BytesIO(bad), "a")] == [False]
    for broken in (member()[:-9], gzip.compress(raw[:-4]), gzip.compress(raw + b"x"), gzip.compress(b"no record\r\n\r\n")):
        with pytest.raises(ValueError):
            list(warc.read_records(io.BytesIO(broken), "a"))
