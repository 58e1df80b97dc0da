from __future__ import annotations

import hashlib
import io
import zipfile

import pyarrow as pa
import pytest

from tessera.llm import warc

PAGES = "page_id long, url string, html string, payload string, digest string, row long"


def brute(rows):
    first = {}
    for i, _, h in rows:
        p = (h or "").encode()
        if len(p) >= 100 and i is not None:
            first[p] = min(i, first.get(p, i))
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), first.get(p)))
    return out


def run(spark, rows, **more):
    table = spark.createDataFrame([(i, u, h, "p", "d", 1) for i, u, h in rows], PAGES)
    manifest = warc.write_archives(table, **more)
    return manifest, warc.read_records(warc.locate_records(manifest)).collect()


def test_round_trip_with_odd_rows(spark):
    same, long = "<p>" + "x" * 200, "é\r\n\r\nWARC/1.1 " * 40_000
    rows = [(5, "http://a/", same), (3, "http://b/\r\nX: y", same), (9, None, same), (9, None, same), (1, "u", "short"), (2, "u", "short"), (4, "u", None), (6, "u", ""),
            (7, "u", long), (8, "u", long), (None, "u", same), (None, "u", "z" * 100), (10, "u", "z" * 100)]
    _, found = run(spark, rows, records_per_archive=4)
    assert sorted((r["page_id"] is None, r["page_id"] or 0, r["payload_bytes"], r["payload_digest"]) for r in found) == sorted((i is None, i or 0, n, d) for i, n, d, _ in brute(rows))
    by_digest = {}
    for r in found:
        by_digest.setdefault(r["payload_digest"], []).append(r)
    firsts = {d: f for _, n, d, f in brute(rows) if n >= 100}
    texts = {hashlib.sha256((h or "").encode()).hexdigest(): (h or "").encode() for _, _, h in rows}
    for digest, group in by_digest.items():
        responses = [r for r in group if r["record_type"] == "response"]
        assert all(bytes(r["payload"]) == texts[digest] for r in responses)
        if digest in firsts:
            assert [r["page_id"] for r in responses] == [firsts[digest]]
            assert all(r["refers_to"] == firsts[digest] and r["payload"] is None for r in group if r["record_type"] == "revisit")
        else:
            assert len(responses) == len(group)


def test_no_rows(spark):
    manifest, found = run(spark, [])
    assert manifest.count() == 0 and found == []


def test_archives_are_plain_zip_files(spark):
    manifest, found = run(spark, [(i, "u", f"{i}" * 150) for i in range(20)])
    assert sum(r["records"] for r in manifest.collect()) == len(found) == 20
    for r in manifest.collect():
        with zipfile.ZipFile(r["archive"].removeprefix("file://")) as z:
            assert {x.filename: x.compress_type for x in z.infolist()} == {warc.RECORDS: zipfile.ZIP_STORED, warc.INDEX: zipfile.ZIP_STORED}
            assert z.testzip() is None


def test_zip64_directory():
    """Every place and size of the directory only in its ZIP64 fields."""
    name, data = b"archive/data.warc.gz", b"0123456789"
    import struct
    local = warc.LOCAL + struct.pack("<HHHHHIIIHH", 45, 0, 0, 0, 0, 0, 10, 10, len(name), 4) + name + b"\0" * 4 + data
    extra = struct.pack("<HHQQQ", 1, 24, 10, 10, 0)
    central = warc.CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0, 0, 0, 0, 0, warc.IN_ZIP64, warc.IN_ZIP64, len(name), len(extra), 0, 0, 0, 0, warc.IN_ZIP64) + name + extra
    end64 = warc.END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(central), len(local))
    locator = warc.LOCATOR64 + struct.pack("<IQI", 0, len(local) + len(central), 1)
    end = warc.END + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, warc.IN_ZIP64, warc.IN_ZIP64, 5) + b"a PK!"
    f = pa.BufferReader(local + central + end64 + locator + end)
    entry, = warc.directory(f)
    assert entry == {"name": name.decode(), "method": 0, "size": 10, "at": 0}
    assert warc.read_at(f, warc.stored_member(f, entry), entry["size"]) == data


def test_deflated_members_and_damage_are_refused():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", b"a" * 100)
    f = pa.BufferReader(out.getvalue())
    with pytest.raises(ValueError, match="not stored"):
        warc.stored_member(f, warc.directory(f)[0])
    with pytest.raises(ValueError, match="no ZIP end"):
        warc.directory(pa.BufferReader(b"nothing"))
    record = warc.warc_record({"page_id": 1, "row": 0, "url": "u", "payload": b"abc", "digest": hashlib.sha256(b"abc").hexdigest(), "ref_page": None, "ref_row": None}, "2000-01-01T00:00:00Z")
    with pytest.raises(ValueError, match="damaged"):
        warc.parse_record(record.replace(b"abc", b"abd"))
