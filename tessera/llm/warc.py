"""WARC records in ZIP-packaged archives: writing, and reading without extraction.

An archive is a ZIP file whose members are stored, not deflated: ``archive/data.warc.gz``
(one gzip member a record) and ``indexes/index.cdxj`` (a line a record, with its place in
the first member). ``write_archives`` makes one archive or more per task in the shared
folder and gives a written manifest; a task that is tried again writes files of its own,
and only those named in the manifest count. ``locate_records`` reads the end of an archive,
its central directory (ZIP64 where sizes or places need it) and its index, and
``read_records`` range-reads single records from the outer file.

Of rows with equal payloads of ``least`` bytes or more, the one with the smallest
``page_id`` (then the first row) is a response; others are revisits that refer to it.

Defined results: a null html is an empty payload, a null url is left out; a null
``page_id`` is larger than any other; repeated rows are records of their own; no rows
give no archive and no records; other columns are ignored, whatever their names.

Tasks open the shared folder through ``pyarrow.fs``, so its store must be one that Arrow
knows (local or mounted paths, HDFS, S3, GCS).
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fresh_dir, materialize, numbered, prepare_workers, read_binary_rows

RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Fixed values of the ZIP format: signatures of its structures.
END, END64, LOCATOR64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
IN_ZIP64 = 0xFFFFFFFF
#: Revisits (three numbers each) that may be broadcast.
BROADCAST_ROWS = 500_000


def file_system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    scheme = path.partition(":")[0]
    if scheme in ("s3a", "s3n"):
        path = "s3" + path[len(scheme):]
    elif scheme == "file":
        path = "/" + path[len("file:"):].lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path)


# ---------------------------------------------------------------- records


def record_id(page_id: int | None, row: int) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{row}>"


def page_of(record: str) -> int | None:
    page = record.strip("<>").split(":")[2]
    return int(page) if page else None


def warc_record(row: dict, date: str) -> bytes:
    """One WARC/1.1 record; a revisit has the payload's length and digest, not its bytes."""
    revisit = row["ref_row"] is not None
    payload = row["payload"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(row['page_id'], row['row'])}",
            f"WARC-Date: {date}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{row['digest']}"]
    if row["url"] is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in row["url"]))
    if revisit:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(row['ref_page'], row['ref_row'])}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Fields and payload of one record; a response whose bytes differ from its digest raises."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/1."):
        raise ValueError(f"no WARC record: {version[:40]!r}")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    revisit = fields["warc-type"] == "revisit"
    if not revisit and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged payload in {fields['warc-record-id']}")
    return {"page_id": page_of(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "payload": None if revisit else payload,
            "payload_bytes": size, "payload_digest": digest, "record_type": fields["warc-type"],
            "refers_to": page_of(fields["warc-refers-to"]) if revisit else None}


# ---------------------------------------------------------------- ZIP, reading


def read_at(f: pa.NativeFile, at: int, n: int) -> bytes:
    f.seek(at)
    return f.read(n)


def directory(f: pa.NativeFile) -> list[dict]:
    """Entries of the central directory: name, method, size, at (of the local header)."""
    size = f.size()
    tail_at = max(0, size - 65557)  # the end record and the longest comment
    tail = read_at(f, tail_at, size - tail_at)
    k = tail.rfind(END)
    if k < 0:
        raise ValueError("no ZIP end record")
    n, length, start = struct.unpack("<HII", tail[k + 10:k + 20])
    if (n == 0xFFFF or IN_ZIP64 in (length, start)) and tail_at + k >= 20:
        locator = read_at(f, tail_at + k - 20, 20)
        if locator[:4] == LOCATOR64:
            end64 = read_at(f, struct.unpack("<Q", locator[8:16])[0], 56)
            if end64[:4] != END64:
                raise ValueError("no ZIP64 end record")
            n, length, start = struct.unpack("<QQQ", end64[32:56])
    data, entries, p = read_at(f, start, length), [], 0
    for _ in range(n):
        if data[p:p + 4] != CENTRAL:
            raise ValueError("damaged central directory")
        method, = struct.unpack("<H", data[p + 10:p + 12])
        packed, unpacked, names, extras, comments = struct.unpack("<IIHHH", data[p + 20:p + 34])
        at, = struct.unpack("<I", data[p + 42:p + 46])
        name, extra = data[p + 46:p + 46 + names], data[p + 46 + names:p + 46 + names + extras]
        while len(extra) >= 4:
            kind, m = struct.unpack("<HH", extra[:4])
            if kind == 1:  # ZIP64: only those values that the entry itself leaves open, in this order
                wide = list(struct.unpack(f"<{m // 8}Q", extra[4:4 + m // 8 * 8]))
                unpacked = wide.pop(0) if unpacked == IN_ZIP64 else unpacked
                packed = wide.pop(0) if packed == IN_ZIP64 else packed
                at = wide.pop(0) if at == IN_ZIP64 else at
            extra = extra[4 + m:]
        entries.append({"name": name.decode(), "method": method, "size": packed, "at": at})
        p += 46 + names + extras + comments
    return entries


def stored_member(f: pa.NativeFile, entry: dict) -> int:
    """Where the bytes of a stored member begin in the archive."""
    if entry["method"] != 0:
        raise ValueError(f"{entry['name']} is not stored")
    local = read_at(f, entry["at"], 30)
    if local[:4] != LOCAL:
        raise ValueError(f"no local header for {entry['name']}")
    names, extras = struct.unpack("<HH", local[26:30])
    return entry["at"] + 30 + names + extras


# ---------------------------------------------------------------- operators


def with_references(pages: DataFrame, id_col: str, url_col: str, html_col: str, least: int) -> DataFrame:
    """row, page_id, url, payload, digest, and page and row of the response for revisits."""
    rows, row = numbered(pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                                      F.coalesce(F.col(f"`{html_col}`").cast("string").cast("binary"), F.lit(b"")).alias("payload"))
                         .withColumn("digest", F.sha2("payload", 256)).withColumn("n", F.octet_length("payload")))
    rows = rows.withColumnRenamed(row, "row")
    long_ones = rows.where(F.col("n") >= least).select("row", "page_id", "digest")
    n = rows.count()
    firsts = materialize(long_ones.groupBy("digest").agg(F.count("*").alias("rows"), F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "row")).alias("first"))
                         .where("rows > 1").select("digest", F.col("first.page_id").alias("ref_page"), F.col("first.row").alias("ref_row")), "firsts", n)
    revisits = materialize(long_ones.join(firsts, "digest").where("row != ref_row").select("row", "ref_page", "ref_row"), "revisits", n)
    if revisits.count() <= BROADCAST_ROWS:  # payloads are not shuffled; beyond that they are
        revisits = F.broadcast(revisits)
    return rows.drop("n").join(revisits, "row", "left").select("row", "page_id", "url", "payload", "digest", "ref_page", "ref_row")


def write_archives(pages: DataFrame, folder: str | None = None, least: int = 100, records_per_archive: int = 100_000,
                   date: str = "2000-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all pages; the written manifest (archive, records)."""
    spark = pages.sparkSession
    prepare_workers(spark)
    folder = folder or fresh_dir(spark, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = read_binary_rows(batches)
        fs, root = file_system(folder)
        row = next(rows, None)
        while row is not None:
            path = f"{root}/{uuid.uuid4().hex}.wacz"
            fs.create_dir(root, recursive=True)
            index, at = [], 0
            with fs.open_output_stream(path) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
                with archive.open(zipfile.ZipInfo(RECORDS), "w", force_zip64=True) as member:
                    while row is not None and len(index) < records_per_archive:
                        data = gzip.compress(warc_record(row, date), 4, mtime=0)
                        member.write(data)
                        index.append(json.dumps({"id": record_id(row["page_id"], row["row"]), "offset": at, "length": len(data)}))
                        at += len(data)
                        row = next(rows, None)
                with archive.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as member:
                    member.write("\n".join(index).encode())
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{path.rpartition('/')[2]}"]), pa.array([len(index)], pa.int64())], ["archive", "records"])

    return materialize(with_references(pages, id_col, url_col, html_col, least).mapInArrow(run, "archive string, records long"), "warc-manifest")


def locate_records(archives: DataFrame) -> DataFrame:
    """``archives`` (archive) as one row per record: archive, at, length; from directories and indexes alone."""
    prepare_workers(archives.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name in b.column(0).to_pylist():
                fs, path = file_system(name)
                with fs.open_input_file(path) as f:
                    members = {e["name"]: e for e in directory(f)}
                    base = stored_member(f, members[RECORDS])
                    index = read_at(f, stored_member(f, members[INDEX]), members[INDEX]["size"])
                lines = [json.loads(x) for x in index.decode().split("\n") if x]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(lines)), pa.array([base + x["offset"] for x in lines], pa.int64()),
                                                  pa.array([x["length"] for x in lines], pa.int64())], ["archive", "at", "length"])

    return archives.select("archive").mapInArrow(run, "archive string, at long, length long")


#: Bytes of an archive that one task reads from its start to its end.
STRETCH = 4 << 20


def read_records(located: DataFrame) -> DataFrame:
    """Range-read the located records: page_id, url, payload (null of revisits), payload_bytes,
    payload_digest, record_type, refers_to."""
    prepare_workers(located.sparkSession)
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(maxsize=1)
        def opened(name: str) -> pa.NativeFile:
            fs, path = file_system(name)
            return fs.open_input_file(path)

        for b in batches:
            rows = list(zip(*(c.to_pylist() for c in b.columns), strict=True))
            for i in range(0, len(rows), 256):
                found = [parse_record(gzip.decompress(read_at(opened(name), at, n))) for name, at, n in rows[i:i + 256]]
                yield pa.RecordBatch.from_pylist(found, schema)

    # Records are dealt by stretches of their archives: a manifest's few files would make few tasks.
    spark = located.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = located.select("archive", "at", "length").repartition(n, "archive", F.expr(f"at div {STRETCH}")).sortWithinPartitions("archive", "at")
    return dealt.mapInArrow(
        run, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long")
