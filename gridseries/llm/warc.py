"""Legacy archives to WARC: ARC files of version 1 or 2 in, WARC 1.1 files out, both read and written by Spark.

``write_arcs`` packs pages into ARC files, ``read_arcs`` parses them by the version line and the declared lengths,
``write_warcs`` synthesises WARC records (identifier, time, type, digests) and ``read_warcs`` reads those back.
Files are compressed by gzip and cut at about ``ARCHIVE_BYTES`` of content, so one file is one bounded piece of work; a record larger than that has a file
to itself. Each task packs the rows it has: pages are not shuffled for writing. Records with equal payloads of
at least ``min_revisit_bytes`` become one response, with the largest page id, and revisits of it.

A null html is an empty payload and a null url the target ``-``. A null page id stays null and counts as the smallest.
Of repeated rows with the largest id one is the response, the others revisit it. Very long pages are kept whole.
An empty table gives empty folders and an empty result. Other columns of the input are left out.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARCHIVE_BYTES = 8 << 20
# A few percent more bytes than the default level for much less time; compressing is most of what the conversion costs.
GZIP_LEVEL = {"zlib.compress.level": "FOUR"}
DATE = "20240101000000"
V1 = "URL IP-address Archive-date Content-type Archive-length"
V2 = "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"
FIELDS = {"1": V1.split(), "2": V2.split()}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def one_field(text: str | None) -> str:
    """A header field without spaces or control characters: those are percent-encoded; null is ``-``."""
    if not text:
        return "-"
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


# Writing


def _pack(rows: DataFrame, path: str, first_piece, piece_of, line_end: str) -> None:
    """Write pieces of bytes as files of about ARCHIVE_BYTES in one folder, each begun by ``first_piece``.

    A row is a whole archive and a file holds one row, so tasks neither sort their pieces nor open a folder for each file.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number, room, held = TaskContext.get().partitionId(), 0, 0, []

        def closed() -> pd.DataFrame:
            found = pd.DataFrame({"archive": [line_end.encode().join(held)]})
            held.clear()
            return found

        for batch in batches:
            for row in batch.itertuples(index=False):
                piece = piece_of(row)
                if held and room < len(piece):
                    yield closed()
                    number += 1
                if not held:
                    room = ARCHIVE_BYTES
                    held.append(first_piece(f"{part:06d}-{number:06d}", number))
                room -= len(piece)
                held.append(piece)
        if held:
            yield closed()

    whole = rows.mapInPandas(run, "archive binary").select(F.col("archive").cast("string").alias("value"))
    whole.write.options(lineSep=line_end, compression="gzip", maxRecordsPerFile=1, **GZIP_LEVEL).text(path)


def arc_version_block(name: str, version: str) -> bytes:
    body = f"{version} 0 gridseries\n{V1 if version == '1' else V2}\n".encode()
    fields = {"URL": f"filedesc://{name}.arc", "IP-address": "0.0.0.0", "Archive-date": DATE,
              "Content-type": "text/plain", "Archive-length": str(len(body)), "Result-code": "200", "Checksum": "-",
              "Location": "-", "Offset": "0", "Filename": f"{name}.arc"}
    return (" ".join(fields[f] for f in FIELDS[version]) + "\n").encode() + body


def arc_record(version: str, name: str, url: str | None, block: bytes) -> bytes:
    fields = {"URL": one_field(url), "IP-address": "192.0.2.1", "Archive-date": DATE, "Content-type": "text/html",
              "Archive-length": str(len(block)), "Result-code": "200", "Checksum": hashlib.md5(block).hexdigest(),
              "Location": "-", "Offset": "-", "Filename": f"{name}.arc"}
    return (" ".join(fields[f] for f in FIELDS[version]) + "\n").encode() + block


def write_arcs(pages: DataFrame, path: str, versions: str = "12") -> str:
    """Pages (page_id, url, html) as ARC files; the versions take turns from task to task."""
    rows = pages.select(F.col("page_id").cast("long").cast("string").alias("page_id"), F.col("url").cast("string"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("html"))

    def version() -> str:
        return versions[TaskContext.get().partitionId() % len(versions)]

    def piece(row) -> bytes:
        payload = bytes(row.html)
        head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        head += f"X-Page-Id: {row.page_id}\r\n" if row.page_id is not None and row.page_id == row.page_id else ""
        return arc_record(version(), "pages", row.url, f"{head}Content-Length: {len(payload)}\r\n\r\n".encode() + payload)

    _pack(rows, path, lambda name, number: arc_version_block(name, version()), piece, "\n")
    return path


# Reading ARC


def parse_arc(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, block) of each record after the version block, by declared lengths."""
    at, fields = 0, None
    while at < len(content):
        if content[at: at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = content.index(b"\n", at)
        values = content[at:end].decode().rstrip("\r").split(" ")
        length = int(values[-1])
        block = content[end + 1: end + 1 + length]
        if len(block) != length:
            raise ValueError(f"record at byte {at} declares {length} bytes, {len(block)} are there")
        if fields is None:
            if not values[0].startswith("filedesc://"):
                raise ValueError("no version block at the start of the archive")
            version = block.split(b" ", 1)[0].decode()
            if version not in FIELDS:
                raise ValueError(f"unknown archive version {version}")
            fields = FIELDS[version]
        else:
            if len(values) != len(fields):
                raise ValueError(f"record at byte {at} has {len(values)} fields, {len(fields)} are due")
            yield at, dict(zip(fields, values, strict=True)), block
        at = end + 1 + length


def http_parts(block: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and payload of an HTTP response."""
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, payload


def archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "part-*").load(path).select("path", "content")


RECORD = ("record_id string, page_id long, url string, date string, ip string, content_type string, block binary, "
          "payload_bytes long, payload_digest string")


def read_arcs(spark: SparkSession, path: str) -> DataFrame:
    """The records of ARC files with the identifiers and digests that their WARC records get."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in RECORD.split(", ")]
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                short = name.rsplit("/", 1)[-1]
                out = []
                for offset, fields, block in parse_arc(gzip.decompress(content)):
                    head, payload = http_parts(block)
                    number = head.get("x-page-id")
                    out.append((f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{short}#{offset}')}",
                                None if number is None else int(number), fields["URL"], fields["Archive-date"],
                                fields["IP-address"], fields["Content-type"], block, len(payload), sha1(payload)))
                frame = pd.DataFrame(out, columns=columns)
                yield frame.assign(page_id=frame["page_id"].astype("Int64"))

    return archives(spark, path).mapInPandas(run, RECORD)


# WARC


def warc_types(records: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Records with their type and, for revisits, the record and page they refer to."""
    key = F.struct("page_id", "record_id")
    keepers = records.filter(F.col("payload_bytes") >= min_revisit_bytes).groupBy("payload_digest", "payload_bytes").agg(
        F.max(F.struct("page_id", "record_id", "url", "date")).alias("first"))
    joined = records.join(keepers, ["payload_digest", "payload_bytes"], "left")
    again = F.col("first").isNotNull() & (F.struct("first.page_id", "first.record_id") != key)
    return joined.select(
        *[c for c in records.columns], F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("first"))


def warc_date(date: str) -> str:
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in headers], f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block


def write_warcs(records: DataFrame, path: str) -> str:
    """Typed records as WARC files; a revisit keeps only the HTTP header as its block."""
    rows = records.select("record_id", F.col("page_id").cast("string"), "url", "date", "ip", "block", "payload_digest",
                          F.col("payload_bytes").cast("string"), "record_type",
                          F.col("first.record_id").alias("to_id"), F.col("first.page_id").cast("string").alias("to_page"),
                          F.col("first.url").alias("to_url"), F.col("first.date").alias("to_date"))

    def info(name: str, number: int) -> bytes:
        body = b"software: gridseries\r\nformat: WARC File Format 1.1\r\n"
        return warc_record([
            ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"),
            ("WARC-Date", warc_date(DATE)), ("WARC-Filename", f"{name}.warc"),
            ("Content-Type", "application/warc-fields")], body)

    def piece(row) -> bytes:
        block = bytes(row.block)
        headers = [("WARC-Type", row.record_type), ("WARC-Record-ID", f"<{row.record_id}>"),
                   ("WARC-Date", warc_date(row.date)), ("WARC-Target-URI", row.url), ("WARC-IP-Address", row.ip),
                   ("Content-Type", "application/http; msgtype=response"),
                   ("WARC-Payload-Digest", f"sha1:{row.payload_digest}"), ("X-Payload-Length", row.payload_bytes)]
        if row.page_id is not None and row.page_id == row.page_id:
            headers.append(("X-Page-Id", row.page_id))
        if row.record_type == "revisit":
            block = block.partition(b"\r\n\r\n")[0] + b"\r\n\r\n"
            headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{row.to_id}>"),
                        ("WARC-Refers-To-Target-URI", row.to_url), ("WARC-Refers-To-Date", warc_date(row.to_date))]
            if row.to_page is not None and row.to_page == row.to_page:
                headers.append(("X-Refers-To-Page-Id", row.to_page))
        return warc_record([*headers, ("WARC-Block-Digest", f"sha1:{sha1(block)}")], block)

    _pack(rows, path, info, piece, "\r\n\r\n")
    return path


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record, by declared lengths."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        begin = end + 4
        stop = begin + int(fields["Content-Length"])
        if content[stop: stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} doesn't end where it declares")
        yield fields, content[begin:stop]
        at = stop + 4


BACK = ("record_id string, page_id long, url string, date string, record_type string, payload_bytes long, "
        "payload_digest string, refers_to long, refers_to_record string, payload binary")


def read_warcs(spark: SparkSession, path: str) -> DataFrame:
    """Responses and revisits of WARC files. Digests of blocks and payloads are recomputed and must agree."""
    def number(text: str | None) -> int | None:
        return None if text is None else int(text)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in BACK.split(", ")]
        for batch in batches:
            for content in batch["content"]:
                out = []
                for f, block in parse_warc(gzip.decompress(content)):
                    if f["WARC-Type"] not in ("response", "revisit"):
                        continue
                    digest, payload = f["WARC-Payload-Digest"].removeprefix("sha1:"), None
                    if sha1(block) != f["WARC-Block-Digest"].removeprefix("sha1:"):
                        raise ValueError(f"{f['WARC-Record-ID']}: its block has another digest")
                    if f["WARC-Type"] == "response":
                        payload = http_parts(block)[1]
                        if sha1(payload) != digest or len(payload) != int(f["X-Payload-Length"]):
                            raise ValueError(f"{f['WARC-Record-ID']}: its payload has another digest or length")
                    out.append((f["WARC-Record-ID"].strip("<>"), number(f.get("X-Page-Id")), f["WARC-Target-URI"],
                                f["WARC-Date"], f["WARC-Type"], int(f["X-Payload-Length"]), digest,
                                number(f.get("X-Refers-To-Page-Id")), f.get("WARC-Refers-To", "").strip("<>") or None,
                                payload))
                frame = pd.DataFrame(out, columns=columns)
                yield frame.assign(page_id=frame["page_id"].astype("Int64"), refers_to=frame["refers_to"].astype("Int64"))

    return archives(spark, path).mapInPandas(run, BACK)


def convert(spark: SparkSession, arcs: str, warcs: str, min_revisit_bytes: int = 0) -> DataFrame:
    """Convert a folder of ARC files to WARC files; gives what the new files hold."""
    write_warcs(warc_types(read_arcs(spark, arcs), min_revisit_bytes), warcs)
    return read_warcs(spark, warcs)
