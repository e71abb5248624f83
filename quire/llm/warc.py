"""WARC archives as a PySpark Python data source (``format("warc")``).

Archives are gzip files of one member for each record. Each member's header
carries the WARC standard's ``sl`` extra field (compressed and uncompressed
length), so a reader inflates the first bytes of a member, parses the headers,
and seeks past the payload unless it is wanted.

Reading: files become one partition each (writers roll files at
``roll_bytes``); filters on ``record_type``, ``record_id``, ``target_uri``,
``refers_to`` and ``payload_digest`` are pushed into the header stage; option
``payload=false`` leaves every payload undecoded. Writing follows Spark's
commit protocol: tasks write files under unique names, the commit puts their
names into a manifest, and readers see only files that a manifest names, so
retried and lost tasks leave no duplicate.

Paths are opened with ``pyarrow.fs`` and may be any URI that it knows; a bare
path is a local one.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from .common import scratch

SCHEMA = (
    "record_id string, record_type string, target_uri string, record_date string, refers_to string, "
    "payload_digest string, full_bytes long, content_length long, payload binary"
)
#: WARC header of each column that has one.
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "record_date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "full_bytes": "X-Full-Payload-Length",
    "content_length": "Content-Length",
}
PUSHED = ("record_type", "record_id", "target_uri", "refers_to", "payload_digest")
HEAD_BYTES = 4096
ROLL_BYTES = 64 << 20
_EXTRA = b"sl" + struct.pack("<H", 8)


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return pafs.LocalFileSystem(), path


def member(headers: list[tuple[str, str]], payload: bytes) -> bytes:
    """One record as a gzip member with its lengths in the ``sl`` field."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers)
    body = b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + payload + b"\r\n\r\n"
    packer = zlib.compressobj(1, zlib.DEFLATED, -15)
    deflated = packer.compress(body) + packer.flush()
    total = 24 + len(deflated) + 8
    head = b"\x1f\x8b\x08\x04" + b"\0\0\0\0" + b"\0\xff" + struct.pack("<H", 12) + _EXTRA + struct.pack("<II", total, len(body) & 0xFFFFFFFF)
    return head + deflated + struct.pack("<II", zlib.crc32(body), len(body) & 0xFFFFFFFF)


def parse_headers(block: bytes) -> dict[str, str]:
    out = {}
    for line in block.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        out[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    return out


def scan(file, wanted, decode: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """Headers and payloads (None if not decoded) of the records that ``wanted`` accepts."""
    at, end = 0, file.size()
    while at < end:
        file.seek(at)
        first = file.read(24 + HEAD_BYTES)
        if len(first) < 24 or first[:4] != b"\x1f\x8b\x08\x04" or first[12:16] != _EXTRA:
            raise ValueError(f"no record with skip lengths at byte {at}")
        total, _ = struct.unpack("<II", first[16:24])
        inflate = zlib.decompressobj(-15)
        text = inflate.decompress(first[24 : min(len(first), total - 8)])
        got = len(first)
        while (cut := text.find(b"\r\n\r\n")) < 0 and got < total:
            text += inflate.decompress(more := file.read(min(HEAD_BYTES, total - got)))
            got += len(more)
        headers = parse_headers(text[:cut])
        if wanted(headers):
            payload = None
            if decode:
                if got < total:
                    text += inflate.decompress(file.read(total - got))
                text += inflate.flush()
                payload = text[cut + 4 : cut + 4 + int(headers["content-length"])]
            yield headers, payload
        at += total


@dataclass
class FilePart(InputPartition):
    path: str


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.decode = options.get("payload", "true").lower() != "false"
        self.only: list[tuple[str, tuple]] = []

    def pushFilters(self, filters: list[Filter]):  # noqa: N802
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in PUSHED and isinstance(f, EqualTo):
                self.only.append((HEADERS[column].lower(), (f.value,)))
            elif column in PUSHED and isinstance(f, In):
                self.only.append((HEADERS[column].lower(), tuple(f.value)))
            elif not (isinstance(f, IsNotNull) and column == "record_type"):
                yield f

    def partitions(self) -> list[FilePart]:
        fs, folder = open_folder(self.path)
        names = []
        for info in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
            if info.base_name.startswith("manifest-"):
                with fs.open_input_stream(info.path) as f:
                    names += json.loads(f.read())
        return [FilePart(n) for n in sorted(names)]

    def read(self, partition: FilePart) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, FilePart):
            return
        only, schema = self.only, pa.schema(_arrow_fields())
        fs, folder = open_folder(self.path)

        def wanted(headers: dict[str, str]) -> bool:
            return all(headers.get(k) in v for k, v in only)

        rows: list[tuple] = []
        held = 0
        with fs.open_input_file(f"{folder}/{partition.path}") as file:
            for headers, payload in scan(file, wanted, self.decode):
                values = [headers.get(h.lower()) for h in HEADERS.values()]
                values[6:8] = [None if x is None else int(x) for x in values[6:8]]
                rows.append((*values, payload))
                held += len(payload or b"")
                if len(rows) >= 1024 or held > 8 << 20:
                    yield _batch(rows, schema)
                    rows, held = [], 0
        if rows:
            yield _batch(rows, schema)


def _arrow_fields() -> list[tuple[str, pa.DataType]]:
    kinds = {"full_bytes": pa.int64(), "content_length": pa.int64(), "payload": pa.binary()}
    return [(c, kinds.get(c, pa.string())) for c in (*HEADERS, "payload")]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


class WarcWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.roll = int(options.get("roll_bytes", ROLL_BYTES))

    def write(self, iterator) -> Written:
        fs, folder = open_folder(self.path)
        fs.create_dir(folder, recursive=True)
        files: list[str] = []
        out, size = None, 0
        stamp = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
        for row in iterator:
            if out is None or size >= self.roll:
                if out is not None:
                    out.close()
                files.append(f"records-{uuid.uuid4().hex}.warc.gz")
                out, size = fs.open_output_stream(f"{folder}/{files[-1]}", compression=None), 0
            payload = bytes(row["payload"] or b"")
            headers = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", row["record_date"] or stamp)]
            headers += [(HEADERS[c], str(row[c])) for c in ("target_uri", "refers_to", "payload_digest", "full_bytes") if row[c] is not None]
            headers = [(k, "" if v is None else " ".join(v.split("\r\n"))) for k, v in headers] + [("Content-Length", str(len(payload)))]
            size += out.write(record := member(headers, payload)) or len(record)
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages) -> None:
        fs, folder = open_folder(self.path)
        fs.create_dir(folder, recursive=True)
        names = [n for m in messages if m is not None for n in m.files]
        with fs.open_output_stream(f"{folder}/manifest-{uuid.uuid4().hex}.json") as f:
            f.write(json.dumps(names).encode())

    def abort(self, messages) -> None:
        fs, folder = open_folder(self.path)
        for name in (n for m in messages if m is not None for n in m.files):
            fs.delete_file(f"{folder}/{name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def page_records(pages: DataFrame, least: int = 0) -> DataFrame:
    """Records of ``pages``: response, or revisit of the equal payload with the smallest page_id.

    Payloads of fewer than ``least`` bytes are all responses. Null html is an
    empty payload. Rows that repeat the smallest page_id are responses too; a
    null page_id sorts last. Only digests and ids meet in the grouping, which
    sums up on the map side; the join splits hot payloads.
    """
    rows = pages.select("page_id", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("body"), F.col("url").alias("target_uri"))
    rows = rows.withColumns({"sha": F.sha1("body"), "full_bytes": F.octet_length("body").cast("long")})
    # The first of a group is found from two narrow columns; no html is shuffled for it.
    firsts = (
        rows.where(F.col("full_bytes") >= least)
        .groupBy("sha", "full_bytes")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("sha", "full_bytes", "first_id")
    )
    found = rows.join(firsts, ["sha", "full_bytes"], "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return found.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(">")).alias("record_id"),
        "target_uri",
        F.lit(None).cast("string").alias("record_date"),
        F.when(again, F.concat(F.lit("<urn:page:"), F.col("first_id").cast("string"), F.lit(">"))).alias("refers_to"),
        F.lit("sha1:").alias("prefix"),
        "sha",
        "full_bytes",
        F.when(~again, F.col("body")).alias("payload"),
    ).select(
        "record_id", "record_type", "target_uri", "record_date", "refers_to",
        F.concat("prefix", base32(F.col("sha"))).alias("payload_digest"), "full_bytes", "payload",
    )


def base32(hex40):
    """A SHA-1's 40 hex digits in base32, 20 bits at a time."""
    parts = []
    for i in range(0, 40, 5):
        bits = F.conv(F.substring(hex40, i + 1, 5), 16, 10).cast("long")
        for shift in (15, 10, 5, 0):
            parts.append(F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), (F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1)))
    return F.concat(*parts)


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``pages`` as WARC archives, read them back, and report every record.

    Digest and length of a response are taken again from its payload; those of
    a revisit come from its headers.
    """
    spark = pages.sparkSession
    register(spark)
    path = path or scratch(spark, "warc")
    page_records(pages).write.format("warc").mode("append").option("path", path).save()
    records = spark.read.format("warc").option("path", path).load()
    page = F.regexp_extract("record_id", r"^<urn:page:(-?\d+)>$", 1)
    refers = F.regexp_extract("refers_to", r"^<urn:page:(-?\d+)>$", 1)
    kept = F.col("record_type") == "response"
    return records.select(
        F.when(page != "", page.try_cast("long")).alias("page_id"),
        F.when(kept, F.octet_length("payload").cast("long")).otherwise(F.col("full_bytes")).alias("payload_bytes"),
        F.when(kept, base32(F.sha1("payload"))).otherwise(F.substring("payload_digest", 6, 32)).alias("payload_digest"),
        "record_type",
        F.when(~kept & (refers != ""), refers.try_cast("long")).alias("refers_to"),
    )


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h, min(page_id) OVER (PARTITION BY sha1(b)) AS first_id FROM p),
bits AS (SELECT page_id, n, first_id, h, list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31 AS BIGINT), 1)) AS q FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, array_to_string(q, '') AS payload_digest,
    CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM bits
"""
