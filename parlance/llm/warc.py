"""WARC files as a PySpark data source (operator 6).

Writing: a task writes files of bounded size, one gzip member a record, with the member's compressed and whole lengths in the gzip
header's extra field ``sl``. The driver's commit lists the files of successful tasks; other files are not read.
Reading: a partition is one file. Predicates on record type, ids, target, date and digest are pushed down; a reader inflates
a record's header only, and skips the payload of a record that is not wanted, or of all records where the payload is not asked for. Rows
go to Spark as Arrow batches. Header names count in any case; a record without a length, or a file that ends inside one, fails the query; an HTTP
block without a blank line is a payload as a whole.
"""

from __future__ import annotations

import base64
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, WriterCommitMessage

from parlance.llm.common import new_path

SCHEMA = "record_id string, record_type string, target_uri string, date string, refers_to string, payload_digest string, payload_bytes bigint, payload binary"
#: Names of the format's header fields.
FIELDS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest", "payload_bytes": "X-Payload-Length"}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LIST = "files.json"
#: Bytes after which a file ends with the next record; rows and bytes of a batch for Spark.
FILE_BYTES, ROWS, BYTES = 1 << 30, 500, 1 << 23


def opened(root: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(root if ":/" in root else f"file://{root}")


def record_bytes(row: dict) -> bytes:
    payload = row["payload"] or b""
    revisit = row["record_type"] == "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1"]
    for column, field in FIELDS.items():
        if row[column] is not None:
            head.append(f"{field}: " + str(row[column]).replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        head.append(f"WARC-Profile: {PROFILE}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int = 1) -> bytes:
    """A gzip member that tells its own length and that of its content."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    size = 10 + 2 + 12 + len(body) + 8
    if size >= 1 << 32 or len(data) >= 1 << 32:
        return struct.pack("<4BI2B", 31, 139, 8, 0, 0, 0, 255) + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    return struct.pack("<4BI2BH2sHII", 31, 139, 8, 4, 0, 0, 255, 12, b"sl", 8, size, len(data)) + body + struct.pack("<II", zlib.crc32(data), len(data))


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, root: str, file_bytes: int = FILE_BYTES):
        self.root, self.file_bytes = root, file_bytes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, base = opened(self.root)
        fs.create_dir(base, recursive=True)
        files, sink, size = [], None, 0
        for batch in iterator:
            for lo in range(0, batch.num_rows, 200):
                for row in batch.slice(lo, 200).to_pylist():
                    if sink is None:
                        files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        sink, size = fs.open_output_stream(f"{base}/{files[-1]}", compression=None), 0
                    data = member(record_bytes(row))
                    sink.write(data)
                    size += len(data)
                    if size >= self.file_bytes:
                        sink.close()
                        sink = None
        if sink is not None:
            sink.close()
        return Written(files)

    def commit(self, messages: list) -> None:
        fs, base = opened(self.root)
        fs.create_dir(base, recursive=True)
        listed = json.loads(read_all(fs, f"{base}/{LIST}")) if exists(fs, f"{base}/{LIST}") else []
        with fs.open_output_stream(f"{base}/{LIST}") as sink:
            sink.write(json.dumps(listed + [f for m in messages if m is not None for f in m.files]).encode())

    def abort(self, messages: list) -> None:
        fs, base = opened(self.root)
        for m in messages:
            for f in m.files if m is not None else []:
                fs.delete_file(f"{base}/{f}")


def exists(fs: pafs.FileSystem, path: str) -> bool:
    return fs.get_file_info(path).type != pafs.FileType.NotFound


def read_all(fs: pafs.FileSystem, path: str) -> bytes:
    with fs.open_input_file(path) as f:
        return f.read()


@dataclass
class FilePartition(InputPartition):
    file: str


class Member:
    """A record in a file: its text up to a length, or past it. Plain files and gzip members with or without ``sl``."""

    def __init__(self, f, at: int, zipped: bool):
        self.f, self.at, self.end = f, at, None
        f.seek(at)
        self.inflate = None
        if zipped:
            start = f.read(24)
            if len(start) == 24 and start[3] == 4 and start[12:14] == b"sl":
                self.end = at + struct.unpack("<I", start[16:20])[0]
            f.seek(at)
            self.inflate = zlib.decompressobj(31)
        self.data, self.over = b"", False

    def more(self, size: int = 2048) -> bool:
        if self.over:
            return False
        if self.inflate is None:
            got = self.f.read(size)
            self.data += got
            self.over = not got
        elif self.inflate.unconsumed_tail:
            self.data += self.inflate.decompress(self.inflate.unconsumed_tail, size * 4)
        else:
            got = self.f.read(size if self.end is None else min(size, max(0, self.end - self.f.tell())))
            if got:
                self.data += self.inflate.decompress(got, size * 4)
            self.over = self.inflate.eof or not got
        return True

    def upto(self, mark: bytes) -> int:
        while (k := self.data.find(mark)) < 0 and self.more():
            pass
        return k

    def take(self, size: int) -> bytes:
        while len(self.data) < size and self.more(max(2048, min(1 << 20, size))):
            pass
        return self.data[:size]

    def finish(self, size: int) -> int:
        """Where the next record begins; ``size`` is this one's whole length."""
        if self.inflate is None:
            return self.at + size
        if self.end is None:
            while self.more(1 << 16):
                self.data = b""
            self.end = self.f.tell() - len(self.inflate.unused_data)
        return self.end


def records(f, length: int, zipped: bool, wanted: dict[str, set], payload: bool) -> Iterator[tuple]:
    at = 0
    while at < length:
        one = Member(f, at, zipped)
        cut = one.upto(b"\r\n\r\n")
        if cut < 0:
            if one.data.strip():
                raise ValueError(f"a record at {at} ends inside its header")
            return  # white space after the last record
        if not one.data[:cut].strip():  # blank lines between records
            at = one.finish(cut + 4)
            continue
        fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in one.data[:cut].decode("utf-8", "replace").strip().split("\r\n")[1:])}
        if not fields.get("content-length", "").isdigit():
            raise ValueError(f"a record at {at} has no length")
        body = int(fields["content-length"])
        row = {c: fields.get(name.lower()) for c, name in FIELDS.items()}
        row["payload_bytes"] = int(row["payload_bytes"]) if row["payload_bytes"] is not None else None
        if all(row[c] in some for c, some in wanted.items()):
            content = None
            if payload and row["record_type"] != "revisit":
                block = one.take(cut + 4 + body)[cut + 4 :]
                if len(block) < body:
                    raise ValueError(f"a record at {at} ends inside its block")
                head, blank, rest = block.partition(b"\r\n\r\n")
                content = rest if blank and "application/http" in fields.get("content-type", "") else block
            yield (*row.values(), content)
        at = one.finish(cut + 4 + body + 4)


def row_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    columns = [x.split() for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[kind]) for c, (_, kind) in zip(zip(*rows, strict=True), columns, strict=True)], [name for name, _ in columns])


class WarcReader(DataSourceReader):
    def __init__(self, root: str, payload: bool):
        self.root, self.payload = root, payload
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list):
        for f in filters:
            some = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if some is None or len(f.attribute) != 1 or f.attribute[0] not in FIELDS:
                yield f
            else:
                self.wanted[f.attribute[0]] = self.wanted.get(f.attribute[0], some) & some

    def partitions(self) -> list[FilePartition]:
        fs, base = opened(self.root)
        if exists(fs, f"{base}/{LIST}"):
            names = json.loads(read_all(fs, f"{base}/{LIST}"))
        elif fs.get_file_info(base).type == pafs.FileType.File:
            return [FilePartition("")]
        else:
            names = sorted(x.base_name for x in fs.get_file_info(pafs.FileSelector(base, recursive=False)) if x.base_name.endswith((".warc", ".warc.gz")))
        return [FilePartition(n) for n in names]

    def read(self, partition: FilePartition | None) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        fs, base = opened(self.root)
        path = f"{base}/{partition.file}".rstrip("/")
        with fs.open_input_file(path) as f:
            held, size = [], 0
            for row in records(f, f.size(), path.endswith(".gz"), self.wanted, self.payload):
                held.append(row)
                size += len(row[-1] or b"")
                if len(held) >= ROWS or size >= BYTES:
                    yield row_batch(held)
                    held, size = [], 0
            if held:
                yield row_batch(held)


class WarcSource(DataSource):
    """Format ``warc``; options: path, payload (``false`` leaves payloads unread), fileBytes (after which a file ends)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true") != "false")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], int(self.options.get("fileBytes", FILE_BYTES)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


#: Base32 by arithmetic: five hexadecimal digits are four letters.
def base32_column(digest):
    """Column: a hexadecimal SHA-1 as upper-case base32."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    out = []
    for k in range(0, 40, 5):
        group = F.conv(F.substring(digest, k + 1, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(letters), F.shiftright(group, 15 - 5 * i).bitwiseAND(31) + 1, F.lit(1)) for i in range(4)]
    return F.concat(*out)


def page_records(pages: DataFrame, least: int = 0) -> DataFrame:
    """A record for each page, of any length. Of pages with equal payloads of at least ``least`` bytes that of the smallest page_id is a
    response and the others are revisits of it; all smaller ones are responses.

    Defined results: a null html is an empty payload; a null url gives no target; rows that repeat a page_id and its html
    are alike; a null page_id never refers; an empty table gives no records; further columns are ignored.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    keys = rows.select("page_id", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("size")).where(F.col("size") >= least)
    first = keys.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    again = keys.join(first, "digest").where("page_id > first").select("page_id", "digest", "first").distinct()
    rows = rows.withColumn("digest", F.sha1("payload"))
    all_ = rows.join(again, ["page_id", "digest"], "left")
    name = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    revisit = F.col("first").isNotNull()
    return all_.select(
        name(F.col("page_id")).alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.col("url").alias("target_uri"), F.lit("2024-01-01T00:00:00Z").alias("date"),
        F.when(revisit, name(F.col("first"))).alias("refers_to"), F.concat(F.lit("sha1:"), base32_column(F.col("digest"))).alias("payload_digest"), F.octet_length("payload").cast("bigint").alias("payload_bytes"), F.when(~revisit, F.col("payload")).alias("payload"),
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through WARC files. A response's length and digest are those of the payload that was read back."""
    register(spark)
    root = new_path(spark, "warc")
    page_records(spark.read.parquet(f"{sf_dir}/pages.parquet")).write.format("warc").mode("append").save(root)
    back = spark.read.format("warc").option("path", root).load()
    number = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1)
    real = F.col("record_type") == "response"
    back = back.withColumn("digest", F.when(real, F.sha1("payload")))
    return back.select(
        F.nullif(number("record_id"), F.lit("")).cast("bigint").alias("page_id"), F.when(real, F.octet_length("payload")).otherwise(F.col("payload_bytes")).cast("bigint").alias("payload_bytes"),
        F.when(real, base32_column(F.col("digest"))).otherwise(F.substring("payload_digest", 6, 32)).alias("payload_digest"), "record_type", F.when(~real, number("refers_to").cast("bigint")).alias("refers_to"),
    )


OP6_SQL = """
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as digest from pages),
f as (select digest, min(page_id) as first from p group by digest)
select page_id, cast(strlen(html) as bigint) as payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((cast('0x' || substr(digest, 5 * (i // 4) + 1, 5) as bigint) >> (15 - 5 * (i % 4))) & 31 as int) + 1, 1) for i in range(32)], '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id = first then null else first end as refers_to
from p join f using (digest)
"""
