"""WARC archives: write pages, resolve repeated payloads into revisit records, write deduplicated archives, read them back.

An archive is a .warc.gz of one gzip member for each record. Tasks write files of their own names into a folder that all
executors share and return their names, so files of a failed attempt are never read. Archives are cut at a size, and a
task reads one archive as a stream.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystar.llm.common import Batches, stored, utf8
from quaystar.session import shared_folder

CUT_BYTES = 64 << 20
LEVEL = 1
CHUNK = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILES = "file string, records long"
HEADERS = (
    "file string, at long, size long, record_id string, record_type string, page_id {id}, url string, date string,"
    " payload_bytes long, payload_digest string, refers_to_id string"
)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record as a gzip member. Line breaks in a value are written as in a URL."""
    lines = [f"{k}: {v.replace('\r', '%0D').replace('\n', '%0A')}" for k, v in headers if v is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}", "", ""]).encode()
    packer = zlib.compressobj(LEVEL, wbits=31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def response(record_id: str, page_id: str | None, url: str | None, date: str, payload: bytes) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [
        ("WARC-Type", "response"),
        ("WARC-Record-ID", f"<urn:uuid:{record_id}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"),
        ("X-Page-ID", page_id),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return _record(headers, http + payload)


def revisit(record_id: str, page_id: str | None, url: str | None, date: str, digest: str, original: dict | None) -> bytes:
    headers = [
        ("WARC-Type", "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{record_id}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Page-ID", page_id),
        ("WARC-Profile", PROFILE),
        ("WARC-Refers-To", f"<urn:uuid:{original['id']}>" if original else None),
        ("WARC-Refers-To-Target-URI", original["url"] if original else None),
        ("WARC-Refers-To-Date", original["date"] if original else None),
    ]
    return _record(headers, b"")


class _Archives:
    """Writes records to archives of a folder; a new archive begins when one is large enough."""

    def __init__(self, folder: str, cut_bytes: int):
        self.store, self.path = fs.FileSystem.from_uri(folder)
        self.folder, self.cut_bytes = folder, cut_bytes
        self.stream, self.name, self.size, self.records = None, "", 0, 0
        self.done: list[tuple[str, int]] = []

    def add(self, record: bytes) -> None:
        if self.stream is None:
            self.store.create_dir(self.path)
            self.name = f"{uuid.uuid4().hex}.warc.gz"
            self.stream, self.size, self.records = self.store.open_output_stream(f"{self.path}/{self.name}", compression=None), 0, 0
        self.stream.write(record)
        self.size += len(record)
        self.records += 1
        if self.size >= self.cut_bytes:
            self.close()

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.done.append((f"{self.folder}/{self.name}", self.records))
            self.stream = None

    def files(self) -> pa.RecordBatch:
        self.close()
        names, counts = [x[0] for x in self.done], [x[1] for x in self.done]
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], names=["file", "records"])


def members(stream) -> Iterator[tuple[int, int, bytes]]:
    """Place, size and content of each gzip member."""
    data, at = b"", 0
    while True:
        data = data or stream.read(CHUNK)
        if not data:
            return
        unpacker, content, size = zlib.decompressobj(31), [], 0
        while not unpacker.eof:
            data = data or stream.read(CHUNK)
            if not data:
                raise EOFError("an archive ends inside a record")
            content.append(unpacker.decompress(data))
            size += len(data)
            data = b""
        data = unpacker.unused_data
        size -= len(data)
        yield at, size, b"".join(content)
        at += size


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and payload of a record; of an HTTP response, what comes after the HTTP header."""
    head, _, block = record.partition(b"\r\n\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n")[1:])}
    block = block[: int(headers.get("content-length", 0))]
    if headers.get("content-type", "").startswith("application/http"):
        block = block.partition(b"\r\n\r\n")[2]
    return headers, block


def _id(value: str | None) -> str | None:
    return value.removeprefix("<urn:uuid:").removesuffix(">") if value else None


def write_archives(pages: DataFrame, folder: str, cut_bytes: int = CUT_BYTES) -> DataFrame:
    """Every page (page_id, url, html) as a response record; returns the files. Other columns are left out."""
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = pages.select(F.col("page_id").cast("string").alias("page_id"), "url", "html")

    def run(batches: Batches) -> Batches:
        archives = _Archives(folder, cut_bytes)
        for batch in batches:
            columns = batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2))
            for page_id, url, payload in zip(*columns, strict=True):
                archives.add(response(str(uuid.uuid4()), page_id, url, date, payload))
        yield archives.files()

    return stored(rows.mapInArrow(run, FILES), "warc_files")


def read_headers(files: DataFrame, id_type: str = "bigint") -> DataFrame:
    """The headers of all records of the archives; of a response, size and digest are those of the payload itself."""
    each = files.select("file").repartition(max(1, files.count()))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                store, path = fs.FileSystem.from_uri(file)
                found: list[tuple] = []
                with store.open_input_stream(path, compression=None) as stream:
                    for at, size, record in members(stream):
                        headers, payload = parsed(record)
                        own = headers["warc-type"] == "response"
                        digest = digest_of(payload) if own else headers.get("warc-payload-digest", "").removeprefix("sha1:")
                        found.append((
                            file, at, size, _id(headers["warc-record-id"]), headers["warc-type"], headers.get("x-page-id"),
                            headers.get("warc-target-uri"), headers.get("warc-date"), len(payload) if own else None, digest,
                            _id(headers.get("warc-refers-to")),
                        ))
                columns = list(zip(*found, strict=True)) or [()] * 11
                kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    schema = HEADERS.format(id="string")
    names = [part.split()[0] for part in schema.split(", ")]
    rows = each.mapInArrow(run, schema)
    return stored(rows.withColumn("page_id", F.col("page_id").cast(id_type)), "warc_headers")


def resolved(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """`headers` plus `original`: for a record whose payload an earlier response has, that response.

    Headers are brought together by payload digest. The first response is the one with the smallest page_id (a null one
    comes last), then by place in the archives. Only digests that several records share take part in the join.
    """
    first = F.struct(
        F.col("page_id").isNull().alias("no_id"), *[F.col(c) for c in ("page_id", "file", "at", "url", "date", "payload_bytes")]
    )
    response = F.col("record_type") == "response"
    shared = (
        headers.where(~response | (F.col("payload_bytes") >= min_bytes))
        .groupBy(F.col("payload_digest").alias("digest"))
        .agg(F.min(F.when(response, first)).alias("original"), F.count("*").alias("records"))
        .where(F.col("original").isNotNull() & (F.col("records") > 1))
        .select("digest", "original")
    )
    shared = stored(shared, "warc_originals")
    same = (F.col("file") == F.col("original.file")) & (F.col("at") == F.col("original.at"))
    joined = headers.join(shared, F.col("payload_digest") == F.col("digest"), "left").drop("digest")
    small = response & (F.col("payload_bytes") < min_bytes)
    return joined.withColumn("original", F.when(~F.coalesce(same, F.lit(False)) & ~small, F.col("original")))


def _new_id(file: str, at: int) -> str:
    return str(uuid.UUID(bytes=hashlib.md5(f"{file}:{at}".encode()).digest()))


def write_deduplicated(records: DataFrame, folder: str, cut_bytes: int = CUT_BYTES) -> DataFrame:
    """The records of `resolved` in new archives with fresh headers: those with an original become revisit records that
    refer to it. A task takes the records of one archive, whose size is bounded. Returns the files."""
    wanted = records.select(
        "file", "at", "size", "record_type", "page_id", "url", "date", "payload_digest",
        F.col("original.file").alias("original_file"), F.col("original.at").alias("original_at"),
        F.col("original.url").alias("original_url"), F.col("original.date").alias("original_date"),
    )
    wanted = wanted.withColumn("page_id", F.col("page_id").cast("string"))

    def run(table: pa.Table) -> pa.Table:
        archives = _Archives(folder, cut_bytes)
        rows = table.sort_by("at").to_pylist()
        store, path = fs.FileSystem.from_uri(rows[0]["file"])
        with store.open_input_file(path) as source:
            for row in rows:
                new_id = _new_id(row["file"], row["at"])
                common = new_id, row["page_id"], row["url"], row["date"]
                if row["original_file"] is not None:
                    original = {
                        "id": _new_id(row["original_file"], row["original_at"]), "url": row["original_url"], "date": row["original_date"]
                    }
                    archives.add(revisit(*common, row["payload_digest"], original))
                elif row["record_type"] == "revisit":
                    archives.add(revisit(*common, row["payload_digest"], None))
                else:
                    source.seek(row["at"])
                    _, payload = parsed(zlib.decompress(source.read(row["size"]), 31))
                    archives.add(response(*common, payload))
        return pa.Table.from_batches([archives.files()])

    return stored(wanted.groupBy("file").applyInArrow(run, FILES), "warc_files")


def read_pages(files: DataFrame, id_type: str = "bigint") -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to: the archives as read back, each revisit record
    joined to the response it refers to."""
    headers = read_headers(files, id_type)
    revisits = headers.where("record_type = 'revisit'").select("page_id", "payload_digest", "record_type", "refers_to_id")
    originals = headers.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), "payload_bytes", F.col("page_id").alias("refers_to")
    )
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    responses = headers.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast(id_type))
    return responses.select(*names).unionByName(revisits.join(originals, "refers_to_id", "left").select(*names))


def archive(pages: DataFrame, min_bytes: int = 0, cut_bytes: int = CUT_BYTES) -> DataFrame:
    """Pages through raw archives, resolution and deduplicated archives, and back: a row for each page.

    Null html is an empty payload, of which there can be one response like of any other. A null page_id is kept, and is
    the response only where all pages of that payload have none. Repeated rows: one is the response. Pages without a url
    have no target URI. Columns other than page_id, url and html are left out. No pages give no rows.
    """
    folder = f"{shared_folder(pages.sparkSession).rstrip('/')}/llm/warc-{uuid.uuid4().hex}"
    id_type = pages.schema["page_id"].dataType.simpleString()
    raw = read_headers(write_archives(pages, f"{folder}/raw", cut_bytes), id_type)
    return read_pages(write_deduplicated(resolved(raw, min_bytes), f"{folder}/deduplicated", cut_bytes), id_type)
