import base64
import gzip
import hashlib
import uuid

from pyarrow import fs
from pyspark.sql import functions as F

from quaystar.llm import warc
from quaystar.session import shared_folder

PAGES = [
    (3, "http://a/3", "<p>one</p>"),
    (1, "http://a/1", "<p>one</p>"),
    (2, "http://a/2\r\nInjected: x", "<p>two é😀</p>\r\n\r\nWARC/1.1\r\n\r\n"),
    (7, None, "<p>one</p>"),
    (5, "http://a/5", None),
    (6, "http://a/6", ""),
    (None, "http://a/n", "<p>one</p>"),
    (None, "http://a/m", "only without id"),
    (8, "http://a/8", "x" * 300_000),
    (9, "http://a/9", "twin"),
    (9, "http://a/9", "twin"),
]


def pages(spark):
    return spark.createDataFrame([(*p, "extra") for p in PAGES], "page_id long, url string, html string, record_type string").repartition(3)


def expected(min_bytes=0):
    rows, seen = [], {}
    for page_id, _, html in sorted(PAGES, key=lambda p: (p[0] is None, p[0] or 0)):
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        first = seen.setdefault(digest, page_id) if digest in seen or len(payload) >= min_bytes else None
        repeated = len(payload) >= min_bytes and any(r[2] == digest for r in rows)
        rows.append((page_id, len(payload), digest, "revisit" if repeated else "response", first if repeated else None))
    return sorted(rows, key=str)


def test_round_trip(spark):
    found = warc.archive(pages(spark), cut_bytes=200)
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, found.collect()), key=str) == expected()
    assert sorted(map(tuple, warc.archive(pages(spark), min_bytes=5).collect()), key=str) == expected(5)
    assert warc.archive(pages(spark).limit(0)).count() == 0


def test_records_are_standard_gzip_members(spark):
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    files = warc.write_archives(pages(spark).where("page_id = 2"), folder)
    store, path = fs.FileSystem.from_uri(files.first().file)
    with store.open_input_stream(path, compression=None) as stream:
        record = gzip.decompress(stream.read())
    head, _, block = record.partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and b"\r\nInjected" not in head
    assert block.endswith(b"\r\n\r\n") and f"Content-Length: {len(block) - 4}".encode() in head
    assert warc.parsed(record)[1] == PAGES[2][2].encode()


def test_revisits_that_were_there_before(spark):
    """A revisit record of an input archive follows its original; one without an original stays as it is."""
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    old = warc.read_headers(warc.write_deduplicated(warc.resolved(warc.read_headers(warc.write_archives(pages(spark), f"{folder}/a"))), f"{folder}/b"))
    again = warc.read_pages(warc.write_deduplicated(warc.resolved(old), f"{folder}/c"))
    assert sorted(map(tuple, again.collect()), key=str) == expected()
    lone = old.where((F.col("record_type") == "revisit"))
    left = warc.read_pages(warc.write_deduplicated(warc.resolved(lone), f"{folder}/d")).collect()
    assert {row.record_type for row in left} == {"revisit"} and {row.refers_to for row in left} == {None}
