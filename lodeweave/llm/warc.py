"""WARC archives: written by Spark's own writer, read back, and their revisits resolved.

An archive is a file of gzip members, one for each record, so it can be read from any record on. Records are made
in Python and written by Spark's text writer, which passes bytes through as they are; the separator that it puts behind
each row is an empty gzip member, which readers skip. So archives go wherever Spark can write. They are cut at
ARCHIVE bytes, so that one fits in memory when it is read back as a whole.

Resolving: the headers of all records are shuffled by payload digest; the smallest page of a digest is the original.
Other records of at least `least` payload bytes are revisits, and are joined to their original for the headers that
refer to it; then all are written again with fresh headers, responses with their payload and revisits without.
Digests of very many records are few (at most 1 / HOT_SHARE of them have that share of all records or more) and are joined by
broadcast; no other digest has more than that share.

Cases: a null html is an empty payload; null urls get a name made from the page's number; rows that repeat a page_id
are separate records, of which one that is not the response revisits its own page (ties go by the place in the archives); a null page_id comes
last in the order and stays null; payloads of any bytes and sizes; an empty table gives an empty archive and result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeweave.llm.common import read_table, scratch_path, small_batches, stored

ARCHIVE = 32 << 20
LEAST = 0
HOT_SHARE = 1 / 512
LEVEL = 6
_END = gzip.compress(b"", mtime=0)
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = "archive string, record binary"
_READ = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, refers_uri string, record_id string, archive string, place long, member binary"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(url: str) -> str:
    return "".join(c if " " < c != "\x7f" else f"%{ord(c):02X}" for c in url)


def record(kind: str, page: int | None, url: str, payload: bytes, sha: str, size: int, number: str, refers: tuple[int | None, str, str] | None = None) -> bytes:
    """One record, as a gzip member. A revisit's block is the response's head alone."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    if kind == "response":
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(_NAMES, number)}>", f"WARC-Date: {_DATE}", f"WARC-Target-URI: {_clean(url)}", f"WARC-Payload-Digest: sha1:{sha}"]
    if page is not None:
        head.append(f"X-Page-ID: {page}")
    head.append(f"X-Payload-Length: {size}")
    if refers:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {refers[2]}", f"WARC-Refers-To-Target-URI: {_clean(refers[1])}", f"WARC-Refers-To-Date: {_DATE}"]
        if refers[0] is not None:
            head.append(f"X-Refers-To-Page: {refers[0]}")
    head += [f"WARC-Block-Digest: sha1:{digest(block)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(head).encode() + block + b"\r\n\r\n", LEVEL, mtime=0)


class _Archives:
    """Names of archives within a task, so that none holds much more than ARCHIVE bytes."""

    def __init__(self, tag: str, most: int):
        self.task, self.tag, self.most, self.number, self.size = TaskContext.get().partitionId(), tag, most, 0, 0

    def name(self, size: int) -> str:
        if self.size and self.size + size > self.most:
            self.number, self.size = self.number + 1, 0
        self.size += size
        return f"{self.tag}-{self.task:06d}-{self.number:05d}"


def _write(records: DataFrame, path: str) -> None:
    """records (archive, record) to one file for each archive."""
    records.select("archive", F.col("record").cast("string").alias("value")).write.partitionBy("archive").option("lineSep", _END.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)


def write_pages(pages: DataFrame, path: str, most: int = ARCHIVE) -> None:
    """One response for each of pages (page_id, url, html)."""

    tag = f"pages-{uuid.uuid4().hex[:12]}"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives, count = _Archives(tag, most), 0
        for batch in batches:
            names, records = [], []
            for page, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                payload = (html or "").encode()
                name = url if url else f"urn:page:{page}"
                records.append(record("response", page, name, payload, digest(payload), len(payload), f"{archives.tag}/{archives.task}/{count}"))
                names.append(archives.name(len(records[-1])))
                count += 1
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(records, pa.binary())], ["archive", "record"])

    small_batches(pages.sparkSession)
    _write(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, _RECORD), path)


def _members(raw: bytes) -> Iterator[tuple[bytes, bytes]]:
    """Each gzip member that has contents, and the contents."""
    view, at = memoryview(raw), 0
    while at < len(raw):
        start = at
        engine = zlib.decompressobj(31)
        out = [engine.decompress(view[at : at + 65536])]
        at += min(65536, len(raw) - at)
        while not engine.eof and at < len(raw):
            out.append(engine.decompress(view[at : at + 65536]))
            at += min(65536, len(raw) - at)
        if not engine.eof:
            raise ValueError("the archive ends within a record")
        at -= len(engine.unused_data)
        if data := b"".join(out):
            yield raw[start:at], data


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """A record's headers (lower-case names) and block."""
    end = data.index(b"\r\n\r\n")
    head = data[:end].decode().split("\r\n")
    if not head[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head[1:])}
    return fields, data[end + 4 : end + 4 + int(fields["content-length"])]


def payload_of(block: bytes) -> bytes:
    """What stands behind the HTTP head."""
    return block[block.index(b"\r\n\r\n") + 4 :]


def read_archives(spark: SparkSession, path: str, with_records: bool = False) -> DataFrame:
    """The records of all archives under path; with the gzip members that hold them if asked for. Payload digests are computed, where there is a payload."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "refers_uri", "record_id", "archive", "place", "member"]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        number = lambda x: None if x is None else int(x)
        for batch in batches:
            for i in range(len(batch)):
                rows, size, archive = [], 0, batch.column(0)[i].as_py()
                for place, (member, data) in enumerate(_members(batch.column(1)[i].as_py())):
                    fields, block = parsed(data)
                    sha = fields["warc-payload-digest"].removeprefix("sha1:")
                    n = int(fields["x-payload-length"]) if "x-payload-length" in fields else None
                    if fields["warc-type"] == "response":
                        payload = payload_of(block)
                        n, sha = len(payload), digest(payload)
                    rows.append((number(fields.get("x-page-id")), fields.get("warc-target-uri"), fields["warc-type"], n, sha, number(fields.get("x-refers-to-page")), fields.get("warc-refers-to-target-uri"), fields["warc-record-id"], archive, place, member if with_records else None))
                    size += len(member) if with_records else 100
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(run, _READ)


def resolutions(headers: DataFrame, least: int = LEAST) -> DataFrame:
    """archive, place, and the original's to_page, to_url and to_record, of each record of headers that repeats one.

    Records that were revisits before are joined to the response of their digest like the others.
    """
    last = F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id"), F.col("archive"), F.col("place"), F.col("url"), F.col("record_id"))
    long_enough = F.coalesce(F.col("payload_bytes") >= least, F.lit(True)) | (F.col("record_type") == "revisit")
    firsts = headers.filter(long_enough).groupBy("payload_digest").agg(F.count("*").alias("n"), F.min(F.when(F.col("record_type") == "response", last)).alias("first")).filter("n > 1 AND first IS NOT NULL")
    firsts = stored(firsts, "originals")
    total = firsts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = F.col("n") > F.lit(total * HOT_SHARE)
    some = headers.filter(long_enough).select("archive", "place", "payload_digest")
    hot = some.join(F.broadcast(firsts.filter(often)), "payload_digest")  # 1 / HOT_SHARE rows at most
    rest = some.join(firsts.filter(~often), "payload_digest")
    found = hot.unionByName(rest)
    return found.filter((F.col("archive") != F.col("first.archive")) | (F.col("place") != F.col("first.place"))).select("archive", "place", F.col("first.page_id").alias("to_page"), F.col("first.url").alias("to_url"), F.col("first.record_id").alias("to_record"))


def resolve(spark: SparkSession, source: str, target: str, least: int = LEAST, most: int = ARCHIVE) -> None:
    """The archives under source, written to target with revisits for what repeats an earlier page's payload.

    A revisit whose original is in none of the archives is passed on as it is.
    """
    headers = stored(read_archives(spark, source).drop("member"), "headers")
    revisits = resolutions(headers, least)

    tag = f"resolved-{uuid.uuid4().hex[:12]}"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives, count = _Archives(tag, most), 0
        for batch in batches:
            names, records = [], []
            for page, url, kind, sha, size, member, again, to_page, to_url, to_record in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                refers = (to_page, to_url, to_record) if again else None
                if kind != "response" and not again:
                    records.append(member)
                    names.append(archives.name(len(member)))
                    continue
                payload = b"" if again else payload_of(parsed(gzip.decompress(member))[1])
                records.append(record("revisit" if again else "response", page, url, payload, sha, size or 0, f"{archives.tag}/{archives.task}/{count}", refers))
                names.append(archives.name(len(records[-1])))
                count += 1
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(records, pa.binary())], ["archive", "record"])

    # records move as the gzip members that they are, and revisits without
    full = read_archives(spark, source, with_records=True)
    joined = full.join(revisits.withColumn("again", F.lit(True)), ["archive", "place"], "left")
    again = F.coalesce("again", F.lit(False))
    rows = joined.select("page_id", "url", "record_type", "payload_digest", "payload_bytes", F.when(~again, F.col("member")).alias("member"), again.alias("again"), "to_page", "to_url", "to_record")
    _write(rows.mapInArrow(run, _RECORD), target)


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, done = scratch_path(spark, "warc"), scratch_path(spark, "warc")
    write_pages(read_table(spark, sf_dir, "pages"), raw)
    resolve(spark, raw, done)
    return read_archives(spark, done).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
b AS (SELECT page_id, h, array_to_string(list_transform(string_split(sha1(h), ''), lambda c: right(bin(16 + CAST('0x' || c AS INT)), 4)), '') AS bits FROM p),
f AS (SELECT page_id, strlen(h) AS payload_bytes,
        array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST('0b' || substr(bits, 5 * i + 1, 5) AS INT), 1)), '') AS payload_digest,
        row_number() OVER (PARTITION BY h ORDER BY page_id) AS nth, first(page_id) OVER (PARTITION BY h ORDER BY page_id) AS original FROM b)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN nth > 1 THEN original END AS refers_to FROM f
"""
