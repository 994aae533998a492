"""WARC archives written per record as gzip members, and a reader that splits them anywhere.

Writing: equal payloads are found by their SHA-256; the record of the smallest page_id is a response, the others revisit it
and carry no payload. Only (page_id, url, digest, length) is shuffled for that; html moves once, for the responses. Every task
writes one archive under a name of its own and renames it, so a repeated task leaves one file.

Reading: a task gets (archive, from, to), looks for the gzip magic from `from` on, takes a place for a member if it
inflates to a WARC header, and owns the records that start before `to`; the last of them is read beyond `to`. Where archives are
cut does not matter. Payloads are UTF-8 text, which cannot contain the magic bytes. Within a range every record must begin where the one
before it ends, and so must the first one after it: a record whose header, content or end is damaged ends the job with
DamagedArchive and its place, whichever task finds it, and is never passed over.

Null html is an empty payload, a null url leaves the target out. Rows that repeat the smallest page_id and its payload are
responses, too. Only page_id, url and html are read. Archives go to any file system that pyarrow can open by its URI.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as filesystems
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.llm.common import in_batches, steps, table, to_bytes
from freightlens.session import Workspace

MAGIC = b"\x1f\x8b\x08"
SPLIT = 8 << 20
LOOK = 1 << 16
WRITTEN_AT = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target string, at long"


def opened(uri: str) -> tuple[filesystems.FileSystem, str]:
    return filesystems.FileSystem.from_uri(uri)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _page(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes | None, refers_to: int | None, size: int, sha1: str) -> bytes:
    """One gzip member. A payload of None makes a revisit record, whose HTTP header tells the full payload's length."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if payload is None else 'response'}", f"WARC-Record-ID: {_page(page_id)}", f"WARC-Date: {WRITTEN_AT}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url))
    if payload is None:
        head += [f"WARC-Refers-To: {_page(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{sha1}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def write_archives(ws: Workspace, pages: DataFrame, folder: str) -> DataFrame:
    """Archives below `folder`; (path, bytes, records) of each."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    pages = pages.select(F.col("page_id").cast("long"), "url", payload.alias("html"), F.sha2(payload, 256).alias("sha"))
    sha1 = F.sha1(F.col("html").cast("binary")).alias("sha1")
    narrow = ws.write(pages.select("page_id", "url", "sha", F.octet_length("html").cast("long").alias("size"), sha1), ws.fresh("digests"))
    first = narrow.groupBy("sha").agg(F.min("page_id").alias("first"))
    responses = pages.join(first.withColumnRenamed("sha", "its"), F.col("page_id").eqNullSafe(F.col("first")) & (F.col("sha") == F.col("its")))
    responses = responses.select("page_id", "url", "html", F.lit(None).cast("long").alias("refers_to"), F.lit(None).cast("long").alias("size"), F.lit(None).cast("string").alias("sha1"))
    revisits = narrow.join(first, "sha").where(~F.col("page_id").eqNullSafe(F.col("first")))
    revisits = revisits.select("page_id", "url", F.lit(None).cast("string").alias("html"), F.col("first").alias("refers_to"), "size", "sha1")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        system, root = opened(folder)
        own, final = (f"{root}/{n}" for n in (f".try-{context.taskAttemptId()}", f"part-{context.partitionId():05d}.warc.gz"))
        out, written, records = None, 0, 0
        for batch in batches:
            for page_id, url, html, refers_to, size, sha1 in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    system.create_dir(root)
                    out = system.open_output_stream(own)
                if html is None:
                    member = record(page_id, url, None, refers_to, size, base64.b32encode(bytes.fromhex(sha1)).decode())
                else:
                    data = to_bytes(html)
                    member = record(page_id, url, data, None, len(data), digest(data))
                out.write(member)
                written += len(member)
                records += 1
        if out is not None:
            out.close()
            system.move(own, final)
            uri = folder.rstrip("/") + "/" + final.rsplit("/", 1)[1]
            yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([written]), pa.array([records])], ["path", "bytes", "records"])

    return ws.write(in_batches(responses.unionByName(revisits), work, "path string, bytes long, records long"), ws.fresh("archives"))


def _inflated(source, at: int, size: int, most: int | None = None) -> tuple[bytes, int]:
    """Content of the member at `at` (its first bytes, if `most` is given) and the place behind it."""
    unpacker, out, got, place = zlib.decompressobj(31), [], 0, at
    while not unpacker.eof:
        data = source.read_at(min(LOOK, size - place), place)
        if not data:
            raise zlib.error("the archive ends inside a member")
        place += len(data)
        out.append(unpacker.decompress(data, most or 0))
        got += len(out[-1])
        if most and got >= most:
            break
    return b"".join(out), place - len(unpacker.unused_data)


class DamagedArchive(ValueError):
    """A place where a record must begin, or go on, holds something else."""


def _begins(source, at: int, size: int) -> bool:
    """Whether a record begins at a place: gzip magic, and content that begins like a WARC header."""
    if source.read_at(min(len(MAGIC), size - at), at) != MAGIC:
        return False
    try:
        return _inflated(source, at, size, 8)[0].startswith(b"WARC/1.")
    except zlib.error:
        return False


def records_of(source, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(place, content) of the records that start in [start, end) of an archive opened for random access.

    In front of the first record, magic that leads to no WARC header is chance. From then on every record begins where the one before it ends,
    the one after the range included; anything else there, and a record that does not unpack, raises DamagedArchive.
    """
    size, at, due = source.size(), start, start == 0
    while at < min(end, size):
        if not due:
            data = source.read_at(min(LOOK, size - at), at)
            found = data.find(MAGIC)
            if found < 0:
                at += max(1, len(data) - len(MAGIC) + 1)
                continue
            at += found
            if at >= end:
                return
            if not _begins(source, at, size):
                at += 1
                continue
        elif not _begins(source, at, size):
            raise DamagedArchive(f"no record begins at byte {at}")
        try:
            content, behind = _inflated(source, at, size)
        except zlib.error as error:
            raise DamagedArchive(f"the record at byte {at} is damaged: {error}") from error
        yield at, content
        at, due = behind, True
    if due and at < size and not _begins(source, at, size):
        raise DamagedArchive(f"no record begins at byte {at}")


def parsed(content: bytes) -> tuple:
    """page_id, payload bytes, digest, type, refers_to, target of a record."""
    head, _, block = content.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    http, _, payload = block[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    page, other = (int(m) if (m := fields.get(k, "<urn:page:>")[10:-1]) else None for k in ("WARC-Record-ID", "WARC-Refers-To"))
    if fields["WARC-Type"] == "response":
        size, sha1 = len(payload), digest(payload)
        if f"sha1:{sha1}" != fields["WARC-Payload-Digest"]:
            raise ValueError(f"page {page}: payload and digest differ")
    else:
        size = int(re.search(rb"Content-Length: (\d+)", http).group(1))
        sha1 = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    return page, size, sha1, fields["WARC-Type"], other, fields.get("WARC-Target-URI")


def read_archives(archives: DataFrame, split: int = SPLIT) -> DataFrame:
    """Records of the archives (path, bytes), read in ranges of `split` bytes."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split).cast("long")))
    tasks = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = archives.select("path", starts.alias("from")).repartition(tasks, "path", "from")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in READ.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns)):
                system, name = opened(path)
                with system.open_input_file(name) as source:
                    rows = [(*parsed(content), at) for at, content in records_of(source, start, start + split)]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    return in_batches(ranges, work, READ)


def op6_splittable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = steps(spark)
    archives = write_archives(ws, table(spark, sf_dir, "pages", "page_id", "url", "html"), ws.path("warc"))
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
