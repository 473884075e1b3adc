"""WARC archives: write whole-file gzip streams, normalise them, read them back.

``write_monolithic`` makes archives that are one gzip stream each.  The normaliser
inflates such a stream once, rewrites every record as a gzip member of its own and
writes a sidecar index of offsets.  ``read_archives`` seeks by that index.

Files appear under their final names by an atomic rename, and their names depend
on the partition alone, so a task that runs again writes the same file again.
Where the shared folder is not a mounted one, pyarrow's file systems reach it.

A response's block is an HTTP response with the payload; a revisit's is empty and
names its response by URL, date and page.  The pages have no time of their own, so
all records carry a given one.

Defined cases: a null payload is empty; a very long one is one record, held whole; a
null url becomes ``urn:page:`` and the page_id; payloads below ``MIN_DEDUP`` bytes are
always responses; rows with the least page_id of an equal payload are responses
(all of them, if that id repeats), and a null page_id counts as larger than any;
if all are null they are responses; repeated rows are records of their own, each with
an id of its own; an empty table gives an empty result; extra columns of any name and
type are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import scratch

MIN_DEDUP = 100
LEVEL = 3
INFLATE = 1 << 18
#: Payload bytes after which a task begins another archive.
ARCHIVE_BYTES = 1 << 30
#: WARC-Date of the records.
DATE = "1970-01-01T00:00:00Z"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def decided(pages: DataFrame) -> DataFrame:
    """Pages with digest, size and, for revisits, the page they refer to.

    Digests are aggregated first, so copies meet as one row for each task.  Only
    digests that repeat go back to the pages; that join's hot keys are split by
    adaptive execution (its large side may be split, its small side is unique).
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url"), F.lit("")).alias("url"), F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"))
    p = p.withColumn("digest", F.sha2("payload", 256))
    long = p.where(F.octet_length("payload") >= MIN_DEDUP).select("digest", "page_id")
    least = long.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))
    return p.join(least.drop("n"), "digest", "left").select("page_id", "url", "payload", "digest", F.when(later, F.col("first")).alias("refers_to"))


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def target_uri(url: str, page_id: int | None) -> str:
    """The url with blanks and control characters escaped, or a name of the page where there is none."""
    return _UNSAFE.sub(lambda m: f"%{ord(m.group()):02X}", url) or f"urn:page:{'' if page_id is None else page_id}"


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, record_id: str, date: str = DATE) -> bytes:
    """One WARC record: a response, or a revisit if it refers to a page."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = b"" if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:uuid:{record_id}>", f"WARC-Date: {date}", f"WARC-Target-URI: {target_uri(url, page_id)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To-Date: {date}", f"X-Refers-To-Page-ID: {refers_to}"]
    return ("\r\n".join(lines) + f"\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"


class Reader:
    """Records of an inflated stream; holds one record at a time."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.buf = pieces, bytearray()

    def _fill(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        self.buf += piece
        return True

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
        """(header fields, body, the whole record as it stands)."""
        while self.buf or self._fill():
            seen = 0
            while (end := self.buf.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
                seen = len(self.buf)
                if not self._fill():
                    raise ValueError("a record's header is cut off")
            fields = dict(line.split(": ", 1) for line in bytes(self.buf[:end]).decode().split("\r\n")[1:])
            whole = end + 4 + int(fields["Content-Length"]) + 4
            while len(self.buf) < whole:
                if not self._fill():
                    raise ValueError("a record's body is cut off")
            raw = bytes(self.buf[:whole])
            del self.buf[:whole]
            yield fields, raw[end + 4 : whole - 4], raw


def inflate(source) -> Iterator[bytes]:
    """The text of a gzip file of one or several members, in bounded pieces."""
    z, left = zlib.decompressobj(31), b""
    while True:
        left = left or source.read(INFLATE)
        if not left:
            break
        piece = z.decompress(left, INFLATE * 4)
        left = z.unconsumed_tail
        if z.eof:
            left, z = z.unused_data, zlib.decompressobj(31)
        if piece:
            yield piece


def write_monolithic(decided_pages: DataFrame, folder: str, date: str = DATE, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives of some ``archive_bytes`` of payloads, each a single gzip stream; returns (path, records).

    A record's id follows from its archive and place, so a task that runs again gives it again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        store, base = _open(folder)
        space = uuid.uuid5(uuid.NAMESPACE_URL, folder)
        made, n, held, out, z = 0, 0, 0, None, None

        def close() -> pa.RecordBatch:
            out.write(z.flush())
            out.close()
            store.move(temp, name)
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name.rpartition('/')[2]}"], "records": [n]})

        for b in batches:
            for page_id, url, payload, digest, refers_to in zip(*(b.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to")), strict=True):
                if out is not None and held >= archive_bytes:
                    yield close()
                    made, n, held, out = made + 1, 0, 0, None
                if out is None:
                    store.create_dir(base)
                    stem = f"{task.partitionId():06d}-{made:03d}"
                    name, temp, z = f"{base}/{stem}.warc.gz", f"{base}/.{stem}-{task.taskAttemptId()}", zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    out = store.open_output_stream(temp, compression=None)
                body = payload.as_py()
                out.write(z.compress(record(page_id.as_py(), url.as_py(), body, digest.as_py(), refers_to.as_py(), str(uuid.uuid5(space, f"{stem}/{n}")), date)))
                n, held = n + 1, held + len(body)
        if out is not None:
            yield close()

    return decided_pages.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(run, "path string, records long")


def normalise_file(path: str, tag: str, drop: bool = False) -> tuple[str, int]:
    """Rewrite one archive record by record, with its sidecar index; returns the new path and the records."""
    store, name = _open(path)
    stem = name.removesuffix(".warc.gz")
    target, index = f"{stem}.members.warc.gz", f"{stem}.members.idx"
    at = n = 0
    with store.open_input_stream(name, compression=None) as source, store.open_output_stream(f"{target}.{tag}", compression=None) as out, store.open_output_stream(f"{index}.{tag}", compression=None) as idx:
        for fields, _, raw in Reader(inflate(source)):
            z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            member = z.compress(raw) + z.flush()
            out.write(member)
            entry = {"offset": at, "length": len(member), "id": fields["WARC-Record-ID"], "type": fields["WARC-Type"], "date": fields["WARC-Date"], "uri": fields["WARC-Target-URI"]}
            idx.write((json.dumps(entry) + "\n").encode())
            at, n = at + len(member), n + 1
    store.move(f"{target}.{tag}", target)
    store.move(f"{index}.{tag}", index)
    return path.removesuffix(".warc.gz") + ".members.warc.gz", n


def normalise(archives: DataFrame) -> DataFrame:
    """(path) of archives -> (path, records) of their normalised forms, a task for each archive or few."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tag = f"tmp{TaskContext.get().taskAttemptId()}"
        for b in batches:
            for path in b.column("path").to_pylist():
                new, n = normalise_file(path, tag)
                yield pa.RecordBatch.from_pydict({"path": [new], "records": [n]})

    return archives.select("path").mapInArrow(run, "path string, records long")


def _number(digits: str | None) -> int | None:
    return None if digits is None else int(digits)


def read_archives(archives: DataFrame) -> DataFrame:
    """Every record of normalised archives, found by index; a response's digest is computed anew and must agree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column("path").to_pylist():
                store, name = _open(path)
                rows = []
                with store.open_input_stream(name.removesuffix(".warc.gz") + ".idx") as s:
                    entries = s.read().decode().splitlines()
                with store.open_input_file(name) as f:
                    for e in map(json.loads, entries):
                        f.seek(e["offset"])
                        raw = zlib.decompress(f.read(e["length"]), 31)
                        fields, body, _ = next(iter(Reader(iter([raw]))))
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        size = int(fields["X-Payload-Length"])
                        payload = body.partition(b"\r\n\r\n")[2]
                        if e["type"] == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
                            raise ValueError(f"{path} at {e['offset']}: the payload doesn't fit its digest")
                        rows.append((_number(fields.get("X-Page-ID")), size, digest, e["type"], _number(fields.get("X-Refers-To-Page-ID"))))
                        if len(rows) == 5000:
                            yield _batch(rows)
                            rows = []
                if rows:
                    yield _batch(rows)

    return archives.select("path").mapInArrow(run, RECORDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def _settle_paths(spark: SparkSession, paths: DataFrame, at: str) -> DataFrame:
    """Write the list of archives, run what makes them, and deal the list a path to a task."""
    paths.write.parquet(at)
    kept = spark.read.parquet(at)
    n = kept.count()
    return kept.repartitionByRange(max(1, n), "path")


def archive(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write, normalise; returns the list of normalised archives."""
    spark = pages.sparkSession
    folder = folder or scratch(spark, "warc")
    whole = _settle_paths(spark, write_monolithic(decided(pages), f"{folder}/archives"), f"{folder}/whole")
    new = _settle_paths(spark, normalise(whole), f"{folder}/members")
    drop_monolithic(spark, f"{folder}/archives")
    return new


def drop_monolithic(spark: SparkSession, folder: str) -> None:
    """Delete the inputs of the normaliser, once all their successors are listed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.exists(path):
        for f in store.listStatus(path):
            name = f.getPath().getName()
            if name.endswith(".warc.gz") and not name.endswith(".members.warc.gz"):
                store.delete(f.getPath(), False)
