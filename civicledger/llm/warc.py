"""WARC archives: write, normalise monolithic gzip, index, read back.

``write_archives`` turns pages into WARC records and writes them with Spark's
text sink as whole-file gzip streams (the record end is the line separator).
``normalise`` inflates each such stream once, rewrites every record as a gzip
member of its own and writes a sidecar index of offsets beside the archive.
``read_records`` opens the archives at the index's offsets and checks digests.

Every file goes to a folder that all executors share. The normaliser writes to
a name of its attempt and renames it when complete, so a task that runs again
replaces its file with the same bytes.

Defined cases: a null payload is empty; a null url leaves its header out, line
breaks in a url become blanks; a null page id leaves the id header out (such a
page is a response unless a page with an id has the same payload); pages with
equal ids are records of their own; of equal payloads every row that carries
the smallest id is a response; an empty table gives no record; a truncated
archive raises an error that names it.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch

END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "archive string, offset bigint, length bigint, record_id string, record_type string, payload_digest string"
RECORD = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
          "refers_to bigint, payload binary")


def mark_revisits(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Adds n, digest and first: the smallest id with the same payload, for pages that only repeat it."""
    keyed = pages.withColumn("n", F.octet_length("payload").cast("long")).withColumn(
        "digest", F.sha2(F.col("payload").cast("binary"), 256))
    groups = (keyed.where(F.col("n") >= least_bytes).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
              .where("copies > 1 and first is not null").select("digest", "first"))
    # only the large side is split when a digest is hot; the other holds one row per repeated payload
    return keyed.join(groups.hint("shuffle_hash"), "digest", "left").withColumn(
        "first", F.when(F.col("page_id").eqNullSafe(F.col("first")), None).otherwise(F.col("first")))


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def record_text(date: str) -> Column:
    """One WARC record without its end, from page_id, url, payload, n, digest, first."""
    uri = F.regexp_replace(F.col("url"), r"[\r\n\x00]+", " ")
    record_id = F.concat(F.lit("<urn:uuid:"), F.substring(F.md5(F.concat_ws(
        "|", F.col("page_id").cast("string"), F.col("digest"), F.col("url"))), 1, 32), F.lit(">"))
    revisit = F.col("first").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("n").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    return F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", record_id), _line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", uri),
        _line("WARC-Page-ID", F.col("page_id").cast("string")),
        _line("WARC-Refers-To-Page-ID", F.col("first").cast("string")),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 100, records_per_file: int = 5000,
                   date: str = "2024-01-01T00:00:00Z") -> None:
    """Whole-file gzip archives of at most ``records_per_file`` records under ``folder``."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    (mark_revisits(pages, least_bytes).select(record_text(date).alias("value"))
     .write.option("compression", "gzip").option("lineSep", END).option("maxRecordsPerFile", records_per_file)
     .text(folder))


def _filesystem(uri: str):
    """pyarrow's view of a folder on shared storage."""
    from pyarrow import fs
    scheme, sep, rest = uri.partition(":")
    if not sep or scheme.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + rest)


def inflate(data, name: str, step: int = 1 << 18):
    """The bytes of a gzip file in blocks, whatever its members."""
    view, at, engine, fed = memoryview(data), 0, zlib.decompressobj(31), False
    while at < len(view) or engine.unused_data:
        if engine.eof:
            rest = engine.unused_data
            engine, fed = zlib.decompressobj(31), False
            if rest:
                fed = True
                yield engine.decompress(rest)
                continue
        block = view[at:at + step]
        at += len(block)
        if block:
            fed = True
            yield engine.decompress(block)
    if fed and not engine.eof:
        raise ValueError(f"{name}: the gzip stream is truncated")


def records(blocks, name: str):
    """Whole WARC records, end included, of a stream of blocks."""
    held = bytearray()
    head = -1
    need = -1
    for block in blocks:
        held += block
        while True:
            if need < 0:
                head = held.find(b"\r\n\r\n")
                if head < 0:
                    break
                fields = header(bytes(held[:head]))
                need = head + 4 + int(fields["content-length"]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = -1
    if held:
        raise ValueError(f"{name}: the last record is truncated")


def header(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def normalise(spark: SparkSession, source: str, target: str, level: int = 6) -> DataFrame:
    """Rewrites every ``*.gz`` archive of ``source`` record by record under ``target``; returns the index (lazy)."""

    def rewrite(batches):
        fs, root = _filesystem(target)
        fs.create_dir(root, recursive=True)
        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                name = path.rsplit("/", 1)[-1].removesuffix(".gz").removesuffix(".txt") + ".warc.gz"
                own = f"{root}/_{uuid.uuid4().hex}"
                rows, at = [], 0
                with fs.open_output_stream(own) as out:
                    for rec in records(inflate(content.as_buffer(), path), path):
                        f = header(rec[:rec.find(b"\r\n\r\n")])
                        engine = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = engine.compress(rec) + engine.flush()
                        out.write(member)
                        rows.append((name, at, len(member), f.get("warc-record-id"), f.get("warc-type"),
                                     f.get("warc-payload-digest", "").removeprefix("sha256:")))
                        at += len(member)
                with fs.open_output_stream(own + ".idx") as out:
                    for r in rows:
                        out.write((json.dumps(dict(zip(FIELDS, r, strict=True))) + "\n").encode())
                fs.move(own, f"{root}/{name}")
                fs.move(own + ".idx", f"{root}/{name}.idx")
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(
                    (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()))], list(FIELDS))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path", "content")
    return files.mapInArrow(rewrite, INDEX)


FIELDS = ("archive", "offset", "length", "record_id", "record_type", "payload_digest")


def read_index(spark: SparkSession, target: str) -> DataFrame:
    """The sidecar indexes of a folder of normalised archives."""
    return spark.read.schema(INDEX).option("pathGlobFilter", "*.idx").json(target)


def read_records(index: DataFrame, target: str, with_payload: bool = True) -> DataFrame:
    """One row per record that ``index`` names; payload lengths and digests are checked against the bytes read."""

    def read(batches):
        fs, root = _filesystem(target)
        name, file = None, None
        for b in batches:
            out = []
            for archive, offset, length in zip(*(b.column(c).to_pylist() for c in ("archive", "offset", "length")),
                                               strict=True):
                if archive != name:
                    if file is not None:
                        file.close()
                    name, file = archive, fs.open_input_file(f"{root}/{archive}")
                file.seek(offset)
                rec = zlib.decompress(file.read(length), 31)
                head = rec.find(b"\r\n\r\n")
                f = header(rec[:head])
                http, _, payload = rec[head + 4:-4].partition(b"\r\n\r\n")
                said = f["warc-payload-digest"].removeprefix("sha256:")
                n = int(http.rsplit(b"Content-Length: ", 1)[1])
                if f["warc-type"] == "response" and (len(payload) != n or hashlib.sha256(payload).hexdigest() != said):
                    raise ValueError(f"{archive} at {offset}: the payload is not what its header says")
                whole = lambda k: int(f[k]) if k in f else None  # noqa: B023, E731
                out.append((whole("warc-page-id"), f.get("warc-target-uri"), n, said, f["warc-type"],
                            whole("warc-refers-to-page-id"), payload if with_payload else None))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(
                (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()))],
                ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])
        if file is not None:
            file.close()

    # an archive's records lie together in the index: it is read front to back
    return index.select("archive", "offset", "length").mapInArrow(read, RECORD)


def archive_pages(spark: SparkSession, pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """Pages through monolithic archives and the normaliser, read back: page_id, payload_bytes, ... per page."""
    scratch = Scratch(spark, "warc")
    write_archives(pages, scratch.path("monolithic"), least_bytes)
    index = scratch.stage(normalise(spark, scratch.path("monolithic"), scratch.path("archives")), "index")
    scratch.drop("monolithic")
    return read_records(index, scratch.path("archives"), with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
