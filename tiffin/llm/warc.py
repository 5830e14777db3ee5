"""A deterministic sharded WARC writer, and the reader of its archives.

Records are sorted by id in ranges, one task a range. A task rolls to a new file when the compressed size of the current one
passes a limit. Every record is a gzip member of its own with a fixed header order, an id derived from its row and a given date, so
a task that runs again writes the same bytes. A file is written under a temporary name and renamed when it is complete; the
manifest, written after all files, is what commits the set: readers follow the manifest and never list folders.

Files are written and read through ``pyarrow.fs`` under the shared folder. Null payloads count as empty. Records with equal payloads of at least
``min_bytes`` bytes are stored once: the one with the smallest id is the response, the others are revisits that refer to it.
Rows that repeat an id with an equal payload are all responses if that id is the smallest; rows without an id come last and are
responses of their own. An empty table gives an empty manifest.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm.store import new_folder

VERSION = "WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "part int, seq int, file string, records long, bytes long, sha256 string"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(row_id: object, url: str, payload: bytes, date: str, refers_to: object, own_digest: str, size: int) -> bytes:
    """The bytes of one record. A revisit carries the digest and the size of the payload that it leaves out."""
    kind = "response" if refers_to is None else "revisit"
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{row_id}|{url}|{own_digest}")
    head = [
        VERSION,
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{name}>",
        f"WARC-Date: {date}",
        "WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url),
        "Content-Type: text/html; charset=utf-8",
        f"WARC-Payload-Digest: sha1:{own_digest}",
        f"WARC-Block-Digest: sha1:{digest(payload)}",
        f"X-Row: {'' if row_id is None else row_id}",
        f"X-Payload-Length: {size}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT}", f"X-Refers-To-Row: {refers_to}"]
    head.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def mark_revisits(pages: DataFrame, row_id: str = "page_id", payload: str = "html", min_bytes: int = 0) -> DataFrame:
    """(row_id, sha, refers_to) of the rows that are revisits. Digests are summed up before the shuffle, so a payload that a third
    of all rows share is one row for each task; the join back to the rows can be split."""
    body = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(row_id).alias("row_id"), F.sha1(body).alias("sha"), F.octet_length(body).cast("long").alias("size"))
    first = rows.filter(F.col("size") >= min_bytes).groupBy("sha").agg(F.min("row_id").alias("first"), F.count("*").alias("n"))
    joined = rows.join(first.filter("n > 1").drop("n"), "sha")
    later = (F.col("row_id") != F.col("first")) & (F.col("size") >= min_bytes)
    return joined.filter(later).select("row_id", "sha", F.col("first").alias("refers_to")).distinct()


def write(
    pages: DataFrame,
    row_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_bytes: int = 0,
    file_bytes: int = 64 << 20,
    date: str = "2024-01-01T00:00:00Z",
    folder: str | None = None,
) -> DataFrame:
    """Writes all rows as archives under ``folder`` (a new one in the shared folder if not given); returns the manifest's rows."""
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    rows = pages.select(
        F.col(row_id).alias("row_id"), F.coalesce(F.col(url), F.lit("")).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("payload")
    ).withColumn("sha", F.sha1(F.col("payload").cast("binary")))
    # What a row refers to travels as a row of its own in front of it, so that the payloads are dealt once, by ranges.
    marks = mark_revisits(pages, row_id, payload, min_bytes).withColumn("_row", F.lit(1))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("row_id").asc_nulls_last(), F.col("_row").desc(), "url", "payload"]
    full = rows.withColumn("_row", F.lit(0)).unionByName(marks, allowMissingColumns=True)
    ordered = full.repartitionByRange(parts, F.col("row_id").asc_nulls_last()).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        store, root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        store.create_dir(root, recursive=True)
        held, size, count, done = None, 0, 0, []
        sha, marked, named = None, None, {}

        def close() -> None:
            nonlocal held
            held.close()
            name = f"part-{part:06d}-{len(done):05d}.warc.gz"
            store.move(f"{root}/{temporary}", f"{root}/{name}")
            done.append((part, len(done), name, count, size, sha.hexdigest()))
            held = None

        for batch in batches:
            columns = (batch.column(c) for c in ("row_id", "url", "payload", "refers_to", "sha", "_row"))
            for own, address, text, refers, hexed, mark in zip(*columns, strict=True):
                if own != marked:
                    marked, named = own, {}
                if mark.as_py():
                    named[hexed.as_py()] = refers.as_py()
                    continue
                if held is None:
                    temporary = f"_temporary-{part:06d}-{len(done):05d}-{attempt}"
                    held, size, count, sha = store.open_output_stream(f"{root}/{temporary}"), 0, 0, hashlib.sha256()
                body = text.as_py().encode()
                to = named.get(hexed.as_py())
                raw = record(own.as_py(), address.as_py(), body if to is None else b"", date, to, digest(body), len(body))
                member = gzip.compress(raw, 6, mtime=0)
                held.write(member)
                sha.update(member)
                size, count = size + len(member), count + 1
                if size >= file_bytes:
                    close()
        if held is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*done, strict=True)], schema=_manifest_schema())

    # One row for each archive, in one file.
    ordered.mapInArrow(run, MANIFEST).repartition(1).write.parquet(f"{folder}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest").withColumn("folder", F.lit(folder))


def _manifest_schema() -> pa.Schema:
    return pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a file of gzip members."""
    unzip, raw = zlib.decompressobj(31), b""
    while piece := stream.read(1 << 20):
        while piece:
            raw += unzip.decompress(piece)
            piece = unzip.unused_data
            if not unzip.eof:
                break
            head, _, rest = raw.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            if lines[0] != VERSION:
                raise ValueError(f"not a WARC record: {lines[0][:40]}")
            named = dict(line.split(": ", 1) for line in lines[1:])
            size = int(named["Content-Length"])
            if rest[size:] != b"\r\n\r\n":
                raise ValueError("a record's length disagrees with its header")
            yield named, rest[:size]
            unzip, raw = zlib.decompressobj(31), b""
    if raw:
        raise ValueError("the last record is cut off")


def read(spark: SparkSession, manifest: DataFrame, id_type: str = "long") -> DataFrame:
    """(row_id, url, record_type, refers_to, payload_bytes, payload_digest, block) of every record of the files in a manifest.

    Fails if a file's digest, a block's digest or the number of records disagrees with what was committed.
    """
    files = manifest.select("folder", "file", "records", "sha256")
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    schema = "row_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, block binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "block"]
        kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

        def packed(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

        for batch in batches:
            for entry in batch.to_pylist():
                folder = entry["folder"]
                store, root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
                seen, out, held = 0, [], 0
                with store.open_input_stream(f"{root}/{entry['file']}", compression=None) as stream:
                    checked = _Checked(stream)
                    for head, block in records(checked):
                        kind, own = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
                        if digest(block) != head["WARC-Block-Digest"].removeprefix("sha1:") or kind == "response" and digest(block) != own:
                            raise ValueError(f"damaged record {head['WARC-Record-ID']} in {entry['file']}")
                        out.append((head["X-Row"] or None, head["WARC-Target-URI"], kind, head.get("X-Refers-To-Row"), int(head["X-Payload-Length"]), own, block))
                        seen, held = seen + 1, held + len(block)
                        if held > 8 << 20:
                            yield packed(out)
                            out, held = [], 0
                    if seen != entry["records"] or checked.sha.hexdigest() != entry["sha256"]:
                        raise ValueError(f"{entry['file']} is not what the manifest says")
                if out:
                    yield packed(out)

    done = files.repartition(n, "file").mapInArrow(run, schema)
    return done.withColumns({c: F.col(c).cast(id_type) for c in ("row_id", "refers_to")})


class _Checked:
    """A stream that hashes what is read from it."""

    def __init__(self, stream):
        self.stream, self.sha = stream, hashlib.sha256()

    def read(self, n: int) -> bytes:
        piece = self.stream.read(n)
        self.sha.update(piece)
        return piece
