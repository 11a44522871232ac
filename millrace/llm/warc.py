"""WARC archives: write, normalise monolithic gzip, index, and read back.

Some crawlers compress a whole archive as one gzip stream, which can only be read from the start.
The normaliser inflates such a file once, cuts it into its records and writes each as a gzip member
of its own, with a sidecar index of member offsets; afterwards every record can be read alone.
Archives are inflated piece by piece, and only one record is held at a time.

Files go to the shared folder under names unique to the attempt, and the rows that a task returns
name the files of the attempt that counted; a lost executor leaves an orphan at worst.

Records with equal payloads of at least ``least_bytes`` become revisits of the one with the smallest
page id. Defined results: null html is an empty payload; payloads below the limit are all responses;
rows that repeat the id of a response are responses too; rows without an id are responses and nobody
revisits them; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import os
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_rows, stored
from millrace.session import Folder, fresh_dir

LEAST_BYTES = 100
ARCHIVE_BYTES = 64 << 20  # of records, before compression, after which a new archive begins
PIECE = 1 << 18
RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload_crc32 long"


# -- files on whatever file system the shared folder has


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a name. Names without scheme are local; stages qualify theirs on the driver first."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def create(uri: str):
    files, path = opened(uri)
    files.create_dir(os.path.dirname(path), recursive=True)
    return files.open_output_stream(path, compression=None)


def own_name(folder: str, suffix: str) -> str:
    return f"{folder}/{uuid.uuid4().hex}{suffix}"


# -- records


def record(page_id: int | None, url: str | None, kind: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit carries headers and no payload."""
    body = payload if kind == "response" else b""
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {json.dumps(url)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(body)}",
    ]
    if refers_to is not None:
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    return fields, rest[: int(fields["Content-Length"])]


def inflate(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The content of a gzip file of any number of members, in pieces of bounded size."""
    unpacker, within = zlib.decompressobj(wbits=31), False
    for piece in pieces:
        while True:
            within = within or bool(piece)
            out = unpacker.decompress(piece, PIECE)
            if out:
                yield out
            piece = unpacker.unconsumed_tail
            if unpacker.eof:
                piece, unpacker, within = unpacker.unused_data, zlib.decompressobj(wbits=31), False
            if not piece and len(out) < PIECE:  # a full piece may leave more inside
                break
    if within:
        raise ValueError("the archive ends within a gzip member")


def records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records cut out of a stream; the length in a record's head says where it ends."""
    held = bytearray()
    need, scanned = -1, 0
    for piece in pieces:
        held += piece
        while True:
            if need < 0:
                end = held.find(b"\r\n\r\n", max(0, scanned - 3))
                if end < 0:
                    scanned = len(held)
                    break
                head = bytes(held[:end]).decode().split("\r\n")
                length = next(int(line.split(":", 1)[1]) for line in head if line.lower().startswith("content-length:"))
                need = end + 4 + length + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need, scanned = -1, 0
    if held:
        raise ValueError("the archive ends within a record")


# -- stages


def classified(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page_id, url, html, refers_to): only ids and digests travel to find the first of each payload."""
    slim = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"))
    keys = slim.filter(F.octet_length("html") >= least_bytes).filter("page_id IS NOT NULL").select("page_id", F.sha2("html", 256).alias("digest"))
    firsts = keys.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).filter("first < last")
    revisits = keys.join(firsts.select("digest", "first"), "digest").filter("page_id > first").groupBy("page_id", "digest").agg(F.min("first").alias("refers_to"))
    page = slim.withColumn("_digest", F.sha2("html", 256)).alias("p")
    match = (F.col("p.page_id") == F.col("r.page_id")) & (F.col("p._digest") == F.col("r.digest"))
    return page.join(revisits.alias("r"), match, "left").select("p.page_id", "p.url", "p.html", "r.refers_to")


def write_monolithic(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives of one gzip stream each; (path, records) per archive."""
    folder = Folder(pages.sparkSession, folder).qualified()

    def run(batches):
        stream = archive = None
        path, held, count = "", 0, 0
        for batch in batches:
            for page_id, url, html, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to")), strict=True):
                payload = (html or "").encode()
                kind = "response" if refers_to is None else "revisit"
                data = record(page_id, url, kind, payload, hashlib.sha256(payload).hexdigest(), refers_to)
                if stream is None:
                    path = own_name(folder, ".warc.gz")
                    stream = create(path)
                    archive = zlib.compressobj(6, wbits=31)  # one gzip stream
                stream.write(archive.compress(data))
                held, count = held + len(data), count + 1
                if held >= archive_bytes:
                    stream.write(archive.flush())
                    stream.close()
                    yield pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([count], pa.int64())})
                    stream, held, count = None, 0, 0
        if stream is not None:
            stream.write(archive.flush())
            stream.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([count], pa.int64())})

    return pages.mapInArrow(run, "path string, records long")


def pieces_of(uri: str, start: int = 0, length: int | None = None) -> Iterator[bytes]:
    files, path = opened(uri)
    with files.open_input_file(path) as source:
        source.seek(start)
        left = length
        while left is None or left > 0:
            data = source.read(PIECE if left is None else min(PIECE, left))
            if not data:
                return
            if left is not None:
                left -= len(data)
            yield data


def normalise_file(source: str, folder: str, expected: int | None = None) -> tuple[str, str, int]:
    """Rewrite one archive as (archive, index, records); the index has a JSON line per member.

    An archive that is cut, or that does not hold the ``expected`` number of records, is an error.
    """
    target = own_name(folder, ".warc.gz")
    sidecar = target + ".idx"
    offset = count = 0
    with create(target) as out, create(sidecar) as index:
        for data in records(inflate(pieces_of(source))):
            member = gzip.compress(data, compresslevel=6, mtime=0)
            out.write(member)
            index.write((json.dumps({"offset": offset, "length": len(member), "id": parse_id(data)}) + "\n").encode())
            offset, count = offset + len(member), count + 1
    if expected is not None and count != expected:
        raise ValueError(f"{source} holds {count} records, not {expected}")
    return target, sidecar, count


def parse_id(data: bytes) -> str:
    return parse(data)[0]["WARC-Record-ID"]


def spread_files(archives: DataFrame) -> DataFrame:
    """One task per few archives: a list of paths is tiny, its work is not."""
    tasks = max(1, archives.sparkSession.sparkContext.defaultParallelism)
    return archives.repartition(max(tasks, min(10_000, archives.count())), "path")


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """(archive, sidecar, records) per monolithic archive (path, and the records it should hold where that is known)."""
    folder = Folder(archives.sparkSession, folder).qualified()
    records = F.col("records") if "records" in archives.columns else F.lit(None).cast("long").alias("records")

    def run(batch: pa.RecordBatch):
        for path, expected in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist(), strict=True):
            archive, sidecar, count = normalise_file(path, folder, expected)
            yield [[archive], [sidecar], [count]]

    return map_rows(spread_files(archives).select("path", records), run, "archive string, sidecar string, records long")


def read_back(normalised: DataFrame) -> DataFrame:
    """A row per record, each member read alone at the offset that its index names."""

    def run(batch: pa.RecordBatch):
        for archive, sidecar in zip(batch.column("path").to_pylist(), batch.column("sidecar").to_pylist(), strict=True):
            files, path = opened(archive)
            rows = []
            with files.open_input_file(path) as source:
                for line in b"".join(pieces_of(sidecar)).splitlines():
                    entry = json.loads(line)
                    source.seek(entry["offset"])
                    rows.append(row_of(gzip.decompress(source.read(entry["length"]))))
                    if len(rows) == 5000:
                        yield list(map(list, zip(*rows, strict=True)))
                        rows = []
            if rows:
                yield list(map(list, zip(*rows, strict=True)))

    return map_rows(spread_files(normalised.withColumnRenamed("archive", "path")).select("path", "sidecar"), run, RESULT)


def row_of(data: bytes) -> tuple:
    fields, body = parse(data)
    number = lambda text: int(text[len("<urn:page:") : -1]) if text and text != "<urn:page:>" else None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "response" and hashlib.sha256(body).hexdigest() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return (
        number(fields["WARC-Record-ID"]), int(fields["X-Payload-Length"]), digest, fields["WARC-Type"],
        number(fields.get("WARC-Refers-To")), json.loads(fields["WARC-Target-URI"]), zlib.crc32(body),
    )


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` as monolithic archives, normalise them, and return what the members hold."""
    spark = pages.sparkSession
    folder = folder or fresh_dir(spark, "warc")
    monolithic = stored(write_monolithic(classified(pages), f"{folder}/monolithic"), "warc-archives")
    return read_back(stored(normalise(monolithic, f"{folder}/members"), "warc-members"))
