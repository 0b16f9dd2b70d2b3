"""WARC archives: monolithic gzip files are inflated once and rewritten with one gzip member per record and a sidecar index.

``write_archives`` makes archives as many crawlers leave them: all records in one gzip stream, of which no record can be read alone.
``normalise`` streams through each file once, rewrites every record as its own member, and writes beside it ``.cdx`` lines
(offset, length, type, id, digest). ``read_records`` opens the members at the offsets of an index and checks each payload's digest.

Files are written under a shared folder by its URI (any store that Arrow's file systems reach), first under a name of the attempt, then
renamed, so a task that runs again replaces its own file. Archives end at a bounded payload size; nothing larger than one record is held.

Equal payloads: that of the largest page_id is a response, the others are revisits of it and hold no payload. The choice is made on
digests (pre-aggregated); pages themselves meet only their own decision, so a page with very many copies is not gathered anywhere.

Defined cases: a null html is an empty payload; rows that repeat both page_id and payload are all responses or all revisits; a null page_id
is written as no id, is never referred to, and stays null; control characters in a url are percent-encoded; a table without rows gives no file.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage, scratch_path
from .common import batch, utf8

#: Payload bytes after which an archive ends.
ARCHIVE_BYTES = 32 << 20
CHUNK = 1 << 20
# Layout of a record.
HEAD = b"WARC/1.1\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
DATE = b"1970-01-01T00:00:00Z"

_INDEX = {"path": pa.string(), "offset": pa.int64(), "length": pa.int64(), "record_type": pa.string(), "page_id": pa.int64(), "payload_digest": pa.string()}
_INDEX_SQL = "path string, offset bigint, length bigint, record_type string, page_id bigint, payload_digest string"


def payload_digest(payload: bytes) -> bytes:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest())


def _urn(page_id: int | None) -> bytes:
    return b"<urn:page:%s>" % (b"" if page_id is None else b"%d" % page_id)


def _of_urn(value: bytes | None) -> int | None:
    number = (value or b"")[len(b"<urn:page:"):-1]
    return int(number) if number else None


def record(page_id: int | None, url: bytes | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record; a revisit (``refers_to`` given) holds the response's header alone, its digest and length are of the full payload."""
    address = b"".join(b"%%%02X" % c if c < 33 or c == 127 else bytes([c]) for c in url or b"")
    block = HTTP % len(payload) + (payload if refers_to is None else b"")
    fields = [(b"WARC-Type", b"response" if refers_to is None else b"revisit"), (b"WARC-Record-ID", _urn(page_id)), (b"WARC-Date", DATE),
              (b"WARC-Target-URI", address), (b"WARC-Payload-Digest", b"sha1:" + payload_digest(payload))]
    if refers_to is not None:
        fields += [(b"WARC-Refers-To", _urn(refers_to)), (b"WARC-Profile", b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    fields += [(b"Content-Type", b"application/http; msgtype=response"), (b"Content-Length", b"%d" % len(block))]
    return HEAD + b"".join(k + b": " + v + b"\r\n" for k, v in fields) + b"\r\n" + block + b"\r\n\r\n"


def head_fields(head: bytes) -> dict[bytes, bytes]:
    return {k: v.strip() for k, _, v in (line.partition(b":") for line in head.split(b"\r\n")[1:])}


def parse(raw: bytes) -> tuple[dict[bytes, bytes], bytes]:
    """Header fields and block of one whole record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = head_fields(head)
    return fields, rest[:int(fields[b"Content-Length"])]


def inflated(source):
    """Chunks of a gzip file of one or many members, inflated."""
    stream = zlib.decompressobj(31)
    while data := source.read(CHUNK):
        while data:
            yield stream.decompress(data)
            data = stream.unused_data
            if stream.eof:
                stream = zlib.decompressobj(31)
            elif not data:
                break


def records(chunks):
    """Whole records of a stream of bytes, one at a time."""
    held, at = bytearray(), 0
    need, size = b"\r\n\r\n", None
    for chunk in chunks:
        held += chunk
        while True:
            if size is None:
                end = held.find(need, at)
                if end < 0:
                    break
                fields = head_fields(bytes(held[at:end]))
                size = end + 4 - at + int(fields[b"Content-Length"]) + 4
            if len(held) - at < size:
                break
            yield bytes(held[at:at + size])
            at, size = at + size, None
        if at:
            del held[:at]
            at = 0
    if held:
        raise ValueError("the archive ends inside a record")


def store(uri: str):
    """File system and path of a URI or plain path."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class _File:
    """A file that appears under its name only when it is whole."""

    def __init__(self, uri: str):
        self.fs, self.path = store(uri)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.own = f"{self.path}.{uuid.uuid4().hex}"
        self.out, self.size = self.fs.open_output_stream(self.own, compression=None), 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.own, self.path)


def _write_monolithic(folder: str, archive_bytes: int):
    def kernel(batches):
        part, made, out = TaskContext.get().partitionId(), 0, None
        for b in batches:
            for page, url, html, refers in zip(b.column("page").to_pylist(), utf8(b.column("url")), utf8(b.column("html")), b.column("refers_to").to_pylist()):
                if out is None:
                    path = f"{folder}/part-{part:06d}-{made:04d}.warc.gz"
                    out, gz, size, n = _File(path), zlib.compressobj(1, zlib.DEFLATED, 31), 0, 0
                out.write(gz.compress(record(page, url, html or b"", refers)))
                size, n = size + len(html or b""), n + 1
                if size >= archive_bytes:
                    out.write(gz.flush())
                    out.close()
                    yield batch({"path": pa.string(), "n": pa.int64()}, {"path": [path], "n": [n]})
                    out, made = None, made + 1
        if out is not None:
            out.write(gz.flush())
            out.close()
            yield batch({"path": pa.string(), "n": pa.int64()}, {"path": [path], "n": [n]})
    return kernel


def _normalise(folder: str, level: int):
    def kernel(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                system, name = store(path)
                target = f"{folder}/{path.rpartition('/')[2]}"
                out, index = _File(target), []
                with system.open_input_stream(name, compression=None) as source:
                    for raw in records(inflated(source)):
                        fields = head_fields(raw[:raw.index(b"\r\n\r\n")])
                        gz = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = gz.compress(raw) + gz.flush()
                        index.append((target, out.size, len(member), fields[b"WARC-Type"].decode(), _of_urn(fields[b"WARC-Record-ID"]),
                                      fields[b"WARC-Payload-Digest"].removeprefix(b"sha1:").decode()))
                        out.write(member)
                out.close()
                side = _File(target.removesuffix(".warc.gz") + ".cdx")
                side.write("".join(f"{o} {n} {kind} {'-' if page is None else page} {digest}\n" for _, o, n, kind, page, digest in index).encode())
                side.close()
                if index:
                    yield batch(_INDEX, dict(zip(_INDEX, zip(*index))))
    return kernel


_READ = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}


def _read(batches):
    for b in batches:
        out, opened, source = [], None, None
        for path, offset, length in zip(*(b.column(c).to_pylist() for c in ("path", "offset", "length"))):
            if path != opened:
                if source is not None:
                    source.close()
                system, name = store(path)
                opened, source = path, system.open_input_file(name)
            source.seek(offset)
            fields, block = parse(zlib.decompress(source.read(length), 31))
            head, _, payload = block.partition(b"\r\n\r\n")
            size = int(head.rpartition(b"Content-Length: ")[2])
            digest = fields[b"WARC-Payload-Digest"].removeprefix(b"sha1:")
            kind = fields[b"WARC-Type"].decode()
            if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
                raise ValueError(f"payload differs from its digest in {path} at {offset}")
            out.append((_of_urn(fields[b"WARC-Record-ID"]), size, digest.decode(), kind, _of_urn(fields.get(b"WARC-Refers-To")),
                        payload if kind == "response" else None))
        if source is not None:
            source.close()
        if out:
            yield batch(_READ, dict(zip(_READ, zip(*out))))


def revisits(pages: DataFrame, least: int = 0, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """page, url?, html and refers_to: the largest page_id with an equal payload of at least ``least`` bytes, if it is another."""
    own = pages.select(F.col(page_id).cast("bigint").alias("page"), "url", F.coalesce(html, F.lit("")).alias("html"))
    own = own.withColumn("sha", F.sha1("html"))
    marks = own.filter(F.octet_length("html") >= least).select("page", "sha")
    last = marks.groupBy("sha").agg(F.max("page").alias("last"), F.count("*").alias("n")).filter("n > 1 AND last IS NOT NULL").drop("n")
    told = (marks.distinct().join(last, "sha").filter("NOT page <=> last")
            .select(F.col("page").alias("told_page"), F.col("sha").alias("told_sha"), F.col("last").alias("refers_to")))
    return own.join(told, own["page"].eqNullSafe(told["told_page"]) & (own["sha"] == told["told_sha"]), "left").select("page", "url", "html", "refers_to")


def tasks(df: DataFrame) -> int:
    """Tasks for rows that are only places of files: their own size says nothing about the work."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, least: int = 0) -> DataFrame:
    """Write one record per row of ``pages`` into monolithic gzip archives; path and number of records of each."""
    return cut_lineage(revisits(pages, least).mapInArrow(_write_monolithic(folder, archive_bytes), "path string, n bigint"), "archives")


def normalise(archives: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Rewrite the archives at ``path`` into ``folder``, one member per record; the index of all of them."""
    spread = archives.select("path").repartition(tasks(archives))
    return cut_lineage(spread.mapInArrow(_normalise(folder, level), _INDEX_SQL), "index")


def read_records(index: DataFrame) -> DataFrame:
    """The records at the places of ``index``: page_id, payload_bytes, payload_digest, record_type, refers_to, payload."""
    places = index.select("path", "offset", "length").repartition(tasks(index), "path").sortWithinPartitions("path", "offset")
    return places.mapInArrow(
        _read, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary")


def round_trip(pages: DataFrame, least: int = 0, folder: str | None = None) -> DataFrame:
    """Pages written as monolithic archives, normalised, and read back through the index."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return read_records(normalise(write_archives(pages, f"{folder}/monolithic", least=least), f"{folder}/members"))
