"""WARC writing, normalising of monolithic gzip archives, and reading back.

Pages become WARC records: a response with the whole payload, or a revisit that names the response with the same
payload. ``write_archives`` streams them into archives that are one gzip stream each. ``normalise`` inflates such a
stream once and rewrites every record as a gzip member of its own, with a sidecar index of offsets.
``read_archives`` reads members by that index.

Files go to a folder all executors share, under a name that holds the attempt; only files named in the returned
manifest count, so a lost or repeated task leaves at most an orphan. Archives are read and written in chunks, so memory
doesn't grow with an archive's length; a page's payload, one row of the input, is held whole where it is written and
where its member is read back.

Foreign archives: blank lines before a record are left out; a record without a length, one that doesn't end where its
length says, a cut stream and a count of records other than the manifest's are errors.

Defined cases: null html is an empty payload; payloads below ``least`` bytes are never revisits; rows equal in
page_id and payload are both responses, under one record id; a null page_id comes last when the response of a payload is
chosen; null urls give records without a target; other columns play no part; an empty table gives no archives and no rows.
"""

from __future__ import annotations

import hashlib
import io
import itertools
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_path, small, written

CHUNK = 1 << 20
GZIP = 31  # zlib's window bits for a gzip header and trailer
#: Fixed values of the format.
HEAD_END = b"\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Of records of pages without a time of their own.
DATE = "2024-01-01T00:00:00Z"

MANIFEST = "path string, records long, bytes long"
INDEXED = "path string, index_path string, records long, bytes long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, offset long, length long"


def classify(pages: DataFrame, least: int = 100) -> DataFrame:
    """pages(page_id, url, html) with payload_digest, payload_bytes, record_type, refers_to and refers_uri.

    Digests are grouped with a partial minimum; revisits, without their payloads, are joined back, and pages are only
    shuffled if there are too many revisits for a broadcast.
    """
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha2("payload", 256)).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    keys = written(rows.where(F.col("payload_bytes") >= least).select("page_id", "url", "payload_digest"), "warc-digests")
    place = F.struct(F.col("page_id").isNull().alias("last"), "page_id")
    firsts = keys.groupBy("payload_digest").agg(F.min(F.struct(*place_and_url())).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = F.struct(F.col("first.last").alias("last"), F.col("first.page_id").alias("page_id"))
    again = keys.join(firsts, "payload_digest").where(place != first)
    again = again.select(F.col("page_id").alias("again_id"), F.col("payload_digest").alias("again_digest"), F.col("first.page_id").alias("refers_to"), F.col("first.url").alias("refers_uri"), F.lit(True).alias("again")).distinct()
    again = written(again, "warc-revisits")
    out = rows.join(small(again, again.count()), F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("payload_digest") == F.col("again_digest")), "left")
    return out.select("page_id", "url", "payload", "payload_digest", "payload_bytes", F.when(F.col("again"), "revisit").otherwise("response").alias("record_type"), "refers_to", "refers_uri")


def place_and_url() -> list:
    """The order in which the response of a payload is chosen; the url comes along."""
    return [F.col("page_id").isNull().alias("last"), F.col("page_id"), F.col("url")]


def record_id(page_id: int | None, digest: str) -> str:
    """The same for the same page and payload, so that a revisit can name its response."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def record_head(row: dict, body: int, date: str = DATE) -> bytes:
    """The header block of one record; ``body`` is the length of what follows."""
    one_line = lambda url: url.replace("\r", "%0D").replace("\n", "%0A")
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {record_id(row['page_id'], row['payload_digest'])}", f"WARC-Date: {date}"]
    if row["url"] is not None:
        lines.append("WARC-Target-URI: " + one_line(row["url"]))
    if row["page_id"] is not None:
        lines.append(f"X-Page-Id: {row['page_id']}")
    lines += [f"WARC-Payload-Digest: sha256:{row['payload_digest']}", f"X-Payload-Length: {row['payload_bytes']}"]
    if row["record_type"] == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(row['refers_to'], row['payload_digest'])}", f"WARC-Refers-To-Date: {date}"]
        if row["refers_uri"] is not None:
            lines.append("WARC-Refers-To-Target-URI: " + one_line(row["refers_uri"]))
        if row["refers_to"] is not None:
            lines.append(f"X-Refers-To-Page: {row['refers_to']}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {body}"]
    return "\r\n".join(lines).encode() + HEAD_END


def parse_head(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


class Inflated:
    """The bytes of a gzip stream, however many members it has, read forwards in bounded chunks."""

    def __init__(self, source):
        self.source, self.engine, self.buffer = source, zlib.decompressobj(GZIP), bytearray()
        self.pending, self.ended = b"", False

    def _more(self) -> bool:
        while not self.ended:
            data = self.engine.unconsumed_tail or self.pending or self.source.read(CHUNK)
            self.pending = b""
            if not data:
                self.ended = True
                if not self.engine.eof:
                    raise ValueError("the gzip stream is cut short")
                return False
            if self.engine.eof:
                self.engine = zlib.decompressobj(GZIP)
            got = self.engine.decompress(data, CHUNK)
            if self.engine.eof:
                self.pending = self.engine.unused_data
            self.buffer += got
            if got:
                return True
        return False

    def more(self) -> bool:
        """Whether anything but blank lines is left; those before it are left out."""
        while True:
            kept = bytes(self.buffer).lstrip(b"\r\n") if self.buffer[:1] in (b"\r", b"\n") else self.buffer
            if kept:
                self.buffer = bytearray(kept) if kept is not self.buffer else self.buffer
                return True
            self.buffer.clear()
            if not self._more():
                return False

    def until(self, mark: bytes) -> bytes:
        """Up to ``mark``, which is dropped."""
        seen = 0
        while (at := self.buffer.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.buffer)
            if not self._more():
                raise ValueError("a record is cut short")
        out = bytes(self.buffer[:at])
        del self.buffer[: at + len(mark)]
        return out

    def chunks(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes, in pieces."""
        while n:
            if not self.buffer and not self._more():
                raise ValueError("a record is cut short")
            piece = bytes(self.buffer[:n])
            del self.buffer[:n]
            n -= len(piece)
            yield piece


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    columns = {name: batch.column(name) for name in batch.schema.names}
    for i in range(batch.num_rows):
        yield {k: v[i].as_py() for k, v in columns.items()}


def _opened(uri: str):
    """Filesystem and path of a folder, made if need be."""
    filesystem, path = pafs.FileSystem.from_uri(uri)
    filesystem.create_dir(path, recursive=True)
    return filesystem, path


def write_archives(records: DataFrame, folder: str, level: int = 1, most: int = 256 << 20, date: str = DATE) -> DataFrame:
    """A manifest of archives, each one gzip stream of about ``most`` bytes of records, made where the rows are."""

    def write(batches):
        filesystem, top = _opened(folder)
        name = out = engine = None
        n = size = 0

        def close():
            out.write(engine.flush())
            out.close()
            return pa.RecordBatch.from_pydict({"path": [name], "records": [n], "bytes": [size]}, schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

        for batch in batches:
            for row in _rows(batch):
                if out is None:
                    name, n, size = f"mono-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out, engine = filesystem.open_output_stream(f"{top}/{name}", compression=None), zlib.compressobj(level, zlib.DEFLATED, GZIP)
                payload = row["payload"]
                http = HTTP % len(payload)
                body = http if row["record_type"] == "revisit" else http + payload
                for piece in (record_head(row, len(body), date), body, HEAD_END):
                    out.write(engine.compress(piece))
                    size += len(piece)
                n += 1
                if size >= most:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return written(records.mapInArrow(write, MANIFEST), "warc-manifest")


def normalise(manifest: DataFrame, source: str, folder: str, level: int = 1) -> DataFrame:
    """Each archive of ``manifest`` again in ``folder``, with a gzip member for each record and an index beside it:
    a line of JSON per record with its offset, length and header fields. A null count of records isn't checked."""

    def rewrite(batches):
        inputs, above = pafs.FileSystem.from_uri(source)
        filesystem, top = _opened(folder)
        for batch in batches:
            for path, expected in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist(), strict=True):
                name = f"{path.removesuffix('.warc.gz')}-{uuid.uuid4().hex[:8]}.warc.gz"
                n = offset = 0
                with inputs.open_input_stream(f"{above}/{path}", compression=None) as raw, filesystem.open_output_stream(f"{top}/{name}", compression=None) as out, filesystem.open_output_stream(f"{top}/{name}.idx", compression=None) as index:
                    stream = Inflated(raw)
                    while stream.more():
                        head = stream.until(HEAD_END)
                        fields = parse_head(head)
                        if "content-length" not in fields:
                            raise ValueError(f"{path}: record {n} has no Content-Length")
                        engine, start = zlib.compressobj(level, zlib.DEFLATED, GZIP), offset
                        for piece in itertools.chain([head + HEAD_END], stream.chunks(int(fields["content-length"])), [HEAD_END]):
                            offset += out.write(engine.compress(piece))
                        offset += out.write(engine.flush())
                        if b"".join(stream.chunks(len(HEAD_END))) != HEAD_END:
                            raise ValueError(f"{path}: a record doesn't end where its length says")
                        index.write(json.dumps({"offset": start, "length": offset - start, "type": fields.get("warc-type"), "uri": fields.get("warc-target-uri"), "id": fields.get("warc-record-id")}).encode() + b"\n")
                        n += 1
                if expected is not None and n != expected:
                    raise ValueError(f"{path}: {n} records, {expected} by the manifest")
                yield pa.RecordBatch.from_pydict({"path": [name], "index_path": [f"{name}.idx"], "records": [n], "bytes": [offset]}, schema=pa.schema([("path", pa.string()), ("index_path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    count = manifest.count()
    return written(manifest.repartition(max(1, count)).mapInArrow(rewrite, INDEXED), "warc-index") if count else manifest.sparkSession.createDataFrame([], INDEXED)


def read_member(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and content block of one record."""
    whole = zlib.decompress(data, GZIP)
    head, _, rest = whole.partition(HEAD_END)
    fields = parse_head(head)
    return fields, rest[: int(fields["content-length"])]


def read_archives(indexed: DataFrame, folder: str) -> DataFrame:
    """A row per record, read member by member through the sidecar index. Responses' digests are taken of the payloads read."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())])

    def read(batches):
        filesystem, top = pafs.FileSystem.from_uri(folder)
        number = lambda x: None if x is None else int(x)
        for batch in batches:
            for path, index_path in zip(batch.column("path").to_pylist(), batch.column("index_path").to_pylist(), strict=True):
                rows = []
                with filesystem.open_input_file(f"{top}/{path}") as archive, filesystem.open_input_stream(f"{top}/{index_path}", compression=None) as index:
                    for line in io.BufferedReader(index, CHUNK):
                        entry = json.loads(line)
                        archive.seek(entry["offset"])
                        fields, block = read_member(archive.read(entry["length"]))
                        size, digest = number(fields.get("x-payload-length")), fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
                        if fields.get("warc-type") == "response":
                            payload = block.partition(HEAD_END)[2]
                            size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                        rows.append((number(fields.get("x-page-id")), fields.get("warc-target-uri"), size, digest, fields.get("warc-type"), number(fields.get("x-refers-to-page")), entry["offset"], entry["length"]))
                        if len(rows) == 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    count = indexed.count()
    return indexed.repartition(max(1, count)).mapInArrow(read, RECORDS)


def round_trip(pages: DataFrame, least: int = 100) -> DataFrame:
    """Write, normalise and read back ``pages``."""
    spark = pages.sparkSession
    mono, members = new_path(spark, "warc-mono"), new_path(spark, "warc-members")
    manifest = write_archives(classify(pages, least), mono)
    return read_archives(normalise(manifest, mono, members), members)


SQL = """
with p as (select page_id, encode(coalesce(html, '')) as payload from pages),
d as (select page_id, octet_length(payload) as n, sha256(payload) as digest from p),
f as (select digest, min(page_id) as first from d where n >= 100 group by digest)
select d.page_id, cast(d.n as bigint) as payload_bytes, d.digest as payload_digest,
  case when f.first is not null and f.first <> d.page_id then 'revisit' else 'response' end as record_type,
  case when f.first is not null and f.first <> d.page_id then f.first end as refers_to
from d left join f on f.digest = d.digest and d.n >= 100
"""
