import gzip
import hashlib
import io
import json
import zlib

import pytest
from pyarrow import fs as pafs

from millrace.llm import warc
from millrace.llm.common import new_path

from ..compare import same


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 5) for r in rows], "page_id long, url string, html string, payload string, length int")


ROWS = [
    (3, "http://a/3", "y" * 100), (1, "http://a/1", "y" * 100), (2, "http://a/2", "y" * 99), (4, "http://a/4", "y" * 99), (5, None, None), (6, "http://a/\r\n6", ""),
    (7, "u", "é" * 50), (8, "u", "é" * 50), (8, "u", "é" * 50), (None, "u", "y" * 100), (9, "u", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 40), (10, "u", "z" * 3_000_000),
]


def brute(rows):
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        firsts = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        first = min(firsts) if firsts else None
        again = len(data) >= 100 and first is not None and page_id != first
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def test_round_trip(spark):
    out = warc.round_trip(pages(spark, ROWS)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute(ROWS)
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_archives_are_monolithic_and_members_stand_alone(spark):
    mono, members = new_path(spark, "m"), new_path(spark, "n")
    manifest = warc.write_archives(warc.classify(pages(spark, ROWS)).coalesce(1), mono)
    indexed = warc.normalise(manifest, mono, members)
    filesystem, top = pafs.FileSystem.from_uri(mono)
    name = manifest.first()["path"]
    data = filesystem.open_input_file(f"{top}/{name}").read()
    engine = zlib.decompressobj(31)
    whole = engine.decompress(data)
    assert engine.eof and not engine.unused_data  # one stream
    filesystem, top = pafs.FileSystem.from_uri(members)
    row = indexed.first()
    archive = filesystem.open_input_file(f"{top}/{row['path']}").read()
    index = [json.loads(x) for x in filesystem.open_input_file(f"{top}/{row['index_path']}").read().splitlines()]
    assert len(index) == len(ROWS) == row["records"]
    assert [e["offset"] for e in index[1:]] == [e["offset"] + e["length"] for e in index[:-1]]
    assert gzip.decompress(archive) == whole  # nothing but the compression changed
    for e in index:
        assert gzip.decompress(archive[e["offset"] : e["offset"] + e["length"]]).startswith(b"WARC/1.1\r\n")


def test_archives_roll_over(spark):
    manifest = warc.write_archives(warc.classify(pages(spark, ROWS)).coalesce(1), new_path(spark, "m"), most=1000)
    assert manifest.count() > 3 and manifest.groupBy().sum("records").first()[0] == len(ROWS)


def test_inflating_in_chunks(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 7)
    body = b"head\r\n\r\n" + bytes(range(256)) * 5
    stream = warc.Inflated(io.BytesIO(gzip.compress(body[:600]) + gzip.compress(body[600:])))
    assert stream.more() and stream.until(b"\r\n\r\n") == b"head"
    assert b"".join(stream.chunks(1280)) == body[8:] and not stream.more()
    with pytest.raises(ValueError, match="cut short"):
        list(warc.Inflated(io.BytesIO(gzip.compress(body)[:-20])).chunks(len(body) + 1))


def test_sql(spark, sf_dir, duck):
    out = warc.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    same(out, duck, warc.SQL)


def foreign(spark, data, records=None):
    """One archive made elsewhere, normalised: its index rows."""
    mono, members = new_path(spark, "m"), new_path(spark, "n")
    filesystem, top = pafs.FileSystem.from_uri(mono)
    filesystem.create_dir(top, recursive=True)
    with filesystem.open_output_stream(f"{top}/a.warc.gz", compression=None) as out:
        out.write(gzip.compress(data))
    manifest = spark.createDataFrame([("a.warc.gz", records, len(data))], warc.MANIFEST)
    return warc.read_archives(warc.normalise(manifest, mono, members), members).collect()


def record(n, kind="response", body=b"HTTP/1.1 200 OK\r\n\r\npayload"):
    row = {"record_type": kind, "page_id": n, "payload_digest": "d", "url": None, "payload_bytes": 7, "refers_to": 1, "refers_uri": "u"}
    return warc.record_head(row, len(body)) + body + b"\r\n\r\n"


def test_foreign_archives(spark):
    blank = b"\r\n".join([b"", record(1), b"", b"", record(2), b"\n", record(3), b"\r\n"])
    assert [r["page_id"] for r in foreign(spark, blank, 3)] == [1, 2, 3]
    assert [r["page_id"] for r in foreign(spark, blank)] == [1, 2, 3]
    for data, said in ((record(1).replace(b"Content-Length: ", b"X-Length: "), "no Content-Length"), (record(1) + record(2)[:-9], "cut short"), (record(1).replace(b"payload\r", b"payload more\r"), "doesn't end where")):
        with pytest.raises(Exception, match=said):
            foreign(spark, data)
    with pytest.raises(Exception, match="3 records, 4 by the manifest"):
        foreign(spark, blank, 4)


def test_revisits_name_their_response(spark):
    rows = warc.classify(pages(spark, ROWS)).where("record_type = 'revisit'").collect()
    assert {r["refers_to"] for r in rows} == {1, 7} and {r["refers_uri"] for r in rows} == {"http://a/1", "u"}
    for r in rows:
        head = warc.parse_head(warc.record_head(r.asDict(), 0).partition(b"\r\n\r\n")[0])
        assert head["warc-refers-to"] == warc.record_id(r["refers_to"], r["payload_digest"]) and head["warc-refers-to-target-uri"] == r["refers_uri"]
