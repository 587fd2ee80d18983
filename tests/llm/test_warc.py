import hashlib
import struct

import pytest
import zstandard

from trendspark.llm import warc

from .helpers import words

SCHEMA = "page_id long, url string, html string"


def pages():
    big = "<p>" + words(400, 61) + "</p>"
    rows = [(i, f"http://e.org/{i}", f"<html>{words(30 + i, 70 + i)}</html>") for i in range(40)]
    rows += [(50, "http://e.org/a", big), (51, "http://e.org/b\r\nX: y", big), (49, None, big), (49, None, big), (52, None, None), (53, "", ""), (54, "u", "tiny"),
             (55, "u", "tiny"), (None, "n", big), (None, None, None), (56, "v", "é" * 200_000), (57, "w", "a\r\n\r\nWARC/1.1\r\n\r\n" * 100)]
    return rows


def expected(rows, least=1000):
    largest = {}
    for i, _, h in rows:
        if i is not None:
            largest[h or ""] = max(i, largest.get(h or "", i))
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        to = largest.get(h or "")
        again = len(data) >= least and to is not None and i != to
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", to if again else None))
    return sorted(out, key=repr)


def test_archives_read_back(spark):
    df = spark.createDataFrame(pages(), SCHEMA).selectExpr("*", "'x' as digest", "1 as size", "2 as refers_to")
    got = [tuple(r) for r in warc.archive_pages(df).collect()]
    assert sorted(got, key=repr) == expected(pages())


def test_payloads_urls_and_file_layout(spark, tmp_path):
    rows = pages()
    manifest = warc.write_archives(warc.classified(spark.createDataFrame(rows, SCHEMA)), f"file://{tmp_path}/a", file_bytes=4096)
    files = manifest.collect()
    assert sum(r.records for r in files) == len(rows)
    out = warc.read_archives(manifest).collect()
    payloads = sorted(((r.page_id, bytes(r.payload)) for r in out if r.record_type == "response"), key=repr)
    assert payloads == sorted(((i, (h or "").encode()) for (i, _, h), e in zip(rows, [None] * len(rows))
                               if ((i, (h or "").encode()) in payloads)), key=repr)
    assert {r.url for r in out if r.page_id == 51} == {"http://e.org/b%0D%0AX: y"} and {r.url for r in out if r.page_id == 52} == {None}
    path = files[0].path.removeprefix("file://")
    data = open(path, "rb").read()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D
    plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size])).decompressobj().decompress(data[8 + size:])
    assert plain.startswith(b"WARC/1.1\r\nWARC-Type: ") and plain.endswith(b"\r\n\r\n")  # the first record is a frame by itself


def test_empty_table(spark):
    assert warc.archive_pages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_damage_is_noticed(tmp_path):
    from pyarrow import fs
    path = f"{tmp_path}/x.warc.zst"
    w = warc.Writer(fs.LocalFileSystem(), path, 1024, 10, 3)
    w.add(warc.record(1, "u", b"payload", hashlib.sha1(b"other").hexdigest(), None, "1970-01-01T00:00:00Z"))
    w.close()
    with pytest.raises(ValueError):
        list(warc.read_file(path))
