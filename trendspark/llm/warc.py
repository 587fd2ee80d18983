"""WARC archives with a Zstandard dictionary: writer, reader, and payload deduplication.

A file is a skippable frame with the dictionary, followed by one Zstandard
frame for each record, so that a record can be read by itself once the
dictionary is known. The dictionary is built from the first records that go
into the file (a bounded sample; every record is compressed whole).
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import mapped, saved, shared_dir, text_or_empty

#: Fixed value: magic number of the skippable frame that holds a dictionary.
DICTIONARY_FRAME = 0x184D2A5D
#: Fixed value: profile of a revisit with an identical payload.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, records long, bytes long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def classified(pages: DataFrame, least: int = 1000, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Pages with digest, size, and for repeated payloads the page that has the response.

    ``(page_id, url, html, digest, size, refers_to)``. Of rows whose payloads
    are equal and at least ``least`` bytes long, those with the largest id are
    responses (``refers_to`` null), the others refer to it. Null payloads are
    empty. A null id refers to the largest id of its group; if all are null,
    all are responses. Only digests are grouped; the payloads move once.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        text_or_empty(payload_col).alias("html"))
    marked = rows.select("page_id", F.sha1("html").alias("digest"), F.octet_length("html").cast("long").alias("size"))
    repeated = marked.where(F.col("size") >= least).groupBy("digest", "size").agg(
        F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null")
    revisits = marked.join(repeated, ["digest", "size"]).where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select(
        F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "refers_to").distinct()
    whole = rows.select("*", F.sha1("html").alias("digest"), F.octet_length("html").cast("long").alias("size"))
    on = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest"))
    return whole.join(revisits, on, "left").select("page_id", "url", "html", "digest", "size", "refers_to")


def record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}/{digest}')}>"


def one_line(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """The bytes of a response record, or of a revisit record if ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    labelled = base64.b32encode(bytes.fromhex(digest)).decode()
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page, digest)), ("WARC-Date", date),
              ("WARC-Target-URI", one_line(url or f"urn:page:{page}")), ("Content-Type", "application/http; msgtype=response"),
              ("WARC-Payload-Digest", f"sha1:{labelled}")]
    if page is not None:
        fields.append(("Page-ID", str(page)))
    if url is None:
        fields.append(("Page-URL", "none"))
    if refers_to is not None:
        fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", record_id(refers_to, digest)), ("Refers-To-Page-ID", str(refers_to))]
    fields.append(("Content-Length", str(len(block))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def build_dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the samples' bytes as a raw one where there are too few to train on."""
    total = sum(map(len, samples))
    if len(samples) >= 16 and total >= 8 * 1024:
        try:
            return zstandard.train_dictionary(min(size, total // 4), samples, k=1024, d=8).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(samples)[-size:] or b"WARC/1.1"


class Writer:
    """One archive file: waits for the sample, then writes dictionary and records."""

    def __init__(self, files: fs.FileSystem, path: str, dictionary_size: int, sample_bytes: int, level: int):
        self.files, self.path, self.dictionary_size, self.sample_bytes, self.level = files, path, dictionary_size, sample_bytes, level
        self.waiting: list[bytes] = []
        self.size = self.records = self.written = 0
        self.out = self.compressor = None

    def add(self, data: bytes) -> None:
        self.records += 1
        if self.compressor is None:
            self.waiting.append(data)
            self.size += len(data)
            if self.size >= self.sample_bytes:
                self.start()
        else:
            self.put(self.compressor.compress(data))

    def put(self, data: bytes) -> None:
        self.out.write(data)
        self.written += len(data)

    def start(self) -> None:
        samples, room = [], self.sample_bytes
        for data in self.waiting:
            samples.append(data[:min(room, 1 << 17)])
            room -= len(samples[-1])
            if room <= 0:
                break
        dictionary = build_dictionary(samples, self.dictionary_size)
        self.out = self.files.open_output_stream(self.path, compression=None)
        self.put(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
        self.compressor = zstandard.ZstdCompressor(level=self.level, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True)
        for data in self.waiting:
            self.put(self.compressor.compress(data))
        self.waiting = []

    def close(self) -> None:
        if self.compressor is None:
            self.start()
        self.out.close()


def write_archives(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", file_bytes: int = 1 << 28, dictionary_size: int = 1 << 16,
                   sample_bytes: int = 1 << 21, level: int = 3) -> DataFrame:
    """Writes the rows of ``classified`` as archives under ``folder`` and returns the manifest.

    Each task writes its own files, named by its attempt; the manifest lists
    the files of the attempts that Spark committed, so files of lost or
    repeated attempts are never read.
    """
    def write(batches):
        files, base = fs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        context, number, writer = TaskContext.get(), 0, None
        done = []
        for batch in batches:
            for page, url, html, digest, _, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if writer is None:
                    name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{number:03d}.warc.zst"
                    writer = Writer(files, f"{base}/{name}", dictionary_size, sample_bytes, level)
                    number += 1
                writer.add(record(page, url, html.encode(), digest, refers_to, date))
                if writer.written >= file_bytes:
                    writer.close()
                    done.append(writer)
                    writer = None
        if writer is not None:
            writer.close()
            done.append(writer)
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{folder}/{w.path.rsplit('/', 1)[1]}" for w in done]), pa.array([w.records for w in done], pa.int64()),
                 pa.array([w.written for w in done], pa.int64())], ["path", "records", "bytes"])

    return saved(mapped(pages.select("page_id", "url", "html", "digest", "size", "refers_to"), write, MANIFEST), "warc-manifest")


def read_file(path: str) -> Iterator[tuple]:
    """The records of an archive, streamed: ``(page_id, url, size, digest, type, refers_to, payload)``."""
    files, name = fs.FileSystem.from_uri(path)
    with files.open_input_stream(name, compression=None) as raw:
        magic, length = struct.unpack("<II", raw.read(8))
        if magic != DICTIONARY_FRAME:
            raise ValueError(f"{path}: no dictionary frame")
        dictionary = zstandard.ZstdCompressionDict(raw.read(length))
        reader = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(raw, read_across_frames=True), 1 << 18)
        while line := reader.readline():
            if line != b"WARC/1.1\r\n":
                raise ValueError(f"{path}: not a record: {line[:40]!r}")
            fields = {}
            while (line := reader.readline()) != b"\r\n":
                key, _, value = line.decode().rstrip("\r\n").partition(": ")
                fields[key] = value
            block = reader.read(int(fields["Content-Length"]))
            if reader.read(4) != b"\r\n\r\n":
                raise ValueError(f"{path}: a record's end is missing")
            head, _, payload = block.partition(b"\r\n\r\n")
            size = int(head.rpartition(b"Content-Length: ")[2])
            digest = base64.b32decode(fields["WARC-Payload-Digest"].partition(":")[2]).hex()
            page, target = fields.get("Page-ID"), fields.get("Refers-To-Page-ID")
            if fields["WARC-Type"] == "response":
                if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"{path}: payload of {fields['WARC-Record-ID']} is damaged")
            else:
                payload = None
            yield (page and int(page), None if "Page-URL" in fields else fields["WARC-Target-URI"], size, digest, fields["WARC-Type"],
                   target and int(target), payload)


def read_archives(manifest: DataFrame, payloads: bool = True, at_once: int = 1 << 24) -> DataFrame:
    """All records of the manifest's files; ``payload`` is null for revisits, or for all without ``payloads``."""
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def pack(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def read(batches):
        rows, size = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for row in read_file(path):
                    rows.append(row if payloads else (*row[:-1], None))
                    size += 256 + (len(row[-1]) if payloads and row[-1] else 0)
                    if size >= at_once:
                        yield pack(rows)
                        rows, size = [], 0
        if rows:
            yield pack(rows)

    paths = manifest.select("path")
    return mapped(paths.repartition(max(1, paths.count()), "path"), read, RECORDS)


def archive_pages(pages: DataFrame, folder: str | None = None, least: int = 1000) -> DataFrame:
    """Writes all pages to archives and returns what reading them back gives, without the payloads.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to``; an
    empty table writes nothing and gives no rows.
    """
    folder = folder or f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    manifest = write_archives(classified(pages, least), folder)
    return read_archives(manifest, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
