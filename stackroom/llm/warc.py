"""Web archives whose records are compressed one by one with a Zstandard dictionary that the file itself carries.

A file starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary, itself compressed. Every record
after it, the file's ``warcinfo`` first, is a frame of its own, so a reader can start at any record. The dictionary is
trained once, on the driver, from at most ``dict_rows`` of the records to be archived, of ``dict_row_bytes`` bytes at
most each; it is ``dict_bytes`` bytes long at most.

Pages with equal payloads meet in a join on the digest; the one with the largest page id becomes a response, the others
revisit it and carry no payload. Each task writes its files under temporary names and renames them, so a task that
runs again puts the same records in their place. What was written is listed in a manifest table beside the files.
"""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackroom.operators.joins import join_per_key

from .common import slices

#: Fixed values of the file format.
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:page:"


@dataclass(frozen=True)
class WarcSpec:
    date: str = "2024-01-01T00:00:00Z"
    level: int = 3
    dict_bytes: int = 65_536
    dict_rows: int = 1000
    dict_row_bytes: int = 65_536
    file_bytes: int = 256_000_000


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<{RECORD_ID}{'none' if page_id is None else page_id}>"


def page_of(identifier: str | None) -> int | None:
    name = (identifier or "").strip("<>").removeprefix(RECORD_ID)
    return None if name in ("", "none") else int(name)


def warc_record(kind: str, fields: dict[str, str], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields.items()), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, spec: WarcSpec) -> bytes:
    """A response with the payload, or a revisit that keeps the HTTP header (and so the payload's length) only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = {
        "WARC-Record-ID": record_id(page_id),
        "WARC-Date": spec.date,
        "WARC-Target-URI": urllib.parse.quote(url or "", safe="%/:?#[]@!$&'()*+,;=~-._"),
        "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
        "Content-Type": "application/http; msgtype=response",
    }
    if revisit:
        fields |= {"WARC-Profile": REVISIT, "WARC-Refers-To": record_id(refers_to)}
    return warc_record("revisit" if revisit else "response", fields, http if revisit else http + payload)


def train_dictionary(records: list[bytes], spec: WarcSpec) -> bytes:
    """A trained dictionary, or the records themselves as a plain one where there are too few to train on."""
    try:
        return zstandard.train_dictionary(spec.dict_bytes, records, k=1024, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[-spec.dict_bytes :] or b"WARC/1.1\r\nWARC-Type: response\r\n"


class ArchiveFile:
    """One file in the making: dictionary frame, then a frame for each record."""

    def __init__(self, folder: str, name: str, dictionary: bytes, spec: WarcSpec):
        self.store, root = fs.FileSystem.from_uri(folder)
        self.store.create_dir(root, recursive=True)
        self.name, self.target = name, f"{root}/{name}"
        self.temporary = f"{root}/_{name}.{uuid.uuid4().hex}"
        self.stream = self.store.open_output_stream(self.temporary, compression=None)
        packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
        self.size = self.records = 0
        self._put(DICTIONARY_FRAME.to_bytes(4, "little") + len(packed).to_bytes(4, "little") + packed)
        self.packer = zstandard.ZstdCompressor(level=spec.level, dict_data=zstandard.ZstdCompressionDict(dictionary))
        info = {"WARC-Record-ID": f"<urn:file:{name}>", "WARC-Date": spec.date, "WARC-Filename": name, "Content-Type": "application/warc-fields"}
        self._put(self.packer.compress(warc_record("warcinfo", info, b"format: WARC File Format 1.1\r\n")))

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def add(self, record: bytes) -> None:
        self._put(self.packer.compress(record))
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.stream.close()
        self.store.move(self.temporary, self.target)
        return self.name, self.records, self.size


def typed_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, response_id (largest page id with the payload). Null html is an empty payload.

    Only digest and id are aggregated; the pages then go through one shuffle, and a payload that many pages have can
    be split over tasks.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    last = rows.select("digest", "page_id").groupBy("digest").agg(F.max("page_id").alias("response_id"))
    return join_per_key(rows, last, ["digest"], "inner").select("page_id", "url", "payload", "response_id")


def dictionary_sample(pages: DataFrame, spec: WarcSpec) -> list:
    """At most ``dict_rows`` short pages, chosen by hash. The hashes are chosen first, so few pages reach the driver."""
    rows = pages.where(F.length(F.coalesce("html", F.lit(""))) <= spec.dict_row_bytes).select("page_id", "url", "html")
    rows = rows.withColumn("place", F.xxhash64("page_id", "html"))
    places = rows.select("place").distinct().orderBy("place").limit(spec.dict_rows)
    # At most dict_rows numbers are broadcast; repeated rows are cut off once more.
    return rows.join(F.broadcast(places), "place", "left_semi").drop("place").limit(spec.dict_rows).collect()


def write_archives(pages: DataFrame, folder: str, spec: WarcSpec = WarcSpec()) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives below ``folder``; returns the manifest (file, records, bytes).

    Repeated rows of the largest page id are all responses; a null page id loses to any other.
    """
    sample = dictionary_sample(pages, spec)
    records = [page_record(r["page_id"], r["url"], (r["html"] or "").encode(), None, False, spec) for r in sample]
    dictionary = train_dictionary(records, spec)

    def write(batches):
        part, made, file = TaskContext.get().partitionId(), [], None
        for batch in slices(batches, 64):
            for page_id, url, payload, response_id in zip(*(batch.column(i).to_pylist() for i in range(4))):
                file = file or ArchiveFile(folder, f"part-{part:05d}-{len(made):04d}.warc.zst", dictionary, spec)
                file.add(page_record(page_id, url, payload, response_id, page_id != response_id, spec))
                if file.size >= spec.file_bytes:
                    made.append(file.close())
                    file = None
        if file:
            made.append(file.close())
        names, counts, sizes = zip(*made) if made else ((), (), ())
        yield pa.record_batch({"file": pa.array(names, pa.string()), "records": pa.array(counts, pa.int64()), "bytes": pa.array(sizes, pa.int64())})

    manifest = f"{folder}/_manifest"
    typed_pages(pages).mapInArrow(write, "file string, records long, bytes long").write.parquet(manifest)
    return pages.sparkSession.read.schema("file string, records long, bytes long").parquet(manifest)


def read_frames(stream) -> Iterator[bytes]:
    """The records of a file, one after another; only a record and a piece of the file are in memory."""
    head = stream.read(8)
    if int.from_bytes(head[:4], "little") == DICTIONARY_FRAME:
        dictionary = stream.read(int.from_bytes(head[4:], "little"))
        if dictionary.startswith(ZSTD_MAGIC):
            dictionary = zstandard.ZstdDecompressor().decompressobj().decompress(dictionary)
        opener, rest = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)), b""
    else:
        opener, rest = zstandard.ZstdDecompressor(), head
    frame, out = opener.decompressobj(), []
    while rest or (rest := stream.read(32_768)):
        out.append(frame.decompress(rest))
        rest = frame.unused_data if frame.eof else b""
        if frame.eof:
            yield b"".join(out)
            frame, out = opener.decompressobj(), []
    if any(out):
        raise ValueError("the archive ends within a record")


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    return fields, rest[: int(fields["content-length"])]


def parse_page(record: bytes) -> tuple | None:
    """(page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload) of a page's record, else None."""
    fields, block = parse_record(record)
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    head, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(line[16:]) for line in head.split(b"\r\n") if line.startswith(b"Content-Length: "))
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or payload_digest(payload) != digest):
        raise ValueError(f"damaged record {fields['warc-record-id']}")
    refers = page_of(fields.get("warc-refers-to"))
    return page_of(fields["warc-record-id"]), fields["warc-target-uri"], kind, refers, digest, length, payload if kind == "response" else None


PAGE = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """A row for each page record of the files in the manifest. Payloads are checked against length and digest."""
    types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
    schema = pa.schema([(c.split()[0], t) for c, t in zip(PAGE.split(", "), types)])

    def read(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                store, root = fs.FileSystem.from_uri(folder)
                with store.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    rows, size = [], 0
                    for page in filter(None, map(parse_page, read_frames(stream))):
                        rows.append(page)
                        size += len(page[-1] or b"")
                        if len(rows) == 256 or size > 4_000_000:
                            yield to_batch(rows)
                            rows, size = [], 0
                    yield to_batch(rows)

    def to_batch(rows):
        columns = zip(*rows) if rows else [()] * len(schema)
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    files = manifest.count()
    return manifest.select("file").repartition(max(files, 1), "file").mapInArrow(read, PAGE)


def new_archive(pages: DataFrame, folder: str, spec: WarcSpec = WarcSpec()) -> DataFrame:
    """Write and read back."""
    return read_archives(write_archives(pages, folder, spec), folder)
