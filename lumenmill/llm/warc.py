"""WARC archives compressed record by record with a dictionary of their own.

Layout of a file: a skippable frame (magic 0x184D2A5D) that holds a Zstandard dictionary built from
the archive's first records, then one frame per record, then a skippable frame with the offsets of all records. Any record can be read by its offset
with the dictionary alone (``ArchiveFile.record``); ``write_archives`` gives a manifest of archives, ``read_archives`` the place of every record. Payloads of ``min_bytes`` or more that repeat are written once,
by the page with the smallest id; the others are revisit records that name it.

A null payload is empty. Repeated ids are all kept: a row is a revisit by its own payload, whatever other rows of its id hold, and every row
of the smallest id is a response. A null id is no page to refer to: rows without id are revisits of a page with an id and an equal payload,
else responses. An empty table gives no archive; extra columns are
ignored. A task holds the records of one archive's dictionary sample (``sample_bytes``) and one open archive
(``archive_bytes``, or one record if it is longer)."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable
from itertools import islice

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import storage
from .ordering import shuffle_partitions

SKIPPABLE = 0x184D2A5D
DATE = "1970-01-01T00:00:00Z"


def record(kind: str, page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    body = b"" if kind == "revisit" else payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {''.join(url.splitlines())}", f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Payload-Length: {len(payload)}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: text/html", f"Content-Length: {len(body)}"]
    return "\r\n".join([*head, "", ""]).encode() + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    return fields, rest[: int(fields["Content-Length"])]


def build_dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; where samples are too few to train on, their own bytes."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


class ArchiveFile:
    """An archive by its ranges: ``fetch(start, size)``; ``size`` is that of the file. The dictionary and the offsets are read at once, records when they are asked for."""

    def __init__(self, fetch: Callable[[int, int], bytes], size: int):
        magic, words = struct.unpack("<II", fetch(0, 8))
        (count,) = struct.unpack("<Q", fetch(size - 8, 8))
        index = size - 16 - 8 * count  # a skippable frame: magic, length, offsets, their number
        tail = fetch(index, 8 + 8 * count)
        if magic != SKIPPABLE or struct.unpack_from("<II", tail) != (SKIPPABLE, 8 * count + 8):
            raise ValueError("no dictionary or index frame")
        self.offsets = [*struct.unpack_from(f"<{count}Q", tail, 8), index]
        self.fetch = fetch
        self.packer = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(fetch(8, words))) if words else zstandard.ZstdDecompressor()

    @classmethod
    def open(cls, uri: str, size: int) -> ArchiveFile:
        return cls(lambda at, n: storage.get_range(uri, at, n), size)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def record(self, k: int) -> tuple[dict[str, str], bytes]:
        """(fields, body) of the k-th record, from its own bytes."""
        return parse_record(self.packer.decompress(self.fetch(self.offsets[k], self.offsets[k + 1] - self.offsets[k])))


def read_archive(data: bytes):
    """(fields, body) of every record."""
    f = ArchiveFile(lambda at, n: data[at : at + n], len(data))
    return map(f.record, range(len(f)))


MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 100, dictionary_bytes: int = 1 << 16, sample_bytes: int = 1 << 20, archive_bytes: int = 1 << 26) -> DataFrame:
    """Write the archives into ``folder``; returns their manifest, read from shared storage."""
    pages = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    pages = pages.withColumn("digest", F.when(F.length("payload") >= min_bytes, F.unhex(F.sha2("payload", 256))))
    keyed = pages.filter("digest is not null").select("page_id", "digest")
    copies = storage.staged(keyed.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null").select("digest", "first"), f"{folder}/copies")
    again = keyed.join(copies, "digest").filter("not (page_id <=> first)").select("page_id", "digest", F.col("first").alias("refers_to")).distinct()  # a row for every copied page
    again = storage.staged(again.withColumnRenamed("page_id", "p").withColumnRenamed("digest", "d"), f"{folder}/again")
    rows = pages.join(again, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("digest") == F.col("d")), "left")

    def write(batches):
        held, size, out, packer, places = [], 0, [], None, []
        total = count = 0

        def put(r: bytes):
            nonlocal total
            places.append(total)
            out.append(packer.compress(r))
            total += len(out[-1])

        def start():
            nonlocal packer, total
            words = build_dictionary(held, dictionary_bytes)
            packer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(words)) if words else zstandard.ZstdCompressor(level=3)
            out.extend([struct.pack("<II", SKIPPABLE, len(words)), words])
            total = 8 + len(words)
            for r in held:
                put(r)
            held.clear()

        def close():
            nonlocal packer, size, total, count
            if packer is None:
                start()
            out.append(struct.pack(f"<II{len(places)}QQ", SKIPPABLE, 8 * len(places) + 8, *places, len(places)))
            done = pa.RecordBatch.from_pylist([{"path": storage.put_file(folder, "pages.warc.zst", out), "records": count, "bytes": total + len(out[-1])}], schema=MANIFEST)
            out.clear()
            places.clear()
            packer, size, total, count = None, 0, 0, 0
            return done

        for whole in batches:
            for b in storage.bounded(whole, 2):
                for page, url, payload, refers in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    r = record("response" if refers is None else "revisit", page, url, payload, hashlib.sha256(payload).hexdigest(), refers)
                    count += 1
                    if packer is None:
                        held.append(r)
                        size += len(r)
                        if size >= sample_bytes:
                            start()
                    else:
                        put(r)
                    if total >= archive_bytes:
                        yield close()
        if count:
            yield close()

    return storage.staged(rows.select("page_id", "url", "payload", "refers_to").mapInArrow(write, "path string, records long, bytes long"), f"{folder}/manifest")


def _number(urn: str | None) -> int | None:
    text = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def read_archives(manifest: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record, and where it is (path, offset, size); the digest of a response is taken anew from its bytes."""
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "path", "offset", "size"]

    def rows_of(path: str, f: ArchiveFile):
        for k in range(len(f)):
            head, body = f.record(k)
            digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
            if head["WARC-Type"] == "response" and (len(body) != int(head["WARC-Payload-Length"]) or hashlib.sha256(body).hexdigest() != digest):
                raise ValueError(f"damaged record {head['WARC-Record-ID']}")
            yield _number(head["WARC-Record-ID"]), int(head["WARC-Payload-Length"]), digest, head["WARC-Type"], _number(head.get("WARC-Refers-To")), path, f.offsets[k], f.offsets[k + 1] - f.offsets[k]

    def read(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                data = storage.get_file(path)
                rows = rows_of(path, ArchiveFile(lambda at, n, data=data: data[at : at + n], len(data)))
                while part := list(islice(rows, 10_000)):
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*part, strict=True), types, strict=True)], names=names)

    n = shuffle_partitions(manifest)
    return manifest.select("path").repartition(n, "path").mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, path string, offset long, size long")
