"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over 16 bytes cuts every text where its content says so, so a passage shared by
documents falls into the same chunks in all of them. A chunk is encoded as a text of its own, once while a worker's
bounded cache holds it: reuse is within a worker, since sending chunks to one place and their ids back would cost more than
encoding them (README has the measured share). A join of two chunks is repaired: the last two words of the one and the first two of the other are encoded
together, and this counts if its ids agree with those of the outer two words as their chunks have them; where they don't, the
window grows to both chunks, then to the whole text. A chunk of fewer than four words grows by its neighbour.

``encode_documents`` gives ids and the decoded text of every row in the order of its input:
null and empty texts have no ids, repeated rows are all kept, an empty table gives none, extra
columns are ignored. One pass over the table, no shuffle; a task holds ``BATCH`` bytes of texts or one longer text,
``cache_bytes`` of chunks and two generations of ``pieces`` words."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe, storage

WINDOW, MIN_CHUNK, BATCH = 16, 256, 1 << 20
_GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)


def cut_points(text: bytes, mask: int = 1023) -> list[int]:
    """Ends of the chunks. A cut depends on the 16 bytes before it, and on the cut before it by the least chunk length alone."""
    if len(text) <= MIN_CHUNK:
        return [len(text)] if text else []
    h = _GEAR[np.frombuffer(text, np.uint8)]
    step = 1
    while step < WINDOW:
        up = h.copy()
        up[step:] += h[:-step] << np.uint32(step)
        h, step = up, 2 * step
    out, last = [], 0
    for i in (np.flatnonzero((h >> np.uint32(16)) & np.uint32(mask) == 0) + 1).tolist():
        while i < len(text) and text[i] & 0xC0 == 0x80:  # never inside a code point
            i += 1
        if i - last >= MIN_CHUNK and i < len(text):
            out.append(i)
            last = i
    return [*out, len(text)]


class Part(NamedTuple):
    """A chunk's first two words (their bytes and ids, the ids of the second), what is between, and its last two (the ids of the first of them)."""

    head: bytes
    head_ids: bytes
    second: bytes
    body_ids: bytes
    tail: bytes
    tail_ids: bytes
    last_but_one: bytes


class ChunkEncoder:
    def __init__(self, path: str = bpe.DEFAULT_PATH, cache_bytes: int = 24 << 20, pieces: int = 150_000):
        self.enc, self.room = bpe.Encoder(path, pieces), cache_bytes
        self.new: dict[bytes, Part | None] = {}
        self.old: dict[bytes, Part | None] = {}
        self.held = self.hits = self.misses = self.grown = 0

    def chunk(self, chunk: bytes) -> Part | None:
        key = hashlib.blake2b(chunk, digest_size=16).digest()
        if key in self.new:
            self.hits += 1
            return self.new[key]
        if key in self.old:
            self.hits += 1
            got = self.old[key]
        else:
            self.misses += 1
            got = self.part(chunk)
        self.held += 300 + (sum(map(len, got)) if got else 0)
        if 2 * self.held > self.room:
            self.old, self.new, self.held = self.new, {}, 0
        self.new[key] = got
        return got

    def part(self, chunk: bytes) -> Part | None:
        """The chunk encoded by itself; None if it has fewer than four words."""
        first, last = chunk.split(None, 2), chunk.rsplit(None, 2)
        if len(first) < 3 or len(last) < 3:
            return None
        lo, hi = len(chunk) - len(first[2]), len(last[0])
        if lo > hi and len(chunk.split(None, 4)) < 4:
            return None
        enc = self.enc.encode
        head, tail = chunk[:lo], chunk[hi:]
        return Part(head, enc(head), enc(first[1]), enc(chunk[lo:hi]), tail, enc(tail), enc(last[1]))

    def joined(self, a: Part, b: Part) -> bytes | None:
        """Ids of the words around a join, if they agree with both chunks at the outer words."""
        got = self.enc.encode(a.tail + b.head)
        return got if got.startswith(a.last_but_one) and got.endswith(b.second) else None

    def encode(self, text: bytes) -> bytes:
        if not self.enc.by_piece:
            return self.enc.encode(text)
        parts: list[tuple[int, int, Part]] = []
        start = 0
        for end in cut_points(text):
            got = self.chunk(text[start:end])
            if got is not None:
                parts.append((start, end, got))
                start = end
        if start < len(text):  # too short to stand alone: it grows over the chunk before it
            start = parts.pop()[0] if parts else 0
            got = self.chunk(text[start:]) if start else None
            if got is None:
                return self.enc.encode(text)
            parts.append((start, len(text), got))
        if not parts:
            return b""
        out = [parts[0][2].head_ids, parts[0][2].body_ids]
        for (lo, _, a), (_, hi, b) in pairwise(parts):
            ids = self.joined(a, b)
            if ids is None:
                self.grown += 1
                both = self.enc.encode(text[lo:hi])
                if not (both.startswith(a.head_ids + a.body_ids) and both.endswith(b.body_ids + b.tail_ids)):
                    return self.enc.encode(text)
                ids = both[len(a.head_ids + a.body_ids) : len(both) - len(b.body_ids + b.tail_ids)]
            out += [ids, b.body_ids]
        return b"".join([*out, parts[-1][2].tail_ids])


_held: dict[str, ChunkEncoder] = {}


def chunk_encoder(path: str) -> ChunkEncoder:
    """One for each worker process, so that its cache outlives a task."""
    if path not in _held:
        _held[path] = ChunkEncoder(path)
    return _held[path]


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = bpe.DEFAULT_PATH, digests_only: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, and unless ``digests_only`` also ids and decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = chunk_encoder(tokenizer)
        for b in (part for whole in batches for part in storage.bounded(whole, 1, BATCH)):
            cols: list[list] = [[], [], [], [], []]
            for t in b.column(1).to_pylist():
                ids = enc.encode(t) if t else b""
                nums = np.frombuffer(ids, "<u4")
                text = enc.enc.decode(nums)
                cols[0].append(len(nums))
                cols[1].append(hashlib.sha256(ids).hexdigest())
                cols[2].append(hashlib.sha256(text).hexdigest())
                if not digests_only:
                    cols[3].append(nums)
                    cols[4].append(text)
            arrays = [b.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if not digests_only:
                arrays += [pa.array([x.astype(np.int32) for x in cols[3]], pa.list_(pa.int32())), pa.array(cols[4], pa.binary()).cast(pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ("" if digests_only else ", ids array<int>, decoded string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, schema)
