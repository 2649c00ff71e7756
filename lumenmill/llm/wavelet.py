"""Token ids on disk as wavelet-matrix files.

A shard is one file: document ids and lengths, and one bit-plane for each bit of a token id,
most significant first, each plane a stable partition of the one before (zeros, then ones). A plane
has a rank directory, the ones before every block of 512 bits, and two select directories, the block of every 1024th
one and zero. Planes are compressed in pieces of ``PIECE`` bytes. ``access``, ``rank``, ``count``, ``select`` and
``occurrences`` read directories and the pieces they touch, from a file by its ranges; ``decode`` restores all ids in order.

``write_token_shards(docs)`` encodes every text (null: empty; null ids sort first; rows with
equal ids are ordered by a hash of their texts and all kept), appends ``end_id`` to each document
and writes shards in ascending order of the id. An empty table gives no shard. Extra columns
are ignored. ``read_token_shards(manifest)`` gives one row per document, ``count_tokens`` and ``find_token`` answer from all shards, each from the files alone.
Memory of a task: ``BATCH`` bytes of text with their ids, then one shard (``shard_tokens`` ids, or one document if it is longer)."""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe, storage
from .ordering import bucket_bounds, bucket_of, place_of, shuffle_partitions

MAGIC = b"LMWVM002"
BLOCK, SELECT, PIECE, BATCH = 512, 1024, 1 << 15, 2 << 20
MANIFEST = "bucket int, seq int, path string, n_docs long, n_tokens long"


class Planes:
    """Bit-planes in compressed pieces; a piece is inflated when it is first touched. ``fetch(start, size)`` gives bytes of the pieces' area."""

    def __init__(self, sizes: list[list[int]], fetch: Callable[[int, int], bytes]):
        self.sizes, self.fetch = sizes, fetch
        at, self.starts = 0, []
        for level in sizes:
            self.starts.append([])
            for size in level:
                self.starts[-1].append(at)
                at += size
        self.held: dict[tuple[int, int], np.ndarray] = {}

    def piece(self, level: int, k: int) -> np.ndarray:
        if (level, k) not in self.held:
            raw = self.fetch(self.starts[level][k], self.sizes[level][k])
            self.held[level, k] = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
        return self.held[level, k]

    def whole(self, level: int) -> np.ndarray:
        raw = self.fetch(self.starts[level][0], sum(self.sizes[level])) if self.sizes[level] else b""
        out, at = [], 0
        for size in self.sizes[level]:
            out.append(zstandard.ZstdDecompressor().decompress(raw[at : at + size]))
            at += size
        return np.frombuffer(b"".join(out), np.uint8)

    def blocks(self, level: int, numbers: np.ndarray) -> np.ndarray:
        """A row of 512 bits for every block number."""
        out = np.zeros((len(numbers), BLOCK // 8), np.uint8)
        place, inside = numbers // (PIECE * 8 // BLOCK), numbers % (PIECE * 8 // BLOCK)
        for k in np.unique(place).tolist():
            if k >= len(self.sizes[level]):
                continue  # past the last bit: zeros
            data = self.piece(level, k)
            if len(data) % (BLOCK // 8):
                data = np.concatenate([data, np.zeros(-len(data) % (BLOCK // 8), np.uint8)])
            rows = data.reshape(-1, BLOCK // 8)
            mine = np.flatnonzero(place == k)
            there = mine[inside[mine] < len(rows)]
            out[there] = rows[inside[there]]
        return np.unpackbits(out, axis=1, bitorder="little")


class WaveletFile:
    """A shard. Positions count from 0; ``rank`` is over [0, i); ``select(s, k)`` is the place of the k-th s from 0, or -1."""

    def __init__(self, head: dict, directories: bytes, fetch: Callable[[int, int], bytes]):
        self.n, self.zeros = head["n"], head["zeros"]
        self.planes = Planes(head["planes"], fetch)
        out, at = [], 0
        for size, kind in zip(head["sizes"], ["<i8", "<u4", "u1", *["<u4"] * (3 * len(self.zeros))], strict=True):
            out.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(directories[at : at + size]), kind))
            at += size
        self.doc_ids, self.lengths, self.null_ids = out[:3]
        levels = len(self.zeros)
        self.dirs, self.ones_at, self.zeros_at = out[3 : 3 + levels], out[3 + levels : 3 + 2 * levels], out[3 + 2 * levels :]

    @staticmethod
    def build(ids: np.ndarray, doc_ids: np.ndarray, lengths: np.ndarray, null_ids: np.ndarray | None = None) -> list[bytes]:
        """Parts of the file of these ids."""
        press = zstandard.ZstdCompressor(level=1).compress
        levels = max(1, int(ids.max(initial=0)).bit_length())
        x = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        zeros, dirs, ones_at, zeros_at, sizes, pieces = [], [], [], [], [], []
        for k in range(levels - 1, -1, -1):
            one = (x & x.dtype.type(1 << k)) != 0
            plane = np.packbits(one, bitorder="little")
            zeros.append(len(x) - int(np.count_nonzero(one)))
            dirs.append(_directory(plane))
            ones_at.append(_every(dirs[-1]))
            zeros_at.append(_every(_zeros_before(dirs[-1], len(x))))
            packed = [press(plane[i : i + PIECE].tobytes()) for i in range(0, len(plane), PIECE)]
            sizes.append([len(p) for p in packed])
            pieces += packed
            x = np.concatenate([x.take(np.flatnonzero(~one)), x.take(np.flatnonzero(one))])
        nulls = np.zeros(len(doc_ids), np.uint8) if null_ids is None else null_ids
        small = [press(a.tobytes()) for a in (doc_ids.astype("<i8"), lengths.astype("<u4"), nulls, *dirs, *ones_at, *zeros_at)]
        head = json.dumps({"n": len(ids), "zeros": zeros, "sizes": [len(s) for s in small], "planes": sizes}).encode()
        return [MAGIC, struct.pack("<II", len(head), sum(map(len, small))), head, *small, *pieces]

    @classmethod
    def parse(cls, data: bytes) -> WaveletFile:
        return cls.read(lambda start, size: data[start : start + size])

    @classmethod
    def open(cls, uri: str) -> WaveletFile:
        """From a file in shared storage: head and directories now, pieces of planes when they are needed."""
        return cls.read(lambda start, size: storage.get_range(uri, start, size))

    @classmethod
    def read(cls, fetch: Callable[[int, int], bytes]) -> WaveletFile:
        start = fetch(0, 16)
        if start[:8] != MAGIC:
            raise ValueError("not a token shard")
        head, small = struct.unpack_from("<II", start, 8)
        raw, base = fetch(16, head + small), 16 + head + small
        return cls(json.loads(raw[:head]), raw[head:], lambda at, size: fetch(base + at, size))

    def _ones(self, level: int, i: np.ndarray) -> np.ndarray:
        """Ones in [0, i) of a plane: the directory, then fewer than 512 bits."""
        block = i // BLOCK
        bits = self.planes.blocks(level, block)
        return self.dirs[level][block].astype(np.int64) + (bits * (np.arange(BLOCK) < (i - block * BLOCK)[:, None])).sum(axis=1, dtype=np.int64)

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes.blocks(level, np.array([i // BLOCK]))[0, i % BLOCK])

    def access(self, i: int) -> int:
        value = 0
        for level, zeros in enumerate(self.zeros):
            bit, ones = self._bit(level, i), int(self._ones(level, np.array([i]))[0])
            value, i = value << 1 | bit, zeros + ones if bit else i - ones
        return value

    def _down(self, symbol: int, i: int, j: int) -> tuple[int, int]:
        """The symbol's places below the last plane, of those in [i, j)."""
        if symbol < 0 or symbol >> len(self.zeros):
            return 0, 0
        ends = np.array([i, j], np.int64)
        for level, zeros in enumerate(self.zeros):
            ones = self._ones(level, ends)
            ends = zeros + ones if symbol >> (len(self.zeros) - 1 - level) & 1 else ends - ones
        return int(ends[0]), int(ends[1])

    def rank(self, symbol: int, i: int) -> int:
        a, b = self._down(symbol, 0, i)
        return b - a

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.n)

    def _up(self, level: int, bit: int, ranks: np.ndarray) -> np.ndarray:
        """Places of the ``ranks``-th bits of a plane: the select directory bounds the block, the rank directory names it, its bits give the place."""
        before = self.dirs[level].astype(np.int64) if bit else _zeros_before(self.dirs[level], self.n).astype(np.int64)
        sample = (self.ones_at if bit else self.zeros_at)[level].astype(np.int64)
        lo = sample[ranks // SELECT]
        hi = np.append(sample, len(before) - 2)[ranks // SELECT + 1]
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            up = before[mid] <= ranks
            lo, hi = np.where(up, mid, lo), np.where(up, hi, mid - 1)
        bits = self.planes.blocks(level, lo) == bit
        return lo * BLOCK + (np.cumsum(bits, axis=1) > (ranks - before[lo])[:, None]).argmax(axis=1)

    def _selected(self, symbol: int, lo: int, hi: int) -> np.ndarray:
        a, b = self._down(symbol, 0, self.n)
        at = np.arange(a + max(lo, 0), min(a + hi, b), dtype=np.int64)
        for level in range(len(self.zeros) - 1, -1, -1):
            bit = symbol >> (len(self.zeros) - 1 - level) & 1
            at = self._up(level, bit, at - self.zeros[level] if bit else at) if len(at) else at
        return at

    def select(self, symbol: int, k: int) -> int:
        got = self._selected(symbol, k, k + 1) if k >= 0 else ()
        return int(got[0]) if len(got) else -1

    def occurrences(self, symbol: int, most: int = 4096):
        """Every place of a symbol, rising, ``most`` in an array."""
        for k in range(0, self.count(symbol), most):
            yield self._selected(symbol, k, k + most)

    def decode(self) -> np.ndarray:
        """All ids: from the last plane up, each partition is undone."""
        levels = len(self.zeros)
        x = np.zeros(self.n, np.uint16 if levels <= 16 else np.uint32)
        for k, level in enumerate(range(levels - 1, -1, -1)):
            one = np.unpackbits(self.planes.whole(level), count=self.n, bitorder="little").view(bool)
            x[self.zeros[level] :] |= x.dtype.type(1 << k)
            up = np.empty_like(x)
            up[np.flatnonzero(~one)] = x[: self.zeros[level]]
            up[np.flatnonzero(one)] = x[self.zeros[level] :]
            x = up
        return x


def _directory(plane: np.ndarray) -> np.ndarray:
    """Ones before each block of 512 bits, and in all."""
    counts = np.bitwise_count(plane)
    full = np.zeros((len(plane) + 63) // 64 * 64, np.uint8)
    full[: len(counts)] = counts
    return np.concatenate([[0], np.cumsum(full.reshape(-1, 64).sum(axis=1, dtype=np.uint32))]).astype("<u4")


def _zeros_before(ones: np.ndarray, n: int) -> np.ndarray:
    """The same of zeros."""
    return (np.minimum(np.arange(len(ones), dtype=np.int64) * BLOCK, n) - ones).astype("<u4")


def _every(before: np.ndarray) -> np.ndarray:
    """The block of every 1024th counted bit."""
    return (np.searchsorted(before, np.arange(0, max(int(before[-1]), 1), SELECT), "right") - 1).astype("<u4")


def write_token_shards(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = bpe.DEFAULT_PATH, end_id: int = 1, shard_tokens: int = 1 << 21) -> DataFrame:
    """Write the shards into ``folder``; returns their manifest, read from shared storage."""
    n = shuffle_partitions(docs)
    docs = docs.select(place_of(id_col).alias("place"), F.col(id_col).isNull().alias("no_id"), F.col(text_col).cast("binary").alias("text")).withColumn("tie", F.xxhash64(F.coalesce("text", F.lit(b""))))
    bounds = bucket_bounds(docs, "place", 4 * n)

    def encode(batches):
        enc = bpe.encoder(tokenizer, None, end_id)
        end = np.array([end_id], enc.dtype).tobytes()
        for whole in batches:
            for b in storage.bounded(whole, 4, BATCH):
                ids = [enc.encode(t) + end if t else end for t in b.column(4).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(4)), pa.array(ids, pa.binary()), pa.array([enc.dtype.itemsize] * len(ids), pa.int32())], names=["bucket", "place", "no_id", "tie", "ids", "width"])

    encoded = docs.select(bucket_of(F.col("place"), F.col("tie"), bounds).alias("bucket"), "place", "no_id", "tie", "text").mapInArrow(encode, "bucket int, place long, no_id boolean, tie long, ids binary, width int")
    ordered = encoded.repartition(n, "bucket").sortWithinPartitions("bucket", "place", F.desc("no_id"), "tie", "ids")

    def write(batches):
        bpe.release()
        bucket, seq, held, count = None, 0, [], 0

        def flush():
            ids = np.concatenate([np.frombuffer(x, f"<u{w}") for _, _, x, w in held])
            keys = np.array([k for k, *_ in held], np.int64)
            nulls = np.array([no for _, no, *_ in held], np.uint8)
            return storage.put_file(folder, f"tokens-{bucket:06d}-{seq:06d}.wvm", WaveletFile.build(ids, keys, np.array([len(x) // w for _, _, x, w in held]), nulls))

        def row():
            return pa.RecordBatch.from_pylist([{"bucket": bucket, "seq": seq, "path": flush(), "n_docs": len(held), "n_tokens": count}], schema=_SCHEMA)

        for whole in batches:
            for b in storage.bounded(whole, 3, BATCH):
                for g, key, no_id, ids, width in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    size = len(ids) // width
                    if held and (g != bucket or count + size > shard_tokens):
                        yield row()
                        seq, held, count = (seq + 1 if g == bucket else 0), [], 0
                    bucket = g
                    held.append((key, no_id, ids, width))
                    count += size
        if held:
            yield row()

    rows = ordered.select("bucket", "place", "no_id", "ids", "width").mapInArrow(write, MANIFEST)
    return storage.staged(rows.repartition(max(1, n // 16), "path"), f"{folder}/manifest")  # a row for each shard: few files, none written beside the encoded ids


_SCHEMA = pa.schema([("bucket", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])


def with_starts(manifest: DataFrame) -> DataFrame:
    """Adds the number of ids before each shard. One task adds up a number for each bucket (a few times the shuffle partitions), whatever the data."""
    sums = manifest.groupBy("bucket").agg(F.sum("n_tokens").alias("n"))
    base = sums.select("bucket", F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    w = Window.partitionBy("bucket").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.join(F.broadcast(base), "bucket").withColumn("start", F.col("base") + F.coalesce(F.sum("n_tokens").over(w), F.lit(0))).drop("base")


def _on_shards(manifest: DataFrame, answer, schema: str) -> DataFrame:
    """What ``answer(path, start)`` yields of every shard."""

    def run(batches):
        bpe.release()
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                yield from answer(path, start)

    return with_starts(manifest).select("path", "start").repartition(shuffle_partitions(manifest), "path").mapInArrow(run, schema)


def read_token_shards(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian unsigned 32-bit integers, from the files."""

    def documents(path, start):
        f = WaveletFile.open(path)
        ids = f.decode()
        ends = np.cumsum(f.lengths, dtype=np.int64)
        begins = ends - f.lengths
        crc = [zlib.crc32(ids[i:j].astype("<u4")) for i, j in zip(begins.tolist(), ends.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(f.doc_ids, mask=f.null_ids.astype(bool)), pa.array(begins + start), pa.array(f.lengths.astype(np.int64)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return _on_shards(manifest, documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def count_tokens(manifest: DataFrame, tokens: list[int]) -> DataFrame:
    """(token, n): how often each of some tokens stands in all shards, from their directories and two paths down the planes."""

    def counts(path, _):
        f = WaveletFile.open(path)
        yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array([f.count(t) for t in tokens], pa.int64())], names=["token", "n"])

    return _on_shards(manifest, counts, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def find_token(manifest: DataFrame, token: int) -> DataFrame:
    """(doc_id, place, position): every occurrence of a token, its place in its document and its position among all ids."""

    def places(path, start):
        f = WaveletFile.open(path)
        ends = np.cumsum(f.lengths, dtype=np.int64)
        for at in f.occurrences(token):
            d = np.searchsorted(ends, at, "right")
            yield pa.RecordBatch.from_arrays([pa.array(f.doc_ids[d], mask=f.null_ids[d].astype(bool)), pa.array(at - (ends - f.lengths)[d]), pa.array(at + start)], names=["doc_id", "place", "position"])

    return _on_shards(manifest, places, "doc_id long, place long, position long")
