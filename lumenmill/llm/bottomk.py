"""Bottom-k sketches of word shingles.

A text's sketch is the ``k`` smallest distinct 64-bit hashes of its shingles of ``SHINGLE`` words (A-Z
lower-cased, white space by ASCII rules; a shorter text is one shingle, a text without words
has an empty sketch). The sketch of a union is the ``k`` smallest of the merged sketches, so parts can be sketched apart;
below ``k`` hashes a sketch is the whole set and every estimate is exact.

``edited_likeness`` orders documents by id (null ids first, equal ids by a hash of their texts, then by text) and compares each with an edit of
itself and with the next one; after the last comes the first, and a single document is its own next. A null text is
empty. An empty table gives none; extra columns are ignored. Two empty sketches are alike (1), an empty and
another are not (0). Texts are hashed in runs of ``RUN`` bytes, so a task holds ``BATCH`` bytes of texts, or one longer text,
and eight bytes for each of its words."""

from __future__ import annotations

import base64
import hashlib
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import storage
from .ordering import bucket_bounds, bucket_of, place_of, shuffle_partitions

SHINGLE, K = 5, 128
RUN, BATCH = 1 << 16, 2 << 20
_ODD = 0x9E3779B97F4A7C15
_SPACES = (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _powers(base: int) -> np.ndarray:
    x = np.full(RUN + 1, base, np.uint64)
    x[0] = 1
    return np.multiply.accumulate(x)


_UP, _DOWN = _powers(_ODD), _powers(pow(_ODD, -1, 1 << 64))  # powers of an odd number and of its inverse modulo 2^64


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ h >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ h >> np.uint64(33)


def _runs(text: bytes):
    """Consecutive parts of a text that end at white space, of ``RUN`` bytes at most; a longer word is a part of its own."""
    at = 0
    while at < len(text):
        end = at + RUN
        if end < len(text):
            space = max(map(text.rfind, _SPACES, repeat(at), repeat(end)))
            if space < at:
                after = [x for x in map(text.find, _SPACES, repeat(end)) if x >= 0]
                space = min(after, default=len(text) - 1)
            end = space + 1
        yield text[at:end]
        at = end


def _word_hashes(part: bytes) -> np.ndarray:
    b = np.frombuffer(part, np.uint8)
    space = np.concatenate([[True], _SPACE[b], [True]])
    starts = np.flatnonzero(space[:-1] & ~space[1:])
    ends = np.flatnonzero(~space[:-1] & space[1:])
    if len(b) <= RUN:
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * _UP[: len(b)])])
        h = (sums[ends] - sums[starts]) * _DOWN[starts]
    else:  # one long word
        total, lo, hi = 0, int(starts[0]), int(ends[0])
        for k, i in enumerate(range(lo, hi, RUN)):
            x = b[i : min(i + RUN, hi)].astype(np.uint64) + np.uint64(1)
            total += int((x * _UP[: len(x)]).sum(dtype=np.uint64)) * pow(_ODD, k * RUN, 1 << 64)
        h = np.array([total % (1 << 64)], np.uint64)
    return _mix(h + (ends - starts).astype(np.uint64))


def shingle_hashes(text: bytes, width: int = SHINGLE) -> np.ndarray:
    words = np.concatenate([np.zeros(0, np.uint64), *map(_word_hashes, _runs(text.lower()))])
    if not len(words):
        return words
    width = min(width, len(words))
    h = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        h = h * np.uint64(0xD6E8FEB86659FD93) + words[i : i + len(h)]
    return _mix(h)


def sketch(text: bytes, k: int = K) -> np.ndarray:
    h = shingle_hashes(text)
    if len(h) > 8 * k:  # repeats are few as a rule: cut before the sort, and check
        low = np.unique(np.partition(h, 4 * k)[: 4 * k])
        if len(low) >= k:
            return low[:k]
    return np.unique(h)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = merge(a, b, k)
    return len(np.intersect1d(np.intersect1d(both, a, True), b, True)) / len(both)


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) * 2.0**64 / (float(a[k - 1]) + 1)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct(merge(a, b, k), k) / distinct(a, k))


def pack(a: np.ndarray) -> str:
    return base64.b64encode(a.astype("<u8").tobytes()).decode()


def unpack(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), "<u8")


def merged_sketches(sketches: DataFrame, group_col: str, sketch_col: str = "fingerprint", k: int = K, salts: int = 64) -> DataFrame:
    """(group, fingerprint) of each group's union; a hot group is first merged in ``salts`` parts, each in a running sketch."""

    def fold(batches):
        held: dict = {}
        for b in batches:
            for g, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held[g] = merge(held[g], unpack(s), k) if g in held else unpack(s)
            if len(held) > 10_000:
                yield pa.RecordBatch.from_pylist([{"g": g, "s": pack(x)} for g, x in held.items()], schema=schema)
                held.clear()
        if held:
            yield pa.RecordBatch.from_pylist([{"g": g, "s": pack(x)} for g, x in held.items()], schema=schema)

    schema = pa.schema([("g", pa.string()), ("s", pa.string())])
    rows = sketches.select(F.col(group_col).cast("string").alias("g"), F.col(sketch_col).alias("s")).filter("s is not null")
    part = rows.mapInArrow(fold, "g string, s string").repartition(salts, "g", F.pmod(F.xxhash64("s"), F.lit(salts))).mapInArrow(fold, "g string, s string")
    return part.repartition("g").sortWithinPartitions("g").mapInArrow(fold, "g string, s string").select(F.col("g").alias("group"), F.col("s").alias("fingerprint"))


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_shingles double, contained_edited double, contained_next double"


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edit: the last quarter of its code points gives way to the start of the next document's text.
    ``near_*`` estimate resemblance, ``contained_*`` the share of the text's shingles that the other has, ``n_shingles`` how many distinct ones it has."""
    n = shuffle_partitions(docs)
    docs = docs.select(place_of(id_col).alias("place"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    docs = docs.withColumn("tie", F.xxhash64("text"))
    own = docs.withColumn("bucket", bucket_of(F.col("place"), F.col("tie"), bucket_bounds(docs, "place", 4 * n)))
    rows = own.select("bucket", F.lit(0).alias("tail"), "place", "tie", "doc_id", "text")
    firsts = own.groupBy("bucket").agg(F.min(F.struct("place", "tie")).alias("f"))  # a row for each bucket
    order = Window.orderBy("bucket")
    to = firsts.select(F.col("f.place").alias("place"), F.col("f.tie").alias("tie"), F.coalesce(F.lag("bucket").over(order), F.max("bucket").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("bucket"))  # the first document follows the bucket before it
    heads = docs.join(F.broadcast(to), ["place", "tie"]).groupBy("bucket", "place", "tie").agg(F.min("text").alias("text"))
    rows = rows.union(heads.select("bucket", F.lit(1), "place", "tie", F.lit(None).cast("long"), "text"))
    dealt = rows.repartition(n, "bucket").sortWithinPartitions("bucket", "tail", "place", "tie", "text")

    def compared(held, text, mark):
        key, before, own = held
        chars = before.decode("utf-8")
        cut = len(chars) // 4
        edited = (chars[: len(chars) - cut] + text.decode("utf-8")[:cut]).encode()
        other = own if edited == before else sketch(edited)
        return key, len(chars), hashlib.sha256(edited).hexdigest(), pack(own), pack(other), resemblance(own, other), resemblance(own, mark), distinct(own), containment(own, other), containment(own, mark)

    def run(batches):
        held = None
        for whole in batches:
            for b in storage.bounded(whole, 2, BATCH):
                out: list[tuple] = []
                for tail, key, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    mark = sketch(text)
                    if held is not None:
                        out.append(compared(held, text, mark))
                    held = None if tail else (key, text, mark)
                types = [pa.float64() if x.endswith("double") else pa.string() if x.endswith("string") else pa.int64() for x in SCHEMA.split(", ")]
                cols = list(zip(*out, strict=True)) or [()] * len(types)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return dealt.select("tail", "doc_id", "text").mapInArrow(run, SCHEMA)
