"""Packing of tokenized documents into as few sequences of a fixed length as can be, by a configuration linear program.

Every document is its ids and an end id. One that is longer than a sequence is cut into whole sequences, its first piece taking what is over; no other is cut.
The number of pieces of each length is a table of ``capacity`` rows at most, whatever the corpus, and all that the driver gets. A configuration is
a set of lengths that fit into a sequence. Multiplicative weights solve the program that covers every length with the fewest
configurations: a length's price falls as it is covered, and a knapsack by dynamic programming finds the dearest configuration at
present prices. Weights are rounded to whole numbers, as far as pieces are left, and what remains goes, longest first, where it fits best;
short pieces that are left to the end fill what others can't, so smaller shares of the weights are tried too.
Pieces are then ranked within their length, and a piece's rank names its sequence and offset: nothing is packed in one place.

A null text is empty, and has the end id alone. Null ids come first, equal ids and repeated rows are documents each. An empty
table gives no rows; extra columns are ignored. A task holds ``BATCH`` bytes of texts with their ids, or one longer text."""

from __future__ import annotations

import base64
import bisect
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import storage
from .ordering import ranked

TOKENIZER, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
CAPACITY, END_ID = 2048, 0
SHARES = (1.0, 0.75, 0.5, 0.25, 0.1)  # of the program's weights that are rounded; the fewest sequences count
BATCH = 4 << 20
# What both libraries part alike: characters whose classes have long been settled, and no long white space, in which a pattern may run out of steps.
_OTHER = re.compile("[\x1c-\x1f\x85\u0250-\u200f\u2028-\u202f\u2030-\u20ab\u20ad-\U0010ffff]|\\s{500}")


class Encoder:
    """Ids of byte-level BPE as the tokenizers library gives them. Texts of settled characters go through the same vocabulary as ranks, which is eight times as fast."""

    def __init__(self, tokenizer: str = TOKENIZER, ranks: str | None = RANKS):
        import tiktoken
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(tokenizer)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.quick = None
        if ranks is not None:
            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            special = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
            self.quick = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        if self.quick is not None and not _OTHER.search(text):
            return self.quick.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4")


_held: dict[tuple, Encoder] = {}


def _encoder(*paths) -> Encoder:
    if paths not in _held:
        _held.clear()
        _held[paths] = Encoder(*paths)
    return _held[paths]


def cuts(n: int, capacity: int) -> list[int]:
    """Where the pieces of n ids begin, and n."""
    first = n % capacity or min(n, capacity)
    return [0, *range(first, n + 1, capacity)] if n else [0]


PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, ids binary"


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True, tokenizer: str = TOKENIZER, ranks: str | None = RANKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's pieces; ``ids`` are little-endian unsigned 32-bit integers, null unless asked for."""
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in PIECES.split(", ")]

    def run(batches):
        enc, end = _encoder(tokenizer, ranks), np.array([end_id], "<u4")
        for whole in batches:
            for b in storage.bounded(whole, 1, BATCH):
                out = []
                for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    ids = np.concatenate([enc.ids(text), end]) if text else end
                    at = cuts(len(ids), capacity)
                    for k, (lo, hi) in enumerate(zip(at, at[1:], strict=False)):
                        raw = ids[lo:hi].tobytes()
                        out.append((doc, k, lo, hi - lo, zlib.crc32(raw), raw if with_ids else None))
                cols = list(zip(*out, strict=True)) or [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, PIECES)


def knapsack(price: np.ndarray) -> np.ndarray:
    """The dearest set of lengths within every room; ``price`` by length, -inf for a length that there is not."""
    best = np.zeros(len(price))
    for room in range(1, len(price)):
        best[room] = max(best[room - 1], (price[1 : room + 1] + best[room - 1 :: -1]).max())
    return best


def configuration(price: np.ndarray, best: np.ndarray, stock: np.ndarray) -> dict[int, int]:
    """Back along ``best`` from a whole sequence, as far as the stock allows."""
    price, room, out = price.copy(), len(price) - 1, {}
    while room:
        n = int((price[1 : room + 1] + best[room - 1 :: -1]).argmax()) + 1
        if price[n] == -np.inf:
            break
        out[n] = out.get(n, 0) + 1
        if out[n] == stock[n]:
            price[n] = -np.inf
        room -= n
    return out


def fractional(stock: np.ndarray, passes: int = 2, rate: float = 0.3, refresh: int = 64) -> tuple[list[tuple[float, dict[int, int]]], float]:
    """(weights and configurations, a bound that no packing is below). Each step takes the dearest configuration as often as its scarcest length allows; a length's
    price falls by ``exp(-rate)`` each time that its pieces are covered. It ends when the steps have covered all tokens ``passes`` times; the weights are for one."""
    size = np.arange(len(stock))
    have = stock > 0
    price = np.where(have, size / (len(stock) - 1), -np.inf)
    weights: dict[tuple, float] = {}
    goal, covered, step, bound = passes * int((size * stock).sum()), 0.0, 0, 0.0
    while covered < goal:
        if step % refresh == 0:
            best = knapsack(price)
            bound = max(bound, float((stock[have] * price[have]).sum()) / best[-1])
        took = configuration(price, best, stock)
        times = min(stock[n] / k for n, k in took.items())
        key = tuple(sorted(took.items()))
        weights[key] = weights.get(key, 0.0) + times / passes
        for n, k in took.items():
            price[n] *= np.exp(-rate * times * k / stock[n])
            covered += times * k * n
        step += 1
    return [(w, dict(k)) for k, w in weights.items()], bound


def rounded(stock: np.ndarray, weights: list[tuple[float, dict[int, int]]]) -> list[tuple[int, dict[int, int]]]:
    """(times, configuration) that use up the stock: weights to the nearest whole number while pieces are left, greatest first, then the rest where it fits best."""
    left, capacity = stock.copy(), len(stock) - 1
    bins: list[tuple[int, dict[int, int]]] = []
    for w, took in sorted(weights, key=lambda x: (-x[0], sorted(x[1].items()))):
        times = min(round(w), *(int(left[n]) // k for n, k in took.items()))
        if times:
            bins.append((times, took))
            for n, k in took.items():
                left[n] -= times * k
    rooms: dict[int, list[tuple[int, dict[int, int]]]] = {}
    for times, took in bins:
        rooms.setdefault(capacity - sum(n * k for n, k in took.items()), []).append((times, took))
    order = sorted(rooms)

    def put(room: int, times: int, took: dict[int, int]) -> None:
        if room not in rooms or not rooms[room]:
            rooms.setdefault(room, [])
            i = bisect.bisect_left(order, room)
            if i == len(order) or order[i] != room:
                order.insert(i, room)
        rooms[room].append((times, took))

    for n in range(capacity, 0, -1):
        while left[n]:
            i = bisect.bisect_left(order, n)
            while i < len(order) and not rooms[order[i]]:
                order.pop(i)
            if i < len(order):
                room = order[i]
                times, took = rooms[room].pop()
                use = min(times, int(left[n]))
                if use < times:
                    rooms[room].append((times - use, took))
                put(room - n, use, took | {n: took.get(n, 0) + 1})
                left[n] -= use
            else:
                each = min(capacity // n, int(left[n]))
                put(capacity - each * n, int(left[n]) // each, {n: each})
                left[n] %= each
    return [x for room in sorted(rooms) for x in rooms[room]]


def solve(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, dict[int, int]]], int]:
    """Whole sequences for these numbers of pieces by length, and a bound that no packing is below."""
    stock = np.zeros(capacity + 1, np.int64)
    for n, k in counts.items():
        stock[n] = k
    if not stock.any():
        return [], 0
    weights, bound = fractional(stock)
    whole = int((np.arange(capacity + 1) * stock).sum())
    tries = [rounded(stock, [(w * share, took) for w, took in weights]) for share in SHARES]
    return min(tries, key=lambda bins: sum(times for times, _ in bins)), max(-(-whole // capacity), int(np.ceil(bound - 1e-6)))


class Slots:
    """The places of all pieces of a length, one after the other."""

    def __init__(self, bins: list[tuple[int, dict[int, int]]], capacity: int):
        rows, base = [], 0
        for times, took in bins:
            at = 0
            for n, k in sorted(took.items(), reverse=True):
                rows.append((n, base, at, k, times))
                at += n * k
            base += times
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 5)
        self.lengths, self.base, self.at, self.each = table[:, 0], table[:, 1], table[:, 2], table[:, 3]
        self.begin = np.concatenate([[0], np.cumsum(self.each * table[:, 4])])
        self.first = self.begin[np.searchsorted(self.lengths, np.arange(capacity + 1))]

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the rank-th pieces of lengths."""
        slot = self.first[length] + rank
        i = np.searchsorted(self.begin, slot, "right") - 1
        copy, which = np.divmod(slot - self.begin[i], self.each[i])
        return self.base[i] + copy, self.at[i] + which * length


def pack(rows: DataFrame, folder: str, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces. They are written below ``folder``; the driver gets a number for each length."""
    rows = storage.staged(rows, f"{folder}/pieces")
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}  # `capacity` rows at most
    slots = Slots(solve(counts, capacity)[0], capacity)
    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    spread = ranked(rows, ["length"], ["doc_id", "piece", "ids_crc32"], f"{folder}/order").select(*rows.columns, "rank")

    def run(batches):
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            at = slots.places(length, rank)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *map(pa.array, at)], names=[*b.schema.names[:-1], "sequence_id", "offset"])

    return spread.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids, doc_ids, offsets): whole training rows, from packed pieces that have their ids. A group holds one sequence."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    got = packed.groupBy("sequence_id").agg(F.sum("length").cast("int").alias("length"), parts.alias("parts"))
    ids = F.aggregate("parts", F.lit(b"").cast("binary"), lambda all_, p: F.concat(all_, p["ids"]))
    return got.select("sequence_id", "length", ids.alias("ids"), F.col("parts.doc_id").alias("doc_ids"), F.col("parts.offset").alias("offsets"))
