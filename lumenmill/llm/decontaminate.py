"""Benchmark decontamination with suffix arrays.

Documents are read in shards: consecutive rows of ``shard_bytes`` together, every document whole; a longer one is a shard of its own. A shard's
suffix array is an integer array of word positions, sorted by the ``depth`` words that follow (the window's length); positions whose first ``SEED``
words, hashed, start no test suffix are left out, since no match of that length begins there; a document without such a match has its one or two words bisected in the test array. Test texts lie in block files with their own full suffix array.
All test suffixes of a block are searched in the shard's array by bisection, in one call of sorted keys: windows give the ranges of their
occurrences, and the neighbours in the merged order the longest match at every place. A match that fills the depth is followed to its end by
bisecting the test array with range hashes, and compared word by word before it is reported.

Words: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z is lower-cased. A window is ``window`` consecutive
words of an item, or the whole item if it is shorter, but not empty. A document's longest match counts from one word on; among equals the first in the document is told, with its item and its place there.

A worker holds one block at a time (``block_words`` words, or one longer item) and takes all shards of an Arrow batch through it before the next, so the test set may be of any
size. Null and empty texts have no words and are never contaminated; repeated rows are judged each on
its own; an item without id is searched like others, but not named or counted; items of one id count once; an empty table of either kind works. Extra
columns are ignored."""

from __future__ import annotations

import hashlib
import pickle
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import storage

SEED, BITS = 3, 22
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_BASE = 0xD1B54A32D192ED03


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORDS).split() if text else []


def _codes(ids: np.ndarray, width: int) -> np.ndarray:
    """A slot for the first ``width`` words of every position that has so many."""
    n = max(0, len(ids) - width + 1)
    h = np.full(n, width, np.uint64)
    for k in range(width):
        h = (h ^ ids[k : k + n].astype(np.uint64)) * _MIX[k]
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def _pair_slots(pairs: np.ndarray) -> np.ndarray:
    return (pairs * _MIX[0] >> np.uint64(64 - BITS)).astype(np.int64)


def suffix_array(ids: np.ndarray, longest: int) -> np.ndarray:
    """Places of ``ids`` in the order of what follows, by prefix doubling up to ``longest`` words."""
    rank, k = ids.astype(np.int64), 1
    while k < 2 * longest:
        after = np.zeros_like(rank)
        after[: max(0, len(rank) - k)] = rank[k:]
        values, rank = np.unique(rank * (int(rank.max(initial=0)) + 1) + after, return_inverse=True)
        if len(values) == len(rank):
            break
        rank, k = rank + 1, 2 * k
    return np.argsort(rank, kind="stable").astype(np.int32)


def _rows(ids: np.ndarray, places: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """The ``depth`` words at each place, zeros after its end."""
    at = places[:, None] + np.arange(depth)
    return np.where(at < ends[:, None], ids[np.minimum(at, len(ids) - 1)], 0).astype(">u4")


def _keys(rows: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(rows).view(f"S{4 * rows.shape[1]}").ravel()


class Hashed:
    """Range hashes of a sequence of ids: equal ranges have equal hashes."""

    def __init__(self, ids: np.ndarray):
        x = (ids.astype(np.uint64) + np.uint64(1)) * _MIX[0]
        x ^= x >> np.uint64(31)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * _accumulated(_BASE, len(ids)))])
        self.back = _accumulated(pow(_BASE, -1, 1 << 64), len(ids) + 1)

    def range(self, at: np.ndarray, size: int) -> np.ndarray:
        return (self.sums[at + size] - self.sums[at]) * self.back[at]


def _accumulated(base: int, n: int) -> np.ndarray:
    x = np.full(n, base, np.uint64)
    x[:1] = 1
    return np.multiply.accumulate(x)


class Tests:
    """A block of test texts: vocabulary, ids (items parted by 0), their suffix array and the slots of their first words."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.window, self.names, self.vocab = window, [], {}
        parts, starts, at = [], [], 0
        slots: dict[int, set] = {}
        for item, text in items:
            words = words_of(text)
            if not words:
                continue
            ids = np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in words], np.uint32)
            width = min(SEED, window, len(ids))
            slots.setdefault(width, set()).update(_codes(ids, width).tolist())
            parts += [ids, np.zeros(1, np.uint32)]
            starts.append(at)
            self.names.append(item)
            at += len(ids) + 1
        self.ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        self.starts = np.array(starts, np.int64)
        longest = int(np.diff([*starts, at]).max(initial=1))
        order = suffix_array(self.ids, longest)
        self.order = order[self.ids[order] > 0]
        self.slots = {w: np.array(sorted(s), np.int64) for w, s in slots.items()}

    def ready(self) -> Tests:
        """What follows from the above and is not worth storing."""
        self.maps = {w: np.zeros(1 << BITS, bool) for w in self.slots}
        for w, s in self.slots.items():
            self.maps[w][s] = True
        self.ends = np.append(self.starts[1:] - 1, len(self.ids) - 1)
        self.item = np.searchsorted(self.starts, self.order, "right") - 1
        self.rows = _rows(self.ids, self.order, self.ends[self.item], self.window)
        self.keys = _keys(self.rows)
        size = self.ends[self.item] - self.order
        full = (size >= self.window) | (self.order == self.starts[self.item])  # where a window begins
        self.windows = np.flatnonzero(full)
        self.sizes = np.minimum(size, self.window)
        after = np.where(size > 1, self.ids[np.minimum(self.order + 1, len(self.ids) - 1)], 0)
        self.pairs = self.ids[self.order].astype(np.uint64) << np.uint64(32) | after.astype(np.uint64)  # the first two words of every suffix, rising
        self.has_pair = np.zeros(1 << BITS, bool)
        self.has_pair[_pair_slots(self.pairs)] = True
        self.hashed = None
        return self

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Words as the block's numbers, 0 for those that it lacks."""
        return np.fromiter(map(self.vocab.get, words, repeat(0)), np.uint32, len(words))

    def brief(self, ids: np.ndarray, ends: np.ndarray, places: np.ndarray) -> np.ndarray:
        """(place, length, test place) of matches of two words at some places, and of one word at those that have none."""
        after = np.where(places + 1 < ends[places], ids[np.minimum(places + 1, len(ids) - 1)], 0).astype(np.uint64)
        pairs = ids[places].astype(np.uint64) << np.uint64(32) | after
        two = np.flatnonzero(self.has_pair[_pair_slots(pairs)] & (after > 0))
        k = np.searchsorted(self.pairs, pairs[two], "left")
        two = two[self.pairs[np.minimum(k, len(self.pairs) - 1)] == pairs[two]]
        size = np.ones(len(places), np.int64)
        size[two] = 2
        return np.stack([places, size, np.zeros(len(places), np.int64)])

    def brief_place(self, ids: np.ndarray, place: int, size: int) -> int:
        """Where a match of one or two words stands in the block."""
        key = int(ids[place]) << 32 | (int(ids[place + 1]) if size == 2 else 0)
        return int(self.order[np.searchsorted(self.pairs, np.uint64(key), "left")])

    def search(self, ids: np.ndarray, ends: np.ndarray, longest: bool):
        """Of a shard's numbers: (place, length, item number) of every window's occurrences, and (place, length, test place) of the longest matches of ``SEED`` words
        or more. ``ends``: where the document of each position ends."""
        none = np.zeros((3, 0), np.int64)
        at = np.zeros(len(ids), bool)
        for width, slots in self.maps.items():
            codes = _codes(ids, width)
            at[: len(codes)] |= slots[codes]
        places = np.flatnonzero(at & (ids > 0))
        if not len(places):
            return none, none
        rows = _rows(ids, places, ends[places], self.window)
        keys = _keys(rows)
        order = np.argsort(keys, kind="stable")
        places, keys, rows = places[order], keys[order], rows[order]
        # every test suffix in the shard's array: the range of what begins with its first words
        lo = np.searchsorted(keys, self.keys, "left")
        top = self.rows[self.windows].copy()
        top[np.arange(self.window) >= self.sizes[self.windows, None]] = 0xFFFFFFFF
        hi = np.searchsorted(keys, _keys(top), "right")
        n = np.maximum(hi - lo[self.windows], 0)
        there = np.flatnonzero(n)
        w, n = self.windows[there], n[there]
        first = np.unique(np.stack([lo[w], n, self.sizes[w], self.item[w]]), axis=1, return_index=True)[1]  # an item's equal windows occur alike
        w, n = w[first], n[first]
        spot = np.repeat(lo[w], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        found = np.stack([places[spot], np.repeat(self.sizes[w], n), np.repeat(self.item[w], n)])
        if not longest:
            return found, none
        near = np.searchsorted(self.keys, keys, "left")  # the merged order from the shard's side
        best, test = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        for k in (near - 1, near):
            k = np.clip(k, 0, len(self.keys) - 1)
            same = (rows == self.rows[k]) & (rows > 0)
            size = np.where(same.all(axis=1), self.window, same.argmin(axis=1))
            test = np.where(size > best, self.order[k], test)
            best = np.maximum(best, size)
        deep = np.flatnonzero(best == self.window)
        if len(deep):
            best[deep], test[deep] = self.follow(ids, places[deep], ends[places[deep]])
        keep = best >= SEED
        return found, np.stack([places[keep], best[keep], test[keep]])

    def follow(self, ids: np.ndarray, places: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(length, test place) of the longest match at each place, by bisection of the full test array."""
        self.hashed = self.hashed or Hashed(self.ids)
        own = Hashed(ids)
        t_ends = self.ends[self.item]
        most = 1 << int(max(1, (ends - places).max())).bit_length()

        def common(k: np.ndarray) -> np.ndarray:
            t, t_end = self.order[k].astype(np.int64), t_ends[k]
            room = np.minimum(ends - places, t_end - t)
            size, step = np.zeros(len(places), np.int64), most
            while step:
                fits = np.flatnonzero(size + step <= room)
                same = own.range(places[fits] + size[fits], step) == self.hashed.range(t[fits] + size[fits], step)
                size[fits[same]] += step
                step //= 2
            return size

        def word(x: np.ndarray, i: np.ndarray, end: np.ndarray) -> np.ndarray:
            return np.where(i < end, x[np.minimum(i, len(x) - 1)], 0)

        lo, hi = np.zeros(len(places), np.int64), np.full(len(places), len(self.order), np.int64)
        while (lo < hi).any():
            mid = np.minimum((lo + hi) // 2, len(self.order) - 1)
            size = common(mid)
            less = word(self.ids, self.order[mid] + size, t_ends[mid]) < word(ids, places + size, ends)
            open_ = lo < hi
            lo, hi = np.where(open_ & less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
        below, above = np.maximum(lo - 1, 0), np.minimum(lo, len(self.order) - 1)
        a, b = common(below), common(above)
        return np.maximum(a, b), self.order[np.where(a >= b, below, above)].astype(np.int64)


_block: dict[str, Tests] = {}


def load_block(uri: str) -> Tests:
    """The block in this worker; one is held at a time."""
    if uri not in _block:
        _block.clear()
        _block[uri] = pickle.loads(storage.get_file(uri)).ready()
    return _block[uri]


def pack_tests(tests: DataFrame, folder: str, window: int, block_words: int, id_col: str, text_col: str) -> list[str]:
    """URIs of the block files; the driver gets those names alone."""
    tests = tests.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).cast("binary").alias("text")).filter("text is not null")
    size = tests.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-size // (6 * block_words)))

    def pack(batches):
        held, size = [], 0
        for whole in batches:
            for b in storage.bounded(whole, 1):
                for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    if held and size + len(text) > 6 * block_words:
                        yield block(held)
                        held, size = [], 0
                    held.append((item, text))
                    size += len(text)
        if held:
            yield block(held)

    def block(items):
        items.sort(key=lambda x: (x[0] is None, x))
        return pa.RecordBatch.from_pylist([{"path": storage.put_file(folder, "tests.block", [pickle.dumps(Tests(items, window))])}])

    return sorted(r[0] for r in storage.staged(tests.repartition(parts, F.xxhash64("item_id", "text")).mapInArrow(pack, "path string"), f"{folder}/tests").collect())


class Verdicts:
    """What the blocks say of a shard's documents."""

    def __init__(self, texts: list[bytes | None], longest: bool):
        self.texts, self.longest = texts, longest
        self.sizes = np.array([len(words_of(t)) for t in texts], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.sizes)])
        self.edge = np.zeros(int(self.begin[-1]) + 1, np.int64)
        self.items: dict[int, set] = {}
        self.best: list[tuple | None] = [None] * len(texts)

    def add(self, tests: Tests) -> None:
        words = [w for t in self.texts for w in words_of(t)]
        ids, ends = tests.numbers(words), np.repeat(self.begin[1:], self.sizes)
        found, matches = tests.search(ids, ends, self.longest)
        np.add.at(self.edge, found[0], 1)
        np.add.at(self.edge, found[0] + found[1], -1)
        docs = np.searchsorted(self.begin, found[0], "right") - 1
        for d, k in np.unique(np.stack([docs, found[2]]), axis=1).T.tolist():
            if tests.names[k] is not None:
                self.items.setdefault(d, set()).add(tests.names[k])
        if self.longest:
            short = found[1] < SEED  # a whole item of fewer words
            matches = np.concatenate([matches, np.stack([found[0], found[1], tests.starts[found[2]]])[:, short]], axis=1)
            matches = np.concatenate([matches, self._brief(tests, ids, ends, matches)], axis=1)
            docs = np.searchsorted(self.begin, matches[0], "right") - 1
            order = np.lexsort([matches[2], matches[0], -matches[1], docs])
            for i in order[np.unique(docs[order], return_index=True)[1]].tolist():
                d, (at, size, t) = int(docs[i]), matches[:, i].tolist()
                k = int(np.searchsorted(tests.starts, t, "right")) - 1
                spot = t - int(tests.starts[k])
                size = self._checked(words[at : at + size], tests, t)
                one = (-size, at - int(self.begin[d]), tests.names[k] is None, tests.names[k] or "", spot)
                if self.best[d] is None or one < self.best[d]:
                    self.best[d] = one

    def _brief(self, tests: Tests, ids: np.ndarray, ends: np.ndarray, matches: np.ndarray) -> np.ndarray:
        """The first of the longest matches below ``SEED`` words of every document that has no longer one here or in an earlier block."""
        bare = np.array([b is None or b[0] > -SEED for b in self.best], bool)
        bare[np.searchsorted(self.begin, matches[0][matches[1] >= SEED], "right") - 1] = False
        places = np.flatnonzero((ids > 0) & np.repeat(bare, self.sizes))
        if not len(places):
            return np.zeros((3, 0), np.int64)
        got = tests.brief(ids, ends, places)
        docs = np.searchsorted(self.begin, got[0], "right") - 1
        order = np.lexsort([got[0], -got[1], docs])
        got = got[:, order[np.unique(docs[order], return_index=True)[1]]]
        got[2] = [tests.brief_place(ids, at, size) for at, size in got[:2].T.tolist()]
        return got

    @staticmethod
    def _checked(words: list[bytes], tests: Tests, t: int) -> int:
        """The length of a match, word by word."""
        ids = np.fromiter(map(tests.vocab.get, words, repeat(0)), np.uint32, len(words))
        differ = np.flatnonzero(ids != tests.ids[t : t + len(ids)])
        return int(differ[0]) if len(differ) else len(ids)

    def hits(self) -> np.ndarray:
        run = np.concatenate([[0], np.cumsum(np.cumsum(self.edge[:-1]) > 0)])
        return run[self.begin[1:]] - run[self.begin[:-1]]


def judge(batch: pa.RecordBatch, place: int, blocks: list[str], shard_bytes: int, longest: bool):
    """(rows, verdicts) of every shard of a batch. With several blocks each is loaded once for all shards, and texts are parted into words anew for each."""
    shards = storage.bounded(batch, place, shard_bytes)
    binary = lambda rows: [t.encode() if isinstance(t, str) else t for t in rows.column(place).to_pylist()]
    if len(blocks) > 1:
        held = [(rows, Verdicts(binary(rows), longest)) for rows in shards]
        for uri in blocks:
            tests = load_block(uri)
            for _, v in held:
                v.add(tests)
        yield from held
    else:
        for rows in shards:
            v = Verdicts(binary(rows), longest)
            for uri in blocks:
                v.add(load_block(uri))
            yield rows, v


def affected(n_words: np.ndarray, n_hit: np.ndarray, min_share: int) -> np.ndarray:
    return (n_hit > 0) & (min_share * n_hit >= n_words)


SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest_match long, match_at long, match_item string, match_item_at long"


def contamination(docs: DataFrame, tests: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 13, min_share: int = 20, block_words: int = 1 << 19, shard_bytes: int = 4 << 20) -> DataFrame:
    """One row per document: words, hit words, items with an occurring window, the verdict (a hit word in every ``min_share`` at least), the longest match in words, and where it is: first word
    in the document, item, first word in the item (nulls without a match)."""
    folder = storage.workspace(docs.sparkSession, "decontaminate")
    blocks = pack_tests(tests, folder, window, block_words, item_col, item_text_col)

    def run(batches):
        for b in batches:
            for rows, v in judge(b, 1, blocks, shard_bytes, True):
                n, n_hit = v.sizes, v.hits()
                names = [sorted(v.items.get(d, ())) for d in range(len(n))]
                yield pa.RecordBatch.from_arrays([
                    rows.column(0), pa.array(n, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in names], pa.int64()),
                    pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in names], pa.string()), pa.array(affected(n, n_hit, min_share)),
                    pa.array([-x[0] if x else 0 for x in v.best], pa.int64()), pa.array([x and x[1] for x in v.best], pa.int64()),
                    pa.array([None if not x or x[2] else x[3] for x in v.best], pa.string()), pa.array([x and x[4] for x in v.best], pa.int64()),
                ], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, SCHEMA)


def keep_clean(docs: DataFrame, tests: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 13, min_share: int = 20, block_words: int = 1 << 19, shard_bytes: int = 4 << 20) -> DataFrame:
    """The rows, with all their columns, that are not contaminated."""
    blocks = pack_tests(tests, storage.workspace(docs.sparkSession, "decontaminate"), window, block_words, item_col, item_text_col)
    place = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            for rows, v in judge(b, place, blocks, shard_bytes, False):
                yield rows.filter(pa.array(~affected(v.sizes, v.hits(), min_share)))

    return docs.mapInArrow(run, docs.schema)
