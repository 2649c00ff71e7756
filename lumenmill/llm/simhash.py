"""SimHash near-duplicates by tiled exact comparison.

Fingerprint: 64 bits, each 1 if set in over half of the XXH64 (seed 42) values of a text's
3-word shingles, repeats included; a text of fewer words is one shingle, a text without words
(null and empty too) has fingerprint zero.

Two fingerprints within ``radius`` bits agree on at least ``5 - radius`` of five fixed bit
blocks, so tables keyed by every choice of that many blocks bring each linked pair together at
least once: no pair is lost. Within a key, fingerprints (distinct ones; copies share theirs) go
to tiles of bounded size, a key that outgrows one tile to every pair of its tiles. A task sorts
a tile pair by bit count, compares sub-tiles with exclusive-or and bit counts, and skips pairs
of sub-tiles whose counts differ beyond the radius. It passes on a spanning forest of its links,
not all of them: what is connected stays connected, and a large group makes no square of rows.

``near_duplicates`` gives one row for every input row: rows with equal ids are judged each by its own text, and a component is named by the
smallest id among its rows (null only where none has one). ``keep_one`` leaves one row of every component: that of the smallest id (a row
without id only where none has one), of several such rows that of the smallest text hash, of repeats the smallest by all columns; null and empty
texts are alike. An empty table gives none; extra columns are ignored by the first and kept by the second. A task holds ``BATCH`` bytes of texts,
or one longer text, and a tile pair. Rows that share a fingerprint meet its component in a join with one row a fingerprint, whose skew AQE splits."""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import storage
from .components import components

BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
TILE, BATCH = 1 << 12, 4 << 20
SUB = 512


def fingerprint(text: bytes | None) -> int:
    import xxhash

    words = text.lower().split() if text else []  # ASCII rules: A-Z, and white space U+0009-000D and U+0020
    if not words:
        return 0
    shingles = map(b" ".join, zip(words, words[1:], words[2:], strict=False)) if len(words) >= 3 else [b" ".join(words)]
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), np.uint64)
    bits = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        bits += np.unpackbits(h[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long), and a hash of the text."""

    def run(batches):
        for whole in batches:
            for b in storage.bounded(whole, 2, BATCH):
                fps = np.array([fingerprint(t) for t in b.column(2).to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64()), b.column(1)], names=["doc_id", "fp", "text_hash"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_hash(text_col), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, "doc_id long, fp long, text_hash long")


def text_hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))).alias("text_hash")


def tile_links(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among distinct fingerprints: sub-tiles in the order of bit counts."""
    counts = np.bitwise_count(fps)
    order = np.argsort(counts, kind="stable")
    fps, counts = fps[order], counts[order].astype(np.int16)
    up = list(range(len(fps)))

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    out = []
    for i in range(0, len(fps), SUB):
        a = fps[i : i + SUB]
        for j in range(i, len(fps), SUB):
            if counts[j] - counts[min(i + SUB, len(fps)) - 1] > radius:
                break  # bit counts rise: no later sub-tile is nearer
            near = np.bitwise_count(a[:, None] ^ fps[None, j : j + SUB]) <= radius
            for x, y in np.argwhere(near).tolist():
                p, q = i + x, j + y
                if p < q and (r := root(p)) != (s := root(q)):
                    up[s] = r
                    out.append((int(fps[p]), int(fps[q])))
    return out


def links(fps: DataFrame, folder: str, radius: int = 3, tile: int = TILE) -> DataFrame:
    """(a, b) pairs of distinct fingerprints that connect all which differ by ``radius`` bits or fewer."""
    if not 0 <= radius < len(BLOCKS):
        raise ValueError("radius must be 0 to 4")
    tables = list(combinations(BLOCKS, len(BLOCKS) - radius))

    def keyed(blocks):
        parts = [F.shiftrightunsigned("fp", at).bitwiseAND((1 << width) - 1).cast("string") for at, width in blocks]
        return F.concat_ws("-", *parts)

    keys = F.array(*(F.struct(F.lit(i).cast("short").alias("t"), F.xxhash64(keyed(t)).alias("key")) for i, t in enumerate(tables)))
    rows = storage.staged(fps.select("fp", F.explode(keys).alias("k")).select("k.t", "k.key", "fp"), f"{folder}/keys")
    many = rows.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1").withColumn("tiles", F.ceil(F.col("n") / tile).cast("int"))
    mine = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    paired = (
        rows.join(many, ["t", "key"])
        .withColumn("mine", mine)
        .select("t", "key", "fp", "mine", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
        .select("t", "key", "fp", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    )

    def run(batches):
        held, key = [], None
        found: set = set()

        def flush():
            found.update(tile_links(np.unique(np.concatenate(held).view(np.uint64)), radius))

        def emit():
            pairs = np.array(sorted(found), np.uint64).reshape(-1, 2).view(np.int64)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for b in batches:
            ids = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            change = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in ids[:4]])) + 1
            for lo, hi in zip([0, *change.tolist()], [*change.tolist(), b.num_rows], strict=True):
                now = tuple(c[lo].item() for c in ids[:4])
                if now != key and held:
                    flush()
                    held = []
                key = now
                held.append(ids[4][lo:hi].copy())
            if len(found) > 1 << 14:
                yield emit()
        if held:
            flush()
        if found:
            yield emit()

    order = ["t", "key", "i", "j"]
    return paired.select(*order, "fp").repartition(*order).sortWithinPartitions(*order).mapInArrow(run, "a long, b long")


def _rooted(own: DataFrame, folder: str, radius: int, best: Column) -> DataFrame:
    """(fp, root, first): of every distinct fingerprint its component, and ``best`` of its rows."""
    firsts = storage.staged(own.groupBy("fp").agg(best.alias("first")), f"{folder}/distinct")
    roots = components(links(firsts.select("fp"), folder, radius), folder)
    return firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id in the row's component."""
    folder = storage.workspace(docs.sparkSession, "simhash")
    own = storage.staged(fingerprints(docs, id_col, text_col).select("doc_id", "fp"), f"{folder}/fingerprints")
    of_fp = _rooted(own, folder, radius, F.min("doc_id"))
    named = of_fp.join(of_fp.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("fp", "component_id")
    return own.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3) -> DataFrame:
    """The rows, with all their columns, that stand for their components."""
    folder = storage.workspace(docs.sparkSession, "simhash")
    own = storage.staged(fingerprints(docs, id_col, text_col), f"{folder}/fingerprints")
    rows = storage.staged(own.groupBy("fp", "doc_id", "text_hash").agg(F.count("*").alias("n")), f"{folder}/rows")
    of_fp = _rooted(rows, folder, radius, F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "n")))
    taken = {c.lower() for c in docs.columns}
    id_, hash_, many, mine = (next(x for x in (f"_{s}{k or ''}" for k in range(len(taken) + 1)) if x not in taken) for s in ("id", "hash", "many", "own"))  # names that no column has
    chosen = of_fp.groupBy("root").agg(F.min("first").alias("c")).select(F.col("c.doc_id").alias(id_), F.col("c.text_hash").alias(hash_), (F.col("c.n") > 1).alias(many))
    chosen = storage.staged(chosen, f"{folder}/chosen")
    met = docs.withColumn(mine, text_hash(text_col)).join(chosen, F.col(id_col).cast("long").eqNullSafe(F.col(id_)) & (F.col(mine) == F.col(hash_)))
    alone = met.filter(~F.col(many)).select(*docs.columns)
    order = F.struct(*(F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in docs.schema))  # a map has no order of its own
    repeats = met.filter(many).groupBy(id_, hash_).agg(F.min_by(F.struct(*docs.columns), order).alias("r")).select("r.*")  # a running minimum in each task: repeats are never gathered
    return alone.unionByName(repeats)
