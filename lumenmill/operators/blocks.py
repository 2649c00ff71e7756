"""Greedy removal by TF-IDF cosine, a block of rows after the other (DES6).

All rows in their order are cut into blocks that a task holds. In round i a task for every block that is not done takes out the rows that are like a kept row of block i - 1, and that of block i then goes through its own rows in
order: what is left are the rows that a sequential pass keeps. So every pair that shares a rare word meets in some task, but none is written: between the rounds stand the vectors, once, and the numbers of the rows that are left.
A block has at most ``MOST`` bytes of words and weights, so rounds grow with the input and their work with its square; tasks read the blocks from the shared folder, and the words are not shuffled again."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from ..sources.shared import durable, parted, remove, workers_find_package, workspace

LEAST, MOST, WIDE = 1 << 20, 64 << 20, 16  # bytes of a block; as many blocks as this as long as they are not smaller than the least


def _offsets(lists: pa.ListArray) -> np.ndarray:
    return np.cumsum([0, *pc.list_value_length(lists).to_numpy(zero_copy_only=False)])


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sid, w, tf): every word of a row once, with its count."""
    for b in batches:
        at, words = _offsets(b.column(1)), b.column(1).flatten().to_numpy()
        bags = [np.unique(words[i:j], return_counts=True) for i, j in zip(at[:-1], at[1:], strict=True)]
        ends = np.cumsum([0, *(len(w) for w, _ in bags)])
        w, tf = (np.concatenate([np.empty(0, np.int64), *(x[k] for x in bags)]) for k in (0, 1))
        yield pa.RecordBatch.from_arrays([b.column(0), _lists(w, ends), _lists(tf.astype(np.int32), ends)], names=["sid", "w", "tf"])


def _read(uri: str, columns: list[str]) -> pa.Table | None:
    """The rows of a folder; none where it isn't."""
    system, path = fs.FileSystem.from_uri(uri)
    return pq.read_table(path, columns=columns, filesystem=system, partitioning=None) if system.get_file_info(path).type == fs.FileType.Directory else None


def _vectors(batches: Iterator[pa.RecordBatch], bags: str, vocabulary: str, total: int) -> Iterator[pa.RecordBatch]:
    """Of blocks (id): every row's words that other rows have too, the rarest first, with counts, the rows that have them, and the norm over all words."""
    for block in (x for b in batches for x in b.column(0).to_pylist()):
        own, known = _read(f"{bags}/block={block}", ["at", "w", "tf"]), _read(f"{vocabulary}/block={block}", ["w", "df"])
        if own is None:
            continue
        lists = own["w"].combine_chunks()
        ends, w, tf, df = _offsets(lists), lists.flatten().to_numpy(), own["tf"].combine_chunks().flatten().to_numpy(), np.ones(len(lists.flatten()), np.int32)
        if known is not None:
            words, of = known["w"].to_numpy(), known["df"].to_numpy()
            by = np.argsort(words)
            words, of = words[by], of[by]
            at = np.minimum(np.searchsorted(words, w), len(words) - 1)
            df = np.where(words[at] == w, of[at], 1)
        x = tf * (np.log((1 + total) / (1 + df)) + 1)
        norm = np.sqrt(np.add.reduceat(x * x, ends[:-1]))  # no row is without words
        doc = np.repeat(np.arange(len(norm)), np.diff(ends))
        shared = np.flatnonzero(df > 1)
        shared = shared[np.lexsort((w[shared], df[shared], doc[shared]))]
        ends = np.concatenate([[0], np.cumsum(np.bincount(doc[shared], minlength=len(norm)))])
        parts = [pa.array(np.full(len(norm), block), pa.int32()), own["at"].combine_chunks(), _lists(w[shared], ends), _lists(tf[shared].astype(np.int32), ends), _lists(df[shared].astype(np.int32), ends), pa.array(norm)]
        yield from pa.Table.from_arrays(parts, names=["block", "at", "w", "tf", "df", "norm"]).to_batches(max_chunksize=1024)


def _spans(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places lo[0], lo[0] + 1, ... of n[0], then those of the next."""
    return np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())


class Block:
    """Rows of a block that are left, with their words, weights and what a word and those behind it weigh together. Two rows above the threshold share the first of their common words among those that stand before each one's last part of a
    norm below it."""

    def __init__(self, vectors: str, block: int, left: np.ndarray | None, total: int, threshold: float):
        rows = _read(f"{vectors}/block={block}", ["at", "w", "tf", "df", "norm"])
        if left is not None and rows is not None:
            rows = rows.filter(pc.is_in(rows["at"], pa.array(left)))
        if rows is None:
            rows = pa.table({c: pa.array([], t) for c, t in (("at", pa.int64()), ("w", pa.list_(pa.int64())), ("tf", pa.list_(pa.int32())), ("df", pa.list_(pa.int32())), ("norm", pa.float64()))})
        rows = rows.sort_by("at").combine_chunks()
        flat = {c: pa.concat_arrays([x.flatten() for x in rows[c].chunks] or [pa.array([], pa.int64())]).to_numpy() for c in ("w", "tf", "df")}
        self.at, self.w = rows["at"].to_numpy(), flat["w"]
        self.n = pc.list_value_length(rows["w"]).to_numpy()
        self.end = np.cumsum(self.n)
        self.start = self.end - self.n
        self.x = flat["tf"] * (np.log((1 + total) / (1 + flat["df"])) + 1) / np.repeat(rows["norm"].to_numpy(), self.n)
        sums = np.concatenate([[0.0], np.cumsum(self.x * self.x)])
        rest = np.repeat(sums[self.end], self.n) - sums[:-1]
        self.least = threshold * threshold * 0.999999
        self.threshold = threshold
        doc = np.repeat(np.arange(len(self.at)), self.n)
        first = np.flatnonzero(rest >= self.least)
        self.p_w, self.p_doc, self.p_rest = self.w[first], doc[first], rest[first]

    def take_out(self, kept: Block, gone: np.ndarray) -> None:
        """Marks the rows that are like one of ``kept``. Where that is this block itself its rows are taken in order, those that are gone take none out, and only later ones go."""
        inside = kept is self
        words, ids = np.unique(self.w, return_inverse=True)
        if not len(words) or not len(kept.w):
            return
        by = np.argsort(self.p_w, kind="stable")
        p_w, p_doc, p_rest = self.p_w[by], self.p_doc[by], self.p_rest[by]
        lo, hi = np.searchsorted(p_w, kept.p_w), np.searchsorted(p_w, kept.p_w, "right")
        meets = np.flatnonzero(hi > lo)
        lo, n, rest = lo[meets], (hi - lo)[meets], kept.p_rest[meets]
        of = np.searchsorted(kept.p_doc[meets], np.arange(len(kept.at) + 1))
        found = np.minimum(np.searchsorted(words, kept.w), len(words) - 1)
        own = words[found] == kept.w
        dense = np.zeros(len(words))
        for k in range(len(kept.at)):
            some = slice(of[k], of[k + 1])
            if of[k] == of[k + 1] or inside and gone[k]:
                continue
            at = _spans(lo[some], n[some])
            near = np.zeros(len(gone), bool)
            near[p_doc[at[np.repeat(rest[some], n[some]) * p_rest[at] >= self.least]]] = True
            near &= ~gone
            if inside:
                near[: k + 1] = False
            rows = np.flatnonzero(near)
            if not len(rows):
                continue
            whole = slice(kept.start[k], kept.end[k])
            mine = found[whole][own[whole]]
            dense[mine] = kept.x[whole][own[whole]]
            at = _spans(self.start[rows], self.n[rows])
            cos = np.add.reduceat(dense[ids[at]] * self.x[at], np.cumsum(self.n[rows]) - self.n[rows])
            gone[rows[cos > self.threshold]] = True
            dense[mine] = 0.0


def _round(batches: Iterator[pa.RecordBatch], now: int, vectors: str, before: str | None, total: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """(done, block, at) of the rows that are left of blocks (id) when those kept of the block before ``now`` have taken theirs out; block ``now`` is done then."""
    for block in (x for b in batches for x in b.column(0).to_pylist()):
        left = None
        if before is not None:
            rows = _read(f"{before}/done=false/block={block}", ["at"])
            left = np.empty(0, np.int64) if rows is None else rows["at"].to_numpy()
        own = Block(vectors, block, left, total, threshold)
        gone = np.zeros(len(own.at), bool)
        kept = _read(f"{before}/done=true/block={now - 1}", ["at"]) if before is not None else None
        if kept is not None and len(own.at):
            own.take_out(Block(vectors, now - 1, kept["at"].to_numpy(), total, threshold), gone)
        if block == now:
            own.take_out(own, gone)
        at = own.at[~gone]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), block == now), pa.bool_()), pa.array(np.full(len(at), block), pa.int32()), pa.array(at, pa.int64())], names=["done", "block", "at"])


def dedup_tfidf(rows: DataFrame, order: str, words: str, threshold: float = 0.85, most: int = MOST) -> DataFrame:
    """DES6: rows whose TF-IDF cosine with a kept earlier row is above ``threshold`` go. ``order`` is unique and not null, the better row first; rows without words are like none. The weight of a word is its count times ln((1 + N) / (1 + df)) + 1."""
    spark = rows.sparkSession
    workers_find_package(spark)
    docs = rows.select(F.col(order).alias("sid"), F.transform(F.array_compact(words), lambda w: F.xxhash64(w)).alias("words"))  # 64 bits a word: equal for equal words
    full = F.size("words") > 0
    total, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.when(full, F.size("words"))), F.lit(0))).first()
    if not size:
        return rows
    blocks = max(-(-16 * size // most), min(WIDE, -(-16 * size // LEAST)))
    schema = StructType([StructField("sid", docs.schema["sid"].dataType), StructField("w", ArrayType(LongType())), StructField("tf", ArrayType(IntegerType()))])
    work = workspace(spark, "tfidf")
    placed = docs.filter(full).mapInArrow(_bags, schema).repartitionByRange(blocks, "sid").sortWithinPartitions("sid")
    bags = parted(placed.select(F.spark_partition_id().alias("block"), F.monotonically_increasing_id().alias("at"), "sid", "w", "tf"), f"{work}/bags", "block")
    table = spark.read.schema(StructType([*schema, StructField("at", LongType()), StructField("block", IntegerType())])).parquet(bags)
    ids = durable(table.select("at", "sid"), "ids")
    of_block = table.select("block", F.explode("w").alias("w")).groupBy("block", "w").agg(F.count("*").alias("n"))
    known = of_block.select("block", "w", F.sum("n").over(Window.partitionBy("w")).alias("df")).filter("df > 1")  # a row for each block that has the word
    vocabulary = parted(known.select("block", "w", F.col("df").cast("int").alias("df")).repartition(blocks, "block"), f"{work}/vocabulary", "block")
    each = spark.range(0, blocks, 1, blocks)
    vectors = parted(each.mapInArrow(partial(_vectors, bags=bags, vocabulary=vocabulary, total=total), "block int, at long, w array<long>, tf array<int>, df array<int>, norm double"), f"{work}/vectors", "block")
    remove(spark, bags, vocabulary)
    before = None
    for now in range(blocks):
        left = spark.range(now, blocks, 1, blocks - now).mapInArrow(partial(_round, now=now, vectors=vectors, before=before, total=total, threshold=threshold), "done boolean, block int, at long")
        at = parted(left, f"{work}/left/round={now}", "done", "block")
        if before is not None:
            remove(spark, f"{before}/done=false")
        before = at
    remove(spark, vectors)
    places = spark.read.schema("at long, done boolean").parquet(f"{work}/left").filter("done").select("at")
    stays = ids.hint("merge").join(places.hint("merge"), "at").select(F.col("sid").alias(order))
    without = rows.filter(F.coalesce(F.size(F.array_compact(words)), F.lit(0)) <= 0)
    return rows.hint("merge").join(stays.hint("merge"), order, "left_semi").unionByName(without)
