"""Appends that bring a key once, whatever is run again (SNK2, REL6).

Beside the rows of an output stands ``_ledger``, which readers skip. Append ``n`` first writes its new rows, the digests of their keys and a Bloom filter of them, parted in ``BUCKETS``
by digest, below ``_ledger/n=<n>``, then a mark that it is ready; then its files move into the output under names of their own, and a second mark ends it.
An append that was lost before it was ready is written anew under its number; one that was lost later is moved on by the next. A job reads the filters, ``BITS`` bits a key, and no
earlier row. Digests are read only if the filters let a key pass: a true repeat, or one new key in about a hundred."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import durable, workers_find_package

BUCKETS, BITS, PROBES = 64, 10, 6
FILTER = "bucket int, bits binary"


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.hadoop = spark._jvm.org.apache.hadoop.fs.Path
        self.system = self.hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, number: int, name: str = "") -> str:
        return f"{self.path}/_ledger/n={number}{name and '/'}{name}"

    def there(self, path: str) -> bool:
        return self.system.exists(self.hadoop(path))

    def ended(self) -> int:
        """How many appends have ended; one that is ready is ended first."""
        n = 0
        while self.there(self.at(n, "_READY")):
            if not self.there(self.at(n, "_DONE")):
                self.move(n)
            n += 1
        return n

    def move(self, number: int) -> None:
        rows = self.at(number, "rows")
        for f in self.system.listStatus(self.hadoop(rows)) if self.there(rows) else []:
            name = f.getPath().getName()
            if name.startswith("part-"):
                self.system.rename(f.getPath(), self.hadoop(f"{self.path}/append-{number:06d}-{name}"))
        self.mark(number, "_DONE")

    def mark(self, number: int, name: str) -> None:
        self.system.create(self.hadoop(self.at(number, name)), True).close()

    def put(self, number: int, rows: DataFrame | None, digests: DataFrame) -> None:
        if rows is not None:
            rows.write.mode("overwrite").json(self.at(number, "rows"))
        digests.write.mode("overwrite").parquet(self.at(number, "digests"))
        filters(self.spark.read.parquet(self.at(number, "digests"))).write.mode("overwrite").parquet(self.at(number, "filters"))
        self.mark(number, "_READY")
        self.move(number)

    def known(self, digests: DataFrame, ended: int) -> DataFrame:
        """The digests of some that earlier appends have."""
        if not ended:
            return digests.limit(0)
        passed = durable(passing(digests, self.spark.read.schema(FILTER).parquet(*(self.at(n, "filters") for n in range(ended)))), "passed")
        if passed.isEmpty():
            return passed
        return self.spark.read.schema("digest binary").parquet(*(self.at(n, "digests") for n in range(ended))).join(passed, "digest", "left_semi").distinct()


def _bucket(digest) -> F.Column:
    return F.pmod(F.conv(F.substring(F.hex(digest), 1, 8), 16, 10).cast("long"), F.lit(BUCKETS)).cast("int")


def _probes(digests: list[bytes], size: int) -> np.ndarray:
    """Bits of every digest in a filter of a size, by double hashing over the digest's halves."""
    two = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
    return (two[:, :1] + np.arange(PROBES, dtype=np.uint64) * (two[:, 1:] | np.uint64(1))) % np.uint64(size)


def _runs(batches: Iterator[pa.RecordBatch], place: int = 0) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """(bucket, parts) of rows that come by bucket."""
    held, bucket = [], None
    for b in batches:
        cut = b.column(place).to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), len(cut)]
        for lo, hi in zip(edges, edges[1:], strict=False):
            if hi > lo:
                if held and cut[lo] != bucket:
                    yield bucket, held
                    held = []
                bucket = int(cut[lo])
                held.append(b.slice(lo, hi - lo))
    if held:
        yield bucket, held


def filters(digests: DataFrame) -> DataFrame:
    """A Bloom filter of each bucket's digests."""

    def run(batches):
        for bucket, parts in _runs(batches):
            every = [d for b in parts for d in b.column(1).to_pylist()]
            size = max(64, BITS * len(every) + 7 & ~7)
            bits = np.zeros(size, bool)
            bits[_probes(every, size).ravel()] = True
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["bucket", "bits"])

    workers_find_package(digests.sparkSession)
    return digests.select(_bucket(F.col("digest")).alias("bucket"), "digest").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, FILTER)


def passing(digests: DataFrame, held: DataFrame) -> DataFrame:
    """The digests that one of the filters lets pass."""

    def run(batches):
        for _, parts in _runs(batches):
            sieves = []
            for b in parts:
                for raw in b.column(1).to_pylist():
                    if raw is not None:
                        sieves.append(np.frombuffer(raw, np.uint8))
                some = [d for d in b.column(2).to_pylist() if d is not None]  # filters come before digests
                if some and sieves:
                    through = np.zeros(len(some), bool)
                    for bits in sieves:
                        at = _probes(some, 8 * len(bits))
                        through |= (bits[at >> np.uint64(3)] << (at & np.uint64(7)).astype(np.uint8) & 128).all(axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array([d for d, x in zip(some, through, strict=True) if x], pa.binary())], names=["digest"])

    none = F.lit(None).cast("binary")
    rows = held.select("bucket", "bits", none.alias("digest")).union(digests.distinct().select(_bucket(F.col("digest")), none, "digest"))
    workers_find_package(digests.sparkSession)
    return rows.repartition("bucket").sortWithinPartitions("bucket", F.col("bits").isNull()).mapInArrow(run, "digest binary")


def append_new(df: DataFrame, path: str, key: str) -> None:
    """The rows whose key the output lacks are appended, so a rerun adds nothing; of rows with one new key in one call all are, and null is a key like others.
    What an output without ledger has is entered first: its rows stay where they are."""
    spark = df.sparkSession
    ledger = Ledger(spark, path)
    digest = lambda: F.substring(F.unhex(F.sha2(F.coalesce(F.concat(F.lit("1"), F.col(key).cast("string")), F.lit("0")), 256)), 1, 16)
    if not ledger.there(ledger.at(0, "_READY")) and ledger.there(path) and any(not f.getPath().getName().startswith("_") for f in ledger.system.listStatus(ledger.hadoop(path))):
        ledger.put(0, None, spark.read.schema(df.select(key).schema).json(path).select(digest().alias("digest")).distinct())
    ended = ledger.ended()
    rows = durable(df, "append")
    keys = rows.select(digest().alias("digest"))
    known = durable(ledger.known(keys, ended), "known")
    name = next(f"_digest{k}" for k in range(len(df.columns) + 1) if f"_digest{k}" not in df.columns)
    new = rows.withColumn(name, digest()).join(known.withColumnRenamed("digest", name), name, "left_anti")
    ledger.put(ended, new.drop(name), new.select(F.col(name).alias("digest")).distinct())
