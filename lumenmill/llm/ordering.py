"""Global order by id without a global sort of the payload: quantile buckets, of which a frequent id has several; ranks within keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import storage

LEAST = -(1 << 63)


def place_of(id_col: str) -> Column:
    """Ids as places in the order; null ids come first."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST).cast("long"))


def bucket_bounds(df: DataFrame, place_col: str, n: int) -> list[tuple[float, int]]:
    """Rising (bound, how many of the quantiles it is), from n - 1 approximate quantiles (one scan of that column; the driver gets n numbers)."""
    if n < 2:
        return []
    got = df.select(F.col(place_col).cast("double").alias("x")).approxQuantile("x", [i / n for i in range(1, n)], 0.25 / n)
    return [(x, got.count(x)) for x in sorted(set(got))]


def bucket_of(place: Column, tie: Column, bounds: list[tuple[float, int]]) -> Column:
    """Bucket of a row, as a balanced tree of comparisons. Rows at a bound that is m quantiles at once, so more than m - 1 buckets of rows with
    one id, are dealt over m buckets by the leading bits of ``tie`` (a signed 64-bit hash), in its order: (place, tie) rises with the bucket."""
    x = place.cast("double")
    share = F.shiftrightunsigned(tie.bitwiseXOR(F.lit(LEAST).cast("long")), 44)  # 20 bits that rise with the tie
    first = [1]  # bucket at which each bound's rows begin
    for _, m in bounds:
        first.append(first[-1] + (1 if m < 2 else m + 1))

    def leaf(i: int) -> Column:
        bound, m = bounds[i]
        if m < 2:
            return F.lit(first[i])
        return F.when(x > bound, F.lit(first[i] + m)).otherwise(F.lit(first[i]) + F.shiftright(share * m, 20))

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return leaf(lo - 1) if lo else F.lit(0)
        mid = (lo + hi) // 2
        return F.when(x < bounds[mid][0], tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(bounds)).cast("int")


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ranked(rows: DataFrame, keys: list[str], order: list[str], folder: str) -> DataFrame:
    """Adds ``rank``, from 0 within ``keys`` by ``order`` (nulls first, strings by their bytes), and ``total``, the rows of the key.

    Rows are dealt out by ranges of keys and order, equal rows by their place in the input, so no key and no group of repeats lands in one task;
    a table of a row for each part and key holds what stands before. ``rows`` should come from a table: it is sampled first. The sorted rows
    are written below ``folder``, so places in them hold when a task runs again."""
    names = [*keys, *order]
    lined = rows.withColumn("_dealt", F.monotonically_increasing_id()).repartitionByRange(shuffle_partitions(rows), *names, "_dealt").sortWithinPartitions(*names, "_dealt")
    lined = storage.staged(lined.drop("_dealt").withColumn("_at", F.monotonically_increasing_id()), f"{folder}/lined").withColumn("_part", F.shiftright("_at", 33))
    sums = lined.groupBy("_part", *keys).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    of_key = Window.partitionBy(*keys)
    before = F.coalesce(F.sum("_n").over(of_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select("_part", *keys, (before - F.col("_first")).alias("_shift"), F.sum("_n").over(of_key).alias("total"))
    return lined.join(sums, ["_part", *keys]).withColumn("rank", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")
