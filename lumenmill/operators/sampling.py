"""Planned selection rules: hash samples, source penalties, topic quotas, agreement of samples, acceptance figures (DES1, DES3, DES4, DES7-DES9, DES15, DES16, DES18)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.patterns import LEAK_WORDS
from .names import fresh

# Topics, their share in percent and their key words.
TOPICS = (
    ("algebra", 30, "equation|polynomial|solve for|linear|quadratic"),
    ("geometry", 15, "triangle|circle|area|volume|angle"),
    ("calculus", 15, "derivative|integral|limit|differentiate"),
    ("number_theory", 15, "prime|divisor|modulo|gcd|remainder"),
    ("statistics", 10, "probability|mean|variance|distribution"),
    ("combinatorics", 10, "permutation|combination|counting"),
)
OTHER = ("other", 5)


def hash_key(c: Column) -> Column:
    """32 hex digits of a value's MD5: their order is random, but the same in every run and engine."""
    return F.md5(c.cast("string").cast("binary"))


def in_share(c: Column, share: float) -> Column:
    """DES3, DES9: true for ``share`` of the values, by the first 16 bits of their hash."""
    return F.left(hash_key(c), F.lit(4)) < F.lit(f"{round(share * 65536):04x}" if share < 1 else "g")


def first_of_lower(rows: DataFrame, text: str, order: str) -> DataFrame:
    """DES7: the first row of every lower-cased text. A minimum that is aggregated before the shuffle, so a hot text costs no sort."""
    key = F.md5(F.lower(F.coalesce(text, F.lit(""))).cast("binary"))
    k, o = fresh(rows, "k", "o")
    firsts = rows.groupBy(key.alias(k)).agg(F.min(order).alias(o))
    return rows.join(firsts, (key == F.col(k)) & (F.col(order) == F.col(o)), "left_semi")


def source_penalty(rows: DataFrame, source: str, bad: Column) -> DataFrame:
    """DES4: ``penalised`` (in place of a column of that name) for all rows of a source with a bad row. One row per bad source is joined, not a window over a source that may hold a third of all rows."""
    s, found = fresh(rows, "s", "found")
    sources = rows.filter(bad).select(F.col(source).alias(s), F.lit(True).alias(found)).distinct()
    return rows.join(sources, F.col(source).eqNullSafe(F.col(s)), "left").withColumn("penalised", F.coalesce(found, F.lit(False))).drop(s, found)


def topic(c: Column) -> Column:
    """DES8: the first topic with a key word in the text, in the order of the table."""
    low = F.lower(F.coalesce(c, F.lit("")))
    out = F.when(low.rlike(TOPICS[0][2]), TOPICS[0][0])
    for name, _, words in TOPICS[1:]:
        out = out.when(low.rlike(words), name)
    return out.otherwise(OTHER[0])


def topic_quota(rows: DataFrame, topic_col: str, key: str, total: int) -> DataFrame:
    """DES8: of every topic its share of ``total`` rows, those with the smallest hashes of ``key`` (unique).

    Counts by topic and the hash's first 16 bits show in which bin the quota ends; rows before it are taken whole, and only that bin is
    ranked, so no task sorts a topic."""
    quota = F.create_map(*(F.lit(x) for name, share, *_ in (*TOPICS, OTHER) for x in (name, total * share // 100)))
    h, own, of, bin_, n, room, r = fresh(rows, "h", "own", "t", "bin", "n", "room", "r")
    keyed = rows.withColumn(h, hash_key(F.col(key))).withColumn(own, F.left(h, F.lit(4)))
    bins = keyed.groupBy(F.col(topic_col).alias(of), F.col(own).alias(bin_)).agg(F.count("*").alias(n))  # 65,536 rows a topic at most
    before = F.sum(n).over(Window.partitionBy(of).orderBy(bin_)) - F.col(n)
    bins = bins.withColumn(room, F.try_element_at(quota, F.col(of)) - before).filter(F.col(room) > 0)
    near = keyed.join(F.broadcast(bins), (F.col(topic_col) == F.col(of)) & (F.col(own) == F.col(bin_)))
    whole = near.filter(F.col(n) <= F.col(room))
    rank = F.row_number().over(Window.partitionBy(of, bin_).orderBy(h, key))
    part = near.filter(F.col(n) > F.col(room)).withColumn(r, rank).filter(F.col(r) <= F.col(room))
    return whole.select(*rows.columns).union(part.select(*rows.columns))


def token_length_kept(c: Column, least: int = 200, most: int = 9012) -> Column:
    """DES15 on the estimate of TXT30."""
    return t.estimated_tokens(F.coalesce(c, F.lit(""))).between(least, most)


def format_ok(question: Column, answer: Column) -> Column:
    """DES1: lengths, mathematics, a final answer, no cut end, a question."""
    q, a = F.coalesce(question, F.lit("")), F.coalesce(answer, F.lit(""))
    low = F.lower(a)
    final = low.rlike(r"=\s*-?[0-9]") | F.contains(low, F.lit("\\boxed")) | low.rlike("answer is|therefore")
    cut = F.rtrim(low).rlike(r"(\.\.\.|\band|,)$")
    asks = F.contains(q, F.lit("?")) | F.lower(q).rlike("find|prove|solve|compute")
    return F.length(q).between(30, 1000) & F.length(a).between(100, 3000) & F.concat(q, a).rlike(r"[$\\=0-9]") & final & ~cut & asks


def agreeing_samples(samples: DataFrame, gold: DataFrame, question: str, answer: str) -> DataFrame:
    """DES16: self-distillation. Of the samples of a question those agree whose last boxed answer is that of its gold row, and not empty; of each question the longest that agrees, of equals the greatest text.

    Both tables have the question's id and an answer; rows without an id or a box agree with nothing. Of several gold rows of a question any may be met."""
    boxed = lambda rows: rows.select(F.col(question).alias("q"), F.col(answer).alias("a"), t.last_boxed(F.col(answer)).alias("boxed")).filter("boxed <> ''")
    met = boxed(samples).join(boxed(gold).select("q", "boxed").distinct(), ["q", "boxed"])
    best = met.groupBy("q").agg(F.max(F.struct(F.length("a").alias("n"), "a", "boxed")).alias("b"))  # a running maximum: samples of a question are never gathered
    return best.select(F.col("q").alias(question), F.col("b.a").alias(answer), F.col("b.boxed").alias("boxed"))


def acceptance(rows: DataFrame) -> DataFrame:
    """DES18: of audit rows (route, messages, quality, reasoning_quality) a row of figures for each route: how many rows there are and pass every gate, which checks of a
    training row they meet or fail (thinking and a box present, no system text, no leak words, a question that begins as one), tokens, mean and greatest length."""
    system, q, a = (F.col("messages")[i]["content"] for i in range(3))
    keep = F.coalesce(F.col("quality.keep"), F.lit(False)) & F.coalesce(F.col("reasoning_quality.keep"), F.lit(False))
    leak = F.exists(F.array(*map(F.lit, LEAK_WORDS)), lambda w: F.contains(F.lower(F.concat(q, a)), w))
    return rows.groupBy("route").agg(
        F.count("*").alias("n_rows"),
        F.count_if(keep).alias("kept"),
        F.count_if(F.contains(a, F.lit("<think>"))).alias("thinking"),
        F.count_if(F.contains(a, F.lit("\\boxed{"))).alias("boxed"),
        F.count_if(leak).alias("leaks"),
        F.count_if(q.rlike("^[a-z]|^Example")).alias("bad_start"),
        F.count_if(system != "").alias("system_texts"),
        F.count_if(format_ok(q, a)).alias("format_ok"),
        F.sum(t.estimated_tokens(a)).alias("tokens"),
        F.avg(F.length(a).cast("double")).alias("mean_chars"),
        F.max(F.length(a)).cast("long").alias("longest"),
    )
