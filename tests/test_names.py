"""Operators on tables whose other columns have the names that they use or give."""

import pytest
from pyspark.sql import functions as F

from lumenmill.operators import dedup, extract, inference, names, sampling, split
from lumenmill.plans import fixture

SOLVED = "# T\n\n## Problem\n\nFind x such that $x + 2 = 4$ holds here.\n\n## Solution\n\n" + "We subtract $2$ from both sides and get $x$ alone. " * 18 + "Thus, the answer is $2$."
PLAIN = [(1, SOLVED, "A"), (2, "short", "D"), (3, SOLVED, "A"), (4, None, "B")]
CLASH = (
    "_k _o _s _t _h _n _r _bin _own _room _skip _found _at _chunk _chunks _of _key _reply _digest strategy problem solution penalised chunk_index chunk_total chunk_chars chunk_id source_doc_id "
    "qa_index chunk chunk_start STRATEGY_1 x y a b sid w root node".split()
)
OPERATORS = {
    "first_of_key": lambda d: dedup.first_of_key(d, "text", "id"),
    "first_of_lower": lambda d: sampling.first_of_lower(d, "text", "id"),
    "source_penalty": lambda d: sampling.source_penalty(d, "label", F.col("id") == 2),
    "topic_quota": lambda d: sampling.topic_quota(d.withColumn("topic", F.lit("algebra")), "topic", "id", 10),
    "dedup_questions": lambda d: dedup.dedup_questions(d.withColumn("set", F.split(F.coalesce("text", F.lit("")), " ")), "id", "text", "set"),
    "dedup_tfidf": lambda d: dedup.dedup_tfidf(d.withColumn("set", F.split(F.coalesce("text", F.lit("")), " ")), "id", "set"),
    "extract_pairs": lambda d: extract.extract_pairs(d, keep_skipped=True),
    "split_documents": lambda d: split.split_documents(d, "id", min_chunk=100, min_math=0.0),
    "overlapping_chunks": lambda d: split.overlapping_chunks(d, size=300, overlap=100),
    "split_questions": lambda d: split.split_questions(d),
    "first_pairs": lambda d: split.first_pairs(d, "label", "id"),
    "ask": lambda d: inference.ask(d, F.col("text"), "said", fixture.scripted_model),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_clashing_columns_change_nothing(spark, name):
    docs = spark.createDataFrame(PLAIN, "id long, text string, label string")
    want = OPERATORS[name](docs)
    clashing = docs.select("*", *(F.lit(7).alias(c) for c in CLASH), F.create_map(F.lit("m"), F.lit(1)).alias("map"))
    got = OPERATORS[name](clashing)
    assert len({c.lower() for c in got.columns}) == len(got.columns) and {"map", "_k", "sid"} <= set(got.columns)
    rows = lambda df: sorted(map(str, df.select(*want.columns).collect()))
    assert rows(got) == rows(want)
    assert got.select(*(c for c in CLASH if c not in want.columns and c in got.columns)).distinct().count() <= 1
    assert OPERATORS[name](clashing.limit(0)).count() == 0


def test_written_through_replies_beside_clashing_columns(spark, tmp_path):
    docs = spark.createDataFrame(PLAIN, "id long, text string, label string")
    clashing = docs.select("*", *(F.lit(7).alias(c) for c in CLASH))
    said = lambda d, m: sorted(map(str, inference.ask(d, F.col("text"), "said", m).select("id", "said").collect()))
    assert said(clashing, inference.WriteThrough(fixture.scripted_model, f"file://{tmp_path}/log")) == said(docs, fixture.scripted_model)


def test_fresh_names(spark):
    rows = spark.createDataFrame([(1, 2, 3)], "_K int, _k1 int, x int")
    assert names.fresh(rows, "k", "x") == ["_k2", "_x"] and names.without(rows, ("X", "_k1"), ("x",)).columns == ["_K", "x"]
