import hashlib

from pyspark.sql import functions as F

from lumenmill.operators import dedup, sampling


def test_quota_takes_the_smallest_hashes(spark):
    rows = [(i, "algebra" if i % 3 else "other") for i in range(200)]
    got = {r.i for r in sampling.topic_quota(spark.createDataFrame(rows, "i long, topic string"), "topic", "i", 40).collect()}
    order = sorted(range(200), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    assert got == {*[i for i in order if i % 3][:12], *[i for i in order if not i % 3][:2]}


def test_penalty_and_first_of_lower(spark):
    rows = spark.createDataFrame([(1, "a", "X"), (2, "a", "x"), (3, None, None), (4, None, ""), (5, "b", "y")], "i long, s string, t string")
    got = {r.i: r.penalised for r in sampling.source_penalty(rows, "s", F.col("i").isin(2, 4)).collect()}
    assert got == {1: True, 2: True, 3: True, 4: True, 5: False}
    assert {r.i for r in sampling.first_of_lower(rows, "t", "i").collect()} == {1, 3, 5}
    assert not sampling.first_of_lower(rows.limit(0), "t", "i").count()


def test_agreeing_samples(spark):
    rows = [(1, r"a \boxed{2}"), (1, r"longer \boxed{2}"), (1, r"the longest, but wrong \boxed{5}"), (2, r"x \boxed{1}"), (2, r"y \boxed{1}"), (2, r"z \boxed{1}"), (3, "none"), (4, r"alone \boxed{7}"), (5, r"\boxed{8}"), (None, r"\boxed{9}")]
    gold = [(1, r"gold \boxed{3} then \boxed{2}"), (1, r"gold \boxed{2}"), (2, r"\boxed{3}"), (3, "none"), (4, r"\boxed{7}"), (6, r"\boxed{8}"), (None, r"\boxed{9}")]
    table = lambda x: spark.createDataFrame(x, "q long, a string")
    got = sampling.agreeing_samples(table(rows), table(gold), "q", "a").collect()
    assert sorted((r.q, r.a, r.boxed) for r in got) == [(1, r"longer \boxed{2}", "2"), (4, r"alone \boxed{7}", "7")]  # three equal wrong answers are out, a right one beside a wrong one stays
    assert sampling.agreeing_samples(table([]), table(gold), "q", "a").count() == sampling.agreeing_samples(table(rows), table([]), "q", "a").count() == 0


def test_dedup_of_empty_sets_and_tables(spark):
    rows = spark.createDataFrame([(1, None, []), (2, None, ["a"]), (3, "k", None), (4, "l", [])], "o long, k string, s array<string>")
    assert {r.o for r in dedup.dedup_questions(rows, "o", "k", "s").collect()} == {1, 3, 4}
    assert not dedup.dedup_questions(rows.limit(0), "o", "k", "s").count()
