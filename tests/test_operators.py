import re

from pyspark.sql import functions as F

from lumenmill.functions import patterns as p
from lumenmill.functions import text as t
from lumenmill.operators import dedup, extract, gates, quality, split


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first()["y"]


def test_counts_and_cleaning(spark):
    assert one(spark, "menu: click here at 9:30 pm https://a.b/c likes: 12 [INS: x :INS]", lambda c: t.count(c, p.NOISE)) == 6
    assert one(spark, r"Solve $x^2$ and $$y$$ with \frac, 3 + 4 = 7, sin", lambda c: t.count(c, p.MATH)) == 6
    rules = dict(quality.CLEANING)
    assert one(spark, "a[DEL: z :DEL]b[INS: keep :INS]c[INS: open", rules["cms"]) == "abkeepcopen"
    assert one(spark, r"\(a\) and \[b\]", rules["latex"]) == "$a$ and $$b$$"
    assert one(spark, "a\n\n\n\nb\n\nc", rules["blank"]) == "a\n\nb\n\nc"
    assert one(spark, "a\n\n**WRONG**: no\n\nb", rules["wrong"]) == "a\n\nb"
    assert one(spark, "x\n## Common Mistakes\nbad\n### in\nbad\n## Next\nok", rules["wrong"]) == "x\n## Next\nok"
    assert one(spark, "What is  $X_1$? \\boxed{9} 求值!", t.normalise) == "what is x 1 求值"


def test_every_pattern_compiles_in_both_forms(spark):
    for name, q in vars(p).items():
        if isinstance(q, p.P):
            assert q.re and one(spark, "abc", lambda c, q=q: t.count(c, q)) == len(list(re.finditer(q.re, "abc"))), name


def test_cascade_boundaries(spark):
    rows = [("x" * 799, 2.0), ("x" * 800, 1.49), ("$a$ " * 300, 1.5), ("$a$ " * 12501, 2.0), (None, None)]
    out = quality.quality_cascade(spark.createDataFrame(rows, "text string, score double"))
    assert [(r["label"], (r["reason"] or "").split("(")[0]) for r in out.collect()] == [("discard", "too_short"), ("discard", "low_nemo"), ("normal", ""), ("long", ""), ("discard", "too_short")]


def test_force_split_and_sections(spark):
    got = one(spark, "aaaa\n\nbbbb\n\ncccccccccccc\n\nd", lambda c: split.force_split(c, 12, 12))
    assert got == ["aaaa\n\nbbbb", "cccccccccccc", "d"]
    assert one(spark, "pre\n# A\nx\n## B\ny", split.heading_sections) == ["pre\n", "# A\nx\n", "## B\ny"]


def test_gates(spark):
    long = "We compute $a$, $b$ and $c$. " * 8
    assert one(spark, long + "Thus, the answer is $7$.", gates.inject_boxed).endswith("\n\n\\boxed{7}")
    df = spark.createDataFrame([("Find the value of x in the equation.", long + "\\boxed{7}"), ("This is a problem about some numbers.", long + "\\boxed{7}"), ("Find the value of x in the equation.", long)], "problem string, solution string")
    assert [r[0] for r in df.select(gates.gate_reason(F.col("problem"), F.col("solution"))).collect()] == [None, "L6:dangling_reference_start", "L1:no_boxed"]


def test_extraction():
    text = "# T\n\n## Problem\n\nFind x such that $x + 2 = 4$ holds here.\n\n## Solution\n\n" + "We subtract $2$ from both sides. " * 5
    assert extract.extract_one(text, "A")[0] == "S1"
    assert extract.extract_one("nothing here", "A") is None


def test_greedy_dedup_is_sequential(spark):
    import random

    rng = random.Random(3)
    words = "a b c d e f g h".split()
    rows = [(i, f"k{rng.randint(0, 40)}", sorted({rng.choice(words) for _ in range(rng.randint(0, 7))})) for i in range(60)]
    kept = []
    for _, k, s in rows:
        near = lambda u: bool(set(u) | set(s)) and 10000 * len(set(u) & set(s)) >= 8200 * len(set(u) | set(s))
        if not any(k == x[1] or near(x[2]) for x in kept):
            kept.append((_, k, s))
    out = dedup.dedup_questions(spark.createDataFrame(rows, "i long, k string, s array<string>"), "i", "k", "s", 8200)
    assert sorted(r["i"] for r in out.collect()) == [x[0] for x in kept]
