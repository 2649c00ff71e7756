from pyspark.sql import functions as F

from lumenmill.functions import register

TEXTS = ["# A title?\n\nWhat is $x$ of 'two' sums? so $x = 5$\n\\boxed{3}", "## Problem\n\nFind x.\n\n## Solution\n\nWe add. Thus, the answer is $7$.", "Definition: a ratio.\n\n\n\n1 + 1 = 2\n" * 9, "a\n\n**WRONG**: no\n\nb", "", None]


def test_every_registered_function_equals_its_column(spark):
    names = register.register(spark)
    df = spark.createDataFrame([(x, TEXTS[(i + 1) % len(TEXTS)]) for i, x in enumerate(TEXTS)], "a string, b string")
    assert len(names) == len(register.scalars()) > 35
    for name, (params, _, f) in register.scalars().items():
        many = "ARRAY" in params
        args = [F.split(x, " ") if many else F.col(x) for x in ("a", "b")[: params.count(",") + 1]]
        call = ", ".join(f"split({x}, ' ')" if many else x for x in ("a", "b")[: params.count(",") + 1])
        got = df.select(F.expr(f"lm_{name}({call})").alias("x"), f(*args).alias("y")).collect()
        assert [r["x"] for r in got] == [r["y"] for r in got], name
