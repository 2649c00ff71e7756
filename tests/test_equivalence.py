"""Answer equivalence against exact values of generated expressions."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from lumenmill.operators import equivalence, gates
from lumenmill.operators.equivalence import DIFFERENT, SAME, UNDECIDED, verdict

CASES = [
    ("x(x+1)", "x^2+x", SAME), (r"\frac{2}{4}", "1/2", SAME), (r"\sqrt{8}", r"2\sqrt{2}", SAME), (r"\frac12", "0.5", SAME), ("1,000", "1000.0", SAME), (r"50\%", "0.5", SAME),
    (r"\frac{1}{\sqrt{2}}", r"\frac{\sqrt{2}}{2}", SAME), (r"\sqrt{6}", r"\sqrt{2}\cdot\sqrt{3}", SAME), (r"3\frac{1}{2}", "3.5", SAME), ("x^10", "x^{10}", SAME), (r"\left(\frac{a}{b}\right)^2", r"\frac{a^2}{b^2}", SAME),
    ("-3^2", "-9", SAME), ("x=5", "5=x", SAME), (r"\sin(x+x)", r"\sin(2x)", SAME), ("red", " red", SAME), (r"2\pi", r"\pi+\pi", SAME),
    ("x+1", "x+2", DIFFERENT), (r"\sqrt{2}+\sqrt{3}", r"\sqrt{5}", DIFFERENT), ("10^{400}", "10^{400}+1", DIFFERENT), ("2", "-2", DIFFERENT), (r"\sqrt{2}", r"-\sqrt{2}", DIFFERENT), (r"\pi", "3.14", DIFFERENT),
    (r"\sqrt{4x}", r"2\sqrt{x}", UNDECIDED), ("red", "blue", UNDECIDED), (r"\sin x", "x", UNDECIDED), ("5", "x=5", UNDECIDED), ("1/0", "2", UNDECIDED), ("i^2", "-1", UNDECIDED), (r"\sqrt[3]{8}", "2", UNDECIDED),
    ("", "", UNDECIDED), (None, "1", UNDECIDED), ("(" * 5000 + "1" + ")" * 5000, "1", UNDECIDED), ("1 2 3", "4", UNDECIDED), ("x +", "x", UNDECIDED), (r"\text{cm}", "1", UNDECIDED),
]


@pytest.mark.parametrize(("a", "b", "want"), CASES)
def test_verdicts(a, b, want):
    assert verdict(a, b) == verdict(b, a) == want


def made(rng, depth):
    """A random expression in LaTeX and its exact value at letters' values (none where it has none)."""
    if depth == 0 or rng.random() < 0.2:
        if rng.random() < 0.5:
            name = rng.choice("xyz")
            return name, lambda at: at[name]
        n = rng.choice([0, 1, 2, 3, 7, 12])
        return str(n), lambda at: Fraction(n)
    (a, f), (b, g) = made(rng, depth - 1), made(rng, depth - 1)
    kind = rng.choice("+-*/^")
    if kind == "^":
        k = rng.randint(0, 3)
        return f"({a})^{{{k}}}", lambda at: None if f(at) is None else f(at) ** k

    def value(at):
        x, y = f(at), g(at)
        if x is None or y is None or kind == "/" and y == 0:
            return None
        return x + y if kind == "+" else x - y if kind == "-" else x * y if kind == "*" else x / y

    text = rf"\frac{{{a}}}{{{b}}}" if kind == "/" else f"({a})({b})" if kind == "*" and rng.random() < 0.5 else f"({a}){kind}({b})"
    return text, value


def test_generated_expressions_against_exact_values():
    rng, seen = random.Random(12), {SAME: 0, DIFFERENT: 0}
    pool = [made(rng, rng.randint(1, 3)) for _ in range(300)]
    points = [{c: Fraction(rng.randint(-10**6, 10**6), rng.randint(1, 10**3)) for c in "xyz"} for _ in range(6)]
    for _ in range(4000):
        (a, f), (b, g) = rng.choice(pool), rng.choice(pool)
        if rng.random() < 0.5:  # the same written otherwise
            b, g = rng.choice([(f"{b}-({b})+({a})", lambda at, f=f, g=g: None if g(at) is None else f(at)), (f"(1+1)({a})/2", f), (f"0.5({a}+{a})", f)])
        pairs = [(f(at), g(at)) for at in points]
        if any(x is None or y is None for x, y in pairs):
            assert verdict(a, b) in (UNDECIDED, SAME, DIFFERENT)
            continue
        want = SAME if all(x == y for x, y in pairs) else DIFFERENT
        assert verdict(a, b) == want, (a, b)
        seen[want] += 1
    assert min(seen.values()) > 300


def test_columns(spark):
    rows = spark.createDataFrame([(a, b, w) for a, b, w in CASES], "a string, b string, want string")
    assert rows.filter(equivalence.answer_verdict(F.col("a"), F.col("b")) != F.col("want")).count() == 0
    same = gates.same_answer(F.col("a"), F.col("b"), equivalence.answer_verdict(F.col("a"), F.col("b")) == "same")
    assert rows.filter(same).filter("a <> ''").count() == sum(w == SAME for *_, w in CASES)
    assert rows.limit(0).select(equivalence.answer_verdict(F.col("a"), F.col("b"))).count() == 0
