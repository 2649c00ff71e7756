"""Whether two answers say the same (DES2): LaTeX expressions as values at points modulo primes.

An answer is parsed as a rational expression of numbers, letters, fractions, powers and roots. Two expressions are the same if they are so at points whose coordinates follow from the letters'
names, modulo primes of 61 bits; two that differ at one point are different, as numbers and rational functions have but one value there. The root of a whole number is the product of its prime factors' roots, each
chosen once for a prime, modulo a prime that has them all. What has no exact value there (a root of letters, a function) stands for itself: where it is the same on both sides so are its values, but a difference
proves nothing, and the verdict is ``undecided``, as it is for what can't be parsed."""

from __future__ import annotations

import hashlib
import re
from fractions import Fraction
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SAME, DIFFERENT, UNDECIDED = "same", "different", "undecided"
_TOKEN = re.compile(r"\\[A-Za-z]+|\\[%$ ,;!]|\d+(?:,\d{3})+(?!\d)(?:\.\d+)?|\d+\.\d+|\.\d+|\d+|[A-Za-z]|[-+*/^(){}\[\]=]|\S")
# Commands by what they do here.
_DROPPED = {"\\left", "\\right", "\\displaystyle", "\\,", "\\;", "\\!", "\\ ", "\\$", "$", "\\quad", "\\limits", "\\big", "\\Big"}
_TIMES, _OVER = {"*", "\\cdot", "\\times", "·", "×"}, {"/", "\\div", "÷"}
_FRACTIONS = {"\\frac", "\\dfrac", "\\tfrac", "\\cfrac"}
_FUNCTIONS = {"\\sin", "\\cos", "\\tan", "\\cot", "\\sec", "\\csc", "\\ln", "\\log", "\\exp", "\\arcsin", "\\arccos", "\\arctan"}
_LETTERS = {f"\\{x}" for x in "alpha beta gamma delta epsilon theta lambda mu pi rho sigma phi omega infty".split()}
_VAGUE = {"i", "e", "\\infty"}  # letters that may be constants with rules of their own
_MOST_POWER = 1 << 20


class NoParse(Exception):
    pass


class Parser:
    """A tree of tuples: (kind, ...)."""

    def __init__(self, text: str):
        if re.search(r"(?<![\\A-Za-z])[A-Za-z]{3,}", text) or re.search(r"\\(text|mathrm|mbox)", text):
            raise NoParse
        self.tokens, self.at = [x for x in _TOKEN.findall(text) if x not in _DROPPED], 0

    def whole(self):
        got = self.sum()
        if self.at < len(self.tokens) and self.tokens[self.at] == "=":
            self.at += 1
            got = ("equation", got, self.sum())
        if self.at < len(self.tokens):
            raise NoParse
        return got

    def peek(self) -> str:
        return self.tokens[self.at] if self.at < len(self.tokens) else ""

    def take(self, token: str = "") -> str:
        got = self.peek()
        if not got or token and got != token:
            raise NoParse
        self.at += 1
        return got

    def sum(self):
        out = self.product()
        while self.peek() in ("+", "-"):
            out = ("+" if self.take() == "+" else "-", out, self.product())
        return out

    def product(self):
        if self.peek() in ("-", "+"):
            return ("-", ("number", Fraction(0)), self.product()) if self.take() == "-" else self.product()
        out = self.power()
        while True:
            x = self.peek()
            if x in _TIMES or x in _OVER:
                self.take()
                sign = self.peek() == "-" and self.take()
                right = self.power()
                right = ("-", ("number", Fraction(0)), right) if sign else right
                out = ("*" if x in _TIMES else "/", out, right)
            elif x and (x[0].isalnum() or x == "(" or x == "{" or x[0] == "\\" and x != "\\%"):
                if x[0].isdigit() and self.tokens[self.at - 1][-1].isdigit():
                    raise NoParse  # two numbers side by side
                if x in _FRACTIONS and self.tokens[self.at - 1][-1].isdigit() and (self.at < 2 or self.tokens[self.at - 2] not in ("}", "^")):
                    out = ("+", out, self.power())  # a mixed number
                else:
                    out = ("*", out, self.power())
            else:
                return out

    def power(self):
        out = self.atom()
        while self.peek() in ("^", "\\%"):
            if self.take() == "\\%":
                out = ("/", out, ("number", Fraction(100)))
            else:
                out = ("^", out, self.argument(whole=True))
        return out

    def argument(self, whole: bool = False):
        """What a command or a power takes: a group or one token; of a number its first digit, but for a power, which is told as people write it."""
        if self.peek() == "{":
            return self.group("{", "}")
        if self.peek() == "-":
            self.take()
            return ("-", ("number", Fraction(0)), self.argument(whole))
        x = self.peek()
        if x.isdigit() and len(x) > 1 and not whole:
            self.tokens[self.at : self.at + 1] = [x[0], x[1:]]
        return self.atom()

    def group(self, left: str, right: str):
        self.take(left)
        out = self.sum()
        self.take(right)
        return out

    def atom(self):
        x = self.peek()
        if x in ("(", "{"):
            return self.group(x, ")" if x == "(" else "}")
        self.take() if x else self.take("a value")
        if x[0].isdigit() or x[0] == ".":
            return ("number", Fraction(x.replace(",", "")))
        if x in _FRACTIONS:
            return ("/", self.argument(), self.argument())
        if x == "\\sqrt":
            degree = self.group("[", "]") if self.peek() == "[" else ("number", Fraction(2))
            return ("^", self.argument(), ("/", ("number", Fraction(1)), degree))
        if x in _FUNCTIONS:
            raised = self.take() and self.argument() if self.peek() == "^" else None
            inner = self.group("(", ")") if self.peek() == "(" else self.power()
            out = ("function", x, inner)
            return ("^", out, raised) if raised else out
        if len(x) == 1 and x.isalpha() or x in _LETTERS:
            return ("letter", x)
        raise NoParse


@lru_cache(4096)
def _factors(n: int) -> tuple[tuple[int, int], ...] | None:
    """Prime factors of a number up to 10^12, by division; none beyond."""
    if n > 10**12:
        return None
    out, q = [], 2
    while q * q <= n:
        k = 0
        while n % q == 0:
            n, k = n // q, k + 1
        if k:
            out.append((q, k))
        q += 1 if q == 2 else 2
    return tuple(out + [(n, 1)] if n > 1 else out)


@lru_cache(4096)
def _root(q: int, p: int) -> int | None:
    """A square root of q modulo p, of p = 3 modulo 4; none if there is none."""
    r = pow(q, (p + 1) // 4, p)
    return min(r, p - r) if r * r % p == q % p else None


def _is_prime(n: int) -> bool:
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37):  # enough below 3.3 * 10^24
        x = pow(a, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(s - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


@lru_cache(1)
def primes(most: int = 192) -> list[int]:
    """Primes of 61 bits that are 3 modulo 4."""
    out, n = [], (1 << 61) - 1
    while len(out) < most:
        if _is_prime(n):
            out.append(n)
        n -= 4
    return out


class NoValue(Exception):
    """This point or prime doesn't do."""


class Point:
    """Values of trees at one point; ``vague`` tells whether something stood for itself."""

    def __init__(self, p: int, seed: int):
        self.p, self.seed, self.vague = p, seed, False

    def named(self, name: str) -> int:
        return int.from_bytes(hashlib.blake2b(f"{self.seed}:{name}".encode(), digest_size=16).digest(), "big") % self.p

    def constant(self, tree) -> Fraction | None:
        """The number that a tree is, where it has neither letters nor roots."""
        kind = tree[0]
        if kind == "number":
            return tree[1]
        if kind in ("+", "-", "*", "/", "^"):
            a, b = self.constant(tree[1]), self.constant(tree[2])
            if a is None or b is None:
                return None
            if kind == "^":
                small = b.denominator == 1 and abs(b) <= 64 and abs(a.numerator) < 1 << 64 and a.denominator < 1 << 64
                return a**b.numerator if small and (a or b >= 0) else None
            if kind == "/":
                return a / b if b else None
            return a + b if kind == "+" else a - b if kind == "-" else a * b
        return None

    def value(self, tree) -> int:
        kind, p = tree[0], self.p
        if kind == "number":
            return tree[1].numerator * self.over(tree[1].denominator) % p
        if kind == "letter":
            self.vague |= tree[1] in _VAGUE
            return self.named(tree[1])
        if kind == "function":
            self.vague = True
            return self.named(f"{tree[1]} {self.value(tree[2])}")
        if kind == "equation":
            return self.named("=") * (self.value(tree[1]) - self.value(tree[2])) % p
        if kind == "^":
            return self.raised(tree[1], tree[2])
        a, b = self.value(tree[1]), self.value(tree[2])
        return (a + b if kind == "+" else a - b if kind == "-" else a * b if kind == "*" else a * self.over(b)) % p

    def over(self, x: int) -> int:
        if x % self.p == 0:
            raise NoValue
        return pow(x, -1, self.p)

    def raised(self, base, power) -> int:
        k = self.constant(power)
        if k is not None and abs(k.numerator) <= _MOST_POWER:
            if k.denominator == 1:
                x = self.value(base)
                return pow(x, k.numerator, self.p) if k >= 0 else pow(self.over(x), -k.numerator, self.p)
            if k.denominator == 2:
                root = self.root(base)
                return pow(root, k.numerator, self.p) if k >= 0 else pow(self.over(root), -k.numerator, self.p)
        self.vague = True  # a power of letters, a higher root
        return self.named(f"^ {self.value(base)} {self.value(power)}")

    def root(self, base) -> int:
        x = self.constant(base)
        if x is not None and x >= 0 and (_factors(x.numerator) is not None or not x) and _factors(x.denominator) is not None:
            if not x:
                return 0
            out = 1
            for part, up in ((x.numerator, True), (x.denominator, False)):
                for q, k in _factors(part):
                    r = _root(q, self.p) if k % 2 else 1
                    if r is None:
                        raise NoValue
                    whole = pow(q, k // 2, self.p) * r % self.p
                    out = out * (whole if up else self.over(whole)) % self.p
            return out
        self.vague = True
        return self.named(f"root {self.value(base)}")


def verdict(a: str | None, b: str | None, points: int = 4) -> str:
    """``same``, ``different`` or ``undecided``. Empty and null answers are undecided, as is an equation beside an expression."""
    if not (a or "").strip() or not (b or "").strip():
        return UNDECIDED
    if "".join(a.split()) == "".join(b.split()):
        return SAME
    try:
        one, two = Parser(a).whole(), Parser(b).whole()
    except (NoParse, RecursionError, IndexError, ZeroDivisionError):
        return UNDECIDED
    if (one[0] == "equation") != (two[0] == "equation"):
        return UNDECIDED
    equal, seed = 0, 0
    for p in primes():
        point, seed = Point(p, seed), seed + 1
        try:
            x, y = point.value(one), point.value(two)
        except NoValue:
            continue
        except RecursionError:
            return UNDECIDED
        if one[0] == "equation":  # the same up to a factor that is a number: a ratio that no point changes
            if x == 0 or y == 0:
                return SAME if x == y else UNDECIDED
            ratio = x * pow(y, -1, p) % p
            if ratio not in (1, p - 1):
                return UNDECIDED
        elif x != y:
            return UNDECIDED if point.vague else DIFFERENT
        equal += 1
        if equal == points:
            return SAME
    return UNDECIDED


def answer_verdict(given: Column, found: Column) -> Column:
    """:func:`verdict` of two columns, in Arrow batches."""

    @F.pandas_udf("string")
    def verdicts(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([verdict(x, y) for x, y in zip(a, b, strict=True)], dtype=object)

    return verdicts(given, found)
