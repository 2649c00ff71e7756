"""Queries with the SQL that states the same result, and pieces of that SQL (dialect: DuckDB, whose regular expressions are RE2's)."""

from __future__ import annotations

from ..functions import patterns as p
from .fixture import MATHDOCS_SQL

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def n(c: str, q: p.P) -> str:
    return f"len(regexp_extract_all({c}, {lit(q.re2)}))"


def rx(c: str, q: p.P, to: str = "") -> str:
    return f"regexp_replace({c}, {lit(q.re2)}, {lit(to)}, 'g')"


def has(c: str, q: p.P) -> str:
    return f"regexp_matches({c}, {lit(q.re2)})"


def strip(c: str) -> str:
    return rf"regexp_replace({c}, '\A[\s\x1c-\x1f\x0b\x{{85}}\x{{a0}}]+|[\s\x1c-\x1f\x0b\x{{85}}\x{{a0}}]+\z', '', 'g')"


def compress(c: str) -> str:
    return rx(c, p.EXCESS_BLANK, chr(10) * 2)


def light(c: str) -> str:
    x = rf"regexp_replace(replace(coalesce({c}, ''), chr(13), chr(10)), 'https?://\S+', ' ', 'g')"
    return strip(compress(rf"regexp_replace({x}, '[ \t]+', ' ', 'g')"))


def title(c: str) -> str:
    return light(rf"regexp_extract(coalesce({c}, ''), '(?m)^#\s+(.+)', 1)")


def normal(c: str) -> str:
    return rf"trim(regexp_replace({rx(f'lower({light(c)})', p.BOXED_PLAIN, ' ')}, '[^0-9a-z\x{{4e00}}-\x{{9fff}}]+', ' ', 'g'))"


def last_boxed(c: str) -> str:
    return f"coalesce(regexp_extract_all({c}, {lit(p.BOXED_PLAIN.re2)}, 1)[-1], '')"


def any_of(c: str, words) -> str:
    return "(" + " or ".join(f"contains({c}, {lit(w)})" for w in words) + ")"


def flags(*given: tuple[str, str]) -> str:
    """Names of the conditions that hold, in order, comma-joined."""
    return "concat_ws(',', " + ", ".join(f"case when {cond} then '{name}' end" for name, cond in given) + ")"


def question(raw: str, fallback: str = "''") -> str:
    """TXT17 of a lightly cleaned text."""
    asked = rf"case when regexp_matches({raw}, '[?？]') then regexp_extract({raw}, '[^?？\n]{{8,220}}[?？]') end"
    q = f"coalesce(nullif({strip(asked)}, ''), {strip(f'split_part({raw}, chr(10), 1)')})"
    q = rf"regexp_replace(regexp_replace({q}, '^[\-\d\.\)\s]+', ''), '(?i)^(question|instruction)\s*[:：]\s*', '')"
    q = rf"""regexp_replace({q}, '^[ "''`]+|[ "''`]+$', '', 'g')"""
    q = f"coalesce(nullif({q}, ''), nullif({fallback}, ''), 'What is the main mathematical question in this source unit?')"
    return rf"""list_transform([{q}], lambda x: left(case when regexp_matches(x, '[?？]$') then x else regexp_replace(x, '[。.:：]+$', '') || '?' end, 220))[1]"""


def lines(c: str) -> str:
    return f"list_transform(string_split({c}, chr(10)), lambda x: {strip('x')})"


M = f"with m as ({MATHDOCS_SQL})"
