"""Scalar text functions as Spark columns."""

from __future__ import annotations

from functools import partial, reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import ANSWER_LIKE, BOXED_PLAIN, CONCEPT_MARK, EXCESS_BLANK, EXPLICIT_QUESTION, LIST_MARK, NEXT_PROBLEM, NEXT_Q, PROBLEM_UNIT, RESCUE, ROLE_LINE, SESSION_WORD, THINK, P

# What ``(?U)[\s\x1c-\x1f]`` matches, character by character: a trim looks at both ends alone, where a pattern would try every place of a text.
WHITE = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
BLANK = WHITE.translate(dict.fromkeys(range(0x1C, 0x20)))  # what ``(?U)\s`` matches


def strip(c: Column) -> Column:
    """White space by Unicode rules off both ends (TXT helper)."""
    return F.btrim(c, F.lit(WHITE))


def strip_end(c: Column) -> Column:
    return F.rtrim(c, F.lit(WHITE))


def count(c: Column, p: P) -> Column:
    return F.regexp_count(c, F.lit(p.java)).cast("long")


def has(c: Column, p: P) -> Column:
    return c.rlike(p.java)


def sub(c: Column, p: P, to: str = "") -> Column:
    return F.regexp_replace(c, p.java, to)


def per(n: Column, c: Column, chars: int) -> Column:
    """A number of matches in ``c`` per so many characters; 0 for an empty text."""
    return F.when(F.length(c) > 0, n / (F.length(c) / F.lit(float(chars)))).otherwise(F.lit(0.0))


def density(c: Column, p: P, chars: int) -> Column:
    """Matches per ``chars`` characters; 0 for an empty text (FLT1, FLT2)."""
    return per(F.regexp_count(c, F.lit(p.java)), c, chars)


def let(x: Column, f) -> Column:
    """``f`` of a value that is computed once: what is built of many uses of a long expression stays small."""
    return F.get(F.transform(F.array(x), f), 0)


def nullif_empty(c: Column) -> Column:
    return let(c, lambda x: F.when(x != "", x))


def where(c: Column, marks: tuple[str, ...], f) -> Column:
    """``f`` of a text that has one of ``marks``, without which ``f`` changes nothing: looking for them costs less than a pattern that is tried at every place."""
    return let(c, lambda x: F.when(reduce(or_, (F.contains(x, F.lit(m)) for m in marks)), f(x)).otherwise(x))


def compress_blank(c: Column) -> Column:
    return where(c, ("\n\n\n",), lambda x: sub(x, EXCESS_BLANK, "\n\n"))


def light_clean(c: Column) -> Column:
    """TXT13."""
    c = F.replace(F.coalesce(c, F.lit("")), F.lit("\r"), F.lit("\n"))
    c = where(c, ("://",), lambda x: F.regexp_replace(x, r"(?Ud)https?://\S+", " "))
    c = where(c, ("  ", "\t"), lambda x: F.regexp_replace(x, r" [ \t]+|\t[ \t]*", " "))  # a lone blank stays as it is
    return strip(compress_blank(c))


def title(c: Column) -> Column:
    """TXT14: the first H1."""
    return light_clean(F.regexp_extract(F.coalesce(c, F.lit("")), r"(?Udm)^#\s+(.+)", 1))


def normalise(c: Column) -> Column:
    """TXT15: the form that near-duplicate tests compare."""
    c = F.regexp_replace(F.lower(light_clean(c)), BOXED_PLAIN.java, " ")
    return F.btrim(F.regexp_replace(c, r"[^0-9a-z\x{4e00}-\x{9fff}]+", " "))


def tokens(c: Column) -> Column:
    """TXT38: distinct tokens of the normalised text; none for an empty one."""
    return let(normalise(c), lambda n: F.when(n == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.split(n, " "))))


def last_boxed(c: Column) -> Column:
    """TXT16."""
    return F.coalesce(F.try_element_at(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(BOXED_PLAIN.java), F.lit(1)), F.lit(-1)), F.lit(""))


def jaccard(a: Column, b: Column) -> Column:
    """TXT39 over distinct arrays; 0 where both are empty."""
    both = F.size(F.array_intersect(a, b))
    return both / F.greatest(F.lit(1), F.size(a) + F.size(b) - both)


def bigrams(c: Column) -> Column:
    """TXT37: the set of word pairs of the lower-cased text, of words where it has fewer than two."""

    def pairs(w: Column) -> Column:
        both = F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda x, y: F.concat_ws(" ", x, y))
        return F.array_distinct(F.filter(F.when(F.size(w) >= 2, both).otherwise(w), lambda x: x != ""))

    return let(F.split(F.regexp_replace(strip(F.lower(c)), r"(?Ud)[\s\x1c-\x1f]+", " "), " "), pairs)


def fingerprint120(c: Column) -> Column:
    return F.substring(F.regexp_replace(strip(F.lower(c)), r"(?Ud)[\s\x1c-\x1f]+", " "), 1, 120)


def clean_question(c: Column, fallback: str | Column = "") -> Column:
    """TXT17: the first question of 8 to 220 characters, else the first line; labels off, a question mark on, 220 characters at most."""
    return let(light_clean(c), lambda raw: _question(raw, fallback))


def _question(raw: Column, fallback: str | Column) -> Column:
    # a text without a question mark would try 220 characters from every place
    asked = F.when(raw.rlike("[?？]"), F.regexp_extract(raw, r"[^?？\n]{8,220}[?？]", 0))
    q = F.coalesce(nullif_empty(strip(asked)), strip(F.substring_index(raw, "\n", 1)))
    q = F.regexp_replace(F.regexp_replace(q, r"(?Ud)^[\-\d\.\)\s]+", ""), r"(?Uid)^(question|instruction)\s*[:：]\s*", "")
    q = F.regexp_replace(q, r"^[ \"'`]+|[ \"'`]+$", "")
    given = fallback if isinstance(fallback, Column) else F.lit(fallback)
    q = F.coalesce(nullif_empty(q), nullif_empty(given), F.lit("What is the main mathematical question in this source unit?"))
    return let(q, lambda x: F.substring(F.when(x.rlike("[?？]$"), x).otherwise(F.concat(F.regexp_replace(x, "[。.:：]+$", ""), F.lit("?"))), 1, 220))


def short_hash(c: Column) -> Column:
    """TXT31."""
    return F.left(F.sha2(c, 256), F.lit(8))


def chunk_id(doc: Column, index: Column) -> Column:
    """TXT32."""
    return F.format_string("%s__chunk%03d", doc.cast("string"), index.cast("int"))


def chat(system: Column, user: Column, assistant: Column) -> Column:
    """TXT33: three turns in fixed order."""
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return F.array(turn("system", system), turn("user", user), turn("assistant", assistant))


def with_reasoning(reasoning: Column, answer: Column) -> Column:
    """TXT24."""
    return F.concat(F.lit("<think>"), reasoning, F.lit("</think>\n"), answer)


def estimated_tokens(c: Column) -> Column:
    """TXT30."""
    return F.floor(F.length(c) / 3.5).cast("long")


def explicit_question(unit: Column, title_: Column) -> Column:
    """TXT18: the question that a marked place asks, else the first line that is a question and no answer, else a title that asks; '' if none does."""
    unit = F.coalesce(unit, F.lit(""))
    marked = [nullif_empty(F.regexp_extract(unit, q.java, 1)) for q in EXPLICIT_QUESTION]
    lines = F.transform(F.split(light_clean(unit), "\n"), strip)
    asks = lambda x: x.endswith("?") & F.length(x).between(12, 220) & ~x.rlike(r"\A(\*\*|#)") & ~F.contains(x, F.lit("Tags")) & ~has(x, ANSWER_LIKE)
    found = F.coalesce(*marked, F.get(F.filter(lines, asks), 0), F.when(strip(title_).endswith("?"), title_))
    return F.coalesce(let(found, lambda q: F.when(q.isNotNull(), clean_question(q))), F.lit(""))


def problem_unit(c: Column, most: int = 1400) -> Column:
    """TXT19: the first block of problem and solution, else the head of a text that has such marks and a question; '' otherwise."""
    c = F.coalesce(c, F.lit(""))
    blocks = [nullif_empty(F.regexp_extract(c, q.java, 1)) for q in PROBLEM_UNIT]
    head = light_clean(F.substring(c, 1, most))
    marked = F.exists(F.array(*map(F.lit, ("Problem", "Question", "Solution", "Answer"))), lambda w: F.contains(c, w))
    whole = let(head, lambda h: F.when(marked & F.contains(h, F.lit("?")), h).otherwise(""))
    return F.coalesce(let(F.coalesce(*blocks), lambda b: F.when(b.isNotNull(), light_clean(F.substring(b, 1, most)))), whole)


def concept_excerpt(c: Column, most: int = 900) -> Column:
    """TXT20: paragraphs with a marker until ``most`` characters are reached, else the first three."""
    return let(F.filter(F.transform(F.split(light_clean(c), r"(?U)\n\s*\n"), strip), lambda x: x != ""), lambda blocks: _excerpt(blocks, most))


def _excerpt(blocks: Column, most: int) -> Column:
    """Blocks of a cleaned text joined as they stand are clean. A block is looked through only while fewer than ``most`` characters are found, and its length is taken once."""
    marked = lambda x: let(F.lower(x), lambda low: F.exists(F.array(*map(F.lit, CONCEPT_MARK)), lambda w: F.contains(low, w)))
    found = lambda got, x: F.struct(F.concat(got["kept"], F.array(x)).alias("kept"), (got["n"] + F.length(x) + F.when(got["n"] > 0, 2).otherwise(0)).alias("n"))
    grow = lambda got, x: F.when(got["n"] >= most, got).otherwise(F.when(marked(x), found(got, x)).otherwise(got))
    kept = F.aggregate(blocks, F.struct(F.array().cast("array<string>").alias("kept"), F.lit(0).alias("n")), grow, lambda got: got["kept"])
    return let(kept, lambda k: F.substring(F.array_join(F.when(F.size(k) > 0, k).otherwise(F.slice(blocks, 1, 3)), "\n\n"), 1, most))


def without_thinking(c: Column) -> Column:
    """What a model's reply keeps: no thinking, no turn symbols (LLM2)."""
    return F.replace(F.replace(where(c, ("<think>",), lambda x: sub(x, THINK)), F.lit("⚇"), F.lit("")), F.lit("⚼"), F.lit(""))


def _without_leaks(c: Column) -> Column:
    c = where(c, (":", "："), lambda x: sub(x, ROLE_LINE))
    return F.regexp_replace(c, "(?Udi)(?=[apr])" + SESSION_WORD.body, "")  # a look at one letter saves three tries at a place


def _without_boxes(c: Column) -> Column:
    return where(c, ("\\boxed{",), lambda x: sub(x, BOXED_PLAIN))


def _ended(c: Column) -> Column:
    return F.when((c == "") | c.endswith("。") | c.endswith(".") | c.endswith("!") | c.endswith("?"), c).otherwise(F.concat(c, F.lit("。")))


def rescue_boxed(c: Column) -> Column:
    """TXT22: the first of seven forms of a final answer at the end of a text; '' if none is there."""
    return let(strip(c), lambda text: let(_last_lines(text), lambda lines: _rescued(text, lines)))


def _last_lines(text: Column, most: int = 6, near: int = 2000) -> Column:
    """The last lines that are not blank: of the end of a text where it has more than ``most``, as the first may be cut, else of all of it."""
    split = lambda c: F.filter(F.transform(F.split(c, r"[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"), strip), lambda x: x != "")
    last = lambda x: F.when(F.size(x) > most, F.slice(x, -most, most))
    return F.coalesce(let(split(F.right(text, F.lit(near))), last), let(split(text), lambda x: F.coalesce(last(x), x)))


def _displayed(text: Column) -> Column:
    """What stands between the first ``$$`` of a text and the ``$$`` that ends it, after which a full stop may stand; null if none does. The pattern of this form reads the rest of a text from every ``$$``."""
    stopped = F.when(text.endswith(".") | text.endswith("。"), F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    between = lambda x: F.when(x.endswith("$$"), F.substring(x, F.instr(x, "$$") + 2, F.length(x) - F.instr(x, "$$") - 3))
    return let(F.when(F.contains(text, F.lit("$$")), F.rtrim(stopped, F.lit(BLANK))), between)


def _rescued(text: Column, lines: Column) -> Column:
    places = {"lines": F.array_join(lines, " "), "last": F.coalesce(F.try_element_at(lines, F.lit(-1)), F.lit(""))}

    def sure(least: int, most: int, v: Column) -> Column:
        free = ~v.startswith("=") & ~F.contains(v, F.lit("\\begin{array}")) & ~F.contains(v, F.lit("\\begin{align"))
        return F.when(F.length(v).between(least, most) & free, v)

    found = []
    for q, place, trim, least, most in RESCUE:
        v = F.regexp_replace(_displayed(text), r"(?U)\s+", " ") if place == "text" else F.regexp_extract(places[place], q.java, 1)
        v = strip(v)
        v = F.regexp_replace(v, f"[{trim}]+\\z", "") if trim else v
        found.append(let(v, partial(sure, least, most)))
    return F.coalesce(*found, F.lit(""))


def _first_reply(c: Column) -> Column:
    return where(c, ("\n#",), lambda x: sub(sub(x, NEXT_Q), NEXT_PROBLEM))


def clean_answer(c: Column) -> Column:
    """TXT21: a reply without leaks and following questions, its last box (or a rescued one) alone at the end."""
    x = without_thinking(strip(F.coalesce(c, F.lit(""))))
    return let(strip(compress_blank(_without_leaks(_first_reply(x)))), _boxed_last)


def _boxed_last(x: Column) -> Column:
    box = lambda body, answer: F.concat(_ended(body), F.lit("\n\n\\boxed{"), answer, F.lit("}"))
    kept = let(compress_blank(strip(_without_boxes(x))), lambda body: strip(box(body, strip(last_boxed(x)))))
    rescued = let(rescue_boxed(x), lambda r: F.when(r != "", box(x, r)).otherwise(x))
    return F.when(has(x, BOXED_PLAIN), kept).otherwise(rescued)


def clean_reasoning(c: Column) -> Column:
    """TXT23."""
    x = where(strip(F.coalesce(c, F.lit(""))), ("think>",), lambda x: F.regexp_replace(x, "</?think>", ""))
    return strip(compress_blank(_without_boxes(_without_leaks(x))))


def parse_judge(c: Column) -> Column:
    """TXT25: four marks (1 where absent), keep and reason."""
    raw = light_clean(c)
    mark = lambda k: F.coalesce(F.regexp_extract(raw, rf"(?i){k}\s*=\s*([1-5])", 1).try_cast("int"), F.lit(1)).alias(k)
    keep = F.lower(F.regexp_extract(raw, r"(?i)keep\s*=\s*(yes|no)", 1)) == "yes"
    reason = F.coalesce(nullif_empty(strip(F.regexp_extract(raw, r"(?id)reason\s*=\s*(.+)", 1))), F.substring(raw, 1, 200))
    return F.struct(*(mark(k) for k in ("groundedness", "reasoning", "pedagogy", "format")), keep.alias("keep"), reason.alias("reason"))


def parse_questions(c: Column, most: int = 2) -> Column:
    """TXT26: questions of a list, distinct, ``most`` at most; a line is cut to 220 characters after the test for repeats."""
    lines = F.transform(F.split(light_clean(c), "\n"), lambda x: strip(sub(x, LIST_MARK)))
    lines = F.transform(F.filter(lines, lambda x: F.length(x) >= 10), lambda x: F.when(x.rlike(r"[?？]\z"), x).otherwise(F.concat(F.regexp_replace(x, r"[。.:：]+\z", ""), F.lit("?"))))
    add = lambda acc, x: F.when((F.size(acc) >= most) | F.array_contains(acc, x), acc).otherwise(F.array_append(acc, F.substring(x, 1, 220)))
    return F.aggregate(lines, F.array().cast("array<string>"), add)
