"""Layered quality gates of extracted pairs and of generated answers (FLT16-FLT28, AGG6, DES1, DES5, DES13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as p
from ..functions import text as t


def _last_full(c: Column) -> Column:
    return t.strip(F.try_element_at(F.regexp_extract_all(c, F.lit(p.BOXED_FULL.java), F.lit(1)), F.lit(-1)))


def gate_reason(problem: Column, solution: Column, relaxed: bool = False) -> Column:
    """L1-L6: the first failure as ``Ln:reason``, or null."""
    seen = lambda x: F.struct(x["p"].alias("p"), x["s"].alias("s"), F.regexp_count(x["s"], F.lit(p.BOXED.java)).alias("n"))
    return t.let(t.let(F.struct(problem.alias("p"), solution.alias("s")), seen), lambda x: _gate_reason(x["p"], x["s"], x["n"], relaxed))


def _gate_reason(problem: Column, solution: Column, found: Column, relaxed: bool) -> Column:
    # where the last boxed answer starts: what a greedy prefix leaves
    place = F.length(F.regexp_extract(solution, r"(?Uds)\A(.*)\\boxed\{[^}]*\}", 1))
    content = _last_full(solution)
    code = F.aggregate(F.regexp_extract_all(solution, F.lit(p.CODE_BLOCK.java), F.lit(0)), F.lit(0), lambda a, x: a + F.length(x))
    cut = t.let(F.lower(F.substring(t.strip_end(solution), -50, 50)), lambda end: F.exists(F.array(*map(F.lit, p.TRUNCATED)), lambda x: F.endswith(end, x)))  # the end is made once, not for every word
    n, m = F.length(problem), F.length(solution)
    start = t.strip(problem)
    return (
        F.when(found == 0, "L1:no_boxed")
        .when(found > (3 if relaxed else 1), F.concat(F.lit("L1:boxed_count_"), found.cast("string")))
        .when(F.coalesce(content, F.lit("")) == "", "L1:empty_boxed")
        .when(F.length(content) > 100, "L1:boxed_too_long")
        .when(place < 0.35 * m, "L1:boxed_too_early")
        .when((n < 30) | (n > 2000), F.concat(F.lit("L2:problem_length_"), n.cast("string")))
        .when((m < 150) | (m > 6000), F.concat(F.lit("L2:solution_length_"), m.cast("string")))
        .when(~((t.count(solution, p.LATEX_EXPR) >= 3) | (t.count(solution, p.CORE_MATH) >= 2) | (t.count(solution, p.ARITHMETIC) >= 4)), "L3:low_math_density")
        .when(t.has(solution, p.GATE_NOISE), F.concat(F.lit("L4:noise_keyword:"), F.substring(F.regexp_extract(solution, p.GATE_NOISE.java, 0), 1, 30)))
        .when(t.count(solution, p.URL) > 2, F.concat(F.lit("L4:too_many_urls_"), t.count(solution, p.URL).cast("string")))
        .when(code > 0.35 * m, "L4:code_block_dominant")
        .when(cut, "L4:truncated_ending")
        .when(~t.has(F.right(solution, F.lit(300)), p.BOXED), "L5:boxed_not_at_end")
        .when(t.has(start, p.DANGLING), "L6:dangling_reference_start")
        .when(t.has(start, p.EXTERNAL_REF), F.concat(F.lit("L6:external_reference:"), F.substring(F.regexp_extract(start, p.EXTERNAL_REF.java, 0), 1, 30)))
    )


def clean_answer(c: Column) -> Column:
    """FLT28."""
    a = t.strip(c)
    whole = rf"(?Uid)\A(?:{p.BOXED_NOISE.body})\z"
    return (F.length(a) > 0) & (F.length(a) <= 100) & ~a.rlike(r"\A[+,.;=*/]") & ~F.contains(a, F.lit("\n")) & ~a.rlike(whole)


def inject_boxed(solution: Column) -> Column:
    """TXT29: the solution with its final answer boxed at the end; null where it has a box or no sure answer. Later priorities are tried where an earlier answer isn't clean."""
    return t.let(solution, lambda s: F.when(~t.has(s, p.BOXED), t.let(F.right(s, F.lit(600)), lambda tail: _injected(s, tail))))


def _injected(solution: Column, tail: Column) -> Column:
    last = lambda c, q: t.strip(F.try_element_at(F.regexp_extract_all(c, F.lit(q.java), F.lit(1)), F.lit(-1)))
    closed = lambda q: F.when(tail.rlike(r"(?Udm)\$[.,;)!\s]*$"), last(tail, q))  # noqa: E731 - the end that both patterns have: without it their words need not be tried at every place
    ok = lambda a, most=100: t.let(a, lambda x: F.when(clean_answer(x) & (F.length(x) <= most), x))
    display = t.strip(F.regexp_replace(t.strip(t.nullif_empty(F.regexp_extract(solution, p.DISPLAY_FINAL.java, 1))), r"(?Ud)\A=\s*", ""))
    # the last inline formula, and up to 80 characters before it: what formulas part, read from the end
    formula = F.try_element_at(F.regexp_extract_all(tail, F.lit(p.INLINE.java), F.lit(0)), F.lit(-1))
    after = F.element_at(F.split(tail, p.INLINE.java), -1)
    context = F.right(F.left(tail, F.length(tail) - F.length(after) - F.length(formula)), F.lit(80))
    inline = t.strip(F.substr(formula, F.lit(2), F.length(formula) - 2))
    answer = F.coalesce(ok(closed(p.CONCLUSION_INLINE)), ok(closed(p.EQUATION_INLINE)), ok(display), ok(last(tail, p.ANSWER_LABEL)), F.when(t.has(context, p.CONCLUSION_WORD), ok(inline, 60)))
    return F.concat(t.strip_end(solution), F.lit("\n\n\\boxed{"), answer, F.lit("}"))  # null without an answer


def _flags(*given: tuple[str, Column]) -> Column:
    return F.array_compact(F.array(*(F.when(cond, F.lit(name)) for name, cond in given)))


def _leaks(c: Column) -> Column:
    return F.exists(F.array(*map(F.lit, p.LEAK_WORDS)), lambda w: F.contains(F.lower(c), w))


def _dots(c: Column) -> Column:
    return F.regexp_count(c, F.lit("[。.]"))


def answer_flags(question: Column, answer: Column, min_chars: int = 50, min_dots: int = 1) -> Column:
    """FLT16: flags in fixed order; nulls count as empty. DES17 asks for 80 characters and 2 full stops."""
    question, answer = F.coalesce(question, F.lit("")), F.coalesce(answer, F.lit(""))
    norm = t.let(F.struct(t.normalise(question).alias("q"), t.normalise(answer).alias("a")), lambda n: (n["q"] != "") & F.contains(n["a"], n["q"]) & (F.length(n["a"]) < F.length(n["q"]) + 80))
    boxed = F.contains(answer, F.lit("\\boxed{"))
    thin = ~F.contains(answer, F.lit("\n")) & (_dots(answer) < min_dots)
    copied = ~boxed & norm
    return _flags(("missing_boxed", ~boxed), ("prompt_leak", _leaks(answer)), ("too_short", F.length(answer) < min_chars), ("thin_reasoning", thin), ("question_copied", copied))


def reasoning_flags(c: Column, min_chars: int = 180) -> Column:
    """FLT17: flags in fixed order; null counts as empty. DES17 asks for 220 characters."""
    c = F.coalesce(c, F.lit(""))
    thin = (F.regexp_count(c, F.lit("\n")) < 2) & (_dots(c) < 4)
    return _flags(("reasoning_too_short", F.length(c) < min_chars), ("reasoning_prompt_leak", _leaks(c)), ("reasoning_too_thin", thin), ("reasoning_too_long", F.length(c) > 7000))


def question_rejected(c: Column) -> Column:
    """FLT19: a question that holds its own answer."""
    return F.contains(c, F.lit("\\boxed{")) | t.has(c, p.QUESTION_WITH_ANSWER)


def gated(pairs: DataFrame, relaxed: bool = False) -> DataFrame:
    """FLT27 without L7: ``boxed_injected``, the solution with its box, and ``gate`` (null: passed)."""
    out = pairs.withColumn("_boxed", inject_boxed(F.col("solution")))
    out = out.withColumn("boxed_injected", F.col("_boxed").isNotNull()).withColumn("solution", F.coalesce("_boxed", "solution")).drop("_boxed")
    return out.withColumn("gate", gate_reason(F.col("problem"), F.col("solution"), relaxed))


def judged_good(judge: Column) -> Column:
    """DES13: the least marks of a model's judgement (TXT25)."""
    return (judge["groundedness"] >= 3) & (judge["reasoning"] >= 3) & (judge["format"] >= 4)


def keep_rows(rows: DataFrame) -> DataFrame:
    """FLT18."""
    return rows.filter(F.coalesce(F.col("quality.keep"), F.lit(False)) & F.coalesce(F.col("reasoning_quality.keep"), F.lit(False)))


def token_band(c: Column) -> Column:
    """DES5 on the estimate of TXT30: drop, keep or shorten."""
    n = t.estimated_tokens(c)
    return F.when(n < 150, "drop").when(n > 900, "truncate").otherwise("keep")


def shortened(c: Column) -> Column:
    """DES5: a text over the band keeps its first three steps and its last; a step is a line that is not blank."""
    steps = F.filter(F.transform(F.split(c, "\n"), t.strip), lambda x: x != "")
    short = t.let(steps, lambda x: F.when(F.size(x) > 4, F.array_join(F.concat(F.slice(x, 1, 3), F.slice(x, -1, 1)), "\n")).otherwise(c))
    return F.when(token_band(c) == "truncate", short).otherwise(c)


def _value(c: Column) -> Column:
    """A number that an answer states (plain, with thousands, as a fraction), or null."""
    plain = F.regexp_replace(F.regexp_replace(c, r"\\[dt]?frac\{(-?[0-9.]+)\}\{([0-9.]+)\}", "$1/$2"), r"[\s$,]", "")
    number = plain.try_cast("double")
    over = F.regexp_extract(plain, r"\A(-?[0-9.]+)/([0-9.]+)\z", 1).try_cast("double"), F.regexp_extract(plain, r"\A(-?[0-9.]+)/([0-9.]+)\z", 2).try_cast("double")
    return F.coalesce(number, F.when(over[1] != 0, over[0] / over[1]))


def same_answer(a: Column, b: Column, other: Column | None = None) -> Column:
    """DES2: two answers that state one number, or are equal without blanks and dollar signs, or that ``other`` (a plug-in's verdict, such as a symbolic check) calls equal. Nulls are no answers."""
    bare = lambda c: F.regexp_replace(c, r"[\s$]", "")
    numbers = F.abs(_value(a) - _value(b)) <= 1e-9
    return F.coalesce(numbers, F.lit(False)) | F.coalesce(bare(a) == bare(b), F.lit(False)) | (F.coalesce(other, F.lit(False)) if other is not None else F.lit(False))
