"""Quality cascade, cleaning and rule classification: one pass of native expressions each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as p
from ..functions import text as t
from ..functions.counts import counts
from .names import fresh


REASONS = ("too_short", "low_nemo", "noise_dense", "low_math")  # the kinds of reason that the cascade gives


def quality_cascade(docs: DataFrame, text: str = "text", score: str = "score", min_len: int = 800, max_len: int = 50_000, min_score: float = 1.5, max_noise: float = 0.15, min_math: float = 0.5) -> DataFrame:
    """FLT1-FLT4: adds ``label`` (normal, long, discard) and ``reason``; tests run cheapest first and the first failure decides. A null text is empty, a null score 0."""
    c, s = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(score).cast("double"), F.lit(0.0))
    (n,) = fresh(docs, "counts")
    enough = (F.length(c) >= min_len) & (s >= min_score)
    docs = docs.withColumn(n, counts(F.when(enough, c), noise=p.NOISE, math=p.MATH))
    noise, math = t.per(F.col(n)["noise"], c, 100), t.per(F.col(n)["math"], c, 500)
    reason = (
        F.when(F.length(c) < min_len, F.format_string("too_short(%d)", F.length(c)))
        .when(s < min_score, F.format_string("low_nemo(%.2f)", s))
        .when(noise > max_noise, F.format_string("noise_dense(%.3f)", noise))
        .when(math < min_math, F.format_string("low_math(%.3f)", math))
    )
    return docs.withColumn("reason", reason).drop(n).withColumn("label", F.when(F.col("reason").isNotNull(), "discard").when(F.length(c) > max_len, "long").otherwise("normal"))


def reason_kind(c: Column) -> Column:
    return F.split_part(c, F.lit("("), F.lit(1))


def delete_wrong_sections(c: Column) -> Column:
    """TXT4: a labelled section goes, up to the next heading of its level or above; one literal pattern for each level, higher levels first."""
    for level in range(1, 5):
        head = p.WRONG_HEADER.body.replace("#{1,4}", f"#{{{level}}}")
        c = F.regexp_replace(c, rf"(?Udm){head}[\s\S]*?(?=^#{{1,{level}}}\s|\z)", "")
    return c


def delete_wrong_paragraphs(c: Column) -> Column:
    """TXT5: a paragraph with a wrong-answer label goes with the blank lines after it."""
    marked = F.regexp_replace(c, r"(\n{2,})", "$1\u0001")
    kept = F.filter(F.split(marked, "\u0001"), lambda x: ~F.regexp_replace(x, r"\n+\z", "").rlike(p.WRONG_LABEL.java))
    return F.array_join(kept, "")


CLEANING = (
    ("cms", lambda c: t.sub(t.sub(t.sub(t.sub(c, p.DEL), p.INS, "$1"), p.DEL_BARE), p.INS_BARE)),
    ("nav", lambda c: t.sub(c, p.NAV_LINE)),
    ("forum", lambda c: t.sub(c, p.FORUM_META)),
    ("wrong", lambda c: delete_wrong_paragraphs(delete_wrong_sections(c))),
    ("latex", lambda c: t.sub(t.sub(c, p.LATEX_DISPLAY, r"\$\$$1\$\$"), p.LATEX_INLINE, r"\$$1\$")),
    ("blank", t.compress_blank),
)


def clean(docs: DataFrame, text: str = "text", min_len: int = 600) -> DataFrame:
    """TXT1-TXT9, FLT5: the rule chain in order, with ``hit_<rule>`` columns and ``reason`` for texts that end up too short."""
    c = F.coalesce(F.col(text), F.lit(""))
    steps = [F.lit(0)]
    out = docs.withColumn("_t0", c)
    for i, (_, rule) in enumerate(CLEANING, 1):
        out = out.withColumn(f"_t{i}", rule(F.col(f"_t{i - 1}")))
        steps.append(F.col(f"_t{i}"))
    for i, (name, _) in enumerate(CLEANING, 1):
        out = out.withColumn(f"hit_{name}", F.col(f"_t{i}") != F.col(f"_t{i - 1}"))
    out = out.withColumn(text, t.strip(F.col(f"_t{len(CLEANING)}"))).drop(*(f"_t{i}" for i in range(len(CLEANING) + 1)))
    return out.withColumn("reason", F.when(F.length(text) < min_len, F.format_string("post_clean_too_short(%d)", F.length(text))))


def is_calculator(c: Column) -> Column:
    lines = F.filter(F.transform(F.split(c, "\n"), t.strip), lambda x: x != "")
    numeric = F.size(F.filter(lines, lambda x: x.rlike(p.NUMBER_LINE.java)))
    return (t.count(c, p.CALC_LINE) >= 8) | t.has(c, p.UNIT_TABLE) | ((F.size(lines) >= 10) & (2 * numeric > F.size(lines)))


def rule_label(c: Column) -> Column:
    """FLT6-FLT10: E, B, D, A or null."""
    return (
        F.when(is_calculator(c), "E")
        .when(t.count(c, p.FORUM_STRONG) >= 2, "B")
        .when((t.count(c, p.NUMBERED_SECTION) >= 2) & (t.count(c, p.FORMAL_BLOCK) >= 2), "D")
        .when(t.has(c, p.PROB_MARK) & t.has(c, p.SOL_MARK), "A")
    )


def fallback_label(c: Column, label: Column) -> Column:
    """FLT11: only the label F is looked at again."""
    return F.when(label == "F", F.coalesce(rule_label(c), undecided_label(c))).otherwise(label)


def undecided_label(c: Column) -> Column:
    return F.when(t.has(F.substring(c, 1, 800), p.WORD_PROBLEM) & (F.length(c) < 5000), "A").when(t.has(c, p.DEFINITION), "C").otherwise("F")


def classify(docs: DataFrame, text: str = "text", model=None) -> DataFrame:
    """Rules, then ``model`` (DataFrame -> DataFrame that adds ``model_label``) for the undecided, then the fallback: ``label`` and ``label_source``. Without a model the undecided count as F."""
    c = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn("_rule", t.let(c, rule_label))  # bound once: a filter on the label is pushed below what made the text
    if model is not None:
        out = model(out.filter("_rule is null")).unionByName(out.filter("_rule is not null"), allowMissingColumns=True)
    else:
        out = out.withColumn("model_label", F.lit("F"))
    given = F.coalesce("model_label", F.lit("F"))  # the rules have left these undecided: they need no second run
    out = out.withColumn("label", F.coalesce("_rule", F.when(given == "F", t.let(c, undecided_label)).otherwise(given)))
    return out.withColumn("label_source", F.when(F.col("_rule").isNotNull(), "rule").otherwise("model")).drop("_rule", "model_label")


def is_low_value(c: Column) -> Column:
    """FLT14."""
    return t.has(c, p.DIVISOR_PAGE) | (t.has(c, p.ISBN) & (F.length(c) < 4000)) | (t.has(c, p.CONTENTS_PAGE) & ~t.has(c, p.WORKED)) | (t.has(c, p.UPLOADED) & (F.length(c) < 3000))


def is_concept(title: Column, c: Column) -> Column:
    """FLT15."""
    return t.let(F.struct(F.lower(title).alias("low"), F.lower(F.substring(c, 1, 900)).alias("head")), lambda x: _is_concept(x["low"], x["head"]))  # made once, not for every word


def _is_concept(low: Column, head: Column) -> Column:
    any_of = lambda col, words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(col, w))
    question = low.endswith("?") & ~low.contains("how to") & ~low.contains("what is") & (F.length(low) > 40)
    solved = head.contains("## solution") & ~head.contains("objective") & ~head.contains("big idea")
    return (any_of(low, p.CONCEPT_TITLE) | any_of(head, p.CONCEPT_BODY)) & ~(question | head.contains("problem statement") | solved)


def valid_pair(problem: Column, solution: Column, kind: str) -> Column:
    """FLT12, FLT13."""
    enough = (F.length(problem) >= 30) & (F.length(solution) >= (80 if kind == "B" else 100))
    return enough & (t.has(solution, p.MATH_IN_SOLUTION) if kind == "A" else t.has(F.concat(problem, solution), p.MATH_CONTENT))
