"""Generated question-answer rows: a chat model asked from tasks, routes A and B, their gates and merge (LLM2-LLM11, TVF6, FLT18-FLT20, TXT27, TXT34, TXT40, REL2, REL4, REL5, REL7).

Only the question to the model is Python (:mod:`inference`); what goes in and what is made of a reply are native expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from . import dedup, gates, inference, quality
from .inference import Model, WriteThrough
from .names import kept

# Instructions to the model, by task; a caller may pass others of the same keys.
PROMPTS = {
    "question": "Read the mathematical passage and write the one question that a student would ask and that the passage answers. Give the question alone, ended by a question mark.",
    "answer": "Answer the question from the passage alone, in two to four clear steps. Put the final answer on the last line as \\boxed{...}.",
    "box": "Repeat this solution and add its final answer as \\boxed{...} on a line of its own at the end. Give nothing else.",
    "reasoning": "Write out the full reasoning that leads from the question to its answer, in at least eight sentences, without the final answer, headings or tags.",
    "questions": "Write two different questions about this topic, one a line: one on the concept, one a simple application. Each must make sense alone. Give no answers.",
    "topic_answer": "Answer the question as a teacher would, with the definitions and formulas of the excerpt. Put the final answer on the last line as \\boxed{...}.",
}


def prompt(task: str, prompts: dict[str, str], **parts: Column) -> Column:
    """TXT27: the instruction and the named parts, a blank line between them."""
    return F.concat_ws("\n\n", F.lit(prompts[task]), *(F.concat(F.lit(f"{k.replace('_', ' ').capitalize()}:\n"), v) for k, v in parts.items()))


def ask(rows: DataFrame, question: Column, out: str, model: Model | WriteThrough, max_tokens: int = 240, temperature: float = 0.0, sample: Column | None = None) -> DataFrame:
    """LLM2: :func:`inference.ask`, without what a model thought aloud."""
    got = inference.ask(rows, question, out, model, max_tokens, temperature, sample=sample)
    return got.withColumn(out, F.struct(t.strip(t.without_thinking(F.col(out)["text"])).alias("text"), F.col(out)["error"].alias("error")))


def samples(rows: DataFrame, question: Column, model: Model | WriteThrough, draws: int = 3, temperature: float = 0.7, max_tokens: int = 600) -> DataFrame:
    """DES16's draws: a row for each of ``draws`` replies to a question, with its number ``sample`` and its text ``answer`` (null where the call failed or nothing was asked)."""
    drawn = rows.withColumn("sample", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))))
    got = ask(drawn, question, "answer", model, max_tokens, temperature, F.col("sample"))
    return got.withColumn("answer", F.col("answer.text"))


CLASSES = "Classes: A problem with solution, B forum thread, C lesson or concept, D textbook part, E calculator output, F other. Answer with one letter.\n\nText: \""


def class_prompt(c: Column, max_chars: int = 600) -> Column:
    """TXT28: the classes and the head of a text, without double quotes and two-character line marks."""
    head = F.replace(F.replace(F.substring(F.coalesce(c, F.lit("")), 1, max_chars), F.lit('"'), F.lit("'")), F.lit("\\n"), F.lit(" "))
    return F.concat(F.lit(CLASSES), head, F.lit('"\nClass:'))


def classify_model(model: Model, text: str = "text", max_chars: int = 600) -> Callable[[DataFrame], DataFrame]:
    """LLM1: a model for :func:`quality.classify`; the first letter A to F of a reply, else F."""

    def label(rows: DataFrame) -> DataFrame:
        got = ask(rows, class_prompt(F.col(text), max_chars), "_reply", model, 4)
        letter = F.regexp_extract(F.upper(F.coalesce("_reply.text", F.lit(""))), "[A-F]", 0)
        return got.withColumn("model_label", F.coalesce(t.nullif_empty(letter), F.lit("F"))).drop("_reply")

    return label


def _asked(rows: DataFrame, *question, **how) -> DataFrame:
    """:func:`ask`, written at once: the next question is made of what is in that table, so no step before it runs again and a task has one Python worker, not one for every question so far."""
    return dedup.durable(ask(rows, *question, **how), "asked")


def _answered(rows: DataFrame, task: str, model: Model, prompts: dict[str, str], **parts: Column) -> DataFrame:
    """LLM5-LLM7, LLM9: answer, box where it lacks one, flags, reasoning. Rows (question, source_unit) whose answer failed go."""
    q, unit = F.col("question"), F.col("source_unit")
    rows = _asked(rows, prompt(task, prompts, question=q, **parts), "_a", model, 600).filter("_a.error is null")
    rows = rows.withColumn("answer", t.clean_answer(F.col("_a.text"))).drop("_a")
    a, boxed = F.col("answer"), F.lit("\\boxed{")
    again = ~F.contains(a, boxed) & (F.length(a) > 60) & ~F.array_contains(gates.answer_flags(q, a), "question_copied")
    rows = _asked(rows, F.when(again, prompt("box", prompts, question=q, solution=a)), "_b", model, 700)
    rows = rows.withColumn("answer", F.when(F.contains("_b.text", boxed), t.clean_answer(F.col("_b.text"))).otherwise(a)).drop("_b")
    rows = rows.withColumn("_flags", gates.answer_flags(q, a))
    good = F.size("_flags") == 0
    rows = _asked(rows, F.when(good, prompt("reasoning", prompts, question=q, passage=unit)), "_t", model, 1500)
    rows = rows.withColumn("_think", F.when(good, t.clean_reasoning(F.col("_t.text"))))
    rows = rows.withColumn("_think_flags", F.when(good, gates.reasoning_flags(F.col("_think"))))
    sound = F.coalesce(F.size("_think_flags") == 0, F.lit(False))
    judge = F.struct(*(F.lit(0).alias(k) for k in ("groundedness", "reasoning", "pedagogy", "format")), good.alias("keep"), F.lit("rules alone").alias("reason"))
    verdict = F.struct((-2 * F.size("_flags")).alias("score"), (good & sound).alias("keep"), F.col("_flags").alias("rule_flags"), judge.alias("judge"))
    thought = F.when(good, F.struct(sound.alias("keep"), F.col("_think_flags").alias("flags"), F.length("_think").alias("think_length")))
    final = F.when(good & sound, t.with_reasoning(F.col("_think"), a)).otherwise(a)
    return rows.select("*", t.chat(F.lit(""), q, final).alias("messages"), verdict.alias("quality"), thought.alias("reasoning_quality"))


def _audit(rows: DataFrame, route: str) -> DataFrame:
    """TXT34: the same columns for both routes; a route's missing ones are null."""
    extra = [F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in ("title", "knowledge_point")]
    return rows.select(F.lit(route).alias("route"), "source_id", "source_unit", "messages", "quality", "reasoning_quality", *extra)


def units(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Route A before the model: source_id, title, source_unit (40 characters or more) and the explicit ``question``, '' where none is asked."""
    c = F.coalesce(F.col(text), F.lit(""))
    unit = F.coalesce(t.nullif_empty(t.problem_unit(c)), t.light_clean(F.substring(c, 1, 1400)))
    rows = kept(docs.select(F.col(id_col).cast("string").alias("source_id"), t.title(c).alias("title"), unit.alias("source_unit")), F.length("source_unit") >= 40)
    return rows.withColumn("question", t.explicit_question(F.col("source_unit"), F.col("title")))


def route_a(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text", prompts: dict[str, str] = PROMPTS) -> DataFrame:
    """LLM10: one row a document at most: its own question, or one that the model finds for its passage."""
    rows, q = units(docs, id_col, text), F.col("question")
    rows = _asked(rows, F.when(q == "", prompt("question", prompts, title=F.col("title"), passage=F.col("source_unit"))), "_q", model, 160, 0.1)
    found = t.clean_question(F.col("_q.text"), F.when(F.col("title").endswith("?"), F.col("title")).otherwise(""))
    rows = rows.filter("_q.error is null").withColumn("question", F.when(q == "", found).otherwise(q)).drop("_q")
    rows = rows.filter(~gates.question_rejected(q))
    return _audit(_answered(rows, "answer", model, prompts, passage=F.col("source_unit")), "A")


def excerpts(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Route B before the model: source_id, knowledge_point and an excerpt of 40 characters or more."""
    c = F.coalesce(F.col(text), F.lit(""))
    unit = F.coalesce(t.nullif_empty(t.concept_excerpt(c)), t.light_clean(F.substring(c, 1, 900)))
    point = F.coalesce(t.nullif_empty(t.title(c)), F.lit("mathematical concept"))
    return kept(docs.select(F.col(id_col).cast("string").alias("source_id"), point.alias("knowledge_point"), unit.alias("source_unit")), F.length("source_unit") >= 40)


def stock_questions(point: Column) -> Column:
    """LLM8 where the model gives no question."""
    return F.array(F.concat(F.lit("What is the key idea behind "), point, F.lit("?")), F.concat(F.lit("How would you explain "), point, F.lit(" with one short worked example?")))


def route_b(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text", prompts: dict[str, str] = PROMPTS) -> DataFrame:
    """TVF6: up to two questions about a document's topic, each a row ``<id>::<hash of the question>``."""
    rows, point = excerpts(docs, id_col, text), F.col("knowledge_point")
    rows = _asked(rows, prompt("questions", prompts, topic=point, excerpt=F.col("source_unit")), "_q", model, 180, 0.2)
    asked = t.parse_questions(F.col("_q.text"))
    rows = rows.withColumn("_asked", asked).withColumn("question", F.explode(F.when(F.size("_asked") > 0, F.col("_asked")).otherwise(stock_questions(point)))).drop("_q", "_asked")
    rows = rows.withColumn("source_id", F.concat("source_id", F.lit("::"), t.short_hash(F.col("question"))))
    return _audit(_answered(rows, "topic_answer", model, prompts, topic=point, excerpt=F.col("source_unit")), "B")


def routed(docs: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """REL4: ``route`` of labelled documents: B for concept documents of class C, A for the rest of A to D; others go."""
    c = F.coalesce(F.col(text), F.lit(""))
    concept = (F.col(label) == "C") & quality.is_concept(t.title(c), c)
    return docs.filter(F.col(label).isin("A", "B", "C", "D")).withColumn("route", F.when(concept, "B").otherwise("A"))


def merged(rows: DataFrame, threshold_bp: int = 8200) -> DataFrame:
    """Kept rows of both routes, near duplicates out (DD1). Of duplicates the one with the higher score stays, then the smaller source id, then the smaller route and question."""
    q, a = F.col("messages")[1]["content"], F.col("messages")[2]["content"]
    place = F.concat_ws("\x01", F.lpad((-F.col("quality.score")).cast("string"), 6, "0"), "source_id", "route", F.sha2(q, 256), F.sha2(a, 256))
    rows = gates.keep_rows(rows).withColumn("_o", place).dropDuplicates(["_o"])
    rows = dedup.durable(rows)  # a model is asked once: what follows reads what it said
    keyed = rows.select("_o", t.normalise(q).alias("_k"), t.tokens(F.concat_ws(" ", q, t.last_boxed(a))).alias("_s"))
    stays = dedup.dedup_questions(keyed, "_o", "_k", "_s", threshold_bp).select("_o")
    return rows.join(stays, "_o", "left_semi").drop("_o")
