"""The scalar functions as temporary SQL functions: ``register(spark)``, then ``select lm_light_clean(text) from ...``. Each is one SQL expression, so Catalyst inlines it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from . import text as t

INFIX = {"=", "<=>", "<", "<=", ">", ">=", "+", "-", "*", "/", "%", "and", "or", "&", "|", "^", "||"}


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def sql_of(node) -> str:
    """SQL of a column's node, every operator in brackets."""
    kind = node.getClass().getSimpleName()
    if kind == "UnresolvedFunction":
        name, args = node.functionName().lower(), _items(node.arguments())
        if name in INFIX and len(args) == 2:
            return f"({sql_of(args[0])} {name} {sql_of(args[1])})"
        if name in ("not", "!"):
            return f"(not {sql_of(args[0])})"
        if name in ("-", "negative", "~") and len(args) == 1:
            return f"({'~' if name == '~' else '-'}{sql_of(args[0])})"
        if name in ("isnull", "isnotnull"):
            return f"({sql_of(args[0])} is {'not ' if name == 'isnotnull' else ''}null)"
        if name == "in":
            return f"({sql_of(args[0])} in ({', '.join(map(sql_of, args[1:]))}))"
        named = lambda x: f"{sql_of(x)} as {x.name().apply(0)}" if x.getClass().getSimpleName() == "Alias" else sql_of(x)
        return f"{name}({', '.join(map(named, args))})"
    if kind == "CaseWhenOtherwise":
        when = "".join(f" when {sql_of(b._1())} then {sql_of(b._2())}" for b in _items(node.branches()))
        return f"(case{when}{' else ' + sql_of(node.otherwise().get()) if node.otherwise().isDefined() else ''} end)"
    if kind == "Alias":
        return sql_of(node.child())
    if kind == "Cast":
        tried = node.sql().upper().startswith("TRY")
        return f"{'try_cast' if tried else 'cast'}({sql_of(node.child())} as {node.dataType().sql()})"
    if kind == "LambdaFunction":
        names = [sql_of(x) for x in _items(node.arguments())]
        return f"{names[0] if len(names) == 1 else '(' + ', '.join(names) + ')'} -> {sql_of(node.function())}"
    if kind == "UnresolvedExtractValue":
        return f"{sql_of(node.child())}[{sql_of(node.extraction())}]"
    return node.sql()


def scalars() -> dict[str, tuple[str, str, Callable[..., Column]]]:
    """name: (parameters, result, function of columns)."""
    from ..operators import gates, quality, sampling

    out = {f.__name__: ("c STRING", "STRING", f) for f in (t.strip, t.compress_blank, t.light_clean, t.title, t.normalise, t.last_boxed, t.clean_question, t.problem_unit, t.concept_excerpt, t.rescue_boxed, t.clean_answer, t.clean_reasoning, t.fingerprint120, t.short_hash, quality.rule_label, quality.delete_wrong_sections, quality.delete_wrong_paragraphs, gates.inject_boxed, gates.token_band, gates.shortened, sampling.topic)}
    out |= {f.__name__: ("c STRING", "ARRAY<STRING>", f) for f in (t.tokens, t.bigrams, t.parse_questions, gates.reasoning_flags)}
    out |= {f.__name__: ("c STRING", "BOOLEAN", f) for f in (quality.is_calculator, quality.is_low_value, gates.question_rejected, sampling.token_length_kept)}
    out["is_clean_answer"] = ("c STRING", "BOOLEAN", gates.clean_answer)
    out |= {f.__name__: ("a STRING, b STRING", "ARRAY<STRING>", f) for f in (gates.answer_flags,)}
    out |= {f.__name__: ("a STRING, b STRING", "STRING", f) for f in (gates.gate_reason, t.explicit_question, t.with_reasoning)}
    out |= {f.__name__: ("a STRING, b STRING", "BOOLEAN", f) for f in (quality.is_concept, sampling.format_ok, gates.same_answer)}
    out["jaccard"] = ("a ARRAY<STRING>, b ARRAY<STRING>", "DOUBLE", t.jaccard)
    out["estimated_tokens"] = ("c STRING", "BIGINT", t.estimated_tokens)
    return out


def register(spark: SparkSession, prefix: str = "lm_") -> list[str]:
    """Creates all functions in the session; returns their names."""
    names = []
    for name, (params, result, f) in scalars().items():
        body = sql_of(f(*(F.col(x.split()[0]) for x in params.split(", ")))._jc.node())
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({params}) RETURNS {result} RETURN {body}")
        names.append(prefix + name)
    return names
