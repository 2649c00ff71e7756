"""The cold start: pairs that need no model, boxed, gated and without near duplicates (CAS-6, FLT27 with L7, DD2, AGG6, SNK5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as p
from ..functions import text as t
from . import dedup, extract, gates
from .names import kept


def gated_pairs(docs: DataFrame, text: str = "text", label: str = "label", relaxed: bool = False) -> DataFrame:
    """Every document: its pair where it has one, ``boxed_injected`` and ``gate`` (``no_extraction``, the first failure of L1-L6, or null)."""
    return gated(extract.extract_pairs(docs, text, label, keep_skipped=True, cold_start=True), relaxed)


def gated(pairs: DataFrame, relaxed: bool = False) -> DataFrame:
    """The same of extracted pairs, nulls where a document has none."""
    pairs = gates.gated(pairs, relaxed)
    return pairs.withColumn("gate", F.when(F.col("strategy").isNull(), "no_extraction").otherwise(F.col("gate")))


def cold_start(docs: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "label", relaxed: bool = False) -> DataFrame:
    """Audit rows of the pairs that pass L1-L6 and, in the order of class and id (unique, not null), of no earlier kept pair's likeness (L7)."""
    pairs = gated_pairs(docs, text, label, relaxed).select(*dict.fromkeys((id_col, label, "strategy", "problem", "solution", "boxed_injected", "gate")))
    passed = dedup.durable(kept(pairs, "gate is null").drop("gate").withColumn("_o", F.struct(label, id_col)))  # extraction runs once, though keys and rows are both read; whole texts stay behind
    keyed = passed.select("_o", t.fingerprint120(F.col("problem")).alias("_k"), t.bigrams(F.col("problem")).alias("_s"))
    stays = passed.join(dedup.dedup_questions(keyed, "_o", "_k", "_s", 8000).select("_o"), "_o", "left_semi")
    size = F.struct(F.length("problem").alias("problem"), F.length("solution").alias("solution"))
    return stays.select(
        F.col(id_col).cast("string").alias("source_id"),
        F.col(label).alias("input_class"),
        F.col("strategy").alias("extraction_strategy"),
        "boxed_injected",
        size.alias("char_counts"),
        t.count(F.col("solution"), p.BOXED).alias("boxed_count"),
        t.chat(F.lit(""), F.col("problem"), F.col("solution")).alias("messages"),
    )


def rejects(pairs: DataFrame, id_col: str = "doc_id", label: str = "label") -> DataFrame:
    """The dry run's rows of documents without a pair or with a failed gate."""
    tail = F.substring(F.reverse(F.col("solution")), 1, 80)
    return kept(pairs, "gate is not null").select(
        F.col(id_col).cast("string").alias("id"),
        F.col(label).alias("input"),
        F.coalesce("strategy", F.lit("SKIP")).alias("strategy"),
        F.col("gate").alias("filter_reason"),
        F.left("problem", F.lit(80)).alias("problem_preview"),
        F.reverse(tail).alias("solution_tail"),
    )
