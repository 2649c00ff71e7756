"""Documents to training text in five stages: every stage reads all that the one before kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes each stage's rows as
Parquet in the shared folder and reads them again for the next. All but the last return the columns of ``documents``; the last returns
the encoding of every document that is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenmill.llm import chunk_bpe, decontaminate, secret_crf, simhash, storage, toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxic_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose noisy-or of sentence scores reaches a half go. Rows are judged each by its text; a null or empty text is one empty sentence,
    whose chance is the bias, and stays; with no labels, or of one kind alone, all rows stay."""
    storage.workers_find_package(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep(docs.select(*COLUMNS), model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, as :func:`simhash.keep_one` says: by the row's own text, so another row of its id decides nothing;
    a row without id stays where no copy has one; of repeats one; null and empty texts are copies of one another."""
    storage.workers_find_package(spark)
    return simhash.keep_one(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage by the contamination rule go. Rows are judged each by its text; texts without words, null ones too, stay;
    with an empty benchmark all rows stay."""
    storage.workers_find_package(spark)
    return decontaminate.keep_clean(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced in its text and n_chars follows the text; all rows stay, null texts as they are with their n_chars."""
    storage.workers_find_package(spark)
    field = secret_crf.fit(docs)
    return secret_crf.redact(docs.select(*COLUMNS), field).withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text, a row for every row; null and empty texts have no ids."""
    storage.workers_find_package(spark)
    return chunk_bpe.encode_documents(docs, digests_only=True)


STAGES = [("toxicity", toxic_filter), ("near_dedup", near_dedup), ("decontamination", decontamination), ("secrets", secret_redaction), ("bpe", encoding)]
ORACLE_SQL = None  # learned models, XXH64 bits and merges are beyond SQL; tests/llm/test_pipeline.py holds every stage and run() against plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = storage.workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = storage.staged(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return docs
