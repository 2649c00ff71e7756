"""The mathified view: a projection of ``documents`` on which the text operators have something to do. One SQL text, the same rows in Spark and in the oracle."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from ..sources.layout import spread

MATHDOCS_SQL = """
select doc_id, lang, cast(doc_id % 8 as int) as k, case cast(doc_id % 8 as int)
 when 0 then concat('# Worksheet ', cast(doc_id as varchar(20)), chr(10), chr(10), '## Problem', chr(10), chr(10), 'Find x such that $x + ', cast(doc_id % 97 as varchar(20)), ' = ', cast(2 * (doc_id % 97) as varchar(20)), '$. ', split_part(t, chr(10), 1), chr(10), chr(10), '## Solution', chr(10), chr(10), t, chr(10), chr(10), 'Thus, the answer is $', cast(doc_id % 97 as varchar(20)), '$.')
 when 1 then concat('# Sheet ', cast(doc_id as varchar(20)), chr(10), chr(10), 'Compute the integral of x + ', cast(doc_id % 97 as varchar(20)), '. ', t, chr(10), chr(10), '## Answer', chr(10), chr(10), t, ' and 1 + 1 = 2')
 when 2 then concat('Posted by u', cast(doc_id as varchar(20)), chr(10), 'Joined: 2009', chr(10), t, chr(10), 'Reply #1', chr(10), 'Quote: see https://a.example/x ', t)
 when 3 then concat('1.1 Intro ', t, chr(10), '1.2 More', chr(10), 'Theorem 1.1 abc', chr(10), 'Definition 2 xyz')
 when 4 then concat('1 + 1 = 2', chr(10), '2 + 2 = 4', chr(10), '3 + 3 = 6', chr(10), '4 + 4 = 8', chr(10), '5 + 5 = 10', chr(10), '6 + 6 = 12', chr(10), '7 + 7 = 14', chr(10), '8 + 8 = 16', chr(10), t)
 when 5 then concat('# Ratio lesson ', cast(doc_id as varchar(20)), chr(10), chr(10), '## Example 1: find the ratio', chr(10), chr(10), t, ' $a/b$')
 when 6 then concat('Home > Docs', chr(10), 'Share This', chr(10), '[DEL: x :DEL][INS: kept :INS]', chr(10), t, chr(10), 'click here to subscribe', chr(10), chr(92), '(a+b', chr(92), ')')
 else t end as text
from (select doc_id, lang, coalesce(text, '') as t from documents)
"""


def mathdocs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(MATHDOCS_SQL.replace("from documents", "from {documents}"), documents=spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the score stand-in: 1 plus the quality label, 2 where there is none."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return mathdocs(spark, sf_dir).join(labels, "doc_id", "left").selectExpr("doc_id", "lang", "k", "text", "cast(1.0 + coalesce(quality, 1) as double) as score")


def scripted_model():
    """Stands in for a chat model in queries: replies follow from the MD5 of the prompt alone, some without a box, some failing (``reply_sql`` says the same)."""

    def reply(prompt: str, max_tokens: int, temperature: float) -> str:
        h = hashlib.md5(prompt.encode()).hexdigest()[:2]
        if h < "04":
            raise TimeoutError("no reply")
        if max_tokens == 180:
            return f"1. What does rule {h} say about sums?\n2) Compute the sum of {h} and 3."
        if max_tokens == 160:
            return f"Question: What is the value of x + {h} in this passage?"
        if max_tokens == 1500:
            return "We write the terms down.\nWe add them in order.\n" + f"Adding {h} keeps both sides equal. " * 6
        end = f"\\boxed{{{h}}}" if h >= "50" else f"so that x = {h}."
        return f"<think>hm</think>We write the terms of the sum down and add them.\nThe total follows, {end}"

    return reply


def in_batches(model):
    """The same model behind the interface that takes many prompts in a call; a prompt's failure is its own."""

    def factory():
        one = model()

        def reply_many(prompts, max_tokens, temperature):
            out = []
            for x in prompts:
                try:
                    out.append(one(x, max_tokens, temperature))
                except Exception as e:  # noqa: BLE001 - told for its prompt
                    out.append(e)
            return out

        one.reply_many = reply_many
        return one

    return factory


def reply_sql(prompt: str, max_tokens: int) -> str:
    """The scripted reply to a prompt in SQL; null where it fails."""
    h = f"left(md5({prompt}), 2)"
    if max_tokens == 180:
        text = f"'1. What does rule ' || {h} || ' say about sums?' || chr(10) || '2) Compute the sum of ' || {h} || ' and 3.'"
    elif max_tokens == 160:
        text = f"'Question: What is the value of x + ' || {h} || ' in this passage?'"
    elif max_tokens == 1500:
        text = f"'We write the terms down.' || chr(10) || 'We add them in order.' || chr(10) || repeat('Adding ' || {h} || ' keeps both sides equal. ', 6)"
    else:
        text = f"'<think>hm</think>We write the terms of the sum down and add them.' || chr(10) || 'The total follows, ' || case when {h} >= '50' then chr(92) || 'boxed{{' || {h} || '}}' else 'so that x = ' || {h} || '.' end"
    return f"case when {h} >= '04' then {text} end"
