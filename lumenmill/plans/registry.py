"""Named queries over the driver tables, with the SQL that states the same result."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import patterns as p
from ..functions import text as t
from ..functions.counts import counts
from ..operators import coldstart, dedup, extract, gates, quality, routes, sampling, split
from . import dedup_queries, extract_queries, file_queries, more_queries, text_queries  # noqa: F401 - register their queries
from .fixture import mathdocs, scored, scripted_model
from .stage_sql import CALC, CASCADE, CLEAN, CMS, FORUM, LABELLED, LATEX, RULE  # noqa: F401
from .sql import ORACLE_SQL, QUERIES, M, has, lit, n, query, rx, strip  # noqa: F401

def cascade(spark, sf_dir):
    return quality.quality_cascade(scored(spark, sf_dir)).select("doc_id", "label", quality.reason_kind(F.col("reason")).alias("reason"))


@query(f"{CASCADE} select doc_id, label, reason from d")
def flt3_quality_cascade(spark, sf_dir):
    return cascade(spark, sf_dir)


@query(f"{CASCADE} select label, count(*) as n from d group by label")
def agg1_label_counts(spark, sf_dir):
    return cascade(spark, sf_dir).groupBy("label").agg(F.count("*").alias("n"))


@query(f"{CASCADE} select reason, count(*) as n from d where reason is not null group by reason")
def agg2_reason_histogram(spark, sf_dir):
    return cascade(spark, sf_dir).filter("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))


@query(f"{M} select doc_id, {n('text', p.NOISE)} as noise, {n('text', p.MATH)} as math from m")
def flt1_flt2_density_counts(spark, sf_dir):
    return mathdocs(spark, sf_dir).select("doc_id", counts(F.col("text"), noise=p.NOISE, math=p.MATH).alias("n")).select("doc_id", "n.noise", "n.math")


def rule(name):
    return dict(quality.CLEANING)[name](F.col("text"))


@query(f"{M} select doc_id, {CMS} as text from m")
def txt2_cms_markers(spark, sf_dir):
    return mathdocs(spark, sf_dir).select("doc_id", rule("cms").alias("text"))


@query(f"{M} select doc_id, {rx('text', p.NAV_LINE)} as text from m")
def txt1_nav_lines(spark, sf_dir):
    return mathdocs(spark, sf_dir).select("doc_id", rule("nav").alias("text"))


@query(f"{M} select doc_id, {rx('text', p.FORUM_META)} as text from m")
def txt3_forum_meta(spark, sf_dir):
    return mathdocs(spark, sf_dir).select("doc_id", rule("forum").alias("text"))


@query(f"{M} select doc_id, {LATEX} as text from m")
def txt7_latex_delimiters(spark, sf_dir):
    return mathdocs(spark, sf_dir).select("doc_id", rule("latex").alias("text"))


@query(f"{CLEAN} select doc_id, {strip('text')} as text, length({strip('text')}) >= 600 as kept from t5")
def txt9_clean(spark, sf_dir):
    return quality.clean(mathdocs(spark, sf_dir)).select("doc_id", "text", F.col("reason").isNull().alias("kept"))


@query(f"{M} select doc_id, {RULE} as label from m")
def flt10_rule_label(spark, sf_dir):
    return mathdocs(spark, sf_dir).select("doc_id", quality.rule_label(F.col("text")).alias("label"))


@query(f"{LABELLED} select doc_id, label, label_source from f")
def flt11_classify(spark, sf_dir):
    return quality.classify(mathdocs(spark, sf_dir)).select("doc_id", "label", "label_source")


@query(f"{LABELLED} select label, count(*) filter (label_source = 'rule') as by_rule, count(*) filter (label_source = 'model') as by_model from f group by label")
def agg4_label_source(spark, sf_dir):
    out = quality.classify(mathdocs(spark, sf_dir))
    return out.groupBy("label").agg(F.count_if(F.col("label_source") == "rule").alias("by_rule"), F.count_if(F.col("label_source") == "model").alias("by_model"))


@query(f"""{M} select doc_id, ({has('text', p.DIVISOR_PAGE)} or ({has('text', p.ISBN)} and length(text) < 4000) or ({has('text', p.CONTENTS_PAGE)} and not {has('text', p.WORKED)}) or ({has('text', p.UPLOADED)} and length(text) < 3000)) as low_value from m""")
def flt14_low_value(spark, sf_dir):
    return mathdocs(spark, sf_dir).select("doc_id", quality.is_low_value(F.col("text")).alias("low_value"))


@query("""with s as (select doc_id, text, unnest(range(0, greatest(length(text), 1), 1300)) as pos from documents where text is not null)
select doc_id, pos as chunk_start, substring(text, pos + 1, 1500) as chunk from s where length(substring(text, pos + 1, 1500)) > 0""")
def des11_overlapping_chunks(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return split.overlapping_chunks(docs).select("doc_id", "chunk_start", "chunk")


@query("select min(doc_id) as doc_id, text from documents where text is not null group by text")
def dd3_first_of_key(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").filter("text is not null")
    return dedup.first_of_key(docs, "text", "doc_id")


@query(f"{LABELLED} select f.doc_id from f where f.label <> 'A' and not exists (select 1 from labels l where l.doc_id = f.doc_id)")
def rel6_resume_anti_join(spark, sf_dir):
    done = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id")
    return quality.classify(mathdocs(spark, sf_dir)).filter("label <> 'A'").join(done, "doc_id", "left_anti").select("doc_id")


@query("select doc_id, left(sha256(text), 8) as h, printf('%d__chunk%03d', doc_id, doc_id % 7) as chunk_id, cast(floor(length(text) / 3.5) as bigint) as tokens from documents where text is not null")
def txt30_txt31_txt32_ids(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("text is not null")
    return docs.select("doc_id", t.short_hash(F.col("text")).alias("h"), t.chunk_id(F.col("doc_id"), F.col("doc_id") % 7).alias("chunk_id"), t.estimated_tokens(F.col("text")).alias("tokens"))


CLEANED = f"""{CLEAN}, k as (select doc_id, {strip("text")} as text from t5 where length({strip("text")}) >= 600), r as (select doc_id, text, {RULE} as r from k),
f as (select doc_id, text, coalesce(r, case when {has('substring(text, 1, 800)', p.WORD_PROBLEM)} and length(text) < 5000 then 'A' when {has('text', p.DEFINITION)} then 'C' else 'F' end) as label from r)"""
#: In the view only the worksheets of classes 0 and 1 hold pairs: both headings, or a lone answer under the first heading.
PAIRS = f"""{CLEANED}, x as (select doc_id, label, 'S1' as strategy, {strip("split_part(split_part(text, '## Problem', 2), '## Solution', 1)")} as problem, {strip("split_part(text, '## Solution', 2)")} as solution from f where doc_id % 8 = 0
 union all select doc_id, label, 'S1b', {strip("split_part(substring(text, strpos(text, chr(10))), '## Answer', 1)")}, {strip("split_part(text, '## Answer', 2)")} from f where doc_id % 8 = 1)"""


@query(f"{PAIRS} select * from x where label = 'A' and length(problem) >= 30 and length(solution) >= 100 and {has('solution', p.MATH_IN_SOLUTION)}")
def cas_a_to_d_extraction(spark, sf_dir):
    docs = quality.classify(quality.clean(mathdocs(spark, sf_dir)).filter("reason is null").drop("reason"))
    return extract.extract_pairs(docs).select("doc_id", "label", "strategy", "problem", "solution")


@query("select doc_id, left(md5(cast(doc_id as varchar)), 4) < '4ccd' as sampled, left(md5(cast(doc_id as varchar)), 4) < '0ccd' as thinking from documents")
def des3_des9_hash_shares(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", sampling.in_share(F.col("doc_id"), 0.3).alias("sampled"), sampling.in_share(F.col("doc_id"), 0.05).alias("thinking"))


@query("""with d as (select d.doc_id, d.source, coalesce(l.quality, 1) = 0 as bad from documents d left join labels l on d.doc_id = l.doc_id)
select doc_id, source, coalesce(bool_or(bad) over (partition by source), false) as penalised from d""")
def des4_source_penalty(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source").join(labels, "doc_id", "left")
    return sampling.source_penalty(docs, "source", F.col("quality") == 0).select("doc_id", "source", "penalised")


@query("select min(doc_id) as doc_id from documents group by md5(lower(coalesce(text, '')))")
def des7_first_of_lower(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return sampling.first_of_lower(docs, "text", "doc_id").select("doc_id")


TOPIC = "case " + " ".join(f"when regexp_matches(lower(text), '{words}') then '{name}'" for name, _, words in sampling.TOPICS) + " else 'other' end"
SHARE = "case topic " + " ".join(f"when '{name}' then {share}" for name, share, *_ in (*sampling.TOPICS, sampling.OTHER)) + " end"


@query(f"""{M}, k as (select doc_id, {TOPIC} as topic from m), r as (select doc_id, topic, row_number() over (partition by topic order by md5(cast(doc_id as varchar)), doc_id) as r from k)
select doc_id, topic from r where r <= {SHARE}""")
def des8_topic_quota(spark, sf_dir):
    docs = mathdocs(spark, sf_dir).select("doc_id", sampling.topic(F.col("text")).alias("topic"))
    return sampling.topic_quota(docs, "topic", "doc_id", 100)


@query(f"{M} select doc_id, cast(floor(length(text) / 3.5) as bigint) between 200 and 9012 as kept from m")
def des15_token_length(spark, sf_dir):
    return mathdocs(spark, sf_dir).select("doc_id", sampling.token_length_kept(F.col("text")).alias("kept"))


QA_PARTS = f"string_split(regexp_replace(text, {lit(f'(?{p.PROB_HEADER.flags})({p.PROB_HEADER.body})')}, chr(2) || '\\1', 'g'), chr(2))"


@query(f"""{M}, s as (select doc_id, concat(text, chr(10), text) as text from m), q as (select doc_id, text, {QA_PARTS} as parts from s),
u as (select doc_id, unnest(case when len(parts) > 2 then parts[2:] else [text] end) as text, unnest(range(0, case when len(parts) > 2 then len(parts) - 1 else 1 end)) as qa_index from q)
select doc_id, qa_index, text from u where qa_index < 2""")
def des10_des12_question_splits(spark, sf_dir):
    twice = mathdocs(spark, sf_dir).select("doc_id", F.concat("text", F.lit("\n"), "text").alias("text"))
    return split.first_pairs(split.split_questions(twice), "doc_id", "qa_index").select("doc_id", "qa_index", "text")
