"""Splitting, greedy dedup, the cold start and the two routes, with SQL (TVF1-TVF6, AGG7, DD1, DD2, CAS-6, TXT29, REL2-REL7, LLM2-LLM11, SNK5, DES18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import patterns as p
from ..functions import text as t
from ..operators import coldstart, dedup, extract, gates, routes, sampling, split
from .extract_queries import ALL_TURNS, SQL_PARTS, as_put_together, cold_docs, cold_rows, documents, turn_docs
from .fixture import in_batches, mathdocs, reply_sql, scripted_model
from .sql import M, any_of, has, last_boxed, light, lit, n, normal, query, question, rx, strip, title
from .text_queries import EXCERPTS, GATE, UNITS, answer_flags, reasoning, reasoning_flags, reply_ctes, two_questions

NL2 = "chr(10) || chr(10)"
CHUNKS = rf"""c0 as (select doc_id, list_filter(list_transform(string_split(regexp_replace(text, '(?m)^(#{{1,4}}\s+.)', chr(1) || '\1', 'g'), chr(1)), lambda x: {strip("x")}), lambda x: x <> '') as ls from m),
c1 as (select doc_id, unnest(string_split(piece, chr(2))) as piece, generate_subscripts(string_split(piece, chr(2)), 1) as k from (select doc_id, case when len(ls) > 0 then list_reduce(ls, lambda a, x: case when length(x) < 800 then a || {NL2} || x else a || chr(2) || x end) end as piece from c0) where piece is not null),
c2 as (select doc_id, k, case when length(piece) > 15000 then list_reduce(list_filter(regexp_split_to_array(piece, '\n{{2,}}'), lambda x: {strip("x")} <> ''), lambda a, x: case when length(split_part(a, chr(3), -1)) + length(x) + 2 <= 8000 then a || {NL2} || x else a || chr(3) || x end) else piece end as piece from c1),
c3 as (select doc_id, k, unnest(string_split(piece, chr(3))) as chunk, generate_subscripts(string_split(piece, chr(3)), 1) as j from c2),
c4 as (select doc_id, chunk, row_number() over (partition by doc_id order by k, j) - 1 as chunk_index, count(*) over (partition by doc_id) as chunk_total from c3),
chunks as (select * from c4 where length(chunk) >= 800 and {n("chunk", p.MATH)} / (length(chunk) / 500.0) >= 0.3)"""
# Long documents with headings and paragraphs of their own, so that merging and filling have work.
LONG = "concat(text, chr(10), '# Part two', chr(10), repeat(concat('We compute $x$ with care. ', left(text, 300), chr(10), chr(10)), cast(doc_id % 90 as int)), '## Part three', chr(10), 'short', chr(10), '### Part four', chr(10), text, ' $y = 1 + 1$ ', left(text, 700))"
LM = f"{M.replace('with m as', 'with m0 as')}, m as (select doc_id, {LONG} as text from m0)"


def long_docs(spark, sf_dir):
    return mathdocs(spark, sf_dir).selectExpr("doc_id", f"{LONG} as text")


@query(f"{LM}, {CHUNKS} select doc_id, printf('%d__chunk%03d', doc_id, chunk_index) as chunk_id, chunk_index, chunk_total, cast(length(chunk) as bigint) as chunk_chars, chunk as text from chunks")
def tvf1_to_tvf4_split_documents(spark, sf_dir):
    return split.split_documents(long_docs(spark, sf_dir)).select("doc_id", "chunk_id", F.col("chunk_index").cast("long").alias("chunk_index"), "chunk_total", "chunk_chars", "text")


@query(f"{M}, {CHUNKS} select doc_id, printf('%d__chunk%03d', doc_id, chunk_index) as chunk_id, chunk_index, chunk_total, cast(length(chunk) as bigint) as chunk_chars from chunks")
def tvf4_split_documents(spark, sf_dir):
    return split.split_documents(mathdocs(spark, sf_dir)).select("doc_id", "chunk_id", F.col("chunk_index").cast("long").alias("chunk_index"), "chunk_total", "chunk_chars")


@query(f"""{LM}, {CHUNKS}, l as (select list_sort(list(length(chunk))) as l, count(*) as n, sum(length(chunk)) as s from chunks)
select n as chunks, (select count(*) from m where doc_id not in (select doc_id from chunks)) as empty_docs, cast(s // n as bigint) as mean_chars, cast(l[n // 10 + 1] as bigint) as p10, cast(l[n // 2 + 1] as bigint) as p50, cast(l[cast(floor(n * 0.9) as bigint) + 1] as bigint) as p90 from l""")
def agg7_chunk_stats(spark, sf_dir):
    return split.chunk_stats(long_docs(spark, sf_dir))


def greedy_ctes(source: str, bp: int) -> str:
    """CTEs ending in ``gkept`` (o): what a sequential pass over ``source`` (o, k, s) keeps."""
    return f"""gi as materialized (select row_number() over (order by o) as i, o, k, s, len(s) as z from {source}),
gn as materialized (select y.i, list(x.i) as js from gi x join gi y on x.i < y.i and (x.k is not distinct from y.k or (x.z > 0 and y.z > 0 and 10000 * least(x.z, y.z) >= {bp} * greatest(x.z, y.z)
  and (10000 + {bp}) * len(list_intersect(x.s, y.s)) >= {bp} * (x.z + y.z))) group by y.i),
gz as materialized (select count(*) as z from gi),
gr(i, kept) as (select cast(0 as bigint), cast([] as bigint[]) union all select gr.i + 1, case when gn.js is not null and list_has_any(gr.kept, gn.js) then gr.kept else list_append(gr.kept, gr.i + 1) end
  from gr left join gn on gn.i = gr.i + 1 where gr.i < (select z from gz)),
gkept as (select gi.o from gi where gi.i in (select unnest(kept) from gr where i = (select count(*) from gi)))"""


def token_set(c: str) -> str:
    return f"list_filter(list_distinct(string_split({normal(c)}, ' ')), lambda x: x <> '')"


@query(f"{M.replace('with ', 'with recursive ')}, src as (select doc_id as o, {normal('text')} as k, {token_set('text')} as s from m), {greedy_ctes('src', 8200)} select o as doc_id from gkept")
def dd1_greedy_dedup(spark, sf_dir):
    docs = mathdocs(spark, sf_dir)
    keyed = docs.select("doc_id", t.normalise(F.col("text")).alias("k"), t.tokens(F.col("text")).alias("s"))
    return dedup.dedup_questions(keyed, "doc_id", "k", "s", 8200).select("doc_id")


def pair_words(c: str) -> str:
    low = rf"regexp_replace({strip(f'lower({c})')}, '[\s\x1c-\x1f\x{{85}}\x{{a0}}]+', ' ', 'g')"
    return f"list_transform([string_split({low}, ' ')], lambda w: case when len(w) >= 2 then list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) else list_filter(w, lambda x: x <> '') end)[1]"


def first120(c: str) -> str:
    return rf"left(regexp_replace({strip(f'lower({c})')}, '[\s\x1c-\x1f\x{{85}}\x{{a0}}]+', ' ', 'g'), 120)"


@query(f"{ALL_TURNS.replace('with ', 'with recursive ')}, src as (select label || doc_id as o, {first120('problem')} as k, {pair_words('problem')} as s from t where ok), {greedy_ctes('src', 8000)} select o from gkept")
def dd2_shingle_dedup(spark, sf_dir):
    pairs = extract.extract_pairs(turn_docs(spark, sf_dir)).withColumn("o", F.concat("label", F.col("doc_id").cast("string")))
    keyed = pairs.select("o", t.fingerprint120(F.col("problem")).alias("k"), t.bigrams(F.col("problem")).alias("s"))
    return dedup.dedup_questions(keyed, "o", "k", "s", 8000).select("o")


# TXT29: ends that each of the five priorities, or none, finds an answer in.
ENDS = ("", " Thus, the answer is $7$.", " hence $y = 5$", " $$ = \\ln 3 $$", " Answer: 42", " as a result of $x$ and then we get $z$ in all of it", " so it is $$ and $q$ here", " done with $a$ and $b$", " \\boxed{1}")
CLOSED = "concat(s, case doc_id % 9 " + " ".join(f"when {i} then {lit(x)}" for i, x in enumerate(ENDS)) + " end)"


def injected_ctes(source: str, given: str, name: str) -> str:
    """CTEs ending in ``name``: columns of ``source`` and ``boxed`` (null: nothing injected)."""
    ok = lambda a, most=100: f"list_filter([{strip(a)}], lambda x: length(x) between 1 and {most} and not regexp_matches(x, '^[+,.;=*/]') and not contains(x, chr(10)) and not regexp_matches(x, {lit('(?i)^(?:' + p.BOXED_NOISE.body + ')$')}))[1]"
    last = lambda q: f"regexp_extract_all(tail, {lit(q.re2)}, 1)[-1]"
    display = rf"regexp_replace({strip(f'nullif(regexp_extract({given}, {lit(p.DISPLAY_FINAL.re2)}, 1), {chr(39) * 2})')}, '^=\s*', '')"
    inline = f"case when {has('context', p.CONCLUSION_WORD)} then inner_ end"
    return f"""{name}0 as (select *, right({given}, 600) as tail from {source}),
{name}1 as (select *, {last(p.INLINE)} as inner_, length(regexp_split_to_array(tail, {lit(p.INLINE.re2)})[-1]) as after from {name}0),
{name}2 as (select *, right(left(tail, length(tail) - after - length(inner_) - 2), 80) as context from {name}1),
{name}3 as (select *, coalesce({ok(last(p.CONCLUSION_INLINE))}, {ok(last(p.EQUATION_INLINE))}, {ok(display)}, {ok(last(p.ANSWER_LABEL))}, {ok(inline, 60)}) as answer_ from {name}2),
{name} as (select * exclude (tail, inner_, after, context, answer_), case when not {has(given, p.BOXED)} and answer_ is not null then regexp_replace({given}, '[\\s\\x1c-\\x1f]+$', '') || {NL2} || chr(92) || 'boxed{{' || answer_ || '}}' end as boxed from {name}3)"""


@query(f"with parts as ({SQL_PARTS}), e as (select doc_id, {CLOSED} as solution from parts), {injected_ctes('e', 'solution', 'i')} select doc_id, boxed from i")
def txt29_boxed_injection(spark, sf_dir):
    return documents(spark, sf_dir).selectExpr("doc_id", f"{CLOSED.replace(chr(92), chr(92) * 2)} as solution").select("doc_id", gates.inject_boxed(F.col("solution")).alias("boxed"))


COLD_PAIRS = f"with recursive parts as ({SQL_PARTS}), cold as (" + " union all ".join(cold_rows(x) for x in "ABCD") + "), clean as (select doc_id, label, strategy, problem, solution from cold), "
COLD_GATED = f"""{injected_ctes('clean', 'solution', 'i')}, pairs as (select doc_id, label, strategy, problem, boxed is not null as boxed_injected, coalesce(boxed, solution) as solution from i), {GATE}"""


@query(f"""{COLD_PAIRS}{COLD_GATED}, src as (select label || lpad(cast(doc_id as varchar), 12, '0') as o, {first120('problem')} as k, {pair_words('problem')} as s from g where gate is null), {greedy_ctes('src', 8000)}
select cast(doc_id as varchar) as source_id, label as input_class, strategy as extraction_strategy, boxed_injected, {n('solution', p.BOXED)} as boxed_count, problem, solution from g where gate is null and label || lpad(cast(doc_id as varchar), 12, '0') in (select o from gkept)""")
def cas6_dd2_cold_start(spark, sf_dir):
    out = coldstart.cold_start(cold_docs(spark, sf_dir), relaxed=True)
    return out.select("source_id", "input_class", "extraction_strategy", "boxed_injected", "boxed_count", F.col("messages")[1]["content"].alias("problem"), F.col("messages")[2]["content"].alias("solution"))


@query(f"""{COLD_PAIRS}{COLD_GATED}, none as (select parts.doc_id, l.label from parts, (values ('A'), ('B'), ('C'), ('D')) l(label) where not exists (select 1 from cold c where c.doc_id = parts.doc_id and c.label = l.label))
select cast(doc_id as varchar) as id, label as input, strategy, gate as filter_reason, left(problem, 80) as problem_preview, right(solution, 80) as solution_tail from g where gate is not null
union all select cast(doc_id as varchar), label, 'SKIP', 'no_extraction', null, null from none""")
def snk5_txt36_cold_start_rejects(spark, sf_dir):
    pairs = as_put_together(extract.extract_pairs(cold_docs(spark, sf_dir), keep_skipped=True, cold_start=True))
    return coldstart.rejects(coldstart.gated(pairs, relaxed=True))


def prompt_sql(task: str, **parts: str) -> str:
    return f"concat_ws({NL2}, {lit(routes.PROMPTS[task])}" + "".join(f", {lit(k.replace('_', ' ').capitalize() + ':' + chr(10))} || {v}" for k, v in parts.items()) + ")"


def trimmed(c: str) -> str:
    return strip(f"replace(replace({rx(c, p.THINK)}, '⚇', ''), '⚼', '')")


def answered_ctes(source: str, task: str, name: str, route: str, extra: dict[str, str]) -> str:
    """CTEs ending in ``name``: of rows (question, source_unit, ...) what the chain of model calls makes of them."""
    box = "contains({0}, chr(92) || 'boxed{{')"
    first = reply_sql(prompt_sql(task, question="question", **extra), 600)
    again = f"not {box.format('answer')} and length(answer) > 60 and not contains(f0, 'question_copied')"
    return f"""{name}_a as (select *, {trimmed(first)} as said from {source}), {reply_ctes(f"(select * from {name}_a where said is not null)", "said", f"{name}_b")},
{name}_c as (select * exclude (said), {answer_flags("question", "answer")} as f0 from {name}_b), {name}_d as (select *, case when {again} then {trimmed(reply_sql(prompt_sql("box", question="question", solution="answer"), 700))} end as more from {name}_c),
{reply_ctes(f"(select * exclude (answer), answer as given from {name}_d)", "more", f"{name}_e")},
{name}_f as (select * exclude (answer, given, more, f0), case when {box.format("more")} then answer else given end as answer from {name}_e), {name}_g as (select *, {answer_flags("question", "answer")} as flags from {name}_f),
{name}_h as (select *, case when flags = '' then {trimmed(reply_sql(prompt_sql("reasoning", question="question", passage="source_unit"), 1500))} end as thought from {name}_g), {name}_i as (select *, case when flags = '' then {reasoning("thought")} end as think from {name}_h),
{name}_j as (select *, flags = '' and coalesce({reasoning_flags("think")} = '' and think is not null, false) as keep from {name}_i),
{name} as (select '{route}' as route, source_id, question, case when keep then '<think>' || think || '</think>' || chr(10) || answer else answer end as answer, keep, flags from {name}_j)"""


CONCEPT = f"""({any_of('lower(' + title('text') + ')', p.CONCEPT_TITLE)} or {any_of("lower(left(text, 900))", p.CONCEPT_BODY)}) and not ((ends_with(lower({title("text")}), '?') and not contains(lower({title("text")}), 'how to') and not contains(lower({title("text")}), 'what is') and length({title("text")}) > 40)
 or contains(lower(left(text, 900)), 'problem statement') or (contains(lower(left(text, 900)), '## solution') and not contains(lower(left(text, 900)), 'objective') and not contains(lower(left(text, 900)), 'big idea')))"""


def generated_ctes(labelled: str) -> str:
    """CTEs ending in ``generated``, of ``labelled`` (doc_id, text, label)."""
    a_docs, b_docs = UNITS.replace(" from m)", " from m_a)"), EXCERPTS.replace(" from m)", " from m_b)")
    asked = reply_sql(prompt_sql("question", title="title", passage="source_unit"), 160)
    fallback = "case when ends_with(title, '?') then title else '' end"
    point, excerpt = "knowledge_point", "source_unit"
    listed = reply_sql(prompt_sql("questions", topic=point, excerpt=excerpt), 180)
    stock = f"['What is the key idea behind ' || {point} || '?', 'How would you explain ' || {point} || ' with one short worked example?']"
    return f"""routed as (select doc_id, text, label = 'C' and {CONCEPT} as concept from {labelled} where label in ('A', 'B', 'C', 'D')), m_a as (select doc_id, text from routed where not concept), m_b as (select doc_id, text from routed where concept), {a_docs},
a1 as (select cast(doc_id as varchar) as source_id, title, source_unit, question as own, case when question = '' then {trimmed(asked)} end as said from units),
a2 as (select source_id, title, source_unit, own, {light("said")} as raw from a1 where own <> '' or said is not null),
a3 as (select source_id, source_unit, case when own = '' then {question("raw", fallback)} else own end as question from a2),
a4 as (select * from a3 where not (contains(question, chr(92) || 'boxed{{') or {has("question", p.QUESTION_WITH_ANSWER)})), {answered_ctes("a4", "answer", "ra", "A", {"passage": "source_unit"})}, {b_docs},
b1 as (select cast(doc_id as varchar) as id, {point}, {excerpt}, {trimmed(listed)} as text from excerpts), {two_questions("b1", f"id, {point}, {excerpt}")},
b2 as (select id, {point}, {excerpt}, unnest(case when len(questions) > 0 then questions else {stock} end) as question from asked2),
b3 as (select id || '::' || left(sha256(question), 8) as source_id, {point}, {excerpt}, question from b2), {answered_ctes("b3", "topic_answer", "rb", "B", {"topic": point, "excerpt": excerpt})},
generated as (select * from ra union all select * from rb)"""


# Documents of class C that are concept lessons, and the others in turn.
LESSON = "case when doc_id % 8 = 5 then concat('# Understanding ratio ', doc_id, chr(10), chr(10), 'Definition: a ratio compares $a$ and $b$. ', text) else text end"
LABELLED = f"labelled as (select doc_id, {LESSON} as text, case when doc_id % 8 = 5 then 'C' when doc_id % 8 = 4 then 'E' when doc_id % 8 = 2 then 'B' else 'A' end as label from m)"


def labelled(spark, sf_dir):
    return mathdocs(spark, sf_dir).selectExpr("doc_id", f"{LESSON} as text", "case when doc_id % 8 = 5 then 'C' when doc_id % 8 = 4 then 'E' when doc_id % 8 = 2 then 'B' else 'A' end as label")


def generated(spark, sf_dir, model=scripted_model):
    docs = routes.routed(labelled(spark, sf_dir))
    return routes.route_a(docs.filter("route = 'A'"), model).unionByName(routes.route_b(docs.filter("route = 'B'"), model))


@query(f"{M}, {LABELLED}, {generated_ctes('labelled')} select route, source_id, question, answer, keep, flags from generated")
def llm10_tvf6_routes(spark, sf_dir):
    return told(generated(spark, sf_dir))


@query(f"{M}, {LABELLED}, {generated_ctes('labelled')} select route, source_id, question, answer, keep, flags from generated")
def llm10_llm11_routes_in_batches(spark, sf_dir):
    """The same rows from a model that takes many prompts in a call."""
    return told(generated(spark, sf_dir, in_batches(scripted_model)))


def told(rows):
    q, a = F.col("messages")[1]["content"], F.col("messages")[2]["content"]
    return rows.select("route", "source_id", q.alias("question"), a.alias("answer"), F.col("quality.keep").alias("keep"), F.array_join("quality.rule_flags", ",").alias("flags"))


@query(f"{M}, {LABELLED} select label, label = 'C' and {CONCEPT} as concept, count(*) as n from labelled where label in ('A', 'B', 'C', 'D') group by 1, 2")
def rel4_rel5_routing(spark, sf_dir):
    docs = routes.routed(labelled(spark, sf_dir))
    return docs.groupBy("label", (F.col("route") == "B").alias("concept")).agg(F.count("*").alias("n"))


@query(f"""{M.replace('with ', 'with recursive ')}, {LABELLED}, {generated_ctes('labelled')}, good as (select distinct * from generated where keep),
src as (select '000000' || chr(1) || source_id || chr(1) || route || chr(1) || sha256(question) || chr(1) || sha256(answer) as o, {normal("question")} as k, {token_set("question || ' ' || " + last_boxed("answer"))} as s, route, source_id from good),
{greedy_ctes('src', 8200)} select route, source_id from src where o in (select o from gkept)""")
def rel2_rel7_flt18_merge_routes(spark, sf_dir):
    return routes.merged(generated(spark, sf_dir)).select("route", "source_id")


FORMAT_OK = r"length(problem) between 30 and 1000 and length(solution) between 100 and 3000 and regexp_matches(problem || solution, '[$\\=0-9]') and (regexp_matches(lower(solution), '=\s*-?[0-9]') or contains(lower(solution), chr(92) || 'boxed') or regexp_matches(lower(solution), 'answer is|therefore')) and not regexp_matches(rtrim(lower(solution)), '(\.\.\.|\band|,)$') and (contains(problem, '?') or regexp_matches(lower(problem), 'find|prove|solve|compute'))"


@query(f"{ALL_TURNS} select doc_id, label, {FORMAT_OK} as format_ok from t where ok")
def des1_format_check(spark, sf_dir):
    pairs = extract.extract_pairs(turn_docs(spark, sf_dir))
    return pairs.select("doc_id", "label", sampling.format_ok(F.col("problem"), F.col("solution")).alias("format_ok"))


@query(f"""{M}, {LABELLED}, {generated_ctes('labelled')} select route, count(*) as n_rows, count(*) filter (keep) as kept, count(*) filter (contains(answer, '<think>')) as thinking, count(*) filter (contains(answer, chr(92) || 'boxed{{')) as boxed,
 count(*) filter ({any_of("lower(question || answer)", p.LEAK_WORDS)}) as leaks, count(*) filter (regexp_matches(question, '^[a-z]|^Example')) as bad_start, cast(0 as bigint) as system_texts,
 count(*) filter ({FORMAT_OK.replace("problem", "question").replace("solution", "answer")}) as format_ok, sum(cast(floor(length(answer) / 3.5) as bigint)) as tokens, avg(cast(length(answer) as double)) as mean_chars, max(length(answer)) as longest from generated group by route""")
def des18_acceptance(spark, sf_dir):
    return sampling.acceptance(generated(spark, sf_dir))
