"""Wrong-answer removal, long routes, prompts, a model's labels, judge replies and planned rules, with SQL (TXT4-TXT6, TXT24-TXT28, TXT40, FLT3, FLT4, AGG3, LLM1, DES2, DES5, DES6, DES13, DES16, DES17)."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from ..functions import patterns as p
from ..functions import text as t
from ..operators import dedup, equivalence, gates, inference, quality, routes, sampling
from ..sources.shared import workers_find_package, workspace
from .dedup_queries import prompt_sql
from .extract_queries import SQL_PARTS, documents
from .fixture import in_batches, mathdocs
from .sql import M, flags, last_boxed, light, lit, n, normal, query, rx, strip
from .stage_sql import CMS, LABELLED, LATEX
from .text_queries import DOTS, leak

NL, NL2 = "chr(10)", "chr(10), chr(10)"
# sections with wrong answers: up to the next heading of the level, with a deeper one inside; to the end; none
SECTIONS = f"case doc_id % 3 when 0 then concat(words, {NL}, '## Common Mistakes', {NL}, s, {NL}, '### inner', {NL}, 'x', {NL}, '## Next', {NL}, p) when 1 then concat(words, {NL}, '### Wrong Answers', {NL}, s, {NL}, '#### deeper', {NL}, p) else concat(words, {NL}, '## Common sense', {NL}, p) end"
SECTIONS_LEFT = f"case doc_id % 3 when 0 then concat(words, {NL}, '## Next', {NL}, p) when 1 then concat(words, {NL}) else concat(words, {NL}, '## Common sense', {NL}, p) end"
LABELS = ("'**WRONG**: '", "'1. WRONG: '", "'- **WRONG** : '", "'*Incorrect*: '", "'**Wrong answer** : '", "'Wrong, but plain: '")
LABEL = "case doc_id % 6 " + " ".join(f"when {i} then {x}" for i, x in enumerate(LABELS)) + " end"
PARAGRAPHS = f"concat(words, {NL2}, {LABEL}, s, {NL2}, p)"
PARAGRAPHS_LEFT = f"case when doc_id % 6 = 5 then {PARAGRAPHS} else concat(words, {NL2}, p) end"


@query(f"with parts as ({SQL_PARTS}) select doc_id, {SECTIONS_LEFT} as sections, {PARAGRAPHS_LEFT} as paragraphs, concat({SECTIONS_LEFT}, case doc_id % 3 when 1 then '' else concat({NL2}, 'end') end) as both from parts")
def txt4_txt5_txt6_wrong_answers(spark, sf_dir):
    rows = documents(spark, sf_dir).selectExpr("doc_id", f"{SECTIONS} as a", f"{PARAGRAPHS} as b", f"concat({SECTIONS}, {NL2}, '**WRONG**: no', {NL2}, 'end') as c")
    wrong = dict(quality.CLEANING)["wrong"]
    return rows.select("doc_id", quality.delete_wrong_sections(F.col("a")).alias("sections"), quality.delete_wrong_paragraphs(F.col("b")).alias("paragraphs"), wrong(F.col("c")).alias("both"))


HIT = f"concat(text, case when doc_id % 9 = 0 then concat({NL2}, '**WRONG**: no way', {NL2}, 'the end') else '' end)"


@query(f"""{M.replace('with m as', 'with m0 as')}, m as (select doc_id, {HIT} as text from m0), t1 as (select doc_id, text as t0, {CMS} as text from m), t2 as (select doc_id, t0, text as t1, {rx('text', p.NAV_LINE)} as text from t1),
t3 as (select doc_id, t0, t1, text as t2, {rx('text', p.FORUM_META)} as text from t2), t4 as (select doc_id, t0, t1, t2, text as t3, replace(text, concat('**WRONG**: no way', {NL2}), '') as text from t3),
t5 as (select doc_id, t0, t1, t2, t3, text as t4, {LATEX} as text from t4), t6 as (select *, {rx('text', p.EXCESS_BLANK, chr(10) * 2)} as last from t5)
select count(*) filter (t0 <> t1) as cms, count(*) filter (t1 <> t2) as nav, count(*) filter (t2 <> t3) as forum, count(*) filter (t3 <> t4) as wrong, count(*) filter (t4 <> text) as latex, count(*) filter (text <> last) as blank from t6""")
def agg3_rule_hits(spark, sf_dir):
    out = quality.clean(mathdocs(spark, sf_dir).selectExpr("doc_id", f"{HIT} as text"))
    return out.agg(*(F.count_if(f"hit_{k}").alias(k) for k, _ in quality.CLEANING))


REPEATED = "case when doc_id % 4 = 0 then repeat(concat(text, ' $x$ we compute '), 40) else text end"


@query(f"""{M.replace('with m as', 'with m0 as')}, m as (select doc_id, {REPEATED} as text from m0), c as (select doc_id, length(text) as n, case when length(text) > 0 then {n('text', p.NOISE)} / (length(text) / 100.0) else 0 end as noise, case when length(text) > 0 then {n('text', p.MATH)} / (length(text) / 500.0) else 0 end as math from m),
d as (select doc_id, n, noise, math, case when n < 800 then 'too_short' when noise > 0.15 then 'noise_dense' when math < 0.5 then 'low_math' end as reason from c)
select doc_id, case when reason is not null then 'discard' when n > 50000 then 'long' else 'normal' end as label, case reason when 'too_short' then n when 'noise_dense' then round(noise, 3) when 'low_math' then round(math, 3) end as number from d""")
def flt3_flt4_long_route_and_numbers(spark, sf_dir):
    docs = mathdocs(spark, sf_dir).selectExpr("doc_id", f"{REPEATED} as text", "2.0D as score")
    out = quality.quality_cascade(docs)
    number = F.regexp_extract("reason", r"\(([0-9.]+)\)", 1).cast("double")
    return out.select("doc_id", "label", number.alias("number"))


@query(f"""{M} select doc_id, '<think>' || text || '</think>' || chr(10) || doc_id as wrapped, {prompt_sql("answer", question="cast(doc_id as varchar)", passage="text")} as prompt,
 {lit(routes.CLASSES)} || replace(replace(left(text, 600), '"', ''''), chr(92) || 'n', ' ') || '"' || chr(10) || 'Class:' as classes from m""")
def txt24_txt27_txt28_prompts(spark, sf_dir):
    c, d = F.col("text"), F.col("doc_id").cast("string")
    return mathdocs(spark, sf_dir).select("doc_id", t.with_reasoning(c, d).alias("wrapped"), routes.prompt("answer", routes.PROMPTS, question=d, passage=c).alias("prompt"), routes.class_prompt(c).alias("classes"))


LETTERS = "ABCDEFABCDEFABCD"


def letter_model():
    """Answers a class prompt with a letter by its MD5; one in sixteen replies names none, one in sixteen fails."""

    def reply(prompt, max_tokens, temperature):
        h = hashlib.md5(prompt.encode()).hexdigest()[0]
        if h == "f":
            raise TimeoutError("no reply")
        return "<think>B</think>so: " + ("?" if h == "e" else LETTERS[int(h, 16)].lower())

    return reply


CLASS_PROMPT = f"""{lit(routes.CLASSES)} || replace(replace(left(text, 600), '"', ''''), chr(92) || 'n', ' ') || '"' || chr(10) || 'Class:'"""


SAID = f"""{LABELLED}, w as (select r.doc_id, r.r, f.label as fallback, left(md5({CLASS_PROMPT}), 1) as h from r join f on f.doc_id = r.doc_id),
x as (select doc_id, r, fallback, case when h in ('e', 'f') then 'F' else substr('{LETTERS}', strpos('0123456789abcdef', h), 1) end as said from w)
select doc_id, coalesce(r, case when said = 'F' then fallback else said end) as label, case when r is null then 'model' else 'rule' end as label_source from x"""


@query(SAID)
def llm1_classify_with_a_model(spark, sf_dir):
    return quality.classify(mathdocs(spark, sf_dir), model=routes.classify_model(letter_model)).select("doc_id", "label", "label_source")


@query(SAID)
def llm1_llm11_classify_in_batches(spark, sf_dir):
    """The same labels from a model that takes many prompts in a call, several calls in flight."""
    return quality.classify(mathdocs(spark, sf_dir), model=routes.classify_model(in_batches(letter_model))).select("doc_id", "label", "label_source")


@query(f"{M}, w as (select doc_id, {CLASS_PROMPT} as q, left(md5({CLASS_PROMPT}), 1) as h from m) select doc_id, case when h <> 'f' then '<think>B</think>so: ' || case when h = 'e' then '?' else lower(substr('{LETTERS}', strpos('0123456789abcdef', h), 1)) end end as said, case when h = 'f' then 'no reply' end as error from w")
def llm2_written_through_replies(spark, sf_dir):
    """A first job asks for some documents, the next for all: what the first was told is read from its files."""
    rows, model = mathdocs(spark, sf_dir).select("doc_id", routes.class_prompt(F.col("text")).alias("q")), inference.WriteThrough(in_batches(letter_model), f"{workspace(spark, 'replies')}/log")
    inference.ask(rows.filter("doc_id % 3 = 0"), F.col("q"), "r", model, 4)
    return inference.ask(rows, F.col("q"), "r", model, 4).select("doc_id", F.col("r.text").alias("said"), F.col("r.error").alias("error"))


JUDGED = "concat('Groundedness = ', doc_id % 6, chr(10), 'reasoning=', doc_id % 5, ' format = ', 1 + doc_id % 5, chr(10), case when doc_id % 2 = 0 then 'keep = YES' else 'keep=no' end, chr(10), case when doc_id % 3 = 0 then concat('reason = because ', doc_id) else text end)"


def mark(k: str) -> str:
    return rf"coalesce(try_cast(regexp_extract(raw, '(?i){k}\s*=\s*([1-5])', 1) as int), 1)"


@query(rf"""{M}, j as (select doc_id, {light(JUDGED)} as raw from m), k as (select doc_id, {", ".join(f"{mark(x)} as {x}" for x in ("groundedness", "reasoning", "pedagogy", "format"))}, lower(regexp_extract(raw, '(?i)keep\s*=\s*(yes|no)', 1)) = 'yes' as keep,
 coalesce(nullif({strip("regexp_extract(raw, '(?i)reason" + chr(92) + "s*=" + chr(92) + "s*(.+)', 1)")}, ''), left(raw, 200)) as reason from j)
select doc_id, groundedness, reasoning, pedagogy, format, keep, reason, groundedness >= 3 and reasoning >= 3 and format >= 4 as good from k""")
def txt25_des13_judge_replies(spark, sf_dir):
    rows = mathdocs(spark, sf_dir).selectExpr("doc_id", f"{JUDGED} as said").select("doc_id", t.parse_judge(F.col("said")).alias("j"))
    return rows.select("doc_id", "j.*", gates.judged_good(F.col("j")).alias("good"))


@query(f"{M} select doc_id, {flags(('missing_boxed', 'not contains(text, chr(92) || ' + lit('boxed{') + ')'), ('prompt_leak', leak('text')), ('too_short', 'length(text) < 80'), ('thin_reasoning', 'not contains(text, chr(10)) and ' + DOTS.format('text') + ' < 2'))} as answer, length(text) < 220 as short_reasoning from m where {normal('text')} <> ''")
def des17_stricter_flags(spark, sf_dir):
    c = F.col("text")
    rows = mathdocs(spark, sf_dir).filter(t.normalise(c) != "")
    return rows.select("doc_id", F.array_join(gates.answer_flags(F.lit(""), c, 80, 2), ",").alias("answer"), F.array_contains(gates.reasoning_flags(c, 220), "reasoning_too_short").alias("short_reasoning"))


GIVEN = ("'1/2'", "concat('$', chr(92), 'frac{1}{4}$')", "'1,000'", "'x +  1'", "'3'", "words")
FOUND = ("'0.50'", "'0.25'", "'1000'", "'x+1'", "'4'", "words")


@query(f"with parts as ({SQL_PARTS}) select doc_id, doc_id % 6 <> 4 as same from parts")
def des2_same_answers(spark, sf_dir):
    turn = lambda xs: "case doc_id % 6 " + " ".join(f"when {i} then {x}" for i, x in enumerate(xs)) + " end"
    return documents(spark, sf_dir).selectExpr("doc_id", f"{turn(GIVEN)} as a", f"{turn(FOUND)} as b").select("doc_id", gates.same_answer(F.col("a"), F.col("b")).alias("same"))


ANSWER_N = "(doc_id % 50 + length(text) % 7 + 2)"
FORMS = (  # an answer, another way to write it, and what a check must say
    ("concat('(x+', {n}, ')(x-', {n}, ')')", "concat('x^2 - ', {n} * {n})", "same"),
    ("concat(chr(92), 'sqrt{', 4 * {n}, '}')", "concat('2', chr(92), 'sqrt{', {n}, '}')", "same"),
    ("concat(chr(92), 'frac{', 3 * {n}, '}{', 12, '}')", "concat({n}, '/4')", "same"),
    ("concat('y = ', {n}, 'x + 1')", "concat({n}, 'x + 1 = y')", "same"),
    ("concat('(a+', {n}, ')^2')", "concat('a^2+', {n} * {n})", "different"),
    ("concat({n}, chr(92), 'pi')", "concat({n}, '.5', chr(92), 'pi')", "different"),
    ("concat(chr(92), 'sqrt{', {n}, 'x}')", "concat(chr(92), 'sqrt{x}')", "undecided"),
    ("concat('about ', {n})", "concat('roughly ', {n})", "undecided"),
    ("text", "concat(text, ' indeed')", "undecided"),
    ("text", "text", "same"),
)


@query(f"select doc_id, case when text = '' and doc_id % 10 >= 8 then 'undecided' else case doc_id % 10 " + " ".join(f"when {k} then '{x[2]}'" for k, x in enumerate(FORMS)) + " end end as verdict from (select doc_id, coalesce(text, '') as text from documents)")
def des2_equivalent_answers(spark, sf_dir):
    turn = lambda at: "case doc_id % 10 " + " ".join(f"when {k} then {x[at].replace('{n}', ANSWER_N)}" for k, x in enumerate(FORMS)) + " end"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "coalesce(text, '') as text").selectExpr("doc_id", f"{turn(0)} as a", f"{turn(1)} as b")
    workers_find_package(spark)
    return rows.select("doc_id", equivalence.answer_verdict(F.col("a"), F.col("b")).alias("verdict"))


STEPS = f"list_filter(list_transform(string_split(text, chr(10)), lambda x: {strip('x')}), lambda x: x <> '')"
STEPPED = "concat(text, chr(10), 'second', chr(10), chr(10), ' third ', chr(10), text, chr(10), 'the end')"


@query(f"{M.replace('with m as', 'with m0 as')}, m as (select doc_id, {STEPPED} as text from m0), b as (select doc_id, text, cast(floor(length(text) / 3.5) as bigint) as n, {STEPS} as st from m) select doc_id, case when n < 150 then 'drop' when n > 900 then 'truncate' else 'keep' end as band, case when n > 900 and len(st) > 4 then array_to_string(list_concat(st[1:3], [st[-1]]), chr(10)) else text end as text from b")
def des5_token_bands(spark, sf_dir):
    rows = mathdocs(spark, sf_dir).selectExpr("doc_id", f"{STEPPED} as text")
    return rows.select("doc_id", gates.token_band(F.col("text")).alias("band"), gates.shortened(F.col("text")).alias("text"))


@query(f"""{M.replace('with ', 'with recursive ')}, w as materialized (select doc_id, unnest(string_split({normal('text')}, ' ')) as w from m where {normal('text')} <> ''), tf as materialized (select doc_id, w, count(*) as tf from w group by 1, 2),
df as materialized (select w, count(*) as df from tf group by w), x as (select doc_id, w, tf * (ln((1.0 + (select count(*) from m)) / (1 + df)) + 1) as x from tf join df using (w)),
u as materialized (select doc_id, w, x / sqrt(sum(x * x) over (partition by doc_id)) as x from x), o as materialized (select row_number() over (order by coalesce(l.quality, 1) desc, m.doc_id) as i, m.doc_id from m left join labels l on l.doc_id = m.doc_id),
p as (select a.doc_id as a, b.doc_id as b from u a join u b on a.w = b.w and a.doc_id <> b.doc_id group by 1, 2 having sum(a.x * b.x) > 0.85),
gn as materialized (select y.i, list(x.i) as js from p join o x on x.doc_id = p.a join o y on y.doc_id = p.b and x.i < y.i group by y.i), gz as materialized (select count(*) as z from o),
gr(i, kept) as (select cast(0 as bigint), cast([] as bigint[]) union all select gr.i + 1, case when gn.js is not null and list_has_any(gr.kept, gn.js) then gr.kept else list_append(gr.kept, gr.i + 1) end from gr left join gn on gn.i = gr.i + 1 where gr.i < (select z from gz))
select o.doc_id from o where o.i in (select unnest(kept) from gr where i = (select z from gz))""")
def des6_tfidf_dedup(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    norm = t.normalise(F.col("text"))
    words = t.let(norm, lambda x: F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(x, " ")))
    rows = mathdocs(spark, sf_dir).join(labels, "doc_id", "left").select("doc_id", F.struct((-F.coalesce("quality", F.lit(1))).alias("q"), F.col("doc_id").alias("d")).alias("place"), words.alias("words"))
    return dedup.dedup_tfidf(dedup.durable(rows, "tfidf"), "place", "words").select("doc_id")


def boxed(n: str) -> str:
    return f"chr(92), 'boxed{{', {n}, '}}'"


GOLD = f"case when doc_id % 5 = 0 then text else concat(text, {boxed('doc_id % 7')}) end"
SAMPLES = (  # right, right for two thirds, right only where the number is small; equal wrong answers agree with nothing
    f"concat(text, {boxed('doc_id % 7')})",
    f"concat('Again: ', text, {boxed('case when doc_id % 3 = 0 then 99 else doc_id % 7 end')})",
    f"concat(text, ' ', text, {boxed('1')}, {boxed('case when doc_id % 7 < 3 then doc_id % 7 else 99 end')})",
)


@query(f"{M}, s as (" + " union all ".join(f"select doc_id, {x} as a from m" for x in SAMPLES) + f"), g as (select doc_id, {last_boxed(GOLD)} as gold from m), b as (select s.doc_id, a, {last_boxed('a')} as boxed from s)"
       " select doc_id, answer, boxed from (select b.doc_id, a as answer, boxed, row_number() over (partition by b.doc_id order by length(a) desc, a desc) as r from b join g on g.doc_id = b.doc_id and g.gold = b.boxed where boxed <> '') where r = 1")  # fmt: skip
def des16_agreeing_samples(spark, sf_dir):
    """Three samples of every question against its gold row; the answers are whole texts with a box."""
    docs, out = mathdocs(spark, sf_dir), None
    for x in SAMPLES:
        one = docs.selectExpr("doc_id", f"{x} as answer")
        out = one if out is None else out.unionByName(one)
    return sampling.agreeing_samples(out, docs.selectExpr("doc_id", f"{GOLD} as answer"), "doc_id", "answer").select("doc_id", "answer", "boxed")
