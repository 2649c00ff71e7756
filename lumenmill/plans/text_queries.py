"""Text functions and gates over the mathified view (TXT10-TXT40, FLT15-FLT28, LLM9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import patterns as p
from ..functions import text as t
from ..operators import dedup, gates, quality, routes
from .fixture import mathdocs
from .sql import M, any_of, compress, flags, has, last_boxed, light, lit, n, normal, query, question, rx, strip, title
from .sql import lines as lines_sql

BOX = chr(92) + "boxed{"


@query(f"""{M} select doc_id, {light("text")} as light, {title("text")} as title, {normal("text")} as normal, {last_boxed("text || ' ' || chr(92) || 'boxed{' || doc_id || '}'")} as boxed from m""")
def txt13_txt14_txt15_txt16_forms(spark, sf_dir):
    boxed = F.concat(F.col("text"), F.lit(" " + BOX), F.col("doc_id").cast("string"), F.lit("}"))
    return mathdocs(spark, sf_dir).select("doc_id", t.light_clean(F.col("text")).alias("light"), t.title(F.col("text")).alias("title"), t.normalise(F.col("text")).alias("normal"), t.last_boxed(boxed).alias("boxed"))


@query(f"{M}, r as (select doc_id, {light('text')} as raw from m) select doc_id, {question('raw')} as question from r")
def txt17_clean_question(spark, sf_dir):
    return mathdocs(spark, sf_dir).select("doc_id", t.clean_question(F.col("text")).alias("question"))


def _unit(q: p.P) -> str:
    return f"nullif(regexp_extract(text, {lit(q.re2.replace('(?=', '(?:').replace(chr(92) + 'Z', chr(92) + 'z'))}, 1), '')"


ASKING = f"""list_filter({lines_sql("u")}, lambda x: ends_with(x, '?') and length(x) between 12 and 220 and not regexp_matches(x, '^(\\*\\*|#)') and not contains(x, 'Tags') and not {has("x", p.ANSWER_LIKE)})"""
UNITS = f"""u0 as (select doc_id, text, {title("text")} as title, coalesce({", ".join(map(_unit, p.PROBLEM_UNIT))}) as b, {light("left(text, 1400)")} as head from m),
u1 as (select doc_id, title, head, coalesce(case when b is not null then {light("left(b, 1400)")} end, case when {any_of("text", ("Problem", "Question", "Solution", "Answer"))} and contains(head, '?') then head else '' end) as found from u0),
u2 as (select doc_id, title, coalesce(nullif(found, ''), head) as source_unit from u1),
u3 as (select doc_id, title, source_unit, {light("source_unit")} as u from u2 where length(source_unit) >= 40),
u4 as (select doc_id, title, source_unit, {light("coalesce(" + ", ".join(f"nullif(regexp_extract(source_unit, {lit(q.re2)}, 1), '')" for q in p.EXPLICIT_QUESTION) + f", {ASKING}[1], case when ends_with({strip('title')}, '?') then title end)")} as found from u3),
units as (select doc_id, title, source_unit, case when found <> '' then {question("found")} else '' end as question from u4)"""


@query(f"{M}, {UNITS} select cast(doc_id as varchar) as source_id, title, source_unit, question from units")
def txt18_txt19_flt20_route_a_units(spark, sf_dir):
    return routes.units(mathdocs(spark, sf_dir)).select("source_id", "title", "source_unit", "question")


EXCERPTS = f"""e0 as (select doc_id, text, {title("text")} as title, list_filter(list_transform(regexp_split_to_array({light("text")}, '\\n\\s*\\n'), lambda x: {strip("x")}), lambda x: x <> '') as blocks from m),
e1 as (select doc_id, text, title, blocks, list_filter(blocks, lambda x: {any_of("lower(x)", p.CONCEPT_MARK)}) as marked from e0),
e2 as (select doc_id, text, title, case when len(marked) > 0 then list_reduce(marked, lambda a, x: case when length(a) >= 900 then a else a || chr(10) || chr(10) || x end) else array_to_string(blocks[1:3], chr(10) || chr(10)) end as kept from e1),
e3 as (select doc_id, coalesce(nullif(title, ''), 'mathematical concept') as knowledge_point, coalesce(nullif(left({light("kept")}, 900), ''), {light("left(text, 900)")}) as source_unit from e2),
excerpts as (select * from e3 where length(source_unit) >= 40)"""


@query(f"{M}, {EXCERPTS} select cast(doc_id as varchar) as source_id, knowledge_point, source_unit from excerpts")
def txt20_tvf5_concept_excerpts(spark, sf_dir):
    return routes.excerpts(mathdocs(spark, sf_dir)).select("source_id", "knowledge_point", "source_unit")


def rescue_ctes(source: str, given: str, before: str = "r") -> str:
    """CTEs that add ``rescued`` (TXT22) for the text ``given`` of ``source``; the last is ``<before>9``."""
    ends = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
    places = {"text": "t", "lines": "tail", "last": "last"}
    found = []
    for q, place, trim, least, most in p.RESCUE:
        body = q.re2.replace("(?<![a-zA-Z])", "(?:^|[^a-zA-Z])")
        v = f"regexp_extract({places[place]}, {lit(body)}, 1)"
        v = strip(rf"regexp_replace({v}, '\s+', ' ', 'g')" if place == "text" else v)
        v = f"regexp_replace({v}, '[{trim}]+$', '')" if trim else v
        v = f"list_filter([{v}], lambda x: length(x) between {least} and {most} and not starts_with(x, '=') and not contains(x, chr(92) || 'begin{{array}}') and not contains(x, chr(92) || 'begin{{align'))[1]"
        found.append(v)
    return f"""{before}7 as (select *, {strip(given)} as t, list_filter(list_transform(regexp_split_to_array({strip(given)}, {lit(ends)}), lambda x: {strip("x")}), lambda x: x <> '') as ls from {source}),
{before}8 as (select *, array_to_string(ls[-6:], ' ') as tail, coalesce(ls[-1], '') as last from {before}7), {before}9 as (select * exclude (t, ls, tail, last), coalesce({", ".join(found)}, '') as rescued from {before}8)"""


def reply_ctes(source: str, given: str, name: str) -> str:
    """CTEs ending in ``name``: the columns of ``source`` and ``answer`` (TXT21) of ``given``."""
    x = f"replace(replace({rx(strip(f"coalesce({given}, '')"), p.THINK)}, '⚇', ''), '⚼', '')"
    x = rx(rx(x, p.NEXT_Q), p.NEXT_PROBLEM)
    x = strip(compress(rx(rx(x, p.ROLE_LINE), p.SESSION_WORD)))
    ended = lambda c: f"case when regexp_matches({c}, '[^。.!?]$') then {c} || '。' else {c} end"
    box = f"chr(10) || chr(10) || chr(92) || 'boxed{{' || "
    kept = f"list_transform([{compress(strip(rx('_x', p.BOXED_PLAIN)))}], lambda b: {strip(f'{ended("b")} || {box} {strip(last_boxed("_x"))} || {lit("}")}')})[1]"
    return f"""{name}0 as (select *, {x} as _x from {source}), {rescue_ctes(f"{name}0", "_x", name)},
{name} as (select * exclude (_x, rescued), case when {has("_x", p.BOXED_PLAIN)} then {kept} when rescued <> '' then {ended("_x")} || {box} rescued || '}}' else _x end as answer from {name}9)"""


def reasoning(c: str) -> str:
    x = f"regexp_replace({strip(f"coalesce({c}, '')")}, '</?think>', '', 'g')"
    return strip(compress(rx(rx(rx(x, p.ROLE_LINE), p.SESSION_WORD), p.BOXED_PLAIN)))


# endings that call for each of the seven forms of a final answer, by the id
ENDINGS = ("", " so $$ x = 5 $$", " so x = 7.", " the total is 133,320.", " that makes **9.8 m/s**.", " we get $ab$.", " the answer is blue or so", " in all 12", " hence " + BOX + " 2 } as said", "\n## Q next\nmore", "<think>hm</think> it is 4", "\nUser: hi\nend here", "\n## Question 2\nWhat else?")
ENDED = "concat(text, case " + " ".join(f"when doc_id % {len(ENDINGS)} = {i} then {lit(x)}" for i, x in enumerate(ENDINGS)) + " end)"


def ended(spark, sf_dir):
    out = F.when(F.col("doc_id") % len(ENDINGS) == 0, F.lit(ENDINGS[0]))
    for i, x in enumerate(ENDINGS[1:], 1):
        out = out.when(F.col("doc_id") % len(ENDINGS) == i, F.lit(x))
    return mathdocs(spark, sf_dir).withColumn("text", F.concat("text", out))


@query(f"{M}, s as (select doc_id, {ENDED} as text from m), {reply_ctes('s', 'text', 'a')}, {rescue_ctes('a', 'text', 'b')} select doc_id, answer, rescued, {reasoning('text')} as reasoning from b9")
def txt21_txt22_txt23_clean_replies(spark, sf_dir):
    return ended(spark, sf_dir).select("doc_id", t.clean_answer(F.col("text")).alias("answer"), t.rescue_boxed(F.col("text")).alias("rescued"), t.clean_reasoning(F.col("text")).alias("reasoning"))


ASKED = rf"""list_transform(list_filter(list_transform(string_split({light("text")}, chr(10)), lambda x: {strip(f"regexp_replace(x, {lit(p.LIST_MARK.re2)}, '')")}), lambda x: length(x) >= 10),
 lambda x: case when regexp_matches(x, '[?？]$') then x else regexp_replace(x, '[。.:：]+$', '') || '?' end)"""


def two_questions(source: str, keep: str = "doc_id") -> str:
    """CTEs ending in ``asked2``: the first question, and the first that differs from it as cut (TXT26)."""
    return f"asked0 as (select {keep}, {ASKED} as ls from {source}), asked1 as (select *, left(ls[1], 220) as q1 from asked0), asked2 as (select * exclude (ls, q1), list_filter([q1, left(list_filter(ls[2:], lambda x: x <> q1)[1], 220)], lambda x: x is not null) as questions from asked1)"


@query(f"{M}, s as (select doc_id, concat('1. What is a ratio?', chr(10), '2) Compute 3:4 of 28.', chr(10), '- short', chr(10), '3. What is a ratio?', chr(10)) || text as led, text, doc_id % 2 as odd from m), r as (select doc_id, case odd when 1 then led else text end as text from s), {two_questions('r')} select doc_id, array_to_string(questions, chr(10)) as questions from asked2")
def txt26_dd4_question_lists(spark, sf_dir):
    lead = F.when(F.col("doc_id") % 2 == 1, "1. What is a ratio?\n2) Compute 3:4 of 28.\n- short\n3. What is a ratio?\n").otherwise("")
    return mathdocs(spark, sf_dir).select("doc_id", F.array_join(t.parse_questions(F.concat(lead, F.col("text"))), chr(10)).alias("questions"))


@query(rf"""{M}, w as (select doc_id, {strip(r"regexp_replace(" + strip("lower(text)") + r", '[\s\x1c-\x1f\x{85}\x{a0}]+', ' ', 'g')")} as l, {normal("text")} as k from m), v as (select doc_id, l, k, string_split(l, ' ') as ws from w)
select doc_id, left(l, 120) as fingerprint, array_to_string(list_sort(case when len(ws) >= 2 then list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) else list_filter(ws, lambda x: x <> '') end), '|') as bigrams,
 case when k = '' then '' else array_to_string(list_sort(list_distinct(string_split(k, ' '))), '|') end as tokens from v""")
def txt37_txt38_sets(spark, sf_dir):
    sets = lambda c: F.array_join(F.array_sort(c), "|")
    return mathdocs(spark, sf_dir).select("doc_id", t.fingerprint120(F.col("text")).alias("fingerprint"), sets(t.bigrams(F.col("text"))).alias("bigrams"), sets(t.tokens(F.col("text"))).alias("tokens"))


@query(f"""{M}, s as (select doc_id, string_split({normal("text")}, ' ') as a from m), r as (select x.doc_id, list_distinct(x.a) as a, list_distinct(y.a) as b from s x join s y on y.doc_id = x.doc_id + 1)
select doc_id, case when a = [''] and b = [''] then 0.0 else len(list_intersect(list_filter(a, lambda x: x <> ''), list_filter(b, lambda x: x <> ''))) / cast(greatest(1, len(list_distinct(list_concat(list_filter(a, lambda x: x <> ''), list_filter(b, lambda x: x <> ''))))) as double) end as jaccard from r""")
def txt39_jaccard_of_neighbours(spark, sf_dir):
    own = dedup.durable(mathdocs(spark, sf_dir).select("doc_id", t.tokens(F.col("text")).alias("a")), "tokens")  # made once for both sides
    return own.join(own.select((F.col("doc_id") - 1).alias("doc_id"), F.col("a").alias("b")), "doc_id").select("doc_id", t.jaccard(F.col("a"), F.col("b")).alias("jaccard"))


@query(f"""{M} select doc_id, {flags(("t", f"{any_of('lower(' + title('text') + ')', p.CONCEPT_TITLE)}"))} <> '' or {any_of("lower(left(text, 900))", p.CONCEPT_BODY)} as hinted,
 ({any_of('lower(' + title("text") + ')', p.CONCEPT_TITLE)} or {any_of("lower(left(text, 900))", p.CONCEPT_BODY)}) and not ((ends_with(lower({title("text")}), '?') and not contains(lower({title("text")}), 'how to') and not contains(lower({title("text")}), 'what is') and length({title("text")}) > 40)
 or contains(lower(left(text, 900)), 'problem statement') or (contains(lower(left(text, 900)), '## solution') and not contains(lower(left(text, 900)), 'objective') and not contains(lower(left(text, 900)), 'big idea'))) as concept from m""")
def flt15_concept_routing(spark, sf_dir):
    low, head = F.lower(t.title(F.col("text"))), F.lower(F.substring(F.col("text"), 1, 900))
    hinted = F.exists(F.array(*map(F.lit, p.CONCEPT_TITLE)), lambda w: F.contains(low, w)) | F.exists(F.array(*map(F.lit, p.CONCEPT_BODY)), lambda w: F.contains(head, w))
    return mathdocs(spark, sf_dir).select("doc_id", hinted.alias("hinted"), quality.is_concept(t.title(F.col("text")), F.col("text")).alias("concept"))


DOTS = "len(regexp_extract_all({0}, '[。.]'))"


def leak(c: str) -> str:
    return any_of(f"lower({c})", p.LEAK_WORDS)


def answer_flags(q: str, a: str) -> str:
    """FLT16; ``q`` and ``a`` are columns."""
    copied = f"not contains({a}, chr(92) || 'boxed{{') and {normal(q)} <> '' and contains({normal(a)}, {normal(q)}) and length({normal(a)}) < length({normal(q)}) + 80"
    thin = f"not contains({a}, chr(10)) and {DOTS.format(a)} < 1"
    return flags(("missing_boxed", f"not contains({a}, chr(92) || 'boxed{{')"), ("prompt_leak", leak(a)), ("too_short", f"length({a}) < 50"), ("thin_reasoning", thin), ("question_copied", copied))


def reasoning_flags(c: str) -> str:
    thin = f"length({c}) - length(replace({c}, chr(10), '')) < 2 and {DOTS.format(c)} < 4"
    return flags(("reasoning_too_short", f"length({c}) < 180"), ("reasoning_prompt_leak", leak(c)), ("reasoning_too_thin", thin), ("reasoning_too_long", f"length({c}) > 7000"))


ANSWERS = ("text", "concat('User: ', text)", "replace(text, chr(10), ' ')", "concat(text, ' ', chr(92), 'boxed{1}')", "md5(text)")  # the last is a short one that all of a text decides
ASKING = "case when doc_id % 10 = 2 then text else split_part(text, chr(10), 1) end"
ANSWER = "case doc_id % 5 " + " ".join(f"when {i} then {x}" for i, x in enumerate(ANSWERS)) + " end"


@query(f"{M}, q as (select doc_id, {ASKING} as q, {ANSWER} as a from m) select doc_id, {answer_flags('q', 'a')} as flags from q")
def flt16_answer_flags(spark, sf_dir):
    docs = mathdocs(spark, sf_dir).selectExpr("doc_id", f"{ASKING} as q", f"{ANSWER} as a")
    return docs.select("doc_id", F.array_join(gates.answer_flags(F.col("q"), F.col("a")), ",").alias("flags"))


@query(f"{M}, r as (select doc_id, case when doc_id % 3 = 0 then concat(text, ' source unit') else text end as text from m) select doc_id, {reasoning_flags('text')} as flags from r")
def flt17_reasoning_flags(spark, sf_dir):
    return mathdocs(spark, sf_dir).select("doc_id", F.array_join(gates.reasoning_flags(F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" source unit"))).otherwise(F.col("text"))), ",").alias("flags"))


ASKS = "case doc_id % 4 when 0 then concat(text, ' ', chr(92), 'boxed{2}') when 1 then concat(text, ' is $x$ here?') else text end"


@query(f"{M}, q as (select doc_id, {ASKS} as q from m) select doc_id, contains(q, chr(92) || 'boxed{{') or {has('q', p.QUESTION_WITH_ANSWER)} as rejected from q")
def flt19_question_rejected(spark, sf_dir):
    return mathdocs(spark, sf_dir).selectExpr("doc_id", f"{ASKS} as q").select("doc_id", gates.question_rejected(F.col("q")).alias("rejected"))


def valid_sql(kind: str) -> str:
    math = has("s", p.MATH_IN_SOLUTION) if kind == "A" else has("p || s", p.MATH_CONTENT)
    return f"length(p) >= 30 and length(s) >= {80 if kind == 'B' else 100} and {math}"


@query(f"{M}, q as (select doc_id, split_part(text, chr(10), 1) as p, text as s from m) select doc_id, {valid_sql('A')} as a, {valid_sql('B')} as b, {valid_sql('C')} as c from q")
def flt12_flt13_valid_pairs(spark, sf_dir):
    docs = mathdocs(spark, sf_dir).selectExpr("doc_id", "split_part(text, chr(10), 1) as p", "text as s")
    return docs.select("doc_id", *(quality.valid_pair(F.col("p"), F.col("s"), k).alias(k.lower()) for k in "ABC"))


HUNDRED = "concat(md5(text), md5(concat(text, 'y')), md5(concat('y', text)), 'abcd')"  # 100 characters that all of a text decides
CLEAN_ANSWERS = f"case doc_id % 7 when 0 then concat('  ', md5(text), ' ') when 1 then concat('= ', md5(text)) when 2 then 'Therefore' when 3 then concat(text, chr(10), 'b') when 4 then text when 5 then {HUNDRED} else concat('e', {HUNDRED}) end"


@query(f"{M}, a as (select doc_id, {strip(CLEAN_ANSWERS)} as a from m) select doc_id, length(a) > 0 and length(a) <= 100 and not regexp_matches(a, '^[+,.;=*/]') and not contains(a, chr(10)) and not regexp_matches(a, {lit('(?i)^(?:' + p.BOXED_NOISE.body + ')$')}) as clean from a")
def flt28_clean_answer(spark, sf_dir):
    return mathdocs(spark, sf_dir).selectExpr("doc_id", f"{CLEAN_ANSWERS} as a").select("doc_id", gates.clean_answer(F.col("a")).alias("clean"))


# solutions that fail at each gate in turn, by the id
BODY = "regexp_replace(text, '[^A-Za-z ]+', ' '{g})"
PAD = "repeat('We compute $a$, $b$ and $c$. ', 8)"
GATED = {
    0: f"concat({PAD}, s, ' ', chr(92), 'boxed{{7}}')",
    1: f"concat({PAD}, s)",
    2: f"concat({PAD}, s, chr(92), 'boxed{{1}}', chr(92), 'boxed{{2}}', chr(92), 'boxed{{3}}', chr(92), 'boxed{{4}}')",
    3: f"concat({PAD}, s, chr(92), 'boxed{{ }}')",
    4: f"concat(chr(92), 'boxed{{7}} ', {PAD}, s)",
    5: f"concat({PAD}, s, chr(92), 'boxed{{', repeat('y', 101), '}}')",
    6: "concat(s, ' ', chr(92), 'boxed{7}')",
    7: f"concat({PAD}, s, 'see also ', chr(92), 'boxed{{7}}')",
    8: f"concat({PAD}, s, 'https://a.b https://c.d https://e.f ', chr(92), 'boxed{{7}}')",
    9: f"concat({PAD}, '```x', chr(10), repeat('code ', 80), s, '```', chr(92), 'boxed{{7}}')",
    10: f"concat({PAD}, s, chr(92), 'boxed{{7}} and')",
    11: f"concat({PAD}, {PAD}, s, chr(92), 'boxed{{7}}', {PAD}, {PAD}, ' x')",
    12: f"concat({PAD}, s, chr(92), 'boxed{{7}}')",
}
PROBLEMS = "case when doc_id % 13 < 12 then concat('Find the value of x in this equation. ', s) when doc_id % 3 = 0 then concat('The above is a problem about numbers. ', s) when doc_id % 3 = 1 then concat('Find x as shown in the diagram and say why. ', s) else 'short' end"
PAIRS = f"select doc_id, {PROBLEMS} as problem, case doc_id % 13 " + " ".join(f"when {k} then {x}" for k, x in GATED.items()) + " end as solution from (select doc_id, " + BODY + " as s from {m})"
GATE = f"""g0 as (select *, len(regexp_extract_all(solution, {lit(p.BOXED.re2)})) as nb, {strip(f"regexp_extract_all(solution, {lit(p.BOXED_FULL.re2)}, 1)[-1]")} as content, length(regexp_extract(solution, '(?s)^(.*)\\\\boxed\\{{[^}}]*\\}}', 1)) as place,
 coalesce(list_sum(list_transform(regexp_extract_all(solution, {lit(p.CODE_BLOCK.re2)}), lambda x: length(x))), 0) as code, lower(right(regexp_replace(solution, '[\\s\\x1c-\\x1f]+$', ''), 50)) as tail, length(problem) as np, length(solution) as ns, {strip("problem")} as start from pairs),
g as (select *, case when nb = 0 then 'L1:no_boxed' when nb > 3 then 'L1:boxed_count_' || nb when coalesce(content, '') = '' then 'L1:empty_boxed' when length(content) > 100 then 'L1:boxed_too_long' when place < 0.35 * ns then 'L1:boxed_too_early'
 when np < 30 or np > 2000 then 'L2:problem_length_' || np when ns < 150 or ns > 6000 then 'L2:solution_length_' || ns
 when not ({n("solution", p.LATEX_EXPR)} >= 3 or {n("solution", p.CORE_MATH)} >= 2 or {n("solution", p.ARITHMETIC)} >= 4) then 'L3:low_math_density'
 when {has("solution", p.GATE_NOISE)} then 'L4:noise_keyword:' || left(regexp_extract(solution, {lit(p.GATE_NOISE.re2)}), 30) when {n("solution", p.URL)} > 2 then 'L4:too_many_urls_' || {n("solution", p.URL)}
 when code > 0.35 * ns then 'L4:code_block_dominant' when {" or ".join(f"ends_with(tail, '{x}')" for x in p.TRUNCATED)} then 'L4:truncated_ending' when not {has("right(solution, 300)", p.BOXED)} then 'L5:boxed_not_at_end'
 when {has("start", p.DANGLING)} then 'L6:dangling_reference_start' when {has("start", p.EXTERNAL_REF)} then 'L6:external_reference:' || left(regexp_extract(start, {lit(p.EXTERNAL_REF.re2)}), 30) end as gate from g0)"""


def pairs(spark, sf_dir):
    solution = "case doc_id % 13 " + " ".join(f"when {k} then {x}" for k, x in GATED.items()) + " end as solution"
    return mathdocs(spark, sf_dir).selectExpr("doc_id", BODY.replace("{g}", "") + " as s").selectExpr("doc_id", f"{PROBLEMS} as problem", solution)


@query(f"{M}, pairs as ({PAIRS.replace('{g}', ', ' + lit('g')).replace('{m}', 'm')}), {GATE} select doc_id, gate from g")
def flt21_to_flt27_gates(spark, sf_dir):
    return pairs(spark, sf_dir).select("doc_id", gates.gate_reason(F.col("problem"), F.col("solution"), relaxed=True).alias("gate"))


@query(f"{M}, pairs as ({PAIRS.replace('{g}', ', ' + lit('g')).replace('{m}', 'm')}), {GATE} select coalesce(split_part(gate, ':', 1), 'passed') as gate, count(*) as n from g group by 1")
def agg6_gate_histogram(spark, sf_dir):
    gate = gates.gate_reason(F.col("problem"), F.col("solution"), relaxed=True)
    return pairs(spark, sf_dir).groupBy(F.coalesce(F.split_part(gate, F.lit(":"), F.lit(1)), F.lit("passed")).alias("gate")).agg(F.count("*").alias("n"))
