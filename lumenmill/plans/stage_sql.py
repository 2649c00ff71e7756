"""The SQL of the first stages: cascade, cleaning, labels."""

from __future__ import annotations

from ..functions import patterns as p
from .sql import M, has, lit, n, rx, strip  # noqa: F401

CASCADE = f"""{M}, s as (select m.doc_id, m.text, cast(1.0 + coalesce(l.quality, 1) as double) as score from m left join labels l on m.doc_id = l.doc_id),
c as (select doc_id, case when length(text) < 800 then 'too_short' when score < 1.5 then 'low_nemo'
 when {n('text', p.NOISE)} / (length(text) / 100.0) > 0.15 then 'noise_dense' when {n('text', p.MATH)} / (length(text) / 500.0) < 0.5 then 'low_math' end as reason, length(text) > 50000 as long from s),
d as (select doc_id, reason, case when reason is not null then 'discard' when long then 'long' else 'normal' end as label from c)"""
CMS = rx(rx(rx(rx("text", p.DEL), p.INS, r"\1"), p.DEL_BARE), p.INS_BARE)
FORUM = rx(rx("text", p.NAV_LINE), p.FORUM_META)
LATEX = rx(rx("text", p.LATEX_DISPLAY, r"$$\1$$"), p.LATEX_INLINE, r"$\1$")
CLEAN = f"""{M}, t1 as (select doc_id, text as t0, {CMS} as text from m), t2 as (select doc_id, t0, text as t1, {rx('text', p.NAV_LINE)} as text from t1),
t3 as (select doc_id, t0, t1, text as t2, {rx('text', p.FORUM_META)} as text from t2), t4 as (select doc_id, t0, t1, t2, text as t3, {LATEX} as text from t3),
t5 as (select doc_id, t0, t1, t2, t3, text as t4, {rx('text', p.EXCESS_BLANK, chr(10) * 2)} as text from t4)"""
LINES = f"list_filter(list_transform(string_split(text, chr(10)), lambda x: {strip('x')}), lambda x: x <> '')"
CALC = f"({n('text', p.CALC_LINE)} >= 8 or {has('text', p.UNIT_TABLE)} or (len({LINES}) >= 10 and 2 * len(list_filter({LINES}, lambda x: {has('x', p.NUMBER_LINE)})) > len({LINES})))"
RULE = f"""case when {CALC} then 'E' when {n('text', p.FORUM_STRONG)} >= 2 then 'B' when {n('text', p.NUMBERED_SECTION)} >= 2 and {n('text', p.FORMAL_BLOCK)} >= 2 then 'D'
 when {has('text', p.PROB_MARK)} and {has('text', p.SOL_MARK)} then 'A' end"""
LABELLED = f"""{M}, r as (select doc_id, text, {RULE} as r from m), f as (select doc_id, coalesce(r, case when {has('substring(text, 1, 800)', p.WORD_PROBLEM)} and length(text) < 5000 then 'A' when {has('text', p.DEFINITION)} then 'C' else 'F' end) as label,
 case when r is null then 'model' else 'rule' end as label_source from r)"""
