"""Licence scan by a positional rare-token index, with DataFrame functions alone.

A template is a licence text with one or more key phrases. The index lists the words that a template has once, with their places. One pass parts
every text into words and keeps, of a file that has all key words of some template, the words themselves, of any file the licence words it has; the document frequency of
those is counted over all files. Then every file is looked up by its own ``TOP`` rarest words of each template: a place of such a word proposes a start of
the template, proposals of two of the words or more must agree, and an agreed start counts where every key phrase stands, word for word, within the template's slack
of its place. ``score`` is the largest share of a template's words that stand in place at a counted start; at starts that agree without
the key phrases half of that share; else 0.

The contract's base phrases are templates that are one key phrase without slack: all their words are rare words of a file that has them, so no place of
them is lost. Words: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased (the two other letters that lower-case into
ASCII are put aside first). Null and empty texts have no words. Repeated rows are scanned each, an empty table gives none, extra columns
are ignored. No shuffle but the corpus counts: a number for each licence word. A task holds one file's words."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from . import storage

TOP = 4


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...]
    base: bool = False
    slack: int = 8

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def once(self) -> dict[str, int]:
        """The index entries: words that stand once, and where."""
        return {w: k for k, w in enumerate(self.words) if self.words.count(w) == 1}

    @property
    def key_places(self) -> list[tuple[int, list[str]]]:
        """Every key phrase and its first place in the text."""
        words = self.words
        return [(next(k for k in range(len(words)) if words[k : k + len(p)] == p), p) for p in (x.split() for x in self.keys)]


def phrase(label: str, text: str, base: bool = False) -> Template:
    return Template(label, text, (text,), base, 0)


# Licence texts as words, and the phrases without which a text is not that licence.
_WARRANTY = "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"
_BSD = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
    "1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
    "2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"
)
_GNU = (
    "this program is free software you can redistribute it and or modify it under the terms of the gnu {0}general public license as published by the free software foundation either version {1} of the license "
    "or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"
)
TEMPLATES = (
    phrase("mit", "under the mit license", True),
    phrase("apache-2", "apache license version 2", True),
    phrase("cc-by-nc", "cc by nc", True),
    phrase("cc-by-sa", "cc by sa"),
    phrase("gpl-2", "gnu general public license version 2"),
    phrase("gpl-3", "gnu general public license version 3"),
    phrase("lgpl", "gnu lesser general public license"),
    phrase("mpl-2", "mozilla public license version 2"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction "
        "including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so "
        f"subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software {_WARRANTY}",
        ("permission is hereby granted free of charge", "to deal in the software without restriction"),
    ),
    Template("bsd-2", _BSD, ("redistribution and use in source and binary forms", "must reproduce the above copyright notice")),
    Template(
        "bsd-3",
        f"{_BSD} 3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        ("redistribution and use in source and binary forms", "endorse or promote products derived from this software"),
        slack=16,
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies "
        "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
        ("permission to use copy modify and or distribute this software", "disclaims all warranties"),
    ),
    Template(
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 "
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
        ("you may not use this file except in compliance with the license", "unless required by applicable law or agreed to in writing"),
    ),
    Template("gpl-2", _GNU.format("", "2"), ("under the terms of the gnu general public license", "either version 2 of the license")),
    Template("gpl-3", _GNU.format("", "3"), ("under the terms of the gnu general public license", "either version 3 of the license")),
    Template("lgpl", _GNU.format("lesser ", "3"), ("under the terms of the gnu lesser general public license",)),
    Template(
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone "
        "to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
        ("in no event will the authors be held liable", "to alter it and redistribute it freely"),
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary "
        "for any purpose commercial or non commercial and by any means",
        ("free and unencumbered software released into the public domain",),
    ),
)


def words_column(text: Column) -> Column:
    aside = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("İ"), F.lit("é")), F.lit("K"), F.lit("é"))
    spaced = F.btrim(F.regexp_replace(F.lower(aside), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def _literals(words) -> Column:
    return F.array(*map(F.lit, words)) if words else F.array().cast("array<string>")


def looked_up(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_words, present, words): the licence words a file has, and its words if it has all key words of a template."""
    vocab = sorted({w for t in TEMPLATES for w in t.words})
    keys = sorted({tuple(sorted({w for p in t.keys for w in p.split()})) for t in TEMPLATES})
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), words_column(F.col(text_col)).alias("words"))
    rows = rows.select("doc_id", F.size("words").cast("long").alias("n_words"), "words", F.array_intersect(_literals(vocab), "words").alias("present"))
    any_of = F.lit(False)
    for k in keys:
        any_of = any_of | (F.size(F.array_intersect("present", _literals(k))) == len(k))
    return rows.select("doc_id", "n_words", "present", F.when(any_of, F.col("words")).alias("words"))


def rarest_first(rows: DataFrame) -> list[str]:
    """Licence words by the number of files that have them, then by letters. The driver gets one number for each word of the templates."""
    got = rows.select(F.explode("present").alias("w")).groupBy("w").count().collect()
    return sorted((r["w"] for r in got), key={r["w"]: (r["count"], r["w"]) for r in got}.__getitem__)


def agreed_starts(t: Template) -> Column:
    """The starts of a template that two of the file's rarest words of it propose."""
    offset = F.create_map(*(F.lit(x) for w, k in t.once.items() for x in (w, k)))
    own = F.slice(F.filter("ranked", lambda w: w.isin(list(t.once))), 1, TOP)
    none = F.array().cast("array<int>")

    def proposed(w: Column) -> Column:
        place = F.try_element_at(offset, w)
        return F.transform(F.filter("places", lambda p: p["w"] == w), lambda p: p["i"] - place)

    def met(sets: Column) -> Column:
        pairs = (F.array_intersect(F.get(sets, F.lit(i)), F.get(sets, F.lit(j))) for i in range(TOP) for j in range(i + 1, TOP))
        return F.array_distinct(F.concat(*(F.coalesce(p, none) for p in pairs)))

    return let(F.transform(own, proposed), met)


def _verified(t: Template, s: Column) -> Column:
    """Whether every key phrase stands near its place for a start ``s``."""

    def stands(words: list[str], at: Column) -> Column:
        return F.when(at >= 0, F.slice("words", F.greatest(at + 1, F.lit(1)), len(words)) == _literals(words)).otherwise(F.lit(False))

    found = [F.exists(F.sequence(s + (place - t.slack), s + (place + t.slack)), partial(stands, words)) if t.slack else stands(words, s + place) for place, words in t.key_places]
    return reduce(lambda x, y: x & y, found)


def _share(t: Template, s: Column) -> Column:
    """Share of the template's words that stand in place for a start ``s``."""
    same = F.filter(F.transform(_literals(t.words), lambda w, k: F.get("words", s + k) == w), lambda x: F.coalesce(x, F.lit(False)))
    return F.size(same) / F.lit(float(len(t.words)))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    rows = storage.staged(looked_up(docs, id_col, text_col), f"{storage.workspace(docs.sparkSession, 'licenses')}/words")
    ranked = rarest_first(rows)
    vocab = sorted({w for t in TEMPLATES for w in t.once})
    plain = rows.filter("words is null").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_base"), F.lit(None).cast("long").alias("first_word"), F.lit(None).cast("long").alias("last_word"), F.lit("").alias("base_labels"), F.lit("").alias("labels"), F.lit(0.0).alias("score")
    )
    places = F.filter(F.transform("words", lambda w, i: F.when(w.isin(vocab), F.struct(i.alias("i"), w.alias("w")))), lambda p: p.isNotNull())
    rows = rows.filter("words is not null").select("doc_id", "n_words", "words", F.array_intersect(_literals(ranked), "present").alias("ranked"), places.alias("places"))
    rows = rows.select("doc_id", "n_words", "words", *(agreed_starts(t).alias(f"m{k}") for k, t in enumerate(TEMPLATES)))
    rows = rows.select("doc_id", "n_words", "words", *(f"m{k}" for k in range(len(TEMPLATES))), *(F.filter(f"m{k}", partial(_verified, t)).alias(f"t{k}") for k, t in enumerate(TEMPLATES)))
    best = F.greatest(F.lit(0.0), *(F.coalesce(F.array_max(F.transform(f"t{k}", partial(_share, t))), F.lit(0.0)) for k, t in enumerate(TEMPLATES)))
    near = F.greatest(F.lit(0.0), *(F.coalesce(F.array_max(F.transform(f"m{k}", partial(_share, t))), F.lit(0.0)) for k, t in enumerate(TEMPLATES)))
    spots = F.concat(*(f"t{k}" for k, t in enumerate(TEMPLATES) if t.base))

    def labels(keep) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*(F.when(F.size(f"t{k}") > 0, F.lit(t.label)) for k, t in enumerate(TEMPLATES) if keep(t)))))), ",")

    found = rows.select(
        "doc_id", "n_words", F.size(spots).cast("long").alias("n_base"), F.array_min(spots).cast("long").alias("first_word"), F.array_max(spots).cast("long").alias("last_word"),
        labels(lambda t: t.base).alias("base_labels"), labels(lambda t: True).alias("labels"), F.when(best > 0, best).otherwise(near / 2).alias("score"),
    )
    return found.unionByName(plain)


def _sql_list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


#: The same result in DuckDB's SQL: joins of places with the index's entries in place of array functions.
ORACLE_SQL = f"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from documents),
tpl as (select * from (values {", ".join(f"({k}, '{t.label}', {str(t.base).lower()}, {t.slack}, {_sql_list(t.words)})" for k, t in enumerate(TEMPLATES))}) v(t, label, base, slack, tw)),
keys as (select * from (values {", ".join(f"({k}, {place}, {_sql_list(p)})" for k, t in enumerate(TEMPLATES) for place, p in t.key_places)}) v(t, place, kw)),
entries as (select * from (values {", ".join(f"({k}, '{w}', {at})" for k, t in enumerate(TEMPLATES) for w, at in t.once.items())}) v(t, w, k)),
toks as (select r, unnest(words) as w, unnest(range(0, len(words))) as i from d),
vocab as (select distinct unnest(tw) as w from tpl),
present as (select distinct r, w from toks semi join vocab using (w)),
df as (select w, count(*) as n from present group by w),
keywords as (select distinct t, unnest(kw) as w from keys),
able as (select r, t from (select p.r, k.t, count(*) as n from present p join keywords k using (w) group by p.r, k.t) join (select t, count(*) as m from keywords group by t) using (t) where n = m),
gate as (select distinct r from able),
own as (select r, t, w, k from (select p.r, e.t, p.w, e.k, row_number() over (partition by p.r, e.t order by df.n, p.w) as q from present p semi join gate g on g.r = p.r join entries e using (w) join df using (w)) where q <= {TOP}),
met as (select o.r, o.t, t.i - o.k as s from own o join toks t on t.r = o.r and t.w = o.w group by 1, 2, 3 having count(distinct o.w) >= 2),
fit as (select m.r, m.t, m.s, tpl.label, tpl.base,
  (select bool_and(list_bool_or(list_transform(range(-tpl.slack, tpl.slack + 1), lambda x: m.s + k.place + x >= 0 and d.words[m.s + k.place + x + 1 : m.s + k.place + x + len(k.kw)] = k.kw))) from keys k where k.t = m.t) as ok,
  len(list_filter(range(0, len(tpl.tw)), lambda x: m.s + x >= 0 and coalesce(d.words[m.s + x + 1], '') = tpl.tw[x + 1])) / cast(len(tpl.tw) as double) as share
  from met m join tpl on tpl.t = m.t join d on d.r = m.r),
agg as (select r, count(*) filter (ok and base) as n_base, min(s) filter (ok and base) as first_word, max(s) filter (ok and base) as last_word,
  coalesce(array_to_string(list_sort(list_distinct(list(label) filter (ok and base))), ','), '') as base_labels, coalesce(array_to_string(list_sort(list_distinct(list(label) filter (ok))), ','), '') as labels,
  coalesce(max(share) filter (ok), max(share) / 2) as score from fit group by r)
select d.doc_id, cast(len(d.words) as bigint) as n_words, coalesce(a.n_base, 0) as n_base, cast(a.first_word as bigint) as first_word, cast(a.last_word as bigint) as last_word,
  coalesce(a.base_labels, '') as base_labels, coalesce(a.labels, '') as labels, coalesce(a.score, 0.0) as score from d left join agg a on a.r = d.r
"""
