"""Long-document splitting: headings, merging, forced paragraph splits (TVF1-TVF5, AGG7, DES11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as p
from ..functions import text as t
from ..functions.counts import counts, counts_each
from .names import fresh, without

_MARK = "\u0001"


def heading_sections(c: Column) -> Column:
    """TVF1: bodies with their heading line, the preamble first where it is not blank. A bare ``##`` takes the next line that isn't blank as its title, so a heading there begins no section of its own."""
    parts = F.split(F.regexp_replace(c, r"(?Udm)^#{1,4}\s+.", _MARK + "$0"), _MARK)
    return F.filter(parts, lambda x: t.strip(x) != "")


def _joined(parts: Column, starts: Column) -> Column:
    """Parts from each start (from 0) to the next one, a blank line between them. A part is copied once."""
    to = lambda k: F.coalesce(F.try_element_at(starts, k + 2), F.size(parts))
    return F.transform(starts, lambda at, k: F.array_join(F.slice(parts, at + 1, to(k) - at), "\n\n"))


def merged(sections: Column, min_chunk: int) -> Column:
    """TVF2: a section shorter than ``min_chunk`` joins the piece before it; the first starts one. Places are found first, then texts are joined."""
    starts = lambda x: F.array_compact(F.transform(x, lambda s, i: F.when((i == 0) | (F.length(s) >= min_chunk), i)))
    return t.let(F.transform(sections, t.strip), lambda x: t.let(starts(x), lambda at: _joined(x, at)))


def force_split(piece: Column, target: int, limit: int) -> Column:
    """TVF3: a piece over ``limit`` is refilled paragraph by paragraph up to ``target``; a longer paragraph stays whole. The fold goes over lengths and keeps where pieces begin, so its state is a number for each piece."""
    empty = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).cast("long").alias("now"))

    def step(acc, x):
        size = x["n"].cast("long")
        fits = (acc["now"] > 0) & (acc["now"] + size + 2 <= target)
        return F.when(fits, F.struct(acc["starts"].alias("starts"), (acc["now"] + size + 2).alias("now"))).otherwise(F.struct(F.concat(acc["starts"], F.array(x["i"])).alias("starts"), size.alias("now")))

    def refilled(paragraphs):
        sizes = F.transform(paragraphs, lambda x, i: F.struct(i.alias("i"), F.length(x).alias("n")))
        return t.let(F.aggregate(sizes, empty, step, lambda acc: acc["starts"]), lambda at: _joined(paragraphs, at))

    paragraphs = F.filter(F.split(piece, r"\n{2,}"), lambda x: t.strip(x) != "")
    return F.when(F.length(piece) > limit, t.let(paragraphs, refilled)).otherwise(F.array(piece))


def _chunks(c: Column, min_chunk: int, target: int, max_chunk: int) -> Column:
    """TVF1 to TVF3: all pieces of a text in order."""
    pieces = merged(heading_sections(F.coalesce(c, F.lit(""))), min_chunk)
    return F.flatten(F.transform(pieces, lambda x: force_split(x, target, max_chunk)))


def split_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chunk: int = 800, target: int = 8000, max_chunk: int = 15_000, min_math: float = 0.3) -> DataFrame:
    """TVF4: chunks with ``chunk_index`` and ``chunk_total`` (both before the drop of short or plain chunks), ``chunk_chars``, ``source_doc_id`` and a chunk id, in place of columns of those names. Null and empty texts give none."""
    pieces, piece, of = fresh(docs, "chunks", "chunk", "of")
    rows = without(docs.withColumn(of, F.col(id_col)), ("chunk_index", "chunk_total", "chunk_chars", "source_doc_id", "chunk_id"), (id_col, text)).withColumn(pieces, _chunks(F.col(text), min_chunk, target, max_chunk))
    rows = rows.withColumn("chunk_total", F.size(pieces).cast("long"))  # before a row for each chunk is made, which would carry all chunks for this
    names = [c for c in rows.columns if c != pieces]
    rows = rows.select(*(c for c in names if c.lower() != text.lower()), F.posexplode(pieces).alias("chunk_index", piece))
    rows = rows.select(*(F.col(piece).alias(text) if c.lower() == text.lower() else c for c in names), "chunk_index").withColumn("chunk_chars", F.length(text).cast("long"))
    (n,) = fresh(rows, "counts")
    rows = rows.filter(F.length(text) >= min_chunk).withColumn(n, counts(F.col(text), math=p.MATH))
    rows = rows.filter(t.per(F.col(n)["math"], F.col(text), 500) >= min_math).drop(n)
    return rows.withColumn("source_doc_id", F.col(of)).withColumn("chunk_id", t.chunk_id(F.col(of), F.col("chunk_index"))).drop(of)


def chunk_stats(docs: DataFrame, text: str = "text", min_chunk: int = 800, target: int = 8000, max_chunk: int = 15_000, min_math: float = 0.3) -> DataFrame:
    """AGG7 of the chunks that :func:`split_documents` gives: their number, documents without one, mean by integer division, and the lengths at the sorted places
    n // 10, n // 2, int(n * 0.9); nulls without a chunk. One lazy aggregate: rows are counted by length before anything is ordered."""
    pieces = docs.select(F.filter(_chunks(F.col(text), min_chunk, target, max_chunk), lambda x: F.length(x) >= min_chunk).alias("pieces"))
    found = pieces.select(F.transform("pieces", F.length).alias("sizes"), counts_each(F.col("pieces"), p.MATH).alias("math"))
    sizes = F.zip_with("sizes", "math", lambda x, n: F.when(n / (x / 500.0) >= min_math, x))
    of_length = found.select(F.explode_outer(F.array_compact(sizes)).alias("len")).groupBy("len").agg(F.count("*").alias("n"))  # a null length: a document without a chunk
    own = F.when(F.col("len").isNotNull(), F.col("n")).otherwise(0)
    ordered = Window.orderBy("len").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # a row for each length
    placed = of_length.withColumn("own", own).withColumn("to", F.sum("own").over(ordered)).withColumn("total", F.sum("own").over(Window.partitionBy(F.lit(0))))
    at = lambda place: F.max(F.when((F.col("to") - F.col("own") <= place) & (place < F.col("to")), F.col("len"))).cast("long")
    total = F.col("total")
    return placed.agg(
        F.coalesce(F.sum("own"), F.lit(0)).alias("chunks"),
        F.coalesce(F.sum(F.col("n") - F.col("own")), F.lit(0)).alias("empty_docs"),
        F.expr("cast(sum(len * own) as bigint) div nullif(sum(own), 0)").alias("mean_chars"),
        at(F.floor(total / 10)).alias("p10"),
        at(F.floor(total / 2)).alias("p50"),
        at(F.floor(total * 0.9)).alias("p90"),
    )


def overlapping_chunks(docs: DataFrame, text: str = "text", size: int = 1500, overlap: int = 200) -> DataFrame:
    """DES11: windows of ``size`` characters, each ``overlap`` into the one before."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), F.lit(size - overlap))
    (at,) = fresh(docs, "at")
    return docs.withColumn(at, F.explode(starts)).withColumn("chunk", F.substr(F.col(text), F.col(at), F.lit(size))).filter("length(chunk) > 0").withColumn("chunk_start", (F.col(at) - 1).cast("long")).drop(at)


def split_questions(docs: DataFrame, text: str = "text") -> DataFrame:
    """DES12: a document with two or more problem headings gives one row for each, from that heading to the next; ``qa_index`` counts from 0.
    Others stay whole with index 0, as do null texts. What stands before the first problem heading goes with the split."""
    mark = "\x02"
    c = F.translate(F.col(text), mark, "")
    parts = F.split(F.regexp_replace(c, p.PROB_HEADER.java, mark + "$0"), mark)
    units = F.when(F.size(parts) > 2, F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))).otherwise(F.array(F.col(text)))
    rest = [x for x in docs.columns if x not in (text, "qa_index")]
    return docs.select(*rest, F.posexplode(units).alias("qa_index", text)).select(*(c for c in docs.columns if c != "qa_index"), F.col("qa_index").cast("long").alias("qa_index"))


def first_pairs(pairs: DataFrame, article: str, order: str, most: int = 2) -> DataFrame:
    """DES10: of every article its first ``most`` pairs. Each task ranks before the shuffle (a group limit), so a long article sends few rows. Null articles are one article."""
    rank = F.row_number().over(Window.partitionBy(article).orderBy(order))
    (r,) = fresh(pairs, "r")
    return pairs.withColumn(r, rank).filter(F.col(r) <= most).drop(r)
