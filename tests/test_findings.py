"""What the findings of round 3 asked for: expressions that are made once, parts of bounded size, joins without the driver, stages that write once."""

import pyarrow as pa
from pyspark.sql import functions as F

from lumenmill.functions import patterns as p
from lumenmill.functions import text as t
from lumenmill.functions.counts import counts, counts_each
from lumenmill.operators import coldstart, dedup, quality, routes, slices, split
from lumenmill.operators.names import kept
from lumenmill.plans import drivers, registry
from lumenmill.plans.fixture import scripted_model
from lumenmill.sources import jsonl


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_trims_are_what_the_pattern_strips(spark):
    chars = spark.createDataFrame([(i, chr(i) + "a" + chr(i) + "b" + chr(i)) for i in range(1, 0x10000) if not 0xD800 <= i < 0xE000], "id int, c string")
    pattern = F.regexp_replace("c", r"(?Ud)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")
    assert chars.filter(t.strip(F.col("c")) != pattern).count() == 0
    assert chars.filter(t.strip_end(F.col("c")) != F.regexp_replace("c", r"(?Ud)[\s\x1c-\x1f]+\z", "")).count() == 0


def test_blanks_and_other_characters_come_to_one_blank(spark):
    rows = spark.createDataFrame([(x,) for x in ("a b", "a  b", "a\tb", "a \t b", "\ta b ", "a,b c", "a , b", "é a", " ", "", "a-é 7", "x \n y")], "c string")
    plain = F.btrim(F.regexp_replace(F.lower(t.light_clean(F.col("c"))), r"[^0-9a-z\x{4e00}-\x{9fff}]+", " "))
    assert rows.filter(t.normalise(F.col("c")) != plain).count() == 0
    assert rows.filter(t.light_clean(F.col("c")) != t.strip(F.regexp_replace("c", r"[ \t]+", " "))).count() == 0


def test_a_filter_does_not_make_its_column_again(spark):
    docs = spark.createDataFrame([(1, "# T\n\nWhat is asked here in these many words?\n\nan answer", "A")], "doc_id long, text string, label string")
    made = docs.select("doc_id", F.regexp_replace("text", "asked", "x").alias("y"))
    assert optimized(made.filter("length(y) > 3")).count("regexp_replace") == 2 and optimized(kept(made, "length(y) > 3")).count("regexp_replace") == 1
    assert kept(made, "length(y) > 3").columns == ["doc_id", "y"] and kept(made, F.length("y") < 3).count() == 0
    assert optimized(coldstart.rejects(coldstart.gated_pairs(docs))).count("L4:code_block_dominant") == 1
    assert optimized(routes.excerpts(docs)).count("vocabulary") == 1


def test_parts_of_a_batch_are_bounded(spark):
    assert list(slices.places([5, 5, 5, 50, 1], 2, 20)) == [(0, 2), (2, 1), (3, 1), (4, 1)] and list(slices.places([])) == []
    texts = ["x" * 700_000, None, "y" * 700_000, *["z"] * 600]
    parts = list(slices.slices(iter([pa.RecordBatch.from_pydict({"c": texts})]), 0))
    assert [x for b in parts for x in b.column(0).to_pylist()] == texts and max(b.num_rows for b in parts) <= slices.ROWS
    assert max(sum(len(x or "") for x in b.column(0).to_pylist()) for b in parts) <= slices.BYTES


def test_joins_of_the_dedup_send_nothing_through_the_driver(spark):
    prefix = dedup.durable(spark.createDataFrame([(i, 10, 7, 2, 1, 1, i, 0) for i in range(2)], "sid long, n int, w long, df long, r int, m long, h long, salt int"))
    sets = dedup.durable(spark.createDataFrame([(i, list(range(10))) for i in range(2)], "sid long, s array<long>"))
    links = dedup.jaccard_links(sets, 8000, prefix.alias("x"), prefix.alias("y"))
    assert "Broadcast" not in links._jdf.queryExecution().executedPlan().toString() and [tuple(r) for r in links.collect()] == [(0, 1)]


def test_pairs_meet_only_where_enough_is_left_behind(spark):
    """Two sets of ten whose first shared token is the third of both can share eight at most; 0.8 asks for nine."""
    rows = [(s, 10, 7, 2, r, 1, s, 0) for s, r in ((0, 3), (1, 3))] + [(2, 10, 8, 2, 1, 1, 2, 0), (3, 10, 8, 2, 1, 1, 3, 0)]
    prefix = spark.createDataFrame(rows, "sid long, n int, w long, df long, r int, m long, h long, salt int")
    same = spark.createDataFrame([(i, list(range(10))) for i in range(4)], "sid long, s array<long>")
    assert [(r["a"], r["b"]) for r in dedup.jaccard_links(same, 8000, prefix.alias("x"), prefix.alias("y")).collect()] == [(2, 3)]


def test_routes_ask_from_one_worker_a_task(spark):
    docs = spark.createDataFrame([(i, f"# Sheet {i}\n\nHow much is {i} + {i} in all of this? We add the numbers.") for i in range(40)], "doc_id long, text string")
    assert optimized(routes.route_a(docs, scripted_model)).count("ArrowEvalPython") == 0


def test_extraction_writes_each_row_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(drivers, "durable", lambda *_: (_ for _ in ()).throw(AssertionError("a table between")))
    s = "The sum is found by adding all the terms one by one so that $x = 1$ and $y$ hold. " * 3
    rows = [("1", f"# T\n\n## Problem\n\nFind the number that is asked for below\n\n## Solution\n\n{s}"), ("2", "none")]
    jsonl.write(spark.createDataFrame(rows, "id string, text string"), f"{tmp_path}/in")
    for _ in range(2):  # a rerun replaces
        told = {(r["name"], r["n"]) for r in drivers.extract_stage(spark, f"{tmp_path}/in", f"{tmp_path}/out", "A").collect()}
        assert told == {("S1", 1), ("skipped", 1)}
    assert [r["id"] for r in spark.read.json(f"{tmp_path}/out/sft").collect()] == ["1"] and [r["text"] for r in spark.read.json(f"{tmp_path}/out/skipped").collect()] == ["none"]
    assert sorted(x.name for x in (tmp_path / "out").iterdir()) == ["sft", "skipped"]


def against_sql(spark, tmp_path, name: str, texts: list) -> tuple[list, list]:
    """The rows of a query over documents of these texts, and those of its SQL."""
    import duckdb
    import pyarrow.parquet as pq

    n = len(texts)
    pq.write_table(pa.table({"doc_id": pa.array(range(n), pa.int64()), "text": pa.array(texts, pa.string()), "lang": pa.array(["en"] * n), "source": pa.array(["s"] * n)}), f"{tmp_path}/documents.parquet")
    pq.write_table(pa.table({"doc_id": pa.array(range(0, n, 3), pa.int64()), "quality": pa.array([i % 2 for i in range(0, n, 3)], pa.int32())}), f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.execute(f"create view {table} as select * from '{tmp_path}/{table}.parquet'")
    return sorted(map(tuple, registry.QUERIES[name](spark, str(tmp_path)).collect()), key=str), sorted(con.sql(registry.ORACLE_SQL[name]).fetchall(), key=str)


def test_the_cold_start_of_texts_without_letters(spark, tmp_path):
    texts = [x for x in (None, "", " ", "12 34", "汉字", "a", "two words") for _ in range(7)]
    for name in ("cas_6_strategies", "snk5_txt36_cold_start_rejects"):
        got, stated = against_sql(spark, tmp_path, name, texts)
        assert got == stated, name


def test_counts_are_those_of_the_patterns(spark):
    """Blanks, digits, words and letters of every script, matches that end where a word goes on, nulls and empty arrays."""
    frame = "{0}cookie sum{0} 5{0}+{0}3 5:30{0}pm views{0}:{0}5 http://a{0}cookie \\a{0}1 + 2 {0}: {0}1:30 am s{0}n $1{0} $ 1+1{0}sum 5:30 pm{0}menu l{0}kes: 5 {0}5=1 [INS:{0}] likes:5{0}menu"
    chars = [c for c in map(chr, (*range(1, 0x250), *range(0x300, 0x400), 0x661, 0x1680, *range(0x2000, 0x2070), 0x212A, 0x24B6, 0x4E00, 0xFF11, 0x1F130, 0x1F600, 0x1D7CE))]
    rows = spark.createDataFrame([(frame.replace("{0}", c),) for c in ("", *chars)] + [(None,), ("",), ("likes:5x2:30 am",), ("\\cdot2 + 3",), ("5:30 pm12:45 am",), ("$$a$$$ b",)], "c string")
    n = rows.select(counts(F.col("c"), noise=p.NOISE, math=p.MATH).alias("n"), t.count(F.col("c"), p.NOISE).alias("a"), t.count(F.col("c"), p.MATH).alias("b"))
    assert n.filter("not (n.noise <=> a and n.math <=> b)").count() == 0
    lists = spark.createDataFrame([(["1 + 1", "x", "$a$ é=$b$"],), ([],), (["é 1=2"],)], "c array<string>")
    assert [r[0] for r in lists.select(counts_each(F.col("c"), p.MATH)).collect()] == [[1, 0, 2], [], [1]]


def test_the_cascade_tries_no_pattern_at_every_place(spark):
    docs = spark.createDataFrame([(1, "We compute $x$ and more of it. " * 60, 2.0)], "doc_id long, text string, score double")
    out = quality.quality_cascade(docs)
    assert "regexp_count" not in optimized(out) and out.columns == ["doc_id", "text", "score", "reason", "label"]
    assert optimized(out.filter("label = 'normal'")).count("ArrowEvalPython") == 1 and [r["label"] for r in out.filter("label = 'normal'").collect()] == ["normal"]


def test_chunks_try_no_pattern_at_every_place(spark):
    docs = spark.createDataFrame([(1, "We compute $x$ and more of it. " * 60), (2, "short"), (3, None)], "doc_id long, text string")
    assert "regexp_count" not in optimized(split.split_documents(docs)) + optimized(split.chunk_stats(docs))
    assert split.split_documents(docs).count() == 1 and split.chunk_stats(docs).first()[:3] == (1, 2, 1859)


def test_neighbours_make_their_tokens_once(spark, tmp_path):
    got, stated = against_sql(spark, tmp_path, "txt39_jaccard_of_neighbours", ["a b c", "b c d $x$", None, "", "B, c; \u4e00"] * 4)
    assert got == stated and len(got) == 19
    assert "lower(" not in optimized(registry.QUERIES["txt39_jaccard_of_neighbours"](spark, str(tmp_path)))


def test_a_displayed_answer_is_found_without_its_pattern(spark):
    """The first form of a rescued answer: what its pattern finds, which reads the rest of a text from every ``$$``."""
    forms = ["$$ x = 5 $$", "$$x$$.", "$$ x\n\t y $$ 。", "a $$ b $$ c $$", "$$ a $$ b $$ c", "$$", "$$$", "$$$$", "$$$$$", "$$ $$", "$$ x $$..", "$$ x $$\x1c.", "$$\x1cx\xa0$$ .", "$ x $$", "$$ x $", "$$=x$$", "", ".", "$$.$$.", "$$" + "y" * 119 + "$$", "$$" + "y" * 120 + "$$", "\U0001d7ce $$\U0001d7ce$$", "$$$ x $$$", None]
    rows = spark.createDataFrame([(x,) for x in (*forms, *(f"so {x}" for x in forms if x), *(f"{x} " for x in forms if x))], "c string")
    c = t.strip(F.col("c"))
    plain = t.strip(F.regexp_replace(F.regexp_extract(c, p.RESCUE[0][0].java, 1), r"(?U)\s+", " "))
    made = t.strip(F.regexp_replace(t._displayed(c), r"(?U)\s+", " "))
    assert rows.filter(F.coalesce(plain, F.lit("")) != F.coalesce(made, F.lit(""))).count() == 0 and rows.filter(made != "").count() > 20
    assert r"[\s\S]+?" not in optimized(rows.select(t.rescue_boxed(F.col("c")), t.clean_answer(F.col("c"))))
    long = spark.createDataFrame([("and$$$ " * 20_000 + "so 5.",), ("and$$$ " * 20_000 + "$$",)], "c string")
    assert [r[0] for r in long.select(t.rescue_boxed(F.col("c"))).collect()] == ["5", ""]


def test_cleaned_replies_are_those_of_the_sql(spark, tmp_path):
    texts = [x for x in ("a$$$ b$$$ c", "$$ x $$", "and $$ x\n y $$ .", "$$$$", "", None, "* $$a$$ *", "= 7 $$") for _ in range(13)]
    got, stated = against_sql(spark, tmp_path, "txt21_txt22_txt23_clean_replies", texts)
    assert got == stated and len(got) == len(texts)


def made_texts(spark, n: int = 4000):
    """Texts of what cleaning, paragraphs and marks look at, put together by chance."""
    import random

    r = random.Random(19)
    parts = ["\n", "\n\n", "\n\n\n", " ", "  ", "\t", "\r", "\x1c", "\x85", "\xa0", "https://a.b", "http://", "https:// x", "://", "Example", "STRATEGY", "big idea", "a", "b c", "é", "İ", "汉", "w" * 300, "v " * 200]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 24))) for _ in range(n)]
    return spark.createDataFrame([(x,) for x in (*texts, None, "", " \n", "definition " * 2000, "a\n\n" * 500 + "example")], "c string").repartition(4)


def plainly_clean(c):
    c = F.regexp_replace(F.replace(F.coalesce(c, F.lit("")), F.lit("\r"), F.lit("\n")), r"(?Ud)https?://\S+", " ")
    return t.strip(F.regexp_replace(F.regexp_replace(c, r"[ \t]+", " "), "\n{3,}", "\n\n"))


def test_patterns_wait_for_what_they_look_for(spark):
    rows = made_texts(spark)
    assert rows.filter(t.light_clean(F.col("c")) != plainly_clean(F.col("c"))).count() == 0
    assert rows.filter(~t.compress_blank(F.col("c")).eqNullSafe(F.regexp_replace("c", "\n{3,}", "\n\n"))).count() == 0
    assert optimized(rows.select(t.light_clean(F.col("c")).alias("x"))).count("CASE WHEN") == 3


def test_an_excerpt_is_cleaned_once(spark):
    """Paragraphs of a cleaned text are clean when joined; the plain form cleans them again, and measures what it has at every paragraph."""
    rows = made_texts(spark)
    blocks = F.filter(F.transform(F.split(plainly_clean(F.col("c")), r"(?U)\n\s*\n"), t.strip), lambda x: x != "")
    marked = F.filter(blocks, lambda x: F.exists(F.array(*map(F.lit, p.CONCEPT_MARK)), lambda w: F.contains(F.lower(x), w)))
    kept = F.aggregate(marked, F.lit(""), lambda acc, x: F.when(F.length(acc) >= 900, acc).otherwise(F.concat(acc, F.when(acc == "", "").otherwise("\n\n"), x)))
    plain = F.substring(plainly_clean(F.when(kept != "", kept).otherwise(F.array_join(F.slice(blocks, 1, 3), "\n\n"))), 1, 900)
    both = rows.select(plain.alias("plain"), t.concept_excerpt(F.col("c")).alias("made"))
    assert both.filter("not (plain <=> made)").count() == 0 and both.filter("length(made) = 900").count() > 200
    assert optimized(rows.select(t.concept_excerpt(F.col("c")).alias("x"))).count("https?://") == 1


def test_excerpts_are_those_of_the_sql(spark, tmp_path):
    texts = [x for x in ("An example\n\nof  two\t\tblanks https://a.b/c d", "x\n\n\n\ny\n \nz\r\r\rw", "Big idea " * 200, "", None, "plain\n\n" * 9) for _ in range(8)]
    got, stated = against_sql(spark, tmp_path, "txt20_tvf5_concept_excerpts", texts)
    assert got == stated and len(got) == 38


def test_last_lines_and_leaks_are_those_of_the_patterns(spark):
    rows = made_texts(spark).union(spark.createDataFrame([("a\r\n" * 3 + "b c",), ("x" * 1995 + "\r\na\nb\nc\nd\ne\nf\ng",), (("l" * 400 + "\n") * 9,), ("\n".join(map(str, range(900))),), ("Actual Session a prompt:\nuſer: x\nRESPONSE: y\nuser：z\n",), ("a!",), ("b。",), ("c\n",)], "c string"))
    lines = F.filter(F.transform(F.split("c", r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"), t.strip), lambda x: x != "")
    assert rows.filter(~t._last_lines(F.col("c")).eqNullSafe(F.when(F.size(lines) > 6, F.slice(lines, -6, 6)).otherwise(lines))).count() == 0
    assert rows.filter(~t._without_leaks(F.col("c")).eqNullSafe(t.sub(t.sub(F.col("c"), p.ROLE_LINE), p.SESSION_WORD))).count() == 0
    assert rows.filter(~t._ended(F.col("c")).eqNullSafe(F.when(F.col("c").rlike(r"[^。.!?]\z"), F.concat("c", F.lit("。"))).otherwise(F.col("c")))).count() == 0
