import pytest
from pyspark.sql import functions as F

from lumenmill.functions import text as t
from lumenmill.operators import coldstart, extract, gates, routes, split
from lumenmill.sources.layout import spread


def col(spark, values, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r["y"] for r in df.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


def test_flags(spark):
    long = "We add both sides.\nThen the sum is 4 and we are done with it.\n\n\\boxed{4}"
    q = "What is the sum of two and two here?"
    got = col(spark, [long, "Request: x", "What is the sum of two and two here", "\\boxed{", None], lambda c: gates.answer_flags(F.lit(q), c))
    assert got == [[], ["missing_boxed", "prompt_leak", "too_short", "thin_reasoning"], ["missing_boxed", "too_short", "thin_reasoning", "question_copied"], ["too_short", "thin_reasoning"], ["missing_boxed", "too_short", "thin_reasoning"]]
    got = col(spark, ["a. " * 80, "x" * 7001, "User: hi", None], gates.reasoning_flags)
    assert got == [[], ["reasoning_too_thin", "reasoning_too_long"], ["reasoning_too_short", "reasoning_prompt_leak", "reasoning_too_thin"], ["reasoning_too_short", "reasoning_too_thin"]]
    assert col(spark, ["y" * 60 + ". a\n", "z" * 80 + "."], lambda c: gates.answer_flags(F.lit("q"), c, 80, 2)) == [["missing_boxed", "too_short"], ["missing_boxed", "thin_reasoning"]]
    assert col(spark, ["groundedness=3 reasoning=3 format=4", "groundedness=5 reasoning=5 format=3"], lambda c: gates.judged_good(t.parse_judge(c))) == [True, False]
    assert col(spark, ["What is $x$ now?", "is $x$ = 4?", "a \\boxed{1}?", "What?"], gates.question_rejected) == [True, True, True, False]


def test_questions(spark):
    ask = lambda c: t.explicit_question(c, F.lit("Is this a title?"))
    texts = ["**Question:** What is a ratio of two numbers?\nmore", "Intro\nWhere does the line cross zero?\nend", "The area is 4 cm?", "", None]
    assert col(spark, texts, ask) == ["What is a ratio of two numbers?", "Where does the line cross zero?", "Is this a title?", "Is this a title?", "Is this a title?"]
    assert col(spark, ["no question"], lambda c: t.explicit_question(c, F.lit("title"))) == [""]
    lists = ["1. What is a ratio?\n2) Compute 3:4 of 28.\n- short\n3. What is a ratio?", "", None]
    assert col(spark, lists, t.parse_questions) == [["What is a ratio?", "Compute 3:4 of 28?"], [], []]


def test_units(spark):
    blocks = ["a\n## Problem Statement\nx?\n## Solution\ny\n## Next\nz", "A Question about x?", "nothing", None]
    assert col(spark, blocks, t.problem_unit) == ["## Problem Statement\nx?\n## Solution\ny", "A Question about x?", "", ""]
    assert col(spark, ["a\n\nDefinition: b\n\nc", "a\n\nb\n\nc\n\nd", None], t.concept_excerpt) == ["Definition: b", "a\n\nb\n\nc", ""]


@pytest.mark.parametrize(
    ("reply", "answer"),
    [
        ("<think>no</think>We add.\nUser: x\n\\boxed{1} so \\boxed{ 2 }", "We add.\n\n so。\n\n\\boxed{2}"),
        ("It holds.\n## Question 2\nmore", "It holds."),
        ("Thus $$ x = 5 $$", "Thus $$ x = 5 $$。\n\n\\boxed{x = 5}"),
        ("So x = 5.", "So x = 5.\n\n\\boxed{5}"),
        ("The sum is 133,320.", "The sum is 133,320.\n\n\\boxed{133,320}"),
        ("That makes **9.8 m/s**.", "That makes **9.8 m/s**.\n\n\\boxed{9.8 m/s}"),
        ("We get $ab$.", "We get $ab$.\n\n\\boxed{ab}"),
        ("The answer is blue or so", "The answer is blue or so。\n\n\\boxed{blue or so}"),
        ("There are, in all 12", "There are, in all 12。\n\n\\boxed{12}"),
        ("no answer", "no answer"),
        (None, ""),
    ],
)
def test_clean_answer(spark, reply, answer):
    assert col(spark, [reply], t.clean_answer) == [answer]


def test_reasoning_and_judge(spark):
    assert col(spark, ["<think>a\nanswer: b\n\n\n\nc \\boxed{1}</think>"], t.clean_reasoning) == ["a\n\nc"]
    got = col(spark, ["groundedness=4 format = 9\nkeep=YES\nreason=fine", None], t.parse_judge)
    assert tuple(got[0]) == (4, 1, 1, 1, True, "fine") and tuple(got[1])[:5] == (1, 1, 1, 1, False)


def model():
    calls = {600: "We add the numbers of both sides.\nThe sum is then known.\n\n\\boxed{4}", 160: "What is the sum here?", 180: "", 1500: "We add. We check. " * 12}

    def reply(prompt, max_tokens, temperature):
        if "broken" in prompt:
            raise OSError("down")
        return calls[max_tokens]

    return reply


def test_routes_and_merge(spark):
    text = "# Sums\n\nA plain passage about sums of numbers, long enough to use."
    docs = spark.createDataFrame([(1, text), (2, text.replace("plain", "broken")), (3, "short"), (4, None), (5, text)], "doc_id long, text string")
    a = routes.route_a(docs, model)
    rows = {r["source_id"]: r for r in a.collect()}
    assert sorted(rows) == ["1", "5"]
    assert rows["1"]["quality"]["keep"] and rows["1"]["messages"][2]["content"].startswith("<think>We add.") and rows["1"]["quality"]["score"] == 0
    b = routes.route_b(docs, model)
    asked = [r["messages"][1]["content"] for r in b.filter("source_id like '1::%'").collect()]
    assert sorted(asked) == ["How would you explain Sums with one short worked example?", "What is the key idea behind Sums?"]
    kept = [(r["route"], r["source_id"].split("::")[0]) for r in routes.merged(a.unionByName(b)).collect()]
    assert sorted(kept) == [("A", "1"), ("B", "1"), ("B", "1")]


def test_cold_start(spark):
    body = "We subtract $2$ from both sides and get $x$ alone. " * 5 + "Thus, the answer is $2$."
    text = f"# T\n\n## Problem\n\nFind x such that $x + 2 = 4$ holds here.\n\n## Solution\n\n{body}"
    assert extract.extract_one(text, "A", cold_start=True)[0] == "S1"
    docs = spark.createDataFrame([(1, "A", text), (2, "C", text), (3, "B", "nothing"), (4, "A", None)], "doc_id long, label string, text string")
    got = coldstart.cold_start(docs).collect()
    assert [(r["source_id"], r["boxed_injected"], r["boxed_count"]) for r in got] == [("1", True, 1)]
    dry = coldstart.rejects(coldstart.gated_pairs(docs)).collect()
    assert sorted((r["id"], r["filter_reason"]) for r in dry) == [("3", "no_extraction"), ("4", "no_extraction")]


def test_extraction_orders():
    lead = "# Ratios of numbers\n\nA ratio compares $a$ and $b$ in a fixed order.\n\n"
    steps = "We divide $a$ by $b$ and simplify. " * 5
    # a class D title is looked for wherever the first heading stands; a theorem's section runs to the next heading of its level
    d = f"# Theorem 1.2 Reduction\n\nEvery ratio $a/b$ can be reduced.\n\n# Proof\n\n{steps}"
    assert extract.theorem_proof(extract.Doc(d), "D")[0] == "State and prove the following theorem:\n\n**Theorem 1.2 Reduction**: Every ratio $a/b$ can be reduced."
    assert extract.theorem_proof(extract.Doc(d), "C")[0] == "Theorem\n\nEvery ratio $a/b$ can be reduced."
    got = extract.example_headings(extract.Doc(f"{lead}## Example 1: reduce\n\n{steps}"), "C")
    assert got[0] == "Ratios of numbers\n\nA ratio compares $a$ and $b$ in a fixed order."
    assert extract.solution_only(extract.Doc("## Problem\n\n## Solution\n\nx")) is None


def test_spread_deals_out_small_tables(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(f"{tmp_path}/one")
    spark.range(100).repartition(8).write.parquet(f"{tmp_path}/many")
    one, many = (spread(spark.read.parquet(f"{tmp_path}/{x}")) for x in ("one", "many"))
    sizes = [r["n"] for r in one.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 100 and len(sizes) == spark.sparkContext.defaultParallelism
    assert "RoundRobin" not in many._jdf.queryExecution().toString() and many.count() == 100


def test_question_splits(spark):
    texts = ["lead\n## Problem 1\na\n## Solution\nb\n## Problem 2\nc\n### Question\nd", "## Problem\nx", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [(r["doc_id"], r["qa_index"], r["text"]) for r in split.split_questions(docs).orderBy("doc_id", "qa_index").collect()]
    assert got == [(0, 0, "## Problem 1\na\n## Solution\nb\n"), (0, 1, "## Problem 2\nc\n"), (0, 2, "### Question\nd"), (1, 0, "## Problem\nx"), (2, 0, ""), (3, 0, None)]
    assert split.first_pairs(split.split_questions(docs), "doc_id", "qa_index").count() == 5
