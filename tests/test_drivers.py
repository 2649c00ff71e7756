"""Stages from files to files: bad and blank lines, reruns, resumed runs, limits, dry runs."""

import json

import pytest
from pyspark.sql import functions as F

from lumenmill.operators import sampling
from lumenmill.plans import drivers
from lumenmill.sources import jsonl, ledger, ordered, shared
from lumenmill.streaming import incremental

LONG = "We compute $a$, $b$ and $c$ with care. " * 30
SOLVED = "# T\n\n## Problem\n\nFind x such that $x + 2 = 4$ holds here.\n\n## Solution\n\n" + "We subtract $2$ from both sides and get $x$ alone. " * 18 + "Thus, the answer is $2$."


def lines(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(r if isinstance(r, str) else json.dumps(r) + "\n" for r in rows), encoding="utf-8")
    return str(path)


def doc(i, text, score=2.0):
    return {"id": i, "text": text, "metadata": {"nemocurator_scores": score}, "extra": 1}


def counts(report):
    return {r["name"]: r["n"] for r in report.collect()}


def rows(spark, path, schema="id string, text string, filter_reason string"):
    return spark.read.schema(schema).json(str(path))


@pytest.fixture
def raw(tmp_path):
    big = "\n\n".join(f"## Part {k}\n\n{LONG}" for k in range(60))
    return lines(tmp_path / "raw.jsonl", [doc("a", LONG), "\n", "   \n", "{bad\n", doc("b", "short"), doc("c", LONG, 1.0), doc("é", SOLVED), doc("big", big), '{"id": "d"}\n', "[1\n"])


def test_filter_counts_bad_lines_apart(spark, raw, tmp_path):
    for _ in range(2):  # a rerun replaces what it wrote
        got = counts(drivers.filter_stage(spark, raw, f"{tmp_path}/f"))
        assert got == {"total": 6, "normal": 2, "long": 1, "discard": 5, "reason:too_short": 2, "reason:low_nemo": 1}
        kept = rows(spark, tmp_path / "f")
        assert sorted((r["id"], r["label"]) for r in kept.select("id", "label").collect()) == [("a", "normal"), ("b", "discard"), ("big", "long"), ("c", "discard"), ("d", "discard"), ("é", "normal")]
    assert kept.filter("id = 'c'").first()["filter_reason"] == "low_nemo(1.00)"


def test_curate_and_extract(spark, raw, tmp_path):
    got = {(r["stage"], r["name"]): r["n"] for r in drivers.curate(spark, raw, str(tmp_path)).collect()}
    chunks = jsonl.read(spark, f"{tmp_path}/chunks", drivers.CHUNK, "strict").collect()
    assert len(chunks) == 60 and chunks[0]["metadata"]["source_doc_id"] == "big" and {c["metadata"]["chunk_total"] for c in chunks} == {60}
    assert got["clean", "clean"] == 62 and got["classify", "A:rule"] == 1
    report = counts(drivers.extract_stage(spark, f"{tmp_path}/classified/route=A", f"{tmp_path}/x", "A"))
    sft = spark.read.json(f"{tmp_path}/x/sft").collect()
    assert report["S1"] == 1 and any(r["source_id"] == "é" and r["messages"][0]["content"] == drivers.EXTRACTED_SYSTEM and r["messages"][1]["content"].startswith("Find x") for r in sft)
    assert sum(report.values()) == sum(n for (stage, name), n in got.items() if stage == "classify" and name.startswith("A"))


def test_strict_and_dropping_scans(spark, raw):
    with pytest.raises(Exception):  # noqa: B017 - the engine's own
        jsonl.read(spark, raw, mode="strict").collect()
    assert jsonl.read(spark, [raw, raw], mode="drop").select("id", "text").count() == 12
    bad = jsonl.read(spark, raw).filter("_corrupt is not null")
    assert sorted(r["_corrupt"] for r in bad.collect()) == ["[1", "{bad"]


def model():
    replies = {600: "We add the numbers of both sides.\nThe sum is then known.\n\n\\boxed{4}", 160: "What is the sum here?", 180: "1. What does the lesson say on ratios?\n2. Which ratio is greater here?", 1500: "We add. We check. " * 12, 4: "yes"}

    def reply(prompt, max_tokens, temperature):
        if "broken" in prompt:
            raise OSError("down")
        return replies[max_tokens]

    return reply


def classified(spark, path, texts):
    data = [(f"{label}{i}", f"# {label} text {i}\n\nA plain passage number {i} of class {label} about sums, {'broken' if (label, i) in broken else 'long'} enough to use.", label) for label, n, broken in texts for i in range(n)]
    jsonl.write_routes(spark.createDataFrame(data, "id string, text string, route string"), path, "route")


def test_generation_resumes_and_merges(spark, tmp_path):
    source, out = f"{tmp_path}/classified", f"{tmp_path}/g"
    classified(spark, source, [("A", 3, {("A", 2)}), ("B", 2, set()), ("C", 2, set())])
    drivers.generate_stage(spark, source, out, model, "ABC", limit=2)
    ids = lambda tag: sorted(r["source_id"].split("::")[0] for r in jsonl.read(spark, f"{out}/raw/{tag}", drivers.AUDIT, "drop").select("source_id").distinct().collect())
    assert ids("AB") == ["A0", "A1"]
    for _ in range(2):  # the second resumed run finds only the document that failed
        drivers.generate_stage(spark, source, out, model, "ABC", resume=True)
        assert ids("AB") == ["A0", "A1", "B0", "B1"] and jsonl.read(spark, f"{out}/raw/AB", drivers.AUDIT, "drop").count() == 4
    report = counts(drivers.merge_stage(spark, out, ["AB", "C", "none"]))
    final = spark.read.json(f"{out}/final")
    assert final.columns == ["messages"] and final.count() == sum(report[x] for x in "AB" if x in report) < report["read"]
    drivers.generate_stage(spark, source, out, model, "B")
    assert ids("B") == ["B0", "B1"]
    drivers.generate_stage(spark, source, out, model, "B")
    assert jsonl.read(spark, f"{out}/raw/B", drivers.AUDIT, "drop").count() == 2  # a plain rerun replaces


def test_preflight_stops_before_any_work(spark, tmp_path):
    def down():
        raise OSError("no server")

    with pytest.raises(RuntimeError, match="no server"):
        drivers.generate_stage(spark, f"{tmp_path}/none", f"{tmp_path}/g", down)
    assert not jsonl.exists(spark, f"{tmp_path}/g")


def test_quota_gives_route_b_first(spark):
    docs = spark.createDataFrame([(f"{i:02d}", "B" if i % 4 == 0 else "A") for i in range(20)], "id string, route string")
    got = [(r["route"], r["id"]) for r in drivers.quota(docs, 7).collect()]
    assert sorted(got) == [("A", "01"), ("A", "02"), *(("B", f"{i:02d}") for i in range(0, 20, 4))]
    assert drivers.quota(docs, 3).filter("route = 'A'").count() == 0 and drivers.quota(docs, None).count() == 20


def test_cold_start_files(spark, tmp_path):
    source = f"{tmp_path}/classified"
    data = [("a1", SOLVED, "A"), ("a2", SOLVED, "A"), ("b1", "nothing", "B"), ("c1", SOLVED, "C"), ("d1", "nothing", "D")]
    jsonl.write_routes(spark.createDataFrame(data, "id string, text string, route string"), source, "route")
    dry = drivers.cold_start_stage(spark, source, f"{tmp_path}/cold", dry_run=True)
    assert sorted((r["id"], r["filter_reason"]) for r in dry.collect()) == [("b1", "no_extraction"), ("d1", "no_extraction")] and not jsonl.exists(spark, f"{tmp_path}/cold")
    assert counts(drivers.cold_start_stage(spark, source, f"{tmp_path}/cold")) == {"A:S1": 1}
    assert spark.read.json(f"{tmp_path}/cold/final").count() == spark.read.json(f"{tmp_path}/cold/A/audit").count() == 1
    assert not jsonl.exists(spark, f"{tmp_path}/cold/C") and spark.read.json(f"{tmp_path}/cold/A/sft").columns == ["messages"]
    assert counts(drivers.cold_start_stage(spark, source, f"{tmp_path}/cold2", "C", limit=1)) == {"C:S1": 1}


def test_workshop_files(spark, tmp_path):
    lines(tmp_path / "in" / "one_problem.jsonl", [{"question": "q1", "solution": "s", "answer": "4", "source_index": "x"}, '{"question":"q2","solution":"s","answer":"5","source_index": ab-12}\n', "{bad\n", "\n", {"question": "", "solution": "s", "answer": "6"}])
    lines(tmp_path / "in" / "two_problem.jsonl", [{"question": "q3", "solution": None}])
    lines(tmp_path / "in" / "empty_problem.jsonl", [])
    lines(tmp_path / "in" / "other.jsonl", [{"question": "no"}])
    assert counts(drivers.convert_workshop(spark, f"{tmp_path}/in", f"{tmp_path}/out")) == {"one_sft": 2, "two_sft": 1}
    got = spark.read.json(f"{tmp_path}/out/file=one_sft").select(F.col("messages")[1]["content"].alias("q"), F.col("messages")[2]["content"].alias("a")).collect()
    assert sorted((r["q"], r["a"]) for r in got) == [("q1", "<think>\ns\n</think>\n\\boxed{4}"), ("q2", "<think>\ns\n</think>\n\\boxed{5}")]


def test_append_and_stream_add_nothing_twice(spark, tmp_path):
    some = spark.createDataFrame([("a", 1), ("b", 2)], "id string, x int")
    for _ in range(2):
        ledger.append_new(some, f"{tmp_path}/sink", "id")
    assert spark.read.json(f"{tmp_path}/sink").count() == 2
    stage = lambda df: df.filter("text <> ''")
    run = lambda: incremental.run_stage(spark, f"{tmp_path}/in", "id string, text string", stage, f"{tmp_path}/out", f"{tmp_path}/check", "id").awaitTermination()
    for name, data in (("1", [("a", "x"), ("b", "")]), (None, None), ("2", [("a", "x"), ("c", "y")])):
        if name:
            lines(tmp_path / "in" / f"{name}.json", [{"id": i, "text": t} for i, t in data])
        run()
    assert sorted(r["id"] for r in spark.read.schema("id string").json(f"{tmp_path}/out/batch=*").collect()) == ["a", "c"]


def test_a_replayed_batch_loses_and_doubles_nothing(spark, tmp_path):
    stage = lambda df: df.select("id")
    run = lambda: incremental.run_stage(spark, f"{tmp_path}/in", "id long", stage, f"{tmp_path}/out", f"{tmp_path}/check", "id").awaitTermination()
    got = lambda: sorted((r["id"] or 0) for r in spark.read.schema("id long").json(f"{tmp_path}/out/batch=*").collect())
    for k, ids in enumerate(([1, None], [1, 2, 3, None])):
        lines(tmp_path / "in" / f"{k}.json", [{"id": i} for i in ids])
        run()
    assert got() == [0, 1, 2, 3]
    for lost in ("1", "0"):  # the last commit, then what looks like a first batch that never ended
        for f in (tmp_path / "check" / "commits").iterdir():
            if f.name.strip(".").removesuffix(".crc") >= lost:
                f.unlink()
        run()
        assert got() == [0, 1, 2, 3]


def test_appends_end_once_wherever_they_are_lost(spark, tmp_path):
    sink, table = f"{tmp_path}/sink", lambda *ids: spark.createDataFrame([(i, f"x{i}") for i in ids], "id string, x string")
    got = lambda: sorted(r["id"] or "" for r in spark.read.schema("id string").json(sink).collect())
    table("old", None).write.json(sink)  # an output that no ledger knows
    ledger.append_new(table("old", None, "a"), sink, "id")
    assert got() == ["", "a", "old"]
    book = ledger.Ledger(spark, sink)
    assert book.ended() == 2
    table("b").write.json(book.at(2, "rows"))  # lost before it was ready
    ledger.append_new(table("a", "c", "c"), sink, "id")
    assert got() == ["", "a", "c", "c", "old"]
    for f in (tmp_path / "sink").glob("*append-000002-*"):  # ready, and lost before its files were moved
        f.rename(tmp_path / "sink" / "_ledger" / "n=2" / "rows" / f.name.replace("append-000002-", ""))
    (tmp_path / "sink" / "_ledger" / "n=2" / "_DONE").unlink()
    assert got() == ["", "a", "old"]
    for _ in range(2):
        ledger.append_new(table("c", "d"), sink, "id")
    assert got() == ["", "a", "c", "c", "d", "old"]
    ledger.append_new(table().limit(0), sink, "id")
    assert len(got()) == 6


def test_new_keys_read_no_history(spark, tmp_path):
    """Rows and digests of earlier appends are made unreadable: filters alone answer for new keys."""
    sink = tmp_path / "sink"
    ledger.append_new(spark.range(500).selectExpr("cast(id as string) as id"), f"{sink}", "id")
    for f in [*sink.glob("append-*"), *sink.glob("_ledger/n=0/digests/part-*")]:
        f.write_bytes(b"{broken")
    for f in [*sink.glob(".*.crc"), *sink.glob("_ledger/n=0/digests/.*.crc")]:
        f.unlink()
    ledger.append_new(spark.createDataFrame([("n",)], "id string"), f"{sink}", "id")
    assert spark.read.json(f"{sink}").filter("id = 'n'").count() == 1
    digests = spark.range(20000).selectExpr("substring(unhex(sha2(cast(id as string), 256)), 1, 16) as digest")
    kept = ledger.filters(digests.filter("hex(digest) < '8'"))
    assert ledger.passing(digests.filter("hex(digest) < '8'"), kept).count() == digests.filter("hex(digest) < '8'").count()
    assert ledger.passing(digests.filter("hex(digest) >= '8'"), ledger.filters(digests.filter("hex(digest) >= '8'").limit(0))).count() == 0
    odd = digests.filter("substring(hex(digest), 32, 1) in ('0', '1', '2', '3', '4', '5', '6', '7')")
    assert ledger.passing(digests.exceptAll(odd), ledger.filters(odd)).count() < 300


def test_a_workspace_is_shared_or_local(spark):
    path = shared.workspace(spark, "test")
    assert path.startswith("file:///")
    rows_ = shared.staged(spark.range(3).toDF("x"), f"{path}/x")
    assert rows_.count() == 3 and shared.durable(rows_).count() == 3


def test_acceptance_by_route(spark):
    from lumenmill.operators import routes

    docs = spark.createDataFrame([(1, "# Sums\n\nA plain passage about sums of numbers, long enough to use.")], "doc_id long, text string")
    got = sampling.acceptance(routes.route_a(docs, model)).first()
    assert (got["n_rows"], got["kept"], got["thinking"], got["boxed"], got["leaks"], got["system_texts"]) == (1, 1, 1, 1, 0, 0)


def test_lines_in_the_order_of_sorted_files(spark, tmp_path):
    """Files that are read in several splits each, empty ones, blank and bad lines, names with spaces: as reading them one after the other."""
    want, folder = [], tmp_path / "in"
    for name, n in (("b 2.jsonl", 400), ("a+1.jsonl", 3), ("c.jsonl", 0), ("b 10.jsonl", 150), ("d.jsonl", 1)):
        lines(folder / name, ["\n" if k % 50 == 9 else "{bad\n" if k % 50 == 10 else {"id": f"{name}-{k}", "text": "x" * (k % 90)} for k in range(n)])
    k = 0
    for f in sorted(folder.iterdir()):
        for line in f.read_text().splitlines():
            if line.strip():
                want.append((k, f.name, None if line == "{bad" else json.loads(line)["id"]))
            k += 1
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size, cost in (("3000", "10"), ("128m", "4m")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", cost)
            got = ordered.read(spark, f"{folder}", "id STRING, text STRING", "tolerant")
            assert sorted((r["ord"], r["file"], r["id"]) for r in got.collect()) == want
            assert got.rdd.getNumPartitions() > 5 or size == "128m"
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert ordered.read(spark, f"{folder}", "id STRING").count() == sum(i is not None for *_, i in want)
    with pytest.raises(Exception):  # noqa: B017 - the engine's own
        ordered.read(spark, f"{folder}", "id STRING", "strict").collect()
    assert ordered.lines(spark, f"{folder}/c.jsonl").count() == 0


def test_every_line_is_in_one_place(spark, tmp_path):
    good = {"question": "q", "solution": "s", "answer": "4", "source_index": "x"}
    rows_ = [good, "\n", '{"question":"q2","solution":"s","answer":"5","source_index": ab-12}\n', '\ufeff{"question":"q3"}\n', '{"question":"q4",}\n', '{"question":"q5"\n', "[1, 2]\n", "{x}\n", "   \n"]
    lines(tmp_path / "in" / "a.jsonl", rows_)
    lines(tmp_path / "in" / "b.jsonl", [good])
    got = counts(drivers.intake_stage(spark, f"{tmp_path}/in", f"{tmp_path}/out", jsonl.WORKSHOP))
    assert got == {"rows": 2, "repaired": 3, "malformed": 3, "blank": 2, "repair:byte order mark": 1, "repair:bare source_index": 1, "repair:comma before the end": 1, "cause:cut off": 1, "cause:no object": 1, "cause:no JSON of the schema": 1}
    out = spark.read.schema("file STRING, ord LONG, route STRING, question STRING, source_index STRING, line STRING, cause STRING").json(f"{tmp_path}/out").orderBy("ord").collect()
    assert [r["ord"] for r in out] == list(range(10)) and [r["file"] for r in out] == ["a.jsonl"] * 9 + ["b.jsonl"]
    assert [r["question"] for r in out] == ["q", None, "q2", "q3", "q4", None, None, None, None, "q"] and out[2]["source_index"] == "ab-12"
    assert [r["line"] for r in out if r["route"] == "malformed"] == ['{"question":"q5"', "[1, 2]", "{x}"]


def test_reports_come_from_the_pass_that_writes(spark, raw, tmp_path):
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("report", "report")
    drivers.filter_stage(spark, raw, f"{tmp_path}/f").collect()
    drivers.clean_stage(spark, [f"{tmp_path}/f/label=normal"], f"{tmp_path}/c").collect()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs.getJobIdsForGroup("report")) <= 4


def test_class_outputs_are_merged_in_their_order(spark, tmp_path):
    row = lambda p, a: {"messages": [{"role": "system", "content": ""}, {"role": "user", "content": p}, {"role": "assistant", "content": a}]}
    one, two = "find the sum of two and two here", "find the product of nine and ten at once"
    lines(tmp_path / "B" / "sft" / "part-1.json", [row(two, "B1"), "\n", row(one, "B2")])
    lines(tmp_path / "A" / "sft" / "part-2.json", [row(one, "A3")])
    lines(tmp_path / "A" / "sft" / "part-1.json", [row(one, "A1"), row("something else that is asked here", "A2")])
    lines(tmp_path / "A" / "sft" / "part-0.json", [])
    assert counts(drivers.merge_cold_start(spark, f"{tmp_path}", "DBCA")) == {"A": 3, "B": 2, "kept": 3}
    assert sorted(r["messages"][2]["content"] for r in spark.read.json(f"{tmp_path}/final").collect()) == ["A1", "A2", "B1"]
    assert drivers.merge_cold_start(spark, f"{tmp_path}/none").count() == 0 and not jsonl.exists(spark, f"{tmp_path}/none")


def test_curated_rows_are_those_of_documents_that_were_not_split(spark, tmp_path):
    """A long document is curated in chunks, which are no rows of the query: its SQL states whole documents."""
    from lumenmill.plans import file_queries

    line = "We compute $x + 1$ and the integral with some care.\n"
    rows = [(8, line * 40), (16, line * 1200)]
    spark.createDataFrame([(k, "en", x) for k, x in rows], "doc_id long, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(8, 1), (16, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = file_queries.drv1_rel1_filter_clean_classify(spark, str(tmp_path)).collect()
    assert [(r["id"], r["route"]) for r in got] == [("8", "A")]
