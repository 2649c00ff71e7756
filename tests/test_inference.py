"""Batched, concurrent and written-through model calls."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from lumenmill.operators import inference, routes
from lumenmill.plans import drivers, fixture
from lumenmill.sources import jsonl


class Slow:
    """Tells how many calls were open at once, and which batches came."""

    def __init__(self, many):
        self.lock, self.open, self.peak, self.seen = threading.Lock(), 0, 0, []
        if many:
            self.reply_many = self._many

    def _held(self, prompts):
        with self.lock:
            self.open += 1
            self.peak = max(self.peak, self.open)
            self.seen.append(prompts)
        time.sleep(0.02)
        with self.lock:
            self.open -= 1

    def __call__(self, prompt, max_tokens, temperature):
        self._held([prompt])
        if "bad" in prompt:
            raise ValueError("bad one")
        return f"{prompt}!{max_tokens}"

    def _many(self, prompts, max_tokens, temperature):
        self._held(prompts)
        if any("bad" in p for p in prompts):
            raise ValueError("bad one")
        return [TimeoutError("late") if "late" in p else f"{p}!{max_tokens}" for p in prompts]


@pytest.mark.parametrize("many", [False, True])
def test_calls_overlap_and_keep_their_order(many):
    slow = Slow(many)
    prompts = [None if k == 7 else "p" * (k * 37 % 50) + str(k) for k in range(100)]
    with inference.Client(lambda: slow, 9, 0.5, batch=8, in_flight=3) as client:
        got = client.replies(prompts)
    assert got == [(None, None) if p is None else (f"{p}!9", None) for p in prompts]
    assert slow.peak == 3 and max(map(len, slow.seen)) == (8 if many else 1)
    if many:  # batches of like lengths: their ranges don't overlap
        spans = sorted((min(map(len, b)), max(map(len, b))) for b in slow.seen)
        assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))


@pytest.mark.parametrize("many", [False, True])
def test_a_failure_is_its_own(many):
    prompts = [f"x{k}" for k in range(30)] + ["bad", "late" if many else "bad too"]
    with inference.Client(lambda: Slow(many), 1, 0.0, batch=32) as client:
        got = client.replies(prompts)
    assert got[:30] == [(f"x{k}!1", None) for k in range(30)] and got[30] == (None, "bad one") and got[31][0] is None and got[31][1] in ("late", "bad one")


def test_both_interfaces_give_the_same_rows(spark):
    rows = spark.range(300).withColumn("q", F.when(F.col("id") % 10 != 3, F.concat(F.lit("prompt "), F.col("id").cast("string")))).withColumn("_key_0", F.lit(1)).repartition(3)
    tables = [sorted((r["id"], r["r"]["text"], r["r"]["error"], r["_key_0"]) for r in inference.ask(rows, F.col("q"), "r", m, 240).collect()) for m in (fixture.scripted_model, fixture.in_batches(fixture.scripted_model))]
    assert tables[0] == tables[1] and {e for *_, e, _ in tables[0]} == {None, "no reply"} and all(t is None and e is None for i, t, e, _ in tables[0] if i % 10 == 3)


def model_of(folder, most):
    """Leaves a mark for every prompt asked; the process dies at the ``most``-th if ``<folder>/die`` is there."""

    def factory():
        import os
        import uuid

        def reply(prompt, max_tokens, temperature):
            with open(f"{folder}/asked-{uuid.uuid4().hex}", "w") as f:
                f.write(prompt)
            if os.path.exists(f"{folder}/die") and len(os.listdir(folder)) > most:
                os._exit(1)
            return fixture.scripted_model()(prompt, max_tokens, temperature)

        return reply

    return factory


def asked(folder):
    return sorted(f.read_text() for f in folder.glob("asked-*"))


def test_a_lost_job_costs_what_was_in_flight(spark, tmp_path):
    marks, log = tmp_path / "marks", f"file://{tmp_path}/log"
    marks.mkdir()
    (marks / "die").touch()
    rows = spark.range(200).withColumn("q", F.concat(F.lit("prompt "), (F.col("id") % 150).cast("string"))).repartition(2)
    model = inference.WriteThrough(model_of(f"{marks}", 60), log, every=8)
    with pytest.raises(Exception):
        inference.ask(rows, F.col("q"), "r", model)
    first = asked(marks)
    kept = model.known(rows).filter("error is null").count()
    assert 30 < kept <= len(first) < 150
    (marks / "die").unlink()
    got = inference.ask(rows, F.col("q"), "r", model).collect()
    plain = {r["q"]: r["r"] for r in inference.ask(rows, F.col("q"), "r", fixture.scripted_model).collect()}
    assert len(got) == 200 and all(r["r"] == plain[r["q"]] for r in got)
    assert len(asked(marks)) == len(first) + 150 - kept  # equal prompts are asked once, kept ones never again
    failed = sum(plain[q]["error"] is not None for q in plain)
    inference.ask(rows, F.col("q"), "r", model)
    assert len(asked(marks)) == len(first) + 150 - kept + failed  # what failed is asked again
    two = rows.limit(1).withColumn("n", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    inference.ask(two, F.lit("draw"), "r", model, temperature=0.7, sample=F.col("n"))
    assert asked(marks).count("draw") == 3
    assert inference.ask(rows.limit(0), F.col("q"), "r", model).collect() == []


def test_a_resumed_generation_asks_only_what_has_no_reply(spark, tmp_path):
    marks, source, out = tmp_path / "marks", f"{tmp_path}/classified", f"{tmp_path}/out"
    marks.mkdir()
    text = "# Sums of terms {k}\n\nA plain passage about the sums of numbers, number {k}, which is long enough to be used here."
    jsonl.write_routes(spark.createDataFrame([(f"d{k}", text.format(k=k), "A") for k in range(60)], "id string, text string, route string"), source, "route")
    whole = drivers.generate_stage(spark, source, f"{tmp_path}/whole", model_of(f"{marks}", 0), "A").collect()
    every = [q for q in asked(marks) if q != "Say yes."]
    for f in marks.iterdir():
        f.unlink()
    (marks / "die").touch()
    with pytest.raises(Exception):
        drivers.generate_stage(spark, source, out, model_of(f"{marks}", 100), "A")
    (marks / "die").unlink()
    before = len([q for q in asked(marks) if q != "Say yes."])
    again = drivers.generate_stage(spark, source, out, model_of(f"{marks}", 0), "A", resume=True).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, whole))
    kept = inference.WriteThrough(None, f"file://{out}/replies").known(spark.range(1)).count()
    assert kept == len(set(every)) and 60 < before < len(every)
    assert len(set(every)) <= len([q for q in asked(marks) if q != "Say yes."]) < len(every) + before  # the first step's replies were there
    read = lambda x: sorted(map(str, spark.read.json(f"{x}/raw/A").collect()))
    assert read(out) == read(f"{tmp_path}/whole")


def test_samples_are_drawn_each(spark):
    rows = spark.createDataFrame([(1, "q1"), (2, None)], "id long, question string")
    got = routes.samples(rows, F.col("question"), fixture.scripted_model)
    assert sorted((r["id"], r["sample"]) for r in got.filter("answer is not null").collect()) == [(1, 0), (1, 1), (1, 2)]
