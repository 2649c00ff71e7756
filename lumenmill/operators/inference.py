"""Calls of a chat model from tasks: in batches of like lengths, several in flight, and written through (LLM1, LLM2, LLM11, TVF6).

A model is a factory, called once in a task. What it gives is asked by ``reply(prompt, max_tokens, temperature) -> str``, or, if it has one,
by ``reply_many(prompts, max_tokens, temperature)``, which returns a text or an exception for each prompt. A task sorts up to ``ROWS`` prompts of an Arrow batch by length,
parts them in batches of ``BATCH`` and keeps ``IN_FLIGHT`` calls open from as many threads, so a client must bear that many at once; replies come back in the order of the rows.
A batch that fails as a whole is asked again in halves, down to the prompt that fails, so a failure belongs to its row alone.

With :class:`WriteThrough` every ``every`` replies of a task are a file in shared storage as soon as they are there, under the digest of prompt, limits and sample. A task that runs again,
and a job that is started again, ask only what no file answers; failed prompts are asked again by the next job. Equal prompts are asked once."""

from __future__ import annotations

import json
import uuid
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import jsonl
from ..sources.shared import durable, workers_find_package
from .names import fresh

Model = Callable[[], Callable[[str, int, float], str]]
BATCH, IN_FLIGHT = 32, 4
ROWS = 1024  # prompts of an Arrow batch that are Python strings at once, where replies are not written through
REPLY = "struct<text: string, error: string>"
LOG = "key STRING, text STRING, error STRING"


class Client:
    """One task's way to its model. ``replies`` gives (text, error) in the order of the prompts, null for a null prompt."""

    def __init__(self, model: Model, max_tokens: int, temperature: float, batch: int = BATCH, in_flight: int = IN_FLIGHT):
        self.reply, self.limits = model(), (max_tokens, temperature)
        self.many = getattr(self.reply, "reply_many", None)
        self.batch, self.window = batch if self.many else 1, in_flight
        self.pool = ThreadPoolExecutor(in_flight)

    def __enter__(self) -> Client:
        return self

    def __exit__(self, *_) -> None:
        self.pool.shutdown(cancel_futures=True)

    def _ask(self, prompts: list[str]) -> list[tuple[str | None, str | None]]:
        try:
            if self.many:
                got = list(self.many(prompts, *self.limits))
                if len(got) != len(prompts):
                    raise ValueError(f"{len(got)} replies to {len(prompts)} prompts")
            else:
                got = [self.reply(prompts[0], *self.limits)]
        except Exception as e:  # noqa: BLE001 - a server's failure belongs to its row
            if len(prompts) == 1:
                return [(None, str(e))]
            half = len(prompts) // 2
            return self._ask(prompts[:half]) + self._ask(prompts[half:])
        return [(None, str(x)) if isinstance(x, BaseException) else (x, None) for x in got]

    def batches(self, prompts: list[str | None]) -> Iterator[tuple[list[int], list[tuple[str | None, str | None]]]]:
        """(places, replies) of each batch, shortest prompts first; no more than the window is open."""
        order = sorted((i for i, p in enumerate(prompts) if p is not None), key=lambda i: len(prompts[i]))
        open_: deque = deque()
        for lo in range(0, len(order), self.batch):
            if len(open_) == self.window:
                places, future = open_.popleft()
                yield places, future.result()
            places = order[lo : lo + self.batch]
            open_.append((places, self.pool.submit(self._ask, [prompts[i] for i in places])))
        for places, future in open_:
            yield places, future.result()

    def replies(self, prompts: list[str | None]) -> list[tuple[str | None, str | None]]:
        out: list[tuple[str | None, str | None]] = [(None, None)] * len(prompts)
        for places, got in self.batches(prompts):
            for i, x in zip(places, got, strict=True):
                out[i] = x
        return out


class WriteThrough:
    """A model whose replies are kept under ``folder``, a place that all executors share."""

    def __init__(self, model: Model, folder: str, every: int = 256):
        self.model, self.folder, self.every = model, folder, every

    def known(self, rows: DataFrame) -> DataFrame:
        """(key, text, error) of all that has been asked, a row for each prompt: its reply where it has one."""
        spark = rows.sparkSession
        jobs = jsonl.folders(spark, self.folder)  # by name: a plan takes two scans of one path for the same, though files have come between
        if not jobs:
            return spark.createDataFrame([], LOG)
        log = spark.read.schema(LOG).option("mode", "DROPMALFORMED").option("recursiveFileLookup", "true").json(jobs)
        found = log.groupBy("key").agg(F.min(F.when(F.col("error").isNull(), F.struct("text"))).alias("t"), F.min("error").alias("e"))
        return found.select("key", F.col("t.text").alias("text"), F.when(F.col("t").isNull(), F.col("e")).alias("error"))

    def answered(self, rows: DataFrame, key: Column, question: Column, max_tokens: int, temperature: float, batch: int, in_flight: int) -> DataFrame:
        """Asks what has no reply, now, and returns :meth:`known`."""
        spark, model, every = rows.sparkSession, self.model, self.every
        asked = rows.select(key.alias("key"), question.alias("prompt")).filter("prompt is not null").dropDuplicates(["key"])
        open_ = durable(asked.join(self.known(rows).filter("error is null").select("key"), "key", "left_anti"), "prompts")
        folder = f"{self.folder}/{uuid.uuid4().hex}"
        workers_find_package(spark)

        def run(batches):
            from pyarrow import fs

            system, root = fs.FileSystem.from_uri(folder)
            root = f"{root}/{TaskContext.get().partitionId():06d}"
            done: set[str] = set()  # of an earlier attempt at this task
            for info in system.get_file_info(fs.FileSelector(root, allow_not_found=True)):
                if not info.base_name.startswith("_"):
                    with system.open_input_file(info.path) as f:
                        done.update(json.loads(line)["key"] for line in f.read().splitlines())

            def put(rows: list[dict]) -> None:
                system.create_dir(root, recursive=True)
                name = uuid.uuid4().hex
                with system.open_output_stream(f"{root}/_{name}.json") as out:
                    out.write("".join(json.dumps(r) + "\n" for r in rows).encode())
                system.move(f"{root}/_{name}.json", f"{root}/{name}.json")  # readers skip a file until it is whole

            n = 0
            with Client(model, max_tokens, temperature, batch, in_flight) as client:
                for b in batches:
                    todo = [(k, p) for k, p in zip(*(c.to_pylist() for c in b.columns), strict=True) if k not in done]
                    held: list[dict] = []
                    for places, got in client.batches([p for _, p in todo]):
                        held += [{"key": todo[i][0], "text": text, "error": error} for i, (text, error) in zip(places, got, strict=True)]
                        n += len(places)
                        if len(held) >= every:
                            put(held)
                            held = []
                    if held:
                        put(held)
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

        open_.mapInArrow(run, "n long").agg(F.sum("n")).collect()
        return self.known(rows)


def ask(rows: DataFrame, question: Column, out: str, model: Model | WriteThrough, max_tokens: int = 240, temperature: float = 0.0, batch: int = BATCH, in_flight: int = IN_FLIGHT, sample: Column | None = None) -> DataFrame:
    """``out`` as struct (text, error). A null prompt is not asked; an error never becomes text (it is kept beside it). ``sample`` tells draws for one prompt apart where replies are kept.
    A plain model is asked as often as the plan runs; one that writes through is asked when this is called."""
    workers_find_package(rows.sparkSession)
    if isinstance(model, WriteThrough):
        key = F.when(question.isNotNull(), F.sha2(F.concat_ws("\x01", F.lit(f"{max_tokens} {temperature}"), (F.lit(0) if sample is None else sample).cast("string"), question), 256))
        known = model.answered(rows, key, question, max_tokens, temperature, batch, in_flight)
        names = fresh(rows, "key", "reply", "own")
        known = known.select(F.col("key").alias(names[0]), F.struct("text", "error").alias(names[1]))
        got = rows.withColumn(names[2], key).join(known, F.col(names[2]) == F.col(names[0]), "left")
        none = F.struct(F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("error"))
        return got.withColumn(out, F.coalesce(names[1], none)).drop(*names)

    @F.pandas_udf(REPLY)
    def replies(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        with Client(model, max_tokens, temperature, batch, in_flight) as client:
            for prompts in batches:
                for lo in range(0, len(prompts), ROWS):
                    yield pd.DataFrame(client.replies(prompts.iloc[lo : lo + ROWS].tolist()), columns=["text", "error"], dtype=object)

    return rows.withColumn(out, replies.asNondeterministic()(question))
