"""Lines to rows with nothing lost: what can't be parsed is mended by the first rule that helps, or kept as it came, with its place and the cause (SRC1, SRC6, FLT29)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import jsonl, ordered

# Rules for lines that are no JSON, in the order in which they are tried.
REPAIRS: tuple[tuple[str, Callable[[Column], Column]], ...] = (
    ("byte order mark", lambda c: F.regexp_replace(c, "^﻿", "")),
    ("bare source_index", lambda c: F.regexp_replace(c, r'"source_index":\s*([a-f0-9-]+)([},])', '"source_index": "$1"$2')),
    ("comma before the end", lambda c: F.regexp_replace(c, r",\s*([}\]])", "$1")),
)
ROUTES = ("rows", "repaired", "malformed", "blank")


def read(spark: SparkSession, paths: str | list[str], schema: str = jsonl.RAW, repairs: Sequence[tuple[str, Callable[[Column], Column]]] = REPAIRS) -> DataFrame:
    """Every line once: ``file``, ``ord`` (its place among all lines of the sorted files), ``route`` (one of ``ROUTES``), ``repair`` (the rule that helped), ``cause`` and ``line`` (of what is malformed: no object, cut off, or no JSON of the
    schema) and ``r``, the parsed row, null for malformed and blank lines."""
    lines = ordered.lines(spark, paths)
    line, tries = F.trim("value"), []
    for name, text in (("", line), *((name, fix(line)) for name, fix in repairs)):
        parsed = F.from_json(text, f"{schema}, _corrupt STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
        tries.append(F.when(parsed["_corrupt"].isNull(), F.struct(F.lit(name).alias("repair"), parsed.dropFields("_corrupt").alias("r"))))
    rows = lines.withColumn("got", F.when(line != "", F.coalesce(*tries)))
    route = F.when(line == "", "blank").when(F.col("got").isNull(), "malformed").when(F.col("got.repair") != "", "repaired").otherwise("rows")
    cause = F.when(~line.startswith("{"), "no object").when(~line.endswith("}"), "cut off").otherwise("no JSON of the schema")
    rows = rows.withColumn("route", route)
    bad = F.col("route") == "malformed"
    return rows.select("file", "ord", "route", F.when(F.col("route") == "repaired", F.col("got.repair")).alias("repair"), F.when(bad, cause).alias("cause"), F.when(bad, F.col("value")).alias("line"), F.col("got.r").alias("r"))
