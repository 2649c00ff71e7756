"""JSONL sources and sinks (SRC1-SRC9, SNK1-SNK5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import no_shuffles_left

RAW = "id STRING, text STRING, metadata STRUCT<nemocurator_scores: DOUBLE, finemath_scores: DOUBLE, category: STRING>"
WORKSHOP = "question STRING, solution STRING, answer STRING, source_index STRING"
MODES = {"tolerant": "PERMISSIVE", "drop": "DROPMALFORMED", "strict": "FAILFAST"}


def read(spark: SparkSession, paths: str | list[str], schema: str = RAW, mode: str = "tolerant") -> DataFrame:
    """SRC1-SRC5, SRC7: a path, a list or a glob. Blank lines are skipped in every mode (a strict scan does not fail on them); ``tolerant`` keeps bad lines in ``_corrupt``, ``drop`` drops them, ``strict`` fails.
    Files are read in no order: what depends on it carries a column to sort by."""
    reader = spark.read.option("mode", MODES[mode])
    if mode == "tolerant":
        reader, schema = reader.option("columnNameOfCorruptRecord", "_corrupt"), f"{schema}, _corrupt STRING"
    return reader.schema(schema).json(paths)


def read_by_label(spark: SparkSession, paths: dict[str, str], schema: str = RAW, mode: str = "strict") -> DataFrame:
    """SRC9: one table of several files, with their label."""
    out = None
    for label, path in sorted(paths.items()):
        one = read(spark, path, schema, mode).withColumn("label", F.lit(label))
        out = one if out is None else out.unionByName(one)
    return out


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The folders in a folder; none where it isn't."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().toString() for f in system.listStatus(hadoop) if f.isDirectory()) if system.exists(hadoop) else []


def remove(spark: SparkSession, path: str) -> None:
    """An output that is about to be written anew goes."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def replace(spark: SparkSession, path: str, to: str) -> None:
    """A written folder takes the place of another; where it isn't, an empty one does."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    system = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(hadoop(to), True)
    if not (system.rename(hadoop(path), hadoop(to)) if system.exists(hadoop(path)) else system.mkdirs(hadoop(to))):
        raise OSError(f"{path} could not be moved to {to}")


def qualified(spark: SparkSession, path: str) -> str:
    """The path as a URI that tasks open, too."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and not full.startswith("file://") else full


def by_file(rows: DataFrame) -> DataFrame:
    """SRC7: ``file``, the name of the file that a row was read from; sorting by it and the place in a file is the order of a sorted list of files. Empty files give no rows."""
    return rows.select("*", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"))


def read_workshop(spark: SparkSession, paths: str | list[str], keep_file: bool = False) -> DataFrame:
    """SRC6: a line is parsed as it is or with its bare ``source_index`` quoted; lines without a question go (FLT29)."""
    line = F.trim("value")
    fixed = F.regexp_replace(line, r'"source_index":\s*([a-f0-9-]+)([},])', '"source_index": "$1"$2')
    parsed = lambda c: F.from_json(c, f"{WORKSHOP}, _corrupt STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    first, second = parsed(line), parsed(fixed)
    rows = spark.read.text(paths)
    rows = by_file(rows) if keep_file else rows
    kept = ["file"] if keep_file else []
    rows = rows.filter(line != "").select(*kept, F.when(first["_corrupt"].isNull(), first).when(second["_corrupt"].isNull(), second).alias("r"))
    return rows.select(*kept, "r.*").drop("_corrupt").filter("coalesce(question, '') <> ''")


def write(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None) -> None:
    """``compression`` as Spark names it (gzip); lines as they are without it. What the write shuffles goes with its end."""
    with no_shuffles_left(df.sparkSession):
        df.write.mode(mode).json(path, compression=compression)


def write_routes(df: DataFrame, path: str, route: str = "label", compression: str | None = None) -> None:
    """SNK3: one pass, a folder for every route."""
    with no_shuffles_left(df.sparkSession):
        df.write.mode("overwrite").partitionBy(route).json(path, compression=compression)
