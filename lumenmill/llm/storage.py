"""Files of a job in shared storage, and the tables of :mod:`lumenmill.sources.shared`."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

from ..sources.shared import staged, workspace  # noqa: F401 - part of this module's interface

ROOT = str(Path(__file__).resolve().parents[2])


def workers_find_package(spark: SparkSession) -> None:
    """Python workers import this package from where the driver did."""
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *parts])


def bounded(batch: pa.RecordBatch, place: int, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with ``most`` bytes in column ``place`` at most, so that a worker unpacks no more at once; a longer text comes alone."""
    lo = held = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column(place)), 0).to_pylist()):
        if i > lo and held + n > most:
            yield batch.slice(lo, i - lo)
            lo, held = i, 0
        held += n
    if lo < batch.num_rows:
        yield batch.slice(lo)


def open_fs(uri: str):
    """(filesystem, path) of a folder or file in shared storage."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def put_file(folder: str, name: str, parts: list[bytes]) -> str:
    """Write a file under a name of this attempt; returns its URI. Names of failed attempts are never listed in a manifest, so nobody reads them."""
    system, root = open_fs(folder)
    system.create_dir(root, recursive=True)
    stem, _, ext = name.rpartition(".")
    name = f"{stem}-{uuid.uuid4().hex[:12]}.{ext}"
    with system.open_output_stream(f"{root}/{name}", compression=None) as out:
        for p in parts:
            out.write(p)
    return f"{folder}/{name}"


def get_file(uri: str) -> bytes:
    system, path = open_fs(uri)
    with system.open_input_file(path) as f:
        return f.read()


def get_range(uri: str, start: int, size: int) -> bytes:
    """Some bytes of a file, without the rest."""
    system, path = open_fs(uri)
    with system.open_input_file(path) as f:
        return f.read_at(size, start)
