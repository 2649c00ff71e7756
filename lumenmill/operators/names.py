"""Column names that don't meet those of a caller's table."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh(rows: DataFrame, *stems: str) -> list[str]:
    """A name for each stem that no column has, whatever its case."""
    taken = {c.lower() for c in rows.columns}
    return [next(x for x in (f"_{s}{k or ''}" for k in count()) if x.lower() not in taken) for s in stems]


def without(rows: DataFrame, outputs: tuple[str, ...], used: tuple[str, ...] = ()) -> DataFrame:
    """The table less the columns that an operator's outputs of their name replace; those that it reads stay."""
    kept = {c.lower() for c in used}
    gone = {c.lower() for c in outputs} - kept
    return rows.drop(*(c for c in rows.columns if c.lower() in gone))


def kept(rows: DataFrame, condition: Column | str) -> DataFrame:
    """The rows that meet a condition on columns that long expressions make. A plain filter moves below the projection that makes them, and they are made twice; one that also reads a row's number stays above it."""
    (at,) = fresh(rows, "at")
    condition = F.expr(condition) if isinstance(condition, str) else condition
    return rows.withColumn(at, F.monotonically_increasing_id()).filter(condition & (F.col(at) >= 0)).drop(at)
