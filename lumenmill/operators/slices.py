"""Arrow batches in small parts, so that what a Python worker makes of one is bounded by bytes, not by Spark's rows a batch."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

#: Rows and bytes of text that are Python objects at once; a longer text is a part of its own.
ROWS, BYTES = 256, 1 << 20


def places(sizes: list[int], rows: int = ROWS, most: int = BYTES) -> Iterator[tuple[int, int]]:
    """(start, length) of runs of at most ``rows`` and ``most`` in all, or of one."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and (i - start == rows or total + n > most):
            yield start, i - start
            start, total = i, 0
        total += n
    if sizes[start:]:
        yield start, len(sizes) - start


def slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The rows of some batches in parts by the bytes of a text column. A part is a view: nothing is copied."""
    for b in batches:
        for at, n in places(pc.fill_null(pc.binary_length(b.column(column)), 0).to_pylist()):
            yield b.slice(at, n)
