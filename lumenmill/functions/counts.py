"""Matches counted in Arrow batches by RE2, whose time is linear: a pattern with many words costs a JVM several tries at every place of a text.

RE2 knows words, digits and blanks of ASCII alone, so a text with other characters is first brought to ASCII, each to one of its kind; that changes no count."""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import P

# Characters beyond ASCII: letters that stand for i, s and k where case doesn't count, blanks, and what ``(?U)\w`` matches besides letters, marks, digits and connectors.
_LETTERS = {"\u0130": "i", "\u0131": "i", "\u017f": "s", "\u212a": "k"}
_BLANK = frozenset(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_WORD = frozenset(map(chr, (0x200C, 0x200D, *range(0x24B6, 0x24EA), *range(0x1F130, 0x1F14A), *range(0x1F150, 0x1F16A), *range(0x1F170, 0x1F18A))))


def _counter(forms: list[str]):
    """A function from an array of texts to an array of counts for each form. It is made here, so that workers get it whole and need no package."""
    letters, blank, word, tables = _LETTERS, _BLANK, _WORD, []

    def kind(c: str) -> int:
        if c < "\x80" or c in letters:
            return ord(letters.get(c, c))
        of = unicodedata.category(c)
        return ord("0" if of == "Nd" else "_" if of[0] in "LM" or of in ("Nl", "Pc") or c in word else " " if c in blank else "\x01")

    def to_ascii(text: pa.Scalar) -> bytes:
        if not tables:
            tables.append(np.array([kind(chr(i)) for i in range(1 << 16)], np.uint8))
        codes = np.frombuffer(str(text.as_buffer(), "utf-8", "replace").encode("utf-32-le"), np.uint32)
        out, far = tables[0][np.minimum(codes, 0xFFFF)], codes > 0xFFFF
        if far.any():
            out[far] = [kind(chr(i)) for i in codes[far]]
        return out.tobytes()

    def count(texts: pa.Array) -> list[pa.Array]:
        other = pc.invert(pc.fill_null(pc.string_is_ascii(texts), True))
        if pc.any(other, min_count=0).as_py():
            texts = pc.replace_with_mask(texts, other, pa.array([to_ascii(x) for x in texts.filter(other)], pa.binary()).cast(texts.type))
        return [pc.count_substring_regex(texts, form).cast(pa.int64()) for form in forms]

    return count


def counts(c: Column, **patterns: P) -> Column:
    """A struct with the number of matches of each pattern in a text; nulls for a null one. A filter does not run this again."""
    names, count = list(patterns), _counter([q.scan for q in patterns.values()])

    def run(texts: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(count(texts), names)

    return F.arrow_udf(run, f"struct<{', '.join(f'{x}: bigint' for x in names)}>").asNondeterministic()(c)


def counts_each(c: Column, pattern: P) -> Column:
    """The number of matches in each of an array of texts, which must not be null."""
    count = _counter([pattern.scan])

    def run(lists: pa.Array) -> pa.Array:
        ends = pc.cumulative_sum(pc.list_value_length(lists)).cast(pa.int32())
        return pa.ListArray.from_arrays(pa.concat_arrays([pa.array([0], pa.int32()), ends]), count(lists.flatten())[0])

    return F.arrow_udf(run, "array<bigint>").asNondeterministic()(c)
