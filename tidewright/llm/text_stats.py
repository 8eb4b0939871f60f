"""Counts over whole texts that the quality rules and the quality classifier start from."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewright.llm import arrays as A
from tidewright.llm.common import per_batch

COUNTS = ["n_bytes", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
          "n_lower", "n_digits", "n_stops", "n_marks", "n_distinct_words", "n_short_words"]


def _set(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


SYMBOLS = _set(b"#*$%&|<>")
UPPER, LOWER, DIGITS = _set(bytes(range(65, 91))), _set(bytes(range(97, 123))), _set(b"0123456789")
STOPS = _set(b".,;:")
MARKS = _set(b"!?\"'()[]{}/\\@=+-_~^`")


def count_batch(column: pa.Array) -> dict[str, np.ndarray]:
    """One value per text and name of COUNTS."""
    data, offsets = A.text_bytes(column)
    out = {name: np.zeros(len(offsets) - 1, np.int64) for name in COUNTS}
    for i, j, part, bounds in A.chunks(data, offsets):
        at = slice(i, j)
        starts, ends, of = A.word_spans(part, bounds)
        text_of = A.owners(of).astype(np.uint64)
        hashes = A.span_hashes(part, starts, ends)
        out["n_bytes"][at] = np.diff(bounds)
        out["n_words"][at] = np.diff(of)
        # Code points: all bytes but UTF-8 continuations.
        out["word_chars"][at] = A.per_text(((part & 0xC0) != 0x80) & ~A.SPACE[part], bounds)
        for name, kind in (("n_symbols", SYMBOLS), ("n_upper", UPPER), ("n_lower", LOWER), ("n_digits", DIGITS), ("n_stops", STOPS), ("n_marks", MARKS)):
            out[name][at] = A.per_text(kind[part], bounds)
        out["n_short_words"][at] = A.per_text(ends - starts <= 3, of)
        salted = A.mix(hashes + A.mix(text_of + np.uint64(1)))
        out["n_distinct_words"][at] = A.per_text(~A.repeats(salted)[1], of)

        # Windows of three words of one text; a word in a repeated window is marked once.
        triples = A.shingle_hashes(hashes, 3)
        inside = text_of[2:] == text_of[:-2] if len(text_of) > 2 else np.zeros(0, bool)
        where = np.flatnonzero(inside)
        again = where[A.repeats(A.mix(triples[where] + A.mix(text_of[where] + np.uint64(1))))[0]]
        marked = np.zeros(len(hashes), bool)
        for k in range(3):
            marked[again + k] = True
        out["n_repeat_words"][at] = A.per_text(marked, of)

        # Lines end at \n or with the text; only those that hold a word count.
        breaks = np.flatnonzero(part == 10)
        line_starts = np.union1d(breaks + 1, bounds[:-1])
        line_starts = line_starts[line_starts < len(part)]
        next_break = np.append(breaks, len(part))[np.searchsorted(breaks, line_starts)]
        line_ends = np.minimum(next_break, bounds[np.searchsorted(bounds, line_starts, "right")]) if len(part) else next_break
        held = np.searchsorted(starts, line_starts) < np.searchsorted(starts, line_ends)
        line_starts, line_ends = line_starts[held], line_ends[held]
        lines_of = np.searchsorted(line_starts, bounds)
        keys = A.mix(A.span_hashes(part, line_starts, line_ends) + A.mix(A.owners(lines_of).astype(np.uint64) + np.uint64(1)))
        out["n_lines"][at] = np.diff(lines_of)
        out["n_dup_lines"][at] = A.per_text(A.repeats(keys)[1], lines_of)
    return out


def text_stats(docs: DataFrame, keys: list[str]) -> DataFrame:
    """The ``keys`` columns and COUNTS of each row's ``text``. One pass, no shuffle."""
    source = docs.select(*keys, "text")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keys).schema] + [f"{c} long" for c in COUNTS])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = count_batch(batch.column("text"))
        return pa.RecordBatch.from_arrays([batch.column(k) for k in keys] + [pa.array(counts[c]) for c in COUNTS], names=[*keys, *COUNTS])

    return source.mapInArrow(per_batch(work), schema)
