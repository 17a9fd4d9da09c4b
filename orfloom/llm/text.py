"""Vectorised text helpers that run inside Arrow tasks.

Everything works on slices of a record batch: the UTF-8 bytes of some rows in
one array with the row offsets beside it, so that words are found and hashed
for hundreds of documents per numpy call and memory stays bounded by a slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orfloom.llm.storage import bounded_batches

#: Bytes of text handled at once; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20
#: Bytes hashed at once, but for longer spans: tables and totals take eight times that.
HASH_BYTES = 1 << 18

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def free_name(columns: list[str], name: str) -> str:
    """``name``, with as many marks before it as no column starts with."""
    while any(c.lower().startswith(name.lower()) for c in columns):
        name = "_" + name
    return name


def with_text(df: DataFrame, names: list[str], text: str) -> tuple[DataFrame, int]:
    """``df``'s columns ``names`` and, only if it is not among them, the text; and where the text is."""
    bounded_batches(df.sparkSession)
    cols = [F.col(f"`{n}`") for n in names]
    if text in names:
        return df.select(*cols), names.index(text)
    return df.select(*cols, F.col(f"`{text}`").alias(free_name(names, "__text"))), len(names)


def _byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    for lo, hi in ranges:
        table[lo : hi + 1] = False
    return table


#: ``[^\x20\x09-\x0D]+``
SPACE_WORDS = _byte_set((0x20, 0x20), (0x09, 0x0D))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (after lower-casing A-Z)
ALNUM_WORDS = _byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets from 0) of a string column; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    if n == 0:
        return
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def word_spans(buf: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each row and the end): words never cross rows."""
    inside = table[buf]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    if len(inside):
        before[0] = after[-1] = False
    edges = offsets[(offsets > 0) & (offsets < len(buf))]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Finishes a 64-bit hash."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        table = np.full(max(n, HASH_BYTES + 1), base, dtype=np.uint64)
        table[0] = 1
        np.cumprod(table, out=table)
        if n > HASH_BYTES + 1:  # a span longer than that: not kept
            return table
        have = _powers[name] = table
    return have[:n]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, both ends ascending, by a polynomial over one stretch of the slice after another."""
    found = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        at = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, at + HASH_BYTES, "right")))
        a, b = starts[i:j] - at, ends[i:j] - at
        total = np.zeros(int(b[-1]) + 1, dtype=np.uint64)
        total[1:] = buf[at : at + len(total) - 1]
        total[1:] += np.uint64(1)
        total[1:] *= _power("up", _MULTIPLIER, len(total) - 1)
        np.cumsum(total, out=total)
        found[i:j] = (total[b] - total[a]) * _power("down", _INVERSE, len(total))[a]
        i = j
    return mix(found ^ (ends - starts).astype(np.uint64))


def hashed_words(buf: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word with A-Z lower-cased, first word of each row and the end)."""
    low = LOWER[buf]
    starts, ends, first = word_spans(low, offsets, table)
    return span_hashes(low, starts, ends), first
