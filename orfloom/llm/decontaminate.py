"""Benchmark decontamination by an FM-index of each training shard.

A shard is a slice of documents inside a task.  Its text is the sequence of
its words, written in the benchmark's alphabet: a word outside the benchmark's
vocabulary can be part of no match, so it and every run of known words that is
shorter than the shortest window are left out, as separators.  The FM-index of
that sequence is a wavelet matrix over the Burrows-Wheeler transform; all
windows are searched backward at once, rows of the matches are located by
walking to sampled suffix positions, and the matched spans are merged.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orfloom.llm.storage import give_back, stored
from orfloom.llm.text import ALNUM_WORDS, LOWER, free_name, hashed_words, slices, span_hashes, with_text, word_spans

#: Benchmark text of a part, about.  Its windows of ten 32-bit symbols take some eight times that, on the driver and in a broadcast.
PART_BYTES = 8 << 20
#: Every so many positions of the shard's sequence a suffix position is kept.
SAMPLE = 16
#: Text of one shard.
SHARD_BYTES = 1 << 20


class WaveletMatrix:
    """Ranks of symbols in a sequence of integers, for many queries at once."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.bits = max(1, int(top).bit_length())
        self.zeros, self.ones_before = [], []
        s = symbols.astype(np.int32)
        for level in reversed(range(self.bits)):
            bit = (s >> level) & 1
            self.ones_before.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]))
            self.zeros.append(len(s) - int(self.ones_before[-1][-1]))
            s = np.concatenate([s[bit == 0], s[bit == 1]])
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=top + 1))])  # symbols below each symbol

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each end."""
        lo, hi = np.zeros_like(end), end.copy()
        for k, level in enumerate(reversed(range(self.bits))):
            one = (symbol >> level) & 1 == 1
            ones = self.ones_before[k]
            a, b = ones[lo], ones[hi]
            lo = np.where(one, self.zeros[k] + a, lo - a)
            hi = np.where(one, self.zeros[k] + b, hi - b)
        return hi - lo


class FMIndex:
    """Full-text index of runs of symbols from 1; matches never cross runs."""

    def __init__(self, runs: np.ndarray, run_starts: np.ndarray, top: int):
        """runs: the runs' symbols in one array; run_starts: where each starts in it."""
        n, r = len(runs), len(run_starts)
        self.n = n + r
        place = np.arange(n) + np.searchsorted(run_starts, np.arange(n), "right") - 1
        text = np.zeros(self.n, dtype=np.int32)
        text[place] = runs
        rank = np.empty(self.n, dtype=np.int64)
        ends = np.flatnonzero(text == 0)  # a separator after each run; each sorts as a symbol of its own
        rank[ends] = np.arange(r)
        rank[place] = runs + r - 1
        step = 1
        while True:
            after = np.zeros(self.n, dtype=np.int64)
            after[:-step] = rank[step:] + 1 if step < self.n else 0
            key = rank * (self.n + r + top + 2) + after
            order = np.argsort(key, kind="stable")
            new = np.cumsum(np.concatenate([[0], (np.diff(key[order]) != 0).astype(np.int64)]))
            rank[order] = new
            step *= 2
            if new[-1] == self.n - 1 or step >= self.n:
                break
        del rank, after, key, new
        order = order.astype(np.int32)
        self.bwt = text[order - 1]
        self.wavelet = WaveletMatrix(self.bwt, top)
        starts = np.zeros(self.n, dtype=bool)
        starts[np.concatenate([[0], ends[:-1] + 1])] = True
        self.sampled = (order % SAMPLE == 0) | starts[order]
        self.position = np.where(self.sampled, order, -1)  # kept for sampled suffixes only
        self.place = np.full(self.n, -1, dtype=np.int32)
        self.place[place] = np.arange(n)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [lo, hi) of the suffixes that start with each pattern, all of one length."""
        lo = np.zeros(len(patterns), dtype=np.int64)
        hi = np.full(len(patterns), self.n, dtype=np.int64)
        live = np.arange(len(patterns))
        for k in reversed(range(patterns.shape[1])):
            c = patterns[live, k]
            lo[live] = self.wavelet.first[c] + self.wavelet.rank(c, lo[live])
            hi[live] = self.wavelet.first[c] + self.wavelet.rank(c, hi[live])
            live = live[lo[live] < hi[live]]
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in ``runs`` where the suffixes of the rows start."""
        rows, walked = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        live = np.flatnonzero(~self.sampled[rows])
        while len(live):
            c = self.bwt[rows[live]]
            rows[live] = self.wavelet.first[c] + self.wavelet.rank(c, rows[live])
            walked[live] += 1
            live = live[~self.sampled[rows[live]]]
        return self.place[self.position[rows] + walked]


@dataclass
class Windows:
    """The benchmark's windows in its own alphabet."""

    #: Sorted hashes of the words; a word's symbol is its place from 1.
    words: np.ndarray
    #: For each length: the distinct windows.
    patterns: dict[int, np.ndarray]
    #: For each length: items of window i are ``items[where[i]:where[i+1]]``.
    items: dict[int, tuple[np.ndarray, np.ndarray]]
    names: list[str]


def benchmark_windows(items: DataFrame, size: int) -> Windows:
    """The windows of a part of the benchmark, columns ``i`` and ``t``; those of items without an id belong to nobody."""
    found = sorted(((r["i"], r["t"]) for r in items.collect()), key=lambda r: (r[0] is None, r[0] or "", r[1]))
    names = sorted({i for i, _ in found if i is not None})
    number = {i: k for k, i in enumerate(names)}
    nobody = len(names)
    owner = np.array([number.get(i, nobody) for i, _ in found], dtype=np.int64)
    hashes, first = [np.zeros(0, np.uint64)], [0]
    for _, _, raw, offsets in slices(pa.array([t for _, t in found], pa.string())):
        h, f = hashed_words(raw, offsets, ALNUM_WORDS)
        hashes.append(h)
        first.extend((f[1:] + first[-1]).tolist())
    flat = np.concatenate(hashes)
    words = np.unique(flat)
    symbols = (np.searchsorted(words, flat) + 1).astype(np.int32)
    parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for k, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
        width = min(size, b - a)
        if width:
            view = np.lib.stride_tricks.sliding_window_view(symbols[a:b], width)
            parts.setdefault(width, []).append((view, np.full(len(view), owner[k])))
    patterns, named = {}, {}
    for width, got in parts.items():
        distinct, which = np.unique(np.concatenate([v for v, _ in got]), axis=0, return_inverse=True)
        pairs = np.unique(which.ravel() * (nobody + 1) + np.concatenate([o for _, o in got]))
        pattern, item = np.divmod(pairs, nobody + 1)
        patterns[width] = distinct
        named[width] = item[item < nobody], np.searchsorted(pattern[item < nobody], np.arange(len(distinct) + 1))
    return Windows(words, patterns, named, names)


def _spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, value) of all values in the ranges."""
    n = hi - lo
    which = np.repeat(np.arange(len(lo)), n)
    return which, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + lo[which]


def search_shard(hashes: np.ndarray, first: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hit flag of each word, rows and items of the distinct pairs that match) of a shard's words."""
    hit, none = np.zeros(len(hashes), dtype=bool), np.zeros(0, np.int64)
    if not windows.patterns or not len(hashes):
        return hit, none, none
    at = np.minimum(np.searchsorted(windows.words, hashes), len(windows.words) - 1)
    known = windows.words[at] == hashes
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    joined = np.concatenate([[False], known[1:] & known[:-1] & (row[1:] == row[:-1])])
    start = np.flatnonzero(known & ~joined)
    end = np.flatnonzero(known & ~np.append(joined[1:], False)) + 1
    long = end - start >= min(windows.patterns)
    start, end = start[long], end[long]
    if not len(start):
        return hit, none, none
    _, word = _spread(start, end)
    sizes = end - start
    index = FMIndex(at[word] + 1, np.cumsum(sizes) - sizes, len(windows.words))
    change = np.zeros(len(hashes) + 1, dtype=np.int64)
    pairs = [none]
    for width, patterns in windows.patterns.items():
        lo, hi = index.search(patterns)
        which, rows = _spread(lo, hi)
        begin = word[index.locate(rows)]
        np.add.at(change, begin, 1)
        np.add.at(change, begin + width, -1)
        flat, where = windows.items[width]
        match = np.unique(row[begin] * len(patterns) + which)
        doc, pattern = match // len(patterns), match % len(patterns)
        k, item = _spread(where[pattern], where[pattern + 1])
        pairs.append(doc[k] * len(windows.names) + flat[item])
    doc, item = np.divmod(np.unique(np.concatenate(pairs)), max(1, len(windows.names)))
    return np.cumsum(change[:-1]) > 0, doc, item


def decontaminate(
    df: DataFrame, benchmark: DataFrame, size: int = 10, text: str = "text", item_id: str = "item_id", item_text: str = "text", cleaned: bool = False, part_bytes: int = PART_BYTES
) -> DataFrame:
    """Adds ``n_words``, ``n_hit``, ``items`` and ``spans`` to every row; a narrow pass beside a broadcast of windows for each part of the benchmark.

    A window is ``size`` consecutive words of an item (all its words, if
    fewer); a word of a text inside any occurrence of a window is hit.
    ``items``: ids, sorted as strings, of the items with a window in the text;
    ``spans``: merged byte ranges from the first to the last of adjacent hit
    words.  With ``cleaned``, ``clean_text`` is the text without its spans,
    for the rows that have any (else null).  Null and empty texts and items have no
    words; windows of items without an id hit words and add nothing to ``items``; an
    empty benchmark hits nothing.  Very long texts are searched whole.
    Columns of ``df`` with the names of the results are replaced.

    A benchmark of more than ``part_bytes`` of text is dealt into parts by a
    hash of its rows; each pass adds its part's hits to those before, and is
    written, so that its broadcast can go.
    """
    items = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("i"), F.col(f"`{item_text}`").alias("t")).where("t is not null")
    parts = max(1, -(-(items.agg(F.sum(F.octet_length("t"))).first()[0] or 0) // part_bytes))
    before = None
    for k in range(parts - 1):
        windows = df.sparkSession.sparkContext.broadcast(benchmark_windows(items.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == k), size))
        names = before or (free_name(df.columns, "__items"), free_name(df.columns, "__spans"))
        df, before = stored(_add_hits(df, windows, text, before, names), "decontaminated"), names
        windows.unpersist()
    last = items if parts == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == parts - 1)
    windows = df.sparkSession.sparkContext.broadcast(benchmark_windows(last, size))
    return _add_hits(df, windows, text, before, None, cleaned)


def _add_hits(df: DataFrame, windows: Broadcast, text: str, before: tuple[str, str] | None, names_of_hits: tuple[str, str] | None, cleaned: bool = False) -> DataFrame:
    """A pass: the hits in columns ``before`` and those of ``windows``, as columns ``names_of_hits``, or (None) all results."""
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    hits = [T.StructField(n, t) for n, t in zip(names_of_hits or ("items", "spans"), (T.ArrayType(T.StringType()), T.ArrayType(span)), strict=True)]
    added = hits if names_of_hits else [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), *hits]
    added = added + [T.StructField("clean_text", T.StringType())] * cleaned
    names = [f.name for f in added]
    keep = [f for f in df.schema.fields if f.name not in names and f.name not in (before or ())]
    span_type = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    rows, at = with_text(df, [*(f.name for f in keep), *(before or ())], text)

    def run(batches):
        known = windows.value
        for batch in batches:
            for lo, hi, raw, offsets in slices(batch.column(at), SHARD_BYTES):
                low = LOWER[raw]
                starts, ends, first = word_spans(low, offsets, ALNUM_WORDS)
                hit, doc, item = search_shard(span_hashes(low, starts, ends), first, known)
                items: list[list[str]] = [[] for _ in range(hi - lo)]
                for d, i in zip(doc.tolist(), item.tolist(), strict=True):  # in the order of names: sorted
                    items[d].append(known.names[i])
                if before:
                    olds = zip(batch.column(len(keep)).slice(lo, hi - lo).to_pylist(), batch.column(len(keep) + 1).slice(lo, hi - lo).to_pylist(), strict=True)
                    for d, (old, old_spans) in enumerate(olds):
                        items[d] = sorted({*items[d], *old}) if old else items[d]
                        for x in old_spans:  # all words in an earlier span were hit
                            a, b = np.searchsorted(starts[first[d] : first[d + 1]], [x["start"] + offsets[d], x["end"] + offsets[d]]) + first[d]
                            hit[a:b] = True
                total = np.concatenate([[0], np.cumsum(hit)])
                n_hit = total[first[1:]] - total[first[:-1]]
                spans: list[list[dict]] = [[] for _ in range(hi - lo)]
                clean: list[str | None] = [None] * (hi - lo)
                for d in np.flatnonzero(n_hit).tolist():
                    mine = np.flatnonzero(hit[first[d] : first[d + 1]]) + first[d]
                    cut = np.flatnonzero(np.diff(mine) > 1)
                    a = starts[mine[np.concatenate([[0], cut + 1])]] - offsets[d]
                    b = ends[mine[np.append(cut, len(mine) - 1)]] - offsets[d]
                    spans[d] = [{"start": int(x), "end": int(y)} for x, y in zip(a, b, strict=True)]
                    if cleaned:
                        whole = raw[offsets[d] : offsets[d + 1]].tobytes()
                        parts = zip([0, *b.tolist()], [*a.tolist(), len(whole)], strict=True)
                        clean[d] = b"".join(whole[x:y] for x, y in parts).decode("utf-8")
                out = [pa.array(items, pa.list_(pa.string())), pa.array(spans, pa.list_(span_type))]
                if not names_of_hits:
                    out = [pa.array(np.diff(first)), pa.array(n_hit.astype(np.int64)), *out]
                if cleaned:
                    out.append(pa.array(clean, pa.string()))
                piece = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*(piece.column(i) for i in range(len(keep))), *out], names=[*(f.name for f in keep), *names])
        give_back()

    return rows.mapInArrow(run, T.StructType([*keep, *added]))
