"""Phrase collocations by prefix-free parsing.

1. *Parse*: a text is cut into pieces at marks and lines, and a piece into
   chunks at trigger windows: three words whose hash is 0 modulo ``TRIGGER``.
   Windows depend on the words in them alone, so equal passages give equal
   chunks wherever they stand.  A chunk goes on to the end of the window that
   starts the next one; it owns the phrases that begin before that window, so
   each occurrence of a phrase of up to four words is counted in one chunk.
2. *Dictionary*: distinct chunks with the frequency of each in the parse, by
   language; a written table.  Everything below reads it and not the texts.
3. *Filters*: pairs of words are counted into a saturating sketch, weighted by
   the chunks' frequencies; then phrases of three and four words all of whose
   pairs pass.  A cell is never less than a phrase's count, so what a filter
   stops is under the threshold.  A filter is a bit a cell, 16 MB at most.
4. *Counts*: phrases that pass are counted by their strings, exactly.
5. *Scores*: parts and longer phrases are joined to the candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orfloom.llm.storage import bounded_batches, give_back, stored
from orfloom.llm.text import LOWER, _byte_set, mix, slices, span_hashes, word_spans

#: Words of the longest phrase, and of a trigger window.
LONGEST, WINDOW = 4, 3
#: One window in so many is a trigger; a chunk without one ends after ``MOST_WORDS``.
TRIGGER, MOST_WORDS = 16, 4096
#: Cells of a filter: one for every ``CELL_BYTES`` of the dictionary within these bounds (a bit each where it is broadcast).
LEAST_BITS, MOST_BITS, CELL_BYTES = 20, 27, 32
_BLOCK = 1 << 16
_STEP = np.uint64(0x9FB21C651E98DF25)

_MARKS = ~_byte_set(*((b, b) for b in b".,;:!?"), (0x0A, 0x0D))
_WORDS = _byte_set(*((b, b) for b in b".,;:!?"), (0x0A, 0x0D), (0x20, 0x20), (0x09, 0x09))
_PARTS = _byte_set((0x20, 0x20))

_CHUNKS = "lang string, chunk string, overlap int, n long"
_PHRASES = "lang string, phrase string, size int, n long"


def _gathered(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte spans as strings."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(buf[at]))


def _totals(columns: dict[str, pa.Array], weights: np.ndarray) -> pa.RecordBatch | None:
    """Sums of the weights of equal rows."""
    table = pa.table({**columns, "n": pa.array(weights, pa.int64())}).group_by(list(columns)).aggregate([("n", "sum")])
    if not table.num_rows:
        return None
    names = [*columns, "n"]
    return pa.RecordBatch.from_arrays([(c := table.column(k)).combine_chunks().cast(pa.string() if pa.types.is_large_string(c.type) else c.type) for k in range(len(names))], names=names)


def _windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size`` words from each word on, as far as they go."""
    m = max(0, len(hashes) - size + 1)
    whole = np.zeros(m, dtype=np.uint64)
    for j in range(size):
        whole = whole * _STEP + hashes[j : j + m]
    return mix(whole)


def parse(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, first byte, end byte, overlapping words) of every chunk of the texts, and the words with one space behind each."""
    low = LOWER[raw]
    starts, ends, first = word_spans(low, offsets, _WORDS)
    n = len(starts)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none, none, np.zeros(0, np.uint8)
    sizes = ends - starts
    plain = np.full(int(sizes.sum()) + n, 0x20, dtype=np.uint8)
    before = np.cumsum(sizes) - sizes
    to = before + np.arange(n)  # where each word begins among words and spaces
    plain[np.arange(int(sizes.sum())) + np.repeat(np.arange(n), sizes)] = low[_inside(low, starts, ends)]
    # pieces: words with a mark before them, or the first of their text
    marks = np.concatenate([[0], np.cumsum(_MARKS[low])])
    new = np.zeros(n, dtype=bool)
    new[1:] = marks[starts[1:]] != marks[starts[:-1]]
    new[first[:-1][first[:-1] < n]] = True
    piece = np.flatnonzero(new)
    piece_end = np.repeat(np.append(piece[1:], n), np.diff(np.append(piece, n)))  # of each word
    hit = np.zeros(n, dtype=bool)
    windows = _windows(span_hashes(low, starts, ends), WINDOW)
    hit[: len(windows)] = windows % np.uint64(TRIGGER) == 0
    hit &= np.arange(n) + WINDOW <= piece_end
    cut = np.flatnonzero(new | hit)
    length = np.diff(np.append(cut, n))
    parts = -(-length // MOST_WORDS)
    nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    cut = np.repeat(cut, parts) + nth * MOST_WORDS
    following = np.append(cut[1:], n)
    stop = piece_end[cut]
    end = np.where(following < stop, np.minimum(following + WINDOW, stop), stop)
    row = np.searchsorted(first, cut, "right") - 1
    overlap = end - np.minimum(following, stop)
    return row, to[cut], to[end - 1] + sizes[end - 1], overlap, plain


def _inside(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places of the bytes of all spans."""
    sizes = ends - starts
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def dictionary(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, chunk, overlap, n``: distinct chunks, how many words at the end belong to the next one, and their frequency."""
    bounded_batches(df.sparkSession)
    rows = df.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text"))

    def run(batches):
        for batch in batches:
            langs = batch.column(0).cast(pa.large_string())
            for lo, _, raw, offsets in slices(batch.column(1)):
                row, a, b, overlap, plain = parse(raw, offsets)
                if len(row):
                    columns = {"lang": langs.take(pa.array(row + lo)), "chunk": _gathered(plain, a, b), "overlap": pa.array(overlap, pa.int32())}
                    yield _totals(columns, np.ones(len(row), np.int64))
        give_back()

    parsed = rows.mapInArrow(run, _CHUNKS)
    return parsed.groupBy("lang", "chunk", "overlap").agg(F.sum("n").alias("n"))


class _Slice:
    """Words of some distinct chunks: spans, hashes seeded by language, weights, and which phrases a chunk owns."""

    def __init__(self, batch: pa.RecordBatch, seeds: np.ndarray, lo: int, hi: int, raw: np.ndarray, offsets: np.ndarray):
        self.raw = raw
        self.starts, self.ends, first = word_spans(raw, offsets, _PARTS)
        count = np.diff(first)
        self.row = np.repeat(np.arange(lo, hi), count)
        self.weight = batch.column(3).to_numpy(zero_copy_only=False)[self.row]
        self.hash = span_hashes(raw, self.starts, self.ends) ^ seeds[self.row]
        end = np.repeat(first[1:], count)
        at = np.arange(len(self.row))
        self.left = end - at  # words from here to the end of the chunk
        self.own = self.left > batch.column(2).to_numpy(zero_copy_only=False)[self.row]

    def phrases(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(first words of the phrases inside a chunk, hash of the phrase from each word on)."""
        windows = _windows(self.hash, size)
        inside = self.left[: len(windows)] >= size
        return inside, windows


def _dictionary_slices(batches) -> Iterator[tuple[pa.RecordBatch, _Slice]]:
    for batch in batches:
        langs = pc.dictionary_encode(batch.column(0))
        names = langs.dictionary.to_pylist()
        seeds = np.array([hash_of(x) for x in names], dtype=np.uint64)[langs.indices.to_numpy(zero_copy_only=False)]
        for lo, hi, raw, offsets in slices(batch.column(1)):
            yield batch, _Slice(batch, seeds, lo, hi, raw, offsets)


def hash_of(name: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(name.encode())


def _passing(slice_: _Slice, bits: int, pairs: np.ndarray | None, longer: np.ndarray | None, sizes: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, first words, hashes) of owned phrases whose pairs, and which themselves, pass the filters that there are."""
    two = slice_.phrases(2)
    good = two[0] & _bit(pairs, two[1], bits) if pairs is not None else two[0]
    for size in sizes:
        inside, hashes = two if size == 2 else slice_.phrases(size)
        keep = inside & slice_.own[: len(inside)]
        for j in range(size - 1):
            keep &= good[j : j + len(keep)]
        if size > 2 and longer is not None:
            keep &= _bit(longer, hashes, bits)
        at = np.flatnonzero(keep)
        yield size, at, hashes[at]


def _bit(filter_: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    cell = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    return (filter_[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1


def _filter(chunks: DataFrame, bits: int, threshold: int, sizes: tuple[int, ...], pairs) -> np.ndarray:
    """A bit for each cell: whether the phrases of ``sizes`` in it may reach ``threshold`` together."""
    most = min(threshold, 255)

    def count(batches):
        cells, seen = np.zeros(1 << bits, dtype=np.uint8), False
        for _, piece in _dictionary_slices(batches):
            for _, at, hashes in _passing(piece, bits, pairs.value if pairs else None, None, sizes):
                if len(at):
                    seen = True
                    cell = (hashes >> np.uint64(64 - bits)).astype(np.int64)
                    order = np.argsort(cell, kind="stable")
                    cell, weight = cell[order], np.minimum(piece.weight[at][order], most)
                    edge = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
                    cell, weight = cell[edge], np.add.reduceat(weight, edge)
                    cells[cell] = np.minimum(cells[cell] + weight, most)
        if seen:
            rows = cells.reshape(-1, min(_BLOCK, len(cells)))
            for lo in range(0, len(rows), 64):
                blocks = [k for k in range(lo, min(lo + 64, len(rows))) if rows[k].any()]
                yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array([rows[k].tobytes() for k in blocks], pa.binary())], names=["block", "counts"])
        give_back()

    def merge(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = np.frombuffer(counts, np.uint8)
                total[block] = np.minimum(total[block].astype(np.uint16) + found, most).astype(np.uint8) if block in total else found
        for block, counts in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([np.packbits(counts >= most).tobytes()], pa.binary())], names=["block", "bits"])

    size = min(_BLOCK, 1 << bits)
    out = np.zeros((1 << bits) // 8, dtype=np.uint8).reshape(-1, size // 8)
    parts = chunks.mapInArrow(count, "block int, counts binary").repartition(len(out), "block")
    for row in parts.mapInArrow(merge, "block int, bits binary").collect():  # a fixed size in all
        out[row["block"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def phrase_counts(df: DataFrame, text: str = "text", lang: str = "lang", threshold: int = 30) -> DataFrame:
    """``lang, phrase, size, n``: phrases of 1 to 4 words that occur ``threshold`` times at least; and one row a language with no phrase, of size 0: all words."""
    spark = df.sparkSession
    chunks = stored(dictionary(df, text, lang), "phrase-chunks")
    room = (chunks.agg(F.sum(F.octet_length("chunk"))).first()[0] or 0) // CELL_BYTES
    bits = min(max(int(room).bit_length(), LEAST_BITS), MOST_BITS)
    pairs = spark.sparkContext.broadcast(_filter(chunks, bits, threshold, (2,), None))
    longer = spark.sparkContext.broadcast(_filter(chunks, bits, threshold, (3, 4), pairs))

    def count(batches):
        for batch, piece in _dictionary_slices(batches):
            langs = batch.column(0).cast(pa.large_string())
            own = np.flatnonzero(piece.own)
            rows, where = np.unique(piece.row[own], return_inverse=True)
            if not len(rows):
                continue
            words = np.zeros(len(rows), np.int64)
            np.add.at(words, where, piece.weight[own])
            none = {"phrase": pa.nulls(len(rows), pa.large_string()), "size": pa.array(np.zeros(len(rows)), pa.int32())}
            yield _totals({"lang": langs.take(pa.array(rows)), **none}, words)
            for size, at, _ in [(1, own, None), *_passing(piece, bits, pairs.value, longer.value, (2, 3, 4))]:
                if len(at):
                    phrase = _gathered(piece.raw, piece.starts[at], piece.ends[at + size - 1])
                    yield _totals({"lang": langs.take(pa.array(piece.row[at])), "phrase": phrase, "size": pa.array(np.full(len(at), size), pa.int32())}, piece.weight[at])
        give_back()

    counts = chunks.mapInArrow(count, _PHRASES).groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))
    counts = stored(counts.where((F.col("n") >= threshold) | (F.col("size") == 0)), "phrase-counts")
    pairs.destroy()
    longer.destroy()
    return counts


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", threshold: int = 30, covered: tuple[int, int] = (80, 100), most: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``most`` best phrases of 2 to 4 words of each language.

    ``a`` is the phrase's count, ``l`` and ``r`` those of its parts at the cut
    with the least score ``floor(2000000 * a / (l + r))`` (ties: the first cut),
    ``n`` the words of the language.  A phrase inside a longer candidate with
    ``covered`` of its count is left out.  Ties of scores go by ``a``, then by the
    phrase's bytes.  Null texts are empty, a null language is ``und``; equal
    rows count as often as they are; an empty table has no rows; other columns
    play no part.  A text of any length is parsed whole.  Arithmetic is exact
    to counts of 4 * 10^15.
    """
    counts = phrase_counts(df, text, lang, threshold)
    found = counts.where("size >= 2").withColumnRenamed("n", "a")
    cuts = found.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumns({"head": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - size)")})
    heads = counts.where("size between 1 and 3").select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    rests = heads.withColumnsRenamed({"head": "rest", "l": "r"})
    cuts = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"])
    # a * 2000000 // (l + r) in two steps of three digits and more, so that no product passes 64 bits
    score = F.expr("(a * 2000) div (l + r) * 1000 + (((a * 2000) % (l + r)) * 1000) div (l + r)")
    scored = cuts.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    inner = found.where("size >= 3").select("lang", "a", "size", F.split("phrase", " ").alias("w"), F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("part"))
    inner = inner.select("lang", "a", F.explode(F.expr("transform(sequence(1, size - part + 1), i -> array_join(slice(w, i, part), ' '))")).alias("phrase"))
    longest = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    num, den = covered
    stay = scored.join(longest, ["lang", "phrase"], "left").where(F.col("longest").isNull() | (F.col("longest") * den < F.col("a") * num))
    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    top = stay.select("lang", F.row_number().over(best).cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "cut.score").where(F.col("rank") <= most)
    words = counts.where("size = 0").select("lang", "n")
    return top.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
