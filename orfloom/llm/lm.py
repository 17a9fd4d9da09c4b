"""Language-model scores from a log-frequency Bloom filter.

The corpus becomes a written table of token streams: a row for each chunk of
documents, with the chunk's distinct words (as 64-bit hashes) and the tokens as
places among them.  Exchanges of packed blocks follow, none of them with a row
for each token:

* words: every chunk sends its distinct words and their training counts to the
  blocks of the hash range, which send the corpus-wide counts back;
* bigrams: training counts, summed over some chunks, go to the blocks of their
  hash range; a block keeps the log-quantised counts as a segment of the filter:
  a bigram of level ``l`` is entered with the levels ``1 .. l``.

The filter is broadcast, and a scorer probes a bigram with level 1, 2, ... until
the first miss.  Only if all segments together pass ``BROADCAST_BYTES`` the
probes travel instead: chunks send their distinct bigrams to ranges of segments,
one row for each range, which send the levels back; a range's task holds its
segments and probes for many chunks at once.  Both ways give the same scores.

The probability is the bigram's quantised count, smoothed with the unigram by a
weight that depends on the count of the word before.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orfloom.llm.storage import bounded_batches, give_back, stored
from orfloom.llm.text import SPACE_WORDS, hashed_words, mix, slices

#: Text of a chunk, about.
CHUNK_BYTES = 1 << 20
#: Tokens whose bigrams are summed up before they are sent.
SEND_TOKENS = 1_000_000
#: Keys that a task of an exchange handles at once: the number of blocks follows from it.
BLOCK_KEYS = 1_000_000
#: Bits of the filter for each entry, probes for each level, and bytes of a filter that is broadcast.
ENTRY_BITS, PROBES, BROADCAST_BYTES = 10, 4, 128 << 20
#: Bytes of a range of segments that travelling probes meet in one task, at most, and ranges, at least, as far as there are blocks.
RANGE_BYTES, RANGES = 8 << 20, 64
#: Pseudo-count of the unigram behind each word.
PRIOR = 300.0
_START, _END = np.uint64(0x51A27B1D00000001), np.uint64(0x51A27B1D00000002)
_ODD = np.uint64(0xD6E8FEB86659FD93)
_KEY = np.uint64((1 << 40) - 1)
_TRAIN, _NO_ID = np.uint8(1), np.uint8(2)
_STREAM = "chunk long, ids binary, flags binary, sizes binary, words binary, tokens binary"
_STREAM_ARROW = pa.schema([("chunk", pa.int64()), *((c, pa.binary()) for c in ("ids", "flags", "sizes", "words", "tokens"))])


def _streams(docs: DataFrame) -> DataFrame:
    """A row for each chunk: document ids, flags and token counts, sorted distinct words, tokens as places in them."""

    def run(batches):
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids = pc.fill_null(batch.column(0), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flags = np.asarray(batch.column(1)) * _TRAIN + np.asarray(batch.column(0).is_null()) * _NO_ID
            for lo, hi, raw, offsets in slices(batch.column(2), CHUNK_BYTES):
                hashes, first = hashed_words(raw, offsets, SPACE_WORDS)
                words, tokens = np.unique(np.insert(hashes, first[1:], _END), return_inverse=True)
                kind = np.uint16 if len(words) <= 1 << 16 else np.uint32
                parts = (ids[lo:hi], flags[lo:hi].astype(np.uint8), (np.diff(first) + 1).astype(np.int32), words, tokens.astype(kind))
                yield pa.RecordBatch.from_arrays([pa.array([chunk]), *(pa.array([x.tobytes()], pa.binary()) for x in parts)], schema=_STREAM_ARROW)
                chunk += 1
        give_back()

    return stored(docs.mapInArrow(run, _STREAM), "token-streams")


class _Chunk:
    """A row of the streams as arrays."""

    def __init__(self, row: dict[str, pa.Scalar]):
        def array(name, dtype):
            return np.frombuffer(row[name].as_buffer(), dtype)

        self.name = row["chunk"].as_py()
        self.ids, self.flags, self.sizes, self.words = array("ids", np.int64), array("flags", np.uint8), array("sizes", np.int32).astype(np.int64), array("words", np.uint64)
        self.tokens = array("tokens", np.uint16 if len(self.words) <= 1 << 16 else np.uint32)
        self.train = (self.flags & _TRAIN) > 0
        self.first = np.cumsum(self.sizes) - self.sizes

    def taught(self) -> np.ndarray:
        """Whether each token is of a training text."""
        return np.repeat(self.train, self.sizes)

    def bigrams(self) -> np.ndarray:
        """Hash of each token with the one before it, or with the start."""
        h = self.words[self.tokens]
        before = np.empty_like(h)
        before[1:] = h[:-1]
        before[self.first] = _START
        return mix(before * _ODD + h)


def _rows_of(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(j)[i] for j, name in enumerate(batch.schema.names)}


def _chunks_of(batches):
    for row in _rows_of(batches):
        yield _Chunk(row)


def _block_of(keys: np.ndarray, blocks: int) -> np.ndarray:
    """Blocks are equal ranges of the upper 32 bits, so sorted keys fall into runs."""
    return ((keys >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def _cuts(keys: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """(blocks that have some of the sorted keys, where each block starts)."""
    cut = np.searchsorted(_block_of(keys, blocks), np.arange(blocks + 1))
    return np.flatnonzero(np.diff(cut)), cut


def _runs(data: bytes, starts: np.ndarray, ends: np.ndarray, width: int) -> list[bytes]:
    """The keys of each run, ``width`` bytes a key."""
    return [data[a:b] for a, b in zip((starts * width).tolist(), (ends * width).tolist(), strict=True)]


_PIECES = "chunk long, lo long, width int, counts binary"


def _pieces(chunks: list[int], places: list[int], widths: list[int], counts: list[bytes]) -> pa.Table:
    """Replies: ``counts`` of a chunk's keys from place ``lo``, each ``width`` bytes."""
    return pa.table({"chunk": pa.array(chunks, pa.int64()), "lo": pa.array(places, pa.int64()), "width": pa.array(widths, pa.int32()), "counts": _binaries(counts)})


def _binaries(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def _word_counts(streams: DataFrame, blocks: int) -> DataFrame:
    """``(chunk, lo, width, counts)``: corpus-wide training counts of the chunk's words from place ``lo``; chunk -1: (distinct, all) of a block."""

    def send(batches):
        for c in _chunks_of(batches):
            counts = np.bincount(c.tokens[c.taught()], minlength=len(c.words)).astype(np.uint32)
            some, cut = _cuts(c.words, blocks)
            parts = [_binaries(_runs(x.tobytes(), cut[some], cut[some + 1], x.itemsize)) for x in (c.words, counts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array(np.full(len(some), c.name)), pa.array(cut[some]), *parts],
                names=["block", "chunk", "lo", "words", "counts"],
            )

    def reply(got: pa.Table) -> pa.Table:
        words = [np.frombuffer(x, np.uint64) for x in got["words"].to_pylist()]
        distinct, at = np.unique(np.concatenate(words), return_inverse=True)
        total = np.zeros(len(distinct), dtype=np.uint64)
        np.add.at(total, at, np.concatenate([np.frombuffer(x, np.uint32) for x in got["counts"].to_pylist()]).astype(np.uint64))
        stats = np.array([(total > 0).sum(), total.sum()], dtype=np.uint64).tobytes()
        width = 4 if total.max(initial=0) < 1 << 32 else 8
        back = np.split(total.astype(f"<u{width}")[at], np.cumsum([len(w) for w in words])[:-1])
        chunks, places = ([*got[c].to_pylist(), end] for c, end in (("chunk", -1), ("lo", 0)))
        give_back()
        return _pieces(chunks, places, [width] * len(words) + [8], [*(x.tobytes() for x in back), stats])

    sent = streams.mapInArrow(send, "block long, chunk long, lo long, words binary, counts binary")
    return stored(sent.groupBy("block").applyInArrow(reply, _PIECES), "word-counts")


def _pack(keys: np.ndarray) -> bytes:
    """40 bits of each key: with its block they are its name."""
    return np.ascontiguousarray((keys & _KEY).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _unpack(values: list[bytes]) -> np.ndarray:
    packed = np.frombuffer(b"".join(values), np.uint8).reshape(-1, 5)
    wide = np.zeros((len(packed), 8), dtype=np.uint8)
    wide[:, :5] = packed
    return wide.view("<u8").ravel()


def level_of(counts: np.ndarray) -> np.ndarray:
    """Two levels for each power of two: counts from 1, 2, 3, 4, 6, 8, 12, ... have the levels 1, 2, 3, 4, 5, 6, 7, ..."""
    power = np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64)
    return np.where(counts > 0, np.maximum(1, 2 * power + (counts >= 1.5 * np.exp2(power))), 0)


def least_count(levels: np.ndarray) -> np.ndarray:
    """The smallest count of each level, 0 at level 0."""
    return np.where(levels > 1, np.exp2(levels // 2) * (1 + 0.5 * (levels % 2)), levels)


def _places(keys: np.ndarray, level: int, probe: int, size: np.ndarray | np.uint64) -> np.ndarray:
    salt = np.uint64((level * 64 + probe + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return (mix(keys ^ salt) % size).astype(np.int64)


def _filter_segments(streams: DataFrame, blocks: int) -> DataFrame:
    """``(block, bits, filter)``: the log-frequency Bloom filter of each block's bigrams."""

    def message(held: list[np.ndarray]):
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        some, cut = _cuts(keys, blocks)
        more = np.concatenate([[0], np.cumsum(counts > 1)])[cut]  # keys before each cut that were counted more than once
        once = _runs(_pack(keys[counts == 1]), (cut - more)[some], (cut - more)[some + 1], 5)
        often = _runs(_pack(keys[counts > 1]), more[some], more[some + 1], 5)
        times = _runs(counts[counts > 1].astype(np.uint32).tobytes(), more[some], more[some + 1], 4)
        return pa.RecordBatch.from_arrays([pa.array(some), *map(_binaries, (once, often, times))], names=["block", "once", "often", "times"])

    def send(batches):
        held, size = [], 0
        for c in _chunks_of(batches):
            held.append(c.bigrams()[c.taught()])
            size += len(held[-1])
            if size >= SEND_TOKENS:
                yield message(held)
                held, size = [], 0
        if size:
            yield message(held)
        held = []
        give_back()

    def build(got: pa.Table) -> pa.Table:
        once = _unpack(got["once"].to_pylist())
        keys = np.concatenate([once, _unpack(got["often"].to_pylist())])
        counts = np.concatenate([np.ones(len(once), np.int64), np.frombuffer(b"".join(got["times"].to_pylist()), np.uint32).astype(np.int64)])
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, levels = keys[start], level_of(np.add.reduceat(counts, start))
        size = max(64, -(-int(levels.sum()) * ENTRY_BITS // 64) * 64)
        bits = np.zeros(size, dtype=bool)
        for level in range(1, int(levels.max()) + 1):
            mine = keys[levels >= level]
            for probe in range(PROBES):
                bits[_places(mine, level, probe, np.uint64(size))] = True
        packed = np.packbits(bits).tobytes()
        del once, keys, counts, order, start, levels, bits
        give_back()
        return pa.table({"block": got["block"].slice(0, 1), "bits": pa.array([size], pa.int64()), "filter": _binaries([packed])})

    sent = streams.mapInArrow(send, "block long, once binary, often binary, times binary")
    return stored(sent.groupBy("block").applyInArrow(build, "block long, bits long, filter binary"), "bigram-filter")


class LogFrequencyFilter:
    """Segments of some blocks; other blocks' bigrams are never found in it."""

    def __init__(self, blocks: int, segments: list[tuple[int, int, bytes]]):
        self.blocks = blocks
        self.size, self.start = np.zeros(blocks, dtype=np.uint64), np.zeros(blocks, dtype=np.int64)
        self.data = np.empty(sum(bits // 8 for _, bits, _ in segments), dtype=np.uint8)
        at = 0
        for block, bits, data in segments:
            self.size[block], self.start[block] = bits, at
            self.data[at : at + bits // 8] = np.frombuffer(data, np.uint8)
            at += bits // 8

    def levels(self, bigrams: np.ndarray) -> np.ndarray:
        """Level of each bigram."""
        return self.levels_in(_block_of(bigrams, self.blocks), bigrams)

    def levels_in(self, block: np.ndarray, bigrams: np.ndarray) -> np.ndarray:
        """Level of each bigram (its 40 bits are enough): probes with 1, 2, ... up to the first miss; 0: not held."""
        found = np.zeros(len(bigrams), dtype=np.int64)
        live = np.flatnonzero(self.size[block] > 0)
        keys, size, start = bigrams[live] & _KEY, self.size[block[live]], self.start[block[live]]
        level = 0
        while len(live):
            level += 1
            for probe in range(PROBES):
                at = _places(keys, level, probe, size)
                hit = np.flatnonzero(self.data[start + (at >> 3)] >> (7 - (at & 7)).astype(np.uint8) & 1)
                if len(hit) < len(live):
                    live, keys, size, start = live[hit], keys[hit], size[hit], start[hit]
            found[live] = level
        return found


def _asked_levels(streams: DataFrame, segments: DataFrame, blocks: int, per: int) -> DataFrame:
    """``(chunk, lo, width, counts)``: levels of the chunk's sorted distinct bigrams from place ``lo``, asked of the segments where they lie.

    ``per`` blocks are a range, and a range a task.  A chunk asks a range with one row, so rows do not grow with the
    blocks; ``sizes`` says how many of its keys each block has.  Segments come first, and what is asked streams past them.
    """
    ranges = -(-blocks // per)

    def ask(batches):
        for c in _chunks_of(batches):
            keys = np.sort(c.bigrams())
            keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]  # np.unique without an inverse hashes, several times as slow
            _, cut = _cuts(keys, blocks)
            cut = np.concatenate([cut, np.full(ranges * per - blocks, cut[-1])])
            start, sizes = cut[::per], np.diff(cut).astype(np.uint32)
            some = np.flatnonzero(np.diff(start))
            parts = (_runs(sizes.tobytes(), some * per, (some + 1) * per, 4), _runs(_pack(keys), start[some], start[some + 1], 5))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array(np.full(len(some), c.name)), pa.array(start[some]), *map(_binaries, parts)], names=["range", "chunk", "lo", "sizes", "keys"]
            )

    def answer(batches):
        segments, held = [], None
        for batch in batches:
            n = batch.column("chunk").null_count
            segments += [(r["block"], r["bits"], r["filter"]) for r in batch.slice(0, n).to_pylist()]
            asked = batch.slice(n)
            if not asked.num_rows:
                continue
            held = held or LogFrequencyFilter(blocks, segments)
            segments = []
            sizes = np.frombuffer(b"".join(asked.column("sizes").to_pylist()), np.uint32).reshape(-1, per)
            block = np.tile(np.arange(per), len(sizes)) + np.repeat(asked.column("range").to_numpy() * per, per)
            names = _unpack(asked.column("keys").to_pylist()) | np.repeat(block.astype(np.uint64) << np.uint64(40), sizes.ravel())
            names, at = np.unique(names, return_inverse=True)
            level = held.levels_in((names >> np.uint64(40)).astype(np.int64), names).astype(np.uint8)[at]
            end = np.cumsum(sizes.sum(axis=1, dtype=np.int64))
            found = _runs(level.tobytes(), np.concatenate([[0], end[:-1]]), end, 1)
            yield from _pieces(asked.column("chunk").to_pylist(), asked.column("lo").to_pylist(), [1] * len(found), found).to_batches()
        give_back()

    asked = streams.mapInArrow(ask, "range long, chunk long, lo long, sizes binary, keys binary")
    met = segments.withColumn("range", F.floor(F.col("block") / per)).unionByName(asked, allowMissingColumns=True)
    met = met.repartitionById(ranges, F.col("range").cast("int")).sortWithinPartitions(F.col("chunk").asc_nulls_first())
    return stored(met.mapInArrow(answer, _PIECES), "bigram-levels")


def _joined(streams: DataFrame, replies: DataFrame, name: str) -> DataFrame:
    """Each chunk with the pieces that came back for it."""
    pieces = replies.where("chunk >= 0").groupBy("chunk").agg(F.collect_list(F.struct("lo", "width", "counts")).alias(name))  # those of one chunk
    return streams.join(pieces, "chunk")


def _gathered(pieces: pa.Scalar, size: int) -> np.ndarray:
    out = np.zeros(size, dtype=np.int64)
    for lo, width, counts in zip(*(pieces.values.field(n).to_pylist() for n in ("lo", "width", "counts")), strict=True):
        got = np.frombuffer(counts, f"<u{width}")
        out[lo : lo + len(got)] = got
    return out


def lm_scores(df: DataFrame, is_train: Column, doc_id: str = "doc_id", text: str = "text", prior: float = PRIOR, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``df``.

    Tokens are words cut at white space with A-Z lower-cased, then one end.
    ``base_score`` is the exact add-0.1 unigram log10 probability, ``n_known``
    counts tokens seen in training.  ``score`` is the sum over tokens of
    ``log10((k + prior*p(w)) / (c(v) + prior))``: ``p`` the same unigram,
    ``k`` the least count of the filter's level for the bigram ``v w``, at most
    ``c(v)``, the count of the word before (of training texts at a text's
    start).  But for the filter's false positives (about 1 % of unseen
    bigrams) the probabilities of a context sum to at most 1, and a context that
    was never seen leaves the unigram alone.

    Every training bigram is entered.  Null and empty texts are an end alone; a
    very long text is a chunk of its own.  A null ``is_train`` counts as false;
    without training rows all is unknown.  Repeated rows are each scored and
    each taught; a null id stays null; other columns of ``df`` play no part; an
    empty table gives no rows.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    docs = df.select(F.col(f"`{doc_id}`").cast("long"), F.coalesce(is_train, F.lit(False)), F.col(f"`{text}`"))
    streams = _streams(docs)
    size = streams.agg(F.sum(F.octet_length("words") / 8), F.sum(F.octet_length("tokens") / 2)).first()
    word_blocks, pair_blocks = (max(16, -(-int(x or 0) // BLOCK_KEYS)) for x in size)
    counts = _word_counts(streams, word_blocks)

    def sums(batches):
        for r in _rows_of(batches):
            v, n = np.frombuffer(r["counts"].as_buffer(), np.uint64)
            yield pa.RecordBatch.from_pylist([{"v": int(v), "n": int(n)}])

    def texts(batches):
        for r in _rows_of(batches):
            yield pa.RecordBatch.from_pylist([{"n": int((np.frombuffer(r["flags"].as_buffer(), np.uint8) & _TRAIN).sum())}])

    totals = counts.where("chunk = -1").select("counts").mapInArrow(sums, "v long, n long").agg(F.sum("v"), F.sum("n")).first()
    distinct, total = int(totals[0] or 0), int(totals[1] or 0)
    starts = int(streams.select("flags").mapInArrow(texts, "n long").agg(F.sum("n")).first()[0] or 0)

    segments = _filter_segments(streams, pair_blocks)
    told = _joined(streams, counts, "counts")
    shipped = None
    held = segments.agg(F.sum(F.octet_length("filter"))).first()[0] or 0
    if held <= broadcast_bytes:
        parts = [(r["block"], r["bits"], bytes(r["filter"])) for r in segments.toLocalIterator()]  # at most broadcast_bytes in all
        shipped = spark.sparkContext.broadcast(LogFrequencyFilter(pair_blocks, parts))
        del parts
    else:
        per = max(1, min(pair_blocks * RANGE_BYTES // held, pair_blocks // RANGES))
        told = _joined(told, _asked_levels(streams, segments, pair_blocks, per), "levels")
    found = stored(_score(told, shipped, prior, distinct, total, starts), "lm-scores")  # now, so that workers let the filter go
    if shipped is not None:
        shipped.destroy()
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def _score(told: DataFrame, shipped, prior: float, distinct: int, total: int, starts: int) -> DataFrame:
    norm = total + 0.1 * (distinct + 1)

    def run(batches):
        for row in _rows_of(batches):
            c = _Chunk(row)
            count = _gathered(row["counts"], len(c.words))
            p = ((count + 0.1) / norm)[c.tokens]
            before = np.empty(len(c.tokens), dtype=np.int64)
            before[1:] = count[c.tokens[:-1]]
            before[c.first] = starts
            names, at = np.unique(c.bigrams(), return_inverse=True)
            level = (shipped.value.levels(names) if shipped is not None else _gathered(row["levels"], len(names)))[at]
            held = np.minimum(least_count(level), before)
            score = np.log10((held + prior * p) / (before + prior))
            known = (count > 0)[c.tokens].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.ids, mask=(c.flags & _NO_ID) > 0), pa.array(~c.train), pa.array(c.sizes), *(pa.array(np.add.reduceat(x, c.first)) for x in (known, np.log10(p), score))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
            )

    return told.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
