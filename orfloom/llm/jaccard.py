"""N-gram Jaccard join as a blocked sparse product, and the classes it links.

Rows of the sparse matrix are documents (one for each distinct set of word
n-grams), columns are n-grams.  Two sets of sizes a <= b with a Jaccard
coefficient of at least t share at least ``t/(1+t)*(a+b)`` n-grams, so they
share one among the first ``a - ceil(t*a) + 1`` of each in any common order.
The order puts frequent n-grams last (by a count sketch over all documents), so
that a passage which many documents share makes no long columns.

1. *Sets*: number and 64-bit name of each document's distinct n-grams (copies
   collapse there), and the count sketch: a pass over the texts.
2. *Prefixes*: a written row for each set with its prefix n-grams in order: a
   second pass.  All columns come from this table.
3. *Columns*: prefix n-grams that at least two rows of that table have, with
   the places of those n-grams in the sets that have them.
4. *Few*: columns of few sets are joined with themselves and overlaps are
   accumulated; pairs under the size-derived bound are discarded.
5. *Hubs*: in every column of many sets each set is paired with hubs of its size
   class, those it shares most columns with, where these could be enough.  That
   joins large groups of near copies without their pairs.
6. *Links*: the pairs of 4 and 5 are counted exactly on the whole sets, which a
   third pass over the texts reads for the sets of these pairs.
7. *Blocks*: columns of many sets that still hold several components are
   multiplied in dense blocks; pairs that could be enough and are not connected
   are counted like those before.  Only where there are any, the texts are read
   a fourth time.
8. Connected components over all exact links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orfloom.llm.components import components
from orfloom.llm.storage import bounded_batches, give_back, stored
from orfloom.llm.text import SPACE_WORDS, hashed_words, mix, slices

#: Counters of the sketch, broadcast: a fixed size.
SKETCH_BITS = 22
_BLOCK = 1 << 16
#: Bits of a filter: 16 for each key, at most 2^27 (16 MB); a key's bits lie in one block of 2^13.
LEAST_FILTER_BITS, MOST_FILTER_BITS, _FILTER_BLOCK = 19, 27, 13
#: Hubs of a set in the columns of many sets.
HUB_ROUNDS = 2
#: A column of more sets is hot: it goes to hubs and then is multiplied in dense blocks of so many rows.
DENSE_COLUMN, BLOCK_ROWS = 64, 512
_STEP = np.uint64(0x9FB21C651E98DF25)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each row's ``size``-word shingles; fewer words are one shingle, none give none."""
    words, first = hashed_words(raw, offsets, SPACE_WORDS)
    m = max(0, len(words) - size + 1)
    whole = np.zeros(m, dtype=np.uint64)
    for j in range(size):
        whole = whole * _STEP + words[j : j + m]
    whole = mix(whole)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            s = np.sort(whole[a : b - size + 1])
            new = s[1:] != s[:-1]
            yield s if new.all() else np.concatenate([s[:1], s[1:][new]])
        elif b == a:
            yield np.zeros(0, np.uint64)
        else:
            one = np.full(1, b - a, dtype=np.uint64)
            for w in words[a:b]:
                one = one * _STEP + w
            yield mix(one ^ _STEP)


def set_name(s: np.ndarray) -> int:
    """64-bit name of a set of hashes."""
    total, every = s.sum(dtype=np.uint64, keepdims=True), np.bitwise_xor.reduce(s, keepdims=True)
    return int(mix(total ^ (every * _STEP) ^ np.uint64(len(s))).view(np.int64)[0])


def prefix_length(n: int, num: int, den: int) -> int:
    return n - -(-num * n // den) + 1


_SETS = "doc_id long, n long, sid long, block int, counts binary"


def _read_sets(docs: DataFrame, size: int) -> DataFrame:
    """A row for each document, and each task's part of the sketch in blocks."""

    def run(batches):
        sketch = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        seen = False
        for batch in batches:
            n, names = [], []
            for _, _, raw, offsets in slices(batch.column(1)):
                for s in shingle_sets(raw, offsets, size):
                    seen = True
                    n.append(len(s))
                    names.append(set_name(s) if len(s) else None)
                    sketch[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)] += np.uint32(1)  # a set's counters, once each
            rows = len(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(names, pa.int64()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())],
                names=["doc_id", "n", "sid", "block", "counts"],
            )
        if seen:
            parts = np.minimum(sketch, 255).astype(np.uint8).reshape(-1, _BLOCK)
            none = pa.nulls(len(parts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, none, pa.array(np.arange(len(parts), dtype=np.int32)), pa.array([p.tobytes() for p in parts], pa.binary())],
                names=["doc_id", "n", "sid", "block", "counts"],
            )
        give_back()

    return stored(docs.mapInArrow(run, _SETS), "shingle-sets")


def _order_classes(parts: DataFrame) -> np.ndarray:
    """Class of each counter: how often its n-grams occur, in half powers of two."""

    def merge(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if block not in total:
                    total[block] = np.zeros(_BLOCK, dtype=np.uint64)
                total[block] += np.frombuffer(counts, np.uint8)
        for block, counts in total.items():
            classes = np.minimum(2 * np.log2(np.maximum(counts, 1)), 127).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([classes.tobytes()], pa.binary())], names=["block", "classes"])

    out = np.zeros((1 << SKETCH_BITS) // _BLOCK * _BLOCK, dtype=np.uint8).reshape(-1, _BLOCK)
    for row in parts.repartition(len(out), "block").mapInArrow(merge, "block int, classes binary").collect():  # a fixed size in all
        out[row["block"]] = np.frombuffer(row["classes"], np.uint8)
    return out.ravel()


def ordered_prefix(s: np.ndarray, classes: np.ndarray, num: int, den: int) -> np.ndarray:
    """Order keys of a set's prefix, ascending: 7 bits of frequency class, then 56 of the hash."""
    key = (classes[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (s & np.uint64((1 << 56) - 1))
    k = prefix_length(len(s), num, den)
    return np.sort(np.partition(key, k - 1)[:k] if k < len(key) else key)


def _prefixes(docs: DataFrame, size: int, num: int, den: int, classes) -> DataFrame:
    """``(sid, n, keys)``: the prefix of each set, ascending; a task gives each set once."""

    def run(batches):
        seen: set[int] = set()
        order = classes.value
        for batch in batches:
            names, sizes, keys = [], [], []
            for _, _, raw, offsets in slices(batch.column(1)):
                for s in shingle_sets(raw, offsets, size):
                    if len(s) and (sid := set_name(s)) not in seen:
                        seen.add(sid)
                        names.append(sid)
                        sizes.append(len(s))
                        keys.append(ordered_prefix(s, order, num, den).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), _lists(keys, pa.int64())], names=["sid", "n", "keys"])
        give_back()

    return stored(docs.mapInArrow(run, "sid long, n long, keys array<long>"), "shingle-prefixes")


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), pa.array(flat, kind))


def _bits(keys: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block of each key in a filter of 2^width bits, and its two places in the block."""
    m = mix(keys)
    low = np.uint64((1 << _FILTER_BLOCK) - 1)
    return (m >> np.uint64(64 - width + _FILTER_BLOCK)).astype(np.int64), (m & low).astype(np.int64), (m >> np.uint64(_FILTER_BLOCK) & low).astype(np.int64)


def _in_filter(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    block, one, two = _bits(keys, (len(bits) * 8).bit_length() - 1)
    one, two = (block << _FILTER_BLOCK) + one, (block << _FILTER_BLOCK) + two
    return (bits[one >> 3] >> (7 - (one & 7)) & 1) & (bits[two >> 3] >> (7 - (two & 7)) & 1)


def _column_filter(keys: DataFrame) -> np.ndarray:
    """A Bloom filter over all keys, of bounded size; exact membership is settled by a join later."""
    width = min(max(LEAST_FILTER_BITS, (16 * keys.count()).bit_length()), MOST_FILTER_BITS)
    size = 1 << _FILTER_BLOCK

    def dealt(batches):
        for batch in batches:
            k = np.unique(batch.column(0).to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(_bits(k, width)[0].astype(np.int32)), pa.array(k.view(np.int64))], names=["block", "key"])

    def build(batches):
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            block, one, two = _bits(batch.column(1).to_numpy().view(np.uint64), width)
            names, at = np.unique(block, return_inverse=True)
            flags = np.zeros((len(names), size), dtype=bool)
            flags[at, one] = flags[at, two] = True
            for b, f in zip(names.tolist(), np.packbits(flags, axis=1), strict=True):
                blocks[b] = blocks[b] | f if b in blocks else f
        yield pa.RecordBatch.from_arrays([pa.array(list(blocks), pa.int32()), pa.array([f.tobytes() for f in blocks.values()], pa.binary())], names=["block", "bits"])

    out = np.zeros(((1 << width) // size, size // 8), dtype=np.uint8)
    parts = keys.select("key").mapInArrow(dealt, "block int, key long").repartition(min(len(out), max(64, len(out) >> 4)), "block")
    for row in parts.mapInArrow(build, "block int, bits binary").collect():  # at most 16 MB in all
        out[row["block"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def _rows(prefixes: DataFrame, columns) -> DataFrame:
    """Sets with a prefix n-gram in the filter: those keys with their place, and the last prefix key."""

    def run(batches):
        bits = columns.value
        for batch in batches:
            lists = batch.column(2)
            where = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.values.to_numpy(zero_copy_only=False)[where[0] : where[-1]].view(np.uint64)
            where = where - where[0]
            held = np.flatnonzero(_in_filter(bits, flat))
            row = np.searchsorted(where, held, "right") - 1
            some, start = np.unique(row, return_index=True)
            cut = pa.array(np.append(start, len(held)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(some)), batch.column(1).take(pa.array(some)), pa.array(flat[where[some + 1] - 1].view(np.int64)),
                 pa.ListArray.from_arrays(cut, pa.array(flat[held].view(np.int64))), pa.ListArray.from_arrays(cut, pa.array((held - where[row]).astype(np.int32)))],
                names=["sid", "n", "last", "keys", "places"],
            )

    found = prefixes.mapInArrow(run, "sid long, n long, last long, keys array<long>, places array<int>")
    return found.dropDuplicates(["sid"])  # a set that several tasks met is one row


def _contents(docs: DataFrame, size: int, ids) -> DataFrame:
    """``(sid, content)`` of the sets of the documents whose id is in the filter or null; a task gives each set once."""

    def run(batches):
        seen: set[int] = set()
        bits = ids.value
        for batch in batches:
            known = pc.fill_null(batch.column(0), 0).to_numpy(zero_copy_only=False).view(np.uint64)
            batch = batch.filter(pa.array(_in_filter(bits, known).astype(bool) | np.asarray(batch.column(0).is_null())))
            for _, _, raw, offsets in slices(batch.column(1)):
                sids, contents = [], []
                for s in shingle_sets(raw, offsets, size):
                    if len(s) and (sid := set_name(s)) not in seen:
                        seen.add(sid)
                        sids.append(sid)
                        contents.append(s.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), pa.array(contents, pa.binary())], names=["sid", "content"])
        give_back()

    return stored(docs.mapInArrow(run, "sid long, content binary"), "shingle-contents")


def _linked(pairs: DataFrame, docs: DataFrame, members: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Pairs ``(a, b)`` whose sets meet the threshold, counted exactly; only sets of the pairs are read, each from one document."""
    pairs = stored(pairs, "pairs")
    named = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    read = stored(members.join(named, "sid", "left_semi").groupBy("sid").agg(F.min("doc_id").alias("key")).where("key is not null"), "pair-documents")
    ids = docs.sparkSession.sparkContext.broadcast(_column_filter(read))
    sets = _contents(docs, size, ids).dropDuplicates(["sid"])  # by the exchange of the joins
    ids.destroy()
    left = pairs.join(sets.select(F.col("sid").alias("a"), F.col("content").alias("x")), "a")
    both = left.join(sets.select(F.col("sid").alias("b"), F.col("content").alias("y")), "b").select("a", "b", "x", "y")

    def run(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                shared = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                keep[i] = den * shared >= num * (len(x) + len(y) - shared)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))
        give_back()

    return stored(both.mapInArrow(run, "a long, b long"), "links")


def _labelled(columns: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Columns with the component of each set; only those where two components still meet."""
    if labels is None:
        return columns.withColumn("comp", F.col("sid"))
    named = columns.join(labels.withColumnRenamed("node", "sid"), "sid", "left").withColumn("comp", F.coalesce("component", "sid")).drop("component")
    open_keys = named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    return stored(named.join(open_keys, "key"), "columns")


def _rest(n: Column, num: int, den: int) -> Column:
    """N-grams of a set behind its prefix."""
    return F.ceil(n * num / den - F.lit(1e-9)) - 1


def _enough(num: int, den: int) -> tuple[Column, Column]:
    """(overlap that sizes ``n_a``, ``n_b`` need, most n-grams that a pair can share behind the prefix that ends first)."""
    need = F.ceil((F.col("n_a") + F.col("n_b")) * num / (num + den) - F.lit(1e-9))
    return need, F.when(F.col("last_a") <= F.col("last_b"), _rest(F.col("n_a"), num, den)).otherwise(_rest(F.col("n_b"), num, den))


def _hub_pairs(columns: DataFrame, turn: int, num: int, den: int) -> DataFrame:
    """For each set the hub, of its own or the next smaller size class, that it shares most columns with, if those could be enough.

    The hub of a column is at turn 0 its best connected set, the likely original
    of near copies; at other turns a pseudo-random one.
    """
    if turn == 0:
        columns = columns.join(columns.groupBy("sid").agg((-F.sum("m")).alias("h")), "sid")
    else:
        columns = columns.withColumn("h", F.xxhash64("sid", F.lit(turn)))
    hubs = columns.groupBy("key", "bucket").agg(F.min(F.struct("h", "sid", "comp", "n", "last")).alias("hub"))
    hubs = hubs.select("key", "bucket", *(F.col(f"hub.{c}").alias(f"{c}_a") for c in ("sid", "comp", "n", "last")))
    wide = hubs.unionByName(hubs.withColumn("bucket", F.col("bucket") + 1))
    rows = columns.select("key", "bucket", *(F.col(c).alias(f"{c}_b") for c in ("sid", "comp", "n", "last")))
    pairs = rows.join(wide, ["key", "bucket"]).where("comp_a <> comp_b").groupBy("sid_b", "sid_a", "n_a", "n_b", "last_a", "last_b").agg(F.count("*").alias("shared"))
    need, behind = _enough(num, den)
    best = pairs.where(F.col("shared") + behind >= need).groupBy("sid_b").agg(F.max(F.struct("shared", "sid_a")).alias("best"))
    return best.select(F.col("best.sid_a").alias("a"), F.col("sid_b").alias("b"))


def _few_pairs(columns: DataFrame, hot: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs proposed by columns of few sets, their overlaps accumulated; hot columns count as if shared.

    The first n-gram that a pair shares has the whole overlap ahead of it.
    """

    def side(name: str) -> DataFrame:
        return columns.select("key", *(F.col(c).alias(f"{c}_{name}") for c in ("sid", "n", "place", "last")))

    need, behind = _enough(num, den)
    ahead = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    both = (
        side("a").join(side("b"), "key")
        .where("n_a < n_b or (n_a = n_b and sid_a < sid_b)")  # each pair once, the smaller set first
        .where((F.col("n_a") * den >= F.col("n_b") * num) & (ahead + F.least("place_a", "place_b") >= need))
    )
    counted = both.groupBy("sid_a", "sid_b", "n_a", "n_b", "last_a", "last_b").agg(F.count("*").alias("shared"), F.max(ahead).alias("ahead")).where(F.col("ahead") >= need)
    most = hot.groupBy("sid").agg(F.count("*").alias("hot"))
    for x in "ab":
        counted = counted.join(most.select(F.col("sid").alias(f"sid_{x}"), F.col("hot").alias(f"hot_{x}")), f"sid_{x}", "left")
    hidden = F.least(F.coalesce("hot_a", F.lit(0)), F.coalesce("hot_b", F.lit(0)))
    return counted.where(F.col("shared") + hidden + behind >= need).select(F.col("sid_a").alias("a"), F.col("sid_b").alias("b"))


def _many_pairs(hot: DataFrame, rows: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of different components proposed by columns of many sets: dense blocks are multiplied inside tasks.

    A pair is proposed by its first common column alone, with its overlap over all columns.
    """
    sizes = hot.groupBy("key").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    many = hot.select("key", "sid", "comp").join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
    many = many.join(rows.select("sid", "n", "last", "keys", "places"), "sid").select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    many = many.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))

    def multiply(frame: pd.DataFrame) -> pd.DataFrame:
        key, i, j = (int(frame[c].iloc[0]) for c in ("key", "i", "j"))
        found = _block_product(frame[frame["block"] == i], frame[frame["block"] == j], i == j, key, num, den)
        give_back()
        return pd.DataFrame(found, columns=["a", "b"])

    return many.groupBy("key", "i", "j").applyInPandas(multiply, "a long, b long")


def _block_product(x: pd.DataFrame, y: pd.DataFrame, same: bool, key: int, num: int, den: int) -> np.ndarray:
    """Pairs of two blocks of rows, by sums of columns: overlaps up to and before ``key``."""
    if not len(x) or not len(y):  # a block that the hash left empty
        return np.zeros((0, 2), dtype=np.int64)
    names = np.unique(np.concatenate([np.concatenate(f["keys"].to_list()) for f in (x, y)]))

    def dense(f: pd.DataFrame, lo: int, hi: int) -> np.ndarray:
        out = np.zeros((len(f), hi - lo), dtype=np.float32)
        for r, keys in enumerate(f["keys"]):
            at = np.searchsorted(names, keys)
            out[r, at[(at >= lo) & (at < hi)] - lo] = 1
        return out

    def place(f: pd.DataFrame) -> np.ndarray:
        return np.array([p[np.searchsorted(k, key)] for k, p in zip(f["keys"], f["places"], strict=True)], dtype=np.int64)

    total, before = (np.zeros((len(x), len(y)), dtype=np.float32) for _ in range(2))
    split = int(np.searchsorted(names, key))
    for lo in range(0, len(names), 2048):
        hi = min(lo + 2048, len(names))
        a, b = dense(x, lo, hi), dense(y, lo, hi)
        total += a @ b.T
        if split > lo:
            before += a[:, : split - lo] @ b[:, : split - lo].T
    nx, ny = x["n"].to_numpy()[:, None], y["n"].to_numpy()[None, :]
    need = -(-(nx + ny) * num // (num + den))
    rest_x, rest_y = -(-nx * num // den) - 1, -(-ny * num // den) - 1
    behind = np.where(x["last"].to_numpy()[:, None] <= y["last"].to_numpy()[None, :], rest_x, rest_y)
    ahead = np.minimum(nx - place(x)[:, None], ny - place(y)[None, :])
    ok = (before == 0) & (ahead >= need) & (total + behind >= need) & (np.minimum(nx, ny) * den >= np.maximum(nx, ny) * num)
    ok &= x["comp"].to_numpy()[:, None] != y["comp"].to_numpy()[None, :]
    if same:
        ok &= np.triu(np.ones(ok.shape, dtype=bool), 1)
    r, c = np.nonzero(ok)
    return np.column_stack([x["sid"].to_numpy()[r], y["sid"].to_numpy()[c]])


def jaccard_classes(
    df: DataFrame, size: int = 5, threshold: tuple[int, int] = (75, 100), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``df``.

    Words are cut at white space with A-Z lower-cased; a text's set is its
    distinct ``size``-word shingles, the whole sequence if it has fewer words.
    Texts are linked when ``den * |x & y| >= num * |x | y|`` for ``threshold =
    (num, den)``; ``component_id`` is the smallest id reachable by links.  Null,
    empty and blank texts have an empty set and are linked with nothing, not
    even each other.  Repeated rows are copies of each other.  A row with a
    null id gets the class of its text.  Other columns of ``df`` play no part;
    an empty table gives no rows.
    """
    num, den = threshold
    spark = df.sparkSession
    bounded_batches(spark)
    docs = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    read = _read_sets(docs, size)
    members = read.where("block is null").select("doc_id", "n", "sid")
    classes = spark.sparkContext.broadcast(_order_classes(read.where("block is not null").select("block", "counts")))
    prefixes = _prefixes(docs, size, num, den, classes)
    classes.destroy()
    counts = prefixes.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("m"))
    shared = stored(counts.where("m > 1"), "shared-columns")  # a set that several tasks met counts as several; alone in a column it has no pair
    bits = spark.sparkContext.broadcast(_column_filter(shared))
    rows = stored(_rows(prefixes, bits), "shingle-rows")
    bits.destroy()
    bucket = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(den / num))).cast("int")
    flat = rows.select("sid", "n", "last", F.explode(F.arrays_zip("keys", "places")).alias("k")).select(
        "sid", "n", "last", F.col("k.keys").alias("key"), F.col("k.places").alias("place"), bucket.alias("bucket")
    )
    columns = stored(flat.join(shared, "key"), "columns")
    few, hot = columns.where(F.col("m") <= DENSE_COLUMN), columns.where(F.col("m") > DENSE_COLUMN)
    still = _labelled(hot, None)
    pairs = [_few_pairs(few, hot, num, den), *(_hub_pairs(still, turn, num, den) for turn in range(HUB_ROUNDS))]
    links = _linked(_all(pairs).distinct(), docs, members, size, num, den)
    labels = components(links)
    still = _labelled(still.drop("comp"), labels)
    if not still.isEmpty():
        links = links.unionByName(_linked(_many_pairs(still, rows, num, den).distinct(), docs, members, size, num, den))
        labels = components(links)
    named = members.join(labels.withColumnRenamed("node", "sid"), "sid", "left").select("doc_id", "n", "sid", F.coalesce("component", "sid").alias("comp"))
    least = named.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("least"))
    return named.join(least, "comp", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
