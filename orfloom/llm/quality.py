"""Quality classifier by co-training of a text view and a metadata view.

Two logistic classifiers see different things: the words, characters and lines
of a text, and what is known about the page beside it (language, source, size as
its table has them).  In each round either one labels the documents that it is surest of, and
the other learns from them.  Both are then calibrated on labelled rows that
neither has seen, combined, and every document is scored in a narrow pass.

The labels are a bounded sample (``LABELLED_ROWS``), fitted on the driver.  The
documents without one are all taken: their features are a written table, and
counts of scores, moments, gradients and Hessians are summed over it in tasks.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orfloom.llm.storage import bounded_batches, stored
from orfloom.llm.text import LOWER, SPACE_WORDS, free_name, slices, span_hashes, word_spans

#: Most labelled rows (about) that the fit takes: a documented bound, the same at every size.
LABELLED_ROWS = 8000
ROUNDS, SURE, SHARE = 3, 0.95, 0.1
NEWTON_STEPS = 15
#: Steps of the counted scores (logits, -30 to 30) and tasks that add up partial sums.
_STEPS, _SUM_TASKS = 60_000, 16
_WORD_BUCKETS, _SOURCE_BUCKETS, _LANG_BUCKETS = 128, 32, 16
_LINES = np.ones(256, dtype=bool)
_LINES[0x0A] = False


def _classes() -> np.ndarray:
    """Class of each byte: letter, upper case, digit, white space, common mark, other mark."""
    out = np.full(256, 5, dtype=np.uint8)
    out[128:] = 0
    for lo, hi, k in (("a", "z", 0), ("A", "Z", 1), ("0", "9", 2)):
        out[ord(lo) : ord(hi) + 1] = k
    out[[9, 10, 11, 12, 13, 32]] = 3
    out[[ord(c) for c in ".,;:!?'\"-()"]] = 4
    return out


_CLASSES = _classes()


def _per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(np.float64)


def _distinct(hashes: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    order = np.lexsort((hashes, row))
    h, r = hashes[order], row[order]
    first = np.ones(len(h), dtype=bool)
    first[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return np.bincount(r[first], minlength=rows).astype(np.float64)


def text_view(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Features of a slice's texts: characters, words, lines, and a hashed bag of words."""
    rows = len(offsets) - 1
    size = np.maximum(1, np.diff(offsets)).astype(np.float64)
    low = LOWER[raw]
    starts, ends, first = word_spans(low, offsets, SPACE_WORDS)
    n = np.diff(first)
    row = np.repeat(np.arange(rows), n)
    hashes = span_hashes(low, starts, ends)
    words = np.maximum(1, n).astype(np.float64)
    kinds = _CLASSES[raw]
    shares = [_per_row(kinds == k, offsets) / size for k in range(6)]
    long = (ends - starts).astype(np.float64)
    last = _CLASSES[raw[ends - 1]] if len(ends) else np.zeros(0, np.uint8)
    text = [*shares, _per_row(long, first) / words, _per_row(long == 1, first) / words, _per_row(last == 5, first) / words, _per_row(last == 4, first) / words, _distinct(hashes, row, rows) / words]
    a, b, line = word_spans(raw, offsets, _LINES)
    m = np.diff(line)
    lines = np.maximum(1, m).astype(np.float64)
    at = np.repeat(np.arange(rows), m)
    closed = np.isin(raw[b - 1], [ord(c) for c in ".!?"]) if len(b) else np.zeros(0, bool)
    text += [np.log1p(m), _per_row((b - a).astype(np.float64), line) / lines, _distinct(span_hashes(raw, a, b), at, rows) / lines, _per_row(closed, line) / lines]
    bag = np.bincount(row * _WORD_BUCKETS + (hashes % np.uint64(_WORD_BUCKETS)).astype(np.int64), minlength=rows * _WORD_BUCKETS).reshape(rows, -1) / words[:, None]
    return np.column_stack([*text, bag])


def meta_view(lang: pa.Array, source: pa.Array, size: pa.Array) -> np.ndarray:
    """Features of what the table says: hashed language and source (null: the empty one), size and whether it is known."""

    def bucket(column: pa.Array, buckets: int) -> np.ndarray:
        coded = pc.fill_null(column, "").dictionary_encode()
        names = np.array([zlib.crc32(x.encode()) % buckets for x in coded.dictionary.to_pylist()], dtype=np.int64)
        return np.eye(buckets)[names[coded.indices.to_numpy()]] if len(column) else np.zeros((0, buckets))

    known = np.asarray(size.is_valid()).astype(np.float64)
    number = np.nan_to_num(pc.fill_null(size, 0).to_numpy(zero_copy_only=False), posinf=0, neginf=0)
    return np.column_stack([np.log1p(np.maximum(number, 0)), known, bucket(lang, _LANG_BUCKETS), bucket(source, _SOURCE_BUCKETS)])


class Logistic:
    """Ridge logistic regression on standardised columns, by Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = NEWTON_STEPS):
        self.start(x.mean(0), x.std(0), ridge)
        for _ in range(rounds):
            if self.step(self.derivatives(x, y)):
                break

    def start(self, mean: np.ndarray, deviation: np.ndarray, ridge: float = 1.0) -> None:
        self.mean, self.scale = mean, np.maximum(deviation, 1e-9)
        self.weights = np.zeros(len(mean) + 1)
        self.penalty = np.full(len(mean) + 1, ridge)
        self.penalty[-1] = 1e-6

    @classmethod
    def at(cls, mean: np.ndarray, deviation: np.ndarray) -> Logistic:
        """Not yet fitted: ``step`` takes sums that were made elsewhere."""
        model = cls.__new__(cls)
        model.start(mean, deviation)
        return model

    def derivatives(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Gradient and Hessian of the rows, in one flat array: sums over parts add up."""
        z = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])
        p = 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))
        return np.concatenate([z.T @ (y - p), ((z * (p * (1 - p))[:, None]).T @ z).ravel()])

    def step(self, sums: np.ndarray) -> bool:
        n = len(self.weights)
        step = np.linalg.solve(sums[n:].reshape(n, n) + np.diag(self.penalty), sums[:n] - self.penalty * self.weights)
        self.weights = self.weights + step
        return bool(np.abs(step).max() < 1e-6)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1], -30, 30)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class QualityModel:
    """Two views, their calibrations and the combination; without two classes only the base rate.

    ``given``: pseudo-labels that either view had from the other when it was last fitted.
    """

    base: float
    views: tuple[Logistic, Logistic] | None = None
    calibration: tuple[Logistic, Logistic] | None = None
    combination: Logistic | None = None
    given: tuple[int, int] = (0, 0)

    def score(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.views is None:
            flat = np.full(len(text), self.base)
            return flat, flat, flat
        own = [c.logit(v.logit(x)[:, None]) for v, c, x in zip(self.views, self.calibration, (text, meta), strict=True)]
        return _sigmoid(own[0]), _sigmoid(own[1]), _sigmoid(self.combination.logit(np.column_stack(own)))


#: A round: its views, and for each the steps from which up it says 1 and down to which it says 0.
Round = tuple[list[Logistic], list[tuple[int, int]]]
_ONE, _ZERO = (int((30 + sign * np.log(SURE / (1 - SURE))) * _STEPS / 60) for sign in (1, -1))


def _step_of(logits: np.ndarray) -> np.ndarray:
    return np.minimum((logits + 30) * _STEPS / 60, _STEPS - 1).astype(np.int64)


def _given(history: list[Round], x: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """The labels that either view has from the other, the first one each; NaN: none."""
    out = [np.full(len(x[0]), np.nan) for _ in range(2)]
    for views, limits in history:
        for k in range(2):
            at, other = _step_of(views[k].logit(x[k])), out[1 - k]
            said = np.where(at >= limits[k][0], 1.0, np.where(at <= limits[k][1], 0.0, np.nan))
            out[1 - k] = np.where(np.isnan(other), said, other)
    return out


def _summed(pool: DataFrame, work, size: int) -> np.ndarray:
    """Sum over all rows of ``pool`` of what ``work`` makes of the two views; parts add up in tasks, in a fixed order."""

    def run(batches):
        from pyspark import TaskContext

        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += work(tuple(np.frombuffer(b"".join(batch.column(i).to_pylist()), np.float32).reshape(batch.num_rows, -1).astype(np.float64) for i in range(2)))
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])

    def add(batches):
        rows = sorted((p, x) for b in batches for p, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        if rows:
            total = np.zeros(size)
            for _, x in rows:
                total += np.frombuffer(x)
            yield pa.RecordBatch.from_arrays([pa.array([rows[0][0]]), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])

    parts = pool.mapInArrow(run, "part long, sums binary").repartition(_SUM_TASKS, F.col("part") % _SUM_TASKS).mapInArrow(add, "part long, sums binary")
    total = np.zeros(size)
    for r in sorted(parts.collect()):  # a few arrays of a fixed size
        total += np.frombuffer(r["sums"])
    return total


def _limits(counts: np.ndarray, prior: float) -> tuple[int, int]:
    """Steps of the surest ``SHARE`` of either class; equal scores go together."""
    n = counts.sum()
    up, down = np.cumsum(counts[::-1]), np.cumsum(counts)
    hi = _STEPS - 1 - int(np.searchsorted(up, max(1, int(SHARE * prior * n))))
    lo = int(np.searchsorted(down, max(1, int(SHARE * (1 - prior) * n))))
    return max(hi, _ONE + 1), min(lo, _ZERO - 1)


def _learn(pool: DataFrame, history: list[Round], x: tuple[np.ndarray, np.ndarray], y: np.ndarray) -> tuple[list[Logistic], tuple[int, int]]:
    """Both views, fitted to the labelled rows and to all rows of the pool that have a label from the other view."""
    base, width = [v.mean(0) for v in x], [v.shape[1] for v in x]

    def split(sums: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
        return [sums[: sizes[0]], sums[sizes[0] :]]

    def moments(k: int, rows: np.ndarray) -> np.ndarray:
        d = rows - base[k]
        return np.concatenate([[len(d)], d.sum(0), (d**2).sum(0)])

    def pool_moments(v) -> np.ndarray:
        given = _given(history, v)
        return np.concatenate([moments(k, v[k][~np.isnan(given[k])]) for k in range(2)])

    views, taken = [], []
    for k, sums in enumerate(split(_summed(pool, pool_moments, 2 * sum(width) + 2), [2 * w + 1 for w in width])):
        taken.append(int(sums[0]))
        sums = sums + moments(k, x[k])
        mean = sums[1 : width[k] + 1] / sums[0]
        views.append(Logistic.at(base[k] + mean, np.sqrt(np.maximum(sums[width[k] + 1 :] / sums[0] - mean**2, 0))))
    sizes = [(w + 1) * (w + 2) for w in width]
    for _ in range(NEWTON_STEPS):

        def derivatives(v) -> np.ndarray:
            given = _given(history, v)
            return np.concatenate([views[k].derivatives(v[k][(has := ~np.isnan(given[k]))], given[k][has]) for k in range(2)])

        sums = split(_summed(pool, derivatives, sum(sizes)), sizes)
        if all([views[k].step(sums[k] + views[k].derivatives(x[k], y)) for k in range(2)]):
            break
    return views, (taken[0], taken[1])


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, pool: DataFrame) -> QualityModel:
    """y: labels of the arrays' rows; the rows of ``pool`` (both views, float32) have none.  Every fourth labelled row calibrates."""
    held = np.arange(len(y)) % 4 == 3
    if len(y) < 8 or len(set(y[~held])) < 2 or len(set(y[held])) < 2:
        return QualityModel(float(y.mean()) if len(y) else 0.5)
    x, given = (text[~held], meta[~held]), (0, 0)
    views = [Logistic(x[k], y[~held]) for k in range(2)]
    history: list[Round] = []
    for _ in range(ROUNDS):
        counts = _summed(pool, lambda v, views=views: np.concatenate([np.bincount(_step_of(views[k].logit(v[k])), minlength=_STEPS) for k in range(2)]).astype(np.float64), 2 * _STEPS)
        if not counts.any():
            break
        history.append((views, [_limits(counts[k * _STEPS : (k + 1) * _STEPS], y.mean()) for k in range(2)]))
        views, given = _learn(pool, history, x, y[~held])
    raw = [views[k].logit((text, meta)[k][held]) for k in range(2)]
    calibration = [Logistic(r[:, None], y[held]) for r in raw]
    own = np.column_stack([c.logit(r[:, None]) for c, r in zip(calibration, raw, strict=True)])
    return QualityModel(float(y.mean()), tuple(views), tuple(calibration), Logistic(own, y[held]), given)


def _page(df: DataFrame, lang: str, source: str, size: str) -> list[Column]:
    """Language, source and size of each row; null where the table has no such column."""
    return [F.col(f"`{c}`").cast(kind) if c in df.columns else F.lit(None).cast(kind) for c, kind in ((lang, "string"), (source, "string"), (size, "double"))]


def fit_quality(
    df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", size: str = "n_chars", label: str = "quality", labelled_rows: int = LABELLED_ROWS
) -> QualityModel:
    """Co-trains on a hash sample of about ``labelled_rows`` labels and on all other rows of ``df``.

    Null labels and ids teach nothing; of repeated labels the largest counts, and
    of the rows of one label that with the least hash of its text teaches, so
    the driver holds ``labelled_rows`` rows of features however often they are
    repeated.  Other repeated rows each teach; columns that ``df`` lacks count
    as null.
    """
    bounded_batches(df.sparkSession)
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.max(label).cast("double").alias("__y"))
    n_known = known.count()

    def within(rows: int, total: int, salt: int):
        return F.pmod(F.xxhash64(F.col(doc_id), F.lit(salt)), F.lit(1 << 62)) < int((1 << 62) * min(1.0, rows / max(1, total)))

    sample = known.where(within(labelled_rows, n_known, 1))  # bounded: at most about labelled_rows small rows
    page = [c.alias(n) for c, n in zip(_page(df, lang, source, size), ("lang", "source", "size"), strict=True)]
    rows = df.select(F.col(f"`{doc_id}`").alias(doc_id), F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("h"), F.col(f"`{text}`").alias("t"), *page)
    rows = rows.join(F.broadcast(sample), doc_id, "left").select("t", "lang", "source", "size", "__y", "h", F.when(F.col("__y").isNotNull(), F.xxhash64(doc_id)).alias("i"))

    def run(batches):
        for batch in batches:
            for lo, hi, raw, offsets in slices(batch.column(0)):
                cut = [batch.column(i).slice(lo, hi - lo) for i in range(7)]
                views = (text_view(raw, offsets), meta_view(*cut[1:4]))
                packed = (pa.array([x.tobytes() for x in v.astype(np.float32)], pa.binary()) for v in views)
                yield pa.RecordBatch.from_arrays([*cut[4:], *packed], names=["y", "h", "i", "a", "b"])

    table = stored(rows.mapInArrow(run, "y double, h long, i long, a binary, b binary"), "quality-features")
    one = table.where("y is not null").groupBy("i", "y").agg(F.min(F.struct("h", "a", "b")).alias("x"))
    got = one.select("y", "x.*").toPandas().sort_values(["h", "a"])  # a row for each sampled label
    if not len(got):
        return QualityModel(0.5)
    a, b = (np.stack([np.frombuffer(x, np.float32) for x in got[c]]).astype(np.float64) for c in ("a", "b"))
    return co_train(a, b, (got["y"].to_numpy(np.float64) > 0).astype(np.float64), table.where("y is null").select("a", "b"))


def score_quality(df: DataFrame, model: QualityModel, text: str = "text", lang: str = "lang", source: str = "source", size: str = "n_chars") -> DataFrame:
    """Adds ``text_score``, ``meta_score`` and ``score`` (each 0..1, large is good) to every row, in one narrow pass.

    Null and empty texts have zero features and are scored like others, very
    long ones whole; null or absent languages, sources and sizes are a value of
    their own, each by itself, as in fitting.  Repeated rows are each scored.
    Columns of ``df`` with the names of the results are replaced.
    """
    names = ["text_score", "meta_score", "score"]
    keep = [f for f in df.schema.fields if f.name not in names]
    width = len(keep)
    bounded_batches(df.sparkSession)
    mark = free_name(df.columns, "__page")
    page = [c.alias(f"{mark}{i}") for i, c in enumerate([F.col(f"`{text}`"), *_page(df, lang, source, size)])]
    rows = df.select(*(F.col(f"`{f.name}`") for f in keep), *page)
    shipped = df.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers

    def run(batches):
        model = shipped.value
        for batch in batches:
            for lo, hi, raw, offsets in slices(batch.column(width)):
                piece = batch.slice(lo, hi - lo)
                scores = model.score(text_view(raw, offsets), meta_view(*(piece.column(width + i) for i in (1, 2, 3))))
                yield pa.RecordBatch.from_arrays([*(piece.column(i) for i in range(width)), *(pa.array(s) for s in scores)], names=[*(f.name for f in keep), *names])

    return rows.mapInArrow(run, T.StructType([*keep, *(T.StructField(n, T.DoubleType()) for n in names)]))
