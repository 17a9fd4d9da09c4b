"""Language ID with hyperdimensional profiles.

Each letter has a fixed pseudo-random vector of +1/-1.  A trigram's vector binds
its letters, each permuted (rolled) by its place: ``roll(a,2) * roll(b,1) * c``.
A text is the bundle (sum) of its trigrams' vectors, a language the bundle of
its training texts; a text gets the language of largest cosine.

Bundling is linear, so a language's prototype needs only the trigram counts of
its texts: training is one pass of counts, of a size fixed by the alphabet, and
one small product.  Prediction multiplies each batch's sparse counts with the
trigram vectors.
"""

from __future__ import annotations

import sys
import unicodedata
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orfloom.llm.storage import bounded_batches, give_back
from orfloom.llm.text import slices, with_text

DIMENSIONS = 512
#: Symbols of the alphabet: 0 stands for all that is no letter, the letters share the others by their code point.
SYMBOLS = 64
TRIGRAMS = SYMBOLS**3
#: A table of languages is small by nature; more distinct labels than this are an error in the data.
MOST_LANGUAGES = 1000
UNDETERMINED = "und"
#: Trigrams of a text block that are turned into vectors at once.
BLOCK = 4096
#: Bytes of text handled at once.
SLICE = 1 << 20

_symbols: np.ndarray | None = None
_vectors: dict[tuple[int, int], np.ndarray] = {}


def _symbol_table() -> np.ndarray:
    """Symbol of every code point: a-z are 1 to 26, other letters 27 and up by their lower-case code point."""
    global _symbols
    if _symbols is None:
        table = np.zeros(sys.maxunicode + 1, dtype=np.uint8)
        for c in range(sys.maxunicode + 1):
            ch = chr(c)
            if ch.isalpha():
                low = ord(ch.lower()[0])
                table[c] = low - 96 if 97 <= low <= 122 else 27 + low % (SYMBOLS - 27)
        _symbols = table
    return _symbols


def _letters(dimensions: int, seed: int) -> np.ndarray:
    if (dimensions, seed) not in _vectors:
        _vectors[dimensions, seed] = np.random.default_rng(seed).choice(np.array([-1, 1], np.int8), size=(SYMBOLS, dimensions))
    return _vectors[dimensions, seed]


def trigram_vectors(codes: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
    """Bound vectors of trigram codes, as float32 rows."""
    letters = _letters(dimensions, seed)
    a, b, c = codes // (SYMBOLS * SYMBOLS), codes // SYMBOLS % SYMBOLS, codes % SYMBOLS
    return (np.roll(letters, 2, axis=1)[a] * np.roll(letters, 1, axis=1)[b] * letters[c]).astype(np.float32)


def _trigrams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, code, count) of the distinct trigrams of a slice, and whether each row has a letter.

    Marks between words count as one blank; trigrams lie within one text,
    which has a blank before and after it.
    """
    text = raw.tobytes().decode("utf-8")
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    head = (raw & 0xC0) != 0x80
    at = np.concatenate([[0], np.cumsum(head)])[offsets]
    symbols = _symbol_table()[points]
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
    first = np.zeros(len(points), dtype=bool)
    first[at[:-1][np.diff(at) > 0]] = True
    before = np.empty_like(symbols)
    if len(symbols):
        before[0], before[1:] = 0, symbols[:-1]
        before[first] = 0
    keep = (symbols != 0) | (before != 0)
    symbols, rows = symbols[keep].astype(np.int64), rows[keep]
    has = np.zeros(len(offsets) - 1, dtype=bool)
    has[rows[symbols != 0]] = True
    one = np.concatenate([[0], symbols[:-1]]) if len(symbols) else symbols
    two = np.concatenate([[0, 0], symbols[:-2]]) if len(symbols) > 1 else np.zeros_like(symbols)
    same1 = np.concatenate([[False], rows[1:] == rows[:-1]]) if len(rows) else np.zeros(0, bool)
    same2 = np.concatenate([[False, False], rows[2:] == rows[:-2]]) if len(rows) > 1 else np.zeros(len(rows), bool)
    code = (two * same2 * SYMBOLS + one * same1) * SYMBOLS + symbols
    key = np.sort(rows * TRIGRAMS + code)
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(start, len(key)))
    key = key[start]
    return key // TRIGRAMS, key % TRIGRAMS, count, has


@dataclass(frozen=True)
class LanguageProfiles:
    languages: list[str]
    #: Unit vectors, one row for each language.
    prototypes: np.ndarray
    dimensions: int
    seed: int
    #: Chance that two trigrams of a language are the same.
    repeats: np.ndarray | None = None


def fit_language_profiles(
    df: DataFrame, text: str = "text", lang: str = "lang", where: Column | None = None, dimensions: int = DIMENSIONS, seed: int = 7
) -> LanguageProfiles:
    """Prototypes of all languages from every row with a label (and ``where``).

    Null labels and texts without letters teach nothing.  What is shuffled and
    collected are trigram counts, bounded by languages times the alphabet's
    trigrams, whatever the number of documents.
    """
    bounded_batches(df.sparkSession)
    rows = df.where(F.col(lang).isNotNull())
    rows = rows.where(where) if where is not None else rows

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = np.asarray(batch.column(1).to_pylist(), dtype=object)
            for lo, hi, raw, offsets in slices(batch.column(0), SLICE):
                row, code, n, _ = _trigrams(raw, offsets)
                names = labels[lo:hi]
                for name in set(names):
                    mine = (names == name)[row]
                    if name not in total:
                        total[name] = np.zeros(TRIGRAMS, dtype=np.int64)
                    total[name] += np.bincount(code[mine], weights=n[mine], minlength=TRIGRAMS).astype(np.int64)
        for name, counts in total.items():
            code = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(code), pa.string()), pa.array(code), pa.array(counts[code])], names=["lang", "code", "n"])

    counts = (
        rows.select(F.col(f"`{text}`"), F.col(f"`{lang}`").cast("string"))
        .mapInArrow(count, "lang string, code long, n long")
        .groupBy("lang", "code").agg(F.sum("n").alias("n"))
        .groupBy("lang").agg(F.collect_list(F.struct("code", "n")).alias("grams"))  # at most one entry for each trigram
    )

    def bundle(frames):
        for frame in frames:
            out = []
            for name, grams in zip(frame["lang"], frame["grams"], strict=True):
                code, n = np.array([g["code"] for g in grams]), np.array([g["n"] for g in grams], dtype=np.float64)
                total = np.zeros(dimensions)
                for i in range(0, len(code), BLOCK):
                    total += n[i : i + BLOCK] @ trigram_vectors(code[i : i + BLOCK], dimensions, seed)
                out.append((name, total.tolist(), float((n**2).sum() / n.sum() ** 2)))
            yield pd.DataFrame(out, columns=["lang", "v", "repeats"])

    found = counts.mapInPandas(bundle, "lang string, v array<double>, repeats double").limit(MOST_LANGUAGES + 1).collect()  # a row for each language
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} distinct languages")
    found = sorted((r["lang"], r["v"], r["repeats"]) for r in found)
    matrix = np.array([v for _, v, _ in found], dtype=np.float64).reshape(len(found), dimensions)
    norm = np.linalg.norm(matrix, axis=1, keepdims=True)
    return LanguageProfiles([name for name, _, _ in found], matrix / np.where(norm > 0, norm, 1), dimensions, seed, np.array([x for _, _, x in found]))


def predict_language(df: DataFrame, profiles: LanguageProfiles, text: str = "text", label: str | None = None) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` (largest cosine, cut to 0..1) to every row, in one narrow pass.

    Only the text is looked at.  Null, empty and letterless texts, and all
    texts where nothing was learned, get ``und`` and 0.  Ties go to the
    language that sorts first.  Columns of ``df`` with the names of the
    results are replaced.

    With a column ``label`` two more are added.  ``likeness``: how frequent the
    text's trigrams are in ``lang_pred``, on average, as a share of what a text
    of that language has; about 1 at any length for texts of the language and
    near 0 for others.  ``label_score``: cosine with the labelled language
    (null without a label, 0 for one that was not learned).
    """
    names = ("lang_pred", "score") if label is None else ("lang_pred", "score", "likeness", "label_score")
    keep = [f for f in df.schema.fields if f.name not in names]
    schema = T.StructType([*keep, T.StructField("lang_pred", T.StringType()), *(T.StructField(n, T.DoubleType()) for n in names[1:])])
    labelled = [f.name for f in keep].index(label) if label is not None else 0
    shipped = df.sparkSession.sparkContext.broadcast(profiles)  # languages x dimensions numbers

    rows, at = with_text(df, [f.name for f in keep], text)

    def run(batches):
        profiles = shipped.value
        labels = np.array([UNDETERMINED, *profiles.languages], dtype=object)
        place = {name: k for k, name in enumerate(profiles.languages)}
        for batch in batches:
            for lo, hi, raw, offsets in slices(batch.column(at), SLICE):
                pred, score, like, own = np.zeros(hi - lo, np.int64), np.zeros(hi - lo), np.zeros(hi - lo), np.zeros(hi - lo)
                piece = batch.slice(lo, hi - lo)
                mine = np.array([-2 if x is None else place.get(x, -1) for x in piece.column(labelled).cast(pa.string()).to_pylist()], np.int64) if label is not None else None
                row, code, n, has = _trigrams(raw, offsets)
                if profiles.languages and len(row):
                    bundles = _bundles(row, code, n, hi - lo, profiles)
                    norm = np.linalg.norm(bundles, axis=1)
                    cosine = bundles @ profiles.prototypes.T.astype(np.float32) / np.where(norm > 0, norm, 1)[:, None]
                    best = cosine.argmax(axis=1)
                    pred = np.where(has, best + 1, 0)
                    score = np.where(has, np.clip(cosine[np.arange(hi - lo), best].astype(np.float64), 0, 1), 0)
                    if label is not None:
                        squares = np.bincount(row, weights=n.astype(np.float64) ** 2, minlength=hi - lo)
                        all_of = np.bincount(row, weights=n, minlength=hi - lo)
                        like = score * np.sqrt(squares) / np.maximum(1, all_of) / np.sqrt(profiles.repeats[best])
                        own = np.where(has & (mine >= 0), cosine[np.arange(hi - lo), np.maximum(mine, 0)].astype(np.float64), 0)
                more = [pa.array(like), pa.array(own, mask=mine == -2)] if label is not None else []
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(i) for i in range(len(keep))), pa.array(labels[pred], pa.string()), pa.array(score), *more], names=[*(f.name for f in keep), *names]
                )
        give_back()

    return rows.mapInArrow(run, schema)


def likeness_floors(df: DataFrame, profiles: LanguageProfiles, text: str = "text", lang: str = "lang", quantile: float = 0.05, share: float = 0.3) -> dict[str, float]:
    """For each language ``share`` of the low ``quantile`` of the likeness of all its labelled texts that are predicted as labelled."""
    rows = df.where(F.col(lang).isNotNull()).select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"))
    found = predict_language(rows, profiles, label="lang").where("lang = lang_pred").groupBy("lang").agg(F.percentile_approx("likeness", quantile).alias("low"))
    return {r["lang"]: share * r["low"] for r in found.collect()}  # a row for each language


def _bundles(row: np.ndarray, code: np.ndarray, n: np.ndarray, rows: int, profiles: LanguageProfiles) -> np.ndarray:
    """Bundled trigram vectors of each row, by blocks of distinct trigrams."""
    known, which = np.unique(code, return_inverse=True)
    bundles = np.zeros((rows, profiles.dimensions), dtype=np.float32)
    for i in range(0, len(known), BLOCK):
        mine = (which >= i) & (which < i + BLOCK)
        width = min(BLOCK, len(known) - i)
        vectors = trigram_vectors(known[i : i + width], profiles.dimensions, profiles.seed)
        for top in range(0, rows, 256):
            here = mine & (row >= top) & (row < top + 256)
            dense = np.zeros((min(256, rows - top), width), dtype=np.float32)
            dense[row[here] - top, which[here] - i] = n[here]
            bundles[top : top + 256] += dense @ vectors
    return bundles
