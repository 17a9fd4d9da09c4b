"""op2 and op9 against plain versions, and odd rows for them."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orfloom.llm import language, quality
from orfloom.llm.language import fit_language_profiles, predict_language
from orfloom.llm.mixing import mix_sources
from orfloom.llm.quality import Logistic, fit_quality, meta_view, score_quality, text_view
from orfloom.llm.text import free_name, slices


def bundle(text, letters):
    """The bundle of a text's trigrams, one after another; marks between words are one blank."""
    table = language._symbol_table()
    symbols = [0]
    for c in text or "":
        s = int(table[ord(c)])
        if s or symbols[-1]:
            symbols.append(s)
    symbols = [0, *symbols] if len(symbols) > 1 else []
    total = np.zeros(letters.shape[1])
    for a, b, c in zip(symbols, symbols[1:], symbols[2:], strict=False):
        total += np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c]
    return total


def test_language_as_plain_vectors(spark):
    rng = random.Random(41)
    rows = []
    for i in range(60):
        words = rng.choice([["der", "und", "ich"], ["the", "and", "a"], ["è", "qué", "los"]])
        rows.append((i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 15))) + rng.choice(["", ".", " 12"]), {"der": "de", "the": "en", "è": "es"}[words[0]]))
    rows += [(60, None, "en"), (61, "", None), (62, "x" * 70_000, "en"), (63, rows[0][1], None), (63, rows[0][1], None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = fit_language_profiles(df, where=F.col("doc_id") % 3 != 0)
    letters = language._letters(profiles.dimensions, profiles.seed).astype(float)
    names = sorted({lang for i, _, lang in rows if lang and i % 3})
    sums = np.array([sum(bundle(t, letters) for i, t, lang in rows if lang == name and i % 3) for name in names])
    assert profiles.languages == names
    got = sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in predict_language(df, profiles).collect())
    want = []
    for i, t, _ in rows:
        v = bundle(t, letters)
        if not any(language._symbol_table()[ord(c)] for c in t or ""):
            want.append((i, "und", 0.0))
            continue
        cosine = sums @ v / np.linalg.norm(sums, axis=1) / np.linalg.norm(v)
        want.append((i, names[int(cosine.argmax())], float(np.clip(cosine.max(), 0, 1))))
    for g, w in zip(got, sorted(want), strict=True):
        assert g[:2] == w[:2] and g[2] == pytest.approx(w[2], abs=1e-4)


def test_languages_of_no_rows_and_ties(spark):
    df = spark.createDataFrame([(1, "abc", "bb"), (2, "abc", "aa")], "doc_id long, text string, lang string")
    profiles = fit_language_profiles(df)
    assert {r["lang_pred"] for r in predict_language(df, profiles).collect()} == {"aa"}
    assert predict_language(df.where("false"), profiles).count() == 0


def plain_co_training(x, y, held, pool):
    """Both views by sorting and refitting in memory."""
    train = [v[~held] for v in x]
    views = [Logistic(v, y[~held]) for v in train]
    given = [np.full(len(pool[0]), np.nan) for _ in range(2)]
    for _ in range(quality.ROUNDS):
        for k in range(2):
            step = quality._step_of(views[k].logit(pool[k]))
            n, prior = len(step), y.mean()
            up = max(np.sort(step)[::-1][max(1, int(quality.SHARE * prior * n)) - 1], quality._ONE + 1)
            down = min(np.sort(step)[max(1, int(quality.SHARE * (1 - prior) * n)) - 1], quality._ZERO - 1)
            said = np.where(step >= up, 1.0, np.where(step <= down, 0.0, np.nan))
            given[1 - k] = np.where(np.isnan(given[1 - k]), said, given[1 - k])
        views = []
        for k in range(2):
            has = ~np.isnan(given[k])
            views.append(Logistic(np.concatenate([train[k], pool[k][has]]), np.concatenate([y[~held], given[k][has]])))
    raw = [views[k].logit(x[k][held]) for k in range(2)]
    scale = [Logistic(r[:, None], y[held]) for r in raw]
    own = np.column_stack([c.logit(r[:, None]) for c, r in zip(scale, raw, strict=True)])
    return quality.QualityModel(float(y.mean()), tuple(views), tuple(scale), Logistic(own, y[held]))


def views_of(rows):
    import pyarrow as pa

    parts = [text_view(raw, offsets) for _, _, raw, offsets in slices(pa.array([r[1] for r in rows], pa.string()))]
    meta = meta_view(*(pa.array([r[i] for r in rows], kind) for i, kind in ((2, pa.string()), (3, pa.string()), (4, pa.float64()))))
    return [v.astype(np.float32).astype(np.float64) for v in (np.concatenate(parts), meta)]


def test_quality_as_plain_co_training(spark):
    rng = random.Random(42)
    rows = []
    for i in range(3000):
        good = rng.random() < 0.6
        words = [rng.choice("the cat sat on mat and dog ran by a tree".split()) if good == (rng.random() < 0.8) else rng.choice(["x###", "$$$", "a | b"]) for _ in range(rng.randint(3, 20))]
        rows.append((i, " ".join(words), "en" if good == (rng.random() < 0.8) else None, f"s{rng.randint(0, 3) + 4 * good}", float(rng.randint(1, 99)), int(good)))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars double, good int").repartition(3)
    labels = df.where("doc_id < 400").selectExpr("doc_id", "good quality")
    model = fit_quality(df, labels)
    order = {r["doc_id"]: r["h"] for r in df.where("doc_id < 400").select("doc_id", F.xxhash64("doc_id", "text").alias("h")).collect()}
    some = sorted(rows[:400], key=lambda r: order[r[0]])
    y = np.array([float(r[5]) for r in some])
    plain = plain_co_training(views_of(some), y, np.arange(400) % 4 == 3, views_of(rows[400:]))
    want = dict(zip((r[0] for r in rows), plain.score(*views_of(rows))[2], strict=True))
    for r in score_quality(df, model).collect():
        assert r["score"] == pytest.approx(want[r["doc_id"]], abs=2e-3)
    # a column that is absent is scored as one of nulls, the others as ever
    left = {r["doc_id"]: r["meta_score"] for r in score_quality(df.drop("source"), model).collect()}
    null = {r["doc_id"]: r["meta_score"] for r in score_quality(df.withColumn("source", F.lit(None).cast("string")), model).collect()}
    assert left == null and len(set(left.values())) > 50
    # names of the helpers' own are the user's to use; repeated rows are scored alike
    odd = df.limit(5).withColumn("__page0", F.lit("p")).withColumn("__lang", F.lit("q")).withColumn("__text", F.lit("r"))
    back = score_quality(odd.unionByName(odd), model).collect()
    assert len(back) == 10 and all((r["__page0"], r["__lang"], r["__text"]) == ("p", "q", "r") for r in back)


def test_mixing_with_names_like_its_own(spark):
    rows = [(i, "a b c", "x", 1, 2, 3) for i in range(20)] + [(None, "d " * 40_000, "y", 1, 2, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, __cut int, __mix_full int, __level0 int")
    got = mix_sources(df, [F.col("lang")], [{}], fraction=1.0)
    assert got.count() == 21 and {"__cut", "__mix_full", "__level0", "epoch"} <= set(got.columns)


def test_free_names():
    assert free_name(["a", "__mix_full", "__MIX2"], "__mix") == "___mix" and free_name([], "x") == "x"
