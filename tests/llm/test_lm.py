"""Language-model scores against a plain bigram model: all bigrams count, and both ways of asking the filter agree."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from orfloom.llm import lm
from orfloom.llm.lm import lm_scores

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TRAIN = "crc32(cast(doc_id as string)) % 10 <> 0"
STEPS = sorted({x << i for i in range(20) for x in (1, 2, 3)})


def tokens_of(text):
    return [*re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOW)), None]


def brute(docs, prior):
    """(n_tokens, n_known, train_tokens, held_out, base, score) of each (id, text)."""
    taught = [tokens_of(t) for i, t in docs if i is not None and zlib.crc32(str(i).encode()) % 10]
    one = collections.Counter(w for t in taught for w in t)
    two = collections.Counter(p for t in taught for p in zip(["<s>", *t], t, strict=False))
    n, v = sum(one.values()), len(one)
    out = []
    for i, text in docs:
        t = tokens_of(text)
        p = [(one[w] + 0.1) / (n + 0.1 * (v + 1)) for w in t]
        before = [len(taught), *(one[w] for w in t[:-1])]
        held = [max((s for s in STEPS if s <= two[x]), default=0) for x in zip(["<s>", *t], t, strict=False)]
        score = sum(math.log10((h + prior * a) / (b + prior)) for h, a, b in zip(held, p, before, strict=True))
        out.append((len(t), sum(one[w] > 0 for w in t), n, i is None or not zlib.crc32(str(i).encode()) % 10, sum(map(math.log10, p)), score))
    return out


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_scores(spark, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(lm, "CHUNK_BYTES", 300)
    monkeypatch.setattr(lm, "SEND_TOKENS", 200)
    monkeypatch.setattr(lm, "ENTRY_BITS", 100)  # next to no false positives
    rng = random.Random(11)
    docs = [*((i, " ".join(rng.choice(["A", "b", "c d", "é", f"w{rng.randint(0, 60)}"]) for _ in range(rng.randint(0, 30)))) for i in range(120))]
    docs += [(200, None), (201, ""), (202, "new words"), (203, "b " * 5000), (204, " \n"), (2**53 + 1, "a b"), (None, "a b"), (5, docs[5][1]), (2**63 - 1, "b"), (-(2**63), "b a")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, score string, chunk int").repartition(3)
    got = lm_scores(df, F.expr(TRAIN), prior=20.0, broadcast_bytes=broadcast_bytes).collect()
    want = brute(docs, 20.0)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[6])
    got = sorted((tuple(r[c] for c in ("doc_id", "n_tokens", "n_known", "train_tokens", "held_out", "base_score", "score")) for r in got), key=key)
    want = sorted(((i, *w) for (i, _), w in zip(docs, want, strict=True)), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want, strict=True):
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=0.02)


def test_travelling_probes_do_not_grow_with_blocks(spark, monkeypatch):
    """A chunk asks ranges of blocks, not blocks: rows grow as the text and not as its square; scores are those of the broadcast filter."""
    written = {}
    real = lm.stored
    monkeypatch.setattr(lm, "stored", lambda df, name: written.setdefault(name, real(df, name)))
    monkeypatch.setattr(lm, "CHUNK_BYTES", 600)
    monkeypatch.setattr(lm, "BLOCK_KEYS", 20)
    monkeypatch.setattr(lm, "RANGES", 3, raising=False)
    rng = random.Random(23)
    # long runs of one pair have high levels; the held-out texts have pairs that no segment has
    docs = [(i, " ".join(rng.choice(["a b a b a b", f"w{rng.randint(0, 200)}", f"x{i}"]) for _ in range(30))) for i in range(150)]
    df = spark.createDataFrame([*docs, (None, None), (500, "")], "doc_id long, text string").repartition(3)
    shipped = {r["doc_id"]: r for r in lm_scores(df, F.expr(TRAIN)).collect()}
    written.clear()
    asked = {r["doc_id"]: r for r in lm_scores(df, F.expr(TRAIN), broadcast_bytes=0).collect()}
    assert asked == shipped and len(asked) == 152
    chunks, blocks = written["token-streams"].count(), written["bigram-filter"].count()
    assert chunks > 20 and blocks > 100
    assert written["bigram-levels"].count() <= 4 * chunks


def test_nothing_to_learn_or_score(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert lm_scores(df.where("false"), F.expr(TRAIN)).count() == 0
    for r in lm_scores(df, F.lit(False)).collect():
        assert (r["n_known"], r["base_score"], r["score"]) == (0, 0, 0)
    assert all(r["held_out"] for r in lm_scores(df, F.lit(None).cast("boolean")).collect())


def test_single_bigrams_count(spark, tmp_path):
    from orfloom.llm.queries import op6_lm_scores

    rng = random.Random(22)
    docs = [(i, " ".join(f"w{rng.randint(0, 60)}" for _ in range(30))) for i in range(60)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["score"] for r in op6_lm_scores(spark, str(tmp_path)).collect()}
    for (i, _), w in zip(docs, brute(docs, lm.PRIOR), strict=True):
        assert got[i] == pytest.approx(w[5], rel=0.02)


def test_levels():
    counts = np.arange(0, 5000)
    held = lm.least_count(lm.level_of(counts))
    assert (held <= counts).all() and (held * 1.5 >= counts).all()
    assert held.tolist() == [max((s for s in STEPS if s <= c), default=0) for c in counts.tolist()]


def test_filter_has_no_misses_and_few_lies():
    rng = np.random.default_rng(12)
    keys = np.unique(rng.integers(0, 1 << 63, size=20_000).astype(np.uint64))
    levels = lm.level_of(rng.integers(1, 40, size=len(keys)))
    size = 64 * (int(levels.sum()) * lm.ENTRY_BITS // 64 + 1)
    bits = np.zeros(size, bool)
    for level in range(1, levels.max() + 1):
        for probe in range(lm.PROBES):
            bits[lm._places(keys[levels >= level] & lm._KEY, level, probe, np.uint64(size))] = True
    held = lm.LogFrequencyFilter(1, [(0, size, np.packbits(bits).tobytes())])
    assert (held.levels(keys) >= levels).all() and (held.levels(keys) > levels).mean() < 0.05
    assert (held.levels(rng.integers(0, 1 << 63, size=20_000).astype(np.uint64)) > 0).mean() < 0.05
