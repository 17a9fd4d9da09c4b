"""Collocations against plain counting."""

import collections
import random
import re

import numpy as np
import pytest

from orfloom.llm.collocations import LONGEST, MOST_WORDS, collocations, parse

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "text string, lang string, n int, phrase string, doc_id long"


def pieces(text):
    return [w for p in re.split("[.,;:!?\n-\r]", (text or "").translate(LOW)) if (w := re.findall("[^ \t]+", p))]


def plain(rows, threshold, most):
    counts, words = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        for p in pieces(text):
            words[lang or "und"] += len(p)
            for n in range(1, LONGEST + 1):
                counts[lang or "und"].update(tuple(p[i : i + n]) for i in range(len(p) - n + 1))
    out = set()
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= threshold}
        rows = []
        for p, a in candidates.items():
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            inside = any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in candidates.items())
            if not inside:
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:most], 1):
            out.add((lang, rank, p.decode(), -a, left, right, words[lang], -score))
    return out


def texts():
    rng = random.Random(2)
    vocabulary = ["the", "The", "of", "new", "york", "city", "é", "中文", "a-b", "x'y", "12", "😀"] + [f"w{i}" for i in range(30)]
    gaps = [" ", " ", " ", " ", "  ", "\t", ". ", ", ", "\n", " ;", "!?", "\x0b"]
    rows = [("".join(rng.choice(vocabulary) + rng.choice(gaps) for _ in range(rng.randint(0, 60))), rng.choice(["en", "fr", None, "und"])) for _ in range(150)]
    rows += [("new york city of the new york city", "en")] * 25 + [("same " * 9000, "fr"), ("one two three four five six seven " * 400, "en"), (None, "en"), ("", None), (".,;", "xx")]
    return rows


@pytest.mark.parametrize(("threshold", "most"), [(3, 2000), (30, 7)])
def test_collocations(spark, threshold, most):
    rows = texts()
    df = spark.createDataFrame([(t, lang, 1, "p", 5) for t, lang in rows], DOCS).repartition(5)
    got = {tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in collocations(df, threshold=threshold, most=most).collect()}
    assert got == plain(rows, threshold, most)


def test_empty_table(spark):
    assert collocations(spark.createDataFrame([], DOCS)).count() == 0


def test_chunks_own_every_phrase_once():
    for text in [t for t, _ in texts()[:40]] + ["w " * (2 * MOST_WORDS + 5), " ".join(f"v{i}" for i in range(3 * MOST_WORDS)), "a.b c", ""]:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        row, a, b, overlap, plain_bytes = parse(raw, np.array([0, len(raw)]))
        found = collections.Counter()
        for lo, hi, extra in zip(a, b, overlap, strict=True):
            w = plain_bytes[lo:hi].tobytes().decode().split(" ")
            assert len(w) <= MOST_WORDS + 3
            found.update(tuple(w[i : i + n]) for n in range(1, 5) for i in range(len(w) - extra) if i + n <= len(w))
        want = collections.Counter(tuple(p[i : i + n]) for p in pieces(text) for n in range(1, 5) for i in range(len(p) - n + 1))
        assert found == want and (row == 0).all()
