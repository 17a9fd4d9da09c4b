"""Training-data operators against brute force, on small tables full of odd rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from orfloom.llm import jaccard
from orfloom.llm.components import components
from orfloom.llm.decontaminate import FMIndex, decontaminate
from orfloom.llm.jaccard import jaccard_classes
from orfloom.llm.language import fit_language_profiles, predict_language
from orfloom.llm.mixing import mix_sources
from orfloom.llm.token_files import read_token_files, write_token_files
from orfloom.llm.tokens import token_counts
from orfloom.llm.topk import top_k
from orfloom.llm.urls import judge_urls

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, n_tokens int, score int, epoch int, h string"


def table(spark, texts):
    """Documents with extra columns whose names clash with results."""
    return spark.createDataFrame([(i, t, 1, 2, 3, "x") for i, t in texts], DOCS)


def odd_texts():
    rng = random.Random(5)
    parts = [" ", "  ", "\n", "\t", "'s", "'re", "'", "don't", "é", "ß", "12", "!", "_", "\u2019", "中", "\u3000", "\x1c", "\x85", "😀", "\r\n", "<|endoftext|>", "the", " cat"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    return [*enumerate(texts), (300, None), (301, ""), (302, "word " * 60_000), (303, texts[0]), (303, texts[0])]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY)


def test_token_counts(spark, library):
    rows = odd_texts()
    got = token_counts(table(spark, rows), VOCABULARY).collect()
    want = sorted((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert sorted((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) and r["h"] == "x" for r in got)
    assert token_counts(table(spark, []), VOCABULARY).count() == 0


def test_sentencepiece_counts(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    p = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [(1, "the cat sat"), (2, None), (3, "é 中")]
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts(table(spark, rows), path).collect()}
    assert got == {i: len(p.encode(t or "")) for i, t in rows}


def test_token_files_round_trip(spark, library):
    rows = odd_texts()
    manifest = write_token_files(table(spark, rows).repartition(5), VOCABULARY, partitions=4)
    back = sorted((r["start"], r["doc_id"], list(r["ids"])) for r in read_token_files(manifest).collect())
    want = sorted((i, t or "") for i, t in rows)
    ids = [[*library.encode(t, add_special_tokens=False).ids, 0] for _, t in want]
    assert [(s, d, x) for s, d, x in back] == [(int(s), i, x) for s, (i, _), x in zip(np.cumsum([0, *map(len, ids)])[:-1], want, ids, strict=True)]
    digests = {(r["start"], r["n_tokens"], r["ids_crc32"]) for r in read_token_files(manifest, digests=True).collect()}
    assert digests == {(s, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for s, _, x in back}
    assert read_token_files(write_token_files(table(spark, []), VOCABULARY)).count() == 0
    nameless = write_token_files(table(spark, [(1, "b"), (None, "a"), (0, "c"), (None, None)]), VOCABULARY, partitions=2)
    named = [(r["doc_id"], r["n_tokens"]) for r in read_token_files(nameless, digests=True).orderBy("start").collect()]
    assert named == [(None, 1), (None, 2), (0, 2), (1, 2)] and nameless.agg(F.sum("n_null")).first()[0] == 2


def test_language(spark):
    rng = random.Random(6)
    syllables = {"xx": ["ka", "ro", "mi"], "yy": ["sch", "ung", "eit"], "zz": ["ção", "lha", "nha"]}
    rows = [(i, " ".join("".join(rng.choice(s) for _ in range(3)) for _ in range(20)), lang) for i, (lang, s) in enumerate(list(syllables.items()) * 30)]
    rows += [(900, None, "xx"), (901, "", "yy"), (902, "12 !? \U0001F600", "xx"), (903, rows[0][1], None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("lang_pred", F.lit("clash"))
    found = {r["doc_id"]: r for r in predict_language(df, fit_language_profiles(df, where=F.col("doc_id") % 4 != 0)).collect()}
    assert all(found[i]["lang_pred"] == lang for i, _, lang in rows[:90]) and found[903]["lang_pred"] == "xx"
    assert all((found[i]["lang_pred"], found[i]["score"]) == ("und", 0.0) for i in (900, 901, 902))
    assert all(0 <= r["score"] <= 1 for r in found.values())
    none = fit_language_profiles(df.where("false"))
    assert {r["lang_pred"] for r in predict_language(df, none).collect()} == {"und"}


def test_fm_index_finds_every_occurrence():
    rng = np.random.default_rng(7)
    runs = [rng.integers(1, 4, size=n) for n in rng.integers(1, 40, size=30)]
    runs += [runs[0]] * 3
    flat, starts = np.concatenate(runs), np.cumsum([0, *map(len, runs)])[:-1]
    index = FMIndex(flat, starts, 4)
    row = np.repeat(np.arange(len(runs)), [len(r) for r in runs])
    for width in (1, 2, 5):
        for pattern in rng.integers(1, 5, size=(20, width)):
            lo, hi = index.search(pattern[None, :])
            got = sorted(index.locate(np.arange(lo[0], hi[0])).tolist())
            assert got == [i for i in range(len(flat) - width + 1) if row[i] == row[i + width - 1] and (flat[i : i + width] == pattern).all()]


def brute_decontaminate(docs, bench, size):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = collections.defaultdict(set)
    for i, t in bench:
        w = word.findall((t or "").translate(LOW))
        k = min(size, len(w))
        for j in range(len(w) - k + 1 if k else 0):
            windows[tuple(w[j : j + k])].add(str(i))
    out = {}
    for d, t in docs:
        w = word.findall((t or "").translate(LOW))
        hit, items = [0] * len(w), set()
        for k in {len(x) for x in windows}:
            for j in range(len(w) - k + 1):
                if found := windows.get(tuple(w[j : j + k])):
                    items |= found
                    hit[j : j + k] = [1] * k
        out[d] = (len(w), sum(hit), sorted(items))
    return out


def test_decontaminate(spark):
    rng = random.Random(8)

    def text(n):
        return rng.choice([" ", ", "]).join(rng.choice("ab cd EF é x".split()) for _ in range(n))

    docs = [*((i, text(rng.randint(0, 40))) for i in range(300)), (300, None), (301, text(30_000)), (302, "   ")]
    bench = [*((i, text(rng.choice([0, 1, 3, 4, 5, 9]))) for i in range(30)), (77, None)]
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = decontaminate(table(spark, docs), items, size=5, cleaned=True).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in got} == brute_decontaminate(docs, bench, 5)
    parted = decontaminate(table(spark, docs), items, size=5, cleaned=True, part_bytes=60)
    assert parted.columns == decontaminate(table(spark, docs), items, size=5, cleaned=True).columns
    assert sorted(parted.collect(), key=lambda r: r["doc_id"]) == sorted(got, key=lambda r: r["doc_id"])
    nameless = decontaminate(table(spark, docs), items.withColumn("item_id", F.lit(None).cast("long")), size=5)
    assert {(r["doc_id"], r["n_hit"], len(r["items"])) for r in nameless.collect()} == {(r["doc_id"], r["n_hit"], 0) for r in got}
    for r in got:
        cut = b"".join(r["text"].encode()[s["start"] : s["end"]] for s in r["spans"]) if r["spans"] else b""
        assert (r["clean_text"] is None) == (r["n_hit"] == 0)
        if r["n_hit"]:
            assert len(r["clean_text"].encode()) + len(cut) == len(r["text"].encode())
    assert decontaminate(table(spark, docs), items.where("false")).agg(F.sum("n_hit")).first()[0] == 0
    assert decontaminate(table(spark, []), items).count() == 0


def brute_classes(docs, size=5):
    sets = {}
    for d, t in docs:
        w = re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOW))
        sets[d] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    names = sorted(sets)
    label = {d: d for d in names}
    changed = True
    links = [(a, b) for k, a in enumerate(names) for b in names[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {d: (len(sets[d]), label[d]) for d in names}


def near_copies():
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(40)]
    docs = []
    for g in range(12):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([3, 30, 80]))]
        for _ in range(rng.randint(1, 8)):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = f"z{rng.randint(0, 99)}"
            docs.append(" ".join(words))
    docs += [" ".join([*passage, *(f"q{g}-{i}" for i in range(10))]) for g in range(25)]
    chain = [f"c{i}" for i in range(80)]
    docs += [" ".join(chain[3 * k : 3 * k + 60]) for k in range(6)]
    docs += ["", " \n", "one", "One", "one two", None, docs[0], docs[0].upper()]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize(("rounds", "column", "block"), [(0, 4, 3), (0, 64, 512), (1, 2, 7), (3, 64, 512)])
def test_jaccard_classes(spark, monkeypatch, rounds, column, block):
    monkeypatch.setattr(jaccard, "HUB_ROUNDS", rounds)
    monkeypatch.setattr(jaccard, "DENSE_COLUMN", column)
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", block)
    docs = near_copies()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_classes(table(spark, docs)).collect()}
    assert got == brute_classes(docs)


def test_jaccard_of_nothing(spark):
    assert jaccard_classes(table(spark, [])).count() == 0
    got = sorted(map(tuple, jaccard_classes(table(spark, [(5, "a b"), (5, "a b"), (3, "A  b"), (None, "a b")])).collect()), key=str)
    assert got == sorted([(5, 1, 3), (5, 1, 3), (3, 1, 3), (None, 1, 3)], key=str)


def test_components(spark):
    rng = random.Random(10)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(1000, k) for k in range(2000, 2300)] + [(k, k + 1) for k in range(5000, 5060)] + [(7, 7)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    assert {r["node"]: r["component"] for r in components(df).collect()} == {x: find(x) for x in parent}
    assert components(df.where("false")).count() == 0


def test_top_k(spark):
    rng = np.random.default_rng(13)
    v = [list(map(float, x)) for x in rng.normal(size=(400, 6)).astype(np.float32)]
    v[7], v[8], v[9], v[300] = v[200], v[200], None, [1.0, None, 0.0, 0.0, 0.0, 0.0]
    v[301], v[302] = [float("nan")] * 6, [1.0, 2.0]
    v[303] = [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0]
    df = spark.createDataFrame([(i, x, 9) for i, x in enumerate(v)], "vec_id long, embedding array<float>, rank int").repartition(3)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in top_k(df, F.col("vec_id") % 20 == 0, k=5).collect())
    ok = [i for i, x in enumerate(v) if x is not None and len(x) == 6 and all(y is not None and math.isfinite(y) for y in x)]
    ints = {i: [math.floor(1024 * float(np.float32(y))) for y in v[i]] for i in ok}
    want = []
    for q in (i for i in ok if i % 20 == 0):
        best = sorted(((-sum(a * b for a, b in zip(ints[q], ints[i], strict=True)), i) for i in ok if i != q))[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == sorted(want)
    assert top_k(df.where("false"), F.lit(True)).count() == 0


def test_top_k_of_huge_numbers(spark):
    df = spark.createDataFrame([(0, [1e5, 1e5]), (1, [1e5, 1e5 - 0.001]), (2, [1e5, 99999.0])], "vec_id long, embedding array<double>")
    got = [(r["vec_id"], r["score"]) for r in top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    f = lambda x: math.floor(1024 * x)
    assert got == [(1, f(1e5) ** 2 + f(1e5) * f(1e5 - 0.001)), (2, f(1e5) ** 2 + f(1e5) * f(99999.0))]


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def test_urls(spark):
    rows = [
        (1, "http://a.net/x#f", '<link rel="canonical" href="/y">'), (2, "http://A.net/y", None), (3, "http://b.com/de/1", "<link href=http://a.net/y rel=canonical>"), (4, "http://c.org", "q"), (5, None, None),
        (6, "nope", ""), (7, "http://v.net/", '<META http-equiv="refresh" content="5;URL=http://w.com/de/9">'), (8, "https://m.EXAMPLE.org/en/12?x", ""), (9, "http://xorg/", ""), (10, "HTTP://u.net/a://b", ""),
        (11, "http://r.net/1", ""), (12, "http://q.com/fr/a", '<link rel=canonical href="http://s.net/">'), (13, "http://s.net/", '<link rel=canonical href="http://b.com/de/1">'), (14, "http://s.net/", ""),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("verdict", F.lit("clash"))
    moved = spark.createDataFrame([("http://r.net/1", "http://b.net/2"), ("http://b.net/2", "http://k.com/de/3"), (None, "x")], "src string, dst string")
    got = {r["page_id"]: r for r in judge_urls(pages, RULES, moved).collect()}
    assert {i: r["verdict"] for i, r in got.items()} == {
        1: "allow", 2: "allow", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "block", 8: "block", 9: "allow", 10: "allow", 11: "block", 12: "allow", 13: "allow", 14: "allow"
    }
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"]) for i in (3, 4, 5, 8, 10)] == [("b.com", "/de/1", "com/de/"), ("c.org", "", None), ("", "", None), ("m.example.org", "/en/12", "example.org/en/1"), ("u.net", "/a://b", None)]
    assert judge_urls(pages.where("false"), RULES).count() == 0


def fill(budget, kids):
    out, left = {}, list(kids)
    budget = min(budget, sum(c for _, _, c in kids))
    while left:
        total = sum(w for _, w, _ in left)
        full = [k for k in left if k[2] <= k[1] * budget / total + 1e-9]
        if not full:
            return out | {n: w * budget / total for n, w, _ in left}
        for k in full:
            out[k[0]] = k[2]
            budget -= k[2]
            left.remove(k)
    return out


def test_mixing(spark, monkeypatch):
    from orfloom.llm import mixing

    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    rng = random.Random(14)
    rows = [(i, "w " * rng.choice([0, 1, 5, 30]), rng.choice(["x", "y", None]), rng.choice("abc")) for i in range(300)] + [(300, None, "x", "a"), (5, "w w", "x", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, g string, s string").withColumn("epoch", F.lit("clash"))
    got = collections.Counter((r["doc_id"], r["text"], r["epoch"]) for r in mix_sources(df, [F.col("g"), F.col("s")], [{"x": 3.0}, {"a": 2.0}], fraction=1.1, max_epochs=3, seed=2).collect())
    leaves = collections.defaultdict(list)
    for i, t, g, s in rows:
        leaves[("null" if g is None else "=" + g), "=" + s].append((i, t, len((t or "").split())))
    size = {k: sum(n for *_, n in x) for k, x in leaves.items()}
    top = fill(1.1 * sum(size.values()), [(g, {"=x": 3.0}.get(g, 1.0), 3 * sum(v for k, v in size.items() if k[0] == g)) for g in sorted({k[0] for k in size})])
    want = collections.Counter()
    for g, b in top.items():
        for s, share in fill(b, [(k[1], {"=a": 2.0}.get(k[1], 1.0), 3 * v) for k, v in size.items() if k[0] == g]).items():
            docs, total = leaves[g, s], size[g, s]
            budget = math.floor(share + 1e-6)
            full = budget // total
            for e in range(1, full + 1):
                want.update((i, t, e) for i, t, _ in docs)
            places = collections.defaultdict(list)
            for i, t, n in docs:
                places[int(hashlib.md5(f"2-{full + 1}-{i}".encode()).hexdigest()[:15], 16)].append((i, t, n))
            spent = 0
            for p in sorted(places):
                spent += sum(n for *_, n in places[p])
                if spent > budget - full * total:
                    break
                want.update((i, t, full + 1) for i, t, _ in places[p])
    assert got == want
    assert mix_sources(df.where("false"), [F.col("g")], [{}]).count() == 0


def test_quality(spark):
    from orfloom.llm.quality import fit_quality, score_quality

    rng = random.Random(15)
    rows = []
    for i in range(400):
        good = i % 3 != 0
        words = [rng.choice("the cat sat on mat and dog ran".split()) if good else rng.choice(["x###", "$$$", "a | b", "%%%"]) for _ in range(30)]
        rows.append((i, " ".join(words), "en" if good else "xx", "s1" if good else "s2", "clash"))
    rows += [(400, None, None, None, "x"), (401, "", "en", None, "x"), (402, "word " * 50_000, "en", "s1", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(0, 400, 2)] + [(0, None), (None, 1)], "doc_id long, quality int")
    model = fit_quality(df, labels)
    got = {r["doc_id"]: r for r in score_quality(df, model).collect()}
    assert len(got) == 403 and all(0 <= r["score"] <= 1 for r in got.values())
    assert sum((got[i]["score"] >= 0.5) == (i % 3 != 0) for i in range(1, 400, 2)) >= 195
    flat = fit_quality(df, labels.where("false"))
    assert {r["score"] for r in score_quality(df, flat).collect()} == {0.5}
    assert score_quality(df.where("false"), model).count() == 0


def test_url_sql_follows_links(spark, tmp_path):
    import duckdb

    from orfloom.llm.queries import op10_url_filter
    from orfloom.llm.sql import ORACLES

    rows = [
        (1, "http://a.net/x#f", '<link rel="canonical" href="/y">'), (2, "http://A.net/y", None), (3, "http://b.com/de/1", "<link href=http://a.net/y rel=canonical>"), (4, None, "<p>"), (5, "nope", ""),
        (6, "http://v.net/d/e?q", '<META http-equiv="refresh" content="5;URL=f">'), (7, "http://v.net/d/f", "<link rel=canonical href=//w.com/de/9>"), (8, "http://k.example.org/es/", ""), (9, "http://z.org", ""),
    ]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    got = op10_url_filter(spark, str(tmp_path)).collect()
    db = duckdb.connect()
    db.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    want = db.execute(f"select page_id, host, path, rule, verdict from ({ORACLES['op10_url_filter']})").fetchall()
    assert sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got) == sorted(want)
    assert {r["page_id"] for r in got if r["verdict"] == "block"} == {1, 2, 3, 6, 7, 8}
