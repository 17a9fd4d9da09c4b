"""The pipeline's stages on a small corpus, against plain versions."""

import random
import re
import zlib

import numpy as np
import public_tokenizers

import corpus_pipeline

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def corpus():
    rng = random.Random(16)
    items = [" ".join(f"bench{i}x{k}" for k in range(15)) for i in range(3)]
    rows = [(i, " ".join(rng.choice(["the", "and", "of", f"w{i}a", f"w{i}b", f"w{rng.randint(0, 999)}"]) for _ in range(60)), "en" if i % 2 else "de", f"src{i % 4}") for i in range(60)]
    rows += [(100 + i, rows[i][1], "en", "src0") for i in range(5)]
    rows += [(200 + i, rows[10 + i][1] + " " + items[i] + " tail", "en", "src1") for i in range(3)]
    rows += [(300, items[0], "en", "src1"), (301, None, "en", "src2"), (302, "12 !!", None, "src2"), (303, rows[20][1], None, None), (303, rows[20][1], None, None)]
    return rows, list(enumerate(items))


def test_stages(spark, tmp_path):
    from tokenizers import Tokenizer

    rows, items = corpus()
    docs = spark.createDataFrame([(i, t, x, s, len(t or "")) for i, t, x, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    state, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, state, str(tmp_path)).write.parquet(str(tmp_path / name))
        state = spark.read.parquet(str(tmp_path / name))
        if k < 4:
            assert state.columns == docs.columns
        kept[name] = {r["doc_id"]: r for r in state.collect()}
        assert state.count() == len(kept[name]) or name == "language_id"
    everything = {i for i, *_ in rows}
    assert set(kept["language_id"]) == everything - {301, 302} and kept["language_id"][303]["lang"] in ("en", "de")
    assert set(kept["near_duplicates"]) == everything - {301, 302, *range(100, 105), 303, *range(200, 203)} | (set(kept["near_duplicates"]) & {200, 201, 202})
    windows = {tuple(w[i : i + 10]) for _, t in items for w in [WORD.findall(t.translate(LOW))] for i in range(len(w) - 9)}
    assert 300 not in kept["decontamination"]
    for r in kept["decontamination"].values():
        w = WORD.findall(r["text"].translate(LOW))
        assert not windows & {tuple(w[i : i + 10]) for i in range(len(w) - 9)} and r["n_chars"] == len(r["text"])
    total = sum(len(r["text"].split()) for r in kept["decontamination"].values())
    assert 0.7 * total <= sum(len(r["text"].split()) for r in kept["mixing"].values()) <= 0.9 * total
    library, start = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    for i in sorted(kept["mixing"]):
        ids = [*library.encode(kept["mixing"][i]["text"], add_special_tokens=False).ids, 0]
        r = kept["token_output"][i]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(tuple, kept["token_output"].values()))


def test_empty(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_duplicates_by_row(spark):
    import corpus_pipeline

    long = " ".join(f"w{i}" for i in range(80))
    near = long.replace("w40", "x")
    rows = [(5, long), (None, near), (7, long), (3, near), (None, "alone without an id"), (9, "one of two texts"), (9, "the other text of nine"), (None, None), (4, None), (4, None), (None, "alone without an id")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "more") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, __key string").repartition(3)
    got = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    want = [(3, near), (None, "alone without an id"), (9, "one of two texts"), (9, "the other text of nine"), (None, None), (4, None)]
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(want, key=str) and all(r["__key"] == "more" for r in got)
