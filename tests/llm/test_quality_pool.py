"""op9_quality: the exchange goes over all unlabelled documents, not over a sample."""

import random


def test_all_unlabelled_rows_are_exchanged(spark):
    from orfloom.llm.quality import SHARE, fit_quality, score_quality

    rng = random.Random(23)
    rows = []
    for i in range(24_000):
        good = rng.random() < 0.6
        words = [rng.choice("the cat sat on mat and dog ran by a tree".split()) if good == (rng.random() < 0.9) else rng.choice(["x###", "$$$", "a | b", "%%%"]) for _ in range(12)]
        rows.append((i, " ".join(words), "en" if good == (rng.random() < 0.9) else "xx", ("s1" if good == (rng.random() < 0.9) else "s2"), int(good)))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, good int").repartition(4)
    model = fit_quality(df, df.where("doc_id < 600").selectExpr("doc_id", "good quality"))
    # three rounds over a pool of 8000 could give no more than this
    assert max(model.given) > 3 * SHARE * 8000
    got = score_quality(df.where("doc_id >= 600"), model).collect()
    assert sum((r["score"] >= 0.5) == (r["good"] == 1) for r in got) >= 0.95 * len(got)


def test_copies_of_a_labelled_document_are_one_row(spark):
    from pyspark.sql import functions as F

    from orfloom.llm.quality import fit_quality

    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string"), F.lit(" good text")).alias("text"))
    labels = spark.range(40).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"))
    many = docs.unionByName(docs.where("doc_id = 3").crossJoin(spark.range(3000)).select("doc_id", "text"))
    a, b = fit_quality(docs, labels), fit_quality(many, labels)
    assert a.base == b.base and len(a.views) == len(b.views)
