"""The dual-tree search: it prunes where there are clusters, agrees with brute force, and takes odd vectors."""

import math

import numpy as np
from pyspark.sql import functions as F

from orfloom.llm.topk import LEAF_ROWS, Best, cover_tree, search_block, top_k


def searched(queries, points, k=10):
    best = Best(len(queries), k)
    ids = np.arange(len(points)) + 10**6
    done = search_block(queries, np.arange(len(queries)), cover_tree(queries, np.arange(len(queries))), points, ids, best)
    scores = (queries @ points.T).astype(np.int64)
    order = np.lexsort((np.broadcast_to(ids, scores.shape), -scores), axis=-1)[:, :k]
    assert (best.id == ids[order]).all() and (best.score == np.take_along_axis(scores, order, 1)).all()
    return done / scores.size


def test_clusters_are_pruned_by_pairs_of_nodes():
    rng = np.random.default_rng(31)
    centers = rng.normal(size=(20, 16)) * 1000
    queries = np.floor(np.repeat(centers, 3 * LEAF_ROWS, axis=0) + rng.normal(size=(20 * 3 * LEAF_ROWS, 16)))
    points = np.floor(np.repeat(centers, 100, axis=0) + rng.normal(size=(2000, 16)))
    rng.shuffle(queries)
    rng.shuffle(points)
    assert searched(queries, points) < 0.2


def test_random_vectors_are_exact():
    rng = np.random.default_rng(32)
    assert searched(np.floor(rng.normal(size=(300, 24)) * 1024), np.floor(rng.normal(size=(1500, 24)) * 1024)) <= 1
    assert searched(np.zeros((5, 3)), np.zeros((400, 3))) <= 1  # nothing but ties


def test_vectors_out_of_range(spark):
    rows = [(0, [1.0, 2.0]), (1, [1e306, 0.0]), (2, [1e200, 1.0]), (3, [-1e200, 1.0]), (4, [3.0, 1.0]), (4, [3.0, 1.0]), (None, [9.0, 9.0]), (5, []), (6, [2.0] * 5000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["vec_id"], r["score"]) for r in top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    most = 2**63 - 2
    fit = 1024 * 3 * 1024 + 1024 * 2048
    assert got == [(2, most), (4, fit), (4, fit), (3, -most)] and math.isfinite(fit)
    assert [(r["vec_id"], r["score"]) for r in top_k(df, F.col("vec_id") == 2).orderBy("rank").collect()][-1] == (3, -most)
