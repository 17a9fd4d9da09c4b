"""Sweeps with a key over many tasks, resampling, strengths and ranks, against plain loops."""

import random

import numpy as np
from pyspark.sql import functions as F

from orfloom.operators import stats, sweeps


def test_running_totals_cross_parts(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, 1, 1, 1]), i, rng.choice([None, *range(9)])) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, i int, v int").repartition(3)
    got = {(r["k"], r["i"]): (r["s"], r["m"]) for r in sweeps.running(df, ["k"], ["i"], {"s": ("sum", "v"), "m": ("max", "v")}).collect()}
    for k in (None, 1):
        seen = []
        for _, i, v in sorted((r for r in rows if r[0] == k), key=lambda r: r[1]):
            assert got[k, i] == (sum(seen) if seen else None, max(seen, default=None))
            seen += [v] if v is not None else []
    assert sweeps.running(df.where("false"), ["k"], ["i"], {"s": ("sum", "v")}).count() == 0


def first_fit(rows):
    out = {}
    for k, _, a, b, name in sorted(rows, key=lambda r: r[1]):
        if a is None or a >= b:
            continue
        for c in out.setdefault(k, []):
            if a < c[1] and c[0] < b:
                c[0], c[1], c[2] = min(a, c[0]), max(b, c[1]), c[2] + 1
                c[3].add(name)
                break
        else:
            out[k].append([a, b, 1, {name}])
    return sorted((k if k is not None else -1, a, b, n, ",".join(sorted(m))) for k, cs in out.items() for a, b, n, m in cs)


def test_first_fit_leaves_bridged_clusters_apart(spark):
    rng = random.Random(2)
    rows = [(7, 0, 0, 10, "a"), (7, 1, 20, 30, "b"), (7, 2, 5, 25, "c"), (7, 3, 24, 26, "d"), (7, 4, 40, 40, "e"), (None, 5, 1, 2, "f")]
    rows += [(rng.choice([1, 1, 1, 2]), 10 + i, a := rng.randint(0, 3000), a + rng.randint(1, 25), rng.choice("uvw")) for i in range(600)]
    df = spark.createDataFrame(rows, "k int, nr int, a int, b int, name string").repartition(5)
    got = sorted((r["k"] if r["k"] is not None else -1, r["a"], r["b"], r["n"], r["members"]) for r in sweeps.first_fit_clusters(df, ["k"], ["nr"], "a", "b", "name").collect())
    assert got == first_fit(rows)
    assert [r[1:4] for r in got if r[0] == 7] == [(0, 26, 3), (20, 30, 1)]  # c bridges and joins the first; d meets that one first too
    chains = sweeps.islands(df.where("k = 1 and a < b"), ["k"], "a", "b", -1).select("island").distinct().count()
    assert chains < len([r for r in got if r[0] == 1])
    assert sweeps.first_fit_clusters(df.where("false"), ["k"], ["nr"], "a", "b", "name").count() == 0


def test_ranks_have_no_single_task(spark):
    rows = [(i, float(i % 7) if i % 11 else None, "p" if i % 3 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, v double, p string")
    for part in ([], ["p"]):
        ranked = sweeps.average_ranks(df, "v", part)
        plan = ranked._jdf.queryExecution().executedPlan().toString().splitlines()
        assert all("HashAggregate" in plan[i + 1] for i, line in enumerate(plan) if "SinglePartition" in line)  # totals of parts, never rows
        for r in ranked.collect():
            peers = [v for i, v, p in rows if v is not None and (not part or p == r["p"])]
            want = None if r["v"] is None else sum(v < r["v"] for v in peers) + (sum(v == r["v"] for v in peers) + 1) / 2
            assert r["rank"] == want and (r["v"] is None or r["rank_of"] == len(peers))


def test_every_replicate_draws_all_clusters(spark):
    rows = [(f"c{i // 2}", float(i % 13)) for i in range(400)] + [(None, 3.0), ("c1", None)]
    df = spark.createDataFrame(rows, "c string, v double")
    a, b = (stats.resampled_sums(x, "c", "v", 300, 5, leaf_clusters=16).orderBy("rep").toPandas() for x in (df.repartition(1), df.repartition(7)))
    assert (a["draws"] == 201).all() and np.allclose(a, b)
    n, means = 201, a["s"] / a["n"]
    assert abs(means.mean() - 6.0) < 0.15 and 0.5 < means.std() / (np.std([x[1] for x in rows if x[1] is not None]) / np.sqrt(2 * n)) < 1.6
    assert stats.resampled_sums(df.where("false"), "c", "v", 5).count() == 0
    low, high = stats.cluster_bootstrap(df, "c", "v", 300).select("low", "high").first()
    assert low < 6.0 < high


def test_strengths_in_spark_equal_the_dense_ones(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(300):
        x, y = rng.sample(range(9), 2)
        if (x < 6) == (y < 6):  # two components
            rows.append((f"a{x}", f"a{y}", f"a{x}" if rng.random() < 0.4 + 0.05 * (x - y) else f"a{y}"))
    df = spark.createDataFrame([*rows, ("a0", "a1", None)], "x string, y string, w string")
    dense = {r["arm"]: (r["strength"], r["component"]) for r in stats.pair_strengths(df, "x", "y", "w", 6).collect()}
    joined = {r["arm"]: (r["strength"], r["component"]) for r in stats.pair_strengths(df, "x", "y", "w", 6, dense_arms=3).collect()}
    assert dense.keys() == joined.keys() and all(abs(dense[k][0] - joined[k][0]) < 1e-9 and dense[k][1] == joined[k][1] for k in dense)
    assert dense["a0"] == (0.0, "a0") and dense["a7"][1] == "a6" and dense["a6"][0] == 0.0
    assert stats.pair_strengths(df.where("false"), "x", "y", "w").count() == 0


def test_many_arms_stay_in_spark(spark):
    df = spark.range(3000).select(F.concat(F.lit("a"), F.col("id")).alias("x"), F.concat(F.lit("a"), (F.col("id") + 1) % 3000).alias("y")).withColumn("w", F.col("x"))
    got = stats.pair_strengths(df, "x", "y", "w", rounds=1)
    assert got.count() == 3000 and got.select("component").distinct().count() == 1


def test_picks_by_proposals_equal_claims_in_turn(spark):
    rng = random.Random(8)
    rows = [(i, f"g{rng.randint(0, 25)}" if i % 17 else None, f"s{rng.randint(0, 4)}", float(rng.randint(0, 40))) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, g string, s string, v double")
    for slots in (7, 23, 60):
        quotas = {r["s"]: r["quota"] for r in stats.even_quotas(df, "s", slots).collect()}
        assert sum(quotas.values()) == slots and [quotas[k] for k in sorted(quotas)] == sorted(quotas.values(), reverse=True)
        groups, filled, want = set(), {}, set()
        for i, g, s, _ in sorted((r for r in rows if r[1]), key=lambda r: (-r[3], r[0])):
            if g not in groups and filled.get(s, 0) < quotas[s]:
                groups.add(g)
                filled[s] = filled.get(s, 0) + 1
                want.add((i, filled[s]))
        got = stats.quota_picks(df, "i", "g", "s", "v", 0, quotas=stats.even_quotas(df, "s", slots))
        assert {(r["i"], r["rank"]) for r in got.collect()} == want


def test_invariants_of_a_factor_analysis(spark):
    rng = random.Random(4)
    rows = [(i, *(rng.gauss(0, k + 1) if rng.random() < 0.9 else None for k in range(6)), float(i % 5)) for i in range(80)]
    df = spark.createDataFrame(rows, "i int, a double, b double, c double, d double, e double, f double, v double")
    got = {(r["check"], r["item"]): (r["value"], r["holds"]) for r in stats.factor_invariants(df, "i", {"x": ["a", "b"], "y": ["c", "d", "e", "f"]}, ["v"], 2, 30).collect()}
    assert all(holds for _, holds in got.values() if holds is not None)
    assert abs(got["leading_eigenvalue", "y"][0] - 1) < 1e-8 and got["distance_error", "30 pairs"][0] < 1e-9
    x = np.array([[np.nan if v is None else v for v in r[1:7]] for r in rows])
    z = np.nan_to_num((x - np.nanmean(x, 0)) / np.nanstd(x, 0))
    for cut in (slice(0, 2), slice(2, 6)):
        z[:, cut] /= np.linalg.svd(z[:, cut], compute_uv=False)[0]
    assert abs(got["imputation_bias", ""][0] - np.corrcoef(np.linalg.norm(z, axis=1), (~np.isnan(x)).mean(1))[0, 1]) < 1e-9
    scores = z @ np.linalg.svd(z)[2][0]
    assert abs(abs(got["correlation", "factor 1, v"][0]) - abs(np.corrcoef(scores, [r[7] for r in rows])[0, 1])) < 1e-9
