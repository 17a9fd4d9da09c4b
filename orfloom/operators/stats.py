"""Evaluation statistics, catalogues and reconciliation."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orfloom.functions.scalars import numbers_in
from orfloom.operators.sweeps import average_ranks
from orfloom.scratch import stored


def order_consistency(df: DataFrame, unit: str, a: str, b: str, winner: str) -> DataFrame:
    """Pairs judged in both orders: unparseable, inconsistent or consistent, per unit (EQ01)."""
    x = df.where(F.col(a) < F.col(b)).select(unit, F.col(a).alias("x"), F.col(b).alias("y"), F.col(winner).alias("w1"))
    y = df.where(F.col(a) > F.col(b)).select(unit, F.col(b).alias("x"), F.col(a).alias("y"), F.col(winner).alias("w2"))
    state = F.when(F.col("w1").isNull() | F.col("w2").isNull(), "unparseable").when(F.col("w1") == F.col("w2"), "consistent").otherwise("inconsistent")
    return x.join(y, [unit, "x", "y"]).groupBy(unit, state.alias("state")).agg(F.count("*").alias("n"))


def slot_rate(df: DataFrame, keys: list[str], a: str, winner: str) -> DataFrame:
    """How often the first slot wins (EQ02)."""
    return df.where(F.col(winner).isNotNull()).groupBy(*keys).agg(F.avg((F.col(winner) == F.col(a)).cast("int")).alias("slot_a_rate"), F.count("*").alias("n"))


def quartile_rates(df: DataFrame, value: str, won: Column, row_id: str, part: list[str]) -> DataFrame:
    """Win rate in the quarters of a value's order, cut at ``q*n/4`` (WN12)."""
    w = Window.partitionBy(*part)
    rn = F.row_number().over(w.orderBy(value, row_id))
    q = F.floor((rn - 1) * 4 / F.count("*").over(w)).cast("int")
    return df.withColumn("quartile", q).groupBy(*part, "quartile").agg(F.avg(won.cast("int")).alias("win_rate"), F.count("*").alias("n"))


#: Arms whose square table of wins is worked on in memory (8 MB); more of them stay in Spark.
DENSE_ARMS = 1000


def pair_strengths(df: DataFrame, a: str, b: str, winner: str, rounds: int = 200, prior: float = 0.5, tolerance: float = 1e-10, dense_arms: int = DENSE_ARMS) -> DataFrame:
    """Log strengths of the arms by minorise-maximise over pair counts (EQ03), and the ``component`` of arms that met; its first arm is 0.

    Arms of different components were never compared, so each component has a
    scale of its own.  Spark counts the pairs.  Up to ``dense_arms`` arms the
    steps run on their square table, else as joins of the strengths with the
    sparse table of pairs, until no log strength moves by ``tolerance``.
    """
    won = df.where(F.col(winner).isNotNull()).select(F.col(winner).cast("string").alias("w"), F.when(F.col(winner) == F.col(a), F.col(b)).otherwise(F.col(a)).cast("string").alias("l"))
    wins = stored(won.groupBy("w", "l").agg(F.count("*").alias("n")), "pair-wins")
    arms = wins.select(F.col("w").alias("arm")).union(wins.select("l")).distinct()
    if arms.limit(dense_arms + 1).count() <= dense_arms:
        return _dense_strengths(wins, rounds, prior, tolerance)
    return _joined_strengths(wins, rounds, prior, tolerance)


def _dense_strengths(wins: DataFrame, rounds: int, prior: float, tolerance: float) -> DataFrame:
    counts = wins.collect()  # of at most dense_arms squared pairs
    arms = sorted({x for r in counts for x in (r["w"], r["l"])})
    place = {x: i for i, x in enumerate(arms)}
    m = np.zeros((len(arms), len(arms)))
    for r in counts:
        m[place[r["w"]], place[r["l"]]] += r["n"]
    met = (m + m.T) > 0
    first = np.arange(len(arms))
    while True:
        least = np.where(met, first[None, :], len(arms)).min(axis=1, initial=len(arms))
        new = np.minimum(first, least)
        if (new == first).all():
            break
        first = new
    m = m + prior * met
    log = np.zeros(len(arms))
    for _ in range(rounds):
        s = np.exp(log)
        new = np.log(m.sum(1)) - np.log(np.maximum(((m + m.T) / (s[:, None] + s[None, :])).sum(1), 1e-300))
        new -= new[first]
        done = np.abs(new - log).max(initial=0) < tolerance
        log = new
        if done:
            break
    return wins.sparkSession.createDataFrame([(x, float(v), arms[f]) for x, v, f in zip(arms, log, first, strict=True)], "arm string, strength double, component string")


def _joined_strengths(wins: DataFrame, rounds: int, prior: float, tolerance: float) -> DataFrame:
    """The same steps on ``(arm, other, met, own wins)`` rows; a step is a written table of one row an arm."""
    both = wins.select(F.col("w").alias("arm"), F.col("l").alias("other"), F.col("n").alias("won"), F.col("n").alias("met")).unionByName(wins.select(F.col("l").alias("arm"), F.col("w").alias("other"), F.lit(0).cast("long").alias("won"), F.col("n").alias("met")))
    pairs = stored(both.groupBy("arm", "other").agg((F.sum("won") + prior).alias("won"), (F.sum("met") + 2 * prior).alias("met")), "met-pairs")
    total = pairs.groupBy("arm").agg(F.sum("won").alias("total"))
    least = stored(total.select("arm", F.col("arm").alias("component")), "components")
    while True:  # each arm takes the least component around it, then that component's own one
        around = pairs.join(least.withColumnsRenamed({"arm": "other", "component": "near"}), "other").groupBy("arm").agg(F.min("near").alias("near"))
        moved = least.join(around, "arm").select("arm", F.least("component", "near").alias("component"), F.col("component").alias("was"))
        jump = moved.select(F.col("arm").alias("component"), F.col("component").alias("further"))
        moved = stored(moved.join(jump, "component").select("arm", F.least("component", "further").alias("component"), "was"), "components")
        least = moved.drop("was")
        if moved.where("component <> was").isEmpty():
            break
    fixed = stored(total.join(least, "arm"), "arms")
    state = fixed.select("arm", "component", "total", F.lit(0.0).alias("log"))
    for _ in range(rounds):
        other = state.select(F.col("arm").alias("other"), F.col("log").alias("other_log"))
        shares = pairs.join(other, "other").join(state.select("arm", "log"), "arm").groupBy("arm").agg(F.sum(F.col("met") / (F.exp("log") + F.exp("other_log"))).alias("share"))
        new = state.join(shares, "arm").select("arm", "component", "total", F.col("log").alias("was"), (F.log("total") - F.log("share")).alias("new"))
        zero = new.where("arm = component").select("component", F.col("new").alias("zero"))
        step = stored(new.join(zero, "component").select("arm", "component", "total", (F.col("new") - F.col("zero")).alias("log"), "was"), "strengths")
        state = step.drop("was")
        if (step.agg(F.max(F.abs(F.col("log") - F.col("was")))).first()[0] or 0.0) < tolerance:
            break
    return state.select("arm", F.col("log").alias("strength"), "component")


def logistic_pairs(df: DataFrame, label: str, features: list[str], ridge: float = 1e-3) -> DataFrame:
    """Ridge logistic fit of pair outcomes on covariates (EQ04), as ``(feature, weight)``."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    rows = VectorAssembler(inputCols=features, outputCol="__x", handleInvalid="skip").transform(df.where(F.col(label).isNotNull()).withColumn("__y", F.col(label).cast("double")))
    model = LogisticRegression(featuresCol="__x", labelCol="__y", regParam=ridge, elasticNetParam=0.0, standardization=False).fit(rows)
    weights = [*zip(features, model.coefficients.toArray().tolist(), strict=True), ("intercept", float(model.intercept))]
    return df.sparkSession.createDataFrame(weights, "feature string, weight double")


#: Clusters of a leaf of the resampling tree, about; and the most leaves (8 MB of counts).
LEAF_CLUSTERS, MOST_LEAF_BITS = 1 << 16, 20


def _leaf_draws(leaf: int, bits: int, counts: np.ndarray, replicates: int, seed: int) -> np.ndarray:
    """How many draws of each replicate fall to a leaf: binomial splits on the way from the root, the same in every task."""
    draws = np.full(replicates, int(counts.sum()), dtype=np.int64)
    lo, hi = 0, len(counts)
    for level in range(bits):
        mid = (lo + hi) // 2
        left, both = int(counts[lo:mid].sum()), int(counts[lo:hi].sum())
        to_left = np.random.default_rng((seed, level, lo)).binomial(draws, left / both)
        if leaf < mid:
            draws, hi = to_left, mid
        else:
            draws, lo = draws - to_left, mid
    return draws


def resampled_sums(df: DataFrame, cluster: str, value: str, replicates: int = 2000, seed: int = 0, leaf_clusters: int = LEAF_CLUSTERS) -> DataFrame:
    """``rep, s, n, draws``: sum and rows of each replicate, which draws as many clusters as there are, with replacement.

    Clusters are dealt by hash to the leaves of a binary tree; a replicate's
    draws go down it by binomial splits and inside a leaf by a multinomial.  All
    random numbers depend on the seed and the place in the tree only, so the
    replicates do not depend on how Spark partitions the table.
    """
    sums = df.where(F.col(value).isNotNull()).groupBy(cluster).agg(F.sum(value).cast("double").alias("s"), F.count("*").alias("n"))
    sums = stored(sums.select(F.col(cluster).cast("string").alias("c"), F.xxhash64(cluster, F.lit(seed)).alias("h"), "s", "n"), "clusters")
    bits = min(MOST_LEAF_BITS, max(0, math.ceil(math.log2(max(1, sums.count() / leaf_clusters)))))
    leaf = F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("long")
    dealt = sums.withColumn("leaf", leaf)
    counts = np.zeros(1 << bits, dtype=np.int64)
    for r in dealt.groupBy("leaf").count().collect():  # a number for each leaf
        counts[r["leaf"]] = r["count"]

    def draw(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["h", "c"], kind="stable", na_position="first")
        at, m = int(f["leaf"].iloc[0]), len(f)
        draws = _leaf_draws(at, bits, counts, replicates, seed)
        rng = np.random.default_rng((seed, bits, at, 1))
        values = f[["s", "n"]].to_numpy(np.float64)
        total = np.zeros((replicates, 2))
        for r in range(replicates):
            total[r] = np.bincount(rng.integers(0, m, int(draws[r])), minlength=m) @ values
        return pd.DataFrame({"rep": np.arange(replicates), "s": total[:, 0], "n": total[:, 1], "draws": draws})

    drawn = dealt.groupBy("leaf").applyInPandas(draw, "rep int, s double, n double, draws long")
    return drawn.groupBy("rep").agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.sum("draws").alias("draws"))


def cluster_bootstrap(df: DataFrame, cluster: str, value: str, replicates: int = 2000, seed: int = 0, level: float = 0.95) -> DataFrame:
    """Percentile interval of a mean under resampling of clusters (EQ05); see :func:`resampled_sums`."""
    means = resampled_sums(df, cluster, value, replicates, seed).select((F.col("s") / F.nullif("n", F.lit(0.0))).alias("m"))
    lo = (1 - level) / 2
    q = means.agg(F.percentile("m", F.array(F.lit(lo), F.lit(1 - lo))).alias("q"))
    known = df.where(F.col(value).isNotNull())
    point = known.agg(F.avg(value).alias("mean"), F.countDistinct(F.coalesce(F.col(cluster).cast("string"), F.lit("\0"))).alias("n_clusters"))
    return point.crossJoin(F.broadcast(q.select(F.col("q")[0].alias("low"), F.col("q")[1].alias("high"))))


def main_effects(df: DataFrame, factors: list[str], value: str) -> DataFrame:
    """Mean with minus mean without each two-level factor (EQ06)."""
    return df.agg(*((F.avg(F.when(F.col(f), F.col(value))) - F.avg(F.when(~F.col(f), F.col(value)))).alias(f) for f in factors))


def ungrounded_numbers(df: DataFrame, text: str, reference: str, places: int = 3) -> DataFrame:
    """Numbers of a text that are neither in its reference nor a rounding of one of its numbers (EQ07, SC24)."""
    said, known = numbers_in(text), numbers_in(reference)
    rounded = F.flatten(F.transform(known, lambda x: F.transform(F.sequence(F.lit(0), F.lit(places)), lambda d: F.regexp_replace(F.format_string("%.6f", F.round(x.cast("double") * F.pow(F.lit(10.0), d)) / F.pow(F.lit(10.0), d)), r"\.?0+$", ""))))
    return df.withColumn("ungrounded", F.array_except(F.array_except(said, known), rounded))


def unmeasured_claims(df: DataFrame, text: str, fields: dict[str, str]) -> DataFrame:
    """Names of fields that a text speaks of (by pattern) although they are null in its row (EQ08)."""
    claims = [F.when(F.col(f).isNull() & F.col(text).rlike(p), F.lit(f)) for f, p in fields.items()]
    return df.withColumn("unmeasured", F.array_compact(F.array(*claims)))


def degenerate_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """Per field: rows, distinct values, most common share (EQ08)."""
    long = df.select(F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("v")) for f in fields))).alias("x")).select("x.*")
    n = long.groupBy("field", "v").agg(F.count("*").alias("n"))
    return n.groupBy("field").agg(F.sum("n").alias("rows"), F.count("v").alias("distinct"), (F.max("n") / F.sum("n")).alias("top_share"))


def missing_cells(expected: list[DataFrame], present: DataFrame) -> DataFrame:
    """Combinations of the small expected lists without an output (EQ09)."""
    grid = expected[0]
    for e in expected[1:]:
        grid = grid.crossJoin(F.broadcast(e))
    return grid.join(present.select(*grid.columns).distinct(), grid.columns, "left_anti")


def provenance(df: DataFrame, index: DataFrame, key: str, build: str, digest: str) -> DataFrame:
    """First problem of each output: not indexed, another build, another hash; and counts (EQ10)."""
    i = index.select(key, F.col(build).alias("__b"), F.col(digest).alias("__d"), F.lit(True).alias("__in"))
    state = F.when(F.col("__in").isNull(), "not_in_index").when(~F.col(build).eqNullSafe(F.col("__b")), "other_build").when(~F.col(digest).eqNullSafe(F.col("__d")), "hash_mismatch").otherwise("ok")
    return df.join(i, key, "left").groupBy(state.alias("state")).agg(F.count("*").alias("n"))


def shard_audit(df: DataFrame, shard: str, group: str, expected: DataFrame) -> DataFrame:
    """Per group: ok, missing, duplicated across shards, or orphan (EQ11)."""
    have = df.groupBy(group).agg(F.countDistinct(shard).alias("shards"), F.count("*").alias("rows"))
    e = expected.select(group).distinct().withColumn("__e", F.lit(True))
    state = F.when(F.col("shards").isNull(), "missing").when(F.col("__e").isNull(), "orphan").when(F.col("shards") > 1, "duplicate").otherwise("ok")
    return e.join(have, group, "full").groupBy(state.alias("state")).agg(F.count("*").alias("n"))


def balanced_shards(df: DataFrame, key: str, weight: str, shards: int) -> DataFrame:
    """Shard of each key, by equal shares of a running weight in key order (EQ12).

    Keys are ranged over hash buckets first, so the running sum needs no
    single ordered partition of all keys.
    """
    b = df.withColumn("__b", F.pmod(F.xxhash64(key), F.lit(4096)))
    sums = b.groupBy("__b").agg(F.sum(weight).cast("double").alias("s"))
    before = F.sum("s").over(Window.orderBy("__b")) - F.col("s")
    starts = sums.select("__b", before.alias("start"), F.sum("s").over(Window.partitionBy(F.lit(1))).alias("total"))
    w = Window.partitionBy("__b").orderBy(key)
    at = F.col("start") + F.sum(weight).over(w) - F.col(weight)
    return b.join(F.broadcast(starts), "__b").withColumn("shard", F.least(F.floor(at / F.col("total") * shards), F.lit(shards - 1)).cast("int")).select(*df.columns, "shard")


def column_checksums(df: DataFrame, row_id: str) -> DataFrame:
    """Order-independent checksum of every column over (id, value) (AG26, EQ13)."""
    cols = [c for c in df.columns if c != row_id]
    sums = df.agg(*(F.sum(F.xxhash64(F.col(row_id), F.col(c).cast("string")).cast("decimal(38,0)")).cast("string").alias(c) for c in cols))
    return sums.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("checksum")) for c in cols))).alias("x")).select("x.*")


def duplicate_columns(df: DataFrame, row_id: str) -> DataFrame:
    """Groups of columns of equal content, the first by name to keep (AG26)."""
    return column_checksums(df, row_id).groupBy("checksum").agg(F.sort_array(F.collect_list("column")).alias("columns")).where(F.size("columns") > 1).select(F.col("columns")[0].alias("keep"), F.array_join("columns", ",").alias("columns"))


def snapshot_compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one side only, with multiplicity (EQ13)."""
    cols = sorted(set(a.columns) & set(b.columns))
    x, y = a.select(*cols), b.select(*cols)
    return x.exceptAll(y).withColumn("side", F.lit("left")).unionByName(y.exceptAll(x).withColumn("side", F.lit("right")))


def check_contract(before: DataFrame, after: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Keys that were lost; raises on missing columns (EQ14)."""
    lacking = [c for c in columns if c not in after.columns]
    if lacking:
        raise ValueError(f"columns missing: {lacking}")
    return before.select(*key).join(after.select(*key), key, "left_anti")


def feature_catalog(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill rate, distinct values and kind of each column, with the reason to leave it out (AG25, AG28)."""
    types = dict(df.dtypes)
    aggs = [F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.count(c).alias("filled"), F.countDistinct(c).alias("distinct"), F.count("*").alias("rows")).alias(c) for c in columns]
    one = df.agg(*aggs)
    out = one.select(F.explode(F.array(*(F.col(c) for c in columns))).alias("x")).select("x.*").withColumn("fill_rate", F.col("filled") / F.col("rows"))
    kind = F.when(F.col("distinct") <= 1, "constant").when((F.col("type") == "boolean") | (F.col("distinct") == 2), "binary").when(F.col("type") == "string", "categorical").otherwise("numeric")
    out = out.withColumn("kind", kind)
    return out.withColumn("reason", F.when(F.col("kind") == "constant", "constant").when(F.col("fill_rate") < 0.5, "sparse").when((F.col("kind") == "categorical") & (F.col("distinct") > 50), "open_set"))


def extreme_picks(df: DataFrame, row_id: str, components: list[str]) -> DataFrame:
    """Per component the largest and smallest row, and the row of least infinity norm (TK05)."""
    rows = df.select(F.col(row_id).alias("id"), F.explode(F.array(*(F.struct(F.lit(c).alias("component"), F.col(c).cast("double").alias("v")) for c in components))).alias("x")).select("id", "x.*")
    ends = rows.groupBy("component").agg(F.min_by("id", F.struct(-F.col("v"), "id")).alias("max"), F.min_by("id", F.struct("v", "id")).alias("min"))
    norm = F.greatest(*(F.abs(F.col(c)) for c in components))
    center = df.agg(F.min_by(row_id, F.struct(norm, row_id)).alias("center"))
    picks = ends.select("component", F.explode(F.create_map(F.lit("max"), F.col("max"), F.lit("min"), F.col("min"))).alias("pick", "id"))
    return picks.unionByName(center.select(F.lit("all").alias("component"), F.lit("center").alias("pick"), F.col("center").alias("id")))


def even_quotas(strata: DataFrame, stratum: str, slots: int) -> DataFrame:
    """``stratum, quota``: slots split evenly, what is left over going to the first strata by name (TK06)."""
    names = strata.where(F.col(stratum).isNotNull()).select(stratum).distinct()
    n = names.count()
    ranked = average_ranks(names, stratum, [], "__rank")
    return ranked.select(stratum, (F.lit(slots // max(1, n)) + (F.col("__rank") <= slots % max(1, n)).cast("int")).alias("quota"))


def quota_picks(df: DataFrame, row_id: str, group: str, stratum: str, score: str, per_stratum: int, excluded: DataFrame | None = None, quotas: DataFrame | None = None) -> DataFrame:
    """Rows of the allowed pool claimed from the best score down, each of another group, ``per_stratum`` (or ``quotas``: stratum, quota) of each stratum (TK06).

    A stratum whose best groups are taken falls through to its next ones.
    Strata and groups like the same rows best, so claiming row by row ends as
    proposals do: every stratum holds its quota of best rows, a group stays with
    the best one that holds it and turns the others away for good, and those
    strata hold their next rows, until no group is held twice.  A round is one
    join over the rows that are left; nothing comes to the driver.
    """
    pool = df.join(excluded, row_id, "left_anti") if excluded is not None else df
    pool = pool.select(row_id, group, stratum, score).where(F.col(group).isNotNull() & F.col(stratum).isNotNull() & F.col(score).isNotNull())
    best = pool.groupBy(stratum, group).agg(F.min_by(F.struct(row_id, score), F.struct(-F.col(score), F.col(row_id))).alias("r")).select("r.*", group, stratum)
    best = best.join(quotas.select(stratum, "quota"), stratum) if quotas is not None else best.withColumn("quota", F.lit(per_stratum))
    left = stored(best, "quota-pool")
    order = [F.desc(score), F.asc(row_id)]
    while True:
        held = left.withColumn("rank", F.row_number().over(Window.partitionBy(stratum).orderBy(*order))).where(F.col("rank") <= F.col("quota"))
        held = stored(held.withColumn("__turn", F.row_number().over(Window.partitionBy(group).orderBy(*order))), "quota-held")
        away = held.where(F.col("__turn") > 1).select(stratum, group)
        if away.isEmpty():
            return held.select(row_id, group, stratum, score, "rank")
        left = stored(left.join(away, [stratum, group], "left_anti"), "quota-pool")


def _fitted(df: DataFrame, row_id: str, blocks: dict[str, list[str]]) -> tuple[list[str], DataFrame, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Columns, standardised rows, their Gram matrix, the columns' block weights, and the weighted matrix's eigenvalues and vectors."""
    cols = [c for b in blocks.values() for c in b]
    stats = df.agg(*(F.avg(c).alias(f"m_{c}") for c in cols), *(F.stddev_pop(c).alias(f"s_{c}") for c in cols)).first()
    z = [F.coalesce((F.col(c).cast("double") - F.lit(stats[f"m_{c}"])) / F.lit(stats[f"s_{c}"] or 1.0), F.lit(0.0)).alias(c) for c in cols]
    rows = df.select(F.col(row_id).alias("id"), *z)

    def gram(frames):
        total = np.zeros((len(cols), len(cols)))
        for f in frames:
            x = f[cols].to_numpy()
            total += x.T @ x
        yield pd.DataFrame({"g": [total.ravel().tolist()]})

    parts = rows.drop("id").mapInPandas(gram, "g array<double>").select(F.posexplode("g").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()  # columns squared
    g = np.zeros(len(cols) ** 2)
    for r in parts:
        g[r["i"]] = r["v"]
    g = g.reshape(len(cols), len(cols))
    scale, at = np.ones(len(cols)), 0
    for b in blocks.values():
        inner = slice(at, at + len(b))
        scale[inner] = 1 / math.sqrt(max(np.linalg.eigvalsh(g[inner, inner])[-1], 1e-300))
        at += len(b)
    values, vectors = np.linalg.eigh(g * scale[:, None] * scale[None, :])
    return cols, rows, g, scale, values, vectors


def factor_invariants(df: DataFrame, row_id: str, blocks: dict[str, list[str]], scores: list[str] | None = None, factors: int = 3, pairs: int = 200, seed: int = 0) -> DataFrame:
    """``check, item, value, holds``: what must hold of a factor analysis before its scores are used (FS04).

    ``leading_eigenvalue`` of each weighted block is 1; ``contributions`` of the
    blocks to each factor sum to 1; ``distance_error``: the largest difference of
    distances among all factors and among the features, over ``pairs`` seeded
    pairs of rows.  ``imputation_bias`` (rows far out against the share of known
    values) and ``correlation`` of the first ``factors`` with each of ``scores``
    are for the reader: ``holds`` is null.
    """
    cols, rows, g, scale, values, vectors = _fitted(df, row_id, blocks)
    found, at = [], 0
    share = vectors**2
    for name, b in blocks.items():
        inner = slice(at, at + len(b))
        lead = float(np.linalg.eigvalsh(g[inner, inner] * np.outer(scale[inner], scale[inner]))[-1])
        found.append(("leading_eigenvalue", name, lead, abs(lead - 1) <= 1e-8))
        at += len(b)
    total = np.abs(share.sum(axis=0) - 1).max(initial=0.0)
    found.append(("contributions", "largest deviation", float(total), bool(total <= 1e-6)))
    few = rows.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(2 * pairs).toPandas()  # the seeded sample
    x = few[cols].to_numpy(np.float64)[: len(few) // 2 * 2] * scale
    apart = x[::2] - x[1::2]
    error = np.abs(np.linalg.norm(apart, axis=1) - np.linalg.norm(apart @ vectors, axis=1)).max(initial=0.0)
    found.append(("distance_error", f"{len(apart)} pairs", float(error), bool(error <= 1e-6)))
    # factors are a rotation, so the length of a row's scores is that of its weighted features
    radius = F.sqrt(sum((F.col(c) * F.col(c) * F.lit(float(w * w)) for c, w in zip(cols, scale, strict=True)), F.lit(0.0)))
    known = sum((F.col(c).isNotNull().cast("double") for c in cols), F.lit(0.0)) / len(cols)
    top = np.argsort(values)[::-1][:factors]
    axes = [sum((F.col(c) * F.lit(float(scale[i] * vectors[i, j])) for i, c in enumerate(cols)), F.lit(0.0)).alias(f"f{k + 1}") for k, j in enumerate(top)]
    meta = df.select(F.col(row_id).alias("id"), known.alias("known"), *(F.col(c).cast("double").alias(f"s_{c}") for c in scores or []))
    joined = rows.select("id", radius.alias("radius"), *axes).join(meta, "id")
    want = [("imputation_bias", "", "radius", "known"), *(("correlation", f"factor {k + 1}, {c}", f"f{k + 1}", f"s_{c}") for c in scores or [] for k in range(len(top)))]
    related = [F.try_divide(F.covar_pop(a, b), F.stddev_pop(F.when(F.col(b).isNotNull(), F.col(a))) * F.stddev_pop(F.when(F.col(a).isNotNull(), F.col(b)))) for _, _, a, b in want]  # null where one is constant
    row = joined.agg(*(c.alias(f"c{i}") for i, c in enumerate(related))).first()
    found += [(check, item, row[f"c{i}"], None) for i, (check, item, _, _) in enumerate(want)]
    return df.sparkSession.createDataFrame(found, "check string, item string, value double, holds boolean")


def factor_analysis(df: DataFrame, row_id: str, blocks: dict[str, list[str]], k: int = 2) -> tuple[DataFrame, DataFrame]:
    """Scores and loadings of a multiple factor analysis (FS01-FS03).

    Columns are standardised with population deviations, nulls are 0; each
    block is divided by its first singular value; then one decomposition of
    all.  Only Gram matrices (columns squared) leave the executors.
    """
    cols, rows, _, scale, values, vectors = _fitted(df, row_id, blocks)
    top = np.argsort(values)[::-1][:k]
    v = vectors[:, top] * np.where(np.abs(vectors[:, top]).max(0) == vectors[:, top].max(0), 1, -1)  # the largest entry is positive
    scores = rows.select("id", *(sum((F.col(c) * F.lit(float(scale[i] * v[i, j])) for i, c in enumerate(cols)), F.lit(0.0)).alias(f"f{j + 1}") for j in range(k)))
    loadings = [(name, c, j + 1, float(v[cols.index(c), j]), float(v[cols.index(c), j] ** 2), float(values[top[j]])) for name, b in blocks.items() for c in b for j in range(k)]
    return scores, df.sparkSession.createDataFrame(loadings, "block string, column string, factor int, loading double, contribution double, eigenvalue double")
