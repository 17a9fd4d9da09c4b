"""Combining samples, de-duplicating, resolving sources and pairing with references."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames, missing columns as nulls (ST01, ST05)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def combine_samples(df: DataFrame, key: list[str], sample: str, samples: list[str], metrics: list[str], order: list[str], shared: list[str] | None = None, count: str | None = None) -> DataFrame:
    """One row per key: shared fields once, ``{sample}_{metric}`` wide, presence flags, the list and number of samples (AG01).

    The first row in ``order`` of a (key, sample) counts; presence is a non-null
    ``count`` (the first metric).  One aggregation with map-side combine; the
    samples are given, so no pass looks for them.
    """
    count = count or metrics[0]
    firsts = df.groupBy(*key, sample).agg(
        F.min_by(F.struct(*metrics, *(shared or [])), F.struct(*order)).alias("r"), F.min(F.struct(*order)).alias("o")
    )
    aggs = [F.min_by(F.col(f"r.{s}"), F.col("o")).alias(s) for s in shared or []]
    for s in samples:
        mine = F.col(sample) == s
        aggs += [F.max(F.when(mine, F.col(f"r.{m}"))).alias(f"{s}_{m}") for m in metrics]
        aggs.append(F.coalesce(F.max(F.when(mine, F.col(f"r.{count}").isNotNull())), F.lit(False)).alias(f"present_{s}"))
    out = firsts.groupBy(*key).agg(*aggs)
    names = F.array_compact(F.array(*(F.when(F.col(f"present_{s}"), F.lit(s)) for s in samples)))
    return out.withColumn("samples", names).withColumn("n_samples", F.size("samples"))


def inconsistent_keys(df: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """Keys where a field has more than one value, null being none (AG02)."""
    counts = df.groupBy(*key).agg(*(F.countDistinct(f).alias(f) for f in fields))
    return counts.where(reduce(lambda a, b: a | b, (F.col(f) > 1 for f in fields)))


def first_per_key(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The representative row of each key (WN02)."""
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("__rn = 1").drop("__rn")


def dedupe_by(df: DataFrame, key: list[str], best: list[Column], row_id: str, sets: list[str], maxima: list[str] | None = None, minima: list[str] | None = None) -> DataFrame:
    """One row per key: its representative's id, distinct counts, sorted joined sets, extremes (AG03, AG04).

    ``best``: larger is better; ties go to the smallest id.
    """
    rank = F.struct(*(F.coalesce(-b.cast("double"), F.lit(float("inf"))) for b in best), F.col(row_id))
    aggs = [F.min_by(row_id, rank).alias(row_id), F.count("*").alias("n_rows")]
    for s in sets:
        values = F.sort_array(F.collect_set(F.col(s).cast("string")))
        aggs += [F.countDistinct(s).alias(f"n_{s}"), F.array_join(values, ",").alias(f"{s}_set")]
    aggs += [F.max(m).alias(f"max_{m}") for m in maxima or []] + [F.min(m).alias(f"min_{m}") for m in minima or []]
    return df.groupBy(*key).agg(*aggs)


def row_extremes(df: DataFrame, cols: list[str], prefix: str) -> DataFrame:
    """Least, largest and number of the values present among columns of a row (AG05); nulls are absent."""
    a = F.array_compact(F.array(*(F.col(c) for c in cols)))
    return df.withColumn(f"{prefix}_min", F.array_min(a)).withColumn(f"{prefix}_max", F.array_max(a)).withColumn(f"{prefix}_n", F.size(a))


def resolve_sources(df: DataFrame, site: list[str], candidate: str, abundance: str, window: str, least: float = 3.0, dominance: float | None = 0.5) -> DataFrame:
    """Verdict of each site (AG06, AG07): single, pure, divergent or no_support; the source; whether it is resolved.

    Candidates below ``least`` are not expressed.  With several, equal windows
    are pure; differing ones are divergent and resolved only if the top one
    holds ``dominance`` of the abundance.  Ties go to the smallest id.
    """
    live = df.where(F.col(abundance) >= least).groupBy(*site, candidate).agg(F.sum(abundance).cast("double").alias("a"), F.min(window).alias("w"), F.max(window).alias("w2"))
    verdict = live.groupBy(*site).agg(
        F.count("*").alias("n_candidates"), F.min_by(candidate, F.struct(-F.col("a"), F.col(candidate))).alias("source"), F.max("a").alias("top"), F.sum("a").alias("total"),
        ((F.min("w") == F.max("w2"))).alias("same"),
    )
    share = F.col("top") / F.col("total")
    out = df.select(*site).distinct().join(verdict, site, "left")
    status = F.when(F.col("n_candidates").isNull(), "no_support").when(F.col("n_candidates") == 1, "single").when(F.col("same"), "pure").otherwise("divergent")
    out = out.withColumn("status", status)
    strong = share >= dominance if dominance is not None else F.lit(True)
    resolved = F.col("status").isin("single", "pure") | ((F.col("status") == "divergent") & strong)
    return out.select(*site, F.coalesce("n_candidates", F.lit(0)).cast("long").alias("n_candidates"), "status", F.coalesce(resolved, F.lit(False)).alias("resolved"),
                      F.when(resolved, F.col("source")).alias("source"), share.alias("top_share"))


def annotate_left(df: DataFrame, notes: DataFrame, keys: list[str]) -> DataFrame:
    """Annotation join, one note a key (JN01, JN17); Spark broadcasts small notes by its own threshold."""
    return df.join(notes.dropDuplicates(keys), keys, "left")


def impute_missing_reference(df: DataFrame, id_col: str, annotated: Column, order: list[Column], sources: list[tuple[DataFrame, list[str]]], required: list[str], fills: dict[str, Column] | None = None) -> DataFrame:
    """Rows for ids that have rows but no annotated one: the first row, joined to its sources; incomplete ones go (JN02)."""
    have = df.where(annotated).select(id_col).distinct()
    rows = first_per_key(df.join(have, id_col, "left_anti"), [id_col], order).select(id_col)
    for source, keys in sources:
        rows = rows.join(source, keys, "left")
    for name, value in (fills or {}).items():
        rows = rows.withColumn(name, F.coalesce(F.col(name), value))
    return rows.dropna(subset=required).withColumn("imputed", F.lit(True))


def pair_with_reference(df: DataFrame, keys: list[str], annotated: Column, order: list[str], start: str, expr: str) -> DataFrame:
    """Alternatives joined to the first annotated row of their key: start distances and fold change (JN03)."""
    ref = df.where(annotated).groupBy(*keys).agg(F.min_by(F.struct(start, expr), F.struct(*order)).alias("ref"))
    out = df.where(~F.coalesce(annotated, F.lit(False))).join(ref, keys)
    delta = F.col(start) - F.col(f"ref.{start}")
    fold = (F.col(expr) + 1) / (F.col(f"ref.{expr}") + 1)
    return out.select(*(F.col(c) for c in df.columns), F.col(f"ref.{start}").alias("ref_start"), F.col(f"ref.{expr}").alias("ref_expr"), delta.alias("start_delta"),
                      F.abs(delta).alias("start_distance"), fold.alias("fold"), F.log2(fold).alias("log2_fold"))


def reference_rows(df: DataFrame, group: list[str], annotated: Column, length: str, row_id: str) -> DataFrame:
    """The longest annotated row of a group, else the longest of any; ties to the smallest id (JN04)."""
    rank = F.struct(F.when(F.coalesce(annotated, F.lit(False)), 0).otherwise(1), -F.coalesce(F.col(length), F.lit(-1)).cast("double"), F.col(row_id))
    return df.groupBy(*group).agg(F.min_by(F.struct(*(c for c in df.columns if c not in group)), rank).alias("r")).select(*group, "r.*")


def resolve_ids(df: DataFrame, id_col: str, overrides: DataFrame, known: DataFrame, defaults: DataFrame, gene: str) -> DataFrame:
    """Id cascade: override, the same or a new version of it, the gene's default, else unresolved; with ``how`` (JN09).

    overrides: (id, to); known: (id); defaults: (gene, id).  Versions follow a dot.
    """
    bare = F.split_part(F.col(id_col), F.lit("."), F.lit(1))
    k = known.select(F.col("id").alias("__same")).distinct()
    v = known.groupBy(F.split_part(F.col("id"), F.lit("."), F.lit(1)).alias("__bare")).agg(F.max("id").alias("__version"))
    out = df.withColumn("__bare", bare).join(overrides.select(F.col("id").alias(id_col), F.col("to").alias("__over")), id_col, "left")
    out = out.join(k, F.col(id_col) == F.col("__same"), "left").join(v, "__bare", "left").join(defaults.select(F.col("gene").alias(gene), F.col("id").alias("__default")), gene, "left")
    how = F.when(F.col("__over").isNotNull(), "override").when(F.col("__same").isNotNull(), "same").when(F.col("__version").isNotNull(), "new_version").when(F.col("__default").isNotNull(), "gene_default").otherwise("unresolved")
    return out.withColumn("resolved_id", F.coalesce("__over", "__same", "__version", "__default")).withColumn("how", how).drop("__bare", "__over", "__same", "__version", "__default")


def best_evidence(df: DataFrame, site: list[str], replicate: str, sample: str, samples: list[str], count: str, p: str) -> DataFrame:
    """Best count and p-value per site and replicate, then per sample, wide (JN10); nulls lose."""
    per = df.groupBy(*site, sample, replicate).agg(F.max(count).alias("c"), F.min(p).alias("p"))
    return per.groupBy(*site).pivot(sample, samples).agg(F.max("c").alias("count"), F.min("p").alias("p"))


def open_key_counts(df: DataFrame, key: list[str], name: str, out: str = "counts") -> DataFrame:
    """Counts by an open set of names as a map (AG08); null names are left out."""
    n = df.where(F.col(name).isNotNull()).groupBy(*key, name).agg(F.count("*").alias("n"))
    return n.groupBy(*key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(name, "n")))).alias(out))


def best_per_group(df: DataFrame, group: list[str], order: list[Column], row_id: str) -> DataFrame:
    """Id of the lexicographically largest tuple (first wins on ties) and group size (AG24, TK03)."""
    return df.groupBy(*group).agg(F.max_by(row_id, F.struct(*order, -F.col(row_id))).alias("best"), F.count("*").alias("n"))
