"""Paired comparison of two sides with three-valued logic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orfloom.functions.scalars import clean_number, density_ratio, enriched, guarded_ratio


def scalar_deltas(df: DataFrame, fields: list[str], left: str, right: str) -> DataFrame:
    """``{field}_delta`` = left - right for numbers that are finite on both sides (CP01)."""
    for f in fields:
        df = df.withColumn(f"{f}_delta", clean_number(F.col(f"{left}{f}").cast("double")) - clean_number(F.col(f"{right}{f}").cast("double")))
    return df


def predictor_change(a: Column, b: Column, ran_a: Column, ran_b: Column) -> Column:
    """Null if a side did not run; true if only one has a value or they differ; false if both are missing (CP02)."""
    return F.when(ran_a & ran_b, ~a.eqNullSafe(b))


def generic_change(a: Column, b: Column) -> Column:
    """Null if one side is missing; false if both are; else whether they differ (CP03)."""
    return F.when(a.isNull() & b.isNull(), False).otherwise(a != b)


def enrichment(df: DataFrame, fields: list[str], unique: str, shared: str, verified: Column) -> DataFrame:
    """``_ratio`` and ``_enriched`` of unique against shared, only where the region is verified (CP04, SC17)."""
    for f in fields:
        u, s = F.col(f"{unique}{f}"), F.col(f"{shared}{f}")
        df = df.withColumn(f"{f}_ratio", F.when(verified, guarded_ratio(u, s))).withColumn(f"{f}_enriched", F.when(verified, enriched(u, s)))
    return df


def compare_pairs(df: DataFrame, modules: dict[str, list[str]], left: str, right: str) -> DataFrame:
    """One struct per module of its fields' deltas or changes; modules without the right side are left out (CP05, CP06)."""
    types = dict(df.dtypes)
    for name, fields in modules.items():
        if not all(f"{right}{f}" in types for f in fields):
            continue
        parts = []
        for f in fields:
            numeric = types[f"{left}{f}"] in ("int", "bigint", "double", "float")
            a, b = F.col(f"{left}{f}"), F.col(f"{right}{f}")
            parts.append((a - b).alias(f"{f}_delta") if numeric else generic_change(a, b).alias(f"{f}_changed"))
        df = df.withColumn(f"cmp_{name}", F.struct(*parts))
    return df


def gained_lost(left: Column, right: Column) -> dict[str, Column]:
    """Sets of keys on one side only, and on both; null when a side did not run (JN13, ST02)."""
    return {"gained": F.array_except(left, right), "lost": F.array_except(right, left), "shared": F.array_intersect(left, right)}


def hits_in_span(hits: str, start: Column, end: Column) -> Column:
    """Hits that overlap the differential span (JN12)."""
    return F.filter(F.col(hits), lambda h: (h.pos < end) & (h.end > start))


def feature_diff(left: DataFrame, right: DataFrame, key: list[str], value: str) -> DataFrame:
    """Items of one side only and of both, with deltas (JN15)."""
    a = left.select(*key, F.col(value).alias("left_value"))
    b = right.select(*key, F.col(value).alias("right_value"))
    kind = F.when(F.col("right_value").isNull(), "gained").when(F.col("left_value").isNull(), "lost").otherwise("shared")
    return a.join(b, key, "full").withColumn("change", kind).withColumn("delta", F.coalesce("left_value", F.lit(0.0)) - F.coalesce("right_value", F.lit(0.0)))


def region_densities(df: DataFrame, key: list[str], in_unique: Column, in_shared: Column, len_unique: str, len_shared: str) -> DataFrame:
    """Counts and density ratio of unique to shared (AG09)."""
    n = df.groupBy(*key, len_unique, len_shared).agg(F.count_if(in_unique).alias("n_unique"), F.count_if(in_shared).alias("n_shared"))
    return n.withColumn("density_ratio", density_ratio(F.col("n_unique"), F.col(len_unique), F.col("n_shared"), F.col(len_shared)))


def effect_rollup(df: DataFrame, key: list[str], delta: str, lof: Column, af: Column, damaging: float = -7.5, common: float = 1e-3) -> DataFrame:
    """Scorable, damaging and loss-of-function counts, mean and least delta (AG10, VC10).

    Loss of function always damages; a common variant is tolerated otherwise.
    """
    l, tolerated = F.coalesce(lof, F.lit(False)), F.coalesce(af >= common, F.lit(False))
    bad = l | (~tolerated & F.coalesce(F.col(delta) <= damaging, F.lit(False)))
    return df.groupBy(*key).agg(
        F.count("*").alias("n"), F.count_if(l | F.col(delta).isNotNull()).alias("n_scorable"), F.count_if(bad).alias("n_damaging"), F.count_if(l).alias("n_lof"),
        F.avg(delta).alias("mean_delta"), F.min(delta).alias("min_delta"),
    )


def species_rollup(df: DataFrame, key: list[str], species: str, depth: str, aligned: Column, intact: Column, identity: str) -> DataFrame:
    """Aligned and intact species, fractions, mean identity, the deepest intact one (AG11)."""
    return df.groupBy(*key).agg(
        F.count("*").alias("n"), F.count_if(aligned).alias("n_aligned"), F.count_if(intact).alias("n_intact"), F.avg(intact.cast("int")).alias("frac_intact"),
        F.avg(F.when(aligned, F.col(identity))).alias("mean_identity"), F.max_by(F.when(intact, F.col(species)), F.when(intact, F.struct(depth, species))).alias("deepest_intact"),
    )


def feature_profile(df: DataFrame, key: list[str], feature: str, value: str, least: float = 0.0, top: int = 30) -> DataFrame:
    """Largest, mean and prevalence of each feature of a key; the ``top`` by their largest value (AG13, TK03)."""
    from pyspark.sql import Window

    sizes = df.groupBy(*key).agg(F.countDistinct("residue").alias("residues"))
    f = df.groupBy(*key, feature).agg(F.max(value).alias("peak"), F.avg(value).alias("mean"), F.count("*").alias("n"))
    f = f.join(sizes, key).withColumn("prevalence", F.col("n") / F.col("residues")).where(F.col("prevalence") >= least)
    order = Window.partitionBy(*key).orderBy(F.desc("peak"), F.asc(feature))
    return f.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
