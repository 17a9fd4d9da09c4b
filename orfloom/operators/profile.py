"""Population profiles, percentiles, cutoffs and tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orfloom.functions.scalars import clean_number

GRID = [i / 100 for i in range(101)]


def with_strata(df: DataFrame, kind: str, rollups: dict[str, list[str]] | None = None) -> DataFrame:
    """A row for each stratum it belongs to: all, its own type, roll-ups of types (AG19)."""
    names = [F.lit("all"), F.col(kind)]
    names += [F.when(F.col(kind).isin(*members), F.lit(name)) for name, members in (rollups or {}).items()]
    return df.withColumn("stratum", F.explode(F.array_distinct(F.array_compact(F.array(*names)))))


def unpivot_metrics(df: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    pairs = F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), clean_number(F.col(m).cast("double")).alias("value")) for m in metrics)))
    return df.select(*keys, pairs.alias("m")).select(*keys, "m.metric", "m.value")


def profile_numeric(df: DataFrame, metrics: list[str], stratum: str = "stratum", buckets: int = 64) -> DataFrame:
    """For each metric and stratum: counts, moments, 101 linear quantiles, and a histogram over p01..p99 (AG16, TG01)."""
    long = unpivot_metrics(df, [stratum], metrics)
    stats = long.groupBy("metric", stratum).agg(
        F.count("*").alias("rows"), F.count("value").alias("n"), F.avg("value").alias("mean"), F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"), F.percentile("value", F.array(*(F.lit(g) for g in GRID))).alias("grid"),
    )
    lo, hi = F.element_at("grid", 2), F.element_at("grid", 100)
    stats = stats.withColumn("lo", lo).withColumn("hi", F.when(hi > lo, hi).otherwise(lo + 1.0))
    inside = long.join(stats.select("metric", stratum, "lo", "hi"), ["metric", stratum]).where("value between lo and hi")
    bucket = F.least(F.width_bucket("value", "lo", "hi", F.lit(buckets)), F.lit(buckets))
    hist = inside.groupBy("metric", stratum, bucket.alias("b")).agg(F.count("*").alias("c"))
    hist = hist.groupBy("metric", stratum).agg(F.map_from_entries(F.collect_list(F.struct("b", "c"))).alias("m"))
    counts = F.transform(F.sequence(F.lit(1), F.lit(buckets)), lambda b: F.coalesce(F.element_at("m", b), F.lit(0).cast("long")))
    out = stats.join(hist, ["metric", stratum], "left").withColumn("hist", F.when(F.col("m").isNotNull(), counts)).drop("m")
    return out.withColumn("n_missing", F.col("rows") - F.col("n")).withColumn("fill_rate", F.col("n") / F.col("rows"))


def profile_categorical(df: DataFrame, column: str, keys: list[str], top: int = 20) -> DataFrame:
    """The ``top`` values with their fractions and the rest as ``__other__`` (AG17)."""
    n = df.where(F.col(column).isNotNull()).groupBy(*keys, F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*keys).orderBy(F.desc("n"), F.asc("value"))
    n = n.withColumn("value", F.when(F.row_number().over(w) <= top, F.col("value")).otherwise("__other__"))
    n = n.groupBy(*keys, "value").agg(F.sum("n").alias("n"))
    return n.withColumn("frac", F.col("n") / F.sum("n").over(Window.partitionBy(*keys)))


def tri_state_rates(df: DataFrame, flags: list[str], stratum: str = "stratum") -> DataFrame:
    """True, false and unknown counts per criterion; the true share of the evaluable (AG18)."""
    long = df.select(stratum, F.explode(F.array(*(F.struct(F.lit(f).alias("criterion"), F.col(f).alias("v")) for f in flags))).alias("x")).select(stratum, "x.criterion", "x.v")
    out = long.groupBy("criterion", stratum).agg(
        F.count("*").alias("n"), F.count_if("v").alias("n_true"), F.count_if(~F.col("v")).alias("n_false"), F.count_if(F.col("v").isNull()).alias("n_none")
    )
    known = F.col("n_true") + F.col("n_false")
    return out.withColumn("frac_true", F.when(known > 0, F.col("n_true") / known)).withColumn("frac_evaluable", known / F.col("n"))


def percentile_of(value: Column, grid: Column) -> Column:
    """Place of a value on a 101-point grid: the last point at or under it, 0..100 (WN07)."""
    return F.when(value.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(100), F.size(F.filter(grid, lambda g: g <= value)) - 1)))


def value_at(percentile: Column, grid: Column, n: Column, least: int = 30) -> Column:
    """Linear inverse; null for profiles of fewer than ``least`` values (WN07)."""
    k = F.least(F.floor(percentile).cast("int"), F.lit(99))
    lo, hi = F.element_at(grid, k + 1), F.element_at(grid, k + 2)
    return F.when(n >= least, lo + (hi - lo) * (percentile - k))


def histogram_trough(df: DataFrame, key: list[str], bucket: str, count: str, prominence: float = 0.25) -> DataFrame:
    """The deepest interior bucket between two peaks, if its prominence is enough (TG06)."""
    w = Window.partitionBy(*key).orderBy(bucket)
    left = F.max(count).over(w.rowsBetween(Window.unboundedPreceding, -1))
    right = F.max(count).over(w.rowsBetween(1, Window.unboundedFollowing))
    peak = F.least(left, right)
    deep = df.withColumn("peak", F.when(left.isNotNull() & right.isNotNull(), peak)).withColumn("prominence", (F.col("peak") - F.col(count)) / F.col("peak"))
    best = deep.where((F.col("peak") > 0) & (F.col("prominence") >= prominence))
    return best.groupBy(*key).agg(F.min_by(F.struct(bucket, count, "prominence"), F.struct(-F.col("prominence"), F.col(bucket))).alias("t")).select(*key, "t.*")


def choose_cutoff(anchor: Column, trough: Column, percentile: Column, rate_of, band: tuple[float, float] = (0.10, 0.60)) -> tuple[Column, Column]:
    """Anchor, else trough, else percentile: the first whose firing rate is in the band; and which (TG07)."""
    value, how = F.lit(None).cast("double"), F.lit(None).cast("string")
    for name, c in (("percentile", percentile), ("trough", trough), ("anchor", anchor)):
        ok = c.isNotNull() & rate_of(c).between(*band)
        value, how = F.when(ok, c).otherwise(value), F.when(ok, F.lit(name)).otherwise(how)
    return value, how


def row_cutoff(kind: Column, stratum: Column, cutoffs: Column, pooled: Column) -> Column:
    """Cutoff of a row: by type, else stratum, else pooled (TG03)."""
    return F.coalesce(F.element_at(cutoffs, kind), F.element_at(cutoffs, stratum), pooled)


def fire_tags(df: DataFrame, registry: list[dict], kind: str, row_id: str) -> DataFrame:
    """``(row, tag_id, fired, cited)`` for each tag (TG02).

    registry: tag_id, metric, direction (``>=`` or ``<``), cutoff, optional
    ``by`` (type -> cutoff) and ``valid`` (types).  Unknown metrics or cutoffs
    and types out of scope give null; a tag without its column is all null.
    """
    parts = []
    for t in registry:
        value = F.col(t["metric"]).cast("double") if t["metric"] in df.columns else F.lit(None).cast("double")
        cut = F.lit(None if t.get("cutoff") is None else float(t["cutoff"])).cast("double")
        for name, c in (t.get("by") or {}).items():
            cut = F.when(F.col(kind) == name, F.lit(float(c))).otherwise(cut)
        fired = value >= cut if t["direction"] == ">=" else value < cut
        if t.get("valid"):
            fired = F.when(F.col(kind).isin(*t["valid"]), fired)
        parts.append(F.struct(F.lit(t["tag_id"]).alias("tag_id"), fired.alias("fired"), F.when(fired, value).alias("cited")))
    return df.select(row_id, F.explode(F.array(*parts)).alias("t")).select(row_id, "t.*")


def tag_rates(fired: DataFrame) -> DataFrame:
    return fired.groupBy("tag_id").agg(F.avg(F.col("fired").cast("int")).alias("fire_rate"), F.avg(F.col("fired").isNull().cast("int")).alias("null_rate"))


def tag_jaccard(fired: DataFrame, row_id: str) -> DataFrame:
    """Jaccard of each pair of tags over rows evaluable for both (ST06, TG09); rows carry all their tags in one array."""
    rows = fired.groupBy(row_id).agg(F.sort_array(F.collect_list(F.struct("tag_id", "fired"))).alias("tags"))  # one entry a tag
    pairs = rows.select(F.explode(F.flatten(F.transform("tags", lambda a: F.transform(F.filter("tags", lambda b: b.tag_id > a.tag_id), lambda b: F.struct(a.alias("a"), b.alias("b")))))).alias("p"))
    known = pairs.where("p.a.fired is not null and p.b.fired is not null")
    both, either = F.count_if(F.col("p.a.fired") & F.col("p.b.fired")), F.count_if(F.col("p.a.fired") | F.col("p.b.fired"))
    return known.groupBy(F.col("p.a.tag_id").alias("tag_a"), F.col("p.b.tag_id").alias("tag_b")).agg(F.when(either > 0, both / either).alias("jaccard"))


def candidate_funnel(df: DataFrame, reasons: list[tuple[str, Column]]) -> DataFrame:
    """First matching reason of each candidate and its count (TG08)."""
    reason = F.lit("kept")
    for name, cond in reversed(reasons):
        reason = F.when(F.coalesce(cond, F.lit(False)), name).otherwise(reason)
    return df.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


def tag_parity(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Rows on which a tag and a scored criterion disagree, null being a state (TG10)."""
    return df.agg(*(F.count_if(~F.col(a).eqNullSafe(F.col(b))).alias(f"{a}_{b}") for a, b in pairs))


def registry_fingerprint(registry: DataFrame) -> DataFrame:
    """One hash of the sorted rows of a small registry (TG04)."""
    row = F.to_json(F.struct(*sorted(registry.columns)))
    return registry.agg(F.sha2(F.array_join(F.sort_array(F.collect_list(row)), "\n"), 256).alias("fingerprint"))


def build_registry(rows: DataFrame, metrics: list[str]) -> tuple[DataFrame, DataFrame]:
    """Registry of reviewed rows and the rows that cannot enter: conflicting duplicates, unknown metrics (TG11)."""
    counts = rows.groupBy("tag_id").agg(F.countDistinct(F.to_json(F.struct(*rows.columns))).alias("__n"))
    marked = rows.join(counts, "tag_id").withColumn("problem", F.when(F.col("__n") > 1, "conflict").when(~F.col("metric").isin(*metrics), "unknown_metric")).drop("__n")
    return marked.where("problem is null").drop("problem").distinct(), marked.where("problem is not null")


def carry_decisions(new: DataFrame, old: DataFrame, key: str, decided: list[str], measured: list[str]) -> DataFrame:
    """Existing keys keep their decisions, vanished ones stay as retired with measured columns blank (ST07)."""
    n = new.select(key, *measured, F.lit(True).alias("__new"))
    both = n.join(old.select(key, *decided), key, "full")
    return both.select(key, *measured, *decided, F.when(F.col("__new").isNull(), "retired").otherwise("current").alias("state"))


def position_histogram(df: DataFrame, keys: list[str], pos: str, top: int = 10) -> DataFrame:
    """Rows by position, and the share of the ``top`` positions in the whole distribution (AG20)."""
    n = df.groupBy(*keys, pos).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*keys)
    rank = F.row_number().over(w.orderBy(F.desc("n"), F.asc(pos)))
    n = n.withColumn("rank", rank).withColumn("total", F.sum("n").over(w))
    return n.groupBy(*keys).agg(F.count("*").alias("positions"), F.max("n").alias("peak"), (F.sum(F.when(F.col("rank") <= top, F.col("n"))) / F.max("total")).alias("concentration"))


def effect_stats(df: DataFrame, keys: list[str], value: str, classes: dict[str, Column]) -> DataFrame:
    """Rows against scored rows, median, class counts (AG21, AG29)."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), F.count(value).alias("n_scored"), F.median(value).alias("median"), F.percentile(value, F.lit(0.9)).alias("p90"),
        *(F.count_if(c).alias(f"n_{name}") for name, c in classes.items()),
    )


def top_rows(df: DataFrame, cond: Column, sort_by: str, row_id: str, limit: int = 25, descending: bool = True) -> DataFrame:
    """The first rows by a column, nulls last, ids breaking ties; ``n_matched`` counts all, ``truncated`` tells of the cap (TK01, TK02)."""
    limit = max(1, min(100, limit))
    hits = df.where(cond)
    total = hits.agg(F.count("*").alias("n_matched"))
    order = F.col(sort_by).desc_nulls_last() if descending else F.col(sort_by).asc_nulls_last()
    return hits.orderBy(order, F.col(row_id).asc()).limit(limit).crossJoin(F.broadcast(total)).withColumn("truncated", F.col("n_matched") > limit)
