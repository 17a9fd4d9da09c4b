"""Range joins, interval sweeps and ordered scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orfloom.operators.sweeps import average_ranks, running


def bins(start: Column, end: Column, width: float) -> Column:
    """Bins that the closed range touches."""
    lo, hi = F.floor(start / width).cast("long"), F.floor(end / width).cast("long")
    return F.explode(F.sequence(lo, F.greatest(lo, hi)))


def range_join(left: DataFrame, right: DataFrame, width: float, l_start: str, l_end: str, r_start: str, r_end: str, on: list[str] | None = None) -> DataFrame:
    """Pairs whose half-open ranges overlap (JN06), by an equi-join on bins.

    A pair is kept in the first bin that both touch, so no distinct is needed.
    Long ranges cost a row for each bin: choose ``width`` near the median range.
    Skewed bins are ordinary skewed join keys for adaptive execution.
    """
    on = on or []
    a = left.withColumn("__bin", bins(F.col(l_start), F.col(l_end), width))
    b = right.withColumn("__bin", bins(F.col(r_start), F.col(r_end), width))
    first = F.floor(F.greatest(F.col(l_start), F.col(r_start)) / width).cast("long")
    both = a.join(b, [*on, "__bin"])
    return both.where((F.col(l_start) < F.col(r_end)) & (F.col(r_start) < F.col(l_end)) & (F.col("__bin") == first)).drop("__bin")


def point_join(points: DataFrame, spans: DataFrame, width: float, pos: str, start: str, end: str, on: list[str] | None = None, how: str = "inner") -> DataFrame:
    """Points in half-open spans, ``start <= pos < end`` (JN05); a point lies in one bin, so only spans are copied."""
    on = on or []
    a = points.withColumn("__bin", F.floor(F.col(pos) / width).cast("long"))
    b = spans.withColumn("__bin", bins(F.col(start), F.col(end), width))
    cond = (a["__bin"] == b["__bin"]) & (F.col(start) <= F.col(pos)) & (F.col(pos) < F.col(end))
    for c in on:
        cond = cond & (a[c] == b[c])
    out = a.join(b, cond, how).drop(a["__bin"]).drop(b["__bin"])
    for c in on:
        out = out.drop(b[c])
    return out


def tag_regions(variants: DataFrame, regions: DataFrame, key: str, pos: str, variant_id: str) -> DataFrame:
    """Flags of a 1-based point in a key's ``unique``, ``shared`` and ``isoform`` spans (JN05).

    regions: (key, region, start, end), half-open.  Points outside every span
    go; a null position is kept untagged.
    """
    hits = variants.join(regions, key).where((F.col("start") < F.col(pos)) & (F.col(pos) <= F.col("end")))
    names = ["unique", "shared", "isoform"]
    flags = hits.groupBy(key, variant_id).agg(*(F.max(F.col("region") == n).alias(f"in_{n}") for n in names))
    blank = variants.where(F.col(pos).isNull()).select("*", *(F.lit(None).cast("boolean").alias(f"in_{n}") for n in names))
    return variants.join(flags, [key, variant_id]).unionByName(blank)


def spans_at(points: DataFrame, spans: DataFrame, pos: str, start: str, end: str, on: list[str] | None = None, out: str = "n") -> DataFrame:
    """``points`` that lie in half-open spans, with how many (JN05): the pairs of :func:`point_join`, counted without being formed.

    A running total over the distinct positions; the cost does not grow with the
    lengths of the spans or with how many cover a point.
    """
    on = on or []
    ends = F.explode(F.array(F.struct(F.col(start).alias("__pos"), F.lit(1).alias("__d")), F.struct(F.col(end).alias("__pos"), F.lit(-1).alias("__d")))).alias("__e")
    steps = spans.where(F.col(start) < F.col(end)).select(*on, ends).select(*on, "__e.*")
    asked = points.where(F.col(pos).isNotNull()).select(*on, F.col(pos).alias("__pos"), F.lit(0).alias("__d")).distinct()
    steps = steps.unionByName(asked).groupBy(*on, "__pos").agg(F.sum("__d").alias("__d"))
    depth = running(steps, on, ["__pos"], {"__before": ("sum", "__d")}).withColumn(out, F.coalesce("__before", F.lit(0)) + F.col("__d"))
    return points.withColumn("__pos", F.col(pos)).join(depth.where(F.col(out) > 0).select(*on, "__pos", out), [*on, "__pos"]).drop("__pos")


def points_within(spans: DataFrame, points: DataFrame, key: list[str], start: str, end: str, pos: str, least: str, on: list[str] | None = None) -> DataFrame:
    """``key, n, least``: points in a key's half-open spans and the least value of a column over them; keys without points are left out.

    The pairs of a range join, summed up without being formed.  A span of a
    length from 2^k to 2^(k+1) is the tail of one aligned block of 2^k, the blocks
    behind it (two at most) and the head of another; heads and tails are running
    totals over the distinct positions.  Points are copied for each k in use.
    """
    on = on or []
    # of a power of two, so that places in blocks are exact; never above the length
    size = F.pow(F.lit(2.0), F.floor(F.log2(F.col("__hi") - F.col("__lo")) - 1e-9))
    block = lambda x: F.floor(F.col(x) / F.col("__size"))
    s = spans.where(F.col(start) < F.col(end)).select(*key, *(c for c in on if c not in key), F.col(start).alias("__lo"), F.col(end).alias("__hi")).withColumn("__size", size)
    first, last = block("__lo"), block("__hi")
    ask = lambda part, b, x: F.struct(F.lit(part).alias("__part"), b.alias("__block"), x.cast("double").alias("__at"))
    middle = F.when(last - first > 1, F.transform(F.sequence(first + 1, last - 1), lambda b: ask("whole", b, F.lit(0.0)))).otherwise(F.array().cast("array<struct<__part:string,__block:bigint,__at:double>>"))
    asked = s.withColumn("__ask", F.explode(F.concat(F.array(ask("tail", first, F.col("__lo")), ask("head", last, F.col("__hi"))), middle))).select(*dict.fromkeys([*key, *on]), "__size", "__ask.*")

    known = points.where(F.col(pos).isNotNull()).groupBy(*on, F.col(pos).cast("double").alias("__at")).agg(F.count("*").alias("__n"), F.min(least).alias("__least"))
    known = known.crossJoin(F.broadcast(s.select("__size").distinct())).withColumn("__block", block("__at"))  # a few sizes
    place, empty = [*on, "__size", "__block"], [F.lit(None).cast("long").alias("__n"), F.lit(None).cast(points.schema[least].dataType).alias("__least")]
    wanted = asked.where("__part <> 'whole'").select(*place, "__at", "__part").distinct()

    def side(part: str) -> DataFrame:
        """Sums of a block's points before a head's end, or from a tail's start on."""
        rows = known.select(*place, "__at", "__n", "__least", F.lit(False).alias("__asks")).unionByName(wanted.where(F.col("__part") == part).select(*place, "__at", *empty, F.lit(True).alias("__asks")))
        way = 1 if part == "head" else -1
        rows = rows.withColumns({"__way": F.col("__at") * way, "__turn": F.col("__asks").cast("int") * -way})
        sums = running(rows, place, ["__way", "__turn"], {"__n_all": ("sum", "__n"), "__least_all": ("min", "__least")}).where("__asks and __n_all is not null")
        return sums.select(*place, "__at", F.lit(part).alias("__part"), F.col("__n_all").alias("n"), F.col("__least_all").alias(least))

    whole = known.groupBy(*place).agg(F.sum("__n").alias("n"), F.min("__least").alias(least)).select(*place, F.lit(0.0).alias("__at"), F.lit("whole").alias("__part"), "n", least)
    found = asked.join(side("head").unionByName(side("tail")).unionByName(whole), [*place, "__at", "__part"])
    return found.groupBy(*key).agg(F.sum("n").alias("n"), F.min(least).alias(least))


def track_integrals(intervals: DataFrame, track: DataFrame, columns: dict[str, Column], width: float, on: list[str] | None = None) -> DataFrame:
    """``intervals`` (distinct rows with start, end) with, for each column, the sum over the track of value times overlap.

    Both are cut at the edges of bins.  In a bin the integral up to a place is the running
    slope times the place, less a running sum; a piece is the difference of two.
    """
    on = on or []
    edge = F.col("__bin") * width

    def cut(df: DataFrame, start: str, end: str) -> DataFrame:
        rows = df.where(F.col(start) < F.col(end)).withColumn("__bin", bins(F.col(start), F.col(end), width))
        rows = rows.withColumns({"__lo": F.greatest(F.col(start), edge) - edge, "__hi": F.least(F.col(end), edge + width) - edge})
        return rows.where("__lo < __hi")

    ends = lambda: F.explode(F.array(F.struct(F.col("__lo").cast("double").alias("at"), F.lit(1).alias("sign")), F.struct(F.col("__hi").cast("double").alias("at"), F.lit(-1).alias("sign")))).alias("__e")
    values = [f"__v{k}" for k in range(len(columns))]
    steps = cut(track.withColumns(dict(zip(values, columns.values(), strict=True))), "t_start", "t_end").select(*on, "__bin", *values, ends())
    steps = steps.select(*on, "__bin", "__e.at", *((F.col(v) * F.col("__e.sign")).cast("double").alias(v) for v in values))
    parts = cut(intervals, "start", "end").select(*intervals.columns, "__bin", ends()).select(*intervals.columns, "__bin", "__e.*")
    places = parts.select(*on, "__bin", "at").distinct()
    steps = steps.unionByName(places.select("*", *(F.lit(0.0).alias(v) for v in values))).groupBy(*on, "__bin", "at").agg(*(F.sum(v).alias(v) for v in values))
    steps = steps.select("*", *((F.col(v) * F.col("at")).alias(f"{v}_at") for v in values))
    totals = {f"{v}_sum": ("sum", v) for v in values} | {f"{v}_at_sum": ("sum", f"{v}_at") for v in values}
    upto = running(steps, [*on, "__bin"], ["at"], totals)
    upto = upto.select(*on, "__bin", "at", *(F.coalesce(F.col(f"{v}_sum") * F.col("at") - F.col(f"{v}_at_sum"), F.lit(0.0)).alias(v) for v in values))
    met = parts.join(upto, [*on, "__bin", "at"])
    return met.groupBy(*intervals.columns).agg(*(F.sum(-F.col("sign") * F.col(v)).alias(c) for c, v in zip(columns, values, strict=True)))


def weighted_track_mean(intervals: DataFrame, track: DataFrame, key: list[str], width: float, on: list[str] | None = None) -> DataFrame:
    """Mean of a track over intervals, weighted by interval width; intervals without data do not count (JN11).

    intervals: key + (start, end); track: (t_start, t_end, value).  Pairs are
    not formed.  Values that are not finite go as a track of their own, lest
    they spoil the sums of others.
    """
    value, mine = F.col("value").cast("double"), list(dict.fromkeys([*key, *(on or []), "start", "end"]))
    infinite = float("inf")
    odd = {"nan": F.isnan(value), "up": value == infinite, "down": value == -infinite}
    known, distinct = track.where("value is not null"), intervals.select(*mine).distinct()
    finite = ~(odd["nan"] | odd["up"] | odd["down"])
    per = track_integrals(distinct, known, {"sum": F.when(finite, value).otherwise(0.0), "over": F.lit(1.0)}, width, on).where("over > 0")
    if not known.where(~finite).isEmpty():
        flags = track_integrals(distinct, known.where(~finite), {k: c.cast("double") for k, c in odd.items()}, width, on)
        same = per["start"].eqNullSafe(flags["start"]) & per["end"].eqNullSafe(flags["end"])
        for c in mine[:-2]:
            same = same & per[c].eqNullSafe(flags[c])
        per = per.join(flags, same, "left").select(*(per[c] for c in per.columns), "nan", "up", "down")
        added = F.when((F.col("nan") > 0) | ((F.col("up") > 0) & (F.col("down") > 0)), float("nan")).when(F.col("up") > 0, infinite).when(F.col("down") > 0, -infinite)
        per = per.withColumn("sum", F.coalesce(added, F.col("sum")))
    per = per.groupBy(*key, "start", "end").agg((F.sum("sum") / F.sum("over")).alias("m"))
    w = F.col("end") - F.col("start")
    return per.groupBy(*key).agg((F.sum(F.col("m") * w) / F.sum(w)).alias("mean"), F.sum(w).alias("width"), F.count("*").alias("n_intervals"))


def merge_intervals(df: DataFrame, key: list[str], start: str, end: str, closed: bool = False, members: str | None = None) -> DataFrame:
    """Unions of overlapping or adjacent intervals (WN05); ``closed``: inclusive ends, so ``start <= end + 1`` joins."""
    w = Window.partitionBy(*key).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col(start) > before + (1 if closed else 0)), 1).otherwise(0)
    island = df.withColumn("__new", new).withColumn("__island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    aggs = [F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n")]
    if members:
        aggs.append(F.array_join(F.sort_array(F.collect_set(F.col(members).cast("string"))), ",").alias("members"))
    return island.groupBy(*key, "__island").agg(*aggs).drop("__island")


def coverage_depth(df: DataFrame, key: list[str], start: str, end: str) -> DataFrame:
    """Segments of equal positive depth, equal neighbours joined (WN06)."""
    events = df.where(F.col(start) < F.col(end)).select(*key, F.explode(F.array(F.struct(F.col(start).alias("p"), F.lit(1).alias("d")), F.struct(F.col(end).alias("p"), F.lit(-1).alias("d")))).alias("e"))
    steps = events.groupBy(*key, F.col("e.p").alias("p")).agg(F.sum("e.d").alias("d")).where("d <> 0")  # a step of 0 joins equal neighbours
    w = Window.partitionBy(*key).orderBy("p")
    out = steps.select(*key, F.col("p").alias("start"), F.lead("p").over(w).alias("end"), F.sum("d").over(w).alias("depth"))
    return out.where("depth > 0 and end is not null")


def state_runs(df: DataFrame, key: list[str], order: list[str], state: str, least: dict[str, int] | None = None) -> DataFrame:
    """Runs of one state in order: 1-based inclusive first and last place, length (WN03); shorter ones than ``least[state]`` go."""
    w = Window.partitionBy(*key).orderBy(*order)
    n = df.withColumn("__i", F.row_number().over(w)).withColumn("__j", F.col("__i") - F.row_number().over(Window.partitionBy(*key, state).orderBy(*order)))
    runs = n.groupBy(*key, state, "__j").agg(F.min("__i").alias("first"), F.max("__i").alias("last"), F.count("*").alias("length")).drop("__j")
    if least:
        need = F.lit(1)
        for name, k in least.items():
            need = F.when(F.col(state) == name, k).otherwise(need)
        runs = runs.where(F.col("length") >= need)
    return runs


def gap_runs(df: DataFrame, key: list[str], order: list[str], target_gap: Column, reference_gap: Column) -> DataFrame:
    """Runs of insertions and deletions over alignment columns, a column with both gaps closing a run (WN04)."""
    state = F.when(target_gap & reference_gap, "both").when(target_gap, "deletion").when(reference_gap, "insertion").otherwise("match")
    runs = state_runs(df.withColumn("kind", state), key, order, "kind").where(F.col("kind").isin("deletion", "insertion"))
    return runs.withColumn("frameshift", F.col("length") % 3 != 0)


def rolling_quota(df: DataFrame, client: str, seconds: str, windows: list[int], limits: list[int]) -> DataFrame:
    """Events of a client in the trailing windows, whether over the limit, and the wait until the oldest leaves (WN10)."""
    out = df
    for width, limit in zip(windows, limits, strict=True):
        w = Window.partitionBy(client).orderBy(seconds).rangeBetween(-width + 1, 0)
        out = out.withColumn(f"n_{width}", F.count("*").over(w)).withColumn(f"over_{width}", F.col(f"n_{width}") > limit)
        out = out.withColumn(f"wait_{width}", F.when(F.col(f"over_{width}"), F.min(seconds).over(w) + width - F.col(seconds)).otherwise(0))
    return out


def running_offset(df: DataFrame, key: list[str], order: list[Column], length: str) -> DataFrame:
    """Start and end of each part in the concatenation of its group (WN11)."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(length).over(w)
    return df.withColumn("offset_end", end).withColumn("offset_start", F.col("offset_end") - F.col(length))


def normal_scores(df: DataFrame, value: str, part: list[str], transform, out: str = "score") -> DataFrame:
    """Normal scores of average ranks, ``transform((rank - 0.5) / n)``; nulls stay null (WN08).

    Ranks are running totals over the distinct values, dealt by ranges of them.
    """
    ranked = average_ranks(df, value, part, "__rank")
    return ranked.withColumn(out, transform((F.col("__rank") - 0.5) / F.col("__rank_of"))).drop("__rank", "__rank_of")


def proximity_pairs(df: DataFrame, structure: str, residue: str, xyz: list[str], cutoff: float) -> DataFrame:
    """Residue pairs of a structure within a distance, by a join on grid cells (JN16)."""
    cell = [F.floor(F.col(c) / cutoff).cast("long") for c in xyz]
    a = df.select(structure, F.col(residue).alias("i"), *(F.col(c).alias(f"{c}_i") for c in xyz), *(x.alias(f"cell{k}") for k, x in enumerate(cell)))
    b = df.select(structure, F.col(residue).alias("j"), *(F.col(c).alias(f"{c}_j") for c in xyz), *(x.alias(f"cell{k}") for k, x in enumerate(cell)))
    for k in range(len(xyz)):
        b = b.withColumn(f"cell{k}", F.explode(F.sequence(F.col(f"cell{k}") - 1, F.col(f"cell{k}") + 1)))
    d2 = sum(((F.col(f"{c}_i") - F.col(f"{c}_j")) ** 2 for c in xyz), F.lit(0.0))
    pairs = a.join(b, [structure, *(f"cell{k}" for k in range(len(xyz)))]).where((F.col("i") < F.col("j")) & (d2 <= cutoff * cutoff))
    return pairs.select(structure, "i", "j", F.sqrt(d2).alias("distance"))
