"""Marking, keeping and suppressing rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orfloom.scratch import stored

REASONS = ["NotReferenceTranscript", "LowReadcounts", "NotSignificant", "UpstreamTIS"]


def rate_per_million(df: DataFrame, count: str, key: list[str], order: list[str], total: float | None = None, out: str = "rate") -> DataFrame:
    """``count / total * 1e6``; without a total, the sum over rows distinct on ``key``, the first in ``order`` counting (PRJ05)."""
    if total is not None:
        return df.withColumn(out, F.col(count) / F.lit(float(total)) * 1e6)
    first = df.groupBy(*key).agg(F.min_by(count, F.struct(*order)).alias("__n"))
    return df.crossJoin(F.broadcast(first.agg(F.sum("__n").cast("double").alias("__total")))).withColumn(out, F.col(count) / F.col("__total") * 1e6).drop("__total")


def reference_ids(df: DataFrame, id_col: str, is_reference: Column, count: Column, least: float, bounds: list[tuple[str, float]]) -> DataFrame:
    """Distinct ids with a reference row of enough counts and significance in all bounds (PRJ06)."""
    ok = is_reference & (count >= least)
    for name, top in bounds:
        ok = ok & (F.col(name) <= top)
    return df.where(ok).select(id_col).distinct()


def filter_with_reasons(df: DataFrame, checks: list[tuple[str, Column]], exempt: Column | None = None, exempt_from: list[str] | None = None, out: str = "drop_reason") -> DataFrame:
    """Appends the names of failed checks in their order, joined by ``|``; a null check fails; null means kept (PRJ07)."""
    parts = []
    for name, passes in checks:
        fails = ~F.coalesce(passes, F.lit(False))
        if exempt is not None and (exempt_from is None or name in exempt_from):
            fails = fails & ~F.coalesce(exempt, F.lit(False))
        parts.append(F.when(fails, F.lit(name)))
    return df.withColumn(out, F.nullif(F.concat_ws("|", *parts), F.lit("")))


def split_kept(df: DataFrame, reason: str = "drop_reason") -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(reason).isNull()), df.where(F.col(reason).isNotNull())


def suppress_within(df: DataFrame, part: list[str], pos: str, score: str, row_id: str, buffer: float = 30, first: Column | None = None) -> DataFrame:
    """Rows that survive greedy downstream suppression (WN01).

    In priority order (``first``, then score from the top, position, id) a row
    is kept unless a kept row lies at most ``buffer`` before it (or at it); one
    without a position is kept.  Of one position only the best row can stay, so
    the others go before anything is sorted.  Then come rounds: a row with no
    better undecided row in its reach is kept, and what it reaches goes.  A
    round sees bins of positions, with the rows that reach into a bin copied to
    it, so that one key is dealt over many tasks and no group is collected.
    """
    keys = [f"__part{k}" for k in range(len(part))]
    rows = df.select(*(F.col(c).alias(k) for c, k in zip(part, keys, strict=True)), F.col(pos).cast("double").alias("__pos"), F.struct(
        (F.when(F.coalesce(first, F.lit(False)), 0).otherwise(1) if first is not None else F.lit(0)).alias("first"),
        F.coalesce(-F.col(score), F.lit(float("inf"))).cast("double").alias("score"), F.col(row_id).alias("id")).alias("__rank"))
    kept = rows.where("__pos is null").select(*keys, F.col("__rank.id").alias("__id"))
    left = rows.where("__pos is not null").groupBy(*keys, "__pos").agg(F.min("__rank").alias("__rank"))
    while True:
        seen = stored(_suppression_rounds(left, keys, float(buffer)), "suppression")
        kept = kept.unionByName(seen.where("__kept").select(*keys, F.col("__rank.id").alias("__id")))
        left = seen.where("not __kept").drop("__kept")
        if left.isEmpty():
            break
    same = F.col(row_id) == F.col("__id")
    for c, k in zip(part, keys, strict=True):
        same = same & F.col(c).eqNullSafe(F.col(k))
    return df.join(kept, same, "left_semi")


def _suppression_rounds(rows: DataFrame, keys: list[str], buffer: float, rounds: int = 3) -> DataFrame:
    """Rows that are kept or still undecided after some rounds; each round looks two buffers back, so bins overlap by that."""
    back = 2 * rounds * buffer
    width = 8 * back or 1.0
    home = F.floor(F.col("__pos") / width)
    rows = rows.withColumn("__home", home).withColumn("__bin", F.explode(F.sequence(home, F.floor((F.col("__pos") + back) / width))))
    reach = f"over (partition by {', '.join([*keys, '__bin'])} order by __pos range between {buffer!r}D preceding and current row)"
    # at equal scores the earlier position goes first, then the id
    rows = rows.withColumn("__order", F.struct("__rank.first", "__rank.score", "__pos", "__rank.id")).withColumn("__kept", F.lit(False)).withColumn("__open", F.lit(True))
    for _ in range(rounds):
        best = F.expr(f"min(case when __open then __order end) {reach}")
        rows = rows.withColumn("__now", F.col("__open") & (best == F.col("__order")))
        over = F.coalesce(F.expr(f"min(case when __now then __order end) {reach}") < F.col("__order"), F.lit(False))
        rows = rows.withColumn("__over", over)
        rows = rows.withColumn("__kept", F.col("__kept") | F.col("__now")).withColumn("__open", F.expr("__open and not __now and not __over"))
    return rows.where("__bin = __home and (__kept or __open)").select(*keys, "__pos", "__rank", "__kept")


def collapse_to_source(df: DataFrame, id_col: str, samples: dict[str, tuple[str, str]], annotated: Column, keep_unevaluated: bool = True) -> DataFrame:
    """Annotated rows, rows that a resolved sample chose, and (if wished) those that no sample evaluated (PRJ08).

    samples: name -> (resolved column, chosen id column); truth may be text.
    """
    chosen, seen = F.lit(False), F.lit(False)
    for resolved, source in samples.values():
        yes = F.lower(F.col(resolved).cast("string")) == "true"
        chosen = chosen | F.coalesce(yes & (F.col(source) == F.col(id_col)), F.lit(False))
        seen = seen | F.col(resolved).isNotNull()
    keep = F.coalesce(annotated, F.lit(False)) | chosen
    return df.where(keep | ~seen if keep_unevaluated else keep)


def restrict_to_picks(df: DataFrame, picks: DataFrame, group: str, keys: list[str], annotated: Column) -> DataFrame:
    """All annotated rows of the picked groups and the rows picked by key (PRJ09)."""
    groups = picks.select(group).distinct()
    a = df.where(annotated).join(groups, group, "left_semi")
    b = df.where(~F.coalesce(annotated, F.lit(False))).join(picks.select(*keys).distinct(), keys, "left_semi")
    return a.unionByName(b)


def groups_with(df: DataFrame, group: list[str], cond: Column) -> DataFrame:
    """Rows of the groups that have a row with ``cond`` (PRJ13)."""
    return df.join(df.where(cond).select(*group).distinct(), group, "left_semi")


def present_in_any(df: DataFrame, samples: list[str], prefix: str = "present_") -> DataFrame:
    """Rows present in at least one sample (PRJ14)."""
    cond = F.lit(False)
    for s in samples:
        cond = cond | F.coalesce(F.col(f"{prefix}{s}").cast("boolean"), F.lit(False))
    return df.where(cond)
