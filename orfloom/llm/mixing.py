"""Mixing sources to target weights by hierarchical budgeting.

Budgets go down a tree (domain, language, source): a node's budget is divided
among its children by weight, none gets more than its documents can give in
``max_epochs`` passes, and what a full child cannot take goes to its siblings.
A node never gets more than all its children can take, so a shortage leaves a
family only when the whole family is full: siblings before ancestors.

A leaf takes whole seeded epochs and then the prefix of one more.  A prefix in
hash order is a threshold on the hash: the leaf table carries it, and documents
are chosen in a narrow pass, however many a leaf has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orfloom.llm.storage import stored
from orfloom.llm.text import free_name

#: Documents of a hash bucket, about: only one bucket of a leaf is put in order.
BUCKET_ROWS = 5000


def words(text: Column) -> Column:
    """Tokens of a text, as words cut at white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def epoch_hash(doc_id: Column, epoch: Column, seed: int) -> Column:
    """A document's 60-bit place in an epoch's order."""
    return F.conv(F.substring(F.md5(F.concat_ws("-", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 15), 16, 10).cast("long")


def _weight(level: Column, weights: dict[str, float]) -> Column:
    if any(not w > 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    out = F.lit(1.0)
    for name, w in sorted(weights.items()):
        out = F.when(level == F.lit("=" + name), F.lit(float(w))).otherwise(out)
    return out


def water_fill(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Adds ``share`` to rows with ``budget`` (of the parent), ``weight`` and ``cap``: by weight, no more than cap, the rest to the others."""
    ratio = F.col("cap") / F.col("weight")
    order = Window.partitionBy(*parent).orderBy(ratio.asc(), F.col(name).asc())
    below = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    family = Window.partitionBy(*parent)
    out = children.withColumn("level", (F.col("budget") - below) / left).withColumn("full", ratio <= F.col("level"))
    out = out.withColumn("water", F.max(F.when(~F.col("full"), F.col("level"))).over(family))
    return out.withColumn("share", F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * F.col("water"))).drop("level", "full", "water")


def mix_sources(
    df: DataFrame,
    levels: list[Column],
    weights: list[dict[str, float]],
    fraction: float = 1.0,
    total: int | None = None,
    max_epochs: int = 1,
    seed: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``df``'s columns and ``epoch``: the documents that meet the budgets, once for each epoch that takes them.

    ``levels`` are the tree's columns from the root, ``weights`` for each the
    weights of names among their siblings (1 where none is given; all must be
    positive).  The budget is ``total`` tokens, or that fraction of all tokens.
    A leaf's last epoch takes documents in hash order as long as their tokens
    stay within its budget; rows of one id stand or fall together in an epoch.  Very long texts are one
    document like others.
    Null names are a name of their own; texts without words cost nothing and
    go with the prefix; a null id has one place in the order.  Empty tables and
    leaves without tokens: only full epochs (one, if the budget has any room)
    are taken.  An ``epoch`` column of ``df`` is replaced.
    """
    spark = df.sparkSession
    k = len(levels)
    mark = free_name(df.columns, "__mix")
    names = [f"{mark}_level{i}" for i in range(k)]
    full_, rest_, buckets_, cut_ = (f"{mark}_{x}" for x in ("full", "rest", "buckets", "cut"))
    named = [F.coalesce(F.concat(F.lit("="), level.cast("string")), F.lit("null")).alias(n) for level, n in zip(levels, names, strict=True)]
    slim = stored(df.select(*named, F.col(f"`{doc_id}`").alias("doc_id"), words(F.col(f"`{text}`")).alias("tokens")), "mixing-rows")
    leaves = stored(slim.groupBy(*names).agg(F.sum("tokens").cast("double").alias("tokens"), F.count("*").alias("docs")), "leaves")
    every = leaves.agg(F.sum("tokens")).first()[0] or 0.0
    budget = min(float(total) if total is not None else fraction * every, every * max_epochs)
    nodes = None
    for depth in range(1, k + 1):
        path = names[:depth]
        level = leaves.groupBy(*path).agg((F.sum("tokens") * max_epochs).alias("cap")).withColumn("weight", _weight(F.col(path[-1]), weights[depth - 1]))
        if nodes is None:
            level = level.withColumn("root", F.lit(0)).withColumn("budget", F.lit(budget))
            nodes = water_fill(level, ["root"], path[-1])
        else:
            above = nodes.select(*names[: depth - 1], F.col("share").alias("budget"))
            nodes = water_fill(level.join(above, names[: depth - 1]), names[: depth - 1], path[-1])
    target = F.floor(F.col("share") + 1e-6)
    full = F.when(F.col("tokens") > 0, F.floor(target / F.col("tokens"))).otherwise(F.lit(1 if budget > 0 or not every else 0)).cast("long")
    plan = leaves.join(nodes.select(*names, "share"), names).select(
        *names, "docs", full.alias(full_), F.when(F.col("tokens") > 0, target - full * F.col("tokens")).otherwise(0).cast("long").alias(rest_)
    )
    plan = stored(plan.withColumn(buckets_, F.greatest(F.lit(1), F.ceil(F.col("docs") / BUCKET_ROWS)).cast("long")), "mixing-plan")
    place = epoch_hash(F.col("doc_id"), F.col(full_) + 1, seed)
    bucket = F.least(F.floor(F.col("place") / F.lit(float(1 << 60)) * F.col(buckets_)), F.col(buckets_) - 1)
    rows = slim.join(plan.where(f"{rest_} > 0"), names).withColumn("place", place).withColumn("bucket", bucket)
    sums = rows.groupBy(*names, "bucket").agg(F.sum("tokens").alias("tokens"), F.first(rest_).alias("rest"))
    running = Window.partitionBy(*names).orderBy("bucket")  # a row for some thousand documents
    sums = sums.withColumn("upto", F.sum("tokens").over(running)).withColumn("before", F.col("upto") - F.col("tokens"))
    edge = sums.where("before <= rest and upto > rest").groupBy(*names).agg(F.min("bucket").alias("bucket"), F.min("before").alias("before"))
    inside = Window.partitionBy(*names).orderBy("place")  # one bucket of the leaf; rows of one place count together
    cut = (
        rows.join(edge, [*names, "bucket"])
        .withColumn("upto", F.col("before") + F.sum("tokens").over(inside))
        .groupBy(*names)
        .agg(F.max(F.when(F.col("upto") <= F.col(rest_), F.col("place"))).alias("within"), F.min("place").alias("first"))
        .select(*names, F.coalesce("within", F.col("first") - 1).alias(cut_))
    )
    plan = stored(plan.join(cut, names, "left").select(*names, full_, F.coalesce(cut_, F.when(F.col(rest_) > 0, F.lit((1 << 62))).otherwise(F.lit(-1))).alias(cut_)), "mixing-cuts")
    keep = [c for c in df.columns if c != "epoch"]
    out = df.select(*(F.col(f"`{c}`") for c in keep), *named).join(plan, names)
    last = (epoch_hash(F.col(f"`{doc_id}`"), F.col(full_) + 1, seed) <= F.col(cut_)).cast("long")
    times = F.col(full_) + last
    out = out.withColumn(f"{mark}_times", times).where(f"{mark}_times > 0")
    return out.select(*(F.col(f"`{c}`") for c in keep), F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"{mark}_times"))).alias("epoch"))
