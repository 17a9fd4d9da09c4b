"""Running totals and clusters in order, with a key dealt over many tasks.

Rows are range-partitioned by key and order and written; a part of a key is
totalled by itself, the totals of the parts before it (a row for each part) are
its carry.  So a key with a third of all rows is as many tasks as it is large.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orfloom.scratch import stored

_AGGREGATES = {"sum": F.sum, "max": F.max, "min": F.min}


def _same(a: list[str], b: list[str]) -> Column:
    cond = F.lit(True)
    for x, y in zip(a, b, strict=True):
        cond = cond & F.col(x).eqNullSafe(F.col(y))
    return cond


def running(df: DataFrame, key: list[str], order: list[str], totals: dict[str, tuple[str, str]]) -> DataFrame:
    """``df`` with, for each ``{name: (aggregate, column)}``, that aggregate (sum, max, min) of the key's rows before this one in ``order``; null at the first.

    ``order`` must tell the rows of a key apart, else equal rows are in any order.
    """
    places = [*key, *order]
    parts = df.repartitionByRange(*places).sortWithinPartitions(*places) if places else df
    parts = stored(parts.withColumn("__part", F.spark_partition_id()), "running-parts")
    local = Window.partitionBy(*key, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    whole = parts.groupBy(*(F.col(k).alias(f"__key{i}") for i, k in enumerate(key)), F.col("__part").alias("__of")).agg(*(_AGGREGATES[how](c).alias(f"__all_{name}") for name, (how, c) in totals.items()))
    keys = [f"__key{i}" for i in range(len(key))]
    before = Window.partitionBy(*keys).orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part of a key
    carried = whole.select(*keys, "__of", *(_AGGREGATES[how](f"__all_{name}").over(before).alias(f"__carry_{name}") for name, (how, _) in totals.items()))
    out = parts.select("*", *(_AGGREGATES[how](c).over(local).alias(f"__own_{name}") for name, (how, c) in totals.items()))
    out = out.join(carried, _same(key, keys) & (F.col("__part") == F.col("__of")))
    both = {"sum": lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b), "max": F.greatest, "min": F.least}
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *(both[how](F.col(f"__own_{name}"), F.col(f"__carry_{name}")).alias(name) for name, (how, _) in totals.items()))


def islands(df: DataFrame, key: list[str], start: str, end: str, reach: int = 0, out: str = "island") -> DataFrame:
    """``df`` with the number of its transitive union of overlapping (``reach`` 0: also adjacent; -1: overlapping only) intervals within the key."""
    spans = df.groupBy(*key, start, end).agg(F.count("*").alias("__n"))  # equal intervals are in one island
    ends = running(spans, key, [start, end], {"__before": ("max", end)})
    new = F.when(F.col("__before").isNull() | (F.col(start) > F.col("__before") + reach), 1).otherwise(0)
    numbered = running(ends.withColumn("__new", new), key, [start, end], {"__count": ("sum", "__new")})
    numbered = numbered.select(*(F.col(c).alias(f"__i{k}") for k, c in enumerate([*key, start, end])), (F.coalesce("__count", F.lit(0)) + F.col("__new")).alias(out))
    named = [f"__i{k}" for k in range(len(key) + 2)]
    return df.join(numbered, _same([*key, start, end], named)).drop(*named)


def average_ranks(df: DataFrame, value: str, part: list[str], out: str = "rank") -> DataFrame:
    """``df`` with the average rank of a value in its part, and ``<out>_of``: how many values there are; nulls and their rank stay null.

    Ranks come from the distinct values, so ties of any number are one row there.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*part, value).agg(F.count("*").alias("__n"))
    before = running(counts, part, [value], {"__before": ("sum", "__n")})
    size = counts.groupBy(*(F.col(p).alias(f"__p{i}") for i, p in enumerate(part))).agg(F.sum("__n").alias(f"{out}_of"))
    keys = [f"__p{i}" for i in range(len(part))]
    ranks = before.join(F.broadcast(size) if not part else size, _same(part, keys))
    ranks = ranks.select(*(F.col(p).alias(f"__q{i}") for i, p in enumerate([*part, value])), (F.coalesce("__before", F.lit(0)) + (F.col("__n") + 1) / 2).alias(out), f"{out}_of")
    named = [f"__q{i}" for i in range(len(part) + 1)]
    on = _same(part, named[:-1]) & (F.col(value) == F.col(named[-1]))
    return df.join(ranks, on, "left").drop(*named)


def first_fit_clusters(df: DataFrame, key: list[str], order: list[str], start: str, end: str, label: str) -> DataFrame:
    """Clusters of a key's half-open spans: each span, in ``order``, joins the oldest cluster whose union it overlaps, else founds one (WN13).

    A span that bridges two clusters leaves them apart, unlike a transitive
    union.  Returns ``key, start, end, n, members`` (sorted labels).  Spans of
    different transitive unions never meet, so a task walks whole unions in
    order; only the clusters of the current one are in memory.  Spans that are
    empty or null are left out.
    """
    rows = df.where(F.col(start) < F.col(end))
    rows = islands(rows, key, start, end, -1, "__island")
    names = [*key, "__island", "__nr", start, end, label]
    rows = rows.select(*key, "__island", F.struct(*order).alias("__nr"), F.col(start).cast("long").alias(start), F.col(end).cast("long").alias(end), F.col(label).cast("string").alias(label))
    rows = rows.repartition(*key, "__island").sortWithinPartitions(*key, "__island", "__nr").drop("__nr")
    names.remove("__nr")
    fields = [rows.schema[k] for k in key]
    schema = T.StructType([*fields, *T.StructType.fromDDL("__cluster long, lo long, hi long, n long, members array<string>").fields])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow, width = to_arrow_schema(schema), len(key)

    def walk(batches):
        group, clusters = None, []

        def rows_of():
            return [(*group[:width], i, lo, hi, n, sorted(found)) for i, (lo, hi, n, found) in enumerate(clusters)]

        for batch in batches:
            out = []
            for row in zip(*(batch.column(i).to_pylist() for i in range(len(names))), strict=True):
                if row[: width + 1] != group:
                    if group is not None:
                        out += rows_of()
                    group, clusters = row[: width + 1], []
                a, b, name = row[width + 1 :]
                for c in clusters:
                    if a < c[1] and c[0] < b:
                        c[0], c[1], c[2] = min(a, c[0]), max(b, c[1]), c[2] + 1
                        break
                else:
                    c = [a, b, 1, set()]
                    clusters.append(c)
                if name is not None:
                    c[3].add(name)
            if out:
                yield _rows(out, arrow)
        if group is not None:
            yield _rows(rows_of(), arrow)

    found = rows.mapInArrow(walk, schema)
    return found.select(*key, F.col("lo").alias(start), F.col("hi").alias(end), "n", F.array_join("members", ",").alias("members"))


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
