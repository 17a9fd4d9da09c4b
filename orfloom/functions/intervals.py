"""Interval arrays: ``array<struct<start:bigint,end:bigint>>``, 0-based and half-open, inside one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from orfloom.functions.scalars import SEPARATE_TYPES, col

INTERVALS = "array<struct<start:bigint,end:bigint>>"


def _pair(start: Column, end: Column) -> Column:
    return F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end"))


def empty() -> Column:
    return F.array().cast(INTERVALS)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once a row, however often it is used."""
    return F.transform(F.array(value), use)[0]


def normalize(intervals: str | Column) -> Column:
    """Sorted, empty ones dropped, overlapping and adjacent ones merged (SC20)."""
    given = F.sort_array(F.filter(col(intervals).cast(INTERVALS), lambda x: x.start < x.end))

    def add(done: Column, x: Column) -> Column:
        joins = (F.size(done) > 0) & F.coalesce(x.start <= F.try_element_at(done, F.lit(-1)).end, F.lit(False))
        tail = F.try_element_at(done, F.lit(-1))
        longer = F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(_pair(tail.start, F.greatest(tail.end, x.end))))
        return F.when(joins, longer).otherwise(F.concat(done, F.array(_pair(x.start, x.end))))

    def merged(x: Column) -> Column:
        touch = F.zip_with(F.slice(x.end, 1, F.size(x) - 1), F.slice(x.start, 2, F.size(x)), lambda end, start: start <= end)
        return F.when((F.size(x) < 2) | ~F.array_contains(touch, True), x).otherwise(F.aggregate(x, empty(), add))  # most lists have nothing to merge

    return bound(given, merged)


def total_length(intervals: str | Column) -> Column:
    return F.aggregate(col(intervals), F.lit(0).cast("bigint"), lambda a, x: a + F.greatest(x.end - x.start, F.lit(0)))


def intersect(a: str | Column, b: str | Column) -> Column:
    """Common parts of two normalised lists (ST03)."""

    def common(other: Column) -> Column:
        parts = F.transform(
            col(a).cast(INTERVALS),
            lambda x: F.transform(F.filter(other, lambda y: (x.start < y.end) & (y.start < x.end)), lambda y: _pair(F.greatest(x.start, y.start), F.least(x.end, y.end))),
        )
        return F.flatten(parts)

    return bound(col(b).cast(INTERVALS), common)


def difference(a: str | Column, b: str | Column) -> Column:
    """Parts of normalised ``a`` outside ``b``: the gaps that ``b`` leaves in each interval."""
    other = normalize(b)

    def cut(x: Column) -> Column:
        inside = F.filter(other, lambda y: (x.start < y.end) & (y.start < x.end))
        starts = F.concat(F.array(x.start), F.transform(inside, lambda y: y.end))
        ends = F.concat(F.transform(inside, lambda y: y.start), F.array(x.end))
        return F.filter(F.zip_with(starts, ends, _pair), lambda g: g.start < g.end)

    return F.flatten(F.transform(col(a).cast(INTERVALS), cut))


def contains_position(intervals: str | Column, pos: str | Column) -> Column:
    """Is a 1-based position inside?  ``start < pos <= end``."""
    p = col(pos)
    return F.exists(col(intervals), lambda x: (x.start < p) & (p <= x.end))


def overlaps(intervals: str | Column, start: str | Column, end: str | Column) -> Column:
    s, e = col(start), col(end)
    return F.exists(col(intervals), lambda x: (x.start < e) & (s < x.end))


def unique_shared(kind: str | Column, isoform: str | Column, canonical: str | Column) -> dict[str, Column]:
    """Unique and shared parts by ORF type (ST04): a separate ORF shares nothing even where bases overlap."""
    k = col(kind)
    separate, truncated = k.isin(SEPARATE_TYPES), k == "Truncated"
    return {
        "unique": F.when(truncated, difference(canonical, isoform)).when(separate, col(isoform).cast(INTERVALS)).otherwise(difference(isoform, canonical)),
        "shared": F.when(separate, empty()).otherwise(intersect(isoform, canonical)),
    }


def take_coding(exons: str | Column, start: str | Column, n_bases: str | Column, strand: str | Column) -> Column:
    """The first ``n_bases`` of a transcript from a genomic start, along its exons (SC21).

    ``start`` is the 0-based first base on ``+`` and the exclusive upper end on ``-``.
    """
    minus = col(strand) == "-"
    s, n = col(start).cast("bigint"), col(n_bases).cast("bigint")
    ordered = F.array_sort(col(exons).cast(INTERVALS))
    ordered = F.when(minus, F.reverse(ordered)).otherwise(ordered)
    zero = F.struct(empty().alias("out"), n.alias("left"))

    def step(state: Column, x: Column) -> Column:
        lo = F.when(minus, x.start).otherwise(F.greatest(x.start, s))
        hi = F.when(minus, F.least(x.end, s)).otherwise(x.end)
        take = F.greatest(F.least(hi - lo, state.left), F.lit(0))
        piece = F.when(minus, _pair(hi - take, hi)).otherwise(_pair(lo, lo + take))
        return F.struct(F.when(take > 0, F.concat(state.out, F.array(piece))).otherwise(state.out).alias("out"), (state.left - take).alias("left"))

    return F.array_sort(F.aggregate(ordered, zero, step).out)


def coding_offset(exons: str | Column, pos: str | Column, strand: str | Column) -> Column:
    """0-based offset of a 1-based genomic position along the exons, null outside them (WN11)."""
    p, minus, e = col(pos), col(strand) == "-", col(exons)
    plus = F.aggregate(e, F.lit(0).cast("bigint"), lambda a, x: a + F.greatest(F.least(x.end, p - 1) - x.start, F.lit(0)))
    after = F.aggregate(e, F.lit(0).cast("bigint"), lambda a, x: a + F.greatest(x.end - F.greatest(x.start, p), F.lit(0)))
    return F.when(contains_position(e, p), F.when(minus, after).otherwise(plus))


def changed_span(pos: str | Column, ref: str | Column, alt: str | Column) -> dict[str, Column]:
    """Minimal change (SC23): first changed base and the alleles without their common prefix (one base kept for pure indels' position)."""
    r, a = F.upper(col(ref)), F.upper(col(alt))
    n = F.least(F.length(r), F.length(a))
    # two single bases, as most changes are, need no loop
    same = F.when((F.length(r) == 1) & (F.length(a) == 1), (r == a).cast("int")).otherwise(F.aggregate(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0),
        lambda k, i: F.when((k == i - 1) & (i <= n) & (F.substr(r, i, F.lit(1)) == F.substr(a, i, F.lit(1))), i).otherwise(k),
    ))
    return {"first": col(pos) + same, "ref": F.substr(r, same + 1), "alt": F.substr(a, same + 1), "shared": same}
