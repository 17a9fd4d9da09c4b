"""Sequences as fixed tiles, and what is cut out of them.

A chromosome is rows ``(chrom, tile, bases)`` of ``width`` bases, so no value and no
task holds a whole one.  Exons meet the tiles they lie on in a join on
``(chrom, tile)``; the pieces of a transcript are stitched in order.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orfloom.functions.intervals import INTERVALS, bound, empty, normalize, total_length
from orfloom.functions.sequence import reverse_complement
from orfloom.scratch import stored

#: Bases of a tile.
WIDTH = 1 << 16


def _pieces(df: DataFrame, width: int) -> DataFrame:
    """``chrom, at, bases`` of any lengths, cut at the edges of tiles and put together: one row a tile."""
    first, last = F.floor(F.col("at") / width), F.floor((F.col("at") + F.length("bases") - 1) / width)
    cut = df.where(F.length("bases") > 0).select("*", F.explode(F.sequence(first, last)).alias("tile"))
    lo = F.greatest(F.col("at"), F.col("tile") * width)
    piece = F.substr("bases", (lo - F.col("at") + 1).cast("int"), ((F.col("tile") + 1) * width - lo).cast("int"))
    cut = cut.select("chrom", "tile", F.struct(lo.alias("lo"), piece.alias("piece")).alias("x"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["piece"]), "")  # at most a tile
    return cut.groupBy("chrom", "tile").agg(whole.alias("bases"))


def tiles(df: DataFrame, chrom: str | Column, sequence: str | Column, width: int = WIDTH) -> DataFrame:
    """``chrom, tile, bases`` of sequences that are values of a table."""
    c = F.col(chrom) if isinstance(chrom, str) else chrom
    s = F.col(sequence) if isinstance(sequence, str) else sequence
    parts = F.regexp_extract_all(s, F.lit(f"(?s)(.{{1,{width}}})"), F.lit(1))  # one pass; an outer generator has its input computed once
    cut = df.select(c.alias("chrom"), F.posexplode_outer(parts).alias("tile", "bases"))
    return cut.where("bases is not null").select("chrom", F.col("tile").cast("long").alias("tile"), "bases")


def read_genome(spark: SparkSession, path: str | list[str], width: int = WIDTH, name: str = r"^(\S+)") -> DataFrame:
    """Tiles of FASTA files, plain ones read by many tasks at once (SRC06); ``name``: what of a header names the sequence.

    A task runs through its split of a file and writes stretches of bases with
    their distance from the last header in the split; what lies before the
    first one continues the split before.  Headers and bases of the splits
    (a row for each) give every stretch its sequence and its place.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.rtrim("value").alias("value"))

    def run(batches):
        split, header, at, held, size, nr = None, None, 0, [], 0, 0

        def row():
            nonlocal at, held, size, nr
            out = (*split, nr, header, at, "".join(held))
            at, held, size, nr = at + size, [], 0, nr + 1
            return out

        for batch in batches:
            out = []
            for file, block, value in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if (file, block) != split:
                    if split is not None:
                        out.append(row())
                    split, header, at, nr = (file, block), None, 0, 0
                if value.startswith(">"):
                    out.append(row())
                    header, at = value[1:], 0
                elif not value.startswith(";"):
                    held.append(value)
                    size += len(value)
                    if size >= width:
                        out.append(row())
            if out:
                yield _stretches(out)
        if split is not None:
            yield _stretches([row()])

    found = stored(lines.mapInArrow(run, "file string, block long, nr long, header string, at long, bases string"), "genome-stretches")
    named, end = F.col("header").isNotNull(), F.col("at") + F.length("bases")
    splits = found.groupBy("file", "block").agg(
        F.max(F.when(~named, end)).alias("lead"), F.max_by("header", F.when(named, F.col("nr"))).alias("last"), F.max_by(end, F.when(named, F.col("nr"))).alias("tail"),
    )
    order = Window.partitionBy("file").orderBy("block")  # a row for each split
    splits = splits.withColumns({"group": F.count("last").over(order), "adds": F.when(F.col("last").isNotNull(), F.col("tail")).otherwise(F.col("lead")), "from": F.last("last", ignorenulls=True).over(order)})
    splits = splits.withColumn("upto", F.sum("adds").over(Window.partitionBy("file", "group").orderBy("block")))
    splits = splits.select("file", "block", F.lag("from").over(order).alias("from"), F.lag("upto").over(order).alias("offset"))
    placed = found.join(splits, ["file", "block"])
    chrom = F.regexp_extract(F.coalesce("header", "from"), name, 1)
    placed = placed.select(chrom.alias("chrom"), (F.col("at") + F.when(named, 0).otherwise(F.coalesce("offset", F.lit(0)))).alias("at"), "bases")
    return _pieces(placed.where("chrom <> ''"), width)


def _stretches(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("file", pa.string()), ("block", pa.int64()), ("nr", pa.int64()), ("header", pa.string()), ("at", pa.int64()), ("bases", pa.string())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows, strict=True), kinds, strict=True)], schema=pa.schema(kinds))


def cut_out(df: DataFrame, tiled: DataFrame, key: list[str], columns: dict[str, str], chrom: str = "chrom", strand: str = "strand", width: int = WIDTH) -> DataFrame:
    """``key`` and, for each ``{out: intervals column}``, the bases of its half-open intervals read on the strand, upper-cased, and ``<out>_missing``: how many of them no tile has (SC03).

    All columns are cut in one join with the tiles.  A row without intervals
    has an empty sequence.  ``key`` must be unique.  ``df`` is computed once and
    written, with its intervals in order.
    """
    given = df.withColumns({f"__of_{o}": normalize(F.coalesce(F.col(c).cast(INTERVALS), empty())) for o, c in columns.items()})
    df = stored(given.drop(*(c for c in columns if c in df.columns)), "cut-out")

    def named(o: str) -> Column:
        return F.transform(f"__of_{o}", lambda x: F.struct(F.lit(o).alias("which"), F.greatest(x.start, F.lit(0)).alias("lo"), x.end.alias("hi")))

    rows = df.select(*key, F.col(chrom).alias("chrom"), F.explode(F.concat(*map(named, columns))).alias("x")).select(*key, "chrom", "x.*")
    ends = [F.when(F.col("which") == o, F.col(c)).alias(f"__{c}_{o}") for o in columns for c in ("lo", "hi")]
    found = _met(rows.select(*key, "chrom", *ends), tiled, key, {o: (f"__lo_{o}", f"__hi_{o}") for o in columns}, "chrom", width, "inner")
    found = found.select(*(F.col(k).alias(f"__{k}") for k in key), *columns)
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    out = df.join(found, same, "left")
    minus = F.col(strand) == "-"
    return out.select(
        *(F.col(c) for c in df.columns if not c.startswith("__of_")),
        *(F.when(minus, reverse_complement(F.coalesce(o, F.lit("")))).otherwise(F.upper(F.coalesce(o, F.lit("")))).alias(o) for o in columns),
        *((total_length(f"__of_{o}") - F.length(F.coalesce(o, F.lit("")))).alias(f"{o}_missing") for o in columns),
    )


def _met(exons: DataFrame, tiled: DataFrame, by: list[str], spans: dict[str, tuple[str, str]], chrom: str, width: int, how: str, order: str | None = None) -> DataFrame:
    """``by`` and, for each ``{out: (start, end)}``, the bases of its intervals by ``order``, else by their starts, and ``__of_<out>``: how long they are together, null where all are null.

    A row meets the tiles under all of its intervals once.
    """
    given = {o: F.col(a) < F.col(b) for o, (a, b) in spans.items()}
    lo = [F.when(given[o], F.greatest(F.col(a), F.lit(0))) for o, (a, _) in spans.items()]
    hi = [F.when(given[o], F.col(b)) for o, (_, b) in spans.items()]
    lo, hi = (F.least(*lo), F.greatest(*hi)) if len(spans) > 1 else (lo[0], hi[0])
    under = F.when(lo < hi, F.sequence(F.floor(lo / width), F.floor((hi - 1) / width)))
    ends = list(dict.fromkeys([c for pair in spans.values() for c in pair] + [order] * (order is not None)))
    rows = exons.select(*by, F.col(chrom).alias("chrom"), *ends, (F.posexplode_outer if how == "left" else F.posexplode)(under).alias("__nth", "tile"))
    met = rows.join(tiled.select("chrom", "tile", "bases"), ["chrom", "tile"], how)
    first, pieces, lengths = F.col("tile") * width, {}, {}
    for o, (a, b) in spans.items():
        begin = F.greatest(F.col(a), first)
        end = F.least(F.col(b), first + width)
        piece = F.substr("bases", (begin - first + 1).cast("int"), (end - begin).cast("int"))
        # in a tile, with bases; a null is not collected
        pieces[f"__p_{o}"] = F.when(given[o] & (begin < end) & (begin - first < F.length("bases")), F.struct(F.col(order or a).alias("nr"), begin.alias("at"), piece.alias("bases")))
        lengths[f"__of_{o}"] = F.when(given[o].isNotNull() & (F.coalesce("__nth", F.lit(0)) == 0), F.greatest(F.col(b) - F.col(a), F.lit(0)))
    met = met.select(*by, *(c.alias(n) for n, c in (pieces | lengths).items()))
    whole = (F.array_join(F.sort_array(F.collect_list(f"__p_{o}"))["bases"], "").alias(o) for o in spans)  # of one transcript
    return met.groupBy(*by).agg(*whole, *(F.sum(n).alias(n) for n in lengths))


def splice(exons: DataFrame, tiled: DataFrame, key: list[str], spans: dict[str, tuple[str, str]], keep: list[str] | None = None, every: bool = True, chrom: str = "chrom", strand: str = "strand", width: int = WIDTH, order: str | None = None) -> DataFrame:
    """``cut_out`` of a table of one exon a row: ``key``, ``keep`` and, for each ``{out: (start, end)}``, its bases and ``<out>_missing``.

    A row may hold several parts of its exon.  Exons are read by ``order``, else
    by their starts, which must then differ in a key; bases on which they overlap
    are read in each.  Of a key whose intervals are all null, so is the sequence.  Chromosome,
    strand and the columns ``keep`` are the same in all rows of a key.  Without
    ``every``, keys of which no tile has a base are left out.  Where exons are
    dealt by ``key`` already and tiles are few, no exon is shuffled or written.
    """
    found = _met(exons, tiled, [*key, *(keep or []), strand], spans, chrom, width, "left" if every else "inner", order)
    found = found if every else found.where(" or ".join(f"length(`{o}`) > 0" for o in spans))
    minus, known = F.col(strand) == "-", {o: F.when(F.col(f"__of_{o}").isNotNull(), F.col(o)) for o in spans}
    return found.select(
        *key, *(keep or []),
        *(F.when(minus, reverse_complement(x)).otherwise(F.upper(x)).alias(o) for o, x in known.items()),
        *((F.col(f"__of_{o}") - F.length(o)).alias(f"{o}_missing") for o in spans if every),
    )


def coding_parts(exons: str, start: str | Column, end: str | Column) -> Column:
    """The part of sorted exons inside the coding bounds."""
    s, e = ((F.col(x) if isinstance(x, str) else x).cast("long") for x in (start, end))

    def cut(span: Column) -> Column:
        parts = F.transform(normalize(exons), lambda x: F.struct(F.greatest(x.start, span.start).alias("start"), F.least(x.end, span.end).alias("end")))
        return F.filter(parts, lambda x: (x.start < x.end) & span.start.isNotNull() & span.end.isNotNull())

    return bound(F.struct(s.alias("start"), e.alias("end")), cut)


def index_with_sequences(df: DataFrame, tiled: DataFrame, key: str = "tis_id", frames: dict[str, tuple[str, str]] | None = None, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """The index with a coding sequence for each ``{out: (exons, residues)}``, and how many disagree with the protein they should encode (SNK09).

    A sequence is right where it has three bases for each residue; without a
    length or without bases nothing is checked.
    """
    frames = frames or {"orf_cds": ("orf_exons", "isoform_len"), "canonical_cds": ("canonical_orf_exons", "canonical_per_tid_length")}
    return _checked(cut_out(df, tiled, [key], {o: exons for o, (exons, _) in frames.items()}, width=width), {o: n for o, (_, n) in frames.items()})


def _checked(out: DataFrame, residues: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    wrong = {o: (F.length(o) > 0) & F.col(n).isNotNull() & (F.length(o) != 3 * F.col(n)) for o, n in residues.items()}
    counts = [F.struct(F.lit(o).alias("sequence"), F.count_if(F.length(o) > 0).alias("n"), F.count_if(bad).alias("n_mismatched")) for o, bad in wrong.items()]
    report = out.agg(F.array(*counts).alias("x")).select(F.explode("x").alias("x")).select("x.*")  # a row for each sequence, of an empty index too
    return out.withColumns({f"{o}_ok": ~bad for o, bad in wrong.items()}), report


def index_exons(exons: DataFrame, tiled: DataFrame, key: str, frames: dict[str, tuple[str, str, str]], width: int = WIDTH, order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``index_with_sequences`` of a table of one exon a row, with ``{out: (start, end, residues)}``; see ``splice``."""
    spans, residues = {o: (a, b) for o, (a, b, _) in frames.items()}, {o: n for o, (*_, n) in frames.items()}
    index, given = (splice(exons, tiled, [key], spans, list(dict.fromkeys(residues.values())), every=every, width=width, order=order) for every in (True, False))
    return _checked(index, residues)[0], _checked(given, residues)[1]  # the report counts keys that have bases
