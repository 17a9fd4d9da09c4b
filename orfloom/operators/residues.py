"""Per-residue tables, alignment frames and the assembly of sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orfloom.functions import intervals as iv
from orfloom.functions import scalars as sc
from orfloom.functions import sequence as sq
from orfloom.operators.ranges import gap_runs


def array_mean(values: Column) -> Column:
    known = F.filter(values, lambda x: x.isNotNull() & ~F.isnan(x))
    return F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda a, x: a + x) / F.size(known))


def region_scores(df: DataFrame, scores: str, length: str, start: str, end: str, tolerant: float = -0.5) -> DataFrame:
    """Means over the unique and the shared residues, their difference, tolerant unique residues, status (AG12).

    Residues are 0-based and half-open; anything not computable is null with its status.
    """
    s, a, b = F.col(scores), F.col(start), F.col(end)
    status = (
        F.when(s.isNull(), "no_cache").when(a.isNull() | b.isNull() | (b <= a), "no_diff_region").when(F.size(s) != F.col(length), "length_mismatch").otherwise("ok")
    )
    df = df.withColumn("status", status)
    ok = F.col("status") == "ok"
    inside = F.slice(s, a + 1, F.greatest(b - a, F.lit(0)))
    outside = F.concat(F.slice(s, F.lit(1), a), F.slice(s, b + 1, F.greatest(F.size(s) - b, F.lit(0))))
    df = df.withColumn("unique_mean", F.when(ok, array_mean(inside))).withColumn("shared_mean", F.when(ok, array_mean(outside)))
    df = df.withColumn("n_tolerant", F.when(ok, F.size(F.filter(inside, lambda x: x >= tolerant))))
    return df.withColumn("difference", F.col("unique_mean") - F.col("shared_mean"))


def window_stats(df: DataFrame, key: list[str], values: str, start: Column, end: Column, cap: int = 100) -> DataFrame:
    """Statistics of an array over a residue window, and its first ``cap`` rows beside them (AG14, AG32)."""
    rows = df.select(*key, start.alias("__a"), end.alias("__b"), F.posexplode(values).alias("residue", "value")).where("residue >= __a and residue < __b").drop("__a", "__b")
    stats = rows.groupBy(*key).agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    rows = rows.withColumn("__k", F.row_number().over(Window.partitionBy(*key).orderBy("residue"))).where(F.col("__k") <= cap).drop("__k")
    return rows.join(stats, key)


def matrix_blocks(df: DataFrame, key: list[str], i: str, j: str, value: str, start: str, end: str) -> DataFrame:
    """Mean error within the unique, within the shared residues and between them, both directions pooled (AG14)."""
    u, v = (F.col(c).between(F.col(start), F.col(end) - 1) for c in (i, j))
    block = F.when(u & v, "unique").when(~u & ~v, "shared").otherwise("between")
    out = df.groupBy(*key).agg(*(F.avg(F.when(block == b, F.col(value))).alias(b) for b in ("unique", "shared", "between")))
    return out


def element_summary(df: DataFrame, key: list[str], kind: str, length: str, confidence: str, floor: float = 0.7) -> DataFrame:
    """Elements by kind, and the longest of enough confidence (AG15)."""
    return df.groupBy(*key, kind).agg(F.count("*").alias("n"), F.coalesce(F.max(F.when(F.col(confidence) >= floor, F.col(length))), F.lit(0)).alias("longest"))


def frame_integrity(df: DataFrame, key: list[str], column: str, reference: str, target: str) -> DataFrame:
    """What a target keeps of a reference reading frame in aligned columns (WN14).

    ``column`` orders the alignment.  The start codon must equal the
    reference's own; a stop before the last codon is premature; ``intact`` is
    no frameshift and no premature stop; identity is over codons without gaps,
    null if there are none; ``aligned`` is false when no base is.
    """
    w = Window.partitionBy(*key).orderBy(column)
    cols = df.withColumn("__r", F.sum((F.col(reference) != "-").cast("int")).over(w) - 1)
    shifts = gap_runs(df, key, [column], F.col(target) == "-", F.col(reference) == "-").groupBy(*key).agg(F.max("frameshift").alias("frameshift"))
    bases = cols.where(F.col(reference) != "-").withColumn("__c", F.floor(F.col("__r") / 3))
    codon = F.array_sort(F.collect_list(F.struct("__r", F.col(reference).alias("a"), F.col(target).alias("b"))))
    codons = bases.groupBy(*key, "__c").agg(codon.alias("x"), F.count_if(F.col(target) != "-").alias("__n"), F.count("*").alias("__k"))
    codons = codons.withColumn("a", F.concat_ws("", F.transform("x", lambda x: x.a))).withColumn("b", F.concat_ws("", F.transform("x", lambda x: x.b)))
    last = F.max("__c").over(Window.partitionBy(*key))
    codons = codons.withColumn("last", last).withColumn("whole", (F.length("b") == 3) & ~F.col("b").contains("-"))
    aa, ab = sq.translate("a"), sq.translate("b")
    out = codons.groupBy(*key).agg(
        (F.sum("__n") / F.sum("__k")).alias("coverage"), F.max(F.when(F.col("__c") == 0, F.upper("a") == F.upper("b"))).alias("start_intact"),
        F.coalesce(F.max(F.when(F.col("whole") & (F.col("__c") < F.col("last")), ab == "*")), F.lit(False)).alias("premature_stop"), F.avg(F.when(F.col("whole"), (aa == ab).cast("int"))).alias("identity"),
    )
    out = out.join(shifts, key, "left").withColumn("frameshift", F.coalesce("frameshift", F.lit(False))).withColumn("aligned", F.col("coverage") > 0)
    return out.withColumn("intact", F.col("aligned") & ~F.col("frameshift") & ~F.col("premature_stop"))


def assemble_sites(rows: DataFrame, skeletons: DataFrame) -> DataFrame:
    """Alternative rows with their transcript's reference protein and skeleton: id, ORF type, exons, region (JN18).

    rows: symbol, tid, genome_pos, codon, tis_type, protein, samples; raises
    if an alternative's transcript has no annotated row.
    """
    p = sc.parse_locus("genome_pos")
    typed = rows.select("*", p["chrom"].alias("chrom"), p["gstart"].alias("gstart"), p["strand"].alias("strand"), sc.orf_type("tis_type").alias("orf_type"))
    annotated = typed.where("orf_type = 'Annotated'")
    alternatives = typed.where("orf_type <> 'Annotated'")
    lacking = [r["tid"] for r in alternatives.select("tid").distinct().join(annotated.select("tid").distinct(), "tid", "left_anti").limit(20).collect()]
    if lacking:
        raise ValueError(f"transcripts without an annotated row: {lacking}")
    best = F.struct(F.length("protein"), -F.col("gstart"))
    canonical = annotated.groupBy("tid").agg(F.max_by(F.struct("protein", "gstart"), best).alias("ref"))
    out = alternatives.join(canonical, "tid").join(skeletons.select(F.col("transcript_id").alias("tid"), "exons"), "tid", "left")
    start = F.when(F.col("strand") == "-", F.col("gstart")).otherwise(F.col("gstart") - 1)
    ref_start = F.when(F.col("strand") == "-", F.col("ref.gstart")).otherwise(F.col("ref.gstart") - 1)
    bases = [(F.length(F.rtrim(c, F.lit("*"))) * 3).cast("bigint") for c in (F.col("protein"), F.col("ref.protein"))]
    out = out.withColumn("canonical_protein", F.col("ref.protein")).withColumn("isoform_exons", iv.take_coding("exons", start, bases[0], "strand")).withColumn("canonical_exons", iv.take_coding("exons", ref_start, bases[1], "strand"))
    split = iv.unique_shared("orf_type", "isoform_exons", "canonical_exons")
    out = out.withColumn("unique", split["unique"]).withColumn("shared", split["shared"]).withColumn("region", sq.differential_region("orf_type", "protein", "canonical_protein"))
    return out.withColumn("tis_id", F.concat_ws(":", "chrom", F.col("gstart").cast("string"), "strand", "codon", "tid")).drop("ref")
