"""Readers of the domain's text formats, each one plan over ``spark.read``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orfloom.functions.scalars import content_hash, normalize_chrom

CALLS = (
    "Gid string, Tid string, Symbol string, GeneType string, GenomePos string, StartCodon string, Start long, Stop long, TisType string, TISGroup string, TISCounts long, "
    "TISPvalue double, RiboPvalue double, RiboPStatus string, FisherPvalue double, TISQvalue double, FrameQvalue double, FisherQvalue double, AALen long, Seq string, AASeq string"
)
#: Summary rows of a counts file.
QC_ROWS = ["__no_feature", "__ambiguous", "__too_low_aQual", "__not_aligned", "__alignment_not_unique"]


def read_predictions(spark: SparkSession, path: str | list[str], header: bool = True) -> DataFrame:
    """Initiation calls; a trailing stop is cut from the protein and its length recomputed (SRC01)."""
    df = spark.read.csv(path, sep="\t", schema=CALLS, header=header, nullValue="NA", enforceSchema=True)
    return df.withColumn("AASeq", F.rtrim("AASeq", F.lit("*"))).withColumn("AALen", F.length("AASeq").cast("long"))


def _attribute(name: str) -> Column:
    return F.nullif(F.regexp_extract("attributes", rf'{name} "([^"]*)"', 1), F.lit(""))


def read_gtf(spark: SparkSession, path: str | list[str], feature: str | None = None) -> DataFrame:
    """Annotation lines with their quoted attributes (SRC02)."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.col("value").startswith("#")).select(f.alias("f")).where(F.size("f") >= 9)
    names = ["chromosome", "source", "feature_type", "start", "end", "score", "strand", "frame", "attributes"]
    rows = rows.select(*(F.col("f")[i].alias(n) for i, n in enumerate(names))).withColumn("start", F.col("start").try_cast("long")).withColumn("end", F.col("end").try_cast("long"))
    if feature:
        rows = rows.where(F.col("feature_type") == feature)
    for a in ("gene_id", "gene_name", "gene_type", "transcript_id", "transcript_type", "transcript_support_level"):
        rows = rows.withColumn(a, _attribute(a))
    return rows.withColumn("MANE_Select", F.col("attributes").contains("MANE_Select")).drop("score", "frame", "attributes")


def exon_skeletons(gtf: DataFrame) -> DataFrame:
    """Per transcript: sorted exons (0-based half-open), coding bounds, lengths (SRC03, SNK08).

    Start and stop codons bound the coding part where given, else its segments
    do.  ``consistent`` is false where a transcript has several chromosomes or
    strands.  The protein length is that of the spliced coding part.
    """
    def of(kind: str, value: Column) -> Column:
        return F.when(F.col("feature_type") == kind, value)

    s, e = F.col("start") - 1, F.col("end")
    g = gtf.groupBy("transcript_id").agg(
        F.first("gene_name", ignorenulls=True).alias("gene_name"), F.min("chromosome").alias("chrom"), F.min("strand").alias("strand"),
        ((F.min("chromosome") == F.max("chromosome")) & (F.min("strand") == F.max("strand"))).alias("consistent"),
        F.array_sort(F.collect_list(of("exon", F.struct(s.alias("start"), e.alias("end"))))).alias("exons"),
        F.min(of("CDS", s)).alias("c0"), F.max(of("CDS", e)).alias("c1"),
        F.min(of("start_codon", s)).alias("a0"), F.max(of("start_codon", e)).alias("a1"), F.min(of("stop_codon", s)).alias("z0"), F.max(of("stop_codon", e)).alias("z1"),
    )
    minus = F.col("strand") == "-"
    g = g.withColumn("cds_start", F.when(minus, F.coalesce("z0", "c0")).otherwise(F.coalesce("a0", "c0")))
    g = g.withColumn("cds_end", F.when(minus, F.coalesce("a1", "c1")).otherwise(F.coalesce("z1", "c1")))
    zero = F.lit(0).cast("long")
    coding = F.aggregate("exons", zero, lambda a, x: a + F.greatest(zero, F.least(x.end, F.col("cds_end")) - F.greatest(x.start, F.col("cds_start"))))
    total = F.aggregate("exons", zero, lambda a, x: a + x.end - x.start)
    return g.select("transcript_id", "gene_name", "chrom", "strand", "consistent", "exons", "cds_start", "cds_end", total.alias("length_nt"),
                    F.when(F.col("cds_start").isNotNull(), F.greatest(zero, F.floor(coding / 3) - 1)).alias("length_aa"))


def read_counts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Counts by gene summed over replicate files, without the summary rows (SRC04)."""
    df = spark.read.csv(paths, sep="\t", schema="Gid string, counts long").where(~F.col("Gid").isin(*QC_ROWS))
    return df.groupBy("Gid").agg(F.sum("counts").alias("counts"))


def sample_manifest(samples: DataFrame, files: DataFrame, condition: Column | None = None) -> DataFrame:
    """Replicate files of each sample; raises if one has none (SRC05)."""
    have = (files.where(condition) if condition is not None else files).groupBy("sample").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    lacking = [r["sample"] for r in samples.join(have, "sample", "left_anti").limit(20).collect()]
    if lacking:
        raise ValueError(f"samples without files: {lacking}")
    return samples.join(have, "sample")


def read_fasta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Records ``header, fields (split at the pipe), sequence`` (SRC06)."""
    rows = spark.read.text(path, lineSep=">").where(F.trim("value") != "")
    lines = F.split(F.rtrim("value"), r"\r?\n")
    rows = rows.select(F.col("value"), lines[0].alias("header"), F.concat_ws("", F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))).alias("sequence"))
    return rows.select("header", F.split("header", r"\|").alias("fields"), "sequence")


def transcript_abundance(df: DataFrame, id_col: str, value: str | None = None, least: float = 0.0) -> DataFrame:
    """Abundance of each id (cut at the first pipe); without a value column, the sum of all others (SRC07)."""
    others = [c for c in df.columns if c != id_col]
    total = F.col(value).cast("double") if value else sum((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in others), F.lit(0.0))
    out = df.select(F.split_part(F.col(id_col), F.lit("|"), F.lit(1)).alias("feature_id"), total.alias("abundance"))
    return out.groupBy("feature_id").agg(F.sum("abundance").alias("abundance")).where(F.col("abundance") >= least)


def read_variant_lines(spark: SparkSession, path: str | list[str], longest: int = 4 << 20) -> DataFrame:
    """Lines of plain or compressed variant files without headers (SRC08); a line of more than ``longest`` characters is an error.

    ``line`` is unique and grows within a file.
    """
    rows = spark.read.text(path).select(F.monotonically_increasing_id().alias("line"), "value").where(~F.col("value").startswith("#"))
    too_long = F.raise_error(F.concat(F.lit(f"a variant line has more than {longest} characters: "), F.substring("value", 1, 40))).cast("string")
    return rows.withColumn("value", F.when(F.length("value") > longest, too_long).otherwise(F.col("value")))


def clinical_variants(spark: SparkSession, path: str, assembly: str = "GRCh38") -> DataFrame:
    """Clinical table with its three spellings of missing; one assembly (SRC10)."""
    df = spark.read.csv(path, sep="\t", header=True)
    df = df.select(*(F.when(~F.col(f"`{c}`").isin("-", "", "na"), F.col(f"`{c}`")).alias(c) for c in df.columns))
    return df.where(F.col("Assembly") == assembly)


def annotation_fields(lines: DataFrame, name: str = "vep") -> list[str]:
    """Names of an annotation's fields in their order, from the header line that describes it (``... Format: A|B|C``)."""
    row = lines.where(F.col("value").startswith(f"##INFO=<ID={name},")).select(F.regexp_extract("value", r"Format: ([^\">]+)", 1).alias("f")).first()
    if row is None or not row["f"]:
        raise ValueError(f"no header line describes {name}")
    return [x.strip() for x in row["f"].split("|")]


def population_variants(lines: DataFrame, fields: list[str], name: str = "vep") -> DataFrame:
    """PASS rows by their first canonical transcript annotation that has a symbol (SRC11).

    Annotations lie under ``name``: comma-separated entries whose fields are
    split at the pipe, in the order of ``fields`` (see ``annotation_fields``).
    """
    lacking = [x for x in ("Consequence", "SYMBOL", "CANONICAL", "HGVSc", "HGVSp", "Protein_position") if x not in fields]
    if lacking:
        raise ValueError(f"annotation fields missing: {lacking}")

    def field(entry, what: str):
        return F.get(entry, F.lit(fields.index(what)))

    f = F.split("value", "\t")
    rows = lines.where(~F.col("value").startswith("#")).select(f.alias("f")).where(F.col("f")[6] == "PASS").select("f", F.str_to_map(F.col("f")[7], F.lit(";"), F.lit("=")).alias("info"))
    notes = F.transform(F.split(F.element_at("info", F.lit(name)), ","), lambda x: F.split(x, r"\|"))
    best = F.try_element_at(F.filter(notes, lambda x: (field(x, "CANONICAL") == "YES") & (field(x, "SYMBOL") != "")), F.lit(1))
    rows = rows.withColumn("v", best).where("v is not null")
    chrom, pos, ref, alt = normalize_chrom(F.col("f")[0]), F.col("f")[1].cast("long"), F.col("f")[3], F.col("f")[4]
    return rows.select(chrom.alias("chrom"), pos.alias("pos"), ref.alias("ref"), alt.alias("alt"), F.concat_ws(":", chrom, pos.cast("string"), ref, alt).alias("variant_id"),
                       F.element_at("info", F.lit("AF")).try_cast("double").alias("allele_frequency"), 
                       *(field(F.col("v"), x).alias(y) for x, y in (("Consequence", "consequence"), ("SYMBOL", "gene_symbol"), ("HGVSp", "hgvsp"), ("HGVSc", "hgvsc"), ("Protein_position", "protein_position"))))


def somatic_variants(lines: DataFrame, fields: list[str]) -> DataFrame:
    """Chosen INFO fields as columns; a bare flag is ``True`` (SRC12)."""
    f = F.split("value", "\t")
    rows = lines.where(~F.col("value").startswith("#")).select(f.alias("f")).withColumn("info", F.str_to_map(F.col("f")[7], F.lit(";"), F.lit("=")))
    values = [F.when(F.array_contains(F.map_keys("info"), k), F.coalesce(F.element_at("info", F.lit(k)), F.lit("True"))).alias(k) for k in fields]
    return rows.select(normalize_chrom(F.col("f")[0]).alias("chrom"), F.col("f")[1].cast("long").alias("pos"), F.col("f")[3].alias("ref"), F.col("f")[4].alias("alt"), *values)


def pathogenicity_scores(spark: SparkSession, path: str) -> DataFrame:
    """Per-substitution scores ``chrom, pos, ref, alt, score_transcript, score`` (SRC13)."""
    return spark.read.csv(path, sep="\t", comment="#", schema="chrom string, pos long, ref string, alt string, score_transcript string, score double")


def read_external_starts(spark: SparkSession, path: str) -> DataFrame:
    """External start sites: required columns are checked, optional ones filled with null (SRC14)."""
    df = spark.read.csv(path, sep="\t", header=True)
    need = ["Hugo_Symbol", "Chromosome", "Start_Position", "End_Position", "Strand", "Transcript_ID", "Type"]
    lacking = [c for c in need if c not in df.columns]
    if lacking:
        raise ValueError(f"columns missing: {lacking}")
    strand = F.when(F.col("Strand").isin("1", "+", "+1"), "+").when(F.col("Strand").isin("-1", "-"), "-")
    extra = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in ("Reference_Allele", "Provenance")]
    return df.select("Hugo_Symbol", normalize_chrom("Chromosome").alias("Chromosome"), F.col("Start_Position").cast("long"), F.col("End_Position").cast("long"), strand.alias("Strand"), "Transcript_ID", "Type", *extra)


def load_picks(spark: SparkSession, source: str | list[dict], required: list[str], aliases: dict[str, str] | None = None) -> DataFrame:
    """Picks of a Parquet or CSV file or of rows at hand, under their usual names (SRC15)."""
    if isinstance(source, str):
        df = spark.read.parquet(source) if source.rstrip("/").endswith(".parquet") else spark.read.csv(source, header=True)
    else:
        df = spark.createDataFrame(source)
    for old, new in (aliases or {}).items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    lacking = [c for c in required if c not in df.columns]
    if lacking:
        raise ValueError(f"columns missing: {lacking}")
    return df


def flatten_structs(df: DataFrame, drop_lists: bool = True) -> DataFrame:
    """Structs as dotted columns, lists left out (SRC16, SC19)."""
    def walk(name: str, field: T.StructField) -> list[Column]:
        c = F.col(name)
        if isinstance(field.dataType, T.StructType):
            return [x for f in field.dataType for x in walk(f"{name}.`{f.name}`", f)]
        if isinstance(field.dataType, T.ArrayType) and drop_lists:
            return []
        return [c.alias(name.replace("`", ""))]

    return df.select(*(x for f in df.schema for x in walk(f"`{f.name}`", f)))


def expand_map(df: DataFrame, column: str, absent=None, most: int = 10_000) -> DataFrame:
    """A column for each key of all rows; an absent key is ``absent``, a null map null (SRC16).  More than ``most`` keys, too many for columns, are an error."""
    found = df.select(F.explode(F.map_keys(column)).alias("k")).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} keys")
    keys = sorted(r["k"] for r in found)
    cols = [F.when(F.col(column).isNotNull(), F.coalesce(F.element_at(column, F.lit(k)), F.lit(absent))).alias(f"{column}.{k}") for k in keys]
    return df.select(*(c for c in df.columns if c != column), *cols)


def read_flat(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files of differing columns as one flat table (SRC16)."""
    from orfloom.operators.combine import union_all

    return union_all([flatten_structs(spark.read.parquet(p)) for p in paths])


def alignment_rows(spark: SparkSession, path: str, reference: str, species: list[str]) -> DataFrame:
    """Rows ``block, species, start, strand, seq`` of alignment blocks; species missing in a block are gaps; blocks without the reference go (SRC17)."""
    whole = spark.read.text(path, lineSep="\n\n").withColumn("block", F.monotonically_increasing_id())
    blocks = whole.select("block", F.explode(F.split("value", "\n")).alias("l")).where(F.col("l").startswith("s"))
    f = F.split(F.trim("l"), r"\s+")
    rows = blocks.select("block", f.alias("f")).select("block", F.split_part(F.col("f")[1], F.lit("."), F.lit(1)).alias("species"), F.col("f")[2].cast("long").alias("start"), F.col("f")[4].alias("strand"), F.col("f")[6].alias("seq"))
    width = rows.where(F.col("species") == reference).groupBy("block").agg(F.max(F.length("seq")).alias("n"))
    grid = width.select("block", "n", F.explode(F.array(*(F.lit(s) for s in species))).alias("species"))
    one = rows.groupBy("block", "species").agg(F.min_by(F.struct("start", "strand", "seq"), "start").alias("r"))
    return grid.join(one, ["block", "species"], "left").select("block", "species", "r.start", "r.strand", F.coalesce(F.col("r.seq"), F.expr("repeat('-', n)")).alias("seq"))


def read_signal_track(spark: SparkSession, path: str) -> DataFrame:
    """Score intervals under one spelling of chromosome names (SRC18)."""
    return spark.read.csv(path, sep="\t", schema="chrom string, t_start long, t_end long, value double").withColumn("chrom", normalize_chrom("chrom"))


def residue_scores(df: DataFrame, protein: str) -> DataFrame:
    """Score arrays keyed by protein content (SRC19, JN14)."""
    return df.withColumn("protein_hash", content_hash(protein))
