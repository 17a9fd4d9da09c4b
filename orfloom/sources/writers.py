"""Writers: Spark's committer makes every one of them atomic (SNK03)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orfloom.functions.intervals import unique_shared
from orfloom.functions.scalars import content_hash


def paired_table(isoforms: DataFrame, canonical: DataFrame, genes: DataFrame, key: str = "transcript_id", gene: str = "gene_name") -> DataFrame:
    """One row per site: ``isoform_*``, ``canonical_*`` of its transcript, the gene's columns (SNK01)."""
    can = canonical.select(F.col(key), *(F.col(c).alias(f"canonical_{c}") for c in canonical.columns if c not in (key, gene)))
    iso = isoforms.select(key, gene, *(F.col(c).alias(f"isoform_{c}") for c in isoforms.columns if c not in (key, gene)))
    return iso.join(can, key, "left").join(genes, gene, "left")


def wide_expression(long: DataFrame, key: list[str], sample: str, samples: list[str], metrics: list[str]) -> DataFrame:
    """``expr_{sample}_{metric}`` columns (SNK02)."""
    aggs = [F.max(F.when(F.col(sample) == s, F.col(m))).alias(f"expr_{s}_{m}") for s in samples for m in metrics]
    return long.groupBy(*key).agg(*aggs)


def long_expression(wide: DataFrame, key: list[str], metrics: list[str]) -> DataFrame:
    """The inverse: a row for each sample with any value (SNK02)."""
    samples = sorted({c[5 : -len(m) - 1] for c in wide.columns for m in metrics if c.startswith("expr_") and c.endswith(f"_{m}")})
    rows = F.array(*(F.struct(F.lit(s).alias("sample"), *((F.col(f"expr_{s}_{m}") if f"expr_{s}_{m}" in wide.columns else F.lit(None).cast("double")).cast("double").alias(m) for m in metrics)) for s in samples))
    out = wide.select(*key, F.explode(rows).alias("x")).select(*key, "x.*")
    return out.where(F.coalesce(*(F.col(m) for m in metrics)).isNotNull())


def protein_fasta(df: DataFrame, protein: str) -> DataFrame:
    """A record for each distinct protein, named by its hash; write with ``.write.text`` (SNK04)."""
    one = df.select(content_hash(protein).alias("h"), F.upper(F.rtrim(protein, F.lit("*"))).alias("p")).where("p <> ''").dropDuplicates(["h"])
    return one.select(F.concat(F.lit(">"), "h", F.lit("\n"), "p").alias("value"))


def region_bed(df: DataFrame) -> DataFrame:
    """BED12 lines of the unique blocks; needs chrom, strand, name, kind, isoform and canonical intervals (SNK05)."""
    u = df.withColumn("b", F.array_sort(unique_shared("kind", "isoform", "canonical")["unique"])).where(F.size("b") > 0)
    lo, hi = F.element_at("b", 1).start, F.element_at("b", -1).end
    sizes = F.array_join(F.transform("b", lambda x: (x.end - x.start).cast("string")), ",")
    starts = F.array_join(F.transform("b", lambda x: (x.start - F.element_at(F.col("b"), 1).start).cast("string")), ",")
    return u.select(F.concat_ws("\t", "chrom", lo.cast("string"), hi.cast("string"), "name", F.lit("0"), "strand", lo.cast("string"), hi.cast("string"), F.lit("0"), F.size("b").cast("string"), sizes, starts).alias("value"))


def gene_records(df: DataFrame, gene: str) -> DataFrame:
    """A nested JSON record for each gene; NaN is null (SNK06, SC25, AG23)."""
    clean = df.select(*(F.when(~F.isnan(F.col(c)), F.col(c)).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes))
    row = F.struct(*(c for c in clean.columns if c != gene))
    return clean.groupBy(gene).agg(F.to_json(F.sort_array(F.collect_list(row)), {"ignoreNullFields": "false"}).alias("record"))


def variants_long(df: DataFrame, hits: str, effects: DataFrame, fields: list[str]) -> DataFrame:
    """A row for each hit with metadata fields and the last effect of its variant; a missing effect stays null (SNK07)."""
    flat = df.select("tis_id", "gene_name", F.explode(hits).alias("h")).select("tis_id", "gene_name", "h.*")
    last = effects.groupBy("variant_id").agg(F.max_by(F.struct(*(c for c in effects.columns if c not in ("variant_id", "seq"))), "seq").alias("e"))
    return flat.join(last, "variant_id", "left").select(*(c for c in flat.columns if c != "metadata"), *(F.element_at("metadata", F.lit(f)).alias(f) for f in fields), "e.*")


def orf_index(df: DataFrame, columns: list[str], key: str = "tis_id") -> tuple[DataFrame, DataFrame]:
    """Pruned index columns and an order-independent fingerprint of them (SNK09)."""
    index = df.select(key, *columns)
    return index, index.agg(F.sum(F.xxhash64(F.to_json(F.struct(*index.columns))).cast("decimal(38,0)")).cast("string").alias("fingerprint"), F.count("*").alias("rows"))


def provenance_row(before: DataFrame, after: DataFrame, notes: dict[str, str]) -> DataFrame:
    """Row counts around a filter and the run's notes, as one row (SNK11)."""
    return before.agg(F.count("*").alias("rows_before")).crossJoin(after.agg(F.count("*").alias("rows_after"))).select("*", F.to_json(F.create_map(*(F.lit(x) for kv in notes.items() for x in kv))).alias("notes"))


def ranked_features(df: DataFrame, key: str, lists: dict[str, str]) -> DataFrame:
    """Long table of compared features with their rank within each list (SNK12, WN09)."""
    from orfloom.operators.combine import union_all

    return union_all([df.select(key, F.lit(kind).alias("change"), F.posexplode(c).alias("rank", "feature")).withColumn("rank", F.col("rank") + 1) for kind, c in lists.items()])
