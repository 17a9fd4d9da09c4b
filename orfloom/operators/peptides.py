"""Diagnostic peptides of isoforms, unique within their pair and within the proteome (SC15)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orfloom.functions.sequence import tryptic_digest

# Fixed values of the domain: second residues after which the initiator is cut off.
EXCISED_BEFORE = ("A", "C", "G", "P", "S", "T", "V")


def diagnostic_peptides(
    df: DataFrame, protein: str, kind: str, region_start: str | Column, region_end: str | Column, missed: int = 1, shortest: int = 7, longest: int = 30
) -> DataFrame:
    """``df``'s columns with ``peptide, pos, end, excised``, a row for each peptide that tells an isoform from its canonical protein.

    ``kind`` is the ORF type.  Of an extension the peptides that touch the region
    [``region_start``, ``region_end``) of the isoform, all where it is not known; of a
    truncation those at its start; of others all.  A peptide at the start of a
    classified isoform whose second residue lets the initiator go is there
    without it, too.
    """
    a, b = (F.col(x) if isinstance(x, str) else x for x in (region_start, region_end))
    rows = df.select("*", F.explode(tryptic_digest(protein, missed, shortest, longest)).alias("__p"))
    pos, end = F.col("__p.start"), F.col("__p.start") + F.length("__p.peptide")
    type_ = F.col(kind)
    touches = (pos < b) & (end > a)
    kept = F.when((type_ == "Extended") & a.isNotNull() & b.isNotNull(), touches).when(type_ == "Truncated", pos == 0).otherwise(F.lit(True))
    rows = rows.where(kept)
    letter = F.substring("__p.peptide", 2, 1)
    form = lambda text, at, cut: F.struct(text.alias("peptide"), at.cast("int").alias("pos"), end.cast("int").alias("end"), F.lit(cut).alias("excised"))
    cut = F.when(type_.isNotNull() & (pos == 0) & letter.isin(*EXCISED_BEFORE), form(F.substr("__p.peptide", F.lit(2)), F.lit(1), True))
    forms = F.array_compact(F.array(form(F.col("__p.peptide"), pos, False), cut))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], F.explode(forms).alias("__f")).select(*[F.col(f"`{c}`") for c in df.columns], "__f.*")


def proteome_peptides(proteins: DataFrame, protein: str, missed: int = 1, shortest: int = 7, longest: int = 30) -> DataFrame:
    """``peptide``: the distinct digest of a proteome, with its starts without initiator; equal proteins are digested once."""
    once = proteins.select(F.col(protein).alias("__protein")).where(F.col(protein).isNotNull()).distinct()
    digested = diagnostic_peptides(once.withColumn("__kind", F.lit("Annotated")), "__protein", "__kind", F.lit(None).cast("int"), F.lit(None).cast("int"), missed, shortest, longest)
    return digested.select("peptide").distinct()


def unique_peptides(
    sites: DataFrame, gene: str, isoform: str, canonical: str, kind: str, region_start: str, region_end: str,
    proteome: DataFrame | None = None, missed: int = 1, shortest: int = 7, longest: int = 30,
) -> DataFrame:
    """``gene, peptide``: diagnostic peptides that the site's canonical protein does not yield, and with ``proteome`` (``peptide``) no other protein does.

    Sites without either protein have none.  All tests are joins on the
    peptide; a frequent one is dealt over tasks like any other skewed key.
    """
    both = sites.where(F.col(isoform).isNotNull() & (F.col(isoform) != "") & F.col(canonical).isNotNull() & (F.col(canonical) != ""))
    pairs = both.select(gene, F.col(isoform).alias("__iso"), F.col(canonical).alias("__can"), F.col(kind).alias("__kind"), F.col(region_start).alias("__a"), F.col(region_end).alias("__b")).distinct()
    own = diagnostic_peptides(pairs, "__iso", "__kind", "__a", "__b", missed, shortest, longest).select(gene, "__can", "peptide").distinct()
    other = pairs.select("__can").distinct().select("__can", F.explode(tryptic_digest("__can", missed, shortest, longest)).alias("p")).select("__can", F.col("p.peptide").alias("peptide")).distinct()
    found = own.join(other, ["__can", "peptide"], "left_anti").select(gene, "peptide").distinct()
    return found if proteome is None else found.join(proteome.select("peptide").distinct(), "peptide", "left_anti")
