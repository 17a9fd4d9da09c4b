"""Variant normalisation and consequence as join jobs."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orfloom.functions.intervals import changed_span, coding_offset
from orfloom.functions.scalars import normalize_chrom
from orfloom.functions.sequence import reverse_complement, start_codon_effect, translate, translate_short
from orfloom.operators.ranges import range_join
from orfloom.scratch import stored

MOST_ALTS = 1000


def _once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with columns that are computed once a row: from a generator no filter or projection above takes copies of the expressions."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(k) for k, c in columns.items())))))


def normalize_variants(lines: DataFrame, value: str = "value", line_id: str = "line") -> DataFrame:
    """One row per alternative allele with its class, or a typed rejection (SRC09)."""
    text = F.col(value)
    rows = _once(lines.where(~text.startswith("#") & (F.trim(text) != "")).select(line_id, value), {"f": F.split(text, "\t")}).drop(value)
    pos = F.try_element_at("f", F.lit(2)).try_cast("long")
    ref = F.upper(F.try_element_at("f", F.lit(4)))
    alts = F.split(F.upper(F.try_element_at("f", F.lit(5))), ",")
    rows = _once(rows, {"chrom": normalize_chrom(F.col("f")[0]), "pos": pos, "ref": ref, "alts": alts, "filter": F.try_element_at("f", F.lit(7))}).drop("f")
    bad = F.when(F.col("pos").isNull() | (F.col("pos") < 1) | F.col("ref").isNull() | ~F.col("ref").rlike("^[ACGTN]+$") | F.col("alts").isNull(), "malformed").when(F.size("alts") > MOST_ALTS, "too_many_alts")
    rows = _once(rows, {"rejected": bad})
    out = rows.select("*", F.posexplode_outer(F.when(F.col("rejected").isNull(), F.col("alts"))).alias("alt_index", "alt")).drop("alts")
    odd = F.when(F.col("alt").rlike(r"[\[\]]"), "sv_breakend").when(F.col("alt").isNotNull() & ~F.col("alt").rlike("^[ACGTN]+$"), "unsupported_alt")
    out = out.withColumn("rejected", F.coalesce("rejected", odd))
    delta = F.length("alt") - F.length("ref")
    kind = F.when((delta == 0) & (F.length("ref") == 1), "snv").when(delta == 0, "mnv").when(delta > 0, "insertion").otherwise("deletion")
    out = out.withColumn("kind", F.when(F.col("rejected").isNull(), kind))
    return out.withColumn("variant_id", F.concat_ws(":", "chrom", F.col("pos").cast("string"), "ref", "alt"))


def variants_in_orfs(variants: DataFrame, index: DataFrame, width: int = 10_000) -> DataFrame:
    """(variant, ORF) rows whose spans meet (JN06); index: orf_id, chrom, strand, exons, cds, kind, unique."""
    v = variants.withColumn("v_start", F.col("pos") - 1).withColumn("v_end", F.col("pos") - 1 + F.length("ref"))
    spans = index.withColumn("o_start", F.array_min(F.transform("exons", lambda x: x.start))).withColumn("o_end", F.array_max(F.transform("exons", lambda x: x.end)))
    return range_join(v, spans, width, "v_start", "v_end", "o_start", "o_end", ["chrom"])


def _edges(first: Column, last: Column) -> dict[str, Column]:
    """Where a changed span (1-based, inclusive) leaves the exons: intronic bases below or above its coding ones, or between them."""
    inside = F.filter("exons", lambda x: (x.start < last) & (first <= x.end))
    low, high = F.array_min(F.transform(inside, lambda x: F.greatest(x.start + 1, first))), F.array_max(F.transform(inside, lambda x: F.least(x.end, last)))
    coding = F.aggregate(inside, F.lit(0).cast("long"), lambda n, x: n + F.least(x.end, last) - F.greatest(x.start + 1, first) + 1)
    ends = F.array_min(F.transform("exons", lambda x: x.start)) + 1, F.array_max(F.transform("exons", lambda x: x.end))
    return {"below": (first < low) & (low - 1 > ends[0]), "above": (last > high) & (high + 1 < ends[1]), "between": coding < high - low + 1}


def classify(pairs: DataFrame) -> DataFrame:
    """Consequence, residue and notation of each (variant, ORF) row (VC01-VC06, VC11).

    Offsets of the first and last changed base decide; the smaller one is the
    anchor on either strand.  A span that leaves the coding sequence is judged by
    where it leaves: into an intron it takes a splice site (the acceptor, where
    it takes both), out through the start codon the start, else its length
    class stands (a substitution is intronic).  Substitutions are judged by
    their codon window; other changes by their length: ``ref_aa`` and ``alt_aa`` are
    then the residues removed and gained, ``stop_after`` how many residues behind
    the first one of a frameshift a stop follows inside the sequence.  An
    insertion is inside if both its neighbours are.
    """
    c = changed_span("pos", "ref", "alt")
    p = pairs.withColumn("first", c["first"]).withColumn("r", c["ref"]).withColumn("a", c["alt"])
    minus = F.col("strand") == "-"
    n = F.length("cds")
    last = F.col("first") + F.greatest(F.length("r") - 1, F.lit(0))
    p = p.withColumn("last", last)
    insertion = (F.length("r") == 0) & (F.length("a") > 0)
    p = p.withColumn("o1", coding_offset("exons", "first", "strand"))
    p = p.withColumn("o2", F.when(F.col("last") == F.col("first"), F.col("o1")).otherwise(coding_offset("exons", "last", "strand")))
    p = p.withColumn("ob", F.when(insertion, coding_offset("exons", F.col("first") - 1, "strand")))
    many = F.aggregate("exons", F.lit(0).cast("long"), lambda m, x: m + F.greatest(F.least(x.end, F.col("last")) - F.greatest(x.start, F.col("first") - 1), F.lit(0)))
    p = p.withColumn("covered", F.when(F.col("last") == F.col("first"), F.col("o1").isNotNull().cast("long")).otherwise(many))
    p = p.withColumn("lo", F.least("o1", "o2"))
    read_r = F.when(minus, reverse_complement("r")).otherwise(F.col("r"))
    read_a = F.when(minus, reverse_complement("a")).otherwise(F.col("a"))
    # an insertion goes before the first changed base; on the minus strand behind it
    at = F.when(insertion, F.least("o1", "ob") + 1).otherwise(F.col("lo"))
    p = p.withColumn("at", at).withColumn("read_r", read_r).withColumn("read_a", read_a)
    whole = F.col("covered") == F.col("last") - F.col("first") + 1
    inside = F.when(insertion, F.col("o1").isNotNull() & F.col("ob").isNotNull()).otherwise(whole)
    partly = ~insertion & ~whole & (F.col("covered") > 0)
    p = p.withColumn("inside", inside).withColumn("partly", partly)
    found = F.substr("cds", F.col("at") + 1, F.length("r"))
    mutant = F.concat(F.substr("cds", F.lit(1), F.col("at")), F.col("read_a"), F.substr("cds", F.col("at") + F.length("r") + 1))
    p = p.withColumn("mutant", F.when(F.col("inside"), mutant))
    delta = F.length("a") - F.length("r")
    edge = _edges(F.col("first"), F.col("last"))
    low_exon = F.filter("exons", lambda x: (x.start < F.col("last")) & (F.col("first") <= x.end))
    low_base, high_base = F.greatest(F.array_min(F.transform(low_exon, lambda x: x.start)) + 1, F.col("first")), F.least(F.array_max(F.transform(low_exon, lambda x: x.end)), F.col("last"))
    least = F.when(F.col("partly"), coding_offset("exons", F.when(minus, high_base).otherwise(low_base), "strand"))
    p = p.withColumn("anchor", F.when(F.col("inside"), F.col("at")).otherwise(least))
    codon = F.floor(F.col("anchor") / 3).cast("int")
    n_codons = F.greatest(F.lit(1), F.ceil((F.col("anchor") % 3 + F.greatest(F.length("r"), F.lit(1))) / 3)).cast("int")
    p = p.withColumn("codon", codon).withColumn("n_codons", n_codons)
    window = lambda seq, count: translate_short(F.substr(seq, F.col("codon") * 3 + 1, count * 3))
    moved = F.floor(F.abs(delta) / 3).cast("int")
    gained = F.regexp_extract(window("mutant", moved), r"^([^*]*\*?)", 1)
    ref_aa = F.when(delta == 0, window("cds", F.col("n_codons"))).when(delta % 3 != 0, window("cds", F.lit(1))).when(delta < 0, window("cds", moved)).otherwise("")
    alt_aa = F.when(delta == 0, window("mutant", F.col("n_codons"))).when((delta % 3 == 0) & (delta > 0), gained).otherwise("")
    fits = (F.col("codon") + F.when(insertion, 1).otherwise(F.col("n_codons"))) * 3 <= n
    p = p.withColumn("ref_aa", F.when(F.col("inside") & fits, ref_aa)).withColumn("alt_aa", F.when(F.col("inside") & fits, alt_aa))
    start = start_codon_effect(F.substring("cds", 1, 3), F.substring("mutant", 1, 3))["consequence"]
    unknown = start_codon_effect(F.substring("cds", 1, 3), F.lit("NNN"))["consequence"]
    length_class = F.when(delta % 3 != 0, "frameshift").when(delta > 0, "inframe_insertion").otherwise("inframe_deletion")
    substitution = (
        F.when((F.col("codon") == 0) & start.isNotNull(), start).when(F.col("ref_aa") == F.col("alt_aa"), "synonymous").when(F.instr("ref_aa", "*") > 0, "stop_lost")
        .when(F.instr("alt_aa", "*") > 0, "stop_gained").otherwise("missense")
    )
    upstream, downstream = F.when(minus, edge["above"]).otherwise(edge["below"]), F.when(minus, edge["below"]).otherwise(edge["above"])
    leaving = (
        F.when(downstream & ~upstream, "splice_donor").when(upstream | downstream | edge["between"], "splice_acceptor")
        .when((F.col("anchor") < 3) & unknown.isNotNull(), "start_lost").when(delta == 0, "intronic").otherwise(length_class)
    )
    what = (
        F.when(F.col("partly"), leaving).when(~F.col("inside"), "intronic").when(~insertion & (found != F.col("read_r")), "reference_mismatch")
        .when(~fits & (delta == 0), "past_the_end").when(delta == 0, substitution).when((F.col("codon") == 0) & start.isNotNull(), start).otherwise(length_class)
    )
    p = p.withColumn("consequence", what).withColumn("residue", F.col("codon"))
    behind = F.instr(translate(F.substr("mutant", F.col("codon") * 3 + 1)), "*")
    p = p.withColumn("stop_after", F.when((F.col("consequence") == "frameshift") & F.col("inside"), F.nullif(behind, F.lit(0))))
    p = p.withColumn("in_last_codon", F.when(F.col("inside"), F.col("codon") == F.floor(n / 3).cast("int") - 1))
    p = p.withColumn("notation", notation("consequence", "residue", "ref_aa", "alt_aa"))
    return p.drop("o1", "o2", "ob", "lo", "at", "read_r", "read_a", "mutant", "r", "a", "first", "last", "covered", "inside", "partly", "anchor", "codon", "n_codons")


# Three-letter names of amino acids, and how a stop is written.
AMINO_NAMES = {
    "A": "Ala", "C": "Cys", "D": "Asp", "E": "Glu", "F": "Phe", "G": "Gly", "H": "His", "I": "Ile", "K": "Lys", "L": "Leu", "M": "Met",
    "N": "Asn", "P": "Pro", "Q": "Gln", "R": "Arg", "S": "Ser", "T": "Thr", "V": "Val", "W": "Trp", "Y": "Tyr", "*": "Ter",
}


def three_letters(residues: str | Column) -> Column:
    """Residues by their three-letter names; other letters stay."""
    names = F.create_map(*(F.lit(x) for kv in AMINO_NAMES.items() for x in kv))
    c = F.col(residues) if isinstance(residues, str) else residues
    one = F.coalesce(F.element_at(names, c), c)
    return F.when(F.length(c) <= 1, one).otherwise(F.array_join(F.transform(F.split(c, ""), lambda x: F.coalesce(F.element_at(names, x), x)), ""))


def notation(consequence: str | Column, residue: str | Column, ref_aa: str | Column, alt_aa: str | Column, frame: Column | None = None) -> Column:
    """The change of a hit in protein notation, and the frame it is counted in where one is given (VC11).

    Only changes of as many residues as they replace have one, others are null:
    a lost start ends in ``?``, several residues are replaced as a stretch, an
    unchanged one ends in ``=``.
    """
    what, at, old, new = (F.col(x) if isinstance(x, str) else x for x in (consequence, residue, ref_aa, alt_aa))
    place = F.concat(three_letters(F.substring(old, 1, 1)), (at + 1).cast("string"))
    stretch = F.concat(place, F.lit("_"), three_letters(F.substring(old, -1, 1)), (at + F.length(old)).cast("string"), F.lit("delins"), three_letters(new))
    text = F.when(what == "start_lost", F.concat(place, F.lit("?"))).when(F.length(old) > 1, stretch).when(old == new, F.concat(place, F.lit("="))).otherwise(F.concat(place, three_letters(new)))
    plain = F.when((F.length(old) > 0) & (F.length(old) == F.length(new)), F.concat(F.lit("p."), text))
    return plain if frame is None else F.when(plain.isNotNull(), F.concat(plain, F.lit(" · "), frame, F.lit(" frame")))


def fallback_class(delta: Column, coding: Column) -> Column:
    """Class of a change without a sequence (VC05)."""
    return F.when(~coding, "intronic").when(delta == 0, "coding").when(delta % 3 != 0, "frameshift").when(delta > 0, "inframe_insertion").otherwise("inframe_deletion")


def region_of_hit(residue: Column, region_start: Column, region_end: Column) -> Column:
    """``unique`` inside the differential residues, else ``shared`` (VC06)."""
    return F.when((residue >= region_start) & (residue < region_end), "unique").when(residue.isNotNull(), "shared")


def figure_coordinate(offset: Column, start_offset: Column) -> Column:
    """Residues from the start codon; whole when in frame (VC07)."""
    d = offset - start_offset
    return F.when(d % 3 == 0, (d / 3).cast("double")).otherwise(d / 3.0)


_ALLELE, _MODEL = ["chrom", "pos", "ref", "alt"], ["chrom", "strand", "exons", "cds"]


class Called(NamedTuple):
    """A variant file called against an index: its variants with their stage, the index, counts of the stages and passing alleles, and a call for each allele on each distinct model."""

    variants: DataFrame
    index: DataFrame
    alleles: DataFrame
    calls: DataFrame


def _alike(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    cond = F.lit(True)
    for c in columns:
        cond = cond & a[c].eqNullSafe(b[c])
    return cond


def scan_calls(lines: DataFrame, index: DataFrame, contigs: list[str] | None = None, width: int = 10_000) -> Called:
    """Calls of a variant file: lines of one allele and ORFs of one model (chromosome, strand, exons, sequence) have the same calls, so these are made once (VC08)."""
    v = normalize_variants(lines)
    passing = F.col("filter").isNull() | F.col("filter").isin("PASS", ".", "")
    known = F.col("chrom").isin(*contigs) if contigs else F.lit(True)
    stage = F.when(F.col("rejected").isNotNull(), F.concat(F.lit("rejected_"), "rejected")).when(~passing, "not_pass").when(~known, "off_catalog")
    v = _once(v, {"stage": stage})
    counts = v.groupBy("stage", *(F.when(F.col("stage").isNull(), F.col(c)).alias(c) for c in _ALLELE)).agg(F.count("*").alias("n_lines"))
    counts = stored(counts, "scan-alleles")
    alleles, models = counts.where("stage is null").select(*_ALLELE), index.select(*_MODEL).distinct()
    return Called(v, index, counts, stored(classify(variants_in_orfs(alleles, models, width)), "scan-calls"))


def all_hits(found: Called, calls: DataFrame | None = None) -> DataFrame:
    """A row for each line and ORF of the calls (or of ``calls`` made from them)."""
    calls = found.calls if calls is None else calls
    v, index = found.variants.where("stage is null"), found.index
    met = calls.join(v, _ALLELE)
    added = [c for c in index.columns if c not in _MODEL]
    return met.join(index, _alike(met, index, _MODEL)).select(*(met[c] for c in met.columns), *(index[c] for c in added))


def weighed_hits(found: Called, group: str) -> DataFrame:
    """The calls for each value of an index column, with ``weight``: of how many lines and ORFs; and ``variant_id``."""
    lines = found.alleles.where("stage is null").select(*_ALLELE, "n_lines")
    orfs = found.index.groupBy(*_MODEL, group).agg(F.count("*").alias("n_rows"))
    met = found.calls.join(lines, _ALLELE)
    met = met.join(orfs, _alike(met, orfs, _MODEL)).select(*(met[c] for c in met.columns), orfs[group], (F.col("n_lines") * F.col("n_rows")).alias("weight"))
    return met.withColumn("variant_id", F.concat_ws(":", "chrom", F.col("pos").cast("string"), "ref", "alt")).drop("n_lines")


def funnel(found: Called) -> DataFrame:
    """How many variants ended in each stage (AG22): each counts in the first class that fits; lines of one number share a hit."""
    hit = found.calls.where("consequence <> 'intronic'").select(*_ALLELE).distinct().withColumn("hit", F.lit(True))
    met = found.variants.where("stage is null").select("line", "alt_index", *_ALLELE).join(hit, _ALLELE, "left")
    met = met.groupBy("line", "alt_index").agg(F.count("*").alias("n"), F.max("hit").alias("hit")).select(F.when(F.col("hit"), "hit").otherwise("no_orf").alias("stage"), "n")
    return found.alleles.where("stage is not null").select("stage", F.col("n_lines").alias("n")).unionByName(met).groupBy("stage").agg(F.sum("n").alias("n"))


def scan(lines: DataFrame, index: DataFrame, contigs: list[str] | None = None, width: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """Hits and the funnel of a variant file (VC08, AG22)."""
    found = scan_calls(lines, index, contigs, width)
    return all_hits(found), funnel(found)


def hits_by_gene(hits: DataFrame, gene: str, region: str | None = None) -> DataFrame:
    """Distinct variants, hits and ORFs of each gene, most first (AG22); with a ``region`` column also the hits in unique and in shared regions."""
    where = [] if region is None else [F.count_if(F.col(region) == r).alias(f"n_{r}") for r in ("unique", "shared")]
    rolled = hits.groupBy(gene).agg(F.countDistinct("variant_id").alias("n_variants"), F.count("*").alias("n_hits"), *where, F.countDistinct("orf_id").alias("n_orfs"))
    return rolled.orderBy(F.desc("n_variants"), F.desc("n_hits"), gene)


def genes_of_scan(found: Called, gene: str, region: Column | None = None) -> DataFrame:
    """As :func:`hits_by_gene`, from the calls and their weights: hits are not formed."""
    hits = weighed_hits(found, gene).withColumn("region", F.lit(None).cast("string") if region is None else region)
    where = [] if region is None else [F.coalesce(F.sum(F.when(F.col("region") == r, F.col("weight"))), F.lit(0)).alias(f"n_{r}") for r in ("unique", "shared")]
    rolled = hits.groupBy(gene).agg(F.countDistinct("variant_id").alias("n_variants"), F.sum("weight").alias("n_hits"), *where)
    met, index = found.calls.select(*_MODEL).distinct(), found.index
    orfs = index.join(met, _alike(index, met, _MODEL), "left_semi").groupBy(F.col(gene).alias("__gene")).agg(F.countDistinct("orf_id").alias("n_orfs"))
    rolled = rolled.join(orfs, F.col(gene).eqNullSafe(F.col("__gene"))).drop("__gene")
    return rolled.orderBy(F.desc("n_variants"), F.desc("n_hits"), gene)


def score_lookup(variants: DataFrame, scores: DataFrame, transcript: str) -> DataFrame:
    """Per-variant score by exact allele, a matching transcript (without version) first (JN08)."""
    bare = F.split_part(F.col("score_transcript"), F.lit("."), F.lit(1))
    keys = ["chrom", "pos", "ref", "alt"]
    j = variants.join(scores, keys, "left").withColumn("__own", (bare == F.split_part(F.col(transcript), F.lit("."), F.lit(1))).cast("int"))
    best = j.groupBy("variant_id", transcript).agg(F.max_by("score", F.struct(F.coalesce("__own", F.lit(0)), "score")).alias("score"))
    return variants.join(best, ["variant_id", transcript], "left")


def gene_variants(variants: list[DataFrame], genes: DataFrame, width: int = 100_000) -> DataFrame:
    """Variants of each gene by symbol or by position in its box, once each (JN07)."""
    from orfloom.operators.combine import union_all

    v = union_all(variants)
    by_name = v.join(genes.select("gene", F.col("gene").alias("symbol")), "symbol").select("gene", *v.columns)
    box = genes.select("gene", "chrom", F.col("start").alias("g_start"), F.col("end").alias("g_end"))
    point = v.withColumn("p_start", F.col("pos") - 1).withColumn("p_end", F.col("pos"))
    by_place = range_join(point, box, width, "p_start", "p_end", "g_start", "g_end", ["chrom"]).select("gene", *v.columns)
    return by_name.unionByName(by_place).dropDuplicates(["gene", "source", "variant_id"])


def variant_effects(hits: DataFrame, logprobs: str = "logprobs", letters: str = "ACDEFGHIKLMNPQRSTVWY") -> DataFrame:
    """Log-probability change of a missense hit with an amino-acid guard (VC10); ``logprobs``: array of 20-arrays by residue."""
    row = F.try_element_at(F.col(logprobs), F.col("residue") + 1)
    wt, mt = F.instr(F.lit(letters), F.col("ref_aa")), F.instr(F.lit(letters), F.col("alt_aa"))
    ok = (F.col("consequence") == "missense") & row.isNotNull() & (wt > 0) & (mt > 0)
    delta = F.when(ok, F.try_element_at(row, mt) - F.try_element_at(row, wt))
    status = F.when(F.col("consequence") != "missense", "not_missense").when(row.isNull(), "no_cache").when((wt == 0) | (mt == 0), "bad_residue").otherwise("ok")
    return hits.withColumn("effect_delta", delta).withColumn("effect_status", status)


def spliced(exons: str | Column, chromosome: str | Column, strand: str | Column, start: Column | None = None, end: Column | None = None) -> Column:
    """Transcript of sorted half-open exons cut from its chromosome's sequence, read on its strand (SC03); ``start``, ``end``: the coding part of it."""
    e = F.col(exons) if isinstance(exons, str) else exons
    c = F.col(chromosome) if isinstance(chromosome, str) else chromosome
    s = F.col(strand) if isinstance(strand, str) else strand

    def piece(x: Column) -> Column:
        lo = x.start if start is None else F.greatest(x.start, start)
        hi = x.end if end is None else F.least(x.end, end)
        return F.substr(c, (lo + 1).cast("int"), F.greatest(hi - lo, F.lit(0)).cast("int"))

    whole = F.concat_ws("", F.transform(e, piece))
    return F.when(s == "-", reverse_complement(whole)).otherwise(F.upper(whole))


def two_frames(pairs: DataFrame, frames: dict[str, tuple[str, str]], fields: list[str]) -> DataFrame:
    """Each variant called in two frames, ``{prefix: (exons column, coding column)}``, with prefixed results (VC09)."""
    out = pairs
    for prefix, (exons, cds) in frames.items():
        called = classify(out.withColumn("exons", F.col(exons)).withColumn("cds", F.col(cds)))
        out = called.select(*out.columns, *(F.col(f).alias(f"{prefix}_{f}") for f in fields))
    return out


def chosen_frame(isoform: Column, canonical: Column, isoform_region: Column, canonical_region: Column) -> dict[str, Column]:
    """Residue, frame and region of a hit: the isoform's frame first, then the canonical one; ``unique`` wins (VC06)."""
    other = isoform.isNull() | ((canonical_region == "unique") & ~isoform_region.eqNullSafe(F.lit("unique")) & canonical.isNotNull())
    return {
        "residue": F.when(other, canonical).otherwise(isoform), "frame": F.when(other & canonical.isNotNull(), "canonical").when(isoform.isNotNull(), "isoform"),
        "region": F.when(other, canonical_region).otherwise(isoform_region),
    }


def wrong_reference(hits: DataFrame, key: list[str], mismatch: Column, checked: Column, share: float = 0.5, least: int = 10, weight: str | None = None) -> DataFrame:
    """Per key: bases checked against the reference, mismatches, and whether they speak for another assembly (AG30); ``weight``: of how many hits a row speaks."""
    count = F.count_if if weight is None else lambda which: F.coalesce(F.sum(F.when(which, F.col(weight))), F.lit(0))
    out = hits.groupBy(*key).agg(count(checked).alias("n_checked"), count(checked & mismatch).alias("n_mismatch"))
    return out.withColumn("wrong_reference", (F.col("n_checked") >= least) & (F.col("n_mismatch") >= share * F.col("n_checked")))


def severest(hits: str | Column, rank: dict[str, int], kind: str, tie: str, n: int) -> Column:
    """The ``n`` severest hits of a list, ties by a field, unknown kinds last (TK04)."""
    ranks = F.create_map(*(F.lit(x) for pair in rank.items() for x in pair))
    listed = F.transform(F.col(hits) if isinstance(hits, str) else hits, lambda h: F.struct((-F.coalesce(F.element_at(ranks, h[kind]), F.lit(0))).alias("severity"), h[tie].alias("tie"), h.alias("hit")))
    return F.transform(F.slice(F.array_sort(listed), 1, n), lambda x: x.hit)
