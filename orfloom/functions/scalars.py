"""Scalar column expressions: identifiers, labels, guarded arithmetic, tri-state logic.

Nulls mean "not computable" throughout and are never turned into false.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the domain.
#: ORF types and, for each, the space of its unique region.
ORF_TYPES = ["Annotated", "Truncated", "Extended", "InternalOutOfFrame", "uORF", "uoORF", "3UTR_ORF", "AltORF"]
SEPARATE_TYPES = ["InternalOutOfFrame", "uORF", "uoORF", "3UTR_ORF", "AltORF"]
#: Codons that can initiate: ATG and its single-base neighbours.
START_CODONS = ["ATG", "CTG", "GTG", "TTG", "ACG", "AGG", "AAG", "ATA", "ATC", "ATT"]
#: Severity rank of clinical families.
SIGNIFICANCE_RANK = {"pathogenic": 5, "conflicting": 4, "uncertain": 3, "other": 2, "benign": 1, "none": 0}


def col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- loci and labels (PRJ01-PRJ04, PRJ12, PRJ16)


def parse_locus(genome_pos: str | Column) -> dict[str, Column]:
    """``chrom:lo-hi:strand`` from the right; start and stop swap on the minus strand; malformed gives nulls."""
    c, pattern = col(genome_pos), r"^(.*):(\d+)-(\d+):([+-])$"
    part = [F.nullif(F.regexp_extract(c, pattern, i), F.lit("")) for i in range(1, 5)]
    lo, hi, strand = part[1].cast("long"), part[2].cast("long"), part[3]
    return {
        "chrom": part[0], "lo": lo, "hi": hi, "strand": strand,
        "gstart": F.when(strand == "-", hi).otherwise(lo), "gend": F.when(strand == "-", lo).otherwise(hi),
    }


def init_site(genome_pos: str | Column, codon: str | Column) -> Column:
    p = parse_locus(genome_pos)
    return F.concat_ws(":", p["chrom"], p["gstart"].cast("string"), p["strand"], col(codon))


def simple_type(tis_type: str | Column) -> Column:
    """Five-way label by the first substring found, in a fixed order."""
    c, out = col(tis_type), F.lit("Other")
    for part, label in reversed([("Annotated", "Annotated"), ("Truncated", "Truncated"), ("5'UTR", "uORF"), ("Extended", "Extended")]):
        out = F.when(c.contains(part), label).otherwise(out)
    return F.when(c.isNotNull(), out)


def orf_type(tis_type: str | Column) -> Column:
    """Eight-way ORF type by prefix; out-of-reading-frame overlaps are named apart."""
    c = col(tis_type)
    overlap = c.contains("CDSFrameOverlap")
    return (
        F.when(c.startswith("Annotated"), "Annotated").when(c.startswith("Truncated"), "Truncated").when(c.startswith("Extended"), "Extended")
        .when(c.startswith("Internal"), "InternalOutOfFrame").when(c.startswith("5'UTR") & overlap, "uoORF").when(c.startswith("5'UTR"), "uORF")
        .when(c.startswith("3'UTR"), "3UTR_ORF").when(c.startswith("Novel") & overlap, "uoORF").when(c.isNotNull(), "AltORF")
    )


def region_label(kind: str | Column) -> Column:
    c = col(kind)
    return F.when(c == "Extended", "extension").when(c == "Truncated", "lost region").when(c.isNotNull(), "ORF")


def normalize_chrom(chrom: str | Column) -> Column:
    c = F.trim(col(chrom))
    bare = F.regexp_replace(c, "^(?i)chr", "")
    return F.when(bare.isin("MT", "M"), "chrM").otherwise(F.concat(F.lit("chr"), bare))


def with_initiator(protein: str | Column, annotated: str | Column) -> Column:
    """Annotated rows start with M."""
    c = col(protein)
    return F.when(col(annotated) & (F.length(c) > 0), F.concat(F.lit("M"), F.substring(c, 2, 1 << 30))).otherwise(c)


def identity_columns(isoform: str | Column, canonical: str | Column) -> dict[str, Column]:
    a, b = F.length(F.rtrim(col(isoform), F.lit("*"))), F.length(F.rtrim(col(canonical), F.lit("*")))
    return {"isoform_len": a, "canonical_len": b, "delta_len": a - b, "ratio_len": guarded_ratio(a, b)}


# --- guarded arithmetic and tri-state logic (PRJ15, AG09, AG31, SC17, EV*)


def guarded_ratio(num: str | Column, den: str | Column) -> Column:
    d = col(den)
    return F.when(d > 0, col(num) / d)


def strict_least(*cols: str | Column) -> Column:
    """``least`` that is null when any part is."""
    cs = [col(c) for c in cols]
    missing = cs[0].isNull()
    for c in cs[1:]:
        missing = missing | c.isNull()
    return F.when(~missing, F.least(*cs))


def density_ratio(n_subject: Column, len_subject: Column, n_reference: Column, len_reference: Column) -> Column:
    """Density of a region against another; null on an empty region, an empty reference or a negative count."""
    ok = (len_subject > 0) & (len_reference > 0) & (n_reference > 0) & (n_subject >= 0)
    return F.when(ok, (n_subject / len_subject) / (n_reference / len_reference))


def enriched(unique: Column, shared: Column) -> Column:
    """Is the unique side larger?  Null when a side is negative or the shared one is not positive."""
    return F.when((unique >= 0) & (shared > 0), unique > shared)


def any_true(*flags: Column) -> Column:
    """True if any is; null if none is known; else false: unlike SQL's OR, unknown parts do not matter."""
    known = F.array_compact(F.array(*flags))
    return F.when(F.size(known) > 0, F.exists(known, lambda x: x))


def at_least(value: str | Column, cutoff: float) -> Column:
    return col(value) >= F.lit(cutoff)


def clean_number(value: str | Column) -> Column:
    """NaN is missing."""
    c = col(value)
    return F.when(~F.isnan(c), c)


# --- transforms (SC16, WN08)


def log1p_clipped(c: str | Column) -> Column:
    return F.log1p(F.greatest(col(c), F.lit(0.0)))


def signed_log(c: str | Column) -> Column:
    return F.signum(col(c)) * F.log1p(F.abs(col(c)))


def neg_log10(c: str | Column) -> Column:
    return -F.log10(F.greatest(col(c), F.lit(1e-300)))


def normal_quantile(p: str | Column) -> Column:
    """Inverse normal distribution function, by a rational approximation refined with two Halley steps (error < 1e-9).

    Intermediate values are bound by higher-order functions, so the expression stays small.
    """
    c = col(p)

    def start(low: Column) -> Column:
        t = F.sqrt(-2 * F.log(low))
        # Abramowitz and Stegun, formula 26.2.23.
        return t - (2.515517 + t * (0.802853 + t * 0.010328)) / (1 + t * (1.432788 + t * (0.189269 + t * 0.001308)))

    def refine(x: Column, low: Column) -> Column:
        def halley(error: Column) -> Column:
            return x + error / (1 - x * error / 2)

        density = F.exp(-x * x / 2) / F.sqrt(F.lit(2 * 3.141592653589793))
        return F.transform(F.array((_upper_tail(x) - low) / density), halley)[0]

    def solve(low: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(2)), start(low), lambda x, _: refine(x, low))

    tail = F.least(F.greatest(F.least(c, 1 - c), F.lit(1e-300)), F.lit(0.5))
    x = F.transform(F.array(tail), solve)[0]
    return F.when(c < 0.5, -x).when(c.isNotNull(), x)


def _upper_tail(x: Column) -> Column:
    """P(Z > x) for x >= 0: a continued fraction for large, a series for small arguments."""
    density = F.exp(-x * x / 2) / F.sqrt(F.lit(2 * 3.141592653589793))
    fraction = x
    for k in range(60, 0, -1):
        fraction = x + k / fraction
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(60)), F.struct(x.alias("term"), x.alias("total")),
        lambda a, k: F.struct((a.term * x * x / (2 * k + 1)).alias("term"), (a.total + a.term * x * x / (2 * k + 1)).alias("total")),
    ).total
    return F.when(x > 2.5, density / fraction).otherwise(0.5 - density * series)


# --- clinical labels (PRJ10, PRJ11)


def significance_family(text: str | Column) -> Column:
    """Conflicting is tested before pathogenic; empty is ``none``."""
    c = F.lower(F.trim(col(text)))
    return (
        F.when(c.isNull() | (c == ""), "none").when(c.contains("conflicting"), "conflicting").when(c.contains("pathogenic"), "pathogenic")
        .when(c.contains("uncertain"), "uncertain").when(c.contains("benign"), "benign").otherwise("other")
    )


def significance_rank(family: str | Column) -> Column:
    ranks = F.create_map(*(F.lit(x) for pair in SIGNIFICANCE_RANK.items() for x in pair))
    return F.element_at(ranks, col(family))


def review_stars(status: str | Column) -> Column:
    c = F.lower(col(status))
    return (
        F.when(c.contains("practice guideline"), 4).when(c.contains("expert panel"), 3).when(c.contains("multiple submitters"), 2)
        .when(c.contains("single submitter") | c.contains("conflicting"), 1).otherwise(0)
    )


def protein_position(notation: str | Column) -> Column:
    """0-based residue of a protein notation: its first integer less one."""
    return F.regexp_extract(col(notation), r"(\d+)", 1).try_cast("int") - 1


def content_hash(protein: str | Column) -> Column:
    return F.sha1(F.upper(F.rtrim(col(protein), F.lit("*"))))


def numbers_in(text: str | Column, stop: list[str] | None = None) -> Column:
    """Numbers of a text, without thousands separators, per cent and plus signs; those of the stop list left out."""
    found = F.regexp_extract_all(col(text), F.lit(r"([+-]?\d[\d,]*(?:\.\d+)?%?)"), F.lit(1))
    found = F.transform(found, lambda x: F.regexp_replace(x, r"[,%+]", ""))
    return F.array_except(found, F.array(*(F.lit(s) for s in stop))) if stop else F.array_distinct(found)
