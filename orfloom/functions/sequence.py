"""Sequence features as column expressions; tables of values are parameters or fixed values of the domain."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

from orfloom.functions.scalars import START_CODONS, col

# Fixed values of the domain.
#: Amino acids of the codons in the order TTT, TTC, TTA, TTG, TCT, ... (standard code).
STANDARD_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
HYDROPATHY = {
    "A": 1.8, "R": -4.5, "N": -3.5, "D": -3.5, "C": 2.5, "E": -3.5, "Q": -3.5, "G": -0.4, "H": -3.2, "I": 4.5,
    "L": 3.8, "K": -3.9, "M": 1.9, "F": 2.8, "P": -1.6, "S": -0.8, "T": -0.7, "W": -0.9, "Y": -1.3, "V": 4.2,
}
DISORDER = {
    "A": 0.06, "R": 0.18, "N": 0.007, "D": 0.192, "C": -0.02, "E": 0.736, "Q": 0.318, "G": 0.166, "H": 0.303, "I": -0.486,
    "L": -0.326, "K": 0.586, "M": -0.397, "F": -0.697, "P": 0.987, "S": 0.341, "T": 0.059, "W": -0.884, "Y": -0.510, "V": -0.121,
}
PK = {"N_term": 9.69, "C_term": 2.34, "D": 3.9, "E": 4.07, "C": 8.18, "Y": 10.46, "H": 6.04, "K": 10.54, "R": 12.48}
LETTER_SETS = {"charged": "DEKRH", "disorder_promoting": "AESGQKPRD", "aromatic": "FWY", "pi": "FYWRHQN", "prion_like": "QNGSY"}
START_CONSENSUS = "GCCGCCRCCATGG"
START_WEIGHTS = {
    "full": [1.0] * 13,
    "major": [0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 1.0, 1.0, 1.0, 1.0],
    "partial": [0.1, 0.1, 0.1, 0.1, 0.1, 0.1, 1.0, 0.1, 0.1, 1.0, 1.0, 1.0, 1.0],
}
#: Bit of each base in an ambiguity code.
AMBIGUITY = {"A": 1, "C": 2, "G": 4, "T": 8, "U": 8, "R": 5, "Y": 10, "M": 3, "K": 12, "S": 6, "W": 9, "B": 14, "D": 13, "H": 11, "V": 7, "N": 15}
MOTIFS = {
    "CDK_Sites_SP_TP": "[ST]P",
    "ATM_Sites_SQ_TQ": "[ST]Q",
    "Mode1_1433": "R[SFYW][^P][ST][LVIMF]P",
    "Mode2_1433": "R[^E][^P][ST][LEVM][^P][^P]",
    "EB1_SxIP": "[ST].[IL]P",
    "RGG_Sites": "RGG",
    "SH3_ClassI": "[RK].{2}P.{2}P",
    "SH3_ClassII": "P.{2}P.[RK]",
    "Heme_CP_HRM": "C[^C].{2}C[^C]H",
    "Heme_CXXCH": "C.{2}CH",
    "PIP_box": "Q.{2}[ILMV].{2}[FY][FY]",
    "APIM": "[KR][FYW][ILMV][ILMV][KR]",
    "ZnF_C2H2": "C.{2}C.{12}H.{3,5}H",
    "RING_finger": "C.{2}C.{9,39}C.{1,3}H.{2,3}C.{2}C.{4,48}C.{2}C",
}


def literal_map(values: dict) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))


def letters(seq: str | Column) -> Column:
    """Characters of a sequence; an empty one has none."""
    c = col(seq)
    return F.when(F.length(c) > 0, F.split(c, "")).otherwise(F.array().cast("array<string>"))


# --- nucleotides (SC01-SC06)


def reverse_complement(seq: str | Column) -> Column:
    return F.translate(F.reverse(F.upper(col(seq))), "ACGT", "TGCA")


def _residue(codon: Column) -> Column:
    """The amino acid of three bases, by their places in the order T, C, A, G; X for others."""
    place = [F.instr(F.lit("TCAG"), F.substr(codon, F.lit(k), F.lit(1))) for k in (1, 2, 3)]
    at = (place[0] - 1) * 16 + (place[1] - 1) * 4 + place[2]
    return F.when((place[0] > 0) & (place[1] > 0) & (place[2] > 0) & (F.length(codon) == 3), F.substr(F.lit(STANDARD_CODE), at, F.lit(1))).otherwise(F.lit("X"))


_RESIDUES = {"".join(digits): a for digits, a in zip(product("1234", repeat=3), STANDARD_CODE, strict=True)}
#: Amino acids by three digits, one a base: T, C, A, G are 1 to 4, any other character is 0.
_BY_DIGITS = [_RESIDUES.get(f"{k:03}", "X") for k in range(445)]


def translate(seq: str | Column) -> Column:
    """Amino acids of whole codons; ``*`` for stops, X for gaps and ambiguous bases; a partial codon is dropped.

    One pass of an expression cuts the codons: a substring at a place would walk there from the start.
    """
    c = F.upper(col(seq))
    digits = F.translate(F.regexp_replace(c, "[^TCAG]", "0"), "TCAG", "1234")
    table = F.array(*(F.lit(a) for a in _BY_DIGITS))
    codons = F.transform(F.regexp_extract_all(digits, F.lit("([0-4]{3})"), F.lit(1)), lambda x: F.get(table, x.cast("int")))
    return F.when(c.isNotNull(), F.concat_ws("", codons))


def translate_short(seq: str | Column) -> Column:
    """As :func:`translate`, without a loop for up to two codons: a variant's window is seldom more."""
    c = F.upper(col(seq))
    n = F.floor(F.length(c) / 3).cast("int")
    one, two = _residue(F.substring(c, 1, 3)), _residue(F.substring(c, 4, 3))
    return F.when(n == 1, one).when(n == 2, F.concat(one, two)).otherwise(translate(c))


def start_window(transcript: str | Column, offset: str | Column, up: int, down: int) -> Column:
    """Up to ``up`` bases before the start codon's A and ``down`` from it, cut at the transcript's 5' end."""
    at = col(offset)
    lo = F.greatest(at - up, F.lit(0))
    return F.substr(col(transcript), lo + 1, at + down - lo)


def start_context(chromosome: str | Column, position: str | Column, strand: str | Column) -> Column:
    """13 bases around a start codon: 9 before the A (1-based ``position``) and 4 from it; null at an end."""
    c, p, minus = col(chromosome), col(position), col(strand) == "-"
    lo = F.when(minus, p - 3).otherwise(p - 9)
    piece = F.substr(c, lo, F.lit(13))
    return F.when((lo >= 1) & (F.length(piece) == 13), F.when(minus, reverse_complement(piece)).otherwise(F.upper(piece)))


def start_distance(context: str | Column, weights: str = "full", consensus: str = START_CONSENSUS) -> Column:
    """Weighted mismatches with an ambiguous consensus: a base matches if the codes share one."""
    bits = literal_map(AMBIGUITY)
    want = F.array(*(F.lit(AMBIGUITY[b]) for b in consensus))
    weight = F.array(*(F.lit(w) for w in START_WEIGHTS[weights]))
    mask = F.transform(letters(F.upper(col(context))), lambda b: F.coalesce(F.element_at(bits, b), F.lit(0)))
    miss = F.zip_with(F.zip_with(mask, want, lambda a, b: (a.bitwiseAND(b) == 0).cast("double")), weight, lambda m, w: m * w)
    return F.when(F.length(col(context)) == len(consensus), F.aggregate(miss, F.lit(0.0), lambda a, x: a + x))


def letter_fraction(seq: str | Column, members: str) -> Column:
    """Share of the letters that are in a set; null for an empty sequence (SC09)."""
    c = col(seq)
    n = F.length(c)
    return F.when(n > 0, (n - F.length(F.regexp_replace(c, f"[{members}]", ""))) / n)


def gc_fraction(seq: str | Column) -> Column:
    return letter_fraction(F.upper(col(seq)), "GC")


def start_codon_effect(ref: str | Column, alt: str | Column) -> dict[str, Column]:
    """What a change does to a start codon (VC02): the rule is not symmetric."""
    r, a = F.upper(F.substring(col(ref), 1, 3)), F.upper(F.substring(col(alt), 1, 3))
    starts = [F.lit(c) for c in START_CODONS]
    lost = (r != a) & ((r == "ATG") | (r.isin(*starts) & ~a.isin(*starts)))
    note = (
        F.when(r == a, "").when(r == "ATG", "annotated start lost").when(~r.isin(*starts), "annotated start does not initiate")
        .when(~a.isin(*starts), "weak start lost").when(a == "ATG", "start strengthened").otherwise("still a weak start")
    )
    return {"consequence": F.when(lost, "start_lost"), "note": note}


# --- proteins (SC07-SC15)


def mean_scale(seq: str | Column, scale: dict[str, float]) -> Column:
    """Mean over the letters that the scale has (SC08)."""
    table = literal_map(scale)
    values = F.filter(F.transform(letters(F.upper(col(seq))), lambda x: F.element_at(table, x)), lambda v: v.isNotNull())
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / F.size(values))


def _count(seq: Column, letter: str) -> Column:
    return F.length(seq) - F.length(F.replace(seq, F.lit(letter), F.lit("")))


def net_charge(seq: str | Column, ph: str | Column | float = 7.0) -> Column:
    c = F.upper(col(seq))
    p = F.lit(ph) if isinstance(ph, float) else col(ph)
    total = 1 / (1 + F.pow(F.lit(10.0), p - PK["N_term"])) - 1 / (1 + F.pow(F.lit(10.0), PK["C_term"] - p))
    for aa in "KRH":
        total = total + _count(c, aa) / (1 + F.pow(F.lit(10.0), p - PK[aa]))
    for aa in "DECY":
        total = total - _count(c, aa) / (1 + F.pow(F.lit(10.0), PK[aa] - p))
    return F.when(F.length(c) > 0, total)


def isoelectric_point(seq: str | Column) -> Column:
    """Bisection of 0..14 to a width of at most 0.01, rounded to 4 places (SC07)."""
    c = col(seq)

    def halve(s: Column, _: Column) -> Column:
        mid = (s.lo + s.hi) / 2
        positive = net_charge(c, mid) > 0
        return F.struct(F.when(positive, mid).otherwise(s.lo).alias("lo"), F.when(positive, s.hi).otherwise(mid).alias("hi"))

    # 14 / 2^11 is the first width below 0.01
    end = F.aggregate(F.sequence(F.lit(1), F.lit(11)), F.struct(F.lit(0.0).alias("lo"), F.lit(14.0).alias("hi")), halve)
    return F.when(F.length(c) > 0, F.round((end.lo + end.hi) / 2, 4))


def instability(seq: str | Column, weights: Column) -> Column:
    """10/L times the summed dipeptide weights (SC10); ``weights``: a map column, as broadcast by the caller."""
    c = F.upper(col(seq))
    pairs = F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.coalesce(F.element_at(weights, F.substr(c, i, F.lit(2))), F.lit(1.0)))
    return F.when(F.length(c) > 1, F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x) * 10 / F.length(c))


def entropy(seq: str | Column) -> Column:
    """Shannon entropy of the letters, in bits (SC11)."""
    c = col(seq)
    n = F.length(c)
    parts = F.transform(F.array_distinct(letters(c)), lambda x: (n - F.length(F.replace(c, x, F.lit("")))) / n)
    return F.when(n > 0, F.aggregate(parts, F.lit(0.0), lambda a, p: a - p * F.log2(p)))


def windows(seq: str | Column, size: int) -> Column:
    c = col(seq)
    return F.when(F.length(c) >= size, F.transform(F.sequence(F.lit(1), F.length(c) - size + 1), lambda i: F.substr(c, i, F.lit(size)))).otherwise(
        F.array().cast("array<string>")
    )


def complexity(seq: str | Column, letters_in_use: int = 20) -> Column:
    return entropy(seq) / F.log2(F.lit(float(letters_in_use)))


def window_entropy(seq: str | Column, size: int = 20) -> Column:
    """Mean entropy of the sliding windows; the whole sequence if it is shorter."""
    w = windows(seq, size)
    return F.when(F.size(w) > 0, F.aggregate(F.transform(w, entropy), F.lit(0.0), lambda a, x: a + x) / F.size(w)).otherwise(entropy(seq))


def low_complexity_fraction(seq: str | Column, size: int = 12, cutoff: float = 2.2) -> Column:
    w = windows(seq, size)
    return F.when(F.size(w) > 0, F.size(F.filter(F.transform(w, entropy), lambda e: e < cutoff)) / F.size(w))


def longest_run(seq: str | Column) -> Column:
    """Length of the longest run of one letter (SC12)."""
    end = F.aggregate(
        letters(seq), F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best")),
        lambda s, x: F.struct(
            x.alias("last"), F.when(x == s.last, s.run + 1).otherwise(1).alias("run"),
            F.greatest(s.best, F.when(x == s.last, s.run + 1).otherwise(1)).alias("best"),
        ),
    )
    return F.when(col(seq).isNotNull(), end.best)


def n_terminal_diversity(seq: str | Column, size: int = 20) -> Column:
    head = F.substring(col(seq), 1, size)
    return F.when(F.length(head) > 0, F.size(F.array_distinct(letters(head))) / F.length(head))


def pair_density(seq: str | Column, pair: str) -> Column:
    """Non-overlapping occurrences of a pattern per 100 letters."""
    c = col(seq)
    return F.when(F.length(c) > 0, F.regexp_count(c, F.lit(pair)) * 100 / F.length(c))


def motif_counts(seq: str | Column, motifs: dict[str, str] | None = None) -> dict[str, Column]:
    return {name: F.regexp_count(col(seq), F.lit(p)) for name, p in (motifs or MOTIFS).items()}


def motif_hits(seq: str | Column, pattern: str) -> Column:
    """Non-overlapping hits as ``array<struct<pos,end,match>>``, 0-based and half-open (SC13).

    The text between matches is what a split leaves, so positions are running lengths.
    """
    c = col(seq)
    found = F.regexp_extract_all(c, F.lit(f"({pattern})"), F.lit(1))
    gaps = F.split(c, pattern)
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<pos:int,end:int,match:string>>").alias("hits"))

    def step(s: Column, i: Column) -> Column:
        pos, m = s.at + F.length(F.get(gaps, i)), F.get(found, i)
        hit = F.struct(pos.alias("pos"), (pos + F.length(m)).alias("end"), m.alias("match"))
        return F.struct((pos + F.length(m)).alias("at"), F.concat(s.hits, F.array(hit)).alias("hits"))

    return F.when(F.size(found) > 0, F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), zero, step).hits).otherwise(
        F.array().cast("array<struct<pos:int,end:int,match:string>>")
    )


def tryptic_digest(seq: str | Column, missed: int = 1, shortest: int = 7, longest: int = 30) -> Column:
    """Distinct ``(peptide, start)``: cuts after K or R unless before P, up to ``missed`` cuts left out (SC14)."""
    pieces = F.split(col(seq), "(?<=[KR])(?!P)")
    n = F.size(pieces)
    starts = F.aggregate(pieces, F.array(F.lit(0)), lambda a, p: F.concat(a, F.array(F.element_at(a, -1) + F.length(p))))

    def joined(k: int) -> Column:
        places = F.filter(F.sequence(F.lit(1), n), lambda i: i + k <= n)
        return F.transform(places, lambda i: F.struct(F.concat_ws("", F.slice(pieces, i, k + 1)).alias("peptide"), F.element_at(starts, i).alias("start")))

    every = [joined(k) for k in range(missed + 1)]
    return F.array_distinct(F.filter(F.concat(*every), lambda x: F.length(x.peptide).between(shortest, longest)))


def peptides_outside(peptides: str | Column, other: str | Column) -> Column:
    """Peptides that are no part of another protein (SC15)."""
    o = F.coalesce(col(other), F.lit(""))
    return F.filter(col(peptides), lambda x: F.instr(o, x.peptide) == 0)


def differential_region(kind: str | Column, isoform: str | Column, canonical: str | Column, tail: int = 50, share: float = 0.95) -> Column:
    """``struct<space,start,end,confidence>`` of the isoform-unique residues (SC22).

    Extended and truncated proteins: exact suffix; for truncations a replaced
    initiator; the shorter one's first 20 residues found in the longer with a
    tail that agrees; else the difference in length.  Other types: the whole ORF.
    """
    k, iso, can = col(kind), F.rtrim(col(isoform), F.lit("*")), F.rtrim(col(canonical), F.lit("*"))
    truncated = k == "Truncated"
    long, short = F.when(truncated, can).otherwise(iso), F.when(truncated, iso).otherwise(can)
    gap = F.length(long) - F.length(short)
    exact = (gap > 0) & (F.length(short) > 0) & long.endswith(short)
    rest = F.substring(short, 2, 1 << 30)
    initiator = truncated & (F.length(iso) > 1) & iso.startswith("M") & (gap >= 0) & long.endswith(rest)
    head = F.least(F.lit(20), F.length(short))
    at = F.instr(long, F.substr(short, F.lit(1), head)) - 1
    x, y = F.substr(long, at + head + 1), F.substr(short, head + 1)
    n = F.least(F.length(x), F.length(y))
    m = F.least(n, F.lit(4 * tail))
    same = F.aggregate(F.sequence(F.lit(1), F.greatest(m, F.lit(1))), F.lit(0), lambda a, i: a + (F.substr(x, i, F.lit(1)) == F.substr(y, i, F.lit(1))).cast("int"))
    agrees = (n > 0) & F.when(n < tail, F.substr(x, F.lit(1), n) == F.substr(y, F.lit(1), n)).otherwise(same / m >= share)
    verified = (head >= 3) & (at >= 0) & agrees
    space = F.when(truncated, "canonical").otherwise("isoform")

    def region(end: Column, confidence: str) -> Column:
        return F.struct(space.alias("space"), F.lit(0).alias("start"), end.cast("int").alias("end"), F.lit(confidence).alias("confidence"))

    return (
        F.when(~k.isin("Extended", "Truncated"), region(F.length(iso), "whole_orf"))
        .when(exact, region(gap, "exact"))
        .when(initiator, region(gap, "initiator"))
        .when(verified, region(at, "verified"))
        .when(gap > 0, region(gap, "length_only"))
        .when(iso.isNotNull() & can.isNotNull(), region(F.length(long), "whole"))
    )


def orf_from_start(transcript: str | Column, offset: str | Column) -> dict[str, Column]:
    """The ORF that an external start opens on a spliced transcript (SC26), or the reason why there is none."""
    t, at = F.upper(col(transcript)), col(offset)
    codon = F.substr(t, at + 1, F.lit(3))
    protein = translate(F.substr(t, at + 1))
    stop = F.instr(protein, "*")
    reason = (
        F.when(t.isNull(), "no_transcript").when(at.isNull() | (at < 0) | (at + 3 > F.length(t)), "outside_transcript")
        .when(~codon.isin(*START_CODONS), "not_a_start").when(stop == 0, "no_stop")
    )
    found = F.when(reason.isNull(), F.concat(F.lit("M"), F.substr(protein, F.lit(2), stop - 2)))
    return {"codon": F.when(reason.isNull(), codon), "protein": found, "aa_len": F.length(found), "rejected": reason}
