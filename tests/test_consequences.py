"""Consequences on spliced models of both strands, against a base-by-base walk."""

import random

from pyspark.sql import functions as F

from orfloom.functions.sequence import STANDARD_CODE, START_CODONS
from orfloom.operators import variants

TURNED = str.maketrans("ACGT", "TGCA")
CODE = {a + b + c: STANDARD_CODE[16 * i + 4 * j + k] for i, a in enumerate("TCAG") for j, b in enumerate("TCAG") for k, c in enumerate("TCAG")}
EXONS = [[(10, 17), (25, 31), (40, 51)], [(5, 29)], [(3, 9), (12, 18), (20, 26), (30, 36)]]


def translated(s):
    return "".join(CODE.get(s[i : i + 3], "X") for i in range(0, len(s) - len(s) % 3, 3))


def start_lost(ref, alt):
    return ref != alt and (ref == "ATG" or (ref in START_CODONS and alt not in START_CODONS))


def walk(exons, strand, cds, pos, ref, alt):
    """(consequence, residue, ref_aa, alt_aa) by a map from every coding position to its offset."""
    order = [p for a, b in exons for p in range(a + 1, b + 1)]
    if strand == "-":
        order.reverse()
    offset = {p: i for i, p in enumerate(order)}
    same = 0
    while same < min(len(ref), len(alt)) and ref[same] == alt[same]:
        same += 1
    ref, alt, first = ref[same:], alt[same:], pos + same
    delta = len(alt) - len(ref)
    indel = None if delta == 0 else "frameshift" if delta % 3 else "inframe_insertion" if delta > 0 else "inframe_deletion"
    if not ref and alt:
        sides = [offset.get(first - 1), offset.get(first)]
        offsets = [min(sides) + 1] if None not in sides else [None]
        span = [first]
    else:
        span = list(range(first, first + max(len(ref), 1)))
        offsets = [offset.get(p) for p in span]
    mapped = [o for o in offsets if o is not None]
    if not mapped:
        return "intronic", None, None, None
    if len(mapped) < len(offsets):
        coding, other = [p for p in span if p in offset], [p for p in span if p not in offset]
        intronic = [p for p in other if min(offset) < p < max(offset)]
        if intronic:
            below, above = any(p < min(coding) for p in intronic), any(p > max(coding) for p in intronic)
            up, down = (below, above) if strand == "+" else (above, below)
            return ("splice_donor" if down and not up else "splice_acceptor"), min(mapped) // 3, None, None
        if min(mapped) < 3 and start_lost(cds[:3], "NNN"):
            return "start_lost", min(mapped) // 3, None, None
        return indel or "intronic", min(mapped) // 3, None, None
    at = min(mapped)
    codon, last = at // 3, (at + max(len(ref), 1) - 1) // 3
    if (last + 1) * 3 > len(cds):
        return indel or "past_the_end", codon, None, None
    if strand == "-":
        ref, alt = ref[::-1].translate(TURNED), alt[::-1].translate(TURNED)
    mutant = cds[:at] + alt + cds[at + len(ref) :]
    whole, changed = translated(cds), translated(mutant)
    count = last - codon + 1
    if delta == 0:
        old, new = whole[codon : codon + count], changed[codon : codon + count]
    elif delta % 3:
        old, new = whole[codon : codon + 1], ""
    elif delta < 0:
        old, new = whole[codon : codon - delta // 3], ""
    else:
        stop = changed[codon : codon + delta // 3].partition("*")
        old, new = "", stop[0] + stop[1]
    if cds[at : at + len(ref)] != ref:
        return "reference_mismatch", codon, old, new
    if codon == 0 and start_lost(cds[:3], mutant[:3]):
        return "start_lost", codon, old, new
    if delta:
        return indel, codon, old, new
    return ("synonymous" if old == new else "stop_lost" if "*" in old else "stop_gained" if "*" in new else "missense"), codon, old, new


def test_consequences_equal_the_walk(spark):
    rng = random.Random(11)
    rows, want = [], {}
    for i in range(900):
        chrom = "".join(rng.choice("ACGT") for _ in range(60))
        exons, strand = rng.choice(EXONS), rng.choice("+-")
        if rng.random() < 0.7:  # a start codon, in the first three coding bases
            order = [p for a, b in exons for p in range(a, b)]
            base = dict(zip(order[:3], "ATG", strict=True)) if strand == "+" else dict(zip(order[-3:], "CAT", strict=True))
            chrom = "".join(base.get(k, c) for k, c in enumerate(chrom))
        cds = "".join(chrom[a:b] for a, b in exons)
        cds = cds[::-1].translate(TURNED) if strand == "-" else cds
        pos, n = rng.randint(2, 55), rng.choice([1, 1, 1, 2, 3, 4, 6, 9, 14])
        ref = chrom[pos - 1 : pos - 1 + n]
        if rng.random() < 0.05:
            ref = "".join(rng.choice("ACGT") for _ in ref)
        alt = rng.choice([rng.choice("ACGT"), ref[0], ref + rng.choice(["A", "TAA", "CCC", "GATTAC"]), "".join(rng.choice("ACGT") for _ in ref), ref[0] + "TAG"])
        if alt == ref:
            continue
        rows.append((i, "chr1", strand, [*exons], cds, pos, ref, alt))
        want[i] = walk(exons, strand, cds, pos, ref, alt)
    kind = "i int, chrom string, strand string, exons array<struct<start:bigint,end:bigint>>, cds string, pos bigint, ref string, alt string"
    called = variants.classify(spark.createDataFrame(rows, kind))
    got = {r["i"]: (r["consequence"], r["residue"], r["ref_aa"], r["alt_aa"]) for r in called.collect()}
    assert {i: (got[i], rows[[r[0] for r in rows].index(i)]) for i in want if got[i] != want[i]} == {}
    assert len({w[0] for w in want.values()}) >= 12


def test_notation_and_frame(spark):
    rows = [("missense", 4, "A", "V"), ("missense", 4, "AR", "VK"), ("stop_gained", 0, "Q", "*"), ("stop_lost", 8, "*", "R"), ("frameshift", 9, "L", ""), ("inframe_deletion", 2, "KR", ""), ("inframe_insertion", 2, "", "GG"), ("synonymous", 1, "S", "S"), ("start_lost", 0, "L", "P"), ("splice_donor", 3, None, None), ("missense", 0, "X", "A")]
    df = spark.createDataFrame(rows, "what string, residue int, old string, new string")
    got = [r[0] for r in df.select(variants.notation("what", "residue", "old", "new")).collect()]
    assert got == ["p.Ala5Val", "p.Ala5_Arg6delinsValLys", "p.Gln1Ter", "p.Ter9Arg", None, None, None, "p.Ser2=", "p.Leu1?", None, "p.X1Ala"]
    framed = [r[0] for r in df.select(variants.notation("what", "residue", "old", "new", F.lit("isoform"))).limit(1).collect()]
    assert framed == ["p.Ala5Val · isoform frame"]
