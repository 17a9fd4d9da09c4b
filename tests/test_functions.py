"""Scalar, interval and sequence functions on small rows."""

import itertools
import math
import random
import time

import pytest
from pyspark.sql import functions as F

from orfloom.functions import intervals as iv
from orfloom.functions import scalars as sc
from orfloom.functions import sequence as sq


def one(spark, **cols):
    row = spark.range(1).select(*(c.alias(k) for k, c in cols.items())).first()
    return row.asDict(recursive=True)


def test_locus(spark):
    p = sc.parse_locus(F.lit("chr:1:10-20:-"))
    r = one(spark, **p, site=sc.init_site(F.lit("chr1:10-20:+"), F.lit("ATG")), bad=sc.parse_locus(F.lit("x"))["lo"])
    assert (r["chrom"], r["lo"], r["gstart"], r["gend"], r["site"], r["bad"]) == ("chr:1", 10, 20, 10, "chr1:10:+:ATG", None)


def test_types_and_chromosomes(spark):
    r = one(
        spark, a=sc.simple_type(F.lit("5'UTR:Known")), b=sc.orf_type(F.lit("Novel:CDSFrameOverlap")), c=sc.orf_type(F.lit("Internal")), d=sc.orf_type(F.lit(None).cast("string")),
        m=sc.normalize_chrom(F.lit("MT")), n=sc.normalize_chrom(F.lit("chr7")), o=sc.normalize_chrom(F.lit("X")),
    )
    assert list(r.values()) == ["uORF", "uoORF", "InternalOutOfFrame", None, "chrM", "chr7", "chrX"]


def test_tri_state(spark):
    no, yes, null = F.lit(False), F.lit(True), F.lit(None).cast("boolean")
    r = one(spark, a=sc.any_true(null, null), b=sc.any_true(null, no), c=sc.any_true(no, yes, null), d=sc.strict_least(F.lit(1), F.lit(None)), e=sc.guarded_ratio(F.lit(1), F.lit(0)))
    assert list(r.values()) == [None, False, True, None, None]


def test_significance(spark):
    r = one(spark, a=sc.significance_family(F.lit("Conflicting interpretations of pathogenicity")), b=sc.significance_family(F.lit("Likely pathogenic")), c=sc.significance_rank(F.lit("benign")), d=sc.protein_position(F.lit("p.Ala12Val")))
    assert list(r.values()) == ["conflicting", "pathogenic", 1, 11]


def test_normal_quantile(spark):
    ps = [0.001, 0.025, 0.3, 0.5, 0.9, 0.999999]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in ps], "p double").select(sc.normal_quantile("p")).collect()]
    for p, x in zip(ps, got, strict=True):
        assert 0.5 * math.erfc(-x / math.sqrt(2)) == pytest.approx(p, rel=1e-7)


def test_intervals_match_sets(spark):
    rng = random.Random(1)

    def some():
        return [(a, a + rng.randint(0, 8)) for a in (rng.randint(0, 40) for _ in range(rng.randint(0, 5)))]

    rows = [(i, some(), some()) for i in range(200)]
    df = spark.createDataFrame(rows, f"i int, a {iv.INTERVALS}, b {iv.INTERVALS}")
    df = df.withColumn("x", iv.normalize("a")).withColumn("y", iv.normalize("b"))
    out = df.select("i", "x", iv.total_length("x").alias("n"), iv.intersect("x", "y").alias("both"), iv.difference("x", "y").alias("only")).collect()

    def bases(xs):
        return {p for a, b in xs for p in range(a, b)}

    for (_, a, b), r in zip(rows, sorted(out, key=lambda r: r["i"]), strict=True):
        assert bases(r["x"]) == bases(a) and r["n"] == len(bases(a))
        assert all(p[1] < q[0] for p, q in zip(r["x"], r["x"][1:], strict=False))
        assert bases(r["both"]) == bases(a) & bases(b) and bases(r["only"]) == bases(a) - bases(b)


def test_coding_offset_and_walk(spark):
    df = spark.createDataFrame([([(10, 13), (20, 25)], s, p) for s in "+-" for p in (10, 11, 13, 14, 21, 25, 26)], f"e {iv.INTERVALS}, s string, p int")
    got = [r[0] for r in df.select(iv.coding_offset("e", "p", "s")).collect()]
    assert got == [None, 0, 2, None, 3, 7, None, None, 7, 5, None, 4, 0, None]
    walk = spark.createDataFrame([([(10, 13), (20, 25)], 11, 4, "+"), ([(10, 13), (20, 25)], 23, 5, "-")], f"e {iv.INTERVALS}, a int, n int, s string")
    assert [[tuple(x) for x in r[0]] for r in walk.select(iv.take_coding("e", "a", "n", "s")).collect()] == [[(11, 13), (20, 22)], [(11, 13), (20, 23)]]


def test_unique_shared(spark):
    df = spark.createDataFrame([("Truncated", [(5, 10)], [(0, 10)]), ("Extended", [(0, 10)], [(5, 10)]), ("uORF", [(0, 6)], [(3, 9)])], f"k string, i {iv.INTERVALS}, c {iv.INTERVALS}")
    u = iv.unique_shared("k", "i", "c")
    got = [([tuple(x) for x in r[0]], [tuple(x) for x in r[1]]) for r in df.select(u["unique"], u["shared"]).collect()]
    assert got == [([(0, 5)], [(5, 10)]), ([(0, 5)], [(5, 10)]), ([(0, 6)], [])]


def test_changed_span(spark):
    c = iv.changed_span(F.lit(100), F.lit("ACT"), F.lit("ACGT"))
    assert one(spark, **c) == {"first": 102, "ref": "T", "alt": "GT", "shared": 2}


def test_sequences(spark):
    r = one(
        spark, rc=sq.reverse_complement(F.lit("aACGN")), tr=sq.translate(F.lit("ATGTAAGNNAT")), empty=sq.translate(F.lit("A")), gc=sq.gc_fraction(F.lit("GGAT")),
        kozak=sq.start_distance(F.lit("GCCGCCACCATGG")), miss=sq.start_distance(F.lit("GCCGCCTCCATGA"), "major"), start=sq.start_codon_effect(F.lit("ATG"), F.lit("CTG"))["consequence"],
        weak=sq.start_codon_effect(F.lit("CTG"), F.lit("ATG"))["note"], ent=sq.entropy(F.lit("AABB")), run=sq.longest_run(F.lit("ABBBA")), hyd=sq.mean_scale(F.lit("AIX"), sq.HYDROPATHY),
    )
    assert (r["rc"], r["tr"], r["empty"], r["gc"], r["kozak"], r["miss"]) == ("NCGTT", "M*X", "", 0.5, 0.0, 2.0)
    assert (r["start"], r["weak"], r["ent"], r["run"]) == ("start_lost", "start strengthened", 1.0, 3) and r["hyd"] == pytest.approx(3.15)


def test_charge_and_pi(spark):
    r = one(spark, q=sq.net_charge(F.lit("KKD"), 7.0), pi=sq.isoelectric_point(F.lit("KKD")))
    at_pi = one(spark, q=sq.net_charge(F.lit("KKD"), float(r["pi"])))["q"]
    assert r["q"] > 0.5 and abs(at_pi) < 0.02


def test_motifs_and_digest(spark):
    r = one(spark, h=sq.motif_hits(F.lit("ASPTPP"), "[ST]P"), d=sq.tryptic_digest(F.lit("MAAAAAAKPGGGGGGRLLLLLLLK")))
    assert [(x["pos"], x["end"], x["match"]) for x in r["h"]] == [(1, 3, "SP"), (3, 5, "TP")]
    assert {(x["peptide"], x["start"]) for x in r["d"]} == {("MAAAAAAKPGGGGGGR", 0), ("LLLLLLLK", 16), ("MAAAAAAKPGGGGGGRLLLLLLLK", 0)}


def test_region(spark):
    can = "MABCDEFGHIKLMNPQRSTV"
    r = one(
        spark, ext=sq.differential_region(F.lit("Extended"), F.lit("QQ" + can), F.lit(can)), cut=sq.differential_region(F.lit("Truncated"), F.lit(can[5:]), F.lit(can)),
        met=sq.differential_region(F.lit("Truncated"), F.lit("M" + can[6:]), F.lit(can)), orf=sq.differential_region(F.lit("uORF"), F.lit("MAB"), F.lit(can)),
    )
    assert [(x["space"], x["end"], x["confidence"]) for x in r.values()] == [("isoform", 2, "exact"), ("canonical", 5, "exact"), ("canonical", 5, "initiator"), ("isoform", 3, "whole_orf")]


def test_numbers(spark):
    assert sorted(one(spark, n=sc.numbers_in(F.lit("1,200 of 35% is +3.5, 3.5")))["n"]) == ["1200", "3.5", "35"]


def test_long_sequences_are_translated_in_one_pass(spark):
    rng = random.Random(11)
    seq = "".join(rng.choice("acgtTCAGNnR-1é𝄞") if k % 7 == 0 else rng.choice("TCAG") for k in range(200_001))
    code = {"".join(b): a for b, a in zip(itertools.product("TCAG", repeat=3), sq.STANDARD_CODE, strict=True)}
    want = "".join(code.get(seq[i : i + 3].upper(), "X") for i in range(0, len(seq) - 2, 3))
    df = spark.createDataFrame([(seq,), ("",), (None,)], "s string")
    began = time.monotonic()
    got = [r["p"] for r in df.select(sq.translate("s").alias("p")).collect()]
    assert got == [want, "", None]
    assert time.monotonic() - began < 60  # a walk from the start for each codon takes minutes
