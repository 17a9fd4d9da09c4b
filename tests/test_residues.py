"""Per-residue readers, reading frames and assembly."""

import pytest
from pyspark.sql import functions as F

from orfloom.functions import sequence as sq
from orfloom.operators import residues

SPAN = "array<struct<start:bigint,end:bigint>>"


def test_region_scores(spark):
    df = spark.createDataFrame([("a", [0.0, -1.0, 4.0, 2.0], 4, 0, 2), ("b", None, 4, 0, 2), ("c", [1.0], 4, 0, 2), ("d", [1.0], 1, None, None)], "k string, s array<double>, n int, a int, b int")
    got = {r["k"]: (r["status"], r["unique_mean"], r["shared_mean"], r["difference"], r["n_tolerant"]) for r in residues.region_scores(df, "s", "n", "a", "b").collect()}
    assert got == {"a": ("ok", -0.5, 3.0, -3.5, 1), "b": ("no_cache", *[None] * 4), "c": ("length_mismatch", *[None] * 4), "d": ("no_diff_region", *[None] * 4)}


def test_windows_and_blocks(spark):
    df = spark.createDataFrame([("a", [float(i) for i in range(10)])], "k string, v array<double>")
    got = residues.window_stats(df, ["k"], "v", F.lit(2), F.lit(8), cap=3).orderBy("residue").collect()
    assert [(r["residue"], r["n"], r["mean"]) for r in got] == [(2, 6, 4.5), (3, 6, 4.5), (4, 6, 4.5)]
    m = spark.createDataFrame([("a", i, j, float(10 * i + j), 0, 1) for i in range(2) for j in range(2)], "k string, i int, j int, v double, s int, e int")
    assert tuple(residues.matrix_blocks(m, ["k"], "i", "j", "v", "s", "e").first()) == ("a", 0.0, 11.0, 5.5)


def aligned(spark, **pairs):
    rows = [(k, i, a, b) for k, (x, y) in pairs.items() for i, (a, b) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "k string, i int, a string, b string")


def test_frame_integrity(spark):
    ref = "ATGAAATGA"
    df = aligned(spark, same=(ref, ref), stop=(ref, "ATGTAATGA"), shift=(ref, "ATGA-ATGA"), none=(ref, "-" * 9), ins=("ATG---AAATGA", "CTGCCCAAATGA"))
    got = {r["k"]: r for r in residues.frame_integrity(df, ["k"], "i", "a", "b").collect()}
    assert {k: (r["intact"], r["premature_stop"], r["frameshift"], r["start_intact"]) for k, r in got.items()} == {
        "same": (True, False, False, True), "stop": (False, True, False, True), "shift": (False, False, True, True), "none": (False, False, False, False), "ins": (True, False, False, False),
    }
    assert got["none"]["identity"] is None and got["same"]["identity"] == 1.0 and got["ins"]["identity"] == pytest.approx(2 / 3)


def test_orf_from_start(spark):
    df = spark.createDataFrame([("CCATGAAATAGC", 2), ("CCATGAAATAGC", 3), ("ATGAAA", 0), (None, 0), ("ATG", 5)], "t string, o int")
    c = sq.orf_from_start("t", "o")
    assert [tuple(r) for r in df.select(c["protein"], c["rejected"]).collect()] == [("MK", None), (None, "not_a_start"), (None, "no_stop"), (None, "no_transcript"), (None, "outside_transcript")]


def test_assembly(spark):
    can = "MAAKKKKKKK"
    rows = [("G", "T", "chr1:101-131:+", "ATG", "Annotated", can), ("G", "T", "chr1:110-131:+", "CTG", "Truncated", "M" + can[4:])]
    df = spark.createDataFrame(rows, "symbol string, tid string, genome_pos string, codon string, tis_type string, protein string")
    sk = spark.createDataFrame([("T", [(100, 140)])], f"transcript_id string, exons {SPAN}")
    r = residues.assemble_sites(df, sk).first()
    assert (r["tis_id"], r["orf_type"], r["region"]["end"]) == ("chr1:110:+:CTG:T", "Truncated", 3)
    assert ([tuple(x) for x in r["unique"]], [tuple(x) for x in r["shared"]]) == ([(100, 109)], [(109, 130)])
    with pytest.raises(ValueError, match="without an annotated row"):
        residues.assemble_sites(df.where("tis_type <> 'Annotated'"), sk)
