"""Operators whose queries cannot show every rule: suppression, variants, readers, writers, streams."""

import random

from pyspark.sql import functions as F

from orfloom.operators import combine, evidence, filters, profile, ranges, stats, variants
from orfloom.sources import readers, writers
from orfloom.streaming.jobs import stream_quota, stream_scan


def test_suppression_is_the_greedy_loop(spark):
    rng = random.Random(3)
    rows = [(g, i, rng.randint(0, 120), float(rng.randint(0, 5)), rng.random() < 0.1) for g in range(60) for i in range(rng.randint(1, 25))]
    df = spark.createDataFrame(rows, "g int, i int, p int, s double, a boolean")
    got = {(r["g"], r["i"]) for r in filters.suppress_within(df, ["g"], "p", "s", "i", 10, F.col("a")).collect()}
    want = set()
    for g in range(60):
        kept = []
        for _, i, p, s, a in sorted((r for r in rows if r[0] == g), key=lambda r: (not r[4], -r[3], r[2], r[1])):
            if not any(k <= p <= k + 10 for k in kept):
                kept.append(p)
                want.add((g, i))
    assert got == want


def test_suppression_keeps_rows_without_position_and_one_of_a_position(spark):
    rows = [(None, 1, None, 1.0), (None, 2, 5, 1.0), ("a", 3, 5, None), ("a", 4, 5, 2.0), ("a", 5, 5, 2.0), ("a", 6, None, 0.0), ("a", 7, 15, 9.0), ("a", 8, 16, 1.0)]
    df = spark.createDataFrame(rows, "g string, i int, p int, s double")
    assert sorted(r["i"] for r in filters.suppress_within(df, ["g"], "p", "s", "i", 10).collect()) == [1, 2, 4, 6, 7]
    assert filters.suppress_within(df.limit(0), ["g"], "p", "s", "i", 10).count() == 0
    chain = spark.createDataFrame([(0, i, 5 * i, float(-i)) for i in range(100)], "g int, i int, p int, s double")  # a chain that many rounds decide
    assert sorted(r["i"] for r in filters.suppress_within(chain, ["g"], "p", "s", "i", 5).collect()) == list(range(0, 100, 2))


def test_quota_picks_fall_through_to_the_next_group(spark):
    rng = random.Random(6)
    rows = [(i, rng.randint(0, 9), rng.choice("xyz"), float(rng.randint(0, 40))) for i in range(200)] + [(900, 1, None, 99.0), (901, None, "x", 99.0)]
    df = spark.createDataFrame(rows, "i int, g int, s string, v double")
    got = {(r["i"], r["rank"]) for r in stats.quota_picks(df, "i", "g", "s", "v", 3).collect()}
    groups, filled, want = set(), {}, set()
    for i, g, s, _ in sorted(rows, key=lambda r: (-r[3], r[0])):
        if g is not None and s is not None and g not in groups and filled.get(s, 0) < 3:
            groups.add(g)
            filled[s] = filled.get(s, 0) + 1
            want.add((i, filled[s]))
    assert got == want and len(want) == 9
    assert stats.quota_picks(df.limit(0), "i", "g", "s", "v", 3).count() == 0


def test_range_join_is_the_inequality_join(spark):
    rng = random.Random(4)
    a = [(i, x, x + rng.randint(0, 30)) for i in range(80) for x in [rng.randint(-50, 200)]]
    b = [(i, x, x + rng.randint(0, 90)) for i in range(80) for x in [rng.randint(-50, 200)]]
    got = ranges.range_join(spark.createDataFrame(a, "i int, s int, e int"), spark.createDataFrame(b, "j int, t int, f int"), 16, "s", "e", "t", "f").select("i", "j").collect()
    assert sorted(map(tuple, got)) == sorted((x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2])


def test_reasons_and_nulls(spark):
    df = spark.createDataFrame([(1, 5.0, True), (2, None, False), (3, 1.0, True)], "i int, p double, r boolean")
    out = filters.filter_with_reasons(df, [("NotReferenceTranscript", F.col("r")), ("NotSignificant", F.col("p") > 2)])
    assert {r["i"]: r["drop_reason"] for r in out.collect()} == {1: None, 2: "NotReferenceTranscript|NotSignificant", 3: "NotSignificant"}


def test_criteria_are_tri_state(spark):
    names = "primate_identity mammal_identity phylop_mean max_efficiency constraint_delta depletion_ratio disease_enrichment region_confidence shared_rmsd confidence_isoform confidence_canonical hydropathy_delta charge_delta disorder_change top_gained top_lost"
    df = spark.range(1).select(*(F.lit(None).cast("double").alias(n) for n in names.split()), *(F.lit(None).cast("int").alias(n) for n in ("n_samples", "n_unique_peptides", "shared_length", "n_domain_changes")),
                               *(F.lit(None).cast("boolean").alias(n) for n in ("peptide_search_ran", "location_changed", "membrane_changed", "signal_changed", "targeting_changed")),
                               F.lit(None).cast("array<struct<length:int,confidence:double>>").alias("elements"))
    r = evidence.score_axes(df, evidence.criteria()).first()
    assert r["criteria"]["D1"] is False and all(v is None for k, v in r["criteria"].items() if k != "D1")
    assert (r["existence_score"], r["existence_evaluable"], r["existence_high"]) == (0, 1, False)


VCF = ["##x", "#CHROM\tPOS", "1\t11\t.\tA\tC\t.\tPASS\t.", "1\t14\t.\tG\tA\t.\tPASS\t.", "1\t16\t.\tAA\tA\t.\tq10\t.", "1\t16\t.\tAA\tA\t.\tPASS\t.", "1\t30\t.\tA\tT,<DEL>\t.\tPASS\t.", "bad\tx", "1\t17\t.\tA\tT\t.\t.\t."]


def index(spark):
    # ATG GCA AAA TGA on the plus strand in one exon from base 10 (0-based)
    return spark.createDataFrame([("o1", "g1", "chr1", "+", [(10, 22)], "ATGGCAAAATGA")], "orf_id string, gene string, chrom string, strand string, exons array<struct<start:bigint,end:bigint>>, cds string")


def test_variant_scan(spark):
    lines = spark.createDataFrame(list(enumerate(VCF)), "line long, value string")
    hits, funnel = variants.scan(lines, index(spark))
    got = {r["variant_id"]: (r["consequence"], r["notation"]) for r in hits.collect()}
    assert got == {"chr1:11:A:C": ("start_lost", "p.Met1?"), "chr1:14:G:A": ("missense", "p.Ala2Thr"), "chr1:16:AA:A": ("frameshift", None), "chr1:17:A:T": ("stop_gained", "p.Lys3Ter")}
    assert {r["stage"]: r["n"] for r in funnel.collect()} == {"hit": 4, "not_pass": 1, "no_orf": 1, "rejected_unsupported_alt": 1, "rejected_malformed": 1}


def test_minus_strand_variant(spark):
    # the same protein read from the other strand
    idx = spark.createDataFrame([("o2", "g2", "chr1", "-", [(10, 22)], "ATGGCAAAATGA")], "orf_id string, gene string, chrom string, strand string, exons array<struct<start:bigint,end:bigint>>, cds string")
    lines = spark.createDataFrame([(0, "1\t19\t.\tC\tT\t.\tPASS\t."), (1, "1\t19\t.\tA\tT\t.\tPASS\t.")], "line long, value string")
    hits, _ = variants.scan(lines, idx)
    assert {r["line"]: r["consequence"] for r in hits.collect()} == {0: "missense", 1: "reference_mismatch"}


def test_readers(spark, tmp_path):
    (tmp_path / "a.gtf").write_text(
        "#h\n" + "".join(f'1\tx\t{k}\t{a}\t{b}\t.\t-\t.\tgene_name "G"; transcript_id "T"; tag "MANE_Select";\n' for k, a, b in (("exon", 11, 20), ("exon", 31, 40), ("CDS", 14, 20), ("CDS", 31, 36), ("start_codon", 34, 36), ("stop_codon", 11, 13)))
    )
    s = readers.exon_skeletons(readers.read_gtf(spark, str(tmp_path / "a.gtf"))).first()
    assert ([tuple(x) for x in s["exons"]], s["cds_start"], s["cds_end"], s["length_nt"], s["length_aa"], s["consistent"]) == ([(10, 20), (30, 40)], 10, 36, 20, 4, True)
    (tmp_path / "p.fa").write_text(">a|b one\nMK\nLL\n>c\nM\n")
    assert {r["header"]: (r["fields"], r["sequence"]) for r in readers.read_fasta(spark, str(tmp_path / "p.fa")).collect()} == {"a|b one": (["a", "b one"], "MKLL"), "c": (["c"], "M")}
    (tmp_path / "c1").write_text("G1\t3\n__no_feature\t9\n")
    (tmp_path / "c2").write_text("G1\t4\nG2\t1\n")
    assert {r["Gid"]: r["counts"] for r in readers.read_counts(spark, [str(tmp_path / "c1"), str(tmp_path / "c2")]).collect()} == {"G1": 7, "G2": 1}
    (tmp_path / "m.maf").write_text("a score=1\ns hg.chr1 5 3 + 100 AC-G\ns mm.chr2 7 4 - 90 ACTG\n\na\ns mm.chr2 1 2 + 90 AC\n\n")
    rows = readers.alignment_rows(spark, str(tmp_path / "m.maf"), "hg", ["hg", "mm", "rn"]).collect()
    assert {r["species"]: r["seq"] for r in rows} == {"hg": "AC-G", "mm": "ACTG", "rn": "----"}


def test_population_and_somatic(spark):
    lines = spark.createDataFrame([("1\t5\t.\tA\tG\t.\tPASS\tAF=0.1;FLAG;vep=G|mis||NO|c|p|1,G|mis|GENE|YES|c2|p2|7",), ("1\t6\t.\tA\tG\t.\tAC0\tAF=1",)], "value string")
    header = spark.createDataFrame([('##INFO=<ID=vep,Number=.,Type=String,Description="Annotations. Format: Allele|Consequence|SYMBOL|CANONICAL|HGVSc|HGVSp|Protein_position">',)], "value string")
    fields = readers.annotation_fields(header)
    p = readers.population_variants(lines, fields).collect()
    turned = readers.population_variants(lines, ["Allele", "SYMBOL", "Consequence", "CANONICAL", "HGVSc", "HGVSp", "Protein_position"]).collect()
    assert [(r["consequence"], r["gene_symbol"]) for r in turned] == [("GENE", "mis")]
    assert [(r["gene_symbol"], r["allele_frequency"], r["hgvsp"], r["protein_position"]) for r in p] == [("GENE", 0.1, "p2", "7")]
    s = readers.somatic_variants(lines, ["AF", "FLAG", "NONE"]).collect()
    assert [(r["AF"], r["FLAG"], r["NONE"]) for r in s] == [("0.1", "True", None), ("1", None, None)]


def test_wide_and_long(spark):
    long = spark.createDataFrame([("t1", "A", 1.0, None), ("t1", "B", 2.0, 3.0)], "t string, sample string, raw double, cpm double")
    wide = writers.wide_expression(long, ["t"], "sample", ["A", "B", "C"], ["raw", "cpm"])
    back = writers.long_expression(wide, ["t"], ["raw", "cpm"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, long.collect()))


def test_bed_and_fasta(spark):
    df = spark.createDataFrame([("chr1", "+", "n", "Extended", [(0, 10), (20, 30)], [(5, 10), (20, 30)]), ("chr1", "+", "same", "Extended", [(0, 3)], [(0, 3)])],
                               "chrom string, strand string, name string, kind string, isoform array<struct<start:bigint,end:bigint>>, canonical array<struct<start:bigint,end:bigint>>")
    assert [r[0] for r in writers.region_bed(df).collect()] == ["chr1\t0\t5\tn\t0\t+\t0\t5\t0\t1\t5\t0"]
    f = spark.createDataFrame([("MK*",), ("mk",), ("",)], "p string")
    assert writers.protein_fasta(f, "p").count() == 1


def test_shards_and_contract(spark):
    df = spark.range(1000).withColumn("w", F.lit(1.0))
    n = [r["n"] for r in stats.balanced_shards(df, "id", "w", 4).groupBy("shard").agg(F.count("*").alias("n")).collect()]
    assert len(n) == 4 and max(n) - min(n) <= 2
    assert [r["id"] for r in stats.check_contract(df, df.where("id <> 7"), ["id"], ["w"]).collect()] == [7]


def test_cutoffs(spark):
    rate = lambda c: F.when(c > 5, 0.05).otherwise(0.3)
    r = spark.range(1).select(*profile.choose_cutoff(F.lit(9.0), F.lit(None).cast("double"), F.lit(2.0), rate)).first()
    assert tuple(r) == (2.0, "percentile")


def test_resolve_ids(spark):
    df = spark.createDataFrame([("T1.1", "g"), ("T2.1", "g"), ("T9", "g"), ("T9", "h")], "tid string, gene string")
    over = spark.createDataFrame([("T1.1", "O")], "id string, to string")
    known = spark.createDataFrame([("T2.2",)], "id string")
    default = spark.createDataFrame([("g", "D")], "gene string, id string")
    got = {(r["tid"], r["gene"]): (r["resolved_id"], r["how"]) for r in combine.resolve_ids(df, "tid", over, known, default, "gene").collect()}
    assert got == {("T1.1", "g"): ("O", "override"), ("T2.1", "g"): ("T2.2", "new_version"), ("T9", "g"): ("D", "gene_default"), ("T9", "h"): (None, "unresolved")}


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.vcf").write_text("\n".join(VCF) + "\n")
    q = stream_scan(spark, str(tmp_path / "in"), index(spark), str(tmp_path / "hits"), str(tmp_path / "genes"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "hits")).count() == 4
    events = spark.createDataFrame([("u", "2024-01-01 00:05:00"), ("u", "2024-01-01 00:15:00")], "u string, t string").withColumn("t", F.to_timestamp("t"))
    assert stream_quota(events, "u", "t").agg(F.max("n")).first()[0] == 2


def test_nothing_is_cut_in_silence(spark, tmp_path):
    import pytest

    (tmp_path / "v.vcf").write_text("#h\nchr1\t5\t.\tA\tG\nchr1\t6\t.\tA\t" + "G" * 60 + "\n")
    assert readers.read_variant_lines(spark, str(tmp_path / "v.vcf")).count() == 2
    with pytest.raises(Exception, match="more than 50 characters"):
        readers.read_variant_lines(spark, str(tmp_path / "v.vcf"), longest=50).collect()
    df = spark.sql("select map('a', 1, 'b', 2, 'c', 3) as m")
    assert readers.expand_map(df, "m").columns == ["m.a", "m.b", "m.c"]
    with pytest.raises(ValueError, match="more than 2 keys"):
        readers.expand_map(df, "m", most=2)
