"""Tiles, spliced sequences and the index with sequences, against plain slices."""

import random

from pyspark.sql import functions as F

from orfloom.operators import genome
from orfloom.sources.readers import read_fasta

TURNED = str.maketrans("ACGT", "TGCA")


def chromosomes():
    rng = random.Random(7)
    return {f"chr{k}": "".join(rng.choice("ACGTN" if k else "acgt") for _ in range(n)) for k, n in enumerate((1003, 64, 0, 257, 5))}


def write_fasta(path, seqs, line):
    path.write_text("; a comment\n" + "".join(f">{c} some words|x\n" + "".join(s[i : i + line] + "\n" for i in range(0, len(s), line)) for c, s in seqs.items()))


def test_fasta_of_many_splits_becomes_tiles(spark, tmp_path):
    seqs = chromosomes()
    write_fasta(tmp_path / "a.fa", seqs, 17)
    write_fasta(tmp_path / "b.fa", {"other": seqs["chr0"]}, 60)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in ("90b", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            tiled = genome.read_genome(spark, str(tmp_path), 64)
            rows = tiled.collect()
            if split == "90b":
                assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
            for c, s in (seqs | {"other": seqs["chr0"]}).items():
                mine = sorted((r["tile"], r["bases"]) for r in rows if r["chrom"] == c)
                assert mine == [(i, s[i * 64 : i * 64 + 64]) for i in range(-(-len(s) // 64))]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    whole = {r["header"].split()[0]: r["sequence"] for r in read_fasta(spark, str(tmp_path / "a.fa")).collect()}
    assert whole.get("chr3", seqs["chr3"]) == seqs["chr3"]


def test_spliced_equals_slices(spark):
    seqs, rng = chromosomes(), random.Random(9)
    df = spark.createDataFrame(list(seqs.items()), "chrom string, s string")
    tiled = genome.tiles(df, "chrom", "s", 50)
    rows, want = [], {}
    for i in range(80):
        c, strand = rng.choice([*seqs, "absent"]), rng.choice("+-")
        cuts = sorted(rng.sample(range(1100), 2 * rng.randint(0, 4)))
        exons = [(cuts[k], cuts[k + 1]) for k in range(0, len(cuts), 2)]
        rng.shuffle(exons)
        rows.append((i, c, strand, exons or rng.choice([None, []]), exons[:1], (len(cuts) * 7) % 50))
        for name, parts in (("whole", exons), ("first", exons[:1])):
            plus = "".join(seqs.get(c, "")[a:b].upper() for a, b in sorted(parts))
            want[i, name] = (plus[::-1].translate(TURNED) if strand == "-" else plus, sum(b - a for a, b in parts) - len(plus))
    kind = "tis_id int, chrom string, strand string, exons array<struct<start:long,end:long>>, one array<struct<start:long,end:long>>, residues int"
    sites = spark.createDataFrame(rows, kind)
    got = {}
    for r in genome.cut_out(sites, tiled, ["tis_id"], {"whole": "exons", "first": "one"}, width=50).collect():
        got |= {(r["tis_id"], n): (r[n], r[f"{n}_missing"]) for n in ("whole", "first")}
    assert got == want
    frames = {"cds": ("exons", "residues")}
    index, report = genome.index_with_sequences(sites, tiled, "tis_id", frames, 50)
    wrong = sum(1 for r in rows if (s := want[r[0], "whole"][0]) and len(s) != 3 * r[5])
    assert report.first()["n_mismatched"] == wrong and index.where("not cds_ok").count() == wrong
    assert genome.cut_out(sites.where("false"), tiled, ["tis_id"], {"whole": "exons"}).count() == 0


def test_coding_parts_are_the_exons_inside_the_bounds(spark):
    df = spark.sql("SELECT array(named_struct('start', 30L, 'end', 40L), named_struct('start', 0L, 'end', 10L), named_struct('start', 15L, 'end', 22L)) AS e")
    got = df.select(genome.coding_parts("e", F.lit(5), F.lit(33)).alias("p")).first()["p"]
    assert [(x["start"], x["end"]) for x in got] == [(5, 10), (15, 22), (30, 33)]


def test_bounds_that_are_missing_or_crossed_leave_no_part(spark):
    df = spark.sql("SELECT array(named_struct('start', 0L, 'end', 10L), named_struct('start', 10L, 'end', 20L)) AS e")
    spans = {"whole": (-5, 99), "crossed": (15, 5), "open": (None, 7), "point": (4, 4)}
    got = df.select(*(genome.coding_parts("e", F.lit(a).cast("int"), F.lit(b).cast("int")).alias(k) for k, (a, b) in spans.items())).first().asDict(recursive=True)
    assert got == {"whole": [{"start": 0, "end": 20}], "crossed": [], "open": [], "point": []}


def test_rows_to_cut_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    kind = "tis_id long, chrom string, strand string, exons array<struct<start:long,end:long>>"
    sites = spark.createDataFrame([(i, "c", "+", [(i, i + 5), (i + 3, i + 9)]) for i in range(20)], kind).mapInArrow(count, kind)
    tiled = genome.tiles(spark.createDataFrame([("c", "ACG\nT𝄞" * 9), ("d", ""), ("e", None)], "chrom string, s string"), "chrom", "s", 4)
    assert sorted((r["tile"], r["bases"]) for r in tiled.collect()) == [(k, ("ACG\nT𝄞" * 9)[4 * k : 4 * k + 4]) for k in range(14)]
    got = {r["tis_id"]: r["out"] for r in genome.cut_out(sites, tiled, ["tis_id"], {"out": "exons"}, width=4).collect()}
    assert got == {i: ("ACG\nT𝄞" * 9)[i : i + 9].upper() for i in range(20)}
    assert seen.value == 20  # not once for the pieces and once for the rows


def test_report_of_an_index_computes_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    kind = "tis_id long, chrom string, strand string, exons array<struct<start:long,end:long>>, residues int"
    sites = spark.createDataFrame([(i, "c", "-", [(i, i + 6)], 2 + i % 2) for i in range(10)], kind).mapInArrow(count, kind)
    tiled = genome.tiles(spark.createDataFrame([("c", "ACGT" * 9)], "chrom string, s string"), "chrom", "s", 4)
    report = genome.index_with_sequences(sites, tiled, "tis_id", {"cds": ("exons", "residues")}, 4)[1]
    assert [tuple(r) for r in report.collect()] == [("cds", 10, 5)] and seen.value == 10


def exon_rows(spark, seqs, rng):
    """Exons of 60 transcripts, a row each with two parts, and the sequences and missing bases they should give."""
    rows, want = [], {}
    for i in range(60):
        c, strand = rng.choice([*seqs, "absent"]), rng.choice("+-")
        starts = sorted(rng.sample(range(-40, 1100), rng.randint(1, 4)))
        exons = [(a, a + rng.choice([0, 3, 40, 300])) for a in starts]  # overlapping ones are read twice, an empty one is nothing
        parts = [(a + 2, max(a + 2, b - 5)) for a, b in exons]
        for name, spans in (("whole", exons), ("part", parts)):
            plus = "".join(seqs.get(c, "")[max(a, 0) : max(b, 0)].upper() for a, b in spans)
            want[i, name] = (plus[::-1].translate(TURNED) if strand == "-" else plus, sum(b - a for a, b in spans) - len(plus))
        rows += [(i, c, strand, *x, *y, i % 50) for x, y in zip(exons, parts, strict=True)]
        rows.append((i, c, strand, None, 7, 5, None, i % 50))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "tis_id long, chrom string, strand string, a long, b long, c long, d long, residues int"), want


def test_spliced_rows_equal_slices(spark):
    seqs, rng = chromosomes(), random.Random(11)
    tiled = genome.tiles(spark.createDataFrame(list(seqs.items()), "chrom string, s string"), "chrom", "s", 50)
    exons, want = exon_rows(spark, seqs, rng)
    spans, old = {"whole": ("a", "b"), "part": ("c", "d")}, spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in (old, "-1"):  # tiles broadcast and shuffled
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            every = genome.splice(exons, tiled, ["tis_id"], spans, ["residues"], width=50).collect()
            assert {(r["tis_id"], n): (r[n], r[f"{n}_missing"]) for r in every for n in spans} == want and len(every) == 60
            assert all(r["residues"] == r["tis_id"] % 50 for r in every)
            given = {r["tis_id"]: (r["whole"], r["part"]) for r in genome.splice(exons, tiled, ["tis_id"], spans, every=False, width=50).collect()}
            assert given == {i: (want[i, "whole"][0], want[i, "part"][0]) for i in range(60) if want[i, "whole"][0] or want[i, "part"][0]}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_index_of_exon_rows_and_its_report(spark):
    seqs, rng = chromosomes(), random.Random(12)
    tiled = genome.tiles(spark.createDataFrame(list(seqs.items()), "chrom string, s string"), "chrom", "s", 50)
    exons, want = exon_rows(spark, seqs, rng)
    exons = exons.withColumn("residues", F.when(F.col("tis_id") % 2 == 0, F.lit(1)).otherwise(F.lit(len(want[1, "part"][0]) // 3)))
    index, report = genome.index_exons(exons, tiled, "tis_id", {"part": ("c", "d", "residues")}, 50)
    lengths = {i: len(want[i, "part"][0]) for i in range(60)}
    wrong = {i for i, n in lengths.items() if n and n != 3 * (1 if i % 2 == 0 else lengths[1] // 3)}
    assert [tuple(r) for r in report.collect()] == [("part", sum(1 for n in lengths.values() if n), len(wrong))]
    assert {r["tis_id"] for r in index.where("not part_ok").collect()} == wrong and index.count() == 60
    nothing = genome.index_exons(exons.where("false"), tiled, "tis_id", {"part": ("c", "d", "residues")}, 50)[1]
    assert [tuple(r) for r in nothing.collect()] == [("part", 0, 0)]


def test_spliced_rows_go_by_their_order_and_nulls_stay_null(spark):
    tiled = genome.tiles(spark.createDataFrame([("c", "ACGTTGCAAC")], "chrom string, s string"), "chrom", "s", 4)
    rows = [(1, "c", "+", 2, 0, 6), (1, "c", "+", 1, 0, 9), (2, "c", "-", 1, None, 3), (3, "c", "+", 1, 4, 4), (3, "c", "+", 2, 3, None)]
    exons = spark.createDataFrame(rows, "k long, chrom string, strand string, nr int, a long, b long")
    got = genome.splice(exons, tiled, ["k"], {"s": ("a", "b")}, width=4, order="nr")
    assert sorted(map(tuple, got.collect())) == [(1, "ACGTTGCAA" + "ACGTTG", 0), (2, None, None), (3, "", 0)]


def test_exons_of_the_queries_are_shuffled_once(spark):
    from orfloom.plans import sequence_queries

    for query in (sequence_queries.orf_sequences, sequence_queries.genome_transcripts):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
    tiled = sequence_queries._genome(spark, "/root/testdata/sf0.01")
    assert tiled.where("chrom >= 200").count() == 0 < tiled.count()  # only chromosomes that transcripts name
