"""The variant scan calls an allele once on each model; its results are those of calling every line on every ORF."""

import random

from pyspark.sql import functions as F

from orfloom.operators import variants
from orfloom.scratch import stored


def _inputs(spark):
    rng = random.Random(8)
    lines = [(i // 2, f"chr{rng.choice('12')}\t{rng.randint(1, 70)}\t.\t{rng.choice('ACGT')}\t{rng.choice(['A', 'C', 'G,T', 'GA', '<DEL>'])}\t.\t{rng.choice(['PASS', '.', 'q10'])}\t.") for i in range(400)]
    cds = "ATGGCCAAATGGCTGACCGATTAA"
    orfs = [(i, rng.choice("xyz"), rng.choice(["chr1", "chr2"]), rng.choice("+-"), [(a, a + 12), (a + 20, a + 32)], cds if i % 3 else None) for i in range(60) for a in [rng.choice([0, 10, 30])]]
    return spark.createDataFrame(lines, "line long, value string"), spark.createDataFrame(orfs, "orf_id int, gene string, chrom string, strand string, exons array<struct<start:long,end:long>>, cds string")


def test_scan_is_that_of_all_pairs(spark):
    lines, orfs = _inputs(spark)
    found = variants.scan_calls(lines, orfs, ["chr1"], 16)
    v = variants.normalize_variants(lines).where("rejected is null and filter in ('PASS', '.') and chrom = 'chr1'")
    plain = stored(variants.classify(variants.variants_in_orfs(v, orfs, 16)), "plain")
    columns = ["line", "alt_index", "variant_id", "kind", "orf_id", "gene", "chrom", "consequence", "residue", "ref_aa", "alt_aa", "stop_after", "notation"]
    hits = stored(variants.all_hits(found), "hits")
    rows = lambda df, names: sorted(map(str, df.select(*names).collect()))
    assert rows(hits, columns) == rows(plain, columns)
    assert found.calls.count() < hits.count() / 2 and found.calls.count() == plain.select(*variants._ALLELE, *variants._MODEL).distinct().count()

    region = variants.region_of_hit(F.col("residue"), F.lit(1), F.lit(4))
    genes = variants.hits_by_gene(plain.withColumn("region", region), "gene", "region")
    assert [tuple(r) for r in variants.genes_of_scan(found, "gene", region).collect()] == [tuple(r) for r in genes.collect()]
    bad, checked = F.col("consequence") == "reference_mismatch", F.col("consequence").isNotNull()
    names = ["gene", "n_checked", "n_mismatch", "wrong_reference"]
    assert rows(variants.wrong_reference(variants.weighed_hits(found, "gene"), ["gene"], bad, checked, weight="weight"), names) == rows(variants.wrong_reference(plain, ["gene"], bad, checked), names)
    stages, ids = dict(map(tuple, variants.funnel(found).collect())), plain.where("consequence <> 'intronic'").select("line", "alt_index").distinct()
    assert stages["hit"] == v.join(ids, ["line", "alt_index"], "left_semi").count() > ids.count()
    assert sum(stages.values()) == variants.normalize_variants(lines).count()
