"""More registered queries: sequences, labels, criteria, the variant scan and the registries, on strings and spans made from the driver's tables."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from orfloom.functions import scalars as sc
from orfloom.functions import sequence as sq
from orfloom.operators import combine, compare, evidence, filters, metrics, stats, variants
from orfloom.plans.queries import EVENTS, events, register, t
from orfloom.scratch import stored

_CODONS = "MAP {" + ", ".join(f"'{''.join(b)}': '{a}'" for b, a in zip(product("TCAG", repeat=3), sq.STANDARD_CODE, strict=True)) + "}"


def _translated(dna: str) -> str:
    return f"coalesce(array_to_string(list_transform(range(0, length({dna}) // 3), lambda i: {_CODONS}[substr({dna}, CAST(i * 3 + 1 AS BIGINT), 3)]), ''), '')"


_UPPER = "translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')"


def _upper(column: str):
    return F.translate(column, "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


_DNA = "d AS (SELECT doc_id, regexp_replace(upper(text), '[^ACGT]', '', 'g') AS dna FROM documents WHERE text IS NOT NULL)"


def _dna(spark, d):
    return t(spark, d, "documents").where("text is not null").select("doc_id", F.regexp_replace(F.upper("text"), "[^ACGT]", "").alias("dna"))


# --- sequences (SC01-SC05, SC09, SC18, PRJ04, PRJ12)


@register(f"""
WITH {_DNA}
SELECT doc_id, md5(translate(reverse(dna), 'ACGT', 'TGCA')) AS reverse_md5, md5({_translated("dna")}) AS protein_md5,
  CASE WHEN length(dna) > 0 THEN round((length(dna) - length(regexp_replace(dna, '[GC]', '', 'g'))) / length(dna), 9) END AS gc, substr(dna, 3, 8) AS start_window
FROM d""")
def dna_features(spark, d):
    return _dna(spark, d).select(
        "doc_id", F.md5(sq.reverse_complement("dna")).alias("reverse_md5"), F.md5(sq.translate("dna")).alias("protein_md5"),
        F.round(sq.gc_fraction("dna"), 9).alias("gc"), sq.start_window("dna", F.lit(6), 4, 4).alias("start_window"),
    )


@register(f"""
WITH p AS (SELECT doc_id, regexp_replace({_UPPER}, '[^ACDEFGHIKLMNPQRSTVWY]', '', 'g') AS aa FROM documents WHERE text IS NOT NULL)
SELECT doc_id, sha1(aa) AS digest, md5(CASE WHEN doc_id % 2 = 0 AND length(aa) > 0 THEN 'M' || substr(aa, 2) ELSE aa END) AS initiated_md5,
  length(aa) AS isoform_len, length(substr(aa, 11)) AS canonical_len, length(aa) - length(substr(aa, 11)) AS delta_len,
  CASE WHEN length(substr(aa, 11)) > 0 THEN round(length(aa) / length(substr(aa, 11)), 9) END AS ratio_len
FROM p""")
def protein_identity(spark, d):
    p = t(spark, d, "documents").where("text is not null").select("doc_id", F.regexp_replace(_upper("text"), "[^ACDEFGHIKLMNPQRSTVWY]", "").alias("aa"))
    i = sc.identity_columns("aa", F.substring("aa", 11, 1 << 30))
    return p.select("doc_id", sc.content_hash("aa").alias("digest"), F.md5(sc.with_initiator("aa", F.col("doc_id") % 2 == 0)).alias("initiated_md5"), *(F.round(c, 9).alias(k) if k == "ratio_len" else c.alias(k) for k, c in i.items()))


@register(f"""
WITH {_DNA}, e AS (SELECT doc_id, dna, substr(dna, 3, 20) || substr(dna, 41, 30) || substr(dna, 81, 10) AS whole, substr(dna, 11, 12) || substr(dna, 41, 25) AS coding FROM d)
SELECT doc_id, CASE WHEN doc_id % 2 = 1 THEN translate(reverse(whole), 'ACGT', 'TGCA') ELSE whole END AS transcript,
  CASE WHEN doc_id % 2 = 1 THEN translate(reverse(coding), 'ACGT', 'TGCA') ELSE coding END AS coding
FROM e""")
def spliced_transcripts(spark, d):
    exons = F.array(*(F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in ((2, 22), (40, 70), (80, 90))))
    strand = F.when(F.col("doc_id") % 2 == 1, "-").otherwise("+")
    return _dna(spark, d).select("doc_id", variants.spliced(exons, "dna", strand).alias("transcript"), variants.spliced(exons, "dna", strand, F.lit(10), F.lit(65)).alias("coding"))


# --- loci and labels (PRJ01-PRJ03, PRJ10, PRJ16, SC16)

_LOCUS = "'chr' || CAST(l_suppkey % 25 AS VARCHAR) || ':' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_partkey + CAST(l_quantity AS BIGINT) AS VARCHAR) || ':' || CASE WHEN l_linenumber % 2 = 0 THEN '-' ELSE '+' END"


@register(f"""
WITH x AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 5 THEN 'chr1:x-9:+' ELSE {_LOCUS} END AS pos FROM lineitem),
y AS (SELECT *, regexp_extract(pos, '^(.*):(\\d+)-(\\d+):([+-])$', ['c', 'lo', 'hi', 's']) AS r FROM x)
SELECT l_orderkey, l_linenumber, nullif(r.c, '') AS chrom, try_cast(CASE WHEN r.s = '-' THEN r.hi ELSE r.lo END AS BIGINT) AS gstart, try_cast(CASE WHEN r.s = '-' THEN r.lo ELSE r.hi END AS BIGINT) AS gend, nullif(r.s, '') AS strand FROM y""")
def locus_parts(spark, d):
    text = F.concat(F.lit("chr"), (F.col("l_suppkey") % 25).cast("string"), F.lit(":"), F.col("l_partkey").cast("string"), F.lit("-"), (F.col("l_partkey") + F.col("l_quantity").cast("long")).cast("string"), F.when(F.col("l_linenumber") % 2 == 0, ":-").otherwise(":+"))
    x = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") == 5, "chr1:x-9:+").otherwise(text).alias("pos"))
    p = sc.parse_locus("pos")
    return x.select("l_orderkey", "l_linenumber", *(p[k].alias(k) for k in ("chrom", "gstart", "gend", "strand")))


_RAW = ["Annotated", "Truncated:Known", "5'UTR", "5'UTR:CDSFrameOverlap", "Internal", "Extended", "3'UTR", "Novel:CDSFrameOverlap", "Novel", None]
_SIMPLE = ["Annotated", "Truncated", "uORF", "uORF", "Other", "Extended", "Other", "Other", "Other", None]
_FULL = ["Annotated", "Truncated", "uORF", "uoORF", "InternalOutOfFrame", "Extended", "3UTR_ORF", "uoORF", "AltORF", None]
_REGION = [None if k is None else {"Extended": "extension", "Truncated": "lost region"}.get(k, "ORF") for k in _FULL]


def _sql_list(values: list) -> str:
    return "[" + ", ".join("NULL" if v is None else "'" + str(v).replace("'", "''") + "'" for v in values) + "]"


def _pick(values: list, place):
    return F.array(*(F.lit(v).cast("string") for v in values))[place]


@register(f"SELECT p_partkey, {_sql_list(_SIMPLE)}[p_partkey % 10 + 1] AS simple, {_sql_list(_FULL)}[p_partkey % 10 + 1] AS orf_type, {_sql_list(_REGION)}[p_partkey % 10 + 1] AS region FROM part")
def orf_labels(spark, d):
    x = t(spark, d, "part").select("p_partkey", _pick(_RAW, (F.col("p_partkey") % 10).cast("int")).alias("raw"))
    x = x.withColumn("orf_type", sc.orf_type("raw"))
    return x.select("p_partkey", sc.simple_type("raw").alias("simple"), "orf_type", sc.region_label("orf_type").alias("region"))


_CLINICAL = ["Pathogenic/Likely pathogenic", "Conflicting classifications of pathogenicity", "Uncertain significance", "Likely benign", "drug response", "", None]
_FAMILY = ["pathogenic", "conflicting", "uncertain", "benign", "other", "none", "none"]
_STATUS = ["practice guideline", "reviewed by expert panel", "criteria provided, multiple submitters, no conflicts", "criteria provided, single submitter", "criteria provided, conflicting classifications", "no assertion", "x"]
_STARS = [4, 3, 2, 1, 1, 0, 0]


@register(f"SELECT p_partkey, {_sql_list(_FAMILY)}[p_partkey % 7 + 1] AS family, CAST([5, 4, 3, 1, 2, 0, 0][p_partkey % 7 + 1] AS INTEGER) AS severity, CAST({_STARS}[p_partkey % 7 + 1] AS INTEGER) AS stars FROM part")
def clinical_labels(spark, d):
    at = (F.col("p_partkey") % 7).cast("int")
    x = t(spark, d, "part").select("p_partkey", sc.significance_family(_pick(_CLINICAL, at)).alias("family"), _pick(_STATUS, at).alias("status"))
    return x.select("p_partkey", "family", sc.significance_rank("family").alias("severity"), sc.review_stars("status").alias("stars"))


@register("""
SELECT c_custkey, round(ln(1 + greatest(c_acctbal, 0)), 6) AS log1p, round(sign(c_acctbal) * ln(1 + abs(c_acctbal)), 6) AS signed, round(-log10(greatest(c_acctbal / 1e4, 1e-300)), 6) AS neg_log FROM customer""")
def value_transforms(spark, d):
    c = t(spark, d, "customer")
    return c.select("c_custkey", F.round(sc.log1p_clipped("c_acctbal"), 6).alias("log1p"), F.round(sc.signed_log("c_acctbal"), 6).alias("signed"), F.round(sc.neg_log10(F.col("c_acctbal") / 1e4), 6).alias("neg_log"))


# --- criteria (EV01-EV11)

_INPUTS = {
    "primate_identity": "l_discount * 10", "mammal_identity": "CASE WHEN l_linenumber <> 3 THEN l_tax * 10 END", "phylop_mean": "l_quantity / 10 - 1", "n_samples": "nullif(l_linenumber, 5)",
    "max_efficiency": "CASE WHEN l_returnflag = 'A' THEN l_discount END", "peptide_search_ran": "CASE WHEN l_returnflag <> 'R' THEN l_linestatus = 'O' END", "n_unique_peptides": "nullif(l_linenumber, 2) - 1",
    "location_changed": "CASE WHEN l_linenumber <> 1 THEN l_quantity > 25 END", "membrane_changed": "CASE WHEN l_linenumber > 2 THEN l_tax > 0.04 END",
    "signal_changed": "CASE WHEN l_returnflag = 'N' THEN l_tax > 0.06 END", "targeting_changed": "CASE WHEN l_linestatus = 'F' THEN l_discount > 0.05 END",
    "constraint_delta": "CASE WHEN l_linenumber <> 4 THEN l_tax - 0.04 END", "depletion_ratio": "CASE WHEN l_returnflag = 'A' THEN l_discount * 12 END", "disease_enrichment": "CASE WHEN l_quantity > 5 THEN l_quantity / 25 END",
    "region_confidence": "l_discount * 9", "confidence_isoform": "CASE WHEN l_linenumber <> 6 THEN l_tax * 15 END", "confidence_canonical": "CASE WHEN l_linenumber <> 2 THEN l_quantity / 30 END", "shared_length": "CAST(l_quantity AS INTEGER)",
    "shared_rmsd": "l_discount * 40", "n_domain_changes": "l_linenumber - 2", "hydropathy_delta": "CASE WHEN l_linenumber <> 1 THEN l_tax * 5 - 0.2 END", "charge_delta": "CASE WHEN l_linenumber <> 1 THEN l_discount - 0.05 END",
    "disorder_change": "CASE WHEN l_linenumber <> 1 THEN -l_tax END", "top_gained": "CASE WHEN l_returnflag <> 'N' THEN l_quantity / 4 END", "top_lost": "CASE WHEN l_linestatus = 'F' THEN -l_quantity / 3 END",
}


def _any(a: str, b: str) -> str:
    return f"CASE WHEN ({a}) IS NOT NULL OR ({b}) IS NOT NULL THEN coalesce({a}, false) OR coalesce({b}, false) END"


@register(f"""
WITH i AS (SELECT l_orderkey, l_linenumber, {', '.join(f'{v} AS {k}' for k, v in _INPUTS.items())} FROM lineitem)
SELECT l_orderkey, l_linenumber, primate_identity >= 0.8 AS "C1", mammal_identity >= 0.5 AS "C2", phylop_mean >= 2.0 AS "C3", coalesce(n_samples, 0) >= 3 AS "D1", max_efficiency >= 0.01 AS "D2",
  CASE WHEN peptide_search_ran THEN coalesce(n_unique_peptides, 0) >= 1 END AS "D3", {_any('location_changed', 'membrane_changed')} AS "L1", {_any('signal_changed', 'targeting_changed')} AS "L2",
  CASE WHEN l_linenumber <> 7 THEN {_any('constraint_delta >= 0.0', 'depletion_ratio < 0.8')} END AS "M1", disease_enrichment >= 1.0 AS "M2", region_confidence >= 0.7 AS "P1",
  CASE WHEN shared_length >= 20 AND CASE WHEN confidence_isoform IS NOT NULL AND confidence_canonical IS NOT NULL THEN least(confidence_isoform, confidence_canonical) END >= 0.7 THEN shared_rmsd >= 2.0 END AS "P2",
  n_domain_changes >= 1 AS "S1", {_any('abs(hydropathy_delta) >= 0.3', 'abs(charge_delta) >= 0.05')[:-4]} WHEN disorder_change IS NOT NULL THEN false END OR (disorder_change IS NOT NULL AND abs(disorder_change) >= 0.05) AS "S2",
  greatest(abs(top_gained), abs(top_lost)) >= 10.0 AS "S3"
FROM i""")
def criteria_flags(spark, d):
    i = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *(F.expr(v).alias(k) for k, v in _INPUTS.items()), F.expr("cast(null as array<struct<length:int,confidence:double>>)").alias("elements"))
    flags = evidence.criteria(separate=F.col("l_linenumber") == 7)
    return i.select("l_orderkey", "l_linenumber", *(c.alias(k) for k, c in flags.items() if k != "P3"))


# --- variants (VC01-VC09, SRC09, AG22, AG30, TK04)

_CODING = "ATGGCCAAATGGCTGACCGATTAA"
_BASES = ["A", "C", "G", "T"]


def _variant_lines(spark, d):
    base = lambda x: F.array(*(F.lit(b) for b in _BASES))[x.cast("int")]
    x = t(spark, d, "lineitem")
    bad = F.when(F.col("l_linenumber") == 6, "<DEL>").when(F.col("l_linenumber") == 7, "A[chr2:5[").otherwise(base((F.col("l_partkey") + F.col("l_suppkey") % 3 + 1) % 4))
    fields = [F.concat(F.lit("chr"), (F.col("l_suppkey") % 4 + 1).cast("string")), F.when(F.col("l_linenumber") == 5, "x").otherwise((F.col("l_partkey") + 1).cast("string")), F.lit("."),
              base(F.col("l_partkey") % 4), bad, F.lit("."), F.when(F.col("l_returnflag") == "N", "LowQual").when(F.col("l_returnflag") == "A", ".").otherwise("PASS"), F.lit("x=1")]
    return x.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"), F.concat_ws("\t", *fields).alias("value"))


def _orfs(spark, d):
    start = F.col("p_partkey") * 7 % 2000
    p = t(spark, d, "part").where("p_size <= 10")
    exons = F.array(F.struct(start.alias("start"), (start + len(_CODING)).alias("end")))
    return p.select(F.col("p_partkey").alias("orf_id"), "p_brand", F.concat(F.lit("chr"), (F.col("p_partkey") % 3 + 1).cast("string")).alias("chrom"), F.lit("+").alias("strand"), exons.alias("exons"), F.lit(_CODING).alias("cds"))


_SCAN = f"""
v AS (SELECT l_orderkey * 10 + l_linenumber AS line, 'chr' || CAST(l_suppkey % 4 + 1 AS VARCHAR) AS chrom, l_partkey + 1 AS pos, {_sql_list(_BASES)}[l_partkey % 4 + 1] AS ref, {_sql_list(_BASES)}[(l_partkey + l_suppkey % 3 + 1) % 4 + 1] AS alt,
  CASE WHEN l_linenumber = 5 THEN 'rejected_malformed' WHEN l_linenumber = 6 THEN 'rejected_unsupported_alt' WHEN l_linenumber = 7 THEN 'rejected_sv_breakend'
       WHEN l_returnflag = 'N' THEN 'not_pass' WHEN l_suppkey % 4 = 3 THEN 'off_catalog' END AS stage FROM lineitem),
o AS (SELECT p_partkey AS orf_id, p_brand, 'chr' || CAST(p_partkey % 3 + 1 AS VARCHAR) AS chrom, p_partkey * 7 % 2000 AS start FROM part WHERE p_size <= 10),
h AS (SELECT v.*, orf_id, p_brand, pos - 1 - start AS off FROM v JOIN o ON v.chrom = o.chrom AND pos - 1 >= start AND pos - 1 < start + {len(_CODING)} WHERE stage IS NULL),
m AS (SELECT *, CAST(off // 3 AS INTEGER) AS residue, substr('{_CODING}', CAST(off // 3 * 3 + 1 AS BIGINT), 3) AS c1, substr('{_CODING}', CAST(off + 1 AS BIGINT), 1) AS found,
  substr(substr('{_CODING}', 1, CAST(off AS BIGINT)) || alt || substr('{_CODING}', CAST(off + 2 AS BIGINT)), CAST(off // 3 * 3 + 1 AS BIGINT), 3) AS c2 FROM h),
c AS (SELECT *, {_CODONS}[c1] AS ref_aa, {_CODONS}[c2] AS alt_aa FROM m),
k AS (SELECT *, CASE WHEN found <> ref THEN 'reference_mismatch' WHEN residue = 0 AND c2 <> 'ATG' THEN 'start_lost' WHEN ref_aa = alt_aa THEN 'synonymous' WHEN ref_aa = '*' THEN 'stop_lost' WHEN alt_aa = '*' THEN 'stop_gained' ELSE 'missense' END AS consequence FROM c)"""


def _scan(spark, d):
    return variants.scan_calls(_variant_lines(spark, d), _orfs(spark, d), ["chr1", "chr2", "chr3"], width=100)


@register(f"WITH {_SCAN} SELECT coalesce(stage, CASE WHEN EXISTS (SELECT 1 FROM h WHERE h.line = v.line) THEN 'hit' ELSE 'no_orf' END) AS stage, count(*) AS n FROM v GROUP BY 1")
def scan_funnel(spark, d):
    return variants.funnel(_scan(spark, d))


@register(f"WITH {_SCAN} SELECT line, orf_id, residue, ref_aa, alt_aa, consequence FROM k")
def vcf_scan(spark, d):
    return variants.all_hits(_scan(spark, d)).select("line", "orf_id", "residue", "ref_aa", "alt_aa", "consequence")


@register(f"WITH {_SCAN} SELECT p_brand, count(DISTINCT chrom || ':' || pos || ':' || ref || ':' || alt) AS n_variants, count(*) AS n_hits, count(DISTINCT orf_id) AS n_orfs FROM h GROUP BY 1")
def scan_genes(spark, d):
    return variants.genes_of_scan(_scan(spark, d), "p_brand")


@register(f"WITH {_SCAN} SELECT p_brand, count(*) AS n_checked, count(*) FILTER (consequence = 'reference_mismatch') AS n_mismatch, count(*) >= 10 AND count(*) FILTER (consequence = 'reference_mismatch') >= 0.5 * count(*) AS wrong_reference FROM k GROUP BY 1")
def wrong_reference(spark, d):
    hits = variants.weighed_hits(_scan(spark, d), "p_brand")
    return variants.wrong_reference(hits, ["p_brand"], F.col("consequence") == "reference_mismatch", F.col("consequence").isNotNull(), weight="weight")


@register(f"WITH {_SCAN}, w AS (SELECT *, off >= 9 AS inside FROM k) SELECT line, orf_id, consequence AS whole_consequence, CASE WHEN off >= 9 THEN residue - 3 ELSE residue END AS residue, CASE WHEN off >= 9 THEN 'isoform' ELSE 'canonical' END AS frame, CASE WHEN off >= 9 THEN 'unique' ELSE 'shared' END AS region FROM w")
def two_frame_calls(spark, d):
    found = _scan(spark, d)
    late = F.transform("exons", lambda x: F.struct((x.start + 9).alias("start"), x.end.alias("end")))
    both = found.calls.select("chrom", "pos", "ref", "alt", "strand", "exons", "cds").withColumn("whole_exons", F.col("exons")).withColumn("whole_cds", F.col("cds")).withColumn("late_exons", late).withColumn("late_cds", F.substring("cds", 10, 100))
    called = variants.two_frames(both, {"whole": ("whole_exons", "whole_cds"), "late": ("late_exons", "late_cds")}, ["consequence", "residue"])
    pick = variants.chosen_frame(F.col("late_residue"), F.col("whole_residue"), F.when(F.col("late_residue").isNotNull(), "unique"), F.lit("shared"))
    called = called.withColumns({"exons": F.col("whole_exons"), "cds": F.col("whole_cds")})  # the model that was hit
    return variants.all_hits(found, stored(called, "two-frames")).select("line", "orf_id", "whole_consequence", *(c.alias(k) for k, c in pick.items()))


@register(f"WITH {_SCAN} SELECT p_brand, count(DISTINCT chrom || ':' || pos || ':' || ref || ':' || alt) AS n_variants, count(*) AS n_hits, count(*) FILTER (off >= 9) AS n_unique, count(*) FILTER (off < 9) AS n_shared, count(DISTINCT orf_id) AS n_orfs FROM k GROUP BY 1")
def scan_regions(spark, d):
    return variants.genes_of_scan(_scan(spark, d), "p_brand", variants.region_of_hit(F.col("residue"), F.lit(3), F.lit(99)))


_SEVERITY = {"R": 3, "A": 2, "N": 1}


@register("""
WITH r AS (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE l_returnflag WHEN 'R' THEN 3 WHEN 'A' THEN 2 ELSE 1 END DESC, l_linenumber) AS k FROM lineitem)
SELECT l_orderkey, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY k) AS kept FROM r WHERE k <= 3 GROUP BY 1""")
def severest_items(spark, d):
    lists = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_returnflag")).alias("hits"))  # an order has few lines
    kept = variants.severest("hits", _SEVERITY, "l_returnflag", "l_linenumber", 3)
    return lists.select("l_orderkey", F.array_join(F.transform(kept, lambda h: h.l_linenumber.cast("string")), ",").alias("kept"))


# --- registries and roll-ups (PRJ14, PRJ15, PRJ17, AG11, AG27, TG05, UD01, UD02, UD04, EQ08, EQ14, JN12, JN13)


@register("""
SELECT c_custkey, c_acctbal AS raw, abs(c_acctbal) AS magnitude, len(string_split(c_name, '#')) AS parts, CASE WHEN c_nationkey > 0 THEN round(c_acctbal / c_nationkey, 6) END AS derived, CAST(NULL AS DOUBLE) AS absent FROM customer""")
def named_metrics(spark, d):
    c = t(spark, d, "customer").withColumn("words", F.split("c_name", "#"))
    derived = {"per_nation": (["c_acctbal", "c_nationkey"], lambda: F.round(sc.guarded_ratio("c_acctbal", "c_nationkey"), 6)), "needs_more": (["not_here"], lambda: F.col("not_here"))}
    names = ["c_acctbal", "abs:c_acctbal", "words__len", "per_nation", "needs_more"]
    out = metrics.with_metrics(c, names, derived)
    return out.select("c_custkey", *(F.col(f"`metric:{n}`").alias(a) for n, a in zip(names, ("raw", "magnitude", "parts", "derived", "absent"), strict=True)))


@register(f"""
WITH p AS (SELECT doc_id, {_UPPER} AS a, substr({_UPPER}, 1, 200) AS b FROM documents WHERE text IS NOT NULL)
SELECT doc_id, length(a) AS whole_size_n, length(a) - length(replace(a, 'E', '')) AS whole_size_e, length(b) AS head_size_n, length(b) - length(replace(b, 'E', '')) AS head_size_e, length(a) > 1000 AS long FROM p""")
def applied_modules(spark, d):
    p = t(spark, d, "documents").where("text is not null").select("doc_id", _upper("text").alias("a"), F.substring(_upper("text"), 1, 200).alias("b"))
    size = lambda s: {"n": F.length(s), "e": F.length(s) - F.length(F.regexp_replace(s, "E", ""))}
    out = metrics.protein_modules(p, {"whole": "a", "head": "b"}, {"size": size})
    return metrics.site_modules(out, [(["whole_size_n"], lambda x: x.withColumn("long", F.col("whole_size_n") > 1000)), (["absent"], lambda x: x.withColumn("never", F.lit(1)))]).drop("a", "b")


@register(f"""
WITH {EVENTS}, k AS (SELECT user_id, MAP {{'click': 'domain', 'view': 'family', 'purchase': 'disorder', 'error': 'coiled_coil', 'signup': 'site'}}[event_type] AS kind, s AS a, s + CAST(floor(value) AS BIGINT) * 60 + 1 AS b FROM e),
w AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY user_id, kind ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM k),
i AS (SELECT *, sum(new) OVER (PARTITION BY user_id, kind ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS island FROM w)
SELECT user_id, kind, min(a) AS a, max(b) AS b, count(*) AS n FROM i GROUP BY user_id, kind, island""")
def domain_spans(spark, d):
    names = {"click": "Domain", "view": "Family", "purchase": "Disorder", "error": "Coiled_coil", "signup": "Active_site"}
    label = F.create_map(*(F.lit(x) for p in names.items() for x in p))[F.col("event_type")]
    e = events(spark, d).select("user_id", label.alias("label"), F.col("s").alias("a"), (F.col("s") + F.floor("value").cast("long") * 60 + 1).alias("b"))
    return metrics.domain_spans(e, ["user_id"], "label", "a", "b")


@register("""
SELECT 'rich' AS candidate, 'criterion' AS kind, count(*) FILTER (c_nationkey <> 3) AS n_evaluable, count(*) FILTER (c_nationkey <> 3 AND c_acctbal > 5000) AS n_on, true AS present FROM customer
UNION ALL SELECT 'c_acctbal', 'metric', count(*), count(*) FILTER (c_acctbal > 0), true FROM customer
UNION ALL SELECT 'builder', 'boolean', count(*), count(*) FILTER (c_mktsegment = 'BUILDING'), true FROM customer
UNION ALL SELECT 'opinion', 'judged', 0, 0, false""")
def tag_candidates(spark, d):
    c = t(spark, d, "customer").withColumn("rich", F.expr("CASE WHEN c_nationkey <> 3 THEN c_acctbal > 5000 END")).withColumn("builder", F.col("c_mktsegment") == "BUILDING")
    return metrics.tag_candidates(c, ["rich"], ["c_acctbal"], ["builder"], ["opinion"])


@register("""
WITH m AS (
  SELECT 'l_' || lower(l_returnflag) || '_' || ['n_lines', 'price_delta', 'tax_ratio', 'canonical_price'][l_linenumber % 4 + 1] AS metric, max(l_linenumber % 4) AS kind, upper(l_returnflag) AS category FROM lineitem GROUP BY 1, 3),
p AS (SELECT metric, CASE WHEN kind = 3 THEN 'canonical' ELSE 'isoform' END AS pane, category FROM m UNION ALL SELECT 'abs:' || metric, 'isoform', category FROM m WHERE kind = 1 AND category <> 'A'),
b AS (SELECT DISTINCT 'l_' || lower(l_returnflag) || '_' || CASE WHEN l_linestatus = 'F' THEN 'tax_enriched' ELSE 'big_enriched' END AS feature, upper(l_returnflag) AS category FROM lineitem),
r AS (SELECT *, regexp_replace(feature, '_enriched$', '_ratio') AS ratio, regexp_replace(feature, '_enriched$', '_ratio') IN (SELECT metric FROM p) AS known FROM b)
SELECT lower(l_returnflag) || '1' AS tag_id, l_returnflag AS category, 'flag ' || l_returnflag AS label, 'crit_' || l_returnflag AS metric, 'bool' AS kind, '' AS direction, 'criterion' AS source,
  CASE WHEN l_returnflag = 'N' THEN 'criteria column absent in this run' ELSE '' END AS blocked FROM lineitem GROUP BY l_returnflag
UNION ALL SELECT metric || '_magnitude', category, metric || ' changes appreciably', 'abs:' || metric, 'code', '>=', 'sweep', '' FROM p WHERE metric LIKE 'l%\\_delta' ESCAPE '\\' AND 'abs:' || metric IN (SELECT metric FROM p)
UNION ALL SELECT metric || e.s, category, metric || e.w, metric, 'code', e.d, 'sweep', '' FROM p, (VALUES ('_hi', ' high', '>='), ('_lo', ' low', '<')) e(s, w, d) WHERE pane <> 'canonical' AND metric NOT LIKE '%delta'
UNION ALL SELECT CASE WHEN known THEN ratio || '_hi' ELSE feature END, category, CASE WHEN known THEN ratio || ' high' ELSE feature END, CASE WHEN known THEN ratio ELSE feature END, CASE WHEN known THEN 'code' ELSE 'bool' END,
  CASE WHEN known THEN '>=' ELSE '' END, CASE WHEN known THEN 'enriched' ELSE 'bool' END, '' FROM r
UNION ALL SELECT 'asked', 'S', 'asked', '', 'llm', '', 'llm', ''""")
def enumerated_candidates(spark, d):
    """A catalogue, profiles and criteria whose names come from the lines' flags."""
    x = t(spark, d, "lineitem").select("l_returnflag", F.lower("l_returnflag").alias("f"), (F.col("l_linenumber") % 4).alias("k"), "l_linestatus")
    kinds = F.array(*(F.lit(n) for n in ("n_lines", "price_delta", "tax_ratio", "canonical_price")))
    metric = F.concat(F.lit("l_"), "f", F.lit("_"), F.get(kinds, F.col("k")))
    seen = x.select(metric.alias("metric"), F.when(F.col("k") == 3, "canonical").otherwise("isoform").alias("pane"), F.upper("l_returnflag").alias("category"), "k").distinct()
    profiled = seen.drop("k").unionByName(seen.where("k = 1 and category <> 'A'").select(F.concat(F.lit("abs:"), "metric").alias("metric"), F.lit("isoform").alias("pane"), "category"))
    name = F.concat(F.lit("l_"), "f", F.when(F.col("l_linestatus") == "F", "_tax_enriched").otherwise("_big_enriched"))
    catalog = x.select(name.alias("feature"), F.lit("bool").alias("dtype"), F.lit("isoform").alias("pane"), F.upper("l_returnflag").alias("category"), F.lit("binary").alias("exclude_reason")).distinct()
    criteria = x.select(F.concat("l_returnflag", F.lit("1")).alias("criterion"), F.concat(F.lit("flag "), "l_returnflag").alias("label"), F.concat(F.lit("crit_"), "l_returnflag").alias("column")).distinct()
    judged = spark.createDataFrame([("asked", "S", "asked")], "tag_id string, category string, label string")
    columns = ["crit_A", "crit_R", *(f"l_{f}_{k}_enriched" for f in "anr" for k in ("tax", "big"))]
    return metrics.enumerate_candidates(catalog, profiled, criteria, judged, columns)


@register("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R' OR coalesce(CASE WHEN l_linenumber <> 2 THEN l_tax > 0.05 END, false)")
def present_in_any(spark, d):
    x = t(spark, d, "lineitem").withColumn("present_a", F.col("l_returnflag") == "R").withColumn("present_b", F.expr("CASE WHEN l_linenumber <> 2 THEN l_tax > 0.05 END"))
    return filters.present_in_any(x, ["a", "b"]).select("l_orderkey", "l_linenumber")


@register("""
SELECT doc_id, array_to_string(list_filter([CASE WHEN lang = 'fr' AND regexp_matches(text, 'the ') THEN 'english' END, CASE WHEN n_chars < 500 AND regexp_matches(text, 'le ') THEN 'french' END], lambda x: x IS NOT NULL), ',') AS claims FROM documents""")
def unmeasured_claims(spark, d):
    x = t(spark, d, "documents").withColumn("english", F.expr("CASE WHEN lang <> 'fr' THEN 1 END")).withColumn("french", F.expr("CASE WHEN n_chars >= 500 THEN 1 END")).where("lang is not null")
    none = t(spark, d, "documents").where("lang is null").withColumn("english", F.lit(1)).withColumn("french", F.expr("CASE WHEN n_chars >= 500 THEN 1 END"))
    return stats.unmeasured_claims(x.unionByName(none), "text", {"english": "the ", "french": "le "}).select("doc_id", F.array_join("unmeasured", ",").alias("claims"))


@register("""
WITH l AS (SELECT 'l_returnflag' AS field, l_returnflag AS v FROM lineitem UNION ALL SELECT 'l_linenumber', CAST(l_linenumber AS VARCHAR) FROM lineitem), n AS (SELECT field, v, count(*) AS n FROM l GROUP BY ALL)
SELECT field, CAST(sum(n) AS BIGINT) AS rows, count(v) AS "distinct", max(n) / sum(n) AS top_share FROM n GROUP BY field""")
def degenerate_fields(spark, d):
    return stats.degenerate_fields(t(spark, d, "lineitem"), ["l_returnflag", "l_linenumber"])


@register("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 10)")
def lost_keys(spark, d):
    kept = t(spark, d, "lineitem").where("l_quantity > 10").select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    return stats.check_contract(t(spark, d, "orders"), kept, ["o_orderkey"], ["o_orderkey", "l_quantity"])


@register("""
SELECT l_suppkey, count(*) AS n, count(*) FILTER (l_quantity > 10) AS n_aligned, count(*) FILTER (l_tax > 0.03) AS n_intact, avg(CASE WHEN l_tax > 0.03 THEN 1.0 ELSE 0.0 END) AS frac_intact, round(avg(l_discount) FILTER (l_quantity > 10), 9) AS mean_identity,
  arg_max(CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber, {'a': l_partkey, 'b': CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber}) FILTER (l_tax > 0.03) AS deepest_intact FROM lineitem GROUP BY 1""")
def species_rollup(spark, d):
    x = t(spark, d, "lineitem").withColumn("name", F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")))
    return compare.species_rollup(x, ["l_suppkey"], "name", "l_partkey", F.col("l_quantity") > 10, F.col("l_tax") > 0.03, "l_discount").withColumn("mean_identity", F.round("mean_identity", 9))


@register("""
WITH s AS (SELECT o_orderkey, o_custkey FROM orders), n AS (SELECT c_custkey, c_name FROM customer WHERE c_nationkey < 12)
SELECT o_orderkey, c_name FROM s LEFT JOIN n ON o_custkey = c_custkey""")
def annotated_left(spark, d):
    notes = t(spark, d, "customer").where("c_nationkey < 12").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return combine.annotate_left(t(spark, d, "orders").select("o_orderkey", "o_custkey"), notes, ["o_custkey"]).select("o_orderkey", "c_name")
