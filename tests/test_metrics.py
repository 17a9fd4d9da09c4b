"""Derived metrics and candidate enumeration on small tables."""

from pyspark.sql import functions as F

from orfloom.operators import metrics


def test_derived_metrics(spark):
    kind = (
        "i int, expr_a_raw_count double, expr_b_raw_count double, expr_a_initiation_efficiency double, expr_b_initiation_efficiency string, isoform_massspec_summary struct<pepquery_run: boolean>, "
        "isoform_massspec_hits array<struct<unique_to_isoform: boolean, validated: boolean>>, isoform_structure_plddt_shared_mean_isoform double, isoform_structure_plddt_shared_mean_canonical double, "
        "isoform_sae_top_lost_delta_max double, cmp_biophysics_gravy_delta double, cmp_biophysics_gravy_unique double, cmp_biophysics_gravy_shared double, cmp_biophysics_gravy_ratio double"
    )
    rows = [
        (1, 5.0, None, 0.1, "0.3", (True,), [(True, True), (True, None), (False, True)], 0.9, 0.5, -4.0, -0.2, 0.5, -0.1, -5.0),
        (2, None, None, None, "x", (False,), [(True, True)], 0.9, None, None, None, 1.0, 2.0, 0.5),
        (3, 0.0, 2.0, None, "0.2", (True,), None, None, None, 1.0, 0.4, None, 1.0, 3.0),
        (4, 1.0, 2.0, None, None, None, [], 0.1, 0.2, 0.0, 0.0, 1.0, None, 2.0),
    ]
    df = spark.createDataFrame(rows, kind)
    derived = metrics.derived_metrics(df, ["a", "b", "c"])
    names = ["tx:n_cell_lines", "tx:max_initiation_efficiency", "tx:n_validated_unique_peptides", "tx:min_shared_plddt", "tx:sae_top_delta", "tx:abs_gravy_delta", "tx:gravy_unique_minus_shared", "cmp_biophysics_gravy_ratio", "tx:abs_disorder_delta"]
    out = metrics.with_metrics(df, names, derived).orderBy("i").select(*(F.col(f"`metric:{n}`") for n in names)).collect()
    assert [tuple(r) for r in out] == [
        (1.0, 0.3, 1.0, 0.5, 4.0, 0.2, 0.6, None, None), (0.0, None, None, None, None, None, -1.0, 0.5, None),
        (2.0, 0.2, 0.0, None, 1.0, 0.4, None, 3.0, None), (2.0, None, None, 0.1, 0.0, 0.0, None, None, None),
    ]
    assert metrics.derived_metrics(spark.range(1), ["a"]) == {}


def test_candidates(spark):
    catalog = spark.createDataFrame([("is_new", "bool", "isoform", "S", "binary"), ("pi_enriched", "bool", "cmp", None, "binary"), ("old", "bool", "canonical", "S", "binary"), ("gone", "bool", "isoform", "S", "binary"), ("full", "bool", "isoform", "S", "")], "feature string, dtype string, pane string, category string, exclude_reason string")
    profiled = spark.createDataFrame([("len", "isoform", "C"), ("pi_ratio", "cmp", ""), ("pi_delta", "cmp", "S"), ("abs:pi_delta", "cmp", "S"), ("x_delta", "cmp", "S"), ("can", "canonical", "C"), ("seen", "isoform", "D"), ("tx:abs_gravy_delta", "cmp", "S")], "metric string, pane string, category string")
    criteria = spark.createDataFrame([("C1", "conserved", "crit.C1"), ("P2", "moved", "crit.P2")], "criterion string, label string, column string")
    judged = spark.createDataFrame([("fold", "P", "folds")], "tag_id string, category string, label string")
    got = sorted(tuple(r) for r in metrics.enumerate_candidates(catalog, profiled, criteria, judged, ["crit.C1", "is_new", "pi_enriched", "full"], ["seen"]).collect())
    assert got == sorted([
        ("c1", "C", "conserved", "crit.C1", "bool", "", "criterion", ""), ("p2", "P", "moved", "crit.P2", "bool", "", "criterion", "criteria column absent in this run"),
        ("len_hi", "C", "len high", "len", "code", ">=", "sweep", ""), ("len_lo", "C", "len low", "len", "code", "<", "sweep", ""),
        ("pi_ratio_hi", "-", "pi_ratio high", "pi_ratio", "code", ">=", "sweep", ""), ("pi_ratio_lo", "-", "pi_ratio low", "pi_ratio", "code", "<", "sweep", ""),
        ("pi_delta_magnitude", "S", "pi_delta changes appreciably", "abs:pi_delta", "code", ">=", "sweep", ""), ("is_new", "S", "is_new", "is_new", "bool", "", "bool", ""),
        ("pi_ratio_hi", "-", "pi_ratio high", "pi_ratio", "code", ">=", "enriched", ""), ("fold", "P", "folds", "", "llm", "", "llm", ""),
    ])
