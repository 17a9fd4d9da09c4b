"""Tri-state criteria and the two scores.  A criterion is ``(config) -> (flag, reason)`` (UD03)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orfloom.functions.scalars import any_true, strict_least


@dataclass(frozen=True)
class Thresholds:
    """Fixed values of the domain."""

    primate_identity: float = 0.80
    mammal_identity: float = 0.50
    phylop: float = 2.0
    samples: int = 3
    efficiency: float = 0.01
    peptides: int = 1
    constraint_delta: float = 0.0
    depletion: float = 0.80
    disease_enrichment: float = 1.0
    confidence: float = 0.70
    rmsd: float = 2.0
    shared_length: int = 20
    element_length: int = 6
    domains: int = 1
    hydropathy_delta: float = 0.3
    charge_delta: float = 0.05
    disorder_delta: float = 0.05
    feature_delta: float = 10.0
    existence_high: int = 5
    functional_high: int = 3


EXISTENCE = ["C1", "C2", "C3", "D1", "D2", "D3"]
FUNCTIONAL = ["L1", "L2", "M1", "M2", "P1", "P2", "P3", "S1", "S2", "S3"]


def criteria(t: Thresholds = Thresholds(), separate: Column | None = None) -> dict[str, Column]:  # noqa: B008
    """The 16 criteria over columns named after their inputs (EV01-EV11); false is "tested, absent", null "not evaluable"."""
    c = F.col
    apart = separate if separate is not None else F.lit(False)
    near = strict_least(c("confidence_isoform"), c("confidence_canonical"))
    return {
        "C1": c("primate_identity") >= t.primate_identity,
        "C2": c("mammal_identity") >= t.mammal_identity,
        "C3": c("phylop_mean") >= t.phylop,
        "D1": F.coalesce(c("n_samples"), F.lit(0)) >= t.samples,
        "D2": c("max_efficiency") >= t.efficiency,
        "D3": F.when(c("peptide_search_ran"), F.coalesce(c("n_unique_peptides"), F.lit(0)) >= t.peptides),
        "L1": any_true(c("location_changed"), c("membrane_changed")),
        "L2": any_true(c("signal_changed"), c("targeting_changed")),
        "M1": F.when(~apart, any_true(c("constraint_delta") >= t.constraint_delta, c("depletion_ratio") < t.depletion)),
        "M2": c("disease_enrichment") >= t.disease_enrichment,
        "P1": c("region_confidence") >= t.confidence,
        "P2": F.when((c("shared_length") >= t.shared_length) & (near >= t.confidence), c("shared_rmsd") >= t.rmsd),
        "P3": F.exists(c("elements"), lambda e: (e.length >= t.element_length) & (e.confidence >= t.confidence)),
        "S1": c("n_domain_changes") >= t.domains,
        "S2": any_true(F.abs(c("hydropathy_delta")) >= t.hydropathy_delta, F.abs(c("charge_delta")) >= t.charge_delta, F.abs(c("disorder_change")) >= t.disorder_delta),
        "S3": F.greatest(F.abs(c("top_gained")), F.abs(c("top_lost"))) >= t.feature_delta,
    }


def score_axes(df: DataFrame, flags: dict[str, Column], axes: dict[str, tuple[list[str], int]] | None = None) -> DataFrame:
    """Per axis: score (trues), evaluable (known), high confidence (both at the cutoff); and the criteria as a map (EV12)."""
    axes = axes or {"existence": (EXISTENCE, Thresholds.existence_high), "functional": (FUNCTIONAL, Thresholds.functional_high)}
    df = df.withColumn("criteria", F.map_from_arrays(F.array(*(F.lit(k) for k in flags)), F.array(*flags.values())))
    for axis, (names, high) in axes.items():
        values = F.array(*(F.element_at("criteria", F.lit(n)) for n in names if n in flags))
        df = df.withColumn(f"{axis}_score", F.size(F.filter(values, lambda x: x))).withColumn(f"{axis}_evaluable", F.size(F.array_compact(values)))
        df = df.withColumn(f"{axis}_high", (F.col(f"{axis}_score") >= high) & (F.col(f"{axis}_evaluable") >= high))
    return df
