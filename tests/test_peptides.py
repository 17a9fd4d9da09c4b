"""Diagnostic peptides against a plain digest."""

import random
import re

from orfloom.operators import peptides

SITES = "gene string, iso string, can string, kind string, a int, b int"


def digest(s, shortest=3, longest=12):
    parts = [p for p in re.split(r"(?<=[KR])(?!P)", s) if p]
    starts = [sum(map(len, parts[:i])) for i in range(len(parts))]
    return {(p, starts[i]) for k in (1, 2) for i in range(len(parts) - k + 1) if shortest <= len(p := "".join(parts[i : i + k])) <= longest}


def diagnostic(iso, kind, a, b):
    kept = {(p, s) for p, s in digest(iso) if not (kind == "Extended" and a is not None and b is not None and not (s < b and s + len(p) > a)) and not (kind == "Truncated" and s)}
    out = {(p, s, s + len(p), False) for p, s in kept}
    return out | {(p[1:], 1, s + len(p), True) for p, s in kept if kind and s == 0 and p[1:2] in set("ACGPSTV")}


def test_unique_peptides(spark):
    rng = random.Random(6)
    protein = lambda n: "M" + "".join(rng.choice("AGKRPSTLE") for _ in range(n))
    rows = []
    for i in range(40):
        can, kind = protein(40), rng.choice(["Extended", "Truncated", "uORF", "Annotated", None])
        iso = protein(9)[:9] + can if kind == "Extended" else can[12:] if kind == "Truncated" else protein(25)
        rows.append((f"g{i % 7}", iso, can, kind, 0 if kind == "Extended" and i % 3 else None, 9))
    rows += [("g0", None, "MKK", "uORF", None, None), ("g0", "MAAAK", "", "uORF", None, None)]
    df = spark.createDataFrame(rows, SITES)
    got = {tuple(r) for r in peptides.diagnostic_peptides(df.where("iso is not null"), "iso", "kind", "a", "b", 1, 3, 12).select("iso", "kind", "peptide", "pos", "end", "excised").collect()}
    assert got == {(iso, kind, *x) for _, iso, _, kind, a, b in rows if iso for x in diagnostic(iso, kind, a, b)}
    want = {(g, p) for g, iso, can, kind, a, b in rows if iso and can for p, *_ in diagnostic(iso, kind, a, b) if p not in {x for x, _ in digest(can)}}
    assert {tuple(r) for r in peptides.unique_peptides(df, "gene", "iso", "can", "kind", "a", "b", None, 1, 3, 12).collect()} == want
    proteome = peptides.proteome_peptides(df, "can", 1, 3, 12)
    known = {p for r in rows if r[2] for p, *_ in diagnostic(r[2], "Annotated", None, None)}
    assert {r[0] for r in proteome.collect()} == known
    alone = peptides.unique_peptides(df, "gene", "iso", "can", "kind", "a", "b", proteome, 1, 3, 12).select("gene", "peptide")
    assert {tuple(r) for r in alone.collect()} == {(g, p) for g, p in want if p not in known}
