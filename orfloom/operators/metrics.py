"""Named metrics, list counts, modules and candidates: small registries of column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orfloom.operators.ranges import merge_intervals

#: Builds a column; the names are the columns that it needs.
Derived = tuple[list[str], Callable[[], Column]]


def metric(df: DataFrame, name: str, derived: dict[str, Derived] | None = None) -> Column | None:
    """A metric by its name (PRJ15, UD04): a derived one, ``abs:`` and a column, a list's column and ``__len``, or a column; None where ``df`` lacks what it needs.

    A ``_ratio`` of a unique to a shared region is null unless the ``_shared`` value, where ``df`` has it, is above zero: else its sign is turned.
    """
    if name in (derived or {}):
        need, build = derived[name]
        return build() if set(need) <= set(df.columns) else None
    if name.startswith("abs:"):
        inner = metric(df, name[4:], derived)
        return None if inner is None else F.abs(inner)
    if name.endswith("__len") and name not in df.columns:
        return list_count(F.col(f"`{name[:-5]}`")) if name[:-5] in df.columns else None
    if name not in df.columns:
        return None
    if name.endswith("_ratio") and f"{name[:-6]}_shared" in df.columns:
        return F.when(F.col(f"`{name[:-6]}_shared`").try_cast("double") > 0, F.col(f"`{name}`"))
    return F.col(f"`{name}`")


# Fixed values of the domain: properties whose difference is taken between regions, and those judged by the size of their change.
REGION_PROPERTIES = ("gravy", "disorder", "instability_index")
MAGNITUDES = {"tx:abs_gravy_delta": "cmp_biophysics_gravy_delta", "tx:abs_fraction_charged_delta": "cmp_biophysics_fraction_charged_delta", "tx:abs_disorder_delta": "cmp_biophysics_disorder_delta"}


def derived_metrics(df: DataFrame, samples: list[str]) -> dict[str, Derived]:
    """The derived metrics that ``df`` can give, for :func:`metric`: each by the columns of it that are there (PRJ15).

    Samples that detect the site and their best efficiency (null samples do
    not count), validated peptides of the isoform alone (null where no search
    ran), the weaker shared confidence (null where a side is), the strongest
    change of a shared feature, magnitudes of changes, unique minus shared.
    """
    number = lambda c: F.col(f"`{c}`").try_cast("double")
    there = lambda names: [c for c in names if c in df.columns]
    out: dict[str, Derived] = {}

    def add(name: str, need: list[str], build: Callable[[], Column]) -> None:
        if need:
            out[name] = (need, build)

    most = lambda columns: F.array_max(F.array_compact(F.array(*columns)))
    counts, rates = there([f"expr_{x}_raw_count" for x in samples]), there([f"expr_{x}_initiation_efficiency" for x in samples])
    add("tx:n_cell_lines", counts, lambda: sum((F.col(f"`{c}`").isNotNull().cast("double") for c in counts), F.lit(0.0)))
    add("tx:max_initiation_efficiency", rates, lambda: most([number(c) for c in rates]))
    hits, flat = "isoform_massspec_hits", "isoform_massspec_summary.pepquery_run"
    ran = F.col(f"`{flat}`") if flat in df.columns else F.col("isoform_massspec_summary")["pepquery_run"]
    if hits in df.columns and (flat in df.columns or "isoform_massspec_summary" in df.columns):
        both = lambda h: F.coalesce(h["unique_to_isoform"] & h["validated"], F.lit(False))
        add("tx:n_validated_unique_peptides", [hits], lambda: F.when(ran, F.coalesce(F.size(F.filter(hits, both)), F.lit(0)).cast("double")))
    sides = ["isoform_structure_plddt_shared_mean_isoform", "isoform_structure_plddt_shared_mean_canonical"]
    add("tx:min_shared_plddt", there(sides), lambda: F.when(number(sides[0]).isNotNull() & number(sides[1]).isNotNull(), F.least(*map(number, sides))) if len(there(sides)) == 2 else F.lit(None).cast("double"))
    tops = there(["isoform_sae_top_gained_delta_max", "isoform_sae_top_lost_delta_max"])
    add("tx:sae_top_delta", tops, lambda: most([F.abs(number(c)) for c in tops]))
    for name, c in MAGNITUDES.items():
        add(name, there([c]), lambda c=c: F.abs(number(c)))
    for p in REGION_PROPERTIES:
        pair = [f"cmp_biophysics_{p}_unique", f"cmp_biophysics_{p}_shared"]
        add(f"tx:{p}_unique_minus_shared", there(pair), lambda pair=pair: number(pair[0]) - number(pair[1]) if len(there(pair)) == 2 else F.lit(None).cast("double"))
    return out


def with_metrics(df: DataFrame, names: list[str], derived: dict[str, Derived] | None = None) -> DataFrame:
    """A column for each metric; one that ``df`` cannot give is null."""
    found = [(n, metric(df, n, derived)) for n in names]
    return df.select("*", *((F.lit(None).cast("double") if c is None else c).alias(f"metric:{n}") for n, c in found))


def list_count(items: Column) -> Column:
    """Elements of a list; null has no count (AG27)."""
    return F.when(items.isNotNull(), F.size(items))


def protein_modules(df: DataFrame, panes: dict[str, str], modules: dict[str, Callable[[Column], dict[str, Column]]]) -> DataFrame:
    """Applies pure functions of one sequence to every pane; results are ``{pane}_{module}_{field}`` (UD01)."""
    return df.select("*", *(c.alias(f"{pane}_{m}_{f}") for pane, seq in panes.items() for m, build in modules.items() for f, c in build(F.col(seq)).items()))


def site_modules(df: DataFrame, modules: list[tuple[list[str], Callable[[DataFrame], DataFrame]]]) -> DataFrame:
    """Chains functions of a row's table, each where its columns are there (UD02)."""
    for need, step in modules:
        if set(need) <= set(df.columns):
            df = df.transform(step)
    return df


#: Fixed values of the domain: kinds of annotation entries.
DOMAIN_KINDS = {"Domain": "domain", "Repeat": "domain", "Family": "family", "Homologous_superfamily": "family", "Coiled_coil": "coiled_coil", "Disorder": "disorder"}


def domain_kind(label: Column, kinds: dict[str, str] = DOMAIN_KINDS) -> Column:  # noqa: B006
    """Kind of a domain hit; what is not listed is a site (PRJ17)."""
    out = F.lit("site")
    for name, kind in kinds.items():
        out = F.when(label == name, kind).otherwise(out)
    return F.when(label.isNotNull(), out)


def domain_spans(hits: DataFrame, key: list[str], label: str, start: str, end: str, kinds: dict[str, str] = DOMAIN_KINDS) -> DataFrame:  # noqa: B006
    """Overlapping hits of one kind as one span (PRJ17)."""
    kinded = hits.withColumn("kind", domain_kind(F.col(label), kinds))
    return merge_intervals(kinded.select(*key, "kind", start, end), [*key, "kind"], start, end)


def tag_candidates(df: DataFrame, criteria: list[str], metrics: list[str], booleans: list[str], judged: list[str]) -> DataFrame:
    """What could become a tag (TG05): each column with its kind, evaluable rows, and rows where a flag is true or a metric is above zero."""
    kinds = [(c, "criterion") for c in criteria] + [(c, "metric") for c in metrics] + [(c, "boolean") for c in booleans] + [(c, "judged") for c in judged]

    def entry(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        here = name in df.columns
        known = F.count(c) if here else F.lit(0).cast("long")
        on = F.count_if((c.cast("double") > 0) if kind == "metric" else c.cast("boolean")) if here else F.lit(0).cast("long")
        return F.struct(F.lit(name).alias("candidate"), F.lit(kind).alias("kind"), known.alias("n_evaluable"), on.alias("n_on"), F.lit(here).alias("present"))

    return df.agg(F.array(*(entry(*k) for k in kinds)).alias("c")).select(F.explode("c").alias("c")).select("c.*")


def _slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def enumerate_candidates(catalog: DataFrame, profiled: DataFrame, criteria: DataFrame, judged: DataFrame, columns: list[str], seeded: list[str] | None = None) -> DataFrame:
    """What could become a tag, from the feature catalogue and the frozen profiles (TG05): ``tag_id, category, label, metric, kind, direction, source, blocked``.

    ``criteria``: criterion, label, column; ``profiled``: metric, pane, category of
    the whole population; ``catalog``: feature, dtype, pane, category,
    exclude_reason; ``judged``: tag_id, category, label; ``seeded``: metrics that
    criteria stand for already.

    - A criterion is a flag; it is blocked where the run lacks its column.
    - A profiled metric of another pane than the canonical one is proposed high
      and low, a signed ``_delta`` by its profiled magnitude only, a magnitude
      never by itself.
    - A binary flag of the catalogue that the run has is proposed as it is; an
      ``_enriched`` one by its ratio where that is profiled.
    - Judged ones have neither metric nor cutoff.
    """
    text = lambda x: F.lit(x).cast("string")
    have = profiled.sparkSession.createDataFrame([(c,) for c in sorted(set(columns))], "have string")
    skip = profiled.sparkSession.createDataFrame([(c,) for c in sorted(set(seeded or []))], "metric string").unionByName(criteria.select(F.col("column").alias("metric"))).distinct()

    def rows(df: DataFrame, tag: Column, label: Column, metric_: Column, kind: str, direction: Column, source: str, blocked: Column | None = None, category: Column | None = None) -> DataFrame:
        named = F.coalesce(F.nullif(F.col("category"), F.lit("")), F.lit("-")) if category is None else category
        return df.select(_slug(tag).alias("tag_id"), named.alias("category"), label.alias("label"), metric_.alias("metric"), F.lit(kind).alias("kind"), direction.alias("direction"), F.lit(source).alias("source"), (text("") if blocked is None else blocked).alias("blocked"))

    c = criteria.join(have, F.col("column") == F.col("have"), "left")
    missing = F.when(F.col("have").isNull(), "criteria column absent in this run").otherwise("")
    flags = rows(c, F.col("criterion"), F.col("label"), F.col("column"), "bool", text(""), "criterion", missing, F.substring("criterion", 1, 1))

    m = F.col("metric")
    sweep = profiled.join(skip, "metric", "left_anti").where((F.col("pane").isNull() | (F.col("pane") != "canonical")) & ~m.startswith("abs:") & ~m.startswith("tx:abs_"))
    whole = profiled.select(F.col("metric").alias("known")).distinct()
    signed = sweep.where(m.contains("_delta")).join(whole, F.concat(F.lit("abs:"), m) == F.col("known"))
    changes = rows(signed, F.concat(m, F.lit("_magnitude")), F.concat(m, F.lit(" changes appreciably")), F.col("known"), "code", text(">="), "sweep")
    both = sweep.where(~m.contains("_delta")).select("*", F.explode(F.array(F.struct(F.lit(">=").alias("d"), F.lit("hi").alias("s"), F.lit(" high").alias("w")), F.struct(F.lit("<").alias("d"), F.lit("lo").alias("s"), F.lit(" low").alias("w")))).alias("x"))
    ends = rows(both, F.concat(m, F.lit("_"), F.col("x.s")), F.concat(m, F.col("x.w")), m, "code", F.col("x.d"), "sweep")

    f = F.col("feature")
    binary = catalog.where((F.col("dtype") == "bool") & (F.col("pane").isNull() | (F.col("pane") != "canonical")) & (F.col("exclude_reason") == "binary")).join(have, f == F.col("have"))
    binary = binary.withColumn("ratio", F.when(f.endswith("_enriched"), F.concat(F.substr(f, F.lit(1), F.length(f) - len("_enriched")), F.lit("_ratio")))).join(whole, F.col("ratio") == F.col("known"), "left")
    plain = rows(binary.where("known is null"), f, f, f, "bool", text(""), "bool")
    ratios = rows(binary.where("known is not null"), F.concat("ratio", F.lit("_hi")), F.concat("ratio", F.lit(" high")), F.col("ratio"), "code", text(">="), "enriched")
    asked = judged.select("tag_id", "category", "label", text("").alias("metric"), F.lit("llm").alias("kind"), text("").alias("direction"), F.lit("llm").alias("source"), text("").alias("blocked"))
    return flags.unionByName(changes).unionByName(ends).unionByName(plain).unionByName(ratios).unionByName(asked)
