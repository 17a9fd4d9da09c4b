"""The operators' registered queries, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orfloom.llm.collocations import collocations
from orfloom.llm.conversations import Repair, joined_digests
from orfloom.llm.decontaminate import decontaminate
from orfloom.llm.jaccard import jaccard_classes
from orfloom.llm.language import fit_language_profiles, predict_language
from orfloom.llm.lm import lm_scores
from orfloom.llm.mixing import mix_sources, words
from orfloom.llm.pages import extract
from orfloom.llm.quality import fit_quality, score_quality
from orfloom.llm.sql import ORACLES  # noqa: F401  (read beside QUERIES)
from orfloom.llm.token_files import read_token_files, write_token_files
from orfloom.llm.tokens import token_counts
from orfloom.llm.topk import top_k
from orfloom.llm.urls import judge_urls

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    profiles = fit_language_profiles(docs, where=~held_out)
    found = predict_language(docs.select("doc_id", held_out.alias("held_out"), "text"), profiles)
    return found.drop("text")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_files(write_token_files(table(spark, sf_dir, "documents"), VOCABULARY), digests=True)


#: The mixture's weights by level: domain, language, source; 1 where none is given.
MIX_WEIGHTS = [{"domain0": 2.0}, {"en": 2.0}, {"src0": 2.0}]


def mix_levels() -> list[Column]:
    """The tables have no domain: sources are dealt into three."""
    domain = F.concat(F.lit("domain"), F.pmod(F.crc32(F.coalesce("source", F.lit(""))), F.lit(3)).cast("string"))
    return [domain, F.col("lang"), F.col("source")]


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    mixed = mix_sources(docs, mix_levels(), MIX_WEIGHTS, fraction=0.8, max_epochs=2, seed=11)
    return mixed.select("doc_id", "epoch", "lang", "source", words(F.col("text")).alias("n_tokens"))


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    return lm_scores(table(spark, sf_dir, "documents"), ~held_out)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), VOCABULARY).drop("text")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    found = score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", "text_score", "meta_score", "score", (F.col("score") >= 0.5).alias("keep"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES).drop("component")


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` with one of five damages by the row's key; ``copies`` of each row, ties in the order of the rows as they were."""
    space = F.lit(" ")
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key) % 20
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        role.alias("was_role"), text.alias("was_text"), F.when(kind == 3, 2).otherwise(1).alias("copies"), kind.alias("kind"),
    ).where("kind <> 0")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    repair = Repair(damaged(rows), order_role=F.col("was_role"), order_text=F.col("was_text"), copies=F.col("copies"))
    found = rows.select("conv_id").distinct()
    for part in (repair.counts(), repair.audits(), joined_digests(repair.repaired())):
        found = found.join(part, F.col("conv_id").eqNullSafe(F.col("conv")), "left").drop("conv")
    zero, had_rows = F.lit(0).cast("long"), F.col("audit").isNotNull()
    numbers = [F.when(had_rows, F.col(c)).otherwise(zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


QUERIES = {
    "op1_top_k": op1_top_k,
    "op2_language_id": op2_language_id,
    "op3_decontamination": op3_decontamination,
    "op4_token_files": op4_token_files,
    "op5_mixing": op5_mixing,
    "op6_lm_scores": op6_lm_scores,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_token_counts": op8_token_counts,
    "op9_quality": op9_quality,
    "op10_url_filter": op10_url_filter,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_collocations": op12_collocations,
    "op13_main_text": op13_main_text,
}
