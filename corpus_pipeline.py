"""Training-corpus pipeline over ``documents``: five stages, each a written table.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``documents``.  An empty table passes through; extra
columns of ``docs`` are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orfloom.llm.decontaminate import decontaminate
from orfloom.llm.jaccard import jaccard_classes
from orfloom.llm.language import UNDETERMINED, fit_language_profiles, likeness_floors, predict_language
from orfloom.llm.mixing import mix_sources
from orfloom.llm.queries import MIX_WEIGHTS, VOCABULARY, mix_levels
from orfloom.llm.storage import stored
from orfloom.llm.text import free_name
from orfloom.llm.token_files import read_token_files, write_token_files

#: A label gives way where another language's cosine is so many standard errors larger.
CONFIDENT = 3
#: Share of the tokens that the mixture keeps.
MIX_FRACTION = 0.9


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter go, and texts less like their language than the floor set by all its labelled texts.

    A null ``lang`` is filled; one that the text clearly contradicts is put right.
    """
    profiles = fit_language_profiles(docs)
    floors = likeness_floors(docs, profiles)
    floor = F.coalesce(F.create_map(*(F.lit(x) for item in floors.items() for x in item))[F.col("lang_pred")], F.lit(0.0)) if floors else F.lit(0.0)
    found = predict_language(docs, profiles, label="lang").where((F.col("lang_pred") != UNDETERMINED) & (F.col("likeness") >= floor))
    wrong = F.col("score") - F.col("label_score") >= CONFIDENT * (2 / profiles.dimensions) ** 0.5
    return found.withColumn("lang", F.when(F.col("lang").isNull() | wrong, F.col("lang_pred")).otherwise(F.col("lang"))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies one row stays, that of the smallest id (null ids last); a row that is repeated stays once.

    Rows are told apart by id and text, so that null and repeated ids lose no text.
    """
    key = free_name(docs.columns, "__key")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    classes = jaccard_classes(keyed.select(key, "text"), doc_id=key).groupBy(F.col("doc_id").alias(key)).agg(F.min("component_id").alias("class"))
    order = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", key)).alias("first")
    stay = keyed.select(key, "doc_id").join(classes, key).groupBy("class").agg(order).select(F.col(f"first.{key}").alias(key))
    return keyed.join(stay, key, "left_semi").dropDuplicates([key, "doc_id", "text"]).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; a document of which no word is left goes."""
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), cleaned=True)
    found = found.where("n_hit = 0 or n_hit < n_words")
    cut = F.col("n_hit") > 0
    found = found.withColumn("n_chars", F.when(cut, F.length("clean_text").cast("long")).otherwise(F.col("n_chars")))
    return found.withColumn("text", F.when(cut, F.col("clean_text")).otherwise(F.col("text"))).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come down to their weights; no document is repeated."""
    return mix_sources(docs, mix_levels(), MIX_WEIGHTS, fraction=MIX_FRACTION, max_epochs=1).select(*docs.columns)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in ascending id; a row for each document, read back from them."""
    return read_token_files(write_token_files(docs, VOCABULARY), digests=True)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]

#: The language profiles cannot be written in SQL; a test compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
