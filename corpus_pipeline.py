"""From raw documents to token digests, one operator a stage.

``run`` stores every stage's rows as Parquet in shared storage and reads them back as the
next stage's documents, so a lost executor repeats work of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm import bagminhash, contamination, lexicon, repeats, rules
from strata.llm.queries import VOCABULARY
from strata.llm.store import ship_package, stored


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    ship_package(spark)
    return rules.keep_good(docs)


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id among near-duplicates."""
    ship_package(spark)
    return bagminhash.keep_first(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes that occur again; ``n_chars`` follows the text."""
    ship_package(spark)
    cut = repeats.remove_repeats(docs.withColumnsRenamed({c: f"__doc_{c}" for c in docs.columns if c != "text"}))
    changed = {"text": F.col("text"), "n_chars": F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("__doc_n_chars"))}
    return cut.select(*[changed.get(c, F.col(f"`__doc_{c}`")).alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    ship_package(spark)
    return contamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the encoded and decoded texts."""
    ship_package(spark)
    return lexicon.round_trip_digests(docs.select("doc_id", "text"), VOCABULARY)


STAGES = [
    ("quality rules", keep_good),
    ("near duplicates", keep_one_of_each_class),
    ("repeated strings", cut_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("encoding and decoding", encode),
]

#: SQL can neither follow the near-duplicate classes nor encode.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
