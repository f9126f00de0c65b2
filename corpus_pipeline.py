"""The corpus pipeline: language ID, near duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` applies
them to ``documents``, writing each result as Parquet in the shared folder and
reading it back for the next one.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sectionmap.llm import decontaminate, jaccard_join, language, mixing, sharding
from sectionmap.llm.common import stage, table


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str, wanted: Sequence[str] | None = None) -> DataFrame:
    """Documents whose predicted language is one of ``wanted``, by default any language that
    is learned from the labelled rows; ``und`` (no letter in the text) never is.  With nothing to
    learn from no language is known, and every text with a letter stays."""
    names, prototypes = language.learn(docs)
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    judged = language.identify(rows, names, prototypes, letters=True)
    stays = F.col("lang_pred").isin(list(names if wanted is None else wanted)) if names else F.col("has_letter")
    return judged.where(stays).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: the one with the smallest
    id (a null id is the largest; of equal ids the smallest text hash).  Rows
    repeated with the same id and text are one row."""
    found = jaccard_join.near_duplicates(docs, threshold=0.8)

    def place(df: DataFrame) -> DataFrame:
        return df.withColumn("__id", F.coalesce("doc_id", F.lit((1 << 63) - 1)))

    key = ["__id", "__hash"]
    gone = place(found.where(~F.col("leads"))).select("__id", F.col("text_hash").alias("__hash")).dropDuplicates()
    # One shuffle of the texts: the repeats are found in the partitions of the join.
    rest = place(docs).withColumn("__hash", F.xxhash64("text")).join(gone, key, "left_anti")
    return rest.dropDuplicates([*key, "text"]).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verbatim run of a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), width=10)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it (none, once or twice);
    rows that share an id are told apart by their texts."""
    by_text = docs.select(F.struct("doc_id", F.xxhash64("text").alias("hash")).alias("doc_id"), "source", "text")
    copies = mixing.mix(by_text).where("copies > 0").select(
        F.col("doc_id.doc_id").alias("__id"), F.col("doc_id.hash").alias("__hash"), F.col("source").alias("__source"), F.col("copies").alias("__copies"))
    same = (F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash")) & F.col("source").eqNullSafe(F.col("__source")))
    return docs.join(copies, same).withColumn("__copy", F.explode(F.sequence(F.lit(1), "__copies"))).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document of the mix."""
    return sharding.shard_documents(docs)


STAGES = [
    ("language_id", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Language profiles, chosen paths, tilted rates and label propagation are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(spark, apply(spark, docs, sf_dir), name)
    return docs
