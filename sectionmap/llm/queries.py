"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sectionmap.llm import (chat, decontaminate, jaccard_join, language, line_dedup, mixing, quality_classifier,
                            quality_rules, sharding, suffix_dedup, token_alignment, token_counts, whitening)
from sectionmap.llm.common import table

CONTROL_CONVERSATION = "</s>[INST] ok [/INST]"


def tokenizer_file(name: str) -> bytes:
    """A file of the public tokenizers on the driver; its content is shipped to the tasks."""
    import public_tokenizers
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(CONTROL_CONVERSATION).alias("text"))
    out = chat.format_chats(turns.unionByName(extra))
    formatted = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    masked = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: chat.unescape(s["text"]))
    read = (out.withColumn("formatted", formatted).withColumn("masked", F.array_join(masked, ""))
            .withColumn("read", chat.read_chats(F.col("formatted"))))
    said = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("read").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length("masked").cast("long").alias("loss_chars"), F.sha2("masked", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"), "valid", "n_rejected")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["words"])
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return (found.withColumn("n_hit", hit)
            .select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(ids, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_substrings(table(spark, sf_dir, "documents"), width=50)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"), threshold=0.8).select("doc_id", "class_id", "n_links")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = language.held_out(F.col("doc_id"))
    names, prototypes = language.learn(docs.where(~held))
    return language.identify(docs.select("doc_id", "text", held.alias("held_out")), names, prototypes).select(
        "doc_id", "held_out", "lang_pred", "score")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_classifier.learn(docs, labels.where(~language.held_out(F.col("doc_id"))))
    return quality_classifier.score(docs, model).select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), limit=512)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    model = whitening.learn(rows, scale=64, shift=1_000_000, components=16)
    out = whitening.whiten(rows, model, scale=64, shift=1_000_000)
    share = F.lit(None).cast("double")
    if model:
        share = F.element_at(F.lit([float(v) / model.trace for v in model.values]), F.col("component"))
    return out.select("vec_id", "component", F.lit(model.n if model else 0).cast("long").alias("n"), "deviation", "whitened",
                      share.alias("explained"), F.lit(model.identity_error if model else 0.0).alias("identity_error"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = token_alignment.align(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"),
                                    tokenizer_file("piece_bpe_32k.model"), digest=True)
    return token_alignment.score(aligned, token_alignment.link_counts(aligned)).withColumnRenamed("groups", "groups_sha256")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_mixing, op2_quality_rules, op3_decontaminate, op4_chat_format, op5_sharding, op6_suffix_dedup, op7_line_dedup,
    op8_jaccard_join, op9_language, op10_quality_classifier, op11_token_counts, op12_whitening, op13_token_alignment, pipeline)}
