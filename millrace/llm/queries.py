"""The queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat, decontam, packing, secrets, simhash, tokens, toxicity, urlfilter, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tokens.section_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return found.withColumnsRenamed({"row_id": "doc_id", "text_tokens": "doc_tokens"}).drop("name")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.digests(chat.windows(turns))


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.judged(decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.filtered(table(spark, sf_dir, "pages"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(warc.write(table(spark, sf_dir, "pages"))).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), out="found")
    base = F.filter("found", lambda s: s.kind.isin(*secrets.KINDS[: secrets.BASE]))

    def number(kind: str):
        return F.size(F.filter("found", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", number("assign"), number("access"), number("hex"), F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed("found").alias("spans"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    score = toxicity.scored(docs, model, out="score")
    return score.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_token_counts, op2_chat_format, op3_nearest, op4_packing, op5_decontamination, op6_url_filter, op7_warc, op8_secrets, op9_simhash, op10_toxicity, pipeline)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {}
