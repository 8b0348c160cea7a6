"""From raw documents to packed training sequences: the stages of the corpus pipeline."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontam, packing, secrets, simhash, toxicity
from millrace.llm.common import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
REJECT_FROM = 0.3
#: Packing's memory: its workers run beside a JVM that the stages before have made large.
REMEMBERED_WORDS, ENCODED_BYTES = 80_000, 1 << 20


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity under ``REJECT_FROM``; learned from those labelled and not held out.

    Null and empty texts are scored like texts without hits, and stay; rows with
    a null or repeated id are each judged by their text; equal texts share their
    fate. Without labels the seed terms decide. An empty table stays empty, and
    columns beyond those of documents are dropped, here and in all stages.
    """
    docs = docs.select(*COLUMNS)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.scored(docs, model, out="__toxicity").where(F.col("__toxicity") < REJECT_FROM).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, a similarity of 0.8), one document: the least id (null last), then the least hash of the text.

    Rows with the same id and text count as one. Texts without words (null,
    empty, white space alone) are one group. Only ids and hashes are gathered;
    texts meet the chosen ones in a join on both. An empty table stays empty.
    """
    docs = docs.select(*COLUMNS)
    found = simhash.near_copies(docs)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("text_hash").alias("hash")))
    chosen = stored(found.groupBy("component").agg(best.alias("b")).select("b.*"))
    keys = docs.withColumns({"none": F.col("doc_id").isNull(), "id": F.coalesce("doc_id", F.lit(0)), "hash": F.xxhash64("text")})
    return keys.join(chosen, ["none", "id", "hash"]).dropDuplicates(["none", "id", "hash"]).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark's windows do not cover to a twentieth.

    Null, empty and wordless texts have no hit, and stay; rows with a null or
    repeated id are each judged by their text. An empty benchmark drops nothing;
    an empty table stays empty.
    """
    docs = docs.select(*COLUMNS)
    whole = docs.select(F.struct(*COLUMNS).alias("row"), F.col("text").alias("t"))
    found = decontam.judged(decontam.contamination(whole, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="row", text_col="t"))
    return found.where(~F.col("contaminated")).select("doc_id.*")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark; those without keep their text.

    ``n_chars`` follows the text; where that is null it stays as it is. Rows with
    a null or repeated id are each treated for itself; an empty table stays empty.
    """
    docs = secrets.redacted(docs.select(*COLUMNS))
    return docs.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4096 tokens, and their ids.

    A null or empty text is the end id alone; rows with a null or repeated id
    are packed each for itself; an empty table gives no pieces.
    """
    pieces = packing.pack(docs.select(*COLUMNS), public_tokenizers.path("word_bpe_49k.json"), remembered=REMEMBERED_WORDS, at_once=ENCODED_BYTES)
    return pieces.withColumnsRenamed({"row_id": "doc_id", "text_tokens": "doc_tokens"})


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

#: No stage can be said in SQL; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each stage's rows are written, and read by the next.

    What stages do with nulls, empty texts, repeated rows and empty tables, each says.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
