"""The registered queries themselves, against brute force on a small table."""

import hashlib
import zlib

from pyspark.sql import functions as F

from millrace.llm import queries

from . import test_chat, test_secrets, test_simhash
from .odd import real

SF = "/root/testdata/sf0.001"


def run(spark, name):
    return queries.queries()[name](spark, SF)


def test_op1_counts_add_up(spark):
    found = run(spark, "op1_token_counts")
    assert "doc_id" in found.columns and "doc_tokens" in found.columns and "row_id" not in found.columns
    assert {r.doc_id for r in found.collect()} <= {r.doc_id for r in real(spark, "documents").collect()}


def test_op2_has_every_conversation_and_the_odd_one(spark):
    turns = real(spark, "conversations").select("conv_id", "turn", "role", "text").collect()
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([*map(tuple, turns), (-1, 0, "user", said), (-1, 1, "assistant", said)], test_chat.TURNS).collect()
    rows = run(spark, "op2_chat_format").collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows} == test_chat.slow(more)
    assert all(r.formatted_chars > r.loss_chars for r in rows)


def test_op8_digests(spark):
    texts = {r.doc_id: r.text for r in real(spark, "documents").collect()}
    rows = run(spark, "op8_secrets").collect()
    assert len(rows) == len(texts)
    for r in rows:
        base, spans = test_secrets.slow_base(texts[r.doc_id]), test_secrets.slow_links(texts[r.doc_id] or "")
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in base) for k in ("assign", "access", "hex"))
        assert r.base_sha256 == hashlib.sha256(",".join("%s:%d:%d" % s for s in base).encode()).hexdigest()
        assert r.spans == ",".join("%s:%d:%d" % s for s in spans)


def test_op9_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in real(spark, "documents").collect()]
    assert test_simhash.as_rows(run(spark, "op9_simhash")) == test_simhash.expected(docs)


def test_op10_columns(spark):
    for r in run(spark, "op10_toxicity").collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_rows_of_the_others(spark):
    pages, docs = real(spark, "pages").count(), real(spark, "documents").count()
    assert run(spark, "op6_url_filter").count() == run(spark, "op7_warc").count() == pages
    assert run(spark, "op5_decontamination").count() == docs
    assert run(spark, "op3_nearest").groupBy("query_id").agg(F.count("*").alias("n")).where("n <> 20").count() == 0
    assert run(spark, "op4_packing").select("doc_id").distinct().count() == docs
