import public_tokenizers
import pytest
from pyspark.sql import functions as F

from millrace.llm import tokens

from .odd import clashing, empty_docs, odd_docs, real

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder.load(PATH)


def slow_counts(encoder, text, start, stop):
    """By walking over the tokens' bytes one by one."""
    a, b = len(text[:start].encode()), len(text[:stop].encode())
    first = last = 0
    share, at = 0.0, 0
    for token in encoder.encoding.encode_ordinary(text):
        size = len(encoder.encoding.decode_single_token_bytes(token))
        first += a <= at < b
        last += a <= at + size - 1 < b
        share += max(0, min(b, at + size) - max(a, at)) / size
        at += size
    return first, last, share


def check(encoder, texts, rows):
    for r in rows:
        first, last, share = slow_counts(encoder, texts[r.row_id], r.start, r.stop)
        assert (r.tokens_first, r.tokens_last) == (first, last)
        assert r.tokens_share == pytest.approx(share)


def test_lines_of_real_documents(spark, encoder):
    docs = real(spark, "documents").where(F.length("text") < 1500)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = tokens.section_tokens(clashing(docs), PATH).collect()
    check(encoder, texts, rows)
    for doc, text in texts.items():
        own = sorted((r for r in rows if r.row_id == doc), key=lambda r: r.section)
        assert "".join(text[r.start : r.stop] for r in own) == text
        assert sum(r.tokens_first for r in own) == sum(r.tokens_last for r in own) == own[0].text_tokens


def test_given_sections_cross_tokens(spark, encoder):
    text = "naïve 日本語 😀😀 unbelievable\n\n\nend"
    spans = [(f"{a}-{b}", a, b) for a in range(0, len(text) + 3, 2) for b in range(0, len(text) + 9, 3)]
    docs = spark.createDataFrame([(1, text, spans), (2, "x", None), (3, None, [("a", 0, 5)]), (4, "x", [("a", None, 5), None])], "doc_id long, text string, own array<struct<name: string, start: long, stop: long>>")
    rows = tokens.section_tokens(docs, PATH, sections_col="own").collect()
    assert sum(r.row_id == 1 for r in rows) == len(spans) and [r.text_tokens for r in rows if r.row_id == 3] == [0]
    check(encoder, {1: text, 3: ""}, rows)


def test_odd_rows(spark):
    rows = tokens.section_tokens(odd_docs(spark), PATH).collect()
    assert sum(r.row_id == 1 for r in rows) == 4 and sum(r.row_id is None for r in rows) == 2
    assert [(r.start, r.stop, r.text_tokens) for r in rows if r.row_id == 2] == [(0, 0, 0)]
    assert tokens.section_tokens(empty_docs(spark), PATH).count() == 0


@pytest.mark.parametrize("text", ["lorem ipsum, dolor's 12 " * 30_000, "x" * 450_000, " " * 450_000 + "a b", "\n a" * 150_000, "é ß日 " * 90_000])
def test_cuts_of_long_texts_change_nothing(encoder, text):
    whole = encoder.sizes[encoder.encoding.encode_to_numpy(text[:400_001], disallowed_special=())]
    assert encoder.lengths(text[:400_001]).tolist() == whole.tolist()
