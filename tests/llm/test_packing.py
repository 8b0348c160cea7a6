import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import packing

from .odd import clashing, empty_docs, odd_docs, real

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(docs, pieces):
    tokenizer = Tokenizer.from_file(PATH)
    want = sorted(np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for r in docs.collect())
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_seq[p.sequence_id].append((p.offset, p.length))
        by_doc[p.doc_id, p.doc_tokens].append(p)
        assert 0 < p.length <= 4096
    for rows in by_seq.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(p.length for p in pieces)
    assert total == sum(len(w) // 4 for w in want)
    whole = [(w, zlib.crc32(w)) for w in want]
    return by_seq, by_doc, whole


def test_real_documents(spark):
    docs = real(spark, "documents", "0.01")
    pieces = packing.digests(packing.pack(clashing(docs), PATH)).collect()
    by_seq, _, _ = check(docs, pieces)
    total = sum(p.length for p in pieces)
    assert len(by_seq) == -(-total // 4096)  # no padding but the last sequence's
    tokenizer = Tokenizer.from_file(PATH)
    ids = {r.doc_id: np.array([*tokenizer.encode(r.text, add_special_tokens=False).ids, 2], "<u4") for r in docs.collect()}
    seen = defaultdict(list)
    for p in pieces:
        assert p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes())
        seen[p.doc_id].append((p.start, p.length))
    for doc, parts in seen.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == len(ids[doc])


def test_odd_rows(spark):
    docs = odd_docs(spark)
    pieces = packing.digests(packing.pack(docs, PATH)).collect()
    check(docs, pieces)
    assert len([p for p in pieces if p.doc_id is None]) == 2


def test_texts_that_fill_whole_windows(spark):
    words = "lorem ipsum dolor sit amet of the and a in".split()
    docs = spark.createDataFrame([(i, " ".join(words[j % 10] for j in range(i % 23))) for i in range(400)], "doc_id long, text string").repartition(6)
    pieces = packing.pack(docs, PATH, capacity=4, least_cut=1).collect()
    tokenizer, seen, parts = Tokenizer.from_file(PATH), defaultdict(set), defaultdict(dict)
    for p in pieces:
        cells = set(range(p.offset, p.offset + p.length))
        assert not cells & seen[p.sequence_id] and max(cells) < 4
        seen[p.sequence_id] |= cells
        parts[p.row_id][p.start] = bytes(p.ids)
    for r in docs.collect():
        want = [*tokenizer.encode(r.text, add_special_tokens=False).ids, 2]
        assert b"".join(parts[r.doc_id][k] for k in sorted(parts[r.doc_id])) == np.array(want, "<u4").tobytes()
    total = sum(p.length for p in pieces)
    assert len(seen) == -(-total // 4) and all(c == set(range(len(c))) for c in seen.values())


def test_empty_table(spark):
    assert packing.pack(empty_docs(spark), PATH).count() == 0


def test_ids_are_neither_shuffled_nor_broadcast(spark):
    """Whatever Spark's own threshold is: no exchange of the stored ids, nor a broadcast at all."""
    docs = real(spark, "documents").repartition(5)
    for threshold, partitions in (("-1", "8"), ("10485760", "64")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            pieces = packing.pack(docs, PATH)
            check(docs, packing.digests(pieces).collect())
            plan = pieces._jdf.queryExecution().explainString(pieces._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        exchanges = re.findall(r"\) (?:Broadcast)?Exchange\nInput \[\d+\]: \[(.*?)\]", plan)
        assert exchanges and not any("ids#" in x for x in exchanges)
        assert "BroadcastExchange" not in plan and "ShuffledHashJoin" in plan


def best_sum(capacity, counts):
    reach = {0}
    for length, n in counts.items():
        for _ in range(n):
            reach |= {x + length for x in reach if x + length <= capacity}
    return max(reach)


@given(st.integers(1, 80), st.dictionaries(st.integers(1, 40), st.integers(1, 5), max_size=6))
def test_fill_is_the_best_subset(capacity, counts):
    found = packing.fill(capacity, counts, sorted(counts, reverse=True))
    assert all(n <= counts[k] for k, n in found.items())
    assert sum(k * n for k, n in found.items()) == best_sum(capacity, counts)


@settings(deadline=None, max_examples=60)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=12), st.sampled_from([1, 4, 64]))
def test_plan_places_every_text_once(histogram, least_cut):
    plan = packing.plan(histogram, 64, least_cut)
    taken = defaultdict(set)
    for length, n in histogram.items():
        for rank in range(n):
            at = 0
            for start, size, sequence, offset in plan.pieces(length, rank):
                assert start == at and 0 <= sequence < plan.sequences and offset + size <= 64
                cells = set(range(offset, offset + size))
                assert not cells & taken[sequence]
                taken[sequence] |= cells
                at += size
            assert at == length
    assert all(cells == set(range(len(cells))) for cells in taken.values())
    if least_cut == 1:
        assert plan.sequences == -(-sum(k * v for k, v in histogram.items()) // 64)


def test_word_encoder_against_the_tokenizer():
    encoder, tokenizer = packing.WordEncoder(PATH), Tokenizer.from_file(PATH)
    random.seed(5)
    signs = ["a", "B", "é", "É", "ß", "İ", "Σ", "ς", " ", " ", "\n", "\t", "\x1c", " ", "́", "'s", "'LL", "<|endoftext|>", "<|EndOfText|>", ".", ",", "…", "1", "_", "²", "Ⅷ", "word", "Ünd", "***", "!!", "###", "?;:", "&&&%", "$$$", "'", "日", "😀", "​", "　"]
    texts = ["".join(random.choices(signs, k=random.randrange(40))) for _ in range(4000)]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert tokenizer.encode(text, add_special_tokens=False).ids == ids.tolist(), repr(text)


def test_word_encoder_that_remembers_little():
    encoder, tokenizer = packing.WordEncoder(PATH, remembered=20), Tokenizer.from_file(PATH)
    random.seed(6)
    for _ in range(40):
        texts = [" ".join(f"word{min(random.randrange(60), random.randrange(60))}" for _ in range(12)) for _ in range(3)]
        assert [x.tolist() for x in encoder.encode(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(encoder.known) <= 20 + 36 and len(encoder.older) <= 20 + 36
