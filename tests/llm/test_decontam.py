import hashlib
import random
import re

from millrace.llm import decontam

from .odd import clashing, empty_docs, odd_docs, real


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_force(docs, items):
    windows = []
    for item, text in items:
        w = words(text)
        windows += [(tuple(w[i : i + 13]), item) for i in range(max(1, len(w) - 12))] if w else []
    by_size = {}
    for w, item in windows:
        by_size.setdefault(len(w), {}).setdefault(w, set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size, known in by_size.items():
            for i in range(len(w) - size + 1):
                if (names := known.get(tuple(w[i : i + size]))) is not None:
                    hit |= set(range(i, i + size))
                    found |= names
        out.append((doc is None, doc or 0, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def rows(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


def pairs(df, key):
    return [(r[key], r.text) for r in df.collect()]


def test_real_documents(spark):
    docs, items = real(spark, "documents", "0.01"), real(spark, "benchmark", "0.01")
    found = rows(decontam.judged(decontam.contamination(clashing(docs), items)))
    assert found == brute_force(pairs(docs, "doc_id"), pairs(items, "item_id"))
    assert any(r[-1] for r in found)


def test_odd_rows_and_blocks(spark):
    random.seed(1)
    vocabulary = ["a", "bb", "é", "7", "zz", "qq"]
    docs = odd_docs(spark).union(spark.createDataFrame([(100 + i, " ".join(random.choices(vocabulary, k=random.randrange(60))), "", "", 0) for i in range(120)], odd_docs(spark).schema))
    items = spark.createDataFrame(
        [(1, "Lorem, ipsum"), (2, None), (3, ""), (4, "..."), (5, "a"), (5, "bb bb"), (6, "bb é 7 zz"), (7, "a a a a a"), (8, "IN two LINES"), (9, "plain words")]
        + [(i, " ".join(random.choices(vocabulary[:2], k=13))) for i in range(10, 20)],
        "item_id long, text string",
    )
    want = brute_force(pairs(docs, "doc_id"), pairs(items, "item_id"))
    assert rows(decontam.judged(decontam.contamination(docs, items))) == want
    assert rows(decontam.judged(decontam.contamination(docs, items, block_bytes=60))) == want


def test_empty_tables(spark):
    items = real(spark, "benchmark")
    assert decontam.contamination(empty_docs(spark), items).count() == 0
    found = decontam.judged(decontam.contamination(odd_docs(spark), items.limit(0))).collect()
    assert len(found) == 11 and not any(r.contaminated for r in found)
