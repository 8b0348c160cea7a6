import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import toxicity

from .odd import clashing, empty_docs, odd_docs, real


def distance(a, b):
    """Letters put in, left out, replaced, or swapped with the next one."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        rows.append([i, *[0] * len(b)])
        for j, y in enumerate(b, 1):
            rows[i][j] = min(rows[i - 1][j] + 1, rows[i][j - 1] + 1, rows[i - 1][j - 1] + (x != y))
            if i > 1 and j > 1 and x != y and a[i - 2] == y and x == b[j - 2]:
                rows[i][j] = min(rows[i][j], rows[i - 2][j - 2] + 1)
    return rows[-1][-1]


def slow_match(word, terms):
    best = None
    for term, weight in terms.items():
        stem, plain = term.endswith("*"), term.removesuffix("*")
        d = min(distance(word[:k], plain) for k in range(len(word) + 1)) if stem else distance(word, plain)
        if d <= toxicity.allowed(len(plain), stem) and (best is None or (d, -weight) < best):
            best = d, -weight
    return best and (best[0], -best[1])


def test_automaton_against_levenshtein():
    rng = np.random.default_rng(4)
    terms = {"idiot": 2.0, "worthless": 3.0, "disgusting": 2.5, "lowei*": 1.5, "pathetic": 2.0, "moronic": 1.0, "worth": 0.5, "verybadword*": 1.0, "ass": 1.0}
    automaton = toxicity.Automaton(terms)
    words = list(terms) + ["", "a", "idiots", "loweischaft"]
    for _ in range(3000):
        w = list(str(rng.choice(list(terms))).removesuffix("*"))
        for _ in range(rng.integers(0, 4)):
            at, kind = rng.integers(0, len(w) + 1), rng.integers(0, 4)
            if kind == 3:
                w[at : at + 2] = w[at : at + 2][::-1]
            elif kind == 0:
                w.insert(at, str(rng.choice(list("abcdeiowt"))))
            elif at < len(w):
                w[at : at + 1] = [] if kind == 1 else [str(rng.choice(list("abcdeiowt")))]
        words.append("".join(w) + str(rng.choice(["", "", "en"])))
    for w in words:
        found = automaton.match(w)
        assert (found and found[:2]) == slow_match(w, terms), w


def test_misspelled_short_terms():
    reader = toxicity.Reader({t: 2.0 for t in ("idiot", "trash", "clown", "loser", "moron", "scum")})
    for word in ("idoit", "idiott", "trassh", "clwn", "looser", "morron"):
        x = reader.features(f"such a {word} here")
        assert x[0] == 0 and x[1] > 0, word
    assert not any(reader.features("the slum and the sum of it"))


def test_context_tells_quotes_from_abuse():
    reader = toxicity.Reader({"idiot": 2.0})
    abuse, quote, report = (reader.features(t) for t in ("you are an idiot", 'the word "idiot" is rude', "he said idiot"))
    assert abuse[4] > 0 and abuse[3] == 0
    assert quote[3] > 0 and quote[0] == 0 and report[3] > 0


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.fit(real(spark, "documents", "0.1"), real(spark, "labels", "0.1"))


def test_held_out_documents(spark, model):
    docs, labels = real(spark, "documents", "0.1"), real(spark, "labels", "0.1")
    found = toxicity.scored(clashing(docs).drop("toxic"), model).where(toxicity.held_out("doc_id")).join(labels, "doc_id").select("doc_id", "toxic", "toxicity").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in found)
    right = sum((r.toxicity >= 0.3) == (r.toxic == 1) for r in found)
    caught = [r.toxicity >= 0.3 for r in found if r.toxic]
    assert right / len(found) > 0.98 and sum(caught) / len(caught) > 0.9


def test_odd_rows(spark, model):
    found = toxicity.scored(odd_docs(spark), model).collect()
    assert len(found) == 11 and all(0 <= r.toxicity <= 1 for r in found)
    assert toxicity.scored(empty_docs(spark), model).count() == 0


def test_fit_without_labels_or_documents(spark):
    labels = real(spark, "labels")
    for docs, marks in ((odd_docs(spark), labels.limit(0)), (empty_docs(spark), labels), (odd_docs(spark), labels.withColumn("toxic", F.lit(None).cast("int")))):
        scores = {r.doc_id: r.toxicity for r in toxicity.scored(odd_docs(spark), toxicity.fit(docs, marks)).collect()}
        assert scores[5] > scores[1]


def test_held_out_labels_change_nothing(spark, model):
    labels = real(spark, "labels", "0.1").withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = toxicity.fit(real(spark, "documents", "0.1"), labels)
    assert other.terms == model.terms and np.allclose(other.weights, model.weights)
