from pyspark.sql import functions as F

import corpus_pipeline as p

from . import test_decontam, test_secrets, test_simhash
from .odd import clashing, empty_docs, odd_docs, real

SF = "/root/testdata/sf0.001"


def texts(df):
    return sorted((str(r.doc_id), str(r.text)) for r in df.collect())


def test_stages_keep_the_columns(spark):
    docs = odd_docs(spark).where("doc_id is null or doc_id <> 6")
    for name, stage in p.STAGES[:-1]:
        found = stage(spark, clashing(docs), SF)
        assert found.columns == list(p.COLUMNS), name
        assert found.count() > 0 and stage(spark, empty_docs(spark), SF).count() == 0
    assert p.STAGES[-1][1](spark, empty_docs(spark), SF).count() == 0


def test_toxicity_drops_what_it_rejects(spark):
    docs, labels = real(spark, "documents", "0.01"), real(spark, "labels", "0.01")
    left = p.drop_toxic(spark, docs, "/root/testdata/sf0.01").join(labels, "doc_id")
    assert left.where("toxic = 0").count() == labels.where("toxic = 0").count()
    assert left.where("toxic = 1").count() < 0.5 * labels.where("toxic = 1").count()


def test_near_duplicates_leave_one(spark):
    docs = odd_docs(spark).where("doc_id is null or doc_id <> 6").union(real(spark, "documents"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0))
    roots = test_simhash.slow_groups([t for _, t in rows])
    left = p.drop_near_duplicates(spark, docs, SF).collect()
    assert len(left) == len(set(roots))
    assert sorted(str(r.doc_id) for r in left) == sorted(str(rows[r][0]) for r in set(roots))


def test_contaminated_documents_go(spark):
    docs, items = real(spark, "documents", "0.01"), real(spark, "benchmark", "0.01")
    bad = {r[1] for r in test_decontam.brute_force(test_decontam.pairs(docs, "doc_id"), test_decontam.pairs(items, "item_id")) if r[-1]}
    assert bad and texts(p.drop_contaminated(spark, docs, "/root/testdata/sf0.01")) == texts(docs.where(~F.col("doc_id").isin(*bad)))


def test_secrets_are_marked_and_lengths_follow(spark):
    left = p.redact_secrets(spark, real(spark, "documents", "0.01"), SF).collect()
    assert len(left) == 1000
    assert all(r.n_chars == len(r.text) and not test_secrets.slow_base(r.text) for r in left)


def test_run(spark):
    pieces = p.run(spark, SF).collect()
    assert sum(r.length for r in pieces) == sum({r.doc_id: r.doc_tokens for r in pieces}.values())
    assert all(len(r.ids) == 4 * r.length for r in pieces)
