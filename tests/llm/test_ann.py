import math

import numpy as np

from millrace.llm import ann

from .odd import clashing, real


def exact(rows, every, k):
    """By sorting all inner products."""
    out = {}
    for q, x in rows:
        if q % every == 0:
            scored = sorted((-float(sum(a * b for a, b in zip(x, y))), i) for i, y in rows if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def recall(found, want):
    got = {}
    for r in found:
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hit = 0
    for q, best in want.items():
        own = sorted(got.get(q, []))
        assert [r[0] for r in own] == list(range(1, len(best) + 1))
        assert own == sorted(own, key=lambda r: (-r[2], r[1]))
        hit += len({r[1] for r in own} & {b[0] for b in best})
    return hit / sum(map(len, want.values()))


def test_recall_on_real_vectors(spark):
    table = real(spark, "embeddings", "0.1")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    found = ann.nearest(clashing(table)).collect()
    assert recall(found, exact(rows, 20, 20)) >= 0.98
    vectors = dict(rows)
    for r in found[:200]:
        total = 0.0  # in order, without the compensation of sum()
        for a, b in zip(vectors[r.query_id], vectors[r.vec_id]):
            total += a * b
        assert r.score == total


def test_recall_of_the_codes_alone(spark):
    """A pool of 100 out of 2000 has to hold nearly all of the true neighbours."""
    table = real(spark, "embeddings", "0.1")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    assert recall(ann.nearest(table, pool=100).collect(), exact(rows, 20, 20)) >= 0.9


def test_odd_vectors_and_ties(spark):
    good = [(i, [1.0, float(i % 3), 0.5, 2.0, 0.0]) for i in range(40)]
    odd = [(100, None), (120, []), (140, [0.0] * 5), (160, [1.0, None, 0.0, 0.0, 0.0]), (180, [math.nan, 1.0, 1.0, 1.0, 1.0]), (200, [math.inf, 1.0, 1.0, 1.0, 1.0]), (220, [1.0, 2.0]), (None, [1.0] * 5)]
    table = spark.createDataFrame(good + odd + good[:1], "vec_id long, embedding array<float>")
    found = ann.nearest(table).collect()
    want = exact(good, 20, 20)
    assert {r.query_id for r in found} == {0, 20}
    for q in (0, 20):
        assert [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r.rank) if r.query_id == q] == want[q]


def test_small_and_empty_tables(spark):
    kind = "vec_id long, embedding array<float>"
    assert ann.nearest(spark.createDataFrame([], kind)).count() == 0
    assert ann.nearest(spark.createDataFrame([(20, [1.0, 0.0])], kind)).count() == 0
    assert ann.nearest(spark.createDataFrame([(1, [1.0, 0.0]), (3, [-1.0, 2.0])], kind)).count() == 0
    two = ann.nearest(spark.createDataFrame([(20, [1.0, 0.0]), (3, [-1.0, 2.0])], kind)).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in two] == [(20, 1, 3, -1.0)]


def test_blocks_and_waves_give_the_same(spark):
    table = real(spark, "embeddings")
    whole = sorted(map(tuple, ann.nearest(table).collect()))
    assert sorted(map(tuple, ann.nearest(table, block_rows=60, wave_queries=7, pool=5).collect())) == whole


def test_vectors_are_not_multiplied_by_queries(spark):
    """What a search shuffles is candidates for each query, not the rows' vectors."""
    found = ann.nearest(real(spark, "embeddings"))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_anisotropic_loss_goes_down():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 7))

    def loss(q):
        padded = q.padded(x, 4)
        unit = padded / np.linalg.norm(padded, axis=(1, 2), keepdims=True)
        codes = q.nearest(padded)
        q.improve(padded, unit, codes)
        r = padded - q.decoded(codes)
        return (r**2).sum() + (q.eta - 1) * ((r * unit).sum(axis=(1, 2)) ** 2).sum()

    losses = [loss(ann.Quantiser.fit(x, rounds=k)) for k in (0, 1, 6)]
    assert losses[0] > losses[1] > losses[2]


def test_nearest_among_many_near_copies(spark):
    """A third of the rows have almost the same code: more than the pool holds."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 64))
    for i, noise in zip(range(0, 3000, 3), np.tile([0.0001, 0.001, 0.01, 0.1], 250)):
        x[i] = x[0] + rng.normal(size=64) * noise * np.linalg.norm(x[0]) / 8
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    score = x[::20] @ x.T
    score[np.arange(150), np.arange(0, 3000, 20)] = -np.inf
    want = {20 * i: set(np.argsort(-row)[:20].tolist()) for i, row in enumerate(score)}
    got = {q: set() for q in want}
    for r in ann.nearest(table, pool=128).collect():
        got[r.query_id].add(r.vec_id)
    assert got == want
