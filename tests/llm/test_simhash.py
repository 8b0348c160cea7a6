import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from millrace.llm import simhash
from millrace.llm.common import connected_components

from .odd import clashing, empty_docs, odd_docs, real


def slow_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def slow_components(rows):
    """rows: (id, fingerprint). Component of each by exhaustive search."""
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if bin(a ^ b).count("1") <= 4:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    ids = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        ids[find(i)].append(doc)
    return [min((x for x in ids[find(i)] if x is not None), default=None) for i in range(len(rows))]


def as_rows(df):
    return sorted(((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id is None, r.component_id or 0) for r in df.collect()))


def expected(texts):
    fps = [(i, slow_fingerprint(t)) for i, t in texts]
    return sorted((i is None, i or 0, f"{f:016x}", c is None, c or 0) for (i, f), c in zip(fps, slow_components(fps)))


def test_odd_rows_against_brute_force(spark):
    docs = odd_docs(spark).where("doc_id is null or doc_id <> 6")
    assert as_rows(simhash.near_duplicates(clashing(docs))) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_real_documents_against_brute_force(spark):
    docs = real(spark, "documents")
    assert as_rows(simhash.near_duplicates(docs)) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_empty_table(spark):
    assert simhash.near_duplicates(empty_docs(spark)).count() == 0


def test_links_of_planted_fingerprints(spark):
    """Chains of 1 to 6 flipped bits, in one crowded ball and apart, with few variants at a time."""
    rng = np.random.default_rng(3)
    fps = [0, (1 << 64) - 1]
    for _ in range(60):
        base = int(rng.integers(0, 1 << 63)) * 2 + 1
        for k in range(7):
            at = rng.choice(64, k, replace=False)
            fps.append(base ^ sum(1 << int(b) for b in at))
    fps += [sum(1 << int(b) for b in rng.choice(64, 3, replace=False)) for _ in range(80)]
    fps = sorted(set(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.ball_links(spark.createDataFrame([(f,) for f in signed], "fp long"), at_once=20_000)
    root = {r.node: r.root for r in connected_components(edges).collect()}
    got = [root.get(f, f) for f in signed]
    want = slow_components(list(enumerate(fps)))
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(0, 120)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    edges = spark.createDataFrame(path + star + [(5, 5)], "src long, dst long")
    found = connected_components(edges).groupBy("root").agg(F.count("*").alias("n")).collect()
    assert {(r.root, r.n) for r in found} == {(0, 121), (1000, 200)}


def slow_groups(texts):
    """Group of each text by the similarity of all pairs of five-word shingle sets."""
    sets = []
    for t in texts:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", lower)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else {()})
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) >= 0.8 * len(a | b):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))]


def grouped(found, key):
    by = defaultdict(set)
    for r in found:
        by[r[key]].add(r.doc_id)
    return sorted(map(sorted, by.values()))


def test_sketches_and_prefixes_deny_no_similar_pair():
    rng = np.random.default_rng(12)
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    near = 0
    for _ in range(1500):
        n = int(rng.integers(1, 900))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate((a[: max(1, int(len(a) * rng.uniform(0.75, 1)))], rng.integers(0, 1 << 63, int(n * rng.uniform(0, 0.2))).astype(np.uint64))))
        both = len(np.intersect1d(a, b))
        apart = simhash.bits_apart(simhash.by_length([simhash.sketch(a), simhash.sketch(b)]), np.array([0]), np.array([1]))[0]
        assert apart <= len(a) + len(b) - 2 * both
        if both >= 0.8 * (len(a) + len(b) - both):
            near += 1
            assert apart <= 0.2 / 1.8 * (len(a) + len(b)) + 1e-9
            common = np.intersect1d(simhash.prefix(a, *none, 0.8), simhash.prefix(b, *none, 0.8))
            assert len(common) >= simhash.shared(min(len(a), len(b)))
    assert 300 < near < 1200
    sketches = simhash.by_length([simhash.sketch(x) for x in rng.integers(0, 1 << 63, (100, 500)).astype(np.uint64)])
    assert simhash.bits_apart(sketches, np.arange(50), np.arange(50) + 50).min() > 0.2 / 1.8 * 1000


def test_near_copies_of_real_documents(spark):
    docs = real(spark, "documents", "0.01")
    rows = docs.collect()
    want = defaultdict(list)
    for r, g in zip(rows, slow_groups([r.text for r in rows])):
        want[g].append(r.doc_id)
    found = simhash.near_copies(clashing(docs)).collect()
    assert grouped(found, "component") == sorted(map(sorted, want.values()))
    assert all(r.component_id == min(x for x in [r.component_id, r.doc_id]) for r in found)


def test_near_copies_meet_and_others_do_not(spark):
    rng = np.random.default_rng(8)
    rows, want = [], []
    for k in range(150):
        words = [f"w{x}" for x in rng.integers(0, 5000, 300)]
        rows.append(" ".join(words))
        for changes in (2, 4, 5, 20):  # shingles in common: 290, 280 (0.87), 275 (0.83) and 200 (0.5) or a little more, of 296
            other = list(words)
            for at in rng.choice(np.arange(10, 290, 6), changes, replace=False):
                other[at] = f"x{k}"
            rows.append(" ".join(other))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in simhash.near_copies(docs).collect()}
    near = [found[i] == i - i % 5 for i in range(len(rows)) if i % 5 in (1, 2, 3)]
    far = [found[i] == i for i in range(len(rows)) if i % 5 == 4]
    assert sum(near) >= 0.97 * len(near) and all(far)


def test_a_large_group_of_near_copies(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*words[:100], f"own{i}", *words[100:]])) for i in range(1500)]
    found = simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in found} == {0} and len(found) == 1500


def test_a_template_family_around_the_least_similarity(spark):
    """Copies of one text, each with own words in some of 24 places: about half of all pairs are similar enough."""
    rng = np.random.default_rng(5)
    rows = []
    for family in range(6):
        words = [f"f{family}w{i}" for i in range(240)]
        for i in range(150):
            own = list(words)
            for at in rng.choice(24, rng.integers(2, 8), replace=False):
                own[at * 10 + 3] = f"own{i}"
            rows.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    want = defaultdict(list)
    for i, g in enumerate(slow_groups(rows)):
        want[g].append(i)
    assert grouped(simhash.near_copies(docs).collect(), "component") == sorted(want.values())


def test_short_texts_at_the_least_similarity(spark):
    """Eight words and one more: four of five shingles in common, exactly the least similarity."""
    rng = np.random.default_rng(6)
    rows = []
    for k in range(400):
        words = [f"w{x}" for x in rng.integers(0, 100_000, 8)]
        rows += [" ".join(words), " ".join([*words, f"end{k}"])]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in simhash.near_copies(docs).collect()} == {i: i - i % 2 for i in range(800)}


def test_crowded_shingles_in_rounds_and_blocks(spark, monkeypatch):
    """Few pairs a round, small blocks, and pairs of one family in groups of their own: as all pairs say."""
    monkeypatch.setattr(simhash, "AT_ONCE_SETS", 4)
    monkeypatch.setattr(simhash, "ROUND_PAIRS", 1)
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 30)
    rng = np.random.default_rng(9)
    rows = []
    for i in range(80):
        own = [f"w{j}" for j in range(100)]
        for at in rng.choice(10, rng.integers(2, 4), replace=False):
            own[at * 10 + 3] = f"own{rng.integers(0, 12)}"
        rows.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    want = defaultdict(list)
    for i, g in enumerate(slow_groups(rows)):
        want[g].append(i)
    assert grouped(simhash.near_copies(docs).collect(), "component") == sorted(want.values())


def test_contracted_in_parts(monkeypatch):
    """Each part becomes stars around its least nodes, of the same components as its edges."""
    from millrace.llm import common

    monkeypatch.setattr(common, "EDGES", 3)
    batches = [pa.RecordBatch.from_pydict({"src": pa.array(s, pa.int64()), "dst": pa.array(d, pa.int64())}) for s, d in (([5, 4], [4, -3]), ([9], [9]), ([7, 7], [8, 8]))]
    found = [list(zip(*b.to_pydict().values())) for b in common.contracted(iter(batches))]
    assert found == [[(4, -3), (5, -3)], [(8, 7)]]
    assert list(common.contracted(iter([]))) == []


def test_stars(spark):
    from millrace.llm.common import are_stars

    for edges, stars in (([], True), ([(3, 1), (3, 1), (4, 1), (9, 2)], True), ([(3, 1), (3, 2)], False), ([(3, 2), (2, 1)], False)):
        assert are_stars(spark.createDataFrame(edges, "src long, dst long")) is stars
