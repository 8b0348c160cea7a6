"""Near duplicates by SimHash, linked by meet-in-the-middle ball hashing."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, local_components, slices, stored

BITS = 64
SEED = 42
#: Variants that a task holds at once; where it runs beside a JVM that has grown large.
AT_ONCE = 4_000_000
FEW_AT_ONCE = 1_000_000


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of some hashes (of none: 0)."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        bits = np.unpackbits(hashes[at : at + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << j for j in np.flatnonzero(2 * ones > len(hashes)).tolist()))


def fingerprint(raw: bytes | None, width: int = 4) -> int:
    """SimHash over the ``width``-word shingles of a text in UTF-8, repeats included.

    Words are what stands between ASCII white space, A-Z in lower case. A text
    of fewer words is one shingle; one without words (or null) has fingerprint 0.
    """
    words = (raw or b"").lower().split()
    if not words:
        return 0
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    first, last = starts[:n].tolist(), ends[-n:].tolist()
    for at in range(0, n, 1 << 15):
        part = [digest(text[a:b], SEED) for a, b in zip(first[at : at + (1 << 15)], last[at : at + (1 << 15)])]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << j for j in np.flatnonzero(2 * ones > n).tolist()))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """(doc_id, text_hash, fp) for each row: Spark's xxhash64 of the text (of null: its seed), and the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.array([fingerprint(x, width) for x in batch.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], ["doc_id", "text_hash", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("binary").alias("raw"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def masks(bits: int, most: int) -> np.ndarray:
    """All numbers of ``bits`` bits of which at most ``most`` are set, fewest first."""
    out = [sum(1 << j for j in c) for k in range(most + 1) for c in combinations(range(bits), k)]
    return np.array(out, np.uint64)


def ball_edges(fps: np.ndarray, prefix: int, prefix_bits: int, half: int, at_once: int = AT_ONCE) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect the fingerprints sharing a variant with this prefix.

    Of each fingerprint, those variants within ``half`` bits are made whose top
    bits are ``prefix``. Two fingerprints with a variant in common are at most
    2 * half bits apart, and two that are have a variant in common in some
    prefix; so a star around each variant keeps every link's connectivity, and
    a forest of the stars is returned instead of all pairs. Variants are made
    in ranges of their next bits, so that ``at_once`` bounds the memory.
    """
    low_bits = BITS - prefix_bits
    fps = np.unique(fps)
    top, low = fps >> np.uint64(low_bits), fps & np.uint64((1 << low_bits) - 1)
    used = np.bitwise_count(top ^ np.uint64(prefix)).astype(np.int64)
    total = sum(int((used == d).sum()) * len(masks(low_bits, half - d)) for d in range(half + 1))
    parts = 1 << max(0, math.ceil(math.log2(max(1, total / at_once))))
    links_a, links_b = [], []
    shift = np.uint64(low_bits - int(math.log2(parts)))
    for part in range(parts):
        values, owners = [], []
        for d in range(half + 1):
            own = np.flatnonzero(used == d)
            for mask in np.array_split(masks(low_bits, half - d), max(1, len(own) * 1600 // at_once)):
                value = (low[own][:, None] ^ mask[None, :]).ravel()
                owner = np.repeat(own, len(mask))
                if parts > 1:
                    here = (value >> shift) == part
                    value, owner = value[here], owner[here]
                values.append(value)
                owners.append(owner)
        value, owner = np.concatenate(values), np.concatenate(owners)
        ordered = np.sort(value)
        shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if not len(shared):
            continue
        place = np.minimum(np.searchsorted(shared, value), len(shared) - 1)
        hit = shared[place] == value
        place, owner = place[hit], owner[hit]
        centre = np.full(len(shared), len(fps))
        np.minimum.at(centre, place, owner)
        links_a.append(centre[place])
        links_b.append(owner)
    if not links_a:
        return fps[:0], fps[:0]
    root = local_components(len(fps), np.concatenate(links_a), np.concatenate(links_b))
    other = np.flatnonzero(root != np.arange(len(fps)))
    return fps[root[other]], fps[other]


def ball_links(fps: DataFrame, radius: int = 4, at_once: int = AT_ONCE) -> DataFrame:
    """(src, dst): a graph with the components of all fingerprints (fp: distinct longs) linked at ``radius`` bits or fewer.

    Every fingerprint has 1 + 64 + 2016 variants within half the radius 4. They
    are shuffled on their top bits: one row goes to each prefix that some of
    its variants have, and the variants are written out where they meet. The
    number of top bits follows from the number of fingerprints alone.
    """
    if radius % 2:
        raise ValueError("the radius must be even: each side flips half of it")
    half = radius // 2
    count = fps.count()
    variants = sum(math.comb(BITS, k) for k in range(half + 1))
    prefix_bits = min(24, max(8, math.ceil(math.log2(max(1, count * variants / at_once)))))
    flips = masks(prefix_bits, half)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            fp = batch.column(0).to_numpy().view(np.uint64)
            prefix = (fp >> np.uint64(BITS - prefix_bits))[:, None] ^ flips[None, :]
            yield pa.RecordBatch.from_arrays(
                [pa.array(prefix.ravel().astype(np.int32)), pa.array(np.repeat(fp.view(np.int64), len(flips)))], ["prefix", "fp"]
            )

    def meet(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        found = table.column("fp").to_numpy().view(np.uint64)
        a, b = ball_edges(found, key[0].as_py(), prefix_bits, half, at_once)
        return pa.table({"src": a.view(np.int64), "dst": b.view(np.int64)})

    return fps.select("fp").mapInArrow(spread, "prefix int, fp long").groupBy("prefix").applyInArrow(meet, "src long, dst long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4, width: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id, n_copies, component, text_hash) for each row of ``docs``.

    fingerprint: 16 hex digits; component_id: the least doc_id of the component
    of fingerprints linked at ``radius`` bits; n_copies: rows with this
    fingerprint; component: its least fingerprint, as a long; text_hash: Spark's
    xxhash64 of the text. Texts that are null, empty or white space alone have
    fingerprint 0 and are linked like any other. Rows with a null or repeated
    id keep one row each; null ids never name a component unless it has no
    other. An empty table gives none. Other columns are ignored.
    """
    rows = stored(fingerprints(docs, id_col, text_col, width))
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_copies")))
    roots = stored(connected_components(ball_links(nodes, radius)))
    nodes = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", "n_copies", F.coalesce("root", "fp").alias("root"))
    named = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = stored(nodes.join(named, "root").select("fp", "n_copies", "component_id", F.col("root").alias("component")))
    return rows.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "n_copies", "component", "text_hash"
    )


#: Near copies by similarity: documents whose shingles are counted to tell rare from
#: common ones, and how many of these are told apart at most.
SAMPLE_DOCS = 10_000
COMMON = 200_000
#: Words of 64 bits of the parities that go with each shingle of a prefix.
PARITIES = 1
#: Of so many shingles one more has to be shared by the prefixes of two sets.
EACH_SHARED = 32
#: Rows of a bucket of prefixes, and of a block of a crowded shingle, on average.
BUCKET_ROWS = 50_000
BLOCK_ROWS = 4096
#: Sets that share a shingle and are compared in all pairs at once; pairs for each row of a block in the first round, and in later ones, which double them.
AT_ONCE_SETS = 32
FIRST_PAIRS = 2
ROUND_PAIRS = 32
#: Words of sketches that are compared at once.
PAIR_WORDS = 1 << 17
#: Shingles of the sets that one task verifies links of, about.
CELL_ITEMS = 2_000_000


def shingles(raw: bytes | None, width: int) -> tuple[int, np.ndarray]:
    """Hash of a text's words, and of its distinct shingles, ascending (words as in ``fingerprint``)."""
    words = (raw or b"").lower().split()
    text = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        found = [digest(text, SEED)] if words else []
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        found = [digest(text[a:b], SEED) for a, b in zip(starts[: 1 - width].tolist(), ends[width - 1 :].tolist())]
    return digest(text, SEED + 1), np.unique(np.array(found, np.uint64))


def parities(hashes: np.ndarray, words: int) -> np.ndarray:
    """Whether an odd number of a set's hashes falls on each of ``words`` * 64 bits: two sets differ in as many hashes at least as in bits."""
    odd = np.bincount((hashes % np.uint64(words * 64)).astype(np.int64), minlength=words * 64) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def sketch(hashes: np.ndarray) -> bytes:
    """Parities on as many bits as the set has hashes, or more, by a power of two."""
    return parities(hashes, 1 << max(0, math.ceil(math.log2(max(1, len(hashes) / 64))))).tobytes()


def folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """Sketches of one length (rows) as they were on fewer bits."""
    return np.bitwise_xor.reduce(sketches.reshape(len(sketches), -1, words), axis=1)


def by_length(sketches: list[bytes]) -> tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]:
    """The words of each sketch, its place among those of the same length, and these in one table for each length."""
    words = np.fromiter(map(len, sketches), np.int64, len(sketches)) // 8
    place, tables = np.zeros(len(sketches), np.int64), {}
    for size in np.unique(words).tolist():
        own = np.flatnonzero(words == size)
        place[own] = np.arange(len(own))
        tables[size] = np.frombuffer(b"".join(sketches[i] for i in own.tolist()), np.uint64).reshape(-1, size)
    return words, place, tables


def bits_apart(sketches: tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many bits the a-th and b-th sketches (``by_length``) differ, the longer of two folded to the length of the other."""
    words, place, tables = sketches
    out = np.zeros(len(a), np.int64)
    for large, small in np.unique(np.stack((np.maximum(words[a], words[b]), np.minimum(words[a], words[b])), axis=1), axis=0).tolist():
        short = folded(tables[large], small)
        for one, other in ((a, b), (b, a)) if large > small else ((a, b),):
            own = np.flatnonzero((words[one] == large) & (words[other] == small))
            step = max(1, PAIR_WORDS // small)
            for k in range(0, len(own), step):
                at = own[k : k + step]
                out[at] = np.bitwise_count(short[place[one[at]]] ^ tables[small][place[other[at]]]).sum(axis=1, dtype=np.int64)
    return out


def shared(n: np.ndarray | int) -> np.ndarray | int:
    """How many hashes the prefixes of a set of ``n`` and of a similar one have in common at least, if that is no smaller."""
    return 1 + n // EACH_SHARED


def prefix(hashes: np.ndarray, common: np.ndarray, times: np.ndarray, similarity: float) -> np.ndarray:
    """The rarest hashes of a set, so many that every set of this similarity has ``shared`` of them among its own.

    The order is by the number in ``times`` (0 if not in ``common``, which
    ascends), then by hash: any order does that is the same for all sets. Sets
    of n that are similar have o >= similarity * n in common. The l-th of these
    has o - l more behind it, so that it is among the first n - o + l of either.
    """
    place = np.minimum(np.searchsorted(common, hashes), max(0, len(common) - 1))
    count = np.where(common[place] == hashes, times[place], 0) if len(common) else np.zeros(len(hashes), np.int64)
    return hashes[np.lexsort((hashes, count))][: len(hashes) - math.ceil(similarity * len(hashes) - 1e-9) + shared(len(hashes))]


def most_apart(total: np.ndarray, similarity: float) -> np.ndarray:
    """In how many hashes two sets of this similarity can differ that have ``total`` together."""
    return (1 - similarity) / (1 + similarity) * total + 1e-9


def possible(n: np.ndarray, bits: np.ndarray, a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets of these sizes and parities can be so similar; never denied to two that are."""
    lengths = np.minimum(n[a], n[b]) >= similarity * np.maximum(n[a], n[b]) - 1e-9
    return lengths & (np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64) <= most_apart(n[a] + n[b], similarity))


def first_pairs(key: np.ndarray, n: np.ndarray, bits: np.ndarray, root: np.ndarray, similarity: float, at_once: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows (a, b) of the same key and of different roots, keys ascending, and which rows are of crowded keys.

    All possible pairs, but of keys with more than ``at_once`` rows only those
    of the middle row with all and of each with the next few; the others are
    left to ``more_pairs``.
    """
    begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.append(begin, len(key)))
    crowded = np.repeat(size > at_once, size)
    found_a, found_b = [], []

    def add(a: np.ndarray, b: np.ndarray) -> None:
        for at in range(0, len(a), 1 << 16):
            x, y = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
            fine = (root[x] != root[y]) & possible(n, bits, x, y, similarity)
            found_a.append(x[fine])
            found_b.append(y[fine])

    add(np.repeat(begin + size // 2, size)[crowded], np.flatnonzero(crowded))
    left = np.flatnonzero(np.repeat(size > 1, size))
    for offset in range(1, at_once):
        left = left[left + offset < len(key)]
        left = left[key[left] == key[left + offset]]
        if offset > at_once // 4:
            left = left[~crowded[left]]
        add(left, left + offset)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b]), crowded


def more_pairs(root: np.ndarray, side: np.ndarray, n: np.ndarray, bits: np.ndarray, sketches: tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]], similarity: float, done: int, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Possible pairs of rows (ascending n) of different roots, and of different sides if there are two, that are more than ``done`` rows apart; and how far apart all of them are found.

    Ends after ``most`` pairs: for rows that are left, roots can be the same in the next round.
    """
    values, counts = np.unique(root, return_counts=True)
    out = np.flatnonzero(root != values[counts.argmax()])
    two = len(np.unique(side)) > 1
    links_a, links_b, total = [out[:0]], [out[:0]], 0
    waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def flush() -> int:
        """Takes those of the waiting pairs that their sketches leave."""
        if not waiting:
            return 0
        a, b = (np.concatenate(x) for x in zip(*waiting))
        waiting.clear()
        fine = bits_apart(sketches, a, b) <= most_apart(n[a] + n[b], similarity)
        links_a.append(a[fine])
        links_b.append(b[fine])
        return int(fine.sum())

    last = int((np.searchsorted(n, n / similarity + 1e-6, side="right") - 1 - np.arange(len(n))).max(initial=0))
    for offset in range(done + 1, last + 1):
        lower = np.concatenate((out[out + offset < len(n)], out[out >= offset] - offset))
        lower = lower[root[lower] != root[lower + offset]]
        if two:
            lower = lower[side[lower] != side[lower + offset]]
        lower = np.unique(lower[possible(n, bits, lower, lower + offset, similarity)])
        if len(lower):
            waiting.append((lower, lower + offset))
        if sum(len(w[0]) for w in waiting) >= min(most, 1 << 15):
            total += flush()
        if total > most:
            return np.concatenate(links_a), np.concatenate(links_b), offset
    flush()
    return np.concatenate(links_a), np.concatenate(links_b), len(n)


BITS_OF = [f"b{i}" for i in range(PARITIES)]


def columns_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return table.column("node").to_numpy(), table.column("n").to_numpy().astype(np.int64), np.stack([table.column(b).to_numpy().view(np.uint64) for b in BITS_OF], axis=1)


def first_links(nodes: DataFrame, rows: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(src, dst): pairs of nodes that can be similar and have different roots; and (key, node, n, parities): rows of shingles too crowded for all pairs.

    Two sets of this similarity share some shingles of their prefixes (``rows``
    in all), which are dealt out by them. A pair that shares a crowded one is
    met there; any other has to share as many as ``shared`` says.
    """
    buckets, at_once = max(8, math.ceil(rows / BUCKET_ROWS)), AT_ONCE_SETS

    def meet(_: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("n", "ascending"), ("node", "ascending")])
        key, root = table.column("key").to_numpy(), table.column("root").to_numpy()
        # Keys that bring no two roots together are of no use.
        begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        mixed = np.minimum.reduceat(root, begin) != np.maximum.reduceat(root, begin)
        table = table.filter(pa.array(np.repeat(mixed, np.diff(np.append(begin, len(key))))))
        key, root, (node, n, bits) = table.column("key").to_numpy(), table.column("root").to_numpy(), columns_of(table)
        a, b, crowded = first_pairs(key, n, bits, root, similarity, at_once)
        # Pairs as numbers of two nodes in one, so that little is sorted.
        ids, first, local = np.unique(node, return_index=True, return_inverse=True)
        pairs, place = np.unique(np.minimum(local[a], local[b]) * len(ids) + np.maximum(local[a], local[b]), return_inverse=True)
        low, high = pairs // max(1, len(ids)), pairs % max(1, len(ids))
        need = shared(np.minimum(n[first[low]], n[first[high]]))
        count = np.maximum(np.bincount(place, minlength=len(pairs)), need * (np.bincount(place, crowded[a], len(pairs)) > 0))
        links = pa.table({"key": pa.nulls(len(pairs), pa.int64()), "node": ids[low], "dst": ids[high], "count": count.astype(np.int32), "n": need.astype(np.int32)})
        return pa.concat_tables([links, table.take(pa.array(np.flatnonzero(crowded))).drop_columns(["bucket", "root"])], promote_options="default").select(kinds)

    kinds = ["key", "node", "dst", "count", "n", *BITS_OF]
    spread = nodes.select(F.explode("prefix").alias("key"), "node", "n", "root", *BITS_OF).withColumn("bucket", F.pmod("key", F.lit(buckets)).cast("int"))
    schema = "key long, node long, dst long, count int, n int, " + ", ".join(f"{b} long" for b in BITS_OF)
    found = stored(spread.groupBy("bucket").applyInArrow(meet, schema))
    links = found.where("key is null").groupBy(F.col("node").alias("src"), "dst").agg(F.sum("count").alias("count"), F.max("n").alias("need"))
    return links.where(F.col("count") >= F.col("need")).select("src", "dst"), found.where("key is not null").drop("dst", "count")


def more_links(crowded: DataFrame, sketches: DataFrame, roots: DataFrame, done: DataFrame | None, similarity: float, pairs: int) -> tuple[DataFrame, DataFrame]:
    """(src, dst): further possible pairs of crowded shingles, of nodes that no verified links join yet; and (key, x, y, done): how far each block of rows is through.

    A crowded shingle's rows are split in blocks, which meet in pairs. Sketches
    (node, sketch) go with the rows, so that few pairs are left that are not similar.
    """
    crowded = crowded.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_keys = crowded.groupBy("key").agg(F.count("*").alias("rows"), F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    rows = crowded.join(open_keys.select("key", F.ceil(F.col("rows") / BLOCK_ROWS).cast("int").alias("blocks")), "key")
    rows = rows.withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).join(sketches, "node")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("x", F.least("side", "other")).withColumn("y", F.greatest("side", "other"))
    if done is not None:
        rows = rows.join(done, ["key", "x", "y"])
    else:
        rows = rows.withColumn("done", F.lit(0))

    def meet(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("n", "ascending"), ("node", "ascending")])
        (node, n, bits), root, side = columns_of(table), table.column("root").to_numpy(), table.column("side").to_numpy()
        a, b, at = more_pairs(root, side, n, bits, by_length(table.column("sketch").to_pylist()), similarity, table.column("done")[0].as_py(), pairs * len(node))
        if at < len(node):
            a, b = np.append(a, -1), np.append(b, -1)
        src, dst = node[a], node[b]
        through = np.full(len(a), -1)
        if at < len(node):
            through[-1] = at
        k, x, y = (v.as_py() for v in key)
        return pa.table({"key": np.full(len(a), k), "x": np.full(len(a), x, np.int32), "y": np.full(len(a), y, np.int32), "src": np.minimum(src, dst), "dst": np.maximum(src, dst), "done": through.astype(np.int32)})

    found = stored(rows.select("key", "x", "y", "node", "n", *BITS_OF, "sketch", "root", "side", "done").groupBy("key", "x", "y").applyInArrow(meet, "key long, x int, y int, src long, dst long, done int"))
    return found.where("done < 0").select("src", "dst").distinct(), found.where("done >= 0").select("key", "x", "y", "done")


def ball_pairs(nodes: DataFrame, radius: int = 4) -> DataFrame:
    """(src, dst): nodes whose fingerprints are within ``radius`` bits, as a graph with their components."""
    fps = stored(nodes.groupBy("fp").agg(F.min("node").alias("rep")))
    links, other = ball_links(fps, radius, FEW_AT_ONCE), fps.select(F.col("fp").alias("dst"), F.col("rep").alias("b"))
    apart = links.join(fps.select(F.col("fp").alias("src"), F.col("rep").alias("a")), "src").join(other, "dst").select(F.col("a").alias("src"), F.col("b").alias("dst"))
    return apart.unionByName(nodes.join(fps, "fp").where("node <> rep").select(F.col("node").alias("src"), F.col("rep").alias("dst")))


def similar(links: pa.Table, sets: pa.Table, similarity: float) -> pa.Table:
    """(src, dst: the least node) for each set that similar links connect to a lesser one; links between sets that others connect already are passed over."""
    node = sets.column("node").to_numpy()
    order = np.argsort(node, kind="stable")
    items = pa.concat_arrays(sets.column("items").chunks) if sets.num_rows else pa.array([], pa.list_(pa.int64()))
    values, bounds = items.values.to_numpy().view(np.uint64), items.offsets.to_numpy()
    a, b = (order[np.searchsorted(node, links.column(c).to_numpy(), sorter=order)] for c in ("src", "dst"))
    n = np.diff(bounds)
    first = np.argsort(np.abs(n[a] - n[b]), kind="stable")
    parent = list(range(len(node)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in zip(a[first].tolist(), b[first].tolist()):
        root, other = find(i), find(j)
        if root == other:
            continue
        x, y = values[bounds[i] : bounds[i + 1]], values[bounds[j] : bounds[j + 1]]
        both = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
        if both >= similarity * (len(x) + len(y) - both):
            parent[other] = root
    roots = np.array([find(i) for i in range(len(node))], np.int64)
    least = node.copy()
    np.minimum.at(least, roots, node)
    below = np.flatnonzero(least[roots] != node)
    return pa.table({"src": node[below], "dst": least[roots[below]]})


def plausible(links: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """The links (src, dst) between nodes whose sketches allow this similarity; never denied to two that have it."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            n = batch.num_rows
            total = batch.column(2).to_numpy().astype(np.int64) + batch.column(3).to_numpy()
            apart = bits_apart(by_length(batch.column(4).to_pylist() + batch.column(5).to_pylist()), np.arange(n), np.arange(n) + n)
            yield batch.select([0, 1]).filter(pa.array(apart <= most_apart(total, similarity)))

    a, b = (nodes.select(F.col("node").alias(c), F.col("n").alias(f"{c}_n"), F.col("sketch").alias(f"{c}_sketch")) for c in ("src", "dst"))
    both = links.join(a, "src").join(b, "dst").select("src", "dst", "src_n", "dst_n", "src_sketch", "dst_sketch")
    return both.mapInArrow(keep, "src long, dst long")


def verified(links: DataFrame, nodes: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """(src, dst): stars that connect what the similar ones of ``links`` between ``nodes`` (node, none, id, hash, n, sketch) connect.

    Sketches, small ones, drop most links that are not similar. What the others connect is put in one cell, where each set is needed once,
    and links of sets that are found connected are passed over. Cells hold the
    sets of many small components, or, of a component with more than
    ``CELL_ITEMS`` shingles, two blocks of its sets. Only ids are joined with
    links; a set is made from its text once, and goes to the cells that it has
    links in.
    """
    links = stored(plausible(links, nodes, similarity))
    comps = connected_components(links).withColumnRenamed("root", "comp")
    chosen = stored(nodes.drop("sketch").join(comps, "node"))
    sizes = chosen.groupBy("comp").agg(F.ceil(F.sum("n") / CELL_ITEMS).alias("blocks"))
    cells = max(8, math.ceil((chosen.agg(F.sum("n")).first()[0] or 0) / CELL_ITEMS))
    placed = stored(chosen.select("node", "comp").join(sizes, "comp").select("node", "comp", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("side")))
    src, dst = (placed.select(F.col("node").alias(c), "comp", "blocks", F.col("side").alias(f"{c}_side")) for c in ("src", "dst"))
    met = links.join(src, "src").join(dst.drop("comp", "blocks"), "dst")
    alone = F.col("blocks") == 1
    met = stored(
        met.select(
            "src", "dst", F.when(alone, F.pmod(F.xxhash64("comp"), F.lit(cells))).otherwise(F.col("comp")).alias("cell"),
            F.when(alone, -1).otherwise(F.least("src_side", "dst_side")).alias("x"), F.when(alone, -1).otherwise(F.greatest("src_side", "dst_side")).alias("y"),
        )
    )
    needed = met.select(F.explode(F.array("src", "dst")).alias("node"), "cell", "x", "y").distinct().groupBy("node").agg(F.collect_list(F.struct("cell", "x", "y")).alias("cells"))
    wanted = stored(chosen.select("node", "none", "id", "hash").join(needed, "node"))

    def read_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # rows with the same id and text, of which one is enough
        for batch in slices(batches):
            found = [(i, node) for i, node in enumerate(batch.column(0).to_pylist()) if node not in seen and not seen.add(node)]
            part = batch.take(pa.array([i for i, _ in found], pa.int64()))
            sets = pa.array([shingles(x, width)[1].view(np.int64) for x in part.column(2).to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), sets], ["node", "cells", "items"])

    sets = texts.join(wanted, ["none", "id", "hash"]).select("node", "cells", "raw").mapInArrow(read_sets, "node long, cells array<struct<cell: long, x: long, y: long>>, items array<long>")
    by = ["cell", "x", "y"]
    sets = sets.select("node", "items", F.explode("cells").alias("c")).select("c.*", "node", "items").repartition(*by).dropDuplicates([*by, "node"])

    def check(left: pa.Table, right: pa.Table) -> pa.Table:
        return similar(left, right, similarity)

    return stored(met.groupBy(*by).cogroup(sets.groupBy(*by)).applyInArrow(check, "src long, dst long"))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, text_hash, component, component_id) for each row: groups of texts whose shingles are similar.

    Texts of the same words are one class, and classes are linked if the Jaccard
    similarity of their distinct ``width``-word shingles is ``similarity`` or
    more. Pairs with close fingerprints are met by ball hashing first, which
    brings most copies together. But at this similarity most pairs have
    fingerprints far apart, so that classes meet by their rarest shingles too,
    of which all similar pairs have one in common, and bounds from sizes and
    parities only drop pairs that cannot be similar. Of shingles that many texts
    share, pairs are verified in rounds. The exact similarity decides in all
    cases, and only pairs that verified links join already are left out, so that
    no group is missed. Odd rows are treated as by ``near_duplicates``; texts
    without words are one class, linked to no other.
    """
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("binary").alias("raw"))

    def read_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [shingles(x, width)[1] for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["item"])

    share = min(1.0, SAMPLE_DOCS / max(1, keyed.count()))
    sample = keyed.where(F.pmod("text_hash", F.lit(1 << 40)) < max(1, int((1 << 40) * share))).dropDuplicates(["text_hash"]).select("raw")
    counted = sample.mapInArrow(read_shingles, "item long").groupBy("item").agg(F.count("*").alias("times")).where("times > 3")
    counted = counted.orderBy(F.desc("times"), "item").limit(COMMON).toArrow()
    common, times = counted.column("item").to_numpy().view(np.uint64), counted.column("times").to_numpy()
    order = np.argsort(common)
    common, times = common[order], times[order]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [shingles(x, width) for x in batch.column(2).to_pylist()]
            node = np.array([n for n, _ in found], np.uint64).view(np.int64)
            fps = np.array([majority(h) for _, h in found], np.uint64).view(np.int64)
            rarest = pa.array([prefix(h, common, times, similarity).view(np.int64) if len(h) else None for _, h in found], pa.list_(pa.int64()))
            bits = np.stack([parities(h, PARITIES) for _, h in found]).view(np.int64)
            sketches = pa.array([sketch(h) for _, h in found], pa.binary())
            sizes = pa.array([len(h) for _, h in found], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(node), sizes, pa.array(fps), *map(pa.array, bits.T.copy()), rarest, sketches], ["doc_id", "text_hash", "node", "n", "fp", *BITS_OF, "prefix", "sketch"])

    schema = "doc_id long, text_hash long, node long, n int, fp long, " + ", ".join(f"{b} long" for b in BITS_OF) + ", prefix array<long>, sketch binary"
    rows = stored(keyed.mapInArrow(read, schema))
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("text_hash").alias("hash"))
    nodes = stored(rows.groupBy("node").agg(F.min(first).alias("r"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("sketch").alias("sketch")).select("node", "r.*", "n", "fp", "sketch"))
    named, worded = nodes.drop("fp"), nodes.where("n > 0").select("node", "fp")
    texts = keyed.select(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("text_hash").alias("hash"), "raw")
    roots = stored(connected_components(verified(ball_pairs(worded), named, texts, width, similarity)))

    def joined(links: DataFrame) -> DataFrame:
        """The roots with what these links join."""
        found = verified(links, named, texts, width, similarity)
        return roots if found.isEmpty() else stored(connected_components(found.unionByName(roots.select(F.col("node").alias("src"), F.col("root").alias("dst")))))

    classes = rows.where("n > 0").dropDuplicates(["node"]).select("node", "n", *BITS_OF, "prefix")
    classes = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    many = nodes.agg(F.sum(F.col("n") - F.ceil(similarity * F.col("n")) + 1 + F.floor(F.col("n") / EACH_SHARED))).first()[0] or 0
    links, crowded = first_links(classes, many, similarity)
    roots = joined(links)
    done, pairs = None, min(FIRST_PAIRS, ROUND_PAIRS)
    while not (crowded.isEmpty() if done is None else done.isEmpty()):
        links, done = more_links(crowded, nodes.select("node", "sketch"), roots, done, similarity, pairs)
        pairs = min(2 * pairs, ROUND_PAIRS)  # few at first, as verified links spare most of the others
        if not links.isEmpty():
            roots = joined(links)
    least = nodes.select("node", F.when(~F.col("none"), F.col("id")).alias("least")).join(roots, "node", "left").withColumn("component", F.coalesce("root", "node"))
    ids = least.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = stored(least.join(ids, "component").select("node", "component", "component_id"))
    return rows.join(classes, "node").select("doc_id", "text_hash", "component", "component_id")
