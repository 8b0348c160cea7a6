"""Benchmark decontamination: a prefix-filtered join of item windows with documents."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored

#: Bytes of item texts that one index is made of. A larger benchmark is joined
#: in blocks of this size, each over all documents.
BLOCK_BYTES = 16 << 20

#: Bytes that are no part of a word become spaces, A-Z becomes a-z.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
MIX = 0x9E3779B97F4A7C15


def words_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(FOLD).split()


def grams(ids: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the shingles of ``width`` words that are all known (id over 0)."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    known = np.concatenate(([0], np.cumsum(ids > 0)))
    at = np.flatnonzero(known[width:] - known[:-width] == width)
    h = np.zeros(len(at), np.uint64)
    for j in range(width):
        h = (h ^ ids[at + j].astype(np.uint64)) * np.uint64(MIX)
        h ^= h >> np.uint64(29)
    return at, h


@dataclass
class Index:
    """The windows of some items, and the shingles that find them."""

    vocabulary: dict[bytes, int]
    windows: list[np.ndarray]  # word ids
    items: list[list[str]]  # of each window
    shingles: dict[int, np.ndarray]  # by width: the sorted hashes of all shingles of windows

    def ids(self, words: list[bytes]) -> np.ndarray:
        get = self.vocabulary.get
        return np.array([get(w, 0) for w in words], np.int64)

    @classmethod
    def of(cls, rows: list[tuple[str, bytes | None]], window: int, width: int) -> Index:
        vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], dict[str, None]] = {}
        for item, raw in rows:
            ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(raw)]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                found.setdefault(tuple(ids[at : at + window]), {})[item] = None
        windows = [np.array(w, np.int64) for w in found]
        by_width: dict[int, list[np.ndarray]] = {}
        for w in windows:
            by_width.setdefault(min(width, len(w)), []).append(grams(w, min(width, len(w)))[1])
        return cls(vocabulary, windows, [list(x) for x in found.values()], {k: np.unique(np.concatenate(v)) for k, v in by_width.items()})

    def places(self, width: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of a text's shingles that the index has, and their numbers there."""
        at, h = grams(ids, width)
        known = self.shingles[width]
        number = np.minimum(np.searchsorted(known, h), len(known) - 1)
        hit = known[number] == h
        return at[hit], number[hit]

    def prefixes(self, width: int, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each shingle in order: where its windows begin in the two arrays, windows and the shingle's offset in each.

        A text that holds a window holds all of its shingles, so the one that is
        rarest over the corpus is necessary, and alone enough to look for.
        """
        entries = []
        for k, w in enumerate(self.windows):
            if min(self.width, len(w)) == width:
                at, number = self.places(width, w)
                best = min(range(len(at)), key=lambda i: (counts[number[i]], number[i], i))
                entries.append((number[best], k, at[best]))
        entries.sort()
        table = np.array(entries, np.int64).reshape(-1, 3)
        return np.searchsorted(table[:, 0], np.arange(len(self.shingles[width]) + 1)), table[:, 1], table[:, 2]

    @property
    def width(self) -> int:
        return max(self.shingles, default=0)


def counted(index: Index) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts, over a partition's texts, of the index's shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {k: np.zeros(len(v), np.int64) for k, v in index.shingles.items()}
        for batch in slices(batches):
            for raw in batch.column(0).to_pylist():
                ids = index.ids(words_of(raw))
                for width, sums in total.items():
                    number = index.places(width, ids)[1]
                    if len(number):
                        sums += np.bincount(number, minlength=len(sums))
        for width, sums in total.items():
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), width)), pa.array(at), pa.array(sums[at])], ["width", "number", "n"])

    return run


def joined(index: Index, prefixes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each text: its words, the covered stretches and the items that occur."""

    def hits(ids: np.ndarray) -> tuple[np.ndarray, set[str]]:
        step, items = np.zeros(len(ids) + 1, np.int64), set()
        for width, (begin, window, offset) in prefixes.items():
            at, number = index.places(width, ids)
            keep = begin[number + 1] > begin[number]
            for a, s in zip(at[keep].tolist(), number[keep].tolist()):
                for e in range(begin[s], begin[s + 1]):
                    want, start = index.windows[window[e]], a - int(offset[e])
                    if start < 0 or start + len(want) > len(ids):  # the bounds by position and length
                        continue
                    if np.array_equal(ids[start : start + len(want)], want):
                        step[start] += 1
                        step[start + len(want)] -= 1
                        items.update(index.items[window[e]])
        return np.diff(np.concatenate(([0], np.cumsum(step) > 0, [0])).astype(np.int8)), items

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n, spans, names = [], [], []
            for raw in batch.column(1).to_pylist():
                words = words_of(raw)
                edge, items = hits(index.ids(words)) if words else (np.zeros(0, np.int8), set())
                n.append(len(words))
                spans.append([{"start": a, "stop": b} for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())])
                names.append(sorted(items))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), pa.array(names, pa.list_(pa.string()))],
                ["row_id", "n_words", "spans", "items"],
            )

    return run


def merged(spans: list[dict[str, int]]) -> list[dict[str, int]]:
    out: list[dict[str, int]] = []
    for s in sorted(spans, key=lambda s: (s["start"], s["stop"])):
        if out and s["start"] <= out[-1]["stop"]:
            out[-1]["stop"] = max(out[-1]["stop"], s["stop"])
        else:
            out.append(dict(s))
    return out


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = pa.array([merged(x) for x in batch.column(2).to_pylist()], batch.schema.field(2).type)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), spans, batch.column(3)], batch.schema.names)


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = 13, width: int = 5, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(row_id: doc_id, n_words, spans: covered [start, stop) word positions, items) for each row of ``docs``.

    Items are cut into windows of ``window`` words (shorter items are one);
    windows are sets of shingles of ``width`` words, ordered by their count over
    all documents, and the rarest of each, the prefix that full containment
    needs, is joined with the documents' shingles. Position and length bound the
    candidates; the words of the item-sized window then decide.

    The index holds ``block_bytes`` of item texts at most; a larger benchmark
    takes several passes over the documents. A null or empty text has no words
    and no hits, such an item no windows; rows with the same or no id are each
    judged; a null item_id is named "null". An empty benchmark hits nothing.
    """
    item = F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item")
    items = benchmark.select(item, F.col(item_text_col).cast("binary").alias("raw"))
    size = items.agg(F.sum(F.length("raw"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    rows = docs.select(F.col(id_col).alias("row_id"), F.col(text_col).cast("binary").alias("raw"))
    if blocks > 1:
        rows = stored(rows.select(F.struct("row_id", F.monotonically_increasing_id().alias("nr")).alias("row_id"), "raw"))
    kind = rows.schema["row_id"].dataType.simpleString()
    parts = []
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item", "raw"), F.lit(blocks)) == k)
        index = Index.of([(r.item, bytes(r.raw) if r.raw is not None else None) for r in block.collect()], window, width)
        counts = {w: np.zeros(len(v), np.int64) for w, v in index.shingles.items()}
        sums = rows.select("raw").mapInArrow(counted(index), "width long, number long, n long").groupBy("width", "number").agg(F.sum("n").alias("n"))
        for r in sums.collect() if index.windows else []:  # at most a row for each shingle of the index
            counts[r.width][r.number] = r.n
        prefixes = {w: index.prefixes(w, c) for w, c in counts.items()}
        parts.append(rows.mapInArrow(joined(index, prefixes), f"row_id {kind}, n_words long, spans array<struct<start: long, stop: long>>, items array<string>"))
    if blocks == 1:
        return parts[0]
    all_parts = parts[0]
    for p in parts[1:]:
        all_parts = all_parts.unionByName(p)
    whole = all_parts.groupBy("row_id").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    return whole.mapInArrow(_merge, whole.schema).select(F.col("row_id.row_id").alias("row_id"), "n_words", "spans", "items")


def judged(found: DataFrame, share: int = 20) -> DataFrame:
    """The contract's columns: a document is contaminated from one word in ``share`` on."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s.stop - s.start)
    return found.select(
        F.col("row_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
