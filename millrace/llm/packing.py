"""Packing token sequences into windows by minimum bin slack."""

from __future__ import annotations

import math
import os
import re
from bisect import bisect_right
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import bucketed, by_bytes, kept, slices, stored

#: Distinct words, last met, whose ids a Python worker remembers; up to as many met before them are kept too.
REMEMBERED = 250_000
#: Bytes of texts that are encoded at once (a text of more is whole).
ENCODED_BYTES = 6 << 20
#: Texts to a bucket of the stored ids, on average, and buckets at most (Spark's own limit): tasks read them as streams, however large.
BUCKET_ROWS = 16_384
BUCKETS = 100_000


class WordEncoder:
    """Ids of whole texts by a tokenizer that never joins across a space or line feed.

    Such a tokenizer drops white space and merges within words alone, so that a
    text's ids are those of its stretches between spaces, one after the other;
    each distinct stretch is encoded once. Words, letters alone, are tokens
    apart from the commas and full stops behind them, and case is dropped, so
    that both are taken off first where that changes no token.
    """

    #: A sign before a comma or full stop, which one token may hold together.
    UNSAFE = re.compile(r"[.,](?=[ \n])(?<=[\W_][.,])(?<![ \n].)")

    #: Letters, and signs that no token holds together with letters.
    SIGNED = re.compile(r"([^\W\d_]+)([!#$%&*.,;:?]+)")

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        self.remembered = remembered
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True

    @classmethod
    def shared(cls, path: str, remembered: int) -> WordEncoder:
        """One for all tasks that a Python worker runs."""
        return kept(f"words {path} {remembered}", lambda: cls(path, remembered))

    def learn(self, words: list[str]) -> None:
        """Encodes words: those of letters, which are one stretch of tokens each, many at a time; of those with signs behind, both apart; others one by one."""
        plain, signed, other = {}, [], {}
        for w in words:
            m = self.SIGNED.fullmatch(w)
            letters, signs = m.groups() if m else (w, "")
            if not letters.isalpha() or "\u0130" in letters:
                other[w] = None
            elif signs:
                signed.append((w, letters, signs))
            else:
                plain[w] = None
        plain.update((letters, None) for _, letters, _ in signed if letters not in self.known)
        other.update((signs, None) for *_, signs in signed if signs not in self.known)
        for w, found in zip(other, self.tokenizer.encode_batch_fast(list(other), add_special_tokens=False)):
            self.known[w] = np.array(found.ids, "<u4").tobytes()
        plain = list(plain)
        for at in range(0, len(plain), 512):
            part = plain[at : at + 512]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            cuts = [0, *(4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()]
            raw = ids.tobytes()
            self.known.update(zip(part, (raw[a:b] for a, b in zip(cuts, cuts[1:])), strict=True))
        self.known.update((w, self.known[letters] + self.known[signs]) for w, letters, signs in signed)

    def spaced(self, text: str) -> str:
        """The text with its words apart from commas and full stops, where its tokens stay the same."""
        # U+0130 is the one letter that has a sign when in lower case.
        if "\u0130" not in text and not self.UNSAFE.search(text):
            for sign in ",.":
                text = text.replace(f"{sign} ", f" {sign} ").replace(f"{sign}\n", f" {sign} ")
        if text.isascii() and "|>" not in text:
            text = text.lower()
        return text.replace("\n", " ")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > self.remembered:
            self.known, self.older = {}, self.known
        words = pc.split_pattern(pa.array(map(self.spaced, texts), pa.large_string()), " ")
        coded = words.values.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        known, older = self.known, self.older
        found = list(map(known.get, distinct))
        missing = [i for i, x in enumerate(found) if x is None]
        # Words that are met again outlast those that are not.
        known.update((w, older[w]) for w in map(distinct.__getitem__, missing) if w in older)
        self.learn([w for w in map(distinct.__getitem__, missing) if w not in known])
        for i in missing:
            found[i] = known[distinct[i]]
        # The ids of all words in turn, gathered from those of the distinct words.
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        at = coded.indices.to_numpy(zero_copy_only=False)
        n = sizes[at]
        ends = np.cumsum(n)
        first = (np.cumsum(sizes) - sizes)[at] - (ends - n)
        ids = np.frombuffer(b"".join(found), "<u4")[np.repeat(first, n) + np.arange(n.sum())]
        bounds = np.concatenate(([0], ends))[words.offsets.to_numpy()]
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]


@dataclass
class Plan:
    """Where the pieces of each length class go.

    For a class, the bounds at which ranks begin, and the pieces of each range
    of ranks: (first rank, start in the text, length, first sequence, pieces of
    it in a sequence, offset in the sequence).
    """

    sequences: int = 0
    rows: dict[int, list[tuple[int, int, int, int, int, int, int]]] = field(default_factory=dict)
    _bounds: dict[int, tuple[list[int], list[list[int]]]] = field(default_factory=dict)

    def pieces(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start, length, sequence, offset) of the text with this rank among those of its length."""
        if length not in self._bounds:
            rows = self.rows.get(length, [])
            bounds = sorted({r[0] for r in rows} | {r[1] for r in rows})
            within: list[list[int]] = [[] for _ in bounds]
            for k, (low, high, *_) in enumerate(rows):
                for b in range(bisect_right(bounds, low) - 1, bisect_right(bounds, high - 1)):
                    within[b].append(k)
            self._bounds[length] = bounds, within
        bounds, within = self._bounds[length]
        out = []
        for k in within[bisect_right(bounds, rank) - 1]:
            low, _, first, start, size, base, times_offset = self.rows[length][k]
            times, offset = times_offset >> 32, times_offset & 0xFFFFFFFF
            nth = first + rank - low
            out.append((start, size, base + nth // times, offset + nth % times * size))
        return sorted(out)


def fill(capacity: int, counts: dict[int, int], lengths: list[int]) -> dict[int, int]:
    """The multiset of lengths with the largest sum of at most ``capacity``: by bitset subset sums, with counts traced back.

    Bit s of ``reached`` says that some multiset sums to s. Each length enters
    in powers of two of its count, each of which is taken or not.
    """
    mask, reached, steps = (1 << (capacity + 1)) - 1, 1, []
    for length in lengths:
        left, chunk = min(counts[length], capacity // length), 1
        while left > 0:
            take = min(chunk, left)
            steps.append((length, take, reached))
            reached |= reached << (length * take) & mask
            left, chunk = left - take, chunk * 2
        if reached >> capacity & 1:
            break
    at, out = reached.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            at -= length * take
            out[length] = out.get(length, 0) + take
    return out


def plan(histogram: dict[int, int], capacity: int = 4096, least_cut: int = 16) -> Plan:
    """Packs ``histogram`` (length: how many, lengths from 1 to ``capacity``) into sequences.

    Each step puts the longest length left into a window, fills the rest by
    ``fill``, and repeats that window while the counts last; so the steps follow
    the number of lengths, at most ``capacity``, not the number of texts. Where
    the slack is ``least_cut`` or more, the longest piece left is cut to fill it.
    """
    pool: dict[int, deque[list[int]]] = {k: deque([[k, 0, 0, v]]) for k, v in histogram.items() if v > 0}
    counts = {k: v for k, v in histogram.items() if v > 0}
    out = Plan()

    def draw(length: int, many: int) -> Iterator[list[int]]:
        """[class, start, first rank, end rank] of ``many`` pieces of this length."""
        counts[length] -= many
        if not counts[length]:
            del counts[length]
        while many:
            own, start, low, high = pool[length][0]
            take = min(many, high - low)
            if take == high - low:
                pool[length].popleft()
            else:
                pool[length][0][2] += take
            many -= take
            yield [own, start, low, low + take]

    def put(length: int, source: Iterator[list[int]], times: int, offset: int) -> None:
        nth = 0
        for own, start, low, high in source:
            out.rows.setdefault(own, []).append((low, high, nth, start, length, out.sequences, times << 32 | offset))
            nth += high - low

    while counts:
        longest = max(counts)
        counts[longest] -= 1
        rest = capacity - longest
        chosen = fill(rest, counts, sorted((k for k in counts if k <= rest and counts[k] > 0), reverse=True)) if rest else {}
        counts[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(counts[k] // m for k, m in chosen.items())
        slack = capacity - sum(k * m for k, m in chosen.items())
        cut = 0
        if slack >= least_cut:
            left = {k: v - chosen.get(k, 0) for k, v in counts.items()}
            cut = max((k for k, v in left.items() if v > 0 and k > slack), default=0)
            if cut:
                times = min(times, counts[cut] // (chosen.get(cut, 0) + 1))
        offset = 0
        for length in sorted(chosen, reverse=True):
            put(length, draw(length, times * chosen[length]), chosen[length], offset)
            offset += length * chosen[length]
        if cut:
            heads = list(draw(cut, times))
            put(slack, iter([list(x) for x in heads]), 1, offset)
            for own, start, low, high in heads:
                pool.setdefault(cut - slack, deque()).append([own, start + slack, low, high])
            counts[cut - slack] = counts.get(cut - slack, 0) + times
        out.sequences += times
    return out


def encoded(path: str, capacity: int, end: int, remembered: int, at_once: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Ids of each text, its class (what is left beyond full windows) and its place among those of its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seen = WordEncoder.shared(path, remembered), TaskContext.get().partitionId(), {}
        stop = np.array([end], "<u4")
        narrow = "<u2" if max(len(encoder.ends), end + 1) <= 1 << 16 else "<u4"
        for batch in by_bytes(batches, 1, at_once):
            texts = [x or "" for x in batch.column(1).to_pylist()]
            ids, tokens, left, rank, full = [], [], [], [], []
            for found in encoder.encode(texts):
                whole = np.concatenate((found, stop))
                ids.append(whole.astype(narrow).tobytes())
                tokens.append(len(whole))
                rest = len(whole) % capacity
                left.append(rest)
                rank.append(seen.get(rest, 0))
                seen[rest] = rank[-1] + 1
                full.append(seen.get(-1, 0))
                seen[-1] = full[-1] + len(whole) // capacity
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(ids), part, np.int32)), pa.array(left, pa.int32()), pa.array(rank, pa.int64()), pa.array(full, pa.int64()), pa.array(tokens, pa.int64()), pa.array(ids, pa.binary())],
                ["row_id", "part", "rest", "rank", "full", "tokens", "ids"],
            )

    return run


def placed(found: Plan, capacity: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row for each piece: those that fill a sequence come after the plan's sequences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 512):
            owner, columns, parts = [], ([], [], [], [], []), []
            for i, r in enumerate(batch.select(["rest", "rank", "full", "tokens", "ids"]).to_pylist()):
                n = r["tokens"]
                raw = np.frombuffer(r["ids"], "<u2" if len(r["ids"]) == 2 * n else "<u4").astype("<u4").tobytes()
                pieces = [(k * capacity, capacity, found.sequences + r["full"] + k, 0) for k in range(n // capacity)]
                if r["rest"]:
                    pieces += [(n - r["rest"] + a, size, s, o) for a, size, s, o in found.pieces(r["rest"], r["rank"])]
                for a, size, s, o in pieces:
                    owner.append(i)
                    for column, x in zip(columns, (a, size, n, s, o)):
                        column.append(x)
                    parts.append(raw[4 * a : 4 * (a + size)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner, pa.int64())), *(pa.array(c, pa.int64()) for c in columns), pa.array(parts, pa.binary())],
                ["row_id", "start", "length", "text_tokens", "sequence_id", "offset", "ids"],
            )

    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, end: int = 2, least_cut: int = 16, remembered: int = REMEMBERED, at_once: int = ENCODED_BYTES) -> DataFrame:
    """Pieces of ``docs`` in sequences of at most ``capacity`` ids: (row_id, start, length, text_tokens, sequence_id, offset, ids: little-endian uint32).

    Each text's ids, ``end`` last, are cut into full windows and a rest; the
    rests are placed by ``plan`` from the counts of their lengths alone. Ids are
    encoded once, stored in buckets by the task that made them, and never
    shuffled or broadcast: what meets them there is one row for each such task,
    of how many texts of each length the tasks before it have. Concatenating
    the pieces of a sequence by offset gives its ids without gaps.

    ``remembered`` (words whose ids a worker keeps) and ``at_once`` (bytes of
    texts encoded at a time) trade memory for time, and change no result.

    A null or empty text is the id ``end`` alone; rows with the same or no id are
    packed each for itself; an empty table gives no pieces.
    """
    rows = docs.select(F.col(id_col).alias("row_id"), F.col(text_col).alias("text"))
    kind = rows.schema["row_id"].dataType.simpleString()
    # With fewer buckets than shuffles have partitions, Spark would shuffle the ids to have as many.
    buckets = min(BUCKETS, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(docs.count() / BUCKET_ROWS)))
    ids = rows.mapInArrow(encoded(tokenizer, capacity, end, remembered, at_once), f"row_id {kind}, part int, rest int, rank long, full long, tokens long, ids binary")
    ids = bucketed(ids, "part", buckets)
    # A class is a length of rests, or 0 for full windows.
    counts = ids.groupBy("part", "rest").agg(F.count("*").alias("n"), F.sum(F.floor(F.col("tokens") / capacity)).alias("whole"))
    counts = counts.select("part", F.explode(F.array(F.struct(F.col("rest").alias("class"), F.when(F.col("rest") > 0, F.col("n")).otherwise(0).alias("n")), F.struct(F.lit(0).alias("class"), F.col("whole").alias("n")))).alias("c")).select("part", "c.*")
    counts = counts.where("class > 0 or n > 0").groupBy("part", "class").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranked = stored(counts.withColumn("ranked", F.coalesce(F.sum("n").over(before), F.lit(0))))
    histogram = {r["class"]: r.n for r in ranked.where("class > 0").groupBy("class").agg(F.sum("n").alias("n")).collect()}  # fewer rows than ``capacity``
    found = plan(histogram, capacity, least_cut)
    offsets = ranked.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("class", "ranked"))).alias("before"))

    def shifted(own: str, of: Column) -> Column:
        return (F.col(own) + F.coalesce(F.col("before")[of], F.lit(0))).alias(own)

    ready = ids.join(offsets.hint("shuffle_hash"), "part").select("row_id", "rest", shifted("rank", F.col("rest")), shifted("full", F.lit(0)), "tokens", "ids")
    return ready.mapInArrow(placed(found, capacity), f"row_id {kind}, start long, length long, text_tokens long, sequence_id long, offset long, ids binary")


def digests(pieces: DataFrame) -> DataFrame:
    """The contract's columns."""
    return pieces.select(
        F.col("row_id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), F.col("text_tokens").alias("doc_tokens"), "sequence_id", "offset"
    )
