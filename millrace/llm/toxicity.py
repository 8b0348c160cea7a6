"""Toxicity: Levenshtein automata over a lexicon trie, and scores of the words around."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import released, slices, stored

# Common insults with which a lexicon begins; the rest is learned from labels.
SEEDS = (
    "arschloch bastard bitch clown connard cretin crétin cunt degenerate dickhead disgusting dumbass dumb fool fuck fucker gilipollas hurensohn idiot idiota "
    "imbecile imbécil imbécile jerk loser miststück moron pathetic pendejo puta retard salaud salope scum scumbag shit stupid trash trottel vermin whore worthless wichser"
).split()
#: Words near a hit that speak to somebody, and that report what somebody said.
ADDRESS = frozenset("you your you're youre u ur du dein deine dich ihr tu ton ta toi vous votre tú tu eres usted vos such so total absolute".split())
REPORT = frozenset("said says say called calls word words term terms quote quoted quotes wrote writes insult insults slur slurs sagte nannte wort dit appelé mot dijo llamó palabra".split())
QUOTES = "\"'“”‘’«»„`"
#: Words on either side of a hit that its context takes in.
CONTEXT = 4

#: Labelled rows that lexicon and weights are fitted on at most (in expectation), and terms that may get into the lexicon by chance (in expectation).
TRAINING_ROWS = 20_000
FALSE_TERMS = 0.05
STEMS = (4, 5, 6)
WORD = re.compile(r"[^\W_]+")
#: Words whose verdict a task remembers, and states of the automaton.
REMEMBERED = 100_000
STATES = 50_000

FEATURES = 7


def allowed(length: int, stem: bool) -> int:
    """Edits that a term of this length may have: two from 10 letters on, one from 5; stems one from 8 on, as what follows them is free."""
    return int(length >= 8) if stem else (length >= 5) + (length >= 10)


Reached = dict[tuple[int, str], int]


class Automaton:
    """The Levenshtein automata of all terms, run at once over their trie.

    A state is the set of trie nodes that can have been reached, each with the
    fewest edits; states and their moves are made when a word first needs them.
    Edits are letters put in, left out, replaced, or swapped with the next one:
    a node can wait for the first of two swapped letters. A term that ends in
    ``*`` is a stem: it accepts words that begin with it.
    """

    def __init__(self, terms: dict[str, float]) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.end: dict[int, tuple[int, bool, float]] = {}  # node: edits allowed, stem, weight
        self.limit = [0]
        for term, weight in terms.items():
            word, stem = term.removesuffix("*"), term.endswith("*")
            node, most = 0, allowed(len(word), stem)
            for c in word:
                self.limit[node] = max(self.limit[node], most)
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.limit.append(0)
                node = self.children[node][c]
            self.limit[node] = max(self.limit[node], most)
            if node not in self.end or self.end[node][2] < weight:
                self.end[node] = most, stem, weight
        self.alphabet = {c for x in self.children for c in x}
        self.reset()

    def reset(self) -> None:
        self.numbers: dict[tuple[tuple[tuple[int, str], int], ...], int] = {}
        self.states: list[tuple[tuple[tuple[int, str], int], ...]] = []
        self.moves: list[dict[str, int]] = []
        self.stems: list[tuple[int, float] | None] = []
        self.begin = self.state({(0, ""): 0})

    def state(self, reached: Reached) -> int:
        """The number of a state, after the moves that skip a letter of a term."""
        todo = [at for at in reached if not at[1]]
        while todo:
            at = todo.pop()
            for child in self.children[at[0]].values():
                e = reached[at] + 1
                if e <= self.limit[child] and e < reached.get((child, ""), 9):
                    reached[child, ""] = e
                    todo.append((child, ""))
        key = tuple(sorted(reached.items()))
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
            self.stems.append(self.verdict(key, stems=True))
        return self.numbers[key]

    def verdict(self, key: tuple[tuple[tuple[int, str], int], ...], stems: bool) -> tuple[int, float] | None:
        """(edits, weight) of the best term that ends here: fewest edits, then the largest weight."""
        ends = [(e, -self.end[n][2]) for (n, wait), e in key if not wait and n in self.end and e <= self.end[n][0] and (self.end[n][1] or not stems)]
        e, w = min(ends, default=(0, 1.0))
        return None if w > 0 else (e, -w)

    def move(self, at: int, c: str) -> int:
        reached: Reached = {}

        def reach(node: int, wait: str, e: int) -> None:
            if e <= self.limit[node]:
                reached[node, wait] = min(e, reached.get((node, wait), 9))

        for (node, wait), e in self.states[at]:
            if wait:  # the letter before stood for the second of two, so that this has to be the first
                if wait == c:
                    reach(node, "", e)
                continue
            child = self.children[node].get(c)
            if child is not None:
                reach(child, "", e)
            if e < self.limit[node]:
                reach(node, "", e + 1)
                for first, other in self.children[node].items():
                    reach(other, "", e + 1)
                    swapped = self.children[other].get(c)
                    if swapped is not None and first != c:
                        reach(swapped, first, e + 1)
        return self.state(reached) if reached else -1

    def match(self, word: str) -> tuple[int, float, bool] | None:
        """(edits, weight, by a stem) of the term nearest to a word, None if none is near enough."""
        if len(self.states) > STATES:
            self.reset()
        at, stem = self.begin, None
        for c in word:
            c = c if c in self.alphabet else "\0"
            to = self.moves[at].get(c)
            if to is None:
                to = self.moves[at][c] = self.move(at, c)
            if to < 0:
                return (*stem, True) if stem else None
            at = to
            if self.stems[at] and (stem is None or self.stems[at][0] < stem[0]):
                stem = self.stems[at]
        whole = self.verdict(self.states[at], stems=False)
        if whole and (stem is None or whole <= stem):
            return (*whole, False)
        return (*stem, True) if stem else None


class Reader:
    """Turns texts into features."""

    def __init__(self, terms: dict[str, float]) -> None:
        self.automaton = Automaton(terms)
        self.known: dict[str, tuple[int, float, bool] | None] = {}

    def hit(self, word: str) -> tuple[int, float, bool] | None:
        try:
            return self.known[word]
        except KeyError:
            found = self.known[word] = self.automaton.match(word)
            return found

    def features(self, text: str | None) -> list[float]:
        """Weights of exact, misspelled and stem hits (sums and the largest), of quoted and addressed hits, and their density."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        low = (text or "").lower()
        words = WORD.findall(low)
        hits = {w: h for w in set(words) if (h := self.hit(w))}
        exact = fuzzy = most = quoted = addressed = 0.0
        if hits:
            spans = [m.span() for m in WORD.finditer(low)]
            for i, w in enumerate(words):
                if h := hits.get(w):
                    edits, weight, _ = h
                    a, b = spans[i]
                    around = {*words[max(0, i - CONTEXT) : i], *words[i + 1 : i + 1 + CONTEXT]}
                    # A word alone between quotation marks, or one that a report names, is quoted.
                    told = (low[a - 1 : a] in QUOTES and low[a - 1 : a] != "" and low[b : b + 1] in QUOTES and low[b : b + 1] != "") or bool(around & REPORT)
                    quoted += weight * told
                    addressed += weight * (not told and bool(around & ADDRESS))
                    exact += weight * (edits == 0 and not told)
                    fuzzy += weight * (edits > 0 and not told) / max(edits, 1)
                    most = max(most, weight * (not told) / (1 + edits))
        total = exact + fuzzy
        return [math.log1p(exact), math.log1p(fuzzy), most, math.log1p(quoted), math.log1p(addressed), total / (10 + len(words)), float(exact > 0)]


@dataclass
class Model:
    terms: dict[str, float]
    weights: np.ndarray  # of the features, then the constant
    centre: np.ndarray
    scale: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.centre) / self.scale) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def bucket(word: str) -> int:
    """A number from 0 to 62 for a word, the same in every process."""
    h = 7
    for c in word[-6:]:
        h = (h * 31 + ord(c)) % 1_000_003
    return h % 63


def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each word and stem: how many texts of either label have it, and after which words it stands in toxic ones."""
    seen: tuple[Counter[str], Counter[str]] = Counter(), Counter()
    before: dict[str, int] = {}

    def flush() -> pa.RecordBatch:
        keys = list(seen[0] | seen[1])
        columns = [pa.array(keys, pa.string()), pa.array([seen[0][k] for k in keys], pa.int64()), pa.array([seen[1][k] for k in keys], pa.int64()), pa.array([before.get(k, 0) for k in keys], pa.int64())]
        for x in (*seen, before):
            x.clear()
        return pa.RecordBatch.from_arrays(columns, ["term", "clean", "toxic", "places"])

    for batch in slices(batches):
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = WORD.findall((text or "").lower())
            own = set(words)
            seen[toxic].update(own)
            seen[toxic].update({w[:k] + "*" for w in own for k in STEMS if len(w) > k})
            if toxic:
                last = ""
                for w in words:
                    bit = 1 << bucket(last)
                    for term in (w, *(w[:k] + "*" for k in STEMS if len(w) > k)):
                        before[term] = before.get(term, 0) | bit
                    last = w
        if len(seen[0]) + len(seen[1]) > 1_000_000:
            yield flush()
    yield flush()


def lexicon(found: list[tuple[str, int, int, float]], toxic: int, clean: int) -> dict[str, float]:
    """Terms and weights from (term, clean texts, toxic texts, log likelihood ratio); words that a chosen stem begins are left out."""
    weight = {t: math.log((k + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1)) for t, c, k, _ in found}
    # A stem has to be more than one of its words, and than a longer stem.
    family: dict[str, int] = {}
    for t, _, k, _ in found:
        word = t.removesuffix("*")
        for size in STEMS:
            if len(word) > size or (len(word) == size and not t.endswith("*")):
                share = 0.95 if t.endswith("*") else 0.6
                family[word[:size] + "*"] = max(family.get(word[:size] + "*", 0), int(k / share))
    stems = {t.removesuffix("*") for t, _, k, _ in found if t.endswith("*") and k > family.get(t, 0)}
    out = {s: 2.0 for s in SEEDS}
    for term, *_ in found:
        word = term.removesuffix("*")
        if term.endswith("*") and word not in stems:
            continue
        if any(word.startswith(s) and word != s and weight[term] <= weight[s + "*"] + 0.7 for s in stems):
            continue
        out[term] = weight[term]
    return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights and constant, by Newton's method."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    penalty = np.diag([*[ridge] * x.shape[1], 1e-3])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty, a.T @ (y - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(id_col: str) -> Column:
    """Rows never learned from: crc32 of the id as text leaves 2 by 4. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id", label_col: str = "toxic", training_rows: int = TRAINING_ROWS) -> Model:
    """Learns lexicon and weights from labelled rows that are not held out.

    A document with several labels has the largest; null labels count as none.
    Equal texts count once. Where more than ``training_rows`` are left, a share
    of them is taken by a hash of the text. A term must be more frequent in toxic
    texts than chance makes any of those tried (likelihood ratio, by their
    number and ``FALSE_TERMS``), and stand after different words there, so that many copies of one text prove nothing. With no labels, the
    seed terms and a fixed weight are used.
    """
    marks = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(label_id_col).alias("id")).agg((F.max(label_col) > 0).cast("int").alias("toxic"))
    rows = docs.where(~held_out(id_col)).select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # Only ids and hashes are shuffled; the texts of the chosen rows are read again.
    hashed = rows.select("id", F.xxhash64("text").alias("h"))
    keys = stored(hashed.join(marks, "id").groupBy("h").agg(F.min(F.struct("id", "toxic")).alias("r")).select("h", "r.id", "r.toxic"))
    share = min(1.0, training_rows / max(1, keys.count()))
    keys = F.broadcast(keys.where(F.pmod("h", F.lit(1 << 40)) < max(1, int((1 << 40) * share))))
    rows = rows.withColumn("h", F.xxhash64("text")).join(keys, ["id", "h"]).dropDuplicates(["h"])
    rows = stored(rows.select("text", "toxic"))
    sizes = {r.toxic: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    found = []
    if toxic and clean:
        sums = rows.select("text", "toxic").mapInArrow(evidence, "term string, clean long, toxic long, places long")
        sums = sums.groupBy("term").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("k"), F.bit_or("places").alias("b"))
        # Different places, by linear counting over 63 bits; no more toxic texts count than places, and clean ones in the same proportion.
        places = F.round(-63 * F.log(1 - F.least(F.bit_count("b").cast("double"), F.lit(62.5)) / 63))
        k = F.least(F.col("k").cast("double"), places)
        c = F.col("c") * k / F.col("k")
        base = toxic / (toxic + clean)
        both = k + c
        ratio = 2 * (k * F.log(k / (both * base)) + F.when(c > 0, c * F.log(c / (both * (1 - base)))).otherwise(0.0))
        sums = stored(sums.where("k >= 3").select("term", "c", "k", ratio.alias("ratio"), (k > 3 * base * both).alias("more")))
        # The more terms are tried, the more of them look toxic by chance.
        least = 2 * math.log(max(1, sums.count()) / FALSE_TERMS)
        sums = sums.where((F.col("ratio") > least) & F.col("more"))
        found = [(r.term, r.c, r.k, r.ratio) for r in sums.orderBy(F.desc("ratio"), "term").collect()]  # what the training rows prove: their number bounds it
    terms = lexicon(found, toxic, clean)
    if not (toxic and clean):
        return Model(terms, np.array([0.0] * (FEATURES - 1) + [4.0, -3.0]), np.zeros(FEATURES), np.ones(FEATURES))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(terms)
        for batch in slices(batches):
            x = [reader.features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(x, pa.list_(pa.float64()))], ["toxic", "x"])

    got = rows.select("text", "toxic").mapInArrow(read, "toxic int, x array<double>").groupBy("toxic", "x").agg(F.count("*").alias("n")).toArrow()
    x = np.array(got.column("x").to_pylist()).reshape(-1, FEATURES)
    times = got.column("n").to_numpy()
    x, y = np.repeat(x, times, axis=0), np.repeat(got.column("toxic").to_numpy(), times).astype(float)
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    return Model(terms, logistic((x - centre) / scale, y), centre, scale)


def scoring(model: Model) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        released()
        reader = Reader(model.terms)
        for part in parts:
            for at in range(0, len(part), 1024):
                x = [reader.features(t.as_py()) for t in part.slice(at, 1024)]
                if at == 0:
                    out = []
                out.append(model.score(np.array(x).reshape(-1, FEATURES)))
            yield pa.array(np.concatenate(out) if len(part) else np.zeros(0))

    return run


def scored(docs: DataFrame, model: Model, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with the column ``out`` (0 to 1) from the text alone.

    Every row is scored, whole; null and empty texts like texts without hits.
    Repeated rows repeat, an empty table stays empty, and a column that has the
    name ``out`` already is replaced.
    """
    return docs.withColumn(out, F.arrow_udf(scoring(model), "double")(F.col(text_col)))
