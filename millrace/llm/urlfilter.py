"""URL filters: rules by host and path, and logistic regression on hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

# The words that labelled urls are made of. First what names sites that filters
# commonly block: gambling, medicines, adult, loans, malware, spam and advertising.
BAD_WORDS = (
    "casino poker slots jackpot roulette betting bets gambling lottery pills viagra pharma meds cialis steroids weightloss adult porn xxx sex nude escort cams "
    "dating loans payday credit debt malware keygen crack warez torrent phishing spam seo backlinks linkfarm clickbait popunder adserver ads advert banner tracker tracking pixel"
).split()
#: Words that stand beside these, and beside harmless ones too.
EITHER_WORDS = "free cheap best online fast win bonus hot top buy sale offers deals now club farm track world zone store".split()
GOOD_WORDS = (
    "library museum garden weather recipes travel history science school music theatre bakery bicycle hiking orchard village council university poetry photo journal "
    "kitchen harbour railway football chess painting geology physics medicine nursing market bookshop pottery knitting sailing birds forest river castle archive radio"
).split()
SYLLABLES = "ba be bi bo da de do el en er fa fi ga ge he in is ka ke la le li lo ma me mi na ne no on or pa pe ra re ri ro sa se so st ta te th ti to un va ve wi".split()
ENDINGS = "com net org info example.com example.net example.org".split()
SUBDOMAINS = ("", "", "www.", "m.", "blog.", "news.")
BAD_PATHS = "/win-now /order /claim-prize /buy-cheap /cams/live /download/crack.exe /click?id=9 /bonus /free-pills".split()
GOOD_PATHS = "/ /en/12 /fr/480/ /de/7.html /es/2021 /about /wiki/Photosynthesis /2021/05/local-news /guide/install.html /thread/4412 /index.php /catalog/books".split()
#: Labelled urls made of each kind.
MADE = 1200
#: The rules of the contract: host and path that follow, and the verdict.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

GRAMS = (3, 4, 5)
DIMENSIONS = 1 << 18
#: Labelled urls and rules that the driver takes at most.
TRAINING_ROWS = 100_000
MOST_RULES = 1_000_000
MIX = np.uint64(0x9E3779B97F4A7C15)


def host_and_path(url: object) -> tuple[object, object]:
    """As columns: what follows the first ``://`` up to a slash, ``?``, ``#`` or the end, A-Z in lower case; then up to ``?`` or ``#``. Else both empty."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def grams(texts: list[bytes], kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Owners and buckets of the n-grams of texts, all at once. Texts have a mark at either end; hosts (kind 1) and paths (2) share no n-gram."""
    sizes = np.fromiter((len(t) + 2 for t in texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(b"\x02" + t + b"\x03" for t in texts), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    owners, buckets = [], []
    for n in GRAMS:
        if len(data) < n:
            continue
        h = np.full(len(data) - n + 1, 8 * kind + n, np.uint64)
        for j in range(n):
            h = (h ^ data[j : len(data) - n + 1 + j]) * MIX
            h ^= h >> np.uint64(31)
        own = owner[: len(h)] == owner[n - 1 :]
        owners.append(owner[: len(h)][own])
        buckets.append((h[own] % np.uint64(DIMENSIONS)).astype(np.int64))
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(owners), np.concatenate(buckets)


Parts = tuple[bytes, bytes]


def features(urls: list[Parts]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owners, buckets and values of the n-grams of (host, path): counts over the root of their number, for host and path apart."""
    found = []
    for kind in (1, 2):
        owner, bucket = grams([u[kind - 1] for u in urls], kind)
        norm = 1 / np.sqrt(np.maximum(1, np.bincount(owner, minlength=len(urls))))
        found.append((owner, bucket, norm[owner]))
    return tuple(np.concatenate(x) for x in zip(*found))


class Classifier:
    """Logistic regression: full-batch gradient steps on hashed n-grams of host and path."""

    def __init__(self, urls: list[Parts], labels: list[int], rounds: int = 600, rate: float = 40.0, ridge: float = 1e-3) -> None:
        self.weights, self.constant = np.zeros(DIMENSIONS), 0.0
        y, n = np.array(labels, float), len(urls)
        owner, bucket, value = features(urls)
        used, place = np.unique(bucket, return_inverse=True)
        w = np.zeros(len(used))
        for _ in range(rounds):
            gap = (self.logistic(np.bincount(owner, w[place] * value, n) + self.constant) - y) / max(1, n)
            w -= rate * (np.bincount(place, gap[owner] * value, len(used)) + ridge * w / max(1, n))
            self.constant -= rate * 0.1 * gap.sum()
        self.weights[used] = w

    @staticmethod
    def logistic(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def scores(self, urls: list[Parts]) -> np.ndarray:
        owner, bucket, value = features(urls)
        return self.logistic(np.bincount(owner, self.weights[bucket] * value, len(urls)) + self.constant)


def made_urls(many: int = MADE, seed: int = 11) -> list[tuple[str, int]]:
    """(url, 1 to block): a small labelled table made by rule from the word lists, independent of any page.

    Hosts to block hold a bad word, alone or beside another; harmless ones hold
    good words, words that stand beside either, or names of random syllables.
    """
    rng = np.random.default_rng(seed)

    def pick(words: list[str] | tuple[str, ...]) -> str:
        return str(words[rng.integers(len(words))])

    def name(kind: int) -> str:
        syllables = "".join(pick(SYLLABLES) for _ in range(rng.integers(2, 5)))
        if kind:
            pair = [pick(BAD_WORDS), pick((*BAD_WORDS, *EITHER_WORDS, *EITHER_WORDS, syllables))]
            pair = pair[:: 1 if rng.random() < 0.5 else -1]
        elif rng.random() < 0.5:
            pair = [syllables]
        else:
            pair = [pick((*GOOD_WORDS, *EITHER_WORDS)), pick((*GOOD_WORDS, syllables))]
        return pick(("", "-", "-")).join(pair[: rng.integers(1, 3)] if not kind else pair)

    out = []
    for kind in (0, 1):
        for _ in range(many):
            path = pick(BAD_PATHS if kind and rng.random() < 0.2 else GOOD_PATHS)
            out.append((f"https://{pick(SUBDOMAINS)}{name(kind)}.{pick(ENDINGS)}{path}", kind))
    return out


def trained(urls: list[Parts], labels: list[int]) -> tuple[Classifier, float]:
    """The classifier, and the score from which urls are blocked: the one of fewest errors on a fifth of them that a first classifier has not seen."""
    y = np.array(labels)
    kept = np.arange(len(urls)) % 5 != 0
    first = Classifier([u for u, k in zip(urls, kept) if k], y[kept].tolist())
    score = first.scores([u for u, k in zip(urls, kept) if not k])
    order = np.argsort(score)
    bad = y[~kept][order]
    # Errors where those from the k-th on are blocked: the bad before it, and the harmless from it on.
    errors = np.concatenate(([0], np.cumsum(bad))) + (1 - bad).sum() - np.concatenate(([0], np.cumsum(1 - bad)))
    best = np.flatnonzero(errors == errors.min())
    edges = np.concatenate(([0.0], score[order], [1.0]))
    middle = best[len(best) // 2]
    return Classifier(urls, labels), float((edges[middle] + edges[middle + 1]) / 2)


def rule_of(host: str, path: str, rules: dict[str, list[tuple[str, str]]]) -> tuple[str, str] | None:
    """(rule, verdict) of the longest rule that fits the host or a domain it is under."""
    best: tuple[int, str, str] | None = None
    labels = host.split(".")
    for i in range(len(labels)):
        name = ".".join(labels[i:])
        for prefix, verdict in rules.get(name, ()):
            if path.startswith(prefix) and (best is None or (len(name) + len(prefix), name + prefix) > best[:2]):
                best = len(name) + len(prefix), name + prefix, verdict
    return best and best[1:]


def filtered(
    pages: DataFrame, rules: list[tuple[str, str]] | tuple[tuple[str, str], ...] = RULES, labelled: list[tuple[str, int]] | None = None, id_col: str = "page_id", url_col: str = "url", threshold: float | None = None
) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for each row.

    ``rules``: (host and path, allow or block), ``MOST_RULES`` at most;
    ``labelled``: (url, 1 to block), ``TRAINING_ROWS`` at most, by default
    ``made_urls``; more of either is an error. The classifier trained on these
    decides where no rule fits, from ``threshold`` on, by default the one that
    ``trained`` sets. A url that is null or without ``://`` has an empty host
    and path, and is allowed if no rule fits. Repeated rows repeat; an empty
    table stays empty; other columns are ignored.
    """
    spark = pages.sparkSession
    labelled = made_urls() if labelled is None else labelled
    if len(labelled) > TRAINING_ROWS or len(rules) > MOST_RULES:
        raise ValueError("too many labelled urls or rules for the driver")
    host, path = host_and_path(F.col("url"))
    train = spark.createDataFrame(labelled, "url string, label int").select(host.alias("host"), path.alias("path"), "label").collect()
    model, set_at = trained([(r.host.encode(), r.path.encode()) for r in train], [r.label for r in train])
    least = set_at if threshold is None else threshold
    by_host: dict[str, list[tuple[str, str]]] = {}
    for rule, verdict in rules:
        name, slash, rest = rule.partition("/")
        by_host.setdefault(name.lower(), []).append((slash + rest, verdict))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            score = model.scores([(h.encode(), p.encode()) for h, p in zip(hosts, paths)])
            score[[not h and not p for h, p in zip(hosts, paths)]] = 0.0
            found = [rule_of(h, p, by_host) for h, p in zip(hosts, paths)]
            verdict = [f[1] if f else "block" if s >= least else "allow" for f, s in zip(found, score.tolist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f and f[0] for f in found], pa.string()), pa.array(verdict, pa.string()), pa.array(score)], ["page_id", "host", "path", "rule", "verdict", "score"]
            )

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url")).select("page_id", host.alias("host"), path.alias("path"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string, score double")
