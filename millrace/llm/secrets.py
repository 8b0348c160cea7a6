"""Secret scans: base patterns, and multipart credentials linked within scopes."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

#: In the order in which spans with the same start are listed.
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
BASE = 3
#: Code points between two parts of a credential at most; a blank line ends a scope too.
SCOPE = 300

# Fixed patterns. The first is searched in the text with A-Z in lower case.
ASSIGN = re.compile(rb"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
IDENTIFIER = re.compile(rb"(?:client_?id|access_?key_?id|account_?(?:id|name)|user_?(?:id|name)|login)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9@_.+-]{3,})")
SECRET = re.compile(rb"[A-Za-z0-9+/_-]{32,}={0,2}")
ENDPOINT = re.compile(rb"[a-z][a-z0-9+.-]{1,15}://[^\s\"'<>]{3,}|(?:endpoint|host(?:name)?|server)[\"']?\x20*[:=]\x20*[\"']?[a-z0-9.-]+\.[a-z0-9]{2,}(?::[0-9]+)?")
MIXED = (re.compile(rb"[a-z]"), re.compile(rb"[A-Z]"), re.compile(rb"[0-9]"))

Span = tuple[int, int]


class Parts:
    """Spans of one text, to be joined with others by scope."""

    def __init__(self, raw: bytes, spans: list[Span]) -> None:
        self.raw, self.spans = raw, sorted(spans)
        self.starts = [a for a, _ in self.spans]
        self.ends = list(accumulate((b for _, b in self.spans), max))

    def scope(self, stop: int, start: int) -> bool:
        """Whether what stands between two spans leaves them in one scope."""
        if start <= stop:
            return True
        between = self.raw[stop : min(start, stop + 4 * SCOPE + 1)]
        return start - stop <= len(between) and len(between.decode(errors="replace")) <= SCOPE and b"\n\n" not in between

    def near(self, span: Span) -> bool:
        """Whether one of the spans lies in the same scope.

        Of those that begin before, it is enough to try the one that ends last
        (not the last to begin), as less stands between; of the others, the first.
        """
        at = bisect_right(self.starts, span[0])
        return (at > 0 and self.scope(self.ends[at - 1], span[0])) or (at < len(self.starts) and self.scope(span[1], self.starts[at]))


def cover(spans: list[Span]) -> list[Span]:
    """The stretches that the spans cover together, sorted and apart."""
    out: list[Span] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def apart(span: Span, covered: list[Span]) -> bool:
    """Whether a span overlaps none of the covered stretches."""
    at = bisect_left(covered, (span[1], 0))
    return at == 0 or covered[at - 1][1] <= span[0]


def scan(raw: bytes) -> list[tuple[int, int, int]]:
    """(kind, start, stop) in bytes, by start and then kind.

    The base kinds stand by themselves. Weak parts need company in their scope
    (``SCOPE`` code points between two parts at most, and no blank line): a bare
    identifier some secret, a bare random string some identifier, an endpoint
    both. Weak parts that overlap a base span are left to it.
    """
    lower = raw.lower()
    assign = [m.span() for m in ASSIGN.finditer(lower) if m.end(1) - m.start(1) >= 6]
    access = [m.span() for m in ACCESS.finditer(raw) if m.end() - m.start() >= 20] if b"AKIA" in raw else []
    hexes = [m.span() for m in HEX.finditer(raw)]
    found = [(0, *s) for s in assign] + [(1, *s) for s in access] + [(2, *s) for s in hexes]
    base = cover([s[1:] for s in found])
    free = [m.span() for m in SECRET.finditer(raw) if all(p.search(raw, *m.span()) for p in MIXED)]
    free = [s for s in free if apart(s, base)]
    if not (base or free):
        return []
    names = [s for s in (m.span() for m in IDENTIFIER.finditer(lower)) if apart(s, base)] if assign or hexes or free else []
    identifiers = Parts(raw, access + names)
    free = [s for s in free if identifiers.near(s)]
    secrets = Parts(raw, assign + hexes + free)
    names = [s for s in names if secrets.near(s)]
    identifiers = Parts(raw, access + names)
    found += [(3, *s) for s in names] + [(4, *s) for s in free if apart(s, cover(names))]
    if identifiers.spans and secrets.spans:
        taken = cover([s[1:] for s in found] + free)
        places = (m.span() for m in ENDPOINT.finditer(lower))
        found += [(5, *s) for s in places if apart(s, taken) and identifiers.near(s) and secrets.near(s)]
    return sorted(found, key=lambda s: (s[1], s[0], s[2]))


def spans_of(raw: bytes | None) -> list[dict[str, object]]:
    """As ``scan`` finds them, in code points."""
    found = scan(raw) if raw else []
    if not found:
        return []
    begun = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
    return [{"kind": KINDS[k], "start": int(begun[a]), "stop": int(begun[b])} for k, a, b in found]


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))


def find_secrets(docs: DataFrame, text_col: str = "text", out: str = "secret_spans") -> DataFrame:
    """``docs`` with the column ``out``: array of (kind, start, stop) in code points, stop exclusive.

    A null or empty text has none. Every row is scanned for itself and whole, so
    repeated rows repeat and an empty table stays empty. A column that has the
    name ``out`` already is replaced.
    """

    @F.arrow_udf("array<struct<kind: string, start: long, stop: long>>")
    def scanned(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array([spans_of(x) for x in part.to_pylist()], SPANS)

    return docs.withColumn(out, scanned(F.col(text_col).cast("binary")))


def listed(spans: str | object) -> object:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.stop)), ",")


def redacted(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each stretch of overlapping spans replaced by ``mark``; texts without secrets stay as they are.

    Null and empty texts stay null and empty, repeated rows and rows without id
    are each treated for itself, other columns stay, an empty table is empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at = batch.schema.get_field_index(text_col)
            texts = []
            for raw in batch.column(at).cast(pa.binary()).to_pylist():
                if raw:
                    parts, done = [], 0
                    for _, a, b in scan(raw):
                        if a >= done:
                            parts += [raw[done:a], mark.encode()]
                        done = max(done, b)
                    raw = b"".join(parts) + raw[done:] if parts else raw
                texts.append(raw)
            yield batch.set_column(at, text_col, pa.array(texts, pa.binary()).cast(pa.string()))

    return docs.mapInArrow(run, docs.schema)
