"""Token counts of sections, from one encoding of the whole document."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, slices

# The pattern of this byte-level vocabulary: contractions, words, numbers, signs, white space.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Code points that the encoder takes at once. Longer texts are cut between a
#: letter and a space that one letter follows, where no token of it crosses.
AT_ONCE = 200_000


@dataclass
class Encoder:
    """A byte-level vocabulary: the bytes of a text's tokens, joined, are the text's."""

    encoding: tiktoken.Encoding
    sizes: np.ndarray

    @classmethod
    def shared(cls, path: str) -> Encoder:
        return kept(f"bytes {path}", lambda: cls.load(path))

    @classmethod
    def load(cls, path: str) -> Encoder:
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, number in ranks.items():
            sizes[number] = len(token)
        return cls(tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes)

    def lengths(self, text: str) -> np.ndarray:
        """Bytes of each token of a text, in order."""
        parts, at = [], 0
        while at < len(text):
            end = at + AT_ONCE
            if end < len(text):
                while end < len(text) and not (text[end] == " " and text[end - 1].isalpha() and text[end + 1 : end + 2].isalpha()):
                    end += 1
            parts.append(self.sizes[self.encoding.encode_to_numpy(text[at:end], disallowed_special=())])
            at = end
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)


@dataclass
class Offsets:
    """Byte spans of a text's tokens, and where its code points begin."""

    ends: np.ndarray  # of the tokens, 0 first
    points: np.ndarray  # byte at which each code point begins, and the end

    @classmethod
    def of(cls, text: str, encoder: Encoder) -> Offsets:
        raw = np.frombuffer(text.encode(), np.uint8)
        points = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
        return cls(np.concatenate(([0], np.cumsum(encoder.lengths(text)))), points)

    def before(self, at: np.ndarray) -> np.ndarray:
        """Tokens before some bytes, a token that is crossed counting by its share of bytes."""
        k = np.searchsorted(self.ends, at, side="right") - 1
        k = np.minimum(k, max(0, len(self.ends) - 2))
        if len(self.ends) == 1:
            return np.zeros(len(at))
        return k + (at - self.ends[k]) / (self.ends[k + 1] - self.ends[k])

    def counts(self, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of sections (code points, stop exclusive) by each rule: first byte, last byte, share."""
        a, b = self.points[starts], self.points[stops]
        begins, lasts = self.ends[:-1], self.ends[1:] - 1
        first = np.searchsorted(begins, b) - np.searchsorted(begins, a)
        last = np.searchsorted(lasts, b) - np.searchsorted(lasts, a)
        return np.maximum(first, 0), np.maximum(last, 0), np.maximum(self.before(b) - self.before(a), 0.0)


def lines(text: str) -> list[tuple[str, int, int]]:
    """The lines of a text, each with the line feed that ends it; an empty text is one empty line."""
    out, at = [], 0
    while at < len(text) or not out:
        end = text.find("\n", at) + 1 or len(text)
        out.append(("line", at, end))
        at = end
    return out


def section_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", sections_col: str | None = None) -> DataFrame:
    """A row for each section of each document: (row_id, section, name, start, stop, tokens_first, tokens_last, tokens_share, text_tokens).

    ``sections_col`` is an array of (name, start, stop) in code points, stop
    exclusive; sections may overlap or leave gaps, what lies beyond the text is
    cut off, and a null array or span is none. Without it, the lines are the
    sections. A token that crosses a boundary counts where its first byte is
    (tokens_first), where its last one is (tokens_last), or in parts by its
    bytes (tokens_share); sections that cover the text once sum to text_tokens
    by each rule.

    A null text is empty and has no tokens; rows with the same or no id are each
    counted; an empty table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.shared(vocabulary)
        for batch in slices(batches, keep=True):
            owner, name, total = [], [], []
            columns: list[list[np.ndarray]] = [[], [], [], [], [], []]
            given = batch.column(2).to_pylist() if sections_col else [None] * batch.num_rows
            for i, (text, own) in enumerate(zip(batch.column(1).to_pylist(), given)):
                text = text or ""
                if sections_col:
                    found = [(s["name"], s["start"], s["stop"]) for s in own or [] if s and s["start"] is not None and s["stop"] is not None]
                else:
                    found = lines(text)
                starts = np.clip(np.array([s[1] for s in found], np.int64), 0, len(text))
                stops = np.maximum(starts, np.clip(np.array([s[2] for s in found], np.int64), 0, len(text)))
                offsets = Offsets.of(text, encoder)
                for column, x in zip(columns, (np.arange(len(found)), starts, stops, *offsets.counts(starts, stops))):
                    column.append(x)
                owner += [i] * len(found)
                name += [s[0] for s in found]
                total += [len(offsets.ends) - 1] * len(found)
            n, a, b, first, last, share = (np.concatenate(c) for c in columns)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(n), pa.array(name, pa.string()), pa.array(a), pa.array(b), pa.array(first), pa.array(last), pa.array(share.astype(float)), pa.array(total, pa.int64())],
                ["row_id", "section", "name", "start", "stop", "tokens_first", "tokens_last", "tokens_share", "text_tokens"],
            )

    columns = [F.col(id_col).alias("row_id"), F.col(text_col).alias("text"), *([F.col(sections_col).alias("sections")] if sections_col else [])]
    rows = docs.select(*columns)
    kind = rows.schema["row_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"row_id {kind}, section long, name string, start long, stop long, tokens_first long, tokens_last long, tokens_share double, text_tokens long")
