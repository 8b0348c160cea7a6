"""Maximum inner product search: anisotropic 4-bit quantisation, table scans, exact reranking."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.formats import scratch
from .common import slices, stored

#: Vectors that the codebooks are fitted on at most (in expectation).
TRAINING_ROWS = 20_000
#: Dimensions of a codebook of 16 centres, and rounds of fitting.
BLOCK_DIMS = 2
ROUNDS = 6
#: The inner products that matter, as a share of the norms' product: the larger, the more a parallel error weighs.
THRESHOLD = 0.2
#: Rows whose codes are scanned at once; queries that all tasks hold at once; rows of a task when the vectors are encoded.
BLOCK_ROWS = 16_384
WAVE_QUERIES = 16_384
PART_ROWS = 65_536
#: One row in so many is scanned first, for the least score that each query's neighbours must have.
PROBE = 16
#: Candidates that are scored exactly at first, where no such score is known.
POOL = 512


@dataclass
class Quantiser:
    """Codebooks of 16 centres for each block of dimensions.

    The loss of a vector x and its residual r is |r|^2 + (eta - 1) (r . x / |x|)^2:
    the residual's part along x, which moves large inner products most, weighs eta times.
    """

    eta: float
    centres: np.ndarray  # blocks, 16, dimensions of a block

    @classmethod
    def fit(cls, x: np.ndarray, rounds: int = ROUNDS, threshold: float = THRESHOLD, seed: int = 7) -> Quantiser:
        n, d = x.shape
        blocks = math.ceil(d / BLOCK_DIMS)
        eta = max(1.0, (d - 1) * threshold**2 / (1 - threshold**2))
        x = cls.padded(x, blocks)
        rng = np.random.default_rng(seed)
        self = cls(eta, np.stack([x[rng.integers(0, n, 16), m] for m in range(blocks)]))
        unit = x / np.linalg.norm(x, axis=(1, 2), keepdims=True)
        codes = self.nearest(x)
        for _ in range(rounds):
            self.improve(x, unit, codes)
            along = ((x - self.decoded(codes)) * unit).sum(axis=2)
            total = along.sum(axis=1)
            for m in range(blocks):  # each centre by weighted least squares, the other blocks as they are
                u, own = unit[:, m], codes[:, m]
                others = total - along[:, m]
                weight = np.eye(BLOCK_DIMS)[None] + (eta - 1) * u[:, :, None] * u[:, None, :]
                right = np.einsum("nij,nj->ni", weight, x[:, m]) + (eta - 1) * u * others[:, None]
                for c in range(16):
                    at = own == c
                    if at.any():
                        self.centres[m, c] = np.linalg.solve(weight[at].sum(axis=0) + 1e-9 * np.eye(BLOCK_DIMS), right[at].sum(axis=0))
                new = ((x[:, m] - self.centres[m][own]) * u).sum(axis=1)
                total, along[:, m] = others + new, new
        return self

    @staticmethod
    def padded(x: np.ndarray, blocks: int) -> np.ndarray:
        out = np.zeros((len(x), blocks * BLOCK_DIMS))
        out[:, : x.shape[1]] = x
        return out.reshape(len(x), blocks, BLOCK_DIMS)

    def decoded(self, codes: np.ndarray) -> np.ndarray:
        return self.centres[np.arange(codes.shape[1])[None, :], codes]

    def nearest(self, x: np.ndarray) -> np.ndarray:
        codes = np.empty(x.shape[:2], np.int64)
        for m in range(x.shape[1]):
            codes[:, m] = ((x[:, m][:, None] - self.centres[m][None]) ** 2).sum(axis=2).argmin(axis=1)
        return codes

    def improve(self, x: np.ndarray, unit: np.ndarray, codes: np.ndarray) -> None:
        """Coordinate descent: each block's code anew, the others as they are."""
        total = ((x - self.decoded(codes)) * unit).sum(axis=(1, 2))
        for m in range(x.shape[1]):
            r = x[:, m][:, None] - self.centres[m][None]
            along = (r * unit[:, m][:, None]).sum(axis=2)
            others = total - along[np.arange(len(x)), codes[:, m]]
            loss = (r**2).sum(axis=2) + (self.eta - 1) * (others[:, None] + along) ** 2
            codes[:, m] = loss.argmin(axis=1)
            total = others + along[np.arange(len(x)), codes[:, m]]

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Codes of vectors, two of 4 bits in a byte."""
        x = self.padded(x, len(self.centres))
        unit = x / np.linalg.norm(x, axis=(1, 2), keepdims=True)
        codes = self.nearest(x)
        for _ in range(2):
            self.improve(x, unit, codes)
        if codes.shape[1] % 2:
            codes = np.hstack([codes, np.zeros((len(codes), 1), np.int64)])
        return (codes[:, ::2] | codes[:, 1::2] << 4).astype(np.uint8)

    def tables(self, q: np.ndarray) -> np.ndarray:
        """For a query, the inner products with all pairs of centres that a byte stands for: bytes, 256."""
        q = self.padded(q[None], len(self.centres))[0]
        table = np.einsum("mcd,md->mc", self.centres, q)
        if len(table) % 2:
            table = np.vstack([table, np.zeros((1, 16))])
        return (table[::2][:, None, :] + table[1::2][:, :, None]).reshape(-1, 256).astype(np.float32)


def inner(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed from the first dimension to the last."""
    out = np.zeros(len(x))
    for j in range(x.shape[1]):
        out += x[:, j] * q[j]
    return out


def best(score: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k largest, ties to the first, in order of index."""
    if len(score) <= k:
        return np.arange(len(score))
    least = np.partition(score, len(score) - k)[len(score) - k]
    above = np.flatnonzero(score > least)
    return np.sort(np.concatenate((above, np.flatnonzero(score == least)[: k - len(above)])))


def residuals(quantiser: Quantiser, vectors: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """How far from a vector's inner product with a query of length 1 that of its code can be, rounding of the scan included."""
    blocks = len(quantiser.centres)
    both = np.stack((codes & 15, codes >> 4), axis=2).reshape(len(codes), -1)[:, :blocks]
    off = np.zeros(len(codes))
    for at in range(0, len(codes), 2048):
        part = slice(at, at + 2048)
        off[part] = np.linalg.norm(quantiser.padded(vectors[part], blocks) - quantiser.decoded(both[part]), axis=(1, 2))
    return off + 1e-5 * (off + np.linalg.norm(vectors, axis=1))


@dataclass
class Best:
    """The ``k`` nearest rows that one task has met, for each query of a wave; ``least``: scores below are of no interest."""

    quantiser: Quantiser
    query_ids: np.ndarray
    queries: np.ndarray
    least: np.ndarray
    k: int
    pool: int

    def __post_init__(self) -> None:
        none = np.zeros(0, np.int64), np.zeros(0)
        self.lengths = np.linalg.norm(self.queries, axis=1)
        self.kept = [none] * len(self.queries)

    def scan(self, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray) -> None:
        """A table scan of a block's codes picks the candidates, whose exact scores decide.

        Candidates are all rows whose code's score and residual allow a score as
        good as the k-th known, so that none of the nearest is missed.
        """
        columns = np.ascontiguousarray(codes.T)
        off, norms = residuals(self.quantiser, vectors, codes), np.linalg.norm(vectors, axis=1)
        for i, (query, q, length) in enumerate(zip(self.query_ids.tolist(), self.queries, self.lengths.tolist())):
            rough = np.zeros(len(ids), np.float32)
            for table, column in zip(self.quantiser.tables(q), columns):
                rough += table.take(column)
            rough[ids == query] = -np.inf
            known, scores = self.kept[i]
            least = max(self.least[i], scores[-1]) if len(scores) == self.k else self.least[i]
            if least == -np.inf:
                first = best(rough, self.pool)
                exact = np.sort(inner(vectors[first[ids[first] != query]], q))
                least = exact[-self.k] if len(exact) >= self.k else least
            at = np.flatnonzero(~(rough + length * off < least) & (ids != query))
            # The fast product differs from the exact score in rounding alone.
            at = at[vectors[at] @ q >= least - 1e-9 * length * norms[at]]
            exact = inner(vectors[at], q)
            at, exact = at[exact >= least], exact[exact >= least]
            if len(at):
                known, scores = np.concatenate((known, ids[at])), np.concatenate((scores, exact))
                order = np.lexsort((known, -scores))[: self.k]
                self.kept[i] = known[order], scores[order]

    def rows(self) -> pa.RecordBatch:
        counts = [len(ids) for ids, _ in self.kept]
        none = np.zeros(0, np.int64), np.zeros(0)
        columns = [np.repeat(self.query_ids, counts), *(np.concatenate([none[j], *(x[j] for x in self.kept)]) for j in (0, 1))]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])


def valid_vectors(table: DataFrame, id_col: str, vector_col: str, parts: int) -> DataFrame:
    """(vec_id, x: array of double): one row for each id, without vectors that take no part, in ``parts`` partitions."""
    x = F.col(vector_col).cast("array<double>")
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).where("vec_id is not null and x is not null")
    fine = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("x", lambda v: v != 0)
    return rows.where(fine).repartition(parts, "vec_id").groupBy("vec_id").agg(F.min("x").alias("x"))


def nearest(
    table: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", pool: int = POOL, training_rows: int = TRAINING_ROWS, block_rows: int = BLOCK_ROWS, wave_queries: int = WAVE_QUERIES
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest by inner product of each row whose id ``every`` divides, among all other rows.

    Codebooks are fitted on ``training_rows`` vectors (in expectation), chosen
    by a hash of their ids; every vector is encoded, and stays where it is
    stored: waves of about ``wave_queries`` queries are sent to all tasks, each
    of which scans the 4-bit codes of its rows for each query and scores those
    exactly that the codes' errors leave in question. Before that, one row in
    ``PROBE`` is scanned alike: a query's k-th best among these bounds its
    neighbours' scores from below, so that a task passes on few others, however
    many tasks there are. Ties go to the smaller id.

    Vectors that are null, zero, or hold null or non-finite components take no
    part, nor do rows without id or of another length than most vectors'. Rows
    with the same id count as one (the least vector). No rows give no rows.
    """
    spark = table.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, math.ceil(table.count() / PART_ROWS))
    rows = stored(valid_vectors(table, id_col, vector_col, parts))
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    out = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], out)
    d, n = sizes[0].d, sizes[0]["count"]
    rows = rows.where(F.size("x") == d)
    share = min(1.0, training_rows / n)
    sample = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 40)) < max(1, int((1 << 40) * share))).select("x").toArrow()
    if sample.num_rows == 0:
        sample = rows.select("x").limit(1).toArrow()
    quantiser = Quantiser.fit(np.stack(sample.column("x").to_numpy()))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            x = np.stack(batch.column(1).to_numpy(zero_copy_only=False))
            packed = [c.tobytes() for c in quantiser.encode(x)], [v.tobytes() for v in x]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed[0], pa.binary()), pa.array(packed[1], pa.binary())], ["vec_id", "code", "x"])

    index = stored(rows.select("vec_id", "x").mapInArrow(encode, "vec_id long, code binary, x binary"))
    probe = stored(index.where(F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(PROBE)) == 0))
    queries = stored(index.where(F.col("vec_id") % every == 0).select("vec_id", "x"))

    def matrix(column: pa.ChunkedArray, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1) if len(column) else np.zeros((0, d), kind)

    def searched(among: DataFrame, wave: pa.Table, least: np.ndarray) -> tuple[Broadcast, DataFrame]:
        """The queries as sent to all tasks, and (query_id, rank, vec_id, score): their ``k`` nearest."""
        sent = spark.sparkContext.broadcast((wave.column("vec_id").to_numpy(), matrix(wave.column("x"), float), least))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found, waiting = Best(quantiser, *sent.value, k, pool), []

            def scan() -> None:
                block = pa.Table.from_batches(waiting)
                found.scan(block.column("vec_id").to_numpy(), matrix(block.column("x"), float), matrix(block.column("code"), np.uint8))
                waiting.clear()

            for batch in slices(batches, block_rows):
                waiting.append(batch)
                if sum(b.num_rows for b in waiting) >= block_rows:
                    scan()
            if waiting:
                scan()
            yield found.rows()

        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        ranked = among.mapInArrow(run, "query_id long, vec_id long, score double").withColumn("rank", F.row_number().over(order))
        return sent, ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    waves, path = max(1, math.ceil(queries.count() / wave_queries)), scratch(spark)
    for nr in range(waves):
        wave = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(waves)) == nr).toArrow()
        least = np.full(wave.num_rows, -np.inf)
        sent, found = searched(probe, wave, least)
        bounds = found.where(F.col("rank") == k).select("query_id", "score").toArrow()  # a row for each query of the wave, at most
        sent.destroy()
        place = {q: i for i, q in enumerate(wave.column("vec_id").to_pylist())}
        least[[place[q] for q in bounds.column("query_id").to_pylist()]] = bounds.column("score").to_numpy()
        sent, found = searched(index, wave, least)
        found.write.mode("append").parquet(path)
        sent.destroy()
    return spark.read.schema(out).parquet(path)
