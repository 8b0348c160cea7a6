"""What the operators of this package share: stored tables, batches, components."""

from __future__ import annotations

import ctypes
import sys
import types
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.formats import scratch

#: Rows that the Python functions handle at once, so that their copies of the
#: texts of an Arrow batch stay small.
SLICE = 128
#: Edges that a task contracts at once.
EDGES = 1 << 19


def stored(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Writes ``df`` as Parquet to the shared folder and reads it back.

    Cuts the lineage: a lost executor costs no recomputation of what is stored.
    """
    spark = df.sparkSession
    path = scratch(spark)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, by: str, buckets: int) -> DataFrame:
    """Writes ``df`` to the shared folder in buckets by a column, without a shuffle, and reads it back.

    Joins and aggregates on that column then need none of it moved. The table's
    name is needed for writing alone; its files outlast it.
    """
    spark, name = df.sparkSession, f"millrace_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, by).option("path", scratch(spark)).option("compression", "zstd").saveAsTable(name)
    rows = spark.table(name)
    rows.schema  # resolved before the name goes
    spark.sql(f"DROP TABLE {name}")
    return rows


def _remembered() -> dict[str, Any]:
    return sys.modules.setdefault("_millrace_worker", types.ModuleType("_millrace_worker")).__dict__.setdefault("kept", {})


def released(but: str | None = None) -> None:
    """Drops what ``kept`` holds in this process, all or all but one, and gives its memory back."""
    state = _remembered()
    dropped = [key for key in state if key != but]
    for key in dropped:
        del state[key]
    if dropped and sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def kept(key: str, make: Callable[[], Any]) -> Any:
    """What ``make`` returns, made once for the tasks that a Python worker runs, until it runs those of another operator."""
    released(but=key)
    state = _remembered()
    if key not in state:
        state[key] = make()
    return state[key]


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE, keep: bool = False) -> Iterator[pa.RecordBatch]:
    """Batches of few rows; drops what other operators have ``kept``, unless their task needs it."""
    if not keep:
        released()
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def by_bytes(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of rows whose strings in a column have about ``most`` bytes, or that are one row."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        begun = (np.cumsum(sizes) - sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(begun)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index in the component of each of n nodes; edges are a[i] - b[i]."""
    label = np.arange(n)
    if len(a) == 0:
        return label
    key = np.unique(np.minimum(a, b).astype(np.int64) * n + np.maximum(a, b))
    a, b = key // n, key % n
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars (src, dst: the least node) with the components of each ``EDGES`` edges (src, dst)."""

    def stars(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        src, dst = (np.concatenate([p.column(i).to_numpy() for p in parts]) for i in (0, 1))
        nodes, at = np.unique(np.concatenate((src, dst)), return_inverse=True)
        root = local_components(len(nodes), at[: len(src)], at[len(src) :])
        other = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[other]), pa.array(nodes[root[other]])], ["src", "dst"])

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= EDGES:
            yield stars(held)
            held, rows = [], 0
    if rows:
        yield stars(held)


def are_stars(edges: DataFrame) -> bool:
    """Whether each src (greater than its dst) has one dst alone, which is no src: all components are found."""
    ends = edges.select(F.col("src").alias("node"), "dst").unionByName(edges.select(F.col("dst").alias("node"), F.lit(None).cast("long").alias("dst")))
    ends = ends.groupBy("node").agg(F.min("dst").alias("low"), F.max("dst").alias("high"), F.max(F.col("dst").isNull()).alias("centre"))
    return not ends.agg(F.max((F.col("low") != F.col("high")) | (F.col("centre") & F.col("low").isNotNull()))).first()[0]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (src, dst: long), root being the least node of its component.

    Tasks contract the edges that they read, in bounded parts; then large-star
    and small-star steps alternate until the edges are stars. Every step is a
    partial minimum and an equi-join that AQE can split on skew; no node's
    neighbours are gathered. Each round is stored, which bounds the plan.
    """
    edges = stored(edges.select("src", "dst").where("src <> dst").mapInArrow(contracted, "src long, dst long"))
    while not are_stars(edges):
        both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        least = both.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("src", "m").alias("m"))
        large = stored(both.where("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst")).distinct())
        low = large.groupBy("src").agg(F.min("dst").alias("m"))
        small = large.join(low, "src").where("dst <> m").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
        edges = stored(small.unionByName(low.withColumnRenamed("m", "dst")).mapInArrow(contracted, "src long, dst long"))
    return edges.select(F.col("src").alias("node"), F.col("dst").alias("root")).unionByName(edges.select("dst").distinct().select(F.col("dst").alias("node"), F.col("dst").alias("root"))).distinct()
