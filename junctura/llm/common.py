"""Shared pieces: durable cut of lineage, and connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from junctura.checkpoints import checkpoint_folder

# Characters that part words: space and U+0009 to U+000D.
WORD = r"[^ \t-\r]+"
BATCH_BYTES = 8 << 20
ROWS_A_FILE = 50_000


def checkpointed(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Write ``df`` to the session's checkpoint folder once and continue from there.

    Where a bound on the number of rows is known, few files are written for few
    rows; an exchange deals them, so that the work before it keeps its tasks.
    """
    checkpoint_folder(df.sparkSession)
    if rows is not None:
        df = df.repartition(1 + rows // ROWS_A_FILE)
    return df.checkpoint(eager=True)


def removed(spark: SparkSession, path: str) -> None:
    """Remove a table that nothing reads any more, in whatever store it is in."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Keep Arrow batches of whole texts small in rows and bytes, unless they are smaller already."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) not in range(1, rows + 1):
        spark.conf.set(key, str(rows))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    told = spark.conf.get(key).removesuffix("b")
    if not told.isdigit() or int(told) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def give_back() -> None:
    """Return to the system what this process freed but still holds, where its C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass  # another C library; it keeps what it holds


def frugal(run: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """``run``, a generator of a task, that gives memory back at its end: workers live on beside those of later stages."""

    @wraps(run)
    def wrapped(*args) -> Iterator:
        try:
            yield from run(*args)
        finally:
            give_back()

    return wrapped


def word_count(text) -> F.Column:
    """Number of words of ``text``; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _star(edges: DataFrame, large: bool, rows: int) -> DataFrame:
    """One step of the star contraction on edges (u, v) with u > v."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    # Written out, both inputs of the join are plain exchanges, which adaptive
    # execution can split where a node has very many neighbours.
    least = checkpointed(least, rows)
    if large:
        moved = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = both.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.union(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the parts of label that pairs (a, b) link; label[i] <= i stays a root's index."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := label[label], label):
            label[:] = up


@frugal
def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) of a task as stars, v the least node of each of their parts."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    edges = pa.Table.from_batches(held)
    both = pa.chunked_array([*edges.column("u").chunks, *edges.column("v").chunks])
    names = pc.unique(both)
    names = names.take(pc.sort_indices(names))
    at, label = pc.index_in(both, names).to_numpy(), np.arange(len(names))
    merge(label, at[: edges.num_rows], at[edges.num_rows :])
    leaves = np.flatnonzero(label != np.arange(len(names)))
    yield pa.RecordBatch.from_arrays([names.take(pa.array(leaves)), names.take(pa.array(label[leaves]))], ["u", "v"])


def _contracted(edges: DataFrame, rows: int) -> DataFrame:
    """Edges dealt in parts of about ``ROWS_A_FILE`` rows, each of which a task turns into stars, written out."""
    kinds = ", ".join(f"{c} {kind}" for c, kind in edges.dtypes)
    return checkpointed(edges.repartition(1 + rows // ROWS_A_FILE).mapInArrow(_contract, kinds))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b) as rows (node, label).

    Parts of the edges are turned into stars, which leaves at most an edge a node
    of each; edges of several parts go on by alternating large-star and small-star
    steps. The label is the least node of the component. Nodes without an edge
    are absent. Nothing but two numbers a round reaches the driver.
    """
    edges = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    rows, before = edges.count(), None
    edges = _contracted(edges, rows)
    # Stars of one part are the components; no step of a node's least neighbour rises, so a round that changes nothing is the last.
    while rows >= ROWS_A_FILE:
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == before:
            break
        edges, before = _contracted(_star(_star(edges, True, now[0]), False, now[0]), now[0]), now
        rows = now[0]
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
