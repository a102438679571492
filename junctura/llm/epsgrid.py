"""Embedding near-dedup by an epsilon grid order join.

Unit vectors within cosine c lie within epsilon = sqrt(2 - 2c) of each other.
Distinct vectors are sorted by the grid cells, epsilon wide, of their leading
principal coordinates and cut into sequence intervals. Pairs of intervals whose
bounding boxes are further apart than epsilon are skipped; the others are joined
recursively, halving the longer one and skipping again, down to small blocks
whose cosines are computed in double precision. A box spans the principal axes
and the length of what is left of a vector off them, as lengths that differ by
more than epsilon tell vectors apart too. No pair of linked vectors is lost:
skipping is proven, and the axes, fitted on a bounded sample, only decide how
much can be skipped.

Intervals meet through an equality join on the cells that they cover along the
first two axes, and a task reports a spanning star and the numbers of links. An
interval holds at most ``INTERVAL_BYTES`` of vectors.

Defined results: vectors that are null, zero, or hold null or non-finite
components link with nothing and are their own component; vectors of different
lengths don't link, and those of each length are joined by themselves; a null vec_id never names a component that has another; equal vectors
fold into one node and count as links of each other; repeated rows likewise.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from junctura.llm.common import checkpointed, components, merge
from junctura.llm.simhash import _binary

SAMPLE, SAMPLE_BYTES = 20_000, 64 << 20  # vectors that fit the principal axes, and their bytes in double precision
CELLS = 4  # axes of the sort order
AXES = 16  # axes of the bounding boxes
LEAF = 512
INTERVALS = 16
LEAST, MOST = 1024, 32_768  # vectors of an interval
INTERVAL_BYTES = 16 << 20
LEAST_CELL = 0.1  # width of the cells in which intervals meet
SLACK = 1e-6


def clean(vector: list | None, kind: str) -> bytes | None:
    """The vector's bytes, or None if it can't link."""
    if not vector or any(x is None for x in vector):
        return None
    v = np.array(vector, kind) + 0
    return v.tobytes() if np.isfinite(v).all() and v.any() else None


def units(raw: list[bytes] | bytes, size: int, kind: str) -> np.ndarray:
    """Vectors over their norms, in double precision."""
    v = np.frombuffer(raw if isinstance(raw, bytes) else b"".join(raw), kind).reshape(-1, size).astype(np.float64)
    v /= np.abs(v).max(axis=1, initial=1e-300)[:, None]
    return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


def placed(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Coordinates of unit vectors along the axes, and the length of the rest."""
    y = x @ axes
    return np.c_[y, np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", y, y)))]


def _box(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return y.min(axis=0), y.max(axis=0)


def _apart(a: tuple, b: tuple) -> float:
    gap = np.maximum(0, np.maximum(a[0] - b[1], b[0] - a[1]))
    return float(np.sqrt(gap @ gap))


def _join(x: np.ndarray, y: np.ndarray, a: tuple[int, int], b: tuple[int, int], least: float, eps: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of the intervals a and b (equal, or a before b) with cosine >= least."""
    if _apart(_box(y[a[0] : a[1]]), _box(y[b[0] : b[1]])) > eps + SLACK:
        return
    m, n = a[1] - a[0], b[1] - b[0]
    if max(m, n) <= LEAF:
        i, j = np.nonzero(x[a[0] : a[1]] @ x[b[0] : b[1]].T >= least)
        i, j = i + a[0], j + b[0]
        yield (i[i < j], j[i < j]) if a == b else (i, j)
        return
    if a == b:
        h = (a[0] + a[1]) // 2
        left, right = (a[0], h), (h, a[1])
        for p, q in ((left, left), (left, right), (right, right)):
            yield from _join(x, y, p, q, least, eps)
    elif m >= n:
        h = (a[0] + a[1]) // 2
        yield from _join(x, y, (a[0], h), b, least, eps)
        yield from _join(x, y, (h, a[1]), b, least, eps)
    else:
        h = (b[0] + b[1]) // 2
        yield from _join(x, y, a, (b[0], h), least, eps)
        yield from _join(x, y, a, (h, b[1]), least, eps)


def _pairs(batches: Iterator[pa.RecordBatch], size: int, kind: str, axes: np.ndarray, least: float, eps: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            own = [batch.column(c)[k].as_py() for c in ("nodes1", "raws1", "counts1")]
            if same := batch.column("i")[k].as_py() == batch.column("j")[k].as_py():
                nodes, raws, counts = own
            else:
                nodes, raws, counts = (p + batch.column(c)[k].as_py() for p, c in zip(own, ("nodes2", "raws2", "counts2")))
            nodes = np.frombuffer(nodes, np.uint8).reshape(-1, 16)
            x, counts = units(raws, size, kind), np.frombuffer(counts, np.int64)
            y, m = placed(x, axes), len(own[0]) // 16
            label, links = np.arange(len(x)), np.zeros(len(x), np.int64)
            for a, b in _join(x, y, (0, m), (0, m) if same else (m, len(x)), least, eps):
                np.add.at(links, a, counts[b])
                np.add.at(links, b, counts[a])
                merge(label, a, b)
            hit = np.flatnonzero(links)
            if len(hit):
                yield pa.RecordBatch.from_arrays([_binary(nodes[hit]), _binary(nodes[label[hit]]), pa.array(links[hit])], ["a", "b", "links"])


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    single = vectors.select(F.col(f"`{vector_col}`")).dtypes[0][1] == "array<float>"
    kind = "<f4" if single else "<f8"  # vectors travel as they are
    raw = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<float>" if single else "array<double>").alias("v"))

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([clean(v, kind) for v in batch.column(1).to_pylist()], pa.binary())], ["vec_id", "raw"])

    rows = checkpointed(raw.mapInArrow(cleaned, "vec_id long, raw binary").withColumn("node", F.unhex(F.md5("raw"))))
    width = np.dtype(kind).itemsize
    sizes = rows.where("raw is not null").groupBy((F.octet_length("raw") / width).cast("int").alias("size")).count().where("count > 1")
    named = None
    # A row a length; lengths of one vector link with nothing.
    for size in sorted(r["size"] for r in sizes.collect()):
        own = _linked(rows.where(F.octet_length("raw") == size * width), size, kind, cosine)
        named = own if named is None else named.union(own)
    if named is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    return rows.join(named, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("raw").isNull() | F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _linked(rows: DataFrame, size: int, kind: str, cosine: float) -> DataFrame:
    """node, n_links and component_id of rows (vec_id, raw, node) of vectors of one length."""
    spark = rows.sparkSession
    eps = math.sqrt(max(1e-12, 2 - 2 * cosine))
    nodes = rows.groupBy("node").agg(F.first("raw").alias("raw"), F.count("*").alias("n"), F.min("vec_id").alias("first"))
    nodes = checkpointed(nodes)
    total = nodes.count()
    most = max(1, min(MOST, INTERVAL_BYTES // (size * np.dtype(kind).itemsize)))
    interval = min(most, max(LEAST, -(-total // INTERVALS)))
    sample = units([bytes(r.raw) for r in nodes.orderBy("node").limit(max(2, min(SAMPLE, SAMPLE_BYTES // (8 * size)))).select("raw").collect()], size, kind)
    centred = sample - sample.mean(axis=0) if len(sample) else np.zeros((1, size))
    axes = np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, : min(AXES, size)].copy()

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = units(batch.column(1).to_pylist(), size, kind) @ axes
            cells = np.floor(y[:, :CELLS] / max(eps, 1e-9)).clip(-120, 120) + 128
            fine = ((y[:, :CELLS].clip(-1, 1) + 1) * 127).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([*batch.columns, _binary(np.c_[cells.astype(np.uint8), fine])], ["node", "raw", "n", "cell"])

    def intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, []

        def cut(k: int, number: int) -> pa.RecordBatch:
            nonlocal held
            now, held = held[:k], held[k:]
            y = placed(units([r[1] for r in now], size, kind), axes)
            low, high = _box(y)
            row = (number, low.tolist(), high.tolist(), b"".join(r[0] for r in now), b"".join(r[1] for r in now), np.array([r[2] for r in now], np.int64).tobytes())
            names = ["i", "low", "high", "nodes", "raws", "counts"]
            types = [pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

        for batch in batches:
            held += zip(batch.column("node").to_pylist(), batch.column("raw").to_pylist(), batch.column("n").to_pylist())
            while len(held) >= interval:
                yield cut(interval, number)
                number += 1
        if held:
            yield cut(len(held), number)

    order = ["cell", "node"]
    keyed = nodes.select("node", "raw", "n").mapInArrow(ordered, "node binary, raw binary, n long, cell binary")
    parts = max(1, -(-total // interval))
    blocks = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    blocks = checkpointed(blocks.mapInArrow(intervals, "i long, low array<double>, high array<double>, nodes binary, raws binary, counts binary"))

    # Intervals meet in the cells along the first two axes that both reach; the
    # pair is formed in the first of them only.
    place = lambda c, k: F.floor(F.col(c)[k] / max(eps, LEAST_CELL))
    left = blocks.select("i", "low", "high", *(place(c, k).alias(f"{c}{k}") for k in range(2) for c in ("low", "high")))
    right = left.select("i", "low", "high", *((F.col(f"low{k}") - 1).alias(f"low{k}") for k in range(2)), *((F.col(f"high{k}") + 1).alias(f"high{k}") for k in range(2)))
    for k in range(2):
        left, right = (x.withColumn(f"cell{k}", F.explode(F.sequence(f"low{k}", f"high{k}"))) for x in (left, right))
    gap = F.expr("aggregate(zip_with(zip_with(l.low, r.high, (x, y) -> x - y), zip_with(r.low, l.high, (x, y) -> x - y), (x, y) -> greatest(x, y, 0D)), 0D, (s, x) -> s + x * x)")
    met = left.alias("l").join(right.alias("r"), F.expr("l.cell0 = r.cell0 and l.cell1 = r.cell1 and l.i <= r.i and l.cell0 = greatest(l.low0, r.low0) and l.cell1 = greatest(l.low1, r.low1)"))
    met = met.where(gap <= (eps + SLACK) ** 2).select(F.col("l.i").alias("i"), F.col("r.i").alias("j"))
    met = checkpointed(met)
    own = ["nodes", "raws", "counts"]
    met = met.join(blocks.select("i", *(F.col(c).alias(c + "1") for c in own)), "i")
    met = met.join(blocks.select(F.col("i").alias("j"), *(F.when(F.lit(True), F.col(c)).alias(c + "2") for c in own)), "j")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")  # each row holds two intervals
    try:
        found = checkpointed(met.repartition("i", "j").mapInArrow(lambda b: _pairs(b, size, kind, axes, cosine, eps), "a binary, b binary, links long"))
    finally:
        spark.conf.set(key, before)

    links = checkpointed(found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links")), total)
    parts_of = checkpointed(components(found.select("a", "b")).join(nodes.select("node", "first"), "node"), total)
    least = checkpointed(parts_of.groupBy("label").agg(F.min("first").alias("component_id")), total)
    named = parts_of.join(least, "label").select("node", "component_id")
    return checkpointed(nodes.join(links, "node", "left").join(named, "node", "left").select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component_id", "first").alias("component_id")
    ), total)
