"""Codes of vectors: a codebook for each part of them, by Lloyd rounds with Elkan's bounds.

Components become integers, so distances, ties and means are exact. Vectors lie
in blocks; beside each block its bounds are kept from round to round: for every
part an upper bound of the distance to its entry, and a lower bound of the
distance to each entry. An entry is passed over only where a bound proves it
farther than the part's own, strictly; all others are compared by integer squared
distance, the lower index first. When entries move, bounds are shifted by how far.
Bounds are rounded outwards to single precision.

A round reads the blocks' table and writes the next one in the checkpoint folder,
with the sums of its parts by entry; only those reach the driver, a row for each
component of a codebook. The table before it is then removed.

Defined results: vectors that are null, or hold null or non-finite components, are
left out, and so are those of another length than most vectors have (the shorter
length if two are as common). A length that the parts don't divide makes the first
parts one longer. Ties of vec_id among the first entries go by the vector; a null
vec_id comes last. With fewer vectors than entries a codebook has fewer. Null
labels are one label. Repeated rows are coded each. Components whose distances
exceed 64 bits are compared by unbounded integers; a sum of errors that does is an
error. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from junctura.checkpoints import checkpoint_folder
from junctura.llm.common import removed, small_batches

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
BLOCK_BYTES = 1 << 20  # of the components of a block
LABELS = 1 << 16  # labels whose sums are broadcast
STATE = "ids array<long>, labels array<string>, raw binary, codes binary, upper binary, lower binary, sums array<decimal(38,0)>"
_NAMES = [c.split()[0] for c in STATE.split(", ")]
_TYPES = [pa.list_(pa.int64()), pa.list_(pa.string()), *[pa.binary()] * 4, pa.list_(pa.decimal128(38, 0))]

Book = list[np.ndarray]


def widths(size: int, parts: int) -> list[slice]:
    """Consecutive parts of a vector, as even as can be."""
    ends = np.cumsum([size // parts + (k < size % parts) for k in range(parts)]).tolist()
    return [slice(i, j) for i, j in zip([0, *ends[:-1]], ends)]


def exact(v: np.ndarray) -> np.ndarray:
    """Whole numbers in 64 bits, or unbounded ones where squared distances would not fit."""
    most = math.isqrt((1 << 62) // max(1, v.shape[-1])) // 2
    if v.size and np.abs(v).max() >= most:
        return np.array([int(x) for x in v.ravel()], object).reshape(v.shape)
    return v.astype(np.int64)


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = x - c
    return (d * d).sum(axis=-1)


def _root(squared: np.ndarray, towards: float) -> np.ndarray:
    """Square roots rounded outwards: never above the true one towards 0, never below it towards infinity."""
    return np.nextafter(np.sqrt(squared.astype(np.float64)), towards)


def _single(x: np.ndarray, towards: float) -> np.ndarray:
    return np.nextafter(x.astype("<f4"), np.float32(towards))


def assign(x: np.ndarray, book: np.ndarray, state: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Nearest entries of the parts ``x``, upper and lower bounds, and how many distances were computed.

    ``state`` is that of the last call, its bounds shifted to this book.
    """
    n, k = len(x), len(book)
    if state is None:
        d = np.stack([_squared(x, c) for c in book], axis=1)
        near = np.argmin(d, axis=1) if d.dtype != object else np.array([min(range(k), key=lambda j: (r[j], j)) for r in d], np.int64)
        return near, _root(d[np.arange(n), near], np.inf), np.maximum(0, _root(d, 0)), n * k
    near, upper, lower = (a.copy() for a in state)
    half = np.array([[_root(np.asarray(_squared(a, b)), 0) / 2 for b in book] for a in book]).reshape(k, k) * (1 - 1e-12)
    np.fill_diagonal(half, np.inf)
    open_ = np.flatnonzero(~(upper < half.min(axis=1, initial=np.inf)[near]))
    if not len(open_):
        return near, upper, lower, 0
    own, computed = x[open_], len(open_)
    best = _squared(own, book[near[open_]])
    at, u, low = near[open_], _root(best, np.inf), lower[open_]
    low[np.arange(len(at)), at] = np.maximum(0, _root(best, 0))
    for j in range(k):
        todo = np.flatnonzero((at != j) & ~(u < low[:, j]) & ~(u < half[at, j]))
        if not len(todo):
            continue
        computed += len(todo)
        d = _squared(own[todo], book[j])
        low[todo, j] = np.maximum(0, _root(d, 0))
        nearer = ((d < best[todo]) | ((d == best[todo]) & (j < at[todo]))).astype(bool)
        won = todo[nearer]
        at[won], best[won] = j, d[nearer]
        u[won] = _root(best[won], np.inf)
    near[open_], upper[open_], lower[open_] = at, u, low
    return near, upper, lower, computed


def shifted(near: np.ndarray, upper: np.ndarray, lower: np.ndarray, before: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bounds of distances to ``book``, from those of ``before``."""
    moved = np.where((before == book).all(axis=1), 0.0, _root(_squared(before, book), np.inf))
    up = np.nextafter(upper + moved[near], np.inf)
    return near, np.where(moved[near] == 0, upper, up), np.maximum(0, np.where(moved == 0, lower, np.nextafter(lower - moved, -np.inf)))


def _sums(x: np.ndarray, near: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the parts of each entry by component, and how many there are."""
    total = np.zeros((k, x.shape[1]), object)
    order = np.argsort(near, kind="stable")
    count = np.bincount(near, minlength=k)
    used = np.flatnonzero(count)
    if len(used) and x.shape[1]:
        total[used] = np.add.reduceat(x[order], (np.cumsum(count) - count)[used], axis=0).astype(object)
    return total, count


def _held(batch: pa.RecordBatch, size: int) -> Iterator[tuple[dict, np.ndarray]]:
    """Rows of blocks, and their components."""
    for row in batch.to_pylist():
        n = len(row["ids"])
        kind = "<i4" if len(row["raw"]) == 4 * n * size else "<f8"
        yield row, exact(np.frombuffer(row["raw"], kind).reshape(n, size))


def _round(batches: Iterator[pa.RecordBatch], size: int, before: Book | None, book: Book) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, v in _held(batch, size):
            n, k, parts = len(v), len(book[0]), len(book)
            codes, upper, lower, sums = np.empty((parts, n), "u1"), np.empty((parts, n), "<f4"), np.empty((parts, n, k), "<f4"), []
            counts = []
            old = None
            if before is not None:
                old = np.frombuffer(row["codes"], "u1").reshape(parts, n), np.frombuffer(row["upper"], "<f4").reshape(parts, n), np.frombuffer(row["lower"], "<f4").reshape(parts, n, k)
            for p, at in enumerate(widths(size, parts)):
                state = None
                if old is not None:
                    state = shifted(old[0][p].astype(np.int64), old[1][p].astype(float), old[2][p].astype(float), before[p], book[p])
                near, up, low, _ = assign(v[:, at], book[p], state)
                codes[p], upper[p], lower[p] = near, _single(up, np.inf), np.maximum(0, _single(low, -np.inf))
                total, count = _sums(v[:, at], near, k)
                sums += [Decimal(int(t)) for t in total.ravel()]
                counts += [Decimal(int(c)) for c in count]
            held = (row["ids"], row["labels"], row["raw"], codes.tobytes(), upper.tobytes(), lower.tobytes(), sums + counts)
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(held, _TYPES)], _NAMES)


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Blocks of rows (vec_id, label, v), without bounds yet."""
    most = max(1, BLOCK_BYTES // (4 * max(1, size)))
    ids: list = []
    labels: list = []
    held = np.empty((0, size))

    def cut(n: int) -> pa.RecordBatch:
        nonlocal held
        with np.errstate(over="ignore"):
            v = np.floor(SCALE * held[:n])
        raw = v.astype("<i4" if np.abs(v).max(initial=0) < 1 << 31 else "<f8").tobytes()
        row = (ids[:n], labels[:n], raw, b"", b"", b"", [])
        held = held[n:]
        del ids[:n], labels[:n]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _TYPES)], _NAMES)

    for batch in batches:
        ids += batch.column(0).to_pylist()
        labels += batch.column(1).to_pylist()
        held = np.concatenate([held, batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, size)])
        while len(ids) >= most:
            yield cut(most)
    if ids:
        yield cut(len(ids))


def _next(book: Book, sums: dict[int, int]) -> Book:
    """Entries moved to the floor of the mean of their parts."""
    place, out = 0, []
    first = sum(b.size for b in book)
    for p, entries in enumerate(book):
        k, width = entries.shape
        new = entries.astype(object)
        for e in range(k):
            count = sums.get(first + p * k + e, 0)
            if count:
                new[e] = [sums.get(place + e * width + i, 0) // count for i in range(width)]
        place += k * width
        out.append(exact(new))
    return out


def _final(batches: Iterator[pa.RecordBatch], size: int, before: Book, book: Book) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, v in _held(batch, size):
            n, k, parts = len(v), len(book[0]), len(book)
            codes, error = np.empty((n, parts), "u1"), np.zeros(n, object)
            old = np.frombuffer(row["codes"], "u1").reshape(parts, n), np.frombuffer(row["upper"], "<f4").reshape(parts, n), np.frombuffer(row["lower"], "<f4").reshape(parts, n, k)
            for p, at in enumerate(widths(size, parts)):
                state = shifted(old[0][p].astype(np.int64), old[1][p].astype(float), old[2][p].astype(float), before[p], book[p])
                near = assign(v[:, at], book[p], state)[0]
                codes[:, p] = near
                error = error + _squared(v[:, at], book[p][near]).astype(object)
            told = [c.tobytes().hex() for c in codes]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], pa.int64()), pa.array(row["labels"], pa.string()), pa.array(told), pa.array([int(e) for e in error], pa.int64())], ["vec_id", "label", "code", "error"],
            )


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label as text, and v, of vectors whose components are all there and finite."""
    own = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("string").alias("label"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    broken = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return own.where(F.col("v").isNotNull() & ~broken)


def codebooks(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Book]:
    """(vec_id, label, code and error of each vector; the final entries of each part).

    ``rounds`` is one at least; a code has two hex digits for each part.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col, label_col)
    common = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if common is None:
        return spark.createDataFrame([], "vec_id long, label string, code string, error long"), []
    size = common["size"]
    rows = rows.where(F.size("v") == size)
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()
    start = np.array([[math.floor(SCALE * x) for x in r.v] for r in first], object).reshape(len(first), size)
    book: Book = [exact(start[:, at]) for at in widths(size, parts)]
    before: Book | None = None
    folder = f"{checkpoint_folder(spark)}/codes-{uuid.uuid4().hex}"
    small_batches(spark, 8000)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    told = spark.conf.get(key)
    state, path = rows.mapInArrow(lambda b: _blocks(b, size), STATE), None
    try:
        for k in range(rounds):
            if k:
                spark.conf.set(key, "4")  # a row is a block
            last, path = path, f"{folder}/{k}"
            state.mapInArrow(lambda b, old=before, new=book: _round(b, size, old, new), STATE).write.parquet(path)
            if last:
                removed(spark, last)
            state = spark.read.schema(STATE).parquet(path)
            sums = state.select(F.posexplode("sums").alias("place", "x")).groupBy("place").agg(F.sum("x").alias("x")).collect()
            before, book = book, _next(book, {r.place: int(r.x) for r in sums})
        coded = state.mapInArrow(lambda b, old=before, new=book: _final(b, size, old, new), "vec_id long, label string, code string, error long")
        coded.write.parquet(f"{folder}/coded")
    finally:
        spark.conf.set(key, told)
    removed(spark, path)
    return spark.read.parquet(f"{folder}/coded"), book


def codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", **settings: int) -> DataFrame:
    """Per vector: vec_id, code, error, label_error (of all vectors of its label) and the digest of the codebooks."""
    rows, book = codebooks(vectors, id_col, vector_col, label_col, **settings)
    told = ",".join(str(int(x)) for entries in book for x in entries.ravel())
    # Summed within tasks first, so that a label of many rows is a row a task.
    sums = rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    if sums.count() <= LABELS:
        sums = F.broadcast(sums)
    met = rows.alias("r").join(sums.alias("s"), F.col("r.label").eqNullSafe(F.col("s.label")))
    return met.select("vec_id", "code", "error", "label_error", F.lit(hashlib.sha256(told.encode()).hexdigest()).alias("codebooks_sha256"))
