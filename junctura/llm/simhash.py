"""SimHash near-dedup over pivot distance tables.

1. Every text becomes a fingerprint: a bit is 1 if it is set in over half of the
   hashes of its word shingles. Equal fingerprints fold into one node.
2. Blocks of bit positions deal the fingerprints into buckets: ``exact_tables``
   covers every pair within the radius by the pigeonhole principle twice,
   ``sampled_tables`` finds pairs at larger radii with high probability.
3. Within every bucket a pivot distance table holds the Hamming distances to
   ``PIVOTS`` reference fingerprints. Pairs whose coordinates differ by more than
   the radius anywhere can't be links (triangle inequality) and are discarded, in
   buckets of over 32 rows by order of the first coordinate; the others are
   verified by their distance.
4. A bucket reports a spanning star of each of its connected parts, never all
   pairs. A bucket over ``LIMIT`` rows is dealt again, in pairs of chunks.
5. Star contraction joins the parts; nothing of the corpus reaches the driver.

Step 2 stands before the pivots since their coordinates alone don't index 64-bit
fingerprints: distances to a reference crowd around 32 +- 4, so 46 % of all
unrelated pairs pass a coordinate at radius 3 and 0.2 % pass all eight, a number
that grows with the square of the corpus.

Defined results: null and empty texts, and texts without words, have the zero
fingerprint and link like any other; a null doc_id never becomes a component's
identifier unless the whole component has none; repeated rows are repeated.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from junctura.llm.common import checkpointed, components, merge, small_batches
from junctura.llm.contentsort import LOWER

SEED = 42
CHUNK = 1 << 12  # shingles whose bits are counted at once
PIVOTS = 8
BUCKET = 4096  # rows of a bucket on average at most, in sampled tables
LIMIT = 16384  # rows of a bucket that one task compares
BLOCK = 64  # rows compared at once with the rest of their bucket
PAIRS = 1 << 16  # pairs verified at once
COARSE = 4  # words of 64 bits that are compared first


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hashed_shingles(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 of a text's word shingles in order; a text under ``shingle`` words is one."""
    words = text.translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    body = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    return np.fromiter(map(xxhash.xxh64_intdigest, (body[a:b] for a, b in zip(starts, ends)), repeat(SEED)), np.uint64, n)


def majority(hashed: np.ndarray, bits: int = 64) -> bytes:
    """Bits that are set in over half of some hashes; lanes beyond the first 64 bits are mixed from them."""
    counts = np.zeros(bits, np.int64)
    for i in range(0, len(hashed), CHUNK):
        h = hashed[i : i + CHUNK]
        lanes = np.empty((len(h), bits // 64), ">u8")
        lanes[:, 0] = h
        with np.errstate(over="ignore"):
            for k in range(1, bits // 64):
                lanes[:, k] = _mix(h + np.uint64((k * 0x9E3779B97F4A7C15) & (2**64 - 1)))
        rows = np.unpackbits(lanes.view(np.uint8).reshape(len(h), -1), axis=1)
        for j in range(0, len(rows), 255):  # as many as a byte counts
            counts += rows[j : j + 255].sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(hashed)).tobytes()


def fingerprint(text: bytes, shingle: int = 3, bits: int = 64, distinct: bool = False) -> bytes:
    """Fingerprint of a text in UTF-8, most significant bit first.

    The first 64 bits come from XXH64 with seed 42 itself; further lanes are
    mixed from it. Repeated shingles count as often as they occur unless
    ``distinct``.
    """
    hashed = hashed_shingles(text, shingle)
    return majority(np.unique(hashed) if distinct else hashed, bits)


def exact_tables(bits: int = 64, radius: int = 3) -> list[list[int]]:
    """Sets of positions such that any two within ``radius`` agree on one of them.

    Of radius + 1 blocks one is free of differences; of radius + 1 blocks of the
    remaining positions again one.
    """
    out = []
    for block in np.array_split(np.arange(bits), radius + 1):
        rest = np.setdiff1d(np.arange(bits), block)
        out += [[*block.tolist(), *more.tolist()] for more in np.array_split(rest, radius + 1)]
    return out


def sampled_tables(bits: int, differ: float, count: int, missed: float = 0.03, seed: int = SEED) -> list[list[int]]:
    """Random sets of positions, so many that a pair with a share ``differ`` of its bits apart agrees on none with probability ``missed``.

    Sets are so wide that a bucket of ``count`` fingerprints' table has
    ``BUCKET`` rows or fewer on average, 12 positions at least; they are disjoint
    while the positions last.
    """
    width = max(12, math.ceil(math.log2(max(count, 1) / BUCKET)))
    tables = math.ceil(math.log(missed) / math.log1p(-((1 - differ) ** width)))
    rng, order, out = np.random.default_rng(seed), np.empty(0, int), []
    while len(out) < tables:
        if len(order) < width:
            order = rng.permutation(bits)
        out.append(order[:width].tolist())
        order = order[width:]
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as a binary column."""
    rows = np.ascontiguousarray(rows)
    at = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(at), pa.py_buffer(rows)])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _roots(n: int) -> np.ndarray:
    return np.arange(n)


def _links(key: np.ndarray, prints: np.ndarray, radius: int) -> np.ndarray:
    """Root of every row under links within runs of equal (sorted) keys."""
    n = len(key)
    label = _roots(n)
    words = np.ascontiguousarray(prints).view(np.uint64).reshape(n, -1)
    pivots = np.random.default_rng(SEED).integers(0, 2**64, (PIVOTS, words.shape[1]), np.uint64)
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    count = np.diff(np.r_[start, n])

    # The first words alone rule out most pairs of long fingerprints: what they
    # may differ in is the radius' share and four deviations more.
    first = min(COARSE, words.shape[1])
    share = radius / (64 * words.shape[1])
    coarse = radius if first == words.shape[1] else 64 * first * share + 4 * (64 * first * share * (1 - share)) ** 0.5

    def close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        near = np.bitwise_count(words[a, :first] ^ words[b, :first]).sum(axis=1, dtype=np.int64) <= coarse
        if first < words.shape[1]:
            some = np.flatnonzero(near)
            near[some] = np.bitwise_count(words[a[some]] ^ words[b[some]]).sum(axis=1, dtype=np.int64) <= radius
        return near

    table = np.stack([np.bitwise_count(words ^ p).sum(axis=1, dtype=np.int16) for p in pivots], axis=1)

    # Small buckets together: every row against the one d places on.
    small = np.repeat(count <= 32, count)
    for d in range(1, int(min(32, count.max(initial=0)))):
        a = np.flatnonzero(small[:-d] & (key[d:] == key[:-d]))
        if not len(a):
            break
        a = a[(np.abs(table[a] - table[a + d]) <= radius).all(axis=1)]
        a = a[close(a, a + d)]
        merge(label, a, a + d)
    for s, m in zip(start[count > 32], count[count > 32]):
        order = np.argsort(table[s : s + m, 0], kind="stable")
        own, place = words[s + order], table[s + order]
        till = np.searchsorted(place[:, 0], place[:, 0] + radius, "right")
        for i in range(0, m, BLOCK):
            j = min(i + BLOCK, m)
            end = int(till[j - 1])
            # Rows that are joined already need no further look at each other.
            part = label[order + s]
            near = part[i:j, None] != part[None, i:end]
            for c in range(PIVOTS):
                near &= np.abs(place[i:j, c, None] - place[None, i:end, c]) <= radius
            apart = np.zeros(near.shape, np.uint16)
            for c in range(first):
                apart += np.bitwise_count(own[i:j, None, c] ^ own[None, i:end, c])
            a, b = np.nonzero(near & (apart <= coarse))
            a, b = order[a[a < b] + i] + s, order[b[a < b] + i] + s
            for k in range(0, len(a), PAIRS):
                x, y = a[k : k + PAIRS], b[k : k + PAIRS]
                linked = close(x, y)
                merge(label, x[linked], y[linked])
    return label


def _stars(key: np.ndarray, prints: np.ndarray, radius: int) -> pa.RecordBatch | None:
    label = _links(key, prints, radius)
    moved = np.flatnonzero(label != np.arange(len(label)))
    if not len(moved):
        return None
    return pa.RecordBatch.from_arrays(
        [pa.nulls(len(moved), pa.int64()), _binary(prints[moved]), _binary(prints[label[moved]])], ["key", "a", "b"]
    )


def _bucket_batches(batches: Iterator[pa.RecordBatch], width: int, radius: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Edges (null, a, b) of buckets sorted by key; (key, a, null) for rows of larger buckets."""
    key, prints, heavy = np.empty(0, np.int64), np.empty((0, width), np.uint8), None
    for batch in batches:
        key = np.r_[key, batch.column("key").to_numpy(zero_copy_only=False)]
        prints = np.r_[prints, _matrix(batch.column("a"), width)]
        if not len(key):
            continue
        last = int(np.searchsorted(key, key[-1]))
        if last and last - int(np.searchsorted(key, key[0])) >= 0:
            done = np.flatnonzero(key[:last] != heavy) if heavy is not None else np.arange(last)
            late = np.flatnonzero(key[:last] == heavy) if heavy is not None else []
            if len(late):
                yield pa.RecordBatch.from_arrays([pa.array(key[late]), _binary(prints[late]), pa.nulls(len(late), pa.binary())], ["key", "a", "b"])
            if len(done) and (found := _stars(key[done], prints[done], radius)):
                yield found
            key, prints, heavy = key[last:], prints[last:], None
        if heavy is not None or len(key) > limit:
            heavy = key[0]
            yield pa.RecordBatch.from_arrays([pa.array(key), _binary(prints), pa.nulls(len(key), pa.binary())], ["key", "a", "b"])
            key, prints = key[:0], prints[:0]
    if len(key) and (found := _stars(key, prints, radius)):
        yield found


def _fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int, bits: int, distinct: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(1).cast(pa.binary())
            prints = [fingerprint(t.as_py() or b"", shingle, bits, distinct) for t in text]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.binary())], ["doc_id", "print"])

    pair = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return pair.mapInArrow(run, "doc_id long, print binary")


def _keyed(prints: DataFrame, width: int, tables: list[list[int]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column(0), width)
            bits = np.unpackbits(rows, axis=1)
            for k, at in enumerate(tables):
                key = bits[:, at].astype(np.int64) @ (np.int64(1) << np.arange(len(at), dtype=np.int64)) + (k << 40)
                yield pa.RecordBatch.from_arrays([pa.array(key), batch.column(0)], ["key", "a"])

    return prints.mapInArrow(run, "key long, a binary")


def _in_buckets(keyed: DataFrame, width: int, radius: int, limit: int) -> DataFrame:
    return keyed.sortWithinPartitions("key").mapInArrow(lambda b: _bucket_batches(b, width, radius, limit), "key long, a binary, b binary")


def links(prints: DataFrame, bits: int, radius: int, tables: list[list[int]], limit: int = LIMIT) -> DataFrame:
    """Spanning edges (a, b) of the links among distinct fingerprints (column print)."""
    width = bits // 8
    found = checkpointed(_in_buckets(_keyed(prints, width, tables).repartition("key"), width, radius, limit))
    edges, heavy = found.where("key is null").select("a", "b"), found.where("key is not null").select("key", "a")
    if not heavy.isEmpty():
        # Chunks of half the limit; each pair of chunks meets in one cell.
        sizes = checkpointed(heavy.groupBy("key").agg(F.ceil(F.count("*") / F.lit(limit // 4)).alias("n")))
        cells = heavy.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("a"), F.col("n")))
        cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
        cells = cells.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "a")
        # The cells' sizes are even up to hashing, so no row is put off again.
        edges = edges.union(_in_buckets(cells.repartition("key"), width, radius, 1 << 62).select("a", "b"))
    return edges


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bits: int = 64, radius: int = 3,
    distinct: bool = False, exact: bool = True, limit: int = LIMIT, similarity: float | None = None,
) -> DataFrame:
    """One row per document: doc_id, print (binary), component_id.

    component_id is the smallest doc_id reachable over links of fingerprints that
    differ in at most ``radius`` bits. Not ``exact``, the tables are sampled and a
    pair at the radius is missed with probability 0.03. With a ``similarity`` the
    links are the pairs whose sets of shingles have at least that Jaccard
    similarity, each of them verified, and print is the digest of the set.
    """
    if similarity is not None:
        from junctura.llm.shingles import jaccard_groups

        return jaccard_groups(docs, id_col, text_col, shingle, similarity)
    small_batches(docs.sparkSession)
    prints = checkpointed(_fingerprints(docs, id_col, text_col, shingle, bits, distinct))
    nodes = checkpointed(prints.groupBy("print").agg(F.min("doc_id").alias("first")))
    n = nodes.count()
    tables = exact_tables(bits, radius) if exact else sampled_tables(bits, radius / bits, n)
    parts = components(links(nodes.select("print"), bits, radius, tables, limit))
    parts = parts.select(F.col("node").alias("print"), "label").join(nodes, "print")
    parts = checkpointed(parts, n)
    least = checkpointed(parts.groupBy("label").agg(F.min("first").alias("component_id")), n)
    linked = checkpointed(parts.join(least, "label").select("print", "component_id"), n)
    named = checkpointed(nodes.join(linked, "print", "left").select("print", F.coalesce("component_id", "first").alias("component_id")), n)
    return prints.join(named, "print").select("doc_id", "print", "component_id")


#: Jaccard similarity of 0.8 or more on the sets of five-word shingles.
NEAR = {"shingle": 5, "similarity": 0.8}


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` less all but the smallest doc_id of each near-duplicate group.

    Rows that share a doc_id count as one document; a null doc_id stays.
    """
    found = simhash_groups(docs, id_col, text_col, exact=False, **NEAR)
    gone = checkpointed(found.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct())
    return docs.alias("d").join(gone.alias("g"), F.col(f"d.`{id_col}`").cast("long") == F.col("g.__gone"), "left_anti")
