"""Near copies by SimHash and pivot distance tables, verified by the exact Jaccard similarity of their word shingles.

1. Every text becomes the set of its hashed shingles (64 bits each). Equal sets
   fold into one node, which keeps a sketch: the set's size, 24 bits of each
   band's key, and the set's fingerprint (SimHash, ``BITS`` bits).
2. Bands of ``ROWS`` minima deal the nodes into buckets. Two sets with similarity
   0.8 share none of the 24 buckets with probability 3 in a million, whatever
   their sizes; more similar ones are missed less.
3. In every bucket a pivot distance table holds the Hamming distances of the
   fingerprints to ``PIVOTS`` references, which are fingerprints of the bucket
   itself. Pairs that differ by more than the radius in some coordinate are
   discarded (triangle inequality), then those whose fingerprints do, and those
   whose sizes rule the similarity out. At 0.8 a link's fingerprints are beyond
   the radius with a probability of 3 in 10 million at most (calculated for all
   small sets and in the limit), whatever the sets' sizes.
4. First each node of a bucket is paired with the next one alone, which joins
   large groups of near copies by few pairs.
5. In buckets that still hold several parts, all pairs follow whose nodes aren't
   in one part yet, each in the first bucket that it shares. Their sets come to
   the bucket once a node, so that no table has a row for each pair; a bucket over
   ``CELL_ROWS`` rows or ``CELL_BYTES`` of sets is dealt in pairs of chunks.
6. Sets are compared whole; a pair is a link if the shared part of its union
   reaches the similarity, and not otherwise. Star contraction joins the links.

Step 2 stands before the pivots since blocks of bit positions that miss as few
pairs at this radius, a quarter of all bits, would be four times as many and hold
thousands of unrelated rows each. Buckets and fingerprints only say what is
compared, never what is linked. Texts of fewer words
than a shingle are one shingle; those without words are all equal.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from junctura.llm.common import checkpointed, components, frugal, small_batches
from junctura.llm.simhash import PIVOTS, SEED, _binary, _matrix, _mix, hashed_shingles, majority

BANDS, ROWS = 24, 4
BITS, KEY = 512, 3  # bits of a fingerprint; bytes of a band's key in a sketch
WIDTH = 4 + KEY * BANDS + BITS // 8  # bytes of a sketch
# Sets under SMALL shingles may differ in more bits than the angle between sets says: by a quarter at most, others by a fourteenth.
SMALL, SPREAD, DEVIATIONS = 12, (1.25, 1.07), 5.2
CHUNK = 512  # shingles whose minima are taken at once
NEXT = 64  # rows of a bucket whose pairs are looked through in the first pass
BLOCK = 1 << 13  # pairs of fingerprints compared at once
CELL_ROWS, CELL_BYTES = 1 << 13, 32 << 20
FEW = 200_000  # nodes that are broadcast, of 16 bytes each, to pick texts without moving all of them
_ODD = np.random.default_rng(SEED).integers(0, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: bytes, shingle: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    return np.unique(hashed_shingles(text, shingle))


def minima(own: np.ndarray) -> np.ndarray:
    """Least value of a set under each hash function."""
    out = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for i in range(0, len(own), CHUNK):
        np.minimum(out, np.multiply.outer(own[i : i + CHUNK], _ODD).min(axis=0), out=out)
    return out


def _node(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


@frugal
def _sketches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    step = np.arange(BANDS, dtype=np.uint64)[None]
    for batch in batches:
        sets = [shingle_set(t.as_py() or b"", shingle) for t in batch.column(2).cast(pa.binary())]
        least = np.array([minima(s) for s in sets], np.uint64).reshape(-1, BANDS * ROWS)
        key = np.broadcast_to(step, (len(sets), BANDS))
        with np.errstate(over="ignore"):
            for r in range(ROWS):
                key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + least[:, r::ROWS])
        own = np.ascontiguousarray(key).view(np.uint8)
        bands = own.reshape(-1, BANDS, 8)[:, :, 8 - KEY :].reshape(-1, KEY * BANDS)
        prints = np.frombuffer(b"".join(majority(s, BITS) for s in sets), np.uint8).reshape(-1, BITS // 8)
        size = np.array([len(s) for s in sets], np.uint32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([_node(s) for s in sets], pa.binary()),
             _binary(np.c_[size.view(np.uint8).reshape(-1, 4), bands, prints]), _binary(own)],
            ["doc_id", "digest", "node", "sketch", "bands"],
        )


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a band: key, whose last five bits are the band's number, and node."""
    for batch in batches:
        keys = _matrix(batch.column("bands"), 8 * BANDS).view(np.int64).reshape(-1, BANDS) & -32 | np.arange(BANDS)
        for k in range(BANDS):
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(keys[:, k])), batch.column("node")], ["key", "node"])


@frugal
def _several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the buckets that hold two or more, sorted by key."""
    for table in _buckets(batches):
        key = table.column("key").to_numpy()
        same = key[1:] == key[:-1]
        yield from table.filter(pa.array(np.r_[False, same] | np.r_[same, False])).combine_chunks().to_batches()


def _buckets(batches: Iterator[pa.RecordBatch], by: str = "key") -> Iterator[pa.Table]:
    """Tables that hold whole buckets of rows sorted by their key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(by).to_numpy(zero_copy_only=False)
        at = int(np.searchsorted(key, key[-1]))
        if held and key[-1] != held[-1].column(by)[-1].as_py():
            yield pa.Table.from_batches([*held, batch.slice(0, at)])
            held = [batch.slice(at)]
        elif held or at == 0:
            held.append(batch)
        else:
            yield pa.Table.from_batches([batch.slice(0, at)])
            held = [batch.slice(at)]
    if held:
        yield pa.Table.from_batches(held)


def radii(similarity: float) -> tuple[int, int]:
    """Bits in which fingerprints of sets with the similarity differ at most: where one has under ``SMALL`` shingles, and otherwise."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return tuple(math.ceil(BITS * p + DEVIATIONS * (BITS * p * (1 - p)) ** 0.5) for p in (min(0.5, share * more) for more in SPREAD))


def pivot_table(words: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Hamming distances of fingerprints to ``PIVOTS`` references of their bucket.

    References lie evenly in a bucket; its order, by digest, is as good as random.
    """
    table = np.empty((len(words), PIVOTS), np.int16)
    for k in range(PIVOTS):
        table[:, k] = np.bitwise_count(words ^ words[np.repeat(start + count * k // PIVOTS, count)]).sum(axis=1)
    return table


class Sketches:
    """Fingerprints of rows in buckets with their pivot distance table, to say which pairs are worth a comparison."""

    def __init__(self, column: pa.ChunkedArray, similarity: float, start: np.ndarray, count: np.ndarray) -> None:
        rows = _matrix(column, WIDTH)
        self.size, self.bands = np.ascontiguousarray(rows[:, :4]).view(np.uint32)[:, 0].astype(np.float64), rows[:, 4 : 4 + KEY * BANDS]
        self.words = np.ascontiguousarray(rows[:, 4 + KEY * BANDS :]).view(np.uint64)
        self.table = pivot_table(self.words, start, count)
        self.similarity, self.radii = similarity, radii(similarity)

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        small, large = np.minimum(self.size[a], self.size[b]), np.maximum(self.size[a], self.size[b])
        out, radius = small >= self.similarity * large - 1e-6, np.where(small < SMALL, *self.radii)
        left = np.flatnonzero(out)
        for i in range(0, len(left), BLOCK):
            some = left[i : i + BLOCK]
            x, y, most = a[some], b[some], radius[some]
            close = np.abs(self.table[x] - self.table[y]).max(axis=1) <= most
            x, y = x[close], y[close]
            close[close] = np.bitwise_count(self.words[x] ^ self.words[y]).sum(axis=1) <= most[close]
            out[some] = close
        return out


ROW = "key long, node binary, other binary, sketch binary"
CELL = "cell long, key long, node binary, label binary, sketch binary"


@frugal
def _first(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Pairs (null, node, other, null) of neighbours, and rows (key, node, null, sketch) that have more to compare."""
    for table in _buckets(batches):
        key = table.column("key").to_numpy()
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        count = np.diff(np.r_[start, len(key)])
        if count.max() < 2:
            continue
        sketches, more = Sketches(table.column("sketch"), similarity, start, count), np.repeat(count > NEXT, count)
        few = np.repeat((count <= NEXT) & (count > 2), count)
        for d in range(1, min(NEXT, int(count.max()))):
            a = np.flatnonzero((few[:-d] if d > 1 else True) & (key[d:] == key[:-d]))
            if not len(a):
                break
            a = a[sketches.near(a, a + d)]
            if d > 1:
                more[a] = more[a + d] = True
            elif len(a):
                node = table.column("node")
                yield pa.RecordBatch.from_arrays([pa.nulls(len(a), pa.int64()), node.take(a).combine_chunks(), node.take(a + 1).combine_chunks(), pa.nulls(len(a), pa.binary())], ["key", "node", "other", "sketch"])
        if more.any():
            rest = table.filter(pa.array(more)).combine_chunks()
            for b in rest.to_batches():
                yield pa.RecordBatch.from_arrays([b.column("key"), b.column("node"), pa.nulls(b.num_rows, pa.binary()), b.column("sketch")], ["key", "node", "other", "sketch"])


class Cell:
    """Rows of one bucket, or of two chunks of one, that may hold links between parts."""

    def __init__(self, table: pa.Table, similarity: float) -> None:
        self.sketches = Sketches(table.column("sketch"), similarity, np.zeros(1, np.int64), np.array([table.num_rows]))
        self.band = int(table.column("key")[0].as_py()) & 31
        self.label = table.column("label").combine_chunks().dictionary_encode().indices.to_numpy().copy()
        self.part = np.arange(int(self.label.max()) + 1)

    def near(self, i: int) -> np.ndarray:
        """Later rows of other parts that neither pivots nor fingerprints rule out, if this is the first bucket that the pair shares."""
        own = self.part[self.label]
        b = np.flatnonzero(own[i + 1 :] != own[i]) + i + 1
        b = b[self.sketches.near(np.full(len(b), i), b)]
        if len(b) and self.band:
            bands = self.sketches.bands[:, : KEY * self.band]
            shared = (bands[b] == bands[i]).reshape(len(b), self.band, KEY).all(axis=2).any(axis=1)
            b = b[~shared]
        return b

    def join(self, i: int, b: np.ndarray) -> None:
        for j in b:
            x, y = self.part[self.label[i]], self.part[self.label[j]]
            self.part[self.part == max(x, y)] = min(x, y)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    for table in _buckets(batches, "cell"):
        cell = table.column("cell").to_numpy()
        start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        for s, e in zip(start.tolist(), [*start[1:].tolist(), len(cell)]):
            yield table.slice(s, e - s)


@frugal
def _open(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Rows that have a pair to compare."""
    for table in _cells(batches):
        cell = Cell(table, similarity)
        kept = np.zeros(table.num_rows, bool)
        for i in range(table.num_rows - 1):
            if len(b := cell.near(i)):
                kept[i] = True
                kept[b] = True
        if kept.any():
            yield from table.filter(pa.array(kept)).combine_chunks().to_batches()


@frugal
def _compared(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Labels (a, b) of the parts that links join."""
    for table in _cells(batches):
        cell, label = Cell(table, similarity), table.column("label").combine_chunks()
        raw = table.column("own").to_pylist()
        size = np.array([len(r) // 8 for r in raw], np.int64)
        number = np.unique(np.frombuffer(b"".join(raw), np.uint64), return_inverse=True)[1]
        end = np.cumsum(size)
        held = np.zeros(int(number.max()) + 1 if len(number) else 1, np.int64)
        a, b = [], []
        for i in range(len(raw) - 1):
            near = cell.near(i)
            if not len(near):
                continue
            own = number[end[i] - size[i] : end[i]]
            held[own] = 1
            n = size[near]
            begin = np.cumsum(n) - n
            shared = np.add.reduceat(held[number[np.repeat(end[near] - n - begin, n) + np.arange(int(n.sum()))]], begin)
            held[own] = 0
            near = near[shared / (size[i] + n - shared) >= similarity]
            cell.join(i, near)
            a += [i] * len(near)
            b += near.tolist()
        if a:
            yield pa.RecordBatch.from_arrays([label.take(pa.array(a)), label.take(pa.array(b))], ["a", "b"])


@frugal
def _linked(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Pairs whose sets reach the similarity."""
    for batch in batches:
        keep = []
        for one, two in zip(batch.column("own"), batch.column("its")):
            one, two = np.frombuffer(one.as_py(), np.uint64), np.frombuffer(two.as_py(), np.uint64)
            shared = len(np.intersect1d(one, two, assume_unique=True))
            keep.append(shared / (len(one) + len(two) - shared) >= similarity)
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _size(sketch: F.Column) -> F.Column:
    """Shingles of a set, from the first four bytes of its sketch, the lowest first."""
    byte = lambda i: F.conv(F.hex(F.substring(sketch, i, 1)), 16, 10).cast("long")
    return byte(1) + 256 * (byte(2) + 256 * (byte(3) + 256 * byte(4)))


def _digest(text) -> F.Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row per document: doc_id, print (digest of the shingle set), component_id.

    component_id is the smallest doc_id reachable over links of shingle sets with
    at least ``similarity``.
    """
    spark = docs.sparkSession
    small_batches(spark)
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), _digest(text).alias("digest"), text.alias("text"))
    prints = checkpointed(rows.mapInArrow(lambda b: _sketches(b, shingle), "doc_id long, digest binary, node binary, sketch binary, bands binary"))
    nodes = prints.groupBy("node").agg(F.min("doc_id").alias("first"), F.first(F.struct("digest", "sketch", "bands")).alias("one"))
    nodes = checkpointed(nodes.select("node", "first", "one.*"))
    n = nodes.count()

    @frugal
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [shingle_set(t.as_py() or b"", shingle) for t in batch.column(0).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array([_node(s) for s in own], pa.binary()), pa.array([s.tobytes() for s in own], pa.binary())], ["node", "own"])

    def sets_of(some: DataFrame) -> DataFrame:
        """node and own, its set, of the nodes in ``some``."""
        wanted = checkpointed(some.join(nodes, "node").select("digest"), n)
        # Few are broadcast; for many the texts are dealt by digest.
        found = rows.join(F.broadcast(wanted) if wanted.count() <= FEW else wanted.hint("merge"), "digest", "left_semi").select("text")
        # Rows alike in text give the same set several times.
        return checkpointed(found.mapInArrow(sets, "node binary, own binary").groupBy("node").agg(F.first("own").alias("own")))

    def verified(pairs: DataFrame) -> DataFrame:
        held = sets_of(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct())
        both = pairs.join(held.select(F.col("node").alias("a"), "own"), "a").join(held.select(F.col("node").alias("b"), F.col("own").alias("its")), "b")
        return checkpointed(both.select("a", "b", "own", "its").mapInArrow(lambda b: _linked(b, similarity), "a binary, b binary"))

    dealt = nodes.where(F.col("sketch").substr(1, 4) != F.lit(bytes(4))).select("node", "bands").mapInArrow(_dealt, "key long, node binary")
    # Most sets are alone in their buckets, so sketches travel for the others only.
    dealt = dealt.repartition("key").sortWithinPartitions("key").mapInArrow(_several, "key long, node binary").join(nodes.select("node", "sketch"), "node")
    dealt = dealt.select("key", "node", "sketch").repartition("key").sortWithinPartitions("key", "node").mapInArrow(lambda b: _first(b, similarity), ROW)
    dealt = checkpointed(dealt)
    ordered = [F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")]
    tried = checkpointed(dealt.where("other is not null").select(*ordered).distinct())
    edges = verified(tried)
    label = components(edges)
    # Labels of the first pass are the nodes of the second.
    label = checkpointed(nodes.select("node").join(label, "node", "left").select("node", F.coalesce("label", "node").alias("label")), n)
    rest = dealt.where("other is null").select("key", "node", "sketch").join(label, "node")
    rest = checkpointed(rest.withColumn("bytes", 8 * _size(F.col("sketch"))))
    cells = F.ceil(F.greatest(F.count("*") / F.lit(CELL_ROWS), F.sum("bytes") / F.lit(CELL_BYTES))).cast("int")
    mixed = rest.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), cells.alias("n"))
    rest = rest.join(mixed.where("low <> high").select("key", "n"), "key").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("n")))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    cell = F.xxhash64("key", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("cell")
    rest = rest.select(cell, "key", "node", "label", "sketch").repartition("cell").sortWithinPartitions("cell", "node")
    rest = checkpointed(rest.mapInArrow(lambda b: _open(b, similarity), CELL))
    if not rest.isEmpty():
        both = rest.join(sets_of(rest.select("node").distinct()), "node").select("cell", "key", "node", "label", "sketch", "own")
        more = both.repartition("cell").sortWithinPartitions("cell", "node").mapInArrow(lambda b: _compared(b, similarity), "a binary, b binary")
        more = components(checkpointed(more)).select(F.col("node").alias("label"), F.col("label").alias("joined"))
        label = label.join(more, "label", "left").select("node", F.coalesce("joined", "label").alias("label"))
    parts = checkpointed(label.join(nodes.select("node", "first"), "node"), n)
    least = checkpointed(parts.groupBy("label").agg(F.min("first").alias("component_id")), n)
    linked = parts.join(least, "label").select("node", "component_id")
    named = nodes.select("node", "first").join(linked, "node", "left")
    named = checkpointed(named.select("node", F.coalesce("component_id", "first").alias("component_id")), n)
    return prints.select("doc_id", "node").join(named, "node").select("doc_id", F.col("node").alias("print"), "component_id")
