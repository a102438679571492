"""Exact deduplication by sorting contents.

The normalised text (A-Z in lower case, null as empty) decides equality. Sampled
splitters on (leading characters, hash of the whole, identifier) range-partition
the rows; the hash stands for the bytes past the leading ones, so that splitters
stay small, and the identifier deals a text with very many copies over several
neighbouring partitions. Within partitions an external sort on leading
characters, hash and then all normalised bytes places equal texts side by side,
and each row is compared whole with the one before it. Runs whose sort key is that
of a partition's first or last row are settled in a second, small step on their
digest.

Defined results: null and empty texts are equal; a null doc_id sorts below every
other; of rows alike in text and doc_id one stays; an empty table gives an empty
result; other columns are carried untouched whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from junctura.llm.common import checkpointed, small_batches

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
PREFIX = 64  # characters of the content that lead the sort key


def _body(text: Column) -> Column:
    """The normalised text."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def content_sorted(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    """Rows so that equal contents are adjacent; ``row`` holds all columns if ``carry``."""
    name = "`" + text_col.replace("`", "``") + "`"
    body = _body(F.col(name))
    row = F.struct(*["`" + c.replace("`", "``") + "`" for c in docs.columns]) if carry else F.struct(F.col(name).alias(text_col))
    keyed = docs.select(
        row.alias("row"), F.col("`" + id_col.replace("`", "``") + "`").cast("long").alias("id"),
        F.left(body, F.lit(PREFIX)).alias("head"), F.xxhash64(body).alias("hash"),
    )
    key, last = [F.col("head"), F.col("hash")], F.col("id").desc_nulls_last()
    # The bytes themselves are looked at where head and hash tie.
    return keyed.repartitionByRange(*key, last).sortWithinPartitions(*key, _body(F.col("row")[text_col]), last)


def _runs(batches: Iterator[pa.RecordBatch], text_col: str, rows: bool) -> Iterator[tuple]:
    """Runs of equal content of one sorted partition: lists of (digest, ids, first row), one list a key.

    A row belongs to the run of the one before it if both are equal byte by byte.
    """
    key, last, found = None, None, []
    for batch in batches:
        row = batch.column("row")
        text = row.field(text_col).cast(pa.binary())
        keys = zip(batch.column("head").to_pylist(), batch.column("hash").to_pylist(), batch.column("id").to_pylist())
        for i, (head, hashed, doc_id) in enumerate(keys):
            body = (text[i].as_py() or b"").translate(LOWER)
            if (head, hashed) != key:
                yield found
                key, last, found = (head, hashed), None, []
            if body == last:
                found[-1][1].append(doc_id)
            else:
                found.append((hashlib.sha256(body).hexdigest(), [doc_id], row[i].as_py() if rows else None))
                last = body
    yield found


def _marked(keys: Iterator[list[tuple]]) -> Iterator[tuple]:
    """(run, whether it may go on in a neighbouring partition).

    Any run of the first and of the last key may, should contents share a key.
    """
    held, first = None, True
    for runs in filter(None, keys):
        if held is not None:
            yield from ((run, first) for run in held)
            first = False
        held = runs
    yield from ((run, True) for run in held or ())


GROUPS = "doc_id long, text_sha256 string, keep_id long, group_size long, kept boolean, edge boolean, part int, head boolean"


def _group_batches(batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[pa.RecordBatch]:
    names = ("doc_id", "text_sha256", "keep_id", "group_size", "kept", "edge", "part", "head")
    types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int32(), pa.bool_())
    part, out = TaskContext.get().partitionId(), []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    for (digest, ids, _), edge in _marked(_runs(batches, text_col, False)):
        for k, doc_id in enumerate(ids):
            out.append((doc_id, digest, ids[0], len(ids), k == 0, edge, part, k == 0))
            if len(out) >= 8192:
                yield batch()
                out.clear()
    if out:
        yield batch()


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    The row with the largest doc_id of equal texts stays.
    """
    small_batches(docs.sparkSession)
    found = content_sorted(docs, id_col, text_col, False)
    found = checkpointed(found.mapInArrow(lambda batches: _group_batches(batches, text_col), GROUPS))
    # Runs of at most two keys a partition reach its edge, so this table has twice
    # as many rows as partitions, and as many more as contents share those keys.
    edges = (
        found.where("edge and head").groupBy("text_sha256")
        .agg(F.max("keep_id").alias("top"), F.sum("group_size").alias("all"), F.max(F.struct("doc_id", "part")).alias("best"))
    )
    return found.join(F.broadcast(edges), "text_sha256", "left").select(
        "doc_id",
        F.when(F.col("edge"), F.col("top")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(F.col("edge"), F.col("all")).otherwise(F.col("group_size")).alias("group_size"),
        F.when(F.col("edge"), F.col("kept") & F.struct("doc_id", "part").eqNullSafe(F.col("best"))).otherwise(F.col("kept")).alias("kept"),
        "text_sha256",
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    small_batches(docs.sparkSession)
    schema = T.StructType([
        T.StructField("row", docs.schema), T.StructField("digest", T.StringType()),
        T.StructField("edge", T.BooleanType()), T.StructField("part", T.IntegerType()), T.StructField("id", T.LongType()),
    ])

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, part = None, TaskContext.get().partitionId()

        def seen() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for b in batches:
                kind = b.schema.field("row").type
                yield b

        def batch() -> pa.RecordBatch:
            row, digest, edge, ids = zip(*out)
            return pa.RecordBatch.from_arrays(
                [pa.array(row, kind), pa.array(digest), pa.array(edge), pa.array([part] * len(out), pa.int32()), pa.array(ids, pa.int64())],
                ["row", "digest", "edge", "part", "id"],
            )

        out: list[tuple] = []
        size = 0
        for (digest, ids, row), edge in _marked(_runs(seen(), text_col, True)):
            out.append((row, digest, edge, ids[0]))
            size += len(row.get(text_col) or "")
            if len(out) >= 500 or size > 4_000_000:
                yield batch()
                out.clear()
                size = 0
        if out:
            yield batch()

    found = checkpointed(content_sorted(docs, id_col, text_col, True).mapInArrow(heads, schema))
    edges = found.where("edge").groupBy("digest").agg(F.max(F.struct("id", "part")).alias("best"))
    joined = found.join(F.broadcast(edges), "digest", "left")
    return joined.where(~F.col("edge") | F.struct("id", "part").eqNullSafe(F.col("best"))).select("row.*")
