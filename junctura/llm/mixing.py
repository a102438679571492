"""Mixing sources to target weights by Sainte-Lague apportionment.

Targets come from the weights, capped at a multiple of a source's own size, the
excess reshared. Blocks of equal length in words are seats: they go to sources
by the highest quotients target / (2 seats + 1), and each source's seats go to
its shards in the same way, so every shard has an integer quota. Within a shard
documents lie in a seeded order and the quota's blocks are taken from a seeded
block on, round after round where a shard gives more than it holds.

What reaches the driver are totals by source and by shard; there are at most
``MAX_SHARDS`` shards plus one for each source, and the quota table that is
broadcast has that bound too.

Defined results: null and empty texts have size 0 and take nothing; a null
source is a source of its own, last in order; repeated rows and ties are
interchangeable; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from junctura.llm.common import checkpointed, word_count

WEIGHTS = (5, 2, 1)
REPEATS = 3  # times its size that a source gives at most
SEED = 42
BLOCK = 256  # words of a block at most
SHARD = 100_000  # words of a shard at least
MAX_SHARDS = 200_000


def targets(sizes: list[int], weights: list[float], repeats: int = REPEATS) -> list[float]:
    """Share the sum of ``sizes`` by weight; none is above ``repeats`` times its size."""
    out = [0.0] * len(sizes)
    free, left = set(range(len(sizes))), Fraction(sum(sizes))
    while free:
        total = sum(Fraction(weights[i]) for i in free)
        if not total:
            break
        full = [i for i in free if left * Fraction(weights[i]) / total > repeats * sizes[i]]
        if not full:
            for i in free:
                out[i] = float(left * Fraction(weights[i]) / total)
            break
        for i in full:
            out[i] = float(repeats * sizes[i])
            left -= repeats * sizes[i]
            free.discard(i)
    return out


def apportion(votes: list[float], seats: int) -> list[int]:
    """Sainte-Lague seats of each party; ties go to the earlier one.

    Seats by the highest quotients votes / (2 s + 1) are the rounded quotas of
    one common divisor; from a rounding near it the last few are set right.
    """
    total = sum(votes)
    if seats <= 0 or total <= 0:
        return [0] * len(votes)
    votes = [Fraction(v) for v in votes]
    total = sum(votes)
    got = [int(v * seats / total + Fraction(1, 2)) for v in votes]
    more = [(-v / (2 * s + 1), i) for i, (v, s) in enumerate(zip(votes, got))]
    less = [(v / (2 * s - 1), -i) for i, (v, s) in enumerate(zip(votes, got)) if s]
    heapq.heapify(more)
    heapq.heapify(less)
    have = sum(got)
    while have < seats:
        _, i = heapq.heappop(more)
        got[i] += 1
        heapq.heappush(more, (-votes[i] / (2 * got[i] + 1), i))
        have += 1
    while have > seats:
        _, i = heapq.heappop(less)
        got[-i] -= 1
        if got[-i]:
            heapq.heappush(less, (votes[-i] / (2 * got[-i] - 1), i))
        have -= 1
    return got


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS,
    repeats: int = REPEATS, seed: int = SEED, carry: bool = False,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken; with ``carry`` also row, all columns.

    ``weights`` go round over the sources in the order of their code points.
    """
    spark = docs.sparkSession
    base = docs.select(
        *([F.struct(*[_named(c) for c in docs.columns]).alias("row")] if carry else []),
        _named(id_col).cast("long").alias("doc_id"), _named(source_col).cast("string").alias("source"), word_count(_named(text_col)).alias("size"),
        F.xxhash64(F.lit(seed), _named(id_col).cast("long"), _named(text_col)).alias("hash"),
    )
    if not carry:
        base = checkpointed(base)
    by_source = sorted(base.groupBy("source").agg(F.sum("size").alias("n")).collect(), key=lambda r: (r.source is None, r.source or ""))
    sizes = [int(r.n) for r in by_source]
    goals = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], repeats)
    block = max(1, min([BLOCK, *(int(g) // BLOCK for g in goals if g > 0)]))
    seats = apportion(goals, round(sum(goals) / block))
    per_shard = max(SHARD, -(-sum(sizes) // MAX_SHARDS))
    shards = [max(1, n // per_shard) for n in sizes]

    table = [(r.source, i, shards[i], sizes[i], goals[i]) for i, r in enumerate(by_source)]
    kind = T.StructType.fromDDL("its_source string, si int, n_shards int, source_size long, target double")
    base = base.join(F.broadcast(spark.createDataFrame(table, kind)), F.col("source").eqNullSafe(F.col("its_source")))
    base = base.withColumn("shard", F.pmod(F.col("hash"), F.col("n_shards").cast("long")))

    held: dict[int, list[tuple[int, int]]] = {}
    for r in base.groupBy("si", "shard").agg(F.sum("size").alias("n")).collect():
        held.setdefault(r.si, []).append((int(r.shard), int(r.n)))
    quotas = []
    for i, own in held.items():
        own.sort()
        for (shard, n), q in zip(own, apportion([n for _, n in own], seats[i])):
            quotas.append((i, shard, n, min(q * block, repeats * n)))
    kind = T.StructType.fromDDL("qi int, q_shard long, held long, quota long")
    quota = spark.createDataFrame(quotas, kind)
    base = base.join(F.broadcast(quota), (F.col("si") == F.col("qi")) & (F.col("shard") == F.col("q_shard")))

    # Within a shard: where each document lies, and what of it the quota covers.
    order = Window.partitionBy("si", "shard").orderBy("hash", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = base.withColumn("end", F.sum("size").over(order)).withColumn("begin", F.col("end") - F.col("size"))
    some = F.greatest(F.col("held"), F.lit(1))
    base = base.withColumn("rounds", F.expr("quota div greatest(held, 1)")).withColumn("rest", F.col("quota") % some)
    blocks = F.expr(f"(greatest(held, 1) + {block - 1}) div {block}")
    base = base.withColumn("first", F.pmod(F.xxhash64(F.lit(seed), "si", "shard"), blocks) * block)
    base = base.withColumn("last", F.col("first") + F.col("rest"))
    ahead = F.greatest(F.lit(0), F.least("end", "last") - F.greatest("begin", "first"))
    round_again = F.greatest(F.lit(0), F.least(F.col("end"), F.col("last") - F.col("held")) - F.col("begin"))
    taken = F.col("rounds") * F.col("size") + ahead + round_again
    return base.select(
        *(["row"] if carry else []), "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame, **parameters) -> DataFrame:
    """The documents of the mix, each as often as it is taken.

    A document that a block's edge cuts counts in whole if at least half of it
    was taken.
    """
    found = mix(docs, carry=True, **parameters)
    copies = F.when(F.col("size") > 0, F.expr("(2 * taken + size) div (2 * size)")).otherwise(0).cast("int")
    return found.select("row", F.explode(F.array_repeat(F.lit(0), copies)).alias("copy")).select("row.*")
