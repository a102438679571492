"""Distinct values in order, with how many rows lie up to each: ranks, running minima and medians without a single-task sort.

Rows of one value are counted before anything is sorted, so that ties, however
many, are one row. The distinct values are dealt over range partitions of equal
size; places within a partition and the sums of the partitions below give each
value's place. Only a table of one row a partition and group is ever in one
window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from junctura.checkpoints import checkpointed

HOT = 1024  # at most as many values hold a share of one over it of all rows each
START, UPTO = Window.unboundedPreceding, Window.currentRow


def _keys(by: tuple[str, ...]) -> list[str]:
    return [f"__k{i}" for i in range(len(by))]


def keyed(rows: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """``rows`` with the groups' columns in structs, as nulls are equal within these."""
    return rows.withColumns({k: F.struct(F.col(f"`{c}`")) for k, c in zip(_keys(by), by)})


def cumulated(rows: DataFrame, value: str | Column, by: tuple[str, ...] = ()) -> DataFrame:
    """Distinct values that are not null: group keys __k0.., __v, __c rows of it, __upto rows up to and with it, __n in the group, and its __part."""
    keys = _keys(by)
    counted = keyed(rows, by).select(*keys, (F.col(f"`{value}`") if isinstance(value, str) else value).alias("__v")).where("__v is not null")
    counted = counted.groupBy(*keys, "__v").agg(F.count("*").alias("__c"))
    # Written out, so that a value's partition is the same wherever it is asked for.
    dealt = checkpointed(counted.repartitionByRange(*keys, "__v").withColumn("__part", F.spark_partition_id()))
    sums = dealt.groupBy(*keys, "__part").agg(F.sum("__c").alias("__s"))
    sums = sums.withColumn("__below", F.coalesce(F.sum("__s").over(Window.partitionBy(*keys).orderBy("__part").rowsBetween(START, -1)), F.lit(0)))
    sums = sums.withColumn("__n", F.sum("__s").over(Window.partitionBy(*keys))).drop("__s")
    own = F.sum("__c").over(Window.partitionBy(*keys, "__part").orderBy("__v").rowsBetween(START, UPTO))
    return dealt.join(sums, [*keys, "__part"]).withColumn("__upto", F.col("__below") + own).drop("__below")


def least_from(found: DataFrame, value: str, by: tuple[str, ...], out: str) -> DataFrame:
    """The least of ``value`` over each distinct value and all greater ones of its group."""
    keys = _keys(by)
    above = Window.partitionBy(*keys).orderBy(F.desc("__part")).rowsBetween(START, -1)
    lows = found.groupBy(*keys, "__part").agg(F.min(value).alias("__low")).withColumn("__above", F.min("__low").over(above)).drop("__low")
    inner = F.min(value).over(Window.partitionBy(*keys, "__part").orderBy(F.desc("__v")).rowsBetween(START, UPTO))
    return found.join(lows, [*keys, "__part"]).withColumn(out, F.least(inner, "__above")).drop("__above")


def given_back(rows: DataFrame, value: str | Column, by: tuple[str, ...], found: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``rows`` with columns of their value (``columns``: name in ``found`` to new name), null where the value is.

    Values that many rows share are met by a broadcast of at most ``HOT`` of
    them; other rows, few a value, by a join in which those already met, and
    those of no value, are spread.
    """
    keys = _keys(by)
    total = found.agg(F.sum("__c")).first()[0] or 0
    found = found.select(*keys, "__v", "__c", *[F.col(a).alias(f"__o{i}") for i, a in enumerate(columns)])
    often = F.col("__c") * HOT >= total
    outs = [f"__o{i}" for i in range(len(columns))]
    hot = found.where(often).drop("__c").withColumnsRenamed({o: f"{o}h" for o in outs}).withColumn("__hot", F.lit(True))
    spread = F.xxhash64(*[F.col(f"`{c}`") for c, t in rows.dtypes if not t.startswith(("map", "variant"))])
    own = keyed(rows, by).withColumn("__v", F.col(f"`{value}`") if isinstance(value, str) else value)
    own = own.join(F.broadcast(hot), [*keys, "__v"], "left")
    own = own.withColumn("__salt", F.when(F.col("__v").isNull() | F.col("__hot"), F.when(spread == 0, 1).otherwise(spread)).otherwise(0))
    # 0 as well, though the optimizer, which would take a constant out of the join's keys, can't know.
    rest = found.where(~often).withColumn("__salt", F.least("__c", F.lit(0).cast("long"))).drop("__c")
    # A row that has no value or is met takes no part: its salt is not 0.
    met = own.withColumn("__v", F.coalesce("__v", F.lit(0).cast(dict(own.dtypes)["__v"]))).join(rest, [*keys, "__v", "__salt"], "left")
    new = {out: F.when(F.col("__hot"), F.col(f"{o}h")).otherwise(F.col(o)) for o, out in zip(outs, columns.values())}
    return met.withColumns(new).drop(*keys, "__v", "__hot", "__salt", *outs, *[f"{o}h" for o in outs])


def medians(rows: DataFrame, value: str | Column, by: tuple[str, ...] = (), out: str = "median") -> DataFrame:
    """The exact median of each group that has a value: the groups' columns and ``out``."""
    keys = _keys(by)
    found = cumulated(rows, value, by)
    low, high = F.expr("(__n - 1) div 2"), F.expr("__n div 2")
    first = F.col("__upto") - F.col("__c")
    held = found.where((first <= high) & (F.col("__upto") > low))  # one or two values a group
    middle = held.groupBy(*keys).agg(((F.min("__v") + F.max("__v")) / 2).alias(out))
    return middle.select(*[F.col(f"{k}.{c}").alias(c) for k, c in zip(keys, by)], out)
