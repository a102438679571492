"""Donor and acceptor clusters, their totals and the offsets they give."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from junctura.checkpoints import checkpointed
from junctura.functions import introns as I
from junctura.operators import counts, ordered

CLUSTERS = ("donor_cluster", "acceptor_cluster")


def assign_clusters(cells: DataFrame) -> DataFrame:
    """Parse intron_id once and add its parts and both clusters."""
    parsed = cells.withColumn("__p", I.parse_strict(F.col("intron_id")))
    site = lambda at: I.cluster(F.col("__p.chrom"), F.col(f"__p.{at}"), F.col("__p.strand"))
    return parsed.select("*", "__p.*", site("donor").alias("donor_cluster"), site("acceptor").alias("acceptor_cluster")).drop("__p")


def cluster_totals(cells: DataFrame, cluster: str) -> DataFrame:
    """Counts per (cluster, sample)."""
    return cells.groupBy(cluster, "sample_id").agg(F.sum("count").cast("long").alias("total"))


def add_totals(cells: DataFrame, clusters: tuple[str, ...] = CLUSTERS) -> DataFrame:
    """Totals of each cell's clusters as {donor,acceptor}_total, and shared_total, the greater of them.

    With one cluster column the shared total is that cluster's.
    """
    for c in clusters:
        cells = cells.withColumn(c.replace("_cluster", "_total"), F.sum("count").over(Window.partitionBy(c, "sample_id")).cast("long"))
    totals = [c.replace("_cluster", "_total") for c in clusters]
    return cells.withColumn("shared_total", F.greatest(*totals) if len(totals) > 1 else F.col(totals[0]))


def packed_clusters(cells: DataFrame, samples: list[str]) -> DataFrame:
    """One row per intron of long counts: counts in the samples' order, its parts and both clusters.

    Written once: identifiers are parsed for each intron, not for each cell, and
    what is asked of their parts isn't asked of the rows that they come from.
    """
    return checkpointed(assign_clusters(counts.packed(cells, samples)))


def packed_totals(rows: DataFrame, clusters: tuple[str, ...] = CLUSTERS) -> DataFrame:
    """Packed introns with their clusters' totals, arrays {donor,acceptor}_totals beside counts.

    Counts are dealt by cluster, a row an intron, and summed by place; introns
    meet the sums by a join, so that no row a cell is moved or sorted.
    """
    out = rows
    for c in clusters:
        held = counts.sums_by_place(rows, c).groupBy(c).agg(F.array_sort(F.collect_list(F.struct("place", "total"))).alias("__held"))
        out = out.join(held.select(c, F.col("__held.total").alias(c.replace("_cluster", "_totals"))), c)
    return out


def dense_totals(rows: DataFrame, samples: list[str], clusters: tuple[str, ...] = CLUSTERS) -> DataFrame:
    """Packed introns as long counts with the columns of ``add_totals``."""
    values = {"counts": "count"} | {c.replace("_cluster", "_totals"): c.replace("_cluster", "_total") for c in clusters}
    cells, totals = counts.unpacked(packed_totals(rows, clusters), samples, values), list(values.values())[1:]
    return cells.withColumn("shared_total", F.greatest(*totals) if len(totals) > 1 else F.col(totals[0]))


def log_offset(total: str = "shared_total") -> F.Column:
    """Natural log of the total and a half."""
    return F.log(F.col(total) + F.lit(0.5))


def offsets(cells: DataFrame) -> DataFrame:
    """intron_id, sample_id and offset, from the shared totals."""
    return cells.select("intron_id", "sample_id", log_offset().alias("offset"))


def with_totals(cells: DataFrame, table: DataFrame) -> DataFrame:
    """Cells with the shared_total that a table (intron_id, sample_id, shared_total) gives them; an error is raised where it lacks one."""
    found = cells.drop("shared_total").join(table.select("intron_id", "sample_id", F.col("shared_total").alias("__total")), ["intron_id", "sample_id"], "left")
    there = F.assert_true(F.col("__total").isNotNull(), F.concat(F.lit("no shared total for "), "intron_id", F.lit(" in "), "sample_id"))
    return found.withColumn("shared_total", F.when(there.isNull(), F.col("__total"))).drop("__total")


def cluster_sizes(introns: DataFrame, cluster: str) -> DataFrame:
    """One row: clusters, and the least, median and greatest number of introns."""
    sizes = introns.select("intron_id", cluster).distinct().groupBy(cluster).agg(F.count("*").alias("n"))
    told = sizes.agg(F.count("*").alias("n_clusters"), F.min("n").alias("least"), F.max("n").alias("most"))
    return told.join(ordered.medians(sizes, "n", out="middle"), how="left").select("n_clusters", "least", "middle", "most")


def offset_summary(cells: DataFrame) -> DataFrame:
    """Spread of positive shared totals, which cluster gave them, and how many are small or missing."""
    some = F.when(F.col("shared_total") > 0, F.col("shared_total"))
    told = cells.agg(
        F.count("*").alias("n_cells"), F.count_if(F.col("shared_total") > 0).alias("n_positive"), F.min(some).alias("least"),
        F.max(some).alias("most"), (F.sum(some) / F.count(some)).alias("mean"),
        F.count_if(F.col("donor_total") >= F.col("acceptor_total")).alias("n_donor"), F.count_if(F.col("acceptor_total") > F.col("donor_total")).alias("n_acceptor"),
        F.count_if(F.col("shared_total") < 10).alias("n_small"), F.count_if(F.col("shared_total").isNull()).alias("n_missing"),
    )
    return told.join(ordered.medians(cells, some, out="middle"), how="left")  # a row each
