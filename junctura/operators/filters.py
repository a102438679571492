"""Threshold filters on introns and clusters, in the order that the pipeline applies them.

Each takes long counts, a row a cell, or packed ones, a row an intron with an
array ``counts``, and returns what it takes. Packed rows need no window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from junctura.operators import counts


def canonical(cells: DataFrame, keep_noncanonical: bool = False) -> DataFrame:
    return cells if keep_noncanonical else cells.where("flag = 'OK'")


def low_count(cells: DataFrame, min_total: int = 10, min_samples: int = 2) -> DataFrame:
    """Introns with enough reads in all and enough samples with any.

    A window per intron; cells that come dealt by intron aren't moved for it.
    """
    if "counts" in cells.columns:
        return cells.where((counts.array_sum("counts") >= min_total) & (F.size(F.filter("counts", lambda n: n > 0)) >= min_samples))
    intron = Window.partitionBy("intron_id")
    flagged = cells.withColumn("__n", F.sum("count").over(intron)).withColumn("__k", F.count_if(F.col("count") > 0).over(intron))
    return flagged.where((F.col("__n") >= min_total) & (F.col("__k") >= min_samples)).drop("__n", "__k")


def passing(cells: DataFrame, cluster: str, out: str, min_count: int = 20, min_samples: int = 3) -> DataFrame:
    """Cells with ``out``: whether their cluster's total reaches ``min_count`` in enough samples.

    Rows of long counts are dealt by cluster once. The total of a sample is the sum over the
    cluster's rows of that sample, counted at the first of them.
    """
    if "counts" in cells.columns:
        enough = counts.sums_by_place(cells, cluster).groupBy(cluster).agg((F.count_if(F.col("total") >= min_count) >= min_samples).alias(out))
        return cells.join(enough, cluster)
    by_sample = Window.partitionBy(cluster).orderBy("sample_id")
    total = F.sum("count").over(by_sample.rangeBetween(Window.currentRow, Window.currentRow))
    once = F.row_number().over(by_sample) == F.rank().over(by_sample)
    enough = cells.withColumn("__enough", once & (total >= min_count))
    return enough.withColumn(out, F.count_if("__enough").over(Window.partitionBy(cluster)) >= min_samples).drop("__enough")


def single_cluster(cells: DataFrame, cluster: str, min_count: int = 20, min_samples: int = 3) -> DataFrame:
    """Members of passing clusters of one kind; without that column all cells stay."""
    if cluster not in cells.columns:
        return cells
    return passing(cells, cluster, "__passes", min_count, min_samples).where("__passes").drop("__passes")


def cluster_flags(cells: DataFrame, min_count: int = 20, min_samples: int = 3) -> DataFrame:
    """Cells with donor_passes and acceptor_passes."""
    for kind in ("donor", "acceptor"):
        cells = passing(cells, f"{kind}_cluster", f"{kind}_passes", min_count, min_samples)
    return cells


def either_cluster(cells: DataFrame, min_count: int = 20, min_samples: int = 3) -> DataFrame:
    """Introns whose donor cluster or acceptor cluster passes."""
    return cluster_flags(cells, min_count, min_samples).where("donor_passes or acceptor_passes").drop("donor_passes", "acceptor_passes")


def chain(
    cells: DataFrame, min_intron_count: int = 10, min_intron_samples: int = 2, min_cluster_count: int = 20, min_cluster_samples: int = 3,
    keep_noncanonical: bool = False, cluster_type: str = "both",
) -> DataFrame:
    """Canonical, then intron counts, then clusters, whose totals are those of the survivors."""
    kept = low_count(canonical(cells, keep_noncanonical), min_intron_count, min_intron_samples)
    if cluster_type == "both":
        return either_cluster(kept, min_cluster_count, min_cluster_samples)
    return single_cluster(kept, f"{cluster_type}_cluster", min_cluster_count, min_cluster_samples)


def breakdown(cells: DataFrame, min_count: int = 20, min_samples: int = 3) -> DataFrame:
    """One row: introns kept through both clusters, one of them, or none."""
    flags = cluster_flags(cells, min_count, min_samples).groupBy("intron_id").agg(F.first("donor_passes").alias("d"), F.first("acceptor_passes").alias("a"))
    return flags.agg(
        F.count("*").alias("n_before"), F.count_if(F.expr("d or a")).alias("n_kept"), F.count_if(F.expr("not (d or a)")).alias("n_removed"),
        F.count_if(F.expr("d and a")).alias("n_both"), F.count_if(F.expr("d and not a")).alias("n_donor_only"), F.count_if(F.expr("a and not d")).alias("n_acceptor_only"),
    )


def cluster_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: distinct clusters of each kind before and after a filter."""
    kinds = ("donor", "acceptor")
    counted = [x.agg(*[F.count_distinct(f"{k}_cluster").alias(f"{k}_{when}") for k in kinds]) for x, when in ((before, "before"), (after, "after"))]
    return counted[0].join(counted[1], how="left").select(*[f"{k}_{when}" for k in kinds for when in ("before", "after")])
