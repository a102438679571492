"""Percent spliced in: values, group statistics and differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def psi_values(cells: DataFrame, total: str = "shared_total") -> DataFrame:
    """count / total, 0 where the total is 0."""
    return cells.withColumn("psi", F.when(F.col(total) > 0, F.col("count") / F.col(total)).otherwise(F.lit(0.0)))


def psi_legacy(cells: DataFrame, cluster: str = "donor_cluster") -> DataFrame:
    """PSI over the total of a single cluster column."""
    total = F.sum("count").over(Window.partitionBy(cluster, "sample_id")).cast("long")
    return psi_values(cells.withColumn("cluster_total", total), "cluster_total")


def grouped(psi: DataFrame, metadata: DataFrame) -> DataFrame:
    """Values of the samples that the metadata name, with their group. Metadata, a row a sample, are broadcast: dealt by sample, cells would lie in a task a sample."""
    return psi.join(F.broadcast(metadata.select("sample_id", "group")), "sample_id")


def group_stats(psi: DataFrame, metadata: DataFrame) -> DataFrame:
    """Mean, exact median and sample deviation per intron and group of samples that are in the matrix."""
    return grouped(psi, metadata).groupBy("intron_id", "group").agg(
        F.avg("psi").alias("mean_psi"), F.median("psi").alias("median_psi"), F.stddev_samp("psi").alias("std_psi"), F.count("*").alias("n_samples")
    )


def contrast_deltas(psi: DataFrame, metadata: DataFrame, contrasts: dict[str, tuple[str, list[str]]]) -> DataFrame:
    """intron_id, contrast, mean_first, mean_other and their difference, for all contrasts (label: first group, others) in one aggregation.

    Several other groups weigh alike.
    """
    names = sorted({g for first, others in contrasts.values() for g in (first, *others)})
    mean = {g: F.col(f"__m{i}") for i, g in enumerate(names)}
    means = grouped(psi, metadata).groupBy("intron_id").agg(*[F.avg(F.when(F.col("group") == g, F.col("psi"))).alias(f"__m{i}") for i, g in enumerate(names)])

    def side(label: str, first: str, others: list[str]) -> Column:
        other = sum((mean[g] for g in others[1:]), mean[others[0]]) / len(others)
        return F.struct(F.lit(label).alias("contrast"), mean[first].alias("mean_first"), other.alias("mean_other"))

    each = means.select("intron_id", F.inline(F.array(*[side(label, *sides) for label, sides in contrasts.items()])))
    return each.withColumn("delta_psi", F.col("mean_first") - F.col("mean_other"))


def delta_psi(psi: DataFrame, metadata: DataFrame, first: str, others: list[str]) -> DataFrame:
    """mean_first, mean_other and their difference; several other groups weigh alike."""
    return contrast_deltas(psi, metadata, {"": (first, others)}).drop("contrast")


def psi_table(psi: DataFrame, metadata: DataFrame, samples: list[str], contrast: str | None = None) -> DataFrame:
    """One row per intron as it is written: {sample}_PSI, {group}_mean_PSI, _median_PSI, _std_PSI, and delta_PSI.

    delta_PSI is there for a simple contrast, or without one for exactly two groups.
    """
    names = sorted(r.group for r in metadata.select(F.col("group").cast("string").alias("group")).where("`group` is not null").distinct().collect())
    out = [F.max(F.when(F.col("sample_id") == s, F.col("psi"))).alias(f"{s}_PSI") for s in samples]
    for g in names:
        own = F.when(F.col("group") == g, F.col("psi"))
        out += [F.avg(own).alias(f"{g}_mean_PSI"), F.median(own).alias(f"{g}_median_PSI"), F.stddev_samp(own).alias(f"{g}_std_PSI")]
    table = psi.join(F.broadcast(metadata.select("sample_id", "group")), "sample_id", "left").groupBy("intron_id").agg(*out)
    sides = [x.strip() for x in contrast.split("-")] if contrast and "," not in contrast else names if not contrast else []
    if len(sides) == 2 and set(sides) <= set(names):
        table = table.withColumn("delta_PSI", F.col(f"`{sides[0]}_mean_PSI`") - F.col(f"`{sides[1]}_mean_PSI`"))
    return table


def with_psi(results: DataFrame, table: DataFrame, keep_samples: bool = False) -> DataFrame:
    """Results with the columns of ``psi_table``: those of groups and the difference, and of samples if wanted."""
    kept = [c for c in table.columns if c != "intron_id" and (keep_samples or c == "delta_PSI" or c.endswith(("_mean_PSI", "_median_PSI", "_std_PSI")))]
    taken = {c.lower() for c in results.columns}
    return results.join(table.select("intron_id", *[f"`{c}`" for c in kept if c.lower() not in taken]), "intron_id", "left")


def compatible_delta(psi: DataFrame, metadata: DataFrame, contrast: str | None = None) -> DataFrame | None:
    """Difference as the plain pipeline has it: by a simple contrast, or of the two groups in order of name, else none."""
    names = sorted(r.group for r in metadata.select(F.col("group").cast("string").alias("group")).where("`group` is not null").distinct().collect())
    if contrast and "," not in contrast:
        first, _, other = contrast.partition("-")
        return delta_psi(psi, metadata, first.strip(), [other.strip()])
    return delta_psi(psi, metadata, names[0], [names[1]]) if not contrast and len(names) == 2 else None


def high_delta(deltas: DataFrame, least: float = 0.1) -> DataFrame:
    """One row: introns, and those with a difference beyond ``least``."""
    return deltas.agg(F.count("delta_psi").alias("n_introns"), F.count_if(F.abs("delta_psi") > least).alias("n_high"))


def at_least(results: DataFrame, least: float | None) -> DataFrame:
    """Rows with |delta_psi| of ``least`` or more; null fails; 0 or None keeps all."""
    return results.where(F.abs("delta_psi") >= least) if least else results
