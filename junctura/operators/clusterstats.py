"""Results per cluster: combined p-values, direction, PSI and genes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from junctura.functions import pvalues
from junctura.operators.fdr import bh_fdr

METHODS = {"fisher": pvalues.fisher, "cauchy": pvalues.cauchy}


def combined_clusters(results: DataFrame, method: str = "cauchy", cluster: str = "cluster", by: tuple[str, ...] = ()) -> DataFrame:
    """One row per cluster (and group of ``by``) with cluster_pvalue and direction of the significant introns.

    Without a significant column all introns count as significant. Statistics of
    delta_psi and the list of genes are there if their columns are.
    """
    sure = F.coalesce(F.col("significant"), F.lit(False)) if "significant" in results.columns else F.lit(True)
    change = F.when(sure, F.col("logFC"))
    up, down = F.count_if(sure & (F.col("logFC") > 0)), F.count_if(sure & (F.col("logFC") < 0))
    n = F.count_if(sure)
    out = [
        F.count("*").alias("n_introns"), n.alias("n_significant_introns"), METHODS[method](F.col("PValue")).alias("cluster_pvalue"),
        F.when(n == 0, "none").when(up > down, "increased").when(down > up, "decreased").otherwise("mixed").alias("dominant_direction"),
        up.alias("n_increased"), down.alias("n_decreased"),
        F.coalesce(F.max(F.abs(change)), F.lit(0.0)).alias("max_abs_logFC"), F.coalesce(F.avg(change), F.lit(0.0)).alias("mean_logFC"),
    ]
    if "delta_psi" in [c.lower() for c in results.columns]:
        delta = F.when(sure, F.col("delta_psi"))
        out += [F.coalesce(F.avg(delta), F.avg("delta_psi")).alias("mean_delta_psi"), F.coalesce(F.max(F.abs(delta)), F.max(F.abs("delta_psi"))).alias("max_abs_delta_psi")]
    out += [F.avg(f"`{c}`").alias(c) for c in results.columns if c.lower().endswith("_mean_psi")]
    if "gene_name" in results.columns:
        out.append(F.concat_ws(", ", F.array_sort(F.collect_set("gene_name"))).alias("gene_name"))
    return results.groupBy(*by, cluster).agg(*out)


def aggregate_clusters(results: DataFrame, method: str = "cauchy", cluster: str = "cluster", by: tuple[str, ...] = ()) -> DataFrame:
    """``combined_clusters`` with cluster_FDR."""
    return bh_fdr(combined_clusters(results, method, cluster, by), "cluster_pvalue", by, "cluster_FDR")


def significant_cluster_introns(results: DataFrame, clusters: DataFrame, cluster: str = "cluster", threshold: float = 0.05) -> DataFrame:
    """Introns of clusters with cluster_FDR below the threshold, with the cluster's p-value, FDR and direction."""
    kept = clusters.where(F.col("cluster_FDR") < threshold).select(cluster, "cluster_pvalue", "cluster_FDR", "dominant_direction")
    return results.join(kept, cluster)


def cluster_summary(clusters: DataFrame, fdr: float = 0.05) -> DataFrame:
    """Significant clusters by direction."""
    return clusters.where(F.col("cluster_FDR") < fdr).groupBy("dominant_direction").agg(F.count("*").alias("n_clusters"))
