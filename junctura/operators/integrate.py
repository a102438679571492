"""Side-by-side integration of donor and acceptor results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATISTICS = ("logFC", "logCPM", "F", "PValue", "FDR", "FDR_original", "cluster", "significant")
METADATA = ("gene_name", "intron_status", "overlapping_genes")


def prefixed(results: DataFrame, prefix: str) -> DataFrame:
    """Statistics and PSI columns under a prefix."""
    named = {c: f"{prefix}_{c}" for c in results.columns if c in STATISTICS or c.lower().endswith("_psi")}
    return results.withColumnsRenamed(named)


def outer(donor: DataFrame, acceptor: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join in which null keys are equal."""
    a, b = donor.alias("a"), acceptor.alias("b")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    rest = [F.col(f"a.{c}") for c in donor.columns if c not in keys] + [F.col(f"b.{c}") for c in acceptor.columns if c not in keys and c not in donor.columns]
    return a.join(b, same, "full_outer").select(*[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys], *rest)


def status(merged: DataFrame) -> DataFrame:
    """tested_in, significant_in and direction_consistent."""
    d, a = F.col("donor_PValue").isNotNull(), F.col("acceptor_PValue").isNotNull()
    ds, as_ = (F.coalesce(F.col(f"{x}_significant"), F.lit(False)) for x in ("donor", "acceptor"))
    pick = lambda x, y: F.when(x & y, "both").when(x, "donor_only").when(y, "acceptor_only").otherwise("neither")
    same = F.signum("donor_logFC") == F.signum("acceptor_logFC")
    return merged.withColumn("tested_in", pick(d, a)).withColumn("significant_in", pick(ds, as_)).withColumn("direction_consistent", F.when(ds & as_, same))


def best(merged: DataFrame) -> DataFrame:
    """best_analysis, best_FDR, best_logFC and best_delta_psi; a null FDR on either side means acceptor."""
    donor = F.col("donor_FDR") <= F.col("acceptor_FDR")
    take = lambda c: F.when(donor, F.col(f"donor_{c}")).otherwise(F.col(f"acceptor_{c}"))
    out = merged.withColumn("best_FDR", F.least("donor_FDR", "acceptor_FDR")).withColumn("best_analysis", F.when(donor, "donor").otherwise("acceptor"))
    out = out.withColumn("best_logFC", take("logFC"))
    return out.withColumn("best_delta_psi", take("delta_psi")) if {"donor_delta_psi", "acceptor_delta_psi"} <= {c.lower() for c in merged.columns} else out


def integrate(donor: DataFrame, acceptor: DataFrame) -> DataFrame:
    """All introns and contrasts of either side in one join."""
    keys = ["intron_id", *(["contrast"] if "contrast" in donor.columns and "contrast" in acceptor.columns else [])]
    keys += [c for c in METADATA if c in donor.columns and c in acceptor.columns]
    merged = best(status(outer(prefixed(donor, "donor"), prefixed(acceptor, "acceptor"), keys)))
    first = [c for c in (*keys, "tested_in", "significant_in", "best_analysis", "best_FDR", "best_logFC", "best_delta_psi", "direction_consistent") if c in merged.columns]
    return merged.select(*first, *[c for c in merged.columns if c not in first and c not in ("donor_F", "acceptor_F")])


def significant(integrated: DataFrame) -> DataFrame:
    return integrated.where("significant_in <> 'neither'")


def summary(integrated: DataFrame) -> DataFrame:
    """One row of ten counters."""
    tested = lambda x: F.count_if(F.col("tested_in") == x)
    sure = lambda x: F.count_if(F.col("significant_in") == x)
    both = F.col("significant_in") == "both"
    return integrated.agg(
        F.count("*").alias("total_introns"), tested("both").alias("tested_both"), tested("donor_only").alias("tested_donor_only"), tested("acceptor_only").alias("tested_acceptor_only"),
        sure("both").alias("significant_both"), sure("donor_only").alias("significant_donor_only"), sure("acceptor_only").alias("significant_acceptor_only"), sure("neither").alias("significant_neither"),
        F.count_if(both & F.col("direction_consistent")).alias("both_sig_consistent_direction"), F.count_if(both & ~F.col("direction_consistent")).alias("both_sig_opposite_direction"),
    )
