"""Benjamini-Hochberg adjustment without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from junctura.checkpoints import checkpointed
from junctura.operators import ordered


def bh_fdr(rows: DataFrame, p: str = "PValue", by: tuple[str, ...] = (), out: str = "FDR") -> DataFrame:
    """Adjusted p-values over all rows, or within each group of ``by``; null p-values (and NaN) stay null and count for nothing.

    Equal p-values are one row until the end: the adjusted value is that of the
    last rank among them, and the least of it over all greater ones. Rows are
    written first: they are met by their p-values, and one that is a sum of
    doubles differs in its last digits when it is computed again.
    """
    rows = checkpointed(rows)
    told = F.when(~F.isnan(F.col(f"`{p}`")), F.col(f"`{p}`").cast("double"))
    found = ordered.cumulated(rows, told, by).withColumn("__q", F.col("__v") * F.col("__n") / F.col("__upto"))
    found = ordered.least_from(found, "__q", by, "__low").withColumn("__fdr", F.least(F.lit(1.0), "__low"))
    return ordered.given_back(rows, told, by, found, {"__fdr": out})


def flag_significant(results: DataFrame, fdr: float = 0.05, min_log_fc: float = 0.0) -> DataFrame:
    """FDR strictly below and |logFC| at least the thresholds."""
    return results.withColumn("significant", (F.col("FDR") < fdr) & (F.abs("logFC") >= min_log_fc))


def refilter(results: DataFrame, least: float | None) -> DataFrame:
    """Keep large differences, then adjust anew over all contrasts together.

    FDR_original keeps the old value; significant is FDR <= 0.05, whatever the
    thresholds of the test were.
    """
    kept = results.where(F.abs("delta_psi") >= least) if least else results
    kept = bh_fdr(kept.withColumnRenamed("FDR", "FDR_original"), "PValue")
    return kept.withColumn("significant", F.col("FDR") <= 0.05)


def result_summary(results: DataFrame, by: tuple[str, ...] = ("contrast",)) -> DataFrame:
    """Tested, significant, up and down, and the spread of logFC."""
    up = F.col("significant") & (F.col("logFC") > 0)
    down = F.col("significant") & (F.col("logFC") < 0)
    told = results.groupBy(*by).agg(
        F.count("*").alias("n_tested"), F.count_if("significant").alias("n_significant"), F.count_if(up).alias("n_up"), F.count_if(down).alias("n_down"),
        F.min("logFC").alias("least_logFC"), F.max("logFC").alias("most_logFC"),
    )
    middle = ordered.medians(results, "logFC", by, "middle_logFC").withColumnsRenamed({c: f"__{c}" for c in by})
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"`__{c}`")) for c in by]
    return told.join(middle, same, "left").select(*told.columns[:-1], "middle_logFC", "most_logFC")


def volcano(results: DataFrame) -> DataFrame:
    """Points of the volcano and mean-difference plots."""
    return results.select("intron_id", "contrast", "logFC", (-F.log10("PValue")).alias("neg_log10_p"), "significant")
