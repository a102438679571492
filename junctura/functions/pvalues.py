"""Combination of p-values as aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def valid(p: Column) -> Column:
    """p within (0, 1] and not NaN, else null."""
    return F.when((p > 0) & (p <= 1) & ~F.isnan(p), p)


def fisher(p: Column) -> Column:
    """Fisher's combination over a group; null without a valid p.

    2 k degrees of freedom are even, so the upper tail is a Poisson sum:
    exp(-h) * sum of h^j / j! for j < k, with h minus the sum of ln p. Terms
    follow by recurrence, scaled by exp(-h / k) each so that neither part of the
    product leaves the range of doubles.
    """
    h = F.abs(F.sum(F.log(valid(p))))
    k = F.count(valid(p)).cast("int")
    sums = F.aggregate(
        F.sequence(F.lit(0), F.greatest(k, F.lit(1)) - 1),
        F.struct(F.lit(0.0).alias("log"), F.lit(float("-inf")).alias("sum")),
        lambda held, j: F.struct(
            F.when(j > 0, held["log"] + F.log(F.greatest(h, F.lit(1e-300))) - F.log(F.greatest(j, F.lit(1)).cast("double"))).otherwise(F.lit(0.0)).alias("log"),
            _log_add(held["sum"], F.when(j > 0, held["log"] + F.log(F.greatest(h, F.lit(1e-300))) - F.log(F.greatest(j, F.lit(1)).cast("double"))).otherwise(F.lit(0.0))).alias("sum"),
        ),
        lambda held: F.least(F.lit(1.0), F.exp(held["sum"] - h)),
    )
    return F.when(k > 0, sums)


def _log_add(a: Column, b: Column) -> Column:
    top = F.greatest(a, b)
    return top + F.log(F.exp(a - top) + F.exp(b - top))


def cauchy(p: Column, weight: Column | None = None) -> Column:
    """Cauchy combination over a group, weights normalised; clamped to [0, 1]; null without a valid p.

    The tail is atan2(1, mean) / pi, the same as 1/2 - atan(mean) / pi, without
    its cancellation where the result is small.
    """
    statistic = F.tan((F.lit(0.5) - valid(p)) * F.pi())
    if weight is None:
        mean = F.avg(statistic)
    else:
        mean = F.sum(weight * statistic) / F.sum(F.when(valid(p).isNotNull(), weight))
    return F.when(mean.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.atan2(F.lit(1.0), mean) / F.pi())))
