"""Points of a plot as hexagons with counts, and the points that lie apart: as many rows as the plot has room for, however many points there are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from junctura.checkpoints import checkpointed

COLUMNS = 80  # hexagons across the plot
ALONE = 2  # points of a hexagon, at most, that are shown themselves


def _placed(points: DataFrame, x: str, y: str, columns: int) -> DataFrame:
    """Points with finite coordinates and the centre (hex_x, hex_y) of their hexagon.

    Hexagons are the cells nearest to two grids of centres, one shifted by half a
    step. Their size comes from the range of all points, whatever group they are of.
    """
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    # Read for the range, for the counts, and once more for the points that lie apart.
    own = checkpointed(points.where(finite(x) & finite(y)))
    low_x, high_x, low_y, high_y = own.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()
    wide = lambda low, high: (high - low) / columns if low is not None and high > low else 1.0
    dx, dy = wide(low_x, high_x), wide(low_y, high_y) * 3**0.5
    at = lambda c, low, d: (F.col(c) - F.lit(float(low or 0))) / F.lit(d)
    u, v = at(x, low_x, dx), at(y, low_y, dy)
    near = lambda c: F.floor(c + 0.5).cast("double")
    half = lambda c: F.floor(c).cast("double") + 0.5
    far = lambda a, b: (u - a) * (u - a) + 3 * (v - b) * (v - b)
    first = far(near(u), near(v)) < far(half(u), half(v))
    back = lambda c, low, d: c * F.lit(d) + F.lit(float(low or 0))
    pick = lambda a, b: F.when(first, a).otherwise(b)
    return own.withColumns({"hex_x": back(pick(near(u), half(u)), low_x, dx), "hex_y": back(pick(near(v), half(v)), low_y, dy)})


def hexagons(points: DataFrame, x: str, y: str, by: tuple[str, ...] = (), columns: int = COLUMNS, **counts: Column) -> DataFrame:
    """Hexagons that hold points, for each group of ``by``: centre, n, and further aggregates."""
    return _placed(points, x, y, columns).groupBy(*by, "hex_x", "hex_y").agg(F.count("*").alias("n"), *[c.alias(n) for n, c in counts.items()])


def apart(points: DataFrame, x: str, y: str, by: tuple[str, ...] = (), columns: int = COLUMNS) -> DataFrame:
    """The points of hexagons with ``ALONE`` points at most, whole."""
    placed = _placed(points, x, y, columns)
    few = placed.groupBy(*by, "hex_x", "hex_y").agg(F.count("*").alias("n")).where(F.col("n") <= ALONE)
    return placed.join(few, [*by, "hex_x", "hex_y"], "left_semi").select([F.col(f"`{c}`") for c in points.columns])
