"""Samples, groups and contrasts."""

from __future__ import annotations

import re
import warnings
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def valid_samples(metadata: DataFrame) -> DataFrame:
    """Metadata rows whose sample_id is neither null nor blank."""
    return metadata.where(F.trim("sample_id") != "").withColumn("sample_id", F.col("sample_id").cast("string"))


def keep_samples(cells: DataFrame, metadata: DataFrame) -> DataFrame:
    """Cells of samples that the metadata name."""
    return cells.join(valid_samples(metadata).select("sample_id"), "sample_id", "left_semi")


def missing_samples(cells: DataFrame, metadata: DataFrame) -> DataFrame:
    """Samples in the metadata alone."""
    return valid_samples(metadata).select("sample_id").distinct().join(cells.select("sample_id").distinct(), "sample_id", "left_anti")


def excluded_samples(cells: DataFrame, metadata: DataFrame) -> DataFrame:
    """Samples in the matrix alone."""
    return cells.select("sample_id").distinct().join(valid_samples(metadata).select("sample_id"), "sample_id", "left_anti")


def told(names: DataFrame, what: str, most: int = 5) -> str | None:
    """Number of samples and the first of them in order, or None if there are none."""
    n = names.count()
    first = [r.sample_id for r in names.orderBy("sample_id").limit(most).collect()]
    return f"{n} {what}: {', '.join(first)}{'...' if n > most else ''}" if n else None


def warn_dropped(cells: DataFrame, metadata: DataFrame) -> None:
    """Warn of samples that one side alone has."""
    for names, what in ((missing_samples(cells, metadata), "samples of the metadata aren't in the matrix"), (excluded_samples(cells, metadata), "samples of the matrix aren't in the metadata")):
        if said := told(names, what):
            warnings.warn(said, stacklevel=3)


def groups(metadata: DataFrame, column: str = "group") -> DataFrame:
    return metadata.select(F.col(f"`{column}`").cast("string").alias("group")).where("`group` is not null").distinct()


def listed(text: str | None) -> list[str]:
    """Names of a comma list, stripped."""
    return [x.strip() for x in (text or "").split(",") if x.strip()]


def valid_name(name: str) -> str:
    """The name as a variable in a model formula: other characters become dots, a bad start gets an X."""
    name = re.sub(r"[^A-Za-z0-9._]", ".", name)
    return name if re.match(r"[A-Za-z]|\.(?![0-9])", name) else f"X{name}"


def pairwise_contrasts(names: list[str]) -> list[str]:
    return [f"{a}-{b}" for a, b in combinations(sorted(names), 2)]


def control_contrasts(names: list[str], controls: list[str]) -> list[str]:
    """Each group that is no control against all controls that there are."""
    there = [c for c in controls if c in names]
    if not there:
        raise ValueError("none of the control groups is among the groups")
    return [f"{g}-{','.join(there)}" for g in sorted(names) if g not in there]


def contrasts(names: list[str], contrast: str | None = None, controls: list[str] | None = None) -> list[str]:
    """The contrasts to test: the given one, each group against the controls, or all pairs."""
    if contrast and controls:
        raise ValueError("contrast and control groups exclude each other")
    return [contrast] if contrast else control_contrasts(names, controls) if controls else pairwise_contrasts(names)


def first_contrast(names: list[str]) -> str:
    """The first group against the second, as tested where no contrast is given."""
    if len(names) < 2:
        raise ValueError("a contrast needs two groups at least")
    return "-".join(sorted(names)[:2])


def parse_contrast(contrast: str, names: list[str]) -> tuple[str, list[str]]:
    """First group and the groups it is set against; an error unless each is known."""
    sides = contrast.split("-")
    if len(sides) != 2:
        raise ValueError(f"a contrast has exactly one dash: {contrast}")
    first, others = sides[0].strip(), listed(sides[1])
    unknown = [x for x in (first, *others) if x not in names]
    if unknown or not others:
        raise ValueError(f"unknown groups in {contrast}: {', '.join(unknown) or 'none given'}")
    return first, others


def contrast_label(contrast: str) -> str:
    """A_vs_B, or A_vs_B1_B2 against several."""
    first, _, rest = contrast.partition("-")
    return f"{first.strip()}_vs_{'_'.join(listed(rest))}"


def contrast_file(contrast: str) -> str:
    """The contrast as part of a file's name."""
    return contrast.replace("-", "_vs_")
