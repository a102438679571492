"""Send this package to executors whose Python can't import it."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parents[1]
_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package to Spark as an archive, once an application, unless PYTHONPATH names its folder.

    Spark's own file service takes it from the driver to each executor.
    """
    context = spark.sparkContext
    if context.applicationId in _SENT or str(ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    path = f"{tempfile.mkdtemp(prefix='junctura-')}/junctura.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(ROOT.joinpath("junctura").rglob("*.py")):
            archive.write(file, file.relative_to(ROOT))
    context.addPyFile(path)
    _SENT.add(context.applicationId)


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run
