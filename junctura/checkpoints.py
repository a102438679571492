"""Durable cut of lineage in the session's checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder (spark.checkpoint.dir).

    Where it names none, a temporary one is chosen in local mode; on a cluster
    that would be a folder that executors can't read, so it is an error there.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        told = spark.conf.get("spark.checkpoint.dir", None)
        if not told and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(told or tempfile.mkdtemp(prefix="junctura-checkpoint-"))
    return context.getCheckpointDir()


def checkpointed(rows: DataFrame) -> DataFrame:
    """Write ``rows`` once and go on from there."""
    checkpoint_folder(rows.sparkSession)
    return rows.checkpoint(eager=True)
