"""Sum junction files into matrix cells as they arrive.

The batch reader's rules hold: the sample is the file's name up to its first
dot, and rows of one name add up. Cells are kept in the stream's state, which is
keyed by intron and sample.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from junctura.operators.counts import sum_junctions
from junctura.sources.readers import JUNCTION, sample_of_file


def junction_stream(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.readStream.schema(", ".join(f"{c} {t}" for c, t in JUNCTION.items())).option("sep", "\t").option("header", True).csv(folder)
    return rows.select(sample_of_file().alias("sample_id"), "intron", "splice_pair", "splice_flag", "count")


def cell_stream(spark: SparkSession, folder: str) -> DataFrame:
    return sum_junctions(junction_stream(spark, folder))


def write_cells(cells: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the cells that each batch of files changed, to a folder of its own; ends when no files are left.

    A batch that is run again writes the same folder again, so nothing is lost or
    counted twice, and no batch touches what others wrote. ``read_cells`` has the
    matrix as it stands.
    """

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return cells.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def compact(spark: SparkSession, path: str) -> None:
    """Put what all batches but the last wrote into the folder of the one before it, so that reading doesn't grow with the number of batches.

    For use between streams, as a stream that runs a batch again writes its folder.
    """
    rows = spark.read.parquet(path)
    last = rows.agg(F.max("batch")).first()[0]
    if last is None or last < 2:
        return
    kept = rows.where(F.col("batch") < last).groupBy("intron_id", "sample_id").agg(F.max_by("count", "batch").alias("count"))
    # Written beside the batches first; a name with a dot in front is not read.
    kept.write.mode("overwrite").parquet(f"{path}/.compacted")
    place = spark._jvm.org.apache.hadoop.fs.Path
    system = place(path).getFileSystem(spark._jsc.hadoopConfiguration())
    old = [s.getPath() for s in system.listStatus(place(path)) if s.getPath().getName().startswith("batch=") and int(s.getPath().getName()[6:]) < last - 1]
    system.delete(place(f"{path}/batch={last - 1}"), True)
    system.rename(place(f"{path}/.compacted"), place(f"{path}/batch={last - 1}"))
    for folder in old:
        system.delete(folder, True)


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """Matrix cells: of each intron and sample what the last batch that changed it wrote."""
    rows = spark.read.parquet(path)
    last = rows.groupBy("intron_id", "sample_id").agg(F.max_by("count", "batch").alias("count"))
    return last.select("intron_id", "sample_id", "count")
