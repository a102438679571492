"""Writers: TSV with NA for null at the edges, parquet between stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_tsv(rows: DataFrame, path: str, compression: str | None = None) -> None:
    writer = rows.write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", "NA")
    (writer.option("compression", compression) if compression else writer).csv(path)


def write_wide(cells: DataFrame, names: list[str], path: str, column: str = "count", noted: tuple[str, ...] = (), absent: str = "0", leading: tuple[str, ...] = ()) -> None:
    """Cells (intron_id, sample_id, ``column``) as a wide matrix: a line for each intron, columns ``leading``, a field for each of ``names``, then ``noted``.

    A line is put together from the array of its cells in the samples' order, so
    a sample is neither a column nor an expression. Absent cells are ``absent``,
    nulls NA; of repeated cells the greatest is kept.
    """
    places = cells.sparkSession.createDataFrame([(n, i) for i, n in enumerate(names)], "sample_id string, place int")
    shown = F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("NA"))
    own = cells.join(F.broadcast(places), "sample_id")  # a row a sample
    held = own.groupBy("intron_id", *leading, *noted).agg(F.array_sort(F.collect_list(F.struct("place", shown.alias("told")))).alias("held"))
    gap = lambda n: F.repeat(F.lit(f"{absent}\t"), n)
    once = F.filter("held", lambda x, i: F.coalesce(F.get("held", i + 1)["place"] != x.place, F.lit(True)))
    last = lambda i: F.coalesce(F.get("held", i - 1)["place"], F.lit(-1))
    fields = F.transform("held", lambda x, i: F.concat(gap(x.place - last(i) - 1), x.told))
    rest = F.repeat(F.lit(f"\t{absent}"), F.lit(len(names) - 1) - F.element_at("held", -1)["place"])
    line = F.concat(F.array_join(fields, "\t"), rest)
    before, notes = ([F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("NA")) for n in some] for some in (leading, noted))
    told = F.concat_ws("\t", "intron_id", *before, line, *notes)
    # One column whose name is the header; no sign parts or quotes it.
    held.withColumn("held", once).select(told.alias("\t".join(["intron_id", *leading, *names, *noted]))).write.mode("overwrite").option("sep", "\x01").option("quote", "").option("header", True).option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_junctions(junctions: DataFrame, path: str) -> None:
    """Junctions with sample_id as gzip TSV, a folder ``sample_id=NAME`` for each sample."""
    junctions.orderBy("sample_id", "intron").write.mode("overwrite").partitionBy("sample_id").option("sep", "\t").option("header", True).option("compression", "gzip").csv(path)


def write_results(results: DataFrame, path: str) -> None:
    """All results by p-value, and the significant ones beside them if there are any."""
    ordered = results.orderBy(F.asc_nulls_last("PValue"))
    write_tsv(ordered, f"{path}.intron_results")
    hits = ordered.where("significant")
    if not hits.isEmpty():
        write_tsv(hits, f"{path}.significant_introns")


def write_by_contrast(results: DataFrame, path: str, files: dict[str, str] | None = None) -> None:
    """Results dealt by contrast in one pass: a folder ``file=A_vs_B`` for each, by p-value within.

    ``files`` says the names of contrasts whose files are called otherwise.
    """
    name = F.col("contrast")
    for contrast, file in (files or {}).items():
        name = F.when(F.col("contrast") == contrast, file).otherwise(name)
    named = results.withColumn("file", name).repartition("contrast").sortWithinPartitions("file", F.asc_nulls_last("PValue"))
    named.write.mode("overwrite").partitionBy("file").option("sep", "\t").option("header", True).option("nullValue", "NA").csv(path)


def save_stage(rows: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a stage as parquet and read it again."""
    rows.write.mode("overwrite").parquet(f"{folder}/{name}")
    return rows.sparkSession.read.parquet(f"{folder}/{name}")


def saved_stage(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    """A stage of an earlier run, if it was written to its end."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}/_SUCCESS")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.read.parquet(f"{folder}/{name}")
    return None
