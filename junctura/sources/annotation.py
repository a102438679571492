"""Annotation tables kept beside their GTF, and used while they are not older."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from junctura.operators import annotate
from junctura.sources import readers
from junctura.sources.files import changed

TABLES = ("introns", "index")


def build(gtf: DataFrame, genes_only: bool = False) -> tuple[DataFrame, DataFrame]:
    """Annotated introns with their genes, and the index of ranges that carry a gene's name."""
    rows = annotate.features(gtf)
    exon = annotate.exons(rows)
    spans = None if genes_only else annotate.transcript_spans(exon)
    return annotate.intron_genes(annotate.exon_introns(exon)), annotate.gene_index(annotate.gene_map(rows), spans)


# Headings of the sections of a cache as text, and the columns below them.
SECTIONS = {"Annotated Introns": "chr\tstart\tend\tstrand\tgene_names", "Gene Regions": "chr\tstart\tend\tstrand\tgene_id\tgene_name"}
NONE = "."


def write_cache(introns: DataFrame, genes: DataFrame, path: str) -> None:
    """Annotated introns (chrom, start, end, strand, genes) and genes (chrom, start, end, strand, gene_id, gene_name) as one text of two sections.

    Lines are in order, also from file to file of the folder: each section below
    its headings, by chromosome, start, end and strand.
    """
    names = F.when(F.size("genes") > 0, F.concat_ws(",", F.array_sort("genes"))).otherwise(NONE)
    head = [(0, -3, "## Intron annotation cache"), (0, -2, "##")]
    for k, (name, columns) in enumerate(SECTIONS.items()):
        head += [(k, -1, f"## {name}"), (k, 0, columns)] if k == 0 else [(k, -2, "##"), (k, -1, f"## {name}"), (k, 0, columns)]
    place = ["chrom", "start", "end", "strand"]
    told = introns.sparkSession.createDataFrame(head, "section int, place int, value string").select("section", "place", *[F.lit(None).cast(t).alias(c) for c, t in zip(place, ("string", "long", "long", "string"))], "value")
    for k, (rows, last) in enumerate(((introns, [names]), (genes, [F.col("gene_id"), F.col("gene_name")]))):
        line = F.concat_ws("\t", *[F.col(c).cast("string") for c in place], *[F.coalesce(x, F.lit(NONE)) for x in last])
        told = told.unionByName(rows.select(F.lit(k).alias("section"), F.lit(1).alias("place"), "chrom", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "strand", line.alias("value")))
    told.orderBy("section", "place", *place).select("value").write.mode("overwrite").text(path)


def read_cache(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Annotated introns with their genes, and the genes, from such a text.

    A line belongs to the last heading before it, in whatever split that is: a
    row for each split says which section was open where it begins.
    """
    lines = readers.lines(spark, path).select("ord", F.col("ord.path").alias("path"), F.col("ord.start").alias("start"), F.trim("value").alias("value"))
    mark = F.lit(None).cast("int")
    for k, name in enumerate(SECTIONS):
        mark = F.when(F.col("value").startswith("##") & F.col("value").contains(name), k).otherwise(mark)
    marked = lines.withColumn("mark", mark)
    splits = marked.groupBy("path", "start").agg(F.max_by("mark", F.when(F.col("mark").isNotNull(), F.col("ord"))).alias("last"))
    open_ = F.last("last", ignorenulls=True).over(Window.orderBy("path", "start").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("path", "start", open_.alias("open"))
    own = F.last("mark", ignorenulls=True).over(Window.partitionBy("path", "start").orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = marked.withColumn("own", own).join(splits, ["path", "start"]).withColumn("section", F.coalesce("own", "open"))
    field = F.split("value", "\t", -1)
    rows = found.where(~F.col("value").startswith("##") & ~F.col("value").startswith("chr\t") & (F.col("value") != "")).select("section", field.alias("f"))
    at = lambda i: F.get("f", F.lit(i))
    place = [at(0).alias("chrom"), at(1).cast("long").alias("start"), at(2).cast("long").alias("end"), at(3).alias("strand")]
    introns = rows.where("section = 0 and size(f) >= 5").select(*place, F.when(at(4) == NONE, F.array().cast("array<string>")).otherwise(F.split(at(4), ",")).alias("genes"))
    return introns, rows.where("section = 1 and size(f) >= 6").select(*place, at(4).alias("gene_id"), at(5).alias("gene_name"))


def gene_regions(gtf: DataFrame) -> DataFrame:
    """Genes with their identifiers; the last row of a place counts."""
    rows = annotate.features(gtf).where("feature = 'gene'")
    last = F.max_by(F.struct("gene_id", "gene_name"), "ord").alias("g")
    return rows.groupBy(*annotate.PLACE).agg(last).select(*annotate.PLACE, "g.*")


def load_text(spark: SparkSession, gtf: str, cache: str, force: bool = False) -> tuple[DataFrame, DataFrame]:
    """The two tables through a cache as text: introns with genes, and the index of the genes alone, as the text has no transcripts."""
    made = changed(spark, cache)
    if force or made is None or made < (changed(spark, gtf) or 0):
        rows = readers.read_gtf(spark, gtf)
        write_cache(build(rows)[0], gene_regions(rows), cache)
    introns, genes = read_cache(spark, cache)
    return introns, annotate.gene_index(genes)


def load(spark: SparkSession, gtf: str, cache: str | None = None, genes_only: bool = False, force: bool = False) -> tuple[DataFrame, DataFrame]:
    """The two tables, from ``cache`` if it is complete and not older than the GTF, else parsed and written there."""
    if cache is None:
        return build(readers.read_gtf(spark, gtf), genes_only)
    cache = f"{cache}{'-genes' if genes_only else ''}"
    done = [changed(spark, f"{cache}/{t}/_SUCCESS") for t in TABLES]
    if force or None in done or min(done) < (changed(spark, gtf) or 0):
        for name, table in zip(TABLES, build(readers.read_gtf(spark, gtf), genes_only)):
            table.write.mode("overwrite").parquet(f"{cache}/{name}")
    return tuple(spark.read.parquet(f"{cache}/{t}") for t in TABLES)
