"""Gene annotation: GTF features, introns between exons, and overlap with genes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from junctura.checkpoints import checkpointed
from junctura.functions import introns as I

LEAST_BIN, STEP, LEVELS = 14, 2, 10  # bins of 2^14 bases, four times as many at each level; beyond 2^32 bases there is one for all
PLACE = ["chrom", "start", "end", "strand"]


def attribute(attributes: Column, key: str) -> Column:
    """Value of a GTF attribute; the last of repeated keys, null if absent."""
    values = F.regexp_extract_all(attributes, F.lit(rf'(?:^|;)\s*{key}\s+"([^"]+)"'), F.lit(1))
    return F.when(F.size(values) > 0, F.element_at(values, -1))


def features(gtf: DataFrame) -> DataFrame:
    """Exon and gene rows of a GTF scan with gene_id, gene_name (gene_id if absent) and transcript_id."""
    gene, name = attribute(F.col("attributes"), "gene_id"), attribute(F.col("attributes"), "gene_name")
    return gtf.select("chrom", "feature", "start", "end", "strand", "ord", gene.alias("gene_id"), F.coalesce(name, gene).alias("gene_name"), attribute(F.col("attributes"), "transcript_id").alias("transcript_id"))


def exons(found: DataFrame) -> DataFrame:
    return found.where("feature = 'exon' and transcript_id is not null")


def gene_map(found: DataFrame) -> DataFrame:
    """Genes by place; the last row of a place names it."""
    genes = found.where("feature = 'gene'") if "feature" in found.columns else found
    return genes.groupBy(*PLACE).agg(F.max_by("gene_name", "ord").alias("gene_name"))


def exon_introns(exon: DataFrame) -> DataFrame:
    """Introns between the neighbouring exons of each transcript, with the transcript's gene.

    Exons go by start, ties by row; both must lie on one chromosome, and an
    intron has two bases at least. The gene is the one of the first exon row.
    """
    order = Window.partitionBy("transcript_id").orderBy("start", "ord")
    first = F.first("gene_name").over(Window.partitionBy("transcript_id").orderBy("ord"))
    pairs = exon.select(
        "chrom", "strand", "transcript_id", (F.col("end") + 1).alias("istart"), (F.lead("start").over(order) - 1).alias("iend"),
        F.lead("chrom").over(order).alias("__next"), first.alias("gene_name"),
    )
    pairs = pairs.where("istart < iend and chrom = __next")
    return pairs.select("chrom", F.col("istart").alias("start"), F.col("iend").alias("end"), "strand", "transcript_id", "gene_name")


def intron_genes(introns: DataFrame) -> DataFrame:
    """Sorted genes of each annotated intron."""
    return introns.groupBy(*PLACE).agg(F.array_sort(F.collect_set("gene_name")).alias("genes"))


def transcript_spans(exon: DataFrame) -> DataFrame:
    """First start, and the end of the exon that starts last, of each transcript."""
    return exon.groupBy("transcript_id").agg(
        F.min_by("chrom", "ord").alias("chrom"), F.min("start").alias("start"), F.max_by("end", F.struct("start", "ord")).alias("end"),
        F.min_by("strand", "ord").alias("strand"), F.min_by("gene_name", "ord").alias("gene_name"),
    )


def gene_index(genes: DataFrame, spans: DataFrame | None = None) -> DataFrame:
    """Distinct ranges that carry a gene's name: genes, and transcripts unless left out."""
    columns = [*PLACE, "gene_name"]
    return (genes.select(columns).union(spans.select(columns)) if spans is not None else genes.select(columns)).distinct()


def bin_of(start: Column, end: Column) -> Column:
    """The smallest bin that holds an interval whole, as struct (level, bin).

    The bits in which its ends differ say the level. Each end is named but a few
    times, as its expression may be put in place of each.
    """
    bits = F.length(F.bin(start.cast("long").bitwiseXOR(end.cast("long"))))
    level = F.least(F.lit(LEVELS), F.ceil((F.greatest(bits, F.lit(LEAST_BIN)) - LEAST_BIN) / STEP)).cast("int")
    told = F.transform(F.array(F.struct(level.alias("level"), start.cast("long").alias("at"))), lambda x: F.struct(
        x["level"].alias("level"), F.when(x["level"] == LEVELS, F.lit(0).cast("long")).otherwise(F.call_function("shiftright", x["at"], x["level"] * STEP + LEAST_BIN)).alias("bin")))
    return F.get(told, F.lit(0))


def _upwards(own: Column, with_own: bool) -> Column:
    """A bin's ancestors, with itself or without."""
    steps = F.sequence(F.lit(0), F.lit(LEVELS)) if with_own else F.sequence(F.lit(1), F.lit(LEVELS))
    above = F.filter(steps, lambda k: own["level"] + k <= LEVELS)
    shifted = lambda k: F.call_function("shiftright", own["bin"], STEP * k)
    return F.transform(above, lambda k: F.struct((own["level"] + k).alias("level"), F.when(own["level"] + k == LEVELS, F.lit(0).cast("long")).otherwise(shifted(k)).alias("bin")))


def interval_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Pairs of rows that agree on ``on`` and whose inclusive ranges start..end overlap.

    An interval lies in the smallest bin that holds it whole, of bins four times
    as wide at each level, and in that alone, however long it is. Bins are
    nested, so of two intervals that overlap the bin of one is the other's or an
    ancestor of it: each side is looked up once in the bins above its own, a row
    a level. A pair comes once. The right side's range comes as other_start,
    other_end.
    """
    a = left.where("start <= end").withColumn("__own", bin_of(F.col("start"), F.col("end")))
    b = right.where("start <= end").withColumn("__own", bin_of(F.col("start"), F.col("end"))).withColumnsRenamed({"start": "other_start", "end": "other_end"})
    at = lambda rows, places: rows.withColumn("__bin", places).drop("__own")
    key = lambda x: x["bin"] * 16 + x["level"]  # noqa: E731  one number instead of a struct in each row that moves
    overlap = (F.col("start") <= F.col("other_end")) & (F.col("end") >= F.col("other_start"))
    low = at(a, F.explode(F.transform(_upwards(F.col("__own"), True), key))).join(at(b, key(F.col("__own"))), [*on, "__bin"]).where(overlap)
    high = at(a, key(F.col("__own"))).join(at(b, F.explode(F.transform(_upwards(F.col("__own"), False), key))), [*on, "__bin"]).where(overlap)
    return low.unionByName(high).drop("__bin")


def parsed(introns: DataFrame) -> DataFrame:
    """Distinct introns (intron_id) with chrom, start, end and strand, null where an identifier can't be read.

    Written once: joins read it several times, and what they ask of its columns
    would else be asked, parsing and all, of every row that the introns come from.
    """
    return checkpointed(introns.select("intron_id").distinct().withColumn("__p", I.parse_lenient(F.col("intron_id"))).select("intron_id", "__p.*"))


def notes(introns: DataFrame, annotated: DataFrame, index: DataFrame) -> DataFrame:
    """gene_name, intron_status and overlapping_genes of distinct introns, a row for each intron_id.

    Genes of an annotated intron of the same place win over those that overlap;
    the first in order names it. Identifiers that can't be read are ``unknown``.
    Only places go to the bins, and all that is told of a place meets it by place.
    """
    names = parsed(introns)
    names = names.join(annotated.withColumn("__known", F.lit(True)), PLACE, "left")
    open_ones = names.where("__known is null and chrom is not null").select(*PLACE)
    over = interval_join(open_ones, index, ["chrom", "strand"]).groupBy(*PLACE).agg(F.array_sort(F.collect_set("gene_name")).alias("__over"))
    names = names.join(over, PLACE, "left").withColumn("__all", F.coalesce("genes", "__over", F.array().cast("array<string>")))
    some = F.size("__all") > 0
    return names.select(
        "intron_id", F.when(some, F.element_at("__all", 1)).otherwise(".").alias("gene_name"),
        F.when(F.col("chrom").isNull(), "unknown").when(F.col("__known"), "known").otherwise("novel").alias("intron_status"),
        F.when(some, F.concat_ws(",", "__all")).otherwise(".").alias("overlapping_genes"),
    )


def annotate(introns: DataFrame, annotated: DataFrame, index: DataFrame) -> DataFrame:
    """Rows with intron_id and what ``notes`` says of their introns."""
    if "intron_status" in introns.columns:
        return introns
    return introns.join(notes(introns, annotated, index), "intron_id", "left")


NOTES = ("gene_name", "intron_status", "overlapping_genes")


def to_results(results: DataFrame, notes: DataFrame) -> DataFrame:
    """Results with what ``notes`` (intron_id and some of ``NOTES``) say of their introns, behind intron_id."""
    named = [c for c in NOTES if c in notes.columns and c not in results.columns]
    if not named:
        return results
    found = results.join(notes.select("intron_id", *named).distinct(), "intron_id", "left")
    return found.select("intron_id", *named, *[c for c in results.columns if c != "intron_id"])


def annotation_summary(introns: DataFrame) -> DataFrame:
    """Introns by status, and how many of them have a gene."""
    return introns.groupBy("intron_status").agg(F.count("*").alias("n_introns"), F.count_if(F.col("gene_name") != ".").alias("n_with_gene"))
