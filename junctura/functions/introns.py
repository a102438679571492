"""Intron identifiers, splice motifs and clusters as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Motifs by strand in the clustering rule, and all that count as canonical.
PLUS = ("GT--AG", "GC--AG", "AT--AC")
MINUS = ("CT--AC", "CT--GC", "GT--AT")
CANONICAL = PLUS + MINUS

STRICT = r"^([^:^-]+):(\d+)-(\d+)\^([^^]+)\^([^^]+)$"
EITHER = r"^([^:]+):(\d+)-(\d+)(?::([+-])$|\^([ACGT]{2})--([ACGT]{2})\^)"


def strand_of(motif: Column) -> Column:
    """Strand by the clustering rule; ``?`` for motifs that are not canonical."""
    return F.when(motif.isin(*PLUS), "+").when(motif.isin(*MINUS), "-").otherwise("?")


def annotation_strand(left: Column, right: Column) -> Column:
    """Strand by the annotation rule, which differs: it falls back to the left half and then to ``+``."""
    return (
        F.when((left == "GT") & (right == "AG"), "+").when((left == "CT") & (right == "AC"), "-")
        .when(left == "GT", "+").when(left == "CT", "-").otherwise("+")
    )


def splice_flag(motif: Column) -> Column:
    return F.when(motif.isin(*CANONICAL), "OK").otherwise("NON")


def intron_token(intron: Column, motif: Column, flag: Column) -> Column:
    return F.concat_ws("^", intron, motif, flag)


def parse_strict(intron_id: Column) -> Column:
    """Struct chrom, start, end, strand, splice_pair, flag, donor, acceptor; raises on any other form."""
    part = lambda k: F.regexp_extract(intron_id, STRICT, k)
    fits = F.assert_true(intron_id.rlike(STRICT), F.concat(F.lit("not an intron identifier: "), intron_id))
    start, end = part(2).cast("long"), part(3).cast("long")
    strand = strand_of(part(4))
    return F.when(fits.isNull(), F.struct(
        part(1).alias("chrom"), start.alias("start"), end.alias("end"), strand.alias("strand"), part(4).alias("splice_pair"), part(5).alias("flag"),
        F.when(strand == "-", end).otherwise(start).alias("donor"), F.when(strand == "-", start).otherwise(end).alias("acceptor"),
    ))


def parse_lenient(intron_id: Column) -> Column:
    """Struct chrom, start, end, strand for annotation; null where neither form fits.

    One pattern says whether it fits; parts are then cut at the signs between them.
    """
    cut = lambda text, sign, k: F.split_part(text, F.lit(sign), F.lit(k))
    place = cut(cut(intron_id, ":", 2), "^", 1)
    told, motif = cut(cut(intron_id, "^", 1), ":", 3), cut(intron_id, "^", 2)
    strand = F.when(told != "", told).otherwise(annotation_strand(F.substring(motif, 1, 2), F.substring(motif, 5, 2)))
    number = lambda k: cut(place, "-", k).try_cast("long")
    return F.when(intron_id.rlike(EITHER), F.struct(cut(intron_id, ":", 1).alias("chrom"), number(1).alias("start"), number(2).alias("end"), strand.alias("strand")))


def cluster(chrom: Column, position: Column, strand: Column) -> Column:
    return F.concat_ws(":", chrom, position.cast("string"), strand)


def dinucleotides(sequence: Column, start: Column, end: Column) -> Column:
    """First and last two bases of an intron (1-based, inclusive ends) of a short sequence, joined by ``--``."""
    return F.concat_ws("--", F.substring(sequence, start, F.lit(2)), F.substring(sequence, end - 1, F.lit(2)))


def cigar_introns(position: Column, cigar: Column) -> Column:
    """Array of (start, end) of the distinct gaps (N) of an alignment that begins at 1-based ``position``.

    A running reference position over the operations M, D, N, = and X.
    """
    sizes = F.transform(F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(1)), lambda x: x.cast("long"))
    kinds = F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(2))
    steps = F.zip_with(sizes, kinds, lambda n, k: F.struct(n.alias("n"), k.alias("k")))
    start = F.struct(position.cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("found"))

    def step(held: Column, op: Column) -> Column:
        moves = op.k.isin("M", "D", "N", "=", "X")
        here = F.struct(held["at"].alias("start"), (held["at"] + op.n - 1).alias("end"))
        return F.struct(
            F.when(moves, held["at"] + op.n).otherwise(held["at"]).alias("at"),
            F.when(op.k == "N", F.concat(held["found"], F.array(here))).otherwise(held["found"]).alias("found"),
        )

    return F.array_distinct(F.aggregate(steps, start, step, lambda held: held["found"]))
