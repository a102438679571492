"""Junction counts: summing, densifying, and the wide matrix at the edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from junctura.functions import introns as I

TILE = 1 << 16  # bases of a row of sequence
MAPPING_QUALITY, LEFT_OUT = 60, 256 | 4  # least quality; flags of secondary and of unmapped reads


def count_junctions(alignments: DataFrame, mapping_quality: int = MAPPING_QUALITY) -> DataFrame:
    """Reads per (sample_id, chrom, start, end) from alignments sample_id, flag, chrom, pos, mapq, cigar.

    Keeps mapped primary reads of the quality; a read counts once for each of
    its distinct gaps.
    """
    kept = alignments.where((F.col("mapq") >= mapping_quality) & (F.col("flag").bitwiseAND(LEFT_OUT) == 0) & F.col("cigar").contains("N"))
    gaps = kept.select("sample_id", "chrom", F.explode(I.cigar_introns(F.col("pos"), F.col("cigar"))).alias("gap"))
    return gaps.groupBy("sample_id", "chrom", F.col("gap.start").alias("start"), F.col("gap.end").alias("end")).agg(F.count("*").alias("count"))


def tiles(sequences: DataFrame, tile: int = TILE) -> DataFrame:
    """Sequences (chrom, seq) cut into rows of ``tile`` bases and one more: chrom, tile, bases.

    Bytes are cut, as characters would be counted from the start for each tile.
    """
    raw = sequences.select("chrom", F.col("seq").cast("binary").alias("raw"))
    last = F.greatest(F.lit(0), F.expr(f"(octet_length(raw) - 1) div {tile}")).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda k: F.substring("raw", k * tile + 1, F.lit(tile + 1)))
    return raw.select("chrom", F.posexplode(cut).alias("tile", "bases"))


def name_junctions(counts: DataFrame, sequences: DataFrame, tile: int = TILE) -> DataFrame:
    """Add intron, splice_pair and splice_flag from chromosome sequences (chrom, seq), or tiles of them; drops names with ``_``.

    Each end of a distinct junction is a row and meets the one tile that holds
    its two bases, so tiles are read once, the work grows with junctions and
    tiles, and no chromosome is one key.
    """
    main = counts.where(~F.col("chrom").contains("_"))
    cut = sequences if "bases" in sequences.columns else tiles(sequences, tile)
    sites = main.select("chrom", "start", "end").distinct().join(cut.select("chrom").distinct(), "chrom", "left_semi")
    ends = F.array(*[F.struct(F.lit(k).alias("__side"), (F.col(c) - n).cast("long").alias("__at")) for k, c, n in ((0, "start", 1), (1, "end", 2))])
    placed = sites.select("*", F.inline(ends)).withColumn("__tile", F.expr(f"__at div {tile}"))
    # Bases before a sequence's first or beyond its last are empty.
    held = cut.select("chrom", F.col("tile").cast("long").alias("__tile"), F.col("bases").alias("__bases"))
    own = F.substring("__bases", (F.col("__at") % tile + 1).cast("int"), F.lit(2)).cast("string")
    told = placed.join(held, ["chrom", "__tile"], "left").select("chrom", "start", "end", "__side", F.coalesce(F.when(F.col("__at") >= 0, own), F.lit("")).alias("__own"))
    side = lambda k: F.max(F.when(F.col("__side") == k, F.col("__own")))
    pair = told.groupBy("chrom", "start", "end").agg(F.concat_ws("--", side(0), side(1)).alias("splice_pair"))
    return main.join(pair, ["chrom", "start", "end"]).select(
        "sample_id", F.concat("chrom", F.lit(":"), "start", F.lit("-"), "end").alias("intron"), "splice_pair", I.splice_flag(F.col("splice_pair")).alias("splice_flag"), "count"
    )


def _token() -> Column:
    return I.intron_token(F.col("intron"), F.col("splice_pair"), F.col("splice_flag"))


def sum_junctions(junctions: DataFrame) -> DataFrame:
    """Matrix cells: counts summed per (intron_id, sample_id); samples of one name and repeated rows add up."""
    return junctions.groupBy(_token().alias("intron_id"), "sample_id").agg(F.sum("count").cast("long").alias("count"))


def junction_introns(junctions: DataFrame) -> DataFrame:
    """Distinct introns (intron_id) of junctions, without summing their cells first."""
    return junctions.select(_token().alias("intron_id")).distinct()


def sample_names(cells: DataFrame) -> list[str]:
    return sorted(r.sample_id for r in cells.select("sample_id").distinct().collect())


def packed(cells: DataFrame, samples: list[str]) -> DataFrame:
    """One row per intron: intron_id and counts, an array in the order of ``samples``; absent cells are 0, repeated cells add up.

    Rows dealt by intron once serve both aggregations.
    """
    once = cells.repartition("intron_id").groupBy("intron_id", "sample_id").agg(F.sum("count").alias("count"))
    held = once.groupBy("intron_id").agg(F.map_from_entries(F.collect_list(F.struct("sample_id", "count"))).alias("held"))
    count = lambda s: F.coalesce(F.try_element_at("held", s), F.lit(0)).cast("long")
    return held.select("intron_id", F.transform(_names(samples), count).alias("counts"))


def _names(samples: list[str]) -> Column:
    return F.array(*[F.lit(s) for s in samples]) if samples else F.array().cast("array<string>")


def array_sum(values: str) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda held, x: held + x)


def sums_by_place(rows: DataFrame, key: str) -> DataFrame:
    """Counts of packed rows summed for each key and place: key, place, total.

    Rows are dealt by key before they are taken apart, so what moves is a row an
    intron, and what follows may group by key again without moving anything.
    """
    placed = rows.select(key, "counts").repartition(key).select(key, F.posexplode("counts").alias("place", "n"))
    return placed.groupBy(key, "place").agg(F.sum("n").alias("total"))


def unpacked(rows: DataFrame, samples: list[str], values: dict[str, str] = {"counts": "count"}) -> DataFrame:  # noqa: B006
    """A row for every intron and sample, arrays in the samples' order (``values``: array to column) taken apart; other columns follow."""
    each = F.arrays_zip(_names(samples).alias("sample_id"), *[F.col(a).alias(v) for a, v in values.items()])
    return rows.select("intron_id", F.inline(each), *[c for c in rows.columns if c != "intron_id" and c not in values])


def densify(cells: DataFrame, samples: list[str]) -> DataFrame:
    """A row for every intron and sample, absent cells being 0; repeated cells add up.

    One aggregation per intron into an array and back, rather than a join with
    all pairs.
    """
    return unpacked(packed(cells, samples), samples)


def pivot_matrix(cells: DataFrame, samples: list[str]) -> DataFrame:
    """Wide matrix: intron_id and a column for each sample, absent cells 0."""
    wide = cells.groupBy("intron_id").pivot("sample_id", samples).agg(F.sum("count"))
    return wide.na.fill(0)


def unpivot_matrix(wide: DataFrame, key: str = "intron_id", other: tuple[str, ...] = ()) -> DataFrame:
    """Long form of a wide matrix; all columns but the key and ``other`` are samples."""
    samples = [c for c in wide.columns if c != key and c not in other]
    quoted = [f"`{c}`" for c in samples]
    return wide.unpivot([f"`{key}`", *(f"`{c}`" for c in other)], quoted, "sample_id", "count").withColumnRenamed(key, "intron_id")
