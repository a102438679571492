"""Registered queries of the engine and the SQL that says the same.

Values that depend on the order of a sum or on a library's logarithm are rounded
to nine digits on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from junctura.checkpoints import checkpointed
from junctura.functions import introns as I
from junctura.functions import pvalues
from junctura.operators import annotate, clusters, clusterstats, counts, fdr, filters, glm, integrate, plots, psi, samples
from junctura.plans import adapter as A

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(text: str | None = None, **extra: str) -> Callable[[Query], Query]:
    """Register a function under its name, with SQL over the adapter's CTEs."""

    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if text:
            ORACLE[f.__name__] = A.sql(text, extra)
        return f

    return put


def r9(x: Column | str) -> Column:
    return F.round(x, 9)


def lg(x: Column | str) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("long")


# Counts and identifiers.


@query("SELECT intron_id, sample_id, count FROM cell")
def junction_matrix_sum(spark, d):
    return A.cells(spark, d)


@query("SELECT intron_id, sample_id, count FROM dense")
def matrix_densify(spark, d):
    return counts.densify(A.cells(spark, d), A.SAMPLES)


_WIDE = ", ".join(f"CAST(coalesce(sum(count) FILTER (WHERE sample_id = '{s}'), 0) AS BIGINT) AS {s}" for s in A.SAMPLES)


@query(f"SELECT intron_id, {_WIDE} FROM cell GROUP BY 1")
def matrix_pivot(spark, d):
    return counts.pivot_matrix(A.cells(spark, d), A.SAMPLES)


@query("SELECT intron_id, sample_id, count FROM dense")
def matrix_unpivot(spark, d):
    return counts.unpivot_matrix(counts.pivot_matrix(A.cells(spark, d), A.SAMPLES))


@query('SELECT intron_id, chrom, "start", "end", strand, splice_pair, flag, donor, acceptor FROM intron')
def parse_intron_id(spark, d):
    return A.cells(spark, d).select("intron_id").distinct().withColumn("p", I.parse_strict(F.col("intron_id"))).select("intron_id", "p.*")


@query('SELECT intron_id, chrom, "start", "end", strand FROM lenient')
def parse_intron_lenient(spark, d):
    return A.cells(spark, d).select("intron_id").distinct().withColumn("p", I.parse_lenient(F.col("intron_id"))).select("intron_id", "p.*")


@query(
    "SELECT p_partkey, m AS splice_pair, CASE WHEN m IN ('GT--AG', 'GC--AG', 'AT--AC', 'CT--AC', 'CT--GC', 'GT--AT') THEN 'OK' ELSE 'NON' END AS splice_flag FROM cut",
    cut="SELECT p_partkey, substr(repeat('ACGTGTAGCTACGCAT', 20), p_partkey % 100 + 1, 2) || '--' || substr(repeat('ACGTGTAGCTACGCAT', 20), p_partkey % 100 + 11 + p_partkey % 50 - 1, 2) AS m FROM part",
)
def splice_flag(spark, d):
    k = F.col("p_partkey")
    start = (k % 100 + 1).cast("int")
    motif = I.dinucleotides(F.lit("ACGTGTAGCTACGCAT" * 20), start, start + 10 + (k % 50).cast("int"))
    return A.table(spark, d, "part").select("p_partkey", motif.alias("splice_pair"), I.splice_flag(motif).alias("splice_flag"))


CIGAR = """SELECT k, 'S' || (k % 3 + 1) AS sample_id, 'chr' || (k % 5) || CASE WHEN k % 11 = 0 THEN '_alt' ELSE '' END AS chrom, 1000 + k * 13 % 5000 AS pos,
    k % 50 + 1 AS a, k % 300 + 20 AS n, 20 + k % 7 AS b, 100 + k % 90 AS n2 FROM (SELECT p_partkey AS k FROM part) WHERE k % 4 <> 0 AND k % 5 <> 0"""


SAM = {
    "read": CIGAR,
    "gap": """SELECT k, sample_id, chrom, pos + a AS "start", pos + a + n - 1 AS "end" FROM "read" UNION
        SELECT k, sample_id, chrom, pos + a + n + b + 5, pos + a + n + b + 5 + n2 - 1 FROM "read" WHERE k % 3 = 0""",
}


def alignments(spark, d):
    k = F.col("p_partkey")
    tail = F.when(k % 3 == 0, F.concat(F.lit("5D"), 100 + k % 90, F.lit("N10M2S"))).otherwise("")
    return A.table(spark, d, "part").select(
        F.concat(F.lit("S"), k % 3 + 1).alias("sample_id"), F.when(k % 5 == 0, 256).otherwise(0).alias("flag"),
        F.concat(F.lit("chr"), k % 5, F.when(k % 11 == 0, "_alt").otherwise("")).alias("chrom"), (1000 + k * 13 % 5000).alias("pos"), F.when(k % 4 == 0, 20).otherwise(60).alias("mapq"),
        F.concat(k % 50 + 1, F.lit("M"), k % 300 + 20, F.lit("N"), 20 + k % 7, F.lit("M"), tail).alias("cigar"),
    )


@query('SELECT sample_id, chrom, "start", "end", count(*) AS count FROM gap WHERE NOT contains(chrom, \'_\') GROUP BY ALL', **SAM)
def sam_introns(spark, d):
    return counts.count_junctions(alignments(spark, d)).where(~F.col("chrom").contains("_"))


GENOME = """SELECT 'chr' || p_size % 7 AS chrom, string_agg(translate(md5(p_name), '0123456789abcdef', 'ACGTACGTACGTGTAG'), '' ORDER BY p_partkey) AS seq FROM part GROUP BY 1"""
SITE = """SELECT 'S' || l_linenumber AS sample_id, 'chr' || l_suppkey % 8 || CASE WHEN l_partkey % 11 = 0 THEN '_alt' ELSE '' END AS chrom, 1 + l_partkey * 31 % 9000 AS "start",
    1 + l_partkey * 31 % 9000 + 20 + l_suppkey * 13 % 700 AS "end", CAST(sum(l_quantity) AS BIGINT) AS count FROM lineitem GROUP BY 1, 2, 3, 4"""


def _bases():
    return F.translate(F.md5(F.col("p_name").cast("binary")), "0123456789abcdef", "ACGTACGTACGTGTAG")


def genome(spark, d):
    part = A.table(spark, d, "part").select(F.concat(F.lit("chr"), F.col("p_size") % 7).alias("chrom"), F.struct("p_partkey", _bases().alias("bases")).alias("one"))
    return part.groupBy("chrom").agg(F.array_join(F.transform(F.array_sort(F.collect_list("one")), lambda x: x.bases), "").alias("seq"))


def genome_lines(spark, d):
    """FASTA of the same sequences: a header and a line for each part, in order."""
    part = A.table(spark, d, "part").select((F.col("p_size") % 7).alias("c"), F.col("p_partkey").alias("k"), _bases().alias("value"))
    heads = part.groupBy("c").agg(F.lit(-1).cast(dict(part.dtypes)["k"]).alias("k")).withColumn("value", F.concat(F.lit(">chr"), "c", F.lit(" made of parts")))
    return part.unionByName(heads).orderBy("c", "k").select("value")


NAMING = f"""SELECT sample_id, chrom || ':' || "start" || '-' || "end" AS intron, pair AS splice_pair, CASE WHEN pair IN {I.CANONICAL} THEN 'OK' ELSE 'NON' END AS splice_flag, count
    FROM (SELECT s.*, substr(seq, "start", 2) || '--' || substr(seq, "end" - 1, 2) AS pair FROM site s JOIN genome USING (chrom) WHERE chrom NOT LIKE '%\\_%' ESCAPE '\\')"""


def sites(spark, d):
    start = 1 + F.col("l_partkey") * 31 % 9000
    return A.table(spark, d, "lineitem").groupBy(
        F.concat(F.lit("S"), "l_linenumber").alias("sample_id"), F.concat(F.lit("chr"), F.col("l_suppkey") % 8, F.when(F.col("l_partkey") % 11 == 0, "_alt").otherwise("")).alias("chrom"),
        start.alias("start"), (start + 20 + F.col("l_suppkey") * 13 % 700).alias("end"),
    ).agg(F.sum("l_quantity").cast("long").alias("count"))


@query(NAMING, genome=GENOME, site=SITE)
def junction_naming(spark, d):
    return counts.name_junctions(sites(spark, d), genome(spark, d), tile=512)


# Clusters and offsets.


@query("SELECT intron_id, donor_cluster, acceptor_cluster FROM intron")
def cluster_assign(spark, d):
    return clusters.assign_clusters(A.cells(spark, d).select("intron_id").distinct()).select("intron_id", "donor_cluster", "acceptor_cluster")


_SIZES = "SELECT '{0}' AS kind, count(*) AS n_clusters, min(n) AS least, median(n) AS middle, max(n) AS most FROM (SELECT {0}_cluster, count(*) AS n FROM intron GROUP BY 1)"


@query(f"{_SIZES.format('donor')} UNION ALL {_SIZES.format('acceptor')}")
def cluster_sizes(spark, d):
    rows = clusters.assign_clusters(A.cells(spark, d).select("intron_id").distinct())
    each = [clusters.cluster_sizes(rows, f"{k}_cluster").withColumn("kind", F.lit(k)) for k in ("donor", "acceptor")]
    return each[0].unionByName(each[1])


@query("SELECT donor_cluster, sample_id, CAST(sum(count) AS BIGINT) AS total FROM dense GROUP BY 1, 2")
def donor_totals(spark, d):
    return clusters.cluster_totals(A.dense(spark, d), "donor_cluster")


@query("SELECT acceptor_cluster, sample_id, CAST(sum(count) AS BIGINT) AS total FROM dense GROUP BY 1, 2")
def acceptor_totals(spark, d):
    return clusters.cluster_totals(A.dense(spark, d), "acceptor_cluster")


@query("SELECT intron_id, sample_id, donor_total, acceptor_total, shared_total FROM total")
def shared_offsets(spark, d):
    return A.totals(spark, d).select("intron_id", "sample_id", "donor_total", "acceptor_total", "shared_total")


@query("SELECT intron_id, sample_id, donor_total AS shared_total FROM total")
def single_cluster_offsets(spark, d):
    return clusters.add_totals(A.dense(spark, d), ("donor_cluster",)).select("intron_id", "sample_id", "shared_total")


@query("SELECT intron_id, sample_id, round(ln(shared_total + 0.5::DOUBLE), 9) AS log_offset FROM total")
def log_offsets(spark, d):
    return A.totals(spark, d).select("intron_id", "sample_id", r9(clusters.log_offset()).alias("log_offset"))


@query(
    """SELECT count(*) AS n_cells, count(*) FILTER (WHERE shared_total > 0) AS n_positive, min(shared_total) FILTER (WHERE shared_total > 0) AS least,
    median(shared_total) FILTER (WHERE shared_total > 0) AS middle, max(shared_total) FILTER (WHERE shared_total > 0) AS most,
    round(CAST(sum(shared_total) FILTER (WHERE shared_total > 0) AS DOUBLE) / count(*) FILTER (WHERE shared_total > 0), 9) AS mean,
    count(*) FILTER (WHERE donor_total >= acceptor_total) AS n_donor, count(*) FILTER (WHERE acceptor_total > donor_total) AS n_acceptor,
    count(*) FILTER (WHERE shared_total < 10) AS n_small, count(*) FILTER (WHERE shared_total IS NULL) AS n_missing FROM total"""
)
def offset_summary(spark, d):
    return clusters.offset_summary(A.totals(spark, d)).withColumn("mean", r9("mean"))


# Samples and contrasts.

_META = "SELECT * FROM (VALUES ('S1', 'A'), ('S2', 'A'), ('S3', 'A'), ('S4', 'B'), ('S5', 'B'), ('S9', 'B'), (' ', 'A'), (NULL, 'A')) AS v(sample_id, grp) WHERE trim(sample_id) <> ''"


@query("SELECT intron_id, sample_id, count FROM cell WHERE sample_id IN (SELECT sample_id FROM meta)", meta=_META)
def samples_intersect(spark, d):
    return samples.keep_samples(A.cells(spark, d), A.wild_metadata(spark)).select("intron_id", "sample_id", "count")


@query("SELECT sample_id FROM meta EXCEPT SELECT sample_id FROM cell", meta=_META)
def samples_missing(spark, d):
    return samples.missing_samples(A.cells(spark, d), A.wild_metadata(spark))


@query("SELECT sample_id FROM cell EXCEPT SELECT sample_id FROM meta", meta=_META)
def samples_excluded(spark, d):
    return samples.excluded_samples(A.cells(spark, d), A.wild_metadata(spark))


@query("SELECT DISTINCT c_mktsegment AS \"group\" FROM customer WHERE c_mktsegment IS NOT NULL")
def groups_distinct(spark, d):
    return samples.groups(A.table(spark, d, "customer"), "c_mktsegment")


@query("SELECT a.grp || '-' || b.grp AS contrast FROM seg a JOIN seg b ON a.grp < b.grp", seg="SELECT DISTINCT c_mktsegment AS grp FROM customer")
def contrasts_pairwise(spark, d):
    names = [r.group for r in samples.groups(A.table(spark, d, "customer"), "c_mktsegment").collect()]
    return spark.createDataFrame([(c,) for c in samples.pairwise_contrasts(names)], "contrast string")


@query(
    "SELECT grp || '-BUILDING,MACHINERY' AS contrast, grp || '_vs_BUILDING_MACHINERY' AS label FROM seg WHERE grp NOT IN ('BUILDING', 'MACHINERY')",
    seg="SELECT DISTINCT c_mktsegment AS grp FROM customer",
)
def contrasts_vs_controls(spark, d):
    names = [r.group for r in samples.groups(A.table(spark, d, "customer"), "c_mktsegment").collect()]
    rows = [(c, samples.contrast_label(c)) for c in samples.control_contrasts(names, ["BUILDING", "MACHINERY"])]
    return spark.createDataFrame(rows, "contrast string, label string")


@query("SELECT contrast, count(*) AS n_introns FROM result GROUP BY 1")
def contrast_union(spark, d):
    rows = A.results(spark, d)
    parts = [rows.where(F.col("contrast") == c) for c in ("A_vs_B", "A_vs_C")]
    return parts[0].unionByName(parts[1].drop("gene_name"), allowMissingColumns=True).groupBy("contrast").agg(F.count("*").alias("n_introns"))


# Filters.

_CELL = "intron_id, sample_id, count"


def _cells(rows):
    return counts.unpacked(rows, A.SAMPLES).select("intron_id", "sample_id", "count")


@query(f"SELECT {_CELL} FROM canonical")
def filter_canonical(spark, d):
    return _cells(filters.canonical(A.packed(spark, d)))


@query(f"SELECT {_CELL} FROM lowcount")
def filter_low_count(spark, d):
    return _cells(_survivors(spark, d))


def _survivors(spark, d):
    return filters.low_count(filters.canonical(A.packed(spark, d)), A.LIMITS["min_intron_count"], A.LIMITS["min_intron_samples"])


_CLUSTER = (A.LIMITS["min_cluster_count"], A.LIMITS["min_cluster_samples"])


@query(f"SELECT {_CELL} FROM flagged WHERE d")
def filter_cluster_single(spark, d):
    return _cells(filters.single_cluster(_survivors(spark, d), "donor_cluster", *_CLUSTER))


@query(f"SELECT {_CELL} FROM kept")
def filter_cluster_either(spark, d):
    return _cells(filters.either_cluster(_survivors(spark, d), *_CLUSTER))


@query("SELECT intron_id, donor_cluster, acceptor_cluster, CAST(sum(count) AS BIGINT) AS n FROM kept GROUP BY 1, 2, 3")
def filter_chain(spark, d):
    kept = filters.chain(A.packed(spark, d), **A.LIMITS)
    return kept.select("intron_id", "donor_cluster", "acceptor_cluster", counts.array_sum("counts").alias("n"))


@query(
    """SELECT count(*) AS n_before, count(*) FILTER (WHERE d OR a) AS n_kept, count(*) FILTER (WHERE NOT (d OR a)) AS n_removed, count(*) FILTER (WHERE d AND a) AS n_both,
    count(*) FILTER (WHERE d AND NOT a) AS n_donor_only, count(*) FILTER (WHERE a AND NOT d) AS n_acceptor_only FROM (SELECT DISTINCT intron_id, d, a FROM flagged)"""
)
def filter_breakdown(spark, d):
    return filters.breakdown(_survivors(spark, d), *_CLUSTER)


@query(
    """SELECT count(DISTINCT donor_cluster) AS donor_before, count(DISTINCT donor_cluster) FILTER (WHERE d OR a) AS donor_after,
    count(DISTINCT acceptor_cluster) AS acceptor_before, count(DISTINCT acceptor_cluster) FILTER (WHERE d OR a) AS acceptor_after FROM flagged"""
)
def cluster_counts(spark, d):
    # Flags are those of clusters, so a row for each pair of clusters says all.
    flagged = filters.cluster_flags(_survivors(spark, d), *_CLUSTER).select("donor_cluster", "acceptor_cluster", "donor_passes", "acceptor_passes").distinct()
    flagged = checkpointed(flagged)
    return filters.cluster_counts(flagged, flagged.where("donor_passes or acceptor_passes"))


# PSI.


@query("SELECT intron_id, sample_id, psi FROM psi")
def psi_long(spark, d):
    return psi.psi_values(A.totals(spark, d)).select("intron_id", "sample_id", "psi")


@query("SELECT intron_id, sample_id, CASE WHEN acceptor_total > 0 THEN CAST(count AS DOUBLE) / acceptor_total ELSE 0.0 END AS psi FROM total")
def psi_legacy_cluster(spark, d):
    return psi.psi_legacy(A.dense(spark, d), "acceptor_cluster").select("intron_id", "sample_id", "psi")


@query(
    """SELECT intron_id, grp AS "group", round(avg(psi), 12) AS mean_psi, round(median(psi), 12) AS median_psi, round(stddev_samp(psi), 12) AS std_psi, count(*) AS n_samples
    FROM psi GROUP BY 1, 2"""
)
def psi_group_stats(spark, d):
    stats = psi.group_stats(psi.psi_values(A.totals(spark, d)), A.metadata(spark))
    return stats.withColumns({c: F.round(c, 12) for c in ("mean_psi", "median_psi", "std_psi")})


_DELTA = "SELECT intron_id, avg(psi) FILTER (WHERE grp = 'A') AS mean_first, avg(psi) FILTER (WHERE grp = 'B') AS mean_other FROM psi GROUP BY 1"


def _delta(spark, d):
    return psi.delta_psi(psi.psi_values(A.totals(spark, d)), A.metadata(spark), "A", ["B"])


@query("SELECT intron_id, round(mean_first, 9) AS mean_first, round(mean_other, 9) AS mean_other, round(mean_first - mean_other, 9) AS delta_psi FROM delta", delta=_DELTA)
def psi_delta(spark, d):
    return _delta(spark, d).select("intron_id", *(r9(c).alias(c) for c in ("mean_first", "mean_other", "delta_psi")))


@query("SELECT count(*) AS n_introns, count(*) FILTER (WHERE abs(mean_first - mean_other) > 0.1) AS n_high FROM delta", delta=_DELTA)
def psi_high_delta(spark, d):
    return psi.high_delta(_delta(spark, d))


# Multiple testing.


def _bh(name: str, source: str, by: str = "", p: str = '"PValue"') -> dict[str, str]:
    part = f"PARTITION BY {by}" if by else ""
    return {
        f"{name}_rank": f"SELECT *, row_number() OVER ({part} ORDER BY {p}) AS rk, count(*) OVER ({part}) AS n FROM {source} WHERE {p} IS NOT NULL",
        name: f"SELECT * EXCLUDE (rk, n), least(1.0::DOUBLE, min({p} * n / rk) OVER ({part} ORDER BY rk DESC ROWS UNBOUNDED PRECEDING)) AS fdr FROM {name}_rank UNION ALL BY NAME SELECT *, NULL::DOUBLE AS fdr FROM {source} WHERE {p} IS NULL",
    }


_BY = _bh("adjusted", "result", "contrast")
_FLAG = _BY | {"tested": 'SELECT *, fdr < 0.2 AND abs("logFC") >= 0.5 AS significant FROM adjusted'}


def tested(spark, d):
    return fdr.flag_significant(fdr.bh_fdr(A.results(spark, d), "PValue", ("contrast",)), 0.2, 0.5)


@query('SELECT intron_id, contrast, "PValue", round(fdr, 12) AS "FDR" FROM adjusted', **_BY)
def bh_fdr_by_contrast(spark, d):
    return fdr.bh_fdr(A.results(spark, d), "PValue", ("contrast",)).select("intron_id", "contrast", "PValue", F.round("FDR", 12).alias("FDR"))


@query('SELECT intron_id, contrast, "PValue", round(fdr, 12) AS "FDR" FROM adjusted', **_bh("adjusted", "result"))
def bh_fdr_pooled(spark, d):
    return fdr.bh_fdr(A.results(spark, d), "PValue").select("intron_id", "contrast", "PValue", F.round("FDR", 12).alias("FDR"))


@query('SELECT intron_id, contrast, significant FROM tested', **_FLAG)
def significance_flags(spark, d):
    return tested(spark, d).select("intron_id", "contrast", "significant")


@query(
    """SELECT contrast, count(*) AS n_tested, count(*) FILTER (WHERE significant) AS n_significant, count(*) FILTER (WHERE significant AND "logFC" > 0) AS n_up,
    count(*) FILTER (WHERE significant AND "logFC" < 0) AS n_down, min("logFC") AS "least_logFC", median("logFC") AS "middle_logFC", max("logFC") AS "most_logFC" FROM tested GROUP BY 1""",
    **_FLAG,
)
def result_summary(spark, d):
    return fdr.result_summary(tested(spark, d))


@query('SELECT intron_id, contrast, "logFC", round(-log10("PValue"), 9) AS neg_log10_p, significant FROM tested', **_FLAG)
def volcano_data(spark, d):
    return fdr.volcano(tested(spark, d)).withColumn("neg_log10_p", r9("neg_log10_p"))


_PLOT = _FLAG | {
    "point": 'SELECT intron_id, contrast, "logFC", round(-log10("PValue"), 9) AS p, significant FROM tested WHERE "PValue" IS NOT NULL',
    "size": 'SELECT min("logFC") AS lx, (max("logFC") - min("logFC")) / 80 AS dx, min(p) AS ly, (max(p) - min(p)) / 80 * sqrt(3.0::DOUBLE) AS dy FROM point',
    "unit": 'SELECT *, ("logFC" - lx) / dx AS u, (p - ly) / dy AS v FROM point, size',
    "side": "SELECT *, (u - floor(u + 0.5)) ** 2 + 3 * (v - floor(v + 0.5)) ** 2 < (u - floor(u) - 0.5) ** 2 + 3 * (v - floor(v) - 0.5) ** 2 AS one FROM unit",
    "hexed": "SELECT *, CASE WHEN one THEN floor(u + 0.5) ELSE floor(u) + 0.5 END AS a, CASE WHEN one THEN floor(v + 0.5) ELSE floor(v) + 0.5 END AS b FROM side",
}


def _points(spark, d):
    return fdr.volcano(tested(spark, d)).withColumn("neg_log10_p", r9("neg_log10_p"))


@query("SELECT contrast, round(a * dx + lx, 6) AS hex_x, round(b * dy + ly, 6) AS hex_y, count(*) AS n, count(*) FILTER (WHERE significant) AS n_significant FROM hexed GROUP BY ALL", **_PLOT)
def volcano_hexagons(spark, d):
    found = plots.hexagons(_points(spark, d), "logFC", "neg_log10_p", ("contrast",), n_significant=F.count_if("significant"))
    return found.withColumns({c: F.round(c, 6) for c in ("hex_x", "hex_y")})


@query('SELECT intron_id, contrast, "logFC", p AS neg_log10_p FROM (SELECT *, count(*) OVER (PARTITION BY contrast, a, b) AS n FROM hexed) WHERE n <= 2', **_PLOT)
def volcano_apart(spark, d):
    return plots.apart(_points(spark, d), "logFC", "neg_log10_p", ("contrast",)).select("intron_id", "contrast", "logFC", "neg_log10_p")


_JOINED = {"delta": _DELTA, **_FLAG, "with_psi": "SELECT t.*, round(x.mean_first - x.mean_other, 9) AS delta_psi FROM tested t LEFT JOIN delta x USING (intron_id)"}


def _with_psi(spark, d):
    return tested(spark, d).join(_delta(spark, d).select("intron_id", r9("delta_psi").alias("delta_psi")), "intron_id", "left")


@query('SELECT intron_id, contrast, "PValue", "logFC", delta_psi FROM with_psi', **_JOINED)
def results_with_psi(spark, d):
    return _with_psi(spark, d).select("intron_id", "contrast", "PValue", "logFC", "delta_psi")


@query(
    'SELECT intron_id, contrast, delta_psi, round("FDR_original", 12) AS "FDR_original", round(fdr, 12) AS "FDR", fdr <= 0.05 AS significant FROM again',
    **_JOINED, far='SELECT * EXCLUDE (fdr, significant), fdr AS "FDR_original" FROM with_psi WHERE abs(delta_psi) >= 0.02', **_bh("again", "far"),
)
def delta_filter_fdr(spark, d):
    kept = fdr.refilter(_with_psi(spark, d), 0.02)
    return kept.select("intron_id", "contrast", "delta_psi", F.round("FDR_original", 12).alias("FDR_original"), F.round("FDR", 12).alias("FDR"), "significant")


# Clusters of results. Logarithms of p-values are compared, so that small ones count.


def log10p(p: Column) -> Column:
    return F.round(F.log10(p), 8)


_FISHER = {
    "sums": """SELECT contrast, cluster, count(*) FILTER (WHERE "PValue" > 0 AND "PValue" <= 1) AS m, abs(sum(ln("PValue")) FILTER (WHERE "PValue" > 0 AND "PValue" <= 1)) AS h FROM result GROUP BY 1, 2""",
}
_VALID = '"PValue" > 0 AND "PValue" <= 1'
_CAUCHY = f'CASE WHEN count(*) FILTER (WHERE {_VALID}) > 0 THEN greatest(0.0, least(1.0, atan2(1.0::DOUBLE, avg(tan((0.5 - "PValue") * pi())) FILTER (WHERE {_VALID})) / pi())) END'


@query(
    """SELECT contrast, cluster, round(log10(CASE WHEN m > 0 THEN least(1.0, (SELECT sum(exp(j * ln(h) - lgamma(j + 1) - h)) FROM range(0, m) AS r(j))) END), 8) AS log10_p FROM sums""",
    **_FISHER,
)
def fisher_by_cluster(spark, d):
    return A.results(spark, d).groupBy("contrast", "cluster").agg(log10p(pvalues.fisher(F.col("PValue"))).alias("log10_p"))


@query(f"SELECT contrast, cluster, round(log10({_CAUCHY}), 8) AS log10_p FROM result GROUP BY 1, 2")
def cauchy_by_cluster(spark, d):
    return A.results(spark, d).groupBy("contrast", "cluster").agg(log10p(pvalues.cauchy(F.col("PValue"))).alias("log10_p"))


@query(
    """SELECT contrast, cluster, CASE WHEN count("PValue") > 0 THEN round(log10(greatest(0.0, least(1.0, atan2(1.0::DOUBLE, sum(s * tan((0.5 - "PValue") * pi())) FILTER (WHERE "PValue" > 0) / sum(s) FILTER (WHERE "PValue" > 0)) / pi()))), 8) END AS log10_p
    FROM result GROUP BY 1, 2"""
)
def cauchy_weighted(spark, d):
    weight = F.col("s").cast("double")
    return A.results(spark, d).groupBy("contrast", "cluster").agg(log10p(pvalues.cauchy(F.col("PValue"), weight)).alias("log10_p"))


_SURE = "coalesce(significant, FALSE)"
AGG = _FLAG | {
    "clustered": f"""SELECT contrast, cluster, count(*) AS n_introns, count(*) FILTER (WHERE {_SURE}) AS n_significant_introns, {_CAUCHY} AS cluster_pvalue,
        count(*) FILTER (WHERE {_SURE} AND "logFC" > 0) AS n_increased, count(*) FILTER (WHERE {_SURE} AND "logFC" < 0) AS n_decreased,
        coalesce(max(abs("logFC")) FILTER (WHERE {_SURE}), 0.0::DOUBLE) AS "max_abs_logFC", coalesce(avg("logFC") FILTER (WHERE {_SURE}), 0.0::DOUBLE) AS "mean_logFC" FROM tested GROUP BY 1, 2""",
    "directed": """SELECT *, CASE WHEN n_significant_introns = 0 THEN 'none' WHEN n_increased > n_decreased THEN 'increased' WHEN n_decreased > n_increased THEN 'decreased' ELSE 'mixed' END AS dominant_direction FROM clustered""",
    **_bh("with_fdr", "directed", "contrast", "cluster_pvalue"),
}


def aggregated(spark, d):
    rows = tested(spark, d).drop("gene_name")
    return clusterstats.aggregate_clusters(rows, "cauchy", by=("contrast",))


@query('SELECT * EXCLUDE (fdr, cluster_pvalue, "mean_logFC"), round(log10(cluster_pvalue), 8) AS log10_p, round("mean_logFC", 9) AS "mean_logFC", round(log10(fdr), 8) AS log10_fdr FROM with_fdr', **AGG)
def cluster_aggregate(spark, d):
    rows = aggregated(spark, d).withColumn("log10_p", log10p(F.col("cluster_pvalue"))).withColumn("log10_fdr", log10p(F.col("cluster_FDR")))
    return rows.withColumn("mean_logFC", r9("mean_logFC")).drop("cluster_pvalue", "cluster_FDR")


@query(
    """SELECT contrast, cluster, round(coalesce(avg(delta_psi) FILTER (WHERE significant), avg(delta_psi)), 9) AS mean_delta_psi,
    round(coalesce(max(abs(delta_psi)) FILTER (WHERE significant), max(abs(delta_psi))), 9) AS max_abs_delta_psi FROM raw_psi GROUP BY 1, 2""",
    **_JOINED, raw_psi="SELECT t.*, x.mean_first - x.mean_other AS delta_psi FROM tested t LEFT JOIN delta x USING (intron_id)",
)
def cluster_psi_stats(spark, d):
    rows = tested(spark, d).join(_delta(spark, d).select("intron_id", "delta_psi"), "intron_id", "left")
    found = clusterstats.combined_clusters(rows, "cauchy", by=("contrast",))
    return found.select("contrast", "cluster", r9("mean_delta_psi").alias("mean_delta_psi"), r9("max_abs_delta_psi").alias("max_abs_delta_psi"))


@query("SELECT contrast, cluster, coalesce(array_to_string(list_sort(list(DISTINCT gene_name) FILTER (WHERE gene_name IS NOT NULL)), ', '), '') AS gene_name FROM result GROUP BY 1, 2")
def cluster_genes(spark, d):
    return clusterstats.combined_clusters(tested(spark, d), "cauchy", by=("contrast",)).select("contrast", "cluster", "gene_name")


@query(
    'SELECT t.intron_id, t.contrast, t.cluster, round(log10(c.cluster_pvalue), 8) AS log10_p, c.dominant_direction FROM tested t JOIN with_fdr c ON t.contrast = c.contrast AND t.cluster = c.cluster WHERE c.fdr < 0.05',
    **AGG,
)
def sig_cluster_introns(spark, d):
    rows = tested(spark, d).withColumn("key", F.concat_ws("/", "contrast", "cluster"))
    found = aggregated(spark, d).withColumn("key", F.concat_ws("/", "contrast", "cluster"))
    return clusterstats.significant_cluster_introns(rows, found, "key").select("intron_id", "contrast", "cluster", log10p(F.col("cluster_pvalue")).alias("log10_p"), "dominant_direction")


@query("SELECT dominant_direction, count(*) AS n_clusters FROM with_fdr WHERE fdr < 0.05 GROUP BY 1", **AGG)
def cluster_summary(spark, d):
    return clusterstats.cluster_summary(aggregated(spark, d))


# Annotation.


@query('SELECT chrom, "start", "end", strand, transcript_id, gene_name FROM exon_intron')
def exon_introns(spark, d):
    return annotate.exon_introns(A.exons(spark, d))


@query('SELECT transcript_id, chrom, "start", "end", strand, gene_name FROM span')
def transcript_spans(spark, d):
    return annotate.transcript_spans(A.exons(spark, d))


@query('SELECT chrom, "start", "end", strand, gene_name FROM gene_at')
def gene_map_last(spark, d):
    return annotate.gene_map(A.genes(spark, d))


@query("SELECT chrom, \"start\", \"end\", strand, array_to_string(genes, ',') AS genes FROM intron_gene")
def intron_gene_sets(spark, d):
    return annotate.intron_genes(annotate.exon_introns(A.exons(spark, d))).withColumn("genes", F.concat_ws(",", "genes"))


def annotated(spark, d, introns=None):
    """Notes of the introns of all junctions, or of those given (distinct)."""
    exon = A.exons(spark, d)
    index = annotate.gene_index(annotate.gene_map(A.genes(spark, d)), annotate.transcript_spans(exon))
    return annotate.notes(A.introns(spark, d) if introns is None else introns, annotate.intron_genes(annotate.exon_introns(exon)), index)


@query("SELECT intron_id, intron_status FROM annotated")
def known_novel(spark, d):
    return annotated(spark, d).select("intron_id", "intron_status")


@query("SELECT intron_id, array_to_string(genes, ',') AS genes FROM over")
def overlap_genes(spark, d):
    index = annotate.gene_index(annotate.gene_map(A.genes(spark, d)), annotate.transcript_spans(A.exons(spark, d)))
    names = annotate.parsed(A.introns(spark, d))
    met = annotate.interval_join(names, index, ["chrom", "strand"])
    return met.groupBy("intron_id").agg(F.concat_ws(",", F.array_sort(F.collect_set("gene_name"))).alias("genes"))


@query("SELECT intron_id, gene_name, intron_status, overlapping_genes FROM annotated")
def gene_assignment(spark, d):
    return annotated(spark, d).select("intron_id", "gene_name", "intron_status", "overlapping_genes")


@query("SELECT intron_status, count(*) AS n_introns, count(*) FILTER (WHERE gene_name <> '.') AS n_with_gene FROM annotated GROUP BY 1")
def annotation_summary(spark, d):
    return annotate.annotation_summary(annotated(spark, d))


@query("SELECT p_partkey, 'G' || (p_partkey % 60) AS gene_id, CASE WHEN p_partkey % 3 = 0 THEN 'N' || p_partkey END AS gene_name, 't' || (p_partkey % 7 + 1) AS tag FROM part")
def gtf_attributes(spark, d):
    k = F.col("p_partkey")
    text = F.concat(
        F.lit('gene_id "G'), k % 60, F.lit('"; tag "first"; '), F.when(k % 3 == 0, F.concat(F.lit('gene_name "N'), k, F.lit('"; '))).otherwise(""), F.lit('tag "t'), k % 7 + 1, F.lit('";'),
    )
    rows = A.table(spark, d, "part").select("p_partkey", text.alias("attributes"))
    return rows.select("p_partkey", *(annotate.attribute(F.col("attributes"), c).alias(c) for c in ("gene_id", "gene_name", "tag")))


@query('SELECT r.intron_id, contrast, "PValue", a.gene_name, intron_status, overlapping_genes FROM result r LEFT JOIN annotated a USING (intron_id)')
def results_annotated(spark, d):
    rows = A.results(spark, d).drop("gene_name")
    found = annotate.to_results(rows, annotated(spark, d))
    return found.select("intron_id", "contrast", "PValue", "gene_name", "intron_status", "overlapping_genes")


# Integration.

SIDES = {
    **_FLAG,
    "donor": """SELECT intron_id, contrast, gene_name, "PValue" AS "donor_PValue", round(fdr, 12) AS "donor_FDR", "logFC" AS "donor_logFC", significant AS donor_significant FROM tested WHERE s % 3 <> 0""",
    "acceptor": """SELECT intron_id, contrast, gene_name, "PValue" AS "acceptor_PValue", round(fdr, 12) AS "acceptor_FDR", CASE WHEN k % 2 = 0 THEN "logFC" ELSE -"logFC" END AS "acceptor_logFC", significant AS acceptor_significant FROM tested WHERE s % 4 <> 1""",
    "outer2": """SELECT coalesce(d.intron_id, a.intron_id) AS intron_id, coalesce(d.contrast, a.contrast) AS contrast, coalesce(d.gene_name, a.gene_name) AS gene_name,
        d.* EXCLUDE (intron_id, contrast, gene_name), a.* EXCLUDE (intron_id, contrast, gene_name)
        FROM donor d FULL JOIN acceptor a ON d.intron_id = a.intron_id AND d.contrast = a.contrast AND d.gene_name IS NOT DISTINCT FROM a.gene_name""",
    "judged": """SELECT *, CASE WHEN "donor_PValue" IS NOT NULL AND "acceptor_PValue" IS NOT NULL THEN 'both' WHEN "donor_PValue" IS NOT NULL THEN 'donor_only' WHEN "acceptor_PValue" IS NOT NULL THEN 'acceptor_only' ELSE 'neither' END AS tested_in,
        CASE WHEN coalesce(donor_significant, FALSE) AND coalesce(acceptor_significant, FALSE) THEN 'both' WHEN coalesce(donor_significant, FALSE) THEN 'donor_only' WHEN coalesce(acceptor_significant, FALSE) THEN 'acceptor_only' ELSE 'neither' END AS significant_in,
        CASE WHEN coalesce(donor_significant, FALSE) AND coalesce(acceptor_significant, FALSE) THEN sign("donor_logFC") = sign("acceptor_logFC") END AS direction_consistent,
        least("donor_FDR", "acceptor_FDR") AS "best_FDR", CASE WHEN "donor_FDR" <= "acceptor_FDR" THEN 'donor' ELSE 'acceptor' END AS best_analysis,
        CASE WHEN "donor_FDR" <= "acceptor_FDR" THEN "donor_logFC" ELSE "acceptor_logFC" END AS "best_logFC" FROM outer2""",
}


def _sides(spark, d):
    rows = tested(spark, d).withColumn("FDR", F.round("FDR", 12))
    columns = ["intron_id", "contrast", "gene_name", "PValue", "FDR", "logFC", "significant"]
    other = rows.where("s % 4 <> 1").withColumn("logFC", F.when(F.col("k") % 2 == 0, F.col("logFC")).otherwise(-F.col("logFC")))
    return rows.where("s % 3 <> 0").select(columns), other.select(columns)


def integrated(spark, d):
    return integrate.integrate(*_sides(spark, d))


@query('SELECT intron_id, contrast, gene_name, "donor_PValue", "acceptor_PValue", "donor_logFC", "acceptor_logFC" FROM judged', **SIDES)
def integrate_outer(spark, d):
    return integrated(spark, d).select("intron_id", "contrast", "gene_name", "donor_PValue", "acceptor_PValue", "donor_logFC", "acceptor_logFC")


@query("SELECT intron_id, contrast, tested_in, significant_in, direction_consistent FROM judged", **SIDES)
def integrate_status(spark, d):
    return integrated(spark, d).select("intron_id", "contrast", "tested_in", "significant_in", "direction_consistent")


@query('SELECT intron_id, contrast, best_analysis, "best_FDR", "best_logFC" FROM judged', **SIDES)
def integrate_best(spark, d):
    return integrated(spark, d).select("intron_id", "contrast", "best_analysis", "best_FDR", "best_logFC")


def _counters() -> str:
    of = lambda column, value, name: f"count(*) FILTER (WHERE {column} = '{value}') AS {name}"
    parts = ["count(*) AS total_introns"] + [of("tested_in", v, f"tested_{v}") for v in ("both", "donor_only", "acceptor_only")]
    parts += [of("significant_in", v, f"significant_{v}") for v in ("both", "donor_only", "acceptor_only", "neither")]
    parts += ["count(*) FILTER (WHERE direction_consistent) AS both_sig_consistent_direction", "count(*) FILTER (WHERE NOT direction_consistent) AS both_sig_opposite_direction"]
    return ", ".join(parts)


@query(f"SELECT {_counters()} FROM judged", **SIDES)
def integrate_summary(spark, d):
    return integrate.summary(integrated(spark, d))


@query("SELECT intron_id, contrast, significant_in FROM judged WHERE significant_in <> 'neither'", **SIDES)
def significant_integrated(spark, d):
    return integrate.significant(integrated(spark, d)).select("intron_id", "contrast", "significant_in")


# The model.


@query(
    """SELECT intron_id, round(ln((a + 0.5::DOUBLE) / (ta + 0.5::DOUBLE)) - ln((b + 0.5::DOUBLE) / (tb + 0.5::DOUBLE)), 9) AS usage_log_ratio FROM (
    SELECT intron_id, sum(count) FILTER (WHERE grp = 'A') AS a, sum(shared_total) FILTER (WHERE grp = 'A') AS ta, sum(count) FILTER (WHERE grp = 'B') AS b, sum(shared_total) FILTER (WHERE grp = 'B') AS tb FROM total GROUP BY 1)"""
)
def usage_log_ratio(spark, d):
    rows = psi.grouped(A.totals(spark, d), A.metadata(spark))
    add = lambda c, g: F.sum(F.when(F.col("group") == g, F.col(c))) + F.lit(0.5)
    ratio = F.log(add("count", "A") / add("shared_total", "A")) - F.log(add("count", "B") / add("shared_total", "B"))
    return rows.groupBy("intron_id").agg(r9(ratio).alias("usage_log_ratio"))


def _meta(batch: bool = False, pooled: bool = False) -> pd.DataFrame:
    groups = {**A.GROUPS, "S6": "C", "S7": "C"} if pooled else A.GROUPS
    meta = pd.DataFrame({"sample_id": list(groups), "group": list(groups.values())})
    return meta.assign(batch=[f"b{i % 2}" for i in range(len(meta))]) if batch else meta


@query("SELECT intron_id, CAST(row_number() OVER (PARTITION BY intron_id ORDER BY sample_id) - 1 AS INTEGER) AS place, CAST(count AS DOUBLE) AS count, round(ln(shared_total + 0.5::DOUBLE), 9) AS \"offset\" FROM total")
def glm_sample_order(spark, d):
    """Counts and offsets as arrays in the order of the design's samples."""
    rows = glm.model_input(A.totals(spark, d), glm.design(_meta()))
    return rows.select("intron_id", F.posexplode(F.arrays_zip("counts", "offsets")).alias("place", "x")).select("intron_id", "place", F.col("x.counts").alias("count"), r9("x.offsets").alias("offset"))


_PHI, _NEWTON = 0.1, 40


def _newton() -> dict[str, str]:
    """Scoring steps for the mean of each intron and group, one after another."""
    out = {"cellwise": """SELECT intron_id, grp, CAST(count AS DOUBLE) AS y, ln(shared_total + 0.5::DOUBLE) AS o FROM total
        WHERE intron_id IN (SELECT intron_id FROM (SELECT intron_id, grp, sum(count) AS n FROM total GROUP BY 1, 2) GROUP BY 1 HAVING min(n) >= 100)""",
        "step0": "SELECT intron_id, grp, avg(ln(y + 0.5) - o) AS b FROM cellwise GROUP BY 1, 2"}
    for k in range(_NEWTON):
        out[f"step{k + 1}"] = f"""SELECT c.intron_id, c.grp, any_value(b) + sum((y - exp(b + o)) / (1 + {_PHI}::DOUBLE * exp(b + o))) / sum(exp(b + o) / (1 + {_PHI}::DOUBLE * exp(b + o))) AS b
            FROM cellwise c JOIN step{k} s ON c.intron_id = s.intron_id AND c.grp = s.grp GROUP BY 1, 2"""
    return out


@query(
    f"""SELECT c.intron_id, round(max(b) FILTER (WHERE c.grp = 'A'), 5) AS beta_a, round(max(b) FILTER (WHERE c.grp = 'B'), 5) AS beta_b,
    round(2 * sum(CASE WHEN y > 0 THEN y * ln(y / exp(b + o)) ELSE 0 END - (y + {1 / _PHI}::DOUBLE) * ln((y + {1 / _PHI}::DOUBLE) / (exp(b + o) + {1 / _PHI}::DOUBLE))), 5) AS deviance
    FROM cellwise c JOIN step{_NEWTON} s ON c.intron_id = s.intron_id AND c.grp = s.grp GROUP BY 1""",
    **_newton(),
)
def glm_fixed_dispersion(spark, d):
    """Coefficients and deviances at a given dispersion, of introns with reads enough in both groups."""
    cells = psi.grouped(A.totals(spark, d), A.metadata(spark))
    kept = cells.groupBy("intron_id", "group").agg(F.sum("count").alias("n")).groupBy("intron_id").agg(F.min("n").alias("n")).where("n >= 100")
    found = glm.fixed(cells.join(kept.select("intron_id"), "intron_id", "left_semi"), _meta(), _PHI)
    return found.select("intron_id", F.round(F.col("coefficients")[0], 5).alias("beta_a"), F.round(F.col("coefficients")[1], 5).alias("beta_b"), F.round("deviance", 5).alias("deviance"))


@query()
def glm_ql_test(spark, d):
    return glm.test(A.totals(spark, d), _meta(), ["A-B"])


@query()
def glm_pooled_controls(spark, d):
    return glm.test(A.totals(spark, d), _meta(pooled=True), ["A-B,C", "B-C"])


@query()
def glm_batch(spark, d):
    return glm.test(A.totals(spark, d), _meta(batch=True), ["A-B"], batch="batch")
