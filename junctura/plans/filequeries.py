"""Registered queries that go through files: rows are written, read again by the engine's readers, and compared as SQL says.

Files lie below the session's checkpoint folder, which all executors share.
"""

from __future__ import annotations

import uuid
import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from junctura.checkpoints import checkpoint_folder
from junctura.operators import annotate, clusters, clusterstats, counts, filters, psi
from junctura.plans import adapter as A
from junctura.plans import queries as Q
from junctura.plans.pipeline import NOTES, noted, read_clustered, write_model_input
from junctura.sources import annotation, bam, readers, writers


_SIDE = "SELECT intron_id, avg(psi) FILTER (WHERE grp = 'A') AS mean_a, avg(psi) FILTER (WHERE grp = 'B') AS mean_b FROM psi GROUP BY 1"
_STATS_OF = 'round(mean_a, 9) AS "A_mean_PSI", round(mean_b, 9) AS "B_mean_PSI"'


def _place(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_folder(spark)}/files-{uuid.uuid4().hex}/{name}"


def _lines(*parts: Column | str) -> Column:
    return F.concat_ws("\t", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _text(lines: DataFrame, path: str) -> str:
    """Lines (ord, value) in files one after another, in their order."""
    lines.repartitionByRange("ord").sortWithinPartitions("ord").select("value").write.text(path)
    return path


@Q.query("SELECT intron_id, sample_id, count FROM cell")
def file_junctions(spark, d):
    path = _place(spark, "junctions")
    writers.write_junctions(A.junctions(spark, d), path)
    return counts.sum_junctions(readers.read_junctions(spark, path))


@Q.query("SELECT intron_id, sample_id, count FROM dense")
def file_matrix(spark, d):
    path = _place(spark, "matrix")
    writers.write_wide(A.cells(spark, d), A.SAMPLES, path)
    return readers.read_cells(spark, path)


@Q.query('SELECT intron_id, contrast, "PValue", "logFC", gene_name, cluster FROM result')
def file_results(spark, d):
    path = _place(spark, "run")
    writers.write_results(A.results(spark, d).withColumn("significant", F.col("PValue") < 0.01), path)
    return readers.read_results(spark, f"{path}.intron_results").select("intron_id", "contrast", "PValue", "logFC", "gene_name", "cluster")


@Q.query('SELECT intron_id, contrast, "PValue" FROM result WHERE "PValue" < 0.01')
def file_significant(spark, d):
    path = _place(spark, "run")
    writers.write_results(A.results(spark, d).withColumn("significant", F.col("PValue") < 0.01), path)
    return readers.read_results(spark, f"{path}.significant_introns").select("intron_id", "contrast", "PValue")


@Q.query("SELECT contrast, count(*) AS n, count(\"PValue\") AS n_tested FROM result GROUP BY 1")
def file_by_contrast(spark, d):
    path = _place(spark, "by_contrast")
    writers.write_by_contrast(A.results(spark, d), path)
    rows = readers.read_results(spark, path)
    return rows.where("file = contrast").groupBy("contrast").agg(F.count("*").alias("n"), F.count("PValue").alias("n_tested"))


@Q.query(
    "SELECT 's' || s_suppkey AS sample_id, CASE WHEN s_suppkey % 4 <> 0 THEN 'g' || s_nationkey END AS \"group\", CASE WHEN s_suppkey % 4 <> 0 AND s_suppkey % 3 = 0 THEN 'b' || s_suppkey % 2 END AS batch FROM supplier"
)
def file_metadata(spark, d):
    k = F.col("s_suppkey")
    head = spark.createDataFrame([(-3, "# samples of a study"), (-2, ""), (-1, "sample_id\tgroup\tbatch")], "ord long, value string")
    # Short rows, NA, and marks of comments at a line's end.
    short = F.concat(F.lit("s"), k)
    batch = F.when(k % 3 == 0, F.concat(F.lit("b"), k % 2)).otherwise("NA")
    full = F.concat_ws("\t", short, F.concat(F.lit("g"), "s_nationkey"), batch)
    line = F.concat(F.when(k % 4 == 0, short).otherwise(full), F.when(k % 5 == 0, " # left by hand").otherwise(""))
    rows = A.table(spark, d, "supplier").select(k.alias("ord"), line.alias("value"))
    return readers.read_metadata(spark, _text(head.union(rows), _place(spark, "samples")))


def _gtf(spark: SparkSession, d: str) -> str:
    """Genes and exons as GTF, with rows of other kinds between them."""
    text = lambda key, value: F.concat(F.lit(f'{key} "'), value, F.lit('";'))
    gene = A.genes(spark, d).select((2 * F.col("ord")).alias("ord"), _lines(F.col("chrom"), "made", "gene", F.col("start"), F.col("end"), ".", F.col("strand"), ".", text("gene_id", F.col("gene_name"))).alias("value"))
    named = F.concat_ws(" ", text("gene_id", F.col("gene_name")), text("transcript_id", F.col("transcript_id")))
    exon = A.exons(spark, d)
    kind = lambda k: _lines(F.col("chrom"), "made", k, F.col("start"), F.col("end"), ".", F.col("strand"), ".", named)
    after = 1 << 40
    rows = exon.select(F.explode(F.array(*[F.struct((after + 2 * F.col("ord") + i).alias("ord"), kind(k).alias("value")) for i, k in enumerate(("exon", "CDS"))])).alias("r")).select("r.*")
    head = spark.createDataFrame([(-1, "#!made from tables")], "ord long, value string")
    return _text(head.union(gene).union(rows), _place(spark, "genes.gtf"))


@Q.query('SELECT chrom, "start", "end", strand, transcript_id, gene_name FROM exon_intron')
def file_gtf(spark, d):
    return annotate.exon_introns(annotate.exons(annotate.features(readers.read_gtf(spark, _gtf(spark, d)))))


@Q.query("SELECT intron_id, gene_name, intron_status, overlapping_genes FROM annotated")
def file_annotation_cache(spark, d):
    gtf, cache = _gtf(spark, d), _place(spark, "annotation")
    annotation.load(spark, gtf, cache)
    kept = annotation.load(spark, gtf, cache)  # the second time from the tables
    found = annotate.annotate(A.cells(spark, d).select("intron_id").distinct(), *kept)
    return found.select("intron_id", "gene_name", "intron_status", "overlapping_genes")


@Q.query("""SELECT 'intron' AS kind, chrom, "start", "end", strand, array_to_string(genes, ',') AS told FROM intron_gene
    UNION ALL SELECT 'gene', chrom, "start", "end", strand, gene_name || '/' || gene_name FROM gene_at""")
def file_annotation_text(spark, d):
    """The cache as one text of two sections, made from a GTF."""
    cache = _place(spark, "genes.intron_cache.tsv")
    annotation.load_text(spark, _gtf(spark, d), cache)
    introns, genes = annotation.read_cache(spark, cache)
    one = introns.select(F.lit("intron").alias("kind"), *annotate.PLACE, F.concat_ws(",", "genes").alias("told"))
    return one.union(genes.select(F.lit("gene"), *annotate.PLACE, F.concat("gene_id", F.lit("/"), "gene_name")))


@Q.query(
    'SELECT sample_id, chrom, "start", "end", count(*) AS count FROM gap GROUP BY ALL',
    **Q.SAM,
)
def file_sam(spark, d):
    path = _place(spark, "sam")
    r = F.col
    line = _lines(r("name"), r("flag"), r("chrom"), r("pos"), r("mapq"), r("cigar"), "*", "0", "0", "*", "*")
    Q.alignments(spark, d).withColumn("name", F.concat(F.lit("r"), "pos")).select("sample_id", line.alias("value")).write.partitionBy("sample_id").text(path)
    return counts.count_junctions(readers.read_sam(spark, path))


@Q.query(
    'SELECT sample_id, chrom, "start", "end", count(*) AS count FROM gap GROUP BY ALL',
    **Q.SAM,
)
def file_bam(spark, d):
    """BAM files of many tasks, each read by as many as it has parts."""
    path = _place(spark, "bam")
    bam.write_bam(Q.alignments(spark, d), path, {f"chr{i}{alt}": 1 << 20 for i in range(5) for alt in ("", "_alt")})
    return counts.count_junctions(bam.read_bam(spark, [path], counts.MAPPING_QUALITY, counts.LEFT_OUT, gapped=True, part=1 << 12))


def _fasta(spark: SparkSession, d: str) -> str:
    """The genome in lines of 60 bases, none of them a row of more."""
    path = _place(spark, "genome.fa")
    Q.genome_lines(spark, d).write.text(path)
    return path


@Q.query("SELECT chrom, k AS tile, md5(substr(seq, k * 4096 + 1, 4097)) AS digest FROM genome, unnest(range(0, (length(seq) + 4095) // 4096)) AS t(k)", genome=Q.GENOME)
def file_fasta(spark, d):
    cut = readers.read_tiles(spark, _fasta(spark, d), 4096)
    return cut.select("chrom", F.col("tile").cast("long").alias("tile"), F.md5("bases").alias("digest"))


@Q.query(Q.NAMING, genome=Q.GENOME, site=Q.SITE)
def file_junction_naming(spark, d):
    """Junctions named from a file of sequences."""
    return counts.name_junctions(Q.sites(spark, d), readers.read_tiles(spark, _fasta(spark, d), 4096), tile=4096)


def _offsets(spark: SparkSession, d: str) -> str:
    """Shared totals of all introns as a file."""
    path = _place(spark, "offsets")
    writers.write_wide(A.totals(spark, d), A.SAMPLES, path, "shared_total", absent="NA")
    return path


@Q.query("SELECT intron_id, sample_id, CAST(shared_total AS DOUBLE) AS shared_total FROM total")
def file_offsets(spark, d):
    return readers.read_cells(spark, _offsets(spark, d), value="shared_total", kind="double")


_MODEL = 'SELECT intron_id, sample_id, count, round(ln(shared_total + 0.5::DOUBLE), 9) AS "offset", chrom, "start", "end", strand, splice_pair, flag, donor_cluster, acceptor_cluster FROM total WHERE flag = \'OK\''


@Q.query(_MODEL)
def file_model_input(spark, d):
    """Counts, log offsets and annotations of the cells that a filter leaves, the totals taken from the file."""
    path = _place(spark, "model")
    # Dense cells go into the totals and the model's input, the latter's cells into three files.
    dense = writers.save_stage(A.dense(spark, d), path, "dense")
    writers.write_wide(clusters.add_totals(dense), A.SAMPLES, f"{path}/offsets", "shared_total", absent="NA")
    table = readers.read_cells(spark, f"{path}/offsets", value="shared_total", kind="double")
    cells = writers.save_stage(clusters.with_totals(dense.where("flag = 'OK'"), table), path, "cells")
    write_model_input(cells, A.SAMPLES, path)
    offset = readers.read_cells(spark, f"{path}_offsets", value="offset", kind="double")
    found = readers.read_cells(spark, f"{path}_counts").join(offset, ["intron_id", "sample_id"]).join(readers.read_table(spark, f"{path}_annotations"), "intron_id")
    places = [F.col(c).cast("long").alias(c) for c in ("start", "end")]
    return found.select("intron_id", "sample_id", "count", Q.r9("offset").alias("offset"), "chrom", *places, "strand", "splice_pair", "flag", "donor_cluster", "acceptor_cluster")


@Q.query("SELECT intron_id, sample_id, count, donor_cluster, acceptor_cluster FROM dense")
def file_clustered_matrix(spark, d):
    """A clustered matrix, read with the clusters that it holds."""
    path = _place(spark, "clustered")
    cells = A.dense(spark, d)
    writers.write_wide(cells, A.SAMPLES, path, **noted(cells))
    return readers.read_cells(spark, path, other=clusters.CLUSTERS).select("intron_id", "sample_id", "count", *clusters.CLUSTERS)


@Q.query("SELECT intron_id, sample_id, count, donor_cluster, acceptor_cluster FROM kept")
def file_filtered_matrix(spark, d):
    path = _place(spark, "filtered")
    cells = counts.unpacked(filters.chain(A.packed(spark, d), **A.LIMITS), A.SAMPLES)
    writers.write_wide(cells, A.SAMPLES, path, **noted(cells))
    return read_clustered(spark, path).select("intron_id", "sample_id", "count", *clusters.CLUSTERS)


@Q.query("SELECT intron_id, sample_id, count, gene_name, intron_status, overlapping_genes FROM dense JOIN annotated USING (intron_id)")
def file_annotated_matrix(spark, d):
    path = _place(spark, "annotated")
    introns = A.packed(spark, d)
    notes = Q.annotated(spark, d, introns).select("intron_id", *NOTES[2:])
    # Notes meet introns before these are taken apart, a row an intron.
    cells = counts.unpacked(introns.join(notes, "intron_id"), A.SAMPLES)
    writers.write_wide(cells, A.SAMPLES, path, **noted(cells))
    return read_clustered(spark, path).select("intron_id", "sample_id", "count", *NOTES[2:])


@Q.query(
    f'SELECT r.intron_id, contrast, "PValue", "logFC", {_STATS_OF}, round(mean_a - mean_b, 9) AS "delta_PSI" FROM result r JOIN side USING (intron_id)', side=_SIDE,
)
def file_results_with_psi(spark, d):
    """Results with the summaries of PSI, without those of samples."""
    path = _place(spark, "with_psi")
    table = psi.psi_table(psi.psi_values(A.totals(spark, d)), A.metadata(spark), A.SAMPLES)
    writers.write_results(psi.with_psi(A.results(spark, d).withColumn("significant", F.lit(False)), table), path)
    found = readers.read_results(spark, f"{path}.intron_results")
    return found.select("intron_id", "contrast", "PValue", "logFC", *[Q.r9(c).alias(c) for c in ("A_mean_PSI", "B_mean_PSI", "delta_PSI")])


@Q.query('SELECT contrast, cluster, n_introns, n_significant_introns, dominant_direction, round(log10(cluster_pvalue), 8) AS log10_p FROM with_fdr', **Q.AGG)
def file_clusters(spark, d):
    path = _place(spark, "clusters")
    writers.write_tsv(Q.aggregated(spark, d).orderBy(F.asc_nulls_last("cluster_pvalue")), path)
    found = readers.read_results(spark, path)
    counted = [F.col(c).cast("long").alias(c) for c in ("n_introns", "n_significant_introns")]
    return found.select("contrast", "cluster", *counted, "dominant_direction", Q.log10p(F.col("cluster_pvalue")).alias("log10_p"))


@Q.query('SELECT intron_id, contrast, tested_in, significant_in, best_analysis, "best_FDR", "donor_PValue", "acceptor_PValue" FROM judged', **Q.SIDES)
def file_integrated(spark, d):
    path = _place(spark, "integrated")
    writers.write_tsv(Q.integrated(spark, d).orderBy("contrast", "best_FDR"), path)
    return readers.read_results(spark, path).select("intron_id", "contrast", "tested_in", "significant_in", "best_analysis", "best_FDR", "donor_PValue", "acceptor_PValue")


def _descents(rows: DataFrame, kind: str, *keys: str) -> DataFrame:
    """Lines of a file, and how many of them come before where a sort by ``keys``, nulls last, has them."""
    place = F.struct(*[x for k in keys for x in (F.col(k).isNull(), F.col(k))]).alias("k")
    seen = rows.select(place, readers.in_order().alias("ord"))
    within = seen.withColumn("falls", F.lag("k").over(Window.partitionBy("ord.path", "ord.start").orderBy("ord")) > F.col("k"))
    parts = within.groupBy("ord.path", "ord.start").agg(F.count("*").alias("n"), F.count_if("falls").alias("falls"), F.min("k").alias("low"), F.max("k").alias("high"))
    before = F.max("high").over(Window.orderBy("path", "start").rowsBetween(Window.unboundedPreceding, -1))  # a row a split
    return parts.withColumn("between", before > F.col("low")).agg(F.sum("n").alias("n_lines"), (F.sum("falls") + F.count_if("between")).alias("n_descents")).select(F.lit(kind).alias("kind"), "n_lines", "n_descents")


@Q.query(
    """SELECT 'results' AS kind, count(*) AS n_lines, 0::BIGINT AS n_descents FROM result UNION ALL SELECT 'clusters', count(*), 0 FROM with_fdr
    UNION ALL SELECT 'cluster_introns', count(*), 0 FROM tested t JOIN with_fdr c ON t.contrast = c.contrast AND t.cluster = c.cluster WHERE c.fdr < 0.05
    UNION ALL SELECT 'integrated', count(*), 0 FROM judged""",
    **Q.AGG, **{k: v for k, v in Q.SIDES.items() if k not in Q.AGG},
)
def file_orders(spark, d):
    """Files of results, clusters, introns of significant clusters and integrated results are in their orders from line to line."""
    place = _place(spark, "orders")
    writers.write_results(A.results(spark, d).withColumn("significant", F.lit(False)), f"{place}/results")
    found = Q.aggregated(spark, d).withColumn("key", F.concat_ws("/", "contrast", "cluster"))
    writers.write_tsv(found.orderBy(F.asc_nulls_last("cluster_pvalue")), f"{place}/clusters")
    rows = Q.tested(spark, d).withColumn("key", F.concat_ws("/", "contrast", "cluster"))
    writers.write_tsv(clusterstats.significant_cluster_introns(rows, found, "key").orderBy("cluster_FDR", F.asc_nulls_last("PValue")), f"{place}/introns")
    writers.write_tsv(Q.integrated(spark, d).orderBy("contrast", F.asc_nulls_last("best_FDR")), f"{place}/integrated")
    read = lambda name: readers.read_results(spark, f"{place}/{name}")
    out = [_descents(read("results.intron_results"), "results", "PValue"), _descents(read("clusters"), "clusters", "cluster_pvalue")]
    out += [_descents(read("introns"), "cluster_introns", "cluster_FDR", "PValue"), _descents(read("integrated"), "integrated", "contrast", "best_FDR")]
    return out[0].union(out[1]).union(out[2]).union(out[3])


@Q.query("SELECT contrast, count(*) AS n, count(gene_name) AS n_named FROM result GROUP BY 1")
def file_combined(spark, d):
    """Tables of single contrasts, one without a column and one that is absent, put together by name."""
    place, rows = _place(spark, "combined"), A.results(spark, d).select("intron_id", "contrast", "PValue", "gene_name")
    writers.write_tsv(rows.where("contrast = 'A_vs_B'").drop("gene_name"), f"{place}/one")
    writers.write_tsv(rows.where("contrast = 'A_vs_C'"), f"{place}/two")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        found = readers.read_combined(spark, [f"{place}/{n}" for n in ("one", "absent", "two")])
    named = rows.where("contrast = 'A_vs_B'").select("intron_id", "contrast", F.col("gene_name").alias("__name"))
    found = found.join(named, ["intron_id", "contrast"], "left").withColumn("gene_name", F.coalesce("gene_name", "__name"))
    return found.groupBy("contrast").agg(F.count("*").alias("n"), F.count("gene_name").alias("n_named"))


_VALUES = ", ".join(f"round(max(psi) FILTER (WHERE sample_id = '{s}'), 9) AS \"{s}_PSI\"" for s in A.SAMPLES)
_STATS = ", ".join(
    f"round({f}(psi) FILTER (WHERE grp = '{g}'), 9) AS \"{g}_{n}_PSI\"" for g in ("A", "B") for f, n in (("avg", "mean"), ("median", "median"), ("stddev_samp", "std"))
)


@Q.query(f"SELECT intron_id, {_VALUES}, {_STATS}, round(avg(psi) FILTER (WHERE grp = 'A') - avg(psi) FILTER (WHERE grp = 'B'), 9) AS \"delta_PSI\" FROM psi GROUP BY 1")
def file_psi_values(spark, d):
    path = _place(spark, "psi")
    writers.write_tsv(psi.psi_table(psi.psi_values(A.totals(spark, d)), A.metadata(spark), A.SAMPLES), path)
    table = readers.read_table(spark, path)
    return table.select("intron_id", *[Q.r9(c).alias(c) for c in table.columns[1:]])
