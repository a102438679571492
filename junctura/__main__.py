"""Command line: ``python -m junctura {run,count,matrix,cluster,filter,offsets,psi,aggregate,integrate,combine} ...``; without a command, run."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from junctura.operators import annotate as notes
from junctura.operators import clusters, clusterstats, counts, filters, integrate, psi, samples
from junctura.plans.pipeline import Parameters, noted, read_clustered, run_files, write_model_input
from junctura.shipping import ship
from junctura.sources import annotation, bam, readers, writers

COMMANDS = ("run", "count", "matrix", "cluster", "filter", "offsets", "psi", "aggregate", "integrate", "combine")


def _thresholds(parser: argparse.ArgumentParser, base: Parameters) -> None:
    for name in ("min_intron_count", "min_intron_samples", "min_cluster_count", "min_cluster_samples"):
        parser.add_argument(f"--{name}", type=int, default=getattr(base, name))
    parser.add_argument("--keep_noncanonical", action="store_true")
    parser.add_argument("--cluster_type", choices=("donor", "acceptor", "both"), default=base.cluster_type)


def _parser() -> argparse.ArgumentParser:
    told = argparse.ArgumentParser(prog="junctura", description=__doc__)
    sub = told.add_subparsers(dest="command", required=True)

    run = sub.add_parser("run", help="matrix and samples to results")
    for name in ("matrix", "samples", "output_dir"):
        run.add_argument(f"--{name}", required=True)
    run.add_argument("--gtf")
    run.add_argument("--gtf_cache", help="annotation as one text of two sections, made from the GTF where it is absent or older")
    base = Parameters()
    _thresholds(run, base)
    run.add_argument("--group_col", default=base.group_col)
    run.add_argument("--batch_col")
    run.add_argument("--contrast")
    run.add_argument("--control_groups", help="names parted by commas")
    run.add_argument("--fdr_threshold", type=float, default=base.fdr_threshold)
    run.add_argument("--min_logFC", type=float, default=base.min_logFC)
    run.add_argument("--min_delta_psi", type=float)
    run.add_argument("--compat", action="store_true")
    run.add_argument("--force_rerun", action="store_true")

    count = sub.add_parser("count", help="BAM or SAM files to junction files")
    count.add_argument("--genome_fa", required=True)
    count.add_argument("--alignments", nargs="+", required=True)
    count.add_argument("--output", required=True)

    matrix = sub.add_parser("matrix", help="junction files to a wide matrix")
    matrix.add_argument("--intron_files", nargs="+", required=True)
    matrix.add_argument("--output", required=True)

    cluster = sub.add_parser("cluster", help="wide matrix to clustered matrix")
    cluster.add_argument("--matrix", required=True)
    cluster.add_argument("--samples")
    cluster.add_argument("--output", required=True)

    kept = sub.add_parser("filter", help="clustered matrix to filtered matrix")
    kept.add_argument("--matrix", required=True)
    kept.add_argument("--output", required=True)
    _thresholds(kept, base)

    offsets = sub.add_parser("offsets", help="offsets of a matrix, or the model's input with shared or own offsets")
    offsets.add_argument("--matrix", required=True)
    offsets.add_argument("--output")
    offsets.add_argument("--output_prefix")
    offsets.add_argument("--compute_offsets_only", action="store_true")
    offsets.add_argument("--shared_offsets")
    offsets.add_argument("--samples")
    offsets.add_argument("--cluster_type", choices=("donor", "acceptor"))

    psis = sub.add_parser("psi", help="results with PSI of a single kind of cluster")
    for name in ("counts", "annotations", "samples", "results", "output"):
        psis.add_argument(f"--{name}", required=True)
    psis.add_argument("--cluster_col", default="donor_cluster")
    psis.add_argument("--group_col", default=base.group_col)
    psis.add_argument("--contrast")
    psis.add_argument("--keep_individual_samples", action="store_true")

    aggregate = sub.add_parser("aggregate", help="intron results to clusters")
    aggregate.add_argument("--results", required=True)
    aggregate.add_argument("--output", required=True)
    aggregate.add_argument("--cluster_col", default="cluster")
    aggregate.add_argument("--method", choices=tuple(clusterstats.METHODS), default="cauchy")
    aggregate.add_argument("--fdr_threshold", type=float, default=0.05)

    both = sub.add_parser("integrate", help="donor and acceptor results side by side")
    both.add_argument("--donor", required=True)
    both.add_argument("--acceptor", required=True)
    both.add_argument("--output", required=True)
    both.add_argument("--gtf")
    both.add_argument("--fdr_threshold", type=float, help="judge significance by this instead of the results' own column")

    combined = sub.add_parser("combine", help="results of several contrasts to one table")
    combined.add_argument("--results", nargs="+", required=True)
    combined.add_argument("--output", required=True)
    return told


def _offsets(spark: SparkSession, a: dict) -> None:
    """Shared totals alone, from both kinds of cluster; or the model's input, with shared offsets or those of one kind of cluster."""
    if a["compute_offsets_only"] and not a["output"] or not a["compute_offsets_only"] and not a["output_prefix"]:
        raise SystemExit("offsets needs --output with --compute_offsets_only, else --output_prefix")
    if not (a["compute_offsets_only"] or a["shared_offsets"] or a["cluster_type"]):
        raise SystemExit("offsets needs --cluster_type unless --shared_offsets or --compute_offsets_only is given")
    cells = read_clustered(spark, a["matrix"])
    if a["samples"]:
        metadata = readers.read_metadata(spark, a["samples"])
        samples.warn_dropped(cells, metadata)
        cells = samples.keep_samples(cells, metadata)
    names = counts.sample_names(cells)
    if not names:
        raise ValueError("matrix and metadata share no sample")
    if a["shared_offsets"] and not a["compute_offsets_only"]:
        cells = clusters.with_totals(cells, readers.read_cells(spark, a["shared_offsets"], value="shared_total", kind="double"))
    else:
        kinds = clusters.CLUSTERS if a["compute_offsets_only"] else (f"{a['cluster_type']}_cluster",)
        cells = clusters.add_totals(cells, kinds)
    if a["compute_offsets_only"]:
        writers.write_wide(cells, names, a["output"], "shared_total", absent="NA")
    else:
        write_model_input(cells, names, a["output_prefix"])


def _psi(spark: SparkSession, a: dict) -> None:
    notes_of = readers.read_table(spark, a["annotations"]).select("intron_id", F.col(f"`{a['cluster_col']}`").alias("cluster"))
    cells = readers.read_cells(spark, a["counts"]).join(notes_of, "intron_id")
    metadata = samples.valid_samples(readers.read_metadata(spark, a["samples"])).withColumn("group", F.col(f"`{a['group_col']}`").cast("string"))
    table = psi.psi_table(psi.psi_legacy(cells, "cluster"), metadata, counts.sample_names(cells), a["contrast"])
    writers.write_tsv(psi.with_psi(readers.read_results(spark, a["results"]), table, a["keep_individual_samples"]), a["output"])


def main(argv: list[str] | None = None) -> None:
    argv = list(sys.argv[1:] if argv is None else argv)
    if not argv or argv[0] not in COMMANDS and argv[0] not in ("-h", "--help"):
        argv.insert(0, "run")
    a = vars(_parser().parse_args(argv))
    spark, command = SparkSession.builder.getOrCreate(), a.pop("command")
    ship(spark)
    if command == "run":
        matrix, meta, output, gtf, cache, force = (a.pop(k) for k in ("matrix", "samples", "output_dir", "gtf", "gtf_cache", "force_rerun"))
        a["control_groups"] = tuple(samples.listed(a["control_groups"]))
        run_files(spark, matrix, meta, output, gtf, Parameters(**a), force, cache)
    elif command == "count":
        files = a["alignments"]
        bams, sams = [p for p in files if p.endswith(".bam")], [p for p in files if not p.endswith(".bam")]
        parts = [bam.read_bam(spark, bams, counts.MAPPING_QUALITY, counts.LEFT_OUT, gapped=True)] if bams else []
        parts += [readers.read_sam(spark, sams)] if sams else []
        reads = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        named = counts.name_junctions(counts.count_junctions(reads), readers.read_tiles(spark, a["genome_fa"]))
        writers.write_junctions(named, a["output"])
    elif command == "matrix":
        cells = counts.sum_junctions(readers.read_junctions(spark, a["intron_files"]))
        writers.write_wide(cells, counts.sample_names(cells), a["output"])
    elif command == "cluster":
        cells = readers.read_cells(spark, a["matrix"])
        if a["samples"]:
            metadata = readers.read_metadata(spark, a["samples"])
            samples.warn_dropped(cells, metadata)
            cells = samples.keep_samples(cells, metadata)
        names = counts.sample_names(cells)
        if not names:
            raise ValueError("matrix and metadata share no sample")
        found = clusters.assign_clusters(counts.densify(cells, names))
        writers.write_wide(found, names, a["output"], **noted(found))
    elif command == "filter":
        limits = [a[k] for k in ("min_intron_count", "min_intron_samples", "min_cluster_count", "min_cluster_samples", "keep_noncanonical", "cluster_type")]
        cells = filters.chain(read_clustered(spark, a["matrix"]), *limits)
        writers.write_wide(cells, counts.sample_names(cells), a["output"], **noted(cells))
    elif command == "offsets":
        _offsets(spark, a)
    elif command == "psi":
        _psi(spark, a)
    elif command == "combine":
        writers.write_tsv(readers.read_combined(spark, a["results"]), a["output"])
    elif command == "aggregate":
        results = readers.read_results(spark, a["results"])
        found = clusterstats.aggregate_clusters(results, a["method"], a["cluster_col"])
        writers.write_tsv(found.orderBy(F.asc_nulls_last("cluster_pvalue")), f"{a['output']}.clusters")
        hits = clusterstats.significant_cluster_introns(results, found, a["cluster_col"], a["fdr_threshold"])
        writers.write_tsv(hits.orderBy("cluster_FDR", "PValue"), f"{a['output']}.significant_cluster_introns")
        writers.write_tsv(clusterstats.cluster_summary(found, a["fdr_threshold"]), f"{a['output']}.summary")
    else:
        sides = [readers.read_results(spark, a[k]) for k in ("donor", "acceptor")]
        if a["fdr_threshold"] is not None:
            sides = [x.withColumn("significant", F.col("FDR") < a["fdr_threshold"]) for x in sides]
        found = integrate.integrate(*sides)
        if a["gtf"]:
            found = notes.annotate(found, *annotation.load(spark, a["gtf"]))
        order = [c for c in ("contrast", "best_FDR") if c in found.columns]
        writers.write_tsv(found.orderBy(*order), f"{a['output']}.integrated")
        hits = integrate.significant(found)
        if not hits.isEmpty():
            writers.write_tsv(hits.orderBy(*order), f"{a['output']}.significant")
            writers.write_tsv(integrate.summary(found), f"{a['output']}.summary")


if __name__ == "__main__":
    main()
