"""The whole analysis as one plan: matrix and samples in, results with PSI out."""

from __future__ import annotations

import hashlib
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from junctura.operators import annotate, clusters, counts, fdr, filters, glm, plots, psi, samples
from junctura.sources import annotation, files, readers, writers


@dataclass(frozen=True)
class Parameters:
    """Settings of a run, with their defaults."""

    min_intron_count: int = 10
    min_intron_samples: int = 2
    min_cluster_count: int = 20
    min_cluster_samples: int = 3
    keep_noncanonical: bool = False
    cluster_type: str = "both"
    group_col: str = "group"
    batch_col: str | None = None
    contrast: str | None = None
    control_groups: tuple[str, ...] = field(default=())
    fdr_threshold: float = 0.05
    min_logFC: float = 0.0
    min_delta_psi: float | None = None
    compat: bool = False  # delta_psi as the plain pipeline has it: none with several groups and no contrast

    def __post_init__(self) -> None:
        if self.contrast and self.control_groups:
            raise ValueError("contrast and control_groups exclude each other")


class SpliceEngine:
    """Runs the analysis; stages are written to ``folder`` if one is given, and found again by a later run.

    A stage's name holds a digest of inputs and parameters, so a run with other
    settings doesn't take over what doesn't fit. With ``force`` every stage is
    made and written anew.
    """

    def __init__(self, spark: SparkSession, parameters: Parameters | None = None, folder: str | None = None, force: bool = False) -> None:
        self.spark, self.parameters, self.folder, self.force = spark, parameters or Parameters(), folder, force

    def _stage(self, name: str, key: str, make) -> DataFrame:
        if not self.folder:
            return make()
        name = f"{name}-{hashlib.sha256(f'{key} {sorted(asdict(self.parameters).items())}'.encode()).hexdigest()[:16]}"
        found = None if self.force else writers.saved_stage(self.spark, self.folder, name)
        return found if found is not None else writers.save_stage(make(), self.folder, name)

    def clustered(self, cells: DataFrame, metadata: DataFrame, annotation: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
        """Dense, clustered counts of the samples that both sides name, with shared totals and annotation.

        Totals are those of the whole matrix, before any filter.
        """
        samples.warn_dropped(cells, metadata)
        kept = samples.keep_samples(cells, metadata)
        names = counts.sample_names(kept)
        if not names:
            raise ValueError("matrix and metadata share no sample")
        found = clusters.add_totals(clusters.assign_clusters(counts.densify(kept, names)))
        if annotation is not None:
            found = annotate.annotate(found, *annotation)
        return found

    def filtered(self, clustered: DataFrame) -> DataFrame:
        p = self.parameters
        return filters.chain(clustered, p.min_intron_count, p.min_intron_samples, p.min_cluster_count, p.min_cluster_samples, p.keep_noncanonical, p.cluster_type)

    def contrasts(self, metadata: DataFrame) -> list[str]:
        names = [r.group for r in samples.groups(metadata, self.parameters.group_col).collect()]
        return samples.contrasts(names, self.parameters.contrast, list(self.parameters.control_groups))

    def run(self, cells: DataFrame, metadata: DataFrame, annotation: tuple[DataFrame, DataFrame] | None = None, key: str = "") -> dict[str, DataFrame]:
        """clustered, filtered, psi, results and, with min_delta_psi, psi_filtered."""
        p = self.parameters
        metadata = samples.valid_samples(metadata).withColumn("group", F.col(p.group_col).cast("string"))
        clustered = self._stage("clustered", key, lambda: self.clustered(cells, metadata, annotation))
        filtered = self._stage("filtered", key, lambda: self.filtered(clustered))
        present = metadata.join(filtered.select("sample_id").distinct(), "sample_id", "left_semi")
        local = present.toPandas()  # a row per sample
        wanted = self.contrasts(present)
        values = self._stage("psi", key, lambda: psi.psi_values(filtered))
        fitted: list[glm.Fitted] = []

        def estimate() -> glm.Fitted:
            if not fitted:
                fitted.append(glm.estimate(filtered, local, "group", p.batch_col))
            return fitted[0]

        tested = self._stage("tested", key, lambda: estimate().test(wanted, p.fdr_threshold, p.min_logFC))
        fits = self._stage("fits", key, lambda: estimate().parameters())

        tested = annotate.to_results(tested, filtered)
        if p.compat:
            delta = psi.compatible_delta(values, present, p.contrast)
            results = tested.join(delta, "intron_id", "left") if delta is not None else tested
        else:
            names = sorted(local["group"].unique())
            sides = {samples.contrast_label(c): samples.parse_contrast(c, names) for c in wanted}
            results = tested.join(psi.contrast_deltas(values, present, sides), ["intron_id", "contrast"], "left")
        table = psi.psi_table(values, present, sorted(local["sample_id"]), p.contrast)
        out = {"clustered": clustered, "filtered": filtered, "psi": values, "group_stats": psi.group_stats(values, present), "psi_table": table, "results": results, "fits": fits, "contrasts": wanted}
        if p.min_delta_psi and "delta_psi" in results.columns:
            out["psi_filtered"] = fdr.refilter(results, p.min_delta_psi)
        return out


def input_key(spark: SparkSession, *paths: str | None) -> str:
    """Paths with the length and the time of change of their files, so that a file written anew is another input."""
    return " ".join(f"{p} {files.stamp(spark, p)}" if p else "-" for p in paths)


def run_files(spark: SparkSession, matrix: str, metadata: str, output: str, gtf: str | None = None, parameters: Parameters | None = None, force: bool = False, gtf_cache: str | None = None) -> dict[str, DataFrame]:
    """Read the files, run, and write the tables at the edges as TSV."""
    cells = readers.read_cells(spark, matrix)
    meta = readers.read_metadata(spark, metadata)
    engine = SpliceEngine(spark, parameters, f"{output}/stages", force)
    if gtf and gtf_cache:
        notes = annotation.load_text(spark, gtf, gtf_cache, force)
    else:
        notes = annotation.load(spark, gtf, f"{output}/annotation", force=force) if gtf else None
    found = engine.run(cells, meta, notes, input_key(spark, matrix, metadata, gtf, gtf_cache))
    results, table = found["results"], found["psi_table"]
    writers.write_results(results, f"{output}/results")
    writers.write_results(psi.with_psi(results, table), f"{output}/results_with_psi")
    writers.write_by_contrast(results, f"{output}/results_by_contrast", {samples.contrast_label(c): samples.contrast_file(c) for c in found["contrasts"]})
    kept, whole = found["filtered"], found["clustered"]
    names = counts.sample_names(whole)
    writers.write_wide(whole, names, f"{output}/clustered_matrix", **noted(whole))
    writers.write_wide(kept, names, f"{output}/filtered_matrix", **noted(kept))
    # Totals, not their logarithms, of all introns, also of those that the filters drop.
    writers.write_wide(whole, names, f"{output}/shared_offsets", "shared_total", absent="NA")
    write_model_input(kept, names, f"{output}/model")
    writers.write_tsv(table, f"{output}/psi_values")
    if "psi_filtered" in found:
        writers.write_tsv(psi.with_psi(found["psi_filtered"], table), f"{output}/psi_filtered")
    hits = {"n_significant": F.count_if("significant")}
    shown = {"volcano": (fdr.volcano(results), "logFC", "neg_log10_p", ("contrast",), hits), "mean_difference": (results, "logCPM", "logFC", ("contrast",), hits)}
    points = glm.dispersion_points(found["fits"])
    shown |= {"dispersion": (points, "logCPM", "bcv", (), {"trended_bcv": F.avg("trended_bcv")}), "ql_dispersion": (points, "logCPM", "root_ql_raw", (), {"root_ql_squeezed": F.avg("root_ql_squeezed")})}
    for name, (rows, x, y, by, more) in shown.items():
        writers.write_tsv(plots.hexagons(rows, x, y, by, **more), f"{output}/diagnostics_{name}")
        writers.write_tsv(plots.apart(rows, x, y, by).select(*[c for c in ("intron_id", *by, x, y) if c in rows.columns]), f"{output}/diagnostics_{name}_apart")
    found["fits"].write.mode("overwrite").parquet(f"{output}/fits")
    return found


LEADING = ("gene_name", "intron_status")
NOTES = ("donor_cluster", "acceptor_cluster", "gene_name", "intron_status", "overlapping_genes")


def noted(cells: DataFrame) -> dict[str, tuple[str, ...]]:
    """Where a matrix has its notes: names and status of genes before the samples, the others behind."""
    there = [c for c in NOTES if c in cells.columns]
    return {"leading": tuple(c for c in there if c in LEADING), "noted": tuple(c for c in there if c not in LEADING)}


def read_clustered(spark: SparkSession, path: str, notes: tuple[str, ...] = NOTES[2:]) -> DataFrame:
    """Cells of a matrix with or without clusters, clustered by their identifiers, with those ``notes`` that it has."""
    cells = readers.read_cells(spark, path, other=NOTES)
    return clusters.assign_clusters(cells.select("intron_id", "sample_id", "count", *[n for n in notes if n in cells.columns]))


def write_model_input(cells: DataFrame, names: list[str], prefix: str) -> None:
    """Counts, log offsets and annotations of the introns that are tested."""
    writers.write_wide(cells, names, f"{prefix}_counts")
    writers.write_wide(cells.withColumn("offset", clusters.log_offset()), names, f"{prefix}_offsets", "offset", absent="NA")
    told = [c for c in ("chrom", "start", "end", "strand", "splice_pair", "flag", *NOTES) if c in cells.columns]
    writers.write_tsv(cells.select("intron_id", *told).distinct(), f"{prefix}_annotations")
