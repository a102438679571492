"""Readers, writers, the stream, and the pipeline on files."""

import gzip
import struct

import numpy as np
import pytest

from junctura.operators import counts
from junctura.plans.pipeline import Parameters, SpliceEngine, input_key, run_files
from junctura.sources import annotation, bam, readers, writers
from junctura.streaming import junctions

HEAD = "intron\tsplice_pair\tsplice_flag\tcount\n"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j/s1.introns.tsv").write_text(f"{HEAD}chr1:5-9\tGT--AG\tOK\t3\nchr1:5-9\tGT--AG\tOK\t4\n")
    with gzip.open(tmp_path / "j/s2.introns.tsv.gz", "wt") as f:
        f.write(f"{HEAD}chr1:5-9\tGT--AG\tOK\t1\nchr2:1-4\tAA--TT\tNON\t2\n")
    return tmp_path


CELLS = {("chr1:5-9^GT--AG^OK", "s1", 7), ("chr1:5-9^GT--AG^OK", "s2", 1), ("chr2:1-4^AA--TT^NON", "s2", 2)}


def test_junction_files(spark, folder):
    got = counts.sum_junctions(readers.read_junctions(spark, str(folder / "j"))).collect()
    assert {tuple(r) for r in got} == CELLS


@pytest.mark.parametrize("name", ["s 1", "a+b", "x%20y", "é=1", "007"])
def test_names_of_samples_survive_files(spark, tmp_path, name):
    (tmp_path / f"{name}.introns.tsv").write_text(f"{HEAD}chr1:5-9\tGT--AG\tOK\t3\n")
    rows = readers.read_junctions(spark, str(tmp_path / "*.tsv"))
    assert [tuple(r) for r in rows.collect()] == [(name, "chr1:5-9", "GT--AG", "OK", 3)]
    writers.write_junctions(rows, str(tmp_path / "dealt"))
    assert readers.read_junctions(spark, str(tmp_path / "dealt")).collect() == rows.collect()


def test_junction_files_go_by_their_own_headers(spark, tmp_path):
    (tmp_path / "s1.tsv").write_text("count\tnote\tsplice_flag\tintron\tsplice_pair\n7\tx\tOK\tchr1:5-9\tGT--AG\n")
    (tmp_path / "s2.tsv").write_text(f"{HEAD}chr1:5-9\tGT--AG\tOK\t1\n")
    got = counts.sum_junctions(readers.read_junctions(spark, str(tmp_path / "*.tsv"))).collect()
    assert {tuple(r) for r in got} == {("chr1:5-9^GT--AG^OK", "s1", 7), ("chr1:5-9^GT--AG^OK", "s2", 1)}
    (tmp_path / "s3.tsv").write_text("intron\tcount\nchr1:5-9\t1\n")
    with pytest.raises(ValueError, match="without splice_pair, splice_flag"):
        readers.read_junctions(spark, str(tmp_path / "*.tsv"))


def test_matrix_of_many_samples(spark, tmp_path):
    names = [f"s.{i}-x" for i in range(20_000)]
    rows = [(f"chr1:{k}-9^GT--AG^OK", names[i], k * i) for k in range(1, 4) for i in range(0, 20_000, k)]
    cells = spark.createDataFrame(rows, "intron_id string, sample_id string, count long")
    writers.write_wide(cells, names, str(tmp_path / "wide"))
    got = readers.read_cells(spark, str(tmp_path / "wide"))
    assert got.count() == 60_000
    assert sorted(tuple(r) for r in got.where("count > 0").collect()) == sorted(r for r in rows if r[2])


def test_wide_lines_have_gaps_nulls_and_notes(spark, tmp_path):
    rows = [("i1", "b", 2, "x"), ("i1", "d", None, "x"), ("i2", "a", 1, None), ("i2", "a", 1, None), ("i3", "d", 4, "y z")]
    cells = spark.createDataFrame(rows, "intron_id string, sample_id string, count long, note string")
    writers.write_wide(cells, ["a", "b", "c", "d"], str(tmp_path / "w"), noted=("note",))
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "w")).distinct().collect())
    assert lines == ["i1\t0\t2\t0\tNA\tx", "i2\t1\t0\t0\t0\tNA", "i3\t0\t0\t0\t4\ty z", "intron_id\ta\tb\tc\td\tnote"]
    got = readers.read_cells(spark, str(tmp_path / "w"), other=("note",)).where("sample_id = 'd'").orderBy("intron_id").collect()
    assert [tuple(r) for r in got] == [("i1", "x", "d", None), ("i2", None, "d", 0), ("i3", "y z", "d", 4)]


def test_junction_stream(spark, folder):
    query = junctions.write_cells(junctions.cell_stream(spark, str(folder / "j")), str(folder / "out"), str(folder / "check"))
    query.awaitTermination(120)
    assert {tuple(r) for r in junctions.read_cells(spark, str(folder / "out")).collect()} == CELLS
    # More files later: only the cells that they change are written.
    (folder / "j/s1.more.tsv").write_text(f"{HEAD}chr1:5-9\tGT--AG\tOK\t10\n")
    junctions.write_cells(junctions.cell_stream(spark, str(folder / "j")), str(folder / "out"), str(folder / "check")).awaitTermination(120)
    later = {tuple(r) for r in junctions.read_cells(spark, str(folder / "out")).collect()}
    assert later == CELLS - {("chr1:5-9^GT--AG^OK", "s1", 7)} | {("chr1:5-9^GT--AG^OK", "s1", 17)}
    assert spark.read.parquet(str(folder / "out/batch=1")).count() == 1
    (folder / "j/s3.tsv").write_text(f"{HEAD}chr1:5-9\tGT--AG\tOK\t5\n")
    junctions.write_cells(junctions.cell_stream(spark, str(folder / "j")), str(folder / "out"), str(folder / "check")).awaitTermination(120)
    junctions.compact(spark, str(folder / "out"))
    assert {tuple(r) for r in junctions.read_cells(spark, str(folder / "out")).collect()} == later | {("chr1:5-9^GT--AG^OK", "s3", 5)}
    assert sorted(p.name for p in (folder / "out").iterdir() if p.name.startswith("batch")) == ["batch=1", "batch=2"]


def test_metadata_comments_cut_lines(spark, tmp_path):
    path = tmp_path / "m.tsv"
    path.write_text("# about\nsample_id\tgroup\tbatch\n\nA\tx\t1\nB#no\tx\nC\ty # late\n")
    got = [tuple(r) for r in readers.read_metadata(spark, str(path)).collect()]
    assert got == [("A", "x", "1"), ("B", None, None), ("C", "y", None)]


def test_sam_and_fasta(spark, tmp_path):
    (tmp_path / "s1.sam").write_text("@HD\tVN\nr1\t0\tchr1\t3\t60\t2M6N2M\t*\nr2\t256\tchr1\t3\t60\t2M6N2M\t*\nr3\t0\tchr1\t3\t20\t2M6N2M\t*\n")
    (tmp_path / "g.fa").write_text(">chr1 first\nACACGTAA\nAGGG\n>chr2\nAC\n")
    sam = counts.count_junctions(readers.read_sam(spark, str(tmp_path / "s1.sam")))
    named = counts.name_junctions(sam, readers.read_tiles(spark, str(tmp_path / "g.fa"))).collect()
    assert [tuple(r) for r in named] == [("s1", "chr1:5-10", "GT--AG", "OK", 1)]


def test_gtf_and_na(spark, tmp_path):
    (tmp_path / "a.gtf").write_text('#c\nchr1\tx\tgene\t1\t9\t.\t+\t.\tgene_id "g1"; tag "a"; tag "b";\nchr1\tshort\n')
    rows = readers.read_gtf(spark, str(tmp_path / "a.gtf")).collect()
    assert [(r.chrom, r.start, r.attributes) for r in rows] == [("chr1", 1, 'gene_id "g1"; tag "a"; tag "b";')]
    writers.write_tsv(spark.createDataFrame([(1, None)], "a int, b string"), str(tmp_path / "t"))
    assert [tuple(r) for r in readers.read_results(spark, str(tmp_path / "t")).collect()] == [(1, None)]


def test_pipeline_resumes(spark, tmp_path):
    lines = ["\tA1\tA2\tA3\tB1\tB2\tB3"]
    for i in range(30):
        lines.append(f"chr1:{100 + 1000 * i}-{900 + 1000 * i}^GT--AG^OK\t" + "\t".join(str(30 + (i * 7 + k * 11) % 23) for k in range(6)))
        lines.append(f"chr1:{100 + 1000 * i}-{800 + 1000 * i}^GT--AG^OK\t" + "\t".join(str(20 + (i * 5 + k * 3) % 19 + (40 if k < 3 and i < 5 else 0)) for k in range(6)))
    (tmp_path / "m.tsv").write_text("\n".join(lines) + "\n")
    (tmp_path / "s.tsv").write_text("sample_id\tgroup\n" + "".join(f"{g}{k}\t{g}\n" for g in "AB" for k in (1, 2, 3)) + "C1\tC\n")
    found = run_files(spark, str(tmp_path / "m.tsv"), str(tmp_path / "s.tsv"), str(tmp_path / "out"), parameters=Parameters(min_delta_psi=0.05))
    results = found["results"].toPandas()
    read = lambda name: readers.read_results(spark, str(tmp_path / "out" / name))
    assert read("clustered_matrix").columns == ["intron_id", "A1", "A2", "A3", "B1", "B2", "B3", "donor_cluster", "acceptor_cluster"]
    assert read("shared_offsets").count() == read("clustered_matrix").count() == 60 and read("model_counts").count() == read("filtered_matrix").count()
    assert {"A_mean_PSI", "B_std_PSI", "delta_PSI", "A1_PSI"} <= set(read("psi_values").columns) and "A_median_PSI" in read("results_with_psi.intron_results").columns
    assert read("results_by_contrast/file=A_vs_B").count() == 60 and "trended_bcv" in read("diagnostics_dispersion").columns
    assert read("diagnostics_mean_difference").agg({"n": "sum"}).first()[0] == 60 and "bcv" in read("diagnostics_dispersion_apart").columns
    assert len(results) == 60 and set(results["contrast"]) == {"A_vs_B"}
    assert (found["psi_filtered"].toPandas()["delta_psi"].abs() >= 0.05).all()
    engine = SpliceEngine(spark, Parameters(min_delta_psi=0.05), f"{tmp_path}/out/stages")
    cells = readers.read_cells(spark, str(tmp_path / "m.tsv"))
    key = input_key(spark, f"{tmp_path}/m.tsv", f"{tmp_path}/s.tsv", None, None)
    engine._stage("psi", key, lambda: pytest.fail("the stage was there"))
    (tmp_path / "m.tsv").write_text("\n".join(lines) + "\n\n")  # written anew, so nothing of it is taken over
    with pytest.raises(RuntimeError, match="made again"):
        engine._stage("psi", input_key(spark, f"{tmp_path}/m.tsv", f"{tmp_path}/s.tsv", None, None), again)
    with pytest.raises(RuntimeError, match="made again"):
        SpliceEngine(spark, Parameters(min_delta_psi=0.05), f"{tmp_path}/out/stages", force=True)._stage("psi", key, again)
    assert cells.count() == 360


def again():
    raise RuntimeError("made again")


@pytest.mark.parametrize("split", [40, 1 << 20])
def test_annotation_text(spark, tmp_path, split):
    introns = spark.createDataFrame([("chr2", 5, 9, "-", ["g2", "g1"]), ("chr1", 100, 200, "+", []), ("chr1", 20, 30, "+", ["g1"])], "chrom string, start long, end long, strand string, genes array<string>")
    genes = spark.createDataFrame([("chr1", 10, 300, "+", "ENS1", "g1"), ("chr1", 9, 300, "+", "ENS2", "g2")], "chrom string, start long, end long, strand string, gene_id string, gene_name string")
    annotation.write_cache(introns, genes, str(tmp_path / "cache.tsv"))
    lines = "".join(p.read_text() for p in sorted((tmp_path / "cache.tsv").glob("part-*"))).splitlines()
    assert [x for x in lines if not x.startswith("##")] == [
        "chr\tstart\tend\tstrand\tgene_names", "chr1\t20\t30\t+\tg1", "chr1\t100\t200\t+\t.", "chr2\t5\t9\t-\tg1,g2",
        "chr\tstart\tend\tstrand\tgene_id\tgene_name", "chr1\t9\t300\t+\tENS2\tg2", "chr1\t10\t300\t+\tENS1\tg1",
    ]
    (tmp_path / "one.tsv").write_text("\n".join(lines) + "\n")
    key, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set(key, str(split))
        for path in ("cache.tsv", "one.tsv"):
            one, two = annotation.read_cache(spark, str(tmp_path / path))
            assert sorted((r.chrom, r.start, r.end, r.strand, sorted(r.genes)) for r in one.collect()) == sorted((r.chrom, r.start, r.end, r.strand, sorted(r.genes)) for r in introns.collect())
            assert sorted(map(tuple, two.collect())) == sorted(map(tuple, genes.collect()))
    finally:
        spark.conf.set(key, before)


def test_gene_names_do_not_depend_on_how_files_are_split(spark, tmp_path):
    from junctura.operators import annotate

    rows = [f'chr1\tx\tgene\t{10 * (i % 7) + 1}\t{10 * (i % 7) + 9}\t.\t+\t.\tgene_id "g{i}";' for i in range(200)]
    (tmp_path / "genes.gtf").mkdir()
    for k in range(4):
        (tmp_path / f"genes.gtf/part-{k}.gtf").write_text("\n".join(rows[50 * k : 50 * k + 50]) + "\n")
    want = {10 * (i % 7) + 1: f"g{i}" for i in range(200)}
    key, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in (500, 1 << 20):
            spark.conf.set(key, str(split))
            found = annotate.gene_map(annotate.features(readers.read_gtf(spark, str(tmp_path / "genes.gtf"))))
            assert {r.start: r.gene_name for r in found.collect()} == want
    finally:
        spark.conf.set(key, before)


def bam_bytes() -> bytes:
    """A small BAM: two references; a spliced read, a secondary one and an unmapped one."""
    def record(ref: int, pos: int, mapq: int, flag: int, ops: list[tuple[int, str]]) -> bytes:
        packed = b"".join(struct.pack("<I", n << 4 | "MIDNSHP=X".index(k)) for n, k in ops)
        body = struct.pack("<iiBBHHHiiii", ref, pos, 3, mapq, 0, len(ops), flag, 4, -1, -1, 0) + b"r1\0" + packed + b"\0\0" + b"\0" * 4
        return struct.pack("<i", len(body)) + body

    names = b"".join(struct.pack("<i", len(n) + 1) + n + b"\0" + struct.pack("<i", 100) for n in (b"chr1", b"chr2"))
    spliced = [(2, "M"), (6, "N"), (2, "M")]
    return b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", 2) + names + record(0, 2, 60, 0, spliced) + record(0, 2, 60, 256, spliced) + record(-1, -1, 0, 4, [])


def put_bam(path, data: bytes) -> None:
    path.write_bytes(bam._compressed(data) + bam._END)


def test_bam_is_read_like_sam(spark, tmp_path):
    put_bam(tmp_path / "s1.bam", bam_bytes())
    reads = bam.read_bam(spark, [str(tmp_path / "s1.bam"), f"file://{tmp_path}/s1.bam"])
    assert sorted({tuple(r) for r in reads.collect()}) == [("s1", 0, "chr1", 3, 60, "2M6N2M"), ("s1", 4, "*", 0, 0, "*"), ("s1", 256, "chr1", 3, 60, "2M6N2M")]
    assert [(r.chrom, r.start, r.end, r["count"]) for r in counts.count_junctions(reads).collect()] == [("chr1", 5, 10, 2)]
    kept = bam.read_bam(spark, [str(tmp_path)], mapq=60, without=256 | 4, gapped=True)
    assert [tuple(r) for r in kept.collect()] == [("s1", 0, "chr1", 3, 60, "2M6N2M")]
    put_bam(tmp_path / "bad.bam", bam_bytes()[:-3])
    with pytest.raises(Exception, match="cut short"):
        bam.read_bam(spark, [str(tmp_path / "bad.bam")]).collect()
    (tmp_path / "other.bam").write_bytes(b"something else")
    with pytest.raises(Exception, match="not a BAM file"):
        bam.read_bam(spark, [str(tmp_path / "other.bam")]).collect()


def invented_reads(seed, n):
    """Records of all lengths, some much longer than a block, with bases that look like anything."""
    rng = np.random.default_rng(seed)
    out, told = [], []
    for i in range(n):
        ref = int(rng.integers(-1, 2))
        pos, mapq, flag = int(rng.integers(-1, 900)), int(rng.integers(0, 70)), int(rng.choice([0, 4, 16, 256, 1024]))
        ops = [(int(rng.integers(1, 500)), "MIDNSHP=X"[int(rng.integers(0, 9))]) for _ in range(int(rng.integers(0, 6)))]
        bases = int(rng.choice([0, 5, 150, 150, 150, 9000, 200_000], p=[0.1, 0.1, 0.3, 0.2, 0.2, 0.09, 0.01]))
        own = f"read/{i}".encode() + b"\0"
        packed = b"".join(struct.pack("<I", k << 4 | "MIDNSHP=X".index(c)) for k, c in ops)
        body = struct.pack("<iiBBHHHiiii", ref, pos, len(own), mapq, 0, len(ops), flag, bases, -1, -1, 0) + own + packed + rng.integers(0, 256, (bases + 1) // 2 + bases, np.uint8).tobytes()
        out.append(struct.pack("<i", len(body)) + body)
        told.append((flag, ("chrA", "chrB", "*")[ref], pos + 1, mapq, "".join(f"{k}{c}" for k, c in ops) or "*"))
    return bam.bam_header({"chrA": 1000, "chrB": 2000}) + b"".join(out), told


@pytest.mark.parametrize("part", [900, 30_000, 100_000, 1 << 30])
@pytest.mark.parametrize("window", [1 << 12, 1 << 20])
def test_parts_of_a_bam_hold_every_record_once(tmp_path, part, window, monkeypatch):
    monkeypatch.setattr(bam, "WINDOW", window)
    data, told = invented_reads(window % 97, 700)
    put_bam(tmp_path / "s.bam", data)
    size = (tmp_path / "s.bam").stat().st_size
    got = [tuple(r.values())[1:] for at in range(0, size, part) for b in bam.alignments(str(tmp_path / "s.bam"), at, min(size, at + part)) for r in b.to_pylist()]
    assert got == told


def test_bam_of_many_tasks(spark, tmp_path):
    data, told = invented_reads(5, 300)
    put_bam(tmp_path / "s.bam", data)
    reads = bam.read_bam(spark, [str(tmp_path / "s.bam")], part=20_000)
    assert reads.rdd.getNumPartitions() > 10
    assert sorted(tuple(r)[1:] for r in reads.collect()) == sorted(told)
    bam.write_bam(reads.where("chrom <> '*'"), str(tmp_path / "again"), {"chrB": 2000, "chrA": 1000})
    assert sorted(tuple(r)[1:] for r in bam.read_bam(spark, [str(tmp_path / "again")]).collect()) == sorted(t for t in told if t[1] != "*")


@pytest.mark.parametrize("split", [64, 300, 1 << 20])
def test_fasta_in_tiles(spark, tmp_path, split):
    rng = np.random.default_rng(9)
    seqs = {f"c{i}": "".join(rng.choice(list("ACGTN"), n)) for i, n in enumerate((0, 1, 130, 64, 65, 129, 2000, 0, 700))}
    text = "".join(f">{name} about it\n" + "".join(seq[i : i + 60] + "\n" for i in range(0, len(seq), 60)) for name, seq in seqs.items())
    (tmp_path / "g.fa").write_text("lost\n" + text)
    key, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set(key, str(split))
        got = {(r.chrom, r.tile): bytes(r.bases).decode() for r in readers.read_tiles(spark, str(tmp_path / "g.fa"), 64).collect()}
    finally:
        spark.conf.set(key, before)
    assert got == {(n, k): s[64 * k : 64 * k + 65] for n, s in seqs.items() for k in range(max(1, -(-len(s) // 64)))}


def test_annotation_tables_are_kept(spark, tmp_path):
    from junctura.sources import annotation

    gtf = tmp_path / "a.gtf"
    line = 'chr1\tx\texon\t{}\t{}\t.\t+\t.\tgene_id "{}"; transcript_id "t1";\n'
    gtf.write_text(line.format(1, 9, "g1") + line.format(20, 30, "g1"))
    first = annotation.load(spark, str(gtf), str(tmp_path / "cache"))
    assert [(r.start, r.end, r.genes) for r in first[0].collect()] == [(10, 19, ["g1"])]
    gtf.write_text(line.format(1, 9, "g2") + line.format(20, 30, "g2"))
    import os
    import time

    os.utime(gtf, (1, 1))  # older than the tables, so they are used
    assert annotation.load(spark, str(gtf), str(tmp_path / "cache"))[0].first().genes == ["g1"]
    os.utime(gtf, (time.time() + 99, time.time() + 99))
    assert annotation.load(spark, str(gtf), str(tmp_path / "cache"))[0].first().genes == ["g2"]


def test_commands(spark, tmp_path):
    from junctura.__main__ import main

    put_bam(tmp_path / "s1.bam", bam_bytes())
    (tmp_path / "g.fa").write_text(">chr1\nACACGTAAAGGG\n>chr2\nACGT\n")
    main(["count", "--genome_fa", str(tmp_path / "g.fa"), "--alignments", str(tmp_path / "s1.bam"), "--output", str(tmp_path / "counted")])
    assert [tuple(r) for r in spark.read.csv(f"{tmp_path}/counted", sep="\t", header=True).collect()] == [("chr1:5-10", "GT--AG", "OK", "1", "s1")]
    # The files that one command writes are what the next one reads, and keep their sample's name.
    for k, files in enumerate(("counted", "counted/sample_id=s1")):
        main(["matrix", "--intron_files", str(tmp_path / files), "--output", str(tmp_path / f"own{k}")])
        assert readers.read_table(spark, str(tmp_path / f"own{k}")).columns == ["intron_id", "s1"]
    (tmp_path / "x1.tsv").write_text(f"{HEAD}chr1:5-9\tGT--AG\tOK\t3\n")
    main(["matrix", "--intron_files", str(tmp_path / "x1.tsv"), "--output", str(tmp_path / "wide")])
    assert [tuple(r) for r in readers.read_table(spark, str(tmp_path / "wide")).collect()] == [("chr1:5-9^GT--AG^OK", 3)]
    rows = [("i1", "c1", 1.5, 1e-6, 1e-5, True), ("i2", "c1", -1.0, 0.5, 0.6, False), ("i3", "c2", 0.5, 0.9, 0.9, False)]
    results = spark.createDataFrame(rows, "intron_id string, cluster string, logFC double, PValue double, FDR double, significant boolean")
    writers.write_tsv(results, str(tmp_path / "r"))
    main(["aggregate", "--results", str(tmp_path / "r"), "--output", str(tmp_path / "agg"), "--method", "fisher"])
    assert readers.read_results(spark, f"{tmp_path}/agg.clusters").count() == 2
    assert readers.read_results(spark, f"{tmp_path}/agg.significant_cluster_introns").count() == 2
    main(["integrate", "--donor", str(tmp_path / "r"), "--acceptor", str(tmp_path / "r"), "--output", str(tmp_path / "int")])
    assert readers.read_results(spark, f"{tmp_path}/int.significant").count() == 1
    assert readers.read_results(spark, f"{tmp_path}/int.summary").first().tested_both == 3


def test_package_is_shipped_once(spark, monkeypatch):
    from junctura import shipping

    monkeypatch.setattr(shipping, "_SENT", set())
    shipping.ship(spark)
    assert not shipping._SENT  # PYTHONPATH names the folder
    monkeypatch.setenv("PYTHONPATH", "")
    sent = []
    monkeypatch.setattr(spark.sparkContext, "addPyFile", sent.append)
    shipping.ship(spark)
    shipping.ship(spark)
    assert len(sent) == 1 and sent[0].endswith(".zip")
    import zipfile

    assert "junctura/operators/glm.py" in zipfile.ZipFile(sent[0]).namelist()


def test_commands_one_after_another(spark, tmp_path, monkeypatch):
    from junctura import __main__ as command

    monkeypatch.setattr(command, "ship", lambda spark: None)
    at = lambda name: str(tmp_path / name)
    lines = ["\tA1\tA2\tB1\tB2\tX"] + [f"chr1:{100 + 1000 * i}-{900 + 1000 * i + 100 * k}^{'GT--AG^OK' if i else 'AA--TT^NON'}\t{20 + i}\t{30 + k}\t{25 + i * k}\t40\t1" for i in range(5) for k in (0, 1)]
    (tmp_path / "m.tsv").write_text("\n".join(lines) + "\n")
    (tmp_path / "s.tsv").write_text("sample_id\tgroup\nA1\ta\nA2\ta\nB1\tb\nB2\tb\nZ\tb\n")
    with pytest.warns(UserWarning, match="1 samples of the (metadata|matrix) aren't"):
        command.main(["cluster", "--matrix", at("m.tsv"), "--samples", at("s.tsv"), "--output", at("clustered")])
    assert readers.read_table(spark, at("clustered")).columns == ["intron_id", "A1", "A2", "B1", "B2", "donor_cluster", "acceptor_cluster"]
    command.main(["filter", "--matrix", at("clustered"), "--output", at("filtered"), "--min_cluster_count", "10"])
    assert readers.read_table(spark, at("filtered")).count() == 8
    command.main(["offsets", "--matrix", at("clustered"), "--compute_offsets_only", "--output", at("offsets")])
    command.main(["offsets", "--matrix", at("filtered"), "--shared_offsets", at("offsets"), "--output_prefix", at("shared")])
    command.main(["offsets", "--matrix", at("filtered"), "--cluster_type", "donor", "--samples", at("s.tsv"), "--output_prefix", at("own")])
    totals = readers.read_table(spark, at("offsets")).toPandas().set_index("intron_id")
    assert (totals >= 20).all(axis=None) and float(totals.loc["chr1:1100-1900^GT--AG^OK", "A1"]) == 42  # raw, not logarithms
    shared, own = (readers.read_table(spark, at(f"{k}_offsets")).orderBy("intron_id").toPandas() for k in ("shared", "own"))
    assert np.allclose(shared["A1"], np.log(totals["A1"].loc[shared["intron_id"]].to_numpy() + 0.5))
    assert len(shared) == len(own) == 8 and (shared["A1"] >= own["A1"] - 1e-9).all()
    counts_ = readers.read_table(spark, at("shared_counts"))
    counts_.selectExpr("intron_id", "0.01 as PValue", "0.02 as FDR", "1.5 as logFC", "true as significant", "'a_vs_b' as contrast").coalesce(1).write.csv(at("results"), sep="\t", header=True)
    command.main(["psi", "--counts", at("shared_counts"), "--annotations", at("shared_annotations"), "--samples", at("s.tsv"), "--results", at("results"), "--output", at("psi")])
    got = readers.read_results(spark, at("psi"))
    assert {"a_mean_PSI", "b_median_PSI", "delta_PSI"} <= set(got.columns) and "A1_PSI" not in got.columns and got.count() == 8
    assert got.where("abs(delta_PSI - (a_mean_PSI - b_mean_PSI)) > 1e-9").count() == 0
    with pytest.raises(SystemExit):
        command.main(["offsets", "--matrix", at("filtered"), "--output_prefix", at("x")])


def test_a_cluster_needs_a_shared_checkpoint_folder():
    from junctura import checkpoints

    class Context:
        master, folder = "spark://host:7077", None
        getCheckpointDir = lambda self: self.folder
        setCheckpointDir = lambda self, folder: setattr(self, "folder", folder)

    class Session:
        def __init__(self, told):
            self.sparkContext, self.conf = Context(), {"spark.checkpoint.dir": told} if told else {}

    with pytest.raises(RuntimeError):
        checkpoints.checkpoint_folder(Session(None))
    assert checkpoints.checkpoint_folder(Session("hdfs://x/y")) == "hdfs://x/y"


def test_heads_are_found_without_a_sort_of_all_lines(spark, tmp_path):
    head = "count\tsplice_pair\tintron\tsplice_flag"
    for name, lines in (("one.introns", [head, "3\tGT--AG\tchr1:1-9\tOK"]), ("two.introns", ["x\t" + head, "-\t4\tGT--AG\tchr1:1-9\tOK", "intron"])):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    rows = spark.read.text(str(tmp_path)).select("value", readers.in_order().alias("ord"))
    found = readers.likely_heads(rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan
    assert sorted(r.head for r in found.collect() if r.head) == sorted([head, "x\t" + head])
