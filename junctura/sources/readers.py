"""Readers of junction files, matrices, metadata, annotations, alignments and sequences."""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from junctura.checkpoints import checkpointed
from junctura.operators.counts import TILE
from junctura.sources.files import changed

JUNCTION = {"intron": "string", "splice_pair": "string", "splice_flag": "string", "count": "int"}
RUN = 1 << 15  # bases of a row of a split
_RUN_NAMES = ["path", "start", "number", "name", "place", "bases"]
_RUN_TYPES = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.string()]
HEADERS = 64  # different headers of junction files
GTF = "chrom string, source string, feature string, start long, end long, score string, strand string, frame string, attributes string"
RESULTS = "logFC double, logCPM double, F double, PValue double, FDR double, intron_id string, contrast string, significant boolean"


def sample_of_file() -> F.Column:
    """The folder ``sample_id=NAME`` that a file is in, as ``write_junctions`` deals them, else the file's name up to its first dot."""
    decoded = lambda name: F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))  # noqa: E731  of a path in the form of a URI
    folder = F.regexp_extract(F.input_file_name(), "/sample_id=([^/]*)/[^/]*$", 1)
    file = F.split_part(F.element_at(F.split(F.input_file_name(), "/"), -1), F.lit("."), F.lit(1))
    return F.when(folder != "", decoded(decoded(folder))).otherwise(decoded(file))


def read_junctions(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Junction files, plain or gzip, one sample each: sample_id, intron, splice_pair, splice_flag, count.

    Columns go by the names in each file's own header, in any order and with
    others between; a file without one of them is an error.
    """
    rows = spark.read.text(paths).select("value", sample_of_file().alias("sample_id"), in_order().alias("ord"))
    begun, path = rows.where("ord.start = 0"), F.col("ord.path").alias("path")
    heads = likely_heads(begun).groupBy("path").agg(F.min_by("head", "line").alias("head"))
    kinds = [r.head for r in heads.select("head").distinct().limit(HEADERS + 1).collect()]
    if None in kinds:  # a file begins with another line, which is to be told
        heads = begun.groupBy(path).agg(F.min_by("value", "ord").alias("head"))
        kinds = [r.head for r in heads.select("head").distinct().limit(HEADERS + 1).collect()]
    if len(kinds) > HEADERS:
        raise ValueError(f"more than {HEADERS} different headers")
    for kind in kinds:
        if absent := [c for c in JUNCTION if c not in kind.split("\t")]:
            raise ValueError(f"junction files without {', '.join(absent)}")
    if len(kinds) > 1:
        # A row a file; each file keeps its own header.
        rows = rows.join(F.broadcast(heads), F.col("ord.path") == F.col("path"))
    else:
        rows = rows.withColumn("head", F.lit(kinds[0] if kinds else "\t".join(JUNCTION)))
    field, found = F.split("value", "\t", -1), F.lit(None).cast("struct<intron:string,splice_pair:string,splice_flag:string,count:int>")
    for kind in kinds:
        names = kind.split("\t")
        own = F.struct(*[F.nullif(F.get(field, F.lit(names.index(c))), F.lit("")).cast(t).alias(c) for c, t in JUNCTION.items()])
        found = F.when(F.col("head") == kind, own).otherwise(found)
    return rows.where((F.col("value") != F.col("head")) & (F.col("value") != "")).select("sample_id", found.alias("j")).select("sample_id", "j.*")


def likely_heads(rows: DataFrame) -> DataFrame:
    """path, head and line: the first of each file's lines (value, ord) that have all names of a junction file, and the first of the others as null.

    Numbers are summed up as rows come; lines kept by their place would all be sorted.
    """
    named = F.forall(listed(list(JUNCTION)), lambda c: F.array_contains(F.split("value", "\t", -1), c))
    head = F.when(F.col("value").contains(next(iter(JUNCTION))), F.when(named, F.col("value")))
    return rows.groupBy(F.col("ord.path").alias("path"), head.alias("head")).agg(F.min("ord.line").alias("line"))


def in_order() -> F.Column:
    """Place of a line among all lines of its files: path, begin of the split, and number within the task that reads it.

    Lines of a split are read by one task, one after another, so the order is
    that of the files however the splits are dealt.
    """
    return F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"))


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of text files in order: ord, value."""
    return spark.read.text(path).select(in_order().alias("ord"), "value")


def header(rows: DataFrame) -> str | None:
    """The first of ordered lines that isn't blank."""
    found = rows.where("trim(value) <> ''").orderBy("ord").first()
    return found.value if found else None


def listed(values: list[str]) -> F.Column:
    """An array of strings as one literal, however many there are."""
    return F.split(F.lit("\t".join(values)), "\t") if values else F.array().cast("array<string>")


def read_cells(spark: SparkSession, path: str, other: tuple[str, ...] = (), value: str = "count", kind: str = "long") -> DataFrame:
    """A wide matrix in long form: intron_id, those of the columns ``other`` that are there, sample_id and the value.

    The first column, whose header may be blank, is intron_id; all others are
    samples. Lines are split into arrays and exploded, so a sample is neither a
    column nor an expression; ``NA`` and absent fields are null. A file's header
    may be repeated in others of a folder.
    """
    rows = lines(spark, path)
    first = header(rows)
    if first is None:
        raise ValueError(f"no header in {path}")
    names = first.split("\t")
    places = {n: i for i, n in enumerate(names) if i and n in other}
    samples = [(n, i) for i, n in enumerate(names) if i and n not in other]
    part = F.split("value", "\t", -1)
    told = rows.where((F.col("value") != first) & (F.trim("value") != "")).select(part.alias("__f"))
    each = F.arrays_zip(listed([n for n, _ in samples]).alias("name"), listed([str(i) for _, i in samples]).cast("array<int>").alias("at"))
    at = lambda i: F.nullif(F.get("__f", i), F.lit("NA"))
    flat = told.select(F.get("__f", F.lit(0)).alias("intron_id"), *[at(F.lit(i)).alias(n) for n, i in places.items()], "__f", F.explode(each).alias("__e"))
    number = at(F.col("__e.at")).cast("double")
    return flat.select("intron_id", *[f"`{n}`" for n in places], F.col("__e.name").alias("sample_id"), number.cast(kind).alias(value))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table of few columns with a header, whose first column may be unnamed and is intron_id; NA is null."""
    rows = spark.read.csv(path, sep="\t", header=True, inferSchema=True, nullValue="NA")
    return rows.withColumnRenamed(rows.columns[0], "intron_id")


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Sample table: ``#`` cuts a line anywhere, blank lines are skipped, short rows are padded with null."""
    rows = lines(spark, path).select("ord", F.rtrim(F.regexp_replace("value", "#.*$", "")).alias("value")).where("value <> ''")
    first = header(rows)
    if first is None:
        raise ValueError(f"no header in {path}")
    fields = F.split("value", "\t")
    value = lambda i: F.when(F.size(fields) > i, F.trim(F.get(fields, F.lit(i))))
    return rows.where(F.col("value") != first).select(*[F.when(value(i) != "NA", value(i)).alias(n.strip()) for i, n in enumerate(first.split("\t"))])


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """GTF rows with nine fields, quotes of attributes kept; ord is their place in the files."""
    rows = spark.read.csv(path, sep="\t", comment="#", quote="", schema=GTF)
    return rows.select("*", in_order().alias("ord")).where("attributes is not null")


def read_sam(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Alignments of SAM text: sample_id, flag, chrom, pos, mapq, cigar."""
    lines = spark.read.text(paths).where(~F.col("value").startswith("@"))
    part = F.split("value", "\t")
    at = lambda i: F.get(part, F.lit(i))
    return lines.select(sample_of_file().alias("sample_id"), at(1).cast("int").alias("flag"), at(2).alias("chrom"), at(3).cast("long").alias("pos"), at(4).cast("int").alias("mapq"), at(5).alias("cigar"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of FASTA (path, start, value) as runs of bases.

    A row has the split that it is from, the number of the sequence within the
    split (0 for the one begun before it) with its name, if it begins there, the
    place of its bases in that sequence as far as the split has it, and at most
    ``RUN`` bases. A sequence that begins has a row, also without bases.
    """
    split, number, name, place = None, 0, None, 0
    held: list[str] = []
    out: list[tuple] = []
    size = 0

    def put() -> None:
        nonlocal held, size, place
        text = "".join(held)
        for i in range(0, len(text), RUN):
            out.append((*split, number, name, place + i, text[i : i + RUN]))
        place += len(text)
        held, size = [], 0

    for batch in batches:
        for path, start, value in zip(*(c.to_pylist() for c in batch.columns)):
            if (path, start) != split:
                if split:
                    put()
                split, number, name, place = (path, start), 0, None, 0
                out.append((path, start, 0, None, 0, ""))
            if value.startswith(">"):
                put()
                number, name, place = number + 1, (value[1:].split() or [""])[0], 0
                out.append((path, start, number, name, 0, ""))
            elif own := "".join(value.split()):
                held.append(own)
                size += len(own)
                if size >= RUN:
                    put()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _RUN_TYPES)], _RUN_NAMES)
            out = []
    if split:
        put()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _RUN_TYPES)], _RUN_NAMES)


def read_tiles(spark: SparkSession, path: str | list[str], tile: int = TILE) -> DataFrame:
    """Sequences of FASTA as rows of ``tile`` bases and one more: chrom, tile, bases.

    No row has more than that. Each split counts the bases of its sequences; a
    small table, of a row for each split, says where it takes up a sequence that
    began before, in the same file or, in a folder, in one before it. Names have
    to be distinct. A line is a row of the scan, so bases have to be folded.
    """
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")
    runs = checkpointed(rows.mapInArrow(_runs, "path string, start long, number int, name string, place long, bases string"))
    n = F.length("bases")
    met = runs.groupBy("path", "start", "number").agg(F.max("name").alias("name"), F.sum(n).alias("n"))
    splits = met.groupBy("path", "start").agg(F.max_by(F.struct("name", "n"), "number").alias("last"), F.max("number").alias("heads"), F.max(F.when(F.col("number") == 0, F.col("n"))).alias("n0"))
    # A row a split, in one window: where a split begins lies what the one before it left open.
    order = Window.orderBy("path", "start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("upto", F.coalesce(F.sum(F.when(F.col("heads") > 0, F.col("last.n")).otherwise(F.col("n0"))).over(before), F.lit(0)))
    opened = lambda c: F.last(F.when(F.col("heads") > 0, F.col(c)), ignorenulls=True).over(before)
    splits = splits.select("path", "start", F.lit(0).alias("number"), opened("last.name").alias("open"), (F.col("upto") - opened("upto")).alias("before"))
    found = runs.join(splits, ["path", "start", "number"], "left").withColumn("chrom", F.coalesce("name", "open")).where("chrom is not null")
    found = found.withColumn("at", F.col("place") + F.coalesce("before", F.lit(0)))
    last = F.greatest(F.col("at"), F.col("at") + F.length("bases") - 1)
    first_tile = F.greatest(F.lit(0), F.expr(f"(at - 1) div {tile}"))
    spread = found.select("chrom", "at", "bases", F.explode(F.sequence(first_tile, F.floor(last / tile).cast("long"))).alias("tile"))
    begin = F.greatest(F.lit(0), F.col("tile") * tile - F.col("at"))
    piece = F.substring("bases", (begin + 1).cast("int"), ((F.col("tile") + 1) * tile + 1 - F.col("at") - begin).cast("int"))
    pieces = spread.select("chrom", "tile", F.struct((F.col("at") + begin).alias("at"), piece.alias("piece")).alias("p"), F.length("bases").alias("n"))
    # A sequence of no bases has its first tile; other tiles have some.
    pieces = pieces.where((F.length("p.piece") > 0) | (F.col("tile") == 0))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda x: x.piece), "")
    return pieces.groupBy("chrom", F.col("tile").cast("int").alias("tile")).agg(whole.cast("binary").alias("bases"))


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Result tables with a header; NA is null."""
    return spark.read.csv(path, sep="\t", header=True, inferSchema=True, nullValue="NA")


def read_combined(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Result tables of several contrasts in one, columns by name; absent ones are warned of, none at all is an error."""
    there = [p for p in paths if changed(spark, p) is not None]
    if absent := [p for p in paths if p not in there]:
        warnings.warn(f"no results at {', '.join(absent[:5])}{'...' if len(absent) > 5 else ''}", stacklevel=2)
    if not there:
        raise ValueError("there are no results of any contrast")
    found = read_results(spark, there[0])
    for p in there[1:]:
        found = found.unionByName(read_results(spark, p), allowMissingColumns=True)
    return found
