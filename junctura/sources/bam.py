"""Alignments of BAM files as a DataFrame, a file read by many tasks.

A BAM file is a row of compressed blocks. It is parted by offsets in the file;
each task begins with the first block that begins in its part, finds there the
first record's begin, and reads the records whose begin lies in its blocks, the
last one to its end in the next. A begin is taken for one only if a chain of
records follows it to the end of what is held; every field of fixed size in
them has to be possible. Filters are applied to numbers, and CIGAR text is made
for what they leave.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

ALIGNMENT = "sample_id string, flag int, chrom string, pos long, mapq int, cigar string"
OPERATIONS = "MIDNSHP=X"
PART = 16 << 20  # bytes of a file for each task
WINDOW = 1 << 20  # bytes decompressed at once
CHAIN = 1 << 18  # bytes in which records must follow one another behind the first
LONGEST = 1 << 28  # bytes of a record
FIXED = struct.Struct("<iiBBHHHi")
_BLOCK = b"\x1f\x8b\x08\x04"
_LETTERS = np.array([ord(c) for c in OPERATIONS.ljust(16, "?")], np.uint8)
_GAP = OPERATIONS.index("N")


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class Blocks:
    """Compressed blocks of a file, from an offset on."""

    def __init__(self, file: pa.NativeFile, size: int, at: int) -> None:
        self.file, self.size, self.at = file, size, at
        self.held, self.first = b"", at

    def _need(self, at: int, n: int) -> bytes:
        """``n`` bytes from the offset ``at``, or as many as there are."""
        if not self.first <= at <= at + n <= self.first + len(self.held):
            self.file.seek(at)
            self.first, self.held = at, self.file.read(max(n, WINDOW))
        return self.held[at - self.first : at - self.first + n]

    def length(self, at: int) -> int | None:
        """Length of the block at an offset, None if there is none."""
        head = self._need(at, 12)
        if len(head) < 12 or head[:4] != _BLOCK:
            return None
        extra, k = self._need(at + 12, struct.unpack_from("<H", head, 10)[0]), 0
        while k + 4 <= len(extra):
            n = struct.unpack_from("<H", extra, k + 2)[0]
            if extra[k : k + 2] == b"BC" and n == 2 and k + 6 <= len(extra):
                return struct.unpack_from("<H", extra, k + 4)[0] + 1
            k += 4 + n
        return None

    def find(self, end: int) -> bool:
        """Go to the first block that begins before ``end``; it has to be followed by another, or by the file's end."""
        while self.at < end:
            held = self._need(self.at, min(WINDOW, end - self.at + len(_BLOCK)))
            k = held.find(_BLOCK)
            if k < 0:
                self.at += max(1, len(held) - len(_BLOCK) + 1)
                continue
            self.at += k
            if self.at >= end:
                return False
            n = self.length(self.at)
            if n and (self.at + n == self.size or self.length(self.at + n)):
                return True
            self.at += 1
        return False

    def next(self) -> bytes | None:
        """The next block's bytes, None behind the last."""
        if self.at >= self.size:
            return None
        n = self.length(self.at)
        if n is None:
            raise ValueError(f"no block at {self.at}: not a BAM file, or cut short")
        raw = self._need(self.at, n)
        if len(raw) < n:
            raise ValueError("the BAM file is cut short")
        self.at += n
        return zlib.decompress(raw, wbits=31)


def header(file: pa.NativeFile, size: int) -> tuple[list[str], np.ndarray, int, int]:
    """Names and lengths of the references, the offset of the block in which the first record begins, and its place there."""
    blocks, held, starts = Blocks(file, size, 0), bytearray(), []

    def upto(n: int) -> None:
        while len(held) < n:
            at = blocks.at
            more = blocks.next()
            if more is None:
                raise ValueError("the BAM file is cut short")
            starts.append((at, len(held), len(more)))
            held.extend(more)

    upto(8)
    if held[:4] != b"BAM\1":
        raise ValueError("not a BAM file")
    at = 8 + struct.unpack_from("<i", held, 4)[0]
    upto(at + 4)
    names, lengths = [], []
    n = struct.unpack_from("<i", held, at)[0]
    at += 4
    for _ in range(n):
        upto(at + 4)
        own = struct.unpack_from("<i", held, at)[0]
        upto(at + 8 + own)
        names.append(held[at + 4 : at + 3 + own].decode())
        lengths.append(struct.unpack_from("<i", held, at + 4 + own)[0])
        at += 8 + own
    for offset, begin, size_ in reversed(starts):
        if begin <= at < begin + size_:
            return names, np.array(lengths), offset, at - begin
    return names, np.array(lengths), blocks.at, 0


def _possible(held: bytes, at: int, lengths: np.ndarray) -> int | None:
    """The record's length, with that field, if one can begin here; 0 if too little is held to tell."""
    if at + 36 > len(held):
        return 0
    size, ref, pos, name, _, _, ops, _, bases, next_ref, next_pos = struct.unpack_from("<iiiBBHHHiii", held, at)
    if not 32 <= size <= LONGEST or not -1 <= ref < len(lengths) or not -1 <= next_ref < len(lengths) or name < 1 or bases < 0:
        return None
    if pos < -1 or next_pos < -1 or ref >= 0 and pos > lengths[ref] or next_ref >= 0 and next_pos > lengths[next_ref]:
        return None
    if 32 + name + 4 * ops + (bases + 1) // 2 + bases > size:
        return None
    end = at + 35 + name
    if end < len(held) and (held[end] != 0 or 0 in held[at + 36 : end]):
        return None
    for k in range(at + 36 + name, min(at + 36 + name + 4 * ops, len(held) - 3), 4):
        if held[k] & 15 >= len(OPERATIONS):
            return None
    return size + 4


def first_record(held: bytes, own: int, lengths: np.ndarray, last: bool) -> int | None:
    """Place of the first record that begins in the first ``own`` bytes, or None; ``last`` if nothing follows what is held."""
    for start in range(own):
        at = start
        while True:
            n = _possible(held, at, lengths)
            if n is None or n == 0 and last and at != len(held):
                break
            if n == 0 or at + n > len(held):
                if last and at + (n or 0) > len(held):
                    break
                return start
            at += n
    return None


def _starts(held: bytes, at: int, own: int) -> list[int]:
    """Places of the whole records from ``at`` on that begin before ``own``."""
    out, read = [], struct.Struct("<i").unpack_from
    while at < own and at + 4 <= len(held):
        n = read(held, at)[0]
        if n < 32:
            raise ValueError("the BAM file is damaged")
        if at + 4 + n > len(held):
            break
        out.append(at)
        at += 4 + n
    return out


@dataclass(frozen=True)
class Wanted:
    """Least quality, flags of which none may be set, and whether a gap must be there."""

    mapq: int = 0
    without: int = 0
    gapped: bool = False


def _batch(held: bytes, starts: list[int], names: np.ndarray, sample: str, wanted: Wanted) -> pa.RecordBatch:
    raw = np.frombuffer(held, np.uint8)
    at = np.array(starts, np.int64)
    number = lambda place, kind: raw[place[:, None] + np.arange(np.dtype(kind).itemsize)].copy().view(kind)[:, 0].astype(np.int64)
    keep = np.ones(len(at), bool)
    if wanted.mapq:
        keep &= raw[at + 13] >= wanted.mapq
    if wanted.without:
        keep &= number(at + 18, "<u2") & wanted.without == 0
    at = at[keep]
    n = number(at + 16, "<u2")
    first = at + 36 + raw[at + 12]
    place = np.repeat(first - 4 * (np.cumsum(n) - n), n) + 4 * np.arange(int(n.sum()))
    ops = number(place, "<u4")
    if wanted.gapped:
        gaps = np.r_[0, np.cumsum(ops & 15 == _GAP)]
        has = gaps[np.cumsum(n)] > gaps[np.cumsum(n) - n]
        at, ops, n = at[has], ops[np.repeat(has, n)], n[has]
    ref = number(at + 4, "<i4")
    size, letter = (ops >> 4).tolist(), _LETTERS[ops & 15].tobytes().decode()
    told = [f"{a}{b}" for a, b in zip(size, letter)]
    ends = np.cumsum(n)
    cigar = ["".join(told[i:j]) or "*" for i, j in zip((ends - n).tolist(), ends.tolist())]
    chrom = pa.DictionaryArray.from_arrays(pa.array(np.where(ref < 0, len(names) - 1, ref)), pa.array(names)).cast(pa.string())
    columns = [pa.array([sample] * len(at), pa.string()), pa.array(number(at + 18, "<u2"), pa.int32()), chrom, pa.array(number(at + 8, "<i4") + 1), pa.array(raw[at + 13].astype(np.int32)), pa.array(cigar, pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["sample_id", "flag", "chrom", "pos", "mapq", "cigar"])


def alignments(path: str, start: int, end: int, wanted: Wanted = Wanted()) -> Iterator[pa.RecordBatch]:
    """Alignments of the records that begin in blocks whose offset lies in [start, end)."""
    system, where = opened(path)
    sample = path.rpartition("/")[2].partition(".")[0]
    with system.open_input_file(where) as file:
        size = file.size()
        names, lengths, first, place = header(file, size)
        blocks = Blocks(file, size, max(start, first))
        if start <= first:
            if first >= end:
                return
        elif not blocks.find(end):
            return
        named, held, known = np.array([*names, "*"]), bytearray(), start <= first
        own, done = 0, False  # bytes of own blocks are at the front of what is held; others only end the last record

        def more() -> bool:
            nonlocal own
            inside = blocks.at < end
            block = blocks.next()
            if block is None:
                return False
            held.extend(block)
            if inside:
                own = len(held)
            return True

        while not done:
            fresh = True
            while blocks.at < min(end, size) and (fresh or len(held) < WINDOW):
                more()
                fresh = False
            if not known:
                while len(held) < own + CHAIN and more():
                    pass
            done = blocks.at >= min(end, size)
            if not known:
                found = first_record(bytes(held), own, lengths, blocks.at >= size)
                if found is None:
                    del held[:own]  # a record begun before fills them
                    own = 0
                    continue
                place, known = found, True
            starts = _starts(held, place, own)
            ended = lambda: starts[-1] + 4 + struct.unpack_from("<i", held, starts[-1])[0] if starts else place
            while done and ended() < own:
                if not more():
                    raise ValueError("the BAM file is cut short")
                starts += _starts(held, ended(), own)
            if starts:
                yield _batch(bytes(held), starts, named, sample, wanted)
            after = ended()
            cut = min(after, len(held))
            del held[:cut]
            own, place = max(0, own - cut), after - cut


@dataclass
class Part(InputPartition):
    path: str
    start: int
    end: int


class BamReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.paths, self.part = options["paths"].split("\n"), int(options.get("part", PART))
        self.wanted = Wanted(int(options.get("mapq", 0)), int(options.get("without", 0)), options.get("gapped", "false").lower() == "true")

    def partitions(self) -> list[Part]:
        out = []
        for path in self.paths:
            system, where = opened(path)
            info = system.get_file_info(where)
            root = path[: -len(where)] if path.endswith(where) else ""
            found = system.get_file_info(fs.FileSelector(where, recursive=True)) if info.type == fs.FileType.Directory else [info]
            if info.type == fs.FileType.NotFound:
                raise FileNotFoundError(path)
            files = [f for f in found if f.type == fs.FileType.File and (f.path.endswith(".bam") or f is info)]
            out += [Part(root + f.path, at, min(at + self.part, f.size)) for f in sorted(files, key=lambda f: f.path) for at in range(0, f.size, self.part)]
        return out

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        yield from alignments(partition.path, partition.start, partition.end, self.wanted)


class BamSource(DataSource):
    """Alignments of BAM files: options ``paths`` (parted by line feeds), ``part`` (bytes a task), ``mapq``, ``without`` and ``gapped``."""

    @classmethod
    def name(cls) -> str:
        return "junctura_bam"

    def schema(self) -> str:
        return ALIGNMENT

    def reader(self, schema) -> BamReader:
        return BamReader(self.options)


def read_bam(spark: SparkSession, paths: list[str], mapq: int = 0, without: int = 0, gapped: bool = False, part: int = PART) -> DataFrame:
    """Alignments of BAM files or folders of them; the sample is a file's name up to its first dot.

    ``mapq``, ``without`` and ``gapped`` leave out reads of less quality, with
    any of these flags, and without a gap.
    """
    spark.dataSource.register(BamSource)
    return spark.read.format("junctura_bam").options(paths="\n".join(paths), part=str(part), mapq=str(mapq), without=str(without), gapped=str(gapped)).load()


def _compressed(data: bytes) -> bytes:
    """Blocks of at most 65,280 bytes each."""
    out = []
    for i in range(0, len(data), 65_280):
        own = data[i : i + 65_280]
        deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
        raw = deflate.compress(own) + deflate.flush()
        out.append(_BLOCK + struct.pack("<IBBHBBHH", 0, 0, 255, 6, 66, 67, 2, len(raw) + 25) + raw + struct.pack("<II", zlib.crc32(own), len(own)))
    return b"".join(out)


_END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


def packed(rows: Iterator[tuple[int, str, int, int, str]], names: dict[str, int], name: str = "r") -> bytes:
    """Records of (flag, chrom, 1-based pos, mapq, cigar)."""
    out = bytearray()
    for k, (flag, chrom, pos, mapq, cigar) in enumerate(rows):
        ops, n = [], ""
        for c in "" if cigar == "*" else cigar:
            if c.isdigit():
                n += c
            else:
                ops.append(int(n) << 4 | OPERATIONS.index(c))
                n = ""
        own = f"{name}{k}".encode() + b"\0"
        record = FIXED.pack(names.get(chrom, -1), pos - 1, len(own), mapq, 0, len(ops), flag, 0) + struct.pack("<iii", -1, -1, 0) + own + struct.pack(f"<{len(ops)}I", *ops)
        out += struct.pack("<i", len(record)) + record
    return bytes(out)


def bam_header(references: dict[str, int]) -> bytes:
    told = "".join(f"@SQ\tSN:{n}\tLN:{k}\n" for n, k in references.items()).encode()
    out = b"BAM\1" + struct.pack("<i", len(told)) + told + struct.pack("<i", len(references))
    for n, k in references.items():
        own = n.encode() + b"\0"
        out += struct.pack("<i", len(own)) + own + struct.pack("<i", k)
    return out


def write_bam(rows: DataFrame, path: str, references: dict[str, int]) -> None:
    """Alignments as BAM files in the folder ``path``; each task writes one for each sample it has, named ``SAMPLE.task.bam``.

    References are name to length. Files of tasks that are run again go by names
    of their own, and only those of the runs that succeeded get the ending
    ``.bam``.
    """
    spark, numbers = rows.sparkSession, {n: i for i, n in enumerate(references)}
    head = _compressed(bam_header(references))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, where = opened(path)
        system.create_dir(where, recursive=True)
        task, files = uuid.uuid4().hex, {}
        try:
            for batch in batches:
                own: dict[str, list[tuple]] = {}
                for sample, *row in zip(*(c.to_pylist() for c in batch.columns)):
                    own.setdefault(sample, []).append(tuple(row))
                for sample, found in own.items():
                    if sample not in files:
                        files[sample] = system.open_output_stream(f"{where}/{sample}.{task}.part")
                        files[sample].write(head)
                    files[sample].write(_compressed(packed(found, numbers)))
            for file in files.values():
                file.write(_END)
        finally:
            for file in files.values():
                file.close()
        names = [f"{where}/{sample}.{task}" for sample in files]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], ["name"])

    ordered = rows.select("sample_id", "flag", "chrom", F.col("pos").cast("long"), "mapq", "cigar")
    done = [r.name for r in ordered.mapInArrow(run, "name string").collect()]  # a row a file
    system, _ = opened(path)
    for name in done:
        system.move(f"{name}.part", f"{name}.bam")
