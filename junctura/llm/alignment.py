"""Alignment of the tokens of two tokenizers over the same bytes.

A text is encoded by a byte-level tokenizer (A) and by one of pieces (B). Two
packed bitsets have a bit for every byte; a bit is set where a token of A, or of
B, ends. Their AND has the shared cuts, which part the bytes into groups; counts
of set bits up to a cut say which tokens lie in each group, and every token of A
in a group is linked to every token of B there.

Neither tokenizer joins what a single space between other characters parts, so
texts are cut before such spaces, and each distinct stretch of a batch is encoded
and aligned once. The numbers of documents that hold a pair of ids linked are
counted over all documents. Pairs that many documents hold, at most ``FREQUENT``
of them, are looked up in a broadcast table; each other pair is in few documents
and is met by a join, so nothing is dropped and no key is hot.

Defined results: texts that are null or empty, or whose tokens don't spell the
text with a space before it (one that holds U+2581, say), have no tokens: zeros
and an empty string. Repeated rows and identifiers count each; other columns
aren't read; an empty table gives an empty result. A stretch without such spaces
is encoded whole, however long.
"""

from __future__ import annotations

import json
import os
import uuid
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from junctura.checkpoints import checkpoint_folder
from junctura.llm.common import frugal, small_batches

FREQUENT = 1 << 18  # pairs in the broadcast table
EXPANDED = 1 << 21  # links held at once
TOGETHER = 1 << 15  # bytes of words encoded as one text
AT_ONCE = 8  # texts whose encodings are held at once, as they are many times the size of their ids
SLICE = 4 << 20  # characters of texts aligned at once
LARGE = 1 << 16  # links of a group from which equal ids of it are counted first
SPACE = "▁"


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Spelled:
    """Bytes of each id of a vocabulary, one after another."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        told = np.char.mod("%d", np.arange(len(tokens)))
        self.digits = np.char.str_len(told).astype(np.int64)
        self.written = np.frombuffer(told.astype("S10").tobytes(), np.uint8).reshape(-1, 10)

    def __len__(self) -> int:
        return len(self.lengths)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        n = self.lengths[ids]
        begin = np.cumsum(n) - n
        return self.flat[np.repeat(self.starts[ids] - begin, n) + np.arange(int(n.sum()))]


class Tokenizers:
    """Both tokenizers: ids of many stretches, each of which begins with a space."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True  # their strings in texts are plain text
        self.b = SentencePieceProcessor(model_file=piece_path)
        letters, names = _byte_letters(), {i: t for t, i in self.a.get_vocab().items()}
        spell = lambda t: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode()
        self.spelled_a = Spelled([spell(names.get(i, "")) for i in range(max(names) + 1)])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.spelled_b = Spelled([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)])
        # Stretches may be encoded apart where no token joins what a space parts.
        steps = json.loads(self.a.to_str())
        by_word = steps["normalizer"] is None and (steps["pre_tokenizer"] or {}).get("type") == "ByteLevel" and steps["pre_tokenizer"].get("use_regex")
        self.apart = bool(by_word) and not any(SPACE in p.lstrip(SPACE) for p in pieces)

    def encode(self, stretches: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """(ids one after another, how many each stretch has) of A and of B."""
        a, b = [], []
        for i in range(0, len(stretches), AT_ONCE):
            own = stretches[i : i + AT_ONCE]
            a += [_ids(x.ids) for x in self.a.encode_batch_fast(own, add_special_tokens=False)]
            b += map(_ids, self.b.encode([s[1:] for s in own], num_threads=1))
        return _flat(a), _flat(b)

    def encode_words(self, words: list[str], size: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """The same of words, a space before each and no white space in or behind it: many at once, parted again by their sizes in bytes."""
        found = []
        runs = list(_runs(size, TOGETHER))
        flat = self.encode(["".join(words[i:j]) for i, j in runs])
        for (ids, n), spelled in zip(flat, (self.spelled_a, self.spelled_b)):
            parts, begin = [np.empty(0, np.int64)], np.cumsum(n) - n
            for (i, j), first, many in zip(runs, begin, n):
                ends, own = np.cumsum(spelled.lengths[ids[first : first + many]]), np.cumsum(size[i:j])
                at = np.searchsorted(ends, own, "right")
                if many != at[-1] or not np.array_equal(ends[np.maximum(at, 1) - 1], own):
                    return self.encode(words)  # a word that isn't spelt shifts the others
                parts.append(np.diff(at, prepend=0))
            found.append((ids, np.concatenate(parts)))
        return found[0], found[1]


@lru_cache(maxsize=1)
def loaded(byte_path: str, piece_path: str) -> Tokenizers:
    """Both tokenizers, kept for all tasks of a worker."""
    return Tokenizers(byte_path, piece_path)


def _ids(found: list[int]) -> array:
    return array("i", found)


def _flat(ids: list[array]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(ids), "i4").astype(np.int64), np.fromiter(map(len, ids), np.int64, len(ids))


def _parting() -> np.ndarray:
    """First bytes of characters that are surely no white space."""
    ok = np.zeros(256, bool)
    ok[33:127] = True
    ok[0xC3:0xE0] = True
    ok[0xE4:0xF5] = True
    return ok


_OK = _parting()


def cuts(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places in ``raw`` where stretches begin: ``starts``, and single spaces between other characters."""
    space = np.flatnonzero(raw == 32)
    space = space[(space > 0) & (space < len(raw) - 1)]
    back = [raw[np.maximum(space - k, 0)] for k in range(1, 5)]
    lead = np.where(back[0] < 0x80, back[0], np.where(back[1] >= 0xC0, back[1], np.where(back[2] >= 0xE0, back[2], back[3])))
    marks = np.zeros(len(raw), bool)
    marks[starts] = marks[space[_OK[lead] & _OK[raw[space + 1]]]] = True
    return np.flatnonzero(marks)


def _words(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which stretches are a space and characters that are surely no white space."""
    black = _OK[raw] | (raw & 0xC0 == 0x80)
    return (end - begin > 1) & (_sums(black, end - begin) == end - begin - 1)


def _encoded(tokenizers: Tokenizers, stretches: list[str], raw: np.ndarray, size: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Ids of A and of B of stretches, words together and others by themselves."""
    end = np.cumsum(size)
    word = _words(raw, end - size, end) if tokenizers.apart else np.zeros(len(size), bool)
    plain, odd = np.flatnonzero(word), np.flatnonzero(~word)
    both = zip(tokenizers.encode_words([stretches[i] for i in plain.tolist()], size[plain]), tokenizers.encode([stretches[i] for i in odd.tolist()]))
    place = np.argsort(np.r_[plain, odd])
    out = []
    for (ids, n), (ids_odd, n_odd) in both:
        ids, n = np.r_[ids, ids_odd], np.r_[n, n_odd]
        first, many = (np.cumsum(n) - n)[place], n[place]
        out.append((ids[np.repeat(first - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))], many))
    return out


def _sums(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of the lengths ``n``."""
    total = np.r_[0, np.cumsum(values)]
    ends = np.cumsum(n)
    return total[ends] - total[ends - n]


def _spelt(spelled: Spelled, ids: np.ndarray, n: np.ndarray, raw: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the tokens of each stretch spell its bytes."""
    same = _sums(spelled.lengths[ids], n) == size
    own, theirs = spelled.bytes_of(ids[np.repeat(same, n)]), raw[np.repeat(same, size)]
    wrong = np.repeat(np.flatnonzero(same), size[same])[own != theirs]
    same[wrong] = False
    return same


def _bits(ends: np.ndarray, size: int) -> np.ndarray:
    """Packed bitset of ``size`` bytes, in words of 64 bits, with a bit at the last byte of each token."""
    marks = np.zeros(-(-size // 64) * 64, bool)
    marks[ends - 1] = True
    return np.packbits(marks, bitorder="little").view("<u8")


def _rank(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of set bits up to and with each place."""
    below = np.r_[0, np.cumsum(np.bitwise_count(bits), dtype=np.int64)]
    word, bit = at >> 6, (at & 63).astype(np.uint64)
    return below[word] + np.bitwise_count(bits[word] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(63) - bit)))


def groups(length_a: np.ndarray, length_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shared cuts of two runs of tokens over the same bytes, and how many tokens of each lie up to each cut."""
    ends_a, ends_b = np.cumsum(length_a), np.cumsum(length_b)
    size = int(ends_a[-1]) if len(ends_a) else 0
    a, b = _bits(ends_a, size), _bits(ends_b, size)
    shared = np.flatnonzero(np.unpackbits((a & b).view(np.uint8), bitorder="little"))
    return shared + 1, _rank(a, shared), _rank(b, shared)


def _unique_sums(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    if not len(keys):
        return keys, times
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(times, first)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys, kind="stable")
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.diff(np.r_[first, len(keys)])


def _runs(n: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive runs whose ``n`` sum up to ``most`` at most, or single ones."""
    ends, i = np.cumsum(n), 0
    while i < len(n):
        before = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, before + most, "right")))
        yield i, j
        i = j


def _linked(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, owner: np.ndarray, many_b: int, pairs: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys owner * pairs + a * many_b + b of all links of groups of na and nb tokens, and how often each is there."""
    first_a, first_b, n = np.cumsum(na) - na, np.cumsum(nb) - nb, na * nb
    keys, times = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for g in np.flatnonzero(n > LARGE):
        one, n_one = np.unique(a[first_a[g] : first_a[g] + na[g]], return_counts=True)
        two, n_two = np.unique(b[first_b[g] : first_b[g] + nb[g]], return_counts=True)
        keys.append(((owner[g] * pairs + one * many_b)[:, None] + two[None]).ravel())
        times.append((n_one[:, None] * n_two[None]).ravel())
    small = np.flatnonzero(n <= LARGE)
    for i, j in _runs(n[small], EXPANDED):
        own = small[i:j]
        m = n[own]
        place = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
        wide = np.repeat(nb[own], m)
        one, two = a[np.repeat(first_a[own], m) + place // wide], b[np.repeat(first_b[own], m) + place % wide]
        key, often = _counted(np.repeat(owner[own] * pairs, m) + one * many_b + two)
        keys.append(key)
        times.append(often)
    return _unique_sums(np.concatenate(keys), np.concatenate(times))


def _written(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, told_a: Spelled, told_b: Spelled) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;`` of all groups one after another, and where each group's end."""
    before_a, before_b = np.cumsum(na) - na, np.cumsum(nb) - nb
    at_a = np.arange(len(a)) + np.repeat(before_b, na)
    at_b = np.arange(len(b)) + np.repeat(before_a + na, nb)
    total = len(a) + len(b)
    row, size = np.empty((total, 11), np.uint8), np.empty(total, np.int64)
    for at, ids, told in ((at_a, a, told_a), (at_b, b, told_b)):
        row[at, :10], size[at] = told.written[ids], told.digits[ids]
    mark = np.full(total, ord(","), np.uint8)
    mark[at_a[before_a + na - 1]] = ord("|")
    mark[at_b[before_b + nb - 1]] = ord(";")
    row[np.arange(total), size] = mark
    text = row[np.arange(11)[None] <= size[:, None]].tobytes()
    return text, np.cumsum(size + 1)[at_b[before_b + nb - 1]] if len(na) else np.empty(0, np.int64)


COLUMNS = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"


def aligned(texts: list[str | None], tokenizers: Tokenizers) -> list[pa.Array]:
    """The columns of ``COLUMNS`` for some texts."""
    one, two = tokenizers.spelled_a, tokenizers.spelled_b
    many_b, pairs = len(two), len(one) * len(two)
    docs = [i for i, t in enumerate(texts) if t]
    data = [b" " + texts[i].encode() for i in docs]
    size = np.array([len(x) for x in data], np.int64)
    starts = np.cumsum(size) - size
    raw = np.frombuffer(b"".join(data), np.uint8)
    begin = cuts(raw, starts) if tokenizers.apart else starts
    n = len(begin)
    doc = np.searchsorted(starts, begin, "right") - 1  # among ``docs``
    offsets = pa.py_buffer(np.r_[begin, len(raw)].astype(np.int64))
    told = pa.Array.from_buffers(pa.large_binary(), n, [None, offsets, pa.py_buffer(raw)]).dictionary_encode()
    stretch, own = told.indices.to_numpy().astype(np.int64), told.dictionary
    del data, told

    length = pc.binary_length(own).to_numpy().astype(np.int64)
    spelling = np.frombuffer(b"".join(own.to_pylist()), np.uint8)
    (a, n_a), (b, n_b) = _encoded(tokenizers, own.cast(pa.large_string()).to_pylist(), spelling, length)
    good = _spelt(one, a, n_a, spelling, length) & _spelt(two, b, n_b, spelling, length)
    a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
    ends, upto_a, upto_b = groups(one.lengths[a], two.lengths[b])
    g_a, g_b = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)
    # Stretches end in shared cuts.
    good_ends = np.cumsum(length[good])
    owner = np.flatnonzero(good)[np.searchsorted(good_ends, ends)] if len(ends) else np.empty(0, np.int64)
    text, till = _written(a, b, g_a, g_b, one, two)
    per = lambda w: np.bincount(owner, w, len(own)).astype(np.int64)  # noqa: E731  sums below 2^53
    n_groups = np.bincount(owner, minlength=len(own))
    n_links = per(g_a * g_b)
    last = np.cumsum(n_groups)
    piece_end = np.where(last > 0, till[np.maximum(last - 1, 0)], 0) if len(till) else np.zeros(len(own), np.int64)
    pieces = [text[i:j] for i, j in zip(np.r_[0, piece_end[:-1]].tolist() if len(own) else [], piece_end.tolist())]
    keys, times = _linked(a, b, g_a, g_b, owner, many_b, pairs)
    holder, pair = keys // pairs, keys % pairs
    n_pairs = np.bincount(holder, minlength=len(own))
    first_pair = np.cumsum(n_pairs) - n_pairs

    valid = np.bincount(doc, ~good[stretch], len(docs)) == 0
    out = {name: np.zeros(len(texts), np.int64) for name in ("n_a", "n_b", "n_groups", "n_links")}
    at = np.array(docs, np.int64)
    for name, values in (("n_a", n_a), ("n_b", n_b), ("n_groups", n_groups), ("n_links", n_links)):
        out[name][at] = np.where(valid, np.bincount(doc, values[stretch], len(docs)), 0)
    strings, held, many = [""] * len(texts), [], np.zeros(len(texts), np.int64)
    edge = np.searchsorted(doc, np.arange(len(docs) + 1)).tolist()
    listed = stretch.tolist()
    for k, i in enumerate(docs):
        if valid[k]:
            strings[i] = b"".join([pieces[s] for s in listed[edge[k] : edge[k + 1]]])[:-1].decode()
    # Pairs of each text, from those of its distinct stretches.
    member, often = _counted(doc[valid[doc]] * max(1, len(own)) + stretch[valid[doc]])
    whose, which = member // max(1, len(own)), member % max(1, len(own))
    per_doc = np.bincount(whose, n_pairs[which], len(docs)).astype(np.int64)
    edges = np.searchsorted(whose, np.arange(len(docs) + 1))
    for i, j in _runs(per_doc, EXPANDED):
        w = slice(edges[i], edges[j])
        m = n_pairs[which[w]]
        place = np.repeat(first_pair[which[w]] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))
        found = _unique_sums(np.repeat(whose[w], m) * pairs + pair[place], times[place] * np.repeat(often[w], m))
        many[at[i:j]] = np.bincount(found[0] // pairs - i, minlength=j - i)
        held.append((found[0] % pairs, found[1]))
    bounds = pa.array(np.r_[0, np.cumsum(many)].astype(np.int32))
    lists = [pa.ListArray.from_arrays(bounds, pa.array(np.concatenate([np.empty(0, np.int64), *(h[k] for h in held)]))) for k in range(2)]
    return [*(pa.array(x) for x in out.values()), pa.array(strings), *lists]


def alignments(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, row (a number of its own), the numbers of tokens, groups and links, the groups of ids written
    ``a1,a2|b1;a3|b2,b3``, and the linked pairs of ids (a times the size of B's vocabulary, plus b) with how often each is linked.
    """
    small_batches(docs.sparkSession, 8000)
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        tokenizers = None
        for batch in batches:
            tokenizers = tokenizers or loaded(byte_path, piece_path)
            size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
            for i, j in _runs(size, SLICE):
                rows = pa.array(np.arange(number, number + j - i))
                number += j - i
                columns = aligned(batch.column(1).slice(i, j - i).to_pylist(), tokenizers)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), rows, *columns], ["doc_id", "row", *(c.split()[0] for c in COLUMNS.split(", "))])

    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return own.mapInArrow(run, f"doc_id long, row long, {COLUMNS}")


def _stored(rows: DataFrame, name: str) -> DataFrame:
    path = f"{checkpoint_folder(rows.sparkSession)}/alignment-{uuid.uuid4().hex}/{name}"
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _frequent(counts: DataFrame, most: int) -> DataFrame:
    """Pairs in at least so many documents, the least power of two for which there are at most ``most``."""
    sizes = counts.groupBy(F.floor(F.log2("n")).alias("power")).count().collect()  # a row a power of two
    total, least = 0, 1 << 62
    for r in sorted(sizes, reverse=True):
        total += r["count"]
        if total > most:
            break
        least = 1 << r.power
    return counts.where(F.col("n") >= least)


def link_counts(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    A pair's count is the number of rows of the whole table in which it is
    linked. ``n_best`` are the links whose pair has the highest count of all
    pairs of its id of A; ``count_sum`` is the sum of the counts over links.
    """
    spark = docs.sparkSession
    many_b = len(loaded(byte_path, piece_path).spelled_b)
    found = alignments(docs, byte_path, piece_path, id_col, text_col)
    digest = F.when(F.col("groups") != "", F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    rows = _stored(found.withColumn("groups_sha256", digest).drop("groups"), "rows")
    counts = _stored(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "counts")
    first = F.expr(f"pair div {many_b}").alias("a")
    best = counts.groupBy(first).agg(F.max("n").alias("best"))  # a row an id of A
    table, tops = _frequent(counts, frequent).orderBy("pair").toArrow(), best.orderBy("a").toArrow()
    arrays = [c.to_numpy() for c in (*table.columns, *tops.columns)]
    sent = spark.sparkContext.broadcast(arrays)

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, a, best = sent.value
        for batch in batches:
            lists, times = batch.column(1), batch.column(2).flatten().to_numpy()
            own, bounds = lists.flatten().to_numpy(), lists.offsets.to_numpy().astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            at = np.minimum(np.searchsorted(pair, own), max(0, len(pair) - 1))
            hit = pair[at] == own if len(pair) else np.zeros(len(own), bool)
            at = at[hit]
            top = best[np.searchsorted(a, own[hit] // many_b)] == n[at]
            each = np.zeros((2, len(own)), np.int64)
            each[0, hit], each[1, hit] = np.where(top, times[hit], 0), times[hit] * n[at]
            sums = [_sums(x, np.diff(bounds)) for x in each]
            left = pa.array(np.r_[0, np.cumsum(np.bincount(row[~hit], minlength=batch.num_rows))].astype(np.int32))
            rest = [pa.ListArray.from_arrays(left, pa.array(x[~hit])) for x in (own, times)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums[0]), pa.array(sums[1]), *rest], ["row", "n_best", "count_sum", "pairs", "times"])

    known = _stored(rows.select("row", "pairs", "times").mapInArrow(looked_up, "row long, n_best long, count_sum long, pairs array<long>, times array<long>"), "known")
    rare = known.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), "p.times")
    met = rare.join(counts, "pair").withColumn("a", F.expr(f"pair div {many_b}"))
    met = met.join(F.broadcast(best), "a")  # at most a row an id of A
    late = met.groupBy("row").agg(F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    sums = known.select("row", "n_best", "count_sum").union(late).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return rows.drop("pairs", "times").join(sums, "row").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
