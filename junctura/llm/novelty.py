"""Secret scan: fixed patterns, and dictionary-primed compression novelty.

A candidate is a long string of key characters that stands shortly after a
sensitive word. Its novelty is the number of bytes that it adds when the code
around it is compressed with zstandard, primed with a dictionary of common code
and of the words that identifiers and prose of the corpus are made of. That is
held against what random strings of the same kinds of characters and the same
length add in the same place: strings that compress hardly better are reported as
``novel`` beside the spans of the fixed patterns, which always stay.

The dictionary's words are those that most documents hold, counted over all of
them, ``WORDS`` at most, as many as a dictionary has room for.

Defined results: null and empty texts have no spans; whole texts are read, with
positions in code points; repeated rows are repeated.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from junctura.llm.common import small_batches

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
_WORDS = ("password", "passwd", "secret", "token", "api")
_HEX = bytes(104 if c in b"0123456789abcdef" else 32 for c in range(256))

SENSITIVE = re.compile(r"password|passwd|secret|token|api[ _-]?key|passphrase|passcode|pwd|credential|bearer|authorization|private[ _-]?key|access[ _-]?key|client[ _-]?id|signature|session|cookie|jwt|auth|\bkey\b", re.I | re.A)
_HINTS = ("pass", "secret", "token", "pwd", "credential", "bearer", "auth", "key", "client", "signature", "session", "cookie", "jwt")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
REACH = 64  # code points after a sensitive word in which a candidate may begin
AROUND = 200  # code points of surrounding text that prime the compressor
NOVEL = 0.75  # of the bytes that a random string adds
WORDS, DICTIONARY_BYTES = 8192, 1 << 16
KINDS_OF_CHARACTERS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "+/_=-")
DRAWS = 3  # random strings that a candidate is held against

# Words and identifiers common in code and configuration.
DICTIONARY = (
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 "
    "import from return class function const public private static void string int float double boolean "
    "self this null none true false export default require module package include define struct typedef "
    "password passwd secret token api_key apikey access_key private_key client_id client_secret username user "
    "authorization bearer basic auth session cookie signature credential certificate config settings environment "
    "http https localhost example com org net server host port path url uri request response header content type "
    "application json text html charset utf-8 database connection timeout version 1.0.0 2.0.0 2023 2024 2025 "
    "getElementById addEventListener createElement toString hashCode equals println printf console log error warning debug info"
).encode()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, leftmost and non-overlapping per kind."""
    out, low = [], text.lower()
    if any(w in low for w in _WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    raw, need = text.encode("utf-8", "surrogatepass"), b"h" * LEAST["hex"]
    mask = raw.translate(_HEX)
    at, chars, seen = mask.find(need), 0, 0
    while at >= 0:
        end = at + LEAST["hex"]
        while end < len(mask) and mask[end] == 104:
            end += 1
        chars += len(raw[seen:at].decode("utf-8", "surrogatepass"))
        out.append((chars, 2, chars + end - at))
        chars, seen = chars + end - at, end
        at = mask.find(need, end)
    return sorted(out)


def dictionary(words: list[str]) -> bytes:
    """What primes the compressor: words, the most frequent last, where they are nearest, and the fixed ones behind."""
    kept, size = [], len(DICTIONARY) + 1
    for word in words:
        own = " ".join(dict.fromkeys((word, word.capitalize()))).encode()
        if size + len(own) + 1 > DICTIONARY_BYTES:
            break
        kept.append(own)
        size += len(own) + 1
    return b" ".join([*reversed(kept), DICTIONARY])


class Novelty:
    """Marginal compressed bytes of a string against its surroundings, by those of random strings."""

    def __init__(self, primer: bytes = DICTIONARY) -> None:
        primed = zstandard.ZstdCompressionDict(primer, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(level=9)
        self.packer = zstandard.ZstdCompressor(level=9, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False)

    def rate(self, text: str, start: int, end: int) -> float:
        around = (text[max(0, start - AROUND) : start] + text[end : end + AROUND]).encode("utf-8", "surrogatepass")
        own = text[start:end]
        plain = len(self.packer.compress(around))
        letters = "".join(k for k in KINDS_OF_CHARACTERS if any(c in k for c in own))
        draw = random.Random(own)
        cost = [len(self.packer.compress(around + "".join(draw.choices(letters, k=len(own))).encode())) - plain for _ in range(DRAWS)]
        return (len(self.packer.compress(around + own.encode())) - plain) / max(1.0, sum(cost) / DRAWS)


def novel_spans(text: str, base: list[tuple[int, int, int]], novelty: Novelty) -> list[tuple[int, int, int]]:
    """Spans in sensitive surroundings that hardly compress and touch no base span."""
    low = text.lower()
    if not any(w in low for w in _HINTS):
        return []
    seen: dict[int, int] = {}  # start by end; of several in one string the last
    # Strings of key characters that were read: where they begin and end, and where the value after the last = begins.
    begins, ends, names = [], [], []
    for word in SENSITIVE.finditer(text):
        till = word.end() + REACH
        # The least candidate that begins in reach ends within 16 characters more.
        for m in CANDIDATE.finditer(text, word.end(), till + 16):
            if m.start() > till:
                break
            # A string is read to its end once, however many words are in it.
            i = bisect_right(ends, m.start())
            if i == len(ends) or m.start() < begins[i]:
                own = CANDIDATE.match(text, m.start())[0]
                begins.insert(i, m.start())
                ends.insert(i, m.start() + len(own))
                names.insert(i, m.start() + own.rstrip("=").rfind("=") + 1)
            # In NAME_KEY=value the value is the candidate, if it is one itself.
            end = ends[i]
            at = max(m.start(), names[i]) if end - names[i] >= 16 else m.start()
            if at > seen.get(end, -1):
                seen[end] = at
    starts = [s for s, _, _ in base]
    reach = list(accumulate((e for _, _, e in base), max))
    out = []
    for end, start in seen.items():
        own = text[start:end]
        mixed = re.search(r"[0-9]", own) and re.search(r"[A-Za-z]", own)
        # Of the base spans that begin before the end none may reach beyond the start.
        before = bisect_left(starts, end)
        free = not before or reach[before - 1] <= start
        if mixed and free and novelty.rate(text, start, end) >= NOVEL:
            out.append((start, 3, end))
    return sorted(out)


def _said(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def ordinary(docs: DataFrame, text_col: str = "text") -> list[str]:
    """Words of three letters or more in all documents, by how many hold them; parts of identifiers are words."""
    apart = F.regexp_replace(F.col(f"`{text_col}`"), "([a-z])([A-Z])", "$1 $2")
    words = F.array_distinct(F.transform(F.regexp_extract_all(apart, F.lit("[A-Za-z]{3,20}"), F.lit(0)), F.lower))
    met = docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return [r.word for r in met.where("n > 1").orderBy(F.desc("n"), "word").limit(WORDS).collect()]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256 (digest of the base spans) and spans (all of them)."""
    small_batches(docs.sparkSession)
    primer = dictionary(ordinary(docs, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(primer)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                every = sorted(base + novel_spans(text or "", base, novelty))
                said = _said(base)
                rows.append((*(sum(k == i for _, k, _ in base) for i in range(3)), hashlib.sha256(said.encode()).hexdigest(), _said(every)))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    pair = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return pair.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
