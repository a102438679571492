"""Alignment of two tokenizers against a plain walk over whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from junctura.llm import alignment

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
ODD = [
    None, "", " ", "\n", "a", "one two  three\tfour\n five", "<|endoftext|> and <s> </s> <unk> <0x41>", "a ▁ b", "▁", "don't we'll   'tis", "ünïcödé straße 東京 は  いい 🙂 é ́x  y 　z",
    "x" * 5000, "ab" * 3000 + " " + "é" * 2000, "1234567 89.5e-3 $%&! ...", " leading and trailing ", " em space ", "nul \x00 here", "\r\n\r\n  indented\n\n\n", "word " * 3000,
]


@pytest.fixture(scope="module")
def tokenizers():
    return alignment.Tokenizers(*PATHS)


def plain(text, told):
    """Groups of ids of one text, encoded whole."""
    if not text:
        return []
    a = told.a.encode(" " + text, add_special_tokens=False).ids
    b = told.b.encode(text)
    spell = lambda s, i: bytes(s.flat[s.starts[i] : s.starts[i] + s.lengths[i]])
    one, two = [spell(told.spelled_a, i) for i in a], [spell(told.spelled_b, i) for i in b]
    if not b"".join(one) == b"".join(two) == b" " + text.encode():
        return []
    out, i, j, at, to, own = [], 0, 0, 0, 0, ([], [])
    while i < len(a) or j < len(b):
        if at <= to and i < len(a):
            own[0].append(a[i])
            at += len(one[i])
            i += 1
        else:
            own[1].append(b[j])
            to += len(two[j])
            j += 1
        if at == to:
            out.append(own)
            own = ([], [])
    return out


def plain_counts(texts, told):
    groups = [plain(t, told) for t in texts]
    links = [Counter((x, y) for one, two in g for x in one for y in two) for g in groups]
    count = Counter(p for own in links for p in own)
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    rows = []
    for g, own in zip(groups, links):
        told_groups = ";".join(f"{','.join(map(str, one))}|{','.join(map(str, two))}" for one, two in g)
        rows.append((
            sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(own.values()), sum(n for p, n in own.items() if count[p] == best[p[0]]),
            sum(n * count[p] for p, n in own.items()), hashlib.sha256(told_groups.encode()).hexdigest() if g else "",
        ))
    return rows


def invented(seed, n=60):
    rng = random.Random(seed)
    letters = "abcdefghij éßñ    \n\t.,'<>|0123▁東🙂"
    return ["".join(rng.choices(letters, k=rng.randint(0, 300))) for _ in range(n)]


def got(spark, texts, **more):
    rows = spark.createDataFrame([(i, t, 0, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_a int, pairs string")
    found = alignment.link_counts(rows, *PATHS, **more).collect()
    assert len(found) == len(texts)
    return [tuple(r)[1:] for r in sorted(found, key=lambda r: r.doc_id)]


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 20, 0])
def test_links_are_the_plain_ones(spark, tokenizers, frequent):
    texts = ODD + invented(1) + ["the same words again and again"] * 40
    assert got(spark, texts, frequent=frequent) == plain_counts(texts, tokenizers)


def test_documents_of_the_table(spark, tokenizers):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    found = {r.doc_id: tuple(r)[1:] for r in alignment.link_counts(docs, *PATHS).collect()}
    assert found == dict(zip((r.doc_id for r in rows), plain_counts([r.text for r in rows], tokenizers)))


def test_long_groups_and_small_runs(tokenizers, monkeypatch):
    texts = ODD + invented(2)
    whole = alignment.aligned(texts, tokenizers)
    monkeypatch.setattr(alignment, "EXPANDED", 7)
    monkeypatch.setattr(alignment, "LARGE", 2)
    monkeypatch.setattr(alignment, "TOGETHER", 16)
    assert all(x.equals(y) for x, y in zip(whole, alignment.aligned(texts, tokenizers)))


def test_bitsets_have_the_shared_cuts():
    rng = np.random.default_rng(3)
    for _ in range(50):
        cut = np.flatnonzero(rng.random(500) < 0.3)
        a, b = (np.unique(np.r_[cut[rng.random(len(cut)) < 0.7], 499]) + 1 for _ in range(2))
        shared, upto_a, upto_b = alignment.groups(np.diff(a, prepend=0), np.diff(b, prepend=0))
        assert shared.tolist() == np.intersect1d(a, b).tolist()
        assert upto_a.tolist() == [int((a <= s).sum()) for s in shared] and upto_b.tolist() == [int((b <= s).sum()) for s in shared]


def test_repeated_and_null_identifiers_and_an_empty_table(spark):
    rows = spark.createDataFrame([(1, "to be"), (1, "to be"), (None, "to be"), (2, None)], "doc_id long, text string")
    found = alignment.link_counts(rows, *PATHS).collect()
    assert sorted((r.doc_id or 0, r.count_sum) for r in found) == [(0, 6), (1, 6), (1, 6), (2, 0)]
    assert alignment.link_counts(rows.where("false"), *PATHS).collect() == []
