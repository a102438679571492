"""Vector codes against plain Lloyd rounds on whole numbers."""

import hashlib
import math

import numpy as np
import pytest

from junctura.llm import vectorcodes

SCHEMA = "vec_id long, embedding array<float>, label int, code string"


def plain(rows, parts=8, entries=16, rounds=6):
    """{place of a kept row: (vec_id, code, error, label_error)} and the digest."""
    kept = [(i, a, [math.floor(4096 * x) for x in v], c) for i, (a, v, c) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    lengths = [len(r[2]) for r in kept]
    size = min(set(lengths), key=lambda n: (-lengths.count(n), n)) if kept else 0
    kept = [r for r in kept if len(r[2]) == size]
    first = sorted(kept, key=lambda r: (r[1] is None, r[1] or 0, r[2]))[:entries]
    ends = np.cumsum([size // parts + (p < size % parts) for p in range(parts)]).tolist()
    cut = [slice(i, j) for i, j in zip([0, *ends[:-1]], ends)]
    books = [[r[2][at] for r in first] for at in cut]
    far = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y))
    near = lambda x, book: min(range(len(book)), key=lambda e: (far(x, book[e]), e))
    for _ in range(rounds):
        for p, at in enumerate(cut):
            own = [near(r[2][at], books[p]) for r in kept]
            for e in range(len(books[p])):
                members = [r[2][at] for r, o in zip(kept, own) if o == e]
                if members:
                    books[p][e] = [sum(c) // len(members) for c in zip(*members)]
    out = {}
    for i, a, v, c in kept:
        own = [near(v[at], books[p]) for p, at in enumerate(cut)]
        out[i] = [a, "".join(f"{e:02x}" for e in own), sum(far(v[at], books[p][own[p]]) for p, at in enumerate(cut)), c]
    total = {}
    for _, _, error, c in out.values():
        total[c] = total.get(c, 0) + error
    told = ",".join(str(x) for book in books for entry in book for x in entry)
    digest = hashlib.sha256(told.encode()).hexdigest()
    return sorted(((a, code, error, total[c], digest) for a, code, error, c in out.values()), key=str)


def got(spark, rows, **settings):
    frame = spark.createDataFrame([(a, v, c, "x") for a, v, c in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in vectorcodes.codes(frame, **settings).collect()), key=str)


def clustered(seed, n, size, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(7, size))
    return [(int(i) * 3, (centres[i % 7] + spread * rng.normal(size=size)).astype("f4").tolist(), [0, 1, None][i % 3]) for i in rng.permutation(n)]


@pytest.mark.parametrize("size", [64, 19, 8])
def test_codes_are_the_plain_ones(spark, size, monkeypatch):
    monkeypatch.setattr(vectorcodes, "BLOCK_BYTES", 4 * size * 37)
    assert got(spark, clustered(1, 400, size)) == plain(clustered(1, 400, size))


def test_ties_repeats_and_broken_vectors(spark):
    rng = np.random.default_rng(2)
    grid = [(int(rng.integers(0, 40)), (rng.integers(-2, 3, 16) / 4096).tolist(), int(rng.integers(0, 2))) for _ in range(300)]
    broken = [(1, None, 0), (2, [0.5, None] * 8, 0), (3, [float("nan")] * 16, None), (4, [float("inf")] + [0.0] * 15, 1), (5, [], 1), (6, [0.1] * 5, 0), (None, [0.25] * 16, None)]
    assert got(spark, grid + broken + grid[:50]) == plain(grid + broken + grid[:50])


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=8) * 10.0 ** (i % 3 * 2)).astype("f4").tolist(), None) for i in range(40)]
    assert got(spark, rows) == plain(rows)
    assert vectorcodes.exact(np.array([[1e12, 3.0]])).dtype == object and vectorcodes.exact(np.array([[5.0, 3.0]])).dtype == np.int64


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_vectors(spark, n):
    rows = clustered(3, n, 16)
    assert got(spark, rows) == plain(rows)


def test_bounds_pass_over_most_entries():
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(6, 8))[rng.integers(0, 6, 3000)] * 4096 + rng.normal(size=(3000, 8)) * 60).astype(np.int64)
    book = x[:16].copy()
    near, up, low, computed = vectorcodes.assign(x, book)
    assert computed == 3000 * 16
    for _ in range(5):
        total, count = vectorcodes._sums(x, near, 16)
        new = np.array([[t // n for t in row] if n else old for row, n, old in zip(total.tolist(), count.tolist(), book.tolist())], np.int64)
        near, up, low, computed = vectorcodes.assign(x, new, vectorcodes.shifted(near, up, low, book, new))
        full = ((x[:, None] - new[None]) ** 2).sum(-1)
        assert (near == full.argmin(1)).all() and (up**2 >= full.min(1)).all() and (low**2 <= full).all()
        book = new
    assert computed < 3000 * 16 // 3


def test_two_digits_for_each_part(spark):
    rows = clustered(6, 60, 12)
    assert got(spark, rows, parts=3, entries=20, rounds=2) == plain(rows, 3, 20, 2)
