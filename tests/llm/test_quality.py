"""Quality by pairwise ranking: held-out accuracy, junk of unseen kinds, and odd inputs."""

import random
import zlib

import numpy as np
import pytest

from junctura.llm import quality, queries

TABLES = "/root/testdata/sf0.01"
SYLLABLES = {"a": "ka lo mi ren ta su vel no da pir".split(), "b": "schu berg ein ung lich ver ge au tz ßa".split(), "c": "ción que el ado mente los ría ña por un".split()}


def prose(rng, tongue, n=160):
    out, left = [], 0
    for _ in range(n):
        word = "".join(rng.choices(SYLLABLES[tongue], k=rng.choice((1, 1, 2, 2, 3))))
        if left == 0:
            word, left = word.capitalize(), rng.randint(5, 14)
        left -= 1
        out.append(word + (rng.choice(".  .?!").strip() or "." if left == 0 else "," if rng.random() < 0.08 else ""))
    return " ".join(out)


JUNK = {
    "shouting": lambda rng, t: " ".join(w.upper() + "!!" for w in prose(rng, t).split()),
    "stutter": lambda rng, t: " ".join(w for w in prose(rng, t, 12).split() for _ in range(15)),
    "cells": lambda rng, t: " | ".join(prose(rng, t).split()),
    "signs": lambda rng, t: " ".join(w + rng.choice("#$%&*") * 3 for w in prose(rng, t).split()),
    "numbers": lambda rng, t: " ".join(str(rng.randint(1, 10**6)) for _ in range(160)),
    "lines": lambda rng, t: "\n".join([prose(rng, t, 6)] * 30),
}


def sample(tongues, kinds, n, seed):
    rng = random.Random(seed)
    texts = [prose(rng, rng.choice(tongues), rng.randint(60, 260)) for _ in range(n)]
    texts += [JUNK[rng.choice(kinds)](rng, rng.choice(tongues)) for _ in range(n // 5)]
    return texts, np.r_[np.ones(n, int), np.zeros(n // 5, int)]


def test_held_out_labels(spark):
    found = queries.op12_quality(spark, TABLES).toPandas()
    gold = spark.read.parquet(f"{TABLES}/labels.parquet").toPandas().dropna(subset=["quality"])
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    assert len(found) == docs.count() and found["score"].between(0, 1).all() and ((found["score"] >= 0.3) == (found["predicted"] == 1)).all()
    assert (found["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found["doc_id"]]).all()
    held = found[found["held_out"]].merge(gold, on="doc_id")
    assert len(held) > 50 and (held["predicted"] == held["quality"]).mean() >= 0.97


def test_words_of_tongues_without_lessons_count_for_nothing():
    texts, y = sample(["a"], list(JUNK), 300, 1)
    model = quality.fit(np.array([quality.measures(t) for t in texts]), y, 1 / 6)
    texts, y = sample(["b", "c"], list(JUNK), 200, 2)
    right = (model.scores(texts) >= quality.CUT) == (y == 1)
    assert right[y == 1].mean() >= 0.95 and right[y == 0].mean() >= 0.95


def test_pairs_decide_the_order_and_the_quantile_the_threshold():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, len(quality.MEASURES)))
    y = (x[:, 0] - x[:, 3] + 0.1 * rng.normal(size=600) > -1).astype(int)
    share = float((y == 0).mean())
    model = quality.fit(x, y, share)
    z = model.ranks(x)
    assert np.mean(z[y == 1][:, None] > z[y == 0][None]) > 0.99
    assert abs((z < model.cut).mean() - share) < 0.03
    better, worse = quality.pairs(np.arange(5), np.arange(5, 9))
    assert len(set(zip(better.tolist(), worse.tolist()))) == 20
    better, worse = quality.pairs(np.arange(900), np.arange(900, 1000), 5000)
    assert len(better) == len(worse) == 5000 and np.ptp(np.bincount(better)) <= 1 and np.ptp(np.bincount(worse)[900:]) <= 1


def test_quantile():
    z, w = np.array([3.0, 1.0, 2.0, 4.0]), np.ones(4)
    assert [quality.quantile(z, w, s) for s in (0.25, 0.5, 1.0)] == [1.5, 2.5, 4.0]


@pytest.mark.parametrize("text", [None, "", " \n\t", "a", "!", "ß" * 10, "🙂 東京", "word " * 200_000, "x" * 1_000_000, "\n".join("line" for _ in range(50_000)), "\ud800 odd"])
def test_measures_of_odd_texts_are_finite(text):
    found = quality.measures(text)
    assert len(found) == len(quality.MEASURES) and np.isfinite(found).all()


def test_measures_do_not_depend_on_slices(monkeypatch):
    text = prose(random.Random(5), "c", 400)
    whole = quality.measures(text)
    monkeypatch.setattr(quality, "LONG", 64)
    assert np.allclose([a for a, m in zip(quality.measures(text), quality.MEASURES) if m != "evenness of pairs"], [a for a, m in zip(whole, quality.MEASURES) if m != "evenness of pairs"])


def frames(spark, rows, marks):
    docs = spark.createDataFrame([(i, t, "en", 0.0, "z") for i, t in rows], "doc_id long, text string, lang string, score double, label string")
    return docs, spark.createDataFrame(marks, "doc_id long, quality int, score double")


def test_repeats_clashing_columns_and_nulls(spark):
    texts, y = sample(["a", "b"], list(JUNK), 60, 4)
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, None), (1, None), (None, texts[2])]
    docs, marks = frames(spark, rows, [(i, int(q), 0.5) for i, q in enumerate(y)] + [(0, None, None), (None, 1, None), (3, 0, None)])
    model = quality.train(docs, marks)
    found = quality.score(docs, model).toPandas()
    assert len(found) == len(rows) and found["score"].between(0, 1).all() and set(found.columns) == {"doc_id", "text", "lang", "score", "label"}
    assert found[found["doc_id"] == 0]["score"].nunique() == 1


def test_never_learns_from_the_held_out_fold(spark):
    texts, y = sample(["a"], list(JUNK), 80, 6)
    held = [zlib.crc32(str(i).encode()) % 5 == 0 for i in range(len(texts))]
    rows = list(enumerate(texts))
    one = quality.train(*frames(spark, rows, [(i, int(q), None) for i, q in enumerate(y)]))
    two = quality.train(*frames(spark, rows, [(i, int(1 - q if h else q), None) for i, (q, h) in enumerate(zip(y, held))]))
    assert np.array_equal(one.weight, two.weight) and one.cut == two.cut


def test_without_lessons(spark):
    rows = [(1, "one text"), (2, None), (3, "")]
    for marks, want in (([], 0.3), ([(1, 1, None)], 1.0), ([(1, 0, None), (2, None, None)], 0.0)):
        docs, labels = frames(spark, rows, marks)
        assert {r.score for r in quality.score(docs, quality.train(docs, labels)).collect()} == {want}
    docs, labels = frames(spark, rows, [(1, 1, None)])
    assert quality.score(docs.where("false"), quality.train(docs.where("false"), labels)).collect() == []


def test_every_labelled_document_counts(spark, monkeypatch):
    """In many groups as in one, and none of them left out."""
    texts, y = sample(["a", "b"], list(JUNK), 150, 8)
    docs, marks = frames(spark, list(enumerate(texts)), [(i, int(q), None) for i, q in enumerate(y)])
    seen, sums = [], quality.Lessons.sums
    monkeypatch.setattr(quality.Lessons, "sums", lambda self, run, join=np.add: seen.append(self.rows) or sums(self, run, join))
    monkeypatch.setattr(quality, "GROUP", 20)
    monkeypatch.setattr(quality, "RARE", 4)
    monkeypatch.setattr(quality, "FAN", 2)
    model = quality.train(docs, marks)
    assert {r.id for r in seen[0].collect()} == {i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 5}
    assert seen[0].rdd.getNumPartitions() > 2
    right = (model.scores(texts) >= quality.CUT) == (y == 1)
    assert right.mean() >= 0.95


def test_sums_of_few_groups_where_a_session_deals_into_many_parts(spark, monkeypatch):
    texts, y = sample(["a", "b"], list(JUNK), 150, 8)
    docs, marks = frames(spark, list(enumerate(texts)), [(i, int(q), None) for i, q in enumerate(y)])
    kind, groups, found = type(docs), [], quality.Lessons.__init__
    deal = kind.repartition
    monkeypatch.setattr(kind, "repartition", lambda self, n, *keys: deal(self, max(n, 23) if keys else n, *keys))
    monkeypatch.setattr(quality.Lessons, "__init__", lambda self, rows: found(self, rows) or groups.append((self.groups, rows.count())))
    model = quality.train(docs, marks)
    assert groups == [(1, sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(len(texts))))]
    assert ((model.scores(texts) >= quality.CUT) == (y == 1)).mean() >= 0.95


def test_quantile_of_spread_scores(spark):
    rng = np.random.default_rng(9)
    x, y = rng.normal(size=(500, len(quality.MEASURES))), rng.integers(0, 2, 500)
    rows = spark.createDataFrame([(i, int(b), a.tolist()) for i, (a, b) in enumerate(zip(x, y))], "id long, label int, x array<double>").repartition(7)
    each = np.array([0.3, 0.7]) / np.bincount(y)
    for share in (0.01, 0.3, 0.999, 1.0):
        got = quality.spread_quantile(quality.Lessons(rows), lambda a, b: a[:, 2], each, share)
        assert abs(got - quality.quantile(x[:, 2], each[y], share)) < 1e-9
