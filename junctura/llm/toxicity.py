"""Toxicity by weak supervision.

Voters are lexicon entries and patterns: runs of characters anywhere in a text,
words, pairs of words, beginnings of words with their ends, shouting, masked
words. They are found in a bounded sample of labelled rows, by how much they lean
to toxic texts, and each votes on a text or not. A generative label model
estimates every voter's rates in both classes and the correlations between voters
given the class, by expectation maximisation that the gold labels anchor as one
more voter; correlated voters share their weight. A linear classifier is then
trained on the posterior labels and scores every whole text. Beside it ``PARTS``
others are trained, each without a part of the sample; their logits of that part
say where the threshold lies. Its values are
whether a feature is there and how dense it is, so that a few marks count in a
long text too; for that it also sees toxic texts with clean ones appended.

The sample holds at most ``MAX_TRAIN`` labelled documents of each class and
``MAX_BYTES`` of text, chosen by a hash of the identifier. Half of the bytes, and
what the other class leaves of its half, are for each class; a document that
doesn't fit is passed over alone. A class in which none fits has its smallest. Of
near copies in the sample one is used.

Gold labels choose the voters and orient the model, so this is weak supervision
with labels, not without: nothing but the labels says what is toxic.

Defined results: null and empty texts score by the bias alone; labels that are
null teach nothing; an identifier with several labels counts as toxic if one is;
without labels of both classes every score is the prior (0 if there are none).
Only the text is read for a score.
"""

from __future__ import annotations

import math
import pickle
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from junctura.llm import grams
from junctura.llm.common import frugal, give_back, small_batches

MAX_TRAIN = 4000
MAX_BYTES = 20 << 20
FOLDS, HELD_OUT = 5, 0
VOTERS, FEATURES = 200, 20_000
LEAST_DOCS, LEAST_SHARE = 3, 0.004  # toxic texts that hold a feature
LEAN = 3.0  # times as often in toxic texts as in clean ones
DENSE = 50.0  # a feature is fully dense at one in so many words
PRESENT = 2.0  # ... and fully there if it occurs so often; two thirds count for the first time
BUCKETS = 24  # bits of the buckets that rule out features
_SHIFT = np.uint64(grams.BITS - BUCKETS)
PATTERNS = 3
SILENCE = 0.0  # voters abstain where they don't vote: a text in one tongue is silent to those of all others
STEPS = 300
RIDGE = 1e-5
PARTS = 3  # of the sample; each is left out by one of the classifiers
CARE = 0.3  # weight of the toxic class where the threshold is set
HOLD = 0.1  # pull of the threshold's curve to the logits as they are, over the number of toxic texts


def fold(doc_id: Column) -> Column:
    """crc32 of the identifier as text, modulo ``FOLDS``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def patterns(text: str | None) -> list[bool]:
    """Pattern voters of a text as a whole: exclaiming, shouting, masked words."""
    text = text or ""
    upper = sum(map(str.isupper, text))
    return [text.count("!") * 40 > len(text), upper * 3 > len(text) > 0, bool(re.search(r"\w[*#@$%]{2,}\w", text))]


def distinct(texts: list[str], gold: np.ndarray) -> np.ndarray:
    """Places of the texts but for near copies of an earlier one of the same label, by minima over runs of five words."""
    odd = np.random.default_rng(7).integers(0, 2**63, 3, np.uint64) * np.uint64(2) + np.uint64(1)
    seen: set[tuple] = set()
    kept = []
    for i, text in enumerate(texts):
        own = [grams.Text(held).word_hashes()[1] for held in grams.pieces([text])]
        h = np.concatenate(own) if own else np.empty(0, np.uint64)
        with np.errstate(over="ignore"):
            if len(h) > 4:
                h = grams.mixed(sum(h[k : len(h) - 4 + k] * np.uint64(2 * k + 3) for k in range(5)))
            least = [int(grams.mixed(h * m).min()) if len(h) else 0 for m in odd]
        pairs = [(gold[i], k, least[k], least[k - 1]) for k in range(3)]
        if not any(p in seen for p in pairs):
            kept.append(i)
        seen.update(pairs)
    return np.array(kept, int)


def _sketched(texts: list[str], weight: np.ndarray) -> None:
    """Add to each bucket of ``weight`` the number of texts with a feature in it."""
    for some in grams.pieces(texts):
        text = grams.Text(some)
        for at, numbers in text.families():
            bucket = (numbers >> _SHIFT).astype(np.int64) << 12 | text.doc[at] & 4095
            bucket = grams.unique(bucket) >> 12
            first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else bucket
            weight[bucket[first]] += np.diff(np.r_[first, len(bucket)]).astype(np.uint16)


def _supported(toxic: list[str], clean: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features that enough of the toxic texts hold and few of the clean ones, and how many toxic texts do; sorted.

    Counts by bucket rule out nearly all of the features before any is held.
    """
    least = max(min(LEAST_DOCS, max(1, len(toxic) // 4)), math.ceil(LEAST_SHARE * len(toxic)))
    a, b = np.zeros(1 << BUCKETS, np.uint16), np.zeros(1 << BUCKETS, np.uint16)
    _sketched(toxic, a)
    _sketched(clean, b)
    open_ = a >= least
    some = np.flatnonzero(open_)
    open_[some] = a[some].astype(float) * (len(clean) + 1) > 1.5 * len(toxic) * b[some]
    del a, b, some
    held = [np.empty(0, np.uint64)]
    for some in grams.pieces(toxic):
        text = grams.Text(some)
        for at, numbers in text.families():
            own = np.flatnonzero(open_[(numbers >> _SHIFT).astype(np.int64)])
            # 12 bits more tell the texts of a list apart.
            held.append(grams.unique(numbers[own] << np.uint64(12) | text.doc[at[own]].astype(np.uint64) & np.uint64(4095)) >> np.uint64(12))
    numbers, n = np.unique(np.concatenate(held), return_counts=True)
    return numbers[n >= least], n[n >= least]


def _rows(texts: list[str], numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, count) and the number of words of each text."""
    members, words = grams.Members(numbers), np.zeros(len(texts))
    parts = [(np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.float32))]
    for doc, feature, count, first, n in grams.counted(texts, members):
        words[first : first + len(n)] += n
        parts.append(((doc + first).astype(np.int32), feature.astype(np.int32), count.astype(np.float32)))
    return *_summed(*(np.concatenate(x) for x in zip(*parts)), len(numbers)), words


def _summed(doc: np.ndarray, feature: np.ndarray, count: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows by text and feature, those of one text and feature added up."""
    pair = doc.astype(np.int64) * max(1, many) + feature
    if (pair[1:] > pair[:-1]).all():
        return doc, feature, count
    order = np.argsort(pair, kind="stable")
    pair = pair[order]
    first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
    return doc[order][first], feature[order][first], np.add.reduceat(count[order], first)


def _leaning(toxic: list[str], clean: list[str]) -> np.ndarray:
    """Numbers of the features that lean to toxic texts most; sorted."""
    n1, n0 = len(toxic), len(clean)
    numbers, a = _supported(toxic, clean)
    b = np.bincount(_rows(clean, numbers)[1], minlength=len(numbers))
    ratio = ((a + 0.5) / (n1 + 1)) / ((b + 0.5) / (n0 + 1))
    lean = np.where(ratio >= LEAN, a * np.log(ratio), 0)
    best = np.lexsort((numbers, -lean))[:FEATURES]
    return np.sort(numbers[best[lean[best] > 0]])


def _voters(doc: np.ndarray, feature: np.ndarray, toxic: np.ndarray, many: int, n: int) -> np.ndarray:
    """Features one after another, those first that reach the most toxic texts that few of the earlier ones reach, less the clean ones."""
    weight, chosen = np.where(toxic, 1.0, -1.0), []
    order = np.argsort(feature, kind="stable")
    doc, start = doc[order], np.searchsorted(feature[order], np.arange(many + 1))
    feature = feature[order]
    for _ in range(min(n, many)):
        gain = np.bincount(feature, weight[doc], many)
        gain[chosen] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= 0:
            break
        chosen.append(best)
        own = doc[start[best] : start[best + 1]]
        weight[own[toxic[own]]] *= 0.5
    return np.array(chosen, int)


def label_model(votes: np.ndarray, gold: np.ndarray, weight: np.ndarray, prior: float, rounds: int = 10, silence: float = math.inf) -> np.ndarray:
    """Posterior of the toxic class from votes (documents x voters).

    A voter has a rate of voting in each class. Voters whose residuals go
    together within the classes are correlated, and each weighs one over its sum
    of correlations. The gold label is a voter whose accuracy is estimated too.
    Voters that don't vote say ``silence`` at most, together.
    """
    q = np.where(gold == 1, 0.8, 0.2)
    for _ in range(rounds):
        a, b = weight * q, weight * (1 - q)
        one = np.clip((a @ votes + 0.5) / (a.sum() + 1), 1e-4, 1 - 1e-4)
        none = np.clip((b @ votes + 0.05) / (b.sum() + 1), 1e-4, 1 - 1e-4)
        rest = (votes - np.outer(q, one) - np.outer(1 - q, none)) * np.sqrt(weight)[:, None]
        cov = rest.T @ rest
        spread = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        together = np.clip(cov / spread[:, None] / spread[None, :], 0, 1)
        share = 1 / np.maximum(1, np.where(together > 0.1, together, 0).sum(axis=1))
        right = min(0.99, max(0.6, float((weight * np.where(gold == 1, q, 1 - q)).sum() / weight.sum())))
        logit = math.log(prior / (1 - prior)) + np.where(gold == 1, 1, -1) * math.log(right / (1 - right))
        silent = (1 - votes) @ (share * np.log((1 - one) / (1 - none)))
        logit = logit + votes @ (share * np.log(one / none)) + np.clip(silent, -silence, silence)
        q = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return q


class Model:
    """Linear classifier over whether features are there, how dense they are, and the number of words."""

    def __init__(self, bias: float, numbers: np.ndarray | None = None, there: np.ndarray | None = None, dense: np.ndarray | None = None, length: float = 0.0) -> None:
        self.bias, self.length = bias, length
        self.numbers = np.empty(0, np.uint64) if numbers is None else numbers
        self.there, self.dense = (np.zeros(len(self.numbers)) if x is None else x for x in (there, dense))
        self._members: grams.Members | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_members": None}

    def logits(self, texts: list[str | None]) -> np.ndarray:
        if self._members is None:
            self._members = grams.Members(self.numbers)
        total = np.zeros(len(texts))
        words, late = np.zeros(len(texts)), defaultdict(list)
        for doc, feature, count, first, n in grams.counted(texts, self._members):
            words[first : first + len(n)] += n
            late[first].append((doc + first, feature, count, first + len(n)))
        for parts in late.values():
            doc, feature, count = (np.concatenate([p[k] for p in parts]) for k in range(3))
            doc, feature, count = _summed(doc, feature, count, len(self.numbers))  # a text may come in several pieces
            there, dense = _values(count, words[doc])
            total += np.bincount(doc, there * self.there[feature] + dense * self.dense[feature], len(texts))
        return self.bias + self.length * _long(words) + total

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -30, 30)))

    def score(self, text: str | None) -> float:
        return float(self.scores([text])[0])


def _values(count: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.minimum(1.0, (1 + count) / (1 + PRESENT)), np.minimum(1.0, DENSE * count / np.maximum(words, 1))


def _long(words: np.ndarray) -> np.ndarray:
    return np.log1p(words) / 8


def _diluted(doc: np.ndarray, feature: np.ndarray, count: np.ndarray, words: np.ndarray, toxic: np.ndarray, many: int) -> tuple:
    """Rows of toxic texts, each with one or two clean texts appended; numbered on from the last text."""
    clean, own = np.flatnonzero(~toxic), np.flatnonzero(toxic)
    if not len(clean) or not len(own):
        return doc[:0], feature[:0], count[:0], words[:0], own
    rng = np.random.default_rng(42)
    other = [clean[rng.integers(0, len(clean), len(own))] for _ in range(2)]
    start = np.searchsorted(doc, np.arange(len(words) + 1))

    def rows(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = start[which + 1] - start[which]
        at = np.repeat(start[which] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return np.repeat(np.arange(len(which)), n), at

    parts = [rows(w) for w in (own, *other)]
    new = np.concatenate([p[0] for p in parts])
    at = np.concatenate([p[1] for p in parts])
    return *_summed(new.astype(np.int32), feature[at], count[at], many), words[own] + words[other[0]] + words[other[1]], own


def _trained(texts: list[str], y: np.ndarray, prior: float) -> Model:
    """One linear classifier on the label model's posterior."""
    numbers = _leaning([t for t, g in zip(texts, y) if g], [t for t, g in zip(texts, y) if not g])
    if not len(numbers):
        return Model(math.log(prior / (1 - prior)))
    doc, feature, count, words = _rows(texts, numbers)
    many, n = len(numbers), len(texts)

    chosen = _voters(doc, feature, y == 1, many, VOTERS)
    at = np.full(many, -1)
    at[chosen] = np.arange(len(chosen))
    votes = np.zeros((n, 2 * len(chosen) + PATTERNS))
    own = at[feature] >= 0
    votes[doc[own], at[feature[own]]] = 1
    often = own & (DENSE * 4 * count >= words[doc])
    votes[doc[often], len(chosen) + at[feature[often]]] = 1
    votes[:, 2 * len(chosen) :] = [patterns(t) for t in texts]
    # The sample's classes are weighed back to their shares.
    share = np.where(y == 1, prior / max(1, (y == 1).sum()), (1 - prior) / max(1, (y == 0).sum()))
    q = label_model(votes, y, share * n, prior, silence=SILENCE)
    del votes

    more = _diluted(doc, feature, count, words, y == 1, many)
    doc, feature, count = (np.concatenate([x, m]) for x, m in zip((doc, feature, count), (more[0] + np.int32(n), more[1], more[2])))
    words = np.r_[words, more[3]]
    # A toxic text and its diluted form share their weight.
    balance = np.where(y == 1, share / 2, share)
    balance, q = np.r_[balance, balance[more[4]]], np.r_[q, q[more[4]]]
    there, dense = (x.astype(np.float32) for x in _values(count, words[doc]))
    del count
    long = _long(words)
    # Rows lie by text for the logits, and once more by feature for the slopes.
    order = np.argsort(feature, kind="stable")
    by_text, by_feature = (np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) for x in (doc, feature[order]))
    texts_met, met = doc[by_text], feature[order][by_feature]
    doc, there_f, dense_f = doc[order], there[order], dense[order]
    # Weights stay positive, as each feature leans to toxic texts.
    w, bias = np.zeros(2 * many, np.float32), np.array([math.log(prior / (1 - prior)), 0.0])
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros(2), np.zeros(2)
    g = np.zeros_like(w)
    for step in range(1, STEPS + 1):
        z = bias[0] + bias[1] * long
        z[texts_met] += np.add.reduceat(there * w[:many][feature] + dense * w[many:][feature], by_text)
        wrong = balance * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - q)
        back = wrong.astype(np.float32)[doc]
        g[met], g[many + met] = np.add.reduceat(there_f * back, by_feature), np.add.reduceat(dense_f * back, by_feature)
        g += np.float32(RIDGE) * w
        gb = np.array([wrong.sum(), wrong @ long])
        m, v = np.float32(0.9) * m + np.float32(0.1) * g, np.float32(0.99) * v + np.float32(0.01) * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        fix = 0.05 * math.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        w = np.maximum(np.float32(0), w - np.float32(fix) * m / (np.sqrt(v) + np.float32(1e-8)))
        bias = bias - 2 * fix * mb / (np.sqrt(vb) + 1e-8)
    w = w.astype(float)
    used = np.flatnonzero(w[:many] + w[many:] > 1e-4)
    return Model(float(bias[0]), numbers[used], w[used], w[many + used], float(bias[1]))


def left_out(texts: list[str], gold: list[int], prior: float, part: int) -> tuple[Model, np.ndarray, np.ndarray]:
    """A classifier of all parts of the sample but one (of all if ``part`` is ``PARTS``), and that one's logits and labels."""
    y = np.array(gold)
    kept = distinct(texts, y)
    texts, y = [texts[i] for i in kept], y[kept]
    # Each class is dealt over the parts in turn.
    turn = np.empty(len(y), int)
    for label in (0, 1):
        turn[y == label] = np.arange((y == label).sum()) % PARTS
    rest, own = np.flatnonzero(turn != part), np.flatnonzero(turn == part)
    if len(set(y[rest].tolist())) < 2:
        rest = np.arange(len(y))
    model = _trained([texts[i] for i in rest], y[rest], prior)
    return model, model.logits([texts[i] for i in own]), y[own]


def joined(found: list[tuple[Model, np.ndarray, np.ndarray]]) -> Model:
    """The last classifier, that of the whole sample, set right by a logistic curve through the logits that the others gave to texts they hadn't seen."""
    whole = found[-1][0]
    z, y = (np.concatenate([f[k] for f in found]) for k in (1, 2))
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    slope, shift = 1.0, 0.0
    if n1 and n0:
        weight = np.where(y == 1, CARE / n1, (1 - CARE) / n0)
        target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        # Newton's steps; the curve is held near the logits as they are where there are few texts.
        hold = HOLD / n1
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(slope * z + shift, -30, 30)))
            d, h = weight * (p - target), weight * p * (1 - p) + 1e-9
            g = np.array([d @ z + hold * (slope - 1), d.sum() + hold * shift])
            hessian = np.array([[h @ (z * z) + hold, h @ z], [h @ z, h.sum() + hold]])
            step = np.linalg.solve(hessian, g)
            step *= min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
            slope, shift = max(0.05, slope - step[0]), shift - step[1]
    return Model(shift + slope * whole.bias, whole.numbers, slope * whole.there, slope * whole.dense, slope * whole.length)


def fit(texts: list[str], gold: list[int], prior: float) -> Model:
    """Train on a sample of texts with gold labels; ``prior`` is the share of toxic ones in all labels."""
    if len(set(gold)) < 2:
        return Model(math.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
    return joined([left_out(texts, gold, prior, part) for part in range(PARTS + 1)])


def fitting(sample: list, size: dict[int, int]) -> list:
    """The rows (id, label) of the sample whose texts, ``size`` bytes an id, fit ``MAX_BYTES``."""
    own: dict[int, list] = defaultdict(list)
    for r in sorted((r for r in sample if r.id in size), key=lambda r: zlib.crc32(str(r.id).encode())):
        own[r.label].append(r)
    rows, left = [], MAX_BYTES
    # The class with less text goes first and leaves the rest of its half.
    for k, label in enumerate(sorted(own, key=lambda c: (sum(size[r.id] for r in own[c]), c))):
        room, taken = left if k else left // 2, 0
        for r in own[label]:
            if taken + size[r.id] <= room:
                rows.append(r)
                taken += size[r.id]
        if not taken and all(r.label != label for r in rows):
            rows.append(min(own[label], key=lambda r: size[r.id]))
        left -= min(left, taken)
    return rows


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on labelled rows outside the held-out fold."""
    key = labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
    key = key.where("id is not null and label in (0, 1)").where(fold(F.col("id")) != HELD_OUT).groupBy("id").agg(F.max("label").alias("label"))
    share = {r.label: r["count"] for r in key.groupBy("label").count().collect()}
    if not share:
        return Model(-30.0)
    order = F.xxhash64("id")
    sample = key.where("label = 1").orderBy(order, "id").limit(MAX_TRAIN).union(key.where("label = 0").orderBy(order, "id").limit(MAX_TRAIN)).collect()
    spark = docs.sparkSession
    text = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def chosen(rows: list) -> DataFrame:
        # At most twice MAX_TRAIN rows are broadcast.
        return text.join(F.broadcast(spark.createDataFrame([tuple(r) for r in rows], "id long, label int")), "id")

    sizes = chosen(sample).groupBy("id").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("n")).collect()
    rows = fitting(sample, {r.id: r.n for r in sizes})
    prior = min(max(share.get(1, 0) / sum(share.values()), 1e-3), 1 - 1e-3)
    if len({r.label for r in rows}) < 2:
        return Model(-30.0 if not share.get(1) else 30.0 if not share.get(0) else math.log(prior / (1 - prior)))
    small_batches(spark)

    @frugal
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = defaultdict(list)
        for batch in batches:
            for part, *row in zip(*(c.to_pylist() for c in batch.columns)):
                held[part].append(row)
        for part, own in held.items():
            own.sort(key=lambda r: (zlib.crc32(str(r[0]).encode()), r[0], r[2] or ""))
            found = left_out([r[2] for r in own], [r[1] for r in own], prior, part)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([pickle.dumps(found)], pa.binary())], ["part", "found"])

    # Each task has the whole sample, of at most MAX_BYTES.
    dealt = chosen(rows).select(F.explode(F.sequence(F.lit(0), F.lit(PARTS))).alias("part"), "id", "label", "text")
    found = dealt.repartitionById(PARTS + 1, F.col("part")).mapInArrow(parts, "part int, found binary").collect()
    return joined([pickle.loads(bytes(r.found)) for r in sorted(found, key=lambda r: r.part)])


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text. The model has at most ``FEATURES`` features."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(text: pd.Series) -> pd.Series:
        scores = pd.Series(sent.value.scores(text.tolist()))
        give_back()
        return scores

    return docs.withColumn(out, scored(F.col(f"`{text_col}`")))
