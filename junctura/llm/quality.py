"""Quality of documents by pairwise ranking.

A document is described by measures of its make-up: lengths, kinds of characters,
how words begin and end, how much is repeated, how evenly characters are used.
None of them knows a language's words. Each measure enters as it is and as the
bin, between quantiles of the sample, that it lies in, so its effect need not be
straight. A Bradley-Terry model gives each document a score, linear in these; it
is learnt from preference pairs, a good document over a poor one, by the logistic
loss of the differences of their features, in Newton's steps.

Documents are judged by a quantile of the scores: the share of poor ones among the
labels. The quantile is taken over scores that labelled documents get from models
which never saw them. A score of ``CUT`` stands at that quantile.

All labelled documents outside the held-out fold are learnt from. Their measures
are dealt into groups of about ``GROUP`` rows; each group draws its pairs, in which
every one of its documents stands, and each of Newton's steps adds up the groups'
gradients and curvatures. Bins, means and the quantile are counts and sums over
all of them too. The driver gets sums alone. Every row is scored by its whole text,
and by nothing else.

Defined results: null and empty texts have the measures of no words and are scored
by them; labels that are null teach nothing; an identifier with several labels is
good if one says so, one with several texts teaches by the least of them;
without labels of both classes every score is 1, 0, or ``CUT`` if there are none.
Repeated rows are scored each; other columns aren't read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from junctura.llm.common import checkpointed, frugal, give_back, small_batches
from junctura.llm.toxicity import HELD_OUT, fold

GROUP = 16_384  # labelled documents that are paired together
RARE = 64  # documents of the rarer class that a group has, on average, at least
PAIRS = 60_000  # of a group; more where a group is larger
GRAIN = 4096  # bins in which measures and scores are counted
FAN = 16  # groups whose sums are added up before the driver gets them
BINS = 8
RIDGE = 1e-3
STEPS = 12
PARTS = 3  # of the labelled documents; each is scored by a model of the others
CUT = 0.3
LONG = 1 << 22  # characters whose classes are found at once

_LOWER, _UPPER, _OTHER, _DIGIT, _SPACE, _STOP, _COMMA, _SIGN = range(8)


@cache
def _classes() -> np.ndarray:
    """Kind of every code point."""
    out = np.full(0x110000, _SIGN, np.uint8)
    for c in range(0x110000):
        s = chr(c)
        if s.isspace():
            out[c] = _SPACE
        elif s.isalpha():
            out[c] = _LOWER if s.islower() else _UPPER if s.isupper() else _OTHER
        elif s.isnumeric():
            out[c] = _DIGIT
    for kind, signs in ((_STOP, ".!?…。"), (_COMMA, ",;:、'\"()-")):
        out[[ord(s) for s in signs]] = kind
    return out


def _code(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _evenness(numbers: np.ndarray) -> float:
    """Entropy in bits."""
    n = numbers[numbers > 0]
    total = n.sum()
    return float(math.log2(total) - (n * np.log2(n)).sum() / total) if total else 0.0


def _distinct(numbers: np.ndarray) -> float:
    if not len(numbers):
        return 1.0
    numbers = np.sort(numbers)
    return float(1 + (numbers[1:] != numbers[:-1]).sum()) / len(numbers)


MEASURES = (
    "log words", "log characters", "mean length", "spread of lengths", "longest word", "short words", "lower", "upper", "other letters", "digits", "space", "stops", "commas", "signs",
    "distinct", "distinct per root", "top word", "equal neighbours", "distinct pairs", "distinct triples", "upper words", "begin upper", "begin sign", "end stop", "end comma", "end sign",
    "end two signs", "words a stop", "words a line", "distinct lines", "lines without stop", "evenness", "evenness of pairs", "top sign",
)


def measures(text: str | None) -> list[float]:
    """The values of ``MEASURES`` for a whole text."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return [0.0] * len(MEASURES)
    table, kinds = _classes(), np.zeros(8)
    single, double, signs = np.zeros(1 << 12), np.zeros(1 << 12), np.zeros(1 << 12)
    for i in range(0, len(text), LONG):
        code = _code(text[i : i + LONG])
        kind = table[code]
        kinds += np.bincount(kind, minlength=8)
        low = (code & 4095).astype(np.int64)
        single += np.bincount(low, minlength=1 << 12)
        double += np.bincount((low[1:] * 61 + low[:-1]) & 4095, minlength=1 << 12)
        signs += np.bincount(low[kind == _SIGN], minlength=1 << 12)
    known: dict[str, int] = {}
    own = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    many = len(known)
    length = np.fromiter(map(len, words), np.int64, n)
    begin, end = table[_code("".join([w[0] for w in words]))], table[_code("".join([w[-1] for w in words]))]
    before = table[_code("".join([w[-2] if len(w) > 1 else "a" for w in words]))]
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    last = table[_code("".join([x.rstrip()[-1] for x in lines]))]
    size, stops = kinds.sum(), int((end == _STOP).sum())
    pairs = own[1:] * many + own[:-1]
    return [
        math.log1p(n), math.log1p(size), float(length.mean()), float(length.std()), math.log1p(int(length.max())), float((length <= 3).mean()), *(kinds / size).tolist(),
        many / n, many / math.sqrt(n), float(np.bincount(own).max()) / n, float((own[1:] == own[:-1]).mean()) if n > 1 else 0.0, _distinct(pairs), _distinct(pairs[1:] * 31 + own[:-2] * 1_000_003) if n > 2 else 1.0,
        sum(map(str.isupper, words)) / n, float((begin == _UPPER).mean()), float((begin >= _STOP).mean()), stops / n, float((end == _COMMA).mean()), float((end == _SIGN).mean()),
        float(((end >= _STOP) & (before >= _STOP)).mean()), math.log1p(n / (stops + 1)), math.log1p(n / len(lines)), len(set(lines)) / len(lines), float((last != _STOP).mean()),
        _evenness(single), _evenness(double), float(signs.max()) / size,
    ]


class Model:
    """Scores from measures: linear in the measures and the bins that they lie in."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, edges: np.ndarray, weight: np.ndarray, cut: float = 0.0) -> None:
        self.mean, self.scale, self.edges, self.weight, self.cut = mean, scale, edges, weight, cut

    def wide(self, x: np.ndarray) -> np.ndarray:
        """Measures as they are, within bounds, and a column for each edge that a measure lies beyond."""
        plain = np.clip((x - self.mean) / self.scale, -4, 4)
        return np.concatenate([plain, (x[:, :, None] > self.edges[None]).reshape(len(x), self.edges.size)], axis=1)

    def ranks(self, x: np.ndarray) -> np.ndarray:
        return self.wide(x) @ self.weight

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        z = self.ranks(np.array([measures(t) for t in texts])) - self.cut + math.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Constant:
    """The same score for all."""

    def __init__(self, value: float) -> None:
        self.value = value

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return np.full(len(texts), self.value)


def pairs(good: np.ndarray, poor: np.ndarray, most: int = PAIRS) -> tuple[np.ndarray, np.ndarray]:
    """Preference pairs, each document of either side as often as others of its side; all pairs where they are few."""
    if len(good) * len(poor) <= most:
        return np.repeat(good, len(poor)), np.tile(poor, len(good))
    rng = np.random.default_rng(42)
    deal = lambda side: np.concatenate([rng.permutation(side) for _ in range(-(-most // len(side)))])[:most]
    return deal(good), deal(poor)


def ranked(x: np.ndarray, y: np.ndarray) -> Model:
    """A Bradley-Terry model of the measures ``x`` with labels ``y``."""
    edges = np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    model = Model(x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9), edges, np.zeros(0))
    wide = model.wide(x)
    better, worse = pairs(np.flatnonzero(y == 1), np.flatnonzero(y == 0))
    w = np.zeros(wide.shape[1])
    for _ in range(STEPS):
        g, h = RIDGE * w, RIDGE * np.eye(len(w))
        z = wide @ w
        for i in range(0, len(better), 8192):
            d = wide[better[i : i + 8192]] - wide[worse[i : i + 8192]]
            p = 1 / (1 + np.exp(np.clip((z[better] - z[worse])[i : i + 8192], -30, 30)))
            g = g - d.T @ p / len(better)
            h = h + (d * (p * (1 - p))[:, None]).T @ d / len(better)
        step = np.linalg.solve(h, g)
        far = float(np.abs(wide @ step).max())
        w = w - step * min(1.0, 3.0 / max(1e-9, far))
        if far < 1e-3:
            break
    model.weight = w
    return model


def quantile(z: np.ndarray, weight: np.ndarray, share: float) -> float:
    """The score below which lies ``share`` of the weight, midway to the next."""
    order = np.argsort(z, kind="stable")
    z, upto = z[order], np.cumsum(weight[order]) / weight.sum()
    k = int(np.searchsorted(upto, share - 1e-9))
    return float((z[k] + z[min(k + 1, len(z) - 1)]) / 2)


def fit(x: np.ndarray, y: np.ndarray, share: float) -> Model:
    """Learn from measures and labels of a sample; ``share`` of all labels are poor."""
    turn = np.empty(len(y), int)
    for label in (0, 1):
        turn[y == label] = np.arange((y == label).sum()) % PARTS
    whole, z = ranked(x, y), np.empty(len(y))
    centre = lambda m, own: float(np.mean([m.ranks(x[own & (y == c)]).mean() for c in (0, 1)]))
    for part in range(PARTS):
        rest, own = turn != part, turn == part
        if not own.any():
            continue
        model = ranked(x[rest], y[rest]) if len(set(y[rest].tolist())) == 2 else whole
        # Scores of a pairwise model have no zero of their own; the models' centres are put together.
        z[own] = model.ranks(x[own]) - centre(model, rest if model is not whole else rest | own)
    weight = np.where(y == 1, (1 - share) / (y == 1).sum(), share / (y == 0).sum())
    whole.cut = quantile(z, weight, share) + centre(whole, np.ones(len(y), bool))
    return whole


class Lessons:
    """Measures of all labelled documents in groups, a partition each, and sums over them."""

    def __init__(self, rows: DataFrame) -> None:
        self.rows, self.groups = rows, rows.rdd.getNumPartitions()

    def sums(self, run: Callable[[np.ndarray, np.ndarray], list[np.ndarray]], join: Callable = np.add) -> list[np.ndarray]:
        """Arrays that ``run`` (measures, labels) makes of every group, put together in the groups' order."""
        shapes = [a.shape for a in run(np.zeros((0, len(MEASURES))), np.zeros(0, int))]

        @frugal
        def of_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(list(batches), _LESSON).sort_by("id")
            if table.num_rows:
                x = table.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(MEASURES))
                found = np.concatenate([np.ravel(a).astype(float) for a in run(x, table.column("label").to_numpy())])
                yield pa.RecordBatch.from_arrays([table.column("id").slice(0, 1).combine_chunks(), pa.array([found.tobytes()], pa.binary())], ["id", "own"])

        def together(rows: list[tuple[int, bytes]]) -> np.ndarray:
            return reduce(join, (np.frombuffer(own) for _, own in sorted(rows)))

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = [(i, own) for b in batches for i, own in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([min(rows)[0]]), pa.array([together(rows).tobytes()], pa.binary())], ["id", "own"])

        found = self.rows.mapInArrow(of_group, "id long, own binary")
        if self.groups > FAN:
            found = found.repartition(-(-self.groups // FAN)).mapInArrow(added, "id long, own binary")
        flat, out = together([(r.id, bytes(r.own)) for r in found.collect()]), []
        for shape in shapes:
            n = math.prod(shape)
            out.append(flat[:n].reshape(shape))
            flat = flat[n:]
        return out


_LESSON = pa.schema([("id", pa.int64()), ("label", pa.int32()), ("x", pa.list_(pa.float64()))])


def _turns(y: np.ndarray) -> np.ndarray:
    """Parts that documents of a group belong to, of each class in turn."""
    turn = np.empty(len(y), int)
    for label in (0, 1):
        turn[y == label] = np.arange((y == label).sum()) % PARTS
    return turn


def _counted(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """How many rows lie in each of ``GRAIN`` bins between ``low`` and ``high``, by column; those beyond are in the bins at the ends."""
    at = np.clip((x - low) / np.maximum(high - low, 1e-300) * GRAIN, 0, GRAIN - 1).astype(int)
    return np.stack([np.bincount(at[:, k], minlength=GRAIN) for k in range(x.shape[1])])


def features(lessons: Lessons) -> Model:
    """A model without weights: means, deviations and bins of all labelled documents."""
    n, total = lessons.sums(lambda x, y: [np.array([len(x)]), x.sum(axis=0)])
    mean = total / n
    square = lessons.sums(lambda x, y: [((x - mean) ** 2).sum(axis=0)])[0]
    ends = lessons.sums(lambda x, y: [np.concatenate([-x, x], axis=1).max(axis=0, initial=-np.inf)], np.maximum)[0]
    scale = np.maximum(np.sqrt(square / n), 1e-9)
    low, high = np.maximum(-ends[: len(MEASURES)], mean - 8 * scale), np.minimum(ends[len(MEASURES) :], mean + 8 * scale)
    upto = np.cumsum(lessons.sums(lambda x, y: [_counted(x, low, high)])[0], axis=1)
    place = [[np.searchsorted(c, q * n[0]) + 1 for q in np.linspace(0, 1, BINS + 1)[1:-1]] for c in upto]
    edges = low[:, None] + np.array(place) / GRAIN * (high - low)[:, None]
    return Model(mean, scale, edges, np.zeros(len(mean) * BINS))


def slopes(model: Model, weights: list[np.ndarray], open_ones: list[int], x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Of each model, the last of which sees all parts: gradient, upper half of the curvature and number of its pairs in a group."""
    wide, turn, many, out = model.wide(x), _turns(y), len(model.mean) * BINS, []
    half = np.triu_indices(many)
    for k in open_ones:
        seen = turn != k
        better, worse = pairs(np.flatnonzero(seen & (y == 1)), np.flatnonzero(seen & (y == 0)), max(PAIRS, 4 * len(y))) if 0 < y[seen].sum() < seen.sum() else (np.zeros(0, int),) * 2
        g, h, z = np.zeros(many), np.zeros((many, many)), wide @ weights[k]
        for i in range(0, len(better), 8192):
            a, b = better[i : i + 8192], worse[i : i + 8192]
            d = wide[a] - wide[b]
            p = 1 / (1 + np.exp(np.clip(z[a] - z[b], -30, 30)))
            g -= d.T @ p
            h += (d * (p * (1 - p))[:, None]).T @ d
        out += [g, h[half], np.array([len(better)])]
    return out


def learnt(lessons: Lessons, share: float) -> Model:
    """Learn from all lessons; ``share`` of all labels are poor."""
    model = features(lessons)
    many = len(model.weight)
    half = np.triu_indices(many)
    weights, open_ones = [np.zeros(many) for _ in range(PARTS + 1)], list(range(PARTS + 1))
    for _ in range(STEPS):
        now = [w.copy() for w in weights]
        found = lessons.sums(lambda x, y, now=now, some=open_ones: slopes(model, now, some, x, y))
        steps = {}
        for i, k in enumerate(open_ones):
            g, upper, n = found[3 * i : 3 * i + 3]
            h = np.zeros((many, many))
            h[half] = upper
            h = np.triu(h) + np.triu(h, 1).T
            steps[k] = np.linalg.solve(h / max(n[0], 1) + RIDGE * np.eye(many), g / max(n[0], 1) + RIDGE * weights[k])
        table = np.stack(list(steps.values()), axis=1)
        far = lessons.sums(lambda x, y, table=table: [np.abs(model.wide(x) @ table).max(axis=0, initial=0.0)], np.maximum)[0]
        for k, most in zip(steps, far):
            weights[k] = weights[k] - steps[k] * min(1.0, 3.0 / max(1e-9, most))
        open_ones = [k for k, most in zip(steps, far) if most >= 1e-3]
        if not open_ones:
            break

    def middles(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        wide, turn = model.wide(x), _turns(y)
        own = [[(turn == t) & (y == c) for c in (0, 1)] for t in range(PARTS)]
        return [np.array([[wide[o].sum(axis=0) for o in some] for some in own]), np.array([[o.sum() for o in some] for some in own])]

    # Scores of a pairwise model have no zero of their own; the models' centres are put together.
    total, count = lessons.sums(middles)
    others = lambda k: [t for t in range(PARTS) if t != k]
    centre = [float(np.mean([total[others(k), c].sum(axis=0) @ weights[k] / max(count[others(k), c].sum(), 1) for c in (0, 1)])) for k in range(PARTS + 1)]
    unseen = [bool((count[others(k)].sum(axis=0) > 0).all()) for k in range(PARTS)]  # else the other parts lack a class
    told, away = np.stack([weights[k if unseen[k] else PARTS] for k in range(PARTS)], axis=1), np.array([centre[k if unseen[k] else PARTS] for k in range(PARTS)])

    def ranks(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        turn = _turns(y)
        return (model.wide(x) @ told - away)[np.arange(len(y)), turn]

    each = np.array([share, 1 - share]) / count.sum(axis=0)
    model.weight, model.cut = weights[PARTS], spread_quantile(lessons, ranks, each, share) + centre[PARTS]
    return model


def spread_quantile(lessons: Lessons, ranks: Callable[[np.ndarray, np.ndarray], np.ndarray], each: np.ndarray, share: float) -> float:
    """``quantile`` of the ranks of all lessons, of weight ``each`` by class, from counts in bins that close in on it."""
    ends = lessons.sums(lambda x, y: [np.array([(-ranks(x, y)).max(initial=-np.inf), ranks(x, y).max(initial=-np.inf)])], np.maximum)[0]
    low, high, below = float(-ends[0]), float(ends[1]), 0.0
    for _ in range(4):
        def counted(x: np.ndarray, y: np.ndarray, low: float = low, high: float = high) -> list[np.ndarray]:
            z = ranks(x, y)
            at = np.searchsorted(np.linspace(low, high, GRAIN + 1), z, "left")  # 0 up to low, GRAIN + 1 beyond high
            return [np.stack([np.bincount(at[y == c], minlength=GRAIN + 2) for c in (0, 1)])]

        upto = np.cumsum(each @ lessons.sums(counted)[0])
        k = int(np.searchsorted(upto, share - 1e-9))
        if not 0 < k <= GRAIN:
            break
        edge = np.linspace(low, high, GRAIN + 1)
        low, high = float(edge[k - 1]), float(edge[k])
        if high - low <= 1e-12 * max(1.0, abs(high)):
            break
    top = low if k == 0 else high
    near = lessons.sums(lambda x, y: [np.array([(z := ranks(x, y))[z <= top].max(initial=-np.inf), (-z[z > top]).max(initial=-np.inf)])], np.maximum)[0]
    return float((near[0] + (near[0] if np.isinf(near[1]) else -near[1])) / 2)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model | Constant:
    """Learn from all labelled rows outside the held-out fold."""
    key = labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
    key = key.where("id is not null and label in (0, 1)").where(fold(F.col("id")) != HELD_OUT).groupBy("id").agg(F.max("label").alias("label"))
    count = {r.label: r["count"] for r in key.groupBy("label").count().collect()}
    if len(count) < 2:
        return Constant(float(next(iter(count))) if count else CUT)
    small_batches(docs.sparkSession)

    @frugal
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [measures(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values, pa.list_(pa.float64()))], ["id", "label", "x"])

    text = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    own = text.where(fold(F.col("id")) != HELD_OUT).join(key, "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    rows = own.mapInArrow(measured, "id long, label int, x array<double>")
    groups = max(1, min(-(-sum(count.values()) // GROUP), min(count.values()) // RARE))
    # A session may deal into more parts than it is asked for; each step writes the sums of each.
    rows = checkpointed(rows.repartition(groups, F.xxhash64("id"))).coalesce(groups)
    there = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(there) < 2:
        return Constant(float(next(iter(there))) if there else CUT)
    return learnt(Lessons(rows), count[0] / sum(count.values()))


def score(docs: DataFrame, model: Model | Constant, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text. The model is as large as the measures' bins."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(text: pd.Series) -> pd.Series:
        scores = pd.Series(sent.value.scores(text.tolist()))
        give_back()
        return scores

    return docs.withColumn(out, scored(F.col(f"`{text_col}`")))
