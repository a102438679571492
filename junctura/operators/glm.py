"""Negative-binomial test of usage with offsets, in Arrow batches.

log mu = X beta + log(total + 0.5). Three distributed passes over a table of one
row per intron, with a small step on the driver between them:

1. per intron, the adjusted profile likelihood (Cox-Reid) over a grid of
   dispersions, which is kept. Its sums by abundance are fitted locally, by lines
   with tricube weights around knots that each have as many introns, and give the
   common and trended dispersion, and with them weighted into it an intron's own
   (tagwise) one;
2. per intron, the quasi-likelihood dispersion at the trend. Its prior follows
   abundance, fitted likewise, and is robust: degrees of freedom are matched to winsorised moments,
   and introns far out in the tail get fewer of them;
3. per intron, the dispersion squeezed towards the prior and an F test of every
   contrast.

The fit does not depend on the contrast, so all contrasts share one pass. The
driver gets sums by abundance bin and counts by bucket of tail probability alone.
Parity with other implementations of the method is statistical.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from junctura.checkpoints import checkpointed
from junctura.functions.special import f_tail, lgamma
from junctura.operators.fdr import bh_fdr, flag_significant
from junctura.operators.samples import contrast_label, first_contrast, parse_contrast, valid_name

GRID = np.exp(np.linspace(np.log(1e-4), np.log(8.0), 25))
FINE, FINEST = 16, 640  # bins of abundance, a unit of log2 each, in which sums are taken, and the number of the last on either side
KNOTS = 48  # bins put together so that each has as many introns
SPAN = 0.4  # of all introns, that a local fit reaches
WINSOR = (0.05, 0.1)  # shares of the residuals at both ends that count as the value where they begin
TAILS, PER_DECADE = 4096, 128  # buckets of tail probabilities
STILL = 1e-10  # change of a deviance, in proportion to it, with which a row's fit is done
MOST_DF = 1e6  # degrees of freedom that stand for infinity
PRIOR_COUNT = 0.125  # added to counts, in proportion to library sizes, for logFC alone
RESULT = "intron_id string, contrast string, logFC double, logCPM double, F double, PValue double"


@dataclass
class Design:
    """Samples in order, the model matrix and the names of its columns."""

    samples: list[str]
    matrix: np.ndarray
    names: list[str]
    groups: list[str] = field(default_factory=list)


def design(metadata: pd.DataFrame, group: str = "group", batch: str | None = None) -> Design:
    """~ 0 + group [+ batch]: a column per group; text batches as dummies but for the first, numbers as they are.

    A batch column that isn't there is ignored.
    """
    meta = metadata.sort_values("sample_id")
    names = sorted(meta[group].astype(str).unique())
    columns, labels = [(meta[group].astype(str) == g).to_numpy(float) for g in names], [valid_name(g) for g in names]
    if batch and batch in meta:
        if pd.api.types.is_numeric_dtype(meta[batch]):
            columns.append(meta[batch].to_numpy(float))
            labels.append(batch)
        else:
            for level in sorted(meta[batch].astype(str).unique())[1:]:
                columns.append((meta[batch].astype(str) == level).to_numpy(float))
                labels.append(valid_name(f"{batch}{level}"))
    matrix = np.stack(columns, axis=1)
    if np.linalg.matrix_rank(matrix) < matrix.shape[1]:
        raise ValueError("the design is not of full rank")
    return Design([str(s) for s in meta["sample_id"]], matrix, labels, names)


def contrast_vector(plan: Design, contrast: str) -> np.ndarray:
    """+1 for the first group, -1/k for each of the k others."""
    first, others = parse_contrast(contrast, plan.groups)
    vector = np.zeros(len(plan.names))
    vector[plan.names.index(valid_name(first))] = 1
    for g in others:
        vector[plan.names.index(valid_name(g))] -= 1 / len(others)
    return vector


def _information(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    """X' W X of every row of weights, kept invertible."""
    k = x.shape[1]
    return (w @ (x[:, :, None] * x[:, None, :]).reshape(len(x), k * k)).reshape(-1, k, k) + 1e-9 * np.eye(k)


def fit(y: np.ndarray, offset: np.ndarray, x: np.ndarray, phi: np.ndarray, rounds: int = 40, beta: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients and means of all rows by weighted least squares, halved where the deviance would rise.

    A row is done when its deviance stands still or can't fall; the rounds that follow are for the others alone.
    """
    phi = np.broadcast_to(np.asarray(phi, float), len(y))[:, None]
    if beta is None:
        beta = np.linalg.lstsq(x, np.log((y + 0.5) / np.exp(offset)).T, rcond=None)[0].T
    mean = lambda b, o: np.exp(np.clip(b @ x.T + o, -30, 30))
    beta, mu = beta.copy(), mean(beta, offset)
    last = deviance(y, mu, phi)
    rows, own_y, own_o, own_phi, own_mu = np.arange(len(y)), y, offset, phi, mu
    for _ in range(rounds):
        w = own_mu / (1 + own_phi * own_mu)
        step = np.linalg.solve(_information(w, x), ((w * (own_y - own_mu) / own_mu) @ x)[..., None])[..., 0]
        step = np.clip(step, -5, 5)
        begin, before = beta[rows], last[rows]
        now = mean(begin + step, own_o)
        dev = deviance(own_y, now, own_phi)
        for _ in range(5):
            worse = np.flatnonzero(dev > before + 1e-9)
            if not len(worse):
                break
            step[worse] /= 2
            now[worse] = mean(begin[worse] + step[worse], own_o[worse])
            dev[worse] = deviance(own_y[worse], now[worse], own_phi[worse])
        better = dev <= before + 1e-9
        done = rows[better]
        beta[done], mu[done], last[done] = (begin + step)[better], now[better], dev[better]
        going = better & (np.abs(before - dev) >= STILL * (1 + before))
        if not going.any():
            break
        rows, own_mu = rows[going], now[going]
        own_y, own_o, own_phi = own_y[going], own_o[going], own_phi[going]
    return beta, mu


def deviance(y: np.ndarray, mu: np.ndarray, phi: np.ndarray) -> np.ndarray:
    """Unit deviances summed over samples."""
    with np.errstate(divide="ignore", invalid="ignore"):
        first = np.where(y > 0, y * np.log(y / mu), 0)
    size = 1 / np.maximum(phi, 1e-10)
    return 2 * (first - (y + size) * np.log((y + size) / (mu + size))).sum(axis=1)


def profile(y: np.ndarray, offset: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Adjusted profile log likelihood of every row at every dispersion of the grid."""
    out, beta = np.empty((len(y), len(GRID))), None
    for k, phi in enumerate(GRID):
        beta, mu = fit(y, offset, x, np.full(len(y), phi), 12, beta)  # from the last dispersion's fit
        size = 1 / phi
        logl = lgamma(y + size) - lgamma(np.array(size)) - lgamma(y + 1.0) + size * np.log(size / (size + mu)) + y * np.log(mu / (size + mu))
        w = mu / (1 + phi * mu)
        out[:, k] = logl.sum(axis=1) - 0.5 * np.linalg.slogdet(_information(w, x))[1]
    return out


def peak(likelihood: np.ndarray) -> float:
    """Dispersion at the top of a grid of log likelihoods, by a parabola through its neighbours."""
    k, logs = int(np.argmax(likelihood)), np.log(GRID)
    if 0 < k < len(GRID) - 1:
        a, b, c = likelihood[k - 1 : k + 2]
        if a - 2 * b + c < 0:
            return float(np.exp(logs[k] + 0.5 * (a - c) / (a - 2 * b + c) * (logs[1] - logs[0])))
    return float(GRID[k])


def fine_bin(level: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(level * FINE), -FINEST, FINEST).astype(int)


@dataclass
class Knots:
    """Means of quantities at abundances, from sums by fine bin."""

    at: np.ndarray  # mean abundance of each knot, ascending
    n: np.ndarray
    means: np.ndarray

    @classmethod
    def of(cls, sums: np.ndarray, levels: np.ndarray, n: np.ndarray) -> Knots:
        """Put fine bins, in order, together to ``KNOTS`` at most, by the place of their middle among all introns."""
        if not len(n):
            return cls(np.zeros(1), np.ones(1), np.zeros((1, sums.shape[1])))
        which = np.unique(np.floor((np.cumsum(n) - n / 2) / n.sum() * KNOTS), return_inverse=True)[1]
        many = which.max() + 1
        add = lambda x: np.stack([np.bincount(which, c, many) for c in np.atleast_2d(x.T)], axis=1)
        count = add(n)[:, 0]
        return cls(add(levels)[:, 0] / count, count, add(sums) / count[:, None])

    def smooth(self) -> np.ndarray:
        """At each knot the value there of a line fitted around it, weighted by introns and by a tricube of the distance."""
        out = np.empty_like(self.means)
        for k, at in enumerate(self.at):
            far = np.abs(self.at - at)
            order = np.argsort(far, kind="stable")
            reach = int(np.searchsorted(np.cumsum(self.n[order]), SPAN * self.n.sum()))
            # Two neighbours at least are within reach, where there are any.
            width = far[order[min(max(reach, 2), len(far) - 1)]] * (1 + 1e-6) + 1e-9
            w = self.n * np.maximum(0, 1 - (far / width) ** 3) ** 3
            d = self.at - at
            total, first, second = w.sum(), w @ d, w @ (d * d)
            free = total * second - first * first
            line = (second * w - first * w * d) / free if free > 1e-9 * total * total else w / total
            out[k] = line @ self.means
        return out

    def between(self, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The knot below each level, and the part of the way to the next one; levels beyond the ends are at the ends."""
        low = np.clip(np.searchsorted(self.at, level, "right") - 1, 0, max(0, len(self.at) - 2))
        high = np.minimum(low + 1, len(self.at) - 1)
        gap = self.at[high] - self.at[low]
        return low, np.clip(np.where(gap > 0, (level - self.at[low]) / np.where(gap > 0, gap, 1), 0), 0, 1)

    def along(self, level: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Positive ``values`` at the knots, at each abundance: their logarithm is linear between knots."""
        low, part = self.between(level)
        logs = np.log(values)
        return np.exp((1 - part) * logs[low] + part * logs[np.minimum(low + 1, len(logs) - 1)])


def collected(rows: DataFrame, level: str, values: list) -> Knots:
    """Knots of sums by fine bin; the driver gets a row a fine bin."""
    bins = F.least(F.greatest(F.floor(F.col(level) * FINE), F.lit(-FINEST)), F.lit(FINEST)).cast("int").alias("b")
    sums = [F.sum(v).alias(f"s{i}") for i, v in enumerate(values)]
    found = sorted(rows.groupBy(bins).agg(F.count("*").alias("n"), F.sum(level).alias("l"), *sums).collect())
    table = np.array([list(r) for r in found], float).reshape(len(found), 3 + len(values))
    return Knots.of(table[:, 3:], table[:, 2], table[:, 1])


def winsorised(df1: float, df2: float) -> tuple[float, float]:
    """Mean and variance of log F with both tails cut to their quantiles."""
    t = np.linspace(-40, 40, 16001)
    a, b = df1 / 2, df2 / 2
    x = t + np.log(df1 / df2)
    logs = a * x - (a + b) * np.logaddexp(0, x)
    mass = np.exp(logs - logs.max())
    mass /= mass.sum()
    below = np.cumsum(mass) - mass / 2
    low, high = np.interp([WINSOR[0], 1 - WINSOR[1]], below, t)
    cut = np.clip(t, low, high)
    mean = float(mass @ cut)
    return mean, float(mass @ (cut - mean) ** 2)


@dataclass
class Prior:
    """Prior of the quasi-likelihood dispersion: its scale at knots of abundance, its degrees of freedom, and those by bucket of the tail probability."""

    knots: Knots
    scale: np.ndarray
    df: float
    by_tail: np.ndarray

    def of(self, ratio: np.ndarray, df: int) -> np.ndarray:
        """Degrees of freedom for dispersions that are ``ratio`` times the scale."""
        return self.by_tail[_tail_bucket(ratio, df, self.df)]


def _tail_bucket(ratio: np.ndarray, df1: float, df2: float) -> np.ndarray:
    tail = f_tail(ratio, df1, np.full(len(ratio), df2))
    return np.clip(np.floor(-PER_DECADE * np.log10(np.maximum(tail, 1e-300))), 0, TAILS - 1).astype(int)


def robust_prior(squares: DataFrame, df: int) -> Prior:
    """Prior from rows (level, z), z being the log of the dispersion before squeezing.

    After removal of the trend along the level, the winsorised variance of z says
    how many degrees of freedom the prior has, and its mean where the scale lies.
    An intron is an outlier as far as its tail probability is below the share of
    introns as far out; the outliers' degrees of freedom make the furthest of them
    the middle of its distribution. The tail probabilities are counted in buckets,
    so no order over all introns is needed.
    """
    knots = collected(squares, "level", [F.col("z")])
    n = int(knots.n.sum())
    if n < 3:
        return Prior(knots, np.ones(len(knots.at)), MOST_DF, np.full(TAILS, MOST_DF))
    trend = knots.smooth()[:, 0]

    def residuals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"r": pdf["z"] - np.interp(pdf["level"], knots.at, trend)})

    rest = squares.mapInPandas(residuals, "r double")
    low, high = rest.agg(F.percentile_approx("r", [WINSOR[0], 1 - WINSOR[1]], 10_000).alias("q")).first().q
    cut = F.greatest(F.lit(low), F.least(F.lit(high), "r"))
    mean, spread = rest.agg(F.avg(cut), F.var_samp(cut)).first()
    if spread <= winsorised(df, MOST_DF)[1]:
        prior = MOST_DF
    else:
        a, b = np.log(0.05), np.log(MOST_DF)
        for _ in range(50):
            middle = (a + b) / 2
            a, b = (middle, b) if winsorised(df, float(np.exp(middle)))[1] > spread else (a, middle)
        prior = float(np.exp((a + b) / 2))
    shift = mean - winsorised(df, prior)[0]
    scale = np.exp(trend + shift)

    def tails(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            bucket = _tail_bucket(np.exp(pdf["r"].to_numpy() - shift), df, prior)
            yield pdf.assign(b=bucket)

    counted = rest.mapInPandas(tails, "r double, b int").groupBy("b").agg(F.count("*").alias("n"), F.max("r").alias("r")).collect()
    by_tail = np.full(TAILS, prior)
    order = sorted(counted, key=lambda r: -r.b)
    size = np.array([r.n for r in order], float)
    beyond = (np.cumsum(size) - size / 2) / n
    tail = 10 ** (-(np.array([r.b for r in order]) + 0.5) / PER_DECADE)
    steady = np.minimum(1.0, tail / beyond)
    if (steady < 1).any():
        if prior >= MOST_DF:
            own = np.where(steady < 1, steady * n * df, MOST_DF)
        else:
            top = np.exp(max(r.r for r in order) - shift)
            outlier = prior
            for _ in range(2):
                p = float(f_tail(np.array([top]), df, np.array([outlier]))[0])
                outlier *= math.log(0.5) / math.log(min(max(p, 1e-300), 0.5))
            own = steady * prior + (1 - steady) * outlier
        # Degrees of freedom don't fall from the furthest inwards.
        running = np.cumsum(own * size) / np.cumsum(size)
        first = int(np.argmin(running))
        own[: first + 1] = running[first]
        own = np.maximum.accumulate(own)
        by_tail = np.interp(np.arange(TAILS), [r.b for r in reversed(order)], own[::-1])
    return Prior(knots, scale, prior, by_tail)


def _poisson_p(y: np.ndarray, offset: np.ndarray, x: np.ndarray, free: np.ndarray) -> np.ndarray:
    """Likelihood-ratio test of one direction with Poisson variance."""
    none = np.full(len(y), 1e-8)
    dev = [deviance(y, fit(y, offset, m, none)[1] if m.shape[1] else np.exp(offset), none[:, None]) for m in (x, x @ free)]
    return np.vectorize(math.erfc, otypes=[float])(np.sqrt(np.maximum(dev[1] - dev[0], 0) / 2))


def model_input(cells: DataFrame, plan: Design) -> DataFrame:
    """One row per intron: counts and log offsets as arrays in the order of the design's samples.

    Offsets are those of a column ``offset`` if there is one, else of the shared
    totals. An error is raised where an intron lacks a sample.
    """
    offset = F.col("offset") if "offset" in cells.columns else F.log(F.col("shared_total") + 0.5)
    order = F.create_map(*[c for i, s in enumerate(plan.samples) for c in (F.lit(s), F.lit(i))])
    known = cells.where(F.col("sample_id").isin(plan.samples)).withColumn("__i", F.element_at(order, F.col("sample_id")))
    # The fit is heavy on processors while its rows are few bytes, so rows go to
    # all cores rather than to partitions of a given size.
    parts = max(2 * cells.sparkSession.sparkContext.defaultParallelism, int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    packed = known.repartition(parts, "intron_id").groupBy("intron_id").agg(F.array_sort(F.collect_list(F.struct("__i", F.col("count").cast("double").alias("c"), offset.alias("o")))).alias("all"))
    whole = F.assert_true(F.size("all") == len(plan.samples), F.lit("an intron lacks samples of the design"))
    return packed.select("intron_id", F.when(whole.isNull(), F.col("all.c")).alias("counts"), F.col("all.o").alias("offsets"))


def _arrays(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return np.stack(pdf["counts"].to_numpy()), np.stack(pdf["offsets"].to_numpy())


@dataclass
class Fitted:
    """What the passes over all introns have found; per-intron values are made from it on demand."""

    rows: DataFrame
    plan: Design
    library: np.ndarray
    common: float
    knots: Knots
    trend: np.ndarray  # dispersion at the knots
    shared: np.ndarray  # mean log likelihood over the grid at the knots
    df: int
    prior: Prior

    def abundance(self, y: np.ndarray) -> np.ndarray:
        return _abundance(y, self.library)

    def fitted(self, y: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, ...]:
        """Level, trended dispersion, coefficients, means, deviance, prior degrees of freedom and squeezed quasi-likelihood dispersion."""
        level = self.abundance(y)
        phi = self.knots.along(level, self.trend)
        beta, mu = fit(y, offset, self.plan.matrix, phi)
        dev = deviance(y, mu, phi[:, None])
        scale = self.prior.knots.along(level, self.prior.scale)
        more = self.prior.of(dev / self.df / scale, self.df)
        return level, phi, beta, mu, dev, more, (more * scale + dev) / (more + self.df)

    def tagwise(self, level: np.ndarray, own: np.ndarray) -> np.ndarray:
        """An intron's own dispersion: the top of its log likelihood and the shared one, which weighs as the prior's degrees of freedom."""
        low, part = self.knots.between(level)
        shared = (1 - part)[:, None] * self.shared[low] + part[:, None] * self.shared[np.minimum(low + 1, len(self.shared) - 1)]
        return np.array([peak(row) for row in own + self.prior.df / self.df * shared])

    def parameters(self) -> DataFrame:
        """Per intron: logCPM, trended and tagwise dispersion, quasi-likelihood dispersions before and after squeezing, the prior's degrees of freedom, and coefficients in the order of the design."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                y, offset = _arrays(pdf)
                level, phi, beta, _, dev, more, s2 = self_.fitted(y, offset)
                own = self_.tagwise(level, np.stack(pdf["profile"].to_numpy()))
                yield pd.DataFrame({"intron_id": pdf["intron_id"], "logCPM": level, "trend": phi, "dispersion": own, "ql_raw": dev / self_.df, "ql_squeezed": s2, "prior_df": more, "coefficients": list(beta)})

        self_ = self._local()
        return self.rows.mapInPandas(run, "intron_id string, logCPM double, trend double, dispersion double, ql_raw double, ql_squeezed double, prior_df double, coefficients array<double>")

    def diagnostics(self) -> DataFrame:
        return dispersion_points(self.parameters())

    def _local(self) -> Fitted:
        """Itself without the DataFrame, to send to workers."""
        return replace(self, rows=None)

    def test(self, contrasts: list[str] | None = None, fdr: float = 0.05, min_log_fc: float = 0.0) -> DataFrame:
        """logFC, logCPM, F, PValue, FDR (within the contrast) and significant of each intron and contrast, in one pass.

        Without contrasts the first group is set against the second.
        """
        contrasts = contrasts or [first_contrast(self.plan.groups)]
        x, vectors = self.plan.matrix, {contrast_label(c): contrast_vector(self.plan, c) for c in contrasts}
        self_ = self._local()

        def tests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                y, offset = _arrays(pdf)
                level, phi, _, mu, full, prior, s2 = self_.fitted(y, offset)
                # Fold changes of introns without reads in a group stay finite.
                more = PRIOR_COUNT * self_.library / self_.library.mean()
                steady, _ = fit(y + more, np.log(np.exp(offset) + 2 * more), x, phi)
                for name, c in vectors.items():
                    # The null model keeps the directions that the contrast doesn't see.
                    free = np.linalg.svd(c[None, :])[2][1:].T
                    _, mu0 = fit(y, offset, x @ free, phi) if free.shape[1] else (None, np.exp(offset))
                    f = np.maximum(deviance(y, mu0, phi[:, None]) - full, 0) / s2
                    p = f_tail(f, 1, prior + self_.df)
                    # Where the variance falls below that of counts themselves,
                    # the test may not be surer than one with Poisson variance.
                    low = np.flatnonzero((s2[:, None] * (1 + phi[:, None] * mu)).min(axis=1) < 1)
                    if len(low):
                        p[low] = np.maximum(p[low], _poisson_p(y[low], offset[low], x, free))
                    yield pd.DataFrame({"intron_id": pdf["intron_id"], "contrast": name, "logFC": steady @ c / np.log(2), "logCPM": level, "F": f, "PValue": p})

        return flag_significant(bh_fdr(self.rows.drop("profile").mapInPandas(tests, RESULT), "PValue", ("contrast",)), fdr, min_log_fc)


def dispersion_points(parameters: DataFrame) -> DataFrame:
    """Points of the dispersion plots: logCPM against the roots of the dispersions."""
    return parameters.select(
        "intron_id", "logCPM", F.sqrt("dispersion").alias("bcv"), F.sqrt("trend").alias("trended_bcv"), F.sqrt("ql_raw").alias("root_ql_raw"), F.sqrt("ql_squeezed").alias("root_ql_squeezed")
    )


def _abundance(y: np.ndarray, library: np.ndarray) -> np.ndarray:
    return np.log2(((y + 0.5) / (library + 1) * 1e6).mean(axis=1))


def estimate(cells: DataFrame, metadata: pd.DataFrame, group: str = "group", batch: str | None = None) -> Fitted:
    """Dispersions and their prior from long counts with shared_total, in two passes over a table of one row per intron."""
    plan = design(metadata, group, batch)
    x, df = plan.matrix, plan.matrix.shape[0] - plan.matrix.shape[1]
    if df < 1:
        raise ValueError("no residual degrees of freedom")
    rows = checkpointed(model_input(cells, plan))
    sums = rows.select(F.posexplode("counts").alias("i", "c")).groupBy("i").agg(F.sum("c").alias("n")).collect()
    sizes = {r.i: float(r.n) for r in sums}
    library = np.array([max(sizes.get(i, 0.0), 1.0) for i in range(len(plan.samples))])

    def profiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            y, offset = _arrays(pdf)
            yield pdf.assign(level=_abundance(y, library), profile=list(profile(y, offset, x)))

    rows = checkpointed(rows.mapInPandas(profiles, "intron_id string, counts array<double>, offsets array<double>, level double, profile array<double>"))
    knots = collected(rows, "level", [F.col("profile")[k] for k in range(len(GRID))])
    common = peak(knots.n @ knots.means)
    shared = knots.smooth()
    trend = np.array([peak(s) for s in shared])

    def squares(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            y, offset = _arrays(pdf)
            level = _abundance(y, library)
            phi = knots.along(level, trend)
            _, mu = fit(y, offset, x, phi)
            yield pd.DataFrame({"level": level, "z": np.log(np.maximum(deviance(y, mu, phi[:, None]) / df, 1e-6))})

    prior = robust_prior(checkpointed(rows.drop("profile").mapInPandas(squares, "level double, z double")), df)
    return Fitted(rows, plan, library, common, knots, trend, shared, df, prior)


def fixed(cells: DataFrame, metadata: pd.DataFrame, dispersion: float, group: str = "group", batch: str | None = None) -> DataFrame:
    """Coefficients of every intron at a given dispersion, one pass and no estimate: intron_id, coefficients in the order of the design, and deviance."""
    plan = design(metadata, group, batch)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            y, offset = _arrays(pdf)
            phi = np.full(len(y), dispersion)
            beta, mu = fit(y, offset, plan.matrix, phi, 100)
            yield pd.DataFrame({"intron_id": pdf["intron_id"], "coefficients": list(beta), "deviance": deviance(y, mu, phi[:, None])})

    return model_input(cells, plan).mapInPandas(run, "intron_id string, coefficients array<double>, deviance double")


def test(cells: DataFrame, metadata: pd.DataFrame, contrasts: list[str] | None = None, group: str = "group", batch: str | None = None, fdr: float = 0.05, min_log_fc: float = 0.0) -> DataFrame:
    """Estimate once and test all contrasts."""
    return estimate(cells, metadata, group, batch).test(contrasts, fdr, min_log_fc)
