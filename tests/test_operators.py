"""Operators on small cases made by hand, and against independent pandas."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from junctura.functions import introns as I
from junctura.functions import pvalues, special
from junctura.operators import annotate, clusters, clusterstats, counts, fdr, filters, glm, integrate, ordered, plots, psi, samples

IDS = [
    ("chr1:100-900^GT--AG^OK", [5, 0, 7]), ("chr1:100-800^GT--AG^OK", [1, 0, 3]), ("chr1:100-700^AA--TT^NON", [9, 9, 9]),
    ("chr1:300-900^CT--AC^OK", [2, 2, 2]), ("chr2:10-20^GT--AT^OK", [0, 0, 4]),
]


@pytest.fixture(scope="module")
def cells(spark):
    rows = [(i, f"S{k}", n) for i, ns in IDS for k, n in enumerate(ns, 1) if n]
    sparse = spark.createDataFrame(rows, "intron_id string, sample_id string, count long")
    return clusters.assign_clusters(counts.densify(sparse, ["S1", "S2", "S3"]))


def test_densify_and_pivot_round_trip(spark, cells):
    wide = counts.pivot_matrix(cells.select("intron_id", "sample_id", "count"), ["S1", "S2", "S3"])
    assert {r.intron_id: [r.S1, r.S2, r.S3] for r in wide.collect()} == dict(IDS)
    assert counts.unpivot_matrix(wide).exceptAll(cells.select("intron_id", "sample_id", "count")).isEmpty()


def test_names_with_dots_and_dashes(spark):
    wide = spark.createDataFrame([("x", 1, 2)], "intron_id string, `a.b` long, `c-d` long")
    assert {(r.sample_id, r["count"]) for r in counts.unpivot_matrix(wide).collect()} == {("a.b", 1), ("c-d", 2)}


def test_motif_rules_differ(spark):
    row = spark.range(1).select(
        I.strand_of(F.lit("GT--AT")).alias("a"), I.annotation_strand(F.lit("GT"), F.lit("AT")).alias("b"),
        I.strand_of(F.lit("AA--TT")).alias("c"), I.annotation_strand(F.lit("AA"), F.lit("TT")).alias("d"),
    ).first()
    assert tuple(row) == ("-", "+", "?", "+")


def test_strict_form_raises_and_lenient_is_null(spark):
    bad = spark.createDataFrame([("chr1:5-x",)], "i string")
    assert bad.select(I.parse_lenient(F.col("i")).alias("p")).first().p is None
    with pytest.raises(Exception, match="not an intron"):
        bad.select(I.parse_strict(F.col("i"))).collect()


def test_shared_totals(cells):
    got = {(r.intron_id, r.sample_id): r.shared_total for r in clusters.add_totals(cells).collect()}
    assert got["chr1:100-900^GT--AG^OK", "S1"] == 6  # donor 100 of two introns; the acceptor has it alone
    assert got["chr1:100-700^AA--TT^NON", "S1"] == 9  # strand ? keeps it apart
    assert got["chr1:300-900^CT--AC^OK", "S2"] == 2


def test_totals_bound_counts_and_psi(cells):
    frame = psi.psi_values(clusters.add_totals(cells)).toPandas()
    assert (frame["shared_total"] >= frame["count"]).all() and frame["psi"].between(0, 1).all()
    assert (frame.loc[frame["shared_total"] == 0, "psi"] == 0).all()


def test_either_holds_both(cells):
    flags = filters.cluster_flags(cells, 3, 2).toPandas()
    either = set(filters.either_cluster(cells, 3, 2).toPandas()["intron_id"])
    assert either == set(flags[flags.donor_passes | flags.acceptor_passes]["intron_id"])


def test_group_of_one_has_no_deviation(spark, cells):
    meta = spark.createDataFrame([("S1", "a"), ("S2", "b"), ("S3", "b")], "sample_id string, `group` string")
    stats = psi.group_stats(psi.psi_values(clusters.add_totals(cells)), meta).where("`group` = 'a'").toPandas()
    assert stats["std_psi"].isna().all()
    assert psi.compatible_delta(cells, meta.union(spark.createDataFrame([("S4", "c")], meta.schema))) is None


def reference_bh(p):
    p = np.array(p, float)
    order = np.argsort(p)
    out = np.minimum.accumulate((p[order] * len(p) / np.arange(1, len(p) + 1))[::-1])[::-1]
    back = np.empty(len(p))
    back[order] = np.minimum(out, 1)
    return back


def test_bh_known_and_random(spark):
    rng = np.random.default_rng(1)
    p = [0.01, 0.02, 0.02, 0.5]
    got = fdr.bh_fdr(spark.createDataFrame([(x,) for x in [*p, None]], "PValue double")).collect()
    assert sorted(round(r.FDR, 7) for r in got if r.FDR is not None) == [0.0266667] * 3 + [0.5]
    assert [r.FDR for r in got if r.PValue is None] == [None]
    p = np.round(rng.random(3000) ** 3, 4)
    got = fdr.bh_fdr(spark.createDataFrame([(int(i), float(x)) for i, x in enumerate(p)], "i long, PValue double")).orderBy("i").toPandas()
    assert np.allclose(got["FDR"], reference_bh(p), rtol=1e-12)
    assert (got["FDR"] >= got["PValue"] - 1e-15).all()


def test_combined_p_values(spark):
    frame = spark.createDataFrame([("a", 0.01), ("a", 0.04), ("a", 0.2), ("b", 0.0), ("b", None), ("c", 1.0)] + [("d", 1e-300)] * 60, "k string, p double")
    got = {r.k: r for r in frame.groupBy("k").agg(pvalues.fisher(F.col("p")).alias("f"), pvalues.cauchy(F.col("p")).alias("c")).collect()}
    assert math.isclose(got["a"].f, 0.004394303471102363, rel_tol=1e-12) and math.isclose(got["a"].c, 0.02318601957020977, rel_tol=1e-12)
    assert got["b"].f is None and got["b"].c is None
    assert got["c"].f == 1 and 0 <= got["d"].f < 1e-200


def test_cluster_aggregation_without_significant(spark):
    rows = spark.createDataFrame([("x", 0.01, 2.0, "g2"), ("x", 0.03, -1.0, "g1"), ("y", None, 1.0, None)], "cluster string, PValue double, logFC double, gene_name string")
    got = {r.cluster: r for r in clusterstats.aggregate_clusters(rows).collect()}
    assert (got["x"].dominant_direction, got["x"].gene_name, got["x"].max_abs_logFC) == ("mixed", "g1, g2", 2.0)
    assert got["y"].cluster_pvalue is None and got["y"].cluster_FDR is None and got["y"].gene_name == ""


def test_interval_join_is_the_plain_one(spark):
    rng = np.random.default_rng(2)
    side = lambda n: [(f"c{rng.integers(2)}", int(s), int(s + rng.integers(0, 400_000)), i) for i, s in enumerate(rng.integers(0, 10**6, n))]
    a, b = side(60), side(80)
    left = spark.createDataFrame(a, "chrom string, start long, end long, a long")
    right = spark.createDataFrame(b, "chrom string, start long, end long, b long")
    got = [(r.a, r.b) for r in annotate.interval_join(left, right, ["chrom"]).collect()]
    want = [(x[3], y[3]) for x in a for y in b if x[0] == y[0] and x[1] <= y[2] and x[2] >= y[1]]
    assert sorted(got) == sorted(want)


def test_long_intervals_are_a_row_a_level(spark):
    rows = [(0, 1, 10**9), (1, 5, 5), (2, 3 * 10**8, 5 * 10**8), (3, 16383, 16384), (4, 2**33, 2**34), (5, 10**9, 2**33), (6, 9, 3)]
    side = spark.createDataFrame([("c", a, b, i) for i, a, b in rows], "chrom string, start long, end long, i long")
    got = annotate.interval_join(side, side.withColumnRenamed("i", "j"), ["chrom"])
    assert sorted((r.i, r.j) for r in got.collect()) == sorted((i, j) for i, a, b in rows for j, c, d in rows if a <= b and c <= d and a <= d and b >= c)
    steps = side.where("start <= end").select(F.size(annotate._upwards(annotate.bin_of(F.col("start"), F.col("end")), True)).alias("n"))
    assert max(r.n for r in steps.collect()) <= annotate.LEVELS + 1


def test_annotation_prefers_exact_and_drops_short_gaps(spark):
    exon = spark.createDataFrame(
        [("chr1", 1, 99, "+", "t1", "gB", 0), ("chr1", 901, 950, "+", "t1", "gB", 1), ("chr1", 952, 990, "+", "t1", "gB", 2)],
        "chrom string, start long, end long, strand string, transcript_id string, gene_name string, ord long",
    )
    known = annotate.intron_genes(annotate.exon_introns(exon))
    assert [(r.start, r.end) for r in known.collect()] == [(100, 900)]
    genes = spark.createDataFrame([("chr1", 800, 2000, "+", "gA", 0)], "chrom string, start long, end long, strand string, gene_name string, ord long")
    ids = spark.createDataFrame([("chr1:100-900^GT--AG^OK",), ("chr1:150-800^GT--AG^OK",), ("chr1:150-800^CT--AC^OK",), ("odd",), ("chr1:150-800:+",), ("chr1:150-800:?",), ("chr1:1-9^gt--ag^OK",)], "intron_id string")
    got = {r.intron_id: (r.gene_name, r.intron_status) for r in annotate.annotate(ids, known, annotate.gene_index(annotate.gene_map(genes))).collect()}
    assert got == {"chr1:100-900^GT--AG^OK": ("gB", "known"), "chr1:150-800^GT--AG^OK": ("gA", "novel"), "chr1:150-800^CT--AC^OK": (".", "novel"), "odd": (".", "unknown"), "chr1:150-800:+": ("gA", "novel"), "chr1:150-800:?": (".", "unknown"), "chr1:1-9^gt--ag^OK": (".", "unknown")}


def test_outer_join_matches_null_keys(spark):
    kind = "intron_id string, gene_name string, logFC double, PValue double, FDR double, significant boolean"
    donor = spark.createDataFrame([("i", None, 1.0, 0.1, 0.01, True), ("j", "g", 1.0, 0.1, 0.2, False)], kind)
    acceptor = spark.createDataFrame([("i", None, -1.0, 0.1, 0.02, True), ("k", "g", 1.0, 0.1, 0.2, True)], kind)
    got = {r.intron_id: r for r in integrate.integrate(donor, acceptor).collect()}
    assert len(got) == 3 and got["i"].tested_in == "both" and got["i"].direction_consistent is False and got["i"].best_analysis == "donor"
    assert got["j"].best_analysis == "acceptor" and got["j"].best_logFC is None and got["j"].best_FDR == 0.2


def test_contrasts():
    assert samples.pairwise_contrasts(["b", "a", "c"]) == ["a-b", "a-c", "b-c"]
    assert samples.control_contrasts(["a", "b", "c"], ["b", "zz"]) == ["a-b", "c-b"]
    assert samples.contrast_label("a-b,c") == "a_vs_b_c" and samples.contrast_file("a-b") == "a_vs_b"
    assert samples.valid_name("1x-y") == "X1x.y"
    for bad in ("a", "a-b-c", "a-zz", "a-"):
        with pytest.raises(ValueError):
            samples.parse_contrast(bad, ["a", "b", "c"])
    with pytest.raises(ValueError):
        samples.contrasts(["a", "b"], "a-b", ["b"])


def test_cigar(spark):
    got = spark.range(1).select(I.cigar_introns(F.lit(100), F.lit("5S10M100N5M2I3D20N4M")).alias("g")).first().g
    assert [(g.start, g.end) for g in got] == [(110, 209), (218, 237)]
    assert spark.range(1).select(I.cigar_introns(F.lit(100), F.lit("50M")).alias("g")).first().g == []


def test_special_functions():
    assert np.allclose(special.lgamma(np.array([0.1, 1, 2.5, 30])), [math.lgamma(x) for x in (0.1, 1, 2.5, 30)], rtol=1e-10)
    assert np.allclose(special.f_tail(np.array([0.0, 4.0, 161.4476]), 1, np.array([5.0, 10.0, 1.0])), [1, 0.0733880, 0.05], atol=1e-5)
    assert math.isclose(special.trigamma_inverse(special.trigamma(3.7)), 3.7, rel_tol=1e-9)


def test_model_on_simulated_counts(spark):
    rng = np.random.default_rng(3)
    n, groups = 400, ["a"] * 4 + ["b"] * 4
    rows = []
    for i in range(n):
        base, effect = rng.uniform(0.2, 0.6), (0.25 if i < 60 else 0.0)
        for k, g in enumerate(groups):
            total = int(rng.integers(150, 400))
            mean = total * (base + (effect if g == "a" else 0))
            rows.append((f"i{i:04d}", f"S{k}", int(rng.negative_binomial(20, 20 / (20 + mean))), total))
    cells = spark.createDataFrame(rows, "intron_id string, sample_id string, count long, shared_total long")
    meta = pd.DataFrame({"sample_id": [f"S{k}" for k in range(8)], "group": groups})
    got = glm.test(cells, meta, ["a-b"]).toPandas().set_index("intron_id").sort_index()
    null, real = got.iloc[60:], got.iloc[:60]
    assert 0.35 < null["PValue"].mean() < 0.65 and null["significant"].mean() < 0.03
    assert real["significant"].mean() > 0.5 and (real["logFC"] > 0).mean() > 0.95
    table = glm.estimate(cells, meta).parameters().toPandas()
    assert len(table) == n and (table["dispersion"] > 0).all() and all(len(c) == 2 for c in table["coefficients"])
    with pytest.raises(ValueError):
        glm.design(meta.assign(batch=groups), "group", "batch")


def plain_fit(y, offset, x, phi):
    """Coefficients and deviance of one intron by Newton's steps on the likelihood itself."""
    beta = np.linalg.lstsq(x, np.log((y + 0.5) / np.exp(offset)), rcond=None)[0]
    for _ in range(200):
        mu = np.exp(x @ beta + offset)
        score = x.T @ ((y - mu) / (1 + phi * mu))
        step = np.linalg.solve(x.T @ (x * (mu * (1 + phi * y) / (1 + phi * mu) ** 2)[:, None]), score)
        beta = beta + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-13:
            break
    mu = np.exp(x @ beta + offset)
    first = np.where(y > 0, y * np.log(np.maximum(y, 1e-300) / mu), 0)
    return beta, 2 * (first - (y + 1 / phi) * np.log((y + 1 / phi) / (mu + 1 / phi))).sum()


@pytest.mark.parametrize("kind", ["pooled", "batch"])
def test_model_against_a_plain_fit(spark, kind):
    rng = np.random.default_rng(5)
    groups = ["a"] * 3 + ["b"] * 3 + ["c"] * 3
    meta = pd.DataFrame({"sample_id": [f"S{k}" for k in range(9)], "group": groups, "batch": ["p", "q", "r"] * 3})
    rows, counts_, offsets = [], [], []
    for i in range(60):
        total = rng.integers(150, 400, 9)
        y = rng.negative_binomial(15, 15 / (15 + total * rng.uniform(0.2, 0.6)))
        counts_.append(y.astype(float))
        offsets.append(np.log(total + 0.5))
        rows += [(f"i{i:02d}", f"S{k}", int(y[k]), int(total[k])) for k in range(9)]
    cells = spark.createDataFrame(rows, "intron_id string, sample_id string, count long, shared_total long")
    fitted = glm.estimate(cells, meta, batch="batch" if kind == "batch" else None)
    contrast = "a-b,c" if kind == "pooled" else "a-b"
    got = fitted.test([contrast]).toPandas().set_index("intron_id").sort_index()
    table = fitted.parameters().toPandas().set_index("intron_id").sort_index()
    x = np.array([[g == h for h in "abc"] + ([b == h for h in "qr"] if kind == "batch" else []) for g, b in zip(groups, meta["batch"])], float)
    c = np.array([1, -0.5, -0.5] if kind == "pooled" else [1, -1, 0, 0, 0])
    null = x @ np.linalg.svd(c[None])[2][1:].T
    for i in range(60):
        own = table.iloc[i]
        beta, dev = plain_fit(counts_[i], offsets[i], x, own["trend"])
        assert np.allclose(own["coefficients"], beta, atol=1e-5) and math.isclose(own["ql_raw"] * (9 - x.shape[1]), dev, rel_tol=1e-6)
        f = (plain_fit(counts_[i], offsets[i], null, own["trend"])[1] - dev) / own["ql_squeezed"]
        assert math.isclose(got.iloc[i]["F"], max(f, 0), rel_tol=1e-5, abs_tol=1e-6)


def test_robust_prior_sets_outliers_apart(spark):
    rng = np.random.default_rng(2)
    level, df, prior = rng.uniform(0, 12, 4000), 6, 12.0
    scale = np.exp(0.1 * level)
    s2 = scale * (rng.chisquare(df, 4000) / df) / (rng.chisquare(prior, 4000) / prior)
    s2[:40] *= 60
    found = glm.robust_prior(spark.createDataFrame(pd.DataFrame({"level": level, "z": np.log(s2)})), df)
    assert 8 < found.df < 18
    assert np.allclose(found.knots.along(np.array([2.0, 6.0, 10.0]), found.scale), np.exp([0.2, 0.6, 1.0]), rtol=0.15)
    own = found.of(s2 / found.knots.along(level, found.scale), df)
    assert np.median(own[:40]) < 0.5 * found.df and np.median(own[40:]) > 0.9 * found.df
    mean, spread = glm.winsorised(df, prior)
    z = np.log((rng.chisquare(df, 200_000) / df) / (rng.chisquare(prior, 200_000) / prior))
    z = np.clip(z, *np.quantile(z, [0.05, 0.9]))
    assert abs(z.mean() - mean) < 0.01 and abs(z.var() - spread) < 0.01


def plain_smooth(level, value, span):
    """Local lines at knots, from the rows themselves."""
    bins = np.clip(np.floor(level * glm.FINE), -glm.FINEST, glm.FINEST)
    order = sorted(set(bins))
    n = np.array([(bins == b).sum() for b in order])
    which = [math.floor((n[:i].sum() + n[i] / 2) / n.sum() * glm.KNOTS) for i in range(len(order))]
    groups = [np.isin(bins, [b for b, w in zip(order, which) if w == k]) for k in sorted(set(which))]
    at, many, mean = (np.array([f(g) for g in groups]) for f in (lambda g: level[g].mean(), lambda g: g.sum(), lambda g: value[g].mean()))
    out = []
    for a in at:
        far = np.abs(at - a)
        near = np.argsort(far, kind="stable")
        k = next(i for i in range(len(at)) if many[near[: i + 1]].sum() >= span * many.sum() or i == len(at) - 1)
        width = far[near[min(max(k, 2), len(at) - 1)]] * (1 + 1e-6) + 1e-9
        w = np.sqrt(many * np.maximum(0, 1 - (far / width) ** 3) ** 3)
        out.append(np.linalg.lstsq(np.c_[w, w * (at - a)], w * mean, rcond=None)[0][0])
    return at, np.array(out)


@pytest.mark.parametrize("shape", ["even", "sparse", "one"])
def test_trend_is_the_plain_local_regression(spark, shape):
    rng = np.random.default_rng(6)
    level = {"even": rng.uniform(-2, 14, 900), "sparse": np.r_[rng.normal(3, 0.2, 600), rng.uniform(-5, 19, 12)], "one": np.full(30, 4.25)}[shape]
    value = np.sin(level) + 0.1 * rng.normal(size=len(level))
    rows = spark.createDataFrame(pd.DataFrame({"level": level, "z": value}))
    found = glm.collected(rows, "level", [F.col("z")])
    at, smooth = plain_smooth(level, value, glm.SPAN)
    assert np.allclose(found.at, at, rtol=1e-9) and len(at) <= glm.KNOTS
    assert np.allclose(found.smooth()[:, 0], smooth, rtol=1e-6, atol=1e-6)
    own = found.along(level, np.exp(found.smooth()[:, 0]))
    assert np.allclose(np.log(own), np.interp(level, found.at, found.smooth()[:, 0]))


def test_hexagons_are_bounded_and_nearest(spark):
    rng = np.random.default_rng(10)
    pdf = pd.DataFrame({"i": range(5000), "x": rng.normal(size=5000), "y": rng.exponential(size=5000), "g": ["a", "b"] * 2500})
    pdf.loc[:2, "x"] = [np.nan, np.inf, 9.0]
    points = spark.createDataFrame(pdf)
    found = plots.hexagons(points, "x", "y", ("g",), 20).toPandas()
    assert found["n"].sum() == 4998 and len(found) < 2 * 20 * 40
    kept = pdf[np.isfinite(pdf["x"])]
    dx, dy = np.ptp(kept["x"]) / 20, np.ptp(kept["y"]) / 20 * 3**0.5
    placed = plots._placed(points, "x", "y", 20).toPandas()
    assert (((placed["x"] - placed["hex_x"]) / dx).abs() <= 0.5 + 1e-9).all() and (((placed["y"] - placed["hex_y"]) / dy).abs() <= 1 / 3 + 1e-9).all()
    few = found[found["n"] <= plots.ALONE]
    got = plots.apart(points, "x", "y", ("g",), 20).toPandas()
    assert len(got) == few["n"].sum() and 2 in set(got["i"]) and list(got.columns) == ["i", "x", "y", "g"]
    assert plots.hexagons(points.where("false"), "x", "y").collect() == []


def test_tagwise_lies_between_its_own_and_the_trend(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(200):
        size = 2 if i < 20 else 40
        rows += [(f"i{i:03d}", f"S{k}", int(rng.negative_binomial(size, size / (size + 100))), 250) for k in range(8)]
    cells = spark.createDataFrame(rows, "intron_id string, sample_id string, count long, shared_total long")
    meta = pd.DataFrame({"sample_id": [f"S{k}" for k in range(8)], "group": ["a"] * 4 + ["b"] * 4})
    table = glm.estimate(cells, meta).parameters().toPandas().set_index("intron_id").sort_index()
    assert table["dispersion"][:20].median() > 2 * table["dispersion"][20:].median() and (table["dispersion"] > 0).all()


def test_repeated_cells_add_up(spark):
    rows = [("i1", "S1", 2), ("i1", "S1", 3), ("i2", "S2", 1)]
    got = counts.densify(spark.createDataFrame(rows, "intron_id string, sample_id string, count long"), ["S1", "S2"]).collect()
    assert {tuple(r) for r in got} == {("i1", "S1", 5), ("i1", "S2", 0), ("i2", "S1", 0), ("i2", "S2", 1)}


def test_junctions_are_named_across_tiles(spark):
    rng = np.random.default_rng(1)
    seq = {"c1": "".join(rng.choice(list("ACGT"), 1000)), "c2": "ACGTA", "c3": ""}
    sites = [("c1", int(a), int(a + w)) for a, w in zip(rng.integers(1, 1010, 300), rng.integers(1, 90, 300))] + [("c2", 1, 5), ("c2", 5, 6), ("c3", 1, 4), ("zz", 1, 4), ("c1_alt", 3, 9)]
    rows = [("S", c, a, b, 1) for c, a, b in sites]
    got = counts.name_junctions(spark.createDataFrame(rows, "sample_id string, chrom string, start long, end long, count long"), spark.createDataFrame(list(seq.items()), "chrom string, seq string"), tile=64)
    want = [(f"{c}:{a}-{b}", f"{seq[c][a - 1 : a + 1]}--{seq[c][b - 2 : b]}") for c, a, b in sites if c in seq]
    assert sorted((r.intron, r.splice_pair) for r in got.collect()) == sorted(want)


def test_totals_table_must_be_whole(spark):
    cells = spark.createDataFrame([("i1", "S1", 2), ("i1", "S2", 3)], "intron_id string, sample_id string, count long")
    table = spark.createDataFrame([("i1", "S1", 1000.0), ("i1", "S2", 9.0)], "intron_id string, sample_id string, shared_total double")
    found = clusters.offsets(clusters.with_totals(cells, table)).collect()
    assert sorted(round(r.offset, 6) for r in found) == [round(math.log(9.5), 6), round(math.log(1000.5), 6)]
    with pytest.raises(Exception, match="no shared total for i1 in S2"):
        clusters.with_totals(cells, table.where("sample_id = 'S1'")).collect()


def test_bh_of_many_ties_and_nulls_in_groups(spark):
    rng = np.random.default_rng(7)
    rows = [(g, None if k == 0 else 1.0 if k == 1 else float(rng.random() ** 2)) for g in ("a", None) for k in rng.integers(0, 4, 2000)] + [("b", None)] * 3
    got = fdr.bh_fdr(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, g string, p double"), "p", ("g",)).orderBy("i").toPandas()
    assert len(got) == len(rows) and got.columns.tolist() == ["i", "g", "p", "FDR"]
    for g in ("a", None):
        own = [i for i, r in enumerate(rows) if r[0] == g and r[1] is not None]
        assert np.allclose(got["FDR"][own], reference_bh([rows[i][1] for i in own]), rtol=1e-12)
    assert got["FDR"].isna().sum() == sum(r[1] is None for r in rows)


def test_ties_and_nulls_are_spread(spark):
    """Half of the rows without a value and a third of one value: no task gets a large share of them."""
    rows = spark.range(200_000).selectExpr("id", "case when id % 2 = 0 then null when id % 6 < 3 then 1.0D else (id % 99991) / 1e5 end as p")
    told = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in told}
    try:
        for k, v in told.items():
            spark.conf.set(k, v)
        got = fdr.bh_fdr(rows, "p")
        sizes = got.groupBy(F.spark_partition_id()).count().toPandas()["count"]
        assert sizes.sum() == 200_000 and sizes.max() < 2 * 200_000 / 16
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_medians_by_group(spark):
    rng = np.random.default_rng(8)
    rows = [(g, None if rng.random() < 0.1 else float(rng.integers(0, 50))) for g in ("a", "b", None) for _ in range(int(rng.integers(1, 400)))] + [("c", None), ("d", 4.0), ("d", 5.0)]
    got = {r.g: r.m for r in ordered.medians(spark.createDataFrame(rows, "g string, v double").repartition(3), "v", ("g",), "m").collect()}
    assert got == {g: float(np.median([v for h, v in rows if h == g and v is not None])) for g in ("a", "b", None, "d")}
    assert [r.median for r in ordered.medians(spark.createDataFrame([], "v long"), "v").collect()] == [None]


def test_psi_table(spark):
    cells = spark.createDataFrame([("i1", s, p) for s, p in (("S1", 0.2), ("S2", 0.4), ("S3", 0.9), ("S9", 0.5))], "intron_id string, sample_id string, psi double")
    meta = spark.createDataFrame([("S1", "a"), ("S2", "a"), ("S3", "b")], "sample_id string, `group` string")
    row = psi.psi_table(cells, meta, ["S1", "S2", "S3", "S9"]).first()
    assert (row["S9_PSI"], round(row["a_mean_PSI"], 9), round(row["a_median_PSI"], 9), row["b_std_PSI"]) == (0.5, 0.3, 0.3, None)
    assert math.isclose(row["a_std_PSI"], 0.02**0.5) and math.isclose(row["delta_PSI"], -0.6)
    both = psi.with_psi(spark.createDataFrame([("i1", 1.0)], "intron_id string, logFC double"), psi.psi_table(cells, meta, ["S1"], "b-a"))
    assert both.columns == ["intron_id", "logFC", "a_mean_PSI", "a_median_PSI", "a_std_PSI", "b_mean_PSI", "b_median_PSI", "b_std_PSI", "delta_PSI"]
    every = {r.contrast: r.delta_psi for r in psi.contrast_deltas(cells, meta, {"a_vs_b": ("a", ["b"]), "b_vs_a": ("b", ["a"])}).collect()}
    assert math.isclose(every["a_vs_b"], -0.6) and math.isclose(every["b_vs_a"], 0.6)


def test_adjusted_values_of_sums_that_differ_when_computed_again(spark):
    """Sums of doubles are added in another order by another run of the same plan."""
    rows = spark.createDataFrame([(f"c{i}", "k", (i + 1) / 1000, 1.0) for i in range(200)], "cluster string, contrast string, PValue double, logFC double").repartition(3)

    def shaken(batches):
        for pdf in batches:
            yield pdf.assign(PValue=pdf["PValue"] * (1 + np.random.default_rng().integers(1, 1000, len(pdf)) * 1e-13))

    found = clusterstats.aggregate_clusters(rows.mapInPandas(shaken, rows.schema), by=("contrast",)).collect()
    assert len(found) == 200 and all(r.cluster_FDR is not None and r.cluster_FDR >= r.cluster_pvalue for r in found)


def test_points_of_a_plot_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    points = spark.range(300).select(F.lit("k").alias("contrast"), (F.col("id") % 17).cast("double").alias("x"), (F.col("id") % 23).cast("double").alias("y"))
    plots.apart(points.mapInPandas(counted, points.schema), "x", "y", ("contrast",)).collect()
    assert seen.value == 300


@pytest.fixture(scope="module")
def packed(spark):
    rows = [(i, f"S{k}", n) for i, ns in IDS for k, n in enumerate(ns, 1) if n]
    sparse = spark.createDataFrame(rows, "intron_id string, sample_id string, count long")
    return clusters.packed_clusters(sparse, ["S1", "S2", "S3"])


def test_packed_introns_have_the_totals_of_cells(packed, cells):
    want = clusters.add_totals(cells)
    got = clusters.dense_totals(packed, ["S1", "S2", "S3"]).select(*[f"`{c}`" for c in want.columns])
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    one = clusters.dense_totals(packed, ["S1", "S2", "S3"], ("donor_cluster",))
    assert one.where("shared_total <> donor_total").isEmpty() and "acceptor_total" not in one.columns


@pytest.mark.parametrize("kind", ["both", "donor", "acceptor"])
def test_packed_introns_are_filtered_as_cells(packed, cells, kind):
    for noncanonical in (False, True):
        limits = (4, 2, 6, 1, noncanonical, kind)
        want = filters.chain(cells, *limits).select("intron_id", "sample_id", "count")
        got = counts.unpacked(filters.chain(packed, *limits), ["S1", "S2", "S3"]).select("intron_id", "sample_id", "count")
        assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()
    assert filters.breakdown(packed, 6, 1).collect() == filters.breakdown(cells, 6, 1).collect()


def test_cells_are_not_dealt_by_sample(spark, cells):
    """Samples are few, so all cells would meet in as many tasks."""
    meta = spark.createDataFrame([("S1", "A"), ("S2", "B"), ("S3", "B")], "sample_id string, `group` string")
    plan = psi.grouped(psi.psi_values(clusters.add_totals(cells)), meta)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning(sample_id" not in plan


def test_fit_of_a_row_does_not_depend_on_its_batch():
    """Introns without reads in a group, whose coefficients run away, keep no other row going, nor do others keep them going."""
    rng = np.random.default_rng(4)
    x = np.zeros((7, 2))
    x[:3, 0] = x[3:, 1] = 1
    total = rng.integers(50, 4000, (60, 7))
    y = rng.binomial(total, rng.random((60, 1))).astype(float)
    y[::3, :3] = 0
    offset, phi = np.log(total + 0.5), np.full(60, 0.1)
    beta, mu = glm.fit(y, offset, x, phi)
    alone = [glm.fit(y[i : i + 1], offset[i : i + 1], x, phi[i : i + 1]) for i in range(60)]
    assert np.allclose(beta, np.concatenate([b for b, _ in alone]), atol=1e-9)
    assert np.allclose(mu, np.concatenate([m for _, m in alone]), rtol=1e-9)
