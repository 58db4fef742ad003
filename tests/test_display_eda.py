import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievekit.functions.fmt import MISSING, fmt_num, fmt_pct
from sievekit.operators import eda as E


@pytest.mark.parametrize("x", [0.1234, 0.03625, 0.02675, -0.004, 1.0, 12.3456789, 1234.5])
def test_format_matches_python(spark, x):
    row = spark.createDataFrame([(x,)], "x double").select(
        fmt_pct(F.col("x")).alias("p"), fmt_num(F.col("x")).alias("n"),
        fmt_num(F.col("x"), 1).alias("n1")).first()
    assert row.p == f"{100 * x:.2f}%"
    assert row.n == f"{x:.3f}" and row.n1 == f"{x:.1f}"


def test_format_missing_and_text(spark):
    df = spark.createDataFrame([(None,), ("0.5",), ("n/a",)], "s string")
    got = [r.p for r in df.select(fmt_pct(F.col("s")).alias("p")).collect()]
    assert got == [MISSING, "50.00%", MISSING]


def test_choose_features():
    cols = ["ticker", "ROE", "beta", "PE_ratio", "x"]
    assert E.choose_features(cols, ["ROE", "beta", "PE_ratio", "x"]) == ["PE_ratio", "ROE"]
    assert E.choose_features(["a", "b"], ["a", "b"]) == ["a", "b"]
    pick = E.choose_features(cols, ["a", "b", "c", "d", "e", "f"], mode="random", seed=1)
    assert len(pick) == 4 and len(set(pick)) == 4
    assert pick == E.choose_features(cols, ["a", "b", "c", "d", "e", "f"], mode="random", seed=1)


def test_histogram_auto_bins_match_numpy(spark):
    rng = np.random.default_rng(2)
    vals = rng.lognormal(size=500)
    df = spark.createDataFrame([(float(v), "A" if i % 3 else "B") for i, v in enumerate(vals)],
                               "x double, target string")
    h = E.histogram(df, ["x"], "target", "auto").toPandas()
    edges = np.histogram_bin_edges(vals, bins="auto")
    assert h.bin.max() + 1 == len(edges) - 1
    assert h["count"].sum() == 500
    counts, _ = np.histogram(vals, bins=len(edges) - 1)
    got = h.groupby("bin")["count"].sum().reindex(range(len(counts)), fill_value=0).to_numpy()
    assert np.abs(got - counts).sum() <= 2          # edge rounding only


def test_kde_integrates_to_one(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(float(v), "A") for v in rng.normal(size=300)], "x double, target string")
    k = E.kde_curves(df, ["x"], "target").toPandas().sort_values("grid_idx")
    area = np.trapezoid(k.density, k.x) if hasattr(np, "trapezoid") else np.trapz(k.density, k.x)
    assert area == pytest.approx(1.0, abs=0.01)


def test_correlation_diagonal_and_constant(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 5.9, 5.0)], "a double, b double, c double")
    m = {(r.feature_a, r.feature_b): r.corr for r in E.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert len(m) == 9
    assert m[("a", "a")] == pytest.approx(1.0) and m[("a", "b")] == m[("b", "a")]
    assert m[("a", "c")] is None and m[("c", "c")] is None
    assert not math.isnan(m[("a", "b")])


def test_kde_is_near_the_exact_density(spark):
    import numpy as np

    from sievekit.operators import eda as E
    r = np.random.default_rng(3)
    x = np.concatenate([r.normal(0, 1, 700), r.normal(5, 0.2, 300), [60.0]])
    df = spark.createDataFrame([(float(v), "A") for v in x], "x double, target string")
    k = E.kde_curves(df, ["x"], "target").toPandas().sort_values("grid_idx")
    h = x.std(ddof=1) * len(x) ** -0.2
    exact = np.exp(-0.5 * ((k["x"].to_numpy()[:, None] - x) / h) ** 2).sum(axis=1) / (len(x) * h * np.sqrt(2 * np.pi))
    assert np.abs(k["density"] - exact).max() < 5e-4 * exact.max()


def test_exact_kde_is_the_density(spark):
    """Ties, a skewed class and a class without spread: every grid point equals the sum over all rows."""
    rng = np.random.default_rng(12)
    x = np.round(np.concatenate([rng.exponential(2, 400), rng.normal(5, 1, 100), [3.0] * 20]), 1)
    hue = ["a"] * 400 + ["b"] * 100 + ["c"] * 20
    df = spark.createDataFrame([(float(v), h) for v, h in zip(x, hue)] + [(None, "a")], "x double, target string")
    k = E.kde_curves(df, ["x"], "target", gridsize=40, bins_per_h=None).toPandas().sort_values("grid_idx")
    assert sorted(k["target"].unique()) == ["a", "b"]
    for h in "ab":
        v = x[np.array(hue) == h]
        bw = v.std(ddof=1) * len(v) ** -0.2
        grid = np.linspace(v.min() - 3 * bw, v.max() + 3 * bw, 40)
        want = np.exp(-0.5 * ((grid[:, None] - v) / bw) ** 2).sum(axis=1) / (len(v) * bw * np.sqrt(2 * np.pi))
        got = k[k["target"] == h]
        assert np.allclose(got["x"], grid) and np.allclose(got["density"], want, rtol=1e-10, atol=1e-14)
