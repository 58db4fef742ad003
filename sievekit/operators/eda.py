"""Exploratory statistics (E1-E4): the *data* behind the charts.

E1 is a blocked accumulator of pairwise moments; E2 and E3 are per (feature, class) aggregates over an in-stage unpivot, with shared
bin edges per feature.  No chart is drawn.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.nulls import numeric_columns
from ..functions.quantiles import qname, quantiles
from ..functions.sqlexpr import lit_str, q

# The guided factor list and the default number of plots.
GUIDED_FEATURES = ("earnings_yield", "PE_ratio", "ROE", "DE_ratio", "revenue_growth",
                   "profit_margin", "quality_score", "leverage_adj_roe")
MAX_PLOTS = 4


def eda_columns(df: DataFrame, outcome: str = "forward_return") -> list[str]:
    """Numeric columns by type, minus the outcome."""
    return numeric_columns(df, exclude=(outcome,))


# --------------------------------------------------------------------- E1
# Columns of a block side: the accumulators of one block fit code generation's field limit
# (16 pairs x 4 + 8 x 3 without NULLs, 9 pairs x 10 with them).
BLOCK, BLOCK_WITH_NULLS = 4, 3


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Long-form Pearson matrix (feature_a, feature_b, corr), every
    ordered pair including the diagonal, each pair over its complete rows;
    NULL for a constant side or no complete row.

    The matrix is cut into blocks of column pairs.  A block is one ungrouped aggregate over its
    own columns (the scan reads only those): centred co-moments of its pairs and centred
    second moments of each side over the pair's complete rows, accumulated in place.  No row is
    multiplied, and one row a task is shuffled.  Columns without NULLs, told by a
    count, share their second moment among all pairs of a block.
    """
    cols = list(cols) if cols is not None else eda_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "feature_a string, feature_b string, corr double")
    n = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(c)).alias(f"_c{i}") for i, c in enumerate(cols)]).first()
    whole = {c for i, c in enumerate(cols) if n[f"_c{i}"] == n["_n"]}
    size = BLOCK if len(whole) == len(cols) else BLOCK_WITH_NULLS
    blocks = [cols[i:i + size] for i in range(0, len(cols), size)]
    out = None
    for i, side in enumerate(blocks):
        for other in blocks[i:]:
            pairs = [(a, b) for x, a in enumerate(side) for y, b in enumerate(other) if side is not other or x <= y]
            part = _block(df, pairs, whole)
            out = part if out is None else out.unionByName(part)
    return out


def _block(df: DataFrame, pairs: Sequence[tuple[str, str]], whole: set[str]) -> DataFrame:
    def value(c: str, with_: str) -> str:
        x = f"CAST({q(c)} AS DOUBLE)"
        return x if with_ in whole or with_ == c else f"CASE WHEN {q(with_)} IS NOT NULL THEN {x} END"

    rows = []
    aggs = []
    for k, (a, b) in enumerate(pairs):
        sd = f"stddev_pop({value(a, b)}) * stddev_pop({value(b, a)})"
        co = f"covar_pop({value(a, b)}, {value(b, a)})"
        aggs.append(F.expr(f"try_divide({co}, nullif({sd}, 0.0D)) AS _r{k}"))
        rows += [f"struct({lit_str(x)} AS feature_a, {lit_str(y)} AS feature_b, _r{k} AS corr)" for x, y in dict.fromkeys([(a, b), (b, a)])]
    return df.agg(*aggs).select(F.expr(f"inline(array({', '.join(rows)}))"))


def _long(df: DataFrame, cols: Sequence[str], hue: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast(DoubleType()).alias("x"))
                      for c in cols])
    return df.select(F.col(hue).alias("hue"), F.inline(pairs)).where(F.col("x").isNotNull())


# --------------------------------------------------------------------- E2
def bin_edges(df: DataFrame, cols: Sequence[str], bins="auto") -> DataFrame:
    """Per feature: (feature, lo, hi, nbins) shared by every class.

    ``bins="auto"`` follows numpy's rule: the smaller of the Sturges width
    and the Freedman-Diaconis width, the latter floored at half the
    square-root-rule width (which caps the bin count); an int fixes the
    count.  A constant feature gets one bin.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast(DoubleType()).alias("x"))
                      for c in cols])
    lx = df.select(F.inline(pairs)).where(F.col("x").isNotNull())
    stats = lx.groupBy("feature").agg(F.min("x").alias("lo"), F.max("x").alias("hi"),
                                      F.count(F.lit(1)).alias("n"))
    rng = F.col("hi") - F.col("lo")
    if bins == "auto":
        q = quantiles(lx, ["x"], [0.25, 0.75], by=["feature"])
        stats = stats.join(q, "feature", "left")
        iqr = F.col(qname("x", 0.75)) - F.col(qname("x", 0.25))
        n = F.col("n").cast(DoubleType())
        sturges = rng / (F.log2(n) + 1.0)
        fd = 2.0 * iqr * F.pow(n, -1.0 / 3.0)
        half_sqrt = rng / F.sqrt(n) / 2.0
        width = F.least(F.greatest(fd, half_sqrt), sturges)
        nb = F.when(rng > 0, F.ceil(rng / width)).otherwise(F.lit(1))
    else:
        nb = F.lit(int(bins))
    return stats.select("feature", "lo", "hi", F.greatest(nb, F.lit(1)).cast("long").alias("nbins"))


def histogram(df: DataFrame, cols: Sequence[str] | None = None, hue: str = "target",
              bins="auto") -> DataFrame:
    """Counts per (feature, class, bin) on edges shared by all classes;
    bins are left-closed, the last one closed: b = min(floor((x-lo)/(hi-lo)*k), k-1)."""
    cols = list(cols) if cols is not None else eda_columns(df)
    edges = bin_edges(df, cols, bins)
    long = _long(df, cols, hue)
    # one row per feature: a bound we know, so broadcast it (a shuffle join
    # on a dozen keys would funnel each feature's rows into one task)
    j = long.join(F.broadcast(edges), "feature")
    k = F.col("nbins")
    span = F.col("hi") - F.col("lo")
    b = F.when(span > 0, F.least(F.floor((F.col("x") - F.col("lo")) / span * k), k - 1)) \
         .otherwise(F.lit(0)).cast("long")
    width = span / k
    return (j.withColumn("bin", b)
             .groupBy("feature", F.col("hue").alias(hue), "bin")
             .agg(F.count(F.lit(1)).alias("count"),
                  F.first(F.col("lo") + F.col("bin") * width).alias("bin_lo"),
                  F.first(F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi")))


# --------------------------------------------------------------------- E3
def kde_curves(df: DataFrame, cols: Sequence[str] | None = None, hue: str = "target",
               gridsize: int = 200, cut: float = 3.0, bins_per_h: int | None = 20) -> DataFrame:
    """Gaussian KDE per (feature, class) on ``gridsize`` points over
    [min - cut*h, max + cut*h], Scott bandwidth h = sd_sample * n^(-1/5).

    Rows are first collapsed to equal-width bins per (feature, class) of at
    most h / ``bins_per_h`` -- (mean, weight) pairs -- so the error stays
    near 1 / (24 bins_per_h^2) of a kernel's height for any n, while the work per curve grows
    only with the range over h (n^(1/5)), not with n.  ``bins_per_h=None`` collapses
    equal values only: the exact density, at ``gridsize`` kernels per distinct value.
    Classes with < 2 rows or zero variance have no curve.
    """
    cols = list(cols) if cols is not None else eda_columns(df)
    long = _long(df, cols, hue)
    st = long.groupBy("feature", "hue").agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"),
        F.min("x").alias("lo"), F.max("x").alias("hi"))
    st = st.where((F.col("n") >= 2) & (F.col("sd") > 0))
    st = st.withColumn("h", F.col("sd") * F.pow(F.col("n").cast(DoubleType()), -0.2))
    # one row per feature and class; adaptive execution broadcasts it when small
    j = long.join(st, ["feature", "hue"])
    curve = ["feature", "hue", "n", "h", "lo", "hi"]
    if bins_per_h is None:
        binned = j.groupBy(*curve, F.col("x").alias("c")).agg(F.count(F.lit(1)).alias("w"))
    else:
        span = F.col("hi") - F.col("lo")
        nb = F.ceil(span / (F.col("h") / bins_per_h))
        b = F.when(span > 0, F.least(F.floor((F.col("x") - F.col("lo")) / span * nb), nb - 1)).otherwise(F.lit(0))
        binned = j.groupBy(*curve, b.cast("long").alias("b")).agg(F.count(F.lit(1)).alias("w"), F.avg("x").alias("c"))
    g_lo = F.col("lo") - cut * F.col("h")
    g_hi = F.col("hi") + cut * F.col("h")
    step = (g_hi - g_lo) / (gridsize - 1)
    pts = binned.select("feature", "hue", "n", "h", "w", "c",
                        F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("g"),
                        g_lo.alias("g_lo"), step.alias("step"))
    z = ((pts["g_lo"] + pts["g"] * pts["step"]) - pts["c"]) / pts["h"]
    contrib = pts.select("feature", "hue", "g", "n", "h",
                         (F.col("g_lo") + F.col("g") * F.col("step")).alias("x"),
                         (F.col("w") * F.exp(-0.5 * z * z)).alias("k"))
    norm = F.lit(1.0 / math.sqrt(2 * math.pi))
    return (contrib.groupBy("feature", F.col("hue").alias(hue), F.col("g").alias("grid_idx"))
                   .agg(F.first("x").alias("x"),
                        (F.sum("k") * norm / (F.first("n") * F.first("h"))).alias("density")))


# --------------------------------------------------------------------- E4
def choose_features(columns: Sequence[str], numeric: Sequence[str], mode: str = "guided",
                    k: int = MAX_PLOTS, seed: int | None = 42) -> list[str]:
    """Which features to plot (driver-side list logic).

    ``guided``: the guided list intersected with the columns, else the first
    ``k`` numeric columns; ``random``: up to ``k`` numeric columns drawn
    without replacement with a seeded generator.
    """
    numeric = list(numeric)
    if mode == "random":
        rng = random.Random(seed)
        return rng.sample(numeric, min(k, len(numeric)))
    guided = [c for c in GUIDED_FEATURES if c in columns]
    if not guided:
        guided = numeric[:k]
    return guided[:k]
