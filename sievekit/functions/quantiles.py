"""Exact, skew-safe quantiles (linear interpolation) for many columns at once.

Spark's built-in exact ``percentile`` keeps a value->count map per group and
merges it in a single task, so one group holding a third of the rows puts a
third of the distinct values in one task.  ``method="exact"`` here avoids
that:

1. one pass of ``percentile_approx``, minima and maxima gives, per group and
   column, value bounds that are guaranteed (by the sketch's rank-error bound)
   to enclose the two order statistics the interpolation needs, but for one rank;
2. one *wide* aggregate counts, per column and probability, the values below the
   band, and keeps the nearest value on either side of it: one row per group and
   task is shuffled, rows are not multiplied;
3. only values *inside* a band (about 6 / accuracy of the rows per probability)
   become rows of their own, collapsed to (value, count) and cut into ``BAND_BINS``
   bins by value.  Prefix sums over the bins name the one or two that hold ranks
   floor((n-1)p) and ceil((n-1)p), and only their values are ordered by a window,
   per bin.  The result is lo + (hi - lo) * frac, the same linear rule as pandas
   ``quantile`` and SQL ``quantile_cont``.

There is one path for all sizes; the largest window holds about
6n / (accuracy * BAND_BINS) distinct values of a group of n rows.  NaN counts as
missing, like NULL.  ``method="approx"`` is plain ``percentile_approx`` (one pass,
bounded memory).  Results are small DataFrames: one row per group, one column per
(column, probability), named by :func:`qname`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .sqlexpr import lit_num, lit_str, q
from .stats import attach_by_group

DEFAULT_ACCURACY = 10000
# Bins of a band (a table bound, not a limit on rows).
BAND_BINS = 1024


def qname(column: str, prob: float) -> str:
    """Column name of quantile ``prob`` of ``column`` in a wide stats frame."""
    return f"{column}__q{round(prob * 10000):05d}"


def _null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str], rkeys: Sequence[str]):
    cond = None
    for k, rk in zip(keys, rkeys):
        c = left[k].eqNullSafe(right[rk])
        cond = c if cond is None else cond & c
    return cond


def _arr(ps) -> str:
    return "array(" + ", ".join(lit_num(p) for p in ps) + ")"


def _value(c: str) -> str:
    """A column as double, NaN as NULL."""
    return f"nanvl(CAST({q(c)} AS DOUBLE), CAST(NULL AS DOUBLE))"


def sketch_bounds(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                  by: Sequence[str] = (), accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Pass 1: per group, ``percentile_approx`` at p -/+ 3/accuracy for every
    column (``_b<i>``: lower bounds then upper bounds).  A side past an end of
    [0, 1] takes the minimum or maximum itself.  One row per group."""
    delta = 3.0 / accuracy
    inner = [p - delta for p in probs] + [p + delta for p in probs]
    aggs = []
    for i, c in enumerate(cols):
        sketch = f"percentile_approx({_value(c)}, {_arr([min(max(p, 0.0), 1.0) for p in inner])}, {accuracy})"
        bounds = [f"min({_value(c)})" if p <= 0.0 else f"max({_value(c)})" if p >= 1.0 else f"{sketch}[{k}]"
                  for k, p in enumerate(inner)]
        aggs.append(F.expr(f"array({', '.join(bounds)}) AS _b{i}"))
    return df.groupBy(*by).agg(*aggs)


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
              by: Sequence[str] = (), method: str = "exact",
              accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Wide form: one row per group of ``by`` with one column per
    (column, prob) named ``qname(column, prob)``; NULL where a group has no
    value for a column.  With ``by=()`` the result has exactly one row, also of an empty frame.

    The result is lazy after pass 1; callers that use it twice write it."""
    by, cols, probs = list(by), list(cols), [float(p) for p in probs]
    k = len(probs)
    slots = [(i, j) for i in range(len(cols)) for j in range(k)]
    names = [q(qname(cols[i], probs[j])) for i, j in slots]
    if method == "approx":
        wide = df.groupBy(*by).agg(*[
            F.expr(f"percentile_approx({_value(c)}, {_arr(probs)}, {accuracy}) AS _b{i}")
            for i, c in enumerate(cols)])
        return wide.select(*by, *[F.expr(f"_b{i}[{j}] AS {n}") for (i, j), n in zip(slots, names)])
    if method != "exact":
        raise ValueError(f"unknown quantile method {method!r}")

    # -- pass 1: bounds around each target rank, next to every row ----------
    sketch = sketch_bounds(df, cols, probs, by, accuracy)
    values = df.select(*by, *[F.expr(f"{_value(c)} AS _x{i}") for i, c in enumerate(cols)])
    if by:
        # one row per group, written once; adaptive execution broadcasts it when it is small
        rows = attach_by_group(values, materialize(sketch), by, prefix="_s")
        lo, hi = [[f"_s_b{i}[{m + j}]" for i, j in slots] for m in (0, k)]
    else:
        row, rows = sketch.first(), values
        lo, hi = [["CAST(NULL AS DOUBLE)" if row[f"_b{i}"][m + j] is None else lit_num(row[f"_b{i}"][m + j])
                   for i, j in slots] for m in (0, k)]

    # -- pass 2: counts below each band and the nearest values outside it ---
    aggs = [F.expr(f"count(_x{i}) AS _n{i}") for i in range(len(cols))]
    for s, (i, _) in enumerate(slots):
        aggs += [F.expr(f"count(CASE WHEN _x{i} < {lo[s]} THEN 1 END) AS _below{s}"),
                 F.expr(f"max(CASE WHEN _x{i} < {lo[s]} THEN _x{i} END) AS _pred{s}"),
                 F.expr(f"min(CASE WHEN _x{i} > {hi[s]} THEN _x{i} END) AS _succ{s}")]
    items = ", ".join(f"struct({s} AS slot, (_n{i} - 1) * {lit_num(probs[j])} AS pos, _below{s} AS below, "
                      f"_pred{s} AS pred, _succ{s} AS succ)" for s, (i, j) in enumerate(slots))
    totals = rows.groupBy(*by).agg(*aggs).select(*by, F.expr(f"inline(array({items}))")).select(
        *by, "slot", "pos", F.expr("floor(pos) - below AS _lo"), F.expr("ceil(pos) - below AS _hi"), "pred", "succ")

    # -- pass 3: in-band values, binned --------------------------------------
    items = ", ".join(f"struct({s} AS slot, _x{i} AS x, {lo[s]} AS lo, {hi[s]} AS hi)" for s, (i, _) in enumerate(slots))
    # an infinite or empty span leaves one bin
    share = "nanvl(coalesce(try_divide(x - lo, nullif(hi - lo, 0.0D)), 0.0D), 0.0D)"
    keys = [*by, "slot"]
    band = (rows.select(*by, F.expr(f"inline(filter(array({items}), e -> e.x >= e.lo AND e.x <= e.hi))"))
                .withColumn("_bin", F.expr(f"CAST(least(floor({share} * {BAND_BINS}), {BAND_BINS - 1}) AS INT)"))
                .groupBy(*keys, "_bin", "x").agg(F.count(F.lit(1)).alias("cnt")))
    earlier = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = (band.groupBy(*keys, "_bin").agg(F.sum("cnt").alias("_in"))
                .withColumn("_upto", F.coalesce(F.sum("_in").over(earlier), F.lit(0))))

    def renamed(frame: DataFrame, columns: Sequence[str], prefix: str, *rest: str) -> DataFrame:
        return frame.select(*[F.col(n).alias(f"{prefix}{m}") for m, n in enumerate(columns)], *rest)

    def tagged(columns: Sequence[str], prefix: str) -> list[str]:
        return [f"{prefix}{m}" for m in range(len(columns))]

    wanted = renamed(totals, keys, "_t", "_lo", "_hi")
    holds = " OR ".join(f"({r} >= _upto AND {r} < _upto + _in)" for r in ("_lo", "_hi"))
    chosen = bins.join(wanted, _null_safe_on(bins, wanted, keys, tagged(keys, "_t"))).where(holds)
    bkeys = [*keys, "_bin"]
    chosen = renamed(chosen, bkeys, "_k", "_upto", "_lo", "_hi")
    within = Window.partitionBy(*bkeys).orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (band.join(chosen, _null_safe_on(band, chosen, bkeys, tagged(bkeys, "_k")))
                  .withColumn("_reach", F.col("_upto") + F.sum("cnt").over(within)))
    picked = [f"CASE WHEN {r} >= _reach - cnt AND {r} < _reach THEN x END AS b{r}" for r in ("_lo", "_hi")]

    # -- the totals and the values at the ranks meet in one row per group ---
    null = "CAST(NULL AS DOUBLE)"
    both = totals.selectExpr(*[q(b) for b in by], "slot", "pos", "_lo", "_hi", "pred", "succ", f"{null} AS b_lo", f"{null} AS b_hi").unionByName(
        ranked.selectExpr(*[q(b) for b in by], "slot", f"{null} AS pos", "CAST(NULL AS BIGINT) AS _lo", "CAST(NULL AS BIGINT) AS _hi",
                          f"{null} AS pred", f"{null} AS succ", *picked).where("b_lo IS NOT NULL OR b_hi IS NOT NULL"))
    out = both.groupBy(*by).agg(*[
        F.expr(f"max(CASE WHEN slot = {s} THEN struct(pos, _lo, _hi, pred, succ) END) FILTER (WHERE pos IS NOT NULL) AS _t{s}")
        for s in range(len(slots))], *[
        F.expr(f"min(CASE WHEN slot = {s} THEN b{r} END) AS _v{s}{r}") for s in range(len(slots)) for r in ("_lo", "_hi")])

    def at(s: int, r: str) -> str:
        # a rank outside the band is the nearest value outside (ties included)
        return f"CASE WHEN _t{s}.{r} < 0 THEN _t{s}.pred ELSE coalesce(_v{s}{r}, _t{s}.succ) END"

    return out.select(*by, *[F.expr(f"{at(s, '_lo')} + ({at(s, '_hi')} - {at(s, '_lo')}) * (_t{s}.pos - floor(_t{s}.pos)) AS {n}")
                             for s, n in enumerate(names)])
