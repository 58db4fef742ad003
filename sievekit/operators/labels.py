"""Outcome labels (L1-L8): quantile labels and their documented variants."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import qname, quantiles
from ..functions.stats import scalars

BUY, HOLD, SELL = "Buy", "Hold", "Sell"


@dataclass(frozen=True)
class LabelPolicy:
    """How forward returns become Buy/Hold/Sell.

    ``inclusive``: Buy if r >= q_buy, else Sell if r <= q_sell (batch rule);
    ``strict``: Buy if r > q_buy, Sell if r < q_sell (tercile docs rule);
    ``qcut``: right-closed bins, Sell if r <= q_sell, Buy if r > q_buy.
    """
    buy_quantile: float = 0.70
    sell_quantile: float = 0.30
    mode: str = "inclusive"
    drop_null_outcome: bool = False     # tercile docs drop NULL returns first
    degenerate_guard: bool = True       # < 3 rows or < 2 distinct -> all Hold


# The policies found in the reference and its documents.
BATCH_POLICY = LabelPolicy(0.70, 0.30, "inclusive")
TERCILE_POLICY = LabelPolicy(0.66, 0.33, "strict", drop_null_outcome=True, degenerate_guard=False)
QCUT_POLICY = LabelPolicy(0.70, 0.30, "qcut", degenerate_guard=False)


def label_cutoffs(df: DataFrame, outcome: str = "forward_return",
                  probs=(0.33, 0.66), method: str = "exact") -> DataFrame:
    """One-row frame of outcome quantiles (the cutoff report)."""
    q = quantiles(df, [outcome], list(probs), method=method)
    return q.select(*[F.col(qname(outcome, p)).alias(f"q{round(p * 100):02d}") for p in probs])


def _classify(r: Column, qb: Column, qs: Column, mode: str) -> Column:
    if mode == "inclusive":
        # equal cutoffs switch to strict comparisons (L3)
        return (F.when(qb == qs, F.when(r > qb, BUY).when(r < qs, SELL).otherwise(HOLD))
                 .otherwise(F.when(r >= qb, BUY).when(r <= qs, SELL).otherwise(HOLD)))
    if mode == "strict":
        return F.when(r > qb, BUY).when(r < qs, SELL).otherwise(HOLD)
    if mode == "qcut":
        return (F.when(r.isNull(), F.lit(None).cast("string"))
                 .when(r <= qs, SELL).when(r > qb, BUY).otherwise(HOLD))
    raise ValueError(f"unknown label mode {mode!r}")


def quantile_label(df: DataFrame, policy: LabelPolicy = BATCH_POLICY,
                   outcome: str = "forward_return", target: str = "target",
                   method: str = "exact") -> DataFrame:
    """Add ``target`` from outcome quantiles.

    Cutoffs are scalar subqueries over the (already filtered) frame, so
    the frame is read once for the statistics and once for the rows.
    NULL outcomes fall through to Hold (NULL under ``qcut``).
    """
    if policy.drop_null_outcome:
        df = df.where(F.col(outcome).isNotNull())
    q = quantiles(df, [outcome], [policy.buy_quantile, policy.sell_quantile], method=method)
    s = scalars(q, [qname(outcome, policy.buy_quantile), qname(outcome, policy.sell_quantile)])
    qb, qs = s[qname(outcome, policy.buy_quantile)], s[qname(outcome, policy.sell_quantile)]
    r = F.col(outcome)
    label = _classify(r, qb, qs, policy.mode)
    if policy.degenerate_guard:
        # L2: nunique < 2  <=>  min == max (or no value at all)
        g = df.agg(F.count(F.lit(1)).alias("n"), F.min(outcome).alias("lo"),
                   F.max(outcome).alias("hi"))
        gs = scalars(g, ["n", "lo", "hi"])
        degenerate = (gs["n"] < 3) | F.coalesce(gs["lo"] == gs["hi"], F.lit(True))
        label = F.when(degenerate, F.lit(HOLD)).otherwise(label)
    return df.withColumn(target, label)


def fixed_bin_label(df: DataFrame, edges=(0.06, 0.11), outcome: str = "forward_return",
                    target: str = "target") -> DataFrame:
    """Right-closed fixed bins (-inf, e0], (e0, e1], (e1, inf) -> Sell/Hold/Buy."""
    r = F.col(outcome)
    return df.withColumn(target, F.when(r.isNull(), F.lit(None).cast("string"))
                         .when(r <= edges[0], SELL).when(r <= edges[1], HOLD).otherwise(BUY))


def class_distribution(df: DataFrame, col: str = "target") -> DataFrame:
    """Value counts, most frequent first (ties by label)."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.desc("count"), F.asc(col)))
