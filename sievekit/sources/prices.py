"""Price-history operators.

The as-of lookup behind the 12-month forward return is written so that no
task holds a whole ticker: rows are bucketed by (ticker, month); the
running "last close" is computed inside each bucket, and the value carried
in from earlier buckets comes from a per-(ticker, month) table, which has
at most one row per month of history whatever the ticker's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..session import materialize


def history_filter(df: DataFrame, prices: DataFrame, min_rows: int = 252,
                   key: str = "ticker") -> DataFrame:
    """Keep rows of ``df`` whose ticker has more than ``min_rows`` price
    rows (tickers without history drop out).  The count is a partial
    aggregate; the semi join never duplicates rows.  Adaptive execution
    broadcasts the key set when its measured size allows and otherwise splits
    the partitions of a hot ticker."""
    ok = (prices.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
                .where(F.col("_n") > min_rows).select(key))
    return df.join(ok, key, "left_semi")


def date_window(prices: DataFrame, end=None, years: int = 2, date_col: str = "date") -> DataFrame:
    """Rows with ``end - years <= date < end`` (a pushed-down range
    filter); ``end`` defaults to today."""
    if end is None:
        end_c = F.current_date()
    else:
        end_c = end if isinstance(end, Column) else F.lit(end).cast("date")
    start = F.add_months(end_c, -12 * years)
    d = F.col(date_col)
    return prices.where((d >= start) & (d < end_c))


def asof_last(probes: DataFrame, prices: DataFrame, probe_date: str, out: str = "asof_close",
              key: str = "ticker", date_col: str = "date", value: str = "close",
              keep_last: bool = False, last_col: str = "_last") -> DataFrame:
    """Backward as-of lookup: for each probe row, ``value`` at the latest
    price date <= ``probe_date`` of the same key (NULL if none).  A NULL price is
    no price: the last known one before it counts.  Of several prices of one key
    and date the largest counts.

    Probe rows keep all their columns; one output row per probe row.  With
    ``keep_last`` the key's last price date is added as ``last_col``.
    """
    pcols = probes.columns
    nulls = [F.lit(None).cast(f.dataType).alias(f"_p_{i}") for i, f in enumerate(probes.schema.fields)]
    ev_price = prices.select(F.col(key).alias("_k"), F.col(date_col).cast("date").alias("_d"),
                             F.lit(0).alias("_probe"), F.col(value).cast(DoubleType()).alias("_v"),
                             *nulls)
    ev_probe = probes.select(F.col(key).alias("_k"), F.col(probe_date).cast("date").alias("_d"),
                             F.lit(1).alias("_probe"), F.lit(None).cast(DoubleType()).alias("_v"),
                             *[F.col(c).alias(f"_p_{i}") for i, c in enumerate(pcols)])
    events = ev_price.unionByName(ev_probe).withColumn("_m", F.trunc("_d", "month"))

    # carry-in per (key, month): the last price of any earlier month.  The
    # month table has one row per month with prices or probes, so the
    # window below holds at most the months of one ticker's history.
    per_month = (events.where(F.col("_probe") == 0)
                       .groupBy("_k", "_m").agg(
                           # the last close that is known; of several on one day the largest
                           F.max(F.when(F.col("_v").isNotNull(), F.struct("_d", "_v")))["_v"].alias("_mv"),
                           F.max("_d").alias("_md")))
    probe_only = (events.where(F.col("_probe") == 1).select("_k", "_m").distinct()
                        .join(per_month.select("_k", "_m"), ["_k", "_m"], "left_anti")
                        .withColumn("_mv", F.lit(None).cast(DoubleType()))
                        .withColumn("_md", F.lit(None).cast("date")))
    earlier = Window.partitionBy("_k").orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_k")
    # the key's last price date rides along on the same small month table
    carry = (per_month.unionByName(probe_only)
                      .select("_k", "_m", F.last("_mv", ignorenulls=True).over(earlier).alias("_carry"),
                              F.max("_md").over(whole).alias(last_col)))

    # within-bucket running last value; prices sort before probes on a day
    within = (Window.partitionBy("_k", "_m").orderBy("_d", "_probe", F.col("_v").asc_nulls_first())
                    .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = events.withColumn("_local", F.last("_v", ignorenulls=True).over(within))
    hits = local.where(F.col("_probe") == 1).join(carry, ["_k", "_m"], "left")
    return hits.select(*[F.col(f"_p_{i}").alias(c) for i, c in enumerate(pcols)],
                       F.coalesce(F.col("_local"), F.col("_carry")).alias(out),
                       *([F.col(last_col)] if keep_last else []))


def forward_return(prices: DataFrame, months: int = 12, key: str = "ticker",
                   date_col: str = "date", value: str = "close",
                   out: str = "forward_return", barrier: str = "checkpoint") -> DataFrame:
    """(P[t + months] - P[t]) / P[t] for every (ticker, date) row, with
    P[t + months] the last close on or before that date; NULL when the
    horizon passes the ticker's last price date.  The panel is read twice
    (as prices and as probes), so it is materialized once first."""
    prices = materialize(prices.select(key, date_col, value), barrier)
    base = prices.select(key, date_col, value,
                         F.add_months(F.col(date_col), months).alias("_target"))
    hit = asof_last(base, prices, "_target", "_future", key, date_col, value, keep_last=True)
    fr = F.when(F.col("_target") > F.col("_last"), F.lit(None).cast(DoubleType())).otherwise(
        (F.col("_future") - F.col(value)) / F.col(value))
    return hit.select(key, date_col, value, fr.alias(out))
