"""Derived fixture views built from the driver's TPC-H-style tables.

There is no fundamentals feed offline, so the cross-section is derived
from ``customer``/``orders``/``lineitem`` (one row per customer, features
from orders before 1999-01-01, outcome from later ones: no look-ahead).

Plan shape (what keeps this cheap at 100 TB):

* ``lineitem`` is pre-aggregated per order key *before* any join (map-side
  partial aggregation; TPC-H lineitem is clustered by order key), so the
  widest table is reduced ~4x before its only shuffle;
* the per-order aggregate is already hash-partitioned by order key, so
  the join with ``orders`` shuffles only ``orders``;
* one grouped pass per customer computes every feature (no second pass
  over orders);
* both sides of the customer join are keyed uniquely by customer key, so
  a hot customer cannot skew it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .tables import read_table

# Period boundaries of the derived cross-section.
FEATURE_END = "1999-01-01 00:00:00"
GROWTH_SPLIT = "1997-01-01 00:00:00"


def _cents(c: str):
    """A two-decimal amount as whole cents: sums are exact in any order."""
    return F.round(F.col(c) * 100).cast("long")


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


def fundamentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical ``fundamentals`` table (ticker, sector, 9 ratios, forward_return)."""
    customer = read_table(spark, sf_dir, "customer",
                          ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"])
    orders = read_table(spark, sf_dir, "orders",
                        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    lineitem = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_discount", "l_tax"])

    per_order = lineitem.groupBy("l_orderkey").agg(
        F.sum(_cents("l_discount")).alias("sd"), F.count("l_discount").alias("nd"),
        F.sum(_cents("l_tax")).alias("st"), F.count("l_tax").alias("nt"))

    end, split = _ts(FEATURE_END), _ts(GROWTH_SPLIT)
    d, p, s = F.col("o_orderdate"), _cents("o_totalprice"), F.col("o_orderstatus")

    def total(cents):
        return F.sum(cents).cast(DoubleType()) / 100
    pre = d < end
    o = (orders.join(per_order, orders["o_orderkey"] == per_order["l_orderkey"], "left")
         .groupBy("o_custkey")
         .agg(F.count(F.when(pre, F.lit(1))).cast(DoubleType()).alias("n"),
              F.try_divide(total(F.when(pre, p)), F.count(F.when(pre, p)).cast(DoubleType())).alias("avg_price"),
              total(F.when(pre, p)).alias("tot"),
              total(F.when(d < split, p)).alias("rev0"),
              total(F.when((d >= split) & pre, p)).alias("rev1"),
              total(F.when(d >= end, p)).alias("rev2"),
              total(F.when((s == "F") & pre, p)).alias("st_f"),
              total(F.when((s == "O") & pre, p)).alias("st_o"),
              total(F.when((s == "P") & pre, p)).alias("st_p"),
              # lineitem averages over orders before the cut (NULL when none)
              F.try_divide(total(F.when(pre, F.col("sd"))),
                           F.sum(F.when(pre, F.col("nd"))).cast(DoubleType())).alias("disc"),
              F.try_divide(total(F.when(pre, F.col("st"))),
                           F.sum(F.when(pre, F.col("nt"))).cast(DoubleType())).alias("tax")))

    def ratio(a, b):
        return F.try_divide(a, F.when(b != 0, b))

    c = customer.join(o, customer["c_custkey"] == o["o_custkey"], "left")
    return c.select(
        F.col("c_name").alias("ticker"),
        F.when(F.col("c_custkey") % 50 == 7, F.lit(None).cast("string"))
         .otherwise(F.col("c_mktsegment")).alias("sector"),
        (ratio(F.col("avg_price"), F.col("c_acctbal")) / 4).alias("PE_ratio"),
        (ratio(F.col("c_acctbal"), F.col("tot")) * 25).alias("ROE"),
        ratio(F.col("st_f"), F.col("st_o")).alias("DE_ratio"),
        F.col("disc").alias("dividend_yield"),
        (ratio(F.col("rev1"), F.col("rev0")) - 1).alias("revenue_growth"),
        (F.col("tax") * 3).alias("profit_margin"),
        ratio(F.col("st_o"), F.col("st_p")).alias("current_ratio"),
        F.log10(F.col("tot")).alias("market_cap_log"),
        (F.col("n") / 6).alias("beta"),
        (ratio(F.col("rev2"), F.col("rev1")) - 1).alias("forward_return"),
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long price table (ticker, date, close): 25 synthetic tickers
    (segment/priority), daily average order price.

    Orders are pre-aggregated per (customer, day, priority) before the
    customer join, so a customer with a third of all orders contributes
    one row per day and priority to that join instead of all its orders.
    """
    orders = read_table(spark, sf_dir, "orders",
                        ["o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"])
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    pre = (orders.groupBy("o_custkey", F.to_date("o_orderdate").alias("date"), "o_orderpriority")
                 .agg(F.sum(_cents("o_totalprice")).alias("s"), F.count("o_totalprice").alias("n")))
    j = pre.join(customer, pre["o_custkey"] == customer["c_custkey"], "inner")
    return (j.groupBy(F.concat(F.col("c_mktsegment"), F.lit("/"), F.col("o_orderpriority"))
                       .alias("ticker"), "date")
             .agg((F.sum("s").cast(DoubleType()) / 100 / F.sum("n").cast(DoubleType())).alias("close")))


def scored(spark: SparkSession, sf_dir: str, fund: DataFrame | None = None) -> DataFrame:
    """Predictions without a model (exact-oracle input for evaluation ops).

    Columns: ticker, sector, forward_return, target, signal_rules,
    ml_pred_class, ml_buy_proba, ml_sell_proba, ml_hold_proba.
    """
    f = fund if fund is not None else fundamentals(spark, sf_dir)
    f = f.where(F.col("forward_return").isNotNull() & F.col("ROE").isNotNull()
                & F.col("revenue_growth").isNotNull())
    roe = F.least(F.greatest(F.col("ROE"), F.lit(-1.0)), F.lit(1.0))
    rg = F.least(F.greatest(F.col("revenue_growth"), F.lit(-1.0)), F.lit(3.0))
    p_buy = F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-(3 * roe + 0.5 * rg - 0.5))), 2)
    s = f.select("ticker", "sector", "forward_return", "beta", "PE_ratio", "ROE", "DE_ratio",
                 "revenue_growth", "profit_margin", p_buy.alias("p_buy"))
    pe, r, de, g, pm = (F.col(c) for c in ("PE_ratio", "ROE", "DE_ratio", "revenue_growth",
                                          "profit_margin"))
    fr = F.col("forward_return")
    sell = (pe > 30) | (pe < 0) | (r < 0.05) | (de > 3.0) | (g < -0.10)
    buy = (pe > 0) & (pe < 20) & (r > 0.12) & (de < 1.5) & (g > 0.05) & (pm > 0.08)
    pb = F.col("p_buy")
    sell_p = F.floor((1 - pb) * F.col("beta") / (F.col("beta") + 1) * 100 + 0.3137) / 100
    return s.select(
        "ticker", "sector", "forward_return",
        F.when(fr >= 1.0, "Buy").when(fr <= -0.25, "Sell").otherwise("Hold").alias("target"),
        F.when(sell, "Sell").when(buy, "Buy").otherwise("Hold").alias("signal_rules"),
        F.when(pb >= 0.55, "Buy").when(pb <= 0.42, "Sell").otherwise("Hold").alias("ml_pred_class"),
        pb.alias("ml_buy_proba"),
        sell_p.cast(DoubleType()).alias("ml_sell_proba"),
        (1 - pb - sell_p).cast(DoubleType()).alias("ml_hold_proba"),
    )
