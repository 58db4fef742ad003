"""Threshold rule screens.

A rulebook is data: Buy conditions (all must hold), Sell conditions (any
triggers) and a precedence.  Every predicate is a native comparison,
``coalesce``-guarded so NULL or a missing column reads as "not met" --
exactly how a NaN or an absent column behaves in the original masks.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from ..functions.nulls import col_or_null, truthy

_OPS = {
    ">": lambda x, v: x > v, ">=": lambda x, v: x >= v,
    "<": lambda x, v: x < v, "<=": lambda x, v: x <= v,
}


@dataclass(frozen=True)
class Rule:
    column: str
    op: str
    value: float

    def predicate(self, df: DataFrame) -> Column:
        if self.column not in df.columns:
            return F.lit(False)
        # NaN and NULL never meet a threshold (NaN sorts above all numbers in Spark)
        x = F.nanvl(F.col(self.column), F.lit(None).cast("double"))
        return truthy(_OPS[self.op](x, F.lit(float(self.value))))


@dataclass(frozen=True)
class Rulebook:
    name: str
    buy: tuple[Rule, ...]
    sell: tuple[Rule, ...]
    precedence: str = "sell"            # "sell": Sell overrides Buy; "buy": Buy first
    distances: tuple[tuple[str, str, float, int], ...] = field(default=())

    def buy_mask(self, df: DataFrame) -> Column:
        return reduce(lambda a, b: a & b, [r.predicate(df) for r in self.buy], F.lit(True))

    def sell_mask(self, df: DataFrame) -> Column:
        return reduce(lambda a, b: a | b, [r.predicate(df) for r in self.sell], F.lit(False))


# The four rulebooks (column, operator, threshold) as stated
# by the reference code (strict and inclusive) and its documents.
STRICT = Rulebook(
    "strict",
    buy=(Rule("PE_ratio", ">", 0), Rule("PE_ratio", "<", 20), Rule("ROE", ">", 0.12),
         Rule("DE_ratio", "<", 1.5), Rule("revenue_growth", ">", 0.05),
         Rule("profit_margin", ">", 0.08)),
    sell=(Rule("PE_ratio", ">", 30), Rule("PE_ratio", "<", 0), Rule("ROE", "<", 0.05),
          Rule("DE_ratio", ">", 3.0), Rule("revenue_growth", "<", -0.10)),
    precedence="sell")

INCLUSIVE = Rulebook(
    "inclusive",
    buy=(Rule("PE_ratio", ">=", 0), Rule("PE_ratio", "<=", 20), Rule("ROE", ">=", 0.12),
         Rule("DE_ratio", "<=", 1.5), Rule("revenue_growth", ">=", 0.05),
         Rule("profit_margin", ">=", 0.08)),
    sell=(Rule("PE_ratio", ">=", 40), Rule("ROE", "<=", 0.05), Rule("DE_ratio", ">=", 3.0),
          Rule("revenue_growth", "<=", 0.0), Rule("profit_margin", "<=", 0.02)),
    precedence="sell",
    # (output column, input column, threshold, sign): sign +1 -> x - t, -1 -> t - x
    distances=(("dist_PE_to_max_buy", "PE_ratio", 20.0, -1),
               ("dist_ROE_to_min_buy", "ROE", 0.12, 1),
               ("dist_DE_to_max_buy", "DE_ratio", 1.5, -1),
               ("dist_rev_growth_to_min_buy", "revenue_growth", 0.05, 1),
               ("dist_profit_margin_to_min_buy", "profit_margin", 0.08, 1)))

DOCS = Rulebook(
    "docs",
    buy=(Rule("PE_ratio", ">", 0), Rule("PE_ratio", "<=", 20), Rule("ROE", ">", 0.12),
         Rule("DE_ratio", "<", 1.5), Rule("revenue_growth", ">", 0.05),
         Rule("profit_margin", ">", 0.08)),
    sell=(Rule("PE_ratio", ">", 50), Rule("PE_ratio", "<=", 0), Rule("ROE", "<", 0.05),
          Rule("DE_ratio", ">", 3.0), Rule("revenue_growth", "<", -0.05),
          Rule("profit_margin", "<", 0.01)),
    precedence="buy")

ALTERNATE = Rulebook(
    "alternate",
    buy=(Rule("PE_ratio", ">", 0), Rule("PE_ratio", "<=", 20), Rule("ROE", ">", 0.12),
         Rule("DE_ratio", "<", 1.5), Rule("revenue_growth", ">", 0.05),
         Rule("profit_margin", ">", 0.08)),
    sell=(Rule("PE_ratio", ">", 50), Rule("ROE", "<", 0.02), Rule("DE_ratio", ">", 5)),
    precedence="sell")

RULEBOOKS = {rb.name: rb for rb in (STRICT, INCLUSIVE, DOCS, ALTERNATE)}

MIN_DISTANCE = "min_distance_to_buy_threshold"


def screen(df: DataFrame, rulebook: Rulebook = STRICT, out: str = "signal_rules") -> DataFrame:
    """Add the Buy/Hold/Sell signal of ``rulebook``."""
    buy, sell = rulebook.buy_mask(df), rulebook.sell_mask(df)
    if rulebook.precedence == "sell":
        sig = F.when(sell, "Sell").when(buy, "Buy").otherwise("Hold")
    else:
        sig = F.when(buy, "Buy").when(sell, "Sell").otherwise("Hold")
    return df.withColumn(out, sig)


def add_distances(df: DataFrame, rulebook: Rulebook = INCLUSIVE) -> DataFrame:
    """Signed distance to each Buy threshold (positive = passes
    with margin) and their row-wise minimum, NULLs skipped."""
    cols = []
    for name, src, t, sign in distances_of(rulebook):
        x = col_or_null(df, src)
        cols.append(((x - F.lit(t)) if sign > 0 else (F.lit(t) - x)).cast(DoubleType()).alias(name))
    out = df.select("*", *cols)
    names = [F.col(d[0]) for d in distances_of(rulebook)]
    least = names[0] if len(names) == 1 else F.least(*names) if names else F.lit(None).cast(DoubleType())
    return out.withColumn(MIN_DISTANCE, least)


# Short names of the screened columns in distance columns.
_SHORT = {"PE_ratio": "PE", "ROE": "ROE", "DE_ratio": "DE", "revenue_growth": "rev_growth",
          "profit_margin": "profit_margin"}


def distances_of(rulebook: Rulebook) -> tuple[tuple[str, str, float, int], ...]:
    """The distance columns of a rulebook: those it states, else one for each
    Buy rule: to its maximum for an upper threshold (t - x), to its minimum for a
    lower one (x - t).  The lower end of a column that also has an upper one is
    no distance (a small P/E is no near miss)."""
    if rulebook.distances:
        return rulebook.distances
    capped = {r.column for r in rulebook.buy if r.op in ("<", "<=")}
    out = []
    for r in rulebook.buy:
        upper = r.op in ("<", "<=")
        if upper or r.column not in capped:
            out.append((f"dist_{_SHORT.get(r.column, r.column)}_to_{'max' if upper else 'min'}_buy", r.column,
                        float(r.value), -1 if upper else 1))
    return tuple(dict.fromkeys(out))


def screen_with_distances(df: DataFrame, rulebook: Rulebook = INCLUSIVE) -> DataFrame:
    """R2+R3+R4 as one projection: distances first, then the signal."""
    return add_distances(screen(df, rulebook), rulebook)


_RULE_SCHEMA = StructType([
    StructField("rulebook", StringType()), StructField("side", StringType()),
    StructField("position", IntegerType()), StructField("column", StringType()),
    StructField("op", StringType()), StructField("value", DoubleType()),
    StructField("name", StringType())])


def rulebook_table(spark: SparkSession, rulebook: Rulebook) -> DataFrame:
    """The rulebook as a small DataFrame (what the committee approves).

    Sides 'buy' and 'sell' hold the rules in order, 'precedence' the side that
    wins (in ``op``), 'distance' the stated distance columns (``name``, the sign
    in ``op``)."""
    rows = [(rulebook.name, side, i, r.column, r.op, float(r.value), None)
            for side, rules in (("buy", rulebook.buy), ("sell", rulebook.sell)) for i, r in enumerate(rules)]
    rows.append((rulebook.name, "precedence", 0, None, rulebook.precedence, None, None))
    rows += [(rulebook.name, "distance", i, src, "+" if sign > 0 else "-", float(t), name)
             for i, (name, src, t, sign) in enumerate(rulebook.distances)]
    return spark.createDataFrame(rows, _RULE_SCHEMA)


def rulebook_from_table(table_rows, name: str | None = None, precedence: str | None = None) -> Rulebook:
    """Rebuild a rulebook from rows of :func:`rulebook_table` (bounded), in any order.
    ``name`` and ``precedence`` override what the table says."""
    rows = sorted((r.asDict() if hasattr(r, "asDict") else dict(r) for r in table_rows),
                  key=lambda r: (r["side"], r.get("position") or 0))
    rules = {side: tuple(Rule(r["column"], r["op"], r["value"]) for r in rows if r["side"] == side)
             for side in ("buy", "sell")}
    stated = next((r["op"] for r in rows if r["side"] == "precedence"), "sell")
    distances = tuple((r["name"], r["column"], r["value"], 1 if r["op"] == "+" else -1)
                      for r in rows if r["side"] == "distance")
    known = next((r["rulebook"] for r in rows), "custom")
    return Rulebook(name or known, rules["buy"], rules["sell"], precedence or stated, distances)


# The columns of the signal sample.
SAMPLE_COLUMNS = ("ticker", "PE_ratio", "ROE", "DE_ratio", "revenue_growth", "profit_margin",
                  "signal_rules", MIN_DISTANCE, "target")


def signal_sample(df: DataFrame, n: int = 5, columns=SAMPLE_COLUMNS,
                  order_by: str = "ticker") -> DataFrame:
    """The first ``n`` rows (by ticker) with whichever columns exist.
    A top-n by key: each task keeps n rows, the driver merges them."""
    cols = [c for c in columns if c in df.columns]
    return df.select(*cols).orderBy(order_by).limit(n)
