"""Conforming raw feeds to the canonical table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..session import materialize

# Raw feed keys -> canonical column names.
FEATURE_MAP = {
    "trailingPE": "PE_ratio",
    "returnOnEquity": "ROE",
    "debtToEquity": "DE_ratio",
    "dividendYield": "dividend_yield",
    "revenueGrowth": "revenue_growth",
    "profitMargins": "profit_margin",
    "currentRatio": "current_ratio",
    "marketCap": "market_cap_raw",
    "beta": "beta",
    "sector": "sector",
}

# Expected canonical columns (ticker is placed first).
EXPECTED_COLUMNS = ("PE_ratio", "ROE", "DE_ratio", "dividend_yield", "revenue_growth",
                    "profit_margin", "current_ratio", "market_cap_log", "beta", "sector",
                    "forward_return", "ticker")

# The described columns; the sentences are this library's own.
COLUMN_DEFINITIONS = {
    "ticker": "Identifies the entity; one row per ticker in a cross-section.",
    "sector": "Peer group; missing ratios are filled with its median.",
    "PE_ratio": "Price over earnings per share; below zero when earnings are.",
    "ROE": "Net income over equity, as a fraction.",
    "DE_ratio": "Debt over equity.",
    "revenue_growth": "Change of revenue against the period before, as a fraction.",
    "profit_margin": "Net income over revenue, as a fraction.",
    "market_cap": "Value of all shares, in the currency of the feed.",
    "forward_return": "Price change over the twelve months that follow, as a fraction.",
    "earnings_yield": "Reciprocal of PE_ratio; missing where that is zero.",
    "quality_score": "ROE times profit_margin.",
    "leverage_adj_roe": "ROE scaled down in proportion to DE_ratio, to zero at the largest DE_ratio.",
}
DEFAULT_DEFINITION = "No definition recorded; see the feed's own documentation."


def rename_raw(df: DataFrame, mapping: dict[str, str] = FEATURE_MAP) -> DataFrame:
    """Raw feed keys -> canonical names (absent keys are skipped)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def log_market_cap(df: DataFrame) -> DataFrame:
    """``market_cap_log = log10(market_cap_raw)`` (else from
    ``market_cap``); the source column is dropped.  log10 of 0 or a
    negative value is NULL."""
    for src in ("market_cap_raw", "market_cap"):
        if src in df.columns:
            return df.withColumn("market_cap_log", F.log10(F.col(src).cast(DoubleType()))).drop(src)
    return df


def conform_columns(df: DataFrame, expected: Sequence[str] = EXPECTED_COLUMNS, prefix: str = "SYN") -> DataFrame:
    """Add missing expected columns as typed NULLs, ticker first, then
    the expected order (extra columns are dropped).  A missing ticker is generated
    as S7 does, ``SYN{i}`` with dense i, in the order of :func:`hashed_index`; a ticker
    column that is there stays as it is, NULLs included."""
    def typed(c):
        if c in df.columns:
            return F.col(c)
        t = StringType() if c in ("ticker", "sector") else DoubleType()
        return F.lit(None).cast(t).alias(c)
    order = ["ticker", *[c for c in expected if c != "ticker"]]
    if "ticker" in df.columns:
        return df.select(*[typed(c) for c in order])
    whole = df.select(*[typed(c) for c in order[1:]])
    return hashed_index(whole).select(F.concat(F.lit(prefix), F.col("_idx").cast("string")).alias("ticker"), *order[1:])


# Hash buckets of :func:`hashed_index`: the rows of its broadcast table of offsets.
INDEX_BUCKETS = 65_536


def hashed_index(df: DataFrame, out: str = "_idx") -> DataFrame:
    """0-based dense row index in two levels, hash bucket and rank inside it: it depends on
    the rows alone, not on their partitions.  Nothing is written or sorted as a whole: rows
    are counted per bucket, offsets are prefix sums over ``INDEX_BUCKETS`` counts, and windows
    order n / ``INDEX_BUCKETS`` rows by (hash, columns).  Only rows equal throughout tie;
    which of them takes which number makes no difference."""
    columns = [F.col(c) for c in df.columns]
    hashed = (df.withColumn("_h", F.xxhash64(*columns))
                .withColumn("_b", F.pmod("_h", F.lit(INDEX_BUCKETS)).cast("int")))
    counts = hashed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_b", F.coalesce(F.sum("_n").over(
        Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    rank = F.row_number().over(Window.partitionBy("_b").orderBy("_h", *columns))
    return hashed.join(F.broadcast(offsets), "_b").select(*df.columns, (F.col("_off") + rank - 1).alias(out))


def dense_index(df: DataFrame, order_by: Sequence, out: str = "_idx",
                barrier: str = "checkpoint") -> DataFrame:
    """0-based dense row index in ``order_by`` order, without a single-task
    window: sort (range-partitioned), tag each row with its partition and
    position, prefix-sum the per-partition counts (one row per partition),
    add the offset.  The sorted frame is materialized first so both reads
    see the same partitioning."""
    tagged = (df.orderBy(*order_by)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id()))
    tagged = materialize(tagged, barrier)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    # window over the partition-count table only (one row per partition)
    offsets = counts.select("_pid", "_m0", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    j = tagged.join(F.broadcast(offsets), "_pid")
    return j.select(*df.columns, (F.col("_off") + F.col("_mid") - F.col("_m0")).alias(out))


def ensure_ticker(df: DataFrame, order_by: Sequence | None = None, prefix: str = "SYN") -> DataFrame:
    """When ``ticker`` is absent, generate ``SYN{i}`` from a dense index
    over a stable ordering (all columns, NULLs first, by default)."""
    if "ticker" in df.columns:
        return df
    order_by = order_by or [F.col(c).asc_nulls_first() for c in df.columns]
    idx = dense_index(df, order_by)
    return idx.select(F.concat(F.lit(prefix), F.col("_idx").cast("string")).alias("ticker"),
                      *df.columns)


_DICT_SCHEMA = StructType([StructField("column", StringType()),
                           StructField("meaning", StringType())])


def data_dictionary(spark: SparkSession, df: DataFrame,
                    definitions: dict[str, str] = COLUMN_DEFINITIONS) -> DataFrame:
    """One row per column of ``df`` with its definition (default text
    when undefined).  Built from the schema, not the data."""
    cols = spark.createDataFrame([(c,) for c in df.columns], "column string")
    defs = spark.createDataFrame(list(definitions.items()), _DICT_SCHEMA)
    return (cols.join(defs, "column", "left")
                .select("column", F.coalesce("meaning", F.lit(DEFAULT_DEFINITION)).alias("meaning")))


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns) as a one-row frame (one counting job)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def head(df: DataFrame, n: int = 5, order_by: str = "ticker") -> DataFrame:
    """A deterministic preview -- the first ``n`` rows by key."""
    return df.orderBy(order_by).limit(n)
