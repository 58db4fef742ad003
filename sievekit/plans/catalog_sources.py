"""Registered source/sink and formatting queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.fmt import fmt_num, fmt_pct
from ..sources import conform as S
from ..sources import files as IO
from ..sources import prices as P
from ..sources.fixtures import fundamentals, prices
from . import oracle_sql as O
from .registry import register, rounded, sel
from .workflow import cleaned

RAW = O.RAW_COLUMNS
RAW_D = [*O.FEATURES, "forward_return"]


def _fund_sql(body: str) -> str:
    return O.with_ctes(O.FUNDAMENTALS, body=body)


@register("s01_read_csv", _fund_sql(f"SELECT {sel(RAW, RAW_D)} FROM fundamentals"))
def q_s01(spark, sf_dir):
    path = IO.scratch_path(spark, "fundamentals-csv")
    fundamentals(spark, sf_dir).write.mode("overwrite").option("header", True).csv(path)
    return rounded(IO.read_fundamentals(spark, path).select(*RAW))


@register("s02_write_cache", _fund_sql(
    "SELECT COUNT(*) >= 50 AS written, COUNT(*) AS rows_read_back FROM fundamentals"))
def q_s02(spark, sf_dir):
    path = IO.scratch_path(spark, "fundamentals-cache")
    written = IO.write_cache(fundamentals(spark, sf_dir), path, min_rows=50)
    back = IO.read_fundamentals(spark, path) if written else spark.range(0)
    return back.agg(F.lit(written).alias("written"), F.count(F.lit(1)).alias("rows_read_back"))


@register("s03_first_sufficient_source", _fund_sql(
    f"SELECT 'live' AS source, {sel(RAW, RAW_D)} FROM fundamentals"))
def q_s03(spark, sf_dir):
    missing = IO.scratch_path(spark, "no-such-cache")
    tiers = [IO.Tier("cache", lambda: IO.read_fundamentals(spark, missing)),
             IO.Tier("live", lambda: fundamentals(spark, sf_dir), min_rows=50),
             IO.Tier("csv", lambda: IO.read_fundamentals(spark, missing + "-csv"))]
    name, df = IO.first_sufficient(tiers)
    return rounded(df.select(F.lit(name).alias("source"), *RAW))


# The feed's own keys, spelled out here so that a wrong entry of the map shows.
_FEED_KEYS = {
    "sector": "sector", "trailingPE": "PE_ratio", "returnOnEquity": "ROE", "debtToEquity": "DE_ratio",
    "dividendYield": "dividend_yield", "revenueGrowth": "revenue_growth", "profitMargins": "profit_margin",
    "currentRatio": "current_ratio", "beta": "beta",
}


def _raw_feed(spark, sf_dir):
    """The fundamentals as a raw feed delivers them (vendor keys, market cap in USD)."""
    f = fundamentals(spark, sf_dir)
    cols = [F.col(c).alias(key) for key, c in _FEED_KEYS.items()]
    return f.select("ticker", *cols, F.pow(F.lit(10.0), F.col("market_cap_log")).alias("marketCap"), "forward_return")


_S04_COLS = ["ticker", "sector", "PE_ratio", "ROE", "DE_ratio", "dividend_yield", "revenue_growth",
             "profit_margin", "current_ratio", "beta", "forward_return"]


@register("s04_rename_raw_keys", _fund_sql(
    f"SELECT {sel(_S04_COLS, RAW_D)} FROM fundamentals"))
def q_s04(spark, sf_dir):
    return rounded(S.rename_raw(_raw_feed(spark, sf_dir)).select(*_S04_COLS))


@register("s05_log_market_cap", _fund_sql(
    "SELECT ticker, ROUND(market_cap_log, 9) AS market_cap_log FROM fundamentals"))
def q_s05(spark, sf_dir):
    df = S.log_market_cap(S.rename_raw(_raw_feed(spark, sf_dir)))
    return rounded(df.select("ticker", "market_cap_log"))


_S06 = ["ticker", *[c for c in S.EXPECTED_COLUMNS if c != "ticker"]]


@register("s06_conform_columns", _fund_sql("SELECT " + ", ".join(
    "CAST(NULL AS DOUBLE) AS " + c if c in ("beta", "current_ratio")
    else (f"ROUND({c}, 9) AS {c}" if c in RAW_D else c) for c in _S06) + " FROM fundamentals"))
def q_s06(spark, sf_dir):
    df = fundamentals(spark, sf_dir).drop("beta", "current_ratio")
    return rounded(S.conform_columns(df))


_NOTICK = [c for c in RAW if c != "ticker"]


@register("s07_generate_ticker", _fund_sql(
    "SELECT 'SYN' || CAST(row_number() OVER (ORDER BY "
    + ", ".join(f"{c} ASC NULLS FIRST" for c in _NOTICK)
    + ") - 1 AS VARCHAR) AS ticker, " + sel(_NOTICK, RAW_D) + " FROM fundamentals"))
def q_s07(spark, sf_dir):
    return rounded(S.ensure_ticker(fundamentals(spark, sf_dir).drop("ticker")))


def _price_sql(body: str) -> str:
    return O.with_ctes(O.PRICES, body=body)


@register("s08_history_filter", _price_sql("""
, n AS (SELECT ticker FROM prices GROUP BY ticker HAVING COUNT(*) > 530)
SELECT ticker, date, ROUND(close, 9) AS close FROM prices WHERE ticker IN (SELECT ticker FROM n)"""))
def q_s08(spark, sf_dir):
    p = prices(spark, sf_dir)
    return rounded(P.history_filter(p, p, min_rows=530))


@register("s09_date_window", _price_sql("""
SELECT ticker, date, ROUND(close, 9) AS close FROM prices
WHERE date >= DATE '1996-12-31' AND date < DATE '1998-12-31'"""))
def q_s09(spark, sf_dir):
    return rounded(P.date_window(prices(spark, sf_dir), "1998-12-31", years=2))


@register("s10_forward_return", _price_sql("""
, probes AS (SELECT ticker, date, close, CAST(date + INTERVAL 12 MONTH AS DATE) AS target FROM prices),
mx AS (SELECT ticker, MAX(date) AS last_date FROM prices GROUP BY ticker)
SELECT pr.ticker, pr.date, ROUND(pr.close, 9) AS close,
       ROUND(CASE WHEN pr.target > mx.last_date THEN NULL ELSE (p.close - pr.close) / pr.close END, 9)
         AS forward_return
FROM probes pr ASOF LEFT JOIN prices p ON pr.ticker = p.ticker AND pr.target >= p.date
JOIN mx ON pr.ticker = mx.ticker"""))
def q_s10(spark, sf_dir):
    return rounded(P.forward_return(prices(spark, sf_dir)))


@register("s12_shape", _fund_sql("SELECT COUNT(*) AS rows, 12 AS columns FROM fundamentals"))
def q_s12_shape(spark, sf_dir):
    return S.shape(fundamentals(spark, sf_dir))


@register("s12_head_preview", _fund_sql(
    f"SELECT {sel(RAW, RAW_D)} FROM fundamentals ORDER BY ticker LIMIT 5"))
def q_s12_head(spark, sf_dir):
    return rounded(S.head(fundamentals(spark, sf_dir)))


_RATIOS = [*O.FEATURES, "earnings_yield", "quality_score", "leverage_adj_roe", "forward_return"]


def _printf(fmt: str, value: str, name: str) -> str:
    return ", ".join(f"CASE WHEN {c} IS NULL THEN '—' ELSE printf('{fmt}', {value.format(c)}) END AS {c}{name}" for c in _RATIOS)


@register("x01_format_percent", O.with_ctes(*O.clean_prefix(), body=f"""
SELECT ticker, {_printf('%.2f%%', '{} * 100', '_pct')} FROM clean"""))
def q_x01(spark, sf_dir):
    """Every ratio of the cleaned rows as percent text."""
    c = cleaned(spark, sf_dir)
    return c.select("ticker", *[fmt_pct(F.col(r)).alias(f"{r}_pct") for r in _RATIOS])


@register("x02_format_number", O.with_ctes(*O.clean_prefix(), body=f"""
SELECT ticker, {_printf('%.3f', '{}', '_text')}, {_printf('%.1f', '{}', '_short')} FROM clean"""))
def q_x02(spark, sf_dir):
    """Every ratio of the cleaned rows with three decimals and with one."""
    c = cleaned(spark, sf_dir)
    return c.select("ticker", *[fmt_num(F.col(r)).alias(f"{r}_text") for r in _RATIOS],
                    *[fmt_num(F.col(r), 1).alias(f"{r}_short") for r in _RATIOS])
