"""ANSI-SQL oracles (DuckDB dialect) for the registered queries.

These strings are the *independent* statement of each query's semantics:
the same fixture views, cleaning chain and labels written as plain SQL
with CTEs, so the DataFrame implementation can be checked row by row.
Fitted statistics are computed with ``quantile_cont`` (linear
interpolation, as pandas and our exact quantile).
"""

from __future__ import annotations

FUNDAMENTALS = """
fundamentals AS (
  WITH o AS (
    SELECT o_custkey AS k,
      CAST(COUNT(CASE WHEN o_orderdate < TIMESTAMP '1999-01-01 00:00:00' THEN 1 END) AS DOUBLE) AS n,
      CAST(SUM(CASE WHEN o_orderdate < TIMESTAMP '1999-01-01 00:00:00' THEN CAST(ROUND(o_totalprice * 100) AS BIGINT) END) AS DOUBLE) / 100 / NULLIF(COUNT(CASE WHEN o_orderdate < TIMESTAMP '1999-01-01 00:00:00' THEN o_totalprice END), 0) AS avg_price,
      CAST(SUM(CASE WHEN o_orderdate < TIMESTAMP '1999-01-01 00:00:00' THEN CAST(ROUND(o_totalprice * 100) AS BIGINT) END) AS DOUBLE) / 100 AS tot,
      CAST(SUM(CASE WHEN o_orderdate < TIMESTAMP '1997-01-01 00:00:00' THEN CAST(ROUND(o_totalprice * 100) AS BIGINT) END) AS DOUBLE) / 100 AS rev0,
      CAST(SUM(CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1999-01-01 00:00:00' THEN CAST(ROUND(o_totalprice * 100) AS BIGINT) END) AS DOUBLE) / 100 AS rev1,
      CAST(SUM(CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01 00:00:00' THEN CAST(ROUND(o_totalprice * 100) AS BIGINT) END) AS DOUBLE) / 100 AS rev2,
      CAST(SUM(CASE WHEN o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1999-01-01 00:00:00' THEN CAST(ROUND(o_totalprice * 100) AS BIGINT) END) AS DOUBLE) / 100 AS st_f,
      CAST(SUM(CASE WHEN o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '1999-01-01 00:00:00' THEN CAST(ROUND(o_totalprice * 100) AS BIGINT) END) AS DOUBLE) / 100 AS st_o,
      CAST(SUM(CASE WHEN o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '1999-01-01 00:00:00' THEN CAST(ROUND(o_totalprice * 100) AS BIGINT) END) AS DOUBLE) / 100 AS st_p
    FROM orders GROUP BY o_custkey),
  l AS (
    SELECT o_custkey AS k, CAST(SUM(CAST(ROUND(l_discount * 100) AS BIGINT)) AS DOUBLE) / 100 / NULLIF(COUNT(l_discount), 0) AS disc,
           CAST(SUM(CAST(ROUND(l_tax * 100) AS BIGINT)) AS DOUBLE) / 100 / NULLIF(COUNT(l_tax), 0) AS tax
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00' GROUP BY o_custkey)
  SELECT c_name AS ticker,
    CASE WHEN c_custkey % 50 = 7 THEN NULL ELSE c_mktsegment END AS sector,
    avg_price / NULLIF(c_acctbal, 0) / 4 AS PE_ratio,
    c_acctbal / NULLIF(tot, 0) * 25 AS ROE,
    st_f / NULLIF(st_o, 0) AS DE_ratio,
    disc AS dividend_yield,
    rev1 / NULLIF(rev0, 0) - 1 AS revenue_growth,
    tax * 3 AS profit_margin,
    st_o / NULLIF(st_p, 0) AS current_ratio,
    LOG10(tot) AS market_cap_log,
    n / 6 AS beta,
    rev2 / NULLIF(rev1, 0) - 1 AS forward_return
  FROM customer LEFT JOIN o ON c_custkey = o.k LEFT JOIN l ON c_custkey = l.k)"""

PRICES = """
prices AS (
  SELECT concat(c_mktsegment, '/', o_orderpriority) AS ticker,
         CAST(o_orderdate AS DATE) AS date,
         CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 / COUNT(o_totalprice) AS close
  FROM orders JOIN customer ON o_custkey = c_custkey
  GROUP BY concat(c_mktsegment, '/', o_orderpriority), CAST(o_orderdate AS DATE))"""

SCORED = """
scored AS (
  WITH s AS (
    SELECT ticker, sector, forward_return, beta, PE_ratio, ROE, DE_ratio, revenue_growth, profit_margin,
      ROUND(1 / (1 + EXP(-(3 * LEAST(GREATEST(ROE, -1), 1)
                         + 0.5 * LEAST(GREATEST(revenue_growth, -1), 3) - 0.5))), 2) AS p_buy
    FROM fundamentals
    WHERE forward_return IS NOT NULL AND ROE IS NOT NULL AND revenue_growth IS NOT NULL),
  s2 AS (
    SELECT *, FLOOR((1 - p_buy) * beta / (beta + 1) * 100 + 0.3137) / 100 AS sell_p FROM s)
  SELECT ticker, sector, forward_return,
    CASE WHEN forward_return >= 1.0 THEN 'Buy' WHEN forward_return <= -0.25 THEN 'Sell' ELSE 'Hold' END AS target,
    CASE WHEN PE_ratio > 30 OR PE_ratio < 0 OR ROE < 0.05 OR DE_ratio > 3.0 OR revenue_growth < -0.10 THEN 'Sell'
         WHEN PE_ratio > 0 AND PE_ratio < 20 AND ROE > 0.12 AND DE_ratio < 1.5
          AND revenue_growth > 0.05 AND profit_margin > 0.08 THEN 'Buy' ELSE 'Hold' END AS signal_rules,
    CASE WHEN p_buy >= 0.55 THEN 'Buy' WHEN p_buy <= 0.42 THEN 'Sell' ELSE 'Hold' END AS ml_pred_class,
    CAST(p_buy AS DOUBLE) AS ml_buy_proba,
    CAST(sell_p AS DOUBLE) AS ml_sell_proba,
    CAST(1 - p_buy - sell_p AS DOUBLE) AS ml_hold_proba
  FROM s2)"""

# The canonical cross-section columns.
RAW_COLUMNS = ["ticker", "sector", "PE_ratio", "ROE", "DE_ratio", "dividend_yield",
               "revenue_growth", "profit_margin", "current_ratio", "market_cap_log", "beta",
               "forward_return"]
FEATURES = ["PE_ratio", "ROE", "DE_ratio", "dividend_yield", "revenue_growth", "profit_margin",
            "current_ratio", "market_cap_log", "beta"]


def _nonnull_count(cols):
    return " + ".join(f"(CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END)" for c in cols)


def clean_ctes(thresh: int = 9, lower: float = 0.01, upper: float = 0.99) -> str:
    """CTEs c1 .. clean: the cleaning chain over ``fundamentals``."""
    f = FEATURES
    med = ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in f)
    c5 = ", ".join(f"COALESCE(c4.{c}, m.{c}) AS {c}" for c in f)
    c6 = ", ".join(f"COALESCE(c5.{c}, g.{c}) AS {c}" for c in f)
    wb = ", ".join(f"quantile_cont({c}, {lower}) AS {c}_lo, quantile_cont({c}, {upper}) AS {c}_hi"
                   for c in f)
    c8 = ", ".join(f"CASE WHEN {c} IS NULL THEN NULL ELSE LEAST(GREATEST({c}, {c}_lo), {c}_hi) END AS {c}"
                   for c in f)
    return f"""
c1 AS (SELECT * FROM fundamentals WHERE {_nonnull_count(RAW_COLUMNS)} >= {thresh}),
c4 AS (SELECT ticker, COALESCE(sector, 'Unknown') AS sector, {", ".join(f)}, forward_return FROM c1),
m AS (SELECT sector, {med} FROM c4 GROUP BY sector),
c5 AS (SELECT c4.ticker, c4.sector, {c5}, c4.forward_return FROM c4 LEFT JOIN m ON c4.sector = m.sector),
g AS (SELECT {med} FROM c5),
c6 AS (SELECT c5.ticker, c5.sector, {c6}, c5.forward_return FROM c5, g),
wb AS (SELECT {wb} FROM c6),
c8 AS (SELECT ticker, sector, {c8}, forward_return FROM c6, wb),
eng AS (
  SELECT c8.*,
    CASE WHEN PE_ratio <> 0 THEN 1.0 / PE_ratio END AS earnings_yield,
    ROE * profit_margin AS quality_score,
    CASE WHEN mx.v = 0 OR mx.v IS NULL THEN ROE ELSE ROE * (1 - DE_ratio / mx.v) END AS leverage_adj_roe
  FROM c8, (SELECT MAX(DE_ratio) AS v FROM c8) mx),
clean AS (
  SELECT ticker, sector, {", ".join(f)}, forward_return, earnings_yield, quality_score, leverage_adj_roe
  FROM eng WHERE earnings_yield IS NOT NULL AND quality_score IS NOT NULL
    AND leverage_adj_roe IS NOT NULL AND forward_return IS NOT NULL)"""


LABELLED = """
lq AS (SELECT quantile_cont(forward_return, 0.7) AS qb, quantile_cont(forward_return, 0.3) AS qs,
              COUNT(*) AS n, MIN(forward_return) AS lo, MAX(forward_return) AS hi FROM clean),
labelled AS (
  SELECT clean.*,
    CASE WHEN lq.n < 3 OR COALESCE(lq.lo = lq.hi, TRUE) THEN 'Hold'
         WHEN lq.qb = lq.qs THEN
           CASE WHEN forward_return > qb THEN 'Buy' WHEN forward_return < qs THEN 'Sell' ELSE 'Hold' END
         ELSE CASE WHEN forward_return >= qb THEN 'Buy' WHEN forward_return <= qs THEN 'Sell' ELSE 'Hold' END
    END AS target
  FROM clean, lq)"""

STRICT_SIGNAL = """CASE WHEN PE_ratio > 30 OR PE_ratio < 0 OR ROE < 0.05 OR DE_ratio > 3.0
          OR revenue_growth < -0.10 THEN 'Sell'
     WHEN PE_ratio > 0 AND PE_ratio < 20 AND ROE > 0.12 AND DE_ratio < 1.5
          AND revenue_growth > 0.05 AND profit_margin > 0.08 THEN 'Buy' ELSE 'Hold' END"""

SCREENED = f"""
screened AS (SELECT labelled.*, {STRICT_SIGNAL} AS signal_rules FROM labelled)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def clean_prefix(*extra: str) -> tuple[str, ...]:
    return (FUNDAMENTALS, clean_ctes(), *extra)
