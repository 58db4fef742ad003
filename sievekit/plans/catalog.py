"""Registered queries: one DataFrame builder + one oracle SQL per operator.

Every query reads the driver's tables (through the fixture views) in full;
no id subsets, prefixes or row caps.  Double outputs are rounded to 6
decimals on both sides so the comparison is insensitive to summation
order.  Keys are ``<operator id>_<slug>``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import nan_to_null
from ..operators import clean as C
from ..operators import labels as L
from ..operators import rules as R
from ..session import materialize
from ..sources.fixtures import fundamentals
from . import oracle_sql as O
from .registry import register, round6, rounded, sel
from .workflow import cleaned, labelled, screened, signal_returns

FEAT = O.FEATURES
RAW = O.RAW_COLUMNS
RAW_D = [*FEAT, "forward_return"]
ENG = ["earnings_yield", "quality_score", "leverage_adj_roe"]
CLEAN_COLS = ["ticker", "sector", *FEAT, "forward_return", *ENG]
CLEAN_D = [*FEAT, "forward_return", *ENG]


def _stage(spark, sf_dir, upto: str, barrier: str = "checkpoint") -> DataFrame:
    """fundamentals -> ... -> ``upto`` using the library operators."""
    df = C.coerce_numeric(nan_to_null(fundamentals(spark, sf_dir)))
    df = C.drop_sparse_rows(df)
    if upto == "c1":
        return df
    cols = C.feature_columns(df)
    df = materialize(C.fill_sector(df), barrier)
    if upto == "c4":
        return df
    # as in the library chain: one full-data barrier (above), the median
    # table is written by the imputation itself, later steps are projections
    df = C.impute_group_median(df, cols, "sector", barrier=barrier)
    if upto == "c5":
        return df
    df = C.impute_global_median(df, cols)
    if upto == "c6":
        return df
    return C.winsorize(df, cols)


# --------------------------------------------------------------------- flagship
FLAGSHIP_SQL = O.with_ctes(*O.clean_prefix(O.LABELLED, O.SCREENED), body="""
SELECT signal_rules, COUNT(*) AS n_names, ROUND(AVG(forward_return), 9) AS avg_forward_return,
       COUNT(CASE WHEN target = signal_rules THEN 1 END) AS n_agree
FROM screened GROUP BY signal_rules""")


@register("flagship_signal_returns", FLAGSHIP_SQL)
def q_flagship(spark, sf_dir):
    return rounded(signal_returns(screened(spark, sf_dir)))


# --------------------------------------------------------------------- cleaning
@register("c01_drop_sparse_rows", O.with_ctes(O.FUNDAMENTALS, body=f"""
SELECT {sel(RAW, RAW_D)} FROM fundamentals
WHERE {O._nonnull_count(RAW)} >= 9"""))
def q_c01(spark, sf_dir):
    return rounded(C.drop_sparse_rows(nan_to_null(fundamentals(spark, sf_dir))))


@register("c02_coerce_numeric", O.with_ctes(O.FUNDAMENTALS, body="""
SELECT ticker, ROUND(PE_ratio, 9) AS PE_ratio, ROUND(ROE, 9) AS ROE,
       CAST(NULL AS DOUBLE) AS sector_as_number FROM fundamentals"""))
def q_c02(spark, sf_dir):
    f = fundamentals(spark, sf_dir)
    text = f.select("ticker", F.col("PE_ratio").cast("string").alias("PE_ratio"),
                    F.col("ROE").cast("string").alias("ROE"),
                    F.col("sector").alias("sector_as_number"))
    return rounded(C.coerce_numeric(text, keep_text=("ticker",)))


@register("c04_fill_sector", O.with_ctes(O.FUNDAMENTALS, O.clean_ctes(), body="""
SELECT ticker, sector FROM c4"""))
def q_c04(spark, sf_dir):
    return _stage(spark, sf_dir, "c4", "none").select("ticker", "sector")


@register("c05_sector_median_impute", O.with_ctes(O.FUNDAMENTALS, O.clean_ctes(), body=f"""
SELECT {sel(RAW, RAW_D)} FROM c5"""))
def q_c05(spark, sf_dir):
    return rounded(_stage(spark, sf_dir, "c5").select(*RAW))


@register("c06_global_median_impute", O.with_ctes(O.FUNDAMENTALS, O.clean_ctes(), body=f"""
SELECT {sel(RAW, RAW_D)} FROM c6"""))
def q_c06(spark, sf_dir):
    return rounded(_stage(spark, sf_dir, "c6").select(*RAW))


_C07_SQL = O.with_ctes(O.FUNDAMENTALS, body=f"""
, c1 AS (SELECT * FROM fundamentals WHERE {O._nonnull_count(RAW)} >= 9),
g AS (SELECT {", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in FEAT)} FROM c1)
SELECT c1.ticker, {", ".join(f"ROUND(COALESCE(c1.{c}, g.{c}), 9) AS {c}" for c in FEAT)},
       ROUND(c1.forward_return, 9) AS forward_return
FROM c1, g""")


@register("c07_global_only_impute", _C07_SQL)
def q_c07(spark, sf_dir):
    df = C.drop_sparse_rows(nan_to_null(fundamentals(spark, sf_dir))).drop("sector")
    df = materialize(df)
    return rounded(C.impute_global_median(df, C.feature_columns(df)))


@register("c08_winsorize", O.with_ctes(O.FUNDAMENTALS, O.clean_ctes(), body=f"""
SELECT {sel(RAW, RAW_D)} FROM c8"""))
def q_c08(spark, sf_dir):
    return rounded(_stage(spark, sf_dir, "c8").select(*RAW))


@register("c09_earnings_yield", O.with_ctes(O.FUNDAMENTALS, O.clean_ctes(), body="""
SELECT ticker, ROUND(earnings_yield, 9) AS earnings_yield FROM eng"""))
def q_c09(spark, sf_dir):
    return rounded(C.add_engineered(materialize(_stage(spark, sf_dir, "c8")))
                   .select("ticker", "earnings_yield"))


@register("c10_quality_score", O.with_ctes(O.FUNDAMENTALS, O.clean_ctes(), body="""
SELECT ticker, ROUND(quality_score, 9) AS quality_score FROM eng"""))
def q_c10(spark, sf_dir):
    return rounded(C.add_engineered(materialize(_stage(spark, sf_dir, "c8")))
                   .select("ticker", "quality_score"))


@register("c11_leverage_adj_roe", O.with_ctes(O.FUNDAMENTALS, O.clean_ctes(), body="""
SELECT ticker, ROUND(leverage_adj_roe, 9) AS leverage_adj_roe FROM eng"""))
def q_c11(spark, sf_dir):
    return rounded(C.add_engineered(materialize(_stage(spark, sf_dir, "c8")))
                   .select("ticker", "leverage_adj_roe"))


@register("c12_drop_incomplete", O.with_ctes(O.FUNDAMENTALS, O.clean_ctes(), body="""
SELECT ticker FROM clean"""))
def q_c12(spark, sf_dir):
    return C.drop_incomplete(C.add_engineered(materialize(_stage(spark, sf_dir, "c8")))).select("ticker")


@register("c13_clean_and_engineer", O.with_ctes(O.FUNDAMENTALS, O.clean_ctes(), body=f"""
SELECT {sel(CLEAN_COLS, CLEAN_D)} FROM clean"""))
def q_c13(spark, sf_dir):
    return rounded(cleaned(spark, sf_dir).select(*CLEAN_COLS))


@register("c13_clean_report", O.with_ctes(O.FUNDAMENTALS, O.clean_ctes(), body="""
SELECT (SELECT COUNT(*) FROM fundamentals) AS rows_in,
       (SELECT COUNT(*) FROM c1) AS rows_after_sparse_drop,
       (SELECT COUNT(*) FROM clean) AS rows_out"""))
def q_c13_report(spark, sf_dir):
    raw = fundamentals(spark, sf_dir)
    return C.clean_report(raw, cleaned(spark, sf_dir))


# --------------------------------------------------------------------- labels
_LAB = O.clean_prefix(O.LABELLED)


@register("l01_quantile_label", O.with_ctes(*_LAB, body="""
SELECT ticker, ROUND(forward_return, 9) AS forward_return, target FROM labelled"""))
def q_l01(spark, sf_dir):
    return rounded(labelled(spark, sf_dir).select("ticker", "forward_return", "target"))


@register("l03_equal_cutoff_label", O.with_ctes(*O.clean_prefix(), body="""
, r AS (SELECT ticker, ROUND(forward_return, 0) AS fr FROM clean),
q AS (SELECT quantile_cont(fr, 0.7) AS qb, quantile_cont(fr, 0.3) AS qs,
             COUNT(*) AS n, MIN(fr) AS lo, MAX(fr) AS hi FROM r)
SELECT ticker, fr AS forward_return,
  CASE WHEN q.n < 3 OR COALESCE(q.lo = q.hi, TRUE) THEN 'Hold'
       WHEN q.qb = q.qs THEN CASE WHEN fr > qb THEN 'Buy' WHEN fr < qs THEN 'Sell' ELSE 'Hold' END
       ELSE CASE WHEN fr >= qb THEN 'Buy' WHEN fr <= qs THEN 'Sell' ELSE 'Hold' END END AS target
FROM r, q"""))
def q_l03(spark, sf_dir):
    df = cleaned(spark, sf_dir).select("ticker", round6(F.col("forward_return"), 0).alias("forward_return"))
    return L.quantile_label(df).select("ticker", "forward_return", "target")


@register("l04_tercile_label", O.with_ctes(*O.clean_prefix(), body="""
, q AS (SELECT quantile_cont(forward_return, 0.66) AS qh, quantile_cont(forward_return, 0.33) AS ql
       FROM clean WHERE forward_return IS NOT NULL)
SELECT ticker, CASE WHEN forward_return > qh THEN 'Buy' WHEN forward_return < ql THEN 'Sell'
                    ELSE 'Hold' END AS target
FROM clean, q WHERE forward_return IS NOT NULL"""))
def q_l04(spark, sf_dir):
    return L.quantile_label(cleaned(spark, sf_dir), L.TERCILE_POLICY).select("ticker", "target")


@register("l05_cutoff_report", O.with_ctes(*_LAB, body="""
SELECT ROUND(quantile_cont(forward_return, 0.33), 9) AS q33,
       ROUND(quantile_cont(forward_return, 0.66), 9) AS q66 FROM labelled"""))
def q_l05(spark, sf_dir):
    return rounded(L.label_cutoffs(labelled(spark, sf_dir)))


@register("l06_fixed_bin_label", O.with_ctes(*O.clean_prefix(), body="""
SELECT ticker, CASE WHEN forward_return IS NULL THEN NULL WHEN forward_return <= 0.06 THEN 'Sell'
                    WHEN forward_return <= 0.11 THEN 'Hold' ELSE 'Buy' END AS target FROM clean"""))
def q_l06(spark, sf_dir):
    return L.fixed_bin_label(cleaned(spark, sf_dir)).select("ticker", "target")


@register("l07_qcut_label", O.with_ctes(*O.clean_prefix(), body="""
, q AS (SELECT quantile_cont(forward_return, 0.7) AS qb, quantile_cont(forward_return, 0.3) AS qs FROM clean)
SELECT ticker, CASE WHEN forward_return IS NULL THEN NULL WHEN forward_return <= qs THEN 'Sell'
                    WHEN forward_return > qb THEN 'Buy' ELSE 'Hold' END AS target
FROM clean, q"""))
def q_l07(spark, sf_dir):
    return L.quantile_label(cleaned(spark, sf_dir), L.QCUT_POLICY).select("ticker", "target")


@register("l08_class_distribution", O.with_ctes(*_LAB, body="""
SELECT target, COUNT(*) AS count FROM labelled GROUP BY target"""))
def q_l08(spark, sf_dir):
    return L.class_distribution(labelled(spark, sf_dir))


# --------------------------------------------------------------------- rules
_SCR = O.clean_prefix(O.LABELLED, O.SCREENED)


@register("r01_garp_strict", O.with_ctes(*_SCR, body="""
SELECT ticker, target, signal_rules FROM screened"""))
def q_r01(spark, sf_dir):
    return screened(spark, sf_dir).select("ticker", "target", "signal_rules")


_INCL_SIGNAL = """CASE WHEN PE_ratio >= 40 OR ROE <= 0.05 OR DE_ratio >= 3.0 OR revenue_growth <= 0.0
          OR profit_margin <= 0.02 THEN 'Sell'
     WHEN PE_ratio >= 0 AND PE_ratio <= 20 AND ROE >= 0.12 AND DE_ratio <= 1.5
          AND revenue_growth >= 0.05 AND profit_margin >= 0.08 THEN 'Buy' ELSE 'Hold' END"""
_DIST = """20.0 - PE_ratio AS dist_PE_to_max_buy, ROE - 0.12 AS dist_ROE_to_min_buy,
  1.5 - DE_ratio AS dist_DE_to_max_buy, revenue_growth - 0.05 AS dist_rev_growth_to_min_buy,
  profit_margin - 0.08 AS dist_profit_margin_to_min_buy"""
_DIST_COLS = ["dist_PE_to_max_buy", "dist_ROE_to_min_buy", "dist_DE_to_max_buy",
              "dist_rev_growth_to_min_buy", "dist_profit_margin_to_min_buy"]


@register("r02_garp_inclusive", O.with_ctes(*_LAB, body=f"""
SELECT ticker, {_INCL_SIGNAL} AS signal_rules FROM labelled"""))
def q_r02(spark, sf_dir):
    return R.screen(labelled(spark, sf_dir), R.INCLUSIVE).select("ticker", "signal_rules")


@register("r03_threshold_distances", O.with_ctes(*_LAB, body=f"""
, d AS (SELECT ticker, {_DIST} FROM labelled)
SELECT ticker, {sel(_DIST_COLS, _DIST_COLS)} FROM d"""))
def q_r03(spark, sf_dir):
    return rounded(R.add_distances(labelled(spark, sf_dir)).select("ticker", *_DIST_COLS))


@register("r04_min_distance", O.with_ctes(*_LAB, body=f"""
, d AS (SELECT ticker, {_DIST} FROM labelled)
SELECT ticker, ROUND(LEAST({", ".join(_DIST_COLS)}), 9) AS min_distance_to_buy_threshold
FROM d"""))
def q_r04(spark, sf_dir):
    return rounded(R.add_distances(labelled(spark, sf_dir)).select("ticker", R.MIN_DISTANCE))


@register("r05_missing_column_screen", O.with_ctes(*_LAB, body="""
SELECT ticker,
  CASE WHEN PE_ratio > 30 OR PE_ratio < 0 OR ROE < 0.05 OR DE_ratio > 3.0
            OR revenue_growth < -0.10 THEN 'Sell' ELSE 'Hold' END AS signal_rules,
  ROUND(LEAST(20.0 - PE_ratio, ROE - 0.12, 1.5 - DE_ratio, revenue_growth - 0.05), 9)
    AS min_distance_to_buy_threshold
FROM labelled"""))
def q_r05(spark, sf_dir):
    df = labelled(spark, sf_dir).drop("profit_margin")
    out = R.add_distances(R.screen(df, R.STRICT), R.INCLUSIVE)
    return rounded(out.select("ticker", "signal_rules", R.MIN_DISTANCE))


@register("r06_garp_docs", O.with_ctes(*_LAB, body="""
SELECT ticker, CASE
  WHEN PE_ratio > 0 AND PE_ratio <= 20 AND ROE > 0.12 AND DE_ratio < 1.5 AND revenue_growth > 0.05
       AND profit_margin > 0.08 THEN 'Buy'
  WHEN PE_ratio > 50 OR PE_ratio <= 0 OR ROE < 0.05 OR DE_ratio > 3.0 OR revenue_growth < -0.05
       OR profit_margin < 0.01 THEN 'Sell' ELSE 'Hold' END AS signal_rules FROM labelled"""))
def q_r06(spark, sf_dir):
    return R.screen(labelled(spark, sf_dir), R.DOCS).select("ticker", "signal_rules")


@register("r07_garp_alternate", O.with_ctes(*_LAB, body="""
SELECT ticker, CASE
  WHEN PE_ratio > 50 OR ROE < 0.02 OR DE_ratio > 5 THEN 'Sell'
  WHEN PE_ratio > 0 AND PE_ratio <= 20 AND ROE > 0.12 AND DE_ratio < 1.5 AND revenue_growth > 0.05
       AND profit_margin > 0.08 THEN 'Buy' ELSE 'Hold' END AS signal_rules FROM labelled"""))
def q_r07(spark, sf_dir):
    return R.screen(labelled(spark, sf_dir), R.ALTERNATE).select("ticker", "signal_rules")


@register("r09_signal_distribution", O.with_ctes(*_SCR, body="""
SELECT signal_rules, COUNT(*) AS count FROM screened GROUP BY signal_rules"""))
def q_r09(spark, sf_dir):
    return L.class_distribution(screened(spark, sf_dir), "signal_rules")


@register("r10_signal_sample", O.with_ctes(*O.clean_prefix(O.LABELLED), body=f"""
, s AS (SELECT labelled.*, {_INCL_SIGNAL} AS signal_rules,
        LEAST({_DIST.replace(' AS dist_PE_to_max_buy', '').replace(' AS dist_ROE_to_min_buy', '')
               .replace(' AS dist_DE_to_max_buy', '').replace(' AS dist_rev_growth_to_min_buy', '')
               .replace(' AS dist_profit_margin_to_min_buy', '')}) AS min_distance_to_buy_threshold
        FROM labelled)
SELECT ticker, ROUND(PE_ratio, 9) AS PE_ratio, ROUND(ROE, 9) AS ROE, ROUND(DE_ratio, 9) AS DE_ratio,
  ROUND(revenue_growth, 9) AS revenue_growth, ROUND(profit_margin, 9) AS profit_margin, signal_rules,
  ROUND(min_distance_to_buy_threshold, 9) AS min_distance_to_buy_threshold, target
FROM s ORDER BY ticker LIMIT 5"""))
def q_r10(spark, sf_dir):
    return rounded(R.signal_sample(R.screen_with_distances(labelled(spark, sf_dir))))
