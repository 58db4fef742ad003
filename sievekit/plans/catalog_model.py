"""Registered EDA, ML-preparation and model queries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions.nulls import bounded_distinct
from ..operators import eda as E
from ..operators import features as M
from ..operators import model as T
from ..session import materialize
from ..operators import evaluate as V
from ..sources.fixtures import prices
from ..sources.tables import read_table
from . import oracle_sql as O
from .registry import register, round6, rounded
from .workflow import labelled, main_analysis, screened

EDA_COLS = [*O.FEATURES, "earnings_yield", "quality_score", "leverage_adj_roe"]
_LAB = O.clean_prefix(O.LABELLED)
_SCR = O.clean_prefix(O.LABELLED, O.SCREENED)


def _unpivot_sql(src: str, hue: str = "target") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, {hue} AS hue, CAST({c} AS DOUBLE) AS x FROM {src} WHERE {c} IS NOT NULL"
        for c in EDA_COLS)


# --------------------------------------------------------------------- E1
def _corr_sql() -> str:
    parts = []
    for i, a in enumerate(EDA_COLS):
        for b in EDA_COLS[i:]:
            both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
            expr = (f"COVAR_POP(CASE WHEN {both} THEN {a} END, CASE WHEN {both} THEN {b} END) / "
                    f"NULLIF(STDDEV_POP(CASE WHEN {both} THEN {a} END) * "
                    f"STDDEV_POP(CASE WHEN {both} THEN {b} END), 0)")
            parts.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, ROUND({expr}, 9) AS corr FROM labelled")
            if a != b:
                parts.append(f"SELECT '{b}', '{a}', ROUND({expr}, 9) FROM labelled")
    return "\nUNION ALL\n".join(parts)


@register("e01_correlation_matrix", O.with_ctes(*_LAB, body=_corr_sql()))
def q_e01(spark, sf_dir):
    return rounded(E.correlation_matrix(labelled(spark, sf_dir), EDA_COLS))


# --------------------------------------------------------------------- E2
@register("e02_histogram", O.with_ctes(*_LAB, body=f"""
, lx AS ({_unpivot_sql("labelled")}),
st AS (SELECT feature, MIN(x) AS lo, MAX(x) AS hi, COUNT(*) AS n,
              quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr FROM lx GROUP BY feature),
ed AS (SELECT feature, lo, hi, GREATEST(CASE WHEN hi - lo > 0 THEN CEIL((hi - lo) / LEAST(
          GREATEST(2.0 * iqr * POW(CAST(n AS DOUBLE), -1.0 / 3.0), (hi - lo) / SQRT(CAST(n AS DOUBLE)) / 2.0),
          (hi - lo) / (LOG2(CAST(n AS DOUBLE)) + 1.0))) ELSE 1 END, 1) AS k FROM st),
b AS (SELECT lx.feature, lx.hue, ed.lo, ed.hi, ed.k,
        CAST(CASE WHEN ed.hi - ed.lo > 0 THEN LEAST(FLOOR((lx.x - ed.lo) / (ed.hi - ed.lo) * ed.k), ed.k - 1)
             ELSE 0 END AS BIGINT) AS bin
      FROM lx JOIN ed ON lx.feature = ed.feature)
SELECT feature, hue AS target, bin, COUNT(*) AS count,
       ROUND(MAX(lo + bin * ((hi - lo) / k)), 9) AS bin_lo, ROUND(MAX(lo + (bin + 1) * ((hi - lo) / k)), 9) AS bin_hi
FROM b GROUP BY feature, hue, bin"""))
def q_e02(spark, sf_dir):
    return rounded(E.histogram(labelled(spark, sf_dir), EDA_COLS, "target", "auto"))


# --------------------------------------------------------------------- E3
_NORM = repr(1.0 / math.sqrt(2 * math.pi))


@register("e03_kde_curves", O.with_ctes(*_LAB, body=f"""
, lx AS ({_unpivot_sql("labelled")}),
st AS (SELECT feature, hue, COUNT(*) AS n, STDDEV_SAMP(x) AS sd, MIN(x) AS lo, MAX(x) AS hi
       FROM lx GROUP BY feature, hue),
st1 AS (SELECT *, sd * POW(CAST(n AS DOUBLE), -0.2) AS h FROM st WHERE n >= 2 AND sd > 0),
st2 AS (SELECT *, CEIL((hi - lo) / (h / 20)) AS nb FROM st1),
bn AS (SELECT lx.feature, lx.hue, lx.x, st2.n, st2.h, st2.lo, st2.hi, st2.nb,
         CAST(CASE WHEN st2.hi - st2.lo > 0 THEN LEAST(FLOOR((lx.x - st2.lo) / (st2.hi - st2.lo) * nb), nb - 1)
              ELSE 0 END AS BIGINT) AS b
       FROM lx JOIN st2 ON lx.feature = st2.feature AND lx.hue = st2.hue),
bw AS (SELECT feature, hue, n, h, lo, hi, b, COUNT(*) AS w,
              AVG(x) AS c FROM bn GROUP BY feature, hue, n, h, lo, hi, nb, b),
pts AS (SELECT bw.*, g.g, lo - 3.0 * h AS g_lo, ((hi + 3.0 * h) - (lo - 3.0 * h)) / 199 AS step
        FROM bw CROSS JOIN (SELECT CAST(range AS INTEGER) AS g FROM range(0, 200)) g),
ct AS (SELECT feature, hue, g, n, h, g_lo + g * step AS x,
              w * EXP(-0.5 * ((g_lo + g * step) - c) / h * ((g_lo + g * step) - c) / h) AS k FROM pts)
SELECT feature, hue AS target, g AS grid_idx, ROUND(MAX(x), 9) AS x,
       ROUND(SUM(k) * {_NORM} / (MAX(n) * MAX(h)), 9) AS density
FROM ct GROUP BY feature, hue, g"""))
def q_e03(spark, sf_dir):
    return rounded(E.kde_curves(labelled(spark, sf_dir), EDA_COLS, "target"))


@register("e03_kde_exact", O.with_ctes(*_LAB, body=f"""
, lx AS ({_unpivot_sql("labelled")}),
st AS (SELECT feature, hue, COUNT(*) AS n, STDDEV_SAMP(x) AS sd, MIN(x) AS lo, MAX(x) AS hi
       FROM lx GROUP BY feature, hue HAVING COUNT(*) >= 2 AND STDDEV_SAMP(x) > 0),
gr AS (SELECT feature, hue, n, h, g, (lo - 3.0 * h) + g * (((hi + 3.0 * h) - (lo - 3.0 * h)) / 199) AS gx
       FROM (SELECT *, sd * POW(CAST(n AS DOUBLE), -0.2) AS h FROM st)
       CROSS JOIN (SELECT CAST(range AS INTEGER) AS g FROM range(0, 200)) points)
SELECT gr.feature, gr.hue AS target, g AS grid_idx, ROUND(MAX(gx), 9) AS x,
       ROUND(SUM(EXP(-0.5 * (gx - lx.x) / h * (gx - lx.x) / h)) * {_NORM} / (MAX(n) * MAX(h)), 8) AS density
FROM gr JOIN lx ON lx.feature = gr.feature AND lx.hue = gr.hue GROUP BY gr.feature, gr.hue, g"""))
def q_e03_exact(spark, sf_dir):
    """The density itself, summed over every row; eight decimals, as sums of many kernels carry noise."""
    df = E.kde_curves(labelled(spark, sf_dir), EDA_COLS, "target", bins_per_h=None)
    return df.select("feature", "target", "grid_idx", round6(F.col("x")).alias("x"), round6(F.col("density"), 8).alias("density"))


# --------------------------------------------------------------------- M1, M3
_SECTORS = ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "Unknown")


@register("m01_one_hot_sector", O.with_ctes(*_SCR, body=", ".join(
    ["SELECT ticker"] + [f"CASE WHEN sector = '{s}' THEN 1 ELSE 0 END AS sector_{s}" for s in _SECTORS])
    + " FROM screened"))
def q_m01(spark, sf_dir):
    s = screened(spark, sf_dir)
    cats = M.fit_categories(s)
    return M.one_hot(s, cats).select("ticker", *[c for c in M.one_hot(s, cats).columns
                                                 if c.startswith("sector_")])


@register("m03_label_encode", O.with_ctes(*_SCR, body="""
SELECT ticker, target, CAST(dense_rank() OVER (ORDER BY target) - 1 AS DOUBLE) AS label FROM screened"""))
def q_m03(spark, sf_dir):
    s = screened(spark, sf_dir)
    classes = bounded_distinct(s, "target")
    return M.label_index(s, classes).select("ticker", "target", "label")


# --------------------------------------------------------------------- M4, M5, M7
_SPLIT = """
, sp AS (SELECT screened.*,
    row_number() OVER (PARTITION BY target ORDER BY md5(ticker || '42'), ticker)
      <= ROUND(CAST(COUNT(*) OVER (PARTITION BY target) AS DOUBLE) * CAST(0.3 AS DOUBLE)) AS is_test
  FROM screened)"""


@register("m04_stratified_split", O.with_ctes(*_SCR, body=_SPLIT + """
SELECT ticker, target, is_test FROM sp"""))
def q_m04(spark, sf_dir):
    return M.stratified_split(screened(spark, sf_dir)).select("ticker", "target", "is_test")


@register("m05_unstratified_split", O.with_ctes(*_SCR, body="""
SELECT ticker, row_number() OVER (ORDER BY md5(ticker || '42'), ticker)
  <= ROUND(CAST(COUNT(*) OVER () AS DOUBLE) * CAST(0.3 AS DOUBLE)) AS is_test FROM screened"""))
def q_m05(spark, sf_dir):
    return M.stratified_split(screened(spark, sf_dir), label=None).select("ticker", "is_test")


def _z_sql() -> str:
    cols = ", ".join(
        f"ROUND((sp.{c} - st.{c}_m) / COALESCE(NULLIF(st.{c}_s, 0), 1.0), 6) AS {c}" for c in EDA_COLS)
    stats = ", ".join(f"AVG({c}) AS {c}_m, STDDEV_POP({c}) AS {c}_s" for c in EDA_COLS)
    return _SPLIT + f""",
st AS (SELECT {stats} FROM sp WHERE NOT is_test)
SELECT sp.ticker, sp.is_test, {cols} FROM sp, st"""


@register("m06_zscore_train_fit", O.with_ctes(*_SCR, body=_z_sql()))
def q_m06(spark, sf_dir):
    sp = materialize(M.stratified_split(screened(spark, sf_dir)))
    scaler = M.fit_scaler(sp.where(~F.col("is_test")), EDA_COLS)
    # means and deviations carry summation noise: compare six decimals
    return rounded(scaler.transform(sp).select("ticker", "is_test", *EDA_COLS), 6)


@register("m07_test_metadata", O.with_ctes(*_SCR, body=_SPLIT + """
SELECT ticker, ROUND(forward_return, 9) AS forward_return, target, signal_rules FROM sp WHERE is_test"""))
def q_m07(spark, sf_dir):
    return rounded(M.test_metadata(M.stratified_split(screened(spark, sf_dir))))


@register("m08_temporal_split", O.with_ctes(O.PRICES, body="""
SELECT ticker, date, row_number() OVER (ORDER BY date, ticker) - 1
  >= ROUND(CAST(COUNT(*) OVER () AS DOUBLE) * CAST(0.7 AS DOUBLE)) AS is_test FROM prices"""))
def q_m08(spark, sf_dir):
    return M.temporal_split(prices(spark, sf_dir), ["date", "ticker"]).select("ticker", "date", "is_test")


# --------------------------------------------------------------------- T1-T8 (rows-only)
def _model(spark, sf_dir, tune: bool):
    prep = T.prepare(screened(spark, sf_dir))
    return prep, T.train_screen_model(prep, tune=tune)


@register("t01_fit_coefficients", None)
def q_t01(spark, sf_dir):
    _, m = _model(spark, sf_dir, tune=False)
    return m.coefficients(spark)


@register("t02_grid_search", None)
def q_t02(spark, sf_dir):
    _, m = _model(spark, sf_dir, tune=True)
    rows = [(float(c), float(s), c == m.best_c) for c, s in m.grid.scores.items()]
    return spark.createDataFrame(rows, "C double, mean_f1_weighted double, best boolean")


@register("t05_test_predictions", None)
def q_t05(spark, sf_dir):
    prep, m = _model(spark, sf_dir, tune=False)
    return m.predict(prep.test, keep=["ticker", "forward_return", "target", "signal_rules"])


@register("t07_buy_coefficients", None)
def q_t07(spark, sf_dir):
    _, m = _model(spark, sf_dir, tune=False)
    return m.class_coefficients(spark, "Buy")


@register("t08_score_rows", None)
def q_t08(spark, sf_dir):
    _, m = _model(spark, sf_dir, tune=False)
    return m.score(labelled(spark, sf_dir), keep=["ticker"])


@register("a01_main_analysis", None)
def q_a01(spark, sf_dir):
    """Entry A: tuned model vs rule screen on the held-out rows."""
    return main_analysis(spark, sf_dir, tune=True).metrics


@register("t09_embeddings_fit", None)
def q_t09(spark, sf_dir):
    """T1-T5 + V3 on the embeddings table: 64 float features, 10 classes.
    The array is split into columns in one projection; the same split,
    train-fitted scaler and multinomial fit as the screen model."""
    emb = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    dims = emb.select(F.max(F.size("embedding"))).first()[0] or 0
    x = emb.select(F.col("vec_id").cast("string").alias("ticker"),
                   F.format_string("c%02d", F.col("label")).alias("target"),
                   *[F.col("embedding")[i].cast("double").alias(f"e{i:02d}") for i in range(dims)])
    prep = T.prepare(x)
    m = T.train_screen_model(prep, tune=False)
    pred = m.predict(prep.test, keep=["ticker", "target"])
    return V.classification_report(pred, "target", "ml_pred_class", prep.classes)
