"""Registered queries that reach branches the plain fixtures don't.

Inputs are the same tables with some values blanked or rewritten by a rule on
the customer number, so every branch changes rows; each has its DuckDB oracle.
"""

from __future__ import annotations

import math

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.nulls import nan_to_null
from ..functions.sqlexpr import lit_num, q
from ..operators import clean as C
from ..operators import evaluate as V
from ..operators import features as M
from ..operators import labels as L
from ..operators import model as T
from ..operators import rules as R
from ..operators.persist import load_screen, save_screen
from ..session import materialize
from ..sources import conform as S
from ..sources import files as IO
from ..sources import prices as P
from ..sources.fixtures import fundamentals, prices, scored
from . import oracle_sql as O
from .catalog_eval import _REPORT
from .catalog_model import _SPLIT, EDA_COLS
from .registry import register, rounded, sel
from .workflow import cleaned, labelled, main_analysis, screened

RAW_D = [*O.FEATURES, "forward_return"]
_LAB = O.clean_prefix(O.LABELLED)
_SCR = O.clean_prefix(O.LABELLED, O.SCREENED)
#: the customer number inside a ticker
_KEY_SQL = "CAST(right(ticker, 9) AS INTEGER)"


def _key():
    return F.substring("ticker", -9, 9).cast("int")


def _changed(select: str) -> str:
    """The fixture under another name, and ``fundamentals`` derived from it."""
    return O.FUNDAMENTALS.replace("fundamentals AS (", "base AS (", 1) + f",\nfundamentals AS ({select})"


# --------------------------------------------------------------------- cleaning
_C06 = _changed("SELECT * REPLACE (CASE WHEN sector = 'BUILDING' THEN NULL ELSE beta END AS beta) FROM base")


@register("c06_group_without_values", O.with_ctes(_C06, O.clean_ctes(), body="""
SELECT ticker, sector, ROUND(beta, 9) AS beta FROM c6"""))
def q_c06(spark, sf_dir):
    """One sector has no value of a column at all: only the overall median fills it."""
    f = fundamentals(spark, sf_dir)
    f = f.withColumn("beta", F.when(F.coalesce(F.col("sector") == "BUILDING", F.lit(False)), None).otherwise(F.col("beta")))
    df = C.drop_sparse_rows(nan_to_null(f))
    cols = C.feature_columns(df)
    df = C.impute_group_median(materialize(C.fill_sector(df)), cols, "sector")
    return rounded(C.impute_global_median(df, cols).select("ticker", "sector", "beta"))


_TEXT_SQL = f"""CASE {_KEY_SQL} % 5 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN 12.5
  ELSE CAST({_KEY_SQL} AS DOUBLE) END"""


@register("c02_mixed_text", O.with_ctes(O.FUNDAMENTALS, body=f"""
SELECT ticker, {_TEXT_SQL} AS PE_ratio FROM fundamentals"""))
def q_c02(spark, sf_dir):
    k = _key()
    text = (F.when(k % 5 == 0, "1d").when(k % 5 == 1, "n/a").when(k % 5 == 2, "1,000").when(k % 5 == 3, " 12.5 ")
            .otherwise(k.cast("string")))
    return C.coerce_numeric(fundamentals(spark, sf_dir).select("ticker", text.alias("PE_ratio")))


_TEXT_COLS = ("PE_ratio", "ROE", "DE_ratio", "dividend_yield")


def _c13_sql() -> str:
    present = " + ".join(
        f"(CASE WHEN {c} IS NOT NULL{f' OR {_KEY_SQL} % 10 = 0' if c in _TEXT_COLS else ''} THEN 1 ELSE 0 END)"
        for c in O.RAW_COLUMNS)
    cols = ", ".join(f"CASE WHEN {_KEY_SQL} % 10 = 0 THEN NULL ELSE {c} END AS {c}" if c in _TEXT_COLS else c
                     for c in O.RAW_COLUMNS)
    chain = O.clean_ctes()
    first = chain.index("c4 AS (")
    names = ["ticker", *O.FEATURES, "earnings_yield"]
    return O.with_ctes(O.FUNDAMENTALS, f"\nc1 AS (SELECT {cols} FROM fundamentals WHERE {present} >= 9)", chain[first:],
                       body=f"\nSELECT {sel(names, names[1:])} FROM clean")


@register("c13_text_feed", _c13_sql())
def q_c13(spark, sf_dir):
    """Text that can't be read counts as present when sparse rows are dropped, and as missing after."""
    f = fundamentals(spark, sf_dir)
    for c in _TEXT_COLS:
        f = f.withColumn(c, F.when(_key() % 10 == 0, "n/a").otherwise(F.col(c).cast("string")))
    return rounded(C.clean_and_engineer(f).select("ticker", *O.FEATURES, "earnings_yield"))


# --------------------------------------------------------------------- labels
@register("l03_equal_cutoffs", O.with_ctes(*O.clean_prefix(), body="""
, r AS (SELECT ticker, CASE WHEN forward_return > 2.0 THEN 1.0 WHEN forward_return < -0.95 THEN -1.0 ELSE 0.0 END AS fr FROM clean),
q AS (SELECT quantile_cont(fr, 0.7) AS qb, quantile_cont(fr, 0.3) AS qs, COUNT(*) AS n, MIN(fr) AS lo, MAX(fr) AS hi FROM r)
SELECT ticker, fr AS forward_return,
  CASE WHEN q.n < 3 OR COALESCE(q.lo = q.hi, TRUE) THEN 'Hold'
       WHEN q.qb = q.qs THEN CASE WHEN fr > qb THEN 'Buy' WHEN fr < qs THEN 'Sell' ELSE 'Hold' END
       ELSE CASE WHEN fr >= qb THEN 'Buy' WHEN fr <= qs THEN 'Sell' ELSE 'Hold' END END AS target
FROM r, q"""))
def q_l03(spark, sf_dir):
    r = F.col("forward_return")
    df = cleaned(spark, sf_dir).select("ticker", F.when(r > 2.0, 1.0).when(r < -0.95, -1.0).otherwise(0.0).alias("forward_return"))
    return L.quantile_label(df)


@register("l02_degenerate_label", O.with_ctes(*O.clean_prefix(), body="""
SELECT ticker, 'Hold' AS target FROM clean"""))
def q_l02(spark, sf_dir):
    """All outcomes equal: every row is held."""
    df = cleaned(spark, sf_dir).select("ticker", (F.col("forward_return") * 0 + 1.0).alias("forward_return"))
    return L.quantile_label(df).select("ticker", "target")


# --------------------------------------------------------------------- rules
_DERIVED = {"dist_PE_to_max_buy": "20.0 - PE_ratio", "dist_ROE_to_min_buy": "ROE - 0.12", "dist_DE_to_max_buy": "1.5 - DE_ratio",
            "dist_rev_growth_to_min_buy": "revenue_growth - 0.05", "dist_profit_margin_to_min_buy": "profit_margin - 0.08"}


@register("r03_derived_distances", O.with_ctes(*_LAB, body=f"""
, d AS (SELECT ticker, {", ".join(f"{e} AS {n}" for n, e in _DERIVED.items())} FROM labelled)
SELECT rulebook, ticker, {sel(list(_DERIVED), list(_DERIVED))}, ROUND(LEAST({", ".join(_DERIVED)}), 9) AS {R.MIN_DISTANCE}
FROM d, (VALUES ('strict'), ('docs'), ('alternate')) AS b(rulebook)"""))
def q_r03(spark, sf_dir):
    """Rulebooks that state no distances get them from their Buy rules."""
    df = materialize(labelled(spark, sf_dir).select("ticker", *O.FEATURES))
    out = None
    for book in (R.STRICT, R.DOCS, R.ALTERNATE):
        part = R.add_distances(df, book).select(F.lit(book.name).alias("rulebook"), "ticker", *_DERIVED, R.MIN_DISTANCE)
        out = part if out is None else out.unionByName(part)
    return rounded(out)


@register("r08_rulebook_as_table", O.with_ctes(*_LAB, body="""
SELECT ticker, CASE
  WHEN PE_ratio > 0 AND PE_ratio <= 20 AND ROE > 0.12 AND DE_ratio < 1.5 AND revenue_growth > 0.05
       AND profit_margin > 0.08 THEN 'Buy'
  WHEN PE_ratio > 50 OR PE_ratio <= 0 OR ROE < 0.05 OR DE_ratio > 3.0 OR revenue_growth < -0.05
       OR profit_margin < 0.01 THEN 'Sell' ELSE 'Hold' END AS signal_rules FROM labelled"""))
def q_r08(spark, sf_dir):
    """A rulebook written to a table and read back screens as before, precedence included."""
    back = R.rulebook_from_table(R.rulebook_table(spark, R.DOCS).collect())
    return R.screen(labelled(spark, sf_dir), back).select("ticker", "signal_rules")


# --------------------------------------------------------------------- sources
_NULL_CLOSES = O.PRICES.replace("prices AS (", "all_prices AS (", 1) + """,
prices AS (SELECT ticker, date, CASE WHEN day(date) % 5 = 0 THEN NULL ELSE close END AS close FROM all_prices)"""


@register("s10_null_closes", O.with_ctes(_NULL_CLOSES, body="""
, probes AS (SELECT ticker, date, close, CAST(date + INTERVAL 12 MONTH AS DATE) AS target FROM prices),
known AS (SELECT * FROM prices WHERE close IS NOT NULL),
mx AS (SELECT ticker, MAX(date) AS last_date FROM prices GROUP BY ticker)
SELECT pr.ticker, pr.date, ROUND(pr.close, 9) AS close,
       ROUND(CASE WHEN pr.target > mx.last_date THEN NULL ELSE (p.close - pr.close) / pr.close END, 9) AS forward_return
FROM probes pr ASOF LEFT JOIN known p ON pr.ticker = p.ticker AND pr.target >= p.date
JOIN mx ON pr.ticker = mx.ticker"""))
def q_s10(spark, sf_dir):
    p = prices(spark, sf_dir)
    return rounded(P.forward_return(p.withColumn("close", F.when(F.dayofmonth("date") % 5 != 0, F.col("close")))))


@register("s03_insufficient_tier", O.with_ctes(O.FUNDAMENTALS, body="""
SELECT 'all' AS source, ticker FROM fundamentals"""))
def q_s03(spark, sf_dir):
    """The first tier can be read but has too few rows: the next one serves."""
    f = fundamentals(spark, sf_dir)
    need = f.count()
    tiers = [IO.Tier("sectors", lambda: f.where("sector is not null"), min_rows=need), IO.Tier("all", lambda: f, min_rows=need)]
    name, df = IO.first_sufficient(tiers)
    return df.select(F.lit(name).alias("source"), "ticker")


@register("s05_market_cap_edges", O.with_ctes(O.FUNDAMENTALS, body=f"""
SELECT ticker, ROUND(CASE {_KEY_SQL} % 4 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL
  ELSE LOG10(CAST({_KEY_SQL} AS DOUBLE) * 1000) END, 9) AS market_cap_log FROM fundamentals"""))
def q_s05(spark, sf_dir):
    """Zero, negative and missing capitalisations have no logarithm."""
    k = _key()
    cap = F.when(k % 4 == 0, 0.0).when(k % 4 == 1, -5.0).when(k % 4 == 3, k.cast("double") * 1000)
    raw = fundamentals(spark, sf_dir).select("ticker", cap.alias("marketCap"))
    return rounded(S.log_market_cap(S.rename_raw(raw)).select("ticker", "market_cap_log"))


_FEED = [c for c in S.EXPECTED_COLUMNS if c not in ("ticker", "beta")]


@register("s07_after_conform", O.with_ctes(O.FUNDAMENTALS, body=f"""
SELECT {sel(_FEED, RAW_D)}, CAST(NULL AS DOUBLE) AS beta, TRUE AS dense FROM fundamentals"""))
def q_s07_after(spark, sf_dir):
    """A feed without a ticker column run through S6: every row gets a ticker, SYN0 .. SYN(n-1) once each."""
    out = materialize(S.conform_columns(fundamentals(spark, sf_dir).drop("ticker", "beta")))
    number = F.substring("ticker", 4, 20).cast("long")
    facts = out.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("ticker").alias("d"), F.min(number).alias("lo"),
                    F.max(number).alias("hi")).first()
    dense = facts["n"] == facts["d"] and (facts["n"] == 0 or (facts["lo"], facts["hi"]) == (0, facts["n"] - 1))
    return rounded(out.select(*_FEED, "beta", F.lit(dense).alias("dense")))


# --------------------------------------------------------------------- split
@register("m04_split_null_keys", O.with_ctes(*_SCR, body=f"""
, s AS (SELECT CASE WHEN {_KEY_SQL} % 11 = 0 THEN NULL ELSE target END AS target FROM screened)
SELECT target, CAST(ROUND(CAST(COUNT(*) AS DOUBLE) * CAST(0.3 AS DOUBLE)) AS BIGINT) AS n_test,
       COUNT(*) - CAST(ROUND(CAST(COUNT(*) AS DOUBLE) * CAST(0.3 AS DOUBLE)) AS BIGINT) AS n_train
FROM s GROUP BY target"""))
def q_m04(spark, sf_dir):
    """Rows without a key or a label are split like the others; none is lost."""
    k = _key()
    df = screened(spark, sf_dir).withColumn("target", F.when(k % 11 != 0, F.col("target")))
    df = materialize(df.withColumn("ticker", F.when(_key() % 7 != 0, F.col("ticker"))))
    return (M.stratified_split(df).groupBy("target")
            .agg(F.count(F.when(F.col("is_test"), 1)).alias("n_test"), F.count(F.when(~F.col("is_test"), 1)).alias("n_train")))


@register("m07_split_report", O.with_ctes(*_SCR, body=_SPLIT + """
SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS side, target, COUNT(*) AS n,
       ROUND(CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (PARTITION BY is_test), 9) AS share
FROM sp GROUP BY is_test, target"""))
def q_m07(spark, sf_dir):
    return rounded(M.split_report(M.stratified_split(screened(spark, sf_dir))))


@register("m02_feature_list_with_distances", O.with_ctes(*_LAB, body=f"""
, s AS (SELECT DISTINCT sector FROM labelled)
SELECT unnest([{", ".join(f"'{c}'" for c in [*EDA_COLS, *_DERIVED, R.MIN_DISTANCE])}]) AS feature
UNION ALL SELECT 'sector_' || sector FROM s WHERE sector <> (SELECT MIN(sector) FROM s)"""))
def q_m02(spark, sf_dir):
    """The interactive feature set: ratios, sector dummies and the six distance columns."""
    prep = T.prepare(R.screen_with_distances(labelled(spark, sf_dir)))
    return spark.createDataFrame([(f,) for f in prep.features], "feature string")


@register("a02_interactive_analysis", None)
def q_a02(spark, sf_dir):
    """The workflow with distance columns as features; rows only, as the fit is iterative."""
    return main_analysis(spark, sf_dir, tune=False, distances=True).metrics


# --------------------------------------------------------------------- evaluation
@register("v01_unknown_signal", O.with_ctes(O.FUNDAMENTALS, O.SCORED, body=f"""
, codes AS (SELECT label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS BIGINT) AS code
            FROM (SELECT DISTINCT target AS label FROM scored WHERE target IS NOT NULL)),
s AS (SELECT ticker, CASE {_KEY_SQL} % 6 WHEN 0 THEN 'Review' WHEN 1 THEN NULL ELSE signal_rules END AS signal_rules FROM scored)
SELECT s.ticker, s.signal_rules,
       CAST(COALESCE(c.code, (SELECT code FROM codes WHERE label = 'Hold'), 0) AS BIGINT) AS signal_rules_encoded
FROM s LEFT JOIN codes c ON s.signal_rules = c.label"""))
def q_v01(spark, sf_dir):
    k = _key()
    df = scored(spark, sf_dir).withColumn("signal_rules", F.when(k % 6 == 0, "Review").when(k % 6 != 1, F.col("signal_rules")))
    return V.encode_signal(materialize(df)).select("ticker", "signal_rules", "signal_rules_encoded")


# --------------------------------------------------------------------- model: facts that no solver changes
def _fitted(spark, sf_dir):
    clean, cleaner = C.fit_clean(fundamentals(spark, sf_dir))
    df = R.screen(L.quantile_label(materialize(clean)), R.STRICT)
    prep = T.prepare(df, cleaner=cleaner)
    return prep, T.train_screen_model(prep, tune=False)


_FEATURES_SQL = f"(SELECT {len(EDA_COLS)} + COUNT(DISTINCT sector) - 1 FROM labelled)"


@register("t01_optimality", O.with_ctes(*_LAB, body=f"""
SELECT DISTINCT target AS class, CAST({_FEATURES_SQL} AS BIGINT) AS n_features, TRUE AS at_optimum FROM labelled"""))
def q_t01(spark, sf_dir):
    """The gradient of the penalised objective is zero (1e-4) at the fit, class by class."""
    prep, m = _fitted(spark, sf_dir)
    x = vector_to_array("features")
    rows = m.model.transform(T.assemble(prep.train, prep.features))
    p, n = vector_to_array("probability"), len(prep.features)
    aggs = []
    for k in range(len(prep.classes)):
        gap = p[k] - F.when(F.col("label") == k, 1.0).otherwise(0.0)
        aggs += [F.avg(gap * x[j]).alias(f"g{k}_{j}") for j in range(n)] + [F.avg(gap).alias(f"g{k}_i")]
    g = rows.agg(*aggs).first()
    w, reg = m.model.coefficientMatrix.toArray(), m.model.getRegParam()
    out = []
    for k, name in enumerate(prep.classes):
        worst = max([abs(g[f"g{k}_{j}"] + reg * w[k][j]) for j in range(n)] + [abs(g[f"g{k}_i"])])
        out.append((name, n, bool(worst < 1e-4)))
    return spark.createDataFrame(out, "class string, n_features long, at_optimum boolean")


@register("t02_fold_sizes", O.with_ctes(*_SCR, body=_SPLIT + """
, f AS (SELECT target, (row_number() OVER (PARTITION BY target ORDER BY md5(ticker || '42'), ticker) - 1) % 5 AS fold
        FROM sp WHERE NOT is_test)
SELECT target, CAST(fold AS INTEGER) AS fold, COUNT(*) AS n FROM f GROUP BY target, fold"""))
def q_t02(spark, sf_dir):
    train = M.stratified_split(screened(spark, sf_dir)).where(~F.col("is_test"))
    return T.assign_folds(train, 5, "target").groupBy("target", "fold").agg(F.count(F.lit(1)).alias("n"))


@register("t02_choice", O.with_ctes(*_SCR, body="""
, n AS (SELECT COUNT(*) AS n FROM screened)
SELECT c.c AS "C", 5 AS folds, TRUE AS in_bounds, TRUE AS chosen_as_ruled
FROM (VALUES (0.01), (0.1), (1.0), (10.0), (100.0)) c(c), n WHERE n.n >= 5"""))
def q_t02_choice(spark, sf_dir):
    """The grid has its five values over five folds; the best is the smallest C of the highest mean score."""
    g = T.train_screen_model(T.prepare(screened(spark, sf_dir)), tune=True).grid
    top = max(g.scores.values())
    best = min(c for c, v in g.scores.items() if v == top)
    rows = [(float(c), g.folds, 0.0 <= v <= 1.0, (c == g.best_c) == (c == best)) for c, v in g.scores.items()]
    return spark.createDataFrame(rows, "C double, folds int, in_bounds boolean, chosen_as_ruled boolean")


@register("t06_coefficients", O.with_ctes(*_LAB, body=f"""
SELECT DISTINCT target AS class, CAST({_FEATURES_SQL} + 1 AS BIGINT) AS n_rows, TRUE AS same FROM labelled"""))
def q_t06(spark, sf_dir):
    """The coefficient table alone, applied to the test rows, gives the model's probabilities."""
    prep, m = _fitted(spark, sf_dir)
    table = m.coefficients(spark).collect()
    score = {}
    for cls in m.classes:
        own = {r["feature"]: r["coefficient"] for r in table if r["class"] == cls}
        terms = [f"{lit_num(w)} * {q(f)}" for f, w in own.items() if f != "Intercept"]
        score[cls] = f"exp({' + '.join([lit_num(own['Intercept']), *terms])})"
    total = " + ".join(score.values())
    exact = prep.test.select("ticker", *[F.expr(f"{e} / ({total})").alias(f"_p{i}") for i, e in enumerate(score.values())])
    got = m.predict(prep.test, keep=["ticker"]).join(exact, "ticker")
    worst = got.agg(*[F.max(F.abs(F.col(f"ml_{c.lower()}_proba") - F.col(f"_p{i}"))).alias(f"w{i}") for i, c in enumerate(m.classes)]).first()
    rows = [(c, sum(r["class"] == c for r in table), worst[f"w{i}"] is not None and worst[f"w{i}"] < 1e-9) for i, c in enumerate(m.classes)]
    return spark.createDataFrame(rows, "class string, n_rows long, same boolean")


@register("t03_weighted_f1", O.with_ctes(O.FUNDAMENTALS, O.SCORED, body=_REPORT + """
SELECT ROUND(f1_score, 9) AS f1_weighted FROM rep WHERE label = 'weighted avg' AND method = 'ml_pred_class'"""))
def q_t03(spark, sf_dir):
    """The scorer of the grid search on the scored rows, labels coded as the search codes them."""
    s = materialize(scored(spark, sf_dir))
    classes = V.class_list(s, "target")
    coded = M.label_index(M.label_index(s, classes), classes, "ml_pred_class", "prediction")
    value = T.weighted_f1(coded, [float(i) for i in range(len(classes))])
    return rounded(spark.createDataFrame([(value,)], "f1_weighted double"))


@register("t05_prediction_facts", O.with_ctes(*_SCR, body=_SPLIT + """
SELECT target, COUNT(*) AS n, TRUE AS sums_to_one, TRUE AS largest_wins FROM sp WHERE is_test GROUP BY target"""))
def q_t05(spark, sf_dir):
    prep, m = _fitted(spark, sf_dir)
    proba = [F.col(f"ml_{c.lower()}_proba") for c in m.classes]
    best = F.greatest(*proba)
    wins = F.lit(False)
    for c, p in zip(m.classes, proba):
        wins = wins | ((F.col("ml_pred_class") == c) & (p == best))
    total = sum(proba[1:], proba[0])
    return (m.predict(prep.test, keep=["target"]).groupBy("target")
            .agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.coalesce(F.abs(total - 1) < 1e-9, F.lit(False))).alias("sums_to_one"),
                 F.bool_and(F.coalesce(wins, F.lit(False))).alias("largest_wins")))


@register("t07_coefficient_order", O.with_ctes(*_LAB, body=f"""
, s AS (SELECT DISTINCT sector FROM labelled),
names AS (SELECT unnest([{", ".join(f"'{c}'" for c in EDA_COLS)}]) AS feature
          UNION ALL SELECT 'sector_' || sector FROM s WHERE sector <> (SELECT MIN(sector) FROM s))
SELECT feature, TRUE AS in_order FROM names"""))
def q_t07(spark, sf_dir):
    _, m = _fitted(spark, sf_dir)
    rows = m.class_coefficients(spark, "Buy").collect()
    before = [math.inf] + [r["coefficient"] for r in rows]
    return spark.createDataFrame([(r["feature"], r["coefficient"] <= b) for r, b in zip(rows, before)], "feature string, in_order boolean")


@register("t08_raw_rows_score_alike", O.with_ctes(*_SCR, body=_SPLIT + """
SELECT target, COUNT(*) AS n, TRUE AS same FROM sp WHERE is_test GROUP BY target"""))
def q_t08(spark, sf_dir):
    """Test rows scored from their raw values by the fitted state get the predictions of T5."""
    prep, m = _fitted(spark, sf_dir)
    want = m.predict(prep.test, keep=["ticker", "target"])
    got = m.score(fundamentals(spark, sf_dir).drop("forward_return"), keep=["ticker"])
    got = got.select(F.col("ticker").alias("_t"), *[F.col(c).alias("_" + c) for c in got.columns if c != "ticker"])
    return _same_predictions(want, got, m.classes)


def _same_predictions(want, got, classes):
    j = want.join(got, F.col("ticker") == F.col("_t"), "left")
    same = F.col("ml_pred_class") == F.col("_ml_pred_class")
    for c in classes:
        same = same & (F.abs(F.col(f"ml_{c.lower()}_proba") - F.col(f"_ml_{c.lower()}_proba")) < 1e-9)
    return j.groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.coalesce(same, F.lit(False))).alias("same"))


@register("t08_saved_model", O.with_ctes(*_SCR, body=_SPLIT + """
SELECT target, COUNT(*) AS n, TRUE AS same FROM sp WHERE is_test GROUP BY target"""))
def q_t08_saved(spark, sf_dir):
    """The fitted screen saved, loaded by another session and given raw test rows predicts as T5 does."""
    prep, m = _fitted(spark, sf_dir)
    path = IO.scratch_path(spark, "screen")
    save_screen(m, path)
    other = spark.newSession()
    got = load_screen(other, path).score(fundamentals(other, sf_dir).drop("forward_return"), keep=["ticker"])
    scores = IO.scratch_path(spark, "scores")
    got.select(F.col("ticker").alias("_t"), *[F.col(c).alias("_" + c) for c in got.columns if c != "ticker"]).write.parquet(scores)
    return _same_predictions(m.predict(prep.test, keep=["ticker", "target"]), spark.read.parquet(scores), m.classes)


# --------------------------------------------------------------------- evaluation of the fitted screen on held-out rows
# The rules' side of every table is exact; the model's side comes from an iterative fit, so its own
# queries are rows-only and a07 states what holds for any fit.
_HELD_OUT = _SPLIT + """,
scored AS (SELECT ticker, target, signal_rules, signal_rules AS ml_pred_class, forward_return FROM sp WHERE is_test)"""


def _held_out(spark, sf_dir):
    return main_analysis(spark, sf_dir, tune=False).evaluation()


def _rules(df):
    return rounded(df.where(F.col("method") == "signal_rules").drop("method"))


@register("a03_held_out_confusion", O.with_ctes(*_SCR, body=_HELD_OUT + """,
labels AS (SELECT DISTINCT target AS l FROM labelled WHERE target IS NOT NULL)
SELECT t.l AS true_label, p.l AS pred_label, COUNT(s.ticker) AS n
FROM labels t CROSS JOIN labels p LEFT JOIN scored s ON s.target = t.l AND s.signal_rules = p.l GROUP BY t.l, p.l"""))
def q_a03(spark, sf_dir):
    """V2 of the rules on the rows the model was not fitted on."""
    return _rules(_held_out(spark, sf_dir).confusion())


@register("a04_held_out_report", O.with_ctes(*_SCR, body=_HELD_OUT + _REPORT + """
SELECT label, ROUND(precision, 9) AS precision, ROUND(recall, 9) AS recall, ROUND(f1_score, 9) AS f1_score,
       ROUND(support, 9) AS support FROM rep WHERE method = 'signal_rules'"""))
def q_a04(spark, sf_dir):
    """V3 and V5 of the rules on the held-out rows."""
    return _rules(_held_out(spark, sf_dir).report())


@register("a05_held_out_sizes", O.with_ctes(*_SCR, body=_HELD_OUT + """
SELECT COUNT(CASE WHEN signal_rules = 'Buy' THEN 1 END) AS n_buy, COUNT(CASE WHEN signal_rules = 'Sell' THEN 1 END) AS n_sell,
       LEAST(COUNT(CASE WHEN signal_rules = 'Buy' THEN 1 END), COUNT(CASE WHEN signal_rules = 'Sell' THEN 1 END)) < 15 AS fragile,
       COUNT(CASE WHEN target = 'Buy' AND signal_rules = 'Sell' THEN 1 END) AS buy_as_sell,
       COUNT(CASE WHEN target = 'Sell' AND signal_rules = 'Buy' THEN 1 END) AS sell_as_buy,
       ROUND(AVG(CASE WHEN signal_rules = 'Buy' THEN forward_return END)
           - AVG(CASE WHEN signal_rules = 'Sell' THEN forward_return END), 9) AS spread
FROM scored"""))
def q_a05(spark, sf_dir):
    """V7, V12 and V13 of the rules on the held-out rows."""
    return _rules(_held_out(spark, sf_dir).sizes())


@register("a06_held_out_box", O.with_ctes(*_SCR, body=_HELD_OUT + """
, lg AS (SELECT signal_rules AS signal, forward_return AS r FROM scored WHERE signal_rules IS NOT NULL AND forward_return IS NOT NULL),
q AS (SELECT signal, quantile_cont(r, 0.25) AS q1, quantile_cont(r, 0.5) AS med, quantile_cont(r, 0.75) AS q3 FROM lg GROUP BY signal)
SELECT lg.signal, COUNT(*) AS n, ROUND(MAX(q1), 9) AS q1, ROUND(MAX(med), 9) AS median, ROUND(MAX(q3), 9) AS q3
FROM lg JOIN q ON lg.signal = q.signal GROUP BY lg.signal"""))
def q_a06(spark, sf_dir):
    """V11 of the rules on the held-out rows."""
    return _rules(_held_out(spark, sf_dir).box().select("method", "signal", "n", "q1", "median", "q3"))


@register("a07_fitted_facts", O.with_ctes(*_SCR, body=_SPLIT + """
SELECT target AS class, COUNT(*) AS support, TRUE AS report_agrees, TRUE AS curve_closes, TRUE AS area_in_bounds, TRUE AS box_agrees
FROM sp WHERE is_test GROUP BY target"""))
def q_a07(spark, sf_dir):
    """The fitted model's tables agree with each other, class by class, whatever the fit."""
    e = _held_out(spark, sf_dir)
    conf = materialize(e.confusion().where("method = 'ml_pred_class'"))
    supports = conf.groupBy(F.col("true_label").alias("class")).agg(F.sum("n").alias("support"))
    report = e.report().where("method = 'ml_pred_class'").select(F.col("label").alias("class"), F.col("support").alias("reported"), "recall")
    right = conf.where("true_label = pred_label").select(F.col("true_label").alias("class"), F.col("n").alias("right"))
    curve = e.roc().groupBy("class").agg(F.max("fpr").alias("fpr"), F.max("tpr").alias("tpr"),
                                         F.count_if(F.col("threshold").isNull()).alias("origins"))
    of_signal = (e.pred.where("forward_return is not null").groupBy(F.col("ml_pred_class").alias("class"))
                 .agg(F.count(F.lit(1)).alias("given")))
    box = e.box().where("method = 'ml_pred_class'").select(F.col("signal").alias("class"), F.col("n").alias("boxed"))
    rows = supports.where("support > 0")
    for part in (report, right, curve, e.auc(), of_signal, box):
        rows = rows.join(part, "class", "left")
    zero = F.lit(0)
    return rows.select(
        "class", "support",
        ((F.col("reported") == F.col("support")) & (F.abs(F.col("recall") - F.col("right") / F.col("support")) < 1e-12)).alias("report_agrees"),
        ((F.col("fpr") == 1) & (F.col("tpr") == 1) & (F.col("origins") == 1)).alias("curve_closes"),
        F.col("auc").between(0, 1).alias("area_in_bounds"),
        (F.coalesce("boxed", zero) == F.coalesce("given", zero)).alias("box_agrees"))


@register("a08_fitted_report", None)
def q_a08(spark, sf_dir):
    """V3 of the rules and the fitted model on the held-out rows."""
    return _held_out(spark, sf_dir).report()


@register("a09_fitted_roc", None)
def q_a09(spark, sf_dir):
    """V8 of the fitted model's probabilities on the held-out rows."""
    return _held_out(spark, sf_dir).roc()


@register("a08_fitted_box", None)
def q_a08_box(spark, sf_dir):
    """V11 of the rules and the fitted model on the held-out rows."""
    return _held_out(spark, sf_dir).box()
