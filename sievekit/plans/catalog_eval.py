"""Registered evaluation queries (V1-V16) over the ``scored`` fixture."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluate as V
from ..session import materialize
from ..sources.fixtures import scored
from . import oracle_sql as O
from .registry import register, rounded

METHODS = ("signal_rules", "ml_pred_class")
PROBA = {"Buy": "ml_buy_proba", "Hold": "ml_hold_proba", "Sell": "ml_sell_proba"}


def _scored(spark, sf_dir) -> DataFrame:
    return materialize(scored(spark, sf_dir))


def _sql(body: str) -> str:
    return O.with_ctes(O.FUNDAMENTALS, O.SCORED, body=body)


def _per_method(frames):
    out = None
    for m, f in frames:
        f = f.select(F.lit(m).alias("method"), "*")
        out = f if out is None else out.unionByName(f)
    return out


_LONG = """
, long AS (SELECT 'signal_rules' AS method, ticker, target, signal_rules AS pred, forward_return FROM scored
           UNION ALL
           SELECT 'ml_pred_class', ticker, target, ml_pred_class, forward_return FROM scored),
labels AS (SELECT DISTINCT target AS l FROM scored WHERE target IS NOT NULL)"""

_REPORT = _LONG + """,
cc AS (SELECT long.method, l.l AS label,
         COUNT(CASE WHEN long.target = l.l AND long.pred = l.l THEN 1 END) AS tp,
         COUNT(CASE WHEN long.target = l.l THEN 1 END) AS support,
         COUNT(CASE WHEN long.pred = l.l THEN 1 END) AS predicted
       FROM long CROSS JOIN labels l GROUP BY long.method, l.l),
per0 AS (SELECT method, label,
           CASE WHEN predicted = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(predicted AS DOUBLE) END AS precision,
           CASE WHEN support = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(support AS DOUBLE) END AS recall,
           CAST(support AS DOUBLE) AS support FROM cc),
per AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
                       ELSE 2 * precision * recall / (precision + recall) END AS f1_score FROM per0),
rep AS (
  SELECT method, label, precision, recall, f1_score, support FROM per
  UNION ALL
  SELECT method, 'macro avg', AVG(precision), AVG(recall), AVG(f1_score), SUM(support) FROM per GROUP BY method
  UNION ALL
  SELECT method, 'weighted avg', SUM(precision * support) / SUM(support), SUM(recall * support) / SUM(support),
         SUM(f1_score * support) / SUM(support), SUM(support) FROM per GROUP BY method)"""


# --------------------------------------------------------------------- V1
@register("v01_signal_encoding", _sql("""
, codes AS (SELECT label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS BIGINT) AS code
            FROM (SELECT DISTINCT target AS label FROM scored WHERE target IS NOT NULL))
SELECT s.ticker, s.signal_rules,
       CAST(COALESCE(c.code, (SELECT code FROM codes WHERE label = 'Hold'), 0) AS BIGINT) AS signal_rules_encoded
FROM scored s LEFT JOIN codes c ON s.signal_rules = c.label"""))
def q_v01(spark, sf_dir):
    return V.encode_signal(_scored(spark, sf_dir)).select("ticker", "signal_rules",
                                                          "signal_rules_encoded")


# --------------------------------------------------------------------- V2
@register("v02_confusion_matrix", _sql(_LONG + """
SELECT long.method, t.l AS true_label, p.l AS pred_label, COUNT(long.ticker) AS n
FROM (SELECT DISTINCT method FROM long) m CROSS JOIN labels t CROSS JOIN labels p
LEFT JOIN long ON long.method = m.method AND long.target = t.l AND long.pred = p.l
GROUP BY m.method, t.l, p.l""".replace("SELECT long.method, t.l", "SELECT m.method, t.l")))
def q_v02(spark, sf_dir):
    s = _scored(spark, sf_dir)
    classes = V.class_list(s, "target")
    return _per_method((m, V.confusion(s, "target", m, classes)) for m in METHODS)


# --------------------------------------------------------------------- V3-V5, V16
@register("v03_classification_report", _sql(_REPORT + """
SELECT method, label, ROUND(precision, 9) AS precision, ROUND(recall, 9) AS recall,
       ROUND(f1_score, 9) AS f1_score, ROUND(support, 9) AS support FROM rep"""))
def q_v03(spark, sf_dir):
    s = _scored(spark, sf_dir)
    classes = V.class_list(s, "target")
    return rounded(_per_method((m, V.classification_report(s, "target", m, classes))
                               for m in METHODS))


@register("v04_accuracy", _sql(_LONG + """
SELECT method, ROUND(AVG(CASE WHEN target = pred THEN 1.0 ELSE 0.0 END), 9) AS accuracy
FROM long GROUP BY method"""))
def q_v04(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return rounded(_per_method((m, s.agg(V.accuracy(s, "target", m).alias("accuracy")))
                               for m in METHODS))


@register("v05_weighted_f1", _sql(_REPORT + """
SELECT method, ROUND(f1_score, 9) AS f1_weighted FROM rep WHERE label = 'weighted avg'"""))
def q_v05(spark, sf_dir):
    s = _scored(spark, sf_dir)
    classes = V.class_list(s, "target")
    return rounded(_per_method((m, V.weighted_f1(s, "target", m, classes)) for m in METHODS))


@register("v16_report_table", _sql(_REPORT + """
, acc AS (SELECT method, AVG(CASE WHEN target = pred THEN 1.0 ELSE 0.0 END) AS a FROM long GROUP BY method)
SELECT method, label, ROUND(precision, 9) AS precision, ROUND(recall, 9) AS recall,
       ROUND(f1_score, 9) AS f1_score, ROUND(support, 9) AS support FROM rep
UNION ALL
SELECT method, 'accuracy', ROUND(a, 9), ROUND(a, 9), ROUND(a, 9), ROUND(a, 9) FROM acc"""))
def q_v16(spark, sf_dir):
    s = _scored(spark, sf_dir)
    classes = V.class_list(s, "target")
    return rounded(_per_method((m, V.report_table(s, "target", m, classes)) for m in METHODS))


# --------------------------------------------------------------------- V6, V7
_IC_SQL = """
, b AS (SELECT ml_buy_proba AS a, forward_return AS r FROM scored
        WHERE ml_buy_proba IS NOT NULL AND forward_return IS NOT NULL),
rk AS (SELECT rank() OVER (ORDER BY a) + (COUNT(*) OVER (PARTITION BY a) - 1) / 2.0 AS ra,
              rank() OVER (ORDER BY r) + (COUNT(*) OVER (PARTITION BY r) - 1) / 2.0 AS rb FROM b),
ic AS (SELECT CASE WHEN COUNT(*) >= 2 THEN
                COVAR_POP(ra, rb) / NULLIF(STDDEV_POP(ra) * STDDEV_POP(rb), 0) END AS ic FROM rk)"""


@register("v06_information_coefficient", _sql(_IC_SQL + """
SELECT ROUND(ic, 9) AS ic FROM ic"""))
def q_v06(spark, sf_dir):
    return rounded(V.information_coefficient(_scored(spark, sf_dir), "ml_buy_proba",
                                             "forward_return"))


@register("v07_spread", _sql("""
SELECT ROUND(AVG(CASE WHEN signal_rules = 'Buy' THEN forward_return END)
           - AVG(CASE WHEN signal_rules = 'Sell' THEN forward_return END), 9) AS spread_rules,
       ROUND(AVG(CASE WHEN ml_pred_class = 'Buy' THEN forward_return END)
           - AVG(CASE WHEN ml_pred_class = 'Sell' THEN forward_return END), 9) AS spread_ml
FROM scored"""))
def q_v07(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return rounded(s.agg(V.spread("signal_rules").alias("spread_rules"),
                         V.spread("ml_pred_class").alias("spread_ml")))


# --------------------------------------------------------------------- V8-V10
_ROC_BASE = """
, long AS (
  SELECT 'Buy' AS class, ml_buy_proba AS s, CASE WHEN target = 'Buy' THEN 1 ELSE 0 END AS pos
    FROM scored WHERE ml_buy_proba IS NOT NULL AND target IS NOT NULL
  UNION ALL
  SELECT 'Hold', ml_hold_proba, CASE WHEN target = 'Hold' THEN 1 ELSE 0 END
    FROM scored WHERE ml_hold_proba IS NOT NULL AND target IS NOT NULL
  UNION ALL
  SELECT 'Sell', ml_sell_proba, CASE WHEN target = 'Sell' THEN 1 ELSE 0 END
    FROM scored WHERE ml_sell_proba IS NOT NULL AND target IS NOT NULL),
d AS (SELECT class, s, SUM(pos) AS pos, SUM(1 - pos) AS neg FROM long GROUP BY class, s),
c AS (SELECT class, s, pos, neg,
        SUM(pos) OVER (PARTITION BY class ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
        SUM(neg) OVER (PARTITION BY class ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp
      FROM d),
t AS (SELECT class, SUM(pos) AS P, SUM(neg) AS N FROM d GROUP BY class),
aucs AS (SELECT c.class, SUM(neg * (tp - pos + pos / 2.0)) / (MAX(t.P) * MAX(t.N)) AS auc
         FROM c JOIN t ON c.class = t.class WHERE t.P > 0 AND t.N > 0 GROUP BY c.class)"""


@register("v08_roc_points", _sql(_ROC_BASE + """
SELECT c.class, ROUND(c.s, 9) AS threshold, ROUND(CAST(fp AS DOUBLE) / N, 9) AS fpr,
       ROUND(CAST(tp AS DOUBLE) / P, 9) AS tpr
FROM c JOIN t ON c.class = t.class WHERE P > 0 AND N > 0
UNION ALL
SELECT class, CAST(NULL AS DOUBLE), 0.0, 0.0 FROM t WHERE P > 0 AND N > 0"""))
def q_v08(spark, sf_dir):
    return rounded(V.roc_table(_scored(spark, sf_dir), "target", PROBA))


def _aucs(spark, sf_dir):
    return V.auc_table(_scored(spark, sf_dir), "target", PROBA)


@register("v09_auc", _sql(_ROC_BASE + """
SELECT class, ROUND(auc, 9) AS auc FROM aucs"""))
def q_v09(spark, sf_dir):
    return rounded(_aucs(spark, sf_dir))


@register("v10_macro_auc", _sql(_ROC_BASE + """
SELECT ROUND(AVG(auc), 9) AS macro_auc FROM aucs"""))
def q_v10(spark, sf_dir):
    return rounded(_aucs(spark, sf_dir).agg(F.avg("auc").alias("macro_auc")))


# --------------------------------------------------------------------- V11-V15
@register("v11_box_stats", _sql(_LONG + """
, lg AS (SELECT method, pred AS signal, forward_return AS r FROM long
         WHERE pred IS NOT NULL AND forward_return IS NOT NULL),
q AS (SELECT method, signal, quantile_cont(r, 0.25) AS q1, quantile_cont(r, 0.5) AS med,
             quantile_cont(r, 0.75) AS q3 FROM lg GROUP BY method, signal)
SELECT lg.method, lg.signal, COUNT(*) AS n, ROUND(MAX(q1), 9) AS q1, ROUND(MAX(med), 9) AS median,
       ROUND(MAX(q3), 9) AS q3, ROUND(MAX(q3 - q1), 9) AS iqr,
       ROUND(MIN(CASE WHEN r >= q1 - 1.5 * (q3 - q1) THEN r END), 9) AS whisker_lo,
       ROUND(MAX(CASE WHEN r <= q3 + 1.5 * (q3 - q1) THEN r END), 9) AS whisker_hi,
       COUNT(CASE WHEN r < q1 - 1.5 * (q3 - q1) OR r > q3 + 1.5 * (q3 - q1) THEN 1 END) AS n_outliers
FROM lg JOIN q ON lg.method = q.method AND lg.signal = q.signal
GROUP BY lg.method, lg.signal"""))
def q_v11(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return rounded(V.box_stats(s, METHODS).select(
        "method", "signal", "n", "q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi",
        "n_outliers"))


@register("v12_bucket_sizes", _sql("""
SELECT method, n_buy, n_sell, LEAST(n_buy, n_sell) < 15 AS fragile FROM (
  SELECT 'signal_rules' AS method, COUNT(CASE WHEN signal_rules = 'Buy' THEN 1 END) AS n_buy,
         COUNT(CASE WHEN signal_rules = 'Sell' THEN 1 END) AS n_sell FROM scored
  UNION ALL
  SELECT 'ml_pred_class', COUNT(CASE WHEN ml_pred_class = 'Buy' THEN 1 END),
         COUNT(CASE WHEN ml_pred_class = 'Sell' THEN 1 END) FROM scored)"""))
def q_v12(spark, sf_dir):
    return V.bucket_sizes(_scored(spark, sf_dir), METHODS)


@register("v13_high_stakes_errors", _sql(_LONG + """
SELECT method, COUNT(CASE WHEN target = 'Buy' AND pred = 'Sell' THEN 1 END) AS buy_as_sell,
       COUNT(CASE WHEN target = 'Sell' AND pred = 'Buy' THEN 1 END) AS sell_as_buy
FROM long GROUP BY method"""))
def q_v13(spark, sf_dir):
    return V.high_stakes_errors(_scored(spark, sf_dir), "target", METHODS)


_CMP = _REPORT + _IC_SQL.replace("\n, b AS", ",\nb AS", 1) + """,
acc AS (SELECT method, AVG(CASE WHEN target = pred THEN 1.0 ELSE 0.0 END) AS a FROM long GROUP BY method),
f1 AS (SELECT method, f1_score AS f FROM rep WHERE label = 'weighted avg'),
sp AS (SELECT method, AVG(CASE WHEN pred = 'Buy' THEN forward_return END)
                      - AVG(CASE WHEN pred = 'Sell' THEN forward_return END) AS s FROM long GROUP BY method),
cmp AS (
  SELECT 'Accuracy' AS metric, (SELECT a FROM acc WHERE method = 'signal_rules') AS rules_based,
         (SELECT a FROM acc WHERE method = 'ml_pred_class') AS ml_logistic_reg
  UNION ALL
  SELECT 'F1-Weighted', (SELECT f FROM f1 WHERE method = 'signal_rules'),
         (SELECT f FROM f1 WHERE method = 'ml_pred_class')
  UNION ALL
  SELECT 'IC (ML Only)', CAST(NULL AS DOUBLE), (SELECT ic FROM ic)
  UNION ALL
  SELECT 'Spread (Buy-Sell)', (SELECT s FROM sp WHERE method = 'signal_rules'),
         (SELECT s FROM sp WHERE method = 'ml_pred_class'))"""


@register("v14_comparison_table", _sql(_CMP + """
SELECT metric, ROUND(rules_based, 9) AS rules_based, ROUND(ml_logistic_reg, 9) AS ml_logistic_reg
FROM cmp"""))
def q_v14(spark, sf_dir):
    return rounded(V.comparison_table(_scored(spark, sf_dir)))


@register("v15_comparison_long", _sql(_CMP + """
SELECT metric, 'rules_based' AS method, ROUND(rules_based, 9) AS score FROM cmp
UNION ALL
SELECT metric, 'ml_logistic_reg', ROUND(ml_logistic_reg, 9) FROM cmp"""))
def q_v15(spark, sf_dir):
    return rounded(V.comparison_long(V.comparison_table(_scored(spark, sf_dir))))
