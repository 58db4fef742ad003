"""Evaluation (V1-V16): classification metrics and the two finance metrics.

All metrics are aggregates over the scored frame; per-class tables have
one row per class.  The class list (a handful of labels) is the only
thing that reaches the driver, to fix the label order of the outputs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

from ..functions.nulls import MAX_LABELS, bounded_distinct
from ..functions.quantiles import qname, quantiles
from ..functions.ranks import prefix_table, rank_correlation
from ..functions.stats import scalars

BUY, HOLD, SELL = "Buy", "Hold", "Sell"
_COUNTS = ("tp", "support", "predicted")


def class_list(df: DataFrame, *cols: str, limit: int = MAX_LABELS) -> list[str]:
    """Sorted distinct labels over ``cols``; more than ``limit`` in a column raise."""
    vals: set[str] = set()
    for c in cols:
        vals |= set(bounded_distinct(df, c, limit))
    return sorted(vals)


def label_codes(df: DataFrame, target: str = "target") -> DataFrame:
    """(label, code): alphabetical codes of the target's labels (Buy=0...); the
    labels are a bounded list, proven before it reaches the driver."""
    labels = bounded_distinct(df, target)
    return df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(labels)], "label string, code long")


def encode_signal(df: DataFrame, signal: str = "signal_rules", target: str = "target",
                  out: str = "signal_rules_encoded", default: str = HOLD) -> DataFrame:
    """V1: map a signal to the target's codes; unknown -> the default's code."""
    labels = bounded_distinct(df, target)
    code = F.array_position(F.array(*[F.lit(c) for c in labels]).cast("array<string>"), F.col(signal).cast("string")) - 1
    other = labels.index(default) if default in labels else 0
    return df.select("*", F.when(code >= 0, code).otherwise(F.lit(other)).cast(LongType()).alias(out))


def confusion(df: DataFrame, true: str, pred: str, classes: Sequence[str]) -> DataFrame:
    """V2: long confusion matrix (true_label, pred_label, n), zero cells kept,
    fixed label order; predictions outside ``classes`` are ignored."""
    labels = F.array(*[F.lit(c) for c in classes])
    counts = df.groupBy(F.col(true).alias("_t"), F.col(pred).alias("_p")).agg(F.count(F.lit(1)).alias("n"))
    grid = (df.sparkSession.range(1).select(F.explode(labels).alias("true_label"))
            .select("true_label", F.explode(labels).alias("pred_label")))
    on = (grid["true_label"] == counts["_t"]) & (grid["pred_label"] == counts["_p"])
    return grid.join(counts, on, "left").select("true_label", "pred_label", F.coalesce("n", F.lit(0)).alias("n"))


def label_counts(df: DataFrame, true: str, pred: str) -> DataFrame:
    """(_l, tp, support, predicted) of every label found: one grouping by the pair of labels, whose
    few rows then count for the true and for the predicted label."""
    pairs = df.groupBy(F.col(true).alias("_t"), F.col(pred).alias("_p")).agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(0).cast(LongType())
    as_true = F.struct(F.col("_t").alias("label"), F.when(F.col("_t") == F.col("_p"), F.col("n")).otherwise(none).alias("tp"),
                       F.col("n").alias("support"), none.alias("predicted"))
    as_pred = F.struct(F.col("_p").alias("label"), none.alias("tp"), none.alias("support"), F.col("n").alias("predicted"))
    return (pairs.select(F.inline(F.array(as_true, as_pred)))
            .groupBy(F.col("label").alias("_l")).agg(*[F.sum(c).alias(c) for c in _COUNTS]))


def _class_counts(df: DataFrame, true: str, pred: str, classes: Sequence[str]) -> DataFrame:
    """(label, tp, support, predicted) of the given classes; those without rows keep zeros."""
    per, none = label_counts(df, true, pred), F.lit(0).cast(LongType())
    labels = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in classes])).alias("label"))
    return (labels.join(per, F.col("label") == F.col("_l"), "left")
            .select("label", *[F.coalesce(c, none).alias(c) for c in _COUNTS]))


def _zdiv(a: Column, b: Column) -> Column:
    """a / b with 0 on zero division (``zero_division=0``)."""
    return F.coalesce(F.try_divide(a.cast(DoubleType()), F.when(b != 0, b.cast(DoubleType()))),
                      F.lit(0.0))


def classification_report(df: DataFrame, true: str, pred: str,
                          classes: Sequence[str]) -> DataFrame:
    """V3: per-class precision/recall/F1/support plus 'macro avg' and
    'weighted avg' rows (support = total)."""
    cc = _class_counts(df, true, pred, classes)
    per = cc.select(
        "label",
        _zdiv(F.col("tp"), F.col("predicted")).alias("precision"),
        _zdiv(F.col("tp"), F.col("support")).alias("recall"),
        F.col("support").cast(DoubleType()).alias("support"))
    per = per.withColumn("f1_score", _zdiv(2 * F.col("precision") * F.col("recall"),
                                           F.col("precision") + F.col("recall")))
    tot = F.sum("support")
    macro = per.agg(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), tot.alias("support"),
                    F.avg("f1_score").alias("f1_score"))
    weighted = per.agg(F.lit("weighted avg").alias("label"),
                       _zdiv(F.sum(F.col("precision") * F.col("support")), tot).alias("precision"),
                       _zdiv(F.sum(F.col("recall") * F.col("support")), tot).alias("recall"),
                       tot.alias("support"),
                       _zdiv(F.sum(F.col("f1_score") * F.col("support")), tot).alias("f1_score"))
    cols = ["label", "precision", "recall", "f1_score", "support"]
    return per.select(*cols).unionByName(macro.select(*cols)).unionByName(weighted.select(*cols))


def accuracy(df: DataFrame, true: str, pred: str) -> Column:
    """V4 as an aggregate expression: share of rows where true == pred."""
    del df
    return F.avg(F.coalesce(F.col(true) == F.col(pred), F.lit(False)).cast(DoubleType()))


def weighted_f1(df: DataFrame, true: str, pred: str, classes: Sequence[str]) -> DataFrame:
    """V5: one-row weighted F1."""
    rep = classification_report(df, true, pred, classes)
    return rep.where(F.col("label") == "weighted avg").select(F.col("f1_score").alias("f1_weighted"))


def report_table(df: DataFrame, true: str, pred: str, classes: Sequence[str]) -> DataFrame:
    """The report transposed to label x metric, as a dict-of-dicts frame
    transposes: the 'accuracy' row repeats accuracy in every metric column."""
    rep = classification_report(df, true, pred, classes)
    acc = df.agg(*[accuracy(df, true, pred).alias(c)
                   for c in ("precision", "recall", "f1_score", "support")])
    acc = acc.select(F.lit("accuracy").alias("label"), "precision", "recall", "f1_score", "support")
    per = rep.where(~F.col("label").isin("macro avg", "weighted avg"))
    avgs = rep.where(F.col("label").isin("macro avg", "weighted avg"))
    return per.unionByName(acc).unionByName(avgs)


def information_coefficient(df: DataFrame, score: str, outcome: str,
                            buckets: int | None = None) -> DataFrame:
    """V6: Spearman rank correlation (average ranks on ties) of score and
    outcome over pairwise-complete rows; NULL for < 2 rows or constant input."""
    r = rank_correlation(df, score, outcome, buckets)
    return r.select(F.when(F.col("n") >= 2, F.col("corr")).alias("ic"))


def spread(signal: str, outcome: str = "forward_return") -> Column:
    """V7 as an aggregate: mean outcome of Buy minus mean of Sell (NULL if
    either bucket is empty)."""
    r, s = F.col(outcome), F.col(signal)
    return F.avg(F.when(s == BUY, r)) - F.avg(F.when(s == SELL, r))


def _roc_prefix(df: DataFrame, true: str, scores: dict[str, str], buckets: int | None) -> DataFrame:
    """One pass for all classes: (class, threshold, pos, neg, before_..., all_...) per distinct
    score, highest first, of the classes that have both outcomes."""
    items = F.array(*[F.struct(F.lit(c).alias("class"), F.col(s).cast(DoubleType()).alias("threshold"),
                               (F.col(true) == c).cast("long").alias("_hit")) for c, s in scores.items()])
    long = df.where(F.col(true).isNotNull()).select(F.inline(items)).where(F.col("threshold").isNotNull())
    t = prefix_table(long, "threshold", {"pos": F.col("_hit"), "neg": 1 - F.col("_hit")}, descending=True,
                     buckets=buckets, by=["class"])
    return t.where((F.col("all_pos") > 0) & (F.col("all_neg") > 0))


def roc_table(df: DataFrame, true: str, scores: dict[str, str], buckets: int | None = None) -> DataFrame:
    """V8 for several classes (class -> its score column): (class, threshold, fpr, tpr) at every
    distinct score of each, plus each class's (0, 0) origin with a NULL threshold.  A class
    that is the only label, or never is one, has no rows."""
    t = _roc_prefix(df, true, scores, buckets)
    point = F.struct(F.col("threshold"), ((F.col("before_neg") + F.col("neg")) / F.col("all_neg")).alias("fpr"),
                     ((F.col("before_pos") + F.col("pos")) / F.col("all_pos")).alias("tpr"))
    origin = F.struct(F.lit(None).cast(DoubleType()).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    first = F.col("before_pos") + F.col("before_neg") == 0
    return t.select("class", F.inline(F.when(first, F.array(origin, point)).otherwise(F.array(point))))


def roc_points(df: DataFrame, true: str, score: str, positive: str,
               buckets: int | None = None) -> DataFrame:
    """V8: one-vs-rest ROC points (threshold, fpr, tpr) at every distinct
    score, highest first, plus the (0, 0) origin with a NULL threshold.
    Empty when the true labels hold a single value."""
    return roc_table(df, true, {positive: score}, buckets).select("threshold", "fpr", "tpr", "class")


def auc_table(df: DataFrame, true: str, scores: dict[str, str], buckets: int | None = None) -> DataFrame:
    """V9 for several classes in one pass: (class, auc); see :func:`auc`."""
    t = _roc_prefix(df, true, scores, buckets)
    above = F.sum(F.col("neg") * (F.col("before_pos") + F.col("pos") / 2.0))
    return t.groupBy("class").agg((above / (F.first("all_pos").cast(DoubleType()) * F.first("all_neg").cast(DoubleType()))).alias("auc"))


def auc(df: DataFrame, true: str, score: str, positive: str,
        buckets: int | None = None) -> DataFrame:
    """V9: one-vs-rest AUC (trapezoid over the ROC = rank-sum statistic with
    ties counted half).  No row when a single label value is present."""
    is_pos = (F.col(true) == positive).cast("long")
    base = df.where(F.col(score).isNotNull() & F.col(true).isNotNull())
    t = prefix_table(base, score, {"pos": is_pos, "neg": 1 - is_pos}, descending=True,
                     buckets=buckets)
    agg = t.agg(F.sum(F.col("neg") * (F.col("before_pos") + F.col("pos") / 2.0)).alias("w"),
                F.sum("pos").cast(DoubleType()).alias("P"), F.sum("neg").cast(DoubleType()).alias("N"))
    return (agg.where((F.col("P") > 0) & (F.col("N") > 0))
               .select(F.lit(positive).alias("class"),
                       (F.col("w") / (F.col("P") * F.col("N"))).alias("auc")))


def box_stats(df: DataFrame, signals: Sequence[str], outcome: str = "forward_return",
              whis: float = 1.5) -> DataFrame:
    """Per (method, signal): quartiles, IQR, whiskers at the most
    extreme values within ``whis`` x IQR of the box, outlier count."""
    long = None
    for s in signals:
        part = df.select(F.lit(s).alias("method"), F.col(s).alias("signal"), F.col(outcome).alias("r"))
        long = part if long is None else long.unionByName(part)
    long = long.where(F.col("signal").isNotNull() & F.col("r").isNotNull())
    q = quantiles(long, ["r"], [0.25, 0.5, 0.75], by=["method", "signal"])
    q = q.select("method", "signal", F.col(qname("r", 0.25)).alias("q1"),
                 F.col(qname("r", 0.5)).alias("median"), F.col(qname("r", 0.75)).alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo = F.col("q1") - whis * F.col("iqr")
    hi = F.col("q3") + whis * F.col("iqr")
    j = long.join(F.broadcast(q), ["method", "signal"])     # methods x classes rows
    r = F.col("r")
    return j.groupBy("method", "signal").agg(
        F.count(F.lit(1)).alias("n"), F.first("q1").alias("q1"), F.first("median").alias("median"),
        F.first("q3").alias("q3"), F.first("iqr").alias("iqr"),
        F.min(F.when(r >= lo, r)).alias("whisker_lo"), F.max(F.when(r <= hi, r)).alias("whisker_hi"),
        F.count(F.when((r < lo) | (r > hi), 1)).alias("n_outliers"))


def bucket_sizes(df: DataFrame, signals: Sequence[str], fragile_below: int = 15) -> DataFrame:
    """Buy/Sell bucket sizes per method and the small-bucket flag."""
    rows = None
    for s in signals:
        part = df.agg(F.lit(s).alias("method"),
                      F.count(F.when(F.col(s) == BUY, 1)).alias("n_buy"),
                      F.count(F.when(F.col(s) == SELL, 1)).alias("n_sell"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.withColumn("fragile", F.least("n_buy", "n_sell") < fragile_below)


def high_stakes_errors(df: DataFrame, true: str, signals: Sequence[str]) -> DataFrame:
    """True Buy predicted Sell, and true Sell predicted Buy, per method."""
    rows = None
    for s in signals:
        t, p = F.col(true), F.col(s)
        part = df.agg(F.lit(s).alias("method"),
                      F.count(F.when((t == BUY) & (p == SELL), 1)).alias("buy_as_sell"),
                      F.count(F.when((t == SELL) & (p == BUY), 1)).alias("sell_as_buy"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


# The metric names of the comparison table.
METRICS = ("Accuracy", "F1-Weighted", "IC (ML Only)", "Spread (Buy-Sell)")


def comparison_table(df: DataFrame, true: str = "target", rules: str = "signal_rules",
                     ml: str = "ml_pred_class", score: str = "ml_buy_proba",
                     outcome: str = "forward_return", classes: Sequence[str] | None = None,
                     buckets: int | None = None) -> DataFrame:
    """Metric x (rules_based, ml_logistic_reg); IC is NULL for rules."""
    classes = classes or class_list(df, true)
    # one pass for everything but the ranks
    aggs = [accuracy(df, true, rules).alias("acc_r"), accuracy(df, true, ml).alias("acc_m"),
            spread(rules, outcome).alias("sp_r"), spread(ml, outcome).alias("sp_m")]
    for side, pred in (("r", rules), ("m", ml)):
        for i, c in enumerate(classes):
            t, p = F.col(true) == c, F.col(pred) == c
            aggs += [F.count(F.when(t & p, 1)).alias(f"tp_{side}{i}"), F.count(F.when(t, 1)).alias(f"su_{side}{i}"),
                     F.count(F.when(p, 1)).alias(f"pc_{side}{i}")]
    base = df.agg(*aggs)

    def f1(side: str) -> Column:
        total, weighted = F.lit(0.0), F.lit(0.0)
        for i in range(len(classes)):
            tp, su, pc = (F.col(f"{k}_{side}{i}").cast(DoubleType()) for k in ("tp", "su", "pc"))
            precision, recall = _zdiv(tp, pc), _zdiv(tp, su)
            total = total + su
            weighted = weighted + _zdiv(2 * precision * recall, precision + recall) * su
        return _zdiv(weighted, total)

    row = scalars(base.select("acc_r", "acc_m", "sp_r", "sp_m", f1("r").alias("f1_r"), f1("m").alias("f1_m")),
                  ["acc_r", "acc_m", "sp_r", "sp_m", "f1_r", "f1_m"])
    s = {**row, **scalars(information_coefficient(df, score, outcome, buckets), ["ic"])}
    null = F.lit(None).cast(DoubleType())
    items = [F.struct(F.lit(METRICS[0]).alias("metric"), s["acc_r"].alias("rules_based"),
                      s["acc_m"].alias("ml_logistic_reg")),
             F.struct(F.lit(METRICS[1]).alias("metric"), s["f1_r"].alias("rules_based"),
                      s["f1_m"].alias("ml_logistic_reg")),
             F.struct(F.lit(METRICS[2]).alias("metric"), null.alias("rules_based"),
                      s["ic"].alias("ml_logistic_reg")),
             F.struct(F.lit(METRICS[3]).alias("metric"), s["sp_r"].alias("rules_based"),
                      s["sp_m"].alias("ml_logistic_reg"))]
    return df.sparkSession.range(1).select(F.inline(F.array(*items)))


def comparison_long(table: DataFrame) -> DataFrame:
    """Wide -> long (metric, method, score), NULL scores kept."""
    return table.unpivot("metric", ["rules_based", "ml_logistic_reg"], "method", "score")
