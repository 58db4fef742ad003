import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sievekit.functions.ranks import average_ranks
from sievekit.operators import evaluate as V

CLASSES = ["Buy", "Hold", "Sell"]


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(11)
    n = 400
    t = rng.choice(CLASSES, n)
    p = np.where(rng.random(n) < 0.6, t, rng.choice(CLASSES, n))
    s = np.where(rng.random(n) < 0.5, t, rng.choice(CLASSES, n))
    buy = np.round(np.clip((t == "Buy") * 0.3 + rng.random(n) * 0.7, 0, 1), 2)
    r = np.round(rng.normal(size=n) + (t == "Buy") * 0.5, 3)
    pdf = pd.DataFrame({"ticker": [f"t{i}" for i in range(n)], "target": t, "ml_pred_class": p,
                        "signal_rules": s, "ml_buy_proba": buy, "forward_return": r})
    return spark.createDataFrame(pdf), pdf


def _report(y, p, labels):
    rows = {}
    for c in labels:
        tp = np.sum((y == c) & (p == c))
        pc, sup = np.sum(p == c), np.sum(y == c)
        pr = tp / pc if pc else 0.0
        rc = tp / sup if sup else 0.0
        f1 = 2 * pr * rc / (pr + rc) if pr + rc else 0.0
        rows[c] = (pr, rc, f1, sup)
    return rows


def test_report_and_confusion(scored):
    df, pdf = scored
    rep = {r.label: r for r in V.classification_report(df, "target", "ml_pred_class", CLASSES).collect()}
    exp = _report(pdf.target.values, pdf.ml_pred_class.values, CLASSES)
    for c in CLASSES:
        assert rep[c].precision == pytest.approx(exp[c][0])
        assert rep[c].recall == pytest.approx(exp[c][1])
        assert rep[c].f1_score == pytest.approx(exp[c][2])
    sup = np.array([exp[c][3] for c in CLASSES])
    wf1 = float(np.sum([exp[c][2] for c in CLASSES] * sup) / sup.sum())
    assert rep["weighted avg"].f1_score == pytest.approx(wf1)
    cm = V.confusion(df, "target", "ml_pred_class", CLASSES).collect()
    assert len(cm) == 9 and sum(r.n for r in cm) == len(pdf)


def test_zero_division_gives_zero(spark):
    df = spark.createDataFrame([("Buy", "Hold"), ("Hold", "Hold")], "t string, p string")
    rep = {r.label: r for r in V.classification_report(df, "t", "p", ["Buy", "Hold", "Sell"]).collect()}
    assert rep["Buy"].precision == 0.0 and rep["Sell"].f1_score == 0.0


def test_average_ranks_match_pandas_with_ties(spark):
    vals = [3.0, 1.0, 3.0, 2.0, 3.0, 0.5, 2.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    exp = dict(zip(vals, pd.Series(vals).rank(method="average")))
    for b in (1, 2, 5):
        got = {r.x: r.r for r in average_ranks(df, "x", "r", buckets=b).collect()}
        assert got == pytest.approx(exp)


def test_ic_matches_spearman_and_is_rank_invariant(scored):
    df, pdf = scored
    ic = V.information_coefficient(df, "ml_buy_proba", "forward_return").first().ic
    exp = pdf.ml_buy_proba.rank().corr(pdf.forward_return.rank())
    assert ic == pytest.approx(exp, abs=1e-12)
    mono = df.withColumn("ml_buy_proba", F.exp(F.col("ml_buy_proba") * 3))
    assert V.information_coefficient(mono, "ml_buy_proba", "forward_return").first().ic == pytest.approx(ic)
    for b in (1, 3):
        assert V.information_coefficient(df, "ml_buy_proba", "forward_return", b).first().ic == pytest.approx(ic)


def test_ic_null_for_constant_or_single_row(spark):
    df = spark.createDataFrame([(0.5, 0.1), (0.5, 0.2)], "s double, r double")
    assert V.information_coefficient(df, "s", "r").first().ic is None
    one = spark.createDataFrame([(0.5, 0.1)], "s double, r double")
    assert V.information_coefficient(one, "s", "r").first().ic is None


def _auc_bruteforce(y, s):
    pos, neg = s[y], s[~y]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def test_auc_bruteforce_and_symmetry(scored):
    df, pdf = scored
    a = V.auc(df, "target", "ml_buy_proba", "Buy").first().auc
    assert a == pytest.approx(_auc_bruteforce(pdf.target.values == "Buy", pdf.ml_buy_proba.values))
    neg = V.auc(df.withColumn("ml_buy_proba", -F.col("ml_buy_proba")), "target", "ml_buy_proba", "Buy").first().auc
    assert a + neg == pytest.approx(1.0)


def test_roc_points_end_at_one_and_single_class_is_empty(scored, spark):
    df, _ = scored
    pts = V.roc_points(df, "target", "ml_buy_proba", "Buy").collect()
    assert max(p.tpr for p in pts) == pytest.approx(1.0) and max(p.fpr for p in pts) == pytest.approx(1.0)
    assert any(p.threshold is None and p.fpr == 0 and p.tpr == 0 for p in pts)
    one = spark.createDataFrame([("Buy", 0.2), ("Buy", 0.4)], "target string, s double")
    assert V.roc_points(one, "target", "s", "Buy").count() == 0
    assert V.auc(one, "target", "s", "Buy").count() == 0


def test_spread_reference_fixture(spark):
    df = spark.createDataFrame([("A", 0.12, "Buy", "Buy", "Sell"), ("B", 0.05, "Hold", "Sell", "Buy")],
                               "ticker string, forward_return double, target string, "
                               "signal_rules string, ml_pred_class string")
    r = df.agg(V.spread("signal_rules").alias("r"), V.spread("ml_pred_class").alias("m")).first()
    assert r.r == pytest.approx(0.07) and r.m == pytest.approx(-0.07)
    empty = df.agg(V.spread("target").alias("x")).first().x
    assert empty is None                     # no Sell bucket -> NULL


def test_box_stats_match_numpy(scored):
    df, pdf = scored
    got = {(r.method, r.signal): r for r in V.box_stats(df, ["signal_rules"]).collect()}
    for sig, part in pdf.groupby("signal_rules"):
        r = part.forward_return.values
        q1, med, q3 = np.percentile(r, [25, 50, 75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        g = got[("signal_rules", sig)]
        assert (g.q1, g.median, g.q3) == pytest.approx((q1, med, q3))
        assert g.whisker_lo == pytest.approx(r[r >= lo].min())
        assert g.whisker_hi == pytest.approx(r[r <= hi].max())
        assert g.n_outliers == int(((r < lo) | (r > hi)).sum())


def test_comparison_table_shape(scored):
    df, _ = scored
    t = V.comparison_table(df, classes=CLASSES)
    rows = {r.metric: r for r in t.collect()}
    assert list(rows) == list(V.METRICS)
    assert rows["IC (ML Only)"].rules_based is None
    assert V.comparison_long(t).count() == 8


def test_auc_of_very_many_rows_does_not_overflow(spark):
    from pyspark.sql import functions as F

    from sievekit.operators import evaluate as V
    n = 4 * 10**9
    t = spark.createDataFrame([(0.5, n, n)], "s double, pos long, neg long")
    # the aggregate of auc() on one tied score, with counts whose product exceeds a long
    import sievekit.operators.evaluate as mod
    original = mod.prefix_table
    mod.prefix_table = lambda *a, **k: t.withColumn("before_pos", F.lit(0).cast("long")).withColumn("before_neg", F.lit(0).cast("long"))
    try:
        df = spark.createDataFrame([("A", 0.5), ("B", 0.5)], "y string, s double")
        assert abs(V.auc(df, "y", "s", "A").first()["auc"] - 0.5) < 1e-12
    finally:
        mod.prefix_table = original


def test_ranks_treat_nan_as_missing_with_many_buckets(spark):
    from sievekit.functions.ranks import average_ranks
    vals = [float("nan"), None] + [float(i % 13) for i in range(200)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    import pandas as pd
    want = pd.Series(vals[2:]).rank().groupby(vals[2:]).first()
    got = {r["v"]: r["r"] for r in average_ranks(df, "v", "r", buckets=5).collect()}
    assert got == want.to_dict()


def test_evaluation_of_the_fitted_screen(spark):
    """Every table of the held-out rows against numpy on the same predictions."""
    from sievekit.plans.workflow import main_analysis
    from tests.conftest import SF001
    result = main_analysis(spark, SF001, tune=False)
    e, pdf = result.evaluation(), result.predictions.toPandas()
    labels = result.prepared.classes
    y, r = pdf["target"].to_numpy(), pdf["forward_return"].to_numpy(float)
    conf = {(x.method, x.true_label, x.pred_label): x.n for x in e.confusion().collect()}
    rep = {(x.method, x.label): x for x in e.report().collect()}
    sizes = {x.method: x for x in e.sizes().collect()}
    box = {(x.method, x.signal): x for x in e.box().collect()}
    assert len(conf) == 2 * len(labels) ** 2
    for m in ("signal_rules", "ml_pred_class"):
        p = pdf[m].to_numpy()
        for a in labels:
            for b in labels:
                assert conf[m, a, b] == np.sum((y == a) & (p == b))
        for c, (pr, rc, f1, sup) in _report(y, p, labels).items():
            got = rep[m, c]
            assert np.allclose([got.precision, got.recall, got.f1_score, got.support], [pr, rc, f1, sup])
        assert (sizes[m].n_buy, sizes[m].n_sell) == (np.sum(p == "Buy"), np.sum(p == "Sell"))
        assert (sizes[m].buy_as_sell, sizes[m].sell_as_buy) == (np.sum((y == "Buy") & (p == "Sell")), np.sum((y == "Sell") & (p == "Buy")))
        if (p == "Buy").any() and (p == "Sell").any():
            assert sizes[m].spread == pytest.approx(r[p == "Buy"].mean() - r[p == "Sell"].mean())
        for c in np.unique(p):
            b = box[m, c]
            assert np.allclose([b.q1, b.median, b.q3], np.quantile(r[p == c], [.25, .5, .75])) and b.n == np.sum(p == c)
    auc = {x["class"]: x.auc for x in e.auc().collect()}
    for c in labels:
        s = pdf[f"ml_{c.lower()}_proba"].to_numpy(float)
        pos, neg = s[y == c], s[y != c]
        gap = pos[:, None] - neg[None, :]
        assert auc[c] == pytest.approx(((gap > 0) + 0.5 * (gap == 0)).mean())
        points = [(x.fpr, x.tpr) for x in e.roc().where(F.col("class") == c).collect()]
        assert len(points) == len(np.unique(s)) + 1 and max(points) == (1.0, 1.0)
    ranks = pd.DataFrame({"a": pdf["ml_buy_proba"], "b": pdf["forward_return"]}).rank()
    assert e.ic().first().ic == pytest.approx(ranks["a"].corr(ranks["b"]))


def test_report_of_many_labels_and_labels_without_rows(spark):
    """One grouping whatever the number of labels; a label that no row has reports zeros; null and
    unknown predictions count for no label."""
    labels = [f"c{i:03d}" for i in range(300)]
    rows = [(labels[i % 250], labels[i % 125]) for i in range(1000)] + [("c000", None), (None, "c001"), ("c002", "other")]
    rep = {x.label: x for x in V.classification_report(spark.createDataFrame(rows, "t string, p string"), "t", "p", labels).collect()}
    y, p = (np.array([x[k] or "" for x in rows]) for k in (0, 1))
    for c, (pr, rc, f1, sup) in _report(y, p, labels).items():
        assert np.allclose([rep[c].precision, rep[c].recall, rep[c].f1_score, rep[c].support], [pr, rc, f1, sup])
    assert len(rep) == 302 and rep["c299"].support == 0
