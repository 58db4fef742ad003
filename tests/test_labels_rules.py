import numpy as np
import pytest

from sievekit.operators import labels as L
from sievekit.operators import rules as R


def _ret(spark, vals):
    return spark.createDataFrame([(f"t{i}", v) for i, v in enumerate(vals)],
                                 "ticker string, forward_return double")


def test_inclusive_quantile_labels_match_pandas(spark):
    rng = np.random.default_rng(3)
    vals = [float(v) for v in rng.normal(size=101)]
    got = {r.ticker: r.target for r in L.quantile_label(_ret(spark, vals)).collect()}
    qb, qs = np.quantile(vals, 0.7), np.quantile(vals, 0.3)
    for i, v in enumerate(vals):
        exp = "Buy" if v >= qb else ("Sell" if v <= qs else "Hold")
        assert got[f"t{i}"] == exp


def test_degenerate_guard(spark):
    assert {r.target for r in L.quantile_label(_ret(spark, [0.1, 0.2])).collect()} == {"Hold"}
    assert {r.target for r in L.quantile_label(_ret(spark, [0.3] * 5)).collect()} == {"Hold"}


def test_equal_cutoffs_switch_to_strict(spark):
    vals = [0.0] * 8 + [-1.0, 1.0]            # q0.3 == q0.7 == 0
    got = {r.ticker: r.target for r in L.quantile_label(_ret(spark, vals)).collect()}
    assert got["t8"] == "Sell" and got["t9"] == "Buy"
    assert {got[f"t{i}"] for i in range(8)} == {"Hold"}


def test_null_outcome_is_hold_or_dropped(spark):
    vals = [0.1, 0.2, 0.3, 0.4, None]
    assert L.quantile_label(_ret(spark, vals)).where("ticker = 't4'").first().target == "Hold"
    assert L.quantile_label(_ret(spark, vals), L.TERCILE_POLICY).count() == 4


def test_qcut_boundary_goes_to_hold(spark):
    vals = [float(i) for i in range(11)]      # q0.7 = 7 exactly
    got = {r.ticker: r.target for r in L.quantile_label(_ret(spark, vals), L.QCUT_POLICY).collect()}
    assert got["t7"] == "Hold"                # right-closed bin (.3, .7]
    inc = {r.ticker: r.target for r in L.quantile_label(_ret(spark, vals)).collect()}
    assert inc["t7"] == "Buy"                 # inclusive rule: >= q0.7


def test_fixed_bins_reference_fixture(spark):
    got = [r.target for r in L.fixed_bin_label(_ret(spark, [0.1, 0.05, 0.12])).orderBy("ticker").collect()]
    assert got == ["Hold", "Sell", "Buy"]


def test_class_distribution_order(spark):
    df = spark.createDataFrame([("Hold",), ("Buy",), ("Hold",), ("Sell",), ("Buy",)], "target string")
    assert [tuple(r) for r in L.class_distribution(df).collect()] == [
        ("Buy", 2), ("Hold", 2), ("Sell", 1)]


COLS = "ticker string, PE_ratio double, ROE double, DE_ratio double, revenue_growth double, profit_margin double"


def _screen(spark, rows, rb):
    df = spark.createDataFrame(rows, COLS)
    return {r.ticker: r.signal_rules for r in R.screen(df, rb).collect()}


def test_strict_rulebook_and_sell_override(spark):
    rows = [("buy", 15.0, 0.2, 1.0, 0.1, 0.1),
            ("both", 15.0, 0.2, 1.0, 0.1, 0.1),
            ("sell_pe", 35.0, 0.2, 1.0, 0.1, 0.1),
            ("neg_pe", -5.0, 0.2, 1.0, 0.1, 0.1),
            ("edge", 20.0, 0.2, 1.0, 0.1, 0.1),
            ("nan_roe", 15.0, float("nan"), 1.0, 0.1, 0.1),
            ("null_pm", 15.0, 0.2, 1.0, 0.1, None)]
    got = _screen(spark, rows, R.STRICT)
    assert got["buy"] == "Buy" and got["sell_pe"] == "Sell" and got["neg_pe"] == "Sell"
    assert got["edge"] == "Hold"              # strict P/E < 20
    assert got["nan_roe"] == "Hold"           # NaN meets no threshold (as a pandas mask)
    assert got["null_pm"] == "Hold"           # NULL never meets a threshold


def test_inclusive_bounds_and_precedence(spark):
    rows = [("edge", 20.0, 0.12, 1.5, 0.05, 0.08), ("low_growth", 10.0, 0.2, 1.0, 0.0, 0.1)]
    inc = _screen(spark, rows, R.INCLUSIVE)
    assert inc["edge"] == "Buy"               # inclusive bounds
    assert inc["low_growth"] == "Sell"        # growth <= 0 sells
    # a rulebook whose Buy and Sell overlap: precedence decides
    buy = (R.Rule("ROE", ">", 0.1),)
    sell = (R.Rule("PE_ratio", "<", 12),)
    rows = [("both", 10.0, 0.2, 1.0, 0.1, 0.1)]
    assert _screen(spark, rows, R.Rulebook("s", buy, sell, "sell"))["both"] == "Sell"
    assert _screen(spark, rows, R.Rulebook("b", buy, sell, "buy"))["both"] == "Buy"


def test_missing_column_predicate_is_false(spark):
    df = spark.createDataFrame([("x", 10.0, 0.2, 1.0, 0.1)],
                               "ticker string, PE_ratio double, ROE double, DE_ratio double, revenue_growth double")
    out = R.screen_with_distances(df, R.INCLUSIVE).first()
    assert out.signal_rules == "Hold"         # Buy needs profit_margin, which is absent
    assert out.dist_profit_margin_to_min_buy is None
    assert out.min_distance_to_buy_threshold == pytest.approx(0.05)


def test_rulebook_table_roundtrip(spark):
    t = R.rulebook_table(spark, R.STRICT)
    rb = R.rulebook_from_table(t.collect(), "copy", "sell")
    assert rb.buy == R.STRICT.buy and rb.sell == R.STRICT.sell


def test_strict_threshold_at_exact_tie(spark):
    # 0.08 exactly does not pass "> 0.08"; one ulp above does (the sf0.1 case)
    import math
    above = math.nextafter(0.08, 1.0)
    rows = [("tie", 10.0, 0.2, 1.0, 0.1, 0.08), ("ulp", 10.0, 0.2, 1.0, 0.1, above)]
    got = _screen(spark, rows, R.STRICT)
    assert got == {"tie": "Hold", "ulp": "Buy"}
