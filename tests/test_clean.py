import math

import pytest
from pyspark.sql import functions as F

from sievekit.functions.nulls import nan_to_null, to_double, truthy
from sievekit.operators import clean as C

NAN = float("nan")
SCHEMA = ("ticker string, sector string, PE_ratio double, ROE double, DE_ratio double, "
          "profit_margin double, forward_return double")


def test_nan_becomes_null_and_predicates_are_false(spark):
    df = spark.createDataFrame([("a", NAN), ("b", 40.0), ("c", None)], "t string, x double")
    out = nan_to_null(df).select("t", truthy(F.col("x") > 30).alias("p")).orderBy("t").collect()
    # NaN > 30 is true in Spark; after normalisation it is "not met", as in pandas
    assert [r.p for r in out] == [False, True, False]


@pytest.mark.parametrize("text,expected", [
    ("1.5", 1.5), (" 1.5 ", 1.5), ("1e3", 1000.0), ("inf", math.inf), ("-Infinity", -math.inf),
    ("", None), ("1,000", None), ("1d", None), ("2.5F", None), ("abc", None), (None, None)])
def test_to_double_matches_pandas_coercion(spark, text, expected):
    got = spark.createDataFrame([(text,)], "s string").select(to_double(F.col("s"))).first()[0]
    assert got == expected


@pytest.mark.parametrize("ncols,need", [(12, 9), (10, 7), (3, 3), (1, 1)])
def test_sparse_row_threshold_is_the_float_product_rounded_up(spark, ncols, need):
    # 12 * 0.7 = 8.399999999999999 -> 9 values needed
    cols = ", ".join(f"c{i} double" for i in range(ncols))
    rows = [tuple(1.0 if j < k else None for j in range(ncols)) for k in range(ncols + 1)]
    kept = C.drop_sparse_rows(spark.createDataFrame(rows, cols)).count()
    assert kept == ncols + 1 - need


def test_sector_then_global_median_order(spark):
    rows = [("a", "X", 1.0), ("b", "X", 3.0), ("c", "X", None),
            ("d", "Y", None), ("e", "Y", None), ("f", None, None)]
    df = C.fill_sector(spark.createDataFrame(rows, "ticker string, sector string, v double"))
    s5 = C.impute_group_median(df, ["v"], "sector")
    got5 = {r.ticker: r.v for r in s5.collect()}
    assert got5 == {"a": 1.0, "b": 3.0, "c": 2.0, "d": None, "e": None, "f": None}
    # global median is taken over the sector-imputed column: [1, 3, 2] -> 2
    s6 = C.impute_global_median(s5, ["v"])
    assert {r.ticker: r.v for r in s6.collect()} == {k: v if v is not None else 2.0
                                                    for k, v in got5.items()}
    assert {r.sector for r in df.collect()} == {"X", "Y", "Unknown"}


def test_winsorize_clips_and_keeps_null(spark):
    vals = [float(i) for i in range(101)] + [None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    out = [r.x for r in C.winsorize(df, ["x"]).collect()]
    assert min(v for v in out if v is not None) == pytest.approx(1.0)
    assert max(v for v in out if v is not None) == pytest.approx(99.0)
    assert out.count(None) == 1
    # idempotent for fixed bounds
    b = C.winsor_bounds(df, ["x"]).first()
    once = C.winsorize(df, ["x"], bounds=b)
    twice = C.winsorize(once, ["x"], bounds=b)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_reference_fixture_engineered_values(spark):
    # the three-ticker fixture: max D/E 0.6 -> leverage-adjusted ROE
    rows = [("AAPL", "Technology", 30.0, 0.4, 0.5, 0.2, 0.1),
            ("GOOG", "Technology", 25.0, 0.3, 0.6, 0.18, 0.05),
            ("MSFT", "Technology", 35.0, 0.5, 0.4, 0.22, 0.12)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r.ticker: r for r in C.add_engineered(df).collect()}
    assert out["AAPL"].leverage_adj_roe == pytest.approx(0.0666667, abs=1e-7)
    assert out["GOOG"].leverage_adj_roe == pytest.approx(0.0, abs=1e-12)
    assert out["MSFT"].leverage_adj_roe == pytest.approx(0.1666667, abs=1e-7)
    assert out["AAPL"].earnings_yield == pytest.approx(1 / 30)
    assert out["GOOG"].quality_score == pytest.approx(0.3 * 0.18)


def test_zero_pe_and_zero_max_de(spark):
    rows = [("a", "S", 0.0, 0.2, 0.0, 0.1, 0.1), ("b", "S", 10.0, 0.3, 0.0, 0.1, 0.2)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r.ticker: r for r in C.add_engineered(df).collect()}
    assert out["a"].earnings_yield is None                 # P/E = 0 -> NULL, row later dropped
    assert out["b"].leverage_adj_roe == pytest.approx(0.3)  # max D/E = 0 -> ROE unchanged
    assert [r.ticker for r in C.drop_incomplete(C.add_engineered(df)).collect()] == ["b"]


def test_clean_without_sector_uses_global_median(spark):
    rows = [(f"t{i}", float(i) if i % 4 else None, 0.1 + i / 100, 1.0, 0.1, 0.05 * i)
            for i in range(1, 30)]
    df = spark.createDataFrame(rows, "ticker string, PE_ratio double, ROE double, DE_ratio double, "
                                     "profit_margin double, forward_return double")
    out = C.clean_and_engineer(df, C.CleanConfig(barrier="none"))
    assert out.where(F.col("PE_ratio").isNull()).count() == 0
    assert "sector" not in out.columns
    assert out.count() == 29


def test_all_null_column_stays_null(spark):
    rows = [(f"t{i}", "S", float(i + 1), 0.2, None, 0.1, 0.1) for i in range(12)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = C.clean_and_engineer(df, C.CleanConfig(barrier="none", min_present=0.5))
    assert out.where(F.col("DE_ratio").isNotNull()).count() == 0
    # max D/E is NULL, so leverage-adjusted ROE falls back to ROE
    assert all(r.leverage_adj_roe == pytest.approx(r.ROE) for r in out.collect())
