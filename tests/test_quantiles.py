import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sievekit.functions.quantiles import qname, quantiles


def _frame(spark, seed, sizes, ties=False, nulls=False):
    rng = np.random.default_rng(seed)
    rows = []
    for g, n in enumerate(sizes):
        for _ in range(n):
            v = float(rng.integers(0, 5)) if ties else float(rng.normal())
            if nulls and rng.random() < 0.2:
                v = None
            rows.append((f"g{g}", v, float(rng.exponential())))
    return spark.createDataFrame(rows, "g string, a double, b double")


@pytest.mark.parametrize("seed,sizes,ties,nulls", [
    (1, [1, 2, 3, 4, 7], False, False),
    (2, [10, 33, 101], True, False),
    (3, [50, 500, 1500], False, True),
    (4, [6000], False, False),
    (5, [12000], True, True),
])
def test_exact_matches_pandas(spark, seed, sizes, ties, nulls):
    df = _frame(spark, seed, sizes, ties, nulls)
    probs = [0.0, 0.01, 0.3, 0.33, 0.5, 0.66, 0.7, 0.99, 1.0]
    got = quantiles(df, ["a", "b"], probs, by=["g"]).toPandas().set_index("g")
    pdf = df.toPandas()
    for g, part in pdf.groupby("g"):
        for c in ("a", "b"):
            for p in probs:
                exp = part[c].quantile(p)
                val = got.loc[g, qname(c, p)]
                if np.isnan(exp):
                    assert val is None or np.isnan(val)
                else:
                    assert val == pytest.approx(exp, rel=1e-12, abs=1e-12), (g, c, p)


def test_global_and_all_null(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (4.0, None)], "a double, z double")
    got = quantiles(df, ["a", "z"], [0.5]).collect()
    assert quantiles(df, ["a", "z"], [0.5]).collect() == got
    assert len(got) == 1
    assert got[0][qname("a", 0.5)] == 2.0
    assert got[0][qname("z", 0.5)] is None


def test_hot_value_collapses(spark):
    # a third of the rows share one value: the band holds one distinct row
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.col("id").cast("double")).alias("a"))
    got = quantiles(df, ["a"], [0.5]).collect()[0][0]
    assert got == pytest.approx(df.toPandas()["a"].quantile(0.5))


def test_approx_method_close(spark):
    df = _frame(spark, 9, [3000])
    got = quantiles(df, ["a"], [0.5], method="approx").collect()[0][0]
    assert abs(got - df.toPandas()["a"].quantile(0.5)) < 0.05


def test_result_does_not_depend_on_the_sketch(spark):
    df = _frame(spark, 21, [40, 400], ties=True, nulls=True)
    probs = [0.01, 0.25, 0.5, 0.7, 0.99]
    a = quantiles(df, ["a", "b"], probs, by=["g"]).orderBy("g").collect()
    b = quantiles(df, ["a", "b"], probs, by=["g"], accuracy=50).orderBy("g").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]


def test_banded_path_on_hot_group_matches_duckdb(spark):
    """A real skewed key: half of lineitem has return flag 'N'."""
    import duckdb
    from sievekit.sources.tables import read_table, table_path
    sf = "/root/testdata/sf0.01"
    li = read_table(spark, sf, "lineitem", ["l_returnflag", "l_extendedprice", "l_discount"])
    probs = [0.01, 0.5, 0.99]
    got = quantiles(li, ["l_extendedprice", "l_discount"], probs, by=["l_returnflag"]).toPandas().set_index("l_returnflag")
    sql = ", ".join(f"quantile_cont({c}, {p}) AS \"{qname(c, p)}\""
                    for c in ("l_extendedprice", "l_discount") for p in probs)
    exp = duckdb.sql(f"SELECT l_returnflag, {sql} FROM read_parquet('{table_path(sf, 'lineitem')}') "
                     "GROUP BY l_returnflag").df().set_index("l_returnflag")
    for flag in exp.index:
        for col in exp.columns:
            assert got.loc[flag, col] == pytest.approx(exp.loc[flag, col], rel=1e-12), (flag, col)


def test_nan_counts_as_missing_and_infinities_are_values(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([("g", v) for v in [1.0, 2.0, nan, 4.0, None, inf, 3.0]] + [("h", nan), ("h", None), (None, 5.0)],
                               "g string, a double")
    got = {r[0]: (r[1], r[2], r[3]) for r in quantiles(df, ["a"], [0.0, 0.5, 0.75], by=["g"]).collect()}
    assert got["g"] == (1.0, 3.0, 4.0) and got[None] == (5.0, 5.0, 5.0) and got["h"] == (None, None, None)


def test_only_in_band_values_become_rows(spark):
    """Rows aren't multiplied by columns and probabilities: what leaves the generator is the band."""
    df = spark.range(40_000).select(*[F.rand(i).alias(f"c{i}") for i in range(4)])
    long = quantiles(df, [f"c{i}" for i in range(4)], [0.01, 0.5, 0.99], accuracy=1000)
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert "Generate inline(filter(" in plan.replace("\n", " ")
    inner = [v for i in range(4) for v in [df.select(f"c{i}").toPandas()[f"c{i}"].quantile([0.01, 0.5, 0.99]).tolist()]]
    row = long.first()
    for i in range(4):
        for p, want in zip((0.01, 0.5, 0.99), inner[i]):
            assert row[qname(f"c{i}", p)] == pytest.approx(want, rel=1e-12)
