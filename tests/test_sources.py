import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sievekit.sources import conform as S
from sievekit.sources import files as IO
from sievekit.sources import prices as P


def test_csv_roundtrip_and_cache_gate(spark):
    df = spark.createDataFrame([(f"t{i}", "S", float(i), None) for i in range(60)],
                               "ticker string, sector string, PE_ratio double, ROE double")
    small = IO.scratch_path(spark, "small")
    assert not IO.write_cache(df.limit(10), small)
    assert not os.path.exists(small)
    path = IO.scratch_path(spark, "cache")
    assert IO.write_cache(df, path)
    back = IO.read_fundamentals(spark, path)
    assert back.count() == 60
    assert back.where(F.col("forward_return").isNotNull()).count() == 0   # absent -> NULL
    assert back.where("ticker = 't7'").first().PE_ratio == 7.0


def test_first_sufficient_source_order(spark):
    small = spark.range(3).toDF("x")
    big = spark.range(80).toDF("x")

    def boom():
        raise FileNotFoundError("no cache")
    name, df = IO.first_sufficient([IO.Tier("cache", boom), IO.Tier("live", lambda: small, 50),
                                    IO.Tier("csv", lambda: big)])
    assert name == "csv" and df.count() == 80
    with pytest.raises(RuntimeError):
        IO.first_sufficient([IO.Tier("a", boom)])


def test_rename_log_conform(spark):
    raw = spark.createDataFrame([("A", 15.0, 1e10, 0.0), ("B", 12.0, 0.0, 1.0)],
                                "ticker string, trailingPE double, marketCap double, beta double")
    out = S.conform_columns(S.log_market_cap(S.rename_raw(raw)))
    assert out.columns[0] == "ticker" and len(out.columns) == 12
    rows = {r.ticker: r for r in out.collect()}
    assert rows["A"].market_cap_log == pytest.approx(10.0)
    assert rows["B"].market_cap_log is None          # log10(0) -> NULL
    assert rows["A"].ROE is None


def test_generated_tickers_are_dense_and_unique(spark):
    df = spark.createDataFrame([(float(i % 7), float(i)) for i in range(200)], "a double, b double")
    out = S.ensure_ticker(df.repartition(5)).toPandas()
    assert sorted(out.ticker) == sorted(f"SYN{i}" for i in range(200))
    first = out.sort_values(["a", "b"]).iloc[0]
    assert first.ticker == "SYN0"


def test_history_filter_and_date_window(spark):
    rows = [("A", f"2020-01-{d:02d}", 1.0) for d in range(1, 21)] + [("B", "2020-01-01", 1.0)]
    p = spark.createDataFrame(rows, "ticker string, date string, close double").withColumn(
        "date", F.to_date("date"))
    assert {r.ticker for r in P.history_filter(p, p, min_rows=10).collect()} == {"A"}
    w = P.date_window(p, "2020-01-10", years=1)
    assert w.count() == 10


def _brute_forward(pdf, months=12):
    out = []
    for t, g in pdf.groupby("ticker"):
        g = g.sort_values("date")
        last = g.date.max()
        for _, r in g.iterrows():
            target = (pd.Timestamp(r.date) + pd.DateOffset(months=months)).date()
            if target > last:
                out.append((t, r.date, None))
                continue
            fut = g[g.date <= target].iloc[-1].close
            out.append((t, r.date, (fut - r.close) / r.close))
    return {(a, b): c for a, b, c in out}


def test_forward_return_matches_bruteforce_with_gaps(spark):
    rng = np.random.default_rng(1)
    days = pd.date_range("2019-01-01", "2021-06-30", freq="D")
    rows = []
    for t in ("A", "B"):
        keep = rng.random(len(days)) < (0.7 if t == "A" else 0.05)   # B: sparse, month-long gaps
        if t == "B":
            keep[(days >= "2020-02-01") & (days < "2020-06-01")] = False
        for d in days[keep]:
            rows.append((t, d.date(), float(rng.uniform(10, 20))))
    pdf = pd.DataFrame(rows, columns=["ticker", "date", "close"])
    got = P.forward_return(spark.createDataFrame(pdf)).collect()
    exp = _brute_forward(pdf)
    assert len(got) == len(exp)
    for r in got:
        e = exp[(r.ticker, r.date)]
        assert (r.forward_return is None) == (e is None)
        if e is not None:
            assert r.forward_return == pytest.approx(e)


def test_data_dictionary_defaults(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "ROE double, mystery double")
    d = {r.column: r.meaning for r in S.data_dictionary(spark, df).collect()}
    assert d["ROE"] == S.COLUMN_DEFINITIONS["ROE"] and d["mystery"] == S.DEFAULT_DEFINITION


def test_date_window_defaults_to_today(spark):
    import datetime
    today = datetime.date.today()
    rows = [("A", today - datetime.timedelta(days=d), 1.0) for d in (0, 1, 400, 800)]
    p = spark.createDataFrame(rows, "ticker string, date date, close double")
    got = sorted(r.date for r in P.date_window(p).collect())
    assert got == sorted(today - datetime.timedelta(days=d) for d in (1, 400))


def test_cache_versions_are_whole_or_absent(spark, tmp_path):
    """A reader never sees a failed or too small write; old versions go, the last two stay."""
    path = str(tmp_path / "cache")
    frame = lambda k, n: spark.range(n).select((F.col("id") + k).cast("string").alias("ticker"), F.lit("s").alias("sector"),
                                               *[F.lit(float(k)).alias(f.name) for f in IO.FUNDAMENTALS_SCHEMA.fields[2:]])
    read = lambda: {r.PE_ratio for r in IO.read_fundamentals(spark, path).collect()}
    assert IO.write_cache(frame(1, 60), path) and read() == {1.0}
    assert not IO.write_cache(frame(2, 10), path) and read() == {1.0}
    bad = frame(3, 60).withColumn("beta", F.when(F.col("ticker") == "40", F.raise_error(F.lit("lost"))).otherwise(F.col("beta")))
    with pytest.raises(Exception, match="lost"):
        IO.publish(spark, path, lambda folder: bad.write.option("header", True).csv(folder))
    assert read() == {1.0}
    # a cache may be rebuilt from itself
    assert IO.write_cache(IO.read_fundamentals(spark, path).withColumn("PE_ratio", F.lit(4.0)), path) and read() == {4.0}
    for k in (5, 6, 7):
        assert IO.write_cache(frame(k, 50), path) and read() == {float(k)}
    kept = [f for f in os.listdir(path) if f.startswith("v")]
    assert len(kept) == 2 and len([m for m in os.listdir(os.path.join(path, "_PUBLISHED")) if m.startswith("v")]) == 2


def test_conform_generates_tickers(spark):
    rows = [(float(i % 50), None if i % 3 else "s") for i in range(400)]
    df = spark.createDataFrame(rows, "PE_ratio double, sector string").repartition(6)
    out = S.conform_columns(df).toPandas()
    assert sorted(out.ticker) == sorted(f"SYN{i}" for i in range(400))
    again = S.conform_columns(df.repartition(3)).toPandas()
    key = lambda f: sorted(zip(f.ticker, f.PE_ratio, f.sector.fillna("")))
    assert key(out) == key(again)
    assert S.conform_columns(df.limit(0)).count() == 0
    kept = S.conform_columns(df.withColumn("ticker", F.lit(None).cast("string")))
    assert kept.where("ticker is not null").count() == 0
