import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sievekit.operators import features as M
from sievekit.operators import model as T


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(5)
    n = 240
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    logits = np.stack([1.5 * x1, 0.2 * x2, -1.5 * x1 + 0.5 * x2], axis=1)
    p = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
    y = np.array([rng.choice(3, p=row) for row in p])
    names = np.array(["Buy", "Hold", "Sell"])[y]
    sector = rng.choice(["A", "B", "C"], n)
    pdf = pd.DataFrame({"ticker": [f"T{i:04d}" for i in range(n)], "sector": sector,
                        "x1": x1, "x2": x2, "forward_return": rng.normal(size=n),
                        "target": names, "signal_rules": "Hold"})
    return spark.createDataFrame(pdf)


def test_split_partitions_rows_with_exact_quotas(frame):
    sp = M.stratified_split(frame).toPandas()
    assert len(sp) == frame.count() and sp.ticker.is_unique
    for cls, part in sp.groupby("target"):
        assert part.is_test.sum() == int(np.floor(0.3 * len(part) + 0.5))
    # deterministic: same seed, same split; different seed, different split
    base = sp.set_index("ticker").is_test.sort_index()
    again = M.stratified_split(frame).toPandas().set_index("ticker").is_test.sort_index()
    assert (again == base).all()
    other = M.stratified_split(frame, seed=7).toPandas().set_index("ticker").is_test.sort_index()
    assert not (other == base).all()


def test_split_matches_hash_order(frame):
    sp = M.stratified_split(frame, prefix_hex=1).toPandas()
    import hashlib
    sp["h"] = [hashlib.md5((t + "42").encode()).hexdigest() for t in sp.ticker]
    for cls, part in sp.groupby("target"):
        k = int(np.floor(0.3 * len(part) + 0.5))
        want = set(part.sort_values(["h", "ticker"]).ticker[:k])
        assert set(part[part.is_test].ticker) == want


def test_folds_are_balanced_per_class(frame):
    coded = M.label_index(frame, ["Buy", "Hold", "Sell"])
    f = T.assign_folds(coded, 5).toPandas()
    for _, part in f.groupby("label"):
        counts = part.fold.value_counts()
        assert counts.max() - counts.min() <= 1


def test_scaler_population_std_and_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, c double")
    sc = M.fit_scaler(df, ["a", "c"])
    out = sc.transform(df).toPandas()
    assert out.a.tolist() == pytest.approx([-1.224744871, 0.0, 1.224744871])
    assert out.c.tolist() == [0.0, 0.0, 0.0]            # zero std -> scale 1


def test_one_hot_drop_first_and_unseen(spark):
    df = spark.createDataFrame([("a", "X"), ("b", "Y"), ("c", None), ("d", "Z")], "t string, sector string")
    cats = M.fit_categories(df.where("t != 'd'"))
    assert cats == ["Unknown", "X", "Y"]
    out = {r.t: r for r in M.one_hot(df, cats).collect()}
    assert "sector_Unknown" not in M.one_hot(df, cats).columns
    assert (out["a"].sector_X, out["a"].sector_Y) == (1, 0)
    assert (out["d"].sector_X, out["d"].sector_Y) == (0, 0)   # unseen -> baseline


def _numpy_multinomial(X, y, C, iters=60):
    """Newton's method on C*sum(loss) + 1/2 ||W||^2 (intercepts free, centred)."""
    n, p = X.shape
    K = y.max() + 1
    Xb = np.hstack([X, np.ones((n, 1))])
    W = np.zeros((K, p + 1))
    Y = np.eye(K)[y]
    reg = np.ones(p + 1)
    reg[-1] = 1e-9
    for _ in range(iters):
        Z = Xb @ W.T
        P = np.exp(Z - Z.max(1, keepdims=True))
        P /= P.sum(1, keepdims=True)
        G = C * (P - Y).T @ Xb + W * reg
        H = np.zeros((K * (p + 1), K * (p + 1)))
        for a in range(K):
            for b in range(K):
                w = P[:, a] * ((a == b) - P[:, b])
                H[a * (p + 1):(a + 1) * (p + 1), b * (p + 1):(b + 1) * (p + 1)] = C * (Xb.T * w) @ Xb
        H += np.diag(np.tile(reg, K))
        W -= np.linalg.lstsq(H, G.ravel(), rcond=None)[0].reshape(K, p + 1)
    W[:, -1] -= W[:, -1].mean()
    return W[:, :-1], W[:, -1]


def test_model_matches_numpy_solver_and_probabilities_sum(frame, spark):
    prep = T.prepare(frame, barrier="none")
    m = T.train_screen_model(prep, tune=False)
    tr = prep.train.toPandas()
    X = tr[prep.features].to_numpy(float)
    y = tr["label"].to_numpy(int)
    W, b = _numpy_multinomial(X, y, T.DEFAULT_C)
    assert np.allclose(m.model.coefficientMatrix.toArray(), W, atol=2e-3)
    assert np.allclose(m.model.interceptVector.toArray(), b, atol=2e-3)
    pr = m.predict(prep.test, keep=["ticker"]).toPandas()
    s = pr[["ml_buy_proba", "ml_hold_proba", "ml_sell_proba"]].sum(1)
    assert np.allclose(s, 1.0)


def test_stronger_regularisation_shrinks_and_scoring_is_consistent(frame, spark):
    prep = T.prepare(frame, barrier="none")
    train = T.assemble(prep.train, prep.features)
    n = train.count()
    weak = T.make_lr(10.0, n).fit(train).coefficientMatrix.toArray()
    strong = T.make_lr(0.01, n).fit(train).coefficientMatrix.toArray()
    assert np.linalg.norm(strong) < np.linalg.norm(weak)
    m = T.train_screen_model(prep, tune=False)
    # scoring raw training rows (T8) equals predicting the prepared rows (T5)
    raw = frame.join(prep.train.select("ticker"), "ticker")
    a = m.score(raw, keep=["ticker"]).orderBy("ticker").toPandas()
    b = m.predict(prep.train, keep=["ticker"]).orderBy("ticker").toPandas()
    assert (a.ml_pred_class == b.ml_pred_class).all()
    assert np.allclose(a.ml_buy_proba, b.ml_buy_proba)


def test_grid_search_picks_a_grid_value(frame):
    prep = T.prepare(frame, barrier="none")
    m = T.train_screen_model(prep, grid=(0.1, 1.0), tune=True)
    assert m.best_c in (0.1, 1.0) and set(m.grid.scores) == {0.1, 1.0}
    coef = m.class_coefficients(frame.sparkSession, "Buy").toPandas()
    assert coef.coefficient.is_monotonic_decreasing


def test_grid_search_fits_read_one_partition_however_files_are_split(frame, spark, monkeypatch):
    """An iteration of L-BFGS runs a task per partition: splits of small files must not multiply them."""
    prep = T.prepare(frame, barrier="none")
    train = T.assemble(prep.train, prep.features)
    parts, make = [], T.make_lr

    class Counting:
        def __init__(self, lr):
            self.lr = lr

        def fit(self, df):
            parts.append(df.rdd.getNumPartitions())
            return self.lr.fit(df)

    monkeypatch.setattr(T, "make_lr", lambda c, n: Counting(make(c, n)))
    codes = [float(i) for i in range(len(prep.classes))]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        whole = T.grid_search(train, codes, grid=(1.0,), max_folds=2)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        split = T.grid_search(train, codes, grid=(1.0,), max_folds=2)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert parts == [1, 1, 1, 1] and split.scores == pytest.approx(whole.scores, rel=1e-6)


def test_fits_of_few_rows_share_the_cores():
    assert T.concurrent_fits(12, 1) == 12 and T.concurrent_fits(12, 2) == 6
    assert T.concurrent_fits(12, 40) == T.concurrent_fits(2, 1) == T.PARALLEL_FITS


def test_the_last_fit_of_a_search_does_not_run_alone(frame, spark, monkeypatch):
    """Five fits by four would take two rounds, the second with one fit; a given number is kept."""
    assert [T.full_rounds(f, 25) for f in (4, 6, 12, 24)] == [5, 7, 13, 25]
    assert [T.full_rounds(f, 25) for f in (1, 5, 10, 16, 30)] == [1, 5, 10, 16, 30]
    prep = T.prepare(frame, barrier="none")
    train = T.assemble(prep.train, prep.features)
    workers, pool = [], T.ThreadPoolExecutor
    monkeypatch.setattr(T, "concurrent_fits", lambda cores, parts: 4)
    monkeypatch.setattr(T, "ThreadPoolExecutor", lambda max_workers: workers.append(max_workers) or pool(max_workers))
    codes = [float(i) for i in range(len(prep.classes))]
    shared = T.grid_search(train, codes, grid=(1.0,))
    given = T.grid_search(train, codes, grid=(1.0,), parallelism=2)
    assert workers == [5, 2] and shared.scores == pytest.approx(given.scores, rel=1e-6)


def test_weighted_f1_is_the_reports_row_in_few_jobs(spark):
    """Also with missing labels, labels and predictions outside the classes, and a class without rows."""
    from sievekit.operators.evaluate import classification_report
    rows = [(float(i % 3), float(i * i % 4)) for i in range(50)] + [(None, 1.0)] * 4 + [(0.0, None)] * 3 + [(9.0, 2.0), (1.0, 9.0)]
    df = spark.createDataFrame(rows, "label double, prediction double").repartition(6)
    sc = spark.sparkContext
    for classes in ([0.0, 1.0, 2.0], [0.0, 1.0, 2.0, 3.0, 7.0], [5.0]):
        text = df.select(F.col("label").cast("string").alias("t"), F.col("prediction").cast("string").alias("p"))
        want = classification_report(text, "t", "p", [str(c) for c in classes]).where("label = 'weighted avg'").first()["f1_score"]
        group = f"weighted-{len(classes)}"
        try:
            sc.setJobGroup(group, group)
            got = T.weighted_f1(df, classes)
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        assert got == pytest.approx(want, abs=1e-12)
        assert len(sc.statusTracker().getJobIdsForGroup(group)) <= 4


def test_temporal_split_keeps_order(spark):
    df = spark.createDataFrame([(i, f"d{i:03d}") for i in range(50)], "i int, d string")
    out = M.temporal_split(df, ["d"]).toPandas().sort_values("d")
    assert out.is_test.sum() == 15 and not out.is_test.iloc[:35].any()


def test_split_and_folds_keep_rows_without_key_or_label(spark):
    rows = [(None if i % 3 == 0 else f"T{i}", None if i % 4 == 0 else "AB"[i % 2], float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "ticker string, target string, x double")
    for label in ("target", None):
        out = M.stratified_split(df, label).collect()
        assert sorted(r.x for r in out) == [float(i) for i in range(60)]
        if label:
            for c in ("A", "B", None):
                mine = [r for r in out if r.target == c]
                assert sum(r.is_test for r in mine) == round(0.3 * len(mine) + 1e-9)
    ranks = M.class_rank(df, "target").collect()
    assert len(ranks) == 60
    for c in ("A", "B", None):
        mine = sorted(r["_rank"] for r in ranks if r.target == c)
        assert mine == list(range(1, len(mine) + 1))


def test_no_training_rows_raise(spark):
    import pytest

    from sievekit.operators import model as T
    df = spark.createDataFrame([], "ticker string, sector string, x double, forward_return double, target string")
    with pytest.raises(ValueError):
        T.prepare(df, barrier="none")


def _split_rows(spark, n=400):
    return spark.createDataFrame([(f"t{i % 150}" if i % 9 else None, "abc"[i % 3] if i % 7 else None, float(i % 20))
                                  for i in range(n)], "ticker string, target string, v double").repartition(5)


@pytest.mark.parametrize("edge, digits", [(200_000, 4), (3, 1), (1, 2)])
def test_cuts_match_a_sort_at_every_bucket_size(spark, monkeypatch, edge, digits):
    """Quotas stay exact with repeated keys, and small buckets only search longer."""
    monkeypatch.setattr(M, "EDGE_ROWS", edge)
    df = _split_rows(spark)
    out = M.stratified_split(df, prefix_hex=digits).toPandas()
    want = df.toPandas().groupby("target", dropna=False).size()
    got = out[out.is_test].groupby("target", dropna=False).size()
    assert len(out) == 400
    for c, n in want.items():
        same = got[[g for g in got.index if g == c or (g is None or g != g) and (c is None or c != c)]]
        assert same.sum() == int(n * 0.3 + 0.5)
    ranks = M.class_rank(df.select("ticker", "target", "v"), "target").toPandas()
    folds = M.hash_folds(df, 7, "target", prefix_hex=digits).groupBy("target", "fold").count().toPandas()
    for c, part in folds.groupby("target", dropna=False):
        n = part["count"].sum()
        assert sorted(part["count"]) == sorted([n // 7 + (f < n % 7) for f in range(7)])
    assert len(ranks) == 400


def test_split_of_identical_rows(spark):
    """Rows equal throughout can't be told apart; the quota still holds."""
    df = spark.createDataFrame([("x", "a")] * 11 + [("y", "b")] * 3, "ticker string, target string").repartition(4)
    out = M.stratified_split(df).toPandas()
    assert out[out.is_test].groupby("target").size().to_dict() == {"a": 3, "b": 1}
    folds = M.hash_folds(df, 4, "target").toPandas()
    assert sorted(folds[folds.target == "a"].groupby("fold").size()) == [2, 3, 3, 3]


def test_split_of_an_empty_frame(spark):
    df = spark.createDataFrame([], "ticker string, target string, d int")
    assert M.stratified_split(df).count() == 0 and M.hash_folds(df, 5, "target").count() == 0
    assert M.temporal_split(df, ["d"]).count() == 0


def test_temporal_cut_with_nulls_and_ties(spark):
    rows = [(None, "a")] * 4 + [(i // 10, f"t{i % 4}" if i % 5 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "d int, t string").repartition(6)
    for frac in (0.0, 0.03, 0.31, 0.5, 0.77, 1.0):
        out = M.temporal_split(df, ["d", "t"], train_frac=frac).toPandas()
        k = int(len(rows) * frac + 0.5)
        train = sorted([(r.d == r.d, r.d if r.d == r.d else 0, r.t is not None, r.t or "") for r in out[~out.is_test].itertuples()])
        every = sorted([(d is not None, d or 0, t is not None, t or "") for d, t in rows])
        assert train == every[:k]


def test_dense_sums(spark):
    from sievekit.functions.ranks import dense_sums
    df = spark.createDataFrame([(f"k{i:03d}", i % 5) for i in range(100)], "k string, n int").repartition(7)
    got = {r.k: r.before for r in dense_sums(df, [F.col("k").asc()], "n", "before").collect()}
    assert got == {f"k{i:03d}": sum(j % 5 for j in range(i)) for i in range(100)}
