import os

import pytest
from pyspark.sql import functions as F

from sievekit.operators import model as T
from sievekit.operators.clean import fit_clean
from sievekit.operators.labels import quantile_label
from sievekit.operators.persist import load_screen, save_screen
from sievekit.operators.rules import STRICT, screen
from sievekit.session import materialize
from sievekit.sources.files import FUNDAMENTALS_SCHEMA, published, scratch_path
from sievekit.sources.fixtures import fundamentals
from sievekit.streaming.scoring import start_scoring
from tests.conftest import SF001


def test_streamed_raw_rows_get_the_batch_predictions(spark):
    """Raw rows arriving in files are scored as T5 scores the prepared ones; rows that
    can't be completed get no class and no probabilities, never a label."""
    raw = fundamentals(spark, SF001)
    clean, cleaner = fit_clean(raw)
    prep = T.prepare(screen(quantile_label(materialize(clean)), STRICT), cleaner=cleaner)
    model = T.train_screen_model(prep, tune=False)
    rows = raw.select(*[f.name for f in FUNDAMENTALS_SCHEMA.fields])
    src = scratch_path(spark, "incoming")
    # three arriving files
    for i in range(3):
        rows.where(F.abs(F.hash("ticker")) % 3 == i).write.mode("append").parquet(src)
    sink = os.path.join(scratch_path(spark, "scored"), "out")
    q = start_scoring(spark, model, src, sink, available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    got = spark.read.parquet(sink)
    assert got.count() == rows.count()
    want = model.predict(prep.test, keep=["ticker"])
    j = want.alias("w").join(got.alias("g"), "ticker")
    assert j.count() == prep.test.count()
    assert j.where("w.ml_pred_class <> g.ml_pred_class or g.ml_pred_class is null").count() == 0
    worst = j.agg(F.max(F.abs(F.col("g.ml_buy_proba") - F.col("w.ml_buy_proba")))).first()[0]
    assert worst == pytest.approx(0.0, abs=1e-9)
    assert got.where("isnan(ml_buy_proba)").count() == 0
    assert got.where("(ml_pred_class is null) <> (ml_buy_proba is null)").count() == 0


def test_saved_screen_scores_alike_batch_and_streamed(spark, tmp_path):
    """Save, load in another session, score; a failed later save leaves the saved screen."""
    raw = fundamentals(spark, SF001)
    clean, cleaner = fit_clean(raw)
    prep = T.prepare(screen(quantile_label(materialize(clean)), STRICT), cleaner=cleaner)
    model = T.train_screen_model(prep, tune=False)
    model.grid = T.GridResult(0.1, {0.01: 0.25, 0.1: 1 / 3}, 5, "")
    path = str(tmp_path / "screen")
    first = save_screen(model, path)
    back = load_screen(spark.newSession(), path)
    assert (back.categories, back.features, back.classes, back.best_c) == (model.categories, model.features, model.classes, model.best_c)
    assert back.grid == model.grid and back.cleaner.bounds == cleaner.bounds and back.cleaner.max_de == cleaner.max_de
    assert back.cleaner.overall == cleaner.overall
    assert back.model.coefficientMatrix == model.model.coefficientMatrix
    rows = raw.select(*[f.name for f in FUNDAMENTALS_SCHEMA.fields])
    want = sorted(map(tuple, model.score(rows, keep=["ticker"]).collect()))
    assert sorted(map(tuple, load_screen(spark, path).score(rows, keep=["ticker"]).collect())) == want

    broken = T.ScreenModel(**{**vars(model), "model": None})
    with pytest.raises(AttributeError):
        save_screen(broken, path)
    assert published(spark, path) == first

    src, sink = scratch_path(spark, "incoming"), os.path.join(scratch_path(spark, "scored"), "out")
    rows.write.parquet(src)
    q = start_scoring(spark, path, src, sink, available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    got = sorted(tuple(r) for r in spark.read.parquet(sink).select("ticker", "ml_pred_class", *[f"ml_{c.lower()}_proba" for c in model.classes]).collect())
    assert got == want
