"""The fitted screen on disk (T5, T8): save in one session, score in another.

A saved screen is a published folder (``sources.files.publish``) with four parts:
``state`` (one JSON text: feature order, categories, classes, chosen C with its grid, overall
medians, winsor bounds, largest D/E), ``scaler`` (Parquet, one row of train means and
deviations), ``medians`` (Parquet, one row per sector; only with a fitted cleaner) and
``classifier`` (Spark ML's own format).  Doubles keep every bit, so scores are those of
the model that was saved.
"""

from __future__ import annotations

import json

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession

from ..sources.files import publish, published
from .clean import FittedCleaner
from .features import Scaler
from .model import GridResult, ScreenModel

FORMAT = 1


def _state(model: ScreenModel) -> dict:
    grid, cleaner = model.grid, model.cleaner
    return {
        "format": FORMAT, "categories": model.categories, "features": model.features, "classes": model.classes,
        "best_c": model.best_c, "scaled": model.scaler.columns,
        # pairs, as JSON objects have text keys
        "grid": grid and {"best_c": grid.best_c, "scores": list(grid.scores.items()), "folds": grid.folds, "reason": grid.reason},
        "cleaner": cleaner and {"columns": cleaner.columns, "overall": cleaner.overall, "max_de": cleaner.max_de,
                                "bounds": cleaner.bounds, "medians": cleaner.medians is not None},
    }


def save_screen(model: ScreenModel, path: str) -> str:
    """Write ``model`` as a new version of ``path``; a reader sees the former one until
    this one is whole.  Returns the version's folder."""
    spark = model.scaler.stats.sparkSession

    def write(folder: str) -> None:
        text = json.dumps(_state(model))
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{folder}/state")
        model.scaler.stats.coalesce(1).write.parquet(f"{folder}/scaler")
        if model.cleaner is not None and model.cleaner.medians is not None:
            model.cleaner.medians.write.parquet(f"{folder}/medians")
        model.model.write().save(f"{folder}/classifier")

    return publish(spark, path, write)


def load_screen(spark: SparkSession, path: str) -> ScreenModel:
    """The newest saved screen below ``path`` (or a version's own folder), for frames of ``spark``."""
    folder = published(spark, path)
    state = json.loads(spark.read.option("wholetext", True).text(f"{folder}/state").first()[0])
    if state["format"] != FORMAT:
        raise ValueError(f"saved in format {state['format']}, this library reads {FORMAT}")
    scaler = Scaler(state["scaled"], spark.read.parquet(f"{folder}/scaler"))
    grid, c = state["grid"], state["cleaner"]
    cleaner = None
    if c is not None:
        medians: DataFrame | None = spark.read.parquet(f"{folder}/medians") if c["medians"] else None
        cleaner = FittedCleaner(c["columns"], medians, c["overall"], {k: tuple(v) for k, v in c["bounds"].items()}, c["max_de"])
    return ScreenModel(state["categories"], state["features"], scaler, state["classes"],
                       LogisticRegressionModel.load(f"{folder}/classifier"), state["best_c"],
                       grid and GridResult(grid["best_c"], dict(map(tuple, grid["scores"])), grid["folds"], grid["reason"]), cleaner)
