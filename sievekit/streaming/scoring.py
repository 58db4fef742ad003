"""Scoring new records as they arrive (Structured Streaming).

The batch workflow fits everything once (category list, scaler, model) and may
save it (``operators.persist``);
scoring a new record is then a stateless row transform -- rule signal with
distances plus model class and probabilities -- so it runs unchanged on a
streaming DataFrame.  No state store is needed: there is no aggregation
across records, and the fitted values are literals in the plan.

File sources/sinks with a checkpoint location give exactly-once output
across restarts and executor loss; the checkpoint lives under the
session's shared ``spark.checkpoint.dir`` unless a location is given.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.nulls import nan_to_null
from ..operators.model import ScreenModel
from ..operators.persist import load_screen
from ..operators.rules import INCLUSIVE, Rulebook, screen_with_distances
from ..sources.files import FUNDAMENTALS_SCHEMA, scratch_path

KEEP = ("ticker", "PE_ratio", "ROE", "DE_ratio", "revenue_growth", "profit_margin",
        "signal_rules", "min_distance_to_buy_threshold")


def score_frame(model: ScreenModel, rows: DataFrame, rulebook: Rulebook = INCLUSIVE) -> DataFrame:
    """Rule signal + model scores for raw rows (batch or streaming)."""
    base = nan_to_null(rows)
    screened = screen_with_distances(base, rulebook)
    return model.score(screened, keep=[c for c in KEEP if c in screened.columns])


def read_new_records(spark: SparkSession, path: str, schema: StructType = FUNDAMENTALS_SCHEMA,
                     fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming source of raw cross-section rows (declared schema)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        r = r.option("header", True)
    return r.load(path)


def start_scoring(spark: SparkSession, model: ScreenModel | str, source: str, sink: str,
                  checkpoint: str | None = None, schema: StructType = FUNDAMENTALS_SCHEMA,
                  fmt: str = "parquet", available_now: bool = False,
                  rulebook: Rulebook = INCLUSIVE) -> StreamingQuery:
    """Continuously score files landing in ``source`` into parquet at ``sink``, with a
    fitted model or the folder of a saved one (its newest version when the query starts)."""
    if isinstance(model, str):
        model = load_screen(spark, model)
    checkpoint = checkpoint or scratch_path(spark, "scoring-checkpoint")
    scored = score_frame(model, read_new_records(spark, source, schema, fmt), rulebook)
    w = (scored.writeStream.format("parquet").outputMode("append")
               .option("path", sink).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def sink_path(spark: SparkSession, name: str = "scores") -> str:
    return os.path.join(scratch_path(spark, name), "out")
