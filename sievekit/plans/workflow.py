"""End-to-end chains (the batch entry point and its stages).

Stage order mirrors the original workflow: ingest -> clean/engineer ->
label -> rule screen -> (prepare -> tune/train -> evaluate).  Everything up
to the signal column is a single lazy plan with lineage cuts only where a
statistic pass re-reads its input.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate as V
from ..operators import model as T
from ..operators.clean import CleanConfig, clean_and_engineer, fit_clean
from ..operators.labels import BATCH_POLICY, LabelPolicy, quantile_label
from ..operators.rules import INCLUSIVE, STRICT, Rulebook, screen, screen_with_distances
from ..session import materialize
from ..sources.fixtures import fundamentals


def cleaned(spark: SparkSession, sf_dir: str, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """fundamentals -> C1..C12: a projection of the chain's one written barrier."""
    return clean_and_engineer(fundamentals(spark, sf_dir), cfg)


def labelled(spark: SparkSession, sf_dir: str, policy: LabelPolicy = BATCH_POLICY,
             cfg: CleanConfig = CleanConfig()) -> DataFrame:
    # written once: the label statistic reads it, and so do those who use the labels
    clean = materialize(cleaned(spark, sf_dir, cfg), cfg.barrier)
    return quantile_label(clean, policy, method=cfg.quantile_method)


def screened(spark: SparkSession, sf_dir: str, rulebook: Rulebook = STRICT,
             policy: LabelPolicy = BATCH_POLICY, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    return screen(labelled(spark, sf_dir, policy, cfg), rulebook)


def signal_returns(df: DataFrame, signal: str = "signal_rules",
                   outcome: str = "forward_return") -> DataFrame:
    """What did each signal bucket earn?  One row per signal value."""
    return (df.groupBy(signal)
              .agg(F.count(F.lit(1)).alias("n_names"),
                   F.avg(outcome).alias("avg_forward_return"),
                   F.count(F.when(F.col("target") == F.col(signal), F.lit(1))).alias("n_agree")))


# ----------------------------------------------------------------- Entry A

@dataclass
class Evaluation:
    """The evaluation tables of scored rows, for every signal column that is compared.

    ``pred`` holds the true label, the outcome, the signals and one probability
    column a class (``ml_<class>_proba``).  Each table reads ``pred`` anew, so it
    should be a written frame.  A class without rows keeps its zero rows in the
    confusion and the report, and has no curve and no box.
    """

    pred: DataFrame
    classes: Sequence[str]
    signals: Sequence[str] = ("signal_rules", "ml_pred_class")
    true: str = "target"
    outcome: str = "forward_return"

    def _per_method(self, table: Callable[[str], DataFrame]) -> DataFrame:
        out = None
        for m in self.signals:
            part = table(m).select(F.lit(m).alias("method"), "*")
            out = part if out is None else out.unionByName(part)
        return out

    @property
    def _proba(self) -> dict[str, str]:
        return {c: f"ml_{c.lower()}_proba" for c in self.classes}

    def confusion(self) -> DataFrame:
        return self._per_method(lambda m: V.confusion(self.pred, self.true, m, self.classes))

    def report(self) -> DataFrame:
        return self._per_method(lambda m: V.classification_report(self.pred, self.true, m, self.classes))

    def sizes(self) -> DataFrame:
        """Sizes of the Buy and Sell buckets, the two costly errors and the spread, a row per method."""
        spreads = self._per_method(lambda m: self.pred.agg(V.spread(m, self.outcome).alias("spread")))
        return (V.bucket_sizes(self.pred, self.signals).join(V.high_stakes_errors(self.pred, self.true, self.signals), "method")
                .join(spreads, "method"))

    def box(self) -> DataFrame:
        return V.box_stats(self.pred, self.signals, self.outcome)

    def roc(self) -> DataFrame:
        return V.roc_table(self.pred, self.true, self._proba)

    def auc(self) -> DataFrame:
        return V.auc_table(self.pred, self.true, self._proba)

    def ic(self) -> DataFrame:
        return V.information_coefficient(self.pred, self._proba[V.BUY], self.outcome)


@dataclass
class AnalysisResult:
    model: "T.ScreenModel"
    prepared: "T.Prepared"
    predictions: DataFrame        # test rows: ids, labels, rule signal, ML class + probabilities
    metrics: DataFrame            # V14 comparison table

    def evaluation(self) -> Evaluation:
        """All evaluation tables of the held-out rows, rules and fitted model side by side."""
        return Evaluation(self.predictions, self.prepared.classes)


def main_analysis(spark: SparkSession, sf_dir: str, tune: bool = True,
                  cfg: CleanConfig = CleanConfig(), distances: bool = False) -> AnalysisResult:
    """The batch workflow end to end: ingest -> clean -> label -> screen ->
    prepare -> tune/train -> evaluate rules vs model on the test rows.
    ``distances`` takes the interactive variant: the inclusive rulebook, whose
    distance columns then are features as well."""
    clean, cleaner = fit_clean(fundamentals(spark, sf_dir), cfg)
    clean = materialize(clean, cfg.barrier)
    if clean.isEmpty():
        raise ValueError("cleaning left no rows to analyse")
    df = quantile_label(clean, BATCH_POLICY, method=cfg.quantile_method)
    df = screen_with_distances(df, INCLUSIVE) if distances else screen(df, STRICT)
    prep = T.prepare(df, barrier=cfg.barrier, cleaner=cleaner)
    model = T.train_screen_model(prep, tune=tune)
    pred = materialize(model.predict(prep.test, keep=["ticker", "forward_return", "target",
                                                      "signal_rules"]), cfg.barrier)
    metrics = V.comparison_table(pred, classes=prep.classes)
    return AnalysisResult(model, prep, pred, metrics)
