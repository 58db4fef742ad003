"""The probabilistic screen (T1-T8): multinomial logistic regression.

Spark ML's L-BFGS minimises  mean(loss) + regParam/2 * ||W||^2  with the
intercepts unpenalised; the reference objective is  C * sum(loss) +
1/2 * ||W||^2.  Dividing by C*n shows they coincide for
``regParam = 1 / (C * n)``, where n is the number of rows in *that* fit
(so every CV fold and the final refit get their own regParam).
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import IllegalArgumentException
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..functions.nulls import bounded_distinct
from ..session import materialize
from .clean import ENGINEERED, FittedCleaner
from .evaluate import label_counts
from .features import (Scaler, feature_list, fit_categories, fit_scaler, hash_folds,
                       label_decode, label_index, one_hot, stratified_split)

# Rows per partition of a training matrix: L-BFGS runs one aggregation job
# per iteration, so tiny partitions only add scheduling overhead.
ROWS_PER_PARTITION = 200_000
# The same for a fit of a grid search, which shares the cores with other fits: with one
# partition its iterations need no second stage to merge partial sums.
FOLD_ROWS_PER_PARTITION = 1_000_000

# The regularisation grid, folds and solver cap.
C_GRID = (0.01, 0.1, 1.0, 10.0, 100.0)
DEFAULT_C = 1.0
MAX_FOLDS = 5
MAX_ITER = 1000


def make_lr(c: float, n: int, max_iter: int = MAX_ITER) -> LogisticRegression:
    """Multinomial, L2, no internal standardization, regParam = 1/(C n)."""
    return LogisticRegression(featuresCol="features", labelCol="label", family="multinomial",
                              elasticNetParam=0.0, regParam=1.0 / (c * max(n, 1)),
                              standardization=False, fitIntercept=True, maxIter=max_iter,
                              tol=1e-6)


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features",
                           handleInvalid="keep").transform(df)


def assign_folds(df: DataFrame, k: int, label: str = "label", key: str = "ticker",
                 seed: int = 42, out: str = "fold") -> DataFrame:
    """Stratified folds 0..k-1: each takes floor/ceil of its share of every class,
    cut in md5 order (:func:`hash_folds`; rows are neither sorted nor shuffled)."""
    return hash_folds(df, k, label, key, seed, out=out)


def weighted_f1(pred: DataFrame, classes: Sequence[float]) -> float:
    """Weighted F1 of integer-coded predictions, the value of the ``weighted avg`` row of
    :func:`classification_report`.  One grouping counts per class; its row per class is summed here."""
    rows = label_counts(pred.select(F.col("label").cast("string").alias("t"),
                                    F.col("prediction").cast("string").alias("p")), "t", "p").collect()
    counts = {r["_l"]: r for r in rows}
    total, weighted = 0, 0.0
    for r in (counts[str(c)] for c in classes if str(c) in counts):
        precision = r["tp"] / r["predicted"] if r["predicted"] else 0.0
        recall = r["tp"] / r["support"] if r["support"] else 0.0
        total += r["support"]
        weighted += 2 * precision * recall / (precision + recall) * r["support"] if precision + recall else 0.0
    return weighted / total if total else 0.0


@dataclass
class GridResult:
    best_c: float
    scores: dict[float, float] = field(default_factory=dict)
    folds: int = 0
    reason: str = ""                     # why the default C was taken, if it was


# Fits of a grid search that run at a time: each caches the blocks of the folds it trains on.
# With fewer partitions a fit than cores, as many more run as the cores hold.
PARALLEL_FITS = 4

# Bytes of a row group of the folded rows: small ones let the partitions read from a file be equal.
FOLD_ROW_GROUP = 4 << 20


def concurrent_fits(cores: int, parts: int) -> int:
    """Fits at a time: a fit has ``parts`` tasks, so fits of few rows share the cores.
    The rows held stay under cores x FOLD_ROWS_PER_PARTITION, or those of PARALLEL_FITS fits."""
    return max(PARALLEL_FITS, cores // max(parts, 1))


def full_rounds(fits: int, jobs: int) -> int:
    """``fits`` at a time, or a few more where the last of the ``jobs`` would leave over half of a round
    idle: 25 by 12 would end with one fit on its own, 13 at a time need no third round."""
    rounds, rest = divmod(jobs, fits)
    return fits - (-rest // rounds) if rounds and 2 * rest < fits else fits


def grid_search(train: DataFrame, classes: Sequence[float], grid: Sequence[float] = C_GRID,
                max_folds: int = MAX_FOLDS, parallelism: int | None = None) -> GridResult:
    """Mean weighted F1 over stratified folds for each C; the first
    best C wins (smallest on ties).  Fewer than 5 rows -> C=1.0.  The fits
    are independent Spark jobs submitted from a small driver thread pool, ``parallelism``
    at a time (by default :func:`concurrent_fits` in :func:`full_rounds`).  The folded rows are written once; a fit
    reads them in one partition per ``FOLD_ROWS_PER_PARTITION`` rows, however many splits the
    files have: L-BFGS runs a task per partition in every iteration.  It caches the blocks it trains
    on (Spark ML's own copy), and nothing else is held in memory.
    """
    n = train.count()
    if n < 5:
        return GridResult(DEFAULT_C, {}, 0, "fewer than 5 training rows")
    k = min(max_folds, n)
    folded = assign_folds(train, k)
    parts = max(1, -(-n // FOLD_ROWS_PER_PARTITION))
    folded = folded.repartition(max(1, -(-n // ROWS_PER_PARTITION)))
    folded = materialize(folded, row_group=FOLD_ROW_GROUP).coalesce(parts)
    cores = train.sparkSession.sparkContext.defaultParallelism
    fits = parallelism or full_rounds(concurrent_fits(cores, parts), len(grid) * k)
    sizes = {r["fold"]: r["n"] for r in folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}

    def fit_score(args):
        c, f = args
        tr = folded.where(F.col("fold") != f)
        va = folded.where(F.col("fold") == f)
        m = make_lr(c, n - sizes.get(f, 0)).fit(tr)
        return c, f, weighted_f1(m.transform(va), classes)

    jobs = [(c, f) for c in grid for f in range(k)]
    try:
        with ThreadPoolExecutor(max_workers=max(1, min(fits, len(jobs)))) as pool:
            results = list(pool.map(fit_score, jobs))
    except (IllegalArgumentException, ValueError, ArithmeticError) as e:
        # the data can't be fitted (a fold with one class, say); a lost executor
        # or a lack of memory raises
        return GridResult(DEFAULT_C, {}, k, f"{type(e).__name__}: {e}"[:500])
    scores = {c: sum(s for cc, _, s in results if cc == c) / k for c in grid}
    best = max(grid, key=lambda c: (scores[c], -grid.index(c)))
    return GridResult(best, scores, k)


@dataclass
class ScreenModel:
    """Everything needed to score new rows: the fitted category list,
    feature order, scaler, class names and the Spark model."""
    categories: list[str]
    features: list[str]
    scaler: Scaler
    classes: list[str]
    model: LogisticRegressionModel
    best_c: float
    grid: GridResult | None = None
    cleaner: FittedCleaner | None = None

    # T5 / T8 ---------------------------------------------------------------
    def score(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Score raw rows.  Impute, winsorize and engineer with the fitted
        statistics (unless the rows hold the engineered ratios already), encode
        with the fitted list, scale with train statistics, predict; adds
        ``ml_pred_class`` and one ``ml_<class>_proba`` column per class.  A row
        with a feature that stays NULL gets a NULL class and NULL probabilities;
        only a sector dummy absent from the rows counts as 0."""
        if self.cleaner is not None and not all(c in df.columns for c in ENGINEERED):
            df = self.cleaner.transform(df)
        raw = df if "sector" in df.columns else df.withColumn("sector", F.lit(None).cast("string"))
        x = one_hot(raw.drop(*[c for c in raw.columns if c in self.features and c.startswith("sector_")]),
                    self.categories)
        x = x.select(*[c for c in x.columns if c not in self.features],
                     *[(F.col(c) if c in x.columns else F.lit(0.0 if c.startswith("sector_") else None))
                       .cast(DoubleType()).alias(c) for c in self.features])
        return self.predict(self.scaler.transform(x), keep)

    def predict(self, prepared: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """T5: predictions for rows already encoded and scaled (M1-M6)."""
        p = self.model.transform(assemble(prepared, self.features))
        prob = vector_to_array("probability")
        whole = reduce(lambda a, b: a & b, [F.coalesce(~F.isnan(F.col(f)), F.lit(False)) for f in self.features],
                       F.lit(True))
        extra = [F.when(whole, F.element_at(prob, i + 1)).alias(f"ml_{c.lower()}_proba")
                 for i, c in enumerate(self.classes)]
        cols = [c for c in keep if c in p.columns]
        return p.select(*cols, F.when(whole, label_decode(F.col("prediction"), self.classes)).alias("ml_pred_class"),
                        *extra)

    # T6 / T7 ---------------------------------------------------------------
    def coefficients(self, spark: SparkSession) -> DataFrame:
        """(class, feature, coefficient) plus ('Intercept') rows per class."""
        m = self.model.coefficientMatrix.toArray()
        b = self.model.interceptVector.toArray()
        rows = [(cls, f, float(m[i][j])) for i, cls in enumerate(self.classes)
                for j, f in enumerate(self.features)]
        rows += [(cls, "Intercept", float(b[i])) for i, cls in enumerate(self.classes)]
        schema = StructType([StructField("class", StringType()), StructField("feature", StringType()),
                             StructField("coefficient", DoubleType())])
        return spark.createDataFrame(rows, schema)

    def class_coefficients(self, spark: SparkSession, cls: str = "Buy") -> DataFrame:
        """One class's feature coefficients, largest first."""
        return (self.coefficients(spark)
                .where((F.col("class") == cls) & (F.col("feature") != "Intercept"))
                .orderBy(F.desc("coefficient"), "feature"))


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    features: list[str]
    categories: list[str]
    classes: list[str]
    scaler: Scaler
    cleaner: FittedCleaner | None = None


def prepare(df: DataFrame, label: str = "target", test_frac: float = 0.30, seed: int = 42,
            barrier: str = "checkpoint", cleaner: FittedCleaner | None = None) -> Prepared:
    """M1-M7: encode, split (stratified when >= 2 classes), fit the scaler on
    train, scale both sides, index the label.  A frame without a labelled row
    raises ValueError: there is nothing to learn from."""
    classes = bounded_distinct(df, label)
    if not classes:
        raise ValueError("no labelled rows to train on")
    cats = fit_categories(df)
    enc = one_hot(df if "sector" in df.columns else df.withColumn("sector", F.lit(None).cast("string")),
                  cats)
    text = [f.name for f in enc.schema.fields if isinstance(f.dataType, StringType)]
    feats = feature_list(enc, text=text)
    enc = enc.select(*[F.col(c).cast(DoubleType()).alias(c) if c in feats else F.col(c)
                       for c in enc.columns])
    split = stratified_split(enc, label if len(classes) >= 2 else None, test_frac=test_frac,
                             seed=seed)
    split = materialize(label_index(split, classes, label), barrier)
    train = split.where(~F.col("is_test"))
    test = split.where(F.col("is_test"))
    scaler = fit_scaler(train, feats)
    return Prepared(scaler.transform(train), scaler.transform(test), feats, cats, classes, scaler, cleaner)


def train_screen_model(prep: Prepared, grid: Sequence[float] = C_GRID, tune: bool = True,
                       parallelism: int | None = None) -> ScreenModel:
    """Tune C by stratified CV (optional), refit on all train rows."""
    train = assemble(prep.train, prep.features)
    n = train.count()
    if n == 0:
        raise ValueError("no training rows")
    train = materialize(train.repartition(max(1, -(-n // ROWS_PER_PARTITION))), "persist")
    codes = [float(i) for i in range(len(prep.classes))]
    res = grid_search(train, codes, grid, parallelism=parallelism) if tune else GridResult(DEFAULT_C)
    model = make_lr(res.best_c, n).fit(train)
    train.unpersist()
    return ScreenModel(prep.categories, prep.features, prep.scaler, prep.classes, model,
                       res.best_c, res, prep.cleaner)
