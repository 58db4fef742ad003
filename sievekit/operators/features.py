"""ML preparation (M1-M8): encoding, splits, train-fitted scaling.

Fitted state is small and explicit: the sorted category list (a handful
of sectors) and a one-row frame of feature means/standard deviations.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, DoubleType

from ..functions.nulls import MAX_LABELS, bounded_distinct
from ..functions.ranks import dense_sums
from ..functions.stats import scalars

# Identifier and label columns that are never features.
ID_AND_LABELS = ("ticker", "forward_return", "target", "signal_rules")
LABEL_ORDER = "alphabetAsc"


# --------------------------------------------------------------------- M1/M2
def fit_categories(df: DataFrame, col: str = "sector", missing: str = "Unknown",
                   limit: int = MAX_LABELS) -> list[str]:
    """Sorted distinct categories (the fitted list; more than ``limit`` raise)."""
    if col not in df.columns:
        return [missing]
    return bounded_distinct(df.select(F.coalesce(F.col(col), F.lit(missing)).alias("c")), "c", limit)


def one_hot(df: DataFrame, categories: Sequence[str], col: str = "sector",
            missing: str = "Unknown", prefix: str | None = None) -> DataFrame:
    """M1: integer dummies for every fitted category but the first (the
    dropped baseline), replacing ``col``; an absent ``col`` counts as
    ``missing``.  Unseen categories encode as all zeros (the baseline)."""
    prefix = prefix if prefix is not None else f"{col}_"
    value = F.coalesce(F.col(col), F.lit(missing)) if col in df.columns else F.lit(missing)
    dummies = [F.when(value == c, F.lit(1)).otherwise(F.lit(0)).alias(f"{prefix}{c}")
               for c in list(categories)[1:]]
    keep = [c for c in df.columns if c != col]
    return df.select(*keep, *dummies)


def feature_list(df: DataFrame, exclude: Sequence[str] = ID_AND_LABELS,
                 text: Sequence[str] = ()) -> list[str]:
    """M2: every column except ids/labels (and text columns), in frame order
    -- dummies, appended last by :func:`one_hot`, stay last."""
    return [c for c in df.columns if c not in exclude and c not in text]


# --------------------------------------------------------------------- M3
def label_index(df: DataFrame, classes: Sequence[str], col: str = "target",
                out: str = "label") -> DataFrame:
    """M3: alphabetical class codes (Buy=0, Hold=1, Sell=2) as double."""
    expr = F.lit(None).cast(DoubleType())
    for i, c in enumerate(sorted(classes)):
        expr = F.when(F.col(col) == c, F.lit(float(i))).otherwise(expr)
    return df.withColumn(out, expr)


def label_decode(col, classes: Sequence[str]):
    """M3: code -> class name."""
    arr = F.array(*[F.lit(c) for c in sorted(classes)])
    return F.element_at(arr, col.cast("int") + 1)


# --------------------------------------------------------------------- M4/M5
def split_hash(key: str = "ticker", seed: int = 42, others: Sequence[str] = ()):
    """The deterministic shuffle key: md5 of the key text and the seed.

    A NULL key takes a hash of the row's ``others`` instead, so keyless rows
    spread over the hash buckets and none is lost."""
    text = F.col(key).cast("string")
    if others:
        text = F.coalesce(text, F.xxhash64(*[F.col(c) for c in others]).cast("string"))
    return F.md5(F.concat(F.coalesce(text, F.lit("")), F.lit(str(seed))))


def _hashed(df: DataFrame, label: str | None, key: str, seed: int) -> DataFrame:
    """Rows with class ``_c`` and order ``_h``: 32 hex digits of the shuffle key, then
    16 of the row's other columns, so rows tie only when they are equal throughout."""
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType)]
    tail = F.lpad(F.hex(F.xxhash64(*[F.col(c) for c in plain] or [F.lit(0)])), 16, "0")
    # without a label one class, as a value the joins on it can hash
    return (df.withColumn("_h", F.concat(split_hash(key, seed, plain), tail))
              .withColumn("_c", F.col(label).cast("string") if label else F.substring("_h", 1, 0)))


# Hex digits of ``_h``, and the most rows of a hash bucket that one window orders.
HASH_DIGITS = 48
EDGE_ROWS = 200_000


def _edges(counts: DataFrame, wanted: DataFrame | None, targets: str | None) -> list:
    """The buckets (rows ``_c, _p, _nb``) that hold the wanted ranks: (_c, _j, _t, _p, _before, _nb).

    The windows run over bucket counts: 16^digits rows a class or searched bucket."""
    part = ["_c"] if wanted is None else ["_c", "_q"]
    whole = Window.partitionBy(*part)
    run = whole.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    per = counts.withColumn("_before", F.coalesce(F.sum("_nb").over(run), F.lit(0)))
    if wanted is None:
        per = (per.withColumn("n", F.sum("_nb").over(whole))
                  .select("_c", "_p", "_nb", "_before", F.posexplode(F.expr(targets)).alias("_j", "_t")))
    else:
        w = wanted.select(F.col("_c").alias("_c2"), F.col("_p").alias("_q2"), "_j", "_t", F.col("_before").alias("_b0"))
        per = (per.join(F.broadcast(w), per["_c"].eqNullSafe(w["_c2"]) & (per["_q"] == w["_q2"]))
                  .withColumn("_before", F.col("_before") + F.col("_b0")))
    return (per.where("_t > _before AND _t <= _before + _nb")
               .select("_c", "_j", "_t", "_p", "_before", "_nb").collect())


_EDGE = "_c string, _j int, _t long, _p string, _before long, _nb long"


def hash_cuts(base: DataFrame, targets: str, prefix_hex: int = 4) -> list:
    """The rows at given ranks of every class in ``_h`` order, without sorting: (_c, _j, cut, take, ties).

    ``targets`` is SQL for the array of wanted 1-based ranks given the class size ``n``; a rank of 0
    has no row.  Counts per hash prefix name the bucket a rank falls in; a bucket of over ``EDGE_ROWS``
    rows is searched by ``prefix_hex`` more digits, others by one ordered window.  ``take`` of the ``ties``
    rows equal to ``cut`` lie at or before the rank.  The lists collected have a row per class and rank."""
    spark = base.sparkSession
    counts = base.groupBy("_c", F.substring("_h", 1, prefix_hex).alias("_p")).agg(F.count(F.lit(1)).alias("_nb"))
    edges, found, digits = _edges(counts, None, targets), [], prefix_hex
    while True:
        small = [e for e in edges if e["_nb"] <= EDGE_ROWS or digits >= HASH_DIGITS]
        if small:
            e = spark.createDataFrame(small, _EDGE).withColumnsRenamed({"_c": "_c2"})
            near = base.select("_c", "_h").join(F.broadcast(e), base["_c"].eqNullSafe(e["_c2"]) & F.startswith("_h", "_p"))
            order = Window.partitionBy("_c", "_j").orderBy("_h")
            near = (near.groupBy("_c", "_j", "_t", "_before", "_h").agg(F.count(F.lit(1)).alias("ties"))
                        .withColumn("_reach", F.col("_before") + F.sum("ties").over(order)))
            found += (near.where("_t <= _reach AND _t > _reach - ties")
                          .select("_c", "_j", F.col("_h").alias("cut"), F.expr("_t - _reach + ties").alias("take"), "ties").collect())
        edges = [e for e in edges if e not in small]
        if not edges:
            return found
        e = spark.createDataFrame(edges, _EDGE)
        q = e.select(F.col("_c").alias("_c2"), F.col("_p").alias("_q")).distinct()
        inside = base.select("_c", "_h").join(F.broadcast(q), base["_c"].eqNullSafe(q["_c2"])
                                              & (F.substring("_h", 1, digits) == F.col("_q")))
        digits = min(digits + prefix_hex, HASH_DIGITS)
        counts = inside.groupBy("_c", "_q", F.substring("_h", 1, digits).alias("_p")).agg(F.count(F.lit(1)).alias("_nb"))
        edges = _edges(counts, e, None)


def _dealt(df: DataFrame, label: str | None, key: str, seed: int, prefix_hex: int, targets: str, parts: int, out: str) -> DataFrame:
    """``df`` with ``out`` = number of cuts before the row (0 .. parts - 1) within its class.

    A filter by a broadcast row per class; only rows equal throughout to a cut that falls
    between equal rows are numbered by a window."""
    base = _hashed(df, label, key, seed)
    found = hash_cuts(base, targets, prefix_hex)
    cuts: dict = {}
    for r in found:
        cuts.setdefault(r["_c"], [("", 0)] * (parts - 1))[r["_j"]] = (r["cut"], r["take"])
    spark = df.sparkSession
    table = spark.createDataFrame([(c, v) for c, v in cuts.items()], "_c2 string, _cuts array<struct<cut:string,take:long>>")
    j = base.join(F.broadcast(table), base["_c"].eqNullSafe(table["_c2"]), "left")
    none = ", ".join(["struct('' AS cut, 0L AS take)"] * (parts - 1))
    j = j.withColumn("_cuts", F.expr(f"coalesce(_cuts, array({none}))"))
    before = "size(filter(_cuts, z -> z.cut < _h OR (z.cut = _h AND z.take < {n})))"
    columns = [*df.columns, out]
    if all(r["take"] == r["ties"] for r in found):
        return j.withColumn(out, F.expr(before.format(n="0L"))).select(*columns)
    tied = F.expr("exists(_cuts, z -> z.cut = _h)")
    numbered = j.where(tied).withColumn("_rn", F.row_number().over(Window.partitionBy("_c", "_h").orderBy("_h")))
    return (j.where(~tied).withColumn(out, F.expr(before.format(n="0L"))).select(*columns)
            .unionByName(numbered.withColumn(out, F.expr(before.format(n="_rn"))).select(*columns)))


def stratified_split(df: DataFrame, label: str | None = "target", key: str = "ticker",
                     test_frac: float = 0.30, seed: int = 42, prefix_hex: int = 4,
                     out: str = "is_test") -> DataFrame:
    """M4 (M5 with ``label=None``): exactly round(test_frac * n_class) rows
    of each class go to test -- those first in md5(key || seed) order.

    Every input row comes out once, also with a NULL key or label (NULL labels
    are one class).  Nothing is sorted or shuffled but counts: the last test row of
    each class is found by :func:`hash_cuts`, and the split is a comparison with it.
    """
    rank = f"array(CAST(round(CAST(n AS DOUBLE) * {float(test_frac)!r}D) AS BIGINT))"
    return _dealt(df, label, key, seed, prefix_hex, rank, 2, out).withColumn(out, F.col(out) == 0)


def hash_folds(df: DataFrame, k: int, label: str | None = "label", key: str = "ticker", seed: int = 42,
               prefix_hex: int = 4, out: str = "fold") -> DataFrame:
    """Folds 0 .. k - 1 of equal share (the first n % k hold a row more) within each class,
    by k - 1 cuts in md5(key || seed) order; a filter like :func:`stratified_split`."""
    ranks = f"transform(sequence(1L, {k - 1}L), f -> f * (n div {k}) + least(f, n % {k}))" if k > 1 else "array()"
    return _dealt(df, label, key, seed, prefix_hex, ranks, k, out) if k > 1 else df.withColumn(out, F.lit(0))


def class_rank(df: DataFrame, label: str | None = "target", key: str = "ticker",
               seed: int = 42, prefix_hex: int = 4, out: str = "_rank") -> DataFrame:
    """1-based rank of every row within its class in md5(key || seed) order,
    computed as (rows in earlier hash buckets) + (rank inside the bucket):
    the ordered windows run per (class, bucket), never per whole class.  No
    row is lost to a NULL key or label.  The bucket table has at most classes x
    16^prefix_hex rows, classes being a list whose length callers have bounded."""
    base = _hashed(df, label, key, seed).withColumn("_b", F.substring("_h", 1, prefix_hex))
    run = Window.partitionBy("_c").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (base.groupBy("_c", "_b").agg(F.count(F.lit(1)).alias("_nb"))
               .select(F.col("_c").alias("_c2"), F.col("_b").alias("_b2"), F.coalesce(F.sum("_nb").over(run), F.lit(0)).alias("_before")))
    rn = F.row_number().over(Window.partitionBy("_c", "_b").orderBy("_h"))
    j = base.join(F.broadcast(buckets), (base["_b"] == buckets["_b2"]) & base["_c"].eqNullSafe(buckets["_c2"]))
    return j.select(*df.columns, (F.col("_before") + rn).alias(out))


def temporal_split(df: DataFrame, order_by: Sequence[str], train_frac: float = 0.70,
                   out: str = "is_test") -> DataFrame:
    """M8: the first round(train_frac * n) rows in ``order_by`` order (NULLs
    first) train, the rest test (train strictly precedes test).

    The last training row is found column by column: counts per value of the first column
    and their prefix sums give its value, the next column is searched among the rows
    of that value only.  The split then compares rows with it; rows are neither sorted nor
    written.  Rows equal in all columns that the cut falls between are numbered in the order
    of a hash of the row."""
    order_by = list(order_by)
    n = df.count()
    k = int(math.floor(n * float(train_frac) + 0.5))
    if k <= 0 or k >= n:
        return df.withColumn(out, F.lit(k <= 0))
    here, left, values = df, k, []
    for c in order_by:
        sums = dense_sums(here.groupBy(F.col(c).alias("v")).agg(F.count(F.lit(1)).alias("n")),
                          [F.col("v").asc_nulls_first()], "n", "before")
        row = sums.where((F.col("before") < left) & (F.col("before") + F.col("n") >= left)).first()
        values.append(row["v"])
        left -= row["before"]
        here = here.where(F.col(c).eqNullSafe(F.lit(row["v"])))
        ties = row["n"]
    key = F.struct(*[F.col(c) for c in order_by])
    # structs compare field by field, NULLs first
    last = F.struct(*[F.lit(v).cast(df.schema[c].dataType) for c, v in zip(order_by, values)])
    if left == ties:
        return df.withColumn(out, key > last)
    plain = [F.col(f.name) for f in df.schema.fields if isinstance(f.dataType, AtomicType)]
    at = df.where(key == last).withColumn("_rn", F.row_number().over(Window.partitionBy(*order_by).orderBy(F.xxhash64(*plain))))
    return (df.where(key != last).withColumn(out, key > last)
            .unionByName(at.withColumn(out, F.col("_rn") > left).drop("_rn")))


# --------------------------------------------------------------------- M6
@dataclass
class Scaler:
    """Train-fitted z-score: one-row frame of ``<c>__mean`` / ``<c>__sd``."""
    columns: list[str]
    stats: DataFrame

    def transform(self, df: DataFrame) -> DataFrame:
        s = scalars(self.stats, [f"{c}__{k}" for c in self.columns for k in ("mean", "sd")])
        out = []
        for c in df.columns:
            if c in self.columns:
                sd = F.coalesce(F.when(s[f"{c}__sd"] != 0, s[f"{c}__sd"]), F.lit(1.0))
                out.append(((F.col(c).cast(DoubleType()) - s[f"{c}__mean"]) / sd).alias(c))
            else:
                out.append(F.col(c))
        return df.select(*out)


def fit_scaler(train: DataFrame, columns: Sequence[str]) -> Scaler:
    """M6: means and *population* standard deviations over the train rows."""
    columns = list(columns)
    stats = train.agg(*[e for c in columns for e in (
        F.avg(F.col(c).cast(DoubleType())).alias(f"{c}__mean"),
        F.stddev_pop(F.col(c).cast(DoubleType())).alias(f"{c}__sd"))])
    return Scaler(columns, stats)


# --------------------------------------------------------------------- M7
def test_metadata(split: DataFrame, flag: str = "is_test",
                  cols: Sequence[str] = ID_AND_LABELS) -> DataFrame:
    """M7: identifiers and labels of the test rows (carried, not re-joined)."""
    return split.where(F.col(flag)).select(*[c for c in cols if c in split.columns])


def split_report(split: DataFrame, label: str = "target", flag: str = "is_test") -> DataFrame:
    """Rows and class shares of the train and test sides: (side, label, n, share)."""
    side = F.when(F.col(flag), "test").otherwise("train").alias("side")
    counts = split.groupBy(side, F.col(label)).agg(F.count(F.lit(1)).alias("n"))
    # a window over the counts only: two sides x classes rows
    total = F.sum("n").over(Window.partitionBy("side"))
    return counts.withColumn("share", F.col("n").cast(DoubleType()) / total)
