"""Distributed prefix sums over the distinct values of a column.

Average ranks (Spearman IC), ROC points and rank-sum AUC all need, for
every distinct value, counts over the rows *before* it in sort order.  A
window ordered over the whole table runs in one task; instead:

1. collapse rows to distinct values with their weights (partial
   aggregation folds ties -- a hot value becomes one row);
2. cut the distinct values into ``buckets`` equi-depth ranges with a
   ``percentile_approx`` sketch (``buckets - 1`` split points reach the
   driver, a size we choose) and ``Bucketizer``;
3. prefix-sum the per-bucket totals (a table of ``buckets`` rows), then
   run the ordered window *within* each bucket.

There is one path for all sizes.  NaN counts as missing, like NULL.

Output: one row per distinct value with the weights and their sums over
strictly earlier values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..session import materialize


def _bucket_count(df: DataFrame, buckets: int | None) -> int:
    if buckets:
        return int(buckets)
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))


def prefix_table(df: DataFrame, value: str, weights: dict[str, Column],
                 descending: bool = False, buckets: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """(by..., value, w..., before_w..., all_w...) per distinct non-null ``value`` of a group.

    ``before_<w>`` sums ``w`` over rows of the group whose value sorts strictly before
    (ascending, or descending when ``descending``), ``all_<w>`` over the whole group.  All
    groups share one pass and one list of cuts, so no window holds more than a bucket.
    """
    by = list(by)
    key = F.nanvl(F.col(value).cast(DoubleType()), F.lit(None).cast(DoubleType()))
    sort_key = -key if descending else key
    distinct = (df.where(key.isNotNull())
                  .groupBy(*by, sort_key.alias("_k"))
                  .agg(*[F.sum(e).alias(n) for n, e in weights.items()]))
    # written once, read by the sketch and the windows; nothing stays cached
    distinct = materialize(distinct)
    nb = _bucket_count(df, buckets)
    names = list(weights)
    cuts: list[float] = []
    if nb > 1:
        row = distinct.agg(F.percentile_approx("_k", [i / nb for i in range(1, nb)], 10000).alias("s")).first()
        cuts = sorted(set(v for v in (row["s"] or []) if v is not None and abs(v) != float("inf")))
    splits = [float("-inf"), *cuts, float("inf")]
    bucketed = (Bucketizer(splits=splits, inputCol="_k", outputCol="_b").transform(distinct) if cuts
                else distinct.withColumn("_b", F.lit(0.0)))
    totals = bucketed.groupBy(*by, "_b").agg(*[F.sum(n).alias(f"_t_{n}") for n in names])
    # windows over the bucket table only (``buckets`` rows a group)
    whole = Window.partitionBy(*by)
    upto_prev = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    gkeys = [f"_g{i}" for i in range(len(by))]
    offsets = totals.select(*[F.col(b).alias(g) for b, g in zip(by, gkeys)], F.col("_b").alias("_gb"),
                            *[F.coalesce(F.sum(f"_t_{n}").over(upto_prev), F.lit(0)).alias(f"_o_{n}") for n in names],
                            *[F.sum(f"_t_{n}").over(whole).alias(f"all_{n}") for n in names])
    within = Window.partitionBy(*by, "_b").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    on = bucketed["_b"] == offsets["_gb"]
    for b, g in zip(by, gkeys):
        on = on & bucketed[b].eqNullSafe(offsets[g])
    out = bucketed.join(F.broadcast(offsets), on)
    return out.select(
        *by, (-F.col("_k") if descending else F.col("_k")).alias(value),
        *[F.col(n) for n in names],
        *[(F.col(f"_o_{n}") + F.coalesce(F.sum(n).over(within), F.lit(0))).alias(f"before_{n}")
          for n in names], *[F.col(f"all_{n}") for n in names])


def dense_sums(table: DataFrame, order_by: list[Column], weight: str, out: str) -> DataFrame:
    """``table`` with ``out`` = sum of ``weight`` over the rows before it in ``order_by`` order,
    for values of any type: a range-partitioned sort, a running sum inside each partition, and
    prefix sums over one total per partition.  The sorted table is written once, so both
    reads see the same partitions."""
    tagged = materialize(table.orderBy(*order_by).withColumn("_pid", F.spark_partition_id())
                         .withColumn("_mid", F.monotonically_increasing_id()))
    totals = tagged.groupBy("_pid").agg(F.sum(weight).alias("_w"))
    # a window over one row per partition
    offsets = totals.select("_pid", F.coalesce(F.sum("_w").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    within = Window.partitionBy("_pid").orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
    j = tagged.join(F.broadcast(offsets), "_pid")
    return j.select(*table.columns, (F.col("_off") + F.coalesce(F.sum(weight).over(within), F.lit(0))).alias(out))


def average_ranks(df: DataFrame, value: str, out: str, buckets: int | None = None) -> DataFrame:
    """(value, out): 1-based average rank of each distinct value (ties share
    the mean of the ranks they span), as ``rank`` with ``method='average'``."""
    t = prefix_table(df, value, {"cnt": F.lit(1)}, buckets=buckets)
    return t.select(value, (F.col("before_cnt") + (F.col("cnt") + 1) / 2.0)
                    .cast(DoubleType()).alias(out))


def weighted_ranks(rows: DataFrame, value: str, weight: str, spread: str, cuts: list[float], out: str) -> DataFrame:
    """``rows`` (distinct, each standing for ``weight`` equal ones) with the average rank of
    ``value``; nothing is joined on the value.

    ``cuts`` are its equi-depth sketch values.  A row goes to the range bucket between two of
    them, and a value that fills whole buckets (it comes up twice among the cuts) to a
    bucket of its own, whose rows all have one rank, known from the bucket totals: they are
    spread over salts of ``spread`` and no window counts them.  In other buckets ordered windows add up
    the weights of the values before and of ties."""
    finite = sorted({c for c in cuts if abs(c) != float("inf")})
    hot = sorted({c for c in cuts if cuts.count(c) > 1})
    b = rows
    if finite:
        b = Bucketizer(splits=[float("-inf"), *finite, float("inf")], inputCol=value, outputCol="_b").transform(rows)
    else:
        b = b.withColumn("_b", F.lit(0.0))
    alone = F.col(value).isin(hot) if hot else F.lit(False)
    # a cut opens its bucket, so a value of its own bucket comes before the rest of the range
    b = b.withColumn("_alone", alone).withColumn("_sub", F.when(F.col("_alone"), 0).otherwise(1))
    totals = b.groupBy("_b", "_sub").agg(F.sum(weight).alias("_w"))
    # a window over at most two rows per bucket
    upto = Window.orderBy("_b", "_sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_b", "_sub", "_w", F.coalesce(F.sum("_w").over(upto), F.lit(0)).alias("_off"))
    salts = _bucket_count(rows, None)
    b = (b.join(F.broadcast(offsets), ["_b", "_sub"])
          .withColumn("_salt", F.when(F.col("_alone"), F.pmod(F.xxhash64(spread), F.lit(salts))).otherwise(F.lit(-1)).cast("int")))
    part = ["_b", "_sub", "_salt"]
    reach = F.sum(weight).over(Window.partitionBy(*part).orderBy(value).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    ties = F.sum(weight).over(Window.partitionBy(*part, value))
    rank = F.when(F.col("_alone"), F.col("_off") + (F.col("_w") + 1) / 2.0).otherwise(
        F.col("_off") + F.col("_reach") - F.col("_ties") + (F.col("_ties") + 1) / 2.0)
    return (b.withColumn("_reach", reach).withColumn("_ties", ties)
             .select(*rows.columns, rank.cast(DoubleType()).alias(out)))


def rank_correlation(df: DataFrame, a: str, b: str, buckets: int | None = None) -> DataFrame:
    """One row (n, corr): Spearman correlation with average ranks on ties over the rows
    where neither side is missing (NaN counts as missing); NULL for a constant side.

    Equal pairs are folded first; the two ranks are carried along with the pairs through
    :func:`weighted_ranks`, one shuffle by range each."""
    def known(c: str) -> Column:
        return F.nanvl(F.col(c).cast(DoubleType()), F.lit(None).cast(DoubleType()))

    pairs = (df.select(known(a).alias("a"), known(b).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
               .groupBy("a", "b").agg(F.count(F.lit(1)).alias("w")))
    pairs = materialize(pairs)
    nb = _bucket_count(df, buckets)
    probs = F.array(*[F.lit(i / nb) for i in range(1, nb)])
    row = pairs.agg(F.sum("w").alias("n"), *([F.percentile_approx(c, probs, F.lit(10000)).alias(c) for c in "ab"] if nb > 1 else [])).first()
    n = row["n"] or 0
    cuts = {c: list(row[c] or []) if nb > 1 else [] for c in "ab"}
    ranked = weighted_ranks(weighted_ranks(pairs, "a", "w", "b", cuts["a"], "ra"), "b", "w", "a", cuts["b"], "rb")
    mean = (n + 1) / 2.0
    da, db, w = F.col("ra") - mean, F.col("rb") - mean, F.col("w")
    sums = ranked.agg(F.sum(w * da * db).alias("ab"), F.sum(w * da * da).alias("aa"), F.sum(w * db * db).alias("bb"))
    den = F.sqrt("aa") * F.sqrt("bb")
    return sums.select(F.lit(n).alias("n"), F.try_divide("ab", F.when(den != 0, den)).alias("corr"))
