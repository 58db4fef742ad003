"""Attaching fitted statistics back to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scalars(stats: DataFrame, names: Sequence[str], mode: str = "literal") -> dict[str, Column]:
    """Columns of a one-row stats frame, for use in row expressions.

    ``literal`` (default): the single row is fetched once (a bounded,
    one-row action -- what Spark itself does when it evaluates a scalar
    subquery) and inlined as typed literals, which keeps downstream plans
    small.  ``subquery``: lazy scalar subqueries instead; Catalyst evaluates
    them at execution time, but every use embeds a copy of the stats plan.
    """
    names = list(names)
    if mode == "subquery":
        return {n: stats.select(n).scalar() for n in names}
    row = stats.select(*names).first()
    types = {f.name: f.dataType for f in stats.select(*names).schema.fields}
    return {n: F.lit(None if row is None else row[n]).cast(types[n]) for n in names}


def attach_by_group(df: DataFrame, stats: DataFrame, by: Sequence[str],
                    prefix: str = "_s_") -> DataFrame:
    """Left-join per-group statistics onto rows with null-safe keys.

    Statistic columns are renamed with ``prefix``.  The stats side has one
    row per group; AQE turns the join into a broadcast when that side is
    small at run time and keeps a shuffle join otherwise, so the broadcast
    is always behind a measured size.
    """
    by = list(by)
    gk = [f"{prefix}g{i}" for i in range(len(by))]
    right = stats.select(*[F.col(b).alias(g) for b, g in zip(by, gk)],
                         *[F.col(c).alias(prefix + c) for c in stats.columns if c not in by])
    cond = None
    for b, g in zip(by, gk):
        c = df[b].eqNullSafe(right[g])
        cond = c if cond is None else cond & c
    return df.join(right, cond, "left").drop(*gk)
