"""Null/NaN discipline shared by every operator.

pandas treats NaN as missing; Spark treats NaN as a value that compares
*greater* than every number and poisons avg/max.  The rule used across
the package: turn NaN into NULL once at ingest, guard predicates with
``coalesce(pred, false)``, and divide with ``try_divide``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType

# Fixed value: text that looks numeric but carries a Java type suffix
# ('1d', '2.5F') is accepted by Spark's cast and rejected by pandas.
_JAVA_SUFFIX = r"^\s*[-+]?[0-9.eE+-]+[dDfF]\s*$"


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every float/double column (one projection)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def to_double(c: Column) -> Column:
    """pandas-style ``to_numeric(errors='coerce')`` for a string column."""
    s = c.cast(StringType())
    out = F.when(s.rlike(_JAVA_SUFFIX), F.lit(None).cast(DoubleType())).otherwise(
        s.try_cast(DoubleType()))
    return F.nanvl(out, F.lit(None).cast(DoubleType()))


def truthy(pred: Column) -> Column:
    """A predicate over possibly-NULL inputs that is false where unknown."""
    return F.coalesce(pred, F.lit(False))


def col_or_null(df: DataFrame, name: str) -> Column:
    """Column if present, else a typed NULL (missing-column tolerance)."""
    return F.col(name) if name in df.columns else F.lit(None).cast(DoubleType())


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Numeric columns chosen from the schema at run time, in schema order."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in exclude]


# Fixed value: the most distinct labels/categories ever brought to the driver.
MAX_LABELS = 10_000


def bounded_distinct(df: DataFrame, col: str, limit: int = MAX_LABELS) -> list:
    """Sorted distinct non-null values of a label-like column.

    Reads at most ``limit + 1`` distinct values and refuses more: a class or
    category list is small by nature, and this proves it before anything
    reaches the driver.
    """
    rows = (df.select(F.col(col).alias("v")).where(F.col("v").isNotNull()).distinct()
              .limit(limit + 1).collect())
    if len(rows) > limit:
        raise ValueError(f"{col!r} has more than {limit} distinct values; not a label column")
    return sorted(r[0] for r in rows)
