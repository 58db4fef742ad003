"""Query registry: name -> (DataFrame builder, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, _zero_signed_rounds(sql) if sql else sql)
        return fn
    return deco


def round6(c, digits: int = 9):
    """round(x * 10^d) / 10^d: rounds the binary product like SQL engines
    that scale first (decimal-string rounding differs on exact ties); the
    ``+ 0.0`` turns a negative zero into zero."""
    m = float(10 ** digits)
    return F.round(c * m) / m + F.lit(0.0)


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Round every floating column (output presentation for oracle compare)."""
    return df.select(*[round6(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def _zero_signed_rounds(sql: str) -> str:
    """Wrap every ROUND(...) as (ROUND(...) + 0.0) so no -0.0 leaves SQL."""
    out, i = [], 0
    while True:
        j = sql.find("ROUND(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + 5
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = _zero_signed_rounds(sql[j + 6:k])
        out.append(sql[i:j] + "(ROUND(" + inner + ") + 0.0)")
        i = k + 1


def sel(cols, doubles=(), digits: int = 9) -> str:
    """SQL select list with ROUND on the double columns."""
    return ", ".join(f"ROUND({c}, {digits}) AS {c}" if c in doubles else c for c in cols)
