"""Building wide expressions as SQL text.

Each PySpark ``Column`` node is a round trip to the JVM; a select list of
a few hundred nested nodes costs seconds of driver time before any job
runs.  The same expression written as one SQL string is parsed JVM-side
in a single call.  Plans are identical either way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def q(name: str) -> str:
    """Backtick-quote an identifier."""
    return "`" + name.replace("`", "``") + "`"


def lit_str(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def lit_num(x: float) -> str:
    """A SQL double literal that round-trips exactly (``repr`` + D suffix)."""
    x = float(x)
    if x != x:
        return "CAST('NaN' AS DOUBLE)"
    if x in (float("inf"), float("-inf")):
        return f"CAST('{'-' if x < 0 else ''}Infinity' AS DOUBLE)"
    return f"{x!r}D"


def unpivot_expr(cols: Sequence[str], name_col: str = "column", value_col: str = "x") -> Column:
    """``inline(array(struct(name, CAST(value AS DOUBLE)), ...))`` in one call."""
    items = ", ".join(f"struct({lit_str(c)} AS {name_col}, CAST({q(c)} AS DOUBLE) AS {value_col})"
                      for c in cols)
    return F.expr(f"inline(array({items}))")
