"""Display helpers (X1, X2): numbers as text, '—' when not a number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import to_double

# Fixed value: the placeholder shown for a missing number.
MISSING = "—"


def fixed(v: Column, nd: int) -> Column:
    """``nd`` decimals, rounded half-to-even on the exact binary value (as
    Python's ``format(x, '.2f')``).  ``format_number`` rounds that way;
    ``format_string`` rounds half-up.  Grouping commas are removed."""
    return F.regexp_replace(F.format_number(v, int(nd)), ",", "")


def fmt_pct(x: Column) -> Column:
    """``12.34%`` from 0.1234; '—' for NULL or non-numeric text."""
    v = to_double(x)
    return F.when(v.isNull(), F.lit(MISSING)).otherwise(F.concat(fixed(v * 100, 2), F.lit("%")))


def fmt_num(x: Column, nd: int = 3) -> Column:
    """Fixed ``nd`` decimals; '—' for NULL or non-numeric text."""
    v = to_double(x)
    return F.when(v.isNull(), F.lit(MISSING)).otherwise(fixed(v, nd))
