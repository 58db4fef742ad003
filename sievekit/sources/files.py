"""File sources and sinks (S1-S3): schema-declared reads, gated cache
writes, and the first-sufficient-source fallback."""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..functions.nulls import nan_to_null
from ..session import ensure_checkpoint_dir

# The canonical cross-section schema (column order as stored).
FUNDAMENTALS_SCHEMA = StructType(
    [StructField("ticker", StringType()), StructField("sector", StringType())]
    + [StructField(c, DoubleType()) for c in (
        "PE_ratio", "ROE", "DE_ratio", "dividend_yield", "revenue_growth", "profit_margin",
        "current_ratio", "market_cap_log", "beta", "forward_return")])


# Published folders: every write goes to a version of its own below ``path``; an empty
# marker file, created after the write has succeeded, makes it the one that readers take.
_MARKERS = "_PUBLISHED"


def _fs(spark: SparkSession, path: str):
    """(file system, path class) of the storage that ``path`` names, shared or local."""
    cls = spark._jvm.org.apache.hadoop.fs.Path
    return cls(path).getFileSystem(spark._jsc.hadoopConfiguration()), cls


def _versions(spark: SparkSession, path: str) -> list[str]:
    fs, cls = _fs(spark, path)
    markers = cls(path, _MARKERS)
    if not fs.exists(markers):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(markers))


def publish(spark: SparkSession, path: str, write: Callable[[str], None], keep: int = 2) -> str:
    """Run ``write`` on a fresh folder below ``path`` and publish it; returns the folder.

    Readers see the former version until the marker exists, and a write that fails
    leaves no marker, so never a half-written one.  The last ``keep`` versions stay (readers
    may still be on the one before); older ones and what failed writes left below ``path``
    before them are removed."""
    version = f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    target = f"{path}/{version}"
    write(target)
    fs, cls = _fs(spark, path)
    fs.create(cls(f"{path}/{_MARKERS}/{version}"), False).close()
    known = _versions(spark, path)
    oldest = known[-keep:][0]
    for name in known[:-keep]:
        fs.delete(cls(f"{path}/{_MARKERS}/{name}"), False)
    for f in fs.listStatus(cls(path)):
        name = f.getPath().getName()
        if name.startswith("v") and name < oldest:
            fs.delete(f.getPath(), True)
    return target


def published(spark: SparkSession, path: str) -> str:
    """The folder that readers of ``path`` take: its newest published version, or
    ``path`` itself where nothing was published (a plain file or folder)."""
    known = _versions(spark, path)
    return f"{path}/{known[-1]}" if known else path


def read_fundamentals(spark: SparkSession, path: str, fmt: str = "csv",
                      schema: StructType | None = FUNDAMENTALS_SCHEMA) -> DataFrame:
    """Read a cross-section file or published cache with a declared schema (no
    inference pass over the data), then NaN -> NULL once.  ``schema=None`` infers."""
    path = published(spark, path)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        df = reader.option("header", True).csv(path)
    else:
        df = reader.format(fmt).load(path)
    return nan_to_null(df)


def write_cache(df: DataFrame, path: str, min_rows: int = 50, fmt: str = "csv") -> bool:
    """Write ``df`` only if it has at least ``min_rows`` rows.

    The check reads at most ``min_rows`` rows (``limit`` stops early), then
    the write is one distributed job into a new version of ``path``, published when it
    is whole (:func:`publish`): a reader never sees a part of a cache, and a write that
    fails, or one of too few rows, leaves the previous cache readable.  ``df`` may read the cache
    it replaces.  Returns whether it was written.
    """
    if df.limit(min_rows).count() < min_rows:
        return False

    def write(folder: str) -> None:
        if fmt == "csv":
            df.write.option("header", True).csv(folder)
        else:
            df.write.format(fmt).save(folder)

    publish(df.sparkSession, path, write)
    return True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    base = base[len("file:"):] if base.startswith("file:") else base
    return os.path.join(base, "sievekit-cache", f"{name}-{uuid.uuid4().hex[:12]}")


@dataclass(frozen=True)
class Tier:
    """One source in a fallback chain: a loader and its minimum row count."""
    name: str
    load: Callable[[], DataFrame]
    min_rows: int = 0


def first_sufficient(tiers: Sequence[Tier]) -> tuple[str, DataFrame]:
    """S3: the first tier that loads and has at least ``min_rows`` rows.

    Only the size gate is evaluated (``limit(min_rows).count()``); the
    winning frame stays lazy.  Raises if no tier qualifies.
    """
    errors = []
    for t in tiers:
        try:
            df = t.load()
            if t.min_rows and df.limit(t.min_rows).count() < t.min_rows:
                errors.append(f"{t.name}: fewer than {t.min_rows} rows")
                continue
            return t.name, df
        except Exception as e:  # noqa: BLE001 - a failing tier falls through
            errors.append(f"{t.name}: {type(e).__name__}")
    raise RuntimeError("no source qualified: " + "; ".join(errors))
