"""Small Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


#: keys holding over 1 / HOT_GROUPS of a table's rows are fewer than this, so a table of
#: them may be broadcast whatever the table's size
HOT_GROUPS = 16_384


#: passes over the same rows, each with a broadcast block of a table, that one stage may chain
BLOCKS_A_STAGE = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """The frame written as Parquet to the shared checkpoint folder and read back.

    One pass, columnar, cuts the lineage and outlives lost executors; the files
    go with the application's own checkpoint folder.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the files of frames that ``stored`` returned and nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


#: Spark removes the shuffle files of a query at its end, not when the driver happens to collect its garbage
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Every query that ends inside leaves no shuffle files, so disk holds those of one query at
    a time.  Only where each query ends in a written table or in values on the driver."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLES_GO) if before is None else spark.conf.set(SHUFFLES_GO, before)


def spread_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """An equi-join (inner or left) in which no key of ``left`` fills a task: keys with over
    1 / ``HOT_GROUPS`` of its rows are broadcast with their row of ``right``, which has one row
    a key; all other keys meet by a shuffle.  Keys are not null.  ``left`` should be cheap to
    read twice (a written table)."""
    counts = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    hot = stored(counts.where(F.col("_rows") > max(left.count() / HOT_GROUPS, 1)).select(*on))
    few = F.broadcast(right.join(F.broadcast(hot), on, "left_semi"))
    often = left.join(F.broadcast(hot), on, "left_semi").join(few, on, how)
    return often.unionByName(left.join(F.broadcast(hot), on, "left_anti").join(right, on, how))


def release_memory() -> None:
    """Hand freed memory back to the system: Python workers outlive tasks, and their
    allocators keep what a task has freed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def trimmed(fn):
    """The batch function ``fn``, releasing freed memory after each batch and at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one_by_one() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch
                del batch
                release_memory()

        yield from fn(one_by_one())
        release_memory()

    return run


def columns_as(df: DataFrame, **wanted: tuple[str, str]) -> DataFrame:
    """``df`` with only the wanted columns, name=(source column, type); a column that has
    its name and type already is taken as it is, which keeps equal plans equal."""
    types = dict(df.dtypes)
    return df.select(*[F.col(f"`{src}`") if src == name and types.get(src) == kind else F.col(f"`{src}`").cast(kind).alias(name)
                       for name, (src, kind) in wanted.items()])


def free_prefix(columns: list[str], names: tuple[str, ...]) -> str:
    """Underscores that make none of the prefixed names one of the columns."""
    prefix = "_"
    taken = {c.lower() for c in columns}
    while any(prefix + n in taken for n in names):
        prefix += "_"
    return prefix


def grouped_rows(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Consecutive rows with one value of ``key`` as one table (rows come sorted by key)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        k = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(k[1:] != k[:-1]) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for n, (i, j) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            part = batch.slice(i, j - i)
            if n == 0 and held:
                last = held[-1]
                same = last.column(last.schema.get_field_index(key))[len(last) - 1].as_py() == k[0]
                if not same:
                    yield pa.Table.from_batches(held)
                    held = []
            elif n > 0:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def bounded_groups(batches: Iterator[pa.RecordBatch], key: str, cap: int) -> Iterator[tuple[pa.Table, bool]]:
    """Consecutive rows with one value of ``key``: (the whole group, True) up to ``cap`` rows;
    a larger group comes in pieces (piece, False), so never more than ``cap`` rows and a batch are held."""
    held: list[pa.RecordBatch] = []
    size, last, broken = 0, None, False

    def done() -> Iterator[tuple[pa.Table, bool]]:
        if held:
            yield pa.Table.from_batches(held), not broken

    for batch in batches:
        if batch.num_rows == 0:
            continue
        k = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), batch.num_rows]
        for i, j in zip(edges[:-1], edges[1:], strict=True):
            if k[i] != last:
                yield from done()
                held, size, last, broken = [], 0, k[i], False
            held.append(batch.slice(i, j - i))
            size += j - i
            if size > cap:
                broken = True
                yield from done()
                held = []
    yield from done()
