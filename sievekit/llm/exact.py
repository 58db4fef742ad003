"""Exact duplicates by a 128-bit content hash, byte-compared inside hash groups.

Texts are equal when they are identical after every run of space and ``\\t``..``\\r``
became one space (nothing is trimmed); a null text counts as empty.

1. Every row gives (id, hash, digest): 56 bytes, written once.  Partial aggregation
   folds copies before the shuffle, so a group of a third of all rows is one row a task.
2. Rows of hash groups of two or more are compared byte by byte: they are grouped by
   (hash, text), again folded before the shuffle.  A bitmap over the hashes of such
   groups (``BITMAP_BUCKETS`` x 4 KB, whatever the table's size) keeps single texts out
   of that shuffle; once it fills up it lets more texts pass, and no result changes.
3. A hash group with two texts is split by text.
4. Rows meet their group on the hash.  Groups that hold over 1 / ``HOT_GROUPS`` of all
   rows, fewer than ``HOT_GROUPS`` of them, are broadcast; the others have few rows each.

Everything is built-in functions.  Defined results: null text = empty text; a null id
is never smaller than another, and in a group of null ids only ``keep_id`` is null;
rows that repeat an id with an equal text are the same document and stay together; an
empty table gives no rows; other columns are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import HOT_GROUPS, columns_as, stored

#: 4 KB bitmaps of 32,768 bits: 8 MB in all
BITMAP_BUCKETS = 2048
BITS = 32_768
#: pieces that the members of colliding hash groups are dealt over
SALTS = 32


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def content_hash(text: Column) -> Column:
    """128 bits of the normalised text."""
    return F.unhex(F.md5(text))


def _address(key: str) -> tuple[Column, Column]:
    """Bitmap bucket and bit of a hash."""
    place = F.pmod(F.xxhash64(key), F.lit(BITMAP_BUCKETS * BITS))
    return F.floor(place / BITS).cast("int"), (place % BITS).cast("int")


def _bitmap(groups: DataFrame) -> DataFrame:
    bucket, bit = _address("_hash")
    return (groups.select(bucket.alias("_bucket"), bit.cast("long").alias("_bit"))
            .groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_map")))


def _in_bitmap(rows: DataFrame, bitmap: DataFrame) -> DataFrame:
    """Rows whose bit is set: all rows of the groups, and some others."""
    bucket, bit = _address("_hash")
    byte = F.conv(F.hex(F.expr("substring(_map, _bit div 8 + 1, 1)")), 16, 10).cast("int")
    return (rows.withColumn("_bucket", bucket).withColumn("_bit", bit)
            .join(F.broadcast(bitmap), "_bucket")
            .where((byte.bitwiseAND(F.expr("shiftleft(1, _bit % 8)"))) != 0)
            .drop("_bucket", "_bit", "_map"))


def _joined(rows: DataFrame, groups: DataFrame, total: int) -> DataFrame:
    """Rows with their group's columns, null where a row is alone.  ``groups`` has one row a hash."""
    few = groups.where(F.col("group_size") > total / HOT_GROUPS)
    rest = rows.join(F.broadcast(few.select("_hash")), "_hash", "left_anti")
    return rows.join(F.broadcast(few), "_hash").unionByName(
        rest.join(groups.where(F.col("group_size") <= total / HOT_GROUPS), "_hash", "left"))


def exact_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text",
                     hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id (smallest id among equal texts),
    group_size, kept (doc_id is keep_id), text_sha256 of the normalised text."""
    texts = columns_as(docs, doc_id=(id, "long"), text=(text, "string")).select(
        "doc_id", normalized(F.col("text")).alias("_norm"))
    texts = texts.withColumn("_hash", hash_of(F.col("_norm")))
    marks = stored(texts.select("doc_id", "_hash", F.unhex(F.sha2("_norm", 256)).alias("_sha")))
    total = marks.count()
    meeting = stored(marks.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_hash"))
    # bytes are compared here: one row per hash and text
    classes = stored(_in_bitmap(texts, _bitmap(meeting)).groupBy("_hash", "_norm")
                     .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
                     .select("_hash", "keep_id", "group_size", F.sha2("_norm", 256).alias("_class")))
    clashes = stored(classes.groupBy("_hash").agg(F.count(F.lit(1)).alias("_texts")).where("_texts > 1").select("_hash"))
    if clashes.isEmpty():
        out = _joined(marks, classes.where("group_size > 1").drop("_class"), total)
    else:
        single = classes.where("group_size > 1").drop("_class").join(clashes, "_hash", "left_anti")
        out = _joined(marks.join(clashes, "_hash", "left_anti"), single, total).unionByName(_split(texts, clashes))
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                      F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("_sha")).alias("text_sha256"))


def _split(texts: DataFrame, clashes: DataFrame) -> DataFrame:
    """Members of hash groups that hold several texts, joined on the text itself; the texts
    are repeated per salt, so one of them never gathers all its copies in a task."""
    members = texts.join(clashes, "_hash", "left_semi")
    kinds = members.groupBy("_hash", "_norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    salts = F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("_salt")
    salted = members.withColumn("_salt", F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0))), F.lit(SALTS)).cast("int"))
    return (salted.join(kinds.select("*", salts), ["_hash", "_norm", "_salt"])
            .select("_hash", "doc_id", F.unhex(F.sha2("_norm", 256)).alias("_sha"), "keep_id", "group_size"))


def without_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text",
                       hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.  Only the ids and digests of
    rows that go are joined to the table, so single texts need no partner."""
    gone = (exact_duplicates(docs, id, text, hash_of).where(~F.col("kept"))
            .select(F.col("doc_id").alias("_gone_id"), F.col("text_sha256").alias("_gone_sha")).distinct())
    on = (F.col(f"`{id}`").cast("long").eqNullSafe(F.col("_gone_id"))
          & (F.sha2(normalized(F.col(f"`{text}`").cast("string")), 256) == F.col("_gone_sha")))
    return docs.join(gone, on, "left_anti")
