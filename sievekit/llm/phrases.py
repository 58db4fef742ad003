"""Phrase collocations by stripes: a prefix keys an associative counter of its next words.

A stripe is (language, prefix of 0 to ``max_words`` - 1 words) -> {next word: count}.  The empty
prefix's stripe counts the words, a word's stripe the pairs it begins, and so on; stripes
of one prefix are merged elementwise.  From the merged counters come

* extensions: f(prefix + word) is the counter's entry;
* prefix totals: f(prefix) is the entry one word earlier, the empty prefix's total is n;
* subsumption maxima: a phrase lies in a longer one only if it lies in one that is a word
  longer and at least as frequent, so the largest entry of the phrase's own stripe and the
  elementwise maximum over the stripes ending in it decide.

Tasks read slices of about ``SLICE_BYTES`` of whole texts, number their words with an exact
dictionary, and send stripes packed as one string of words and one array of counts; they are
unpacked after the shuffle and merged by an aggregation that can spill.  A phrase can only reach
``min_count`` when its first and its last words do: each length counts only places whose
two shorter parts may be frequent, by a bitmap of ``BITMAP_BITS`` bits.  The bitmap only errs
to one side; when it fills up more is counted and no result changes.

Stripes of prefixes with over 1 / ``HOT_PREFIXES`` of all words (fewer than that number), and the empty
prefix's, are cut into ``SHARDS`` shards by next word, so a very common word is no single task's.

Defined results: a null language is ``und``, a null text is empty, repeated rows count each
time, ties are ordered by count and phrase, an empty table gives no rows; only the text and
language columns are read, whatever else there is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import columns_as, spread_join, stored, trimmed
from .words import LOWER, byte_table, mix64

SLICE_BYTES = 4 << 20
BITMAP_BITS = 1 << 26
HOT_PREFIXES = 1024
SHARDS = 64
#: words a merging task takes, and the largest number of such tasks
TASK_WORDS = 4_000_000
MAX_TASKS = 20_000

_PIECE_END = byte_table(lambda b: b in b".,;:!?" or 10 <= b <= 13)
_BREAK = _PIECE_END | byte_table(lambda b: b in (9, 32))

STRIPES = "lang string, prefix string, shard int, words string, counts array<int>"


# ------------------------------------------------------------------ one slice
class Slice:
    """The words of some texts, numbered: ``gram`` is each place's language and words so far."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        # a piece end keeps neighbouring texts apart
        raw = LOWER[np.frombuffer(b"\n".join(texts), dtype=np.uint8)]
        out = _BREAK[raw]
        word = np.concatenate(([False], ~out, [False]))
        edges = np.flatnonzero(word[1:] != word[:-1])
        starts, ends = edges[::2], edges[1::2]
        offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw[~out])).dictionary_encode()
        self.words: pa.StringArray = words.dictionary
        self.ids = words.indices.to_numpy().astype(np.int64)
        self.langs = sorted(set(langs))
        number = {lang: i for i, lang in enumerate(self.langs)}
        bounds = np.cumsum([len(t) + 1 for t in texts])
        self.lang = np.array([number[x] for x in langs], dtype=np.int64)[np.searchsorted(bounds, starts, side="right")]
        piece = np.cumsum(_PIECE_END[raw])[starts] if len(starts) else np.zeros(0, dtype=np.int64)
        self.follows = piece[1:] == piece[:-1]
        self.hash = pd.util.hash_array(self.words.to_numpy(zero_copy_only=False), categorize=False)

    def __len__(self) -> int:
        return len(self.ids)


def phrase_hashes(lang: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """Bitmap addresses of phrases from the hashes of their language and words."""
    h = lang
    for w in words:
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + w)
    return h & np.uint64(BITMAP_BITS - 1)


def _lang_hashes(langs: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(langs, dtype=object), categorize=False)


def _has(bitmap: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bitmap[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1 > 0


def stripes_of(part: Slice, size: int, bitmap: np.ndarray | None, hot: pa.Array) -> pa.RecordBatch:
    """The packed stripes of prefixes of ``size`` words in a slice.

    ``bitmap`` holds the frequent phrases of ``size`` words (unused for 0), ``hot`` the prefixes
    whose stripes are cut into shards, as language and prefix with a space between."""
    n, v = len(part), max(len(part.words), 1)
    places = np.arange(max(n - size, 0))
    for k in range(size):
        places = places[part.follows[places + k]]
    if size:
        by_lang = _lang_hashes(part.langs)[part.lang]
        word = part.hash[part.ids]

        def frequent(at: np.ndarray) -> np.ndarray:
            return _has(bitmap, phrase_hashes(by_lang[at], [word[at + k] for k in range(size)]))

        places = places[frequent(places)]
        places = places[frequent(places + 1)]
    # prefixes numbered word by word; a number and a next word make one key
    prefix = part.lang[places]
    for k in range(size):
        prefix = np.unique(prefix * v + part.ids[places + k], return_inverse=True)[1]
    keys, first, counts = np.unique(prefix * v + part.ids[places + size], return_index=True, return_counts=True)
    at = places[first]
    prefix, last = keys // v, keys % v
    lang = pa.array(part.langs, pa.string()).take(pa.array(part.lang[at]))
    # the prefix text once a prefix
    new = np.flatnonzero(np.concatenate(([True], prefix[1:] != prefix[:-1]))) if len(prefix) else np.zeros(0, dtype=np.int64)
    number = np.cumsum(np.bincount(new, minlength=len(prefix))) - 1 if len(prefix) else new
    texts = [part.words.take(pa.array(part.ids[at[new] + k])) for k in range(size)]
    text = pc.binary_join_element_wise(*texts, " ") if size else pa.array([""] * len(new), pa.string())
    if size:
        cut = pc.is_in(pc.binary_join_element_wise(lang.take(pa.array(new)), text, " "), value_set=hot)
        cut = cut.to_numpy(zero_copy_only=False)[number] if len(number) else np.zeros(0, dtype=bool)
    else:
        cut = np.ones(len(prefix), dtype=bool)
    shard = np.where(cut, (part.hash[last] % np.uint64(SHARDS)).astype(np.int64), 0)
    order = np.lexsort((shard, number))
    number, shard, last, counts = number[order], shard[order], last[order], counts[order]
    rows = (np.flatnonzero(np.concatenate(([True], (number[1:] != number[:-1]) | (shard[1:] != shard[:-1]))))
            if len(number) else np.zeros(0, dtype=np.int64))
    offsets = pa.array(np.concatenate((rows, [len(number)])).astype(np.int32) if len(rows) else np.zeros(1, np.int32))
    packed = pc.binary_join(pa.ListArray.from_arrays(offsets, part.words.take(pa.array(last))), " ")
    return pa.RecordBatch.from_arrays(
        [lang.take(pa.array(new)).take(pa.array(number[rows])), text.take(pa.array(number[rows])),
         pa.array(shard[rows].astype(np.int32)), packed,
         pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int32)))],
        ["lang", "prefix", "shard", "words", "counts"])


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[Slice]:
    """Whole texts gathered to about ``SLICE_BYTES``."""
    texts: list[bytes] = []
    langs: list[str] = []
    held = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            if not text:
                continue
            texts.append(text)
            langs.append(lang)
            held += len(text)
            if held >= SLICE_BYTES:
                yield Slice(texts, langs)
                texts, langs, held = [], [], 0
    if texts:
        yield Slice(texts, langs)


# ------------------------------------------------------------------ the corpus
def _merged(docs: DataFrame, size: int, bitmap: np.ndarray | None, hot: list[str], tasks: int, least: int) -> DataFrame:
    """(lang, prefix, word, a): the entries of merged stripes that reach ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast((bitmap, hot))

    def stripes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, prefixes = shared.value
        for part in slices(batches):
            yield stripes_of(part, size, known, pa.array(prefixes, pa.string()))

    packed = docs.mapInArrow(trimmed(stripes), STRIPES)
    # every entry of a (prefix, word) lies in one shard, so merging needs no second shuffle
    entries = packed.repartition(tasks, "lang", "prefix", "shard").select(
        "lang", "prefix", "shard", F.inline(F.arrays_zip(F.split("words", " ").alias("word"), F.col("counts").alias("c"))))
    return (entries.groupBy("lang", "prefix", "shard", "word").agg(F.sum("c").alias("a"))
            .where(F.col("a") >= least).drop("shard"))


def _bitmap(phrases: DataFrame) -> np.ndarray:
    """Bits of the phrases (lang, phrase) for the next length: ``BITMAP_BITS`` of them, set in Spark."""

    def addresses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            words = pc.split_pattern(batch.column(1), " ")
            width = len(words[0])
            flat = words.flatten()
            coded = flat.dictionary_encode()
            hashes = pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False), categorize=False)[coded.indices.to_numpy()]
            langs = batch.column(0).dictionary_encode()
            by_lang = _lang_hashes(langs.dictionary.to_pylist())[langs.indices.to_numpy()]
            places = phrase_hashes(by_lang, [hashes[k::width] for k in range(width)])
            yield pa.RecordBatch.from_arrays([pa.array(places.astype(np.int64))], ["place"])

    bits = (phrases.select("lang", "phrase").mapInArrow(addresses, "place long")
            .select(F.expr("place div 32768").cast("int").alias("bucket"), (F.col("place") % 32768).alias("bit"))
            .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")))
    out = np.zeros(BITMAP_BITS // 8, dtype=np.uint8)
    for row in bits.collect():      # 2,048 rows of 4 KB at most
        out[row["bucket"] * 4096:(row["bucket"] + 1) * 4096] = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
    return out


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (l * r)) in 38 digits."""
    return F.expr(f"(CAST({a} AS DECIMAL(15,0)) * CAST({a} AS DECIMAL(15,0)) * CAST(1000000 AS DECIMAL(7,0)))"
                  f" div (CAST({left} AS DECIMAL(18,0)) * CAST({right} AS DECIMAL(18,0)))")


def collocations(docs: DataFrame, top: int = 2000, min_count: int = 10, max_words: int = 3, share: int = 50,
                 text: str = "text", lang: str = "lang") -> DataFrame:
    """Phrases of 2 to ``max_words`` words that occur ``min_count`` times or more within pieces of a language's
    texts and aren't subsumed by a longer one with ``share`` percent of their occurrences: each
    language's first ``top`` as lang, rank (1 = best; by score, count, phrase), phrase, a, l, r, n, score."""
    rows = columns_as(docs, lang=(lang, "string"), text=(text, "string")).select(
        F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    spark = docs.sparkSession
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = stored(_merged(rows, 0, None, [], base, 1).select("lang", F.col("word").alias("phrase"), "a"))
    totals = stored(counted.groupBy("lang").agg(F.sum("a").alias("n")))
    words = totals.agg(F.sum("n")).first()[0] or 0
    tasks = max(base, min(-(-words // TASK_WORDS), MAX_TASKS))
    frequent = [counted.where(F.col("a") >= min_count)]
    for size in range(1, max_words):
        shorter = frequent[-1]
        often = shorter.where(F.col("a") > words / HOT_PREFIXES).select(F.concat_ws(" ", "lang", "phrase").alias("p"))
        hot = [r["p"] for r in often.collect()]
        entries = _merged(rows, size, _bitmap(shorter), hot, tasks, min_count)
        frequent.append(stored(entries.select("lang", F.concat_ws(" ", "prefix", "word").alias("phrase"), "a")))
    known = stored(_union([f.select("lang", "phrase", "a") for f in frequent]))
    kept = stored(_union([_unsubsumed(frequent, k, share) for k in range(2, max_words + 1)]))
    # a language has at most ``top`` rows by now
    return _ranked(_scored(kept, known), top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _unsubsumed(frequent: list[DataFrame], k: int, share: int) -> DataFrame:
    """Candidates of k words without a longer one that holds them in ``share`` percent of the cases."""
    own = frequent[k - 1]
    if k == len(frequent):
        return own
    longer = frequent[k].withColumn("w", F.split("phrase", " "))
    most = (longer.select("lang", F.array_join(F.slice("w", 1, k), " ").alias("phrase"), F.col("a").alias("most"))
            .unionByName(longer.select("lang", F.array_join(F.slice("w", 2, k), " ").alias("phrase"), F.col("a").alias("most")))
            .groupBy("lang", "phrase").agg(F.max("most").alias("most")))
    return (own.join(most, ["lang", "phrase"], "left")
            .where(f"most IS NULL OR 100 * CAST(most AS DECIMAL(20,0)) < {share} * CAST(a AS DECIMAL(20,0))").drop("most"))


def _scored(kept: DataFrame, known: DataFrame) -> DataFrame:
    """The lowest-scoring cut of every candidate with its l, r and score."""
    cuts = stored(kept.withColumn("w", F.split("phrase", " ")).select(
        "*", F.explode(F.expr("sequence(1, size(w) - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("head"),
        F.expr("array_join(slice(w, k + 1, size(w) - k), ' ')").alias("tail")))
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r"))
    both = stored(spread_join(cuts, heads, ["lang", "head"]))
    both = spread_join(both, tails, ["lang", "tail"]).withColumn("score", _score("a", "l", "r"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("b")
    return both.groupBy("lang", "phrase", "a").agg(best).select(
        "lang", "phrase", "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), F.col("b.score").alias("score"))


def _ranked(scored: DataFrame, top: int) -> DataFrame:
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first within salts, so no task orders all phrases of a language
    salted = Window.partitionBy("lang", "_salt").orderBy(*order)
    first = (scored.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(256)))
             .withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top))
    whole = Window.partitionBy("lang").orderBy(*order)
    return first.withColumn("rank", F.row_number().over(whole).cast("long")).where(F.col("rank") <= top)
