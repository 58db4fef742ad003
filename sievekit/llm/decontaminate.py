"""Benchmark decontamination by Wu-Manber multi-pattern search over words (operator 10).

Patterns are windows of benchmark words.  For each pattern length ``m`` a shift
table over hashed two-word blocks says how far a window may move on because no
pattern has the block nearer to its end; where the shift is zero, the hash of
the block selects the bucket of patterns that end with it, these are compared
word by word, and matches are confirmed on the words themselves.  Texts are
searched in many lanes at once, so the skipping search is vectorised.

The benchmark is bounded block by block: at most ``BLOCK_WORDS`` words (or one
item) are a block, and each block is another narrow pass over the same rows.  Rows
are written after ``BLOCKS_A_STAGE`` passes, so a task never holds more blocks
than that; the documents are never shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from .frames import BLOCKS_A_STAGE, free_prefix, stored, trimmed
from .words import ALNUM, Words, hash_words, mix64, slices, string_buffers

WINDOW = 10
BLOCK_WORDS = 400_000
LANE = 512
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_K = np.uint64(0xD6E8FEB86659FD93)


def ascii_words(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased (bytes.lower touches ASCII letters only)."""
    return _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


def _block_hash(words: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    h = words[end]
    if size == 2:
        h = h + words[end - 1] * _K
    return mix64(h)


@dataclass
class Patterns:
    """All patterns of one length, with their shift table and suffix buckets."""

    m: int
    words: np.ndarray              # uint64, patterns x m
    text: list[tuple[bytes, ...]]
    items: list[tuple[str, ...]]
    shift: np.ndarray
    keys: np.ndarray               # sorted distinct suffix-block hashes
    first: np.ndarray              # bucket ranges in ``order``
    order: np.ndarray

    @property
    def block(self) -> int:
        return min(2, self.m)


def _hash_list(words: list[bytes]) -> np.ndarray:
    """Hashes of words one by one, as ``hash_words`` gives them."""
    raw = np.frombuffer(b" ".join(words), np.uint8)
    return hash_words(raw, np.array([0, len(raw)]), ALNUM).hashes


def build_patterns(items: list[tuple[str, str]], window: int = WINDOW) -> list[Patterns]:
    """Patterns of (item_id, text) pairs, one table for each length."""
    where: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
    for item, text in items:
        w = ascii_words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            where[tuple(w[i:i + window])].add(item)
    by_length = defaultdict(list)
    for p in where:
        by_length[len(p)].append(p)
    out = []
    for m, text in sorted(by_length.items()):
        text.sort()
        words = np.stack([_hash_list(list(p)) for p in text])
        size = min(2, m)
        ends = range(size - 1, m)
        bits = max(10, int(np.ceil(np.log2(8 * len(text) * len(ends) + 1))))
        shift = np.full(1 << min(bits, 22), m - size + 1, dtype=np.int64)
        for e in ends:
            h = _block_hash(words.reshape(-1), np.arange(len(text)) * m + e, size)
            np.minimum.at(shift, (h & np.uint64(len(shift) - 1)).astype(np.int64), m - 1 - e)
        suffix = _block_hash(words.reshape(-1), np.arange(len(text)) * m + m - 1, size)
        order = np.argsort(suffix, kind="stable")
        keys, first = np.unique(suffix[order], return_index=True)
        out.append(Patterns(m, words, text, [tuple(sorted(where[p])) for p in text], shift, keys,
                            np.append(first, len(order)), order))
    return out


def search(w: Words, p: Patterns) -> tuple[np.ndarray, np.ndarray]:
    """(end position, pattern) of every occurrence whose word hashes agree."""
    n, words = np.diff(w.first), w.hashes
    begin = w.first[:-1] + p.m - 1
    count = np.maximum(n - p.m + 1, 0)
    lanes = -(-count // LANE)
    k = np.arange(int(lanes.sum())) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    pos = np.repeat(begin, lanes) + k * LANE
    stop = np.minimum(pos + LANE, np.repeat(begin + count, lanes))
    mask, found = np.uint64(len(p.shift) - 1), []
    while len(pos):
        h = _block_hash(words, pos, p.block)
        step = p.shift[(h & mask).astype(np.int64)]
        zero = step == 0
        if zero.any():
            at, key = pos[zero], h[zero]
            b = np.searchsorted(p.keys, key)
            b[b == len(p.keys)] = 0
            hit = p.keys[b] == key
            found.append((at[hit], b[hit]))
        pos = pos + np.maximum(step, 1)
        on = pos < stop
        pos, stop = pos[on], stop[on]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, bucket = (np.concatenate(x) for x in zip(*found, strict=True))
    # a bucket's patterns are tried one after the other, so no product of hits and patterns is held
    ends, which = [], []
    tries = p.first[bucket + 1] - p.first[bucket]
    for t in range(int(tries.max(initial=0))):
        on = tries > t
        pat = p.order[p.first[bucket[on]] + t]
        same = np.ones(len(pat), bool)
        for j in range(p.m):
            same &= words[at[on] - p.m + 1 + j] == p.words[pat, j]
        ends.append(at[on][same])
        which.append(pat[same])
    return np.concatenate(ends) if ends else at[:0], np.concatenate(which) if which else at[:0]


_FIELDS = [StructField("n_words", LongType()), StructField("n_hit", LongType()), StructField("n_items", LongType()),
           StructField("items_sha256", StringType()), StructField("contaminated", BooleanType()),
           StructField("spans", ArrayType(LongType())), StructField("items", ArrayType(StringType()))]


def _scan(tables, last: bool, prefix: str, at_text: int, n_kept: int):
    """Add the hits of one benchmark block; the last pass gives the digest columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = string_buffers(batch.column(at_text))
            spans = batch.column(batch.num_columns - 2).to_pylist()
            items = [set(x) if x else None for x in batch.column(batch.num_columns - 1).to_pylist()]
            n_words = np.zeros(batch.num_rows, np.int64)
            for i, j in slices(offsets):
                w = hash_words(raw, offsets[i:j + 1], ALNUM)
                n_words[i:j] = np.diff(w.first)
                for p in tables.value:
                    ends, which = search(w, p)
                    if not len(ends):
                        continue
                    doc = np.searchsorted(w.first, ends, side="right") - 1
                    text: dict[int, list[bytes]] = {}
                    for e, k, d in zip(ends.tolist(), which.tolist(), doc.tolist(), strict=True):
                        if d not in text:
                            text[d] = _WORD.findall(raw[offsets[i + d]:offsets[i + d + 1]].tobytes().lower())
                        s = e - int(w.first[d]) - p.m + 1
                        if tuple(text[d][s:s + p.m]) == p.text[k]:
                            spans[i + d] = spans[i + d] or []
                            spans[i + d] += [s, s + p.m]
                            items[i + d] = items[i + d] or set()
                            items[i + d].update(x for x in p.items[k] if x is not None)
            spans = [_merge(x) for x in spans]
            items = [sorted(x) if x else [] for x in items]
            if not last:
                yield pa.record_batch([*batch.columns[:-2], pa.array(spans, pa.list_(pa.int64())),
                                       pa.array(items, pa.list_(pa.string()))], names=batch.schema.names)
                continue
            n_hit = [sum(x[1::2]) - sum(x[::2]) for x in spans]
            yield pa.record_batch(
                [*batch.columns[:n_kept], pa.array(n_words), pa.array(n_hit, pa.int64()),
                 pa.array([len(x) for x in items], pa.int64()),
                 pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
                 pa.array([n > 0 for n in n_hit], pa.bool_()), pa.array(spans, pa.list_(pa.int64())),
                 pa.array(items, pa.list_(pa.string()))],
                names=[*batch.schema.names[:n_kept], *(prefix + f.name for f in _FIELDS)])

    return run


def _merge(flat: list[int] | None) -> list[int]:
    """Union of the half-open spans in a flat list, again as a flat list."""
    out: list[int] = []
    if flat:
        for s, e in sorted(zip(flat[::2], flat[1::2], strict=True)):
            if out and s <= out[-1]:
                out[-1] = max(out[-1], e)
            else:
                out += [s, e]
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  block_words: int = BLOCK_WORDS, keep: tuple[str, ...] | None = None, prefix: str = "") -> DataFrame:
    """Per document: the ``keep`` columns (the id as ``doc_id`` by default) and n_words, n_hit, n_items,
    items_sha256, contaminated, the hit word ``spans`` (flat start, end pairs) and the sorted
    ``items``, named with ``prefix``.

    Null and wordless texts have no words and no hits; benchmark items without
    words match nothing, those with a null id hit words but aren't listed, rows
    that repeat an id are one item; document ids may be null or repeat; other
    columns aren't read; an empty benchmark hits nothing.
    """
    source = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"),
                              F.col(f"`{item_text_col}`").cast("string").alias("text")).where("text is not null")
    chars = source.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = max(1, -(-chars // (5 * block_words)))
    kept = [F.col(f"`{c}`") for c in keep] if keep else [F.col(f"`{id_col}`").cast("long").alias("doc_id")]
    same = bool(keep) and text_col in keep and dict(docs.dtypes)[text_col] == "string"
    at_text, n_kept = keep.index(text_col) if same else len(kept), len(kept)
    p = free_prefix(list(keep or ["doc_id"]), ("whole_text", "spans_so_far", "items_so_far"))
    text = [] if same else [F.col(f"`{text_col}`").cast("string").alias(p + "whole_text")]
    now = docs.select(*kept, *text, F.lit(None).cast("array<bigint>").alias(p + "spans_so_far"),
                      F.lit(None).cast("array<string>").alias(p + "items_so_far"))
    done = StructType([*now.schema.fields[:n_kept], *(StructField(prefix + f.name, f.dataType) for f in _FIELDS)])
    for b in range(n_blocks):
        part = source.where(F.pmod(F.xxhash64("text"), F.lit(n_blocks)) == b)
        tables = docs.sparkSession.sparkContext.broadcast(build_patterns([(r[0], r[1]) for r in part.collect()], window))
        last = b == n_blocks - 1
        now = now.mapInArrow(trimmed(_scan(tables, last, prefix, at_text, n_kept)), done if last else now.schema)
        if not last and (b + 1) % BLOCKS_A_STAGE == 0:
            now = stored(now)
    return now


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) without any benchmark window."""
    p = free_prefix(docs.columns, tuple(f.name for f in _FIELDS))
    rows = contamination(docs, benchmark, keep=tuple(docs.columns), prefix=p)
    return rows.where(~F.col(p + "contaminated")).select(*[F.col(f"`{c}`") for c in docs.columns])
