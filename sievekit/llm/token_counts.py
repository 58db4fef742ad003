"""Token counts of byte-level BPE by heap-and-linked-list merging (operator 7).

A text is cut by the vocabulary's pre-tokenisation pattern; special strings in
the text count as one token each, as the library does by default.  Each
distinct pre-token is merged once: its bytes form a doubly linked list, a heap
holds the rank and place of every adjacent pair that has a merge, and the
lowest pair is popped until none is left.  Its count is the initial symbols
minus the merges; no identifiers are emitted.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import trimmed

#: fixed value: the pre-tokenisation pattern of byte-level vocabularies
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: distinct pre-tokens remembered per Python worker, and the longest one remembered
CACHE_ENTRIES = 400_000
CACHE_CHARS = 48


def _byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class BpeCounter(dict):
    """pre-token -> number of tokens; missing pre-tokens are merged and remembered."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        chars = _byte_chars()
        self.symbol = [0] * 256
        for c, b in chars.items():
            self.symbol[b] = vocab[c]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.find = regex.compile(PATTERN).findall

    def __missing__(self, word: str) -> int:
        n = self.merged(word.encode("utf-8"))
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = n
        return n

    def merged(self, data: bytes) -> int:
        """Initial symbols minus merges."""
        n = len(data)
        if n == 1:
            return 1
        get, symbol = self.merges.get, self.symbol
        sym = [symbol[b] for b in data]
        heap = []
        for i in range(n - 1):
            m = get((sym[i], sym[i + 1]))
            if m:
                heap.append((m[0], i, m[1]))
        if not heap:
            return n
        heapify(heap)
        right = list(range(1, n + 1))
        left = list(range(-1, n - 1))
        done = 0
        while heap:
            rank, i, new = heappop(heap)
            j = right[i]
            if sym[i] < 0 or j >= n:
                continue
            m = get((sym[i], sym[j]))
            if m is None or m[0] != rank:
                continue  # a neighbour was merged meanwhile
            done += 1
            sym[i], sym[j] = new, -1
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                m = get((new, sym[k]))
                if m:
                    heappush(heap, (m[0], i, m[1]))
            k = left[i]
            if k >= 0:
                m = get((sym[k], new))
                if m:
                    heappush(heap, (m[0], k, m[1]))
        return n - done

    def count(self, text: str) -> int:
        if self.special is not None and self.special.search(text):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(self.count(p) for p in parts)
        return sum(map(self.__getitem__, self.find(text)))


@lru_cache(maxsize=2)
def _counter(path: str) -> BpeCounter:
    return BpeCounter(path)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row.

    ``vocabulary`` is the path of a byte-level BPE file that every executor can
    open.  Null texts count as empty (0 bytes, 0 tokens); ids may be null or
    repeat; other columns are not read; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            n_bytes = pc.binary_length(texts).cast(pa.int64())
            n = np.fromiter((counter.count(t.as_py()) for t in texts), np.int64, len(texts))
            yield pa.record_batch([batch.column(0), n_bytes, pa.array(n), pa.array(n > limit)],
                                  names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return (docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))
            .mapInArrow(trimmed(run), "doc_id long, n_bytes long, n_tokens long, over_limit boolean"))
