"""SentencePiece encoding and decoding by a shared-prefix forward pass (operator 1).

A text is marked (a space becomes the word mark, one mark stands in front) and
cut into marked words, between which no piece of the vocabulary can reach.
The distinct words of a batch are sorted, which walks their trie depth-first:
a word shares with its predecessor the forward table of their common prefix,
and only its own suffix is computed.

The forward entry of a prefix is the last piece of its best segmentation.  For
unigram models that is the highest sum of scores.  For merge (BPE) models it is
the one piece that may follow the best segmentation in front of it: a sequence
of pieces is what merging gives exactly when each adjacent pair of them is what
merging gives for its own concatenation, and so the entry depends on the prefix
alone.  Pairs are judged once and remembered.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import trimmed

MARK = "▁"
#: words, and judged pairs, remembered per Python worker
CACHE_WORDS = 100_000
CACHE_PAIRS = 300_000


class PieceModel:
    """A SentencePiece vocabulary with identity normalisation, for encoding and decoding."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as proto
        spec = proto.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        norm, kind = spec.normalizer_spec, spec.trainer_spec.model_type
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only models with identity normalisation are supported")
        if kind not in (1, 2) or any(p.type in (4, 5) for p in spec.pieces):
            raise ValueError("only unigram and BPE models without user-defined or unused pieces are supported")
        self.prefix = norm.add_dummy_prefix
        self.bpe = kind == 2
        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.raw: list[bytes] = []
        self.byte_ids = [-1] * 256
        self.unknown = SentencePieceProcessor(model_file=path).unk_id()
        for i, p in enumerate(spec.pieces):
            if p.type == 1:
                self.score[p.piece], self.ids[p.piece] = p.score, i
                self.raw.append(p.piece.replace(MARK, " ").encode())
            elif p.type == 6:
                self.byte_ids[int(p.piece[3:5], 16)] = i
                self.raw.append(bytes([int(p.piece[3:5], 16)]))
            else:
                self.raw.append(spec.trainer_spec.unk_surface.encode() if p.type == 2 else b"")
        self.bytes_known = min(self.byte_ids) >= 0
        self.longest = max(map(len, self.score), default=1)
        self.unknown_score = min(self.score.values(), default=0.0) - 10.0
        self.pairs: dict[tuple[str, str], bool] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        if self.bpe:  # pieces that merging never gives can't end a prefix
            self.reached = {p for p in self.score if len(p) > 1 and self._merge(p) == [p]}
            # ends of pieces: a longer end can't be a piece's if a shorter one isn't
            self.ends = {p[i:] for p in self.reached for i in range(len(p) - 1)}
        self.tuples = {p: (i,) for p, i in self.ids.items()}
        self.cut = self._cuts()

    def _cuts(self) -> re.Pattern | None:
        """A pattern that splits a marked text where no piece can reach across."""
        multi = [p for p in self.score if len(p) > 1]
        joined = set("".join(multi))
        if any(MARK in p.lstrip(MARK) for p in multi):
            return None  # a piece reaches over a word's end: the text is one word
        ascii_ = [chr(i) for i in range(128)]
        alone = re.escape("".join(c for c in ascii_ if c not in joined))
        after_letter = {y for p in multi for x, y in zip(p, p[1:]) if x.isalpha()}
        ends = re.escape("".join(c for c in ascii_ if not c.isalnum() and c not in after_letter)) + MARK
        stop = f"[{alone}]|" if alone else ""
        return re.compile(rf"{MARK}*+[^\W\d_]++(?=[{ends}{alone}]|\Z)|{stop}{MARK}*+[^{MARK}{alone}]++|{MARK}++")

    def _merge(self, text: str) -> list[str]:
        """Plain merging of a short string: the highest score first, the leftmost of equals."""
        get = self.score.get
        parts = list(text)
        none = float("-inf")
        scores = [get(x + y, none) for x, y in zip(parts, parts[1:])]
        while scores:
            best = max(scores)
            if best == none:
                break
            i = scores.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i < len(scores):
                scores[i] = get(parts[i] + parts[i + 1], none)
            if i:
                scores[i - 1] = get(parts[i - 1] + parts[i], none)
        return parts

    def _follows(self, a: str, b: str) -> bool:
        ok = self.pairs.get((a, b))
        if ok is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            ok = self.pairs[a, b] = self._merge(a + b) == [a, b]
        return ok

    def marked(self, text: str) -> str:
        text = text.replace(" ", MARK)
        return MARK + text if self.prefix and text else text

    def split(self, text: str) -> list[str]:
        text = self.marked(text)
        return self.cut.findall(text) if self.cut else [text] if text else []

    def _piece_ids(self, piece: str) -> tuple[int, ...]:
        """A character outside the vocabulary: its bytes, or the unknown piece."""
        if self.bytes_known:
            return tuple(self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass"))
        return (self.unknown,)

    def encode_sorted(self, words: list[str]) -> Iterator[tuple[str, tuple[int, ...]]]:
        """Ids of sorted distinct words; the forward table of a common prefix is kept."""
        last: list[str] = [""]       # last[i]: last piece of the best segmentation of word[:i]
        total: list[float] = [0.0]   # unigram: its score
        before, tuples = "", self.tuples
        extend = self._extend_bpe if self.bpe else self._extend_unigram
        for word in words:
            same, most = 0, min(len(before), len(word), len(last) - 1)
            while same < most and before[same] == word[same]:
                same += 1
            del last[same + 1:], total[same + 1:]
            extend(word, last, total)
            out: tuple[int, ...] = ()
            i = len(word)
            while i:
                piece = last[i]
                out = (tuples.get(piece) or self._piece_ids(piece)) + out
                i -= len(piece)
            yield word, out
            before = word

    def _extend_bpe(self, word: str, last: list[str], total: list[float]) -> None:
        reached, ends, pairs, follows = self.reached, self.ends, self.pairs, self._follows
        for i in range(len(last), len(word) + 1):
            able = []
            j = i - 2
            while j >= 0 and (piece := word[j:i]) in ends:
                if piece in reached:
                    able.append(piece)
                j -= 1
            found = word[i - 1]
            while able:
                piece = able.pop()
                j = i - len(piece)
                if j == 0:
                    found = piece
                    break
                ok = pairs.get((last[j], piece))
                if ok or (ok is None and follows(last[j], piece)):
                    found = piece
                    break
            last.append(found)
            total.append(0.0)

    def _extend_unigram(self, word: str, last: list[str], total: list[float]) -> None:
        score = self.score
        for i in range(len(last), len(word) + 1):
            best, found = total[i - 1] + score.get(word[i - 1], self.unknown_score), word[i - 1]
            for j in range(max(0, i - self.longest), i - 1):
                s = score.get(word[j:i])
                if s is not None and total[j] + s > best:
                    best, found = total[j] + s, word[j:i]
            last.append(found)
            total.append(best)

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of some texts; each distinct word is encoded once."""
        number: dict[str, int] = defaultdict()
        number.default_factory = number.__len__
        split, get = self.split, number.__getitem__
        at = [np.fromiter(map(get, split(t)), np.int32) for t in texts]
        number.default_factory = None
        known = self.words
        new = sorted(w for w in number if w not in known)
        fresh = dict(self.encode_sorted(new))
        ids = [known[w] if w in known else fresh[w] for w in number]
        known.update(islice(fresh.items(), max(0, CACHE_WORDS - len(known))))
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(size.sum()))
        first = np.concatenate(([0], np.cumsum(size)))
        parts, offsets = [], np.zeros(len(texts) + 1, np.int64)
        for k, a in enumerate(at):
            n = size[a]
            m = int(n.sum())
            offsets[k + 1] = offsets[k] + m
            start = np.repeat(first[a] - (np.cumsum(n) - n), n)
            parts.append(flat[start + np.arange(m)])
        return offsets, np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def decode(self, ids) -> str:
        raw = self.raw
        data = b"".join([raw[i] for i in ids])
        if self.prefix and data.startswith(b" "):
            data = data[1:]
        return data.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _model(path: str) -> PieceModel:
    return PieceModel(path)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, n_pieces, decoded) of every row.

    ``model`` is the path of a model file that every executor can open.
    ``decoded`` is the text rebuilt from the ids; it equals the input but for
    the word mark itself, which comes back as a space.  A null text has null
    ids, 0 pieces and a null ``decoded``, an empty one has no ids; row ids may be
    null or repeat; other columns are not read; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _model(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                null = pc.is_null(part.column(1))
                offsets, ids = m.encode_batch(pc.fill_null(part.column(1), "").to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
                decoded = [m.decode(ids[i:j].tolist()) for i, j in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.record_batch(
                    [part.column(0), pc.if_else(null, pa.nulls(len(part), lists.type), lists),
                     pa.array(np.diff(offsets)), pc.if_else(null, None, pa.array(decoded, pa.string()))],
                    names=["doc_id", "ids", "n_pieces", "decoded"])

    return (docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))
            .mapInArrow(trimmed(run), "doc_id long, ids array<int>, n_pieces long, decoded string"))


def decode(rows: DataFrame, model: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with a string column ``text`` decoded from ``ids_col`` (null for null)."""
    from pyspark.sql.types import StringType

    @F.pandas_udf(StringType())
    def text(ids):
        m = _model(model)
        return ids.map(lambda x: None if x is None else m.decode(list(x)))

    return rows.withColumn("text", text(F.col(f"`{ids_col}`")))
