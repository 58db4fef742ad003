"""Language identification with string kernels (operator 6).

The kernel of two texts is the blended-spectrum n-gram presence kernel: the
number of character n-grams (n = 1..3) that both hold, normalised by the
geometric mean of their own numbers.  A bounded set of labelled texts is the
training sample; some of them are Nyström landmarks, the kernel against the
landmarks whitened by their own kernel matrix gives features, and one ridge
regression per language (one against the rest) is solved in closed form.

Characters are lower-cased; letters and the marks that belong to them keep their code
point, runs of anything else are one blank.  Three code points of 21 bits fit one integer,
so every n-gram of every script is its own number and presence is exact.  Batches are scored by
matrix products: presence of the n-grams that most landmarks hold times a dense matrix, the
others by the landmarks' lists; then the kernel rows times the weights.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .frames import free_prefix, stored, trimmed

ORDERS = (1, 2, 3)
#: bounds of the training sample: whole texts per language, and how many of them are landmarks
TRAIN_PER_LANGUAGE = 400
LANDMARKS_PER_LANGUAGE = 60
RIDGE = 1e-3
#: n-grams, those that most landmarks hold, whose presence is multiplied densely; and texts of a product
DENSE = 16_384
BLOCK = 64
UNDETERMINED = "und"
#: a document whose best language scores less stands out from no other one and is rejected
MIN_SCORE = 0.3

_BITS = 21
_BLANK = 1


@cache
def _letters() -> np.ndarray:
    """Code point -> whether it is a letter or a mark."""
    return np.array([unicodedata.category(chr(i))[0] in "LM" for i in range(0x110000)])


def symbols(text: str) -> np.ndarray:
    """Code points + 1 of letters, one blank for each run of anything else."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    out = np.where(_letters()[points], points + 1, _BLANK)
    return out[(out != _BLANK) | (np.concatenate(([0], out[:-1])) != _BLANK)]


def ngrams(text: str) -> np.ndarray:
    """The distinct n-grams of a text, as numbers."""
    s = np.concatenate(([_BLANK], symbols(text), [_BLANK]))
    grams = []
    for n in ORDERS:
        if len(s) >= n:
            value = np.zeros(len(s) - n + 1, np.int64)
            for k in range(n):
                value = (value << _BITS) | s[k:len(s) - n + 1 + k]
            grams.append(value)
    return pd.unique(np.concatenate(grams))


@dataclass
class Landmarks:
    """The n-grams of the landmarks: which of them hold each."""

    keys: np.ndarray            # sorted n-grams that some landmark holds
    row: np.ndarray             # their rows; the first ones are rows of ``dense``
    dense: np.ndarray           # float32, n-gram x landmark
    first: np.ndarray           # ranges of ``lists`` for the other rows
    lists: np.ndarray           # landmarks that hold the n-gram
    size: np.ndarray            # n-grams of each landmark

    @staticmethod
    def of(grams: list[np.ndarray]) -> Landmarks:
        size = np.array([len(g) for g in grams], np.float64)
        flat = np.concatenate([*grams, np.zeros(0, np.int64)])
        keys, code = np.unique(flat, return_inverse=True)
        held = np.bincount(code, minlength=len(keys))
        row = np.empty(len(keys), np.int64)
        row[np.argsort(-held, kind="stable")] = np.arange(len(keys))
        at, mark = row[code], np.repeat(np.arange(len(grams)), size.astype(np.int64))
        wide = min(DENSE, len(keys))
        dense = np.zeros((wide, len(grams)), np.float32)
        dense[at[at < wide], mark[at < wide]] = 1
        order = np.argsort(at[at >= wide], kind="stable")
        first = np.concatenate(([0], np.cumsum(np.bincount(at[at >= wide] - wide, minlength=len(keys) - wide)))).astype(np.int64)
        return Landmarks(keys, row, dense, first, mark[at >= wide][order].astype(np.int32), size)

    def kernel(self, grams: list[np.ndarray]) -> np.ndarray:
        """Kernel values of texts (their n-grams) x landmarks."""
        marks = len(self.size)
        out = np.zeros((len(grams), marks))
        if not len(self.keys):
            return out
        for i in range(0, len(grams), BLOCK):
            block = grams[i:i + BLOCK]
            n = np.array([len(g) for g in block])
            flat, text = np.concatenate(block), np.repeat(np.arange(len(block)), n)
            at = np.minimum(np.searchsorted(self.keys, flat), len(self.keys) - 1)
            known = self.keys[at] == flat
            row, text = self.row[at[known]], text[known]
            near = row < len(self.dense)
            presence = np.zeros((len(block), len(self.dense)), np.float32)
            presence[text[near], row[near]] = 1
            common = (presence @ self.dense).astype(np.float64)
            far = row[~near] - len(self.dense)
            count = self.first[far + 1] - self.first[far]
            place = np.repeat(self.first[far] - np.cumsum(count) + count, count) + np.arange(count.sum())
            cell = np.repeat(text[~near], count) * marks + self.lists[place]
            common += np.bincount(cell, minlength=common.size).reshape(common.shape)
            out[i:i + BLOCK] = common / np.sqrt(np.maximum(n[:, None] * self.size, 1))
        return out


@dataclass
class KernelModel:
    landmarks: Landmarks
    weights: np.ndarray         # landmark + 1 x language
    languages: list[str]

    def kernel(self, texts: list[str]) -> np.ndarray:
        return self.landmarks.kernel([ngrams(t) for t in texts])

    def scores(self, texts: list[str]) -> np.ndarray:
        k = self.kernel(texts)
        return np.hstack([k, np.ones((len(k), 1))]) @ self.weights

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and a score from 0 to 1 (share of the best regression after a soft
        maximum); the first language in alphabetical order wins ties."""
        s = self.scores(texts)
        best = s.argmax(axis=1)
        p = np.exp(6 * (s - s.max(axis=1, keepdims=True)))
        return [self.languages[b] for b in best], (1 / p.sum(axis=1)) if len(s) else np.zeros(0)


def solve(landmarks: Landmarks, own: np.ndarray, rows: np.ndarray, labels: list[str]) -> KernelModel:
    """One-versus-rest ridge regressions on Nyström features: ``own`` is the kernel of the
    landmarks with each other, ``rows`` that of the training texts with the landmarks.
    Languages weigh alike whatever their numbers of texts."""
    languages = sorted(set(labels))
    value, vector = np.linalg.eigh(own)
    keep = value > 1e-8 * value.max()
    whiten = vector[:, keep] / np.sqrt(value[keep])
    x = np.hstack([rows @ whiten, np.ones((len(rows), 1))])
    lang = np.array([languages.index(v) for v in labels])
    y = np.where(lang[:, None] == np.arange(len(languages)), 1.0, -1.0)
    weight = 1 / np.bincount(lang, minlength=len(languages))[lang]
    gram = x.T @ (x * weight[:, None])
    solved = np.linalg.solve(gram + RIDGE * np.eye(len(gram)), x.T @ (y * weight[:, None]))
    return KernelModel(landmarks, np.vstack([whiten @ solved[:-1], solved[-1:]]), languages)


def _no_model() -> KernelModel:
    return KernelModel(Landmarks.of([]), np.zeros((1, 0)), [])


def _landmark_rows(labels: list[str]) -> list[int]:
    """The first LANDMARKS_PER_LANGUAGE rows of each language."""
    taken: dict[str, int] = {}
    out = []
    for i, lang in enumerate(labels):
        taken[lang] = taken.get(lang, 0) + 1
        if taken[lang] <= LANDMARKS_PER_LANGUAGE:
            out.append(i)
    return out


def fit(sample: list[tuple[str, str]]) -> KernelModel:
    """The model of (text, language) pairs held in memory, in the given order."""
    if not sample:
        return _no_model()
    grams = [ngrams(t) for t, _ in sample]
    chosen = _landmark_rows([lang for _, lang in sample])
    marks = Landmarks.of([grams[i] for i in chosen])
    rows = marks.kernel(grams)
    return solve(marks, rows[chosen], rows, [lang for _, lang in sample])


def training_sample(docs: DataFrame) -> DataFrame:
    """(lang, slot, text): at most TRAIN_PER_LANGUAGE whole texts of each language, those with the
    smallest hash of the text in each of as many hash slots; equal texts count once.

    Hashes are folded before they are shuffled; the texts themselves only leave the rows that were
    chosen, at most TRAIN_PER_LANGUAGE a language."""
    slot = F.pmod(F.xxhash64("text", F.lit(7)), F.lit(TRAIN_PER_LANGUAGE))
    rows = (docs.where("text is not null and lang is not null").where(F.col("text").rlike(r"\p{L}"))
            .select("lang", slot.alias("slot"), F.xxhash64("text", F.lit(11)).alias("h"), "text"))
    chosen = stored(rows.groupBy("lang", "slot").agg(F.min("h").alias("h")))
    return stored(rows.join(F.broadcast(chosen), ["lang", "slot", "h"]).dropDuplicates(["lang", "slot", "h"])
                  .select("lang", "slot", "text"))


def fit_on(docs: DataFrame) -> KernelModel:
    """The model of a table (text, lang).  Tasks work out n-grams and kernel rows; the driver takes the
    landmarks' n-grams and one kernel row a training text, both bounded by the sample."""
    sample = training_sample(docs)
    order = [(r["lang"], r["slot"]) for r in sample.select("lang", "slot").orderBy("lang", "slot").collect()]
    if not order:
        return _no_model()
    chosen = [order[i] for i in _landmark_rows([lang for lang, _ in order])]
    wanted = sample.sparkSession.createDataFrame(chosen, "lang string, slot long")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                yield pa.record_batch([*row.columns[:2], pa.array([ngrams(row.column(2)[0].as_py()).tobytes()])], names=["lang", "slot", "v"])

    schema = "lang string, slot long, v binary"
    found = {(r["lang"], r["slot"]): np.frombuffer(r["v"], np.int64) for r in
             sample.join(F.broadcast(wanted), ["lang", "slot"]).select("lang", "slot", "text").mapInArrow(trimmed(grams), schema).collect()}
    marks = Landmarks.of([found[k] for k in chosen])
    shared = sample.sparkSession.sparkContext.broadcast(marks)

    def kernels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                part = batch.slice(i, BLOCK)
                k = shared.value.kernel([ngrams(t) for t in part.column(2).to_pylist()])
                yield pa.record_batch([*part.columns[:2], pa.array([v.tobytes() for v in k])], names=["lang", "slot", "v"])

    rows = {(r["lang"], r["slot"]): np.frombuffer(r["v"]) for r in
            sample.select("lang", "slot", "text").mapInArrow(trimmed(kernels), schema).collect()}
    return solve(marks, np.array([rows[k] for k in chosen]), np.array([rows[k] for k in order]), [lang for lang, _ in order])


def held_out(id_col):
    """crc32 of the id as text, modulo 5, is 0 (null ids are not held out)."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             keep: tuple[str, ...] | None = None, prefix: str = "") -> DataFrame:
    """The ``keep`` columns (the id as ``doc_id`` by default) of every row with held_out, lang_pred
    and score (named with ``prefix``), learned from the rows not held out.

    Null texts and texts without a letter are ``und`` with score 0, as is every
    text when no labelled one exists; ids may be null or repeat; other columns
    aren't read; an empty table gives no rows.  Whole texts are scored.
    """
    text = F.col(f"`{text_col}`").cast("string")
    out = held_out(F.col(f"`{id_col}`").cast("long"))
    kept = [F.col(f"`{c}`") for c in keep] if keep else [F.col(f"`{id_col}`").cast("long").alias("doc_id")]
    model = fit_on(docs.select(text.alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"), out.alias("out")).where("not out"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [prefix + n for n in ("held_out", "lang_pred", "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = pc.fill_null(part.column(at_text), "")
                known = np.asarray(pc.match_substring_regex(texts, r"\p{L}").to_pylist(), bool) & bool(m.languages)
                lang = np.full(len(part), UNDETERMINED, object)
                score = np.zeros(len(part))
                if known.any():
                    lang[known], score[known] = m.predict(texts.filter(pa.array(known)).to_pylist())
                yield pa.record_batch([*part.columns[:n_kept], pa.array(lang, pa.string()), pa.array(score)],
                                      names=[*part.schema.names[:n_kept], *names[1:]])

    rows = docs.select(*kept, out.alias(names[0]))
    n_kept = len(rows.columns)
    same = bool(keep) and text_col in keep and dict(docs.dtypes)[text_col] == "string"
    at_text = keep.index(text_col) if same else n_kept
    if not same:
        rows = docs.select(*kept, out.alias(names[0]), text.alias(free_prefix(rows.columns, ("whole_text",)) + "whole_text"))
    schema = StructType([*rows.schema.fields[:n_kept], StructField(names[1], StringType()), StructField(names[2], DoubleType())])
    return rows.mapInArrow(trimmed(run), schema)


def identified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` (all columns) whose language is determined with at least ``min_score``."""
    p = free_prefix(docs.columns, ("held_out", "lang_pred", "score"))
    rows = identify(docs, keep=tuple(docs.columns), prefix=p)
    return rows.where((F.col(p + "lang_pred") != UNDETERMINED) & (F.col(p + "score") >= min_score)).select(*[F.col(f"`{c}`") for c in docs.columns])
